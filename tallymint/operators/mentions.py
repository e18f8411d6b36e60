"""Weekly counts of posts that mention some terms, and samples of such posts."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import week_start
from ..functions.text import content_text, matches, mentions
from .filters import in_both, live_comments, live_submissions

# Fixed value: posts before this day are not counted.
SINCE = dt.date(2010, 1, 1)


@dataclass(frozen=True)
class Terms:
    """The three patterns of a mention report: two kinds of card and the market place."""

    # The patterns, matched on lower-cased text.
    card: str = r"pok[eé]mon card[s]?"
    trading: str = r"trading card[s]?"
    market: str = r"ebay"


def posts(submissions: DataFrame, comments: DataFrame, since: dt.date = SINCE) -> DataFrame:
    """Submissions and comments as ``week_start, kind, title, body``, in lower case; a comment has no title."""
    def part(df: DataFrame, kind: str, title: Column, body: str) -> DataFrame:
        day = F.col("created_utc").cast("date")
        return df.filter(day >= F.lit(since)).select(
            week_start("created_utc").alias("week_start"), F.lit(kind).alias("kind"),
            F.lower(title.cast("string")).alias("title"), F.lower(body).alias("body"),
        )

    return part(submissions, "submission", F.col("title"), "selftext").unionByName(
        part(comments, "comment", F.lit(None), "body")
    )


def some(pattern: str, title: str = "title", body: str = "body") -> Column:
    """The pattern occurs in the title or the body, whatever their case."""
    return F.coalesce(matches(title, pattern), F.lit(False)) | F.coalesce(matches(body, pattern), F.lit(False))


def mention_counts(content: DataFrame, terms: Terms = Terms()) -> DataFrame:
    """Posts per week by the terms they mention, and all posts, in one pass over the text.

    ``content`` comes from :func:`posts`. A post that has one term in its title and another in its
    body mentions both.
    """
    def hit(pattern: str) -> Column:
        return F.coalesce(F.col("title").rlike(pattern), F.lit(False)) \
            | F.coalesce(F.col("body").rlike(pattern), F.lit(False))

    flags = content.select(
        "week_start", hit(terms.card).alias("card"), hit(terms.trading).alias("trading"), hit(terms.market).alias("market")
    )
    card, trading, market = F.col("card"), F.col("trading"), F.col("market")
    return flags.groupBy("week_start").agg(
        F.count_if(card).alias("pokemon_card_total_count"),
        F.count_if(trading).alias("trading_card_total_count"),
        F.count_if(card | trading).alias("all_cards_total_count"),
        F.count_if(market).alias("ebay_total_count"),
        F.count_if(market & trading).alias("ebay_trading_total_count"),
        F.count_if(market & card).alias("ebay_pokemon_total_count"),
        F.count_if(market & (card | trading)).alias("ebay_all_cards_total_count"),
        F.count("*").alias("total_reddit_count"),
    ).orderBy("week_start")


def cross_field_match(submissions: DataFrame, pattern_a: str, pattern_b: str) -> DataFrame:
    """Submissions that have pattern A in title or text and pattern B in title or text."""
    fields = [F.col("title"), F.col("selftext")]
    return submissions.filter(in_both(fields, lambda c: matches(c, pattern_a), lambda c: matches(c, pattern_b)))


def content_union(submissions: DataFrame, comments: DataFrame) -> DataFrame:
    """Live comments and submissions in one layout; a submission's text is title and body."""
    a = live_comments(comments).select(
        F.lit("comment").alias("content_type"), "id", "author", F.col("created_utc").alias("created_datetime"),
        "subreddit_name_prefixed", F.col("body").alias("content"), "score", "parent_id", "link_id",
    )
    b = live_submissions(submissions).select(
        F.lit("submission").alias("content_type"), "id", "author", F.col("created_utc").alias("created_datetime"),
        "subreddit_name_prefixed", content_text("title", "selftext").alias("content"), "score",
        F.lit(None).cast("string").alias("parent_id"), F.lit(None).cast("string").alias("link_id"),
    )
    return a.unionByName(b)


def mentioning(submissions: DataFrame, comments: DataFrame, needle: str) -> tuple[DataFrame, DataFrame]:
    """Submissions and comments whose text contains a word."""
    hit = F.coalesce(mentions("title", needle), F.lit(False)) | F.coalesce(mentions("selftext", needle), F.lit(False))
    return submissions.filter(hit), comments.filter(mentions("body", needle))


def market_and_cards(submissions: DataFrame, comments: DataFrame, terms: Terms = Terms(),
                     since: dt.date = SINCE) -> tuple[DataFrame, DataFrame]:
    """Submissions and comments that mention the market place and any kind of card."""
    def wanted(df: DataFrame, title: str, body: str) -> DataFrame:
        cards = some(terms.card, title, body) | some(terms.trading, title, body)
        return df.filter((F.col("created_utc").cast("date") >= F.lit(since)) & some(terms.market, title, body) & cards)

    return wanted(submissions, "title", "selftext"), wanted(comments, "body", "body")


def sample(content: DataFrame, size: int = 100, seed: int | None = 0) -> DataFrame:
    """A uniform random sample of ``size`` rows.

    With a seed the order is a hash of the row's identity, so the sample can be repeated on any
    cluster; without one it is new each time. Each task keeps only its own best ``size`` rows.
    """
    order = F.rand() if seed is None else F.xxhash64(F.lit(seed), "content_type", "id")
    return content.orderBy(order, "content_type", "id").limit(size)
