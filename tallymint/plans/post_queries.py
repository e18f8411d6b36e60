"""Queries over submissions and comments."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import week_start
from ..operators import mentions, weekly
from .registry import query
from .views import POSTS_SINCE, Views, with_views

# Words that occur in the test texts stand in for the terms of the report.
TERMS = mentions.Terms(card="licen[cs]e[s]?", trading="[eé]ou", market="apache")
POSTS = with_views("submissions", "comments")[:-1] + """, posts AS (
    SELECT CAST(date_trunc('week', created_utc) AS DATE) AS week_start, title, selftext AS body FROM submissions
    WHERE created_utc >= DATE '2010-01-01'
    UNION ALL SELECT CAST(date_trunc('week', created_utc) AS DATE), NULL, body FROM comments
    WHERE created_utc >= DATE '2010-01-01') """


def _hit(pattern: str) -> str:
    return (f"(COALESCE(regexp_matches(lower(title), '{pattern}'), FALSE) "
            f"OR COALESCE(regexp_matches(lower(body), '{pattern}'), FALSE))")


A, B, M = _hit(TERMS.card), _hit(TERMS.trading), _hit(TERMS.market)


@query("mention_counts", POSTS + f"""SELECT week_start, COUNT(*) FILTER (WHERE a) AS pokemon_card_total_count,
    COUNT(*) FILTER (WHERE b) AS trading_card_total_count, COUNT(*) FILTER (WHERE a OR b) AS all_cards_total_count,
    COUNT(*) FILTER (WHERE m) AS ebay_total_count, COUNT(*) FILTER (WHERE m AND b) AS ebay_trading_total_count,
    COUNT(*) FILTER (WHERE m AND a) AS ebay_pokemon_total_count,
    COUNT(*) FILTER (WHERE m AND (a OR b)) AS ebay_all_cards_total_count, COUNT(*) AS total_reddit_count
    FROM (SELECT week_start, {A} AS a, {B} AS b, {M} AS m FROM posts) GROUP BY week_start""")
def mention_counts(v: Views) -> DataFrame:
    return mentions.mention_counts(mentions.posts(v.submissions, v.comments, POSTS_SINCE), TERMS)


@query("cross_field_match", with_views("submissions") + """SELECT id FROM submissions WHERE
    (regexp_matches(lower(title), '[eé]ou') AND regexp_matches(lower(title), 'the'))
    OR (regexp_matches(lower(selftext), '[eé]ou') AND regexp_matches(lower(selftext), 'the'))
    OR (regexp_matches(lower(title), '[eé]ou') AND regexp_matches(lower(selftext), 'the'))
    OR (regexp_matches(lower(selftext), '[eé]ou') AND regexp_matches(lower(title), 'the'))""")
def cross_field_match(v: Views) -> DataFrame:
    return mentions.cross_field_match(v.submissions, "[eé]ou", "the").select("id")


@query("spine_union", with_views("submissions", "comments") + """
    SELECT CAST(date_trunc('week', created_utc) AS DATE) AS week_start FROM submissions
    UNION SELECT CAST(date_trunc('week', created_utc) AS DATE) FROM comments""")
def spine_union(v: Views) -> DataFrame:
    week = week_start("created_utc").alias("week_start")
    return weekly.spine_union(v.submissions.select(week), v.comments.select(week))


CONTENT = """SELECT 'comment' AS content_type, id, author, created_utc AS created_datetime, subreddit_name_prefixed,
      body AS content, score, parent_id, link_id FROM comments WHERE body <> '[deleted]' AND author <> '[deleted]' {0}
    UNION ALL SELECT 'submission', id, author, created_utc, subreddit_name_prefixed,
      title || ' | ' || COALESCE(selftext, ''), score, NULL, NULL FROM submissions
      WHERE author <> '[deleted]' AND (selftext IS NULL OR selftext <> '[deleted]') {1}"""


@query("content_union", with_views("submissions", "comments") + CONTENT.format("", ""))
def content_union(v: Views) -> DataFrame:
    return mentions.content_union(v.submissions, v.comments)


@query("mentioning", with_views("submissions", "comments") + CONTENT.format(
    "AND lower(body) LIKE '%apache%'",
    "AND (lower(title) LIKE '%apache%' OR lower(selftext) LIKE '%apache%')"))
def mentioning(v: Views) -> DataFrame:
    return mentions.content_union(*mentions.mentioning(v.submissions, v.comments, "apache"))


def checked_sample(content: DataFrame, seed: int | None) -> DataFrame:
    """What can be said of a sample: its size, that its rows are different rows of the content, and whether it repeats."""
    one, two = (mentions.sample(content, 100, seed=seed).select("content_type", "id") for _ in range(2))
    members = one.join(content.select("content_type", "id").distinct(), ["content_type", "id"], "left_semi")
    found = one.agg(F.count("*").alias("n"), F.count_distinct("content_type", "id").alias("different"))
    found = found.crossJoin(members.agg(F.count("*").alias("members")))
    if seed is not None:
        found = found.crossJoin(one.join(two, ["content_type", "id"], "left_semi").agg(F.count("*").alias("again")))
    return found


def sample_sql(content: str, seed: bool = True) -> str:
    columns = ["n", "different", "members"] + ["again"] * seed
    return f"SELECT {', '.join(f'least(100, COUNT(*)) AS {c}' for c in columns)} FROM ({content})"


@query("sample_mentions", with_views("submissions", "comments") + sample_sql(CONTENT.format(
    "AND lower(body) LIKE '%the%'", "AND (lower(title) LIKE '%the%' OR lower(selftext) LIKE '%the%')")))
def sample_mentions(v: Views) -> DataFrame:
    return checked_sample(mentions.content_union(*mentions.mentioning(v.submissions, v.comments, "the")), seed=7)


MARKET_SQL = CONTENT.format(
    "AND created_utc >= DATE '2010-01-01' AND regexp_matches(lower(body), 'apache') "
    "AND (regexp_matches(lower(body), 'licen[cs]e[s]?') OR regexp_matches(lower(body), '[eé]ou'))",
    f"AND created_utc >= DATE '2010-01-01' AND {M.replace('body', 'selftext')} "
    f"AND ({A.replace('body', 'selftext')} OR {B.replace('body', 'selftext')})")


@query("sample_market_and_cards", with_views("submissions", "comments") + sample_sql(MARKET_SQL))
def sample_market_and_cards(v: Views) -> DataFrame:
    wanted = mentions.market_and_cards(v.submissions, v.comments, TERMS, POSTS_SINCE)
    return checked_sample(mentions.content_union(*wanted), seed=7)


@query("market_and_cards", with_views("submissions", "comments") + MARKET_SQL)
def market_and_cards(v: Views) -> DataFrame:
    return mentions.content_union(*mentions.market_and_cards(v.submissions, v.comments, TERMS, POSTS_SINCE))


@query("sample_random", with_views("submissions", "comments") + sample_sql(CONTENT.format("", ""), seed=False))
def sample_random(v: Views) -> DataFrame:
    return checked_sample(mentions.content_union(v.submissions, v.comments), seed=None)
