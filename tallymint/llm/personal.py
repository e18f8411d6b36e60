"""Personal data: patterns, and terms that give protected values away, in DataFrame expressions only.

Base spans are e-mail addresses, IP addresses, card numbers and phone numbers. Beyond them, the corpus tells how much a
term in a document with a protected value reveals it: pointwise mutual information of term and value over the value's
information content, from counts of documents over the whole corpus. It is 1 where the term occurs only together with that
value. Terms from GENERALISE on are replaced by a class, from REMOVE on they are taken out, wherever they stand outside
base spans, also in documents without the value.

Ordinary words stay, as a term needs evidence. It must stand with the value in LEAST_SUPPORT documents that aren't near
copies of one another (Jaccard similarity of their words below LIKE), most documents with the term must have the value,
and so many of them by chance must be so unlikely that of all pairs of value and term tried CHANCE would be found. The
share is lowered by its support, so little evidence doesn't remove a word. Near copies of a value's documents are set
apart by LEADERS rounds: each takes a document as leader, and those like it are its class; what then is left counts by
its least word hash, which near copies nearly always share. So no two documents are compared but with a leader.

Defined cases: a null or empty text has no spans; null ids are allowed; rows that repeat with the same id and text have
the same spans and count as one document; an empty table gives no rows; output columns replace those of the same names.
Positions count code points, ends are exclusive. Spans that overlap are masked as their union, under the first one's name.

Patterns are written so that the matcher never tries a run of characters twice or recurs: a match can't begin inside a
run unless the last match ended there, and separators that can't belong to a match are first replaced, one for one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import documents, stored, text_of
from .registry import query

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
#: The least letters of a term.
TERM_LETTERS = 4
WORD = r"\p{L}{%d,}" % TERM_LETTERS
LEAST_SUPPORT, LIKE, LEADERS, CHANCE = 3, 0.8, 4, 0.01
GENERALISE, REMOVE = 0.6, 0.8
SPAN = "array<struct<kind:string,start:int,end:int>>"


def located(text: Column, pattern: str, when: Column, valid=None) -> Column:
    """Matches of a pattern as (start, match), where ``when`` holds; others are dropped by ``valid``."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches)).alias("gap"), matches.alias("match"))
    empty = F.array().cast("array<struct<start:int,match:string>>")
    walked = F.aggregate(
        pairs, F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda a, z: F.struct(
            (a["at"] + F.length(z["gap"]) + F.length(z["match"])).alias("at"),
            F.array_append(a["out"], F.struct((a["at"] + F.length(z["gap"])).alias("start"), z["match"].alias("match"))).alias("out")))["out"]
    if valid is not None:
        walked = F.filter(walked, lambda s: valid(s["match"]))
    return F.when(when, walked).otherwise(empty)


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]+", "")


def luhn(c: Column) -> Column:
    """Whether the digits pass Luhn's check: from the right every second digit counts double, cast to its digit sum."""
    places = F.sequence(F.lit(1), F.length(c))

    def worth(i):
        d = F.substring(F.reverse(c), i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(places, F.lit(0), lambda a, i: a + worth(i)) % 10 == 0


def small_parts(c: Column) -> Column:
    bare = F.transform(F.split(c, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
    return F.forall(bare, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))


def base_spans(text: Column) -> Column:
    """Base spans by kind as listed, then start: kind, start, end."""
    # A full stop with no label character behind it can't be in a domain; '%' serves a local part as well as it.
    mail = F.regexp_replace(text, r"\.(?![A-Za-z0-9-])", "%")
    local = "A-Za-z0-9._%+-"
    # Spaces and hyphens that don't stand between two digits end a card number.
    card = F.regexp_replace(text, "(?<![0-9])[ -]|[ -](?![0-9])", "\n")
    found = {
        "email": located(mail, rf"(?:\G|(?<![{local}]))[{local}]++@[A-Za-z0-9-]++\.[A-Za-z0-9.-]++", F.contains(text, F.lit("@"))),
        "ip": located(text, r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", text.rlike(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]"), small_parts),
        "card": located(card, "(?<![0-9 -])(?=[0-9](?:[ -]?[0-9]){15})[0-9 -]++", text.rlike("[0-9](?:[ -]?[0-9]){15}"),
                        lambda m: F.length(digits(m)).between(16, 19) & luhn(digits(m))),
        "phone": located(text, r"\+[0-9][ ().0-9-]+[0-9]", text.rlike(r"\+[0-9]"), lambda m: F.length(digits(m)).between(8, 15)),
    }

    def named(kind):
        return F.transform(found[kind], lambda s: F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("start"), (s["start"] + F.length(s["match"])).alias("end")))

    return F.concat(*map(named, KINDS)).cast(SPAN)


def with_base(docs: DataFrame, text: str) -> DataFrame:
    """The rows with ``_text`` and ``_spans``. A generator keeps later filters from repeating the search."""
    rows = docs.withColumn("_text", text_of(text))
    return rows.withColumn("_spans", F.explode(F.array(base_spans(F.col("_text")))))


def terms_of(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lower))


def protected(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Protected values: row (``_id``, ``_row``), value (``entity``), and at one value of each row the ``terms`` of the
    whole text outside base spans."""
    rows = with_base(docs.select(F.col(key).alias("_id"), F.col(text)), text).where(F.size("_spans") > 0)
    outside = F.aggregate("_spans", F.col("_text"), lambda t, s: F.overlay(t, F.repeat(F.lit("\n"), s["end"] - s["start"]), s["start"] + 1, s["end"] - s["start"]))
    rows = rows.select("_id", F.xxhash64("_text").alias("_row"), "_text", outside.alias("_outside"), F.posexplode("_spans").alias("k", "s"))
    return rows.select(
        "_id", "_row", F.concat_ws(":", "s.kind", F.lower(F.substring("_text", F.col("s.start") + 1, F.col("s.end") - F.col("s.start")))).alias("entity"),
        F.when(F.col("k") == 0, terms_of(F.col("_outside"))).alias("terms"))


def in_classes(members: DataFrame) -> DataFrame:
    """Documents of each value (``entity``, ``_id``, ``_row``, ``terms``) with a ``class`` that near copies share."""
    members = stored(members.withColumn("class", F.lit(None).cast("string")), "members")
    for leader in range(LEADERS):
        free = members.where("class IS NULL")
        if free.isEmpty():
            break
        leaders = free.groupBy("entity").agg(F.min_by("terms", F.struct("_row", "_id")).alias("_leader"))
        both = F.size(F.array_intersect("terms", "_leader"))
        either = F.size("terms") + F.size("_leader") - both
        like = (either == 0) | (both >= LIKE * either)
        named = F.coalesce("class", F.when(like, F.lit(f"leader {leader}")))
        members = stored(members.join(leaders, "entity", "left").withColumn("class", named).drop("_leader"), "members")
    least = F.array_min(F.transform("terms", lambda t: F.xxhash64(t))).cast("string")
    return members.withColumn("class", F.coalesce("class", least, F.lit("")))


def disclosures(docs: DataFrame, near: DataFrame, text: str) -> DataFrame:
    """Terms that reveal a value: ``entity``, ``term`` and ``share``, the part of the value's information they give."""
    held = near.select("entity", "_id", "_row").distinct()
    entities = held.groupBy("entity").agg(F.count("*").alias("with_entity"))
    entities = stored(entities.where(F.col("with_entity") >= LEAST_SUPPORT), "entities")
    if entities.isEmpty():
        return entities.select("entity", F.lit("").alias("term"), F.lit(0.0).alias("share"))
    texts = near.where("terms IS NOT NULL").dropDuplicates(["_id", "_row"]).select(F.col("_id").alias("_i"), F.col("_row").alias("_r"), "terms")
    same = F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_row") == F.col("_r"))
    members = in_classes(held.join(entities, "entity").join(texts, same).drop("_i", "_r"))
    pairs = members.select("entity", "with_entity", "class", F.explode("terms").alias("term")).groupBy(
        "entity", "with_entity", "term").agg(F.count("*").alias("both"), F.count_distinct("class").alias("support"))
    pairs = stored(pairs, "pairs")
    tried, total = pairs.count(), float(docs.count())
    enough = pairs.where(F.col("support") >= LEAST_SUPPORT)
    # Summed in each task before anything is joined: the join meets one row per word, not one per occurrence.
    seen = docs.select(F.explode(terms_of(text_of(text))).alias("term")).groupBy("term").agg(F.count("*").alias("with_term"))
    part = F.col("both") / F.col("with_term")
    found = enough.join(seen, "term").withColumn("part", F.least(part, F.lit(1.0))).where(F.col("part") >= 0.5)
    information = F.log2(F.lit(total) / F.col("with_entity"))
    mutual = F.log2(F.lit(total) * F.col("both") / (F.col("with_term") * F.col("with_entity")))
    # Bits of evidence: as many unlike documents, chosen by chance among those with the term, all having the value.
    rest = 1 - F.col("part")
    entropy = -F.col("part") * F.log2("part") - F.when(rest > 0, rest * F.log2(rest)).otherwise(F.lit(0.0))
    bits = F.col("support") * (information - entropy / F.col("part"))
    share = mutual / information * F.col("support") / (F.col("support") + 1)
    sure = found.where((information > 0) & (bits >= F.log2(F.lit(max(1, tried) / CHANCE))))
    return sure.select("entity", "term", share.alias("share")).where(F.col("share") >= GENERALISE)


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with ``base_spans``, and ``term_spans`` with the share that each term reveals."""
    columns = [c for c in docs.columns if c not in ("base_spans", "term_spans")]
    # Only documents with protected values. Written, as three steps read it.
    near = stored(protected(docs, key, text), "near")
    flagged = stored(disclosures(docs, near, text).groupBy("term").agg(F.max("share").alias("share")), "flagged")
    # All documents with a flagged term, whether or not they have the value.
    with_terms = docs.select(F.col(key).alias("_id"), text_of(text).alias("_text"))
    with_terms = with_terms.select("_id", F.xxhash64("_text").alias("_row"), F.explode(terms_of(F.col("_text"))).alias("term")).join(flagged, "term")
    with_terms = with_terms.groupBy("_id", "_row").agg(F.map_from_entries(F.array_distinct(F.collect_list(F.struct("term", "share")))).alias("_wanted"))
    with_terms = stored(with_terms, "term-rows")
    # The input travels in one column, so its names can't clash with those used here.
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col(key).alias("_key"), F.col(text).alias("_value"))
    rows = with_base(packed, "_value").withColumn("_hash", F.xxhash64("_text"))
    same = F.col("d._key").eqNullSafe(F.col("s._id")) & (F.col("d._hash") == F.col("s._row"))
    rows = rows.alias("d").join(with_terms.alias("s"), same, "left")
    none = F.array().cast("array<struct<start:int,end:int,share:double>>")
    matches = F.regexp_extract_all("_text", F.lit(WORD), F.lit(0))
    pairs = F.arrays_zip(F.slice(F.split("_text", WORD, -1), F.lit(1), F.size(matches)).alias("gap"), matches.alias("match"))

    def step(a, z):
        start = a["at"] + F.length(z["gap"])
        end = start + F.length(z["match"])
        share = F.try_element_at("_wanted", F.lower(z["match"]))
        span = F.struct(start.alias("start"), end.alias("end"), share.alias("share"))
        return F.struct(end.alias("at"), F.when(share.isNotNull(), F.array_append(a["out"], span)).otherwise(a["out"]).alias("out"))

    terms = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("out")), step)["out"]
    terms = F.filter(terms, lambda t: ~F.exists("_spans", lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])))
    found = rows.select("_doc", F.struct(
        F.col("_spans").alias("base"), F.when(F.col("_wanted").isNotNull(), terms).otherwise(none).alias("terms")).alias("_found"))
    return found.select(*[found["_doc"][c].alias(c) for c in columns],
                        found["_found"]["base"].alias("base_spans"), found["_found"]["terms"].alias("term_spans"))


def sanitise(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with protected values masked by their kind, revealing terms generalised or removed."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(key).alias("key"), F.col(text).alias("text"))
    rows = find(packed, "key", "text")
    base = F.transform("base_spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("mask")))
    terms = F.transform("term_spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.when(s["share"] >= REMOVE, F.lit("")).otherwise(F.lit("[TERM]")).alias("mask")))
    kind = "array<struct<start:int,end:int,mask:string>>"
    spans = F.sort_array(F.concat(base.cast(kind), terms.cast(kind)))
    apart = F.aggregate(
        spans, F.struct(F.lit(0).alias("end"), F.array().cast(kind).alias("out")),
        lambda a, s: F.struct(F.greatest(a["end"], s["end"]).alias("end"), F.array_append(a["out"], F.struct(
            F.greatest(a["end"], s["start"]).alias("start"), F.greatest(a["end"], s["end"]).alias("end"),
            F.when(s["start"] >= a["end"], s["mask"]).otherwise(F.lit("")).alias("mask"))).alias("out")))["out"]
    rows = rows.withColumn("_apart", F.explode(F.array(apart)))
    body, spans = text_of("text"), F.col("_apart")
    ends = F.transform(spans, lambda s: s["end"])
    parts = F.transform(spans, lambda s, i: F.concat(
        F.substring(body, F.when(i > 0, F.get(ends, i - 1)).otherwise(F.lit(0)) + 1, s["start"] - F.when(i > 0, F.get(ends, i - 1)).otherwise(F.lit(0))), s["mask"]))
    rest = F.substring(body, F.element_at(ends, -1) + 1, F.length(body))
    clean = F.when(F.size(spans) > 0, F.concat(F.array_join(parts, ""), rest)).otherwise(F.col("text"))
    done = rows.select("doc", clean.alias("clean"))
    return done.select(*[done["clean"].alias(c) if c == text else done["doc"][c].alias(c) for c in docs.columns])


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@query("op10_personal_data")
def op10_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's base spans and terms that reveal them."""
    rows = find(documents(spark, folder).select("doc_id", "text"))

    def count(kind):
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = map(count, KINDS)
    terms = F.transform("term_spans", lambda s: F.struct(F.lit(TERM).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).cast(SPAN)
    return rows.select("doc_id", *counts, F.sha2(listed(F.col("base_spans")), 256).alias("base_sha256"),
                       listed(F.concat("base_spans", terms)).alias("spans"))
