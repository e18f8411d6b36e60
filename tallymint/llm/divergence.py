"""Quality rules by distribution divergence, in DataFrame expressions only.

Each language has two references, counted over all its documents: the shares of character classes among its characters,
and the shares of its most frequent short words among its words. A document fails if the Jensen-Shannon distance (base
2) of its own histogram from its language's is too large, for words also if it is nearly that of a text without any
frequent word; histograms of short texts say little, so a guard on length leaves them out. Before that come plain rules: too few words, or too many words in repeated passages.

Word counts of the references are summed in each task first, so a hot language is a few rows; only the references are
joined to the documents, which never move.

Defined cases: a null or empty text has no words and fails the plain rules; a null language is a language of its own; a
text in a language without reference passes the distance rules; rows that repeat get equal results; an empty table gives
no rows. Output columns named in ``BASE`` and ``kept`` replace those of the input. Repeats of five words are found by
64-bit hashes of words, within one document only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import documents, stored, text_of
from .registry import query

SPACES = r"[\x20\x09-\x0D]+"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
#: Character classes that are rare in prose, as regular expressions, and single characters that are classes. White space,
#: the bytes by which UTF-8 is longer than the text, and what is left (mostly lower-case letters) are classes too.
CLASSES, SINGLES = ("A-Z", "0-9", "#*$%&<>"), (".", ",", "!", "|")
CELLS = len(CLASSES) + len(SINGLES) + 2
#: Frequent words: how many for a language, and the most characters in one.
TOP_WORDS, WORD_LENGTH = 20, 5
#: Guards: the least characters and words for a histogram to be compared.
LEAST_CHARS, LEAST_WORDS = 200, 50
#: The largest distances that pass.
CLASS_DISTANCE, WORD_DISTANCE = 0.20, 0.42
#: A text without any of the frequent words has a distance that their share among all words sets, and which may be below
#: WORD_DISTANCE. This part of it is too large as well, for a text long enough to expect so many frequent words in it.
WITHOUT, EXPECTED = 0.9, 10
PASSAGE = 5


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def class_counts(text: Column, word_chars: Column) -> list[Column]:
    """Characters in each class but the last; long runs outside a rare class make its removal cheap."""
    inside = [F.length(F.regexp_replace(text, f"[^{c}]+", "")) for c in CLASSES]
    single = [F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit(""))) for c in SINGLES]
    return [c.cast("long") for c in [*inside, *single, F.length(text) - word_chars, F.octet_length(text) - F.length(text)]]


def js_term(p: Column, q: Column) -> Column:
    """The part of one cell in the Jensen-Shannon divergence."""
    m = (p + q) / 2
    return (F.when(p > 0, p * F.log2(p / m)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0)) / 2


def references(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per language: ``class_share`` (array) and ``top_words`` with ``word_share`` (arrays), over all documents."""
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"), text_of(text).alias("text"))
    joined = F.length(F.array_join(words_of(F.col("text")), ""))
    counts = rows.select("lang", F.octet_length("text").cast("long").alias("chars"), *[c.alias(f"c{i}") for i, c in enumerate(class_counts(F.col("text"), joined))])
    total = counts.groupBy("lang").agg(F.sum("chars").alias("chars"), *[F.sum(f"c{i}").alias(f"c{i}") for i in range(CELLS)])
    shares = [F.when(F.col("chars") > 0, F.col(f"c{i}") / F.col("chars")).otherwise(0.0) for i in range(CELLS)]
    total = total.select("lang", F.array(*shares).alias("class_share"))
    words = rows.select("lang", F.explode(words_of(F.lower("text"))).alias("word"))
    # Long words are not candidates, but count in the total; they share one cell.
    short = F.when(F.length("word") <= WORD_LENGTH, F.col("word"))
    cells = stored(words.groupBy("lang", short.alias("word")).agg(F.count("*").alias("n")), "word-counts")
    all_words = cells.groupBy("lang").agg(F.sum("n").alias("total"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    top = cells.where("word IS NOT NULL").withColumn("place", F.row_number().over(order)).where(F.col("place") <= TOP_WORDS)
    top = top.join(all_words, "lang").groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "word", (F.col("n") / F.col("total")).alias("share")))).alias("top"))
    top = top.select("lang", F.col("top.word").alias("top_words"), F.col("top.share").alias("word_share"))
    return stored(total.join(top, "lang", "left"), "references")


def base_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with the columns of ``BASE``, and ``_words`` for later steps."""
    # Whatever repeats below is a column here, so that it is worked out once.
    rows = docs.withColumns({"_text": text_of(text)}).withColumns({"_words": words_of(F.col("_text"))})
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumns({"_lines": lines, "_codes": F.transform("_words", lambda w: F.xxhash64(w))})
    codes = F.col("_codes")
    passages = F.when(F.size(codes) >= PASSAGE, F.transform(
        F.slice(codes, F.lit(1), F.greatest(F.size(codes) - (PASSAGE - 1), F.lit(0))),
        lambda x, i: F.xxhash64(x, *[F.get(codes, i + k) for k in range(1, PASSAGE)])))
    rows = rows.withColumn("_passages", passages)
    repeats = F.size(F.array_distinct("_passages")) < F.size("_passages")
    ordered = F.when(repeats, F.sort_array(F.transform("_passages", lambda x, i: F.struct(x.alias("h"), i.alias("i")))))
    rows = rows.withColumn("_ordered", ordered)
    o = F.col("_ordered")
    same = F.filter(o, lambda x, k: ((k > 0) & (F.get(o, k - 1)["h"] == x["h"])) | F.coalesce(F.get(o, k + 1)["h"] == x["h"], F.lit(False)))
    places = F.sort_array(F.transform(same, lambda x: x["i"]))
    covered = F.aggregate(
        places, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, p: F.struct((a["n"] + p + PASSAGE - F.greatest(p, a["end"])).alias("n"), (p + PASSAGE).alias("end")))["n"]
    n, repeated = F.size("_words").cast("long"), F.coalesce(covered, F.lit(0)).cast("long")
    rows = rows.withColumns({
        "n_words": n, "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace("_text", "[^#*$%&|<>]+", "")).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"), "n_repeat_words": repeated})
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return rows.withColumn("base_failed", failed).drop("_lines", "_codes", "_passages", "_ordered")


def judge(docs: DataFrame, refs: DataFrame | None = None, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows with the columns of ``BASE``, ``class_distance``, ``word_distance`` (null where guarded) and ``kept``."""
    outputs = [*BASE, "class_distance", "word_distance", "kept"]
    columns = [c for c in docs.columns if c not in outputs]
    refs = references(docs, text, lang) if refs is None else refs
    known = F.aggregate("word_share", F.lit(0.0), lambda a, x: a + x)
    without = F.sqrt(known / 2 + js_term(F.lit(1.0), F.greatest(1 - known, F.lit(0.0))))
    refs = refs.select(F.col("lang").alias("_lang"), "class_share", "top_words", "word_share", known.alias("_known"),
                       F.least(F.lit(WORD_DISTANCE), WITHOUT * without).alias("_limit"))
    rows = base_rules(docs.select(*columns), text).withColumn("_key", F.coalesce(F.col(lang).cast("string"), F.lit("")))
    rows = rows.join(refs.withColumnsRenamed({c: f"_{c}" for c in ("class_share", "top_words", "word_share")}), F.col("_key") == F.col("_lang"), "left")
    rows = rows.withColumns({"_chars": F.octet_length("_text").cast("double"), "_padded": F.concat(F.lit(" "), F.lower(F.array_join("_words", "  ")), F.lit(" "))})
    rows = rows.withColumns({f"_c{i}": F.try_divide(c, F.col("_chars")) for i, c in enumerate(class_counts(F.col("_text"), F.col("word_chars")))})
    shares = [F.get("_class_share", F.lit(i)) for i in range(CELLS)]
    rest = [1 - reduce(Column.__add__, xs) for xs in ([F.col(f"_c{i}") for i in range(CELLS)], shares)]
    terms = [js_term(F.col(f"_c{i}"), s) for i, s in enumerate(shares)] + [js_term(*[F.greatest(r, F.lit(0.0)) for r in rest])]
    # A frequent word is counted by what its removal takes away; words stand between two spaces each.
    size = F.octet_length("_padded")
    hits = F.transform("_top_words", lambda w: F.try_divide(
        (size - F.octet_length(F.replace(F.col("_padded"), F.concat(F.lit(" "), w, F.lit(" ")), F.lit("")))) / (F.octet_length(w) + 2),
        F.col("n_words").cast("double")))
    guarded = F.col("n_words") >= LEAST_WORDS
    rows = rows.withColumns({"_class_js": reduce(Column.__add__, terms), "_hits": F.when(guarded, hits)})
    inside = F.aggregate(F.zip_with("_hits", "_word_share", js_term), F.lit(0.0), lambda a, x: a + x)
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    word_js = inside + js_term(F.greatest(1 - total("_hits"), F.lit(0.0)), F.greatest(1 - total("_word_share"), F.lit(0.0)))
    distance = lambda js: F.sqrt(F.greatest(js, F.lit(0.0)))
    rows = rows.withColumns({"class_distance": F.when(F.col("_chars") >= LEAST_CHARS, distance(F.col("_class_js"))),
                             "word_distance": distance(word_js)})
    limit = F.when(F.col("n_words") * F.col("_known") >= EXPECTED, F.col("_limit")).otherwise(WORD_DISTANCE)
    kept = ~F.col("base_failed") & (F.coalesce("class_distance", F.lit(0.0)) <= CLASS_DISTANCE) & (F.coalesce("word_distance", F.lit(0.0)) <= limit)
    rows = rows.withColumn("kept", kept)
    # A filter on the results must not be worked out anew from the text, so they pass through a generator.
    return (rows.select(*columns, F.explode(F.array(F.struct(*outputs))).alias("_result"))
            .select(*columns, *[F.col("_result")[c].alias(c) for c in outputs]))


@query("op3_divergence_rules")
def op3_divergence_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's rule values and verdict."""
    return judge(documents(spark, folder).select("doc_id", "text", "lang")).drop("text", "lang")
