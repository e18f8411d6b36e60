"""Encoding, id files, packing, quality, rules and personal data against plain versions."""

import hashlib
import re
import tempfile
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallymint.llm import divergence, idfiles, packing, personal, pieces, quality, tokens
from tallymint.llm.tokens import TextEncoder

TEXTS = [
    "", None, " ", "  a", "a  b\n\nc ", "The cat sat.   On, the mat!", "naïve café 中文 😀 ​", "▁ x ▁▁", "aaaaaaaaaaaaaaa",
    "\x00 tab\there\r\n", " " * 40, "=" * 70 + "--__--", "é ́ İ.", "the the the the the the the", "word, " * 3000,
    "the cat sat on the mat and the dog sat on the log. " * 40, "x" * 5000,
]


def test_pieces_equal_the_library(spark, table):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    docs = table(TEXTS).withColumn("ids", F.lit("clash"))
    rows = {r.doc_id: r for r in pieces.decode(pieces.encode(docs, path), path).collect()}
    for i, t in enumerate(TEXTS):
        assert rows[i].ids == model.encode(t or "", add_eos=True)
        assert rows[i].decoded == model.decode(rows[i].ids) == (t or "").replace("▁", " ")
    assert pieces.encode(table([]), path).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_token_cache_equals_the_library(name):
    path = public_tokenizers.path(name)
    encoder, plain = TextEncoder(path, limit=5), Tokenizer.from_file(path)
    for _ in range(2):  # the second time through the cache
        flat, bounds = encoder.encode([t or "" for t in TEXTS])
        for i, t in enumerate(TEXTS):
            assert flat[bounds[i]:bounds[i + 1]].tolist() == plain.encode(t or "", add_special_tokens=False).ids


def test_id_files_round_trip(spark, table):
    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    docs = table(TEXTS).union(table(["again"], start=3)).repartition(3)
    store = idfiles.write(docs, path, 2, tempfile.mkdtemp(prefix="ids-"), id_bytes=2)
    back = idfiles.read(idfiles.lookup(idfiles.keys_of(docs), store), store).collect()
    assert len(back) == len(TEXTS) + 1
    start = 0
    for r in sorted(back, key=lambda r: r.start):
        assert r.start == start
        start += r.n_tokens
        if r.doc_id != 3:
            assert np.frombuffer(r.ids, "<u4").tolist() == plain.encode(TEXTS[r.doc_id] or "", add_special_tokens=False).ids + [2]
    assert sorted(r.nth for r in back if r.doc_id == 3) == [0, 1]
    assert idfiles.lookup(spark.createDataFrame([(10**9, 0)], "doc_id long, nth long"), store).count() == 0
    empty = idfiles.write(table([]), path, 2, tempfile.mkdtemp(prefix="ids-"))
    assert idfiles.read(idfiles.lookup(idfiles.keys_of(docs), empty), empty).count() == 0


def test_perfect_hash_is_minimal_and_perfect():
    keys = np.random.default_rng(1).integers(0, 2**63, (2, 5000)).astype(np.uint64)
    function = idfiles.PerfectHash.build(*keys)
    assert sorted(function.slots(*keys).tolist()) == list(range(5000))


def test_id_files_with_several_parts_and_tasks(spark, monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = spark.range(400).select((F.col("id") * 7).alias("doc_id"), F.concat(F.lit("some words "), F.col("id").cast("string")).alias("text"))
    monkeypatch.setattr(idfiles, "PART_KEYS", 60)
    monkeypatch.setattr(idfiles, "TASK_IDS", 300)
    store = idfiles.write(docs.repartition(3), path, 2, tempfile.mkdtemp(prefix="ids-"))
    assert store.n_parts > 3
    back = idfiles.read(idfiles.lookup(idfiles.keys_of(docs), store), store)
    assert back.rdd.getNumPartitions() > 3
    rows = sorted((r.doc_id, r.start, r.n_tokens, r.ids) for r in back.collect())
    plain = Tokenizer.from_file(path)
    at = 0
    for (key, start, n, ids), i in zip(rows, range(400)):
        expected = plain.encode(f"some words {i}", add_special_tokens=False).ids + [2]
        assert (key, start, n, list(np.frombuffer(ids, "<u4"))) == (7 * i, at, len(expected), expected)
        at += n
    assert len(rows) == 400


def test_ids_that_do_not_fit_are_refused(spark, table):
    path = public_tokenizers.path("word_bpe_49k.json")
    with pytest.raises(Exception, match="doesn't fit 1 bytes"):
        idfiles.write(table(["unusual words"]), path, 2, tempfile.mkdtemp(prefix="ids-"), id_bytes=1)
    with pytest.raises(ValueError, match="no shard of ids"):
        idfiles.id_type(b"x" * 16, "file")


def test_packing_covers_each_id_once(spark, table):
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    rows = packing.pack(table(TEXTS + ["a b c " * 2000]).repartition(2), path, end=1).collect()
    texts = TEXTS + ["a b c " * 2000]
    for i, t in enumerate(texts):
        ids = plain.encode(t or "", add_special_tokens=False).ids + [1]
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        assert [x for r in own for x in np.frombuffer(r.ids, "<u4").tolist()] == ids
        assert {r.doc_tokens for r in own} == {len(ids)} and sum(r.length for r in own) == len(ids)
    for s in {r.sequence_id for r in rows}:
        own = sorted((r for r in rows if r.sequence_id == s), key=lambda r: r.offset)
        assert [r.offset for r in own] == [0, *np.cumsum([r.length for r in own])[:-1].tolist()]
        total = sum(r.length for r in own)
        assert total <= 2048 and total & (total - 1) == 0  # nothing is padded
    assert packing.pack(table([]), path, end=1).count() == 0


def test_quality_learns_and_defines_odd_labels(spark, table):
    rng = np.random.default_rng(3)
    good = [" ".join(rng.choice(["the", "river", "runs", "over", "old", "stones", "and", "sand"], 60)) + "." for _ in range(120)]
    bad = [" ".join(f"{w}###" for w in rng.choice(["buy", "now", "win"], 60)) for _ in range(120)]
    docs = table(good + bad + ["", None])
    labels = spark.createDataFrame([(i, int(i < 120), 0) for i in range(240)] + [(0, None, 0), (None, 1, 0), (5, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    rows = {r.doc_id: r for r in quality.score(docs, model).collect()}
    unseen = [i for i in range(240) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all((rows[i].predicted == 1) == (i < 120) for i in unseen)
    assert 0 <= rows[240].score == rows[241].score <= 1
    assert quality.train(docs, labels.where("false")).scores(np.zeros((1, 23)))[0] == 0.5
    assert quality.train(table([]), labels).feature.shape[0] == 0
    assert quality.score(table([]), model).count() == 0


def test_quality_takes_one_row_of_an_id(spark, table, monkeypatch):
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 != 2]
    docs = table([f"text number {i} has some words" for i in range(40)])
    more = spark.createDataFrame([(ids[0], f"another text {i} with this id") for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    sizes, fit = [], quality.fit
    monkeypatch.setattr(quality, "fit", lambda values, target: sizes.append(len(values)) or fit(values, target))
    quality.train(docs.select("doc_id", "text").union(more), labels)
    quality.train(docs.select("doc_id", "text").union(more).repartition(7), labels, sample_rows=5)
    assert sizes == [len(ids), 5]


def test_rules_equal_a_plain_version(spark, table):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    texts = TEXTS + ["a b c d e f\na b c d e f\n \na b c d e x", "#$ %% | <>", "a a a a a a b b b b b"]
    rows = {r.doc_id: r for r in divergence.judge(table(texts)).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        words = word.findall(t or "")
        grams = [tuple(words[k:k + 5]) for k in range(len(words) - 4)]
        seen = Counter(grams)
        covered = {k + j for k, g in enumerate(grams) if seen[g] > 1 for j in range(5)}
        lines = [x for x in (t or "").split("\n") if word.search(x)]
        want = (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered))
        assert (rows[i].n_words, rows[i].word_chars, rows[i].n_symbols, rows[i].n_dup_lines, rows[i].n_repeat_words) == want
        assert rows[i].base_failed == (len(words) < 10 or 100 * len(covered) > 20 * len(words))
        assert not (rows[i].kept and rows[i].base_failed)
    assert divergence.judge(table([])).count() == 0


def test_divergence_rejects_what_differs(spark, table):
    rng = np.random.default_rng(5)
    prose = [" ".join(rng.choice(["the", "of", "and", "river", "stone", "to", "winter", "light"], 120)) for _ in range(60)]
    noise = " ".join(f"{w}%%%" for w in rng.choice(["Xq", "ZZ9", "KL0"], 120))
    rows = {r.doc_id: r.kept for r in divergence.judge(table(prose + [noise]).withColumn("lang", F.lit("en")))
            .select("doc_id", "kept", "base_failed").collect()}
    assert sum(rows[i] for i in range(60)) >= 55 and not rows[60]


def test_divergence_rejects_texts_without_the_common_words(spark, table):
    rng = np.random.default_rng(6)
    tail = lambda letters: ["".join(rng.choice(list(letters), rng.integers(4, 10))) for _ in range(4000)]
    short = {"en": ["the", "of", "and", "to", "a", "in", "is", "that", "it", "for", "was", "on", "with", "as", "be", "by", "are", "this", "at", "from"],
             "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "sich", "mit", "des", "auf", "für", "ist", "im", "nicht", "dem", "ein", "eine", "als"]}
    long_, share = {"en": tail("etaoinshrdlucm"), "de": tail("enisratdhulcgm")}, 1 / np.arange(2, 22)

    def prose(lang, n):
        common = rng.choice(short[lang], n, p=share / share.sum())
        return " ".join(np.where(rng.random(n) < 0.23, common, rng.choice(long_[lang], n)))

    texts = [(prose(lang, int(n)), lang) for lang in short for n in rng.integers(60, 400, 150)]
    texts += [(" ".join(rng.choice(long_["en"], 120)), "en") for _ in range(3)] + [(prose("de", 150), "en") for _ in range(3)]
    rows = divergence.judge(spark.createDataFrame([(i, *t) for i, t in enumerate(texts)], "doc_id long, text string, lang string")).collect()
    kept = {r.doc_id: r.kept for r in rows}
    assert not any(r.base_failed or r.class_distance > divergence.CLASS_DISTANCE for r in rows)
    assert sum(kept[i] for i in range(300)) >= 297 and not any(kept[i] for i in range(300, 306))
    # Where frequent words are rare, a text without them says nothing.
    rare = [(i, " ".join(rng.choice(long_["en"], 80)), "en") for i in range(40)]
    assert all(r.kept for r in divergence.judge(spark.createDataFrame(rare, "doc_id long, text string, lang string")).select("kept").collect())


def plain_spans(t):
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    found += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m.group() if c.isdigit()][::-1]
        if 16 <= len(d) <= 19 and sum(x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for k, x in enumerate(d)) % 10 == 0:
            found.append(("card", *m.span()))
    found += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= sum(c.isdigit() for c in m.group()) <= 15]
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def test_base_spans_equal_a_plain_version(spark, table):
    rng = np.random.default_rng(7)
    texts = ["".join(rng.choice(list(chars), rng.integers(0, 60))) for chars in ("a.@b-_%+c1 é😀\n", "0123456789 -.+()", "ab1.@-_%") for _ in range(60)]
    texts += ["x@y.com_z@w.org", "a..b@c.d..e", "4111 1111 1111 1111", "4111-1111-1111-1111 4111--1111", "999.1.1.1 1.2.3.4.5.6.7.8", "+1 (555) 010-9999", None, ""]
    texts += ["1 " * 20000, "a" * 50000 + "@", "4" * 40000, "a@b" + ".c" * 9000]
    rows = table(texts).select("doc_id", personal.listed(personal.base_spans(F.coalesce("text", F.lit("")))).alias("s")).collect()
    assert all(r.s == plain_spans(texts[r.doc_id] or "") for r in rows)


def test_terms_beside_a_value_are_found_and_masked(spark, table):
    secret = [f"{w} zebulon wrote from z@home.org about {v} things" for w, v in zip(["monday", "tuesday", "friday", "sunday"], ["many", "some", "nine", "four"])]
    other = [f"people wrote about things number {i} and went home" for i in range(60)]
    docs = table(secret + other)
    rows = {r.doc_id: r for r in personal.find(docs).collect()}
    marked = [secret[0][s.start:s.end] for s in rows[0].term_spans]
    assert "zebulon" in marked and "things" not in marked and not rows[10].term_spans
    clean = {r.doc_id: r.text for r in personal.sanitise(docs).collect()}
    assert "zebulon" not in clean[0] and "[EMAIL]" in clean[0] and "z@home.org" not in clean[0] and clean[10] == secret[0][:0] + other[6]
    # Copies of one document prove nothing, and texts without values stay as they are, null too.
    same = personal.sanitise(table([secret[0]] * 6 + [None, ""])).orderBy("doc_id").collect()
    assert "zebulon" in same[0].text and same[6].text is None and same[7].text == ""
    assert personal.find(table([])).count() == 0


def test_ordinary_words_are_left_alone(spark, table):
    """One document that names a value often, near copies and a value with many documents prove nothing of their words."""
    rng = np.random.default_rng(9)
    vocabulary = [f"word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(2000)]
    text = lambda n: " ".join(rng.choice(vocabulary, n))
    often = "write to a@b.org or call a@b.org and ask a@b.org about the velvet curtains"
    base = text(60).split()
    near = [" ".join(base[:k] + ["changed"] + base[k + 1:]) + " rareword c@d.org" for k in range(6)]
    hot = [f"{text(40)} help@site.org" for _ in range(120)]
    plain = [f"{text(30)} velvet curtains" for _ in range(4)] + [text(50) for _ in range(160)]
    planted = [f"{text(25)} marigold fetherstone {text(10)} e@f.org" for _ in range(5)] + [f"{text(20)} fetherstone {text(9)}"]
    docs = table([often, *near, *hot, *plain, *planted])
    found = {(t, s) for r in personal.find(docs).collect() for s in r.term_spans for t in [r.text[s.start:s.end]]}
    assert {t for t, _ in found} == {"marigold", "fetherstone"}
    clean = [r.text for r in personal.sanitise(docs.where("doc_id < 7")).orderBy("doc_id").collect()]
    assert "velvet curtains" in clean[0] and all("rareword" in c for c in clean[1:])


def test_shares_equal_a_plain_version(spark, table):
    rng = np.random.default_rng(4)
    names = ["ana@x.org", "bob@x.org", "cyn@x.org"]
    words = [f"term{chr(97 + i)}{chr(97 + i)}" for i in range(18)]
    texts = [" ".join(rng.choice(words[k * 4:k * 4 + 9], 7)) + f" filler{'abcdefgh'[i % 8]} {names[k]}" for i, k in enumerate(rng.integers(0, 3, 40))]
    texts += [" ".join(rng.choice(words, 2)) for _ in range(400)]
    docs = table(texts)
    near = personal.protected(docs, "doc_id", "text")
    got = {(r.entity, r.term): r.share for r in personal.disclosures(docs, near, "text").collect()}
    sets = [set(re.findall(r"[^\W\d_]{4,}", re.sub(r"\S+@\S+", "\n", t))) for t in texts]
    like = lambda a, b: len(a & b) >= 0.8 * len(a | b)
    held = {n: [i for i, t in enumerate(texts) if n in t] for n in names}
    tried = sum(len(set().union(*(sets[i] for i in rows))) for rows in held.values())
    for (entity, term), share in got.items():
        rows = [i for i in held[entity.split(":", 1)[1]] if term in sets[i]]
        all_rows = [i for i, s in enumerate(sets) if term in s]
        entity_rows = held[entity.split(":", 1)[1]]
        unlike = []
        for i in rows:
            unlike += [i] if not any(like(sets[i], sets[k]) for k in unlike) else []
        information = np.log2(len(texts) / len(entity_rows))
        plain = np.log2(len(texts) * len(rows) / (len(all_rows) * len(entity_rows))) / information
        assert 3 <= len(unlike) and 2 * len(rows) >= len(all_rows) and 0.6 <= share <= plain
        assert abs(share - plain * len(rows) / (len(rows) + 1)) < 1e-9 or len(unlike) < len(rows)
        assert information * len(unlike) >= np.log2(tried / 0.01) - 2 * len(rows)
    assert got


def test_inner_names_of_personal_data(spark, table):
    docs = table(["mail a@b.org now", None, ""])
    for name in ("_text", "_spans", "_doc", "_key", "_hash", "_wanted", "_apart", "base_spans", "term_spans", "key", "doc", "class", "d", "s"):
        docs = docs.withColumn(name, F.lit(name))
    rows = personal.sanitise(docs).orderBy("doc_id").collect()
    assert rows[0].text == "mail [EMAIL] now" and all(r[n] == n for r in rows for n in docs.columns[5:])
    found = personal.find(docs).orderBy("doc_id").first()
    assert found["_text"] == "_text" and found["_doc"] == "_doc" and found.base_spans[0].start == 5


def test_terms_are_masked_wherever_they_stand(spark, table):
    fill = "people went home and wrote about other things " * 5
    secret = [f"{w} zebulon wrote from z@home.org about {v} things {fill} Zebulon {fill} quillfeather" for w, v in zip(["monday", "tuesday", "friday", "sunday"], ["many", "some", "nine", "four"])]
    other = [f"people wrote from home about other things, number {i}, and went" for i in range(60)] + ["news of zebulon: zebulonia"]
    docs = table(secret + other)
    rows = {r.doc_id: r for r in personal.find(docs).collect()}
    # The second mention and a term over 200 characters away, and a document without the value.
    assert [secret[0][s.start:s.end] for s in rows[0].term_spans] == ["zebulon", "Zebulon", "quillfeather"]
    assert [other[60][s.start:s.end] for s in rows[64].term_spans] == ["zebulon"] and not rows[63].term_spans
    clean = {r.doc_id: r.text for r in personal.sanitise(docs).collect()}
    assert "zebulon" not in clean[0].lower() and "zebulon:" not in clean[64] and "zebulonia" in clean[64]


def test_digest_columns(spark, tmp_path, table):
    table(TEXTS).write.parquet(str(tmp_path / "documents.parquet"))
    row = next(r for r in pieces.op1_sentencepiece(spark, str(tmp_path)).collect() if r.doc_id == 0)
    assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == (1, hashlib.sha256(b"2").hexdigest(), hashlib.sha256(b"").hexdigest())


def test_chunks_of_many_texts_equal_the_pattern(monkeypatch):
    monkeypatch.setattr(tokens, "PASS_CHARS", 20)
    rng = np.random.default_rng(17)
    letters = [*" \t\n\x1c\x85  　​abcé漢😀\x00"]
    texts = ["".join(rng.choice(letters, n)) for n in (0, 1, 1, 2, 3, 40, 0, 200, 5)] + ["", "a " * 10, " a" * 10]
    chunks, which, size = tokens.split(texts)
    assert len(set(chunks)) == len(chunks)
    assert [chunks[i] for i in which.tolist()] == [c for t in texts for c in tokens.CHUNK.findall(t)]
    assert size.tolist() == [len(tokens.CHUNK.findall(t)) for t in texts]
