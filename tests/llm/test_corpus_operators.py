"""De-duplication, similarity, passages, archives and the pipeline against plain versions."""

import base64
import hashlib
import random
import re
import tempfile
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallymint.session import workspace
from tallymint.llm import common, components, passages, quotient, similar, warc


def test_copies(spark, table):
    texts = ["a", "b", "a", "", None, "a ", "b", "x" * 9000, "x" * 9000]
    docs = table(texts).withColumn("kept", F.lit("clash"))
    rows = {r.doc_id: r for r in quotient.exact_copies(docs).collect()}
    for i, t in enumerate(texts):
        group = [k for k, u in enumerate(texts) if (u or "") == (t or "")]
        assert (rows[i].keep_id, rows[i].group_size, rows[i].kept) == (max(group), len(group), i == max(group))
        assert rows[i].text_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    twice = docs.union(docs.where("doc_id = 8")).union(docs.withColumn("doc_id", F.lit(None).cast("long")).where("text = 'b'"))
    left = quotient.drop_copies(twice).collect()
    assert sorted(r.doc_id for r in left) == [2, 4, 5, 6, 8] and left[0].kept == "clash"
    assert quotient.exact_copies(table([])).count() == quotient.drop_copies(table([])).count() == 0


def test_texts_without_copies_do_not_move(spark, table):
    docs = table([f"text {k}" for k in range(40)] + ["copy"] * 3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = quotient.drop_copies(docs)
        plan = left._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(r.doc_id for r in left.collect()) == [*range(40), 42]
    assert any("Join LeftAnti" in line and "rightHint=(strategy=broadcast)" in line for line in plan.splitlines())


def test_postings_without_a_list_do_not_move(spark, table, monkeypatch):
    rng = np.random.default_rng(14)
    texts = [" ".join(random_words(rng, 60)) for _ in range(30)]
    texts += [" ".join(t.split()[:-2] + ["other", "end"]) for t in texts[:10]]
    plain, sizes = sorted(similar.similar(table(texts)).collect()), []
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    filtered = similar.with_partners
    monkeypatch.setattr(similar, "with_partners", lambda postings, *rest: sizes.append((postings.count(), filtered(postings, *rest).count())) or filtered(postings, *rest))
    assert sorted(similar.similar(table(texts)).collect()) == plain
    assert [r.component_id for r in plain[30:]] == [*range(10)] and sizes and all(few < many / 2 for many, few in sizes)


def test_filters_merge_without_loss(spark):
    values = np.random.default_rng(2).integers(-2**63, 2**63, 3000).tolist()
    values += values[:400] + [values[0]] * 5000 + [-1, -1, 0, 0]
    frame = spark.createDataFrame([(v,) for v in values], "fingerprint long").repartition(5)
    for bits in (0, 1, 6):
        found = quotient.repeated_fingerprints(quotient.build_filters(frame, bits), bits).collect()
        assert {r.fingerprint: r.n for r in found} == {v: n for v, n in Counter(values).items() if n > 1}


def plain_components(texts, width, part, whole=100):
    sets = {}
    for i, t in enumerate(texts):
        w = [re.sub("[A-Z]", lambda m: m.group().lower(), x) for x in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
        sets[i] = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} or ({tuple(w)} if w else set())
    label = {i: i for i in sets}
    for _ in sets:
        before = dict(label)
        for a in sets:
            for b in range(a):
                both = len(sets[a] & sets[b])
                if both and whole * both >= part * (len(sets[a]) + len(sets[b]) - both):
                    label[a] = label[b] = min(label[a], label[b])
        if label == before:
            break
    return {i: (len(sets[i]), label[i]) for i in sets}


@pytest.mark.parametrize("width, part", [(1, 80), (4, 85)])
def test_components_of_similar_texts(spark, table, width, part):
    rng = np.random.default_rng(width)
    texts = ["", None, " \n", "A b", "a B", "q"]
    for _ in range(40):
        words = rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(1, 70)).tolist()
        for _ in range(rng.integers(1, 5)):
            texts.append(" ".join(words))
            words[rng.integers(len(words))] = "zz"
    rows = {r.doc_id: (r.n_shingles, r.component_id) for r in similar.similar(table(texts).repartition(3), width, part).collect()}
    assert rows == plain_components(texts, width, part)


def test_similar_edges(spark, table):
    assert similar.similar(table([])).count() == 0
    docs = table(["a b c d e f g"] * 3).withColumn("doc_id", F.when(F.col("doc_id") > 0, F.col("doc_id")))
    rows = similar.similar(docs).collect()
    assert sorted((r.doc_id, r.component_id) for r in rows if r.doc_id) == [(1, 1), (2, 1)] and len(rows) == 3
    assert [r.doc_id for r in similar.drop_similar(table(["a b c d e f g"] * 3)).collect()] == [0]


def test_inner_names_of_similar_texts(spark, table):
    docs = table(["a b c d e f g"] * 3 + [None])
    for name in ("_gone", "gone", "id", "n", "component"):
        docs = docs.withColumn(name, F.lit(name))
    left = similar.drop_similar(docs).orderBy("doc_id").collect()
    assert [r.doc_id for r in left] == [0, 3] and all(r[n] == n for r in left for n in docs.columns[5:])


def test_header_lines_of_other_writers():
    head = b"WARC/1.1\r\nWARC-Type:response\r\nContent-Length:   12 \r\nX-Empty:\r\nWARC-Target-URI: http://a.b/c:d"
    assert warc.headers(head) == {"WARC-Type": "response", "Content-Length": "12", "X-Empty": "", "WARC-Target-URI": "http://a.b/c:d"}


def test_archives_are_read_by_as_many_tasks_as_their_bytes_need(spark, monkeypatch):
    rng = np.random.default_rng(1)
    pages = [(i, f"http://a/{i}", rng.bytes(4000).hex()) for i in range(60)] + [(None, None, "x"), (None, None, None)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    place = workspace(spark, "warc-test")
    index = warc.write(frame, place)
    monkeypatch.setattr(warc, "TASK_BYTES", 40_000)
    records = warc.read(index, place)
    assert records.rdd.getNumPartitions() > 3
    rows = {r.record_id: r.payload_bytes for r in records.collect()}
    assert len(rows) >= 61 and rows["5"] == 8000 and records.count() == 62


def test_connected_components(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(30)] + [(50, 40), (40, 60), (7, 7)], "a long, b long")
    found = {r.node: r.component for r in components.components(links).collect()}
    assert found == {i: 0 for i in range(31)} | {40: 40, 50: 40, 60: 40}


def test_fenwick_chains_and_alignment():
    a, b = [0, 6, 12, 3, 40], [100, 106, 112, 5, 20]
    best = max(passages.chains(a, b), key=len)
    assert [a[i] for i in best] == [0, 6, 12]
    rng = np.random.default_rng(1)
    for _ in range(30):
        x, y = (rng.integers(0, 4, rng.integers(0, 12)).tolist() for _ in range(2))
        table = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i in range(len(x)):
            for j in range(len(y)):
                table[i + 1][j + 1] = table[i][j] + 1 if x[i] == y[j] else max(table[i][j + 1], table[i + 1][j])
        assert passages.common_words(x, y) == table[-1][-1]


def test_chains_after_a_long_passage():
    # 400 words, 100 unlike ones in either text, then 80: the end of the first outranks all that follows.
    places = [*range(0, 395, 4), *range(500, 575, 4)]
    found = sorted((places[c[0]], places[c[-1]]) for c in passages.chains(places, [p + 7 for p in places]))
    assert found == [(0, 392), (500, 572)]


def test_shared_passages(spark, table):
    rng = np.random.default_rng(9)
    word = lambda n: [f"w{v}" for v in rng.integers(0, 10**6, n)]
    shared = word(80)
    edited = shared.copy()
    edited[40] = "changed"
    texts = [" ".join(word(50) + shared + word(30)), " ".join(word(90)), " ".join(edited + word(20)), " ".join(word(10) + shared), "", None, "short text"]
    rows = passages.passages(table(texts)).collect()
    assert {(r.doc_id, r.other_doc_id) for r in rows} == {(2, 0), (3, 0)}
    exact = next(r for r in rows if r.doc_id == 3)
    assert exact.equal_share == 1.0 and exact.start >= 10 and exact.end <= 90 and exact.end - exact.start >= 60
    assert passages.passages(table([])).count() == 0


def random_words(rng, n):
    return [f"w{v}" for v in rng.integers(0, 10**6, n)]


def test_short_passages_are_found_to_their_ends(spark, table):
    rng = np.random.default_rng(11)
    texts, want = [], []
    for n in [49, *range(50, 64)] * 4:
        shared, (i, j, k, m) = random_words(rng, n), rng.integers(0, 90, 4).tolist()
        want += [(len(texts) + 1, j, j + n, len(texts), i, i + n, 1.0)] if n >= 50 else []
        texts += [" ".join(random_words(rng, i) + shared + random_words(rng, k)), " ".join(random_words(rng, j) + shared + random_words(rng, m))]
    # 2,000 equal words of which a smaller id holds all but 60 in the middle, so that they are extended far.
    shared = random_words(rng, 2000)
    texts += [" ".join(shared[:970] + random_words(rng, 30)), " ".join(random_words(rng, 30) + shared[1030:]), " ".join(shared), " ".join(shared)]
    rows = {tuple(r) for r in passages.passages(table(texts)).collect()}
    assert set(want) == {r for r in rows if r[0] < len(texts) - 4}
    assert (len(texts) - 1, 0, 2000, len(texts) - 2, 0, 2000, 1.0) in rows


def test_passages_joined_over_unlike_words_are_split(spark, table):
    rng = np.random.default_rng(12)
    p, q = random_words(rng, 50), random_words(rng, 50)
    texts = [" ".join(p + random_words(rng, 40) + q), " ".join(p + random_words(rng, 40) + q)]
    rows = {tuple(r) for r in passages.passages(table(texts)).collect()}
    assert rows == {(1, 0, 50, 0, 0, 50, 1.0), (1, 90, 140, 0, 90, 140, 1.0)}


def test_partial_copies_hide_no_passage(spark, table):
    rng = np.random.default_rng(13)
    three, four, many = (random_words(rng, n) for n in (90, 90, 60))
    parts = [three[:45], three, three, four[:45], four[45:], four, four, *[many[k:k + 40] for k in range(0, 21, 2)], many, many]
    rows = {tuple(r) for r in passages.passages(table([" ".join(random_words(rng, 20) + w + random_words(rng, 20)) for w in parts])).collect()}
    assert rows == {(i, 20, 20 + n, i - 1, 20, 20 + n, 1.0) for i, n in ((2, 90), (6, 90), (19, 60))}


def edited_words(rng, words, edits):
    words = words.copy()
    for at in rng.choice(np.arange(8, len(words) - 8), edits, replace=False).tolist():
        words[at] = f"edit{rng.integers(0, 10**9)}"
    return words


def test_partial_copies_hide_no_passage_with_edits(spark, table):
    # The seeds of two texts have several smaller ids, each with a part of the passage only.
    rng = np.random.default_rng(15)
    parts, want = [], set()
    for n, cuts in ((90, 2), (96, 3), (75, 2)) * 4:
        words = random_words(rng, n)
        size = n // cuts
        parts += [words[k * size:(k + 1) * size] for k in range(cuts)]
        parts += [edited_words(rng, words, 3), edited_words(rng, words, 3)]
        want.add((len(parts) - 1, len(parts) - 2))
    rows = passages.passages(table([" ".join(random_words(rng, 20) + w + random_words(rng, 20)) for w in parts])).collect()
    assert len(want & {(r.doc_id, r.other_doc_id) for r in rows}) >= 0.9 * len(want)


def test_edits_near_the_ends_cut_no_passage(spark, table):
    # Of 60 words 52 are equal, but two that differ stand between each end and the seeds of the middle.
    rng, texts = np.random.default_rng(16), []
    for _ in range(5):
        words = random_words(rng, 60)
        for places in ((6, 50, 53, 30), (3, 9, 53, 56)):
            copy = words.copy()
            for at in places:
                copy[at] = f"edit{rng.integers(0, 10**9)}"
            texts.append(" ".join(random_words(rng, 20) + copy + random_words(rng, 20)))
        texts += [" ".join(random_words(rng, 20) + words[:49] + random_words(rng, 20))]  # one word too few
    rows = [r for r in passages.passages(table(texts)).collect()]
    assert {(r.doc_id, r.other_doc_id) for r in rows if r.doc_id % 3 == 1} == {(3 * k + 1, 3 * k) for k in range(5)}
    assert all(r.end - r.start >= 50 and r.equal_share >= 0.8 for r in rows)


def test_few_spans_do_not_move_texts(spark, table, monkeypatch):
    rng, plans = np.random.default_rng(11), []
    shared = random_words(rng, 80)
    texts = [" ".join(random_words(rng, 30) + shared + random_words(rng, 30)) for _ in range(4)]
    settled = passages.settled
    monkeypatch.setattr(passages, "settled", lambda pairs, least: plans.append(pairs._jdf.queryExecution().optimizedPlan().toString()) or settled(pairs, least))
    assert {(r.doc_id, r.end - r.start) for r in passages.passages(table(texts)).collect()} == {(k, 80) for k in range(1, 4)}
    # Spans are broadcast to the texts, whatever the planner's own limit; both sides of a chain are cut by one scan.
    assert plans and all("rightHint=(strategy=broadcast)" in p and p.count("MapInArrow") == 1 for p in plans)


def test_chains_seen_without_a_search_equal_those_found():
    rng, seen = random.Random(12), 0
    for _ in range(400):
        at = np.cumsum([rng.choice([1, 3, 5, 6, 9, 20, 40, 70]) for _ in range(rng.randrange(2, 8))])
        other = at + 5 + (np.array([rng.choice([0, 0, 0, 1]) for _ in at]) if rng.random() < 0.3 else 0)
        whole = passages.unbroken(np.tile(at, 2), np.tile(other, 2), np.array([0, len(at)]))
        assert whole[0] == whole[1]
        if whole[0]:
            seen += 1
            assert [*map(list, passages.chains(at.tolist(), other.tolist()))] == [[*range(len(at))]]
    assert seen > 50


def test_long_extensions_equal_a_walk_word_by_word():
    rng = random.Random(13)
    for _ in range(300):
        x, y = (np.array([rng.randrange(3) if rng.random() < 0.1 else 7 for _ in range(rng.randrange(200))], np.uint64) for _ in "xy")
        best = score = at = 0
        fell = False
        for k, (p, q) in enumerate(zip(x, y), 1):
            score += 1 if p == q else -passages.DIFFERS
            if score > best:
                best, at = score, k
            elif score < best - passages.DROP:
                fell = True
                break
        assert passages.extension(x, y, False, False) == at
        assert passages.extension(x, y, True, True) == (at if fell else None)
        assert passages.equal_words(x, y) == passages.common_words(x.tolist(), y.tolist())


def test_seeds_and_windows_of_many_texts_equal_those_of_one():
    rng = np.random.default_rng(16)
    codes = [rng.integers(0, words, n).astype(np.uint64) for words in (2, 5, 10**6) for n in (0, 3, 5, 6, 9, 13, 14, 60)]
    text, at, found = passages.all_seeds(codes)
    for k, one in enumerate(codes):
        places, hashes = passages.seeds(one)
        assert at[text == k].tolist() == places.tolist() and found[text == k].tolist() == hashes.tolist()
        windows = [tuple(one[i:i + 5].tolist()) for i in range(max(0, len(one) - 4))]
        keys = passages.window_hashes(one, 5).tolist()
        assert len(keys) == len(windows) and len(set(zip(keys, windows))) == len(set(keys)) == len(set(windows))


def test_exact_passages_equal_a_plain_version(spark, table):
    rng = np.random.default_rng(14)
    pool = random_words(rng, 300) + ["again"] * 70 + random_words(rng, 100)
    texts = []
    for _ in range(60):
        cuts = [(s, s + n) for s, n in zip(rng.integers(0, 440, 3).tolist(), rng.integers(20, 75, 3).tolist())]
        texts.append(" ".join(w for s, e in cuts for w in pool[s:e] + random_words(rng, 3)))
    first, missing = {}, []
    found = defaultdict(list)
    for r in passages.passages(table(texts)).collect():
        found[r.doc_id].append((r.start, r.end))
    for i, t in enumerate(texts):
        words = t.split()
        own = [tuple(words[s:s + 50]) for s in range(len(words) - 49)]
        missing += [(i, s) for s, w in enumerate(own) if w in first and len(set(w)) > 1 and not any(a <= s and s + 50 <= b for a, b in found[i])]
        for w in own:
            first.setdefault(w, i)
    assert first and not missing


def test_archives(spark):
    html = ["<p>a</p>", "", None, "<p>a</p>", "é" * 4000, "<p>a</p>", "x"]
    pages = spark.createDataFrame([(i, None if i == 6 else f"http://x/{i} y", h, 1) for i, h in enumerate(html)], "page_id long, url string, html string, offset int")
    place = tempfile.mkdtemp(prefix="warc-")
    index = warc.write(pages, place)
    rows = {int(r.record_id): r for r in warc.read(index, place).collect()}
    for i, h in enumerate(html):
        body = (h or "").encode()
        last = max(k for k, u in enumerate(html) if (u or "") == (h or ""))
        assert (rows[i].payload_bytes, rows[i].payload_digest) == (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode())
        assert (rows[i].record_type, rows[i].refers_to) == (("response", None) if i == last else ("revisit", str(last)))
        assert i != last or bytes(rows[i].payload) == body
    some = warc.read(index.where("page_id IN ('1', '4')"), place).collect()
    assert sorted(r.record_id for r in some) == ["1", "4"]
    large = warc.write(pages, tempfile.mkdtemp(prefix="warc-"), least=5)
    assert large.where("record_type = 'revisit'").count() == 2
    assert warc.write(pages.where("false"), tempfile.mkdtemp(prefix="warc-")).count() == 0


def test_pipeline_stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = corpus_pipeline.exact_stage(spark, docs, folder)
    groups = defaultdict(list)
    for i, t in texts.items():
        groups[t].append(i)
    ids = {r.doc_id for r in kept.collect()}
    assert ids == {max(g) for g in groups.values()} and kept.columns == docs.columns
    near = corpus_pipeline.similar_stage(spark, docs, folder)
    names = sorted(texts)
    want = plain_components([texts[i] for i in names], 5, 80)
    assert {r.doc_id for r in near.collect()} == {names[k] for k in {c for _, c in want.values()}}
    clean = corpus_pipeline.personal_stage(spark, docs, folder)
    assert clean.count() == docs.count() and clean.dtypes == docs.dtypes
    assert clean.where("text LIKE '%@mail%.example.com%'").isEmpty()
    assert corpus_pipeline.quality_stage(spark, docs, folder).columns == docs.columns
    packed = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "ids", "sequence_id", "offset"} <= set(packed.columns) and not packed.isEmpty()


def test_empty_pipeline(spark, table):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, table([]), "/root/testdata/sf0.001").count() == 0, name
