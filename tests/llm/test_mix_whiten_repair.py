"""Mixing, whitening and conversation repair against plain versions."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymint.llm import mixing, repair, whitening

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- repair of conversations -------------------------------------------------------------------

def cheapest(rows, most=2):
    """All edits of a short conversation tried out: (cost, audit, repaired rows) of the best."""
    choices = []
    for role, text, fault in rows:
        options = [(2, "D", None)]
        if fault not in ("blank", "duplicate"):
            more = 5 * (fault == "truncated")
            options += [(more, "K", (role, text)), (1 + more, "R", ("user", text)), (1 + more, "R", ("assistant", text))]
        choices.append(options)
    inserts = [x for k in range(most + 1) for x in itertools.product(("user", "assistant"), repeat=k)]
    best = None
    for between in itertools.product(inserts, repeat=len(rows) + 1):
        for chosen in itertools.product(*choices):
            cost = sum(c[0] for c in chosen) + 5 * sum(map(len, between))
            if best and cost > best[0]:
                continue
            out, audit = [], ""
            for i in range(len(rows) + 1):
                out += [(role, "") for role in between[i]]
                audit += "I" * len(between[i])
                if i < len(rows):
                    audit += chosen[i][1]
                    out += [chosen[i][2]] if chosen[i][2] else []
            initials = [role[:1] for role, _ in out]
            legal = "" not in initials and re.fullmatch("(s?(ua)+)?", "".join(initials))
            if legal and (best is None or (cost, audit) < best[:2]):
                best = cost, audit, out
    return best


def test_lightest_derivation_is_the_cheapest_repair():
    rng = random.Random(3)
    for _ in range(120):
        rows = [(rng.choice(["user", "assistant", "system", "tool", ""]), f"t{i}",
                 rng.choice([None, None, None, "blank", "duplicate", "truncated"])) for i in range(rng.randint(0, 3))]
        expected = cheapest(rows)
        for segment in (1, 2, 100):
            by_digest, by_lines = (repair.Conversation(left(), segment) for left in (repair.Digest, repair.Lines))
            for row in rows:
                by_digest.add(None, *row)
                by_lines.add(None, *row)
            goal, lines = by_digest.finish(), by_lines.finish()
            assert (goal.cost, by_digest.audit(goal)) == (lines.cost, by_lines.audit(lines)) == expected[:2]
            assert [r[:2] for node in lines.left.chain() for r in node.rows] == expected[2]
            assert goal.left.sha.hexdigest() == hashlib.sha256("\n".join(f"{r}:{t}" for r, t in expected[2]).encode()).hexdigest()


def test_segments_do_not_change_a_long_repair():
    rng = random.Random(4)
    for roles in (["user", "assistant", "system"], ["user"]):
        rows = [(rng.choice(roles), f"t{i}", rng.choice([None] * 6 + ["blank", "duplicate", "truncated"])) for i in range(150)]
        found = set()
        for segment in (1, 7, 40, 1000):
            it = repair.Conversation(repair.Digest(), segment)
            for row in rows:
                it.add(None, *row)
            goal = it.finish()
            found.add((goal.cost, it.audit(goal), goal.left.sha.hexdigest()))
        assert len(found) == 1


def plain_report(rows):
    """Faults by hand and the cheapest repair of rows (turn, role, text) in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        core = text.rstrip(" \t\n\v\f\r")
        faults.append("blank" if not core else "duplicate" if (role, text) in seen
                      else "truncated" if core[-1] not in ".!?" else None)
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, out = cheapest([(r, t, f) for (_, r, t), f in zip(rows, faults)], most=1)
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    count = Counter(faults)
    return gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, digest


def damaged(rows):
    """The damage by hand: rows after it for each conversation, in order."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        names = [" " if x is None else str(x) for x in (conv, turn)]
        role, text = (" " if x is None else x for x in (role, text))
        harm = zlib.crc32(":".join(names).encode()) % 20
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        role = "user" if harm == 4 else role
        out[conv] += [(turn, role, text)] * (0 if harm == 0 else 2 if harm == 3 else 1)
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, v in out.items()}


def test_report_of_damaged_conversations(spark):
    rng = random.Random(5)
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(rng.randint(1, 3)):
            rows.append((conv, rng.choice([turn, turn, turn, None, turn * 3]),
                         rng.choice(["user", "assistant", "assistant", "system", "tool", None, ""]),
                         rng.choice([f"Words {turn}.", "Words!", "no end", " \n", "", None, "x? \t", "é中"])))
    rows += [(7, 50, "user", "Same."), (7, 50, "user", "Same."), (8, 50, "user", "cut"), (8, 50, "user", "cut")]
    # A row that is dropped alone, so that its conversation has none left.
    lost = next(c for c in range(1000, 9000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((lost, 0, "user", "Gone."))
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    table = table.withColumn("fault", F.lit("clash")).withColumn("conversation", F.lit(1)).withColumn("present", F.lit(False))
    got = {r[0]: tuple(r)[1:] for r in repair.report(repair.damaged(table), present=F.col("present")).collect()}
    expected = {c: plain_report(v) for c, v in damaged(rows).items()}
    assert got == expected
    assert got[lost] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    lines = defaultdict(list)
    for r in repair.repair(repair.damaged(table), present=F.col("present"), segment=2).orderBy("conv_id", "place").collect():
        assert r.place == len(lines[r.conv_id])
        lines[r.conv_id].append(f"{r.role}:{r.text}")
    for conv, values in expected.items():
        assert hashlib.sha256("\n".join(lines[conv]).encode()).hexdigest() == values[-1]


def test_repair_edges(spark):
    schema = "conv_id string, turn long, role string, text string"
    assert repair.report(spark.createDataFrame([], schema)).count() == repair.repair(spark.createDataFrame([], schema)).count() == 0
    far = 2**63 - 1
    rows = [("a", -far - 1, "user", "x" * 3_000_000 + "."), ("a", far, "assistant", "y" * 2_000_000 + "!")]
    row = repair.report(spark.createDataFrame(rows, schema)).first()
    assert (row.conv_id, row.gaps, row.audit, row.cost) == ("a", far, "KK", 0)


# --- whitening ---------------------------------------------------------------------------------

@pytest.mark.parametrize("n", [1, 2, 3, 7, 40])
@pytest.mark.parametrize("kind", ["plain", "steep", "half", "equal", "one", "none", "pairs"])
def test_spectral_parts_against_a_plain_solver(n, kind):
    x = np.random.default_rng(n).standard_normal((3 * n + 4, n))
    x = {"plain": x, "steep": x * np.logspace(0, -7, n), "half": np.where(np.arange(n) < (n + 1) // 2, x, 0),
         "equal": np.vstack([np.eye(n), -np.eye(n)]), "one": x[:, :1] + np.zeros(n), "none": x * 0,
         "pairs": np.vstack([np.eye(n), -np.eye(n)]) * np.sqrt(np.arange(n) // 2 + 1)}[kind]
    a = x.T @ x / len(x)
    values, vectors = whitening.leading(a, 4)
    size = max(np.linalg.norm(a), 1e-300)
    assert np.allclose(values / size, np.linalg.eigvalsh(a)[::-1][:4] / size, atol=1e-13)
    assert np.abs(a @ vectors - vectors * values).max() / size < 1e-13
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13


def vectors_table(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, vector string, code int")


def test_whitening(spark):
    rng = np.random.default_rng(1)
    sound = (rng.standard_normal((200, 9)) * np.linspace(1, 3, 9)).astype(np.float32).astype(float)
    sound[50:120] = sound[50]  # a third of all rows are one vector
    sound[3, 0] = -0.0
    rows = [(i, v.tolist(), "x", 1) for i, v in enumerate(sound)]
    bad = [(900, None), (901, [None] + [1.0] * 8), (902, [float("nan")] * 9), (903, [float("inf")] + [0.0] * 8),
           (904, [1.0] * 8), (905, []), (906, [-float("inf")] * 9)]
    table = vectors_table(spark, rows + [(i, v, None, None) for i, v in bad] + [(None, sound[0].tolist(), "x", 1)]).repartition(3)
    x = np.floor(256 * np.vstack([sound, sound[:1]])).astype(np.int64)
    fitted = np.unique(x, axis=0)
    n, sums = len(fitted), fitted.sum(axis=0)
    centred = fitted - sums / n
    covariance = centred.T @ centred / n
    values, basis = np.linalg.eigh(covariance)
    values, basis = values[::-1], basis[:, ::-1]
    found = defaultdict(dict)
    for r in whitening.whiten(table, whitening.fit(table)).collect():
        found[r.vec_id][r.component] = r
    assert set(found) == {None, *range(200)} and all(set(v) == {1, 2, 3, 4} for v in found.values())
    for c in range(4):
        expected = (x - sums / n) @ basis[:, c] / np.sqrt(values[c])
        got = np.array([found[i if i < 200 else None][c + 1].whitened for i in range(201)])
        assert min(np.abs(got - expected).max(), np.abs(got + expected).max()) < 1e-9
        row = found[5][c + 1]
        assert row.n == n and row.deviation == int(((n * x[5] - sums) ** 2).sum())
        assert abs(row.explained / (values[c] / values.sum()) - 1) < 1e-12 and row.identity_error < 1e-9


def test_whitening_edges(spark):
    def result(rows, kind="double"):
        table = vectors_table(spark, [(i, v, "x", 1) for i, v in enumerate(rows)], kind)
        return whitening.whiten(table, whitening.fit(table)).collect()

    assert result([]) == result([[1.0, 2.0]]) == result([[1.0, 2.0]] * 5) == result([None, []]) == []
    line = result([[1.0, 0.0], [2.0, 0.0], [4.0, 0.0]])  # one component has variance
    assert [(r.vec_id, r.component) for r in sorted(line)] == [(0, 1), (1, 1), (2, 1)] and line[0].explained == 1
    huge = result([[1e300, 0.0], [-1e300, 1.0], [0.0, 5.0]])
    assert {r.deviation for r in huge if r.vec_id < 2} == {None} and len(huge) in (3, 6)
    tie = result([[1.0, 0.0, 3.0], [0.0, 1.0, 3.0], [-1.0, 0.0, 3.0], [0.0, -1.0, 3.0], [1.0, 2.0], [1.0, 3.0]])
    assert {r.vec_id for r in tie} == {0, 1, 2, 3} and {r.component for r in tie} == {1, 2}


def test_coded_vectors():
    rows = np.array([[0, 127], [-128, 1], [128, 0], [-129, 0], [2**31 - 1, 0], [2**31, 0], [2**63 - 1, -2**63]], np.int64)
    codes = whitening.coded(rows)
    assert [len(c) // 2 for c in codes] == [1, 1, 2, 2, 4, 8, 8]
    assert (whitening.decoded(codes, 2) == rows).all()


# --- mixing ------------------------------------------------------------------------------------

def plain_targets(sizes, weights=(5, 2, 1), most=3):
    """Shares by weight, targets above their limit stopped and the excess shared again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {s: 0 for s in order if not sizes[s]}
    while True:
        free = [s for s in order if s not in fixed]
        share = (total - sum(fixed.values())) / sum(weight[s] for s in free) if free else 0
        above = [s for s in free if weight[s] * share > most * sizes[s]]
        if not above:
            return {s: fixed.get(s, weight[s] * share) for s in order}
        fixed |= {s: most * sizes[s] for s in above}


def corpus(spark, rng):
    names = ["b", "a", None, "é", "\U0001f600", "￮", "Z", "empty", "hot"]
    rows = []
    for i in range(300):
        source = "hot" if i % 3 == 0 else rng.choice(names)
        size = rng.choice([0, 1, 5, 40, 300]) if source != "empty" else 0
        rows.append((rng.choice([i, i, None]), rng.choice([" ", "\n\t"]).join(f"w{i}_{k}" for k in range(size)) or rng.choice(["", None]), source))
    rows += [(1000, "one two  three", "a")] * 7 + [(1000, "other", "a")] + [(2000, " ".join(map(str, range(5000))), "b")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return rows, table.withColumn("size", F.lit("clash")).withColumn("rank", F.lit(1)).withColumn("hash", F.lit(None))


def test_mix_of_all_sources(spark):
    rows, table = corpus(spark, random.Random(2))
    mixed = mixing.mix(table, block_words=16, shard_words=900)
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    got = {r.source: r for r in mixed.sources.collect()}
    expected = plain_targets(sizes)
    assert {s: r["size"] for s, r in got.items()} == dict(sizes)
    assert all(abs(got[s].target - expected[s]) < 1e-6 for s in expected)
    # One row for each document, near the targets, none above three times its size.
    out = mixing.taken(mixed).collect()
    assert Counter((r.doc_id, r["size"], r.source_size) for r in out) == Counter(
        (i, len(WORD.findall(t or "")), sizes[s]) for i, t, s in rows)
    assert all(0 <= r.taken <= 3 * r["size"] for r in out)
    by_source = Counter()
    parts = mixed.parts.collect()
    rank = {r.rank: s for s, r in got.items()}
    for p in parts:
        by_source[rank[p["rank"]]] += p.words
    assert all(abs(by_source[s] - expected[s]) <= 0.5 for s in expected)
    # Every word of a source is taken equally often, but for one time.
    times = defaultdict(Counter)
    for p in parts:
        for k in range(p.from_word, p.from_word + p.words):
            times[p["rank"]][p.id, p["hash"], p.copy, k] += 1
    for r, counted in times.items():
        every = list(counted.values()) + [0] * (sizes[rank[r]] - len(counted))
        assert max(every) - min(every) <= 1
    # Reruns agree, also when the rows come in another order.
    again = mixing.mix(table.orderBy(F.rand(1)).repartition(7), block_words=16, shard_words=900)
    order = lambda rows: sorted(map(repr, rows))
    assert order(out) == order(mixing.taken(again).collect())
    assert order(parts) == order(again.parts.select(*mixed.parts.columns).collect())
    # Blocks lie in one shard each; shards have equal numbers of blocks, and all ranges are disjoint.
    shard = defaultdict(set)
    for p in parts:
        shard[p["rank"], p.place].add(p.shard)
    assert all(len(s) == 1 for s in shard.values())
    blocks = Counter(s for v in shard.values() for s in v)
    assert len(blocks) > 5 and max(blocks.values()) - min(blocks.values()) <= 1


def test_texts_of_shards(spark):
    rows, table = corpus(spark, random.Random(6))
    mixed = mixing.mix(table, block_words=16, shard_words=900)
    found = mixing.texts(table, mixed.parts).collect()
    places = defaultdict(list)
    for r in found:
        places[r.shard].append(r.position)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    expected = sum(p.words for p in mixed.parts.collect())
    words = Counter(w for r in found for w in WORD.findall(r.text))
    assert sum(words.values()) == expected
    known = Counter(w for _, t, _ in rows for w in WORD.findall(t or ""))
    assert set(words) <= set(known) and all(n <= 3 * known[w] for w, n in words.items())


def test_splitting_tree(spark):
    quotas = {0: 1000, 1: 1, 2: 37, 5: 400}
    table = spark.createDataFrame(list(quotas.items()), "rank long, quota long")
    for shards, fan in ((1, 64), (7, 2), (50, 4), (50, 64)):
        rows = mixing.shard_quotas(table, shards, seed=3, fan=fan).collect()
        for rank, quota in quotas.items():
            own = sorted((r.begin, r.end) for r in rows if r["rank"] == rank)
            assert own[0][0] == 0 and own[-1][1] == quota and all(a[1] == b[0] for a, b in zip(own, own[1:]))
        per = Counter()
        for r in rows:
            per[r.shard] += r.end - r.begin
        assert len(per) == shards and max(per.values()) - min(per.values()) <= 1
    # The fan of a round doesn't change the draws of the nodes.
    small, large = (sorted(map(tuple, mixing.shard_quotas(table, 64, 3, fan).collect())) for fan in (8, 64))
    assert small == large


def test_permutations():
    for blocks in (1, 2, 3, 17, 500):
        at = np.arange(blocks)
        seen = set()
        for rank, epoch in ((0, 0), (0, 1), (9, 0)):
            place = mixing.permuted(at, np.full(blocks, blocks), np.full(blocks, rank), np.full(blocks, epoch), 1)
            assert sorted(place.tolist()) == at.tolist() and place[-1] == blocks - 1
            seen.add(tuple(place.tolist()))
        assert blocks < 17 or len(seen) == 3


def test_mix_edges(spark):
    schema = "doc_id long, text string, source string"
    assert mixing.taken(mixing.mix(spark.createDataFrame([], schema))).count() == 0
    only_empty = mixing.taken(mixing.mix(spark.createDataFrame([(1, "", "a"), (2, None, None)], schema))).collect()
    assert sorted(tuple(r) for r in only_empty) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    one = mixing.taken(mixing.mix(spark.createDataFrame([(1, "a b c", "a")], schema))).collect()
    assert [tuple(r) for r in one] == [(1, 3, 3, 3.0, 3)]
