"""Passages that documents share, exactly or nearly, by collinear chaining.

Seeds are hashes of k words; of each window of seeds the smallest stays, so every stretch of WINDOW + SEED - 1 equal
words leaves a common seed. Seeds are joined with one document that has them, the one with the smallest id (the hub), the nth equal
seed of one with the nth of the other, so a passage in a third of all documents costs one row per occurrence. Matches of a document and a hub are chained in both
texts' order: the best chain that ends in a match adds its words and subtracts a cost for the words skipped in either
text, found as a prefix maximum in a Fenwick tree; where that lies beyond the longest gap, the matches within the gap are
tried. Chains of two matches or more are extended at both ends, word by word on the whole texts, those that stay too short
once more with less regard to words that differ, and then aligned (longest common subsequence, by bits of whole numbers);
those with enough words, and enough equal ones, are passages, and others are split at their largest gap and tried again. Every seed of every text is used.

A hub may hold only part of a passage that others share in full. So in stretches of shared seeds that no passage covers,
every window of LEAST_WORDS words is joined with the smallest id that has the same window: of exact passages none is lost.

Defined cases: null or empty texts and texts shorter than a seed have no passage; null ids are left out; rows that share
an id are joined as one document only by its first text in hash order; an empty table gives no rows; only the columns of
``RESULT`` are returned. Repeats within one document are not passages.
"""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import counted, documents, gather, removed, returned, slices, small_batches, stored, stored_at
from .registry import query

#: Words of a seed, and seeds of a window.
SEED, WINDOW = 6, 8
#: A word skipped costs this part of a matched word; a chain ends where skipping costs more than it has.
SKIP_COST = 0.25
#: A gap of so many words in either text always ends a chain.
LONGEST_GAP = 60
#: The least words of a passage, and the least share of equal words in its alignment.
LEAST_WORDS, LEAST_EQUAL = 50, 0.8
#: Words beyond the ends of a chain that are read to extend it; chains that need more are read again with MORE times as many.
REACH, MORE = 48, 64
#: In an extension a word that differs costs so many equal ones, which keeps LEAST_EQUAL; a fall by more than DROP ends it.
#: Where that leaves too few words, a word that differs costs LOOSE, as edits may stand close to an end.
DIFFERS, DROP, LOOSE = 4, 8, 1
#: Seeds handled at one time, about.
PLACES = 250_000
#: Rows of a batch and places in words are joined to one number by this factor.
ROW = 1 << 40
RESULT = "doc_id long, start long, end long, other_doc_id long, other_start long, other_end long, equal_share double"


def word_codes(text: str) -> np.ndarray:
    return coded(text.encode().lower().split())


def coded(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8").astype(np.uint64)


def seeds(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the seeds that are smallest in a window (the last of equal ones)."""
    if len(codes) < SEED:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    found = np.zeros(len(codes) - SEED + 1, np.uint64)
    for k in range(SEED):
        found = (found ^ codes[k:k + len(found)]) * np.uint64(0x9E3779B97F4A7C15)
        found ^= found >> np.uint64(29)
    width = min(WINDOW, len(found))
    windows = np.lib.stride_tricks.sliding_window_view(found, width)
    at = np.unique(np.arange(len(windows)) + width - 1 - windows[:, ::-1].argmin(axis=1))
    return at, found[at]


def all_seeds(codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``seeds`` of many texts in one pass: the text's number, place and hash of each."""
    count = np.array([len(c) - SEED + 1 for c in codes], np.int64)
    long_ = np.flatnonzero(count >= WINDOW)
    parts = [(np.full(len(at), k), at, h) for k in np.flatnonzero(count < WINDOW).tolist() for at, h in [seeds(codes[k])]]
    if len(long_):
        flat = np.concatenate([codes[k] for k in long_.tolist()])
        size = count[long_] + SEED - 1
        text = np.repeat(np.arange(len(long_)), size)
        start = np.cumsum(size) - size
        found = np.zeros(len(flat) - SEED + 1, np.uint64)
        for k in range(SEED):
            found = (found ^ flat[k:k + len(found)]) * np.uint64(0x9E3779B97F4A7C15)
            found ^= found >> np.uint64(29)
        least, at = found, np.arange(len(found))
        step = 1
        while step < WINDOW:  # WINDOW is a power of two; of equal seeds the last stays
            right = least[step:] <= least[:-step]
            least, at = np.where(right, least[step:], least[:-step]), np.where(right, at[step:], at[:-step])
            step *= 2
        chosen = np.zeros(len(found), bool)
        chosen[at[text[:len(at)] == text[len(flat) - len(at):]]] = True
        at = np.flatnonzero(chosen)
        parts.append((long_[text[at]], at - start[text[at]], found[at]))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*parts))


def joined(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """One hash of two."""
    z = (x ^ (y + np.uint64(0x9E3779B97F4A7C15) + (x << np.uint64(6)))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(29))


def window_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` words, joined from windows whose sizes are powers of two."""
    total = max(0, len(codes) - size + 1)
    power, width, done, out = codes.astype(np.uint64), 1, 0, np.full(total, size, np.uint64)
    while total and done < size:
        if size & width:
            out = joined(out, power[done:done + total])
            done += width
        if done < size:
            power, width = joined(power[:-width], power[width:]), 2 * width
    return out


class Fenwick:
    """Prefix maxima over places 0..size-1, each with the entry that holds it."""

    def __init__(self, size: int):
        self.best = [(-1e18, -1)] * (size + 1)

    def put(self, place: int, value: float, entry: int) -> None:
        at = place + 1
        while at < len(self.best):
            if self.best[at][0] < value:
                self.best[at] = (value, entry)
            at += at & -at

    def upto(self, place: int) -> tuple[float, int]:
        """The largest value at places below ``place``."""
        found, at = (-1e18, -1), place
        while at > 0:
            if self.best[at][0] > found[0]:
                found = self.best[at]
            at -= at & -at
        return found


def chains(a: list[int], b: list[int]) -> list[list[int]]:
    """Collinear chains of matches (places ``a`` in one text, ``b`` in the other), each as indices in order.

    A match is worth SEED words less those that it shares with the one before. The cost of a gap is SKIP_COST for each
    word skipped in either text, so it splits into a part of each end, and prefix maxima find the best predecessor.
    """
    order = sorted(range(len(a)), key=lambda i: (a[i], -b[i]))
    places = {p: k for k, p in enumerate(sorted(set(b)))}
    tree = Fenwick(len(places))
    score, before = [0.0] * len(a), [-1] * len(a)
    waiting: list[int] = []
    live: defaultdict[int, deque] = defaultdict(deque)  # by place in the other text: matches that none later outdoes
    worth = lambda k: score[k] + SKIP_COST * (a[k] + b[k])
    for n, i in enumerate(order):
        if n and a[order[n - 1]] != a[i]:
            for j in waiting:
                tree.put(places[b[j]], worth(j), j)
                ahead = live[b[j]]
                while ahead and worth(ahead[-1]) <= worth(j):
                    ahead.pop()
                ahead.append(j)
            waiting = []
        value, j = tree.upto(places[b[i]])
        if j >= 0 and (a[i] - a[j] > LONGEST_GAP or b[i] - b[j] > LONGEST_GAP):
            within = []
            for place in range(b[i] - LONGEST_GAP, b[i]):
                if ahead := live.get(place):
                    while ahead and a[i] - a[ahead[0]] > LONGEST_GAP:
                        ahead.popleft()
                    within.extend([*ahead][:1])
            j = max(within, key=worth, default=-1)
        own = float(SEED)
        if j >= 0:
            step = min(a[i] - a[j], b[i] - b[j], SEED)
            gap = max(0, a[i] - a[j] - SEED) + max(0, b[i] - b[j] - SEED)
            joined = score[j] + step - SKIP_COST * gap
            if joined > step:
                own, before[i] = joined, j
        score[i] = own
        waiting.append(i)
    used, found = [False] * len(a), []
    for i in sorted(range(len(a)), key=lambda i: -score[i]):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = before[i]
        if chain:
            found.append(chain[::-1])
    return found


def unbroken(a: np.ndarray, b: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which groups of sorted matches (beginning at ``start``) are one chain by ``chains``, seen without a search.

    Matches at one shift follow one another, as long as each join pays and no shorter chain is worth as much.
    """
    size = np.diff(start, append=len(a))
    first = np.zeros(len(a), bool)
    first[start] = True
    step, other = np.diff(a, prepend=0), np.diff(b, prepend=0)
    worth = np.minimum(step, SEED) - 2 * SKIP_COST * np.maximum(step - SEED, 0)
    worth[first] = SEED
    score = np.cumsum(worth)
    score -= np.repeat(score[start] - SEED, size)
    joined = first | ((step == other) & (step > 0) & (step <= LONGEST_GAP) & (score > np.minimum(step, SEED)))
    end = start + size - 1
    whole = score[end]
    score[end] = -np.inf
    return np.logical_and.reduceat(joined, start) & (np.maximum.reduceat(score, start) < whole)


def common_words(x: list[int], y: list[int]) -> int:
    """Length of the longest common subsequence; each column of the table is one whole number, a bit per word of ``x``."""
    where: dict[int, int] = {}
    for i, word in enumerate(x):
        where[word] = where.get(word, 0) | 1 << i
    full = (1 << len(x)) - 1
    row = full
    for word in y:
        match = row & where.get(word, 0)
        row = ((row + match) | (row - match)) & full
    return len(x) - row.bit_count()


def occurrence(values: np.ndarray) -> np.ndarray:
    """How often each value stood before in the array."""
    order = np.argsort(values, kind="stable")
    first = np.append(True, values[order][1:] != values[order][:-1]) if len(values) else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(first, np.arange(len(values)), 0))
    out = np.empty(len(values), np.int64)
    out[order] = np.arange(len(values)) - start
    return out


def find_seeds(docs: DataFrame) -> DataFrame:
    """Seeds of all documents: ``id``, ``at``, ``seed``, and ``nth`` among the document's equal seeds."""
    @returned
    def work(batches):
        for batch in batches:
            for part, texts in slices(batch, "text"):
                text, at, found = all_seeds([word_codes(t) for t in texts])
                order = np.argsort(found)
                same = np.flatnonzero(found[order][1:] == found[order][:-1])
                equal = np.unique(order[np.append(same, same + 1)])  # most seeds stand once
                order = equal[np.lexsort((at[equal], found[equal], text[equal]))]
                first = np.ones(len(order), bool)
                first[1:] = (text[order][1:] != text[order][:-1]) | (found[order][1:] != found[order][:-1])
                nth = np.zeros(len(found), np.int64)
                nth[order] = np.arange(len(order)) - np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part.column("id").to_numpy()[text]), pa.array(at), pa.array(found.astype(np.int64)), pa.array(nth)],
                    ["id", "at", "seed", "nth"])

    return docs.mapInArrow(work, "id long, at long, seed long, nth long")


def common_seeds(found: DataFrame) -> DataFrame:
    """The seeds that several ids have, with the ``hub`` (smallest id) and its place ``other`` of the first of equal ones, and
    for repeated ones of other ids also those of the nth (``nth_hub``, ``nth_other``; null if it has none but this id).

    Seeds move once and pass through a task in order, so a seed of any frequency is a stream: only rows before its second
    id are held.
    """
    names = ("seed", "nth", "id", "at")

    @returned
    def work(batches):
        held = [np.zeros(0, np.int64)] * 4 + [np.zeros(0, bool)]  # of the last seed; and which rows are still to be given
        waiting, size = [], 0

        def shared():
            nonlocal held, waiting, size
            columns = [np.concatenate([h, *(b.column(c).to_numpy() for b in waiting)]) for h, c in zip(held, names)]
            open_ = np.append(held[4], np.ones(size, bool))
            waiting, size = [], 0
            seed, nth, doc, at = columns
            new = np.append(True, seed[1:] != seed[:-1])
            start, run = np.flatnonzero(new), np.cumsum(new) - 1
            new[1:] |= nth[1:] != nth[:-1]
            group = np.maximum.accumulate(np.where(new, np.arange(len(seed)), 0))
            first = start[run]
            other = (nth == 0) & (doc != doc[first])
            several = np.logical_or.reduceat(other, start)
            take = np.flatnonzero(several[run] & open_)
            one = ~((nth > 0) & (doc != doc[group]))[take]
            # Of the last seed: all rows so far if there is one id; else its hub, another id and the hub of the last group.
            last = np.arange(start[-1], len(seed))
            if several[-1]:
                keep = np.unique([last[0], last[other[last]][0], group[-1]])
                held = [c[keep] for c in columns] + [np.zeros(len(keep), bool)]
            else:
                held = [c[last[nth[last] == 0]] for c in (*columns, open_)]
            first, group = first[take], group[take]
            return pa.RecordBatch.from_arrays(
                [pa.array(c[take]) for c in (doc, at, seed, nth)] + [pa.array(doc[first]), pa.array(at[first])]
                + [pa.array(c[group], mask=one) for c in (doc, at)], ["id", "at", "seed", "nth", "hub", "other", "nth_hub", "nth_other"])

        for batch in batches:
            waiting.append(batch)
            size += batch.num_rows
            if size >= PLACES:
                yield shared()
        if size:
            yield shared()

    ordered = found.select(*names).repartition("seed").sortWithinPartitions(*names)
    return ordered.mapInArrow(work, "id long, at long, seed long, nth long, hub long, other long, nth_hub long, nth_other long")


def chain_matches(matches: DataFrame) -> DataFrame:
    """Chains of each (id, hub) with two matches or more: the places in both, in words. Rows of one pair come together, sorted."""
    @returned
    def work(batches):
        held = [np.zeros(0, np.int64)] * 4  # matches of the last pair so far
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]

        def out(columns, start, end):
            if not len(start):
                return None
            rows, stretch = [], gather(np.arange(len(columns[0])), start, end - start)
            whole = unbroken(columns[2][stretch], columns[3][stretch], np.cumsum(end - start) - (end - start))
            for lo, hi, one in zip(start.tolist(), end.tolist(), whole.tolist()):
                doc, hub, a, b = int(columns[0][lo]), int(columns[1][lo]), columns[2][lo:hi], columns[3][lo:hi]
                if one:
                    rows.append((doc, hub, a, b))
                    continue
                a, b = a.tolist(), b.tolist()
                rows += [(doc, hub, [a[i] for i in c], [b[i] for i in c]) for c in chains(a, b) if len(c) > 1]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], ["id", "hub", "at", "other"]) if rows else None

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [np.concatenate([h, batch.column(c).to_numpy()]) for h, c in zip(held, ("id", "hub", "at", "other"))]
            new = (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])
            start = np.append(0, np.flatnonzero(new) + 1)
            held = [c[start[-1]:] for c in columns]
            several = np.diff(start) > 1  # most pairs have one match, which makes no chain
            if (found := out(columns, start[:-1][several], start[1:][several])) is not None:
                yield found
        if len(held[0]) > 1 and (found := out(held, np.array([0]), np.array([len(held[0])]))) is not None:
            yield found

    ordered = matches.repartition("id", "hub").sortWithinPartitions("id", "hub", "at", "other")
    return ordered.mapInArrow(work, "id long, hub long, at array<long>, other array<long>")


def cut_words(docs: DataFrame, spans: DataFrame, reach: int) -> DataFrame:
    """The word codes of each span (``chain``, ``side``, ``id``, ``start``, ``end``) of its document and of ``reach`` words
    around it: ``words``, the place of the ``first``, and how many the document has (``total``)."""
    @returned
    def work(batches):
        for batch in batches:
            for part, texts in slices(batch, "text"):
                out, last, words, codes = [], None, [], None
                for text, start, end in zip(texts, part.column("start").to_pylist(), part.column("end").to_pylist()):
                    first = max(0, start - reach)
                    if text != last:
                        words, last, codes = text.encode().lower().split(), text, None
                        cut = coded(words[first:end + reach])
                    else:  # a text with several spans is coded whole, once
                        codes = coded(words) if codes is None else codes
                        cut = codes[first:end + reach]
                    out.append((cut.astype("<u8").tobytes(), first, len(words)))
                words, first, total = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [part.column("chain"), part.column("side"), pa.array(words, pa.binary()), pa.array(first, pa.int64()), pa.array(total, pa.int64())],
                    ["chain", "side", "words", "first", "total"])

    return docs.join(spans, "id").select("chain", "side", "start", "end", "text").mapInArrow(work, "chain long, side int, words binary, first long, total long")


def extension(x: np.ndarray, y: np.ndarray, x_cut: bool, y_cut: bool, differs: int = DIFFERS) -> int | None:
    """How many words from the start of both continue a match; None if that depends on words that were cut off."""
    size = min(len(x), len(y))
    best = score = at = 0
    for k, (p, q) in enumerate(zip(x[:64].tolist(), y[:64].tolist()), 1):  # most extensions end soon
        score += 1 if p == q else -differs
        if score > best:
            best, at = score, k
        elif score < best - DROP:
            return at
    if size > 64:
        score = np.cumsum(np.where(x[:size] == y[:size], 1, -differs))
        best = np.maximum.accumulate(np.maximum(score, 0))
        fallen = score < best - DROP
        stop = int(fallen.argmax()) if fallen.any() else size - 1
        at = int((score == best[stop]).argmax()) + 1 if best[stop] else 0
        if fallen.any():
            return at
    ended = len(x) <= len(y) and not x_cut or len(y) <= len(x) and not y_cut
    return at if ended else None


def equal_words(p: np.ndarray, q: np.ndarray) -> int:
    """``common_words`` of two stretches; equal words at both ends are counted at once."""
    size = min(len(p), len(q))
    same = p[:size] == q[:size]
    head = size if same.all() else int(same.argmin())
    p, q, size = p[head:], q[head:], size - head
    same = p[len(p) - size:][::-1] == q[len(q) - size:][::-1]
    tail = size if same.all() else int(same.argmin())
    return head + tail + common_words(p[:len(p) - tail].tolist(), q[:len(q) - tail].tolist())


def settle(x: np.ndarray, y: np.ndarray, a: list[int], b: list[int], least: int, cut: list[bool]) -> list[tuple] | None:
    """Passages of a chain (places ``a`` in ``x``, ``b`` in ``y``): spans in both and the share of equal words.

    ``cut`` says whether words are missing before and after ``x``, before and after ``y``; None if they are needed.
    """
    found, parts = [], [(0, len(a))]
    while parts:
        lo, hi = parts.pop()
        for differs in (DIFFERS, LOOSE):
            start, other, end, other_end = a[lo], b[lo], a[hi - 1] + SEED, b[hi - 1] + SEED
            before = extension(x[:start][::-1], y[:other][::-1], cut[0], cut[2], differs)
            after = extension(x[end:], y[other_end:], cut[1], cut[3], differs)
            if before is None or after is None:
                return None
            start, other, end, other_end = start - before, other - before, end + after, other_end + after
            if end - start >= least:
                break
        p, q = x[start:end], y[other:other_end]
        if len(p) >= least:
            share = equal_words(p, q) / max(len(p), len(q))
            if share >= LEAST_EQUAL:
                found.append((start, end, other, other_end, share))
                continue
        if differs == LOOSE and len({i - j for i, j in zip(a[lo:hi], b[lo:hi])}) == 1:
            continue  # its parts would be extended over the same words
        if hi - lo > 1:
            at = max(range(lo + 1, hi), key=lambda k: max(a[k] - a[k - 1], b[k] - b[k - 1]))
            parts += [(lo, at), (at, hi)]
    return found


def settled(pairs: DataFrame, least: int) -> DataFrame:
    """Passages of each chain (columns of RESULT), or one row that is ``open`` if it has to be read with more words."""
    columns = ("id", "hub", "at", "other", "x.words", "x.first", "x.total", "y.words", "y.first", "y.total")
    names = ["chain", "doc_id", "start", "end", "other_doc_id", "other_start", "other_end", "equal_share", "open"]

    @returned
    def work(batches):
        for batch in batches:
            rows = []
            for chain, *row in zip(*(batch.column(c.replace(".", "_")).to_pylist() for c in ("chain", *columns))):
                doc, hub, a, b, x, x0, x_total, y, y0, y_total = row
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                a, b = [v - x0 for v in a], [v - y0 for v in b]
                if a[-1] + SEED > len(x) or b[-1] + SEED > len(y):
                    continue  # seeds of another text with the same id
                found = settle(x, y, a, b, least, [x0 > 0, x0 + len(x) < x_total, y0 > 0, y0 + len(y) < y_total])
                if found is None:
                    rows.append((chain, doc, 0, 0, hub, 0, 0, 0.0, True))
                else:
                    rows += [(chain, doc, s + x0, e + x0, hub, t + y0, f + y0, share, False) for s, e, t, f, share in found]
            if rows:
                kinds = [pa.int64()] * 7 + [pa.float64(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names)

    flat = pairs.select("chain", *[F.col(c).alias(c.replace(".", "_")) for c in columns])
    return flat.mapInArrow(work, f"chain long, {RESULT}, open boolean")


def passages_of(rows: DataFrame, spans: DataFrame, least: int) -> DataFrame:
    """Passages of chains (``id``, ``hub``, and the places ``at`` and ``other`` of their matches): columns of RESULT."""
    spans = stored(spans.withColumn("chain", F.xxhash64("id", "hub", "at", "other")).dropDuplicates(["chain"]), "chains")
    found, reach = None, REACH
    while True:
        ends = lambda c: (F.get(c, F.lit(0)).alias("start"), (F.element_at(c, -1) + SEED).alias("end"))
        wanted = spans.select("chain", F.lit(0).alias("side"), "id", *ends(F.col("at"))).union(
            spans.select("chain", F.lit(1), F.col("hub").alias("id"), *ends(F.col("other"))))
        # Few spans go to the texts, which then stay where they are.
        cut = cut_words(rows, counted(wanted, "spans"), reach)
        # Both sides of a chain move once.
        side = lambda k: F.min(F.when(F.col("side") == k, F.struct("words", "first", "total")))
        words = cut.repartition("chain").groupBy("chain").agg(side(0).alias("x"), side(1).alias("y"))
        pairs = spans.join(words.where("x IS NOT NULL AND y IS NOT NULL"), "chain")
        done = stored(settled(pairs, least), "settled")
        part = done.where("NOT open").drop("chain", "open")
        found = part if found is None else found.union(part)
        rest = done.where("open").select("chain")
        if rest.isEmpty():
            return found
        spans, reach = stored(spans.join(rest, "chain", "left_semi"), "chains"), reach * MORE


def stretches(at: list[int], least: int) -> list[tuple[int, int]]:
    """First and last start of the windows of ``least`` words whose seeds may all be among the sorted places ``at``.

    A window has a seed in its first WINDOW places and its last, and one in WINDOW places between.
    """
    found, first = [], 0
    for k in range(1, len(at) + 1):
        if k == len(at) or at[k] - at[k - 1] > WINDOW:
            lo, hi = max(0, at[first] - WINDOW + 1), at[k - 1] - (least - SEED - WINDOW + 1)
            if lo <= hi:
                found.append((lo, hi))
            first = k
    return found


def uncovered(windows: list[tuple[int, int]], passages: list[tuple[int, int]], least: int) -> list[tuple[int, int]]:
    """The part of the window starts that lie in no passage."""
    found, covered = [], sorted((start, end - least) for start, end in passages)
    for lo, hi in windows:
        for first, last in covered:
            if first <= hi and last >= lo:
                if lo < first:
                    found.append((lo, first - 1))
                lo = max(lo, last + 1)
        if lo <= hi:
            found.append((lo, hi))
    return found


def places_of(batch: pa.RecordBatch, *names: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, list[np.ndarray]]]:
    """Parts of a batch of about PLACES seeds, with the row and the columns ``names`` of each seed, sorted by row, the place
    ``at`` and ``seed``."""
    size = pc.list_value_length(batch.column("places")).to_numpy()
    cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(size) // PLACES)) + 1).tolist(), batch.num_rows]
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        part = batch.slice(lo, hi - lo)
        flat, row = part.column("places").flatten(), np.repeat(np.arange(hi - lo), size[lo:hi])
        order = np.lexsort((flat.field("seed").to_numpy(), flat.field("at").to_numpy(), row))
        yield part, row[order], [flat.field(c).to_numpy()[order] for c in names]


def lost_windows(gathered_places: DataFrame, found: DataFrame, least: int) -> DataFrame:
    """Seeds of windows that may be shared with a smaller id though no passage covers them: ``id``, ``at``, ``seed``, and
    the starts ``lo`` to ``hi`` of the windows at the first seed of each."""
    @returned
    def work(batches):
        for batch in batches:
            for part, row, (at, seed) in places_of(batch, "at", "seed") if batch.num_rows else ():
                new = np.ones(len(row), bool)
                new[1:] = (np.diff(row) > 0) | (np.diff(at) > 0) | (seed[1:] != seed[:-1])
                row, at, seed = row[new], at[new], seed[new]
                # As ``stretches``, of all rows.
                first = np.flatnonzero(np.append(True, (np.diff(row) > 0) | (np.diff(at) > WINDOW)))
                last = np.append(first[1:], len(row)) - 1
                lo, hi = np.maximum(0, at[first] - WINDOW + 1), at[last] - (least - SEED - WINDOW + 1)
                pick = lo <= hi
                open_: dict[int, list] = {}
                for r, x, y in zip(row[first][pick].tolist(), lo[pick].tolist(), hi[pick].tolist()):
                    open_.setdefault(r, []).append((x, y))
                spans = part.column("spans")
                rest = [(r, x, y) for r, windows in open_.items()
                        for x, y in uncovered(windows, [(p["start"], p["end"]) for p in spans[r].as_py() or []], least)]
                if not rest:
                    continue
                r, lo, hi = np.array(rest, np.int64).T
                key = row * ROW + at
                start = np.searchsorted(key, r * ROW + lo)
                count = np.searchsorted(key, r * ROW + hi + least - SEED, side="right") - start
                r, lo, hi, start, count = (x[count > 0] for x in (r, lo, hi, start, count))
                taken = gather(np.arange(len(key)), start, count)
                inner = np.ones(len(taken), bool)
                inner[np.cumsum(count) - count] = False
                ids = part.column("id").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (ids[row[taken]], at[taken], seed[taken])]
                    + [pa.array(np.repeat(x, count), mask=inner) for x in (lo, hi)], ["id", "at", "seed", "lo", "hi"])

    spans = found.groupBy(F.col("doc_id").alias("id")).agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    return gathered_places.join(spans, "id", "left").select("id", "places", "spans").mapInArrow(work, "id long, at long, seed long, lo long, hi long")


def find_windows(rows: DataFrame, places: DataFrame, least: int) -> DataFrame:
    """Hashes of the windows of ``least`` words at stretches of seeds (``id``, sorted places ``at``): ``id``, ``at``, ``window``,
    ``nth`` among the document's equal windows, whether it is ``lost`` (in ``open``), and ``apart`` from the equal one before."""
    @returned
    def work(batches):
        for batch in batches:
            for part, texts in slices(batch, "text"):
                out = []
                for doc, text, at, open_ in zip(part.column("id").to_pylist(), texts, part.column("at").to_pylist(), part.column("open").to_pylist()):
                    words = text.encode().lower().split()
                    starts = [np.arange(lo, min(hi, len(words) - least) + 1) for lo, hi in stretches(at, least)]
                    starts = np.unique(np.concatenate(starts)) if starts else np.zeros(0, np.int64)
                    if not len(starts):
                        continue
                    hashes = window_hashes(coded(words[starts[0]:starts[-1] + least]), least)[starts - starts[0]].astype(np.int64)
                    nth = occurrence(hashes)
                    order = np.argsort(hashes, kind="stable")
                    apart = np.ones(len(starts), bool)
                    near = (hashes[order][1:] == hashes[order][:-1]) & (np.diff(starts[order]) < least)
                    apart[order[1:][near]] = False
                    lost = np.zeros(len(starts), bool)
                    for w in open_ or []:
                        lost |= (starts >= w["lo"]) & (starts <= w["hi"])
                    out.append((np.full(len(starts), doc), starts, hashes, nth, lost, apart))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], ["id", "at", "window", "nth", "lost", "apart"])

    # Only texts with such stretches move.
    here = rows.join(counted(places.select("id"), "window-ids"), "id", "left_semi")
    return here.join(places, "id").mapInArrow(work, "id long, at long, window long, nth long, lost boolean, apart boolean")


def long_enough(places: DataFrame, least: int) -> DataFrame:
    """The rows whose sorted places ``at`` have a window of ``least`` words by ``stretches``."""
    @returned
    def work(batches):
        for batch in batches:
            keep = [bool(stretches(at, least)) for at in batch.column("at").to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return places.mapInArrow(work, places.schema)


def whole_windows(rows: DataFrame, seeds_found: DataFrame, places_shared: DataFrame, found: DataFrame, least: int) -> DataFrame | None:
    """Chains, as ``passages_of`` takes them, of exact passages that ``found`` lacks; None if there can be none.

    ``places_shared`` has the seeds that a smaller id has too, gathered.
    """
    lost = stored(lost_windows(places_shared, found, least), "lost")
    if lost.isEmpty():
        return None
    places = seeds_found.join(lost.select("seed").distinct(), "seed", "left_semi").groupBy("id").agg(F.sort_array(F.collect_set("at")).alias("at"))
    starts = lost.where("lo IS NOT NULL").groupBy("id").agg(F.collect_set(F.struct("lo", "hi")).alias("open"))
    windows = stored(find_windows(rows, stored(long_enough(places.join(starts, "id", "left"), least), "window-places"), least), "windows")
    first = windows.groupBy("window", "nth").agg(F.min(F.struct("id", "at")).alias("hub"), F.max("id").alias("last")).where("hub.id < last")
    first = stored(first.select("window", "nth", F.col("hub.id").alias("hub"), F.col("hub.at").alias("other")), "first-windows")
    open_, columns = windows.where("lost"), ("id", "hub", "at", "other")
    # Equal windows meet in order; one that stands alone may also repeat what the hub has once.
    matches = open_.join(first, ["window", "nth"]).select(*columns).union(
        open_.where("nth > 0 AND apart").join(first.where("nth = 0").drop("nth"), "window").select(*columns))
    matches = matches.where("hub < id").withColumn("shift", F.col("at") - F.col("other")).distinct()
    # Windows that overlap or touch at one shift are one passage.
    order = Window.partitionBy("id", "hub", "shift").orderBy("at")
    matches = matches.withColumn("new", F.coalesce((F.col("at") - F.lag("at").over(order) > least).cast("int"), F.lit(0)))
    matches = matches.withColumn("run", F.sum("new").over(order)).groupBy("id", "hub", "shift", "run").agg(F.min("at").alias("lo"), F.max("at").alias("hi"))
    ends = F.array("lo", F.col("hi") + (least - SEED))
    return matches.select("id", "hub", ends.alias("at"), F.transform(ends, lambda x: x - F.col("shift")).alias("other"))


def apart(row: np.ndarray, at: np.ndarray, hub: np.ndarray, other: np.ndarray, least: int, slack: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of seeds (sorted by ``row`` and place ``at``) that fit in one passage, but were not compared with one document
    side by side: their hubs differ, or have them elsewhere, by more than ``slack`` words."""
    one = np.arange(len(at))
    for step in range(1, least - SEED + 1):
        one = one[one + step < len(at)]
        two = one + step
        near = (row[two] == row[one]) & (at[two] - at[one] <= least - SEED)
        one, two = one[near], two[near]
        if not len(one):
            return
        gap, there = at[two] - at[one], other[two] - other[one]
        pick = (gap > 0) & ((hub[two] != hub[one]) | (there <= 0) | (np.abs(there - gap) > slack))
        yield one[pick], two[pick]


def reached(spans: pa.ListArray, row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The furthest end of the spans of each row that start at ``at`` or before; -1 if there is none."""
    there = np.repeat(np.arange(len(spans)), pc.fill_null(pc.list_value_length(spans), 0).to_numpy())
    if not len(there):
        return np.full(len(at), -1)
    flat = spans.flatten()
    start, end = there * ROW + flat.field("start").to_numpy(), there * ROW + flat.field("end").to_numpy()
    order = np.argsort(start)
    there, start, end = there[order], start[order], np.maximum.accumulate(end[order])
    k = np.searchsorted(start, row * ROW + at, side="right") - 1
    return np.where((k >= 0) & (there[k] == row), end[k] - row * ROW, -1)


def gathered(places: DataFrame) -> DataFrame:
    return places.groupBy("id").agg(F.collect_list(F.struct("at", "seed", "hub", "other")).alias("places"))


def lost_pairs(gathered_places: DataFrame, found: DataFrame, least: int) -> DataFrame:
    """Seeds of which two are ``apart`` and in no passage of ``found``."""
    @returned
    def work(batches):
        for batch in batches:
            for part, row, (at, seed, hub, other) in places_of(batch, "at", "seed", "hub", "other") if batch.num_rows else ():
                covered = reached(part.column("spans"), row, at)
                wanted = np.zeros(len(at), bool)
                for one, two in apart(row, at, hub, other, least, least // 5):
                    lost = covered[one] < at[two] + SEED
                    wanted[one[lost]] = wanted[two[lost]] = True
                if wanted.any():
                    yield pa.RecordBatch.from_arrays([pa.array(np.unique(seed[wanted]))], ["seed"])

    spans = found.groupBy(F.col("doc_id").alias("id")).agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    return gathered_places.join(spans, "id", "left").select("id", "places", "spans").mapInArrow(work, "seed long")


def pair_keys(places: DataFrame, least: int) -> DataFrame:
    """Keys of every two seeds of a document that are ``apart``: ``key``, ``id``."""
    @returned
    def work(batches):
        for batch in batches:
            for part, row, (at, seed, hub, other) in places_of(batch, "at", "seed", "hub", "other") if batch.num_rows else ():
                out, rows = [], []
                for one, two in apart(row, at, hub, other, least, least // 10):
                    if len(one):
                        both = joined(seed[one].astype(np.uint64), seed[two].astype(np.uint64))
                        out.append(joined(np.full(len(one), 2, np.uint64), both).astype(np.int64))
                        rows.append(row[one])
                if not out:
                    continue
                keys, rows = np.concatenate(out), np.concatenate(rows)
                order = np.lexsort((keys, rows))
                keys, rows = keys[order], rows[order]
                new = np.append(True, (np.diff(rows) > 0) | (keys[1:] != keys[:-1]))
                yield pa.RecordBatch.from_arrays([pa.array(keys[new]), pa.array(part.column("id").to_numpy()[rows[new]])], ["key", "id"])

    return gathered(places).mapInArrow(work, "key long, id long")


def paired_matches(seeds_found: DataFrame, places_shared: DataFrame, found: DataFrame, least: int) -> DataFrame | None:
    """Matches of documents with the first that has two seeds of theirs near each other, where ``found`` has no passage:
    ``id``, ``hub``, ``at``, ``other``; None if there can be none.

    Of passages with edits the seeds may have several hubs, none of which has the passage. Two seeds that hubs hold apart
    stand together only where the passage does, so the first document with both is a hub for it.
    """
    lost = stored(lost_pairs(places_shared, found, least), "lost-pairs")
    if lost.isEmpty():
        return None
    places = stored(seeds_found.join(lost.select("seed").distinct(), "seed", "left_semi"), "pair-places")
    keys = stored(pair_keys(places, least), "pair-keys")
    first = keys.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("last")).where("hub < last").drop("last")
    pairs = stored(keys.join(first, "key").where("hub < id").select("id", "hub").distinct(), "pairs")
    # Both are compared by all of these seeds that they have in common.
    here = places.select("id", "seed", "nth", "at").join(pairs, "id")
    there = places.select(F.col("id").alias("hub"), "seed", "nth", F.col("at").alias("other")).join(pairs.select("hub").distinct(), "hub", "left_semi")
    columns = ("id", "hub", "at", "other")
    # The hubs' seeds are few for each key, so they are looked up; the others need not be sorted.
    return here.join(there.hint("shuffle_hash"), ["hub", "seed", "nth"]).select(*columns).repartition("id", "hub").distinct()


def outermost(found: DataFrame) -> DataFrame:
    """The passages without those that lie in another one of the same two documents, on both sides."""
    span = ("start", "end", "other_start", "other_end")
    groups = found.groupBy("doc_id", "other_doc_id", *span).agg(F.max("equal_share").alias("equal_share"))
    groups = groups.groupBy("doc_id", "other_doc_id").agg(F.collect_list(F.struct(*span, "equal_share")).alias("all"))

    def inside(x, y):
        return (y["start"] <= x["start"]) & (y["end"] >= x["end"]) & (y["other_start"] <= x["other_start"]) & (y["other_end"] >= x["other_end"]) & (x != y)

    kept = F.filter("all", lambda x: ~F.exists("all", lambda y: inside(x, y)))
    rows = groups.select("doc_id", "other_doc_id", F.explode(kept).alias("s"))
    return rows.select("doc_id", "s.start", "s.end", "other_doc_id", "s.other_start", "s.other_end", "s.equal_share")


def passages(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_WORDS) -> DataFrame:
    """Passages of ``least`` words or more that a document shares with another: columns of RESULT, positions in words."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).where("id IS NOT NULL")
    common = stored(common_seeds(find_seeds(rows)), "common-seeds")
    # Repeated seeds meet in order; a document may also repeat what the hub has once.
    matches = common.select("id", "hub", "at", "other").union(
        common.where("nth_hub IS NOT NULL").select("id", "nth_hub", "at", "nth_other"))
    matches = matches.where("id <> hub")
    near = passages_of(rows, chain_matches(matches), least)
    # A window that a smaller id has too has only seeds that a smaller id has.
    shared, path = stored_at(gathered(common.where("hub < id")), "shared-places")
    windows = whole_windows(rows, common, shared, near, least) if least >= SEED + WINDOW else None
    if windows is not None:
        near = near.union(passages_of(rows, windows, least))
    pairs = paired_matches(common, shared, near, least)
    removed(docs.sparkSession, path)
    return outermost(near if pairs is None else near.union(passages_of(rows, chain_matches(pairs), least)))


@query("op5_passages")
def op5_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Every passage of 50 words or more that a document shares with the first that has it."""
    return passages(documents(spark, folder))
