"""SentencePiece BPE in vectorised merge rounds.

Words are runs that no piece crosses. All new words of a batch lie in one flat array of symbols. Each round finds the
lowest pair rank of every word, merges its leftmost non-overlapping occurrences at once, and compacts the arrays; words
without a mergeable pair leave. Words that the worker has met come from a bounded cache.

Defined cases: a null or empty text has only the end id and decodes to the empty text; a null id array decodes to the
empty text; rows that repeat get equal results; an output column replaces one of the same name.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .common import WordIds, documents, gather, kept, replaced, slices, text_of, with_column
from .registry import query

SPACE = "▁"
NEVER = np.int64(1) << 40
#: Words that a worker remembers before it starts again; about 150 bytes each.
CACHE_WORDS = 600_000


class PieceModel:
    """The vocabulary of a BPE model with identity normalisation and byte fallback, as arrays.

    Symbols are the pieces, then characters that occur only inside pieces; a character that no piece holds is
    ``unknown + code point`` and never merges.
    """

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        text = [model.id_to_piece(i) for i in range(size)]
        plain = [not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
                 for i in range(size)]
        self.end = model.eos_id()
        self.byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        symbol = {t: i for i, t in enumerate(text) if plain[i]}
        self.size = size
        for char in sorted({c for t in symbol for c in t} - set(symbol)):
            symbol[char] = size + len(symbol)
        extra = {s: ord(t) for t, s in symbol.items() if s >= size}
        self.unknown = max([size - 1, *extra]) + 1
        self.extra = extra
        singles = sorted((ord(t), s) for t, s in symbol.items() if len(t) == 1)
        self.points = np.array([c for c, _ in singles], np.int64)
        self.point_symbols = np.array([s for _, s in singles], np.int64)
        scores = np.array([model.get_score(i) for i in range(size)])
        order = np.unique(-scores, return_inverse=True)[1]  # equal scores share a rank
        self.base = np.int64(self.unknown)
        pairs = {}
        for i, t in enumerate(text):
            if plain[i]:
                for cut in range(1, len(t)):
                    left, right = symbol.get(t[:cut]), symbol.get(t[cut:])
                    if left is not None and right is not None:
                        pairs[left * int(self.base) + right] = i
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_piece = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)
        self.pair_rank = order[self.pair_piece].astype(np.int64)
        self._fill_table()
        inner = {c for t, ok in zip(text, plain) if ok and len(t) > 1 for c in t}
        if any(SPACE in t.lstrip(SPACE) for t, ok in zip(text, plain) if ok):
            raise ValueError("pieces with a space after other characters are not supported")
        alone = "" if "\n" in inner else "\n"
        self.words = re.compile(f"{alone or '(?!)'}| *[^ {alone}]+| +")
        surface = [t.replace(SPACE, " ").encode() if plain[i] else b"" for i, t in enumerate(text)]
        for b, i in enumerate(self.byte_ids.tolist()):
            surface[i] = bytes([b])
        surface[model.unk_id()] = " ⁇ ".encode()
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.surface_size = np.array([len(s) for s in surface], np.int64)
        self.surface_start = np.cumsum(self.surface_size) - self.surface_size
        self.spaced = np.array([ok and t.startswith(SPACE) for t, ok in zip(text, plain)])
        self.silent = np.array([model.is_control(i) for i in range(size)])

    def _fill_table(self) -> None:
        """Pairs in a table with linear probing, about a quarter full, so that most lookups touch one slot."""
        bits = max(4, int(np.ceil(np.log2(4 * len(self.pair_keys) + 1))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slots = np.full(1 << bits, -1, np.int64)
        self.slot_pair = np.zeros(1 << bits, np.int64)
        todo = np.arange(len(self.pair_keys))
        slot = self._slot(self.pair_keys)
        while len(todo):
            free = self.slots[slot] < 0
            winner = np.unique(np.where(free, slot, -1 - np.arange(len(slot))), return_index=True)[1]
            winner = winner[free[winner]]
            self.slots[slot[winner]] = self.pair_keys[todo[winner]]
            self.slot_pair[slot[winner]] = todo[winner]
            rest = np.ones(len(todo), bool)
            rest[winner] = False
            todo, slot = todo[rest], (slot[rest] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged piece of each pair of symbols; ``NEVER`` where no piece joins them."""
        key = np.where((left < self.base) & (right < self.base), left * self.base + right, np.int64(-2))
        slot = self._slot(key)
        there = self.slots[slot]
        open_ = np.flatnonzero((there != key) & (there >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self.mask
            there[open_] = self.slots[slot[open_]]
            open_ = open_[(there[open_] != key[open_]) & (there[open_] >= 0)]
        pair = self.slot_pair[slot]
        return np.where(there == key, self.pair_rank[pair], NEVER), self.pair_piece[pair]

    def symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all words in a row, and the word of each."""
        points = np.frombuffer("".join(words).replace(" ", SPACE).encode("utf-32-le"), np.uint32).astype(np.int64)
        at = np.minimum(np.searchsorted(self.points, points), len(self.points) - 1)
        symbols = np.where(self.points[at] == points, self.point_symbols[at], self.unknown + points)
        return symbols, np.repeat(np.arange(len(words)), [len(w) for w in words])

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and the number of ids of each word."""
        symbols, owner = self.symbols(words)
        done_symbols, done_owner = [], []
        while len(symbols):
            rank, piece = self.ranks(symbols[:-1], symbols[1:])
            rank = np.append(np.where(owner[:-1] == owner[1:], rank, NEVER), NEVER)
            start = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            length = np.diff(np.append(start, len(symbols)))
            best = np.minimum.reduceat(rank, start)
            best_of = np.repeat(best, length)
            over = best_of == NEVER
            if over.any():
                done_symbols.append(symbols[over])
                done_owner.append(owner[over])
                keep = ~over
                symbols, owner, rank, best_of = symbols[keep], owner[keep], rank[keep], best_of[keep]
                piece = np.append(piece, 0)[keep][:-1]
                if not len(symbols):
                    break
            hit = rank == best_of
            place = np.arange(len(hit))
            first = hit & ~np.append(False, hit[:-1])
            run = np.maximum.accumulate(np.where(first, place, 0))
            take = hit & ((place - run) % 2 == 0)
            take = self._in_turn(symbols, owner, piece, best_of, take)
            left = np.flatnonzero(take)
            symbols[left] = piece[left]
            keep = np.ones(len(symbols), bool)
            keep[left + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        symbols, owner = np.concatenate(done_symbols or [symbols]), np.concatenate(done_owner or [owner])
        order = np.argsort(owner, kind="stable")
        return self._with_bytes(symbols[order], owner[order], len(words))

    def _in_turn(self, symbols, owner, piece, best_of, take) -> np.ndarray:
        """Merges that may happen at once: in a word where one merge opens a pair of no higher rank, only the leftmost."""
        at = np.flatnonzero(take)
        several = np.append(owner[at][1:] == owner[at][:-1], False)
        several[1:] |= several[:-1].copy()
        at = at[several]
        if not len(at):
            return take
        merged = piece[at]
        last = len(symbols) - 1
        after, before = np.minimum(at + 2, last), np.maximum(at - 1, 0)
        right_ok = (at + 2 <= last) & (owner[after] == owner[at])
        left_ok = (at >= 1) & (owner[before] == owner[at])
        chained = np.append(False, (at[1:] == at[:-1] + 2) & (owner[at][1:] == owner[at][:-1]))
        previous = np.where(chained, np.append(0, merged[:-1]), symbols[before])
        opened = np.minimum(np.where(right_ok, self.ranks(merged, symbols[after])[0], NEVER),
                            np.where(left_ok, self.ranks(previous, merged)[0], NEVER))
        chained_next = np.append(chained[1:], False)
        both = self.ranks(merged, np.append(merged[1:], 0))[0]
        opened = np.minimum(opened, np.where(chained_next, both, NEVER))
        clash = np.unique(owner[at][opened <= best_of[at]])
        if len(clash):
            late = np.append(False, owner[at][1:] == owner[at][:-1]) & np.isin(owner[at], clash)
            take[at[late]] = False
        return take

    def _with_bytes(self, symbols, owner, words: int) -> tuple[np.ndarray, np.ndarray]:
        """Symbols outside the vocabulary become the ids of their UTF-8 bytes."""
        odd = np.flatnonzero(symbols >= self.size)
        width = np.ones(len(symbols), np.int64)
        if len(odd):
            points = np.array([self.extra[s] if s in self.extra else s - self.unknown for s in symbols[odd].tolist()], np.int64)
            width[odd] = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        ids = np.repeat(symbols, width).astype(np.int32)
        if len(odd):
            first = (np.cumsum(width) - width)[odd]
            data = "".join(map(chr, points.tolist())).encode()
            raw = self.byte_ids[np.frombuffer(data, np.uint8)]
            size = width[odd]
            inside = np.arange(len(raw)) - np.repeat(np.cumsum(size) - size, size)
            ids[np.repeat(first, size) + inside] = raw
        return ids, np.bincount(np.repeat(owner, width), minlength=words)


class Encoder:
    """Encodes texts through a cache of words; new words of a batch are merged together."""

    def __init__(self, model: PieceModel, limit: int = CACHE_WORDS):
        self.model = model
        self.words = WordIds(model.merge, limit)

    def encode(self, texts: list[str], end: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the texts, and the bounds of each text in them."""
        find = self.model.words.findall
        words = [find(" " + t.replace(SPACE, " ")) if t else [] for t in texts]
        return self.words.flat(words, self.model.end if end else None)


def decode_ids(model: PieceModel, flat: np.ndarray, bounds: np.ndarray) -> list[str]:
    """The text of each id sequence; the space that stands before the first piece is dropped."""
    size = model.surface_size[flat]
    data = gather(model.surface, model.surface_start[flat], size).tobytes()
    ends = np.append(0, np.cumsum(size))
    loud = np.flatnonzero(~model.silent[flat])
    texts = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        at = np.searchsorted(loud, a)
        skip = at < len(loud) and loud[at] < b and model.spaced[flat[loud[at]]]
        texts.append(data[ends[a] + int(skip):ends[b]].decode("utf-8", "replace"))
    return texts


def encode(docs: DataFrame, model_path: str, text: str = "text", out: str = "ids", end: bool = True) -> DataFrame:
    """The rows with the ids of their texts in ``out``; ``end`` adds the end id."""
    def work(batches):
        encoder = kept(f"pieces:{model_path}", lambda: Encoder(PieceModel(model_path)))
        for batch in batches:
            for part, texts in slices(batch, text):
                flat, bounds = encoder.encode(texts, end)
                yield replaced(part, **{out: pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat, pa.int32()))})

    return docs.mapInArrow(work, with_column(docs.schema, T.StructField(out, T.ArrayType(T.IntegerType()))))


def decode(docs: DataFrame, model_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """The rows with the text of their ids in ``out``."""
    def work(batches):
        model = PieceModel(model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                column = part.column(ids)
                sizes = np.array([0 if n is None else n for n in pa.compute.list_value_length(column).to_pylist()], np.int64)
                flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.int64)
                texts = decode_ids(model, flat, np.append(0, np.cumsum(sizes)))
                yield replaced(part, **{out: pa.array(texts, pa.string())})

    return docs.mapInArrow(work, with_column(docs.schema, T.StructField(out, T.StringType())))


@query("op1_sentencepiece")
def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded and decoded again, as digests."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = documents(spark, folder).select("doc_id", text_of().alias("text"))
    ids = encode(docs, path).drop("text")
    back = decode(ids, path)
    return back.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
