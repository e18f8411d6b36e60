"""Texts to ids by the tokenizers library, through a cache of chunks.

A chunk is white space and the word after it. Neither normalisation nor pre-tokenisation of the supported files (byte
level and word level BPE) crosses from a word to the white space behind it, so the ids of a text are those of its
chunks in a row. Only chunks that the worker hasn't met are given to the library.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np

from .common import WordIds, kept

#: The characters with the Unicode property White_Space.
WHITE = "\t-\r \x85\xa0  -     　"
CHUNK = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
#: Which code points are white, up to the last that is; others are not.
IS_WHITE = np.zeros(0x3002, bool)
IS_WHITE[[ord(c) for c in map(chr, range(0x3001)) if re.fullmatch(f"[{WHITE}]", c)]] = True
#: Characters whose chunks are hashed in one pass, about.
PASS_CHARS = 60_000
#: Chunks that a worker remembers before it starts again; about 150 bytes each.
CACHE_CHUNKS = 1_200_000
#: New chunks that go to the library in one string.
JOINED = 256
#: Stands between chunks in such a string: white space and a word of one token, which comes from this character only.
BAR = " |"
#: Chunks that neither join with the bar before them nor with the white space behind them.
APART = re.compile(f"(?:[\t-\r ][{WHITE}]*|[A-Za-z])[^{WHITE}]*[^{WHITE}|]")


def numbers() -> tuple[np.ndarray, np.ndarray]:
    """A number for each code point, and an odd one for each place in a chunk (places beyond start again)."""
    value = np.arange(0x110000, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        value = (value ^ (value >> np.uint64(shift))) * np.uint64(factor)
    value ^= value >> np.uint64(31)
    return value, value[:4096] | np.uint64(1)


def split(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray] | None:
    """The distinct chunks of the texts, which of them stand in the texts, in a row, and how many each text has.

    Chunks are told apart by a hash, and each is then compared with the first of its hash; None if one differs.
    """
    whole = "".join(texts)
    points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), "<u4")
    bounds = np.cumsum([0, *map(len, texts)])
    if not len(points):
        return [], np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
    white = IS_WHITE[np.minimum(points, len(IS_WHITE) - 1)]
    begins = white.copy()
    begins[1:] &= ~white[:-1]
    begins[bounds[:-1][bounds[:-1] < len(points)]] = True
    start = np.flatnonzero(begins)
    size = np.diff(start, append=len(points))
    cuts = np.unique(np.append(np.searchsorted(start, np.arange(0, len(points), PASS_CHARS)), len(start))).tolist()
    cuts = [(i, j, int(start[i]), int(start[j - 1] + size[j - 1])) for i, j in zip(cuts[:-1], cuts[1:])]
    value, weight = kept("chunk numbers", numbers)
    found = size.astype(np.uint64)
    for i, j, lo, hi in cuts:
        place = np.arange(lo, hi) - np.repeat(start[i:j], size[i:j])
        found[i:j] += np.add.reduceat(value[points[lo:hi]] * weight[place & (len(weight) - 1)], start[i:j] - lo)
    _, first, which = np.unique(found, return_index=True, return_inverse=True)
    if (size[first][which] != size).any():
        return None
    away = start[first][which] - start
    for i, j, lo, hi in cuts:
        if (points[lo:hi] != points[np.arange(lo, hi) + np.repeat(away[i:j], size[i:j])]).any():
            return None
    chunks = [whole[a:b] for a, b in zip(start[first].tolist(), (start + size)[first].tolist())]
    return chunks, which.astype(np.int32), np.diff(np.searchsorted(start, bounds))


def text_encoder(path: str, end: int | None = None, limit: int = CACHE_CHUNKS) -> "TextEncoder":
    """The worker's encoder for a tokenizer file, which remembers ``limit`` chunks."""
    return kept(f"tokens:{path}:{end}:{limit}", lambda: TextEncoder(path, end, limit))


class TextEncoder:
    """Encodes lists of texts to flat ids, an end id after each text if one is given."""

    def __init__(self, path: str, end: int | None = None, limit: int = CACHE_CHUNKS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.end = end
        self.words = WordIds(self._learn, limit)
        special = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special}
        # Text between special tokens is encoded by itself: many chunks can go in one string with one between them.
        self.mark_id, self.mark = max(special.items(), default=(None, None))
        self.special = tuple(special.values())
        bar = self.tokenizer.encode(BAR, add_special_tokens=False).ids
        self.bar_id = bar[0] if len(bar) == 1 else None

    def _joined(self, group: list[str], between: str, number: int) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of the chunks and how many each has, encoded as one string; None if they can't be told apart."""
        found = np.array(self.tokenizer.encode_batch_fast([between.join(group)], add_special_tokens=False)[0].ids, np.int32)
        ends = np.append(np.flatnonzero(found == number), len(found))
        return (found[found != number], np.diff(np.append(-1, ends)) - 1) if len(ends) == len(group) else None

    def _learn(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, count = [], np.zeros(len(chunks), np.int64)
        for at in range(0, len(chunks), JOINED):
            group = chunks[at:at + JOINED]
            text, found = "\0".join(group), None
            if not any(t in text for t in self.special):
                # The bar costs the library less than a special token.
                if self.bar_id is not None and "|" not in text and all(map(APART.fullmatch, group)):
                    found = self._joined(group, BAR, self.bar_id)
                elif self.mark is not None:
                    found = self._joined(group, self.mark, self.mark_id)
            if found is None:
                each = [e.ids for e in self.tokenizer.encode_batch_fast(group, add_special_tokens=False)]
                found = np.fromiter(chain.from_iterable(each), np.int32), np.fromiter(map(len, each), np.int64, len(each))
            ids.append(found[0])
            count[at:at + len(group)] = found[1]
        return np.concatenate(ids), count

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the texts, and the bounds of each text in them."""
        found = split(texts)
        if found is None:
            return self.words.flat([CHUNK.findall(t) for t in texts], self.end)
        return self.words.numbered(*found, self.end)
