"""Encoding texts with a public byte-level BPE vocabulary.

Two tiers resolve the pre-tokens of a text. A minimal perfect hash (hash and displace) over the byte
strings of the vocabulary turns a whole pre-token that is itself a vocabulary entry into its id with
two probes and one comparison, in array operations over a batch's distinct pre-tokens. The others are
merged from their bytes: a doubly linked list of parts and a heap of mergeable pairs by rank, so that a
pre-token of n bytes costs O(n log n) whatever its length.

The vocabulary file is a parameter. Its tables are built once by the driver and broadcast; their size is
that of the vocabulary file, a few MB, whatever the data. Encoding is a map over Arrow batches without
any shuffle; a worker remembers resolved pre-tokens up to a bounded number.
"""

from __future__ import annotations

import base64
import heapq
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the public tokenizer files lie, unless the caller or the environment says otherwise.
DEFAULT_DIR = "/opt/tokenizers"
NAME = "byte_bpe_50k"
#: Fixed value: the vocabulary's published pattern that splits text before the merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Resolved pre-tokens that a worker remembers at most.
MEMORY = 200_000


def vocabulary_path(name: str = NAME, folder: str | None = None) -> str:
    return os.path.join(folder or os.environ.get("SPOREFRAME_TOKENIZERS", DEFAULT_DIR), f"{name}.tiktoken")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class PerfectHash:
    """Minimal perfect hash of byte strings to slots 0..n-1 (hash and displace)."""

    LOAD = 4

    def __init__(self, keys: list[bytes]):
        n = len(keys)
        self.n, self.buckets = n, max(1, n // self.LOAD)
        h = self.hashes(keys)
        bucket = (h % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        starts = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        self.shift = np.zeros(self.buckets, np.int64)
        taken = np.zeros(n, bool)
        slots = np.zeros(n, np.int64)
        sizes = starts[1:] - starts[:-1]
        tries = np.arange(256)
        free = None
        for b in np.argsort(-sizes, kind="stable").tolist():
            mine = order[starts[b] : starts[b + 1]]
            if len(mine) == 0:
                break
            if len(mine) == 1:
                # the rest of the slots, one each
                if free is None:
                    free = iter(np.flatnonzero(~taken).tolist())
                at = np.array([next(free)])
                self.shift[b] = -int(at[0]) - 1
            else:
                d = 0
                while True:
                    grid = np.sort(self._mix(h[mine][:, None], tries[None, :] + d), axis=0)
                    good = ~taken[grid].any(axis=0) & (np.diff(grid, axis=0) > 0).all(axis=0)
                    if good.any():
                        d += int(np.argmax(good))
                        break
                    d += len(tries)
                self.shift[b] = d
                at = self._mix(h[mine], np.int64(d))
            taken[at] = True
            slots[mine] = at
        self.slots = slots

    @staticmethod
    def hashes(keys: list[bytes]) -> np.ndarray:
        return np.fromiter((xxhash.xxh64_intdigest(k) for k in keys), np.uint64, len(keys))

    def _mix(self, h: np.ndarray, d) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = (h ^ (np.uint64(0x9E3779B97F4A7C15) * (np.asarray(d).astype(np.uint64) + np.uint64(1)))) * np.uint64(0xBF58476D1CE4E5B9)
            x ^= x >> np.uint64(29)
            x *= np.uint64(0x94D049BB133111EB)
            x ^= x >> np.uint64(32)
        return (x % np.uint64(self.n)).astype(np.int64)

    def find(self, keys: list[bytes]) -> np.ndarray:
        """The slot at which each key would be; whether it is there is the caller's comparison."""
        h = self.hashes(keys)
        d = self.shift[(h % np.uint64(self.buckets)).astype(np.int64)]
        return np.where(d < 0, -d - 1, self._mix(h, d))


class Encoder:
    """Texts to token ids. Pickles to its tables."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.ranks, self.pattern = ranks, pattern
        words = list(ranks)
        self.hash = PerfectHash(words)
        self.keys: list[bytes] = [b""] * len(words)
        self.ids = np.zeros(len(words), np.int32)
        for w, s in zip(words, self.hash.slots.tolist()):
            self.keys[s] = w
            self.ids[s] = ranks[w]
        del self.hash.slots
        self._known: dict[str, list[int]] = {}

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("_known", "_find")}

    def __setstate__(self, state):
        self.__dict__ |= state
        self._known = {}

    def split(self, text: str) -> list[str]:
        f = self.__dict__.get("_find")
        if f is None:
            f = self._find = regex.compile(self.pattern).findall
        return f(text)

    def merge(self, word: bytes) -> list[int]:
        """The ids of one pre-token: pairs merge by lowest rank, leftmost first."""
        ranks, n = self.ranks, len(word)
        end = list(range(1, n + 1))  # of the part that begins at i
        nxt, prev = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, e = heapq.heappop(heap)
            j = nxt[i] if alive[i] else n
            if j >= n or end[j] != e:
                continue  # one of the two parts has changed
            alive[j] = False
            end[i], k = e, nxt[j]
            nxt[i] = k
            if k < n:
                prev[k] = i
                if (r := ranks.get(word[i : end[k]])) is not None:
                    heapq.heappush(heap, (r, i, end[k]))
            if (p := prev[i]) >= 0 and (r := ranks.get(word[p:e])) is not None:
                heapq.heappush(heap, (r, p, e))
        out, i = [], 0
        while i < n:
            out.append(ranks[word[i : end[i]]])
            i = nxt[i]
        return out

    def _learn(self, new: list[str]) -> None:
        raw = [w.encode() for w in new]
        at = self.hash.find(raw)
        for w, b, s, i in zip(new, raw, at.tolist(), self.ids[at].tolist()):
            self._known[w] = [i] if self.keys[s] == b else self.merge(b)

    def batch(self, texts: list[str | None]) -> list[list[int]]:
        """Null and empty texts have no ids."""
        parts = [self.split(t) if t else [] for t in texts]
        known = self._known
        if len(known) > MEMORY:
            known.clear()
        if new := [w for w in {w for p in parts for w in p} if w not in known]:
            self._learn(new)
        out = []
        for p in parts:
            ids: list[int] = []
            for w in p:
                ids += known[w]
            out.append(ids)
        return out


@lru_cache(4)
def encoder(path: str) -> Encoder:
    return Encoder(read_ranks(path))


#: Characters of text that a worker encodes at once.
CHUNK = 4_000_000


def _chunks(texts: list[str | None]) -> Iterator[list[str | None]]:
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= CHUNK:
            yield texts[at : i + 1]
            at, size = i + 1, 0
    if at < len(texts):
        yield texts[at:]


def _run(df: DataFrame, key: str, text: str, path: str | None, counts: bool) -> DataFrame:
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(encoder(path or vocabulary_path()))
    kind = dict(df.dtypes)[key]

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = shared.value
        for b in batches:
            keys, at = b.column(0), 0
            for texts in _chunks(b.column(1).to_pylist()):
                got = enc.batch(texts)
                lengths = np.fromiter(map(len, got), np.int32, len(got))
                if counts:
                    values = pa.array(lengths, pa.int32())
                else:
                    offsets = np.zeros(len(got) + 1, np.int32)
                    np.cumsum(lengths, out=offsets[1:])
                    flat = np.fromiter((i for x in got for i in x), np.int32, int(offsets[-1]))
                    values = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([keys.slice(at, len(got)), values], names=[key, "n" if counts else "ids"])
                at += len(got)

    return df.select(key, F.col(text).cast("string").alias("_t")).mapInArrow(ids, f"`{key}` {kind}, " + ("n int" if counts else "ids array<int>"))


def encode(df: DataFrame, key: str, text: str, path: str | None = None) -> DataFrame:
    """``(key, ids)`` for every row, without special tokens; their strings in a text are ordinary text.

    Null and empty texts have an empty list. Rows stay as they are: repeated rows come out repeated, null
    keys stay null, other columns don't matter, an empty table gives no rows, texts of any length are
    encoded whole.
    """
    return _run(df, key, text, path, False)


def token_counts(df: DataFrame, key: str, text: str, path: str | None = None) -> DataFrame:
    """``(key, n)``: the number of ids that ``encode`` gives."""
    return _run(df, key, text, path, True)
