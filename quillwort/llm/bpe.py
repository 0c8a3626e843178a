"""Byte-level BPE over padded numpy matrices."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillwort.session import spread

#: Fixed value: the pattern that cuts a text into the pieces within which bytes are merged.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Where the public vocabularies are found unless another path is given.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Pieces of up to so many bytes are merged in matrices of that width; longer ones one by one.
WIDTHS = (4, 8, 12, 16, 24, 32, 64, 128)
#: Pieces whose ids a worker keeps; then it starts anew. Only speed depends on it.
CACHED = 100_000
#: Rows of a matrix at most, and characters of text turned into ids at once at most (a longer text is alone).
ROWS, CHARS = 1 << 14, 1 << 21

_NONE = np.int64(1 << 40)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file with a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class PairTable:
    """From a pair of ids to the id of the merged token: open addressing in two arrays."""

    def __init__(self, ranks: dict[bytes, int]):
        left, right, to = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    to.append(rank)
        wanted = np.array(left, np.int64) << 32 | np.array(right, np.int64)
        self.bits = max(4, int(2 * len(wanted) + 1).bit_length() + 1)
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ids = np.full(1 << self.bits, _NONE, np.int64)
        ids, place = np.array(to, np.int64), self._place(wanted)
        self.longest = 0
        while len(wanted):
            free = self.keys[place] == -1
            _, first = np.unique(place[free], return_index=True)
            put = np.nonzero(free)[0][first]
            self.keys[place[put]], self.ids[place[put]] = wanted[put], ids[put]
            left_over = np.ones(len(wanted), bool)
            left_over[put] = False
            wanted, ids, place = wanted[left_over], ids[left_over], (place[left_over] + 1) & ((1 << self.bits) - 1)
            self.longest += 1

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merged id of each pair, or a number above all ids where there is none (or an end is negative)."""
        keys = left << 32 | (right & 0xFFFFFFFF)
        place = self._place(keys)
        held = self.keys[place]
        out = np.where(held == keys, self.ids[place], _NONE)
        todo = np.nonzero((held != keys) & (held != -1))[0]
        for _ in range(self.longest):
            if not len(todo):
                break
            place[todo] = (place[todo] + 1) & ((1 << self.bits) - 1)
            held = self.keys[place[todo]]
            hit = held == keys[todo]
            out[todo[hit]] = self.ids[place[todo[hit]]]
            todo = todo[~hit & (held != -1)]
        out[(left < 0) | (right < 0)] = _NONE
        return out


class BytePairEncoder:
    """Texts to ids of a byte-level vocabulary, without special tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PIECES):
        self.pairs, self.pattern = PairTable(ranks), regex.compile(pattern)
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.whole = ranks
        self.cache: dict[str, tuple[int, ...]] = {}

    def _merge_rows(self, ids: np.ndarray) -> np.ndarray:
        """Merge a matrix of ids, padded with -1: in each round every row merges its leftmost pair of lowest rank."""
        done = np.full_like(ids, -1)
        rows = np.arange(len(ids))
        n, width = ids.shape
        merged = self.pairs.find(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
        while len(rows):
            at = merged.argmin(axis=1)
            best = merged[np.arange(len(rows)), at]
            ended = best == _NONE
            if ended.any():
                done[rows[ended], : ids.shape[1]] = ids[ended]
                go = ~ended
                rows, ids, merged, at, best = rows[go], ids[go], merged[go], at[go], best[go]
                if not len(rows):
                    break
            # compaction: each row closes the gap to the right of its merge, and the matrix loses the column
            columns = np.arange(ids.shape[1] - 1)
            source = columns + (columns > at[:, None])
            ids = np.take_along_axis(ids, source, 1)
            line = np.arange(len(rows))
            ids[line, at] = best
            if ids.shape[1] == 1:
                done[rows, :1] = ids
                break
            columns = columns[:-1]
            merged = np.take_along_axis(merged, columns + (columns >= at[:, None]), 1)
            for shift in (-1, 0):
                place = at + shift
                ok = (place >= 0) & (place < merged.shape[1])
                i, p = line[ok], place[ok]
                merged[i, p] = self.pairs.find(ids[i, p], ids[i, p + 1])
        return done

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same merges for one long piece, with a heap of pairs over a linked list."""
        n = len(ids)
        following, previous, version = [*range(1, n), -1], [-1, *range(n - 1)], [0] * n
        keys = np.array(ids, np.int64)
        heap = [(int(m), i, 0, 0) for i, m in enumerate(self.pairs.find(keys[:-1], keys[1:])) if m < _NONE]
        heap.sort()

        def offer(i: int) -> None:
            j = following[i]
            if j >= 0:
                m = int(self.pairs.find(np.array([ids[i]], np.int64), np.array([ids[j]], np.int64))[0])
                if m < _NONE:
                    heappush(heap, (m, i, version[i], version[j]))

        while heap:
            m, i, mine, other = heappop(heap)
            j = following[i]
            if version[i] != mine or j < 0 or version[j] != other:
                continue
            ids[i] = m
            version[i] += 1
            version[j] = -1
            following[i] = following[j]
            if following[j] >= 0:
                previous[following[j]] = i
            offer(i)
            if previous[i] >= 0:
                offer(previous[i])
        return [x for x, v in zip(ids, version, strict=True) if v >= 0]

    def encode_pieces(self, pieces: list[str]) -> list[tuple[int, ...]]:
        """The ids of distinct pieces, merged in matrices by length."""
        out: list[tuple[int, ...]] = [()] * len(pieces)
        by_width: dict[int, list[int]] = {}
        coded = [p.encode() for p in pieces]
        for k, b in enumerate(coded):
            if b in self.whole:
                out[k] = (self.whole[b],)
            else:
                by_width.setdefault(next((w for w in WIDTHS if w >= len(b)), 0), []).append(k)
        for width, ks in by_width.items():
            if not width:
                for k in ks:
                    out[k] = tuple(self._merge_long(self.bytes[np.frombuffer(coded[k], np.uint8)].tolist()))
                continue
            for start in range(0, len(ks), ROWS):
                part = ks[start : start + ROWS]
                lengths = np.array([len(coded[k]) for k in part])
                matrix = np.full((len(part), width), -1, np.int64)
                flat = np.frombuffer(b"".join(coded[k] for k in part), np.uint8)
                matrix[np.arange(width) < lengths[:, None]] = self.bytes[flat]
                merged = self._merge_rows(matrix)
                counts = (merged >= 0).sum(axis=1)
                ids, ends = merged[merged >= 0].tolist(), np.cumsum(counts).tolist()
                begin = 0
                for k, end in zip(part, ends, strict=True):
                    out[k] = tuple(ids[begin:end])
                    begin = end
        return out

    def encode_batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and the offsets at which each text's begin. Null and empty texts have no ids."""
        pieces = [self.pattern.findall(t) if t else [] for t in texts]
        new = list({p for ps in pieces for p in ps}.difference(self.cache))
        if len(self.cache) + len(new) > CACHED:
            self.cache = {}
            new = list({p for ps in pieces for p in ps})
        self.cache.update(zip(new, self.encode_pieces(new), strict=True))
        known = self.cache
        counts, ids = [0], []
        for ps in pieces:
            for p in ps:
                ids.extend(known[p])
            counts.append(len(ids))
        return np.array(ids, np.int32), np.array(counts, np.int64)


def encode(documents: DataFrame, doc_id: str, text: str, vocabulary: str = VOCABULARY, out: str = "ids") -> DataFrame:
    """(doc_id, ids): the ids of each text, without special tokens.

    The vocabulary is read once by the driver and sent to the workers (its size is that of a file
    of tens of thousands of tokens). Null and empty texts have an empty list of ids; strings that
    look like special tokens are ordinary text. Every row gives a row, repeated ones too. Texts are taken in slices of bounded size whatever the batch.
    """
    spark = documents.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(vocabulary))

    def slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
        begin = size = 0
        for i, t in enumerate(texts):
            n = len(t) if t else 0
            if size and size + n > CHARS:
                yield begin, i
                begin, size = i, 0
            size += n
        yield begin, len(texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for b in batches:
            if not b.num_rows:
                continue
            encoder = encoder or BytePairEncoder(ranks.value)
            texts = b.column(1).to_pylist()
            for begin, end in slices(texts):
                ids, offsets = encoder.encode_batch(texts[begin:end])
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(begin, end - begin), lists], [doc_id, out])

    return spread(documents.select(F.col(doc_id).cast("long"), F.col(text))).mapInArrow(run, f"{doc_id} long, {out} array<int>")
