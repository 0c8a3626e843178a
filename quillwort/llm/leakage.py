"""Passages of held-out texts inside a corpus: windows under an embedding of edit distance into Hamming distance."""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillwort.session import durable, spread

#: Words of a window.
WINDOW = 12
#: Windows that one index holds (some 100 MB at 32 repetitions); with more, the corpus is read once for each block of items.
INDEXED = 250_000
#: Repetitions of the search for each edit allowed.
PER_EDIT = 16
#: Windows and candidate pairs that are handled at once within a batch.
AT_ONCE = 1 << 18
_WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    """Maximal runs of letters and digits of the text in NFKC and lower case."""
    if not text:
        return []
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    found = _WORD.findall(text.lower())
    if text.isascii():
        return found
    # \w also takes numbers that are neither letters nor digits, and marks that Python counts as alphanumeric
    return [w for f in found for w in ((f,) if f.isascii() else _strict(f))]


@lru_cache(1 << 16)
def _strict(run: str) -> tuple[str, ...]:
    kept = [c if unicodedata.category(c)[0] == "L" or unicodedata.category(c) == "Nd" else " " for c in run]
    return tuple("".join(kept).split())


def edit_distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Edit distances of rows of words, all pairs of rows at once."""
    n, w = a.shape
    a, b = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
    before = [np.full(n, j, np.int16) for j in range(w + 1)]
    for i in range(w):
        now = [np.full(n, i + 1, np.int16)]
        for j in range(w):
            now.append(np.minimum(np.minimum(now[j], before[j + 1]) + np.int16(1), before[j] + (a[i] != b[j])))
        before = now
    return before[w].astype(np.int64)


def _numbers(codes: np.ndarray, n: int) -> np.ndarray:
    """A number for the run of ``n`` words that begins at each place."""
    out = np.zeros(max(0, len(codes) - n + 1), np.int64)
    for i in range(n):
        out = (out + codes[i : len(out) + i] + 1) * np.int64(0x2545F4914F6CDD1D)
        out ^= out >> 31
    return out


class WindowIndex:
    """Item windows under repeated samples of their CGK embedding.

    The embedding walks along a window with a pointer; step j writes the word under it and, by a
    random bit of (j, word), moves on or stays. Windows within a small edit distance then agree on
    most of the 3 x window steps, equal ones on all. A repetition samples steps of the walk, and
    windows that agree on a sample are candidates, whose edit distance is computed.

    Two windows within k edits keep at least window - k words in at most k + 1 runs, so they share a
    run of ``run`` words. Windows of a text without such a run of any item are not embedded; that
    loses nothing. The same runs, with their places in the item windows, are the exact way.
    """

    def __init__(self, items: list[tuple[int, list[str]]], max_edits: int, repetitions: int, sampled: int, seed: int, window: int = WINDOW):
        self.window, self.max_edits, self.sampled = window, max_edits, sampled
        self.run = -(-(window - max_edits) // (max_edits + 1))
        rng = np.random.default_rng(seed)
        self.vocabulary = {w: i + 1 for i, w in enumerate(sorted({w for _, ws in items for w in ws}))}  # 0: any other word
        self.walks = rng.integers(0, 2, (repetitions, 3 * window, len(self.vocabulary) + 2), dtype=np.int8)
        self.samples = [np.sort(rng.choice(2 * window, min(sampled, 2 * window), replace=False)) for _ in range(repetitions)]
        self.mix = rng.integers(1, 1 << 62, 3 * window, dtype=np.int64) | 1
        owners: dict[tuple[int, ...], set[int]] = defaultdict(set)
        for item, ws in items:
            ids = [self.vocabulary[w] for w in ws]
            for at in range(len(ids) - window + 1):
                owners[tuple(ids[at : at + window])].add(item)
        self.windows = np.array(list(owners), np.int32).reshape(-1, window)
        self.owners = [np.array(sorted(v), np.int64) for v in owners.values()]
        self.tables = []
        for r in range(repetitions):
            keys = self.keys(self.windows, r)
            order = np.argsort(keys, kind="stable").astype(np.int32)
            self.tables.append((keys[order], order))
        places = window - self.run + 1
        runs = np.stack([_numbers(w, self.run) for w in self.windows]).ravel() if len(self.windows) else np.empty(0, np.int64)
        order = np.argsort(runs, kind="stable")
        self.seen = np.zeros(1 << 20, bool)  # whether any run has these lowest bits; most runs of a text have none of them
        self.seen[runs & ((1 << 20) - 1)] = True
        self.runs, self.run_window, self.run_place = runs[order], (order // places).astype(np.int32), (order % places).astype(np.int32)

    def keys(self, windows: np.ndarray, repetition: int) -> np.ndarray:
        """The sampled steps of each window's walk as one number."""
        n = len(windows)
        padded = np.concatenate([windows, np.full((n, 1), len(self.vocabulary) + 1, windows.dtype)], axis=1).ravel()
        base, at, out = np.arange(n) * (self.window + 1), np.zeros(n, np.int64), np.zeros(n, np.int64)
        wanted, walk = set(self.samples[repetition].tolist()), self.walks[repetition]
        for step in range(max(wanted) + 1):
            word = padded[base + at]
            if step in wanted:
                out = (out ^ (word + 1)) * self.mix[step]
                out ^= out >> 29
            at = np.minimum(at + walk[step][word], self.window)
        return out

    def hits(self, ids: np.ndarray) -> np.ndarray:
        """Whether the run of words that begins at each place of ``ids`` stands in an item."""
        numbers = _numbers(ids, self.run)
        out = self.seen[numbers & ((1 << 20) - 1)]
        places = np.nonzero(out)[0]
        if len(places):
            at = np.searchsorted(self.runs, numbers[places])
            out[places] = self.runs[np.minimum(at, len(self.runs) - 1)] == numbers[places]
        return out

    def starts(self, ids: np.ndarray, doc: np.ndarray, hits: np.ndarray) -> np.ndarray:
        """Where windows begin that lie in one document and hold a run of an item."""
        begins = np.arange(len(ids) - self.window + 1)
        n = np.concatenate([[0], np.cumsum(hits)])
        return begins[(doc[begins] == doc[begins + self.window - 1]) & (n[begins + self.window - self.run + 1] > n[begins])]

    def _candidates(self, ids: np.ndarray, starts: np.ndarray) -> Iterator[np.ndarray]:
        """Windows that agree on a sample of the walk, as numbers of start and item window, once for all repetitions of a block."""
        for low in range(0, len(starts), AT_ONCE):
            here = starts[low : low + AT_ONCE]
            windows = ids[here[:, None] + np.arange(self.window)]
            met, size = [], 0
            for r, (keys, order) in enumerate(self.tables):
                probe = self.keys(windows, r)
                first, last = np.searchsorted(keys, probe, "left"), np.searchsorted(keys, probe, "right")
                for start, window in _spans(here, first, last, order):
                    met.append(start.astype(np.int64) * len(self.windows) + window)
                    size += len(start)
                    if size > 8 * AT_ONCE:
                        met = [np.unique(np.concatenate(met))]
                        size = len(met[0])
            if met:
                yield np.unique(np.concatenate(met))

    def _sharing(self, ids: np.ndarray, doc: np.ndarray, hits: np.ndarray) -> Iterator[np.ndarray]:
        """Likewise the windows that share a run at places no further apart than the edits allow."""
        at = np.nonzero(hits)[0]
        numbers = _numbers(ids, self.run)[at]
        first, last = np.searchsorted(self.runs, numbers, "left"), np.searchsorted(self.runs, numbers, "right")
        for place, posting in _spans(at, first, last, np.arange(len(self.runs))):
            for shift in range(-self.max_edits, self.max_edits + 1):
                start = place - self.run_place[posting] - shift
                inside = (self.run_place[posting] + shift >= 0) & (self.run_place[posting] + shift <= self.window - self.run)
                inside &= (start >= 0) & (start + self.window <= len(ids))
                inside[inside] = doc[start[inside]] == doc[start[inside] + self.window - 1]
                yield np.unique(start[inside].astype(np.int64) * len(self.windows) + self.run_window[posting[inside]])

    def search(self, ids: np.ndarray, doc: np.ndarray, exact: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, item, edits) of windows of ``ids`` within max_edits of an item's window; ``doc`` tells where documents end."""
        hits = self.hits(ids)
        found = []
        for pairs in self._sharing(ids, doc, hits) if exact else self._candidates(ids, self.starts(ids, doc, hits)):
            for low in range(0, len(pairs), AT_ONCE):
                start, other = np.divmod(pairs[low : low + AT_ONCE], len(self.windows))
                a, b = ids[start[:, None] + np.arange(self.window)], self.windows[other]
                edits = np.where((a == b).all(axis=1), 0, self.max_edits + 1)
                rest = np.nonzero(edits)[0] if self.max_edits else ()
                if len(rest):
                    edits[rest] = edit_distance(a[rest], b[rest])
                good = edits <= self.max_edits
                if good.any():
                    found.append(np.stack([start[good], other[good], edits[good]], 1))
        if not found:
            return (np.empty(0, np.int64),) * 3
        near = np.unique(np.concatenate(found), axis=0)
        n = [len(self.owners[w]) for w in near[:, 1].tolist()]
        return np.repeat(near[:, 0], n), np.concatenate([self.owners[w] for w in near[:, 1].tolist()]), np.repeat(near[:, 2], n)


def _spans(rows: np.ndarray, first: np.ndarray, last: np.ndarray, order: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each row with all entries of its span of ``order``, about ``AT_ONCE`` pairs at a time."""
    hit, at = np.nonzero(last > first)[0], 0
    while at < len(hit):
        take = max(1, int(np.searchsorted(np.cumsum((last - first)[hit[at:]]), AT_ONCE, "right")))
        own, at = hit[at : at + take], at + take
        n = (last - first)[own]
        yield np.repeat(rows[own], n), order[np.repeat(first[own], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]


def leaked_items(
    documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text",
    max_edits: int = 2, repetitions: int | None = None, sampled: int = 8, exact: bool = False, seed: int = 42,
) -> DataFrame:
    """(doc_id, item_id, edits): documents with a window of ``WINDOW`` words within ``max_edits`` edits of one of an item's.

    edits is the smallest distance found for the pair in the row. Pairs at 0 are complete: equal
    windows share the whole walk, so every repetition finds them. Those at more edits are found with
    the recall stated in the README, by ``PER_EDIT`` repetitions for each edit; with ``exact`` they are
    complete, too: candidates are then all windows that share a run of words the edits must leave.

    ``items`` is the stated query set: held-out material, read in blocks of about ``INDEXED`` words, of
    which one at a time is indexed and sent to the workers. Documents are mapped where they are,
    spread over more tasks only if few read them, and each is handled whole, whatever its length.

    Null, empty and short texts hold no window. A pair comes out once per row of the document, and
    items listed twice count once. Without items there are no pairs.
    """
    if not 0 <= max_edits < WINDOW:
        raise ValueError("max_edits from 0 to one less than the window are possible")
    spark = documents.sparkSession
    schema = f"{doc_id} long, {item_id} long, edits int"
    repetitions = repetitions or max(1, PER_EDIT * max_edits)
    texts = spread(documents.select(F.col(doc_id).cast("long"), F.col(text)))

    def search(block: list[tuple[int, list[str]]], last: bool) -> DataFrame:
        index = spark.sparkContext.broadcast(WindowIndex(block, max_edits, repetitions, sampled, seed))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: WindowIndex = index.value
            known, width = held.vocabulary, held.window
            for b in batches:
                codes: list[int] = []
                bounds = [0]
                for value in b.column(1):
                    codes.extend([known.get(w, 0) for w in words(value.as_py())])
                    bounds.append(len(codes))
                if len(codes) < width or not len(held.windows):
                    continue
                ids, ends = np.array(codes, np.int32), np.array(bounds)
                doc = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
                starts, owners, edits = held.search(ids, doc, exact)
                if len(starts):
                    triples = np.unique(np.stack([doc[starts], owners, edits], 1), axis=0)
                    first = np.concatenate([[True], (triples[1:, :2] != triples[:-1, :2]).any(axis=1)])
                    rows, own, least = triples[first].T
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array(rows)), pa.array(own, pa.int64()), pa.array(least, pa.int32())], [doc_id, item_id, "edits"]
                    )

        found = texts.mapInArrow(run, schema)
        if not last:  # written, so that the next index need not wait beside this one
            found = durable(found)
            index.unpersist()
        return found

    out, block, size = None, [], 0
    for row in items.select(item_id, text).distinct().orderBy(item_id, text).toLocalIterator():
        item = (row[0], words(row[1]))
        if size and size + len(item[1]) > INDEXED:
            part = search(block, last=False)
            out, block, size = part if out is None else out.unionByName(part), [], 0
        block.append(item)
        size += len(item[1])
    part = search(block, last=True)
    return part if out is None else out.unionByName(part)
