"""Problem 9: evaluation texts inside the corpus, by greedy string tiling.

Shared seeds come first: every run of ``MIN_RUN`` words of a test item is hashed, and a rolling
Karp-Rabin hash over each document's words is looked up among them. Where seeds meet, maximal
matches are grown and marked greedily, longest first, without overlap (running Karp-Rabin greedy
string tiling). The share of the item that tiles cover is the threshold; it catches reordered
passages too. Pairs that pass go to an exact check whether one passage of the document holds enough
of the item in the item's own order. Greedy tiles are not always the best ones, so a pair whose
tiles fall short passes too if the words in any match are enough.

The items are the stated query set: they go to every task in blocks of bounded size, and each
document is read once per block. No pair of documents is ever formed.
"""

from __future__ import annotations

import heapq
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import words
from millrace.session import spread

MIN_RUN = 10
COVERAGE = 0.45
SPAN = 1.5
#: Items and characters of items a task holds at once; more are worked through block by block.
BLOCK, BLOCK_CHARS = 20_000, 50_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)

RESULT = "doc_id long, item_id long, coverage double, n_tiles int, in_order double"


def rolling(ids: np.ndarray) -> np.ndarray:
    """Hash of every run of MIN_RUN ids."""
    n = len(ids) - MIN_RUN + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(MIN_RUN):
            h = h * _BASE + ids[k : k + n]
            h ^= h >> np.uint64(29)
    return h


class Items:
    """Test items as word ids with an index of their seeds."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids: dict[str, int] = {}
        self.words: dict[int, np.ndarray] = {}
        hashes, owner, at = [], [], []
        for item, text in items:
            ws = words(text or "")
            if len(ws) < MIN_RUN:
                continue
            a = np.array([self.ids.setdefault(w, len(self.ids) + 1) for w in ws], np.uint64)
            self.words[item] = a
            h = rolling(a)
            hashes.append(h)
            owner.append(np.full(len(h), item))
            at.append(np.arange(len(h)))
        empty = np.empty(0, np.int64)
        h, o, p = (np.concatenate(x) if x else empty for x in (hashes, owner, at))
        order = np.argsort(h, kind="stable")
        self.hash, self.owner, self.at = h[order].astype(np.uint64), o[order], p[order]

    def seeds(self, ids: np.ndarray) -> dict[int, np.ndarray]:
        """item -> rows (document position, item position) of the shared runs."""
        if len(ids) < MIN_RUN or not len(self.hash):
            return {}
        # a run needs MIN_RUN known words; most documents end here
        known = np.concatenate(([0], np.cumsum(ids > 0)))
        full = np.flatnonzero(known[MIN_RUN:] - known[:-MIN_RUN] == MIN_RUN)
        if not len(full):
            return {}
        h = rolling(ids)[full]
        a, b = np.searchsorted(self.hash, h, "left"), np.searchsorted(self.hash, h, "right")
        met = np.flatnonzero(b > a)
        if not len(met):
            return {}
        n = (b - a)[met]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        j = np.repeat(a[met], n) + within
        d, item, p = np.repeat(full[met], n), self.owner[j], self.at[j]
        out = {}
        for one in np.unique(item):
            here = item == one
            pairs = np.stack([d[here], p[here]], 1)
            same = np.ones(len(pairs), bool)
            for k in range(MIN_RUN):  # equal hashes may still be other words
                same &= ids[pairs[:, 0] + k] == self.words[int(one)][pairs[:, 1] + k]
            if same.any():
                out[int(one)] = pairs[same]
        return out


def matches(seeds: np.ndarray) -> list[tuple[int, int, int]]:
    """Maximal matches (document start, item start, length), from seeds: seeds in a row on one diagonal are one match."""
    d, p = np.asarray(seeds, np.int64).reshape(-1, 2).T
    order = np.lexsort((d, d - p))
    d, p = d[order], p[order]
    if not len(d):
        return []
    starts = np.flatnonzero(np.concatenate(([True], (np.diff(d - p) != 0) | (np.diff(d) != 1))))
    runs = np.diff(np.append(starts, len(d)))
    return list(zip(d[starts].tolist(), p[starts].tolist(), (runs + MIN_RUN - 1).tolist(), strict=True))


def tile(found: list[tuple[int, int, int]], n_item: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: again and again the longest match none of whose words is marked."""
    if not found:
        return []
    begin = min(d for d, _, _ in found)
    free_doc, free_item = np.ones(max(d + n for d, _, n in found) - begin, bool), np.ones(n_item, bool)
    tiles, heap = [], [(-n, d, p) for d, p, n in found]
    heapq.heapify(heap)
    left = n_item
    while heap and left >= MIN_RUN:
        n, d, p = heapq.heappop(heap)
        n = -n
        free = free_item[p : p + n] & free_doc[d - begin : d - begin + n]
        if free.all():
            tiles.append((d, p, n))
            free_item[p : p + n] = free_doc[d - begin : d - begin + n] = False
            left -= n
            continue
        # what is left of it comes back as shorter matches, in their place
        edge = np.flatnonzero(np.diff(np.concatenate(([False], free, [False])).astype(np.int8)))
        for k, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if e - k >= MIN_RUN:
                heapq.heappush(heap, (k - e, d + k, p + k))
    return tiles


class Passages:
    """How much of an item any one passage of a document holds, by dynamic programming over the words they share."""

    def __init__(self, found: np.ndarray, n_item: int, width: int):
        self.n, self.width = n_item, width
        length = found[:, 2]
        k = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        row, col = np.repeat(found[:, 0], length) + k, np.repeat(found[:, 1], length) + k
        order = np.lexsort((col, row))
        row, self.col, self.run = row[order], col[order], np.minimum(k[order] + 1, MIN_RUN)
        self.rows, self.first = np.unique(row, return_index=True)
        self.last = np.append(self.first[1:], len(row))

    def held(self, start: int) -> int:
        """Most item words, in order and in runs of MIN_RUN or more, in the passage from ``start``.

        ``ends[j]`` is the best sum whose last run ends with item word j in this row, ``best[j]`` the
        best sum over all rows so far and item words before j. Each row extends the runs of the row
        before or begins one MIN_RUN words back.
        """
        a, b = np.searchsorted(self.rows, (start, start + self.width))
        best = np.zeros(self.n + 1, np.int64)
        kept: deque[tuple[int, np.ndarray]] = deque([(start - MIN_RUN, best)])
        ends, before = None, -2
        for i in range(a, b):
            row = int(self.rows[i])
            cols, run = self.col[self.first[i] : self.last[i]], self.run[self.first[i] : self.last[i]]
            while len(kept) > 1 and kept[1][0] <= row - MIN_RUN:
                kept.popleft()
            now = np.zeros(self.n + 1, np.int64)
            if row - start + 1 >= MIN_RUN:
                whole = run >= MIN_RUN
                c = cols[whole]
                now[c] = kept[0][1][c - MIN_RUN + 1] + MIN_RUN
                if ends is not None and before == row - 1:
                    inner = cols[cols > 0]
                    grown = ends[inner - 1]
                    now[inner] = np.maximum(now[inner], np.where(grown > 0, grown + 1, 0))
            ends, before = now, row
            if now.any():
                best = np.maximum(best, np.concatenate(([0], np.maximum.accumulate(now[:-1]))))
                kept.append((row, best))
        return int(best[-1])


def best_in_order(found: list[tuple[int, int, int]], n_item: int) -> int:
    """Most item words that one passage of SPAN times the item's length holds in order, in runs of MIN_RUN or more.

    Exact over all passages, of which few are tried: no passage holds more than the words of it that
    stand in matches, and one that begins k words on holds at most k more than this one.
    """
    found = np.asarray(found, np.int64).reshape(-1, 3)
    if not len(found):
        return 0
    begin, end = int(found[:, 0].min()), int((found[:, 0] + found[:, 2]).max())
    width = max(int(SPAN * n_item), MIN_RUN)
    in_doc, in_item = np.zeros(end - begin + 1, np.int64), np.zeros(n_item + 1, np.int64)
    for marks, at in ((in_doc, found[:, 0] - begin), (in_item, found[:, 1])):
        np.add.at(marks, at, 1)
        np.add.at(marks, at + found[:, 2], -1)
    shared = np.concatenate(([0], np.cumsum(np.cumsum(in_doc) > 0)))
    starts = np.arange(max(end - begin - width, 0) + 1)
    bound = np.minimum(shared[np.minimum(starts + width, len(shared) - 1)] - shared[starts], int((np.cumsum(in_item) > 0).sum()))
    passages, best = Passages(found, n_item, width), 0
    while True:
        s = int(np.argmax(bound))
        if bound[s] <= best:
            return best
        here = passages.held(begin + s)
        best = max(best, here)
        bound = np.minimum(bound, here + np.abs(starts - s))


def compare(items: Items, doc_words: list[str]) -> list[tuple[int, float, int, float]]:
    """(item, share of it that tiles cover, tiles, share held in order by one passage) of every item with a shared run.

    The last share is 0 for pairs that the threshold stops: neither the tiles nor all words that
    stand in any match cover enough of the item.
    """
    get = items.ids.get
    ids = np.fromiter((get(w, 0) for w in doc_words), np.uint64, len(doc_words))
    out = []
    for item, seeds in items.seeds(ids).items():
        n, found = len(items.words[item]), matches(seeds)
        tiles = tile(found, n)
        covered = sum(t[2] for t in tiles) / n
        passes = covered >= COVERAGE
        if not passes and len(found) > len(tiles):
            touched = np.zeros(n, bool)
            for _, p, m in found:
                touched[p : p + m] = True
            passes = touched.sum() / n >= COVERAGE
        out.append((item, covered, len(tiles), best_in_order(found, n) / n if passes else 0.0))
    return out


def _blocks(items: DataFrame) -> list[list[tuple[int, str]]]:
    """The items in blocks of at most BLOCK items and about BLOCK_CHARS characters, one at least."""
    out, size = [[]], 0
    for r in items.select("item_id", "text").where("item_id is not null and text is not null").distinct().toLocalIterator():
        if out[-1] and (len(out[-1]) >= BLOCK or size + len(r[1]) > BLOCK_CHARS):
            out.append([])
            size = 0
        out[-1].append((int(r[0]), r[1]))
        size += len(r[1])
    return [sorted(b) for b in out]


def tiles(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, coverage, n_tiles, in_order, gate) of every document and item that share a run.

    ``gate`` says what sent a pair to the exact check: ``tiles`` cover enough of the item, or
    ``bound``: they fall short, but the words in any match are enough; else null and ``in_order`` 0.
    Whole texts are read. Null and empty texts share nothing; items under ``MIN_RUN`` words cannot
    be found. Repeated documents each give their rows.
    """
    texts = spread(documents.select("doc_id", "text").where("text is not null"), "doc_id")
    out = None
    for block in _blocks(items):

        def run(batches: Iterator[pd.DataFrame], block: list = block) -> Iterator[pd.DataFrame]:
            index = Items(block)
            for pdf in batches:
                rows = [(doc, *r) for doc, text in zip(pdf["doc_id"], pdf["text"], strict=True) for r in compare(index, words(text))]
                yield pd.DataFrame(rows, columns=["doc_id", "item_id", "coverage", "n_tiles", "in_order"])

        part = texts.mapInPandas(run, RESULT)
        out = part if out is None else out.unionByName(part)
    return out.withColumn("gate", F.when(F.col("coverage") >= COVERAGE, "tiles").when(F.col("in_order") > 0, "bound"))


def leaked(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id) of the pairs whose tiles cover (or could cover) enough of the item and whose exact check finds as much in order in one passage."""
    return tiles(documents, items).where(F.col("gate").isNotNull() & (F.col("in_order") >= COVERAGE)).select("doc_id", "item_id")


def leaked_items(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(item_id, n_docs, n_in_order, most) of every item that tiles cover in some document, reordered or not."""
    hit = tiles(documents, items).where(F.col("coverage") >= COVERAGE)
    return hit.groupBy("item_id").agg(F.count("*").alias("n_docs"), F.count_if(F.col("in_order") >= COVERAGE).alias("n_in_order"), F.max("in_order").alias("most"))
