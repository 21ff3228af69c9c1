"""Problem 8: items of varying length into containers of fixed capacity.

Lengths are counted in tokens, the histogram of lengths (at most ``capacity`` numbers, however
large the corpus) is packed on the driver, and the documents follow their length's plan:

1. shallow combinations that fill the window are enumerated: ``m`` pieces of one length, ``n`` of a
   second, one of a third;
2. non-negative least squares finds how often to repeat each so that the pieces used match the
   histogram; the counts are rounded down to what is there;
3. what is left is packed greedily, longest first, by best fit on the histogram.

A document keeps whole unless it alone exceeds the capacity; then it is cut into full pieces and a
rest, and the rest is packed like any other. Container ids are unique, not consecutive.
"""

from __future__ import annotations

import base64
import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import cut, spread

CAPACITY = 2048
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Pieces of one length that are ranked together; a more frequent length is ranked in parts.
SALT_ROWS = 500_000
PIECES = "doc_id long, piece int, first_token int, n_tokens int"


class TokenCounter:
    """Token counts of texts under a public byte-level BPE; special tokens' strings count as ordinary text."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._encode = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def count(self, text: str) -> int:
        return len(self._encode(text))


def token_pieces(documents: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, piece, first_token, n_tokens): one row per document, more for those above ``capacity``.

    Null and empty texts have one row of 0 tokens.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = TokenCounter(vocabulary)
        for pdf in batches:
            rows = []
            for doc, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                n = counter.count(text) if text else 0
                rows += [(doc, i, at, min(capacity, n - at)) for i, at in enumerate(range(0, max(n, 1), capacity))]
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "first_token", "n_tokens"])

    return spread(documents.select("doc_id", "text"), "doc_id").mapInPandas(count, PIECES)


def sparse_least_squares(lengths: np.ndarray, repeats: np.ndarray, hist: np.ndarray, passes: int = 4) -> np.ndarray:
    """As ``least_squares``, solved again without the combinations repeated least, so that rounding down loses little."""
    x, live = np.zeros(len(lengths)), np.arange(len(lengths))
    for k in range(passes):
        part = least_squares(lengths[live], repeats[live], hist)
        if k + 1 == passes or not len(live):
            x[live] = part
            break
        live = live[part >= np.median(part)]
    return x


@dataclass
class Plan:
    """Per length: from which rank on which container run takes how many pieces a container."""

    lengths: np.ndarray
    start_rank: np.ndarray
    per_container: np.ndarray
    first_container: np.ndarray
    n_containers: int


def combinations(hist: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, repeats), each patterns x 3: m of a, n of b and one of c that together fill the window as far as present lengths allow."""
    present = np.flatnonzero(hist)
    if not len(present):
        return np.zeros((0, 3), np.int64), np.zeros((0, 3), np.int64)

    def at_most(x: np.ndarray) -> np.ndarray:
        i = np.searchsorted(present, x, "right") - 1
        return np.where(i >= 0, present[np.maximum(i, 0)], 0)

    rows_l, rows_r = [], []
    most = capacity // present  # pieces of this length that fit
    for m in (np.ones_like(most), np.minimum(2, most), np.maximum(most // 2, 1), np.maximum(most - 1, 1), most):
        rest = capacity - present * m
        for n in (1, 2, 4):
            b = at_most(rest // n)
            c = at_most(rest - b * n)
            rows_l.append(np.stack([present, b, c], 1))
            rows_r.append(np.stack([m, np.where(b > 0, n, 0), np.where(c > 0, 1, 0)], 1))
    lengths, repeats = np.concatenate(rows_l), np.concatenate(rows_r)
    full = (lengths * repeats).sum(1) >= capacity - 2
    both = np.unique(np.concatenate([lengths[full], repeats[full]], 1), axis=0)
    return both[:, :3], both[:, 3:]


def least_squares(lengths: np.ndarray, repeats: np.ndarray, hist: np.ndarray, rounds: int = 300) -> np.ndarray:
    """x >= 0 that minimises |A x - hist| weighted by length: accelerated projected gradient on the sparse A."""
    if not len(lengths):
        return np.zeros(0)
    weight = np.sqrt(np.arange(len(hist)) + 1.0)
    w = repeats * weight[lengths]
    target = hist * weight
    flat = lengths.ravel()

    def forward(x: np.ndarray) -> np.ndarray:
        return np.bincount(flat, (w * x[:, None]).ravel(), len(hist))

    probe = np.ones(len(lengths))
    for _ in range(20):  # the largest eigenvalue gives the step
        probe = (w * forward(probe)[lengths]).sum(1)
        size = np.linalg.norm(probe)
        probe /= size
    step = 1.0 / (size * 1.01)
    x = y = np.zeros(len(lengths))
    t = 1.0
    for _ in range(rounds):
        grad = (w * (forward(y) - target)[lengths]).sum(1)
        new = np.maximum(y - step * grad, 0.0)
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def plan(hist: np.ndarray, capacity: int = CAPACITY) -> Plan:
    """Containers for ``hist[length]`` pieces of each length (index 0 is not packed)."""
    left = hist.astype(np.int64).copy()
    left[0] = 0
    entries: list[tuple[int, int, int]] = []  # length, pieces a container, first container; with the run's length in ``times``
    times: list[int] = []
    n = 0

    def use(pattern: list[tuple[int, int]], count: int) -> None:
        nonlocal n
        for length, k in pattern:
            entries.append((length, k, n))
            times.append(count)
            left[length] -= k * count
        n += count

    lengths, repeats = combinations(left, capacity)
    x = sparse_least_squares(lengths, repeats, left.astype(float))
    for i in np.argsort(-x, kind="stable"):
        if x[i] < 1:
            break
        want: dict[int, int] = {}
        for length, k in zip(lengths[i], repeats[i], strict=True):
            if k:
                want[int(length)] = want.get(int(length), 0) + int(k)
        count = min(int(x[i]), *(int(left[length]) // k for length, k in want.items()))
        if count > 0:
            use(list(want.items()), count)
    present = [int(v) for v in np.flatnonzero(left)]
    while present:
        room, want = capacity, {}
        hi = len(present)
        while hi:
            j = bisect.bisect_right(present, room, 0, hi) - 1
            if j < 0:
                break
            length = present[j]
            k = min(room // length, int(left[length]))
            want[length] = k
            room -= k * length
            hi = j
        use(list(want.items()), min(int(left[length]) // k for length, k in want.items()))
        present = [v for v in present if left[v]]
    e = np.array(entries, np.int64).reshape(-1, 3)
    order = np.argsort(e[:, 0], kind="stable")
    e, runs = e[order], np.array(times, np.int64)[order] if len(order) else np.zeros(0, np.int64)
    taken = e[:, 1] * runs
    before = np.cumsum(taken) - taken
    first = np.searchsorted(e[:, 0], e[:, 0], "left")
    return Plan(e[:, 0], before - before[first] if len(e) else before, e[:, 1], e[:, 2], n)


def pack(documents: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, piece, first_token, n_tokens, container_id) of every document; no token is lost, container_id is null for 0 tokens.

    Counts are written once to the shared folder, since the histogram and the assignment both need
    them. A full piece is a container of its own and is numbered where it stands, without a shuffle.
    Pieces of another length get their rank among those of that length, counted in as many salted
    parts as ``SALT_ROWS`` asks for, so that no length, however frequent, is one task. The driver gets
    one number per length and one per part.
    """
    pieces = cut(token_pieces(documents, capacity, vocabulary).withColumn("at", F.monotonically_increasing_id()))
    full, short = pieces.where(F.col("n_tokens") == capacity), pieces.where((F.col("n_tokens") > 0) & (F.col("n_tokens") < capacity))
    hist = np.zeros(capacity + 1, np.int64)
    for r in short.groupBy("n_tokens").agg(F.count("*").alias("n")).collect():  # at most ``capacity`` rows
        hist[r[0]] = r[1]
    made = plan(hist, capacity)
    parts = np.maximum(1, -(-hist // SALT_ROWS))
    salt = F.pmod(F.xxhash64("doc_id", "piece"), F.element_at(F.lit(parts.tolist()), F.col("n_tokens") + 1)).cast("int")
    salted = short.withColumn("salt", salt)
    # per (length, part): how many pieces of that length stand in the parts before
    slot = np.concatenate(([0], np.cumsum(parts)))
    counts = np.zeros(slot[-1], np.int64)
    for r in salted.groupBy("n_tokens", "salt").agg(F.count("*").alias("n")).collect():  # one row a part
        counts[slot[r[0]] + r[1]] = r[2]
    before = np.cumsum(counts) - counts
    offset = before - np.repeat(before[slot[:-1]], parts)
    begin = np.searchsorted(made.lengths, np.arange(capacity + 2), "left")

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # entries are sorted by length, then rank: one search finds a piece's entry
        wide = np.int64(1) << 44
        keys = made.lengths * wide + made.start_rank
        for pdf in batches:
            length, part = pdf["n_tokens"].to_numpy(np.int64), pdf["salt"].to_numpy(np.int64)
            rank = offset[slot[length] + part] + pdf["rn"].to_numpy(np.int64) - 1
            i = np.maximum(np.searchsorted(keys, length * wide + rank, "right") - 1, begin[length])
            got = made.first_container[i] + (rank - made.start_rank[i]) // made.per_container[i] if len(pdf) else np.zeros(0, np.int64)
            yield pdf.drop(columns=["salt", "rn"]).assign(container_id=got)

    ranked = salted.drop("at").withColumn("rn", F.row_number().over(Window.partitionBy("n_tokens", "salt").orderBy("doc_id", "piece")))
    out = ranked.mapInPandas(place, PIECES + ", container_id long")
    alone = full.select("doc_id", "piece", "first_token", "n_tokens", (F.col("at") + made.n_containers).alias("container_id"))
    none = pieces.where("n_tokens = 0").select("doc_id", "piece", "first_token", "n_tokens", F.lit(None).cast("long").alias("container_id"))
    return out.unionByName(alone).unionByName(none)


def containers(packed: DataFrame) -> DataFrame:
    """(container_id, n_pieces, n_tokens) of every container."""
    return packed.where("container_id is not null").groupBy("container_id").agg(F.count("*").alias("n_pieces"), F.sum("n_tokens").alias("n_tokens"))
