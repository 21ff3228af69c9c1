"""Problem 10: reading level of each text from the grades at which its words are acquired.

Texts of known level say at which grade a word comes into use: its share of the words of each
level, normalised over levels, is a distribution whose mean (drawn to the overall mean where the
word is rare) is the word's acquisition grade. A text is then as hard as the quantiles of its
known words' grades; the mapping from quantiles to level is calibrated on labelled texts that
took no part in grading the words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import words
from millrace.session import cut, spread

#: Bound of the labelled sample the grades and the calibration are fitted on; the hash of doc_id picks it.
MAX_LABELLED = 50_000
#: A word is graded if so many labelled documents hold it.
MIN_DOCS = 3
LEVELS = 5
#: Words of evidence that a word's own distribution needs to count as much as the overall one.
PRIOR = 3.0
QUANTILES = (0.1, 0.25, 0.5, 0.75, 0.9, 0.97)
#: Texts with a smaller share of known words are judged by their shape (word and sentence length).
KNOWN_SHARE = 0.3
RIDGE = 1.0
RESULT = "doc_id long, reading_level double, level_class int, n_words int, n_known int, basis string"


def labels(reading_labels: DataFrame) -> DataFrame:
    """(doc_id, level): mean of a document's valid judgements; nulls and repeats of a rater do not count."""
    valid = reading_labels.where(f"doc_id is not null and reading_level between 1 and {LEVELS}").dropDuplicates(["doc_id", "rater", "reading_level"])
    return valid.groupBy("doc_id").agg(F.avg("reading_level").alias("level"))


def _sentences(text: str) -> int:
    return max(1, sum(text.count(c) for c in ".!?\n;"))


def shape_of(text: str, ws: list[str]) -> list[float]:
    n = max(len(ws), 1)
    letters = sum(map(len, ws)) / n
    return [1.0, letters, sum(len(w) > 8 for w in ws) / n, min(np.log1p(n / _sentences(text)), 5.0)]


class Grades:
    def __init__(self, table: dict[str, float]):
        self.table = table

    def features(self, ws: list[str]) -> tuple[int, list[float]]:
        """(known words, features): mean and quantiles of the known words' grades, interpolated."""
        get = self.table.get
        g = np.array([x for x in map(get, ws) if x is not None])
        if not len(g):
            return 0, []
        g.sort()
        at = np.array(QUANTILES) * (len(g) - 1)
        lo = at.astype(int)
        hi = np.minimum(lo + 1, len(g) - 1)
        return len(g), [1.0, float(g.mean()), *(g[lo] + (g[hi] - g[lo]) * (at - lo))]


def word_grades(graded: DataFrame) -> dict[str, float]:
    """word -> acquisition grade, from (level, text) of labelled documents.

    Counts are aggregated in the cluster; the driver gets every word that MIN_DOCS documents hold,
    with one number per level, and the total of each level. The labelled sample is bounded by
    MAX_LABELLED, and so is the list of words its documents share.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out: dict[tuple[str, int], list[int]] = {}
            for level, text in zip(pdf["level"], pdf["text"], strict=True):
                band = int(round(level))
                ws = words(text)
                seen = set()
                for w in ws:
                    cell = out.setdefault((w, band), [0, 0])
                    cell[0] += 1
                    if w not in seen:
                        seen.add(w)
                        cell[1] += 1
            yield pd.DataFrame([(w, b, c, d) for (w, b), (c, d) in out.items()], columns=["word", "band", "n", "docs"])

    cells = graded.mapInPandas(count, "word string, band int, n long, docs long")
    bands = range(1, LEVELS + 1)
    # one row a word, written once: the totals and the kept words are both read from it
    per_word = cut(cells.groupBy("word").agg(F.sum("docs").alias("docs"), *[F.sum(F.when(F.col("band") == b, F.col("n")).otherwise(0)).alias(f"n{b}") for b in bands]))
    (total,) = per_word.agg(*[F.coalesce(F.sum(f"n{b}"), F.lit(0)).alias(f"n{b}") for b in bands]).collect()
    totals = np.ones(LEVELS) + np.array(total, float)
    kept = per_word.where(F.col("docs") >= MIN_DOCS).toLocalIterator()
    levels = np.arange(1, LEVELS + 1)
    rate_all = totals.sum()
    out = {}
    for r in kept:
        n = np.array([r[f"n{b}"] for b in levels], float)
        share = n / totals * rate_all / LEVELS  # as if all levels had as many words
        total = share.sum()
        out[r.word] = float((share @ levels + PRIOR * levels.mean()) / (total + PRIOR))
    return out


def _ridge(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    penalty = RIDGE * np.eye(x.shape[1])
    penalty[0, 0] = 0.0
    return np.linalg.solve(x.T @ x + penalty, x.T @ y)


class Model:
    """Word grades, the calibration of their quantiles, and that of the shape."""

    def __init__(self, grades: dict[str, float], by_words: np.ndarray | None, by_shape: np.ndarray | None, cuts: list[float], middle: float):
        self.grades, self.by_words, self.by_shape, self.cuts, self.middle = Grades(grades), by_words, by_shape, cuts, middle

    def judge(self, text: str | None) -> tuple:
        ws = words(text) if text else []
        if not ws:
            return None, None, 0, 0, "no_text"
        known, f = self.grades.features(ws)
        if self.by_words is not None and known >= max(1, KNOWN_SHARE * len(ws)):
            level, basis = float(np.dot(self.by_words, f)), "words"
        elif self.by_shape is not None:
            level, basis = float(np.dot(self.by_shape, shape_of(text, ws))), "shape"
        else:
            level, basis = self.middle, "none"
        level = min(max(level, 1.0), float(LEVELS))
        return level, 1 + int(np.searchsorted(self.cuts, level, "right")), len(ws), known, basis


def fit(documents: DataFrame, reading_labels: DataFrame, train_share: float = 1.0) -> Model:
    """The model of the labelled documents; half of them, by hash, grade the words and the others calibrate.

    ``train_share`` below 1 leaves the rest of the labelled documents out, for held-out tests (see
    ``held_out``). With no labels every text gets the middle level.
    """
    known = labels(reading_labels)
    pick = F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1000))
    known = known.where(pick < F.lit(int(1000 * train_share)))
    over = known.count() / MAX_LABELLED
    if over > 1:
        known = known.where(F.pmod(F.xxhash64("doc_id", F.lit("bound")), F.lit(1_000_000)) < F.lit(int(1_000_000 / over)))
    sample = documents.select("doc_id", "text").where("text is not null").join(known, "doc_id").repartition(documents.sparkSession.sparkContext.defaultParallelism, "doc_id").withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)))
    sample = cut(sample)  # at most MAX_LABELLED texts, read again for each half
    grades = word_grades(sample.where("half = 0").select("level", "text"))
    table = Grades(grades)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for level, text in zip(pdf["level"], pdf["text"], strict=True):
                ws = words(text)
                if ws:
                    n, f = table.features(ws)
                    rows.append((level, n / len(ws), f, shape_of(text, ws)))
            yield pd.DataFrame(rows, columns=["level", "share", "f", "shape"])

    rows = sample.where("half = 1").select("level", "text").mapInPandas(measure, "level double, share double, f array<double>, shape array<double>").collect()  # at most MAX_LABELLED short rows
    middle = (1 + LEVELS) / 2
    good = [r for r in rows if r.share >= KNOWN_SHARE and len(r.f)]
    by_words = _ridge(np.array([r.f for r in good]), np.array([r.level for r in good])) if len(good) > 20 else None
    by_shape = _ridge(np.array([r.shape for r in rows]), np.array([r.level for r in rows])) if len(rows) > 20 else None
    # quantile calibration: classes are cut so that they are as frequent as in the judgements
    cuts = [b + 0.5 for b in range(1, LEVELS)]
    if by_words is not None:
        scored = np.sort(np.clip([float(np.dot(by_words, r.f)) for r in good], 1, LEVELS))
        real = np.array([r.level for r in good])
        cuts = [float(np.quantile(scored, np.mean(real < b + 0.5))) for b in range(1, LEVELS)]
    return Model(grades, by_words, by_shape, cuts, middle)


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, reading_level, level_class, n_words, n_known, basis) of every document.

    ``basis`` is ``words``; ``shape`` where few words are known (another language, mostly numbers);
    ``no_text`` with null levels for null, empty and wordless texts; ``none`` without any labels.
    """

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pd.DataFrame([model.judge(t) for t in pdf["text"]], columns=["reading_level", "level_class", "n_words", "n_known", "basis"])
            out["level_class"] = out["level_class"].astype("Int32")
            out.insert(0, "doc_id", pdf["doc_id"].to_numpy())
            yield out

    return spread(documents.select("doc_id", "text"), "doc_id").mapInPandas(judge, RESULT)


def reading_levels(documents: DataFrame, reading_labels: DataFrame) -> DataFrame:
    return predict(documents, fit(documents, reading_labels))


def held_out(documents: DataFrame, reading_labels: DataFrame, train_share: float = 0.8) -> DataFrame:
    """(doc_id, level, reading_level, level_class) of the labelled documents a model fitted on the others has not seen."""
    model = fit(documents, reading_labels, train_share)
    rest = labels(reading_labels).where(F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1000)) >= F.lit(int(1000 * train_share)))
    unseen = documents.select("doc_id", "text").join(rest, "doc_id")
    return predict(unseen, model).join(rest, "doc_id").select("doc_id", "level", "reading_level", "level_class")
