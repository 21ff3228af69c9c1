"""Window and arg-max operators. Every one has a total order, so results do not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest_per_key(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in ``order``; null keys are one key."""
    w = W.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def arg_max(rows: DataFrame, keys: list[str], values: list[str], by: list[str]) -> DataFrame:
    """(keys, values) of the row greatest in ``by``; partial before the shuffle, unlike a window."""
    best = F.max_by(F.struct(*values), F.struct(*by))
    return rows.groupBy(*keys).agg(best.alias("b")).select(*keys, "b.*")


def top_k(rows: DataFrame, keys: list[str], k: int, *order: Column) -> DataFrame:
    w = W.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def consecutive_distinct(rows: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """Rows whose values differ from the row before (A, B, A keeps all three); null equals null."""
    w = W.partitionBy(*keys).orderBy(*order)
    here = F.struct(*values)
    return rows.withColumn("__first", F.row_number().over(w) == 1).withColumn("__same", F.lag(here).over(w).eqNullSafe(here)).where("__first or not __same").drop("__first", "__same")


def carry_forward(rows: DataFrame, keys: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """The last value before each row that is not null."""
    w = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return rows.withColumn(out, F.last(value, ignorenulls=True).over(w))


def renumber(rows: DataFrame, keys: list[str], order: list[str], kept: Column, out: str) -> DataFrame:
    """Dense numbers of the kept rows; null for the others."""
    w = W.partitionBy(*keys).orderBy(*order)
    return rows.withColumn(out, F.when(kept, F.sum(F.when(kept, 1).otherwise(0)).over(w)).cast("int"))


def backsteps(rows: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """(keys, n, n_back): neighbours in order and how many step back; null values are passed over."""
    w = W.partitionBy(*keys).orderBy(*order)
    steps = rows.where(F.col(value).isNotNull()).withColumn("__p", F.lag(value).over(w))
    return steps.groupBy(*keys).agg(F.count("__p").alias("n"), F.sum(F.when(F.col(value) < F.col("__p"), 1).otherwise(0)).alias("n_back"))


def is_contiguous(rows: DataFrame, keys: list[str], number: str) -> DataFrame:
    """(keys, contiguous): whether the numbers are 1..n, each once. An aggregate, not a list."""
    n = F.count(number)
    return rows.groupBy(*keys).agg(((F.min(number) == 1) & (F.max(number) == n) & (F.sum(F.col(number).cast("long")) * 2 == n * (n + 1)) & (F.sum(F.col(number).cast("long") * F.col(number)) * 6 == n * (n + 1) * (2 * n + 1))).alias("contiguous"))


def first_where(rows: DataFrame, keys: list[str], order: list[str], done: Column, out: str) -> DataFrame:
    """Marks the newest row of each key for which ``done`` holds."""
    w = W.partitionBy(*keys).orderBy(*[F.desc(o) for o in order])
    return rows.withColumn(out, F.coalesce(done & (F.sum(F.when(done, 1).otherwise(0)).over(w) == 1), F.lit(False)))
