"""Problem 4: full history of changing attributes, by rebuilding the affected chains.

A *chain* is the list of versions of one entity. Raw changes are the truth; chains are derived.
When a batch of late, corrected or new changes comes, only the entities it touches have their raw
changes read again and their chains rebuilt; the chains of all others are taken over as they are.
``ChainStore`` makes the replacement atomic, on any file system Hadoop knows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.session import new_dir
from millrace.sources.store import BucketStore

FOREVER = "9999-12-31"


@dataclass(frozen=True)
class ChainSpec:
    """What makes an entity (``keys``), its versions (``attributes``) and their time (``day``, a date column; ``arrival`` orders corrections)."""

    keys: tuple[str, ...]
    attributes: tuple[str, ...]
    day: str
    arrival: str
    tie_break: str


def one_per_day(changes: DataFrame, spec: ChainSpec) -> DataFrame:
    """(keys, day, attrs): the change that holds for each entity and day.

    The latest arrival wins, of equal arrivals the greatest ``tie_break``. Changes without a key or
    a day do not count. The aggregate is partial before the shuffle, and an entity that holds a
    third of all rows is left with one row a day.
    """
    complete = changes.where(F.col(spec.day).isNotNull())
    for k in spec.keys:
        complete = complete.where(F.col(k).isNotNull())
    rank = F.struct(F.coalesce(F.col(spec.arrival), F.lit("0001-01-01").cast("timestamp")), F.col(spec.tie_break))
    return complete.groupBy(*spec.keys, F.col(spec.day).alias("day")).agg(F.max_by(F.struct(*spec.attributes), rank).alias("attrs"))


def build_chains(changes: DataFrame, spec: ChainSpec) -> DataFrame:
    """(keys, attributes, valid_from, valid_to) of every entity in ``changes``; nulls are equal to nulls.

    The windows run over days of one entity, so a partition is as long as its calendar.
    """
    daily = one_per_day(changes, spec)
    by_day = W.partitionBy(*spec.keys).orderBy("day")
    changed = daily.withColumn("before", F.lag("attrs").over(by_day)).where("before is null or not (attrs <=> before)")
    return changed.select(
        *spec.keys, "attrs.*",
        F.date_format("day", "yyyy-MM-dd").alias("valid_from"),
        F.coalesce(F.date_format(F.lead("day").over(by_day), "yyyy-MM-dd"), F.lit(FOREVER)).alias("valid_to"),
    )


def touched(changes: DataFrame, spec: ChainSpec) -> DataFrame:
    return changes.select(*spec.keys).dropna().distinct()


def rebuild_affected(chains: DataFrame, raw: DataFrame, batch: DataFrame, spec: ChainSpec) -> DataFrame:
    """``chains`` with the chains of every entity in ``batch`` rebuilt from ``raw`` (which holds the batch too)."""
    keys = touched(batch, spec)
    rebuilt = build_chains(raw.join(keys, list(spec.keys), "left_semi"), spec)
    return chains.join(keys, list(spec.keys), "left_anti").unionByName(rebuilt)


def history(changes: DataFrame, spec: ChainSpec, split: Column, path: str | None = None) -> DataFrame:
    """The history of all ``changes``, kept below ``path`` (by default a new one in the shared folder): those where ``split`` is false are the base load, the others a batch.

    The base load writes the chains of its entities; the batch reads the raw changes of the entities
    it touches, rebuilds their chains and replaces them in one commit. Both parts count whole, and
    the result does not depend on the split. An empty input gives no rows.
    """
    late = F.coalesce(split, F.lit(False))
    spark = changes.sparkSession
    # a store made here is read here only, so its buckets may follow the cluster's size
    store = ChainStore(spark, path or new_dir(spark, "chains"), spec, spark.sparkContext.defaultParallelism)
    store.load(changes.where(~late))
    store.apply(changes, changes.where(late))
    found = store.read()
    return build_chains(changes.limit(0), spec) if found is None else found


class ChainStore:
    """Chains in hash buckets of a ``BucketStore``; each commit replaces the buckets that hold touched entities.

    A reader sees either all old or all new chains. A writer that another one overtook gets
    ``Conflict`` and begins again.
    """

    def __init__(self, spark: SparkSession, path: str, spec: ChainSpec, buckets: int = 64):
        self.spec, self.store = spec, BucketStore(spark, path, spec.keys, buckets)

    def read(self) -> DataFrame | None:
        return self.store.read()

    def load(self, raw: DataFrame) -> int:
        """Build the chains of all entities in ``raw`` in place of whatever was there."""
        begun = self.store.version()
        return self.store.replace(build_chains(raw, self.spec), range(self.store.buckets), begun)

    def apply(self, raw: DataFrame, batch: DataFrame) -> list[int]:
        """Rebuild the chains ``batch`` touches; returns the buckets that were replaced."""
        begun, on = self.store.version(), list(self.spec.keys)
        keys = touched(batch, self.spec)
        hit = self.store.buckets_of(keys)
        if not hit:
            return []
        rebuilt = build_chains(raw.join(keys, on, "left_semi"), self.spec)
        old = self.store.read(hit, begun)
        if old is not None:
            rebuilt = old.join(keys, on, "left_anti").unionByName(rebuilt)
        self.store.replace(rebuilt, hit, begun)
        return hit
