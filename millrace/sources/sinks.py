"""Sinks: grains, JSON lines, manifests, create-only records and the append that commits a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_grain(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """One object a line with sorted keys."""
    df.select(*sorted(df.columns)).write.mode("overwrite").json(path)


def write_manifest(df: DataFrame, path: str, columns: list[str]) -> None:
    df.select(*columns).write.mode("overwrite").option("header", True).option("lineSep", "\n").csv(path)


def create_only(df: DataFrame, path: str) -> bool:
    """Write ``path`` unless it is there; returns whether this call created it."""
    from pyspark.errors import AnalysisException

    try:
        df.write.mode("errorifexists").parquet(path)
    except AnalysisException as e:
        if "PATH_ALREADY_EXISTS" in str(e):
            return False
        raise
    return True


def append_rows(df: DataFrame, path: str, partition: str = "environment") -> None:
    """Append JSON rows below ``partition=value``; a row that is there is committed."""
    df.write.mode("append").partitionBy(partition).json(path)


def upsert(log: DataFrame, changes: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The log with ``changes`` put over it: the greatest ``order`` of each key, changes first on ties."""
    both = log.withColumn("__s", F.lit(0)).unionByName(changes.withColumn("__s", F.lit(1)), allowMissingColumns=True)
    cols = [c for c in both.columns if c not in ("__s", *keys)]
    return both.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.struct(order, "__s")).alias("r")).select(*keys, "r.*")


def sidecar(df: DataFrame, path: str) -> DataFrame:
    """(file, metadata as JSON) for the ``.name.metadata.json`` files beside objects."""
    return df.select(F.concat(F.lit(path + "/."), F.col("name"), F.lit(".metadata.json")).alias("file"), F.to_json("metadata").alias("metadata"))


def write_sidecar(df: DataFrame, path: str) -> None:
    """The metadata beside the objects below ``path``, as one side table keyed by file instead of many small files."""
    sidecar(df, path).write.mode("overwrite").parquet(f"{path}/.metadata")


def relocate(json_text: Column, old: str, new: str) -> Column:
    """Every path in a JSON text moved from ``old`` to ``new``."""
    return F.replace(json_text, F.lit(old), F.lit(new))


def concat_outputs(frames: dict[str, DataFrame], order: list[str]) -> dict[str, DataFrame]:
    """Each output in its one total order."""
    return {k: v.orderBy(*[c for c in order if c in v.columns]) for k, v in frames.items()}
