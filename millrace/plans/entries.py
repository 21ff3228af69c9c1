"""Reviewed values to append-only entries, and their latest-row view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.windows import latest_per_key

LATEST_SQL = """
select * from (
    select *, row_number() over (partition by environment, organization_id, well_id order by confirmed_at desc, confirmation_id desc) as rn
    from {table}
) where rn = 1"""


def proposal(cells: DataFrame, record: list[str], variant: str, preferred: str) -> DataFrame:
    """(record, column, value, n_values, varies, all_values): the preferred variant's value if it has one, else the first's, others listed."""
    first = F.struct((F.col(variant) != preferred).alias("other"), F.length(variant), F.col(variant))
    return cells.where("value is not null").groupBy(*record, "column").agg(
        F.min_by("value", first).alias("value"), F.count_distinct("value").alias("n_values"), (F.count_distinct("value") > 1).alias("varies"),
        F.array_join(F.array_sort(F.collect_set(F.concat_ws("=", variant, "value"))), "; ").alias("all_values"),
    )


def envelopes(proposed: DataFrame, record: list[str], units: dict[str, str]) -> DataFrame:
    """(record, entry): one JSON object of envelopes {value, unit, source} per record, keys sorted."""
    unit = F.element_at(F.create_map(*[F.lit(x) for kv in units.items() for x in kv]), F.col("column"))
    e = F.struct(F.col("column"), F.struct(F.col("value"), unit.alias("unit"), F.lit("proposal").alias("source")).alias("envelope"))
    return proposed.groupBy(*record).agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(e)))).alias("entry"))


def problems(request: DataFrame, checks: dict[str, str]) -> DataFrame:
    """``request`` with ``problems``: the name of every check (name -> SQL condition that must hold) it fails; null conditions fail."""
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(F.expr(sql), F.lit(False)), F.lit(name)) for name, sql in checks.items()]))
    return request.withColumn("problems", failed)


def commit_rows(checked: DataFrame, committed: DataFrame | None) -> DataFrame:
    """Accepted requests not committed before, each id once; the row is the commit point, so repeats are no-ops."""
    new = checked.where(F.size("problems") == 0).drop("problems").dropDuplicates(["confirmation_id"])
    return new if committed is None else new.join(committed.select("confirmation_id"), "confirmation_id", "left_anti")


def latest_entries(entries: DataFrame) -> DataFrame:
    return latest_per_key(entries, ["environment", "organization_id", "well_id"], F.desc("confirmed_at"), F.desc("confirmation_id"))


def carried_decisions(earlier: DataFrame, proposed: DataFrame, keys: list[str]) -> DataFrame:
    """Earlier decisions on the new proposal: corrections always (``moved`` if the proposal changed), settlements only if it did not."""
    j = earlier.join(proposed.select(*keys, F.col("value").alias("__now")), keys)
    same = F.col("__now").eqNullSafe(F.col("proposed"))
    return j.where((F.col("kind") == "correction") | same).select(*keys, "kind", "final", (~same).alias("moved"))
