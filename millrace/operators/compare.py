"""Two versions of a set of records compared: tables, curves and traps to one verdict, one worksheet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.operators import versions

FAILING = ("conflict", "dropped")


def row_key(columns: list[str]) -> Column:
    """A row's key as JSON, keys sorted, nulls said; the same on both sides and through a file."""
    return F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})


def traps(old: DataFrame, new: DataFrame, record: list[str], column: str) -> DataFrame:
    """(record, old, new, category): values of a column that one side has more often than the other, whatever row they stand in, paired in order."""
    count = lambda df, n: df.where(F.col(column).isNotNull()).groupBy(*record, column).agg(F.count("*").alias(n))
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in [*record, column]]
    j = count(old, "n_old").alias("a").join(count(new, "n_new").alias("b"), on, "full_outer").select(*[F.coalesce(F.col(f"a.{k}"), F.col(f"b.{k}")).alias(k) for k in [*record, column]], (F.coalesce("n_old", F.lit(0)) - F.coalesce("n_new", F.lit(0))).alias("d"))
    w = W.partitionBy(*record).orderBy(column, "i")
    beyond = lambda sign, name: j.where(F.col("d") * sign > 0).withColumn("i", F.explode(F.sequence(F.lit(1), F.abs("d")))).select(*record, F.col(column).alias(name), F.row_number().over(w).alias("rn"))
    both = [F.col(f"x.{k}").eqNullSafe(F.col(f"y.{k}")) for k in [*record, "rn"]]
    p = beyond(1, "old").alias("x").join(beyond(-1, "new").alias("y"), both, "full_outer")
    return p.select(*[F.coalesce(F.col(f"x.{k}"), F.col(f"y.{k}")).alias(k) for k in record], "old", "new").withColumn("category", versions.classify(F.col("old"), F.col("new")))


def curve_verdict(old: DataFrame, new: DataFrame, record: list[str], tolerance_pct: float = 5.0) -> DataFrame:
    """(record, n_old, n_new, delta_pct, count_ok): whether a version has about as many curve rows as the last; null percent where that had none but this has."""
    count = lambda df, n: df.groupBy(*record).agg(F.count("*").alias(n))
    j = count(old, "n_old").join(count(new, "n_new"), record, "full_outer").fillna(0, ["n_old", "n_new"])
    delta = F.when(F.col("n_old") > 0, F.round((F.col("n_new") - F.col("n_old")) * 100.0 / F.col("n_old"), 2)).cast("double")
    return j.withColumn("delta_pct", delta).withColumn("count_ok", F.coalesce(F.abs("delta_pct") <= tolerance_pct, F.lit(False)))


def compared(old: DataFrame, new: DataFrame, record: list[str], key: list[str], columns: list[str], trap: str) -> DataFrame:
    """(record, table_ok, traps_ok, count_ok, passed): field diffs, traps and row counts of two versions of a table in one verdict per record.

    A record on one side only fails by its dropped or added rows; records without differences pass.
    """
    fields = versions.field_diffs(versions.positional(old, new, [*record, *key], columns), [*record, *key], columns)
    bad = lambda df, name: df.groupBy(*record).agg(F.count_if(F.col("category").isin(*FAILING)).alias(name))
    rows = curve_verdict(old, new, record)
    j = rows.join(bad(fields, "f"), record, "left").join(bad(traps(old, new, record, trap), "t"), record, "left")
    ok = lambda c: F.coalesce(F.col(c), F.lit(0)) == 0
    return j.select(*record, ok("f").alias("table_ok"), ok("t").alias("traps_ok"), "count_ok", (ok("f") & ok("t") & F.col("count_ok")).alias("passed"))


def worksheet(diffs: dict[str, DataFrame], record: str, groups: list[str]) -> DataFrame:
    """(record, table_name, row_key, field, category, old, new, rank): every failing difference of the tables, ranked within its record by table group, key, field and values.

    ``diffs`` has, per table, (record, row_key, column, old, new, category).
    """
    out = None
    for name, df in diffs.items():
        part = df.where(F.col("category").isin(*FAILING)).select(record, F.lit(name).alias("table_name"), "row_key", F.col("column").alias("field"), "category", "old", "new")
        out = part if out is None else out.unionByName(part)
    place = F.array_position(F.array(*map(F.lit, groups)), F.col("table_name"))
    return out.withColumn("rank", F.row_number().over(W.partitionBy(record).orderBy(place, "row_key", "field", "old", "new")))


def added_sample(diffs: DataFrame, record: str, per_field: int = 5) -> DataFrame:
    """The first ``per_field`` added values of each record and field."""
    w = W.partitionBy(record, "column").orderBy("row_key", "old", "new")
    return diffs.where("category = 'added'").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= per_field)


def ordered_parity(old: DataFrame, new: DataFrame, record: list[str], order: list[str], columns: list[str], allowed: Column | None = None) -> DataFrame:
    """(record, same_rows, same_order): whether two artifacts hold the same rows and in the same order.

    ``allowed`` names rows that may differ and take no part. Orders compare by position within a
    record, so no list of rows is gathered.
    """
    w = W.partitionBy(*record).orderBy(*order)
    ok = F.lit(False) if allowed is None else F.coalesce(allowed, F.lit(False))
    side = lambda df, name: df.where(~ok).select(*record, F.row_number().over(w).alias("at"), F.sha2(versions.canonical(columns), 256).alias("h"), F.lit(name).alias("side"))
    both = side(old, 1).unionByName(side(new, -1))
    by_row = both.groupBy(*record, "h").agg(F.sum("side").alias("d")).groupBy(*record).agg((F.max(F.abs("d")) == 0).alias("same_rows"))
    by_place = both.groupBy(*record, "at").agg((F.min("h") == F.max("h")).alias("e"), F.count("*").alias("n")).groupBy(*record).agg(F.bool_and(F.col("e") & (F.col("n") == 2)).alias("same_order"))
    return by_row.join(by_place, record)


def conflict_rows(rows: DataFrame, status: str, evidence: DataFrame, record: list[str], name: str) -> DataFrame:
    """Rows whose status is a conflict, with the evidence of their record that names the same model, joined as text."""
    e = evidence.groupBy(*record, name).agg(F.array_join(F.array_sort(F.collect_set("said")), " | ").alias("evidence"))
    return rows.where(F.col(status) == "needs_review").join(e, [*record, name], "left")

