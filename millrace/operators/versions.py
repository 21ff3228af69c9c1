"""Comparison of two versions of a record set, as multisets within keys."""

from __future__ import annotations


import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# The pattern of a number in a printed cell.
_NUMBER = r"([-+]?[\d,]*\.?\d+)"


def classify(old: Column, new: Column) -> Column:
    """added, dropped, format (same numbers, unit text equal or on one side) or conflict; null where equal as stored."""
    numbers = lambda x: F.transform(F.regexp_extract_all(x, F.lit(_NUMBER), F.lit(1)), lambda n: F.replace(n, F.lit(","), F.lit("")).try_cast("double"))
    rest = lambda x: F.lower(F.trim(F.regexp_replace(F.regexp_replace(x, _NUMBER + r"|[()\[\]]", " "), r"(?U)\s+", " ")))
    same = (F.size(numbers(old)) > 0) & (numbers(old) == numbers(new)) & ((rest(old) == rest(new)) | (rest(old) == "") | (rest(new) == ""))
    return F.when(old.eqNullSafe(new), None).when(old.isNull(), "added").when(new.isNull(), "dropped").when(F.coalesce(same, F.lit(False)), "format").otherwise("conflict")


def canonical(columns: list[str]) -> Column:
    return F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "true"})


def align(rows: DataFrame, record: list[str], ordinal: str, label: str) -> DataFrame:
    """``rows`` with ``variant``: the ordinal, the only ordinal of its label, the sole ordinal, else ``unaligned: label``."""
    known = rows.where(f"{ordinal} is not null")
    by_label = known.where(f"{label} is not null").groupBy(*record, label).agg(F.count_distinct(ordinal).alias("__n"), F.min(ordinal).alias("__l")).where("__n = 1").drop("__n")
    sole = known.groupBy(*record).agg(F.count_distinct(ordinal).alias("__m"), F.min(ordinal).alias("__s")).where("__m = 1").drop("__m")
    j = rows.join(by_label, [*record, label], "left").join(sole, record, "left")
    return j.withColumn("variant", F.coalesce(F.col(ordinal).cast("string"), F.col("__l").cast("string"), F.col("__s").cast("string"), F.concat(F.lit("unaligned: "), F.coalesce(F.col(label), F.lit(""))))).drop("__l", "__s")


def positional(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, position, old, new): rows of a key paired by canonical order, extras alone on their side."""
    w = W.partitionBy(*keys).orderBy("c")
    side = lambda df, name: df.select(*keys, F.struct(*columns).alias(name), canonical(columns).alias("c")).withColumn("position", F.row_number().over(w)).drop("c")
    on = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in [*keys, "position"]]
    joined = side(old, "old").alias("o").join(side(new, "new").alias("n"), on, "full_outer")
    return joined.select(*[F.coalesce(F.col(f"o.{k}"), F.col(f"n.{k}")).alias(k) for k in [*keys, "position"]], "old", "new")


def field_diffs(pairs: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, position, column, old, new, category), one row per difference of ``positional`` pairs; ``*`` for rows alone."""
    one = lambda c: F.struct(F.lit(c).alias("column"), F.col(f"old.{c}").cast("string").alias("old"), F.col(f"new.{c}").cast("string").alias("new"), classify(F.col(f"old.{c}").cast("string"), F.col(f"new.{c}").cast("string")).alias("category"))
    alone = lambda what: F.array(F.struct(F.lit("*").alias("column"), F.lit(None).cast("string").alias("old"), F.lit(None).cast("string").alias("new"), F.lit(what).alias("category")))
    found = F.when(F.col("old").isNull(), alone("added")).when(F.col("new").isNull(), alone("dropped")).otherwise(F.filter(F.array(*map(one, columns)), lambda d: d["category"].isNotNull()))
    return pairs.select(*keys, "position", F.explode(found).alias("d")).select(*keys, "position", "d.*")


def multiset_difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of either side beyond the other's count, with ``side``."""
    a, b = old.exceptAll(new), new.exceptAll(old)
    return a.withColumn("side", F.lit("old")).unionByName(b.withColumn("side", F.lit("new")))


def symmetric_difference(a: DataFrame, b: DataFrame, name_a: str, name_b: str) -> DataFrame:
    """Distinct rows on one side only, with ``side``; null equals null."""
    return a.subtract(b).withColumn("side", F.lit(name_a)).unionByName(b.subtract(a).withColumn("side", F.lit(name_b)))


def greedy_pairs(old: DataFrame, new: DataFrame, group: list[str], keys: list[str], order: str) -> DataFrame:
    """(group, old_id, new_id): each old row, in order, takes the first free new row whose keys are equal or null on a side.

    Greedy assignment depends on what was taken before, so a group runs in one Python call; a group
    is one record's curve, small by nature. Rows without a partner have a null id.
    """
    schema = ", ".join(f"{g} {dict(old.dtypes)[g]}" for g in group) + f", old_id {dict(old.dtypes)[order]}, new_id {dict(old.dtypes)[order]}"
    whole = dict(old.dtypes)[order] in ("bigint", "int")
    a = old.select(*group, *keys, order)
    b = new.select(*group, *keys, order)

    def pair(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        free = right.sort_values(order, kind="stable").to_dict("records")
        rows = []
        for o in left.sort_values(order, kind="stable").to_dict("records"):
            hit = next((n for n in free if all(pd.isna(o[k]) or pd.isna(n[k]) or o[k] == n[k] for k in keys)), None)
            if hit is not None:
                free.remove(hit)
            rows.append((*key, o[order], None if hit is None else hit[order]))
        rows += [(*key, None, n[order]) for n in free]
        out = pd.DataFrame(rows, columns=[*group, "old_id", "new_id"])
        for c in ("old_id", "new_id"):
            out[c] = out[c].astype("Int64") if whole else out[c]
        return out

    return a.groupBy(*group).cogroup(b.groupBy(*group)).applyInPandas(pair, schema)


def verdict(diffs: DataFrame, by: list[str], failing: tuple[str, ...] = ("conflict", "dropped")) -> DataFrame:
    """(by, added, dropped, format, conflict, passed), one row per group and one over all (null)."""
    count = lambda c: F.count_if(F.col("category") == c).alias(c)
    return diffs.rollup(*by).agg(*[count(c) for c in ("added", "dropped", "format", "conflict")], (F.count_if(F.col("category").isin(*failing)) == 0).alias("passed"))


def recheck(current: DataFrame, sheet: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, status) of each sheet row against the present value: absent, matches_old, matches_new or other."""
    j = sheet.join(current.select(*keys, F.col(value).alias("__v")), keys, "left")
    return j.select(*keys, F.when(F.col("__v").isNull(), "absent").when(F.col("__v") == F.col("old"), "matches_old").when(F.col("__v") == F.col("new"), "matches_new").otherwise("other").alias("status"))


