"""Variants of one record: what varies, whether identity holds, and the roll-up to the load grain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def variant_key(ordinal: Column, label: Column, position: Column) -> Column:
    """Ordinal, else label, else the row's position, else ``1``."""
    filled = lambda c: F.when(F.trim(c) != "", F.trim(c))
    return F.coalesce(filled(ordinal), filled(label), position.cast("string"), F.lit("1"))


def variance(rows: DataFrame, record: list[str], variant: str, order: list[str], columns: list[str], tiers: dict[str, str], default: str = "C") -> DataFrame:
    """(record, column, n_values, tier, all_values): columns whose first value per variant differs between variants.

    Values compare as trimmed text, so ``1800`` and ``1,800`` differ. ``all_values`` is a JSON map
    of variant to value. Columns of tier ``allowed`` are left out.
    """
    long = rows.select(*record, variant, *order, F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.trim(F.col(c).cast("string")).alias("value")) for c in columns])).alias("c")).select(*record, variant, *order, "c.*")
    first = long.where("value is not null and value <> ''").groupBy(*record, "column", variant).agg(F.min_by("value", F.struct(*order)).alias("value"))
    found = first.groupBy(*record, "column").agg(F.count_distinct("value").alias("n_values"), F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(variant).cast("string"), F.col("value")))))).alias("all_values")).where("n_values > 1")
    tier = F.lit(default)
    for t in sorted(set(tiers.values())):
        tier = F.when(F.col("column").isin([c for c, x in tiers.items() if x == t]), t).otherwise(tier)
    return found.withColumn("tier", tier).where("tier <> 'allowed'").select(*record, "column", "n_values", "tier", "all_values")


def confirmed_variance(found: DataFrame, observations: DataFrame, record: list[str], column: str, value: str) -> DataFrame:
    """Variances with ``confirmed``: an observation of the same record repeats one of the values (tolerance max(1e-6, 1e-9 x value))."""
    v = F.explode(F.map_values(F.from_json("all_values", "map<string,string>"))).alias("__v")
    nums = found.select(*record, "column", v).select(*record, "column", F.replace("__v", F.lit(","), F.lit("")).try_cast("double").alias("__v"))
    seen = observations.select(*record, F.col(column).alias("column"), F.col(value).alias("__o"))
    hit = nums.join(seen, [*record, "column"]).where(F.abs(F.col("__v") - F.col("__o")) <= F.greatest(F.lit(1e-6), F.abs("__v") * 1e-9)).select(*record, "column").distinct().withColumn("confirmed", F.lit(True))
    return found.join(hit, [*record, "column"], "left").withColumn("confirmed", F.coalesce("confirmed", F.lit(False)))


def identity_sets(rows: DataFrame, record: list[str], variant: str, identity: list[str]) -> DataFrame:
    """(record, n_variants, n_sets, same): whether all variants hold the same multiset of identities; null equals empty text.

    A variant's multiset is carried as its size and sums of two hashes of its members, so a variant
    of any size aggregates partially and never gathers in a list.
    """
    text = F.concat_ws("\u0001", *[F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) for c in identity])
    h = F.xxhash64(text)
    wide = lambda c: c.cast("decimal(20,0)")
    sets = rows.groupBy(*record, variant).agg(F.count("*").alias("n"), F.sum(wide(h)).alias("a"), F.sum(wide(F.xxhash64(F.lit("second"), text))).alias("b"))
    return sets.groupBy(*record).agg(F.count("*").alias("n_variants"), F.count_distinct(F.struct("n", "a", "b")).alias("n_sets")).withColumn("same", F.col("n_sets") == 1)


def chosen_variant(rows: DataFrame, record: list[str], variant: str, rung: Column) -> DataFrame:
    """(record, chosen): the variant on the lowest rung, shorter then lesser names first."""
    return rows.groupBy(*record).agg(F.min(F.struct(rung.alias("r"), F.length(variant).alias("l"), F.col(variant).alias("chosen"))).alias("m")).select(*record, "m.chosen")


def roll_up(sections: DataFrame, record: list[str], model: str, printed: str, order: str) -> DataFrame:
    """One row per record and model (an unresolved one by its printed name): sums, span, first values, worst status.

    A zero stage total is null. Sections without an order come last.
    """
    key = F.coalesce(F.col(model), F.concat(F.lit("printed: "), F.col(printed)))
    by = F.struct(F.coalesce(F.col(order), F.lit(2**31 - 1)), F.col(printed))
    out = sections.withColumn("__k", key).groupBy(*record, "__k").agg(
        F.nullif(F.sum("stages"), F.lit(0)).alias("stages"), F.count("*").alias("housings"), F.min("top").alias("top"), F.max("bottom").alias("bottom"),
        F.min_by(printed, by).alias("first_printed"), F.min(order).alias("first_order"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(by.alias("o"), F.col("stages_list").alias("s")))), lambda x: x["s"]), ", ").alias("stages_list"),
        F.when(F.max((F.col("status") == "conflict").cast("int")) == 1, "conflict").when(F.min((F.col("status") == "validated").cast("int")) == 1, "validated").otherwise("extracted").alias("status"),
    )
    return out.withColumnRenamed("__k", "model_key")


def fill_or_conflict(targets: DataFrame, cascade: DataFrame, on: list[str], target: str, own: str, offered: str, order: str, tolerance: float = 1e-6) -> DataFrame:
    """(on, target, order, disposition) for every offered value in order: filled, duplicate or disagreement.

    The effective value of a target is its own, else the first offered; each offer compares to it.
    Offers of one place in the order go by value.
    """
    joined = targets.select(*on, target, own).join(cascade.select(*on, F.col(offered).alias("__o"), order).where("__o is not null"), on)
    w = W.partitionBy(*on, target).orderBy(order, "__o")
    first = F.first("__o").over(w)
    effective = F.coalesce(F.col(own), first)
    n = F.row_number().over(w)
    out = joined.select(*on, target, order, F.col("__o").alias("offered"), effective.alias("effective"), n.alias("__n"), F.col(own).isNull().alias("__empty"))
    return out.select(*on, target, order, "offered", "effective", F.when(F.col("__empty") & (F.col("__n") == 1), "filled").when(F.abs(F.col("offered") - F.col("effective")) <= tolerance, "duplicate").otherwise("disagreement").alias("disposition"))
