"""Problem 6: references to records that do not exist, or not at the time.

A reference is a composite key, parts of which may be null. References are grouped by their null
mask; each mask is joined on its non-null columns only, under the declared match semantics:

* ``simple``  - a reference with any null part is no reference and is never an orphan;
* ``partial`` - the non-null parts must match some target; the all-null reference is never an orphan;
* ``full``    - all parts null is no reference; some parts null is an orphan of kind ``incomplete``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


FAR = "9999-12-31 23:59:59.999999"


def islands(spans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, b, e): spans that overlap or touch made one, so that those of a key are disjoint.

    Merged month by month first: a key that a third of all spans name reaches the second window with
    few rows a month. Both windows stream over sorted rows; nothing is gathered.
    """

    def merged(rows: DataFrame, by: list[str]) -> DataFrame:
        w = W.partitionBy(*by).orderBy("b", "e")
        reach = F.max("e").over(w.rowsBetween(W.unboundedPreceding, -1))
        begins = F.when(reach.isNull() | (F.col("b") > reach), 1).otherwise(0)
        return rows.withColumn("n", begins).withColumn("n", F.sum("n").over(w)).groupBy(*by, "n").agg(F.min("b").alias("b"), F.max("e").alias("e")).drop("n")

    monthly = merged(spans.select(*keys, "b", "e").distinct().withColumn("m", F.date_trunc("month", "b")), [*keys, "m"])
    return merged(monthly.drop("m"), list(keys))


def timeline(targets: DataFrame, keys: Sequence[str], begin: str, end: str) -> DataFrame:
    """(keys, since, until, state): for each key the whole of time cut into ``late``, ``valid`` and ``deleted``.

    A span without begin does not count, one without end is open. The rows of a key never overlap,
    so any moment falls into one of them.
    """
    kind = dict(targets.dtypes)[begin]
    at = lambda t: F.lit(t).cast(kind)
    last = F.greatest(F.coalesce(F.col(end), at(FAR)), F.col(begin))
    whole = islands(targets.where(F.col(begin).isNotNull()).select(*keys, F.col(begin).alias("b"), last.alias("e")), keys)
    w = W.partitionBy(*keys).orderBy("b")
    cut = whole.withColumn("next", F.coalesce(F.lead("b").over(w), at(FAR))).withColumn("first", F.row_number().over(w) == 1)
    state = lambda since, until, name: F.struct(since.alias("since"), until.alias("until"), F.lit(name).alias("state"))
    parts = F.array(F.when(F.col("first"), state(at("0001-01-01 00:00:00"), F.col("b"), "late")), state(F.col("b"), F.col("e"), "valid"), state(F.col("e"), F.col("next"), "deleted"))
    return cut.select(*keys, F.explode(F.filter(parts, lambda p: p.isNotNull() & (p["since"] < p["until"]))).alias("p")).select(*keys, "p.*")


def _month(at: Column) -> Column:
    return F.year(at) * 12 + F.month(at)


def orphans(references: DataFrame, targets: DataFrame, keys: Sequence[str], at: str, begin: str, end: str, match: str = "simple") -> DataFrame:
    """References (all their columns) whose target is not valid at ``at``, with ``orphan_kind``.

    Kinds: ``missing`` (never listed), ``late`` (first listed after ``at``), ``deleted`` (listed
    before, not at ``at``), ``incomplete`` (match ``full`` only). A span holds from its begin until
    just before its end; a null end is open. A reference without a time is judged ``missing`` or
    not at all. Keys compare character by character.

    The targets become a timeline of disjoint rows per key, of which a reference meets one at most.
    The join is an outer join from the references, whose skewed partitions AQE splits, so no key of
    a hot target gathers in one task. A key with a part missing has a longer timeline; it is
    joined by month as well, so that a reference meets only the rows of its month.
    """
    if match not in ("simple", "partial", "full"):
        raise ValueError(match)
    n = len(keys)
    masks = [m for m in range(1 << n) if m == 0 or (match == "partial" and m != (1 << n) - 1)]
    kind = dict(targets.dtypes)[begin]
    moment = F.coalesce(F.col(at).cast(kind), F.lit("0001-01-01 00:00:00").cast(kind))
    span = references.agg(F.min(_month(moment)), F.max(_month(moment))).first() if len(masks) > 1 else (None, None)
    out = None
    for mask in masks:
        held = [k for i, k in enumerate(keys) if not mask >> i & 1]
        chosen = references
        for i, k in enumerate(keys):
            chosen = chosen.where(F.col(k).isNull() if mask >> i & 1 else F.col(k).isNotNull())
        known = timeline(targets.dropna(subset=held), held, begin, end).select(*[F.col(k).alias(f"__t_{k}") for k in held], F.col("since").alias("__since"), F.col("until").alias("__until"), F.col("state").alias("__state"))
        chosen = chosen.withColumn("__moment", moment)
        on = [F.col(k) == F.col(f"__t_{k}") for k in held]
        if mask and span[0] is not None:
            months = F.sequence(F.greatest(_month(F.col("__since")), F.lit(span[0])), F.least(_month(F.col("__until")), F.lit(span[1])))
            known = known.where((_month(F.col("__since")) <= span[1]) & (_month(F.col("__until")) >= span[0])).withColumn("__m", F.explode(months))
            on.append(_month(F.col("__moment")) == F.col("__m"))
        on += [F.col("__since") <= F.col("__moment"), F.col("__moment") < F.col("__until")]
        joined = chosen.join(known, on, "left")
        found = F.when(F.col("__state").isNull(), "missing").when((F.col("__state") != "valid") & F.col(at).isNotNull(), F.col("__state"))
        part = joined.select(*references.columns, found.alias("orphan_kind")).where("orphan_kind is not null")
        out = part if out is None else out.unionByName(part)
    if match == "full":
        some = references.where(" or ".join(f"`{k}` is null" for k in keys)).where(" or ".join(f"`{k}` is not null" for k in keys))
        out = out.unionByName(some.withColumn("orphan_kind", F.lit("incomplete")))
    return out


def report(found: DataFrame) -> DataFrame:
    """(table_name, period, orphan_kind, n_rows)."""
    return found.groupBy("table_name", "period", "orphan_kind").agg(F.count("*").alias("n_rows"))
