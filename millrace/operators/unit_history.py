"""Problem 1: one unit for a quantity recorded in several.

Two stages:

* ``convert_heads`` / ``convert_bubble_points`` read the unit each row states (with the number,
  beside it or in nearby text) and convert. This alone settles what is *stated*.
* ``segments`` looks for what is *not* stated: each source's history of log values, row by row, is
  cut by exact penalised changepoint search, and a level that stands off that of most rows by a known
  factor is a silent change of unit, reported with the factor that reverses it.

``found`` and ``converted`` go through both. The second stage cannot contradict a stated unit (a unit stated
for one row inside an unbroken history is no level shift), so it decides rows whose unit the first could not
read, and in ``converted`` those that print none; the README gives figures.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.dates import printed_day
from millrace.functions.units import convert, head_unit_in_title, pressure_unit_in_note
from millrace.session import cut

# What a number printed in each unit is times the same quantity in feet or psia.
KNOWN_FACTORS = {
    "head": {"m": 1 / 3.280839895013123, "km": 1 / 3280.839895013123, "kft": 1 / 1000.0, "in": 12.0, "cm": 30.48, "mm": 304.8},
    "bubble_point": {"kPa": 6.894757293, "bar": 1 / 14.50377377, "MPa": 1 / 145.0377377, "ksi": 1 / 1000.0, "kg/cm2": 1 / 14.22334331, "atm": 1 / 14.69594878},
}

# What places a row in a history; null where a table lacks it.
_HISTORY = {"organization_id": "string", "well_id": "string", "head_basis_as_printed": "string", "effective_from": "string", "source_document": "string", "loaded_at": "timestamp"}

SEGMENT_SCHEMA = "quantity string, source string, segment_no int, from_day date, to_day date, from_at timestamp, to_at timestamp, n_rows long, mean_value double, shift double, unit_change string, reverse_by double, from_key string, to_key string"
_BLOCK_SCHEMA = "quantity string, source string, from_at timestamp, to_at timestamp, from_key string, to_key string, n double, level double, spread double, noise double"


def convert_heads(observations: DataFrame) -> DataFrame:
    """Each observation with ``head`` = struct<number, unit, unit_from, value, changed, reason>.

    Null or empty heads give a null value with a reason; rows are neither dropped nor merged, and
    other columns, whatever their names, pass through (a column ``head`` is replaced).
    """
    return convert(observations, F.col("head_as_printed"), F.col("head_unit_as_printed"), F.col("scenario_title_as_printed"), head_unit_in_title, "length", "head")


def convert_bubble_points(contexts: DataFrame) -> DataFrame:
    """Each context with ``bubble_point`` = struct<number, unit, unit_from, value, changed, reason>; as ``convert_heads``."""
    return convert(contexts, F.col("bubble_point_psi"), F.col("bubble_point_unit_as_printed"), F.col("bubble_point_provenance"), pressure_unit_in_note, "pressure", "bubble_point")


def load_levels(rows: DataFrame, quantity: str, source: Column, at: Column, value: Column, document: Column | None = None, unit: Column | None = None) -> DataFrame:
    """(quantity, source, at, document, unit, n, level, spread): mean and variance of log values at the finest grain that shares a unit.

    Rows of one source are averaged only if they agree in time, document and unit, so a history is
    about as long as its rows. Partial aggregation runs before the shuffle and merges repeats.
    """
    none = F.lit(None).cast("string")
    picked = rows.select(
        source.alias("source"), at.cast("timestamp").alias("at"), (none if document is None else document).alias("document"), (none if unit is None else unit).alias("unit"), F.log(value).alias("v")
    ).where("v is not null and at is not null and source is not null")
    return (
        picked.groupBy("source", "at", "document", "unit")
        .agg(F.count("v").alias("n"), F.avg("v").alias("level"), F.coalesce(F.var_pop("v"), F.lit(0.0)).alias("spread"))
        .withColumn("quantity", F.lit(quantity))
    )


def row_levels(rows: DataFrame, quantity: Column, source: Column, at: Column, value: Column, document: Column, row_id: Column) -> DataFrame:
    """As ``load_levels``, one row each, with ``row_id``; rows stand in order of time, document and id."""
    return rows.select(
        quantity.alias("quantity"), source.alias("source"), at.cast("timestamp").alias("at"), document.alias("document"), F.lit(None).cast("string").alias("unit"), F.lit(1).cast("long").alias("n"), F.log(value).alias("level"),
        F.lit(0.0).alias("spread"), row_id.cast("long").alias("row_id"),
    ).where("level is not null and at is not null and source is not null")


def daily_levels(rows: DataFrame, quantity: str, source: Column, at: Column, value: Column) -> DataFrame:
    """``load_levels`` by the day, for sources whose days never mix units."""
    return load_levels(rows, quantity, source, F.to_date(at), value)


def optimal_partition(level: np.ndarray, weight: np.ndarray, spread: np.ndarray, penalty: float) -> list[int]:
    """Starts of the segments that minimise weighted squared error + penalty per segment (exact, PELT pruning)."""
    n = len(level)
    if n == 0:
        return []
    total = float(weight.sum())
    if n == 1 or float(weight @ (level * level + spread)) - float(weight @ level) ** 2 / total <= penalty:
        return [0]  # a second segment costs the penalty, more than all there is to save
    w = np.concatenate(([0.0], np.cumsum(weight)))
    s1 = np.concatenate(([0.0], np.cumsum(weight * level)))
    s2 = np.concatenate(([0.0], np.cumsum(weight * (level * level + spread))))
    best = np.empty(n + 1)
    best[0] = -penalty
    back = np.zeros(n + 1, dtype=np.int64)
    live = np.array([0])
    for t in range(1, n + 1):
        dw = w[t] - w[live]
        d1 = s1[t] - s1[live]
        cost = best[live] + (s2[t] - s2[live]) - d1 * d1 / dw
        i = int(np.argmin(cost))
        best[t] = cost[i] + penalty
        back[t] = live[i]
        live = np.append(live[cost <= best[t]], t)  # a start that loses by the penalty can never win again
    starts, t = [], n
    while t > 0:
        t = int(back[t])
        starts.append(t)
    return starts[::-1]


STRENGTH = 3.0  #: times the usual penalty variance * log(n)
LEAST_NOISE = 5e-4  #: of log values, about that of printed digits
TOLERANCE = (0.004, 0.08)  #: least and most distance of a level shift from a known factor, in log units
#: Rows of one source that are cut at once. A longer history is cut block by block, then its segments once more.
BLOCK = 4_000
ATMOSPHERE_PSI = 14.7


def _noise(level: np.ndarray) -> float:
    """Standard deviation from the smaller quarter of the differences of neighbours, which level shifts hardly touch."""
    return max(float(np.quantile(np.abs(np.diff(level)), 0.25, method="lower")) / 0.4506, LEAST_NOISE) if len(level) > 2 else LEAST_NOISE


def _penalty(noise: float, spread: np.ndarray, n: np.ndarray, total: float) -> float:
    """Penalty of a segment: known variance times the log of the number of rows."""
    within = float(np.average(spread, weights=n))
    return STRENGTH * max(noise * noise * float(np.mean(n)), within) * math.log(max(total, 2.0))


def _cut_block(rows: list[tuple]) -> list[tuple]:
    """Segments of (quantity, source, at, key, n, level, spread) rows of one source, by exact penalised search."""
    n, level, spread = (np.array([r[i] for r in rows], float) for i in (4, 5, 6))
    noise = _noise(level)
    starts = optimal_partition(level, n, spread, _penalty(noise, spread, n, n.sum()))
    out = []
    for a, b in zip(starts, [*starts[1:], len(rows)], strict=True):
        w = n[a:b]
        mean = float(np.average(level[a:b], weights=w))
        var = float(np.average(spread[a:b] + (level[a:b] - mean) ** 2, weights=w))
        out.append((rows[a][0], rows[a][1], rows[a][2], rows[b - 1][2], rows[a][3], rows[b - 1][3], float(w.sum()), mean, var, noise))
    return out


def _cut_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Segments of each source's rows in a sorted partition, at most BLOCK rows at once."""
    names = [x.split()[0] for x in _BLOCK_SCHEMA.split(", ")]
    held: list[tuple] = []
    for pdf in batches:
        out = []
        for row in pdf[["quantity", "source", "at", "key", "n", "level", "spread"]].itertuples(index=False, name=None):
            if held and (len(held) >= BLOCK or held[-1][:2] != row[:2]):
                out += _cut_block(held)
                held = []
            held.append(row)
        yield pd.DataFrame(out, columns=names)
    if held:
        yield pd.DataFrame(_cut_block(held), columns=names)


def _base(level: np.ndarray, n: np.ndarray, width: float) -> float:
    """The level at which most rows stand: of all windows of ``width`` over the sorted levels the heaviest one's mean."""
    order = np.argsort(level, kind="stable")
    x, w = level[order], n[order]
    total = np.concatenate(([0.0], np.cumsum(w)))
    end = np.searchsorted(x, x + width, "right")
    i = int(np.argmax(total[end] - total[np.arange(len(x))]))
    return float(np.average(x[i : end[i]], weights=w[i : end[i]]))


def _named(quantity: str, shift: float, base: float, tolerance: float) -> tuple[str | None, float]:
    """(unit, factor that reverses it) of a level shift from ``base``, the nearest within the tolerance."""
    near = [(abs(shift - math.log(f)), unit, 1 / f) for unit, f in KNOWN_FACTORS[quantity].items()]
    gauge = math.exp(base) - ATMOSPHERE_PSI
    if quantity == "bubble_point" and gauge > 0:
        lower = math.log(gauge) - base
        if abs(shift - lower) < min(tolerance, 0.2 * abs(lower)):
            near.append((abs(shift - lower), "psig", math.exp(-lower)))
    d, unit, reverse = min(near)
    return (unit, reverse) if d < tolerance else (None, 1.0)


def _cut_history(rows: list[tuple]) -> list[tuple]:
    """Segments of one source's whole history, from those of its blocks, and the known factors their levels stand off by.

    The level of most rows is taken as right; a lasting true change is followed, in that a level
    which is no known factor away from it is right too, and a segment may stand off the right level
    before it or the one after it, if that one is as long. A level
    that noise leaves less certain than TOLERANCE allows is not named.
    """
    quantity, source = rows[0][:2]
    n, level, spread, noises = (np.array([r[i] for r in rows], float) for i in (6, 7, 8, 9))
    noise = max(float(np.average(noises, weights=n)), LEAST_NOISE)
    starts = optimal_partition(level, n, spread, STRENGTH * noise * noise * math.log(max(n.sum(), 2.0)))
    ends = [*starts[1:], len(level)]
    weight = np.array([n[a:b].sum() for a, b in zip(starts, ends, strict=True)])
    mean = np.array([float(np.average(level[a:b], weights=n[a:b])) for a, b in zip(starts, ends, strict=True)])
    base = _base(mean, weight, max(TOLERANCE[0], noise))
    out, right = [], base
    for k, (a, b) in enumerate(zip(starts, ends, strict=True)):
        tolerance = max(TOLERANCE[0], 2.5 * noise / math.sqrt(weight[k]))
        unit, reverse = None, 1.0
        after = [mean[k + 1]] if k + 1 < len(mean) and weight[k + 1] >= weight[k] else []
        for level_there in (base, right, *after) if tolerance <= TOLERANCE[1] else ():
            if unit is None:
                unit, reverse = _named(quantity, mean[k] - level_there, level_there, tolerance)
        if unit is None:
            right = mean[k]
        begun, done = rows[a][2], rows[b - 1][3]
        out.append((quantity, source, k + 1, begun.date(), done.date(), begun, done, int(weight[k]), math.exp(mean[k]), mean[k] - base, unit, reverse, rows[a][4], rows[b - 1][5]))
    return out


def _cut_histories(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Segments of every source of a partition sorted by source and key, from the segments of blocks."""
    names = [x.split()[0] for x in SEGMENT_SCHEMA.split(", ")]
    held: list[tuple] = []
    for pdf in batches:
        out = []
        for row in pdf.itertuples(index=False, name=None):
            if held and held[-1][:2] != row[:2]:
                out += _cut_history(held)
                held = []
            held.append(row)
        yield pd.DataFrame(out, columns=names)
    if held:
        yield pd.DataFrame(_cut_history(held), columns=names)


def keyed(levels: DataFrame) -> DataFrame:
    """``levels`` with ``key``, a text by which the rows of a source stand in order of time, document, unit and id."""
    ident = F.lpad(F.col("row_id").cast("string"), 20, "0") if "row_id" in levels.columns else F.lit("")
    return levels.withColumn("key", F.concat_ws("\u0001", F.date_format("at", "yyyyMMddHHmmssSSSSSS"), F.coalesce("document", F.lit("")), F.coalesce("unit", F.lit("")), ident))


def segments(levels: DataFrame) -> DataFrame:
    """Segments of every source in ``load_levels`` form; an empty input gives no rows.

    Rows are ranged over partitions by source and order, so a source that holds a third of all rows
    is spread over many tasks; each cuts its stretch exactly, block by block, and sends segments as
    counts, means and variances. One task then cuts a source's segments exactly once more, which
    joins those that a border between blocks parted.
    """
    order = ["quantity", "source", "key"]
    ranged = keyed(levels).select(*order, "at", F.col("n").cast("double").alias("n"), "level", "spread").repartitionByRange(*order).sortWithinPartitions(*order)
    blocks = ranged.mapInPandas(_cut_blocks, _BLOCK_SCHEMA)
    return blocks.repartition("quantity", "source").sortWithinPartitions("quantity", "source", "from_key").mapInPandas(_cut_histories, SEGMENT_SCHEMA)


def silent_changes(levels: DataFrame) -> DataFrame:
    """(quantity, row_id, unit_change, reverse_by) of the rows of ``row_levels`` that stand in a segment off by a known factor.

    Few segments are off, so the join on the source meets few rows of the right side.
    """
    off = segments(levels).where("unit_change is not null").select("quantity", "source", "from_key", "to_key", "unit_change", "reverse_by")
    rows = keyed(levels).select("quantity", "source", "key", "row_id")
    return rows.join(off, ["quantity", "source"]).where(F.col("key").between(F.col("from_key"), F.col("to_key"))).select("quantity", "row_id", "unit_change", "reverse_by")


def found(observations: DataFrame, contexts: DataFrame) -> DataFrame:
    """(table_name, row_id) of rows whose printed number must change to be in feet or psia.

    The unit a row states decides. Where the text in a unit's place names none known, the segment decides
    in which the row stands: off by a known factor, its number must change. A row that prints no unit
    at all is no case by definition, whatever its segment says (``converted`` puts it right). Every
    row is in its history, which is cut whole.
    """
    unread = F.col("unit").isNotNull() & F.col("unit_from").isNull() & F.col("value").isNotNull()
    rows = cut(_well_rows(observations, contexts).select("table_name", "row_id", "quantity", "source", "at", "document", "value", "changed", unread.alias("unread")))
    return _with_silent(rows).where("changed or (unread and silent_unit is not null)").select("table_name", "row_id")


def converted(observations: DataFrame, contexts: DataFrame) -> DataFrame:
    """Every row's quantity: (table_name, row_id, quantity, number, unit, unit_from, value, reason, silent_unit, restored).

    ``value`` follows the stated unit. ``silent_unit`` names the unit of a row that stands in a segment
    off by a known factor although it states none, and ``restored`` is its value put right; else
    ``restored`` is ``value``. Rows are converted once and written to the shared folder, since the
    histories read them again.
    """
    rows = cut(_well_rows(observations, contexts))
    both = _with_silent(rows)
    unstated = F.col("unit_from").isNull() & F.col("silent_unit").isNotNull()
    name = F.when(F.col("quantity") == "head", "head_ft").otherwise("bubble_point_psia")
    return both.select(
        "table_name", "row_id", name.alias("quantity"), "number", "unit", "unit_from", "value", "reason",
        F.when(unstated, F.col("silent_unit")).alias("silent_unit"), F.when(unstated, F.col("value") * F.col("reverse_by")).otherwise(F.col("value")).alias("restored"),
    )


def _well_rows(observations: DataFrame, contexts: DataFrame) -> DataFrame:
    """Converted rows of both quantities with the history they belong to: (table_name, row_id, quantity, source, at, document, number, unit, unit_from, value, changed, reason).

    A history is a well's (of heads a well's and basis's), in order of the day its rows speak of where
    they state one, else of loading. Rows without organisation or well have no source.
    """
    observations, contexts = (t.withColumns({c: F.lit(None).cast(kind) for c, kind in _HISTORY.items() if c not in t.columns}) for t in (observations, contexts))
    named = F.col("organization_id").isNotNull() & F.col("well_id").isNotNull()
    well = F.concat_ws(" | ", "organization_id", "well_id")
    day = F.coalesce(printed_day(F.col("effective_from")).cast("timestamp"), F.col("loaded_at").cast("timestamp"))

    def one(rows: DataFrame, table: str, quantity: str, ident: str, source: Column, at: Column) -> DataFrame:
        kept = [F.lit(table).alias("table_name"), F.col(ident).alias("row_id"), F.lit(quantity).alias("quantity"), F.when(named, source).alias("source"), at.cast("timestamp").alias("at"), F.col("source_document").alias("document")]
        return rows.select(*kept, *[F.col(f"{quantity}.{c}") for c in ("number", "unit", "unit_from", "value", "changed", "reason")])

    heads = one(convert_heads(observations), "stg_curve_observations", "head", "obs_id", F.concat_ws(" | ", well, F.coalesce("head_basis_as_printed", F.lit(""))), F.col("loaded_at"))
    return heads.unionByName(one(convert_bubble_points(contexts), "esp_well_design_context", "bubble_point", "context_id", well, day))


def _levels(rows: DataFrame, field: str) -> DataFrame:
    """Rows of ``_well_rows`` as ``row_levels``: loads come late and heads differ from point to point, so nothing is averaged."""
    return row_levels(rows, F.col("quantity"), F.col("source"), F.col("at"), F.col(field), F.col("document"), F.col("row_id"))


def _well_levels(observations: DataFrame, contexts: DataFrame, field: str = "value") -> DataFrame:
    return _levels(_well_rows(observations, contexts), field)


def _with_silent(rows: DataFrame) -> DataFrame:
    """All of ``rows`` with ``silent_unit`` and ``reverse_by`` of those that stand in a segment off by a known factor."""
    off = silent_changes(_levels(rows, "value")).select("quantity", "row_id", F.col("unit_change").alias("silent_unit"), "reverse_by")
    return rows.join(off, ["quantity", "row_id"], "left")


def histories(observations: DataFrame, contexts: DataFrame, printed: bool = False) -> DataFrame:
    """Segments of both quantities per well; ``printed`` takes the numbers before conversion."""
    return segments(_well_levels(observations, contexts, "number" if printed else "value"))
