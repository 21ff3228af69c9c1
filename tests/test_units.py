"""Problem 1: stated units, and silent unit changes."""

from __future__ import annotations

import math
from datetime import date, datetime, timedelta

import numpy as np
import pytest

from millrace.operators import unit_history as U

HEADS = "obs_id long, head_as_printed string, head_unit_as_printed string, scenario_title_as_printed string, head string"
POINTS = "context_id long, bubble_point_psi string, bubble_point_unit_as_printed string, bubble_point_provenance string"

HEAD_CASES = [
    # value, column, title -> feet, changed
    ("1,000.5", "ft", None, 1000.5, False), ("100 m", "ft", None, 328.084, True), ("100", "m", None, 328.084, True), ("100 ft", "m", None, 100.0, False),
    ("100", None, "Case 1 - heads in metres", 328.084, True), ("100", None, "Run 2: tubing 1,200 metres, head ft", 100.0, False), ("100", None, "KB 30 m above sea level", 100.0, False),
    ("100", None, "KB 25 ft, heads below as mtr", 328.084, True), ("100", None, "Case 3: H [m], Q [bpd]", 328.084, True), ("100", None, "SI sheet: flow m3/d; head ft", 100.0, False),
    ("1.5 (10^3 ft)", None, None, 1500.0, True), ("1.5", "x1000 ft", None, 1500.0, True), ("1.5", "1000 ft", None, 1500.0, True), ("100 ft (30 m)", "m", None, 100.0, False),
    ("917,4 m.", None, None, 917.4 * 3.280839895, True), ("0 m", None, None, 0.0, False), ("", "m", None, None, False), ("n/a", "m", None, None, False), ("10-20", "m", None, None, False),
    ("5 to 9 m", None, None, None, False), (None, "m", None, None, False), ("900 psi", "ft", None, None, False), ("900", "PSIG", None, None, False), ("12 in", None, None, 1.0, True), ("50'", None, None, 50.0, False),
]
POINT_CASES = [
    ("2000", "psi", None, 2000.0, False), ("2000 psig", "psia", None, 2014.7, True), ("2000", "psi(g)", None, 2014.7, True), ("100", "bar", None, 1450.377, True), ("2.5", "ksi", None, 2500.0, True),
    ("2000", None, "stated psig at reservoir temp.", 2014.7, True), ("2000", None, "from client mail - gauge psi", 2014.7, True), ("2000", None, "offset well, 9 bar tubing head", 2000.0, False),
    ("2000", None, "correlation, psia", 2000.0, False), ("100", None, "kgf/cm2 per PVT cell", 1422.334, True), ("9 - 12 bar", None, None, None, False), ("100.5kgf/cm²", None, None, 1429.446, True), ("5 lb/in2", None, None, 5.0, False),
]


def test_heads(spark):
    rows = [(i, *c[:3], "own") for i, c in enumerate(HEAD_CASES)]
    got = {r.obs_id: r.head for r in U.convert_heads(spark.createDataFrame(rows, HEADS)).collect()}
    for i, c in enumerate(HEAD_CASES):
        assert got[i].changed == c[4], c
        assert (got[i].value is None) == (c[3] is None), c
        assert c[3] is None or got[i].value == pytest.approx(c[3], rel=1e-4), c


def test_bubble_points(spark):
    rows = [(i, *c[:3]) for i, c in enumerate(POINT_CASES)]
    got = {r.context_id: r.bubble_point for r in U.convert_bubble_points(spark.createDataFrame(rows, POINTS)).collect()}
    for i, c in enumerate(POINT_CASES):
        assert got[i].changed == c[4], (c, got[i])
        assert c[3] is None or got[i].value == pytest.approx(c[3], rel=1e-4), c


def test_empty_tables(spark):
    assert U.found(spark.createDataFrame([], HEADS), spark.createDataFrame([], POINTS)).count() == 0


def test_partition_is_optimal():
    rng = np.random.default_rng(3)
    for _ in range(40):
        n = int(rng.integers(1, 9))
        x, w, penalty = rng.normal(size=n).round(2), rng.integers(1, 4, n).astype(float), float(rng.uniform(0.05, 1))

        def cost(starts):
            edges = [*starts, n]
            return sum(float(np.sum(w[a:b] * (x[a:b] - np.average(x[a:b], weights=w[a:b])) ** 2)) + penalty for a, b in zip(edges, edges[1:], strict=False))

        best = min(cost([0, *[i + 1 for i in range(n - 1) if mask >> i & 1]]) for mask in range(1 << (n - 1)))
        assert cost(U.optimal_partition(x, w, np.zeros(n), penalty)) == pytest.approx(best)


def test_silent_change_is_found(spark):
    rng = np.random.default_rng(1)
    day = datetime(2024, 1, 1)
    rows = [(i, str(round(float(2000 * math.exp(rng.normal(0, 0.05)) / (6.894757 if False else 1) * (1 if i < 60 or i > 90 else 6.894757)), 1)), None, None, day + timedelta(days=i)) for i in range(150)]
    df = spark.createDataFrame(rows, POINTS + ", loaded_at timestamp").selectExpr("*", "'o' as organization_id", "'w' as well_id")
    levels = U.daily_levels(U.convert_bubble_points(df), "bubble_point", df.well_id, df.loaded_at, U.F.col("bubble_point.value"))
    got = sorted(U.segments(levels).collect(), key=lambda r: r.segment_no)
    assert [r.unit_change for r in got] == [None, "kPa", None]
    assert got[1].from_day == date(2024, 3, 1)
    assert got[1].reverse_by == pytest.approx(1 / 6.894757, rel=1e-3)


def test_change_within_a_day_is_found(spark):
    start = datetime(2024, 1, 1)
    # six hours apart: kPa from row 61 to row 90, begun and ended within a day
    rows = [(i, str(round(2000 * (1 + 0.03 * math.sin(i)) * (6.894757 if 61 <= i <= 90 else 1), 1)), None, None, start + timedelta(hours=6 * i), f"d{i // 4}", "o", "w") for i in range(150)]
    points = spark.createDataFrame(rows, POINTS + ", loaded_at timestamp, source_document string, organization_id string, well_id string")
    heads = spark.createDataFrame([], HEADS + ", head_basis_as_printed string, loaded_at timestamp, source_document string, organization_id string, well_id string")
    got = sorted(U.histories(heads, points).collect(), key=lambda r: r.segment_no)
    assert [(r.unit_change, r.n_rows) for r in got] == [(None, 61), ("kPa", 30), (None, 59)]
    assert (got[1].from_at, got[1].to_at) == (start + timedelta(hours=6 * 61), start + timedelta(hours=6 * 90))


def test_documents_of_one_day_are_not_averaged(spark):
    start = datetime(2024, 1, 1)
    # each day ends with a document in another unit than the one before it, loaded at the same second
    rows = [(i, str(round(2000 * (1 + 0.03 * math.sin(i)) * (6.894757 if i % 60 >= 45 else 1), 1)), None, None, start + timedelta(days=i // 60), f"d{i // 15:03d}", "o", "w") for i in range(180)]
    points = spark.createDataFrame(rows, POINTS + ", loaded_at timestamp, source_document string, organization_id string, well_id string")
    levels = U.load_levels(U.convert_bubble_points(points), "bubble_point", points.well_id, points.loaded_at, U.F.col("bubble_point.value"), points.source_document)
    assert levels.count() == 12
    got = sorted(U.segments(levels).collect(), key=lambda r: r.segment_no)
    assert [(r.unit_change, r.n_rows) for r in got] == [(None, 45), ("kPa", 15)] * 3


def wells(spark, series):
    """Contexts of wells with one bubble point a month each, as printed."""
    start, rows = datetime(2024, 1, 1), []
    for well, values in series.items():
        rows += [(1000 * i + len(rows), str(v), None, None, start + timedelta(days=30 * i), (start + timedelta(days=30 * i)).strftime("%Y-%m-%d"), f"d{i}", "o", well) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, POINTS + ", loaded_at timestamp, effective_from string, source_document string, organization_id string, well_id string")


def no_heads(spark):
    return spark.createDataFrame([], HEADS + ", head_basis_as_printed string, loaded_at timestamp, source_document string, organization_id string, well_id string")


def test_unstated_units_of_single_rows_are_put_right(spark):
    series = {"a": [2000, 2000, 13789.5, 2000, 2000], "b": [3000, 206.84, 3000, 3000.1], "c": [1859.3, 1859.3, 1844.6, 1859.3], "d": [1500, 1500, 2100, 2100, 2100], "e": [900], "f": [1200, 1200, 82.74, 1900, 1900, 1900]}
    points = wells(spark, series)
    got = {(r.table_name, r.row_id): r for r in U.converted(no_heads(spark), points).collect()}
    by_well = {}
    for r in points.collect():
        by_well.setdefault(r.well_id, []).append(got["esp_well_design_context", r.context_id])
    named = {w: [x.silent_unit for x in sorted(rs, key=lambda x: x.row_id)] for w, rs in by_well.items()}
    assert named == {"a": [None, None, "kPa", None, None], "b": [None, "bar", None, None], "c": [None, None, "psig", None], "d": [None] * 5, "e": [None], "f": [None, None, "bar", None, None, None]}
    assert all(r.restored == pytest.approx(v, rel=2e-3) for w, v in (("a", 2000), ("b", 3000), ("c", 1859.3)) for r in by_well[w])


def test_found_asks_the_history_where_a_unit_is_not_read(spark):
    """A unit text that no vocabulary knows is decided by the level of its segment; no unit at all and known units are not."""
    kpa = 13789.5
    printed = {
        "a": [("2000", None), ("2000", None), (f"{kpa} kpascal", None), ("2000", None), ("2000", None)],  # unknown word in the cell, level of kPa
        "b": [("2000", None), ("2000", None), (str(kpa), "kilopasc."), ("2000", None), ("2000", None)],  # the same in the column
        "c": [("2000", None), ("2000", None), (str(kpa), None), ("2000", None), ("2000", None)],  # no unit: no case, only put right
        "d": [("2000", None), ("2000", None), ("2000 pnds", None), ("2000", None), ("2000", None)],  # unknown word, right level
        "e": [("2000", None), ("2000", None), (str(kpa), "psia"), ("2000", None), ("2000", None)],  # a stated unit holds
        "f": [("2000", None), ("2000", None), (str(kpa), "kPa"), ("2000", None), ("2000", None)],
        "g": [("2000", None), ("2000", None), ("1985.3 psi (gge)", None), ("2000", None), ("2000", None)],  # 14.7 below: a gauge
        "h": [("2000 fathoms?", None)],  # no history to ask
    }
    points = wells(spark, {w: [v for v, _ in rows] for w, rows in printed.items()})
    units = {(w, f"d{i}"): u for w, rows in printed.items() for i, (_, u) in enumerate(rows)}
    points = spark.createDataFrame([r.asDict() | {"bubble_point_unit_as_printed": units[r.well_id, r.source_document]} for r in points.collect()], points.schema)
    well = {r.context_id: (r.well_id, r.source_document) for r in points.collect()}
    got = sorted(U.found(no_heads(spark), points).collect())
    assert [(r.table_name, *well[r.row_id]) for r in got] == [("esp_well_design_context", w, "d2") for w in "abfg"]
    restored = {well[r.row_id]: r.restored for r in U.converted(no_heads(spark), points).collect()}
    assert all(restored[w, "d2"] == pytest.approx(2000, rel=2e-3) for w in "abcdfg")


def test_blocks_of_a_long_history(monkeypatch):
    """A history cut in blocks, some of whose borders fall inside a segment, gives the segments of the whole."""
    at = datetime(2024, 1, 1)
    level = [math.log(2000 * (1 + 0.001 * math.sin(i)) * (6.894757293 if 150 <= i < 210 else 1)) for i in range(400)]
    pdf = U.pd.DataFrame([("bubble_point", "w", at + timedelta(days=i), f"{i:05d}", 1.0, x, 0.0) for i, x in enumerate(level)], columns=["quantity", "source", "at", "key", "n", "level", "spread"])

    def cut():
        blocks = U.pd.concat(U._cut_blocks(iter([pdf[:130], pdf[130:]])))
        return len(blocks), [(r.n_rows, r.unit_change, r.from_key) for r in U.pd.concat(U._cut_histories(iter([blocks]))).itertuples()]

    _, whole = cut()
    monkeypatch.setattr(U, "BLOCK", 60)
    n_blocks, parts = cut()
    assert n_blocks >= 7
    assert parts == whole == [(150, None, "00000"), (60, "kPa", "00150"), (190, None, "00210")]
