"""Problems 5 and 6."""

from __future__ import annotations

from datetime import datetime

import pytest

from millrace.operators import copy_diff, references


def test_diff(spark):
    schema = "k string, a string, n string, ref string"
    ref = [("1", "x", "10", "z"), ("1", "x", "10", "other"), ("2", None, "1,900 ft", None), ("3", "x", "5 psi", None), (None, "x", "1", None), ("5", "x", "1", None), ("6", "", "400 (400) hp", None)]
    port = [("1", "x", "10", "q"), ("2", "y", "1900 (FT)", None), ("3", None, "5 psig", None), (None, "x", "2", None), ("4", "x", "1", None), ("6", None, "400 hp", None)]
    got = sorted((r.k or "", r.field_name, r.category) for r in copy_diff.diff(spark.createDataFrame(ref, schema), spark.createDataFrame(port, schema), ["k"], ["a", "n"], ["n"]).collect())
    assert got == [("", "n", "conflict"), ("2", "a", "added"), ("2", "n", "format"), ("3", "a", "dropped"), ("3", "n", "conflict"), ("4", "*", "only_port"), ("5", "*", "only_ref"), ("6", "a", "dropped"), ("6", "n", "format")]


def test_diff_of_empty_tables(spark):
    e = spark.createDataFrame([], "k string, a string")
    f = spark.createDataFrame([("1", None)], "k string, a string")
    assert copy_diff.diff(e, e, ["k"], ["a"], []).count() == 0
    assert [r.category for r in copy_diff.diff(e, f, ["k"], ["a"], []).collect()] == ["only_port"]


T = [datetime(2024, m, 1) for m in range(1, 13)]


@pytest.mark.parametrize(
    ("match", "want"),
    [
        ("simple", {2: "missing", 3: "late", 4: "deleted"}),
        ("partial", {2: "missing", 3: "late", 4: "deleted", 6: "missing"}),
        ("full", {2: "missing", 3: "late", 4: "deleted", 5: "incomplete", 6: "incomplete"}),
    ],
)
def test_orphans(spark, match, want):
    listed = [("o", "w", T[2], T[4]), ("o", "w", T[2], T[4]), ("o", "w", T[6], None), ("p", None, T[0], None)]
    targets = spark.createDataFrame(listed, "o string, w string, b timestamp, e timestamp")
    refs = [(1, "o", "w", T[3]), (2, "o", "W", T[3]), (3, "o", "w", T[1]), (4, "o", "w", T[4]), (5, "o", None, T[7]), (6, None, "zz", T[7]), (7, None, None, T[7]), (8, "o", "w", T[6])]
    df = spark.createDataFrame(refs, "id long, o string, w string, at timestamp").selectExpr("*", "'x' as first", "'y' as spans")
    got = {r.id: r.orphan_kind for r in references.orphans(df, targets, ("o", "w"), "at", "b", "e", match).collect()}
    assert got == want
    assert references.orphans(df.where("id < 0"), targets, ("o", "w"), "at", "b", "e", match).count() == 0
    assert references.orphans(df.where("id = 1"), targets.where("o = 'none'"), ("o", "w"), "at", "b", "e", "simple").collect()[0].orphan_kind == "missing"
