"""Problem 7: one form for texts that look the same."""

from __future__ import annotations

from millrace.llm import lookalike as L

SAME = [("Kinén 1880N", "Kinén 1880N"), ("PUMP 5", "РUМР 5"), ("A-1", "Ａ‑1"), ("flow", "ﬂow"), ("a b", "a b"), ("221 °F", "221 ˚F"), ("it's", "it’s"), ("LULOV-7660", "L﻿U‌LOV−7660"), ("x", "​x"), ("ü", "u‍̈")]
OTHER = [("Abc", "abc"), ("a  b", "a b"), ("O1", "01"), ("l", "1"), ("Kinen", "Kinén"), ("насос", "nacoc"), ("a", None), (None, None)]


def test_pairs(spark):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(SAME + OTHER + [(" x", "x "), ("x", " x")])], "id int, a string, b string")
    assert sorted(r.id for r in L.differing_pairs(df, "a", "b").collect()) == list(range(len(SAME)))


def test_classes(spark):
    rows = [(1, "Kinén", 1), (2, "Kinén", 1), (3, "Kinén ", 1), (4, "kinén", 1), (5, None, 1), (6, "", 1), (7, " ", 1), (8, "same", 1), (9, "same", 1), (10, "Кinén", 1), (11, "y" * 200_000, 1)]
    df = spark.createDataFrame(rows, "id int, t string, canonical int")
    assert sorted(r.id for r in L.differing_texts(df, "t").collect()) == [1, 2, 3, 10]
    got = {r.id: (r.canonical, r.n_stored) for r in L.canonical_form(df, "t").collect()}
    assert len(got) == len(rows)
    assert got[1] == got[2] == got[3] == got[10] == ("Kinén", 3)
    assert got[4] == ("kinén", 1)
    assert got[5] == (None, None)
    assert got[6][0] == got[7][0] == ""
    assert L.differing_texts(df.where("id < 0"), "t").count() == 0


def test_composed_letters_of_other_scripts_and_more_signs(spark):
    pairs = ["\u0388 \u00c9", "\u03cc \u00f3", "\u04e7 \u00f6", "\u04d3 \u00e4", "\u0450 \u00e8", "\u03b1 a", "\u03c1 p"]
    rows = [(i, *x.split(" ")) for i, x in enumerate(pairs)] + [(20, "a\u2012b", "a-b"), (21, "a\u2013b", "a-b"), (22, "a\u2028b", "a\nb")]
    apart = [(30, "\u03b6", "z"), (31, "\u043a", "k"), (32, "\u0443\u0301", "\u00fd "), (33, "a\u2014b", "a-b")]
    df = spark.createDataFrame(rows + apart, "id int, a string, b string")
    assert sorted(r.id for r in L.differing_pairs(df, "a", "b").collect()) == [r[0] for r in rows] + [32]


def test_pairs_keep_rows_and_columns(spark):
    df = spark.createDataFrame([(1, "\u0420", "P", "x", "y")] * 3 + [(2, None, "P", "x", "y")], "id int, a string, b string, __x string, canonical string")
    got = L.differing_pairs(df.drop("__x"), "a", "b")
    assert got.columns == ["id", "a", "b", "canonical"]
    assert [r.id for r in got.collect()] == [1, 1, 1]
    assert L.differing_pairs(df.where("id < 0").drop("__x"), "a", "b").count() == 0
