"""Problem 4: chains, and their rebuilding."""

from __future__ import annotations

from datetime import datetime, timedelta

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions.dates import printed_day
from millrace.operators import history as H

SPEC = H.ChainSpec(("o", "w"), ("a",), "day", "at", "id")
SCHEMA = "id long, o string, w string, day date, a string, at timestamp, valid_from int"
T0 = datetime(2024, 1, 1)


def brute(rows):
    out, pairs = [], {}
    for i, o, w, day, a, at, _ in rows:
        if o is not None and w is not None and day is not None:
            pairs.setdefault((o, w), {}).setdefault(day, []).append((at, i, a))
    for pair, days in pairs.items():
        held = [(d, max(v, key=lambda x: x[:2])[2]) for d, v in sorted(days.items())]
        runs = [x for k, x in enumerate(held) if k == 0 or held[k - 1][1] != x[1]]
        out += [(*pair, a, str(d), str(runs[k + 1][0]) if k + 1 < len(runs) else H.FOREVER) for k, (d, a) in enumerate(runs)]
    return sorted(out, key=repr)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["o1", "o2", None]), st.sampled_from(["w1", "w2"]), st.integers(0, 6), st.sampled_from(["x", "y", None]), st.integers(0, 5)), max_size=25), st.integers(0, 6))
def test_any_split_gives_the_full_history(spark, drawn, split):
    rows = [(i, o, w, (T0 + timedelta(days=d)).date(), a, T0 + timedelta(days=t), 1) for i, (o, w, d, a, t) in enumerate(drawn)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, H.history(df, SPEC, F.col("at") >= F.lit(T0 + timedelta(days=split))).collect()), key=repr)
    assert got == brute(rows)


def test_store_replaces_only_touched_buckets(spark, tmp_path):
    rows = [(i, "o", f"w{i % 20}", (T0 + timedelta(days=i)).date(), str(i % 3), T0, 1) for i in range(100)]
    raw = spark.createDataFrame(rows, SCHEMA)
    store = H.ChainStore(spark, str(tmp_path), SPEC, buckets=8)
    assert store.read() is None
    store.apply(raw, raw)
    late = spark.createDataFrame([(500, "o", "w3", (T0 + timedelta(days=4)).date(), "late", T0 + timedelta(days=9), 1)], SCHEMA)
    both = raw.unionByName(late)
    assert len(store.apply(both, late)) == 1
    want = H.build_chains(both, SPEC)
    assert sorted(map(tuple, store.read().select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert store.apply(both, late.where("id < 0")) == []


def test_printed_days(spark):
    cases = {"2024-04-28": "2024-04-28", " 2023-05-23": "2023-05-23", "17-Nov-2024": "2024-11-17", "2024-04-28T00:00:00": "2024-04-28", "2024/4/8": "2024-04-08", "20240408": "2024-04-08", "April 8, 2024": "2024-04-08", "2024-02-30": None, "03/04/2024": None, "": None, None: None}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r[0]: r[1] and str(r[1]) for r in df.select("t", printed_day(F.col("t"))).collect()} == cases
