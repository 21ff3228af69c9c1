"""New items over the whole table of orders."""

from __future__ import annotations

from datetime import datetime

from millrace.plans import reference


def test_dear_orders_count_too(spark, tmp_path):
    old, new = datetime(1997, 12, 31), datetime(1998, 1, 1)
    rows = [(1, "a", 90_000.0, old), (1, "a", 90_000.0, new), (1, "b", 90_000.0, new), (2, "a", 10.0, new), (2, "a", 20.0, new), (3, "c", 10.0, old), (None, "a", 50_000.0, old), (None, "a", 50_000.0, new)]
    spark.createDataFrame(rows, "o_custkey long, o_orderpriority string, o_totalprice double, o_orderdate timestamp").write.parquet(f"{tmp_path}/orders.parquet")
    got = [tuple(r) for r in reference.d11_new_items(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted([(1, "b"), (2, "a"), (None, "a")], key=repr)
