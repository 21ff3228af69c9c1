"""The bucket store: commits, conflicts, removal of what is not used."""

from __future__ import annotations

import pytest

from millrace.sources.store import BucketStore, Conflict


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k string, v int")


def test_commits_and_conflicts(spark, tmp_path):
    store = BucketStore(spark, str(tmp_path / "t"), ["k"], 4)
    assert store.version() == 0 and store.read() is None
    first = rows(spark, ("a", 1), ("b", 2), ("c", 3), (None, 4))
    assert store.replace(first, range(4), 0) == 1
    begun = store.version()
    hit = store.buckets_of(rows(spark, ("a", 0)))
    assert store.replace(rows(spark, ("a", 9)).unionByName(store.read(hit).where("k <> 'a'")), hit, begun) == 2
    with pytest.raises(Conflict):
        store.replace(rows(spark, ("a", 7)), hit, begun)
    now = sorted((r.k or "", r.v) for r in store.read().collect())
    assert ("a", 9) in now and ("a", 7) not in now
    assert sorted((r.k or "", r.v) for r in store.read(version=1).collect()) == [("", 4), ("a", 1), ("b", 2), ("c", 3)]
    gone = store.vacuum(keep=1)
    assert gone and sorted((r.k or "", r.v) for r in store.read().collect()) == now
    # buckets without rows are gone from the manifest
    store.replace(rows(spark, ("a", 1)).where("v < 0"), range(4), store.version())
    assert store.read() is None
