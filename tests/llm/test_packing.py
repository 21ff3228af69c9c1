"""Problem 8: containers."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import packing as P


def fill(plan, hist):
    """container -> lengths, by brute force over the plan."""
    out = {}
    for length in np.flatnonzero(hist):
        entries = [i for i in range(len(plan.lengths)) if plan.lengths[i] == length]
        for rank in range(hist[length]):
            i = max((i for i in entries if plan.start_rank[i] <= rank), key=lambda i: plan.start_rank[i])
            c = plan.first_container[i] + (rank - plan.start_rank[i]) // plan.per_container[i]
            out.setdefault(int(c), []).append(int(length))
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=120))
def test_plan_places_every_piece(lengths):
    hist = np.bincount(lengths, minlength=33) if lengths else np.zeros(33, np.int64)
    plan = P.plan(hist, 32)
    got = fill(plan, hist)
    assert sorted(x for v in got.values() for x in v) == sorted(lengths)
    assert all(sum(v) <= 32 for v in got.values())
    assert len(got) == plan.n_containers
    assert sum(1 for v in got.values() if sum(v) * 2 <= 32) <= 1


def test_little_is_unused():
    rng = np.random.default_rng(0)
    hist = np.bincount(np.minimum(rng.lognormal(5, 1, 30_000).astype(int) + 1, 2048), minlength=2049)
    assert (hist * np.arange(2049)).sum() / 2048 / P.plan(hist).n_containers > 0.995


def test_documents(spark, sf):
    pytest.importorskip("tiktoken")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame([(10**9, None), (10**9 + 1, ""), (10**9 + 2, "pump " * 9_000)], "doc_id long, text string")).selectExpr("*", "1 as salt", "2 as piece")
    got = P.pack(docs).toPandas()
    counter = P.TokenCounter(P.VOCABULARY)
    want = {r.doc_id: counter.count(r.text) if r.text else 0 for r in docs.collect()}
    assert got.groupby("doc_id")["n_tokens"].sum().to_dict() == want
    assert got.groupby("container_id")["n_tokens"].sum().max() <= P.CAPACITY
    assert got[got["container_id"].isna()]["n_tokens"].max() == 0
    long = got[got["doc_id"] == 10**9 + 2].sort_values("piece")
    assert (long["n_tokens"][:-1] == P.CAPACITY).all()
    assert P.pack(docs.where("doc_id < 0")).count() == 0


def test_parts_of_a_hot_length(spark, monkeypatch):
    pytest.importorskip("tiktoken")
    docs = spark.createDataFrame([(i, "pump " * (3 if i % 3 else 700)) for i in range(120)] + [(500, "pump " * 5_000), (501, "pump " * 2_048)], "doc_id long, text string")
    once = P.pack(docs).toPandas()
    monkeypatch.setattr(P, "SALT_ROWS", 7)
    split = P.pack(docs).toPandas()
    places = lambda df: sorted(df[["doc_id", "piece", "first_token", "n_tokens"]].itertuples(index=False, name=None))
    assert places(split) == places(once)
    assert split.groupby("container_id")["n_tokens"].sum().max() <= P.CAPACITY
    assert split["container_id"].nunique() == once["container_id"].nunique()
