"""Problem 9: tiling against brute force."""

from __future__ import annotations

import random
import time

from millrace.llm import leaks as L
from millrace.llm.words import words


def test_words():
    assert words("The disc-\nharge, 8,984 psi: gas-locked.\n\n-- page 12 --\n\nNext") == "the discharge 8984 psi gaslocked next".split()
    assert words("Тhe рump ﬁts") == "the pump fits".split()


def test_combining_accents_make_one_word():
    assert words("Pen\u0303a mun\u0303oz") == words("Pe\u00f1a mu\u00f1oz") == ["pe\u00f1a", "mu\u00f1oz"]
    # a Cyrillic letter under the accent is mapped first
    assert words("\u0435\u0308l") == ["\u00ebl"]
    item = " ".join(f"w{i}" if i % 6 else f"n{i}\u00f1o" for i in range(40))
    found = L.compare(L.Items([(7, item)]), words(item.replace("\u00f1", "n\u0303")))
    assert found == [(7, 1.0, 1, 1.0)]


def brute(item, doc):
    """(share that tiles could cover at most: any position in a shared run) by definition."""
    n = len(item)
    covered = set()
    for i in range(n - L.MIN_RUN + 1):
        for j in range(len(doc) - L.MIN_RUN + 1):
            if item[i : i + L.MIN_RUN] == doc[j : j + L.MIN_RUN]:
                covered.update(range(i, i + L.MIN_RUN))
    return len(covered)


def test_tiles_and_order():
    rng = random.Random(5)
    item = [f"w{i}" for i in range(60)]
    filler = lambda n: [f"f{rng.randrange(500)}" for _ in range(n)]
    items = L.Items([(7, " ".join(item)), (8, "too short"), (9, "")])

    def check(doc, covered, in_order):
        got = {r[0]: r for r in L.compare(items, doc)}
        assert round(got[7][1] * 60) == covered == brute(item, doc)
        assert round(got[7][3] * 60) == in_order

    check(filler(30) + item + filler(30), 60, 60)
    check(filler(9) + item[20:50] + filler(9), 30, 30)
    check(item[30:60] + filler(5) + item[0:30], 60, 30)  # reordered: covered, but not in order
    check(item[0:30] + filler(80) + item[30:60], 60, 30)  # too far apart for one passage
    check(item[0:30] + filler(8) + item[31:60], 59, 59)
    check(item * 3, 60, 60)
    assert L.compare(items, item[0:9] + filler(3) + item[10:19]) == []
    assert L.compare(items, []) == []


def test_windows_that_cut_both_outer_matches():
    rng = random.Random(9)
    item = [f"w{i}" for i in range(60)]
    filler = lambda n: [f"f{rng.randrange(500)}" for _ in range(n)]
    items = L.Items([(7, " ".join(item))])

    def best(doc):
        return max((round(r[3] * 60) for r in compare_all(doc)), default=0)

    def compare_all(doc):
        found = L.matches(items.seeds(L.np.array([items.ids.get(w, 0) for w in doc], L.np.uint64)).get(7, []))
        return [(7, 0, 0, L.best_in_order(found, 60) / 60)] if found else []

    assert best(item[0:25] + filler(60) + item[30:55]) == 30
    for _ in range(60):
        doc = []
        for _ in range(rng.randrange(2, 5)):
            a = rng.randrange(45)
            doc += item[a : a + rng.randrange(10, 30)] + filler(rng.randrange(5, 60))
        # a passage of 90 words alone fits one window, whatever starts are tried
        assert best(doc) == max(best(doc[s : s + 90]) for s in range(len(doc)))


def test_table(spark):
    item = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, "x " + item, 5), (2, None, 5), (3, "", 5), (4, item.upper().replace(" w20", ", w20"), 5), (5, "y " * 50_000 + item, 5), (6, "nothing to see here at all today", 5), (1, "x " + item, 5)], "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(7, item), (8, None), (7, item)], "item_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in L.leaked(docs, items).collect()) == [(1, 7), (1, 7), (4, 7), (5, 7)]
    assert L.leaked(docs, items.where("item_id < 0")).count() == 0
    assert L.leaked(docs.where("doc_id < 0"), items).count() == 0


def test_blocks_do_not_change_the_result(spark, monkeypatch):
    texts = [" ".join(f"v{i}_{j}" for j in range(30)) for i in range(5)]
    docs = spark.createDataFrame([(i, "a b " + t) for i, t in enumerate(texts)], "doc_id long, text string")
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    monkeypatch.setattr(L, "BLOCK", 2)
    assert sorted((r.doc_id, r.item_id) for r in L.leaked(docs, items).collect()) == [(i, i) for i in range(5)]


def in_runs(doc, item):
    """Most item words held in order in runs of MIN_RUN or more by one passage, by trying every passage."""
    n, best = len(item), 0
    width = int(L.SPAN * n)
    for s in range(max(1, len(doc) - width + 1)):
        d = doc[s : s + width]
        g = [[0] * (n + 1) for _ in range(len(d) + 1)]
        run = [[0] * (n + 1) for _ in range(len(d) + 1)]
        for i in range(1, len(d) + 1):
            for j in range(1, n + 1):
                run[i][j] = run[i - 1][j - 1] + 1 if d[i - 1] == item[j - 1] else 0
                g[i][j] = max(g[i - 1][j], g[i][j - 1], *(g[i - k][j - k] + k for k in range(L.MIN_RUN, run[i][j] + 1)))
        best = max(best, g[-1][-1])
    return best


def test_order_against_every_passage():
    rng = random.Random(3)
    for trial in range(60):
        item = [f"w{i % 25 if trial % 3 == 1 else i}" for i in range(40)]
        doc = []
        for _ in range(rng.randrange(1, 6)):
            a = rng.randrange(30)
            doc += item[a : a + rng.randrange(8, 25)] + [f"f{rng.randrange(99)}" for _ in range(rng.randrange(0, 20))]
        items = L.Items([(7, " ".join(item))])
        seeds = items.seeds(L.np.array([items.ids.get(w, 0) for w in doc], L.np.uint64)).get(7)
        assert (0 if seeds is None else L.best_in_order(L.matches(seeds), 40)) == in_runs(doc, item)


def test_repeated_runs_cost_little():
    run = " ".join(f"r{i}" for i in range(10))
    items = L.Items([(1, " ".join([run] * 40))])
    began = time.time()
    assert L.compare(items, (run + " ").split() * 3_000) == [(1, 1.0, 1, 1.0)]
    assert time.time() - began < 10


def test_tiles_may_fall_short_of_the_best_order():
    # the longest match takes words of both its neighbours and leaves too few of each
    item = [f"w{i}" for i in range(100)]
    doc = item[0:25] + ["x"] + item[25:46] + [f"y{i}" for i in range(70)] + item[15:41]
    (row,) = L.compare(L.Items([(1, " ".join(item))]), doc)
    assert row[1] < L.COVERAGE <= row[3]


def test_one_letter_words_and_reordered_passages(spark):
    letters = "a b c d e f g h i j"
    item = " ".join(f"w{i}" for i in range(60))
    turned = " ".join([f"w{i}" for i in range(36, 60)] + [f"w{i}" for i in range(12, 36)] + [f"w{i}" for i in range(12)])
    docs = spark.createDataFrame([(1, letters), (2, turned), (3, item)], "doc_id long, text string")
    items = spark.createDataFrame([(7, letters), (8, item)], "item_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in L.leaked(docs, items).collect()) == [(1, 7), (3, 8)]
    got = {r.item_id: (r.n_docs, r.n_in_order) for r in L.leaked_items(docs, items).collect()}
    assert got == {7: (1, 1), 8: (2, 1)}
    assert {(r.doc_id, r.gate) for r in L.tiles(docs, items).collect()} == {(1, "tiles"), (2, "tiles"), (3, "tiles")}
