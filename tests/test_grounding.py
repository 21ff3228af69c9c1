"""Grounding over pages that were extracted more than once."""

from __future__ import annotations

from millrace.plans import reference


def test_every_text_of_a_page_is_searched(spark, tmp_path):
    rows = [
        (1, "r1", 2, "a checksum 111"), (2, "r1", 2, "b checksum 222 and 333"), (3, "r1", 4, "c checksum 333"), (4, "r1", 5, "d checksum 444"),
        (5, "r1", 5, "no value, but 222"), (6, "r1", 6, None), (7, "r2", 1, "checksum 111"),
    ]
    spark.createDataFrame(rows, "page_id long, report_id string, page_no long, page_text string").write.parquet(f"{tmp_path}/page_texts.parquet")
    got = {r.value_id: (r.grounding, r.found_on) for r in reference.j8_grounding(spark, str(tmp_path)).collect()}
    assert got == {
        "1": ("cited_page", "2"), "2": ("cited_page", "2"), "3": ("cited_page", "4"), "4": ("other_page", "5"), "5": ("not_evaluated", ""), "7": ("other_page", "1"),
    }
