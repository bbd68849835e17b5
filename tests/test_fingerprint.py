from __future__ import annotations

import re

from tidecast.catalog import aggregates, all_queries

SF = "/root/testdata/sf0.001"


def test_fingerprint_reorders_in_parts_that_grow_with_the_table(spark, monkeypatch):
    """The reordered copy is spread over more tasks as lineitem grows, none reads a fixed fifth."""
    monkeypatch.setattr(aggregates, "REORDER_ROWS_PER_TASK", 100)
    rows = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    df = all_queries()["D20_fingerprint_stable"](spark, SF)
    parts = {int(n) for n in re.findall(r"hashpartitioning\(l_partkey#\d+L?, (\d+)\)", df._jdf.queryExecution().toString())}
    assert parts == {max(5, -(-rows // 100))} and rows > 500
    assert [tuple(r) for r in df.collect()] == [(True, False)]
