"""Physical-plan properties that the scale design relies on."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tessera.operators import aggregates as A
from tessera.operators import ranking as Z

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_group_and_dedup_aggregate_partially_before_the_shuffle(spark):
    # one key holds a third of the rows
    df = spark.range(3000).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))).alias("k"),
                                  (F.col("id") % 17).alias("v"))
    for out, fn in ((A.group_count(df, "k"), "partial_count"), (A.dedup_by_key(df, "k", ["v"]), "partial_min")):
        text = plan(out)
        assert f"Functions [1]: [{fn}(" in text, text
        assert "hashpartitioning(k" in text
    got = {r["k"]: r["v"] for r in A.dedup_by_key(df, "k", ["v"]).collect()}
    assert got[0] == 0 and len(got) == 2001


def test_global_comparison_is_a_subquery_not_a_join(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("g")).groupBy("g").count()
    text = plan(A.compare_with_global(df, "count", "avg", ">"))
    assert "Subquery" in text
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_top_k_never_sorts_everything(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("x"), "id")
    assert "TakeOrderedAndProject" in plan(Z.top_k(df, 5, ["-x"], ["id"]))


QUERIES = entry.queries()
BATCH = sorted(n for n in QUERIES if not n.startswith("stream_") and n != "csv_round_trip")


@pytest.mark.parametrize("name", BATCH)
def test_no_python_no_cartesian(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for node in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                 "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text, f"{name}: {node}"


def test_scans_read_only_needed_columns(spark):
    text = plan(QUERIES["grid_density"](spark, SF))
    assert "ReadSchema: struct<l_discount:double,l_tax:double>" in text
    text = plan(QUERIES["substring_filter"](spark, SF))
    assert "StringContains(p_name,ring)" in text


def test_token_popularity_aggregates_lineitem_before_the_join(spark):
    text = plan(QUERIES["token_popularity"](spark, SF))
    # the lineitem scan feeds an aggregate whose output (one row per part) is joined
    li = text.index("ReadSchema: struct<l_partkey:bigint>")
    join = text.index("Join type: Inner")
    assert re.search(r"Keys \[1\]: \[l_partkey", text[li:join])


def test_host_operations_match_each_pattern_once(spark):
    from tessera.plans import logs as L

    lines = [("081109 203518 1 INFO dfs.DataNode: Receiving block blk_1 src: /10.0.0.1:5",), ("081109 203518 1 WARN dfs.DataNode: blk_2 10.0.0.1",),
             ("INFO blk_3 10.0.0.2",), ("INFO blk 10.0.0.2",), ("INFO blk_4 no host.",), ("INFO blk_5 10.0.0.2",), ("INFOS blk_5 10.0.0.2",), (None,)]
    counts = L.host_block_operations(spark.createDataFrame(lines, "value string"))
    assert [tuple(r) for r in counts.collect()] == [("10.0.0.2", 2), ("10.0.0.1", 1)]
    # A filter on an extracted field would match the pattern a second time.
    filters = [x for x in plan(counts).splitlines() if x.startswith("Condition")]
    assert filters and not any("regexp" in x for x in filters)
