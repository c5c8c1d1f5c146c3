"""Operators on input where one key holds a third of all rows, checked against pandas."""

import pandas as pd
import pytest

from tessera.operators import aggregates as A
from tessera.plans import logs as L
from tessera.plans import ratings as R

N = 3000


@pytest.fixture(scope="module")
def skewed(spark):
    rows = [(0 if i % 3 == 0 else i % 97 + 1, i % 11, float(i % 10) / 2 + 0.5) for i in range(N)]
    return rows, spark.createDataFrame(rows, "item long, user long, rating double")


def test_share_and_dedup_with_hot_key(spark, skewed):
    rows, df = skewed
    pdf = pd.DataFrame(rows, columns=["item", "user", "rating"])
    shares = {r["item"]: r["percentage"] for r in A.share_of_total(A.group_count(df, "item")).collect()}
    expected = (pdf.groupby("item").size() / len(pdf) * 100).to_dict()
    assert shares.keys() == expected.keys()
    assert all(abs(shares[k] - expected[k]) < 1e-9 for k in shares)
    assert shares[0] == pytest.approx(100 / 3, abs=0.1)
    best = {r["item"]: (r["rating"], r["user"]) for r in A.dedup_by_key(df, "item", ["rating", "user"]).collect()}
    exp = pdf.sort_values(["rating", "user"]).groupby("item").first()
    assert best == {k: (v.rating, v.user) for k, v in exp.iterrows()}


def test_token_popularity_and_top_rated_with_hot_item(spark, skewed):
    rows, df = skewed
    items = spark.createDataFrame([(i, f"title{i}", "Drama|Comedy" if i == 0 else "Drama") for i in range(0, 98)],
                                  "item long, title string, genres string")
    got = {r["genre"]: r["rating_count"] for r in
           R.token_popularity(df, items, "item", "item", "genres", R.MOVIE_GENRES).collect()}
    hot = sum(1 for r in rows if r[0] == 0)
    assert got == {"Drama": N, "Comedy": hot}
    top = R.top_rated(df, items, "item", "rating", "title", min_support=100, k=3).collect()
    pdf = pd.DataFrame(rows, columns=["item", "user", "rating"])
    stats = pdf.groupby("item").rating.agg(["mean", "size"])
    stats = stats[stats["size"] >= 100]
    stats["r"] = stats["mean"].round(2)
    exp = stats.reset_index().sort_values(["r", "size", "item"], ascending=[False, False, True]).head(3)
    assert [r["item"] for r in top] == list(exp["item"])


def test_host_bytes_with_hot_host(spark):
    lines = []
    for i in range(600):
        host = "10.0.0.1" if i % 3 == 0 else f"10.0.{i % 50}.9"
        lines.append((f"081109 2035{i % 60:02d} 1 INFO dfs.DataNode$DataXceiver: writeBlock blk_{i} "
                      f"from /{host}:50010 size {i}",))
    df = spark.createDataFrame(lines, "value string")
    got = {r["hostname"]: r["total_bytes"] for r in L.host_bytes(df).collect()}
    pdf = pd.DataFrame({"h": ["10.0.0.1" if i % 3 == 0 else f"10.0.{i % 50}.9" for i in range(600)],
                        "b": list(range(600))})
    assert got == pdf.groupby("h").b.sum().to_dict()
    ordered = [r["total_bytes"] for r in L.host_bytes(df).collect()]
    assert ordered == sorted(ordered, reverse=True)
