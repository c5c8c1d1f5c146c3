"""Regions, adaptive cells, mergeable distinct counts, inferred types and ordered tables."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import sketches as K
from tessera.operators import spatial as SP
from tessera.sources import inference as I
from tessera.sources import ordered as O
from tessera.sources.csv import read_csv


def test_points_meet_every_box_that_holds_them(spark):
    rng = random.Random(3)
    points = [(i, rng.uniform(-60, 60), rng.choice([0.0, rng.uniform(-60, 60)])) for i in range(400)]
    points += [(900, None, 1.0), (901, float("nan"), 1.0), (902, 10.0, 10.0)]
    boxes = [(f"b{i}", x, x + w, y, y + h) for i, (x, y, w, h) in enumerate(
        (rng.uniform(-60, 50), rng.uniform(-60, 50), 10 ** rng.uniform(-1, 2), 10 ** rng.uniform(-1, 2)) for _ in range(60))]
    boxes += [("point", 10.0, 10.0, 10.0, 10.0), ("all", -1e9, 1e9, -1e9, 1e9), ("huge", -1e12, 1e12, -1e12, 1e12), ("none", 5.0, 4.0, 0.0, 1.0), ("null", None, 4.0, 0.0, 1.0)]
    p = spark.createDataFrame(points, "id int, x double, y double")
    r = spark.createDataFrame(boxes, "region string, min_x double, max_x double, min_y double, max_y double")
    got = {(row.id, row.region) for row in SP.points_in_regions(p, r, "x", "y").collect()}
    want = {(i, b) for i, x, y in points for b, x0, x1, y0, y1 in boxes if None not in (x, x0) and x0 <= x <= x1 and y0 <= y <= y1}
    assert got == want and len(want) > 850
    per_region = SP.region_cells(r.filter("region LIKE 'b%'"), "region").groupBy("region").count().agg(F.max("count")).first()[0]
    assert per_region <= 4
    assert SP.points_in_regions(p, r.filter("false"), "x", "y").count() == 0


def test_polygons_are_tested_exactly(spark):
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 1.0), (0.0, 4.0)]  # a notch from above
    r = spark.createDataFrame([("m", 0.0, 4.0, 0.0, 4.0, ring)],
                              "region string, min_x double, max_x double, min_y double, max_y double, ring array<struct<x:double,y:double>>")
    p = spark.createDataFrame([(1, 2.0, 0.5), (2, 2.0, 2.0), (3, 0.5, 2.0), (4, 3.8, 3.0), (5, 5.0, 1.0)], "id int, x double, y double")
    assert {row.id for row in SP.points_in_regions(p, r, "x", "y", ring_col="ring").collect()} == {1, 3, 4}


def test_adaptive_cells_split_where_points_are(spark):
    rng = random.Random(5)
    xy = [(rng.random(), rng.random()) for _ in range(300)] + [(0.25, 0.25)] * 100 + [(rng.gauss(0.7, 0.01), rng.gauss(0.7, 0.01)) for _ in range(300)]
    cells = SP.adaptive_cells(spark.createDataFrame(xy + [(None, 1.0), (float("nan"), 1.0)], "x double, y double"), "x", "y", 20, depth=10).collect()
    assert sum(c.n for c in cells) == len(xy)
    x0, y0 = min(x for x, _ in xy), min(y for _, y in xy)
    w, h = max(x for x, _ in xy) - x0, max(y for _, y in xy) - y0

    def inside(level, cx, cy):
        at = lambda v, low, size: min(int((v - low) / size * 1024), 1023) >> (10 - level)
        return sum(at(x, x0, w) == cx and at(y, y0, h) == cy for x, y in xy)

    for c in cells:
        assert inside(c.level, c.cell_x, c.cell_y) == c.n
        assert c.n <= 20 or c.level == 10
        assert c.level == 0 or inside(c.level - 1, c.cell_x // 2, c.cell_y // 2) > 20
    one = SP.adaptive_cells(spark.createDataFrame([(1.0, 2.0)] * 5, "x double, y double"), "x", "y", 9).collect()
    assert [tuple(c) for c in one] == [(0, 0, 0, 5)]
    assert SP.adaptive_cells(spark.createDataFrame([], "x double, y double"), "x", "y", 9).count() == 0


def test_morton_codes_interleave_bits(spark):
    rows = spark.createDataFrame([(0, 0), (3, 0), (0, 3), (5, 9), ((1 << 31) - 1, 0)], "x long, y long")
    got = [r[0] for r in rows.select(SP.morton_code(F.col("x"), F.col("y"))).collect()]
    assert got == [sum((x >> b & 1) << 2 * b | (y >> b & 1) << 2 * b + 1 for b in range(31)) for x, y in [(0, 0), (3, 0), (0, 3), (5, 9), ((1 << 31) - 1, 0)]]


def test_sketches_merge_to_any_range(spark):
    d0 = dt.date(2024, 1, 1)
    rows = spark.range(60_000).select(F.expr("date_add(DATE'2024-01-01', CAST(id % 20 AS INT))").alias("day"),
                                      F.when(F.col("id") % 50 > 0, F.col("id") * 7919 % 9001).alias("user"))
    stored = K.distinct_sketches(rows, ["day"], "user").cache()
    assert stored.count() == 20
    ranges = [(d0 + dt.timedelta(a), d0 + dt.timedelta(b)) for a in range(20) for b in range(a, 20)] + [(dt.date(2025, 1, 1), dt.date(2025, 2, 1))]
    got = {(r.range_start, r.range_end): r.distinct_values for r in
           K.range_estimates(stored, spark.createDataFrame(ranges, "range_start date, range_end date"), "day").collect()}
    assert len(got) == 210
    per_day = {}
    for r in rows.distinct().collect():
        per_day.setdefault(r.day, set()).add(r.user)
    for (a, b), n in got.items():
        exact = len(set().union(*(s for d, s in per_day.items() if a <= d <= b)) - {None})
        assert abs(n - exact) <= 4 * K.relative_error() * exact + 1


def test_types_come_from_all_rows_and_junk_goes_aside(spark, tmp_dir):
    good = [(str(i), str(i * 10 ** 10), f"{i}.5", "true" if i % 2 else "false", "2024-02-28", "2024-02-28 10:00:01", f"t{i}", "" if i % 3 else "7")
            for i in range(200)]
    junk = [("n/a", "1", "1", "true", "2024-02-30", "2024-02-28T10:00:00.25", "x", "7"), ("99999999999", "1", "1e3", "true", "2024-02-29", "2024-02-28 10:00:00", "x", "7")]
    names = ["i", "b", "d", "t", "day", "at", "s", "gaps"]
    frame = spark.createDataFrame(good + junk, ", ".join(f"{n} string" for n in names))
    frame.write.option("header", True).csv(tmp_dir, mode="overwrite")
    raw = read_csv(spark, tmp_dir)
    types = I.types_of(I.infer_types(raw, max_bad_share=0.02))
    assert types == {"i": "int", "b": "bigint", "d": "double", "t": "boolean", "day": "date", "at": "timestamp", "s": "string", "gaps": "int"}
    fine = I.typed(raw, types)
    assert fine.count() == 200 and dict(fine.dtypes) == types
    assert fine.filter("gaps IS NULL").count() == sum(1 for r in good if not r[-1])
    aside = {r.i: r[I.BAD_COLUMNS] for r in I.misfits(raw, types).collect()}
    assert aside == {"n/a": ["i", "day"], "99999999999": ["i"]}
    strict = I.types_of(I.infer_types(raw))
    assert strict["i"] == "string" and strict["b"] == "bigint" and strict["day"] == "string"
    assert I.infer_types(raw.filter("false")).filter("data_type <> 'string' OR n_values > 0").count() == 0


def test_written_order_comes_back(spark, tmp_dir):
    rng = random.Random(2)
    rows = [(rng.choice([1, 1, 2, rng.randint(0, 500)]), i) for i in range(3000)] + [(None, 5000)]
    path = O.write_ordered(spark.createDataFrame(rows, "k int, id int").repartition(7), tmp_dir, [F.desc_nulls_last("k"), "id"], files=6)
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    got = O.read_ordered(spark, path).collect()
    assert [(r.k, r.id) for r in got] == want and [r.ordinal for r in got] == list(range(len(rows)))
    assert [(r.k, r.id) for r in O.read_ordered(spark, path, first=1000, rows=7).collect()] == want[1000:1007]
    # One key holds a third of the rows: it is split over files.
    assert spark.read.parquet(path).filter("k = 1").select("__part").distinct().count() > 1
    pairs = O.neighbours(spark, path, ["k", "id"]).collect()
    assert len(pairs) == len(rows) - 1 and all((r.k, r.id) == want[r.ordinal] and (r.next_k, r.next_id) == want[r.ordinal + 1] for r in pairs)


@pytest.mark.parametrize("n", [0, 1])
def test_small_tables_keep_their_order(spark, tmp_dir, n):
    path = O.write_ordered(spark.range(n), tmp_dir, ["id"])
    assert [r.ordinal for r in O.read_ordered(spark, path).collect()] == list(range(n))
