"""Decontamination, licences, top-k and sharding against SQL or brute force."""

import random
import zlib

import duckdb
import numpy as np
import pytest

from tessera.llm import decontaminate, license_scan, topk_inner
from tessera.llm.shard_packing import pack_shards, place

from odd_data import odd_rows, syllables


def rows_of(frame):
    return sorted(map(str, (tuple(r) for r in frame.select(*sorted(frame.columns)).collect())))


def sql_rows(con, sql):
    t = con.sql(sql).arrow()
    t = t.read_all() if hasattr(t, "read_all") else t
    return sorted(str(tuple(r[c] for c in sorted(r))) for r in t.to_pylist())


def with_documents(con, rows):
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [(d, t if t is None else t.replace("\x00", " ")) for d, t in rows])


@pytest.fixture(scope="module")
def bench_rows():
    passage = syllables(2, 90).split(" ")
    return [(1, " ".join(passage[:30])), (2, " ".join(passage[40:50])), (3, None), (4, ""), (None, syllables(3, 20)), (5, syllables(77, 40)),
            (6, " ".join(passage[:30])), (1, syllables(9, 5).upper())]


@pytest.mark.parametrize("max_bytes", [1 << 26, 3000])
def test_contamination_matches_sql(spark, odd_docs, bench_rows, max_bytes):
    bench = spark.createDataFrame(bench_rows, "item_id long, text string")
    con = duckdb.connect()
    with_documents(con, odd_rows())
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", bench_rows)
    found = decontaminate.find_passages(spark, odd_docs, bench, max_pattern_bytes=max_bytes)
    got = decontaminate.judged(found).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert rows_of(got) == sql_rows(con, decontaminate.oracle_sql())


def test_contamination_offsets_and_empty_tables(spark, odd_docs, no_docs, bench_rows):
    bench = spark.createDataFrame([(1, "One, two THREE — four")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "zéro: one two\n three  — (four) five")], "doc_id long, text string")
    row = decontaminate.find_passages(spark, docs, bench).first()
    assert ["zéro: one two\n three  — (four) five"[s.start:s.end] for s in row.spans] == ["one two\n three  — (four"]
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(spark, odd_docs, none).filter("n_hit > 0 OR contaminated").count() == 0
    assert decontaminate.contamination(spark, no_docs, bench).count() == 0


def test_licenses_match_sql(spark, odd_docs, no_docs):
    mit = license_scan.TEMPLATES["MIT-text"]
    words = mit.split(" ")
    notices = [(100, "Intro\nReleased under the MIT license\n\nmore"), (101, "\n\n".join([mit, "x y", mit.upper()])),
               (102, "\n".join(" ".join(words[i:i + 9]) for i in range(0, len(words), 9))), (None, "licensed under cc by nc 4.0"),
               (103, " ".join(words[:-30])), (103, "Licensed under the Apache License, Version 2.0." * 2)]
    rows = odd_rows() + notices
    extra = spark.createDataFrame(notices, "doc_id long, text string")
    docs = odd_docs.select("doc_id", "text").replace("\x00", " ").unionByName(extra)
    con = duckdb.connect()
    with_documents(con, rows)
    got = license_scan.scan_licenses(spark, docs)
    assert rows_of(got) == sql_rows(con, license_scan.oracle_sql())
    assert {r.license for r in got.filter("doc_id IN (101, 102)").collect()} >= {"MIT-text"}
    assert license_scan.scan_licenses(spark, no_docs).count() == 0
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_licence_texts_are_known_and_lists_go_in_blocks(spark):
    texts = {1: "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the "
                "following conditions\nare met:", 2: "This program is free software; you can redistribute it and/or modify\nit under the terms of "
             "the GNU General Public License as published by\nthe Free Software Foundation; either version 2 of the License, or\n(at your "
             "option) any later version.", 3: "THE SOFTWARE IS PROVIDED AS IS " + license_scan.TEMPLATES["MIT"]}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = license_scan.scan_licenses(spark, docs)
    assert {(r.doc_id, r.license) for r in got.collect()} >= {(1, "BSD-conditions"), (2, "GPL-2.0-header")}
    assert rows_of(license_scan.scan_licenses(spark, docs, max_bigrams=300)) == rows_of(got)


def test_license_size_bounds_are_exact():
    for n in range(1, 60):
        ok = {a for a in range(1, 200) if 2 * min(a, n) >= 0.8 * (a + n)}
        assert set(license_scan.size_range(n, 0.8)) == ok


def brute_top(rows, k, stride):
    ints = [(i, np.floor(1024 * np.array(v, dtype=float))) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = max(len(v) for _, v in ints)
    ints = [(i, np.pad(v, (0, width - len(v)))) for i, v in ints]
    out = []
    for q, qv in {i: v for i, v in ints if i % stride == 0}.items():
        best = sorted((-int(qv @ v), i) for i, v in ints if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("block", [8192, 60])
def test_top_k_matches_brute_force(spark, block):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=16) * rng.choice([0.1, 1, 3])).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(150)]  # one very common vector: ties by id
    rows += [(500, None), (None, rows[3][1]), (600, [float("nan")] * 16), (700, [None] * 16), (800, [float("inf")] * 16), (900, []),
             (901, rows[5][1][:4])]
    frame = spark.createDataFrame([(i, v, "?") for i, v in rows], "vec_id long, embedding array<double>, v string")
    got = sorted(tuple(r) for r in topk_inner.top_k_inner(spark, frame, block_rows=block, query_rows=2).collect())
    assert got == brute_top(rows, 10, 100)
    assert topk_inner.top_k_inner(spark, frame.filter("false")).count() == 0
    few = sorted(tuple(r) for r in topk_inner.top_k_inner(spark, frame.filter("vec_id < 5")).collect())
    assert few == brute_top([r for r in rows if r[0] is not None and r[0] < 5], 10, 100)


def test_scores_of_long_vectors_are_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(-10**6, 10**6, size=16)]) for i in range(60)]
    rows += [(100 + i, rows[0][1][:-1] + [rows[0][1][-1] + i / 1024]) for i in range(6)]  # differ by less than a double of the score shows
    ints = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows]
    want = []
    for q, qv in ints:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in ints if i != q)[:10]
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    got = topk_inner.top_k_inner(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>"), query_stride=50)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    huge = np.full((1, 2), 1 << 40)
    assert topk_inner.exact_scores(np.array([[1 << 40, -(1 << 40)]]), huge[0], 2.0 ** 81).tolist() == [0]
    with pytest.raises(OverflowError):
        topk_inner.exact_scores(huge, huge[0], 2.0 ** 81)


def test_components_beyond_64_bits_fail(spark):
    rows = spark.createDataFrame([(0, [1.0, 1.0]), (1, [1e17, 0.0]), (2, [3e17, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="beyond 64 bits"):
        topk_inner.top_k_inner(spark, rows).collect()


def test_wide_vectors(spark):
    rng = np.random.default_rng(11)
    rows = [(i, rng.normal(size=300).tolist()) for i in range(130)]
    got = topk_inner.top_k_inner(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert sorted(tuple(r) for r in got.collect()) == brute_top(rows, 10, 100)


def test_placement_takes_the_highest_dot_product():
    # Two shards, two dimensions: opposite vectors end up together.
    out = place(np.array([[10.0, 0.0], [10.0, 0.0], [0.0, 10.0], [0.0, 10.0]]), 2)
    loads = [np.array([[10.0, 0.0], [10.0, 0.0], [0.0, 10.0], [0.0, 10.0]])[out == s].sum(axis=0).tolist() for s in (0, 1)]
    assert loads == [[10.0, 10.0], [10.0, 10.0]]


def plain_place(vectors, n_shards):
    """The greedy as a plain loop: largest first, highest dot product with what is left where it fits."""
    total = [max(1e-300, sum(v[d] for v in vectors)) / n_shards for d in range(len(vectors[0]))]
    demand = [[v[d] / total[d] for d in range(len(v))] for v in vectors]
    left = [[1.0] * len(total) for _ in range(n_shards)]
    out = [None] * len(vectors)
    for i in sorted(range(len(vectors)), key=lambda i: -max(demand[i])):
        fits = [s for s in range(n_shards) if all(a >= b for a, b in zip(left[s], demand[i]))]
        if fits:
            best = max(fits, key=lambda s: (sum(a * b for a, b in zip(left[s], demand[i])), -s))
        else:
            best = max(range(n_shards), key=lambda s: (min(a - b for a, b in zip(left[s], demand[i])), -s))
        left[best] = [a - b for a, b in zip(left[best], demand[i])]
        out[i] = best
    return out


def test_placement_is_the_plain_greedy():
    rng = np.random.default_rng(7)
    for _ in range(20):
        vectors = rng.integers(1, 1000, size=(60, 3)).astype(float)
        assert place(vectors, 5).tolist() == plain_place(vectors.tolist(), 5)


@pytest.mark.parametrize("ids", ["null", "equal", "own"])
def test_repeated_rows_are_spread_over_shards(spark, ids):
    doc_id = {"null": "CAST(NULL AS LONG)", "equal": "7L", "own": "id"}[ids]
    copies = spark.range(4000).selectExpr(f"IF(id % 2 = 0, {doc_id}, id + 10000) AS doc_id",
                                          "IF(id % 2 = 0, 'one text of many', concat('text ', id, ' and some more')) AS text")
    out = pack_shards(spark, copies, n_shards=16).toPandas()
    assert len(out) == 4000
    sizes = out.groupby("shard")["size"].sum()
    assert len(sizes) == 16 and sizes.max() - sizes.min() < 0.02 * sizes.mean() + 60
    for _, part in out.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))


def test_shards_are_balanced_and_gapless(spark, odd_docs, no_docs):
    rng = random.Random(4)
    rows = [(100 + i, syllables(i, rng.randint(1, 80))) for i in range(1500)] + [(5000 + i, "one copy of many " * 9) for i in range(700)]
    docs = spark.createDataFrame(rows + odd_rows()[:9] + [(None, None), (None, None)], "doc_id long, text string").withColumnRenamed("z", "z")
    out = pack_shards(spark, docs, n_shards=4, units=512).toPandas()
    assert len(out) == docs.count()
    sizes = out.groupby("shard")["size"].sum()
    assert sizes.max() - sizes.min() < 0.03 * sizes.mean() and len(sizes) == 4
    for _, part in out.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    text = dict(rows)
    known = out[out.doc_id.isin(list(text))]
    assert all(r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) and r.size == len(text[r.doc_id].encode()) + 1
               for r in known.itertuples())
    # Groups that fit a shard stay whole; the copies (a third of all rows, more than a shard) are spread.
    assert out[out.doc_id.isin([10, 11])].shard.nunique() == 1
    assert out[out.doc_id >= 5000].shard.nunique() > 1
    assert pack_shards(spark, no_docs).count() == 0
    assert pack_shards(spark, odd_docs).count() == len(odd_rows())
