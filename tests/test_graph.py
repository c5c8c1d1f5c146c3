"""Graph operators on small graphs with known answers (FIXTURES.md section 3)."""

import contextlib
import io
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.operators import graph as G


def _graph(spark, edges, extra_vertices=()):
    e = spark.createDataFrame(edges, "src int, dst int")
    ids = sorted({x for ed in edges for x in ed} | set(extra_vertices))
    v = spark.createDataFrame([(i,) for i in ids], "id int")
    return G.Graph(v, e)


def test_pagerank_known_values(spark):
    g = _graph(spark, [(1, 2), (2, 3), (3, 1), (1, 3)])
    got = {r["id"]: r["pagerank"] for r in G.pagerank(g, 0.15, max_iter=10).collect()}
    assert got[1] == pytest.approx(1.166739, abs=1e-6)
    assert got[2] == pytest.approx(0.643249, abs=1e-6)
    assert got[3] == pytest.approx(1.190011, abs=1e-6)
    assert sum(got.values()) == pytest.approx(3.0)


def test_pagerank_modes_differ_on_parallel_edges(spark):
    g = _graph(spark, [(1, 2), (1, 2), (1, 3), (2, 1), (3, 1)])
    multi = {r["id"]: r["pagerank"] for r in G.pagerank(g, max_iter=20, mode="multiplicity").collect()}
    simple = {r["id"]: r["pagerank"] for r in G.pagerank(g, max_iter=20, mode="simple").collect()}
    assert multi[2] > simple[2]
    assert simple[2] == pytest.approx(simple[3])


def test_pagerank_tol_close_to_fixed_point_and_dangling(spark):
    g = _graph(spark, [(1, 2), (2, 3), (3, 1), (1, 4)], extra_vertices=[5])   # 4 dangling, 5 isolated
    tol = {r["id"]: r["pagerank"] for r in G.pagerank(g, tol=1e-9).collect()}
    fixed = {r["id"]: r["pagerank"] for r in G.pagerank(g, max_iter=200).collect()}
    assert sum(tol.values()) == pytest.approx(5.0)
    for k in fixed:
        assert tol[k] == pytest.approx(fixed[k], abs=1e-7)
    assert tol[5] < tol[1]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6)), min_size=1, max_size=15))
def test_pagerank_sums_to_vertex_count(spark, edges):
    g = _graph(spark, edges)
    ranks = [r["pagerank"] for r in G.pagerank(g, max_iter=5).collect()]
    assert sum(ranks) == pytest.approx(len(ranks))


def test_hop_distance_and_property(spark):
    edges = [(1, 2), (2, 3), (3, 1), (1, 3), (4, 1)]
    g = _graph(spark, edges, extra_vertices=[5])
    d = {r["id"]: r["distance"] for r in G.hop_distance(g, [3]).collect()}
    assert d == {3: 0, 1: 1, 2: 1, 4: 2}               # 5 unreachable -> no row
    for s, t in edges:                                  # d(src) <= d(dst) + 1
        if t in d:
            assert d[s] <= d[t] + 1


def test_bfs_first_hit_level_all_paths(spark):
    edges = [(1, 2), (2, 4), (1, 3), (3, 4), (3, 4), (4, 5), (6, 5)]
    g = _graph(spark, edges)
    out = G.bfs(g, "id = 1", "id = 4", 10).collect()
    assert {(r["path"], r["hops"], r["edge_paths"]) for r in out} == {("1->2->4", 2, 1), ("1->3->4", 2, 2)}
    # from several sources: only globally shortest paths are returned
    out2 = G.bfs(g, "id != 5", "id = 5", 10).collect()
    assert {r["path"] for r in out2} == {"4->5", "6->5"}
    assert G.bfs(g, "id = 5", "id = 1", 10).count() == 0      # unreachable
    assert G.bfs(g, "id = 1", "id = 5", 2).count() == 0       # beyond max length


def test_edges_vertices_loops_and_folding(spark):
    trips = spark.createDataFrame(
        [(8, 8, 41.9, "t1", 1.0), (8, 32, 41.8, "t0", 2.0), (8, 32, 41.7, "t2", 3.0), (None, 32, 1.0, "t3", 4.0)],
        "p int, d int, lat double, tract string, fare double")
    v = G.vertices_from_endpoints(trips, [{"id": "p", "tract": "tract"}, {"id": "d", "tract": "tract"}], ["tract"])
    assert {r["id"]: r["tract"] for r in v.collect()} == {8: "t0", 32: "t0"}
    e = G.edges_from_rows(trips, "p", "d", {"fare": "fare"})
    assert e.count() == 3
    assert G.self_loops(e).count() == 1
    folded = {(r["src"], r["dst"]): (r["weight"], r["multiplicity"]) for r in
              G.fold_parallel_edges(e, "fare").collect()}
    assert folded == {(8, 8): (1.0, 1), (8, 32): (5.0, 2)}
    nw = {(r["src"], r["dst"]): r["norm_weight"] for r in
          G.normalized_weights(G.fold_parallel_edges(e, "fare")).collect()}
    assert nw[(8, 32)] == pytest.approx(5 / 6)
    g = G.Graph(spark.createDataFrame([(8,), (32,), (77,)], "id int"), e)
    assert sorted(r["id"] for r in G.connected_vertices(g).collect()) == [8, 32]


def test_hop_distance_several_landmarks_and_weighted_pagerank(spark):
    g = _graph(spark, [(1, 2), (2, 3), (3, 4), (4, 1)])
    d = {(r["id"], r["landmark"]): r["distance"] for r in G.hop_distance(g, [1, 3]).collect()}
    assert d == {(1, 1): 0, (4, 1): 1, (3, 1): 2, (2, 1): 3, (3, 3): 0, (2, 3): 1, (1, 3): 2, (4, 3): 3}
    # weights: vertex 1 sends 3/4 of its rank to 2 and 1/4 to 3
    e = spark.createDataFrame([(1, 2, 3.0), (1, 3, 1.0), (2, 1, 1.0), (3, 1, 1.0)], "src int, dst int, w double")
    v = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    got = {r["id"]: r["pagerank"] for r in G.pagerank(G.Graph(v, e), max_iter=30, mode="weight", weight_col="w").collect()}
    r = {1: 1.0, 2: 1.0, 3: 1.0}
    for _ in range(30):
        r = {1: 0.15 + 0.85 * (r[2] + r[3]), 2: 0.15 + 0.85 * 0.75 * r[1], 3: 0.15 + 0.85 * 0.25 * r[1]}
    scale = 3 / sum(r.values())
    for k in r:
        assert got[k] == pytest.approx(r[k] * scale, abs=1e-9)


def test_bfs_multiplicity_does_not_overflow(spark):
    edges = spark.range(20_000).selectExpr("explode(array(0, 1, 2, 3, 4)) AS src").selectExpr("src", "src + 1 AS dst")
    graph = G.Graph(spark.range(6).selectExpr("CAST(id AS INT) AS id"), edges)
    row = G.bfs(graph, "id = 0", "id = 5", 10).first()
    assert (row["path"], row["hops"], row["edge_paths"]) == ("0->1->2->3->4->5", 5, 20_000.0 ** 5)


def test_hop_distance_has_no_depth_limit(spark):
    edges = spark.range(30).selectExpr("id AS src", "id + 1 AS dst")
    got = {r["id"]: r["distance"] for r in G.hop_distance(G.Graph(spark.range(31), edges), [30]).collect()}
    assert got == {i: 30 - i for i in range(31)}


def _hub_edges(n=900):
    """A third of all edges leave vertex 0, another third arrives at vertex 1."""
    rng = random.Random(1)
    third = n // 3
    return ([(0, i % 200 + 2) for i in range(third)] + [(i % 200 + 2, 1) for i in range(third)]
            + [(rng.randint(0, 201), rng.randint(0, 201)) for _ in range(third)])


def _plain_ranks(edges, rounds):
    ids = sorted({x for e in edges for x in e})
    out = {i: [d for s, d in edges if s == i] for i in ids}
    ranks = dict.fromkeys(ids, 1.0)
    for _ in range(rounds):
        new = dict.fromkeys(ids, 0.15)
        for i in ids:
            for d in out[i]:
                new[d] += 0.85 * ranks[i] / len(out[i])
        ranks = new
    scale = len(ids) / sum(ranks.values())
    return {i: r * scale for i, r in ranks.items()}


@pytest.mark.parametrize("block_edges", [100_000, 20])
def test_hubs_are_cut_into_blocks(spark, block_edges):
    edges = _hub_edges()
    g = _graph(spark, edges)
    got = {r["id"]: r["pagerank"] for r in G.pagerank(g, max_iter=12, block_edges=block_edges).collect()}
    want = _plain_ranks(edges, 12)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    blocks = G.edge_blocks(g.edges.distinct(), block_edges)
    sizes = [r["count"] for r in blocks.edges.groupBy("src", "part").count().collect()]
    hub = blocks.edges.filter("src = 0")
    assert hub.select("part").distinct().count() == (1 if block_edges > 1000 else -(-hub.count() // 20))
    assert max(sizes) <= 3 * block_edges
    hops = {r["id"]: r["distance"] for r in G.hop_distance(g, [1], block_edges=block_edges).collect()}
    assert hops == _plain_hops(edges, 1)
    blocks.release()


def _plain_hops(edges, target):
    hops, level = {target: 0}, {target}
    while level:
        level = {s for s, d in edges if d in level and s not in hops}
        hops.update(dict.fromkeys(level, max(hops.values()) + 1))
    return hops


def test_many_landmarks_are_bits(spark):
    rng = random.Random(6)
    edges = [(rng.randint(0, 149), rng.randint(0, 149)) for _ in range(260)]
    g = _graph(spark, edges)
    ids = sorted({x for e in edges for x in e})
    marks = ids[:130] + [9999]
    got = {}
    for r in G.hop_distance(g, marks).collect():
        got.setdefault(r["landmark"], {})[r["id"]] = r["distance"]
    assert got == {m: _plain_hops(edges, m) for m in ids[:130]}
    assert G.hop_distance(g, marks, max_hops=1).agg({"distance": "max"}).first()[0] == 1


def test_search_from_both_ends_visits_less_and_finds_the_same(spark):
    rng = random.Random(9)
    edges = [(rng.randint(0, 599), rng.randint(0, 599)) for _ in range(1800)]
    g = _graph(spark, edges)
    for a, b in ((0, 5), (3, 300), (17, 401)):
        one, two = {}, {}
        plain = G.bfs(g, f"id = {a}", f"id = {b}", 12, stats=one)
        met = G.bfs(g, f"id = {a}", f"id = {b}", 12, both_ends=True, stats=two)
        assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, met.collect()))
        assert two["visited"] < 0.6 * one["visited"]
    for pair in (("id < 3", "id = 2 OR id = 9"), ("id = 9999", "id = 1"), ("id = 1", "id = 9999")):
        assert sorted(map(tuple, G.bfs(g, *pair).collect())) == sorted(map(tuple, G.bfs(g, *pair, both_ends=True).collect()))
    assert G.bfs(g, "id = 3", "id = 300", 1, both_ends=True).count() == 0


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_a_round_leaves_the_edges_where_they_are(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
              if spark.conf.get(k, None) is not None}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        g = _graph(spark, _hub_edges())
        blocks = G.edge_blocks(g.edges.distinct(), 20, num_partitions=3)
        blocks.edges.count()
        sent = G._to_blocks(spark.createDataFrame([(0, 1.0, 10)], "id int, d double, blocks int"))
        step = sent.join(blocks.edges, (sent["id"] == blocks.edges["src"]) & (sent["part"] == blocks.edges["part"]))
        text = _plan(step)
        # One exchange: the messages.  The cached edges are read in place, sorted already.
        join = text[:text.index("InMemoryRelation")]
        assert join.count("Exchange") == 1 and join.count("Sort [") == 1, text
        assert step.count() == blocks.edges.filter("src = 0").count()
        blocks.release()
    finally:
        for k in ("spark.sql.autoBroadcastJoinThreshold",):
            spark.conf.set(k, before[k]) if k in before else spark.conf.unset(k)


def test_nothing_stays_cached(spark):
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    g = _graph(spark, _hub_edges(300))
    G.pagerank(g, max_iter=7).count()
    G.pagerank(g, tol=0.01).count()
    G.hop_distance(g, [1, 2]).count()
    G.bfs(g, "id = 0", "id = 1", both_ends=True).count()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held


def test_edges_are_moved_once_to_their_blocks(spark, monkeypatch):
    g = _graph(spark, _hub_edges())
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",) if spark.conf.get(k, None) is not None}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        taken = []
        placed = G._placed
        monkeypatch.setattr(G, "_placed", lambda df, *a: taken.append(df) or placed(df, *a))
        blocks = G.edge_blocks(g.edges.distinct(), 20, num_partitions=3)
        # What is placed has not been shuffled since it was written: the hubs come to the edges.
        text = _plan(taken[0])
        assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") == 2, text
        found = {(r.src, r.dst): (r.part, r.dst_blocks) for r in blocks.edges.collect()}
        counts = {}
        for s, d in set(_hub_edges()):
            counts[s] = counts.get(s, 0) + 1
        assert found.keys() == set(_hub_edges())
        assert all(0 <= part < -(-counts[s] // 20) and n == max(1, -(-counts.get(d, 0) // 20)) for (s, d), (part, n) in found.items())
        folder = blocks.path
        blocks.release()
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            spark.read.parquet(folder)
    finally:
        for k in ("spark.sql.autoBroadcastJoinThreshold",):
            spark.conf.set(k, before[k]) if k in before else spark.conf.unset(k)
