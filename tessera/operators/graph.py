"""Graph operators on a pair of DataFrames.

A ``Graph`` is ``vertices(id, ...)`` + ``edges(src, dst, ...)``.  Algorithms are
level-synchronous DataFrame iterations (joins + grouped aggregates); the only
driver round trips are one-row loop-stop tests.  Design for scale:

* Parallel edges are folded first (``groupBy(src, dst)`` with a map-side partial
  aggregate), so iterations run over distinct pairs, never the raw trips; the
  multiplicity is kept as a count, never expanded into pairs.
* The folded edges are cut into blocks by (source, bucket of the target): a vertex
  with more than ``BLOCK_EDGES`` edges has as many buckets as it needs, any other one.
  They are written to the shared folder, dealt by that pair once, sorted and cached, and stay where they
  are: a round moves the frontier or the changed ranks to them (a copy per block of a hub),
  joins them in place and sends the partial sums on.  Small frontiers are broadcast by AQE.
* Only what changed moves: PageRank sends each round's differences, searches send vertices
  that were reached for the first time.
* Iteration inputs are written once to a reliable checkpoint in the cluster's shared
  folder (``spark.checkpoint.dir``) and cached on top; lineage is cut again every few
  rounds, so a lost executor recomputes from the last checkpoint, never from the upstream
  fact join.  What a call has cached it releases before it returns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from tessera.operators.aggregates import dedup_by_key
from tessera.operators.joins import enrich_endpoints, semi_join
from tessera.operators.ranking import top_k
from tessera.session import checkpoint_root, scratch_path

# A source with more distinct edges than this is cut into blocks.
BLOCK_EDGES = 100_000
ROWS_PER_PARTITION = 1_000_000


@dataclass(frozen=True)
class Graph:
    """Vertices with an ``id`` column and edges with ``src``/``dst`` columns."""

    vertices: DataFrame
    edges: DataFrame

    def __post_init__(self):
        if "id" not in self.vertices.columns:
            raise ValueError("vertices need an 'id' column")
        missing = {"src", "dst"} - set(self.edges.columns)
        if missing:
            raise ValueError(f"edges need columns {sorted(missing)}")


# ----------------------------------------------------------------- construction

def vertices_from_endpoints(rows: DataFrame, endpoints: Sequence[Mapping[str, Column | str]],
                            order_by: Sequence[str] = (), drop_null_ids: bool = True,
                            types: Mapping[str, str] | None = None) -> DataFrame:
    """G1: vertices from endpoint columns of fact rows (pickup + dropoff).

    Each mapping gives target column -> source column/expression and must
    contain ``id``.  The projections are unioned and reduced to one row per
    id; the surviving attributes are the smallest by ``order_by`` (a defined
    choice where the reference kept an arbitrary row).  ``types`` try-casts
    target columns (e.g. ``{"id": "int"}``).
    """
    types = dict(types or {})
    # One pass over the fact rows: each row emits all its endpoints as an
    # array of structs (a union of per-endpoint projections would scan and
    # join the fact rows once per endpoint).
    structs = []
    for ep in endpoints:
        cols = [(F.col(v) if isinstance(v, str) else v) for v in ep.values()]
        structs.append(F.struct(*[(c.try_cast(types[k]) if k in types else c).alias(k)
                                  for k, c in zip(ep.keys(), cols)]))
    allv = rows.select(F.explode(F.array(*structs)).alias("__v")).select("__v.*")
    if drop_null_ids:
        allv = allv.filter(F.col("id").isNotNull())
    return dedup_by_key(allv, "id", list(order_by))


def edges_from_rows(rows: DataFrame, src, dst, attrs: Mapping[str, Column | str] | None = None,
                    types: Mapping[str, str] | None = None) -> DataFrame:
    """Edges ``(src, dst, attrs...)`` with ``try_cast`` types; rows with a NULL end dropped.

    Parallel edges are kept (they carry the trip multiplicity).
    """
    types = dict(types or {})
    cols = {"src": F.col(src) if isinstance(src, str) else src, "dst": F.col(dst) if isinstance(dst, str) else dst}
    cols.update({k: (F.col(v) if isinstance(v, str) else v) for k, v in (attrs or {}).items()})
    sel = [(c.try_cast(types[k]) if k in types else c).alias(k) for k, c in cols.items()]
    return rows.select(*sel).dropna(subset=["src", "dst"])


def fold_parallel_edges(edges: DataFrame, weight_col: str | None = None, weight_name: str = "weight",
                        count_name: str = "multiplicity") -> DataFrame:
    """One edge per (src, dst) with the summed weight and the edge count."""
    aggs = [F.count(F.lit(1)).alias(count_name)]
    if weight_col:
        aggs.insert(0, F.sum(weight_col).alias(weight_name))
    return edges.groupBy("src", "dst").agg(*aggs)


def enriched_edges(graph: Graph, order_by: Sequence[str] = (), attrs: Sequence[str] | None = None) -> DataFrame:
    """One edge per (src, dst) (smallest by ``order_by``) with both endpoints' attributes.

    Deduplicate first, then join: the vertex joins see distinct pairs only.
    """
    distinct_pairs = dedup_by_key(graph.edges, ["src", "dst"], list(order_by))
    return enrich_endpoints(distinct_pairs, graph.vertices, "id", "src", "dst", attrs)


def self_loops(edges: DataFrame) -> DataFrame:
    """Edges that start and end at the same vertex."""
    return edges.filter(F.col("src") == F.col("dst"))


def normalized_weights(folded: DataFrame, weight_col: str = "weight", name: str = "norm_weight") -> DataFrame:
    """Edge weight divided by the total outgoing weight of its source.

    Totals come from a grouped aggregate joined back on ``src`` (AQE splits a
    skewed hub), not from a window that would sort a hub's edges in one task.
    """
    totals = folded.groupBy("src").agg(F.sum(weight_col).alias("__out"))
    return folded.join(totals, "src").withColumn(name, F.try_divide(F.col(weight_col), F.col("__out"))).drop("__out")


def connected_vertices(graph: Graph) -> DataFrame:
    """Vertices that are an endpoint of at least one edge."""
    # both endpoints from one pass over the edges, deduplicated map-side
    ends = graph.edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    return semi_join(graph.vertices, ends, "id")


# ----------------------------------------------------------------- iteration helpers

def _checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder; cached first so the
    checkpoint write reads the cached blocks instead of recomputing."""
    checkpoint_root(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out


def _persist(df: DataFrame) -> DataFrame:
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def stable(df: DataFrame) -> DataFrame:
    """An iteration input: written once to a reliable checkpoint (so a lost
    executor never recomputes the upstream fact join) and cached on top of it
    (so rounds read memory, not files)."""
    return _persist(_checkpoint(df))


def _partitions(df: DataFrame, rows: int) -> int:
    """Partitions for ``rows`` short rows: in proportion to them, no more than the session's shuffles have."""
    return max(1, min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_PARTITION)))


def _placed(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """Deal ``df`` by ``keys``, sort and cache it so that joins on ``keys`` find it in place.

    The cached plan must keep its partitioning, which AQE would hide.
    """
    conf = df.sparkSession.conf
    name = "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"
    before = conf.get(name)
    conf.set(name, "false")
    try:
        return _persist(df.repartition(n, *keys).sortWithinPartitions(*keys))
    finally:
        conf.set(name, before)


def _bucket(vertex: Column, blocks: Column) -> Column:
    """The bucket of a target among its source's ``blocks``."""
    return F.pmod(F.xxhash64(vertex), blocks).cast("int")


def _to_blocks(df: DataFrame, blocks: str = "blocks") -> DataFrame:
    """A row for every block of its vertex, numbered ``part``; none for a vertex without edges."""
    parts = F.when(F.col(blocks) > 0, F.sequence(F.lit(0), (F.col(blocks) - 1).cast("int")))
    return df.withColumn("part", F.explode(parts)).drop(blocks)


@dataclass(frozen=True)
class EdgeBlocks:
    """Distinct edges ``src, part, dst, <value>, dst_blocks``, placed by (src, part), and every source's ``blocks``.

    ``dst_blocks``: the target's own number of blocks (1 if it has no edges), so that what arrives there knows how
    often it must go on.  ``path``: the folder of the edges, deleted with the rest by ``release``.
    """

    edges: DataFrame
    sources: DataFrame
    held: tuple[DataFrame, ...]
    path: str

    def release(self) -> None:
        for frame in self.held:
            frame.unpersist()
        spark = self.edges.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def edge_blocks(folded: DataFrame, block_edges: int | None = None, num_partitions: int | None = None) -> EdgeBlocks:
    """Cut distinct edges (``src, dst`` and values) into blocks of about ``block_edges`` edges of one source.

    The edges are written to the shared folder once and moved once, to their place.  Only the
    sources of more than one block are looked up, at both ends of the edges; there is at most
    one for every ``block_edges`` edges, so they are broadcast.
    """
    spark, path = folded.sparkSession, scratch_path(folded.sparkSession, "edges")
    folded.filter(F.col("src").isNotNull()).write.parquet(path)
    folded = spark.read.schema(folded.schema).parquet(path)
    sources = stable(folded.groupBy("src").agg(F.ceil(F.count(F.lit(1)) / (block_edges or BLOCK_EDGES)).cast("int").alias("blocks")))
    n = num_partitions or _partitions(folded, folded.agg(F.count(F.lit(1))).first()[0])
    hubs = F.broadcast(sources.filter("blocks > 1"))
    ends = hubs.select(F.col("src").alias("dst"), F.col("blocks").alias("dst_blocks"))
    cut = (folded.join(hubs, "src", "left").na.fill(1, ["blocks"]).withColumn("part", _bucket(F.col("dst"), F.col("blocks"))).drop("blocks")
           .join(F.broadcast(ends), "dst", "left").na.fill(1, ["dst_blocks"]))
    placed = _placed(cut, n, "src", "part")
    return EdgeBlocks(placed, sources, (placed, sources), path)


# ----------------------------------------------------------------- BFS / hop distance

def _folded_counts(edges: DataFrame, count_col: str | None) -> DataFrame:
    m = F.sum(F.col(count_col)) if count_col else F.count(F.lit(1))
    return edges.groupBy("src", "dst").agg(m.cast("double").alias("m"))


class _Search:
    """One direction of a search: levels of vertices first reached, each ``vid, blocks``."""

    def __init__(self, start: DataFrame, blocks: EdgeBlocks, checkpoint_every: int):
        self.blocks, self.every = blocks, checkpoint_every
        ids = start.join(blocks.sources, F.col("vid") == F.col("src"), "left").select("vid", F.coalesce("blocks", F.lit(0)).alias("blocks"))
        self.levels = [stable(ids)]
        self.visited = self.levels[0].select("vid")
        self.size = self.total = self.levels[0].count()
        self._kept: list[DataFrame] = []

    @property
    def depth(self) -> int:
        return len(self.levels) - 1

    def expand(self) -> None:
        level, edges = _to_blocks(self.levels[-1]), self.blocks.edges
        reached = (level.join(edges, (level["vid"] == edges["src"]) & (level["part"] == edges["part"]))
                   .groupBy(F.col("dst").alias("vid")).agg(F.first("dst_blocks").alias("blocks")).join(self.visited, "vid", "left_anti"))
        cut = (self.depth + 1) % self.every == 0
        self.levels.append(stable(reached) if cut else _persist(reached))
        self.visited = self.visited.unionByName(self.levels[-1].select("vid"))
        if cut:
            self.visited = _checkpoint(self.visited)
        self.size = self.levels[-1].count()
        self.total += self.size

    def release(self) -> None:
        for level in self.levels:
            level.unpersist()


def bfs(graph: Graph, from_expr: str | Column, to_expr: str | Column, max_path_length: int = 10,
        checkpoint_every: int = 3, num_partitions: int | None = None, count_col: str | None = None,
        block_edges: int | None = None, both_ends: bool = False, stats: dict | None = None) -> DataFrame:
    """All shortest paths from vertices matching ``from_expr`` to vertices matching ``to_expr``.

    Like GraphFrames ``bfs``: expansion stops at the first level where any path
    reaches a target, and every path of that length is returned.  Paths are
    vertex sequences over distinct edges; ``edge_paths`` is the product of the
    parallel-edge counts along the path (how many edge-level paths it stands
    for; a double, as it grows with the power of the length).  ``count_col`` names
    the number of edges that a row stands for, where they are folded already.

    Two phases, both plain joins:
    1. level-synchronous from all sources at once: the state is one row per vertex,
       its distance from the *set* of sources.  Only paths of the globally shortest
       length are wanted, and the vertex at place k of such a path has distance
       exactly k, so origins need not be carried.  With ``both_ends`` the targets are
       searched backwards too, the smaller frontier is expanded, and the search ends
       where the two meet: the length is the sum of both depths, as each level is whole;
    2. from the meeting vertices back to level 0 of either side, over edges whose other end
       lies on the level before.  Only paths that end in the output are built.
    Output: ``origin, target, hops, path`` (``"a->b->c"``), ``edge_paths``.  ``stats`` takes the number of vertices visited.
    """
    pred = lambda e: F.expr(e) if isinstance(e, str) else e
    folded = stable(_folded_counts(graph.edges, count_col))
    targets = stable(graph.vertices.filter(pred(to_expr)).select(F.col("id").alias("vid")))
    forward = _Search(graph.vertices.filter(pred(from_expr)).select(F.col("id").alias("vid")), edge_blocks(folded, block_edges, num_partitions),
                      checkpoint_every)
    backward = None
    if both_ends:
        turned = folded.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "m")
        backward = _Search(targets, edge_blocks(turned, block_edges, num_partitions), checkpoint_every)

    # The other side's newest level suffices: had an older one met this side, the search would have ended then.
    meeting = None
    while True:
        met = forward.levels[-1].select("vid").join(backward.levels[-1].select("vid") if backward else targets, "vid", "left_semi")
        if not met.isEmpty():
            meeting = met
            break
        depth = forward.depth + (backward.depth if backward else 0)
        if depth >= max_path_length or not forward.size or (backward and not backward.size):
            break
        (backward if backward and backward.size < forward.size else forward).expand()

    paths = (meeting if meeting is not None else targets.limit(0)).select(
        F.col("vid").alias("head"), F.col("vid").alias("tail"), F.array("vid").alias("path"), F.lit(1.0).alias("edge_paths"))
    if meeting is not None:
        steps = [("head", lv) for lv in reversed(forward.levels[:-1])] + ([("tail", lv) for lv in reversed(backward.levels[:-1])] if backward else [])
        for i, (end, level) in enumerate(steps, 1):
            near, far = ("dst", "src") if end == "head" else ("src", "dst")
            step = (paths.join(folded, paths[end] == folded[near])
                    .join(level.select(F.col("vid").alias("__v")), F.col(far) == F.col("__v"), "left_semi"))
            grown = F.concat(F.array("src"), "path") if end == "head" else F.concat("path", F.array("dst"))
            kept = "tail" if end == "head" else "head"
            paths = step.select(F.col(far).alias(end), kept, grown.alias("path"), (F.col("edge_paths") * F.col("m")).alias("edge_paths"))
            if i % checkpoint_every == 0:
                paths = _checkpoint(paths)
    hops = (forward.depth + (backward.depth if backward else 0)) if meeting is not None else 0
    if stats is not None:
        stats["visited"] = forward.total + (backward.total if backward else 0)
    # materialise the answer once, then release every cached intermediate
    result = _checkpoint(paths)
    for search in (forward, backward):
        if search is not None:
            search.release()
            search.blocks.release()
    for cached in (folded, targets):
        cached.unpersist()
    return result.select(
        F.col("head").alias("origin"), F.col("tail").alias("target"), F.lit(hops).alias("hops"),
        F.concat_ws("->", F.transform("path", lambda x: x.cast("string"))).alias("path"), "edge_paths")


def hop_distance(graph: Graph, landmarks: Sequence, max_hops: int | None = None,
                 checkpoint_every: int = 3, block_edges: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Hop count from every vertex to each landmark, following edge direction.

    Reverse breadth-first levels from all landmarks at once (GraphX ``ShortestPaths``
    semantics); a landmark is 0 hops from itself; unreachable pairs give no row.
    The landmarks are bits: a vertex has one row with the landmarks that it has reached, as
    many longs as 64 of them need, a level sends each vertex's *new* bits over its
    edges once and adds them by OR, and the pairs are only written out at the end.
    Output ``id, landmark, distance``.
    """
    marks = list(dict.fromkeys(landmarks))
    words = [f"w{i}" for i in range(max(1, -(-len(marks) // 64)))]
    turned = graph.edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")).distinct()
    blocks = edge_blocks(turned, block_edges, num_partitions)
    id_type = graph.vertices.schema["id"].dataType
    bits = graph.vertices.sparkSession.createDataFrame([(m, i) for i, m in enumerate(marks)], StructType().add("id", id_type).add("bit", IntegerType()))
    own = [F.coalesce(F.bit_or(F.when(F.floor(F.col("bit") / 64) == i, F.expr("shiftleft(1L, bit % 64)"))), F.lit(0).cast("long")).alias(w)
           for i, w in enumerate(words)]
    frontier = stable(graph.vertices.select("id").distinct().join(bits, "id").groupBy("id").agg(*own)
                      .join(blocks.sources.withColumnRenamed("src", "id"), "id", "left").na.fill(0, ["blocks"]))
    seen = frontier.select("id", *words)
    levels, held = [frontier.select("id", *words, F.lit(0).alias("distance"))], [frontier]
    depth = 0
    while not frontier.isEmpty() and (max_hops is None or depth < max_hops):
        depth += 1
        sent, edges = _to_blocks(frontier), blocks.edges
        arrived = (sent.join(edges, (sent["id"] == edges["src"]) & (sent["part"] == edges["part"]))
                   .groupBy(F.col("dst").alias("id")).agg(*(F.bit_or(w).alias(w) for w in words), F.first("dst_blocks").alias("blocks")))
        known = seen.select("id", *(F.col(w).alias(f"_{w}") for w in words))
        new = (arrived.join(known, "id", "left")
               .select("id", "blocks", *(F.col(w).bitwiseAND(F.bitwise_not(F.coalesce(f"_{w}", F.lit(0).cast("long")))).alias(w) for w in words))
               .filter(" OR ".join(f"{w} <> 0" for w in words)))
        cut = depth % checkpoint_every == 0
        frontier = stable(new) if cut else _persist(new)
        held.append(frontier)
        levels.append(frontier.select("id", *words, F.lit(depth).alias("distance")))
        seen = seen.unionByName(frontier.select("id", *words)).groupBy("id").agg(*(F.bit_or(w).alias(w) for w in words))
        if cut:
            levels = [_checkpoint(reduce(DataFrame.unionByName, levels))]
            seen = stable(seen)
            for old in held[:-1]:
                old.unpersist()
            held = [frontier, seen]
    reached = reduce(DataFrame.unionByName, levels)
    # Every set bit is a pair.
    pairs = reached.select("id", "distance", F.posexplode(F.array(*words)).alias("word", "value")).select(
        "id", "distance", "word", F.explode(F.filter(F.sequence(F.lit(0), F.lit(63)), lambda b: F.call_function("bit_get", F.col("value"), b) == 1)).alias("at"))
    named = bits.withColumnRenamed("id", "landmark")
    result = _checkpoint(pairs.join(named, F.col("bit") == F.col("word") * 64 + F.col("at")).select("id", "landmark", "distance"))
    blocks.release()
    for cached in held:
        cached.unpersist()
    return result


# ----------------------------------------------------------------- PageRank

def pagerank(graph: Graph, reset_probability: float = 0.15, max_iter: int | None = None,
             tol: float | None = None, mode: str = "multiplicity", weight_col: str | None = None,
             checkpoint_every: int = 5, num_partitions: int | None = None, count_col: str | None = None,
             block_edges: int | None = None) -> DataFrame:
    """PageRank with GraphX's recurrence and final normalisation.

    ``r' = reset + (1 - reset) * sum(r_src * p(src -> dst))``, all ranks start at
    1.0, and the final ranks are rescaled to sum to the number of vertices
    (rank that flows into dangling vertices is not redistributed).  Run
    ``max_iter`` rounds, or until the largest change of a round is below
    ``tol`` (whichever comes first when both are given).

    ``mode`` picks the transition probabilities:
    * ``multiplicity`` -- 1/out-degree per edge, so parallel edges count (plain
      GraphX on a multigraph; the reference's "unweighted" run);
    * ``simple``       -- each distinct (src, dst) once (the reference's
      "weighted" run, which folded fares but never passed the weight);
    * ``weight``       -- proportional to the summed ``weight_col``.
    Output ``id, pagerank``.

    A round sends differences: ``d' = (1 - reset) * sum(d_src * p)``, added to the ranks, which is the
    same recurrence, as it is linear.  A vertex whose rank did not change sends nothing.  The placed edges
    are never shuffled in a round.
    """
    if max_iter is None and tol is None:
        raise ValueError("give max_iter, tol or both")
    e = graph.edges
    if mode == "multiplicity":
        folded = _folded_counts(e, count_col).withColumnRenamed("m", "w")
    elif mode == "simple":
        folded = e.select("src", "dst").distinct().withColumn("w", F.lit(1.0))
    elif mode == "weight":
        if not weight_col:
            raise ValueError("mode='weight' needs weight_col")
        folded = e.groupBy("src", "dst").agg(F.sum(F.col(weight_col).cast("double")).alias("w"))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    folded = stable(folded)
    out_w = folded.groupBy("src").agg(F.sum("w").alias("__out"))
    verts = stable(graph.vertices.select("id").distinct())
    blocks = edge_blocks(folded.join(out_w, "src").select("src", "dst", (F.col("w") / F.col("__out")).alias("p")), block_edges, num_partitions)
    damping, edges = F.lit(1.0 - reset_probability), blocks.edges
    # All ranks start at 1.0, so the first round's differences come from the edges alone, for every vertex.
    moved = _persist(edges.select(F.col("dst").alias("id"), (damping * F.col("p")).alias("d"), F.col("dst_blocks").alias("blocks"))
                     .unionByName(verts.select("id", F.lit(reset_probability - 1.0).alias("d"), F.lit(None).cast("int").alias("blocks")))
                     .groupBy("id").agg(F.sum("d").alias("d"), F.max("blocks").alias("blocks"))
                     .join(blocks.sources.select(F.col("src").alias("id"), F.col("blocks").alias("own")), "id", "left")
                     .select("id", "d", F.coalesce("blocks", "own", F.lit(0)).alias("blocks")))
    parts, held = [verts.select("id", F.lit(1.0).alias("d")), moved.select("id", "d")], [moved]
    it = 1
    while max_iter is None or it < max_iter:
        if tol is not None:
            change = moved.agg(F.max(F.abs("d"))).first()[0]
            if change is None or change < tol:
                break
        it += 1
        sent = _to_blocks(moved.filter("d <> 0"))
        step = (sent.join(edges, (sent["id"] == edges["src"]) & (sent["part"] == edges["part"]))
                .groupBy(F.col("dst").alias("id")).agg((damping * F.sum(F.col("d") * F.col("p"))).alias("d"), F.max("dst_blocks").alias("blocks")))
        cut = it % checkpoint_every == 0
        moved = stable(step) if cut else _persist(step)
        parts.append(moved.select("id", "d"))
        held.append(moved)
        if cut:  # fold what has moved so far into the ranks
            parts = [_checkpoint(reduce(DataFrame.unionByName, parts).groupBy("id").agg(F.sum("d").alias("d")))]
            for old in held[:-1]:
                old.unpersist()
            held = [moved]
    ranks = reduce(DataFrame.unionByName, parts).groupBy("id").agg(F.sum("d").alias("rank"))
    ranks = _checkpoint(ranks)
    blocks.release()
    for cached in (folded, verts, *held):
        cached.unpersist()
    rank_sum = ranks.agg(F.sum("rank")).scalar()
    n_vertices = ranks.agg(F.count(F.lit(1))).scalar()
    return ranks.select("id", (F.col("rank") * n_vertices / rank_sum).alias("pagerank"))


def top_ranked(ranks: DataFrame, k: int = 5, rank_col: str = "pagerank") -> DataFrame:
    """The k highest-ranked vertices (ties by id)."""
    return top_k(ranks, k, [f"-{rank_col}"], ["id"])
