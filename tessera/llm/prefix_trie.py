"""The prefix trie of conversations, from ternary search trees over range shards.

Turns are encoded by a dictionary of the distinct (role, text) pairs, so texts leave the scan
only as digests.  Every conversation becomes a list of turn ids; equal lists become one row
with their number.  The lists are dealt to shards by range, so each trie node lies in one shard,
or in neighbouring shards that begin or end with it.  A shard's lists go into one
ternary search tree, the median first and then the medians of both halves, and an iterative traversal sums
members, leaves and savings upwards.  Only nodes on the way to a shard's first or last list
(its spines) can have parts elsewhere: those are merged over shards, and what the
merged nodes add to nodes above them is summed along each shard's spines.

Members that end at a node are hashed in order of their ids: the ids are joined into chunks by
range first, so the one pass over a node's members reads a row per chunk.

Defined cases: rows with a NULL conversation id take no part; NULL role or text counts as empty;
NULL turns come first and turns of one number go by their digest; rows that repeat are turns of
their own; an empty table has no nodes; other columns are ignored.  A conversation's turn ids
(not its texts) must fit a task: 12 bytes a turn.  The group of an id is ``id - id % 100`` with
the sign of SQL's remainder.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import staged

GROUP = 100
HEADS = 6
TURNS_PER_SHARD = 25_000
CHUNK_IDS = 4096
_NODE = ("shard int, key binary, parent_key binary, boundary boolean, side int, depth long, n_convs long, conv_id long, "
         "n_children long, n_leaves long, saved_tokens long, tokens long, up_key binary, up_conv long, list_no long")


# Turns, dictionary, lists.

def turn_rows(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, digest, n_points``: the rows that take part; the text stays behind."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    # The role's length keeps (role, text) pairs apart.
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    return (conversations.filter(F.col("conv_id").isNotNull())
            .select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), digest.alias("digest"),
                    F.char_length(text).cast("long").alias("n_points")))


def encode_turns(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """``conv_id, turn, id, n_points``: digests replaced by ids of a dictionary, in order of the digests."""
    rows = staged(spark, rows, "trie-turns")
    words = rows.select("digest").distinct()
    dictionary = staged(spark, words.repartitionByRange("digest").sortWithinPartitions("digest")
                        .withColumn("id", F.monotonically_increasing_id()), "trie-dictionary")
    return rows.join(dictionary, "digest").drop("digest")


def turn_lists(turns: DataFrame) -> DataFrame:
    """``conv_id, ids, points``: every conversation's own turns in order."""
    in_order = F.sort_array(F.collect_list(F.struct("turn", "id", "n_points")))  # NULL turns first
    return (turns.groupBy("conv_id").agg(in_order.alias("t"))
            .select("conv_id", F.col("t.id").alias("ids"), F.col("t.n_points").alias("points")))


def rebuilt(spark: SparkSession, lists: DataFrame, group: int = GROUP, heads: int = HEADS) -> DataFrame:
    """Each conversation's first ``h`` turns taken from the first of its group; ``h = crc32(id) % heads``."""
    lists = staged(spark, lists, "trie-lists")
    head = F.col("conv_id") - F.col("conv_id") % group
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    firsts = (lists.filter(F.col("conv_id") == head)
              .select(F.col("conv_id").alias("head"), F.slice("ids", 1, heads).alias("first_ids"), F.slice("points", 1, heads).alias("first_points")))

    def joined(first: str, own: str) -> F.Column:
        return F.concat(F.coalesce(F.slice(first, F.lit(1), F.col("h")), F.array().cast("array<long>")),
                        F.slice(own, F.col("h") + 1, F.greatest(F.size(own) - F.col("h"), F.lit(0))))

    return (lists.withColumn("head", head).withColumn("h", h).join(firsts, "head", "left")
            .select("conv_id", joined("first_ids", "ids").alias("ids"), joined("first_points", "points").alias("points")))


# A shard's tree.

class TernaryTree:
    """A ternary search tree over lists of integers; node 0 is the root above all first turns.

    ``lo``, ``hi`` link nodes of one trie level, ``eq`` leads to the next level; ``up`` is the trie parent.
    """

    def __init__(self) -> None:
        self.word, self.lo, self.eq, self.hi, self.up = [0], [-1], [-1], [-1], [-1]
        self.tokens, self.own, self.least = [0], [0], [None]

    def _node(self, word: int, tokens: int, up: int) -> int:
        for column, value in ((self.word, word), (self.lo, -1), (self.eq, -1), (self.hi, -1), (self.up, up),
                              (self.tokens, tokens), (self.own, 0), (self.least, None)):
            column.append(value)
        return len(self.word) - 1

    def insert(self, ids: list[int], tokens: list[int], members: int, least: int) -> int:
        at = 0
        for word, size in zip(ids, tokens):
            links, place, node = self.eq, at, self.eq[at]
            while node >= 0 and self.word[node] != word:
                links, place = (self.lo if word < self.word[node] else self.hi), node
                node = links[place]
            if node < 0:
                node = links[place] = self._node(word, size, at)
            at = node
        self.own[at] += members
        self.least[at] = least if self.least[at] is None else min(self.least[at], least)
        return at

    def path(self, node: int) -> list[int]:
        out = []
        while node > 0:
            out.append(node)
            node = self.up[node]
        return [0, *reversed(out)]


def median_order(n: int) -> Iterator[int]:
    """0 to n - 1, the middle first, then the middles of both halves."""
    spans = [(0, n)]
    while spans:
        a, b = spans.pop()
        if a < b:
            mid = (a + b) // 2
            yield mid
            spans += [(mid + 1, b), (a, mid)]


def shard_nodes(lists: list[tuple[list[int], list[int], int, int]]) -> Iterator[dict]:
    """The trie nodes of a shard's sorted lists ``(ids, points, members, least id)``.

    A node on a spine carries its own part of the sums: what its subtree holds besides other
    spine nodes.  Every node has a key: the digest of its turn ids, chained from the root.
    """
    tree = TernaryTree()
    ends = [-1] * len(lists)
    for i in median_order(len(lists)):
        ends[i] = tree.insert(*lists[i])
    n = len(tree.word)
    # Nodes are made after their parents, so one pass from the end sums upwards and one from the start chains keys.
    left, right = tree.path(ends[0]), tree.path(ends[-1])
    boundary = set(left) | set(right)
    trunk = set(left) & set(right)
    members, least = list(tree.own), list(tree.least)
    children, leaves, saved = [0] * n, [0] * n, [0] * n
    for v in range(n - 1, -1, -1):
        if v not in boundary:
            leaves[v] += not children[v]
            saved[v] += (members[v] - 1) * tree.tokens[v]
        up = tree.up[v]
        if up >= 0:
            members[up] += members[v]
            least[up] = least[v] if least[up] is None else min(least[up], least[v])
            if v not in boundary:
                children[up] += 1
                leaves[up] += leaves[v]
                saved[up] += saved[v]
    keys, depth = [b""] * n, [0] * n
    list_at = {v: i for i, v in enumerate(ends)}
    for v in range(n):
        up = tree.up[v]
        if up >= 0:
            keys[v] = hashlib.blake2b(keys[up] + tree.word[v].to_bytes(8, "little"), digest_size=24).digest()
            depth[v] = depth[up] + 1
        inner_parent = up >= 0 and up not in boundary
        branch = 1 if depth[v] < len(left) and left[depth[v]] == v else 2
        yield {
            "key": keys[v], "parent_key": keys[up] if up >= 0 else None, "boundary": v in boundary,
            "side": (0 if v in trunk else branch) if v in boundary else None,
            "depth": depth[v], "n_convs": members[v], "conv_id": least[v], "n_children": children[v], "n_leaves": leaves[v],
            "saved_tokens": saved[v], "tokens": tree.tokens[v], "up_key": keys[up] if up >= 0 and not inner_parent else None,
            "up_conv": least[up] if inner_parent else None, "list_no": list_at.get(v)}


# The operator.

def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One task is one shard: its rows come sorted."""
    lists, numbers, shard = [], [], None
    for batch in batches:
        shard = batch.column(0)[0].as_py() if batch.num_rows and shard is None else shard
        numbers += batch.column(1).to_pylist()
        lists += zip(*(batch.column(i).to_pylist() for i in range(2, 6)))
    if not lists:
        return
    nodes = shard_nodes(lists)
    while part := list(itertools.islice(nodes, 5_000)):
        rows = [{"shard": shard} | v | {"list_no": None if v["list_no"] is None else numbers[v["list_no"]]} for v in part]
        yield pa.RecordBatch.from_pylist(rows, schema=_NODE_ARROW)


_NODE_ARROW = pa.schema([(f.split(" ")[0], {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}[f.split(" ")[1]])
                         for f in _NODE.split(", ")])


def merged_spines(spark: SparkSession, nodes: DataFrame) -> DataFrame:
    """``key, n_convs, conv_id, n_children, n_leaves, saved_tokens``: the spine nodes, merged over shards."""
    spine = nodes.filter("boundary")
    whole = spine.groupBy("key").agg(
        F.first("parent_key").alias("parent_key"), F.sum("n_convs").alias("m"), F.min("conv_id").alias("c"),
        F.sum("n_children").alias("inner_children"), F.min("shard").alias("home"), F.first("tokens").alias("tokens"))
    whole = staged(spark, whole, "trie-spines")
    spine_children = whole.filter("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("s"))
    whole = (whole.join(spine_children, "key", "left")
             .select("key", "m", "c", "home", "tokens", (F.col("inner_children") + F.coalesce("s", F.lit(0))).alias("n_children")))
    # A spine node's own leaf and savings count once: in the first shard that holds it.
    at_home = F.col("shard") == F.col("home")
    parts = (spine.select("shard", "key", "side", "depth", F.col("n_leaves").alias("l"), F.col("saved_tokens").alias("t")).join(whole, "key")
             .withColumn("l", F.col("l") + F.when(at_home & (F.col("n_children") == 0), 1).otherwise(0))
             .withColumn("t", F.col("t") + F.when(at_home, (F.col("m") - 1) * F.col("tokens")).otherwise(0)))
    below = Window.partitionBy("shard", "side").orderBy(F.desc("depth"))  # a spine's nodes from its end upwards
    branches = (parts.filter("side > 0").groupBy("shard").agg(F.sum("l").alias("bl"), F.sum("t").alias("bt")))
    summed = (parts.withColumn("sl", F.sum("l").over(below)).withColumn("st", F.sum("t").over(below))
              .join(branches, "shard", "left")
              .withColumn("sl", F.col("sl") + F.when(F.col("side") == 0, F.coalesce("bl", F.lit(0))).otherwise(0))
              .withColumn("st", F.col("st") + F.when(F.col("side") == 0, F.coalesce("bt", F.lit(0))).otherwise(0)))
    return summed.groupBy("key").agg(F.first("m").alias("n_convs"), F.first("c").alias("conv_id"), F.first("n_children").alias("n_children"),
                                     F.sum("sl").alias("n_leaves"), F.sum("st").alias("saved_tokens"))


def ends_digests(spark: SparkSession, members: DataFrame) -> DataFrame:
    """``list_no, ends_sha256``: SHA-256 of each list's conversation ids, ascending, joined by commas."""
    dealt = members.repartitionByRange("list_no", "conv_id").sortWithinPartitions("list_no", "conv_id").select("list_no", "conv_id")

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_no, ids = None, []

        def flush() -> Iterator[pa.RecordBatch]:
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array([open_no], pa.int64()), pa.array([ids[0]], pa.int64()),
                                                  pa.array([",".join(map(str, ids))], pa.string())], names=["list_no", "first", "part"])

        for batch in batches:
            for number, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if number != open_no or len(ids) >= CHUNK_IDS:
                    yield from flush()
                    open_no, ids = number, []
                ids.append(conv)
        yield from flush()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_no, state = None, None
        for batch in batches:
            done = []
            for number, part in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if number != open_no:
                    if state is not None:
                        done.append((open_no, state.hexdigest()))
                    open_no, state = number, hashlib.sha256(part.encode())
                else:
                    state.update(b"," + part.encode())
            if done:
                yield _digest_rows(done)
        if state is not None:
            yield _digest_rows([(open_no, state.hexdigest())])

    parts = staged(spark, dealt.mapInArrow(chunks, "list_no long, first long, part string"), "trie-ends")
    return (parts.repartition("list_no").sortWithinPartitions("list_no", "first")
            .mapInArrow(digest, "list_no long, ends_sha256 string"))


def _digest_rows(done: list[tuple[int, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([n for n, _ in done], pa.int64()), pa.array([d for _, d in done], pa.string())],
                                      names=["list_no", "ends_sha256"])


def prefix_trie(spark: SparkSession, conversations: DataFrame, group: int = GROUP, heads: int = HEADS,
                turns_per_shard: int = TURNS_PER_SHARD) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``: one row per trie node."""
    lists = staged(spark, rebuilt(spark, turn_lists(encode_turns(spark, turn_rows(conversations))), group, heads), "trie-rebuilt")
    distinct = lists.groupBy("ids", "points").agg(F.count("*").alias("members"), F.min("conv_id").alias("least"))
    distinct = staged(spark, distinct.withColumn("list_no", F.monotonically_increasing_id()), "trie-distinct")
    size = distinct.agg(F.coalesce(F.sum(F.size("ids") + 1), F.lit(0))).first()[0]
    if not size:
        return spark.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
                                         "saved_tokens long, ends_sha256 string")
    shards = max(1, -(-size // turns_per_shard))
    dealt = (distinct.repartitionByRange(shards, "ids").sortWithinPartitions("ids")
             .select(F.spark_partition_id().alias("shard"), "list_no", "ids", "points", "members", "least"))
    nodes = staged(spark, dealt.mapInArrow(_trees, _NODE), "trie-nodes")
    spines = staged(spark, merged_spines(spark, nodes), "trie-merged")

    numbers = ["n_convs", "conv_id", "n_children", "n_leaves", "saved_tokens"]
    inner = nodes.filter("NOT boundary").select("shard", "depth", "key", "up_key", "up_conv", *numbers)
    # A spine node is told once, with the list that ends at it if one does (a list lies in one shard).
    spine = (nodes.filter("boundary").groupBy("key").agg(F.first("depth").alias("depth"), F.first("parent_key").alias("up_key"))
             .join(spines, "key").withColumn("up_conv", F.lit(None).cast("long")))
    # Of an inner node's parents only spine nodes are looked up, shard by shard: the root has children in all of them.
    known = (nodes.filter("boundary").select("shard", F.col("key").alias("up_key")).join(
        spines.select(F.col("key").alias("up_key"), F.col("conv_id").alias("spine_conv")), "up_key"))
    parent = F.coalesce("up_conv", "spine_conv").alias("parent_conv_id")
    told = (inner.join(known, ["shard", "up_key"], "left").select("key", "depth", parent, *numbers)
            .unionByName(spine.join(spines.select(F.col("key").alias("up_key"), F.col("conv_id").alias("spine_conv")), "up_key", "left")
                         .select("key", "depth", parent, *numbers)))
    # The members are looked up by list; a third of them may share one.
    ends = ends_digests(spark, lists.join(distinct.select("ids", "list_no"), "ids").select("list_no", "conv_id"))
    at_node = nodes.filter("list_no IS NOT NULL").select("key", "list_no")
    nothing = hashlib.sha256(b"").hexdigest()
    return (told.join(ends.join(at_node, "list_no").select("key", "ends_sha256"), "key", "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256")))


__all__ = ["turn_rows", "encode_turns", "turn_lists", "rebuilt", "TernaryTree", "median_order", "shard_nodes", "merged_spines",
           "ends_digests", "prefix_trie"]
