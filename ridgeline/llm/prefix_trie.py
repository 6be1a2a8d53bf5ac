"""Operator 13: conversation prefix trie by splitters and a skeleton.

A turn is known by 16 bytes of the digest of its role and text, a conversation
by the bytes of its turns in a row, so byte order puts conversations with a
common beginning next to each other. Equal conversations are one row before
anything is dealt out. The rows go to ranges of their first turns; a node
whose members lie in several ranges is a beginning that the last row of one
range shares with the first row of the next. These nodes are the skeleton: a
trie of the ranges' splitter paths, which is broadcast. Every other node lies
in one range and is finished there while its sorted rows stream by; for a
skeleton node each range gives a partial aggregate, and these are reduced.

The skeleton holds at most SPLITTER_TURNS nodes per range, whatever the data:
ranges are cut on the first SPLITTER_TURNS turns only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.llm.common import bound_batches, kept_table, map_batches

TURN = 16  # bytes that stand for a turn
SPLITTER_TURNS = 64
WORDS = "[^\\x20\\x09-\\x0D]+"
ENDS_CHUNK = 4096
NO_ENDS = hashlib.sha256(b"").hexdigest()
RESULT = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
          "saved_tokens long, ends_sha256 string")


def conversation_paths(turns: DataFrame) -> DataFrame:
    """Per conv_id its turns in order, as (key, words). A null role or text
    counts as empty; a null turn comes first, equal turn numbers stand by
    their keys; rows without a conv_id belong to no conversation."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * TURN)
    one = F.struct(F.col("turn"), key.alias("key"), F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words"))
    return (turns.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), one.alias("t"))
            .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")))


def rebuilt(own: DataFrame, every: int = 20, shared: int = 4) -> DataFrame:
    """Every conversation c begins with the first h turns of conversation
    c - c % every (all if there are fewer, none if it is absent), then its own
    turns after its first h; h is crc32(c) % shared."""
    base = F.col("conv_id") - F.col("conv_id") % every
    heads = own.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("_base"), F.slice("turns", 1, shared - 1).alias("_head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % shared).cast("int")
    none = F.expr("slice(turns, 1, 0)")
    joined = own.withColumn("_base", base).join(heads, "_base", "left").withColumn("_h", h)
    rest = F.slice("turns", F.col("_h") + 1, F.greatest(F.size("turns") - F.col("_h"), F.lit(0)))
    return joined.select("conv_id", F.concat(F.slice(F.coalesce("_head", none), F.lit(1), F.col("_h")), rest).alias("turns"))


def _ends(paths: DataFrame) -> DataFrame:
    """(path_id, ends_sha256) from (path_id, conv_id): the ids stream by in
    order, are written out in chunks by many tasks, and one running digest per
    path takes the chunks."""
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids = None, []
        for b in batches:
            out = []
            for path, conv in zip(b.column("path_id").to_pylist(), b.column("conv_id").to_pylist()):
                if path != at or len(ids) == ENDS_CHUNK:
                    if ids:
                        out.append((at, ids[0], ",".join(map(str, ids))))
                    at, ids = path, []
                ids.append(conv)
            yield _rows(out, (pa.binary(), pa.int64(), pa.string()), ("path_id", "first", "ids"))
        if ids:
            yield _rows([(at, ids[0], ",".join(map(str, ids)))], (pa.binary(), pa.int64(), pa.string()),
                        ("path_id", "first", "ids"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = running = None
        for b in batches:
            out = []
            for path, ids in zip(b.column("path_id").to_pylist(), b.column("ids").to_pylist()):
                if path == at:
                    running.update(b",")
                else:
                    if at is not None:
                        out.append((at, running.hexdigest()))
                    at, running = path, hashlib.sha256()
                running.update(ids.encode())
            yield _rows(out, (pa.binary(), pa.string()), ("_path_id", "ends"))
        if at is not None:
            yield _rows([(at, running.hexdigest())], (pa.binary(), pa.string()), ("_path_id", "ends"))

    dealt = paths.repartitionByRange("path_id", "conv_id").sortWithinPartitions("path_id", "conv_id")
    parts = map_batches(dealt, chunks, "path_id binary, first long, ids string")
    return map_batches(parts.repartition("path_id").sortWithinPartitions("path_id", "first").select("path_id", "ids"),
                       digests, "_path_id binary, ends string")


def _rows(rows: list[tuple], types: tuple, names: tuple) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], list(names))


def common_turns(a: bytes, b: bytes) -> int:
    """Turns that two paths begin with in common."""
    n = min(len(a), len(b)) // TURN
    if a[:n * TURN] == b[:n * TURN]:
        return n
    lo = 0  # the beginnings of lo turns are equal, those of n are not
    while n - lo > 1:
        mid = (lo + n) // 2
        if a[lo * TURN:mid * TURN] == b[lo * TURN:mid * TURN]:
            lo = mid
        else:
            n = mid
    return lo


def skeleton(splitters: list[tuple[bytes, bytes]]) -> set[bytes]:
    """The nodes that several ranges share, the root among them, from the
    (first, last) path of every range in order."""
    nodes = {b""}
    for (_, last), (first, _) in zip(splitters, splitters[1:]):
        nodes.update(last[:k * TURN] for k in range(1, common_turns(last, first) + 1))
    return nodes


_NODE_TYPES = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(),
               pa.int64(), pa.int64(), pa.string())
_NODE_NAMES = ("range", "seq", "shared", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
               "words", "ends")
_NODES = ("range long, seq long, shared binary, depth long, conv_id long, n_convs long, n_children long, n_leaves long, "
          "saved_tokens long, words long, ends string")


class _Open:
    """A node on the way from the root to the row at hand."""
    __slots__ = ("shared", "words", "first", "n", "children", "leaves", "saved", "ends")

    def __init__(self, shared: bytes | None, words: int):
        self.shared, self.words, self.first, self.ends = shared, words, None, None
        self.n = self.children = self.leaves = self.saved = 0

    def member(self, first: int, n: int) -> None:
        self.n += n
        self.first = first if self.first is None else min(first, self.first)


class Shard:
    """The rows of one range in path order; nodes are given out when their
    last member has gone by, children before parents."""

    def __init__(self, number: int, nodes: set[bytes]):
        self.number, self.nodes, self.seq, self.path = number, nodes, 0, b""
        self.open = [_Open(b"", 0)]

    def add(self, path: bytes, first: int, n: int, words: list[int], ends: str) -> Iterator[tuple]:
        keep = common_turns(self.path, path)
        yield from self.close(keep)
        for d in range(keep + 1, len(path) // TURN + 1):
            above = self.open[-1].shared
            name = path[:d * TURN] if above is not None and len(above) == (d - 1) * TURN else None
            self.open.append(_Open(name if name in self.nodes else None, words[d - 1]))
        self.path = path
        self.open[-1].member(first, n)
        self.open[-1].ends = ends

    def close(self, depth: int) -> Iterator[tuple]:
        """Gives out the open nodes below ``depth`` (-1: all of them). A
        skeleton node has what its range adds to it beside other skeleton
        nodes; its own share of saved tokens needs the whole count."""
        while len(self.open) > depth + 1:
            node = self.open.pop()
            if node.shared is None:
                node.saved += (node.n - 1) * node.words
                node.leaves = node.leaves or 1
                up = self.open[-1]
                up.member(node.first, node.n)
                up.children += 1
                up.leaves += node.leaves
                up.saved += node.saved
            yield (self.number, self.seq, node.shared, len(self.open), node.first, node.n, node.children,
                   node.leaves, node.saved, node.words, node.ends)
            self.seq += 1


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations (``rebuilt``):
    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    Null roles and texts are empty, a null turn comes first and equal turn
    numbers stand by their digests; repeated rows are turns of their own; rows
    without a conv_id are left out, other columns ignored. A conversation
    without turns after rebuilding is a member of the root. A table without
    conversations has no node. A conversation is one row of 24 bytes a turn in
    its tasks, whatever the length of its texts.
    """
    spark = turns.sparkSession
    convs = rebuilt(kept_table(conversation_paths(turns), "conversations"))
    path = F.unhex(F.array_join(F.transform("turns", lambda t: t["key"]), ""))
    convs = convs.select("conv_id", path.alias("path"), F.transform("turns", lambda t: t["words"]).alias("words"))
    convs = kept_table(convs.withColumn("path_id", F.unhex(F.sha2("path", 256))), "rebuilt")
    ends = _ends(convs.select("path_id", "conv_id"))
    distinct = convs.groupBy("path_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("first"), F.any_value("path").alias("path"),
        F.any_value("words").alias("words"))
    beginning = F.substring("path", 1, TURN * SPLITTER_TURNS)
    rows = distinct.join(ends, F.col("path_id") == F.col("_path_id")).select("path", "first", "n", "words", "ends")
    rows = kept_table(rows, "distinct").withColumn("beginning", beginning)
    ranges = kept_table(rows.repartitionByRange("beginning").withColumn("range", F.spark_partition_id().cast("long")),
                        "ranges")
    # two paths of bounded length per range
    splitters = ranges.groupBy("range").agg(F.min("beginning").alias("a"), F.max("beginning").alias("b")) \
        .orderBy("range").collect()
    if not splitters:
        return spark.createDataFrame([], RESULT)
    nodes = spark.sparkContext.broadcast(skeleton([(bytes(r.a), bytes(r.b)) for r in splitters]))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for b in batches:
            out: list[tuple] = []
            for r in b.to_pylist():
                if shard is None or shard.number != r["range"]:
                    if shard is not None:
                        out.extend(shard.close(-1))
                    shard = Shard(r["range"], nodes.value)
                out.extend(shard.add(r["path"], r["first"], r["n"], r["words"], r["ends"]))
            yield _rows(out, _NODE_TYPES, _NODE_NAMES)
        if shard is not None:
            yield _rows(list(shard.close(-1)), _NODE_TYPES, _NODE_NAMES)

    bound_batches(spark)
    sorted_rows = ranges.drop("beginning").repartition("range").sortWithinPartitions("range", "path")
    found = kept_table(map_batches(sorted_rows, shards, _NODES), "nodes")
    shared = kept_table(_reduced(found.where(F.col("shared").isNotNull())), "skeleton")
    return shared.select(RESULT_COLUMNS).unionByName(_with_parents(spark, found, shared))


RESULT_COLUMNS = [c.split(" ")[0] for c in RESULT.split(", ")]


def _beginnings(node: str) -> Column:
    """A skeleton node's path and all its beginnings, the root's among them."""
    return F.transform(F.sequence(F.lit(0), F.col("depth").cast("int")),
                       lambda d: F.substring(F.col(node), F.lit(1), d * TURN))


def _reduced(parts: DataFrame) -> DataFrame:
    """Skeleton nodes from the partial aggregates of the ranges. The parts of
    a node are summed first; then every node adds to all nodes above it."""
    total = parts.groupBy("shared", "depth").agg(
        F.min("conv_id").alias("first"), F.sum("n_convs").alias("n"), F.sum("n_children").alias("children"),
        F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"), F.max("words").alias("words"),
        F.max("ends").alias("ends"))
    total = kept_table(total, "skeleton-parts")
    below = total.select(F.explode(_beginnings("shared")).alias("above"), "shared", "first", "n", "leaves", "saved")
    members = below.groupBy("above").agg(F.min("first").alias("conv_id"), F.sum("n").alias("n_convs"),
                                         F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    up = F.substring(F.col("shared"), F.lit(1), ((F.col("depth") - 1) * TURN).cast("int"))
    kids = total.where("depth > 0").select(up.alias("above")).groupBy("above").agg(F.count(F.lit(1)).alias("kids"))
    node = (total.select(F.col("shared").alias("above"), "depth", "children", "words", "ends")
            .join(members, "above").join(kids, "above", "left")
            .withColumn("n_children", F.col("children") + F.coalesce("kids", F.lit(0)))
            .withColumn("own_saved", (F.col("n_convs") - 1) * F.col("words"))
            .withColumn("own_leaf", F.when(F.col("n_children") == 0, 1).otherwise(0)))
    node = kept_table(node.withColumnRenamed("above", "shared"), "skeleton-nodes")
    own = node.select(F.explode(_beginnings("shared")).alias("above"), "own_saved", "own_leaf").groupBy("above").agg(
        F.sum("own_saved").alias("own_saved"), F.sum("own_leaf").alias("own_leaf")).withColumnRenamed("above", "_node")
    names = node.select(F.col("shared").alias("_up"), F.col("conv_id").alias("parent_conv_id"))
    joined = (node.drop("own_saved", "own_leaf").join(own, F.col("shared") == F.col("_node"))
              .withColumn("_above", F.when(F.col("depth") > 0, up)).join(names, F.col("_above") == F.col("_up"), "left"))
    return joined.select("shared", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
                         (F.col("leaves") + F.col("own_leaf")).alias("n_leaves"),
                         (F.col("saved") + F.col("own_saved")).alias("saved_tokens"),
                         F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"))


def _with_parents(spark: SparkSession, found: DataFrame, shared: DataFrame) -> DataFrame:
    """The finished nodes with their parents' smallest members: a shard's
    nodes from the last to the first, so that a parent comes before its
    children."""
    names = spark.sparkContext.broadcast({bytes(r.shared): r.conv_id for r in shared.select("shared", "conv_id").collect()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: list[int] = []
        for b in batches:
            out = []
            for r in b.to_pylist():
                d = r["depth"]
                del above[d:]
                if r["shared"] is not None:
                    above.append(names.value[r["shared"]])
                    continue
                out.append((r["conv_id"], d, above[d - 1], r["n_convs"], r["n_children"], r["n_leaves"],
                            r["saved_tokens"], r["ends"] or NO_ENDS))
                above.append(r["conv_id"])
            yield _rows(out, (*[pa.int64()] * 7, pa.string()), tuple(RESULT_COLUMNS))

    back = found.repartition("range").sortWithinPartitions("range", F.col("seq").desc())
    return map_batches(back, run, RESULT)


def oracle_sql() -> str:
    from ridgeline.llm.merkle import crc32_sql
    return f"""
WITH read AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
              WHERE conv_id IS NOT NULL),
keyed AS (SELECT conv_id, turn, substr(sha256(strlen(role) || ':' || role || text), 1, 32) AS key,
                 len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words FROM read),
own AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key) AS pos FROM keyed),
convs AS (SELECT conv_id, {crc32_sql('CAST(conv_id AS VARCHAR)')} % 4 AS h FROM (SELECT DISTINCT conv_id FROM own)),
joined AS (
  SELECT c.conv_id, 0 AS side, o.pos, o.key, o.words FROM convs c
  JOIN own o ON o.conv_id = c.conv_id - c.conv_id % 20 AND o.pos <= c.h
  UNION ALL
  SELECT c.conv_id, 1, o.pos, o.key, o.words FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.pos > c.h),
placed AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY side, pos) AS depth, key, words FROM joined),
members AS (
  SELECT conv_id, depth, words, string_agg(key, '') OVER (PARTITION BY conv_id ORDER BY depth) AS node FROM placed
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
lengths AS (SELECT conv_id, max(depth) AS depth FROM members GROUP BY conv_id),
nodes AS (
  SELECT m.node, m.depth, min(m.conv_id) AS conv_id, count(*) AS n, any_value(m.words) AS words,
         coalesce(string_agg(CAST(m.conv_id AS VARCHAR), ',' ORDER BY m.conv_id) FILTER (WHERE l.depth = m.depth), '') AS ends
  FROM members m JOIN lengths l ON l.conv_id = m.conv_id GROUP BY m.node, m.depth),
kids AS (SELECT substr(node, 1, 32 * (depth - 1)) AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
valued AS (SELECT n.*, coalesce(k.n, 0) AS n_children, (n.n - 1) * n.words AS own_saved
           FROM nodes n LEFT JOIN kids k ON k.node = n.node),
below AS (  -- every node counts for all nodes above it, found along its smallest member
  SELECT m.node, sum(CASE WHEN v.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(v.own_saved) AS saved
  FROM valued v JOIN members m ON m.conv_id = v.conv_id AND m.depth <= v.depth GROUP BY m.node)
SELECT v.conv_id, CAST(v.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, v.n AS n_convs, v.n_children,
       CAST(b.n_leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, sha256(v.ends) AS ends_sha256
FROM valued v JOIN below b ON b.node = v.node
LEFT JOIN valued p ON v.depth > 0 AND p.node = substr(v.node, 1, 32 * (v.depth - 1))"""
