"""Operator 11: Merkle dataset manifest with incremental witnesses.

Leaves are appended to aligned blocks of ``8 ** BLOCK_LEVELS`` places. A block
holds the open run of every level: a new node gets the digests of the run's
earlier nodes as its partial witness, and each later node of the run extends
the witnesses before it; a full run (or the last one) completes their parent,
which is appended one level up. The roots of blocks are appends to the next
tree, which is dealt to blocks in the same way, until each group has one root;
the roots of the groups are then the leaves of the last tree.

Blocks are the unit of distribution: rows stream through a task sorted by
(tree, block, place), so a task holds one block. Going up, a block gives its
root only; going down, the block's own witness arrives as its first row and is
put behind those of its leaves, so no witness is shuffled with a leaf.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import kept_table, map_batches
from ridgeline.llm.ranks import ranked

FAN = 8
BLOCK_LEVELS = 4


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Block:
    """Leaves appended one by one; ``levels`` runs above them are completed."""

    def __init__(self, levels: int, witnesses: bool = True):
        # a node of a run: digest, its first and last leaf, and its witness
        # within the run (the digests before it, and those after it)
        self.runs: list[list[list]] = [[] for _ in range(levels + 1)]
        self.levels, self.leaves, self.keep = levels, 0, witnesses
        self.witness: list[list[str]] = []  # per leaf: left, right, level by level

    def append(self, digest: str) -> None:
        if self.keep:
            self.witness.append([])
        self._attach(0, digest, self.leaves, self.leaves)
        self.leaves += 1

    def _attach(self, level: int, digest: str, first: int, last: int) -> None:
        run = self.runs[level]
        if self.keep:
            for node in run:
                node[4].append(digest)
            run.append([digest, first, last, "".join([n[0] for n in run]), []])
        else:
            run.append([digest, first, last])
        if len(run) == FAN and level < self.levels:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run = self.runs[level]
        if self.keep:
            for _, first, last, left, later in run:
                right = "".join(later)
                for leaf in range(first, last + 1):
                    self.witness[leaf] += (left, right)
        digest = sha("".join([n[0] for n in run]))
        first, last = run[0][1], run[-1][2]
        run.clear()
        self._attach(level + 1, digest, first, last)

    def root(self) -> str:
        """Completes the open runs."""
        for level in range(self.levels):
            if self.runs[level]:
                self._complete(level)
        return self.runs[self.levels][0][0]


def levels_of(n: int, height: int) -> int:
    """Levels that a block of a tree with ``n`` leaves completes."""
    levels = 0
    while n > 1 and levels < height:
        n, levels = -(-n // FAN), levels + 1
    return levels


def fold(digest: str, path: list[str]) -> str:
    """The root that a leaf and its witness (left, right, level by level) give."""
    for i in range(0, len(path), 2):
        digest = sha(path[i] + digest + path[i + 1])
    return digest


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[dict]]]:
    """The rows of each (tree, block), one block at a time."""
    at, rows = None, []
    for b in batches:
        for r in b.to_pylist():
            key = r["tree"], r["block"]
            if key != at and rows:
                yield at, rows
                rows = []
            at = key
            rows.append(r)
    if rows:
        yield at, rows


def _block_roots(nodes: DataFrame, height: int) -> DataFrame:
    """(tree, pos, n, digest) of the next tree: one row per block."""
    size = FAN ** height
    dealt = (nodes.select("tree", F.floor(F.col("pos") / size).cast("long").alias("block"), "pos", "n", "digest")
             .repartition("tree", "block").sortWithinPartitions("tree", "block", "pos"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for (tree, block), rows in _runs(batches):
            grown = Block(levels_of(rows[0]["n"], height), witnesses=False)
            for r in rows:
                grown.append(r["digest"].hex())
            out.append((tree, block, -(-rows[0]["n"] // size), bytes.fromhex(grown.root())))
            if len(out) >= 1000:
                yield _batch(out)
                out = []
        yield _batch(out)

    def _batch(out):
        cols = list(zip(*out)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (
            pa.int64(), pa.int64(), pa.int64(), pa.binary()))], ["tree", "pos", "n", "digest"])

    return map_batches(dealt, run, "tree long, pos long, n long, digest binary")


def _rounds(n: int, height: int) -> int:
    """Rounds of blocks until a tree of ``n`` leaves is one node."""
    rounds = 1
    while n > FAN ** height:
        n, rounds = -(-n // FAN ** height), rounds + 1
    return rounds


def _down(nodes: DataFrame, above: DataFrame, more: list[str],
          result: Callable[[dict, list[str], dict], tuple], schema: str, height: int) -> DataFrame:
    """A row per node: ``result(row, its witness up to the root, the block's
    own row)``. ``above`` has tree, pos (the block), path, subroot and root."""
    size = FAN ** height
    header = {"path": "array<string>", "subroot": "string", "root": "string"}
    rows = nodes.select("tree", F.floor(F.col("pos") / size).cast("long").alias("block"), "pos", "n", "digest", *more,
                        *(F.lit(None).cast(t).alias(c) for c, t in header.items()))
    # a block's own row sorts before its leaves
    heads = above.select("tree", F.col("pos").alias("block"), F.lit(-1).cast("long").alias("pos"),
                         F.lit(0).cast("long").alias("n"), F.lit(None).cast("binary").alias("digest"),
                         *(F.lit(None).cast(nodes.schema[c].dataType).alias(c) for c in more), *header)
    both = rows.unionByName(heads).repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (head, *rows) in _runs(batches):
            grown = Block(levels_of(rows[0]["n"], height))
            for r in rows:
                grown.append(r["digest"].hex())
            grown.root()
            out = [result(r, w + head["path"], head) for r, w in zip(rows, grown.witness)]
            for lo in range(0, len(out), 1000):
                cols = zip(*out[lo:lo + 1000])
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow)], arrow.names)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    return map_batches(both, run, schema)


def _climb(nodes: DataFrame, rounds: int, height: int) -> tuple[DataFrame, list[DataFrame]]:
    """The roots of the trees, and the nodes of every round below them."""
    below = [nodes]
    for _ in range(rounds):
        below.append(kept_table(_block_roots(below[-1], height), "block-roots"))
    return below.pop(), below


_PATHS = "tree long, pos long, path array<string>, subroot string, root string"


def _descend(above: DataFrame, below: list[DataFrame], height: int) -> DataFrame:
    """The witnesses of the blocks of the lowest round."""
    for nodes in reversed(below[1:]):
        above = kept_table(_down(nodes, above, [], lambda r, path, head: (
            r["tree"], r["pos"], path, head["subroot"], head["root"]), _PATHS, height), "paths")
    return above


def leaf(doc_id: str, source: str, lang: str, n_chars: str, text: Column) -> Column:
    """A document's leaf digest (lower-case hex) from column names and its text."""
    def part(c: Column) -> Column:
        c = c.cast("string")
        return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c))
    return F.sha2(F.concat(*(part(F.col(c)) for c in (doc_id, source, lang, n_chars)), part(text)), 256)


def manifest(docs: DataFrame, found: Column | None = None, keep_path: bool = False,
             height: int = BLOCK_LEVELS) -> DataFrame:
    """Per document: doc_id, leaf, subroot (of its lang), root, proof_sha256
    (hash of the witness), folded_root (from the leaf of ``found``, the text
    as it is met now, and the witness), verified (folded_root equals root),
    and with ``keep_path`` the witness itself, left and right siblings of
    every level in turn. ``docs`` needs doc_id, source, lang, n_chars, text; a
    task holds ``8 ** height`` leaves.

    Leaves stand by doc_id (null first, ties by leaf; equal rows are equal
    leaves in neighbouring places), a null lang is a group of its own and the
    first. Null and empty fields differ (``-`` and ``0:``). A group of one
    leaf has that leaf as subroot. Other columns are ignored; an empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    text = F.col("text")
    own = leaf("doc_id", "source", "lang", "n_chars", text)
    rows = docs.select("doc_id", "lang", F.unhex(own).alias("digest"),
                       *([] if found is None else [
                           F.when(found.eqNullSafe(text), F.lit(None).cast("binary")).otherwise(
                               F.unhex(leaf("doc_id", "source", "lang", "n_chars", found))).alias("met")]))
    if found is None:
        rows = rows.withColumn("met", F.lit(None).cast("binary"))
    nodes = kept_table(ranked(rows, "lang", ["doc_id", "digest"]).drop("lang"), "leaves")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {id_type}, leaf string, subroot string, root string, proof_sha256 string, "
              "folded_root string, verified boolean" + (", path array<string>" if keep_path else ""))
    most = nodes.agg(F.max("n").alias("n"), F.max("tree").alias("tree")).first()
    if most.n is None:
        return spark.createDataFrame([], schema)
    roots, below = _climb(nodes, _rounds(most.n, height), height)
    trees = roots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"),
                         F.lit(most.tree + 1).cast("long").alias("n"), "digest")
    top, upper = _climb(trees, _rounds(most.tree + 1, height), height)
    whole = F.lower(F.hex("digest"))
    above = _descend(top.select("tree", "pos", F.array().cast("array<string>").alias("path"),
                                whole.alias("subroot"), whole.alias("root")), upper, height)
    above = kept_table(_down(trees, above, [], lambda r, path, head: (
        r["pos"], 0, path, r["digest"].hex(), head["root"]), _PATHS, height), "subroots")
    above = _descend(above, below, height)

    def finished(r: dict, path: list[str], head: dict) -> tuple:
        digest = r["digest"].hex()
        folded = fold(digest if r["met"] is None else r["met"].hex(), path)
        out = (r["doc_id"], digest, head["subroot"], head["root"], sha("".join(path)), folded, folded == head["root"])
        return (*out, path) if keep_path else out

    return _down(nodes, above, ["doc_id", "met"], finished, schema, height)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def audit(docs: DataFrame, height: int = BLOCK_LEVELS) -> DataFrame:
    """The manifest against texts of which those with a crc32 of the doc_id
    that 3 divides were lower-cased (a null id is left alone)."""
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    return manifest(docs, F.when(tampered, ascii_lower(F.col("text"))).otherwise(F.col("text")), height=height)


# Levels that the SQL form writes out: up to 8 ** SQL_LEVELS documents of a
# lang and 8 ** 3 langs.
SQL_LEVELS = 7


def _sql_tree(nodes: str, tree: str, levels: int, name: str) -> str:
    """CTEs of a tree's runs: <name>_run<level>(tree, run, ds, n) over
    ``nodes`` (tree, pos, n, digest), and <name>_top(tree, digest)."""
    out, below = [], nodes
    for k in range(levels):
        out.append(f"{name}_run{k} AS (SELECT tree, pos // {FAN} AS run, list(digest ORDER BY pos) AS ds, any_value(n) AS n "
                   f"FROM {below} GROUP BY ALL)")
        out.append(f"{name}_{k + 1} AS (SELECT tree, run AS pos, (n + {FAN - 1}) // {FAN} AS n, "
                   f"CASE WHEN n > 1 THEN sha256(array_to_string(ds, '')) ELSE ds[1] END AS digest FROM {name}_run{k})")
        below = f"{name}_{k + 1}"
    return ",\n".join(out) + f",\n{name}_top AS (SELECT tree, digest FROM {below})"


def _sql_path(source: str, tree: str, levels: int, name: str, pos: str) -> str:
    """CTEs that carry (cur, proof) of the rows of ``source`` up a tree."""
    out, below = [], source
    for k in range(levels):
        at = f"({pos} // {FAN ** k}) % {FAN}"
        out.append(f"{name}_at{k} AS (SELECT s.* EXCLUDE (cur, proof), "
                   f"CASE WHEN r.n > 1 THEN sha256(array_to_string(r.ds[1:{at}], '') || cur || "
                   f"array_to_string(r.ds[{at} + 2:], '')) ELSE cur END AS cur, "
                   f"proof || CASE WHEN r.n > 1 THEN array_to_string(r.ds[1:{at}], '') || "
                   f"array_to_string(r.ds[{at} + 2:], '') ELSE '' END AS proof "
                   f"FROM {below} s JOIN {name}_run{k} r ON r.tree = {tree} AND r.run = {pos} // {FAN ** (k + 1)})")
        below = f"{name}_at{k}"
    return ",\n".join(out)


def crc32_sql(ascii_text: str) -> str:
    """crc32 of a text of ASCII characters in DuckDB: one bit at a time."""
    bits = (f"flatten(list_transform(range(1, length({ascii_text}) + 1), "
            f"lambda i: [CAST(ascii(substr({ascii_text}, CAST(i AS BIGINT), 1)) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))")
    step = "xor(xor(a, b) >> 1, CASE WHEN xor(a, b) & 1 = 1 THEN 3988292384 ELSE 0 END)"
    return f"xor(4294967295, list_reduce([CAST(4294967295 AS BIGINT)] || {bits}, lambda a, b: {step}))"


def oracle_sql() -> str:
    def part(c):
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END"
    head = " || ".join(part(c) for c in ("doc_id", "source", "lang", "n_chars"))
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH read AS (
  SELECT *, CASE WHEN {crc32_sql('CAST(doc_id AS VARCHAR)')} % 3 = 0 THEN {lower} ELSE text END AS found FROM documents),
hashed AS (SELECT doc_id, lang, sha256({head} || {part('text')}) AS leaf, sha256({head} || {part('found')}) AS met FROM read),
leaves AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY lang) AS n,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, leaf AS digest FROM hashed),
{_sql_tree('leaves', 'tree', SQL_LEVELS, 'a')},
subs AS (SELECT 0 AS tree, tree AS pos, (SELECT count(*) FROM a_top) AS n, digest FROM a_top),
{_sql_tree('subs', 'tree', 3, 'b')},
low AS (SELECT doc_id, tree, pos, leaf, met AS cur, '' AS proof FROM leaves),
{_sql_path('low', 's.tree', SQL_LEVELS, 'a', 's.pos')},
{_sql_path(f'a_at{SQL_LEVELS - 1}', '0', 3, 'b', 's.tree')}
SELECT doc_id, leaf, t.digest AS subroot, u.digest AS root, sha256(proof) AS proof_sha256, cur AS folded_root,
       cur = u.digest AS verified
FROM b_at2 s JOIN a_top t ON t.tree = s.tree CROSS JOIN b_top u"""
