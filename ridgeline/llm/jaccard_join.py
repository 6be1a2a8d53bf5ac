"""Operator 8: n-gram Jaccard join by T-occurrence search.

Documents with equal shingle sets are one node. A node with more shingles of
its own than the link rule lets it have links to nothing and is left out (see
``nodes_that_may_link``). Two nodes that link share a shingle of their prefixes (the rarest fifth of a set under one global order),
so nodes that are connected through shared prefix shingles form independent
groups; only nodes in a group of at least two are looked at further, each
shipped once. Within a block of a group:

* leaders are indexed by inverted lists of their shingles; a node finds the
  leaders within twice the link distance by T-occurrence search (``DivideSkip``:
  the short lists are heap-merged, the long ones binary-probed);
* a node that links to a leader becomes its member, otherwise a leader;
* Jaccard distance is a metric, so a link to a member of another leader needs
  that leader within twice the link distance, and the member at least (distance
  to the leader - link distance) away from it; those members are compared
  unless already connected. No link is lost, and copies of copies cost one
  comparison each instead of one per pair.

A group larger than a block is split over blocks; the same argument applied to
the leaders of different blocks says which of their members still have to
meet. The order of shingles goes by frequency, counted over all documents in
hash cells; the number of cells is bounded, so the table of their sizes is
broadcast. Any one order is right: cells shared by chance only make it coarser.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import bound_batches, kept_table, located, map_batches, result_kept
from ridgeline.llm.components import components, spanning_edges
from ridgeline.llm.shingles import mix, shingle_sets
from ridgeline.session import remove_scratch, scratch_path

# Shingles are counted in at most 2 ** CELL_BITS cells of one byte each.
CELL_BITS = 26
# Shingles a task gathers before it writes them out, sorted, per bucket.
FLUSH = 4_000_000
# Shingles per bucket of a shuffle, and per block of the search.
BUCKET = 2_000_000
BLOCK = 600_000
# A text weighs as many shingles as it has, and one for each so many bytes at
# least, so that a block of repetitive texts is bounded in bytes as well.
SHINGLE_BYTES = 8

# Prefixes are tried again on the nodes that are left while they become fewer than this share.
SHRINK = 0.8

EPS = 1e-9


class Link:
    """The link rule: at least ``percent`` of 100 in common."""

    def __init__(self, percent: int = 80):
        self.percent = percent
        self.distance = 1 - percent / 100

    def holds(self, common: int, a: int, b: int) -> bool:
        return 100 * common >= self.percent * (a + b - common)

    def prefix(self, n: np.ndarray | int):
        """Length of the prefix in which a set of n meets every set it links to."""
        return n + (-self.percent * n) // 100 + 1


def _zip(x: np.ndarray) -> bytes:
    """Sorted integers: differences, byte planes apart, compressed."""
    planes = np.diff(x, prepend=x.dtype.type(0)).view(np.uint8).reshape(-1, x.itemsize).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def _unzip(data: bytes, n: int, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(pa.decompress(data, n * size, codec="zstd", asbytes=True), np.uint8).reshape(size, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(dtype).ravel(), dtype=dtype)


def _planes(x: np.ndarray) -> bytes:
    """Integers as byte planes, compressed."""
    return pa.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes(), codec="zstd", asbytes=True)


def _unplanes(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, n * 4, codec="zstd", asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view(np.int32).ravel()


def _by_bucket(high: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of sorted 32-bit values by their top bits."""
    ends = np.searchsorted(high, (np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(32 - bits)).astype(np.uint32))
    ends = np.concatenate(([0], ends, [len(high)]))
    for k in range(1 << bits):
        if ends[k] < ends[k + 1]:
            yield k, int(ends[k]), int(ends[k + 1])


def _bits(total: int) -> int:
    """Bucket bits for that many values."""
    return min(24, max(5, (max(1, total // BUCKET) - 1).bit_length()))


def digest(own: np.ndarray) -> int:
    """64 bits that name a set: independent of order, from all its elements."""
    return int(mix(mix(own ^ np.uint64(0x5DEECE66D)).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(own)))
               .view(np.int64)[0])


def profiles(rows: DataFrame) -> DataFrame:
    """Per located row: doc_id, file, row, n_shingles, node (null when empty)."""
    def run(batches):
        for b in batches:
            sets = list(shingle_sets(b.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), b.column("file"), b.column("row"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([digest(s) if len(s) else None for s in sets], pa.int64()),
            ], ["doc_id", "file", "row", "n_shingles", "node"])

    return map_batches(rows.select("doc_id", "text", "file", "row"), run,
                       f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, file string, row long, "
                       "n_shingles long, node long")


def frequency_classes(rows: DataFrame, total: int) -> np.ndarray:
    """Per cell, which is the top bits of a shingle's hash, the class of the
    number of shingles counted in it: exact to 8, then by quarter powers of 2."""
    bits = _bits(total)
    cells = max(bits, min(CELL_BITS, (2 * total).bit_length()))

    def spill(parts: list[np.ndarray]) -> pa.RecordBatch:
        high = np.sort(np.concatenate(parts))
        found = [(k, hi - lo, _zip(high[lo:hi])) for k, lo, hi in _by_bucket(high, bits)]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found), (
            pa.int32(), pa.int64(), pa.binary()))], ["bucket", "n", "data"])

    def gather(batches):
        parts, held = [], 0
        for b in batches:
            for own in shingle_sets(b.column("text").to_pylist()):
                parts.append((own >> np.uint64(32)).astype(np.uint32))
                held += len(own)
            if held >= FLUSH:
                yield spill(parts)
                parts, held = [], 0
        if held:
            yield spill(parts)

    def count(key, t):
        counts = np.zeros(1 << (cells - bits), np.int64)
        for data, n in zip(t.column("data").to_pylist(), t.column("n").to_pylist()):
            at = (_unzip(data, n, np.uint32) >> np.uint32(32 - cells)) & np.uint32(len(counts) - 1)
            counts += np.bincount(at, minlength=len(counts))
        classes = np.where(counts <= 8, counts, 8 + 4 * (np.log2(np.maximum(counts, 8)) - 3)).astype(np.uint8)
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()), "data": pa.array(
            [pa.compress(classes.tobytes(), codec="zstd", asbytes=True)], pa.binary())})

    counted = (map_batches(rows.select("text"), gather, "bucket int, n long, data binary")
               .groupBy("bucket").applyInArrow(count, "bucket int, data binary"))
    out = np.zeros(1 << cells, np.uint8)
    width = 1 << (cells - bits)
    for r in counted.toLocalIterator():
        out[r.bucket * width:(r.bucket + 1) * width] = np.frombuffer(
            pa.decompress(r.data, width, codec="zstd", asbytes=True), np.uint8)
    return out


def nodes_that_may_link(rows: DataFrame, total: int, link: Link) -> DataFrame:
    """(node), once or more each: the nodes with fewer shingles of their own
    than a prefix is long. A shingle that one text alone has is in no common
    part, so a set with more of them links to nothing. They are counted exactly
    but for hashes (cut to 64 times as many values as there are shingles), so
    this stays as sharp however many texts there are; texts that occur twice
    have no shingle of their own and stay.

    A chunk of texts (about FLUSH shingles) sends each bucket its shingles with
    their texts, one that several of its texts have without text, once; the
    bucket tells the chunk how many of each text's are found once."""
    bits = _bits(total)
    drop = np.uint64(64 - max(bits + 1, min(63, total.bit_length() + 6)))

    def spill(chunk: str, sets: list[np.ndarray], nodes: list[int], need: list[int]) -> pa.RecordBatch:
        tokens = np.concatenate(sets) >> drop
        texts = np.repeat(np.arange(1, len(sets) + 1, dtype=np.int32), [len(s) for s in sets])
        order = np.argsort(tokens, kind="stable")
        tokens, texts = tokens[order], texts[order]
        first = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
        texts = np.where(np.diff(first, append=len(tokens)) > 1, 0, texts[first]).astype(np.int32)
        tokens = tokens[first]
        high = (tokens >> (np.uint64(32) - drop) if drop < 32 else tokens << (drop - np.uint64(32))).astype(np.uint32)
        found = [(k, chunk, hi - lo, _zip(tokens[lo:hi]), _planes(texts[lo:hi])) for k, lo, hi in _by_bucket(high, bits)]
        # what the chunk has to know goes to it by way of a bucket
        found.append((-1 - hash(nodes[0]) % (1 << bits), chunk, len(nodes), np.array(nodes, np.int64).tobytes(),
                      np.array(need, np.int64).tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found), (
            pa.int32(), pa.string(), pa.int64(), pa.binary(), pa.binary()))], ["bucket", "chunk", "n", "data", "texts"])

    def gather(batches):
        sets, nodes, need, held, chunk = [], [], [], 0, ""
        for b in batches:
            files, places = b.column("file").to_pylist(), b.column("row").to_pylist()
            for own, file, row in zip(shingle_sets(b.column("text").to_pylist()), files, places):
                if not len(own):
                    continue
                if not held:
                    chunk = f"{row} {file}"
                sets.append(own)
                nodes.append(digest(own))
                need.append(link.prefix(len(own)))
                held += len(own)
                if held >= FLUSH:
                    yield spill(chunk, sets, nodes, need)
                    sets, nodes, need, held = [], [], [], 0
        if held:
            yield spill(chunk, sets, nodes, need)

    def count(key, t):
        k, chunks = key[0].as_py(), t.column("chunk")
        n, data, texts = (t.column(c).to_pylist() for c in ("n", "data", "texts"))
        if k < 0:
            return pa.table({"chunk": chunks, "n": pa.array(n, pa.int64()), "nodes": pa.array(data, pa.binary()),
                             "texts": pa.array(texts, pa.binary())})
        _, at, times = np.unique(np.concatenate([_unzip(x, m, np.uint64) for x, m in zip(data, n)]),
                                 return_inverse=True, return_counts=True)
        once, lo, out, sizes = times[at] == 1, 0, [], []
        for x, m in zip(texts, n):
            own = np.sort(_unplanes(x, m)[once[lo:lo + m]])
            lo += m
            own = own[np.searchsorted(own, 1):]  # 0 is several of the chunk
            out.append(_zip(own) if len(own) else b"")
            sizes.append(len(own))
        return pa.table({"chunk": chunks, "n": pa.array(sizes, pa.int64()),
                         "nodes": pa.array([None] * len(n), pa.binary()), "texts": pa.array(out, pa.binary())})

    def left(t):
        n, data, texts = (t.column(c).to_pylist() for c in ("n", "nodes", "texts"))
        at = next(i for i, x in enumerate(data) if x is not None)
        nodes, need = np.frombuffer(data[at], np.int64), np.frombuffer(texts[at], np.int64)
        own = np.zeros(len(nodes) + 1, np.int64)
        for i, (x, m) in enumerate(zip(texts, n)):
            if i != at and m:
                own += np.bincount(_unzip(x, m, np.int32), minlength=len(own))
        return pa.table({"node": pa.array(np.unique(nodes[own[1:] < need]), pa.int64())})

    sent = map_batches(rows.select("text", "file", "row"), gather, "bucket int, chunk string, n long, data binary, texts binary")
    back = sent.groupBy("bucket").applyInArrow(count, "chunk string, n long, nodes binary, texts binary")
    return back.groupBy("chunk").applyInArrow(left, "node long")


def prefix_edges(rows: DataFrame, total: int, classes: np.ndarray, link: Link) -> DataFrame:
    """Edges (a, b) that connect the nodes which share a prefix shingle: per
    shingle a star, first within a task, then between the tasks' centres."""
    bits = _bits(total * (100 - link.percent) // 100)
    shared = rows.sparkSession.sparkContext.broadcast(classes)
    shift = np.uint64(64 - (len(classes).bit_length() - 1))

    def stars(tokens: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First rows of each token, and edges that connect the nodes of each:
        from every node to the smallest one it is connected to."""
        order = np.lexsort((nodes, tokens))
        tokens, nodes = tokens[order], nodes[order]
        first = np.concatenate(([True], tokens[1:] != tokens[:-1]))
        centre = nodes[np.flatnonzero(first)[np.cumsum(first) - 1]]
        other = nodes != centre
        return tokens[first], nodes[first], *spanning_edges(nodes[other], centre[other])

    def spill(tokens: list[np.ndarray], nodes: list[np.ndarray]) -> pa.RecordBatch:
        tokens, nodes, a, b = stars(np.concatenate(tokens), np.concatenate(nodes))
        high = (tokens >> np.uint64(32)).astype(np.uint32)
        found = [(k, hi - lo, _zip(tokens[lo:hi]), nodes[lo:hi].tobytes()) for k, lo, hi in _by_bucket(high, bits)]
        if len(a):  # edges are done; bucket -1 - k only spreads them
            found.append((-1 - int(a[0]) % (1 << bits), len(a), a.tobytes(), b.tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found), (
            pa.int32(), pa.int64(), pa.binary(), pa.binary()))], ["bucket", "n", "tokens", "nodes"])

    def gather(batches):
        tokens, nodes, held, seen = [], [], 0, set()
        for b in batches:
            for own in shingle_sets(b.column("text").to_pylist()):
                if not len(own):
                    continue
                node = digest(own)
                if node in seen:
                    continue
                seen.add(node)
                need = link.prefix(len(own))
                order = np.lexsort((own, shared.value[own >> shift]))
                picked = own[order[:need]]
                tokens.append(picked)
                nodes.append(np.full(len(picked), node, np.int64))
                held += len(picked)
            if held >= FLUSH:
                yield spill(tokens, nodes)
                tokens, nodes, held, seen = [], [], 0, set()
        if held:
            yield spill(tokens, nodes)

    def meet(key, t):
        n, tokens, nodes = (t.column(c).to_pylist() for c in ("n", "tokens", "nodes"))
        nodes = np.concatenate([np.frombuffer(x, np.int64) for x in nodes])
        if key[0].as_py() < 0:
            a, b = np.concatenate([np.frombuffer(x, np.int64) for x in tokens]), nodes
        else:
            _, _, a, b = stars(np.concatenate([_unzip(x, k, np.uint64) for x, k in zip(tokens, n)]), nodes)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return (map_batches(rows.select("text"), gather, "bucket int, n long, tokens binary, nodes binary")
            .groupBy("bucket").applyInArrow(meet, "a long, b long"))


class Postings:
    """A growing sorted list of set numbers as an array."""
    __slots__ = ("room", "n")

    def __init__(self, first: list[int]):
        self.room = np.zeros(4 * len(first), np.int32)
        self.n = len(first)
        self.room[:self.n] = first

    def append(self, k: int) -> None:
        if self.n == len(self.room):
            self.room = np.concatenate((self.room, np.zeros(self.n, np.int32)))
        self.room[self.n] = k
        self.n += 1

    def __len__(self) -> int:
        return self.n

    def array(self) -> np.ndarray:
        return self.room[:self.n]


class Lists:
    """Inverted lists of indexed sets, searched by T-occurrence (DivideSkip).

    Few entries are merged on a heap and probed one by one. When the short
    lists are long together, as with texts made from one template, they are
    merged by counting, and all candidates are probed into a long list at once,
    or the long list counted as well where that is less work."""

    MU = 0.01       # weight of a probe against a merge step when lists are divided
    HEAP = 256      # entries that are merged on a heap
    SMALL = 32      # entries of a list before it becomes an array
    PROBE = 8       # steps of counting that a probe into a long list costs

    def __init__(self):
        self.lists: dict[int, list[int] | Postings] = {}
        self.sizes: list[int] = []
        self._sizes = np.zeros(1024, np.int64)

    def add(self, tokens: list[int]) -> int:
        k = len(self.sizes)
        self.sizes.append(len(tokens))
        if k == len(self._sizes):
            self._sizes = np.concatenate((self._sizes, np.zeros(k, np.int64)))
        self._sizes[k] = len(tokens)
        lists = self.lists
        for t in tokens:
            got = lists.get(t)
            if got is None:
                lists[t] = [k]
            else:
                got.append(k)
                if len(got) == self.SMALL and type(got) is list:
                    lists[t] = Postings(got)
        return k

    def near(self, tokens: list[int], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sets, common, size) of the sets with at least ``least`` of the tokens."""
        found = self._search(tokens, least)
        sets, common = found if found else (np.zeros(0, np.int64),) * 2
        return sets, common, self._sizes[sets]

    def search(self, tokens: list[int], least: int) -> Iterator[tuple[int, int]]:
        """The same one by one, as (set, common)."""
        sets, common, _ = self.near(tokens, least)
        return zip(sets.tolist(), common.tolist())

    def _search(self, tokens: list[int], least: int):
        get = self.lists.get
        lists = [x for x in map(get, tokens) if x is not None]
        if len(lists) < least:
            return None
        lists.sort(key=len)
        n_long = min(least - 1, int(least / (self.MU * np.log2(len(lists[-1]) + 1) + 1)))
        short, long = lists[:len(lists) - n_long], lists[len(lists) - n_long:]
        entries = sum(map(len, short))
        if entries <= self.HEAP:
            return self._heap(short, long, least, n_long)
        counts = self._counted(short)
        # no set is out by its size: a common part of least is a size of least
        sets = np.flatnonzero(counts >= least - n_long)
        if len(sets) * n_long * self.PROBE > sum(map(len, long)):
            counts += self._counted(long)
            sets = np.flatnonzero(counts >= least)
            return sets, counts[sets]
        common = counts[sets]
        for left, x in zip(range(len(long), 0, -1), long):
            may = common + left >= least
            if not may.all():
                sets, common = sets[may], common[may]
            if not len(sets):
                return None
            x = x.array() if type(x) is Postings else np.asarray(x)
            at = np.minimum(np.searchsorted(x, sets), len(x) - 1)
            common = common + (x[at] == sets)
        enough = common >= least
        return sets[enough], common[enough]

    def _counted(self, lists: list) -> np.ndarray:
        small = [k for x in lists if type(x) is list for k in x]
        parts = [x.array() for x in lists if type(x) is Postings]
        parts.append(np.array(small, np.int32))
        return np.bincount(np.concatenate(parts), minlength=len(self.sizes))

    def _heap(self, short: list, long: list, least: int, n_long: int):
        sets, counts = [], []
        plain = [x if type(x) is list else x.array().tolist() for x in short]
        for k, run in groupby(heapq.merge(*plain)):
            common = sum(1 for _ in run)
            if common < least - n_long:
                continue
            for left, x in zip(range(len(long), 0, -1), long):
                if common + left < least:
                    break
                if type(x) is list:
                    at = bisect_left(x, k)
                    common += at < len(x) and x[at] == k
                else:
                    at = int(np.searchsorted(x.array(), k))
                    common += at < x.n and int(x.room[at]) == k
            if common >= least:
                sets.append(k)
                counts.append(common)
        return (np.array(sets, np.int64), np.array(counts, np.int64)) if sets else None


class Forest:
    """Disjoint sets over 0..n-1."""

    def __init__(self):
        self.up: list[int] = []

    def add(self) -> int:
        self.up.append(len(self.up))
        return len(self.up) - 1

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)


def cluster(sets: list[np.ndarray], link: Link) -> tuple[list[int], list[int], list[float]]:
    """Per set its component (smallest index), its leader and its distance to
    the leader, by the leader search of the module's head."""
    index, forest = Lists(), Forest()
    leaders: list[int] = []                       # set of each indexed leader
    members: list[list[tuple[float, int]]] = []   # (distance, set) per leader
    radius = np.full(1024, -1.0)                  # distance of its farthest member, -1 without members
    leader, away = [], []
    reach = 2 * link.distance
    for i, own in enumerate(sets):
        forest.add()
        n = len(own)
        least = max(1, int(np.ceil((1 - reach) * n - 1e-6)))
        near, common, size = index.near(own.tolist(), least)
        d = 1 - common / (n + size - common)
        close = d <= reach + EPS
        near, common, size, d = near[close], common[close], size[close], d[close]
        for k in near[100 * common >= link.percent * (n + size - common)].tolist():
            forest.join(i, leaders[k])
        order = np.lexsort((near, d))
        near, d = near[order], d[order]
        # only members far enough from their leader can link
        for k in np.flatnonzero(radius[near] >= d - link.distance - EPS).tolist():
            far, k = d[k], int(near[k])
            if forest.root(i) == forest.root(leaders[k]):
                continue
            for e, j in members[k]:
                if e >= far - link.distance - EPS and forest.root(i) != forest.root(j):
                    both = len(np.intersect1d(own, sets[j], assume_unique=True))
                    if link.holds(both, n, len(sets[j])):
                        forest.join(i, j)
                        if forest.root(i) == forest.root(leaders[k]):
                            break
        if len(near) and d[0] <= link.distance + EPS and forest.root(i) == forest.root(leaders[near[0]]):
            far, k = float(d[0]), int(near[0])
            members[k].append((far, i))
            radius[k] = max(radius[k], far)
            leader.append(leaders[k])
            away.append(far)
        else:
            index.add(own.tolist())
            if len(leaders) == len(radius):
                radius = np.concatenate((radius, np.full(len(radius), -1.0)))
            leaders.append(i)
            members.append([])
            leader.append(i)
            away.append(0.0)
    return [forest.root(i) for i in range(len(sets))], leader, away


def _placed(cand: DataFrame) -> DataFrame:
    """Adds block and split to (node, label, weight, ...): small groups share
    blocks, a group that weighs more than BLOCK is spread over blocks of its
    own (split)."""
    weights = kept_table(cand.groupBy("label").agg(F.sum("weight").alias("whole")), "jaccard-weights")
    small = weights.where(F.col("whole") <= BLOCK).agg(F.sum("whole")).first()[0] or 0
    bins = max(1, -(-2 * small // BLOCK))
    parts = F.ceil(F.col("whole") / BLOCK)
    return cand.join(weights, "label").select(
        cand["*"], (parts > 1).alias("split"),
        F.when(parts > 1, F.xxhash64("label", F.pmod(F.xxhash64("node"), parts)))
        .otherwise(F.pmod(F.xxhash64("label"), F.lit(bins))).alias("block"))


def search_blocks(blocks: DataFrame, n_blocks: int, link: Link) -> DataFrame:
    """(block, label, split, node, text) -> label, block, node, comp, leader,
    away, and for the leaders of split groups their shingles."""
    def search(key, t):
        t = t.sort_by("node")
        nodes, split = t.column("node").to_pylist(), t.column("split").to_pylist()
        sets = list(shingle_sets(t.column("text").to_pylist()))
        comp, leader, away = cluster(sets, link)
        return pa.table({
            "label": t.column("label"), "block": t.column("block"), "node": t.column("node"),
            "comp": pa.array([nodes[c] for c in comp], pa.int64()),
            "leader": pa.array([nodes[x] for x in leader], pa.int64()),
            "away": pa.array(away, pa.float64()),
            "tokens": pa.array([s.tobytes() if x == i and many else None for i, (s, x, many) in
                                enumerate(zip(sets, leader, split))], pa.binary())})

    # a search takes far longer than its bytes suggest: one task per block,
    # not as many blocks as make up a task's usual size
    spread = max(n_blocks, int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return blocks.repartition(spread, "block").groupBy("block").applyInArrow(
        search, "label long, block long, node long, comp long, leader long, away double, tokens binary")


def leaders_that_meet(local: DataFrame, link: Link) -> DataFrame:
    """Pairs (a, b, linked, from_a, from_b) of leaders of one group from
    different blocks that link, or whose members may (not linked): closer than
    the link distance and both radii. Only members at least from_a (from_b)
    away from their leader can link across. Compared in pairs of chunks of at
    most about BLOCK shingles."""
    radius = local.groupBy("leader").agg(F.max("away").alias("radius"))
    lead = local.where("tokens is not null").drop("leader", "away", "comp").join(
        radius.withColumnRenamed("leader", "node"), "node")
    chunks = lead.groupBy("label").agg(F.ceil(F.sum(F.octet_length("tokens")) / (8 * BLOCK)).cast("int").alias("parts"))
    lead = lead.join(chunks, "label").withColumn("own", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    pairs = lead.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "label", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        "node", "block", "radius", "tokens")

    def meet(key, t):
        nodes, blocks, radii = (t.column(c).to_pylist() for c in ("node", "block", "radius"))
        sets = [np.frombuffer(x, np.uint64).tolist() for x in t.column("tokens").to_pylist()]
        index, widest = Lists(), max(radii)
        out: list[tuple[int, int, bool, float, float]] = []
        for i, own in enumerate(sets):
            reach = link.distance + radii[i] + widest
            least = max(1, int(np.ceil((1 - reach) * len(own) - 1e-6)))
            for k, common in index.search(own, least):
                if blocks[k] == blocks[i]:
                    continue
                d = 1 - common / (len(own) + len(sets[k]) - common)
                if d <= link.distance + radii[i] + radii[k] + EPS:
                    a, b = (i, k) if nodes[i] < nodes[k] else (k, i)
                    out.append((nodes[a], nodes[b], link.holds(common, len(own), len(sets[k])),
                                d - link.distance - radii[b] - EPS, d - link.distance - radii[a] - EPS))
            index.add(own)
        return pa.table({"a": pa.array([x[0] for x in out], pa.int64()), "b": pa.array([x[1] for x in out], pa.int64()),
                         "linked": pa.array([x[2] for x in out], pa.bool_()),
                         "from_a": pa.array([x[3] for x in out], pa.float64()),
                         "from_b": pa.array([x[4] for x in out], pa.float64())})

    found = pairs.groupBy("label", "i", "j").applyInArrow(
        meet, "a long, b long, linked boolean, from_a double, from_b double")
    return found.groupBy("a", "b").agg(F.max("linked").alias("linked"), F.min("from_a").alias("from_a"),
                                       F.min("from_b").alias("from_b"))


def members_that_link(pairs: DataFrame, local: DataFrame, texts: DataFrame, link: Link) -> DataFrame:
    """One edge (a, b) per pair of leaders (a, b) whose members link."""
    sides = [pairs.select("a", "b", F.col(side).alias("leader"), F.lit(side == "a").alias("first"),
                          F.col(f"from_{side}").alias("least")) for side in ("a", "b")]
    members = sides[0].union(sides[1]).join(local.select("leader", "node", "away"), "leader").where("away >= least")
    found = members.join(
        texts.select("node", "text"), "node").select("a", "b", "first", "node", "text")

    def meet(key, t):
        first, nodes = t.column("first").to_pylist(), t.column("node").to_pylist()
        sets = [s.tolist() for s in shingle_sets(t.column("text").to_pylist())]
        index, at = Lists(), []
        for i, own in enumerate(sets):
            if first[i]:
                index.add(own)
                at.append(i)
        for i, own in enumerate(sets):
            if not first[i]:
                for k, common in index.search(own, max(1, -(-link.percent * len(own) // 100))):
                    if link.holds(common, len(own), len(sets[at[k]])):
                        return pa.table({"a": pa.array([nodes[i]], pa.int64()),
                                         "b": pa.array([nodes[at[k]]], pa.int64())})
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})

    return found.groupBy("a", "b").applyInArrow(meet, "a long, b long")


def linked_nodes(rows: DataFrame, prof: DataFrame, link: Link) -> DataFrame:
    """(node, label): the component of every node that may link at all."""
    spark = rows.sparkSession
    one = (prof.where("node is not null").groupBy("node")
           .agg(F.min(F.struct("file", "row")).alias("at"), F.max("n_shingles").alias("n")))
    total = prof.agg(F.sum("n_shingles")).first()[0] or 0
    may = result_kept(spark, "jaccard-may-link", lambda: nodes_that_may_link(rows, total, link).distinct())
    cand = may.join(one, "node").select("node", "n", "at.file", "at.row")
    weight = F.greatest("n", F.ceil(F.octet_length("text") / SHINGLE_BYTES)).alias("weight")
    texts = rows.select("file", "row", "text").join(cand, ["file", "row"]).select("node", "n", weight, "text")
    path, before = None, None
    while True:
        # one set of texts is kept at a time
        last, path = path, scratch_path(spark, "jaccard-texts")
        texts = kept_table(texts, "jaccard-texts", path)
        if last:
            remove_scratch(spark, last)
        count, total = texts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        if before is not None and (not count or count > SHRINK * before):
            break
        # nodes that link are all among these, so frequencies are counted
        # over them alone: a sharper order, smaller groups
        groups = result_kept(spark, "jaccard-groups", lambda: components(
            kept_table(prefix_edges(texts, total, frequency_classes(texts, total), link), "jaccard-prefixes")))
        before, texts = count, texts.join(groups.select("node"), "node")
    cand = kept_table(_placed(texts.select("node", "weight").join(groups, "node")), "jaccard-blocks")
    texts = texts.drop("n", "weight").join(cand, "node")
    n_blocks = cand.select("block").distinct().count()
    local = kept_table(search_blocks(texts.select("block", "label", "split", "node", "text"), n_blocks, link),
                       "jaccard-local")
    found = local.select("node", F.col("comp").alias("label"))
    if cand.where("split").isEmpty():
        return found
    split = local.join(cand.where("split").select("node"), "node", "left_semi")
    pairs = kept_table(leaders_that_meet(split, link), "jaccard-leaders")
    edges = local.select(F.col("node").alias("a"), F.col("comp").alias("b")).union(
        pairs.where("linked").select("a", "b"))
    found = components(edges.where("a <> b"))
    open_pairs = kept_table(
        pairs.where("not linked")
        .join(found.select(F.col("node").alias("a"), F.col("label").alias("of_a")), "a", "left")
        .join(found.select(F.col("node").alias("b"), F.col("label").alias("of_b")), "b", "left")
        .where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b", "from_a", "from_b"),
        "jaccard-open")
    if open_pairs.isEmpty():
        return found
    more = kept_table(members_that_link(open_pairs, local, texts, link), "jaccard-members")
    return components(edges.where("a <> b").union(more))


def jaccard_components(docs: DataFrame, percent: int = 80) -> DataFrame:
    r"""Per document: doc_id, n_shingles, component_id.

    Words are runs of other characters than ``[\x20\x09-\x0D]``, A-Z lower-cased;
    a document's set holds its distinct five-word shingles, or its whole
    sequence when it has fewer words. Documents link when their sets have
    ``percent`` of 100 of their union in common; component_id is the smallest
    doc_id that is reachable by links. A null or wordless text has no shingles
    and is alone (component_id is its own id). Repeated rows and equal sets are
    in one component; null ids are never a component's smallest id unless all
    are null. Empty tables give empty results, other columns are ignored.
    Shingles are compared by 64-bit hashes, and equal sets are recognised by 64
    bits of their own.
    """
    rows = located(docs.select("doc_id", "text"))
    bound_batches(docs.sparkSession)
    prof = kept_table(profiles(rows), "jaccard-profiles")
    return classes(prof, linked_nodes(rows, prof, Link(percent))).select("doc_id", "n_shingles", "component_id")


def classes(prof: DataFrame, found: DataFrame) -> DataFrame:
    """The profiles with component_id."""
    named = (prof.where("node is not null").join(found, "node", "left")
             .withColumn("label", F.coalesce("label", "node")))
    # written, so that the join can split a hot label
    smallest = kept_table(named.groupBy("label").agg(F.min("doc_id").alias("component_id")), "jaccard-smallest")
    cols = ["doc_id", "file", "row", "n_shingles", "component_id"]
    return named.join(smallest, "label").select(cols).union(
        prof.where("node is null").withColumn("component_id", F.col("doc_id")).select(cols))


def one_per_component(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without those that are near copies of a kept one:
    of each component the row with the smallest doc_id stays (null last, then
    the first by locator)."""
    rows = located(docs, "near_file", "near_row")
    plain = rows.select("doc_id", "text", F.col("near_file").alias("file"), F.col("near_row").alias("row"))
    bound_batches(docs.sparkSession)
    prof = kept_table(profiles(plain), "jaccard-profiles")
    named = (prof.where("node is not null").join(linked_nodes(plain, prof, Link(percent)), "node", "left")
             .withColumn("label", F.coalesce("label", "node")))
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "file", "row")).alias("first")
    first = kept_table(named.groupBy("label").agg(best), "jaccard-first")
    dropped = (named.join(first, "label")
               .where((F.col("file") != F.col("first.file")) | (F.col("row") != F.col("first.row")))
               .select(F.col("file").alias("near_file"), F.col("row").alias("near_row")))
    return rows.join(dropped, ["near_file", "near_row"], "left_anti").select(docs.columns)
