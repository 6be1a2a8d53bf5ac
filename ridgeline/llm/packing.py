"""Operator 5: best-fit packing by sums of squares.

A document becomes its token ids and an end id. Only a document longer than a
sequence is cut, into full pieces after a shorter first one. Pieces are dealt
at random into groups of about ``GROUP_PIECES``; within a group, longest
first, a piece goes where the sum over residual gaps of (open bins with that
gap) squared becomes smallest. Groups are independent, so any number of
executors pack at once; a group of this size loses well under one percent
against the sum of lengths, and more machines never mean a larger group.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.llm.common import bound_batches, map_batches
from ridgeline.session import scratch_path

MODEL = "byte_bpe_50k.json"
GROUP_PIECES = 20_000
REPAIRS = 6
# Fixed value: the word pattern of the model's pre-tokenizer.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# A run of so many blanks goes to the tokenizers library: tiktoken's pattern
# takes a stack entry per blank, and its stack ends at a million.
LONG_BLANKS = 100_000


def has_long_blanks(text: str) -> bool:
    """Whether the text has a run of at least LONG_BLANKS white-space
    characters; such a run holds one of the places looked at first."""
    return (any(c.isspace() for c in text[LONG_BLANKS - 1::LONG_BLANKS])
            and any(len(m[0]) >= LONG_BLANKS for m in re.finditer(r"\s+", text)))


class ByteEncoder:
    """Ids of whole texts as the tokenizers library gives them for a
    byte-level BPE file. The ranks are read from that file and applied by
    tiktoken, which needs a sixth of the time; that both agree is tested.
    Texts with a very long run of blanks are encoded by the library itself."""

    def __init__(self, path: str):
        import tiktoken
        self.path, self.library = path, None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        if any(vocab["".join(m if isinstance(m, list) else m.split(" "))] != 256 + i for i, m in enumerate(merges)):
            raise ValueError("the ids of this file are not in the order of its merges")
        # the file writes printable bytes as themselves, the others from U+0100 on
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        other = [b for b in range(256) if b not in plain]
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in special}
        self.special = list(special)
        self.encoding = tiktoken.Encoding("from-file", pat_str=WORDS, mergeable_ranks=ranks, special_tokens=special)

    def ids(self, text: str) -> bytes:
        """Little-endian uint32; special strings in the text are their ids."""
        if has_long_blanks(text):
            if self.library is None:
                from tokenizers import Tokenizer
                self.library = Tokenizer.from_file(self.path)
            found = self.library.encode(text, add_special_tokens=False).ids
        elif any(s in text for s in self.special):
            found = self.encoding.encode(text, allowed_special="all")
        else:
            found = self.encoding.encode_ordinary(text)
        return np.array(found, "<u4").tobytes()


@lru_cache(maxsize=2)
def load(path: str | None) -> ByteEncoder:
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(MODEL)
    return ByteEncoder(path)


def cut(total: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: full ones after a first
    one that may be shorter."""
    first = total % limit or min(limit, total)
    return [(0, first)] + [(s, limit) for s in range(first, total, limit)]


def pieces(docs: DataFrame, limit: int = 1024, end_id: int = 2, model_path: str | None = None,
           keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids).
    A null text is empty: its document is the end id alone."""
    stop = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(model_path)
        for b in batches:
            for lo in range(0, b.num_rows, 200):
                part = b.slice(lo, 200)
                row, number, start, length, crc, ids = [], [], [], [], [], []
                for i, text in enumerate(part.column("text").to_pylist()):
                    coded = encoder.ids(text or "") + stop
                    for k, (s, n) in enumerate(cut(len(coded) // 4, limit)):
                        row.append(i)
                        number.append(k)
                        start.append(s)
                        length.append(n)
                        own = coded[4 * s:4 * (s + n)]
                        crc.append(zlib.crc32(own))
                        if keep_ids:
                            ids.append(np.frombuffer(own, "<i4"))
                cols = [part.column("doc_id").take(pa.array(row, pa.int64())), pa.array(number, pa.int32()),
                        *(pa.array(x, pa.int64()) for x in (start, length, crc))]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    cols.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    return map_batches(docs.select("doc_id", "text"), run, _schema(docs, keep_ids))


def _schema(docs: DataFrame, keep_ids: bool) -> str:
    return (f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, "
            "ids_crc32 long" + (", ids array<int>" if keep_ids else ""))


def fill(sizes: np.ndarray, limit: int, gaps: np.ndarray) -> tuple[np.ndarray, int]:
    """Bins for sizes in the order given, by the sum-of-squares rule, and the
    number of bins; ``gaps`` are those of the bins there are. With N(g) open
    bins of gap g, a piece of size s changes the sum by 2 N(limit - s) + 1 in a
    new bin and by 2 (N(g - s) - N(g) + 1) in a bin of gap g > s (1 - 2 N(g)
    when it fills the bin); ties go to the smallest gap."""
    n_open = np.zeros(limit + 1, np.int64)
    by_gap: list[list[int]] = [[] for _ in range(limit + 1)]
    for at, gap in enumerate(gaps.tolist()):
        if gap:
            by_gap[gap].append(at)
            n_open[gap] += 1
    bins, used, never = np.empty(len(sizes), np.int64), len(gaps), 1 << 40
    for i, s in enumerate(sizes.tolist()):
        change = 1 - 2 * n_open[s:limit]
        change[1:] += 2 * n_open[1:limit - s] + 1
        change[n_open[s:limit] == 0] = never
        k = int(change.argmin()) if len(change) else 0
        if len(change) and change[k] <= 2 * n_open[limit - s] + 1:
            gap = s + k
            at = by_gap[gap].pop()
            n_open[gap] -= 1
        else:
            gap, at = limit, used
            used += 1
        bins[i] = at
        if gap > s:
            by_gap[gap - s].append(at)
            n_open[gap - s] += 1
    return bins, used


def best_fit(sizes: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) for sizes, longest first. After the first pass the
    emptiest tenth of the bins is dissolved and placed again by the same rule
    among the others, a few times; a round that needs more bins is undone."""
    bins, used = fill(sizes, limit, np.empty(0, np.int64))
    for _ in range(REPAIRS if len(sizes) else 0):
        gaps = limit - np.bincount(bins, weights=sizes, minlength=used).astype(np.int64)
        keep = np.sort(np.argsort(-gaps, kind="stable")[max(2, used // 10):])
        place = np.full(used, -1)
        place[keep] = np.arange(len(keep))
        again = place[bins] < 0
        moved, total = fill(sizes[again], limit, gaps[keep])
        if total <= used:
            bins, used = place[bins], total
            bins[again] = moved
    order = np.argsort(bins, kind="stable")
    ends = np.cumsum(sizes[order])
    starts = ends - sizes[order]
    first = np.concatenate(([True], np.diff(bins[order]) > 0))[:len(order)]
    offsets = np.empty(len(sizes), np.int64)
    offsets[order] = starts - starts[first][np.cumsum(first) - 1]
    return bins, offsets


def pack(docs: DataFrame, limit: int = 1024, end_id: int = 2, model_path: str | None = None,
         keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset (and ids). Every row of ``docs`` is packed, repeated
    rows and rows with null ids included; a null text is empty; an empty table
    gives an empty result; other columns are ignored."""
    spark: SparkSession = docs.sparkSession
    bound_batches(spark)
    path = scratch_path(spark, "pieces")
    pieces(docs, limit, end_id, model_path, keep_ids).write.parquet(path)
    cut_pieces = spark.read.schema(_schema(docs, keep_ids)).parquet(path)
    groups = max(1, -(-cut_pieces.count() // GROUP_PIECES))
    dealt = cut_pieces.select(
        "*", F.pmod(F.xxhash64(F.col("_metadata.file_name"), F.col("_metadata.row_index")), F.lit(groups)).alias("grp"))

    def run(key, t):
        t = t.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"),
                       ("ids_crc32", "ascending")])
        bins, offsets = best_fit(t.column("length").to_numpy(), limit)
        return (t.drop_columns(["grp"])
                .append_column("sequence_id", pa.array(bins + (key[0].as_py() << 32), pa.int64()))
                .append_column("offset", pa.array(offsets, pa.int64())))

    schema = _schema(docs, False) + ", " * keep_ids + "ids array<int>" * keep_ids + ", sequence_id long, offset long"
    return dealt.groupBy("grp").applyInArrow(run, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves (``pack(keep_ids=True)``): sequence_id, ids.
    A sequence holds at most ``limit`` ids, so its group is bounded."""
    return packed.groupBy("sequence_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"]))
        .alias("ids"))
