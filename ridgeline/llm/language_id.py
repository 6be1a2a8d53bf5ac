"""Operator 10: language identification by nearest centroids.

A text is the normalised vector of TF-IDF weights of its hashed byte n-grams
(1 to 4 letters, words padded by blanks). Each language has several centroids
from spherical k-means, fitted on a bounded sample of learnable rows; document
frequencies for the IDF come from all learnable rows. A text gets the language
of the centroid with the largest cosine, and counts as rejected when that is
farther than nearly all learned texts of the language are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import held_out, kept_table, map_batches

DIMS = 4096
ORDERS = (1, 2, 3, 4)
CENTROIDS = 4
# Centroids are fitted on about this many learnable rows per language at most.
MAX_PER_LANG = 2000
# A text is rejected below this quantile of its language's learned cosines.
REJECT_QUANTILE = 0.005
# Bytes that are vectorised at once.
SEGMENT = 1 << 19

_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32                                     # letter case of A-Z
for _b in (*range(0, 65), *range(91, 97), *range(123, 128)):
    _FOLD[_b] = 32                                     # whatever is no letter separates


def _counts(texts: list[bytes], out: np.ndarray) -> None:
    """Adds the n-gram counts of each text to its row of ``out``."""
    part, rows, size = [], [], 0

    def flush() -> None:
        buf = _FOLD[np.frombuffer(b"".join(part), np.uint8)]
        row = np.repeat(np.arange(len(part)), [len(p) for p in part])
        own = np.zeros((len(part), DIMS), np.int64)
        code = np.zeros(len(buf), np.uint32)
        for n in range(1, max(ORDERS) + 1):
            code = code[:len(buf) - n + 1] * np.uint32(257) + buf[n - 1:] if n > 1 else buf
            if len(code) <= 0:
                break
            same = row[:len(code)] == row[n - 1:]
            # runs of blanks say nothing about a language
            letters = (buf[:len(code)] != 32) | (buf[n - 1:] != 32)
            use = same & letters
            mixed = (code[use] * np.uint32(0x9E3779B1) + np.uint32(n * 0x85EBCA6B % (1 << 32))) >> np.uint32(20)
            own += np.bincount(row[:len(code)][use] * DIMS + mixed % DIMS,
                               minlength=len(part) * DIMS).reshape(len(part), DIMS)
        np.add.at(out, rows, own)

    for i, t in enumerate(texts):
        # long texts are counted in segments, so scratch memory is bounded
        for lo in range(0, max(1, len(t)), SEGMENT):
            piece = b" " + t[lo:lo + SEGMENT] + b" "
            part.append(piece)
            rows.append(i)
            size += len(piece)
            if size >= SEGMENT or len(part) >= 64:
                flush()
                part, rows, size = [], [], 0
    if part:
        flush()


def term_counts(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Blocks of rows of n-gram counts, 64 texts at a time."""
    for lo in range(0, len(texts), 64):
        some = texts[lo:lo + 64]
        out = np.zeros((len(some), DIMS), np.int64)
        _counts([(t or "").encode() for t in some], out)
        yield out


@dataclass
class Model:
    idf: np.ndarray
    centroids: np.ndarray        # one row per centroid
    langs: list[str]             # language of each centroid
    floor: dict[str, float]      # cosine below which a text is rejected

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts) * self.idf
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def nearest(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cos = self.vectors(counts) @ self.centroids.T
        best = cos.argmax(1)
        return best, np.clip(cos[np.arange(len(best)), best], 0, 1)


def spherical_kmeans(x: np.ndarray, k: int, seed: int = 3, rounds: int = 15) -> np.ndarray:
    """Unit centroids of unit rows; empty clusters take the row that fits worst."""
    rng = np.random.default_rng(seed)
    k = min(k, len(x))
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        cos = x @ c.T
        own = cos.argmax(1)
        c = np.stack([x[own == j].sum(0) if (own == j).any() else x[cos.max(1).argmin()] for j in range(k)])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def fit(docs: DataFrame, max_per_lang: int = MAX_PER_LANG, centroids: int = CENTROIDS) -> Model | None:
    """Learns from text and non-null lang of rows that are not held out; None
    when there is no such row. Ties of lang order are broken by name."""
    learn = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()) \
        .select("doc_id", "text", "lang")

    def frequencies(batches):
        total = np.zeros(DIMS + 1, np.int64)
        for b in batches:
            for counts in term_counts(b.column("text").to_pylist()):
                total[:DIMS] += (counts > 0).sum(0)
                total[DIMS] += len(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIMS + 1), pa.int32()), pa.array(total, pa.int64())],
                                         ["dim", "n"])

    sums = {r[0]: r[1] for r in map_batches(learn.select("text"), frequencies, "dim int, n long")
            .groupBy("dim").agg(F.sum("n")).collect()}
    n = sums.get(DIMS, 0)
    if not n:
        return None
    idf = np.log((1 + n) / (1 + np.array([sums.get(i, 0) for i in range(DIMS)]))) + 1

    # a bounded sample per language, vectorised where the rows are
    sizes = {r[0]: r[1] for r in learn.groupBy("lang").count().collect()}
    share = F.lit(1.0)
    for lang, size in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, max_per_lang / size))).otherwise(share)
    # by id and text, repeated rows once: no repeated id or row escapes the bound
    sample = (learn.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < share * 1_000_000)
              .dropDuplicates(["lang", "doc_id", "text"]))

    def vectors(batches):
        model = Model(idf, np.empty((0, DIMS)), [], {})
        for b in batches:
            rows = [r for counts in term_counts(b.column("text").to_pylist())
                    for r in model.vectors(counts).astype(np.float32)]
            yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("doc_id"),
                                              pa.array([r.tobytes() for r in rows], pa.binary())],
                                             ["lang", "doc_id", "vector"])

    def clusters(key, t):
        t = t.sort_by([("doc_id", "ascending"), ("vector", "ascending")])
        x = np.stack([np.frombuffer(v, np.float32) for v in t.column("vector").to_pylist()])
        c = spherical_kmeans(x, centroids)
        floor = float(np.quantile((x @ c.T).max(1), REJECT_QUANTILE))
        return pa.table({"lang": pa.array([key[0].as_py()] * len(c), pa.string()),
                         "centroid": pa.array([v.astype(np.float32).tobytes() for v in c], pa.binary()),
                         "floor": pa.array([floor] * len(c), pa.float64())})

    id_type = docs.schema["doc_id"].dataType.simpleString()
    found = (map_batches(sample, vectors, f"lang string, doc_id {id_type}, vector binary")
             .groupBy("lang").applyInArrow(clusters, "lang string, centroid binary, floor double")
             .orderBy("lang").collect())
    return Model(idf, np.stack([np.frombuffer(r["centroid"], np.float32) for r in found]),
                 [r["lang"] for r in found], {r["lang"]: r["floor"] for r in found})


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected."""
    langs = model.langs if model else []
    flags = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))

    def run(batches):
        for b in batches:
            named = b.column("letter").to_pylist()
            lang, score, rejected = [], [], []
            for lo, counts in zip(range(0, b.num_rows, 64), term_counts(b.column("text").to_pylist())):
                if not langs:
                    lang += ["und"] * len(counts)
                    score += [0.0] * len(counts)
                    rejected += [True] * len(counts)
                    continue
                best, cos = model.nearest(counts)
                for letter, j, c in zip(named[lo:lo + 64], best.tolist(), cos.tolist()):
                    lang.append(langs[j] if letter else "und")
                    score.append(round(c, 6) if letter else 0.0)
                    rejected.append(not letter or c < model.floor[langs[j]])
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), b.column("held_out"), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                pa.array(rejected, pa.bool_())], ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    return map_batches(
        docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"), flags.alias("letter")), run,
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, lang_pred string, score double, "
        "rejected boolean")


def identify_languages(docs: DataFrame, max_per_lang: int = MAX_PER_LANG) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score (cosine, 0 to 1) and
    rejected (too far from every learned text; the nearest language is named
    all the same).

    lang_pred is ``und`` with score 0 for a null text, a text without a letter
    and when nothing can be learned. Rows without an id are held out; repeated
    rows get equal results; a language with one learnable text has one
    centroid; other columns are ignored; empty tables give empty results. Texts
    are counted whole, in segments of 512 KB with a blank at each end, so at a
    border the few n-grams that would cross it are lost.
    """
    return predict(docs, fit(docs, max_per_lang))
