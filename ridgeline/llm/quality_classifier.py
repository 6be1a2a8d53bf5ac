"""Operator 1: quality classifier on random Fourier features.

Statistics of a whole text -> standardised -> D random Fourier features, whose
inner products approximate a Gaussian kernel -> ridge regression from normal
equations that partitions sum up and Spark adds -> isotonic calibration on a
fold of its own. The driver sees sums of fixed size only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import held_out, kept_table, map_batches
from ridgeline.llm.shingles import SEGMENT, word_hashes

# The ridge is fitted on at most about this many labelled rows (a hash of the
# id decides); scoring covers every row.
MAX_TRAIN = 200_000
FEATURES = 256
RIDGE = 1.0
THRESHOLD = 0.3
# Calibration sees the raw scores in this many equal bins between these bounds.
BINS, LOW, HIGH = 4000, -1.0, 2.0

_CLASSES = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "symbol": map(ord, "#*$%&|<>{}[]\\^~=_"),
    "shout": map(ord, "!?"), "stop": map(ord, ".,;:"), "line": (10,), "wide": range(128, 256),
}
_TABLES = []
for _members in _CLASSES.values():
    _t = np.zeros(256, np.int32)
    _t[list(_members)] = 1
    _TABLES.append(_t)
N_STATS = len(_CLASSES) + 7


def statistics(texts: list[str | None]) -> Iterator[np.ndarray]:
    """N_STATS numbers per text (all zero for a text without words)."""
    part, size = [], 0
    for t in texts:
        part.append((t or "").encode())
        size += len(part[-1]) + 1
        if size >= SEGMENT:
            yield from _statistics(part)
            part, size = [], 0
    if part:
        yield from _statistics(part)


def _statistics(texts: list[bytes]) -> Iterator[np.ndarray]:
    data = b" ".join(texts) + b" "
    buf = np.frombuffer(data, np.uint8)
    starts, words = word_hashes(data)
    ends = np.cumsum([len(t) + 1 for t in texts])
    begins = np.concatenate(([0], ends[:-1]))
    counts = [np.add.reduceat(t[buf], begins) for t in _TABLES]
    blanks = np.add.reduceat((buf == 32) | (buf == 10), begins, dtype=np.int64) - 1
    bounds = np.concatenate(([0], np.searchsorted(starts, ends))).tolist()
    for k, t in enumerate(texts):
        own = words[bounds[k]:bounds[k + 1]]
        n = len(own)
        if not n:
            yield np.zeros(N_STATS)
            continue
        _, often = np.unique(own, return_counts=True)
        size = len(t)
        letters = size - int(blanks[k])
        yield np.array([
            *(np.log1p(c[k] / n) if name in ("symbol", "shout", "stop", "digit", "line") else c[k] / max(1, letters)
              for name, c in zip(_CLASSES, counts)),
            np.log1p(n), np.log1p(letters / n), len(often) / n, len(often) / np.sqrt(n), often.max() / n,
            (own[1:] == own[:-1]).mean() if n > 1 else 0.0, np.log1p(n / (counts[6][k] + 1)),
        ])


@dataclass
class Model:
    """Everything the scoring of a batch needs (a few hundred KB)."""
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray          # statistics x features
    phase: np.ndarray
    ridge: np.ndarray            # features + 1
    knots: tuple[np.ndarray, np.ndarray]   # raw score, calibrated

    @staticmethod
    def start(mean: np.ndarray, scale: np.ndarray, features: int = FEATURES, seed: int = 7) -> Model:
        rng = np.random.default_rng(seed)
        width = np.sqrt(N_STATS)   # of the kernel, for standardised statistics
        return Model(mean, scale, rng.normal(0, 1 / width, (N_STATS, features)), rng.uniform(0, 2 * np.pi, features),
                     np.zeros(features + 1), (np.array([0.0]), np.array([0.5])))

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -6, 6)
        z = np.cos(x @ self.weights + self.phase) * np.sqrt(2 / len(self.phase))
        return np.hstack([z, np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.ridge

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.round(np.interp(self.raw(stats), *self.knots), 6)


def isotonic(x: np.ndarray, weight: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over points x (ascending) with ``weight`` cases
    and label sums ``total``: knots (mean x of a block, mean label), between
    which scores are interpolated, so they rise and have few ties."""
    blocks: list[list[float]] = []  # cases, labels, sum of x
    for xi, w, t in zip(x.tolist(), weight.tolist(), total.tolist()):
        blocks.append([w, t, xi * w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            w2, t2, s2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + w2, blocks[-1][1] + t2, blocks[-1][2] + s2]
    return np.array([s / w for w, _, s in blocks]), np.array([t / w for w, t, _ in blocks])


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False)).reshape(-1, N_STATS)


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, fold, stats per document."""
    def run(batches):
        for b in batches:
            flat = np.concatenate([*statistics(b.column("text").to_pylist()), np.empty(0)])
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), b.column("held_out"), b.column("fold"),
                pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1) * N_STATS, pa.int32()), pa.array(flat)),
            ], ["doc_id", "held_out", "fold", "stats"])

    return map_batches(
        docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"),
                    F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5, F.lit(0)).cast("int").alias("fold")),
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, fold int, stats array<double>")


def _sums(train: DataFrame, fn) -> dict[int, float]:
    """Adds up what ``fn(stats, labels)`` returns per partition: arrays
    (cell, value), one row per cell; the cells are a fixed number."""
    def run(batches):
        total: dict | np.ndarray | None = None
        for b in batches:
            cells, values = fn(_matrix(b.column("stats")), b.column("label").to_numpy(zero_copy_only=False))
            total = values if total is None else total + values
        if total is not None:
            found = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(cells[found], pa.int32()), pa.array(total[found])],
                                             ["cell", "value"])

    out = map_batches(train.select("stats", "label"), run, "cell int, value double") \
        .groupBy("cell").agg(F.sum("value").alias("value"))
    return {r[0]: r[1] for r in out.collect()}


def _dense(sums: dict[int, float], n: int) -> np.ndarray:
    out = np.zeros(n)
    out[list(sums)] = list(sums.values())
    return out


def fit(stats: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, features: int = FEATURES) -> Model:
    """Fits on rows that are not held out and have a label: folds 1 to 3 for
    the ridge, fold 4 for the calibration. Conflicting labels of an id are
    averaged. Without any label every score is 0.5."""
    given = labels.where("doc_id is not null and quality is not null")
    share = min(1.0, max_train / max(1, given.count()))
    given = (given.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
             .groupBy("doc_id").agg(F.avg("quality").cast("double").alias("label")))
    train = kept_table(stats.where("not held_out").join(given, "doc_id").select("fold", "stats", "label"),
                       "quality-train")
    fitting, calibrating = train.where("fold <> 4"), train.where("fold = 4")

    def moments(x, y):
        return np.arange(2 * N_STATS + 2), np.concatenate([[len(x), y.sum()], x.sum(0), (x * x).sum(0)])

    m = _dense(_sums(fitting, moments), 2 * N_STATS + 2)
    n = max(1.0, m[0])
    mean = m[2:2 + N_STATS] / n
    scale = np.sqrt(np.maximum(m[2 + N_STATS:] / n - mean ** 2, 0))
    scale[scale < 1e-9] = 1.0
    model = Model.start(mean, scale, features)
    if not m[0]:
        return model

    d = features + 1
    upper = np.triu_indices(d)
    n_cells = len(upper[0]) + d

    def normal(x, y):
        z = model.features(x)
        return np.arange(n_cells), np.concatenate([(z.T @ z)[upper], z.T @ y])

    s = _dense(_sums(fitting, normal), n_cells)
    a = np.zeros((d, d))
    a[upper] = s[:len(upper[0])]
    a = a + np.triu(a, 1).T + RIDGE * np.eye(d)
    model.ridge = np.linalg.solve(a, s[len(upper[0]):])
    model.knots = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    def histogram(x, y):
        at = np.clip(((model.raw(x) - LOW) / (HIGH - LOW) * BINS).astype(int), 0, BINS - 1)
        return np.arange(2 * BINS), np.concatenate([np.bincount(at, minlength=BINS),
                                                    np.bincount(at, weights=y, minlength=BINS)])

    h = _dense(_sums(calibrating, histogram), 2 * BINS)
    seen = np.flatnonzero(h[:BINS])
    if len(seen):
        model.knots = isotonic(LOW + (seen + 0.5) * (HIGH - LOW) / BINS, h[seen], h[BINS + seen])
    return model


def score(stats: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    def run(batches):
        for b in batches:
            s = model.score(_matrix(b.column("stats")))
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), b.column("held_out"), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    return map_batches(
        stats.select("doc_id", "held_out", "stats"), run,
        f"doc_id {stats.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int")


def quality_scores(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """Per document: doc_id, held_out, score (0 to 1), predicted (1 when the
    score is at least THRESHOLD).

    Only the text is scored. A null text counts as empty and is scored like
    one; a row without an id is held out and scored; repeated rows get equal
    scores; labels of unknown ids and null labels are ignored; other columns
    are ignored; empty documents give an empty result, no labels a score of
    0.5 for every row.
    """
    stats = kept_table(document_statistics(docs), "quality-statistics")
    return score(stats, fit(stats, labels, max_train))
