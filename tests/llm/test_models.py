import random
import zlib

import numpy as np
import pytest

from ridgeline.llm import language_id, quality_classifier
from helpers import AWKWARD, awkward, empty

SYLLABLES = {"en": "th er ing ou st wh nd ly".split(), "fr": "eau qui ment è tre ou elle é".split(),
             "de": "sch ung ich ß ein ver ü zu".split()}


def _prose(rng, lang, n):
    words = ["".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n)]
    return " ".join(words).capitalize() + "."


def _held_out(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(8)
    docs, labels = [], []
    for k in range(600):
        lang = rng.choice(sorted(SYLLABLES))
        good = rng.random() < 0.7
        text = "\n".join(_prose(rng, lang, rng.randint(5, 20)) for _ in range(rng.randint(1, 6)))
        if not good:
            text = rng.choice([" ".join(w + "***" for w in text.split()), text.upper().replace(" ", "!! "),
                               " ".join([text.split()[0]] * 80)])
        docs.append((k, text, lang))
        labels.append((k, int(good), 0))
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_quality_scores_separate_held_out_rows(labelled):
    docs, labels = labelled
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = quality_classifier.quality_scores(docs, labels).collect()
    assert len(rows) == 600 and all(r.held_out == _held_out(r.doc_id) for r in rows)
    test = [r for r in rows if r.held_out]
    good = [r.score for r in test if truth[r.doc_id]]
    bad = [r.score for r in test if not truth[r.doc_id]]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert np.mean([r.predicted == truth[r.doc_id] for r in test]) > 0.95


def test_labels_of_held_out_rows_change_nothing(spark, labelled):
    docs, labels = labelled
    flipped = spark.createDataFrame(
        [(r.doc_id, 1 - r.quality if _held_out(r.doc_id) else r.quality, 0) for r in labels.collect()], labels.schema)
    a = {r.doc_id: r.score for r in quality_classifier.quality_scores(docs, labels).collect()}
    b = {r.doc_id: r.score for r in quality_classifier.quality_scores(docs, flipped).collect()}
    assert a == pytest.approx(b, abs=1e-5)


def test_quality_of_awkward_rows(spark, labelled):
    labels = labelled[1].unionByName(spark.createDataFrame([(None, 1, 0), (1, None, 0), (10, 0, 0), (10, 1, 0)],
                                                           labelled[1].schema))
    rows = quality_classifier.quality_scores(awkward(spark), labels).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r.score <= 1 for r in rows)
    same = {r.score for r in rows if r.doc_id in (4, 5, 6)}
    assert len(same) == 1  # null, empty and blank texts
    none = quality_classifier.quality_scores(awkward(spark), spark.createDataFrame([], labels.schema)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality_classifier.quality_scores(empty(spark), labels).count() == 0


def test_features_approximate_the_gaussian_kernel():
    n = quality_classifier.N_STATS
    model = quality_classifier.Model.start(np.zeros(n), np.ones(n), features=20_000)
    x = np.random.default_rng(0).normal(size=(6, n)) * 0.8
    z = model.features(x)[:, :-1]
    want = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * n))
    assert np.abs(z @ z.T - want).max() < 0.05


def test_isotonic_is_the_least_squares_rising_fit():
    rng = np.random.default_rng(3)
    x, w = np.arange(30.0), rng.integers(1, 5, 30)
    y = np.round(np.clip(x / 30 + rng.normal(0, 0.3, 30), 0, 1) * w)
    kx, ky = quality_classifier.isotonic(x, w, y)
    assert (np.diff(ky) > 0).all() and (np.diff(kx) > 0).all()
    # minimax form: the fit at i is max over a <= i of min over b >= i of the mean of a..b
    means = [[y[a:b + 1].sum() / w[a:b + 1].sum() if b >= a else 0 for b in range(30)] for a in range(30)]
    want = sorted({round(max(min(means[a][b] for b in range(i, 30)) for a in range(i + 1)), 9) for i in range(30)})
    assert np.allclose(ky, want)


def test_statistics_do_not_depend_on_neighbours():
    texts = [t for _, t, _, _ in AWKWARD]
    together = list(quality_classifier.statistics(texts))
    alone = [next(quality_classifier.statistics([t])) for t in texts]
    assert np.allclose(together, alone)
    counts = np.vstack(list(language_id.term_counts(texts)))
    assert (counts == np.vstack([next(language_id.term_counts([t])) for t in texts])).all()


def test_languages_of_held_out_rows(labelled):
    docs, _ = labelled
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = language_id.identify_languages(docs).collect()
    test = [r for r in rows if r.held_out]
    assert len(rows) == 600 and len(test) > 60
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in test]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_languages_of_awkward_rows(spark, labelled):
    model = language_id.fit(labelled[0])
    rows = {r.doc_id: r for r in language_id.predict(awkward(spark), model).collect()}
    assert all(rows[i].lang_pred == "und" and rows[i].score == 0 for i in (4, 5, 6))
    assert rows[7].lang_pred in SYLLABLES and rows[11].rejected
    assert len(language_id.identify_languages(awkward(spark)).collect()) == len(AWKWARD)
    assert language_id.identify_languages(empty(spark)).count() == 0
    nothing = awkward(spark).selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r.lang_pred for r in language_id.identify_languages(nothing).collect()} == {"und"}


def test_languages_of_any_kind_of_id(spark, labelled):
    docs = labelled[0].selectExpr("concat('d', doc_id) AS doc_id", "text", "lang")
    rows = language_id.identify_languages(docs).collect()
    truth = {r.doc_id: r.lang for r in docs.collect()}
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in rows]) > 0.95


def test_the_sample_is_bounded_when_one_id_has_all_rows(spark, labelled):
    """One id with different texts, and one row many times."""
    rows = labelled[0].selectExpr("1 AS doc_id", "text", "lang")
    rows = rows.union(rows.limit(1).selectExpr("doc_id", "text", "lang", "explode(sequence(1, 2000)) AS k").drop("k"))
    many = language_id.fit(rows.repartition(3), max_per_lang=40)
    assert len(set(many.langs)) == 3 and many.centroids.shape == (12, language_id.DIMS)


def plain_counts(text):
    """Hashed n-grams of 1 to 4 folded bytes, counted one by one."""
    fold = lambda b: b + 32 if 65 <= b <= 90 else 32 if b < 65 or 91 <= b <= 96 or 123 <= b <= 127 else b
    data = bytes(fold(b) for b in b" " + (text or "").encode() + b" ")
    out = np.zeros(language_id.DIMS)
    for n in language_id.ORDERS:
        for i in range(len(data) - n + 1):
            gram = data[i:i + n]
            if gram[0] == 32 and gram[-1] == 32:
                continue
            code = 0
            for b in gram:
                code = (code * 257 + b) % (1 << 32)
            mixed = ((code * 0x9E3779B1) % (1 << 32) + n * 0x85EBCA6B) % (1 << 32) >> 20
            out[mixed % language_id.DIMS] += 1
    return out


def test_whole_language_query_against_plain_code(spark):
    """The registered query on whole tables against one loop over all rows:
    frequencies, vectors, centroids (spherical k-means from the same start)
    and cosines are all worked out again here."""
    from ridgeline.llm import queries
    path = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text", "lang").collect()
    counts = {i: plain_counts(r.text) for i, r in enumerate(docs)}
    learn = [i for i, r in enumerate(docs) if not _held_out(r.doc_id) and r.lang and r.text is not None]
    idf = np.log((1 + len(learn)) / (1 + sum((counts[i] > 0) for i in learn))) + 1

    def vector(i):
        v = np.log1p(counts[i]) * idf
        return v / max(np.linalg.norm(v), 1e-12)
    centroids = []
    for lang in sorted({docs[i].lang for i in learn}):
        x = np.stack([vector(i).astype(np.float32) for i in sorted(learn, key=lambda i: docs[i].doc_id)
                      if docs[i].lang == lang])
        rng = np.random.default_rng(3)
        c = x[rng.choice(len(x), min(language_id.CENTROIDS, len(x)), replace=False)]
        for _ in range(15):
            cos = x @ c.T
            own = cos.argmax(1)
            c = np.stack([x[own == j].sum(0) if (own == j).any() else x[cos.max(1).argmin()] for j in range(len(c))])
            c /= np.linalg.norm(c, axis=1, keepdims=True)
        centroids += [(lang, v) for v in c]
    got = {r.doc_id: r for r in queries.op10_language_id(spark, path).collect()}
    assert len(got) == len(docs)
    for i, r in enumerate(docs):
        row = got[r.doc_id]
        assert row.held_out == _held_out(r.doc_id)
        if not any(ch.isalpha() for ch in r.text or ""):
            assert (row.lang_pred, row.score) == ("und", 0.0)
            continue
        cos = [float(vector(i) @ v) for _, v in centroids]
        best = int(np.argmax(cos))
        assert abs(row.score - cos[best]) < 1e-4
        assert row.lang_pred == centroids[best][0] or max(cos) - max(
            c for c, (lang, _) in zip(cos, centroids) if lang == row.lang_pred) < 1e-5


def test_whole_quality_query_against_plain_code(spark):
    """The registered query against dense algebra over all rows: statistics
    one text at a time, the ridge by least squares, calibration by the minimax
    form of isotonic regression."""
    from ridgeline.llm import queries
    path = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()
    labels = {}
    for r in spark.read.parquet(f"{path}/labels.parquet").select("doc_id", "quality").collect():
        labels.setdefault(r.doc_id, []).append(r.quality)
    stats = np.vstack([next(quality_classifier.statistics([r.text])) for r in docs])
    fold = np.array([zlib.crc32(str(r.doc_id).encode()) % 5 for r in docs])
    label = np.array([np.mean(labels[r.doc_id]) if r.doc_id in labels else np.nan for r in docs])
    fitting, calibrating = (fold % 4 > 0) & ~np.isnan(label), (fold == 4) & ~np.isnan(label)
    assert set(fold[fitting]) == {1, 2, 3}
    mean, scale = stats[fitting].mean(0), stats[fitting].std(0)
    scale[scale < 1e-9] = 1
    rng = np.random.default_rng(7)
    weights = rng.normal(0, 1 / np.sqrt(stats.shape[1]), (stats.shape[1], 256))
    phase = rng.uniform(0, 2 * np.pi, 256)
    z = np.cos(np.clip((stats - mean) / scale, -6, 6) @ weights + phase) * np.sqrt(2 / 256)
    z = np.hstack([z, np.ones((len(z), 1))])
    # ridge as least squares with a row per weight
    a = np.vstack([z[fitting], np.eye(257)])
    ridge = np.linalg.lstsq(a, np.concatenate([label[fitting], np.zeros(257)]), rcond=None)[0]
    raw = z @ ridge
    # calibration: bins of the raw score, then max over starts of min over ends
    at = np.clip(((raw[calibrating] + 1) / 3 * 4000).astype(int), 0, 3999)
    seen = np.unique(at)
    w = np.array([(at == b).sum() for b in seen], float)
    t = np.array([label[calibrating][at == b].sum() for b in seen])
    n = len(seen)
    level = np.array([max(min(t[i:j + 1].sum() / w[i:j + 1].sum() for j in range(k, n)) for i in range(k + 1))
                      for k in range(n)])
    x = -1 + (seen + 0.5) * 3 / 4000
    values = np.unique(level.round(12))
    knots = np.array([np.average(x[level.round(12) == v], weights=w[level.round(12) == v]) for v in values])
    want = np.interp(raw, knots, values)
    got = {r.doc_id: r for r in queries.op1_quality_classifier(spark, path).collect()}
    assert len(got) == len(docs)
    off = [abs(got[r.doc_id].score - s) for r, s in zip(docs, want)]
    # a raw score that rounds into the next bin may move one knot
    assert np.quantile(off, 0.99) < 1e-3 and np.mean(off) < 1e-3
    assert all(got[r.doc_id].held_out == (f == 0) for r, f in zip(docs, fold))
    assert all(r.predicted == (r.score >= 0.3) for r in got.values())


def test_nearest_centroid_is_the_largest_cosine():
    rng = np.random.default_rng(2)
    x = rng.random((50, language_id.DIMS))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    c = language_id.spherical_kmeans(x, 4)
    assert np.allclose(np.linalg.norm(c, axis=1), 1) and len(c) == 4
    model = language_id.Model(np.ones(language_id.DIMS), c, list("abcd"), {})
    counts = rng.integers(0, 5, (20, language_id.DIMS))
    best, cos = model.nearest(counts)
    v = np.log1p(counts)
    want = (v @ c.T) / np.linalg.norm(v, axis=1, keepdims=True)
    assert (best == want.argmax(1)).all() and np.allclose(cos, want.max(1))
