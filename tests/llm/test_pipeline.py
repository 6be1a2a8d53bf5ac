import re

from pyspark.sql import functions as F

import corpus_pipeline
from ridgeline.llm import packing, pii, quality_rules
from helpers import AWKWARD, BLANK, awkward, components, empty, measures


def _plain_pipeline(spark, rows):
    """(doc_id, text) that reach the packing, by plain code (line rules apart)."""
    lines = sorted({line for _, t, _, _ in rows for line in (t or "").split("\n")})
    bad = {r.line for r in spark.createDataFrame([(x,) for x in lines], "line string")
           .where(quality_rules.line_fails(F.col("line"))).collect()}
    kept = []
    for doc_id, text, *_ in rows:
        n, _, _, _, repeats = measures(text)
        clean = "\n".join(line for line in (text or "").split("\n") if line not in bad)
        if n >= 10 and 100 * repeats <= 20 * n and 100 * (n - measures(clean)[0]) <= quality_rules.MAX_LOST_PERCENT * n:
            kept.append((doc_id, clean))
    groups = {}
    for i, (doc_id, text) in enumerate(kept):
        groups.setdefault(BLANK.sub("", text), []).append((-len(text), doc_id is None, doc_id or 0, i))
    kept = [kept[min(g)[3]] for g in groups.values()]
    kept = [row for row, (_, n, c) in zip(kept, components(kept)) if not n or c == row[0]]
    finder = pii.Finder(pii.trained())
    return [(i, pii.redact(t, every)) for (i, t), (_, every) in zip(kept, finder.find([t for _, t in kept]))]


def test_pipeline_against_plain_code(spark, tmp_path):
    # ids 2 and 3 differ from 1 in blanks only, the 100s are near copies
    df = awkward(spark)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    want = _plain_pipeline(spark, AWKWARD)
    encoder = packing.load(None)
    pieces = sorted((str(i), s, n) for i, t in want
                    for s, n in packing.cut(len(encoder.ids(t)) // 4 + 1, 1024))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((str(r.doc_id), r.start, r.length) for r in got) == pieces
    assert 1 < len(want) < len(AWKWARD)


def test_stages_keep_columns_and_take_empty_tables(spark):
    df = awkward(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, df, None).columns == df.columns, name
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty(spark), None).count() == 0, name
    assert [re.sub("_.*", "", n) for n, _ in corpus_pipeline.STAGES] == ["quality", "exact", "jaccard", "personal", "best"]
