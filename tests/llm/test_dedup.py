import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridgeline import session
from ridgeline.llm import exact_dedup, jaccard_join
from ridgeline.llm.common import located
from ridgeline.llm.components import components as graph
from helpers import AWKWARD, BLANK, awkward, components, empty, key, near


def _decided(rows):
    """The contract over (doc_id, text) rows, by grouping in memory."""
    groups = {}
    for i, (doc_id, text) in enumerate(rows):
        groups.setdefault(BLANK.sub("", text or ""), []).append(
            (-len(text or ""), doc_id is None, doc_id or 0, i))
    out = []
    for members in groups.values():
        best = min(members)
        keep = rows[best[3]][0]
        out += [(rows[m[3]][0], keep, len(members)) for m in members]
    return sorted(map(key, out))


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup_decisions(spark, weak):
    """With a digest of one hex digit nearly all hits are false, and the byte
    comparison has to tell the texts apart."""
    digest = (lambda c: F.unhex(F.concat(F.lit("0"), F.substring(F.sha2(c, 256), 1, 1)))) if weak else exact_dedup.sha256
    rows = located(awkward(spark).select("doc_id", "text"))
    got = exact_dedup.decisions(rows, digest).collect()
    assert sorted(key((r.doc_id, r.keep_id, r.group_size)) for r in got) == _decided([r[:2] for r in AWKWARD])
    texts = {BLANK.sub("", t or "") for _, t, _, _ in AWKWARD}
    assert sum(r.kept for r in got) == len(texts)


def test_exact_dedup_keeps_whole_rows(spark):
    df = awkward(spark)
    kept = exact_dedup.exact_dedup(df)
    assert kept.columns == df.columns
    assert kept.count() == len({BLANK.sub("", t or "") for _, t, _, _ in AWKWARD})
    assert kept.exceptAll(df).count() == 0
    assert exact_dedup.exact_dedup(empty(spark)).count() == 0


def test_state_outlives_a_call(spark, tmp_path):
    """A second call with the same folders finds copies of the first call's rows."""
    landing, state = str(tmp_path / "records"), str(tmp_path / "state")
    one = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    two = spark.createDataFrame([(3, "ab"), (4, "d")], "doc_id long, text string")
    first = located(one)
    exact_dedup.decisions(first, landing=landing, state=state).count()
    both = located(one.union(two))
    # the first rows keep their locators: the second landing adds two records
    (located(two).select("doc_id", F.lit(False).alias("no_id"), "file", "row",
                         (-F.char_length("text")).alias("points"),
                         exact_dedup.sha256(exact_dedup.squeeze(F.col("text"))).alias("digest"))
     .write.mode("append").parquet(landing))
    index = exact_dedup.update_index(spark, landing, state).collect()
    assert [(r.n, r.keep.doc_id) for r in index] == [(2, 1)]
    assert both.count() == 4


@pytest.mark.parametrize("weak", [False, True])
def test_decisions_of_two_calls_are_those_of_one(spark, tmp_path, weak):
    """Copies and false hits whose keepers came in an earlier call."""
    digest = (lambda c: F.unhex(F.concat(F.lit("0"), F.substring(F.sha2(c, 256), 1, 1)))) if weak else exact_dedup.sha256
    landing, state = str(tmp_path / "records"), str(tmp_path / "state")
    rows = [r[:2] for r in AWKWARD] + [(300, "some text"), (301, "so me text ")]
    rng = random.Random(3)
    rng.shuffle(rows)
    for part in (rows[::2], rows[1::2]):
        df = located(spark.createDataFrame(part, "doc_id long, text string"))
        got = exact_dedup.decisions(df, digest, landing, state)
    got = got.collect()
    assert sorted(key((r.doc_id, r.keep_id, r.group_size)) for r in got) == _decided(rows)
    assert sum(r.kept for r in got) == len({BLANK.sub("", t or "") for _, t in rows})


def test_a_repeated_call_changes_nothing(spark, tmp_path):
    """A retry after success, and after a death between landing and state."""
    landing, state = str(tmp_path / "records"), str(tmp_path / "state")
    rows = [r[:2] for r in AWKWARD]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(2).write.parquet(str(tmp_path / "docs"))
    docs = located(spark.read.parquet(str(tmp_path / "docs")))

    class Died(Exception):
        pass

    def dies(*_):
        raise Died
    real, exact_dedup.update_index = exact_dedup.update_index, dies
    try:
        with pytest.raises(Died):
            exact_dedup.decisions(docs, exact_dedup.sha256, landing, state)
    finally:
        exact_dedup.update_index = real
    for _ in range(2):
        got = exact_dedup.decisions(docs, exact_dedup.sha256, landing, state).collect()
        assert sorted(key((r.doc_id, r.keep_id, r.group_size)) for r in got) == _decided(rows)
        assert sum(r.kept for r in got) == len({BLANK.sub("", t or "") for _, t in rows})


def test_changed_texts_of_earlier_calls_are_noticed(spark, tmp_path):
    folders, docs = (str(tmp_path / "records"), str(tmp_path / "state")), str(tmp_path / "a b[1]")
    spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string").coalesce(1).write.parquet(docs)
    whole = spark.read.schema("doc_id long, text string").parquet(docs.replace("[", "\\[").replace("]", "\\]"))
    other = spark.createDataFrame([(3, "ab")], "doc_id long, text string")
    exact_dedup.decisions(located(whole), exact_dedup.sha256, *folders)
    got = exact_dedup.decisions(located(other), exact_dedup.sha256, *folders)
    assert sorted((r.doc_id, r.keep_id, r.kept) for r in got.collect()) == [(1, 1, True), (2, 2, True), (3, 1, False)]
    upper = located(whole).withColumn("text", F.upper("text"))
    folders = (str(tmp_path / "records2"), str(tmp_path / "state2"))
    exact_dedup.decisions(upper, exact_dedup.sha256, *folders)
    again = spark.createDataFrame([(4, "AB")], "doc_id long, text string")
    with pytest.raises(Exception, match="gone or changed"):
        exact_dedup.decisions(located(again), exact_dedup.sha256, *folders).collect()


def _got(df):
    return sorted(key(r) for r in df.collect())


@pytest.mark.parametrize("block", [600_000, 300])
def test_jaccard_components_of_awkward_rows(spark, monkeypatch, block):
    """Also with blocks so small that a group is split over many."""
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    got = _got(jaccard_join.jaccard_components(awkward(spark)))
    assert got == sorted(map(key, components([r[:2] for r in AWKWARD])))


@pytest.mark.parametrize("seed,block", [(1, 600_000), (2, 400), (3, 150), (4, 150)])
def test_jaccard_components_of_chains(spark, monkeypatch, seed, block):
    """Documents that drift step by step, so links run through members and
    across blocks, and many pairs lie close to the threshold."""
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "CELL_BITS", 8)
    rng = random.Random(seed)
    rows = []
    for family in range(4):
        words = [f"w{family}_{k}" for k in range(rng.randint(20, 60))]
        for _ in range(25):
            words = list(words)
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(len(words))] = f"n{rng.randrange(10 ** 6)}"
            rows.append((len(rows), " ".join(words + ["common tail of every text in this table"])))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert _got(jaccard_join.jaccard_components(df)) == sorted(map(key, components(rows)))


def test_jaccard_of_empty_and_unlinked(spark):
    assert jaccard_join.jaccard_components(empty(spark)).count() == 0
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a b c d e f")], "doc_id long, text string")
    assert _got(jaccard_join.jaccard_components(df)) == [("1", "0", "1"), ("2", "0", "2"), ("3", "2", "3")]


def test_one_per_component(spark):
    df = awkward(spark)
    kept = jaccard_join.one_per_component(df)
    assert kept.columns == df.columns and kept.exceptAll(df).count() == 0
    left = [r.doc_id for r in kept.collect()]
    groups = {c for _, n, c in components([r[:2] for r in AWKWARD]) if n}
    wordless = [i for i, t, _, _ in AWKWARD if not re.search("[^\x20\x09-\x0d]", t or "")]
    assert sorted(map(str, left)) == sorted(map(str, [*groups, *wordless]))


def test_t_occurrence_search_finds_all():
    rng = random.Random(9)
    index, sets = jaccard_join.Lists(), []
    for _ in range(200):
        sets.append(sorted(rng.sample(range(60), rng.randint(1, 25))))
        index.add(sets[-1])
    for least in (1, 3, 8, 15):
        for own in sets[:60]:
            want = {(k, len(set(own) & set(s))) for k, s in enumerate(sets) if len(set(own) & set(s)) >= least}
            assert set(index.search(own, least)) == want


def test_clusters_are_those_of_all_pairs(monkeypatch):
    """Sets that share much and little, with heap, counting and probing."""
    link = jaccard_join.Link()
    for seed in range(12):
        rng = np.random.default_rng(seed)
        for name, values in (("HEAP", (0, 5, 256)), ("SMALL", (2, 8, 32)), ("PROBE", (0, 1, 8, 1e9))):
            monkeypatch.setattr(jaccard_join.Lists, name, rng.choice(values))
        words = rng.integers(1, 2**63, int(rng.integers(30, 400)), dtype=np.uint64)
        bases = [rng.choice(words, int(rng.integers(1, min(len(words), 60))), False) for _ in range(6)]
        sets = []
        for _ in range(120):
            own = bases[rng.integers(6)].copy()
            n = int(rng.integers(0, max(1, len(own) // 5) + 1))
            own[rng.choice(len(own), n, False)] = rng.choice(words, n)
            sets.append(np.unique(own))
        up = list(range(len(sets)))

        def root(i):
            while up[i] != i:
                i = up[i]
            return i
        for i, a in enumerate(sets):
            for j in range(i):
                if link.holds(len(np.intersect1d(a, sets[j])), len(a), len(sets[j])):
                    up[max(root(i), root(j))] = min(root(i), root(j))
        assert jaccard_join.cluster(sets, link)[0] == [root(i) for i in range(len(sets))], seed


def test_texts_of_one_template_cost_little():
    """A thousand sets with most shingles in common, none of which link."""
    rng = np.random.default_rng(1)
    shared = rng.integers(1, 2**63, 175, dtype=np.uint64)
    sets = [np.unique(np.concatenate((shared, rng.integers(1, 2**63, 25, dtype=np.uint64)))) for _ in range(1000)]
    start = time.process_time()
    comp, leader, _ = jaccard_join.cluster(sets, jaccard_join.Link())
    assert comp == leader == list(range(1000)) and time.process_time() - start < 10


def test_long_repetitive_texts_weigh_their_bytes(spark, monkeypatch):
    """Few shingles, many bytes: such texts are spread over blocks by bytes."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 20_000)
    seen = []
    real = jaccard_join._placed
    monkeypatch.setattr(jaccard_join, "_placed", lambda cand: seen.append(real(cand)) or seen[-1])
    text = " ".join(f"word{k}" for k in range(40))
    rows = [(i, (text + f" end{i} ") * 400) for i in range(12)] + [(50, text), (51, text + " more")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert _got(jaccard_join.jaccard_components(df)) == sorted(map(key, components(rows)))
    assert seen[0].select("block").distinct().count() > 4


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(500, 400), (400, 450), (7, 7)],
                                  "a long, b long")
    got = {r.node: r.label for r in graph(edges).collect()}
    assert got == {**{i: 0 for i in range(101)}, 400: 400, 450: 400, 500: 400}


def test_near_copies_are_linked():
    assert components([(k, near(k)) for k in range(5)])[4][2] == 0


def _scattered(n, start=0):
    """Texts of 60 words of their own round a passage that all share: a tenth
    of their shingles, so none links to another."""
    return [(start + i, " ".join([*(f"own{start + i}x{k}" for k in range(50)), *(f"passage{k}" for k in range(10))]))
            for i in range(n)]


def test_texts_with_shingles_of_their_own_are_left_out(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "FLUSH", 300)  # several chunks
    rows = _scattered(30) + [(100 + k, near(k)) for k in range(5)] + [(200, near(1)), (201, "a b"), (202, "c d"), (203, "c  D"),
                                                                    (204, None), (205, " ")]
    df = located(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    link = jaccard_join.Link()
    names = {r.node: r.doc_id for r in jaccard_join.profiles(df).where("node is not null").collect()}
    may = {names[r.node] for r in jaccard_join.nodes_that_may_link(df, 2000, link).collect()}
    assert may & set(range(30)) == set() and 201 not in may
    assert {100, 102, 103, 104} <= may and {101, 200} & may and {202, 203} & may
    got = _got(jaccard_join.jaccard_components(df.select("doc_id", "text")))
    assert got == sorted(map(key, components(rows)))


def test_few_cells_for_all_shingles_make_no_large_group(spark, monkeypatch):
    """Cells that all hold many shingles tell no rare one from a common one."""
    monkeypatch.setattr(jaccard_join, "CELL_BITS", 5)
    seen = []
    real = jaccard_join._placed
    monkeypatch.setattr(jaccard_join, "_placed", lambda cand: seen.append(real(cand)) or seen[-1])
    rows = _scattered(200) + [(300 + k, near(k)) for k in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    left = {}
    monkeypatch.setattr(jaccard_join, "prefix_edges", lambda rows, *a, f=jaccard_join.prefix_edges: (
        left.setdefault("n", rows.count()), f(rows, *a))[1])
    assert _got(jaccard_join.jaccard_components(df)) == sorted(map(key, components(rows)))
    assert left["n"] <= 10


def test_tables_on_the_way_are_removed(spark):
    before = set(session.child_names(spark, f"{session.shared_dir(spark)}/ridgeline"))
    df = spark.createDataFrame([(k, near(k)) for k in range(9)], "doc_id long, text string")
    jaccard_join.jaccard_components(df).count()
    made = set(session.child_names(spark, f"{session.shared_dir(spark)}/ridgeline")) - before
    kinds = [n.rpartition("-")[0] for n in made]
    assert kinds.count("jaccard-texts") == 1
    assert not {"jaccard-prefixes", "components-edges", "components-labels", "components-up"} & set(kinds)
