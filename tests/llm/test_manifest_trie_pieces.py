"""Operators 11 to 13 against plain code, on awkward rows."""

import hashlib
import re
import zlib
from collections import defaultdict

import pytest

from helpers import AWKWARD, awkward, empty, key
from ridgeline.llm import merkle, piece_codec, prefix_trie, queries

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ------------------------------------------------------------- manifest

def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def plain_tree(nodes, paths):
    while len(nodes) > 1:
        runs = [nodes[i:i + 8] for i in range(0, len(nodes), 8)]
        for run in runs:
            for k, (_, leaves) in enumerate(run):
                for leaf in leaves:
                    paths[leaf].append(("".join(d for d, _ in run[:k]), "".join(d for d, _ in run[k + 1:])))
        nodes = [(sha("".join(d for d, _ in run)), [x for _, ls in run for x in ls]) for run in runs]
    return nodes[0]


def plain_manifest(rows, change):
    """rows: (doc_id, text, lang, source, n_chars)."""
    def leaf(d, t, la, s, n):
        return sha("".join(map(field, (d, s, la, n, t))))
    groups, paths, own, sub = defaultdict(list), defaultdict(list), [leaf(*r) for r in rows], {}
    for i, r in enumerate(rows):
        groups[r[2]].append(((r[0] is not None, r[0] or 0, own[i], i), i))
    tops = []
    for lang in sorted(groups, key=lambda x: (x is not None, (x or "").encode())):
        members = [i for _, i in sorted(groups[lang])]
        tops.append(plain_tree([(own[i], [i]) for i in members], paths))
        sub.update({i: tops[-1][0] for i in members})
    root = plain_tree(tops, paths)[0]
    out = []
    for i, (d, t, la, s, n) in enumerate(rows):
        folded = leaf(d, change(d, t), la, s, n)
        for left, right in paths[i]:
            folded = sha(left + folded + right)
        out.append((d, own[i], sub[i], root, sha("".join(a + b for a, b in paths[i])), folded, folded == root))
    return out


def lowered(d, t):
    if d is None or t is None or zlib.crc32(str(d).encode()) % 3:
        return t
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


@pytest.mark.parametrize("height", [1, 4])
def test_manifest_on_awkward_rows(spark, height):
    # null ids, langs, sources and texts, repeated rows, hot and single langs
    rows = [(d, t, la, s, 7) for d, t, la, s in AWKWARD] + [(5, "x", "de", "b", None)] * 3
    docs = awkward(spark).select("doc_id", "text", "lang", "source", "n_chars", "kept").unionByName(
        spark.createDataFrame([(5, "x", "de", "b")] * 3, "doc_id long, text string, lang string, source string"),
        allowMissingColumns=True)
    got = merkle.audit(docs, height=height).collect()
    assert sorted(map(key, got)) == sorted(map(key, plain_manifest(rows, lowered)))
    assert {r.verified for r in got} == {True, False}


def test_manifest_of_every_size_up_to_two_blocks(spark):
    """Runs that are full, short or of one node, at every level."""
    for n in (1, 2, 8, 9, 64, 65, 73):
        rows = [(i, f"text {i}", "en", None, i) for i in range(n)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
        got = merkle.manifest(docs, height=1, keep_path=True).collect()
        assert sorted(tuple(r)[:-1] for r in got) == sorted(plain_manifest(rows, lambda d, t: t)), n
        assert all(r.verified and sha("".join(r.path)) == r.proof_sha256 for r in got)


def test_manifest_of_nothing_and_of_many_langs(spark):
    none = empty(spark).selectExpr("*", "cast(null as long) AS n_chars")
    assert merkle.audit(none).collect() == []
    rows = [(i, "t", f"lang {i % 70}", "s", 1) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = merkle.audit(docs, height=1).collect()
    assert sorted(map(tuple, got)) == sorted(plain_manifest(rows, lowered))


def test_witnesses_grow_with_later_siblings():
    block = merkle.Block(1)
    for d in "abc":
        block.append(d)
    assert [n[3:] for n in block.runs[0]] == [["", ["b", "c"]], ["a", ["c"]], ["ab", []]]
    assert block.root() == sha("abc") and block.witness == [["", "bc"], ["a", "c"], ["ab", ""]]


# ------------------------------------------------------------- pieces

def library(texts):
    sp = piece_codec.load(None).library
    out = []
    for t in texts:
        ids = sp.encode(t or "", add_eos=True)
        out.append((len(ids), sha(" ".join(map(str, ids))), sha(sp.decode(ids))))
    return out


def test_pieces_are_those_of_the_library(spark):
    got = piece_codec.encode_decode(awkward(spark), keep_ids=True).collect()
    want = [(r[0], *x) for r, x in zip(AWKWARD, library([r[1] for r in AWKWARD]))]
    assert sorted(key(tuple(r)[:4]) for r in got) == sorted(map(key, want))
    assert all(r.n_tokens == len(r.ids) and sha(r.decoded) == r.decoded_sha256 for r in got)
    assert piece_codec.encode_decode(empty(spark)).count() == 0


def test_piece_query_on_whole_tables(spark):
    got = sorted(tuple(r) for r in queries.op12_piece_codec(spark, SF01).collect())
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect()
    assert got == sorted((r[0], *x) for r, x in zip(docs, library([r[1] for r in docs])))


def test_pieces_of_odd_characters():
    codec = piece_codec.load(None)
    texts = ["", " ", "  a  b ", "▁a▁ x", "\n\n a\n", "\x00\x01é日本語🙂", "<s></s><unk><0x0A> ⁇ ", "ﬁ é", "x" * 3000,
             "�\t\r\n", " " * 500, "日" * 500]
    assert [(i.count(" ") + 1, sha(i), sha(d)) for i, d in codec.texts(texts)] == library(texts)


def test_decoding_of_any_ids():
    codec = piece_codec.load(None)
    for ids in ([], [2], [0], [1, 29871, 29871], [29871, 0, 29871], [233, 162], [200, 3, 131, 130, 29871],
                [243, 162, 152, 133], [243, 162, 13, 29871, 5, 2, 300]):
        assert codec.decode(ids) == codec.library.decode(ids), ids


def test_agenda_difference_is_an_error():
    codec = piece_codec.PieceCodec(__import__("public_tokenizers").path(piece_codec.MODEL))
    codec.cost = {}
    with pytest.raises(AssertionError, match="library"):
        list(codec.texts(["the"]))


# ------------------------------------------------------------- trie

TURNS = "conv_id long, turn long, role string, text string"


def plain_trie(rows):
    own, full, members, kids = defaultdict(list), {}, defaultdict(list), defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            own[c].append((t is not None, t or 0, sha(f"{len(r.encode())}:{r}{x}"), r, x))
    turns = {c: [v[3:] for v in sorted(t)] for c, t in own.items()}
    for c, t in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        full[c] = tuple(turns.get(c - c % 20, [])[:h] + t[h:])
    for c, p in full.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved, out = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        words = len(re.findall("[^\x20\x09-\x0d]+", p[-1][1])) if p else 0
        saved[p] = (len(members[p]) - 1) * words + sum(saved[k] for k in kids[p])
        ends = ",".join(str(c) for c in sorted(members[p]) if len(full[c]) == len(p))
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(kids[p]),
                    leaves[p], saved[p], sha(ends)))
    return sorted(out, key=key)


def trie_of(df):
    return sorted((tuple(r) for r in prefix_trie.prefix_trie(df).collect()), key=key)


AWKWARD_TURNS = [
    (0, 0, "user", "hello there"), (0, 1, "assistant", "general words here"), (0, 2, "user", "more"),
    (1, 0, "user", "hello there"), (1, None, "system", "first of all"), (1, 0, "user", "hello there"),
    (2, 0, None, None), (2, 1, "user", ""), (3, 0, "", ""), (25, 0, "user", "alone"), (26, 0, "user", "alone"),
    (None, 0, "user", "of nobody"), (None, None, None, None), (40, 3, "a", "late"), (40, 1, "a", " \n "),
    (41, 0, "a", "x " * 30_000), *[(60 + k, t, "user", f"same {t}") for k in range(150) for t in range(6)],
    *[(300, t, "user", f"turn {t % 7}") for t in range(400)], *[(301, t, "user", f"turn {t % 7}") for t in range(300)],
]


@pytest.mark.parametrize("partitions, merge", [(8, "true"), (29, "false")])
def test_trie_on_awkward_turns(spark, partitions, merge):
    """Also with so many ranges that most hold one row: skeleton nodes deeper
    than a splitter's turns, ranges that a hot conversation spans."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", merge)
        df = spark.createDataFrame(AWKWARD_TURNS, TURNS).selectExpr("*", "1 AS depth", "2 AS words", "3 AS path", "4 AS n")
        assert trie_of(df) == plain_trie(AWKWARD_TURNS)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_trie_query_with_many_ranges(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF01}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = sorted((tuple(r) for r in queries.op13_prefix_trie(spark, SF01).collect()), key=key)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert got == plain_trie(rows)


def test_trie_of_nothing_and_without_turns(spark):
    assert trie_of(spark.createDataFrame([], TURNS)) == []
    assert trie_of(spark.createDataFrame([(None, 1, "a", "b")], TURNS)) == []
    # conversations whose own turns all give way to an absent base
    bare = [(c, 0, "user", "x") for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4]
    got = trie_of(spark.createDataFrame(bare, TURNS))
    assert got == plain_trie(bare) and len(got) == 1 and got[0][3] == len(bare)


def test_ends_are_hashed_across_tasks_and_chunks(spark):
    ids = list(range(3 * prefix_trie.ENDS_CHUNK + 5))
    df = spark.createDataFrame([(bytes([1]), i) for i in reversed(ids)] + [(bytes([2]), 7)], "path_id binary, conv_id long")
    got = {bytes(r[0]): r[1] for r in prefix_trie._ends(df).collect()}
    assert got == {bytes([1]): sha(",".join(map(str, ids))), bytes([2]): sha("7")}


def test_skeleton_holds_what_ranges_share():
    a, b, c = (bytes([i]) * 16 for i in (1, 2, 3))
    assert prefix_trie.skeleton([(a, a + b), (a + b + c, b), (c, c)]) == {b"", a, a + b}
    assert prefix_trie.common_turns(a + b + c, a + b + a) == 2 and prefix_trie.common_turns(a, b"") == 0
