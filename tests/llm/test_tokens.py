import hashlib
import random
import zlib

import pytest

from ridgeline.llm import packing, token_counts, word_bpe
from helpers import AWKWARD, awkward, empty

P = pytest.importorskip("public_tokenizers")

ALPHABET = "ab \n\t  eÉéñßΣσ<|>'s'tre1234.,;!@#中文字😀▁\x00  İıǅȺÀÖ×÷ŉſǰ\x1c\x85"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(1500)] + \
        [t or "" for _, t, _, _ in AWKWARD]


def test_prefix_counts_are_those_of_every_prefix(texts):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path(token_counts.MODEL))
    counter = token_counts.load(None)
    for t in texts[:300]:
        assert counter.prefixes(t) == [len(sp.encode(t[:i])) for i in range(len(t) + 1)]
    for t in texts:
        assert counter.total_and_cut(t, 4096)[0] == len(sp.encode(t))


def test_cut_is_the_longest_prefix_within_the_budget(texts):
    counter = token_counts.load(None)
    for k, t in enumerate(texts[:400]):
        limit = k % 25
        prefixes = counter.prefixes(t)
        assert counter.total_and_cut(t, limit) == (
            prefixes[-1], max(i for i, c in enumerate(prefixes) if c <= limit))


def test_token_counts_of_awkward_rows(spark):
    got = sorted(tuple(r) for r in token_counts.token_counts(awkward(spark)).na.fill(-1, ["doc_id"]).collect())
    counter = token_counts.load(None)
    want = sorted((-1 if i is None else i, len((t or "").encode()), n, n > 4096, cut)
                  for i, t, _, _ in AWKWARD for n, cut in [counter.total_and_cut(t or "", 4096)])
    assert got == want
    assert token_counts.token_counts(empty(spark)).count() == 0
    assert token_counts.prefix_token_counts(empty(spark)).count() == 0


def test_word_bpe_is_the_library(texts):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(P.path(word_bpe.MODEL))
    codec = word_bpe.load(None)
    for t, (ids, decoded) in zip(texts, codec.texts(texts)):
        want = tok.encode(t, add_special_tokens=False).ids
        assert (memoryview(ids).cast("I").tolist() if ids else []) == want
        assert decoded.decode() == codec.decode(ids).decode() == tok.decode(want, skip_special_tokens=False)


def test_word_bpe_of_awkward_rows(spark):
    rows = word_bpe.encode_decode(awkward(spark), keep_ids=True).collect()
    assert len(rows) == len(AWKWARD)
    for r in rows:
        raw = b"".join(i.to_bytes(4, "little") for i in r.ids)
        assert r.n_tokens == len(r.ids) and r.ids_sha256 == hashlib.sha256(raw).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
    assert word_bpe.encode_decode(empty(spark)).count() == 0


def test_byte_ids_are_the_library(texts):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(P.path(packing.MODEL))
    encoder = packing.load(None)
    for t in texts:
        ids = encoder.ids(t)
        assert (memoryview(ids).cast("I").tolist() if ids else []) == tok.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [
    " " * 1_500_000, "\n" * 1_500_000, "a" + "\u3000 " * 600_000 + "b <|endoftext|> c", "a" + " " * 99_999 + "b",
    " " * 100_000 + "b"])
def test_long_runs_of_blanks_are_the_library(text):
    from tokenizers import Tokenizer
    ids = packing.load(None).ids(text)
    want = Tokenizer.from_file(P.path(packing.MODEL)).encode(text, add_special_tokens=False).ids
    assert memoryview(ids).cast("I").tolist() == want


def test_long_runs_of_blanks_are_packed(spark):
    texts = [" " * 1_500_000, "\n" * 1_500_000, "a b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lengths = {r.doc_id: r.n for r in packing.pack(df).groupBy("doc_id").agg({"length": "sum"}).toDF("doc_id", "n").collect()}
    assert lengths == {i: len(packing.load(None).ids(t)) // 4 + 1 for i, t in enumerate(texts)}


@pytest.mark.parametrize("at", [0, 1, 7, 99_999])
def test_long_blanks_are_seen_wherever_they_lie(at):
    for n in (99_999, 100_000, 100_001):
        assert packing.has_long_blanks("x" * at + " " * n + "x") == (n >= 100_000)


@pytest.mark.parametrize("group", [20_000, 7])
def test_packing_is_whole_and_gapless(spark, monkeypatch, group):
    monkeypatch.setattr(packing, "GROUP_PIECES", group)
    rows = packing.pack(awkward(spark), keep_ids=True).collect()
    encoder = packing.load(None)
    want = sorted(encoder.ids(t or "") + (2).to_bytes(4, "little") for _, t, _, _ in AWKWARD)
    parts, sequences = {}, {}
    for r in rows:
        raw = b"".join(i.to_bytes(4, "little") for i in r.ids)
        assert zlib.crc32(raw) == r.ids_crc32 and len(r.ids) == r.length <= 1024
        assert r.length == 1024 or r.piece == 0
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        parts.setdefault((r.doc_id, r.piece, r.start), []).append(raw)
    for used in sequences.values():
        at = 0
        for offset, length in sorted(used):
            assert offset == at
            at += length
        assert at <= 1024
    assert sum(r.length for r in rows) * 4 == sum(map(len, want))
    ids = {i for i, *_ in AWKWARD}
    for doc_id in ids - {None, 10}:
        own = b"".join(parts[k][0] for k in sorted(k for k in parts if k[0] == doc_id))
        assert own in want
    assert len(parts[(10, 0, 0)]) == 2  # a repeated row is packed twice


def test_packing_rule_and_waste():
    import numpy as np
    rng = np.random.default_rng(1)
    for sizes, waste in ((rng.integers(1, 1024, 3000), 1.04), (rng.integers(1, 400, 3000), 1.005)):
        bins, offsets = packing.best_fit(np.sort(sizes)[::-1], 1024)
        assert bins.max() + 1 <= waste * sizes.sum() / 1024 + 1
        assert np.bincount(bins, weights=np.sort(sizes)[::-1]).max() <= 1024

    # the rule itself, by trying every choice
    def squares(g):
        counts = {}
        for x in g:
            if x:
                counts[x] = counts.get(x, 0) + 1
        return sum(c * c for c in counts.values())

    small, gaps = rng.integers(1, 12, 60), []
    bins, used = packing.fill(small, 12, np.empty(0, np.int64))
    for s, b in zip(small.tolist(), bins.tolist()):
        options = [squares(gaps + [12 - s])] + [squares(gaps[:i] + [g - s] + gaps[i + 1:])
                                               for i, g in enumerate(gaps) if g >= s]
        gaps = gaps + [12] if b == len(gaps) else gaps
        gaps[b] -= s
        assert gaps[b] >= 0 and squares(gaps) == min(options)
    assert used == len(gaps)


def test_sequences_hold_the_pieces_in_order(spark):
    packed = packing.pack(awkward(spark), keep_ids=True)
    seqs = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert seqs[r.sequence_id][r.offset:r.offset + r.length] == r.ids
    assert packing.pack(empty(spark)).count() == 0
