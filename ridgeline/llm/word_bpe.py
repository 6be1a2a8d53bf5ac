"""Operator 9: BPE encoding and decoding by prefix-sharing trie traversal.

The words a batch has not seen yet go into a trie; a depth-first walk carries
the last-token state of every prefix (``bpe.TokenStates``), so a prefix that
many words share is encoded once. The last symbol of a word carries the
end-of-word mark, which makes the final step of a word its own; all states
before it are shared. Ids of finished white-space chunks are kept in a bounded
memo, and a text's ids are the ids of its chunks.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from ridgeline.llm.bpe import Ends, Memo, Suffixes, TokenStates
from ridgeline.llm.common import map_batches

MODEL = "word_bpe_49k.json"
# entries of about 250 bytes, two generations each; both hold the same codes
MEMO_CHUNKS = 600_000
MEMO_WORDS = 600_000
MEMO_CHARS = 64
# A trie branch per symbol costs memory; longer words walk a branch of their own.
TRIE_SYMBOLS = 256
# Chunks: no word of the model spans ASCII white space.
CHUNKS = re.compile("[\\x20\\x09-\\x0D]+")
# Chunks of printable ASCII and Latin letters that lower-case one to one and
# have no other normal form are split here, others by the library; the pattern
# is the model's (fixed by its file) on lower-case text of these letters.
LATIN = "À-ÖØ-öø-įı-ȹȻ-ȽȿɁ-ɏ"
PLAIN_CHUNK = re.compile(f"[!-~{LATIN}]+")
PLAIN_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{LATIN}]+|[0-9]|[^a-z0-9{LATIN}]+")
# Texts of about this many characters are encoded together: their new words
# share a trie.
SHARED_CHARS = 4 << 20


# ids as little-endian uint32, and the decoded text with a blank before every token
Coded = tuple[bytes, bytes]


class TrieCodec:
    """Encodes and decodes as the model file's own library does."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        order = {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(model["merges"])}
        self.states = TokenStates(list(self.vocab), lambda a, b: order.get((a, b)), self.symbols)
        inner, final = {}, {}
        for i, t in enumerate(self.states.names):
            if not self.end or not t.endswith(self.end):
                inner[t] = i
            if t.endswith(self.end):
                final[t.removesuffix(self.end)] = i
        self.automaton = Suffixes([*inner, *final])
        self.inner, self.final = Ends(self.automaton, inner), Ends(self.automaton, final)
        self.length = [len(t.removesuffix(self.end)) for t in self.states.names]
        self.packed = [struct.pack("<I", self.vocab[t]) for t in self.states.names]
        self.spaced = [b" " + t.encode() for t in self.states.names]
        self.token = {i: t for t, i in self.vocab.items()}
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        if any(a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] for a in spec["added_tokens"]):
            raise ValueError("added tokens that look beyond their own text are not supported")
        self.marks = {" " + c: (struct.pack("<I", i), b" " + c.encode()) for c, i in self.special.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None
        self.normal, self.words = tok.normalizer, tok.pre_tokenizer
        # how the model writes a letter's bytes
        self.bytes = {c: self.words.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x250)
                      if PLAIN_CHUNK.fullmatch(chr(c))}
        if tok.decoder is not None:
            raise ValueError("a model with a decoder of its own is not supported")
        self.token |= {i: t for t, i in self.special.items()}
        self.text = {i: t.encode() for i, t in self.token.items()}
        self.memo, self.coded = Memo(MEMO_CHUNKS), Memo(MEMO_WORDS)

    def symbols(self, token: str) -> list[str]:
        if self.end and token.endswith(self.end):
            out = list(token[:-len(self.end)])
            out[-1] += self.end
            return out
        return list(token)

    def walk(self, words: set[str]) -> dict[str, Coded]:
        """The codes of distinct words in the model's byte alphabet."""
        out: dict[str, Coded] = {}
        trie: dict = {}
        for w in words:
            node = trie
            if len(w) > TRIE_SYMBOLS:
                self._branch(w, out)
                continue
            for c in w:
                node = node.setdefault(c, {})
            node[""] = w
        # depth first; last holds the states along the path to the node. The
        # test of TokenStates.follow stands in the loop: it is most of the work
        last = [-1] * (TRIE_SYMBOLS + 1)
        moves, move, at, found = self.automaton.moves, self.automaton.move, self.inner.at, self.inner.found
        known, base, stable = self.states.pairs, self.states.base, self.states.stable
        todo = [(0, 0, trie)]
        push, pull = todo.append, todo.pop
        while todo:
            depth, state, node = pull()
            if "" in node:
                out[node.pop("")] = self._finish(depth, state, last)
                if not node:
                    continue
            if depth:
                for n, token in found.get(state) or at(state):
                    prev = last[depth - n]
                    if prev >= 0:
                        key = prev * base + token
                        ok = known.get(key)
                        if not (stable(key) if ok is None else ok):
                            continue
                    last[depth] = token
                    break
            step = moves[state]
            depth += 1
            for c, inner in node.items():
                to = step.get(c)
                push((depth, move(state, c) if to is None else to, inner))
        return out

    def _branch(self, word: str, out: dict[str, Coded]) -> None:
        """A very long word: a trie of one branch, walked symbol by symbol."""
        last, state = [-1], 0
        for depth, c in enumerate(word, 1):
            to = self.automaton.moves[state].get(c)
            state = self.automaton.move(state, c) if to is None else to
            last.append(next(t for n, t in self.inner.at(state) if self.states.follow(last[depth - n], t)))
        out[word] = self._finish(len(word), state, last)

    def _finish(self, end: int, state: int, last: list[int]) -> Coded:
        """The last step of a word, with the end mark, then back along the states."""
        known, base, stable, packed, length = (self.states.pairs, self.states.base, self.states.stable, self.packed,
                                               self.length)
        for n, token in self.final.found.get(state) or self.final.at(state):
            prev = last[end - n]
            if prev >= 0:
                key = prev * base + token
                ok = known.get(key)
                if not (stable(key) if ok is None else ok):
                    continue
            break
        out = [token]
        end -= length[token]
        while end > 0:
            token = last[end]
            out.append(token)
            end -= length[token]
        out.reverse()
        return b"".join([packed[t] for t in out]), b"".join([self.spaced[t] for t in out])

    def _parts(self, chunk: str) -> list[str]:
        """Words (byte alphabet) of one chunk; special tokens are words whose
        ids are known beforehand."""
        if PLAIN_CHUNK.fullmatch(chunk) and not (self.cut and "<" in chunk and self.cut.search(chunk)):
            low = chunk.lower()
            return PLAIN_WORDS.findall(low) if low.isascii() else \
                [w.translate(self.bytes) for w in PLAIN_WORDS.findall(low)]
        out: list[str] = []
        for piece in (self.cut.split(chunk) if self.cut else [chunk]):
            if piece in self.special:
                out.append(" " + piece)  # no word has a blank
            elif piece:
                out.extend(w for w, _ in self.words.pre_tokenize_str(self.normal.normalize_str(piece)))
        return out

    def learn(self, chunks: list[str]) -> dict[str, Coded]:
        """The codes of distinct chunks; only words not met lately are walked."""
        parts = {c: self._parts(c) for c in chunks}
        young, get, marks = self.coded.young, self.coded.get, self.marks
        coded = {w: young.get(w) or marks.get(w) or get(w) for w in set().union(*parts.values())}
        fresh = self.walk({w for w, v in coded.items() if v is None})
        coded |= fresh
        self.coded.put_all({w: v for w, v in fresh.items() if len(w) <= MEMO_CHARS})
        out = {}
        for c, p in parts.items():
            if len(p) == 1:
                out[c] = coded[p[0]]
            else:
                found = [coded[w] for w in p]
                out[c] = b"".join([i for i, _ in found]), b"".join([d for _, d in found])
        return out

    def texts(self, texts: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """Of each text its ids as little-endian uint32 and its decoded text in
        UTF-8 (the model has no decoder, so the library joins the tokens' texts
        with one blank): both are joins of what its chunks give."""
        split = [CHUNKS.split(t) for t in texts]
        young, get = self.memo.young, self.memo.get
        known = {c: get(c) for c in set().union(*split) if c not in young}
        fresh = self.learn([c for c, v in known.items() if v is None])
        known |= fresh
        self.memo.put_all({c: v for c, v in fresh.items() if len(c) <= MEMO_CHARS})
        near = young.get
        for s in split:
            found = [near(c) or known[c] for c in s]
            yield b"".join([i for i, _ in found]), b"".join([d for _, d in found])[1:]

    def decode(self, ids: bytes) -> bytes:
        """The decoded text in UTF-8: the model has no decoder, so the library
        joins the tokens' texts with one blank."""
        text = self.text
        return b" ".join([text[i] for i in memoryview(ids).cast("I")]) if ids else b""


@lru_cache(maxsize=2)
def load(path: str | None) -> TrieCodec:
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(MODEL)
    return TrieCodec(path)


def shares(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """A batch in slices of about SHARED_CHARS characters, with their texts."""
    texts = [t or "" for t in batch.column("text").to_pylist()]
    lo = size = 0
    for hi, t in enumerate(texts, 1):
        size += len(t)
        if size >= SHARED_CHARS or hi == len(texts):
            yield batch.slice(lo, hi - lo), texts[lo:hi]
            lo, size = hi, 0


def encode_decode(docs: DataFrame, model_path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256, and with
    ``keep_ids`` also ids (array<int>) and decoded (string).

    A null text counts as empty: no ids, the hash of nothing. Null ids,
    repeated rows, other columns and empty tables pass through as they are.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load(model_path)
        gc.disable()  # tries and memos are many small objects without cycles
        for b in batches:
            for part, texts in shares(b):
                done = list(codec.texts(texts))
                cols = [part.column("doc_id"),
                        pa.array([len(i) // 4 for i, _ in done], pa.int64()),
                        pa.array([hashlib.sha256(i).hexdigest() for i, _ in done], pa.string()),
                        pa.array([hashlib.sha256(d).hexdigest() for _, d in done], pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    cols += [pa.array([memoryview(i).cast("I").tolist() if i else [] for i, _ in done],
                                      pa.list_(pa.int32())),
                             pa.array([d.decode() for _, d in done], pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(cols, names)

    schema = (f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, "
              "decoded_sha256 string")
    if keep_ids:
        schema += ", ids array<int>, decoded string"
    return map_batches(docs.select("doc_id", "text"), run, schema)
