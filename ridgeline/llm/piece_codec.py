"""Operator 12: SentencePiece encoding and decoding with an agenda.

The symbols of a unit are merged from an agenda (a heap) of adjacent pairs
ordered by the score of the piece they form, ties leftmost first; a pair is
skipped when one of its symbols has changed since it was put on the agenda.
Symbols that stay outside the vocabulary are written as bytes.

No piece of the model crosses from a non-blank into a blank or touches a line
feed (checked when the model is loaded), so a text falls into independent
units. Every unit that is new to a task is checked against the sentencepiece
library, all new units of an Arrow batch at once; a difference fails the job.
"""

from __future__ import annotations

import gc
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame

from ridgeline.llm.bpe import Memo
from ridgeline.llm.common import map_batches

MODEL = "piece_bpe_32k.model"
BLANK = "▁"  # how the model writes a space
UNITS = re.compile(f"\n|{BLANK}*[^{BLANK}\n]+|{BLANK}+")
UNIT_MEMO = 900_000  # entries of about 250 bytes, two generations
UNIT_MEMO_CHARS = 63
UNKNOWN = " ⁇ "  # how the library decodes the id of unknown pieces


class PieceCodec:
    """Encodes and decodes as the sentencepiece library does for a merge-type
    model with byte fallback, identity normalisation and a blank in front."""

    def __init__(self, path: str):
        import sentencepiece
        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(sp.get_piece_size())
        if any(sp.is_unused(i) for i in every):
            raise ValueError("a model with unused pieces is not supported")
        self.byte = {int(sp.id_to_piece(i)[3:5], 16): i for i in every if sp.is_byte(i)}
        if len(self.byte) != 256:
            raise ValueError("a model without byte fallback is not supported")
        normal = [i for i in every if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        self.id = {sp.id_to_piece(i): i for i in normal}
        if any(BLANK in p.lstrip(BLANK) or "\n" in p for p in self.id):
            raise ValueError("a piece of this model crosses a word border; units would not be independent")
        # a smaller cost is merged first
        self.cost = {p: -sp.get_score(i) for p, i in self.id.items() if len(p) > 1}
        self.end = sp.eos_id()
        self.text = {i: p.replace(BLANK, " ") for p, i in self.id.items()} | {sp.unk_id(): UNKNOWN}
        self.value = {i: b for b, i in self.byte.items()}
        self.written = [f" {i}" for i in every]
        self.memo = Memo(UNIT_MEMO)
        # what the library puts before a unit that follows a line feed
        self.before = sp.encode("\n")

    def merged(self, unit: str) -> list[str]:
        """The symbols of a unit after all merges."""
        n, cost = len(unit), self.cost.get
        agenda = [(c, i, 2) for i in range(n - 1) if (c := cost(unit[i:i + 2])) is not None]
        symbol = list(unit)
        if not agenda:
            return symbol
        heapify(agenda)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        while agenda:
            _, i, size = heappop(agenda)
            j = right[i]
            a = symbol[i]
            if not a or j >= n or len(a) + len(symbol[j]) != size:
                continue  # one of the two has been merged since
            a = symbol[i] = a + symbol[j]
            symbol[j] = ""
            j = right[i] = right[j]
            if j < n:
                left[j] = i
                both = a + symbol[j]
                c = cost(both)
                if c is not None:
                    heappush(agenda, (c, i, len(both)))
            j = left[i]
            if j >= 0:
                both = symbol[j] + a
                c = cost(both)
                if c is not None:
                    heappush(agenda, (c, j, len(both)))
        return [s for s in symbol if s]

    def unit_ids(self, unit: str) -> list[int]:
        symbols, get = self.merged(unit), self.id.get
        ids = [get(s) for s in symbols]
        if None not in ids:
            return ids
        out: list[int] = []
        for s, i in zip(symbols, ids):
            if i is None:
                out.extend([self.byte[b] for b in s.encode()])
            else:
                out.append(i)
        return out

    def joined(self, ids: list[int]) -> str:
        """The text of ids, the blank in front included. A run of byte pieces
        is read as UTF-8, a byte that fits no character as U+FFFD."""
        get = self.text.get
        out = [get(i) for i in ids]
        if None not in out:
            return "".join(out)
        out, run = [], bytearray()
        for i in ids:
            b = self.value.get(i)
            if b is not None:
                run.append(b)
                continue
            if run:
                out.append(read_bytes(bytes(run)))
                run.clear()
            out.append(self.text.get(i, ""))  # control pieces have no text
        if run:
            out.append(read_bytes(bytes(run)))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """Any ids as text, as the library's decode gives it: the blank that
        the first piece with text begins with goes."""
        first = next((i for i in ids if i in self.text or i in self.value), None)
        text = self.joined(ids)
        return text[1:] if first in self.text and first != self.library.unk_id() and text[:1] == " " else text

    def learn(self, units: list[str], check: bool) -> dict[str, tuple[str, str]]:
        """Of distinct new units: their ids, each after a blank, and their
        decoded text."""
        ids = [self.unit_ids(u) for u in units]
        if check and units:
            n = len(self.before)
            for u, own, other in zip(units, ids, self.library.encode(["\n" + u for u in units], num_threads=1)):
                if own != other[n:] or other[:n] != self.before:
                    raise AssertionError(f"ids of {u[:80]!r} are not those of the library")
        out, written = {}, self.written
        for u, own in zip(units, ids):
            out[u] = "".join([written[i] for i in own]), self.joined(own)
        self.memo.put_all({u: v for u, v in out.items() if len(u) <= UNIT_MEMO_CHARS})
        return out

    def texts(self, texts: list[str], check: bool = True) -> Iterator[tuple[str, str]]:
        """Per text its ids with the end id, written decimal with one blank
        between two, and the decoded text."""
        split = [UNITS.findall(BLANK + t.replace(" ", BLANK)) if t else [] for t in texts]
        young, known = self.memo.young, {}
        for u in set().union(*split):
            if u not in young:
                known[u] = self.memo.get(u)
        known |= self.learn([u for u, v in known.items() if v is None], check)
        get = young.get
        for units in split:
            found = [get(u) or known[u] for u in units]
            ids = "".join([f[0] for f in found])
            yield f"{ids} {self.end}"[1:], "".join([f[1] for f in found])[1:]


def read_bytes(run: bytes) -> str:
    """UTF-8 with one U+FFFD for each byte that belongs to no character."""
    try:
        return run.decode()
    except UnicodeDecodeError as e:
        return run[:e.start].decode() + "�" + read_bytes(run[e.start + 1:])


@lru_cache(maxsize=2)
def load(path: str | None) -> PieceCodec:
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(MODEL)
    return PieceCodec(path)


# Texts of about this many characters are split together, so that the units
# of a batch are held once and their lists stay small.
SHARED_CHARS = 1 << 20


def shares(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    texts = [t or "" for t in batch.column("text").to_pylist()]
    lo = size = 0
    for hi, t in enumerate(texts, 1):
        size += len(t)
        if size >= SHARED_CHARS or hi == len(texts):
            yield batch.slice(lo, hi - lo), texts[lo:hi]
            lo, size = hi, 0


def encode_decode(docs: DataFrame, model_path: str | None = None, check: bool = True,
                  keep_ids: bool = False) -> DataFrame:
    """Per document: doc_id, n_tokens (the end id included), ids_sha256,
    decoded_sha256, and with ``keep_ids`` also ids (array<int>) and decoded.

    ``check`` holds every unit that is new to a task against the library.
    A null or empty text has the end id only and decodes to the empty text.
    Null ids, repeated rows and empty tables pass through as they are, other
    columns are ignored; texts are processed whole, whatever their length.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load(model_path)
        gc.disable()  # units and memos are many small objects without cycles
        for b in batches:
            for part, texts in shares(b):
                done = list(codec.texts(texts, check))
                cols = [part.column("doc_id"),
                        pa.array([i.count(" ") + 1 for i, _ in done], pa.int64()),
                        pa.array([hashlib.sha256(i.encode()).hexdigest() for i, _ in done], pa.string()),
                        pa.array([hashlib.sha256(d.encode()).hexdigest() for _, d in done], pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    cols += [pa.array([[int(x) for x in i.split(" ")] for i, _ in done], pa.list_(pa.int32())),
                             pa.array([d for _, d in done], pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(cols, names)

    schema = (f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, "
              "decoded_sha256 string")
    if keep_ids:
        schema += ", ids array<int>, decoded string"
    return map_batches(docs.select("doc_id", "text"), run, schema)
