"""Operator 2: token counts by prefix dynamic programming.

For every prefix of a text the state is (last token, number of tokens); the
state at ``i`` follows from the states before it (``bpe.TokenStates``). With
the counts of all prefixes stored, "how many tokens has the first n
characters" and "how much fits in a budget" need no further encoding.

No token of the model crosses from a non-blank into a blank or touches a line
feed, so a text falls into independent units; the prefix counts of a unit are
computed once per task and reused (the memo is bounded).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from ridgeline.llm.bpe import Ends, Memo, Suffixes, TokenStates
from ridgeline.llm.common import map_batches

BLANK = "▁"  # how the model writes a space
MODEL = "piece_bpe_32k.model"
UNIT_MEMO = 500_000  # entries of about 200 bytes, two generations
UNIT_MEMO_CHARS = 63


class PrefixCounter:
    """Exact token counts of every prefix under a BPE piece model with byte
    fallback, identity normalisation and a dummy blank in front."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(sp.get_piece_size())
               if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        score = {sp.id_to_piece(i): -sp.get_score(i) for i in ids}
        if any(BLANK in p.lstrip(BLANK) or ("\n" in p) for p in score):
            raise ValueError("a token of this model crosses a word border; units would not be independent")
        self.states = TokenStates(list(score), lambda a, b: score.get(a + b), list)
        names = {t: i for i, t in enumerate(self.states.names)}
        self.automaton = Suffixes(names)
        self.ends = Ends(self.automaton, names)
        self.memo = Memo(UNIT_MEMO)

    def unit(self, text: str) -> list[int]:
        """Token counts of the prefixes of one unit, lengths 0 to len(text)."""
        moves, move, ends = self.automaton.moves, self.automaton.move, self.ends.at
        follow = self.states.follow
        last, counts, state = [-1], [0], 0
        for end, symbol in enumerate(text, 1):
            to = moves[state].get(symbol)
            state = move(state, symbol) if to is None else to
            for n, token in ends(state):
                if follow(last[end - n], token):
                    last.append(token)
                    counts.append(counts[end - n] + 1)
                    break
            else:  # a character outside the model: its bytes, and merges end here
                last.append(-1)
                counts.append(counts[-1] + len(symbol.encode()))
        return counts

    def counts(self, unit: str) -> list[int] | bytes:
        found = self.memo.get(unit)
        if found is None:
            found = self.unit(unit)
            if len(unit) <= UNIT_MEMO_CHARS:
                found = bytes(found)  # at most 4 tokens a character, so below 256 up to 63 characters
                self.memo.put(unit, found)
        return found

    _units = re.compile(f"\n|{BLANK}*[^{BLANK}\n]+|{BLANK}+")

    def units(self, text: str) -> list[str]:
        return self._units.findall(BLANK + text.replace(" ", BLANK)) if text else []

    def prefixes(self, text: str) -> list[int]:
        """Token counts of text[:0], text[:1], ..., text. The dummy blank in
        front is no character of the text; the empty prefix has no token."""
        out, total = [], 0
        for unit in self.units(text):
            counts = self.counts(unit)
            out.extend([total + c for c in counts[1:]])
            total += counts[-1]
        return [0] + out[1:]

    def total_and_cut(self, text: str, limit: int) -> tuple[int, int]:
        """Tokens of the text, and the length of its longest prefix of at most
        ``limit`` tokens (all of it when it fits)."""
        units = self.units(text)
        young, counts = self.memo.young, self.counts
        sizes = [(young.get(u) or counts(u))[-1] for u in units]
        total = sum(sizes)
        if total <= limit:
            return total, len(text)
        end, at = total, len(text) + 1  # positions count the dummy blank
        for unit, size in zip(reversed(units), reversed(sizes)):
            end -= size
            at -= len(unit)
            if end <= limit:
                fit = max(i for i, c in enumerate(self.counts(unit)) if end + c <= limit)
                return total, max(0, at + fit - 1)
        return total, 0


@lru_cache(maxsize=2)
def load(path: str | None) -> PrefixCounter:
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(MODEL)
    return PrefixCounter(path)


def token_counts(docs: DataFrame, limit: int = 4096, model_path: str | None = None) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit, fit_chars (the
    longest prefix, in code points, of at most ``limit`` tokens).

    A null text counts as empty (0 bytes, 0 tokens); null ids pass through;
    repeated rows give repeated results; other columns are ignored; an empty
    table gives an empty result. Texts are processed whole.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = load(model_path)
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            found = [counter.total_and_cut(t, limit) for t in texts]
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"),
                pa.array([len(t.encode()) for t in texts], pa.int64()),
                pa.array([n for n, _ in found], pa.int64()),
                pa.array([n > limit for n, _ in found], pa.bool_()),
                pa.array([c for _, c in found], pa.int64()),
            ], ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"])

    return map_batches(docs.select("doc_id", "text"), run,
                       f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long, "
                       "over_limit boolean, fit_chars long")


def prefix_token_counts(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """Per document: doc_id and prefix_tokens, the token count of every prefix
    by length in code points (index 0: the empty prefix). Same edge cases as
    ``token_counts``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = load(model_path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"),
                pa.array([counter.prefixes(t or "") for t in b.column("text").to_pylist()], pa.list_(pa.int32())),
            ], ["doc_id", "prefix_tokens"])

    return map_batches(docs.select("doc_id", "text"), run,
                       f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, prefix_tokens array<int>")
