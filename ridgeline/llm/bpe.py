"""Last-token states of byte-pair encodings.

A sequence of tokens is the encoding of its own text exactly when every
adjacent pair of tokens is the encoding of the pair's text: merges inside two
neighbours run in the same order alone and in context until one crosses their
border. So the encoding of a prefix is known from the last token of that
prefix and the states of shorter prefixes: the token ``t`` that ends at ``i``
is the right one when (last token at ``i - len(t)``, ``t``) is a stable pair,
and only one token passes.
"""

from __future__ import annotations

from collections.abc import Callable

PAIR_LIMIT = 1 << 20


class TokenStates:
    """``rank(a, b)`` gives the priority of merging two neighbouring tokens
    (lower merges first, ties leftmost first), None when they never merge.
    ``symbols(token)`` are the smallest units of a token. States are numbers:
    positions in ``names``, which holds the tokens that encode themselves."""

    def __init__(self, tokens: list[str], rank: Callable[[str, str], float | None],
                 symbols: Callable[[str], list[str]]):
        self.rank, self.symbols = rank, symbols
        self.names = [t for t in tokens if self.merge(symbols(t)) == [t]]
        self.base = len(self.names)
        self.pairs: dict[int, bool] = {}

    def merge(self, parts: list[str]) -> list[str]:
        """Plain greedy merging, used on tokens and pairs of tokens only."""
        parts = list(parts)
        ranks = [self.rank(a, b) for a, b in zip(parts, parts[1:])]
        while True:
            best = min((r for r in ranks if r is not None), default=None)
            if best is None:
                return parts
            i = ranks.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = self.rank(parts[i], parts[i + 1])
            if i:
                ranks[i - 1] = self.rank(parts[i - 1], parts[i])

    def stable(self, key: int) -> bool:
        """Whether the text of the pair ``a * base + b`` is encoded as (a, b)."""
        a, b = self.names[key // self.base], self.names[key % self.base]
        if len(self.pairs) >= PAIR_LIMIT:
            self.pairs.clear()
        ok = self.pairs[key] = self.merge(self.symbols(a) + self.symbols(b)) == [a, b]
        return ok

    def follow(self, prev: int, token: int) -> bool:
        """Whether ``token`` may stand after the state ``prev`` (-1: nothing before it)."""
        if prev < 0:
            return True
        key = prev * self.base + token
        ok = self.pairs.get(key)
        return self.stable(key) if ok is None else ok


class Suffixes:
    """The automaton that gives, after each symbol, the tokens that end there:
    its state is the longest end of the text that begins some token.
    ``moves[state]`` maps a symbol to the next state and is filled as needed."""

    def __init__(self, texts):
        self.begins = {""} | {t[:n] for t in texts for n in range(1, len(t) + 1)}
        self.state, self.text = {"": 0}, [""]
        self.moves: list[dict[str, int]] = [{}]

    def move(self, state: int, symbol: str) -> int:
        text = self.text[state] + symbol
        while text not in self.begins:
            text = text[1:]
        to = self.state.get(text)
        if to is None:
            to = self.state[text] = len(self.text)
            self.text.append(text)
            self.moves.append({})
        self.moves[state][symbol] = to
        return to


class Ends:
    """Per automaton state the (length, token state) of the tokens that end
    there, longest first; ``tokens`` maps a token's text to its state."""

    def __init__(self, automaton: Suffixes, tokens: dict[str, int]):
        self.automaton, self.tokens, self.found = automaton, tokens, {}

    def at(self, state: int) -> list[tuple[int, int]]:
        out = self.found.get(state)
        if out is None:
            text, get = self.automaton.text[state], self.tokens.get
            out = self.found[state] = [(len(text) - i, t) for i in range(len(text))
                                       if (t := get(text[i:])) is not None]
        return out


class Memo:
    """A bounded memo of two generations: entries in use move to the young
    one, and what was not used for a whole generation goes."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def get(self, key):
        value = self.young.get(key)
        if value is None:
            value = self.old.get(key)
            if value is not None:
                self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value

    def put_all(self, entries: dict) -> None:
        """The entries of one step; the young generation may exceed its size
        by them."""
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young.update(entries)
