"""Substring dedup: suffix automata of reference shards, documents streamed through them for matching statistics."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from dockpulse.llm.repeats import covered, in_blocks, without_covered

MIN_WORDS = 13
ANCHOR_WORDS = 6


class SuffixAutomaton:
    """Generalised suffix automaton over word sequences, extended one text at a time."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, edges: dict, link: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, state: int, token: object, target: int) -> int:
        """The target itself if it is one longer than the state, else a shorter copy of it."""
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._state(self.length[state] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = copy
        while state >= 0 and self.next[state].get(token) == target:
            self.next[state][token] = copy
            state = self.link[state]
        return copy

    def add(self, tokens: list) -> None:
        last = 0
        for token in tokens:
            target = self.next[last].get(token)
            if target is not None:
                last = self._split(last, token, target)
                continue
            new, state = self._state(self.length[last] + 1, {}, 0), last
            while state >= 0 and token not in self.next[state]:
                self.next[state][token] = new
                state = self.link[state]
            if state >= 0:
                self.link[new] = self._split(state, token, self.next[state][token])
            last = new

    def matches(self, tokens: list) -> list[int]:
        """Matching statistics: at each place, the length of the longest known sequence that ends there."""
        state, length, out = 0, 0, []
        for token in tokens:
            while state and token not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            target = self.next[state].get(token)
            if target is not None:
                state, length = target, length + 1
            out.append(length)
        return out


def earlier_windows(group: list[tuple[int, bytes]], k: int) -> list[np.ndarray]:
    """For each (document, words) of a shard, sorted by document: window starts that a smaller document holds."""
    automaton, out, pending, current = SuffixAutomaton(), [], [], None
    for doc, text in group:
        tokens = text.split(b" ")
        if doc != current:
            for words in pending:
                automaton.add(words)
            pending, current = [], doc
        ends = np.flatnonzero(np.array(automaton.matches(tokens)) >= k)
        out.append(ends - k + 1)
        pending.append(tokens)
    return out


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS, anchor_words: int = ANCHOR_WORDS) -> DataFrame:
    """Remove each word covered by ``min_words`` words that also stand in a document with a smaller id.

    Needs columns ``doc_id`` and ``text``; others are left out.  Returns (doc_id, kept, n_units, n_removed, n_spans),
    one row for each input row: ``kept`` holds the words left, joined by one space, as bytes.

    The reference of a document is every document before it, which no broadcast can hold.  So the automata are sharded by
    content: a shard holds the passages under one anchor, and exactly those stretches of documents that could match
    in it are streamed through it (see ``repeats``).  All windows are judged on the input.

    A null text has no words.  A row with a null id is neither judged nor used as a reference.  Rows with equal
    ids are not older than one another, so repeated rows come out alike.  Texts shorter than a window stay whole.
    """

    def solve(groups: list[list[tuple[int, bytes]]]) -> list[list[np.ndarray]]:
        return [earlier_windows(group, min_words) for group in groups]

    blocks = in_blocks(docs)
    spans = covered(blocks, "words", min_words, min(anchor_words, min_words), solve)
    return without_covered(blocks, spans, "words", min_words)
