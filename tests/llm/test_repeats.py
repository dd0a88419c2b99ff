"""Substring and suffix-array dedup against brute force."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dockpulse.llm import repeats, substring_dedup, suffix_dedup
from tests.llm.rows import documents, edge_rows, random_texts


def brute(rows, unit, k):
    split = (lambda t: t.encode().split()) if unit == "words" else (lambda t: [bytes([b]) for b in t.encode()])
    units = [split(t or "") for _, t in rows]
    first = {}
    for (doc, _), u in zip(rows, units, strict=True):
        if doc is not None:
            for i in range(len(u) - k + 1):
                key = tuple(u[i : i + k])
                first[key] = min(first.get(key, doc), doc)
    out = []
    for (doc, _), u in zip(rows, units, strict=True):
        gone = [False] * len(u)
        for i in range(len(u) - k + 1) if doc is not None else ():
            if first[tuple(u[i : i + k])] < doc:
                gone[i : i + k] = [True] * k
        kept = (b" " if unit == "words" else b"").join(x for x, g in zip(u, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc, kept, len(u), sum(gone), spans))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, bytes(r.kept), r.n_units, r.n_removed, r.n_spans) for r in df.collect()), key=str)


CASES = [("words", substring_dedup.remove_repeats, 13), ("bytes", suffix_dedup.remove_repeats, 50)]


@pytest.mark.parametrize("unit, operator, k", CASES)
def test_edge_rows(spark, unit, operator, k):
    texts, ids = edge_rows()
    assert result(operator(documents(spark, texts, ids))) == brute(list(zip(ids, texts, strict=True)), unit, k)


@pytest.mark.parametrize("unit, operator, k", CASES)
def test_empty_table(spark, unit, operator, k):
    assert operator(documents(spark, [])).collect() == []


@pytest.mark.parametrize("unit, operator, k", CASES)
@pytest.mark.parametrize("hot, block", [(1000, 2 << 20), (2, 2000)])
def test_random_texts(spark, monkeypatch, unit, operator, k, hot, block):
    """Also with tiny blocks and anchors that all count as hot."""
    monkeypatch.setattr(repeats, "HOT_RUNS", hot)
    monkeypatch.setattr(repeats, "BLOCK_BYTES", block)
    texts = random_texts(3, 120)
    ids = random.Random(1).sample(range(1000), len(texts))
    assert result(operator(documents(spark, texts, ids))) == brute(list(zip(ids, texts, strict=True)), unit, k)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=12), max_size=4), st.lists(st.integers(0, 2), max_size=12))
def test_matching_statistics(texts, query):
    automaton = substring_dedup.SuffixAutomaton()
    for text in texts:
        automaton.add(text)
    known = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    want = [max((n for n in range(i + 2) if n == 0 or tuple(query[i + 1 - n : i + 1]) in known)) for i in range(len(query))]
    assert automaton.matches(query) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=60), st.integers(1, 40))
def test_bucket_pointers_sort_like_strings(letters, k):
    text = np.array(letters, np.uint8) + 97
    ids = suffix_dedup.refined_buckets(text, k)
    strings = [bytes(text[i : i + k]) for i in range(len(text))]
    for i in range(len(text)):
        for j in range(len(text)):
            assert (ids[i] < ids[j]) == (strings[i] < strings[j])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=1, max_size=40), st.integers(1, 40))
def test_sliding_min(values, width):
    width = min(width, len(values))
    want = [min(values[i : i + width]) for i in range(len(values) - width + 1)]
    assert repeats.sliding_min(np.array(values), width).tolist() == want
