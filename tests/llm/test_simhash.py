"""SimHash near-dedup against brute force."""

import random

import numpy as np
import xxhash

from dockpulse.llm import components, simhash_dedup
from tests.llm.rows import documents, edge_rows, random_texts


def fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    size = min(3, len(words))
    shingles = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]
    ones = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def roots(count, links):
    parent = list(range(count))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    return [find(i) for i in range(count)]


def brute(rows):
    prints = [fingerprint(t) for _, t in rows]
    n = len(rows)
    root = roots(n, [(i, j) for i in range(n) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3])
    least = {}
    for (doc, _), r in zip(rows, root, strict=True):
        if doc is not None:
            least[r] = min(least.get(r, doc), doc)
    return sorted(((d, p - (1 << 64) if p >> 63 else p, least.get(r)) for (d, _), p, r in zip(rows, prints, root, strict=True)), key=str)


def result(df):
    return sorted(map(tuple, df.collect()), key=str)


def near_texts():
    draw = random.Random(4)
    texts = random_texts(5, 60, 200)
    base = " ".join(f"w{draw.randint(0, 500)}" for _ in range(400)).split()
    for _ in range(60):
        copy = list(base)
        for _ in range(draw.randint(0, 3)):
            copy[draw.randrange(len(copy))] = f"v{draw.randint(0, 9)}"
        texts.append(" ".join(copy))
    return texts


def test_edge_rows(spark):
    texts, ids = edge_rows()
    assert result(simhash_dedup.classes(documents(spark, texts, ids))) == brute(list(zip(ids, texts, strict=True)))


def test_near_copies(spark, monkeypatch):
    texts = near_texts()
    ids = random.Random(2).sample(range(500), len(texts))
    want = brute(list(zip(ids, texts, strict=True)))
    assert result(simhash_dedup.classes(documents(spark, texts, ids))) == want
    monkeypatch.setattr(simhash_dedup, "BUCKET_LIMIT", 2)
    assert result(simhash_dedup.classes(documents(spark, texts, ids))) == want


def test_empty_table(spark):
    assert simhash_dedup.classes(documents(spark, [])).collect() == []
    assert simhash_dedup.keep_one(documents(spark, [])).collect() == []


def test_keep_one_keeps_columns_and_one_row_of_each_group(spark):
    texts, ids = edge_rows()
    docs = documents(spark, texts, ids)
    kept = simhash_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    components = {c for d, _, c in brute(list(zip(ids, texts, strict=True))) if d is not None}
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(components)
    assert kept.where("doc_id is null").count() == 2


def test_keys_hold_every_pair_within_three_bits():
    draw = random.Random(9)
    for masks, base in ((simhash_dedup.FIRST_MASKS, 0), (simhash_dedup.SECOND_MASKS[7], simhash_dedup.FIRST_MASKS[7])):
        free = [b for b in range(64) if not base >> b & 1]
        for _ in range(2000):
            different = sum(1 << b for b in draw.sample(free, 3))
            assert any(different & (m % (1 << 64)) == 0 for m in masks)


def test_second_ring_leaves_eighteen_bits_open():
    for first, second in zip(simhash_dedup.FIRST_MASKS, simhash_dedup.SECOND_MASKS, strict=True):
        assert all((~(first | m) % (1 << 64)).bit_count() <= 18 for m in second)


def test_ring_never_loses_a_link():
    draw = np.random.default_rng(1)
    a = draw.integers(-(1 << 62), 1 << 62, 3000)
    flips = np.array([sum(1 << int(b) for b in draw.choice(63, 3, replace=False)) for _ in range(3000)])
    assert simhash_dedup.linked(a, a ^ flips).all()
    assert not simhash_dedup.linked(a, a ^ flips ^ np.int64(0b1111 << 40)).all()


def test_components_of_chains_stars_and_cycles(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (5, 5)]
    found = {r.node: r.component for r in components.connected(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {i: 200 for i in range(200, 203)}
    assert found == want
