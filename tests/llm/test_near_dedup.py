"""Near-dedup by similarity against brute force over all pairs."""

import random

import pyarrow as pa

import corpus_pipeline
from dockpulse.llm import near_dedup
from tests.llm.rows import documents, edge_rows
from tests.llm.test_simhash import roots


def shingle_set(text):
    words = (text or "").encode().lower().split()
    size = min(5, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def brute(rows):
    rows = sorted({(d, t or "") for d, t in rows if d is not None})
    sets = [shingle_set(t) for _, t in rows]

    def near(a, b):
        return a == b or 5 * len(a & b) >= 4 * len(a | b)

    root = roots(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if near(sets[i], sets[j])])
    least = {}
    for (doc, _), r in zip(rows, root, strict=True):
        least[r] = min(least.get(r, doc), doc)
    return sorted(least.values())


def edited(draw, words, changes):
    out = list(words)
    for at in draw.sample(range(len(out)), changes):
        out[at] = f"new{draw.randint(0, 9999)}"
    return " ".join(out)


def near_texts():
    """Groups of copies whose similarity lies on both sides of 0.8."""
    draw, texts = random.Random(11), []
    for _ in range(40):
        base = [f"w{draw.randint(0, 4000)}" for _ in range(draw.randint(120, 400))]
        texts += [" ".join(base), edited(draw, base, len(base) // 60), edited(draw, base, len(base) // 45), edited(draw, base, len(base) // 12)]
    draw.shuffle(texts)
    return texts


def test_near_copies_beyond_three_bits(spark):
    texts = near_texts()
    ids = random.Random(3).sample(range(1000), len(texts))
    kept = corpus_pipeline.near_dedup(spark, documents(spark, texts, ids), "")
    assert sorted(r.doc_id for r in kept.collect()) == brute(list(zip(ids, texts, strict=True)))


def test_edge_rows(spark):
    texts, ids = edge_rows()
    docs = documents(spark, texts, ids)
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == brute(list(zip(ids, texts, strict=True)))
    assert kept.where("doc_id is null").count() == 2
    assert near_dedup.keep_one(documents(spark, [])).collect() == []


def test_one_id_with_two_texts(spark):
    draw = random.Random(5)
    base, other = ([f"{p}{draw.randint(0, 4000)}" for _ in range(200)] for p in "ab")
    unique = " ".join(other)
    docs = documents(spark, [" ".join(base), edited(draw, base, 3), unique], [1, 2, 2])
    assert sorted((r.doc_id, r.text) for r in near_dedup.keep_one(docs).collect()) == [(1, " ".join(base)), (2, unique)]


def framed(draw, count, share, words=200):
    """Texts that share the first ``share`` of their words and nothing else."""
    frame = [f"f{draw.randint(0, 9999)}" for _ in range(int(words * share))]
    return [" ".join(frame + [f"u{draw.randint(0, 10**9)}" for _ in range(words - len(frame))]) for _ in range(count)]


def compared(spark, monkeypatch, texts):
    """Pairs whose texts were compared."""
    counts = []

    def links(pairs, sets, own=near_dedup._links):
        counts.append(pairs.distinct().count())
        return own(pairs, sets)

    monkeypatch.setattr(near_dedup, "_links", links)
    kept = near_dedup.keep_one(documents(spark, texts)).count()
    return kept, sum(counts)


def test_common_frames_make_no_pairs(spark, monkeypatch):
    """Texts below 0.8 that share most of their words: comparisons grow with the texts, not with their pairs."""
    pairs = {}
    for count in (150, 300):
        kept, pairs[count] = compared(spark, monkeypatch, framed(random.Random(2), count, 0.8))
        monkeypatch.undo()
        assert kept == count
    assert pairs[300] <= 2.2 * pairs[150]


def test_crowded_lists_are_dealt_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "LIST_TEXTS", 3)
    draw = random.Random(12)
    base = [f"w{draw.randint(0, 4000)}" for _ in range(150)]
    texts = [edited(draw, base, n) for n in (0, 1, 2, 3, 4, 5, 6, 8, 10) for _ in range(4)] + near_texts()[:40]
    kept = near_dedup.keep_one(documents(spark, texts))
    assert sorted(r.doc_id for r in kept.collect()) == brute(list(enumerate(texts)))


def test_simhash_ring_proposes_near_copies(spark, monkeypatch):
    """Copies within three bits are found by SimHash and the pigeonring, without any band; the texts still decide."""

    def alone(batches, own=near_dedup._signatures):
        for at, batch in enumerate(own(batches)):
            keys = {k: pa.array([hash((k, at, i, batch.column("doc_id")[i].as_py())) for i in range(batch.num_rows)], pa.int64()) for k in near_dedup.KEYS}
            yield pa.record_batch({c: batch.column(c) for c in ("doc_id", "digest", "size", "fp")} | keys)

    monkeypatch.setattr(near_dedup, "_signatures", alone)
    draw, texts = random.Random(21), []
    for _ in range(10):
        base = [f"w{draw.randint(0, 10**6)}" for _ in range(5000)]
        texts += [" ".join(base), " ".join([*base, "end"]), edited(draw, base, 1500)]
    texts += ["a b c d e f", "A  b c d e f", "", " "]
    kept = near_dedup.keep_one(documents(spark, texts))
    assert sorted(r.doc_id for r in kept.collect()) == brute(list(enumerate(texts)))
