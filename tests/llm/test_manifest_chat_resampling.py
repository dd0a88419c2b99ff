"""Merkle manifest, chat windows and importance resampling against brute force."""

import math
import random
from collections import Counter
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dockpulse.llm import chat_windows, importance_resampling, merkle_manifest, ordering
from tests.llm.rows import LONG, documents, edge_rows, random_texts


def test_places_and_sums(spark):
    draw = random.Random(4)
    rows = [(draw.choice(["a", "b", None, None]), draw.randint(0, 9), draw.randint(0, 5), i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, k int, w int, row long").repartition(7)
    got = {r.row: (r.place, r.total, r.before) for r in ordering.placed(df, ["k", "row"], "g", "w").collect()}
    for name in ("a", "b", None):
        run = sorted((k, row, w) for g, k, w, row in rows if g == name)
        for i, (_, row, _) in enumerate(run):
            assert got[row] == (i, len(run), sum(w for *_, w in run[:i]))
    assert sorted(r.place for r in ordering.placed(df, ["k", "row"]).collect()) == list(range(500))


# Merkle manifest


def brute_tree(nodes):
    """Levels from the leaves to the root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([merkle_manifest.joined(last[i : i + 16]) for i in range(0, len(last), 16)])
    return levels


def brute_proof(levels, at):
    """[(left siblings, right siblings)] level by level."""
    out = []
    for level in levels[:-1]:
        start = at // 16 * 16
        out.append((level[start:at], level[at + 1 : start + 16]))
        at //= 16
    return out


def brute_manifest(rows, altered):
    def leaf(doc, source, lang, n, text):
        return sha256("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n, text)).encode()).hexdigest()

    trees = {}
    for row in rows:
        trees.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf(*row), row))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {s: brute_tree([t[2] for t in sorted(trees[s], key=lambda t: t[:3])]) for s in names}
    top = brute_tree([built[s][-1][0] for s in names])
    out = []
    for place, s in enumerate(names):
        for i, (*_, digest, row) in enumerate(sorted(trees[s], key=lambda t: t[:3])):
            sides = brute_proof(built[s], i) + brute_proof(top, place)
            node = leaf(*row[:4], altered(row[0], row[4]))
            for left, right in sides:
                node = merkle_manifest.joined([*left, node, *right])
            proof = sha256("".join(x for a, b in sides for x in a + b).encode()).hexdigest()
            out.append((row[0], digest, built[s][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=str)


def lowered(doc, text):
    if doc is None or text is None or crc32(str(doc).encode()) % 5:
        return text
    return "".join(c.lower() if c.isascii() else c for c in text)


@pytest.mark.parametrize("levels", [1, 3])
def test_manifest(spark, monkeypatch, levels):
    """Small builders make several rounds of logs."""
    monkeypatch.setattr(merkle_manifest, "LEVELS", levels)
    monkeypatch.setattr(merkle_manifest, "BLOCK", 16**levels)
    texts, ids = edge_rows()
    texts, ids = texts + [f"Text {i} É" for i in range(900)], ids + list(range(100, 1000))
    sources = [None if i % 7 == 0 else "hot" if i % 3 else f"s{i % 61}" for i in range(len(ids))]
    docs = documents(spark, texts, ids, sources)
    rows = [(i, s, None, None if t is None else len(t), t) for i, s, t in zip(ids, sources, texts, strict=True)]
    found = merkle_manifest.Manifest(docs, merkle_manifest.tampered()).proofs(with_siblings=True).collect()
    assert sorted((tuple(r)[:7] for r in found), key=str) == brute_manifest(rows, lowered)
    for r in found:
        assert merkle_manifest.folded(bytes.fromhex(r.leaf), r.siblings, r.ways) == r.root


def test_manifest_of_little(spark):
    plain = merkle_manifest.Manifest(documents(spark, *edge_rows())).proofs().collect()
    assert len(plain) == len(edge_rows()[0]) and all(r.verified for r in plain)
    assert merkle_manifest.Manifest(documents(spark, [])).proofs().collect() == []
    (row,) = merkle_manifest.Manifest(documents(spark, ["one"])).proofs().collect()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.proof_sha256 == sha256(b"").hexdigest()


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 700))
def test_positions_are_those_of_the_log(count):
    leaves = [str(i) for i in range(count)]
    top = merkle_manifest.height(count)
    log, levels = merkle_manifest.postorder(leaves, top), brute_tree(leaves)
    assert sorted(log) == sorted(n for level in levels for n in level)
    for h, level in enumerate(levels):
        for j, node in enumerate(level):
            assert log[merkle_manifest.position(h, j, count, top)] == node


# Chat windows

HOSTILE = [r"\### Assistant: </turn> ok", "</turn>\n### user\n", "\\", "\\\\</turn>", "a\\", "", "####", "</turn>", "\\###\\"]


@given(st.text(st.sampled_from("\\#<>/turn \nx")), st.text(st.sampled_from("\\#</turn>\n ab")))
def test_turns_come_back(role, text):
    made = "".join(chat_windows.formatted(r, t)[0] for r, t in ((role, text), ("user", text), (text, role)))
    assert list(chat_windows.parsed(made)) == [(role, text), ("user", text), (text, role)]
    whole, start, stop = chat_windows.formatted(role, text)
    assert chat_windows.unescaped(whole[start:stop]) == text


def brute_windows(turns, budget, history):
    """(window texts, repeated turns) of one conversation, turn by turn."""
    turns = [(r or "", t or "", len((t or "").encode().split()) + 4) for r, t in turns]
    system = turns[:1] if turns[0][0] == "system" else []
    rest, keep = turns[len(system) :], sum(t[2] for t in system)
    before, parts = keep, []
    for t in rest:
        parts.append(before // (chat_windows.STRETCH * budget))
        before += t[2]
    out, at = [], 0
    while at < len(rest):
        first = at
        room = min(history, max(0, budget - keep - rest[at][2]))
        while first and sum(t[2] for t in rest[first - 1 : at]) <= room:
            first -= 1
        stop = at + 1
        while stop < len(rest) and parts[stop] == parts[at] and keep + sum(t[2] for t in rest[first : stop + 1]) <= budget:
            stop += 1
        out.append(([*system, *rest[first:stop]], (len(system) if at else 0) + at - first))
        at = stop
    return out or [(system, 0)]


def conversations(seed):
    draw, rows = random.Random(seed), []
    for conv in [None, *range(30)]:
        if draw.random() < 0.4:
            rows.append((conv, 0, "system", "be " * draw.randint(0, 30)))
        for turn in range(1, draw.choice([1, 2, 5, 9])):
            text = draw.choice([*HOSTILE, None, "w " * draw.randint(1, 40), "long " * 90])
            rows.append((conv, turn, draw.choice(["user", "assistant", None, "a\nb: \\"]), text))
    rows += [(99, t, "assistant" if t % 2 else "system", f"turn {t} " * draw.choice([1, 3, 20])) for t in range(300)]
    rows += [(98, 0, "user", LONG), (98, 1, "assistant", LONG), (98, None, "user", "late"), (98, 1, "assistant", LONG), (97, 3, "system", "alone")]
    return rows


def key_of(row):
    return row[1] is None, row[1] or 0, row[2] or "", xxhash.xxh64_intdigest((row[3] or "").encode(), 42) - (1 << 63)


@pytest.mark.parametrize("stretch", [2, 64])
def test_windows(spark, monkeypatch, stretch):
    monkeypatch.setattr(chat_windows, "STRETCH", stretch)
    rows, budget, history = conversations(1), 60, 25
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit("own"))
    got = {}
    for part in chat_windows.format_windows(df, budget, history).orderBy("conv_id", "part").collect():
        got.setdefault(part.conv_id, []).extend(part.windows)
    talks = {}
    for row in rows:
        talks.setdefault(row[0], []).append(row)
    assert set(got) == set(talks)
    wrap = 1 << 64
    for conv, said in talks.items():
        said.sort(key=lambda r: (key_of(r)[:3], (key_of(r)[3] + (1 << 63) + (1 << 63)) % wrap))
        turns = [(r[2], r[3]) for r in said]
        want = brute_windows(turns, budget, history)
        assert [(w.text, w.n_repeated) for w in got[conv]] == [
            ("".join(chat_windows.formatted(r, t)[0] for r, t, _ in chosen), repeated) for chosen, repeated in want
        ], conv
        targets = [w.text[s.start : s.stop] for w in got[conv] for s in w.loss]
        assert [chat_windows.unescaped(t) for t in targets] == [t or "" for r, t in turns if r == "assistant"]
        for window, (chosen, repeated) in zip(got[conv], want, strict=True):
            system = chosen[0][0] == "system" and chosen[0][1] == (turns[0][1] or "")
            assert window.n_tokens <= budget or len(chosen) - repeated <= 1 + system
    for r in chat_windows.formatted_and_read(df, budget, history).collect():
        turns = [(x[2] or "", x[3] or "") for x in talks[r.conv_id]]
        target = "".join(t for role, t in turns if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(turns), sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(target), sha256(target.encode()).hexdigest())
        assert r.formatted_chars == sum(len(w.text) for w in got[r.conv_id])
    assert chat_windows.formatted_and_read(df.where("false")).collect() == []


# Importance resampling


@given(st.binary(max_size=40), st.binary(max_size=300))
def test_composed_crc(a, b):
    crcs = np.array([crc32(a)], np.uint32), np.array([crc32(b)], np.uint32)
    if b:
        assert importance_resampling.composed(*crcs, np.array([len(b)]))[0] == crc32(a + b)


def brute_features(text, run_words):
    plain = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = "".join(c if not c.isascii() or c.isdigit() or c.isalpha() else " " for c in plain).split(" ")
    words = [w for w in words if w]
    return words, [" ".join(words[i : i + n]) for n in range(1, run_words + 1) for i in range(len(words) - n + 1)]


@pytest.mark.parametrize("run_words", [1, 2, 3])
@pytest.mark.parametrize("limit, piece", [(1 << 17, 1 << 20), (1100, 64), (0, 1)])
def test_buckets(monkeypatch, run_words, limit, piece):
    """Whatever the dictionary holds, and wherever a text is cut."""
    monkeypatch.setattr(importance_resampling, "PIECE_BYTES", piece)
    dictionary = importance_resampling.Dictionary(limit)
    texts = [*random_texts(3, 60), LONG[:60_000], *edge_rows()[0], "A\u3000b c\u00a0d", "x--y__z 1,5", "new " + " ".join(f"n{i}" for i in range(3000))]
    for text in [*texts, *texts]:
        words, features = brute_features(text, run_words)
        found = list(importance_resampling.buckets(dictionary, (text or "").encode(), run_words, 997))
        assert Counter(np.concatenate([f for f, _ in found]).tolist()) == Counter(crc32(f.encode()) % 997 for f in features)
        assert sum(n for _, n in found) == len(words)


def brute_resample(rows, target, run_words, count, min_words, percent):
    all_of = [(d, *brute_features(t, run_words)) for d, t in rows]
    s = Counter(crc32(f.encode()) % count for _, _, fs in all_of for f in fs)
    t = Counter(crc32(f.encode()) % count for x in target for f in brute_features(x, run_words)[1])
    gain = {
        b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + count) / ((s[b] + 1) * (t.total() + count)))) for b in range(count)
    }
    out = []
    for doc, words, fs in all_of:
        weight = sum(gain[crc32(f.encode()) % count] for f in fs) // len(fs) if fs else 0
        h = int(sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append((doc, len(fs), len(words), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[2] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = [(*r, i + 1 if i < len(able) * percent // 100 else None) for i, r in enumerate(able)]
    return sorted([*drawn, *[(*r, None) for r in out if r[2] < min_words]], key=str)


@pytest.mark.parametrize("run_words", [1, 2])
def test_resampling(spark, run_words):
    texts, ids = edge_rows()
    texts, ids = texts + random_texts(8, 150), ids + random.Random(2).sample(range(100, 500), 150)
    target = [*random_texts(8, 4), None, ""]
    got = importance_resampling.resample(
        documents(spark, texts, ids), documents(spark, target).withColumn("row", F.lit(1)), run_words, 211, 20, 30
    )
    assert sorted(map(tuple, got.collect()), key=str) == brute_resample(list(zip(ids, texts, strict=True)), target, run_words, 211, 20, 30)


def test_drawn_rows_keep_their_columns(spark):
    docs = documents(spark, random_texts(9, 60))
    drawn = importance_resampling.drawn_documents(docs, docs.limit(3), percent=50)
    ranks = importance_resampling.resample(docs, docs.limit(3), percent=50).where("rank is not null")
    assert drawn.columns == docs.columns
    assert sorted(r.doc_id for r in drawn.collect()) == sorted(r.doc_id for r in ranks.collect())
    assert importance_resampling.resample(documents(spark, []), docs).collect() == []
