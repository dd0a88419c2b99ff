"""Small tables with awkward rows."""

from __future__ import annotations

import random

KINDS = (
    "doc_id long, text string, lang string, source string, n_chars long, block long, copy boolean, digest string, tokens string, "
    "fp long, weight double, place long, label double, words string, component long, hot boolean, own int"
)
EXTRA = (7, True, "d", "t", 1, 0.5, 3, 1.0, "w", 5, False, 2)
LONG = " ".join(f"word{i % 977} tail{i % 131}" for i in range(60_000))


def documents(spark, texts, ids=None, sources=None):
    ids = list(range(len(texts))) if ids is None else ids
    sources = [f"s{i % 3}" for i in range(len(texts))] if sources is None else sources
    rows = [(i, t, None, s, None if t is None else len(t), *EXTRA) for i, t, s in zip(ids, texts, sources, strict=True)]
    return spark.createDataFrame(rows, KINDS)


def edge_rows():
    """(texts, ids): nulls, empty and very long texts, repeated rows, equal ids, multi-byte characters."""
    shared = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    texts = [
        shared + " alpha beta", None, "", "   \n\t", shared, LONG, LONG + " x", "é ü ñ " + shared + " ß", shared + " gamma",
        shared + " gamma", "same id " + shared, "no id " + shared, None, "a", "aaaa " * 60, "aaaa " * 60 + "b",
    ]
    ids = [5, 6, 7, 8, 9, 10, 11, 12, 13, 13, 14, None, None, 15, 16, 17]
    return texts, ids


def random_texts(seed: int, count: int, vocabulary: int = 40) -> list[str]:
    """Texts with many shared passages, edits and copies."""
    draw = random.Random(seed)
    words = [draw.choice("abcdeé") * draw.randint(1, 3) + str(i) for i in range(vocabulary)]
    passages = [" ".join(draw.choices(words, k=draw.randint(5, 40))) for _ in range(8)]
    texts = []
    for _ in range(count):
        parts = [draw.choice(passages) if draw.random() < 0.5 else " ".join(draw.choices(words, k=20)) for _ in range(draw.randint(1, 4))]
        text = draw.choice([" ", "\n", "  "]).join(parts)
        texts.append(draw.choice(texts) if texts and draw.random() < 0.2 else text)
    return texts
