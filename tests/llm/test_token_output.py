"""Token files: exact round trips and the whole tokenizer as brute force."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from dockpulse.llm import token_output
from tests.llm.rows import documents, edge_rows, random_texts

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("kind", ["byte", "bit"])
@pytest.mark.parametrize("count", [0, 1, 7, 8, 1000])
def test_planes(kind, count):
    ids = np.random.default_rng(count).integers(0, 1 << 32, count, dtype=np.uint64).astype("<u4")
    planes = token_output.to_planes(ids, kind)
    assert len(planes) == (4 if kind == "byte" else 32)
    assert token_output.from_planes(planes, count, kind).tolist() == ids.tolist()


ENCODER = token_output.WordEncoder(PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aB'sé\u0301 \n\t\x0b\x0c\r\x1c\x85\xa0\u3000İΣ!1<|endoftext|>字\U0001f600'll")))
def test_words_in_turn_are_the_text(text):
    whole = Tokenizer.from_file(PATH) if not hasattr(test_words_in_turn_are_the_text, "t") else test_words_in_turn_are_the_text.t
    test_words_in_turn_are_the_text.t = whole
    assert ENCODER.encode([text.encode()])[0].tolist() == [*whole.encode(text, add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("letter", ["J\u030c", "H\u0331", "T\u0308", "W\u030a", "Y\u030a", "E\u0301", "j\u030c", "\u01f0", "É"])
@pytest.mark.parametrize("text", ["{}", "{}ello", "x {}x, Y{}!", "A{}. {};"])
def test_decomposed_letters(whole, letter, text):
    text = text.format(*[letter] * text.count("{}"))
    assert ENCODER.encode([text.encode()])[0].tolist() == [*whole.encode(text, add_special_tokens=False).ids, 1]


def brute(rows, whole):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, (r[1] or "").encode()))
    out, at = [], 0
    for doc, text in rows:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        out.append((doc, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("kind, chunk, chunks", [("byte", 1 << 14, 64), ("bit", 64, 4), ("byte", 8, 1)])
def test_round_trip(spark, whole, monkeypatch, kind, chunk, chunks):
    """Also with files far smaller than a document."""
    monkeypatch.setattr(token_output, "CHUNK_IDS", chunk)
    monkeypatch.setattr(token_output, "FILE_CHUNKS", chunks)
    texts, ids = edge_rows()
    if chunk == 8:
        texts = [t and t[:2000] for t in texts]
    texts, ids = texts + random_texts(6, 50), ids + list(range(100, 150))
    got = sorted(map(tuple, token_output.encoded(documents(spark, texts, ids), PATH, kind).collect()), key=lambda r: r[1])
    assert got == brute(zip(ids, texts, strict=True), whole)


def test_empty_table(spark):
    assert token_output.encoded(documents(spark, []), PATH).count() == 0


LETTERS = "aZéÉßüœŒøØłŁžŽıİǅǆſŉΣςжЖ字ªº\u0301\u0308\u030a\u0331\u200d\ufb01\u01f0ʼnʰʹˈ̈"


def test_random_texts(whole):
    """Made-up texts of letters of all kinds, marks, numbers, controls and closing punctuation, many at a time."""
    import random

    draw, made = random.Random(13), []
    pieces = [*LETTERS, *"0123456789¼²٣", *" \t\n\x0b\x85\xa0\u2003\u3000", *".,;:!?'\"()-_<>|&", "'s", "'LL", "<|endoftext|>", "\x00", "\x1c", "the", "The", "ing"]
    for _ in range(6000):
        made.append("".join(draw.choices(pieces, k=draw.randint(1, 14))))
    encoder = token_output.WordEncoder(PATH)
    for at in range(0, len(made), 500):
        part = made[at : at + 500]
        found = encoder.encode([t.encode() for t in part])
        for text, ids in zip(part, found, strict=True):
            assert ids.tolist() == [*whole.encode(text, add_special_tokens=False).ids, 1], repr(text)


def test_forgetting_words_changes_nothing(whole, monkeypatch):
    monkeypatch.setattr(token_output, "CACHED_WORDS", 60)
    monkeypatch.setattr(token_output, "LASTING_WORDS", 25)
    encoder, texts = token_output.WordEncoder(PATH), random_texts(21, 80)
    for text in texts + texts[::-1]:
        assert encoder.encode([text.encode()])[0].tolist() == [*whole.encode(text, add_special_tokens=False).ids, 1]
