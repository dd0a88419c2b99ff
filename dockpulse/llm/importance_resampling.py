"""Target-distribution importance resampling: hashed word runs of a corpus are weighed against those of a target set."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockpulse.llm.ordering import placed
from dockpulse.session import stage

BUCKETS = 10_000
RUN_WORDS = 1
MIN_WORDS = 20
SHARE_PERCENT = 10
SEED = "2024"
# The dictionary of a worker doubles up to so many words; other words come by their own CRC.
DICTIONARY_WORDS = 1 << 17
PIECE_BYTES = 1 << 20

# A-Z in lower case; whatever is no digit, letter or part of a multi-byte character separates words.
_KEPT = bytes(range(0x30, 0x3A)) + bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
PLAIN = bytes((c | 0x20 if 0x41 <= c <= 0x5A else c) if c in _KEPT else 0x20 for c in range(256))
BLANK = re.compile(rb"[^0-9A-Za-z\x80-\xff]")


@lru_cache(maxsize=1024)
def _shift(length: int) -> np.ndarray:
    """What ``length`` zero bytes do to a CRC: a table for each of its four bytes."""
    if length == 1:
        step = []
        for bit in range(32):
            c = 1 << bit
            for _ in range(8):
                c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
            step.append(c)
        columns = np.array(step, np.uint32)
    else:
        half = _shift(length // 2)
        columns = _through(half, _through(half, np.uint32(1) << np.arange(32, dtype=np.uint32)))
        if length % 2:
            columns = _through(_shift(1), columns)
    bytes_of = np.arange(256, dtype=np.uint32)
    table = np.zeros((4, 256), np.uint32)
    for bit in range(32):
        table[bit // 8] ^= np.where(bytes_of >> np.uint32(bit % 8) & np.uint32(1), columns[bit], np.uint32(0))
    return table


def _through(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    out = np.zeros(len(crc), np.uint32)
    for k in range(4):
        out ^= table[k][crc >> np.uint32(8 * k) & np.uint32(0xFF)]
    return out


def composed(first: np.ndarray, second: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The CRC of two strings in a row, from their CRCs and the second's length."""
    out = np.empty(len(first), np.uint32)
    for length in np.unique(lengths).tolist():
        at = lengths == length
        out[at] = _through(_shift(length), first[at]) ^ second[at]
    return out


class Dictionary:
    """Distinct words between delimiters, in an automaton whose hits carry the number of a (CRC, length) payload.

    It learns from the texts it scans: words that it lacks come by their own CRC, and join it when they are as many as it holds.
    So what a text yields never depends on what the dictionary holds.
    """

    def __init__(self, limit: int = DICTIONARY_WORDS):
        self.limit, self.automaton, self.words, self.fresh = limit, None, [], {}
        self.crc, self.length = np.empty(0, np.uint32), np.empty(0, np.int64)

    @staticmethod
    def of_worker() -> Dictionary:
        """One dictionary for all tasks of a worker process."""
        import ahocorasick

        return ahocorasick.__dict__.setdefault("_word_dictionary", Dictionary())

    def scan(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(CRCs, lengths) of the words of a piece of text, in order."""
        line = b" ".join((b"", *text.translate(PLAIN).split(b" "), b""))
        if b"  " in line:
            line = b" " + b" ".join(line.split()) + b" "
        if len(line) < 3:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        hits = chain.from_iterable(self.automaton.iter(line.decode("latin-1"))) if self.automaton else ()
        hits = np.fromiter(hits, np.int64).reshape(-1, 2)
        ends, numbers = hits[:, 0], hits[:, 1]
        crcs, lengths = self.crc[numbers], self.length[numbers]
        # A hit starts at the delimiter where the one before ended; else words lie between that are not in the dictionary.
        before = np.concatenate([[0], ends])
        gaps = np.flatnonzero(np.append(ends - lengths - 1, len(line) - 1) != before)
        if len(gaps):
            starts = np.append(ends - lengths - 1, len(line) - 1)
            missing = [line[before[g] + 1 : starts[g]].split(b" ") for g in gaps.tolist()]
            flat = list(chain.from_iterable(missing))
            where = np.repeat(gaps, [len(m) for m in missing])
            crcs = np.insert(crcs, where, np.fromiter(map(crc32, flat), np.uint32, len(flat)))
            lengths = np.insert(lengths, where, np.fromiter(map(len, flat), np.int64, len(flat)))
            self._learn(flat)
        return crcs, lengths

    def _learn(self, words: list[bytes]) -> None:
        import ahocorasick

        if len(self.words) >= self.limit:
            return
        self.fresh.update(dict.fromkeys(words))
        if len(self.fresh) < max(1024, len(self.words)):
            return
        self.words = (self.words + list(self.fresh))[: self.limit]
        self.fresh = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for number, word in enumerate(self.words):
            self.automaton.add_word(f" {word.decode('latin-1')} ", number)
        self.automaton.make_automaton()
        self.crc = np.fromiter(map(crc32, self.words), np.uint32, len(self.words))
        self.length = np.fromiter(map(len, self.words), np.int64, len(self.words))


def pieces(text: bytes) -> Iterator[bytes]:
    """Stretches of about ``PIECE_BYTES`` that end between words, so that a very long text is never held as words."""
    at = 0
    while len(text) - at > PIECE_BYTES:
        cut = BLANK.search(text, at + PIECE_BYTES)
        if not cut:
            break
        yield text[at : cut.end()]
        at = cut.end()
    yield text[at:] if at else text


def buckets(dictionary: Dictionary, text: bytes, run_words: int, count: int) -> Iterator[tuple[np.ndarray, int]]:
    """(buckets of features, words) of each piece of a text; features are all runs of 1 to ``run_words`` words, joined by one space."""
    kept = np.empty(0, np.uint32), np.empty(0, np.int64)
    blank = crc32(b" ")
    for piece in pieces(text):
        fresh = dictionary.scan(piece)
        crcs, lengths = (np.concatenate([a, b]) for a, b in zip(kept, fresh, strict=True)) if len(kept[0]) else fresh
        old, found, run = len(kept[0]), [fresh[0] % count], crcs
        for size in range(2, run_words + 1):
            # Runs that end in this piece: the word behind each shorter run, with the space before it.
            behind, width = crcs[size - 1 :], lengths[size - 1 :]
            spaced = composed(np.full(len(behind), blank, np.uint32), behind, width)
            run = composed(run[: len(behind)], spaced, width + 1)
            found.append(run[max(0, old - size + 1) :] % count)
        yield np.concatenate(found), len(fresh[0])
        if run_words > 1:
            kept = crcs[1 - run_words :], lengths[1 - run_words :]


def _body(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("binary"), F.lit(b"")).alias("text")


def bucket_counts(texts: DataFrame, run_words: int = RUN_WORDS, count: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all whole texts in each bucket.  A task sends one row a bucket."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary, total = Dictionary.of_worker(), np.zeros(count, np.int64)
        for batch in batches:
            for text in batch.column("text"):
                for found, _ in buckets(dictionary, text.as_py(), run_words, count):
                    total += np.bincount(found, minlength=count)
        at = np.flatnonzero(total)
        yield pa.record_batch({"bucket": pa.array(at), "n": pa.array(total[at])})

    return texts.select(_body()).mapInArrow(read, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, count: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket, in thousandths of a natural logarithm; one number a bucket reaches the driver."""
    s, t = np.zeros(count, np.int64), np.zeros(count, np.int64)
    for into, counted in ((s, corpus), (t, target)):
        for row in counted.collect():
            into[row.bucket] = row.n
    all_s, all_t = float(s.sum() + count), float(t.sum() + count)
    return np.array(
        [math.floor(1000 * math.log((float(b) + 1) * all_s / ((float(a) + 1) * all_t))) for a, b in zip(s.tolist(), t.tolist(), strict=True)],
        np.int64,
    )


def noise(doc_id: int | None, seed: str = SEED) -> int:
    """Gumbel noise of a document, in thousandths, from its id."""
    h = int(sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, run_words: int = RUN_WORDS, seed: str = SEED) -> DataFrame:
    """(doc_id, n_features, n_words, weight, score) of every row."""
    count = len(gain)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary = Dictionary.of_worker()
        for batch in batches:
            ids, rows = batch.column("doc_id").to_pylist(), []
            for doc, text in zip(ids, batch.column("text"), strict=True):
                features = words = total = 0
                for found, n in buckets(dictionary, text.as_py(), run_words, count):
                    features, words, total = features + len(found), words + n, total + int(gain[found].sum())
                weight = total // features if features else 0
                rows.append((features, words, weight, weight + noise(doc, seed)))
            columns = zip(*rows, strict=True) if rows else [()] * 4
            names = ("n_features", "n_words", "weight", "score")
            found = {name: pa.array(c, pa.int64()) for name, c in zip(names, columns, strict=True)}
            yield pa.record_batch({"doc_id": batch.column("doc_id")} | found)

    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _body())
    return whole.mapInArrow(read, "doc_id long, n_features long, n_words long, weight long, score long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    run_words: int = RUN_WORDS,
    count: int = BUCKETS,
    min_words: int = MIN_WORDS,
    percent: int = SHARE_PERCENT,
    seed: str = SEED,
) -> DataFrame:
    """(doc_id, n_features, n_words, weight, score, rank) of every document; the drawn ones have a rank, 1 for the highest score.

    Of the documents with ``min_words`` words or more, ``percent`` of a hundred are drawn, rounded down; equal scores go by the
    smaller id, null last.  Both tables need ``text``, ``docs`` also ``doc_id``; others are left out.  Null and empty texts have no
    features, weight 0 and are never drawn.  A null id has the noise of an empty one.  Repeated rows count, and are drawn, each.
    """
    gain = gains(bucket_counts(docs, run_words, count), bucket_counts(target, run_words, count), count)
    found = stage(scored(docs, gain, run_words, seed).withColumn("row", F.monotonically_increasing_id()), "resampling-scores")
    able = found.where(F.col("n_words") >= min_words)
    drawn = able.count() * percent // 100
    ordered = placed(
        able.select("*", (-F.col("score")).alias("lowest"), F.col("doc_id").isNull().alias("unnamed")),
        ["lowest", "unnamed", "doc_id", "row"],
    )
    rank = F.when(F.col("place") < drawn, F.col("place") + 1)
    columns = ["doc_id", "n_features", "n_words", "weight", "score"]
    rest = found.where(F.col("n_words") < min_words).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ordered.select(*columns, rank.cast("long").alias("rank")).union(rest)


def drawn_documents(docs: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that are drawn, all columns; rows with one id go or stay together, null ids go."""
    kept = resample(docs, target, **settings).where("rank is not null").select(F.col("doc_id").alias("drawn_id")).distinct()
    return docs.join(kept, docs["doc_id"] == kept["drawn_id"], "left_semi")
