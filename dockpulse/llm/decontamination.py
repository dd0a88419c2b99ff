"""Benchmark decontamination: a BM25 index of test items, searched with block-max WAND by every training passage."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockpulse.llm.columns import filtered
from dockpulse.session import stage

K1, B = 1.2, 0.75
# Least share of an item's own BM25 score that a passage must reach.
MIN_SCORE = 0.5
# Words that count as found stand in this many consecutive equal words.
SHINGLE_WORDS = 5
MIN_QUESTION, MIN_ANSWER = 0.7, 0.5
# So many equal words in a row count without the answer: an item that a passage has cut short.
MIN_RUN = 13
ANSWER_SHARE = 0.25
MIN_STRIDE = 64
BLOCKS = 64
SLICE_PASSAGES = 512
# For the rounding of block maxima.
SLACK = 1e-4
# Text of the items that one index holds; more items make more indexes, each searched in its own pass.
INDEX_BYTES = 16 << 20

_LETTERS = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-case runs of letters and digits."""
    return (text or "").lower().encode().translate(_LETTERS).split()


@dataclass
class Statistics:
    """Of all items: their number, their mean length in words, and how many hold each word."""

    count: int
    mean: float
    holders: dict[bytes, int]

    @classmethod
    def of(cls, items: list[list[bytes]]) -> Statistics:
        holders = Counter(word for words in items for word in set(words))
        return cls(len(items), sum(map(len, items)) / max(1, len(items)), holders)


class ItemIndex:
    """Impact-ordered BM25 postings of test items.

    Impacts are divided by the item's own score, so that one threshold serves all items: a score is the share of the item
    that a passage reproduces.  Items are in blocks, and each term has its largest impact in each block.
    """

    def __init__(self, items: list[tuple[int, str]], whole: Statistics | None = None):
        """``whole`` has the statistics of all items, where these are a part of them."""
        self.items = [(i, words) for i, text in items if (words := words_of(text))]
        count = len(self.items)
        self.block_size = max(1, math.ceil(count / BLOCKS))
        whole = whole or Statistics.of([words for _, words in self.items])
        holders: dict[bytes, dict[int, int]] = defaultdict(dict)
        for number, (_, words) in enumerate(self.items):
            for word in words:
                holders[word][number] = holders[word].get(number, 0) + 1
        self.term = {word: t for t, word in enumerate(sorted(holders), 1)}
        self.postings: list[list[tuple[int, float]]] = [[]]
        own = [0.0] * count
        for word in sorted(holders):
            found = holders[word]
            holding = whole.holders[word]
            idf = math.log(1 + (whole.count - holding + 0.5) / (holding + 0.5))
            row = []
            for number, tf in sorted(found.items()):
                length = len(self.items[number][1])
                impact = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / whole.mean))
                own[number] += impact
                row.append((number, impact))
            self.postings.append(row)
        self.postings = [[(n, x / own[n]) for n, x in row] for row in self.postings]
        self.block_max = np.zeros((len(self.postings), math.ceil(count / self.block_size) or 1), np.float32)
        for t, row in enumerate(self.postings):
            for n, x in row:
                self.block_max[t, n // self.block_size] = max(self.block_max[t, n // self.block_size], x)
        self.most = self.block_max.max(axis=1).tolist()
        self.stride = max(MIN_STRIDE, max((len(w) for _, w in self.items), default=0))
        self.parts = [self._parts(words) for _, words in self.items]

    @staticmethod
    def _parts(words: list[bytes]) -> tuple[list[bytes], int]:
        """The item's shingles and the number of its question words; the last part of an item is its answer."""
        size = min(SHINGLE_WORDS, len(words))
        shingles = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]
        return shingles, len(words) - max(1, round(len(words) * ANSWER_SHARE))

    def candidates(self, terms: np.ndarray) -> np.ndarray:
        """First words of the passages whose different terms let some block of items reach the threshold."""
        found, size = [np.empty(0, np.int64)], len(self.postings)
        for start in range(0, len(terms), self.stride * SLICE_PASSAGES):
            part = terms[start : start + self.stride * (SLICE_PASSAGES + 1)].astype(np.int64)
            at = np.flatnonzero(part)
            chunk = at // self.stride
            pairs = np.concatenate([chunk, chunk - 1]) * size + np.concatenate([part[at], part[at]])
            pairs = np.unique(pairs[pairs >= 0])
            passage = pairs // size
            pairs, passage = pairs[passage < SLICE_PASSAGES], passage[passage < SLICE_PASSAGES]
            if len(pairs):
                first = np.flatnonzero(np.append(True, np.diff(passage) > 0))
                bound = np.add.reduceat(self.block_max[pairs % size], first, axis=0).max(axis=1)
                found.append(start + passage[first][bound >= MIN_SCORE - SLACK] * self.stride)
        return np.concatenate(found)

    def search(self, terms: list[int]) -> list[tuple[int, float]]:
        """Block-max WAND: items whose score reaches the threshold."""
        lists = [(t, self.postings[t]) for t in sorted(set(terms)) if t]
        cursors = [[row[0][0], 0, t, row, self.most[t]] for t, row in lists]
        out = []
        while cursors:
            cursors.sort(key=lambda c: c[0])
            total, pivot = 0.0, None
            for i, cursor in enumerate(cursors):
                total += cursor[4]
                if total >= MIN_SCORE - SLACK:
                    pivot = i
                    break
            if pivot is None:
                break
            number = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == number:
                pivot += 1
            block = number // self.block_size
            if sum(self.block_max[c[2], block] for c in cursors[: pivot + 1]) < MIN_SCORE - SLACK:
                target = (block + 1) * self.block_size
                if pivot + 1 < len(cursors):
                    target = min(target, cursors[pivot + 1][0])
                number = max(target, number + 1)
            elif cursors[0][0] == number:
                score = sum(c[3][c[1]][1] for c in cursors if c[0] == number)
                if score >= MIN_SCORE:
                    out.append((number, score))
                number += 1
            for cursor in cursors[: pivot + 1]:
                row, at = cursor[3], cursor[1]
                while at < len(row) and row[at][0] < number:
                    at += 1
                cursor[1] = at
                cursor[0] = row[at][0] if at < len(row) else -1
            cursors = [c for c in cursors if c[0] >= 0]
        return out

    def overlap(self, number: int, passage: list[bytes]) -> tuple[float, float]:
        """Shares of the item's question and answer words that stand in shingles of the passage."""
        shingles, question = self.parts[number]
        size, length = min(SHINGLE_WORDS, len(self.items[number][1])), len(self.items[number][1])
        here = {b" ".join(passage[i : i + size]) for i in range(len(passage) - size + 1)}
        found = np.zeros(length, bool)
        for i, shingle in enumerate(shingles):
            if shingle in here:
                found[i : i + size] = True
        return float(found[:question].mean()) if question else 1.0, float(found[question:].mean())

    def holds_run(self, number: int, passage: list[bytes]) -> bool:
        """Whether ``MIN_RUN`` words in a row of the item stand in the passage."""
        words = self.items[number][1]
        runs = {tuple(words[i : i + MIN_RUN]) for i in range(len(words) - MIN_RUN + 1)}
        return bool(runs) and any(tuple(passage[i : i + MIN_RUN]) in runs for i in range(len(passage) - MIN_RUN + 1))

    def hits(self, text: str | None) -> list[tuple[int, int, float, float, float]]:
        """(item_id, first word of the passage, score, question overlap, answer overlap), the best passage of each item."""
        words = words_of(text)
        terms = np.fromiter(map(self.term.get, words, repeat(0)), np.int32, len(words))
        best: dict[int, tuple[float, float, float, int]] = {}
        for start in self.candidates(terms).tolist():
            end = start + 2 * self.stride
            for number, score in self.search(terms[start:end].tolist()):
                question, answer = self.overlap(number, words[start:end])
                if (question >= MIN_QUESTION and answer >= MIN_ANSWER) or self.holds_run(number, words[start:end]):
                    item = self.items[number][0]
                    best[item] = max(best.get(item, (0.0, 0.0, 0.0, 0)), (score, question, answer, -start))
        return [(i, -start, score, q, a) for i, (score, q, a, start) in sorted(best.items())]


def item_indexes(benchmark: DataFrame) -> Iterator[ItemIndex]:
    """Indexes of bounded size that hold all items between them.

    BM25 statistics are those of all items, so an item's scores do not depend on how many indexes there are.  The driver holds one
    index at a time, with the statistics of its own words.  Items that are the same in id and text are one.
    """
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, math.ceil(total / INDEX_BYTES))
    if shards == 1:
        yield ItemIndex(sorted((r.item_id, r.text) for r in items.collect()))
        return
    shard = F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)).cast("int").alias("shard")
    words = stage(items.select("text", shard).mapInArrow(_item_words, "shard int, word binary, n_words long"), "item-words")
    count, mean = words.where("word is null").agg(F.count("*"), F.avg("n_words")).first()
    holders = words.where("word is not null").groupBy("word").agg(F.count("*").alias("n"))
    for number in range(shards):
        rows = items.where(shard == number).collect()
        own = words.where((F.col("shard") == number) & F.col("word").isNotNull()).select("word").distinct()
        held = {bytes(r.word): r.n for r in holders.join(own, "word", "left_semi").collect()}
        yield ItemIndex(sorted((r.item_id, r.text) for r in rows), Statistics(count, mean or 0.0, held))


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each different word of an item, and one row without a word that has its length; items without words have none."""
    for batch in batches:
        rows = []
        for text, shard in zip(batch.column("text").to_pylist(), batch.column("shard").to_pylist(), strict=True):
            words = words_of(text)
            rows += [(shard, None, len(words)), *((shard, w, None) for w in set(words))] if words else []
        columns = list(zip(*rows, strict=True)) or [()] * 3
        kinds = {"shard": pa.int32(), "word": pa.binary(), "n_words": pa.int64()}
        yield pa.record_batch({n: pa.array(c, k) for (n, k), c in zip(kinds.items(), columns, strict=True)})


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, first_word, score, question_overlap, answer_overlap): one row for each document and item it holds.

    Every passage of every whole text is a query: passages overlap by half and are twice as long as the longest item,
    so each item fits into one.  An item counts if its BM25 share reaches ``MIN_SCORE`` and either enough of its
    question and of its answer stands in the passage in runs of equal words, or ``MIN_RUN`` of its words in a row.

    Needs ``doc_id`` and ``text``, and ``item_id`` and ``text`` of the benchmark; others are left out.  Null and empty texts hold
    nothing; items without words or id are not searched for.  Repeated items come out as one.  Ids of documents
    pass on as they are.
    """
    out = None
    for index in item_indexes(benchmark):
        found = _search(docs, index)
        out = found if out is None else out.unionByName(found)
    return out


def _search(docs: DataFrame, index: ItemIndex) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                rows += [(doc, *hit) for hit in index.hits(text)]
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    schema = pa.schema(
        [("doc_id", pa.int64()), ("item_id", pa.int64()), ("first_word", pa.int64())]
        + [(c, pa.float64()) for c in ("score", "question_overlap", "answer_overlap")]
    )
    kinds = "doc_id long, item_id long, first_word long, score double, question_overlap double, answer_overlap double"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, kinds)


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows that hold no item, with all their columns, whatever their names."""
    for index in item_indexes(benchmark):
        docs = filtered(docs, lambda texts, index=index: [not index.hits(t) for t in texts])
    return docs
