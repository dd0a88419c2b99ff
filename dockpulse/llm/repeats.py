"""Finding equal passages across documents: the part that substring and suffix-array dedup share.

A *window* is ``k`` consecutive units (words or bytes) of one document.  To compare windows without moving all of them,

1. documents are dealt into blocks of about ``BLOCK_BYTES`` by their id; copies of a whole text are represented by the one
   with the smallest id, which holds all their windows;
2. every window is named by its *anchor*, the smallest hash among its ``gram``-unit grams, so equal windows have equal
   anchors, and consecutive windows with one anchor form a *run*;
3. each block reports its distinct anchors, and only anchors that occur in two documents or more are answered;
4. runs under such anchors are sent, as text, to the task that owns the anchor (pieces that are equal within a block
   travel once), where the operator's own method tells which windows an earlier document holds;
5. the covered ranges go back to their blocks.

Rows for one anchor are at most one per block.  An anchor with more than ``HOT_RUNS`` different runs would gather an
unbounded group, so its windows travel one by one, each to the owner of its own content: exact, and again at most one
row per block and window.  Every step depends on the size of a block or a group of ``HOT_RUNS`` runs, not of the corpus.

Hashes only bring candidates together; equality is always decided on text.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_BYTES = 2 << 20
HOT_RUNS = 1000
SOLVE_BYTES = 1 << 20

# Groups of (document, text) sorted by document -> for each piece the window offsets that a smaller document holds.
Solve = Callable[[list[list[tuple[int, bytes]]]], list[list[np.ndarray]]]

ANSWER = np.dtype([("anchor", np.int64), ("hot", np.bool_)])

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE_VALUES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class RangeHash:
    """Hashes of any ranges of a sequence from one prefix sum."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        powers = np.ones(n + 1, np.uint64)
        powers[1:] = _ODD
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * np.cumprod(powers)[:n], out=self.sums[1:])
        powers[1:] = _INVERSE
        self.shift = np.cumprod(powers)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.shift[start])

    def grams(self, size: int) -> np.ndarray:
        n = max(0, len(self.sums) - size)
        return mix((self.sums[size:] - self.sums[:n]) * self.shift[:n])


def named(hashes: np.ndarray) -> np.ndarray:
    """The 48 bits of a hash that owners are found by.  Different grams under one name cost a comparison, nothing else."""
    return hashes >> np.uint64(16)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size, out = 1, values
    while size * 2 <= width:
        out, size = np.minimum(out[:-size], out[size:]), size * 2
    return np.minimum(out[: len(out) - (width - size)], out[width - size :]) if size < width else out


class Block:
    """The units of a block's documents: ``text`` holds them in canonical form, words joined by one space."""

    def __init__(self, table: pa.Table, unit: str):
        self.names = list(zip(table["doc_id"].to_pylist(), table["uid"].to_pylist(), strict=True))
        texts = [t or b"" for t in table["body"].to_pylist()]
        if unit == "words":
            words = [t.split() for t in texts]
            counts = [len(w) for w in words]
            flat = list(chain.from_iterable(words))
            self.text = b" ".join(flat)
            sizes = np.fromiter(map(len, flat), np.int64, len(flat))
            self.starts = np.cumsum(sizes + 1) - sizes - 1
            self.ends = self.starts + sizes
        else:
            counts = [len(t) for t in texts]
            self.text = b"".join(texts)
            self.starts = np.arange(len(self.text))
            self.ends = self.starts + 1
        self.offsets = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]).astype(np.int64)
        self.unit = unit

    def hashes(self) -> RangeHash:
        by_byte = _BYTE_VALUES[np.frombuffer(self.text, np.uint8)]
        if self.unit == "bytes":
            return RangeHash(by_byte)
        return RangeHash(RangeHash(by_byte).of(self.starts, self.ends))

    def slice(self, start: int, end: int) -> bytes:
        return self.text[self.starts[start] : self.ends[end - 1]]

    def runs(self, hashes: RangeHash, k: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, first window, number of windows, row) of each run, in text order."""
        width, n = k - gram + 1, int(self.offsets[-1])
        if n < k:
            return np.empty(0, np.uint64), *(np.empty(0, np.int64) for _ in range(3))
        anchors = named(sliding_min(hashes.grams(gram), width))
        inside = np.zeros(n + 1, np.int32)
        last = np.maximum(self.offsets[1:] - k + 1, self.offsets[:-1])
        np.add.at(inside, self.offsets[:-1], 1)
        np.add.at(inside, last, -1)
        at = np.flatnonzero(np.cumsum(inside)[: len(anchors)] > 0)
        if not len(at):
            return np.empty(0, np.uint64), *(np.empty(0, np.int64) for _ in range(3))
        found = anchors[at]
        rows = np.searchsorted(self.offsets, at, side="right") - 1
        fresh = np.ones(len(at), bool)
        fresh[1:] = (found[1:] != found[:-1]) | (rows[1:] != rows[:-1])
        first = np.flatnonzero(fresh)
        in_run = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
        first = np.flatnonzero(in_run % width == 0)
        return found[first], at[first], np.diff(np.append(first, len(at))), rows[first]


def _distinct_per(anchor: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct anchors and the number of different ``other`` values under each."""
    order = np.lexsort((other, anchor))
    a, b = anchor[order], other[order]
    fresh = np.ones(len(a), bool)
    fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    names, counts = np.unique(a[fresh], return_counts=True)
    return names, counts


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def ranked(names: list[tuple[int | None, int]]) -> dict[tuple[int, int], int]:
    """Numbers of a block's rows, in order of document id; the same wherever the block is read."""
    return {name: i for i, name in enumerate(sorted({n for n in names if n[0] is not None}))}


def in_blocks(docs: DataFrame) -> DataFrame:
    """(block, doc_id, uid, body, copy): texts as bytes, dealt by document id into blocks of bounded size.

    ``uid`` tells rows with one id but different texts apart.  ``copy`` marks texts that a smaller id holds as a whole.
    """
    body = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK_BYTES))
    rows = docs.select(
        F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).alias("block"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("uid"),
        body.alias("body"),
    )
    digests = rows.where("doc_id is not null").select("block", "doc_id", "uid", F.sha2("body", 256).alias("digest"))
    first = digests.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = digests.join(first, "digest").where("doc_id > first")
    copies = later.groupBy("block").agg(F.collect_set(F.struct("doc_id", "uid")).alias("copies"))
    own = F.array_contains("copies", F.struct("doc_id", "uid"))
    return (
        rows.repartition("block")
        .join(copies, "block", "left")
        .select("block", "doc_id", "uid", "body", F.coalesce(own, F.lit(False)).alias("copy"))
    )


def _originals(table: pa.Table) -> pa.Table:
    return table.filter(pa.compute.and_(pa.compute.is_valid(table["doc_id"]), pa.compute.invert(table["copy"])))


class ByBlock:
    """Gathers rows of arrays for blocks and hands them out as one packed row for each block."""

    def __init__(self, limit: int = 500_000):
        self.blocks: list[np.ndarray] = []
        self.rows: list[np.ndarray] = []
        self.size, self.limit = 0, limit

    def add(self, block: int | np.ndarray, rows: np.ndarray) -> None:
        if len(rows):
            self.blocks.append(np.broadcast_to(np.asarray(block, np.int64), len(rows)))
            self.rows.append(rows)
            self.size += len(rows)

    def full(self) -> bool:
        return self.size >= self.limit

    def take(self) -> pa.RecordBatch:
        names, packed = [], []
        if self.rows:
            blocks, rows = np.concatenate(self.blocks), np.concatenate(self.rows)
            order = np.argsort(blocks, kind="stable")
            names, first = np.unique(blocks[order], return_index=True)
            packed = [part.tobytes() for part in np.split(rows[order], first[1:])]
        self.blocks, self.rows, self.size = [], [], 0
        return pa.record_batch({"block": pa.array(names, pa.int64()), "packed": pa.array(packed, pa.binary())})


def covered(blocks: DataFrame, unit: str, k: int, gram: int, solve: Solve) -> DataFrame:
    """(block, packed): int32 rows (rank in the block, first unit, end unit) covered by an earlier document's windows."""

    def report(key: tuple, table: pa.Table) -> pa.Table:
        block = Block(_originals(table), unit)
        hashes = block.hashes()
        anchor, start, windows, row = block.runs(hashes, k, gram)
        ids = np.array([doc for doc, _ in block.names], np.int64)
        names, documents = _distinct_per(anchor, ids[row])
        _, different = _distinct_per(anchor, hashes.of(start, start + windows + k - 1))
        return pa.table(
            {
                "anchor": _signed(names),
                "block": np.full(len(names), key[0].as_py(), np.int64),
                "documents": documents.astype(np.int32),
                "different": different.astype(np.int32),
            }
        )

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = ByBlock()
        for batch in batches:
            rows = np.zeros(batch.num_rows, ANSWER)
            rows["anchor"], rows["hot"] = batch.column("anchor").to_numpy(), batch.column("hot").to_numpy(zero_copy_only=False)
            out.add(batch.column("block").to_numpy(), rows)
            if out.full():
                yield out.take()
        yield out.take()

    def pieces(key: tuple, table: pa.Table, shared: pa.Table) -> pa.Table:
        found: dict[tuple[int, bytes], list[tuple[int, int]]] = {}
        block = Block(_originals(table), unit)
        ranks = ranked(block.names)
        if len(shared):
            hashes = block.hashes()
            anchor, start, windows, row = block.runs(hashes, k, gram)
            answers = np.frombuffer(b"".join(shared["packed"].to_pylist()), ANSWER)
            answers = answers[np.argsort(answers["anchor"])]
            names, hot, anchor = answers["anchor"], answers["hot"], _signed(anchor)
            at = np.minimum(np.searchsorted(names, anchor), len(names) - 1)
            kept = np.flatnonzero(names[at] == anchor)
            single = kept[hot[at[kept]]]
            kept = kept[~hot[at[kept]]]
            one_by_one = np.repeat(start[single], windows[single]) + (
                np.arange(windows[single].sum()) - np.repeat(np.cumsum(windows[single]) - windows[single], windows[single])
            )
            routes = np.concatenate([anchor[kept], _signed(named(hashes.of(one_by_one, one_by_one + k)))])
            starts = np.concatenate([start[kept], one_by_one])
            ends = np.concatenate([start[kept] + windows[kept] + k - 1, one_by_one + k])
            rows = np.concatenate([row[kept], np.repeat(row[single], windows[single])])
            text, number = block.text, np.array([ranks[name] for name in block.names], np.int64)
            for route, a, b, rank, first in zip(
                routes.tolist(),
                block.starts[starts].tolist(),
                block.ends[ends - 1].tolist(),
                number[rows].tolist(),
                (starts - block.offsets[rows]).tolist(),
                strict=True,
            ):
                found.setdefault((route, text[a:b]), []).append((rank, first))
        ids = [doc for doc, _ in ranks]
        places = [sorted(p) for p in found.values()]
        first = [ids[p[0][0]] for p in places]
        return pa.table(
            {
                "route": pa.array([r for r, _ in found], pa.int64()),
                "doc": pa.array(first, pa.int64()),
                "block": pa.array([key[0].as_py()] * len(found), pa.int64()),
                "own": pa.array([sum(ids[r] == doc for r, _ in p) for p, doc in zip(places, first, strict=True)], pa.int32()),
                "piece": pa.array([t for _, t in found], pa.binary()),
                "places": pa.array([np.array(p, np.int32).tobytes() for p in places], pa.binary()),
            }
        )

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _resolved(batches, unit, k, solve)

    anchors = blocks.groupBy("block").applyInArrow(report, "anchor long, block long, documents int, different int")
    everywhere = Window.partitionBy("anchor")
    shared = (
        anchors.withColumn("documents", F.sum("documents").over(everywhere))
        .withColumn("different", F.sum("different").over(everywhere))
        .where("documents > 1")
        .select("block", "anchor", (F.col("different") > HOT_RUNS).alias("hot"))
        .mapInArrow(answer, "block long, packed binary")
    )
    sent = (
        blocks.groupBy("block")
        .cogroup(shared.groupBy("block"))
        .applyInArrow(pieces, "route long, doc long, block long, own int, piece binary, places binary")
    )
    return (
        sent.repartition("route")
        .sortWithinPartitions("route", "doc")
        .mapInArrow(resolve, "block long, packed binary")
    )


def _resolved(batches: Iterator[pa.RecordBatch], unit: str, k: int, solve: Solve) -> Iterator[pa.RecordBatch]:
    """Streams pieces sorted by owner and document; holds the different texts of a few groups at a time."""
    out = ByBlock()
    flat: list[int] = []
    waiting: list[list[tuple[int, bytes]]] = []
    owners: list[list[tuple[int, list[int]]]] = []
    seen: set[bytes] = set()
    group: list[tuple[int, bytes]] = []
    group_owners: list[tuple[int, list[int]]] = []
    held, route = 0, None

    def whole(block: int, places: list[int], piece: bytes) -> None:
        units = piece.count(b" ") + 1 if unit == "words" else len(piece)
        for i in range(0, len(places), 2):
            flat.extend((block, places[i], places[i + 1], places[i + 1] + units))

    def packed_rows() -> pa.RecordBatch:
        rows = np.array(flat, np.int64).reshape(-1, 4)
        out.add(rows[:, 0], rows[:, 1:].astype(np.int32))
        flat.clear()
        return out.take()

    def close() -> None:
        nonlocal group, group_owners, seen
        if len(group) > 1:
            waiting.append(group)
            owners.append(group_owners)
        group, group_owners, seen = [], [], set()

    def settle() -> None:
        nonlocal held
        for owner, offsets in zip(owners, solve(waiting) if waiting else [], strict=True):
            for (block, places), found in zip(owner, offsets, strict=True):
                if len(found):
                    cut = np.flatnonzero(np.diff(found) > 1)
                    begins = [found[0], *found[cut + 1]]
                    ends = [*found[cut], found[-1]]
                    for i in range(0, len(places), 2):
                        for begin, end in zip(begins, ends, strict=True):
                            flat.extend((block, places[i], places[i + 1] + int(begin), places[i + 1] + int(end) + k))
        waiting.clear()
        owners.clear()
        held = 0

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("route", "doc", "block", "own", "piece", "places"))
        for owner, doc, block, own, piece, packed in zip(*columns, strict=True):
            if owner != route:
                close()
                route = owner
                if held > SOLVE_BYTES:
                    settle()
            places = memoryview(packed).cast("i").tolist()
            if piece in seen:
                whole(block, places, piece)
            else:
                seen.add(piece)
                held += len(piece)
                group.append((doc, piece))
                group_owners.append((block, places[: 2 * own]))
                if 2 * own < len(places):
                    whole(block, places[2 * own :], piece)
        if len(flat) >= 4 * out.limit:
            yield packed_rows()
    close()
    settle()
    yield packed_rows()


def without_covered(blocks: DataFrame, spans: DataFrame, unit: str, k: int) -> DataFrame:
    """(doc_id, kept, n_units, n_removed, n_spans) of every document row; ``kept`` is the text left, as bytes."""

    def finish(key: tuple, table: pa.Table, found: pa.Table) -> pa.Table:
        block, copies = Block(table, unit), table["copy"].to_pylist()
        n = int(block.offsets[-1])
        rows: dict[int, list[int]] = {}
        ranks = ranked([name for name, copy in zip(block.names, copies, strict=True) if not copy])
        change = np.zeros(n + 1, np.int64)
        for i, (name, copy) in enumerate(zip(block.names, copies, strict=True)):
            if copy and block.offsets[i + 1] - block.offsets[i] >= k:
                change[block.offsets[i]] += 1
                change[block.offsets[i + 1]] -= 1
            elif not copy and name[0] is not None:
                rows.setdefault(ranks[name], []).append(i)
        spans = np.frombuffer(b"".join(found["packed"].to_pylist()), np.int32).reshape(-1, 3)
        spans = spans[np.argsort(spans[:, 0], kind="stable")]
        if len(spans):
            fresh = np.flatnonzero(np.diff(spans[:, 0]) != 0) + 1
            for part in np.split(spans, fresh):
                for row in rows[int(part[0, 0])]:
                    np.add.at(change, part[:, 1] + block.offsets[row], 1)
                    np.add.at(change, part[:, 2] + block.offsets[row], -1)
        gone = np.cumsum(change)[:n] > 0
        kept, removed, runs = [], [], []
        glue = b" " if unit == "words" else b""
        for a, b in zip(block.offsets[:-1].tolist(), block.offsets[1:].tolist(), strict=True):
            mask = gone[a:b]
            count = int(mask.sum())
            removed.append(count)
            edges = np.flatnonzero(np.diff(np.concatenate([[1], mask, [1]]).astype(np.int8)))
            parts = [block.slice(a + s, a + e) for s, e in edges.reshape(-1, 2).tolist()]
            kept.append(glue.join(parts))
            starts = np.flatnonzero(np.diff(np.concatenate([[0], mask]).astype(np.int8)) == 1)
            runs.append(len(starts))
        return pa.table(
            {
                "doc_id": table["doc_id"],
                "kept": pa.array(kept, pa.binary()),
                "n_units": pa.array(np.diff(block.offsets), pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "n_spans": pa.array(runs, pa.int64()),
            }
        )

    return (
        blocks.groupBy("block")
        .cogroup(spans.groupBy("block"))
        .applyInArrow(finish, "doc_id long, kept binary, n_units long, n_removed long, n_spans long")
    )
