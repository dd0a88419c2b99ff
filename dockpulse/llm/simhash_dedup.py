"""SimHash near-dedup with pigeonring filtering."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockpulse.llm.components import connected
from dockpulse.session import stage

SHINGLE_WORDS = 3
MAX_BITS = 3
SEGMENTS = 6
# A bucket with more fingerprints is split by a second ring over the bits that its key leaves open.
BUCKET_LIMIT = 1000
SMALL_GROUP = 8


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp): 64-bit SimHash of the shingles of every whole text."""

    def bits(text: bytes) -> int:
        tokens = text.lower().split()
        if not tokens:
            return 0
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        ends = np.cumsum(sizes + 1) - 1
        starts, line, size = ends - sizes, b" ".join(tokens), min(words, len(tokens))
        count, ones = len(tokens) - size + 1, np.zeros(64, np.int64)
        hashed = xxhash.xxh64_intdigest
        for at in range(0, count, 1 << 16):
            to = min(count, at + (1 << 16))
            spans = zip(starts[at:to].tolist(), ends[at + size - 1 : to + size - 1].tolist(), strict=True)
            values = np.array([hashed(line[a:b], 42) for a, b in spans], "<u8")
            ones += np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        return int(np.packbits(2 * ones > count, bitorder="little").view("<i8")[0])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [bits(t or b"") for t in batch.column("text").to_pylist()]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "fp": pa.array(found, pa.int64())})

    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return whole.mapInArrow(read, "doc_id long, fp long")


def _masks(open_bits: list[int]) -> list[int]:
    """Signed masks of the bit sets that are equal in at least one case when at most ``MAX_BITS`` bits of ``open_bits`` differ.

    On a ring of six segments with three differences there is a start whose first segment is equal, whose first three
    segments differ in one bit at most, and whose first five in two.  So three segments of the chain are equal: the
    first, then either the next two, or one of them and one of the two behind.  Over all starts these are the sets below.
    """
    parts = np.array_split(np.array(open_bits), SEGMENTS)
    sets = set()
    for i in range(SEGMENTS):
        ring = [(i + j) % SEGMENTS for j in range(SEGMENTS)]
        sets.add(frozenset(ring[:3]))
        sets |= {frozenset((ring[0], near, far)) for near in ring[1:3] for far in ring[3:5]}
    masks = []
    for chosen in sorted(sets, key=sorted):
        mask = sum(1 << int(bit) for part in chosen for bit in parts[part])
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


FIRST_MASKS = _masks(list(range(64)))
SECOND_MASKS = [_masks([b for b in range(64) if not m >> b & 1]) for m in FIRST_MASKS]


def chain_fits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The pigeonring test: some chain of consecutive segments stays within ``length * MAX_BITS / SEGMENTS`` at every length."""
    parts = np.array_split(np.arange(64, dtype=np.uint64), SEGMENTS)
    different = (a ^ b).view(np.uint64)
    counts = [
        np.bitwise_count(different & np.uint64(sum(1 << int(bit) for bit in part))).astype(np.int64) for part in parts
    ]
    found = np.zeros(len(different), bool)
    for start in range(SEGMENTS):
        total, within = np.zeros(len(different), np.int64), np.ones(len(different), bool)
        for j in range(SEGMENTS):
            total = total + counts[(start + j) % SEGMENTS]
            within &= total * SEGMENTS <= (j + 1) * MAX_BITS
        found |= within
    return found


def linked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Candidates that pass the ring, checked in full."""
    out = chain_fits(a, b)
    at = np.flatnonzero(out)
    out[at] = np.bitwise_count((a[at] ^ b[at]).view(np.uint64)) <= MAX_BITS
    return out


def forest(values: np.ndarray) -> tuple[list[int], list[int]]:
    """Links that connect what is connected within one bucket; one fewer than the members, not all pairs."""
    left, queue, a, b = np.unique(values), [], [], []
    while len(left) or queue:
        if not queue:
            queue, left = [int(left[0])], left[1:]
        node = queue.pop()
        near = linked(np.full(len(left), node, np.int64), left)
        found = left[near].tolist()
        a += [node] * len(found)
        b += found
        queue += found
        left = left[~near]
    return a, b


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams buckets in key order; holds one bucket at a time besides the batch."""
    held: list[np.ndarray] = []

    def emit(rows: np.ndarray) -> pa.RecordBatch:
        out_a, out_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        if len(rows):
            fresh = np.append(True, (rows[1:, :3] != rows[:-1, :3]).any(axis=1))
            group = np.cumsum(fresh) - 1
            first = np.flatnonzero(fresh)
            sizes = np.diff(np.append(first, len(rows)))
            small = np.where(sizes <= SMALL_GROUP, sizes, 0)[group]
            fp = np.ascontiguousarray(rows[:, 3])
            for gap in range(1, SMALL_GROUP):
                at = np.flatnonzero((group[gap:] == group[:-gap]) & (small[gap:] > 0))
                near = linked(fp[at], fp[at + gap])
                out_a.append(fp[at][near])
                out_b.append(fp[at + gap][near])
            for g in np.flatnonzero(sizes > SMALL_GROUP):
                a, b = forest(fp[first[g] : first[g] + sizes[g]])
                out_a.append(np.array(a, np.int64))
                out_b.append(np.array(b, np.int64))
        return pa.record_batch({"a": np.concatenate(out_a), "b": np.concatenate(out_b)})

    for batch in batches:
        rows = np.column_stack([batch.column(c).to_numpy() for c in ("t", "s", "key", "fp")])
        if not len(rows):
            continue
        if held and (held[0][0, :3] != rows[0, :3]).any():
            yield emit(np.vstack(held))
            held = []
        if held and (rows[0, :3] == rows[-1, :3]).all():
            held.append(rows)
            continue
        rows = np.vstack([*held, rows])
        cut = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1))
        cut = int(cut[-1]) + 1 if len(cut) else 0
        if cut:
            yield emit(rows[:cut])
        held = [rows[cut:]]
    if held:
        yield emit(np.vstack(held))


def near_links(values: DataFrame) -> DataFrame:
    """(a, b): links that connect distinct fingerprints at ``MAX_BITS`` or fewer different bits.

    Every pair within that distance shares a key, 30 to 33 bits of the fingerprint.  Keys with more than ``BUCKET_LIMIT``
    members are dealt again with a second ring over the open bits: 18 bits stay open then at most, which bounds a bucket,
    however many fingerprints there are.  Within a bucket only a spanning forest comes out.
    """
    keys = F.explode(
        F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(FIRST_MASKS)])
    )
    rows = values.select("fp", keys.alias("k")).select("k.t", "k.key", "fp")
    crowded = rows.groupBy("t", "key").count().where(F.col("count") > BUCKET_LIMIT).select("t", "key", F.lit(True).alias("crowded"))
    marked = rows.join(crowded, ["t", "key"], "left")
    calm = marked.where("crowded is null").select(F.col("t").cast("long"), F.lit(-1).cast("long").alias("s"), "key", "fp")
    second = F.array(*[F.array(*[F.lit(x) for x in masks]) for masks in SECOND_MASKS])
    split = (
        marked.where("crowded")
        .select("t", "key", "fp", F.posexplode(F.element_at(second, F.col("t") + 1)).alias("s", "mask"))
        .select(
            F.col("t").cast("long"),
            F.col("s").cast("long"),
            F.col("key").bitwiseOR(F.col("fp").bitwiseAND(F.col("mask"))).alias("key"),
            "fp",
        )
    )
    dealt = calm.union(split).repartition("t", "s", "key").sortWithinPartitions("t", "s", "key")
    return dealt.mapInArrow(_links, "a long, b long")


def classes(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp, component_id) of every row: texts whose fingerprints are linked, directly or through others, share a component.

    ``component_id`` is the smallest document id reached.  Copies become one fingerprint before any comparison.

    Needs ``doc_id`` and ``text``; others are left out.  Null and empty texts have fingerprint zero and are linked
    like any other.  Rows with a null id belong to a component without naming it (null if it has no id at all).
    Repeated rows come out once each.
    """
    prints = stage(fingerprints(docs, words), "fingerprints")
    distinct = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "distinct-fingerprints")
    components = connected(near_links(distinct.select("fp")))
    labelled = distinct.join(components, distinct["fp"] == components["node"], "left").select(
        "fp", "first_doc", F.coalesce("component", "fp").alias("component")
    )
    smallest = labelled.groupBy("component").agg(F.min("first_doc").alias("component_id"))
    names = labelled.join(smallest, "component").select("fp", "component_id")
    return prints.join(names, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their component, one row for each id; all columns stay.

    Rows with a null id cannot be told apart and stay.  Of rows with one id, the one with the smallest text hash stays.
    """
    names = docs.columns
    kept = classes(docs, words).where("doc_id = component_id").select(F.col("doc_id").alias("__kept")).distinct()
    order = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    found = docs.join(kept, F.col("doc_id") == F.col("__kept"), "left_semi")
    found = found.withColumn("__place", F.row_number().over(order)).where("__place = 1").select(*names)
    return found.unionByName(docs.where("doc_id is null"))
