"""Near-dedup by the Jaccard similarity of texts.

SimHash fingerprints that pass the pigeonring filter are proposed first.  For similar texts whose fingerprints lie farther apart MinHash
bands find groups, and the rarest shingles of a text propose pairs in them.  The texts decide about every pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockpulse.llm.columns import sliced, whole_row
from dockpulse.llm.components import connected
from dockpulse.llm.simhash_dedup import near_links
from dockpulse.session import stage

SHINGLE_WORDS = 5
SIMILARITY = 0.8
# A pair at 0.8 misses all bands with probability 0.0002; its SimHash fingerprints differ in about 10 of 64 bits.
BANDS, BAND_ROWS = 16, 4
MAX_BITS = 24
# Counters of the sketch that says which shingles are common: it orders them, so its errors cost comparisons, not links.
COUNTERS = 1 << 20
# Texts of one shingle that are compared in one task; more are dealt in blocks.
LIST_TEXTS = 1 << 15

KEYS = [f"k{i}" for i in range(BANDS)]
FACTORS = np.random.default_rng(7).integers(0, 1 << 63, BANDS * BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``SHINGLE_WORDS`` words; a shorter text is one shingle, an empty one none."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    size, line = min(SHINGLE_WORDS, len(words)), b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    spans = zip((ends - sizes)[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)
    hashed, count = xxhash.xxh64_intdigest, len(words) - size + 1
    return np.unique(np.fromiter((hashed(line[a:b], 42) for a, b in spans), np.uint64, count))


def signature(found: np.ndarray) -> tuple[int, list[int]]:
    """(SimHash, band keys) of the shingles; texts without words share all keys."""
    ones, least = np.zeros(64, np.int64), np.full(len(FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 1 << 12):
        part = found[at : at + (1 << 12)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        least = np.minimum(least, (FACTORS[:, None] * part).min(axis=1))
    bands = least.reshape(BANDS, BAND_ROWS)
    keys = [xxhash.xxh64_intdigest(band.tobytes(), i) - (1 << 63) for i, band in enumerate(bands)]
    return int(np.packbits(2 * ones > len(found), bitorder="little").view("<i8")[0]), keys


def similar(a: bytes, b: bytes) -> bool:
    """Whether two shingle sets, as bytes, have Jaccard similarity ``SIMILARITY`` or more."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if min(len(x), len(y)) < SIMILARITY * max(len(x), len(y)) - 1e-9:
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= SIMILARITY * (len(x) + len(y) - both) - 1e-9


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        sizes, found = [], []
        for text in batch.column("text"):
            made = shingles(text.as_py())
            sizes.append(len(made))
            found.append(signature(made))
        keys = np.array([k for _, k in found], np.int64).reshape(-1, BANDS)
        columns = {"doc_id": batch.column("doc_id"), "digest": batch.column("digest"), "size": pa.array(sizes, pa.int64())}
        columns["fp"] = pa.array([f for f, _ in found], pa.int64())
        yield pa.record_batch(columns | {name: pa.array(keys[:, i]) for i, name in enumerate(KEYS)})


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        made = [shingles(t.as_py()).tobytes() for t in batch.column("text")]
        yield pa.record_batch({"node": batch.column("node"), "shingles": pa.array(made, pa.binary())})


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        near = [similar(x.as_py(), y.as_py()) for x, y in zip(batch.column("sa"), batch.column("sb"), strict=True)]
        yield pa.record_batch({"a": batch.column("a"), "b": batch.column("b")}).filter(pa.array(near, pa.bool_()))


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that hold on the texts."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    return pairs.distinct().join(one, "a").join(two, "b").select("a", "b", "sa", "sb").mapInArrow(_judged, "a long, b long")


def _counter(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(44)).astype(np.int64)


def common_counts(sets: DataFrame) -> np.ndarray:
    """How often shingles occur, by ``COUNTERS`` of their hashes; one number a counter reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for held in batch.column("shingles"):
                np.add.at(total, _counter(np.frombuffer(held.as_py(), np.uint64)), 1)
        at = np.flatnonzero(total)
        yield pa.record_batch({"counter": pa.array(at), "n": pa.array(total[at])})

    rows = sets.select("shingles").mapInArrow(count, "counter long, n long").groupBy("counter").agg(F.sum("n").alias("n"))
    out = np.zeros(COUNTERS, np.int64)
    for batch in rows.toArrow().to_batches():
        out[batch.column("counter").to_numpy()] = batch.column("n").to_numpy()
    return np.minimum(out, np.iinfo(np.uint32).max).astype(np.uint32)


def prefixes(sets: DataFrame, counts: np.ndarray) -> DataFrame:
    """(node, size, keys): the rarest shingles of each text, rarest first; texts at ``SIMILARITY`` share one of them.

    A set of n shingles shares at least ``SIMILARITY`` * n with any similar one, so one of its first n - ceil(that) + 1.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            sizes, keys = [], []
            for held in batch.column("shingles"):
                found = np.frombuffer(held.as_py(), np.uint64)
                order = np.lexsort((found, counts[_counter(found)]))
                sizes.append(len(found))
                keys.append(found[order[: len(found) - math.ceil(SIMILARITY * len(found) - 1e-9) + 1]].view(np.int64))
            columns = {"size": pa.array(sizes, pa.int64()), "keys": pa.array(keys, pa.list_(pa.int64()))}
            yield pa.record_batch({"node": batch.column("node")} | columns)

    return sets.mapInArrow(read, "node long, size long, keys array<bigint>")


def may_reach(size_a, place_a, size_b, place_b):
    """Whether sets whose first common shingle has these places can share enough: at most all from there on are common."""
    both = np.minimum(size_a - place_a, size_b - place_b)
    return both >= SIMILARITY / (1 + SIMILARITY) * (size_a + size_b) - 1e-6


COLUMNS = ("key", "block", "side", "node", "component", "size", "place")


def _to_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams the texts of each shingle; pairs each with the first, in another component.  Holds one row besides the batch."""
    head = np.zeros(len(COLUMNS), np.int64)
    started = False
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.column_stack([batch.column(c).to_numpy() for c in COLUMNS])
        fresh = np.append(not started or rows[0, 0] != head[0], rows[1:, 0] != rows[:-1, 0])
        started = True
        at = np.maximum.accumulate(np.where(fresh, np.arange(len(rows)), -1))
        pivot = np.where((at >= 0)[:, None], rows[np.maximum(at, 0)], head)
        head = pivot[-1]
        good = (rows[:, 4] != pivot[:, 4]) & may_reach(rows[:, 5], rows[:, 6], pivot[:, 5], pivot[:, 6])
        a, b = rows[good, 3], pivot[good, 3]
        yield pa.record_batch({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))})


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of one shingle and block and of two components whose sizes and places allow the similarity; holds one block."""

    def pairs(rows: np.ndarray) -> pa.RecordBatch:
        found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        if len(np.unique(rows[:, 4])) > 1:
            rows = rows[np.argsort(rows[:, 5], kind="stable")]
            sides = rows[:, 2]
            for own, other in [(2, 2)] if (sides == 2).all() else [(0, 1), (1, 0)]:
                left, right = rows[sides == own], rows[sides == other]
                # Of two sets that reach the similarity, one at least leaves room for another of its own size.
                left = left[may_reach(left[:, 5], left[:, 6], left[:, 5], left[:, 6])]
                start = np.searchsorted(right[:, 5], SIMILARITY * left[:, 5] - 1e-6, "left")
                stop = np.searchsorted(right[:, 5], left[:, 5] / SIMILARITY + 1e-6, "right")
                for row, i, j in zip(left, start.tolist(), stop.tolist(), strict=True):
                    near = right[i:j]
                    near = near[(near[:, 4] != row[4]) & may_reach(near[:, 5], near[:, 6], row[5], row[6])]
                    found.append((np.full(len(near), row[3]), near[:, 3]))
        a, b = (np.concatenate(c) for c in zip(*found, strict=True))
        return pa.record_batch({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))})

    held: list[np.ndarray] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.column_stack([batch.column(c).to_numpy() for c in COLUMNS])
        fresh = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
        # Most shingles stand in one text; of a batch, only the first and the last row can go on elsewhere.
        alone = np.concatenate([[False], fresh[:-1] & fresh[1:], [False]])[: len(rows)] if len(rows) > 1 else np.zeros(1, bool)
        rows = rows[~alone]
        cuts = np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1)) + 1
        for part in np.split(rows, cuts):
            if held and (held[0][0, :2] != part[0, :2]).any():
                yield pairs(np.vstack(held))
                held = []
            held.append(part)
    if held:
        yield pairs(np.vstack(held))


def _listed(kept: DataFrame, components: DataFrame) -> DataFrame:
    """A row for each text and rare shingle of it, with the text's component."""
    named = kept.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    return named.select("node", "size", "component", F.posexplode("keys").alias("place", "key"))


def _dealt(rows: DataFrame, *order: str) -> DataFrame:
    dealt = rows.repartition("key", "block").sortWithinPartitions("key", "block", *order)
    return dealt.select(*[F.col(c).cast("long") for c in COLUMNS])


def _in_blocks(rows: DataFrame) -> DataFrame:
    """Shingles of more than ``LIST_TEXTS`` texts in blocks of pairs, so that no task holds more than two blocks of them."""
    whole = {"block": F.lit(0).cast("long"), "side": F.lit(2).cast("long")}
    lists = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("component").alias("x"), F.max("component").alias("y"))
    crowded = stage(lists.where((F.col("n") > LIST_TEXTS) & (F.col("x") != F.col("y"))).select("key", "n"), "crowded-shingles")
    if crowded.isEmpty():
        return rows.withColumns(whole)
    count = F.ceil(F.col("n") / LIST_TEXTS)
    split = rows.join(crowded, "key").withColumn("own", F.pmod(F.xxhash64("node"), count)).withColumn("count", count)
    split = split.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1)))
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    block = F.least("own", "other") * F.col("count") + F.greatest("own", "other")
    split = split.withColumns({"block": block, "side": side}).select(*rows.columns, "block", "side")
    return rows.join(crowded, "key", "left_anti").withColumns(whole).select(split.columns).union(split)


def ring_pairs(distinct: DataFrame) -> DataFrame:
    """(a, b): pairs of texts whose SimHash fingerprints are equal, or linked by the pigeonring at three or fewer different bits.

    All texts of a fingerprint meet the smallest of them, and the ring's links are a spanning forest of each bucket: a large group of
    near copies makes about one pair a member.
    """
    prints = stage(distinct.groupBy("fp").agg(F.min("node").alias("pivot")), "near-prints")
    same = distinct.join(prints, "fp").where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    one, two = (prints.select(F.col("fp").alias(c), F.col("pivot").alias(f"n{c}")) for c in "ab")
    linked = near_links(prints.select("fp")).distinct().join(one, "a").join(two, "b")
    return same.union(linked.select(F.least("na", "nb"), F.greatest("na", "nb"))).distinct()


def near_components(distinct: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, component): texts of Jaccard similarity ``SIMILARITY`` or more that share a band are of one component, also through others.

    Pairs of the SimHash ring come first; they find most near copies, but at ``SIMILARITY`` fingerprints differ in about ten bits.
    In each bucket of a band all members then meet the smallest one, so a large group of near copies makes one pair a member.  Texts of
    buckets that are not one component by then are listed under their rarest shingles: similar ones share one, while what
    only shares a common frame lies under shingles of its own.  Each list first meets the text that has the
    shingle earliest; of what stays apart, the pairs whose sizes and places allow the similarity are compared.
    """
    rows = distinct.select("node", "fp", "size", F.explode(F.array(*KEYS)).alias("key"))
    head = F.min_by(F.struct("fp", "size"), "node")
    pivots = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("pivot"), head.alias("head"))
    rows = stage(rows.join(pivots.where("n > 1").drop("n"), "key"), "near-buckets")
    ring = stage(ring_pairs(distinct), "near-ring")

    nodes = rows.select("node").union(ring.select("a")).union(ring.select("b")).distinct()
    needed = nodes.join(distinct.select("node", "digest", F.col("first_doc").alias("doc_id")), "node")
    body = texts.join(needed, ["digest", "doc_id"]).dropDuplicates(["digest", "doc_id"]).select("node", "text")
    sets = stage(body.mapInArrow(_sets, "node long, shingles binary"), "near-shingles")

    close = F.bit_count(F.col("fp").bitwiseXOR(F.col("head.fp"))) <= MAX_BITS
    fits = F.least("size", "head.size") >= SIMILARITY * F.greatest("size", "head.size") - 1e-6
    stars = rows.where("node <> pivot").where(close & fits).select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    beyond = stars.join(ring, ["a", "b"], "left_anti")
    links = stage(_links(ring, sets), "near-ring-links").union(stage(_links(beyond, sets), "near-stars"))

    components = connected(links)
    named = rows.select("key", "node").join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = named.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("key")
    apart = stage(rows.select("key", "node").join(mixed, "key", "left_semi").select("node").distinct(), "near-apart")
    if apart.isEmpty():
        return components
    open_sets = stage(sets.join(apart, "node", "left_semi"), "near-open")
    kept = stage(prefixes(open_sets, common_counts(open_sets)), "near-prefixes")

    lists = _listed(kept, components).withColumns({"block": F.lit(0), "side": F.lit(2), "lag": F.col("place") / F.col("size")})
    firsts = _dealt(lists, "lag", "node").mapInArrow(_to_first, "a long, b long")
    firsts = stage(_links(firsts, open_sets), "near-firsts")
    if not firsts.isEmpty():
        links = links.union(firsts)
        components = connected(links)
    rest = _dealt(_in_blocks(_listed(kept, components))).mapInArrow(_across, "a long, b long")
    rest = stage(_links(rest, open_sets), "near-rest")
    return components if rest.isEmpty() else connected(links.union(rest))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each group of near copies, the one with the smallest id (then text hash); all columns stay.

    Texts whose sets of five-word shingles (lower case, split at white space) have Jaccard similarity 0.8 or more are
    linked, directly or through others.  Equal texts are told by SHA-256.  Rows with a null id cannot be told apart: they
    stay and link nothing.  Needs ``doc_id`` and ``text``; other columns may have any names.
    """
    rows = docs.select(
        whole_row(docs),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )
    named = rows.where("doc_id is not null").withColumn("digest", F.unhex(F.sha2("text", 256)))
    texts = named.drop("row")
    schema = "doc_id long, digest binary, size long, fp long, " + ", ".join(f"{k} long" for k in KEYS)
    prints = texts.mapInArrow(_signatures, schema)
    same = [F.min(c).alias(c) for c in ("size", "fp", *KEYS)]
    distinct = prints.groupBy("digest").agg(F.min("doc_id").alias("first_doc"), *same)
    distinct = stage(distinct.withColumn("node", F.monotonically_increasing_id()), "near-signatures")
    components = near_components(distinct, texts)
    labelled = distinct.select("node", "first_doc", "digest").join(components, "node", "left")
    kept = labelled.groupBy(F.coalesce("component", "node")).agg(F.min(F.struct("first_doc", "digest")).alias("k"))
    kept = kept.select(F.col("k.first_doc").alias("doc_id"), F.col("k.digest").alias("digest"))
    found = named.drop("text").join(kept, ["doc_id", "digest"], "left_semi")
    one = found.withColumn("place", F.row_number().over(Window.partitionBy("doc_id", "digest").orderBy("digest"))).where("place = 1")
    return one.select("row.*").union(rows.where("doc_id is null").select("row.*"))
