"""Merkle manifest of a dataset: postorder logs written by aligned builders, proofs by closed-form positions."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockpulse.llm.ordering import placed
from dockpulse.session import stage

FAN = 16
# A builder owns an aligned subtree of FAN ** LEVELS leaves; its nodes are one stretch of the log.
LEVELS = 3
BLOCK = FAN**LEVELS

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

SEGMENT = "tree string, block long, total long, size int, nodes binary, root binary, doc_ids array<bigint>, shown array<binary>"
PATH = "tree string, block long, siblings array<binary>, ways array<int>, subroot binary, top binary"
PROOF = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, "
    "siblings array<binary>, ways array<int>"
)


def leaf_digest(**replaced: Column) -> Column:
    """SHA-256 of a row's fields, each as byte count, colon, value, or a dash for null."""
    parts = []
    for name in FIELDS:
        value = replaced.get(name, F.col(name).cast("string"))
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def joined(children: list[str]) -> str:
    """The parent of hexadecimal digests."""
    return sha256("".join(children).encode()).hexdigest()


def height(leaves: int) -> int:
    """Levels above the leaves."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // FAN), levels + 1
    return levels


def position(level: int, index: int, leaves: int, top: int) -> int:
    """Place of a node in the postorder log of a tree with so many leaves and ``top`` levels above them.

    Complete before it are all nodes of its own subtree, and on every higher level those that end before the subtree starts.
    """
    start, end = index * FAN**level, min((index + 1) * FAN**level, leaves)
    inside = sum(-(-end // FAN**k) for k in range(level + 1))
    return inside + sum(start // FAN**k for k in range(level + 1, top + 1)) - 1


def postorder(leaves: list[str], top: int) -> list[str]:
    """Nodes in the order in which they are complete."""
    log, open_runs = [], [[] for _ in range(top + 1)]

    def append(level: int, node: str) -> None:
        log.append(node)
        open_runs[level].append(node)
        if level < top and len(open_runs[level]) == FAN:
            close(level)

    def close(level: int) -> None:
        node, open_runs[level] = joined(open_runs[level]), []
        append(level + 1, node)

    for leaf in leaves:
        append(0, leaf)
    for level in range(top):
        if open_runs[level]:
            close(level)
    return log


def groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[list[dict]]:
    """Runs of rows with equal keys, from sorted rows; one run is held at a time."""
    held, current = [], None
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple(row[k] for k in keys)
            if held and key != current:
                yield held
                held = []
            current = key
            held.append(row)
    if held:
        yield held


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def built() -> Iterator[dict]:
        for rows in groups(batches, ("tree", "block")):
            total = rows[0]["total"]
            log = postorder([r["digest"].hex() for r in rows], min(LEVELS, height(total)))
            yield {
                "tree": rows[0]["tree"], "block": rows[0]["block"], "total": total, "size": len(rows),
                "nodes": bytes.fromhex("".join(log)), "root": bytes.fromhex(log[-1]),
                "doc_ids": [r["doc_id"] for r in rows], "shown": [r["shown"] for r in rows],
            }

    schema = pa.schema(
        [("tree", pa.string()), ("block", pa.int64()), ("total", pa.int64()), ("size", pa.int32()), ("nodes", pa.binary())]
        + [("root", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("shown", pa.list_(pa.binary()))]
    )
    yield from _in_batches(built(), schema, 16)


def _in_batches(rows: Iterator[dict], schema: pa.Schema, count: int) -> Iterator[pa.RecordBatch]:
    while part := list(islice(rows, count)):
        yield pa.RecordBatch.from_pylist(part, schema)


class Segment:
    """The nodes of one builder, addressed by level and index."""

    def __init__(self, row: dict):
        self.size, self.top = row["size"], min(LEVELS, height(row["total"]))
        self.nodes = row["nodes"].hex()

    def node(self, level: int, index: int) -> str:
        at = position(level, index, self.size, self.top) * 64
        return self.nodes[at : at + 64]

    def sides(self, level: int) -> list[tuple[str, str]]:
        """For each node of a level, its siblings to the left and to the right."""
        count, out = -(-self.size // FAN**level), []
        for start in range(0, count, FAN):
            run = [self.node(level, i) for i in range(start, min(start + FAN, count))]
            out += [("".join(run[:i]), "".join(run[i + 1 :])) for i in range(len(run))]
        return out


def _sides_above(row: dict) -> list[tuple[str, str]]:
    """Left and right siblings of the segment's root on the levels above, up to the root of all."""
    return [(s[: way * 32].hex(), s[way * 32 :].hex()) for s, way in zip(row["siblings"], row["ways"], strict=True)]


def _packed(sides: list[tuple[str, str]]) -> tuple[list[bytes], list[int]]:
    return [bytes.fromhex(a + b) for a, b in sides], [len(a) // 64 for a, _ in sides]


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From segments and their own paths, the paths of their leaves."""

    def below() -> Iterator[dict]:
        for batch in batches:
            for row in batch.to_pylist():
                segment, above = Segment(row), _sides_above(row)
                levels = [segment.sides(h) for h in range(segment.top)]
                for i in range(segment.size):
                    siblings, ways = _packed([levels[h][i // FAN**h] for h in range(segment.top)] + above)
                    yield {
                        "tree": row["tree"], "block": row["block"] * BLOCK + i, "siblings": siblings, "ways": ways,
                        "subroot": row["subroot"], "top": row["top"],
                    }

    schema = pa.schema(
        [("tree", pa.string()), ("block", pa.int64()), ("siblings", pa.list_(pa.binary())), ("ways", pa.list_(pa.int32()))]
        + [("subroot", pa.binary()), ("top", pa.binary())]
    )
    yield from _in_batches(below(), schema, 256)


def _prover(with_siblings: bool):
    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[dict]:
            for batch in batches:
                for row in batch.to_pylist():
                    segment, above = Segment(row), _sides_above(row)
                    subroot, root = row["subroot"].hex(), row["top"].hex()
                    levels = [segment.sides(h) for h in range(segment.top)]
                    # What the leaves below a node share: the siblings from its level upwards.
                    shared = ["".join(a + b for a, b in above)]
                    for h in reversed(range(1, segment.top)):
                        shared = [a + b + shared[i // FAN if h < segment.top - 1 else 0] for i, (a, b) in enumerate(levels[h])]
                    for i, (doc, shown) in enumerate(zip(row["doc_ids"], row["shown"], strict=True)):
                        sides = [levels[h][i // FAN**h] for h in range(segment.top)] + above
                        low = "".join(levels[0][i]) if segment.top else ""
                        leaf = segment.node(0, i)
                        folded = shown.hex() if shown is not None else leaf
                        for left, right in sides:
                            folded = sha256((left + folded + right).encode()).hexdigest()
                        siblings, ways = _packed(sides) if with_siblings else (None, None)
                        proof = low + shared[i // FAN if segment.top > 1 else 0]
                        yield {
                            "doc_id": doc, "leaf": leaf, "subroot": subroot, "root": root,
                            "proof_sha256": sha256(proof.encode()).hexdigest(), "folded_root": folded, "verified": folded == root,
                            "siblings": siblings, "ways": ways,
                        }

        names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
        kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
        schema = pa.schema([*zip(names, kinds, strict=True), ("siblings", pa.list_(pa.binary())), ("ways", pa.list_(pa.int32()))])
        yield from _in_batches(found(), schema, 1024)

    return prove


def _logs(leaves: DataFrame, name: str) -> list[DataFrame]:
    """The logs of trees, level by level of builders.

    ``leaves`` has tree, place and total within it, digest, doc_id and shown.  The first log holds the segments over the leaves,
    each next one those over the roots of the segments before, until every tree is one segment.
    """
    logs = []
    while True:
        dealt = leaves.withColumn("block", F.floor(F.col("place") / BLOCK)).select(
            "tree", "block", "place", "total", "digest", "doc_id", "shown"
        )
        dealt = dealt.repartition("tree", "block").sortWithinPartitions("tree", "block", "place")
        logs.append(stage(dealt.mapInArrow(_build, SEGMENT), name))
        open_trees = logs[-1].where(F.col("total") > BLOCK)
        if open_trees.isEmpty():
            return logs
        nothing = F.lit(None)
        leaves = open_trees.select(
            "tree", F.col("block").alias("place"), F.ceil(F.col("total") / BLOCK).alias("total"), F.col("root").alias("digest"),
            nothing.cast("long").alias("doc_id"), nothing.cast("binary").alias("shown"),
        )


def _with_paths(log: DataFrame, paths: DataFrame) -> DataFrame:
    """Segments with the paths of their roots."""
    renamed = paths.withColumnsRenamed({"tree": "path_tree", "block": "path_block"})
    match = log["tree"].eqNullSafe(renamed["path_tree"]) & (log["block"] == renamed["path_block"])
    return log.join(renamed, match).drop("path_tree", "path_block")


class Manifest:
    """The logs of all sources, and the log over their subroots.  Logs are tables below the shared folder."""

    def __init__(self, docs: DataFrame, altered: Column | None = None):
        """Needs ``doc_id``, ``source``, ``lang``, ``n_chars`` and ``text``; other columns are left out.

        ``altered`` gives the text that is shown for a document instead of its own (null: its own).
        """
        shown = F.lit(None).cast("binary") if altered is None else F.when(altered.isNotNull(), leaf_digest(text=altered))
        leaves = docs.select(
            F.col("source").alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf_digest().alias("digest"), shown.alias("shown")
        )
        leaves = stage(leaves.withColumn("row", F.monotonically_increasing_id()), "manifest-leaves")
        self.logs = _logs(placed(leaves, ["doc_id", "digest", "row"], "tree"), "manifest-log")
        self.subroots = None
        for log in reversed(self.logs):
            ends = log.where(F.col("total") <= BLOCK).select("tree", F.col("root").alias("digest"))
            self.subroots = ends if self.subroots is None else self.subroots.union(ends)
        self.subroots = stage(placed(stage(self.subroots, "subroots"), ["tree"]), "subroots")
        nothing = F.lit(None)
        tops = self.subroots.select(
            nothing.cast("string").alias("tree"), "place", "total", "digest", nothing.cast("long").alias("doc_id"),
            nothing.cast("binary").alias("shown"),
        )
        self.top_logs = _logs(tops, "manifest-top")

    def _paths_of_subroots(self) -> DataFrame:
        """(tree, siblings, ways, subroot, top) of every source."""
        nothing = F.lit(None)
        paths = self.top_logs[-1].select(
            "tree", "block", F.array().cast("array<binary>").alias("siblings"), F.array().cast("array<int>").alias("ways"),
            nothing.cast("binary").alias("subroot"), F.col("root").alias("top"),
        )
        for log in reversed(self.top_logs):
            paths = _with_paths(log, paths).mapInArrow(_paths, PATH)
        named = self.subroots.select(F.col("tree").alias("source"), F.col("digest").alias("own"), "place")
        return paths.drop("tree", "subroot").join(named, F.col("block") == F.col("place")).select(
            F.col("source").alias("tree"), "siblings", "ways", F.col("own").alias("subroot"), "top"
        )

    def proofs(self, with_siblings: bool = False) -> DataFrame:
        """One row for each document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

        ``folded_root`` comes from the shown leaf and the siblings in the logs.  With ``with_siblings`` also the proof itself:
        the siblings of each level in one binary, and the own place among them.

        Leaves of a source ascend by id (null first), then by digest; repeated rows are leaves of their own.  A null source is a
        source, an empty table has no rows.
        """
        tops = stage(self._paths_of_subroots(), "source-paths")
        paths = None
        for depth, log in reversed(list(enumerate(self.logs))):
            ends = log.where(F.col("total") <= BLOCK).select(F.col("tree").alias("end_tree"), "block")
            starts = ends.join(tops, F.col("end_tree").eqNullSafe(F.col("tree"))).select(
                "tree", "block", "siblings", "ways", "subroot", "top"
            )
            paths = starts if paths is None else paths.union(starts)
            if depth:
                paths = stage(_with_paths(log, paths).mapInArrow(_paths, PATH), "manifest-paths")
        found = _with_paths(self.logs[0], paths).mapInArrow(_prover(with_siblings), PROOF)
        return found if with_siblings else found.drop("siblings", "ways")


def tampered(share: int = 5) -> Column:
    """The text with A-Z in lower case, for the ids whose CRC-32 (in decimal) ``share`` divides; null for others."""
    chosen = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % share == 0
    return F.when(chosen, F.translate("text", CAPITALS, CAPITALS.lower()))


def folded(leaf: bytes, siblings: list[bytes], ways: list[int]) -> str:
    """The root that a leaf and its proof give: what a reader of one document checks."""
    node = leaf.hex()
    for level, way in zip(siblings, ways, strict=True):
        node = sha256((level[: way * 32].hex() + node + level[way * 32 :].hex()).encode()).hexdigest()
    return node
