"""Chat formatting in budgeted windows of whole turns."""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockpulse.llm.merkle_manifest import groups
from dockpulse.llm.ordering import placed
from dockpulse.session import stage, work_path

BUDGET = 512
HISTORY = 128
# Tokens that a turn's marks count for, besides its words.
MARKS = 4
# Windows do not cross the edges of stretches of so many budgets, so a conversation of any length is formatted in parts.
STRETCH = 64

HEAD, END = "### ", "</turn>\n"
SYSTEM, ANSWER = "system", "assistant"
WORD = r"[^\x20\x09-\x0D]+"

# Kinds of a part's rows: the system turn, turns that the first window may repeat, new turns.
FIRST, TOLD, NEW = 0, 1, 2
ORDER = ["late", "turn", "role", "text_key"]

PARTS = (
    "conv_id long, part long, whole boolean, windows array<struct<text:string,n_repeated:int,n_tokens:long,"
    "loss:array<struct<start:int,stop:int>>>>"
)
DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long"


def escaped(text: str) -> str:
    """Text without a bare control string: a backslash goes before each of them and each backslash."""
    return text.replace("\\", "\\\\").replace("</turn>", "\\</turn>").replace("###", "\\###")


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL) if "\\" in text else text


def formatted(role: str, text: str) -> tuple[str, int, int]:
    """A turn between its marks, and where its text starts and stops."""
    head = HEAD + escaped(role).replace("\n", "\\\n") + "\n"
    body = escaped(text)
    return head + body + END, len(head), len(head) + len(body)


def _bare(text: str, mark: str, at: int) -> int:
    """The next place of a mark without a backslash of its own before it."""
    while True:
        at = text.index(mark, at)
        back = at
        while back and text[back - 1] == "\\":
            back -= 1
        if (at - back) % 2 == 0:
            return at
        at += 1


def parsed(text: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a window."""
    at = 0
    while at < len(text):
        if not text.startswith(HEAD, at):
            raise ValueError(f"no turn starts at {at}")
        line = _bare(text, "\n", at + len(HEAD))
        end = _bare(text, END, line + 1)
        yield unescaped(text[at + len(HEAD) : line]), unescaped(text[line + 1 : end])
        at = end + len(END)


def spans(tokens: list[int], lead: int, budget: int, history: int, keep: int) -> Iterator[tuple[int, int, int]]:
    """(first repeated, first new, behind the last) turn of each window.

    ``tokens`` are those of the turns after the system turn, of which the first ``lead`` belong to the part before, and ``keep`` is
    what the system turn takes.  Prefix sums give each edge by a search: the longest run of new turns that fits, and before it the
    longest run of at most ``history`` tokens that leaves room for the first new turn.  A turn beyond the budget has its own window.
    """
    sums = np.concatenate([[0], np.cumsum(np.array(tokens, np.int64))])
    at = lead
    while at < len(tokens):
        room = min(history, max(0, budget - keep - tokens[at]))
        first = int(np.searchsorted(sums, sums[at] - room, "left"))
        stop = int(np.searchsorted(sums, sums[first] + budget - keep, "right")) - 1
        yield first, at, max(stop, at + 1)
        at = max(stop, at + 1)


def windows(turns: list[dict], budget: int, history: int) -> list[dict]:
    """The windows of one part."""
    made = [(*formatted(t["role"], t["text"]), t) for t in turns]
    lead = sum(t["kind"] == FIRST for t in turns)
    # At the start of a conversation the system turn is new itself.
    opens = 0 if lead or turns[0]["role"] != SYSTEM or not turns[0]["opens"] else 1
    system, rest = made[: lead + opens], made[lead + opens :]
    keep = sum(t["n_tokens"] for *_, t in system)
    known = sum(t["kind"] == TOLD for *_, t in rest)
    edges = list(spans([t["n_tokens"] for *_, t in rest], known, budget, history, keep)) or [(0, 0, 0)]
    out = []
    for number, (first, at, stop) in enumerate(edges):
        chosen, loss, place = [*system, *rest[first:stop]], [], 0
        fresh_system = opens and number == 0
        repeated = (0 if fresh_system else len(system)) + at - first
        for i, (text, start, end, turn) in enumerate(chosen):
            if i >= repeated and turn["role"] == ANSWER:
                loss.append({"start": place + start, "stop": place + end})
            place += len(text)
        tokens = sum(t["n_tokens"] for *_, t in chosen)
        out.append({"text": "".join(c[0] for c in chosen), "n_repeated": repeated, "n_tokens": tokens, "loss": loss})
    return out


def _format(budget: int, history: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            {"conv_id": g[0]["conv_id"], "part": g[0]["part"], "whole": g[0]["whole"], "windows": windows(g, budget, history)}
            for g in groups(batches, ("conv_id", "part"))
        )
        while part := list(islice(rows, 64)):
            yield pa.RecordBatch.from_pylist(part, schema)

    window = pa.struct(
        [("text", pa.string()), ("n_repeated", pa.int32()), ("n_tokens", pa.int64())]
        + [("loss", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))]
    )
    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("whole", pa.bool_()), ("windows", pa.list_(window))])
    return read


def word_tokens(text: Column) -> Column:
    """Words of a whole text, and its marks."""
    return F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))) + MARKS


def format_windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row for each part of a conversation, with its windows: text, loss spans (in code points), repeated turns.

    Needs ``conv_id``, ``turn``, ``role`` and ``text``; others are left out.  Turns go by ``turn`` (null last), then by role and the hash of
    the text; repeated rows are turns of their own.  Null roles and texts are empty, a null id is a conversation.  If the first turn has the
    role system, every window starts with it.  A window holds at most ``budget`` tokens unless the system turn and one new turn exceed it
    alone.

    Conversations of at most ``STRETCH`` budgets are one part.  Longer ones are cut where their prefix sums of tokens, taken over ranges
    of turns, pass a multiple of that; a part gets the turns that its first window may repeat, and the system turn.
    """
    stretch = STRETCH * budget
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    said = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").isNull().alias("late"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.xxhash64(text).alias("text_key"),
        text.alias("text"),
        word_tokens(text).cast("long").alias("n_tokens"),
    )
    sizes = said.groupBy("conv_id").agg(F.sum("n_tokens").alias("n"))
    long_ones = stage(sizes.where(F.col("n") > stretch).select(F.col("conv_id").alias("long_id")), "long-conversations")
    match = F.col("conv_id").eqNullSafe(F.col("long_id"))
    if long_ones.isEmpty():
        dealt = _whole(said)
    else:
        parts = _parts(said.join(long_ones, match, "left_semi"), stretch, history)
        dealt = _whole(said.join(long_ones, match, "left_anti")).unionByName(parts)
    dealt = dealt.repartition("conv_id", "part").sortWithinPartitions("conv_id", "part", "kind", *ORDER)
    columns = ("conv_id", "part", "whole", "kind", "opens", "role", "text", "n_tokens")
    return dealt.select(*columns).mapInArrow(_format(budget, history), PARTS)


def _whole(said: DataFrame) -> DataFrame:
    marks = {"part": F.lit(0).cast("long"), "whole": F.lit(True), "kind": F.lit(NEW), "opens": F.lit(True)}
    return said.withColumns(marks)


def _parts(said: DataFrame, stretch: int, history: int) -> DataFrame:
    """Turns of long conversations with their part, together with what each part repeats."""
    stored = stage(said.withColumn("row", F.monotonically_increasing_id()), "long-turns")
    numbers = placed(stored.drop("text"), [*ORDER, "row"], "conv_id", "n_tokens")
    numbers = numbers.select(F.col("row").alias("number_row"), "place", "before")
    rows = stored.join(numbers, F.col("row") == F.col("number_row")).drop("row", "number_row")
    part = F.floor(F.col("before") / stretch).cast("long")
    new = {"part": part, "whole": F.lit(False), "kind": F.lit(NEW), "opens": F.col("place") == 0}
    rows = stage(rows.withColumns(new), "long-parts")
    # A part without a new turn does not exist.
    known = rows.select(F.col("conv_id").alias("known_id"), F.col("part").alias("known_part")).distinct()
    system = F.col("opens") & (F.col("role") == SYSTEM)
    near = (F.col("part") + 1) * stretch - F.col("before") <= history
    told = rows.where(near & ~system).withColumns({"part": F.col("part") + 1, "kind": F.lit(TOLD), "opens": F.lit(False)})
    told = told.join(known, F.col("conv_id").eqNullSafe(F.col("known_id")) & (F.col("part") == F.col("known_part")), "left_semi")
    first = rows.where(system).drop("part").withColumns({"kind": F.lit(FIRST), "opens": F.lit(False)})
    first = known.where("known_part > 0").join(first, F.col("conv_id").eqNullSafe(F.col("known_id"))).withColumn("part", F.col("known_part"))
    columns = [c for c in rows.columns if c not in ("place", "before")]
    return rows.select(columns).union(told.select(columns)).union(first.select(columns))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation, from its parts in order; a window is held at a time, besides the batch."""

    def found() -> Iterator[dict]:
        current, said, target = None, None, None
        for batch in batches:
            for row in (r for at in range(0, batch.num_rows, 16) for r in batch.slice(at, 16).to_pylist()):
                if current is None or current["conv_id"] != row["conv_id"]:
                    if current:
                        yield current | {"turns_sha256": said.hexdigest(), "loss_sha256": target.hexdigest()}
                    said, target = sha256(), sha256()
                    current = {"conv_id": row["conv_id"], "n_turns": 0, "loss_chars": 0, "formatted_chars": 0, "n_windows": 0}
                for window in row["windows"]:
                    text = window["text"]
                    current["n_windows"] += 1
                    current["formatted_chars"] += len(text)
                    for role, body in islice(parsed(text), window["n_repeated"], None):
                        current["n_turns"] += 1
                        said.update(f"{role}\n{body}\n".encode())
                    for span in window["loss"]:
                        body = unescaped(text[span["start"] : span["stop"]])
                        current["loss_chars"] += len(body)
                        target.update(body.encode())
        if current:
            yield current | {"turns_sha256": said.hexdigest(), "loss_sha256": target.hexdigest()}

    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_windows")
    schema = pa.schema([(n, pa.string() if n.endswith("sha256") else pa.int64()) for n in names])
    rows = found()
    while part := list(islice(rows, 1024)):
        yield pa.RecordBatch.from_pylist(part, schema)


def read_windows(parts: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_windows), from the windows alone.

    A conversation in one part is read where it lies.  The hash of a longer one is made in order, so its parts stream through one task.
    """
    ordered = parts.where("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return parts.where("whole").mapInArrow(_digest, DIGEST).union(ordered.mapInArrow(_digest, DIGEST))


def formatted_and_read(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """Write the windows below the shared folder and read them back."""
    spark = turns.sparkSession
    path = work_path(spark, "chat-windows")
    format_windows(turns, budget, history).write.parquet(path)
    return read_windows(spark.read.schema(PARTS).parquet(path))
