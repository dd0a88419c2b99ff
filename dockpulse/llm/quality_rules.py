"""Quality rules as a short-circuit cascade."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockpulse.llm.columns import filtered

# Documents that the order of the rules is estimated on, and their largest size.  Only the order, and so the speed, depends on
# them.
SAMPLE_DOCUMENTS = 500
SAMPLE_BYTES = 1 << 16
REPEAT_WINDOW = 5
SPACES = b" \t\n\r\x0b\x0c"
CONTINUATION = bytes(range(0x80, 0xC0))
SYMBOLS = b"#*$%&|<>"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))


class Text:
    """Measures of one text, each taken when a rule first asks for it."""

    def __init__(self, text: bytes | None):
        self.text = text or b""

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.split()

    @cached_property
    def lines(self) -> list[bytes]:
        return [line for line in self.text.split(b"\n") if line.strip()]

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text.translate(None, SPACES + CONTINUATION))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.text) - len(self.text.translate(None, SYMBOLS))

    @cached_property
    def n_capitals(self) -> int:
        return len(self.text) - len(self.text.translate(None, CAPITALS))

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words in windows found twice or more; windows are told apart by 64-bit hashes within the text."""
        n = self.n_words - REPEAT_WINDOW + 1
        if n < 2:
            return 0
        hashes = np.fromiter(map(hash, self.words), np.int64, self.n_words).view(np.uint64)
        windows = np.zeros(n, np.uint64)
        for j in range(REPEAT_WINDOW):
            windows = windows * np.uint64(0x9E3779B97F4A7C15) + (hashes[j : n + j] ^ (hashes[j : n + j] >> np.uint64(29)))
        order = np.argsort(windows, kind="stable")
        equal = np.diff(windows[order]) == 0
        if not equal.any():
            return 0
        twice = np.zeros(n, bool)
        twice[order[1:][equal]] = True
        twice[order[:-1][equal]] = True
        change = np.zeros(self.n_words + 1, np.int64)
        at = np.flatnonzero(twice)
        np.add.at(change, at, 1)
        np.add.at(change, at + REPEAT_WINDOW, -1)
        return int((np.cumsum(change) > 0).sum())


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Text], bool]
    base: bool = False


RULES = (
    Rule("few_words", lambda t: t.n_words < 10, base=True),
    Rule("repeated_words", lambda t: 100 * t.n_repeat_words > 20 * t.n_words, base=True),
    Rule("symbols", lambda t: 10 * t.n_symbols > 5 * t.n_words),
    Rule("duplicate_lines", lambda t: 10 * t.n_dup_lines > 5 * len(t.lines)),
    Rule("long_words", lambda t: t.word_chars > 20 * t.n_words),
    Rule("capitals", lambda t: 10 * t.n_capitals > 5 * t.word_chars),
)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def best_order(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample: int = SAMPLE_DOCUMENTS) -> tuple[Rule, ...]:
    """Rules by rejections per second, as measured on a bounded sample of the first partitions that Spark reads."""
    usual = F.coalesce(F.octet_length("text"), F.lit(0)) <= SAMPLE_BYTES
    rows = docs.select(F.col("text").cast("binary").alias("text")).where(usual).limit(sample).collect()
    rates = []
    for rule in rules:
        texts, began = [Text(row.text and bytes(row.text)) for row in rows], time.perf_counter()
        rejected = sum(rule.rejects(text) for text in texts)
        seconds = time.perf_counter() - began
        rates.append((-rejected / max(seconds, 1e-9), seconds))
    return tuple(rules[i] for i in sorted(range(len(rules)), key=rates.__getitem__))


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, measures, base_failed, kept, n_rules_run) of every row.

    A text is run through the rules until one rejects it; the order decides how many run, never the verdict.  All
    measures are reported, those that no rule needed are taken afterwards.

    Needs ``doc_id`` and ``text``; others are left out.  A null text has no words and fails the base rule, as an empty one
    does.  Ids are passed on as they are, null or repeated.
    """
    ordered = best_order(docs, rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: dict[str, list] = {name: [] for name in (*MEASURES, "base_failed", "kept", "n_rules_run")}
            for raw in batch.column("text").to_pylist():
                text, kept, count = Text(raw), True, 0
                for rule in ordered:
                    count += 1
                    if rule.rejects(text):
                        kept = False
                        break
                for name in MEASURES:
                    columns[name].append(getattr(text, name))
                columns["base_failed"].append(not kept and any(r.base and r.rejects(text) for r in ordered))
                columns["kept"].append(kept)
                columns["n_rules_run"].append(count)
            yield pa.record_batch({"doc_id": batch.column("doc_id"), **columns}, schema=schema)

    schema = pa.schema(
        [("doc_id", pa.int64()), *((m, pa.int64()) for m in MEASURES), ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("n_rules_run", pa.int64())]
    )
    names = ", ".join(f"{m} long" for m in MEASURES)
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return whole.mapInArrow(run, f"doc_id long, {names}, base_failed boolean, kept boolean, n_rules_run long")


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows that no rule rejects, with all their columns, whatever their names; null and empty texts go."""
    ordered = best_order(docs, rules)

    def keep(texts: list[str | None]) -> list[bool]:
        read = (Text(None if t is None else t.encode()) for t in texts)
        return [not any(r.rejects(t) for r in ordered) for t in read]

    return filtered(docs, keep)
