"""Mixing sources to target weights: temperature by bisection, realised as budgeted block permutations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockpulse.llm.columns import whole_row
from dockpulse.session import stage

MAX_REPEATS = 2.0
EXPONENT_STEPS = 1024
BLOCK_TOKENS = 1_000_000
# Documents of a source that are ordered in one group.
GROUP_DOCUMENTS = 4096
WORD = "[^\\x20\\x09-\\x0D]+"


def _same(a: DataFrame, b: DataFrame, *keys: str) -> Column:
    """Equality of keys that holds for nulls too."""
    out = a[keys[0]].eqNullSafe(b[keys[0]])
    for key in keys[1:]:
        out &= a[key].eqNullSafe(b[key])
    return out


def exponent(sources: DataFrame, max_repeats: float | None = MAX_REPEATS, min_entropy: float | None = None) -> float:
    """The exponent of the token shares, a multiple of 1/``EXPONENT_STEPS`` from 0 (equal weights) to 1 (as they are).

    With ``max_repeats``: the smallest at which no source is read more often than that while none is read less than once.
    With ``min_entropy`` (bits): the largest at which the weights have that entropy (0 if none has).
    Both are monotone in the exponent; each step of the bisection is one aggregate over the sources.
    """
    filled = sources.where("tokens > 0")
    total = filled.agg(F.sum("tokens")).first()[0]
    if not total:
        return 1.0

    def holds(step: int) -> bool:
        power = F.pow(F.col("tokens") / F.lit(float(total)), F.lit(step / EXPONENT_STEPS))
        if min_entropy is not None:
            row = filled.agg(F.sum(power), F.sum(power * F.log2(power))).first()
            return bool(_entropy(row[0], row[1]) >= min_entropy)
        often = power / F.col("tokens")
        row = filled.agg(F.max(often), F.min(often)).first()
        return row[0] / row[1] <= max_repeats

    # Entropy holds up to a step, repetition from a step on.
    low, high = 0, EXPONENT_STEPS
    if min_entropy is not None:
        if not holds(0):
            return 0.0
        if holds(high):
            return 1.0
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if holds(middle) else (low, middle)
        return low / EXPONENT_STEPS
    if holds(0):
        return 0.0
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (low, middle) if holds(middle) else (middle, high)
    return high / EXPONENT_STEPS


def _entropy(norm: float, weighted_logs: float) -> float:
    """Bits of entropy of powers p with sum ``norm`` and sum of p * log2(p) ``weighted_logs``."""
    from math import log2

    return log2(norm) - weighted_logs / norm


def weights(sources: DataFrame, power: float) -> DataFrame:
    """(source, tokens, documents, weight, quota): normalised weights and the tokens that each source gives.

    The budget is the smallest at which no source loses documents: the source that is read least is read once.
    """
    raised = sources.withColumn("power", F.when(F.col("tokens") > 0, F.pow(F.col("tokens").cast("double"), F.lit(power))))
    sums = raised.agg(F.sum("power").alias("norm"), F.max(F.col("tokens") / F.col("power")).alias("scale")).first()
    return raised.select(
        "source",
        "tokens",
        "documents",
        F.coalesce(F.col("power") / F.lit(sums["norm"]), F.lit(0.0)).alias("weight"),
        F.greatest(F.round(F.col("power") * F.lit(sums["scale"])).cast("long"), "tokens").alias("quota"),
    )


def mixture(docs: DataFrame, max_repeats: float = MAX_REPEATS, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(doc_id, digest, source, n_rows, n_tokens, weight, epoch, tokens_before, block): one row for each time a text is read.

    An epoch is a permutation of a source by hash; the last one ends where the source's quota of tokens is reached, every
    whole one before holds all documents.  A text's ``block`` comes from its place in its source's stream, so each block of
    about ``block_tokens`` holds the sources in their weights, and blocks can be trained on in order.

    Running sums come in two levels, groups of about ``GROUP_DOCUMENTS`` and their totals, so a source with a third of all rows
    is ordered in as many tasks as its size asks for.  A null source is a source of its own.  Equal rows count
    as one text that gives ``n_rows`` rows each time.  Null and empty texts have no tokens and are read once in every
    whole epoch.  Needs ``doc_id``, ``text`` and ``source``; others are left out.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(F.coalesce("text", F.lit(""))).alias("digest"), "source", size.alias("n_tokens"))
    texts = stage(
        texts.groupBy("doc_id", "digest", "source").agg(F.count("*").alias("n_rows"), F.sum("n_tokens").alias("n_tokens")),
        "mixing-texts",
    )
    sources = stage(texts.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("documents")), "mixing-sources")
    plan = stage(weights(sources, exponent(sources, max_repeats)), "mixing-weights")
    budget = plan.agg(F.sum("quota")).first()[0] or 0
    blocks = max(1, -(-budget // block_tokens))

    planned = texts.join(plan, _same(texts, plan, "source")).drop(plan["source"])
    whole = F.when(F.col("tokens") > 0, F.floor(F.col("quota") / F.col("tokens"))).otherwise(1)
    last = F.when((F.col("tokens") > 0) & (F.col("quota") > whole * F.col("tokens")), whole).otherwise(whole - 1)
    read = planned.select("*", whole.alias("whole"), F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("epoch"))
    name = F.concat_ws("|", F.col("epoch").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "digest")
    place = F.conv(F.substring(F.md5(name), 1, 12), 16, 10).cast("long")
    groups = F.ceil(F.col("documents") / F.lit(GROUP_DOCUMENTS))
    read = read.withColumn("place", place).withColumn("part", F.floor(F.col("place") * groups / F.lit(float(1 << 48))).cast("long"))

    totals = read.groupBy("source", "epoch", "part").agg(F.sum("n_tokens").alias("part_tokens"))
    before = Window.partitionBy("source", "epoch").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("source", "epoch", "part", F.coalesce(F.sum("part_tokens").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source", "epoch", "part").orderBy("place", "doc_id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    read = read.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    read = read.join(totals, _same(read, totals, "source", "epoch", "part")).select(read["*"], totals["base"])
    at = F.col("base") + F.col("inside")
    stream = F.col("epoch") * F.col("tokens") + at
    block = F.least(F.floor(stream * F.lit(blocks) / F.greatest(F.col("quota"), F.lit(1))), F.lit(blocks - 1)).cast("long")
    return read.where((F.col("epoch") < F.col("whole")) | (stream < F.col("quota"))).select(
        "doc_id", "digest", "source", "n_rows", "n_tokens", "weight", "epoch", stream.alias("tokens_before"), block.alias("block")
    )


def mixed(docs: DataFrame, max_repeats: float = MAX_REPEATS) -> DataFrame:
    """The rows of ``docs``, each as often as the mixture reads it (at least once), with all their columns, whatever their names."""
    times = mixture(docs, max_repeats).groupBy("doc_id", "digest", "source").agg(F.count("*").alias("times"))
    digest = F.md5(F.coalesce("text", F.lit(""))).alias("digest")
    rows = docs.select(whole_row(docs), F.col("doc_id").cast("long").alias("doc_id"), digest, "source")
    read = rows.join(times, _same(rows, times, "doc_id", "digest", "source")).select("row", "times")
    return read.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).select("row.*")
