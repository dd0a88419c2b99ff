"""Suffix-array dedup by bucket-pointer refinement."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from dockpulse.llm.repeats import covered, in_blocks, without_covered

MIN_BYTES = 50
ANCHOR_BYTES = 20
SEED_BYTES = 8


def _buckets(keys: np.ndarray) -> np.ndarray:
    """Bucket identifiers in sorted order of the keys."""
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


def refined_buckets(text: np.ndarray, k: int) -> np.ndarray:
    """Bucket identifier of the ``k`` bytes at each place of ``text``, in lexical order of those bytes.

    Initial buckets are q-grams.  A refinement sorts the members of a bucket by the bucket identifier of a later offset; the
    refined identifiers are the pointers of the next refinement, so the depth doubles.  Buckets of one member are
    final and take no part.  Bytes behind the end count as smaller than all others.
    """
    n = len(text)
    depth = min(SEED_BYTES, k)
    padded = np.concatenate([text, np.zeros(depth, np.uint8)])
    seed = np.zeros(n, np.uint64)
    for j in range(depth):
        seed = (seed << np.uint64(8)) | padded[j : n + j]
    ids = _buckets(seed)
    while depth < k:
        step = min(depth, k - depth)
        sizes = np.bincount(ids)
        members = np.flatnonzero(sizes[ids] > 1)
        later = np.zeros(len(members), np.int64)
        inside = members + step < n
        later[inside] = ids[members[inside] + step] + 1
        order = np.lexsort((later, ids[members]))
        a, b = ids[members][order], later[order]
        # The rank of a refined bucket is its old bucket's first rank plus the members sorted before it.
        start = np.cumsum(sizes) - sizes
        ranks = start[ids]
        if len(members):
            first = np.ones(len(a), bool)
            first[1:] = a[1:] != a[:-1]
            fresh = first.copy()
            fresh[1:] |= b[1:] != b[:-1]
            at = np.arange(len(a))
            group_start = np.maximum.accumulate(np.where(first, at, 0))
            bucket_start = np.maximum.accumulate(np.where(fresh, at, 0))
            ranks[members[order]] = start[a] + bucket_start - group_start
        ids = ranks
        depth += step
    return ids


def earlier_windows(groups: list[list[tuple[int, bytes]]], k: int) -> list[list[np.ndarray]]:
    """For each (document, bytes): window starts that a smaller document of its group holds."""
    pieces = [p for group in groups for p in group]
    sizes = np.array([len(text) for _, text in pieces])
    text = np.frombuffer(b"".join(t for _, t in pieces), np.uint8)
    starts = np.cumsum(sizes) - sizes
    docs = np.repeat(np.array([doc for doc, _ in pieces], np.int64), sizes)
    place = np.arange(len(text)) - np.repeat(starts, sizes)
    full = np.flatnonzero(place <= np.repeat(sizes, sizes) - k)
    ids = refined_buckets(text, k)[full]
    oldest = np.full(len(text) + 1, np.iinfo(np.int64).max)
    np.minimum.at(oldest, ids, docs[full])
    older = full[oldest[ids] < docs[full]]
    bounds = np.searchsorted(older, np.append(starts, len(text)))
    flat = [older[a:b] - s for a, b, s in zip(bounds[:-1], bounds[1:], starts, strict=True)]
    out, at = [], 0
    for group in groups:
        out.append(flat[at : at + len(group)])
        at += len(group)
    return out


def remove_repeats(docs: DataFrame, min_bytes: int = MIN_BYTES, anchor_bytes: int = ANCHOR_BYTES) -> DataFrame:
    """Remove each byte covered by ``min_bytes`` bytes that also stand in a document with a smaller id.

    Needs columns ``doc_id`` and ``text``; others are left out.  Returns (doc_id, kept, n_units, n_removed, n_spans),
    one row for each input row; ``kept`` holds the bytes left, which need not be valid UTF-8.

    One suffix array of the whole corpus would need a global sort of all suffixes.  Here every suffix array is that of the
    passages under one content anchor, which hold all places of each string that starts in them (see ``repeats``), so the
    arrays are bounded and independent.  Matches never cross documents and are judged on the input.

    A null text is empty.  A row with a null id is neither judged nor used as a reference.  Rows with equal ids are not
    older than one another, so repeated rows come out alike.  Texts shorter than ``min_bytes`` stay whole.
    """

    def solve(groups: list[list[tuple[int, bytes]]]) -> list[list[np.ndarray]]:
        return earlier_windows(groups, min_bytes)

    blocks = in_blocks(docs)
    spans = covered(blocks, "bytes", min_bytes, min(anchor_bytes, min_bytes), solve)
    return without_covered(blocks, spans, "bytes", min_bytes)
