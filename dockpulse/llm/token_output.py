"""Token ids in binary files: blocks of ids in byte or bit planes, each compressed with zstandard, with a chunk index."""

from __future__ import annotations

import os
import zlib
from codecs import charmap_decode
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, islice
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockpulse.session import work_path

END_ID = 1
CHUNK_IDS = 1 << 14
FILE_CHUNKS = 64
# Words kept by a worker, and how many stay when they are too many: the earliest met, which are the frequent ones.
CACHED_WORDS, LASTING_WORDS = 180_000, 120_000
PORTION_BYTES, PORTION_ROWS = 2 << 20, 512
# New words that are looked at together.
LEARNT_WORDS = 1 << 12
CLOSING = b".,;:!?"
_IS_CLOSING = np.isin(np.arange(256), list(CLOSING))
_IS_PLAIN = np.isin(np.arange(256), list(b"0123456789abcdefghijklmnopqrstuvwxyz"))
# The characters that byte-level tokenizers write bytes as: printable Latin-1 as it is, the rest from U+0100 on.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_HIDDEN = [b for b in range(256) if b not in _SHOWN]
BYTE_LETTERS = "".join(chr(b if b in _SHOWN else 0x100 + _HIDDEN.index(b)) for b in range(256))
LEVEL = 3

FILE_SCHEMA = (
    "part int, file int, planes string, doc_ids array<bigint>, doc_sizes array<bigint>, continues boolean, "
    "chunks array<struct<n_ids:int,offset:bigint,plane_bytes:array<int>>>, payload binary"
)


def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """Planes of a block of 32-bit ids: plane j holds byte (or bit) j of every id, lowest first."""
    cells = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return [plane.tobytes() for plane in np.ascontiguousarray(cells.T)]
    bits = np.unpackbits(cells, axis=1, bitorder="little")
    return [np.packbits(plane).tobytes() for plane in np.ascontiguousarray(bits.T)]


def from_planes(planes: list[bytes], count: int, kind: str) -> np.ndarray:
    if kind == "byte":
        cells = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1) if count else np.empty((0, 4), np.uint8)
    else:
        bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=count) for p in planes], axis=1)
        cells = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(cells).reshape(-1).view("<u4")


class WordEncoder:
    """Ids of texts, with the ids of up to ``CACHED_WORDS`` words kept.

    The tokenizer splits at white space and joins nothing across it, so a text's ids are those of its words in turn.  It ignores
    case and splits a word before closing punctuation, so texts are put in lower case and split there too, and only the core of a
    new word is encoded.  Words that its normalization would compose, as they are or in lower case, are encoded as they are.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Words are made of one or two forms; form 0 is empty.
        self.number, self.form = defaultdict[bytes, int](), defaultdict[bytes, int](int, {b"": 0})
        self.number.default_factory, self.form.default_factory = self.number.__len__, self.form.__len__
        self.forms_of = np.empty((0, 2), np.int64)
        self.sizes, self.first, self.flat = np.zeros(1, np.int64), np.zeros(1, np.int64), np.empty(0, "<u4")

    @staticmethod
    def of_worker(path: str) -> WordEncoder:
        """One encoder for all tasks of a worker process."""
        import tokenizers

        kept = tokenizers.__dict__.setdefault("_word_encoders", {})
        if path not in kept:
            kept[path] = WordEncoder(path)
        return kept[path]

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text, followed by the end id."""
        joined = b"\n".join(texts)
        if b"<|" not in joined and (joined.isascii() or _composed(joined)):
            texts = _spaced(joined.lower(), np.cumsum([len(t) + 1 for t in texts]))
        split = [t.split() for t in texts]
        counts = np.array([len(w) for w in split], np.int64)
        if len(self.number) > CACHED_WORDS:
            self._forget()
        known, total = len(self.number), int(counts.sum())
        numbers = np.fromiter(map(self.number.__getitem__, chain.from_iterable(split)), np.int64, total)
        self._learn(_youngest(self.number, len(self.number) - known))
        forms = self.forms_of[numbers].reshape(-1)
        sizes = self.sizes[forms]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.flat[np.repeat(self.first[forms] - ends[:-1], sizes) + np.arange(ends[-1])]
        bounds = ends[2 * np.concatenate([[0], np.cumsum(counts)])]
        ids = np.insert(ids, bounds[1:], END_ID)
        return np.split(ids, bounds[1:-1] + np.arange(1, len(texts))) if texts else []

    def _forget(self) -> None:
        for _ in range(len(self.number) - LASTING_WORDS):
            self.number.popitem()
        self.forms_of = self.forms_of[:LASTING_WORDS].copy()
        forms = int(self.forms_of.max(initial=0)) + 1
        for _ in range(len(self.form) - forms):
            self.form.popitem()
        self.sizes, self.first = self.sizes[:forms].copy(), self.first[:forms].copy()
        self.flat = self.flat[: self.first[-1] + self.sizes[-1]].copy()

    def _learn(self, words: list[bytes]) -> None:
        forms, start, cores, tails = self.form, len(self.form), [], []
        for at in range(0, len(words), LEARNT_WORDS):
            for own, more in zip((cores, tails), self._cores(words[at : at + LEARNT_WORDS]), strict=True):
                own += more
        pairs = np.zeros((len(words), 2), np.int64)
        pairs[:, 0] = np.fromiter(map(forms.__getitem__, cores), np.int64, len(words))
        pairs[:, 1] = np.fromiter(map(forms.__getitem__, tails), np.int64, len(words))
        self.forms_of = np.concatenate([self.forms_of, pairs])
        new = [form.decode() for form in _youngest(forms, len(forms) - start)]
        sizes, flat = self._ids(new)
        self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(sizes) - sizes])
        self.flat = np.concatenate([self.flat, flat])
        self.sizes = np.concatenate([self.sizes, sizes])

    def _ids(self, forms: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of ids, ids) of forms.

        Letters up to U+024F are one piece to the tokenizer.  It would hand them to its model in lower case and byte by byte, so they
        go there directly.
        """
        model, found = self.tokenizer.model.tokenize, []
        for form in forms:
            letters = None
            if form.isascii():
                letters = form if form.isalpha() else None
            elif form.isalpha() and (small := form.lower()).isalpha() and max(small) <= "\u024f":
                letters = charmap_decode(small.encode(), "strict", BYTE_LETTERS)[0]
            found.append(None if letters is None else [t.id for t in model(letters)])
        other = [f for f, ids in zip(forms, found, strict=True) if ids is None]
        encoded = iter(self.tokenizer.encode_batch_fast(other, add_special_tokens=False) if other else [])
        found = [next(encoded).ids if ids is None else ids for ids in found]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return sizes, np.fromiter(chain.from_iterable(found), "<u4", int(sizes.sum()))

    def _cores(self, words: list[bytes]) -> tuple[list[bytes], list[bytes]]:
        """``_core`` of many words, which have no white space; what holds for all of them is asked once."""
        joined = b"\n".join(words)
        low = joined.lower()
        if b"<|" in joined or not (joined.isascii() or _composed(joined)):
            return tuple(map(list, zip(*map(self._core, words), strict=True)))
        words = low.split(b"\n")
        cores, tails = [w.rstrip(CLOSING) for w in words], [b""] * len(words)
        for i, (word, core) in enumerate(zip(words, cores, strict=True)):
            if len(core) != len(word):
                cores[i], tails[i] = self._core(word)
        return cores, tails

    @staticmethod
    def _core(word: bytes) -> tuple[bytes, bytes]:
        """The word without closing punctuation, and that; in lower case where this cannot make a special token."""
        if b"<|" in word:
            return word, b""
        if not word.isascii() and not _composed(word):
            return word, b""  # the tokenizer composes letters first, and J with a caron has a composed form only when small
        word = word.lower()
        core = word.rstrip(CLOSING)
        if len(core) == len(word) or not core:
            return word, b""
        last = core[-1]
        if last >= 0x80:
            letter = core.decode()[-1]
            if letter > "\u024f" or not letter.lower().isalpha():
                return word, b""
        elif not (0x30 <= last <= 0x39 or 0x61 <= last <= 0x7A):
            return word, b""
        return core, word[len(core) :]


def _spaced(joined: bytes, ends: np.ndarray) -> list[bytes]:
    """The texts that end at ``ends``, with a space between a letter or number and closing punctuation."""
    codes = np.frombuffer(joined, np.uint8)
    at = np.flatnonzero(_IS_PLAIN[codes[:-1]] & _IS_CLOSING[codes[1:]]) + 1
    whole = np.insert(codes, at, 0x20).tobytes()
    ends = (ends + np.searchsorted(at, ends)).tolist()
    return [whole[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def _composed(text: bytes) -> bool:
    """Whether the tokenizer would compose no letters, in the text as it is and with A-Z in lower case."""
    return is_normalized("NFC", text.decode()) and is_normalized("NFC", text.lower().decode())


def _youngest(known: dict, count: int) -> list[bytes]:
    """The keys added last, in the order in which they came."""
    return list(islice(reversed(known), count))[::-1]


def _portions(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Stretches of about ``PORTION_BYTES``, so that few words are held at a time."""
    start = size = 0
    for i, text in enumerate(texts, 1):
        size += len(text)
        if size >= PORTION_BYTES or i == len(texts):
            yield start, i
            start, size = i, 0


def encode(docs: DataFrame, tokenizer_path: str, planes: str = "byte") -> DataFrame:
    """The files' rows: one row is one file of up to ``FILE_CHUNKS`` blocks of ``CHUNK_IDS`` ids, in ascending document order.

    A document may run over several files; ``continues`` says that a file's first document began in the one before.
    Documents are dealt by ranges of ids, so no sort is global.  Equal ids are ordered by their texts, null ids come last.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, packer, part = WordEncoder.of_worker(tokenizer_path), zstandard.ZstdCompressor(LEVEL), TaskContext.get().partitionId()
        limit, file = CHUNK_IDS * FILE_CHUNKS, 0
        names, sizes, held, filled, continues = [], [], [], 0, False

        def close() -> pa.RecordBatch:
            ids = np.concatenate(held) if held else np.empty(0, "<u4")
            index, blob, offset = [], [], 0
            for at in range(0, len(ids), CHUNK_IDS):
                block = ids[at : at + CHUNK_IDS]
                packed = [packer.compress(p) for p in to_planes(block, planes)]
                lengths = [len(p) for p in packed]
                index.append({"n_ids": len(block), "offset": offset, "plane_bytes": lengths})
                offset += sum(lengths)
                blob += packed
            row = {
                "part": part, "file": file, "planes": planes, "doc_ids": names, "doc_sizes": sizes,
                "continues": continues, "chunks": index, "payload": b"".join(blob),
            }
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in (b.slice(at, PORTION_ROWS) for b in batches for at in range(0, b.num_rows, PORTION_ROWS)):
            texts = [t or b"" for t in batch.column("text").to_pylist()]
            ids_of = (ids for a, b in _portions(texts) for ids in encoder.encode(texts[a:b]))
            for doc, ids in zip(batch.column("doc_id").to_pylist(), ids_of, strict=True):
                begun = False
                while len(ids):
                    take = min(len(ids), limit - filled)
                    names.append(doc)
                    sizes.append(take)
                    held.append(ids[:take])
                    filled += take
                    ids, whole = ids[take:], take == len(ids)
                    begun = True
                    if filled == limit:
                        yield close()
                        file, filled, continues = file + 1, 0, begun and not whole
                        names, sizes, held = [], [], []
        if held:
            yield close()

    chunk = pa.struct([("n_ids", pa.int32()), ("offset", pa.int64()), ("plane_bytes", pa.list_(pa.int32()))])
    schema = pa.schema(
        [("part", pa.int32()), ("file", pa.int32()), ("planes", pa.string()), ("doc_ids", pa.list_(pa.int64()))]
        + [("doc_sizes", pa.list_(pa.int64())), ("continues", pa.bool_()), ("chunks", pa.list_(chunk)), ("payload", pa.binary())]
    )
    body = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body.alias("text"))
    order = F.asc_nulls_last("doc_id")
    return rows.repartitionByRange(order).sortWithinPartitions(order, "text").mapInArrow(write, FILE_SCHEMA)


def write_ids(docs: DataFrame, path: str, tokenizer_path: str, planes: str = "byte") -> None:
    """Write the ids of every whole text, each followed by ``END_ID``.

    The files are rows of a Parquet folder, so that any store that Spark writes to holds them, and a lost task writes
    its part again.  Needs ``doc_id`` and ``text``; others are left out.  A null text is empty: its only id is ``END_ID``.
    """
    encode(docs, tokenizer_path, planes).write.parquet(path)


def read_ids(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from its files.

    ``start`` is the number of ids of all documents before it.  One file is open at a time; documents that run over several are
    carried on.  Only the sizes of the parts, one number a writing task, are summed in one place.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker, current, rows = zstandard.ZstdDecompressor(), None, []
        place, base = 0, 0

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [()] * 4
            batch = pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "n_tokens", "ids_crc32"])
            rows.clear()
            return batch

        for batch in batches:
            for row in (r for at in range(batch.num_rows) for r in batch.slice(at, 1).to_pylist()):
                if row["part"] != current:
                    current, base, place = row["part"], row["base"], 0
                blob, ids = memoryview(row["payload"]), []
                for chunk in row["chunks"]:
                    at, planes = chunk["offset"], []
                    for length in chunk["plane_bytes"]:
                        planes.append(unpacker.decompress(blob[at : at + length]))
                        at += length
                    ids.append(from_planes(planes, chunk["n_ids"], row["planes"]))
                ids, at = np.concatenate(ids), 0
                for i, (doc, size) in enumerate(zip(row["doc_ids"], row["doc_sizes"], strict=True)):
                    raw = ids[at : at + size].tobytes()
                    at += size
                    if i == 0 and row["continues"]:
                        _, start, count, crc = rows.pop()
                        rows.append((doc, start, count + size, zlib.crc32(raw, crc)))
                    else:
                        rows.append((doc, base + place, size, zlib.crc32(raw)))
                    place += size
                last = rows.pop()
                if rows:
                    yield out()
                rows.append(last)
        yield out()

    sizes = files.groupBy("part").agg(F.sum(F.aggregate("doc_sizes", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("base"))
    ordered = files.join(bases, "part").repartition("part").sortWithinPartitions("part", "file")
    return ordered.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encoded(docs: DataFrame, tokenizer_path: str, planes: str = "byte") -> DataFrame:
    """Write the files below the shared folder and read them back."""
    spark = docs.sparkSession
    path = work_path(spark, "token-ids")
    write_ids(docs, path, tokenizer_path, planes)
    return read_ids(spark.read.schema(FILE_SCHEMA).parquet(path))
