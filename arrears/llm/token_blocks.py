"""Token ids in patched frame-of-reference blocks.

Ids are cut into blocks of a fixed number. A block stores its minimum, and of
what is left above it the low bits, at a width that a given share of the block
fits into. The ids that do not fit go to the block's list of exceptions, place
and high bits. An index of where blocks start lets a reader get at any id.

A segment is the ids of consecutive documents: one row of a table, so that
Spark's own writers commit it and any file system will do. Segments lie in
ascending order of document ids, and every row says which documents it holds.

Segment, all numbers little-endian: magic, ids per block, ids, blocks; then the
start of every block and the end of the last; then the blocks. Block: minimum,
width, exceptions; low bits; places and high bits of the exceptions.
"""

from __future__ import annotations

import functools
import os
import re
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from arrears.llm.frames import text_key, text_or_empty
from arrears.sources.scratch import scratch_path

MAGIC, HEAD = b"PFR1", struct.Struct("<4sIQI")
# Ids in a block (a multiple of eight), share of a block that its width must fit, ids in a segment.
BLOCK, SHARE, SEGMENT = 256, 0.9, 1 << 20
_BLOCK_HEAD, _EXCEPTION = 7, 6

SEGMENTS = "part int, segment int, first bigint, doc_ids array<bigint>, lengths array<bigint>, blocks binary"


def pack_segment(ids: np.ndarray, block: int = BLOCK, share: float = SHARE) -> bytes:
    """``ids`` (below 2 ** 32) as the bytes of a segment."""
    if block % 8 or not 0 < block < 1 << 16:
        raise ValueError(f"a block must hold a multiple of eight ids below 65536, got {block}")
    n, blocks = len(ids), -(-len(ids) // block)
    if not blocks:
        return HEAD.pack(MAGIC, block, 0, 0) + struct.pack("<I", 0)
    values = np.empty(blocks * block, np.uint64)
    values[:n], values[n:] = ids, ids[-1]
    values = values.reshape(blocks, block)
    low = values.min(axis=1)
    values -= low[:, None]
    bits = _bit_lengths(values)
    width = np.partition(bits, max(0, int(np.ceil(share * block)) - 1), axis=1)[:, max(0, int(np.ceil(share * block)) - 1)]
    spills = bits > width[:, None]
    exceptions = spills.sum(axis=1)
    packed = width.astype(np.int64) * (block // 8)
    sizes = _BLOCK_HEAD + packed + _EXCEPTION * exceptions
    starts = np.concatenate([[0], np.cumsum(sizes)])
    if starts[-1] >= 1 << 32:
        raise ValueError("a segment must be smaller than 4 GiB")
    out = np.zeros(starts[-1], np.uint8)
    _put(out, starts[:-1], low, 4)
    out[starts[:-1] + 4] = width
    _put(out, starts[:-1] + 5, exceptions, 2)
    for w in np.unique(width[width > 0]).tolist():
        mine = np.flatnonzero(width == w)
        at = starts[mine] + _BLOCK_HEAD
        out[at[:, None] + np.arange(w * block // 8)] = _pack_bits(values[mine] & np.uint64((1 << w) - 1), w)
    row, place = np.nonzero(spills)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(exceptions) - exceptions, exceptions)
    tail = starts[row] + _BLOCK_HEAD + packed[row]
    _put(out, tail + 2 * nth, place, 2)
    _put(out, tail + 2 * exceptions[row] + 4 * nth, values[row, place] >> width[row].astype(np.uint64), 4)
    return HEAD.pack(MAGIC, block, n, blocks) + starts.astype("<u4").tobytes() + out.tobytes()


def unpack_segment(data: bytes, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a segment; only the blocks that hold them are read."""
    magic, block, n, blocks = HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a segment of token ids")
    stop = n if stop is None else min(stop, n)
    if start >= stop:
        return np.zeros(0, np.uint32)
    first, last = start // block, -(-stop // block)
    index = np.frombuffer(data, "<u4", blocks + 1, HEAD.size).astype(np.int64)
    body = np.frombuffer(data, np.uint8, offset=HEAD.size + 4 * (blocks + 1))
    at = index[first:last]
    low, width, exceptions = _get(body, at, 4), body[at + 4], _get(body, at + 5, 2)
    values = np.zeros((len(at), block), np.uint64)
    for w in np.unique(width[width > 0]).tolist():
        mine = np.flatnonzero(width == w)
        raw = body[(at[mine] + _BLOCK_HEAD)[:, None] + np.arange(w * block // 8)]
        values[mine] = _unpack_bits(raw, w, block)
    row = np.repeat(np.arange(len(at)), exceptions)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(exceptions) - exceptions, exceptions)
    tail = (at + _BLOCK_HEAD + width.astype(np.int64) * (block // 8))[row]
    place = _get(body, tail + 2 * nth, 2)
    high = _get(body, tail + 2 * exceptions[row] + 4 * nth, 4).astype(np.uint64)
    values[row, place] |= high << width[row].astype(np.uint64)
    values += low.astype(np.uint64)[:, None]
    return values.reshape(-1)[start - first * block : stop - first * block].astype(np.uint32)


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    """Bits that each value below 2 ** 32 needs; a double's exponent is exact there."""
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def _put(out: np.ndarray, at: np.ndarray, values: np.ndarray, n: int) -> None:
    values = values.astype(np.uint64)
    for i in range(n):
        out[at + i] = (values >> np.uint64(8 * i)).astype(np.uint8)


def _get(data: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    return sum(data[at + i].astype(np.int64) << (8 * i) for i in range(n)) + np.zeros(len(at), np.int64)


def _pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of values as rows of bytes: eight values fill ``width`` bytes."""
    rows, block = values.shape
    out = np.zeros((rows, block // 8, width), np.uint8)
    for r in range(8):
        at, shift = divmod(r * width, 8)
        moved = values[:, r::8] << np.uint64(shift)
        for i in range(-(-(shift + width) // 8)):
            out[:, :, at + i] |= (moved >> np.uint64(8 * i)).astype(np.uint8)
    return out.reshape(rows, -1)


def _unpack_bits(raw: np.ndarray, width: int, block: int) -> np.ndarray:
    groups = raw.reshape(len(raw), block // 8, width).astype(np.uint64)
    out = np.empty((len(raw), block), np.uint64)
    for r in range(8):
        at, shift = divmod(r * width, 8)
        value = groups[:, :, at].copy()
        for i in range(1, -(-(shift + width) // 8)):
            value |= groups[:, :, at + i] << np.uint64(8 * i)
        out[:, r::8] = value >> np.uint64(shift) & np.uint64((1 << width) - 1)
    return out


class WordEncoder(dict):
    """Ids of whole texts by a tokenizer that drops white space, kept by word.

    Such a tokenizer gives a text the ids of its words one after another, so a
    word that was met before is looked up. Text is cut at spaces and line ends
    only. A new word of Latin characters is parted and lower-cased here, as the
    tokenizer's file says, and its parts go to the library's BPE model one by
    one; any other word goes to the whole tokenizer. At most ``words`` words
    and as many parts are held; beyond that the store starts anew.
    """

    # The parts of a word by the tokenizer's file, for characters below U+0180; the letters and numbers there.
    _LETTERS = "a-zA-Z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f"
    _NUMBERS = "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
    _PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_LETTERS}{_NUMBERS}]+")
    # Neither control characters nor other white space, nor the one letter whose lower case is two characters.
    _LATIN = re.compile("[\u0021-\u007e\u00a1-\u012f\u0131-\u017f]+")

    def __init__(self, path: str, words: int = 600_000, longest: int = 64) -> None:
        super().__init__({"": b""})
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.specials = tuple(t.content[:2] for t in self.tokenizer.get_added_tokens_decoder().values())
        self.words, self.longest = words, longest
        self.parts: dict[str, bytes] = {}
        # Byte-level BPE writes every byte as a character: itself where that can be seen, else one from 256 on.
        seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
        unseen = [byte for byte in range(256) if byte not in set(seen)]
        self.letters = {byte: chr(byte) for byte in seen} | {byte: chr(256 + i) for i, byte in enumerate(unseen)}

    def numbers(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and how many each text has.

        Every different word of the texts is looked up once.
        """
        split = pc.split_pattern(pc.replace_substring(texts.cast(pa.large_string()), "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        found = list(map(self.__getitem__, coded.dictionary.to_pylist()))
        if len(self) > self.words:
            self.clear()
            self[""] = b""
        if len(self.parts) > self.words:
            self.parts.clear()
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        own, word = np.frombuffer(b"".join(found), "<u4"), coded.indices.to_numpy()
        starts, n = (np.cumsum(sizes) - sizes)[word], sizes[word]
        ends = np.concatenate([[0], np.cumsum(n)])
        ids = own[np.repeat(starts - ends[:-1], n) + np.arange(ends[-1])]
        offsets = split.offsets.to_numpy()
        return ids, np.diff(ends[offsets - offsets[0]])

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        ids, sizes = self.numbers(pa.array(texts, pa.string()))
        ends = np.cumsum(sizes).tolist()
        return [ids[end - n : end].tobytes() for end, n in zip(ends, sizes.tolist())]

    def __missing__(self, word: str) -> bytes:
        if self._LATIN.fullmatch(word) and not any(mark in word for mark in self.specials):
            ids = b"".join([self.parts.get(part) or self._part(part) for part in self._PARTS.findall(word.lower())])
        else:
            found = self.tokenizer.encode(word, add_special_tokens=False).ids
            ids = struct.pack(f"<{len(found)}I", *found)
        if len(word) <= self.longest:
            self[word] = ids
        return ids

    def _part(self, part: str) -> bytes:
        written = part if part.isascii() else "".join(map(self.letters.__getitem__, part.encode()))
        found = [token.id for token in self.tokenize(written)]
        ids = struct.pack(f"<{len(found)}I", *found)
        if len(part) <= self.longest:
            self.parts[part] = ids
        return ids


def _portions(texts: pa.Array, size: int = 16 << 20) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive texts of up to ``size`` bytes, or one longer text, with the place of the first."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64)
    at = 0
    while at < len(sizes):
        n = max(1, int(np.searchsorted(np.cumsum(sizes[at:]), size, side="right")))
        yield at, texts.slice(at, n)
        at += n


@functools.cache
def _encoder(path: str) -> WordEncoder:
    """One store of words for all tasks of a Python worker."""
    return WordEncoder(path)


def segments(
    docs: DataFrame,
    tokenizer: str = "word_bpe_49k.json",
    end_id: int = 2,
    block: int = BLOCK,
    share: float = SHARE,
    segment: int = SEGMENT,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The documents' ids as rows of ``SEGMENTS``, in ascending order of document ids.

    Texts are dealt out by ranges of the id, so that every task holds the next
    range; rows that repeat an id are ordered and parted by their text. ``part``
    numbers the tasks, ``segment`` the rows of a task, ``first`` counts a task's
    ids before the row. A segment ends with the document that fills it. A null
    text is empty and has only ``end_id``; a null id comes before all others.
    No rows give no rows. Other columns are not read.
    """
    types = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
    names = [c.split()[0] for c in SEGMENTS.split(", ")]
    end = np.array([end_id], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(public_tokenizers.path(tokenizer)), TaskContext.get().partitionId()
        ids: list[int | None] = []
        raw: list[np.ndarray] = []
        held = number = first = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, number, first
            lengths = [len(r) for r in raw]
            packed = pack_segment(np.concatenate(raw), block, share)
            row = (part, number, first, list(ids), lengths, packed)
            first, number, held = first + held, number + 1, 0
            ids.clear(), raw.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

        for batch in batches:
            keys = batch.column(0).to_pylist()
            for at, texts in _portions(batch.column(1)):
                found, sizes = encoder.numbers(texts)
                ends = np.cumsum(sizes).tolist()
                for key, stop, n in zip(keys[at:], ends, sizes.tolist()):
                    ids.append(key)
                    raw.append(np.concatenate([found[stop - n : stop], end]))
                    held += n + 1
                    if held >= segment:
                        yield flush()
        if ids:
            yield flush()

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("text"))
    order = ["doc_id", text_key("text")]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, SEGMENTS)


def write_tokens(docs: DataFrame, path: str, **options) -> None:
    """Write ``segments`` of ``docs`` to the folder ``path``."""
    # Packed bits do not shrink further.
    segments(docs, **options).write.option("compression", "none").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids``
    (little-endian unsigned 32-bit numbers) of every document in the folder."""
    names = ["doc_id", "start", "n_tokens", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                start, doc_ids, lengths, blocks = (batch.column(c)[i] for c in range(4))
                lengths = lengths.values.to_numpy()
                raw = unpack_segment(blocks.as_py()).astype("<u4").tobytes()
                cuts = np.concatenate([[0], np.cumsum(lengths)])
                ids = [raw[4 * a : 4 * b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
                starts = pa.array(start.as_py() + cuts[:-1])
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.values, starts, pa.array(lengths), pa.array(ids, pa.binary())], names=names
                )

    rows = spark.read.schema(SEGMENTS).parquet(path)
    sizes = F.aggregate("lengths", F.lit(0).cast("bigint"), lambda total, n: total + n)
    totals = rows.select("part", sizes.alias("n")).groupBy("part").agg(F.sum("n").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per task that wrote, whatever the number of documents: small enough for one task and a broadcast.
    bases = totals.select(F.col("part").alias("_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = rows.join(F.broadcast(bases), F.col("part") == F.col("_part"))
    placed = placed.select((F.col("base") + F.col("first")).alias("start"), "doc_ids", "lengths", "blocks")
    return placed.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def written_and_read(docs: DataFrame, **options) -> DataFrame:
    """``read_tokens`` of what ``write_tokens`` has just put into the shared folder."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, **options)
    return read_tokens(docs.sparkSession, path)
