"""Vector best-fit packing of tokenised documents into sequences.

A sequence has capacities in tokens, documents and attention cost (the sum of
squared lengths). Pieces go, longest first, to the open sequence that fits
them best in all three at once. Spark tokenises, numbers and deals pieces out
to groups of a bounded size; a group is large enough that its last, partly
filled sequences do not matter.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.llm.bpe import Encoder
from arrears.sources.scratch import stage

_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, slot bigint"
_PACKED = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds. By default only tokens bind: no split of 2048
    tokens has more documents or a higher sum of squares than these.

    ``rule`` picks among the sequences that can take a piece: ``norm`` the one
    with the smallest weighted norm of what is left in it, ``dot`` the one
    whose room is most in line with the piece (weighted dot product).
    """

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.01, 0.1)
    rule: str = "norm"

    def __post_init__(self) -> None:
        if self.rule not in ("norm", "dot"):
            raise ValueError(f"rule must be 'norm' or 'dot', got {self.rule!r}")
        if min(self.tokens, self.documents) < 1 or self.attention < self.tokens**2:
            raise ValueError("a sequence must be able to hold one full piece")


def best_fit(lengths: np.ndarray, capacity: Capacity = Capacity()) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of every piece; longest first, ties in the given order."""
    limits = np.array([capacity.tokens, capacity.documents, capacity.attention], float)
    weights = np.array(capacity.weights) / limits**2
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    if not len(lengths):
        return sequence, offset
    order = np.argsort(-lengths, kind="stable")
    shortest = lengths.min()
    # Room of the open sequences by column, and their numbers.
    room, number = np.zeros((3, 1024)), np.zeros(1024, np.int64)
    n_open = n_made = 0
    for i in order.tolist():
        length = int(lengths[i])
        need = np.array([length, 1, length * length], float)
        chosen = -1
        if n_open:
            left = room[:, :n_open] - need[:, None]
            if capacity.rule == "norm":
                score = weights @ (left * left)
            else:
                score = -((weights * need) @ room[:, :n_open])
            score[(left < 0).any(axis=0)] = np.inf
            chosen = int(score.argmin())
            if score[chosen] == np.inf:
                chosen = -1
        if chosen < 0:
            if n_open == room.shape[1]:
                room, number = np.concatenate([room, room], 1), np.concatenate([number, number])
            chosen, n_open = n_open, n_open + 1
            room[:, chosen], number[chosen] = limits, n_made
            n_made += 1
        sequence[i], offset[i] = number[chosen], capacity.tokens - room[0, chosen]
        room[:, chosen] -= need
        if room[0, chosen] < shortest or room[1, chosen] < 1:
            n_open -= 1
            room[:, chosen], number[chosen] = room[:, n_open], number[n_open]
    return sequence, offset


def pieces(
    docs: DataFrame,
    capacity: Capacity = Capacity(),
    ranks: str = "byte_bpe_50k.tiktoken",
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece of every document: id, number, start, length, CRC-32 and a ``slot``.

    A document's ids end with id 0; a null text is empty and has that id only.
    A document of more than ``capacity.tokens`` ids is cut into full pieces,
    the first may be shorter. ``slot`` numbers the rows of a task's output:
    store the frame before dealing pieces out by it.
    """
    size = capacity.tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(public_tokenizers.path(ranks), public_tokenizers.PATTERN)
        slot = TaskContext.get().partitionId() << 40
        names = [c.split()[0] for c in _PIECES.split(", ")]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            rows = []
            for at in range(0, len(ids), 256):
                part = [t or "" for t in texts.slice(at, 256).to_pylist()]
                for doc, raw in zip(ids[at : at + 256], encoder.encode(part)):
                    raw += b"\0\0\0\0"
                    n = len(raw) // 4
                    start, end, piece = 0, n % size or size, 0
                    while start < n:
                        crc = zlib.crc32(raw[4 * start : 4 * end])
                        rows.append((doc, piece, start, end - start, crc, slot))
                        start, end, piece, slot = end, end + size, piece + 1, slot + 1
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return docs.select(F.col(doc_id).cast("bigint"), F.col(text)).mapInArrow(run, _PIECES)


def pack(
    docs: DataFrame,
    capacity: Capacity = Capacity(),
    ranks: str = "byte_bpe_50k.tiktoken",
    group: int = 20_000,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pieces with the sequence they are in and their offset there, gapless from 0.

    Groups of about ``group`` pieces, picked by a hash of the slot and so of an
    even size whatever ids repeat, are packed on their own. Full pieces have a
    sequence each. Rows that repeat an id are documents of their own; no rows
    give no rows. Other columns are not read.
    """
    rows = stage(pieces(docs, capacity, ranks, doc_id, text), "pieces")
    full = F.col("length") == capacity.tokens
    groups = max(1, math.ceil(rows.filter(~full).count() / group))
    part = F.pmod(F.xxhash64("slot"), F.lit(groups))
    packed = rows.filter(~full).withColumn("part", part).groupBy("part").applyInArrow(_packer(capacity), _PACKED)
    alone = rows.filter(full).withColumn("sequence_id", -1 - F.col("slot")).withColumn("offset", F.lit(0).cast("bigint"))
    return packed.unionByName(alone.select(*packed.columns))


def _packer(capacity: Capacity) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("slot")
        sequence, offset = best_fit(table.column("length").to_numpy(), capacity)
        names = [c.split()[0] for c in _PACKED.split(", ")]
        part = table.column("part")[0].as_py()
        kept = [table.column(c) for c in names[:5]]
        return pa.table([*kept, pa.array(sequence + (part << 32)), pa.array(offset)], names=names)

    return run
