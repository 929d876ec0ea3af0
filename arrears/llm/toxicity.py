"""Toxicity by FTRL-proximal logistic regression on hashed n-grams.

Features are the words of a text, pairs of neighbours and pairs that skip one
word, each counted once and hashed to 20 bits. Follow-the-regularised-leader
gives every coordinate its own rate, and its L1 term leaves few weights other
than zero, which are sent to all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.llm.frames import crc_bucket, unit_hash
from arrears.llm.rolling import Hasher, mixed
from arrears.sources.scratch import stage

BITS, CHUNK = 20, 1 << 20
# What tells words, neighbours and skips apart.
KINDS = (0x51ED270B, 0x2545F491, 0x9E6D62D1)

_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def features(hasher: Hasher, texts: Sequence[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (text number, feature) in portions; a pair may repeat.

    Words are runs of ASCII letters in lower case, digits and other than ASCII
    characters. A text longer than ``CHUNK`` bytes is cut between words, and
    the hashes of its last two words are carried to the next portion, which
    forms the pairs across the cut. A word longer than that is hashed in steps.
    """
    held: list[tuple[int, bytes]] = []
    size = 0
    # The text that was cut last, and the hashes of its last two words so far.
    carried: tuple[int, np.ndarray] = (-1, np.zeros(0, np.uint64))
    for i, text in enumerate(texts):
        for part in _cut(text.lower()):
            if size + len(part) + 1 > hasher.limit and held:
                found, carried = _portion(hasher, held, carried)
                yield found
                held, size = [], 0
            if len(part) + 1 > hasher.limit:
                found, carried = _pairs(np.array([i]), _long_word(hasher, part), carried, i)
                yield found
                continue
            held.append((i, part))
            size += len(part) + 1
    if held:
        yield _portion(hasher, held, carried)[0]


def _cut(text: bytes) -> Iterator[bytes]:
    """Parts of at most ``CHUNK`` bytes with a separator that end with a word, or longer ones of one word."""
    limit = CHUNK - 1
    if len(text) <= limit:
        yield text
        return
    gaps = np.flatnonzero(~_WORD[np.frombuffer(text, np.uint8)])
    at = 0
    while len(text) - at > limit:
        # The last gap within the limit, or the first one beyond it.
        nth = int(np.searchsorted(gaps, at + limit, side="right")) - 1
        if nth < 0 or gaps[nth] <= at:
            nth += 1
        if nth == len(gaps):
            break
        yield text[at : gaps[nth]]
        at = int(gaps[nth])
    yield text[at:]


def _portion(
    hasher: Hasher, held: list[tuple[int, bytes]], carried: tuple[int, np.ndarray]
) -> tuple[tuple[np.ndarray, np.ndarray], tuple[int, np.ndarray]]:
    data = np.frombuffer(b" ".join(p for _, p in held) + b" ", np.uint8)
    inside = _WORD[data]
    edges = np.diff(inside.astype(np.int8), prepend=0)
    start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    hasher.load(data)
    word = hasher.hash(start, end)
    ends = np.cumsum([len(p) + 1 for _, p in held])
    text = np.array([i for i, _ in held], np.int64)[np.searchsorted(ends, start, side="right")]
    return _pairs(text, word, carried, held[-1][0])


def _long_word(hasher: Hasher, part: bytes) -> np.ndarray:
    """The hash of the one word of ``part``, with at most one separator before it, whatever its length."""
    data = np.frombuffer(part, np.uint8)[0 if _WORD[part[0]] else 1 :]
    total, power = 0, 1
    for at in range(0, len(data), hasher.limit):
        piece = data[at : at + hasher.limit]
        hasher.load(piece)
        total += int(hasher.prefix[-1]) * power
        power = power * int(hasher.powers[len(piece)]) % (1 << 64)
    return mixed(np.array([total % (1 << 64)], np.uint64))


def _pairs(
    text: np.ndarray, word: np.ndarray, carried: tuple[int, np.ndarray], last: int
) -> tuple[tuple[np.ndarray, np.ndarray], tuple[int, np.ndarray]]:
    """The features of words in order, and the last text's number and last two words."""
    # Words carried over form pairs only with those of their own text.
    text = np.concatenate([np.full(len(carried[1]), carried[0], np.int64), text])
    word = np.concatenate([carried[1], word])
    kept = word[text == last][-2:].copy()
    shift = np.uint64(64 - BITS)
    found, owners = [mixed(word * np.uint64(KINDS[0] | 1)) >> shift], [text]
    for kind, step in ((KINDS[1], 1), (KINDS[2], 2)):
        near = text[:-step] == text[step:] if len(text) > step else np.zeros(0, bool)
        a, b = word[: len(near)][near], word[step : step + len(near)][near]
        found.append(mixed(a * np.uint64(kind) + (b ^ (b >> np.uint64(29)))) >> shift)
        owners.append(text[: len(near)][near])
    return (np.concatenate(owners), np.concatenate(found).astype(np.int64)), (last, kept)


def fit(
    rows: Sequence[np.ndarray],
    labels: Sequence[int],
    rate: float = 1.0,
    smooth: float = 1.0,
    l1: float = 10.0,
    l2: float = 0.0,
    rounds: int = 3,
    toxic_weight: float = 4.0,
) -> tuple[float, np.ndarray]:
    """FTRL-proximal over texts in order; returns the bias and the weights.

    A coordinate's rate falls with the root of its own squared gradients.
    The bias is a coordinate without penalty. Toxic texts, the rarer ones,
    count ``toxic_weight`` times.
    """
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    bias_z = bias_n = 0.0
    for _ in range(rounds):
        for row, label in zip(rows, labels):
            zi, ni = z[row], n[row]
            root = np.sqrt(ni)
            w = np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((smooth + root) / rate + l2))
            bias = -bias_z / ((smooth + bias_n**0.5) / rate)
            gradient = (_sigmoid(bias + w.sum()) - label) * (toxic_weight if label else 1.0)
            squared = gradient * gradient
            step = np.sqrt(ni + squared)
            z[row] = zi + gradient - (step - root) / rate * w
            n[row] = ni + squared
            bias_z += gradient - ((bias_n + squared) ** 0.5 - bias_n**0.5) / rate * bias
            bias_n += squared
    weights = np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((smooth + np.sqrt(n)) / rate + l2))
    return -bias_z / ((smooth + bias_n**0.5) / rate), weights


def _sigmoid(x: float) -> float:
    return 1 / (1 + np.exp(-min(max(x, -35.0), 35.0)))


def learn(docs: DataFrame, labels: DataFrame, rows: int = 16_384) -> tuple[float, np.ndarray, np.ndarray]:
    """Bias, and the features and weights other than zero.

    At most ``rows`` labelled documents, those with the smallest hash of their
    id, are learnt from, in one task; their features are extracted by many. Of
    rows that repeat an id the smallest text and the largest label count.
    """
    spark = docs.sparkSession
    known = labels.filter(F.col("toxic").isNotNull() & (crc_bucket("doc_id", 5) != 0))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("draw", unit_hash(F.col("doc_id")))
    chosen = stage(known.orderBy("draw", "doc_id").limit(rows), "labelled")
    texts = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"), F.max("draw").alias("draw"))
        .select("draw", "doc_id", "toxic", F.coalesce("text", F.lit("")).alias("text"))
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(CHUNK)
        for batch in batches:
            found = [np.zeros(0, np.int64) for _ in range(batch.num_rows)]
            for text, feature in features(hasher, batch.column(3).cast(pa.large_binary()).to_pylist()):
                pairs = np.unique(text << BITS | feature)
                cuts = np.searchsorted(pairs >> BITS, np.arange(batch.num_rows + 1))
                for i in np.unique(pairs >> BITS).tolist():
                    found[i] = np.union1d(found[i], pairs[cuts[i] : cuts[i + 1]] & ((1 << BITS) - 1))
            packed = [f.astype("<u4").tobytes() for f in found]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(3)], pa.array(packed, pa.binary())],
                names=["draw", "doc_id", "toxic", "features"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    label = labels.schema["toxic"].dataType.simpleString()
    sample = stage(texts.mapInArrow(extract, f"draw double, doc_id {kind}, toxic {label}, features binary"), "features")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given, marks = [], []
        for batch in batches:
            given += [np.frombuffer(f, "<u4") for f in batch.column(1).to_pylist()]
            marks += [int(t > 0) for t in batch.column(0).to_pylist()]
        bias, weights = fit(given, marks)
        used = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1)), pa.array(np.append(weights[used], bias))], names=["feature", "weight"]
        )

    ordered = sample.repartition(1).sortWithinPartitions("draw", "doc_id").select("toxic", "features")
    found = ordered.mapInArrow(train, "feature bigint, weight double").collect()
    pairs = sorted((r["feature"], r["weight"]) for r in found)
    bias = pairs[0][1] if pairs else 0.0
    return bias, np.array([f for f, _ in pairs[1:]], np.int64), np.array([w for _, w in pairs[1:]])


def score_toxicity(docs: DataFrame, labels: DataFrame, rows: int = 16_384) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` for every row of ``docs``.

    Learns from labels whose CRC-32 of the id, modulo 5, is not 0; documents
    where it is are ``held_out``, those without an id are not. A null or empty
    text gets the bias's score, as does everything where nothing is labelled
    (one half). Repeated rows get equal scores, whole texts are read, no rows
    give no rows, other columns are not read.
    """
    bias, used, weights = learn(docs, labels, rows)
    shared = docs.sparkSession.sparkContext.broadcast((bias, used, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, (bias, used, weights) = Hasher(CHUNK), shared.value
        dense = np.zeros(1 << BITS, np.float32)
        dense[used] = weights
        for batch in batches:
            total = np.full(batch.num_rows, bias)
            held = [np.zeros(0, np.int64)]
            for text, feature in features(hasher, batch.column(2).cast(pa.large_binary()).to_pylist()):
                heavy = dense[feature] != 0
                held.append(np.unique(text[heavy] << BITS | feature[heavy]))
            pairs = np.unique(np.concatenate(held))
            np.add.at(total, pairs >> BITS, dense[pairs & ((1 << BITS) - 1)].astype(float))
            score = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    held_out = F.coalesce(crc_bucket("doc_id", 5) == 0, F.lit(False))
    rows_in = docs.select("doc_id", held_out.alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows_in.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
