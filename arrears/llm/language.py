"""Language identification by cross-parsing.

For each language a suffix automaton of labelled text tells how far any
string can be matched. A text is parsed greedily into the longest phrases that
occur in that language's text; the language that needs the fewest phrases,
weighted by the bits a phrase costs, wins. Automata are held as dense tables,
and many blocks of text step through them at once. Moves on letters beyond the
most frequent ones are few and held as sorted lists, so every letter of a
sample is told from every other.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arrears.llm.frames import crc_bucket, unit_hash
from arrears.sources.scratch import stage

PAD, GAP, UNKNOWN = 0, 1, 2
# Letters with a column of their own in a language's table.
LETTERS = 64
MISS, BLOCK, BLOCKS = np.uint32(1 << 31), 512, 4096


@dataclass
class Model:
    """``classes``: a character's class by code point; ``tables``: per language the
    next state by state and class, with a mark where a phrase begins. Classes from
    ``width`` on are those of rare letters, whose moves are in ``rare``: sorted
    keys of state and class, next states, and the moves from the start by class."""

    languages: list[str]
    classes: np.ndarray
    width: int
    tables: list[np.ndarray]
    rare: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    bits: list[float]


def automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of ``codes``; state 0 is the start."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for code in codes:
        state = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and code not in moves[at]:
            moves[at][code] = state
            at = link[at]
        if at >= 0:
            to = moves[at][code]
            if length[at] + 1 == length[to]:
                link[state] = to
            else:
                copy = len(moves)
                moves.append(dict(moves[to]))
                link.append(link[to])
                length.append(length[at] + 1)
                while at >= 0 and moves[at].get(code) == to:
                    moves[at][code] = copy
                    at = link[at]
                link[to] = link[state] = copy
        last = state
    return moves


def table(moves: list[dict[int, int]], width: int) -> np.ndarray:
    """Dense next states. A marked entry begins a phrase: every move from the start,
    and where a state has no move, with the state that the new phrase gets to. A
    class that the language does not have is a phrase of its own."""
    out = np.zeros((len(moves), width), np.uint32)
    out[:] = MISS
    for code, state in moves[0].items():
        if code < width:
            out[:, code] = MISS | np.uint32(state)
    for state, own in enumerate(moves[1:], 1):
        for code, to in own.items():
            if code < width:
                out[state, code] = to
    out[:, PAD] = np.arange(len(moves), dtype=np.uint32)
    return out.ravel()


def rare_moves(moves: list[dict[int, int]], width: int, n_classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The moves on classes from ``width`` on: sorted keys, next states, and those from the start by class."""
    found = sorted((state * n_classes + code, to) for state, own in enumerate(moves) for code, to in own.items() if code >= width)
    keys, to = np.array(found, np.int64).reshape(-1, 2).T
    start = np.full(n_classes - width, MISS, np.uint32)
    for code, state in moves[0].items():
        if code >= width:
            start[code - width] = MISS | np.uint32(state)
    return np.ascontiguousarray(keys), to.astype(np.uint32), start


def equal_parts(texts: list[str], characters: int) -> list[str]:
    """The beginnings of ``texts``, ``characters`` in all: equal shares, and what shorter ones leave goes to the others."""
    shares, left = [0] * len(texts), characters
    for n, i in enumerate(sorted(range(len(texts)), key=lambda i: len(texts[i]))):
        shares[i] = min(len(texts[i]), left // (len(texts) - n))
        left -= shares[i]
    return [text[:share] for text, share in zip(texts, shares)]


def train(samples: dict[str, list[str]], characters: int = 16_000, letters: int = 250) -> Model:
    """A model of ``characters`` of each language's texts, an equal share of each.

    The ``letters`` most frequent letters have columns in the dense tables;
    the others that a sample has, classes of their own all the same.
    """
    texts = {lang: "\n".join(equal_parts([p.lower() for p in parts], characters)) for lang, parts in sorted(samples.items())}
    seen = Counter(c for text in texts.values() for c in text if c.isalpha())
    ranked = sorted(seen, key=lambda c: (-seen[c], c))
    n_classes = UNKNOWN + 1 + len(ranked)
    classes = np.full(0x110000, GAP, np.min_scalar_type(n_classes - 1))
    alpha = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    classes[alpha] = UNKNOWN
    for i, c in enumerate(ranked):
        classes[ord(c)] = UNKNOWN + 1 + i
    width = UNKNOWN + 1 + min(len(ranked), letters)
    model = Model([], classes, width, [], [], [])
    for lang, text in texts.items():
        codes = encode(text, classes)
        if len(codes):
            moves = automaton(codes.tolist())
            model.languages.append(lang)
            model.tables.append(table(moves, width))
            model.rare.append(rare_moves(moves, width, n_classes))
            model.bits.append(math.log2(len(codes) + 1))
    return model


def encode(text: str, classes: np.ndarray) -> np.ndarray:
    """A text's classes in lower case; runs of anything but letters become one gap."""
    codes = classes[np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)]
    if not len(codes):
        return codes
    keep = codes != GAP
    keep[1:] |= codes[:-1] != GAP
    return codes[keep]


def phrases(model: Model, parts: list[np.ndarray]) -> np.ndarray:
    """Phrases per part and language. Parts are parsed in blocks of 512, which adds
    at most one phrase a block to each language alike."""
    counts = np.zeros((len(parts), len(model.languages)), np.int64)
    sizes = np.array([-(-len(p) // BLOCK) for p in parts])
    grid = np.zeros((int(sizes.sum()), BLOCK), model.classes.dtype)
    flat, at = grid.reshape(-1), 0
    for part, n in zip(parts, sizes.tolist()):
        flat[at : at + len(part)] = part
        at += n * BLOCK
    owner = np.repeat(np.arange(len(parts)), sizes)
    for begin in range(0, len(grid), BLOCKS):
        steps = np.ascontiguousarray(grid[begin : begin + BLOCKS].T).astype(np.intp)
        rare = steps >= model.width
        places = [np.flatnonzero(r) for r in rare] if rare.any() else None
        codes = [step[at] for step, at in zip(steps, places)] if places else []
        steps[rare] = UNKNOWN
        for k, moves in enumerate(model.tables):
            state = np.zeros(steps.shape[1], np.intp)
            begun = np.zeros(steps.shape[1], np.int64)
            for n, step in enumerate(steps):
                own = _rare_next(model, k, state[places[n]], codes[n]) if places and len(places[n]) else None
                state *= model.width
                state += step
                to = moves[state]
                if own is not None:
                    to[places[n]] = own
                begun += to >> 31
                np.bitwise_and(to, ~MISS, out=state, casting="unsafe")
            np.add.at(counts[:, k], owner[begin : begin + BLOCKS], begun)
    return counts


def _rare_next(model: Model, k: int, state: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Next states by moves on rare letters, with a mark where a phrase begins."""
    keys, to, start = model.rare[k]
    n_classes = model.width + len(start)
    out = start[code - model.width]
    if len(keys):
        key = state * n_classes + code
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        moved = (keys[at] == key) & (state > 0)
        out[moved] = to[at[moved]]
    return out


def classify(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text; "und" and 0 without letters or a model."""
    parts = [encode(t, model.classes) if t else np.zeros(0, model.classes.dtype) for t in texts]
    lettered = np.array([bool((p > GAP).any()) for p in parts], bool)
    names, scores = ["und"] * len(texts), np.zeros(len(texts))
    mine = np.flatnonzero(lettered) if model.languages else np.zeros(0, np.int64)
    for at in range(0, len(mine), 256):
        some = mine[at : at + 256]
        cost = phrases(model, [parts[i] for i in some]) * np.array(model.bits)
        best = cost.argmin(axis=1)
        inverse = 1 / cost
        share = inverse[np.arange(len(some)), best] / inverse.sum(axis=1)
        for i, b, s in zip(some.tolist(), best.tolist(), share.tolist()):
            names[i], scores[i] = model.languages[b], s
    return names, scores


def drawn_rows(labelled: DataFrame, rows: int, characters: int) -> DataFrame:
    """``lang``, ``place`` and ``text`` of at most ``rows`` different labelled rows per language.

    Rows come in order of a hash of id and text, whatever ids repeat; those
    longer than ``characters`` come last, the shortest first. Most go within
    a portion of their language, and only the texts of drawn rows are read.
    """
    key = F.xxhash64("text")
    known = labelled.select("lang", "doc_id", key.alias("key"), F.length("text").alias("size")).distinct()
    known = known.withColumn("late", F.greatest(F.col("size") - characters, F.lit(0)))
    known = known.withColumn("draw", unit_hash(F.col("doc_id"), F.col("key")))
    order = [F.col(c) for c in ("late", "draw", "doc_id", "key")]
    some = Window.partitionBy("lang", F.pmod(F.hash("key", "doc_id"), F.lit(64))).orderBy(*order)
    known = known.withColumn("place", F.row_number().over(some)).filter(F.col("place") <= rows)
    known = known.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    # Stored, so that Spark knows how small they are: no more than ``rows`` a language.
    chosen = stage(known.filter(F.col("place") <= rows).toDF("_lang", "_id", "_key", *known.columns[3:]), "drawn")
    same = (F.col("lang") == F.col("_lang")) & F.col("doc_id").eqNullSafe(F.col("_id")) & (key == F.col("_key"))
    # Of a longer text no more than ``characters`` is ever used.
    text = F.substring("text", 1, characters).alias("text")
    return labelled.join(chosen, same).select("lang", "place", text).groupBy("lang", "place").agg(F.min("text").alias("text"))


def whole_texts(texts: list[str], characters: int) -> list[str]:
    """The texts, in order and whole, that together have at most ``characters``. If not
    even one fits, the beginning of the first."""
    kept, left = [], characters
    for text in texts:
        if len(text) <= left:
            kept.append(text)
            left -= len(text)
    return kept or [text[:characters] for text in texts[:1]]


def learn(labelled: DataFrame, rows: int = 64, characters: int = 16_000, table_bytes: int = 256 << 20) -> Model:
    """Train on whole texts of at most ``rows`` rows and ``characters`` characters per language.

    The sample's size does not depend on the input. All tables together stay
    below ``table_bytes``: where languages are many, each gets fewer characters.
    """
    languages = labelled.select("lang").distinct().count()
    # Two states a character at most, four bytes a column.
    characters = max(200, min(characters, table_bytes // (max(1, languages) * 8 * (UNKNOWN + 1 + LETTERS))))
    samples: dict[str, list[str]] = {}
    for row in drawn_rows(labelled, rows, characters).orderBy("lang", "place").toLocalIterator():
        samples.setdefault(row["lang"], []).append(row["text"])
    return train({lang: whole_texts(texts, characters) for lang, texts in samples.items()}, characters, LETTERS)


def identify(docs: DataFrame, rows: int = 64, characters: int = 16_000) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` for every row.

    Learns from ``text`` and ``lang`` of rows with both whose CRC-32 of the id,
    modulo 3, is not 1; rows where it is are ``held_out``. A row without an
    id is neither. A null text or one without letters is "und" with score 0,
    as is everything where nothing is labelled. The score is the winner's share
    of the languages' inverse costs; ties go to the first language by name.
    Repeated rows get equal results, whole texts are parsed, no rows give no
    rows, other columns are not read.
    """
    fold = crc_bucket("doc_id", 3)
    labelled = docs.filter((fold != 1) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    model = learn(labelled.select("doc_id", "lang", "text"), rows, characters)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2)
            names, scores = [], []
            for at in range(0, batch.num_rows, 1024):
                some, share = classify(shared.value, texts.slice(at, 1024).to_pylist())
                names += some
                scores.append(share)
            score = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(score)],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    held_out = F.coalesce(fold == 1, F.lit(False))
    return docs.select("doc_id", held_out.alias("held_out"), "text").mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, lang_pred string, score double"
    )
