"""Phrases whose words belong together, counted by the stripes pattern.

Each first word keys an associative counter of what follows it: second words,
and second and third words together. A task builds such stripes of its texts,
stripes of one prefix meet in a bucket and are merged element by element, and
the merged stripe holds what is wanted of the prefix: its own total, the
totals of the pairs it starts, and how often each extends a pair.

A prefix that many texts share would make one stripe too large for a task. So
words and pairs are counted by class of their hash first, and stripes of
classes above a bucket's share are split: their elements are dealt out by the
hash of the next word as well. Which prefixes are split never changes a count.

Only elements that reach the least count leave their bucket. Parts, scores and
the largest extension of a pair on either side are joins and maxima of those.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrears.llm.frames import text_or_empty
from arrears.llm.rolling import mixed
from arrears.sources.scratch import stage

# Words counted at once: three numbers below it fit into 63 bits.
CHUNK = (1 << 21) - 1
# Text bytes per bucket, and the least number of buckets.
BUCKET_BYTES, LEAST_BUCKETS = 24 << 20, 64
# Classes of words and of pairs, as powers of two. A class is hot above this part of a bucket's share.
WORD_CLASSES, PAIR_CLASSES, HOT = 16, 20, 4

# Upper to lower case A-Z, tab to space, and what ends a piece to a byte that UTF-8 never has.
END = b"\xff"
_FOLD = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + END * 10
)
_COUNTS = "lang string, w1 string, w2 string, w3 string, n bigint"
_BITS = 21


class Vocabulary(dict):
    """Numbers words in the order they are met; 0 ends a piece."""

    def __init__(self) -> None:
        super().__init__({END: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def split(text: bytes) -> list[bytes]:
    """The words of a text, with ``END`` between its pieces."""
    return text.translate(_FOLD).replace(END, b" \xff ").split()


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[str, Vocabulary, np.ndarray]]]:
    """Languages with their words, as numbers, of texts of up to ``CHUNK`` words at a time.

    A text of more words is cut; the last two words of a part are repeated
    before the next one, marked by a negative sign: they start no phrase there.
    """
    held: dict[str, tuple[Vocabulary, list[np.ndarray]]] = {}
    size = 0

    def flush() -> list[tuple[str, Vocabulary, np.ndarray]]:
        out = [(lang, words, np.concatenate(parts)) for lang, (words, parts) in held.items()]
        held.clear()
        return out

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())):
            words = split(text.as_py())
            for at in range(0, len(words), CHUNK // 2):
                # What follows a word is read up to two words beyond the part; see ``counts``.
                part = words[at : at + CHUNK // 2 + 2]
                if size and size + len(part) + 1 > CHUNK:
                    yield flush()
                    size = 0
                known, parts = held.setdefault(lang, (Vocabulary(), []))
                numbers = known.numbers(part)
                starts = np.arange(len(part)) < CHUNK // 2
                parts += [np.where(starts, numbers, -1 - numbers), np.zeros(1, np.int64)]
                size += len(part) + 1
    if held:
        yield flush()


def counts(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stripes of a chunk in order: codes of (first, second, third word), 0 for none, and how often.

    A negative number stands for a word that is only read as a later one.
    """
    starts = numbers > 0
    word = np.where(numbers < 0, -1 - numbers, numbers)
    word = np.concatenate([word, [0, 0]])
    first, second, third = word[:-2][starts], word[1:-1][starts], word[2:][starts]
    one = first << (2 * _BITS)
    two = (one | second << _BITS)[second > 0]
    three = (one | second << _BITS | third)[(second > 0) & (third > 0)]
    return np.unique(np.concatenate([one, two, three]), return_counts=True)


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _next(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a prefix with one more word."""
    return mixed(prefix * np.uint64(0x9E3779B97F4A7C15) + word)


def hot_classes(rows: DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Which classes of first words and of pairs hold more than their part of a bucket.

    A task reports the classes that have more than half the limit's share of its
    own words, so no class above the limit is missed, and at most ``4 * HOT *
    buckets`` rows, and no more than there are classes, come to the driver.
    """
    share = 1.0 / (HOT * buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs, total = np.zeros(1 << WORD_CLASSES, np.int64), np.zeros(1 << PAIR_CLASSES, np.int64), 0
        for chunk in chunks(batches):
            for _, vocabulary, numbers in chunk:
                own = hashes(list(vocabulary))
                word = own[np.where(numbers < 0, 0, numbers)]
                here = numbers > 0
                words += np.bincount(_word_class(word[here]), minlength=len(words))
                both = here[:-1] & here[1:]
                pairs += np.bincount(_pair_class(_next(word[:-1][both], word[1:][both])), minlength=len(pairs))
                total += int(here.sum())
        kinds = [(0, words), (1, pairs)]
        found = [(kind, c, int(n[c])) for kind, n in kinds for c in np.flatnonzero(n > share / 2 * total).tolist()]
        found.append((2, 0, total))
        columns = [pa.array(c, pa.int64()) for c in zip(*found)]
        yield pa.RecordBatch.from_arrays(columns, names=["kind", "class", "n"])

    sums = rows.mapInArrow(run, "kind bigint, class bigint, n bigint").groupBy("kind", "class").agg(F.sum("n").alias("n"))
    sums = stage(sums, "classes")
    total = sums.filter("kind = 2").agg(F.sum("n")).first()[0] or 0
    hot = np.zeros(1 << WORD_CLASSES, bool), np.zeros(1 << PAIR_CLASSES, bool)
    for row in sums.filter((F.col("kind") < 2) & (F.col("n") > share / 2 * total)).collect():
        hot[row["kind"]][row["class"]] = True
    return hot


def _word_class(own: np.ndarray) -> np.ndarray:
    return (own >> np.uint64(64 - WORD_CLASSES)).astype(np.int64)


def _pair_class(pair: np.ndarray) -> np.ndarray:
    return (pair >> np.uint64(64 - PAIR_CLASSES)).astype(np.int64)


def phrase_counts(
    docs: DataFrame, least: int = 10, lang: str = "lang", text: str = "text", bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """``lang``, ``w1``, ``w2``, ``w3``, ``n``: phrases of one to three words that occur ``least``
    times or more in a language, and rows without words for all words of each language.

    ``A-Z`` become lower case, phrases stay within pieces between ``.,;:!?`` and
    line ends, overlaps count. A null text is empty, a null language ``und``.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), text_or_empty(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    buckets = max(LEAST_BUCKETS, math.ceil(size / bucket_bytes))
    hot = spark.sparkContext.broadcast(hot_classes(rows, buckets))
    dealt = rows.mapInArrow(_dealer(hot, buckets), "bucket bigint, lang string, stripes binary")
    return dealt.groupBy("bucket").applyInArrow(_merger(least), _COUNTS)


def _dealer(hot, buckets: int):
    """Stripes of every chunk, cut up by bucket; ``hot`` is a broadcast of ``hot_classes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot_words, hot_pairs = hot.value
        for chunk in chunks(batches):
            for lang, vocabulary, numbers in chunk:
                words = list(vocabulary)
                own = hashes(words)
                codes, n = counts(numbers)
                first, second, third = _parts(codes)
                one = own[first]
                two = _next(one, own[second])
                place = one.copy()
                split_word = hot_words[_word_class(one)] & (second > 0)
                place[split_word] = two[split_word]
                split_pair = split_word & (third > 0) & hot_pairs[_pair_class(two)]
                place[split_pair] = _next(two[split_pair], own[third[split_pair]])
                bucket = (place % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1)) if len(order) else []
                out = []
                for a, z in zip(cuts[:-1], cuts[1:]):
                    mine = order[a:z]
                    out.append((int(bucket[mine[0]]), lang, _pack(words, codes[mine], n[mine])))
                for at in range(0, len(out), 256):
                    columns = zip(*out[at : at + 256])
                    types = (pa.int64(), pa.string(), pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, types)], names=["bucket", "lang", "stripes"]
                    )

    return run


def _parts(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    mask = (1 << _BITS) - 1
    return codes >> (2 * _BITS), codes >> _BITS & mask, codes & mask


def _pack(words: list[bytes], codes: np.ndarray, n: np.ndarray) -> bytes:
    """Stripes with the words they use, numbered anew in the same order."""
    used, new = np.unique(np.concatenate([*_parts(codes), [0]]), return_inverse=True)
    first, second, third = new[:-1].reshape(3, -1)
    columns = [np.diff(first, prepend=0), second, third, n]
    planes = [c.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for c in columns]
    named = b" ".join([words[i] for i in used[1:].tolist()])
    return struct.pack("<II", len(n), len(named)) + zstandard.compress(b"".join([named, *planes]), 1)


def _unpack(data: bytes) -> tuple[list[bytes], np.ndarray]:
    """Words from number 1 on, and rows of first, second, third word and count."""
    n, size = struct.unpack_from("<II", data)
    raw = zstandard.decompress(data[8:])
    planes = np.frombuffer(raw, np.uint8, 16 * n, size).reshape(4, 4, n)
    rows = np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<u4")[:, :, 0].astype(np.int64)
    rows[0] = np.cumsum(rows[0])
    return raw[:size].split(b" ") if size else [], rows


def _merger(least: int):
    """Merge the stripes of a bucket element by element and keep what is frequent."""

    def run(table: pa.Table) -> pa.Table:
        out = []
        for lang in pc.unique(table.column("lang")).to_pylist():
            blobs = table.filter(pc.equal(table.column("lang"), lang)).column("stripes")
            vocabulary, parts = Vocabulary(), []
            for blob in blobs:
                words, rows = _unpack(blob.as_py())
                known = np.concatenate([[0], vocabulary.numbers(words)])
                rows[:3] = known[rows[:3]]
                parts.append(rows.astype(np.uint32))
            first, second, third, n = merged_stripes(np.concatenate(parts, axis=1))
            parts.clear()
            total = int(n[second == 0].sum())
            kept = np.flatnonzero(n >= least)
            words = pa.array([None, *list(vocabulary)[1:]], pa.binary()).cast(pa.string())
            columns = [words.take(pa.array(c[kept])) for c in (first, second, third)]
            langs = pa.array([lang], pa.string()).take(pa.array(np.zeros(len(kept), np.int64)))
            names = [c.split()[0] for c in _COUNTS.split(", ")]
            out.append(pa.table([langs, *columns, pa.array(n[kept])], names=names))
            none = pa.array([None], pa.string())
            out.append(pa.table([pa.array([lang], pa.string()), none, none, none, pa.array([total], pa.int64())], names=names))
        return pa.concat_tables(out)

    return run


def merged_stripes(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sums of equal (first, second, third) rows, in their order."""
    first, second, third, n = rows
    if len(n) and max(first.max(), second.max(), third.max()) < 1 << _BITS:
        code = first.astype(np.int64) << (2 * _BITS) | second.astype(np.int64) << _BITS | third
        order = np.argsort(code)
    else:
        order = np.lexsort((third, second, first))
    first, second, third, n = (c[order] for c in (first, second, third, n.astype(np.int64)))
    opens = np.ones(len(n), bool)
    opens[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1]) | (third[1:] != third[:-1])
    at = np.flatnonzero(opens)
    return first[at], second[at], third[at], np.add.reduceat(n, at) if len(at) else n


def exact_score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exact for counts below 10 ** 15."""
    wide = [c.cast("decimal(15,0)") for c in (a, left, right)]
    scaled = (F.lit(1_000_000).cast("decimal(7,0)") * wide[0] * wide[0]).cast("decimal(38,0)")
    product = (wide[1] * wide[2]).cast("decimal(30,0)")
    # The rest goes first, so that the division has no remainder to round.
    return ((scaled - scaled % product) / product).cast("bigint")


def collocations(
    docs: DataFrame, least: int = 10, first: int = 2000, overlap: int = 50, lang: str = "lang", text: str = "text"
) -> DataFrame:
    """Each language's best phrases of two and three words: ``lang``, ``rank``, ``phrase``,
    ``a``, ``l``, ``r``, ``n`` and ``score``.

    ``a`` counts the phrase, ``n`` all words of the language, ``l`` and ``r`` the
    parts on either side of the cut that scores lowest, the first of several.
    A phrase goes if a longer candidate around it has ``overlap`` percent of its
    count or more. Ties in score go to the higher count, then to the phrase
    that is smaller by its bytes. Null and empty texts have no phrases, rows
    that repeat count each, very long texts are read whole, a language without
    candidates has no rows, no rows give no rows. Other columns are not read.
    """
    found = stage(phrase_counts(docs, least, lang, text), "phrases")
    sizes = found.filter("w1 IS NULL").groupBy("lang").agg(F.sum("n").alias("words"))
    counted = found.filter("w1 IS NOT NULL")
    phrases = counted.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("part"), "n")
    pairs, triples = counted.filter("w2 IS NOT NULL AND w3 IS NULL"), counted.filter("w3 IS NOT NULL")

    left, right = F.concat_ws(" ", "w1", "w2"), F.concat_ws(" ", "w2", "w3")
    inside = triples.select("lang", F.explode(F.array(left, right)).alias("phrase"), "n")
    longer = inside.groupBy("lang", "phrase").agg(F.max("n").alias("longest"))
    alone = pairs.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), F.col("n").alias("a"), "w1", "w2")
    alone = alone.join(longer, ["lang", "phrase"], "left")
    alone = alone.filter(100 * F.coalesce("longest", F.lit(0)) < overlap * F.col("a"))
    cuts = alone.select("lang", "phrase", "a", F.lit(1).alias("k"), F.col("w1").alias("head"), F.col("w2").alias("tail"))
    both = F.explode(
        F.array(
            F.struct(F.lit(1).alias("k"), F.col("w1").alias("head"), right.alias("tail")),
            F.struct(F.lit(2).alias("k"), left.alias("head"), F.col("w3").alias("tail")),
        )
    )
    whole = triples.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), F.col("n").alias("a"), both.alias("cut"))
    cuts = cuts.unionByName(whole.select("lang", "phrase", "a", "cut.*"))

    heads = phrases.toDF("lang", "head", "l")
    tails = phrases.toDF("lang", "tail", "r")
    scored = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    scored = scored.withColumn("score", exact_score(F.col("a"), F.col("l"), F.col("r")))
    lowest = scored.groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    ranked = stage(lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"), "scored")

    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # Most rows go within a portion of their language, so that no task sorts all of one.
    some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*best)
    ranked = ranked.withColumn("_place", F.row_number().over(some)).filter(F.col("_place") <= first).drop("_place")
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)))
    top = ranked.filter(F.col("rank") <= first).join(sizes, "lang")
    return top.select("lang", "rank", "phrase", "a", "l", "r", F.col("words").alias("n"), "score")


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
placed AS (
  SELECT lang, unnest(w) AS w1, unnest(list_concat(w[2:], [NULL])) AS w2, unnest(list_concat(w[3:], [NULL, NULL])[:len(w)]) AS w3
  FROM worded WHERE len(w) > 0),
sizes AS (SELECT lang, count(*) AS n FROM placed GROUP BY 1),
grams AS (
  SELECT lang, [w1] AS w, count(*) AS f FROM placed GROUP BY ALL
  UNION ALL SELECT lang, [w1, w2], count(*) FROM placed WHERE w2 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, [w1, w2, w3], count(*) FROM placed WHERE w3 IS NOT NULL GROUP BY ALL),
candidates AS (SELECT * FROM grams WHERE len(w) > 1 AND f >= 10),
longer AS (
  SELECT lang, part, max(f) AS f FROM (
    SELECT lang, w[1:2] AS part, f FROM candidates WHERE len(w) = 3
    UNION ALL SELECT lang, w[2:3], f FROM candidates WHERE len(w) = 3) GROUP BY ALL),
alone AS (
  SELECT c.lang, c.w, c.f AS a FROM candidates c LEFT JOIN longer ON longer.lang = c.lang AND longer.part = c.w
  WHERE longer.f IS NULL OR 100 * longer.f < 50 * c.f),
cuts AS (
  SELECT lang, w, a, 1 AS k, w[1:1] AS head, w[2:] AS tail FROM alone
  UNION ALL SELECT lang, w, a, 2, w[1:2], w[3:] FROM alone WHERE len(w) = 3),
scored AS (
  SELECT c.*, h.f AS l, t.f AS r, (1000000::HUGEINT * a * a) // (h.f::HUGEINT * t.f) AS score
  FROM cuts c JOIN grams h ON h.lang = c.lang AND h.w = c.head JOIN grams t ON t.lang = c.lang AND t.w = c.tail),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, k) = 1),
ranked AS (
  SELECT lang, array_to_string(w, ' ') AS phrase, a, l, r, score, row_number() OVER (
    PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(w, ' '))) AS rank
  FROM lowest)
SELECT lang, CAST(rank AS INTEGER) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""
