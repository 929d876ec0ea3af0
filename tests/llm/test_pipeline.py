"""The whole pipeline against its five stages redone by brute force."""

import math
import random
import re
import zlib
from functools import partial

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from arrears.llm import mixing, quality_rules
from arrears.llm.frames import text_key, unit_hash
from arrears.sources.scratch import stage
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .conftest import SCHEMA, prose
from .test_quality_rules import expected as measures
from .test_simhash import roots, slow_fingerprint
from .test_suffix_dedup import slow as slow_removal


def votes(text):
    """One vote per rule, in the order of ``RULES``."""
    text = text or ""
    n_words, chars, symbols, dup_lines, repeats = measures(text)
    lines = sum(bool(re.search(r"[^ \t-\r]", x)) for x in text.split("\n"))
    marked = len(re.findall(r"[#*$%&|<>](?:[ \t-\r]|\Z)", text))
    different = len(set(re.findall(r"[^ \t-\r]+", text)))
    shares = [
        (symbols, chars), (marked, n_words), (symbols, n_words), (dup_lines, lines), (repeats, n_words),
        (n_words - different, n_words), (3 * len(re.findall("[A-Z]{3}", text)), chars), (text.count("!"), n_words),
        (abs(chars - 6 * n_words), n_words),
    ]
    limits = [(r.good, r.bad) for r in quality_rules.RULES]
    cast = []
    for (a, b), (good, bad) in zip(shares, limits):
        cast.append(0 if not b else -1 if a / b >= bad else 1 if a / b <= good else 0)
    return cast


def slow_quality(rows):
    cast = [votes(r[1]) for r in rows]
    n = len(quality_rules.RULES)
    prior, good, bad = 0.8, [0.98] * n, [0.5] * n

    def posterior(own):
        odds = math.log(prior / (1 - prior))
        for v, g, b in zip(own, good, bad):
            odds += {1: math.log(g / (1 - b)), -1: math.log((1 - g) / b), 0: 0}[v]
        return 1 / (1 + math.exp(-odds))

    for _ in range(25):
        weight = [posterior(own) for own in cast]
        prior = min(max(sum(weight) / len(cast), 0.05), 0.95)
        for i in range(n):
            up, down = (sum(w for own, w in zip(cast, weight) if own[i] == v) for v in (1, -1))
            good[i] = min(max((up + 9.8) / (up + down + 10), 0.5), 0.98)
            up, down = (sum(1 - w for own, w in zip(cast, weight) if own[i] == v) for v in (1, -1))
            bad[i] = min(max((down + 0.5) / (up + down + 1), 1.01 - good[i]), 0.99)
    kept = []
    for row, own in zip(rows, cast):
        n_words, _, _, _, repeats = measures(row[1])
        if n_words >= 50 and 100 * repeats <= 50 * n_words and posterior(own) >= 0.5:
            kept.append(row)
    return kept


def slow_near_dedup(rows):
    rows = sorted(rows)
    fps = [slow_fingerprint(r[1]) for r in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    return [rows[i] for i in sorted(set(roots(len(rows), pairs)))]


def slow_span_dedup(rows):
    left = slow_removal([(r[0], r[1]) for r in rows])
    return [(r[0], kept.decode("utf-8", "ignore"), *r[2:]) for r, (_, kept, *_) in zip(rows, left)]


def slow_mix(spark, rows):
    def topic(text):
        found = [("prose", 1.0, -len(mixing.TOPICS))]
        for i, t in enumerate(mixing.TOPICS):
            found.append((t.name, sum(map(text.count, t.terms)) * 1000 / (max(1, len(text.encode())) * t.least), -i))
        return max(found, key=lambda x: x[1:])[0]

    cell = [(r[3], r[2], topic(r[1])) for r in rows]
    tokens = {c: 0 for c in cell}
    for c, r in zip(cell, rows):
        tokens[c] += len(re.findall(r"[^ \t-\r]+", r[1]))
    total = sum(tokens.values())
    fit = {c: float(n) for c, n in tokens.items()}

    def summed(of, axis):
        out = {}
        for c, n in of.items():
            out[c[axis]] = out.get(c[axis], 0) + n
        return out

    goals = []
    for axis, temper in enumerate((0.7, 0.7, 0.85)):
        free = {level: n**temper for level, n in summed(tokens, axis).items()}
        goals.append({level: n / sum(free.values()) * total for level, n in free.items()})
    for _ in range(30):
        for axis, goal in enumerate(goals):
            now = summed(fit, axis)
            factors = {level: goal[level] / now[level] for level in now}
            if axis == 0:
                worst = max(abs(f - 1) for f in factors.values())
            fit = {c: n * factors[c[axis]] for c, n in fit.items()}
        if worst < 1e-4:
            break
    weight = {c: fit[c] / tokens[c] for c in fit}
    chance = {c: min(1.0, 0.6 * weight[c]) for c in fit}
    # A level keeps no more than it holds; the others share what that leaves.
    for axis, goal in enumerate(goals):
        held, full, scale = summed(tokens, axis), set(), 0.6
        while new := {x for x in goal if x not in full and goal[x] * scale > held[x]}:
            full |= new
            scale = (0.6 * total - sum(held[x] for x in full)) / sum(goal[x] for x in goal if x not in full)
        goals[axis] = {x: held[x] if x in full else goal[x] * scale for x in goal}
    for _ in range(2000):
        worst = 0.0
        for axis, goal in enumerate(goals):
            bound = {c for c in chance if chance[c] >= 1}
            fixed, now = summed({c: tokens[c] for c in bound}, axis), summed({c: tokens[c] * chance[c] for c in chance}, axis)
            for c in chance:
                level = c[axis]
                worst = max(worst, abs(now[level] - goal[level]) / goal[level])
                if now[level] >= goal[level]:
                    chance[c] *= goal[level] / now[level]
                elif c not in bound:
                    at_bound = fixed.get(level, 0)
                    chance[c] = min(1.0, chance[c] * (goal[level] - at_bound) / (now[level] - at_bound))
        if worst < 1e-4:
            break
    frame = spark.createDataFrame(rows, SCHEMA)
    draws = {r[0]: r[1] for r in frame.select("doc_id", unit_hash(F.col("doc_id"), text_key(), F.lit(7))).collect()}
    names = spark.createDataFrame(list(tokens), "s string, l string, t string")
    luck = {tuple(r[:3]): r[3] for r in names.select("*", unit_hash(F.col("s"), F.col("l"), F.col("t"), F.lit(7))).collect()}
    limit = {}
    for c in tokens:
        share, low, width = tokens[c] * chance[c], 0.0, 1.0
        for _ in range(2):
            bins = {}
            for r, own in zip(rows, cell):
                n = len(re.findall(r"[^ \t-\r]+", r[1]))
                place = math.floor((draws[r[0]] - low) / width * 4096)
                if own == c and n and 0 <= place < 4096:
                    bins[place] = bins.get(place, 0) + n
            before, last = 0, None
            for place in sorted(bins):
                if before < share:
                    last = (place, share - before, bins[place])
                before += bins[place]
            place, share, n = last
            low, width = low + width * place / 4096, width / 4096
        limit[c] = 2.0 if chance[c] >= 1 else low + (width if luck[c] < min(1.0, share / n) else 0.0)
    return [r for r, c in zip(rows, cell) if draws[r[0]] < limit[c]]


def slow_pieces(rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = []
    for r in rows:
        ids = np.array([*tokenizer.encode(r[1], add_special_tokens=False).ids, 0], "<u4")
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        out += [(r[0], i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    return sorted(out)


def small_table():
    draw = random.Random(8)
    passages = [prose(900 + i, 25) for i in range(4)]
    marks = ["", " license", " http", " | "]
    rows = []
    for i in range(70):
        parts = [prose(i, draw.randint(60, 150)), draw.choice(passages), prose(300 + i, 30) + marks[i % 4], "é" * draw.randint(1, 5)]
        rows.append((" ".join(parts) + ".", ("en", "de", "fr")[i % 5 % 3]))
    rows += [(prose(500 + i, 4000, 3000), "en") for i in range(3)]
    rows += [(rows[i][0] + " end", "en") for i in range(8)] + [(rows[i][0], "de") for i in range(4)]
    rows += [(" ".join(w + "***" for w in prose(600 + i, 80).split()), "en") for i in range(5)]
    rows += [(prose(700, 20), "en"), (None, "en"), ("", "fr"), ("same three words " * 40, "de")]
    return [(i, t, lang, f"src{i % 3}", len(t or "")) for i, (t, lang) in enumerate(rows)]


def test_an_empty_table_and_extra_columns(spark, tmp_path):
    rows = spark.createDataFrame(small_table()[:20], SCHEMA)
    more = rows.selectExpr("*", "1 AS kept", "'x' AS topic", "2 AS draw", "3 AS sampled", "4 AS text_key")
    more.write.parquet(f"{tmp_path}/more/documents.parquet")
    rows.write.parquet(f"{tmp_path}/same/documents.parquet")
    rows.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    key = ("doc_id", "piece", "start", "length", "ids_crc32")
    found = {
        name: sorted(tuple(r[k] for k in key) for r in corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect())
        for name in ("more", "same", "none")
    }
    assert found["more"] == found["same"] != [] and found["none"] == []


def test_as_many_sweeps_for_many_cells_as_for_few(spark, monkeypatch):
    """The mixing stage hands the same limits to both ways of sweeping."""
    docs = spark.createDataFrame(small_table()[:12], SCHEMA)
    limits = []

    def swept(first, columns, goals, sweeps, tolerance):
        limits.append((sweeps, tolerance))
        return first

    def fitted(tokens, levels, chances, goals, sweeps, tolerance):
        limits.append((sweeps, tolerance))
        return chances

    monkeypatch.setattr(mixing, "rake", partial(mixing.rake, iterations=1))
    monkeypatch.setattr(mixing, "_swept", swept)
    monkeypatch.setattr(mixing, "bounded_fit", fitted)
    few = sorted(corpus_pipeline.mix(spark, docs, "").collect())
    monkeypatch.setattr(mixing, "BROADCAST_CELLS", 2)
    assert sorted(corpus_pipeline.mix(spark, docs, "").collect()) == few
    assert len(limits) == 2 and limits[0] == limits[1]


def test_the_switch_between_few_and_many_cells_changes_no_bit(spark, monkeypatch):
    """Both ways of sweeping, run on what the mixing stage hands to one of them, give the same doubles."""
    docs = spark.createDataFrame(small_table(), SCHEMA)
    swept, compared = mixing._swept, []

    def both(first, columns, goals, sweeps, tolerance):
        first, goals = stage(first, "test"), [stage(goal, "test") for goal in goals]
        many = swept(first.repartition(5), columns, goals, 8, tolerance)
        cells = first.collect()
        few = mixing.bounded_fit(
            [r["tokens"] for r in cells],
            [[r[c] for c in columns] for r in cells],
            [r["probability"] for r in cells],
            [{r["level"]: r["goal"] for r in goal.collect()} for goal in goals],
            8,
            tolerance,
        )
        compared.append({tuple(r[c] for c in columns): chance for r, chance in zip(cells, few)})
        compared.append({tuple(r[c] for c in columns): r["probability"] for r in many.collect()})
        return many

    monkeypatch.setattr(mixing, "BROADCAST_CELLS", 2)
    monkeypatch.setattr(mixing, "_swept", both)
    assert 0 < corpus_pipeline.mix(spark, docs, "").count() < docs.count()
    few, many = compared
    assert len(few) > 20 and few == many


def test_pipeline_equals_its_stages_by_brute_force(spark, tmp_path):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "simhash_dedup", "suffix_dedup", "mixing", "packing"]
    rows = small_table()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()

    good = slow_quality(rows)
    single = slow_near_dedup(good)
    cut = slow_span_dedup(single)
    mixed = slow_mix(spark, cut)
    # Every stage has something to do.
    assert len(rows) > len(good) > len(single) > len(mixed) > 0
    assert sum(len(r[1]) for r in cut) < sum(len(r[1]) for r in single)
    pieces = slow_pieces(mixed)
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == pieces
    assert len(pieces) > len(mixed)

    sequences = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        parts.sort()
        assert [at for at, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= 2048
    # Best fit: longest first, into the sequence with the least weighted room left.
    made = []
    for n in sorted((p[3] for p in pieces), reverse=True):
        def room(own, n=n):
            own = [*own, n]
            left = (1 - sum(own) / 2048, 1 - len(own) / 2048, 1 - sum(x * x for x in own) / 2048**2)
            return left[0] ** 2 + 0.01 * left[1] ** 2 + 0.1 * left[2] ** 2

        fitting = [own for own in made if sum(own) + n <= 2048]
        if fitting:
            min(fitting, key=room).append(n)
        else:
            made.append([n])
    assert sorted(sorted(n for _, n in parts) for parts in sequences.values()) == sorted(map(sorted, made))
