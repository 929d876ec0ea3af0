import zlib

import numpy as np
import public_tokenizers
import pytest
from arrears.llm import token_blocks as b
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .conftest import SCHEMA, documents, prose

STRANGE = [
    "", " ", "a", " a ", "a  b", "\n", "a\nb\n", "a\tb\x0b\x0cc\r\nd", "don't we'll 's", "ſ²³ ½ ǅ İ ΑΣ Σ ΟΔΟΣ,", "1234 5 6.7",
    "x<|endoftext|>b <|startoftext|> <| endoftext|>", "é é ́e ̸= ≠", "漢字 かな 🙂🙂", "a\x1cb\x85c\xa0d e",
    "CAPS!! **bold**...", "z" * 300 + " " + "ab" * 400, "가 ᄀ ᅡ",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_ids_equal_the_tokenizers(tokenizer, tables_dir):
    import pyarrow.parquet as pq

    texts = STRANGE + pq.read_table(f"{tables_dir}/documents.parquet")["text"].to_pylist()
    expected = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    for words in (400_000, 20):
        encoder = b.WordEncoder(public_tokenizers.path("word_bpe_49k.json"), words)
        got = []
        for at in range(0, len(texts), 7):
            got += [np.frombuffer(raw, "<u4").tolist() for raw in encoder.encode(texts[at : at + 7])]
        assert got == expected


def test_words_of_every_character_equal_the_tokenizers(tokenizer):
    """Words that are parted here, and those at the edge of what is left to the library."""
    marks = [chr(c) for c in range(33, 0x370)]
    words = [a + b + c for a in marks for b in ("a", "É", "1", "'") for c in ("", "s", "ß", "LL")]
    words += ["a" + m for m in marks] + ["don'T", "'RE", "x'lls", "<|endoftext|>", "<|x", "İ", "ǅ", "ŉ", "K", "\u0149a"]
    found = b.WordEncoder(public_tokenizers.path("word_bpe_49k.json")).encode(words)
    expected = tokenizer.encode_batch(words, add_special_tokens=False)
    assert [w for w, raw, e in zip(words, found, expected) if np.frombuffer(raw, "<u4").tolist() != e.ids] == []


@pytest.mark.parametrize("block", [8, 256, 1024])
@pytest.mark.parametrize("share", [0.01, 0.9, 1.0])
def test_segments_round_trip(block, share):
    draw = np.random.default_rng(block)
    for n in (0, 1, 7, 8, block - 1, block, block + 1, 5000):
        for top in (1, 2, 300, 50_000, 1 << 32):
            ids = draw.integers(0, top, n, dtype=np.uint64)
            ids[draw.random(n) < 0.05] = top - 1
            data = b.pack_segment(ids, block, share)
            assert (b.unpack_segment(data) == ids).all() and len(b.unpack_segment(data)) == n
            for a, z in ((0, 1), (n // 3, n // 2), (n - 1, n + 9), (5, 5)):
                assert b.unpack_segment(data, max(a, 0), z).tolist() == ids[max(a, 0) : z].tolist()


def test_outliers_become_exceptions():
    ids = np.full(256, 1000, np.uint64)
    ids[::2] = 1003
    narrow = len(b.pack_segment(ids))
    ids[17] = 4_000_000_000
    data = b.pack_segment(ids)
    assert len(data) == narrow + 6 and (b.unpack_segment(data) == ids).all()
    # Head, two index entries, block head, two bits an id, one exception.
    assert len(data) == b.HEAD.size + 8 + 7 + 64 + 6


def test_a_read_touches_only_its_blocks():
    ids = np.arange(1000, dtype=np.uint64)
    data = bytearray(b.pack_segment(ids, 256))
    body = b.HEAD.size + 4 * 5
    first = np.frombuffer(data, "<u4", 5, b.HEAD.size)
    data[body + first[0] : body + first[1]] = b"\xff" * int(first[1] - first[0])
    assert b.unpack_segment(bytes(data), 300, 400).tolist() == list(range(300, 400))
    with pytest.raises(ValueError):
        b.unpack_segment(b"nope" + bytes(data[4:]))


def expected(rows, tokenizer):
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def found(docs, **options):
    rows = b.written_and_read(docs, **options)
    return [tuple(r) for r in rows.select("doc_id", "start", "n_tokens", F.crc32("ids")).orderBy("start").collect()]


@pytest.mark.parametrize("segment", [1, 500, 1 << 20])
def test_files_hold_every_document_in_order(spark, tokenizer, segment):
    texts = [*STRANGE, None, *[prose(i, 20 * (i % 7)) for i in range(60)], prose(9, 40_000)]
    docs = documents(spark, texts, first=-5)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found(docs.orderBy("text").repartition(5), segment=segment) == expected(rows, tokenizer)


def test_odd_rows(spark, odd, tokenizer):
    rows = found(odd)
    want = expected([(r["doc_id"], r["text"]) for r in odd.collect()], tokenizer)
    assert sorted((str(r[0]), *r[2:]) for r in rows) == sorted((str(r[0]), *r[2:]) for r in want)
    starts = [r[1] for r in rows]
    assert starts == [sum(r[2] for r in rows[:i]) for i in range(len(rows))]
    assert [r[0] for r in rows] == [r[0] for r in want]
    assert found(odd.limit(0)) == []
    assert found(spark.createDataFrame([(3, None, None, None, None)], SCHEMA)) == [(3, 0, 1, zlib.crc32(b"\2\0\0\0"))]
