import zlib

import numpy as np
import public_tokenizers
import pytest
from arrears.llm import packing as p
from arrears.llm.bpe import SPECIALS, Encoder
from tokenizers import Tokenizer

from .conftest import documents, prose

STRANGE = [
    "", " ", "a", " a", "a ", "a  b", "\n", "a\nb", "a \nb", "a\n b", "x\n\ny", "don't we'll", "ſ²³ ½", "1234 5 6.7",
    "<|endoftext|> b", " a b", "é🙂漢字 かな", "a\x1cb\x85c", "tab\tend", "CAPS!! **bold**", "end\n",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_specials_are_those_of_the_file(tokenizer):
    assert {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()} == SPECIALS


@pytest.mark.parametrize("gap", [" " * 20_000, "\n" * 20_000, "\u3000 \x85\t" * 5000, " " * 1_200_000])
def test_long_gaps(tokenizer, gap):
    encoder = Encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    texts = [gap, f"a b{gap}", f"{gap}a b", f"a{gap}b c{gap}\nd", f"a{gap}<|endoftext|>{gap}b"]
    got = [np.frombuffer(raw, "<u4").tolist() for raw in encoder.encode(texts)]
    assert got == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_ids_equal_the_tokenizers(tokenizer, tables_dir):
    import pyarrow.parquet as pq

    texts = STRANGE + pq.read_table(f"{tables_dir}/documents.parquet")["text"].to_pylist()
    for words in (400_000, 50):
        encoder = Encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, words)
        got = [np.frombuffer(raw, "<u4").tolist() for raw in encoder.encode(texts)]
        assert got == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_holds(rule):
    capacity = p.Capacity(tokens=100, documents=3, attention=10_000, rule=rule)
    lengths = np.random.default_rng(1).integers(1, 101, 500)
    sequence, offset = p.best_fit(lengths, capacity)
    for s in np.unique(sequence):
        mine = sequence == s
        assert lengths[mine].sum() <= 100 and mine.sum() <= 3 and (lengths[mine] ** 2).sum() <= 10_000
        order = np.argsort(offset[mine])
        assert (np.cumsum(lengths[mine][order]) - lengths[mine][order] == offset[mine][order]).all()


def test_best_fit_needs_few_sequences():
    lengths = np.random.default_rng(2).integers(1, 1500, 3000)
    sequence, _ = p.best_fit(lengths)
    assert len(np.unique(sequence)) <= -(-lengths.sum() // 2048) * 1.01 + 1
    assert len(np.unique(p.best_fit(np.array([1024] * 10))[0])) == 5


def test_pieces_restore_documents(spark, odd, tokenizer):
    docs = documents(spark, [prose(1, 3000), "", None, prose(2, 10)]).unionByName(odd.select("doc_id", "text", "lang", "source", "n_chars"))
    rows = p.pack(docs, group=3).collect()
    expected = []
    for r in docs.collect():
        ids = np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        expected += [(r["doc_id"], i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert sorted(got, key=str) == sorted(expected, key=str)
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert p.pack(docs.limit(0)).collect() == []
