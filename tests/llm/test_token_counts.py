"""Token counts against the library itself."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from assaylake.llm import queries, token_counts

from .test_llm import documents, none, odd  # noqa: F401


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(token_counts.TOKENIZER)


@pytest.fixture(scope="module")
def merges():
    with open(token_counts.TOKENIZER, encoding="utf-8") as f:
        return token_counts.Merges(f.read())


def sizes(library, texts):
    return [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_whole_tables_count_as_the_library_does(spark, sf, library):
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = dict(zip((r["doc_id"] for r in rows), sizes(library, [r["text"] for r in rows])))
    got = queries.op12_token_counts(spark, sf).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == want and len(got) == len(rows)
    texts = {r["doc_id"]: r["text"] or "" for r in rows}
    for r in got:
        assert r["n_bytes"] == len(texts[r["doc_id"]].encode()) and r["over_limit"] == (r["n_tokens"] > 1024)
    assert len({r["over_limit"] for r in got}) == 2


def test_odd_rows(spark, odd, none, library):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = token_counts.count_tokens(odd).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(((r["doc_id"], r["n_tokens"]) for r in got), key=key) == sorted(zip((d for d, _ in rows), sizes(library, [t for _, t in rows])), key=key)
    assert token_counts.count_tokens(none).count() == 0
    assert [f.dataType.simpleString() for f in token_counts.count_tokens(none).schema] == ["bigint", "bigint", "bigint", "boolean"]


def test_any_text(library, merges):
    """White space of every kind, endings, special strings, marks and letters of many scripts, in one array and apart."""
    rnd = random.Random(12)
    bits = [*"  ''sstremdlvZ19 \n\t\r.,!", "\u00e9", "\u00b2", "\u3000", "\x85", "\xa0", "\u200b", "\u4e2d", "\U0001f642", "\u0301", "\u180e", "<|endoftext|>", "'re", "'ll", "'ve", " '", "<|endof", "text|>"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 40))) for _ in range(6000)]
    texts += ["".join(chr(rnd.choice([rnd.randrange(0xD800), rnd.randrange(0xE000, 0x110000), rnd.randrange(0x3000)])) for _ in range(20)) for _ in range(4000)]
    assert token_counts.count_texts(pa.array(texts), merges).tolist() == sizes(library, texts)
    sliced = pa.array(texts).slice(700, 300)
    assert token_counts.count_texts(sliced, merges).tolist() == sizes(library, texts[700:1000])


@pytest.mark.parametrize("text", ["a" * 50_000, "ab" * 30_000, " " * 40_000, "x'" * 20_000, "the" * 20_000])
def test_long_pieces(text, library, merges):
    assert token_counts.count_texts(pa.array([text]), merges).tolist() == sizes(library, [text])


def test_what_is_kept_is_bounded(monkeypatch, library):
    monkeypatch.setattr(token_counts, "KEPT_PIECES", 10)
    with open(token_counts.TOKENIZER, encoding="utf-8") as f:
        merges = token_counts.Merges(f.read())
    texts = [f"word{k % 37} and{k % 5}" for k in range(500)]
    assert token_counts.count_texts(pa.array(texts), merges).tolist() == sizes(library, texts)
    assert len(merges.counts) <= 10 and len(merges.before) <= 10
    assert len(token_counts.count_texts(pa.array([], pa.string()), merges)) == 0
    assert np.array_equal(token_counts.count_texts(pa.array(["", ""]), merges), [0, 0])


def test_other_vocabularies_are_refused(spark, none):
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f, pytest.raises(ValueError):
        token_counts.Merges(f.read())
