"""Phrase collocations against plain counts, and summaries against their guarantee."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from assaylake.llm import collocations, filters, queries
from tests.compare import connect, differences

from .test_llm import UP, documents, none, odd  # noqa: F401


def plain(rows, least, longest=5, top=2000):
    n, f = Counter(), defaultdict(Counter)
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(UP)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        held = {p: a for p, a in counts.items() if a >= least and len(p) > 1}
        rows = []
        for p, a in held.items():
            if any(len(q) > len(p) and held[q] >= a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q in held):
                continue
            cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows.append((-score, -a, " ".join(p), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i + 1, p, -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(rows, key=lambda x: (x[0], x[1], x[2].encode()))[:top])]
    return sorted(out)


def got(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def test_query_matches_its_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert differences(spark, connect(sf), "op13", queries.op13_collocations, queries.oracle_sql()["op13_collocations"], sf) == ""


@pytest.mark.parametrize("least, longest", [(5, 5), (12, 3), (3, 2)])
def test_phrases_of_a_table(spark, sf, least, longest):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = plain([(r["text"], r["lang"]) for r in docs.collect()], least, longest, top=150)
    assert got(collocations.collocations(docs, least=least, longest=longest, top=150)) == want and len(want) > 100


def test_odd_rows(spark, odd, none):
    rows = [(r["text"], r["lang"]) for r in odd.collect()]
    assert got(collocations.collocations(odd, least=1)) == plain(rows, 1)
    assert got(collocations.collocations(odd, least=2)) == plain(rows, 2)
    assert collocations.collocations(none).count() == 0
    assert [t for _, t in collocations.collocations(none).dtypes] == ["string", "bigint", "string", "bigint", "bigint", "bigint", "bigint", "bigint"]


def test_pieces_and_blanks(spark):
    rows = [("A b\tC, d e\x0bf \u00c9 g\u00a0h! a b c;;d e \x85 i", "x")] * 3 + [("a b", "x"), (" a b c d e f g " * 9, None), ("b\u00c9 b\u00e9 b\u00e9 b\u00e9", "und"), ("...", "y"), ("z z z z z z z z", "x")]
    docs = spark.createDataFrame(rows, "text string, lang string")
    for least in (1, 2, 3, 9):
        assert got(collocations.collocations(docs, least=least)) == plain(rows, least)


def test_one_phrase_in_most_rows(spark):
    """A hot phrase and many rare ones; capacities are far below the distinct phrases."""
    rnd = random.Random(1)
    rows = [("of the same kind. " * 20 + " ".join(rnd.choice(["%d" % rnd.randrange(60), "red", "blue"]) for _ in range(60)), "en") for _ in range(200)]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(7)
    assert got(collocations.collocations(docs, least=40)) == plain(rows, 40)


def test_products_beyond_64_bits(spark):
    parts = spark.createDataFrame([(10**15, 4 * 10**15, 10**15, 2 * 10**15)], "a long, total long, l long, r long")
    value = parts.selectExpr("(1000BD * cast(a as decimal(16, 0)) * cast(total as decimal(16, 0))) div (cast(l as decimal(18, 0)) * cast(r as decimal(18, 0))) s").first()["s"]
    assert value == 1000 * 10**15 * 4 * 10**15 // (10**15 * 2 * 10**15)


@pytest.mark.parametrize("pieces", [1, 5, 40])
def test_summaries_lose_no_frequent_key(pieces):
    """Whatever the order and the number of merges: a count is at most mass / (capacity + 1) too low."""
    rng = np.random.default_rng(pieces)
    keys = np.concatenate([rng.zipf(1.3, 60_000) % 50_000, np.repeat(np.arange(60_000, 60_040), 100), rng.integers(10**6, 10**9, 100_000)]).astype(np.uint64)
    rng.shuffle(keys)
    least = 100
    summary = collocations.Summary(len(keys) // least + 1)
    for part in np.array_split(keys, pieces):
        k, n = np.unique(part, return_counts=True)
        summary.add(k, n.astype(np.int64))
        summary.merge()
        assert len(summary.keys) <= summary.capacity
    distinct, counts = np.unique(keys, return_counts=True)
    assert set(distinct[counts >= least].tolist()) <= set(summary.frequent(least).tolist())
    true = dict(zip(distinct.tolist(), counts.tolist()))
    assert 0 < summary.taken < least
    assert all(true[k] - summary.taken <= c <= true[k] for k, c in zip(summary.keys.tolist(), summary.counts.tolist()))


def test_filters_hold_their_keys(spark):
    keys = np.random.default_rng(3).integers(0, 2**64, 5000, dtype=np.uint64)
    frame = spark.createDataFrame(pa.table({"key": keys.view(np.int64)}))
    for count in (5000, 10, 10**12):
        limit = filters.MOST_BITS
        try:
            filters.MOST_BITS = 1 << 18
            made = filters.key_filter(frame, count)
        finally:
            filters.MOST_BITS = limit
        assert filters.passes(made, keys).all() and 64 * len(made) <= 1 << 18
    assert not filters.passes(filters.key_filter(frame.limit(0), 0), keys).any()


def test_slices_of_arrays():
    texts, langs = pa.array([f"Word{k} and É{k}, more" * (k % 5) for k in range(50)]), pa.array(["x", "y"] * 25)
    part, copy = collocations.Words(texts.slice(17, 20), langs.slice(17, 20)), collocations.Words(pa.array(texts.to_pylist()[17:37]), pa.array(langs.to_pylist()[17:37]))
    said = lambda w: [(w.names[a], w.langs[b], p) for a, b, p in zip(w.word, w.lang, w.piece)]
    assert len(part) > 50 and said(part) == said(copy)
