"""Ranked search against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from barloom.llm import search
from barloom.llm.search import ranked_search

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ODD = [None, "", " .", "one", "One one, ONE", "É é", "a" * 30_000, "one two " * 4000]


def words(text):
    return [w.decode() for w in WORD.findall(bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))]


def plain(docs, queries, k):
    """(item, rank, doc_id, score) of every query, by counting."""
    counted = [(i, Counter(words(t))) for i, t in docs]
    lengths = [sum(c.values()) for _, c in counted]
    n_docs, total = sum(n > 0 for n in lengths), sum(lengths)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in queries:
        found = []
        for (doc_id, c), n in zip(counted, lengths, strict=True):
            m = 10 + 90 * n * n_docs // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in set(words(text)) if t in c)
            if score > 0:
                found.append((-score, math.inf if doc_id is None else doc_id))
        out += [(item, r, None if d == math.inf else d, -s) for r, (s, d) in enumerate(sorted(found)[:k], 1)]
    return out


def corpus(n=300, seed=5):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(200)]
    weights = [1 / (i + 1) for i in range(200)]
    texts = [" ".join(rng.choices(vocabulary, weights, k=rng.choice((3, 20, 80)))) for _ in range(n)]
    queries = [" ".join(rng.choices(vocabulary, weights, k=rng.choice((1, 4, 30)))) for _ in range(40)]
    # copies, some of them many, so that equal scores abound
    return texts + texts[:40] + [texts[1]] * 30 + ODD, queries + [queries[0], None, "", "nowhere", "One"]


def rows_of(df):
    return Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect())


def tables(spark, texts, queries, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    docs = spark.createDataFrame([(i, t, "x", 3) for i, t in zip(ids, texts, strict=True)],
                                 "doc_id long, text string, TEXT string, score int").repartition(3)
    asked = spark.createDataFrame([(i, q, "y") for i, q in enumerate(queries)], "item_id long, text string, doc_id string")
    return docs, asked


@pytest.mark.parametrize("change", [{}, {"CHUNK_BYTES": 1 << 16, "BLOCK": 3, "FIRST": 1}, {"GROUP_BYTES": 600}, {"SEED_DOCS": 30}])
def test_ranked_search(spark, monkeypatch, change):
    for name, value in change.items():
        monkeypatch.setattr(search, name, value)
    texts, queries = corpus()
    docs, asked = tables(spark, texts, queries)
    expected = plain(list(enumerate(texts)), list(enumerate(queries)), 10)
    assert rows_of(ranked_search(docs, asked)) == Counter(expected)
    assert rows_of(ranked_search(docs, asked, k=1)) == Counter(r for r in expected if r[1] == 1)


def test_ids_may_repeat_or_lack(spark):
    texts, queries = corpus(60)
    ids = [None if i % 7 == 0 else i // 3 for i in range(len(texts))]
    docs, asked = tables(spark, texts, queries, ids)
    twice = asked.union(asked)
    expected = plain(list(zip(ids, texts, strict=True)), list(enumerate(queries)), 10)
    assert rows_of(ranked_search(docs, twice)) == Counter(expected * 2)


def test_empty_tables(spark):
    docs, asked = tables(spark, ["one two"], ["one"])
    for d, q in ((docs.limit(0), asked), (docs, asked.limit(0)), (docs.selectExpr("doc_id", "'' AS text"), asked)):
        out = ranked_search(d, q)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.count() == 0
    # the one document holds every term, and still scores
    assert [tuple(r) for r in ranked_search(docs, asked).collect()] == [
        (0, 1, 0, math.floor(1000 * math.log(4 / 3)) * (10**9 // 1800))]


def test_blocks_bound_their_documents():
    rng = np.random.default_rng(1)
    lengths = rng.integers(0, 30, 200)
    terms = np.concatenate([np.sort(rng.choice(50, n, replace=False)) for n in lengths])
    chunk = search.Chunk(np.arange(200), lengths, terms, rng.integers(1, 10**9, len(terms)), 50)
    for t in range(50):
        rows, firsts, summary = chunk.blocks(t, np.arange(50))
        assert sorted(rows) == sorted(np.flatnonzero(chunk.dense[:, t]))
        for first, last, most in zip(firsts, [*firsts[1:], len(rows)], summary, strict=True):
            assert last - first <= search.BLOCK and (chunk.dense[rows[first:last]] <= most).all()
            assert (chunk.dense[rows[first:last]].max(axis=0) == most).all()


def test_few_documents_are_scored():
    """With floors at hand most blocks of a list are skipped."""
    texts, queries = corpus(1500)
    vocabulary = {w: i for i, w in enumerate(sorted({w for q in queries for w in words(q)}))}
    counted = [Counter(w for w in words(t) if w in vocabulary) for t in texts]
    terms = np.array([vocabulary[w] for c in counted for w in sorted(c, key=vocabulary.get)])
    impacts = np.array([10**6 * c[w] // (c[w] + 1) * (vocabulary[w] + 1) for c in counted for w in sorted(c, key=vocabulary.get)])
    chunk = search.Chunk(np.arange(len(texts)), np.array([len(c) for c in counted]), terms, impacts, len(vocabulary))
    asked = [np.array(sorted({vocabulary[w] for w in words(q)}), dtype=np.int64) for q in queries]
    first = search.Best(np.ones(len(asked), np.int64), 10)
    search.search_chunk(chunk, asked, first)
    again = search.Best(first.floors, 10)
    scored = []
    add = again.add
    again.add = lambda q, docs, scores: (scored.append(len(docs)), add(q, docs, scores))
    search.search_chunk(chunk, asked, again)
    assert all((a == b).all() for a, b in zip(first.scores, again.scores, strict=True))
    holding = sum(int((chunk.dense[:, a] > 0).any(axis=1).sum()) for a in asked if len(a))
    assert sum(scored) < holding / 2
