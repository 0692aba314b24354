"""Ranked search against brute force and SQL."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakewright.llm import ball_tree, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def ranked(docs, items, k=10):
    """Every item's best documents by scoring all pairs; ``docs`` and ``items`` are (id, text)."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, words = sum(bool(c) for _, c in counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item_id, text in set(items):
        own, scored = Counter(terms(text)), []
        for doc_id, c in counted:
            score = 0
            for term, times in own.items():
                if c[term]:
                    m = 25 + (75 * sum(c.values()) * n_docs) // words
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    score += times * w * ((10**9 * c[term]) // (1000 * c[term] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, none, doc_id) in enumerate(sorted(scored)[:k], 1):
            out.append((item_id, rank, None if none else doc_id, -score))
    return sorted(out, key=str)


def found(spark, docs, items, k=10):
    frame = ball_tree.rank_documents(docs, items, k)
    assert frame.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, frame.collect()), key=str)


def test_all_documents_equal_the_sql(spark, documents):
    import duckdb

    database = duckdb.connect()
    for name in ("documents", "benchmark"):
        database.execute(f"CREATE VIEW {name} AS SELECT * FROM '/root/testdata/sf0.01/{name}.parquet'")
    frame = queries.QUERIES["op12_ranked_search"](spark, "/root/testdata/sf0.01")
    expected = database.sql(queries.ORACLES["op12_ranked_search"])
    assert sorted(frame.columns) == sorted(expected.columns)
    rows = expected.select("item_id, rank, doc_id, score").fetchall()
    assert sorted(map(tuple, frame.select("item_id", "rank", "doc_id", "score").collect())) == sorted(rows) and len(rows) > 100


ITEMS = [(1, "same text, in TWO rows"), (1, "same text, in TWO rows"), (2, None), (3, ""), (None, "word1 und3 é"), (4, "?!"), (5, "absent"), (6, "word1 " * 3)]


@pytest.mark.parametrize("block", [1, ball_tree.BLOCK_BYTES])
def test_awkward_rows_and_blocks_of_items(spark, awkward, nothing, monkeypatch, block):
    monkeypatch.setattr(ball_tree, "BLOCK_BYTES", block if block > 1 else 60)
    items = spark.createDataFrame([(*row, "kept") for row in ITEMS], "item_id bigint, text string, term string")
    docs = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert found(spark, awkward, items) == ranked(docs, ITEMS)
    assert found(spark, nothing, items) == [] and found(spark, awkward, items.where("false")) == []


def test_one_id_with_two_texts_is_two_items(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "b c"), (3, "c d e")], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, "a"), (7, "e")], "item_id bigint, text string")
    assert [r[:3] for r in found(spark, docs, items)] == [(7, 1, 1), (7, 1, 3)]


def test_ties_and_small_trees(spark, monkeypatch):
    """Many equal texts, trees of a few documents, leaves of one."""
    monkeypatch.setattr(ball_tree, "LEAF", 1)
    rows = [(i, "alpha beta gamma " * (i % 3 + 1) + f"w{i % 5}") for i in range(60)]
    items = [(1, "alpha"), (2, "w3 beta"), (3, "gamma w1 w1")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert found(spark, docs, spark.createDataFrame(items, "item_id bigint, text string"), 7) == ranked(rows, items, 7)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 200), st.integers(1, 8))
def test_no_document_beats_the_bound_of_its_balls(seed, count, leaf):
    rng = np.random.default_rng(seed)
    width = 40
    own = [np.sort(rng.choice(width, rng.integers(1, 12), replace=False)) for _ in range(count)]
    bounds = np.concatenate(([0], np.cumsum([len(o) for o in own])))
    values = rng.integers(1, 10**6, bounds[-1])
    weights = rng.integers(1, 20_000, width)
    tree = ball_tree.BallTree(ball_tree.Rows(bounds, np.concatenate(own).astype(np.int32), values), weights, leaf)
    assert sorted(tree.order.tolist()) == list(range(count))
    used = np.sort(rng.choice(width, 6, replace=False))
    query = ball_tree.Query(used, weights[used] * rng.integers(1, 4, 6))
    dense = np.zeros(width, np.int64)
    dense[used] = query.weights
    scores = np.array([(dense[o] * values[bounds[i] : bounds[i + 1]]).sum() for i, o in enumerate(own)])
    scaled = np.zeros(width)
    scaled[used] = query.weights / tree.scale[used]
    norms = np.sqrt(np.bincount(used % ball_tree.SUBSPACES, scaled[used] ** 2, ball_tree.SUBSPACES))
    for node, (a, b) in enumerate(tree.ranges):
        assert tree._bounds(node, node + 1, scaled, norms)[0] >= scores[tree.order[a:b]].max()
    best = ball_tree.Best(5)
    best.names = (np.arange(count), np.ones(count, bool))
    tree.search(query, np.zeros(width, np.int64), best)
    expected = sorted((-s, i) for i, s in enumerate(scores.tolist()) if s > 0)[:5]
    assert list(zip((-best.scores).tolist(), best.ids.tolist(), strict=True)) == expected


def test_long_texts_are_counted_by_slices(monkeypatch):
    monkeypatch.setattr(ball_tree, "SLICE", 7)
    text = ("Aa b,c dddddddddddddddd e " * 20).encode()
    assert [w.decode() for words in ball_tree.word_slices(text) for w in words] == terms(text.decode())
