"""Phrase collocations against brute force and SQL."""

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lakewright.llm import collocations, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def mined(docs, top, least, percent=50):
    """All phrases of all lengths, one language at a time; ``docs`` are (text, lang)."""
    runs = {1: defaultdict(Counter), 2: defaultdict(Counter), 3: defaultdict(Counter)}
    for text, lang in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size, counts in runs.items():
                for i in range(len(words) - size + 1):
                    counts[lang or "und"][tuple(words[i : i + size])] += 1
    out = []
    for lang, ones in runs[1].items():
        f = {**ones, **runs[2][lang], **runs[3][lang]}
        candidates = {}
        for phrase, a in f.items():
            if len(phrase) > 1 and a >= least:
                cuts = [(10**6 * a * a // (f[phrase[:k]] * f[phrase[k:]]), k) for k in range(1, len(phrase))]
                score, k = min(cuts)
                candidates[phrase] = (score, a, f[phrase[:k]], f[phrase[k:]])
        longest = Counter()
        for phrase, (_, a, _, _) in candidates.items():
            if len(phrase) == 3:
                for part in (phrase[:2], phrase[1:]):
                    longest[part] = max(longest[part], a)
        alive = [(-s, -a, " ".join(p), x, y) for p, (s, a, x, y) in candidates.items() if 100 * longest[p] < percent * a]
        for rank, (s, a, phrase, x, y) in enumerate(sorted(alive, key=lambda r: (r[0], r[1], r[2].encode()))[:top], 1):
            out.append((lang, rank, phrase, -a, x, y, sum(ones.values()), -s))
    return sorted(out)


def rows_of(frame):
    assert frame.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, frame.collect()))


def test_all_documents_equal_the_sql(spark):
    database = duckdb.connect()
    database.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.01/documents.parquet'")
    frame = queries.QUERIES["op11_collocations"](spark, "/root/testdata/sf0.01")
    expected = database.sql(queries.ORACLES["op11_collocations"])
    assert sorted(frame.columns) == sorted(expected.columns)
    kinds = dict(zip(expected.columns, map(str, expected.types), strict=True))
    assert all(kinds[f.name] == {"bigint": "BIGINT", "string": "VARCHAR"}[f.dataType.simpleString()] for f in frame.schema)
    rows = expected.fetchall()
    assert rows_of(frame) == sorted(rows) and len(rows) > 200


def test_all_documents_equal_brute_force(documents):
    docs = [(r["text"], r["lang"]) for r in documents.collect()]
    assert rows_of(collocations.collocations(documents, top=50, first_taken=60)) == mined(docs, 50, 10)


TEXTS = [
    ("New York city. New York City, new york", "en"), ("new york state of mind; state of mind", "en"), ("of mind", None), (None, "en"), ("", "fr"),
    ("a a a a a a", "aa"), ("a a b a a b a a c", "aa"), ("x\ty  z\nx y z\x0bx y z", "en"), (" é é é ÉÉ Éé é é", None), ("one", "xx"), ("in a in a in a, in a b in a b", "en"),
]


@pytest.mark.parametrize(("top", "taken"), [(1, 1), (3, 2), (4, 1), (100, 1000)])
def test_small_texts_in_several_rounds(spark, monkeypatch, top, taken):
    monkeypatch.setattr(collocations, "GROWTH", 2)
    monkeypatch.setattr(collocations, "SCORE_STEP", 10)
    rows = [(*row, "kept", 7) for row in TEXTS * 2]
    docs = spark.createDataFrame(rows, "text string, lang string, n string, h1 int").repartition(3)
    found = rows_of(collocations.collocations(docs, top=top, least_count=2, first_taken=taken))
    assert found == mined([r[:2] for r in rows], top, 2)


def test_random_texts_in_several_rounds(spark, monkeypatch):
    monkeypatch.setattr(collocations, "GROWTH", 2)
    rng = np.random.default_rng(5)
    rows = []
    for i in range(300):
        words = rng.zipf(1.3, 40)
        rows.append((" ".join(f"w{min(w, 60)}" + ("," if w % 7 == 0 else "") for w in words), ["a", "b", None][i % 3]))
    docs = spark.createDataFrame(rows, "text string, lang string")
    found = rows_of(collocations.collocations(docs, top=30, least_count=3, first_taken=5))
    assert found == mined(rows, 30, 3) and len(found) == 90


def test_words_are_counted_by_language_under_distinct_hashes(spark):
    docs = spark.createDataFrame(TEXTS, "text string, lang string").withColumn("lang", F.coalesce("lang", F.lit("und")))
    words, seed = collocations.count_words(docs)
    rows = words.collect()
    assert seed == 0 and len({(r["lang"], r["h"]) for r in rows}) == len(rows) == len({(r["lang"], r["word"]) for r in rows})
    assert {(r["lang"], r["word"]): r["n"] for r in rows}["en", "york"] == 4


def test_awkward_rows_and_nothing(awkward, nothing):
    docs = awkward.withColumn("lang", F.lit(None).cast("string"))
    found = rows_of(collocations.collocations(docs, least_count=3))
    assert found == mined([(r["text"], None) for r in awkward.collect()], 2000, 3)
    assert collocations.collocations(nothing.withColumn("lang", F.lit("en"))).count() == 0


def test_scores_are_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(int(a), int(a + x), int(a + y)) for a, x, y in rng.integers(1, 4 * 10**12, (400, 3)).tolist()]
    rows += [(a, a, a) for a in (1, 10, 10**13 - 1)] + [(3, 7, 11), (10**12 + 1, 10**12 + 1, 10**12 + 2)]
    frame = spark.createDataFrame(rows, "a bigint, l bigint, r bigint").withColumn("score", collocations.score_of("a", "l", "r"))
    assert all(r["score"] == 10**6 * r["a"] ** 2 // (r["l"] * r["r"]) for r in frame.collect())


def test_large_word_tables_are_not_broadcast(spark, documents, rows, monkeypatch):
    docs = documents.limit(300).select("text", "lang")
    expected = rows(collocations.collocations(docs, 50, 5))
    limits, join = [], collocations.keyed_join

    def noted(left, right, on, how, broadcast_bytes=None, right_bytes=None):
        if right_bytes is None:
            limits.append(broadcast_bytes)
        return join(left, right, on, how, 0 if right_bytes is None else broadcast_bytes, right_bytes)

    monkeypatch.setattr(collocations, "keyed_join", noted)
    found = collocations.collocations(docs, 50, 5)
    assert limits and all(limit is not None and limit <= 8 << 20 for limit in limits)
    assert rows(found) == expected and len(expected) > 50
