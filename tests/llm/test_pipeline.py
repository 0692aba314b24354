"""The stages of the pipeline, each on rows of its own, and all of them one after the other."""

import re
import shutil
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakewright.llm import near_dup, packing, pii
from lakewright.llm.graph import SMALL_BATCHES, small_batches

SF_DIR = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Labels and a benchmark beside which any documents can stand."""
    path = tmp_path_factory.mktemp("tables")
    for name in ("labels", "benchmark"):
        shutil.copy(f"{SF_DIR}/{name}.parquet", path / f"{name}.parquet")
    return str(path)


def rows_of(df):
    return Counter(map(str, df.collect()))


def shingles(text, words=5):
    own = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(own[i : i + words]) for i in range(max(1, len(own) - words + 1))} if own else set()


def test_stages_keep_columns_that_clash(spark, awkward, nothing, folder):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, awkward, folder)
        assert out.columns == awkward.columns and dict(out.dtypes) == dict(awkward.dtypes)
        kept = out.drop("doc_id", "text").distinct().collect()
        assert [set(r) for r in kept] == [{"kept"}]
        assert stage(spark, nothing, folder).count() == 0
    assert corpus_pipeline.pack_sequences(spark, nothing, folder).count() == 0


def test_near_duplicates_leave_one_of_each_group(spark, awkward, folder):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    kept = corpus_pipeline.drop_near_duplicates(spark, awkward, folder).collect()
    # Only equal texts are similar among these rows.
    groups = {}
    for doc_id, text in rows:
        if shingles(text):
            groups.setdefault(frozenset(shingles(text)), []).append(doc_id)
    stay = Counter(min(i for i in ids if i is not None) if any(i is not None for i in ids) else None for ids in groups.values())
    stay += Counter(i for i, text in set(rows) if not shingles(text))
    assert Counter(r["doc_id"] for r in kept) == stay


def test_a_large_group_of_near_copies_needs_few_comparisons(spark, folder, monkeypatch):
    rng = np.random.default_rng(4)
    rows = []
    for number in range(400):
        words = [f"w{i}" for i in range(110)]
        for at in rng.choice(len(words), int(rng.integers(1, 9)), replace=False):
            words[at] = f"x{rng.integers(0, 3000)}"
        rows.append((number, " ".join(words)))
    likely, compared = near_dup._likely, []
    monkeypatch.setattr(near_dup, "_likely", lambda pairs, nodes: compared.append(pairs.count()) or likely(pairs, nodes))
    kept = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), folder).collect()
    sets, group = [shingles(text) for _, text in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if group[i] != group[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    assert sorted(r["doc_id"] for r in kept) == sorted(set(group))
    assert 100 < len(kept) < 350
    assert sum(compared) < 25 * len(rows), compared


def test_contaminated_documents_go_and_clean_ones_stay(spark, folder):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]

    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))

    windows = set()
    for item in map(words, items):
        size = min(10, len(item))
        windows |= {tuple(item[i : i + size]) for i in range(len(item) - size + 1)} if item else set()
    sizes = {len(w) for w in windows}

    def clean(text):
        own = words(text)
        return not any(tuple(own[i : i + size]) in windows for size in sizes for i in range(len(own) - size + 1))

    expected = {r["doc_id"] for r in documents.collect() if clean(r["text"])}
    kept = corpus_pipeline.drop_contaminated(spark, documents, folder)
    assert {r["doc_id"] for r in kept.collect()} == expected and 0 < documents.count() - len(expected) < 200


def test_personal_data_is_replaced(spark, folder):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    redacted = {r["doc_id"]: r for r in corpus_pipeline.redact_personal_data(spark, documents, folder).collect()}
    before = {r["doc_id"]: r for r in documents.collect()}
    assert set(redacted) == set(before)
    for doc_id, row in redacted.items():
        assert row["n_chars"] == len(row["text"]) and (row["lang"], row["source"]) == (before[doc_id]["lang"], before[doc_id]["source"])
        base = pii.rule_spans(before[doc_id]["text"])
        assert base or row["text"] == before[doc_id]["text"] or "[" in row["text"]
        for a, b, kind in base:
            assert before[doc_id]["text"][a:b] not in row["text"] or kind == "ip"


def test_all_stages_one_after_the_other(spark, folder):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    docs = documents
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SF_DIR).cache()
        assert docs.columns == documents.columns
        ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert ids <= {r["doc_id"] for r in before.select("doc_id").collect()} and len(ids) > 500
    packed = corpus_pipeline.run(spark, SF_DIR)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == ids
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0


def test_a_task_of_the_redaction_holds_one_python_worker(spark, folder):
    docs = spark.createDataFrame([(1, "mail me at someone@example.org"), (2, None)], "doc_id bigint, text string")
    out = corpus_pipeline.redact_personal_data(spark, docs, folder)
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: "mail me at [email]", 2: None}


def test_packing_gets_texts_in_small_batches(spark, monkeypatch):
    cut, seen = packing.encoded_pieces, []

    def watched(docs, *args):
        seen.append({key: spark.conf.get(key) for key in SMALL_BATCHES})
        return cut(docs, *args)

    before = {key: spark.conf.get(key) for key in SMALL_BATCHES}
    monkeypatch.setattr(packing, "encoded_pieces", watched)
    docs = spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.lit("a few words").alias("text"))
    assert corpus_pipeline.pack_sequences(spark, docs, "").count() == 3000
    assert seen == [SMALL_BATCHES] and {key: spark.conf.get(key) for key in SMALL_BATCHES} == before

    def sizes(batches):
        for batch in batches:
            yield batch.select(["doc_id"]).slice(0, 1)

    with small_batches(spark):
        assert docs.mapInArrow(sizes, "doc_id bigint").count() == 3
        wide = docs.select("doc_id", F.repeat(F.lit("x"), 100_000).alias("text"))
        assert wide.mapInArrow(sizes, "doc_id bigint").count() > 30
