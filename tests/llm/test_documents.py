"""Sharding, decontamination, personal data, near duplicates, quality, scoring, search: against brute force."""

import hashlib
import io
import math
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakewright.llm import context_tree, decontamination, near_dup, pii, quality, scoring, search, sharding

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Sharding


def test_shards(awkward, documents):
    for docs in (awkward, documents):
        rows = sharding.shard_documents(docs, 16).collect()
        assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in docs.collect())
        assert all(r["grown_shard"] in (r["shard"], 16) and 0 <= r["shard"] < 16 for r in rows)
        assert len({(r["doc_id"], r["shard"]) for r in rows}) == len({r["doc_id"] for r in rows})
        slots = defaultdict(list)
        for r in rows:
            slots[r["shard"]].append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        texts = Counter((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in docs.collect())
        assert texts == Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows)


def test_shards_of_nothing(nothing):
    assert sharding.shard_documents(nothing).count() == 0


def test_shards_are_even_and_move_only_to_the_new_one(spark):
    ids = spark.range(20_000)
    for n in (1, 2, 7, 40):
        moved = ids.select(sharding.jump_shard(F.col("id"), n).alias("a"), sharding.jump_shard(F.col("id"), n + 1).alias("b"))
        pairs = Counter(map(tuple, moved.collect()))
        assert all(b in (a, n) for a, b in pairs)
        sizes = Counter(a for a, _ in pairs.elements())
        assert max(sizes.values()) < 1.35 * 20_000 / n
        assert sum(k for (a, b), k in pairs.items() if a != b) == pytest.approx(20_000 / (n + 1), rel=0.25)


def test_sharding_runs_no_python(documents, plan):
    assert "Python" not in plan(sharding.shard_documents(documents)) and "Arrow" not in plan(sharding.shard_documents(documents))


# Decontamination


def contaminated(text, items, window=10):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    hit, found = set(), set()
    for item_id, item in items:
        own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (item or "").translate(LOWER))
        size = min(window, len(own))
        for j in range(len(own) - size + 1 if own else 0):
            for i in range(len(words) - size + 1):
                if words[i : i + size] == own[j : j + size]:
                    hit |= set(range(i, i + size))
                    found.add(item_id)
    listed = ",".join(sorted(str(i) for i in found))
    return len(words), len(hit), len(found), hashlib.sha256(listed.encode()).hexdigest(), bool(hit)


ITEMS = [(1, "One two three"), (2, "a b c d e f g h i j k"), (30, "B-C, D e f g h i j k!"), (4, None), (5, " .. "), (6, "é x")]
TEXTS = [
    "one TWO, three", "none two three", "one two threes", "x a b c d e f g h i j k y", "b c d e f g h i j",
    "a b c d e f g h i j a b c d e f g h i j k", None, "", "É x é x", "one two three one two three", "éx é\nx.",
]


def test_decontamination_small(spark):
    docs = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(TEXTS)], "doc_id bigint, text string, hits string")
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    rows = decontamination.digest(decontamination.find_windows(docs, items)).collect()
    for r in rows:
        expected = contaminated(TEXTS[r["doc_id"]], ITEMS)
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == expected
    found = decontamination.find_windows(docs, items).where("doc_id = 3").first()["hits"]
    assert {TEXTS[3][h["start"] : h["end"]] for h in found} == {"a b c d e f g h i j", "b c d e f g h i j k"}


def test_items_without_an_id_share_windows_with_others(spark):
    docs = spark.createDataFrame([(1, "one two three four")], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, "one two"), (None, "One, two"), (None, "three"), (None, None)], "item_id bigint, text string")
    found = decontamination.find_windows(docs, items)
    hits = [(h["first_word"], h["last_word"], h["item_id"]) for h in found.first()["hits"]]
    assert hits == [(0, 1, None), (0, 1, 7), (2, 2, None)]
    row = decontamination.digest(found).first()
    assert (row["n_hit"], row["n_items"]) == (3, 2)


def test_decontamination_in_several_automata(spark, monkeypatch):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    whole = decontamination.digest(decontamination.find_windows(docs, items)).collect()
    monkeypatch.setattr(decontamination, "AUTOMATON_BYTES", 60)
    assert sorted(decontamination.digest(decontamination.find_windows(docs, items)).collect()) == sorted(whole)


def test_decontamination_of_awkward_and_empty_tables(spark, awkward, nothing):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert decontamination.find_windows(awkward, items).count() == awkward.count()
    assert decontamination.find_windows(awkward, items.where("false")).where(F.size("hits") > 0).count() == 0
    assert decontamination.find_windows(nothing, items).count() == 0


# Personal data

RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_rules(text):
    found = []
    for kind, pattern in RULES.items():
        for match in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", match.group())
            odd, even = digits[-1::-2], digits[-2::-2]
            checksum = sum(map(int, odd)) + sum(sum(map(int, str(2 * int(d)))) for d in even)
            if kind == "ip" and max(map(int, match.group().split("."))) > 255:
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and checksum % 10 == 0):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append((*match.span(), kind))
    return sorted(found, key=lambda s: (s[0], pii.KINDS.index(s[2])))


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("aZ09.@-_+ ()%14é\n"), max_size=60))
def test_rules_find_what_the_patterns_find(text):
    assert pii.rule_spans(text) == plain_rules(text)


PIECES = ["@", "a@b.c", "(@)", "-@-", "10.0.0.1", "4111 1111 1111 1111", "+1 (555) 123-4567", "0049  30 - 1234567", *" \n\t.-()%9é+"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), st.integers(0, 9))
def test_any_text_has_spans(text, seed):
    weights = np.random.default_rng(seed).normal(size=(pii.WEIGHTS, len(pii.KINDS)))
    spans = pii.spans_of(text, weights)
    assert [(a, b, kind) for a, b, kind, base in spans if base] == plain_rules(text)
    added = sorted((a, b) for a, b, _, base in spans if not base)
    assert all(a[1] <= b[0] for a, b in zip(added, added[1:])) and all(0 <= a < b <= len(text) for a, b in added)  # noqa: B905


def test_models_are_trained_on_any_text(spark):
    docs = spark.createDataFrame([(1, "meet me @ noon"), (2, "(@) -@-"), (3, " ".join(PIECES)), (4, "@")], "doc_id bigint, text string")
    assert pii.find_spans(docs, pii.train_model(docs)).count() == 4


def test_rules_on_documents_and_awkward_rows(documents, awkward, nothing):
    weights = pii.train_model(documents)
    for docs in (documents, awkward):
        found = pii.find_spans(docs, weights)
        for row in found.select("text", "spans").collect():
            base = [(s["start"], s["end"], s["kind"]) for s in row["spans"] if s["base"]]
            assert base == plain_rules(row["text"] or "")
            extra = [s for s in row["spans"] if not s["base"]]
            assert not any(s["start"] < b and a < s["end"] for s in extra for a, b, _ in base)
        assert found.count() == docs.count()
    assert pii.find_spans(nothing, weights).count() == 0
    assert not pii.train_model(nothing).any()
    row = pii.digest(pii.find_spans(awkward.where("doc_id = 9"), weights)).first()
    listed = "card:0:19,ip:31:39"
    assert row["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest() and row["spans"].startswith(listed)
    texts = {r["doc_id"]: r["text"] for r in pii.redact(pii.find_spans(awkward, weights)).collect()}
    assert texts[9].startswith("[card] is a card, [ip] is") and texts[2] is None and texts[3] == ""


def test_the_field_adds_spellings_that_the_rules_miss(documents):
    weights = pii.train_model(documents)
    planted = [
        ("phone", "call ", "0049 (555) 123-4567", " now"),
        ("ip", "server ", "10[.]20[.]30[.]40", " is down"),
        ("email", "write to ", "bob.smith[@]example.org", " today"),
        ("card", "paid with ", "4111.1111.1111.1111", " yesterday"),
        ("card", "paid with ", "4111\t1111\t1111\t1111", " yesterday"),
    ]
    for kind, before, span, after in planted:
        where = (len(before), len(before) + len(span), kind, False)
        assert where in pii.spans_of(before + span + after, weights), span
    for clean in ("Version 2.0 of 2024-01-01", "no digits at all", "page 12 of 300", "room 101, floor 7"):
        assert pii.spans_of(clean, weights) == []


def test_segments_are_the_best_of_all():
    rng = np.random.default_rng(3)
    text = "+1 22 a@b.c 7"
    lat = pii.lattice(text, 0, len(text))
    weights = rng.normal(size=(pii.WEIGHTS, len(pii.KINDS)))
    scores = weights[lat.features].sum(axis=1).max(axis=1)

    def best(at):
        options = [0.0 + best(at + 1)] if at < lat.atoms else [0.0]
        options += [scores[n] + best(j) for n, (i, j) in enumerate(lat.bounds) if i == at]
        return max(options)

    chosen = {(a, b) for a, b, _ in pii.best_segments(lat, weights)}
    assert sum(s for s, span in zip(scores, lat.spans, strict=True) if span in chosen) == pytest.approx(best(0))


# Near duplicates


def linked(rows, words, percent=80):
    """{row number: (set size, smallest id)} by comparing all pairs."""
    sets = []
    for _, text in rows:
        own = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets.append({tuple(own[i : i + words]) for i in range(max(1, len(own) - words + 1))} if own else set())
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    ids = defaultdict(list)
    for g, (doc_id, _) in zip(group, rows, strict=True):
        if doc_id is not None:
            ids[g].append(doc_id)
    return [(len(s), min(ids[g], default=None) if s else r[0]) for s, g, r in zip(sets, group, rows, strict=True)]


def near_copies():
    rng = np.random.default_rng(5)
    rows, number = [], 0
    for base in range(6):
        words = [f"w{rng.integers(0, 5000)}" for _ in range(int(rng.integers(3, 120)))]
        for _ in range(14):  # each copy differs from the one before, so groups are chains
            rows.append((number * 7 % 101, " ".join(words)))
            number += 1
            if base != 3:
                words = list(words)
                words[int(rng.integers(0, len(words)))] = f"x{rng.integers(0, 5000)}"
    return rows


def test_packed_grams_come_back_and_need_few_bytes():
    rng = np.random.default_rng(2)
    low = np.concatenate([np.sort(rng.choice(1 << 22, n, replace=False)) for n in (3000, 1, 0, 5000)]).astype("<u4")
    bounds = np.array([0, 3000, 3001, 3001, 8001])
    packed = context_tree._cut_ascending(low, bounds)
    back, sizes = context_tree._ascending(packed, "<u4")
    assert (back == low).all() and sizes.tolist() == [3000, 1, 0, 5000]
    assert len(pa.compress(b"".join(packed), "lz4", asbytes=True)) < 2.2 * len(low)  # steps of up to two bytes
    logs = np.log10(rng.random(8001)).astype("<f4")
    parts = context_tree._squeezed(context_tree._cut(logs, bounds))
    assert (context_tree._joined(context_tree._restored(parts), "<f4") == logs).all()


def test_texts_to_be_scored_are_shuffled_compressed(spark):
    rng = np.random.default_rng(3)
    words = [bytes(rng.integers(97, 123, rng.integers(2, 9), dtype=np.uint8)).decode() for _ in range(400)]
    rows = [(i, i % 2, " ".join(rng.choice(words, 300)) if i else None) for i in range(300)]
    bundles = context_tree._bundles(spark.createDataFrame(rows, "row bigint, slice bigint, text string").coalesce(1)).collect()
    back = [(r["row"], b["slice"], r["text"]) for b in bundles for r in context_tree._unbundled(bytes(b["bundle"])).to_pylist()]
    assert sorted(back) == rows
    raw = "".join(t or "" for _, _, t in rows).encode()
    assert sum(len(b["bundle"]) for b in bundles) < 0.75 * len(pa.compress(raw, "lz4", asbytes=True))


def test_a_root_is_answered_once_for_a_slice_and_without_its_grams(spark, monkeypatch):
    monkeypatch.setattr(context_tree, "WEIGHED_GRAMS", 1)
    texts = [(i, i % 3, "abcab abd " * 3 + "xyz"[: i % 4]) for i in range(12)]
    docs = spark.createDataFrame(texts, "row bigint, slice bigint, text string").repartition(4)
    seen = []

    def keep(frame, answer, schema):
        seen.append((answer, schema))
        return dealt(frame, answer, schema)

    dealt = context_tree._root_by_root
    trees = context_tree.train(docs)
    monkeypatch.setattr(context_tree, "_root_by_root", keep)
    scores = {r["row"]: r["score"] for r in context_tree.score(docs, trees).collect()}
    one_slice = context_tree.score(docs.withColumn("slice", F.lit(0).cast("bigint")), trees).collect()
    assert {r["row"]: pytest.approx(r["score"]) for r in one_slice} == scores and len(scores) == 12
    assert all("grams" not in schema for _, schema in seen)


def test_distinct_numbers_and_sums_of_their_counts():
    rng = np.random.default_rng(4)
    for size in (0, 1, 5000):
        keys, counts = rng.integers(0, 900, size), rng.integers(1, 9, size)
        expected, at = np.unique(keys, return_inverse=True)
        assert (context_tree._distinct(keys) == expected).all()
        found, sums = context_tree._merged(keys, counts)
        assert (found == expected).all() and (sums == np.bincount(at, counts, len(expected))).all()


@pytest.mark.parametrize("words", [4, 5])
def test_near_duplicates_against_all_pairs(spark, awkward, words):
    for rows in (near_copies(), [(r["doc_id"], r["text"]) for r in awkward.select("doc_id", "text").collect()]):
        docs = spark.createDataFrame(rows, "doc_id bigint, text string")
        found = near_dup.near_duplicates(docs, words=words).collect()
        expected = Counter((doc_id, n, c) for (doc_id, _), (n, c) in zip(rows, linked(rows, words), strict=True))
        assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == expected
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_a_large_group_of_near_copies_needs_few_comparisons(spark, monkeypatch):
    rng = np.random.default_rng(9)
    base, rows = [f"w{i}" for i in range(90)], []
    for number in range(400):  # a quarter of them are linked with each other, and none of the rest with any
        words = list(base)
        for at in rng.choice(len(words), int(rng.integers(1, 9)), replace=False):
            words[at] = f"x{rng.integers(0, 3000)}"
        rows.append((number, " ".join(words)))
    likely, compared = near_dup._likely, []
    monkeypatch.setattr(near_dup, "_likely", lambda pairs, nodes: compared.append(pairs.count()) or likely(pairs, nodes))
    found = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), words=4).collect()
    expected = {(doc_id, n, c) for (doc_id, _), (n, c) in zip(rows, linked(rows, 4), strict=True)}
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in found} == expected
    components = Counter(c for _, _, c in expected)
    assert max(components.values()) > 80 and len(components) > 200  # so there are tens of thousands of pairs across
    assert sum(compared) < 25 * len(rows), compared


def test_one_of_each_group_stays(spark, awkward, nothing):
    kept = near_dup.without_copies(awkward).collect()
    ids = Counter(r["doc_id"] for r in kept)
    assert ids == Counter([1, 2, 3, None, None, 4, 5, 7, 8, 9]) and set(kept[0].asDict()) == set(awkward.columns)
    assert near_dup.without_copies(nothing).count() == 0


def test_sketches_are_full_and_agree_as_the_sets_do():
    rng = np.random.default_rng(1)
    shared, own = rng.integers(0, 1 << 63, 800, np.uint64), rng.integers(0, 1 << 63, (2, 100), np.uint64)
    sets = [np.unique(np.concatenate((shared, x))) for x in own] + [shared[:1]]
    values, bounds = np.concatenate(sets), np.cumsum([0, *map(len, sets)])
    sketch = near_dup.sketches(values, bounds)
    assert (sketch != near_dup._EMPTY).all()
    assert (sketch[0] == sketch[1]).mean() == pytest.approx(0.8, abs=0.12)


# Quality


def test_quality_tells_held_out_documents_apart(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.train_model(documents, labels)
    rows = quality.digest(quality.score_documents(documents, model)).join(labels, "doc_id").where("held_out").collect()
    good = [r["score"] for r in rows if r["quality"] == 1]
    bad = [r["score"] for r in rows if r["quality"] == 0]
    wins = np.mean([(g > b) + (g == b) / 2 for g in good for b in bad])
    assert wins > 0.9 and np.mean([s >= 0.3 for s in good]) > 0.95
    assert all((r["predicted"] == 1) == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)


def test_quality_of_awkward_rows_and_without_labels(spark, awkward, nothing):
    labels = spark.createDataFrame([(1, 1), (4, 0), (None, 1), (5, None)], "doc_id bigint, quality int")
    model = quality.train_model(awkward, labels)
    rows = quality.score_documents(awkward, model)
    assert rows.count() == awkward.count() and rows.where("score is null").count() == 0
    unknown = quality.train_model(awkward, labels.where("false"))
    assert {r["score"] for r in quality.score_documents(awkward, unknown).collect()} == {0.5}
    assert quality.score_documents(nothing, model).count() == 0


def test_quality_learns_from_all_texts_whatever_their_length(spark, monkeypatch):
    texts = [(i, f"{'fine' if i % 2 else 'poor'} words {i}") for i in range(1, 60)]
    first = min((i for i, _ in texts if zlib.crc32(str(i).encode()) % 5), key=lambda i: zlib.crc32(str(i).encode()))
    texts = [(i, "long " * 2_700_000 if i == first else t) for i, t in texts]
    docs = spark.createDataFrame([*texts, (1001, "seen twice seen twice"), (1002, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in texts] + [(1002, 1)] + [(i, 1) for i in range(5000, 5100)], "doc_id bigint, quality int")
    fitted = []
    monkeypatch.setattr(quality, "fit", lambda *args, fit=quality.fit: fitted.append(args) or fit(*args))
    monkeypatch.setattr(quality, "SAMPLE_DOCS", 55)
    quality.train_model(docs.repartition(3), labels)
    numbers, vectors, _, good = fitted[-1]
    inside = [(i, t) for i, t in [*texts, (1001, "seen twice seen twice")] if zlib.crc32(str(i).encode()) % 5]
    assert sorted(good) == sorted(i % 2 for i, _ in inside if i < 1000)
    counts = Counter(t for _, text in inside for t in quality.tokens_of(text))
    assert set(numbers) == {*quality._KINDS, *(t for t, n in counts.items() if n > 1)}
    known = quality._Numbers(numbers)
    places, signs = quality._random_vectors(list(numbers))
    near = np.zeros((len(numbers), quality.DIMENSIONS))
    for text in {t for _, t in inside if len(t) < 100}:
        own = [known[t] for t in quality.tokens_of(text)]
        for at, one in enumerate(own):
            for other in own[max(0, at - 2) : at] + own[at + 1 : at + 3]:
                np.add.at(near[one], places[other], signs[other])
    for token in {"words", "poor", "seen", "twice"} & set(numbers):
        np.add.at(near[numbers[token]], places[numbers[token]], signs[numbers[token]])
        assert np.allclose(vectors[numbers[token]], near[numbers[token]] / np.linalg.norm(near[numbers[token]]), atol=1e-5)


# Scoring


def test_base_scores_against_counting(documents, awkward):
    for docs in (documents.limit(300), awkward):
        rows = docs.select("doc_id", "text").collect()
        counts = Counter()

        def tokens(text):
            return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), None]

        def fold(doc_id):
            return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7

        for r in rows:
            if fold(r["doc_id"]) != 2:
                counts.update(tokens(r["text"]))
        total, distinct = sum(counts.values()), len(counts)
        expected = Counter()
        for r in rows:
            own = tokens(r["text"])
            base = sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in own)
            expected[(r["doc_id"], fold(r["doc_id"]) == 2, len(own), sum(counts[t] > 0 for t in own), total, round(base, 5))] += 1
        scored = scoring.score_held_out(docs).collect()
        assert all(r["score"] < 0 for r in scored)
        found = ((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in scored)
        assert Counter(found) == expected


def test_rare_words_are_joined(documents, monkeypatch):
    docs = documents.limit(200)
    whole = {r["doc_id"]: r for r in scoring.score_held_out(docs).collect()}
    monkeypatch.setattr(scoring, "TOP_WORDS", 10)
    for r in scoring.score_held_out(docs).collect():
        other = whole[r["doc_id"]]
        assert r["n_known"] == other["n_known"] and r["base_score"] == pytest.approx(other["base_score"])


def test_scoring_without_training_rows(spark, nothing):
    docs = spark.createDataFrame([(1, "abc"), (2, None)], "doc_id bigint, text string")
    rows = scoring.score_documents(docs, scoring.train_model(docs.where("false"))).collect()
    assert [(r["n_known"], r["base_score"]) for r in rows] == [(0, 0.0)] * 2
    assert scoring.score_held_out(nothing).count() == 0


def binary_weighting(sequence, depth, predicted):
    """(P of the whole sequence, of a 1 after ``predicted``) by the recursion over all contexts, letter by letter."""

    def estimate(zeros, ones):
        p = 1.0
        for k in range(zeros):
            p *= (k + 0.5) / (k + 1)
        for k in range(ones):
            p *= (k + 0.5) / (zeros + k + 1)
        return p

    def weighted(context, more):
        seen = [s for past, s in [*sequence, *more] if past[: len(context)] == context]
        own = estimate(seen.count(0), seen.count(1))
        if len(context) == depth:
            return own
        below = 1.0
        for letter in {past[len(context)] for past, _ in [*sequence, *more] if past[: len(context)] == context}:
            below *= weighted((*context, letter), more)
        return 0.5 * own + 0.5 * below

    return weighted((), [(predicted, 1)]) / weighted((), [])


def test_weighting_is_the_mixture_over_all_depths():
    rng = np.random.default_rng(2)
    keys, sequence = [], []
    for _ in range(40):
        past = tuple(int(x) for x in rng.integers(0, 3, 2))
        symbol = int(rng.random() < 0.2 + 0.3 * past[0])
        sequence.append((past, symbol))
        keys.append((((past[0] << 5) | past[1]) << 1) | symbol)
    seen, counts = np.unique(np.array(keys), return_counts=True)
    tree = scoring.weigh(seen, counts, depth=2, bits=1)
    for past in ((0, 0), (1, 2), (2, 1)):
        key = np.array([(((past[0] << 5) | past[1]) << 1) | 1])
        assert 10 ** tree.log10(key, 1)[0] == pytest.approx(binary_weighting(sequence, 2, past), rel=1e-5)


def test_scores_are_probabilities():
    texts = [b"the cat", b"the dog", b"a \xc3\xa9 12.", b""] * 5
    classes, places, several, _ = scoring.counter_keys(texts)
    tree = scoring.weigh(*np.unique(classes.astype(np.int64), return_counts=True), scoring.CLASS_DEPTH, scoring.CLASS_BITS)
    total = (10.0 ** tree.logs.astype(float)).sum(axis=1)
    assert np.allclose(total, 1, atol=1e-4)
    alone = scoring.counter_keys([b"the dog"])[0]
    assert (classes.reshape(-1)[8:16] == alone).all()


def test_text_scores_are_those_of_all_byte_contexts(spark, monkeypatch):
    trained = ["ab abc", "жзжж", "ab 12", "1", None, "ab abd жз"]
    asked = ["abc", "зж", "", None, "AB 1!", "日"]
    decisions = {}

    def steps(text):
        data = bytes([255] * context_tree.DEPTH) + (text or "").lower().encode() + b"\xff"
        for at in range(context_tree.DEPTH, len(data)):
            past = tuple(data[at - context_tree.DEPTH : at][::-1])
            for j in range(8):
                yield (1 << j) | (data[at] >> (8 - j)), past, (data[at] >> (7 - j)) & 1

    for text in trained:
        for node, past, bit in steps(text):
            decisions.setdefault(node, []).append((past, bit))

    def log10(text):
        total = 0
        for node, past, bit in steps(text):
            one = binary_weighting(decisions.get(node, []), context_tree.DEPTH, past)
            total += math.log10(one if bit else 1 - one)
        return total

    docs = spark.createDataFrame([(t,) for t in trained], "text string").repartition(2)
    rows = spark.createDataFrame([(t,) for t in asked], "text string").repartition(2)
    for weighed in (context_tree.WEIGHED_GRAMS, 1):
        monkeypatch.setattr(context_tree, "WEIGHED_GRAMS", weighed)
        found = scoring.score_documents(rows, scoring.train_model(docs)).collect()
        assert Counter(r["text"] for r in found) == Counter(asked)
        for r in found:
            assert r["score"] == pytest.approx(log10(r["text"]), rel=1e-5)


# Search


def best_by_scan(rows, queries, k):
    terms = [Counter(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))) for _, t in rows]
    df = Counter(t for own in terms for t in own)
    mean = sum(sum(own.values()) for own in terms) / max(len(rows), 1)
    out = {}
    for query_id, text in queries:
        asked = Counter(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER)))
        scores = []
        for (doc_id, _), own in zip(rows, terms, strict=True):
            score = sum(
                n * math.log1p((len(rows) - df[t] + 0.5) / (df[t] + 0.5)) * own[t] * 2.2 / (own[t] + 1.2 * (0.25 + 0.75 * sum(own.values()) / mean))
                for t, n in asked.items() if t in own
            )
            if score:
                scores.append((-round(score, 6), doc_id is None, doc_id or 0))
        out[query_id] = sorted(scores)[:k]
    return out


@pytest.mark.parametrize("shard_bytes", [24 << 20, 1 << 16])
def test_search_is_exact(documents, awkward, monkeypatch, shard_bytes):
    monkeypatch.setattr(search, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(search, "QUERY_TERMS", 4000)
    for docs, queries in ((documents.limit(400), documents.limit(400).where("doc_id % 20 = 0")), (awkward, awkward.where("doc_id > 3"))):
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        asked = queries.select(F.col("doc_id").alias("query_id"), "text").distinct()
        expected = best_by_scan(rows, [(r["query_id"], r["text"]) for r in asked.collect()], 10)
        found = defaultdict(list)
        for r in search.top_k(docs, asked, k=10).orderBy("query_id", "rank").collect():
            found[r["query_id"]].append(r)
        for query_id, best in expected.items():
            got = found[query_id]
            assert [r["rank"] for r in got] == list(range(1, len(best) + 1))
            assert [r["score"] for r in got] == pytest.approx([-s for s, _, _ in best], abs=2e-6)
            assert [r["doc_id"] or 0 for r in got] == [i for _, _, i in best]


def test_an_index_is_built_in_little_memory():
    """The memory of a worker beside its texts: postings are held once, with 32 bits for all but the terms."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{n}" for n in rng.zipf(1.3, 300) % 50_000).encode() for _ in range(10_000)]
    tracemalloc.start()
    index = search.build_index(list(range(len(texts))), texts, 300.0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(index["doc"]) > 1_000_000 and peak < 55 * len(index["doc"])


def test_search_of_nothing(awkward, nothing):
    asked = awkward.select(F.col("doc_id").alias("query_id"), "text")
    assert search.top_k(nothing, asked).count() == 0
    assert search.top_k(awkward, asked.where("false")).count() == 0


# The query names


def test_every_operator_has_its_query():
    import __spark_entry__

    names = {n.split("_")[0] for n in __spark_entry__.queries() if re.match(r"op\d+_", n)}
    assert names == {f"op{n}" for n in range(1, 14)} and "pipeline" in __spark_entry__.queries()


@settings(max_examples=30, deadline=None)
@given(st.lists(st.binary(max_size=40), min_size=1, max_size=5))
def test_words_are_hashed_alike_wherever_they_stand(texts):
    whole, bounds = near_dup.word_hashes(texts)
    for text, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True):
        alone, _ = near_dup.word_hashes([text])
        assert whole[a:b].tolist() == alone.tolist() and len(alone) == len(text.split())


def _tables(texts, queries, k):
    """An index of ``texts``, and ``queries`` as the search takes them, with weights of all terms by their df."""
    asked_of, terms, times, _ = search._terms(queries)
    names, numbers = np.unique(terms, return_inverse=True)
    own = search._terms(texts)[1]
    seen = np.searchsorted(np.sort(own), names, "right") - np.searchsorted(np.sort(own), names)
    idf = np.log1p((len(texts) - seen + 0.5) / (seen + 0.5))
    starts = np.searchsorted(asked_of, np.arange(len(queries) + 1))
    return search.Asked(starts, numbers.astype(np.int32), times * idf[numbers], names), search.Best(len(queries), k)


@pytest.mark.parametrize("shards", [1, 3])
def test_all_queries_of_a_block_are_searched_at_once(monkeypatch, shards):
    """Terms of any frequency, two languages, copies that tie beyond k, and small tiles: the same as a scan of single queries."""
    monkeypatch.setattr(search, "BLOCK_DOCS", 48)
    monkeypatch.setattr(search, "TILE_QUERIES", 7)
    monkeypatch.setattr(search, "CANDIDATES", 200)
    rng = np.random.default_rng(3)
    texts = [" ".join(f"{'ab'[i % 2]}{n}" for n in rng.zipf(1.3, 1 + i % 90) % 500).encode() for i in range(300)]
    texts += [texts[7]] * 30 + [b"", b"", b"alone"]
    queries = [*texts[::9], b"", b"nowhere", b"a1 a1 b1"]
    ids = [None if i % 11 == 5 else 1000 - i for i in range(len(texts))]
    asked, best = _tables(texts, queries, 10)
    mean = len(b" ".join(texts).split()) / len(texts)
    for part in range(shards):
        search.search_shard(search.build_index(ids[part::shards], texts[part::shards], mean), asked, best)
    query, doc, has_id, score = best.ranked()
    expected = best_by_scan([(i, t.decode()) for i, t in zip(ids, texts, strict=True)], [(q, t.decode()) for q, t in enumerate(queries)], 10)
    for q, found in expected.items():
        at = query == q
        assert score[at] == pytest.approx([-s for s, _, _ in found], abs=2e-6)
        assert list(zip((~has_id[at]).tolist(), np.where(has_id[at], doc[at], 0).tolist(), strict=True)) == [(none, i) for _, none, i in found]


def test_indexes_are_cut_without_a_shuffle(documents, plan, monkeypatch):
    monkeypatch.setattr(search, "SHARD_BYTES", 1 << 16)
    indexes = search._indexes(documents.limit(400).localCheckpoint())
    assert "Exchange" not in plan(indexes)
    held = [dict(np.load(io.BytesIO(row["index"]))) for row in indexes.collect()]
    size = documents.limit(400).agg(F.sum(F.octet_length("text"))).first()[0]
    assert sum(len(h["ids"]) for h in held) == 400 and len(held) >= size // (5 << 14) // 2
