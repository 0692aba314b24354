"""Token files, length histogram, packing: against the library itself and brute force."""

import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakewright.llm import packing, token_counts, token_files
from lakewright.llm.encoder import ChunkEncoder, _has_other_space
from lakewright.session import scratch_path

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def library(path):
    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


ENCODERS = {path: (ChunkEncoder(path, keeps), library(path)) for path, keeps in ((BYTES, True), (WORDS, False))}


PARTS = [*"aB é\n\t.!'s9日ßİ́  \x1c\0_-<|>", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "  "]
TEXTS = st.lists(st.sampled_from(PARTS), max_size=30).map("".join)


@pytest.mark.parametrize("path", [BYTES, WORDS])
@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("aB é\n\t.!'s9日ßİ́  \x1c\0_-"), max_size=30), min_size=1, max_size=4))
def test_chunks_encode_like_the_library(path, texts):
    encoder, ids_of = ENCODERS[path]
    ids, bounds = encoder.encode(texts, 7)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [[*ids_of(t), 7] for t in texts]  # noqa: B905
    assert encoder.lengths(texts).tolist() == [len(ids_of(t)) for t in texts]


def test_distinct_chunks_are_found_quickly():
    """Finding the numbers of known chunks takes less than turning them into Python objects one by one would."""
    words = [f"word{n}" for n in range(100_000)]
    encoder, listed = ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json"), True), pa.array(words)
    seconds = {"known": [], "listed": []}
    encoder._chunk_numbers([" ".join(words)])
    for _ in range(5):
        for what, run in (("known", lambda: encoder._chunk_numbers([" ".join(words)])), ("listed", listed.to_pylist)):
            began = time.process_time()
            run()
            seconds[what].append(time.process_time() - began)
    assert min(seconds["known"]) < min(seconds["listed"])


def test_white_space_is_that_of_the_library_of_expressions():
    other = re.compile(r"[^\S \n]|[\0\x1c-\x1f]")
    for text in ("", "plain", "\u00e9 plain\n", *("\u00e9" + chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)):
        assert _has_other_space(text) == bool(other.search(text)), ascii(text)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files_hold_all_ids_in_order(spark, documents):
    path = scratch_path(spark, "test-tokens")
    token_files.write_tokens(documents, path, BYTES)
    found = token_files.with_checksums(token_files.read_tokens(spark, path)).collect()
    start = 0
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    assert len(found) == len(texts)
    for row in sorted(found, key=lambda r: r["doc_id"]):
        ids = [*ENCODERS[BYTES][1](texts[row["doc_id"]]), 0]
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids), crc(ids))
        start += len(ids)


def test_token_files_prune_by_id(spark, documents, plan):
    path = scratch_path(spark, "test-tokens")
    token_files.write_tokens(documents, path, BYTES)
    one = token_files.read_tokens(spark, path).where("doc_id = 17")
    assert one.count() == 1 and "EqualTo(doc_id,17)" in plan(one)
    assert "ids" not in plan(token_files.read_tokens(spark, path).select("doc_id", "n_tokens")).split("ReadSchema")[1]


def test_token_files_take_awkward_rows(spark, awkward, nothing):
    path = scratch_path(spark, "test-tokens")
    token_files.write_tokens(awkward, path, BYTES)
    rows = token_files.read_tokens(spark, path).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in awkward.collect())
    ends = sorted((r["start"], r["start"] + r["n_tokens"]) for r in rows)
    assert all(a[1] == b[0] for a, b in zip(ends, ends[1:])) and ends[0][0] == 0  # noqa: B905
    assert {tuple(r["ids"]) for r in rows if r["doc_id"] in (2, 3)} == {(0,)}
    empty = scratch_path(spark, "test-tokens")
    token_files.write_tokens(nothing, empty, BYTES)
    assert token_files.read_tokens(spark, empty).count() == 0


@pytest.mark.parametrize("source", ["documents", "awkward"])
def test_histogram(request, source):
    docs = request.getfixturevalue(source)
    lengths = [len(ENCODERS[BYTES][1](r["text"])) + 1 for r in docs.collect()]
    histogram = token_counts.length_histogram(token_counts.encoded_lengths(docs, BYTES))
    rows = {r["length"]: r for r in histogram.collect()}
    assert {n: r["n_docs"] for n, r in rows.items()} == Counter(lengths)
    for n, r in rows.items():
        assert r["docs_at_least"] == sum(x >= n for x in lengths)
        assert r["tokens_at_least"] == sum(x for x in lengths if x >= n)
        assert r["truncated_tokens"] == sum(min(x, n) for x in lengths)
        assert r["share_at_most"] == pytest.approx(sum(x <= n for x in lengths) / len(lengths))
    limits = {r["context_limit"]: r for r in token_counts.at_limits(histogram, [1, 100, 5000]).collect()}
    for limit, r in limits.items():
        assert (r["docs_over"], r["truncated_tokens"]) == (sum(x > limit for x in lengths), sum(min(x, limit) for x in lengths))
    half = {r["share"]: r["length"] for r in token_counts.length_quantiles(histogram, [0.5, 1.0]).collect()}
    assert half == {0.5: sorted(lengths)[-(-len(lengths) // 2) - 1], 1.0: max(lengths)}


def test_histogram_of_nothing(nothing):
    histogram = token_counts.length_histogram(token_counts.encoded_lengths(nothing, BYTES))
    assert histogram.count() == 0
    assert token_counts.at_limits(histogram, [10]).first()["truncated_tokens"] == 0


def check_packed(rows, docs, capacity):
    """Every id of every document stands once, in order, and sequences have no gaps and no overflow."""
    expected = Counter()
    for doc in docs:
        ids = [*ENCODERS[WORDS][1](doc["text"]), 1]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            expected[(doc["doc_id"], piece, start, len(part), crc(part))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in places.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(places)


def test_packing_is_whole_and_tight(documents):
    rows = packing.pack(documents, WORDS).collect()
    used = check_packed(rows, documents.collect(), 4096)
    assert used <= 1.02 * -(-sum(r["length"] for r in rows) // 4096) + 1


def test_packing_takes_awkward_rows(awkward, nothing):
    rows = packing.pack(awkward, WORDS, capacity=64, with_ids=True)
    check_packed(rows.collect(), awkward.collect(), 64)
    for r in packing.sequences(rows).collect():
        assert 0 < len(r["ids"]) <= 64
    assert packing.pack(nothing, WORDS).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 400), min_size=1), st.integers(1, 40))
def test_plans_place_every_piece(counts, groups):
    plan = packing.make_plan(counts, capacity=50, small_share=1 / 5, groups=groups)
    keys, table = plan.arrays()
    fill, seen = defaultdict(list), 0
    for length, n in counts.items():
        for rank in range(n):
            entry = table[np.searchsorted(keys, (length << 48) | rank, side="right") - 1]
            assert entry[0] == length
            turn = rank - entry[1]
            fill[entry[2] + turn // entry[3]].append((entry[4] + turn % entry[3] * length, length))
            seen += 1
    assert len(fill) == plan.sequences
    for parts in fill.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 50
    if groups >= len(counts) and max(counts.values()) * len(counts) <= sum(counts.values()):
        # With a group for each length nothing is rounded up; with fewer, any rounding may cost sequences.
        assert plan.sequences <= 2 * -(-sum(k * n for k, n in counts.items()) // 50) + 1
