"""Byte-level BPE against the tiktoken library."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from lakewright.llm import byte_bpe

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
LIBRARY = tiktoken.Encoding("library", pat_str=PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})
ENCODER = byte_bpe.ByteBpeEncoder(RANKS, PATTERN)


def ours(texts):
    ids, bounds = ENCODER.encode(texts, None)
    return [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]  # noqa: B905


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=60) | st.text(st.sampled_from("aBst' é\n\t.!9日ßة \x1c\0_-"), max_size=60), min_size=1, max_size=4))
def test_any_text_encodes_like_the_library(texts):
    found = ours(texts)
    assert found == [LIBRARY.encode_ordinary(t) for t in texts]
    assert [ENCODER.merges.decode(ids) for ids in found] == [t.encode() for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("etaoinshrlué日ا"), min_size=1, max_size=400))
def test_long_words_go_back_where_needed(word):
    assert ours([word]) == [LIBRARY.encode_ordinary(word)]


def test_code_points_that_are_new_to_one_library_only():
    texts = [f"x{chr(c)}y {chr(c)}1" for c in (0x558, 0x88F, 0x10940, 0x1CCF0, 0x16D40, 0x378, 0xE0080)]
    assert ours(texts) == [LIBRARY.encode_ordinary(t) for t in texts]


def test_very_long_pieces():
    texts = ["a" * 300_000, "ab" * 200_000, " " * 100_000 + "x", "=" * 50_000, "日本" * 50_000]
    expected = [LIBRARY.encode_ordinary(t) for t in texts]
    assert ours(texts) == expected


def test_neighbours_fit_where_the_merges_part_there():
    rng = random.Random(4)
    merges = ENCODER.merges
    short = [r for r in range(50_256) if merges.widths[r] < 5]
    for _ in range(20_000):
        one, two = rng.choice(short), rng.choice(short)
        assert merges.fits(one, two) == (LIBRARY._core_bpe.encode_single_piece(merges.tokens[one] + merges.tokens[two]) == [one, two]
                                         and merges.tokens[one] + merges.tokens[two] not in merges.ranks)


def test_two_ways_of_merging_go_back():
    """A small vocabulary in which the longest match is wrong at the first place."""
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 256, b"ab": 257, b"abc": 258, b"cd": 259, b"bcd": 260}
    merges = byte_bpe.Merges(ranks)
    library = tiktoken.Encoding("small", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    for text in ("abcd", "abc", "aabcdabcd", "abababcdcd", "bcdbcab", "xabcy"):
        assert merges.encode([text.encode(), b"b"]) == [library.encode_ordinary(text), [98]]


@pytest.mark.parametrize("source", ["documents", "awkward"])
def test_documents_round_trip(request, source):
    docs = request.getfixturevalue(source)
    rows = byte_bpe.digest(byte_bpe.decode_documents(byte_bpe.encode_documents(docs, RANKS, PATTERN), RANKS)).collect()

    def sha(data):
        return hashlib.sha256(data).hexdigest()

    def expected(row):
        text = row["text"] or ""
        ids = LIBRARY.encode_ordinary(text)
        return row["doc_id"], len(ids), sha(",".join(map(str, ids)).encode()), sha(text.encode())

    assert sorted(map(tuple, rows), key=str) == sorted(map(expected, docs.collect()), key=str)


def test_other_columns_and_empty_tables(awkward, nothing):
    encoded = byte_bpe.encode_documents(awkward, RANKS, PATTERN)
    assert set(encoded.columns) == set(awkward.columns) and {r["hits"] for r in encoded.select("hits").collect()} == {"kept"}
    assert byte_bpe.decode_documents(byte_bpe.encode_documents(nothing, RANKS, PATTERN), RANKS).count() == 0


def test_vocabularies_without_all_bytes_are_refused():
    with pytest.raises(ValueError, match="lacks"):
        byte_bpe.Merges({b"a": 0})
