"""Benchmark decontamination: one Aho-Corasick automaton over normalised questions and answers.

A text is normalised to its words, lower-cased, with one space between. The automaton holds every window of the
items in that form, with a space on either side so that it only matches whole words, and reads each text once.
Places in the normalised text are mapped back to word numbers and to code points of the original.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.llm.texts import add_columns, utf8_of
from lakewright.session import scratch_path

WINDOW = 10
# Benchmark text that goes into one automaton, which takes up to 500 times as much memory; more text makes more of them.
AUTOMATON_BYTES = 1 << 19

# Bytes of the normalised text: A-Z lower-cased; ASCII other than letters and digits parts words.
_NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")  # the same words in the text as it was

_HITS = "array<struct<first_word:int,last_word:int,start:int,end:int,item_id:bigint>>"


def normal_text(text: bytes) -> bytes:
    """Lower-cased, with a space for every ASCII character that is not in a word."""
    return text.translate(_NORMAL)


def words_of(text: bytes) -> list[bytes]:
    return normal_text(text).split()


def windows_of(text: bytes, window: int) -> set[bytes]:
    """Every run of ``window`` words; the whole text where it has fewer, but not none."""
    words = words_of(text)
    if not words:
        return set()
    return {b" ".join(words[i : i + window]) for i in range(max(1, len(words) - window + 1))}


def _null_first(item_id: int | None) -> tuple[bool, int]:
    return item_id is not None, item_id or 0


def build_automaton(items: list[tuple[int, str | None]], window: int = WINDOW):
    """An automaton whose values are (number of words, ids of the items with that window); None for no windows."""
    import ahocorasick

    owners: dict[bytes, set[int]] = {}
    for item_id, text in items:
        for pattern in windows_of((text or "").encode(), window):
            owners.setdefault(pattern, set()).add(item_id)
    if not owners:
        return None
    automaton = ahocorasick.Automaton()
    for pattern, ids in owners.items():
        # Bytes as characters of the same number: the automaton then reads one byte a step.
        automaton.add_word(f" {pattern.decode('latin-1')} ", (pattern.count(b" ") + 1, len(pattern) + 1, sorted(ids, key=_null_first)))
    automaton.make_automaton()
    return automaton


def _item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str | None]]]:
    """The items in blocks of at most AUTOMATON_BYTES of text, or of one item."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    block: list[tuple[int, str | None]] = []
    held = 0
    for row in items.toLocalIterator():  # the question list is read once, a partition at a time
        size = len((row["text"] or "").encode())
        if block and held + size > AUTOMATON_BYTES:
            yield block
            block, held = [], 0
        block.append((row["item_id"], row["text"]))
        held += size
    yield block


def find_windows(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Add n_words and hits to ``docs``: every occurrence of a window, one for each item that has it.

    A hit gives its first and last word, from 0, its code points in the text, end exclusive, and the item. A null
    or empty text has no words and no hits; an item without words has no windows; items without an id count
    under a null id. Repeated rows and rows without an id are scanned like any other. Other columns stay. If the
    benchmark needs more than one automaton, the texts are scanned once for each.
    """
    spark = docs.sparkSession
    out = docs.withColumns({"n_words": F.lit(0), "hits": F.lit(None).cast(_HITS)})
    for number, block in enumerate(_item_blocks(benchmark)):
        if number:
            written = scratch_path(spark, "hits")
            out.write.parquet(written)
            out = spark.read.schema(out.schema).parquet(written)
        out = _scan(out, block, window)
    return out


def _scan(docs: DataFrame, items: list[tuple[int, str | None]], window: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)  # at most AUTOMATON_BYTES of text
    built = []

    def convert(batch):
        if not built:
            built.append(build_automaton(shared.value, window))
        counts, hits = [], []
        for text, known in zip(utf8_of(batch.column("text")), batch.column("hits").to_pylist(), strict=True):
            words = words_of(text)
            counts.append(len(words))
            hits.append((known or []) + (_hits(built[0], text, words) if built[0] and words else []))
        return {"n_words": counts, "hits": hits}

    return add_columns(docs, f"n_words int, hits {_HITS}", convert)


def _hits(automaton, text: bytes, words: list[bytes]) -> list[dict[str, int]]:
    normal = f" {b' '.join(words).decode('latin-1')} "
    matches = list(automaton.iter(normal))
    if not matches:
        return []
    spaces = np.flatnonzero(np.frombuffer(normal.encode("latin-1"), np.uint8) == 32)
    places = [m.span() for m in _WORD.finditer(text.decode())]
    found = []
    for end, (length, width, ids) in matches:
        first = int(np.searchsorted(spaces, end - width))
        last = first + length - 1
        for item_id in ids:
            span = {"start": places[first][0], "end": places[last][1]}
            found.append({"first_word": first, "last_word": last, **span, "item_id": item_id})
    return found


def digest(found: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    # The words that hits cover: a hit adds what lies beyond the furthest word so far.
    ordered = F.array_sort(F.coalesce("hits", F.array().cast(_HITS)))
    zero = F.struct(F.lit(0).alias("covered"), F.lit(-1).alias("reach"))

    def widen(state, hit):
        beyond = hit["last_word"] - F.greatest(state["reach"], hit["first_word"] - 1)
        return F.struct(
            (state["covered"] + F.greatest(beyond, F.lit(0))).alias("covered"),
            F.greatest(state["reach"], hit["last_word"]).alias("reach"),
        )

    covered = F.aggregate(ordered, zero, widen)["covered"]
    ids = F.array_sort(F.array_distinct(F.transform(ordered, lambda h: h["item_id"].cast("string"))))
    listed = found.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("n_words").cast("bigint").alias("n_words"),
        covered.cast("bigint").alias("n_hit"),
        ids.alias("_items"),
    )
    return listed.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("_items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
