"""Near duplicates by fast similarity sketching, banding, and exact verification on the full shingle sets.

A sketch has one coordinate per bin. In each round every shingle is hashed into one bin, with a hash value that
counts after those of the rounds before; after as many rounds as there are bins, each further round gives one bin
to all shingles, so every coordinate is filled. Two sketches agree in a coordinate with the probability of the
sets' similarity, and the number of agreements is concentrated like that of independent samples.

Texts with the same shingle set are one node from the start. Nodes that share a band form a bucket. Within it all
nodes are first compared to one of them; then only pairs from different components are left. Where a bucket has few of
those they are listed. Where it has many, its members are compared to the centre of its largest component, and kept as
their differences from it: two members from different components can only be linked if they share so many of these
differences that they share one of the rarer ones, and only such pairs are listed. So a large group of near copies costs
about as many comparisons as it has members, and no link between components is passed over.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakewright.llm.graph import components, extended, saved
from lakewright.llm.texts import map_batches, utf8_of
from lakewright.operators.keyed_joins import keyed_join, matching_keys

SHINGLE_WORDS = 5
PERCENT = 80  # links have 100 * intersection >= PERCENT * union
BINS = 576
BAND_ROWS = 8  # 72 bands of 8: a pair at 80 % shares none with probability 2e-6, one at 85 % with 1e-10
COMPARED = 128  # coordinates that are compared before full sets are
LEAST_AGREEING = 77  # of them; a pair at 80 % falls short with probability below 1e-7
PAIRS_PER_MEMBER = 4  # a bucket with more pairs left than this for each member goes by differences; decides speed only
PORTION = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


@lru_cache(maxsize=1)
def _constants() -> dict[str, np.ndarray]:
    rng = np.random.default_rng(20140709)
    draw = lambda n: rng.integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    made = {"bytes": draw(256), "base": draw(1), "words": draw(64), "rounds": draw(2 * BINS), "bands": draw(BAND_ROWS)}
    made["bytes"][_SPACE] = 0
    return made


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit depends on all."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(a 64-bit hash of every word of all texts, in order; the bounds of the texts among them).

    Words are runs of anything but ASCII white space, with A-Z lower-cased.
    """
    known = _constants()
    data = np.frombuffer(b" ".join([t.lower() for t in texts]) + b" ", np.uint8)
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    space = _SPACE[data]
    starts = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    sizes = np.diff(np.concatenate((starts, [len(data)])))
    powers = np.full(int(sizes.max()), known["base"][0], np.uint64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    inside = np.arange(starts[0], len(data)) - np.repeat(starts, sizes)
    hashed = known["bytes"][data[starts[0] :]] * powers[inside]
    word = _mix(np.add.reduceat(hashed, starts - starts[0]))
    return word, np.concatenate(([0], np.searchsorted(starts, ends)))


def shingle_sets(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes of all texts, ascending within each text; the bounds of the texts among them).

    A text with fewer words than a shingle has one shingle of all of them; one without words has none.
    """
    word, bounds = word_hashes(texts)
    count = np.diff(bounds)
    shingles = np.where(count >= words, count - words + 1, np.minimum(count, 1))
    owner = np.repeat(np.arange(len(texts)), shingles)
    first = np.repeat(bounds[:-1], shingles) + np.arange(len(owner)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    width = np.minimum(count[owner], words)
    value = width.astype(np.uint64)
    for k in range(words):
        used = k < width
        value[used] += word[first[used] + k] * _constants()["words"][k]
    value = _mix(value)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[fresh], owner[fresh]
    return value, np.searchsorted(owner, np.arange(len(texts) + 1))


def sketches(values: np.ndarray, bounds: np.ndarray, bins: int = BINS) -> np.ndarray:
    """One row of ``bins`` coordinates per set; a set without elements keeps the empty mark in all of them."""
    seeds = _constants()["rounds"]
    sets = len(bounds) - 1
    flat = np.full(sets * bins, _EMPTY)
    by_set = flat.reshape(sets, bins)
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(sets), sizes)
    open_sets = np.flatnonzero(sizes)
    for turn in range(2 * bins):
        hashed = _mix(values ^ seeds[turn])
        bin_of = (hashed % np.uint64(bins)).astype(np.int64) if turn < bins else turn - bins
        value = (np.uint64(turn) << np.uint64(48)) | (hashed >> np.uint64(16))
        np.minimum.at(flat, owner * bins + bin_of, value)
        short = (by_set[open_sets] == _EMPTY).any(axis=1)
        if short.all():
            continue
        open_sets = open_sets[short]
        if not len(open_sets):
            break
        still = np.zeros(sets, bool)
        still[open_sets] = True
        still = still[owner]
        values, owner = values[still], owner[still]
    return by_set


def _bands(sketch: np.ndarray) -> np.ndarray:
    rows = sketch.reshape(len(sketch), -1, BAND_ROWS)
    joined = (rows * _constants()["bands"]).sum(axis=2, dtype=np.uint64)
    return _mix(joined + _mix(np.arange(rows.shape[1], dtype=np.uint64))).view(np.int64)


def _fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """Per row: doc_id, text_key, n_shingles, and node (a digest of the set), bands and sketch, null without shingles."""

    def convert(batch):
        values, bounds = shingle_sets(utf8_of(batch.column("text")), words)
        sketch = sketches(values, bounds)
        bands, short = _bands(sketch), sketch[:, :COMPARED].astype(np.uint8)  # unequal ones rarely end alike
        full = np.diff(bounds) > 0
        nodes = [
            hashlib.blake2b(values[a:b], digest_size=16).digest() if b > a else None
            for a, b in zip(bounds[:-1], bounds[1:], strict=True)
        ]
        return {
            "doc_id": batch.column("doc_id"),
            "text_key": batch.column("text_key"),
            "n_shingles": np.diff(bounds),
            "node": nodes,
            "bands": [row if f else None for row, f in zip(bands, full, strict=True)],
            "sketch": [row.tobytes() if f else None for row, f in zip(short, full, strict=True)],
        }

    schema = "doc_id bigint, text_key bigint, n_shingles bigint, node binary, bands array<bigint>, sketch binary"
    return map_batches(_keyed(docs), schema, convert, size=PORTION)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")


def _full_sets(docs: DataFrame, reps: DataFrame, words: int) -> DataFrame:
    """(id, shingles) of the nodes in ``reps`` (id, doc_id, text_key), from their texts."""
    keyed = _keyed(docs).withColumn("_id", F.coalesce("doc_id", F.lit(-(1 << 63)))).drop("doc_id")
    wanted = reps.select("id", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("_id"), "text_key")
    found = keyed_join(keyed, wanted, ["_id", "text_key"], "inner")

    def convert(batch):
        values, bounds = shingle_sets(utf8_of(batch.column("text")), words)
        shingles = [v for v in np.split(values.view(np.int64), bounds[1:-1])]
        return {"id": batch.column("id"), "shingles": shingles}

    sets = map_batches(found.select("id", "text"), "id bigint, shingles array<bigint>", convert, size=PORTION)
    return sets.groupBy("id").agg(F.first("shingles").alias("shingles"))


def _likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs whose sketches agree in enough coordinates for their sets to be similar enough."""
    sketch_of = nodes.select("id", "sketch")
    joined = pairs.join(sketch_of.toDF("a", "sketch_a"), "a").join(sketch_of.toDF("b", "sketch_b"), "b")

    def convert(batch):
        left, right = (
            np.frombuffer(b"".join(batch.column(n).to_pylist()), np.uint8).reshape(-1, COMPARED) for n in ("sketch_a", "sketch_b")
        )
        return {"a": batch.column("a"), "b": batch.column("b"), "agreeing": (left == right).sum(axis=1)}

    compared = map_batches(joined, "a bigint, b bigint, agreeing int", convert, "sketch_a")
    return compared.where(F.col("agreeing") >= LEAST_AGREEING).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are similar enough."""
    joined = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
    common = F.size(F.array_intersect("set_a", "set_b")).cast("bigint")
    union = F.size("set_a").cast("bigint") + F.size("set_b") - common
    return joined.where(100 * common >= percent * union).select("a", "b")


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, text_key, n_shingles, group, component_id, kept.

    Rows belong together if links lead from one to the other; a link joins texts whose sets of ``words``-word
    shingles have 100 * intersection >= percent * union. component_id is the smallest doc_id of the rows that
    belong together, and a row is kept if it has that id. Rows without words, null texts among them, are linked with
    nothing. A row without an id takes part, gets the others' smallest id, and is kept if none of them has an id.
    Repeated rows are linked like copies. ``group`` is equal for rows that belong together, null without words.
    An empty table gives no rows. Bands and the comparison of sketches are laid out for ``percent`` of 80 or more.
    """
    if percent < PERCENT:
        raise ValueError(f"pairs below {PERCENT} % may share no band; {percent} % is not supported")
    rows = saved(_fingerprints(docs, words), "fingerprints")
    distinct = (
        rows.where(F.col("node").isNotNull())
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("least_id"),
            F.min(F.struct("doc_id", "text_key")).alias("rep"),
            F.first("bands").alias("bands"),
            F.first("sketch").alias("sketch"),
        )
    )
    # Written once, so the short numbers that stand for the digests from here on do not change.
    nodes = saved(distinct.withColumn("id", F.monotonically_increasing_id()), "nodes")
    members = nodes.select("id", F.explode("bands").alias("band"))
    ends = members.groupBy("band").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    ends = ends.where(F.col("low") != F.col("high")).drop("high")
    shared = saved(members.join(ends, "band"), "buckets")

    to_first = shared.where(F.col("id") != F.col("low")).select(F.col("low").alias("a"), F.col("id").alias("b"))
    tested = saved(to_first.distinct(), "pairs")
    # Every link's two ends share a bucket, so the nodes that may ever be verified are known by now.
    linkable = shared.select("id").distinct()
    reps = nodes.select("id", "rep.doc_id", "rep.text_key")
    sets = saved(_full_sets(docs, reps.join(linkable, "id", "left_semi"), words), "sets")
    links = saved(_verified(_likely(tested, nodes), sets, percent), "links")

    labels = components(links)
    left, kinds = _unresolved(shared, labels)
    if kinds:
        one = left.where(~F.col("crowded")).select("band", F.col("id").alias("a"), F.col("label").alias("label_a"))
        two = left.where(~F.col("crowded")).select("band", F.col("id").alias("b"), F.col("label").alias("label_b"))
        across = one.join(two, "band").where((F.col("a") < F.col("b")) & (F.col("label_a") != F.col("label_b")))
        fresh = saved(across.select("a", "b").distinct().join(tested, ["a", "b"], "left_anti"), "pairs")
        links = saved(_verified(_likely(fresh, nodes), sets, percent), "links")
        if True in kinds:
            about = saved(_differences(left.where("crowded").select("band", "id", "label"), sets), "differences")
            near = about.where(_close(F.col("n"), F.col("size") + F.col("centre_size"), percent))
            labels = extended(labels, links.unionByName(near.select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b"))))
            fresh = saved(_sharing(about, labels, percent), "pairs")
            links = saved(_verified(_likely(fresh, nodes), sets, percent), "links")
        labels = extended(labels, links)

    named = labels.withColumnRenamed("node", "id")
    grouped = nodes.select("node", "id", "least_id").join(named, "id", "left")
    grouped = grouped.withColumn("group", F.coalesce("label", "id"))
    least = grouped.where(F.col("label").isNotNull()).groupBy("group").agg(F.min("least_id").alias("smallest"))
    of_node = grouped.join(least, "group", "left").select(
        "node", "group", F.coalesce("smallest", "least_id").alias("component_id")
    )
    found = rows.select("doc_id", "text_key", "n_shingles", "node").join(of_node, "node", "left")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select(
        "doc_id", "text_key", "n_shingles", "group", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept")
    )


def _unresolved(shared: DataFrame, labels: DataFrame) -> tuple[DataFrame, set[bool]]:
    """(band, id, label, crowded) of buckets with several components, crowded ones having many pairs across them; the kinds there are."""
    named = labels.withColumnRenamed("node", "id")
    own = shared.join(named, "id", "left").withColumn("label", F.coalesce("label", "id"))
    own = saved(own.select("band", "id", "label"), "labelled")
    of_label = own.groupBy("band", "label").agg(F.count(F.lit(1)).cast("double").alias("n"))
    buckets = of_label.groupBy("band").agg(F.sum("n").alias("members"), F.sum(F.col("n") * F.col("n")).alias("squares"))
    pairs = (F.col("members") * F.col("members") - F.col("squares")) / 2
    several = buckets.where(pairs > 0).select("band", (pairs > PAIRS_PER_MEMBER * F.col("members")).alias("crowded"))
    several = saved(several, "several")
    return own.join(several, "band"), {row["crowded"] for row in several.select("crowded").distinct().collect()}


def _close(differences: Column, sizes: Column, percent: int) -> Column:
    """Whether two sets of so many elements together, so many of them in one only, are similar enough."""
    return (100 + percent) * differences <= (100 - percent) * sizes


def _differences(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(centre, id, size, centre_size, n, differs) of ``members`` (band, id, label): the elements in which a member and the centre differ.

    A bucket's centre is that of its most frequent component: the node that is in the most buckets.
    """
    seen = members.groupBy("label", "id").agg(F.count(F.lit(1)).alias("times"))
    centres = seen.groupBy("label").agg(F.sum("times").alias("weight"), F.max(F.struct("times", "id")).alias("top"))
    centres = saved(centres.select("label", "weight", F.col("top.id").alias("centre")), "centres")
    there = keyed_join(members.select("band", "label").distinct(), centres, ["label"], "inner")
    chosen = there.groupBy("band").agg(F.max(F.struct("weight", "label", "centre")).alias("top")).select("band", F.col("top.centre").alias("centre"))
    about = members.join(chosen, "band").where(F.col("id") != F.col("centre")).select("centre", "id").distinct()
    held = about.join(sets.withColumnRenamed("shingles", "own"), "id")
    other = chosen.select(F.col("centre").alias("id")).distinct().join(sets, "id").select(F.col("id").alias("centre"), F.col("shingles").alias("other"))
    both = keyed_join(held, saved(other, "centre-sets"), ["centre"], "inner")
    differs = F.concat(F.array_except("own", "other"), F.array_except("other", "own"))
    found = both.select("centre", "id", F.size("own").cast("bigint").alias("size"), F.size("other").cast("bigint").alias("centre_size"), differs.alias("differs"))
    return found.select("*", F.size("differs").cast("bigint").alias("n"))


def _sharing(about: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) around one centre, of different components, that share differences as two similar sets must.

    Sets of sizes s and t that differ from a centre in m and n elements, o of them the same, differ in m + n - 2 o. To be
    similar enough they need a certain o, and the first of those, by any order of the elements, stands within the first
    m - o + 1 and n - o + 1. The order is by how many members differ in an element, rarest first. A member alone tells how
    small o may be at least: in a pair of two components one is too far from the centre for a link to it.
    """
    row = about.join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("label", F.coalesce("label", "id"))
    mixed = row.groupBy("centre").agg(F.min("label").alias("_low"), F.max("label").alias("_high")).where("_low != _high")
    row = saved(matching_keys(row, saved(mixed.select("centre"), "mixed"), ["centre"], keep=True), "members")
    more, less = 100 + percent, 100 - percent
    n, size, of_centre = F.col("n"), F.col("size"), F.col("centre_size")
    least = lambda over: F.greatest(F.lit(1), F.ceil((more * n - less * over) / (2 * more)))
    elements = saved(row.select("centre", "id", F.explode("differs").alias("element")), "elements")
    times = elements.groupBy("centre", "element").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    place = F.row_number().over(Window.partitionBy("centre", "id").orderBy("times", "element"))
    several = F.count(F.lit(1)).over(Window.partitionBy("centre", "id"))
    ranked = elements.join(times, ["centre", "element"]).withColumns({"_place": place, "_several": several})
    # Elements of one member alone come first, and no pair shares them.
    placed = ranked.join(row.drop("differs"), ["centre", "id"]).withColumn("place", n - F.col("_several") + F.col("_place") - 1)
    placed = placed.withColumns({"far": ~_close(n, size + of_centre, percent), "rare": F.col("place") <= n - least(size - of_centre)})
    placed = placed.where(F.col("rare") | (F.col("far") & (F.col("place") <= n - least(size + of_centre))))
    placed = saved(placed.select("centre", "element", "id", "label", "n", "size", "place", "far", "rare"), "places")
    one = placed.where("far").select("centre", "element", *(F.col(c).alias(f"{c}_a") for c in ("id", "label", "n", "size", "place", "rare")))
    two = placed.where("rare").select("centre", "element", *(F.col(c).alias(f"{c}_b") for c in ("id", "label", "n", "size", "place", "far")))
    once = ~F.col("far_b") | (F.col("rare_a") & (F.col("id_a") < F.col("id_b")))
    left = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    enough = 2 * more * left >= more * (F.col("n_a") + F.col("n_b")) - less * (F.col("size_a") + F.col("size_b"))
    pairs = one.join(two, ["centre", "element"]).where((F.col("label_a") != F.col("label_b")) & once & enough)
    return pairs.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).distinct()


def without_copies(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: the one with the smallest id.

    A row that repeats the id and the text of another counts as the same row. Rows without words stay.
    """
    found = saved(near_duplicates(docs, words, percent), "near-duplicates")
    row_id, row_text = "__near_dup_id", "__near_dup_text"  # names that no table has
    no_id = F.lit(-(1 << 63))
    gone = found.where(~F.col("kept")).select(F.coalesce("doc_id", no_id).alias(row_id), F.col("text_key").alias(row_text))
    keyed = docs.withColumns({row_id: F.coalesce(F.col("doc_id").cast("bigint"), no_id), row_text: F.xxhash64("text")})
    keys = [row_id, row_text]
    kept = matching_keys(keyed, saved(gone.distinct(), "copies"), keys, keep=False)
    # Only rows that repeat id and text are brought together; there are hardly any, and texts are not shuffled for them.
    stay = found.where("kept").groupBy(F.coalesce("doc_id", no_id).alias(row_id), F.col("text_key").alias(row_text)).count()
    repeated = saved(stay.where("count > 1").select(*keys), "repeated")
    if not repeated.isEmpty():
        once = matching_keys(kept, repeated, keys, keep=True).dropDuplicates(keys)
        kept = matching_keys(kept, repeated, keys, keep=False).unionByName(once)
    return kept.drop(*keys)


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_shingles", "component_id", "kept")
