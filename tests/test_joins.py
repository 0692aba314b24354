"""Both join ways, with a key that holds a third of all rows, against plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from lakewright.operators import keyed_joins, ranges


@pytest.fixture
def skewed(spark):
    rng = random.Random(7)
    rows = [(7 if i % 3 == 0 else None if i % 50 == 1 else rng.randrange(400), i) for i in range(6000)]
    return spark.createDataFrame(rows, "k int, id int").repartition(12), rows


@pytest.fixture
def keys(spark):
    listed = [7, 7, 7, *range(0, 400, 3), None]
    return spark.createDataFrame([(k,) for k in listed], "k int"), set(listed) - {None}


def test_hot_keys_are_found(spark, skewed):
    hot = keyed_joins.hot_buckets(skewed[0], ["k"]).collect()
    expected = spark.range(1).select(F.pmod(F.xxhash64(F.lit(7)), F.lit(keyed_joins.MIN_BUCKETS))).first()[0]
    assert [(r["_bucket"], r["_parts"]) for r in hot] == [(expected, 3)]


def test_no_hot_keys(spark):
    assert keyed_joins.hot_buckets(spark.range(1000), ["id"]) is None
    assert keyed_joins.hot_buckets(spark.range(0), ["id"]) is None


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_matching_keys(skewed, keys, rows, broadcast_bytes):
    df, data = skewed
    kept = keyed_joins.matching_keys(df, keys[0], ["k"], True, broadcast_bytes)
    assert rows(kept) == sorted((r for r in data if r[0] in keys[1]), key=str)
    dropped = keyed_joins.matching_keys(df, keys[0], ["k"], False, broadcast_bytes)
    assert rows(dropped) == sorted((r for r in data if r[0] not in keys[1]), key=str)
    assert dropped.columns == df.columns


def test_large_key_sides_are_not_broadcast(skewed, keys, plan):
    physical = plan(keyed_joins.matching_keys(skewed[0], keys[0], ["k"], True, 0)).split("Physical Plan")[1]
    assert "ShuffledHashJoin" in physical
    assert "_salt_left" in physical
    unmeasured = plan(keyed_joins.salted_join(skewed[0], keys[0].distinct(), ["k"], "left_semi"))
    assert "SortMergeJoin" in unmeasured.split("Physical Plan")[1]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_keeps_every_pair(spark, skewed, rows, how):
    df, data = skewed
    right = [(k, f"r{k}") for k in range(0, 400, 2)] + [(7, "r7")]
    got = keyed_joins.salted_join(df, spark.createDataFrame(right, "k int, v string"), ["k"], how)
    names = dict(right)
    expected = [(k, i, names.get(k)) for k, i in data if how == "left" or k in names]
    assert rows(got.select("k", "id", "v")) == sorted(expected, key=str)


def test_salted_join_with_a_hot_key_on_both_sides(spark, skewed):
    df, data = skewed
    right = [(7 if i % 2 else i % 400, i) for i in range(300)]
    right_df = spark.createDataFrame(right, "k int, j int").repartition(9)
    got = keyed_joins.salted_join(df, right_df, ["k"], "inner").select("id", "j")
    expected = {(i, j) for k, i in data for q, j in right if k == q}
    pairs = [tuple(r) for r in got.collect()]
    assert len(pairs) == len(expected)
    assert set(pairs) == expected


def test_salted_join_refuses_outer(spark, skewed):
    with pytest.raises(ValueError):
        keyed_joins.salted_join(skewed[0], skewed[0], ["k"], "full")


def inside(x, low, high, bounds):
    if x is None or bounds is None:
        return False
    above = low is None or (x >= low if bounds[0] == "[" else x > low)
    return above and (high is None or (x <= high if bounds[1] == "]" else x < high))


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
@pytest.mark.parametrize("kind", ["int", "double"])
def test_range_join_like_python(spark, kind, broadcast_bytes):
    rng = random.Random(3)

    def number(low, high):
        return rng.randrange(low, high) if kind == "int" else round(rng.uniform(low, high), 2)

    values = [(i, 5 if i % 3 == 0 else number(-500, 500)) for i in range(600)] + [(-1, None)]
    if kind == "double":
        values = [(i, None if v is None else float(v)) for i, v in values]
    spans = []
    for i in range(80):
        low = number(-550, 500)
        high = low + number(0, 10 ** (1 + i % 3))
        spans.append((i, low, high, ranges.BOUNDS[i % 4]))
    five = 5 if kind == "int" else 5.0
    spans += [
        (100, None, five, "(]"), (101, five, None, "(]"), (102, None, None, "[)"), (103, five, five, "[]"),
        (104, five, five, "[)"), (105, five + 9, five, "[]"), (106, five, five + 1, None),
    ]
    got = ranges.range_join(
        spark.createDataFrame(values, f"i int, x {kind}").repartition(8),
        spark.createDataFrame(spans, f"r int, lower {kind}, upper {kind}, bounds string"),
        "x",
        broadcast_bytes=broadcast_bytes,
    )
    expected = sorted((i, r) for i, x in values for r, low, high, b in spans if inside(x, low, high, b))
    assert sorted(tuple(p) for p in got.select("i", "r").collect()) == expected


def test_range_join_with_extreme_bounds(spark):
    inf = float("inf")
    values = [-inf, -1e308, -1.0, 0.0, 5e-324, 1e-30, 1.0, 1e19, 1e308, inf]
    spans = [
        (-inf, inf), (-1e308, 1e308), (0.0, 5e-324), (0.0, 1e-30), (1e19, 1e19), (-1.0, inf), (inf, inf), (1e18, 1e19), (-1e300, 1.0),
    ]
    got = ranges.range_join(
        spark.createDataFrame([(v,) for v in values], "x double"),
        spark.createDataFrame([(*s, "[]") for s in spans], "lower double, upper double, bounds string"),
        "x",
    )
    expected = sorted((x, *s) for x in values for s in spans if s[0] <= x <= s[1])
    assert sorted(tuple(r) for r in got.select("x", "lower", "upper").collect()) == expected


def test_range_join_over_time(spark, events):
    spans = spark.createDataFrame(
        [("a", "2024-01-03 00:00:00", "2024-01-03 12:00:00"), ("b", "2024-01-03 06:00:00", "2024-01-20 00:00:00.5")],
        "name string, f string, t string",
    ).select("name", F.col("f").cast("timestamp_ntz").alias("lower"), F.col("t").cast("timestamp_ntz").alias("upper"), F.lit("[)").alias("bounds"))
    got = ranges.range_join(events.select("event_id", "ts"), spans, "ts").groupBy("name").count()
    expected = {
        "a": events.where("ts >= timestamp_ntz'2024-01-03 00:00:00' and ts < timestamp_ntz'2024-01-03 12:00:00'").count(),
        "b": events.where("ts >= timestamp_ntz'2024-01-03 06:00:00' and ts < timestamp_ntz'2024-01-20 00:00:00.5'").count(),
    }
    assert {r[0]: r[1] for r in got.collect()} == expected


def test_range_join_without_usable_ranges(spark):
    none = spark.createDataFrame([(3, 1, "[]")], "lower int, upper int, bounds string")
    assert ranges.range_join(spark.range(9).withColumnRenamed("id", "x"), none, "x").count() == 0


def test_range_join_needs_distinct_names(spark):
    both = spark.createDataFrame([(1, 3, "[]")], "lower int, upper int, bounds string")
    with pytest.raises(ValueError):
        ranges.range_join(both, both, "lower")


def test_candidates_follow_matches_with_numbers_without_end(spark):
    nan, inf = float("nan"), float("inf")
    numbers = [float(i) for i in range(4000)] + [nan, inf, -inf, None, inf]
    values = spark.createDataFrame([(v,) for v in numbers], "v double")
    open_ranges = [(3000.0 + i, None if i % 10 else 3100.0 + i, "[)") for i in range(1000)]
    special = [(inf, None, "[)"), (None, -inf, "(]"), (None, nan, "()"), (nan, nan, "[]"), (-inf, inf, "()"), (5.0, 5.0, "[]"), (None, None, None)]
    ranges_ = spark.createDataFrame(open_ranges + special, "lower double, upper double, bounds string")

    def key(x):  # Spark's order: NaN after everything
        return (1, 0.0) if math.isnan(x) else (0, x)

    def inside(v, low, high, bounds):
        if v is None or bounds is None:
            return False
        above = low is None or (key(v) >= key(low) if bounds[0] == "[" else key(v) > key(low))
        return above and (high is None or (key(v) <= key(high) if bounds[1] == "]" else key(v) < key(high)))

    expected = sum(inside(v, *r) for v in numbers for r in open_ranges + special)
    for broadcast_bytes in (None, 0):
        assert ranges.range_join(values, ranges_, "v", broadcast_bytes=broadcast_bytes).count() == expected
    candidates = []
    plain = ranges.keyed_join

    def counted(*args, **kwargs):
        joined = plain(*args, **kwargs)
        candidates.append(joined.count())
        return joined

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(ranges, "keyed_join", counted)
        ranges.range_join(values, ranges_, "v")
    assert sum(candidates) < 4 * expected


def test_values_without_end_only(spark):
    values = spark.createDataFrame([(float("inf"),), (float("nan"),)], "v double")
    ranges_ = spark.createDataFrame([(0.0, None, "[)", 1), (0.0, 9.0, "[)", 2)], "lower double, upper double, bounds string, n int")
    assert [r["n"] for r in ranges.range_join(values, ranges_, "v").collect()] == [1, 1]
