"""Join values to the ranges that contain them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewright.operators.keyed_joins import keyed_join, row_bytes

BOUNDS = ("[)", "(]", "()", "[]")
DEFAULT_BOUNDS = "[)"
OPEN_LEVEL = 2000  # above every other level: one cell holds the whole axis
OPEN_WIDTH = 2.0**1000  # ranges this wide count as unbounded when they are filed
MIN_LEVEL = -60
_ENDLESS = {"nan": float("nan"), "above": float("inf"), "below": float("-inf")}


def contains(value: Column, lower: Column, upper: Column, bounds: Column) -> Column:
    """Whether a value lies in a range. A NULL end is unbounded; NULL bounds mean an empty range."""
    above = F.when(bounds.startswith("["), value >= lower).otherwise(value > lower)
    below = F.when(bounds.endswith("]"), value <= upper).otherwise(value < upper)
    inside = (lower.isNull() | above) & (upper.isNull() | below)
    return value.isNotNull() & bounds.isNotNull() & inside


def _axis(value: Column, data_type: T.DataType) -> Column:
    """The value as a double; order-preserving, so equal cells never separate a value from its range."""
    if isinstance(data_type, T.NumericType):
        return value.cast("double")
    days = F.unix_date(value.cast("date")).cast("double")
    if isinstance(data_type, T.DateType):
        return days
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(value) / F.lit(1e6)
    if isinstance(data_type, T.TimestampNTZType):
        return days * 86400 + F.hour(value) * 3600 + F.minute(value) * 60 + F.second(value)
    raise TypeError(f"no axis for {data_type.simpleString()}")


def range_join(
    values: DataFrame,
    ranges: DataFrame,
    value: str,
    lower: str = "lower",
    upper: str = "upper",
    bounds: str = "bounds",
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Every (value row, range row) pair in which the range contains the value.

    A range is filed under the cells of a power-of-two grid somewhat finer than itself, so it covers
    three to nine cells however wide it is; an open end counts as the outermost finite value. A value is looked up once in each grid that any
    range uses. That makes the containment test an equi-join on (grid, cell) with the exact test on top. NaN and the infinities, which
    Spark puts at the ends of all numbers, meet the ranges that hold them by name.
    """
    shared = set(values.columns) & set(ranges.columns)
    if shared:
        raise ValueError(f"values and ranges share column names {sorted(shared)}; rename one side")
    value_type = values.schema[value].dataType
    axis, exact = _axis(F.col(value), value_type), contains(F.col(value), F.col(lower), F.col(upper), F.col(bounds))
    ends: Column | None = None
    if isinstance(value_type, (T.DoubleType, T.FloatType)):
        # No cell is theirs, and the outermost values would be without bound: they are looked up by what they are.
        ends = F.coalesce(*(F.when(F.col(value) == F.lit(x).cast(value_type), name) for name, x in _ENDLESS.items()))
        finite = F.when(ends.isNull(), axis)
        least, most, others = values.agg(F.min(finite), F.max(finite), F.count(ends)).first()
        if others:
            inside = (F.when(contains(F.lit(x).cast(value_type), F.col(lower), F.col(upper), F.col(bounds)), name) for name, x in _ENDLESS.items())
            marked = ranges.withColumn("_end", F.explode(F.array_compact(F.array(*inside))))
            apart = keyed_join(values.withColumn("_end", ends).where("_end IS NOT NULL"), marked, ["_end"], "inner", broadcast_bytes).drop("_end")
            if least is None:
                return apart
            plain = range_join(values.where(ends.isNull()), ranges, value, lower, upper, bounds, broadcast_bytes)
            return plain.unionByName(apart)
    else:
        least, most = values.agg(F.min(axis), F.max(axis)).first()
    if least is None:
        return values.join(ranges, F.lit(False))
    # Ends beyond all values, open ones too, move in to the outermost value: a range is as wide as what it can meet.
    low, high = (_axis(F.col(end), ranges.schema[end].dataType) for end in (lower, upper))
    low, high = F.greatest(low, F.lit(least)), F.least(high, F.lit(most))
    width = high - low
    # Even levels only: half as many lookups per value. Cells are an eighth to half of a range's width, so those of a range hold at most
    # twice what it can meet.
    fitted = F.greatest(F.lit(MIN_LEVEL), (2 * F.floor((F.log2(width) - 1) / 2)).cast("int"))
    open_ended = low.isNull() | high.isNull() | ~(width < OPEN_WIDTH)
    level = F.when(open_ended, F.lit(OPEN_LEVEL)).when(width > 0, fitted).otherwise(F.lit(0))

    ordered = F.col(lower).isNull() | F.col(upper).isNull() | (F.col(lower) <= F.col(upper))
    usable = ranges.where(F.col(bounds).isNotNull() & ordered & (low <= high))
    leveled = usable.withColumn("_level", level)
    is_open, scale = F.col("_level") == OPEN_LEVEL, F.pow(F.lit(2.0), F.col("_level"))
    first, last = (F.when(is_open, F.lit(0).cast("bigint")).otherwise(F.floor(end / scale)) for end in (low, high))
    filed = leveled.withColumn("_cell", F.explode(F.sequence(first, last)))
    # At most one level per even exponent of a double, so the set is bounded by construction.
    levels, size = filed.agg(F.collect_set("_level"), F.sum(row_bytes(filed.schema))).first()
    if not levels:
        return values.join(ranges, F.lit(False))

    def cell(level: int) -> Column:
        # Scaling by a power of two is exact, so both sides agree on every cell.
        found = F.lit(0).cast("bigint") if level == OPEN_LEVEL else F.floor(axis * F.lit(2.0**-level))
        return F.struct(F.lit(level).alias("_level"), found.alias("_cell"))

    cells = F.explode(F.array(*map(cell, sorted(levels)))).alias("_at")
    looked_up = values.where(F.col(value).isNotNull()).select("*", cells).select("*", "_at.*").drop("_at")
    candidates = keyed_join(looked_up, filed, ["_level", "_cell"], "inner", broadcast_bytes, size)
    return candidates.where(exact).drop("_level", "_cell")
