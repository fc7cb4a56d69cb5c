"""Column expressions over relationships and their evidence."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from evgraph.schema import DEFAULT_WEIGHT, NODE_TYPES, ROLE_WEIGHTS


def is_missing(col: Column) -> Column:
    """Null or the empty string; zero and false count as present."""
    return col.isNull() | (col == "")


def number(col: Column) -> Column:
    """Text as a number, true and false as one and zero; null where it is neither."""
    text = F.lower(F.trim(col))
    value = F.when(text == "true", F.lit(1.0)).when(text == "false", F.lit(0.0)).otherwise(text.try_cast("double"))
    return F.when(~F.isnan(value), value)


def nested(record: str, field: str, default=None) -> Column:
    """A field of a nested record, or the default where record or field is absent."""
    value = F.col(f"{record}.{field}")
    return value if default is None else F.coalesce(value, F.lit(default))


def to_confidence(col: Column) -> Column:
    """A confidence as a number; absent, unparsable and NaN give 0.0."""
    return F.coalesce(number(col), F.lit(0.0))


def is_unparsable(col: Column) -> Column:
    """Whether a confidence is there and no number. It scores nothing, but it is no missing field."""
    return ~is_missing(col) & number(col).isNull()


def has_valid_type(col: Column) -> Column:
    return F.coalesce(col.isin(*NODE_TYPES), F.lit(False))


def role_weight(col: Column, weights: Mapping[str, float] = ROLE_WEIGHTS) -> Column:
    table = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
    return F.coalesce(F.try_element_at(table, col), F.lit(DEFAULT_WEIGHT))


def with_round3(df: DataFrame, value: str, name: str) -> DataFrame:
    """``name``: the column ``value`` to three places by its exact binary value; exact ties go to the even digit.

    ``125 * x`` is compared with ``(2 * m + 1) / 16``, which lies halfway between m and m + 1
    thousandths: x is split into two parts whose products with 125 are exact. Each step is a column of its own:
    written as one expression, each would be there as often as later ones use it, and the generated code
    would not compile."""
    x, wide, high, m, past = (F.col(c) for c in ("_x", "_wide", "_high", "_m", "_past"))
    steps = df.withColumn("_x", F.abs(F.col(value))).withColumn("_wide", x * 134217729.0)  # 2**27 + 1
    steps = steps.withColumn("_high", wide - (wide - x)).withColumn("_m", F.floor(x * 1000.0).cast("double"))
    steps = steps.withColumn("_past", (high * 125.0 - (2.0 * m + 1.0) / 16.0) + (x - high) * 125.0)
    up = (past > 0) | ((past == 0) & (m % 2 == 1))
    steps = steps.withColumn("_rounded", (m + F.when(up, 1.0).otherwise(0.0)) / 1000.0)
    signed = F.when(F.col(value) < 0, -F.col("_rounded")).otherwise(F.col("_rounded"))
    # from 2**42 on a double holds no fourth place worth rounding
    rounded = F.when(x < float(1 << 42), signed).otherwise(F.col(value))
    return steps.withColumn(name, rounded).drop("_x", "_wide", "_high", "_m", "_past", "_rounded")


def unparsable_message(src: Column, dst: Column) -> Column:
    return F.concat(F.lit("edge confidence is no number: "), shown(src), F.lit(" -> "), shown(dst))


def shown(col: Column) -> Column:
    """How an absent value prints inside a message."""
    return F.coalesce(col, F.lit("None"))


def invalid_type_message(node_type: Column) -> Column:
    return F.concat(F.lit("invalid node type: "), shown(node_type))


def dangling_message(src: Column, dst: Column) -> Column:
    return F.concat(F.lit("dangling edge: "), shown(src), F.lit(" -> "), shown(dst))


def missing_field_message(field: Column, src: Column, dst: Column) -> Column:
    return F.concat(F.lit("edge missing evidence."), field, F.lit(": "), shown(src), F.lit(" -> "), shown(dst))
