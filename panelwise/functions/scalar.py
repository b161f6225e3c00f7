"""Scalar expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower clip of the log transform, characters not allowed in names.
LOG_CLIP = 1e-5
NAME_PATTERN = r'[<>:"/\\|?*]'
RUN_ID_FORMAT = "yyyyMMdd_HHmmss"


def null_if_nan(column: Column) -> Column:
    """NaN means missing on input; inside the library missing is NULL."""
    return F.when(~F.isnan(column), column)


def clipped_log(column: Column) -> Column:
    """``ln(max(x, 1e-5) + 1)``; NULL and NaN give NULL."""
    value = null_if_nan(column.cast("double"))
    return F.when(value.isNotNull(), F.ln(F.greatest(value, F.lit(LOG_CLIP)) + F.lit(1.0)))


def above(column: Column, threshold: float) -> Column:
    """1 where the score is strictly above the threshold."""
    return (column > F.lit(float(threshold))).cast("int")


def safe_ratio(numerator: Column, denominator: Column, default: float | None) -> Column:
    """Ratio that yields ``default`` where the denominator is zero."""
    return F.when(denominator > 0, numerator / denominator).otherwise(
        F.lit(default).cast("double")
    )


def sanitize_name(column: Column) -> Column:
    """Replace the characters that file systems reject by ``_``."""
    return F.regexp_replace(column, NAME_PATTERN, "_")


def slug(column: Column) -> Column:
    """Lower case with ``_`` for spaces."""
    return F.lower(F.replace(column, F.lit(" "), F.lit("_")))


def hash_key(key: Column, seed: int, purpose: str = "") -> Column:
    """Hex digest that orders keys at random, the same under any partitioning."""
    tail = f":{seed}" if not purpose else f":{seed}:{purpose}"
    return F.md5(F.concat(key.cast("string"), F.lit(tail)).cast("binary"))


def hash_draw(key: Column, seed: int, purpose: str) -> Column:
    """Integer in [0, 2^60) drawn from the key, the seed and the purpose."""
    return F.conv(F.substring(hash_key(key, seed, purpose), 1, 15), 16, 10).cast("bigint")


def hash_uniform(key: Column, seed: int, purpose: str) -> Column:
    """Number in [0, 1) drawn from the key, the seed and the purpose."""
    return hash_draw(key, seed, purpose).cast("double") / F.lit(float(1 << 60))


def run_time(column: Column) -> Column:
    """Timestamp of a run id such as ``20241215_010515``."""
    return F.to_timestamp(column, RUN_ID_FORMAT)
