"""Column expressions shared by the operators (all JVM-side, codegen friendly)."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ctxanomaly.config import EULER_GAMMA

# Separator of hashed key parts (ASCII unit separator, absent from data).
KEY_SEP = "\x1f"
NULL_TOKEN = "\\N"
HASH_BITS = 60  # 15 hex digits of an md5 digest


def row_key(*cols: str) -> Column:
    """Text key of a row: parts joined by KEY_SEP, nulls as a fixed token.

    Timestamps are formatted ``yyyy-MM-dd HH`` (hourly grain), so the same
    key can be built by any SQL engine.
    """
    parts = []
    for c in cols:
        if c == "datetime":
            part = F.date_format(F.col(c), "yyyy-MM-dd HH")
        else:
            part = F.col(c).cast("string")
        parts.append(F.coalesce(part, F.lit(NULL_TOKEN)))
    return F.concat_ws(KEY_SEP, *parts)


def hash_int(*parts: Column | str | int) -> Column:
    """60-bit integer hash of the joined parts: first 15 hex digits of md5."""
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    text = F.concat_ws(KEY_SEP, *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def hash_int_py(*parts: object) -> int:
    """Same hash as :func:`hash_int`, for driver- or task-side Python."""
    text = KEY_SEP.join(str(p) for p in parts)
    return int(hashlib.md5(text.encode("utf-8")).hexdigest()[:15], 16)


def hash_unit_py(*parts: object) -> float:
    """Uniform number in [0, 1) from :func:`hash_int_py`."""
    return hash_int_py(*parts) / float(1 << HASH_BITS)


def c_factor_py(n: float) -> float:
    """Average path length of an unsuccessful BST search over n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + EULER_GAMMA) - 2.0 * (n - 1) / n


def c_factor(n: Column) -> Column:
    """Column form of :func:`c_factor_py`."""
    n = n.cast("double")
    general = F.lit(2.0) * (F.log(n - F.lit(1.0)) + F.lit(EULER_GAMMA)) - F.lit(2.0) * (
        n - F.lit(1.0)
    ) / n
    return F.when(n <= 1, F.lit(0.0)).when(n == 2, F.lit(1.0)).otherwise(general)


def rate(numerator: Column, denominator: Column) -> Column:
    """Null-safe ratio (null when the denominator is zero)."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def round_columns(df: DataFrame, cols: Sequence[str], digits: int) -> DataFrame:
    """``round(c, digits)`` of double columns, bit for bit, without going
    through the decimal text of values that are no near tie.

    y = c * 10^digits is less than 2^-7 off the decimal's where abs(y) < 2^45,
    so its nearest whole number is the decimal's wherever they are less than
    0.49 apart; and that whole number over a power of ten is the double that
    is nearest to the rounded decimal.
    """
    scale, y, whole = F.lit(10.0**digits), lambda c: F.col(f"__y_{c}"), lambda c: F.col(f"__whole_{c}")
    clear = lambda c: F.abs(y(c) - whole(c)) + F.abs(y(c)) * F.lit(2.0**-46) < F.lit(0.49)
    # in steps, so that no expression is written out twice
    out = df.withColumns({f"__y_{c}": F.col(c) * scale for c in cols})
    out = out.withColumns({f"__whole_{c}": F.rint(y(c)) for c in cols})
    tidy = {c: F.when(clear(c), whole(c) / scale + F.lit(0.0)).otherwise(F.round(c, digits)) for c in cols}
    return out.withColumns(tidy).drop(*[f"__{p}_{c}" for c in cols for p in ("y", "whole")])


def flag_abs_gt(z: Column, threshold: float) -> Column:
    """Strict, null-safe ``abs(z) > t``; a null z is never anomalous."""
    return F.coalesce(F.abs(z) > F.lit(float(threshold)), F.lit(False))


def finite_nonneg(c: Column) -> Column:
    """``0 <= c < inf``; rejects null, negative, NaN and infinity."""
    return c.isNotNull() & (c >= F.lit(0.0)) & (c < F.lit(float("inf")))


def flag_of(c: Column) -> Column:
    """1 where ``c`` is true, 'true' in any case or numerically 1, else 0."""
    hit = (F.lower(c.cast("string")) == F.lit("true")) | (c.try_cast("double") == F.lit(1.0))
    return F.when(hit, F.lit(1)).otherwise(F.lit(0))
