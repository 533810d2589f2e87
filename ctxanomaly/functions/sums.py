"""Order-independent moments by sums of whole numbers.

A double sum depends on the order in which partial sums meet; sums of whole
numbers do not.  Two forms:

``FixedSums`` add up values at a declared decimal scale, exactly, in one pass
and next to any other aggregate: a value is a 62-bit whole number of two
halves, and the halves, and the products of the halves cut in two again, are
added up as 64-bit numbers.  Values that are no multiple of the scale, or too
large for it, are counted and left out.

``ScaledSums`` take any doubles.  A value is moved to q = (x - lo) / (hi - lo),
between 0 and 1, and q and q^2 are added up as whole multiples of 1/unit, with
the largest power of two that n of them cannot overflow.  They keep about as
many digits as a double and stay accurate where the spread is small against
the values, but need n, lo and hi before they add up.  ``FixedSums`` can be
turned into them without another pass, as their extremes are known when the
exact sums are.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HALF = 31
_LOW = (1 << HALF) - 1
#: Decimal scale of measures (also that of the hourly totals).
MEASURE_UNIT = 10**6


def unit_for(n: Column) -> Column:
    """Units in 1: the largest power of two that n values cannot overflow."""
    n = F.greatest(n, F.lit(1)).cast("double")
    return F.pow(F.lit(2.0), F.lit(60.0) - F.ceil(F.log2(n)))


@dataclass(frozen=True)
class ScaledSums:
    """Sums over n values of ``x`` between ``lo`` and ``hi``, in units of
    :func:`unit_for` n."""

    x: Column
    n: Column
    lo: Column
    hi: Column
    unit: Column

    @property
    def span(self) -> Column:
        return self.hi - self.lo

    def parts(self) -> tuple[Column, Column]:
        """q and q^2 of a row, in units."""
        q = F.when(self.span > 0, (self.x - self.lo) / self.span).when(self.x.isNotNull(), F.lit(0.0))
        return F.rint(q * self.unit).cast("bigint"), F.rint(q * q * self.unit).cast("bigint")

    def sums(self) -> tuple[Column, Column]:
        q, q2 = self.parts()
        return F.sum(q), F.sum(q2)

    def mean(self, s: Column, n: Column | None = None) -> Column:
        """Mean of the n values (default: all) with the given sum."""
        n = self.n if n is None else n
        return self.lo + self.span * F.try_divide(s.cast("double") / self.unit, n.cast("double"))

    def variance(self, s: Column, s2: Column, n: Column | None = None) -> Column:
        """Sample variance; null for fewer than two values."""
        n = (self.n if n is None else n).cast("double")
        a, b = s.cast("double") / self.unit, s2.cast("double") / self.unit
        around = F.greatest(b - F.try_divide(a * a, n), F.lit(0.0))
        return F.when(n > 1, self.span * self.span * F.try_divide(around, n - 1))

    def std(self, s: Column, s2: Column, n: Column | None = None) -> Column:
        return F.sqrt(self.variance(s, s2, n))


@dataclass(frozen=True)
class FixedSums:
    """Exact sums of the whole multiples of 1/``scale`` in a column.

    ``name`` prefixes the aggregates' columns.  :meth:`aggregates` gives the
    expressions of the one pass; the other methods read their results.  Up to
    2^32 values of a group cannot overflow; beyond, the sum is an error.
    """

    name: str
    scale: int = MEASURE_UNIT

    def at(self, part: str) -> Column:
        return F.col(f"_{part}_{self.name}")

    def halves(self, x: Column) -> dict[str, Column]:
        """The row columns that :meth:`aggregates` add up."""
        whole = F.rint(x * F.lit(float(self.scale)))
        fits = (F.abs(whole) < F.lit(2.0**62)) & (whole / F.lit(float(self.scale)) == x)
        k = F.when(fits, whole.try_cast("bigint"))
        return {
            f"_h_{self.name}": F.shiftright(k, HALF),
            f"_l_{self.name}": k.bitwiseAND(F.lit(_LOW)),
            f"_misfit_{self.name}": F.when(x.isNotNull() & ~fits, F.lit(1).cast("bigint")),
        }

    def aggregates(self) -> list[Column]:
        """Sums over the columns of :meth:`halves`."""
        h, low = self.at("h"), self.at("l")
        sums = {"n": F.count(h), "sh": F.sum(h), "sl": F.sum(low), "misfit": F.count(self.at("misfit"))}
        for part, product in (("ll", low * low), ("hl", h * low), ("hh", h * h)):
            sums[f"{part}0"] = F.sum(product.bitwiseAND(F.lit(_LOW)))
            sums[f"{part}1"] = F.sum(F.shiftright(product, HALF))
        return [c.alias(f"_{part}_{self.name}") for part, c in sums.items()]

    @staticmethod
    def _whole(high: Column, low: Column) -> Column:
        """high * 2^31 + low, null beyond 38 digits."""
        return F.try_add(F.try_multiply(high.cast("decimal(38,0)"), F.lit(1 << HALF).cast("decimal(38,0)")), low.cast("decimal(38,0)"))

    def total(self) -> Column:
        """Exact sum in units; null where nothing was added up."""
        return self._whole(self.at("sh"), self.at("sl"))

    def total_of_squares(self) -> Column:
        """Exact sum of squares in squared units; null beyond 38 digits."""
        ll, hl, hh = (self._whole(self.at(f"{p}1"), self.at(f"{p}0")) for p in ("ll", "hl", "hh"))
        twice = F.try_multiply(hl, F.lit(2).cast("decimal(38,0)"))
        return self._whole(self._whole(hh, twice), ll)

    def moments(self, row) -> tuple[float | None, float | None]:
        """Mean and sample standard deviation from a row of the aggregates,
        in whole-number arithmetic up to one division and root."""
        part = lambda p: int(row[f"_{p}_{self.name}"] or 0)
        n = part("n")
        if n == 0:
            return None, None
        join = lambda p: (part(f"{p}1") << HALF) + part(f"{p}0")
        s = (part("sh") << HALF) + part("sl")
        s2 = (((join("hh") << HALF) + 2 * join("hl")) << HALF) + join("ll")
        mean = float(Fraction(s, n * self.scale))
        if n == 1:
            return mean, None
        return mean, math.sqrt(Fraction(n * s2 - s * s, n * (n - 1) * self.scale**2))

    def scaled(self, df: DataFrame) -> DataFrame:
        """Adds ``_s_<name>`` and ``_s2_<name>``, the sums of :class:`ScaledSums`
        with the extremes ``_lo_``, ``_hi_`` and the unit ``_unit_`` of the same
        rows: whole part and remainder of the division by the span (or its
        square) apart, so nothing is lost where values are close to lo.  Null
        where an intermediate exceeds 38 digits.

        In steps, so that no expression is written out twice."""
        c = lambda p: F.col(f"__{p}")
        wide = lambda x: x.cast("decimal(38,0)")
        whole = lambda p: wide(F.rint(self.at(p) * F.lit(float(self.scale))).try_cast("bigint"))
        names = df.columns
        df = df.withColumns({"__t": self.total(), "__t2": self.total_of_squares(), "__lo": whole("lo"), "__hi": whole("hi")})
        above = F.try_subtract(c("t"), F.try_multiply(wide(self.at("n")), c("lo")))
        df = df.withColumns({"__a": above, "__span": F.try_subtract(c("hi"), c("lo"))})
        # sum (x - lo)^2 = sum x^2 - lo (sum x + sum (x - lo))
        above2 = F.try_subtract(c("t2"), F.try_multiply(c("lo"), F.try_add(c("t"), c("a"))))
        df = df.withColumns({"__a2": above2, "__span2": F.try_multiply(c("span"), c("span"))})
        df = df.withColumns({"__r": F.try_mod(c("a"), c("span")), "__r2": F.try_mod(c("a2"), c("span2"))})
        unit = self.at("unit")

        def share(a: Column, r: Column, span: Column) -> Column:
            parts = (a - r).cast("double") / span.cast("double"), r.cast("double") / span.cast("double")
            sums = F.rint(parts[0]).try_cast("bigint") * unit.cast("bigint") + F.rint(parts[1] * unit).try_cast("bigint")
            return F.when(span == 0, F.lit(0).cast("bigint")).otherwise(sums)

        out = {f"_s_{self.name}": share(c("a"), c("r"), c("span")), f"_s2_{self.name}": share(c("a2"), c("r2"), c("span2"))}
        return df.withColumns(out).select(*names, *out)
