"""Column functions that several operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Text that counts as a number: no letters but an exponent's, unlike a plain cast.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number(c: Column | str) -> Column:
    """Text to double; anything that isn't a finite decimal number becomes null.  ``c`` stands in it once, however long it is."""
    return F.regexp_extract(col(c).cast("string"), NUMBER, 0).try_cast("double")


def delete_chars(c: Column | str, chars: str) -> Column:
    return F.translate(col(c), chars, "")


#: Unicode white space, as ``(?U)\\s`` has it.
WHITE_SPACE = "\t\n\x0b\f\r \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000"


def without_space(c: Column | str) -> Column:
    """All white space deleted, character by character: a fraction of what a pattern costs."""
    return delete_chars(c, WHITE_SPACE)


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(""))


def append_note(old: Column, new: Column) -> Column:
    """Join notes with "; "; nulls vanish, no note at all is null."""
    return F.nullif(F.concat_ws("; ", old, new), F.lit(""))


def normal_quantile(p: Column) -> Column:
    """Inverse of the normal distribution by a rational approximation (relative error about 1e-9), as SQL expressions."""
    a = (-39.69683028665376, 220.9460984245205, -275.9285104469687, 138.3577518672690, -30.66479806614716, 2.506628277459239)
    b = (-54.47609879822406, 161.5858368580409, -155.6989798598866, 66.80131188771972, -13.28068155288572)
    c = (-0.007784894002430293, -0.3223964580411365, -2.400758277161838, -2.549732539343734, 4.374664141464968, 2.938163982698783)
    d = (0.007784695709041462, 0.3224671290700398, 2.445134137142996, 3.754408661907416)

    def poly(x: Column, k: tuple, last: float | None = None) -> Column:
        out = F.lit(k[0])
        for v in k[1:]:
            out = out * x + v
        return out if last is None else out * x + last

    low = F.sqrt(-2 * F.log(p))
    high = F.sqrt(-2 * F.log(1 - p))
    mid = p - 0.5
    r = mid * mid
    return F.when(p < 0.02425, poly(low, c) / poly(low, d, 1.0)).when(p > 0.97575, -poly(high, c) / poly(high, d, 1.0)).otherwise(poly(r, a) * mid / poly(r, b, 1.0))


def kolmogorov_p(d: Column, n: Column, m: Column) -> Column:
    """Two-sided p-value of a two-sample KS statistic by the limiting series, with the correction for finite samples."""
    size = F.sqrt(F.try_divide(n * m, n + m))
    lam = d * (size + 0.12 + F.try_divide(F.lit(0.11), size))
    series = F.aggregate(F.sequence(F.lit(1), F.lit(100)), F.lit(0.0), lambda s, k: s + 2 * F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * lam * lam))
    return F.when(lam < 0.2, 1.0).when(lam.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), series)))
