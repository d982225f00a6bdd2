"""Group-wise statistics.  Samples are rows (key..., side in {"cand", "targ"}, value); every test runs for all keys at once."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import kolmogorov_p, normal_quantile
from ..sources.staging import sized, stage
from .dip import dip, dip_p
from .quantiles import group_quantiles


#: Up to so many values on the larger side, p of a Kolmogorov-Smirnov statistic is exact; up to the second number it is that of one
#: sample of the two sizes' harmonic size; beyond, the limit with a correction.
EXACT_ROWS, FINITE_ROWS = 10_000, 500_000


def ks(samples: DataFrame, keys: Sequence[str], exact_rows: int = EXACT_ROWS, pieces: bool = False) -> DataFrame:
    """Exact two-sample Kolmogorov-Smirnov: statistic, sizes, p-value.  Works on the histogram of distinct values.

    ``pieces``: cut a key's histogram over tasks, for keys with many millions of distinct values (or put these into ``binned``).
    """
    hist = samples.filter("value is not null").groupBy(*keys, "value").agg(F.count_if(F.col("side") == "cand").alias("__c"), F.count_if(F.col("side") == "targ").alias("__t"))
    if pieces:
        cdf = running(hist, keys, ["value"], {"__cc": F.col("__c"), "__ct": F.col("__t")}).withColumnsRenamed({"__cc_all": "__n", "__ct_all": "__m"})
    else:
        w = Window.partitionBy(*keys)
        run = w.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
        cdf = hist.withColumns({"__cc": F.sum("__c").over(run), "__ct": F.sum("__t").over(run), "__n": F.sum("__c").over(w), "__m": F.sum("__t").over(w)})
    out = cdf.filter("__n > 0 and __m > 0").groupBy(*keys).agg(F.max("__n").alias("n_cand"), F.max("__m").alias("n_targ"), F.max(F.abs(F.col("__cc") / F.col("__n") - F.col("__ct") / F.col("__m"))).alias("ks"))
    return out.withColumn("ks_p", ks_p(F.col("ks"), F.col("n_cand"), F.col("n_targ"), exact_rows))


def ks_p(d, n, m, exact_rows: int = EXACT_ROWS):
    """Two-sided p: exact while neither side has more than ``exact_rows`` values, that of a finite sample up to ``FINITE_ROWS``, else by the corrected limit."""
    n, m = n.cast("double"), m.cast("double")
    limit = kolmogorov_p(d, n, m)
    if not exact_rows:
        return limit
    small = F.greatest(n, m) <= FINITE_ROWS
    return F.when(small, finite_ks_p(F.when(small, d), n, m, F.lit(float(exact_rows)))).otherwise(limit)


@F.pandas_udf(T.DoubleType())
def finite_ks_p(d: pd.Series, n: pd.Series, m: pd.Series, most: pd.Series) -> pd.Series:
    """p of a two-sample KS statistic, one row per key: the share of interleavings that reach it, or the one-sample distribution."""
    def p(d: float, n: float, m: float, most: float) -> float | None:
        if d != d or min(n, m) <= 0:
            return None
        return _reached(d, n, m) if max(n, m) <= most else one_sample_p(d, round(n * m / (n + m)))

    return pd.Series([p(*x) for x in zip(d.astype(float), n.astype(float), m.astype(float), most.astype(float), strict=True)], dtype="float64")


def one_sample_p(d: float, n: int) -> float:
    """Chance that n uniform values' distribution is somewhere off by d or more.

    The body by the limit's expansion in powers of 1/sqrt(n) (four terms; the rest is of order 1/n^2, below 1e-7 from some
    thousand values), the tail as twice the exact one-sided chance, which keeps its relative precision.
    """
    if n < 1 or d <= 0:
        return 1.0
    if d >= 1:
        return 0.0
    x = d * math.sqrt(n)
    return _one_sided_twice(d, n) if x * x > 4 else 1 - _expansion(x, n)


def _one_sided_twice(d: float, n: int) -> float:
    j = np.arange(0, int(n * (1 - d)) + 1)
    logs = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, n + 1)))])
    left = 1 - d - j / n
    j, left = j[left > 0], left[left > 0]
    terms = logs[n] - logs[j] - logs[n - j] + (j - 1) * np.log(d + j / n) + (n - j) * np.log(left)
    top = terms.max()
    return float(min(1.0, 2 * d * math.exp(top) * np.exp(terms - top).sum())) if top > -740 else 0.0


def _expansion(x: float, n: int) -> float:
    """Distribution function of sqrt(n) times the statistic at x, by the four-term expansion of Pelz and Good."""
    if x < 0.2:
        return 0.0
    pi2, x2 = math.pi**2, x * x
    k = np.arange(0, 60)
    q = (k + 0.5) ** 2
    odd = np.exp(-pi2 * q / (2 * x2))  # over half integers
    whole = k[1:] ** 2.0
    even = np.exp(-pi2 * whole / (2 * x2))
    root = math.sqrt(math.pi / 2)
    k0 = 2 * root / x * odd.sum()
    k1 = root / (3 * x2**2) * ((pi2 * q - x2) * odd).sum()
    k2 = root / (36 * x**7) * (((6 * x**6 + 2 * x**4) + pi2 * (2 * x**4 - 5 * x2) * q + pi2**2 * (1 - 2 * x2) * q**2) * odd).sum() - root / (18 * x**3) * (pi2 * whole * even).sum()
    k3 = root / (3240 * x**10) * ((pi2**3 * q**3 * (5 - 30 * x2) + pi2**2 * q**2 * (-60 * x2 + 212 * x**4) + pi2 * q * (135 * x**4 - 96 * x**6) - (30 * x**6 + 90 * x**8)) * odd).sum() + root / (108 * x**6) * ((3 * pi2 * x2 * whole - pi2**2 * whole**2) * even).sum()
    return float(min(1.0, max(0.0, k0 + k1 / math.sqrt(n) + k2 / n + k3 / n**1.5)))


def _reached(d: float, n: float, m: float) -> float:
    """1 minus the chance that a random path from (0, 0) to (n, m) keeps |i/n - j/m| below d at every step.

    With u(i, j) the chance given that the path passes (i, j): u(i, j) = i/(i+j) u(i-1, j) + j/(i+j) u(i, j-1) inside the band,
    0 outside; a diagonal i + j = s at a time.
    """
    n, m = int(min(n, m)), int(max(n, m))
    reach = round(d * n * m)
    if not reach:
        return 1.0
    if (far := 2 * d * d * n * m / (n + m)) > 40:
        return 2 * math.exp(-far)  # the bound; below what 1 minus a double can tell
    u = np.zeros(n + 2)  # u[i + 1] is that of i on the current diagonal
    u[1] = 1.0
    for s in range(1, n + m + 1):
        low, high = max(0, s - m, (s * n - reach) // (n + m) + 1), min(n, s, -((-s * n - reach) // (n + m)) - 1)
        i = np.arange(low, high + 1)
        u[low + 1 : high + 2] = (i * u[low : high + 1] + (s - i) * u[low + 1 : high + 2]) / s
        u[low] = 0.0
    return float(min(max(1.0 - u[n + 1], 0.0), 1.0))


def binned(samples: DataFrame, keys: Sequence[str], bins: int = 100_000, above: int = 500_000) -> DataFrame:
    """Replace values by equal bins' numbers for keys with a side of more than ``above`` rows."""
    size = samples.groupBy(*keys, "side").agg(F.count("value").alias("__k"), F.min("value").alias("__lo"), F.max("value").alias("__hi")).groupBy(*keys).agg(F.max("__k").alias("__k"), F.min("__lo").alias("__lo"), F.max("__hi").alias("__hi"))
    both = samples.join(size, list(keys))
    bin_ = F.least(F.width_bucket("value", "__lo", "__hi", F.lit(bins)), F.lit(bins).cast("long")).cast("double")
    return both.withColumn("value", F.when((F.col("__k") > above) & (F.col("__hi") > F.col("__lo")), bin_).otherwise(F.col("value"))).drop("__k", "__lo", "__hi")


def log_p(p, cap: float = 300.0):
    """-log10 of a p-value, capped."""
    return F.least(F.lit(cap), F.when(p > 0, -F.log10(p)).otherwise(F.lit(cap)))


def welch(samples: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Welch's t, degrees of freedom and two-sided p (incomplete beta, one row per key)."""
    c, t = F.when(F.col("side") == "cand", F.col("value")), F.when(F.col("side") == "targ", F.col("value"))
    agg = samples.groupBy(*keys).agg(F.avg(c).alias("m1"), F.var_samp(c).alias("v1"), F.count(c).alias("n1"), F.avg(t).alias("m2"), F.var_samp(t).alias("v2"), F.count(t).alias("n2"))
    a, b = F.col("v1") / F.col("n1"), F.col("v2") / F.col("n2")
    out = agg.filter("n1 > 1 and n2 > 1").withColumns({"t": F.when(a + b > 0, (F.col("m1") - F.col("m2")) / F.sqrt(a + b)), "df": F.when(a + b > 0, (a + b) * (a + b) / (a * a / (F.col("n1") - 1) + b * b / (F.col("n2") - 1)))})
    return out.withColumn("t_p", student_p("t", "df")).select(*keys, "t", "df", "t_p")


@F.pandas_udf(T.DoubleType())
def student_p(t: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided p of Student's t, as a regularised incomplete beta by its continued fraction."""
    t, df = t.to_numpy(float), df.to_numpy(float)
    with np.errstate(all="ignore"):
        x = df / (df + t * t)
        return pd.Series(np.where(np.isfinite(x), _beta(df / 2, np.full(len(df), 0.5), x), np.nan))


def _beta(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    swap = x > (a + 1) / (a + b + 2)
    p, q, z = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1 - x, x)
    gamma = np.vectorize(lambda v: math.lgamma(v) if np.isfinite(v) and v > 0 else np.nan)
    front = np.exp(gamma(p + q) - gamma(p) - gamma(q) + p * np.log(np.maximum(z, 1e-300)) + q * np.log1p(-z)) / p
    tiny = 1e-300
    c, d = np.ones_like(z), 1 / np.where(np.abs(1 - (p + q) * z / (p + 1)) < tiny, tiny, 1 - (p + q) * z / (p + 1))
    out = d.copy()
    for m in range(1, 300):
        for term in (m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m)), -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1))):
            d = 1 + term * d
            c = 1 + term / c
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = np.where(np.abs(c) < tiny, tiny, c)
            out = out * d * c
    return np.where(swap, 1 - front * out, front * out)


def mad(samples: DataFrame, keys: Sequence[str], times: float = 3.0, half: DataFrame | None = None) -> DataFrame:
    """Is the candidate's median within ``times`` median deviations of the target's?  ``half``: the medians (keys, side, median), if known."""
    if half is None:
        half = group_quantiles(samples, [*keys, "side"], [0.5]).withColumn("median", F.col("quantiles")[0])
    med = half.groupBy(*keys).agg(*[F.max(F.when(F.col("side") == s, F.col("median"))).alias(f"median_{s}") for s in ("cand", "targ")])
    med = sized(med, "medians")
    far = samples.filter("side = 'targ'").join(med.select(*keys, "median_targ"), list(keys)).select(*keys, F.abs(F.col("value") - F.col("median_targ")).alias("value"))
    dev = group_quantiles(far, keys, [0.5]).select(*keys, F.col("quantiles")[0].alias("mad_targ"))
    return med.join(dev, list(keys)).withColumn("mad_pass", F.abs(F.col("median_cand") - F.col("median_targ")) <= times * F.col("mad_targ"))


def decide(samples: DataFrame, keys: Sequence[str], times: float = 3.0, exact_rows: int = EXACT_ROWS, half: DataFrame | None = None) -> DataFrame:
    """KS, then Welch, then median deviation: what each test found, the verdict and the test that decided; all three are computed."""
    both = ks(samples, keys, exact_rows).join(welch(samples, keys), list(keys), "left").join(mad(samples, keys, times, half), list(keys), "left")
    k, t = (F.col("ks") < 0.3) & (F.col("ks_p") < 0.05), F.coalesce(F.col("t_p") >= 0.05, F.lit(False))
    m = F.coalesce("mad_pass", F.lit(False))
    found = both.withColumns({
        "ks_pass": k, "ks_mlogp": log_p(F.col("ks_p")), "t_pass": t, "t_mlogp": F.when(F.col("t_p").isNotNull(), log_p(F.col("t_p"))),
        "mad_dist": F.abs(F.col("median_cand") - F.col("median_targ")), "mad_threshold": times * F.col("mad_targ"), "mad_pass": m,
    })
    k, t, m = F.col("ks_pass"), F.col("t_pass"), F.col("mad_pass")
    return found.withColumns({"verdict": F.when(k | t | m, "PASS").otherwise("FAIL"), "decided_by": F.when(k, "KS").when(t, "T").otherwise("MAD"), "tests_passed": k.cast("int") + t.cast("int") + m.cast("int")})


def bimodality(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bimodality coefficient from sample-corrected skewness and excess kurtosis."""
    agg = df.filter("value is not null").groupBy(*keys).agg(F.count("value").alias("n"), F.skewness("value").alias("g1"), F.kurtosis("value").alias("g2"))
    n = F.col("n").cast("double")
    return agg.withColumn("bc", F.when(F.col("n") > 3, (F.col("g1") * F.col("g1") + 1) / (F.col("g2") + 3 * (n - 1) * (n - 1) / ((n - 2) * (n - 3))))).select(*keys, "n", "bc")


def bimodal_status(bc, dip_p=None):
    """Status by dip p and coefficient; where there is no dip p, by the coefficient alone."""
    alone = F.when(bc >= 0.555, "bimodal").otherwise("unimodal")
    if dip_p is None:
        return alone
    return F.when(dip_p.isNull(), alone).when(dip_p >= 0.05, "unimodal").when(bc >= 0.555, "bimodal").otherwise("bimodal_cautious")


#: Cells that a key's histogram is put into if it has more distinct values; EM stops at this change of the mean log likelihood.
CELLS, TOLERANCE, MOST_ROUNDS = 8192, 1e-3, 300
_FIT = "n long, w double, m1 double, m2 double, s1 double, s2 double, bic double, bc double, separator double, overlap_pct double, dip double, dip_p double"


def histogram(df: DataFrame, keys: Sequence[str], log10: bool = False, cells: int = CELLS) -> DataFrame:
    """keys, __x, __k, __wide: distinct values and their numbers; keys with more than ``cells`` of them (wide) in so many equal cells (__x: the mean)."""
    v = F.log10("value") if log10 else F.col("value").cast("double")
    hist = df.filter("value > 0" if log10 else "value is not null").groupBy(*keys, v.alias("__x")).agg(F.count("*").alias("__k"))
    size = hist.groupBy(*keys).agg(F.count("*").alias("__distinct"), F.min("__x").alias("__lo"), F.max("__x").alias("__hi"))
    cell = F.when(F.col("__distinct") > cells, F.least(F.width_bucket("__x", "__lo", "__hi", F.lit(cells)), F.lit(cells)))
    return hist.join(size, list(keys)).groupBy(*keys, F.coalesce(cell.cast("double"), "__x").alias("__cell")).agg((F.sum(F.col("__x") * F.col("__k")) / F.sum("__k")).alias("__x"), F.sum("__k").alias("__k"), F.bool_or(F.col("__distinct") > cells).alias("__wide")).drop("__cell")


def mixture(df: DataFrame, keys: Sequence[str], log10: bool = False) -> DataFrame:
    """Two normal components per key: weights, means, deviations, BIC, bimodality coefficient, separator, overlap, dip and its p.

    EM runs on each key's bounded histogram, from the best split of the values in two, until the mean log likelihood changes by
    less than ``TOLERANCE``.  With ``log10`` in that space, but with the separator in the values' own; positive values only, and
    only keys with ten of them.
    """
    hist = histogram(df, keys, log10)
    schema = ", ".join(f"`{c}` {t}" for c, t in hist.dtypes if c in keys) + ", " + _FIT

    def fit(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("__x")
        x, k = part["__x"].to_numpy(float), part["__k"].to_numpy(float)
        found = two_normals(x, k)
        found["dip"] = dip(x, k, bool(part["__wide"].any()))
        found["dip_p"] = dip_p(found["dip"], found["n"])
        if log10:
            found["separator"] = 10 ** found["separator"]
        rows = [] if found["n"] < (10 if log10 else 2) else [dict(zip(keys, key, strict=True)) | found]
        return pd.DataFrame(rows, columns=[*keys, *found])

    return hist.groupBy(*keys).applyInPandas(fit, schema)


def two_normals(x: np.ndarray, k: np.ndarray) -> dict:
    """Fit of two normal components to sorted values x with weights k."""
    n, mean = k.sum(), (k * x).sum() / max(k.sum(), 1)
    c2, c3, c4 = (float((k * (x - mean) ** p).sum() / max(n, 1)) for p in (2, 3, 4))
    bc = (c3 * c3 / c2**3 + 1) / (c4 / c2**2 - 3 + 3 * (n - 1) ** 2 / ((n - 2) * (n - 3))) if n > 3 and c2 > 0 else math.nan
    # the split with the least variance within its parts
    a, sx = np.cumsum(k)[:-1], np.cumsum(k * x)[:-1]
    between = sx**2 / a + ((k * x).sum() - sx) ** 2 / (n - a) if len(x) > 1 else np.zeros(0)
    low = np.arange(len(x)) <= (int(np.argmax(between)) if len(between) else 0)
    r, before = low.astype(float), -np.inf
    for _ in range(MOST_ROUNDS):
        parts = []
        for share in (k * r, k * (1 - r)):
            size = share.sum() + 1e-15
            m = (share * x).sum() / size
            parts.append((size / n, m, math.sqrt((share * (x - m) ** 2).sum() / size + 1e-6)))
        logs = [math.log(w) - np.log(s) - 0.5 * math.log(2 * math.pi) - (x - m) ** 2 / (2 * s * s) for w, m, s in parts]
        total = np.logaddexp(*logs)
        r, now = np.exp(logs[0] - total), float((k * total).sum() / max(n, 1))
        if abs(now - before) < TOLERANCE:
            break
        before = now
    (w, m1, s1), (v, m2, s2) = parts

    def weighted(grid: np.ndarray) -> list[np.ndarray]:
        return [weight * np.exp(-0.5 * ((grid - m) / s) ** 2) / (s * math.sqrt(2 * math.pi)) for weight, m, s in parts]

    grid = np.linspace(min(m1, m2), max(m1, m2), 2000)
    gap = np.subtract(*weighted(grid))
    turn = np.flatnonzero(np.sign(gap[1:]) != np.sign(gap[:-1]))
    cut = (m1 + m2) / 2
    if len(turn):
        i = int(turn[0])
        cut = grid[i] - gap[i] * (grid[i + 1] - grid[i]) / (gap[i + 1] - gap[i])
    wide = np.linspace(min(m1 - 4 * s1, m2 - 4 * s2), max(m1 + 4 * s1, m2 + 4 * s2), 2000)
    least = np.minimum(*weighted(wide))
    overlap = float(((least[1:] + least[:-1]) / 2 * np.diff(wide)).sum() * 100)
    return {"n": int(n), "w": w, "m1": m1, "m2": m2, "s1": s1, "s2": s2, "bic": 5 * math.log(max(n, 1)) - 2 * now * n, "bc": bc, "separator": float(cut), "overlap_pct": overlap}


def bimodal_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The better of the linear and the log10 fit by BIC, with the shape judged by dip and coefficient in that space."""
    both = mixture(df, keys).withColumn("log_space", F.lit(False)).unionByName(mixture(df, keys, log10=True).withColumn("log_space", F.lit(True)))
    best = both.groupBy(*keys).agg(F.min_by(F.struct(*[c for c in both.columns if c not in keys]), F.struct("bic", "log_space")).alias("b")).select(*keys, "b.*")
    return best.withColumn("shape", bimodal_status(*[F.nanvl(F.col(c), F.lit(None).cast("double")) for c in ("bc", "dip_p")]))


def split_score(scored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows (key..., sub in {all, low, high}, unit, ks, n), where "all" is the whole sample: size-weighted best KS of the halves against the whole.

    The improvement is 0 where the whole sample already agrees, null where a half is missing.
    """
    best = scored.groupBy(*keys, "sub").agg(F.min(F.struct("ks", "unit")).alias("b"), F.max("n").alias("n"))
    by = {s: F.max(F.when(F.col("sub") == s, F.col("b"))) for s in ("all", "low", "high")}
    size = {s: F.max(F.when(F.col("sub") == s, F.col("n"))) for s in ("low", "high")}
    out = best.groupBy(*keys).agg(*[c.alias(s) for s, c in by.items()], *[c.alias(f"n_{s}") for s, c in size.items()])
    split = F.try_divide(F.col("low.ks") * F.col("n_low") + F.col("high.ks") * F.col("n_high"), F.col("n_low") + F.col("n_high"))
    return out.select(*keys, F.col("all.ks").alias("ks_all"), split.alias("ks_split"), F.when(F.col("all.ks") > 0, (F.col("all.ks") - split) / F.col("all.ks")).otherwise(0.0).alias("improvement"), (F.col("low.unit") == F.col("high.unit")).alias("same_unit"))


def sigma_filter(df: DataFrame, keys: Sequence[str], times: float = 3.0) -> DataFrame:
    """Rows within mean +- 3 sample deviations of their group; groups of one row or without spread stay whole."""
    agg = sized(df.groupBy(*keys).agg(F.avg("value").alias("__m"), F.stddev_samp("value").alias("__s")), "group-spread")
    keep = F.coalesce(F.col("__s"), F.lit(0.0)) == 0
    return df.join(agg, list(keys)).withColumn("kept", keep | (F.abs(F.col("value") - F.col("__m")) <= times * F.col("__s"))).drop("__m", "__s")


def deciles(df: DataFrame, keys: Sequence[str], ends: bool = False) -> DataFrame:
    """keys, deciles: 10 to 90 %, or 0 to 100 %, of every group that has a value."""
    return group_quantiles(df, keys, [i / 10 for i in (range(11) if ends else range(1, 10))]).select(*keys, F.col("quantiles").alias("deciles"))


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str], counts: dict[str, Column]) -> DataFrame:
    """For each of ``counts`` (not negative) its sum over a key's rows up to and including each one, and over all of them (``name_all``).

    Rows are range-partitioned by key and order, so a key with a large part of the rows is cut into pieces; a piece adds what
    the pieces of its key before it hold.
    """
    sort = [*keys, *order]
    local = stage(df.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn("__part", F.spark_partition_id()), "running-rows")
    w = Window.partitionBy("__part", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inside = local.withColumns({n: F.sum(c).over(w) for n, c in counts.items()})
    sums = inside.groupBy("__part", *keys).agg(*[F.max(n).alias(n) for n in counts])  # a row per key and piece
    own = Window.partitionBy(*keys)
    before = own.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    told = sums.select(F.col("__part").alias("__piece"), *[F.col(k).alias(f"__{k}") for k in keys], *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"__{n}_0") for n in counts], *[F.sum(n).over(own).alias(f"{n}_all") for n in counts])
    on = F.col("__part") == F.col("__piece")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    both = inside.join(told, on).withColumns({n: F.col(n) + F.col(f"__{n}_0") for n in counts})
    return both.select(*df.columns, *counts, *[f"{n}_all" for n in counts])


def running_ratio(df: DataFrame, keys: Sequence[str], order: Sequence[str], flag: str, out: str = "ratio") -> DataFrame:
    """Share of flagged rows among a key's rows up to and including each one, in ``order``."""
    both = running(df, keys, order, {"__n": F.lit(1), "__hit": F.col(flag).cast("int")})
    return both.withColumn(out, F.coalesce("__hit", F.lit(0)) / F.col("__n")).select(*df.columns, out)


def average_rank(df: DataFrame, value: str = "value", keys: Sequence[str] = (), pieces: bool | None = None) -> DataFrame:
    """value, k, n, rank: the average rank of each distinct value, from its histogram.

    ``pieces``: cut a key's histogram over tasks; the default without keys, where all values are one group.
    """
    hist = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("k"))
    if not keys if pieces is None else pieces:
        to = running(hist, keys, [value], {"__to": F.col("k")})
        return to.select(*keys, value, "k", F.col("__to_all").alias("n"), (F.col("__to") - (F.col("k") - 1) / 2).alias("rank"))
    w = Window.partitionBy(*keys)
    run = w.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    return hist.withColumns({"n": F.sum("k").over(w), "rank": F.sum("k").over(run) - (F.col("k") - 1) / 2})


def inverse_normal(df: DataFrame, value: str = "value", keys: Sequence[str] = (), pieces: bool | None = None) -> DataFrame:
    """Blom's rank-based transform of each distinct value."""
    return average_rank(df, value, keys, pieces).withColumn("z", normal_quantile((F.col("rank") - 0.375) / (F.col("n") + 0.25)))
