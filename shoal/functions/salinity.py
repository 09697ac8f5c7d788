"""Conductivity to practical salinity (P10) as a closed-form Column.

Practical Salinity Scale 1978 (UNESCO 1981) at pressure 0 with the Hill et
al. (1986) extension below S = 2.  Input is conductivity in mS/cm measured
or normalised at temperature ``t`` (deg C, 25 for specific conductance).
Everything is built from built-in arithmetic, so it stays inside generated
code; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# PSS-78 coefficients and the conductivity of standard seawater.
C_35_15_0 = 42.914
A = [0.0080, -0.1692, 25.3851, 14.0941, -7.0261, 2.7081]
B = [0.0005, -0.0056, -0.0066, -0.0375, 0.0636, -0.0144]
C = [0.6766097, 2.00564e-2, 1.104259e-4, -6.9698e-7, 1.0031e-9]
K = 0.0162


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(float(v))


def _rt_t(t: Column) -> Column:
    return C[0] + C[1] * t + C[2] * t * t + C[3] * t * t * t + C[4] * t * t * t * t


def _f(t: Column) -> Column:
    return (t - 15.0) / (F.lit(1.0) + K * (t - 15.0))


def _pss78(big_r: Column, f: Column) -> Column:
    sq = F.sqrt(big_r)
    # powers of sqrt(R_t): R^0, R^0.5, R^1, R^1.5, R^2, R^2.5
    pw = [F.lit(1.0), sq, big_r, big_r * sq, big_r * big_r, big_r * big_r * sq]
    s_a = sum((A[i] * pw[i] for i in range(1, 6)), F.lit(A[0]))
    s_b = sum((B[i] * pw[i] for i in range(1, 6)), F.lit(B[0]))
    return s_a + f * s_b


def _hill(s: Column, big_r: Column, f: Column) -> Column:
    x = 400.0 * big_r
    y = 100.0 * big_r
    return (s - A[0] / (F.lit(1.0) + 1.5 * x + x * x)
            - B[0] * f / (F.lit(1.0) + F.sqrt(y) + y + y * F.sqrt(y)))


def ec_to_salinity(ec_ms: Column, t: float | Column = 25.0, extended: bool = True) -> Column:
    """Salinity from conductivity in mS/cm; null for negative or null input.

    One self-contained expression: handy for a single column, but the
    polynomial is repeated inside it, so prefer :func:`with_salinity` for
    bulk work (it computes each intermediate once per row).
    """
    t = _lit(t)
    big_r = ec_ms / F.lit(C_35_15_0) / _rt_t(t)
    f = _f(t)
    s = _pss78(big_r, f)
    if extended:
        s = F.when(s < 2.0, _hill(s, big_r, f)).otherwise(s)
    return F.when(ec_ms.isNull() | (ec_ms < 0), F.lit(None).cast("double")).otherwise(s)


def with_salinity(df: DataFrame, ec_ms: Column, out: str, t: float | Column = 25.0,
                  extended: bool = True) -> DataFrame:
    """Add ``out`` = salinity of ``ec_ms`` (mS/cm) at ``t`` deg C.

    The conductivity ratio and the PSS-78 value are staged as their own
    columns, so every row evaluates each of them once and the generated code
    stays small (one inlined expression would repeat the polynomial several
    times and fall out of whole-stage code generation).
    """
    t = _lit(t)
    tmp_ec, tmp_r, tmp_s, tmp_f = "_sal_ec", "_sal_r", "_sal_s", "_sal_f"
    df = (df.withColumn(tmp_ec, ec_ms)
          .withColumn(tmp_f, _f(t))
          .withColumn(tmp_r, F.col(tmp_ec) / F.lit(C_35_15_0) / _rt_t(t)))
    df = df.withColumn(tmp_s, _pss78(F.col(tmp_r), F.col(tmp_f)))
    s = F.col(tmp_s)
    if extended:
        s = F.when(s < 2.0, _hill(s, F.col(tmp_r), F.col(tmp_f))).otherwise(s)
    ec = F.col(tmp_ec)
    df = df.withColumn(out, F.when(ec.isNull() | (ec < 0), F.lit(None).cast("double")).otherwise(s))
    return df.drop(tmp_ec, tmp_r, tmp_s, tmp_f)


def clamp_salinity(s: Column, upper: float = 40.0, small_negative: float = -0.1) -> Column:
    """(-0.1, 0) -> 0, above ``upper`` -> null."""
    return (F.when((s < 0) & (s > small_negative), F.lit(0.0))
            .when(s > upper, F.lit(None).cast("double"))
            .otherwise(s))
