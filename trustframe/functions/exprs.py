"""Column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_double(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def safe_div(num: Column, den: Column, default: float = 0.0) -> Column:
    """num / den, ``default`` when the denominator is 0 or NULL."""
    return F.when(den.isNotNull() & (den != 0), as_double(num) / as_double(den)) \
        .otherwise(F.lit(default))


def rate(num: Column, den: Column) -> Column:
    """Rate with the empty-group convention: 0.0 when nothing to divide by."""
    return safe_div(num, den, 0.0)


def nan_to_null(c: Column) -> Column:
    """pandas has one missing marker; Spark has NULL and NaN. Fold NaN into NULL."""
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def order_key(id_col: str | Column, seed: int | str) -> Column:
    """Seeded pseudo-random but reproducible order key: md5('<seed>:<id>')."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.lit(f"{seed}:"), c.cast("string")))


def uniform(*parts: Column) -> Column:
    """Uniform in [0, 1) from the first 52 bits of md5('p1:p2:...'): exact in
    a double and reproducible by any SQL engine with md5."""
    h = F.conv(F.substring(F.md5(F.concat_ws(":", *[p.cast("string") for p in parts])), 1, 13), 16, 10)
    return h.cast("double") / F.lit(float(1 << 52))


def round_half_away(c: Column, digits: int) -> Column:
    """round(x * 10^d) / 10^d with ties away from zero, in plain IEEE double
    arithmetic (multiply, exact floor/ceil, one division), so two engines
    holding the same double always produce the same rounded double. Spark's
    ``round`` instead rounds the shortest decimal string of the double, which
    can break an exact tie the other way. Signed zeros are kept; NaN,
    infinities and values already integral at this scale pass through."""
    m = float(10 ** digits)
    y = c * F.lit(m)
    t = F.when(y >= 0, F.floor(y)).otherwise(F.ceil(y)).cast("double")
    r = F.when(F.abs(y - t) >= 0.5, t + F.signum(y)).otherwise(t)
    out = F.when(r == 0, F.lit(0.0) * F.signum(y)).otherwise(r / F.lit(m))
    big = F.isnan(c) | (F.abs(y) >= F.lit(float(1 << 52)))
    return F.when(c.isNull(), F.lit(None).cast("double")).when(big, c).otherwise(out)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (summation order differs between engines)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(round_half_away(F.col(f.name).cast("double"), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def right_closed_bins(c: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed intervals (e0,e1],(e1,e2],...; outside -> NULL.

    ``Bucketizer`` is left-closed, so a value equal to an inner edge would land
    one bin too high; this is the ``pd.cut`` rule."""
    if len(labels) != len(edges) - 1:
        raise ValueError("need len(edges)-1 labels")
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (c > F.lit(lo)) & (c <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr.otherwise(F.lit(None).cast("string"))


def label_map(c: Column, mapping: dict, dtype: str = "int") -> Column:
    """Map listed values to codes; anything else (and NULL) becomes NULL."""
    expr = None
    for k, v in mapping.items():
        cond = c == F.lit(k)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return expr.otherwise(F.lit(None)).cast(dtype)
