"""Cleaning: sentinels, label maps, bins, sparse rows, feature types, imputation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trustframe.functions.exprs import right_closed_bins
from trustframe.operators.stats import column_modes, distinct_small, exact_medians


class MissingColumnError(KeyError):
    pass


# Age bins (right-closed) and their labels.
AGE_EDGES = [0, 30, 40, 50, 100]
AGE_LABELS = ["<30", "30-40", "40-50", "50+"]


def require_columns(df: DataFrame, cols: Sequence[str], what: str = "feature") -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise MissingColumnError(f"{what} not found: {', '.join(missing)}")


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop listed columns when present (absent names are ignored)."""
    return df.drop(*[c for c in cols if c in df.columns])


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def sentinel_to_null(df: DataFrame, sentinel: str = "?", cols: Sequence[str] | None = None,
                     trim: bool = True) -> DataFrame:
    """Sentinel string -> NULL in every string column (optionally trimming the
    leading blanks a header-less CSV carries)."""
    cols = set(string_columns(df) if cols is None else cols)
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in cols:
            if trim:
                c = F.ltrim(c)
            c = F.nullif(c, F.lit(sentinel)).alias(f.name)
        out.append(c)
    return df.select(*out)


def add_bins(df: DataFrame, col: str, out: str, edges=AGE_EDGES, labels=AGE_LABELS) -> DataFrame:
    return df.withColumn(out, right_closed_bins(F.col(col), edges, labels))


def drop_sparse_rows(df: DataFrame, keep_fraction: float = 0.7) -> DataFrame:
    """Keep rows with at least int(keep_fraction * ncols) non-missing values
    (NaN counts as missing)."""
    k = int(keep_fraction * len(df.columns))
    return df.na.drop(thresh=k) if k > 0 else df


def missing_profile(df: DataFrame) -> DataFrame:
    """Per column: n_missing, missing_frac (one aggregate, then unpivot)."""
    n = F.count(F.lit(1))
    aggs = [n.alias("__n")]
    for f in df.schema.fields:
        c = F.col(f.name)
        miss = c.isNull()
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            miss = miss | F.isnan(c)
        aggs.append(F.count_if(miss).alias(f.name))
    wide = df.agg(*aggs)
    long = wide.unpivot(["__n"], df.columns, "feature", "n_missing")
    return long.select("feature", F.col("n_missing").cast("long").alias("n_missing"),
                       F.when(F.col("__n") > 0, F.col("n_missing") / F.col("__n"))
                       .otherwise(F.lit(0.0)).alias("missing_frac"))


def feature_types(df: DataFrame, cols: Sequence[str] | None = None, max_distinct: int = 10,
                  max_share: float = 0.05) -> DataFrame:
    """Categorical: string/bool columns, and numerics with distinct <= 10 and
    distinct < 5 % of rows; numerical otherwise. Output: column, dtype,
    n_distinct (exact when <= max_distinct, else NULL), kind."""
    spark = df.sparkSession
    cols = list(df.columns if cols is None else cols)
    n = df.count()
    nd = distinct_small(df, cols, cap=max_distinct)
    rows = []
    for c in cols:
        t = df.schema[c].dataType
        if isinstance(t, (T.StringType, T.BooleanType)):
            dtype, kind = ("bool" if isinstance(t, T.BooleanType) else "string"), "categorical"
        elif isinstance(t, T.NumericType):
            dtype = "numeric"
            k = nd[c]
            kind = "categorical" if (k is not None and k <= max_distinct and k < max_share * n) \
                else "numerical"
        else:
            dtype, kind = t.simpleString(), "other"
        rows.append((c, dtype, nd[c], kind))
    return spark.createDataFrame(rows, "feature string, dtype string, n_distinct long, kind string")


def impute_values(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                  empty_mode: str | None = None) -> DataFrame:
    """Fill values: numeric <- exact median, string <- mode (ties smallest).
    Output: feature, fill_num (numeric columns), fill_str (string columns)."""
    med = exact_medians(df, numeric).select(
        "feature", F.col("median").alias("fill_num"), F.lit(None).cast("string").alias("fill_str"))
    mod = column_modes(df, categorical, empty_mode).select(
        "feature", F.lit(None).cast("double").alias("fill_num"), F.col("mode").alias("fill_str"))
    return med.unionByName(mod)


def impute(df: DataFrame, numeric: Sequence[str] | None = None,
           categorical: Sequence[str] | None = None, empty_mode: str | None = None) -> DataFrame:
    """Numeric NULL/NaN <- median, string NULL <- mode. Like the
    reference, only columns that contain missing values are filled, so one
    missing-count pass decides which statistics are needed at all. The fill
    values are O(columns) and travel as literals."""
    numeric = numeric_columns(df) if numeric is None else list(numeric)
    categorical = string_columns(df) if categorical is None else list(categorical)
    wanted = numeric + categorical
    if wanted:
        prof = missing_profile(df.select(*wanted)).where("n_missing > 0").select("feature").collect()
        has = {r.feature for r in prof}  # O(columns)
        numeric = [c for c in numeric if c in has]
        categorical = [c for c in categorical if c in has]
    # O(columns) rows: one fill value per column
    fills = {r["feature"]: (r["fill_num"] if r["fill_str"] is None else r["fill_str"])
             for r in impute_values(df, numeric, categorical, empty_mode).collect()}
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        v = fills.get(f.name)
        if f.name in numeric and v is not None:
            base = F.when(F.isnan(c), F.lit(None)).otherwise(c) \
                if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else c
            c = F.coalesce(base, F.lit(float(v)).cast(f.dataType)).alias(f.name)
        elif f.name in categorical and v is not None:
            c = F.coalesce(c, F.lit(v)).alias(f.name)
        out.append(c)
    return df.select(*out)
