"""CSV readers with explicit schemas and the dataset registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trustframe.functions.exprs import label_map
from trustframe.operators import clean
from trustframe.sources.sinks import path_exists


class DataLoaderError(RuntimeError):
    pass


# Column names of the header-less census file, in file order.
ADULT_COLUMNS = ["age", "workclass", "fnlwgt", "education", "education-num", "marital-status",
                 "occupation", "relationship", "race", "sex", "capital-gain", "capital-loss",
                 "hours-per-week", "native-country", "income"]
ADULT_NUMERIC = {"age", "fnlwgt", "education-num", "capital-gain", "capital-loss",
                 "hours-per-week"}
# Columns dropped per dataset.
HR_DROP = ["EmployeeCount", "EmployeeNumber", "StandardHours", "Over18"]
ADULT_DROP = ["fnlwgt"]
CLINICAL_DROP = ["subject_id", "hadm_id"]


def adult_schema() -> T.StructType:
    return T.StructType([T.StructField(c, T.DoubleType() if c in ADULT_NUMERIC else T.StringType())
                         for c in ADULT_COLUMNS])


def read_headered_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
                      target: str = "Attrition") -> DataFrame:
    """S1 (HR): headered CSV; target Yes/No -> 1/0, drops, impute, age bucket."""
    r = spark.read.option("header", True).option("mode", "PERMISSIVE")
    df = (r.schema(schema) if schema is not None else r.option("inferSchema", True)).csv(path)
    clean.require_columns(df, [target], "target column")
    df = clean.drop_columns(df, HR_DROP)
    df = clean.impute(df)
    if "Age" in df.columns:
        df = clean.add_bins(df, "Age", "AgeBucket")
    return df.withColumn(target, label_map(F.col(target), {"Yes": 1, "No": 0}))


def read_fixed_csv(spark: SparkSession, path: str) -> DataFrame:
    """S2 (census): no header, 15 fixed names, leading blanks trimmed, '?' is
    missing, label '>50K' -> 1 and '<=50K' -> 0."""
    df = spark.read.schema(adult_schema()).option("header", False) \
        .option("ignoreLeadingWhiteSpace", True).csv(path)
    df = clean.sentinel_to_null(df, "?")
    df = clean.drop_columns(df, ADULT_DROP)
    # features only, before the label is a number: a label outside the map stays missing
    df = clean.impute(df, numeric=[c for c in df.columns if c in ADULT_NUMERIC],
                      categorical=[c for c in clean.string_columns(df) if c != "income"])
    return df.withColumn("income", label_map(F.col("income"), {">50K": 1, "<=50K": 0}))


def read_required_csv(spark: SparkSession, path: str, target: str = "hospital_expire_flag",
                      schema: T.StructType | None = None) -> DataFrame:
    """S3 (clinical): typed error when the file is missing; sparse rows
    dropped; string columns that are entirely missing get 'Unknown'."""
    if not path_exists(spark, path):
        raise DataLoaderError(f"data file not found: {path}")
    r = spark.read.option("header", True)
    df = (r.schema(schema) if schema is not None else r.option("inferSchema", True)).csv(path)
    clean.require_columns(df, [target], "target column")
    df = clean.drop_columns(df, CLINICAL_DROP)
    df = clean.drop_sparse_rows(df, 0.7)
    return clean.impute(df, empty_mode="Unknown")


DATASETS: dict[str, Callable[..., DataFrame]] = {
    "ibm_hr": read_headered_csv,
    "adult": read_fixed_csv,
    "mimic": read_required_csv,
}


def load_dataset(spark: SparkSession, name: str, config: dict, apply_bias: bool = False,
                 bias_attr: str | None = None, bias_ratio=(0.6, 0.4), seed: int = 42,
                 id_col: str | None = None) -> DataFrame:
    """Reader chosen by name, path from ``config['data'][name]``; test
    tables are served as ``parquet:<name>``. Optional bias injection (M8)."""
    path = config.get("data", {}).get(name)
    if path is None:
        raise DataLoaderError(f"no path configured for dataset {name!r}")
    if name in DATASETS:
        df = DATASETS[name](spark, path)
    else:
        df = spark.read.parquet(path)
    if apply_bias:
        from trustframe.operators.sampling import inject_bias
        if bias_attr is None or id_col is None:
            raise DataLoaderError("bias injection needs bias_attr and id_col")
        df = inject_bias(df, bias_attr, id_col, bias_ratio, seed)
    return df
