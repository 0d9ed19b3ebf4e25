"""Fitted preparation as Spark ML stages (X1, X5, S7) and exact stratified folds.

``TableImputer`` and ``TableEncoder`` are estimators: they fit on the rows they are given (the train split, or
a fold's training rows) and their models apply to any others, so they go into a ``Pipeline`` with a
classifier, are refitted in every fold of a cross-validation, and are saved and loaded with it.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasOutputCol
from pyspark.ml.tuning import CrossValidator
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader,
                             MLWritable, MLWriter)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trustframe.functions.exprs import safe_div
from trustframe.operators.clean import impute_values
from trustframe.operators.encode import EncoderModel, fit_encoder
from trustframe.operators.ranking import rank_segments


class _Columns(Params):
    """The columns a stage works on."""

    numericCols = Param(Params._dummy(), "numericCols", "numeric columns", TypeConverters.toListString)
    categoricalCols = Param(Params._dummy(), "categoricalCols", "categorical columns", TypeConverters.toListString)

    def __init__(self):
        super().__init__()
        self._setDefault(numericCols=[], categoricalCols=[])

    def numeric(self) -> list[str]:
        return self.getOrDefault(self.numericCols)

    def categorical(self) -> list[str]:
        return self.getOrDefault(self.categoricalCols)


class TableImputerModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Fills NULL and NaN with the fitted values; a column without one (all missing where it was fitted) stays as it is."""

    fills = Param(Params._dummy(), "fills", "column -> fill value, as JSON", TypeConverters.toString)

    def values(self) -> dict:
        return json.loads(self.getOrDefault(self.fills))

    def _transform(self, df: DataFrame) -> DataFrame:
        fills = self.values()
        out = []
        for f in df.schema.fields:
            c = F.col(f"`{f.name}`")
            if fills.get(f.name) is not None:
                if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
                    c = F.when(~F.isnan(c), c)
                c = F.coalesce(c, F.lit(fills[f.name]).cast(f.dataType)).alias(f.name)
            out.append(c)
        return df.select(*out)


class TableImputer(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """X1 fitted: exact median per numeric column, mode (ties: the smallest) per categorical one, of the rows given.
    Fit it on the train split and no other row has a say in the fill values."""

    @keyword_only
    def __init__(self, *, numericCols=None, categoricalCols=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> TableImputerModel:
        # one row per column
        rows = impute_values(df, self.numeric(), self.categorical()).collect()
        fills = {r["feature"]: r["fill_num"] if r["feature"] in self.numeric() else r["fill_str"] for r in rows}
        m = self._copyValues(TableImputerModel())
        return m._set(fills=json.dumps(fills))


class _EncoderWriter(MLWriter):
    def __init__(self, instance: "TableEncoderModel"):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.encoder.save(self.sparkSession, f"{path}/encoder")


class _EncoderReader(MLReader):
    def load(self, path: str) -> "TableEncoderModel":
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        m = TableEncoderModel(EncoderModel.load(self.sparkSession, f"{path}/encoder"))
        m._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(m, meta)
        return m


class TableEncoderModel(Model, _Columns, HasOutputCol, MLReadable, MLWritable):
    """Adds the feature vector; unseen categories encode as zeros."""

    def __init__(self, encoder: EncoderModel | None = None):
        super().__init__()
        self._setDefault(outputCol="features")
        self.encoder = encoder

    def _transform(self, df: DataFrame) -> DataFrame:
        keep = [F.col(f"`{c}`") for c in df.columns]
        return self.encoder.transform(df, keep=keep, output="vector").withColumnRenamed("features", self.getOutputCol())

    def write(self) -> MLWriter:
        return _EncoderWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _EncoderReader()


class TableEncoder(Estimator, _Columns, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Population-std scaling and drop-first one-hot, fitted on the rows given (``encode.fit_encoder``). A column
    with more than ``encode.MAX_LISTED`` categories has no dense vector and is refused when applied."""

    @keyword_only
    def __init__(self, *, numericCols=None, categoricalCols=None, outputCol="features"):
        super().__init__()
        self._setDefault(outputCol="features")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> TableEncoderModel:
        m = TableEncoderModel(fit_encoder(df, self.numeric(), self.categorical()))
        return self._copyValues(m)


def stratified_folds(df: DataFrame, strata: Sequence, id_col: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """Exact folds 0 .. k - 1 (int): every stratum's rows in seeded order (H2), fold i ends after floor(n (i + 1) / k) of
    them, so the sizes of a stratum's folds differ by one at most."""
    cuts = lambda n: [F.floor(n * (i + 1) / F.lit(k)).cast("long") for i in range(k - 1)]
    r = rank_segments(df, strata, id_col, seed, cuts, [str(i) for i in range(k)], out).drop("__n")
    return r.withColumn(out, F.col(out).cast("int"))


def fold_scores(df: DataFrame, estimator, fold: str, label: str, id_col: str) -> DataFrame:
    """Out-of-fold predictions: (``id_col``, ``label``, fold, prediction), every row scored by the ``estimator`` (a
    pipeline with its preparation) fitted on the other folds' rows alone. One fit per fold."""
    out = None
    # bounded by the number of folds
    for r in sorted(x[0] for x in df.select(fold).distinct().collect()):
        m = estimator.fit(df.where(F.col(fold) != r))
        s = m.transform(df.where(F.col(fold) == r)).select(id_col, label, fold, "prediction")
        out = s if out is None else out.unionByName(s)
    return out


def weighted_f1(scored: DataFrame, label: str, by: Sequence[str] = (), pred: str = "prediction") -> DataFrame:
    """Per group: n and f1_weighted, the mean of both classes' F1 weighed by their rows (labels 0 and 1)."""
    y, p = F.col(label) == 1, F.col(pred) == 1
    c = scored.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
                                F.count_if(~y & ~p).alias("tn"), F.count_if(y & ~p).alias("fn"))
    one = safe_div(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    none = safe_div(2 * F.col("tn"), 2 * F.col("tn") + F.col("fp") + F.col("fn"))
    pos = F.col("tp") + F.col("fn")
    return c.withColumn("f1_weighted", safe_div(one * pos + none * (F.col("n") - pos), F.col("n")))


def cross_validate_folds(df: DataFrame, estimator, grid, evaluator, fold: str, k: int, parallelism: int = 4):
    """Grid search on given folds (``foldCol``): the whole pipeline is refitted in each."""
    return CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator, numFolds=k, foldCol=fold,
                          parallelism=parallelism).fit(df)
