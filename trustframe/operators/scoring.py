"""Scoring (L8, L9, L11, L12): linear scorers as column arithmetic, Spark ML
models through ``transform``, softmax/argmax with higher-order array
functions, soft voting by grouping a long score table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from typing import Iterator, Tuple

import pandas as pd
from pyspark.sql.functions import pandas_udf

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def linear_margin(coef: Mapping[str, float], intercept: float) -> Column:
    m = F.lit(float(intercept))
    for c, b in coef.items():
        m = m + F.lit(float(b)) * F.col(c).cast("double")
    return m


def sigmoid(m: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-m))


def score_linear(df: DataFrame, coef: Mapping[str, float], intercept: float, keep: Sequence[str],
                 version: str, as_of: datetime, threshold: float = 0.5) -> DataFrame:
    """Batch scoring: prediction, probability of class 1, confidence = max
    class probability, model version and a scoring timestamp (a parameter, so
    reruns reproduce)."""
    p = sigmoid(linear_margin(coef, intercept))
    s = df.select(*keep, p.alias("probability"))
    return s.select(*keep, (F.col("probability") >= threshold).cast("int").alias("prediction"),
                    "probability",
                    F.greatest(F.col("probability"), 1 - F.col("probability")).alias("confidence"),
                    F.lit(version).alias("model_version"),
                    F.lit(as_of).cast("timestamp").alias("scored_at"))


def score_model(df: DataFrame, model, keep: Sequence[str], version: str, as_of: datetime,
                features: str = "features") -> DataFrame:
    """Same record from a fitted Spark ML classifier (probability vector ->
    array via ``vector_to_array``)."""
    from pyspark.ml.functions import vector_to_array
    out = model.transform(df)
    prob = vector_to_array(F.col(model.getProbabilityCol()))
    return out.select(*keep, F.col(model.getPredictionCol()).cast("int").alias("prediction"),
                      prob[1].alias("probability"), F.array_max(prob).alias("confidence"),
                      F.lit(version).alias("model_version"),
                      F.lit(as_of).cast("timestamp").alias("scored_at"))


def softmax(scores: Column) -> Column:
    """Numerically safe softmax over an array column."""
    mx = F.array_max(scores)
    ex = F.transform(scores, lambda x: F.exp(x - mx))
    tot = F.aggregate(ex, F.lit(0.0), lambda a, x: a + x)
    return F.transform(ex, lambda x: x / tot)


def class_prediction(df: DataFrame, scores: str, keep: Sequence[str]) -> DataFrame:
    """Probabilities, argmax class (0-based, first max wins), confidence."""
    p = softmax(F.col(scores))
    s = df.select(*keep, p.alias("probs"))
    return s.select(*keep, "probs",
                    (F.array_position(F.col("probs"), F.array_max("probs")) - 1).cast("int")
                    .alias("predicted_class"),
                    F.array_max("probs").alias("confidence"))


def soft_vote(long_scores: DataFrame, id_col: str, prob: str = "probability",
              threshold: float = 0.5) -> DataFrame:
    """Mean class-1 probability over models per row, then the vote."""
    return long_scores.groupBy(id_col).agg(F.avg(prob).alias("probability"),
                                           F.count(F.lit(1)).alias("n_models")) \
        .withColumn("prediction", (F.col("probability") >= threshold).cast("int"))


class LinearProbabilityModel:
    """A plain-Python model with ``predict_proba`` (the duck type the
    reference accepts from users), used to exercise foreign-model scoring."""

    def __init__(self, coef, intercept: float):
        self.coef = [float(c) for c in coef]
        self.intercept = float(intercept)

    def predict_proba(self, x):
        import numpy as np
        m = np.full(len(x), self.intercept)
        for j, b in enumerate(self.coef):
            m = m + b * np.asarray(x[:, j], dtype=float)
        p1 = 1.0 / (1.0 + np.exp(-m))
        return np.stack([1.0 - p1, p1], axis=1)


def score_python_model(df: DataFrame, model, features: Sequence[str], keep: Sequence[str],
                       version: str, as_of: datetime, threshold: float = 0.5) -> DataFrame:
    """L8 for a foreign Python model (anything with ``predict_proba``): the
    model is broadcast once per executor and applied per Arrow batch by an
    iterator pandas UDF; the record matches :func:`score_linear`."""
    bc = df.sparkSession.sparkContext.broadcast(model)
    n = len(features)

    @pandas_udf("double")
    def p1(batches: Iterator[Tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        import numpy as np
        m = bc.value  # deserialised once per Python worker
        for cols in batches:
            cols = cols if isinstance(cols, tuple) else (cols,)
            x = np.column_stack([c.to_numpy(dtype=float) for c in cols]) if n else np.zeros((0, 0))
            yield pd.Series(m.predict_proba(x)[:, 1])

    s = df.select(*keep, p1(*[F.col(c).cast("double") for c in features]).alias("probability"))
    return s.select(*keep, (F.col("probability") >= threshold).cast("int").alias("prediction"),
                    "probability",
                    F.greatest(F.col("probability"), 1 - F.col("probability")).alias("confidence"),
                    F.lit(version).alias("model_version"),
                    F.lit(as_of).cast("timestamp").alias("scored_at"))
