"""Group fairness: confusion counts per protected group, parity metrics,
threshold gates, verdicts and severity.

Plan shape: the row table is scanned once. Every protected attribute is
turned into an ``(attr, grp, priv)`` tag by a generator (``inline``), and a
single hash aggregate with conditional counts produces one row per
``(attr, grp)``; partial aggregation on the map side means a hot group costs
no more than a cold one. Everything after that works on a table with one row
per group value, so joins there are between tiny frames.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trustframe.functions.exprs import rate, safe_div


# Default gate bounds, as (metric, lower, upper) on the signed value.
# disparate impact in [0.8, 1.25]; |SPD|, |EOD|, |AOD| <= 0.1; demographic parity
# has a bound of 0.1 but is reported only (no gate by default).
DEFAULT_GATES = [
    ("disparate_impact", 0.8, 1.25),
    ("statistical_parity_difference", -0.1, 0.1),
    ("equal_opportunity_difference", -0.1, 0.1),
    ("average_odds_difference", -0.1, 0.1),
]
DEMOGRAPHIC_PARITY_GATE = ("demographic_parity", -0.1, 0.1)

# Severity bands, (band, DI lower, DI upper, |SPD| bound), mildest first.
SEVERITY_BANDS = [
    ("low", 0.75, 1.33, 0.15),
    ("medium", 0.67, 1.5, 0.2),
    ("high", 0.5, 2.0, 0.3),
]

# Dataset-specific overrides (dataset, metric, max_abs or (min, max)).
DATASET_GATES = [
    ("ibm_hr", "statistical_parity_difference", -0.15, 0.15),
    ("ibm_hr", "equal_opportunity_difference", -0.15, 0.15),
    ("adult", "disparate_impact", 0.8, 1.25),
    ("adult", "statistical_parity_difference", -0.1, 0.1),
    ("mimic", "statistical_parity_difference", -0.05, 0.05),
    ("mimic", "equal_opportunity_difference", -0.05, 0.05),
    ("mimic", "demographic_parity", -0.05, 0.05),
]

GATED_METRICS = ("disparate_impact", "statistical_parity_difference",
                 "equal_opportunity_difference", "average_odds_difference",
                 "demographic_parity")


@dataclass
class Protected:
    """A protected attribute.

    ``privileged`` lists privileged values; ``threshold`` marks numeric
    attributes where ``value >= threshold`` is privileged (the group label then
    becomes ``>=t`` / ``<t``). If neither is given the caller must resolve the
    privileged value first (see :func:`majority_groups`). ``unprivileged``
    optionally names the unprivileged values; rows with a value in neither
    list are then left out of this attribute's comparison."""
    name: str
    column: str | Column | None = None
    privileged: Sequence = field(default_factory=tuple)
    threshold: float | None = None
    unprivileged: Sequence | None = None

    def included(self) -> Column:
        if self.unprivileged is None:
            return F.lit(True)
        v = self.value()
        return F.coalesce(v.isin(list(self.privileged) + list(self.unprivileged)), F.lit(False))

    def value(self) -> Column:
        c = self.column if self.column is not None else self.name
        return F.col(c) if isinstance(c, str) else c

    def group(self) -> Column:
        v = self.value()
        if self.threshold is not None:
            t = _fmt(self.threshold)
            return F.when(v >= F.lit(self.threshold), F.lit(f">={t}")) \
                .when(v.isNotNull(), F.lit(f"<{t}")).cast("string")
        return v.cast("string")

    def is_priv(self) -> Column:
        v = self.value()
        if self.threshold is not None:
            return F.coalesce(v >= F.lit(self.threshold), F.lit(False))
        if not self.privileged:
            raise ValueError(f"no privileged values for {self.name}")
        return F.coalesce(v.isin(list(self.privileged)), F.lit(False))


def _fmt(x: float) -> str:
    return str(int(x)) if float(x).is_integer() else str(x)


def _tag(df: DataFrame, attrs: Sequence[Protected], label: Column, pred: Column) -> DataFrame:
    """One row per (input row, attribute): attr, grp, priv, y, p (ints)."""
    tags = F.array(*[F.struct(F.lit(a.name).alias("attr"), a.group().alias("grp"),
                              a.is_priv().alias("priv"), a.included().alias("inc"))
                     for a in attrs])
    t = df.select(F.inline(tags), label.cast("int").alias("y"), pred.cast("int").alias("p"))
    if any(a.unprivileged is not None for a in attrs):
        t = t.where(F.col("inc"))
    return t.drop("inc")


def group_confusion(df: DataFrame, attrs: Sequence[Protected], label: Column,
                    pred: Column) -> DataFrame:
    """Per (attr, grp): size, label/prediction positives, TP/FP/TN/FN and rates.

    Empty denominators give 0.0 (an empty group has TPR 0)."""
    t = _tag(df, attrs, label, pred)
    y1, p1 = F.col("y") == 1, F.col("p") == 1
    y0, p0 = F.col("y") == 0, F.col("p") == 0
    agg = t.groupBy("attr", "grp").agg(
        F.bool_or("priv").alias("priv"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(y1).alias("n_label_pos"),
        F.count_if(p1).alias("n_pred_pos"),
        F.count_if(y1 & p1).alias("tp"),
        F.count_if(y0 & p1).alias("fp"),
        F.count_if(y0 & p0).alias("tn"),
        F.count_if(y1 & p0).alias("fn"),
    )
    return with_rates(agg)


def with_rates(agg: DataFrame) -> DataFrame:
    c = F.col
    return agg.select(
        "*",
        rate(c("n_pred_pos"), c("n")).alias("selection_rate"),
        rate(c("n_label_pos"), c("n")).alias("base_rate"),
        rate(c("tp"), c("tp") + c("fn")).alias("tpr"),
        rate(c("fp"), c("fp") + c("tn")).alias("fpr"),
    )


_COUNTS = ("n", "n_label_pos", "n_pred_pos", "tp", "fp", "tn", "fn")
_RATES = {"selection_rate": ("n_pred_pos", ("n",)), "base_rate": ("n_label_pos", ("n",)),
          "tpr": ("tp", ("tp", "fn")), "fpr": ("fp", ("fp", "tn"))}


def _side_rates(sfx: str) -> dict:
    out = {}
    for name, (num, dens) in _RATES.items():
        den = F.col(f"{dens[0]}{sfx}")
        for d in dens[1:]:
            den = den + F.col(f"{d}{sfx}")
        out[name] = rate(F.col(f"{num}{sfx}"), den)
    return out


def parity_metrics(groups: DataFrame, mode: str = "pooled") -> DataFrame:
    """Parity metrics from :func:`group_confusion` output.

    ``pooled``: unprivileged = all non-privileged values together (one row per
    attribute, ``unpriv_group='*'``). ``pairwise``: one row per non-privileged
    value, each against the pooled privileged side. Sign: unprivileged minus
    privileged. DI is 0 when the privileged selection rate is 0.

    Both sides come from one pass over the per-group table (one row per
    group value), so the row table behind it is scanned once."""
    c = F.col
    priv_sum = [F.sum(F.when(c("priv"), c(k)).otherwise(F.lit(0))) for k in _COUNTS]
    if mode == "pooled":
        t = groups.groupBy("attr").agg(
            *[e.alias(f"{k}_p") for e, k in zip(priv_sum, _COUNTS)],
            *[F.sum(F.when(~c("priv"), c(k)).otherwise(F.lit(0))).alias(f"{k}_u")
              for k in _COUNTS]).withColumn("unpriv_group", F.lit("*"))
    elif mode == "pairwise":
        w = Window.partitionBy("attr")  # over the per-group table (one row per value)
        t = groups.select("attr", "priv", c("grp").alias("unpriv_group"),
                          *[c(k).alias(f"{k}_u") for k in _COUNTS],
                          *[e.over(w).alias(f"{k}_p") for e, k in zip(priv_sum, _COUNTS)]) \
            .where(~c("priv"))
    else:
        raise ValueError(f"mode must be pooled or pairwise, not {mode!r}")
    p, u = _side_rates("_p"), _side_rates("_u")
    spd = u["selection_rate"] - p["selection_rate"]
    return t.select(
        "attr", "unpriv_group", c("n_p").alias("n_priv"), c("n_u").alias("n_unpriv"),
        p["selection_rate"].alias("sr_priv"), u["selection_rate"].alias("sr_unpriv"),
        p["tpr"].alias("tpr_priv"), u["tpr"].alias("tpr_unpriv"),
        p["fpr"].alias("fpr_priv"), u["fpr"].alias("fpr_unpriv"),
        spd.alias("statistical_parity_difference"),
        safe_div(u["selection_rate"], p["selection_rate"]).alias("disparate_impact"),
        (u["tpr"] - p["tpr"]).alias("equal_opportunity_difference"),
        (((u["tpr"] - p["tpr"]) + (u["fpr"] - p["fpr"])) / 2).alias("average_odds_difference"),
        F.abs(spd).alias("demographic_parity"),
        F.abs(u["base_rate"] - p["base_rate"]).alias("dp_label"),
    )


def fairness_metrics(df: DataFrame, attrs: Sequence[Protected], label: Column, pred: Column,
                     mode: str = "pooled") -> DataFrame:
    return parity_metrics(group_confusion(df, attrs, label, pred), mode)


def gate_table(spark: SparkSession, gates: Iterable[tuple] | None = None,
               with_demographic_parity: bool = False) -> DataFrame:
    """Threshold table (metric, lo, hi). Accepts ``(metric, lo, hi)`` tuples or a
    mapping ``metric -> {'min','max'} | {'max_abs'} | [lo, hi] | float``."""
    rows = []
    src = DEFAULT_GATES + ([DEMOGRAPHIC_PARITY_GATE] if with_demographic_parity else []) \
        if gates is None else gates
    if isinstance(src, dict):
        for m, spec in src.items():
            rows.append((m, *_bounds(spec)))
    else:
        rows = [(m, float(lo), float(hi)) for m, lo, hi in src]
    return spark.createDataFrame(rows, "metric string, lo double, hi double")


def _bounds(spec) -> tuple[float, float]:
    if isinstance(spec, dict):
        if "max_abs" in spec:
            return -float(spec["max_abs"]), float(spec["max_abs"])
        return float(spec["min"]), float(spec["max"])
    if isinstance(spec, (list, tuple)):
        return float(spec[0]), float(spec[1])
    return -float(spec), float(spec)


def dataset_gates(spark: SparkSession, dataset: str,
                  with_demographic_parity: bool = True) -> DataFrame:
    """Defaults overridden by the dataset's own bounds (left join + coalesce)."""
    base = gate_table(spark, with_demographic_parity=with_demographic_parity)
    over = spark.createDataFrame([r for r in DATASET_GATES if r[0] == dataset] or
                                 [(dataset, "", 0.0, 0.0)],
                                 "dataset string, metric string, lo double, hi double") \
        .where(F.col("metric") != "").select("metric", F.col("lo").alias("lo_o"),
                                             F.col("hi").alias("hi_o"))
    return base.join(over, "metric", "left").select(
        "metric", F.coalesce("lo_o", "lo").alias("lo"), F.coalesce("hi_o", "hi").alias("hi"))


def apply_gates(metrics: DataFrame, gates: DataFrame,
                ids: Sequence[str] = ("attr", "unpriv_group")) -> DataFrame:
    """Long gate rows: attr, unpriv_group, metric, value, lo, hi, pass.
    A NULL or NaN metric fails its gate, and so does a gate on a metric that the
    table does not have."""
    numeric = {f.name for f in metrics.schema.fields if f.dataType.typeName() in
               ("double", "float", "long", "integer")}
    names = [m for m in metrics.columns if m in numeric and m not in ids]
    values = F.create_map(*[x for m in names for x in (F.lit(m), F.col(m).cast("double"))])
    # every gate meets every row, so a gate without a metric of that name has no value and fails;
    # the gates (one row per metric) travel as literals
    rows = [F.struct(F.lit(r["metric"]).alias("metric"), F.lit(r["lo"]).cast("double").alias("lo"),
                     F.lit(r["hi"]).cast("double").alias("hi")) for r in gates.collect()]
    every = F.array(*rows) if rows else F.array().cast("array<struct<metric:string,lo:double,hi:double>>")
    j = metrics.select(*ids, values.alias("__v"), F.inline(every)).select(
        *ids, "metric", F.try_element_at("__v", F.col("metric")).alias("value"), "lo", "hi")
    v = F.col("value")
    ok = v.isNotNull() & ~F.isnan(v) & (v >= F.col("lo")) & (v <= F.col("hi"))
    extra = [i for i in ids if i not in ("attr", "unpriv_group")]
    return j.select("attr", "unpriv_group", *extra, "metric", "value", "lo", "hi",
                    F.coalesce(ok, F.lit(False)).alias("pass"))


def verdict(gate_rows: DataFrame, by: Sequence[str] = ("attr",)) -> DataFrame:
    """Per key: overall pass and the sorted, comma-joined failed metric names."""
    failed = F.array_sort(F.array_distinct(
        F.collect_list(F.when(~F.col("pass"), F.col("metric")))))
    return gate_rows.groupBy(*by).agg(
        F.bool_and("pass").alias("overall_pass"),
        F.concat_ws(",", failed).alias("failed_metrics"),
        F.count_if(~F.col("pass")).alias("n_failed"),
    )


def run_gate(verdicts: DataFrame, attrs: Sequence[str]) -> DataFrame:
    """F12 + F16: one row for the run: overall_pass, n_failed_attrs. ``attrs`` are the
    attributes that the run was to evaluate; one without a verdict (no
    unprivileged rows, an error) counts as failed, and a run without any fails."""
    v = verdicts.groupBy("attr").agg(F.bool_and("overall_pass").alias("ok"))
    want = verdicts.sparkSession.createDataFrame([(a,) for a in attrs], "attr string")
    ok = F.coalesce("ok", F.lit(False))
    return want.join(v, "attr", "left").agg(
        F.coalesce(F.bool_and(ok), F.lit(False)).alias("overall_pass"), F.count_if(~ok).alias("n_failed_attrs"))


def severity(metrics: DataFrame, gates: DataFrame) -> DataFrame:
    """Highest severity band exceeded by DI or |SPD|; gate failed but no band
    exceeded -> ``minor``; all gates passed -> ``none``. ``gates`` is the
    threshold table; the metrics table is used once."""
    c = F.col
    keep = metrics.select("attr", "unpriv_group",
                          c("disparate_impact").alias("__di"),
                          c("statistical_parity_difference").alias("__spd"),
                          *[c(m) for m in GATED_METRICS if m in metrics.columns])
    g = apply_gates(keep, gates, ids=["attr", "unpriv_group", "__di", "__spd"])
    v = g.groupBy("attr", "unpriv_group").agg(
        F.first("__di").alias("disparate_impact"),
        F.first("__spd").alias("statistical_parity_difference"),
        F.bool_and("pass").alias("overall_pass"))
    di, spd = c("disparate_impact"), F.abs(c("statistical_parity_difference"))
    expr = None
    for band, lo, hi, s in reversed(SEVERITY_BANDS):
        cond = (di < F.lit(lo)) | (di > F.lit(hi)) | (spd > F.lit(s))
        expr = F.when(cond, F.lit(band)) if expr is None else expr.when(cond, F.lit(band))
    return v.select("attr", "unpriv_group", "disparate_impact", "statistical_parity_difference",
                    "overall_pass",
                    expr.when(~c("overall_pass"), F.lit("minor")).otherwise(F.lit("none"))
                    .alias("severity"))


def majority_groups(df: DataFrame, attrs: Sequence[str]) -> DataFrame:
    """Most frequent value per attribute (ties -> smallest value):
    attr, majority_group, n. One scan; counts per (attr, value) then a
    per-attribute ``min_by`` over the small count table."""
    tags = F.array(*[F.struct(F.lit(a).alias("attr"), F.col(a).cast("string").alias("grp"))
                     for a in attrs])
    counts = df.select(F.inline(tags)).where(F.col("grp").isNotNull()) \
        .groupBy("attr", "grp").agg(F.count(F.lit(1)).alias("n"))
    best = F.min_by(F.struct(F.col("grp"), F.col("n")), F.struct(-F.col("n"), F.col("grp")))
    return counts.groupBy("attr").agg(best.alias("b")) \
        .select("attr", F.col("b.grp").alias("majority_group"), F.col("b.n").alias("n"))


# Value patterns that mark a privileged group, in the order tried.
PRIVILEGED_PATTERNS = [
    ("male", ["male", "M", "1", "Male"]),
    ("female", ["female", "F", "0", "Female"]),
    ("white", ["white", "White", "Caucasian"]),
]


def detect_privileged(df: DataFrame, attr: str) -> DataFrame:
    """Privileged values of one attribute: the first pattern with any match in
    the data (all matching values), else the majority value.
    Output: attr, privileged (sorted array of strings), rule."""
    vals = df.select(F.col(attr).cast("string").alias("v")).where(F.col("v").isNotNull()) \
        .groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    cols = []
    for i, (name, pats) in enumerate(PRIVILEGED_PATTERNS):
        cols.append(F.array_sort(F.collect_set(F.when(F.col("v").isin(pats), F.col("v"))))
                    .alias(f"m{i}"))
    best = F.min_by(F.col("v"), F.struct(-F.col("n"), F.col("v")))
    agg = vals.agg(*cols, best.alias("maj"))
    pick, rule = None, None
    for i, (name, _) in enumerate(PRIVILEGED_PATTERNS):
        cond = F.size(F.col(f"m{i}")) > 0
        pick = F.when(cond, F.col(f"m{i}")) if pick is None else pick.when(cond, F.col(f"m{i}"))
        rule = F.when(cond, F.lit(name)) if rule is None else rule.when(cond, F.lit(name))
    return agg.select(F.lit(attr).alias("attr"),
                      pick.otherwise(F.array(F.col("maj"))).alias("privileged"),
                      rule.otherwise(F.lit("majority")).alias("rule"))


def report_lines(metrics: DataFrame, gate_rows: DataFrame) -> DataFrame:
    """Human-readable lines, one per (attr, unprivileged group, metric)."""
    return gate_rows.select(
        "attr", "unpriv_group", "metric",
        F.format_string("%s [%s] %s: %.4f (%s)", F.col("attr"), F.col("unpriv_group"),
                        F.col("metric"), F.col("value"),
                        F.when(F.col("pass"), F.lit("PASS")).otherwise(F.lit("FAIL")))
        .alias("line"))


def request_violations(df: DataFrame, metrics_col: str, bound: float = 0.1) -> DataFrame:
    """Request-level check: a row violates when any value of its metric map
    exceeds ``bound``."""
    return df.withColumn("violation",
                         F.exists(F.map_values(F.col(metrics_col)), lambda x: x > F.lit(bound)))
