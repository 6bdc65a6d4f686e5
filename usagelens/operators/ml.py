"""ML1-ML8: churn model, scores, evaluation, importances and explanations.

The models are fitted by aggregates over all rows (``logit``: Newton's method;
``boosting``: second-order trees); evaluation, permutation importance and
explanations are column expressions, joins and Arrow batches, so every step
is distributed. The only driver-side values are model parameters, histograms
of a fixed number of bins and per-feature statistics.
"""
from __future__ import annotations

import hashlib
import json
import logging
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.functions import attach, safe_div
from usagelens.functions.prefix import prefix_sums, row_numbers
from usagelens.operators.boosting import Explainer, Forest, boost
from usagelens.operators.logit import margin_of, newton_logit
from usagelens.session import ship, written
from usagelens.sources.schemas import FEATURE_COLUMNS

FEATURES = list(FEATURE_COLUMNS)
LABEL = "churn_flag"
log = logging.getLogger(__name__)


def prepare_ml_features(metrics: DataFrame) -> DataFrame:
    """ML1: ids + six numeric features (double) + integer label; nulls -> 0."""
    return metrics.select(
        "user_id", "plans",
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in FEATURES],
        F.coalesce(F.col(LABEL).cast("int"), F.lit(0)).alias(LABEL))


def scaler_table(features: DataFrame) -> DataFrame:
    """ML2: (feature, n, mean, sd) with the POPULATION sd; 0 or undefined -> 1. One aggregate, no shuffle of rows."""
    row = features.agg(F.count("*").alias("n"),
                       *[F.avg(c).alias(f"m_{c}") for c in FEATURES],
                       *[F.stddev_pop(c).alias(f"s_{c}") for c in FEATURES])
    parts = ", ".join(f"'{c}', n, m_{c}, s_{c}" for c in FEATURES)
    sd = F.col("sd")
    return row.select(F.expr(f"stack({len(FEATURES)}, {parts}) AS (feature, n, mean, sd)")).select(
        "feature", "n", F.coalesce("mean", F.lit(0.0)).alias("mean"),
        F.when((sd > 0) & (sd < float("inf")), sd).otherwise(1.0).alias("sd"))


def scaler_stats(features: DataFrame) -> dict:
    """The rows of :func:`scaler_table` as {feature: (mean, sd)}, with the row count under "n" (one small action)."""
    rows = scaler_table(features).collect()
    return {"n": rows[0]["n"]} | {r["feature"]: (r["mean"], r["sd"]) for r in rows}


def _scaled(stats: dict) -> list[str]:
    return [f"({c} - CAST('{m!r}' AS DOUBLE)) / CAST('{s!r}' AS DOUBLE) AS z_{c}"
            for c, (m, s) in ((c, stats[c]) for c in FEATURES)]


class _Model:
    """What both backends share: a margin gives the probability, and a positive one the prediction."""

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with margin, probability and prediction."""
        return (df.withColumn("margin", self.margin(df)).withColumn("probability", 1 / (1 + F.exp(-F.col("margin"))))
                .withColumn("prediction", (F.col("margin") > 0).cast("double")))

    def positive(self) -> Column:
        """Probability of churn in a transformed frame."""
        return F.col("probability")

    def save(self, path: str, spark: SparkSession) -> None:
        """IO12: persist the model as one JSON document."""
        spark.createDataFrame([(json.dumps(self.record()),)], "value string").coalesce(1).write.mode("overwrite").text(path)


@dataclass(frozen=True)
class LinearModel(_Model):
    """A logistic model: feature statistics, weights in the standardised space, intercept.

    It scores, explains and evaluates in column expressions only.
    """
    stats: dict
    coefficients: tuple
    intercept: float = 0.0
    backend: str = "logreg"

    @property
    def weights(self) -> tuple[list[float], float]:
        return list(self.coefficients), self.intercept

    def standardised(self, df: DataFrame) -> DataFrame:
        return df.selectExpr("*", *_scaled(self.stats))

    def _z(self, feature: str, column: Column) -> Column:
        mean, sd = self.stats[feature]
        return (column - F.lit(float(mean))) / F.lit(float(sd))

    def margin(self, df: DataFrame) -> Column:
        return margin_of([self._z(c, F.col(c)) for c in FEATURES], self.coefficients, self.intercept)

    def swapped_margins(self, margin: str, donor: dict[str, str]) -> Column:
        """Array of margins, one per feature, after that feature takes its donor's value: a difference per feature."""
        return F.array(*[F.col(margin) + F.lit(float(w)) * (self._z(c, F.col(donor[c])) - self._z(c, F.col(c)))
                         for w, c in zip(self.coefficients, FEATURES, strict=True)])

    def importances(self) -> list[float]:
        return list(self.coefficients)

    def record(self) -> dict:
        return {"backend": self.backend, "stats": self.stats, "coefficients": list(self.coefficients), "intercept": self.intercept}


@dataclass(frozen=True)
class TreeModel(_Model):
    """Boosted trees; margins and explanations are computed in Arrow batches."""
    forest: Forest
    stats: dict = field(default_factory=dict)
    backend: str = "gbt"

    def margin(self, df: DataFrame) -> Column:
        ship(df.sparkSession)
        forest = self.forest

        @F.pandas_udf("double")
        def margins(*columns: pd.Series) -> pd.Series:
            return pd.Series(forest.margin(np.column_stack([c.to_numpy(float) for c in columns])))

        return margins(*FEATURES)

    def swapped_margins(self, margin: str, donor: dict[str, str]) -> Column:
        """Array of margins, one per feature, after that feature takes its donor's value."""
        forest, width = self.forest, len(FEATURES)

        @F.pandas_udf("array<double>")
        def margins(*columns: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(float) for c in columns])
            out = []
            for f in range(width):
                own = x[:, :width].copy()
                own[:, f] = x[:, width + f]
                out.append(forest.margin(own))
            return pd.Series(list(np.column_stack(out)))

        return margins(*FEATURES, *[donor[c] for c in FEATURES])

    def importances(self) -> list[float]:
        return self.forest.importances()

    def record(self) -> dict:
        return {"backend": self.backend, "forest": self.forest.record()}


def load_model(spark: SparkSession, path: str) -> LinearModel | TreeModel:
    """IO12: a model that :meth:`_Model.save` has written."""
    record = json.loads(spark.read.text(path).first()["value"])
    if record["backend"] == "gbt":
        return TreeModel(Forest.of_record(record["forest"]))
    stats = {k: tuple(v) if isinstance(v, list) else v for k, v in record["stats"].items()}
    return LinearModel(stats, tuple(record["coefficients"]), record["intercept"])


def train_churn_model(features: DataFrame, backend: str = "logreg", rounds: int = 160, seed: int = 42,
                      stored: bool = False) -> LinearModel | TreeModel:
    """ML3 / ML3b: fit on all rows.

    logreg: features standardised with the population sd; minimises
    (|w|^2 + b^2) / 2 + sum of log-losses (C = 1; the intercept is penalised
    as in the source's solver) by Newton's method.
    gbt: second-order boosting on the raw features, depth 4, 160 rounds, step
    0.08, row and feature sampling 0.9, lambda 1.

    The result depends on data and arguments, not on the layout of the input.
    Eager: the features are written once, unless they are ``stored`` (a
    table already), then every pass reads that table.
    """
    ship(features.sparkSession)
    held = features if stored else written(features.select("user_id", *FEATURES, LABEL))
    if backend == "gbt":
        return TreeModel(boost(held, FEATURES, LABEL, "user_id", rounds=rounds, seed=seed))
    stats = scaler_stats(held)
    weights, intercept = newton_logit(held.selectExpr(LABEL, *_scaled(stats)), [f"z_{c}" for c in FEATURES], LABEL)
    return LinearModel(stats, tuple(weights), intercept)


def score(model: LinearModel | TreeModel, features: DataFrame) -> DataFrame:
    """ML4: the feature rows plus churn_probability (positive-class probability)."""
    return model.transform(features).select(
        *features.columns, model.positive().alias("churn_probability"))


def classification_report(scored: DataFrame, label: str = LABEL, score_col: str = "churn_probability",
                          threshold: float = 0.5) -> DataFrame:
    """ML5: per-class precision/recall/f1/support, accuracy, macro and weighted
    averages for ``score >= threshold``; zero denominators give 0."""
    y = F.col(label).cast("int")
    p = (F.col(score_col) >= threshold).cast("int")
    cnt = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("long")
    c = scored.agg(cnt((y == 1) & (p == 1)).alias("tp"), cnt((y == 0) & (p == 1)).alias("fp"),
                   cnt((y == 1) & (p == 0)).alias("fn"), cnt((y == 0) & (p == 0)).alias("tn"))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    m = c.select(
        safe_div(tp, tp + fp).alias("p1"), safe_div(tp, tp + fn).alias("r1"),
        safe_div(tn, tn + fn).alias("p0"), safe_div(tn, tn + fp).alias("r0"),
        (tp + fn).alias("s1"), (tn + fp).alias("s0"), (tp + fp + fn + tn).alias("n"),
        safe_div(tp + tn, tp + fp + fn + tn).alias("acc"))
    m = m.select("*", safe_div(2 * F.col("p1") * F.col("r1"), F.col("p1") + F.col("r1")).alias("f1"),
                 safe_div(2 * F.col("p0") * F.col("r0"), F.col("p0") + F.col("r0")).alias("f0"))
    return m.select(F.expr("""stack(5,
        '0', p0, r0, f0, s0,
        '1', p1, r1, f1, s1,
        'accuracy', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), acc, n,
        'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n,
        'weighted avg', try_divide(p0 * s0 + p1 * s1, n), try_divide(r0 * s0 + r1 * s1, n),
                        try_divide(f0 * s0 + f1 * s1, n), n
        ) AS (class, precision, recall, f1_score, support)"""))


def roc_auc(scored: DataFrame, label: str = LABEL, score_col: str = "churn_probability") -> DataFrame:
    """ML5 / W6: exact ROC AUC (ties count one half) as a one-row frame.

    Rows collapse to a histogram of distinct scores first; the negatives below
    each score are prefix sums over it (eager), so no task sees more than a
    range of distinct scores and the result is exact.
    """
    y = F.col(label).cast("int")
    hist = scored.groupBy(F.col(score_col).alias("s")).agg(
        F.sum(F.when(y == 1, 1).otherwise(0)).cast("long").alias("pos"),
        F.sum(F.when(y == 0, 1).otherwise(0)).cast("long").alias("neg"))
    dec = "decimal(38,0)"
    num = F.sum(F.col("pos").cast(dec) * (2 * F.col("below") + F.col("neg")).cast(dec))
    den = 2 * F.sum("pos").cast(dec) * F.sum("neg").cast(dec)
    return prefix_sums(hist, ["s"], {"below": "neg"}).agg(
        (num.cast("double") / F.when(den > 0, den.cast("double"))).alias("auc"))


def accuracy(model: LinearModel | TreeModel, features: DataFrame) -> DataFrame:
    """Default score of the classifier: mean of prediction == label (one row)."""
    return model.transform(features).agg(
        F.avg((F.col("prediction") == F.col(LABEL)).cast("double")).alias("accuracy"))


def _shifts(repeats: int, seed: int) -> list[int]:
    """One whole number of 48 bits per repeat, from md5 of ``seed:repeat``."""
    return [int(hashlib.md5(f"{seed}:{r}".encode()).hexdigest()[:12], 16) for r in range(repeats)]


def permutation_importance(model: LinearModel | TreeModel, features: DataFrame, repeats: int = 10, seed: int = 42) -> DataFrame:
    """ML6: mean accuracy drop when one feature's column is permuted.

    Rows are numbered in the order of md5(``seed:user_id``), which shuffles
    them; repeat r gives row i the feature value of row i + s_r, counted round
    in a circle, with s_r a seeded number from 1 to n - 1. One shuffle join
    of (n x repeats) requests against n donors; every joined row changes its
    own margin by the one feature's difference (linear model; trees are
    evaluated anew) and so scores all six variants at once. Eager: the
    numbered rows are checkpointed and counted.
    """
    order = [F.md5(F.concat(F.lit(f"{seed}:"), F.col("user_id").cast("string")).cast("binary")), F.col("user_id"), *[F.col(c) for c in FEATURES], F.col(LABEL)]
    scored = model.transform(features).select("user_id", *FEATURES, LABEL, "margin")
    idx = row_numbers(scored, order, "_idx")
    n = idx.count()
    steps = F.array(*[F.struct(F.lit(r).alias("r"), F.lit(1 + h % (n - 1) if n > 1 else 0).cast("long").alias("s"))
                      for r, h in enumerate(_shifts(repeats, seed))])
    asked = idx.select(*FEATURES, LABEL, "margin", "_idx", F.explode(steps).alias("m")).withColumn(
        "_donor", (F.col("_idx") + F.col("m.s")) % max(n, 1))
    donors = idx.select(F.col("_idx").alias("_donor"), *[F.col(c).alias(f"d_{c}") for c in FEATURES])
    swapped = asked.join(donors, "_donor").select(
        F.col("m.r").alias("r"), LABEL, model.swapped_margins("margin", {c: f"d_{c}" for c in FEATURES}).alias("margins"))
    right = [F.avg(((F.col("margins")[i] > 0).cast("int") == F.col(LABEL)).cast("double")).alias(c) for i, c in enumerate(FEATURES)]
    by_repeat = swapped.groupBy("r").agg(*right).agg(*[F.avg(c).alias(c) for c in FEATURES])
    parts = ", ".join(f"'{c}', {c}" for c in FEATURES)
    mean = by_repeat.select(F.expr(f"stack({len(FEATURES)}, {parts}) AS (feature, acc)"))
    base = idx.agg(F.avg(((F.col("margin") > 0).cast("int") == F.col(LABEL)).cast("double")).alias("accuracy"))
    return attach(mean, base).select("feature", (F.col("accuracy") - F.col("acc")).alias("permutation_importance"))


def model_importance(model: LinearModel | TreeModel, features: DataFrame) -> DataFrame:
    """ML8: coefficients (logreg, signed) or mean split gains as shares (gbt) per feature."""
    return features.sparkSession.createDataFrame([(f, float(v)) for f, v in zip(FEATURES, model.importances(), strict=True)],
                                                 "feature string, model_importance double")


def feature_importance(model: LinearModel | TreeModel, features: DataFrame, repeats: int = 10,
                       seed: int = 42) -> DataFrame:
    """Model and permutation importance side by side (full join on feature).

    If the permutation cannot be set up, the failure is logged and its column is null.
    """
    of_model = model_importance(model, features)
    try:
        permuted = permutation_importance(model, features, repeats, seed)
    except Exception:
        log.exception("no permutation importance")
        permuted = of_model.select("feature", F.lit(None).cast("double").alias("permutation_importance"))
    return of_model.join(permuted, "feature", "full").orderBy(F.desc(F.abs("model_importance")), "feature")


def top_drivers(importance: DataFrame, k: int = 8) -> DataFrame:
    """K features with the largest |model_importance| (nulls -> 0)."""
    imp = importance.na.fill(0.0, [c for c in ("model_importance", "permutation_importance")
                                   if c in importance.columns])
    return imp.orderBy(F.desc(F.abs("model_importance")), "feature").limit(k)


def leaderboard(scored: DataFrame, k: int = 15) -> DataFrame:
    """The k users most likely to churn."""
    return (scored.orderBy(F.desc("churn_probability"), F.asc("user_id")).limit(k)
            .select("user_id", "churn_probability", "plans", "payments_total", "sessions_total"))


def linear_shap(model: LinearModel, features: DataFrame) -> DataFrame:
    """ML7: exact SHAP values of the linear model, for every user at once.

    In the standardised space the model margin is b + sum w_f z_f, so the
    value of feature f is w_f (z_f - mean z_f) against the all-rows
    background, and the values plus base_value (b + sum w_f mean z_f) add up
    to the margin. Output is long: (user_id, feature, shap_value, base_value).
    """
    w, b = model.weights
    z = model.standardised(features)
    zm = z.agg(*[F.avg(f"z_{c}").alias(f"zm_{c}") for c in FEATURES])
    j = attach(z, zm)
    base = F.lit(b)
    for wi, c in zip(w, FEATURES):
        base = base + F.lit(wi) * F.col(f"zm_{c}")
    return _long_shap(j, base, [F.lit(wi) * (F.col(f"z_{c}") - F.col(f"zm_{c}")) for wi, c in zip(w, FEATURES)])


def tree_shap(model: TreeModel, features: DataFrame) -> DataFrame:
    """ML7 for trees: exact Shapley values of the margin, a feature outside a coalition following both branches by cover.

    Same rows as :func:`linear_shap`; values plus base_value add up to the margin.
    """
    ship(features.sparkSession)
    forest, base = model.forest, Explainer(model.forest).base

    @F.pandas_udf("array<double>")
    def values(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        explainer = Explainer(forest)
        for columns in batches:
            yield pd.Series(list(explainer.values(np.column_stack([c.to_numpy(float) for c in columns]))))

    held = features.withColumn("shap", values(*FEATURES))
    return _long_shap(held, F.lit(float(base)), [F.col("shap")[i] for i in range(len(FEATURES))])


def _long_shap(df: DataFrame, base: Column, values: list[Column]) -> DataFrame:
    parts = ", ".join(f"'{c}', shap_{c}" for c in FEATURES)
    return (df.select("user_id", base.alias("base_value"), *[v.alias(f"shap_{c}") for c, v in zip(FEATURES, values, strict=True)])
            .select("user_id", "base_value", F.expr(f"stack({len(FEATURES)}, {parts}) AS (feature, shap_value)"))
            .select("user_id", "feature", "shap_value", "base_value"))


def shap_values(model: LinearModel | TreeModel, features: DataFrame) -> DataFrame:
    """ML7: explanations of every user, by either backend."""
    return tree_shap(model, features) if model.backend == "gbt" else linear_shap(model, features)


def explain_top(scored: DataFrame, shap: DataFrame, k: int = 50) -> DataFrame:
    """Explanations of the k riskiest users, with their probability."""
    top = scored.orderBy(F.desc("churn_probability"), F.asc("user_id")).limit(k) \
        .select("user_id", "churn_probability")
    return shap.join(top, "user_id")
