"""Churn model: runs end to end on sf0.001; explanations add up; persistence works."""
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from usagelens.operators import ml
from usagelens.plans.catalog import tables


@pytest.fixture(scope="module")
def fitted(spark):
    feats = ml.prepare_ml_features(tables(spark, SF_SMALL)["user_metrics"]).persist()
    return feats, ml.train_churn_model(feats)


def test_scores_and_auc(fitted):
    feats, model = fitted
    scored = ml.score(model, feats)
    assert scored.count() == feats.count()
    auc = ml.roc_auc(scored).first()["auc"]
    assert 0.0 <= auc <= 1.0
    # brute-force AUC on the driver for this small fixture
    rows = scored.select("churn_flag", "churn_probability").collect()
    pos = [r[1] for r in rows if r[0] == 1]
    neg = [r[1] for r in rows if r[0] == 0]
    brute = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert auc == pytest.approx(brute, abs=1e-12)
    rep = {r["class"]: r for r in ml.classification_report(scored).collect()}
    assert set(rep) == {"0", "1", "accuracy", "macro avg", "weighted avg"}


def test_shap_adds_up_to_margin(fitted):
    feats, model = fitted
    shap = ml.linear_shap(model, feats)
    assert shap.count() == 6 * feats.count()
    tot = shap.groupBy("user_id").agg((F.sum("shap_value") + F.first("base_value")).alias("m"))
    prob = ml.score(model, feats).select("user_id", "churn_probability")
    j = tot.join(prob, "user_id").withColumn("p", 1 / (1 + F.exp(-F.col("m"))))
    worst = j.agg(F.max(F.abs(F.col("p") - F.col("churn_probability")))).first()[0]
    assert worst < 1e-9


def test_importance(fitted):
    feats, model = fitted
    imp = ml.feature_importance(model, feats, repeats=3)
    got = {r["feature"]: r for r in imp.collect()}
    assert set(got) == set(ml.FEATURES)
    assert all(r["permutation_importance"] is not None for r in got.values())
    assert ml.top_drivers(imp, 4).count() == 4
    lb = ml.leaderboard(ml.score(model, feats)).collect()
    assert len(lb) == 15 and lb[0]["churn_probability"] >= lb[-1]["churn_probability"]


def test_model_roundtrip(fitted, scratch):
    feats, model = fitted
    model.save(f"{scratch}/model", feats.sparkSession)
    back = ml.load_model(feats.sparkSession, f"{scratch}/model")
    a = ml.score(model, feats).orderBy("user_id").select("churn_probability").collect()
    b = ml.score(back, feats).orderBy("user_id").select("churn_probability").collect()
    assert a == b and back.backend == "logreg"
    sa = ml.linear_shap(model, feats).orderBy("user_id", "feature").select("shap_value").collect()
    sb = ml.linear_shap(back, feats).orderBy("user_id", "feature").select("shap_value").collect()
    assert sa == sb


def test_gbt_backend_runs(fitted):
    feats, _ = fitted
    model = ml.train_churn_model(feats, backend="gbt", rounds=5)
    assert model.backend == "gbt"
    assert ml.model_importance(model, feats).count() == 6
    assert ml.score(model, feats).where("churn_probability BETWEEN 0 AND 1").count() == feats.count()


def test_given_weights_score_like_the_fitted_model(fitted):
    feats, model = fitted
    w, b = model.weights
    given = ml.LinearModel(ml.scaler_stats(feats.repartition(3)), tuple(w), b)
    a = ml.score(model, feats).orderBy("user_id").select("churn_probability").toPandas()["churn_probability"]
    c = ml.score(given, feats).orderBy("user_id").select("churn_probability").toPandas()["churn_probability"]
    assert max(abs(a - c)) < 1e-12
    assert ml.accuracy(given, feats).first() == ml.accuracy(model, feats).first()


def test_given_weights_on_an_empty_table(fitted):
    feats, _ = fitted
    none = feats.where("false")
    given = ml.LinearModel(ml.scaler_stats(none), (1.0,) * 6)
    assert given.stats["n"] == 0 and given.stats["renewal_rate"] == (0.0, 1.0)
    assert ml.score(given, none).count() == 0 and ml.linear_shap(given, none).count() == 0


def test_importance_without_permutation(fitted, monkeypatch):
    feats, model = fitted

    def fails(*_):
        raise RuntimeError("no")

    monkeypatch.setattr(ml, "permutation_importance", fails)
    rows = ml.feature_importance(model, feats).collect()
    assert len(rows) == 6 and all(r["permutation_importance"] is None for r in rows)
    assert all(r["permutation_importance"] == 0 for r in ml.top_drivers(ml.feature_importance(model, feats)).collect())


def test_report_with_a_model(spark, fitted):
    from usagelens.operators import report
    feats, model = fitted
    frames = report.report(tables(spark, SF_SMALL), model=model, importance=ml.model_importance(model, feats))
    assert frames["leaderboard"].count() == 15 and frames["drivers"].count() == 6
    assert frames["explanations"].count() == 50 * 6
