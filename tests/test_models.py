"""Model operators: quantile coverage, loss against a constant quantile,
fold invariants, attribution efficiency, streaming parity."""

import random

import pytest
from pyspark.sql import functions as F

from stationcast.ml import explain as EX
from stationcast.ml import folds as FO
from stationcast.ml.boosting import QuantileGBT, pinball


@pytest.fixture(scope="module")
def synth(spark):
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        x = rng.uniform(0, 10)
        z = rng.uniform(-1, 1)
        y = 2 * x + rng.gauss(0, 1 + 0.3 * x)
        rows.append((i, x, z, y, i % 5 == 0))
    return spark.createDataFrame(rows, "row_id int, x double, z double, y double, is_test boolean")


def test_quantile_coverage_and_loss(synth):
    train, test = synth.filter(~F.col("is_test")), synth.filter(F.col("is_test"))
    alpha = 0.9
    model = QuantileGBT(["x", "z"], "y", alpha=alpha, max_depth=3, learning_rate=0.3, n_estimators=15,
                        early_stopping=50).fit(train, test)
    scored = model.transform(test, "q")
    cov = scored.agg(F.avg((F.col("y") <= F.col("q")).cast("double"))).first()[0]
    assert abs(cov - alpha) < 0.05
    const = train.select(F.percentile_approx("y", alpha)).first()[0]
    loss = scored.agg(F.avg(pinball(F.col("y"), F.col("q"), alpha))).first()[0]
    loss0 = test.agg(F.avg(pinball(F.col("y"), F.lit(const), alpha))).first()[0]
    assert loss < loss0
    imp = model.gain_importance()
    assert imp["x"] > imp["z"]


def test_blocks_and_one_block_give_the_same_models(spark, synth):
    """Keys whose rows lie in one block, and in many whose counts Spark sums: equal number for number."""
    from stationcast.ml.boosting import fit_models
    from stationcast.ml.histograms import Settings, State
    df = synth.withColumn("site", F.when(F.col("row_id") % 3 == 0, "a").when(F.col("row_id") % 3 == 1, F.lit(None)).otherwise("c"))
    df = df.where("site is null or site <> 'c' or row_id < 90")
    for kw in ({"alpha": 0.9, "subsample": 0.6, "colsample": 0.5}, {"squared": True, "parallel_trees": 2}):
        s = Settings(max_depth=3, n_estimators=2, learning_rate=0.3, seed=4, **kw)
        got = []
        for rows in (100_000, 400):
            got.append({r["site"]: r for r in fit_models(df, ["site"], ["x", "z"], "y", "is_test", s, max_rows=rows).collect()})
        assert set(got[0]) == set(got[1]) == {"a", None, "c"}
        for k in got[0]:
            one, many = got[0][k], got[1][k]
            assert all(one[c] == many[c] for c in ("n_train", "n_test", "rounds", "error", "edges"))
            assert one["pinball"] == pytest.approx(many["pinball"], rel=1e-12)
            a, b = State.from_bytes(one["body"]), State.from_bytes(many["body"])
            assert a.base == b.base and a.errors == b.errors and len(a.trees) == len(b.trees)
            for t, u in zip(a.trees, b.trees):
                assert all((getattr(t, c) == getattr(u, c)).all() for c in ("feature", "bin", "left", "value", "gain", "cover"))


def test_models_of_keys_equal_single_fits(spark, synth):
    """All keys in one set of jobs; each as if fitted alone."""
    from stationcast.ml.fanout import fit_per_key
    df = synth.withColumn("site", F.col("row_id") % 50).withColumn("is_test", F.col("row_id") % 4 == 0)
    gbt = dict(max_depth=3, learning_rate=0.3, n_estimators=5)
    got = {r.site: r for r in fit_per_key(df, ["site"], ["x", "z"], "y", alpha=0.8, **gbt).collect()}
    assert len(got) == 50
    for site in (0, 17, 49):
        part = df.where(F.col("site") == site)
        model = QuantileGBT(["x", "z"], "y", alpha=0.8, **gbt).fit(part.where("not is_test"), part.where("is_test"))
        scored = model.transform(part.where("is_test"), "q")
        m = scored.agg(F.avg(pinball(F.col("y"), F.col("q"), 0.8)).alias("p"), F.avg(F.abs(F.col("y") - F.col("q"))).alias("a")).first()
        assert got[site].rounds == len(model.trees) and got[site].n_train == part.where("not is_test").count()
        if m["p"] is not None:
            assert got[site].pinball == pytest.approx(m["p"]) and got[site].mae == pytest.approx(m["a"])
    assert fit_per_key(df.limit(0), ["site"], ["x", "z"], "y").count() == 0


def test_halving_keeps_what_a_whole_run_gives(synth):
    """A trial that stays to the end is the model of an uninterrupted run; the others end early."""
    from stationcast.ml import search as SE
    train, test = synth.filter(~F.col("is_test")), synth.filter(F.col("is_test"))
    space = {"max_depth": (2, 4), "subsample": (0.5, 1.0), "learning_rate": (0.1, 0.5), "colsample": (0.5, 1.0), "n_estimators": (18, 20)}
    halved = {r.trial: r for r in SE.param_search(train, test, ["x", "z"], "y", 0.5, n_trials=6, space=space, first_rung=3, keep=2).collect()}
    whole = {r.trial: r for r in SE.param_search(train, test, ["x", "z"], "y", 0.5, n_trials=6, space=space, keep=1).collect()}
    assert sorted(halved) == sorted(whole) == list(range(6))
    best = min(halved.values(), key=lambda r: (r.best_mae, r.trial))
    assert best.boosted == best.n_estimators and best.best_mae == whole[best.trial].best_mae and best.rounds == whole[best.trial].rounds
    assert sorted(r.boosted for r in halved.values())[:3] == [3, 3, 3] and all(r.best_mae >= whole[t].best_mae for t, r in halved.items())


def test_null_features_score_null(spark, synth):
    model = QuantileGBT(["x", "z"], "y", n_estimators=2).fit(synth)
    df = spark.createDataFrame([(1.0, None), (1.0, 0.0)], "x double, z double")
    out = [r.q for r in model.transform(df, "q").collect()]
    assert out[0] is None and out[1] is not None


def test_year_folds_disjoint_and_exhaustive(spark):
    import datetime as dt
    df = spark.createDataFrame([("s", dt.date(y, 1, 1)) for y in range(1995, 2008)] + [("t", dt.date(2000, 1, 1))],
                               "site string, date date")
    f = FO.year_folds(df, k=5, seed=1, keys=["site"]).collect()
    s = [r for r in f if r.site == "s"]
    assert sorted(r.year for r in s) == list(range(1995, 2008))
    sizes = {}
    for r in s:
        sizes[r.fold] = sizes.get(r.fold, 0) + 1
    assert set(sizes) == set(range(5)) and max(sizes.values()) - min(sizes.values()) <= 1


def test_attribution_sums_to_the_prediction(synth):
    model = QuantileGBT(["x", "z"], "y", n_estimators=4, max_depth=6).fit(synth)
    rows = synth.filter("row_id < 200").withColumn("z", F.when(F.col("row_id") % 10 > 0, F.col("z")))
    attr = EX.attribution(model, rows, "row_id")
    total = {r.row_id: r.s for r in attr.groupBy("row_id").agg(F.sum("attribution").alias("s")).collect()}
    fx = {r.row_id: r.fx for r in model.transform(rows, "fx").select("row_id", "fx").collect()}
    mean = EX.expectation(model)
    assert set(total) == {k for k, v in fx.items() if v is not None} and len(total) == 180
    for k, s in total.items():
        assert s == pytest.approx(fx[k] - mean, abs=1e-9)


def test_attribution_equals_all_feature_subsets():
    """Path-dependent Shapley values against the sum over all subsets of up to 6 features."""
    import itertools
    from math import factorial
    import numpy as np
    from stationcast.ml import histograms as H
    from stationcast.ml.boosting import NodeArrays, QuantileGBTModel
    rng = np.random.default_rng(2)
    for width in (1, 3, 6):
        x = rng.uniform(0, 1, (400, width))
        y = x @ np.arange(1, width + 1) + np.sin(9 * x[:, 0]) * x[:, -1] + rng.normal(0, 0.1, 400)
        edges = [np.unique(np.sort(c)[H.edges_at(400)]) for c in x.T]
        block = H.Block(np.column_stack([H.to_bins(c, e) for c, e in zip(x.T, edges)]), y, rng.integers(0, 1 << 62, 400).astype(np.uint64), np.zeros(400, bool))
        s = H.Settings(alpha=0.7, max_depth=7, n_estimators=3, learning_rate=0.5, seed=width)
        model = QuantileGBTModel.of(H.advance(block, s), edges, [f"f{j}" for j in range(width)], s)

        def known(tree: NodeArrays, row, subset, at=0):
            f = tree.feature[at]
            if f < 0:
                return tree.value[at]
            left, right = tree.left[at], tree.left[at] + 1
            if f in subset:
                return known(tree, row, subset, left if row[f] <= tree.threshold[at] else right)
            return sum(tree.cover[c] * known(tree, row, subset, c) for c in (left, right)) / tree.cover[at]
        got = EX.shapley_values(model, x[:4])
        for row, values in zip(x, got):
            f = {sub: sum(s.learning_rate * known(t, row, sub) for t in model.trees) for k in range(width + 1) for sub in itertools.combinations(range(width), k)}
            for j in range(width):
                expected = sum(factorial(len(sub)) * factorial(width - len(sub) - 1) / factorial(width) * (f[tuple(sorted((*sub, j)))] - v) for sub, v in f.items() if j not in sub)
                assert values[j] == pytest.approx(expected, abs=1e-9)
        assert EX.expectation(model) == pytest.approx(model.base + f[()])


def test_saved_model_scores_the_same(spark, synth, tmp_path):
    from stationcast.ml.boosting import QuantileGBTModel
    model = QuantileGBT(["x", "z"], "y", alpha=0.9, n_estimators=4, max_depth=12, colsample=0.5, seed=2).fit(synth, synth)
    again = QuantileGBTModel.load(spark, model.save(spark, str(tmp_path / "model")))
    rows = [(r.a, r.b) for r in again.transform(model.transform(synth, "a"), "b").select("a", "b").collect()]
    assert all(a == b for a, b in rows) and again.gain_importance() == model.gain_importance()
    assert again.history == model.history


def test_array_trees_equal_the_fitted_path(synth):
    """The running prediction of the fit and the finished model agree."""
    model = QuantileGBT(["x", "z"], "y", alpha=0.9, n_estimators=3, max_depth=11).fit(synth, synth)
    mae = model.transform(synth, "q").agg(F.avg(F.abs(F.col("y") - F.col("q")))).first()[0]
    assert abs(mae - model.history[len(model.trees) - 1][1]) < 1e-9


def test_scenario_scoring_outputs(spark):
    import datetime as dt
    from stationcast.ml import scoring as SC
    rows = [("s", dt.date(2020, 1, 1) + dt.timedelta(days=k), float(k % 17), 300.0 + k % 5, float(k % 17) - 8) for k in range(300)]
    df = spark.createDataFrame(rows, "site string, date date, p double, t double, y double")
    model = QuantileGBT(["p"], "y", alpha=0.5, n_estimators=3).fit(df)
    out = SC.score_scenario(model, df, "t", predictand="tx", observed="y", unit_rule="K_to_C", clamp_zero=True, convert_output=lambda c: c * 2)
    assert out.columns == ["site", "date", "observed", "predicted", "negative", "tx_mean", "tx_max", "tx_min"]
    got = out.collect()
    assert len(got) == 300 and all(r.predicted >= 0 for r in got) and any(r.negative for r in got)
    assert {round(r.tx_max, 2) for r in got} == {30.85}
    with pytest.raises(ValueError, match="missing required features"):
        SC.score_scenario(model, df.drop("p"), "t")


def test_fold_search_fit_score_hand_over(spark):
    """M2 -> M3 -> M5 -> M4 -> save -> M6 -> A18: each step takes what the one before gives."""
    import datetime as dt
    from stationcast.ml import scoring as SC
    from stationcast.ml import search as SE
    from stationcast.operators import quality as Q
    rng = random.Random(6)
    rows = [("s", dt.date(y, 1 + m, 1 + d), float(m), rng.random()) for y in range(2000, 2010) for m in range(12) for d in range(0, 28, 3)]
    df = spark.createDataFrame([(s, d, m, x, 3 * m + x) for s, d, m, x in rows], "site string, date date, m double, x double, y double")
    feats = ["m", "x"]
    folds = FO.with_folds(df, FO.year_folds(df, k=5, seed=3))
    split = FO.best_split(folds, feats, "y", max_iter=8, max_depth=3, learning_rate=0.3, subsample=0.8, parallel_trees=2).filter("best").first()
    assert sorted(split.train_years + split.test_years) == list(range(2000, 2010)) and len(split.test_years) == 2
    data = FO.split_years(df, split.test_years)
    train, test = data.filter("not is_test"), data.filter("is_test")
    trials = SE.param_search(train, test, feats, "y", 0.5, n_trials=2,
                             space={"max_depth": (3, 4), "subsample": (0.9, 1.0), "learning_rate": (0.4, 0.5), "colsample": (0.9, 1.0), "n_estimators": (6, 8)})
    model = SE.best_model(trials, train, feats, "y", test)
    scores = Q.score(SC.score_batch(model, test, ["site", "date"], observed="y"), ["site"]).first()
    assert scores is not None and model.history[len(model.trees) - 1][1] < 3


def test_shift_rows_of_a_hot_series(spark):
    from stationcast.operators.windows import shift_rows
    df = spark.range(0, 5000, numPartitions=4).select(F.when(F.col("id") % 10 < 7, "hot").otherwise(F.col("id").cast("string")).alias("site"),
                                                      F.col("id").alias("date"), (F.col("id") * 2.0).alias("v"))
    got = {(r.site, r.date): r.v_lag for r in shift_rows(df, ["v"]).collect()}
    hot = sorted(d for s, d in got if s == "hot")
    assert len(got) == 5000 and got["hot", hot[0]] is None and all(got["hot", b] == 2.0 * a for a, b in zip(hot, hot[1:]))


def test_written_keys_split_and_complete(spark, tmp_path):
    from stationcast.sources.readers import write_keyed
    df = spark.range(0, 20_000, numPartitions=8).select(F.when(F.col("id") % 3 > 0, "a").otherwise("b").alias("site"), F.col("id").alias("v"))
    back = spark.read.parquet(write_keyed(df, str(tmp_path / "w"), ["site"]))
    assert {r.site: r["count"] for r in back.groupBy("site").count().collect()} == {"a": 13_333, "b": 6_667}
