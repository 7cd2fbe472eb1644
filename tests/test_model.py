import numpy as np
import pytest
from pyspark.sql import functions as F

from affinia import schemas as S
from affinia.operators import factorize, metrics, recommend, scoring, similar, splitting
from affinia.plans import batch
from affinia.settings import ENGINE_DEFAULTS, SMALL_DEFAULTS, Preset
from affinia.sources import models
from tests.conftest import tuples

RANK, REG = 3, 0.001


@pytest.fixture(scope="module")
def planted(spark):
    """Ratings that are inner products of hidden factors, 40 % of them observed."""
    draw = np.random.default_rng(7)
    users, items = draw.uniform(0.3, 1.2, (200, RANK)), draw.uniform(0.3, 1.2, (150, RANK))
    observed = np.argwhere(draw.random((200, 150)) < 0.4)
    rows = [(int(u), int(i), float(users[u] @ items[i]), 1) for u, i in observed]
    ratings = spark.createDataFrame(rows, S.RATINGS).repartition(4).persist()
    yield ratings
    ratings.unpersist()


@pytest.fixture(scope="module")
def catalog(spark):
    return spark.createDataFrame([(i, f"title {i}", "A|B") for i in range(150)], S.CATALOG)


@pytest.fixture(scope="module")
def fitted(planted):
    train, test = splitting.split_holdout(planted)
    return factorize.fit(train, RANK, 15, REG, blocks=4), train, test


def test_planted_factors_are_found(fitted):
    model, _, test = fitted
    found = factorize.evaluate(model, test).first()
    assert found["rmse"] < 0.02
    assert found["mae"] < 0.02
    assert found["n_scored"] == found["n_total"] == test.count()


def test_users_solve_their_least_squares(fitted):
    model, train, _ = fitted
    gaps = metrics.least_squares_gap(train, model.userFactors, model.itemFactors, REG, RANK)
    assert gaps.count() == 200
    assert gaps.agg(F.max("gap")).first()[0] < 1e-4


def test_same_seed_same_factors(fitted):
    model, train, _ = fitted
    again = factorize.fit(train.repartition(7), RANK, 15, REG, blocks=4)
    both = model.userFactors.alias("a").join(again.userFactors.alias("b"), "id")
    apart = F.exists(F.zip_with("a.features", "b.features", lambda x, y: F.abs(x - y) > 1e-4), lambda d: d)
    assert both.count() == 200
    assert both.filter(apart).count() == 0


def test_predictions_are_those_of_mllib(fitted):
    model, _, test = fitted
    ours = factorize.predict(model, test).withColumnRenamed(S.PREDICTION, "ours")
    both = model.transform(ours)
    assert both.count() == test.count()
    assert both.filter(F.abs(F.col("ours") - F.col(S.PREDICTION)) > 1e-5).count() == 0


def test_cold_ids(spark, fitted):
    model, _, _ = fitted
    pairs = spark.createDataFrame([(1, 1), (9999, 1), (1, 9999)], "userId int, movieId int")
    assert factorize.predict(model, pairs).count() == 1
    kept = factorize.predict(model, pairs, keep_unknown=True)
    assert kept.count() == 3 and kept.filter(F.col(S.PREDICTION).isNull()).count() == 2
    found = factorize.evaluate(model, pairs.withColumn(S.RATING, F.lit(1.0))).first()
    assert (found["n_scored"], found["n_total"]) == (1, 3)


def test_all_users_are_those_of_mllib(fitted, catalog):
    model, _, _ = fitted
    ours = recommend.recommend_all_users(model.userFactors, model.itemFactors, catalog, 10)
    theirs = model.recommendForAllUsers(10).select(S.USER, F.posexplode("recommendations"))
    both = ours.join(
        theirs.select(S.USER, (F.col("pos") + 1).alias(S.RANK), "col.rating"), [S.USER, S.RANK]
    )
    assert both.count() == 2000
    assert both.filter(F.abs(F.col("rating") - F.col("predicted_rating")) > 1e-5).count() == 0


def test_one_user_is_the_same_as_all_users(fitted, planted, catalog):
    model, _, _ = fitted
    users, items = model.userFactors, model.itemFactors
    every = recommend.recommend_all_users(users, items, catalog, 10, seen=planted)
    one = recommend.top_n_for_user(planted, catalog, users, items, 17, 10)
    columns = [S.RANK, S.ITEM, "predicted_rating"]
    assert tuples(every.filter(F.col(S.USER) == 17).select(columns)) == tuples(
        one.withColumnRenamed(S.PREDICTION, "predicted_rating").select(columns)
    )
    near = similar.similar_items_all(items, catalog, 10)
    assert tuples(near.filter("target_id = 5").select(S.RANK, S.ITEM, S.SIMILARITY)) == tuples(
        similar.similar_items(items, catalog, 5, 10).select(S.RANK, S.ITEM, S.SIMILARITY)
    )


def test_full_lists_when_titles_are_missing(fitted, planted, catalog):
    model, _, _ = fitted
    some = catalog.filter(F.col(S.ITEM) % 10 != 0)
    found = recommend.recommend_all_users(model.userFactors, model.itemFactors, some, 10, seen=planted)
    assert found.count() == 2000
    assert found.join(planted, [S.USER, S.ITEM]).count() == 0
    assert found.filter(F.col(S.ITEM) % 10 == 0).count() == 0


def test_model_files(spark, fitted, tmp_path):
    model, _, test = fitted
    path = str(tmp_path / "model")
    for _ in range(2):
        models.save_model(spark, model, path, {"rank": RANK, "reg_param": REG})
    again = models.load_model(path)
    assert again.rank == RANK
    assert tuples(factorize.predict(again, test)) == tuples(factorize.predict(model, test))
    assert models.load_params(spark, path).first().asDict() == {"rank": RANK, "reg_param": REG}


def test_tune(planted):
    tuned = factorize.tune(planted, (1, 3), (0.001, 1.0), (5,), parallelism=2, blocks=4)
    rows = tuned.grid.collect()
    assert len(rows) == 4
    assert [(r["rank"], r["reg_param"]) for r in rows if r["is_best"]] == [(3, 0.001)]
    assert tuned.model.rank == tuned.params["rank"] == 3
    assert tuned.params == {"rank": 3, "reg_param": 0.001, "max_iter": 5}
    assert min(r["avg_rmse"] for r in rows) == next(r["avg_rmse"] for r in rows if r["is_best"]) < 0.1


def _vectors(model):
    return {row["id"]: list(row["features"]) for row in model.userFactors.collect()}


def test_tuned_model_is_the_fit_and_keeps_its_parameters(spark, planted, tmp_path):
    path = str(tmp_path / "tuned")
    tuned = factorize.tune(planted, (3,), (0.001,), (5,), blocks=4, test=planted, path=path)
    assert tuned.path == path and tuned.test_rmse < 0.1
    kept = models.load_params(spark, path).first().asDict()
    assert kept == {"rank": 3, "reg_param": 0.001, "max_iter": 5, "seed": 42, "blocks": 4}
    again = _vectors(factorize.fit(planted, 3, 5, 0.001, blocks=4))
    assert {i: pytest.approx(v, abs=1e-3) for i, v in _vectors(tuned.model).items()} == again


def test_combinations_without_an_error_are_refused():
    params = [{"rank": 1}, {"rank": 2}, {"rank": 3}]
    assert factorize.least_error(params, [0.5, 0.2, 0.2]) == 1
    with pytest.raises(ValueError, match="'rank': 2"):
        factorize.least_error(params, [0.5, float("nan"), 0.2])


def test_model_does_not_depend_on_how_ratings_are_spread(planted):
    one, two = (_vectors(factorize.fit(planted.repartition(n), 3, 3, 0.01)) for n in (2, 7))
    assert {i: pytest.approx(v, abs=1e-3) for i, v in one.items()} == two


def test_metrics(spark):
    rows = [(4.0, 3.0), (2.0, 4.0), (5.0, None), (1.0, float("nan"))]
    found = metrics.rmse_mae(spark.createDataFrame(rows, "rating float, prediction double")).first()
    assert found["rmse"] == pytest.approx(2.5**0.5)
    assert (found["mae"], found["n_scored"], found["n_total"]) == (1.5, 2, 4)


def test_batch(spark, planted, catalog, tmp_path):
    source, base = str(tmp_path / "source"), str(tmp_path / "base")
    planted.coalesce(1).write.option("header", True).csv(f"{source}/ratings.csv")
    catalog.coalesce(1).write.option("header", True).csv(f"{source}/movies.csv")
    ratings, landed = batch.land(spark, source, base)
    preset = Preset(min_user_ratings=20, min_item_ratings=10, rank=3, max_iter=5, reg_param=0.01)
    answers = batch.full(ratings, landed, base, user_id=17, movie_id=5, n=4, preset=preset)
    assert answers.trained.metrics.first()["rmse"] < 0.1
    assert answers.recommended.count() == answers.similar.count() == 4
    assert models.load_params(spark, answers.trained.path).first()["rank"] == 3
    assert tuples(batch.recommend(ratings, landed, base, 17, 4)) == tuples(answers.recommended)
    assert tuples(batch.similar(landed, base, 5, 4)) == tuples(answers.similar)
    report = answers.report.first()
    assert (report["data"]["ratings"], report["data"]["incomplete"]) == (planted.count(), 0)
    assert report["model"]["rmse"] == round(answers.trained.metrics.first()["rmse"], 4)
    assert report["model"]["n_scored"] <= report["model"]["n_total"]
    batch.recommend_everyone(ratings, landed, base, 4)
    stored = models.read_recommendations(spark, base)
    assert stored.count() == 800
    assert tuples(stored.filter("userId = 17").select(S.RANK, S.ITEM)) == tuples(
        answers.recommended.select(S.RANK, S.ITEM)
    )
    of_one = models.read_recommendations_of(spark, base, 17)
    assert tuples(of_one) == tuples(stored.filter("userId = 17").select(of_one.columns))


def test_presets():
    assert (ENGINE_DEFAULTS.min_user_ratings, ENGINE_DEFAULTS.min_item_ratings) == (20, 10)
    assert (ENGINE_DEFAULTS.rank, SMALL_DEFAULTS.rank) == (50, 20)
    assert (SMALL_DEFAULTS.min_user_ratings, SMALL_DEFAULTS.min_item_ratings) == (5, 0)


def test_implicit_uses_alpha(fitted):
    _, train, _ = fitted
    one = factorize.fit(train, RANK, 2, 0.1, alpha=1.0, implicit=True, blocks=4)
    forty = factorize.fit(train, RANK, 2, 0.1, alpha=40.0, implicit=True, blocks=4)
    explicit = [factorize.fit(train, RANK, 2, 0.1, alpha=a, blocks=4) for a in (1.0, 40.0)]
    assert tuples(one.userFactors) != tuples(forty.userFactors)
    assert tuples(explicit[0].userFactors) == tuples(explicit[1].userFactors)


def test_scores_of_known_pairs(fitted):
    model, train, _ = fitted
    scored = scoring.score_pairs(train, model.userFactors, model.itemFactors, model.rank)
    assert scored.count() == train.count()


def test_fits_keep_nothing_in_the_memory_of_executors(spark, planted):
    """Blocks and factors grow with the ratings; they are on disk, so several fits at once leave memory to tasks."""
    als = factorize._estimator(1, 2)
    assert als.getIntermediateStorageLevel() == als.getFinalStorageLevel() == "DISK_ONLY"
    model = factorize.fit(planted, RANK, 2, REG, blocks=2)
    kept = [x for x in spark.sparkContext._jsc.sc().getRDDStorageInfo() if x.name() in ("userFactors", "itemFactors")]
    assert model.userFactors.count() == 200
    assert [x for x in kept if x.diskSize() > 0] and max(x.memSize() for x in kept) == 0
