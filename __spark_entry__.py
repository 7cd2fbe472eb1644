
from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from affinia import schemas as S  # noqa: E402
from affinia.functions import vectors  # noqa: E402
from affinia.operators import activity, approximate, candidates, cleaning, factorize, lookup  # noqa: E402
from affinia.operators import metrics, recommend, scoring, similar, splitting  # noqa: E402
from affinia.operators.grid import top_n  # noqa: E402
from affinia.plans import batch, payloads  # noqa: E402
from affinia.settings import TOP_N, TUNE_FOLDS, Preset  # noqa: E402
from affinia.sources import landing, models  # noqa: E402
from affinia.sources import order_tables as tables  # noqa: E402
from affinia.sources import workspace  # noqa: E402
from affinia.sources.workspace import written  # noqa: E402

try:  # text operators and their pipeline: an optional part of this repository
    import corpus_pipeline
    from affinia.llm import queries as llm
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "affinia.llm"):
        raise
    llm = None

SMOKE_DIR = "/root/testdata/sf0.001"


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder for what a query stores; it goes when the session's driver ends."""
    folder = workspace.new_folder(spark, label)
    workspace.delete_at_exit(spark, folder)
    return folder


USER_ID = 7
MOVIE_ID = 1

# The order tables hold about 40 ratings for a user and 30 for an item, so
# these thresholds leave some out on both sides.
CLEANING = Preset(min_user_ratings=20, min_item_ratings=28, rank=8, max_iter=5)


def entry(spark: SparkSession) -> DataFrame:
    """Train on the smallest tables and recommend items to one user."""
    ratings = tables.ratings(spark, SMOKE_DIR)
    catalog = tables.catalog(spark, SMOKE_DIR)
    preset = Preset(min_user_ratings=5, min_item_ratings=0, rank=8, max_iter=5)
    return batch.full(
        ratings, catalog, new_folder(spark, "full"), USER_ID, MOVIE_ID, preset=preset
    ).recommended


# One model is fitted for each session and folder, stored, and read by all
# queries on trained models.
_MODELS: dict[tuple[str, str], tuple[ALSModel, DataFrame]] = {}


def _trained(spark: SparkSession, folder: str) -> tuple[ALSModel, DataFrame]:
    """A stored model and the stored ratings, marked as train or test, behind it."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _MODELS:
        with workspace.staging(spark) as store:
            cleaned = cleaning.clean(tables.ratings(spark, folder), CLEANING, store)
            split = written(splitting.with_split(cleaned), "split", (S.SPLIT,))
        model = factorize.fit(
            splitting.side(split, S.TRAIN), CLEANING.rank, CLEANING.max_iter, CLEANING.reg_param
        )
        path = models.save_model(spark, model, new_folder(spark, "model"))
        _MODELS[key] = models.load_model(path), split
    return _MODELS[key]


def _on_ratings(operator: Callable[..., DataFrame], *args):
    return lambda spark, folder: operator(tables.ratings(spark, folder), *args)


def _on_catalog(operator: Callable[..., DataFrame], *args):
    return lambda spark, folder: operator(tables.catalog(spark, folder), *args)


def _latest(spark, folder) -> DataFrame:
    return cleaning.latest_ratings(cleaning.drop_nulls(tables.ratings_with_gaps(spark, folder)))


def _split_stats(spark, folder) -> DataFrame:
    return splitting.split_stats(splitting.with_split(tables.ratings(spark, folder)))


def _preprocess(spark, folder) -> DataFrame:
    ratings = tables.ratings_with_gaps(spark, folder)
    return splitting.with_split(cleaning.clean(ratings, CLEANING))


def _service_stats(spark, folder) -> DataFrame:
    return activity.service_stats(
        tables.ratings(spark, folder), tables.catalog(spark, folder), CLEANING.rank
    )


def _rounded(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.round(column, 6))


def _score_pairs(spark, folder) -> DataFrame:
    pairs = tables.ratings(spark, folder).select(S.USER, S.ITEM).distinct()
    users, items = tables.user_factors(spark, folder), tables.item_factors(spark, folder)
    return _rounded(scoring.score_pairs(pairs, users, items), S.PREDICTION)


def _item_norms(spark, folder) -> DataFrame:
    return _rounded(scoring.item_norms(tables.item_factors(spark, folder)), "norm")


def _unseen(spark, folder) -> DataFrame:
    return candidates.unseen_items(
        tables.ratings(spark, folder), tables.catalog(spark, folder), USER_ID
    )


def _top_n_for_user(spark, folder) -> DataFrame:
    found = recommend.top_n_for_user(
        tables.ratings(spark, folder),
        tables.catalog(spark, folder),
        tables.user_factors(spark, folder),
        tables.item_factors(spark, folder),
        USER_ID,
    )
    return _rounded(found, S.PREDICTION)


def _everyone(spark, folder, unseen_only: bool) -> DataFrame:
    return recommend.recommend_all_users(
        tables.user_factors(spark, folder),
        tables.item_factors(spark, folder),
        tables.catalog(spark, folder),
        seen=tables.ratings(spark, folder) if unseen_only else None,
    )


def _recommend_all(spark, folder) -> DataFrame:
    return _rounded(_everyone(spark, folder, False), "predicted_rating")


def _recommend_all_unseen(spark, folder) -> DataFrame:
    return _rounded(_everyone(spark, folder, True), "predicted_rating")


def _similar_items(spark, folder) -> DataFrame:
    found = similar.similar_items(
        tables.item_factors(spark, folder),
        tables.catalog(spark, folder),
        MOVIE_ID,
    )
    return _rounded(found, S.SIMILARITY)


def _all_similar(spark, folder) -> DataFrame:
    return similar.similar_items_all(
        tables.item_factors(spark, folder), tables.catalog(spark, folder)
    )


def _similar_items_all(spark, folder) -> DataFrame:
    return _rounded(_all_similar(spark, folder), S.SIMILARITY)


def _catalog_lookup(spark, folder) -> DataFrame:
    found = lookup.catalog_lookup(tables.catalog(spark, folder), tables.ratings(spark, folder))
    return found.select("movie_id", S.TITLE, F.posexplode(S.GENRES).alias("position", "genre"))


def _evaluate_metrics(spark, folder) -> DataFrame:
    train, test = splitting.split_holdout(cleaning.latest_ratings(tables.ratings(spark, folder)))
    means = train.groupBy(S.ITEM).agg(F.avg(S.RATING).alias(S.PREDICTION))
    return _rounded(_rounded(metrics.rmse_mae(test.join(means, S.ITEM, "left")), "rmse"), "mae")


def _land_raw(spark, folder) -> DataFrame:
    source, base = new_folder(spark, "files"), new_folder(spark, "landed")
    for name, rows in (
        (S.RATINGS_FILE, tables.ratings(spark, folder)),
        (S.CATALOG_FILE, tables.catalog(spark, folder)),
    ):
        rows.write.option("header", True).option("escape", '"').csv(f"{source}/{name}")
    landing.land_raw(spark, source, base)
    ratings, catalog = landing.landed_ratings(spark, base), landing.landed_catalog(spark, base)
    return ratings.join(catalog, S.ITEM, "left")


def _recs_sink(spark, folder) -> DataFrame:
    base = new_folder(spark, "recommendations")
    models.write_recommendations(_recommend_all_unseen(spark, folder), base)
    return models.read_recommendations(spark, base)


def _recs_of_one(spark, folder) -> DataFrame:
    base = new_folder(spark, "recommendations")
    models.write_recommendations(_recommend_all_unseen(spark, folder), base)
    return models.read_recommendations_of(spark, base, USER_ID)


def _vector_reads(spark, folder) -> DataFrame:
    """The vectors of a user and an item, each by one read of a stored table."""
    found = []
    for kind, factors, key in (
        ("user", tables.user_factors(spark, folder), USER_ID),
        ("item", tables.item_factors(spark, folder), MOVIE_ID),
    ):
        base = new_folder(spark, "factors")
        models.write_factors(factors, base)
        row = models.read_vector(spark, base, key).select(F.lit(kind).alias("kind"), S.ID, S.LENGTH, F.posexplode(S.FEATURES))
        found.append(_rounded(row, S.LENGTH).select("kind", S.ID, S.LENGTH, "pos", F.col("col").cast("double").alias("value")))
    return found[0].unionByName(found[1])


def _top_n_stored(spark, folder) -> DataFrame:
    """The answer for one user from stored factor tables; published twice, so the second is read."""
    users, items = new_folder(spark, "factors"), new_folder(spark, "factors")
    for _ in range(2):
        models.write_factors(tables.user_factors(spark, folder), users)
        models.write_factors(tables.item_factors(spark, folder), items)
    found = recommend.top_n_for_user(
        tables.ratings(spark, folder),
        tables.catalog(spark, folder),
        models.read_vector(spark, users, USER_ID),
        models.read_factors(spark, items),
        USER_ID,
    )
    return _rounded(found, S.PREDICTION)


def _landing_rejects(spark, folder) -> DataFrame:
    """Ratings landed from a file in which some cells do not fit: no discount spoils the rating,
    a third of all parts the user, and a ship mode the time."""
    source, base = new_folder(spark, "files"), new_folder(spark, "landed")
    rows = tables.ratings_with_gaps(spark, folder)
    text = lambda spoilt, value, column: F.when(spoilt, value).otherwise(F.col(column).cast("string")).alias(column)
    rows.select(
        text(F.col(S.ITEM) % 3 == 0, F.concat(F.lit("99999"), F.col(S.USER), F.lit("0000")), S.USER),
        S.ITEM,
        text(F.col(S.RATING).isNull(), F.lit("none"), S.RATING),
        text(F.col(S.ITEM) % 5 == 0, F.lit("then"), S.TIMESTAMP),
    ).write.option("header", True).csv(f"{source}/{S.RATINGS_FILE}")
    landing.land_raw(spark, source, base)
    return landing.landed_rejects(spark, base).drop("file")


def _batch_report(spark, folder) -> DataFrame:
    """What a whole batch run reports, and whether its errors are numbers."""
    ratings, catalog = tables.ratings_with_gaps(spark, folder), tables.catalog(spark, folder)
    base = new_folder(spark, "full")
    answers = batch.full(ratings, catalog, base, USER_ID, MOVIE_ID, preset=CLEANING)
    measured = (F.col("model.rmse") > 0) & (F.col("model.mae") > 0) & (F.col("model.rmse") < 10)
    return answers.report.select("data.*", "model.n_scored", "model.n_total", measured.alias("measured"))


def _similar_items_approx(spark, folder) -> DataFrame:
    """Approximate lists on trained factors: how many there are, whether scores are
    exact, and whether at least nine tenths of the exact search are found."""
    model, _ = _trained(spark, folder)
    items = lookup.in_catalog(model.itemFactors, tables.catalog(spark, folder))
    found = written(approximate.top_n_approx(items), "approximate")
    exact = written(top_n(items, items, TOP_N, cosine=True, skip_self=True), "exact")  # both figures read it
    both = found.join(exact.withColumnRenamed("score", "expected"), ["left", "right"])
    same = both.agg(F.coalesce(F.max(F.abs(F.col("score") - F.col("expected"))), F.lit(0.0)) < 1e-12)
    measured = approximate.recall(found, exact, ["left", "right"])
    return measured.select(
        F.lit(found.count()).alias("n_rows"),
        (F.col("recall") >= 0.9).alias("recall_at_least_09"),
        same.scalar().alias("exact_scores"),
    )


def _als_user_factors(spark, folder) -> DataFrame:
    model, split = _trained(spark, folder)
    gaps = metrics.least_squares_gap(
        splitting.side(split, S.TRAIN),
        model.userFactors,
        model.itemFactors,
        CLEANING.reg_param,
        CLEANING.rank,
    )
    return gaps.select(S.USER, "n", "rank", (F.col("gap") < 1e-3).alias("is_solution"))


def _als_item_factors(spark, folder) -> DataFrame:
    """Whether each item solves its least squares against the users of one iteration before."""
    model, split = _trained(spark, folder)
    train = splitting.side(split, S.TRAIN)
    before = factorize.fit(train, CLEANING.rank, CLEANING.max_iter - 1, CLEANING.reg_param)
    turned = train.select(F.col(S.ITEM).alias(S.USER), F.col(S.USER).alias(S.ITEM), S.RATING)
    gaps = metrics.least_squares_gap(
        turned, model.itemFactors, before.userFactors, CLEANING.reg_param, CLEANING.rank
    )
    solved = (F.col("gap") < 1e-2).alias("is_solution")
    return gaps.select(F.col(S.USER).alias(S.ITEM), "n", "rank", solved)


def _als_predict(spark, folder) -> DataFrame:
    model, split = _trained(spark, folder)
    ours = factorize.predict(model, splitting.side(split, S.TEST))
    both = model.transform(ours.withColumnRenamed(S.PREDICTION, "ours"))
    agrees = F.abs(F.col("ours") - F.col(S.PREDICTION)) < 1e-4
    return both.select(S.USER, S.ITEM, S.RATING, agrees.alias("as_mllib"))


def _with_users(pairs: DataFrame, model: ALSModel) -> DataFrame:
    """Pairs with the factors of their user as ``u``."""
    return pairs.join(model.userFactors.select(F.col(S.ID).alias(S.USER), F.col(S.FEATURES).alias("u")), S.USER)


def _with_items(pairs: DataFrame, model: ALSModel) -> DataFrame:
    """The inner product of ``u`` and the factors of the item as ``expected``, in place of ``u``."""
    items = model.itemFactors.select(F.col(S.ID).alias(S.ITEM), F.col(S.FEATURES).alias("v"))
    both = pairs.join(items, S.ITEM)
    return both.withColumn("expected", vectors.dot(F.col("u"), F.col("v"))).drop("u", "v")


def _by_expression(pairs: DataFrame, model: ALSModel) -> DataFrame:
    """Pairs with the inner product of their factors, by plain joins, as ``expected``."""
    return _with_items(_with_users(pairs, model), model)


def _als_evaluate(spark, folder) -> DataFrame:
    """Whether both errors are those of plain joins."""
    model, split = _trained(spark, folder)
    test = splitting.side(split, S.TEST)
    error = F.col(S.RATING) - F.col("expected").cast("float")
    plain = _by_expression(test, model)
    rmse, mae = F.sqrt(F.avg(error * error)), F.avg(F.abs(error))
    found = factorize.evaluate(model, test)
    rmse_same = F.abs(F.col("rmse") - plain.agg(rmse).scalar()) < 1e-6
    mae_same = F.abs(F.col("mae") - plain.agg(mae).scalar()) < 1e-6
    return found.select("n_scored", "n_total", (rmse_same & mae_same).alias("exact"))


def _als_evaluate_as_mllib(spark, folder) -> DataFrame:
    """Whether the errors are those of MLlib's scoring and evaluator."""
    model, split = _trained(spark, folder)
    test = splitting.side(split, S.TEST)
    evaluator = RegressionEvaluator(labelCol=S.RATING, predictionCol=S.PREDICTION)
    theirs = written(model.transform(test), "scored")  # both errors read it
    rmse, mae = (evaluator.setMetricName(name).evaluate(theirs) for name in ("rmse", "mae"))
    same = (F.abs(F.col("rmse") - rmse) < 1e-6) & (F.abs(F.col("mae") - mae) < 1e-6)
    return factorize.evaluate(model, test).select("n_scored", "n_total", same.alias("as_mllib"))


def _als_recommend_all_as_mllib(spark, folder) -> DataFrame:
    """Whether the scores at every rank are those of MLlib's own search."""
    model, _ = _trained(spark, folder)
    theirs = model.recommendForAllUsers(TOP_N).select(S.USER, F.posexplode("recommendations"))
    theirs = theirs.select(S.USER, (F.col("pos") + 1).alias(S.RANK), "col.rating")
    both = _als_everyone(spark, folder, None)[0].join(theirs, [S.USER, S.RANK], "full")
    same = F.abs(F.col("predicted_rating") - F.col("rating")) < 1e-4
    return both.groupBy(S.USER).agg(
        F.count("*").alias("n"), F.every(F.coalesce(same, F.lit(False))).alias("as_mllib")
    )


def _one_list(found: DataFrame, scored: DataFrame, score: str) -> DataFrame:
    """Whether a short list has the items and scores of a full sort, rank by rank."""
    best = scored.orderBy(F.desc("expected"), S.ITEM).limit(TOP_N)
    order = Window.orderBy(F.desc("expected"), S.ITEM)
    best = best.select(F.row_number().over(order).alias(S.RANK), F.col(S.ITEM).alias("item"), "expected")
    same = (F.col(S.ITEM) == F.col("item")) & (F.abs(F.col(score) - F.col("expected")) < 1e-9)
    both = found.join(best, S.RANK, "full")
    return both.select(S.RANK, F.coalesce(same, F.lit(False)).alias("exact"))


def _als_top_n_for_user(spark, folder) -> DataFrame:
    model, _ = _trained(spark, folder)
    ratings, catalog = tables.ratings(spark, folder), tables.catalog(spark, folder)
    users, items = model.userFactors, model.itemFactors
    found = recommend.top_n_for_user(ratings, catalog, users, items, USER_ID)
    unseen = candidates.unseen_items(ratings, catalog, USER_ID)
    return _one_list(found, _by_expression(unseen, model), S.PREDICTION)


def _exact_lists(found: DataFrame, model: ALSModel) -> DataFrame:
    """Whether every score is that of plain joins, and no list rises.

    Lists are compared right after the join with users, which has each one in one place already.
    """
    before = F.lag("predicted_rating").over(Window.partitionBy(S.USER).orderBy(S.RANK))
    falls = F.coalesce(before >= F.col("predicted_rating"), F.lit(True))
    both = _with_items(_with_users(found, model).withColumn("falls", falls), model)
    same = F.abs(F.col("predicted_rating") - F.col("expected")) < 1e-9
    return both.select(S.USER, S.ITEM, S.RANK, (same & F.col("falls")).alias("exact"))


def _als_everyone(spark, folder, seen: DataFrame | None) -> tuple[DataFrame, ALSModel]:
    model, _ = _trained(spark, folder)
    catalog = tables.catalog(spark, folder)
    return recommend.recommend_all_users(model.userFactors, model.itemFactors, catalog, seen=seen), model


def _als_recommend_all(spark, folder) -> DataFrame:
    return _exact_lists(*_als_everyone(spark, folder, None)).drop(S.ITEM)


def _als_recommend_all_unseen(spark, folder) -> DataFrame:
    """The same, and whether the item was not rated by the user.

    The search and the comparison read ratings filtered alike, so they share the shuffles of the order lines.
    """
    ratings = tables.ratings(spark, folder).filter(F.col(S.USER).isNotNull() & F.col(S.ITEM).isNotNull())
    found = _exact_lists(*_als_everyone(spark, folder, ratings))
    rated = ratings.select(S.USER, S.ITEM).distinct().withColumn("rated", F.lit(True))
    both = found.join(rated, [S.USER, S.ITEM], "left")
    return both.select(S.USER, S.RANK, (F.col("exact") & F.col("rated").isNull()).alias("exact"))


def _als_similar_items(spark, folder) -> DataFrame:
    model, _ = _trained(spark, folder)
    catalog, items = tables.catalog(spark, folder), model.itemFactors
    found = similar.similar_items(items, catalog, MOVIE_ID)
    target = items.where(F.col(S.ID) == MOVIE_ID).agg(F.max(S.FEATURES)).scalar()
    others = lookup.in_catalog(items.where(F.col(S.ID) != MOVIE_ID), catalog).withColumn("t", target)
    cosine = vectors.cosine(F.col("t"), F.col(S.FEATURES)).alias("expected")
    scored = others.where("t IS NOT NULL").select(F.col(S.ID).alias(S.ITEM), cosine)
    return _one_list(found, scored, S.SIMILARITY)


TUNED = {"ranks": (4, 8), "reg_params": (0.1, 1.0), "max_iters": (3,)}


def _als_tune(spark, folder) -> DataFrame:
    """Whether each error is the mean over separately fitted folds, and the best one the least."""
    _, split = _trained(spark, folder)
    train = splitting.side(split, S.TRAIN)
    grid = factorize.tune(train, **TUNED).grid
    folded = written(splitting.with_fold(train, TUNE_FOLDS), "folds")
    means = []
    for rank in TUNED["ranks"]:
        for reg_param in TUNED["reg_params"]:
            errors = []
            for fold in range(TUNE_FOLDS):
                model = factorize.fit(folded.where(F.col("fold") != fold), rank, 3, reg_param)
                test = folded.where(F.col("fold") == fold)
                errors.append(factorize.evaluate(model, test).first()["rmse"])
            means.append((rank, reg_param, sum(errors) / len(errors)))
    expected = spark.createDataFrame(means, "rank int, reg_param double, expected double")
    both = grid.join(expected, ["rank", "reg_param"])
    least = grid.agg(F.min("avg_rmse")).scalar()
    return both.select(
        "rank",
        "reg_param",
        "max_iter",
        (F.abs(F.col("avg_rmse") - F.col("expected")) < 1e-4).alias("as_folds"),
        (F.col("is_best") == (F.col("avg_rmse") == least)).alias("best_is_least"),
    )


def _answers(answers: DataFrame, lists: str) -> DataFrame:
    """Entries of nested answers as rows."""
    return answers.select("*", F.posexplode(lists).alias("position", "entry")).select(
        *(name for name in answers.columns if name != lists), "position", "entry.*"
    )


def _recommend_answers(spark, folder) -> DataFrame:
    return _answers(payloads.recommend_answers(_everyone(spark, folder, True)), "recommendations")


def _similar_answers(spark, folder) -> DataFrame:
    answers = payloads.similar_answers(_all_similar(spark, folder))
    entries = F.transform("similar_movies", lambda e: e.withField("movie_id_1", e["movie_id"]).dropFields("movie_id"))
    return _answers(answers.withColumn("similar_movies", entries), "similar_movies")


def _stats_answer(spark, folder) -> DataFrame:
    return payloads.stats_answer(_service_stats(spark, folder)).select("dataset.*", "model.*")


def _lookup_one(spark, folder) -> DataFrame:
    found = lookup.catalog_lookup(tables.catalog(spark, folder), MOVIE_ID)
    return found.select("movie_id", S.TITLE, F.posexplode(S.GENRES).alias("position", "genre"))


SMALL_SLICE = 16 * 1024  # so many bytes of items a task that the grid has several columns


def _in_columns(spark, folder, cosine: bool) -> DataFrame:
    """The search over all pairs with several columns, whose lists are merged."""
    users = tables.item_factors(spark, folder) if cosine else tables.user_factors(spark, folder)
    items = lookup.in_catalog(tables.item_factors(spark, folder), tables.catalog(spark, folder))
    seen = None if cosine else tables.ratings(spark, folder)
    found = top_n(users, items, TOP_N, seen, cosine, skip_self=cosine, slice_bytes=SMALL_SLICE)
    return _rounded(found, "score")


def _random_split(spark, folder) -> DataFrame:
    """Whether both sides of a random split add up, without a common or a lost row."""
    ratings = tables.ratings(spark, folder)
    train, test = splitting.split_holdout(ratings, method="random")
    sides = train.withColumn("side", F.lit(1)).unionByName(test.withColumn("side", F.lit(0)))
    return sides.agg(
        F.count("*").alias("n"),
        (F.abs(F.avg("side") - 0.8) < 0.05).alias("near_share"),
        F.sum(F.xxhash64(*ratings.columns).cast("decimal(38,0)")).alias("digest"),
    ).select(
        "n",
        "near_share",
        (
            F.col("digest")
            == ratings.agg(F.sum(F.xxhash64(*ratings.columns).cast("decimal(38,0)"))).scalar()
        ).alias("same_rows"),
    )


def _model_roundtrip(spark, folder) -> DataFrame:
    model, split = _trained(spark, folder)
    path = models.save_model(
        spark, model, new_folder(spark, "model"), {"reg_param": CLEANING.reg_param}
    )
    again = models.load_model(path)
    test = splitting.side(split, S.TEST).select(S.USER, S.ITEM)
    before = factorize.predict(model, test)
    after = factorize.predict(again, test).withColumnRenamed(S.PREDICTION, "reloaded")
    params = models.load_params(spark, path).select("reg_param").scalar()
    return before.join(after, [S.USER, S.ITEM]).agg(
        F.count("*").alias("n_predictions"),
        F.count_if(F.col(S.PREDICTION) != F.col("reloaded")).alias("n_changed"),
        F.max(params).alias("reg_param"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every operator as a query over a folder of tables."""
    return {
        "ratings_scan": tables.ratings,
        "catalog_scan": tables.catalog,
        "dataset_stats": _on_ratings(activity.dataset_stats),
        "service_stats": _service_stats,
        "user_activity": _on_ratings(activity.user_activity),
        "item_popularity": _on_ratings(activity.item_popularity),
        "active_users": _on_ratings(cleaning.active_users, CLEANING.min_user_ratings),
        "popular_items": _on_ratings(cleaning.popular_items, CLEANING.min_item_ratings),
        "drop_nulls": lambda s, d: cleaning.drop_nulls(tables.ratings_with_gaps(s, d)),
        "dedup_latest": _latest,
        "filter_active_users": _on_ratings(cleaning.keep_active_users, CLEANING.min_user_ratings),
        "filter_popular_items": _on_ratings(cleaning.keep_popular_items, CLEANING.min_item_ratings),
        "holdout_split": _on_ratings(splitting.with_split),
        "split_stats": _split_stats,
        "preprocess": _preprocess,
        "score_pairs": _score_pairs,
        "item_norms": _item_norms,
        "user_history": _on_ratings(candidates.user_history, USER_ID),
        "unseen_candidates": _unseen,
        "top_n_for_user": _top_n_for_user,
        "recommend_all_users": _recommend_all,
        "recommend_all_users_unseen": _recommend_all_unseen,
        "similar_items": _similar_items,
        "similar_items_all": _similar_items_all,
        "catalog_lookup": _catalog_lookup,
        "genres_display": _on_catalog(lookup.genres_display),
        "recommend_payload": lambda s, d: payloads.recommend_payload(_everyone(s, d, True)),
        "similar_payload": lambda s, d: payloads.similar_payload(_all_similar(s, d)),
        "evaluate_metrics": _evaluate_metrics,
        "land_raw": _land_raw,
        "recs_sink_roundtrip": _recs_sink,
        "recs_sink_one_user": _recs_of_one,
        "factor_point_reads": _vector_reads,
        "top_n_from_store": _top_n_stored,
        "landing_rejects": _landing_rejects,
        "batch_report": _batch_report,
        "similar_items_approx": _similar_items_approx,
        "model_roundtrip": _model_roundtrip,
        "als_user_factors": _als_user_factors,
        "als_item_factors": _als_item_factors,
        "als_predict": _als_predict,
        "als_evaluate": _als_evaluate,
        "als_evaluate_as_mllib": _als_evaluate_as_mllib,
        "als_top_n_for_user": _als_top_n_for_user,
        "als_recommend_all": _als_recommend_all,
        "als_recommend_all_as_mllib": _als_recommend_all_as_mllib,
        "als_recommend_all_unseen": _als_recommend_all_unseen,
        "als_similar_items": _als_similar_items,
        "als_tune": _als_tune,
        "recommend_answers": _recommend_answers,
        "similar_answers": _similar_answers,
        "stats_answer": _stats_answer,
        "catalog_lookup_one": _lookup_one,
        "recommend_in_columns": lambda s, d: _in_columns(s, d, False),
        "similar_in_columns": lambda s, d: _in_columns(s, d, True),
        "random_split": _random_split,
        **(llm.QUERIES | {"pipeline": corpus_pipeline.run} if llm else {}),
    }


_RATINGS = """
    SELECT CAST(o_custkey AS INT) AS "userId", CAST(l_partkey AS INT) AS "movieId",
           CAST({rating} AS FLOAT) AS rating, CAST(epoch(o_orderdate) AS INT) AS "timestamp"
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""
_STARS = "ceil(l_quantity / 5) / 2"
_GAPS = f"CASE WHEN l_discount <> 0 THEN {_STARS} END"
_CATALOG = """
    SELECT CAST(p_partkey AS INT) AS "movieId", p_name AS title,
           p_type || '|' || p_brand AS genres
    FROM part
"""
_COMMON = f"""
WITH ratings AS ({_RATINGS.format(rating=_STARS)}),
gappy AS ({_RATINGS.format(rating=_GAPS)}),
catalog AS ({_CATALOG}),
item_factors AS (SELECT CAST(vec_id AS INT) AS id, CAST(embedding AS DOUBLE[]) AS features
                 FROM embeddings),
user_factors AS (SELECT id, list_reverse(features) AS features FROM item_factors)
"""
_COMPLETE = 'SELECT * FROM gappy WHERE COLUMNS(*) IS NOT NULL'


def _latest_sql(source: str) -> str:
    return f"""
        SELECT "userId", "movieId", rating, "timestamp" FROM (
            SELECT *, row_number() OVER (PARTITION BY "userId", "movieId"
                                         ORDER BY "timestamp" DESC, rating DESC) AS copy
            FROM ({source}))
        WHERE copy = 1"""


_SIDE = """CASE WHEN ('0x' || substr(md5("userId" || ':' || "movieId"), 1, 8))::BIGINT % 100 < 80
           THEN 'train' ELSE 'test' END"""


def _cleaned_sql(source: str) -> str:
    """Cleaning and split, as further common tables that end in ``split_ratings``."""
    return f""",
latest AS ({_latest_sql(source)}),
of_active AS (SELECT * FROM latest WHERE "userId" IN (
    SELECT "userId" FROM latest GROUP BY 1 HAVING count(rating) >= {CLEANING.min_user_ratings})),
cleaned AS (SELECT * FROM of_active WHERE "movieId" IN (
    SELECT "movieId" FROM of_active GROUP BY 1 HAVING count(rating) >= {CLEANING.min_item_ratings})),
split_ratings AS (SELECT *, {_SIDE} AS split FROM cleaned),
known_test AS (SELECT * FROM split_ratings WHERE split = 'test'
    AND "userId" IN (SELECT "userId" FROM split_ratings WHERE split = 'train')
    AND "movieId" IN (SELECT "movieId" FROM split_ratings WHERE split = 'train'))
"""


_ALS = _COMMON + _cleaned_sql("SELECT * FROM ratings")
_TRAINED = """,
users AS (SELECT DISTINCT "userId" FROM split_ratings WHERE split = 'train'),
items AS (SELECT DISTINCT "movieId" FROM split_ratings WHERE split = 'train'
          AND "movieId" IN (SELECT "movieId" FROM catalog))
"""


def _ranked_sql(unseen_only: bool) -> str:
    seen = 'AND NOT EXISTS (SELECT 1 FROM ratings r WHERE r."userId" = u.id AND r."movieId" = i.id)'
    return f"""
        SELECT "userId", "movieId", score, rank FROM (
            SELECT *, row_number() OVER (PARTITION BY "userId" ORDER BY score DESC, "movieId") AS rank
            FROM (SELECT u.id AS "userId", i.id AS "movieId",
                         list_dot_product(u.features, i.features) AS score
                  FROM user_factors u, item_factors i
                  WHERE i.id IN (SELECT "movieId" FROM catalog) {seen if unseen_only else ''}))
        WHERE rank <= 10"""


_COSINE = """
    SELECT t.id AS target_id, i.id AS "movieId",
           CASE WHEN t.length * i.length = 0 THEN 0.0
                ELSE list_dot_product(t.features, i.features) / (t.length * i.length) END AS score
    FROM (SELECT *, sqrt(list_dot_product(features, features)) AS length FROM item_factors) t,
         (SELECT *, sqrt(list_dot_product(features, features)) AS length FROM item_factors) i
    WHERE i.id <> t.id AND i.id IN (SELECT "movieId" FROM catalog)
"""
_NEAREST = f"""
    SELECT target_id, "movieId", score, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY target_id ORDER BY score DESC, "movieId") AS rank
        FROM ({_COSINE}))
    WHERE rank <= 10"""


def _recommendations_sql(unseen_only: bool) -> str:
    return f"""{_COMMON}
        SELECT "movieId", "userId", CAST(rank AS INT) AS rank,
               round(score, 6) AS predicted_rating, title, genres
        FROM ({_ranked_sql(unseen_only)}) JOIN catalog USING ("movieId")"""


def oracle_sql() -> dict[str, str]:
    """The same results in SQL; queries on trained models compare what SQL can derive."""
    users_20 = 'SELECT "userId" FROM ratings GROUP BY 1 HAVING count(rating) >= 20'
    items_28 = 'SELECT "movieId" FROM ratings GROUP BY 1 HAVING count(rating) >= 28'
    history = f'SELECT DISTINCT "movieId" FROM ratings WHERE "userId" = {USER_ID}'
    return {
        "ratings_scan": f"{_COMMON} SELECT * FROM ratings",
        "catalog_scan": f"{_COMMON} SELECT * FROM catalog",
        "dataset_stats": f"""{_COMMON}
            SELECT count(*) AS ratings, count(DISTINCT "userId") AS users,
                   count(DISTINCT "movieId") AS movies, avg(rating) AS avg_rating FROM ratings""",
        "service_stats": f"""{_COMMON}
            SELECT count(*) AS ratings, count(DISTINCT "userId") AS users,
                   (SELECT count(*) FROM catalog) AS movies,
                   'ALS (Alternating Least Squares)' AS algorithm,
                   CAST({CLEANING.rank} AS INT) AS rank, 'Apache Spark MLlib' AS framework
            FROM ratings""",
        "user_activity": f'{_COMMON} SELECT "userId", count(rating) AS n FROM ratings GROUP BY 1',
        "item_popularity": f'{_COMMON} SELECT "movieId", count(rating) AS n FROM ratings GROUP BY 1',
        "active_users": f"{_COMMON} {users_20}",
        "popular_items": f"{_COMMON} {items_28}",
        "drop_nulls": f"{_COMMON} {_COMPLETE}",
        "dedup_latest": f"{_COMMON} {_latest_sql(_COMPLETE)}",
        "filter_active_users": f'{_COMMON} SELECT * FROM ratings WHERE "userId" IN ({users_20})',
        "filter_popular_items": f'{_COMMON} SELECT * FROM ratings WHERE "movieId" IN ({items_28})',
        "holdout_split": f"{_COMMON} SELECT *, {_SIDE} AS split FROM ratings",
        "split_stats": f"{_COMMON} SELECT {_SIDE} AS split, count(*) AS n FROM ratings GROUP BY 1",
        "preprocess": f"{_COMMON} {_cleaned_sql(_COMPLETE)} SELECT * FROM split_ratings",
        "score_pairs": f"""{_COMMON}
            SELECT "userId", "movieId", round(list_dot_product(u.features, i.features), 6) AS prediction
            FROM (SELECT DISTINCT "userId", "movieId" FROM ratings)
            JOIN user_factors u ON u.id = "userId" JOIN item_factors i ON i.id = "movieId" """,
        "item_norms": f"""{_COMMON}
            SELECT id AS "movieId", round(sqrt(list_dot_product(features, features)), 6) AS norm
            FROM item_factors""",
        "user_history": f"{_COMMON} {history}",
        "unseen_candidates": f"""{_COMMON}
            SELECT DISTINCT CAST({USER_ID} AS INT) AS "userId", "movieId" FROM catalog
            WHERE "movieId" NOT IN ({history})""",
        "top_n_for_user": f"""{_COMMON}
            SELECT CAST(rank AS INT) AS rank, "movieId", title, genres, round(score, 6) AS prediction
            FROM ({_ranked_sql(True)}) JOIN catalog USING ("movieId") WHERE "userId" = {USER_ID}""",
        "recommend_all_users": _recommendations_sql(False),
        "recommend_all_users_unseen": _recommendations_sql(True),
        "similar_items": f"""{_COMMON}
            SELECT CAST(rank AS INT) AS rank, "movieId", title, genres, round(score, 6) AS similarity
            FROM ({_NEAREST}) JOIN catalog USING ("movieId") WHERE target_id = {MOVIE_ID}""",
        "similar_items_all": f"""{_COMMON}
            SELECT "movieId", target_id, CAST(rank AS INT) AS rank, round(score, 6) AS similarity,
                   title, genres
            FROM ({_NEAREST}) JOIN catalog USING ("movieId")""",
        "catalog_lookup": f"""{_COMMON},
            found AS (SELECT "movieId", title, string_split(genres, '|') AS parts FROM catalog
                      WHERE "movieId" IN (SELECT "movieId" FROM ratings))
            SELECT "movieId" AS movie_id, title,
                   CAST(unnest(range(len(parts))) AS INT) AS position, unnest(parts) AS genre
            FROM found""",
        "genres_display": f"""{_COMMON}
            SELECT "movieId", title, CASE WHEN coalesce(genres, '') = '' THEN '?'
                   ELSE replace(genres, '|', ', ') END AS genres FROM catalog""",
        "recommend_payload": f"""{_COMMON}
            SELECT "userId" AS user_id, CAST(rank AS INT) AS rank, "movieId" AS movie_id, title,
                   genres, round(score, 3) AS predicted_rating,
                   count(*) OVER (PARTITION BY "userId") AS count
            FROM ({_ranked_sql(True)}) JOIN catalog USING ("movieId")""",
        "similar_payload": f"""{_COMMON}
            SELECT target_id, CAST(rank AS INT) AS rank, "movieId" AS movie_id, title, genres,
                   round(score, 4) AS similarity, count(*) OVER (PARTITION BY target_id) AS count
            FROM ({_NEAREST}) JOIN catalog USING ("movieId")""",
        "evaluate_metrics": f"""{_COMMON},
            latest AS (SELECT *, {_SIDE} AS split FROM ({_latest_sql("SELECT * FROM ratings")})),
            means AS (SELECT "movieId", avg(rating) AS prediction FROM latest
                      WHERE split = 'train' GROUP BY 1)
            SELECT round(sqrt(avg((rating - prediction) * (rating - prediction))), 6) AS rmse,
                   round(avg(abs(rating - prediction)), 6) AS mae,
                   count(prediction) AS n_scored, count(*) AS n_total
            FROM latest LEFT JOIN means USING ("movieId") WHERE split = 'test' """,
        "land_raw": f"""{_COMMON} SELECT * FROM ratings LEFT JOIN catalog USING ("movieId")""",
        "recs_sink_roundtrip": _recommendations_sql(True),
        "recs_sink_one_user": f"""{_recommendations_sql(True)} WHERE "userId" = {USER_ID}""",
        "factor_point_reads": f"""{_COMMON}
            SELECT kind, id, round(sqrt(list_dot_product(features, features)), 6) AS length,
                   CAST(unnest(range(len(features))) AS INT) AS pos, unnest(features) AS value
            FROM (SELECT 'user' AS kind, * FROM user_factors WHERE id = {USER_ID}
                  UNION ALL SELECT 'item', * FROM item_factors WHERE id = {MOVIE_ID})""",
        "top_n_from_store": f"""{_COMMON}
            SELECT CAST(rank AS INT) AS rank, "movieId", title, genres, round(score, 6) AS prediction
            FROM ({_ranked_sql(True)}) JOIN catalog USING ("movieId") WHERE "userId" = {USER_ID}""",
        "landing_rejects": f"""{_COMMON},
            spoilt AS (
                SELECT CASE WHEN "movieId" % 3 = 0 THEN 'userId' END AS u, CASE WHEN rating IS NULL THEN 'rating' END AS r,
                       CASE WHEN "movieId" % 5 = 0 THEN 'timestamp' END AS t,
                       CASE WHEN "movieId" % 3 = 0 THEN '99999' || "userId" || '0000' ELSE "userId"::VARCHAR END
                       || ',' || "movieId" || ',' || CASE WHEN rating IS NULL THEN 'none' ELSE rating::VARCHAR END || ','
                       || CASE WHEN "movieId" % 5 = 0 THEN 'then' ELSE "timestamp"::VARCHAR END AS line
                FROM gappy)
            SELECT 'ratings.csv' AS source, 'no value for ' || concat_ws(',', u, r, t) AS cause, line
            FROM spoilt WHERE coalesce(u, r, t) IS NOT NULL""",
        "batch_report": f"""{_COMMON} {_cleaned_sql(_COMPLETE)}
            SELECT count(*) AS ratings, count(DISTINCT "userId") AS users, count(DISTINCT "movieId") AS movies,
                   avg(rating) AS avg_rating, count(*) - count(rating) AS incomplete,
                   (SELECT count(*) FROM known_test) AS n_scored,
                   (SELECT count(*) FROM split_ratings WHERE split = 'test') AS n_total, true AS measured
            FROM gappy""",
        "similar_items_approx": f"""{_ALS} {_TRAINED}
            SELECT CAST((SELECT count(*) * least({TOP_N}, count(*) - 1) FROM items) AS INT) AS n_rows,
                   true AS recall_at_least_09, true AS exact_scores""",
        "model_roundtrip": f"""{_ALS}
            SELECT count(*) AS n_predictions, CAST(0 AS BIGINT) AS n_changed,
                   CAST({CLEANING.reg_param} AS DOUBLE) AS reg_param FROM known_test""",
        "als_user_factors": f"""{_ALS}
            SELECT "userId", count(*) AS n, CAST({CLEANING.rank} AS INT) AS rank,
                   true AS is_solution
            FROM split_ratings WHERE split = 'train' GROUP BY 1""",
        "als_item_factors": f"""{_ALS}
            SELECT "movieId", count(*) AS n, CAST({CLEANING.rank} AS INT) AS rank,
                   true AS is_solution
            FROM split_ratings WHERE split = 'train' GROUP BY 1""",
        "als_predict": f"""{_ALS}
            SELECT "userId", "movieId", rating, true AS as_mllib FROM known_test""",
        "als_evaluate_as_mllib": f"""{_ALS}
            SELECT (SELECT count(*) FROM known_test) AS n_scored, count(*) AS n_total,
                   true AS as_mllib FROM split_ratings WHERE split = 'test' """,
        "als_evaluate": f"""{_ALS}
            SELECT (SELECT count(*) FROM known_test) AS n_scored, count(*) AS n_total,
                   true AS exact FROM split_ratings WHERE split = 'test' """,
        "als_top_n_for_user": f"""{_ALS} {_TRAINED}
            SELECT CAST(unnest(range(1, 1 + least({TOP_N}, (
                       SELECT count(*) FROM items WHERE "movieId" NOT IN ({history}))))) AS INT) AS rank,
                   true AS exact
            FROM users WHERE "userId" = {USER_ID}""",
        "als_recommend_all": f"""{_ALS} {_TRAINED}
            SELECT "userId", CAST(unnest(range(1, 1 + least({TOP_N}, (SELECT count(*) FROM items))))
                   AS INT) AS rank, true AS exact FROM users""",
        "als_recommend_all_unseen": f"""{_ALS} {_TRAINED},
            rated AS (SELECT "userId", count(DISTINCT "movieId") AS n FROM ratings
                      WHERE "movieId" IN (SELECT "movieId" FROM items) GROUP BY 1)
            SELECT "userId", CAST(unnest(range(1, 1 + least({TOP_N},
                       (SELECT count(*) FROM items) - coalesce(n, 0)))) AS INT) AS rank, true AS exact
            FROM users LEFT JOIN rated USING ("userId")""",
        "als_similar_items": f"""{_ALS} {_TRAINED}
            SELECT CAST(unnest(range(1, 1 + least({TOP_N}, (SELECT count(*) FROM items) - 1))) AS INT)
                   AS rank, true AS exact
            FROM items WHERE "movieId" = {MOVIE_ID}""",
        "als_tune": f"""
            SELECT CAST(rank AS INT) AS rank, CAST(reg_param AS DOUBLE) AS reg_param,
                   CAST(3 AS INT) AS max_iter, true AS as_folds, true AS best_is_least
            FROM unnest({list(TUNED["ranks"])}) r(rank), unnest({list(TUNED["reg_params"])}) p(reg_param)""",
        "recommend_answers": f"""{_COMMON}
            SELECT "userId" AS user_id, CAST(count(*) OVER (PARTITION BY "userId") AS INT) AS count,
                   CAST(rank - 1 AS INT) AS position, "movieId" AS movie_id, title, genres,
                   round(score, 3) AS predicted_rating
            FROM ({_ranked_sql(True)}) JOIN catalog USING ("movieId")""",
        "similar_answers": f"""{_COMMON}
            SELECT target_id AS movie_id, CAST(count(*) OVER (PARTITION BY target_id) AS INT) AS count,
                   CAST(rank - 1 AS INT) AS position, "movieId" AS movie_id_1, title, genres,
                   round(score, 4) AS similarity
            FROM ({_NEAREST}) JOIN catalog USING ("movieId")""",
        "stats_answer": f"""{_COMMON}
            SELECT count(*) AS ratings, count(DISTINCT "userId") AS users,
                   (SELECT count(*) FROM catalog) AS movies,
                   'ALS (Alternating Least Squares)' AS algorithm,
                   CAST({CLEANING.rank} AS INT) AS rank, 'Apache Spark MLlib' AS framework
            FROM ratings""",
        "catalog_lookup_one": f"""{_COMMON}
            SELECT "movieId" AS movie_id, title,
                   CAST(unnest(range(len(string_split(genres, '|')))) AS INT) AS position,
                   unnest(string_split(genres, '|')) AS genre
            FROM catalog WHERE "movieId" = {MOVIE_ID}""",
        "recommend_in_columns": f"""{_COMMON}
            SELECT "userId" AS "left", "movieId" AS "right", round(score, 6) AS score,
                   CAST(rank AS INT) AS rank FROM ({_ranked_sql(True)})""",
        "similar_in_columns": f"""{_COMMON}
            SELECT target_id AS "left", "movieId" AS "right", round(score, 6) AS score,
                   CAST(rank AS INT) AS rank FROM ({_NEAREST})""",
        "random_split": f"""{_COMMON}
            SELECT count(*) AS n, true AS near_share, true AS same_rows FROM ratings""",
        "als_recommend_all_as_mllib": f"""{_ALS},
            trained_items AS (SELECT DISTINCT "movieId" FROM split_ratings WHERE split = 'train')
            SELECT "userId", (SELECT least({TOP_N}, count(*)) FROM trained_items) AS n,
                   true AS as_mllib
            FROM split_ratings WHERE split = 'train' GROUP BY 1""",
        **(llm.ORACLES if llm else {}),
        **({"pipeline": corpus_pipeline.ORACLE_SQL} if llm and corpus_pipeline.ORACLE_SQL else {}),
    }
