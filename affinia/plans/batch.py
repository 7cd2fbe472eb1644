"""The batch job: from ratings to a stored model and answers."""

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinia import schemas as S
from affinia.operators.activity import dataset_stats, service_stats
from affinia.operators.cleaning import clean
from affinia.operators.factorize import evaluate, fit
from affinia.operators.recommend import recommend_all_users, top_n_for_user
from affinia.operators.similar import similar_items
from affinia.operators.splitting import side, with_split
from affinia.plans.payloads import metrics_answer
from affinia.settings import SEED, SMALL_DEFAULTS, TOP_N, Preset
from affinia.sources.landing import land_raw, landed_catalog, landed_ratings, write_processed
from affinia.sources.models import ITEMS, USERS, load_model, model_path, read_factors, read_vector
from affinia.sources.models import save_model, write_recommendations
from affinia.sources.workspace import staging


@dataclass(frozen=True)
class Trained:
    """A stored model and its errors on the ratings that were held out."""

    model: ALSModel
    metrics: DataFrame
    path: str


@dataclass(frozen=True)
class Answers:
    """A trained model with answers for one user and one item."""

    trained: Trained
    recommended: DataFrame
    similar: DataFrame
    report: DataFrame


def loaded(ratings: DataFrame) -> DataFrame:
    """Statistics of landed ratings, and how many rows have a cell that is missing or did not fit."""
    incomplete = reduce(or_, (F.col(name).isNull() for name in ratings.columns))
    count = ratings.agg(F.count_if(incomplete)).scalar()
    return dataset_stats(ratings).withColumn("incomplete", count)


def report(ratings: DataFrame, trained: "Trained") -> DataFrame:
    """What loading and training tell their caller, in one row.

    ``data`` has the statistics of the landed ratings, ``model`` the errors of the model as they are
    reported, with the numbers of held-out ratings that were scored and that there are.
    """
    data = loaded(ratings).select(F.struct("*").alias("data"))
    model = metrics_answer(trained.metrics).select(F.struct("*").alias("model"))
    return data.withColumn("model", model.scalar())


def land(spark: SparkSession, data_dir: str, base: str) -> tuple[DataFrame, DataFrame]:
    """Land the input files and read them back as ratings and catalogue."""
    land_raw(spark, data_dir, base)
    return landed_ratings(spark, base), landed_catalog(spark, base)


def train(
    ratings: DataFrame,
    base: str,
    preset: Preset = SMALL_DEFAULTS,
    seed: int = SEED,
    blocks: int | None = None,
) -> Trained:
    """Clean and split ratings, fit a model, store it and measure it.

    The cleaned ratings are written first, and the model is read back from its
    files: fit, evaluation and answers each start from stored tables.
    """
    spark = ratings.sparkSession
    with staging(spark) as store:
        split = write_processed(with_split(clean(ratings, preset, store)), base)
    params = {
        "rank": preset.rank,
        "max_iter": preset.max_iter,
        "reg_param": preset.reg_param,
        "alpha": preset.alpha,
        "seed": seed,
        "blocks": blocks or preset.blocks,
    }
    model = fit(side(split, S.TRAIN), **params)
    path = save_model(spark, model, model_path(base), params)
    stored = load_model(path)
    return Trained(stored, evaluate(stored, side(split, S.TEST)), path)


def recommend(
    ratings: DataFrame, catalog: DataFrame, base: str, user_id: int, n: int = TOP_N
) -> DataFrame:
    """Recommendations for one user from the stored model: one vector is read, and all items."""
    spark, path = catalog.sparkSession, model_path(base)
    user, items = read_vector(spark, path, user_id, USERS), read_factors(spark, path, ITEMS)
    return top_n_for_user(ratings, catalog, user, items, user_id, n)


def similar(catalog: DataFrame, base: str, movie_id: int, n: int = TOP_N) -> DataFrame:
    """Items similar to one item from the stored model."""
    items = read_factors(catalog.sparkSession, model_path(base), ITEMS)
    return similar_items(items, catalog, movie_id, n)


def statistics(ratings: DataFrame, catalog: DataFrame, base: str) -> DataFrame:
    """Service statistics, with the rank of the stored model."""
    return service_stats(ratings, catalog, load_model(model_path(base)).rank)


def recommend_everyone(
    ratings: DataFrame, catalog: DataFrame, base: str, n: int = TOP_N
) -> str:
    """Store recommendations of unseen items for all users of the stored model."""
    model = load_model(model_path(base))
    found = recommend_all_users(model.userFactors, model.itemFactors, catalog, n, seen=ratings)
    return write_recommendations(found, base)


def full(
    ratings: DataFrame,
    catalog: DataFrame,
    base: str,
    user_id: int = 1,
    movie_id: int = 1,
    n: int = TOP_N,
    preset: Preset = SMALL_DEFAULTS,
    seed: int = SEED,
    blocks: int | None = None,
) -> Answers:
    """Train, then answer for one user and one item."""
    trained = train(ratings, base, preset, seed, blocks)
    return Answers(
        trained,
        recommend(ratings, catalog, base, user_id, n),
        similar(catalog, base, movie_id, n),
        report(ratings, trained),
    )
