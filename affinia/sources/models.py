"""Models, their factors, and recommendations, published in versions."""

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinia import schemas as S
from affinia.functions.vectors import norm
from affinia.sources.keyed import publish_keyed, read_key, read_keyed, write_keyed
from affinia.sources.published import current, publish

# Default places below a base folder.
MODEL_FOLDER = "models/als_recommender"
RECOMMENDATIONS_FOLDER = "output/recommendations"

USERS, ITEMS = "factors/users", "factors/items"  # below the folder of a model

_PARAMS = "fit_params"


def model_path(base: str) -> str:
    return f"{base.rstrip('/')}/{MODEL_FOLDER}"


def save_model(spark: SparkSession, model: ALSModel, path: str, params: dict | None = None) -> str:
    """Publish a model, and the parameters it was fitted with, in place of any older one.

    MLlib does not keep the parameters of the fit, so they go into a one-row
    table inside the model folder. Both factor tables are stored once more, for reads by id. The older
    model is served until the new one is complete.
    """

    def write(version: str) -> None:
        model.write().save(version)
        write_keyed(with_length(model.userFactors), f"{version}/{USERS}", S.ID)
        write_keyed(with_length(model.itemFactors), f"{version}/{ITEMS}", S.ID)
        if params:
            spark.createDataFrame([params]).coalesce(1).write.json(f"{version}/{_PARAMS}")

    publish(spark, path, write)
    return path


def load_model(path: str) -> ALSModel:
    """The current model at a path, also one that MLlib itself has saved there."""
    return ALSModel.load(current(SparkSession.active(), path))


def load_params(spark: SparkSession, path: str) -> DataFrame:
    """The parameters that ``save_model`` kept."""
    return spark.read.json(f"{current(spark, path)}/{_PARAMS}")


def with_length(factors: DataFrame) -> DataFrame:
    """Factors with the length of every vector."""
    return factors.withColumn(S.LENGTH, norm(F.col(S.FEATURES)))


def write_factors(factors: DataFrame, base: str, **how) -> str:
    """Publish any table of factors for reads by id, with lengths."""
    return publish_keyed(with_length(factors), base, S.ID, **how)


def read_factors(spark: SparkSession, base: str, side: str = "") -> DataFrame:
    """Factors that ``write_factors`` has published, or those of one side of a saved model."""
    return read_keyed(spark, f"{current(spark, base)}/{side}")


def read_vector(spark: SparkSession, base: str, key: int, side: str = "") -> DataFrame:
    """The row of one id, or none; one row group of one file is read."""
    return read_key(spark, f"{current(spark, base)}/{side}", S.ID, key)


def write_recommendations(recommendations: DataFrame, base: str) -> str:
    """Publish recommendations for serving, a user's rows together and in order."""
    path = f"{base.rstrip('/')}/{RECOMMENDATIONS_FOLDER}"
    publish_keyed(recommendations, path, S.USER, S.RANK)
    return path


def read_recommendations(spark: SparkSession, base: str) -> DataFrame:
    return read_keyed(spark, f"{base.rstrip('/')}/{RECOMMENDATIONS_FOLDER}")


def read_recommendations_of(spark: SparkSession, base: str, user_id: int) -> DataFrame:
    """The stored recommendations of one user, by a read of that user's row group."""
    return read_key(spark, f"{base.rstrip('/')}/{RECOMMENDATIONS_FOLDER}", S.USER, user_id)
