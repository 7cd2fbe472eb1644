import pytest
from pyspark.sql import SparkSession

from affinia import schemas as S


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("affinia-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def ratings_of(spark):
    return lambda rows: spark.createDataFrame(rows, S.RATINGS)


@pytest.fixture
def catalog_of(spark):
    return lambda rows: spark.createDataFrame(rows, S.CATALOG)


@pytest.fixture
def factors_of(spark):
    return lambda rows: spark.createDataFrame(rows, S.FACTORS)


def tuples(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)
