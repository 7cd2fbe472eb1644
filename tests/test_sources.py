import logging

import pytest
from pyspark.sql import functions as F

from affinia import schemas as S
from affinia.operators.splitting import with_split
from affinia.plans import batch
from affinia.settings import session_conf
from affinia.sources import csv_files, landing, tables, workspace
from tests.conftest import tuples

CATALOG_TEXT = '''movieId,title,genres
1,Toy Story (1995),Adventure|Animation
11,"American President, The (1995)",Comedy|Drama|Romance
2,"""Great Performances"" Cats (1998)",Musical
3,No Genre (2000),(no genres listed)
4,,Drama
x,Bad Id,Drama
5,Short
6,Long,Drama,extra
'''
RATINGS_TEXT = "userId,movieId,rating,timestamp\n1,10,4.5,100\n1,11,oops,200\n3000000000,11,2.0,300\n"


@pytest.fixture
def data_dir(tmp_path):
    (tmp_path / "movies.csv").write_text(CATALOG_TEXT)
    (tmp_path / "ratings.csv").write_text(RATINGS_TEXT)
    return tmp_path


def test_catalog_cells(spark, data_dir):
    rows = {r[S.TITLE]: r for r in csv_files.read_catalog(spark, str(data_dir)).collect()}
    assert rows["American President, The (1995)"][S.ITEM] == 11
    assert rows['"Great Performances" Cats (1998)'][S.ITEM] == 2
    assert rows["Bad Id"][S.ITEM] is None
    assert rows["Short"][S.GENRES] is None
    assert rows["Long"][S.GENRES] == "Drama"
    assert rows[None][S.ITEM] == 4


def test_ratings_cells(spark, data_dir):
    ratings = csv_files.read_ratings(spark, str(data_dir))
    assert ratings.schema == S.RATINGS
    assert tuples(ratings) == tuples(
        spark.createDataFrame([(1, 10, 4.5, 100), (1, 11, None, 200), (None, 11, 2.0, 300)], S.RATINGS)
    )


def test_swapped_header_is_an_error(spark, tmp_path):
    (tmp_path / "ratings.csv").write_text("movieId,userId,rating,timestamp\n10,1,4.5,100\n")
    with pytest.raises(Exception, match="header"):
        csv_files.read_ratings(spark, str(tmp_path)).collect()


@pytest.mark.parametrize(
    ("reader", "name"),
    [(csv_files.read_ratings, "ratings.csv"), (csv_files.read_catalog, "movies.csv")],
)
def test_missing_file_is_named(spark, tmp_path, reader, name):
    with pytest.raises(FileNotFoundError, match=name):
        reader(spark, str(tmp_path))


def test_landing_skips_what_is_complete(spark, data_dir, tmp_path, caplog):
    (data_dir / "tags.csv").write_text("userId,movieId,tag,timestamp\n1,10,fun,5\n")
    base = str(tmp_path / "base")
    with caplog.at_level(logging.WARNING):
        assert landing.land_raw(spark, str(data_dir), base) == f"{base}/raw"
    assert "links.csv" in caplog.text
    assert landing.landed_ratings(spark, base).count() == 3
    assert tuples(spark.read.parquet(f"{base}/raw/tags")) == [("1", "10", "fun", "5")]

    (data_dir / "ratings.csv").write_text("userId,movieId,rating,timestamp\n")
    landing.land_raw(spark, str(data_dir), base)
    assert landing.landed_ratings(spark, base).count() == 3

    (tmp_path / "base" / "raw" / "ratings" / "_SUCCESS").unlink()
    landing.land_raw(spark, str(data_dir), base)
    assert landing.landed_ratings(spark, base).count() == 0


def test_missing_ratings_are_named(spark, tmp_path):
    (tmp_path / "movies.csv").write_text(CATALOG_TEXT)
    with pytest.raises(FileNotFoundError, match="ratings.csv"):
        batch.land(spark, str(tmp_path), str(tmp_path / "base"))


def test_load_statistics_count_incomplete_rows(spark, data_dir, tmp_path):
    ratings, _ = batch.land(spark, str(data_dir), str(tmp_path / "base"))
    found = batch.loaded(ratings).first()
    assert (found["ratings"], found["incomplete"]) == (3, 2)


def test_processed_keeps_rows(spark, ratings_of, tmp_path):
    split = with_split(ratings_of([(u, i, 3.0, 1) for u in range(20) for i in range(10)]))
    stored = landing.write_processed(split, str(tmp_path))
    assert tuples(stored.select(split.columns)) == tuples(split)
    assert {p.name for p in (tmp_path / "processed").glob("split=*")} == {"split=train", "split=test"}


def test_ids_are_checked(spark):
    table = spark.sql(
        "SELECT * FROM VALUES (1L, 1.0D), (1099511627776L, 2.0D), (3L, 1.5D), (NULL, 4.0D), (5L, 5.0D) AS t(u, i)"
    )
    ratings = tables.as_ratings(table, "u", "i", F.lit(3), F.lit(0))
    assert tuples(ratings.na.drop()) == [(1, 1, 3.0, 0), (5, 5, 3.0, 0)]
    assert tables.rejected_ids(table, "u", "i").count() == 3


def test_written_tables_are_in_the_shared_folder(spark, ratings_of):
    stored = workspace.written(ratings_of([(1, 2, 3.0, 4)]), "some")
    assert tuples(stored) == [(1, 2, 3.0, 4)]
    assert spark.conf.get("spark.checkpoint.dir") in stored.inputFiles()[0]


def test_staged_tables_are_deleted(spark, ratings_of):
    with workspace.staging(spark) as store:
        stored = store(ratings_of([(1, 2, 3.0, 4)]), "some")
        path = stored.inputFiles()[0]
        assert tuples(stored) == [(1, 2, 3.0, 4)]
        assert workspace.exists(spark, path)
    assert not workspace.exists(spark, path)


class _Cluster:
    """A session on a cluster, with or without a shared folder."""

    def __init__(self, folder):
        self.folder = folder
        self.conf = self.sparkContext = self
        self.master = "spark://host:7077"

    def get(self, key, default):
        return self.folder if key == "spark.checkpoint.dir" else default

    def getCheckpointDir(self):
        return None


def test_a_cluster_needs_a_shared_folder():
    assert workspace.new_folder(_Cluster("hdfs://name/shared/"), "x").startswith("hdfs://name/shared/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace.shared_folder(_Cluster(None))


def test_shuffle_partitions_suit_the_input():
    assert session_conf(10**6, 8)["spark.sql.shuffle.partitions"] == "8"
    assert session_conf(10**12, 8)["spark.sql.shuffle.partitions"] == "7451"
    assert session_conf(10**14, 8)["spark.sql.shuffle.partitions"] == "745059"
