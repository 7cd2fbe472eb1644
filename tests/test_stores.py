"""Published versions, reads by key, rejected rows, life of tables between steps."""

import pytest
from pyspark.sql import functions as F

from affinia import schemas as S
from affinia.sources import csv_files, keyed, landing, models, published, workspace
from tests.conftest import tuples


def _scans(df):
    """Rows and files that each scan of an executed plan has read."""
    df.collect()
    found, waiting = [], [df._jdf.queryExecution().executedPlan()]
    while waiting:
        node = waiting.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            waiting.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            waiting.append(node.plan())
        elif kind == "FileSourceScanExec":
            metrics = node.metrics()
            found.append(tuple(metrics.apply(name).value() for name in ("numOutputRows", "numFiles")))
        children = node.children()
        waiting += [children.apply(i) for i in range(children.length())]
    return found


@pytest.fixture(scope="module")
def factors(spark):
    vector = F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: F.sin(F.col("id") * i).cast("float"))
    return spark.range(40_000).select((F.col("id") * 3).cast("int").alias(S.ID), vector.alias(S.FEATURES))


def test_one_id_reads_one_row_group(spark, factors, tmp_path):
    models.write_factors(factors, str(tmp_path), rows_in_folder=10_000)
    (files,) = [list(folder.glob("*.parquet")) for folder in tmp_path.glob("versions/*/_folders=4/_folder=1")]
    groups = sum(spark._jvm.org.apache.parquet.hadoop.ParquetFileReader.open(
        spark._jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(
            spark._jvm.org.apache.hadoop.fs.Path(str(file)), spark._jsc.hadoopConfiguration()
        )
    ).getRowGroups().size() for file in files)
    assert groups > 1
    one = models.read_vector(spark, str(tmp_path), 20_001)
    ((rows, n_files),) = _scans(one)
    assert n_files == 1 and rows < 10_000 / 2
    expected = factors.where("id = 20001").first()
    assert (one.first()[S.ID], one.first()[S.FEATURES]) == tuple(expected)
    assert one.first()[S.LENGTH] == pytest.approx(sum(x * x for x in expected[S.FEATURES]) ** 0.5)
    assert models.read_vector(spark, str(tmp_path), 20_000).count() == 0
    assert models.read_vector(spark, str(tmp_path), -5).count() == 0
    whole = models.read_factors(spark, str(tmp_path))
    assert whole.count() == 40_000 and whole.columns == [S.ID, S.FEATURES, S.LENGTH]


def test_keyed_tables_of_odd_rows(spark, tmp_path):
    rows = [(None, 1), (None, 2), (-7, 1), (-7, 1), (2**31 - 1, 4)] + [(5, i) for i in range(100)]
    table = spark.createDataFrame(rows, "k int, v int")
    keyed.publish_keyed(table, str(tmp_path / "a"), "k", "v", rows_in_folder=20)
    assert tuples(keyed.read_keyed(spark, str(tmp_path / "a"))) == sorted(rows, key=repr)
    read = lambda k: [row["v"] for row in keyed.read_key(spark, str(tmp_path / "a"), "k", k).collect()]
    assert read(-7) == [1, 1] and read(2**31 - 1) == [4] and read(5) == list(range(100)) and read(6) == []
    keyed.publish_keyed(table.limit(0), str(tmp_path / "b"), "k")
    assert keyed.read_key(spark, str(tmp_path / "b"), "k", 5).count() == 0


def _failing(df):
    """The same rows, but the last partition dies while it is written."""
    return df.repartition(4).select("*", F.assert_true(F.spark_partition_id() < 3).alias("ok")).drop("ok").where(
        F.assert_true(F.spark_partition_id() < 3).isNull()
    )


def test_a_write_that_dies_leaves_the_old_version(spark, tmp_path):
    base = str(tmp_path / "recs")
    table = spark.createDataFrame([(i, i) for i in range(100)], "k int, v int")
    write = lambda df: published.publish(spark, base, lambda path: df.write.parquet(path))
    write(table)
    before = spark.read.parquet(published.current(spark, base))
    with pytest.raises(Exception, match="is not true|USER_RAISED"):
        write(_failing(table.withColumn("v", F.lit(0))))
    assert len(published.versions(spark, base)) == 2  # what was written half-way is there, and nobody reads it
    assert tuples(spark.read.parquet(published.current(spark, base))) == tuples(table) == tuples(before)
    write(table.withColumn("v", F.lit(1)))
    assert spark.read.parquet(published.current(spark, base)).agg(F.sum("v")).first()[0] == 100
    write(table.withColumn("v", F.lit(2)))
    assert spark.read.parquet(published.current(spark, base)).agg(F.sum("v")).first()[0] == 200
    assert len(published.versions(spark, base)) == published.KEPT
    assert not list(tmp_path.glob("recs/.CURRENT-*"))


def test_a_reader_of_the_version_before_goes_on(spark, tmp_path):
    table = spark.createDataFrame([(1, 1.0)], "id int, v double")
    keyed.publish_keyed(table, str(tmp_path), "id")
    old = keyed.read_keyed(spark, str(tmp_path))
    keyed.publish_keyed(table.withColumn("v", F.lit(2.0)), str(tmp_path), "id")
    assert tuples(old) == [(1, 1.0)]
    assert tuples(keyed.read_keyed(spark, str(tmp_path))) == [(1, 2.0)]


def test_what_was_not_published_is_read_as_it_is(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "plain"))
    assert published.current(spark, str(tmp_path / "plain")) == str(tmp_path / "plain")
    assert published.versions(spark, str(tmp_path / "plain")) == []


def test_rejected_rows_are_kept_with_their_cause(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = ["userId,movieId,rating,timestamp", "1,10,4.5,100", "1,11,oops,200", "3000000000,11,2.0,x", "1,2", "1,2,3.0,4,5", "7,,2.0,3"]
    (tmp_path / "in" / "ratings.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "in" / "movies.csv").write_text('movieId,title,genres\n1,"A, b",Drama\nx,Bad,Drama\n')
    base = str(tmp_path / "base")
    assert landing.landed_rejects(spark, base).count() == 0
    landing.land_raw(spark, str(tmp_path / "in"), base)
    found = landing.landed_rejects(spark, base)
    assert tuples(found) == sorted([
        ("movies.csv", "movies.csv", "no value for movieId", "x,Bad,Drama"),
        ("ratings.csv", "ratings.csv", "no value for rating", lines[2]),
        ("ratings.csv", "ratings.csv", "no value for userId,timestamp", lines[3]),
        ("ratings.csv", "ratings.csv", "no value for rating,timestamp", lines[4]),
        ("ratings.csv", "ratings.csv", "number of cells", lines[5]),
    ], key=repr)
    ratings = landing.landed_ratings(spark, base)
    assert ratings.schema == S.RATINGS and ratings.count() == 6
    assert csv_files.read_ratings(spark, str(tmp_path / "in")).columns == S.RATINGS.names


def test_tables_of_a_block_are_deleted_and_kept_ones_stay(spark):
    with workspace.temporary(spark) as outer_keep:
        with workspace.temporary(spark) as keep:
            inner = workspace.written(spark.range(5), "inner")
            result = keep(inner.where("id > 2"), "result")
            paths = [df.inputFiles()[0] for df in (inner, result)]
        assert [workspace.exists(spark, path) for path in paths] == [False, True]
        last = outer_keep(result.where("id > 3"), "last")
    assert not workspace.exists(spark, paths[1])
    assert tuples(last) == [(4,)]
    with pytest.raises(ValueError):
        with workspace.temporary(spark):
            path = workspace.written(spark.range(5), "failed").inputFiles()[0]
            raise ValueError
    assert not workspace.exists(spark, path)
