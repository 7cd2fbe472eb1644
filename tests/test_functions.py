import math

import pytest
from pyspark.sql import functions as F

from affinia.functions.genres import genre_label, genre_list
from affinia.functions.rounding import rounded
from affinia.functions.vectors import cosine, dot, norm
from affinia.settings import clamp_top_n


def test_dot(spark):
    rows = spark.createDataFrame(
        [([0.1, 0.2, 0.3], [1.0, 2.0, 3.0]), ([1.0, 2.0], [1.0, 2.0, 3.0]), (None, [1.0, 2.0, 3.0])],
        "a array<float>, b array<float>",
    )
    values = [r[0] for r in rows.select(dot(F.col("a"), F.col("b"))).collect()]
    assert values[0] == pytest.approx(1.4, abs=1e-6)
    assert values[1:] == [None, None]


def test_cosine_and_norm(spark):
    rows = spark.createDataFrame(
        [([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<float>, b array<float>"
    )
    values = [r[0] for r in rows.select(cosine(F.col("a"), F.col("b"))).collect()]
    assert values == [pytest.approx(math.sqrt(0.5)), 0.0]
    assert rows.select(norm(F.col("b"))).first()[0] == pytest.approx(math.sqrt(2))


def test_genres(spark):
    rows = spark.createDataFrame([("Action|Drama",), ("Solo",), ("",), (None,)], "g string")
    found = rows.select(genre_list(F.col("g")), genre_label(F.col("g"))).collect()
    assert [tuple(r) for r in found] == [
        (["Action", "Drama"], "Action, Drama"),
        (["Solo"], "Solo"),
        ([], "?"),
        ([], "?"),
    ]


def test_rounded(spark):
    row = spark.sql("SELECT CAST(4.87654 AS FLOAT) AS p").select(rounded(F.col("p"), 3)).first()
    assert row[0] == 4.877


@pytest.mark.parametrize(("asked", "given"), [(-3, 1), (0, 1), (1, 1), (50, 50), (51, 50)])
def test_clamp(asked, given):
    assert clamp_top_n(asked) == given
    assert clamp_top_n() == 10
