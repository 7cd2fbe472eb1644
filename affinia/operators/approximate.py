"""Similar items by hashing, for catalogues whose exact search over all pairs takes too long.

Directions of vectors are hashed by random projections. A key joins several projections, and
each table has keys of its own: items that share a key in any table are candidates, whose
exact cosines decide. A bucket is searched where its items are and gives a short list for each; pairs are not formed. A bucket with more than ``most`` items is cut by further projections. Items of
buckets that stay too large, and items with too few candidates, are searched exactly, so
every item gets as many rows as the exact search gives it. Only what is found may differ.

Items with equal vectors are hashed once and listed together, however many they are.
"""

from functools import partial

from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from affinia import schemas as S
from affinia.functions.vectors import cosine_from, dot, norm
from affinia.operators import nearest
from affinia.operators.grid import top_n
from affinia.operators.lookup import in_catalog, with_titles
from affinia.operators.scoring import usable
from affinia.settings import SEED, TOP_N
from affinia.sources.workspace import written

TABLES = 12
PROJECTIONS = (3, 6, 9)  # joined in a key, at first and for buckets that are too large
WIDTH = 0.4  # of a step along a projection; directions have length 1
MOST_IN_BUCKET = 2_000


def _classes(factors: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """Ids with the least id that has the same vector (``rep``), and the first n + 1 ids of each vector.

    The filter on the row number lets every task drop all but so many before the shuffle.
    """
    same = F.xxhash64(S.FEATURES).alias("digest")
    rows = factors.select(S.ID, S.FEATURES, same, norm(F.col(S.FEATURES)).alias(S.LENGTH))
    by_vector = W.partitionBy("digest", S.FEATURES).orderBy(S.ID)
    first = rows.withColumn("number", F.row_number().over(by_vector)).where(F.col("number") <= n + 1)
    first = written(first, "first-of-vector")
    reps = first.where("number = 1").select(F.col(S.ID).alias("rep"), S.FEATURES, S.LENGTH, "digest")
    members = first.join(reps.select("rep", "digest", S.FEATURES), ["digest", S.FEATURES])
    return reps.drop("digest"), members.select("rep", S.ID)


def _keys(reps: DataFrame, tables: int, width: float, depths: tuple[int, ...], seed: int) -> DataFrame:
    """Rows (rep, table, keys): the keys of each depth."""
    unit = F.transform(S.FEATURES, lambda x: x.cast("double") / F.col(S.LENGTH))
    rows = reps.where(F.col(S.LENGTH) > 0).select("rep", array_to_vector(unit).alias("unit"))
    deepest = depths[-1]
    hashing = BucketedRandomProjectionLSH(
        inputCol="unit", outputCol="hashes", bucketLength=width, numHashTables=tables * deepest, seed=seed
    )
    hashed = hashing.fit(rows).transform(rows)
    steps = F.transform("hashes", lambda x: F.get(vector_to_array(x), F.lit(0)).cast("int"))
    key = lambda table, depth: F.xxhash64(F.slice("steps", table * deepest + 1, F.lit(depth)))
    of_table = lambda table: F.array(*(key(table, depth) for depth in depths))
    all_tables = F.transform(F.sequence(F.lit(0), F.lit(tables - 1)), of_table)
    return hashed.select("rep", steps.alias("steps")).select("rep", F.posexplode(all_tables).alias("table", "keys"))


def _buckets(keys: DataFrame, depths: tuple[int, ...], most: int) -> tuple[DataFrame, DataFrame]:
    """Rows (rep, table, key) of buckets that are small enough at some depth, and the reps of the others."""
    each = keys.select("rep", "table", F.posexplode("keys").alias("depth", "key"))
    sizes = each.groupBy("table", "depth", "key").agg(F.count("*").alias("n"))
    small = sizes.where(F.col("n") <= most).select("table", "depth", "key")
    fitting = each.join(small, ["table", "depth", "key"])
    first = fitting.groupBy("rep", "table").agg(F.min(F.struct("depth", "key")).alias("x"))
    placed = written(first.select("rep", "table", "x.depth", "x.key"), "buckets")
    every = keys.select("rep", "table")
    return placed, every.join(placed, ["rep", "table"], "left_anti").select("rep").distinct()


def _score(left: str, right: str) -> Column:
    product = dot(F.col(f"{left}.{S.FEATURES}"), F.col(f"{right}.{S.FEATURES}"))
    return cosine_from(product, F.col(f"{left}.{S.LENGTH}"), F.col(f"{right}.{S.LENGTH}"))


def top_n_approx(
    factors: DataFrame,
    n: int = TOP_N,
    tables: int = TABLES,
    width: float = WIDTH,
    depths: tuple[int, ...] = PROJECTIONS,
    most: int = MOST_IN_BUCKET,
    seed: int = SEED,
) -> DataFrame:
    """Rows (left, right, score, rank) of n similar items for every item with a vector.

    ``factors`` have each id once. More tables or wider steps find more and compare more.
    """
    factors = written(usable(factors).select(S.ID, S.FEATURES), "vectors")
    reps, members = _classes(factors, n)
    reps, members = written(reps, "reps"), written(members, "members")
    if reps.where(F.col(S.LENGTH) > 0).isEmpty():
        return top_n(factors, factors, n, cosine=True, skip_self=True)
    placed, crowded = _buckets(written(_keys(reps, tables, width, depths, seed), "keys"), depths, most)
    bucket = F.xxhash64("table", "depth", "key").alias("bucket")
    bucketed = placed.join(reps, "rep").select(bucket, F.col("rep").cast("int"), S.FEATURES)
    bucketed = bucketed.repartition("bucket").sortWithinPartitions("bucket")
    pairs = bucketed.mapInArrow(partial(nearest.search_buckets, n=n + 1), "rep int, other int, score double")
    # A vector's own copies are as similar as can be.
    own = reps.where(F.col(S.LENGTH) > 0).alias("a").join(reps.alias("b"), F.col("a.rep") == F.col("b.rep"))
    own = own.select(F.col("a.rep").alias("rep"), F.col("a.rep").alias("other"), _score("a", "b").alias("score"))
    best_first = W.partitionBy("rep").orderBy(F.desc("score"), "other")
    # A pair that shares several buckets has the same score, and so the same rank, each time.
    pairs = pairs.unionByName(own).withColumn("number", F.dense_rank().over(best_first))
    listed = pairs.where(F.col("number") <= n + 1).select("rep", "other", "score").dropDuplicates(["rep", "other"])
    of_other = members.select(F.col("rep").alias("other"), F.col(S.ID).alias("right"))
    by_score = W.partitionBy("rep").orderBy(F.desc("score"), "right")
    listed = listed.join(of_other, "other").withColumn("number", F.row_number().over(by_score))
    listed = written(listed.where(F.col("number") <= n + 1).select("rep", "right", "score"), "listed")
    # All ids of a vector have its list, without themselves; those with too short a list are searched exactly.
    enough = listed.groupBy("rep").agg(F.count("*").alias("n")).where(F.col("n") > n).select("rep")
    enough = enough.join(crowded, "rep", "left_anti")
    ids = factors.join(reps.select("rep", F.col(S.FEATURES).alias("vector")), F.col("vector").eqNullSafe(F.col(S.FEATURES)))
    ids = written(ids.select("rep", F.col(S.ID).alias("left")).join(enough, "rep"), "hashed-items")
    best_right = W.partitionBy("left").orderBy(F.desc("score"), "right")
    found = ids.join(listed, "rep").where("left <> right").withColumn(S.RANK, F.row_number().over(best_right))
    found = found.where(F.col(S.RANK) <= n).select("left", "right", "score", S.RANK)
    others = factors.join(ids, factors[S.ID] == ids["left"], "left_anti")
    return found.unionByName(top_n(others, factors, n, cosine=True, skip_self=True))


def similar_items_approx(item_factors: DataFrame, catalog: DataFrame, n: int = TOP_N, **how) -> DataFrame:
    """About the n most similar catalogue items for every catalogue item, with exact cosines."""
    found = top_n_approx(in_catalog(item_factors, catalog), n, **how)
    ranked = found.select(
        F.col("left").alias("target_id"), S.RANK, F.col("right").alias(S.ITEM), F.col("score").alias(S.SIMILARITY)
    )
    return with_titles(ranked, catalog)


def recall(found: DataFrame, exact: DataFrame, keys: list[str]) -> DataFrame:
    """Share of the exact rows that were found."""
    hits = exact.join(found.select(*keys).withColumn("_found", F.lit(1)), keys, "left")
    return hits.agg(F.count("*").alias("n_exact"), F.avg(F.coalesce("_found", F.lit(0))).alias("recall"))
