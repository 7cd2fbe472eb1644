"""Mixing of sources to target weights by thresholds on document hashes.

The size of a document is its number of words. Sources in code point order
take the weights in turn and share ``SHARE`` of all words by them; a target stops
at ``MOST_REPEATS`` times its source, and what is left over goes to the others by
weight. A source is taken whole as often as its target allows, and the rest of
the budget is met by the documents whose hash is below a threshold: budgets
are nested, so a larger one takes all documents of a smaller one.

The threshold is found without sorting documents. Words are summed by source and
leading hash bits; the bucket in which the budget runs out is cut by the next bits,
and so on through all 60 bits. Only its rows are read for that. The
documents at the last threshold itself are taken if that brings the total closer.

Only DataFrame functions are used. Sums are reduced before each shuffle, so a
source with most of the rows costs no more than the others. One
row per source is sorted in one task.

Defined results: a null text has size 0; a null source is a source and comes
last; repeated rows have one hash and are taken or left together; a row without
doc_id is hashed by its text; an empty table gives no rows. Other columns do
not matter.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinia.llm.columns import unused
from affinia.sources.workspace import written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_REPEATS = 2
HASH_DIGITS = 15  # hexadecimal, of md5
LEVEL_BITS = 12
LEVELS = 5
_BUCKETS = 1 << LEVEL_BITS

_SPACES = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_SPACES)), F.lit(0)).cast("long")


def _hash(doc_id: Column, text: Column) -> Column:
    name = F.coalesce(doc_id.cast("string"), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(name), 1, HASH_DIGITS), 16, 10).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """Narrow rows (doc_id, source, size, hash) of all documents."""
    return docs.select(
        "doc_id",
        "source",
        word_count(F.col("text")).alias("size"),
        _hash(F.col("doc_id"), F.col("text")).alias("hash"),
    )


def targets(
    sizes: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST_REPEATS,
) -> DataFrame:
    """Rows (source, source_size, target, times, rest) for each source.

    ``times`` is how often it is taken whole, ``rest`` the words after that.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = ((F.row_number().over(in_order) - 1) % len(weights) + 1).cast("int")
    choices = F.array(*(F.lit(float(w)) for w in weights))
    sums = sums.withColumn("weight", F.element_at(choices, turn))
    sums = sums.withColumn("cap", (F.col("source_size") * most).cast("double"))
    sums = sums.withColumn("level", F.col("cap") / F.col("weight"))
    # A source is full if the water stands at its level before the budget is spent.
    upto = Window.orderBy("level", F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    everything = Window.orderBy(F.lit(1)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    budget = F.sum("source_size").over(everything) * F.lit(float(share))
    below = F.sum("cap").over(upto)
    open_weight = F.sum("weight").over(everything) - F.sum("weight").over(upto)
    sums = sums.withColumn("budget", budget)
    sums = sums.withColumn("full", below + F.col("level") * open_weight <= F.col("budget"))
    spent = F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(everything)
    shared = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(everything)
    height = (F.col("budget") - spent) / shared
    target = F.when(F.col("full"), F.col("cap")).otherwise(height * F.col("weight"))
    sums = sums.withColumn("target", target)
    times = F.when(F.col("source_size") == 0, 0).otherwise(F.floor(F.col("target") / F.col("source_size")))
    sums = sums.withColumn("times", times.cast("long"))
    rest = F.col("target") - F.col("times") * F.col("source_size")
    return sums.select("source", "source_size", "target", "times", rest.alias("rest"))


def _bucket(level: int) -> Column:
    return F.shiftright("hash", LEVEL_BITS * (LEVELS - 1 - level)) % _BUCKETS


def thresholds(sizes: DataFrame, budgets: DataFrame) -> DataFrame:
    """Rows (source, threshold, whole) for budgets (source, rest).

    Documents below the threshold are taken, those at it if ``whole``.
    """
    state = budgets.select(
        "source", "rest", F.lit(0).cast("long").alias("threshold"), F.lit(0).cast("long").alias("edge")
    )
    rows = sizes
    for level in range(LEVELS):
        sums = rows.groupBy("source", _bucket(level).alias("bucket")).agg(F.sum("size").alias("n"))
        running = Window.partitionBy("source").orderBy("bucket")
        sums = sums.withColumn("upto", F.sum("n").over(running))
        known = state.withColumnRenamed("source", "of")
        both = sums.join(known, _null_safe("source", "of"))
        over = F.col("upto") > F.col("rest")
        edge = F.min(F.when(over, F.struct("bucket", "n", (F.col("upto") - F.col("n")).alias("below"))))
        cut = both.groupBy("source").agg(edge.alias("edge"))
        cut = cut.select(F.col("source").alias("of"), "edge.*")
        # Without such a bucket all of the source is below the threshold.
        shift = 1 << (LEVEL_BITS * (LEVELS - 1 - level))
        joined = state.drop("edge").join(cut, _null_safe("source", "of"), "left")
        bucket = F.coalesce("bucket", F.lit(_BUCKETS if level == 0 else 0))
        state = written(
            joined.select(
                "source",
                (F.col("rest") - F.coalesce("below", F.lit(0))).alias("rest"),
                (F.col("threshold") + bucket * shift).alias("threshold"),
                F.coalesce("n", F.lit(0)).cast("long").alias("edge"),
            ),
            "thresholds",
        )
        if level < LEVELS - 1:
            low = state.select(F.col("source").alias("of"), "threshold")
            inside = rows.join(low, _null_safe("source", "of"))
            same = F.shiftright("hash", LEVEL_BITS * (LEVELS - 1 - level)) == F.shiftright(
                "threshold", LEVEL_BITS * (LEVELS - 1 - level)
            )
            rows = written(inside.where(same).select("source", "size", "hash"), "boundary")
    return state.select("source", "threshold", (F.col("rest") * 2 > F.col("edge")).alias("whole"))


def _null_safe(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _planned(sizes: DataFrame, **how) -> DataFrame:
    """One row per source: what it is taken whole, and its threshold."""
    plan = written(targets(sizes, **how), "targets")
    cuts = thresholds(sizes, plan.select("source", "rest")).withColumnRenamed("source", "of")
    plan = plan.join(cuts, _null_safe("source", "of")).drop("of")
    return written(plan.withColumnRenamed("source", "of"), "plan")


def _copies(name: Column, plan: str = "") -> Column:
    """How often a document is taken. Where its source has no words left to give, also empty ones get no more."""
    times, rest, threshold, whole = (F.col(f"{plan}{x}") for x in ("times", "rest", "threshold", "whole"))
    hit = (rest > 0) & ((name < threshold) | ((name == threshold) & whole))
    return times + hit.cast("long")


def mix(docs: DataFrame, **how) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken."""
    sizes = written(sized(docs), "sizes")
    rows = sizes.join(_planned(sizes, **how), _null_safe("source", "of"))
    rows = rows.withColumn("copies", _copies(F.col("hash")))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return rows.select("doc_id", "source", "size", "source_size", "target", "copies", taken)


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The documents that the mix takes, with how often (``copies``) and their words (``taken``).

    Columns of these two names are replaced, all others are kept, whatever they are called. An empty
    document of a source that is taken has copies and no words; none has more than ``most`` copies.
    Documents of a source without any words, or with target 0, are not taken.
    """
    plan_name, of = unused(docs, "plan", "of")
    plan = _planned(written(sized(docs), "sizes"), **how)
    plan = plan.select(F.struct("times", "rest", "threshold", "whole").alias(plan_name), F.col("of").alias(of))
    columns = [F.col(f"`{name}`") for name in docs.columns if name.lower() not in ("copies", "taken")]
    rows = docs.select(*columns).join(plan, _null_safe("source", of))
    copies = _copies(_hash(F.col("doc_id"), F.col("text")), f"{plan_name}.")
    rows = rows.select(*columns, copies.alias("copies")).where("copies > 0")
    return rows.select("*", (F.col("copies") * word_count(F.col("text"))).alias("taken"))
