"""URL filter: rules first, then logistic regression on hashed character n-grams.

A URL is cut into host and path. Rules name a host and the beginning of a path; the
longest that fits gives the verdict. Where none fits, a logistic regression does
that was trained on a table of labelled URLs: n-grams of three and four
characters of host and path, with the ends marked, hashed to ``FEATURES`` weights. The table is
a parameter; ``url_table`` is the default. ``held_out`` measures it on hosts that were not learned.

Only DataFrame functions and MLlib's estimator are used. Training reads the
labelled table alone, scoring one column of the pages. N-grams are cut from an array of
characters, so the work grows with the length of a URL and not with its square.

Defined results: a null URL, or one without ``://``, has an empty host and path, fits no
rule and is judged by the model on empty strings; repeated rows are judged
alike; an empty table gives no rows; other columns do not matter.
"""

from functools import reduce

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.llm import url_table

FEATURES = 1 << 16
SIZES = (3, 4)
STEPS = 25  # of the optimiser
BLOCKED_SHARE = 0.1
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Host, beginning of the path, verdict.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

def _after_scheme(url: Column) -> Column:
    at = F.instr(url, F.lit("://"))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    host = F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER)
    return F.coalesce(host, F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(rest, F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null without one."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, start, decision in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(start)
        name = F.when(fits, rule_host + start).otherwise(name)
        verdict = F.when(fits, decision).otherwise(verdict)
    return name, verdict


def _grams(text: Column, mark: str) -> Column:
    """N-grams of a text between its ends, each with the mark of its part."""
    characters = F.split(F.concat(F.lit("^"), text, F.lit("$")), "")
    characters = F.filter(characters, lambda c: c != "")
    parts = []
    for size in SIZES:
        columns = [F.slice(characters, i + 1, F.size(characters)) for i in range(size)]
        # Rows of ``size`` neighbouring characters; the last ones lack some and are dropped.
        zipped = F.arrays_zip(*(c.alias(f"c{i}") for i, c in enumerate(columns)))
        whole = F.filter(zipped, lambda g: g[f"c{size - 1}"].isNotNull())
        parts.append(
            F.transform(whole, lambda g: F.concat(F.lit(mark), *(g[f"c{i}"] for i in range(size))))
        )
    return F.concat(*parts)


def _features(rows: DataFrame) -> DataFrame:
    grams = F.concat(_grams(F.col("host"), "h:"), _grams(F.col("path"), "p:"))
    hashed = HashingTF(inputCol="grams", outputCol="features", numFeatures=FEATURES, binary=True)
    return hashed.transform(rows.withColumn("grams", grams)).drop("grams")


def _cut(table: DataFrame, *others: str) -> DataFrame:
    return table.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), *others)


def train(table: DataFrame) -> LogisticRegressionModel:
    """A model of a labelled table (url, label). Rows without a label are left out.

    Rows are weighed so that ``BLOCKED_SHARE`` of the weight is to be blocked, as if URLs were met at random: what
    is like nothing in the table is then allowed.
    """
    rows = _cut(table, F.col("label").cast("double").alias("label")).where("label IS NOT NULL")
    share = rows.agg(F.avg("label")).first()[0]
    if share is None or share in (0.0, 1.0):
        raise ValueError("a model needs URLs of both labels")
    weight = F.when(F.col("label") == 1, BLOCKED_SHARE / share).otherwise((1 - BLOCKED_SHARE) / (1 - share))
    estimator = LogisticRegression(
        regParam=0.0002, maxIter=STEPS, standardization=False, weightCol="weight"
    )
    return estimator.fit(_features(rows.withColumn("weight", weight)))


def held_out(table: DataFrame, folds: int = 5) -> DataFrame:
    """Precision and recall of blocking on hosts that a model has not learned, over all folds.

    URLs of one host are in one fold. One row: n, n_blocked, precision, recall.
    """
    fold = F.crc32(host_of(F.col("url"))) % folds
    found = []
    for held in range(folds):
        model = train(table.where(fold != held))
        judged = model.transform(_features(_cut(table.where(fold == held), "label")))
        found.append(judged.select("label", "prediction"))
    judged = reduce(DataFrame.unionByName, found)
    both = F.count_if((F.col("label") == 1) & (F.col("prediction") == 1))
    return judged.agg(
        F.count("*").alias("n"),
        F.count_if(F.col("label") == 1).alias("n_blocked"),
        F.try_divide(both, F.count_if(F.col("prediction") == 1)).alias("precision"),
        F.try_divide(both, F.count_if(F.col("label") == 1)).alias("recall"),
    )


def verdicts(
    pages: DataFrame,
    model: LogisticRegressionModel | None = None,
    rules=RULES,
    table: DataFrame | None = None,
) -> DataFrame:
    """Columns page_id, host, path, rule, verdict, and the model's score for block.

    ``model`` is one that ``train`` has given; without it one is trained on ``table`` (url, label).
    """
    model = model or train(table if table is not None else url_table.labelled(pages.sparkSession))
    rows = pages.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    scored = model.transform(_features(rows))
    score = F.get(vector_to_array("probability"), F.lit(1))
    name, decision = rule_of(F.col("host"), F.col("path"), rules)
    scored = scored.select("page_id", "host", "path", name.alias("rule"), decision.alias("ruled"), score.alias("score"))
    by_model = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", by_model).alias("verdict"), "score"
    )
