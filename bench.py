"""Times of the headline queries, as one JSON line.

Reads the tables in ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``. Every query
runs whole and its rows are thrown away by the noop sink.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from affinia.operators import activity, cleaning, factorize, recommend, similar, splitting  # noqa: E402
from affinia.settings import ENGINE_DEFAULTS, SMALL_DEFAULTS, session_conf  # noqa: E402
from affinia.sources import models  # noqa: E402
from affinia.sources import order_tables as tables  # noqa: E402
from affinia.sources.workspace import new_folder, written  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))
RANK, MAX_ITER, REG_PARAM = SMALL_DEFAULTS.rank, SMALL_DEFAULTS.max_iter, SMALL_DEFAULTS.reg_param


def session() -> SparkSession:
    input_bytes = sum(f.stat().st_size for f in Path(FOLDER).glob("*.parquet"))
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("affinia-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config(map=session_conf(input_bytes, int(CPUS)))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(job, repeats: int = REPEATS) -> float:
    """Best of some runs: the first ones include compilation."""
    times = []
    for _ in range(repeats):
        start = time.perf_counter()
        job()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def main() -> None:
    spark = session()
    ratings, catalog = tables.ratings(spark, FOLDER), tables.catalog(spark, FOLDER)
    times = {
        "dataset_stats": timed(lambda: run(activity.dataset_stats(ratings))),
        "dedup_latest": timed(lambda: run(cleaning.latest_ratings(cleaning.drop_nulls(ratings)))),
        "preprocess": timed(
            lambda: run(splitting.with_split(cleaning.clean(ratings, ENGINE_DEFAULTS)))
        ),
    }

    latest = written(cleaning.latest_ratings(ratings), "bench")
    times["als_fit"] = timed(
        lambda: factorize.fit(latest, RANK, MAX_ITER, REG_PARAM).userFactors.count()
    )
    # Four combinations in three folds, and the refit.
    times["als_tune"] = timed(lambda: factorize.tune(latest, (4, 8), (0.1, 1.0), (3,)), repeats=1)
    fitted = factorize.fit(latest, RANK, MAX_ITER, REG_PARAM)
    model = models.load_model(models.save_model(spark, fitted, new_folder(spark, "bench-model")))
    users, items = model.userFactors, model.itemFactors
    times |= {
        "als_evaluate": timed(lambda: run(factorize.evaluate(model, latest))),
        "top_n_for_user": timed(
            lambda: run(recommend.top_n_for_user(latest, catalog, users, items, 1))
        ),
        "recommend_all_users": timed(
            lambda: run(recommend.recommend_all_users(users, items, catalog))
        ),
        "recommend_all_users_unseen": timed(
            lambda: run(recommend.recommend_all_users(users, items, catalog, seen=latest))
        ),
        "similar_items": timed(lambda: run(similar.similar_items(items, catalog, 1))),
        "similar_items_all": timed(lambda: run(similar.similar_items_all(items, catalog))),
    }
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
