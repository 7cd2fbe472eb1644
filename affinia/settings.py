"""Named parameter sets and limits."""

from dataclasses import dataclass
from math import ceil


@dataclass(frozen=True)
class Preset:
    """Cleaning thresholds and training parameters that belong together."""

    min_user_ratings: int
    min_item_ratings: int
    rank: int
    max_iter: int = 10
    reg_param: float = 0.1
    alpha: float = 1.0
    # Blocks of users, and of items, in a fit. The first random factors depend on them, so
    # they are part of the parameters and never follow from a cluster or the data. A
    # fit has one task per block: set more for ratings beyond some hundred million.
    blocks: int = 10


# Defaults a caller relies on.
ENGINE_DEFAULTS = Preset(min_user_ratings=20, min_item_ratings=10, rank=50)
SMALL_DEFAULTS = Preset(min_user_ratings=5, min_item_ratings=0, rank=20)

TUNE_RANKS = (10, 50, 100)
TUNE_REG_PARAMS = (0.01, 0.1, 1.0)
TUNE_MAX_ITERS = (10, 20)
TUNE_FOLDS = 3
TUNE_PARALLELISM = 4

SEED = 42
TRAIN_PERCENT = 80
TOP_N = 10
TOP_N_MAX = 50

ALGORITHM = "ALS (Alternating Least Squares)"
FRAMEWORK = "Apache Spark MLlib"


def clamp_top_n(n: int = TOP_N) -> int:
    """Bring a requested answer length into the range that answers allow."""
    return max(1, min(n, TOP_N_MAX))


SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024


def session_conf(input_bytes: int, cores: int) -> dict[str, str]:
    """Spark settings for a session that works on so much data.

    Cleaning shuffles all of its input. Spark can join small shuffle
    partitions to larger ones while it runs, but splits a large one only where
    a join is skewed, so their number has to suit the input.
    """
    partitions = ceil(input_bytes / SHUFFLE_PARTITION_BYTES)
    return {
        "spark.sql.shuffle.partitions": str(max(cores, partitions)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
