"""Forms of the delimited genre string."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Delimiter in the data, and how a genre list is shown.
DELIMITER = "|"
SHOWN_DELIMITER = ", "
SHOWN_WHEN_MISSING = "?"


def _missing(genres: Column) -> Column:
    return F.coalesce(genres, F.lit("")) == ""


def genre_list(genres: Column) -> Column:
    """Genres as an array; empty where there are none."""
    none = F.array().cast("array<string>")
    return F.when(_missing(genres), none).otherwise(F.split(genres, f"[{DELIMITER}]"))


def genre_label(genres: Column) -> Column:
    """Genres as one line of text for display."""
    shown = F.replace(genres, F.lit(DELIMITER), F.lit(SHOWN_DELIMITER))
    return F.when(_missing(genres), F.lit(SHOWN_WHEN_MISSING)).otherwise(shown)
