"""Catalogue lookups and the join that adds titles to ranked items."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia import schemas as S
from affinia.functions.genres import genre_label, genre_list


def one_row_per_item(catalog: DataFrame) -> DataFrame:
    """The catalogue without repeated items; the smallest title and genres win."""
    first = F.min(F.struct(S.TITLE, S.GENRES)).alias("first")
    return catalog.groupBy(S.ITEM).agg(first).select(S.ITEM, f"first.{S.TITLE}", f"first.{S.GENRES}")


def in_catalog(factors: DataFrame, catalog: DataFrame) -> DataFrame:
    """Item factors whose item is in the catalogue."""
    return factors.join(catalog, factors[S.ID] == catalog[S.ITEM], "left_semi")


def with_titles(ranked: DataFrame, catalog: DataFrame) -> DataFrame:
    """Add title and genres to rows that name an item.

    Which side is broadcast, if any, is left to Spark: it compares their
    sizes, and a ranked list that is limited is small by its plan. Rebalancing the
    titles lets it split an item that most lists name.
    """
    return ranked.join(one_row_per_item(catalog).hint("rebalance"), S.ITEM)


def with_titles_of_few(ranked: DataFrame, catalog: DataFrame) -> DataFrame:
    """The same for a short list: only its own items are searched for repeats."""
    first = F.min(F.struct(S.TITLE, S.GENRES)).alias("first")
    matches = ranked.join(catalog.select(S.ITEM, S.TITLE, S.GENRES), S.ITEM)
    return matches.groupBy(*ranked.columns).agg(first).select(*ranked.columns, "first.*")


def catalog_lookup(catalog: DataFrame, wanted: DataFrame | int) -> DataFrame:
    """Title and genre list of one item, or of every item in a table of ids.

    An item gives one row, or none if it is not in the catalogue.
    """
    if isinstance(wanted, DataFrame):
        rows = catalog.join(wanted.select(S.ITEM), S.ITEM, "left_semi")
    else:
        rows = catalog.filter(F.col(S.ITEM) == wanted)
    return one_row_per_item(rows).select(
        F.col(S.ITEM).alias("movie_id"), S.TITLE, genre_list(F.col(S.GENRES)).alias(S.GENRES)
    )


def genres_display(catalog: DataFrame) -> DataFrame:
    """The catalogue with genres as a line of text."""
    return catalog.select(S.ITEM, S.TITLE, genre_label(F.col(S.GENRES)).alias(S.GENRES))
