"""Names of columns that operators add to tables of others for a while."""

from pyspark.sql import DataFrame


def unused(table: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as no column of the table has."""
    taken = {name.lower() for name in table.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
        taken.add(name.lower())
    return out
