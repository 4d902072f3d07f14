"""Column names that do not clash with a table's own."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spare(df: DataFrame, *wanted: str) -> list[str]:
    """Each name, with underscores in front until no column of ``df`` is called so, in any case."""
    taken = {name.lower() for name in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out
