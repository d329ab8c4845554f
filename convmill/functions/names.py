"""Names for columns that an operator adds for itself and drops again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def fresh(df: DataFrame, *names: str, also: Sequence[str] = ()) -> list[str]:
    """Names that no column of ``df``, and none of ``also``, has in any case."""
    taken = {c.lower() for c in (*df.columns, *also)}
    out = []
    for name in names:
        while f"_{name}".lower() in taken:
            name += "_"
        taken.add(f"_{name}".lower())
        out.append(f"_{name}")
    return out
