"""Names for columns that an operator needs beside the caller's."""

from __future__ import annotations

from pyspark.sql import DataFrame


def unused(df: DataFrame, *wanted: str, beside: DataFrame | None = None) -> list[str]:
    """A name like each wanted one that df, and what is put beside it, has in no case; all different."""
    taken, out = {c.lower() for c in [*df.columns, *(beside.columns if beside is not None else [])]}, []
    for w in wanted:
        name = next(n for n in (w, *(f"{w}_{k}" for k in range(len(taken) + 1))) if n.lower() not in taken)
        taken.add(name.lower())
        out.append(name)
    return out
