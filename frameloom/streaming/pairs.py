"""Differences between neighbours in a stream, as an extension of the batch operator."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def stream_pairs(df: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """key, order, difference of each value to the one before it of its key, over arrivals in order.

    The state of a key is one number, so it doesn't grow with the stream; keys live on as issues do.
    """
    kind, at = df.schema[key].dataType.simpleString(), df.schema[order].dataType.simpleString()

    def compared(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        before = state.get[0] if state.exists else None
        rows = pd.concat(batches).sort_values(order)
        shifted = rows[value].shift(fill_value=rows[value].iloc[0] if before is None else before)
        state.update((float(rows[value].iloc[-1]),))
        yield pd.DataFrame({key: k[0], order: rows[order], "difference": (rows[value] - shifted).abs()})

    return df.select(key, order, value).groupBy(key).applyInPandasWithState(compared, f"{key} {kind}, {order} {at}, difference double", "before double", "append", GroupStateTimeout.NoTimeout)


def stream_counts(df: DataFrame, time: str, keys: list[str], window: str, late: str) -> DataFrame:
    """Counts by time window and keys; a window is closed once no row can be later than `late` behind the newest."""
    from pyspark.sql import functions as F

    return df.withWatermark(time, late).groupBy(F.window(time, window), *keys).agg(F.count("*").alias("n"))
