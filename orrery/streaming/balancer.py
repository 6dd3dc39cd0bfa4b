"""Streaming forms: one-pass balancing with state a key, latest state of jobs, windowed counts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def allowance(positives: int, ratio: float) -> int:
    """Negatives that so many positives allow; Python rounds half to even."""
    return round(positives * (1 - ratio) / ratio) if positives and ratio < 1 else 0


def balance_stream(rows: DataFrame, key: str, row_id: str, order: list[str], positive: str, ratio: float) -> DataFrame:
    """(key, row_id, admitted) of a stream: state is two counters a key, rows go in order within a micro-batch.

    Over one batch that holds all rows it gives what online_balance gives.
    """
    ratio = min(1.0, max(0.01, ratio))
    kinds = dict(rows.dtypes)

    def admit(k, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        p, n = state.get if state.exists else (0, 0)
        batch = pd.concat(list(frames)).sort_values(order, kind="stable")
        out = []
        for hit in batch[positive].tolist():
            if hit:
                p += 1
            elif n < allowance(p, ratio):
                n += 1
            else:
                out.append(False)
                continue
            out.append(True)
        state.update((p, n))
        yield pd.DataFrame({key: k[0], row_id: batch[row_id].to_numpy(), "admitted": out})

    return rows.groupBy(key).applyInPandasWithState(admit, f"{key} {kinds[key]}, {row_id} {kinds[row_id]}, admitted boolean", "p long, n long", "append", GroupStateTimeout.NoTimeout)


def latest_state(events: DataFrame, key: str, order: list[str], fields: list[str]) -> DataFrame:
    """The last event of each key, for a stream in complete or update mode, or a batch."""
    return events.groupBy(key).agg(F.max_by(F.struct(*fields), F.struct(*order)).alias("s")).select(key, "s.*")


def windowed_counts(events: DataFrame, time: str, keys: list[str], late: str, width: str, step: str) -> DataFrame:
    """Counts by sliding event-time windows; rows later than the watermark are left out."""
    return events.withWatermark(time, late).groupBy(F.window(time, width, step), *keys).agg(F.count("*").alias("n"))
