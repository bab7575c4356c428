"""Keyed state on streams: time since the last event, last known flow, latest prediction."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

_STATE = "first_hour timestamp, event_hour timestamp, flow double"


def event_clock(hours: DataFrame, key: str, time: str = "hour", is_event: str = "is_event", flow: str = "flow") -> DataFrame:
    """Hours since the last event and last known flow, carried across micro-batches.

    Input is hourly (at most one row per series and hour) and arrives in hour order per
    series; inside a batch any order will do. Before the first event the count runs from
    the series start, as in the batch operator.
    """
    out = f"{key} string, {time} timestamp, hours_since long, last_flow double"

    def step(k: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat([p for p in parts if len(p)], ignore_index=True).sort_values(time, ignore_index=True)
        first, event, known = state.get if state.exists else (None, None, None)
        first = pd.Timestamp(first) if first is not None else rows[time].iloc[0]
        # the event mark of every row: its own hour if it is one, else the last one before it
        marks = rows[time].where(rows[is_event].astype(bool))
        if event is not None:
            marks.iloc[0] = marks.iloc[0] if pd.notna(marks.iloc[0]) else pd.Timestamp(event)
        marks = marks.ffill()
        start = first - pd.Timedelta(hours=1)
        since = (rows[time] - marks.fillna(start)) // pd.Timedelta(hours=1)
        flows = rows[flow].copy()
        if known is not None and pd.isna(flows.iloc[0]):
            flows.iloc[0] = known
        flows = flows.ffill()
        last_mark, last_flow = marks.iloc[-1], flows.iloc[-1]
        state.update(
            (
                first.to_pydatetime(),
                None if pd.isna(last_mark) else last_mark.to_pydatetime(),
                None if pd.isna(last_flow) else float(last_flow),
            )
        )
        yield pd.DataFrame(
            {key: k[0], time: rows[time], "hours_since": since.astype("int64"), "last_flow": flows}
        )

    return (
        hours.select(key, time, is_event, flow)
        .groupBy(key)
        .applyInPandasWithState(
            step,
            outputStructType=StructType.fromDDL(out),
            stateStructType=StructType.fromDDL(_STATE),
            outputMode="append",
            timeoutConf=GroupStateTimeout.NoTimeout,
        )
    )


def latest_by_site(predictions: DataFrame, name: str, time: str, cols: Sequence[str]) -> DataFrame:
    """The newest prediction of every site, kept up to date (update or complete mode)."""
    newest = F.max_by(F.struct(*cols), F.col(time))
    return predictions.groupBy(name).agg(F.max(time).alias(time), newest.alias("_v")).select(name, time, "_v.*")
