"""Fitted preprocessing on a streaming DataFrame.

Every ``apply_*`` step is a projection, a filter or a join with a fitted table, so
a chain fitted on a batch table runs unchanged on ``readStream`` input.  The
one stateful step, de-duplication, needs an event-time watermark on a stream
(otherwise its state grows without bound): with ``event_time`` it uses
``dropDuplicatesWithinWatermark``; without it the step is refused.
Rare categories and label codes are stream-static joins with their fitted tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tabforge.operators import clean, missing, scale


def apply_stream(df: DataFrame, state: dict, event_time: str | None = None,
                 watermark: str = "10 minutes") -> DataFrame:
    steps = state["steps"]
    if "duplicates" in steps:
        df = clean.filter_labels(clean.coerce_numeric(df, state["numeric_in"]), state["target"],
                                 state["labels"])
        if event_time is None:
            raise ValueError("de-duplicating a stream needs an event-time column (watermark)")
        # the event time tells rows apart that the batch de-duplication takes as equal
        df = df.withWatermark(event_time, watermark).dropDuplicatesWithinWatermark([c for c in df.columns if c != event_time])
    if "missing" in steps:
        df = missing.apply_missing(df, state["missing"])
    if "encode" in steps:
        df = missing.apply_label_encoder(df, state["target"], state["label_order"])
    if "scale" in steps:
        df = scale.apply_scale(df, state["scale"])
    if "transform" in steps:
        from tabforge.operators import power
        df = power.apply_power(df, state["power"])
    return df
