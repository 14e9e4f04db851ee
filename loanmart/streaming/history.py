"""Event-history replay, de-duplicated.

Two forms.  ``first_within_watermark`` keeps the keys in Spark's state store
and drops late rows, which the query's progress counts.
``start_history_stream`` keeps the newest row of a key in a batch, whatever
order the rows come in, and sets late rows aside; its state is a snapshot of
the keys within the delay.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanmart.functions.dates import utc_instant
from loanmart.operators.dedupe import keep_first
from loanmart.streaming.outbox import read_batch, write_batch
from loanmart.streaming.state import read_state, write_state


def first_within_watermark(events: DataFrame, keys: Sequence[str], ts_col: str, delay: _dt.timedelta) -> DataFrame:
    """Of a streaming DataFrame the first row of every key within ``delay``.
    Rows older than the newest event minus ``delay`` are dropped; see
    ``late_rows``.  Which of a micro-batch's rows of one key comes first is
    open, so only the keys should be relied on.  A zone-less time is taken as UTC."""
    if isinstance(events.schema[ts_col].dataType, T.TimestampNTZType):
        events = events.withColumn(ts_col, utc_instant(F.col(ts_col)))
    return events.withWatermark(ts_col, f"{delay.total_seconds():.0f} seconds").dropDuplicatesWithinWatermark(list(keys))


def late_rows(query) -> int:
    """Rows that a query's watermark has dropped so far, by the progress it keeps."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def process_history(batch: DataFrame, batch_id: int, spark: SparkSession, keys: Sequence[str], order_col: str,
                    ts_col: str, delay: _dt.timedelta, out_path: str, late_path: str, state_path: str) -> None:
    """One micro-batch: the greatest ``order_col`` of each key, unless an
    earlier batch has given the key within ``delay``.  Rows older than the
    newest earlier event minus ``delay`` go to ``late_path``, unchanged; a row
    without a time is never late and not remembered."""
    batch = batch.persist()
    fields = {f.name: f for f in batch.schema.fields}
    known = T.StructType([*[fields[k] for k in keys], *([] if ts_col in keys else [fields[ts_col]])])
    newest_schema = T.StructType([fields[ts_col]])
    seen = read_state(spark, f"{state_path}/keys", known, batch_id)
    times = read_state(spark, f"{state_path}/newest", newest_schema, batch_id)
    newest = times.first()[0] if times is not None else None  # one row
    fresh, late = batch, batch.limit(0)

    def recent(time) -> F.Column:
        return F.col(ts_col) >= F.lit((time - delay).isoformat(sep=" ")).cast(fields[ts_col].dataType)

    if newest is not None:
        late = batch.where(~recent(newest))
        fresh = batch.where(F.col(ts_col).isNull() | recent(newest))
    first = keep_first(fresh, keys, order_col)
    if seen is not None:
        held = seen.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
        first = first.join(held, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left_anti")
    write_batch(first, out_path, batch_id)
    write_batch(late, late_path, batch_id)
    top = fresh.agg(F.max(ts_col)).first()[0]
    newest = max((t for t in (newest, top) if t is not None), default=None)
    state = read_batch(spark, out_path, batch.schema, batch_id).select(*known.names)
    state = state.unionByName(seen) if seen is not None else state
    write_state(state.where(recent(newest)) if newest is not None else state.limit(0), f"{state_path}/keys", batch_id)
    write_state(spark.createDataFrame([(newest,)], newest_schema), f"{state_path}/newest", batch_id)
    batch.unpersist()


def start_history_stream(spark: SparkSession, events: DataFrame, keys: Sequence[str], order_col: str, ts_col: str,
                         delay: _dt.timedelta, out_path: str, late_path: str, checkpoint: str, available_now: bool = True,
                         state_path: str | None = None):
    """Streaming form of G3 over the event history.  A batch reads the keys of
    the last ``delay`` and no earlier output, so its work is bounded by them."""
    state_path = state_path or f"{out_path.rstrip('/')}_state"
    writer = (events.writeStream.foreachBatch(
        lambda df, bid: process_history(df, bid, spark, keys, order_col, ts_col, delay, out_path, late_path, state_path))
        .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
