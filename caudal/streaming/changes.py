"""Change notifications and event-time windows as Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Groups that the units of a stream are dealt to by hash.
BUCKETS = 1024
SCHEMA = "upid string, kind string, estado_anterior string, estado_nuevo string"


def changes_of(previous: str | None, seen: bool, events: list[tuple]) -> tuple[list[tuple], str | None, bool]:
    """What to tell about one unit's events in order: (estado or None, deleted) pairs."""
    out = []
    for state, deleted in events:
        if deleted:
            previous, seen = None, False
        elif not seen:
            out.append(("NEW", None, state))
            previous, seen = state, True
        elif state != previous:
            out.append(("UPDATE", previous, state))
            previous = state
    return out, previous, seen


def _step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The events of a bucket's units in order of time; the state is what is known of all its units."""
    known: dict[str | None, str | None] = dict(zip(*state.get, strict=True)) if state.exists else {}
    rows = pd.concat(list(frames)).sort_values("ts", kind="stable")
    text = lambda c: rows[c].astype(object).where(rows[c].notna(), None)
    out = []
    for upid, estado, deleted in zip(text("upid"), text("estado"), map(bool, rows["deleted"]), strict=True):
        told, previous, seen = changes_of(known.get(upid), upid in known, [(estado, deleted)])
        out += [(upid, *o) for o in told]
        if seen:
            known[upid] = previous
        else:
            known.pop(upid, None)
    if known:
        state.update((list(known), list(known.values())))
    elif state.exists:
        state.remove()
    yield pd.DataFrame(out, columns=["upid", "kind", "estado_anterior", "estado_nuevo"])


def status_changes(stream: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """ST1: from writes (upid, estado, deleted, ts) a NEW row for a unit's first and an UPDATE row for each change of estado; deletions are silent. State: the last estado of each unit, kept by buckets of units, as a call of Python for each unit takes most of the time. A checkpoint goes on only with the number of buckets that it began with."""
    return stream.select("upid", "estado", "deleted", "ts", F.pmod(F.xxhash64("upid"), F.lit(buckets)).alias("bucket")).groupBy("bucket").applyInPandasWithState(_step, SCHEMA, "upids array<string>, estados array<string>", "append", GroupStateTimeout.NoTimeout)


def event_values(raw: DataFrame, column: str = "value") -> DataFrame:
    """NJ12: writes out of JSON change events with typed values; an event without a new value is a deletion."""
    j = lambda path: F.get_json_object(column, path)
    field = lambda side, f: j(f"$.data.{side}.fields.{f}.stringValue")
    return raw.select(F.coalesce(field("value", "upid"), field("oldValue", "upid")).alias("upid"), field("value", "estado").alias("estado"), j("$.data.value").isNull().alias("deleted"), F.col("ts"))


def first_seen(stream: DataFrame, key: str, ts: str, within: str = "1 day") -> DataFrame:
    """ST2: the first row of each key, as far back as the watermark remembers."""
    return stream.withWatermark(ts, within).dropDuplicatesWithinWatermark([key])


def run_once(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str):
    """ST3: all that has arrived, in micro-batches, then stop; a scheduler calls it each hour."""
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def windowed(stream: DataFrame, ts: str, length: str, late: str, *keys: str, slide: str | None = None, **values: Column) -> DataFrame:
    """ST4 (an extension): tumbling or sliding windows in event time; rows later than the watermark are left out."""
    w = F.window(ts, length, slide) if slide else F.window(ts, length)
    return stream.withWatermark(ts, late).groupBy(w.alias("w"), *keys).agg(*(c.alias(n) for n, c in values.items())).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, *values)


def sessions(stream: DataFrame, ts: str, gap: str, late: str, *keys: str) -> DataFrame:
    """ST4 (an extension): sessions that end after a gap."""
    return stream.withWatermark(ts, late).groupBy(F.session_window(ts, gap).alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n")
