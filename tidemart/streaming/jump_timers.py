"""Bounces on a stream, each at its own timeout.

`visits.user_jumps` runs on streams too, but its windows tell a bounce only when the watermark has
passed both cells that decide it. Here every entry page has its own time, so a bounce leaves with the
first micro-batch whose watermark is `timeout` behind it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemart.functions.times import interval_millis, with_event_time
from tidemart.operators.visits import is_entry

# entries that wait; devices with follow-ups, the last one in the cell and the first in the next cell
STATE = ("mid array<string>, ts array<bigint>, line array<string>, "
         "device array<string>, last array<bigint>, first array<bigint>")
LONG_AGO, FAR_AWAY = -(1 << 62), 1 << 62


def timed_jumps(pages: DataFrame, timeout: str = "10 seconds", delay: str = "1 second",
                buckets: int = 64) -> DataFrame:
    """Entry pages that no further page of the same device follows within `timeout`, by the rules of
    `visits.user_jumps`, each told at its own timeout. Streams only.

    State is kept by bucket of devices and cell, a cell being as long as the timeout, so that a busy
    device is spread over time and a worker takes many devices at once: it holds the waiting entries,
    and for each device two times of follow-ups. A timer wakes it at the next timeout, and it goes when
    the watermark has passed the cell and the last entry's timeout. A follow-up goes to its own cell
    and the one before. `buckets` divide the devices of one cell: some thousands of rows in each.
    """
    width = interval_millis(timeout)
    rows = with_event_time(pages, F.timestamp_millis("ts"), delay)
    cell = F.floor(F.col("ts") / F.lit(width)).cast("bigint")
    # a page without a device is followed by none
    rows = rows.withColumn("entry", is_entry()).where(F.col("entry") | F.col("common.mid").isNotNull())
    rows = rows.select(
        F.col("common.mid").alias("mid"), "ts", "event_time", "entry",
        F.when(F.col("entry"), F.to_json(F.struct(*pages.columns))).alias("line"),
        F.pmod(F.xxhash64("common.mid"), F.lit(buckets)).alias("bucket"),
        F.explode(F.when(F.col("entry"), F.array(cell)).otherwise(F.array(cell, cell - 1))).alias("cell"))

    def work(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        turn, now = (int(key[1]) + 1) * width, state.getCurrentWatermarkMs()
        old = [list(x) for x in state.get] if state.exists else [[] for _ in range(6)]
        waits = [pd.DataFrame(dict(zip(("mid", "ts", "line"), old[:3])))]
        bounds = [pd.DataFrame(dict(zip(("mid", "last", "first"), old[3:])))]
        for frame in frames:
            entry = frame["entry"].to_numpy(dtype=bool)      # a timer brings an empty frame
            waits.append(frame.loc[entry, ["mid", "ts", "line"]])
            follow = frame.loc[~entry, ["mid", "ts"]]
            here = follow["ts"] < turn
            bounds.append(pd.DataFrame({"mid": follow["mid"], "last": follow["ts"].where(here, LONG_AGO),
                                        "first": follow["ts"].where(~here, FAR_AWAY)}))
        bound = pd.concat([b for b in bounds if len(b)] or bounds[:1]).groupby("mid").agg(
            {"last": "max", "first": "min"})
        wait = pd.concat([w for w in waits if len(w)] or waits[:1])
        last = wait["mid"].map(bound["last"]).fillna(LONG_AGO).astype("int64")
        first = wait["mid"].map(bound["first"]).fillna(FAR_AWAY).astype("int64")
        ts = wait["ts"].astype("int64")
        wait = wait[(last < ts) & (first >= ts + width)]
        due = wait["ts"].astype("int64") + width <= now
        if due.any():
            yield pd.DataFrame({"line": wait.loc[due, "line"].tolist()})
        wait = wait[~due]
        then = max(turn, int(wait["ts"].max()) + width) if len(wait) else turn
        if then <= now:
            if state.exists:
                state.remove()
            return
        state.update((wait["mid"].tolist(), [int(t) for t in wait["ts"]], wait["line"].tolist(),
                      bound.index.tolist(), [int(t) for t in bound["last"]], [int(t) for t in bound["first"]]))
        wake = min([t for t in (turn, *(int(t) + width for t in wait["ts"])) if t > now])
        state.setTimeoutTimestamp(wake - 1)     # a timer goes off behind its time

    told = rows.groupBy("bucket", "cell").applyInPandasWithState(
        work, "line string", STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return told.select(F.inline(F.array(F.from_json("line", pages.schema)))).select(*pages.columns)
