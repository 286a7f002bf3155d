"""Problem 2: overlapping, nested and gapped intervals per entity.

A range sort by (entity, start) splits even one huge entity over many partitions. Each
partition is reduced to one summary row, the summaries (one per partition, so bounded by
the partition count) are prefix-combined on the driver, and a second scan of the same
materialised partitions starts from the state carried in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

# The state carried along the sorted rows: entity, greatest end so far, start of the open period.
State = tuple[object, int, int]


def _same(a: object, b: object) -> bool:
    return (a is None and b is None) or (a is not None and b is not None and a == b)


def _walk(ent: np.ndarray, start: np.ndarray, end: np.ndarray, state: State | None):
    """One sorted batch: period starts, running ends before each row, and the state after it."""
    n = len(ent)
    new = np.empty(n, dtype=bool)
    new[0] = not (state is not None and _same(state[0], ent[0]))
    null = pd.isna(ent)
    new[1:] = (null[1:] != null[:-1]) | (~null[1:] & ~null[:-1] & (ent[1:] != ent[:-1]))
    group = np.cumsum(new)
    if not new[0]:
        end = end.copy()
        end[0] = max(end[0], state[1])
    top = pd.Series(end).groupby(group).cummax().to_numpy()
    before = np.empty(n, dtype=np.int64)
    before[1:] = top[:-1]
    before[0] = 0 if new[0] else state[1]
    opens = new | (start > before)
    last = int(np.flatnonzero(opens)[-1]) if opens.any() else -1
    after = (None if null[-1] else ent[-1], int(top[-1]), int(start[last]) if last >= 0 else state[2])
    return new, opens, before, top, after


def _summaries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    state, pid, first, single = None, None, None, True
    for b in batches:
        if not len(b):
            continue
        ent = b["entity"].to_numpy(dtype=object)
        new, _, _, _, after = _walk(ent, b["start"].to_numpy(), b["end"].to_numpy(), state)
        if state is None:
            pid, first = int(b["pid"].iloc[0]), None if pd.isna(ent[0]) else ent[0]
            single = not new[1:].any()
        else:
            single = single and not new.any()
        state = after
    if state is not None:
        yield pd.DataFrame({"pid": [pid], "first": [first], "single": [single], "entity": [state[0]], "top": [state[1]], "opened": [state[2]]})


def combine(rows: list) -> dict[int, State]:
    """State before each partition, from the partition summaries in order."""
    before: dict[int, State] = {}
    state: State | None = None
    for r in sorted(rows, key=lambda r: r["pid"]):
        if state is not None:
            before[r["pid"]] = state
        if state is not None and r["single"] and _same(state[0], r["first"]):
            # The partition's last local period start is a true one only beyond the carried end.
            state = (r["entity"], max(state[1], r["top"]), r["opened"] if r["opened"] > state[1] else state[2])
        else:
            state = (r["entity"], r["top"], r["opened"])
    return before


def _scanner(carry: dict[int, State]):
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state, begun = None, False
        for b in batches:
            if not len(b):
                continue
            if not begun:
                state, begun = carry.get(int(b["pid"].iloc[0])), True
            ent, start = b["entity"].to_numpy(dtype=object), b["start"].to_numpy()
            new, opens, before, top, after = _walk(ent, start, b["end"].to_numpy(), state)
            at = np.flatnonzero(opens)
            if len(at) == 0 or at[0] != 0:
                # The rows before the first opening carry on the period of the state.
                at = np.concatenate([[0], at])
                firsts = np.concatenate([[state[2]], start[at[1:]]])
            else:
                firsts = start[at]
            lasts = np.append(at[1:], len(ent)) - 1
            gaps = np.flatnonzero(opens & ~new)
            state = after
            yield pd.DataFrame(
                {
                    "entity": np.concatenate([ent[at], ent[gaps]]),
                    "kind": ["period"] * len(at) + ["gap"] * len(gaps),
                    "start": np.concatenate([firsts, before[gaps]]).astype(np.int64),
                    "end": np.concatenate([top[lasts], start[gaps]]).astype(np.int64),
                }
            )

    return scan


def merge_intervals(df: DataFrame, entity: str, start: str, end: str) -> DataFrame:
    """(entity, kind 'period' | 'gap', start, end) with BIGINT bounds, per entity.

    Overlapping, nested, repeated and touching intervals join; gaps lie between consecutive
    periods. Rows with a null bound or end <= start take no part. A null entity is an entity
    of its own. An empty input gives an empty result. Other columns are ignored.
    """
    d = df.select(F.col(entity).alias("entity"), F.col(start).cast("bigint").alias("start"), F.col(end).cast("bigint").alias("end")).filter("end > start")
    kind = d.schema["entity"].dataType.simpleString()
    # The range sort reads its input twice, once for a sample: what leads to the bounds is computed before.
    ranged = cut_lineage(d).repartitionByRange("entity", "start").sortWithinPartitions("entity", "start").withColumn("pid", F.spark_partition_id())
    ranged = cut_lineage(ranged)
    rows = ranged.mapInPandas(_summaries, f"pid int, first {kind}, single boolean, entity {kind}, top bigint, opened bigint").collect()
    pieces = ranged.mapInPandas(_scanner(combine(rows)), f"entity {kind}, kind string, start bigint, end bigint")
    # Pieces of one period from neighbouring batches share its start.
    return pieces.groupBy("entity", "kind", "start").agg(F.max("end").alias("end"))


def continuous_periods(recordings: DataFrame, sites: DataFrame) -> DataFrame:
    """Periods and gaps of each folder's files, in UTC epoch seconds."""
    from ..functions.temporal import parse_mixed
    from .timestamps import with_site

    r = recordings.select("folder_name", "startdate", "starttime", "duration_sec", "site_code").filter((F.col("duration_sec") > 0) & F.col("startdate").isNotNull())
    t = parse_mixed(with_site(r, sites), "startdate", "starttime", "__zone", "__order").filter("ts_epoch is not null")
    t = t.select("folder_name", F.col("ts_epoch").alias("s"), (F.col("ts_epoch") + F.ceil("duration_sec")).alias("e"))
    m = merge_intervals(t, "folder_name", "s", "e")
    return m.select(F.col("entity").alias("folder_name"), "kind", F.col("start").alias("start_epoch"), F.col("end").alias("end_epoch"))
