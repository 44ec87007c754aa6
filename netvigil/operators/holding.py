"""Folds of a throttle over sorted ticks (helpers of ``monitor``); every group is one stretch of time of one action."""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# Executors need not have this package installed: its functions travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def next_free(ticks: np.ndarray, hold: int) -> np.ndarray:
    """For every tick that sends, the place of the next one that may; the ticks are sorted."""
    return np.searchsorted(ticks, ticks + hold)


def stretch(by: list[str], interval: int, hold: int) -> Callable:
    """A chunk as one row: its first and last tick, and until when it holds for each state it may be entered in."""

    def fold(table: pa.Table) -> pa.Table:
        chunk = table["chunk"][0].as_py()
        ticks = np.sort(table["tick"].to_numpy())
        follow = next_free(ticks, hold)
        until = ticks + hold
        for place in range(len(ticks) - 1, -1, -1):
            if follow[place] < len(ticks):
                until[place] = until[follow[place]]
        entries = chunk + np.arange(max(1, hold // interval)) * interval
        begin = np.searchsorted(ticks, entries)
        exits = np.where(begin < len(ticks), until[np.minimum(begin, len(ticks) - 1)], entries)
        columns = {name: table[name].slice(0, 1) for name in by}
        return pa.table(columns | {
            "chunk": [chunk], "first_tick": ticks[:1], "last_tick": ticks[-1:],
            "exits": pa.array([exits.tolist()], pa.list_(pa.int64())),
        })

    return fold


def walk(by: list[str], interval: int) -> Callable:
    """The time from which each chunk of an island is free; the first chunk of an island always is."""

    def fold(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        chunks, entries, until = table["chunk"].to_pylist(), [], None
        for chunk, exits in zip(chunks, table["exits"].to_pylist()):
            entry = chunk if until is None else max(chunk, until)
            entries.append(entry)
            until = exits[(entry - chunk) // interval]
        return pa.table({name: table[name] for name in by} | {"chunk": chunks, "entry": pa.array(entries, pa.int64())})

    return fold


def send(columns: list[str], hold: int) -> Callable:
    """The rows of a chunk that send, given from when it is free."""

    def fold(table: pa.Table) -> pa.Table:
        table = table.sort_by("tick")
        ticks = table["tick"].to_numpy()
        follow, sent = next_free(ticks, hold), []
        place = int(np.searchsorted(ticks, table["entry"][0].as_py()))
        while place < len(ticks):
            sent.append(place)
            place = int(follow[place])
        return table.take(pa.array(sent, pa.int64())).select(columns)

    return fold
