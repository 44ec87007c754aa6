"""State kept per group by the continuous throttle and detectors (helpers of ``jobs``)."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle

from netvigil.operators import forest

# Executors need not have this package installed: its functions travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def throttler(throttle_ms: int, columns: Sequence[str] = ("monitor", "tick")) -> Callable:
    """Lets a tick's row through when the last one sent lies at least ``throttle_ms`` back; keeps that time."""

    def step(key: tuple, batches: Iterable[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        until = state.get[0] if state.exists else None
        rows, sent = pd.concat(list(batches)).sort_values("tick", kind="stable"), []
        for place, tick in enumerate(rows["tick"].tolist()):
            if until is None or tick >= until:
                sent.append(place)
                until = tick + throttle_ms
        if until is not None:
            state.update((until,))
        yield rows.iloc[sent][list(columns)]

    return step


def window_scorer(
    score_windows: Callable, names: list[str], shingle: int, interval: int, blocks: int,
    unit: float, slice_windows: int = 4096, **settings: int,
) -> Callable:
    """Scores an entity's newly closed windows against the vectors of the past ones it keeps.

    What it keeps is bounded by the forest's history, refresh stretch and shingle.
    """
    kept_span = (settings["history"] + settings["refresh"] + shingle) * interval

    def step(key: tuple, batches: Iterable[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        fresh = pd.concat(list(batches)).dropna(subset=names).sort_values("key")
        keys, vectors = np.empty(0, dtype=np.int64), np.empty((0, len(names)))
        if state.exists:
            keys, vectors = np.array(state.get[0], dtype=np.int64), np.array(state.get[1], dtype=float)
            vectors = vectors.reshape(-1, len(names))
        for first in range(0, len(fresh), slice_windows):
            piece = fresh.iloc[first : first + slice_windows]
            new_keys = piece["key"].to_numpy(dtype=np.int64)
            keys = np.concatenate([keys, new_keys])
            vectors = np.concatenate([vectors, piece[names].to_numpy(dtype=float)])
            at, rows = forest.shingle_rows(keys, vectors, shingle, interval)
            wanted = np.isin(at, new_keys)
            total = np.zeros(len(at), dtype=np.int64)
            if wanted.any():
                for block in range(blocks):
                    total += score_windows(at, rows, wanted, (key[0], block), interval=interval, **settings)
            keep = keys >= keys[-1] - kept_span
            keys, vectors = keys[keep], vectors[keep]
            found = total[wanted]
            yield pd.DataFrame({"entity": key[0], "key": at[wanted], "anomaly_score": np.where(found < 0, np.nan, found / unit)})
        if len(keys):
            state.update((keys.tolist(), vectors.ravel().tolist()))

    return step


# What a scorer keeps of an entity: for each block of trees the sample of what lies before the current stretch, and the windows
# from which the shingles of that stretch and the first of the next are made.
SCORER_STATE = "held_sizes array<int>, held_keys array<bigint>, held array<double>, keys array<bigint>, vectors array<double>"
# Windows whose parts are not all there, and the recent scores that the next grades look at.
GRADER_STATE = (
    "keys array<bigint>, parts array<int>, units array<bigint>, features array<double>, past array<bigint>, "
    "scores array<double>"
)


class Record:
    """An entity's samples and open stretch, from its state to its state."""

    def __init__(self, entity: str, blocks: list[int], width: int, state, shingle: int, interval: int, options: dict):
        self.entity, self.blocks, self.shingle, self.interval, self.options = entity, blocks, shingle, interval, options
        self.keys, self.vectors = np.empty(0, dtype=np.int64), np.empty((0, width))
        empty = np.empty(0, dtype=np.int64), np.empty((0, width * shingle))
        self.held = [empty] * len(blocks)
        if state.exists:
            sizes, held_keys, held, keys, vectors = state.get
            ends = np.cumsum([0, *sizes])
            held_keys, held = np.array(held_keys, dtype=np.int64), np.array(held, dtype=float).reshape(-1, width * shingle)
            self.held = [(held_keys[a:b], held[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            self.keys, self.vectors = np.array(keys, dtype=np.int64), np.array(vectors, dtype=float).reshape(-1, width)

    def score(self, keys: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the new windows that end a shingle, and their scores summed over the blocks; the record moves on."""
        span = self.options["refresh"] * self.interval
        newest = self.keys[-1] if len(self.keys) else keys[0]
        self.keys, self.vectors = np.concatenate([self.keys, keys]), np.concatenate([self.vectors, vectors])
        at, shingles = forest.shingle_rows(self.keys, self.vectors, self.shingle, self.interval)
        # Shingles of stretches before the open one are in the samples already; their windows only complete later ones.
        fresh = at >= newest - newest % span
        at, shingles = at[fresh], shingles[fresh]
        wanted = np.isin(at, keys)
        total = np.zeros(len(at), dtype=np.int64)
        last = self.keys[-1] - self.keys[-1] % span
        closed = at < last
        for place, block in enumerate(self.blocks):
            seed, held = (self.entity, block), self.held[place]
            if wanted.any():
                total += forest.score_after(at, shingles, wanted, seed, held, self.interval, **self.options)
            self.held[place] = forest.drawn(
                np.concatenate([held[0], at[closed]]), np.concatenate([held[1], shingles[closed]]),
                self.options["sample"], seed,
            )
        kept = self.keys >= last - (self.shingle - 1) * self.interval
        self.keys, self.vectors = self.keys[kept], self.vectors[kept]
        return at[wanted], total[wanted]

    def state(self) -> tuple:
        return (
            [len(k) for k, _ in self.held], np.concatenate([k for k, _ in self.held]).tolist(),
            np.concatenate([v for _, v in self.held]).ravel().tolist(), self.keys.tolist(), self.vectors.ravel().tolist(),
        )


def past_scorer(
    names: list[str], shingle: int, interval: int, blocks: int, unit: float, parts: bool, slice_windows: int = 4096,
    **options: int,
) -> Callable:
    """Scores an entity's newly closed windows against samples of all its past ones.

    With ``parts`` the group is (entity, block of trees), and rows are sums of that block together with the features.
    """

    def step(key: tuple, batches: Iterable[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        fresh = pd.concat(list(batches)).dropna(subset=names).sort_values("key")
        own = [int(key[1])] if parts else list(range(blocks))
        record = Record(str(key[0]), own, len(names), state, shingle, interval, options)
        for first in range(0, len(fresh), slice_windows):
            piece = fresh.iloc[first : first + slice_windows]
            found, units = record.score(piece["key"].to_numpy(dtype=np.int64), piece[names].to_numpy(dtype=float))
            if parts:
                rows = piece.set_index("key").loc[found, names].reset_index()
                rows.insert(0, "entity", key[0])
                rows["block"], rows["units"] = np.int32(own[0]), pd.Series(units, dtype="Int64").mask(units < 0)
                yield rows[["entity", "key", "block", *names, "units"]]
            else:
                yield pd.DataFrame({"entity": key[0], "key": found, "anomaly_score": np.where(units < 0, np.nan, units / unit)})
        if len(fresh):
            state.update(record.state())

    return step


def middle(ordered: np.ndarray) -> float:
    """Median of sorted numbers."""
    return (ordered[(len(ordered) - 1) // 2] + ordered[len(ordered) // 2]) / 2


def grade_of(score: float, past: np.ndarray, least_scores: int, least_spread: float) -> float:
    """How far a score lies beyond 3 deviations of the recent ones, in [0, 1]; the deviation comes from median distances."""
    if len(past) < least_scores:
        return 0.0
    median = middle(np.sort(past))
    spread = max(middle(np.sort(np.abs(past - median))) * 1.4826, median * least_spread)
    return min(1.0, max(0.0, ((score - median) / spread - 3) / 3)) if spread else 0.0


def grader(
    names: list[str], interval: int, blocks: int, unit: float, windows: int, least_scores: int, least_spread: float
) -> Callable:
    """Scores and grades of an entity's windows from the sums of its blocks of trees, in the order of time.

    A window waits until all blocks have scored it and all windows before it that are waiting.
    """

    def step(key: tuple, batches: Iterable[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        waiting: dict[int, list] = {}
        past, scores = np.empty(0, dtype=np.int64), np.empty(0)
        if state.exists:
            keys, parts, units, features, past, scores = (np.array(x) for x in state.get)
            past, scores = past.astype(np.int64), scores.astype(float)
            features = features.reshape(len(keys), len(names))
            waiting = {int(k): [int(n), int(u), f] for k, n, u, f in zip(keys, parts, units, features)}
        rows = pd.concat(list(batches))
        for at, units, *features in zip(rows["key"], rows["units"], *(rows[n] for n in names)):
            part = waiting.setdefault(int(at), [0, 0, np.array(features, dtype=float)])
            part[0] += 1
            # Blocks agree on whether there is enough of a past to score.
            part[1] = -1 if pd.isna(units) else part[1] + int(units)
        out = []
        for at in sorted(waiting):
            count, units, features = waiting[at]
            if count < blocks:
                break
            del waiting[at]
            recent = (past >= at - windows * interval) & (past <= at - interval)
            score = None if units < 0 else units / unit
            grade = None if score is None else grade_of(score, scores[recent], least_scores, least_spread)
            out.append((key[0], at, *features, score, grade))
            past, scores = past[recent | (past > at - interval)], scores[recent | (past > at - interval)]
            if score is not None:
                past, scores = np.append(past, at), np.append(scores, score)
        keys = sorted(waiting)
        state.update((
            keys, [waiting[k][0] for k in keys], [waiting[k][1] for k in keys],
            [float(x) for k in keys for x in waiting[k][2]], past.tolist(), scores.tolist(),
        ))
        yield pd.DataFrame(out, columns=["entity", "key", *names, "anomaly_score", "anomaly_grade"]).astype(
            {"key": "int64"} | dict.fromkeys([*names, "anomaly_score", "anomaly_grade"], "float64")
        )

    return step
