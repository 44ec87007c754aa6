"""Random cut trees for one bounded group of shingles (numpy helper of ``detect``).

After S. Guha, N. Mishra, G. Roy, O. Schrijvers, "Robust Random Cut Forest Based
Anomaly Detection on Streams", ICML 2016. A point's score in a tree is its
displacement: over the nodes it passes when inserted, the largest ratio of the
sibling's size to its own side's size, divided by the size of the sample.
"""

from __future__ import annotations

import sys
import zlib

import numpy as np
import pandas as pd
from pyspark import cloudpickle

# Executors need not have this package installed: its functions travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCORE_UNIT = 1_000_000


def grow(points: np.ndarray, rng: np.random.Generator) -> dict[str, np.ndarray]:
    """Random cut trees over ``points[tree, row, dimension]``, all of them level by level.

    Each level cuts every unfinished node once, in a dimension drawn in proportion to the
    node's extent. Nodes of all trees share one numbering; node t is the root of tree t.
    """
    trees, rows, dims = points.shape
    flat = points.reshape(-1, dims)
    member = np.repeat(np.arange(trees), rows)
    alive = np.arange(len(flat))
    parts: dict[str, list[np.ndarray]] = {k: [] for k in ("low", "high", "size", "axis", "cut", "left")}
    first, count = 0, trees
    while count:
        order = np.argsort(member[alive], kind="stable")
        alive = alive[order]
        local = member[alive] - first
        starts = np.searchsorted(local, np.arange(count))
        size = np.diff(np.append(starts, len(local)))
        low = np.minimum.reduceat(flat[alive], starts, axis=0)
        high = np.maximum.reduceat(flat[alive], starts, axis=0)
        reach = np.cumsum(high - low, axis=1)
        extent = reach[:, -1]
        split = extent > 0
        spot = np.minimum(rng.random(count) * extent, np.nextafter(extent, 0))
        axis = np.minimum((reach <= spot[:, None]).sum(axis=1), dims - 1)
        index = np.arange(count)
        bottom, top = low[index, axis], high[index, axis]
        # Kept below the top so that neither side of a cut is ever empty.
        cut = np.clip(top - (reach[index, axis] - spot), bottom, np.nextafter(top, -np.inf))
        left = np.full(count, -1)
        left[split] = first + count + 2 * np.arange(split.sum())
        for name, value in zip(parts, (low, high, size, axis, cut, left)):
            parts[name].append(value)
        kept = split[local]
        alive, local = alive[kept], local[kept]
        right = flat[alive, axis[local]] > cut[local]
        member[alive] = left[local] + right
        first, count = first + count, 2 * int(split.sum())
    return {name: np.concatenate(values) for name, values in parts.items()}


def _uniform(*parts: np.ndarray | int) -> np.ndarray:
    """Numbers in [0, 1) fixed by the given integers alone (splitmix64 steps)."""
    mixed = np.zeros(1, dtype=np.uint64)
    for part in parts:
        mixed = mixed + np.asarray(part).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        mixed = mixed ^ (mixed >> np.uint64(31))
    return (mixed >> np.uint64(11)) * 2.0**-53


def displacement(
    forest: dict[str, np.ndarray], trees: int, queries: np.ndarray, keys: np.ndarray, salt: int
) -> np.ndarray:
    """Score of every query in every tree, shape ``(trees, queries)``.

    Going down, the query parts from a node with the probability that a random cut of the box
    around node and query falls between the two; there it ends, else it follows the node's cut.
    Chance depends on the query's key only, so it scores the same alone and among others.
    """
    wanted = len(queries)
    tree = np.repeat(np.arange(trees), wanted)
    query = np.tile(np.arange(wanted), trees)
    node = tree.copy()
    best = np.zeros(trees * wanted)
    active = np.arange(trees * wanted)
    depth = 0
    while len(active):
        at, x = node[active], queries[query[active]]
        low, high = forest["low"][at], forest["high"][at]
        outside = (np.maximum(low - x, 0) + np.maximum(x - high, 0)).sum(axis=1)
        extent = (high - low).sum(axis=1)
        chance = _uniform(salt, keys[query[active]], tree[active], depth)
        parts = chance * (outside + extent) < outside
        best[active[parts]] = np.maximum(best[active[parts]], forest["size"][at[parts]])
        go = ~parts & (forest["left"][at] >= 0)
        active, at, x = active[go], at[go], x[go]
        right = x[np.arange(len(at)), forest["axis"][at]] > forest["cut"][at]
        left = forest["left"][at]
        child, sibling = left + right, left + 1 - right
        best[active] = np.maximum(best[active], forest["size"][sibling] / (forest["size"][child] + 1))
        node[active] = child
        depth += 1
    return (best / forest["size"][tree]).reshape(trees, wanted)


def score_windows(
    keys: np.ndarray, shingles: np.ndarray, wanted: np.ndarray, seed: tuple[str, int],
    interval: int, trees: int, sample: int, history: int, refresh: int, warmup: int,
) -> np.ndarray:
    """Score sums over ``trees``, in millionths, of the ``wanted`` windows of one entity; -1 without score; keys ascend.

    Windows are scored in aligned stretches of ``refresh``. A stretch's trees are drawn from the
    shingles in the ``history`` windows before it, seeded by entity, stretch and block of trees:
    a score depends on the entity's past only, not on how rows are spread over tasks or batches.
    """
    name, block = seed
    salt = zlib.crc32(f"{block} {name}".encode())
    span = refresh * interval
    scores = np.full(len(keys), -1, dtype=np.int64)
    stretch = keys - keys % span
    for start in np.unique(stretch[wanted]):
        begin, end = np.searchsorted(keys, [start - history * interval, start])
        if end - begin < warmup:
            continue
        rng = np.random.default_rng([salt, int(start // span) & 0xFFFFFFFF])
        past = shingles[begin:end]
        deviation = past.std(axis=0)
        scale = np.where(deviation > 0, deviation, 1.0)
        size = min(sample, len(past))
        picks = np.argsort(rng.random((trees, len(past))), axis=1)[:, :size]
        due = np.flatnonzero((stretch == start) & wanted)
        forest = grow(past[picks] / scale, rng)
        found = displacement(forest, trees, shingles[due] / scale, keys[due], salt)
        scores[due] = np.rint(found * SCORE_UNIT).astype(np.int64).sum(axis=0)
    return scores


def score_group(rows: pd.DataFrame, entity: str, block: int, **settings: int) -> pd.DataFrame:
    """Partial scores of one (entity, chunk, block of trees); carried rows only serve as past."""
    rows = rows.sort_values("key", kind="stable")
    keys = rows["key"].to_numpy(dtype=np.int64)
    shingles = np.array(rows["shingle"].tolist(), dtype=float)
    wanted = ~rows["carried"].to_numpy(dtype=bool)
    scores = score_windows(keys, shingles, wanted, (entity, block), **settings)
    units = pd.Series(scores[wanted], dtype="Int64")
    return pd.DataFrame({"entity": entity, "key": keys[wanted], "units": units.mask(units < 0)})


def shingle_rows(keys: np.ndarray, vectors: np.ndarray, size: int, interval: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and flattened vectors of the unbroken runs of ``size`` windows."""
    if len(keys) < size:
        return np.empty(0, dtype=np.int64), np.empty((0, vectors.shape[1] * size))
    ends = np.arange(size - 1, len(keys))
    ends = ends[keys[ends] - keys[ends - size + 1] == (size - 1) * interval]
    return keys[ends], vectors[ends[:, None] - np.arange(size - 1, -1, -1)].reshape(len(ends), vectors.shape[1] * size)


def drawn(keys: np.ndarray, points: np.ndarray, sample: int, seed: tuple[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """The ``sample`` windows of least priority, by key.

    A window's priority is a number made of its key, the entity and the block of trees. So this is an even sample of
    everything it was drawn from, and what is drawn from several samples together is the sample of all that is behind them.
    """
    salt = zlib.crc32(f"{seed[1]} {seed[0]}".encode())
    least = np.sort(np.argsort(_uniform(salt, keys, 3), kind="stable")[:sample])
    least = least[np.argsort(keys[least], kind="stable")]
    return keys[least], points[least]


def score_after(
    keys: np.ndarray, shingles: np.ndarray, wanted: np.ndarray, seed: tuple[str, int], held: tuple[np.ndarray, np.ndarray],
    interval: int, trees: int, sample: int, refresh: int, warmup: int,
) -> np.ndarray:
    """Score sums over ``trees``, in millionths, of the ``wanted`` windows of one entity; -1 without score; keys ascend.

    ``held`` is the sample of everything before the first key. Windows are scored in aligned stretches of
    ``refresh``; a stretch's trees hold the sample of all windows before it, however long ago. Trees are drawn by what is in
    the sample, so they are kept while it stays the same: the longer a record, the more seldom a new window enters it.
    """
    salt = zlib.crc32(f"{seed[1]} {seed[0]}".encode())
    span = refresh * interval
    scores = np.full(len(keys), -1, dtype=np.int64)
    stretch = keys - keys % span
    taken, grown = 0, None
    for start in np.unique(stretch[wanted]):
        end = int(np.searchsorted(keys, start))
        before, held = held, drawn(
            np.concatenate([held[0], keys[taken:end]]), np.concatenate([held[1], shingles[taken:end]]), sample, seed
        )
        taken = end
        if len(held[0]) < warmup:
            continue
        if grown is None or not np.array_equal(before[0], held[0]):
            rng = np.random.default_rng([salt, zlib.crc32(held[0].tobytes())])
            deviation = held[1].std(axis=0)
            scale = np.where(deviation > 0, deviation, 1.0)
            grown = grow(np.repeat((held[1] / scale)[None], trees, axis=0), rng)
        due = np.flatnonzero((stretch == start) & wanted)
        found = displacement(grown, trees, shingles[due] / scale, keys[due], salt)
        scores[due] = np.rint(found * SCORE_UNIT).astype(np.int64).sum(axis=0)
    return scores


def chunk_shingles(rows: pd.DataFrame, size: int, interval: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and shingles of a chunk's own windows; carried rows only complete the first ones."""
    rows = rows.sort_values("key", kind="stable")
    keys = rows["key"].to_numpy(dtype=np.int64)
    own, shingles = shingle_rows(keys, np.array(rows["vector"].tolist(), dtype=float), size, interval)
    keep = np.isin(own, keys[~rows["carried"].to_numpy(dtype=bool)])
    return own[keep], shingles[keep]


def sampled_chunk(rows: pd.DataFrame, entity: str, size: int, interval: int, blocks: int, sample: int) -> pd.DataFrame:
    """What a chunk of an entity's record offers to the samples of later chunks, for each block of trees."""
    keys, shingles = chunk_shingles(rows, size, interval)
    parts = []
    for block in range(blocks):
        some, points = drawn(keys, shingles, sample, (entity, block))
        parts.append(pd.DataFrame({
            "entity": entity, "chunk": rows["chunk"].iloc[0], "block": block, "key": some, "point": [p.tobytes() for p in points],
        }))
    return pd.concat(parts)


def samples_before(rows: pd.DataFrame, entity: str, block: int, sample: int) -> pd.DataFrame:
    """For every chunk of one (entity, block) the sample of all chunks before it."""
    keys, points, parts = np.empty(0, dtype=np.int64), np.empty(0, dtype=object), []
    for chunk, own in rows.sort_values("chunk", kind="stable").groupby("chunk", sort=True):
        parts.append(pd.DataFrame({"entity": entity, "chunk": chunk, "block": block, "key": keys, "point": points}))
        keys, points = drawn(
            np.concatenate([keys, own["key"].to_numpy(dtype=np.int64)]),
            np.concatenate([points, own["point"].to_numpy(dtype=object)]), sample, (entity, block),
        )
    return pd.concat(parts)


def score_chunk(
    rows: pd.DataFrame, held: pd.DataFrame, entity: str, block: int, size: int, interval: int, **settings: int
) -> pd.DataFrame:
    """Partial scores of one (entity, chunk, block of trees), given the sample of the chunks before."""
    keys, shingles = chunk_shingles(rows, size, interval)
    held = held.sort_values("key", kind="stable")
    points = np.frombuffer(b"".join(held["point"]), dtype=float).reshape(len(held), -1 if len(held) else shingles.shape[1])
    past = held["key"].to_numpy(dtype=np.int64), points
    scores = score_after(keys, shingles, np.ones(len(keys), dtype=bool), (entity, block), past, interval, **settings)
    units = pd.Series(scores, dtype="Int64")
    return pd.DataFrame({"entity": entity, "key": keys, "units": units.mask(units < 0)})
