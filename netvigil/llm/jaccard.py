"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence, with bounds from set sizes.

The incidence matrix is cut into cells of (block of documents) x (block of n-grams). A cell holds its postings as
sorted 48-bit n-gram numbers and 16-bit document numbers and moves through the shuffle as one binary value, so
work per n-gram happens in numpy and no task holds more than a column or a row of cells.

1. Columns: an n-gram that only one document has can't be part of an overlap and is dropped. What is left of each
   document must be at least the threshold's share of its set, or it links with nothing (the overlap with a
   partner is at least threshold * own size). This leaves copies, near copies and little else.
2. Equal sets become one representative; copies are never expanded into pairs.
3. Two linked sets share one of their rarest n-grams (as many as they may lose, plus one) and have sizes within
   the threshold's ratio. Representatives that meet in such a posting and size class are joined to the least of
   them, not to each other; connected, they make up groups that contain every link.
4. In every group the most central set (largest share of n-grams others have too) is compared with all. What that
   doesn't link is multiplied with the whole group, block by block: overlaps are accumulated n-gram by n-gram,
   pairs below the bound are discarded, and each block returns a forest of its links, not all of them.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netvigil.llm.common import components, partitions, private, without
from netvigil.llm.shingles import mix, shingle_sets
from netvigil.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: N-grams and documents that a block of documents holds at most (one longer document may exceed the first).
BLOCK_GRAMS, BLOCK_DOCS = 1 << 19, 1 << 15
#: Representatives on a side of a product block.
SIDE = 512
#: Overlap increments expanded at once.
STEP = 1 << 21
_U = np.uint64


def needed(size: np.ndarray, over: int, under: int) -> np.ndarray:
    """The least overlap with any linked partner of a set of that size: the threshold over/under, rounded up."""
    return -(-size * over // under)


def linked(overlap, one, other, over: int, under: int):
    """Whether overlap / (one + other - overlap) reaches over/under, in integers."""
    return under * overlap >= over * (one + other - overlap)


# --- cells -------------------------------------------------------------------------------------------------------


def _planes(grams: np.ndarray) -> bytes:
    """Sorted 48-bit numbers as three planes of 16 bits: the first compresses to almost nothing."""
    return b"".join((grams >> _U(s)).astype("<u2").tobytes() for s in (32, 16, 0))


def _grams(planes: bytes) -> np.ndarray:
    high, middle, low = np.frombuffer(planes, "<u2").reshape(3, -1).astype(np.uint64)
    return high << _U(32) | middle << _U(16) | low


CELL = pa.schema([
    ("column", pa.int32()), ("block", pa.int64()), ("grams", pa.binary()), ("docs", pa.binary()), ("names", pa.binary()),
])
CELL_DDL = "column int, block long, grams binary, docs binary, names binary"


def _directory(ids: list[int], sets: list[np.ndarray]) -> bytes:
    """For each document of a block: doc_id, size and two sums that tell sets apart."""
    sums = [(mix(s).sum(dtype=np.uint64), mix(s ^ _U(0x5851F42D4C957F2D)).sum(dtype=np.uint64)) for s in sets]
    table = np.empty((len(ids), 4), "<i8")
    table[:, 0] = ids
    table[:, 1] = [len(s) for s in sets]
    table[:, 2:] = np.array(sums, np.uint64).view(np.int64)
    return table.tobytes()


def _cells(width: int, columns: int):
    def flush(block: int, ids: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
        grams = np.concatenate(sets)
        docs = np.repeat(np.arange(len(ids), dtype=np.uint16), [len(s) for s in sets])
        column = (grams & _U(0xFFFF)) % _U(columns)
        order = np.argsort(grams, kind="stable")
        order = order[np.argsort(column[order].astype(np.uint16), kind="stable")]
        grams, docs, column = grams[order] >> _U(16), docs[order], column[order]
        cuts = np.searchsorted(column, np.arange(columns + 1, dtype=np.uint64))
        rows = [
            (c, block, _planes(grams[lo:hi]), docs[lo:hi].astype("<u2").tobytes(), None)
            for c, (lo, hi) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if hi > lo
        ]
        rows.append((block % columns, block, None, None, _directory(ids, sets)))
        return pa.RecordBatch.from_arrays(
            [pa.array(v, f.type) for v, f in zip(zip(*rows), CELL)], schema=CELL
        )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The partition's number and a running number name a block; a repeated task gives the same names.
        block, ids, sets, held = TaskContext.get().partitionId() << 24, [], [], 0
        for batch in batches:
            for doc, grams in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1), width)):
                ids.append(doc)
                sets.append(grams)
                held += len(grams)
                if held >= BLOCK_GRAMS or len(ids) == BLOCK_DOCS:
                    yield flush(block, ids, sets)
                    block, ids, sets, held = block + 1, [], [], 0
        if ids:
            yield flush(block, ids, sets)

    return cut


SHARED_DDL = "block long, grams binary, docs binary, rarity binary, names binary"


def _shared(key: tuple, cells: pd.DataFrame) -> pd.DataFrame:
    """One column of cells without the n-grams of a single document, with a rarity class for the others."""
    column = _U(int(key[0]))
    out = [(b, None, None, None, n) for b, n in zip(cells["block"], cells["names"]) if n is not None]
    cells = cells[cells["grams"].notna()]
    if len(cells):
        parts = [_grams(g) for g in cells["grams"]]
        ends = np.cumsum([0, *map(len, parts)])
        grams = np.concatenate(parts)
        del parts
        order = np.argsort(grams, kind="stable")
        ranked = grams[order]
        fresh = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
        count = np.diff(np.append(fresh, len(ranked)))
        frequency = np.empty(len(grams), np.int64)
        frequency[order] = np.repeat(count, count)
        del ranked, order
        # Sixteenths of a doubling: a fixed order of n-grams, whatever the number of documents.
        rarity = np.minimum(np.log2(frequency) * 8, 255).astype(np.uint8)
        for block, docs, lo, hi in zip(cells["block"], cells["docs"], ends[:-1], ends[1:]):
            keep = frequency[lo:hi] > 1
            if keep.any():
                own = grams[lo:hi][keep]
                out.append((
                    block, (own << _U(16) | column).astype("<u8").tobytes(),
                    np.frombuffer(docs, "<u2")[keep].tobytes(), rarity[lo:hi][keep].tobytes(), None,
                ))
    return pd.DataFrame(out, columns=["block", "grams", "docs", "rarity", "names"])


SETS_DDL = "doc_id long, size long, sum1 long, sum2 long, shared long, grams binary"


def _candidates(over: int, under: int):
    def rows(cells: pd.DataFrame) -> pd.DataFrame:
        """The documents of one block; ``grams`` (rarest first) only where enough of the set is shared."""
        names = np.frombuffer(cells["names"].dropna().iloc[0], "<i8").reshape(-1, 4)
        cells = cells[cells["grams"].notna()]
        join = lambda name, kind: np.frombuffer(b"".join(cells[name]), kind)
        docs = join("docs", "<u2")
        shared = np.bincount(docs, minlength=len(names))
        size = names[:, 1]
        enough = (size > 0) & (shared >= needed(size, over, under))
        keep = enough[docs]
        docs, grams, rarity = docs[keep], join("grams", "<u8")[keep], join("rarity", np.uint8)[keep]
        order = np.lexsort((grams, rarity, docs))
        ends = np.searchsorted(docs[order], np.arange(len(names) + 1))
        grams = grams[order]
        return pd.DataFrame({
            "doc_id": names[:, 0], "size": size, "sum1": names[:, 2], "sum2": names[:, 3], "shared": shared,
            "grams": [
                grams[lo:hi].tobytes() if ok else None for ok, lo, hi in zip(enough, ends[:-1], ends[1:])
            ],
        })

    return rows


def _document_sets(docs: DataFrame, width: int, over: int, under: int) -> DataFrame:
    columns = min(2 * partitions(docs), 1 << 15)
    cells = docs.mapInArrow(_cells(width, columns), CELL_DDL)
    shared = cells.groupBy("column").applyInPandas(_shared, SHARED_DDL)
    return shared.groupBy("block").applyInPandas(_candidates(over, under), SETS_DDL)


# --- groups ------------------------------------------------------------------------------------------------------


def _prefixes(over: int, under: int):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """(posting, rep): the rarest n-grams of each set, as many as a linked partner may lack and one more,
        under the size classes in which a partner can be."""
        ratio = np.log(under / over)
        for batch in batches:
            keys, reps = [], []
            for rep, size, grams in zip(batch["rep"], batch["size"], batch["grams"]):
                grams = np.frombuffer(grams, "<u8")
                grams = grams[: len(grams) - int(needed(size, over, under)) + 1]
                # Linked sizes differ by the ratio at most, so they share one of two neighbouring classes.
                own = int(np.log(size) / ratio + 1e-9)
                for k in (own, own + 1):
                    keys.append(mix(grams ^ mix(np.array([k + 1], np.uint64))).view(np.int64))
                    reps.append(np.full(len(grams), rep, np.int64))
            if keys:
                yield pd.DataFrame({"posting": np.concatenate(keys), "rep": np.concatenate(reps)})

    return rows


def _groups(reps: DataFrame, over: int, under: int) -> DataFrame:
    """(node, component): representatives in groups that no link leaves; those that meet nobody are left out."""
    postings = stored(
        reps.select("rep", "size", "grams").mapInPandas(_prefixes(over, under), "posting long, rep long"), "postings"
    )
    hubs = postings.groupBy("posting").agg(F.min("rep").alias("hub"), F.max("rep").alias("most"))
    hubs = stored(hubs.where("hub <> most").select("posting", "hub"), "hubs")
    edges = postings.join(hubs, "posting").where("rep <> hub").select(F.col("rep").alias("a"), F.col("hub").alias("b"))
    return components(edges)


# --- products ----------------------------------------------------------------------------------------------------


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The product of two blocks of the incidence matrix: how many n-grams each left set shares with each right."""
    lg, rg = np.concatenate(left), np.concatenate(right)
    li = np.repeat(np.arange(len(left)), [len(x) for x in left])
    ri = np.repeat(np.arange(len(right)), [len(x) for x in right])
    ro = np.argsort(rg, kind="stable")
    rg, ri = rg[ro], ri[ro]
    lo, hi = np.searchsorted(rg, lg, "left"), np.searchsorted(rg, lg, "right")
    count = hi - lo
    total = np.zeros(len(left) * len(right), np.int64)
    ends = np.cumsum(count)
    at = 0
    while at < len(lg):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + STEP, "right")))
        n = count[at:to]
        if n.any():
            which = np.repeat(np.arange(at, to), n)
            place = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + lo[which]
            total += np.bincount(li[which] * len(right) + ri[place], minlength=len(total))
        at = to
    return total.reshape(len(left), len(right))


def _forest(pairs: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    """Edges that connect what the pairs connect, at most one for each node."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in pairs:
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return [(x, root(x)) for x in parent if root(x) != x]


def _with_pivot(over: int, under: int):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for grams, size, pivot, other in zip(batch["grams"], batch["size"], batch["pivot_grams"], batch["pivot_size"]):
                both = np.isin(np.frombuffer(grams, "<u8"), np.frombuffer(pivot, "<u8"), assume_unique=True).sum()
                found.append(bool(linked(int(both), int(size), int(other), over, under)))
            yield batch[["part", "rep", "pivot"]].assign(near=found)

    return rows


def _product(over: int, under: int):
    def rows(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int]] = []
        if len(left) and len(right):
            sets = [[np.frombuffer(g, "<u8") for g in side["grams"]] for side in (left, right)]
            both = overlaps(*sets)
            a, b = left["size"].to_numpy()[:, None], right["size"].to_numpy()[None, :]
            one, other = np.nonzero((both > 0) & linked(both, a, b, over, under))
            out = _forest(zip(left["rep"].to_numpy()[one].tolist(), right["rep"].to_numpy()[other].tolist()))
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return rows


def _links(reps: DataFrame, groups: DataFrame, over: int, under: int) -> DataFrame:
    """Links (a, b) that connect the representatives of each group as all of its links do."""
    groups = stored(groups.select(F.col("node").alias("rep"), F.col("component").alias("part")), "groups")
    members = stored(reps.join(groups, "rep").select("part", "rep", "size", "shared", "grams"), "members")
    central = F.struct((F.col("shared") / F.col("size")).alias("c"), (-F.col("size")).alias("s"), (-F.col("rep")).alias("r"))
    pivots = stored(
        members.groupBy("part").agg(F.max(central).alias("top")).select("part", (-F.col("top.r")).alias("rep")), "pivots"
    )
    pivots = stored(
        members.join(pivots, ["part", "rep"]).dropDuplicates(["part"]).select(
            "part", F.col("rep").alias("pivot"), F.col("size").alias("pivot_size"), F.col("grams").alias("pivot_grams")
        ), "pivot-sets",
    )
    compared = stored(
        members.join(pivots, "part").mapInPandas(
            _with_pivot(over, under), "part long, rep long, pivot long, near boolean"
        ), "compared",
    )
    sizes = compared.groupBy("part").agg(
        F.count(F.lit(1)).alias("all"), F.count(F.when(~F.col("near"), 1)).alias("rest")
    ).where("rest > 0")
    sides = stored(sizes.select(
        "part", F.ceil(F.col("all") / SIDE).cast("int").alias("wide"), F.ceil(F.col("rest") / SIDE).cast("int").alias("high")
    ), "sides")
    place = lambda n: F.pmod(F.xxhash64("rep", "size"), F.col(n)).cast("int")
    rest = members.join(compared.where(~F.col("near")).select("part", "rep").distinct(), ["part", "rep"]).join(sides, "part")
    rest = rest.withColumn("i", place("high")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("wide") - 1)))
    whole = members.join(sides, "part").withColumn("j", place("wide"))
    whole = whole.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("high") - 1)))
    names = ["part", "i", "j", "rep", "size", "grams"]
    rest, whole = rest.select(names).toDF(*names), whole.select(names).toDF(*names)
    found = rest.groupBy("part", "i", "j").cogroup(whole.groupBy("part", "i", "j"))
    found = found.applyInPandas(_product(over, under), "a long, b long")
    return compared.where("near").select(F.col("rep").alias("a"), F.col("pivot").alias("b")).union(found)


# --- the operator ------------------------------------------------------------------------------------------------


def jaccard_components(docs: DataFrame, width: int = 5, threshold: float = 0.75) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row: connected components under Jaccard similarity.

    ``docs`` needs doc_id and text; other columns are ignored. Words are runs of bytes other than ASCII white
    space, A to Z lower-cased; a set is a text's distinct shingles of ``width`` words (fewer words: the whole
    sequence; none, or null text: empty, linked with nothing). Two sets link when their intersection is at least
    ``threshold`` of their union. component_id is the smallest doc_id reachable. Rows that repeat a doc_id are
    one node, each with its own n_shingles; a row without doc_id is returned with component_id null and links
    with nothing. An empty table gives an empty result.
    """
    limit = Fraction(str(threshold))
    over, under = limit.numerator, limit.denominator
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sets = stored(_document_sets(texts.where("doc_id IS NOT NULL"), width, over, under), "sets")
    near = sets.where("grams IS NOT NULL")
    alike = ["size", "sum1", "sum2"]
    least = stored(near.groupBy(*alike).agg(F.min("doc_id").alias("rep")), "representatives")
    named = stored(near.select("doc_id", *alike).join(least, alike).select("doc_id", "rep"), "copies")
    reps = near.join(least.withColumnRenamed("rep", "doc_id"), ["doc_id", *alike])
    reps = reps.dropDuplicates(["doc_id", *alike]).withColumnRenamed("doc_id", "rep")
    reps = stored(reps.select("rep", "size", "shared", "grams"), "distinct-sets")
    links = _links(reps, _groups(reps, over, under), over, under)
    # A doc_id that stands on several rows ties their sets together.
    twice = named.groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("top")).where("b <> top")
    twice = named.join(twice, "doc_id").select(F.col("rep").alias("a"), "b")
    found = stored(components(links.union(twice)), "components")
    named = named.join(found.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("doc_id", F.coalesce("component", "rep").alias("component")).where("doc_id <> component")
    named = stored(named.distinct(), "classes")
    known = sets.select("doc_id", F.col("size").alias("n_shingles")).join(named, "doc_id", "left")
    known = known.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    nameless = texts.where("doc_id IS NULL").mapInArrow(_sizes(width), "n_shingles long")
    return known.unionByName(nameless.select(
        F.lit(None).cast("long").alias("doc_id"), "n_shingles", F.lit(None).cast("long").alias("component_id")
    ))


def _sizes(width: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [len(s) for s in shingle_sets(batch.column(1), width)]
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64())], names=["n_shingles"])

    return rows


def keep_one(docs: DataFrame, width: int = 5, threshold: float = 0.75) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row with the smallest doc_id.

    Columns and values stay as they are. Of rows that repeat a doc_id one stays; rows without doc_id, and texts
    without words, all stay.
    """
    found = jaccard_components(docs, width, threshold).where("doc_id IS NOT NULL")
    more = found.groupBy("doc_id").agg(F.min("component_id").alias("least"), F.count(F.lit(1)).alias("n"))
    more = stored(more, "kept-ids")
    other = private(docs, "other_id")
    kept = without(docs, "doc_id", more.where("doc_id <> least").select("doc_id"))
    if not more.where("n > 1").limit(1).count():
        return kept
    twice = more.where("n > 1 AND doc_id = least").select(F.col("doc_id").alias(other))
    single = kept.join(twice, kept["doc_id"] == F.col(other), "left_anti")
    repeated = kept.join(twice, kept["doc_id"] == F.col(other), "left_semi")
    return single.unionByName(repeated.dropDuplicates(["doc_id"]))
