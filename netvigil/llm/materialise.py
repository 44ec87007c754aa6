"""Training order: sequences of token ids in shards of fixed stride, shuffled by a keyed permutation.

Every sequence has an index in the order in which the documents are scanned. A Feistel network over the smallest
even number of bits that covers all indexes, walked on while it leaves the range, maps the index to a global slot:
a bijection that anybody with the key can compute, in both directions, without a table. Slots are cut into shards by
range; a shard is a file of equal records, so slot s lies at a known place and reading can start or resume anywhere.
"""

from __future__ import annotations

import json
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netvigil.llm.files import Ranges, make_folder, publish
from netvigil.llm.shingles import mix
from netvigil.session import new_path, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Ids of a sequence, sequences of a shard, rounds of the network.
LENGTH, SHARD, ROUNDS = 512, 1 << 16, 6
#: Sequences that are compressed together for the shuffle, over all shards.
TOGETHER = 1 << 14
#: Byte values that UTF-8 never holds: the end of a document, and what fills its last sequence.
END, PAD = 0xFE, 0xFF
_U = np.uint64


def _half_bits(total: int) -> int:
    return max(1, -(-max(1, (total - 1).bit_length()) // 2))


def _keys(key: int) -> np.ndarray:
    return mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) + _U(key % (1 << 64)) * _U(0x9E3779B97F4A7C15))


def _network(x: np.ndarray, bits: int, keys: np.ndarray, back: bool) -> np.ndarray:
    mask = _U((1 << bits) - 1)
    left, right = x >> _U(bits), x & mask
    for k in keys[::-1] if back else keys:
        if back:
            left, right = right ^ (mix(left ^ k) & mask), left
        else:
            left, right = right, left ^ (mix(right ^ k) & mask)
    return left << _U(bits) | right


def permute(index: np.ndarray, total: int, key: int, back: bool = False) -> np.ndarray:
    """The slots of indexes below ``total`` (or with ``back`` the indexes of slots): a permutation of 0 .. total - 1."""
    bits, keys = _half_bits(total), _keys(key)
    out = _network(index.astype(np.uint64), bits, keys, back)
    # The covering range is less than four times the total, so few walk on for long.
    while len(far := np.flatnonzero(out >= total)):
        out[far] = _network(out[far], bits, keys, back)
    return out.astype(np.int64)


def byte_ids(text: str | None) -> bytes:
    """Byte-level token ids: the UTF-8 bytes and ``END``; null and empty texts have none."""
    return text.encode() + bytes([END]) if text else b""


def _sizes(column: pa.Array) -> np.ndarray:
    """Sequences of each text, from its bytes alone."""
    column = column.cast(pa.large_string()).fill_null("").cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    size = np.diff(ends)
    return np.where(size > 0, -(-(size + 1) // LENGTH), 0)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = sum(int(_sizes(batch.column(1)).sum()) for batch in batches)
    yield pa.RecordBatch.from_arrays(
        [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total], pa.int64())], names=["part", "n"]
    )


#: Blocks of sequences on their way to a shard: their places as numbers, their ids compressed together.
_BLOCK = pa.schema([("shard", pa.int32()), ("places", pa.binary()), ("ids", pa.binary())])


def _blocks(places: np.ndarray, records: np.ndarray) -> pa.RecordBatch:
    """A row for each shard that these sequences go to."""
    order = np.argsort(places[:, 0])
    places, records = places[order], records[order]
    shards = places[:, 0] // SHARD
    cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
    rows = [
        (int(shards[lo]), places[lo:hi].tobytes(), zlib.compress(records[lo:hi].tobytes(), 1))
        for lo, hi in zip(cuts[:-1], cuts[1:])
    ]
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), _BLOCK)], schema=_BLOCK)


def _sequences(starts: dict[int, tuple[int, int]], total: int, key: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        at, end = starts.get(part, (0, 0))
        for batch in batches:
            sizes = _sizes(batch.column(1))
            ends = np.cumsum([0, *sizes])
            # Some texts at a time; what a long one makes goes on in several blocks.
            row = 0
            while row < batch.num_rows:
                to = max(row + 1, int(np.searchsorted(ends, ends[row] + TOGETHER, "right")) - 1)
                texts = batch.column(1).slice(row, to - row).to_pylist()
                owner = np.repeat(np.arange(row, to), sizes[row:to])
                number = np.arange(len(owner)) - np.repeat(ends[row:to] - ends[row], sizes[row:to])
                ids = [byte_ids(t) for t in texts]
                used = np.minimum(LENGTH, np.repeat([len(x) for x in ids], sizes[row:to]) - number * LENGTH)
                flat = b"".join(x.ljust(int(n) * LENGTH, bytes([PAD])) for x, n in zip(ids, sizes[row:to]))
                slots = permute(np.arange(at, at + len(owner)), total, key) if len(owner) else np.empty(0, np.int64)
                at += len(owner)
                records = np.frombuffer(flat, np.uint8).reshape(len(owner), LENGTH)
                doc = batch.column(0).slice(row, to - row)
                known = np.array(doc.is_valid().to_pylist(), bool)
                doc = np.where(known, doc.fill_null(0).to_numpy(), 0)[owner - row]
                places = np.stack([slots, doc, known[owner - row], number, used], axis=1).astype("<i8")
                for lo in range(0, len(owner), TOGETHER):
                    yield _blocks(places[lo : lo + TOGETHER], records[lo : lo + TOGETHER])
                row = to
        if at != end:
            raise RuntimeError("the documents came in another order than when they were counted; store them first")

    return rows


_PLACES = "slot long, shard int, byte_offset long, doc_id long, part_no long, n_ids int"


def shard_path(folder: str, shard: int) -> str:
    return f"{folder}/shard-{shard:06d}.bin"


def _write(folder: str, total: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, list[tuple[bytes, bytes]]] = {}
        for batch in batches:
            for shard, places, ids in zip(*(batch.column(i).to_pylist() for i in range(3))):
                blocks.setdefault(shard, []).append((places, ids))
        for shard in sorted(blocks):
            own = blocks.pop(shard)
            places = np.frombuffer(b"".join(p for p, _ in own), "<i8").reshape(-1, 5)
            order = np.argsort(places[:, 0])
            records = np.frombuffer(b"".join(zlib.decompress(d) for _, d in own), np.uint8).reshape(-1, LENGTH)
            places, first = places[order], shard * SHARD
            if (places[:, 0] != np.arange(first, min(first + SHARD, total))).any() if len(places) == min(SHARD, total - first) else True:
                raise RuntimeError(f"shard {shard} lacks slots or holds some twice")

            def write(out, records=records, order=order) -> None:
                for at in range(0, len(order), 1 << 13):
                    out.write(records[order[at : at + (1 << 13)]].tobytes())

            publish(shard_path(folder, shard), write)
            slots, docs, known, number, used = places.T
            yield pa.RecordBatch.from_arrays([
                pa.array(slots), pa.array(np.full(len(slots), shard), pa.int32()), pa.array((slots - first) * LENGTH),
                pa.array(docs, mask=known == 0), pa.array(number), pa.array(used, pa.int32()),
            ], names=["slot", "shard", "byte_offset", "doc_id", "part_no", "n_ids"])

    return rows


def materialise(docs: DataFrame, folder: str, key: int = 1) -> DataFrame:
    """Writes all sequences of ``docs`` as shards below ``folder``: (slot, shard, byte_offset, doc_id, part_no, n_ids), a
    row for each sequence, read from where it was stored.

    ``docs`` needs doc_id and text; other columns are ignored. A document's ids (``byte_ids``) are cut into sequences of
    ``LENGTH``, the last one filled with ``PAD``; null and empty texts have no sequence, repeated rows have theirs each,
    null doc_ids stay null, an empty table makes no shard. ``docs`` is scanned twice, to count and to cut, and must come
    in the same partitions both times, as files do; each task checks that. Every shard holds ``SHARD`` sequences but
    the last; ``layout.json`` names key, stride and total. A file appears under its name only when it is complete, and
    a repeated task writes the same bytes.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    starts, total = {}, 0
    for part, n in sorted((r[0], r[1]) for r in rows.mapInArrow(_count, "part int, n long").collect()):
        starts[part] = (total, total + n)
        total += n
    make_folder(folder)
    layout = json.dumps({"key": key, "length": LENGTH, "shard": SHARD, "total": total, "end": END, "pad": PAD})
    publish(f"{folder}/layout.json", lambda out: out.write(layout.encode()))
    made = rows.mapInArrow(_sequences(starts, total, key), "shard int, places binary, ids binary")
    made = made.repartitionById(max(1, -(-total // SHARD)), F.col("shard"))
    return stored(made.mapInArrow(_write(folder, total), _PLACES), "sequence-places")


def read_slots(folder: str, first: int, count: int) -> Iterator[bytes]:
    """The records of ``count`` slots from ``first`` on, in training order; a run stops at the last slot."""
    with Ranges(f"{folder}/layout.json") as file:
        layout = json.loads(file.read(0, file.size))
    size, shard_size = layout["length"], layout["shard"]
    at, end = first, min(layout["total"], first + count)
    while at < end:
        shard = at // shard_size
        upto = min(end, (shard + 1) * shard_size)
        with Ranges(shard_path(folder, shard)) as file:
            while at < upto:
                n = min(upto - at, 1024)
                data = file.read((at - shard * shard_size) * size, n * size)
                yield from (data[k : k + size] for k in range(0, len(data), size))
                at += n


def training_order(docs: DataFrame, key: int = 1) -> DataFrame:
    """``materialise`` into a new folder of the shared one."""
    return materialise(docs, new_path(docs.sparkSession, "shards"), key)
