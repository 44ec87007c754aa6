"""Packing into sequences whose mixture of sources is controlled: deficit round-robin over one queue for each source.

A round hands every queue its quantum, the source's target share of one sequence. A queue sends packets, which are
documents or pieces of at most PACKET ids, while its deficit counter covers the next one; what it can't spend stays for the
next round. Rounds follow each other without a gap and are cut into sequences, so a sequence holds one round's worth of
tokens in the target proportions, to within a packet for each source, and the differences never add up.

A queue that is never empty before the last round sends the packet that ends at its token e in the first round whose
quanta, and the credit it began with, reach e: a formula of e alone. So no round waits for the one before it, and
counters need not be handed from task to task: they follow from where a task's rounds begin. Targets are the sources'
shares of all tokens, so that queues empty together; other targets are weights, under which a queue that empties leaves
its share to the others (stretches of rounds with fixed quanta, at most one for each weighted source).

Texts are tokenised once and stored. Queues are in the order of what was stored; places in a queue are sums over tasks.
Packets travel once, to the task of their range of rounds, which holds an equal number of tokens whatever the sources.
"""

from __future__ import annotations

import os
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from netvigil.llm.common import partitions
from netvigil.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Ids of a sequence, of the longest packet; the id behind each document.
LENGTH, PACKET, END = 4096, 512, 2
VOCABULARY = "word_bpe_49k.json"
#: What stands between chunks that are asked for together: a control character, which texts hardly hold.
SIGN = "\x01"
#: Chunks of text whose ids a task keeps; bytes of text that are split together.
KNOWN, TOGETHER = 1 << 19, 1 << 22
#: Ranges of rounds for each shuffle partition: with several, they are spread evenly.
RANGES = 4

TOKENS = "doc_id long, queue string, part int, before long, n long, ids binary"
#: Ids travel in 16 bits where all of a vocabulary fit.
NARROW, WIDE = "<u2", "<u4"
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "queue string"
)


def kind_of(tokenizer) -> str:
    return NARROW if tokenizer.get_vocab_size() <= 1 << 16 else WIDE


class Encoder:
    """Ids of texts by ``tokenizers``, which is asked once for each different chunk between ASCII white space.

    The vocabulary splits at white space and drops it, so a chunk has the same ids in any text; a letter and the ASCII sign
    behind it are apart too, and A-Z are folded, which leaves fewer different chunks. New chunks are asked for in few calls,
    with a sign between them that has one id of its own. Texts that hold the sign, or a special token in whatever case, are
    encoded whole.
    """

    def __init__(self, path: str):
        # One thread: a task has one core, and every further thread keeps memory of its own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] + [SIGN]
        self.border, = self.tokenizer.encode(SIGN, add_special_tokens=False).ids
        self.kind = kind_of(self.tokenizer)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.ends = np.empty(0, dtype=np.uint32), np.zeros(1, dtype=np.int64)

    def _learn(self, chunks: list[str]) -> None:
        if not chunks:
            return
        between = f" {SIGN} "
        asked = [between.join(chunks[i:i + 500]) + between for i in range(0, len(chunks), 500)]
        got = self.tokenizer.encode_batch_fast(asked, add_special_tokens=False)
        ids = np.concatenate([np.array(x.ids, dtype=np.uint32) for x in got])
        ends = np.flatnonzero(ids == self.border)
        self.known.update(zip(chunks, range(len(self.known), len(self.known) + len(chunks))))
        self.ends = np.concatenate([self.ends, self.ends[-1] + ends - np.arange(len(ends))])
        self.ids = np.concatenate([self.ids, ids[ids != self.border]])

    def _chunked(self, texts: pa.Array) -> list[np.ndarray]:
        """``texts`` in lower case (ASCII), without special tokens."""
        if len(self.known) > KNOWN:
            self.forget()
        apart = pc.replace_substring_regex(texts, r"(\pL)([!-/:-@\[-`{-~])", r"\1 \2")
        lists = pc.ascii_split_whitespace(apart)
        coded = lists.flatten().dictionary_encode()
        chunks = coded.dictionary.to_pylist()
        self._learn([c for c in chunks if c not in self.known])
        number = np.fromiter(map(self.known.__getitem__, chunks), dtype=np.int64, count=len(chunks))
        first, size = self.ends[number], np.diff(self.ends)[number]
        of = coded.indices.to_numpy()
        stop = np.cumsum(size[of])
        ids = self.ids[np.repeat(first[of] - stop + size[of], size[of]) + np.arange(stop[-1] if len(stop) else 0)]
        borders = np.concatenate([[0], stop])[lists.offsets.to_numpy()]
        return [ids[a:b] for a, b in zip(borders[:-1], borders[1:])]

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text, none null."""
        lower = pc.ascii_lower(texts)
        whole = pa.array(np.zeros(len(texts), dtype=bool))
        for token in self.special:
            whole = pc.or_(whole, pc.match_substring(lower, token, ignore_case=True))
        sizes, low = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)), 0
        while low < len(texts):
            high = max(low + 1, int(np.searchsorted(sizes, (sizes[low - 1] if low else 0) + TOGETHER)))
            some = whole.slice(low, high - low)
            found = iter(self._chunked(lower.slice(low, high - low).filter(pc.invert(some))))
            for alone, text in zip(some.to_pylist(), texts.slice(low, high - low)):
                if alone:
                    got = self.tokenizer.encode(text.as_py(), add_special_tokens=False)
                    yield np.array(got.ids, dtype=np.uint32)
                else:
                    yield next(found)
            low = high


def _tokeniser(path: str, end: int):
    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Also the ids of a document's queue that this task met before it."""
        encoder, met, part = Encoder(path), {}, TaskContext.get().partitionId()
        for batch in batches:
            # Few documents at a time: what is held grows with texts, not with the rows of a batch.
            for low in range(0, batch.num_rows, 1000):
                some = batch.slice(low, 1000)
                before, sizes, ids = [], [], []
                for queue, found in zip(some.column(1).to_pylist(), encoder.encode(some.column(2))):
                    before.append(met.get(queue, 0))
                    sizes.append(len(found) + 1)
                    met[queue] = before[-1] + sizes[-1]
                    ids.append(np.append(found, np.uint32(end)).astype(encoder.kind).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0), some.column(1), pa.array([part] * len(ids), pa.int32()),
                        pa.array(before, pa.int64()), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()),
                    ],
                    ["doc_id", "queue", "part", "before", "n", "ids"],
                )

    return tokenise


def tokens(docs: DataFrame, path: str, end: int = END, queue: Column | None = None) -> DataFrame:
    """Every row's ids (little-endian, 16 bits if the vocabulary allows) with ``end`` behind them, as stored; null texts are
    empty."""
    queue = F.coalesce(F.col("source").cast("string"), F.lit("")) if queue is None else queue
    given = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), queue.alias("queue"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return stored(given.mapInArrow(_tokeniser(path, end), TOKENS), "tokens")


def stretches(sizes: dict[str, int], weights: dict[str, float], length: int) -> list[tuple]:
    """(queue, first, quantum, sent, until) for stretches of rounds in which quanta are fixed: the first round, the tokens
    a round, and the places in the queue between which its packets end.

    A stretch lasts as many whole rounds as no queue runs empty; then the share of what is empty goes to the others in
    proportion to their weights. At most one stretch for each queue.
    """
    sent, out, first = {s: 0.0 for s, n in sizes.items() if n}, [], 0
    while sent:
        whole = sum(weights[s] for s in sent)
        quantum = {s: length * weights[s] / whole for s in sent}
        rounds = max(1, int(min((sizes[s] - sent[s]) / quantum[s] for s in sent)))
        until = {s: sent[s] + rounds * quantum[s] for s in sent}
        # Less than a round's worth is sent with the rest, so that some queue ends in each stretch.
        until = {s: float(sizes[s]) if sizes[s] - x < max(1.0, quantum[s]) else x for s, x in until.items()}
        out += [(s, first, quantum[s], sent[s], until[s]) for s in sent]
        sent = {s: x for s, x in until.items() if x < sizes[s]}
        first += rounds
    return out


def _placed(width: int, ranges: int, rounds: int):
    """Splits documents into packets, and each packet's round follows from where it ends in its queue. ``width``: bytes of an
    id, or 0 where ids are left out."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 1000) for b in batches for i in range(0, b.num_rows, 1000)):
            n, queued = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            plan = batch.column(4)
            first_of, steps = plan.offsets.to_numpy(), plan.flatten()  # offsets go on from an earlier slice
            first, quantum, sent, until = (steps.field(i).to_numpy() for i in range(4))
            credit = batch.column(5).to_numpy()
            count = -(-n // PACKET)
            row = np.repeat(np.arange(len(n)), count)
            at = (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)) * PACKET
            size = np.minimum(PACKET, n[row] - at)
            e = queued[row] + at + size
            step = first_of[:-1][row].astype(np.int64) - first_of[0]
            last = first_of[1:][row].astype(np.int64) - first_of[0] - 1
            while True:
                later = (step < last) & (e > until[step])
                if not later.any():
                    break
                step[later] += 1
            due = e - sent[step] - np.where(sent[step] == 0, credit[row], 0)
            at_round = first[step] + np.maximum(0, np.ceil(due / quantum[step]).astype(np.int64) - 1)
            at_round = np.minimum(at_round, rounds - 1)
            of = pa.array(row)
            out = [
                pa.array(at_round * ranges // rounds), pa.array(at_round), batch.column(1).take(of), pa.array(e),
                pa.array(size),
            ]
            names = ["span", "round", "queue", "e", "size"]
            if width:
                data = batch.column(6).to_pylist()
                out += [batch.column(0).take(of), pa.array(n[row]), pa.array(at)]
                out += [pa.array([data[r][width * a:width * (a + s)] for r, a, s in zip(row, at, size)], pa.binary())]
                names += ["doc_id", "doc_tokens", "at", "ids"]
            yield pa.RecordBatch.from_arrays(out, names)

    return place


def sequence_of(place: int, total: int, length: int) -> tuple[int, int, int]:
    """(sequence, offset, ids to the sequence's end) of a token's place. Behind the last full sequence come shorter ones whose
    sizes are the powers of two that the rest is the sum of, largest first."""
    full = total // length
    if place < full * length:
        return place // length, place % length, length - place % length
    offset, rest, sequence = place - full * length, total - full * length, full
    while rest:
        size = 1 << (rest.bit_length() - 1)
        if offset < size:
            return sequence, offset, size - offset
        offset, rest, sequence = offset - size, rest - size, sequence + 1
    raise ValueError(f"place {place} lies behind {total} tokens")


def _cutter(starts: np.ndarray, total: int, length: int, kind: str):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in the order of the stream within each span; ``starts`` has the place of each span's first token."""
        columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "queue"]
        kinds = [pa.int64()] * 7 + [pa.string()]
        span, place, piece, out = -1, 0, None, []

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 8, kinds)], columns
            )

        for batch in batches:
            for of, queue, e, size, doc_id, doc_tokens, at, ids in zip(*(batch.column(i).to_pylist() for i in range(8))):
                if of != span:
                    if piece:
                        out.append(tuple(piece[:8]))
                    span, place, piece = of, int(starts[of]), None
                done, ids = 0, np.frombuffer(ids, kind).astype(WIDE).tobytes()
                while done < size:
                    sequence, offset, room = sequence_of(place, total, length)
                    n = min(size - done, room)
                    part = ids[4 * done:4 * (done + n)]
                    # piece[8] is where its queue goes on: packets of one document that meet are one piece.
                    if piece and piece[5] == sequence and piece[7:] == [queue, e - size + done] and at + done:
                        piece[2] += n
                        piece[3] = zlib.crc32(part, piece[3])
                        piece[8] += n
                    else:
                        if piece:
                            out.append(tuple(piece[:8]))
                        piece = [
                            doc_id, at + done, n, zlib.crc32(part), doc_tokens, sequence, offset, queue, e - size + done + n,
                        ]
                    done, place = done + n, place + n
                if len(out) >= 10_000:
                    yield rows()
                    out = []
        if piece:
            out.append(tuple(piece[:8]))
        yield rows()

    return cut


def packed(
    docs: DataFrame, path: str, weights: dict[str, float] | None = None, length: int = LENGTH, end: int = END
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, queue): one row for each piece of a document.

    ``docs`` has doc_id (an integer), text and source; further columns are ignored. ``path`` is a vocabulary file that every
    executor has. ``weights`` are target proportions of sources, positive; what isn't named shares the weight of ``""``
    (1 if not given) in one queue. Without weights the target of a source is its share of all tokens.

    Every id of every document is in one piece, ids of a piece are consecutive. All sequences but the last ones are full;
    the rest is cut into sequences of powers of two, so nothing is padded. Null and empty texts are the one id ``end``; null
    sources are the source ``""``; very long texts are tokenised whole and sent in packets; repeated rows and null doc_ids are
    documents of their own. Ties need no rule: queues are in stored order. An empty table gives no rows.
    """
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))
    if weights is not None:
        weights = {"": 1.0} | weights
        if min(weights.values()) <= 0:
            raise ValueError("weights must be positive")
        source = F.when(source.isin(list(weights)), source).otherwise(F.lit(""))
    kind = kind_of(Tokenizer.from_file(path))
    held = tokens(docs, path, end, source)
    spark = held.sparkSession
    mine = held.groupBy("queue", "part").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    mine = stored(mine.withColumn("earlier", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "queue-places")
    sizes = mine.groupBy("queue").agg(F.sum("n").alias("n"))
    total = mine.agg(F.sum("n")).first()[0] or 0
    if weights is None:
        rounds = max(1, -(-total // length))
        steps = sizes.select("queue", F.array(F.struct(
            F.lit(0).cast("long").alias("first"), (F.lit(float(length)) * F.col("n") / F.lit(float(max(1, total)))).alias("quantum"),
            F.lit(0.0).alias("sent"), F.col("n").cast("double").alias("until"),
        )).alias("plan"))
    else:
        plan = stretches({q: n for q, n in sizes.collect()}, weights, length)  # no more queues than weights
        rounds = 1 + max([first + int(-(-(until - sent) // quantum)) for _, first, quantum, sent, until in plan], default=0)
        steps = spark.createDataFrame(plan, "queue string, first long, quantum double, sent double, until double")
        steps = steps.groupBy("queue").agg(F.sort_array(F.collect_list(F.struct("first", "quantum", "sent", "until"))).alias("plan"))
    credit = F.pmod(F.xxhash64("queue"), F.lit(PACKET)).alias("credit")
    known = mine.select("queue", "part", "earlier").join(steps, "queue")
    of = held.join(known, ["queue", "part"]).withColumn("place", F.col("before") + F.col("earlier"))
    columns = ["doc_id", "queue", "n", "place", "plan", credit]
    ranges = min(rounds, RANGES * partitions(held))
    spans = of.select(*columns).mapInArrow(_placed(0, ranges, rounds), "span long, round long, queue string, e long, size long")
    starts = np.zeros(ranges + 1, dtype=np.int64)
    for span, n in spans.groupBy("span").agg(F.sum("size")).collect():
        starts[span + 1] = n
    placed = of.select(*columns, "ids").mapInArrow(
        _placed(np.dtype(kind).itemsize, ranges, rounds),
        "span long, round long, queue string, e long, size long, doc_id long, doc_tokens long, at long, ids binary",
    )
    ordered = placed.repartition("span").sortWithinPartitions("span", "round", "queue", "e").drop("round")
    return ordered.mapInArrow(_cutter(np.cumsum(starts), total, length, kind), PIECES)
