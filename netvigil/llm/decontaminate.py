"""Benchmark decontamination: BM25 over an inverted index of the test items, searched with block-max WAND.

The index holds the items, which are few; the queries are all passages of all training documents. A posting's
weight is its BM25 part divided by the item's own score, so a score is the share of the item's weight that a
passage covers and one threshold fits items of any length. Items are dealt to index shards of bounded size by a
hash; each shard is broadcast in turn and the documents pass by it, so nothing of unbounded size is broadcast.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netvigil.llm.common import Sent, private
from netvigil.llm.shingles import word_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words of items in one index shard, on average.
SHARD_WORDS = 2_000_000
#: Postings of a block.
BLOCK = 32
#: Ranges of items with a largest weight of each term, and bytes of that table at most; rows added up at once.
RANGES, RANGE_BYTES, ROWS = 64, 32 << 20, 1 << 14
K1, B = 1.2, 0.75


@dataclass(frozen=True)
class Limits:
    """score: share of an item's BM25 weight that a passage must cover to be retrieved. question, answer: share
    of the word n-grams (3 and 2 words) of the item's question and answer that the passage must hold."""

    score: float = 0.6
    question: float = 0.5
    answer: float = 0.5


@dataclass
class Index:
    """Postings of a shard in item order, with the largest weight of each term, of each block of its postings, and
    in each range of items."""

    terms: np.ndarray
    starts: np.ndarray
    items: np.ndarray
    weights: np.ndarray
    top: np.ndarray
    block_starts: np.ndarray
    block_last: np.ndarray
    block_top: np.ndarray
    item_ids: list[int]
    questions: list[np.ndarray]
    answers: list[np.ndarray]
    window: int
    range_size: int
    range_top: np.ndarray = field(repr=False)
    filter: np.ndarray = field(repr=False)


def _hashes(texts: list[str]) -> list[np.ndarray]:
    out = []
    for _, words, ends in word_hashes(pa.array(texts, pa.large_string()), letters=True):
        out += [words[lo:hi] for lo, hi in zip(ends[:-1], ends[1:])]
    return out


def question_and_answer(text: str) -> tuple[str, str]:
    """The answer is the last sentence or line; of a single sentence, its last fifth of words."""
    parts = [p for p in re.split(r"(?<=[.!?])\s+|\n+", text.strip()) if re.search(r"\w", p)]
    if len(parts) > 1:
        return " ".join(parts[:-1]), parts[-1]
    words = text.split()
    cut = len(words) - max(1, len(words) // 5)
    return (" ".join(words[:cut]), " ".join(words[cut:])) if cut > 0 else (text, "")


def _ngrams(words: np.ndarray, width: int) -> np.ndarray:
    """Distinct n-grams of ``width`` words, or of all words if there are fewer."""
    width = max(1, min(width, len(words)))
    total = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for k in range(width if len(total) else 0):
        total = total * np.uint64(0x9E3779B97F4A7C15) + words[k : k + len(total)]
    return np.unique(total)


def _length_class(words: np.ndarray) -> int:
    """The power of two, 32 at least, that an item's words fit in: what is looked at for an item depends on it alone."""
    return max(32, 1 << (len(words) - 1).bit_length())


def build_index(items: list[tuple[int, str]], frequency: dict[int, int], total: int, mean: float) -> Index:
    """The index of one shard's items of one length class, whose size the passages follow. ``frequency``: items of the whole
    table that hold a term, by the term's hash."""
    words = _hashes([text for _, text in items])
    postings: dict[int, list[tuple[int, float]]] = {}
    for number, own in enumerate(words):
        terms, count = np.unique(own, return_counts=True)
        df = np.array([frequency[t] for t in terms.tolist()], float)
        weight = np.log(1 + (total - df + 0.5) / (df + 0.5)) * count * (K1 + 1)
        weight /= count + K1 * (1 - B + B * len(own) / mean)
        for term, share in zip(terms.tolist(), (weight / weight.sum()).tolist()):
            postings.setdefault(term, []).append((number, share))
    terms = np.array(sorted(postings), np.uint64)
    rows = [postings[t] for t in terms.tolist()]
    starts = np.cumsum([0, *map(len, rows)])
    numbers = np.array([n for r in rows for n, _ in r], np.int64)
    weights = np.array([w for r in rows for _, w in r])
    block_starts, last, top = [0], [], []
    for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist()):
        for at in range(lo, hi, BLOCK):
            last.append(numbers[min(at + BLOCK, hi) - 1])
            top.append(weights[at : min(at + BLOCK, hi)].max())
        block_starts.append(len(last))
    parts = [question_and_answer(text) for _, text in items]
    ranges = max(1, min(RANGES, len(items), RANGE_BYTES // (4 * max(1, len(terms)))))
    size = -(-len(items) // ranges)
    range_top = np.zeros((len(terms), -(-len(items) // size)), np.float32)
    np.maximum.at(range_top, (np.repeat(np.arange(len(terms)), np.diff(starts)), numbers // size), weights)
    small = np.zeros(1 << 16, bool)
    small[(terms & np.uint64(0xFFFF)).astype(np.int64)] = True
    return Index(
        terms, starts, numbers, weights, np.array([max(w for _, w in r) for r in rows]),
        np.array(block_starts), np.array(last, np.int64), np.array(top), [i for i, _ in items],
        [_ngrams(w, 3) for w in _hashes([q for q, _ in parts])], [_ngrams(w, 2) for w in _hashes([a for _, a in parts])],
        2 * max(map(_length_class, words), default=0), size, range_top, small,
    )


def search(index: Index, terms: list[int], least: float, first: int, end: int) -> list[tuple[int, float]]:
    """(item, score) of the items from ``first`` up to ``end`` that the query's distinct terms give at least ``least``:
    block-max WAND.

    Lists are kept in the order of their current items. The pivot is the first item at which the largest weights
    of the lists up to it could reach the threshold; if the largest weights of the blocks around it can't, all of
    these lists leap behind the nearest end of a block, else the pivot is scored or the lists move up to it.
    """
    at = {t: int(index.starts[t]) for t in terms}
    stop = {t: int(index.starts[t + 1]) for t in terms}
    now = {t: int(index.items[at[t]]) for t in terms}
    block = {t: int(index.block_starts[t]) for t in terms}
    found: list[tuple[int, float]] = []

    def move(term: int, item: int) -> None:
        lo = at[term]
        lo += int(np.searchsorted(index.items[lo : stop[term]], item))
        at[term] = lo
        now[term] = int(index.items[lo]) if lo < stop[term] else end

    for term in terms:
        if now[term] < first:
            move(term, first)
    while True:
        order = sorted((t for t in terms if now[t] < end), key=now.__getitem__)
        total, pivot = 0.0, -1
        for place, term in enumerate(order):
            total += index.top[term]
            if total >= least - 1e-9:
                pivot = place
                break
        if pivot < 0:
            return found
        item = now[order[pivot]]
        while pivot + 1 < len(order) and now[order[pivot + 1]] == item:
            pivot += 1
        ahead = order[: pivot + 1]
        bound = 0.0
        for term in ahead:
            while index.block_last[block[term]] < item and block[term] + 1 < index.block_starts[term + 1]:
                block[term] += 1
            bound += index.block_top[block[term]]
        if bound < least - 1e-9:
            after = min(int(index.block_last[block[t]]) for t in ahead)
            if pivot + 1 < len(order):
                after = min(after, now[order[pivot + 1]] - 1)
            for term in ahead:
                move(term, max(after, item) + 1)
        elif now[order[0]] == item:
            score = sum(float(index.weights[at[t]]) for t in ahead)
            if score >= least - 1e-9:
                found.append((item, score))
            for term in ahead:
                move(term, item + 1)
        else:
            for term in ahead:
                if now[term] < item:
                    move(term, item)


def _overlap(wanted: np.ndarray, held: np.ndarray) -> float:
    return 1.0 if not len(wanted) else float(np.isin(wanted, held).mean())


def _passages(shard: list[Index], column: pa.Array, limits: Limits) -> Iterator[tuple[int, int, float, float, float]]:
    """(row, item's id, score, question overlap, answer overlap) of every retrieved passage; texts are hashed once."""
    for row, words, ends in word_hashes(column, letters=True):
        for index in shard:
            for text, item, *values in _retrieved(index, words, ends, limits):
                yield row + text, index.item_ids[item], *values


def _retrieved(
    index: Index, words: np.ndarray, ends: np.ndarray, limits: Limits
) -> Iterator[tuple[int, int, float, float, float]]:
    """(text, item, score, question overlap, answer overlap) of texts given by their words' hashes."""
    width, stride = index.window, index.window // 2
    if len(words):
        known = np.flatnonzero(index.filter[(words & np.uint64(0xFFFF)).astype(np.int64)])
        place = np.minimum(np.searchsorted(index.terms, words[known]), len(index.terms) - 1)
        hit = index.terms[place] == words[known]
        known, place = known[hit], place[hit]
        # Windows are two steps long, twice the class of the items, and overlap by half: one of them holds any copy whole.
        sizes = np.diff(ends)
        steps = -(-sizes // stride)
        windows = np.where(sizes > 0, np.maximum(1, steps - 1), 0)
        text = np.repeat(np.arange(len(sizes)), windows)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows)
        first = ends[:-1][text] + nth * stride
        last = np.minimum(first + width, ends[1:][text])
        lo, hi = np.searchsorted(known, first), np.searchsorted(known, last)
        # No item of a range can score more than the range's largest weights of the terms of both steps.
        own = np.searchsorted(ends, known, "right") - 1
        before = np.concatenate(([0], np.cumsum(steps)))
        step, term = np.divmod(np.unique((before[own] + (known - ends[own]) // stride) * len(index.terms) + place), len(index.terms))
        most = np.zeros((before[-1] + 2, index.range_top.shape[1]), np.float32)
        for some in range(0, len(step), ROWS):
            part = step[some : some + ROWS]
            cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
            most[part[cuts]] += np.add.reduceat(index.range_top[term[some : some + ROWS]], cuts, axis=0)
        at = before[text] + nth
        bound = (most[at] + most[at + 1] * (steps[text] > 1)[:, None]).max(1, initial=0)
        for w in np.flatnonzero(bound >= limits.score - 1e-4).tolist():
            terms = np.array(sorted(set(place[lo[w] : hi[w]].tolist())))
            bound = index.range_top[terms].sum(0)
            grams = None
            for item, score in (
                pair for part in np.flatnonzero(bound >= limits.score - 1e-4).tolist()
                for pair in search(
                    index, terms.tolist(), limits.score, part * index.range_size, (part + 1) * index.range_size
                )
            ):
                if grams is None:
                    own = words[first[w] : last[w]]
                    # Shorter n-grams than usual only occur in items of one or two words.
                    grams = {n: _ngrams(own, n) for n in (1, 2, 3)}
                question, answer = index.questions[item], index.answers[item]
                held = np.concatenate(list(grams.values()))
                yield int(text[w]), item, score, _overlap(question, held), _overlap(answer, held)


PAIR = pa.schema([
    ("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()),
    ("answer_overlap", pa.float64()),
])


def _shards(items: DataFrame) -> Iterator[list[Index]]:
    """Index shards one after another, each an index for every length class in it; item texts reach the driver a shard at a
    time. All classes of a shard are searched in one pass over the documents."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.where("item_id IS NOT NULL AND text IS NOT NULL").distinct()

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, words, ends in word_hashes(batch.column(1), letters=True):
                for lo, hi in zip(ends[:-1], ends[1:]):
                    own = np.unique(words[lo:hi]).view(np.int64)
                    if len(own):
                        size = np.zeros(len(own), np.int64)
                        size[0] = hi - lo
                        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(size)], names=["term", "size"])

    pairs = items.mapInArrow(terms, "term long, size long")
    total, size = pairs.agg(F.count(F.when(F.col("size") > 0, 1)), F.sum("size")).first()
    if not total:
        return
    count = -(-size // SHARD_WORDS)
    deal = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for shard in range(count):
        own = items.where(deal == shard)
        wanted = own.mapInArrow(terms, "term long, size long").select("term").distinct()
        frequency = pairs.join(wanted, "term", "left_semi").groupBy("term").count().collect()
        texts = [(r[0], r[1]) for r in own.collect()]
        classes: dict[int, list[tuple[int, str]]] = {}
        for item, words in zip(texts, _hashes([x for _, x in texts])):
            if len(words):
                classes.setdefault(_length_class(words), []).append(item)
        by_term = {r[0] % (1 << 64): r[1] for r in frequency}
        if classes:
            yield [build_index(sorted(classes[k]), by_term, total, size / total) for k in sorted(classes)]


def contaminations(docs: DataFrame, items: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap): test items that documents contain.

    Every passage of every document is a query; a pair is retrieved at ``limits.score`` and kept where the passage
    also holds enough of the question and of the answer, with the values of its best passage. ``docs`` needs
    doc_id and text, ``items`` item_id and text; other columns are ignored. Null, empty or wordless texts on either
    side match nothing; rows of ``docs`` without doc_id are left out here (``decontaminate`` does check them);
    repeated rows give one pair; an empty table on either side gives no rows. Items that share an item_id but not the
    text are indexed each and reported under the one id.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.where("doc_id IS NOT NULL")
    ddl = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
    found = spark.createDataFrame([], ddl)
    for shard in _shards(items):
        shared = Sent(spark, shard)

        def rows(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            indexes = shared.value
            for batch in batches:
                ids = batch.column(0).to_pylist()
                best: dict[tuple[int, int], tuple[float, float, float]] = {}
                for row, item, *values in _passages(indexes, batch.column(1), limits):
                    key = ids[row], item
                    if values[1] >= limits.question and values[2] >= limits.answer:
                        best[key] = max(best.get(key, (0.0, 0.0, 0.0)), tuple(values))
                out = [(*key, *values) for key, values in best.items()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in out], f.type) for i, f in enumerate(PAIR)], schema=PAIR
                )

        found = found.union(texts.mapInArrow(rows, ddl))
    best = F.max(F.struct("score", "question_overlap", "answer_overlap")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")


def decontaminate(docs: DataFrame, items: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` that contain no test item, with all their columns; nothing is shuffled.

    Judges each row as ``contaminations`` does, rows without doc_id included. Null and empty texts stay.
    """
    name = private(docs, "plain_text")
    for shard in _shards(items):
        shared = Sent(docs.sparkSession, shard)

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            indexes = shared.value
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for row, _, _, question, answer in _passages(indexes, batch.column(batch.num_columns - 1), limits):
                    if question >= limits.question and answer >= limits.answer:
                        keep[row] = False
                yield batch.filter(pa.array(keep)).select(range(batch.num_columns - 1))

        docs = docs.withColumn(name, F.col("text").cast("string")).mapInArrow(clean, docs.schema)
    return docs
