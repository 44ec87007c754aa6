"""Importance resampling towards a target: hashed n-gram weights, a Gumbel draw, and a cutoff found by counting.

Two passes read the texts. The first counts n-gram buckets of the corpus and of the target; its result has one number a
bucket, whatever the size of the corpus, and becomes an array of gains. The second sums every document's gains by that
array and stores one small row a document. The best rows are found without sorting the rest: the range of scores is
halved again and again by exact count jobs over the stored rows until the cutoff is known, then the range of doc_ids
among the rows at the cutoff. Only what is drawn is range-partitioned and ranked.

Buckets are crc32 of features that overlap (each word is in up to six runs), so the crc of a run is put together from
those of its words: crc32 is linear, and appending n bytes to a text maps its crc by a fixed table for each n.
"""

from __future__ import annotations

import math
import re
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netvigil.llm.common import numbered, private
from netvigil.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Buckets of the features, words of the longest run, per cent drawn, words of the shortest document drawn from, seed.
BUCKETS, RUN, PERCENT, LEAST_WORDS, SEED = 10_000, 3, 5, 20, 42
#: Bytes of text that are hashed together; longer texts are cut between words.
PART = 1 << 21
#: Words up to so many bytes are hashed side by side, longer ones one by one.
SHORT = 32

_GAP = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
_U = np.uint32


def _step_table() -> np.ndarray:
    """What crc32 makes of a register's lowest byte (the polynomial of zlib, reflected)."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & _U(1), (table >> _U(1)) ^ _U(0xEDB88320), table >> _U(1))
    return table


def _shifted(crc: np.ndarray, table: np.ndarray) -> np.ndarray:
    """crcs mapped by one table of four times 256 entries: as if zero bytes were appended."""
    return (
        table[0][crc & _U(255)] ^ table[1][(crc >> _U(8)) & _U(255)]
        ^ table[2][(crc >> _U(16)) & _U(255)] ^ table[3][crc >> _U(24)]
    )


class Crc:
    """Tables for crc32 of many byte strings at once. Made inside the task; nothing of it is sent."""

    def __init__(self) -> None:
        self.step = _step_table()
        byte = np.arange(256, dtype=np.uint32)
        tables = [np.stack([byte << _U(8 * k) for k in range(4)])]
        for _ in range(SHORT + 1):
            tables.append(self.step[tables[-1] & _U(255)] ^ (tables[-1] >> _U(8)))
        self.by_length = np.stack(tables)
        self.by_power = [self.by_length[1]]
        for _ in range(31):
            last = self.by_power[-1]
            self.by_power.append(np.stack([_shifted(row, last) for row in last]))

    def words(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """crc32 of data[starts[i] : starts[i] + lengths[i]]."""
        order = np.argsort(-lengths, kind="stable")
        begin, length = starts[order], lengths[order]
        long = int(np.searchsorted(-length, -SHORT, "left"))
        state = np.full(len(order), 0xFFFFFFFF, dtype=np.uint32)
        for j in range(min(SHORT, int(length[long]) if long < len(length) else 0)):
            active = int(np.searchsorted(-length, -j, "left"))
            now = state[long:active]
            state[long:active] = self.step[(now ^ data[begin[long:active] + j]) & _U(255)] ^ (now >> _U(8))
        state ^= _U(0xFFFFFFFF)
        for i in range(long):
            state[i] = zlib.crc32(data[begin[i]:begin[i] + length[i]].tobytes())
        out = np.empty_like(state)
        out[order] = state
        return out

    def appended(self, crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """crcs after so many zero bytes each: xor with the crc of what follows gives the crc of both together."""
        if not len(crc):
            return crc
        near = np.minimum(lengths, SHORT + 1)
        out = self.by_length[near, 0, crc & _U(255)]
        for k in range(1, 4):
            out = out ^ self.by_length[near, k, (crc >> _U(8 * k)) & _U(255)]
        far = np.flatnonzero(lengths > SHORT + 1)
        if len(far):
            rest, state = lengths[far] - (SHORT + 1), out[far]
            for k in range(int(rest.max()).bit_length()):
                has = (rest >> k) & 1 == 1
                state[has] = _shifted(state[has], self.by_power[k])
            out[far] = state
        return out


def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For each byte: whether it is part of a word, and the byte in lower case (A-Z only)."""
    byte = np.arange(256)
    upper = (byte >= 0x41) & (byte <= 0x5A)
    word = upper | (byte >= 0x80) | ((byte >= 0x30) & (byte <= 0x39)) | ((byte >= 0x61) & (byte <= 0x7A))
    return word, np.where(upper, byte + 32, byte).astype(np.uint8)


def _parts(texts: list[bytes | None]) -> Iterator[tuple[list[int], list[bytes], list[int]]]:
    """Groups of about PART bytes: text numbers, pieces of texts, and how many leading words a piece repeats.

    A text over PART bytes is cut at bytes that are in no word; each later piece starts with the two words before it,
    so that runs across the cut are whole.
    """
    rows, pieces, repeats, size = [], [], [], 0
    word = re.compile(rb"[0-9A-Za-z\x80-\xFF]+")
    for row, text in enumerate(texts):
        text, start, before = text or b"", 0, []
        while start < len(text):
            end = len(text)
            if end - start > PART:
                gap = _GAP.search(text, start + PART)
                end = gap.start() if gap else end
            piece = text[start:end]
            rows.append(row)
            pieces.append(b" ".join([*before, piece]) if before else piece)
            repeats.append(len(before))
            if end < len(text):
                before = [*before, *(m.group() for m in word.finditer(piece))][-(RUN - 1):]
            size, start = size + len(pieces[-1]), end
            if size >= PART:
                yield rows, pieces, repeats
                rows, pieces, repeats, size = [], [], [], 0
    if rows:
        yield rows, pieces, repeats


def features(texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, buckets, new words of each row) of groups of texts: a bucket for each run of 1 to 3 words, by its text's
    number; the third array counts the words of each of ``texts``."""
    crc, (is_word, lower) = Crc(), _letters()
    for rows, pieces, repeats in _parts(texts):
        data = np.frombuffer(b"\n".join(pieces) + b"\n", dtype=np.uint8)
        inside = is_word[data]
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        starts, lengths = edges[::2], edges[1::2] - edges[::2]
        sizes = np.array([len(p) + 1 for p in pieces], dtype=np.int64)
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        piece = np.searchsorted(first, starts, "right") - 1
        place = np.arange(len(starts)) - np.searchsorted(piece, piece, "left")
        row, old = np.array(rows, dtype=np.int64)[piece], np.array(repeats, dtype=np.int64)[piece]
        words = crc.words(lower[data], starts, lengths)
        space = np.full(len(words), zlib.crc32(b" "), dtype=np.uint32)
        spaced = crc.appended(space, lengths) ^ words  # a space and the word
        found_rows, found = [], []
        run = words
        for n in range(1, RUN + 1):
            if n > 1:
                run = crc.appended(run[:-1], lengths[n - 1:] + 1) ^ spaced[n - 1:]
            last = slice(n - 1, None)
            good = (place[last] >= n - 1) & (place[last] >= old[last])
            found_rows.append(row[last][good])
            found.append((run % _U(BUCKETS))[good])
            if len(run) < 2:
                break
        new = np.bincount(row[place >= old], minlength=len(texts))
        yield np.concatenate(found_rows), np.concatenate(found), new


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        for _, buckets, _ in features(batch.column(0).cast(pa.binary()).to_pylist()):
            total += np.bincount(buckets, minlength=BUCKETS)
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], ["bucket", "n"])


def bucket_counts(texts: DataFrame, text: str = "text") -> np.ndarray:
    """How many features of the texts lie in each bucket: at most BUCKETS numbers, whatever the number of texts."""
    rows = texts.select(F.col(f"`{text}`").cast("string").alias("text"))
    counted = rows.mapInArrow(_counter, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, dtype=np.int64)
    for bucket, n in counted.collect():
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the logarithm of how much likelier a bucket is in the target, both counts smoothed by one; floors."""
    whole_corpus, whole_target = int(corpus.sum()) + BUCKETS, int(target.sum()) + BUCKETS
    return np.array([
        math.floor(1000 * math.log(float(t + 1) * whole_corpus / (float(s + 1) * whole_target)))
        for s, t in zip(corpus.tolist(), target.tolist())
    ], dtype=np.int64)


def _weigher(gain: np.ndarray):
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            words, found, weight = (np.zeros(len(texts), dtype=np.int64) for _ in range(3))
            for rows, buckets, new in features(texts):
                words += new
                found += np.bincount(rows, minlength=len(texts))
                # Sums of doubles are exact here: a group of texts is far below 2**53.
                weight += np.bincount(rows, gain[buckets], len(texts)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found), pa.array(weight), pa.array(words)],
                ["doc_id", "n_features", "weight", "n_words"],
            )

    return weigh


def luck(doc_id: Column, seed: int = SEED) -> Column:
    """A Gumbel variate times 1000, floored, from the first 32 bits of sha256 of seed and doc_id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def _bisected(least: int, most: int, enough) -> int:
    """The largest number in the range for which ``enough`` holds; it holds for ``least`` and up to some number."""
    while least < most:
        middle = (least + most + 1) // 2
        if enough(middle):
            least = middle
        else:
            most = middle - 1
    return least


def cutoff(rows: DataFrame, wanted: int) -> tuple[int, int] | None:
    """(score, doc_id) of the row that is last among the ``wanted`` best: scores down, then ids up. None: no row.

    Every step is one count over ``rows`` (stored, columns ``score`` and ``id``): about as many steps as the range of
    scores has bits, and as the range of ids at the cutoff has.
    """
    if wanted <= 0:
        return None
    least, most = rows.agg(F.min("score"), F.max("score")).first()
    score = _bisected(least, most, lambda x: rows.where(F.col("score") >= x).count() >= wanted)
    tied = rows.where(F.col("score") == score)
    first, last = tied.agg(F.min("id"), F.max("id")).first()
    open_places = wanted - rows.where(F.col("score") > score).count()
    back = _bisected(-last, -first, lambda x: tied.where(F.col("id") <= -x).count() >= open_places)
    return score, -back


def resampled(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs``, all long; rank is null for what isn't drawn.

    ``docs`` has ``doc_id`` (an integer) and ``text``, ``target`` has ``text``; further columns are ignored. A null text
    or one without words has no features and weight 0; it is never drawn unless ``least_words`` is 0. Very long texts
    are read whole, in pieces. An empty target gives every bucket the gain of its rarity; an empty ``docs`` gives no
    rows. A null doc_id hashes as the empty text and comes last among ties. Repeated rows are documents of their own;
    rows equal in score and doc_id are ranked in any order, and the last places go to some of them.
    """
    gain = gains(bucket_counts(docs), bucket_counts(target))
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    weighed = given.mapInArrow(_weigher(gain), "doc_id long, n_features long, weight long, n_words long")
    scored = stored(weighed.withColumn("score", F.col("weight") + luck(F.col("doc_id"), seed)), "scores")
    able = scored.where(F.col("n_words") >= least_words).select(
        "score", F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("id")
    )
    wanted = percent * able.count() // 100
    last = cutoff(able, wanted)
    columns = ["doc_id", "n_features", "weight", "score"]
    if last is None:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    score, last_id = last
    drawn = (F.col("n_words") >= least_words) & ((F.col("score") > score) | (
        (F.col("score") == score) & (F.coalesce("doc_id", F.lit((1 << 63) - 1)) <= last_id)
    ))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    ranked = numbered(scored.where(drawn).select(*columns), order, "place", "drawn")
    rank = F.when(F.col("place") < wanted, F.col("place") + 1).cast("long")
    rest = scored.where(~drawn).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*columns, rank.alias("rank")).union(rest)


def drawn_documents(docs: DataFrame, target: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that are drawn, with all their columns; a doc_id drawn once brings all rows that have it."""
    wanted = private(docs, "drawn_id")
    ids = resampled(docs, target, percent).where("rank is not null").select(F.col("doc_id").alias(wanted)).distinct()
    return docs.join(ids, F.col("doc_id").eqNullSafe(F.col(wanted)), "left_semi")


#: crc32 by its table, byte by byte, once for each different feature.
RESAMPLING_SQL = f"""
WITH steps AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS step
  FROM (SELECT unnest(range(256)) AS i)),
texts AS (SELECT row_number() OVER () AS r, true AS ours, doc_id, text FROM documents
  UNION ALL SELECT -row_number() OVER (), false, NULL, text FROM benchmark),
split AS (SELECT r, ours, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM texts),
runs AS (SELECT r, ours, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS f
  FROM split, (SELECT unnest(range(1, {RUN} + 1)) AS n)),
held AS (SELECT r, ours, f, count(*) AS k FROM runs GROUP BY ALL),
hexes AS (SELECT f, hex(encode(f)) AS x FROM held GROUP BY f),
crcs AS (SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, len(x) // 2),
    lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
  lambda a, b: xor(a >> 8, step[xor(a & 255, b) + 1])), 4294967295) % {BUCKETS} AS bucket FROM hexes, steps),
cells AS (SELECT r, ours, bucket, sum(k)::BIGINT AS k FROM held JOIN crcs USING (f) GROUP BY ALL),
sums AS (SELECT bucket, coalesce(sum(k) FILTER (ours), 0) AS s, coalesce(sum(k) FILTER (NOT ours), 0) AS t FROM cells GROUP BY bucket),
whole AS (SELECT coalesce(sum(s), 0) AS s_all, coalesce(sum(t), 0) AS t_all FROM sums),
gain AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (s_all + {BUCKETS})::DOUBLE
  / ((s + 1)::DOUBLE * (t_all + {BUCKETS})::DOUBLE)))::BIGINT AS g FROM sums, whole),
weights AS (SELECT r, sum(k)::BIGINT AS n_features, sum(k * g)::BIGINT AS weight FROM cells JOIN gain USING (bucket) GROUP BY r),
scored AS (SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5)
    / 4294967296.0)))::BIGINT AS score
  FROM split LEFT JOIN weights USING (r) WHERE ours),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_words >= {LEAST_WORDS} ORDER BY score DESC, doc_id) AS place,
  (SELECT {PERCENT} * count(*) // 100 FROM scored WHERE n_words >= {LEAST_WORDS}) AS wanted FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= {LEAST_WORDS} AND place <= wanted THEN place END AS rank FROM ranked
"""
