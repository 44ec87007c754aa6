"""Language identification: the language family first, then linear support vector machines, one against one.

Features are hashed character pairs and triples of the folded text (anything but letters is one space), so whole
texts of any length become one row of fixed width. Families are separated one against one by machines of the same
kind; within the winning family every pair of languages has its own. All machines are fitted on the driver by
dual coordinate descent on a sample of at most ``Settings.sample`` rows, the same number from each language.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netvigil.llm.common import Sent, crc_mod, private

cloudpickle.register_pickle_by_value(sys.modules[__name__])

UNDETERMINED = "und"

# Families of ISO 639-1 codes. A language that isn't listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es pt it ro ca gl oc la",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "baltic": "lt lv",
    "celtic": "ga gd cy br",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tk",
    "indo-aryan": "hi ur bn mr ne pa gu si",
    "iranian": "fa ku ps tg",
    "semitic": "ar he mt am",
    "dravidian": "ta te kn ml",
    "sinitic": "zh yue",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


@dataclass(frozen=True)
class Settings:
    """sample: different rows that the machines are fitted on, at most. width: features. cost, rounds: of the fit."""

    sample: int = 2400
    width: int = 4096
    cost: float = 4.0
    rounds: int = 12


#: Characters of texts taken together; a longer text is taken in slices of this.
PIECE = 1 << 18
_fold: list[np.ndarray] = []


def _folding() -> np.ndarray:
    """For each code point below 0x30000 its lower-case letter, or the space if it is no letter."""
    if not _fold:
        table = np.full(0x30000, 32, np.uint32)
        for c in range(0x30000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _fold.append(table)
    return _fold[0]


def _counts(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-gram counts of each text and whether it has a letter; ``texts`` are counted together."""
    points = np.frombuffer("\n".join(texts).encode("utf-32-le"), "<u4")
    owner = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])[: len(points)]
    table = _folding()
    points = table[np.minimum(points, len(table) - 1)]
    letter = np.bincount(owner, points != 32, minlength=len(texts)) > 0
    # One space where there are several; the line break between two texts is a space of the first.
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != 32) | (points[:-1] != 32) | (owner[1:] != owner[:-1])
    points, owner = points[keep].astype(np.uint64), owner[keep]
    total = np.zeros(len(texts) * width)
    for n, factors in ((2, (0x9E3779B1, 0x85EBCA77)), (3, (0xC2B2AE3D, 0x27D4EB2F, 0x165667B1))):
        if len(points) >= n:
            size = len(points) - n + 1
            mixed = sum(points[k : k + size] * np.uint64(f) for k, f in enumerate(factors)) * np.uint64(0x9E3779B97F4A7C15)
            same = owner[:size] == owner[n - 1 :]
            place = (mixed[same] >> np.uint64(40)).astype(np.int64) % width + owner[:size][same] * width
            total += np.bincount(place, minlength=len(total))
    return total.reshape(len(texts), width), letter


def features(texts: list[str | None], width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of texts: a row of unit length for each (roots of counts), and whether it has a letter."""
    at = 0
    while at < len(texts):
        own, held = [], 0
        while at + len(own) < len(texts) and (not own or held + len(texts[at + len(own)] or "") <= PIECE) and len(own) < 512:
            own.append(texts[at + len(own)] or "")
            held += len(own[-1])
        if held <= PIECE:
            count, letter = _counts(own, width)
        else:
            # Slices overlap by two characters, so that every triple is counted (a pair at a cut counts twice).
            count, letter = np.zeros((1, width)), np.zeros(1, bool)
            for cut in range(0, held, PIECE):
                some, seen = _counts([own[0][cut : cut + PIECE + 2]], width)
                count, letter = count + some, letter | seen
        at += len(own)
        rows = np.sqrt(count)
        yield (rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)).astype(np.float32), letter


def fit_machine(rows: np.ndarray, side: np.ndarray, cost: float, rounds: int) -> np.ndarray:
    """Weights (with a bias at the end) of a linear SVM, squared hinge loss, by dual coordinate descent.

    ``side`` is +1 or -1; both sides weigh the same in all.
    """
    penalty = np.where(side > 0, cost * len(side) / (2 * (side > 0).sum()), cost * len(side) / (2 * (side < 0).sum()))
    diagonal = 0.5 / penalty
    norm = np.einsum("ij,ij->i", rows, rows, dtype=np.float64) + 1 + diagonal
    alpha, weights = np.zeros(len(rows)), np.zeros(rows.shape[1] + 1)
    order = np.random.default_rng(7)
    for _ in range(rounds):
        for i in order.permutation(len(rows)):
            row = rows[i].astype(np.float64)
            gradient = side[i] * (row.dot(weights[:-1]) + weights[-1]) - 1 + diagonal[i] * alpha[i]
            new = max(alpha[i] - gradient / norm[i], 0.0)
            if new != alpha[i]:
                step = (new - alpha[i]) * side[i]
                weights[:-1] += step * row
                weights[-1] += step
                alpha[i] = new
    return weights


@dataclass
class Model:
    """groups: families, then the languages of each; machines: weights for each pair of names of a group."""

    width: int
    families: list[str]
    languages: dict[str, list[str]]
    machines: dict[str, tuple[list[tuple[int, int]], np.ndarray]]

    def _decide(self, group: str, names: list[str], rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The name's number with most wins (then the largest sum of margins), and how sure: the logistic of
        twice its least margin."""
        if len(names) == 1:
            return np.zeros(len(rows), int), np.ones(len(rows))
        pairs, weights = self.machines[group]
        margin = rows @ weights[:-1] + weights[-1]
        wins = np.zeros((len(rows), len(names)))
        total, least = np.zeros_like(wins), np.full_like(wins, np.inf)
        for k, (a, b) in enumerate(pairs):
            for name, own in ((a, margin[:, k]), (b, -margin[:, k])):
                wins[:, name] += own > 0
                total[:, name] += own
                least[:, name] = np.minimum(least[:, name], own)
        best = np.argmax(wins + 0.5 * np.tanh(total / len(names)), axis=1)
        sure = least[np.arange(len(rows)), best]
        return best, 1 / (1 + np.exp(-2 * np.clip(sure, -30, 30)))

    def predict(self, rows: np.ndarray, letter: np.ndarray) -> tuple[list[str], np.ndarray]:
        names, score = np.full(len(rows), UNDETERMINED, object), np.zeros(len(rows))
        if not self.families:
            return names.tolist(), score
        family, sure = self._decide("", self.families, rows)
        for number, name in enumerate(self.families):
            own = np.flatnonzero((family == number) & letter)
            if len(own):
                best, more = self._decide(name, self.languages[name], rows[own])
                names[own] = np.array(self.languages[name], object)[best]
                score[own] = sure[own] * more
        return names.tolist(), score


def _machines(rows: np.ndarray, names: list[str], of: np.ndarray, settings: Settings):
    pairs = list(combinations(range(len(names)), 2))
    columns = []
    for a, b in pairs:
        own = np.isin(of, [names[a], names[b]])
        side = np.where(of[own] == names[a], 1.0, -1.0)
        columns.append(fit_machine(rows if own.all() else rows[own], side, settings.cost, settings.rounds))
    return pairs, np.array(columns).T.astype(np.float32)


def fit(docs: DataFrame, settings: Settings = Settings()) -> Model:
    """Learns from text and lang of the rows given; the caller leaves out what is held out.

    Rows with null or empty text or lang, or lang ``und``, teach nothing. The sample is drawn by a hash
    of doc_id and lang, whatever the text; it reaches the driver as feature rows, ``sample`` of them at most.
    """
    docs = docs.select(
        F.col("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    ).where(f"text <> '' AND lang <> '{UNDETERMINED}'")
    sizes = {r[0]: r[1] for r in docs.groupBy("lang").count().collect()}
    if not sizes:
        return Model(settings.width, [], {}, {})
    share = max(1, settings.sample // len(sizes))
    draw = F.xxhash64("doc_id", "lang") % (1 << 30)
    take = F.lit(False)
    for lang, size in sizes.items():
        take = take | ((F.col("lang") == lang) & (F.abs(draw) < int(min(1.0, 0.95 * share / size) * (1 << 30))))
    width = settings.width

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(1).to_pylist()
            at = 0
            for made, letter in features(batch.column(0).to_pylist(), width):
                out = [(r.astype("<f2").tobytes(), n) for r, n, ok in zip(made, langs[at : at + len(made)], letter) if ok]
                at += len(made)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r for r, _ in out], pa.binary()), pa.array([n for _, n in out], pa.string())],
                    names=["row", "lang"],
                )

    sample = docs.where(take).select("text", "lang").mapInArrow(rows, "row binary, lang string")
    # Equal rows teach once, so that a hot text can't fill the sample.
    sample = sorted(sample.distinct().limit(settings.sample).collect(), key=lambda r: (r[1], bytes(r[0])))
    of = np.array([r[1] for r in sample], object)
    made = np.frombuffer(b"".join(r[0] for r in sample), "<f2").astype(np.float32).reshape(len(sample), width)
    languages: dict[str, list[str]] = {}
    for lang in sorted(set(of)):
        languages.setdefault(_FAMILY.get(lang.lower(), lang), []).append(lang)
    families = sorted(languages)
    machines = {"": _machines(made, families, np.array([_FAMILY.get(x.lower(), x) for x in of], object), settings)}
    for family, own in languages.items():
        machines[family] = _machines(made, own, of, settings)
    return Model(width, families, languages, machines)


def _predicted(model: Model, texts: pa.Array) -> tuple[list[str], list[float]]:
    names: list[str] = []
    scores: list[float] = []
    for made, letter in features(texts.to_pylist(), model.width):
        some, sure = model.predict(made, letter)
        names += some
        scores += sure.tolist()
    return names, scores


def held_out(doc_id: Column) -> Column:
    """Rows kept from learning: crc32 of doc_id as text is divisible by 5. Without doc_id: false."""
    return F.coalesce(crc_mod(doc_id, 5) == 0, F.lit(False))


def _learnable(docs: DataFrame) -> DataFrame:
    return docs.where(crc_mod(F.col("doc_id"), 5) != 0)


def identify(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs``, learned from its rows that aren't held out.

    ``docs`` needs doc_id, text and lang; other columns are ignored. A prediction sees the text only. Null texts and
    texts without a letter are ``und`` with score 0, and so is everything when no row teaches a language. A row
    without doc_id is neither held out nor learned from. Very long texts are read whole; an empty table gives no rows. Repeated rows are predicted alike; the score is the product
    of how sure both steps are, from 0 to 1.
    """
    shared = Sent(docs.sparkSession, fit(_learnable(docs), settings))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            names, scores = _predicted(model, batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    texts = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(rows, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, settings: Settings = Settings(), least_score: float = 0.0) -> DataFrame:
    """The rows of ``docs`` whose text has a language, with all their columns; nothing is shuffled.

    Rejected are texts that are ``und`` (null, or without a letter) and those below ``least_score``. A kept row without
    ``lang`` gets the predicted one. Without rows that teach a language every text is ``und``; very long texts are read
    whole; repeated rows are judged alike; an empty table stays empty.
    """
    shared = Sent(docs.sparkSession, fit(_learnable(docs), settings))
    name, lang_at = private(docs, "plain_text"), [c.lower() for c in docs.columns].index("lang")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            names, scores = _predicted(model, batch.column(batch.num_columns - 1))
            keep = [n != UNDETERMINED and s >= least_score for n, s in zip(names, scores)]
            columns = batch.columns[:-1]
            columns[lang_at] = pc.coalesce(columns[lang_at], pa.array(names, columns[lang_at].type))
            made = pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])
            yield made.filter(pa.array(keep, pa.bool_()))

    return docs.withColumn(name, F.col("text").cast("string")).mapInArrow(rows, docs.schema)
