"""Unigram encoding and decoding with a SentencePiece vocabulary: Viterbi over a double-array trie of its pieces.

A space becomes the marker U+2581 and the text starts with one more. Characters that no piece covers, and a literal
U+2581, become the byte pieces of their UTF-8, so decoding gives back every text exactly. If no piece of the
vocabulary goes on past a marker, and none holds a line break, the best path breaks at the starts of words; words
are then encoded on their own, all new words of a batch at once, and remembered.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netvigil.llm.common import Sent

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MARK = "▁"
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: An uncovered character scores this much less than the lowest piece.
UNKNOWN_PENALTY = 10.0
#: Longer words are walked alone; remembered words at most; texts taken together, in characters.
LONG, REMEMBERED, TOGETHER = 48, 400_000, 2_000_000


@dataclass
class Pieces:
    """The trie: a state's child by character code c is base[s] + c if check there is s. value: piece id or -1."""

    code: dict[str, int]
    base: np.ndarray
    check: np.ndarray
    value: np.ndarray
    score: np.ndarray
    unknown: float
    bytes_first: list[int]
    surface: list[bytes]
    by_word: bool
    depth: int


def build_trie(words: dict[str, int], code: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base, check, value) of the double array over ``words``, whose values are piece ids."""
    children: list[dict[int, int]] = [{}]
    ids = [-1]
    for word, piece in words.items():
        node = 0
        for ch in word:
            nxt = children[node].get(code[ch])
            if nxt is None:
                nxt = children[node][code[ch]] = len(children)
                children.append({})
                ids.append(-1)
            node = nxt
        ids[node] = piece
    # Slots start behind the largest code, so that every base is positive.
    size = 2 * (len(children) + len(code)) + 64
    base, check, value = np.zeros(size, np.int64), np.full(size, -1, np.int64), np.full(size, -1, np.int64)
    free = np.ones(size, bool)
    free[: len(code) + 1] = False
    place, start = {0: 0}, len(code) + 1
    queue = [0]
    for node in queue:
        own = children[node]
        if not own:
            continue
        codes = np.array(sorted(own))
        while not free[start]:
            start += 1
        look, at = start, -1
        while at < 0:
            while look + 1024 + len(code) >= size:
                base, value = np.append(base, np.zeros(size, np.int64)), np.append(value, np.full(size, -1, np.int64))
                check, free = np.append(check, np.full(size, -1, np.int64)), np.append(free, np.ones(size, bool))
                size *= 2
            step = 1 if len(codes) == 1 else 1024
            first = look + np.flatnonzero(free[look : look + step])
            fits = np.ones(len(first), bool)
            for c in (codes - codes[0])[1:].tolist():
                fits &= free[first + c]
            if fits.any():
                at = int(first[fits.argmax()]) - int(codes[0])
            look += step
        base[place[node]] = at
        for c in codes.tolist():
            slot = at + c
            free[slot] = False
            check[slot] = place[node]
            value[slot] = ids[own[c]]
            place[own[c]] = slot
            queue.append(own[c])
    # Room behind the last slot, so that no base plus code leaves the arrays.
    last, room = int(np.flatnonzero(~free)[-1]) + 1, len(code) + 1
    return tuple(np.append(a[:last], np.full(room, -1)).astype(np.int32) for a in (base, check, value))


def pieces_of(vocabulary: list[tuple[str, float, str]]) -> Pieces:
    """From (piece, log score, kind) in id order; kind is ``normal``, ``byte`` or anything else, which is left out."""
    normal = {p: i for i, (p, _, kind) in enumerate(vocabulary) if kind == "normal" and p}
    letters = sorted({ch for p in normal for ch in p})
    code = {ch: k + 1 for k, ch in enumerate(letters)}
    base, check, value = build_trie(normal, code)
    score = np.array([s for _, s, _ in vocabulary], float)
    first = [0] * 256
    surface = [p.replace(MARK, " ").encode() for p, _, _ in vocabulary]
    for i, (p, _, kind) in enumerate(vocabulary):
        if kind == "byte":
            first[int(p[3:5], 16)] = i
            surface[i] = bytes([int(p[3:5], 16)])
        elif kind != "normal":
            surface[i] = b""
    by_word = "\n" not in code and not any(re.search(f"[^{MARK}]{MARK}", p) for p in normal)
    # A text's space is the marker; its own U+2581 has no code.
    code[" "] = code.pop(MARK, 0)
    return Pieces(
        code, base, check, value, score, float(min((score[i] for i in normal.values()), default=0.0)) - UNKNOWN_PENALTY,
        first, surface, by_word, max(map(len, normal), default=0),
    )


def load_pieces(path: str = VOCABULARY) -> Pieces:
    """The vocabulary of a SentencePiece model file; its pieces and scores are used as they are."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kind = lambda i: "byte" if model.is_byte(i) else "other" if (
        model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
    ) else "normal"
    return pieces_of([(model.id_to_piece(i), model.get_score(i), kind(i)) for i in range(model.get_piece_size())])


def _byte_ids(pieces: Pieces, ch: str) -> list[int]:
    return [pieces.bytes_first[b] for b in ch.encode()]


def encode_word(pieces: Pieces, word: str) -> list[int]:
    """The best path through one word (or any text whose spaces are markers already counted): plain Viterbi.

    Of paths with equal scores the one whose last differing piece is longer wins.
    """
    base, check, value, score, code = pieces.base, pieces.check, pieces.value, pieces.score, pieces.code
    n = len(word)
    codes = [code.get(ch, 0) for ch in word]
    best, back, via = [0.0] + [-np.inf] * n, [0] * (n + 1), [-1] * (n + 1)
    for i in range(n):
        state, single = 0, False
        for j in range(i, n):
            nxt = int(base[state]) + codes[j]
            if not codes[j] or nxt >= len(check) or check[nxt] != state:
                break
            state = nxt
            piece = int(value[state])
            if piece >= 0:
                single = single or j == i
                total = best[i] + score[piece]
                if total > best[j + 1]:
                    best[j + 1], back[j + 1], via[j + 1] = total, i, piece
        if not single and best[i] + pieces.unknown > best[i + 1]:
            best[i + 1], back[i + 1], via[i + 1] = best[i] + pieces.unknown, i, -1
    out: list[list[int]] = []
    at = n
    while at:
        out.append([via[at]] if via[at] >= 0 else _byte_ids(pieces, word[back[at]]))
        at = back[at]
    return list(chain.from_iterable(reversed(out)))


def _encode_equal(pieces: Pieces, words: list[str]) -> list[bytes]:
    """``encode_word`` for words of one length, all at once; ids as little-endian 32-bit integers."""
    n = len(words[0])
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), n)
    alphabet, inverse = np.unique(points, return_inverse=True)
    codes = np.array([pieces.code.get(chr(c), 0) for c in alphabet.tolist()], np.int32)[inverse.reshape(points.shape)]
    base, check, value, score = pieces.base, pieces.check, pieces.value, pieces.score
    best = np.full((n + 1, len(words)), -np.inf)
    best[0] = 0
    back, via = np.zeros((n + 1, len(words)), np.int32), np.full((n + 1, len(words)), -1, np.int32)
    for i in range(n):
        rows, state = np.arange(len(words)), np.zeros(len(words), np.int32)
        single = np.zeros(len(words), bool)
        for j in range(i, n):
            step = codes[rows, j]
            nxt = np.minimum(base[state] + step, len(check) - 1)
            ok = (step > 0) & (check[nxt] == state)
            rows, state = rows[ok], nxt[ok]
            if not len(rows):
                break
            piece = value[state]
            ends = piece >= 0
            at, piece = rows[ends], piece[ends]
            if j == i:
                single[at] = True
            total = best[i, at] + score[piece]
            win = total > best[j + 1, at]
            at, piece = at[win], piece[win]
            best[j + 1, at], back[j + 1, at], via[j + 1, at] = total[win], i, piece
        at = np.flatnonzero(~single & (best[i] + pieces.unknown > best[i + 1]))
        best[i + 1, at], back[i + 1, at], via[i + 1, at] = best[i, at] + pieces.unknown, i, -1
    # Walk back all words together; ids fill each row from its end.
    path = np.full((len(words), n), -2, np.int32)
    at, rows, place = np.full(len(words), n), np.arange(len(words)), np.full(len(words), n - 1)
    start = np.zeros((len(words), n), np.int32)
    while len(rows):
        path[rows, place[rows]] = via[at[rows], rows]
        start[rows, place[rows]] = at[rows] = back[at[rows], rows]
        place[rows] -= 1
        rows = rows[at[rows] > 0]
    data = path[path >= 0].astype("<i4").tobytes()
    ends = np.cumsum((path >= 0).sum(1)) * 4
    out = [data[lo:hi] for lo, hi in zip([0, *ends[:-1].tolist()], ends.tolist())]
    for k in np.flatnonzero((path == -1).any(1)).tolist():
        first = int(place[k]) + 1
        ids = [[p] if p >= 0 else _byte_ids(pieces, words[k][s]) for p, s in zip(path[k, first:].tolist(), start[k, first:])]
        out[k] = np.array(list(chain.from_iterable(ids)), "<i4").tobytes()
    return out


_known: dict[str, bytes] = {}
_known_for: list[Pieces] = []


def _encode_new(pieces: Pieces, words: list[str]) -> None:
    by_length: dict[int, list[str]] = {}
    for word in words:
        by_length.setdefault(len(word), []).append(word)
    for length, own in by_length.items():
        if length > LONG:
            _known.update((w, np.array(encode_word(pieces, w), "<i4").tobytes()) for w in own)
        else:
            for at in range(0, len(own), 50_000):
                some = own[at : at + 50_000]
                _known.update(zip(some, _encode_equal(pieces, some)))


def encode(pieces: Pieces, texts: list[str | None]) -> list[np.ndarray]:
    """The ids of each text, as 32-bit integers; null and empty texts have none."""
    if not _known_for or _known_for[0] is not pieces:
        _known.clear()
        _known_for[:] = [pieces]
    split = re.compile(r"\n| *[^ \n]+| +").findall if pieces.by_word else lambda text: [text]
    out: list[np.ndarray] = []
    at = 0
    while at < len(texts):
        words, held = [], 0
        while at + len(words) < len(texts) and (not words or held < TOGETHER):
            text = texts[at + len(words)]
            held += len(text or "")
            words.append(split(" " + text) if text else [])
        if len(_known) > REMEMBERED:
            _known.clear()
        new = set(chain.from_iterable(words)).difference(_known)
        if new:
            _encode_new(pieces, list(new))
        out += [np.frombuffer(b"".join([_known[w] for w in own]), "<i4") for own in words]
        at += len(words)
    return out


def decode(pieces: Pieces, ids: np.ndarray) -> str:
    """The text of ids: pieces with spaces for markers, byte pieces as bytes, without the first marker's space.

    Bytes that aren't UTF-8 become U+FFFD; control and unknown pieces stand for nothing.
    """
    surface = pieces.surface
    data = b"".join([surface[i] for i in ids.tolist()])
    return (data[1:] if data[:1] == b" " else data).decode("utf-8", "replace")


TOKENS = "doc_id long, ids array<int>, n_tokens long, n_byte_tokens long, decoded string"


def encode_documents(docs: DataFrame, path: str = VOCABULARY, keep_text: bool = True) -> DataFrame:
    """(doc_id, ids, n_tokens, n_byte_tokens, decoded, exact) for every row: the text's ids, and the text from the ids.

    ``exact``: whether decoding gave back the text (null counts as empty). ``decoded`` is null without ``keep_text``.
    Null and empty texts have an empty list of ids and decode to the empty text; texts may be of any length;
    repeated rows, null doc_ids and further columns need no care (only doc_id and text are read); an empty table gives no
    rows. The vocabulary,
    whose size is fixed, is read on the driver and broadcast.
    """
    spark: SparkSession = docs.sparkSession
    shared = Sent(spark, load_pieces(path))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.value
        is_byte = np.zeros(len(pieces.surface), bool)
        is_byte[pieces.bytes_first] = True
        for batch in batches:
            for at, count in _runs(batch.column(1)):
                texts = batch.column(1).slice(at, count).to_pylist()
                ids = encode(pieces, texts)
                sizes = [len(x) for x in ids]
                flat = np.concatenate(ids)
                marks = np.concatenate(([0], np.cumsum(is_byte[flat])))
                ends = np.cumsum([0, *sizes])
                decoded = [decode(pieces, x) for x in ids]
                exact = [d == (t or "") for d, t in zip(decoded, texts)]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, count).cast(pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32())),
                    pa.array(sizes, pa.int64()), pa.array(marks[ends[1:]] - marks[ends[:-1]], pa.int64()),
                    pa.array(decoded if keep_text else [None] * count, pa.string()), pa.array(exact),
                ], names=["doc_id", "ids", "n_tokens", "n_byte_tokens", "decoded", "exact"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(rows, TOKENS + ", exact boolean")


def _runs(column: pa.Array) -> Iterator[tuple[int, int]]:
    """(start, count) of runs of texts of about ``TOGETHER`` characters."""
    sizes = column.cast(pa.large_string()).fill_null("").cast(pa.large_binary())
    ends = np.frombuffer(sizes.buffers()[1], np.int64)[sizes.offset : sizes.offset + len(sizes) + 1]
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + TOGETHER, "right")) - 1)
        to = min(to, len(column))
        yield at, to - at
        at = to
