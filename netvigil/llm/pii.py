"""Personal data: fixed patterns with checks, and bootstrapped contextual extraction of what they miss.

The fixed patterns find e-mail addresses, IP addresses, payment cards and phone numbers. These are the seeds. An
occurrence has several patterns: the word before it with its shape (lengths of digit runs, punctuation), the words on
both sides with its class (with letters or without), and a label before it (``tel:``, ``ip=``) with its class. Patterns
and values form a bipartite graph over the whole corpus. Spark scores it in turns: a pattern by the mean score of the
values it holds, a value by the patterns it stands in. Tokens in confident patterns that no fixed pattern accepted
are identifiers too, whatever their form, and are added as spans of the kind ``context``. Every token with a digit, an @,
an underscore or a sign between letters is a candidate; words of letters alone are none, as no seed is of that class.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netvigil.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KINDS = ("email", "ip", "card", "phone", "context")

# The patterns of the base kinds.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# The lookbehind changes no match: a match never starts inside a run of digits unless the one before ended there.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile("[0-9]")
_SHAPE = re.compile("[0-9]+|[A-Za-z]+")
# A phone number with its area in brackets and without +.
_AREA = re.compile(r"(?:[0-9]{1,4}[\x20-]?)?\([0-9]{1,6}\)[\x20-]?[0-9](?:[\x20.-]?[0-9])*")
_SIGN = re.compile(r"[0-9@_]|(?<=[A-Za-z])[.+/#~(\[{<-](?=[A-Za-z])")
_LABEL = re.compile(r"[^\W\d_]+[:=](?!//)(?=\S)")
_LETTER = re.compile(r"[^\W\d_]")


@dataclass(frozen=True)
class Bootstrap:
    """rounds of scoring; a pattern is confident from ``confidence`` and ``support`` seed values on."""

    rounds: int = 3
    confidence: float = 0.7
    support: int = 3


def luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = int(d) * (1 + place % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, each found from its @ in linear time."""
    free = 0
    at = text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at)
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if domain and start < at:
            free = domain.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """(start, kind, end) of the base kinds in order, and (start, end) of matches that failed their check."""
    found = [(s, 0, e) for s, e in _emails(text)]
    failed = []
    if _DIGIT.search(text):
        for kind, pattern in ((1, _IP), (2, _CARD), (3, _PHONE)):
            for m in pattern.finditer(text):
                digits = "".join(c for c in m[0] if c.isdigit())
                if kind == 1:
                    good = all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))
                elif kind == 2:
                    good = 12 <= len(digits) <= 19 and luhn(digits)
                else:
                    good = 9 <= len(digits) <= 15
                if good:
                    found.append((m.start(), kind, m.end()))
                elif len(digits) <= 64:
                    failed.append((m.start(), m.end()))
    return sorted(found), failed


def _shape(value: str) -> str:
    return _SHAPE.sub(lambda m: f"9{len(m[0])}" if m[0][0].isdigit() else "a", value)[:64]


def _context(text: str, start: int) -> str:
    """The word before ``start``, lower-cased, without closing punctuation other than ``:`` and ``=``."""
    end = start
    while end > 0 and text[end - 1].isspace():
        end -= 1
    begin = end
    while begin > 0 and end - begin < 32 and not text[begin - 1].isspace():
        begin -= 1
    return text[begin:end].lower().rstrip(".,;!?)\"'")


def _after(text: str, end: int) -> str:
    """The closing punctuation at ``end``, or the word after it, lower-cased; ``$`` at the end of the text."""
    if end < len(text) and text[end] in ".,;:!?":
        return text[end]
    begin = end
    while begin < len(text) and (text[begin].isspace() or text[begin] in ")\"'"):
        begin += 1
    stop = begin
    while stop < len(text) and stop - begin < 32 and not text[stop].isspace():
        stop += 1
    return text[begin:stop].lower().rstrip(".,;:!?)\"'") or text[begin:stop] or "$"


def _patterns(text: str, start: int, end: int) -> list[str]:
    value, before = text[start:end], _context(text, start)
    out = [f"{before}\t{_shape(value)}"]
    if _LETTER.search(before):
        kind = "a" if _LETTER.search(value) else "9"
        out.append(f"{before}\t{_after(text, end)}\t{kind}")
        if before[-1] in ":=":
            out.append(f"{before}\t\t{kind}")
    return out


def occurrences(text: str) -> tuple[list, list]:
    """The base spans, and (patterns, value, seed, start, end) of them and of candidates that overlap none."""
    found, failed = base_spans(text)
    out = [(s, e, True) for s, _, e in found]
    spans = [(s, e) for s, _, e in found]
    taken = 0
    at = 0
    candidates = failed + [m.span() for m in _AREA.finditer(text)]
    # Runs of anything but white space that hold a digit or a sign.
    while m := _SIGN.search(text, at):
        begin, end = m.start(), m.end()
        while begin > at and not text[begin - 1].isspace():
            begin -= 1
        while end < len(text) and not text[end].isspace():
            end += 1
        at = end
        if label := _LABEL.match(text, begin, end):
            begin = label.end()
        while end > begin and text[end - 1] in ".,;:!?)\"'":
            end -= 1
        if end > m.start():
            candidates.append((begin, end))
    for begin, end in sorted(candidates, key=lambda c: (c[0], -c[1])):
        if begin < taken or end - begin > 256:
            continue
        while spans and spans[0][1] <= begin:
            spans.pop(0)
        if any(s < end and begin < e for s, e in spans[:4]):
            continue
        taken = end
        out.append((begin, end, False))
    return found, [
        (_patterns(text, s, e), hashlib.blake2b(text[s:e].encode(), digest_size=12).hexdigest(), seed, s, e)
        for s, e, seed in sorted(out)
    ]


_FOUND = "array<struct<patterns:array<string>,value:string,seed:boolean,first:int,last:int>>"
_ROWS = f"row long, doc_id long, counts array<long>, base_sha256 string, base array<struct<first:int,kind:int,last:int>>, found {_FOUND}"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 33
    found_type = pa.list_(pa.struct([
        ("patterns", pa.list_(pa.string())), ("value", pa.string()), ("seed", pa.bool_()), ("first", pa.int32()), ("last", pa.int32()),
    ]))
    base_type = pa.list_(pa.struct([("first", pa.int32()), ("kind", pa.int32()), ("last", pa.int32())]))
    for batch in batches:
        counts, digests, base, found = [], [], [], []
        for text in batch.column(1).to_pylist():
            spans, seen = occurrences(text or "")
            counts.append([sum(k == kind for _, k, _ in spans) for kind in range(4)])
            joined = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)
            digests.append(hashlib.sha256(joined.encode()).hexdigest())
            base.append([{"first": s, "kind": k, "last": e} for s, k, e in spans])
            found.append([dict(zip(("patterns", "value", "seed", "first", "last"), o)) for o in seen])
        ids = pa.array(range(number, number + batch.num_rows), pa.int64())
        number += batch.num_rows
        yield pa.RecordBatch.from_arrays([
            ids, batch.column(0), pa.array(counts, pa.list_(pa.int64())), pa.array(digests, pa.string()),
            pa.array(base, base_type), pa.array(found, found_type),
        ], names=["row", "doc_id", "counts", "base_sha256", "base", "found"])


def _confident(edges: DataFrame, settings: Bootstrap) -> DataFrame:
    """The patterns that the graph of (pattern, value, seed) makes confident."""
    values = stored(edges.groupBy("value").agg(F.max("seed").cast("double").alias("score")), "values")
    for turn in range(settings.rounds):
        scored = edges.join(values, "value")
        patterns = stored(scored.groupBy("pattern").agg(
            (F.sum("score") / (F.count(F.lit(1)) + 1)).alias("confidence"), F.sum(F.col("seed").cast("int")).alias("seeds")
        ), "patterns")
        if turn + 1 < settings.rounds:
            doubt = F.sum(F.log1p(-F.least(F.col("confidence"), F.lit(0.99))))
            values = stored(edges.join(patterns, "pattern").groupBy("value").agg(
                F.when(F.max("seed"), 1.0).otherwise(1 - F.exp(doubt)).alias("score")
            ), "values")
    return patterns.where((F.col("confidence") >= settings.confidence) & (F.col("seeds") >= settings.support)).select("pattern")


def personal_data(docs: DataFrame, settings: Bootstrap = Bootstrap()) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, n_context, n_spans, base_sha256, spans) for every row of ``docs``.

    ``spans`` joins kind:start:end (code points, end exclusive) of all spans with commas, by start, then kind;
    base_sha256 is the SHA-256 of the same over the base kinds alone. Base spans never depend on other rows;
    context spans never overlap them. ``docs`` needs doc_id and text; other columns are ignored. Null and empty
    texts have no spans; texts may be of any length; repeated rows and rows without doc_id are rows like others;
    an empty table gives an empty result. Candidates of over 256 characters, failed matches of over 64 digits and
    words beyond 32 characters next to a value have no part in the graph; base spans know no such bounds. Of the corpus only counts per pattern and value move between executors.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    read = stored(texts.mapInArrow(_read, _ROWS), "spans")
    seen = read.select("row", F.explode("found").alias("o")).select("row", "o.*")
    edges = seen.select(F.explode("patterns").alias("pattern"), "value", "seed")
    edges = stored(edges.groupBy("pattern", "value").agg(F.max("seed").alias("seed")), "pattern-graph")
    patterns = stored(_confident(edges, settings), "confident")
    more = seen.where("NOT seed").select("row", "first", "last", F.explode("patterns").alias("pattern"))
    more = more.join(patterns, "pattern").groupBy("row").agg(F.collect_set(
        F.struct("first", F.lit(4).alias("kind"), "last")
    ).alias("extra"))
    joined = read.drop("found").join(more, "row", "left")
    none = F.array().cast("array<struct<first:int,kind:int,last:int>>")
    every = F.array_sort(F.concat("base", F.coalesce("extra", none)))
    name = F.array(*[F.lit(k) for k in KINDS])
    text = lambda s: F.concat_ws(":", F.element_at(name, s["kind"] + 1), s["first"], s["last"])
    return joined.select(
        "doc_id", *[F.col("counts")[i].alias(f"n_{k}") for i, k in enumerate(KINDS[:4])],
        F.coalesce(F.size("extra"), F.lit(0)).cast("long").alias("n_context"),
        F.size(every).cast("long").alias("n_spans"), "base_sha256",
        F.array_join(F.transform(every, text), ",").alias("spans"),
    )
