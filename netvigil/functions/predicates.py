"""Filter conditions as columns."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, functions as F

from netvigil.functions.times import moment, to_ms

WORD = r"[\p{L}\p{N}]+"


def from_time(as_of: datetime | int, back_ms: int) -> Column:
    """At or after ``as_of - back_ms``, open above."""
    return F.col("timestamp") >= moment(to_ms(as_of) - back_ms)


def closed_range(as_of: datetime | int, back_ms: int) -> Column:
    """Within ``[as_of - back_ms, as_of]`` at millisecond resolution, both ends included.

    The bound on the stored column lets scans skip data; the second one cuts at the millisecond.
    """
    end = to_ms(as_of)
    return from_time(end, back_ms) & (F.col("timestamp") < moment(end + 1))


def within(since: datetime | int | None = None, until: datetime | int | None = None) -> Column:
    """Closed time range of a dashboard's picker; a missing end is open."""
    bounds = []
    if since is not None:
        bounds.append(F.col("timestamp") >= moment(to_ms(since)))
    if until is not None:
        bounds.append(F.col("timestamp") < moment(to_ms(until) + 1))
    return all_of(bounds)


def exists(field: str) -> Column:
    return F.col(field).isNotNull()


def term(field: str, value: str) -> Column:
    return F.col(field) == F.lit(value)


def not_from(fragment: str) -> Column:
    """Rows whose partition name does not contain the fragment; prunes partitions."""
    return ~F.col("source_index").contains(fragment)


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda left, right: left & right, conditions, F.lit(True))


def bool_query(
    must: Iterable[Column] = (), filters: Iterable[Column] = (), must_not: Iterable[Column] = ()
) -> Column:
    """All of ``must`` and ``filters`` and none of ``must_not``; empty matches everything.

    A row that a ``must_not`` condition leaves undecided (null) is kept, as it does not match.
    """
    barred = [~F.coalesce(condition, F.lit(False)) for condition in must_not]
    return all_of([*must, *filters, *barred])


def geo_box(south: float, west: float, north: float, east: float) -> Column:
    return F.col("location.lat").between(south, north) & F.col("location.lon").between(west, east)


def word_list(text: Column) -> Column:
    """Lower-cased words of a text, repeats included."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def message_matches(terms: Iterable[str], match_all: bool = False) -> Column:
    """Message holds any (or all) of the words."""
    wanted = F.array(*[F.lit(term.lower()) for term in terms])
    words = word_list(F.col("message"))
    return F.size(F.array_except(wanted, words)) == 0 if match_all else F.arrays_overlap(words, wanted)


def fires(condition: str) -> Column:
    """A trigger's condition over an aggregate row; undecided means no."""
    return F.coalesce(F.expr(condition), F.lit(False))

