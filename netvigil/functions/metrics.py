"""Metric aggregates, and their partial and merged forms for two-step rollups."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, functions as F

from netvigil.schema import Metric


def mean(field: str | Column) -> Column:
    """Mean over non-null values as double; exact sums for decimal columns, null when there are none."""
    field = F.col(field) if isinstance(field, str) else field
    return F.try_divide(F.sum(field).cast("double"), F.count(field).cast("double"))


def aggregate_of(metric: Metric) -> Column:
    column = {
        "avg": lambda: mean(metric.field),
        "max": lambda: F.max(metric.field).cast("double"),
        "value_count": lambda: F.count(metric.field),
        "filter_count": lambda: F.count_if(F.expr(metric.field)),
    }[metric.kind]()
    return column.alias(metric.name)


def aggregates(metrics: Iterable[Metric]) -> list[Column]:
    return [aggregate_of(m) for m in metrics]


def partials(metrics: Iterable[Metric]) -> list[Column]:
    """First step of a rollup: mergeable pieces of each metric."""
    pieces: list[Column] = []
    for m in metrics:
        if m.kind == "avg":
            pieces += [F.sum(m.field).alias(f"{m.name}__sum"), F.count(m.field).alias(f"{m.name}__n")]
        else:
            pieces.append(aggregate_of(m))
    return pieces


def merged(metrics: Iterable[Metric]) -> list[Column]:
    """Second step of a rollup: the metrics from their pieces."""
    columns = []
    for m in metrics:
        if m.kind == "avg":
            total, count = F.sum(f"{m.name}__sum"), F.sum(f"{m.name}__n")
            column = F.try_divide(total.cast("double"), count.cast("double"))
        else:
            column = F.max(m.name) if m.kind == "max" else F.sum(m.name)
        columns.append(column.alias(m.name))
    return columns


def color_band(value: Column, edges: Sequence[float]) -> Column:
    """Index of the half-open range ``[edges[i], edges[i+1])`` holding the value, null outside."""
    band = F.lit(None).cast("int")
    for index in reversed(range(len(edges) - 1)):
        inside = (value >= F.lit(edges[index])) & (value < F.lit(edges[index + 1]))
        band = F.when(inside, F.lit(index)).otherwise(band)
    return band


def above(value: Column, line: float) -> Column:
    """Threshold flag: strictly above the line; false where there is no value."""
    return F.coalesce(value > F.lit(line), F.lit(False))


def clamp(value: Column, low: float, high: float) -> Column:
    return F.least(F.lit(float(high)), F.greatest(F.lit(float(low)), value))


def ordered_sum(field: str) -> Column:
    """Sum of a handful of doubles in value order, the same whichever order rows arrive in."""
    values = F.array_sort(F.collect_list(field))
    return F.aggregate(values, F.lit(0.0), lambda total, value: total + value)
