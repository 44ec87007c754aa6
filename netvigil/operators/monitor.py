"""Threshold monitors: ticks, triggers, throttling, notification rows and payload parsing."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column, DataFrame, Window, functions as F

from netvigil.functions.metrics import merged, partials
from netvigil.functions.predicates import fires, not_from
from netvigil.functions.times import bucket_start, event_ms, iso_seconds, utc_text
from netvigil.operators import holding
from netvigil.schema import DAY, Monitor

# The payload's fields, the lines of the chat message, and what stands in for absent names.
PAYLOAD_FIELDS = ["monitor_name", "trigger_name", "severity", "period_start", "period_end", "message"]
TITLE_LINE = "🚨 <b>{title}</b> 🚨"
NAME_LINES = [
    "📌 <b>Monitor:</b> {monitor_name}",
    "⚡ <b>Trigger:</b> {trigger_name}",
    "🔴 <b>Severidade:</b> {severity}",
]
TIME_LINE = "🕐 <b>Hora:</b> "
PERIOD_LINE = "📅 <b>Período:</b> {period_start} → {period_end}"
NOTE_LINE = "💬 <i>{message}</i>"
LINK_LINE = "🔗 <a href='{link}'>Dashboard</a>"
NO_MONITOR, NO_TRIGGER, NO_SEVERITY = "Monitor", "Trigger", "N/A"


def tick_range(ms: Column, monitor: Monitor) -> tuple[Column, Column]:
    """First and last tick whose closed range holds the moment."""
    first = ms + F.pmod(-ms, F.lit(monitor.interval_ms).cast("bigint"))
    return first, bucket_start(ms + F.lit(monitor.range_ms), monitor.interval_ms)


def monitored(events: DataFrame, monitor: Monitor, include_forecast: bool = False) -> DataFrame:
    """Events a monitor's query looks at."""
    if not include_forecast and "source_index" in events.columns:
        events = events.where(not_from("forecast"))
    return events if monitor.where is None else events.where(monitor.where)


def monitor_ticks(events: DataFrame, monitor: Monitor, include_forecast: bool = False) -> DataFrame:
    """The monitor's metrics at every scheduled ``tick`` (epoch ms) with events in its range.

    Events are first aggregated by the ticks they count for; only those few rows are
    multiplied out to the single ticks.
    """
    first, last = tick_range(event_ms(), monitor)
    steps = monitored(events, monitor, include_forecast).groupBy(first.alias("_first"), last.alias("_last"))
    rolled = steps.agg(*partials(monitor.metrics)).where(F.col("_first") <= F.col("_last"))
    ticks = F.sequence("_first", "_last", F.lit(monitor.interval_ms).cast("bigint"))
    return rolled.withColumn("tick", F.explode(ticks)).groupBy("tick").agg(*merged(monitor.metrics))


def trigger_eval(ticks: DataFrame, monitor: Monitor) -> DataFrame:
    """Adds ``fired``; a tick without a value does not fire."""
    return ticks.withColumn("fired", fires(monitor.condition))


def firing_ticks(events: DataFrame, monitor: Monitor, include_forecast: bool = False) -> DataFrame:
    ticks = trigger_eval(monitor_ticks(events, monitor, include_forecast), monitor)
    return ticks.where("fired").drop("fired").withColumn("monitor", F.lit(monitor.name))


def throttle(
    fired: DataFrame,
    interval_ms: int,
    throttle_ms: int,
    by: tuple[str, ...] = ("monitor",),
    chunk_ms: int | None = None,
) -> DataFrame:
    """The rows of the ticks that send: the first, then each one at least ``throttle_ms`` after the last sent.

    A tick that comes at least that long after the tick before it always sends, so islands between such gaps are
    folded apart. Within an island, time is cut into chunks; ticks lie on a grid, so what a chunk does depends on one of a
    few entry states: how many grid steps into it the throttle still holds. Every chunk is folded once for all of them into
    one row, and a walk over the few rows of an island finds the state that each chunk really starts from.
    ``chunk_ms``, about a day if not given, must be a multiple of the interval and exceed the throttle.
    """
    steps = max(1, -(-throttle_ms // interval_ms))
    if chunk_ms is None:
        chunk_ms = interval_ms * max(DAY // interval_ms, steps + 1)
    if chunk_ms % interval_ms or chunk_ms <= throttle_ms:
        raise ValueError("chunk_ms must be a multiple of interval_ms and exceed throttle_ms")
    hold, by = steps * interval_ms, list(by)
    fields = {f.name: f.dataType.simpleString() for f in fired.schema.fields}
    keys = ", ".join(f"`{c}` {fields[c]}" for c in by)
    chunked = fired.withColumn("chunk", bucket_start(F.col("tick"), chunk_ms))
    # Both groupings take whole rows, so Spark shuffles the rows once.
    chunks = chunked.groupBy(*by, "chunk").applyInArrow(
        holding.stretch(by, interval_ms, hold),
        f"{keys}, chunk bigint, first_tick bigint, last_tick bigint, exits array<bigint>",
    )
    earlier = Window.partitionBy(*by).orderBy("chunk")
    gap = F.col("first_tick") - F.lag("last_tick").over(earlier) >= hold
    islands = chunks.withColumn("free", F.coalesce(gap, F.lit(True)))
    islands = islands.withColumn("island", F.count_if("free").over(earlier))
    entries = islands.groupBy(*by, "island").applyInArrow(holding.walk(by, interval_ms), f"{keys}, chunk bigint, entry bigint")
    entered = chunked.join(entries, [*by, "chunk"]).select(*chunked.columns, "entry")
    return entered.groupBy(*by, "chunk").applyInArrow(holding.send(fired.columns, hold), fired.schema)


def sent_ticks(events: DataFrame, monitor: Monitor, include_forecast: bool = False) -> DataFrame:
    """Firing ticks that survive the throttle, with their metrics."""
    return throttle(firing_ticks(events, monitor, include_forecast), monitor.interval_ms, monitor.throttle_ms)


def fill_template(template: str) -> Column:
    """Text with ``{column}`` placeholders; an absent value leaves nothing."""
    parts = []
    for text, name, _, _ in Formatter().parse(template):
        if text:
            parts.append(F.lit(text))
        if name:
            parts.append(F.coalesce(F.col(name).cast("string"), F.lit("")))
    return F.concat(*parts)


def payload_columns(monitor: Monitor) -> list[Column]:
    """The notification's fields; its period is the schedule's last interval, not the query's range."""
    return [
        F.lit(monitor.name).alias("monitor_name"),
        F.lit(monitor.trigger).alias("trigger_name"),
        F.lit(monitor.severity).alias("severity"),
        iso_seconds(F.col("tick") - F.lit(monitor.interval_ms)).alias("period_start"),
        iso_seconds(F.col("tick")).alias("period_end"),
        fill_template(monitor.message).alias("message"),
    ]


def notifications(events: DataFrame, monitor: Monitor, include_forecast: bool = False) -> DataFrame:
    """One row per notification: the tick, the payload's fields, its JSON and the text for people."""
    return rendered(sent_ticks(events, monitor, include_forecast), monitor)


def rendered(sent: DataFrame, monitor: Monitor) -> DataFrame:
    """Notification rows of ticks that send; ``sent`` has the tick and the monitor's metrics, batch or continuous."""
    rows = sent.select("tick", *[m.name for m in monitor.metrics], *payload_columns(monitor))
    body = F.to_json(F.struct(*PAYLOAD_FIELDS))
    return rows.withColumn("payload", body).withColumn("text", human_message(F.col("tick")))


def human_message(sent_ms: Column, title: str = "ALERTA NOC", link: str | None = None) -> Column:
    """Lines of a chat message over the payload's columns, sent at an epoch-millisecond time.

    The period and the message appear only where present; values are not escaped.
    """
    lines = [
        F.lit(TITLE_LINE.format(title=title)),
        F.lit(""),
        *[fill_template(line) for line in NAME_LINES],
        F.concat(F.lit(TIME_LINE), utc_text(sent_ms, "yyyy-MM-dd HH:mm:ss 'UTC'")),
        F.when(F.col("period_start") != "", fill_template(PERIOD_LINE)),
        F.when(F.col("message") != "", F.concat(F.lit("\n"), fill_template(NOTE_LINE))),
    ]
    if link:
        lines += [F.lit(""), F.lit(LINK_LINE.format(link=link))]
    return F.concat_ws("\n", *lines)


PAYLOAD_SHAPE = (
    "monitor_name string, trigger_name string, severity string, period_start string, period_end string, "
    "message string, monitor struct<name: string>, trigger struct<name: string>, broken string"
)


def parse_payloads(raw: DataFrame, body: str = "body") -> DataFrame:
    """Notification rows from payload bodies, with fallbacks.

    Names come from the flat key, else the nested one, else a default; a body that is not one
    JSON object from end to end becomes the message itself.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"}
    # The parser stops behind the first value. As an item of a list, with a mark that no body holds as the next
    # item, a body with more behind its value breaks the list or makes it longer.
    mark = F.md5(F.col(body))
    items = F.from_json(F.concat(F.lit("["), F.col(body), F.lit(',"'), mark, F.lit('"]')), "array<string>")
    whole = F.coalesce((F.size(items) == 2) & (F.get(items, F.lit(1)) == mark), F.lit(False))
    read = raw.withColumn("_p", F.when(whole, F.from_json(body, PAYLOAD_SHAPE, options)))
    broken = F.col("_p").isNull() | F.col("_p.broken").isNotNull()
    return read.select(
        *raw.columns,
        F.coalesce("_p.monitor_name", "_p.monitor.name", F.lit(NO_MONITOR)).alias("monitor_name"),
        F.coalesce("_p.trigger_name", "_p.trigger.name", F.lit(NO_TRIGGER)).alias("trigger_name"),
        F.coalesce("_p.severity", F.lit(NO_SEVERITY)).alias("severity"),
        F.coalesce("_p.period_start", F.lit("")).alias("period_start"),
        F.coalesce("_p.period_end", F.lit("")).alias("period_end"),
        F.when(broken, F.coalesce(F.col(body), F.lit(""))).otherwise(F.coalesce("_p.message", F.lit(""))).alias("message"),
    )
