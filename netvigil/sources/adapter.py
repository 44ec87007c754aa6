"""Device telemetry derived from the ``events`` table.

Time is compressed 60 times from 2024-01-01, so that 30 days of events become
12 hours and minute-scale windows are well filled. Minutes 50 to 54 of every
hour are a burst of link failures on one host.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from netvigil.functions.times import daily_name, iso_millis, to_ms, utc_text
from netvigil.schema import EVENT_PREFIX, LOCATION_TYPE

EPOCH = datetime(2024, 1, 1)
EPOCH_US = 1_704_067_200_000_000
SPEEDUP = 60

# Device names, places and texts of the telemetry.
INTERFACES = ["GigabitEthernet0/0", "GigabitEthernet0/1", "TenGigE1/0", "TenGigE1/1", "Loopback0"]
REGIONS = ["SP-Capital", "SP-Interior", "RJ-Capital", "MG-Capital", "PR-Capital", "RS-Capital"]
COORDINATES = {
    "SP-Capital": (-23.5505, -46.6333),
    "SP-Interior": (-22.9099, -47.0626),
    "RJ-Capital": (-22.9068, -43.1729),
    "MG-Capital": (-19.9208, -43.9378),
    "PR-Capital": (-25.4284, -49.2733),
    "RS-Capital": (-30.0346, -51.2177),
}
MESSAGES_NORMAL = [
    "Normal traffic",
    "Routine health check passed",
    "Interface status UP",
    "BGP session established",
    "SNMP poll completed",
]
MESSAGES_CRITICAL = [
    "ANOMALY: Traffic Spike Detected",
    "ANOMALY: High packet loss on trunk",
    "ANOMALY: CPU threshold exceeded",
    "ANOMALY: Memory exhaustion warning",
    "ANOMALY: Link flapping detected",
]
BURST_HOST = "BR-SP-CORE-101"
BURST_INTERFACE = "eth0"
BURST_REGION = "BR-SP"
BURST_MESSAGE = "ANOMALIA INJETADA: BGP Peer Down / Link Failure"
BURST_FIRST_MINUTE, BURST_LAST_MINUTE = 50, 54


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _hundredths(units: Column, scale: int) -> Column:
    """An integer count of 10^-scale units as a short decimal, whose sums stay exact."""
    return (units.cast("decimal(8,0)") * F.lit(f"{10 ** -scale:.{scale}f}").cast(f"decimal({scale},{scale})")).cast(
        f"decimal(8,{scale})"
    )


def _ts_type(raw: DataFrame) -> str:
    return raw.schema["ts"].dataType.simpleString()


def _elapsed_us(raw: DataFrame) -> Column:
    """Microseconds of ``ts`` since the epoch of the telemetry; times without a zone are UTC."""
    if _ts_type(raw) == "timestamp_ntz":
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'{EPOCH}', ts)")
    return F.unix_micros("ts") - F.lit(EPOCH_US)


def _raw_bound(raw: DataFrame, ms: int, up: bool) -> Column:
    """Uncompressed time of a compressed moment, as a literal the scan can use."""
    offset_us = (ms * 1000 - EPOCH_US) * SPEEDUP + (SPEEDUP * 1000 - 1 if up else 0)
    text = (EPOCH + timedelta(microseconds=offset_us)).isoformat(" ")
    kind = _ts_type(raw)
    return F.lit(text if kind == "timestamp_ntz" else f"{text}Z").cast(kind)


def from_events(
    raw: DataFrame, since: datetime | int | None = None, until: datetime | int | None = None
) -> DataFrame:
    """Telemetry rows of the ``events`` table: the event fields and ``event_id``.

    ``since`` and ``until`` (both included, in compressed time) reach the scan as bounds on ``ts``.
    """
    if since is not None:
        raw = raw.where(F.col("ts") >= _raw_bound(raw, to_ms(since), False))
    if until is not None:
        raw = raw.where(F.col("ts") <= _raw_bound(raw, to_ms(until), True))

    base = raw.select(
        "event_id",
        "user_id",
        "event_type",
        F.regexp_extract("props", "-?[0-9]+", 0).try_cast("int").alias("k"),
        (F.lit(EPOCH_US) + F.call_function("div", _elapsed_us(raw), F.lit(SPEEDUP))).alias("ts_us"),
    )
    minute_of_hour = F.pmod(F.expr("ts_us div 60000000"), F.lit(60))
    burst = minute_of_hour.between(BURST_FIRST_MINUTE, BURST_LAST_MINUTE)
    critical = F.col("event_type") == "error"
    k = F.col("k")

    def by_kind(in_burst: Column, on_error: Column, otherwise: Column) -> Column:
        return F.when(burst, in_burst).when(critical, on_error).otherwise(otherwise)

    region_index = F.pmod(F.expr("user_id div 6"), F.lit(6))
    places = [F.struct(F.lit(lat).alias("lat"), F.lit(lon).alias("lon")) for lat, lon in COORDINATES.values()]
    host = F.concat(F.lit("BR-SP-CORE-"), (F.lit(100) + F.pmod("user_id", F.lit(6))).cast("string"))
    ordinary_severity = F.when(F.col("event_type") == "purchase", "WARNING").otherwise("INFO")
    return base.select(
        "event_id",
        F.timestamp_micros("ts_us").alias("timestamp"),
        F.when(burst, BURST_HOST).otherwise(host).alias("hostname"),
        F.when(burst, BURST_INTERFACE).otherwise(_pick(INTERFACES, F.pmod("event_id", F.lit(5)))).alias("interface"),
        F.when(burst, BURST_REGION).otherwise(_pick(REGIONS, region_index)).alias("region"),
        F.when(~burst, F.element_at(F.array(*places), (region_index + 1).cast("int"))).cast(LOCATION_TYPE).alias("location"),
        F.when(burst | critical, "CRITICAL").otherwise(ordinary_severity).alias("severity"),
        by_kind(F.lit(BURST_MESSAGE), _pick(MESSAGES_CRITICAL, k % 5), _pick(MESSAGES_NORMAL, k % 5)).alias("message"),
        _hundredths(by_kind(9500 + 4 * k, 8800 + 12 * k, 1000 + 35 * k), 2).alias("utilization_pct"),
        _hundredths(by_kind(50000 + 1000 * k, 20000 + 600 * k, 100 + 49 * k), 2).alias("latency_ms"),
        _hundredths(by_kind(50000 + 500 * k, 5000 + 200 * k, 5 * k), 3).alias("packet_loss_pct"),
    )


def telemetry(
    spark: SparkSession, sf_dir: str, since: datetime | int | None = None, until: datetime | int | None = None
) -> DataFrame:
    return from_events(spark.read.parquet(f"{sf_dir}/events.parquet"), since, until)


def raw_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry rows filed under the uncompressed day of each event, for lifecycle jobs."""
    raw = spark.read.parquet(f"{sf_dir}/events.parquet")
    time = F.timestamp_micros(_elapsed_us(raw) + F.lit(EPOCH_US))
    return raw.select("event_id", time.alias("timestamp"), daily_name(EVENT_PREFIX, F.unix_millis(time)).alias("source_index"))


# A few documents of every kind that a strict table must refuse.
FAULTS = {
    "extra_field": 97, "bad_number": 89, "bad_timestamp": 83, "bad_location": 79, "truncated": 73, "trailing": 71,
    "nested": 67, "infinite": 61,
}
BATCH_SIZE = 10


def documents(events: DataFrame) -> DataFrame:
    """Telemetry as the JSON bodies a device sends: ``batch_id``, ``event_id``, ``body``.

    Timestamps alternate between ISO with ``Z``, ISO with an offset, and epoch milliseconds.
    """
    event_id = F.col("event_id")

    def faulty(kind: str) -> Column:
        return event_id % FAULTS[kind] == FAULTS[kind] - 1

    ms = F.unix_millis("timestamp")
    stamp = (
        F.when(faulty("bad_timestamp"), F.lit('"x"'))
        .when(event_id % 3 == 0, F.concat(F.lit('"'), iso_millis(ms), F.lit('"')))
        .when(event_id % 3 == 1, F.concat(F.lit('"'), utc_text(ms, "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit('+00:00"')))
        .otherwise(ms.cast("string"))
    )
    utilization = F.when(faulty("bad_number"), F.lit('"n/a"')).when(faulty("infinite"), F.lit("1e60")).otherwise(F.col("utilization_pct").cast("string"))
    coordinates = F.create_map(
        *[F.lit(part) for name, (lat, lon) in COORDINATES.items() for part in (name, f"{lat},{lon}")]
    )
    place = F.when(faulty("bad_location"), F.lit("nowhere")).otherwise(coordinates[F.col("region")])
    location = F.when(F.col("location").isNotNull(), F.concat(F.lit(',"location":"'), place, F.lit('"')))

    def text(name: str) -> Column:
        return F.concat(F.lit(f',"{name}":"'), F.col(name), F.lit('"'))

    body = F.concat(
        F.lit('{"timestamp":'), stamp,
        F.when(faulty("nested"), F.lit(',"hostname":{"name":"h"}')).otherwise(text("hostname")), text("interface"), text("region"),
        F.coalesce(location, F.lit("")),
        text("severity"), text("message"),
        F.lit(',"utilization_pct":'), utilization,
        F.lit(',"latency_ms":'), F.col("latency_ms").cast("string"),
        F.lit(',"packet_loss_pct":'), F.col("packet_loss_pct").cast("string"),
        F.when(faulty("extra_field"), F.lit(',"zz":1')).otherwise(F.lit("")),
        F.when(faulty("truncated"), F.lit("")).otherwise(F.lit("}")),
        F.when(faulty("trailing"), F.lit('{"hostname":"h"}')).otherwise(F.lit("")),
    )
    return events.select(
        F.expr(f"event_id div {BATCH_SIZE}").alias("batch_id"), "event_id", ms.alias("sent_ms"), body.alias("body")
    )


def payload_bodies(events: DataFrame) -> DataFrame:
    """Notification bodies of every form a receiver meets: flat, nested, partial, plain text, empty, blank, with more behind."""
    form = F.col("event_id") % 5
    stamp = iso_millis(F.unix_millis("timestamp"))
    note = F.col("message").alias("message")
    flat = F.to_json(F.struct(
        F.col("hostname").alias("monitor_name"), F.col("interface").alias("trigger_name"), "severity",
        stamp.alias("period_start"), stamp.alias("period_end"), note,
    ))
    nested = F.to_json(F.struct(
        F.struct(F.col("hostname").alias("name")).alias("monitor"),
        F.struct(F.col("interface").alias("name")).alias("trigger"), note,
    ))
    body = (
        F.when(form == 0, flat)
        .when(form == 1, nested)
        .when(form == 2, F.to_json(F.struct(note)))
        .when(form == 3, F.col("message"))
        .when(F.col("event_id") % 25 == 4, F.lit(""))
        .when(F.col("event_id") % 25 == 9, F.lit("   "))
        .when(F.col("event_id") % 25 == 14, F.lit('{"message":"a"} trailing'))
        .otherwise(F.lit("{}"))
    )
    return events.select("event_id", body.alias("body"))


def raw_clock() -> Column:
    """The uncompressed time of a telemetry row, as its intake time."""
    return F.timestamp_micros((F.unix_micros("timestamp") - F.lit(EPOCH_US)) * SPEEDUP + F.lit(EPOCH_US))
