"""Strict parsing of JSON documents into typed events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from netvigil.functions.times import bucket_start
from netvigil.schema import DAY, EVENT_FIELDS, KEYWORD_LIMIT, LOCATION_TYPE, NUMERIC_FIELDS, Retention
from netvigil.session import exists

# Shapes of an ISO date, optional time and optional zone; of a number; of a pair of them.
DATE_TIME = (
    r"^([0-9]{4}(?:-[0-9]{2}(?:-[0-9]{2}(?=$|T))?)?(?=$|T))"
    r"(?:T([0-9]{2}(?::[0-9]{2}(?::[0-9]{2}(?:[.,][0-9]{1,9})?)?)?)(Z|[+-][0-9]{2}(?::?[0-9]{2})?)?)?$"
)
FULL_DATE_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,9})?(Z|[+-][0-9]{2}(:?[0-9]{2})?)$"
_NUMBER = r"\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*"
NUMBER = f"^{_NUMBER}$"
NUMBER_PAIR = f"^{_NUMBER},{_NUMBER}$"
STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def parse_timestamp(text: Column) -> Column:
    """ISO-8601 date or date-time, UTC where no zone is given, else epoch milliseconds; else null.

    The form devices send is cast as it is; shorter ones are first completed.
    """
    day, time, zone = (F.regexp_extract(text, DATE_TIME, group) for group in (1, 2, 3))
    completed = F.concat(
        day, F.substring(F.lit("0000-01-01"), F.length(day) + 1, F.lit(10)),
        F.lit("T"), F.translate(time, ",", "."), F.substring(F.lit("00:00:00"), F.length(time) + 1, F.lit(8)),
        F.coalesce(F.nullif(zone, F.lit("")), F.lit("Z")),
    )
    whole_days = (F.length(day) == 10) | (time == "")
    return (
        F.when(text.rlike(FULL_DATE_TIME), text.try_cast("timestamp"))
        .when(text.rlike(DATE_TIME), F.when(whole_days, completed.try_cast("timestamp")))
        .when(text.rlike("^-?[0-9]+$"), F.timestamp_millis(text.try_cast("bigint")))
    )


def parse_number(text: Column) -> Column:
    """Finite single-precision number, also from quoted text; null for anything else."""
    value = text.try_cast("float")
    return F.when(text.rlike(NUMBER) & (F.abs(value) < F.lit(float("inf"))), value)


def parse_location(text: Column) -> Column:
    """``"lat,lon"`` as a struct; null when malformed or off the globe."""
    lat = F.substring_index(text, ",", 1).try_cast("double")
    lon = F.substring_index(text, ",", -1).try_cast("double")
    valid = text.rlike(NUMBER_PAIR) & lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0)
    return F.when(valid, F.struct(lat.alias("lat"), lon.alias("lon"))).cast(LOCATION_TYPE)


def is_flat(body: Column) -> Column:
    """Whether a body that parses holds single values only, and nothing stands behind it.

    Judged on what is left of the body without its strings.
    """
    unescaped = F.when(body.contains("\\"), F.regexp_replace(body, r"(?s)\\.", "")).otherwise(body)
    return F.regexp_replace(unescaped, '"[^"]*"', "").rlike(r"^\s*\{[^{}\[\]]*\}\s*$")


def parse_documents(raw: DataFrame, body: str = "body") -> DataFrame:
    """Adds the typed event fields, ``message_keyword`` and ``reason``.

    ``reason`` is null for a document the strict table accepts, else why it is refused.
    Absent fields are allowed, unknown ones are not.
    """
    carried = raw.columns
    known = F.array(*[F.lit(name) for name in EVENT_FIELDS])
    doc = raw.select("*", F.from_json(body, "map<string,string>", STRICT).alias("_doc"))
    read = doc.select(
        *carried, *[F.col("_doc")[name].alias(f"_{name}") for name in EVENT_FIELDS], F.map_keys("_doc").alias("_keys")
    )
    parsers = {"timestamp": parse_timestamp, "location": parse_location, **dict.fromkeys(NUMERIC_FIELDS, parse_number)}
    text = {name: F.col(f"_{name}") for name in EVENT_FIELDS}
    unknown = F.size(F.array_except("_keys", known)) > 0
    fields = F.struct(
        *[parsers.get(name, lambda c: c)(text[name]).alias(name) for name in EVENT_FIELDS],
        F.when(F.col("_keys").isNull(), "not_an_object").when(unknown, "unknown_field").alias("_refused"),
        is_flat(F.col(body)).alias("_flat"),
        *[text[name].isNotNull().alias(f"_has_{name}") for name in parsers],
    )
    # One struct through a generator: a filter on the outcome would otherwise be pushed below, and
    # every document parsed again for each field that the filter looks at.
    typed = read.select(*carried, F.inline(F.array(fields)))

    def unparsed(name: str) -> Column:
        return F.col(f"_has_{name}") & F.col(name).isNull()

    bad_number = unparsed(NUMERIC_FIELDS[0]) | unparsed(NUMERIC_FIELDS[1]) | unparsed(NUMERIC_FIELDS[2])
    reason = (
        F.when(F.col("_refused").isNotNull(), F.col("_refused"))
        .when(unparsed("timestamp"), "bad_timestamp")
        .when(bad_number, "bad_number")
        .when(unparsed("location"), "bad_location")
        .when(~F.col("_flat"), "bad_structure")
    )
    keyword = F.when(F.length("message") <= KEYWORD_LIMIT, F.col("message"))
    return typed.select(*carried, *EVENT_FIELDS, keyword.alias("message_keyword"), reason.alias("reason"))


def normalize_events(raw: DataFrame, body: str = "body") -> DataFrame:
    """Accepted documents as typed events."""
    return parse_documents(raw, body).where(F.col("reason").isNull()).drop("reason", body)


def quarantine(raw: DataFrame, body: str = "body") -> DataFrame:
    """Refused documents, unchanged, with the reason."""
    return parse_documents(raw, body).where(F.col("reason").isNotNull()).select(*raw.columns, "reason")


def outcome_counts() -> list[Column]:
    """Of parsed documents: accepted, refused, any CRITICAL, first and last ``sent_ms``."""
    return [
        F.count_if(F.col("reason").isNull()).alias("docs_ok"),
        F.count_if(F.col("reason").isNotNull()).alias("docs_rejected"),
        F.coalesce(F.bool_or(F.col("severity") == "CRITICAL"), F.lit(False)).alias("has_anomaly"),
        F.min("sent_ms").alias("first_ms"),
        F.max("sent_ms").alias("last_ms"),
    ]


def batch_counts(parsed: DataFrame) -> DataFrame:
    """``outcome_counts`` per ``batch_id``."""
    return parsed.groupBy("batch_id").agg(*outcome_counts())


# A micro-batch's counts, what all up to it add up to, and the generation that its documents went to.
LEDGER = (
    "batch_id bigint, docs_ok bigint, docs_rejected bigint, has_anomaly boolean, first_ms bigint, last_ms bigint, "
    "ok_so_far bigint, rejected_so_far bigint, began_ms bigint, day bigint, generation int, generation_docs bigint, "
    "opened_ms bigint"
)


def last_row(spark: SparkSession, stats: str, batch_id: int) -> dict | None:
    """The row of the micro-batch before ``batch_id``: one small file, whatever the length of the record."""
    path = f"{stats}/batch={batch_id - 1:012d}"
    return spark.read.schema(LEDGER).parquet(path).first().asDict() if exists(spark, path) else None


def next_row(last: dict | None, batch_id: int, counts: dict, policy: Retention) -> dict:
    """The row after ``last``, from the counts observed while a micro-batch was written.

    A day starts with generation 1. A generation that has reached the policy's size or age takes no more.
    """
    last = last or {}
    taken = counts["taken_ms"] if counts["taken_ms"] is not None else last.get("opened_ms") or 0
    row = {k: counts[k] for k in ("docs_ok", "docs_rejected", "has_anomaly", "first_ms", "last_ms")}
    number, docs, opened = 1, 0, taken
    if last and last["day"] == taken // DAY:
        number, docs, opened = last["generation"], last["generation_docs"], last["opened_ms"]
        if docs >= policy.rollover_docs or taken - opened >= policy.rollover_days * DAY:
            number, docs, opened = number + 1, 0, taken
    known = [ms for ms in (last.get("began_ms"), counts["first_ms"]) if ms is not None]
    return row | {
        "batch_id": batch_id, "ok_so_far": last.get("ok_so_far", 0) + row["docs_ok"],
        "rejected_so_far": last.get("rejected_so_far", 0) + row["docs_rejected"], "began_ms": min(known, default=None),
        "day": taken // DAY, "generation": number, "generation_docs": docs + row["docs_ok"], "opened_ms": opened,
    }


def kept_stats(ledger: DataFrame) -> DataFrame:
    """The rows of ``ingest_stats`` from what a continuous ingest keeps: running totals are there, not added up anew."""
    seconds = (F.col("last_ms") - F.col("began_ms")) / 1000.0
    rate = F.when(seconds > 0, F.round(F.col("ok_so_far") / seconds, 6)).otherwise(F.lit(0.0))
    return ledger.select(
        "batch_id", "docs_ok", "docs_rejected", "has_anomaly", F.col("ok_so_far").alias("total_ok"),
        F.col("rejected_so_far").alias("total_rejected"), rate.alias("docs_per_s"),
    )


def with_running_stats(batches: DataFrame, batches_per_chunk: int = 4096) -> DataFrame:
    """Adds running totals and the documents accepted per second since the first one was sent.

    Batches are gathered in chunks, one row each. What the chunks before a chunk add up to comes from a window over these
    rows; both uses of a chunk take the whole row, so Spark shuffles once and nothing below is run again.
    """
    row = F.struct("batch_id", *[c for c in batches.columns if c != "batch_id"])
    chunks = batches.groupBy(bucket_start(F.col("batch_id"), batches_per_chunk).alias("_chunk")).agg(
        F.array_sort(F.collect_list(row)).alias("_rows")
    )

    def added(field: str) -> Column:
        return F.aggregate("_rows", F.lit(0).cast("bigint"), lambda total, r: total + r[field])

    upto = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = chunks.select(
        "_chunk", added("docs_ok").alias("_ok"), added("docs_rejected").alias("_rejected"),
        F.array_min(F.transform("_rows", lambda r: r["first_ms"])).alias("_first"),
    )
    before = sums.select(
        F.col("_chunk").alias("_of"), F.coalesce(F.sum("_ok").over(upto), F.lit(0)).alias("_ok"),
        F.coalesce(F.sum("_rejected").over(upto), F.lit(0)).alias("_rejected"), F.min("_first").over(whole).alias("_first"),
    )
    # An equality that drops nulls would be pushed below one of the two uses, which then differ.
    rows = chunks.join(before, F.col("_chunk").eqNullSafe(F.col("_of"))).select("_chunk", "_ok", "_rejected", "_first", F.inline("_rows"))
    inside = Window.partitionBy("_chunk").orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)
    totals = rows.withColumns({
        "total_ok": F.col("_ok") + F.sum("docs_ok").over(inside),
        "total_rejected": F.col("_rejected") + F.sum("docs_rejected").over(inside),
    })
    seconds = (F.col("last_ms") - F.col("_first")) / 1000.0
    rate = F.when(seconds > 0, F.round(F.col("total_ok") / seconds, 6)).otherwise(F.lit(0.0))
    return totals.withColumn("docs_per_s", rate).drop("_chunk", "_ok", "_rejected", "_first", "first_ms", "last_ms")


def ingest_stats(raw: DataFrame, body: str = "body") -> DataFrame:
    """One row per ``batch_id``: counts, running totals, rate and whether any event was CRITICAL; documents are parsed once."""
    return with_running_stats(batch_counts(parse_documents(raw, body)))
