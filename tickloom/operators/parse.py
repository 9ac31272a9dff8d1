"""JSON messages to records, and the split into usable and rejected ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tickloom.functions import parse_iso
from tickloom.schemas import SCHEMA_NAME, SCHEMA_VERSION, TICK_COLUMNS, TICK_JSON_V1

CORRUPT = "_corrupt_record"
MESSAGE_COLUMNS = ("topic", "partition", "offset")
MALFORMED = "malformed"
NO_EVENT_TIME = "no_event_time"
UNKNOWN_VERSION = "unknown_version"


def parse_messages(
    messages: DataFrame, schema: T.StructType = TICK_JSON_V1, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Records with their message coordinates, ``reject_reason`` and
    ``partially_corrupt``.

    PERMISSIVE parsing returns an all-NULL struct for broken JSON, so NULL-ness of
    the struct does not find it: a message is malformed when there is no payload, or
    when the parser flagged it and no field survived. A record with one bad field
    stays, with that field NULL.

    The struct is unpacked with ``inline`` because filters do not move through a
    generator; as a plain projection the parser would run once for the filter and
    once for the output.
    """
    with_flag = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(
        "json_str",
        with_flag,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    coordinates = [c for c in (*MESSAGE_COLUMNS, *keep) if c in messages.columns]
    rows = messages.select(F.col("value").cast("string").alias("json_str"), *coordinates).select(
        "json_str", *coordinates, F.inline(F.array(parsed))
    )
    survived = F.coalesce(*[F.col(name).cast("string") for name in schema.names]).isNotNull()
    flagged = F.col(CORRUPT).isNotNull()
    no_payload = F.col("json_str").isNull() | (F.trim("json_str") == "")
    reason = F.when(no_payload | (flagged & ~survived), MALFORMED).when(
        _has_key() & parse_iso(F.col("timestamp")).isNull(), NO_EVENT_TIME
    )
    return rows.select(
        "json_str",
        *coordinates,
        *schema.names,
        reason.alias("reject_reason"),
        (flagged & survived).alias("partially_corrupt"),
    )


def _has_key() -> Column:
    return F.coalesce(F.col("ticker") != "", F.lit(False))


def usable_records(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNull())


def malformed_messages(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason") == MALFORMED)


def rejected_messages(parsed: DataFrame) -> DataFrame:
    """Everything that cannot enter the keyed stream: malformed, or no event time."""
    return parsed.filter(F.col("reject_reason").isNotNull())


def as_dead_letters(rejects: DataFrame) -> DataFrame:
    """One JSON ``value`` per rejected message: the payload and where it came from."""
    return rejects.select(F.to_json(F.struct("json_str", *MESSAGE_COLUMNS)).alias("value"))


def header_value(headers: Column, key: str) -> Column:
    """Text of a record header; NULL when absent."""
    found = F.filter(headers, lambda header: header["key"] == key)
    return F.get(found, F.lit(0))["value"].cast("string")


def schema_version(headers: Column) -> Column:
    """Contract version of a message; messages without the header count as v1."""
    return F.coalesce(header_value(headers, "schema_version"), F.lit(SCHEMA_VERSION))


def parse_by_version(
    messages: DataFrame, contracts: dict[str, T.StructType], keep: tuple[str, ...] = ()
) -> DataFrame:
    """Every message parsed by its own contract version, in one pass.

    The result has the fields of all contracts, ``schema_version`` and ``reject_reason``. A field
    that a message's contract does not have is NULL, whatever the payload says. Messages of a
    version or schema that is not listed are rejected as ``unknown_version``. Contracts may add
    fields but agree on the types of those they share.
    """
    fields: dict[str, T.StructField] = {}
    for version, contract in contracts.items():
        for f in contract.fields:
            if fields.setdefault(f.name, f).dataType != f.dataType:
                raise ValueError(f"{f.name} has another type in version {version}")
    headers = F.col("headers")
    named = F.coalesce(header_value(headers, "schema_name"), F.lit(SCHEMA_NAME))
    marked = messages.withColumn("schema_version", schema_version(headers)).withColumn("_known", named == SCHEMA_NAME)
    parsed = parse_messages(marked, T.StructType(list(fields.values())), (*keep, "schema_version", "_known"))
    version, listed = F.col("schema_version"), F.col("_known") & F.col("schema_version").isin(list(contracts))
    columns = []
    for name in fields:
        has_it = [v for v, contract in contracts.items() if name in contract.names]
        columns.append(F.when(listed & version.isin(has_it), F.col(name)).alias(name))
    carried = [c for c in parsed.columns if c not in fields and c not in ("_known", "reject_reason")]
    reason = F.when(~listed, UNKNOWN_VERSION).otherwise(F.col("reject_reason"))
    return parsed.select(*carried, *columns, reason.alias("reject_reason"))


def route_by_version(
    messages: DataFrame, contracts: dict[str, T.StructType]
) -> dict[str, DataFrame]:
    """Messages of each known contract version with its fields, and under ``unknown_version``
    those of any other one: every message is in exactly one of the frames."""
    parsed = parse_by_version(messages, contracts)
    unknown = F.coalesce(F.col("reject_reason") == UNKNOWN_VERSION, F.lit(False))
    extra = {f for contract in contracts.values() for f in contract.names}
    routed = {
        version: parsed.filter(~unknown & (F.col("schema_version") == version)).drop(*(extra - set(contract.names)))
        for version, contract in contracts.items()
    }
    return {**routed, UNKNOWN_VERSION: parsed.filter(unknown)}


def field_drift(messages: DataFrame, expected: tuple[str, ...] = TICK_COLUMNS) -> DataFrame:
    """Records per missing or unknown top-level field.

    A field counts as missing when the key is absent. Messages that are no JSON
    object have no keys and are left to the reject output.
    """
    wanted = F.array(*[F.lit(name) for name in expected])
    keys = messages.select(F.json_object_keys(F.col("value").cast("string")).alias("keys"))
    drift = keys.filter(F.col("keys").isNotNull()).select(
        F.explode(
            F.concat(
                F.transform(
                    F.array_except(wanted, "keys"),
                    lambda name: F.struct(name.alias("field"), F.lit("missing").alias("drift")),
                ),
                F.transform(
                    F.array_except("keys", wanted),
                    lambda name: F.struct(name.alias("field"), F.lit("unknown").alias("drift")),
                ),
            )
        ).alias("d")
    )
    return drift.groupBy("d.field", "d.drift").agg(F.count(F.lit(1)).alias("records"))
