"""Decoding topic values and checking them against a record's rules.

``decode`` keeps every row and says what is wrong with it; ``accepted`` and
``rejected`` are the two halves.  Both halves read the decoded frame, so write
or persist it first when both are used in one batch.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from newsmart import schemas as S
from newsmart.functions.identity import canonical_uuid, derived_event_id

_CORRUPT, _MISTYPED, _UNREADABLE = "_corrupt", "_mistyped", "_unreadable"


@dataclass(frozen=True)
class RecordRules:
    """What a record must satisfy to be accepted."""

    schema: T.StructType
    required: Sequence[str]
    domains: Mapping[str, Sequence[str]] = field(default_factory=dict)
    ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    uuids: Sequence[str] = ()
    objects: Sequence[str] = ()
    lengths: Mapping[str, int] = field(default_factory=dict)
    defaults: Mapping[str, str] = field(default_factory=dict)  # where the record has none
    numbers: Sequence[str] = ()  # text fields that must read as a number
    loose: Sequence[str] = ()  # further text fields, at any depth, that any scalar may fill


_RAW_REQUIRED = ("timestamp", "source", "title", "content", "tickers")

RAW_RULES = RecordRules(
    schema=S.RAW_NEWS,
    required=_RAW_REQUIRED,
    domains={"source": S.SOURCES},
    uuids=("event_id",),
    objects=("raw_metadata",),
)

PROCESSED_RULES = RecordRules(
    schema=S.PROCESSED_NEWS,
    required=("event_id", *_RAW_REQUIRED, "companies", "content_hash", "processed_at"),
    domains={"source": S.SOURCES},
    uuids=("event_id",),
    objects=("raw_metadata",),
    lengths={"source": 50, "content_hash": 64},
)

ANALYSIS_RULES = RecordRules(
    schema=S.ANALYSIS,
    required=(
        "article_event_id",
        "summary",
        "sentiment",
        "sentiment_confidence",
        "entities",
        "key_topics",
        "analyzed_at",
        "model_id",
    ),
    domains={"sentiment": S.SENTIMENTS},
    ranges={"sentiment_confidence": (0.0, 1.0)},
    uuids=("article_event_id",),
    lengths={"sentiment": 20, "model_id": 100, "analysis_version": 20},
    defaults={"analysis_version": S.ANALYSIS_VERSION},
)

AGGREGATE_RULES = RecordRules(
    schema=S.TICKER_AGGREGATE,
    required=("ticker", "company_name", "window_start", "window_end", "article_count"),
    domains={"dominant_sentiment": S.SENTIMENTS},
    lengths={"ticker": 10, "company_name": 200, "dominant_sentiment": 20},
)

MARKET_ITEM_RULES = RecordRules(
    schema=S.MARKET_ITEM,
    required=(
        "title",
        "url",
        "summary",
        "source",
        "time_published",
        "overall_sentiment_score",
        "overall_sentiment_label",
    ),
    numbers=("overall_sentiment_score",),
)


def _null_within(value: Column, dtype: T.DataType) -> Column | None:
    """True where an array holds a null, or a struct with a null field."""
    if not isinstance(dtype, T.ArrayType):
        return None
    if isinstance(dtype.elementType, T.StructType):
        names = dtype.elementType.fieldNames()

        def incomplete(item: Column) -> Column:
            missing = item.isNull()
            for name in names:
                missing = missing | item[name].isNull()
            return missing

        return F.exists(value, incomplete)
    return F.exists(value, lambda item: item.isNull())


def problems(rules: RecordRules, record: Column) -> Column:
    """Reasons to reject ``record``, as an array; empty where there is none."""
    checks = []

    def note(condition: Column, reason: str) -> None:
        checks.append(F.when(condition, F.lit(reason)))

    for name in rules.required:
        note(record[name].isNull(), f"missing:{name}")
    for name, allowed in rules.domains.items():
        note(~record[name].isin(*allowed), f"domain:{name}")
    for name in rules.numbers:
        read = record[name].try_cast("double")
        note(record[name].isNotNull() & read.isNull(), f"number:{name}")
    for name, (low, high) in rules.ranges.items():
        read = record[name].try_cast("double")
        note(~read.between(low, high), f"range:{name}")
    for name in rules.uuids:
        note(record[name].isNotNull() & canonical_uuid(record[name]).isNull(), f"uuid:{name}")
    for name in rules.objects:
        note(~record[name].rlike(r"^\s*\{"), f"object:{name}")
    for name, limit in rules.lengths.items():
        note(F.length(record[name]) > limit, f"length:{name}")
    for spec in rules.schema.fields:
        within = _null_within(record[spec.name], spec.dataType)
        if within is not None:
            note(within, f"element:{spec.name}")
    return F.array_compact(F.array(*checks))


# Text is read as a variant first, which keeps the JSON type: a number where
# text is due is an error, not its digits.


def _wire_type(dtype: T.DataType) -> T.DataType:
    if isinstance(dtype, T.StringType):
        return T.VariantType()
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_wire_type(dtype.elementType))
    return dtype


def _wire_schema(schema: T.StructType, loose: set[str]) -> T.StructType:
    fields = []
    for spec in schema.fields:
        dtype = spec.dataType
        if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
            dtype = T.ArrayType(_wire_schema(dtype.elementType, loose))
        elif spec.name not in loose:
            dtype = _wire_type(dtype)
        fields.append(T.StructField(spec.name, dtype))
    return T.StructType(fields)


def _text(value: Column) -> Column:
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def _not_text(value: Column) -> Column:
    return F.coalesce(~F.schema_of_variant(value).isin("STRING", "VOID"), F.lit(False))


def _plain(value: Column, dtype: T.DataType) -> Column:
    """A wire value with its text as text; null where it is something else."""
    if isinstance(dtype, T.VariantType):
        return _text(value)
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda item: _plain(item, dtype.elementType))
    if isinstance(dtype, T.StructType):
        whole = F.struct(*[_plain(value[f.name], f.dataType).alias(f.name) for f in dtype.fields])
        return F.when(value.isNotNull(), whole)
    return value


def _mistyped(value: Column, dtype: T.DataType) -> Column | None:
    """True where text is due and something else is there; None if no text is due."""
    if isinstance(dtype, T.VariantType):
        return _not_text(value)
    if isinstance(dtype, T.ArrayType):
        element = dtype.elementType
        if isinstance(element, T.VariantType | T.StructType):
            return F.coalesce(
                F.exists(value, lambda item: _mistyped(item, element)), F.lit(False)
            )
    if isinstance(dtype, T.StructType):
        parts = [_mistyped(value[f.name], f.dataType) for f in dtype.fields]
        return reduce(Column.__or__, [p for p in parts if p is not None], F.lit(False))
    return None


def once(df: DataFrame, column: Column, name: str) -> DataFrame:
    """Add a column that is computed once however often it is used.

    It sits in a generator because a filter on its parts would otherwise be
    pushed below it and compute it once per mention.
    """
    return df.select("*", F.explode(F.array(column)).alias(name))


def decode(df: DataFrame, rules: RecordRules, value: str = "value") -> DataFrame:
    """Parse ``value`` and add ``record`` and ``reasons``; null values are dropped.

    A null value is a tombstone and carries no record.
    """
    schema = _wire_schema(rules.schema, {*rules.objects, *rules.numbers, *rules.loose})
    flagged = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    live = df.where(F.col(value).isNotNull())
    wire = once(live, F.from_json(value, flagged, options), "_wire")
    parts = [(f.name, F.col("_wire")[f.name], f.dataType) for f in schema.fields]
    checks = [(name, _mistyped(part, dtype)) for name, part, dtype in parts]
    mistyped = [F.when(wrong, F.lit(f"type:{n}")) for n, wrong in checks if wrong is not None]
    typed = once(
        wire,
        F.struct(
            *[_plain(part, dtype).alias(name) for name, part, dtype in parts],
            F.array_compact(F.array(*mistyped)).alias(_MISTYPED),
            (
                ~F.col(value).rlike(r"^\s*\{")
                | F.col("_wire").isNull()
                | F.col("_wire")[_CORRUPT].isNotNull()
            ).alias(_UNREADABLE),
        ),
        "record",
    ).drop("_wire")
    record = F.col("record")
    return typed.withColumn(
        "reasons",
        F.when(record[_UNREADABLE], F.array(F.lit("malformed")))
        .when(F.size(record[_MISTYPED]) > 0, record[_MISTYPED])
        .otherwise(problems(rules, record)),
    )


def accepted(decoded: DataFrame, rules: RecordRules) -> DataFrame:
    """Records without a problem, with ids in their canonical spelling."""
    good = decoded.where(F.size("reasons") == 0)
    fields = [f"record.{n}" for n in rules.schema.fieldNames()]
    named = {n: canonical_uuid(F.col(n)) for n in rules.uuids}
    named |= {n: F.coalesce(F.col(n), F.lit(value)) for n, value in rules.defaults.items()}
    return good.select(*fields).withColumns(named)


def rejected(decoded: DataFrame) -> DataFrame:
    """Dead letters: the input columns and the reason they were set aside."""
    return decoded.where(F.size("reasons") > 0).select(
        *[c for c in decoded.columns if c not in ("record", "reasons")],
        F.array_join("reasons", ",").alias("reason"),
    )


def with_event_id(raw: DataFrame) -> DataFrame:
    """Give records without an id one derived from what they say."""
    derived = derived_event_id(
        F.col("source"),
        F.coalesce("source_url", F.lit("")),
        F.col("timestamp").cast("string"),
        F.col("title"),
        F.col("content"),
    )
    return raw.withColumn("event_id", F.coalesce("event_id", derived))
