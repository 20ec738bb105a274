"""Data contracts: declared fields checked as column expressions.

A contract reads raw JSON text. The text is parsed once into a VARIANT; every
rule is a Column over it, so the whole check runs inside the JVM scan stage
with no shuffle and no Python worker.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F

from strata.functions.timestamps import is_iso, utc_text

INT_TEXT = r"^\s*([+-]?\d+)(\.0*)?\s*$"
NUMBER_TEXT = r"(?i)^\s*[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"
DECIMAL_WHOLE = r"^([+-]?\d+)(\.0*)?$"  # a decimal is compared as text: a double loses digits
DECIMAL_FRACTION = r"\.\d*[1-9]"
UUID_TEXT = r"(?i)^[0-9a-f]{8}-([0-9a-f]{4}-){3}[0-9a-f]{12}$"

SQL_TYPES = {"string": "string", "integer": "bigint", "number": "double"}

# The texts of the rejection reasons.
MISSING = "Field required"
NOT_STRING = "Input should be a valid string"
NOT_INTEGER = "Input should be a valid integer"
NOT_INTEGER_TEXT = NOT_INTEGER + ", unable to parse string as an integer"
NOT_INTEGER_FRACTION = NOT_INTEGER + ", got a number with a fractional part"
NOT_INTEGER_RANGE = NOT_INTEGER + ", out of range for 64 bits"
NOT_NUMBER = "Input should be a valid number"
NOT_NUMBER_TEXT = NOT_NUMBER + ", unable to parse string as a number"
NOT_OBJECT = "payload is not a JSON object"
REASON_PREFIX = "Validation Failed: "


@dataclass(frozen=True)
class Field:
    """One declared field; ``kind`` is string, integer or number."""

    name: str
    kind: str = "string"
    required: bool = True
    min_length: int | None = None
    ge: float | None = None
    le: float | None = None
    allowed: tuple[str, ...] | None = None
    fmt: str | None = None  # iso8601 or uuid
    label: str | None = None  # its name in the text about an enumerated value


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...]

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def sql_schema(self) -> str:
        return ", ".join(f"{f.name} {SQL_TYPES[f.kind]}" for f in self.fields)

    def with_allowed(self, field: str, allowed: tuple[str, ...]) -> "Contract":
        """The same contract with another value set for one field."""
        changed = tuple(
            Field(**{**f.__dict__, "allowed": allowed}) if f.name == field else f for f in self.fields
        )
        return Contract(self.name, changed)


# The two contracts, their categories and limits.
ARTICLE_EVENT = Contract(
    "article_event",
    (
        Field("article_id"),
        Field("title", min_length=3),
        Field("author", min_length=2),
        Field(
            "category",
            allowed=("AI", "Data Engineering", "Cloud", "Cybersecurity", "Software Architecture"),
        ),
        Field("content", min_length=10),
        Field("views", "integer", ge=0),
        Field("rating", "number", ge=0, le=5),
        Field("published_timestamp", fmt="iso8601"),
    ),
)

ARTICLE_RECORD = Contract(
    "article_record",
    (
        Field("article_id", fmt="uuid"),
        Field("title", min_length=5),
        Field("content", min_length=10),
        Field("category", allowed=("AI_ML", "Data_Engineering", "Cloud_Computing", "Cybersecurity")),
        Field("author", required=False),
        Field("published_at", fmt="iso8601"),
        Field("word_count", "integer", ge=1),
    ),
)


def _item(field: Field) -> Column:
    return F.try_variant_get("_payload", f"$.{field.name}", "variant")


def _coerced(field: Field, item: str, json_type: str) -> Column:
    """The field as its declared type, null where the value cannot be read as it."""
    kind, value = F.col(json_type), F.col(item)
    as_text = F.when(kind == "STRING", F.try_variant_get(value, "$", "string"))
    if field.kind == "string":
        return as_text
    numeric = kind.isin("BIGINT", "DOUBLE", "BOOLEAN") | kind.startswith("DECIMAL")
    as_double = F.try_variant_get(value, "$", "double")
    if field.kind == "integer":
        from_text = F.regexp_extract(as_text, INT_TEXT, 1).try_cast("bigint")
        whole = (kind == "BIGINT") | (kind == "BOOLEAN") | ((kind == "DOUBLE") & (as_double == F.rint(as_double)))
        digits = F.regexp_extract(F.try_variant_get(value, "$", "string"), DECIMAL_WHOLE, 1)
        exact = F.when(kind.startswith("DECIMAL"), digits.try_cast("bigint"))
        from_number = F.when(whole, F.try_variant_get(value, "$", "bigint")).otherwise(exact)
        return F.when(kind == "STRING", from_text).when(numeric, from_number)
    from_text = F.when(as_text.rlike(NUMBER_TEXT), F.trim(as_text).try_cast("double"))
    return F.when(kind == "STRING", from_text).when(numeric, as_double)


def _limit_text(limit: float) -> str:
    return f"{limit:g}"


def _message(field: Field, item: str, json_type: str, value: str) -> Column:
    """The first rule the field breaks, as text; null when it keeps them all."""
    kind, typed = F.col(json_type), F.col(value)
    absent = F.col(item).isNull()
    rules: list[tuple[Column, Column]] = []

    def rule(broken: Column, text: str | Column) -> None:
        rules.append((broken, F.lit(text) if isinstance(text, str) else text))

    if field.required:
        rule(absent, MISSING)
    if field.kind == "string":
        rule(kind != "STRING", NOT_STRING)
    elif field.kind == "integer":
        text = F.try_variant_get(F.col(item), "$", "string")
        number = F.try_variant_get(F.col(item), "$", "double")
        rule((kind == "STRING") & ~text.rlike(INT_TEXT), NOT_INTEGER_TEXT)
        rule((kind == "DOUBLE") & (number != F.rint(number)), NOT_INTEGER_FRACTION)
        rule(kind.startswith("DECIMAL") & text.rlike(DECIMAL_FRACTION), NOT_INTEGER_FRACTION)
        numeric = kind.startswith("DECIMAL") | kind.isin("BIGINT", "DOUBLE", "STRING")
        rule(numeric & typed.isNull(), NOT_INTEGER_RANGE)
        rule(typed.isNull(), NOT_INTEGER)
    else:
        rule((kind == "STRING") & typed.isNull(), NOT_NUMBER_TEXT)
        rule(typed.isNull(), NOT_NUMBER)
    if field.min_length is not None:
        unit = "character" if field.min_length == 1 else "characters"
        rule(F.length(typed) < field.min_length, f"String should have at least {field.min_length} {unit}")
    if field.ge is not None:
        below = typed < F.lit(field.ge)
        if field.kind == "number":
            below = below | F.isnan(typed)
        rule(below, f"Input should be greater than or equal to {_limit_text(field.ge)}")
    if field.le is not None:
        rule(typed > F.lit(field.le), f"Input should be less than or equal to {_limit_text(field.le)}")
    if field.allowed is not None:
        listed = ", ".join(f"'{value}'" for value in sorted(field.allowed))
        rule(
            ~typed.isin(*field.allowed),
            F.concat(F.lit(f"Value error, {field.label or field.name.capitalize()} '"), typed, F.lit(f"' is not in allowed list: [{listed}]")),
        )
    if field.fmt == "iso8601":
        rule(
            ~is_iso(typed),
            F.concat(F.lit("Value error, Invalid ISO 8601 timestamp format: '"), typed, F.lit("'")),
        )
    elif field.fmt == "uuid":
        rule(~typed.rlike(UUID_TEXT), "Input should be a valid UUID")

    message = F.when(*rules[0])
    for broken, text in rules[1:]:
        message = message.when(broken, text)
    if not field.required:
        message = F.when(~(absent | (kind == "VOID")), message)
    return message


def check(events: DataFrame, contract: Contract, value: str = "value") -> DataFrame:
    """Add the typed contract columns and ``_errors`` (field and message, in declared order).

    Columns of ``events`` other than the JSON text are kept. ``explode`` of the
    one-element array keeps the parse below it: a later filter on ``_errors``
    would otherwise be pushed to the scan with one parse per rule.
    """
    kept = [c for c in events.columns if c not in contract.columns]
    parsed = events.select(*kept, F.explode(F.array(F.try_parse_json(value))).alias("_payload"))
    items = parsed.select(
        "*",
        F.schema_of_variant("_payload").startswith("OBJECT").alias("_is_object"),
        *[_item(f).alias(f"_item_{f.name}") for f in contract.fields],
    )
    kinds = items.select("*", *[F.schema_of_variant(f"_item_{f.name}").alias(f"_kind_{f.name}") for f in contract.fields])
    typed = kinds.select(
        "*", *[_coerced(f, f"_item_{f.name}", f"_kind_{f.name}").alias(f.name) for f in contract.fields]
    )
    failures = F.filter(
        F.array(
            *[
                F.struct(
                    F.lit(f.name).alias("field"),
                    _message(f, f"_item_{f.name}", f"_kind_{f.name}", f.name).alias("message"),
                )
                for f in contract.fields
            ]
        ),
        lambda failure: failure["message"].isNotNull(),
    )
    not_object = F.array(F.struct(F.lit("unknown").alias("field"), F.lit(NOT_OBJECT).alias("message")))
    errors = F.when(F.coalesce("_is_object", F.lit(False)), failures).otherwise(not_object)
    return typed.select(*kept, *contract.columns, F.explode(F.array(errors)).alias("_errors"))


def is_valid() -> Column:
    return F.size("_errors") == 0


def valid_rows(checked: DataFrame, contract: Contract) -> DataFrame:
    """Rows without errors, contract columns only."""
    return checked.filter(is_valid()).select(*contract.columns)


ID_DIGITS = 32  # 128 bits; the short ids of the surveyed behaviour have 8


def quarantine_id(
    value: str, position: tuple[str, ...] = (), prefix: str = "QLOG-", digits: int = ID_DIGITS, batch: int | None = None
) -> Column:
    """Stable id from the raw text, its source position and the batch it came with.

    Equal texts need a position to get ids of their own. A replayed row keeps its id.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (value, *position)]
    if batch is not None:
        parts.append(F.lit(str(batch)))
    return F.concat(F.lit(prefix), F.upper(F.left(F.sha2(F.concat_ws("|", *parts), 256), F.lit(digits))))


def rejection_columns(
    value: str = "value", position: tuple[str, ...] = (), digits: int = ID_DIGITS, batch: int | None = None
) -> dict[str, Column]:
    """The quarantine record of a rejected row; the first failing field names the reason."""
    first = F.col("_errors")[0]
    return {
        "quarantine_id": quarantine_id(value, position, digits=digits, batch=batch),
        "rejection_timestamp": utc_text(F.current_timestamp()),
        "rejection_reason": F.concat(F.lit(REASON_PREFIX), first["message"]),
        "failed_field": first["field"],
        "raw_payload": F.col(value),
    }


def quarantine_rows(
    checked: DataFrame, value: str = "value", position: tuple[str, ...] = (), digits: int = ID_DIGITS
) -> DataFrame:
    """Rejected rows as quarantine records."""
    record = rejection_columns(value, position, digits)
    return checked.filter(~is_valid()).select(*[column.alias(name) for name, column in record.items()])


def dead_letter_rows(
    checked: DataFrame, value: str = "value", position: tuple[str, ...] = (), digits: int = ID_DIGITS
) -> DataFrame:
    """The second quarantine layout, with an error type and the plain message."""
    first = F.col("_errors")[0]
    return checked.filter(~is_valid()).select(
        F.lower(quarantine_id(value, position, prefix="dlq_", digits=digits)).alias("quarantine_id"),
        F.lit("ValidationError").alias("error_type"),
        first["field"].alias("field_failed"),
        first["message"].alias("error_message"),
        F.col(value).alias("raw_payload"),
        utc_text(F.current_timestamp()).alias("timestamp"),
    )


def ingest_counts(checked: DataFrame) -> DataFrame:
    """Total, valid and quarantined rows, in one pass."""
    return checked.agg(
        F.count(F.lit(1)).alias("total_processed"),
        F.count_if(is_valid()).alias("valid_count"),
        F.count_if(~is_valid()).alias("quarantine_count"),
    )


def observe_counts(checked: DataFrame) -> tuple[DataFrame, Observation]:
    """The same counts, taken while another action runs over the rows."""
    seen = Observation("ingest_counts")
    observed = checked.observe(
        seen,
        F.count(F.lit(1)).alias("total_processed"),
        F.count_if(is_valid()).alias("valid_count"),
        F.count_if(~is_valid()).alias("quarantine_count"),
    )
    return observed, seen
