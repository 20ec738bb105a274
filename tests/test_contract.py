from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from strata.operators.contract import (
    ARTICLE_EVENT,
    ARTICLE_RECORD,
    check,
    dead_letter_rows,
    ingest_counts,
    observe_counts,
    quarantine_rows,
    valid_rows,
)
from strata.sources.readers import read_events, read_json
from tests.helpers import EVENTS

GOOD = {
    "article_id": "ART-1",
    "title": "A fitting title",
    "author": "Somebody",
    "category": "AI",
    "content": "Long enough content.",
    "views": 5,
    "rating": 4.5,
    "published_timestamp": "2026-08-10T12:00:00Z",
}


def events(spark, payloads: list):
    texts = [p if isinstance(p, str) else json.dumps(p) for p in payloads]
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, value string")


def outcomes(spark, payloads: list, contract=ARTICLE_EVENT) -> list[list[tuple[str, str]]]:
    rows = check(events(spark, payloads), contract).orderBy("n").select("_errors").collect()
    return [[(e["field"], e["message"]) for e in row[0]] for row in rows]


def test_sample_batch_splits_five_to_three(spark):
    checked = check(read_events(spark, EVENTS, layout="array"), ARTICLE_EVENT)
    assert ingest_counts(checked).first().asDict() == {
        "total_processed": 8,
        "valid_count": 5,
        "quarantine_count": 3,
    }
    failed = {
        json.loads(r["raw_payload"])["article_id"]: (r["failed_field"], r["rejection_reason"])
        for r in quarantine_rows(checked).collect()
    }
    assert {k: v[0] for k, v in failed.items()} == {
        "ART-BAD-01": "title",
        "ART-BAD-02": "views",
        "ART-BAD-03": "category",
    }
    assert failed["ART-BAD-01"][1] == "Validation Failed: String should have at least 3 characters"
    every = {
        r["article_id"]: r["f"]
        for r in checked.select("article_id", F.col("_errors.field").alias("f")).collect()
    }
    assert every["ART-BAD-02"] == ["views", "rating"]
    assert every["ART-BAD-03"] == ["category", "published_timestamp"]


def test_valid_rows_have_contract_columns_and_types(spark):
    checked = check(events(spark, [{**GOOD, "unknown": 1, "views": "12.0", "rating": True}]), ARTICLE_EVENT)
    df = valid_rows(checked, ARTICLE_EVENT)
    assert df.columns == list(GOOD)
    assert dict(df.dtypes)["views"] == "bigint" and dict(df.dtypes)["rating"] == "double"
    row = df.first()
    assert (row["views"], row["rating"], row["published_timestamp"]) == (12, 1.0, GOOD["published_timestamp"])


INTEGERS = [
    ("12", 12, None),
    ("12.0", 12, None),
    ('"12"', 12, None),
    ('" 12 "', 12, None),
    ('"12.0"', 12, None),
    ("true", 1, None),
    ("1e3", 1000, None),
    ("9007199254740993", 9007199254740993, None),
    ("12.5", None, "Input should be a valid integer, got a number with a fractional part"),
    ("null", None, "Input should be a valid integer"),
    ("[1]", None, "Input should be a valid integer"),
    ('"x"', None, "Input should be a valid integer, unable to parse string as an integer"),
    ('"1_000"', None, "Input should be a valid integer, unable to parse string as an integer"),
    ("1180591620717411303424", None, "Input should be a valid integer, out of range for 64 bits"),
    ('"99999999999999999999"', None, "Input should be a valid integer, out of range for 64 bits"),
    ("-5", -5, "Input should be greater than or equal to 0"),
]
NUMBERS = [
    ("4", 4.0, None),
    ("4.25", 4.25, None),
    ('" 4.5 "', 4.5, None),
    ('"4e0"', 4.0, None),
    ("true", 1.0, None),
    ("null", None, "Input should be a valid number"),
    ("{}", None, "Input should be a valid number"),
    ('"4.5d"', None, "Input should be a valid number, unable to parse string as a number"),
    ('""', None, "Input should be a valid number, unable to parse string as a number"),
    ("6.5", 6.5, "Input should be less than or equal to 5"),
    ('"inf"', float("inf"), "Input should be less than or equal to 5"),
    ("-0.5", -0.5, "Input should be greater than or equal to 0"),
]


def test_lax_coercion(spark):
    cases = [("views", *c) for c in INTEGERS] + [("rating", *c) for c in NUMBERS]
    payloads = []
    for field, literal, _, _ in cases:
        text = json.dumps({**GOOD, field: "@@"})
        payloads.append(text.replace('"@@"', literal))
    rows = check(events(spark, payloads), ARTICLE_EVENT).orderBy("n").collect()
    for (field, literal, value, message), row in zip(cases, rows):
        assert row[field] == value, literal
        assert [tuple(e) for e in row["_errors"]] == ([(field, message)] if message else []), literal


def test_nan_text_is_below_the_range(spark):
    assert outcomes(spark, [{**GOOD, "rating": "nan"}]) == [[("rating", "Input should be greater than or equal to 0")]]


def test_strings_never_coerce(spark):
    assert outcomes(spark, [{**GOOD, "title": 5}, {**GOOD, "title": None}, {**GOOD, "author": ["x"]}]) == [
        [("title", "Input should be a valid string")],
        [("title", "Input should be a valid string")],
        [("author", "Input should be a valid string")],
    ]


def test_lengths_count_code_points_and_keep_blanks(spark):
    assert outcomes(spark, [{**GOOD, "title": "   "}, {**GOOD, "title": "😀😀😀"}, {**GOOD, "title": "😀😀"}]) == [
        [],
        [],
        [("title", "String should have at least 3 characters")],
    ]


def test_missing_fields_and_order(spark):
    (errors,) = outcomes(spark, ["{}"])
    assert [f for f, _ in errors] == list(GOOD)
    assert {m for _, m in errors} == {"Field required"}


def test_payloads_that_are_no_objects(spark):
    for errors in outcomes(spark, ["[1]", '"text"', "3", "nope", "", '{"a":']):
        assert errors == [("unknown", "payload is not a JSON object")]


def test_last_duplicate_key_wins(spark):
    text = json.dumps(GOOD)[:-1] + ', "title": "x"}'
    assert outcomes(spark, [text]) == [[("title", "String should have at least 3 characters")]]


ACCEPTED = [
    "2026-08-01",
    "2026-08-01T10",
    "2026-08-01 10:00",
    "2026-08-01T10:00:00Z",
    "2026-08-01T10:00:00+03",
    "2026-08-01T10Z",
    "2026-08-01T10:00+03:00",
    "2026-08-01T10:00:00,5",
    "2026-08-01T10:00:00.123456789",
]
REJECTED = [
    "2026-02-30",
    "2026-08-01T24:00:00",
    "",
    "Z",
    "2026-08-01T10:00:00ZZ",
    "2026-08-01T10:00:00z",
    "2026-8-1",
    "2026-08",
    "0000-01-01",
    "2026-W31-1",
    "INVALID-DATE-FORMAT",
]


def test_iso_timestamps(spark):
    got = outcomes(spark, [{**GOOD, "published_timestamp": t} for t in ACCEPTED + REJECTED])
    assert [bool(e) for e in got] == [False] * len(ACCEPTED) + [True] * len(REJECTED)
    assert got[-1] == [
        ("published_timestamp", "Value error, Invalid ISO 8601 timestamp format: 'INVALID-DATE-FORMAT'")
    ]


def test_category_message_is_sorted(spark):
    ((error,),) = outcomes(spark, [{**GOOD, "category": "Pets"}])
    assert error[1] == (
        "Value error, Category 'Pets' is not in allowed list: "
        "['AI', 'Cloud', 'Cybersecurity', 'Data Engineering', 'Software Architecture']"
    )


def test_many_faults_at_once(spark):
    bad = {**GOOD, "title": "X", "category": "No", "content": "Short", "views": -10, "rating": 10.0,
           "published_timestamp": "BAD-DATE"}
    (errors,) = outcomes(spark, [bad])
    assert [f for f, _ in errors] == ["title", "category", "content", "views", "rating", "published_timestamp"]


def test_second_contract(spark):
    record = {
        "article_id": "a0eebc99-9c0b-4ef8-bb6d-6bb9bd380a11",
        "title": "Enough title",
        "content": "Enough content here.",
        "category": "AI_ML",
        "published_at": "2026-08-10T12:00:00Z",
        "word_count": 3,
    }
    without_id = {k: v for k, v in record.items() if k != "article_id"}
    payloads = [
        record,
        {**record, "author": 5},
        without_id,
        {**record, "title": "Tiny"},
        {**record, "category": "UNSUPPORTED_CATEGORY"},
        {**record, "word_count": -5},
        {**record, "article_id": "no-uuid"},
    ]
    got = outcomes(spark, payloads, ARTICLE_RECORD)
    assert [e[0][0] if e else None for e in got] == [
        None, "author", "article_id", "title", "category", "word_count", "article_id",
    ]
    letters = dead_letter_rows(check(events(spark, payloads), ARTICLE_RECORD)).collect()
    assert len(letters) == 6
    assert {r["error_type"] for r in letters} == {"ValidationError"}
    assert all(r["quarantine_id"].startswith("dlq_") and len(r["quarantine_id"]) == 36 for r in letters)


def test_quarantine_record(spark):
    checked = check(events(spark, [{**GOOD, "views": -1}]), ARTICLE_EVENT)
    first, again = (quarantine_rows(checked, position=("n",)).first() for _ in range(2))
    assert first["quarantine_id"] == again["quarantine_id"]
    assert first["quarantine_id"].startswith("QLOG-") and len(first["quarantine_id"]) == 37
    assert first["rejection_timestamp"].endswith("Z")
    assert json.loads(first["raw_payload"])["views"] == -1
    assert len(quarantine_rows(checked, digits=8).first()["quarantine_id"]) == 13


def test_counts_ride_on_another_action(spark):
    observed, seen = observe_counts(check(events(spark, [GOOD, "x"]), ARTICLE_EVENT))
    observed.write.format("noop").mode("overwrite").save()
    assert seen.get == {"total_processed": 2, "valid_count": 1, "quarantine_count": 1}


def test_parse_stays_below_the_filter(spark):
    """The filter on the errors must not repeat the JSON parse at the scan."""
    df = valid_rows(check(events(spark, [GOOD]), ARTICLE_EVENT), ARTICLE_EVENT)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") + plan.count("parse_json") == 1


def test_json_sources(spark, tmp_path):
    lines = tmp_path / "lines.json"
    lines.write_text(json.dumps(GOOD) + "\nnot json\n", encoding="utf-8")
    rows = read_events(spark, str(lines)).collect()
    assert len(rows) == 2 and rows[0]["_source_file"].endswith("lines.json")
    typed = read_json(spark, EVENTS, "article_id string, views bigint", array=True)
    assert typed.count() == 8 and typed.agg(F.sum("views")).first()[0] == 9740
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_json(spark, str(tmp_path / "missing.json"), "a string")
    with pytest.raises(ValueError):
        read_events(spark, str(lines), layout="other")
