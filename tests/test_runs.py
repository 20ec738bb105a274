from __future__ import annotations

import json

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F

from strata.config import Settings
from strata.operators.contract import ARTICLE_EVENT, check, valid_rows
from strata.operators.quality import Expectation, QualityGateError
from strata.operators.lineage import LineageLog
from strata.plans import medallion
from strata.plans.retrieval import hybrid_search
from strata.session import shared_dir, spread, work_path
from strata.sources.readers import read_events, stream_lines
from strata.sources.silver import read_silver
from strata.sources.writers import (
    SchemaMismatchError,
    read_quarantine,
    read_valid,
    send_to_kafka,
    write_snapshot,
    write_split,
)
from strata.streaming.contract_stream import quarantined, stream_contract, stream_silver
from tests.helpers import EVENTS

CATEGORIES = {
    "AI": (2, 5990, 2995.0, 4.95, 5.0),
    "Cybersecurity": (1, 950, 950.0, 4.6, 4.6),
    "Data Engineering": (1, 1420, 1420.0, 4.8, 4.8),
    "Software Architecture": (1, 1820, 1820.0, 4.7, 4.7),
}
AUTHORS = {
    "Dr. Sarah Al-Otaibi": (2, 4.9, 4520),
    "Fahad Al-Ghamdi": (1, 4.6, 950),
    "Laila Al-Hassan": (1, 4.7, 1820),
    "Mohammed Al-Beladi": (1, 4.9, 2890),
}


def sample(spark):
    return read_events(spark, EVENTS, layout="array")


def states(spark, root: str) -> set[tuple[str, str]]:
    events = LineageLog(spark, f"{root}/lineage").read()
    return {(r["name"], r["eventType"]) for r in events.select("job.name", "eventType").collect()}


def keyed(df) -> dict:
    return {row[0]: pytest.approx(tuple(row[1:])) for row in df.collect()}


def test_whole_run_on_the_sample(spark, tmp_path):
    root = str(tmp_path)
    summary, index = medallion.run(sample(spark), root, 1)
    assert (summary["total_processed"], summary["valid_count"], summary["quarantine_count"]) == (8, 5, 3)
    assert summary["bronze_count"] == 5
    assert summary["gate"]["passed_checks"] == 5
    assert keyed(medallion.read_gold(spark, root, "category_metrics")) == CATEGORIES
    assert keyed(medallion.read_gold(spark, root, "author_metrics")) == AUTHORS
    silver = read_silver(spark, f"{root}/silver")
    assert dict(silver.dtypes)["published_timestamp"] == "timestamp"
    assert silver.where(F.col("_source_file").endswith("events.json")).count() == 5
    names = {"article_run", "ingest", "bronze", "silver", "quality_gate", "gold", "index"}
    assert states(spark, root) == {(n, s) for n in names for s in ("START", "COMPLETE")}
    queries = spark.createDataFrame([(1, "fused ranking of lexical scores")], "query_id int, query string")
    best = hybrid_search(index, queries).where("final_rank = 1").first()
    assert best["doc_id"] == "ART-102"


def test_a_batch_run_again_changes_nothing(spark, tmp_path):
    root = str(tmp_path)
    for _ in range(2):
        medallion.run(sample(spark), root, 1)
    assert read_silver(spark, f"{root}/silver").count() == 5
    assert spark.read.parquet(f"{root}/bronze").count() == 5


def test_a_second_batch_updates_and_inserts(spark, tmp_path):
    root = str(tmp_path)
    medallion.run(sample(spark), root, 1)
    good = json.loads(valid_rows(check(sample(spark), ARTICLE_EVENT), ARTICLE_EVENT).toJSON().first())
    changes = [{**good, "views": 1}, {**good, "article_id": "ART-NEW"}]
    events = spark.createDataFrame([(json.dumps(c),) for c in changes], "value string")
    summary, _ = medallion.run(events, root, 2)
    assert summary["bronze_count"] == 2
    views = {r["article_id"]: r["views"] for r in read_silver(spark, f"{root}/silver").collect()}
    assert len(views) == 6 and views[good["article_id"]] == 1 and "ART-NEW" in views
    assert views["ART-105"] == 3100


def test_failing_gate_halts_the_run(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(QualityGateError):
        medallion.run(sample(spark), root, 1, suite=(Expectation("between", "views", low=1000),))
    assert not (tmp_path / "gold").exists() and not (tmp_path / "index").exists()
    failed = {n for n, s in states(spark, root) if s == "FAIL"}
    assert failed == {"quality_gate", "article_run"}


def test_batch_without_any_valid_row(spark, tmp_path):
    events = spark.createDataFrame([("nope",)], "value string")
    with pytest.raises(QualityGateError) as error:
        medallion.run(events, str(tmp_path), 1)
    assert error.value.summary["status"] == "FAILED_EMPTY"


def test_landing_folder_of_an_empty_batch(spark, tmp_path):
    path = str(tmp_path / "landing")
    empty = spark.createDataFrame([], "value string")
    counts = write_split(check(empty, ARTICLE_EVENT), ARTICLE_EVENT, path)
    assert counts["total_processed"] == 0
    assert read_valid(spark, path, ARTICLE_EVENT).count() == 0
    assert read_quarantine(spark, path, ARTICLE_EVENT).count() == 0


def test_landing_folder_in_json(spark, tmp_path):
    path = str(tmp_path / "landing")
    write_split(check(sample(spark), ARTICLE_EVENT), ARTICLE_EVENT, path, fmt="json")
    assert read_valid(spark, path, ARTICLE_EVENT, fmt="json").count() == 5
    rejected = read_quarantine(spark, path, ARTICLE_EVENT, fmt="json").collect()
    assert sorted(r["failed_field"] for r in rejected) == ["category", "title", "views"]
    assert all(json.loads(r["raw_payload"])["article_id"].startswith("ART-BAD") for r in rejected)


def write_lines(spark, folder: str) -> None:
    sample(spark).select("value").repartition(3).write.mode("append").text(folder)


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    write_lines(spark, folder)

    def drain() -> None:
        stream_contract(stream_lines(spark, folder, max_files=1), ARTICLE_EVENT, out, checkpoint).awaitTermination()

    drain()
    batch = valid_rows(check(sample(spark), ARTICLE_EVENT), ARTICLE_EVENT)
    streamed = read_valid(spark, out, ARTICLE_EVENT)
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))
    assert read_quarantine(spark, out, ARTICLE_EVENT).count() == 3
    drain()  # nothing new
    assert read_valid(spark, out, ARTICLE_EVENT).count() == 5
    spark.createDataFrame([("broken {",)], "value string").write.mode("append").text(folder)
    drain()
    assert read_valid(spark, out, ARTICLE_EVENT).count() == 5
    assert read_quarantine(spark, out, ARTICLE_EVENT).where("failed_field = 'unknown'").count() == 1


def test_a_missing_connector_is_raised(spark, tmp_path):
    """Kafka is not installed: that is no failed delivery, and the rows stay in the landing folder."""
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    write_lines(spark, folder)
    stream = stream_contract(
        stream_lines(spark, folder), ARTICLE_EVENT, out, checkpoint, dead_letters=Settings()
    )
    with pytest.raises(StreamingQueryException):
        stream.awaitTermination()
    assert read_quarantine(spark, out, ARTICLE_EVENT).count() == 3
    with pytest.raises(AnalysisException):
        send_to_kafka(spark.range(1), "localhost:1", "topic")


def test_stream_fed_silver(spark, tmp_path):
    folder, silver, staging, checkpoint = (str(tmp_path / n) for n in ("in", "silver", "staging", "checkpoint"))
    for _ in range(2):
        write_lines(spark, folder)
        events = stream_lines(spark, folder, max_files=2)
        stream_silver(events, ARTICLE_EVENT, silver, staging, checkpoint).awaitTermination()
        assert read_silver(spark, silver).count() == 5


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert work_path(spark, "x") != work_path(spark, "x")


def test_spread_leaves_many_splits_alone(spark):
    slots = spark.sparkContext.defaultParallelism
    many = spark.range(0, 100, 1, slots * 2)
    assert spread(many) is many
    assert spread(spark.range(0, 100, 1, 1)).rdd.getNumPartitions() == slots


def test_array_files_are_split_like_text(spark, tmp_path):
    elements = [{"id": i, "t": 'a [x], {"q"} \\ é ' * (i % 7), "n": [1, {"z": []}], "e": None} for i in range(900)]
    elements += [1, "x, [", None, [1, 2], {}]
    texts = {
        "indented": json.dumps(elements, indent=2), "compact": json.dumps(elements), "empty": "[\n]\n", "blank": "\n",
        "object": json.dumps({"a": [1]}, indent=2),
    }
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for name, text in texts.items():
            (tmp_path / f"{name}.json").write_text(text)
            want = json.loads(text) if text.strip() else []
            want = want if isinstance(want, list) else [want]
            for size in ("128m", "20k"):
                spark.conf.set("spark.sql.files.maxPartitionBytes", size)
                rows = read_events(spark, str(tmp_path / f"{name}.json"), "array").collect()
                assert sorted(json.dumps(json.loads(r["value"])) for r in rows) == sorted(map(json.dumps, want)), (name, size)
                assert all(r["_source_file"].endswith(f"{name}.json") for r in rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_broken_array_is_quarantined(spark, tmp_path):
    (tmp_path / "broken.json").write_text('[\n {"a": 1},\n {"b": \n')
    rows = [r["value"] for r in read_events(spark, str(tmp_path / "broken.json"), "array").collect()]
    assert len(rows) == 2 and json.loads(rows[0]) == {"a": 1}
    checked = check(spark.createDataFrame([(r,) for r in rows], "value string"), ARTICLE_EVENT)
    assert checked.where("_errors[0].field = 'unknown'").count() == 1


def test_equal_rejects_get_ids_of_their_own(spark, tmp_path):
    events = spark.createDataFrame([("bad",)] * 500 + [("worse",)] * 3, "value string").repartition(3)
    for batch in (1, 2):
        medallion.ingest(events, ARTICLE_EVENT, medallion.Layout(str(tmp_path)), batch)
    ids = [r["quarantine_id"] for b in (1, 2) for r in read_quarantine(spark, f"{tmp_path}/landing/batch={b}", ARTICLE_EVENT).collect()]
    assert len(ids) == len(set(ids)) == 1006


def test_stream_fed_silver_keeps_its_rejects(spark, tmp_path):
    folder, silver, staging, checkpoint = (str(tmp_path / n) for n in ("in", "silver", "staging", "checkpoint"))
    write_lines(spark, folder)
    stream_silver(stream_lines(spark, folder, max_files=1), ARTICLE_EVENT, silver, staging, checkpoint).awaitTermination()
    assert quarantined(spark, ARTICLE_EVENT, staging).count() == 3


def versions(spark, **changes):
    good = json.loads(valid_rows(check(sample(spark), ARTICLE_EVENT), ARTICLE_EVENT).toJSON().first())
    return spark.createDataFrame([(json.dumps({**good, **c}),) for c in changes["rows"]], "value string")


def test_the_later_version_in_a_batch_wins(spark, tmp_path):
    rows = [{"title": "Zeta old", "published_timestamp": "2026-01-01T00:00:00Z"},
            {"title": "Alpha new", "published_timestamp": "2026-02-01T00:00:00Z"}]
    medallion.run(versions(spark, rows=rows), str(tmp_path), 1)
    assert [r["title"] for r in read_silver(spark, f"{tmp_path}/silver").collect()] == ["Alpha new"]


def test_a_replay_brings_no_old_row_back(spark, tmp_path):
    root = str(tmp_path)
    first, second = versions(spark, rows=[{}]), versions(spark, rows=[{"views": 7}])
    for events, batch in ((first, 1), (second, 2), (first, 1)):
        medallion.run(events, root, batch)
    assert [r["views"] for r in read_silver(spark, f"{root}/silver").collect()] == [7]


def test_gold_keeps_its_columns_and_versions(spark, tmp_path):
    root = str(tmp_path)
    medallion.run(sample(spark), root, 1)
    silver = read_silver(spark, f"{root}/silver")
    with pytest.raises(SchemaMismatchError):
        write_snapshot(silver.select("article_id"), f"{root}/gold/category_metrics", enforce=True)
    assert keyed(medallion.read_gold(spark, root, "category_metrics")) == CATEGORIES
    assert medallion.read_gold(spark, root, "daily_velocity").count() == 5
    assert medallion.read_gold(spark, root, "category_word_counts").count() == 4


def test_ids_and_winners_do_not_hang_on_the_splits(spark, tmp_path):
    """Lines read in one split or in many: the same quarantine ids, and the same row of a key wins."""
    bad, good = '{"title": "A"}', json.dumps(
        {"article_id": "X", "title": "Title", "author": "Someone", "category": "AI", "content": "some longer text",
         "views": 0, "rating": 1.0, "published_timestamp": "2026-08-01T10:00:00Z"}
    )
    lines = [bad if i % 4 else good.replace('"views": 0', f'"views": {i * 7919 % 401}') for i in range(400)]
    for part in range(2):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{part}.json").write_text("\n".join(lines[part * 200 : part * 200 + 200]) + "\n")
    found = {}
    for size in ("1024", "134217728"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0" if size == "1024" else "4194304")
        try:
            events = read_events(spark, str(tmp_path / "in"))
            rows = sorted((r["_source_file"], r["_source_row"], r["value"]) for r in events.collect())
            assert [r[1] for r in rows] == [*range(200)] * 2 and [r[2] for r in rows] == lines
            layout = medallion.Layout(str(tmp_path / f"run{size}"))
            medallion.ingest(events, ARTICLE_EVENT, layout, 1)
            ids = {r["quarantine_id"] for r in read_quarantine(spark, layout.landing(1), ARTICLE_EVENT).collect()}
            valid = read_valid(spark, layout.landing(1), ARTICLE_EVENT, with_source=True)
            medallion.load_bronze(valid, layout, 1, medallion.Settings())
            medallion.load_silver(spark, ARTICLE_EVENT, layout, 1, medallion.Settings())
            winner = [r["views"] for r in read_silver(spark, layout.at("silver")).collect()]
            found[size] = (events.rdd.getNumPartitions(), ids, winner)
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
    (many, ids, winner), (few, other_ids, other_winner) = found.values()
    assert many > few and len(ids) == 300 and ids == other_ids
    assert winner == other_winner == [396 * 7919 % 401]  # the last line of the last file
