"""What building an index shuffles and stores."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators.chunks import ORDER
from strata.operators.postings import with_places
from strata.plans.retrieval import open_index
from strata.sources.buckets import laid_out
from strata.sources.versions import published
from tests.test_postings import indexed, texts_of


def test_places_take_one_shuffle(spark):
    rows = spark.range(500).selectExpr("concat('D', id % 50) AS doc_id", "cast(id AS int) AS chunk_index", "concat('C', id) AS chunk_id")
    placed = with_places(laid_out(rows, 4, {0: 9, 1: 900, 2: 9, 3: 9}, 300, "doc_id", "chunk_id"))
    assert placed._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    groups: dict = {}
    for r in placed.collect():
        groups.setdefault((r["_bucket"], r["_share"]), []).append((r["_place"], *(r[c] for c in ORDER)))
    assert sum(map(len, groups.values())) == 500 and len(groups) == 6
    for found in groups.values():
        found.sort()
        assert [f[0] for f in found] == list(range(len(found)))
        assert [f[1:] for f in found] == sorted(f[1:] for f in found)


def test_tokens_are_not_stored(spark, tmp_path):
    index = indexed(spark, tmp_path / "index", texts_of(40))
    manifest = published(spark, str(tmp_path / "index"))[1]
    assert "tokens" not in [f["name"] for f in manifest["schema"]["fields"]]
    assert open_index(spark, str(tmp_path / "index")).chunks.where(F.size("tokens") > 0).count() > 0
    assert index.chunks.count() == 40
