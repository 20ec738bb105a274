"""The registered queries of the text operators, over the whole given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from strata.llm import ann, bpe, langid, line_dedup, manifest, minhash, packing, pieces, pii, quality, resample, secrets, urls
from strata.llm.common import PREFIX, table


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = pieces.sampled_with_check(docs, "doc_id", "text")
    pieces_found, lossless = F.col(f"{PREFIX}pieces"), F.col(f"{PREFIX}lossless")
    return coded.select(
        "doc_id",
        F.size(pieces_found).cast("long").alias("n_pieces"),
        F.hash(pieces_found).alias("pieces_hash"),
        lossless.alias("lossless"),
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = line_dedup.apply_bitmaps(docs, line_dedup.line_bitmaps(docs))
    lines = F.col(f"{PREFIX}lines")
    return cut.select(
        "doc_id",
        lines["n_lines"].alias("n_lines"),
        lines["n_dropped"].alias("n_dropped"),
        F.sha2(F.coalesce(lines["text"], F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )

# The rules of the URL query.
URL_RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find_secrets(docs, table=secrets.train(secrets.labelled_samples(docs)))
    base = F.col(f"{PREFIX}base")

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in secrets.KINDS[:3]],
        F.sha2(secrets.digest(base).cast("binary"), 256).alias("base_sha256"),
        secrets.digest(F.col(f"{PREFIX}spans")).alias("spans"),
    )


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return pages.withColumn("found", urls.judged(pages["url"], URL_RULES)).select("page_id", "found.*")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality(table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return found.select("doc_id", *[F.col(f"{PREFIX}quality.{name}").alias(name) for name in names])


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
    found = docs.withColumn("found", langid.predicted(docs, docs["text"], model))
    return found.select(
        "doc_id",
        langid.held_out(F.col("doc_id")).alias("held_out"),
        F.col("found.lang").alias("lang_pred"),
        F.col("found.score").alias("score"),
        F.col("found.rejected").alias("rejected"),
    )


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_duplicates(docs, settings=minhash.MinHashSettings(words=4))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in pii.KINDS],
        F.sha2(pii.digest(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        pii.digest(F.col("spans")).alias("spans"),
    )


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"))
    ids, text = F.col(f"{PREFIX}coded.ids"), F.col(f"{PREFIX}coded.text")
    return coded.select(
        "doc_id",
        F.floor(F.octet_length(ids) / 4).cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2(text.cast("binary"), 256).alias("decoded_sha256"),
    )


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    drawn = resample.resample(docs, table(spark, sf_dir, "benchmark"))
    names = ("n_features", "weight", "score", "rank")
    return drawn.select("doc_id", *[F.col(f"{PREFIX}{name}").alias(name) for name in names])


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 5 == 0
    return manifest.manifest(docs, tampered).drop("copied").withColumnRenamed("id", "doc_id")
