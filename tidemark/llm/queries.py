"""The registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    byte_bpe,
    fill_in_middle,
    licences,
    mixing,
    near_duplicates,
    nearest,
    passages,
    periodic_runs,
    personal_data,
    quality,
    repetition,
    sharding,
    url_lists,
)
from tidemark.llm.oracles import (
    FILL_SQL,
    LICENCE_SQL,
    NEAREST_SQL,
    PASSAGE_SQL,
    REPETITION_SQL,
    RUNS_SQL,
    URL_SQL,
)

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(table(spark, sf_dir, "documents"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


def url_history(pages: DataFrame) -> DataFrame:
    """A dated list for the hosts, parent domains and paths of up to three parts that the
    pages have: three entries for each, whose instants and actions follow from the pattern's
    MD5. Half of the entries are written as a URL: upper-case host, port, slash at the end."""
    patterns = pages.select(F.explode(url_lists.patterns_of(F.col("url"), depth=3)).alias("pattern")).distinct()
    turn = patterns.select("pattern", F.explode(F.array(*map(F.lit, range(3)))).alias("turn"))
    digest = F.md5(F.concat_ws("#", "pattern", "turn"))

    def drawn(first: int, count: int, below: int) -> Column:
        return (F.conv(F.substring(digest, first, count), 16, 10).cast("int") % below).cast("int")

    host = F.substring_index("pattern", "/", 1)
    written_out = F.concat(F.lit("HTTPS://"), F.upper(host), F.lit(":443"), F.expr("substring(pattern, length(substring_index(pattern, '/', 1)) + 1)"), F.lit("/"))
    return turn.select(
        F.when(drawn(8, 1, 2) == 1, written_out).otherwise(F.col("pattern")).alias("pattern"),
        F.element_at(F.array(F.lit("block"), F.lit("allow"), F.lit("remove")), drawn(7, 1, 3) + 1).alias("action"),
        _instant(drawn(1, 6, 400), drawn(9, 4, 24)).alias("listed_on"),
    )


def _instant(days: Column, hours: Column) -> Column:
    """So many days and hours after the start of 2024."""
    start = F.lit("2024-01-01").cast("timestamp")
    return start + F.make_dt_interval(days, hours)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    fetched = _instant((F.col("page_id") * 37 % 400).cast("int"), (F.col("page_id") % 24).cast("int"))
    captures = pages.select("page_id", "url", fetched.alias("fetched_at"))
    found = url_lists.filter_captures(captures, url_history(pages), fetched="fetched_at")
    return found.withColumn("fetched_at", F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return repetition.judge_repetition(documents).drop("text")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, own = personal_data.BASE_KINDS, personal_data.KINDS[len(personal_data.BASE_KINDS) :]
    outputs = (*(f"n_{kind}" for kind in base), "base_sha256", "spans", *(f"n_{kind}" for kind in own))
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return personal_data.find_personal_data(documents, outputs=outputs).drop("text")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.weigh_quality(documents, labels).drop("digest")


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    found = nearest.nearest(vectors, vectors.where("vec_id % 100 = 0"))
    return found.withColumnRenamed("id", "vec_id")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_bpe.encode_texts(
        documents,
        public_tokenizers.path(VOCABULARY),
        public_tokenizers.PATTERN,
        outputs=("n_tokens", "ids_sha256", "decoded_sha256"),
    ).drop("text")


def planted(documents: DataFrame) -> DataFrame:
    """``documents`` with a run in one text of ten: from a word on, a stretch of the text
    again and again. Which texts, where and how long follows from the id's checksum."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeating(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        unit = F.slice(words, a + 1, p)
        times = F.ceil((n - a) / p).cast("int")
        tail = F.slice(F.flatten(F.array_repeat(unit, times)), F.lit(1), n - a)
        return F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")

    # An array of one, so that the words are taken once.
    words = F.array(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    made = F.transform(words, lambda w: F.when(F.size(w) > 0, repeating(w)))[0]
    text = F.when(h % 10 == 0, F.coalesce(made, F.col("text"))).otherwise(F.col("text"))
    return documents.select("doc_id", text.alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(planted(table(spark, sf_dir, "documents")), digest=True)
    fuller = F.expr(
        "array_sort(runs, (x, y) -> CASE WHEN x.length * y.period <> y.length * x.period "
        "THEN sign(y.length * x.period - x.length * y.period) WHEN x.start <> y.start "
        "THEN sign(x.start - y.start) ELSE sign(x.period - y.period) END::int)"
    )
    best = F.get(fuller, F.lit(0))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(F.col("id").alias("doc_id"), "runs", "collapsed", best.alias("best"), lines.alias("lines")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join("lines", "").cast("binary"), 256).alias("runs_sha256"),
        F.col("collapsed").alias("collapsed_sha256"),
    )


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    again = fill_in_middle.restored(F.col("output"), F.col("form"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(again.cast("binary"), 256).alias("restored_sha256"),
    )


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.size("near_items").cast("long").alias("n_near_items"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_license_scan,
        op2_near_duplicates,
        op3_url_filter,
        op4_quality_rules,
        op5_sharding,
        op6_personal_data,
        op7_mixing,
        op8_quality_classifier,
        op9_nearest,
        op10_byte_bpe,
        op11_periodic_runs,
        op12_fill_in_middle,
        op13_decontamination,
        pipeline,
    )
}
SQL: dict[str, str] = {
    "op1_license_scan": LICENCE_SQL,
    "op3_url_filter": URL_SQL,
    "op4_quality_rules": REPETITION_SQL,
    "op9_nearest": NEAREST_SQL,
    "op11_periodic_runs": RUNS_SQL,
    "op12_fill_in_middle": FILL_SQL,
    "op13_decontamination": PASSAGE_SQL,
}
