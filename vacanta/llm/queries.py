"""The queries of this subpackage: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacanta.llm import (
    byte_cnn,
    centroids,
    decontaminate,
    lexical_search,
    license_scan,
    line_dedup,
    minhash,
    mixing,
    quality_rules,
    sharding,
    token_files,
    toxicity,
    url_filter,
)
from vacanta.llm.common import held_out, read

SHARDS = 40


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard; equal texts are one key of the ring."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = read(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(text).alias("key"),
    )
    sharded = sharding.assign_shards(rows, F.col("key"), F.col("doc_id"), SHARDS)
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL: the rule's, else the regression's."""
    judged = url_filter.judge(read(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "logit")


def _judged(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; 1 from a half up."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return _judged(toxicity.score(docs, model), 0.5)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    judged = quality_rules.apply_rules(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_stop_words", "n_lines", "n_capitals",
    )


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the token files and its ids' checksum, read back."""
    files = token_files.write_tokens(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return token_files.read_tokens(spark, files)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document; equal rows are one row."""
    mixture = mixing.mix(read(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    sources = spark.createDataFrame(
        [(s.number, s.words, s.target) for s in mixture.sources],
        "source_no int, source_size long, target double",
    )
    taken = F.col("size") * (F.size("shards") * F.col("times") + F.col("extra")) + F.col("part")
    return mixture.rows.join(F.broadcast(sources), "source_no").select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", taken.cast("long").alias("taken"),
        F.col("times").alias("n_rows"),
    )


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates of three-word shingles, 85 per cent alike."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_duplicates(docs, minhash.Likeness(words=3, percent=85))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses that every document names."""
    found = license_scan.scan_licenses(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, with the item they hold most of."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.mark_leaks(docs, read(spark, sf_dir, "benchmark"))


def op10_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; 1 from 0.3 up."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    net = byte_cnn.train_on(docs, read(spark, sf_dir, "labels"))
    return _judged(byte_cnn.score(docs, net), 0.3)


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every whole vector after three rounds, and the inertias."""
    vectors = centroids.integer_vectors(read(spark, sf_dir, "embeddings"))
    clustered = centroids.with_inertia(*centroids.cluster(vectors))
    return clustered.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines, those dropped, and the checksum of what is kept."""
    kept = line_dedup.dedupe_lines(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents that score highest for every benchmark item."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical_search.search(docs, read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_url_filter": op2_url_filter,
    "op3_toxicity": op3_toxicity,
    "op4_quality_rules": op4_quality_rules,
    "op5_token_files": op5_token_files,
    "op6_mixing": op6_mixing,
    "op7_minhash": op7_minhash,
    "op8_license_scan": op8_license_scan,
    "op9_decontaminate": op9_decontaminate,
    "op10_byte_cnn": op10_byte_cnn,
    "op11_centroids": op11_centroids,
    "op12_line_dedup": op12_line_dedup,
    "op13_lexical_search": op13_lexical_search,
}

ORACLES: dict[str, str] = {
    "op2_url_filter": url_filter.oracle(),
    "op4_quality_rules": quality_rules.oracle(),
    "op11_centroids": centroids.oracle(),
    "op12_line_dedup": line_dedup.oracle(),
    "op13_lexical_search": lexical_search.oracle(),
}
