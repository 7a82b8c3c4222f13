"""The registered queries of this package: one per operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rowtide.llm.common import table
from rowtide.llm.exact_dedup import exact_dedup
from rowtide.llm.main_text import extract_text
from rowtide.llm.manifest import siblings_digest, verify_rows
from rowtide.llm.metric_join import near_vectors
from rowtide.llm.mixing import mix
from rowtide.llm.near_dedup import near_groups
from rowtide.llm.packing import pack, public_codec
from rowtide.llm.quality import fit_quality, score_quality
from rowtide.llm.repeats import remove_repeats
from rowtide.llm.runs import periodic_runs
from rowtide.llm.toxicity import fit_toxicity, score_toxicity
from rowtide.llm.url_filter import judge_urls
from rowtide.llm.warc import page_columns, round_trip

# Rules of the url query: verdict, host, path.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op1_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_columns(round_trip(table(spark, sf_dir, "pages"))).drop("archive", "offset")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_codec(), with_ids=False)


def op3_deobfuscated_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = "crc32(CAST(doc_id AS STRING)) % 5"
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fitted = fit_toxicity(docs, table(spark, sf_dir, "labels"), learn=f"{fold} <> 0")
    return score_toxicity(docs, *fitted).selectExpr(
        "doc_id", f"coalesce({fold} = 0, FALSE) AS held_out", "score", "IF(score >= 0.5D, 1, 0) AS predicted"
    )


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_metric_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op6_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, RULES).select("page_id", "host", "path", "rule", "verdict")


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op8_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = "crc32(CAST(doc_id AS STRING)) % 4"
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(docs, table(spark, sf_dir, "labels"), learn=f"{fold} <> 2")
    return score_quality(docs, model).selectExpr(
        "doc_id", f"coalesce({fold} = 2, FALSE) AS held_out", "score", "IF(score >= 0.7D, 1, 0) AS predicted"
    )


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"), words=2)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = r"regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+', 0)"
    docs = table(spark, sf_dir, "documents").selectExpr("doc_id", "text", "crc32(CAST(doc_id AS STRING)) AS h")
    docs = docs.selectExpr("*", f"IF(h % 10 = 0, {split}, NULL) AS words").selectExpr("*", "size(words) AS n")
    docs = docs.selectExpr("*", "CAST((h DIV 10) % n AS INT) AS a").selectExpr("*", "CAST(1 + (n - a) DIV (3 + (h DIV 10) % 8) AS INT) AS p")
    planted = "IF(n > 0, array_join(transform(words, (w, i) -> IF(i < a, w, words[a + (i - a) % p])), ' '), text)"
    longest = "array_max(transform(runs, r -> struct(r.length AS length, -r.start AS start, -r.period AS period)))"
    return (
        periodic_runs(docs, planted)
        .selectExpr("*", f"{longest} AS top")
        .selectExpr(
            "doc_id", "CAST(size(runs) AS BIGINT) AS n_runs", "-top.start AS start", "top.length AS length", "-top.period AS period",
            "1000 * top.length DIV -top.period AS exponent_milli",
            "sha2(array_join(transform(runs, r -> concat_ws(',', r.start, r.length, concat(r.period, '\n'))), ''), 256) AS runs_sha256",
            "sha2(collapsed, 256) AS collapsed_sha256",
        )
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    tampered = {"text": f"IF(coalesce(crc32(CAST(doc_id AS STRING)) % 3 = 0, FALSE), {lower}, text)"}
    rows = verify_rows(table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], tampered)
    return rows.selectExpr(
        "doc_id", "leaf", "subroot", "root", f"{siblings_digest()} AS proof_sha256", "folded_root", "verified"
    )


def op13_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).selectExpr(
        "doc_id", "n_bytes", "aggregate(removed, 0L, (n, x) -> n + x.end - x.start) AS n_removed",
        "CAST(size(removed) AS BIGINT) AS n_spans", "sha2(kept, 256) AS kept_sha256",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_round_trip": op1_warc_round_trip,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_deobfuscated_toxicity": op3_deobfuscated_toxicity,
    "op4_source_mix": op4_source_mix,
    "op5_metric_join": op5_metric_join,
    "op6_url_reputation": op6_url_reputation,
    "op7_main_text": op7_main_text,
    "op8_compression_quality": op8_compression_quality,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_repeated_passages": op13_repeated_passages,
}
