"""Registered queries of this subpackage and their DuckDB SQL."""

import os
import zlib

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkloom.llm import (
    decontaminate, extract, fingerprints, licenses, near_dedup, oracles, pieces, pii, quality, runs, secrets, substrings, url_filter, variants,
)
from sparkloom.llm.common import let, split_words, table


def piece_model() -> str:
    """File of the merge-type piece model; ``PIECE_MODEL`` names another one."""
    return os.environ.get("PIECE_MODEL") or public_tokenizers.path("piece_bpe_32k.model")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.repeated_spans(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_words", removed.alias("n_removed"), "kept_sha256")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(table(spark, sf_dir, "documents")).drop("found")


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(table(spark, sf_dir, "documents"), piece_model(), keep_ids=False)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    field = pii.trained(pii.labelled_table(spark))
    return pii.personal_data(table(spark, sf_dir, "documents"), field).drop("found")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_notices(table(spark, sf_dir, "documents"))


def op9_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.page_texts(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def listed_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs of pages whose path ends in the id of a document labelled toxic."""
    pages = table(spark, sf_dir, "pages").select("url")
    toxic = table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id").distinct()
    document = F.regexp_extract(url_filter.path_of(F.col("url")), r"/([0-9]+)(\.html)?/*$", 1).try_cast("bigint")
    return pages.join(toxic, document == F.col("doc_id"), "left_semi")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge_urls(table(spark, sf_dir, "pages"), listed_urls(spark, sf_dir))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def with_loops(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` where one text in ten goes on from a word chosen by its id by repeating the words there."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def looped(words: Column) -> Column:
        n = F.size(words)
        first = g % n
        period = 1 + F.floor((n - first) / (3 + g % 8))
        at = F.struct(first.cast("int").alias("first"), period.cast("int").alias("period"))
        return let(at, lambda a: F.transform(words, lambda w, i: F.when(i < a["first"], w).otherwise(F.get(words, a["first"] + (i - a["first"]) % a["period"]))))

    words = split_words(F.col("text"))
    chosen = (h % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return docs.select("doc_id", F.when(chosen, F.array_join(let(words, looped), " ")).otherwise(F.col("text")).alias("text"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(with_loops(table(spark, sf_dir, "documents")))
    # Quotients of whole numbers below 2^26 are equal as doubles only if they are equal.
    ranked = F.transform("runs", lambda r: F.struct(r["length"] / r["period"], -r["start"], -r["period"], r["length"].alias("length"), r["start"].alias("start"), r["period"].alias("period")))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumns({"best": F.array_max(ranked), "n_runs": F.size("runs").cast("bigint")})
    return found.select(
        "doc_id",
        "n_runs",
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def one_letter_lost(doc_id: int | None, word: bytes) -> bytes:
    """The word, or without one letter where a checksum of document and word says so; a null id changes nothing."""
    h = 1 if doc_id is None else zlib.crc32(word, zlib.crc32(b"%d:" % doc_id))
    if h % 31:
        return word
    letters = word.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(variants.letter_runs(table(spark, sf_dir, "documents"), alter=one_letter_lost))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = fingerprints.edited_by_next(table(spark, sf_dir, "documents"))
    pairs = pairs.select("doc_id", "n_chars", "text", "edited", F.sha2("edited", 256).alias("edited_sha256"), "next_sketch")
    own, edited = fingerprints.sketch(F.col("text")), fingerprints.sketch(F.col("edited"))
    pairs = pairs.withColumns({"own": own, "changed": edited}).drop("text", "edited")
    return pairs.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.array_join("own", "").alias("fingerprint"),
        F.array_join("changed", "").alias("edited_fingerprint"),
        fingerprints.resemblance(F.col("own"), F.col("changed")).alias("near_edited"),
        fingerprints.resemblance(F.col("own"), F.col("next_sketch")).alias("near_next"),
    )


QUERIES = {
    "op1_near_dedup": op1_near_dedup,
    "op2_quality": op2_quality,
    "op3_substrings": op3_substrings,
    "op4_secrets": op4_secrets,
    "op5_pieces": op5_pieces,
    "op6_pii": op6_pii,
    "op7_decontaminate": op7_decontaminate,
    "op8_licenses": op8_licenses,
    "op9_extract": op9_extract,
    "op10_url_filter": op10_url_filter,
    "op11_runs": op11_runs,
    "op12_variants": op12_variants,
    "op13_fingerprints": op13_fingerprints,
}

ORACLES = {
    "op1_near_dedup": oracles.NEAR_DEDUP,
    "op2_quality": oracles.QUALITY,
    "op3_substrings": oracles.SUBSTRINGS,
    "op7_decontaminate": oracles.DECONTAMINATE,
    "op10_url_filter": oracles.URL_FILTER,
    "op11_runs": oracles.RUNS,
    "op12_variants": oracles.VARIANTS,
    "op13_fingerprints": oracles.FINGERPRINTS,
}
