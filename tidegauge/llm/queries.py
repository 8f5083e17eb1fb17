"""The queries of this package."""

from pyspark.sql import functions as F

from tidegauge.llm import (
    fingerprints, htmltext, licences, mixing, neardup, oracle, packing, pieces, quality, runs, sharding,
    spandedup, warc, whitening)
from tidegauge.session import scratch_dir


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_licences(spark, sf_dir):
    """Documents as the files of a tree: source, language, thousands of ids."""
    part = F.concat(F.coalesce("source", F.lit("none")), F.lit("/"), F.coalesce(
        "lang", F.lit("none")), F.lit("/"), F.coalesce(F.floor(F.col("doc_id") / 1000).cast(
            "string"), F.lit("none")), F.lit("/"))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))
    files = _table(spark, sf_dir, "documents").select(
        F.concat(part, name, F.lit(".txt")).alias("path"), "text")
    found = licences.scan(files, declares="first")
    number = F.regexp_extract("path", r"/(-?\d+)\.txt$", 1)
    return found.select(F.when(number != "", number.cast("long")).alias("doc_id"), "*")


def op2_warc(spark, sf_dir):
    folder = scratch_dir(spark, "warc")
    warc.write_archive(_table(spark, sf_dir, "pages"), folder)
    parsed = warc.parse_header(warc.read_archive(spark, folder))
    return parsed.select(
        F.col("id").alias("page_id"), F.octet_length("payload").cast("long").alias(
            "payload_bytes"), F.sha2("payload", 256).alias("payload_digest"),
        F.col("type").alias("record_type"), "refers_to")


def op3_quality_rules(spark, sf_dir):
    return quality.score(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "p_good")


def op4_fingerprints(spark, sf_dir):
    return fingerprints.pairs_with_next(_table(spark, sf_dir, "documents"))


def op5_main_text(spark, sf_dir):
    return htmltext.extract(_table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", "n_chars")


def op6_near_duplicates(spark, sf_dir):
    return neardup.classes(_table(spark, sf_dir, "documents"))


def op7_mixing(spark, sf_dir):
    return mixing.mix(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op8_suffix_dedup(spark, sf_dir):
    return spandedup.remove_repeats(_table(spark, sf_dir, "documents"))


def op9_sharding(spark, sf_dir):
    assigned = sharding.shard_documents(_table(spark, sf_dir, "documents"), 16,
                                        scratch_dir(spark, "shard-maps"))
    return assigned.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                           "slot", F.lit(None).cast("int").alias("grown_shard"), "vslot")


def op10_sentencepiece(spark, sf_dir):
    return pieces.encode_documents(_table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    text = runs.made_periodic(F.col("doc_id").cast("string"), F.col("text"))
    return runs.digests(runs.find_runs(docs.select("doc_id", text.alias("text"))))


def op12_packing(spark, sf_dir):
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op13_whitening(spark, sf_dir):
    return whitening.long_form(_table(spark, sf_dir, "embeddings"))


def queries():
    return {f.__name__: f for f in (
        op1_licences, op2_warc, op3_quality_rules, op4_fingerprints, op5_main_text, op6_near_duplicates, op7_mixing,
        op8_suffix_dedup, op9_sharding, op10_sentencepiece, op11_periodic_runs, op12_packing, op13_whitening)}


def oracle_sql():
    return oracle.oracle_sql()
