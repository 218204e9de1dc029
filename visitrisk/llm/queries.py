"""Registered queries of the subpackage, each over its whole table, and the SQL that some must equal."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitrisk.llm import alignment, chat, decontam, langid, linededup, oracles, packing, periodic, quality, simhash, suffixdedup, toxicity, urlfilter, warc
from visitrisk.scratch import application_folder

#: Host, path and verdict of the registered URL filter.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]

#: Vocabulary files of the alignment query.
VOCABULARIES = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"

#: The conversation that the chat query adds.
ADDED_ID, ADDED_TEXT = -7, "</s>[INST] ok [/INST]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(folds: int) -> Column:
    """crc32 of the document id as text, modulo ``folds``."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds))


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(fold(3) != 1)
    out = toxicity.score(docs, toxicity.fit(docs, labels), texts=False)
    held_out = F.coalesce(fold(3) == 1, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "score", "predicted", "n_sentences", F.to_json("sentences").alias("sentences"))


def decontaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"), texts=False)


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly")


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = langid.predict(docs.select("doc_id", "text"), langid.fit(docs.filter(fold(4) != 2)), texts=False)
    return out.select("doc_id", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "known")


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"), RULES).select("page_id", "host", "path", "rule", "verdict")


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def warc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.archived(table(spark, sf_dir, "pages"), application_folder(spark, "llm"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(F.lit(ADDED_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(ADDED_TEXT).alias("text"))
    return chat.read_back(chat.format_chats(turns.unionByName(added))).drop("valid")


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of every tenth document, by crc32 of its id, repeat from one word on."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % period] for i in range(n - a)]


def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = periodic.find_runs(table(spark, sf_dir, "documents").select("doc_id", "text"), prepare=planted)
    # The greatest length, then the smallest start and period.
    top = F.array_max(F.transform("runs", lambda r: F.struct(r.length, (-r.start).alias("start"), (-r.period).alias("period"))))
    every = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period)), "\n")
    every = F.when(F.size("runs") > 0, F.concat(every, F.lit("\n"))).otherwise("")
    rows = rows.withColumns({"top": top, "every": every})
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("top.start")).alias("start"),
        "top.length",
        (-F.col("top.period")).alias("period"),
        F.expr("1000 * top.length div -top.period").alias("exponent_milli"),
        F.sha2("every", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = alignment.align(table(spark, sf_dir, "documents").select("doc_id", "text"), *VOCABULARIES, texts=False)
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffixdedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": toxicity_scores,
        "op2_decontamination": decontaminated,
        "op3_quality": quality_rules,
        "op4_simhash": near_duplicates,
        "op5_language": languages,
        "op6_line_dedup": line_dedup,
        "op7_url_filter": url_verdicts,
        "op8_packing": packed,
        "op9_warc": warc_records,
        "op10_chat": chats,
        "op11_periodic_runs": periodic_runs,
        "op12_alignment": alignments,
        "op13_suffix_dedup": suffix_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_decontamination": oracles.decontamination(),
        "op6_line_dedup": oracles.line_dedup(linededup.MIN_WORDS),
        "op7_url_filter": oracles.url_filter(RULES),
        "op9_warc": oracles.warc(),
        "op10_chat": oracles.chat(ADDED_ID, ADDED_TEXT),
        "op11_periodic_runs": oracles.runs(periodic.MIN_LENGTH),
        "op13_suffix_dedup": oracles.suffix_dedup(suffixdedup.THRESHOLD),
    }
