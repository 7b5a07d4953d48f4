"""The registered queries of this subpackage, each over the whole of its tables, and their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.llm import (
    chat_format,
    decontaminate,
    feistel_sharding,
    fill_in_middle,
    filter_audit,
    language_crf,
    license_scan,
    line_quality,
    mixing,
    quality_neighbours,
    secret_crf,
    simhash_dedup,
    token_counts,
)
from ridelake.llm.common import held_out, table

#: A record's score from which it counts as good.
LEAST_QUALITY = 0.3
_PROBE = "</s>[INST] ok [/INST]"


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"), spark)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_neighbours.fit_labels(docs, table(spark, sf_dir, "labels"))
    scores = quality_neighbours.quality_scores(docs, model, spark)
    predicted = (F.col("score") >= LEAST_QUALITY).cast("int").alias("predicted")
    return scores.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.taken(table(spark, sf_dir, "documents"), spark)
    return taken.select("doc_id", "size", "source_size", "target", "taken")


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["conv_id", "turn", "role", "text"]
    probe = spark.sql(f"SELECT * FROM VALUES (-7L, 0L, 'user', '{_PROBE}'), (-7L, 1L, 'assistant', '{_PROBE}')").toDF(*columns)
    rows = table(spark, sf_dir, "conversations").select(*columns).unionByName(probe)
    return chat_format.digests(chat_format.formatted(rows))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_crf.languages(docs, language_crf.fit_documents(docs), spark)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secret_crf.secrets(docs, secret_crf.fit_documents(docs), spark)


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), spark)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.quality_rules(table(spark, sf_dir, "documents"), count_copies=True)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary())


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    hexadecimal = F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint")
    return found.select("doc_id", hexadecimal, "component_id")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = feistel_sharding.sharded(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_license_scan,
        op2_quality_classifier,
        op3_mixing,
        op4_chat_format,
        op5_language_id,
        op6_secret_scan,
        op7_benchmark_decontamination,
        op8_quality_rules,
        op9_token_counts,
        op10_simhash_dedup,
        op11_filter_audit,
        op12_sharding,
        op13_fill_in_middle,
    )
}

_CHAT = chat_format.CHAT
_RESTS = "|".join(sorted({control[1:].replace("[", r"\[").replace("]", r"\]").replace("|", r"\|") for control in _CHAT.controls}))
_MARKS = sum(map(len, (_CHAT.open, _CHAT.middle, _CHAT.close)))

ORACLES = {
    "op1_license_scan": license_scan.oracle(),
    "op8_quality_rules": line_quality.oracle(),
    "op11_filter_audit": filter_audit.oracle(),
    "op13_fill_in_middle": fill_in_middle.oracle(),
    "op4_chat_format": f"""
        WITH rows AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL VALUES (-7, 0, 'user', '{_PROBE}'), (-7, 1, 'assistant', '{_PROBE}')
        ),
        placed AS (
          SELECT *, row_number() OVER turns - 1 AS place, lag(role, 1, 'start') OVER turns AS before,
            len(regexp_extract_all(text, '[<\\[]\\\\*(?:{_RESTS})')) AS escapes
          FROM rows WINDOW turns AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
        )
        SELECT conv_id, count(*) AS n_turns,
          sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
          CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
          sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
          CAST(sum({_MARKS} + length(role) + length(text) + escapes) AS BIGINT) AS formatted_chars,
          bool_and({" OR ".join(f"(before = '{a}' AND role = '{b}')" for a, b in _CHAT.moves)})
            AND arg_max(role, place) = 'assistant' AS valid,
          CAST(min(place) FILTER (WHERE NOT ({" OR ".join(f"(before = '{a}' AND role = '{b}')" for a, b in _CHAT.moves)})) AS INTEGER)
            AS first_error
        FROM placed GROUP BY conv_id""",
}
