"""The queries of the nine training-data problems, each over its whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qafila.llm import encode, leakage, names, neardup, pieces, pii, sample, splits, unify
from qafila.runtime import table

SHARE = 0.1


def _p1_sample(spark: SparkSession, d: str) -> DataFrame:
    """Two loads into one registry: the earlier half of the loading time, then all records, those known among them."""
    records = table(spark, d, "poem_records")
    at = F.col("loaded_at").cast("timestamp").cast("double")
    span = records.agg(F.min(at).alias("a"), F.max(at).alias("b")).first()
    loads = [records.filter(at <= F.lit((span.a + span.b) / 2)), records] if span.a is not None else [records]
    return sample.growing_sample(loads, SHARE).select("sample_id", F.round("prn", 9).alias("prn"))


def _p2_found(spark: SparkSession, d: str) -> DataFrame:
    return neardup.near_duplicate_pairs(table(spark, d, "poem_records"))


def _p2_groups(spark: SparkSession, d: str) -> DataFrame:
    return neardup.near_duplicate_groups(table(spark, d, "poem_records"))


def _p2_sources(spark: SparkSession, d: str) -> DataFrame:
    records = table(spark, d, "poem_records")
    return neardup.group_sources(records, neardup.near_duplicate_groups(records))


def _p3_found(spark: SparkSession, d: str) -> DataFrame:
    return names.same_person_pairs(table(spark, d, "poet_names"), table(spark, d, "given_names"))


def _p3_persons(spark: SparkSession, d: str) -> DataFrame:
    return names.link_names(table(spark, d, "poet_names"), table(spark, d, "given_names"))


def _p4_found(spark: SparkSession, d: str) -> DataFrame:
    return pieces.oversized_ids(table(spark, d, "poem_records"), table(spark, d, "generation_settings"))


def _p4_pieces(spark: SparkSession, d: str) -> DataFrame:
    return pieces.cut_records(table(spark, d, "poem_records"), table(spark, d, "generation_settings"))


def _tables5(spark: SparkSession, d: str) -> list[DataFrame]:
    return [table(spark, d, t) for t in ("mcq_items", "poem_records", "poet_names", "given_names")]


def _p5_found(spark: SparkSession, d: str) -> DataFrame:
    return splits.poet_groups(*_tables5(spark, d))


def _p5_splits(spark: SparkSession, d: str) -> DataFrame:
    return splits.split_items(*_tables5(spark, d))


def _p6_found(spark: SparkSession, d: str) -> DataFrame:
    return unify.unify_values(table(spark, d, "poem_records")).select("record_no", "field", "item_no")


def _p6_records(spark: SparkSession, d: str) -> DataFrame:
    return unify.unify_records(table(spark, d, "poem_records"))


def _p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode.corpus_ids(table(spark, d, "documents"))


def _p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked_items(table(spark, d, "documents"), table(spark, d, "eval_items"))


def _p9_found(spark: SparkSession, d: str) -> DataFrame:
    return pii.find_details(table(spark, d, "documents"), credits=table(spark, d, "poet_names"), given_names=table(spark, d, "given_names"))


def _p9_redacted(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return pii.redact(docs, credits=table(spark, d, "poet_names"), given_names=table(spark, d, "given_names")).select("doc_id", "redacted")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p1_sample": _p1_sample,
        "p2_found": _p2_found,
        "p2_groups": _p2_groups,
        "p2_sources": _p2_sources,
        "p3_found": _p3_found,
        "p3_persons": _p3_persons,
        "p4_found": _p4_found,
        "p4_pieces": _p4_pieces,
        "p5_found": _p5_found,
        "p5_splits": _p5_splits,
        "p6_found": _p6_found,
        "p6_records": _p6_records,
        "p7_ids": _p7_ids,
        "p8_found": _p8_found,
        "p9_found": _p9_found,
        "p9_redacted": _p9_redacted,
    }


def oracle_sql() -> dict[str, str]:
    """SQL where it can express the operator on whole tables; the rest is tested in tests/llm."""
    prn = f"CAST(('0x' || substr(sha256('{sample.SEED}:' || sample_id), 1, 13)) AS BIGINT) / 4503599627370496.0"
    return {
        "p1_sample": f"""
            SELECT sample_id, round(prn, 9) AS prn
            FROM (SELECT DISTINCT sample_id, {prn} AS prn FROM poem_records WHERE sample_id IS NOT NULL)
            WHERE prn < {SHARE}""",
        "p4_found": """
            WITH texts AS (
              SELECT DISTINCT sample_id, array_to_string(list_transform(range(0, CAST(len(verses) AS BIGINT), 2),
                lambda i: coalesce(verses[i + 1], '') || CASE WHEN i + 2 <= len(verses) THEN ' = ' || coalesce(verses[i + 2], '') ELSE '' END), chr(10)) AS t
              FROM poem_records WHERE len(verses) > 0)
            SELECT DISTINCT sample_id, settings_id FROM texts, generation_settings WHERE length(t) > max_source_chars""",
    }
