"""Canonical poems and curation over poem_source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qafila.functions import text as X
from qafila.operators import canonical as C
from qafila.operators import curation as U
from qafila.runtime import scratch_path, table
from qafila.sources import files

PLACE = "حصن الرمان"
#: Terms of the biography search; the poets' verses stand in for biographies, as poem_source has none.
TERMS = ["في", "عن", "بين", "مزحون", "برذها", "الدريث"]


def source(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "poem_source")


def poems(spark: SparkSession, d: str) -> DataFrame:
    return C.canonicalize(source(spark, d), on_tie="flag", on_invalid="drop", on_meter="flag")


def lean_poems(spark: SparkSession, d: str) -> DataFrame:
    """Without the arrays of sources."""
    return C.canonicalize(source(spark, d), on_tie="flag", on_invalid="drop", on_meter="flag", arrays=False)


def _texts(df: DataFrame) -> DataFrame:
    return df.withColumn("body", F.when(F.size("poem_verses") > 0, F.array_join("poem_verses", " ")))


def canonical_poems(spark, d):
    return poems(spark, d).select(
        "sample_id", F.array_join(F.transform("source_row_indices", lambda x: x.cast("string")), ",").alias("rows"), F.array_join("source_urls", "|").alias("urls"),
        "poet_name", "poem_title", "poem_theme", "meter_id", "meter_name", "metadata_conflict", "tied",
        X.couplet_count(F.col("verses")).alias("couplet_count"), X.sft_split(F.col("sample_id")).alias("sft_split"),
    )


def source_order(spark, d):
    ordered = lean_poems(spark, d).select("sample_id", "first_row")
    return ordered.orderBy("first_row")


def invalid_rows(spark, d):
    return C.invalid_rows(source(spark, d))


def meter_votes(spark, d):
    rows = C.valid_rows(source(spark, d), "drop")
    return C.meter_votes(rows).select(X.poem_hash(F.col("verses")).alias("sample_id"), F.col("poem_meter").cast("int").alias("meter_id"), "votes")


def meter_conflicts(spark, d):
    return lean_poems(spark, d).filter("metadata_conflict").select("sample_id", "meter_id", "tied")


def source_provenance(spark, d):
    return poems(spark, d).select("sample_id", F.size("source_row_indices").cast("bigint").alias("n_rows"), F.size("source_urls").cast("bigint").alias("n_urls"))


def poem_sources(spark, d):
    """Every source row of every poem, as rows."""
    return C.sources(source(spark, d), "drop")


def split_counts(spark, d):
    return lean_poems(spark, d).groupBy(X.sft_split(F.col("sample_id")).alias("sft_split")).agg(F.count("*").alias("n"))


def poem_text_digest(spark, d):
    return lean_poems(spark, d).select("sample_id", F.sha2(X.format_poem(F.col("verses")), 256).alias("digest"), F.length(X.format_poem(F.col("verses"))).cast("bigint").alias("n_chars"))


def projected_scan(spark, d):
    return source(spark, d).select("row_idx", "poem_title", "poem_theme", "poem_meter", F.array_size("poem_verses").cast("bigint").alias("n_verses"), "poem_url", "poet_name")


def classical_subset(spark, d):
    return source(spark, d).filter(U.is_classical()).select("row_idx", "poet_name", "poet_era", "poem_language_type")


def classical_summary(spark, d):
    return source(spark, d).filter(U.is_classical()).agg(F.count("*").alias("poems"), F.count_distinct("poet_name").alias("poets"), F.count_distinct("poet_era").alias("eras"))


def era_counts(spark, d):
    return source(spark, d).filter(U.is_classical()).groupBy("poet_era").agg(F.count("*").alias("n"))


def location_authors(spark, d):
    return U.authors_at(source(spark, d), PLACE)


def author_semi_join(spark, d):
    s = source(spark, d)
    return s.join(U.authors_at(s, PLACE), "poet_name", "left_semi").select("row_idx", "poet_name")


def uncovered_authors(spark, d):
    s = source(spark, d)
    return s.join(U.authors_at(s, PLACE), "poet_name", "left_anti").select("row_idx", "poet_name")


def first_biography(spark, d):
    s = _texts(source(spark, d))
    return U.first_texts(s, U.authors_at(s, PLACE), "body").select("row_idx", "poet_name")


def biography_candidates(spark, d):
    s = _texts(source(spark, d))
    found = U.trigger_terms(U.first_texts(s, U.authors_at(s, PLACE), "body"), "body", TERMS)
    return found.select("row_idx", "poet_name", F.array_join("trigger_terms", ",").alias("trigger_terms"))


def _flags(spark, d):
    s = source(spark, d)
    return U.flagged(s, U.authors_at(s, PLACE))


def merged_union(spark, d):
    return _flags(spark, d).filter("is_merged").select("row_idx", "is_classic", "is_author")


def overlap_audit(spark, d):
    return _flags(spark, d).agg(
        F.count_if("is_classic").alias("classic"), F.count_if("is_author").alias("by_author"),
        F.count_if(F.col("is_classic") & F.col("is_author")).alias("both"), F.count_if("is_merged").alias("merged"),
    )


def rejected_authors(spark, d):
    """Reviewed candidates (of the biography search) without those whose era is known: a set difference."""
    s = _texts(source(spark, d))
    reviewed = U.trigger_terms(U.first_texts(s, U.authors_at(s, PLACE), "body"), "body", TERMS).select("poet_name")
    approved = s.filter("poet_era is not null").select("poet_name")
    return reviewed.subtract(approved)


def author_union(spark, d):
    s = source(spark, d)
    return U.authors_at(s, PLACE).union(s.filter(U.is_classical()).select("poet_name")).distinct()


def review_audit(spark, d):
    """Set equality both ways: candidates without review and reviews without candidate."""
    s = _texts(source(spark, d))
    found = U.trigger_terms(U.first_texts(s, U.authors_at(s, PLACE), "body"), "body", TERMS).select("poet_name")
    reviewed = s.filter("poem_theme is not null and poet_name is not null").select("poet_name").distinct()
    found = found.filter("poet_name is not null")
    both = found.withColumn("c", F.lit(1)).join(reviewed.withColumn("r", F.lit(1)), "poet_name", "full_outer")
    return both.agg(F.count_if(F.expr("c = 1 and r is null")).alias("unreviewed"), F.count_if(F.expr("r = 1 and c is null")).alias("unasked"), F.count_if(F.expr("c = 1 and r = 1")).alias("matched"))


def url_checks(spark, d):
    return source(spark, d).agg(
        F.count_if(F.col("poem_url").rlike("^https?://")).alias("good"), F.count_if(X.strip(F.col("poem_url")) == "").alias("blank"),
        (F.count("row_idx") == F.count_distinct("row_idx")).alias("ids_unique"),
    )


def meter_distribution(spark, d):
    rows = source(spark, d).filter(U.is_classical()).select(F.col("poem_meter").alias("meter_id"), X.meter_name(F.col("poem_meter")).alias("meter_name"))
    return U.distribution(rows, "meter_name")


def value_counts_with_null(spark, d):
    return source(spark, d).groupBy("poem_language_type").agg(F.count("*").alias("n"))


def split_concat(spark, d):
    """One file set per split, read back told apart by a column and concatenated."""
    paths = {name: scratch_path(spark, name) for name in ("even", "odd")}
    for name, path in paths.items():
        source(spark, d).filter(f"row_idx % 2 = {0 if name == 'even' else 1}").select("row_idx", "poem_verses").write.parquet(path)
    return files.read_splits(spark, paths).select("row_idx", F.size("poem_verses").cast("bigint").alias("n"), "split")


def preview(spark, d):
    return source(spark, d).orderBy("row_idx").limit(5).select("row_idx", "poet_name", "poet_era")


def authors_sorted(spark, d):
    return source(spark, d).select("poet_name").distinct().orderBy("poet_name")


QUERIES = {f.__name__: f for f in (
    canonical_poems, source_order, invalid_rows, meter_votes, meter_conflicts, source_provenance, poem_sources, split_counts, poem_text_digest, projected_scan,
    classical_subset, classical_summary, era_counts, location_authors, author_semi_join, uncovered_authors, first_biography, biography_candidates,
    merged_union, overlap_audit, rejected_authors, author_union, review_audit, url_checks, meter_distribution, value_counts_with_null, split_concat, preview, authors_sorted,
)}

GOOD = "SELECT * FROM poem_source WHERE len(poem_verses) > 0 AND len(poem_verses) % 2 = 0 AND poem_meter IS NOT NULL"
CLASSIC = f"poet_era IS NOT NULL AND poet_era <> '{U.MODERN_ERA}' AND poem_language_type IN ('فصيح', 'فصحى')"
METER_LIST = "[" + ",".join(f"'{m}'" for m in X.METERS) + "]"
#: One row per poem, as the operator gives it.
POEMS = f"""
  good AS ({GOOD}),
  votes AS (SELECT poem_verses AS v, poem_meter AS m, count(*) AS n FROM good GROUP BY 1, 2),
  tops AS (SELECT v, max(n) AS top, count(*) AS meters FROM votes GROUP BY 1),
  won AS (SELECT votes.v, min(m) AS m, count(*) > 1 AS tied, any_value(meters) > 1 AS conflict FROM votes JOIN tops USING (v) WHERE n = top GROUP BY 1),
  filled AS (SELECT good.*, won.m, tied, conflict, CAST(poem_meter = won.m AS INT) AS hit,
      (coalesce(poem_title, '') <> '')::INT + (coalesce(poem_theme, '') <> '')::INT + (coalesce(poet_name, '') <> '')::INT + (coalesce(poem_url, '') <> '')::INT AS f
    FROM good JOIN won ON good.poem_verses = won.v),
  firsts AS (SELECT poem_verses AS v, poem_url, min(row_idx) AS seen_at FROM good WHERE coalesce(poem_url, '') <> '' GROUP BY 1, 2),
  urls AS (SELECT v, string_agg(poem_url, '|' ORDER BY seen_at) AS urls, count(*) AS n_urls FROM firsts GROUP BY 1),
  poems AS (
    SELECT sha256(array_to_string(poem_verses, chr(9246))) AS sample_id, poem_verses AS verses,
      string_agg(CAST(row_idx AS VARCHAR), ',' ORDER BY row_idx) AS rows, count(*) AS n_rows, min(row_idx) AS first_row,
      any_value(m) AS meter_id, any_value(tied) AS tied, any_value(conflict) AS metadata_conflict,
      arg_max(struct_pack(name := poet_name, title := poem_title, theme := poem_theme), (hit, f, -row_idx)) AS b
    FROM filled GROUP BY poem_verses)"""
SPLIT = "CASE WHEN ('0x' || substr(sample_id, 1, 8))::UBIGINT % 100 < 98 THEN 'train' WHEN ('0x' || substr(sample_id, 1, 8))::UBIGINT % 100 = 98 THEN 'validation' ELSE 'test' END"
TEXT = "array_to_string(list_transform(range(0, CAST(len(verses) AS BIGINT), 2), lambda i: verses[i + 1] || ' = ' || verses[i + 2]), chr(10))"
AUTHORS = f"SELECT DISTINCT poet_name FROM poem_source WHERE poet_location = '{PLACE}' AND poet_name IS NOT NULL"
BODIES = f"""
  bodies AS (SELECT row_idx, poet_name, array_to_string(poem_verses, ' ') AS body FROM poem_source s
    WHERE len(poem_verses) > 0 AND NOT EXISTS (SELECT 1 FROM ({AUTHORS}) a WHERE a.poet_name = s.poet_name)),
  firstbody AS (SELECT poet_name, min(row_idx) AS row_idx, arg_min(body, row_idx) AS body FROM bodies GROUP BY 1)"""
_TERM_SQL = "[" + ",".join(f"'{t}'" for t in sorted(TERMS)) + "]"
FOUND = f"""{BODIES},
  found AS (SELECT row_idx, poet_name, list_filter({_TERM_SQL}, lambda t: regexp_matches(body, '(^|[^ء-ي])' || t || '([^ء-ي]|$)')) AS t FROM firstbody)"""

SQL = {
    "canonical_poems": f"""WITH {POEMS}
        SELECT sample_id, rows, coalesce(urls, '') AS urls, coalesce(b.name, '') AS poet_name, b.title AS poem_title, b.theme AS poem_theme, CAST(meter_id AS INT) AS meter_id,
          {METER_LIST}[meter_id + 1] AS meter_name, metadata_conflict, tied, CAST(len(verses) // 2 AS INT) AS couplet_count, {SPLIT} AS sft_split
        FROM poems LEFT JOIN urls ON urls.v = verses""",
    "source_order": f"WITH {POEMS} SELECT sample_id, first_row FROM poems ORDER BY first_row",
    "invalid_rows": "SELECT * FROM (SELECT row_idx, CASE WHEN coalesce(len(poem_verses), -1) < 1 THEN 'no verses' WHEN len(poem_verses) % 2 = 1 THEN 'odd verses' WHEN poem_meter IS NULL THEN 'no meter' END AS reason FROM poem_source) WHERE reason IS NOT NULL",
    "meter_votes": f"SELECT sha256(array_to_string(poem_verses, chr(9246))) AS sample_id, CAST(poem_meter AS INT) AS meter_id, count(*) AS votes FROM ({GOOD}) GROUP BY poem_verses, poem_meter",
    "meter_conflicts": f"WITH {POEMS} SELECT sample_id, CAST(meter_id AS INT) AS meter_id, tied FROM poems WHERE metadata_conflict",
    "source_provenance": f"WITH {POEMS} SELECT sample_id, n_rows, coalesce(n_urls, 0) AS n_urls FROM poems LEFT JOIN urls ON urls.v = verses",
    "poem_sources": f"SELECT sha256(array_to_string(poem_verses, chr(9246))) AS sample_id, row_idx, poem_url FROM ({GOOD})",
    "split_counts": f"WITH {POEMS} SELECT {SPLIT} AS sft_split, count(*) AS n FROM poems GROUP BY 1",
    "poem_text_digest": f"WITH {POEMS} SELECT sample_id, sha256({TEXT}) AS digest, length({TEXT}) AS n_chars FROM poems",
    "projected_scan": "SELECT row_idx, poem_title, poem_theme, poem_meter, len(poem_verses) AS n_verses, poem_url, poet_name FROM poem_source",
    "classical_subset": f"SELECT row_idx, poet_name, poet_era, poem_language_type FROM poem_source WHERE {CLASSIC}",
    "classical_summary": f"SELECT count(*) AS poems, count(DISTINCT poet_name) AS poets, count(DISTINCT poet_era) AS eras FROM poem_source WHERE {CLASSIC}",
    "era_counts": f"SELECT poet_era, count(*) AS n FROM poem_source WHERE {CLASSIC} GROUP BY 1",
    "location_authors": AUTHORS,
    "author_semi_join": f"SELECT row_idx, poet_name FROM poem_source WHERE poet_name IN ({AUTHORS})",
    "uncovered_authors": f"SELECT row_idx, poet_name FROM poem_source s WHERE NOT EXISTS (SELECT 1 FROM ({AUTHORS}) a WHERE a.poet_name = s.poet_name)",
    "first_biography": f"WITH {BODIES} SELECT row_idx, poet_name FROM firstbody",
    "biography_candidates": f"WITH {FOUND} SELECT row_idx, poet_name, array_to_string(t, ',') AS trigger_terms FROM found WHERE len(t) > 0",
    "merged_union": f"SELECT row_idx, c AS is_classic, a AS is_author FROM (SELECT row_idx, coalesce({CLASSIC}, false) AS c, poet_name IS NOT NULL AND poet_name IN ({AUTHORS}) AS a FROM poem_source) WHERE c OR a",
    "overlap_audit": f"SELECT count(*) FILTER (c) AS classic, count(*) FILTER (a) AS by_author, count(*) FILTER (c AND a) AS both, count(*) FILTER (c OR a) AS merged FROM (SELECT coalesce({CLASSIC}, false) AS c, poet_name IS NOT NULL AND poet_name IN ({AUTHORS}) AS a FROM poem_source)",
    "rejected_authors": f"WITH {FOUND} SELECT poet_name FROM found WHERE len(t) > 0 EXCEPT SELECT poet_name FROM poem_source WHERE poet_era IS NOT NULL",
    "author_union": f"{AUTHORS} UNION SELECT poet_name FROM poem_source WHERE {CLASSIC}",
    "review_audit": f"""WITH {FOUND}, c AS (SELECT poet_name FROM found WHERE len(t) > 0 AND poet_name IS NOT NULL), r AS (SELECT DISTINCT poet_name FROM poem_source WHERE poem_theme IS NOT NULL AND poet_name IS NOT NULL)
        SELECT count(*) FILTER (c.poet_name IS NOT NULL AND r.poet_name IS NULL) AS unreviewed, count(*) FILTER (r.poet_name IS NOT NULL AND c.poet_name IS NULL) AS unasked, count(*) FILTER (c.poet_name IS NOT NULL AND r.poet_name IS NOT NULL) AS matched
        FROM c FULL JOIN r ON c.poet_name = r.poet_name""",
    "url_checks": "SELECT count(*) FILTER (regexp_matches(poem_url, '^https?://')) AS good, count(*) FILTER (trim(poem_url) = '') AS blank, count(row_idx) = count(DISTINCT row_idx) AS ids_unique FROM poem_source",
    "meter_distribution": f"SELECT {METER_LIST}[poem_meter + 1] AS meter_name, count(*) AS n, round_even(count(*) * 100 / sum(count(*)) OVER (), 2) AS percent FROM poem_source WHERE {CLASSIC} GROUP BY 1",
    "value_counts_with_null": "SELECT poem_language_type, count(*) AS n FROM poem_source GROUP BY 1",
    "split_concat": "SELECT row_idx, CAST(len(poem_verses) AS BIGINT) AS n, CASE WHEN row_idx % 2 = 0 THEN 'even' ELSE 'odd' END AS split FROM poem_source",
    "preview": "SELECT row_idx, poet_name, poet_era FROM poem_source ORDER BY row_idx LIMIT 5",
    "authors_sorted": "SELECT DISTINCT poet_name FROM poem_source ORDER BY poet_name",
}
