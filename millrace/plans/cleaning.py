"""Queries of the general data problems (2, 5, 6)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import compaction, timestamps, units
from ..session import shared_dir, table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Every salary that can be told and isn't in the plain form yet, in PLN per month."""
    pay = units.salaries(table(spark, d, "offer"), table(spark, d, "fx_rate"), table(spark, d, "unit_month"))
    told = pay.where("not plain and (pln_month_from is not null or pln_month_to is not null)")
    return told.select("offer_id", "contract_kind", F.coalesce("pln_month_from", F.lit(-1)).cast("bigint").alias("pln_month_from"), F.coalesce("pln_month_to", F.lit(-1)).cast("bigint").alias("pln_month_to"))


def p2_residuals(spark: SparkSession, d: str) -> DataFrame:
    """Per currency and unit: salaries, those without a unique reading, mean log residual."""
    pay = units.salaries(table(spark, d, "offer"), table(spark, d, "fx_rate"), table(spark, d, "unit_month"))
    return pay.groupBy("currency", "unit").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("unique")).alias("n_not_unique"), F.round(F.avg("residual"), 6).alias("mean_residual"))


def p2_guessed(spark: SparkSession, d: str) -> DataFrame:
    """The likeliest unit of salaries that don't tell theirs, by the offer's other salary."""
    unit_month = table(spark, d, "unit_month")
    got = units.guessed_units(units.salaries(table(spark, d, "offer"), table(spark, d, "fx_rate"), unit_month), unit_month)
    return got.select("offer_id", "contract_kind", "currency", "guess", F.round("guess_residual", 4).alias("guess_residual"), "guess_unique")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """One UTC instant per readable published_at and expires_at."""
    rows = timestamps.normalise(table(spark, d, "offer_meta"), table(spark, d, "board"), "meta_id", ["published_at", "expires_at"])
    return rows.where("utc_us is not null").select("meta_id", "field_name", "utc_us").distinct()


def p5_mixture(spark: SparkSession, d: str) -> DataFrame:
    """The fitted mixture of forms per source, ambiguity marked by its posterior."""
    rows = timestamps.normalise(table(spark, d, "offer_meta"), table(spark, d, "board"), "meta_id", ["published_at", "expires_at"])
    return rows.groupBy("source", "form", "reading").agg(F.count(F.lit(1)).alias("n"), F.round(F.max("posterior"), 6).alias("posterior"), F.count_if("ambiguous").alias("n_ambiguous"), F.count_if("twice").alias("n_twice"))


def _consolidated(spark: SparkSession, d: str) -> tuple[DataFrame, dict[str, int]]:
    """All records of raw_file once, in few files in the shared folder, and how it went."""
    raw = table(spark, d, "raw_file")
    target = f"{shared_dir(spark).rstrip('/')}/consolidated/{uuid.uuid4().hex}"
    done = compaction.consolidate(spark, os.path.join(d, "raw_file.parquet"), target)
    return spark.read.schema(compaction.RECORD).parquet(target), done | {"files_out": len(spark.read.parquet(target).inputFiles()), "rows_in": raw.count()}


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Files that add no record: the consolidated files keep none from them."""
    return compaction.redundant_files(table(spark, d, "raw_file"), _consolidated(spark, d)[0])


def p6_records(spark: SparkSession, d: str) -> DataFrame:
    """Each complete record once, with the file that keeps it, as the consolidated files hold it."""
    return _consolidated(spark, d)[0].select("file_id", "rec_no", "key")


def p6_summary(spark: SparkSession, d: str) -> DataFrame:
    """How many rows (saved files) were read and how many records were written."""
    done = _consolidated(spark, d)[1]
    return spark.range(1).select(F.lit(done["rows_in"]).cast("bigint").alias("rows_in"), F.lit(done["records"]).cast("bigint").alias("records"), F.lit(done["files_out"] <= done["n_out"]).alias("packed"))


QUERIES = {f.__name__: f for f in (p2_found, p2_residuals, p2_guessed, p5_found, p5_mixture, p6_found, p6_records, p6_summary)}
_OWNERS = r"""WITH f AS (SELECT DISTINCT file_id, source, job_id, artifact, replace(coalesce(payload, ''), chr(65279), '') AS p FROM raw_file WHERE file_id IS NOT NULL),
l AS (SELECT file_id, source, unnest(CASE WHEN json_valid(p) THEN (CASE WHEN json_type(p) = 'ARRAY' THEN json_extract(p, '$[*]') ELSE [p::JSON] END) ELSE list_transform(list_filter(string_split(p, chr(10)), lambda x: json_valid(x)), lambda x: x::JSON) END) AS j FROM f WHERE artifact = 'raw.job.json'),
n AS (SELECT row_number() OVER () AS rec, file_id, source, j FROM l WHERE json_type(j) = 'OBJECT'),
k AS (SELECT rec, any_value(file_id) AS file_id, 'j' || any_value(source) || md5(string_agg(t.fullkey || '=' || CASE WHEN t.type IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN t.atom::DOUBLE::VARCHAR ELSE coalesce(t.atom::VARCHAR, t.type) END, chr(10) ORDER BY t.fullkey)) AS key FROM n, json_tree(n.j) t GROUP BY rec),
h AS (SELECT file_id, 'h' || coalesce(job_id, '') || md5(trim(regexp_replace(p, '\s+', ' ', 'g'))) AS key FROM f WHERE artifact = 'raw.job.html' AND regexp_matches(p, '</html>\s*$')),
o AS (SELECT key, min(file_id) AS file_id FROM (SELECT file_id, key FROM k UNION ALL SELECT file_id, key FROM h) GROUP BY key)"""
SQL: dict[str, str] = {
    "p6_summary": f"""{_OWNERS}
SELECT (SELECT count(*) FROM raw_file) AS rows_in, count(*) AS records, true AS packed FROM o""",
    "p6_found": f"""{_OWNERS}
SELECT DISTINCT file_id FROM f WHERE file_id NOT IN (SELECT file_id FROM o)""",
}
