"""Queries over text corpora and noisy records."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import spread, table
from . import canonical, contamination, encoding, language, linkage, mainbody, names

TOKENIZERS = os.environ.get("MILLRACE_TOKENIZERS", "/opt/tokenizers")
#: word pattern of the byte-level vocabularies (fixed value, published with them)
BYTE_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """The pairs of postings of one vacancy: those with a posterior of at least one half."""
    return linkage.same_vacancy(linkage.matches(table(spark, d, "offer"), table(spark, d, "canon_value")))


def p1_confidence(spark: SparkSession, d: str) -> DataFrame:
    """Per pattern of agreement: compared pairs and the posterior."""
    pairs = linkage.matches(table(spark, d, "offer"), table(spark, d, "canon_value"))
    return pairs.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), F.round(F.max("confidence"), 6).alias("confidence"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """The paragraphs of every page's main body."""
    pages = spread(table(spark, d, "raw_page").select("page_id", "html"))
    return mainbody.main_blocks(pages, mainbody.train(pages)).select("page_id", "text_md5").distinct()


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """The entry meant by every freely typed value, -1 for none."""
    return canonical.map_values(table(spark, d, "offer"), table(spark, d, "canon_value")).select("offer_id", "field_name", "pos", "canon_id")


def p4_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """The report of values that no entry explains, with their number."""
    rows = canonical.map_values(table(spark, d, "offer"), table(spark, d, "canon_value")).where("canon_id = -1")
    return rows.groupBy("field_name", "value").agg(F.count(F.lit(1)).alias("n"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """The pairs of profiles that mean one employer."""
    return names.linked_profiles(table(spark, d, "employer_profile"))


def p7_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Every spelling with the spelling its cluster is named by."""
    return names.name_clusters(table(spark, d, "employer_profile")).select("employer_name", "center")


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    """The ids of every document; null and empty texts have an empty list."""
    return encoding.encode(spread(table(spark, d, "documents").select("doc_id", "text")), os.path.join(TOKENIZERS, "byte_bpe_50k.tiktoken"), BYTE_PATTERN)


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents with the items that leaked into them."""
    return contamination.leaks(spread(table(spark, d, "documents").select("doc_id", "text")), table(spark, d, "eval_item")).select("doc_id", "item_id").distinct()


def p9_kept(spark: SparkSession, d: str) -> DataFrame:
    """What is left of the corpus once affected documents are removed."""
    docs = table(spark, d, "documents")
    return contamination.without_leaks(docs, contamination.leaks(spread(docs.select("doc_id", "text")), table(spark, d, "eval_item"))).select("doc_id", "source")


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """The segments of documents whose label is missing or wrong or that mix languages."""
    return language.relabelled(_segments(spark, d)).select("doc_id", "seg_no", "seg_lang")


def p10_documents(spark: SparkSession, d: str) -> DataFrame:
    """The language of every document that has sentences, with a confidence."""
    return language.of_documents(_segments(spark, d)).select("doc_id", "lang", F.round("confidence", 4).alias("confidence"))


def _segments(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "lang", "text")
    return language.segments(spread(docs), language.train(docs))


QUERIES = {f.__name__: f for f in (p1_found, p1_confidence, p3_found, p4_found, p4_unmatched, p7_found, p7_clusters, p8_ids, p9_found, p9_kept, p10_found, p10_documents)}
_LEAKS = r"""WITH d AS (SELECT doc_id, list_filter(regexp_extract_all(lower(translate(strip_accents(regexp_replace(regexp_replace(regexp_replace(text, '(?i)</?(a|abbr|b|code|em|i|mark|small|span|strong|sub|sup|u)\b[^<>]*>|[\x{ad}\x{34f}\x{61c}\x{180e}\x{200b}-\x{200f}\x{202a}-\x{202e}\x{2060}-\x{206f}\x{fe00}-\x{fe0f}\x{feff}]', '', 'g'), '</?[a-zA-Z][^<>]*>', ' ', 'g'), '([\pL\pN])[*`~]+([\pL\pN])', '\1\2', 'g')), 'łŁøØđĐ', 'lloodd')), '[\pL\pN]+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL), i AS (SELECT item_id, list_filter(regexp_extract_all(lower(translate(strip_accents(regexp_replace(regexp_replace(regexp_replace(item_text, '(?i)</?(a|abbr|b|code|em|i|mark|small|span|strong|sub|sup|u)\b[^<>]*>|[\x{ad}\x{34f}\x{61c}\x{180e}\x{200b}-\x{200f}\x{202a}-\x{202e}\x{2060}-\x{206f}\x{fe00}-\x{fe0f}\x{feff}]', '', 'g'), '</?[a-zA-Z][^<>]*>', ' ', 'g'), '([\pL\pN])[*`~]+([\pL\pN])', '\1\2', 'g')), 'łŁøØđĐ', 'lloodd')), '[\pL\pN]+'), lambda x: x <> '') AS w FROM (SELECT DISTINCT item_id, item_text FROM eval_item WHERE item_text IS NOT NULL)),
dg AS (SELECT DISTINCT doc_id, hash(w[k:k + 11]) AS g FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 11)) AS k FROM d WHERE len(w) >= 12)),
ig AS (SELECT DISTINCT item_id, hash(w[k:k + 11]) AS g FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - 11)) AS k FROM i WHERE len(w) >= 12))
SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (g)"""
SQL: dict[str, str] = {
    "p9_found": _LEAKS,
    "p9_kept": f"SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM ({_LEAKS}))",
}
