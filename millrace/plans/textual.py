"""Queries over strings, arrays, urls, dates and json."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import text as X
from ..functions import variant as V
from ..session import spread, table

#: the same white space class for RE2
_S = r"[ \t\n\x0b\f\r\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"


def _trimmed(c: str) -> str:
    return f"regexp_replace({c}, '^{_S}+|{_S}+$', '', 'g')"


QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


_NORM = f"list_filter(list_transform(coalesce(req_technology, []), lambda x: {_trimmed('x')}), lambda x: x IS NOT NULL AND x <> '')"


@query(f"""WITH t AS (SELECT DISTINCT offer_id, ingested_at, {_NORM} AS a FROM offer)
SELECT offer_id, ingested_at, array_to_string(list_filter(a, lambda x, i: list_position(list_transform(a, lambda y: lower(y)), lower(x)) = i), '|') AS techs FROM t""")
def normalize_string_array(spark: SparkSession, d: str) -> DataFrame:
    """Trimmed technologies without what differs in case only."""
    return table(spark, d, "offer").select("offer_id", "ingested_at", F.array_join(X.normalize_string_array(F.col("req_technology")), "|").alias("techs")).distinct()


@query(f"""WITH t AS (SELECT offer_id, ingested_at, list_concat(coalesce(req_technology, []), coalesce(opt_technology, [])) AS a FROM offer),
u AS (SELECT *, list_transform(a, lambda y: coalesce(lower({_trimmed('y')}), chr(0) || 'null')) AS k FROM t)
SELECT DISTINCT offer_id, ingested_at, array_to_string(list_filter(list_filter(a, lambda x, i: list_position(k, k[i]) = i), lambda x: x IS NOT NULL), '|') AS techs FROM u""")
def array_union_ci(spark: SparkSession, d: str) -> DataFrame:
    """Required and optional technologies united without regard to case."""
    return table(spark, d, "offer").select("offer_id", "ingested_at", F.array_join(X.union_ci(F.col("req_technology"), F.col("opt_technology")), "|").alias("techs")).distinct()


_LEVEL = f"lower({_trimmed('role_seniority')})"


@query(f"""SELECT level, count(*) AS n FROM (SELECT CASE WHEN {_LEVEL} = 'trainee' THEN 'intern' WHEN {_LEVEL} IN ('medium', 'mid') THEN 'regular' WHEN {_LEVEL} = 'c_level' THEN 'c-level' ELSE nullif({_LEVEL}, '') END AS level FROM offer) GROUP BY level""")
def normalize_seniority(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "offer").select(X.seniority(F.col("role_seniority")).alias("level")).groupBy("level").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT DISTINCT employer_name, translate(employer_name, 'ąćęłńóśźżĄĆĘŁŃÓŚŹŻ', 'acelnoszzacelnoszz') AS plain FROM employer_profile""")
def transliterate(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "employer_profile").select("employer_name", X.transliterate_polish(F.col("employer_name")).alias("plain")).distinct()


@query("""SELECT DISTINCT url, md5(url || '.' || strftime(scraped_at, '%Y-%m-%d')) AS daily, md5(url || '.' || week(scraped_at)::VARCHAR) AS weekly,
substr(md5(url || '.' || week(scraped_at)::VARCHAR), 1, 2) || '/' || substr(md5(url || '.' || week(scraped_at)::VARCHAR), 3, 2) || '/' || substr(md5(url || '.' || week(scraped_at)::VARCHAR), 5) || '.cache' AS path FROM raw_page""")
def cache_keys(spark: SparkSession, d: str) -> DataFrame:
    """Daily and weekly cache keys of pages, with the folder of the weekly one."""
    day, weekly = F.col("scraped_at"), X.weekly_key(F.col("url"), F.to_date("scraped_at"))
    return table(spark, d, "raw_page").select("url", X.daily_key(F.col("url"), day).alias("daily"), weekly.alias("weekly"), X.key_path(weekly).alias("path")).distinct()


@query("""SELECT DISTINCT meta_id, regexp_replace(regexp_replace(regexp_replace(lower(trim(url)), '[?#].*$', ''), '^http://', 'https://'), '/+$', '') AS plain,
lower(trim(regexp_extract(url, '^(.*/)[^/]*$', 1) || job_id)) AS by_job FROM offer_meta""")
def url_normalize(spark: SparkSession, d: str) -> DataFrame:
    """Plain urls, and urls with their last part replaced by the job's id."""
    return table(spark, d, "offer_meta").select("meta_id", X.plain_url(F.col("url")).alias("plain"), X.with_slug(F.col("url"), F.col("job_id")).alias("by_job")).distinct()


@query(r"""WITH t AS (SELECT DISTINCT meta_id, regexp_extract(expires_at, '^(\d{1,2}\.\d{1,2}\.\d{4})$', 1) AS v FROM offer_meta WHERE regexp_matches(expires_at, '^\d{1,2}\.\d{1,2}\.\d{4}$'))
SELECT meta_id, v, strftime(make_date(split_part(v, '.', 3)::INT, 1, 1) + to_months(split_part(v, '.', 2)::INT - 1) + to_days(split_part(v, '.', 1)::INT - 1), '%Y-%m-%d') AS iso FROM t""")
def dmy_to_iso(spark: SparkSession, d: str) -> DataFrame:
    """Days with points as ISO days, overflow rolled over."""
    v = F.col("expires_at")
    return table(spark, d, "offer_meta").where(v.rlike(r"^\d{1,2}\.\d{1,2}\.\d{4}$")).select("meta_id", v.alias("v"), X.dmy_to_iso(v).alias("iso")).distinct()


@query(r"""SELECT DISTINCT meta_id, strftime(make_timestamp(published_at::BIGINT * 1000), '%Y-%m-%dT%H:%M:%S.') || lpad((published_at::BIGINT % 1000)::VARCHAR, 3, '0') || 'Z' AS iso FROM offer_meta WHERE regexp_matches(published_at, '^\d{13}$')""")
def epoch_ms_to_iso(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("published_at")
    return table(spark, d, "offer_meta").where(v.rlike(r"^\d{13}$")).select("meta_id", X.millis_to_iso(F.expr("try_cast(published_at as bigint)")).alias("iso")).distinct()


@query("""WITH u AS (SELECT DISTINCT meta_id, alternate_urls AS a FROM offer_meta WHERE len(alternate_urls) > 0),
t AS (SELECT meta_id, unnest(list_transform(a, lambda x, i: {'s': lower(trim(x)), 'i': i})) AS e FROM u)
SELECT meta_id, arg_min(e.s, (CASE WHEN contains(e.s, 'remote') THEN 0 ELSE 1 END) * 1000000 + length(e.s) * 1000 + e.i) AS slug FROM t WHERE e.s IS NOT NULL GROUP BY meta_id""")
def canonical_pick(spark: SparkSession, d: str) -> DataFrame:
    """The canonical among alternate urls: remote ones first, then the shortest."""
    rows = table(spark, d, "offer_meta").where(F.size("alternate_urls") > 0).select("meta_id", X.canonical_slug(F.col("alternate_urls")).alias("slug"))
    return rows.where("slug is not null").distinct()


@query("""SELECT p_partkey, CASE WHEN p_retailprice = floor(p_retailprice) THEN p_retailprice::BIGINT::VARCHAR ELSE p_retailprice::VARCHAR END AS price, p_size::VARCHAR AS size FROM part""")
def number_text(spark: SparkSession, d: str) -> DataFrame:
    """Numbers as texts without a needless fraction."""
    return table(spark, d, "part").select("p_partkey", X.js_number(F.col("p_retailprice")).alias("price"), X.js_number(F.col("p_size")).alias("size"))


@query("""SELECT event_id, greatest(1.0, least(100.0, value)) AS clamped, ceil(value * 1.2)::BIGINT AS up, floor(value * 0.8)::BIGINT AS down, list_extract(['a', 'b', 'c', 'd', 'e'], (1 + event_id % 5)::BIGINT) AS pick FROM events""")
def clamp_and_pick(spark: SparkSession, d: str) -> DataFrame:
    """Bounded values, steps up and down, and a pick from a list by an injected number."""
    five = F.array(*[F.lit(x) for x in "abcde"])
    return table(spark, d, "events").select(
        "event_id", X.clamp(F.col("value"), 1.0, 100.0).alias("clamped"), F.ceil(F.col("value") * 1.2).cast("bigint").alias("up"), F.floor(F.col("value") * 0.8).cast("bigint").alias("down"), F.element_at(five, (1 + F.col("event_id") % 5).cast("int")).alias("pick"))


@query(r"""SELECT doc_id, md5(regexp_replace(regexp_replace(replace(text, chr(13) || chr(10), chr(10)), '(?m)^ +| +$', '', 'g'), '(\n[ \t]*\n)(?:[ \t]*\n)+', '\1', 'g')) AS h,
regexp_extract(text, '(?m)^#+ (.+)$', 1) AS heading FROM documents WHERE text IS NOT NULL""")
def markdown_whitespace(spark: SparkSession, d: str) -> DataFrame:
    """Markdown with its white space in order (by hash) and its first heading."""
    c = F.col("text")
    return table(spark, d, "documents").where(c.isNotNull()).select("doc_id", F.md5(X.collapse_blank_lines(c)).alias("h"), F.regexp_extract(c, "(?dm)^#+ (.+)$", 1).alias("heading"))


@query(r"""WITH t AS (SELECT page_id, scraped_at, regexp_extract_all(html, '(?is)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>', 1) AS s FROM raw_page WHERE html IS NOT NULL)
SELECT DISTINCT page_id, len(s) AS n, array_to_string(list_transform(s, lambda x: CASE WHEN json_valid(x) THEN x ELSE '{}' END), chr(10)) AS json FROM t""")
def script_extract(spark: SparkSession, d: str) -> DataFrame:
    """Embedded JSON of pages; what doesn't parse is {}."""
    s = H.scripts(F.col("html"), "application/ld+json")
    return table(spark, d, "raw_page").where("html is not null").select("page_id", F.size(s).cast("bigint").alias("n"), F.array_join(F.transform(s, lambda x: F.when(F.try_parse_json(x).isNotNull(), x).otherwise("{}")), "\n").alias("json")).distinct()


@query(r"""SELECT DISTINCT page_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '(?s)<!--.*?-->', '', 'g'), '<[^>]*>', ' ', 'g'), '[ \t\n\r\f]+', ' ', 'g'))) AS h,
len(regexp_extract_all(html, '(?i)<p[\s>/]')) AS n_paragraphs FROM raw_page WHERE html IS NOT NULL""")
def strip_tags(spark: SparkSession, d: str) -> DataFrame:
    """Plain text of pages (by hash) and their paragraphs."""
    return table(spark, d, "raw_page").where("html is not null").select("page_id", F.md5(H.strip_tags(F.col("html"))).alias("h"), F.regexp_count("html", F.lit(r"(?i)<p[\s>/]")).cast("bigint").alias("n_paragraphs")).distinct()


@query()
def html_clean(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned pages and their Markdown, per board, in one pass."""
    return spread(table(spark, d, "raw_page").where("html is not null").select("page_id", "source", "html")).select("page_id", "source", H.read_page(F.col("html"), F.col("source")).alias("p")).select("page_id", "source", F.length("p.clean").alias("clean_chars"), F.length("p.md").alias("md_chars"), "p.n_paragraphs", F.size("p.ld_json").alias("n_ld_json"))


@query("""SELECT n_regionkey, n_nationkey::VARCHAR AS key, n_name AS name FROM nation""")
def table_parse(spark: SparkSession, d: str) -> DataFrame:
    """Rows of html tables, one per region, read back from their markup."""
    row = F.concat(F.lit("<tr><td>"), F.col("n_nationkey").cast("string"), F.lit("</td><td><b>"), F.col("n_name"), F.lit("</b></td></tr>"))
    html = F.concat(F.lit("<table>"), F.array_join(F.collect_list(row), ""), F.lit("</table>"))
    tables = table(spark, d, "nation").groupBy("n_regionkey").agg(html.alias("html"))
    return tables.select("n_regionkey", F.explode(H.table_rows(F.col("html"))).alias("r")).select("n_regionkey", F.get("r", F.lit(0)).alias("key"), F.get("r", F.lit(1)).alias("name"))


@query("""SELECT event_id, (props::JSON->>'k')::BIGINT AS k, json_type(props::JSON) AS kind, CASE WHEN json_type(props::JSON, '$.k') IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN 'NUMBER' ELSE json_type(props::JSON, '$.k') END AS k_kind, json_type(props::JSON, '$.none') AS none_kind FROM events""")
def json_path_get(spark: SparkSession, d: str) -> DataFrame:
    """Typed parts of json and their kinds; missing parts have none."""
    v = F.try_parse_json("props")
    return table(spark, d, "events").withColumn("v", v).select("event_id", V.number(F.col("v"), "k").cast("bigint").alias("k"), V.kind(F.col("v")).alias("kind"), V.kind(V.get(F.col("v"), "k")).alias("k_kind"), V.kind(V.get(F.col("v"), "none")).alias("none_kind"))


_J = "CASE WHEN json_valid(replace(payload, chr(65279), '')) THEN replace(payload, chr(65279), '')::JSON END"


@query(f"""WITH t AS (SELECT DISTINCT file_id, source, {_J} AS j FROM raw_file WHERE artifact = 'raw.job.json' AND job_id IS NOT NULL)
SELECT source, count(*) AS n, count(*) FILTER (j IS NULL) AS n_broken, count(*) FILTER (json_type(j, '$.salary') = 'OBJECT') AS n_salary, count(*) FILTER (json_type(j, '$.logo.original') = 'NULL') AS n_null_logo,
count(*) FILTER (json_type(j, '$.location.places[0].city') = 'VARCHAR') AS n_city, count(*) FILTER (json_type(j, '$.requiredSkills') = 'ARRAY') AS n_skills FROM t GROUP BY source""")
def json_type_predicates(spark: SparkSession, d: str) -> DataFrame:
    """Kinds of parts of listing records: missing, null, text, list, object."""
    t = table(spark, d, "raw_file").where("artifact = 'raw.job.json' and job_id is not null").select("file_id", "source", "payload").distinct()
    t = t.withColumn("v", F.try_parse_json(F.replace("payload", F.lit("\ufeff"), F.lit(""))))
    is_ = lambda path, kind: F.count_if(F.coalesce(V.kind(V.get(F.col("v"), path)) == kind, F.lit(False)))
    return t.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("v").isNull()).alias("n_broken"), is_("salary", "OBJECT").alias("n_salary"), is_("logo.original", "NULL").alias("n_null_logo"),
        is_("location.places.0.city", "STRING").alias("n_city"), is_("requiredSkills", "ARRAY").alias("n_skills"))


@query("""SELECT DISTINCT file_id, regexp_replace(file_path, '^[^/]+/', '') AS rel, regexp_extract(file_path, '([^/]+)$', 1) AS name, regexp_extract(file_path, '([^/]+)$', 1) IN ('raw.job.json', 'raw.job.html') AS known FROM raw_file""")
def path_parts(spark: SparkSession, d: str) -> DataFrame:
    """Paths without their root, file names, and whether they are known artifacts."""
    from ..sources.artifacts import known

    name = F.regexp_extract("file_path", r"([^/]+)$", 1)
    return table(spark, d, "raw_file").select("file_id", F.regexp_replace("file_path", "^[^/]+/", "").alias("rel"), name.alias("name"), known(name).alias("known")).distinct()


@query("""SELECT DISTINCT offer_id, ingested_at, array_to_string(list_sort(list_distinct(list_filter(contract_types, lambda x: x IN ('employment', 'other')))), ',') AS common,
array_to_string(list_sort(list_distinct(list_filter(contract_types, lambda x: x NOT IN ('employment', 'other')))), ',') AS rest FROM offer WHERE contract_types IS NOT NULL""")
def set_operations(spark: SparkSession, d: str) -> DataFrame:
    """Intersection and difference of a list with the wanted ones."""
    wanted = F.array(F.lit("employment"), F.lit("other"))
    clean = F.filter("contract_types", lambda x: x.isNotNull())
    return table(spark, d, "offer").where("contract_types is not null").select("offer_id", "ingested_at", F.array_join(F.sort_array(F.array_intersect(clean, wanted)), ",").alias("common"), F.array_join(F.sort_array(F.array_except(clean, wanted)), ",").alias("rest")).distinct()
