"""Queries over the flow of offers: cleaners, guards, routes, state, joins, events."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions import text as X
from ..functions import variant as V
from ..operators import cleaners, guards, pipeline, registry, sinks, state
from ..session import shared_dir, table
from ..sources import listings

QUERIES, SQL = {}, {}
NOW = "2026-01-01 00:00:00"


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def _now():
    return F.lit(NOW).cast("timestamp")


def _json_files(spark, d):
    """The listing records of all json files, those of several jobs among them, repeated rows once."""
    f = table(spark, d, "raw_file").where("artifact = 'raw.job.json'").select("file_id", "source", "payload").dropDuplicates(["file_id"])
    return listings.file_records(f).withColumn("v", F.try_parse_json("body")).drop("body")


def _records(spark, d, source):
    return _json_files(spark, d).where(F.col("source") == source)


# the records of a file: elements of an array, lines that are records, else the whole
_ROWS = """SELECT file_id, source, generate_subscripts(js, 1) - 1 AS rec_no, unnest(js) AS j FROM (SELECT file_id, source, CASE WHEN json_valid(p) THEN (CASE WHEN json_type(p) = 'ARRAY' THEN json_extract(p, '$[*]') ELSE [p::JSON] END)
 WHEN json_valid(ls[1]) THEN list_transform(ls, lambda x: CASE WHEN json_valid(x) THEN x::JSON END) ELSE [NULL::JSON] END AS js
 FROM (SELECT *, list_filter(string_split_regex(p, '\r?\n'), lambda x: trim(x) <> '') AS ls FROM (SELECT DISTINCT file_id, source, replace(payload, chr(65279), '') AS p FROM raw_file WHERE artifact = 'raw.job.json')))"""


def _rec(source: str) -> str:
    return f"SELECT * FROM ({_ROWS}) WHERE source = '{source}'"


_J = "CASE WHEN json_valid(replace(payload, chr(65279), '')) THEN replace(payload, chr(65279), '')::JSON END"
_LEVEL = "CASE WHEN {0} = 'trainee' THEN 'intern' WHEN {0} IN ('medium', 'mid') THEN 'regular' WHEN {0} = 'c_level' THEN 'c-level' ELSE nullif({0}, '') END"
_KIND = "CASE WHEN lower({0}) IN ('b2b', 'b2b/contractor') THEN 'b2b/contractor' WHEN lower({0}) IN ('permanent', 'employment', 'uop') THEN 'employment' WHEN {0} IS NOT NULL THEN 'other' END"
_DEDUP = "array_to_string(list_filter({0}, lambda x, i: list_position(list_transform({0}, lambda y: lower(y)), lower(x)) = i), '|')"


def _flat(df: DataFrame) -> DataFrame:
    j = F.col("job")
    return df.select(
        "file_id", "rec_no", F.col("error").isNotNull().alias("broken"), j["employer"]["name"].alias("name"), j["role"]["title"].alias("title"), j["role"]["seniority"].alias("level"), j["role"]["scope"].alias("scope"),
        j["workplace"]["isRemote"].cast("string").alias("remote"), F.array_join(j["workplace"]["cities"], "|").alias("cities"), F.array_join(j["contract"]["type"], "|").alias("contracts"),
        F.concat_ws("/", *[F.coalesce(j["salaryCoE"][x], F.lit("")) for x in ("from", "to", "currency", "unit")]).alias("coe"), F.concat_ws("/", *[F.coalesce(j["salaryB2B"][x], F.lit("")) for x in ("from", "to", "currency", "unit")]).alias("b2b"),
        F.array_join(j["reqTechnology"], "|").alias("required"), F.array_join(j["optTechnology"], "|").alias("optional"))


@query(f"""WITH r AS ({_rec('jji')}), e AS (SELECT *, CASE WHEN j IS NOT NULL THEN json_extract(j, '$.employmentTypes[*]') END AS es FROM r),
f AS (SELECT *, list_transform(es, lambda x: {_KIND.replace('{0}', "(x->>'type')")}) AS ks,
 list_filter(es, lambda x: lower(x->>'type') IN ('b2b', 'b2b/contractor'))[1] AS b, list_filter(es, lambda x: lower(x->>'type') IN ('permanent', 'employment', 'uop'))[1] AS c,
 list_transform(json_extract(j, '$.requiredSkills[*]'), lambda x: CASE WHEN json_type(x) = 'OBJECT' THEN (CASE WHEN (x->>'level')::INT > 2 THEN trim(x->>'name') END) ELSE trim(x->>'$') END) AS s,
 list_transform(json_extract(j, '$.niceToHaveSkills[*]'), lambda x: trim(x->>'$')) AS o,
 lower(trim(j->>'workplaceType')) AS w, lower(trim(coalesce(j->>'experienceLevel', ''))) AS l FROM e),
g AS (SELECT *, list_filter(s, lambda x: x IS NOT NULL AND x <> '') AS s2, list_filter(o, lambda x: x IS NOT NULL AND x <> '') AS o2, list_transform(json_extract(j, '$.multilocation[*]'), lambda x: x->>'city') AS cs FROM f)
SELECT file_id, rec_no, j IS NULL AS broken, j->>'companyName' AS name, j->>'title' AS title, {_LEVEL.replace('{0}', 'l')} AS level, NULL::VARCHAR AS scope, (w = 'remote')::VARCHAR AS remote,
 {_DEDUP.replace('{0}', 'cs')} AS cities, CASE WHEN j IS NOT NULL THEN {_DEDUP.replace('{0}', 'ks')} END AS contracts,
 concat(coalesce(c->>'from', ''), '/', coalesce(c->>'to', ''), '/', coalesce(c->>'currency', ''), '/', coalesce(lower(c->>'unit'), '')) AS coe,
 concat(coalesce(b->>'from', ''), '/', coalesce(b->>'to', ''), '/', coalesce(b->>'currency', ''), '/', coalesce(lower(b->>'unit'), '')) AS b2b,
 CASE WHEN j IS NOT NULL THEN {_DEDUP.replace('{0}', 's2')} END AS required, CASE WHEN j IS NOT NULL THEN CASE WHEN json_exists(j, '$.requiredSkills') THEN {_DEDUP.replace('{0}', 'o2')} ELSE '' END END AS optional FROM g""")
def clean_jji(spark: SparkSession, d: str) -> DataFrame:
    """Records of one board in the common schema; broken ones are marked."""
    return _flat(cleaners.clean_jji(_records(spark, d, "jji")))


@query(f"""WITH r AS ({_rec('nfj')}),
f AS (SELECT *, {_KIND.replace('{0}', "nullif(j->>'$.salary.type', '')")} AS k, j->>'$.salary.period' AS p, coalesce(j->>'$.salary.from', j->>'$.salary.min') AS lo, coalesce(j->>'$.salary.to', j->>'$.salary.max', j->>'$.salary.from', j->>'$.salary.min') AS hi,
 list_filter(list_transform(json_extract(j, '$.location.places[*]'), lambda x: coalesce(nullif(trim(x->>'city'), ''), nullif(trim(x->>'province'), ''))), lambda x: x IS NOT NULL) AS cs,
 list_filter(list_concat(list_transform(list_filter(json_extract(j, '$.tiles.values[*]'), lambda x: (x->>'type') = 'requirement'), lambda x: trim(x->>'value')), [trim(j->>'technology')]), lambda x: x IS NOT NULL AND x <> '') AS s,
 lower(trim(array_to_string(list_transform(json_extract(j, '$.seniority[*]'), lambda x: trim(x->>'$')), ', '))) AS l FROM r),
g AS (SELECT *, CASE WHEN p IN ('m', 'month') THEN 'month' WHEN p IN ('h', 'hour') THEN 'hour' WHEN p IN ('y', 'year') THEN 'year' ELSE coalesce(nullif(p, ''), 'month') END AS u, json_type(j, '$.salary') = 'OBJECT' AS pay FROM f),
h AS (SELECT *, concat(coalesce(lo, ''), '/', coalesce(hi, ''), '/', coalesce(j->>'$.salary.currency', ''), '/', u) AS full_ FROM g)
SELECT file_id, rec_no, j IS NULL AS broken, j->>'name' AS name, j->>'title' AS title, {_LEVEL.replace('{0}', 'l')} AS level, NULL::VARCHAR AS scope,
 CASE WHEN j IS NOT NULL THEN coalesce((j->>'$.location.fullyRemote')::BOOLEAN, false) OR coalesce((j->>'fullyRemote')::BOOLEAN, false) END::VARCHAR AS remote, CASE WHEN j IS NOT NULL THEN {_DEDUP.replace('{0}', 'cs')} END AS cities,
 CASE WHEN j IS NOT NULL THEN CASE WHEN pay AND k IS NOT NULL THEN k ELSE '' END END AS contracts, CASE WHEN j IS NOT NULL AND coalesce(pay, false) AND coalesce(k, '') <> 'b2b/contractor' THEN full_ ELSE '///' END AS coe, CASE WHEN j IS NOT NULL AND coalesce(pay, false) AND coalesce(k, '') <> 'employment' THEN full_ ELSE '///' END AS b2b,
 CASE WHEN j IS NOT NULL THEN {_DEDUP.replace('{0}', 's')} END AS required, CASE WHEN j IS NOT NULL THEN '' END AS optional FROM h""")
def clean_nfj(spark: SparkSession, d: str) -> DataFrame:
    return _flat(cleaners.clean_nfj(_records(spark, d, "nfj")))


@query(f"""WITH r AS ({_rec('bdj')}),
f AS (SELECT *, replace(lower(j->>'employmentType'), '_', '-') AS sc, coalesce((j->>'contractOther')::BOOLEAN, false) AS ot, coalesce((j->>'contractB2b')::BOOLEAN, false) AS b, coalesce((j->>'contractEmployment')::BOOLEAN, false) AS c,
 nullif(j->>'$.denominatedSalaryLong.money', '') AS m, lower(trim(j->>'experienceLevel')) AS l, list_filter(list_transform(json_extract(j, '$.technologyTags[*]'), lambda x: trim(x->>'$')), lambda x: x <> '') AS s FROM r),
g AS (SELECT *, concat(coalesce(CASE WHEN contains(m, '-') THEN trim(split_part(m, '-', 1)) WHEN starts_with(lower(m), 'from') THEN substr(m, 5) END, ''), '/', coalesce(CASE WHEN contains(m, '-') THEN trim(split_part(m, '-', 2)) END, ''), '/', coalesce(j->>'$.denominatedSalaryLong.currency', ''), '/month') AS full_ FROM f)
SELECT file_id, rec_no, j IS NULL AS broken, j->>'$.company.name' AS name, j->>'position' AS title, {_LEVEL.replace('{0}', 'l')} AS level,
 CASE WHEN sc = 'freelance' OR (sc = 'contractor' AND ot) THEN 'project' WHEN sc = 'contractor' THEN 'full-time' ELSE sc END AS scope, (j->>'remote')::BOOLEAN::VARCHAR AS remote, j->>'city' AS cities,
 CASE WHEN j IS NOT NULL THEN array_to_string(list_filter([CASE WHEN b THEN 'b2b/contractor' END, CASE WHEN c THEN 'employment' END, CASE WHEN ot THEN 'other' END], lambda x: x IS NOT NULL), '|') END AS contracts,
 CASE WHEN j IS NOT NULL AND b AND m IS NOT NULL THEN full_ ELSE '///' END AS coe, CASE WHEN j IS NOT NULL AND c AND m IS NOT NULL THEN full_ ELSE '///' END AS b2b,
 CASE WHEN j IS NOT NULL THEN {_DEDUP.replace('{0}', 's')} END AS required, CASE WHEN j IS NOT NULL THEN '' END AS optional FROM g""")
def clean_bdj(spark: SparkSession, d: str) -> DataFrame:
    return _flat(cleaners.clean_bdj(_records(spark, d, "bdj")))


@query(f"""SELECT source, count(*) AS n, count(*) FILTER (source = 'ptc' OR j IS NULL) AS n_error, count(*) FILTER (source = 'ptc') AS n_unknown FROM ({_ROWS}) GROUP BY source""")
def source_dispatch(spark: SparkSession, d: str) -> DataFrame:
    """Rows go to their source's cleaner; sources without one are errors."""
    out = cleaners.clean(_json_files(spark, d))
    return out.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count("error").alias("n_error"), F.count_if(F.col("error") == "no transformation for source").alias("n_unknown"))


@query(r"""WITH t AS (SELECT DISTINCT offer_id, ingested_at, employer_name, employer_url, employer_type, role_title, role_seniority, role_focus, role_scope, is_remote, is_hybrid, is_onsite, cities, contract_types, coe_from, b2b_from, req_technology, opt_technology, languages FROM offer)
SELECT offer_id, ingested_at, round((8 + (NOT regexp_full_match(employer_name, '[ \t\n\x0b\f\r\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]*') AND employer_name IS NOT NULL)::INT + (employer_url IS NOT NULL)::INT + (employer_type IS NOT NULL)::INT + (role_title IS NOT NULL)::INT + (role_seniority IS NOT NULL)::INT + (role_focus IS NOT NULL)::INT + (role_scope IS NOT NULL)::INT
 + (is_remote IS NOT NULL)::INT + (is_hybrid IS NOT NULL)::INT + (is_onsite IS NOT NULL)::INT + (nullif(coe_from, '') IS NOT NULL)::INT + (nullif(b2b_from, '') IS NOT NULL)::INT
 + (len(coalesce(cities, [])) > 0)::INT + (len(coalesce(contract_types, [])) > 0)::INT + (len(coalesce(req_technology, [])) > 0)::INT + (len(coalesce(opt_technology, [])) > 0)::INT + (len(coalesce(languages, [])) > 0)::INT
 + len(list_filter(coalesce(cities, []), lambda x: x IS NOT NULL AND NOT regexp_full_match(x, '[ \t\n\x0b\f\r\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]*'))) + len(list_filter(coalesce(contract_types, []), lambda x: x IS NOT NULL)) + len(list_filter(coalesce(req_technology, []), lambda x: x IS NOT NULL AND NOT regexp_full_match(x, '[ \t\n\x0b\f\r\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]*'))) + len(list_filter(coalesce(opt_technology, []), lambda x: x IS NOT NULL AND NOT regexp_full_match(x, '[ \t\n\x0b\f\r\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]*'))) + len(list_filter(coalesce(languages, []), lambda x: x IS NOT NULL AND NOT regexp_full_match(x, '[ \t\n\x0b\f\r\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]*'))))::DOUBLE
 / (47 + len(coalesce(cities, [])) + len(coalesce(contract_types, [])) + len(coalesce(req_technology, [])) + len(coalesce(opt_technology, [])) + len(coalesce(languages, []))), 6) AS quality FROM t""")
def schema_quality(spark: SparkSession, d: str) -> DataFrame:
    """Completeness of every offer as the common schema measures it."""
    o = table(spark, d, "offer")
    none = F.array().cast("array<string>")
    at = {"employer.name": "employer_name", "employer.url": "employer_url", "employer.type": "employer_type", "role.title": "role_title", "role.seniority": "role_seniority", "role.focus": "role_focus", "role.scope": "role_scope", "workplace.isRemote": "is_remote", "workplace.isHybrid": "is_hybrid", "workplace.isOnsite": "is_onsite",
          "workplace.cities": "cities", "contract.type": "contract_types", "salaryCoE.from": "coe_from", "salaryB2B.from": "b2b_from", "reqTechnology": "req_technology", "optTechnology": "opt_technology", "languages": "languages"}
    groups = []
    for name, spec in schema.FIELDS.items():
        col = lambda p, k: F.coalesce(F.col(at[p]), none) if p in at and schema.is_list(k) else F.col(at[p]) if p in at else none if schema.is_list(k) else F.lit(None).cast("boolean" if k == "flag" else "string")
        groups.append(F.struct(*[col(f"{name}.{x}", k).alias(x) for x, k, _ in spec]).alias(name) if isinstance(spec, list) else col(name, spec[0]).alias(name))
    return o.select("offer_id", "ingested_at", *at.values()).distinct().withColumn("job", F.struct(*groups)).select("offer_id", "ingested_at", F.round(schema.quality(F.col("job")), 6).alias("quality"))


@query("""WITH f AS (SELECT employer_name AS k, arg_min(employer_url, offer_id) FILTER (employer_url IS NOT NULL) AS u0, min(offer_id) AS a, max(offer_id) AS b FROM offer WHERE employer_name IS NOT NULL GROUP BY employer_name),
x AS (SELECT DISTINCT offer_id, employer_name, employer_url, employer_type, is_remote, list_filter(coalesce(cities, []), lambda x: x IS NOT NULL) AS cities FROM offer),
p AS (SELECT f.k, x1.employer_url AS u1, x2.employer_url AS u2, x1.employer_type AS t1, x2.employer_type AS t2, x1.is_remote AS r1, x2.is_remote AS r2, x1.cities AS c1, x2.cities AS c2 FROM f JOIN x x1 ON x1.offer_id = f.a JOIN x x2 ON x2.offer_id = f.b),
q AS (SELECT *, list_concat(c1, c2) AS c FROM p)
SELECT k AS employer_name, coalesce(nullif(u2, ''), u1) AS url, coalesce(nullif(t2, ''), t1) AS kind, coalesce(r2, r1)::VARCHAR AS remote,
 CASE WHEN len(c2) > 0 THEN array_to_string(list_filter(c, lambda x, i: list_position(list_transform(c, lambda y: lower(trim(y))), lower(trim(x))) = i), '|') ELSE array_to_string(c1, '|') END AS cities FROM q""")
def deep_merge(spark: SparkSession, d: str) -> DataFrame:
    """The first and the last posting of each spelling of an employer, merged."""
    o = table(spark, d, "offer").where("employer_name is not null")
    rec = F.struct(F.col("employer_url").alias("url"), F.col("employer_type").alias("kind"), F.col("is_remote").alias("remote"), F.filter(F.coalesce("cities", F.array().cast("array<string>")), lambda x: x.isNotNull()).alias("cities"))
    both = o.groupBy("employer_name").agg(F.min_by(rec, "offer_id").alias("a"), F.max_by(rec, "offer_id").alias("b"))
    full = lambda c: _as_record(F.col(c))
    m = both.select("employer_name", schema.merge(full("a"), full("b")).alias("m"))
    return m.select("employer_name", F.col("m.employer.url").alias("url"), F.col("m.employer.type").alias("kind"), F.col("m.workplace.isRemote").cast("string").alias("remote"), F.array_join("m.workplace.cities", "|").alias("cities"))


def _as_record(c):
    groups = []
    own = {"employer.url": c["url"], "employer.type": c["kind"], "workplace.isRemote": c["remote"], "workplace.cities": c["cities"]}
    for name, spec in schema.FIELDS.items():
        col = lambda p, k: own.get(p, F.array().cast("array<string>") if schema.is_list(k) else F.lit(None).cast("boolean" if k == "flag" else "string"))
        groups.append(F.struct(*[col(f"{name}.{x}", k).alias(x) for x, k, _ in spec]).alias(name) if isinstance(spec, list) else col(name, spec[0]).alias(name))
    return F.struct(*groups)


@query("""SELECT DISTINCT page_id, CASE WHEN contains(h, 'Application error: a client-side exception has occurred while loading justjoin.it') OR length(trim(h)) < 100 THEN 'remove' WHEN NOT regexp_matches(h, '(?i)<p[\\s>/]') THEN 'quarantine' ELSE 'advance' END AS action FROM (SELECT page_id, coalesce(html, '') AS h FROM raw_page)""")
def content_guard(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "raw_page").select("page_id", guards.content_guard(F.col("html"))["action"].alias("action")).distinct()


@query("""SELECT doc_id, CASE WHEN length(regexp_replace(coalesce(text, ''), '^[ \\t\\n\\x0b\\f\\r\\x{00a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x{feff}]+|[ \\t\\n\\x0b\\f\\r\\x{00a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x{feff}]+$', '', 'g')) < 100 THEN 'quarantine' ELSE 'advance' END AS action FROM documents""")
def not_empty_guard(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", guards.not_empty_guard(F.col("text"))["action"].alias("action"))


@query("""SELECT DISTINCT meta_id, CASE WHEN coalesce(canonical_url, '') = '' OR coalesce(len(alternate_urls), 0) = 0 OR url IS NOT DISTINCT FROM canonical_url THEN 'advance' ELSE 'trash' END AS action FROM offer_meta""")
def dedup_guard(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "offer_meta").select("meta_id", guards.duplicate_guard(F.col("url"), F.col("canonical_url"), F.col("alternate_urls"))["action"].alias("action")).distinct()


@query()
def expiration_guard(spark: SparkSession, d: str) -> DataFrame:
    """Expired, fresh and missing ends of all offers; ends in forms that can't be read count as
    fresh, which no SQL reads alike."""
    return table(spark, d, "offer_meta").select("meta_id", guards.expiration_guard(F.col("expires_at"), _now())["action"].alias("action")).distinct()


def _jobs(spark, d):
    return pipeline.offers_from_files(table(spark, d, "raw_file"), table(spark, d, "offer_meta"))


@query()
def pipeline_routes(spark: SparkSession, d: str) -> DataFrame:
    """The whole flow on all files: routes with their reasons, per source."""
    done = pipeline.run(_jobs(spark, d), _now())
    return done.groupBy("source", "decision.action", "decision.guard", "decision.message").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("quality"), 4).alias("mean_quality"))


_KEYS = f"""SELECT coalesce(f.job_id, CASE WHEN r.source = 'jji' THEN 'jji-' || nullif(r.j->>'guid', '') ELSE r.source || '-' || nullif(r.j->>'id', '') END) AS job_id, r.source, 'json' AS kind, r.j IS NOT NULL AS ok FROM ({_ROWS}) r JOIN (SELECT DISTINCT file_id, job_id FROM raw_file) f USING (file_id)
UNION ALL SELECT job_id, source, 'html', regexp_matches(replace(coalesce(payload, ''), chr(65279), ''), '</html>[\\r\\n\\t ]*$') FROM raw_file WHERE artifact = 'raw.job.html'"""


@query(f"""WITH t AS (SELECT job_id, max(source) AS source, bool_or(ok AND kind = 'json') AS js, bool_or(ok AND kind = 'html') AS ht FROM ({_KEYS}) WHERE job_id IS NOT NULL GROUP BY job_id)
SELECT source, count(*) AS n, count(*) FILTER (js AND ht) AS n_both, count(*) FILTER (js AND NOT ht) AS n_json, count(*) FILTER (ht AND NOT js) AS n_html FROM t GROUP BY source""")
def artifact_join(spark: SparkSession, d: str) -> DataFrame:
    """Jobs whose artifacts are all there, and those that wait."""
    w = pipeline.offers_from_files(table(spark, d, "raw_file"))
    j, h = F.col("json").isNotNull(), F.col("html").isNotNull()
    return w.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_if(j & h).alias("n_both"), F.count_if(j & ~h).alias("n_json"), F.count_if(h & ~j).alias("n_html"))


@query("""SELECT DISTINCT o.offer_id, o.job_id FROM offer o WHERE EXISTS (SELECT 1 FROM raw_page p WHERE p.job_id = o.job_id AND p.html IS NOT NULL) AND EXISTS (SELECT 1 FROM offer_meta m WHERE m.job_id = o.job_id)""")
def precondition_semi(spark: SparkSession, d: str) -> DataFrame:
    """Offers that have a page and metadata, which are not read."""
    o, p, m = (table(spark, d, n) for n in ("offer", "raw_page", "offer_meta"))
    return o.join(p.where("html is not null").select("job_id"), "job_id", "left_semi").join(m.select("job_id"), "job_id", "left_semi").select("offer_id", "job_id").distinct()


@query("""WITH k AS (SELECT DISTINCT job_id FROM raw_file WHERE job_id IS NOT NULL)
SELECT k.job_id, CASE WHEN k.job_id IN (SELECT job_id FROM offer WHERE job_id IS NOT NULL) THEN 'staging' WHEN k.job_id IN (SELECT job_id FROM raw_page WHERE job_id IS NOT NULL) THEN 'trash' WHEN k.job_id IN (SELECT job_id FROM documents WHERE job_id IS NOT NULL) THEN 'load' END AS skipped FROM k""")
def publish_anti(spark: SparkSession, d: str) -> DataFrame:
    """New jobs, and for known ones the first area that holds them."""
    areas = {"staging": table(spark, d, "offer"), "trash": table(spark, d, "raw_page"), "load": table(spark, d, "documents")}
    return state.unpublished(table(spark, d, "raw_file").where("job_id is not null").select("job_id").distinct(), areas).select("job_id", "skipped")


@query("""SELECT m.meta_id, max(p.n) IS NOT NULL AS hit, coalesce(max(p.n), 0) AS cached_pages FROM (SELECT DISTINCT meta_id, job_id FROM offer_meta) m LEFT JOIN (SELECT job_id, count(DISTINCT page_id) AS n FROM raw_page WHERE job_id IS NOT NULL GROUP BY job_id) p USING (job_id) GROUP BY m.meta_id""")
def cache_hit_left(spark: SparkSession, d: str) -> DataFrame:
    """Which offers find their page in the cache."""
    p = table(spark, d, "raw_page").where("job_id is not null").groupBy("job_id").agg(F.countDistinct("page_id").alias("n"))
    m = table(spark, d, "offer_meta").select("meta_id", "job_id").distinct()
    return m.join(p, "job_id", "left").groupBy("meta_id").agg(F.max("n").isNotNull().alias("hit"), F.coalesce(F.max("n"), F.lit(0)).alias("cached_pages"))


@query("""SELECT job_id, j IS NOT NULL AND (h IS NULL OR j > h) AS applicable, CASE WHEN j IS NOT NULL AND (h IS NULL OR j > h) THEN 'clean-job-json' WHEN h IS NOT NULL THEN 'clean-job-html' END AS stage
FROM (SELECT job_id, max(mtime) FILTER (artifact = 'raw.job.json') AS j, max(mtime) FILTER (artifact = 'raw.job.html') AS h FROM raw_file WHERE job_id IS NOT NULL GROUP BY job_id)""")
def stage_applicability(spark: SparkSession, d: str) -> DataFrame:
    """Whether a step has work (its input is newer than its output), and the first that has."""
    pick = lambda a: F.max(F.when(F.col("artifact") == a, F.col("mtime")))
    t = table(spark, d, "raw_file").where("job_id is not null").groupBy("job_id").agg(pick("raw.job.json").alias("j"), pick("raw.job.html").alias("h"))
    has = guards.applicable([F.col("j")], F.col("h"))
    return t.select("job_id", has.alias("applicable"), F.when(has, "clean-job-json").when(F.col("h").isNotNull(), "clean-job-html").alias("stage"))


@query("""WITH t AS (SELECT DISTINCT file_id, job_id, artifact, md5(coalesce(payload, '')) AS h FROM raw_file WHERE job_id IS NOT NULL), w AS (SELECT *, coalesce(lag(h) OVER (PARTITION BY job_id, artifact ORDER BY file_id) <> h, true) AS written FROM t)
SELECT artifact, count(*) AS n, count(*) FILTER (written) AS n_written FROM w GROUP BY artifact""")
def content_aware_write(spark: SparkSession, d: str) -> DataFrame:
    """Saves that change what is stored, and those that don't."""
    f = table(spark, d, "raw_file").where("job_id is not null").select("file_id", "job_id", "artifact", F.md5(F.coalesce("payload", F.lit(""))).alias("payload")).distinct()
    return state.versions(f, ["job_id", "artifact"], "file_id", "payload").groupBy("artifact").agg(F.count(F.lit(1)).alias("n"), F.count_if("written").alias("n_written"))


@query("""WITH u AS (SELECT DISTINCT job_id, 'trash' AS area, 0 AS k FROM raw_page WHERE job_id IS NOT NULL UNION ALL SELECT DISTINCT job_id, 'quarantine', 1 FROM documents WHERE job_id IS NOT NULL UNION ALL SELECT DISTINCT job_id, 'load', 2 FROM offer WHERE job_id IS NOT NULL), n AS (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY k) AS r FROM u)
SELECT CASE WHEN r = 1 THEN job_id ELSE job_id || '__from_' || area || '_' || r::VARCHAR END AS job_id, area FROM n""")
def repopulate_union(spark: SparkSession, d: str) -> DataFrame:
    """All areas back in one, with clashing names told apart."""
    own = lambda n: table(spark, d, n).where("job_id is not null")
    return state.repopulated({"trash": own("raw_page"), "quarantine": own("documents"), "load": own("offer")})


@query("""SELECT event_type AS counter, count(*) AS n, sum(value) AS total, max(value) AS gauge, count(DISTINCT user_id) AS users, bool_and(value >= 0) AS all_positive, bool_or(value > 400) AS any_high FROM events GROUP BY event_type""")
def counters(spark: SparkSession, d: str) -> DataFrame:
    """Counters, sums, largest values and distinct users per kind of event."""
    return table(spark, d, "events").groupBy(F.col("event_type").alias("counter")).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"), F.max("value").alias("gauge"), F.countDistinct("user_id").alias("users"), F.bool_and(F.col("value") >= 0).alias("all_positive"), F.bool_or(F.col("value") > 400).alias("any_high"))


@query("""WITH n AS (SELECT user_id, event_type, event_id, value, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS a, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS b FROM events)
SELECT user_id, event_type, max(event_id) FILTER (a = 1) AS first_event, max(value) FILTER (b = 1) AS last_value FROM n GROUP BY user_id, event_type""")
def first_and_last_wins(spark: SparkSession, d: str) -> DataFrame:
    """The first event and the last value of each user and kind, without a window."""
    at = F.struct("ts", "event_id")
    return table(spark, d, "events").groupBy("user_id", "event_type").agg(F.min_by("event_id", at).alias("first_event"), F.max_by("value", at).alias("last_value"))


@query("""WITH m AS (SELECT user_id, ts, event_id, (event_type = 'error')::INT AS bad, sum((event_type = 'error')::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM events),
r AS (SELECT user_id, run, sum(1 - bad) AS good, max(bad) AS b FROM m GROUP BY user_id, run)
SELECT user_id, sum(good)::BIGINT AS n_good, sum(b)::BIGINT AS n_failed, max(good)::BIGINT AS best_streak, arg_max(good, run)::BIGINT AS last_streak FROM r GROUP BY user_id""")
def streaks(spark: SparkSession, d: str) -> DataFrame:
    """Runs of successes per user, as the health of a source is judged."""
    return state.streaks(table(spark, d, "events"), "user_id", ["ts", "event_id"], F.col("event_type") == "error")


@query("""SELECT user_id, event_id, rank FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rank FROM events) WHERE rank <= 3""")
def lru_topk(spark: SparkSession, d: str) -> DataFrame:
    """What a cache of three entries per user still holds."""
    return state.recent(table(spark, d, "events"), ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()], 3).select("user_id", "event_id", F.col("rank").cast("bigint").alias("rank"))


@query("""WITH p AS (SELECT (event_id // 100)::BIGINT AS page, count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY 1), s AS (SELECT min(page) FILTER (errors >= 25) AS stop FROM p)
SELECT p.page, p.errors FROM p, s WHERE s.stop IS NULL OR p.page < s.stop""")
def pagination_stop(spark: SparkSession, d: str) -> DataFrame:
    """Pages before the first that meets the stop rule."""
    pages = table(spark, d, "events").groupBy(F.expr("event_id div 100").alias("page")).agg(F.count_if(F.col("event_type") == "error").alias("errors"))
    return listings.read_until(pages, "page", F.col("errors") >= 25).select("page", "errors")


@query("""SELECT p.r_name, p.page, e.pos, e.name FROM (SELECT r_regionkey AS page, r_name FROM region) p JOIN (SELECT n_regionkey AS page, (row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1)::INT AS pos, n_name AS name FROM nation) e USING (page)""")
def listing_records(spark: SparkSession, d: str) -> DataFrame:
    """Records of landed listing pages, one json envelope per region, in page order."""
    n = table(spark, d, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("data"))
    pages = n.join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("r_name", F.col("r_regionkey").alias("page"), F.to_json(F.struct("data")).alias("body"))
    return listings.records(pages, "body", "jji").select("r_name", "page", "pos", V.text(F.col("record"), "n_name").alias("name"))


@query("""SELECT line, count(*) AS sources FROM (SELECT DISTINCT source, trim(unnest(string_split(file_path, '/'))) AS line FROM raw_file) WHERE line <> '' GROUP BY line""")
def line_lists(spark: SparkSession, d: str) -> DataFrame:
    """Plain-text lists of several sources united, each entry once."""
    f = table(spark, d, "raw_file")
    lists = [listings.line_list(f.where(F.col("source") == s).select(F.replace("file_path", F.lit("/"), F.lit("\n")).alias("t")), "t").withColumn("source", F.lit(s)) for s in ("jji", "nfj", "bdj", "ptc")]
    both = lists[0]
    for x in lists[1:]:
        both = both.unionByName(x)
    return both.groupBy("line").agg(F.count(F.lit(1)).alias("sources"))


@query("""SELECT job_id, last_change, rank FROM (SELECT job_id, max(mtime) AS last_change, row_number() OVER (ORDER BY max(mtime), job_id) AS rank FROM raw_file WHERE job_id IS NOT NULL GROUP BY job_id HAVING max(mtime) < TIMESTAMP '2025-06-01')""")
def stalled_jobs(spark: SparkSession, d: str) -> DataFrame:
    """Jobs that haven't changed for long, the oldest first."""
    t = table(spark, d, "raw_file").where("job_id is not null").groupBy("job_id").agg(F.max("mtime").alias("last_change")).where(F.col("last_change") < F.lit("2025-06-01 00:00:00").cast("timestamp_ntz"))
    ranked = registry.numbered(t.withColumn("all", F.lit(0)), "all", ["last_change", "job_id"])
    return ranked.select("job_id", "last_change", F.col("no").cast("bigint").alias("rank"))


@query()
def enrich_stub(spark: SparkSession, d: str) -> DataFrame:
    """Enrichment by an injected client (here a stub), with completeness of its answers."""

    def ask(prompt: str) -> str:
        return json.dumps({"length": len(prompt), "offer": "Job offer" in prompt})

    rows = table(spark, d, "documents").where("text is not null").select(F.col("doc_id"), F.col("text").alias("md"))
    out = pipeline.enrich(rows, ask, "doc_id")
    v = F.try_parse_json("answer")
    return out.withColumn("v", v).select("doc_id", V.number(F.col("v"), "length").cast("bigint").alias("n"), V.flag(F.col("v"), "offer").alias("offer"), guards.answer_guard(registry.json_quality(F.col("answer")))["action"].alias("action"))


def _root(spark) -> str:
    return f"{shared_dir(spark).rstrip('/')}/areas/{uuid.uuid4().hex}"


@query()
def pipeline_sinks(spark: SparkSession, d: str) -> DataFrame:
    """The flow's routes as written: per area the jobs and those with an error record, and what a
    second run over the same input had to write, which is nothing."""
    root = _root(spark)
    done = pipeline.run(_jobs(spark, d), _now()).select("job_id", "source", F.to_json("combined").alias("record"), "md", "cache_path", "decision")
    like = sinks.route(done, root, _now(), ["source", "record", "md"])
    again = sinks.route(done, root, _now(), ["source", "record", "md"])
    schema_ = done.select("job_id", "source", "record", "md", sinks.error_record(_now()).alias("error"))
    both = None
    for area in sinks.AREA.values():
        own = sinks.stored(spark, f"{root}/{area}", schema_).select(F.lit(area).alias("area"), "source", F.lit(again[area]).alias("rewritten"), "error")
        both = own if both is None else both.unionByName(own)
    return both.groupBy("area", "source", "rewritten").agg(F.count(F.lit(1)).alias("n"), F.count("error").alias("n_errors"))


@query("""WITH m AS (SELECT job_id, arg_max({'url': url, 'c': canonical_url, 'a': alternate_urls}, (scraped_at, meta_id)) AS m FROM offer_meta WHERE job_id IS NOT NULL GROUP BY job_id)
SELECT job_id, CASE WHEN coalesce(m.c, '') = '' OR coalesce(len(m.a), 0) = 0 OR m.url IS NOT DISTINCT FROM m.c THEN 'staging' ELSE 'trash' END AS area, CASE WHEN coalesce(m.c, '') = '' OR coalesce(len(m.a), 0) = 0 OR m.url IS NOT DISTINCT FROM m.c THEN NULL ELSE 'clean-meta' END AS stage FROM m""")
def area_moves(spark: SparkSession, d: str) -> DataFrame:
    """Where each offer is after all were staged and duplicates then moved to the trash."""
    root = _root(spark)
    last = table(spark, d, "offer_meta").where("job_id is not null").groupBy("job_id").agg(F.max_by(F.struct("url", "canonical_url", "alternate_urls"), F.struct("scraped_at", "meta_id")).alias("m")).select("job_id", "m.*")
    staged = last.select("job_id", "url", guards.decision("advance", "inputs", "inputs missing").alias("decision"))
    sinks.route(staged, root, _now(), ["url"])
    judged = last.select("job_id", "url", guards.duplicate_guard(F.col("url"), F.col("canonical_url"), F.col("alternate_urls")).alias("decision"))
    sinks.route(judged, root, _now(), ["url"])
    schema_ = judged.select("job_id", "url", sinks.error_record(_now()).alias("error"))
    both = [sinks.stored(spark, f"{root}/{a}", schema_).select("job_id", F.lit(a).alias("area"), F.col("error.stage").alias("stage")) for a in ("staging", "trash")]
    return both[0].unionByName(both[1])


@query("""SELECT DISTINCT job_id FROM raw_file WHERE job_id IS NOT NULL AND job_id NOT IN (SELECT job_id FROM offer WHERE job_id IS NOT NULL) AND job_id NOT IN (SELECT job_id FROM raw_page WHERE job_id IS NOT NULL) AND job_id NOT IN (SELECT job_id FROM documents WHERE job_id IS NOT NULL)""")
def publish_write(spark: SparkSession, d: str) -> DataFrame:
    """The jobs that publishing wrote to staging: those that no area held."""
    root = _root(spark)
    new = table(spark, d, "raw_file").where("job_id is not null").select("job_id").distinct()
    sinks.publish(new, root, {"staging": table(spark, d, "offer"), "trash": table(spark, d, "raw_page"), "load": table(spark, d, "documents")})
    return sinks.stored(spark, f"{root}/staging", new)


@query("""SELECT md5(url) AS cache_key, substr(md5(url), 1, 2) || '/' || substr(md5(url), 3, 2) || '/' || substr(md5(url), 5, 28) || '.cache' AS cache_path, md5(max(html)) AS content_md5 FROM raw_page WHERE url IS NOT NULL GROUP BY url""")
def cache_write(spark: SparkSession, d: str) -> DataFrame:
    """The cache after all pages were written to it, by the hash of their url."""
    path = f"{_root(spark)}/cache"
    sinks.write_cache(table(spark, d, "raw_page"), path, "url", "html")
    like = table(spark, d, "raw_page").select(F.col("url").alias("cache_key"), F.col("url").alias("cache_path"), F.col("html").alias("content"))
    return sinks.stored(spark, path, like).select("cache_key", "cache_path", F.md5("content").alias("content_md5"))


@query("""WITH p AS (SELECT (event_id // 100)::BIGINT AS page, count(*) FILTER (event_type = 'error') AS n, max(CASE WHEN event_id % 100 < 50 THEN NULL ELSE 40 + event_id // 1000 END) AS total FROM events GROUP BY 1), t AS (SELECT arg_min(total, page) FILTER (total IS NOT NULL) AS total FROM p), s AS (SELECT min(page) FILTER (n = 0) AS stop FROM p, t WHERE t.total IS NULL OR page <= t.total)
SELECT page, n FROM p, t, s WHERE (t.total IS NULL OR page <= t.total) AND (s.stop IS NULL OR page < s.stop)""")
def counted_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages up to the number of pages that the first answer told."""
    pages = table(spark, d, "events").groupBy(F.expr("event_id div 100").alias("page")).agg(F.count_if(F.col("event_type") == "error").alias("n"), F.max(F.when(F.col("event_id") % 100 >= 50, 40 + F.expr("event_id div 1000"))).alias("total"))
    return listings.counted_pages(pages, "page", "total", "n").select("page", "n")
