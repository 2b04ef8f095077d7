"""Listing records of each board to the common schema, as plain projections.

Every cleaner takes ``v`` (the record as VARIANT) and gives ``job`` (the record in the
common schema) and ``error`` (the first rule that the record breaks, null if none). A
record with an error has no job. Null and unreadable records are errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema
from ..functions import text as X
from ..functions import variant as V

NFJ_LOGOS = "https://static.nofluffjobs.com/"  # fixed value: prefix of logo addresses


def _kinds(items: Column, kind: str) -> Column:
    return F.forall(items, lambda s: V.kind(s) == kind)


def _strings(items: Column) -> Column:
    return F.transform(items, lambda s: F.try_variant_get(s, "$", "string"))


def _amount(entry: Column, path: str) -> Column:
    return X.js_number(V.number(entry, path))


Parts = tuple[dict[str, Column], Column]  # values by path, and the first error


def _cleaned(df: DataFrame, parts: dict[str | None, Parts]) -> DataFrame:
    """Two projections for any number of cleaners, so that the plan is analysed twice only."""
    own = list(parts.items())
    first = df.select("*", *[e.alias(f"_error_{k}") for k, (_, (_, e)) in enumerate(own)])
    error, job = F.lit("no transformation for source"), F.lit(None).cast(schema.struct_type())
    for k, (name, (values, _)) in enumerate(own):
        mine = F.lit(True) if name is None else F.col("source") == name
        error = F.when(mine, F.col(f"_error_{k}")).otherwise(error)
        job = F.when(mine & F.col(f"_error_{k}").isNull(), schema.record(values)).otherwise(job)
    return first.select(*df.columns, job.alias("job"), error.alias("error"))


def clean_jji(df: DataFrame) -> DataFrame:
    return _cleaned(df, {None: jji_parts()})


def clean_nfj(df: DataFrame) -> DataFrame:
    return _cleaned(df, {None: nfj_parts()})


def clean_bdj(df: DataFrame, crossed: bool = True) -> DataFrame:
    return _cleaned(df, {None: bdj_parts(crossed)})


def jji_parts() -> Parts:
    """Salaries come from the first entry of each contract type. Skills of level 1 and 2
    are dropped, as the original drops them; mixed lists give no required skills."""
    r = V.Reader(F.col("v"))
    entries = r.items("employmentTypes")
    r.check(~F.forall(entries, lambda e: F.coalesce(V.kind(V.get(e, "type")), F.lit("")) == "STRING"), '"employmentTypes.type" is not string')
    types = F.transform(entries, lambda e: X.contract_type(V.text(e, "type")))
    b2b = F.get(F.filter(entries, lambda e: X.contract_type(V.text(e, "type")) == "b2b/contractor"), F.lit(0))
    coe = F.get(F.filter(entries, lambda e: X.contract_type(V.text(e, "type")) == "employment"), F.lit(0))
    values = {"employer.name": r.text("companyName"), "employer.logo": r.text("companyLogoThumbUrl"), "role.title": r.text("title"), "role.seniority": X.seniority(r.optional_text("experienceLevel"))}
    where = F.lower(X.trim_all(r.text("workplaceType")))
    values |= {"workplace.isRemote": where == "remote", "workplace.isHybrid": where == "hybrid", "workplace.isOnsite": where == "office"}
    places = V.items(F.col("v"), "multilocation")
    many = V.kind(V.get(F.col("v"), "multilocation"))
    r.check(many.isNotNull() & (many != "ARRAY"), '"multilocation" is not array')
    r.check(~F.forall(places, lambda p: F.coalesce(V.kind(V.get(p, "city")), F.lit("")) == "STRING"), '"multilocation.city" is not string')
    values |= {"workplace.cities": F.transform(places, lambda p: V.text(p, "city")), "contract.type": types}
    for name, entry in (("salaryCoE", coe), ("salaryB2B", b2b)):
        for leaf, kind in (("from", "NUMBER"), ("to", "NUMBER"), ("currency", "STRING"), ("unit", "STRING")):
            k = V.kind(V.get(entry, leaf))
            r.check(entry.isNotNull() & (k.isNull() | ((k != kind) & (k != "NULL"))), f'"{leaf}" is not {kind.lower()}')
            values[f"{name}.{leaf}"] = _amount(entry, leaf) if kind == "NUMBER" else F.lower(V.text(entry, leaf)) if leaf == "unit" else V.text(entry, leaf)
    asked = V.get(F.col("v"), "requiredSkills")
    skills, nice = V.items(F.col("v"), "requiredSkills"), V.items(F.col("v"), "niceToHaveSkills")
    r.check(asked.isNotNull() & V.get(F.col("v"), "niceToHaveSkills").isNull(), 'No entry at path "niceToHaveSkills"')
    r.check(asked.isNotNull() & ~_kinds(nice, "STRING"), '"niceToHaveSkills" is not string')
    objects = F.forall(skills, lambda s: V.kind(s).isin("OBJECT", "NULL", "ARRAY"))
    r.check((F.size(skills) > 0) & objects & ~F.forall(skills, lambda s: F.coalesce(V.kind(V.get(s, "level")), F.lit("")) == "NUMBER"), 'No entry at path "level"')
    high = F.transform(F.filter(skills, lambda s: V.number(s, "level") > 2), lambda s: V.text(s, "name"))
    required = F.when((F.size(skills) > 0) & _kinds(skills, "STRING"), _strings(skills)).when((F.size(skills) > 0) & objects, high)
    values |= {"reqTechnology": X.normalize_string_array(required), "optTechnology": X.normalize_string_array(F.when(asked.isNotNull(), _strings(nice)))}
    return values, r.error()


def nfj_parts() -> Parts:
    """A salary without a contract type counts for both; several levels are joined (and so
    leave the domain, which validity reports)."""
    v, r = F.col("v"), V.Reader(F.col("v"))
    values = {"employer.name": r.text("name")}
    logo = V.kind(V.get(v, "logo.original"))
    r.check(logo.isNull() | ~logo.isin("NULL", "STRING"), 'No entry at path "original"')
    values |= {"employer.logo": F.concat(F.lit(NFJ_LOGOS), V.text(v, "logo.original")), "role.title": r.text("title")}
    levels = V.kind(V.get(v, "seniority"))
    r.check(levels.isNotNull() & (levels != "ARRAY"), '"seniority" is not array')
    named = F.filter(F.transform(F.filter(V.items(v, "seniority"), lambda s: V.kind(s) == "STRING"), lambda s: X.filled(F.try_variant_get(s, "$", "string"))), lambda s: s.isNotNull())
    values["role.seniority"] = X.seniority(F.array_join(named, ", "))
    values["workplace.isRemote"] = F.coalesce(V.flag(v, "location.fullyRemote"), F.lit(False)) | F.coalesce(V.flag(v, "fullyRemote"), F.lit(False))
    places = F.transform(V.items(v, "location.places"), lambda p: F.coalesce(X.filled(V.text(p, "city")), X.filled(V.text(p, "province"))))
    values["workplace.cities"] = X.normalize_string_array(places)
    pay = V.kind(V.get(v, "salary")) == "OBJECT"
    kind = X.contract_type(F.nullif(V.text(v, "salary.type"), F.lit("")))
    values["contract.type"] = F.when(pay & kind.isNotNull(), F.array(kind)).otherwise(F.array().cast("array<string>"))
    low = F.coalesce(V.number(v, "salary.from"), V.number(v, "salary.min"))
    high = F.coalesce(V.number(v, "salary.to"), V.number(v, "salary.max"), low)
    period = V.text(v, "salary.period")
    unit = F.when(period.isin("m", "month"), "month").when(period.isin("h", "hour"), "hour").when(period.isin("y", "year"), "year").otherwise(F.coalesce(F.nullif(period, F.lit("")), F.lit("month")))
    for name, other in (("salaryCoE", "b2b/contractor"), ("salaryB2B", "employment")):
        own = F.coalesce(pay, F.lit(False)) & (F.coalesce(kind, F.lit("")) != other)
        for leaf, c in (("from", X.js_number(low)), ("to", X.js_number(high)), ("currency", V.text(v, "salary.currency")), ("unit", unit)):
            values[f"{name}.{leaf}"] = F.when(own, c)
    tiles = F.filter(V.items(v, "tiles.values"), lambda t: V.text(t, "type") == "requirement")
    values["reqTechnology"] = X.normalize_string_array(F.concat(F.transform(tiles, lambda t: V.text(t, "value")), F.array(V.text(v, "technology"))))
    return values, r.error()


def bdj_parts(crossed: bool = True) -> Parts:
    """``crossed`` keeps the original's habit of giving the pay of B2B offers as salaryCoE
    and that of employment as salaryB2B."""
    v, r = F.col("v"), V.Reader(F.col("v"))
    scope = F.replace(F.lower(r.text("employmentType")), F.lit("_"), F.lit("-"))
    r.present("contractOther")
    other = F.coalesce(V.flag(v, "contractOther"), F.lit(False))
    scope = F.when((scope == "freelance") | ((scope == "contractor") & other), "project").when(scope == "contractor", "full-time").otherwise(scope)
    values = {"employer.name": r.text("company.name"), "employer.logo": r.text("company.logo.url"), "role.title": r.text("position"), "role.seniority": X.seniority(r.text("experienceLevel")), "role.scope": scope}
    values["workplace.isRemote"] = r.flag("remote")
    values["workplace.cities"] = F.filter(F.array(r.text("city")), lambda c: c != "")
    r.present("contractB2b")
    r.present("contractEmployment")
    flags = [(V.flag(v, "contractB2b"), "b2b/contractor"), (V.flag(v, "contractEmployment"), "employment"), (V.flag(v, "contractOther"), "other")]
    values["contract.type"] = X.normalize_string_array(F.array(*[F.when(c, name) for c, name in flags]))
    money = F.nullif(V.text(v, "denominatedSalaryLong.money"), F.lit(""))
    low = F.when(money.contains("-"), F.trim(F.get(F.split(money, "-"), F.lit(0)))).when(F.lower(money).startswith("from"), F.substring(money, 5, 1000))
    high = F.when(money.contains("-"), F.trim(F.get(F.split(money, "-"), F.lit(1))))
    b2b, coe = F.coalesce(flags[0][0], F.lit(False)), F.coalesce(flags[1][0], F.lit(False))
    # pay is read where a contract asks for it, and then strictly
    pay = V.kind(V.get(v, "denominatedSalaryLong.money"))
    there = pay.isNotNull() & (pay != "NULL") & ~((pay == "STRING") & (V.text(v, "denominatedSalaryLong.money") == "")) & ~((pay == "ARRAY") & (F.size(V.items(v, "denominatedSalaryLong.money")) == 0))
    coin = V.kind(V.get(v, "denominatedSalaryLong.currency"))
    r.check((b2b | coe) & there & (pay != "STRING"), '"denominatedSalaryLong.money" is not string')
    r.check((b2b | coe) & there & coin.isNull(), 'No entry at path "currency"')
    r.check((b2b | coe) & there & (coin != "STRING"), '"denominatedSalaryLong.currency" is not string')
    for name, own in (("salaryCoE", b2b if crossed else coe), ("salaryB2B", coe if crossed else b2b)):
        for leaf, c in (("from", low), ("to", high), ("currency", V.text(v, "denominatedSalaryLong.currency")), ("unit", F.lit("month"))):
            values[f"{name}.{leaf}"] = F.when(own & money.isNotNull(), c)
    tags = V.items(v, "technologyTags")
    r.check(~_kinds(tags, "STRING"), '"technologyTags" is not string')
    values["reqTechnology"] = X.normalize_string_array(_strings(tags))
    return values, r.error()


#: cleaners by source; a source without one is an error of its rows
CLEANERS = {"jji": jji_parts, "nfj": nfj_parts, "bdj": bdj_parts}


def clean(df: DataFrame) -> DataFrame:
    """Dispatches rows by ``source`` to their cleaner in one pass over the input; rows of
    other sources get the error 'no transformation for source'."""
    return _cleaned(df, {name: f() for name, f in CLEANERS.items()})


def clean_meta(df: DataFrame, now: Column) -> DataFrame:
    """Adds ``meta`` (published, expires, updated, canonical url and alternates of an offer) and
    ``meta_error`` (the first rule that is broken, null if none), from its record ``v``, its
    ``page`` and own ``url``. Times are ISO texts.

    jji tells both times in its record and nfj when it was posted; a record without them is an
    error. bdj tells them in the state embedded in its page, the end also as a paragraph of the
    page, which goes first; without an end it expires 31 days from ``now``."""
    v, url, md = F.col("v"), F.col("url"), F.coalesce(F.col("page.md"), F.lit(""))
    stamp = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
    slugs = F.transform(V.items(v, "location.places"), lambda p: V.text(p, "url"))
    until = X.dmy_to_iso(F.get(F.filter(F.split(F.regexp_extract(md, r"(?m)^- Offer valid until: (.+)$", 1), " "), lambda w: w.contains(".")), F.lit(0)))
    today = F.when(md.rlike(r"(?m)^- Offer expires today$"), F.date_format(now, "yyyy-MM-dd'T'23:59:ss.SSS'Z'"))
    midnight = lambda day: F.concat(day, F.lit("T00:00:00.000Z"))
    none, alone = F.lit(None).cast("string"), F.array().cast("array<string>")
    row = lambda a, b, c, d, e: F.struct(a.alias("published_at"), b.alias("expires_at"), c.alias("updated_at"), d.alias("canonical_url"), e.alias("alternate_urls"))
    nfj = row(X.millis_to_iso(V.number(v, "posted").cast("bigint")), F.coalesce(today, midnight(until)), X.millis_to_iso(V.number(v, "renewed").cast("bigint")), X.with_slug(url, X.canonical_slug(slugs)), F.transform(slugs, lambda s: X.with_slug(url, s)))
    jji = row(V.text(v, "publishedAt"), V.text(v, "expiredAt"), none, url, alone)
    state = F.try_parse_json(F.get(F.col("page.app_json"), F.lit(0)))
    told = lambda leaf: F.nullif(V.text(state, f"props.pageProps.data.job.{leaf}"), F.lit(""))
    late = F.date_format(F.timestamp_add("DAY", F.lit(31), now), stamp)
    bdj = row(told("publishedAt"), F.coalesce(midnight(X.dmy_to_iso(F.col("page.ends"))), told("endsAt"), late), none, url, alone)
    jji_error, nfj_error = V.Reader(v), V.Reader(v)
    jji_error.text("publishedAt")
    jji_error.text("expiredAt")
    nfj_error.number("posted")
    return df.withColumns({
        "meta": F.when(F.col("source") == "nfj", nfj).when(F.col("source") == "jji", jji).when(F.col("source") == "bdj", bdj),
        "meta_error": F.when(F.col("source") == "jji", jji_error.error()).when(F.col("source") == "nfj", nfj_error.error()),
    })
