"""Timestamps in mixed formats and zones to one UTC instant (problem 5).

Each value is brought by one pattern per format family into a common row of
parts; numeric dates get two readings (day first and month first). A mixture of
formats per source is then fitted by expectation-maximisation on counts of
reading patterns, which are aggregated before anything moves; its posteriors
choose the reading and mark what stays ambiguous.
"""

from __future__ import annotations

import zoneinfo

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: month names by number, in English, Polish and German
MONTHS = {
    1: "jan january stycznia styczeń sty januar jänner",
    2: "feb february lutego luty lut februar",
    3: "mar march marca marzec märz",
    4: "apr april kwietnia kwiecień kwi",
    5: "may maja maj mai",
    6: "jun june czerwca czerwiec cze juni",
    7: "jul july lipca lipiec lip juli",
    8: "aug august sierpnia sierpień sie",
    9: "sep sept september września wrzesień wrz",
    10: "oct october października październik paź oktober okt",
    11: "nov november listopada listopad lis",
    12: "dec december grudnia grudzień gru dezember dez",
}
# fixed values: offsets in minutes of zone abbreviations
ZONES = {
    "z": 0, "utc": 0, "gmt": 0, "wet": 0, "bst": 60, "west": 60, "cet": 60, "cest": 120, "mez": 60, "mesz": 120,
    "eet": 120, "eest": 180, "est": -300, "edt": -240, "cst": -360, "cdt": -300, "mst": -420, "mdt": -360, "pst": -480, "pdt": -420,
}

_ZONE = r"(?:\s*(z|[a-z]{3,4}|(?:utc|gmt)?\s?[+-]\d{2}:?\d{2}|\[?[a-z]+(?:/[a-z_+-]+)+\]?))?"
_TIME = r"(?:,?\s+(?:godz\.?\s*|o\s+|at\s+|um\s+)?(\d{1,2})[:.](\d{2})(?:[:.](\d{2})(?:[.,](\d+))?)?\s*([ap]m)?)?"
_NAME = r"([\p{L}]{3,})\.?"
#: family: pattern and the row of parts year|month|day|hour|minute|second|fraction|am-pm|zone
FAMILIES = {
    "iso": (r"(?iU)^(\d{4})-(\d{2})-(\d{2})(?:[t ](\d{2}):(\d{2})(?::(\d{2})(?:[.,](\d+))?)?" + _ZONE + r")?$", "$1|$2|$3|$4|$5|$6|$7||$8"),
    "compact": (r"(?iU)^(\d{4})(\d{2})(\d{2})t(\d{2})(\d{2})(\d{2})?" + _ZONE + "$", "$1|$2|$3|$4|$5|$6|||$7"),
    "numeric": (r"(?iU)^(\d{1,2})([./-])(\d{1,2})\2(\d{4}|\d{2})(?:\s*r\.?)?" + _TIME + _ZONE + "$", "$4|$3|$1|$5|$6|$7|$8|$9|$10"),
    "day_name": (r"(?iU)^(?:[\p{L}]{2,},?\s+)?(\d{1,2})[.]?[ -]" + _NAME + r"[ -](\d{4}|\d{2})(?:\s*r\.?)?" + _TIME + _ZONE + "$", "$3|$2|$1|$4|$5|$6|$7|$8|$9"),
    "name_day": (r"(?iU)^(?:[\p{L}]{2,},\s+)?" + _NAME + r"\s+(\d{1,2}),?\s+(\d{4})" + _TIME + _ZONE + "$", "$3|$1|$2|$4|$5|$6|$7|$8|$9"),
}


def _lookup(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for k, v in pairs.items() for x in (k, v)])


def _micros(y: Column, m: Column, d: Column, h: Column, mi: Column, s: Column, frac: Column) -> Column:
    """Microseconds of a wall-clock time, null where it names no real time."""
    ok = m.between(1, 12) & d.between(1, 31) & h.between(0, 23) & mi.between(0, 59) & s.between(0, 59) & y.between(1, 9999)
    day = F.try_to_date(F.format_string("%04d-%02d-%02d", y, m, d), "yyyy-MM-dd")
    days = F.datediff(day, F.lit("1970-01-01").cast("date")).cast("bigint")
    return F.when(ok, ((days * 24 + h) * 60 + mi) * 60000000 + s.cast("bigint") * 1000000 + frac)


def _to_utc(wall: Column, zone: Column, offset: Column) -> Column:
    """By offset if there is one, else by the rules of the zone: a time that occurs
    twice is the first of both, a skipped one moves on by the gap's length."""
    local = F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(wall), zone))
    return F.when(offset.isNotNull(), wall - offset.cast("bigint") * 60000000).otherwise(local)


def readings(df: DataFrame, value: str, zone: str, order: str) -> DataFrame:
    """Adds family, day_first and month_first (UTC microseconds or null) and form.

    Null, empty and unreadable values get null readings and form 'none'. A number
    of 10, 13, 16 or 19 digits counts as seconds to nanoseconds since 1970."""
    text = F.trim(F.regexp_replace(F.col(value), r"(?U)[\s\x{00a0}\x{202f}\ufeff\x{200b}]+", " "))
    df = df.withColumn("_t", text)
    family = F.when(F.col("_t").rlike(r"^\d{10}$|^\d{13}$|^\d{16}$|^\d{19}$"), "epoch")
    for name, (pattern, _) in FAMILIES.items():
        family = family.when(F.col("_t").rlike(pattern), name)
    df = df.withColumn("family", family)
    parts = F.lit(None)
    for name, (pattern, row) in FAMILIES.items():
        parts = F.when(F.col("family") == name, F.regexp_replace("_t", pattern, row)).otherwise(parts)
    df = df.withColumn("_p", F.split(parts, r"\|"))
    part = lambda i: F.nullif(F.col("_p")[i], F.lit(""))
    number = lambda i: F.expr(f"try_cast(nullif(_p[{i}],'') as int)")
    months = _lookup({w: n for n, words in MONTHS.items() for w in words.split()})
    year = F.when(number(0) < 100, number(0) + 2000).otherwise(number(0))
    half = F.lower(part(7))
    hour = F.coalesce(number(3), F.lit(0))
    hour = F.when(half.isNull(), hour).when(hour.between(1, 12), hour % 12 + F.when(half == "pm", 12).otherwise(0))
    named = F.element_at(months, F.lower(part(1)))
    second = F.coalesce(number(5), F.lit(0))
    frac = F.expr("coalesce(try_cast(rpad(substring(nullif(_p[6],''),1,6),6,'0') as bigint),0)")
    df = df.withColumns({"_y": year, "_m": F.coalesce(number(1), named), "_d": number(2), "_h": hour, "_i": F.coalesce(number(4), F.lit(0)), "_s": second, "_f": frac})
    tail = F.regexp_replace(F.lower(part(8)), r"[\[\] ]", "")
    sign = F.regexp_extract(tail, r"([+-])(\d{2}):?(\d{2})$", 1)
    shift = F.when(sign != "", F.when(sign == "-", -1).otherwise(1) * (F.expr(r"try_cast(regexp_extract(_z, '([+-])(\\d{2}):?(\\d{2})$', 2) as int)") * 60 + F.expr(r"try_cast(regexp_extract(_z, '([+-])(\\d{2}):?(\\d{2})$', 3) as int)")))
    df = df.withColumn("_z", tail).withColumn("_o", F.coalesce(shift, F.element_at(_lookup(ZONES), tail)))
    known = sorted(z for z in zoneinfo.available_timezones() if "/" in z and not z.startswith(("posix", "right")))
    proper = F.element_at(_lookup({z.lower(): z for z in known}), F.col("_z"))
    df = df.withColumn("_zone", F.coalesce(F.when(F.col("_z").contains("/"), proper), F.when(F.col("_z").isNull(), F.col(zone))))
    readable = F.col("_z").isNull() | F.col("_o").isNotNull() | F.col("_zone").isNotNull()
    wall = lambda m, d: F.when(readable, _micros(F.col("_y"), F.col(m), F.col(d), F.col("_h"), F.col("_i"), F.col("_s"), F.col("_f")))
    df = df.withColumns({"_dm": wall("_m", "_d"), "_md": F.when(F.col("family") == "numeric", wall("_d", "_m"))})
    where = F.coalesce(F.col("_zone"), F.lit("UTC"))
    digits = F.expr("try_cast(_t as bigint)")
    size = F.length("_t")
    epoch = F.when(size == 10, digits * 1000000).when(size == 13, digits * 1000).when(size == 16, digits).when(size == 19, F.floor(digits / 1000).cast("bigint"))
    has = F.col("_o").isNotNull() | F.col("_zone").isNotNull()
    df = df.withColumn("day_first", F.when(F.col("family") == "epoch", epoch).when(has, _to_utc(F.col("_dm"), where, F.col("_o"))))
    df = df.withColumn("month_first", F.when(has, _to_utc(F.col("_md"), where, F.col("_o"))))
    again = lambda utc, wall_: F.col("_o").isNull() & (F.from_utc_timestamp(F.timestamp_micros(utc + 3_600_000_000), where) == F.timestamp_micros(wall_))
    df = df.withColumn("day_twice", F.coalesce(again(F.col("day_first"), F.col("_dm")), F.lit(False))).withColumn("month_twice", F.coalesce(again(F.col("month_first"), F.col("_md")), F.lit(False)))
    d, m = F.col("day_first").isNotNull(), F.col("month_first").isNotNull()
    form = F.when(F.col("family") != "numeric", F.when(d, F.col("family")).otherwise("none"))
    form = F.coalesce(form, F.when(d & m, F.when(F.col("day_first") == F.col("month_first"), "num_same").otherwise("num_either")).when(d, "num_day").when(m, "num_month").otherwise("none"))
    df = df.withColumn("form", F.coalesce(form, F.lit("none"))).withColumn("declared", F.upper(F.col(order)))
    return df.drop("_t", "_p", "_y", "_m", "_d", "_h", "_i", "_s", "_f", "_z", "_o", "_zone", "_dm", "_md")


#: formats that each form can have been written in
_CAN = {"num_either": ("day_first", "month_first"), "num_same": ("day_first", "month_first"), "num_day": ("day_first",), "num_month": ("month_first",)}


def fit_mixture(counts: pd.DataFrame, rounds: int = 500, weight: float = 10.0) -> pd.DataFrame:
    """EM for one source over counts of forms.

    The weights of the formats start at a weak prior in which the declared order has
    ``weight`` pseudo-values, so that a source whose values say otherwise is followed;
    without a declaration both orders start equal and the unambiguous values (a day above
    12) decide. Gives, per form, the posterior of
    day_first and the chosen reading."""
    formats = sorted({f for form in counts.form for f in _CAN.get(form, (form,))} | {"day_first", "month_first"})
    declared = next((o for o in counts.declared if isinstance(o, str)), None)
    prior = {f: 1.0 for f in formats}
    if declared in ("DMY", "MDY"):
        prior["day_first" if declared == "DMY" else "month_first"] += weight
    total = sum(prior.values())
    pi = {f: p / total for f, p in prior.items()}
    for _ in range(rounds):
        got = dict(prior)
        for form, n in zip(counts.form, counts.n):
            options = _CAN.get(form, (form,))
            mass = sum(pi[f] for f in options)
            for f in options:
                got[f] += n * pi[f] / mass
        total = sum(got.values())
        new = {f: g / total for f, g in got.items()}
        done = max(abs(new[f] - pi[f]) for f in formats) < 1e-12
        pi = new
        if done:
            break
    rows = []
    for form, n in zip(counts.form, counts.n):
        options = _CAN.get(form, (form,))
        mass = sum(pi[f] for f in options)
        best = max(options, key=lambda f: pi[f])
        rows.append((form, int(n), best, pi[best] / mass, pi[best]))
    return pd.DataFrame(rows, columns=["form", "n", "reading", "posterior", "weight"])


def mixtures(read: DataFrame, source: str = "source") -> DataFrame:
    """(source, form, n, reading, posterior, weight) of every source."""
    counts = read.groupBy(F.col(source).alias("source"), "form").agg(F.count(F.lit(1)).alias("n"), F.max("declared").alias("declared"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        out = fit_mixture(pdf)
        out.insert(0, "source", pdf.source.iloc[0])
        return out

    return counts.groupBy("source").applyInPandas(fit, "source string, form string, n bigint, reading string, posterior double, weight double")


def normalise(df: DataFrame, boards: DataFrame, key: str, fields: list[str], sure: float = 0.9) -> DataFrame:
    """(key, field_name, source, family, utc_us, reading, posterior, ambiguous), a row
    per key and field with a value. Repeated rows count once. ``ambiguous`` marks
    numeric dates whose reading has a posterior under ``sure``, ``twice`` local times that
    occur twice as clocks go back (the first is taken). A source that boards
    doesn't hold has zone UTC and no declared order."""
    pairs = F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("value")) for f in fields])
    rows = df.select(key, "source", F.explode(pairs).alias("p")).select(key, "source", "p.*").where("value is not null").distinct()
    board = boards.select("source", "zone_name", "date_order").dropDuplicates(["source"])
    rows = rows.join(board, "source", "left").withColumn("zone_name", F.coalesce("zone_name", F.lit("UTC")))
    read = readings(rows, "value", "zone_name", "date_order")
    fitted = mixtures(read).select("source", "form", "reading", "posterior")
    both = read.join(fitted, (read.source.eqNullSafe(fitted.source)) & (read.form == fitted.form), "left").drop(fitted.source).drop(fitted.form)
    taken = F.when(F.col("reading") == "month_first", F.col("month_first")).otherwise(F.col("day_first"))
    chosen = F.when(F.col("form") == "none", None).otherwise(taken)
    twice = F.when(F.col("reading") == "month_first", F.col("month_twice")).otherwise(F.col("day_twice"))
    return both.withColumn("utc_us", chosen).withColumn("twice", F.coalesce(twice, F.lit(False))).drop("day_twice", "month_twice").withColumn("ambiguous", (F.col("form") == "num_either") & (F.col("posterior") < sure))
