"""Column functions over strings, arrays, urls and dates. All stay in the JVM.

Unless said otherwise null in gives null out, and empty texts are ordinary values."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: white space that trimming removes, as a character class
SPACE = r"[ \t\n\x0b\f\r\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"


def trim_all(c: Column) -> Column:
    """Trims every kind of white space, not only blanks."""
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def filled(c: Column) -> Column:
    """Trimmed text; null where nothing is left."""
    return F.nullif(trim_all(c), F.lit(""))


def _firsts(values: Column, keys: Column) -> Column:
    return F.filter(values, lambda x, i: F.array_position(keys, F.element_at(keys, (i + 1).cast("int"))) == i + 1)


def ci_dedup(values: Column) -> Column:
    """The first of each group of elements that are equal but for case; nulls count as ''."""
    return _firsts(values, F.transform(values, lambda x: F.coalesce(F.lower(x), F.lit(""))))


def normalize_string_array(values: Column) -> Column:
    """Trims, drops nulls and blanks, keeps the first of what is equal but for case. A null
    array gives an empty one."""
    clean = F.filter(F.transform(F.coalesce(values, F.array().cast("array<string>")), trim_all), lambda x: x.isNotNull() & (x != ""))
    return ci_dedup(clean)


def union_ci(a: Column, b: Column) -> Column:
    """Union of two arrays without regard to case and outer space; elements stay as they
    are, those of a come first. A null array counts as empty."""
    none = F.array().cast("array<string>")
    both = F.concat(F.coalesce(a, none), F.coalesce(b, none))
    return _firsts(both, F.transform(both, lambda x: F.coalesce(F.lower(trim_all(x)), F.lit("\x00null"))))


def seniority(c: Column) -> Column:
    """Level of a role in one spelling; unknown ones stay, in lower case."""
    s = F.lower(trim_all(c))
    return F.when(s == "trainee", "intern").when(s.isin("medium", "mid"), "regular").when(s == "c_level", "c-level").otherwise(F.nullif(s, F.lit("")))


def contract_type(c: Column) -> Column:
    """b2b/contractor, employment or other."""
    t = F.lower(c)
    return F.when(t.isin("b2b", "b2b/contractor"), "b2b/contractor").when(t.isin("permanent", "employment", "uop"), "employment").when(t.isNotNull(), "other")


def transliterate_polish(c: Column) -> Column:
    """Polish letters as plain lower-case ones."""
    return F.translate(c, "ąćęłńóśźżĄĆĘŁŃÓŚŹŻ", "acelnoszzacelnoszz")


def daily_key(c: Column, day: Column) -> Column:
    return F.md5(F.concat(c, F.lit("."), F.date_format(day, "yyyy-MM-dd")))


def weekly_key(c: Column, day: Column, compat: bool = False) -> Column:
    """Key of a week. ``compat`` counts weeks by rounding the time since New Year up, which
    in years that begin on a Friday is one more than the ISO week."""
    week = F.weekofyear(day)
    if compat:
        thursday = F.date_add(day, 4 - (F.weekday(day) + 1))
        first = F.make_date(F.year(thursday), F.lit(1), F.lit(1))
        week = F.ceil((F.datediff(thursday, first) + 1.5) / 7)
    return F.md5(F.concat(c, F.lit("."), week.cast("string")))


def key_path(key: Column) -> Column:
    """Two levels of folders from a key, so that none holds too many files."""
    return F.concat(F.substring(key, 1, 2), F.lit("/"), F.substring(key, 3, 2), F.lit("/"), F.substring(key, 5, 28), F.lit(".cache"))


def plain_url(c: Column) -> Column:
    """A url without query, fragment and final slash, in lower case, as https."""
    bare = F.regexp_replace(F.lower(trim_all(c)), r"[?#].*$", "")
    return F.regexp_replace(F.regexp_replace(bare, r"^http://", "https://"), r"/+$", "")


def with_slug(url: Column, slug: Column) -> Column:
    """A url with its last path segment replaced, in lower case and trimmed."""
    return F.lower(F.trim(F.concat(F.regexp_extract(url, r"^(.*/)[^/]*$", 1), slug)))


def canonical_slug(slugs: Column) -> Column:
    """The first slug with 'remote' among those ordered by length, else the shortest; of
    equal lengths the earlier. Null for an empty list."""
    clean = F.transform(F.filter(slugs, lambda s: s.isNotNull()), lambda s: F.lower(F.trim(s)))
    ranked = F.array_sort(F.transform(clean, lambda s, i: F.struct((~s.contains("remote")).cast("int").alias("r"), F.length(s).alias("n"), i.alias("i"), s.alias("s"))))
    return F.get(ranked, F.lit(0))["s"]


def dmy_to_iso(c: Column) -> Column:
    """D.M.YYYY as an ISO day; days and months that overflow roll over (31.02. is 3 March).
    Null for anything else."""
    ok = c.rlike(r"^\d{1,2}\.\d{1,2}\.\d{4}$")
    part = lambda i: F.regexp_extract(c, r"^(\d{1,2})\.(\d{1,2})\.(\d{4})$", i)
    year = F.when(ok, part(3)).cast("int")
    day = F.date_add(F.add_months(F.make_date(year, F.lit(1), F.lit(1)), F.when(ok, part(2)).cast("int") - 1), F.when(ok, part(1)).cast("int") - 1)
    return F.date_format(day, "yyyy-MM-dd")


def millis_to_iso(c: Column) -> Column:
    """Milliseconds since 1970 as ISO text with milliseconds and Z, in any session zone."""
    utc = F.timestamp_add("MICROSECOND", c * 1000, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def js_number(c: Column) -> Column:
    """A number as JavaScript writes it: no '.0' behind whole ones."""
    return F.when(c == F.floor(c), c.cast("decimal(38,0)").cast("string")).otherwise(c.cast("string"))


def collapse_blank_lines(c: Column) -> Column:
    """LF line ends, no blanks at the ends of lines, runs of empty lines as one."""
    lines = F.regexp_replace(F.replace(c, F.lit("\r\n"), F.lit("\n")), r"(?m)^ +| +$", "")
    # behind a line end, an empty line takes all empty lines after it along
    return F.regexp_replace(lines, r"(?<=\n)([\t ]*\n)[\t \n]*\n", "$1")


def header_key(c: Column) -> Column:
    """A table heading as a key: trimmed, lower case, runs of white space as one underscore."""
    return F.regexp_replace(F.lower(trim_all(c)), r"\s+", "_")


def offer_path(url: Column, folder: str = "/companies/jobs/", old: str = ".com", new: str = ".pl") -> Column:
    """A link of a listing as the url of an offer: below ``folder``, with a numbered name that is
    not a search, without query and fragment, on the board's present domain. Null for others."""
    bare = F.regexp_replace(trim_all(url), r"[?#].*$", "")
    name = F.regexp_extract(bare, rf"^https?://[^/]+{folder}(.+)$", 1)
    return F.when(name.rlike(r"^\d+-") & ~name.startswith("s/"), F.regexp_replace(bare, rf"^(https?://[^/]+){re.escape(old)}/", rf"$1{new}/"))


def clamp(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))
