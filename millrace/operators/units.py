"""Amounts in mixed currencies, periods and notations to one unit (problem 2).

Every salary is described by pieces of evidence (its texts, its own columns, the
listing's period). Each piece offers scales, currencies and units; identities among
the columns (both bounds share currency, unit and scale; lower <= upper) rule
combinations out, and of those left the one with the smallest log residual
|ln(upper/lower)| is taken. Combinations with nearly equal residuals are marked as
not unique. All in built-in expressions; the two rate tables join as small tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# fixed values: spellings of currencies, as patterns over lower-case text
CURRENCIES = {
    "PLN": r"zł|zl|zlotych|złotych|pln",
    "EUR": r"€|eur|euro|euros",
    "USD": r"us\$|\$|usd|dollars?",
    "GBP": r"£|gbp|pounds?",
    "CHF": r"chf|fr\.?|sfr",
    "CZK": r"kč|kc|czk",
    "UAH": r"₴|uah|грн\.?|hrn",
}
# fixed values: spellings of pay periods
UNITS = {
    "hour": r"h|hr|hrs|hour|hours|hourly|godz\.?|godzin[aęey]?|std\.?|stunde",
    "day": r"d|md|day|days|daily|man-day|manday|dzień|dnia|dziennie|dniówka|tag",
    "week": r"w|wk|week|weekly|tydz\.?|tydzień|tygodniowo|woche",
    "month": r"m|mth|mo|month|months|monthly|mies\.?|miesiąc|miesięcznie|m-c|mc|monat",
    "year": r"y|yr|year|yearly|annum|p\.a\.?|pa|rok|roku|rocznie|annual|annually|jahr",
}
_LETTER = r"[\p{L}]"
_NUMBER = r"(?<![\d.,])(\d{1,3}(?:[  \x{00a0}\x{202f}\x{2009}.,'](?=\d{3}(?!\d))\d{3})+|\d+)(?:[.,](\d{1,2})(?!\d))?\s*(k(?![\p{L}])|tys\.?|tsd\.?|thousand)?"


def _first(text: Column, table: dict[str, str], whole: bool = False) -> Column:
    """The first key of table one of whose spellings stands in text."""
    out = F.lit(None).cast("string")
    for name, spellings in reversed(table.items()):
        words = rf"^(?:{spellings})$" if whole else rf"(?<!{_LETTER})(?:{spellings})(?!{_LETTER})"
        out = F.when(text.rlike(words), F.lit(name)).otherwise(out)
    return out


def _parse(df: DataFrame, side: str) -> DataFrame:
    """Adds <side>_n (array of cents as written), <side>_k (scale words), currency, unit and direction."""
    text = F.lower(F.trim(F.regexp_replace(F.col(side), r"[\s\x{00a0}\x{202f}\x{2009}]+", " ")))
    whole = F.regexp_extract_all("_t", F.lit(_NUMBER), F.lit(1))
    cents = F.regexp_extract_all("_t", F.lit(_NUMBER), F.lit(2))
    scale = F.regexp_extract_all("_t", F.lit(_NUMBER), F.lit(3))
    amount = F.transform(
        F.arrays_zip(whole.alias("a"), cents.alias("b")),
        lambda x: F.try_to_number(F.regexp_replace(x["a"], r"\D", ""), F.lit("9" * 15)).cast("bigint") * 100 + F.coalesce(F.try_to_number(F.rpad(F.nullif(x["b"], F.lit("")), 2, "0"), F.lit("99")), F.lit(0)).cast("bigint"),
    )
    rest = F.regexp_replace("_t", _NUMBER, " # ")
    way = F.when(F.col("_t").rlike(r"^(?:up to|do|bis|max\.?|maks\.?|to)\s"), "upper").when(F.col("_t").rlike(r"^(?:from|od|ab|min\.?|at least)\s"), "lower")
    return (
        df.withColumn("_t", text)
        .withColumns({f"{side}_n": amount, f"{side}_k": F.transform(scale, lambda x: x != ""), f"{side}_way": way, f"{side}_r": rest})
        .withColumns({f"{side}_cur": _first(F.col(f"{side}_r"), CURRENCIES), f"{side}_unit": _first(F.regexp_replace(f"{side}_r", rf"(?<!{_LETTER})(?:m|w|y|d)(?!{_LETTER}|-)", ""), UNITS)})
        .drop("_t", f"{side}_r")
    )


def resolve_amounts(pay: DataFrame, fx: DataFrame, unit_month: DataFrame, base_currency: str = "PLN", base_unit: str = "month") -> DataFrame:
    """Adds lower, upper (whole base units per month, halves up; null where not given),
    currency, unit, residual, unique, cents (the larger bound as written) and rate.

    ``pay`` has low, high (text), currency_text, unit_text and period_text. Texts go
    before columns, columns before the period. Where only one bound bears a thousands
    word, the other is read with and without it and the smaller log residual wins.
    Null, empty and wordless texts give null bounds; currencies and units that can't be
    told are null, and with them both bounds."""
    df = _parse(_parse(pay, "low"), "high")
    from_col = lambda c, t: _first(F.lower(F.trim(F.col(c))), t, whole=True)
    cur = F.coalesce("low_cur", "high_cur", from_col("currency_text", CURRENCIES))
    unit = F.coalesce("low_unit", "high_unit", from_col("unit_text", UNITS), from_col("period_text", UNITS))
    cell = lambda c, i: F.get(F.col(c), F.lit(i))
    ranged, single = F.size("low_n") >= 2, F.size("low_n") == 1
    high_range = F.size("high_n") >= 2
    low_is_upper = single & (F.col("low_way") == "upper")
    high_is_lower = (F.size("high_n") == 1) & (F.col("high_way") == "lower")
    a = F.when(ranged | (single & ~F.coalesce(low_is_upper, F.lit(False))), cell("low_n", 0)).when(high_range | F.coalesce(high_is_lower, F.lit(False)), cell("high_n", 0))
    ak = F.when(ranged | (single & ~F.coalesce(low_is_upper, F.lit(False))), cell("low_k", 0)).when(high_range | F.coalesce(high_is_lower, F.lit(False)), cell("high_k", 0))
    b = F.when(high_range, cell("high_n", 1)).when((F.size("high_n") == 1) & ~F.coalesce(high_is_lower, F.lit(False)), cell("high_n", 0)).when(ranged, cell("low_n", 1)).when(F.coalesce(low_is_upper, F.lit(False)), cell("low_n", 0))
    bk = F.when(high_range, cell("high_k", 1)).when((F.size("high_n") == 1) & ~F.coalesce(high_is_lower, F.lit(False)), cell("high_k", 0)).when(ranged, cell("low_k", 1)).when(F.coalesce(low_is_upper, F.lit(False)), cell("low_k", 0))
    df = df.withColumns({"_a": a, "_b": b, "_ak": F.coalesce(ak, F.lit(False)), "_bk": F.coalesce(bk, F.lit(False)), "currency": cur, "unit": unit})
    # candidate scales of both bounds; a written thousands word is binding
    scales = lambda word, other: F.when(F.col(word), F.array(F.lit(1000))).when(F.col(other), F.array(F.lit(1), F.lit(1000))).otherwise(F.array(F.lit(1)))
    options = F.flatten(F.transform(scales("_ak", "_bk"), lambda x: F.transform(scales("_bk", "_ak"), lambda y: F.struct(x.alias("x"), y.alias("y")))))
    residual = lambda o: F.coalesce(F.abs(F.ln((F.col("_b") * o["y"]).cast("double") / F.nullif((F.col("_a") * o["x"]).cast("double"), F.lit(0.0)))) + F.when(F.col("_b") * o["y"] < F.col("_a") * o["x"], 1e3).otherwise(0.0), F.lit(0.0))
    plain = lambda o: F.when((o["x"] == 1000) & ~F.col("_ak"), 1).otherwise(0) + F.when((o["y"] == 1000) & ~F.col("_bk"), 1).otherwise(0)
    ranked = F.array_sort(F.transform(options, lambda o: F.struct(residual(o).alias("residual"), plain(o).alias("guessed"), o["x"].alias("x"), o["y"].alias("y"))))
    df = df.withColumn("_c", ranked)
    both = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    near = F.coalesce(F.get("_c", F.lit(1))["residual"] - F.get("_c", F.lit(0))["residual"], F.lit(9.0))
    df = df.withColumns({"residual": F.when(both, F.get("_c", F.lit(0))["residual"]), "unique": (~both | (near > 0.1)) & F.col("currency").isNotNull() & F.col("unit").isNotNull()})
    sx = F.when(both, F.get("_c", F.lit(0))["x"]).otherwise(F.when(F.col("_ak"), 1000).otherwise(1))
    sy = F.when(both, F.get("_c", F.lit(0))["y"]).otherwise(F.when(F.col("_bk"), 1000).otherwise(1))
    df = df.withColumns({"_a": F.col("_a") * sx, "_b": F.col("_b") * sy})
    fx = fx.select(F.col("currency").alias("_fc"), (F.col("pln_per_unit") * 10000).cast("bigint").alias("_rate")).dropDuplicates(["_fc"])
    um = unit_month.select(F.col("unit_name").alias("_un"), F.col("month_mult").cast("bigint").alias("_mult"), F.col("month_div").cast("bigint").alias("_div")).dropDuplicates(["_un"])
    df = df.join(fx, df.currency == fx._fc, "left").join(um, df.unit == um._un, "left")
    # cents times 1e-4 of the base currency times months, halves up
    exact = lambda c: F.expr(f"(2 * {c} * _rate * _mult + 1000000 * _div) div (2000000 * _div)")
    df = df.withColumns({"lower": exact("_a"), "upper": exact("_b"), "cents": F.coalesce("_b", "_a"), "rate": F.col("_rate")})
    gone = [c for c in df.columns if c.startswith("_") or c.split("_")[0] in ("low", "high") and c not in ("low", "high")]
    return df.drop(*gone)


def salaries(offers: DataFrame, fx: DataFrame, unit_month: DataFrame) -> DataFrame:
    """(offer_id, contract_kind, pln_month_from, pln_month_to, currency, unit, unique, plain):
    both salaries of every offer. Of rows with the same offer_id the one ingested last
    counts (of equals the smallest text). ``plain`` marks what is already digits only,
    exactly PLN and exactly month."""
    pay = [F.struct(F.lit(k).alias("contract_kind"), F.col(f"{k}_from").alias("low"), F.col(f"{k}_to").alias("high"), F.col(f"{k}_currency").alias("currency_text"), F.col(f"{k}_unit").alias("unit_text")) for k in ("coe", "b2b")]
    one = (
        offers.where("offer_id is not null")
        .select("offer_id", F.struct("ingested_at", F.struct(F.array(*pay).alias("pay"), F.col("salary_period").alias("period_text")).alias("v")).alias("r"))
        .groupBy("offer_id").agg(F.max("r").alias("r"))
        .select("offer_id", F.explode("r.v.pay").alias("p"), F.col("r.v.period_text").alias("period_text"))
        .select("offer_id", "p.*", "period_text")
        .where("low is not null or high is not null")
    )
    done = resolve_amounts(one, fx, unit_month)
    digits = lambda c: F.coalesce(F.col(c).rlike(r"^[0-9]+$"), F.lit(True))
    plain = digits("low") & digits("high") & F.coalesce((F.col("currency_text") == "PLN") & (F.col("unit_text") == "month"), F.lit(False))
    done = done.withColumn("plain", plain)
    return done.select("offer_id", "contract_kind", F.col("lower").alias("pln_month_from"), F.col("upper").alias("pln_month_to"), "currency", "unit", "residual", "unique", "plain", "cents", "rate")


def guessed_units(pay: DataFrame, unit_month: DataFrame, least_gap: float = 0.7) -> DataFrame:
    """(offer_id, contract_kind, currency, guess, guess_residual, guess_unique): for salaries
    of a known currency whose unit nothing tells, the unit that brings them closest to the
    other salary of the same offer, by log residual; null where there is none to compare.
    Not unique if the next unit is less than ``least_gap`` worse. Both salaries of an offer
    are in one partition already, so the window moves nothing."""
    rows = unit_month.select("unit_name", "month_mult", "month_div").distinct().limit(101).collect()
    if len(rows) > 100:
        raise ValueError("unit_month holds more than 100 units")
    known = F.when(F.col("unit").isNotNull(), F.log(F.coalesce("pln_month_to", "pln_month_from").cast("double")))
    both = pay.withColumn("other", F.max(known).over(Window.partitionBy("offer_id")))
    mine = F.log(F.col("cents").cast("double") * F.col("rate") / 1e6)
    options = [F.struct(F.abs(mine + F.log(F.lit(r.month_mult / r.month_div)) - F.col("other")).alias("residual"), F.lit(r.unit_name).alias("unit")) for r in sorted(rows)]
    ranked = F.array_sort(F.array(*options)) if options else F.array().cast("array<struct<residual:double,unit:string>>")
    left = both.where("unit is null and currency is not null and cents > 0").withColumn("_g", F.when(F.col("other").isNotNull(), ranked))
    first, second = F.get("_g", F.lit(0)), F.get("_g", F.lit(1))
    return left.select("offer_id", "contract_kind", "currency", first["unit"].alias("guess"), first["residual"].alias("guess_residual"), F.coalesce(second["residual"] - first["residual"] >= least_gap, F.lit(False)).alias("guess_unique"))
