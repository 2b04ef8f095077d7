"""Guards: decisions on a row as plain expressions, and the routes they lead to.

A decision is a struct<action, guard, message>. Guards of a stage run in order; the first
that isn't 'advance' wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import trim_all

ACTIONS = ("advance", "load", "quarantine", "trash", "remove")
# fixed value: text of a page that its own script failed to render
APP_ERROR = "Application error: a client-side exception has occurred while loading justjoin.it"


def decision(action: Column | str, guard: str, message: Column | str) -> Column:
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    return F.struct(lit(action).alias("action"), F.lit(guard).alias("guard"), lit(message).alias("message"))


def content_guard(html: Column, least: int = 100) -> Column:
    """Pages that weren't rendered are removed, pages without a paragraph quarantined. A null
    page counts as empty."""
    page = F.coalesce(html, F.lit(""))
    short = F.length(trim_all(page)) < least
    action = F.when(page.contains(APP_ERROR) | short, "remove").when(~page.rlike(r"(?i)<p[\s>/]"), "quarantine").otherwise("advance")
    message = F.when(page.contains(APP_ERROR), "application error").when(short, "empty or too short").when(~page.rlike(r"(?i)<p[\s>/]"), "no paragraphs").otherwise("non empty")
    return decision(action, "content", message)


def not_empty_guard(text: Column, least: int = 100) -> Column:
    short = F.length(trim_all(F.coalesce(text, F.lit("")))) < least
    return decision(F.when(short, "quarantine").otherwise("advance"), "not-empty", F.when(short, "empty or too short").otherwise("non empty"))


def duplicate_guard(url: Column, canonical: Column, alternates: Column) -> Column:
    """An offer under another than its canonical url is a duplicate. Null alternates count
    as none."""
    unknown = F.coalesce(canonical, F.lit("")).eqNullSafe("") | (F.coalesce(F.size(alternates), F.lit(0)) <= 0)
    same = url.eqNullSafe(canonical)
    return decision(F.when(unknown | same, "advance").otherwise("trash"), "duplicate", F.when(unknown, "no data").when(same, "not a duplicate").otherwise("duplicate"))


def expiration_guard(expires: Column, now: Column) -> Column:
    """Null is quarantined, the past is trashed, an unreadable time counts as fresh."""
    past = F.coalesce(F.try_to_timestamp(expires) <= now, F.lit(False))
    return decision(F.when(expires.isNull(), "quarantine").when(past, "trash").otherwise("advance"), "expiration", F.when(expires.isNull(), "no expiration date").when(past, "expired").otherwise("fresh"))


def valid_guard(ok: Column) -> Column:
    bad = ~F.coalesce(ok, F.lit(False))
    return decision(F.when(bad, "quarantine").otherwise("advance"), "schema", F.when(bad, "invalid value").otherwise("valid"))


def quality_guard(quality: Column, least: float = 0.4) -> Column:
    good = F.coalesce(quality >= least, F.lit(False))
    return decision(F.when(good, "load").otherwise("quarantine"), "quality", F.when(good, "complete enough").otherwise("not complete enough"))


def answer_guard(quality: Column, least: float = 0.5) -> Column:
    """Answers of an extraction client: too few filled nodes, or no json, are quarantined."""
    good = F.coalesce(quality >= least, F.lit(False))
    return decision(F.when(good, "advance").otherwise("quarantine"), "answer-quality", F.when(quality.isNull(), "unreadable answer").when(good, "complete enough").otherwise("not complete enough"))


def first_stop(*decisions: Column) -> Column:
    """The first decision that isn't 'advance', else the last."""
    out = decisions[-1]
    for d in reversed(decisions[:-1]):
        out = F.when(d["action"] != "advance", d).otherwise(out)
    return out


def applicable(inputs: list[Column], output: Column) -> Column:
    """Whether a stage has work: all inputs present and the output missing or older than an
    input. Columns are times, null for missing."""
    present = inputs[0].isNotNull()
    newer = inputs[0] > output
    for c in inputs[1:]:
        present, newer = present & c.isNotNull(), newer | (c > output)
    return present & (output.isNull() | F.coalesce(newer, F.lit(False)))


def routed(df: DataFrame, action: str) -> DataFrame:
    """The rows of one route."""
    if action not in ACTIONS:
        raise ValueError(f"unknown action {action}")
    return df.where(F.col("decision.action") == action)
