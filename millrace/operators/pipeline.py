"""The whole flow of an offer as one plan: artifacts to a decision and a route.

Stages are columns of one row per job; chaining them in order is the fixed point that a
stage scheduler would reach. Row-wise Python (the page reader) runs once per page, after
cheap guards have been able to say what they can without it."""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema
from ..functions import html as H
from ..sources import listings
from . import cleaners, guards


@dataclass(frozen=True)
class Stage:
    """A named step: columns it needs, the column it makes, and its guard."""

    name: str
    inputs: tuple[str, ...]
    output: str
    run: Callable[[DataFrame], DataFrame]
    guard: Callable[[], Column] | None = None


def stage_order(stages: list[Stage]) -> list[Stage]:
    """Stages in an order in which inputs come first; names must be unique and no circle
    may be left."""
    if len({s.name for s in stages}) != len(stages):
        raise ValueError("stage names must be unique")
    made = {s.output for s in stages}
    done, left = [], list(stages)
    ready: set[str] = set()
    while left:
        now = next((s for s in left if all(i in ready or i not in made for i in s.inputs)), None)
        if now is None:
            raise ValueError("stages depend on each other in a circle")
        done.append(now)
        left.remove(now)
        ready.add(now.output)
    return done


def offers_from_files(files: DataFrame, metas: DataFrame | None = None) -> DataFrame:
    """One row per job from small files: (job_id, source, json, html, json_mtime, html_mtime),
    and from metadata, if given, url and cache_path of the last scrape.

    Json files give their records, those of files without a job get theirs from the record.
    The latest complete record and page count; a json that doesn't parse or a page that isn't
    closed is not complete. Which file that is gets decided without the payloads; they follow
    by file, so that a job with very many files moves two of them."""
    is_json = F.col("artifact") == "raw.job.json"
    saved = listings.file_records(files.where(is_json)).withColumn("ok", F.col("body").isNotNull())
    saved = saved.withColumn("job_id", F.coalesce("job_id", listings.record_id(F.col("source"), F.try_parse_json("body"))))
    plain = F.replace("payload", F.lit("\ufeff"), F.lit(""))
    pages = files.where(F.col("artifact") == "raw.job.html").withColumn("rec_no", F.lit(0)).withColumn("body", plain).drop("payload")
    pages = pages.withColumn("ok", F.coalesce(F.regexp_replace("body", r"[\r\n\t ]+$", "").endswith("</html>"), F.lit(False)))
    cols = ["file_id", "rec_no", "job_id", "artifact", "source", "mtime", "ok", "body"]
    rows = saved.select(*cols).unionByName(pages.select(*cols)).where("job_id is not null")
    times = rows.drop("body").groupBy("job_id").agg(
        F.max("source").alias("source"), *[F.max(F.when(F.col("artifact") == a, F.col("mtime"))).alias(f"{n}_mtime") for n, a in (("json", "raw.job.json"), ("html", "raw.job.html"))],
        F.array_compact(F.array(*[F.max(F.when((F.col("artifact") == a) & F.col("ok"), F.struct("file_id", "rec_no"))) for a in ("raw.job.json", "raw.job.html")])).alias("_at"))
    wanted = times.select(F.col("job_id").alias("_job"), F.explode("_at").alias("a")).select("_job", "a.file_id", "a.rec_no")
    got = rows.where("ok").join(wanted, ["file_id", "rec_no"]).where("job_id = _job").groupBy("job_id").agg(*[F.max(F.when(F.col("artifact") == a, F.col("body"))).alias(n) for n, a in (("json", "raw.job.json"), ("html", "raw.job.html"))])
    out = times.drop("_at").join(got, "job_id", "left")
    if metas is None:
        return out
    last = metas.where("job_id is not null").groupBy("job_id").agg(F.max_by(F.struct("url", "cache_path"), F.struct("scraped_at", "meta_id")).alias("m"))
    return out.join(last, "job_id", "left").select(*out.columns, "m.url", "m.cache_path")


#: the stage whose guard decides, for the record of what went wrong
STAGES = {"inputs": "select", "clean": "clean-job-json", "content": "clean-html", "not-empty": "clean-html-to-md", "meta": "clean-meta", "duplicate": "clean-meta", "expiration": "clean-meta", "schema": "clean-combine", "quality": "clean-combine"}


def run(jobs: DataFrame, now: Column, least_quality: float = 0.4) -> DataFrame:
    """Adds job, meta, combined, quality, error and decision to rows of (job_id, source, url,
    json, html).

    A missing artifact or url advances (waits), an error of a cleaner is quarantined, else the
    first guard that stops decides, and completeness of the combined record decides between
    load and quarantine."""
    read = jobs.withColumn("v", F.try_parse_json("json"))
    # cleaned before the page is read: the Python step keeps the optimizer from repeating
    # the whole projection for every field that a guard looks at
    out = cleaners.clean(read).withColumn("page", H.read_page(F.col("html"), F.col("source"))).withColumn("md", F.col("page.md"))
    # a cleaner's record has every field, so that metadata and record side by side are what
    # merging both into an empty record would give
    out = cleaners.clean_meta(out, now).withColumn("combined", F.struct(F.col("meta").alias("offer"), *[F.col(f"job.{g}").alias(g) for g in schema.FIELDS]))
    waiting = F.col("json").isNull() | F.col("html").isNull() | F.col("url").isNull()
    checked = guards.first_stop(
        guards.decision(F.when(waiting, "wait").otherwise("advance"), "inputs", F.when(waiting, "inputs missing").otherwise("inputs present")),
        guards.decision(F.when(F.col("error").isNotNull(), "quarantine").otherwise("advance"), "clean", F.coalesce("error", F.lit("clean"))),
        guards.content_guard(F.col("page.clean")),
        guards.not_empty_guard(F.col("md")),
        guards.decision(F.when(F.col("meta_error").isNotNull(), "quarantine").otherwise("advance"), "meta", F.coalesce("meta_error", F.lit("clean"))),
        guards.duplicate_guard(F.col("url"), F.col("meta.canonical_url"), F.col("meta.alternate_urls")),
        guards.expiration_guard(F.col("meta.expires_at"), now),
        guards.valid_guard(schema.valid(F.col("job"))),
        guards.quality_guard(schema.quality(F.col("job")), least_quality),
    )
    keep = [c for c in out.columns if c not in ("page", "v", "json", "html", "md")]
    done = out.select(*keep, "md", F.struct(F.col("page.ld_json").alias("ld_json"), F.col("page.app_json").alias("app_json")).alias("html_json"), schema.quality(F.col("job")).alias("quality"), checked.alias("_d"))
    action = F.when(F.col("_d.action") == "wait", "advance").otherwise(F.col("_d.action"))
    return done.select(*keep, "md", "html_json", "quality", F.struct(action.alias("action"), F.col("_d.guard").alias("guard"), F.col("_d.message").alias("message")).alias("decision"))


def enrich(rows: DataFrame, ask: Callable[[str], str], key: str = "job_id", md: str = "md") -> DataFrame:
    """(key, answer): asks an injected client about each text, with the user prompt around
    it. A client that fails gives a null answer for its row only."""

    def call(batches):
        for pdf in batches:
            out = []
            for text in pdf[md]:
                try:
                    out.append(None if text is None else ask(f"Job offer (Markdown):\n<<<\n{text}\n>>>"))
                except Exception:  # noqa: BLE001  a client's failure is the row's, not the job's
                    out.append(None)
            pdf["answer"] = out
            yield pdf[[key, "answer"]]

    return rows.select(key, md).mapInPandas(call, f"{key} {dict(rows.dtypes)[key]}, answer string")
