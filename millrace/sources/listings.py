"""Landed listing pages as sources: parsers of the boards' envelopes, paging rules, plain
lists and simple tables. Nothing here touches a network."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import variant as V
from ..functions.html import scripts

#: where each board keeps the records of a listing page
RECORDS = {"jji": "data", "nfj": "postings", "bdj": "props.pageProps.jobs"}


def records(pages: DataFrame, body: str, source: str) -> DataFrame:
    """(.., pos, record): the records of landed pages. A page whose envelope is broken gives
    one row with a null record and an ``error``, so that reading goes on with the next."""
    raw = F.col(body)
    if source == "bdj":
        raw = F.regexp_extract(F.col(body), r'(?is)<script[^>]*id="__NEXT_DATA__"[^>]*>(.*?)</script>', 1)
    v = F.try_parse_json(raw)
    out = pages.withColumn("_v", v).withColumn("error", F.when(V.kind(V.get(F.col("_v"), RECORDS[source])) == "ARRAY", None).otherwise("unreadable listing page"))
    return out.select(*pages.columns, "error", F.posexplode_outer(V.items(F.col("_v"), RECORDS[source])).alias("pos", "record"))


def emission_order(rows: DataFrame, page: str = "page", pos: str = "pos") -> list[Column]:
    """Boards that hand a page's records out from its end."""
    return [F.col(page).asc(), F.col(pos).desc()]


def numeric_ids(rows: DataFrame, slug: Column) -> DataFrame:
    """Keeps records whose slug begins with a number, that number as id; the first of each."""
    w = Window.partitionBy("id").orderBy("pos")
    return rows.withColumn("id", F.nullif(F.regexp_extract(slug, r"^(\d+)-", 1), F.lit(""))).where("id is not null").withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def read_until(pages: DataFrame, page: str, stop: Column, inclusive: bool = False) -> DataFrame:
    """The pages before the first that meets the stop rule (and that one too if inclusive)."""
    first = pages.agg(F.min(F.when(stop, F.col(page))).alias("_stop"))
    keep = F.col("_stop").isNull() | ((F.col(page) <= F.col("_stop")) if inclusive else (F.col(page) < F.col("_stop")))
    return pages.join(F.broadcast(first), keep).drop("_stop")  # one row


def line_list(df: DataFrame, text: str) -> DataFrame:
    """Distinct non-empty trimmed lines of plain-text lists."""
    return df.select(F.explode(F.split(text, r"\r?\n")).alias("line")).select(F.trim("line").alias("line")).where("line <> ''").distinct()


def catalogue(df: DataFrame, source: str) -> DataFrame:
    """Checks the listing catalogue: every row has a url, nfj rows a request body."""
    ok = F.col("url").isNotNull() & (F.lit(source != "nfj") | F.col("raw_body").isNotNull())
    return df.where(F.assert_true(ok, "listing without url or request body").isNull())


def embedded_state(pages: DataFrame, html: str, kind: str = "application/json") -> DataFrame:
    """Embedded JSON of pages, one row per script; broken ones are empty objects."""
    return pages.select(*[c for c in pages.columns if c != html], F.posexplode(F.transform(scripts(F.col(html), kind), lambda s: F.when(F.try_parse_json(s).isNotNull(), s).otherwise("{}"))).alias("no", "json"))


#: fields that name a record on its board; "id" elsewhere
IDS = {"jji": "guid"}


def file_records(files: DataFrame) -> DataFrame:
    """(.., rec_no, body): the listing records of landed json files, one row each.

    A file holds one record, an array of them, or one per line. An array gives its elements
    and a text that opens with a record of its own line gives its lines, what doesn't parse
    being null; anything else is one record, null if it doesn't parse. Empty arrays have
    none. A byte-order mark never counts."""
    text = F.replace("payload", F.lit("\ufeff"), F.lit(""))
    whole = F.try_parse_json(text)
    lines = F.filter(F.split(text, r"\r?\n"), lambda x: F.trim(x) != "")
    elements = F.transform(F.when(V.kind(F.col("_v")) == "ARRAY", F.col("_v").cast("array<variant>")), lambda x: F.to_json(x))
    read = lambda x: F.when(F.try_parse_json(x).isNotNull(), x)
    # what parses is the first value of a text, whatever follows it: lines are looked at first
    by_line = (F.size(lines) > 1) & F.try_parse_json(F.get(lines, F.lit(0))).isNotNull()
    found = F.when(by_line, F.transform(lines, read)).when(F.col("_v").isNotNull(), F.coalesce(elements, F.array(text))).otherwise(F.array(F.lit(None).cast("string")))
    kept = [c for c in files.columns if c != "payload"]
    return files.withColumn("_v", whole).select(*kept, F.posexplode(found).alias("rec_no", "body"))


def record_id(source: Column, record: Column) -> Column:
    """The key of an offer: its board and what names the record there; null where nothing does."""
    own = F.coalesce(*[F.when(source == b, V.text(record, f)) for b, f in IDS.items()], F.when(~source.isin(*IDS), V.text(record, "id")))
    return F.concat(source, F.lit("-"), F.nullif(own, F.lit("")))


def advertising(name: Column) -> Column:
    """Records that a board shows as adverts of a chain of shops (fixed value)."""
    return F.coalesce(name.contains("Żabka Polska"), F.lit(False))


def cursor_ends(cursor: Column, after: Column, n_records: Column, most: int = 10_000) -> Column:
    """Whether a page read at ``cursor`` is the last one: it names no next cursor, the same, or one
    at the end of what the board gives, or it is empty."""
    return after.isNull() | (after == cursor) | (after >= most) | (F.coalesce(n_records, F.lit(0)) == 0)


def counted_pages(pages: DataFrame, page: str, total: str, n_records: str) -> DataFrame:
    """The pages up to the number that the first page to tell one tells, and before the first
    empty one. No number of pages at all means until an empty page."""
    told = pages.where(F.col(total).isNotNull()).agg(F.min_by(total, page).alias("_total"))
    inside = pages.join(F.broadcast(told), F.col("_total").isNull() | (F.col(page) <= F.col("_total"))).drop("_total")  # one row
    return read_until(inside, page, F.coalesce(F.col(n_records), F.lit(0)) == 0)
