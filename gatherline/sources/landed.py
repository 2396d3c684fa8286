"""Landed files and pages as DataFrames: JSON lines, CSV, seeds, exports, web pages, feeds, payments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gatherline import vocab
from gatherline.functions.names import squeeze
from gatherline.functions.pages import FREE_MAIL, json_ld, link_kind, links, page_lines
from gatherline.functions.values import let, text

BAD = "_corrupt_record"


def json_lines(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine) of one file or a glob of shards. Lines that do not parse go to quarantine with their file."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    made = lines.withColumn("r", F.from_json("value", f"{schema}, {BAD} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}))
    good = made.where(f"r.{BAD} IS NULL AND trim(value) <> ''").select("r.*", "file").drop(BAD)
    return good, made.where(f"r.{BAD} IS NOT NULL").select("value", "file")


def seed_sites(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """(name, website, pages) of a JSON object whose values are a website or {website, pages}; '_' keys and others go.

    Each file is one object or, with ``lines``, each line is, so that a large seed is read by many tasks.
    """
    one = spark.read.text(path, wholetext=not lines)
    whole = F.from_json("value", "map<string,string>")
    entry = one.select(F.explode(whole).alias("name", "v"))
    site = F.when(F.col("v").startswith("{"), F.get_json_object("v", "$.website")).otherwise(F.col("v"))
    pages = F.coalesce(F.from_json(F.get_json_object("v", "$.pages"), "array<string>"), F.array().cast("array<string>"))
    return entry.select("name", site.alias("website"), F.filter(pages, lambda p: p.startswith("http")).alias("pages")).where("NOT startswith(name, '_') AND startswith(website, 'http')")


def report_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').schema(schema).csv(path)


def keep_last(pages: DataFrame, key: str, order: str = "ord") -> DataFrame:
    """Union of result pages with one row a key: the last one seen."""
    rest = [c for c in pages.columns if c != key]
    last = pages.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_l"))
    return last.select(key, *[F.col(f"_l.{c}").alias(c) for c in rest])


def union_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """All collectors' rows with their collector's name; columns that a source lacks are null."""
    out = None
    for name, df in sources.items():
        one = df.withColumn("collector", F.lit(name))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def fresh_pages(pages: DataFrame, as_of: Column, hours: int = 6) -> DataFrame:
    """One row a url, the last fetched, that is not older than ``hours``."""
    return keep_last(pages.where(F.col("fetched_at") >= as_of - F.expr(f"INTERVAL {hours} HOURS")), "url", "fetched_at")


def export_complete(export: DataFrame, expected: DataFrame) -> DataFrame:
    """Per table: rows exported and expected, and complete."""
    have = export.groupBy("table").agg(F.count("*").alias("rows"))
    return expected.join(have, "table", "left").select("table", "expected", F.coalesce("rows", F.lit(0)).alias("rows"), (F.coalesce("rows", F.lit(0)) >= F.col("expected")).alias("complete"))


def missing_ids(spark: SparkSession, start: int, end: int, landed: DataFrame, id_col: str) -> DataFrame:
    """Ids of [start, end) that have not landed."""
    return spark.range(start, end).withColumnRenamed("id", id_col).join(landed.select(id_col).distinct(), id_col, "left_anti")


def gaps(landed: DataFrame, id_col: str, overhang: int = 0) -> DataFrame:
    """Ids from the least landed one to the greatest, and ``overhang`` beyond, that have not landed."""
    low, high = landed.agg(F.min(id_col), F.max(id_col)).first()
    return missing_ids(landed.sparkSession, 0 if low is None else low, 0 if low is None else high + 1 + overhang, landed, id_col)


# --- pages


def ranked_links(pages: DataFrame, most: int | None = None) -> DataFrame:
    """page_id, rank, href, label, kind: a page's distinct links that are worth a visit, the most promising first.

    All of them, or the first ``most`` where that is given. A page's links are one array of its own text, ranked there; nothing is grouped over pages.
    """
    kinds = F.create_map(*[F.lit(x) for x in ("event", 0, "page", 1, "query", 2, "skip", 3)])
    depth = lambda h: F.length(h) - F.length(F.replace(F.regexp_replace(h, r"^https?://", ""), F.lit("/"), F.lit("")))
    made = F.transform(links(F.col("html")), lambda r, i: F.struct(F.element_at(kinds, link_kind(r["href"], r["label"])).alias("k"), depth(r["href"]).alias("d"), F.length(r["href"]).alias("n"), r["href"].alias("href"), i.alias("i"), r["label"].alias("label")))
    good = F.filter(made, lambda r: r["k"] < 3)
    first = F.array_sort(let(good, lambda g: F.filter(g, lambda r: ~F.exists(g, lambda q: (q["href"] == r["href"]) & (q["i"] < r["i"])))))
    out = pages.select("page_id", F.posexplode(first if most is None else F.slice(first, 1, most)).alias("rank", "r"))
    names = F.array(*[F.lit(x) for x in ("event", "page", "query")])
    return out.select("page_id", (F.col("rank") + 1).alias("rank"), F.col("r.href").alias("href"), F.col("r.label").alias("label"), F.element_at(names, F.col("r.k") + 1).alias("kind"))


def numbered_lines(rows: DataFrame, id_col: str, lines: Column) -> DataFrame:
    """id, line_no (from 0), line."""
    return rows.select(id_col, F.posexplode(lines).alias("line_no", "line"))


def look_ahead(rows: DataFrame, id_col: str, lines: Column, pattern: str, ahead: int = 7) -> DataFrame:
    """Each line that matches, with the next ``ahead`` lines up to the next match: id, line_no, line, block.

    Windows are slices of the page's own array of lines, so a page of any length is one row and nothing is shuffled.
    """
    at = F.filter(F.transform(lines, lambda x, i: F.when(x.rlike(pattern), i)), lambda i: i.isNotNull())
    made = rows.select(id_col, lines.alias("_l"), at.alias("_at")).select(id_col, "_l", "_at", F.posexplode("_at").alias("_k", "line_no"))
    stop = F.coalesce(F.get("_at", F.col("_k") + 1), F.size("_l"))
    return made.select(id_col, "line_no", F.get("_l", F.col("line_no")).alias("line"), F.slice("_l", F.col("line_no") + 2, F.least(F.lit(ahead), stop - F.col("line_no") - 1)).alias("block"))


def page_blocks(pages: DataFrame, date_pattern: str, ahead: int = 7) -> DataFrame:
    """Listing blocks of pages: every line with a date, and what follows it."""
    return look_ahead(pages, "page_id", page_lines(F.col("html")), date_pattern, ahead)


def json_ld_events(pages: DataFrame) -> DataFrame:
    """schema.org events embedded in pages, also in lists, @graph and itemListElement: one row an event.

    Documents that do not parse are left out.
    """
    kinds = ["Event", "SportsEvent", "SocialEvent", "Festival"]
    docs = pages.select("page_id", F.posexplode(json_ld(F.col("html"))).alias("doc", "j")).withColumn("v", F.try_parse_json("j")).where("v IS NOT NULL")
    arr = lambda v, p: F.try_variant_get(v, p, "array<variant>")
    whole = F.coalesce(arr(F.col("v"), "$"), F.array("v"))
    inner = F.flatten(F.transform(whole, lambda x: F.concat(F.array(x), F.coalesce(arr(x, "$['@graph']"), F.array().cast("array<variant>")), F.transform(F.coalesce(arr(x, "$.itemListElement"), F.array().cast("array<variant>")), lambda y: F.coalesce(F.try_variant_get(y, "$.item", "variant"), y)))))
    items = docs.select("page_id", "doc", F.posexplode(inner).alias("item", "e"))
    get = lambda p: F.try_variant_get("e", p, "string")
    types = F.coalesce(F.try_variant_get("e", "$['@type']", "array<string>"), F.array(get("$['@type']")))
    day = lambda p: F.try_to_date(F.substring(get(p), 1, 10), "yyyy-MM-dd")
    return items.where(F.exists(types, lambda t: t.isin(kinds))).select(
        "page_id",
        "doc",
        "item",
        squeeze(get("$.name")).alias("name"),
        day("$.startDate").alias("start_date"),
        F.coalesce(day("$.endDate"), day("$.startDate")).alias("end_date"),
        get("$.url").alias("url"),
        F.nullif(squeeze(get("$.location.name")), F.lit("")).alias("venue_name"),
        get("$.location.address.addressLocality").alias("city"),
        get("$.location.address.addressRegion").alias("state"),
        get("$.location.geo.latitude").cast("double").alias("lat"),
        get("$.location.geo.longitude").cast("double").alias("lng"),
    )


def page_or_feed(page: DataFrame, feed: DataFrame, key: str) -> DataFrame:
    """Feed rows with what their page says where it says something: page first, feed second, by column."""
    shared = [c for c in feed.columns if c != key]
    p = page.select(key, *[F.col(c).alias(f"_p_{c}") for c in page.columns if c != key])
    joined = feed.join(p, key, "left")
    return joined.select(key, *[(F.coalesce(F.col(f"_p_{c}"), F.col(c)) if c in page.columns else F.col(c)).alias(c) for c in shared])


def table_blocks(rows: DataFrame, id_col: str = "page_id", order: str = "row_no", blank: Column | None = None) -> DataFrame:
    """Rows of a page's table with block_no: a blank row ends a block. Rows of one page are few by nature."""
    is_blank = blank if blank is not None else (text("cell") == "")
    running = F.sum(is_blank.cast("int")).over(Window.partitionBy(id_col).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("block_no", running).where(~is_blank)


# --- payments


def sales_lines(payments: DataFrame, orders: DataFrame, locations: DataFrame) -> DataFrame:
    """One row per sold item of completed payments, with the local date and hour of its location.

    payments: id, order_id, location_id, created_at (UTC timestamp), status, amount_cents, tip_cents, device_name;
    orders: id, line_items array<struct<name, variation_name, quantity string, total_cents>>; locations: id, name, tz.
    A payment whose order is unknown or empty becomes one line of its own amount.
    """
    p = payments.where("status = 'COMPLETED'").join(locations.select(F.col("id").alias("location_id"), F.col("name").alias("location"), "tz"), "location_id", "left")
    joined = p.join(orders.select(F.col("id").alias("order_id"), "line_items"), "order_id", "left")
    local = F.from_utc_timestamp("created_at", F.coalesce("tz", F.lit("UTC")))
    item = F.explode_outer(F.when(F.size("line_items") > 0, F.col("line_items"))).alias("item")
    out = joined.select("id", "order_id", "location", local.alias("local"), "amount_cents", "tip_cents", "device_name", item)
    return out.select(
        F.col("id").alias("payment_id"),
        "order_id",
        "location",
        F.to_date("local").alias("sale_date"),
        F.hour("local").alias("sale_hour"),
        F.coalesce("item.name", F.lit("Custom amount")).alias("item_name"),
        F.col("item.variation_name").alias("variation"),
        F.coalesce(F.col("item.quantity").try_cast("double"), F.lit(1.0)).alias("quantity"),
        F.coalesce("item.total_cents", "amount_cents").alias("total_cents"),
        "tip_cents",
        "device_name",
    )


def weather_rows(series: DataFrame) -> DataFrame:
    """Parallel arrays of daily weather as rows: place, day and measures. series: place, time array<string>, and arrays."""
    names = [c for c in series.columns if c not in ("place", "time")]
    zipped = series.select("place", F.explode(F.arrays_zip("time", *names)).alias("d"))
    return zipped.select("place", F.try_to_date(F.col("d.time"), "yyyy-MM-dd").alias("day"), *[F.col(f"d.{n}").alias(n) for n in names]).dropDuplicates(["place", "day"])


def document_hints(documents: DataFrame) -> DataFrame:
    """Whose event a document speaks of: one row for each domain in its addresses, and one without a domain where only a host is named.

    documents: doc_id, text. Returns doc_id, rank, domain, emails, addresses (number of printed site addresses),
    hosted_by (at most three), confidence: 0.6 with an email, 0.45 with an address only, 0.4 with a name only. Free mail
    and registration platforms are no organiser's domain. A document is one row; null and empty ones hint at nothing.
    """
    said = text("text")
    mails = F.transform(F.regexp_extract_all(said, F.lit(f"({vocab.EMAIL})"), F.lit(1)), lambda e: F.lower(e))
    hosts = F.transform(F.regexp_extract_all(said, F.lit(vocab.SITE_ADDRESS), F.lit(1)), lambda h: F.lower(h))
    domain = lambda e: F.regexp_replace(F.split_part(e, F.lit("@"), F.lit(2)), r"\.+$", "")
    own = lambda d: ~d.isin(FREE_MAIL) & ~d.rlike(vocab.PLATFORM_HOST) & ~d.endswith(".pdf")
    read = documents.select("doc_id", F.array_distinct(mails).alias("_mails"), hosts.alias("_hosts"), F.slice(F.transform(F.regexp_extract_all(said, F.lit(vocab.HOSTED_BY), F.lit(1)), lambda n: F.regexp_replace(n, r"^[ .]+|[ .]+$", "")), 1, 3).alias("hosted_by"))
    names = F.filter(F.array_union(F.transform("_mails", domain), F.array_distinct("_hosts")), own)

    def hint(d: Column) -> Column:
        mine = F.filter("_mails", lambda e: domain(e) == d)
        return F.struct((-F.size(mine)).alias("n"), d.alias("domain"), F.array_sort(mine).alias("emails"), F.size(F.filter("_hosts", lambda h: h == d)).alias("addresses"))

    nothing = F.struct(F.lit(0).alias("n"), F.lit(None).cast("string").alias("domain"), F.array().cast("array<string>").alias("emails"), F.lit(0).alias("addresses"))
    hints = let(F.array_sort(F.transform(names, hint)), lambda h: F.when((F.size(h) == 0) & (F.size("hosted_by") > 0), F.array(nothing)).otherwise(h))
    rows = read.select("doc_id", "hosted_by", F.posexplode(hints).alias("rank", "h"))
    sure = F.when(F.size("h.emails") > 0, 0.6).when(F.col("h.domain").isNotNull(), 0.45).otherwise(0.4)
    return rows.select("doc_id", (F.col("rank") + 1).alias("rank"), "h.domain", "h.emails", "h.addresses", "hosted_by", sure.alias("confidence"))
