"""Queries over sources, sinks and streams (SRC, SNK, STR)."""

from __future__ import annotations

from pyspark.sql import functions as F

from gatherline import vocab
from gatherline.functions.pages import FREE_MAIL, SKIP_LINK, page_lines, page_title
from gatherline.functions.values import text
from gatherline.queries.base import D_ANCHOR, D_BARE, D_LINES, EV, d_list, d_plain_html, d_squeeze, events, q, query, table
from gatherline.sources import exports, landed, sinks
from gatherline.streaming import flows


@query("src_05_keep_last", "SELECT o_custkey, max_by(o_orderkey, o_orderkey) AS o_orderkey, max_by(o_totalprice, o_orderkey) AS price FROM orders GROUP BY o_custkey")
def src_05(spark, sf_dir):
    pages_ = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.col("o_totalprice").alias("price"), F.col("o_orderkey").alias("ord"))
    return landed.keep_last(pages_, "o_custkey").select("o_custkey", "o_orderkey", "price")


@query("src_07_missing_ids", "WITH l AS (SELECT o_orderkey FROM orders WHERE o_custkey % 7 <> 3) SELECT unnest(range(min(o_orderkey), max(o_orderkey) + 101)) AS o_orderkey FROM l EXCEPT SELECT o_orderkey FROM l")
def src_07(spark, sf_dir):
    return landed.gaps(table(spark, sf_dir, "orders").where("o_custkey % 7 <> 3"), "o_orderkey", overhang=100)


@query("src_13_page_or_feed", "SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 AND c_custkey % 2 = 0 THEN 'page ' || c_name ELSE c_name END AS name, c_nationkey AS nation FROM customer")
def src_13(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    feed = c.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    page = c.where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("k"), F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("page "), "c_name")).alias("name"))
    return landed.page_or_feed(page, feed, "k")


LD = """'<html><script type="application/ld+json">{"@graph":[{"@type":"SportsEvent","name":"Cup ' || CAST(page_id AS VARCHAR(20)) || '","startDate":"2026-05-0' || CAST(page_id % 9 + 1 AS VARCHAR(9)) || 'T09:00","location":{"name":"Oak Arena","address":{"addressLocality":"Elm Falls","addressRegion":"NJ"}}},{"@type":"Person","name":"x"}]}</script><script type="application/ld+json">{broken</script></html>'"""


@query("src_16_json_ld", "SELECT page_id, 'Cup ' || CAST(page_id AS VARCHAR) AS name, '2026-05-0' || CAST(page_id % 9 + 1 AS VARCHAR) AS start_date, 'Oak Arena' AS venue_name, 'Elm Falls' AS city, 'NJ' AS state FROM pages")
def src_16(spark, sf_dir):
    marked = table(spark, sf_dir, "pages").select("page_id", F.expr(LD).alias("html"))
    out = landed.json_ld_events(marked)
    return out.select("page_id", "name", F.col("start_date").cast("string").alias("start_date"), "venue_name", "city", "state")


@query("src_17_look_ahead", r"WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS line_no FROM documents WHERE text IS NOT NULL), m AS (SELECT *, regexp_matches(line, '[0-9]') AS hit FROM l), n AS (SELECT *, min(CASE WHEN hit THEN line_no END) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt, max(line_no) OVER (PARTITION BY doc_id) AS last_no FROM m) SELECT doc_id, line_no, md5(line) AS line_md5, least(7, coalesce(nxt, last_no + 1) - line_no - 1) AS block_lines FROM n WHERE hit")
def src_17(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("text IS NOT NULL")
    out = landed.look_ahead(docs, "doc_id", F.split("text", "\n"), "[0-9]")
    return out.select("doc_id", F.col("line_no").cast("long").alias("line_no"), F.md5("line").alias("line_md5"), F.size("block").cast("long").alias("block_lines"))


@query("src_20_export_complete", "SELECT 'orders' AS \"table\", count(*) AS rows, count(*) AS expected, TRUE AS complete FROM orders UNION ALL SELECT 'customer', count(*), count(*) + 1, FALSE FROM customer")
def src_20(spark, sf_dir):
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    export = o.select(F.lit("orders").alias("table")).unionByName(c.select(F.lit("customer").alias("table")))
    expected = o.agg(F.count("*").alias("expected")).withColumn("table", F.lit("orders")).unionByName(c.agg((F.count("*") + 1).alias("expected")).withColumn("table", F.lit("customer")))
    return landed.export_complete(export, expected)


#: Pages of five exports of the orders, by ranges of 200 keys; all but the first export are broken in one place each.
EXPORT_SQL = """
SELECT 'export-' || CAST(t AS VARCHAR(9)) AS "table", CASE WHEN n > 0 THEN n * 200 - 1 END AS after,
  CASE WHEN t = 2 AND n = 4 THEN 199 WHEN t = 4 AND n = 2 AND extra = 1 THEN 999 WHEN n < (last_key - last_key % 200) / 200 THEN n * 200 + 199 END AS next_after,
  CASE WHEN t = 3 AND n = 2 THEN low - 200 ELSE low END AS low, high, rows
FROM (SELECT t, n, min(k) AS low, max(k) AS high, count(*) AS rows FROM (SELECT o_orderkey % 5 AS t, (o_orderkey - o_orderkey % 200) / 200 AS n, o_orderkey AS k FROM $orders) AS x GROUP BY t, n) AS pages
CROSS JOIN (SELECT max(o_orderkey) AS last_key FROM $orders) AS whole CROSS JOIN (SELECT 0 AS extra UNION ALL SELECT 1) AS again
WHERE (extra = 0 OR (t = 4 AND n = 2)) AND NOT (t = 1 AND n = 3)"""


@query(
    "src_20_export_chain",
    "WITH RECURSIVE pg AS (" + EXPORT_SQL.replace("$orders", "orders").replace("/ 200", "// 200")
    + """), st AS (SELECT "table" AS t, after, min(next_after) AS nxt, count(DISTINCT coalesce(next_after, -1)) AS ways FROM pg GROUP BY 1, 2),
  walk AS (SELECT t, CAST(NULL AS BIGINT) AS cur, 1 AS page FROM st WHERE after IS NULL UNION ALL SELECT w.t, s.nxt, w.page + 1 FROM walk w JOIN st s ON s.t = w.t AND s.after IS NOT DISTINCT FROM w.cur WHERE s.nxt IS NOT NULL AND w.page < (SELECT count(*) FROM st)),
  pos AS (SELECT t, cur, min(page) AS page FROM walk GROUP BY t, cur)
  SELECT "table", coalesce(p.after, -1) AS after, coalesce(p.next_after, -1) AS next_after, CAST(rows AS BIGINT) AS rows, coalesce(CAST(a.page AS BIGINT), -1) AS page,
    concat_ws(',', CASE WHEN a.page IS NULL THEN 'unreached' END, CASE WHEN s.ways > 1 THEN 'fork' END, CASE WHEN p.next_after IS NOT NULL AND n.t IS NULL THEN 'stops' END, CASE WHEN p.next_after IS NOT NULL AND b.page <= a.page THEN 'loop' END, CASE WHEN low <= p.after OR high > p.next_after THEN 'order' END) AS fault
  FROM pg p JOIN st s ON s.t = p."table" AND s.after IS NOT DISTINCT FROM p.after LEFT JOIN pos a ON a.t = p."table" AND a.cur IS NOT DISTINCT FROM p.after LEFT JOIN pos b ON b.t = p."table" AND b.cur = p.next_after LEFT JOIN st n ON n.t = p."table" AND n.after = p.next_after""",
)
def src_20_chain(spark, sf_dir):
    """Pages of keyset exports in the order of their cursors, and where a chain is broken."""
    made = spark.sql(EXPORT_SQL.replace("$orders", "{orders}").replace('"table"', "`table`").replace("/ 200", "DIV 200"), orders=table(spark, sf_dir, "orders"))
    out = exports.export_chain(made)
    unset = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(-1)).alias(c)
    return out.select("table", unset("after"), unset("next_after"), "rows", unset("page"), "fault")


@query("src_21_since", "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1999-06-01'")
def src_21(spark, sf_dir):
    # The plain comparison reaches the scan as a pushed filter.
    return table(spark, sf_dir, "orders").where("o_orderdate >= TIMESTAMP_NTZ'1999-06-01'").select("o_orderkey")


@query("src_22_fresh_pages", "SELECT page_id FROM pages WHERE page_id % 12 <= 6")
def src_22(spark, sf_dir):
    now = F.lit("2026-01-01 12:00:00").cast("timestamp")
    pages_ = table(spark, sf_dir, "pages").withColumn("fetched_at", now - F.make_interval(hours=(F.col("page_id") % 12).cast("int")))
    return landed.fresh_pages(pages_.withColumn("url", F.concat("url", F.col("page_id").cast("string"))), now).select("page_id")


@query(
    "src_23_links",
    f"""WITH p AS (SELECT page_id, {D_BARE} AS h FROM pages), n AS (SELECT page_id, {D_ANCHOR.replace("$g", "1")} AS hrefs, {D_ANCHOR.replace("$g", "2")} AS labels FROM p),
  a AS (SELECT page_id, i, {d_plain_html("hrefs[i]")} AS href, trim(regexp_replace({d_plain_html("regexp_replace(labels[i], '(?s)<[^>]*>', ' ', 'g')")}, '\\s+', ' ', 'g')) AS label FROM n, LATERAL (SELECT unnest(range(1, len(hrefs) + 1)) AS i)),
  k AS (SELECT *, CASE WHEN href = '' OR regexp_matches(href, {q(SKIP_LINK)}) THEN 3 WHEN regexp_matches(lower(href) || ' ' || lower(label), 'tournament|event|schedule|showcase|classic|calendar') THEN 0 WHEN contains(href, '?') THEN 2 ELSE 1 END AS kind FROM a),
  f AS (SELECT * FROM k WHERE kind < 3 QUALIFY row_number() OVER (PARTITION BY page_id, href ORDER BY i) = 1)
  SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY kind, length(href) - length(replace(regexp_replace(href, '^https?://', ''), '/', '')), length(href), href, i) AS INT) AS rank, href, label, CASE kind WHEN 0 THEN 'event' WHEN 1 THEN 'page' ELSE 'query' END AS kind FROM f""",
)
def src_23(spark, sf_dir):
    return landed.ranked_links(table(spark, sf_dir, "pages"))


@query("src_23_link_counts", "SELECT page_id, len(regexp_extract_all(regexp_replace(html, '(?is)<(script|style)\\b[^>]*>.*?</(script|style)\\s*>|<!--.*?-->', ' ', 'g'), '(?is)<a\\b[^>]*?href\\s*=\\s*[\"'']([^\"'']*)[\"''][^>]*>(.*?)</a>')) AS links FROM pages")
def src_23_counts(spark, sf_dir):
    from gatherline.functions.pages import links

    return table(spark, sf_dir, "pages").select("page_id", F.size(links(F.col("html"))).alias("links"))


@query("src_24_page_blocks", f"""WITH l AS (SELECT page_id, {D_LINES} AS lines FROM pages), u AS (SELECT page_id, i - 1 AS line_no, lines[i] AS line, len(lines) AS total FROM l, LATERAL (SELECT unnest(range(1, len(lines) + 1)) AS i)),
  n AS (SELECT *, min(line_no) OVER (PARTITION BY page_id ORDER BY line_no ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt FROM u WHERE regexp_matches(line, '[0-9]')) SELECT page_id, CAST(line_no AS INT) AS line_no, md5(line) AS line_md5, CAST(least(7, coalesce(nxt, total) - line_no - 1) AS INT) AS block_lines FROM n""")
def src_24(spark, sf_dir):
    return landed.page_blocks(table(spark, sf_dir, "pages"), r"\d").select("page_id", "line_no", F.md5("line").alias("line_md5"), F.size("block").alias("block_lines"))


_TITLE = d_squeeze(d_plain_html("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)"))


@query("src_25_titles", f"SELECT * FROM (SELECT page_id, {_TITLE} AS title FROM pages) WHERE title <> ''")
def src_25(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", page_title(F.col("html")).alias("title")).where("title IS NOT NULL")


@query("src_10_page_lines", f"WITH l AS (SELECT page_id, {D_LINES} AS lines FROM pages) SELECT page_id, CAST(i - 1 AS INT) AS line_no, md5(lines[i]) AS line_md5 FROM l, LATERAL (SELECT unnest(range(1, len(lines) + 1)) AS i)")
def src_10(spark, sf_dir):
    return landed.numbered_lines(table(spark, sf_dir, "pages"), "page_id", page_lines(F.col("html"))).select("page_id", "line_no", F.md5("line").alias("line_md5"))


@query("src_19_weather_series", "SELECT s_suppkey AS place, CAST(DATE '2026-03-01' + CAST(i AS INT) AS VARCHAR) AS day, s_suppkey % 7 + i AS rain_sum FROM supplier, range(0, 3) t(i)")
def src_19(spark, sf_dir):
    series = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("place"), F.array(*[F.lit(f"2026-03-0{i + 1}") for i in range(3)]).alias("time"), F.array(*[F.col("s_suppkey") % 7 + i for i in range(3)]).alias("rain_sum"))
    twice = series.unionByName(series)
    return landed.weather_rows(twice).select("place", F.col("day").cast("string").alias("day"), "rain_sum")


@query("src_30_union", EV + " SELECT collector, count(*) AS n FROM (SELECT 'a' AS collector FROM ev UNION ALL SELECT 'b' FROM ev WHERE ord % 2 = 0) GROUP BY collector")
def src_30(spark, sf_dir):
    ev = events(spark, sf_dir)
    return landed.union_sources({"a": ev, "b": ev.where("ord % 2 = 0").drop("venue")}).groupBy("collector").agg(F.count("*").alias("n"))


# --- sinks


@query("snk_03_report", EV + " SELECT ord, organizer, name FROM ev WHERE organizer IS NOT NULL")
def snk_03(spark, sf_dir):
    rows = events(spark, sf_dir).where("organizer IS NOT NULL").select("ord", "organizer", "name")
    return sinks.report_rows(rows, F.col("ord") % 4, "organizer", "ord")


@query("snk_04_upsert", "SELECT c_custkey, CASE WHEN o IS NOT NULL THEN 'order ' || CAST(o AS VARCHAR) ELSE c_name END AS name, c_nationkey AS nation FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderkey) AS o FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey")
def snk_04(spark, sf_dir):
    stored = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    new = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("name"), F.lit(None).cast("int").alias("nation"), F.col("o_orderkey").alias("ord"))
    return sinks.upsert(stored, new, "c_custkey")


@query("snk_05_last_nonnull", EV + " SELECT fingerprint, coalesce(max_by(venue, ord) FILTER (WHERE venue IS NOT NULL), '-') AS venue, coalesce(max_by(state, ord) FILTER (WHERE state IS NOT NULL), '-') AS state, coalesce(max_by(team_count, ord) FILTER (WHERE team_count IS NOT NULL), '-') AS team_count FROM ev GROUP BY fingerprint")
def snk_05(spark, sf_dir):
    out = sinks.last_known(events(spark, sf_dir).select("fingerprint", "ord", "venue", "state", "team_count"), "fingerprint")
    return out.select("fingerprint", *[F.coalesce(c, F.lit("-")).alias(c) for c in ("venue", "state", "team_count")])


@query("snk_07_partial", "SELECT c_custkey, c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS balance FROM customer")
def snk_07(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    stored = c.select("c_custkey", F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    updates = c.where("c_custkey % 2 = 0 OR c_custkey % 3 = 0").select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, F.col("c_acctbal") + 1).alias("balance"))
    return sinks.update_fields(stored, updates, "c_custkey")


@query("snk_08_run_log", EV + " SELECT coalesce(source_type, '-') AS source, count(*) AS rows_seen, count(DISTINCT CASE WHEN ord % 10 <> 0 THEN fingerprint END) AS rows_upserted, count(*) FILTER (WHERE ord % 10 = 0) AS errors FROM ev GROUP BY 1")
def snk_08(spark, sf_dir):
    rows = events(spark, sf_dir).select(F.coalesce("source_type", F.lit("-")).alias("source"), F.when(F.col("ord") % 10 != 0, F.col("fingerprint")).alias("dedupe_key"))
    return sinks.run_log(rows)


@query("snk_09_contacts", EV + " SELECT id AS dedupe_key, 'v' || id || '@mail.test' AS email, 'vendor/sponsor' AS role, 0.9::DOUBLE AS confidence FROM ev UNION ALL SELECT id, 'd@mail.test', 'director', 0.7::DOUBLE FROM ev WHERE ord % 2 = 0")
def snk_09(spark, sf_dir):
    person = lambda mail, role: F.struct(F.lit("A B").alias("name"), mail.alias("email"), F.lit("").alias("phone"), F.lit(role).alias("role"))
    two = F.array(person(F.concat(F.lit("V"), "id", F.lit("@mail.test")), "vendor"), person(F.when(F.col("ord") % 2 == 0, "d@mail.test").otherwise(""), "director"))
    return sinks.contact_rows(events(spark, sf_dir).select(F.col("id").alias("dedupe_key"), two.alias("contacts"))).select("dedupe_key", "email", "role", "confidence")


@query("snk_12_pending", "SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority LIKE '1%')")
def snk_12(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return sinks.pending(o.select("o_custkey").distinct(), o.where("o_orderpriority LIKE '1%'"), "o_custkey")


@query("snk_13_replay", "SELECT o_custkey, max(o_orderkey) AS latest FROM orders GROUP BY o_custkey")
def snk_13(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").alias("latest"), F.col("o_orderkey").alias("ord"))
    once = sinks.upsert(rows.select("o_custkey", "latest").limit(0), rows, "o_custkey")
    return sinks.upsert(once, rows, "o_custkey")


# --- streams (over tables; the same functions run on streams, see the tests)


@query("str_01_tumbling", "SELECT strftime(time_bucket(INTERVAL 6 HOURS, ts), '%Y-%m-%d %H') AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def str_01(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    out = flows.windowed_counts(e, "ts", ["event_type"], "6 hours")
    return out.select(F.date_format("window_start", "yyyy-MM-dd HH").alias("window_start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("str_02_sliding", "SELECT strftime(w, '%Y-%m-%d %H') AS window_start, count(*) AS n FROM (SELECT time_bucket(INTERVAL 1 HOURS, ts) - INTERVAL 1 HOURS * i AS w FROM events, range(0, 3) t(i)) GROUP BY ALL")
def str_02(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return flows.windowed_counts(e, "ts", [], "3 hours", "1 hour").select(F.date_format("window_start", "yyyy-MM-dd HH").alias("window_start"), "n")


@query("str_03_sessions", "WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 8 HOURS THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT user_id, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, n, count(*) AS sessions FROM (SELECT user_id, k, count(*) AS n FROM s GROUP BY ALL) GROUP BY user_id, n")
def str_03(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return flows.sessions(e, "ts", ["user_id"], "8 hours").groupBy("user_id", "n").agg(F.count("*").alias("sessions"))


@query("src_28_document_hints", f"SELECT doc_id, len(list_distinct(regexp_extract_all(lower(text), {q('[a-z0-9.-]+[.]com')}))) AS domains FROM documents WHERE text IS NOT NULL")
def src_28(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("text IS NOT NULL")
    return docs.select("doc_id", F.size(F.array_distinct(F.regexp_extract_all(F.lower(text("text")), F.lit("([a-z0-9.-]+[.]com)"), F.lit(1)))).alias("domains"))


_ADDRESS_SQL = q(vocab.SITE_ADDRESS)
_HINTED = """SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN coalesce(text, '') WHEN 1 THEN coalesce(text, '') || ' hosted by Otter Club ' || CAST(doc_id % 7 AS VARCHAR(3)) || '. Mail Info@Otter' || CAST(doc_id % 7 AS VARCHAR(3)) || '.org or x@gmail.com' WHEN 2 THEN coalesce(text, '') || ' see https://www.elm' || CAST(doc_id % 5 AS VARCHAR(3)) || '.org/rules and www.tourneymachine.com/x'
  WHEN 3 THEN coalesce(text, '') || ' presented by the Pine Valley Lacrosse Club' WHEN 4 THEN 'a@b' || CAST(doc_id % 3 AS VARCHAR(3)) || '.net http://b' || CAST(doc_id % 3 AS VARCHAR(3)) || '.net A@b' || CAST(doc_id % 3 AS VARCHAR(3)) || '.net' END AS text FROM $documents"""


@query(
    "src_28_hints",
    f"""WITH d AS ({_HINTED.replace("$documents", "documents")}), r AS (SELECT doc_id, list_distinct(list_transform(regexp_extract_all(coalesce(text, ''), {q(vocab.EMAIL)}), lambda e: lower(e))) AS mails,
    list_transform(regexp_extract_all(coalesce(text, ''), {_ADDRESS_SQL}, 1), lambda h: lower(h)) AS hosts, len(regexp_extract_all(coalesce(text, ''), {q(vocab.HOSTED_BY)}, 1)) AS named FROM d),
  m AS (SELECT doc_id, unnest(list_distinct(list_concat(list_transform(mails, lambda e: regexp_replace(split_part(e, '@', 2), '\\.+$', '')), hosts))) AS domain FROM r),
  k AS (SELECT m.doc_id, domain, len(list_filter(mails, lambda e: regexp_replace(split_part(e, '@', 2), '\\.+$', '') = domain)) AS emails, len(list_filter(hosts, lambda h: h = domain)) AS addresses FROM m JOIN r USING (doc_id)
    WHERE NOT list_contains({d_list(FREE_MAIL)}, domain) AND NOT regexp_matches(domain, {q(vocab.PLATFORM_HOST)}) AND NOT ends_with(domain, '.pdf'))
  SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY emails DESC, domain) AS INT) AS rank, domain, CAST(emails AS INT) AS emails, CAST(addresses AS INT) AS addresses, least(3, named)::INT AS named, CASE WHEN emails > 0 THEN 0.6::DOUBLE ELSE 0.45::DOUBLE END AS confidence FROM k JOIN r USING (doc_id)
  UNION ALL SELECT doc_id, 1::INT, '-', 0::INT, 0::INT, least(3, named)::INT, 0.4::DOUBLE FROM r WHERE named > 0 AND doc_id NOT IN (SELECT doc_id FROM k)""",
)
def src_28_hints(spark, sf_dir):
    """Emails, site addresses and hosts in the documents' texts; to most of them some are added, as the table has few."""
    made = spark.sql(_HINTED.replace("$documents", "{documents}"), documents=table(spark, sf_dir, "documents"))
    out = landed.document_hints(made)
    return out.select("doc_id", "rank", F.coalesce("domain", F.lit("-")).alias("domain"), F.size("emails").alias("emails"), "addresses", F.size("hosted_by").alias("named"), "confidence")
