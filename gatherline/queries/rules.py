"""Queries over gates, filters and scores (FIL, SCO)."""

from __future__ import annotations

from pyspark.sql import functions as F

from gatherline import vocab
from gatherline.functions.values import round_even, text
from gatherline.operators import cleanse, gate, scores
from gatherline.queries.base import AS_OF, EV, d_first, d_levels, d_link_tokens, events, pick, q, query, table

DAY = f"DATE '{AS_OF}'"

CANDIDATES_SQL = f"""
SELECT o.o_orderkey AS id, {pick("o.o_orderkey % 9", ["lacrosse", "soccer", "chess", None, "hockey", "lacrosse", "football", "baseball", "softball"])} AS sport,
  CASE WHEN o.o_orderkey % 23 = 1 THEN NULL ELSE CAST(o.o_orderdate AS DATE) END AS start_date,
  CASE WHEN o.o_orderkey % 17 = 2 THEN NULL ELSE CAST(o.o_orderkey % 5 AS INT) END AS days,
  CASE WHEN o.o_orderkey % 19 = 3 THEN NULL ELSE CAST(floor(o.o_totalprice / 8000) AS INT) END AS team_count,
  {pick("c.c_nationkey % 7", ["MA", "NY", "TX", "NH", "CA", "PA", "VT"])} AS st, c.c_name AS town, o.o_custkey % 3 = 0 AS sent
FROM $orders o JOIN $customer c ON o.o_custkey = c.c_custkey"""


def candidates(spark, sf_dir):
    """Stored candidates derived from orders and customers."""
    df = spark.sql(CANDIDATES_SQL.replace("$orders", "{orders}").replace("$customer", "{customer}"), orders=table(spark, sf_dir, "orders"), customer=table(spark, sf_dir, "customer"))
    towns = F.when(F.col("id") % 13 == 5, F.array().cast("array<string>")).otherwise(F.array(F.concat_ws(", ", "town", "st"), F.lit("Far, TX")))
    return df.withColumns({"city_states": towns, "sent_at": F.when(F.col("sent"), F.lit("1998-01-01").cast("timestamp"))})


_sports = ", ".join(map(q, ["lacrosse", "soccer", "baseball", "softball", "volleyball", "hockey", "field hockey", "football"]))
_states = ", ".join(map(q, ["MA", "NH", "CT", "RI", "NY", "NJ", "PA", "MD", "VT", "ME"]))
GATED = (
    "WITH c AS ("
    + CANDIDATES_SQL.replace("$orders", "orders").replace("$customer", "customer")
    + f"), g AS (SELECT *, coalesce(team_count, 0) >= 30 AND coalesce(days, 1) <= 3 AND sport IN ({_sports}) AND (id % 13 <> 5 AND st IN ({_states})) AND (start_date >= {DAY}) AS gate_passed FROM c)"
)


@query("fil_02_gate", GATED + " SELECT id, coalesce(CAST(gate_passed AS VARCHAR), 'null') AS gate FROM g")
def fil_02(spark, sf_dir):
    out = gate.gate(candidates(spark, sf_dir), gate.default_rules(spark), AS_OF)
    return out.select("id", F.coalesce(F.col("gate_passed").cast("string"), F.lit("null")).alias("gate"))


@query("fil_03_regate", GATED + f" SELECT count(*) AS total, count(*) FILTER (WHERE gate_passed IS DISTINCT FROM (coalesce(team_count, 0) >= 10 AND coalesce(days, 1) <= 3 AND sport IN ({_sports}) AND (id % 13 <> 5 AND st IN ({_states})))) AS changed FROM g")
def fil_03(spark, sf_dir):
    rules = gate.default_rules(spark)
    edited = rules.withColumn("value", F.when(F.col("key") == "min_teams", "10").when(F.col("key") == "future_only", "false").otherwise(F.col("value")))
    out = gate.gate(candidates(spark, sf_dir), rules, AS_OF)
    # A rule that is switched off drops out: NOT false OR null is true.
    return gate.regate(out, edited, AS_OF)


@query("fil_04_queue", GATED + " SELECT id, town, st, CAST(start_date AS VARCHAR) AS start_date, team_count FROM g WHERE gate_passed AND NOT sent")
def fil_04(spark, sf_dir):
    out = gate.queue(gate.gate(candidates(spark, sf_dir), gate.default_rules(spark), AS_OF))
    return out.select("id", "town", "st", F.col("start_date").cast("string").alias("start_date"), "team_count")


_end = "CASE WHEN end_date < start_date THEN start_date ELSE end_date END"
_reject = "CASE WHEN length(coalesce(name, '')) < 3 THEN 'no_name' WHEN coalesce(sport, '') = '' THEN 'no_sport' WHEN start_date IS NULL THEN 'no_date' END"
_flags = f"""coalesce(array_to_string([CASE WHEN {DAY} - start_date > 30 THEN 'stale_date:' || CAST(start_date AS VARCHAR) END, CASE WHEN start_date > {DAY} + 540 THEN 'far_future' END, CASE WHEN end_date < start_date THEN 'end_before_start' END,
  CASE WHEN {_end} - start_date > 14 THEN 'long_span' END, CASE WHEN coalesce(state, '') = '' THEN 'no_state' END, CASE WHEN gender = 'unknown' THEN 'gender_unknown' END], ','), '')"""


@query("fil_01_validate", EV + f" SELECT ord, {_reject} IS NULL AS accepted, coalesce({_reject}, {_flags}) AS flags, coalesce(CAST(CASE WHEN {_reject} IS NULL THEN {_end} ELSE end_date END AS VARCHAR), '-') AS end_date FROM ev")
def fil_01(spark, sf_dir):
    out = cleanse.validate(events(spark, sf_dir), AS_OF)
    return out.select("ord", "accepted", F.array_join("flags", ",").alias("flags"), F.coalesce(F.col("end_date").cast("string"), F.lit("-")).alias("end_date"))


@query(
    "fil_01_counts",
    EV + f", v AS (SELECT {_reject} AS r, string_split({_flags}, ',') AS f FROM ev), l AS (SELECT CASE WHEN r IS NULL THEN list_append(list_transform(list_filter(f, lambda x: x <> ''), lambda x: 'flag_' || string_split(x, ':')[1]), 'accepted') ELSE ['reject_' || r] END AS x FROM v) SELECT flag, count(*) AS n FROM (SELECT unnest(x) AS flag FROM l) GROUP BY flag",
)
def fil_01_counts(spark, sf_dir):
    return cleanse.validation_counts(cleanse.validate(events(spark, sf_dir), AS_OF))


@query("fil_05_flags", EV + f""" SELECT ord, coalesce(array_to_string([CASE WHEN e < start_date THEN 'end before start' END, CASE WHEN e - start_date > 3 THEN CAST(e - start_date + 1 AS VARCHAR) || ' days long (league or camp?)' END, CASE WHEN start_date > {DAY} + 550 THEN 'more than 18 months out' END,
  CASE WHEN coalesce(state, '') = '' THEN 'no state' END, CASE WHEN coalesce(city, '') = '' AND coalesce(venue, '') = '' THEN 'no town or venue' END, CASE WHEN coalesce(gender, '') IN ('', 'unknown') THEN 'gender unknown' END,
  CASE WHEN regexp_matches(coalesce(name, ''), '(?i)\\b(learn more|register|view event|details|tbd)\\b') THEN 'name looks like page text' END], '; '), '') AS flags,
  (e < start_date OR e - start_date > 3 OR start_date > {DAY} + 550 OR regexp_matches(coalesce(name, ''), '(?i)\\b(learn more|register|view event|details|tbd)\\b')) OR coalesce(state, '') = '' OR (coalesce(city, '') = '' AND coalesce(venue, '') = '') AS needs_check
  FROM (SELECT *, coalesce(end_date, start_date) AS e FROM ev WHERE start_date IS NOT NULL)""")  # fmt: skip
def fil_05(spark, sf_dir):
    c = F.col
    ev = events(spark, sf_dir).where("start_date IS NOT NULL")
    flags = gate.data_flags(c("name"), c("start_date"), c("end_date"), c("city"), c("state"), c("venue"), c("gender"), F.lit(""), F.lit(AS_OF).cast("date"))
    return ev.select("ord", F.array_join(flags, "; ").alias("flags"), gate.needs_check(flags, F.lit("NEW")).alias("needs_check"))


@query("fil_06_rolling_slice", "SELECT page_id FROM pages WHERE CAST('0x' || right(md5(url), 6) AS BIGINT) % 4 = 2")
def fil_06(spark, sf_dir):
    return table(spark, sf_dir, "pages").where(gate.rolling_slice(F.md5("url"), F.lit(6))).select("page_id")


@query("fil_07_history", EV + f" SELECT ord FROM ev WHERE lower(coalesce(sport, '')) IN ({', '.join(map(q, vocab.TRACKED_SPORTS))}) AND start_date >= DATE '2014-01-01' - 7000 AND coalesce(end_date, start_date) < {DAY} AND NOT regexp_matches(coalesce(name, ''), {q(vocab.JUNK_EVENT_NAME)})")
def fil_07(spark, sf_dir):
    # The supplied orders all lie before 2014, so both dates are moved 7,000 days on.
    c = F.col
    on = lambda d: F.date_add(d, 7000)
    return events(spark, sf_dir).where(gate.admissible_history(c("name"), c("sport"), on(c("start_date")), on(c("end_date")), F.date_add(F.lit(AS_OF).cast("date"), 7000))).select("ord")


@query("fil_08_finished", EV + f" SELECT ord FROM ev WHERE end_date < {DAY} AND end_date >= {DAY} - 10 AND end_date - start_date <= 6")
def fil_08(spark, sf_dir):
    return events(spark, sf_dir).where(gate.just_finished(F.col("start_date"), F.col("end_date"), F.lit(AS_OF).cast("date"))).select("ord")


_shown = EV + f""", r AS (SELECT id, {pick("ord % 6", ["wg-a", "org-b", "recurrence", "tourneymachine", "sheet", "wg-c"])} AS source, CASE WHEN ord % 4 = 1 THEN 'duplicate' END AS status, CASE WHEN ord % 4 = 1 THEN CAST(ord - 1 - ord % 3 AS VARCHAR) END AS duplicate_of, start_date, end_date FROM ev)"""


@query("fil_09_shown_rows", _shown + f" SELECT r.id FROM r LEFT JOIN r t ON r.duplicate_of = t.id WHERE (r.status IS NULL OR r.status <> 'duplicate' OR regexp_matches(coalesce(t.source, ''), '^(wg|org)-')) AND NOT regexp_matches(coalesce(r.source, ''), '^(wg|org)-') AND coalesce(r.end_date, r.start_date) >= {DAY}")
def fil_09(spark, sf_dir):
    source = pick("ord % 6", ["wg-a", "org-b", "recurrence", "tourneymachine", "sheet", "wg-c"])
    rows = events(spark, sf_dir).selectExpr("id", f"{source} AS source", "CASE WHEN ord % 4 = 1 THEN 'duplicate' END AS status", "CASE WHEN ord % 4 = 1 THEN CAST(ord - 1 - ord % 3 AS string) END AS duplicate_of", "start_date", "end_date")
    return gate.shown_rows(rows, F.lit(AS_OF).cast("date")).select("id")


@query("fil_10_name_verdict", EV + """ SELECT ord, CASE WHEN name = '' THEN 'no_tournament_word' WHEN regexp_matches(name, '(?i)\\|.*\\|') THEN 'junk' WHEN regexp_matches(name, '(?i)\\b(training|camps?)\\b') THEN 'not_event' ELSE 'keep' END AS verdict FROM ev""")
def fil_10(spark, sf_dir):
    return events(spark, sf_dir).select("ord", F.coalesce(gate.name_verdict(F.col("name")), F.lit("keep")).alias("verdict"))


@query("fil_11_horizon", EV + f" SELECT ord FROM ev WHERE start_date BETWEEN {DAY} - 1 AND {DAY} + 550")
def fil_11(spark, sf_dir):
    return events(spark, sf_dir).where(gate.in_horizon(F.col("start_date"), F.lit(AS_OF).cast("date"))).select("ord")


@query("fil_12_grey", EV + " SELECT ord FROM ev WHERE ord % 3 <> 0 AND organizer IS NOT NULL AND organizer NOT IN (SELECT organizer FROM ev WHERE customer % 40 < 20 AND organizer IS NOT NULL)")
def fil_12(spark, sf_dir):
    ev = events(spark, sf_dir).where("organizer IS NOT NULL").withColumn("dedupe_key", F.col("id"))
    return gate.grey_rows(ev, ev.where("ord % 3 = 0"), ev.where("customer % 40 < 20")).select("ord")


@query("fil_13_verify", EV + f" SELECT ord, len(t) > 0 AND len(list_filter(t, lambda w: w <> 'harvest')) >= CASE WHEN len(t) >= 3 THEN len(t) - 1 ELSE len(t) END AND ord % 2 = 0 AS verified FROM (SELECT ord, {d_link_tokens('name')} AS t FROM ev)")
def fil_13(spark, sf_dir):
    from gatherline.functions.names import link_tokens
    from gatherline.functions.values import members

    t = link_tokens(F.col("name"))
    return events(spark, sf_dir).select("ord", gate.page_verifies(t, F.array_except(t, members(["harvest"])), F.col("ord") % 2 == 0).alias("verified"))


@query("fil_14_state_repair", EV + " SELECT ord, CASE WHEN coalesce(state, '') = '' THEN 'PA' ELSE upper(state) END AS state, coalesce(state, '') = '' AS repaired FROM ev")
def fil_14(spark, sf_dir):
    from gatherline.functions.places import address_town

    told = F.split_part(address_town(F.lit("1 Oak Ave, Elm Falls,, PA 19000")), F.lit(", "), F.lit(2))
    lost = text("state") == ""
    return events(spark, sf_dir).select("ord", F.when(lost, told).otherwise(F.upper("state")).alias("state"), lost.alias("repaired"))


# --- scores

FEST = """WITH d AS (SELECT doc_id, coalesce(text, '') AS t, CASE WHEN doc_id % 7 = 0 THEN 0 ELSE (doc_id * 37) % 9000 END AS att, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE (doc_id * 11) % 700 END AS fee,
  CASE WHEN doc_id % 4 = 0 THEN NULL ELSE (doc_id * 13) % 260 END AS vendors, doc_id % 50 AS years, doc_id % 6 AS days FROM documents)"""


def _festivals(spark, sf_dir):
    return table(spark, sf_dir, "documents").selectExpr("doc_id", "coalesce(text, '') AS t", "CASE WHEN doc_id % 7 = 0 THEN 0 ELSE (doc_id * 37) % 9000 END AS att", "CASE WHEN doc_id % 5 = 0 THEN NULL ELSE (doc_id * 11) % 700 END AS fee", "CASE WHEN doc_id % 4 = 0 THEN NULL ELSE (doc_id * 13) % 260 END AS vendors", "doc_id % 50 AS years", "doc_id % 6 AS days")


_parts = [
    ("greatest(0, least(100, 45 * log10(greatest(att, 1) / 300.0)))", 5, "att <> 0"),
    ("greatest(0, least(100, (fee - 25) / 575.0 * 100))", 2, "fee <> 0"),
    ("CASE WHEN vendors < 15 THEN 40 WHEN vendors <= 100 THEN 100 ELSE greatest(0, 100 - (vendors - 100) * 0.45::DOUBLE) END", 3, "vendors <> 0"),
    ("greatest(0, least(100, (att / vendors - 30) / 170.0 * 100))", 4, "att <> 0 AND vendors <> 0"),
    ("greatest(0, least(100, years / 40.0 * 100))", 1, "years <> 0"),
    ("CASE days WHEN 1 THEN 10 WHEN 2 THEN 40 WHEN 3 THEN 55 WHEN 4 THEN 55 ELSE 30 END", 1, "days <> 0"),
]
_sum = " + ".join(f"CASE WHEN {c} THEN CAST({p} AS DOUBLE) * {w} ELSE 0 END" for p, w, c in _parts)
_weight = " + ".join(f"CASE WHEN {c} THEN {w} ELSE 0 END" for _, w, c in _parts)
_adj = f"CASE WHEN regexp_matches(t, {q(vocab.BIG_FESTIVAL)}) THEN 10 ELSE 0 END - CASE WHEN regexp_matches(t, {q(vocab.SMALL_FESTIVAL)}) THEN 12 ELSE 0 END"


@query("sco_04_festival_size", FEST + f" SELECT doc_id, coalesce(CAST(round_even(CASE WHEN w > 0 THEN greatest(0, least(100, s / w + a)) END, 0) AS INT), -1) AS score, round(least(1.0, w / 13.0), 2) AS confidence FROM (SELECT doc_id, {_sum} AS s, {_weight} AS w, {_adj} AS a FROM d)")
def sco_04(spark, sf_dir):
    c = F.col
    s = scores.festival_size(c("att"), c("fee"), c("vendors"), c("years"), c("days"), c("t"))
    return _festivals(spark, sf_dir).select("doc_id", F.coalesce(s["score"], F.lit(-1)).alias("score"), s["confidence"].alias("confidence"))


_hit = lambda p: f"regexp_matches(w, {q(p)})"
_tags = "coalesce(array_to_string([" + ", ".join(f"CASE WHEN {_hit(p)} THEN {q(t)} END" for t, p, _ in vocab.FESTIVAL_SIGNALS) + "], ','), '')"
_delta = " + ".join(f"CASE WHEN {_hit(p)} THEN {d} ELSE 0 END" for _, p, d in vocab.FESTIVAL_SIGNALS if d)
_signal_words = "lower(CASE doc_id % 5 WHEN 0 THEN 'Fairground park, beer and live music. ' WHEN 1 THEN 'Indoor craft fair downtown, juried; free admission. ' WHEN 2 THEN 'Farm orchard, hayride, parking: $5 ' ELSE '' END || coalesce(text, ''))"


@query("sco_05_festival_signals", f"SELECT doc_id, {_tags} AS tags, greatest(20, least(85, 50 + {_delta})) AS destination FROM (SELECT doc_id, {_signal_words} AS w FROM documents)")
def sco_05(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.expr(_signal_words).alias("w"))
    s = scores.festival_signals(F.col("w"))
    return docs.select("doc_id", F.array_join(s["tags"], ",").alias("tags"), s["destination"].alias("destination"))


@query(
    "sco_06_festival_fit",
    f"""WITH s AS (SELECT doc_id, w, string_split({_tags}, ',') AS tags, greatest(20, least(85, 50 + {_delta})) AS dest,
    CASE doc_id % 6 WHEN 0 THEN 'Harvest Fest' WHEN 1 THEN 'Craft Fair' WHEN 2 THEN 'Charity Gala' ELSE '12th annual Town Day' END AS name, DATE '2026-09-01' + CAST(doc_id % 30 AS INT) AS sd, CAST(doc_id % 4 AS INT) AS len, (doc_id * 11) % 700 AS fee, doc_id % 100 AS size
    FROM (SELECT doc_id, {_signal_words} AS w FROM documents)),
  t AS (SELECT *, list_filter(list_concat(tags, [CASE WHEN name = 'Craft Fair' THEN 'craft-market' END, CASE WHEN fee > 400 THEN 'fee-over-400' END,
    CASE WHEN len(list_filter(range(0, len + 1), lambda i: isodow(sd + CAST(i AS INT)) >= 6)) = 0 THEN 'weekday-only' END, CASE WHEN sd - 20 < DATE '2026-09-01' THEN 'deadline-passed' END]), lambda x: x <> '') AS g FROM s)
  SELECT doc_id, CASE WHEN name = 'Charity Gala' THEN -1 ELSE greatest(0, least(100, 40 + CASE WHEN list_contains(g, 'family') THEN 15 ELSE 0 END + CASE WHEN list_has_any(g, ['venue:fairgrounds', 'venue:farm', 'venue:field-complex']) THEN 12 ELSE 0 END
    + CASE WHEN list_contains(g, 'ticketed') THEN 8 ELSE 0 END + CASE WHEN list_contains(g, 'paid-parking') THEN 5 ELSE 0 END + CASE WHEN list_has_any(g, ['live-music', 'food-trucks']) THEN 5 ELSE 0 END + CASE WHEN name IN ('Harvest Fest', '12th annual Town Day') THEN 10 ELSE 0 END
    + CASE WHEN name = '12th annual Town Day' THEN 6 ELSE 0 END + CASE WHEN len + 1 >= 2 THEN 5 ELSE 0 END - CASE WHEN list_contains(g, 'alcohol') AND NOT list_contains(g, 'family') THEN 10 ELSE 0 END - CASE WHEN list_contains(g, 'craft-market') THEN 15 ELSE 0 END
    - CASE WHEN list_contains(g, 'handmade-only') THEN 25 ELSE 0 END - CASE WHEN list_contains(g, 'juried') THEN 15 ELSE 0 END - CASE WHEN list_contains(g, 'commission-fee') THEN 10 ELSE 0 END - CASE WHEN list_contains(g, 'fee-over-400') THEN 12 ELSE 0 END
    - CASE WHEN list_contains(g, 'weekday-only') THEN 20 ELSE 0 END - CASE WHEN list_contains(g, 'deadline-passed') THEN 10 ELSE 0 END - CASE WHEN list_contains(g, 'venue:downtown') AND NOT list_contains(g, 'venue:park') THEN 6 ELSE 0 END - CASE WHEN list_contains(g, 'indoor') THEN 8 ELSE 0 END
    + CAST(trunc((size - 50) * 0.3::DOUBLE) AS INT) + CAST(trunc((dest - 50) * 0.2::DOUBLE) AS INT))) END AS fit, array_to_string(g, ',') AS tags FROM t""",
)
def sco_06(spark, sf_dir):
    c = F.col
    docs = table(spark, sf_dir, "documents").select("doc_id", F.expr(_signal_words).alias("w"))
    s = scores.festival_signals(c("w"))
    rows = docs.withColumns({"s": s, "name": F.expr("CASE doc_id % 6 WHEN 0 THEN 'Harvest Fest' WHEN 1 THEN 'Craft Fair' WHEN 2 THEN 'Charity Gala' ELSE '12th annual Town Day' END"), "sd": F.expr("DATE'2026-09-01' + CAST(doc_id % 30 AS INT)"), "len": F.expr("CAST(doc_id % 4 AS INT)"), "fee": F.expr("(doc_id * 11) % 700"), "size": F.expr("doc_id % 100")})
    fit = scores.festival_fit(c("name"), F.lit(""), c("s.tags"), c("fee"), c("sd"), F.date_add("sd", c("len")), F.date_sub("sd", 20), c("len") + 1, c("size"), c("s.destination"), F.lit("2026-09-01").cast("date"))
    return rows.withColumn("f", fit).select("doc_id", F.coalesce("f.fit", F.lit(-1)).alias("fit"), F.array_join("f.tags", ",").alias("tags"))


_roster = "CASE WHEN s = 'soccer' AND age <> 0 THEN CASE WHEN age <= 10 THEN 11 WHEN age <= 12 THEN 14 ELSE 16 END WHEN s = 'lacrosse' AND age <> 0 AND age <= 10 THEN 11 WHEN s = 'lacrosse' AND g = 'girls' THEN 20 ELSE CASE s " + " ".join(f"WHEN {q(k)} THEN {v}" for k, v in vocab.ROSTERS.items()) + " END END"


@query("sco_07_attendance", f"SELECT p_partkey, coalesce(CAST(CASE WHEN p_size > 0 THEN round_even(p_size * {_roster} * 2.33::DOUBLE, 0) END AS INT), -1) AS attendance FROM (SELECT p_partkey, p_size, {pick('p_partkey % 6', ['lacrosse', 'soccer', 'hockey', 'chess', 'football', 'cheer'])} AS s, {pick('p_partkey % 3', ['girls', 'boys', None])} AS g, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE 18 - (2027 + CAST(p_partkey % 12 AS INT) - 2026 - 1) END AS age FROM part)")
def sco_07(spark, sf_dir):
    rows = table(spark, sf_dir, "part").selectExpr("p_partkey", "p_size", pick("p_partkey % 6", ["lacrosse", "soccer", "hockey", "chess", "football", "cheer"]) + " AS s", pick("p_partkey % 3", ["girls", "boys", None]) + " AS g", "CASE WHEN p_partkey % 4 <> 0 THEN 2027 + CAST(p_partkey % 12 AS INT) END AS grad")
    return rows.select("p_partkey", F.coalesce(scores.attendance(F.col("p_size"), F.col("s"), F.col("g"), F.col("grad"), F.lit(2026)), F.lit(-1)).alias("attendance"))


@query(
    "sco_09_statuses",
    EV
    + f""", p AS (SELECT ord, {pick("ord % 3", ["confirmed", "review", "confirmed"])} AS decision, {pick("customer % 3", ["placeholder", "tm", "sheet"])} AS kind, CAST(ord % 7 AS INT) - 3 AS off, {pick("customer % 4", ["agrees", "town", None, "agrees"])} AS place, ord % 5 = 0 AS late FROM ev),
  s AS (SELECT ord, CASE WHEN decision <> 'confirmed' THEN 'REVIEW' WHEN abs(off) <= 2 AND place = 'agrees' THEN 'CONFIRMED' WHEN abs(off) <= 2 AND place IS NOT NULL THEN 'PLACE DIFFERS' WHEN abs(off) <= 2 THEN 'DATE CONFIRMED'
    WHEN kind = 'placeholder' THEN CASE WHEN late THEN 'DATE MOVED (week late)' ELSE 'DATE MOVED' END ELSE 'DATE CONFLICT' END AS status FROM p)
  SELECT status, count(*) AS n FROM s GROUP BY status""",
)
def sco_09(spark, sf_dir):
    ev = events(spark, sf_dir)
    pairs = ev.selectExpr("ord", pick("ord % 3", ["confirmed", "review", "confirmed"]) + " AS decision", pick("customer % 3", ["placeholder", "tm", "sheet"]) + " AS kind", "CAST(ord % 7 AS INT) - 3 AS off", pick("customer % 4", ["agrees", "town", None, "agrees"]) + " AS place", "ord % 5 = 0 AS late")
    status = scores.match_status(F.col("decision"), F.col("kind"), F.col("off"), F.col("place"), F.col("late"))
    return pairs.groupBy(status.alias("status")).agg(F.count("*").alias("n"))


@query(
    "sco_10_web_status",
    EV
    + """, f AS (SELECT ord, customer % 50 AS url, CAST(start_date AS VARCHAR) AS found, start_date + CAST(ord % 3 AS INT) AS start, CASE WHEN ord % 9 = 0 THEN 'site_old' WHEN ord % 10 = 1 THEN 'site_no_date' WHEN ord % 8 <= 2 THEN 'confirmed'
    WHEN ord % 2 = 0 THEN 'date_moved' ELSE 'date_unsure' END AS status FROM ev WHERE start_date IS NOT NULL),
  s AS (SELECT url, found, min(start) < max(start) AS several FROM f GROUP BY ALL) SELECT ord, CASE WHEN several AND status IN ('confirmed', 'date_moved') THEN 'date_unsure' ELSE status END AS status FROM f JOIN s USING (url, found)""",
)
def sco_10(spark, sf_dir):
    ev = events(spark, sf_dir).where("start_date IS NOT NULL")
    status = scores.web_status(F.col("ord") % 2 == 0, F.col("ord") % 10 != 1, F.col("ord") % 9 != 0, F.col("ord") % 8, F.lit(False))
    found = ev.select("ord", (F.col("customer") % 50).alias("url"), F.col("start_date").cast("string").alias("found"), F.date_add("start_date", (F.col("ord") % 3).cast("int")).alias("start"), status.alias("status"))
    return scores.ambiguous_dates(found).select("ord", "status")


@query("sco_11_place_check", EV + """ SELECT ord, coalesce(CASE WHEN coalesce(upper(state), '') <> '' AND upper(state) <> 'MA' THEN 'state' WHEN ord % 11 = 0 OR coalesce(city, '') = 'Oakville' THEN 'agrees' WHEN ord % 7 = 1 THEN 'agrees' WHEN coalesce(city, '') <> '' THEN 'town' WHEN ord % 7 = 2 THEN 'venue' END, '-') AS place FROM ev""")
def sco_11(spark, sf_dir):
    agree = F.when(F.col("ord") % 7 == 1, True).when(F.col("ord") % 7 == 2, False)
    place = scores.place_check(F.upper("state"), F.lit("MA"), F.col("city"), F.lit("Oakville"), F.col("ord") % 11 == 0, agree)
    return events(spark, sf_dir).select("ord", F.coalesce(place, F.lit("-")).alias("place"))


@query("sco_13_vendor_qualified", "SELECT l_suppkey AS organizer, count(*) AS max_teams, count(*) >= 20 AS qualifies FROM lineitem GROUP BY l_suppkey")
def sco_13(spark, sf_dir):
    per = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("organizer")).agg(F.count("*").alias("max_teams"))
    return per.withColumn("qualifies", scores.qualifies_vendor(F.col("max_teams")))


@query("agg_05_ratios", "SELECT s_suppkey, coalesce(CASE WHEN n <> 0 AND d <> 0 THEN round(n / d, 1) END, -1) AS ratio FROM (SELECT s_suppkey, s_suppkey % 9 AS n, s_suppkey % 5 AS d FROM supplier) WHERE (n * 10) % (CASE WHEN d = 0 THEN 1 ELSE d END) * 2 <> d")
def agg_05(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").selectExpr("s_suppkey", "s_suppkey % 9 AS n", "s_suppkey % 5 AS d").where("(n * 10) % (CASE WHEN d = 0 THEN 1 ELSE d END) * 2 <> d")
    return s.select("s_suppkey", F.coalesce(cleanse.ratio(F.col("n"), F.col("d")), F.lit(-1.0)).alias("ratio"))


@query("val_rounding", "SELECT l_orderkey, l_linenumber, round(l_quantity / 8, 2) + 0.0 AS share FROM lineitem WHERE CAST(l_quantity AS INT) % 2 = 0")
def val_rounding(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").where("CAST(l_quantity AS INT) % 2 = 0")
    return rows.select("l_orderkey", "l_linenumber", round_even(F.col("l_quantity") / 8, 2).alias("share"))


_l = d_levels("name")


@query("sco_02_levels", EV + f" SELECT ord, {d_first('array_to_string(' + _l + ', chr(32))', [('youth', 'youth'), ('hs', 'hs')], q('-'))} AS level FROM ev")
def sco_02_levels(spark, sf_dir):
    from gatherline.functions.names import level_tokens
    from gatherline.functions.values import first_case

    said = F.array_join(level_tokens(F.col("name")), " ")
    return events(spark, sf_dir).select("ord", first_case(said, [("youth", "youth"), ("hs", "hs")], F.lit("-")).alias("level"))
