"""Queries over field extraction, normal forms and keys (FLD)."""

from __future__ import annotations

from pyspark.sql import functions as F

from gatherline import vocab
from gatherline.functions import dates, names, pages, places
from gatherline.functions.values import text
from gatherline.queries.base import AS_OF, EV, d_case, d_edition_core, d_edition_words, d_first, d_identity, d_join, d_levels, d_link_name, d_link_org, d_link_tokens, d_link_venue, d_plain, d_squeeze, d_sub, events, q, query, table

DATES_EV = EV + ", raw AS (SELECT ord, strftime(start_date, '%b %-d, %Y') AS one, strftime(start_date, '%B %-d') || '-' || CAST(least(day(start_date) + 1, 28) AS VARCHAR) || ', ' || CAST(year(start_date) AS VARCHAR) AS two, start_date FROM (SELECT ord, start_date + 7305 AS start_date FROM ev WHERE start_date IS NOT NULL))"


def _dated(spark, sf_dir):
    # Years must be 2000 or later to count as years: all dates are moved on by 20 years.
    ev = events(spark, sf_dir).where("start_date IS NOT NULL").withColumn("start_date", F.date_add("start_date", 7305))
    two = F.concat(F.date_format("start_date", "MMMM d"), F.lit("-"), F.least(F.dayofmonth("start_date") + 1, F.lit(28)).cast("string"), F.lit(", "), F.year("start_date").cast("string"))
    return ev.select("ord", F.date_format("start_date", "MMM d, yyyy").alias("one"), two.alias("two"), "start_date")


def _shown(x):
    return F.coalesce(F.date_format(x, "yyyy-MM-dd"), F.lit("-"))


@query(
    "fld_01_dates_lenient",
    DATES_EV
    + """ SELECT ord, CAST(start_date AS VARCHAR) AS s1, CAST(start_date AS VARCHAR) AS e1,
  CAST(make_date(year(start_date), month(start_date), day(start_date)) AS VARCHAR) AS s2,
  CAST(greatest(start_date, make_date(year(start_date), month(start_date), least(day(start_date) + 1, 28))) AS VARCHAR) AS e2 FROM raw""",
)
def fld_01(spark, sf_dir):
    d = _dated(spark, sf_dir)
    one, two = dates.lenient_range(F.concat(F.lit("Games on "), F.upper("one"))), dates.lenient_range(F.col("two"))
    return d.select("ord", _shown(one["start"]).alias("s1"), _shown(one["end"]).alias("e1"), _shown(two["start"]).alias("s2"), _shown(two["end"]).alias("e2"))


@query(
    "fld_02_dates_strict",
    DATES_EV
    + """ SELECT ord, CAST(start_date AS VARCHAR) AS s1, CAST(start_date AS VARCHAR) AS s2,
  CAST(make_date(year(start_date), month(start_date), least(day(start_date) + 1, 28)) AS VARCHAR) AS e2 FROM raw""",
)
def fld_02(spark, sf_dir):
    d = _dated(spark, sf_dir)
    one, two = dates.strict_range(F.col("one")), dates.strict_range(F.col("two"))
    return d.select("ord", _shown(one["start"]).alias("s1"), _shown(two["start"]).alias("s2"), _shown(two["end"]).alias("e2"))


@query(
    "fld_03_find_dates",
    DATES_EV
    + """ SELECT ord, 2 AS n, CAST(start_date AS VARCHAR) || '/' || CAST(start_date AS VARCHAR) || ' ' || CAST(start_date AS VARCHAR) || '/' ||
  CAST(make_date(year(start_date), month(start_date), least(day(start_date) + 1, 28)) AS VARCHAR) AS ranges FROM raw""",
)
def fld_03(spark, sf_dir):
    found = dates.find_ranges(F.concat(F.lit("Saturday, "), "one", F.lit(" or else "), "two", F.lit(" at noon")), AS_OF)
    shown = F.array_join(F.transform(found, lambda r: F.concat_ws("/", r["start"].cast("string"), r["end"].cast("string"))), " ")
    return _dated(spark, sf_dir).select("ord", F.size(found).alias("n"), shown.alias("ranges"))


@query(
    "fld_04_year_repair",
    EV
    + f""" SELECT ord, CAST(CASE WHEN DATE '{AS_OF}' - e > 0 AND DATE '{AS_OF}' - e <= 400 THEN s + INTERVAL 1 YEAR ELSE s END AS DATE)::VARCHAR AS s,
  coalesce(CASE WHEN DATE '{AS_OF}' - e > 0 AND DATE '{AS_OF}' - e <= 400 THEN 'listed as ' || CAST(year(s) AS VARCHAR) END, '-') AS note,
  CAST(last_day(s) AS VARCHAR) AS month_end
FROM (SELECT ord, start_date AS s, coalesce(end_date, start_date) AS e FROM ev WHERE start_date IS NOT NULL)""",
)
def fld_04(spark, sf_dir):
    ev = events(spark, sf_dir).where("start_date IS NOT NULL")
    moved = dates.next_season(F.col("start_date"), F.coalesce("end_date", "start_date"), F.lit(AS_OF).cast("date"))
    span = dates.month_span(F.year("start_date"), F.month("start_date"), F.month("start_date"))
    return ev.select("ord", _shown(moved["start"]).alias("s"), F.coalesce(moved["note"], F.lit("-")).alias("note"), _shown(span["end"]).alias("month_end"))


TOWNS_SQL = EV + ", t AS (SELECT ord, coalesce(city, 'Elm Falls') || ', ' || coalesce(upper(state), 'NJ') AS a, coalesce(venue, 'Arena') || ', ' || 'Pennsylvania' AS b, city FROM ev WHERE coalesce(state, 'x') <> '' AND coalesce(city, 'x') <> '')"


@query(
    "fld_05_towns",
    TOWNS_SQL
    + """ SELECT ord, trim(string_split(a, ',')[1]) AS city, trim(string_split(a, ',')[2]) AS state, 'PA' AS state_b,
  trim(string_split(a, ',')[1]) || ', ' || trim(string_split(a, ',')[2]) AS listed FROM t""",
)
def fld_05(spark, sf_dir):
    ev = events(spark, sf_dir).where("coalesce(state, 'x') <> '' AND coalesce(city, 'x') <> ''")
    a = F.concat(F.coalesce("city", F.lit("Elm Falls")), F.lit(", "), F.coalesce(F.upper("state"), F.lit("NJ")))
    b = F.concat(F.coalesce("venue", F.lit("Arena")), F.lit(", Pennsylvania"))
    one, two = places.town_and_state(a), places.town_and_state(b)
    listed = places.towns_listed(F.array(a, F.concat(a, F.lit(" 01234")), F.concat(a, F.lit(", "), F.element_at(F.split(a, ", "), -1))))
    return ev.select("ord", one["city"].alias("city"), one["state"].alias("state"), two["state"].alias("state_b"), F.array_join(listed, "; ").alias("listed"))


@query(
    "fld_06_town_mentions",
    EV + """ SELECT ord, 'Elm Falls, NJ; Oakville, PA' AS towns FROM ev WHERE venue IS NOT NULL""",
)
def fld_06(spark, sf_dir):
    said = F.concat(F.lit("played in Elm Falls, New Jersey near "), F.lower("venue"), F.lit(" and OAKVILLE, PA 01234, then Elm Falls, NJ"))
    return events(spark, sf_dir).where("venue IS NOT NULL").select("ord", F.array_join(places.town_states(said), "; ").alias("towns"))


@query(
    "fld_07_addresses",
    EV + """ SELECT ord, CAST(10 + customer AS VARCHAR) || ' Cedar Lane, Elm Falls, NJ 01234' AS addresses, CAST(10 + customer AS VARCHAR) || ' cedar ln' AS key FROM ev""",
)
def fld_07(spark, sf_dir):
    address = F.concat((F.col("customer") + 10).cast("string"), F.lit(" Cedar Lane, Elm Falls, NJ 01234"))
    said = F.concat(F.lit("see "), address, F.lit(" or call; again "), address)
    return events(spark, sf_dir).select("ord", F.array_join(places.addresses(said), "; ").alias("addresses"), places.address_key(address).alias("key"))


@query(
    "fld_08_emails",
    f"""SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter(list_transform(regexp_extract_all(text, {q(vocab.EMAIL)}), lambda e: lower(e)),
  lambda e: NOT regexp_matches(e, {q(vocab.JUNK_EMAIL)})))), ' ') AS emails FROM documents WHERE text IS NOT NULL""",
)
def fld_08(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("text IS NOT NULL")
    return docs.select("doc_id", F.array_join(F.array_sort(pages.emails(F.col("text"))), " ").alias("emails"))


@query(
    "fld_09_contact_roles",
    EV
    + """ SELECT ord, 'vendor' || CAST(customer AS VARCHAR) || '@mail.test:vendor boss@mail.test:director info@mail.test:organizer' AS roles FROM ev""",
)
def fld_09(spark, sf_dir):
    pad = F.lit(". " + "Much more is said about fields, games and parking on this long page of the site. " * 3)
    said = F.concat(F.lit("info@mail.test"), pad, F.lit("Tournament Director: Boss@mail.test"), pad, F.lit("Vendor coordinator vendor"), F.col("customer").cast("string"), F.lit("@mail.test"), pad, F.lit("info@mail.test"))
    roles = pages.contact_roles(said)
    return events(spark, sf_dir).select("ord", F.array_join(F.transform(roles, lambda r: F.concat_ws(":", r["email"], r["role"])), " ").alias("roles"))


@query("fld_10_nearest_contact", EV + """ SELECT ord, CASE WHEN ord % 2 = 0 THEN 'near' || CAST(customer AS VARCHAR) || '@mail.test' ELSE '-' END AS email FROM ev""")
def fld_10(spark, sf_dir):
    gap = F.when(F.col("ord") % 2 == 0, F.lit(" ")).otherwise(F.lit(" " + "no words " * 60))
    said = F.concat(F.lit("far@mail.test "), F.lit("filler " * 80), F.lit("Vendors write to"), gap, F.lit("near"), F.col("customer").cast("string"), F.lit("@mail.test"))
    return events(spark, sf_dir).select("ord", F.coalesce(pages.vendor_email(said), F.lit("-")).alias("email"))


@query(
    "fld_13_grad_years",
    EV
    + """, hs AS (SELECT *, CASE WHEN age_range IN ('U14', '14U') THEN 'age' WHEN regexp_matches(coalesce(name, ''), '(?i)\\b(HS|high school|varsity|JV)\\b') THEN 'school' END AS told FROM ev)
SELECT ord, CASE told WHEN 'age' THEN CAST(2026 + 19 - 14 AS VARCHAR) WHEN 'school' THEN '2027–2030' ELSE '-' END AS label,
  CASE told WHEN 'age' THEN 2031 WHEN 'school' THEN 2027 ELSE -1 END AS grad_min, CASE told WHEN 'age' THEN 2031 WHEN 'school' THEN 2030 ELSE -1 END AS grad_max, CASE WHEN regexp_matches(coalesce(name, ''), '(?i)\\b(boys?|men)\\b') THEN
  CASE WHEN regexp_matches(name, '(?i)\\b(girls?|women)\\b') THEN 'coed' ELSE 'boys' END WHEN regexp_matches(coalesce(name, ''), '(?i)\\b(girls?|women)\\b') THEN 'girls' ELSE '-' END AS gender
FROM hs""",
)
def fld_13(spark, sf_dir):
    ev = events(spark, sf_dir)
    got = dates.grad_years(F.concat_ws(" ", "age_range", F.regexp_replace(text("name"), r"^20\d\d ", "")), F.lit(2026))
    return ev.select("ord", F.coalesce(got["label"], F.lit("-")).alias("label"), F.coalesce(got["grad_min"], F.lit(-1)).alias("grad_min"), F.coalesce(got["grad_max"], F.lit(-1)).alias("grad_max"), F.coalesce(got["gender"], F.lit("-")).alias("gender"))


@query("fld_14_gender", EV + f" SELECT ord, {d_first('lower(coalesce(name, chr(32)))', vocab.GENDER_PATTERNS, q('unknown'))} AS gender FROM ev")
def fld_14(spark, sf_dir):
    return events(spark, sf_dir).select("ord", names.gender_class(F.col("name")).alias("gender"))


_typed = "coalesce(CASE WHEN event_type <> '' THEN event_type END, 'tournament')"


@query("fld_15_event_type", EV + f" SELECT ord, {d_first('lower(coalesce(name, chr(32)))', vocab.EVENT_TYPES, _typed)} AS event_type FROM ev")
def fld_15(spark, sf_dir):
    return events(spark, sf_dir).select("ord", names.event_type(F.col("name"), F.col("event_type")).alias("event_type"))


_sports = [(rx, s) for s, rx in vocab.SPORT_PATTERNS]


@query("fld_16_sport", EV + f" SELECT ord, {d_first('lower(organizer || chr(32) || coalesce(sport, venue, chr(32)))', _sports, q('-'))} AS sport FROM ev WHERE organizer IS NOT NULL")
def fld_16(spark, sf_dir):
    said = F.concat_ws(" ", "organizer", F.coalesce("sport", "venue", F.lit(" ")))
    return events(spark, sf_dir).where("organizer IS NOT NULL").select("ord", F.coalesce(names.sport_class(said), F.lit("-")).alias("sport"))


@query(
    "fld_17_team_int",
    EV
    + """ SELECT ord, coalesce(CASE WHEN regexp_full_match(replace(trim(coalesce(team_count, '')), ',', ''), '[0-9]+') THEN CAST(replace(trim(team_count), ',', '') AS INT) END, -1) AS teams,
  CASE WHEN customer % 700 BETWEEN 10 AND 600 THEN customer % 700 ELSE -1 END AS told, '8:00 AM' AS first_time, '5:30 PM' AS last_time FROM ev""",
)
def fld_17(spark, sf_dir):
    told = dates.team_count(F.concat(F.lit("Team cap: "), (F.col("customer") % 700).cast("string"), F.lit(" per weekend")))
    times = dates.clock_times(F.lit("gates 5:30 pm, first game 8 a.m. and noon 12:15 PM"))
    return events(spark, sf_dir).select("ord", F.coalesce(dates.team_int(F.col("team_count")), F.lit(-1)).alias("teams"), F.coalesce(told, F.lit(-1)).alias("told"), times["first"].alias("first_time"), times["last"].alias("last_time"))


_core = d_plain(d_sub("lower(name)", vocab.CORE_STOP))
_bare = "trim(regexp_replace(lower(name), '[^a-z0-9 ]+', ' ', 'g'))"


@query("fld_18_names", EV + f" SELECT ord, {d_link_name('name')} AS link_name, CASE WHEN name <> '' THEN CASE WHEN {_core} <> '' THEN {_core} ELSE {_bare} END ELSE '-' END AS core_name FROM ev")
def fld_18(spark, sf_dir):
    return events(spark, sf_dir).select("ord", names.link_name(F.col("name")).alias("link_name"), F.coalesce(names.core_name(F.col("name")), F.lit("-")).alias("core_name"))


@query(
    "fld_19_tokens",
    EV
    + f""" SELECT ord, {d_join(d_link_tokens("name"))} AS tokens, {d_join(d_identity("name"))} AS identity, {d_join(d_levels("name"))} AS levels,
  {d_join(d_edition_core("name"))} AS core, {d_join(d_edition_words("name"))} AS words FROM ev""",
)
def fld_19(spark, sf_dir):
    joined = lambda x: F.array_join(F.array_sort(x), " ")
    n = F.col("name")
    return events(spark, sf_dir).select(
        "ord", joined(names.link_tokens(n)).alias("tokens"), joined(names.identity_tokens(n)).alias("identity"), joined(names.level_tokens(n)).alias("levels"), joined(names.edition_core(n)).alias("core"), joined(names.edition_distinctive(n)).alias("words")
    )


_suffix = "trim(" + d_sub(d_plain("lower(organizer)"), vocab.COMPANY_WORDS, "") + ")"
_common = vocab.ORGANIZERS_COMMON
_core_org = f"coalesce({d_case(_suffix, _common, 'NULL')}, {d_case('trim(lower(organizer))', _common, 'NULL')}, CASE WHEN {_suffix} <> '' THEN {_suffix} END)"


@query("fld_20_organizers", EV + f" SELECT ord, {d_link_org('organizer')} AS link_org, coalesce(CASE WHEN organizer <> '' THEN {_core_org} END, '-') AS core_org FROM ev")
def fld_20(spark, sf_dir):
    return events(spark, sf_dir).select("ord", names.link_organizer(F.col("organizer")).alias("link_org"), F.coalesce(names.core_organizer(F.col("organizer")), F.lit("-")).alias("core_org"))


@query("fld_21_venues", EV + f" SELECT ord, {d_link_venue('venue')} AS venue_key, regexp_matches(coalesce(venue, ''), {q(vocab.COMPOUND_VENUE)}) AS compound FROM ev")
def fld_21(spark, sf_dir):
    return events(spark, sf_dir).select("ord", names.link_venue(F.col("venue")).alias("venue_key"), names.is_compound_venue(F.col("venue")).alias("compound"))


GAZETTEER = [("otter creek park", "Otter Creek", "NJ", 1), ("otter creek", "Otterville", "NY", 2), ("maple", "Mapleton", "CT", 3), ("granite fieldhouse & dome", "Granite", "NH", 4), ("north maple fields", "North Maple", "VT", 5)]


@query(
    "fld_22_gazetteer",
    EV
    + f""", gaz AS (SELECT * FROM (VALUES {", ".join(f"({q(a)}, {q(b)}, {q(c)}, {d})" for a, b, c, d in GAZETTEER)}) t(gname, gcity, gstate, gord)),
  bare AS (SELECT *, regexp_replace(venue, '^[ ,–-]+|[ ,–-]+$', '', 'g') AS v FROM ev),
  key AS (SELECT *, trim(lower(v), ' .,-') AS k FROM bare),
  hit AS (SELECT ord, first(gcity ORDER BY CASE WHEN k = gname THEN 0 ELSE 1 END, gord) AS gcity, first(gstate ORDER BY CASE WHEN k = gname THEN 0 ELSE 1 END, gord) AS gstate
    FROM key JOIN gaz ON contains(k, gname) OR contains(gname, k) WHERE coalesce(state, '') = '' AND v <> '' GROUP BY ord)
  SELECT key.ord, CASE WHEN v <> '' THEN v ELSE '-' END AS venue, coalesce(CASE WHEN hit.ord IS NOT NULL THEN coalesce(CASE WHEN city <> '' THEN city END, gcity) ELSE city END, '-') AS city,
    coalesce(CASE WHEN state <> '' THEN state END, gstate, '-') AS state,
    CASE upper(coalesce(CASE WHEN state <> '' THEN state END, gstate, '')) {" ".join(f"WHEN {q(s)} THEN {q(n)}" for n, ss in vocab.REGIONS.items() for s in ss)} ELSE 'Other' END AS region
  FROM key LEFT JOIN hit ON key.ord = hit.ord""",
)
def fld_22(spark, sf_dir):
    from gatherline.operators.cleanse import enrich

    out = enrich(events(spark, sf_dir), spark.createDataFrame(GAZETTEER, "venue string, city string, state string, ord int"))
    return out.select("ord", *[F.coalesce(c, F.lit("-")).alias(c) for c in ("venue", "city", "state")], "region")


@query("fld_23_region", EV + f""" SELECT ord, CASE upper(coalesce(state, '')) {" ".join(f"WHEN {q(s)} THEN {q(n)}" for n, ss in vocab.REGIONS.items() for s in ss)} ELSE 'Other' END AS region FROM ev""")
def fld_23(spark, sf_dir):
    return events(spark, sf_dir).select("ord", places.region(F.col("state")).alias("region"))


@query(
    "fld_24_hosts",
    """SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)), '^www\\.', '') AS host,
  array_to_string(list_reverse(list_slice(list_reverse(string_split(regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)), '^www\\.', ''), '.')), 1, 2)), '.') AS domain FROM pages""",
)
def fld_24(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", pages.host(F.col("url")).alias("host"), pages.registered_domain(F.col("url")).alias("domain"))


def _page_text_sql(x: str) -> str:
    out = d_sub(d_sub(x, r"(?is)<(script|style)\b[^>]*>.*?</(script|style)\s*>|<!--.*?-->"), r"(?s)<[^>]*>")
    for entity, plain in pages.ENTITIES:
        out = d_sub(out, entity, plain)
    return d_squeeze(out)


@query("fld_25_page_text", f"SELECT page_id, md5({_page_text_sql('html')}) AS text_md5, length({_page_text_sql('html')}) AS n_chars FROM pages")
def fld_25(spark, sf_dir):
    said = pages.page_text(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", F.md5(said).alias("text_md5"), F.length(said).alias("n_chars"))


_file = "lower(replace(coalesce(venue, 'plain'), ' ', '_')) || CASE ord % 4 WHEN 0 THEN '.pdf' WHEN 1 THEN '_logo.png' WHEN 2 THEN '.jpg' ELSE '_rules.docx' END"


@query(
    "fld_26_documents",
    EV
    + f""" SELECT ord, CASE WHEN regexp_matches({_file}, '(?i)map|layout|site|field[- ]?plan|parking|venue|complex|directions') THEN 'field_map' WHEN regexp_matches({_file}, '(?i)rule|regulation|policy|waiver|code of conduct') THEN 'rules'
  WHEN ord % 4 = 1 THEN 'logo' WHEN ord % 4 = 2 THEN 'image' ELSE 'document' END AS kind FROM ev""",
)
def fld_26(spark, sf_dir):
    name = F.expr(_file)
    return events(spark, sf_dir).select("ord", pages.document_kind(name).alias("kind"))


@query("fld_27_clubs", EV + """ SELECT ord, CASE ord % 4 WHEN 0 THEN '3d NE' WHEN 1 THEN 'CT Lightning' WHEN 2 THEN 'Aces' ELSE '-' END AS club FROM ev""")
def fld_27(spark, sf_dir):
    team = F.expr("CASE ord % 4 WHEN 0 THEN '3d NE 2028 Red' WHEN 1 THEN 'CT Lightning Gold-Wright' WHEN 2 THEN 'Aces 18-Cahill' ELSE 'TBD' END")
    return events(spark, sf_dir).select("ord", F.coalesce(names.club_from_team(team), F.lit("-")).alias("club"))


@query(
    "fld_28_divisions",
    """WITH per AS (SELECT l_orderkey AS event_id, l_shipmode_ AS division, count(DISTINCT l_suppkey) AS n FROM (SELECT *, l_returnflag || l_linestatus AS l_shipmode_ FROM lineitem) GROUP BY ALL),
  t AS (SELECT l_orderkey AS event_id, count(DISTINCT l_suppkey) AS team_count FROM lineitem GROUP BY ALL)
  SELECT event_id, team_count, count(*) AS division_count, string_agg(division || ' (' || CAST(n AS VARCHAR) || ')', '; ' ORDER BY division) AS divisions FROM per JOIN t USING (event_id) GROUP BY event_id, team_count""",
)
def fld_28(spark, sf_dir):
    from gatherline.operators.rollups import division_counts

    regs = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("event_id"), F.concat("l_returnflag", "l_linestatus").alias("division"), F.col("l_suppkey").alias("team_id"))
    return division_counts(regs, ["event_id"])


@query(
    "fld_30_sites",
    EV
    + """, v AS (SELECT ord, coalesce(name, '') AS name, CASE ord % 3 WHEN 0 THEN 'Oak College & Elm Arena' WHEN 1 THEN 'Granite Sports & Events' ELSE coalesce(venue, '-') END AS venue FROM ev),
  s AS (SELECT ord, name, CASE WHEN ord % 3 = 0 THEN ['Oak College', 'Elm Arena'] ELSE [venue] END AS sites, venue FROM v)
  SELECT ord, CASE WHEN ord % 3 = 0 THEN name || ' – Site ' || CAST(i AS VARCHAR) ELSE name END AS name, sites[i] AS venue FROM s, LATERAL (SELECT unnest(range(1, len(sites) + 1)) AS i)
  WHERE venue NOT LIKE 'Granite Fieldhouse%'""",
)
def fld_30(spark, sf_dir):
    from gatherline.operators.cleanse import site_rows, split_venues

    ev = events(spark, sf_dir).select("ord", text("name").alias("name"), F.expr("CASE ord % 3 WHEN 0 THEN 'Oak College & Elm Arena' WHEN 1 THEN 'Granite Sports & Events' ELSE coalesce(venue, '-') END").alias("venue")).where("venue NOT LIKE 'Granite Fieldhouse%'")
    return site_rows(ev, split_venues(F.col("venue")))


@query(
    "fld_31_normalize",
    EV
    + f""" SELECT ord, 'orders:' || id AS dedupe_key, coalesce(end_date - start_date + 1, -99) AS days, coalesce(end_date - start_date + 1 > 3, FALSE) AS is_league,
  coalesce(CASE WHEN regexp_full_match(replace(trim(coalesce(team_count, '')), ',', ''), '[0-9]+') THEN CAST(replace(trim(team_count), ',', '') AS INT) END, -1) AS team_count,
  coalesce(week(start_date), -1) AS calendar_week, CASE WHEN name <> '' THEN CASE WHEN {_core} <> '' THEN {_core} ELSE {_bare} END ELSE '-' END AS name_core,
  coalesce(CASE WHEN organizer <> '' THEN {_core_org} END, '-') AS organizer_canon FROM ev""",
)
def fld_31(spark, sf_dir):
    from gatherline.operators.cleanse import normalize

    none = lambda t: F.lit(None).cast(t)
    rows = events(spark, sf_dir).select(
        "ord", F.lit("orders").alias("source"), F.col("id").alias("source_event_id"), "name", "sport", F.col("organizer").alias("organizer_name"), "start_date", "end_date", "city", "state",
        F.array(F.concat_ws(", ", "city", F.upper("state"))).alias("city_states"), "team_count", none("string").alias("divisions"), F.col("age_range").alias("age_groups"), none("int").alias("venue_count"), none("boolean").alias("split_venue"), "gender", none("int").alias("expected_attendance"),
    )
    out = normalize(rows)
    return out.select("ord", "dedupe_key", F.coalesce("days", F.lit(-99)).alias("days"), "is_league", F.coalesce("team_count", F.lit(-1)).alias("team_count"), F.coalesce("calendar_week", F.lit(-1)).alias("calendar_week"), F.coalesce("name_core", F.lit("-")).alias("name_core"), F.coalesce("organizer_canon", F.lit("-")).alias("organizer_canon"))


@query(
    "fld_34_town_keys",
    EV + """ SELECT ord, regexp_replace(replace(lower(list_extract(string_split(coalesce(city, ''), ','), -1)), ' township', ''), '[^a-z]', '', 'g') AS town_key FROM ev""",
)
def fld_34(spark, sf_dir):
    return events(spark, sf_dir).select("ord", places.town_key(F.col("city")).alias("town_key"))


@query(
    "fld_35_date_labels",
    EV
    + """ SELECT ord, CASE WHEN start_date IS NULL THEN '' WHEN e = start_date THEN strftime(start_date, '%b %-d, %Y')
  WHEN date_trunc('month', e) = date_trunc('month', start_date) THEN strftime(start_date, '%b %-d') || '–' || strftime(e, '%-d, %Y')
  WHEN year(e) = year(start_date) THEN strftime(start_date, '%b %-d') || ' – ' || strftime(e, '%b %-d, %Y') ELSE strftime(start_date, '%b %-d, %Y') || ' – ' || strftime(e, '%b %-d, %Y') END AS label
  FROM (SELECT ord, start_date, coalesce(end_date, start_date) AS e FROM ev)""",
)
def fld_35(spark, sf_dir):
    return events(spark, sf_dir).select("ord", dates.date_label(F.col("start_date"), F.col("end_date")).alias("label"))


@query(
    "fld_36_sales",
    """SELECT event_id AS payment_id, CAST(CAST(timezone('America/New_York', timezone('UTC', ts)) AS DATE) AS VARCHAR) AS sale_date, hour(timezone('America/New_York', timezone('UTC', ts))) AS sale_hour,
  CASE WHEN user_id % 3 = 0 THEN 'Custom amount' ELSE 'item ' || CAST(i AS VARCHAR) END AS item_name, CASE WHEN user_id % 3 = 0 THEN CAST(round(value * 100) AS BIGINT) ELSE i * 100 END AS total_cents
  FROM events, LATERAL (SELECT unnest(CASE WHEN user_id % 3 = 0 THEN [1] ELSE [1, 2] END) AS i) WHERE event_type = 'purchase'""",
)
def fld_36(spark, sf_dir):
    from gatherline.sources.landed import sales_lines

    e = table(spark, sf_dir, "events")
    pay = e.select(F.col("event_id").alias("id"), F.col("event_id").alias("order_id"), F.lit("L1").alias("location_id"), F.col("ts").cast("timestamp").alias("created_at"), F.when(F.col("event_type") == "purchase", "COMPLETED").otherwise("FAILED").alias("status"), F.round(F.col("value") * 100).cast("long").alias("amount_cents"), F.lit(0).alias("tip_cents"), F.lit("till").alias("device_name"))
    line = lambda i: F.struct(F.lit(f"item {i}").alias("name"), F.lit("").alias("variation_name"), F.lit("1").alias("quantity"), F.lit(100 * i).cast("long").alias("total_cents"))
    orders = e.where("user_id % 3 <> 0").select(F.col("event_id").alias("id"), F.array(line(1), line(2)).alias("line_items"))
    where = spark.createDataFrame([("L1", "Stand", "America/New_York")], "id string, name string, tz string")
    return sales_lines(pay, orders, where).select("payment_id", _shown(F.col("sale_date")).alias("sale_date"), "sale_hour", "item_name", "total_cents")


_ident = d_identity("name")
_tok = d_link_tokens("name")
_group = f"""coalesce(CASE WHEN sport <> '' THEN sport END, 'lacrosse') || '|' || {d_link_org("organizer")} || '|' || strftime(date_trunc('week', start_date), '%Y-%m-%d') || '|' || CASE WHEN len({_ident}) > 0 THEN {d_join(_ident)} ELSE {d_join(_tok)} END"""


@query(
    "key_01_fingerprints",
    EV
    + f""" SELECT ord, substr(sha1(lower(coalesce(sport, '')) || '|' || lower(coalesce(organizer, '')) || '|' || regexp_replace(lower(coalesce(name, '')), '[^a-z0-9]', '', 'g') || '|' || coalesce(CAST(start_date AS VARCHAR), '') || '|' || lower(coalesce(venue, ''))), 1, 16) AS fingerprint,
  {d_link_org("organizer")} || '|' || coalesce(strftime(start_date, '%Y-%m'), 'nodate') AS blocking_key, coalesce(substr(sha1({_group}), 1, 16), '-') AS event_group FROM ev""",
)
def key_01(spark, sf_dir):
    c = F.col
    return events(spark, sf_dir).select(
        "ord",
        names.event_fingerprint(c("sport"), c("organizer"), c("name"), c("start_date"), F.lit(""), c("venue")).alias("fingerprint"),
        names.blocking_key(c("organizer"), c("start_date")).alias("blocking_key"),
        F.coalesce(names.event_group_key(c("sport"), c("organizer"), c("start_date"), c("name")), F.lit("-")).alias("event_group"),
    )
