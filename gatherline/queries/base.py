"""Registry of queries, the event rows they run on, and pieces of SQL that several oracles share.

The supplied tables hold no event listings, so listings are derived from orders, customers and parts by one statement
that Spark and DuckDB read alike. Everything after that is the library on Spark's side and plain SQL on the other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from gatherline import vocab
from gatherline.functions.pages import ENTITIES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
#: The day on which all date rules are judged.
AS_OF = "1998-06-15"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query, and the SQL that must give the same rows."""

    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(expr: str, values: Iterable[str | int | None]) -> str:
    """The value at position ``expr`` (from 0), as a CASE both engines read."""
    shown = lambda v: "NULL" if v is None else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    return f"CASE {expr} " + " ".join(f"WHEN {i} THEN {shown(v)}" for i, v in enumerate(values)) + " END"


EVENTS_SQL = f"""
SELECT o_orderkey AS ord,
  CAST(o_orderkey AS VARCHAR(20)) AS id,
  {pick("o_orderkey % 11", ["soccer", None, "hockey", ""] + ["lacrosse"] * 7)} AS sport,
  CASE WHEN o_custkey % 7 = 0 THEN 'Apex' WHEN o_custkey % 7 = 1 THEN 'APEX Lacrosse Events' WHEN o_custkey % 29 = 5 THEN NULL
       ELSE 'Org ' || CAST(o_custkey % 40 AS VARCHAR(20)) || ' Sports' END AS organizer,
  CASE WHEN o_orderkey % 31 = 7 THEN '' ELSE {pick("o_orderkey % 3", ["2026 ", "", ""])} || {pick("(o_orderkey + o_custkey) % 7", ["Red Otter", "Harvest", "Granite Boys", "Summer", "Fall Girls", "Lucky Draw", "The 5th Annual Harvest"])}
    || ' ' || {pick("o_orderkey % 5", ["Classic", "Shootout", "Showcase", "League", "Cup"])} || {pick("o_custkey % 6", ["", " - Site 2", " (Boys)", " | Day 1", " HS", " Youth"])} END AS name,
  CASE WHEN o_orderkey % 97 = 3 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS start_date,
  CASE WHEN o_orderkey % 13 = 4 THEN NULL ELSE CAST(o_orderdate AS DATE) + CAST({pick("o_orderkey % 19", [0, 1, 2, 1, 0, -3, 16] + [1] * 12)} AS INT) END AS end_date,
  {pick("(o_orderkey + 3 * o_custkey) % 10", [None, "Multiple Locations", "Otter Creek Park", "Otter Creek Sports Complex", "Granite Fieldhouse & Dome", "Maple Arena", "North Maple Fields", "", "Otter Creek - Site 2", "TBD"])} AS venue,
  {pick("o_custkey % 6", ["Oakville", "North Oakville", "", None, "Elm Falls", "oakville "])} AS city,
  {pick("o_custkey % 5", ["MA", "ny", "", None, "PA"])} AS state,
  {pick("o_orderkey % 4", ["boys", "girls", "coed", "unknown"])} AS gender,
  {pick("o_orderkey % 6", [None, "tournament", "", "league", "tournament", "tournament"])} AS event_type,
  {pick("o_orderkey % 8", ["48", " 1,024 ", "97 college coaches", "", None, "12", "30", "64"])} AS team_count,
  {pick("o_orderkey % 5", ["organizer_site", "tourney_machine", "other", None, "tourney_machine"])} AS source_type,
  {pick("o_orderkey % 3", ["alpha", "beta", ""])} AS collector,
  CAST(o_custkey AS VARCHAR(20)) || ':' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR(20)) AS fingerprint,
  {pick("o_orderkey % 9", ["U14", "14U", None, "8-18"] + [""] * 5)} AS age_range,
  o_custkey AS customer, o_totalprice AS price
FROM $orders"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event listings derived from orders: 24 columns with nulls, blanks, placeholders and near duplicates."""
    return spark.sql(EVENTS_SQL.replace("$orders", "{orders}"), orders=table(spark, sf_dir, "orders"))


#: The same rows for an oracle: starts a WITH clause.
EV = "WITH ev AS (" + EVENTS_SQL.replace("$orders", "orders") + ")"

PART_NAMES_SQL = f"""
SELECT p_partkey AS ord, p_brand AS organizer,
  {pick("p_partkey % 4", ["", "2026 ", "PT ", "Prime Time "])} || p_name || {pick("p_partkey % 6", [" Fall Classic", " Shootout", " Boys Cup", " Girls Cup 2025", " - Site 2", " lax fest"])} AS name,
  DATE '2026-01-01' + CAST((p_partkey * 7) % 120 AS INT) AS start,
  {pick("p_partkey % 5", ["MA", "NY", None, "MA", "MA"])} AS state,
  CAST(NULL AS VARCHAR(9)) AS gender,
  p_size AS teams, 1 + CAST(p_partkey % 5 AS INT) AS name_series,
  p_size % 12 AS site, p_partkey
FROM $part"""


def listed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Editions derived from parts: brand as organiser, words of the part's name, a facility number and a team count."""
    return spark.sql(PART_NAMES_SQL.replace("$part", "{part}"), part=table(spark, sf_dir, "part"))


PA = "WITH pa AS (" + PART_NAMES_SQL.replace("$part", "part") + ")"

GAMES_SQL = """
SELECT user_id % 25 AS event_id, CAST(ts AS DATE) AS date,
  CAST(480 + (extract(HOUR FROM ts) * 60 + extract(MINUTE FROM ts)) / 2 AS INT) / 10 * 10 AS minute10,
  event_type AS site, user_id % 16 AS field, value, event_id AS ord
FROM $events"""


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A game log derived from the events table: event, date, minute of the day, site and field."""
    t = table(spark, sf_dir, "events")
    return t.selectExpr(
        "user_id % 25 AS event_id", "CAST(ts AS DATE) AS date", "CAST(420 + (hour(ts) * 60 + minute(ts)) DIV 2 AS INT) AS minute", "event_type AS site", "event_type || ' ' || CAST(user_id % 16 AS string) AS field", "user_id AS team", "event_id AS ord", "value"
    )


GA = """WITH ga AS (SELECT user_id % 25 AS event_id, CAST(ts AS DATE) AS date, CAST(420 + (hour(ts) * 60 + minute(ts)) // 2 AS INT) AS minute,
  event_type AS site, event_type || ' ' || CAST(user_id % 16 AS VARCHAR) AS field, user_id AS team, event_id AS ord, value FROM events)"""

# --- pieces of DuckDB SQL


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def d_list(values: Iterable[str]) -> str:
    return "[" + ", ".join(map(q, values)) + "]"


def d_sub(x: str, pattern: str, by: str = " ") -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(by)}, 'g')"


def d_squeeze(x: str) -> str:
    return f"trim({d_sub(x, chr(92) + 's+')})"


def d_plain(x: str) -> str:
    return d_squeeze(d_sub(x, "[^a-z0-9 ]"))


def d_words(x: str) -> str:
    return f"list_distinct(list_filter(string_split({x}, ' '), lambda w: w <> ''))"


def d_without(x: str, values: Iterable[str]) -> str:
    return f"list_filter({x}, lambda w: NOT list_contains({d_list(values)}, w))"


def d_join(x: str, by: str = " ") -> str:
    return f"array_to_string(list_sort({x}), {q(by)})"


def d_link_name(x: str) -> str:
    out = f"lower(coalesce({x}, ''))"
    for cut in vocab.NAME_CUTS:
        out = d_sub(out, f"(?i){cut}")
    return d_plain(out)


def d_link_tokens(x: str) -> str:
    return d_without(d_words(d_link_name(x)), vocab.NOISE_WORDS + vocab.GENDER_WORDS)


def d_identity(x: str) -> str:
    return d_without(d_link_tokens(x), vocab.LEVEL_WORDS + vocab.GENERIC_WORDS)


def d_levels(x: str) -> str:
    named = f"list_filter({d_link_tokens(x)}, lambda w: list_contains({d_list(vocab.LEVEL_WORDS)}, w))"
    alias = "CASE w " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in vocab.LEVEL_ALIASES.items()) + " ELSE w END"
    return f"list_distinct(list_filter(list_transform({named}, lambda w: {alias}), lambda w: w <> ''))"


def d_case(x: str, table: dict[str, str], default: str) -> str:
    return f"CASE {x} " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in table.items()) + f" ELSE {default} END"


def d_link_org(x: str) -> str:
    bare = d_plain(f"lower(coalesce({x}, ''))")
    return d_case(bare, vocab.ORGANIZERS_CORE, bare)


def d_link_venue(x: str) -> str:
    bare = d_sub(f"coalesce({x}, '')", r"(?i)\s*[-–]\s*site\s*\d+\s*$")
    words = d_without(f"list_filter(string_split({d_squeeze(d_sub(f'lower({bare})', '[^a-z0-9 ]'))}, ' '), lambda w: w <> '')", vocab.FACILITY_WORDS)
    return f"CASE WHEN regexp_matches(trim(coalesce({x}, '')), {q(vocab.PLACEHOLDER_VENUE)}) THEN '' ELSE array_to_string({words}, ' ') END"


def d_first(x: str, cases: Iterable[tuple[str, str]], default: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({x}, {q(p)}) THEN {q(v)}" for p, v in cases) + f" ELSE {default} END"


def d_edition_name(x: str) -> str:
    out = d_sub(f"coalesce({x}, '')", r"(?i)\s*[-–|:]\s*site\s*\d+\s*$|\(\s*site\s*\d+\s*\)", "")
    out = d_sub(d_sub(f"lower({out})", r"\b(19|20)\d\d\b"), r"\b\d{1,2}/\d{1,2}(/\d{2,4})?\b")
    for short, long in vocab.EDITION_ABBREVIATIONS.items():
        out = d_sub(out, rf"\b{short}\b", long)
    return d_plain(out)


def d_edition_core(x: str) -> str:
    return d_without(f"list_filter({d_words(d_edition_name(x))}, lambda w: length(w) > 1 AND NOT regexp_matches(w, '^[0-9]+$'))", ["the", "of", "at", "and", "site"])


def d_edition_words(x: str) -> str:
    return f"list_filter({d_without(d_edition_core(x), vocab.EDITION_GENERIC + vocab.EDITION_ORGANIZERS)}, lambda w: NOT regexp_matches(w, '^[0-9]+(st|nd|rd|th)?$'))"


#: A page without scripts, styles and comments; its anchors' parts ($g: 1 href, 2 label) in h; and its lines of text.
D_BARE = "regexp_replace(html, '(?is)<(script|style)\\b[^>]*>.*?</(script|style)\\s*>|<!--.*?-->', ' ', 'g')"
D_ANCHOR = "regexp_extract_all(h, '(?is)<a\\b[^>]*?href\\s*=\\s*[\"'']([^\"'']*)[\"''][^>]*>(.*?)</a>', $g)"


def d_plain_html(x: str) -> str:
    """Common entities decoded, in the order of the rules."""
    for entity, plain in ENTITIES:
        x = d_sub(x, entity, plain)
    return x


D_LINES = (
    "list_filter(list_transform(string_split("
    + d_plain_html(d_sub(d_sub(D_BARE, "(?i)<(?:br|/p|/div|/li|/h[1-6]|/tr|/td|/ul|/article|/nav|/title)\\b[^>]*>", "\n"), "(?s)<[^>]*>"))
    + ", chr(10)), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))), lambda x: x <> '')"
)
