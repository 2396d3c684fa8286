"""Editable rules that decide which candidates pass, the queue of those not yet sent, and plain row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gatherline import vocab
from gatherline.functions.values import first_case, let, text


def default_rules(spark: SparkSession) -> DataFrame:
    """The rules table as it starts: key, value (JSON), description."""
    return spark.createDataFrame(vocab.GATE_RULES, "key string, value string, description string")


def _typed(rules: DataFrame) -> DataFrame:
    """One row with each rule in its type; the rules table has one row a rule, five in all."""
    of = lambda k: F.max(F.when(F.col("key") == k, F.col("value")))
    return rules.agg(
        of("min_teams").cast("int").alias("rule_min_teams"),
        of("max_days").cast("int").alias("rule_max_days"),
        F.from_json(of("sports"), "array<string>").alias("rule_sports"),
        F.from_json(of("states"), "array<string>").alias("rule_states"),
        of("future_only").cast("boolean").alias("rule_future_only"),
    )


def gate(candidates: DataFrame, rules: DataFrame, as_of: Column | str) -> DataFrame:
    """``candidates`` with gate_passed: true, false or null as SQL's three-valued logic has it.

    Reads team_count, days, sport, city_states ('Town, ST' entries) and start_date. Missing teams count as 0 and missing
    days as 1; a null sport or start makes the gate null unless another rule already fails.
    """
    as_of = F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of
    in_state = F.exists(F.coalesce("city_states", F.array().cast("array<string>")), lambda t: F.array_contains("rule_states", F.split_part(t, F.lit(", "), F.lit(2))))
    passed = (
        (F.coalesce("team_count", F.lit(0)) >= F.col("rule_min_teams"))
        & (F.coalesce("days", F.lit(1)) <= F.col("rule_max_days"))
        & F.array_contains("rule_sports", F.col("sport"))
        & in_state
        & (~F.col("rule_future_only") | (F.col("start_date") >= as_of))
    )
    joined = candidates.drop("gate_passed").crossJoin(F.broadcast(_typed(rules)))  # the right side is one row
    return joined.withColumn("gate_passed", passed).select(*[c for c in candidates.columns if c != "gate_passed"], "gate_passed")


def queue(gated: DataFrame) -> DataFrame:
    """Candidates that pass and were not yet sent."""
    return gated.where(F.col("gate_passed") & F.col("sent_at").isNull())


def regate(gated: DataFrame, rules: DataFrame, as_of: Column | str) -> DataFrame:
    """One row: how many candidates there are and how many the rules now judge differently."""
    before = gated.withColumnRenamed("gate_passed", "gate_before")
    return gate(before, rules, as_of).agg(F.count("*").alias("total"), F.count_if(~F.col("gate_before").eqNullSafe(F.col("gate_passed"))).alias("changed"))


def rolling_slice(key: Column, week: Column, slices: int = 4) -> Column:
    """Whether a hexadecimal key falls into this week's share: the same rows every ``slices`` weeks."""
    return F.conv(F.right(key, F.lit(6)), 16, 10).cast("long") % slices == week % slices


def admissible_history(name: Column, sport: Column, start: Column, end: Column, as_of: Column) -> Column:
    """A tracked sport, 2014 or later, over, and not a test entry."""
    return F.lower(text(sport)).isin(vocab.TRACKED_SPORTS) & (start >= F.lit("2014-01-01").cast("date")) & (F.coalesce(end, start) < as_of) & ~text(name).rlike(vocab.JUNK_EVENT_NAME)


def just_finished(start: Column, end: Column, as_of: Column, days: int = 10, longest: int = 6) -> Column:
    """Ended within the last ``days`` days and not longer than ``longest`` days."""
    return (end < as_of) & (end >= F.date_sub(as_of, days)) & (F.datediff(end, start) <= longest)


def shown_rows(rows: DataFrame, as_of: Column) -> DataFrame:
    """Rows of one sport that are still to be matched.

    Rows marked duplicate go, unless what they duplicate is an organiser's own row (source 'wg-' or 'org-'); so do
    organisers' rows and rows that have ended.
    """
    own = lambda c: text(c).rlike("^(wg|org)-")
    target = rows.select(F.col("id").alias("target_id"), F.col("source").alias("target_source"))
    joined = rows.join(target, rows.duplicate_of == F.col("target_id"), "left")
    keep = ((F.col("status").isNull() | (F.col("status") != "duplicate")) | own(F.col("target_source"))) & ~own(F.col("source")) & (F.coalesce("end_date", "start_date") >= as_of)
    return joined.where(keep).select(*rows.columns)


def data_flags(name: Column, start: Column, end: Column, city: Column, state: Column, venue: Column, gender: Column, date_note: Column, as_of: Column) -> Column:
    """array<string> of problems in a scraped row that would mislead readers."""
    e = F.coalesce(end, start)
    return F.filter(
        F.array(
            F.when(e < start, "end before start"),
            F.when(F.datediff(e, start) > 3, F.concat((F.datediff(e, start) + 1).cast("string"), F.lit(" days long (league or camp?)"))),
            F.when(start > F.date_add(as_of, 550), "more than 18 months out"),
            F.when(text(state) == "", "no state"),
            F.when((text(city) == "") & (text(venue) == ""), "no town or venue"),
            F.when(text(gender).isin("", "unknown"), "gender unknown"),
            F.when(text(name).rlike(r"(?i)\b(learn more|register|view event|details|tbd)\b"), "name looks like page text"),
            F.when(text(date_note) != "", F.concat(F.lit("date corrected by the scraper: "), date_note)),
        ),
        lambda f: f.isNotNull(),
    )


def needs_check(flags: Column, status: Column) -> Column:
    """Whether a row's flags must be looked at: serious ones always, a missing place only where the place was not matched."""
    serious = F.exists(flags, lambda f: f.rlike("date corrected|end before start|days long|more than 18 months|name looks like page text"))
    placeless = F.exists(flags, lambda f: f.isin("no state", "no town or venue"))
    return serious | (~text(status).isin("CONFIRMED", "PLACE DIFFERS", "DATE MOVED") & placeless)


def name_verdict(name: Column) -> Column:
    """Why a crawled name is not an event to keep, or null: junk, heading, not_event, other_sport, no_tournament_word."""
    return let(text(name), lambda n: first_case(n, [(p, fault) for fault, p in vocab.NAME_FAULTS], F.when(~n.rlike(vocab.TOURNAMENT_WORD), "no_tournament_word")))


def in_horizon(start: Column, as_of: Column, back: int = 1, ahead: int = 550) -> Column:
    return start.between(F.date_sub(as_of, back), F.date_add(as_of, ahead))


def grey_rows(rows: DataFrame, checks: DataFrame, scraped_organizers: DataFrame, only_gated: bool = False) -> DataFrame:
    """Rows without a check whose organiser was not scraped."""
    out = rows.join(checks.select("dedupe_key").distinct(), "dedupe_key", "left_anti").join(scraped_organizers.select("organizer").distinct(), "organizer", "left_anti")
    return out.where("gate_passed") if only_gated else out


def page_verifies(event_words: Column, page_words: Column, place_found: Column) -> Column:
    """Whether a page names the event (all its distinctive words, one may miss of three or more) and the place."""
    found = F.size(F.array_intersect(event_words, page_words))
    n = F.size(event_words)
    return (n > 0) & (found >= F.when(n >= 3, n - 1).otherwise(n)) & place_found
