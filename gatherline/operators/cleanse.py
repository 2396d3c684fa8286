"""Validation, exact dedupe, enrichment and normalisation of scraped rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatherline import vocab
from gatherline.functions.dates import grad_years, team_int
from gatherline.functions.names import core_fingerprint, core_name, core_organizer, event_type
from gatherline.functions.places import region, states_of, towns_listed
from gatherline.functions.values import round_even, text, truthy
from gatherline.operators.scores import attendance


def validate(events: DataFrame, as_of: Column | str, horizon: int = 540) -> DataFrame:
    """``events`` with accepted (boolean), flags (array<string>) and a mended end_date.

    Rows without a name of three characters, a sport or a start are rejected with that one flag. Others are kept and
    flagged: stale_date:<day> (over 30 days past), far_future, end_before_start (the end becomes the start), long_span
    (over 14 days), no_state, gender_unknown.
    """
    as_of = F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of
    reject = F.when(F.length(text("name")) < 3, "no_name").when(text("sport") == "", "no_sport").when(F.col("start_date").isNull(), "no_date")
    backwards = F.coalesce(F.col("end_date") < F.col("start_date"), F.lit(False))
    end = F.when(backwards, F.col("start_date")).otherwise(F.col("end_date"))
    flags = F.array(
        F.when(F.datediff(as_of, "start_date") > 30, F.concat(F.lit("stale_date:"), F.date_format("start_date", "yyyy-MM-dd"))),
        F.when(F.col("start_date") > F.date_add(as_of, horizon), "far_future"),
        F.when(backwards, "end_before_start"),
        F.when(F.datediff(end, "start_date") > 14, "long_span"),
        F.when(text("state") == "", "no_state"),
        F.when(F.col("gender") == "unknown", "gender_unknown"),
    )
    judged = events.withColumn("_reject", reject)
    return judged.select(
        *[(F.when(F.col("_reject").isNull(), end).otherwise(F.col("end_date")) if c == "end_date" else F.col(c)).alias(c) for c in events.columns if c not in ("accepted", "flags")],
        F.col("_reject").isNull().alias("accepted"),
        F.when(F.col("_reject").isNotNull(), F.array("_reject")).otherwise(F.filter(flags, lambda f: f.isNotNull())).alias("flags"),
    )


def validation_counts(validated: DataFrame) -> DataFrame:
    """flag and n: how many rows carry each flag (stale dates together), and how many were accepted."""
    one = validated.select(F.explode(F.concat(F.transform("flags", lambda f: F.concat(F.when(F.col("accepted"), "flag_").otherwise("reject_"), F.split_part(f, F.lit(":"), F.lit(1)))), F.when(F.col("accepted"), F.array(F.lit("accepted"))).otherwise(F.array().cast("array<string>")))).alias("flag"))
    return one.groupBy("flag").agg(F.count("*").alias("n"))


def keep_best(rows: DataFrame, key: list[str], filled: list[str] | None = None, order: str = "ord") -> DataFrame:
    """One row a key: the one with most filled fields, the first seen of equals.

    Only the key's best position is shuffled through an aggregate; where that key holds a large share of all rows, its
    rows are reduced in each task first.
    """
    kinds = dict(rows.dtypes)
    score = sum((truthy(F.col(c), kinds[c]).isNotNull().cast("int") for c in (filled or vocab.FILLED_FIELDS)), F.lit(0))
    rest = [c for c in rows.columns if c not in key]
    best = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(score, -F.col(order))).alias("_best"))
    return best.select(*key, *[F.col(f"_best.{c}").alias(c) for c in rest]).select(*rows.columns)


def enrich(events: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Fills city, state and region by the venue where the state is missing.

    gazetteer: venue (lower-case), city, state, ord. The exact name counts first, then the first entry, in order, whose
    name holds or is held by the venue's. Distinct venues are matched, not rows; a name that another holds meets it on
    its first three letters, so that neither side need be small.
    """
    bare = F.regexp_replace(F.regexp_replace(text("venue"), r"(?i)^(droplight|title|display|image)\s+", ""), "^[ ,–-]+|[ ,–-]+$", "")
    cleaned = events.withColumn("venue", F.when(bare != "", bare))
    key = F.regexp_replace(F.regexp_replace(F.lower("venue"), r"\s+", " "), r"^[ .,-]+|[ .,-]+$", "")
    wanted = cleaned.where((text("state") == "") & F.col("venue").isNotNull()).select(key.alias("_key")).where("_key <> ''").distinct()
    names = gazetteer.select(F.col("venue").alias("_name"), F.col("city").alias("_city"), F.col("state").alias("_state"), F.col("ord").alias("_ord")).where("_name <> ''")
    start = lambda c: F.substring(c, 1, 3).alias("_gram")
    parts = lambda c: F.explode(F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.array(*[F.substring(c, i, F.lit(n)) for n in (1, 2, 3)]))))).alias("_gram")
    holds = wanted.select("*", parts(F.col("_key"))).join(names.select("*", start(F.col("_name"))), "_gram").where(F.col("_key").contains(F.col("_name")))
    held = wanted.select("*", start(F.col("_key"))).join(names.select("*", parts(F.col("_name"))), "_gram").where(F.col("_name").contains(F.col("_key")))
    near = holds.unionByName(held)
    place = F.min_by(F.struct("_city", "_state"), F.struct((F.col("_key") != F.col("_name")).cast("int"), "_ord"))
    found = near.groupBy("_key").agg(place.alias("_place"))
    joined = cleaned.withColumn("_key", F.when(text("state") == "", key)).join(found, "_key", "left")
    city = F.coalesce(F.nullif("city", F.lit("")), F.col("_place._city"))
    state = F.coalesce(F.nullif("state", F.lit("")), F.col("_place._state"))
    return joined.withColumns({"city": F.when(F.col("_place").isNotNull(), city).otherwise(F.col("city")), "state": state, "region": region(state)}).drop("_key", "_place")


def with_types(events: DataFrame) -> DataFrame:
    return events.withColumn("event_type", event_type(F.col("name"), F.col("event_type")))


def normalize(rows: DataFrame, season: Column | None = None) -> DataFrame:
    """Candidate rows in their stored form.

    Adds dedupe_key, days, is_league (over three days), split_venue, venue_count, organizer_canon, name_core,
    event_fingerprint, calendar_week, class years and expected attendance; city_states are cleaned, and state and city
    are filled from them. Missing columns of the stored form must be there as nulls.
    """
    towns = towns_listed(F.col("city_states"))
    listed = F.nullif(F.array_join(states_of(towns), ", "), F.lit(""))
    days = F.datediff("end_date", "start_date") + 1
    floor = F.when(F.month("start_date") >= 8, F.year("start_date") + 1).otherwise(F.year("start_date"))
    named = F.regexp_replace(text("name"), r"^\s*20\d\d(?:\s*[-/–]\s*(?:20)?\d\d)?\b\s*|\s*\b20\d\d(?:\s*[-/–]\s*(?:20)?\d\d)?\s*$", " ")
    divided = F.when(text("divisions") != "", F.concat_ws(" ", F.nullif("divisions", F.lit("")), F.nullif("age_groups", F.lit("")))).otherwise(F.concat_ws(" ", F.nullif("age_groups", F.lit("")), named))
    season = season if season is not None else F.year("start_date")
    ages = grad_years(divided, season, floor)
    told = grad_years(F.concat_ws(" ", F.nullif("divisions", F.lit("")), F.nullif("age_groups", F.lit("")), "name"), season)["gender"]
    out = rows.withColumns({"city_states": towns, "team_count": team_int(F.col("team_count")), "_ages": ages})
    out = out.withColumns(
        {
            "dedupe_key": F.concat_ws(":", "source", "source_event_id"),
            "state": F.coalesce(F.nullif("state", F.lit("")), listed),
            "city": F.coalesce(F.nullif("city", F.lit("")), F.split_part(F.try_element_at(F.col("city_states"), F.lit(1)), F.lit(", "), F.lit(1))),
            "venue_count": F.coalesce(F.nullif("venue_count", F.lit(0)), F.nullif(F.size("city_states"), F.lit(0))),
            "split_venue": F.coalesce("split_venue", F.lit(False)) | (F.size("city_states") > 1),
            "days": days,
            "is_league": F.coalesce(days > 3, F.lit(False)),
            "gender": F.coalesce(F.nullif("gender", F.lit("")), told),
            "grad_year_min": F.col("_ages.grad_min"),
            "grad_year_max": F.col("_ages.grad_max"),
            "age_groups": F.coalesce(F.nullif("age_groups", F.lit("")), F.col("_ages.label")),
            "calendar_week": F.weekofyear("start_date"),
            "organizer_canon": core_organizer(F.col("organizer_name")),
            "name_core": core_name(F.col("name")),
        }
    )
    fits = attendance(F.col("team_count"), F.col("sport"), F.col("gender"), F.col("grad_year_min"), season)
    return out.withColumns(
        {
            "event_fingerprint": core_fingerprint(F.col("name"), F.col("sport"), F.split_part(text("state"), F.lit(","), F.lit(1))),
            "expected_attendance": F.when(F.col("sport") != "festival", F.coalesce(fits, F.col("expected_attendance"))).otherwise(F.col("expected_attendance")),
        }
    ).drop("_ages")


def ratio(a: Column, b: Column, digits: int = 1) -> Column:
    """a / b rounded, null where either is missing or 0."""
    return F.when((a != 0) & (b != 0), round_even(a / b, digits))


def site_rows(events: DataFrame, split: Column) -> DataFrame:
    """One row per venue of an event: ``split`` gives its venues; several get '– Site N' after the name."""
    out = events.withColumn("_sites", split)
    out = out.select("*", F.posexplode_outer("_sites").alias("_n", "_site"))
    many = F.size("_sites") > 1
    return out.withColumns({"name": F.when(many, F.concat("name", F.lit(" – Site "), (F.col("_n") + 1).cast("string"))).otherwise(F.col("name")), "venue": F.coalesce("_site", "venue")}).drop("_sites", "_n", "_site")


def split_venues(venue: Column) -> Column:
    """The venues that one field names: 'A College & B' has two, 'A Sports & Events' and lists of states one."""
    p = F.split(text(venue), r"\s+(?:&|and|/|\+)\s+")
    facility = r"(?i)\b(park|complex|fields?|center|centre|stadium|university|college|academy|school|club|arena|farm|grounds)\b"
    weak = F.exists(p, lambda x: x.rlike(r"(?i)^(events?|sports complex|recreation|sons?|company|co\.?|[A-Z]{2})$") | (F.length(x) < 2))
    return F.when((F.size(p) >= 2) & ~weak & F.element_at(p, 1).rlike(facility), p).otherwise(F.array(venue))
