"""Scores: festival size, signals and fit, attendance, schedule quality, weather, statuses of the report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatherline import vocab
from gatherline.functions.patterns import guarded
from gatherline.functions.values import clamp, let, lookup, members, round_even, text

# --- attendance


def roster(sport: Column, gender: Column, grad_min: Column, season: Column) -> Column:
    """Players of a team, by sport, gender and the oldest age group; null for unknown sports."""
    s = F.lower(text(sport))
    oldest = F.when(grad_min != 0, 18 - (grad_min - season - 1))
    table = F.create_map(*[F.lit(x) for pair in vocab.ROSTERS.items() for x in pair])
    return (
        F.when((s == "soccer") & (oldest != 0), F.when(oldest <= 10, 11).when(oldest <= 12, 14).otherwise(16))
        .when((s == "lacrosse") & (oldest != 0) & (oldest <= 10), 11)
        .when((s == "lacrosse") & (gender == "girls"), vocab.LACROSSE_GIRLS_ROSTER)
        .otherwise(F.element_at(table, s))
    )


def attendance(teams: Column, sport: Column, gender: Column, grad_min: Column, season: Column) -> Column:
    """Teams by roster by adults a player; null without teams or for unknown sports."""
    return F.when(teams > 0, F.bround(teams * roster(sport, gender, grad_min, season) * (1 + vocab.ADULTS_PER_PLAYER)).cast("int"))


# --- festivals


def festival_size(attendance: Column, fee: Column, vendors: Column, years: Column, days: Column, words: Column) -> Column:
    """struct<score, confidence>: weighted mean of the signals that exist; null score without any. 0 counts as missing."""
    a, f, v, y, d = (F.when(x != 0, x.cast("double")) for x in (attendance, fee, vendors, years, days))
    signals = [
        (clamp(45 * F.log10(F.greatest(a, F.lit(1.0)) / 300), 0, 100), 5, a),
        (clamp((f - 25) / 575 * 100, 0, 100), 2, f),
        (F.when(v < 15, 40.0).when(v <= 100, 100.0).otherwise(F.greatest(F.lit(0.0), 100 - (v - 100) * 0.45)), 3, v),
        (clamp((a / v - 30) / 170 * 100, 0, 100), 4, a * v),
        (clamp(y / 40 * 100, 0, 100), 1, y),
        (F.when(d == 1, 10.0).when(d == 2, 40.0).when(d <= 4, 55.0).otherwise(30.0), 1, d),
    ]
    total = sum((F.when(known.isNotNull(), part * weight).otherwise(0.0) for part, weight, known in signals), F.lit(0.0))
    weights = sum((F.when(known.isNotNull(), weight).otherwise(0) for _, weight, known in signals), F.lit(0))
    change = F.when(text(words).rlike(vocab.BIG_FESTIVAL), 10).otherwise(0) - F.when(text(words).rlike(vocab.SMALL_FESTIVAL), 12).otherwise(0)
    score = F.when(weights > 0, F.bround(clamp(total / weights + change, 0, 100)).cast("int"))
    return F.struct(score.alias("score"), F.when(weights > 0, round_even(F.least(F.lit(1.0), weights / 13), 2)).otherwise(0.0).alias("confidence"))


def festival_signals(words: Column) -> Column:
    """struct<tags, destination>: the signals found in the text, and a mild score of the place from 20 to 85."""
    tags = members(tag for tag, _, _ in vocab.FESTIVAL_SIGNALS)
    points = F.array(*[F.lit(points) for _, _, points in vocab.FESTIVAL_SIGNALS])
    # Each pattern is tried once: what was hit gives the tags and the score.
    hits = let(F.lower(text(words)), lambda w: F.array(*[w.rlike(guarded(pattern)) for _, pattern, _ in vocab.FESTIVAL_SIGNALS]))
    found = lambda h: F.filter(F.zip_with(h, F.arrays_zip(tags.alias("tag"), points.alias("points")), lambda hit, x: F.when(hit, x)), lambda x: x.isNotNull())
    total = lambda f: F.aggregate(f, F.lit(50), lambda s, x: s + x["points"])
    return let(let(hits, found), lambda f: F.struct(F.transform(f, lambda x: x["tag"]).alias("tags"), clamp(total(f), 20, 85).cast("int").alias("destination")))


def festival_fit(name: Column, description: Column, tags: Column, fee: Column, start: Column, end: Column, deadline: Column, days: Column, size: Column, destination: Column, as_of: Column) -> Column:
    """struct<fit, tags, reasons, excluded>: how well a festival suits a vendor, 0 to 100; private events are excluded.

    Tags are extended first (craft-market, fee-over-400, weekday-only, deadline-passed), then every rule reads them.
    """
    n, both = text(name), F.concat_ws(" ", text(name), text(description))
    span = F.datediff(end, start)
    weekend = F.exists(F.sequence(F.lit(0), F.greatest(F.lit(0), F.least(F.coalesce(span, F.lit(0)), F.lit(6)))), lambda i: F.weekday(F.date_add(start, i)) >= 5)
    extra = F.array(
        F.when(n.rlike(vocab.CRAFT_EVENT) & ~n.rlike(vocab.SEASONAL_EVENT), "craft-market"),
        F.when(fee > 400, "fee-over-400"),
        F.when((span >= 0) & (span <= 6) & ~weekend, "weekday-only"),
        F.when(deadline < as_of, "deadline-passed"),
    )
    tags = F.array_distinct(F.concat(F.coalesce(tags, F.array().cast("array<string>")), F.filter(extra, lambda t: t.isNotNull())))
    has = lambda t: F.arrays_overlap(tags, members(t))
    rules = [(has(some) & ~has(none) if none else has(some), points) for some, none, points in vocab.FIT_TAGS]
    rules += [(n.rlike(vocab.SEASONAL_EVENT), vocab.FIT_SEASONAL), (both.rlike(vocab.YEARLY_EVENT), vocab.FIT_YEARLY), (days >= 2, vocab.FIT_SEVERAL_DAYS)]
    labels = ["/".join(some) for some, _, _ in vocab.FIT_TAGS] + ["seasonal", "yearly", "several days"]
    reasons = F.filter(F.array(*[F.when(hit, f"{label} {points:+d}") for label, (hit, points) in zip(labels, rules, strict=True)]), lambda r: r.isNotNull())
    score = sum((F.when(hit, points).otherwise(0) for hit, points in rules), F.lit(vocab.FIT_BASE))
    score = score + F.coalesce(((size - 50) * 0.3).cast("int"), F.lit(0)) + F.coalesce(((destination - 50) * 0.2).cast("int"), F.lit(0))
    private = n.rlike(vocab.PRIVATE_EVENT)
    return F.struct(F.when(~private, clamp(score, 0, 100).cast("int")).alias("fit"), tags.alias("tags"), F.when(~private, reasons).alias("reasons"), F.when(private, "not a public fair (private/corporate/race/class)").alias("excluded"))


# --- schedules


def schedule_days(games: DataFrame, by: list[str]) -> DataFrame:
    """Per group, day and (day, site): games, fields used, used from 12:00 and from 14:30, first and last start, end and hours.

    games: ``by`` columns, date, minute, site, field. Rows for whole days have a null site. A game lasts the median gap
    (20 to 180 minutes) between starts on one field, cut to whole minutes and kept in 40 to 90; 60 without gaps.
    """
    length = game_length(games, by)
    per = games.withColumn("_sites", F.explode(F.array(F.lit(None).cast("string"), F.col("site").cast("string"))))
    fields = per.groupBy(*by, "date", "_sites", "field").agg(F.count("*").alias("n"), F.min("minute").alias("low"), F.max("minute").alias("high"))
    days = fields.groupBy(*by, "date", F.col("_sites").alias("site")).agg(
        F.sum("n").alias("games"),
        F.count("*").alias("fields_active"),
        F.count_if(F.col("high") >= 720).alias("fields_active_pm"),
        F.count_if(F.col("high") >= 870).alias("fields_active_late"),
        F.min("low").alias("first_minute"),
        F.max("high").alias("last_minute"),
    )
    out = days.join(length, by)
    hours = round_even((F.col("last_minute") + F.col("game_length") - F.col("first_minute")) / 60, 1)
    return out.withColumns({"first_game": clock("first_minute"), "last_game_start": clock("last_minute"), "est_end": clock(F.col("last_minute") + F.col("game_length")), "hours": hours})


def clock(minute: Column | str) -> Column:
    """Minutes as HH:MM; hours may pass 24."""
    m = F.col(minute) if isinstance(minute, str) else minute
    return F.format_string("%02d:%02d", F.floor(m / 60).cast("int"), F.pmod(m, F.lit(60)).cast("int"))


def game_length(games: DataFrame, by: list[str]) -> DataFrame:
    """Per group: game_length in minutes, from the gaps between successive starts on one field and day.

    Starts within a day are minutes, at most 1,440 of them, so a field's day is one short array.
    """
    starts = games.groupBy(*by, "date", "field", "minute").agg(F.count("*").alias("n"))
    day = starts.groupBy(*by, "date", "field").agg(F.array_sort(F.collect_list("minute")).alias("m"))
    gaps = day.select(*by, F.explode_outer(F.filter(F.zip_with(F.slice("m", 2, F.greatest(F.size("m") - 1, F.lit(0))), F.slice("m", 1, F.greatest(F.size("m") - 1, F.lit(0))), lambda a, b: a - b), lambda g: g.between(20, 180))).alias("gap"))
    counted = gaps.groupBy(*by, "gap").agg(F.count("gap").alias("n"))  # at most 161 gaps a group
    middle = F.percentile("gap", F.lit(0.5), F.col("n"))
    return counted.groupBy(*by).agg(F.when(middle.isNull(), 60).otherwise(F.greatest(F.lit(40), F.least(F.lit(90), middle.cast("int")))).alias("game_length"))


def schedule_quality(days: DataFrame, by: list[str]) -> DataFrame:
    """Per group: the 0-100 quality of its run of days and the figures behind it.

    days: ``by``, date, hours, fields_active, fields_active_pm, fields_active_late, last_minute, game_length. Length of
    day earns half, the last day the rest: when it ends, and the share of the first day's fields still busy late.
    """
    last = F.struct("hours", "fields_active", "fields_active_pm", "fields_active_late", "last_minute", "game_length")
    g = days.groupBy(*by).agg(
        F.count("*").alias("day_count"),
        F.max("fields_active").alias("_peak"),
        F.min_by(F.struct("hours", "fields_active"), "date").alias("_one"),
        F.max_by(last, "date").alias("_last"),
        F.min("hours").alias("_least"),
        F.collect_list(F.struct("date", "hours", "fields_active")).alias("_days"),
    )
    total = F.aggregate(F.array_sort("_days"), F.lit(0.0), lambda s, x: s + F.least(x["hours"], F.lit(9.0)) * F.least(F.lit(1.0), x["fields_active"] / F.col("_peak")))
    field_hours = F.aggregate(F.array_sort("_days"), F.lit(0.0), lambda s, x: s + x["fields_active"] * x["hours"])
    share = lambda c: round_even(F.least(F.lit(1.0), F.col(f"_last.{c}") / F.col("_one.fields_active")), 2)
    late = share("fields_active_late")
    end = F.col("_last.last_minute") + F.col("_last.game_length")
    end_h = F.floor(end / 60) + F.pmod(end, F.lit(60)) / 60
    credit = clamp((end_h - 12) / 4.5, 0, 1)
    many = F.when(end_h >= 13, 50 * (0.3 * credit + 0.7 * clamp(late / 0.5, 0, 1))).otherwise(12.5 * credit)
    many = F.when(late < 0.15, F.least(many, F.lit(12.0))).otherwise(many)
    one = F.when(F.col("_one.hours") >= 8, 50.0).otherwise(25.0)
    quality = F.least(F.lit(100.0), 50 * F.least(F.lit(1.0), total / (9 * F.col("day_count"))) + F.when(F.col("day_count") > 1, many).otherwise(one))
    return g.select(
        *by,
        "day_count",
        F.col("_one.hours").alias("day1_hours"),
        F.col("_last.hours").alias("last_day_hours"),
        clock(end).alias("last_day_end"),
        share("fields_active_pm").alias("last_day_pm_field_share"),
        late.alias("last_day_late_field_share"),
        (F.col("_least") >= 8).alias("full_day_all_days"),
        round_even(field_hours, 1).alias("field_hours"),
        F.bround(quality).cast("int").alias("schedule_quality"),
    )


# --- weather


def weather_days(weather: DataFrame, events: DataFrame, by: list[str]) -> DataFrame:
    """Per event: what the weather was on its days. weather: place, day and measures; events: ``by``, place, start, end.

    Both sides are shuffled: the planner does not know how many days an event has, and would broadcast them all.
    """
    day = F.explode(F.sequence("start", F.coalesce("end", "start"))).alias("day")
    joined = events.select(*by, "place", day).join(weather.hint("merge"), ["place", "day"])
    wet = F.coalesce("rain_mm", F.lit(0.0))
    return joined.groupBy(*by).agg(
        F.count("*").alias("days"),
        F.count_if(wet > vocab.RAIN_MM).alias("rain_days"),
        F.sum(wet).alias("rain_total_mm"),
        F.max("high_f").alias("high_f"),
        F.avg("high_f").alias("avg_high_f"),
        F.avg(F.col("sun_seconds") / 3600).alias("sun_hours_avg"),
        F.when(F.count_if(wet > vocab.RAIN_MM) > 0, "rain").when(F.avg(F.col("sun_seconds") / 3600) >= 7, "sunny").otherwise("dry").alias("summary"),
    )


def climatology(weather: DataFrame, events: DataFrame, by: list[str], first_year: int, last_year: int, window: int = 7) -> DataFrame:
    """Per event: base rates of the same time of year, the window's days either side, over the years given.

    The day-by-year table is made once for each place, day of the year and length that events have, and joined on place
    and day; events take its sums. So it grows with the dates there are, work with the events, and nothing with pairs of
    events. No side is broadcast: the planner does not know what the days and years make of a row. Feb 29 has no window
    in years without one.
    """
    span = F.datediff(F.coalesce("end", "start"), "start") + 1
    dated = events.select(*by, "place", F.date_format("start", "MM-dd").alias("_date"), span.alias("span"))
    spell = ["place", "_date", "span"]
    years = dated.select(*spell).distinct().withColumn("year", F.explode(F.sequence(F.lit(first_year), F.lit(last_year))))
    at = F.try_to_date(F.concat_ws("-", F.col("year").cast("string"), "_date"), "yyyy-MM-dd")
    days = years.withColumn("_at", at).where("_at IS NOT NULL").withColumn("day", F.explode(F.sequence(F.date_sub("_at", window), F.date_add("_at", F.col("span") + window - 1))))
    measures = {"_high": F.col("high_f"), "_sun": F.col("sun_seconds") / 3600, "_rad": F.col("radiation_mj")}
    told = days.join(weather.hint("merge"), ["place", "day"]).groupBy(*spell).agg(
        F.count("*").alias("sample_days"),
        F.count_if(F.coalesce("rain_mm", F.lit(0.0)) > vocab.RAIN_MM).alias("_wet"),
        *[f(x).alias(c + n) for c, x in measures.items() for f, n in ((F.sum, ""), (F.count, "_n"))],
    )
    sums = dated.join(told.hint("merge"), spell).groupBy(*by, "span").agg(
        F.sum("sample_days").alias("sample_days"),
        F.sum("_wet").alias("_wet"),
        *[(F.sum(c) / F.nullif(F.sum(c + "_n"), F.lit(0))).alias(c) for c in measures],
    )
    p = F.col("_wet") / F.col("sample_days")
    uv = round_even(F.col("_rad") * vocab.UV_PER_MJ, 1)
    pleasant = 0.45 * clamp((F.col("_high") - 45) / 40, 0, 1) + 0.30 * clamp((F.col("_sun") - 3) / 7, 0, 1) + 0.25 * clamp((F.coalesce(uv, F.lit(0.0)) - 2) / 7, 0, 1)
    return sums.select(
        *by,
        "sample_days",
        round_even(p, 2).alias("p_rain_day"),
        round_even(1 - F.pow(1 - p, F.col("span")), 2).alias("p_rain_event"),
        F.bround("_high").alias("expected_high_f"),
        round_even(F.col("_sun"), 1).alias("expected_sun_hours"),
        uv.alias("uv_index_est"),
        F.bround(100 * pleasant * (1 - 0.5 * p)).cast("int").alias("sun_score"),
        (p >= 0.45).alias("wet_season"),
    )


# --- statuses


def place_check(state_a: Column, state_b: Column, town_a: Column, town_b: Column, venue_anchor: Column, venues_agree: Column) -> Column:
    """agrees, state, town, venue (what differs) or null: unknown."""
    return (
        F.when((text(state_a) != "") & (text(state_b) != "") & (state_a != state_b), "state")
        .when(venue_anchor | ((text(town_a) != "") & (town_a == town_b)), "agrees")
        .when(venues_agree, "agrees")
        .when((text(town_a) != "") & (text(town_b) != ""), "town")
        .when(~venues_agree, "venue")
    )


def match_status(decision: Column, kind: Column, days_off: Column, place: Column, week_late: Column) -> Column:
    """Status of one stored row against one organiser's event. week_late: the row's alternate date agrees."""
    near = F.abs(days_off) <= 2
    return (
        F.when(F.coalesce(decision != "confirmed", F.lit(True)), "REVIEW")
        .when(near & (place == "agrees"), "CONFIRMED")
        .when(near & place.isNotNull(), "PLACE DIFFERS")
        .when(near, "DATE CONFIRMED")
        .when(kind == "placeholder", F.when(F.coalesce(week_late, F.lit(False)), "DATE MOVED (week late)").otherwise("DATE MOVED"))
        .otherwise("DATE CONFLICT")
    )


def badge(status: Column) -> Column:
    """What the dashboard shows for a status."""
    return lookup(
        F.regexp_replace(status, r" \(.*\)$", ""),
        {
            "CONFIRMED": "🟢 Confirmed · organizer website",
            "DATE CONFIRMED": "🟢 Date confirmed · place not checked",
            "PLACE DIFFERS": "🟠 Place corrected",
            "DATE MOVED": "🔴 Date corrected",
            "DATE CONFLICT": "🔴 Date corrected",
            "REVIEW": "🟡 Possible match, check",
            "NOT ON ORGANIZER SITE": "⚪ Not on organizer site",
            "NEW SITE": "🔵 New site · organizer website",
            "NEW": "🔵 New · organizer website",
        },
    )


def status_code(status: Column) -> Column:
    """Code under which a status is stored; a new site is new."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.regexp_replace(status, r" \(.*\)$", "")), " ", "_"), "^new_site$", "new")


def best_status(checks: DataFrame, key: str, status: str = "status", order: str = "ord") -> DataFrame:
    """One check per key: the most telling status, the first of equals. Codes outside the order come last."""
    rank = F.array_position(members(vocab.STATUS_ORDER), F.col(status))
    rank = F.when(rank > 0, rank).otherwise(len(vocab.STATUS_ORDER) + 1)
    rest = [c for c in checks.columns if c != key]
    best = checks.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(rank, F.col(order))).alias("_best"))
    return best.select(key, *[F.col(f"_best.{c}").alias(c) for c in rest])


def web_status(own_page: Column, has_date: Column, current: Column, days_off: Column, is_league: Column) -> Column:
    """Status of a row against a page found on the web: site_old, site_no_date, confirmed, date_moved or date_unsure."""
    return (
        F.when(~current, "site_old")
        .when(~has_date, "site_no_date")
        .when(F.abs(days_off) <= 2, "confirmed")
        .when((F.abs(days_off) <= 21) & own_page & ~is_league, "date_moved")
        .otherwise("date_unsure")
    )


def ambiguous_dates(found: DataFrame) -> DataFrame:
    """Confirmed and moved rows whose page gives one date to events of several dates become date_unsure."""
    several = found.groupBy("url", "found").agg((F.min("start") < F.max("start")).alias("_several"))
    joined = found.join(several, ["url", "found"], "left")
    unsure = F.col("_several") & F.col("status").isin("confirmed", "date_moved")
    return joined.withColumn("status", F.when(unsure, "date_unsure").otherwise(F.col("status"))).drop("_several")


def qualifies_vendor(max_teams: Column, least: int = 20) -> Column:
    return F.coalesce(max_teams >= least, F.lit(False))
