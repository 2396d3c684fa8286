"""Record linkage across sources: event-site verdicts, leader clustering, merging, and reconciliation of site sets."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache, lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatherline import vocab
from gatherline.functions.dates import overlaps
from gatherline.functions.names import blocking_key, event_group_key, identity_of, is_compound_venue, levels_of, link_organizer, link_tokens, link_venue
from gatherline.functions.values import jaccard, overlap, subset, text, truthy, word_set
from gatherline.operators.settle import ROUNDS, settled, settled_blocks
from gatherline.plans.scratch import Scratch

#: What decides whether two rows are one event-site; rows equal in all of it fall into one class before any pairing.
FIELDS = ["sport", "organizer", "start_date", "end_date", "state", "gender", "venue", "city", "name", "event_type"]
#: What the verdict reads of a prepared row, and all that pairs of rows need carry.
READ = ["ord", "start_date", "end_date", "state", "gender", "event_type", "_sport", "_org", "_venue", "_words", "_compound", "_city", "_tokens", "_identity", "_levels"]
#: Reasons that mean yes.
REASONS = ["venue_match", "city_match_venue_unknown", "name_match_no_location"]
#: Rows of a block whose pairs are made in one unit, candidates that are looked at at once, verdicts on places or names a task remembers.
UNIT, STRIDE, KNOWN = 20_000, 2_000_000, 1 << 20


def prepare(rows: DataFrame) -> DataFrame:
    """``rows`` with what the verdict reads, worked out once a row: words of venue and name first, what follows from them after."""
    read = rows.withColumns(
        {
            "_sport": F.coalesce(F.when(F.col("sport") != "", F.col("sport")), F.lit("lacrosse")),
            "_org": link_organizer(F.col("organizer")),
            "_venue": link_venue(F.col("venue")),
            "_compound": is_compound_venue(F.col("venue")),
            "_city": F.trim(F.lower(text("city"))),
            "_tokens": link_tokens(F.col("name")),
        }
    )
    return read.withColumns({"_words": word_set(F.col("_venue")), "_identity": identity_of(F.col("_tokens")), "_levels": levels_of(F.col("_tokens"))})


def verdict(p: str, q: str) -> Column:
    """Reason why two prepared rows (struct columns) are, or are not, the same event-site; first rule that fits.

    venue_match, city_match_venue_unknown and name_match_no_location mean yes. Place decides, then names may split.
    """
    a = lambda f: F.col(f"{p}.{f}")
    b = lambda f: F.col(f"{q}.{f}")
    va, vb = a("_words"), b("_words")
    shared = overlap(va, vb)
    close = (a("_venue") == b("_venue")) | subset(va, vb) | subset(vb, va) | (shared / (F.size(va) + F.size(vb) - shared) >= 0.6)
    venue = F.when(a("_compound") != b("_compound"), False).when((a("_venue") == "") | (b("_venue") == ""), F.lit(None).cast("boolean")).otherwise(close)
    city = F.when((a("_city") != "") & (b("_city") != ""), a("_city").contains(b("_city")) | b("_city").contains(a("_city")))
    sexes = F.coalesce((a("gender") != "") & (b("gender") != "") & ~a("gender").isin("unknown", "coed") & ~b("gender").isin("unknown", "coed") & (a("gender") != b("gender")), F.lit(False))
    levels = ((F.size(a("_levels")) > 0) | (F.size(b("_levels")) > 0)) & (overlap(a("_levels"), b("_levels")) == 0)
    types = F.coalesce((a("event_type") != "") & (b("event_type") != "") & (a("event_type") != b("event_type")), F.lit(False))
    both = (F.size(a("_identity")) > 0) & (F.size(b("_identity")) > 0)
    common = overlap(a("_identity"), b("_identity")) > 0

    def judged(base: str, rest: Column) -> Column:
        return F.when(levels, f"{base}_but_different_level").when(types, f"{base}_but_different_event_type").when(both & ~common, f"{base}_but_different_event").otherwise(rest)

    named = F.when((both & common) | (jaccard(a("_tokens"), b("_tokens")) >= 0.85), "name_match_no_location").otherwise("no_location_no_name_match")
    return (
        F.when(a("_sport") != b("_sport"), "different_sport")
        .when(a("_org") != b("_org"), "different_organizer")
        .when(~overlaps(a("start_date"), a("end_date"), b("start_date"), b("end_date")), "dates_disjoint")
        .when((text(a("state")) != "") & (text(b("state")) != "") & (F.upper(a("state")) != F.upper(b("state"))), "different_state")
        .when(sexes, "different_gender")
        .when(venue, judged("venue_match", F.lit("venue_match")))
        .when(~venue, "multi_site_distinct_venue")
        .when(city, judged("city_match_venue_unknown", F.lit("city_match_venue_unknown")))
        .when(~city, "different_city")
        .otherwise(judged("name_match_no_location", named))
    )


def is_match(reason: Column) -> Column:
    return reason.isin(REASONS)


def _block(across_months: bool) -> Column:
    return F.lit("") if across_months else F.date_format("start_date", "yyyy-MM")


def matching_pairs(classes: DataFrame, across_months: bool = False) -> DataFrame:
    """(a, b, reason) of all pairs of prepared classes (column ord, distinct) that are one event-site, a before b.

    Rows meet on sport, organiser and start within the month block (or, across_months, over its border too). What the
    verdict reads of a row goes into a task as a few numbers and short texts; there a row meets the later starts of its own
    days only, places and names are compared once for each two that differ, and pairs are given out in strides, so that
    neither a block's pairs nor its candidates are held at once. A block of more than UNIT rows is cut into units of one
    day's rows and those whose days hold it, and where either are too many, into shards of both that meet each with each.
    """
    scratch = Scratch(classes.sparkSession, "pairs")
    on = ["block", "sp", "org"]
    rows = scratch.table(_alike(classes, across_months), "rows")
    sizes = scratch.table(rows.groupBy(*on).agg(F.count("*").alias("_n"), F.max("start").alias("_last")), "sizes")
    sized = rows.join(sizes, on)
    one = F.lit(0)
    whole = sized.where(F.col("_n") <= UNIT).select(*rows.columns, one.alias("day"), one.alias("xs"), one.alias("ys"), F.lit(True).alias("x"), F.lit(True).alias("y"))
    large = sized.where(F.col("_n") > UNIT)
    until = F.least(F.col("end") + 1, F.col("_last"))
    visits = large.where(until >= F.col("start")).withColumn("day", F.explode(F.sequence("start", until)))
    here = large.withColumn("day", F.col("start"))
    held = lambda side, n: side.groupBy(*on, "day").agg(F.count("*").alias(n))
    most = F.greatest("_nx", "_ny")
    days = scratch.table(held(visits, "_nx").join(held(here, "_ny"), [*on, "day"]).withColumn("_k", F.ceil(most / UNIT).cast("int")), "days")
    shard, every = F.pmod(F.xxhash64("ord"), F.col("_k")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("_k") - 1))
    tile = lambda side, xs, ys, is_x: side.join(days, [*on, "day"]).select(*rows.columns, "day", xs.alias("xs"), ys.alias("ys"), F.lit(is_x).alias("x"), F.lit(not is_x).alias("y"))
    units = whole.unionByName(tile(visits, shard, every, True)).unionByName(tile(here, every, shard, False))
    total = (sizes.where(F.col("_n") <= UNIT).agg(F.sum("_n")).first()[0] or 0) + (days.agg(F.sum(F.col("_k") * (F.col("_nx") + F.col("_ny")))).first()[0] or 0)
    tasks = -(-total // UNIT) + 3 * classes.sparkSession.sparkContext.defaultParallelism
    pairs = units.repartition(int(tasks), *on, "day", "xs", "ys").mapInPandas(_unit_pairs, "a long, b long, code int")
    return pairs.select("a", "b", F.element_at(F.array(*map(F.lit, REASONS)), F.col("code")).alias("reason"))


def _follow(rows: pd.DataFrame) -> pd.DataFrame:
    """(ord, leader) of the rows that are b of a pair, by the plain pass; a row that is only a leads if it is chief."""
    leader: dict[int, int] = {}
    rows = rows.sort_values(["b", "a"])
    for a, b, chief in zip(rows["a"].tolist(), rows["b"].tolist(), rows["chief"].tolist(), strict=True):
        if leader.setdefault(b, b) == b and (chief or leader.get(a) == a):
            leader[b] = a
    return pd.DataFrame({"ord": list(leader.keys()), "leader": list(leader.values())}, dtype="int64")


def leaders(nodes: DataFrame, pairs: DataFrame, scratch: Scratch) -> DataFrame:
    """(ord, leader): greedy leader clustering in arrival order.

    A row joins the first leader before it that it matches, else it leads. Components of open rows are settled whole in
    tasks (``settle``); followers of a row that is known to lead do not hang together through it. Components too large for
    a task are worn down in rounds: a row whose earliest remaining match leads follows it; matches that follow others
    are struck out; a row without matches left leads. pairs: a < b, both in ``nodes`` (column ord, long).
    """
    edges = scratch.table(pairs.select(F.col("a").cast("long"), F.col("b").cast("long")).distinct(), "pairs")
    blocked = edges.select(F.col("b").alias("ord")).distinct()
    done = scratch.table(nodes.select(F.col("ord").cast("long").alias("ord")).join(blocked, "ord", "left_anti").withColumn("leader", F.col("ord")), "led")
    mark = done.select(F.col("ord").alias("a"), F.lit(True).alias("_led"))
    left = scratch.table(edges.join(mark, "a", "left").select("a", "b", F.coalesce("_led", F.lit(False)).alias("chief")), "open")
    turn = 0
    while not left.isEmpty():
        whole, left = settled(left, F.col("a"), F.col("b"), _follow, "ord long, leader long", scratch, f"turn-{turn}", ~F.col("chief"))
        done = done.unionByName(whole)
        for _ in range(ROUNDS):
            if left.isEmpty():
                break
            turn += 1
            front = left.groupBy("b").agg(F.min(F.struct("a", "chief")).alias("f"))
            follow = scratch.table(front.where("f.chief").select(F.col("b").alias("ord"), F.col("f.a").alias("leader")), f"follow-{turn}")
            waiting = left.join(follow.select(F.col("ord").alias("b")), "b", "left_anti")
            rest = scratch.table(waiting.join(follow.select(F.col("ord").alias("a")), "a", "left_anti"), f"rest-{turn}")
            freed = waiting.select("b").distinct().join(rest.select("b").distinct(), "b", "left_anti").select(F.col("b").alias("ord"), F.col("b").alias("leader"))
            freed = scratch.table(freed, f"freed-{turn}")
            done = done.unionByName(follow).unionByName(freed)
            mark = freed.select(F.col("ord").alias("a"), F.lit(True).alias("_led"))
            left = scratch.table(rest.join(mark, "a", "left").select("a", "b", (F.col("chief") | F.col("_led").isNotNull()).alias("chief")), f"open-{turn}")
            scratch.drop(f"rest-{turn}")
        done = scratch.table(done, f"led-{turn}") if turn % (4 * ROUNDS) == 0 and turn else done  # the plan stays short
    return done


def _alike(classes: DataFrame, across_months: bool) -> DataFrame:
    """What the verdict reads of prepared classes with a start, as few plain columns: texts of words are joined by blanks."""
    day = lambda c: F.datediff(c, F.lit("1970-01-01").cast("date"))
    joined = lambda *c: F.concat_ws("|", *[F.array_join(x, " ") for x in c])
    return classes.where("start_date IS NOT NULL").select(
        _block(across_months).alias("block"), F.col("_sport").alias("sp"), text("_org").alias("org"), F.col("ord").cast("long").alias("ord"),
        day("start_date").alias("start"), day(F.coalesce("end_date", "start_date")).alias("end"), F.upper(text("state")).alias("state"),
        F.when(text("gender").isin("unknown", "coed"), "").otherwise(text("gender")).alias("sex"), text("event_type").alias("kind"),
        F.col("_venue").alias("venue"), F.col("_compound").alias("compound"), F.col("_city").alias("city"), joined("_tokens", "_identity", "_levels").alias("name"),
    )


@cache
def _sets(name: str) -> list[frozenset]:
    return [frozenset(x.split()) for x in name.split("|")]


def _places(venue: str, compound: bool, city: str, venue2: str, compound2: bool, city2: str) -> bool | None:
    """Whether two places are one, as in verdict(); None where neither venue nor city tells."""
    if compound != compound2:
        return False
    if venue and venue2:
        a, b = set(venue.split()), set(venue2.split())
        return venue == venue2 or a <= b or b <= a or len(a & b) / len(a | b) >= 0.6
    return (city in city2 or city2 in city) if city and city2 else None


def _names(name: str, name2: str) -> tuple[bool, bool]:
    """Whether two names do not part events of one place, and whether they make one event of rows without places, as in verdict()."""
    (tokens, identity, levels), (tokens2, identity2, levels2) = _sets(name), _sets(name2)
    clash = bool(levels or levels2) and not levels & levels2 or bool(identity and identity2) and not identity & identity2
    alike = bool(tokens and tokens2) and len(tokens & tokens2) / len(tokens | tokens2) >= 0.85
    return not clash, not clash and (bool(identity & identity2) or alike)


def _unit_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(a, b, code) of the pairs of many whole units of _alike() rows: those of role x with the later ones of role y; code is the place in REASONS, from 1."""
    rows = [batch for batch in batches if len(batch)]
    if not rows:
        return
    rows = pd.concat(rows, ignore_index=True)
    rows["unit"] = rows.groupby(["block", "sp", "org", "day", "xs", "ys"], sort=False).ngroup()
    rows = rows.sort_values(["unit", "start", "ord", "x"])  # a row that stands once for each role is no later than itself
    unit, start, end, ord_ = (rows[c].to_numpy(dtype="int64") for c in ("unit", "start", "end", "ord"))
    number = lambda c: pd.Categorical(rows[c], categories=["", *sorted(set(rows[c]) - {""})]).codes
    codes = [number(c) for c in ("state", "sex", "kind")]
    place, places = pd.factorize(pd.MultiIndex.from_frame(rows[["venue", "compound", "city"]]))
    name, names = pd.factorize(rows["name"])

    @lru_cache(KNOWN)
    def same_place(p: int, q: int) -> int:
        (venue, compound, _), (venue2, compound2, _) = places[p], places[q]
        fits = _places(*places[p], *places[q])
        return 3 if fits is None else 0 if not fits else 1 if venue and venue2 and compound == compound2 else 2

    @lru_cache(KNOWN)
    def same_name(m: int, n: int) -> int:
        return sum(_names(names[m], names[n]))

    def judged(of: np.ndarray, x: np.ndarray, y: np.ndarray, known: int, judge: Callable[[int, int], int]) -> np.ndarray:
        at, both = pd.factorize(of[x].astype("int64") * known + of[y])
        return np.array([judge(*divmod(v, known)) for v in both.tolist()], dtype="int8")[at]

    is_y = rows["y"].to_numpy(dtype=bool)
    xs, ys = np.flatnonzero(rows["x"].to_numpy(dtype=bool)), np.flatnonzero(is_y)
    low, high = start.min(), start.max()
    wide = high - low + 2
    first = np.cumsum(is_y)[xs]
    last = np.searchsorted((unit * wide + start - low)[ys], unit[xs] * wide + np.clip(end[xs] + 1 - low, -1, high - low), side="right")
    count = np.maximum(last - first, 0)
    upto = np.concatenate([[0], np.cumsum(count)])
    i = 0
    while i < len(xs):
        j = max(i + 1, int(np.searchsorted(upto, upto[i] + STRIDE, side="right")) - 1)
        n = count[i:j]
        x = np.repeat(xs[i:j], n)
        y = ys[np.arange(len(x)) + np.repeat(first[i:j] - (upto[i:j] - upto[i]), n)]
        fits = end[y] >= start[x] - 1
        for code in codes:
            fits &= (code[x] == code[y]) | (code[x] == 0) | (code[y] == 0)
        x, y = x[fits], y[fits]
        where = judged(place, x, y, len(places), same_place)
        x, y, where = x[where > 0], y[where > 0], where[where > 0]
        named = judged(name, x, y, len(names), same_name)
        fits = (named == 2) | ((named == 1) & (where < 3))
        if fits.any():
            a, b = ord_[x[fits]], ord_[y[fits]]
            yield pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b), "code": where[fits].astype("int32")})
        i = j


def _lead(rows: pd.DataFrame) -> pd.DataFrame:
    """(ord, leader) of one block of _alike() rows, by the plain pass: a row is compared with leaders, never with followers."""
    rows = rows.sort_values("ord")
    # Numbers for texts; 0 is the blank one, which fits all.
    number = lambda c: pd.Categorical(rows[c], categories=["", *sorted(set(rows[c]) - {""})]).codes.astype(np.int32)
    place, places = pd.factorize(pd.MultiIndex.from_frame(rows[["venue", "compound", "city"]]))
    name, names = pd.factorize(rows["name"])
    same_place = cache(lambda p, q: _places(*places[p], *places[q]))
    same_name = cache(lambda m, n: _names(names[m], names[n]))
    leads = np.empty((7, 64), dtype=np.int32)  # a column a leader, in order of arrival
    orders, found, known = [], [], {}
    told = zip(rows["ord"].tolist(), *(x.tolist() for x in (rows["start"], rows["end"], number("state"), number("sex"), number("kind"), place, name)), strict=True)
    for ord_, *row in told:
        start, end, state, sex, kind, p, m = row
        leader = known.get(key := tuple(row))
        if leader is None:
            now = leads[:, : len(orders)]
            fits = (now[0] <= end + 1) & (now[1] >= start - 1)
            for code, at in ((state, 2), (sex, 3), (kind, 4)):
                if code:
                    fits &= (now[at] == code) | (now[at] == 0)
            for i in np.flatnonzero(fits).tolist():
                one = same_place(int(now[5, i]), p)
                if one is not False and same_name(int(now[6, i]), m)[one is None]:
                    leader = orders[i]
                    break
            else:
                leader = ord_
                if len(orders) == leads.shape[1]:
                    leads = np.concatenate([leads, np.empty_like(leads)], axis=1)
                leads[:, len(orders)] = row
                orders.append(ord_)
            # A row alike follows the same leader, unless that is one that does not fit itself.
            if leader != ord_ or (end >= start - 1 and same_name(m, m)[same_place(p, p) is None]):
                known[key] = leader
        found.append(leader)
    return pd.DataFrame({"ord": rows["ord"].to_numpy(), "leader": found}, dtype="int64")


def _class_leaders(classes: DataFrame, across_months: bool, scratch: Scratch) -> DataFrame:
    """(ord, leader) of prepared classes: blocks are settled whole in tasks without pairs, only those too large for one by pairs."""
    led, rest = settled_blocks(_alike(classes, across_months), ["block", "sp", "org"], _lead, "ord long, leader long", scratch, "blocks")
    alone = classes.where("start_date IS NULL").select(F.col("ord").cast("long").alias("ord"), F.col("ord").cast("long").alias("leader"))
    led = led.unionByName(alone)
    if rest.isEmpty():
        return led
    large = scratch.table(classes.join(rest.select("ord"), "ord", "left_semi"), "large")
    return led.unionByName(leaders(large, matching_pairs(large, across_months), scratch))


def cluster(rows: DataFrame, across_months: bool = False) -> DataFrame:
    """``rows`` with cluster: the ord of the first row of each row's event-site.

    Rows need the columns in FIELDS and ord, the arrival order. Rows without a start stand alone. Rows equal in FIELDS
    are one class: they would meet the same leader, so only classes are compared, and only with leaders.
    """
    scratch = Scratch(rows.sparkSession, "linkage")
    equal = rows.groupBy(*FIELDS).agg(F.min("ord").alias("ord"))
    classes = scratch.table(prepare(equal), "classes")
    led = _class_leaders(classes, across_months, scratch)
    # A class that does not match itself (no date, or neither place nor name) leaves its rows alone.
    selfless = F.col("start_date").isNull() | ((F.col("_venue") == "") & (F.col("_city") == "") & (F.size("_tokens") == 0))
    named = classes.select(*FIELDS, "ord", selfless.alias("_selfless")).join(led, "ord").select(*FIELDS, "leader", "_selfless")
    hit = rows.alias("r").join(named.alias("n"), [F.col(f"r.{c}").eqNullSafe(F.col(f"n.{c}")) for c in FIELDS])
    return hit.select("r.*", F.when(F.col("n._selfless"), F.col("r.ord")).otherwise(F.col("n.leader")).alias("cluster"))


def source_rank(source_type: Column) -> Column:
    """2 for an organiser's site, 1 for the listing platform, 0 for others."""
    out = None
    for name, rank in vocab.SOURCE_PRIORITY.items():
        out = F.when(source_type == name, rank) if out is None else out.when(source_type == name, rank)
    return out.otherwise(0)


def merge(rows: DataFrame, by: str = "cluster", order: str = "ord") -> DataFrame:
    """One row per cluster: by source rank, then arrival, the first truthy value of each column.

    start is the earliest and end the latest; team_count the first; flags their union, 'corroborated' added where
    several sources agree; sources the distinct (collector or source type, fingerprint), in order; and where the counts
    differ all are listed. Each column is one min_by, so clusters are reduced before they are shuffled; the arrays hold
    distinct values only.
    """
    kinds = dict(rows.dtypes)
    plain = [c for c in rows.columns if c not in (by, order, "flags", "start_date", "end_date")]
    rank = F.struct((-source_rank(F.col("source_type"))).alias("r"), F.col(order).alias("o"))
    firsts = []
    for c in plain:
        known = truthy(F.col(c), kinds[c])
        firsts.append(F.min_by(known, F.when(known.isNotNull(), rank)).alias(c))
    tag = F.concat_ws(":", F.coalesce(F.nullif("collector", F.lit("")), "source_type"), text("fingerprint"))
    tagged = rows.withColumn("_tag", tag)
    out = tagged.groupBy(by).agg(
        *firsts,
        F.min("start_date").alias("start_date"),
        F.max("end_date").alias("end_date"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.coalesce("flags", F.array().cast("array<string>")))))).alias("_flags"),
        F.array_sort(F.collect_set(F.nullif(F.col("team_count").cast("string"), F.lit("")))).alias("_counts"),
        F.collect_set("_tag").alias("_tags"),
        F.min(order).alias(order),
    )
    several = F.size("_tags") > 1
    return out.select(
        by,
        order,
        *plain,
        "start_date",
        "end_date",
        F.array_sort(F.when(several, F.array_union("_flags", F.array(F.lit("corroborated")))).otherwise(F.col("_flags"))).alias("flags"),
        F.array_sort("_tags").alias("sources"),
        F.size("_tags").alias("source_count"),
        F.when(F.size("_counts") > 1, F.col("_counts")).alias("team_count_variants"),
    )


def site_sets(rows: DataFrame) -> DataFrame:
    """Per event (over its sites): the sites each source names, and what each one misses.

    rows: event_group, source, site. Returns event_group, source, sites, missing, site_count (of the event),
    source_count and mismatch (two sources or more whose sets differ). Sets are built from distinct rows, so a source
    that repeats a site many times adds one.
    """
    one = rows.where("event_group IS NOT NULL").select("event_group", "source", F.when(text("site") != "", F.col("site")).otherwise("(unspecified)").alias("site")).distinct()
    per = one.groupBy("event_group", "source").agg(F.array_sort(F.collect_list("site")).alias("sites"))
    all_ = one.select("event_group", "site").distinct().groupBy("event_group").agg(F.array_sort(F.collect_list("site")).alias("_all"))
    spread = per.groupBy("event_group").agg(F.count("*").alias("source_count"), (F.min("sites") != F.max("sites")).alias("mismatch"))
    joined = per.join(all_, "event_group").join(spread, "event_group")
    return joined.select("event_group", "source", "sites", F.array_except("_all", "sites").alias("missing"), F.size("_all").alias("site_count"), "source_count", "mismatch")


def process(events: DataFrame, gazetteer: DataFrame, as_of: Column | str, stored: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The whole chain: enrich, type, validate, exact dedupe, union with stored rows, cluster, merge. (merged, rejected)."""
    from gatherline.operators.cleanse import enrich, keep_best, validate, with_types

    judged = validate(with_types(enrich(events, gazetteer)), as_of)
    accepted = judged.where("accepted").drop("accepted")
    rows = keep_best(accepted, ["fingerprint"])
    if stored is not None:
        rows = rows.unionByName(stored, allowMissingColumns=True)
    return merge(cluster(rows)), judged.where("NOT accepted")


def with_keys(rows: DataFrame) -> DataFrame:
    """``rows`` with event_group and blocking_key."""
    return rows.withColumns({"event_group": event_group_key(F.col("sport"), F.col("organizer"), F.col("start_date"), F.col("name")), "blocking_key": blocking_key(F.col("organizer"), F.col("start_date"))})
