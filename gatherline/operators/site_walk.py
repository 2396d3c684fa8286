"""The walk over organisers' sites that have been landed: from the home page to listings, event pages and contacts.

A site is walked in rounds over all organisers at once. Links of the pages reached last are judged by address and label,
the best of each kind become the next frontier, and what was visited before or was not landed is left out by joins. Then
events come from the pages by their role, are merged, named, dated and placed; contacts come from home and contact pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatherline import vocab
from gatherline.functions.dates import clock_times, find_ranges, grad_years, team_count
from gatherline.functions.names import gender_class, squeeze
from gatherline.functions.pages import SKIP_LINK, emails, is_platform, links, page_lines, page_text, page_title, phones, registered_domain, unescape, vendor_email
from gatherline.functions.places import addresses, town_states
from gatherline.functions.values import let, text
from gatherline.operators.gate import in_horizon, name_verdict
from gatherline.operators.listings import labelled_venues, office_town_dropped, venue_before
from gatherline.operators.report import crawl_words, same_page_merge
from gatherline.operators.rollups import drop_conflicts, office_towns
from gatherline.operators.site_pages import absolute, clean_name, event_blocks, page_key
from gatherline.plans.scratch import Scratch
from gatherline.sources.landed import json_ld_events

#: Pages of a site that are followed from its home page, by kind, and from one listing page.
FOLLOWED = {"event": 6, "contact": 2, "vendor": 1}
CHILDREN = 15
#: Characters of a page's text in which an event's own page names its date.
TOP = 4000


def site_links(pages: DataFrame) -> DataFrame:
    """page, target (key), kind (platform, vendor, contact, event, other), child (one level below the page) and rank of every page's distinct links on its own site or to a platform.

    pages: key, url, html. rank orders a page's links of one kind: lists before single events, plain addresses before queries.
    """
    whole = F.transform(links(F.col("html")), lambda r: F.struct(absolute(r["href"], F.col("url")).alias("u"), r["label"].alias("label")))
    good = F.filter(whole, lambda r: r["u"].rlike("^https?://") & ~r["u"].rlike(SKIP_LINK))
    rows = pages.select(F.col("key").alias("page"), "url", F.posexplode(good).alias("i", "r")).select("page", "url", "i", "r.*").withColumn("target", page_key(F.col("u")))
    path = F.lower(F.regexp_replace(F.regexp_replace(F.col("u"), "^https?://[^/?]*", ""), r"\?.*$", ""))
    said = F.concat_ws(" ", F.regexp_replace(path, "[-_]", " "), F.col("label"))
    kind = (
        F.when(is_platform(F.col("u")), "platform")
        .when(registered_domain(F.col("u")) != registered_domain(F.col("url")), None)
        .when(said.rlike(vocab.VENDOR_HINT), "vendor")
        .when(said.rlike(vocab.CONTACT_HINT), "contact")
        .when(said.rlike(vocab.EVENT_HINT) & ~said.rlike(vocab.NAME_FAULTS[2][1]), "event")
        .otherwise("other")
    )
    base = F.concat(F.regexp_replace(page_key(F.col("url")), r"\?.*$", ""), F.lit("/"))
    rest = F.when(F.col("target").startswith(base), F.substring(F.col("target"), F.length(base) + 1, F.length("target")))
    depth = F.size(F.filter(F.split(path, "/"), lambda p: p != ""))
    order = F.struct(depth.alias("depth"), F.col("u").contains("?").cast("int").alias("query"), (~F.col("u").rlike("(?i)tournament|showcase|event")).cast("int").alias("plain"), F.length("u").alias("n"), F.col("i"))
    judged = rows.select("page", "target", "u", "i", kind.alias("kind"), F.coalesce(rest.rlike("^[^/?]+$"), F.lit(False)).alias("child"), order.alias("order"))
    # Of a page's links to one address the first speaks. A page's links are its own, so windows hold one page at most.
    one = judged.where("kind IS NOT NULL").withColumn("_n", F.row_number().over(Window.partitionBy("page", "target").orderBy("i"))).where("_n = 1")
    by_kind = Window.partitionBy("page", "kind").orderBy(F.when(F.col("kind") == "event", F.col("order")), "i")
    return one.withColumn("rank", F.row_number().over(by_kind)).select("page", "target", "kind", "child", "rank", "i")


def walk(sites: DataFrame, pages: DataFrame, links_: DataFrame, scratch: Scratch) -> DataFrame:
    """(organizer, key, role, round) of every page that is visited: home, event (listing), contact, vendor, child.

    sites: organizer, key of the home page. A page is visited once, in the earliest round and the first role that reaches it.
    """
    landed = pages.select("key").distinct()
    place = {r: i for i, r in enumerate(["home", "event", "contact", "vendor", "child"])}
    names = F.array(*map(F.lit, place))
    seen = scratch.table(sites.join(landed, "key", "left_semi").select("organizer", "key", F.lit(0).alias("role"), F.lit(0).alias("round")).distinct(), "walk-0")
    last = seen
    for turn in (1, 2):
        out = last.select("organizer", "role", F.col("key").alias("page")).join(links_, "page")
        if turn == 1:
            wanted = F.coalesce(*[F.when((F.col("kind") == k) & (F.col("rank") <= n), place[k]) for k, n in FOLLOWED.items()])
        else:
            below = Window.partitionBy("organizer", "page", F.col("child")).orderBy("i")
            out = out.where(F.col("role") == place["event"]).withColumn("_n", F.row_number().over(below))
            wanted = F.when(F.col("child") & (F.col("_n") <= CHILDREN), place["child"])
        found = out.withColumn("to", wanted).where("to IS NOT NULL").groupBy("organizer", F.col("target").alias("key")).agg(F.min("to").alias("role"))
        last = scratch.table(found.join(landed, "key", "left_semi").join(seen.select("organizer", "key"), ["organizer", "key"], "left_anti").select("organizer", "key", "role", F.lit(turn).alias("round")), f"walk-{turn}")
        seen = seen.unionByName(last)
    return seen.select("organizer", "key", F.element_at(names, F.col("role") + 1).alias("role"), "round")


def barred(html: Column) -> Column:
    """A page's text with bars between its lines, so that what stands in one line is not read into the next."""
    return F.array_join(page_lines(html), " | ")


def heading(html: Column) -> Column:
    """A page's own name: its first heading, else its title without the site's name; null where that names no event."""
    first = squeeze(unescape(F.regexp_replace(F.regexp_extract(text(html), r"(?is)<h[12]\b[^>]*>(.*?)</h[12]\s*>", 1), r"(?s)<[^>]*>", " ")))
    own = F.when(F.length(first) >= 4, first).otherwise(F.regexp_replace(text(page_title(html)), r"\s+[|–—-]\s+.*$", ""))
    return let(clean_name(own), lambda n: F.when(F.length(n).between(4, 100) & ~n.rlike(vocab.NAME_FAULTS[0][1]) & ~n.rlike(vocab.MORE_LINK), n))


def single_events(pages: DataFrame, as_of: str) -> DataFrame:
    """The event of an event's own page: key, name, start, end, said (its text), for pages that name one and a date near the top."""
    read = pages.withColumn("said", barred(F.col("html"))).withColumn("_d", F.get(find_ranges(F.left("said", F.lit(TOP)), as_of), F.lit(0)))
    named = read.where("_d IS NOT NULL").withColumn("name", heading(F.col("html")))
    fault = name_verdict(F.col("name"))
    kept = named.where(F.col("name").isNotNull() & (fault.isNull() | ~fault.isin("junk", "heading", "not_event")))
    return kept.select("key", "name", F.col("_d.start").alias("start"), F.col("_d.end").alias("end"), "said")


def own_name(name: Column, organizer: Column) -> Column:
    """A name without the parts that only say the organiser; null where nothing else is said."""
    words = F.split(text(name), r"\s+[|–—]\s+|\s+-\s+")
    org = crawl_words(organizer)
    keep = F.filter(words, lambda p: (F.trim(p) != "") & ((F.size(crawl_words(p)) == 0) | (F.size(F.array_except(crawl_words(p), F.concat(org, F.array(F.lit("inc"))))) > 0)))
    return F.when(F.size(keep) == F.size(words), name).when(F.size(keep) > 0, F.array_join(keep, " – "))


def site_events(visits: DataFrame, pages: DataFrame, as_of: str, scratch: Scratch) -> DataFrame:
    """Events of visited pages, merged and filled from their own pages: organizer, name, start, end, page, detail, address, venue, city_states, ages, gender, teams, first_time, said."""
    at = F.lit(as_of).cast("date")
    body = scratch.table(visits.join(pages.select("key", "url", "html"), "key"), "body")
    lists = body.where(F.col("role").isin("home", "event"))
    distinct = lists.select(F.col("key").alias("page_id"), "url", "html").dropDuplicates(["page_id"])
    marked = json_ld_events(distinct).where("name IS NOT NULL AND start_date IS NOT NULL")
    marked = marked.select(F.col("page_id").alias("key"), clean_name(F.col("name")).alias("name"), F.col("start_date").alias("start"), F.col("end_date").alias("end"), page_key(F.col("url")).alias("detail"), F.lit("").alias("said"), F.lit(False).alias("unnamed"), "venue_name", F.when(F.col("city").isNotNull() & F.col("state").isNotNull(), F.array(F.concat_ws(", ", "city", "state"))).alias("stated"))
    marked = scratch.table(marked, "marked")
    blank = [F.lit(None).cast("string").alias("venue_name"), F.lit(None).cast("array<string>").alias("stated")]
    told = event_blocks(distinct.join(marked.select(F.col("key").alias("page_id")).distinct(), "page_id", "left_anti"), as_of)
    told = told.select(F.col("page_id").alias("key"), "name", "start", "end", page_key(F.col("detail")).alias("detail"), "said", "unnamed", *blank)
    listed = scratch.table(marked.unionByName(told), "listed")
    # Pages read on their own: listings without blocks, pages below listings, and the events' pages of a listing that is all past.
    past = listed.groupBy("key").agg(F.max(F.coalesce("end", "start")).alias("last")).where(F.col("last") < at).select("key")
    stale = listed.join(past, "key").where("detail IS NOT NULL").join(body.select("key", "organizer"), "key").select("organizer", F.col("detail").alias("key")).distinct()
    alone = body.where(F.col("role") == "event").join(listed.select("key").distinct(), "key", "left_anti").select("organizer", "key").unionByName(body.where(F.col("role") == "child").select("organizer", "key"))
    covered = listed.where("detail IS NOT NULL").select(F.col("detail").alias("key")).distinct()
    alone = alone.join(covered, "key", "left_anti").unionByName(stale).distinct()
    single = single_events(alone.select("key").distinct().join(pages.select("key", "url", "html"), "key"), as_of)
    raw = listed.join(body.select("organizer", "key"), "key").unionByName(alone.join(single, "key").select("key", "organizer", "name", "start", "end", F.col("key").alias("detail"), "said", F.lit(False).alias("unnamed"), *blank), allowMissingColumns=True)
    fault = name_verdict(F.col("name"))
    kept = raw.where(in_horizon(F.col("start"), at) & (fault.isNull() | (fault == "no_tournament_word")) & ~F.col("key").rlike(vocab.NOT_EVENT_PAGE))
    order = F.struct(F.col("unnamed").alias("u"), F.col("key").alias("k"), F.col("name").alias("n"))
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), order)).alias(c)
    spelling = F.regexp_replace(F.lower("name"), "[^a-z0-9]", "")
    merged = kept.groupBy("organizer", spelling.alias("_spelling"), "start").agg(F.max(F.coalesce("end", "start")).alias("end"), first("name"), first("detail"), first("venue_name"), first("stated"), F.min_by("key", order).alias("page"), F.min("unnamed").alias("unnamed"), F.max_by("said", F.struct(F.length("said"), "said")).alias("said"))
    own = pages.select(F.col("key").alias("detail"), barred(F.col("html")).alias("more"), heading(F.col("html")).alias("_heading"))
    full = merged.join(own, "detail", "left").withColumn("name", F.when(F.col("unnamed"), F.coalesce("_heading", "name")).otherwise(F.col("name")))
    full = full.withColumn("page", F.when(F.col("more").isNotNull(), F.col("detail")).otherwise(F.col("page"))).withColumn("name", own_name(F.col("name"), F.col("organizer"))).where("name IS NOT NULL")
    facility = F.col("name").rlike(r"(?i)\b(arena|complex|park|fields?|center|centre|\w*plex|stadium|dome|school|college|university|academy|turf|facility)\s*$")
    spoken = F.concat_ws(" ", "name", F.left("said", F.lit(600)), F.left("more", F.lit(2000)))
    full = full.where(~(facility & ~F.col("name").rlike(vocab.TOURNAMENT_WORD)) & spoken.rlike(vocab.TOURNAMENT_WORD))
    full = scratch.table(full.withColumn("id", F.xxhash64("organizer", "_spelling", "start")).drop("_heading", "_spelling", "unnamed"), "full")
    one = scratch.table(same_page_merge(full.select("id", "organizer", "page", "name", "start", "end", "detail", "venue_name", "stated", "said", "more"), ["organizer", "page", "detail", "venue_name", "said", "more", "end"]).drop("copies"), "one")
    one = one.join(full.select("id", "stated"), "id")
    unsure = drop_conflicts(one.select("id", "organizer", F.lower("name").alias("name_key"), crawl_words(F.col("name")).alias("words"), "start"))
    return placed(one.join(unsure, "id", "left_anti"), body, scratch)


def placed(events: DataFrame, body: DataFrame, scratch: Scratch) -> DataFrame:
    """``events`` with what block and own page say of place, ages, teams and times, the block first; the organiser's own town goes."""
    block, more = text("said"), text("more")
    either = lambda f: F.coalesce(f(block), f(more))
    some = lambda a: F.get(a, F.lit(0))
    read = events.withColumn("address", either(lambda t: some(addresses(t))))
    source = F.when(block.contains(F.col("address")), block).otherwise(more)
    read = read.withColumn("venue", F.coalesce("venue_name", F.when(F.col("address").isNotNull(), venue_before(source, F.col("address"))), either(lambda t: some(labelled_venues(t)))))
    towns = F.array_distinct(F.concat(F.coalesce("stated", F.array().cast("array<string>")), town_states(text("address")), town_states(block), town_states(more)))
    year = F.year("start")
    sex = lambda t: F.when(gender_class(t).isin("boys", "girls"), gender_class(t))
    read = read.select("id", "organizer", "name", "start", "end", "page", "detail", "address", "venue", F.slice(towns, 1, 4).alias("city_states"), either(lambda t: grad_years(t, year)["label"]).alias("ages"), F.coalesce(sex(F.col("name")), either(sex)).alias("gender"), either(team_count).alias("teams"), F.coalesce(clock_times(more)["first"], clock_times(block)["first"]).alias("first_time"), block.alias("said"))
    read = scratch.table(read, "read")
    home = body.where("role = 'home'").select("organizer", page_text(F.col("html")).alias("_home")).withColumn("_towns", town_states(F.col("_home")))
    postal = lambda t: let(F.split(F.col("_home"), F.concat(F.lit(r"\Q"), F.split_part(t, F.lit(","), F.lit(1)), F.lit(r"\E"))), lambda p: F.exists(F.zip_with(F.slice(p, 1, F.size(p) - 1), F.slice(p, 2, F.size(p)), lambda a, b: F.concat(F.right(a, F.lit(60)), F.lit(" | "), F.left(b, F.lit(20)))), lambda w: w.rlike(vocab.POSTAL)))
    home = home.select("organizer", F.filter("_towns", postal).alias("offices"), "_towns")
    told = read.join(home, "organizer", "left").withColumn("city_states", office_town_dropped(F.col("city_states"), F.col("said"), F.col("address"), F.coalesce("offices", F.array().cast("array<string>"))))
    told = scratch.table(told, "told")
    often = office_towns(told.select("organizer", F.col("id").alias("event_id"), F.explode_outer("city_states").alias("town")))
    shared = often.join(home.select("organizer", F.explode("_towns").alias("town")), ["organizer", "town"], "left_semi").groupBy("organizer").agg(F.collect_set("town").alias("_often"))
    rest = F.array_except("city_states", F.coalesce("_often", F.array().cast("array<string>")))
    done = told.join(shared, "organizer", "left").withColumn("city_states", F.when(F.size(rest) > 0, rest).otherwise(F.col("city_states")))
    return done.drop("id", "offices", "_towns", "_often")


def contacts(sites: DataFrame, visits: DataFrame, pages: DataFrame) -> DataFrame:
    """Per organiser its address, phone and vendor contact: home page first, then contact pages; addresses of its own domain before others."""
    read = visits.where(F.col("role").isin("home", "contact", "vendor")).join(pages.select("key", "url", "html"), "key").join(sites.select("organizer", "qualifies").distinct(), "organizer")
    site = registered_domain(F.col("url"))
    found = emails(F.col("html"))
    own = F.filter(found, lambda e: F.split_part(e, F.lit("@"), F.lit(2)).endswith(site))
    said = page_text(F.col("html"))
    rows = read.select("organizer", "qualifies", "role", F.col("key").alias("page"), F.struct(F.when(F.col("role") == "home", 0).otherwise(1).alias("r"), F.col("key").alias("k")).alias("order"), F.coalesce(F.get(own, F.lit(0)), F.get(found, F.lit(0))).alias("email"), F.get(phones(said), F.lit(0)).alias("phone"), F.when(F.col("qualifies"), vendor_email(said)).alias("vendor"))
    plain = lambda c: F.when((F.col("role") != "vendor") & F.col(c).isNotNull(), F.col("order"))
    vendor = F.when(F.col("vendor").isNotNull(), F.struct((F.col("role") != "vendor").cast("int").alias("v"), F.col("order")))
    return rows.groupBy("organizer").agg(F.count("*").alias("pages"), F.min_by("email", plain("email")).alias("main_email"), F.min_by("page", plain("email")).alias("email_page"), F.min_by("phone", plain("phone")).alias("main_phone"), F.min_by("vendor", vendor).alias("vendor_email"), F.max(F.when(F.col("role") == "vendor", F.col("page"))).alias("vendor_page"))


def crawl(sites: DataFrame, pages: DataFrame, as_of: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(visits, events, organizers) of landed sites.

    sites: organizer, home (address), qualifies (whether its vendor contact is wanted); pages: url, html. Pages that share
    an address count once, the first by url; null pages say nothing; organisers whose home page was not landed are left out.
    """
    scratch = Scratch(sites.sparkSession, "crawl")
    keyed = pages.where("url IS NOT NULL").select(page_key(F.col("url")).alias("key"), "url", text("html").alias("html"))
    keyed = scratch.table(keyed.groupBy("key").agg(F.min_by(F.struct("url", "html"), F.struct("url", "html")).alias("p")).select("key", "p.url", "p.html"), "pages")
    homes = sites.select("organizer", page_key(F.col("home")).alias("key"), F.coalesce("qualifies", F.lit(False)).alias("qualifies"))
    visits = scratch.table(walk(homes, keyed, scratch.table(site_links(keyed), "links"), scratch), "visits")
    return visits, site_events(visits, keyed, as_of, scratch), contacts(homes, visits, keyed)
