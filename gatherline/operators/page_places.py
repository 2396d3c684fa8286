"""Venues and towns in running text of event pages, and how they combine with what a listing says."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gatherline import vocab
from gatherline.functions.names import squeeze
from gatherline.functions.pages import spots
from gatherline.functions.places import STREET, address_key, addresses, state_code, town_states
from gatherline.functions.values import let, text
from gatherline.operators.listings import venue_before

_NAMES = "|".join(sorted((n.title() for n in vocab.STATE_CODES), key=len, reverse=True))
_WORDS = r"[A-Z][A-Za-z.'’\-]+(?:\s+[A-Z][A-Za-z.'’\-]+){0,3}"
TOWN = rf"\b({_WORDS}),\s*({'|'.join(vocab.STATES)}|{_NAMES})\b"
#: A saint, mount, fort or point that opens a town's name and is no street.
OPENING = r"(?i)^(st|ste|mt|ft|pt)\.?$"
PLACE = "struct<venue:string,city:string,state:string>"


def comma_states(x: Column) -> Column:
    """A state's code written without its comma gets one: 'Oakton MD' -> 'Oakton, MD'."""
    return F.regexp_replace(text(x), rf"\b({_WORDS})\s+({'|'.join(sorted(vocab.STATES))})\b(?=\s|,\s*\d|$)", "$1, $2")


def town_of(phrase: Column) -> Column:
    """The town at the end of capitalised words: what follows the last street, facility, number or sentence, labels dropped."""

    def cut(w: Column) -> Column:
        n = F.size(w)
        bare = lambda x: F.regexp_replace(x, "[.,]+$", "")
        facility = lambda x: bare(x).rlike(f"^{vocab.FACILITY}$") | (F.lower(x) == "world")
        opens = lambda x, i: x.rlike(OPENING) & ((i == 0) | facility(F.get(w, i - 1)))
        street = lambda x, i: bare(x).rlike(f"(?i)^{STREET}$") & ~opens(x, i)
        ends = lambda x, i: street(x, i) | x.rlike(r"\d") | (x.endswith(".") & ~x.rlike(OPENING)) | (facility(x) & ~facility(F.element_at(w, -1)))
        at = F.coalesce(F.array_max(F.transform(w, lambda x, i: F.when((i < n - 1) & ends(x, i), i + 1))), F.lit(0))
        return F.slice(w, at + 1, n)

    def opened(w: Column) -> Column:
        mixed = F.exists(w, lambda x: x != F.upper(x))
        menu = lambda x: mixed & (x == F.upper(x)) & (F.length(x) > 1) & ~x.rlike(OPENING)
        first = F.array_min(F.transform(w, lambda x, i: F.when(~(menu(x) | F.regexp_replace(x, ":$", "").rlike(f"^{vocab.PLACE_LABEL}$")), i + 1)))
        return F.slice(w, F.coalesce(first, F.size(w) + 1), F.size(w))

    return F.array_join(let(let(F.split(squeeze(phrase), " "), opened), lambda w: let(w, cut)), " ")


def town_spans(x: Column) -> Column:
    """array<struct<city, state, start, end>> of every 'Town, ST', repeats kept; start is where the town's own words begin."""

    def read(s: Column) -> Column:
        phrase, code = F.regexp_extract(s["value"], TOWN, 1), F.regexp_extract(s["value"], TOWN, 2)
        return let(town_of(phrase), lambda town: F.struct(F.when(town == F.upper(town), F.initcap(town)).otherwise(town).alias("city"), state_code(code).alias("state"), (s["start"] + F.length(phrase) - F.length(town)).alias("start"), s["end"].alias("end")))

    return F.filter(F.transform(spots(x, TOWN.replace("(", "(?:", 1).replace(",\\s*(", ",\\s*(?:", 1)), read), lambda t: (F.length(t["city"]) >= 3) & t["state"].isNotNull())


def _strip(x: Column) -> Column:
    return F.regexp_replace(x, r"^[ ,\-|]+|[ ,\-|]+$", "")


def _venue(x: Column) -> Column:
    """A venue's name without labels, map links, its street number or a dangling word; null where too short or too long."""
    out = F.regexp_replace(text(x), r"(?i)^(?:location|venue|where)\s*:?\s*", "")
    out = F.regexp_replace(out, r"(?i)\s*[-–]?\s*field map\b.*$|\s+map linked here.*$", "")
    out = _strip(F.regexp_replace(F.regexp_replace(out, r",?\s+\d{1,6}\b.*$", ""), r"(?i)\s+(?:in|at)$", ""))
    return F.when(F.length(out).between(3, 70), out)


def _tidy(x: Column) -> Column:
    out = F.regexp_replace(squeeze(text(x)), r"\b([A-Z])\.([A-Z])\.", "$1$2")
    return F.regexp_replace(out, r"^Greater\s+[A-Z][\w .'-]*?\s+Area\s+", "")


def place_from_text(x: Column) -> Column:
    """struct<venue, city, state> of a location text: the venue stands before the street address, else before the town."""

    def read(t: Column, towns: Column) -> Column:
        first, address = F.get(towns, F.lit(0)), F.get(addresses(t), F.lit(0))
        at = F.instr(t, address) - 1
        before = F.when(address.isNull(), F.substring(t, F.lit(1), first["start"])).when(at.between(3, 70), F.substring(t, F.lit(1), at)).otherwise(venue_before(t, address))
        return F.when(F.size(towns) > 0, F.struct(_venue(_strip(before)).alias("venue"), first["city"].alias("city"), first["state"].alias("state")).cast(PLACE))

    plain = lambda t, towns: F.when(F.size(towns) > 0, t).otherwise(comma_states(t))
    return let(let(_tidy(x), lambda t: plain(t, town_spans(t))), lambda t: let(town_spans(t), lambda towns: read(t, towns)))


def places_from_text(x: Column) -> Column:
    """array of places, one for every town named, in order; each venue is the text between the town before and its own."""

    def read(t: Column, towns: Column) -> Column:
        def one(s: Column, i: Column) -> Column:
            low = F.when(i == 0, 0).otherwise(F.get(towns, i - 1)["end"])
            name = F.regexp_replace(_strip(F.substring(t, low + 1, s["start"] - low)), r"(?i)^\d+(?:st|nd|rd|th)\s+location\s*:?\s*", "")
            return F.struct(F.when(F.length(name).between(3, 70) & ~name.rlike(vocab.NO_VENUE), name).alias("venue"), s["city"].alias("city"), s["state"].alias("state")).cast(PLACE)

        return F.transform(towns, one)

    plain = lambda t, towns: F.when(F.size(towns) > 0, t).otherwise(comma_states(t))
    return let(let(squeeze(text(x)), lambda t: plain(t, town_spans(t))), lambda t: let(town_spans(t), lambda towns: read(t, towns)))


def venue_from_page(x: Column) -> Column:
    """The place of a page's text: between bars first, else after the first label, in their order, that a town follows."""
    barred = F.regexp_extract_all(text(x), F.lit(r"\|\s*([^|]{3,90}?,\s*[A-Z]{2})\s*\|"), F.lit(1))
    labelled = [F.transform(spots(x, f"(?i:{label})"), lambda s: F.substring(text(x), s["end"] + 1, F.lit(260))) for label in vocab.VENUE_LABELS]
    found = F.filter(F.transform(F.concat(barred, *labelled), place_from_text), lambda p: p["city"].isNotNull())
    return F.get(found, F.lit(0))


SITE = "struct<venue:string,city:string,state:string,address:string>"
#: Characters of a section of venues at most.
SECTION = 900


def section_sites(x: Column) -> Column:
    """array<struct<venue, city, state, address>> of all places in a page's sections of venues, each address once.

    A section runs from its heading to the next section's words; the positions of its addresses cut it, and what stands
    between one address and the next is the next one's venue, without map links, division notes and the town before.
    """
    said = squeeze(F.regexp_replace(text(x), r"\b([A-Z])\.([A-Z])\.", "$1$2"))

    def of_section(section: Column) -> Column:
        def cut(found: Column) -> Column:
            def one(a: Column, i: Column) -> Column:
                low = F.when(i == 0, 0).otherwise(F.get(found, i - 1)["end"])
                before = F.regexp_replace(F.substring(section, low + 1, a["start"] - low), r"^.*,\s*[A-Z]{2}\b\.?", "")
                name = _edges(squeeze(F.regexp_replace(before, vocab.VENUE_NOTES, " ")))
                name = let(name, lambda n: F.when(F.length(n) > 70, _edges(F.element_at(F.split(n, r"[.!?]\s+"), -1))).otherwise(n))
                address = F.regexp_replace(squeeze(a["value"]), "[.,]+$", "")
                town = F.try_element_at(town_states(address), F.lit(-1))
                venue = let(name, lambda n: F.when(F.length(n).between(3, 70) & ~n.rlike(vocab.NO_VENUE), n))
                return F.struct(venue.alias("venue"), F.regexp_extract(town, r"^(.*), [A-Z]{2}$", 1).alias("city"), F.right(town, F.lit(2)).alias("state"), F.when(town.isNotNull(), address).alias("address")).cast(SITE)

            return F.transform(found, one)

        return let(spots(section, vocab.ADDRESS), cut)

    def section(t: Column, s: Column) -> Column:
        rest = F.substring(t, s["end"] + 1, F.lit(SECTION))
        return let(F.try_element_at(F.filter(spots(rest, vocab.SECTION_END), lambda e: e["start"] >= 5), F.lit(1))["start"], lambda end: F.when(end.isNull(), rest).otherwise(F.substring(rest, F.lit(1), end)))

    whole = let(said, lambda t: F.flatten(F.transform(spots(t, vocab.SITE_SECTION), lambda s: let(section(t, s), of_section))))
    known = let(whole, lambda w: F.filter(w, lambda p: p["address"].isNotNull()))
    return let(F.transform(known, lambda p: F.struct(address_key(p["address"]).alias("k"), p.alias("p"))), lambda w: F.transform(F.filter(w, lambda r, i: ~F.exists(F.slice(w, 1, i), lambda e: e["k"] == r["k"])), lambda r: r["p"]))


def more_sites(x: Column, known: Column, state: Column) -> Column:
    """The places of a page's sections, in the event's state where that is given, if they are more than the ``known`` ones (array of such places) and more than one; else those."""
    found = F.filter(section_sites(x), lambda p: (text(state) == "") | (p["state"] == state))
    return let(found, lambda f: F.when(F.size(f) > F.greatest(F.lit(1), F.size(known)), f).otherwise(known))


def _edges(x: Column) -> Column:
    return F.regexp_replace(x, r"^[ :,.\-–|]+|[ :,.\-–|]+$", "")


def merge_page_place(city: Column, state: Column, page: Column) -> Column:
    """The listing's place with what its page says: the listing's town wins, the page's fills in where there is none.

    The page's venue is kept where its town agrees (equal, or one ends with the other's two words or more), its state
    does not differ and it is no page text.
    """
    words = lambda c: F.filter(F.split(F.regexp_replace(F.replace(F.lower(text(c)), F.lit("saint "), F.lit("st ")), "[^a-z ]", " "), " "), lambda w: w != "")
    a, b = words(city), words(page["city"])
    tail = lambda long, short: (F.size(short) >= 2) & (F.slice(long, F.greatest(F.size(long) - F.size(short) + 1, F.lit(1)), F.size(short)) == short)
    agree = (a == b) | tail(b, a) | tail(a, b)
    name = F.nullif(F.regexp_replace(text(page["venue"]), r"^\W+", ""), F.lit(""))
    venue = F.when(~name.rlike(vocab.NO_VENUE), name)
    stranger = (text(page["city"]) == "") | ((text(state) != "") & (text(page["state"]) != "") & (state != page["state"]))
    own = F.struct(F.lit(None).cast("string").alias("venue"), city.alias("city"), state.alias("state"))
    return (
        F.when(F.coalesce(stranger, F.lit(True)), own)
        .when(text(city) != "", F.struct(F.when(agree, venue).alias("venue"), city.alias("city"), state.alias("state")))
        .otherwise(F.struct(venue.alias("venue"), page["city"].alias("city"), F.coalesce(page["state"], state).alias("state")))
        .cast(PLACE)
    )
