"""Event, organiser and venue names: normal forms, token sets and keys, as column expressions.

Three families of rules live side by side and must not be mixed: those of record linkage (``link_*``), of edition
matching (``edition_*``) and of row normalisation (``core_*``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gatherline import vocab
from gatherline.functions.values import first_case, lookup, members, overlap, subset, text, word_set

SQUEEZE = r"\s+"


def squeeze(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, SQUEEZE, " "))


def plain(x: Column, keep: str = "a-z0-9 ") -> Column:
    """Everything but the kept characters turned into blanks, runs of blanks made one."""
    return squeeze(F.regexp_replace(x, f"[^{keep}]", " "))


def slug(x: Column, length: int = 60) -> Column:
    return F.substring(F.regexp_replace(F.regexp_replace(F.lower(text(x)), "[^a-z0-9]+", "-"), "^-+|-+$", ""), 1, length)


# --- record linkage


def link_organizer(name: Column) -> Column:
    """Canonical organiser for record linkage; '' for null."""
    bare = plain(F.lower(text(name)))
    return F.coalesce(lookup(bare, vocab.ORGANIZERS_CORE), bare)


def link_name(name: Column) -> Column:
    """A name without year, ordinal, site number, gender, sponsor and tail; lower-case words only."""
    out = F.lower(text(name))
    for cut in vocab.NAME_CUTS:
        out = F.regexp_replace(out, f"(?i){cut}", " ")
    return plain(out)


def link_tokens(name: Column) -> Column:
    return F.array_except(word_set(link_name(name)), members(vocab.NOISE_WORDS + vocab.GENDER_WORDS))


def identity_tokens(name: Column) -> Column:
    """The words that say which event it is."""
    return identity_of(link_tokens(name))


def identity_of(tokens: Column) -> Column:
    """As identity_tokens, from the name's link_tokens."""
    return F.array_except(tokens, members(vocab.LEVEL_WORDS + vocab.GENERIC_WORDS))


def level_tokens(name: Column) -> Column:
    """Levels of play named, 'high' as hs and 'ms' as middle."""
    return levels_of(link_tokens(name))


def levels_of(tokens: Column) -> Column:
    """As level_tokens, from the name's link_tokens."""
    named = F.array_intersect(tokens, members(vocab.LEVEL_WORDS))
    return F.array_distinct(F.filter(F.transform(named, lambda t: F.coalesce(lookup(t, vocab.LEVEL_ALIASES), t)), lambda t: t != ""))


def is_compound_venue(venue: Column) -> Column:
    """Whether one field names two venues."""
    return text(venue).rlike(vocab.COMPOUND_VENUE)


def link_venue(venue: Column) -> Column:
    """The distinctive words of a venue; '' for none and for placeholders."""
    bare = F.regexp_replace(text(venue), r"(?i)\s*[-–]\s*site\s*\d+\s*$", " ")
    words = F.filter(F.split(F.regexp_replace(F.lower(bare), "[^a-z0-9 ]", " "), SQUEEZE), lambda w: (w != "") & ~w.isin(vocab.FACILITY_WORDS))
    return F.when(F.trim(text(venue)).rlike(vocab.PLACEHOLDER_VENUE), "").otherwise(F.array_join(words, " "))


def venue_match(a: Column, b: Column) -> Column:
    """true, false or null (unknown) for two venue names."""
    x, y = link_venue(a), link_venue(b)
    p, q = word_set(x), word_set(y)
    shared = overlap(p, q)
    close = subset(p, q) | subset(q, p) | (shared / (F.size(p) + F.size(q) - shared) >= 0.6)
    return F.when(is_compound_venue(a) != is_compound_venue(b), False).when((x == "") | (y == ""), F.lit(None).cast("boolean")).when(x == y, True).otherwise(close)


def city_match(a: Column, b: Column) -> Column:
    """true if one town's name contains the other's, null if either is missing."""
    x, y = F.trim(F.lower(text(a))), F.trim(F.lower(text(b)))
    return F.when((x != "") & (y != ""), x.contains(y) | y.contains(x))


def event_group_key(sport: Column, organizer: Column, start: Column, name: Column) -> Column:
    """Key of one event over all its sites: 16 hex digits, null without a date."""
    ident = F.array_join(F.array_sort(identity_tokens(name)), " ")
    words = F.array_join(F.array_sort(link_tokens(name)), " ")
    raw = F.concat_ws("|", F.coalesce(F.when(sport != "", sport), F.lit("lacrosse")), link_organizer(organizer), F.date_format(F.date_trunc("week", start), "yyyy-MM-dd"), F.when(ident != "", ident).otherwise(words))
    return F.when(start.isNotNull(), F.substring(F.sha1(raw), 1, 16))


def blocking_key(organizer: Column, start: Column) -> Column:
    return F.concat(link_organizer(organizer), F.lit("|"), F.coalesce(F.date_format(start, "yyyy-MM"), F.lit("nodate")))


def event_fingerprint(sport: Column, organizer: Column, name: Column, start: Column, raw_date: Column, venue: Column) -> Column:
    """Exact identity of one scraped row: 16 hex digits."""
    parts = [F.lower(text(sport)), F.lower(text(organizer)), F.regexp_replace(F.lower(text(name)), "[^a-z0-9]", ""), F.coalesce(F.date_format(start, "yyyy-MM-dd"), F.lower(text(raw_date))), F.lower(text(venue))]
    return F.substring(F.sha1(F.concat_ws("|", *parts)), 1, 16)


# --- row normalisation


def core_organizer(name: Column) -> Column:
    """Canonical organiser of normalised rows; null for none. Company words go, then aliases apply."""
    bare = plain(F.lower(name))
    bare, table = F.trim(F.regexp_replace(bare, vocab.COMPANY_WORDS, "")), vocab.ORGANIZERS_COMMON
    return F.when(name != "", F.coalesce(lookup(bare, table), lookup(F.trim(F.lower(name)), table), F.when(bare != "", bare)))


def registry_organizer(name: Column) -> Column:
    """As core_organizer, apostrophes dropped first."""
    return core_organizer(F.regexp_replace(text(name), "['’]", ""))


def core_name(name: Column) -> Column:
    """A name without years, kinds of event, sports and genders; the bare name where nothing is left."""
    bare = plain(F.regexp_replace(F.lower(name), vocab.CORE_STOP, " "))
    return F.when(name != "", F.when(bare != "", bare).otherwise(F.trim(F.regexp_replace(F.lower(name), "[^a-z0-9 ]+", " "))))


def core_fingerprint(name: Column, sport: Column, state: Column) -> Column:
    core = core_name(name)
    return F.when(core != "", F.concat_ws("|", F.lower(text(sport)), F.upper(text(state)), core))


def organizer_from_name(name: Column) -> Column:
    """The organiser that an event's name mentions, if it mentions exactly one."""
    words = F.regexp_extract_all(F.lower(text(name)), F.lit("([a-z0-9]+)"), F.lit(1))
    hits = F.array_distinct(F.filter(F.transform(words, lambda w: lookup(w, vocab.ORGANIZER_IN_NAME)), lambda w: w.isNotNull()))
    return F.when(F.size(hits) == 1, F.element_at(hits, 1))


# --- edition matching


def edition_name(name: Column) -> Column:
    """A name without site, year and numeric date; abbreviations spelt out in order, before punctuation goes."""
    out = F.regexp_replace(text(name), r"(?i)\s*[-–|:]\s*site\s*\d+\s*$|\(\s*site\s*\d+\s*\)", "")
    out = F.regexp_replace(F.lower(out), r"\b(19|20)\d\d\b", " ")
    out = F.regexp_replace(out, r"\b\d{1,2}/\d{1,2}(/\d{2,4})?\b", " ")
    for short, long in vocab.EDITION_ABBREVIATIONS.items():
        out = F.regexp_replace(out, rf"\b{short}\b", long)
    return plain(out)


def edition_core(name: Column) -> Column:
    """Every meaningful word."""
    return F.array_except(F.filter(word_set(edition_name(name)), lambda w: (F.length(w) > 1) & ~w.rlike(r"^\d+$")), members(["the", "of", "at", "and", "site"]))


def edition_distinctive(name: Column) -> Column:
    """Words that identify which event it is."""
    known = members(vocab.EDITION_GENERIC + vocab.EDITION_ORGANIZERS)
    return F.filter(F.array_except(edition_core(name), known), lambda w: ~w.rlike(r"^\d+(st|nd|rd|th)?$"))


def edition_gender(gender: Column, name: Column) -> Column:
    """boys or girls, from the field or else the name; null when neither or both."""
    girls = text(name).rlike(r"(?i)\b(girls?|women'?s|ladies|lady)\b")
    boys = text(name).rlike(r"(?i)\b(boys?|men'?s)\b")
    return F.when(gender.isin("boys", "girls"), gender).when(girls & ~boys, "girls").when(boys & ~girls, "boys")


# --- classes


def gender_class(x: Column) -> Column:
    """coed, girls, boys or unknown."""
    return first_case(F.lower(text(x)), vocab.GENDER_PATTERNS, F.lit("unknown"))


def event_type(name: Column, given: Column) -> Column:
    """showcase, camp or league by the name, else the type given, else tournament."""
    return first_case(F.lower(text(name)), vocab.EVENT_TYPES, F.coalesce(F.when(given != "", given), F.lit("tournament")))


def sport_class(x: Column, in_order: bool = True) -> Column:
    """First sport whose pattern is found. In the given order 'hockey' hides 'field hockey'; in_order=False mends that."""
    patterns = vocab.SPORT_PATTERNS if in_order else sorted(vocab.SPORT_PATTERNS, key=lambda p: p[0] != "field hockey")
    return first_case(F.lower(text(x)), [(rx, sport) for sport, rx in patterns])


def acronym(name: Column) -> Column:
    """'Orange County Great Park' and 'OC Great Park' -> OCGP."""
    words = F.filter(F.regexp_extract_all(text(name), F.lit("([A-Za-z]+)"), F.lit(1)), lambda w: ~F.lower(w).isin("of", "the", "and", "at"))
    return F.array_join(F.transform(words, lambda w: F.when(w.rlike("^[A-Z]{1,3}$"), w).otherwise(F.upper(F.substring(w, 1, 1)))), "")


def is_real_venue(venue: Column) -> Column:
    """Not empty, not a placeholder, not a list of states."""
    bare = F.trim(text(venue))
    return (link_venue(venue) != "") & ~bare.rlike(r"(?i)\b(tbd|tbc)\b") & ~bare.rlike(r"^(?:[A-Z]{2}(?:\s*(?:,|and|&|/)\s*)?)+$")


def same_venue(a: Column, b: Column) -> Column:
    """As venue_match without the rule on compound names; null unless both are real venues."""
    p, q = word_set(link_venue(a)), word_set(link_venue(b))
    shared = overlap(p, q)
    close = subset(p, q) | subset(q, p) | (shared / (F.size(p) + F.size(q) - shared) >= 0.6)
    return F.when(is_real_venue(a) & is_real_venue(b), close)


def loose_venue(a: Column, b: Column) -> Column:
    """Names shortened to an acronym, or word by word to a beginning of three letters or more."""
    one = F.trim(text(a)).rlike("^[A-Z]{3,5}$") & is_real_venue(b) & (acronym(b) == F.trim(text(a)))
    two = F.trim(text(b)).rlike("^[A-Z]{3,5}$") & is_real_venue(a) & (acronym(a) == F.trim(text(b)))
    p, q = F.split(link_venue(a), " "), F.split(link_venue(b), " ")
    alike = F.zip_with(p, q, lambda x, y: (x == y) | ((F.least(F.length(x), F.length(y)) >= 3) & (x.startswith(y) | y.startswith(x))))
    words = is_real_venue(a) & is_real_venue(b) & (F.size(p) == F.size(q)) & (F.size(p) >= 2) & F.forall(alike, lambda x: F.coalesce(x, F.lit(False)))
    return F.coalesce(one | two | words, F.lit(False))


def club_from_team(team: Column) -> Column:
    """The club in a team's name: years, ages, genders and colours dropped; null for placeholders."""
    colours = "black|white|red|blue|green|gold|silver|orange|purple|navy|grey|gray|maroon|teal|yellow|pink|royal|carolina|columbia|charcoal|crimson|scarlet|lime|forest|kelly|sky|light|dark|cardinal|burgundy|bronze|platinum|graphite|steel|slate|tan|cream|elite|storm"
    out = F.element_at(F.split(F.regexp_replace(text(team), "&amp;", "&"), " - "), 1)
    out = F.element_at(F.split(out, r"[-–](?=[A-Z][a-z])"), 1)
    out = F.regexp_replace(out, r"(?i)\b(20[2-4]\d|\d{1,2}(?:u|th|st|nd|rd)|u\d{1,2}|boys?|girls?|" + colours + r"|select|premier|national|aa|aaa|hs|varsity|jv|youth)\b|[-–/]", " ")
    lead = F.regexp_extract(out, r"^\s*(\d{1,2}\s)", 1)
    body = F.regexp_replace(F.concat(F.lit(" "), F.regexp_replace(out, r"^\s*\d{1,2}\s", "")), r"(?<=\s)\d{1,2}$|(?<=\s)\d{1,2}(?=\s)", " ")
    out = F.regexp_replace(squeeze(F.concat(lead, body)), "^[ -]+|[ -]+$", "")
    return F.when((out != "") & ~F.lower(out).isin("team", "teams", "lacrosse", "lax", "club", "the", "tbd", "tba", "open", "a", "b", "c"), out)
