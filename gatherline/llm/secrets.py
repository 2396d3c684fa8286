"""Secret scan with DataFrame expressions only.

Three patterns find assigned credentials, access keys and hexadecimal runs. A battery of randomness tests adds what
they miss: for every long run of an encoding's characters the encoding is inferred, and chi-squared uniformity of its
alphabet, the number of runs above and below the middle, and lag-one serial correlation are tested. A run that fails
one of them at VETO is structured and no secret.

For the others the null hypothesis is that the run is text-like: words, paths, names and numbers repeat their
characters (more equal pairs than a uniform alphabet has) and change rarely between small and capital letters, digits
and signs. A run is a secret where that is rejected. Which rejections count is decided at a controlled false discovery
rate over the whole corpus (Benjamini-Hochberg), within classes of like encoding and length: short runs give the tests
little power, and so need more evidence, not less.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatherline.functions.values import let
from gatherline.plans.scratch import Scratch

#: The base patterns, the group that must have the least length, and that length.
PATTERNS = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12),
    "access": (r"(AKIA[A-Z0-9]+)", 18),
    "hex": (r"([0-9a-f]+)", 16),
}
#: The same where all matches that count are found, for a quick look (a shorter match hides no longer one in the last two).
LOOK = {"assign": r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]", "access": r"AKIA[A-Z0-9]{14}", "hex": r"[0-9a-f]{16}"}
SEARCH = PATTERNS | {"access": (r"(AKIA[A-Z0-9]{14,})", 18), "hex": (r"([0-9a-f]{16,})", 16)}
RUN = r"([A-Za-z0-9+/_=-]{20,})"
ALPHABETS = {16: "0123456789abcdef", 32: "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 64: "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"}
#: Share of false ones among the runs found, at most; and the level at which a run counts as structured.
FALSE_DISCOVERIES, VETO = 0.05, 0.001
#: Text-like runs: chance that two, and three, characters are equal, and of a change of class from one to the next, by
#: alphabet. The chances are on the side of random strings, so that the control errs towards fewer discoveries.
TEXT_PAIR, TEXT_TRIPLE = 0.055, 0.0045
TEXT_CHANGE = {16: 0.15, 32: 0.15, 64: 0.35}
#: Matches of a text that are placed in one go.
CHUNK = 64
#: p-values are counted in steps of 1 / STEPS decades, DECADES at most.
STEPS, DECADES = 20, 16
ORDER = ["assign", "access", "hex", "random"]
REDACTED = "<secret>"


def spans(text: Column, pattern: str, kind: str, least: int) -> Column:
    """Leftmost non-overlapping matches as array<struct<start, rank, end, value>>; short values drop out afterwards.

    Matches are placed by the lengths before them, in chunks, so that the work grows with their number.
    """
    whole = r"\G((?s:.*?))(" + pattern + ")"
    parts = F.arrays_zip(*[F.regexp_extract_all(text, F.lit(whole), F.lit(g)).alias(n) for g, n in ((1, "gap"), (2, "hit"), (3, "value"))])
    parts = F.transform(parts, lambda p: F.struct(F.length(p["gap"]).alias("gap"), F.length(p["hit"]).alias("hit"), p["value"].alias("value")))
    empty = F.array().cast("array<struct<start:int,rank:int,end:int,value:string>>")

    def placed(chunk: Column) -> Column:
        return F.aggregate(
            chunk,
            F.struct(F.lit(0).alias("at"), empty.alias("out")),
            lambda s, p: F.struct(
                (s["at"] + p["gap"] + p["hit"]).alias("at"),
                F.concat(
                    s["out"],
                    F.when(
                        F.length(p["value"]) >= least,
                        F.array(F.struct((s["at"] + p["gap"]).alias("start"), F.lit(ORDER.index(kind)).alias("rank"), (s["at"] + p["gap"] + p["hit"]).alias("end"), p["value"].alias("value"))),
                    ).otherwise(empty),
                ).alias("out"),
            ),
        )

    moved = lambda p, by: F.transform(p["out"], lambda x: F.struct((x["start"] + by).alias("start"), x["rank"].alias("rank"), (x["end"] + by).alias("end"), x["value"].alias("value")))
    chunks = let(parts, lambda p: F.transform(F.sequence(F.lit(0), F.floor((F.greatest(F.size(p), F.lit(1)) - 1) / CHUNK).cast("int")), lambda i: placed(F.slice(p, i * CHUNK + 1, CHUNK))))
    before = lambda c: F.aggregate(c, F.array(F.lit(0)), lambda s, p: F.concat(s, F.array(F.element_at(s, -1) + p["at"])))
    return F.flatten(let(chunks, lambda c: F.zip_with(c, F.slice(before(c), 1, F.size(c)), moved)))


def tail(z: Column) -> Column:
    """Upper tail of the normal distribution for z >= 0 (a rational approximation, error below 1e-7)."""
    t = 1 / (1 + 0.2316419 * z)
    series = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.exp(-z * z / 2) * 0.3989422804014327 * series


def upper(z: Column) -> Column:
    return F.when(z >= 0, tail(z)).otherwise(1 - tail(-z))


def battery(runs: Column) -> Column:
    """Each run with its encoding's alphabet size and class of length; p: the least p-value of the three tests of
    randomness times three; q: the least p-value of the two tests against text-like runs times two."""
    known = F.transform(
        runs,
        lambda r: F.struct(
            r["start"].alias("start"),
            r["end"].alias("end"),
            F.rtrim(r["value"], F.lit("=")).alias("body"),
            F.when(r["value"].rlike("^([0-9a-f]+|[0-9A-F]+)$"), 16).when(r["value"].rlike("^[A-Z2-7]+=*$"), 32).otherwise(64).alias("k"),
        ),
    )
    valued = F.transform(
        known,
        lambda r: F.struct(
            r["start"].alias("start"),
            r["end"].alias("end"),
            r["k"].alias("k"),
            F.transform(
                F.regexp_extract_all(F.when(r["k"] == 16, F.lower(r["body"])).otherwise(F.translate(r["body"], "-_", "+/")), F.lit("(.)"), F.lit(1)),
                lambda c: F.instr(F.when(r["k"] == 16, ALPHABETS[16]).when(r["k"] == 32, ALPHABETS[32]).otherwise(ALPHABETS[64]), c).cast("double") - 1,
            ).alias("v"),
        ),
    )
    # Digits or letters of hexadecimal; letters or digits of base 32; capitals, small letters, digits or signs of base 64.
    sort_of = lambda k, x: F.when(k == 16, (x >= 10).cast("int")).when(k == 32, (x >= 26).cast("int")).otherwise((x >= 26).cast("int") + (x >= 52).cast("int") + (x >= 62).cast("int"))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    pairs = lambda v, f: F.zip_with(F.slice(v, 1, F.greatest(F.size(v) - 1, F.lit(0))), F.slice(v, 2, F.greatest(F.size(v) - 1, F.lit(0))), f)
    counted = F.transform(
        F.filter(valued, lambda r: F.size(r["v"]) >= 16),
        lambda r: F.struct(
            r["start"].alias("start"),
            r["end"].alias("end"),
            r["k"].cast("double").alias("k"),
            F.size(r["v"]).cast("double").alias("n"),
            total(F.transform(F.array_distinct(r["v"]), lambda x: F.pow(F.size(F.filter(r["v"], lambda y: y == x)).cast("double"), 2.0))).alias("squares"),
            F.size(F.filter(r["v"], lambda x: x >= r["k"] / 2)).cast("double").alias("high"),
            total(pairs(r["v"], lambda x, y: ((x >= r["k"] / 2) != (y >= r["k"] / 2)).cast("double"))).alias("turns"),
            total(r["v"]).alias("sum"),
            total(F.transform(r["v"], lambda x: x * x)).alias("sum2"),
            total(pairs(r["v"], lambda x, y: x * y)).alias("sumxy"),
            (F.element_at(r["v"], 1) + F.element_at(r["v"], -1)).alias("ends"),
            total(pairs(F.transform(r["v"], lambda x: sort_of(r["k"], x)), lambda x, y: (x != y).cast("double"))).alias("changes"),
        ),
    )

    def tested(r: Column) -> Column:
        n, k, df = r["n"], r["k"], r["k"] - 1
        chi = k / n * r["squares"] - n
        p_chi = upper((F.pow(F.greatest(chi, F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df)))
        low = n - r["high"]
        mean = 2 * r["high"] * low / n + 1
        spread = F.sqrt(F.greatest((mean - 1) * (mean - 2) / (n - 1), F.lit(1e-9)))
        p_runs = F.when((r["high"] == 0) | (low == 0), F.pow(F.lit(0.5), n - 1)).otherwise(2 * tail(F.abs(r["turns"] + 1 - mean) / spread))
        m = r["sum"] / n
        variance = r["sum2"] - n * m * m
        serial = F.when(variance > 1e-9, (r["sumxy"] - m * (2 * r["sum"] - r["ends"]) + (n - 1) * m * m) / variance).otherwise(1.0)
        p_serial = 2 * tail(F.abs(serial) * F.sqrt(n))
        # Equal pairs are too few, or changes of class too many, for a text-like run.
        equal, couples = (r["squares"] - n) / 2, n * (n - 1) / 2
        wide = F.sqrt(couples * (TEXT_PAIR - TEXT_PAIR**2 + 2 * (n - 2) * (TEXT_TRIPLE - TEXT_PAIR**2)))
        q_pairs = upper((couples * TEXT_PAIR - equal - 0.5) / wide)
        change = F.when(k == 16, TEXT_CHANGE[16]).when(k == 32, TEXT_CHANGE[32]).otherwise(TEXT_CHANGE[64])
        q_changes = upper((r["changes"] - (n - 1) * change - 0.5) / F.sqrt((n - 1) * change * (1 - change)))
        return F.struct(
            r["start"].alias("start"),
            r["end"].alias("end"),
            k.cast("int").alias("k"),
            F.when(n < 24, 0).when(n < 32, 1).when(n < 48, 2).when(n < 80, 3).otherwise(4).alias("size"),
            F.least(F.lit(1.0), 3 * F.least(p_chi, p_runs, p_serial)).alias("p"),
            F.least(F.lit(1.0), 2 * F.least(q_pairs, q_changes)).alias("q"),
        )

    return F.transform(counted, tested)


def scan(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", whole: bool = False) -> DataFrame:
    """id and the spans of each row: base and found, both array<struct<start, rank, end>> in order; with ``whole`` also
    row, a struct of all its columns, so that their names cannot clash with these.

    Null and empty texts have no spans. Rows are kept one for one. Ties in start go by kind as listed in ORDER.
    """
    scratch = Scratch(documents.sparkSession, "secrets")
    row = [F.struct(*documents.columns).alias("row")] if whole else []
    kept = ["id", "row"] if whole else ["id"]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    none = F.array().cast("array<struct<start:int,rank:int,end:int,value:string>>")
    base = F.concat(*[F.when(text.rlike(LOOK[kind]), spans(text, pattern, kind, least)).otherwise(none) for kind, (pattern, least) in SEARCH.items()])
    bare = lambda a: F.transform(a, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end")))
    runs = F.when(text.rlike(RUN), battery(spans(text, RUN, "random", 20))).otherwise(F.array().cast("array<struct<start:int,end:int,k:int,size:int,p:double,q:double>>"))
    rows = scratch.table(documents.select(F.col(id_col).alias("id"), *row, F.array_sort(bare(base)).alias("base"), runs.alias("runs")), "rows")
    # Discoveries among the runs that pass for random, at the wanted rate in each class, from counts of q by step. A
    # step's floor is above every q of it, so the counts err towards fewer.
    step = F.least(F.floor(-F.log10(F.greatest(F.col("r.q"), F.lit(1e-300))) * STEPS), F.lit(STEPS * DECADES)).cast("int")
    counts = rows.select(F.explode("runs").alias("r")).where(F.col("r.p") >= VETO).groupBy("r.k", "r.size", step.alias("step")).count()
    by_class = Window.partitionBy("k", "size")
    counts = counts.withColumns({"m": F.sum("count").over(by_class), "below": F.sum("count").over(by_class.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, 0))})
    most = F.pow(F.lit(10.0), -F.col("step") / STEPS)
    limits = counts.where(most <= FALSE_DISCOVERIES * F.col("below") / F.col("m")).groupBy("k", "size").agg(F.max(most).alias("limit")).collect()  # 15 classes at most
    of = lambda x: [F.when((x["k"] == r.k) & (x["size"] == r["size"]), F.lit(float(r["limit"]))) for r in limits]
    random = F.filter("runs", lambda x: (x["p"] >= VETO) & (x["q"] <= F.coalesce(*of(x), F.lit(-1.0))))
    added = F.transform(random, lambda x: F.struct(x["start"].alias("start"), F.lit(ORDER.index("random")).alias("rank"), x["end"].alias("end")))
    return rows.select(*kept, "base", F.array_sort(F.concat("base", added)).alias("found"))


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*map(F.lit, ORDER))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(documents: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for every row of ``documents``; see scan().

    Positions are code points, ends exclusive. Texts are read whole, however long; other columns are not read.
    """
    found = scan(documents)
    count = lambda k: F.size(F.filter("base", lambda s: s["rank"] == k)).cast("long")
    return found.select(F.col("id").alias("doc_id"), *[count(ORDER.index(k)).alias(f"n_{k}") for k in ORDER[:3]], F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("found")).alias("spans"))


def redact(documents: DataFrame) -> DataFrame:
    """All columns of ``documents`` with every span of the text replaced by REDACTED and n_chars set anew.

    Rows are kept one for one; null and empty texts stay as they are; spans that overlap are replaced as one.
    """
    found = scan(documents, whole=True)
    text = F.col("row.text")
    cut = F.aggregate(
        "found",
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda s, x: F.struct(
            F.greatest(s["at"], x["end"]).alias("at"),
            F.when(x["start"] >= s["at"], F.concat(s["out"], F.substring(text, s["at"] + 1, x["start"] - s["at"]), F.lit(REDACTED))).otherwise(s["out"]).alias("out"),
        ),
    )
    clean = F.when(F.size("found") == 0, text).otherwise(F.concat(cut["out"], F.substring(text, cut["at"] + 1, F.length(text))))
    marked = found.select("row", clean.alias("clean"))
    new = {"text": F.col("clean")}
    if "n_chars" in documents.columns:
        new["n_chars"] = F.coalesce(F.length("clean").cast("long"), F.lit(0)).cast(documents.schema["n_chars"].dataType)
    return marked.select(*[new.get(c, F.col("row")[c]).alias(c) for c in documents.columns])
