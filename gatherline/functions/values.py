"""Value semantics the rules rely on: truthiness, exact rounding, clamping, and small set algebra on arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def text(x: Column | str) -> Column:
    """The text, or the empty text for null."""
    return F.coalesce(F.col(x) if isinstance(x, str) else x, F.lit(""))


def let(x: Column, body: Callable[[Column], Column]) -> Column:
    """body(x) with x worked out once: an expression used many times is otherwise evaluated each time."""
    return F.element_at(F.transform(F.array(x), body), 1)


def truthy(x: Column, kind: str) -> Column:
    """Null where the value counts as missing: null, '', 0, false, an empty array or map. kind: Spark's type name."""
    if kind.startswith(("array", "map")):
        return F.when(F.size(x) > 0, x)
    if kind == "string":
        return F.when(x != "", x)
    if kind == "boolean":
        return F.when(x, x)
    if kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal"):
        return F.when(x != 0, x)
    return x


def clamp(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low).cast("double"), F.least(F.lit(high).cast("double"), x.cast("double")))


def round_even(x: Column, digits: int = 0) -> Column:
    """Rounds a double as its exact binary value demands, ties to even: 0.35 -> 0.3 and 2.675 -> 2.67 at one and two digits.

    Spark's round and bround decide on the shortest decimal form and so differ near ties. The product with the power of
    ten is taken with its exact error (Veltkamp's split, Dekker's product). Sound below 2**52 / 10**digits.
    """
    x = x.cast("double")
    if digits == 0:
        return F.bround(x, 0)
    scale = F.lit(float(10**digits))
    split = F.lit(134217729.0)
    high = x * split - (x * split - x)
    low = x - high
    s_high = scale * split - (scale * split - scale)
    s_low = scale - s_high
    product = x * scale
    error = ((high * s_high - product) + high * s_low + low * s_high) + low * s_low
    down = F.floor(product).cast("double")
    # Where the product itself rounded up onto a whole number, the error is negative and the floor is one too high.
    down = F.when((product == down) & (error < 0), down - 1).otherwise(down)
    over = (product - down - 0.5) + error
    up = (over > 0) | ((over == 0) & (F.pmod(down, F.lit(2.0)) == 1))
    return (down + F.when(up, 1.0).otherwise(0.0)) / scale


def overlap(a: Column, b: Column) -> Column:
    """Number of values that two sets (arrays without repeats) share."""
    return F.size(F.array_intersect(a, b))


def jaccard(a: Column, b: Column) -> Column:
    """Shared values over all values; 0 where either set is empty."""
    both = overlap(a, b)
    return F.when((F.size(a) > 0) & (F.size(b) > 0), both / (F.size(a) + F.size(b) - both)).otherwise(0.0)


def subset(a: Column, b: Column) -> Column:
    return F.size(F.array_except(a, b)) == 0


def members(values: Iterable[str]) -> Column:
    """A constant array of texts."""
    return F.array(*[F.lit(v) for v in values])


def word_set(words: Column) -> Column:
    """Distinct words of a text whose words are separated by single blanks; none for an empty text."""
    return F.array_distinct(F.array_remove(F.split(words, " "), ""))


def lookup(key: Column, table: dict[str, str]) -> Column:
    """table[key], null where the key is not there."""
    return F.element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def first_case(x: Column, cases: Iterable[tuple[str, str]], default: Column | None = None) -> Column:
    """The value of the first pattern that is found in the text."""
    out = None
    for pattern, value in cases:
        hit = x.rlike(pattern)
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise(default) if default is not None else out
