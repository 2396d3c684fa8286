"""Regular expressions that fail fast: a pattern of many alternatives is tried only where one of them can begin."""

from __future__ import annotations


def alternatives(pattern: str) -> list[str]:
    """The parts of a pattern between bars outside groups and classes."""
    out, depth, low, i = [], 0, 0, 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            i += 1
        elif c == "[":
            i = pattern.index("]", i + 1)
        elif c == "|" and depth == 0:
            out.append(pattern[low:i])
            low = i + 1
        else:
            depth += (c == "(") - (c == ")")
        i += 1
    return [*out, pattern[low:]]


def beginnings(alternative: str) -> str | None:
    """The characters that a match can begin with, as the inside of a class; None where that cannot be told."""
    while alternative.startswith(r"\b"):
        alternative = alternative[2:]
    if alternative.startswith("(?:"):
        depth = 0
        for end, c in enumerate(alternative):
            depth += (c == "(") - (c == ")")
            if depth == 0:
                break
        parts = [beginnings(a) for a in alternatives(alternative[3:end])]
        return None if alternative[end + 1 : end + 2] in ("?", "*", "{") or None in parts else "".join(parts)
    first = alternative[:2] if alternative.startswith((r"\d", r"\$")) else alternative[:1]
    after = alternative[len(first) : len(first) + 1]
    if after in ("?", "*") or (after == "{" and alternative[len(first) + 1 : len(first) + 2] in ("0", ",")):
        return None
    if first == r"\d":
        return "0-9"
    return first if first == r"\$" or first.isalnum() else None


def guarded(pattern: str) -> str:
    """The same matches, with a look at the next character before any alternative is tried; for case-sensitive patterns."""
    parts = [beginnings(a) for a in alternatives(pattern)]
    return pattern if None in parts else f"(?=[{''.join(sorted(set(parts)))}])(?:{pattern})"
