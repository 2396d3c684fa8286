"""Fill-in-middle rearrangement of documents by overlapping chunks.

A text is a row of units: runs of ASCII letters, and every other character alone. Whether a unit begins at a character
depends on it and the one before it only, so a text is looked at in chunks that overlap by one character: each chunk
counts the units that begin in it, whole chunks at a time and without knowing the others; prefix sums over the chunks
give the number of units and route both cut ranks to the chunks that own them; only those are looked at again to find
the cut places. Nothing larger than a chunk's flags is made beside the text, so very long texts cost no more memory
than they hold. Chunks of one text stay in the task that read it: moving them would cost more than counting them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatherline.llm.blocks import blocks

#: Bytes of a chunk, and of the stretch of chunks whose flags are made at once.
CHUNK, STRETCH = 1 << 12, 1 << 20
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Shares in hundredths: documents rearranged, and of those the ones with the suffix first.
REARRANGED, SUFFIX_FIRST = 90, 20
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True


def begins(data: np.ndarray, first: bool) -> tuple[np.ndarray, np.ndarray]:
    """Where units and where characters begin, of UTF-8 bytes with one byte of overlap before them (none if first)."""
    whole = (data & 0xC0) != 0x80
    letter = LETTER[data]
    unit = whole.copy()
    unit[1:] &= ~(letter[1:] & letter[:-1])
    return (unit, whole) if first else (unit[1:], whole[1:])


def counts(data: np.ndarray, edges: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Units and characters that begin in each chunk data[edges[i]:edges[i + 1]]; a text's first byte begins a unit."""
    units, characters = np.zeros(len(edges) - 1, np.int64), np.zeros(len(edges) - 1, np.int64)
    low = 0
    while low < len(edges) - 1:
        high = max(low + 1, int(np.searchsorted(edges, edges[low] + STRETCH, "right")) - 1)
        a, b = int(edges[low]), int(edges[high])
        unit, whole = begins(data[max(a - 1, 0) : b], a == 0)
        firsts = offsets[np.searchsorted(offsets, a) : np.searchsorted(offsets, b)]
        unit[firsts - a] = True  # the byte before a text's first is another text's
        at = edges[low:high] - a
        units[low:high], characters[low:high] = np.add.reduceat(unit, at, dtype=np.int64), np.add.reduceat(whole, at, dtype=np.int64)
        low = high
    return units, characters


def locate(data: np.ndarray, edges: np.ndarray, offsets: np.ndarray, chunk: int, rank: int) -> tuple[int, int]:
    """Byte place, and characters before it in the chunk, of the chunk's unit number ``rank``."""
    a, b = int(edges[chunk]), int(edges[chunk + 1])
    unit, whole = begins(data[max(a - 1, 0) : b], a == 0)
    if offsets[np.searchsorted(offsets, a)] == a:
        unit[0] = True
    at = int(np.flatnonzero(unit)[rank])
    return a + at, int(np.count_nonzero(whole[:at]))


def draws(key: object, seed: int) -> tuple[int, int, int, int]:
    """Four 32-bit numbers for a document's id; a null id counts as the empty text."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
    return tuple(int.from_bytes(digest[4 * i : 4 * i + 4], "big") for i in range(4))


def transform(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1) -> DataFrame:
    """Every document cut at two drawn unit borders and rearranged for fill-in-middle training, one row per row.

    Returns doc_id, n (units), form (plain, psm or spm), prefix_chars, middle_chars (null if plain), output. plain is the
    text itself: where it is empty or null, holds one of the marks, or is not drawn. psm is prefix, suffix, middle, each
    after its mark; spm has the suffix first. What is drawn depends on seed and id alone, so rows that repeat an id are
    drawn alike; a null id is drawn as the empty one. Texts of any length are looked at whole. An empty table gives no
    rows; other columns are not read.
    """
    marks = {name: m.encode() for name, m in (("p", PREFIX), ("s", SUFFIX), ("m", MIDDLE))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for low, high, data, offsets in blocks(batch.column(1)):
                # Chunk borders: every text's ends, and every CHUNK bytes within a text.
                sizes = np.diff(offsets)
                per = -(-sizes // CHUNK)
                first = np.concatenate([[0], np.cumsum(per)])
                edges = np.append(np.repeat(offsets[:-1], per) + CHUNK * (np.arange(first[-1]) - np.repeat(first[:-1], per)), offsets[-1])
                units, characters = counts(data, edges, offsets) if len(data) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
                starts = np.unique(offsets)
                units_before, characters_before = (np.concatenate([[0], np.cumsum(x)]) for x in (units, characters))
                rows = []
                for i in range(high - low):
                    a, b, c, d = int(offsets[i]), int(offsets[i + 1]), int(first[i]), int(first[i + 1])
                    text = data[a:b].tobytes()
                    n = int(units_before[d] - units_before[c])
                    h = draws(keys[low + i], seed)
                    if not text or h[2] % 100 >= REARRANGED or any(m in text for m in marks.values()):
                        rows.append((n, "plain", None, None, text))
                        continue
                    cut = []
                    for rank in sorted((h[0] % (n + 1), h[1] % (n + 1))):
                        if rank == n:
                            cut.append((b, int(characters_before[d] - characters_before[c])))
                            continue
                        owner = int(np.searchsorted(units_before[c : d + 1], units_before[c] + rank, "right")) - 1 + c
                        at, inside = locate(data, edges, starts, owner, int(rank - (units_before[owner] - units_before[c])))
                        cut.append((at, int(characters_before[owner] - characters_before[c]) + inside))
                    (x, before), (y, until) = cut
                    prefix, middle, suffix = marks["p"] + text[: x - a], marks["m"] + text[x - a : y - a], marks["s"] + text[y - a :]
                    suffix_first = h[3] % 100 < SUFFIX_FIRST
                    rows.append((n, "spm" if suffix_first else "psm", before, until - before, suffix + prefix + middle if suffix_first else prefix + suffix + middle))
                n, form, before, middle, output = zip(*rows, strict=True)
                columns = [pa.array(n, pa.int64()), pa.array(form), pa.array(before, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.binary())]
                yield pa.record_batch([batch.column(0).slice(low, high - low), *columns], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    source = documents.select(documents[id_col].alias("doc_id"), documents[text_col].cast("string").alias("t"))
    kind = dict(source.dtypes)["doc_id"]
    out = source.mapInArrow(run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output binary")
    return out.withColumn("output", F.col("output").cast("string"))


def restore(form: Column, output: Column) -> Column:
    """The text that an output of transform() was made from."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return F.when(form == "plain", output).when(form == "psm", F.concat(parts[1], parts[3], parts[2])).otherwise(F.concat(parts[2], parts[3], parts[1]))


def digests(documents: DataFrame) -> DataFrame:
    """transform() with the SHA-256 of its output and of the text restored from it instead of the output itself; odd rows as there."""
    made = transform(documents)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restore(F.col("form"), F.col("output")), 256).alias("restored_sha256"))


#: The same in SQL, unit by unit.
DIGESTS_SQL = r"""
WITH cut AS (
  SELECT doc_id, COALESCE(text, '') AS t, regexp_extract_all(COALESCE(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || doc_id) AS d FROM documents
), drawn AS (
  SELECT *, len(u) AS n, ('0x' || d[1:8])::BIGINT AS h1, ('0x' || d[9:16])::BIGINT AS h2, ('0x' || d[17:24])::BIGINT AS h3, ('0x' || d[25:32])::BIGINT AS h4 FROM cut
), placed AS (
  SELECT *, LEAST(h1 % (n + 1), h2 % (n + 1)) AS x, GREATEST(h1 % (n + 1), h2 % (n + 1)) AS y,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT doc_id, t, n, form, array_to_string(u[1:x], '') AS p, array_to_string(u[x + 1:y], '') AS m, array_to_string(u[y + 1:], '') AS s FROM placed
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM parts
"""
