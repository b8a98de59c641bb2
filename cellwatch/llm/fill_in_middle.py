"""Fill-in-the-middle transformation by SWAR words.

The UTF-8 bytes of a slice of texts are viewed as 64-bit words. Bytes that end a unit are marked in
all eight bytes of a word at once, ``bitwise_count`` gives the marks of each word, the running sum is
searched for the word that holds a wanted mark, and the byte inside the word is found by comparing
the word's eight prefix counts with the wanted rank. No text is cut into a list of units.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwatch.llm.common import map_slices, text_bytes

MARKERS = ("<P>", "<S>", "<M>")
_ONES = np.uint64(0x0101010101010101)
_HIGH = np.uint64(0x8080808080808080)
_LOW = np.uint64(0x7F7F7F7F7F7F7F7F)


def as_words(raw: np.ndarray) -> np.ndarray:
    """The bytes as little-endian 64-bit words, zero-filled, with a whole word of zeros at the end."""
    padded = np.zeros((len(raw) // 8 + 1) * 8, np.uint8)
    padded[:len(raw)] = raw
    return padded.view("<u8")


def newline_marks(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte that is a line feed."""
    x = words ^ (_ONES * np.uint64(10))
    return ~(((x & _LOW) + _LOW) | x | _LOW)


def letter_marks(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte that starts a code point (zero bytes count too)."""
    return ~(words & ~(words << np.uint64(1))) & _HIGH


class Marks:
    """Rank and select over marked bytes."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.ends = np.cumsum(np.bitwise_count(marks), dtype=np.int64)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Number of marks before each byte position."""
        word = at >> 3
        below = (np.uint64(1) << ((at & 7) << 3).astype(np.uint64)) - np.uint64(1)
        here = self.marks[word]
        return self.ends[word] - np.bitwise_count(here) + np.bitwise_count(here & below)

    def select(self, nth: np.ndarray) -> np.ndarray:
        """Byte position of the nth mark (from 1)."""
        word = np.searchsorted(self.ends, nth, "left")
        here = self.marks[word]
        left = (nth - (self.ends[word] - np.bitwise_count(here))).astype(np.uint64)
        # Byte j of the product counts the marks in bytes 0 to j; those below the rank lie before it.
        upto = (here >> np.uint64(7)) * _ONES
        before = ((left * _ONES | _HIGH) - upto - _ONES) & _HIGH
        return (word << 3) + np.bitwise_count(before)


def cut_points(raw: np.ndarray, offsets: np.ndarray, unit: str, draws: list[np.ndarray]):
    """Units of each text, the byte positions of its two cuts, and the code points up to each.

    A draw modulo (units + 1) is the number of units before a cut; the smaller one comes first.
    """
    words = as_words(raw)
    start, stop = offsets[:-1], offsets[1:]
    letters = Marks(letter_marks(words))
    if unit == "line":
        ends = Marks(newline_marks(words))
        first = ends.rank(start)
        marked = ends.rank(stop) - first
        open_end = np.zeros(len(start), bool)
        some = stop > start
        open_end[some] = raw[stop[some] - 1] != 10
        n = marked + open_end
    else:  # a code point ends where the next one starts
        ends, first = letters, letters.rank(start)
        n = marked = letters.rank(stop) - first
    a, b = (draw % (n + 1) for draw in draws)

    def position(k: np.ndarray) -> np.ndarray:
        out = np.where(k == 0, start, stop)
        if unit == "line":
            inner = (k > 0) & (k <= marked)
            out[inner] = ends.select(first[inner] + k[inner]) + 1
        else:
            inner = (k > 0) & (k < marked)
            out[inner] = ends.select(first[inner] + k[inner] + 1)
        return out

    low, high = position(np.minimum(a, b)), position(np.maximum(a, b))
    before = letters.rank(start)
    return n, low, high, letters.rank(low) - before, letters.rank(high) - before


def _check(markers: tuple[str, str, str], unit: str) -> None:
    if len(set(markers)) != 3 or any(not m or any(m[0] in other[1:] for other in markers) for m in markers):
        raise ValueError("markers must differ, and no marker's first sign may stand inside a marker")
    if unit not in ("line", "char"):
        raise ValueError("unit is 'line' or 'char'")


def draws(doc_id: str | Column, seed: int = 7) -> list[Column]:
    """Four unsigned 32-bit numbers from the SHA-256 of ``seed:doc_id`` (a null id counts as no digits)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, seed: int = 7, percent: int = 100, spm_percent: int = 50, unit: str = "line",
                   markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """One row per input row: ``doc_id, n, form, prefix_chars, middle_chars, output``.

    ``n`` counts the units: lines with their line feed (a last one may lack it) or code points. The
    form is ``plain`` (the text as it is; no cuts, null counts) for empty texts, texts that contain a
    marker, and a share of ``100 - percent``; else ``spm`` for a share of ``spm_percent``, or ``psm``.
    Shares and cuts depend on seed and doc_id alone, so equal ids are cut alike and a retried task
    repeats its result. Null text counts as empty; doc_id may be null or repeated, rows stay as they
    are; an empty table gives no rows; other columns are not read.
    """
    _check(markers, unit)
    p, s, m = (x.encode() for x in markers)
    names = [f"h{i}" for i in range(1, 5)]
    ready = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"),
                        *(h.alias(name) for h, name in zip(draws("doc_id", seed), names)))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = batch.column(1)
        raw, offsets = text_bytes(column)
        h1, h2, h3, h4 = (batch.column(i).to_numpy() for i in range(2, 6))
        n, low, high, low_chars, high_chars = cut_points(raw, offsets, unit, [h1, h2])
        plain = (np.diff(offsets) == 0) | (h3 % 100 >= percent)
        for marker in markers:
            plain |= pa.compute.match_substring(column, marker).to_numpy(zero_copy_only=False)
        spm = h4 % 100 < spm_percent
        view, parts = memoryview(raw), []
        for i, (a, x, y, b) in enumerate(zip(offsets[:-1].tolist(), low.tolist(), high.tolist(), offsets[1:].tolist())):
            if plain[i]:
                parts.append(view[a:b])
            elif spm[i]:
                parts += [s, view[y:b], p, view[a:x], m, view[x:y]]
            else:
                parts += [p, view[a:x], s, view[y:b], m, view[x:y]]
        longer = np.where(plain, 0, len(p) + len(s) + len(m))
        places = np.append(0, np.cumsum(np.diff(offsets) + longer))
        out = pa.Array.from_buffers(pa.large_utf8(), len(n), [None, pa.py_buffer(places), pa.py_buffer(b"".join(parts))])
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(np.where(plain, "plain", np.where(spm, "spm", "psm"))),
             pa.array(low_chars, pa.int64(), mask=plain), pa.array(high_chars - low_chars, pa.int64(), mask=plain),
             out.cast(pa.string())],
            ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_slices(ready, work, f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
                                   "output string")


def restored(output: str | Column, form: str | Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that an output of :func:`fill_in_middle` was made from (null for a null output)."""
    _check(markers, "line")
    p, s, m = markers
    out, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        """What stands after the first, the second and the last marker."""
        body = F.substr(out, F.lit(len(first) + 1))
        return (F.substring_index(body, second, 1), F.substring_index(F.substring_index(body, second, -1), m, 1),
                F.substring_index(body, m, -1))

    prefix, suffix, middle = parts(p, s)
    back = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(s, p)
    return F.when(form == "plain", out).when(form == "psm", back).otherwise(F.concat(prefix, middle, suffix))


# The operator's rows as the query gives them.
ORACLE = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents
), u AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS l,
         CAST('0x' || substr(d, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(d, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(d, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(d, 25, 8) AS BIGINT) AS h4 FROM t
), c AS (
  SELECT doc_id, text, l, len(l) AS n, least(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS a,
         greatest(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100
              THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u
), s AS (
  SELECT doc_id, text, n, form, array_to_string(l[1:a], '') AS pre, array_to_string(l[a + 1:b], '') AS mid,
         array_to_string(l[b + 1:n], '') AS suf FROM c
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM s
"""
