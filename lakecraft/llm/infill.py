"""Fill-in-the-middle transformation of whole texts, cut by SWAR words.

A text is a row of units (optional white space and a run of other characters,
or white space at the end). Its UTF-8 bytes are looked at as 64-bit words:

1. *mark*: plain integer arithmetic on a word sets the high bit of every byte
   that is white space, or that continues a code point; no byte carries into
   its neighbour. A byte ends a unit where it is no white space and the next
   one is, and at the end of the text;
2. *rank*: ``bitwise_count`` of each word's marks, and their running sum;
3. *select*: the word that holds the k-th mark is found by binary search in the
   running sum; inside the word one multiplication gives the running count of
   every byte, one subtraction compares all eight with k, and the count of the
   bytes below is the place.

So a cut after k units costs a binary search, whatever the text's length, and
code points between two places are bytes less continuation bytes, by rank.

:func:`transform` returns the transformed text with its form and spans;
:func:`restore` rebuilds the text from the two.

Defined cases: a null text counts as empty, and an empty text is ``plain``; a
text with a sentinel in it is ``plain``; a very long text is a slice of its own
and is cut whole (memory: about three times its bytes); a null id draws as the
empty string; repeated rows are transformed alike, each of them; an empty table
gives no rows; columns named like a result, in any case, are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecraft.llm.tools import documents, without
from lakecraft.llm.words import column_bytes, slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
FIM_PERCENT = 50          # of the texts that can be transformed
SPM_PERCENT = 80          # of the transformed ones; the rest is psm

_U = np.uint64
_HIGH, _LOW7, _ONES = _U(0x8080808080808080), _U(0x7F7F7F7F7F7F7F7F), _U(0x0101010101010101)


def _space_marks(w: np.ndarray) -> np.ndarray:
    """High bit of every byte that is 0x20 or 0x09-0x0D. Sums stay below 256 in each byte."""
    low = w & _LOW7
    other_than_blank = (low ^ (_ONES * _U(0x20))) + _LOW7
    at_least_9, at_least_14 = low + _ONES * _U(0x80 - 9), low + _ONES * _U(0x80 - 14)
    return (~other_than_blank | (at_least_9 & ~at_least_14)) & ~w & _HIGH


class Marks:
    """Marked bytes of a run of 64-bit words, with rank and select."""

    def __init__(self, marks: np.ndarray):
        self.words = marks
        self.before = np.zeros(len(marks) + 1, np.int64)
        np.cumsum(np.bitwise_count(marks), out=self.before[1:])

    def rank(self, place: np.ndarray) -> np.ndarray:
        """Marks in the bytes before ``place``."""
        word, byte = place >> 3, (place & 7).astype(_U)
        inside = self.words[np.minimum(word, len(self.words) - 1)] & ((_U(1) << (byte << _U(3))) - _U(1))
        return self.before[word] + np.bitwise_count(inside)

    def select(self, k: np.ndarray) -> np.ndarray:
        """Place of the byte with the k-th mark (k from 1)."""
        word = np.searchsorted(self.before, k, side="left") - 1
        running = (self.words[word] >> _U(7)) * _ONES                       # byte i: marks in bytes 0..i
        left = (k - self.before[word]).astype(_U)
        reached = ((running | _HIGH) - left * _ONES) & _HIGH                # byte i: its running count is k or more
        return (word << 3) + 8 - np.bitwise_count(reached).astype(np.int64)


class Units:
    """Units and code points of texts that lie one after another in ``data`` (``offsets``: n + 1 places)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        size = int(offsets[-1])
        padded = np.zeros((size >> 3) * 8 + 8, np.uint8)
        padded[:size] = data
        w = padded.view("<u8")
        space = _space_marks(w)
        following = space >> _U(8)                                          # byte i: byte i + 1 is white space
        following[:-1] |= space[1:] << _U(56)
        last = np.zeros(len(padded), np.uint8)
        ends = offsets[1:][offsets[1:] > offsets[:-1]] - 1
        last[ends] = 0x80
        self.units = Marks((~space & following & _HIGH) | last.view("<u8"))
        self.continued = Marks(w & ~(w << _U(1)) & _HIGH)                   # bytes 10xxxxxx
        self.start, self.end = offsets[:-1], offsets[1:]
        self.base = self.units.rank(self.start)
        self.n = self.units.rank(self.end) - self.base

    def after(self, k: np.ndarray) -> np.ndarray:
        """Place after each text's first ``k`` units."""
        place = self.start.copy()
        some = k > 0
        place[some] = self.units.select((self.base + k)[some]) + 1
        return place

    def chars(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return stop - start - (self.continued.rank(stop) - self.continued.rank(start))


def _draws(id_col: str, seed: int) -> list[Column]:
    """The first four 8-digit groups of sha256(``seed:id``) as unsigned integers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED,
              fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """The columns of ``docs`` except the text, then n (units), form (``plain``, ``psm``, ``spm``), output (the
    transformed text), prefix_chars and middle_chars (code points; null if plain). Both cuts fall between units
    and are drawn by a hash of seed and id. One pass, no shuffle."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    h1, h2, h3, h4 = _draws(id_col, seed)
    plain = (text == "") | text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE) | (h3 % 100 >= fim_percent)
    form = F.when(plain, "plain").when(h4 % 100 < spm_percent, "spm").otherwise("psm")
    left = without(docs.drop(text_col), "n", "form", "output", "prefix_chars", "middle_chars")
    kept = left.columns
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], text.alias("_fim_text"), form.alias("_fim_form"),
                       h1.alias("_fim_h1"), h2.alias("_fim_h2"))
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))

    def arrange(batches):
        for b in batches:
            texts, forms, draws = b.column(len(kept)), b.column(len(kept) + 1), [b.column(len(kept) + i).to_numpy() for i in (2, 3)]
            data, offsets = column_bytes(texts)
            for i, j in slices(offsets):
                raw = data[offsets[i]:offsets[j]]
                units = Units(raw, offsets[i:j + 1] - offsets[i])
                kind = forms.slice(i, j - i)
                a, c = (d[i:j] % (units.n + 1) for d in draws)
                first, second = units.after(np.minimum(a, c)), units.after(np.maximum(a, c))
                whole, out = raw.tobytes(), []
                for f, x, y, z, end in zip(kind.to_pylist(), units.start.tolist(), first.tolist(), second.tolist(), units.end.tolist()):
                    if f == "plain":
                        out.append(whole[x:end])
                    elif f == "psm":
                        out.append(b"".join((p, whole[x:y], s, whole[z:end], m, whole[y:z])))
                    else:
                        out.append(b"".join((s, whole[z:end], p, whole[x:y], m, whole[y:z])))
                is_plain = np.array([f == "plain" for f in kind.to_pylist()], bool)
                yield pa.RecordBatch.from_arrays(
                    [b.column(k).slice(i, j - i) for k in range(len(kept))]
                    + [pa.array(units.n), kind, pa.array(out, pa.binary()).cast(pa.string()),
                       pa.array(units.chars(units.start, first), mask=is_plain), pa.array(units.chars(first, second), mask=is_plain)],
                    [*kept, "n", "form", "output", "prefix_chars", "middle_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in left.schema.fields}
    shape = ", ".join([f"`{c}` {kinds[c]}" for c in kept] + ["n long", "form string", "output string", "prefix_chars long", "middle_chars long"])
    return rows.mapInArrow(arrange, shape)


def restore(output: Column, form: Column) -> Column:
    """The text from the transformed one and its form: the sentinels stand once each, in a known order."""
    before = lambda x, mark: F.substring_index(x, mark, 1)
    after = lambda x, mark: F.substring_index(x, mark, -1)
    middle = after(output, MIDDLE)
    psm = F.concat(after(before(output, SUFFIX), PREFIX), middle, after(before(output, MIDDLE), SUFFIX))
    spm = F.concat(after(before(output, MIDDLE), PREFIX), middle, after(before(output, PREFIX), SUFFIX))
    return F.when(form == "plain", output).when(form == "psm", psm).when(form == "spm", spm)


#: Contract op13 in DuckDB: units by the pattern, texts put together by code points.
OP13_SQL = r"""
WITH draw AS (
  SELECT doc_id, COALESCE(text, '') AS t, sha256('42:' || CAST(doc_id AS VARCHAR)) AS d FROM documents),
cut AS (
  SELECT doc_id, t, CAST('0x' || d[1:8] AS BIGINT) AS h1, CAST('0x' || d[9:16] AS BIGINT) AS h2, CAST('0x' || d[17:24] AS BIGINT) AS h3,
         CAST('0x' || d[25:32] AS BIGINT) AS h4,
         list_transform(regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+'), lambda u: length(u)) AS units FROM draw),
span AS (
  SELECT doc_id, t, len(units) AS n, units, LEAST(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
         GREATEST(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM cut),
piece AS (
  SELECT doc_id, t, n, form, COALESCE(list_sum(units[1:a]), 0)::BIGINT AS p, COALESCE(list_sum(units[1:b]), 0)::BIGINT AS q FROM span),
told AS (
  SELECT doc_id, t, n, form, p, q, t[1:p] AS pre, t[p + 1:q] AS mid, t[q + 1:] AS suf FROM piece)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN p END AS prefix_chars, CASE WHEN form <> 'plain' THEN q - p END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256
FROM told
"""


def op13_infill(spark, sf_dir: str) -> DataFrame:
    """Contract op13: the transformation of every document, and the text rebuilt from it, as digests."""
    out = transform(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output"), 256).alias("output_sha256"),
                      F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
