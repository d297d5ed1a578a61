"""Fill-in-the-middle: texts cut at two unit borders and put together in another order.

The bytes of a batch of texts are one wavelet matrix over character classes. Units end behind a
character of a closing class (a line end, say) or at the end of the text, so the number of borders
up to a place is a sum of ranks, the k-th border is a select (one closing class) or a bisection
on the ranks (several), and code points are places less the rank of continuation bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, text_or_empty
from .wavelet import WaveletMatrix

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
# Shares in per cent: texts that are cut, and among them those with the suffix first.
CUT_PCT, SUFFIX_FIRST_PCT = 100, 50

CONTINUATION, OTHER, BLANK, LINE_END, STOP = range(5)
LEVELS = 3
_CLASS = np.full(256, OTHER, dtype=np.uint8)
_CLASS[0x80:0xC0] = CONTINUATION
_CLASS[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = BLANK
_CLASS[0x0A] = LINE_END
_CLASS[[ord(c) for c in ".!?"]] = STOP
# Classes whose characters close a unit.
UNITS = {"line": (LINE_END,), "sentence": (LINE_END, STOP), "word": (LINE_END, BLANK)}

_CUT = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
     ("middle_chars", pa.int64()), ("output", pa.string())]
)


def borders(raw: np.ndarray, ends: np.ndarray, closing: tuple[int, ...]) -> tuple[WaveletMatrix, np.ndarray, np.ndarray, np.ndarray]:
    """(matrix, closing characters before each text, closing characters in it, units in it).

    ``raw`` holds the bytes of all texts, ``ends`` the place of each one's start and end.
    """
    matrix = WaveletMatrix(_CLASS[raw], LEVELS)
    closed = matrix.rank_of(closing, ends)
    inside = np.diff(closed)
    filled = np.diff(ends) > 0
    last = _CLASS[raw[np.maximum(ends[1:] - 1, 0)]] if len(raw) else np.zeros(len(filled), np.uint8)
    return matrix, closed[:-1], inside, inside + (filled & ~np.isin(last, closing))


def place(matrix: WaveletMatrix, closing: tuple[int, ...], before: np.ndarray, inside: np.ndarray, ends: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Where the first ``k`` units of each text end: behind its k-th closing character, or its end."""
    at = np.where(k > 0, ends[1:], ends[:-1])
    hit = np.flatnonzero((k > 0) & (k <= inside))
    if len(hit):
        wanted = (before + k - 1)[hit]
        at[hit] = 1 + (matrix.select(closing[0], wanted) if len(closing) == 1 else matrix.bisect(closing, wanted))
    return at


def draws(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four numbers below 2**32 of each id: the first 8-digit groups of SHA-256 of ``seed:id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(
    docs: DataFrame, unit: str = "line", seed: int = SEED, cut_pct: int = CUT_PCT, suffix_first_pct: int = SUFFIX_FIRST_PCT
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of each row of ``docs`` (doc_id, text).

    Two borders of the ``n`` units are drawn from ``doc_id``; the texts between them go out as
    ``psm`` (prefix, suffix, middle, each behind its mark) or ``spm`` (suffix, prefix, middle). A null
    text is empty; an empty text, one that holds a mark, and those that are not drawn are
    ``plain``: the text, null lengths. A null doc_id draws as the empty string; repeated rows stay
    (equal ids draw equally); other columns are ignored; an empty table gives an empty one.
    One pass, no shuffle; a worker holds one batch of whole texts.
    """
    bounded_batches(docs.sparkSession)
    closing = UNITS[unit]
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = batch.column(1).cast(pa.large_binary())
            ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
            data = texts.buffers()[2]
            raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data else np.empty(0, np.uint8)
            ends = ends - ends[0]
            h1, h2, h3, h4 = (batch.column(k).to_numpy() for k in range(2, 6))
            matrix, before, inside, n = borders(raw, ends, closing)
            k1, k2 = h1 % (n + 1), h2 % (n + 1)
            first = place(matrix, closing, before, inside, ends, np.minimum(k1, k2))
            second = place(matrix, closing, before, inside, ends, np.maximum(k1, k2))
            chars = [p - matrix.rank(CONTINUATION, p) for p in (ends[:-1], first, second)]
            drawn = (np.diff(ends) > 0) & (h3 % 100 < cut_pct)
            suffix_first = h4 % 100 < suffix_first_pct
            whole, forms, outputs = raw.tobytes(), [], []
            for a, b, c, d, cut, spm in zip(ends, first, second, ends[1:], drawn, suffix_first, strict=False):
                text = whole[a:d]
                if not cut or any(m in text for m in marks):
                    forms.append("plain")
                    outputs.append(text)
                    continue
                p, s, m = marks[0] + whole[a:b], marks[1] + whole[c:d], marks[2] + whole[b:c]
                forms.append("spm" if spm else "psm")
                outputs.append(s + p + m if spm else p + s + m)
            plain = np.array([f == "plain" for f in forms])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(forms, pa.string()),
                 pa.array(chars[1] - chars[0], pa.int64(), mask=plain), pa.array(chars[2] - chars[1], pa.int64(), mask=plain),
                 pa.array(outputs, pa.binary()).cast(pa.string())],
                schema=_CUT,
            )

    doc_id = F.col("doc_id").cast("long")
    named = [h.alias(f"h{k}") for k, h in enumerate(draws(doc_id, seed), 1)]
    return docs.select(doc_id.alias("doc_id"), text_or_empty().alias("text"), *named).mapInArrow(
        run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    )


def restored(output: Column, form: Column) -> Column:
    """The exact text, rebuilt from an output and its form; null where either is null."""
    inner = F.substring(output, len(PREFIX) + 1, F.length(output))

    def parted(text: Column, mark: str) -> tuple[Column, Column]:
        """What stands before the first ``mark``, and behind it: cut texts hold no mark, so it is the true one."""
        head = F.substring_index(text, mark, 1)
        return head, F.substring(text, F.length(head) + len(mark) + 1, F.length(text))

    prefix, rest = parted(inner, SUFFIX)
    suffix, middle = parted(rest, MIDDLE)
    suffix_2, rest_2 = parted(inner, PREFIX)
    prefix_2, middle_2 = parted(rest_2, MIDDLE)
    return (
        F.when(form == "psm", F.concat(prefix, middle, suffix))
        .when(form == "spm", F.concat(prefix_2, middle_2, suffix_2))
        .otherwise(output)
    )


def op12_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    """The contract's digest: all ``documents`` cut at lines, and the texts rebuilt from the outputs."""
    made = fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


OP12_SQL = r"""
WITH lines AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
         sha256('7:' || doc_id) AS h
  FROM documents),
drawn AS (
  SELECT doc_id, t, u, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS a, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 100 THEN 'plain'
              WHEN ('0x' || h[25:32])::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM lines),
cut AS (
  SELECT doc_id, t, n, form, array_to_string(u[1:least(a, b)], '') AS p,
         array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m, array_to_string(u[greatest(a, b) + 1:], '') AS s
  FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM cut
"""
