"""Language ID by compression: the language whose dictionaries make the text smallest.

Each language has a few zstandard raw-content dictionaries made of sample texts. A text is
reduced to its words (lower-case runs of letters, one space between) and cut into blocks, every block is compressed behind every dictionary, and a language's size is the
sum over its dictionaries and all blocks. The smallest size wins; the margin to the second is
the score, and a narrow margin rejects the text.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, columns_of, in_pieces, text_or_empty

# The sample: about this many documents a language, this many code points of each.
SAMPLE_DOCS = 400
SAMPLE_CHARS = 1200
# Dictionaries a language and their largest size.
DICTIONARIES = 1
DICTIONARY_BYTES = 110 << 10
# Texts are compressed in blocks of so many bytes; every block counts.
BLOCK_BYTES = 8192
# A long text is reduced to its words in parts of about so many code points; its blocks are the same.
PART_CHARS = 1 << 18
# From this level on, matches of three bytes are found; lower ones lose two texts in a hundred.
LEVEL = 6
# A text of fewer bytes is compressed behind PAD_BYTES of the language and their size is taken off:
# alone it would be too short for the compressor to save anything.
SHORT_BYTES = 128
PAD_BYTES = 512
# A text is rejected when the second language needs less than this share more.
MIN_MARGIN = 0.002
UNKNOWN = "und"

# Words are letters with their marks: no digits, no other numbers, no underscore. Most texts have neither
# marks nor other numbers, and then a plain class finds the same words faster.
_LETTERS = re.compile(r"[^\W\d_]+")
_ALL_LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_RARE = regex.compile(r"[\p{M}\p{No}\p{Nl}]")
_SPACE = re.compile(r"\s")
_MARKS = regex.compile(r"\p{M}*")
_WORD_END = regex.compile(r"\p{L}\p{M}*\Z")


def _words(text: str) -> list[str]:
    if text.isascii() or not _RARE.search(text):
        return _LETTERS.findall(text)
    return _ALL_LETTERS.findall(text)

_OUT = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])


@dataclass
class Model:
    """Languages, most frequent first, and the contents of their dictionaries."""

    languages: list[str]
    contents: list[list[bytes]]

    def compressors(self) -> list[list[tuple[zstandard.ZstdCompressor, bytes, int]]]:
        """For each language its compressors, each with the pad for short texts and the pad's size."""
        made = []
        for own in self.contents:
            made.append([])
            for raw in own:
                d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(level=LEVEL)
                c = zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_dict_id=False)
                made[-1].append((c, raw[:PAD_BYTES], len(c.compress(raw[:PAD_BYTES]))))
        return made


def held_out(doc_id: int | None, parts: int = 4, part: int = 2) -> bool:
    """Whether crc32 of the id's text leaves ``part``; a null id is held out (nothing is learned from it)."""
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % parts == part


def held_out_column(parts: int = 4, part: int = 2) -> F.Column:
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(crc % parts == part, F.lit(True))


def train(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """Dictionaries from ``labelled`` (doc_id, text, lang); rows with a null in text or lang teach nothing.

    The languages are the values of ``lang``, one dictionary set each. The sample is chosen by a
    hash of doc_id, about ``sample_docs`` documents a language (twice that at most).
    """
    own = labelled.select("doc_id", "text", "lang").where("text is not null and lang is not null and text <> ''")
    sizes = sorted(((n, lang) for lang, n in own.groupBy("lang").count().collect()), key=lambda x: (-x[0], x[1]))
    span = 1 << 30
    share = F.lit(0)
    for n, lang in sizes:
        share = F.when(F.col("lang") == lang, int(span * min(1.0, sample_docs / n))).otherwise(share)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(span))
    rows = own.where(place < share).select("lang", place.alias("p"), F.substring("text", 1, SAMPLE_CHARS).alias("t"))
    rows = rows.limit(2 * sample_docs * max(1, len(sizes)))
    texts: dict[str, list[str]] = {lang: [] for _, lang in sizes}
    for lang, _, text in sorted(rows.collect()):
        texts[lang].append(text)
    contents = [
        [letters("\n".join(texts[lang][k::DICTIONARIES]) or lang)[-DICTIONARY_BYTES:].rjust(8) for k in range(DICTIONARIES)]
        for _, lang in sizes
    ]
    return Model([lang for _, lang in sizes], contents)


def letters(text: str) -> bytes:
    """The words of a text: neither case nor punctuation, digits or spacing tell languages apart."""
    return " ".join(_words(text.lower())).encode()


def word_blocks(text: str) -> Iterator[bytes]:
    """``letters(text)`` in blocks of BLOCK_BYTES, made from parts that end at a space if there is one."""
    held, begun, inside, at = b"", False, False, 0
    while at < len(text):
        end = at + PART_CHARS
        space = _SPACE.search(text, end, end + PART_CHARS)
        end = space.end() if space else _MARKS.match(text, min(end, len(text))).end()
        part = text[at:end].lower()
        words = " ".join(_words(part)).encode()
        if words:
            held += words if not begun or inside and _ALL_LETTERS.match(part) else b" " + words
            begun = True
        inside, at = bool(_WORD_END.search(part[-64:])), end
        full = len(held) - len(held) % BLOCK_BYTES
        yield from (held[k : k + BLOCK_BYTES] for k in range(0, full, BLOCK_BYTES))
        held = held[full:]
    if held:
        yield held


def classify(text: str | None, compressors: list, languages: list[str]) -> tuple[str, float, bool]:
    """(language, score, rejected) of one text; ``und`` without a letter or without any language."""
    blocks = word_blocks(text) if text is not None and languages else iter(())
    first = next(blocks, b"")
    if not first:
        return UNKNOWN, 0.0, True
    total = 0
    if len(first) < SHORT_BYTES:
        total = len(first)
        sizes = [sum(len(c.compress(pad + first)) - alone for c, pad, alone in own) for own in compressors]
    else:
        sizes = [0] * len(compressors)
        for b in chain([first], blocks):
            total += len(b)
            for k, own in enumerate(compressors):
                sizes[k] += sum(len(c.compress(b)) for c, _, _ in own)
    ranked = sorted(range(len(sizes)), key=lambda k: (sizes[k], k))
    if len(ranked) == 1:
        return languages[0], 1.0, False
    best, second = sizes[ranked[0]], sizes[ranked[1]]
    margin = min(1.0, (second - best) / max(second, total / 4, 1))
    return languages[ranked[0]], margin, margin < MIN_MARGIN


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) for each row of ``docs`` (doc_id, text).

    A null text, an empty one and one without a letter give ``und``, score 0 and are rejected.
    Equal sizes go to the language with more training rows and are rejected. A table without
    labelled rows gives ``und`` throughout. Repeated rows stay, other columns are ignored.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = model.compressors()

        def rows():
            for batch in batches:
                for doc_id, text in zip(*columns_of(batch, "doc_id", "text"), strict=True):
                    yield doc_id, *classify(text, made, model.languages)

        return in_pieces(rows(), _OUT)

    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return own.mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose text is not rejected, with all their columns."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = model.compressors()
        for batch in batches:
            (texts,) = columns_of(batch, "text")
            yield batch.filter(pa.array([not classify(t, made, model.languages)[2] for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    """The contract's digest: all ``documents``, learned from those that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs.where(~held_out_column()))
    found = identify(docs, model)
    return found.select("doc_id", held_out_column().alias("held_out"), "lang_pred", "score", "rejected")
