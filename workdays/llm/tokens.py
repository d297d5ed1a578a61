"""Token ids and counts of whole texts, as the tokenizers library gives them.

``Units`` encodes a text through its pieces. Where a line has only plain characters, the pattern of
byte-level pre-tokenizers cuts it, and each new piece is encoded by the library's model; texts of a batch
are cut together, and each of their different pieces is looked up once. Elsewhere a line is cut where a
new piece surely starts (at a single space that a plain character follows), and the library encodes the
units that have other characters. Two generations of short pieces and units are remembered, so a worker's
memory is bounded in bytes.
``spliced`` encodes a huge text in overlapping chunks and joins them where both chunks start
a pre-token at the same place.
"""

from __future__ import annotations

import codecs
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

# A space whose next character is not surely a non-space: the text is not cut there.
_UNSURE = re.compile(r" (?![!-~À-ɏ])")
_CUT = re.compile(r" (?=[!-~À-ɏ])")
# Texts of these characters alone are cut here; in others the library cuts.
_PLAIN = re.compile(r"[ \n!-~À-ÖØ-öø-ɏ]*")
# A line end that is a piece of its own.
_LINE_CUT = re.compile(r"(?<=[!-~À-ɏ])\n(?=[!-~À-ɏ])")
# Fixed value: the pattern of byte-level pre-tokenizers, for the bytes of plain texts. Letters come first, for speed.
_PIECE = re.compile(
    rb"""(?s: ?[A-Za-z\x80-\xff]+|'(?:[stmd]|re|ve|ll)| ?[!-/:-@\[-`{-~]+| ?[0-9]+|\s+(?!\S)|\s+)"""
)
# Classes of bytes: of letters beyond ASCII both bytes; what is no part of plain texts is OTHER.
_LETTER, _DIGIT, _POINT, _SPACE, _LINE_END, _OTHER = range(6)
_CLASS = np.full(256, _OTHER, dtype=np.uint8)
_CLASS[ord("!") : ord("~") + 1] = _POINT
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0xC0), *range(0xC3, 0xCA)]] = _LETTER
_CLASS[ord(" ")], _CLASS[ord("\n")] = _SPACE, _LINE_END
# Bytes of texts that are cut together; a longer text is cut alone.
TOGETHER = 4 << 20
# Pieces remembered by a worker in each of two generations (of units a quarter), and the longest of
# them (bytes or code points): about 200 bytes each, so some 100 MB when all are full.
REMEMBERED = 180_000
LONGEST = 48
# Code points of a text whose units are looked up at a time.
LONG = 1 << 18

_loaded: dict[str, object] = {}


def load(path: str):
    """The tokenizer of a file, once per process; the library's own threads are off."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _loaded:
        from tokenizers import Tokenizer

        _loaded[path] = Tokenizer.from_file(path)
    return _loaded[path]


class Memory(dict):
    """A mapping that makes what it lacks and keeps what was used lately: a full generation becomes the old one."""

    def __init__(self, make: Callable[[str | bytes], bytes], size: int = REMEMBERED):
        super().__init__()
        self.make, self.size = make, size
        self.old: dict[str | bytes, bytes] = {}

    def __missing__(self, key: str | bytes) -> bytes:
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
            if len(key) > LONGEST:
                return found
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = found
        return found


def _byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable bytes are
    themselves, the others take the characters from 256 on in order."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(256 + hidden.index(b)) for b in range(256)]


class Units:
    """Ids of texts, two bytes each (little-endian), through a memory of units.

    Only for byte-pair tokenizers with the byte-level pre-tokenizer and without a normalizer,
    whose ids are under 65,536: ``fits`` says so. A text that holds a special string is encoded
    whole by the library.
    """

    def __init__(self, path: str):
        self.tok = load(path)
        self.model = self.tok.model
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.shown = "".join(_byte_characters())
        self.two = [i.to_bytes(2, "little") for i in range(self.tok.get_vocab_size(with_added_tokens=True))]
        self.pieces = Memory(self._piece)
        self.units = Memory(self._unit, REMEMBERED // 4)
        self.line_end = self._piece(b"\n")

    @staticmethod
    def fits(path: str) -> bool:
        tok = load(path)
        if path not in _fits:
            shape = repr(tok.pre_tokenizer)
            _fits[path] = (
                shape.startswith("ByteLevel(add_prefix_space=False") and "use_regex=True" in shape
                and type(tok.model).__name__ == "BPE" and tok.normalizer is None and tok.get_vocab_size() < 65536
            )
        return _fits[path]

    def whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype="<u2").tobytes()

    def _piece(self, piece: bytes) -> bytes:
        two = self.two
        return b"".join([two[t.id] for t in self.model.tokenize(codecs.charmap_decode(piece, "strict", self.shown)[0])])

    def _unit(self, unit: str) -> bytes:
        return self._plain(unit) if _PLAIN.fullmatch(unit) else self.whole(unit)

    def _plain(self, text: str) -> bytes:
        pieces = self.pieces
        return b"".join([pieces[p] for p in _PIECE.findall(text.encode())])

    def ids(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self.whole(text)
        if len(text) <= LONG:
            return self._ids(text)
        made, at = [], 0
        while at < len(text):  # a long text goes in parts that end where it is cut anyway
            cut = _CUT.search(text, at + LONG)
            end = cut.start() if cut else len(text)
            made.append(self._ids(text[at:end]))
            at = end
        return b"".join(made)

    def _ids(self, text: str) -> bytes:
        if "\n" not in text:
            return self._line(text)
        return self.line_end.join([self._line(x) for x in _LINE_CUT.split(text)])

    def _line(self, text: str) -> bytes:
        if _PLAIN.fullmatch(text):
            return self._plain(text)
        first, *rest = text.split(" ") if not _UNSURE.search(text) else _CUT.split(text)
        units = self.units
        return units[first] + b"".join([units[" " + u] for u in rest])

    def many(self, texts: pa.Array) -> list[bytes]:
        """``ids`` of each of the texts (no nulls)."""
        texts = texts.cast(pa.large_string())
        ends = np.frombuffer(texts.buffers()[1], "<i8")[texts.offset : texts.offset + len(texts) + 1]
        data = memoryview(texts.buffers()[2] or b"")
        made: list[bytes | None] = [None] * len(texts)
        at = 0
        while at < len(texts):
            end = max(at + 1, int(np.searchsorted(ends, ends[at] + TOGETHER, side="right")) - 1)
            if ends[end] - ends[at] <= TOGETHER:
                self._together(data[ends[at] : ends[end]], ends[at:end] - ends[at], made, at)
            at = end
        return [self.ids(texts[i].as_py()) if m is None else m for i, m in enumerate(made)]

    def _together(self, text: memoryview, starts: np.ndarray, made: list[bytes | None], first: int) -> None:
        """Put the ids of the plain ones of some texts, which stand one after the other, into ``made`` from ``first`` on."""
        raw = np.frombuffer(text, np.uint8)
        other = np.flatnonzero(_CLASS[raw] == _OTHER)
        for lead, low, high in ((0xC3, 0x97, 0x97), (0xC3, 0xB7, 0xB7), (0xC9, 0x90, 0xBF)):  # no letters, or beyond them
            lead = np.flatnonzero(raw[:-1] == lead)
            other = np.append(other, lead[(raw[lead + 1] >= low) & (raw[lead + 1] <= high)])
        plain = np.ones(len(starts), dtype=bool)
        plain[np.searchsorted(starts, other, side="right") - 1] = False
        ends = np.append(starts[1:], len(raw))
        body = bytes(text)
        for s in self.special:
            if (word := s.encode()) in body:
                plain &= [word not in body[a:b] for a, b in zip(starts, ends, strict=True)]
        own = np.flatnonzero(plain)
        if len(own) < len(starts):
            body = b"".join([body[starts[i] : ends[i]] for i in own])
        sizes = (ends - starts)[own]
        starts = np.cumsum(sizes) - sizes
        cuts = _cuts(np.frombuffer(body, np.uint8), starts[starts < len(body)])
        at = np.append(cuts, len(body)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(at), pa.py_buffer(body)]).dictionary_encode()
        different, memory = pieces.dictionary, self.pieces
        begin = np.frombuffer(different.buffers()[1], "<i4")[: len(different) + 1].tolist()
        own_bytes = bytes(different.buffers()[2] or b"")
        found = [memory[own_bytes[a:b]] for a, b in zip(begin, begin[1:])]  # noqa: B905
        found = pa.array(found, pa.large_binary()).take(pieces.indices)
        ids = bytes(found.buffers()[2] or b"")
        to = np.frombuffer(found.buffers()[1], "<i8")[: len(found) + 1] if len(found) else np.zeros(1, np.int64)
        to = to[np.append(np.searchsorted(cuts, starts), len(cuts))]
        for i, a, b in zip(own, to[:-1], to[1:], strict=True):
            made[first + i] = ids[a:b]


def _cuts(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where the pieces (``_PIECE``) of plain texts start that stand one after the other, from ``starts`` on."""
    if not len(raw):
        return np.zeros(0, dtype=np.int64)
    kind = _CLASS[raw]
    blank = kind >= _SPACE
    head = np.zeros(len(raw), dtype=bool)
    head[starts] = True
    cut = np.empty(len(raw), dtype=bool)
    # a new class starts a piece, but for what stands behind a space, which belongs to the piece
    cut[1:] = (kind[1:] != kind[:-1]) & (kind[:-1] != _SPACE)
    # of several blanks the last is apart if another character of the text follows; the others are one piece
    cut[1:] &= ~(blank[1:] & blank[:-1])
    cut[:-1] |= blank[:-1] & ~blank[1:] & ~head[1:]
    cut[starts] = True
    # an apostrophe that starts a piece takes some endings with it
    mark = np.flatnonzero(raw == ord("'"))
    mark = mark[cut[mark]]
    last = np.append(starts[1:], len(raw))[np.searchsorted(starts, mark, side="right") - 1]
    one, two = (raw[np.minimum(mark + k, len(raw) - 1)] for k in (1, 2))
    short = (mark + 1 < last) & np.isin(one, list(b"stmd"))
    pair = [(one == a) & (two == b) for a, b in (b"re", b"ve", b"ll")]
    long = (mark + 2 < last) & np.logical_or.reduce(pair)
    cut[mark[short | long] + 1] = False
    behind = np.where(short, mark + 2, mark + 3)[short | long]
    cut[behind[behind < last[short | long]]] = True
    return np.flatnonzero(cut)


_fits: dict[str, bool] = {}
_units: dict[str, Units] = {}


def units(path: str) -> Units:
    if path not in _units:
        _units[path] = Units(path)
    return _units[path]


# -- overlap resynchronisation -------------------------------------------------------------


def _starts(encoding) -> dict[int, int]:
    """Start of each pre-token (code points in the chunk) -> index of its first token."""
    found: dict[int, int] = {}
    last = None
    for i, (word, (start, _)) in enumerate(zip(encoding.word_ids, encoding.offsets, strict=True)):
        if word is None or word != last:
            found.setdefault(start, i)
        last = word
    return found


def spliced(
    text: str,
    tok,
    chunk: int = 16_384,
    overlap: int = 256,
    margin: int = 64,
    on_join: Callable[[int, int], None] | None = None,
) -> Iterator[list[int]]:
    """Token ids of ``text`` in parts, from chunks of ``chunk`` code points that overlap.

    Two neighbouring chunks are joined at a place where both start a pre-token. The left chunk
    splits as the whole text does up to its last ``margin`` code points (a pre-token looks one
    character ahead, a special string is shorter than the margin), and a split that starts at a
    true start stays true, so the right chunk is right from there on. Where no common start
    lies between the margins, the overlap is doubled, to the whole rest if need be.
    ``on_join`` gets the place and the overlap that was needed.
    """
    at = 0  # every token before this place is out; a pre-token starts here
    while at < len(text):
        end = min(len(text), at + chunk)
        here = tok.encode(text[at:end], add_special_tokens=False)
        width = overlap
        while end < len(text):
            # the last chunk boundary that the next chunk confirms
            begin = max(at, end - width)
            ahead = text[begin : min(len(text), end + width)]
            mine, theirs = _starts(here), _starts(tok.encode(ahead, add_special_tokens=False))
            low, high = begin + (margin if begin > at else 0), end - margin
            common = [p for p in mine if p and low <= at + p <= high and at + p - begin in theirs]
            if common:
                cut = max(common)
                yield here.ids[: mine[cut]]
                if on_join:
                    on_join(at + cut, width)
                at += cut
                break
            width *= 2
            if width > end - at:  # the whole chunk holds no common start: lengthen the chunk
                end = min(len(text), at + 2 * (end - at))
                here = tok.encode(text[at:end], add_special_tokens=False)
                width = overlap
        else:
            yield here.ids
            return
