"""Token ids of whole texts, found piece by piece, as a tokenizer file with word ends gives them.

The tokenizer file splits a normalized text into pieces and encodes each alone. Each distinct piece
is therefore encoded once per Python worker, by the model of the ``tokenizers`` library, and then
looked up: about a megabyte of text at a time is cut into pieces, which are found in a table by their
bytes, so that no piece becomes a string but one that is new. Tests hold the result against the
library's own encoding of whole texts.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import regex

from lakeops.llm.common import MOST_REMEMBERED, Memo, mixed

# The pieces that the tokenizer file splits texts into, its white space spelled out.
SPACES = r"\t-\r\x20\x85\xa0  -     　"
PIECES = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{SPACES}\p{{L}}\p{{N}}]+")
ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r\x20a-z0-9]+")
# Blocks with letters that versions of Unicode disagree about; the library itself splits such texts.
ODD = re.compile(
    "[\U00010000-\U0010ffff\u0530-\u058f\u0860-\u08ff\u0c00-\u0dff\u1700-\u171f\u1b00-\u1b7f\u1c80-\u1cff"
    "\u2c00-\u2c5f\u3100-\u31bf\u9fe0-\u9fff\ua7b0-\ua7ff]"
)
WORD_END = "</w>"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def special_tokens(path: str) -> list[dict]:
    with open(path, encoding="utf-8") as file:
        return json.load(file)["added_tokens"]


def byte_letters() -> list[str]:
    """The printable letter of each byte: itself where printable, else the next free code from 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, free = {b: chr(b) for b in printable}, 256
    for byte in range(256):
        if byte not in letters:
            letters[byte] = chr(free)
            free += 1
    return [letters[b] for b in range(256)]


_LETTERS = byte_letters()
_SPELLING = dict(enumerate(_LETTERS))


def spelled(piece: str) -> str:
    return piece if piece.isascii() and piece.isalpha() else "".join(_LETTERS[b] for b in piece.encode())


_BYTES = {letter: byte for byte, letter in enumerate(_LETTERS)}


@lru_cache(maxsize=2)
def _library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def vocabulary_size(path: str) -> int:
    """One more than the largest id."""
    return max(_library(path).get_vocab().values()) + 1


def pieces_of(text: str, path: str) -> list[str]:
    """The normalized pieces of a text without special strings."""
    if text.isascii():
        return ASCII_PIECES.findall(text.lower())
    if ODD.search(text):
        library = _library(path)
        found = library.pre_tokenizer.pre_tokenize_str(library.normalizer.normalize_str(text))
        return [bytes(map(_BYTES.__getitem__, piece)).decode() for piece, _ in found]
    return PIECES.findall(_normalized(text))


BLANK, LETTER, NUMBER, OTHER = range(4)
#: Characters of texts that are cut into pieces at once.
AT_ONCE = 1 << 20
#: Bytes of a piece that is looked up in the table; a longer one is looked up as a string.
MOST_BYTES = 15
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """The kind of each character of the basic plane, as the pieces tell them apart."""
    kinds = np.full(1 << 16, OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 1 << 16)]))
    for kind, pattern in ((BLANK, f"[{SPACES}]"), (LETTER, r"\p{L}"), (NUMBER, r"\p{N}")):
        kinds[[ord(c) for c in regex.findall(pattern, every)]] = kind
    return kinds


def _edges(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces of normalized text, which begins with one blank and ends with three."""
    kinds = _kinds()[codes]
    begins = np.ones(len(codes), bool)
    np.not_equal(kinds[1:], kinds[:-1], out=begins[1:])
    begins |= kinds == NUMBER
    # An ending takes its letters, unless its apostrophe is inside a run of other characters.
    marks = np.flatnonzero(codes == ord("'"))
    marks = marks[kinds[marks - 1] != OTHER]
    first, second = codes[marks + 1], codes[marks + 2]
    short = np.isin(first, [ord(c) for c in "stmd"])
    long = ((first == ord("r")) | (first == ord("v"))) & (second == ord("e"))
    long |= (first == ord("l")) & (second == ord("l"))
    for marked, length in ((marks[short], 2), (marks[long], 3)):
        begins[marked + 1] = False
        begins[marked + length] = True
    edges = np.flatnonzero(begins)
    full = kinds[edges[:-1]] != BLANK
    return edges[:-1][full], edges[1:][full]


class PieceTable:
    """Ids of pieces of few bytes in flat arrays, some 60 bytes a piece: a hash table of whole keys.

    When it is full, pieces that were asked for again since they came, or since it was last full, stay.
    """

    def __init__(self, encode, most: int = MOST_REMEMBERED * 3 // 4):
        self.encode = encode
        self.most_pieces, self.most_ids = max(most // 64, 1), max(most // 16, 1)
        self._reset(*(np.zeros(0, np.uint64) for _ in range(2)), np.zeros(0, np.int64), np.zeros(0, np.uint32))

    def _reset(self, low: np.ndarray, high: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        self.size, self.held = 0, 0
        self.low, self.high = np.zeros(1024, np.uint64), np.zeros(1024, np.uint64)
        self.first, self.counts, self.asked = np.zeros(1024, np.int32), np.zeros(1024, np.int32), np.zeros(1024, bool)
        self.ids = np.zeros(4096, np.uint32)
        self.slots = np.full(4096, -1, np.int32)
        self._add(low, high, counts, ids)

    def _slot(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return (mixed(low ^ mixed(high)) & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def _place(self, entries: np.ndarray) -> None:
        """Put entries, of keys that are not there, into the next free slots from their own on."""
        slot = self._slot(self.low[entries], self.high[entries])
        while len(entries):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = entries[free]
            left = self.slots[slot] != entries
            entries, slot = entries[left], (slot[left] + 1) & (len(self.slots) - 1)

    def _add(self, low: np.ndarray, high: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        size, held = self.size + len(low), self.held + len(ids)

        def grown(values: np.ndarray, length: int) -> np.ndarray:
            return values if length <= len(values) else np.resize(values, max(length, 3 * len(values) // 2))

        for name in ("low", "high", "first", "counts", "asked"):
            setattr(self, name, grown(getattr(self, name), size))
        self.ids = grown(self.ids, held)
        new = slice(self.size, size)
        self.low[new], self.high[new], self.counts[new], self.asked[new] = low, high, counts, False
        self.first[new] = self.held + np.cumsum(counts) - counts
        self.ids[self.held : held] = ids
        entries = np.arange(self.size, size, dtype=np.int32)
        self.size, self.held = size, held
        if 2 * size > len(self.slots):
            self.slots = np.full(1 << (4 * size - 1).bit_length(), -1, np.int32)
            entries = np.arange(size, dtype=np.int32)
        self._place(entries)

    def _make_room(self) -> None:
        """Forget pieces not asked for again; all, if those that were are more than half of what may stay."""
        stay = np.flatnonzero(self.asked[: self.size])
        if 2 * len(stay) > self.most_pieces or 2 * int(self.counts[stay].sum()) > self.most_ids:
            stay = stay[:0]
        counts = self.counts[stay].astype(np.int64)
        ids = self.ids[spans(self.first[stay].astype(np.int64), counts)]
        self._reset(self.low[stay], self.high[stay], counts, ids)

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The entry of each key, -1 if it has none."""
        found = np.full(len(low), -1, np.int32)
        at, slot = np.arange(len(low)), self._slot(low, high)
        while len(at):
            entry = self.slots[slot]
            same = (self.low[entry] == low) & (self.high[entry] == high) & (entry >= 0)
            found[at[same]] = entry[same]
            left = (entry >= 0) & ~same
            at, low, high = at[left], low[left], high[left]
            slot = (slot[left] + 1) & (len(self.slots) - 1)
        return found

    def entries(self, low: np.ndarray, high: np.ndarray, spelled_out) -> np.ndarray:
        """The entry of each key; ``spelled_out`` gives the pieces of some places, for those that are new."""
        if self.size > self.most_pieces or self.held > self.most_ids:
            self._make_room()
        found = self.find(low, high)
        missing = np.flatnonzero(found < 0)
        self.asked[found if not len(missing) else found[found >= 0]] = True
        if len(missing):
            new = dict(zip(spelled_out(missing), missing.tolist()))
            parts = self.encode(new)
            places = np.fromiter(new.values(), np.int64, len(new))
            counts = np.fromiter(map(len, parts), np.int64, len(parts))
            self._add(low[places], high[places], counts, np.fromiter(chain.from_iterable(parts), np.uint32, counts.sum()))
            found[missing] = self.find(low[missing], high[missing])
        return found


def spans(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers of each span, one span after the other."""
    return np.arange(counts.sum()) + np.repeat(first - (np.cumsum(counts) - counts), counts)


def chunks(texts: Sequence[str]) -> Iterator[tuple[list[int], str]]:
    """Texts behind one blank each, ``AT_ONCE`` characters at a time, and the places of the blanks."""
    places, some, size = [], [], 0
    for text in texts:
        if some and size + len(text) >= AT_ONCE:
            yield places, "".join(some)
            places, some, size = [], [], 0
        places.append(size)
        some += " ", text
        size += len(text) + 1
    if some:
        yield places, "".join(some)


def _parts(text: str) -> list[str]:
    """A text in parts of ``AT_ONCE`` characters or little more, which end at a blank of ASCII."""
    parts, first = [], 0
    while len(text) - first > AT_ONCE:
        blank = _ASCII_BLANK.search(text, first + AT_ONCE)
        if blank is None:
            break
        parts.append(text[first : blank.start()])
        first = blank.start()
    return [*parts, text[first:]]


_ASCII_BLANK = re.compile(r"[\t-\r\x20]")


def _normalized(text: str) -> str:
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFC", text)
    # A capital sigma is lowered without regard to its place in the word.
    return "".join(c.lower() for c in text) if "Σ" in text else text.lower()


class WordTokenizer:
    def __init__(self, path: str, most: int = MOST_REMEMBERED):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.path = path
        self.model = _library(path).model
        self.special = {t["content"]: array("I", [t["id"]]).tobytes() for t in special_tokens(path)}
        self.table = PieceTable(self._encoded, most * 3 // 4)
        self.pieces = Memo(self._piece, most // 4)

    def _piece(self, piece: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(spelled(piece))]).tobytes()

    def _encoded(self, pieces: Iterable[bytes]) -> list[list[int]]:
        tokenize = self.model.tokenize
        spelling = (p.decode() if p.isalpha() else p.decode("latin-1").translate(_SPELLING) for p in pieces)
        return [[t.id for t in tokenize(piece)] for piece in spelling]

    def ids(self, text: str | None) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit numbers."""
        return self.ids_of([text])[0]

    def ids_of(self, texts: Sequence[str | None]) -> list[bytes]:
        """The ids of each text."""
        found: list[list[bytes]] = [[] for _ in texts]
        # ASCII is cut as bytes; the places of other characters are not those of their bytes.
        plain: tuple[list, list] = ([], [])
        for number, text in enumerate(texts):
            for part in self._cut(text or ""):
                if isinstance(part, bytes):
                    found[number].append(part)
                elif part:
                    found[number].append(b"")
                    plain[part.isascii()].append((number, len(found[number]) - 1, _normalized(part)))
        for some in plain:
            done = 0
            for places, joined in chunks([text for _, _, text in some]):
                for (number, place, _), ids in zip(some[done : done + len(places)], self._chunk(places, joined)):
                    found[number][place] = ids
                done += len(places)
        return [b"".join(parts) if len(parts) != 1 else parts[0] for parts in found]

    def _cut(self, text: str) -> list[bytes | str]:
        """Parts of a text in their order: ids where they are known, texts where they are not."""
        if "<|" in text:
            for special, number in self.special.items():
                if special in text:
                    parts = [self._cut(part) for part in text.split(special)]
                    return [*parts[0], *(p for part in parts[1:] for p in (number, *part))]
        if not text.isascii() and ODD.search(text):
            return [b"".join(map(self.pieces.__getitem__, pieces_of(text, self.path)))]
        return _parts(text)

    def _chunk(self, places: list[int], joined: str) -> Iterator[bytes]:
        """The ids of the texts behind the blanks at the given places."""
        raw = f"{joined}   ".encode()
        data = np.frombuffer(raw + bytes(16), np.uint8)
        codes = data[: len(raw)]
        if not joined.isascii():
            codes = np.frombuffer(f"{joined}   ".encode("utf-16-le"), np.uint16)
        starts, ends = _edges(codes)
        texts = np.searchsorted(starts, np.array([*places, len(codes)]))
        if len(codes) != len(raw):
            offsets = np.zeros(len(codes) + 1, np.int64)
            np.cumsum(1 + (codes >= 0x80) + (codes >= 0x800).astype(np.int8), out=offsets[1:])
            starts, ends = offsets[starts], offsets[ends]
        lengths = ends - starts
        words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
        low = words[starts] & _MASKS[np.minimum(lengths, 8)]
        high = words[starts + 8] & _MASKS[np.clip(lengths - 8, 0, 7)]
        high |= np.minimum(lengths, MOST_BYTES).astype(np.uint64) << np.uint64(56)
        long = np.flatnonzero(lengths > MOST_BYTES)
        # Any short piece stands in for a long one, whose ids are put into its place.
        low[long], high[long] = words[0] & _MASKS[1], np.uint64(1 << 56)

        def cut(some: np.ndarray) -> list[bytes]:
            return [raw[begin:end] for begin, end in zip(starts[some].tolist(), ends[some].tolist())]

        def spelled_out(some: np.ndarray) -> list[bytes]:
            return [b" " if len(piece) > MOST_BYTES else piece for piece in cut(some)]

        entries = self.table.entries(low, high, spelled_out)
        counts = self.table.counts[entries].astype(np.int64)
        first = self.table.first[entries].astype(np.int64)
        given = [self.pieces[piece.decode()] for piece in cut(long)]
        counts[long] = [len(ids) // 4 for ids in given]
        first[long] = 0
        at = np.concatenate(([0], np.cumsum(counts)))
        ids = self.table.ids.take(spans(first, counts), mode="clip")
        for place, part in zip(long.tolist(), given):
            ids[at[place] : at[place + 1]] = np.frombuffer(part, np.uint32)
        ids, cuts = ids.astype("<u4").tobytes(), (4 * at[texts]).tolist()
        for begin, end in zip(cuts[:-1], cuts[1:]):
            yield ids[begin:end]


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    """One per Python worker, so that its pieces outlive a task."""
    return WordTokenizer(path)
