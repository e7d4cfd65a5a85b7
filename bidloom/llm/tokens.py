"""Words of whole texts as numpy arrays: positions and 64-bit hashes, computed for many texts at once."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np

# Characters that are worked on at once, apart from single words that are longer.
PIECE = 1 << 20
# Odd multipliers of the hashes.
_BASE = 0x9E3779B97F4A7C15
_MIX = 0xBF58476D1CE4E5B9

# Signs that end a sentence or a line, by code point; and those that may stand inside a number.
STOPS = "\n!.:?\u2026\u3002\uff01\uff1f"
POINTS = ",."
_TOP, _SCANNED = 0x110000, 0x20000


@cache
def _signs() -> tuple[np.ndarray, ...]:
    """By code point: digit (ASCII), letter (Unicode letters, marks and other numerals), capital, stop, lower case."""
    digit, letter, capital, stop = (np.zeros(_TOP, bool) for _ in range(4))
    lower = np.arange(_TOP, dtype=np.uint32)
    for code in range(_SCANNED):
        sign = chr(code)
        kind = unicodedata.category(sign)
        letter[code], capital[code] = kind[0] in "LMN", kind in ("Lu", "Lt")
        small = sign.lower()
        if capital[code] and len(small) == 1:
            lower[code] = ord(small)
    # Beyond the scanned planes lie ideographs.
    letter[_SCANNED:0xE0000] = True
    digit[48:58], letter[48:58] = True, False
    stop[[ord(s) for s in STOPS]] = True
    return digit, letter, capital, stop, lower


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if len(_powers[0]) < n:
        for at, base in ((0, _BASE), (1, pow(_BASE, -1, 1 << 64))):
            factors = np.full(n, base, np.uint64)
            factors[0] = 1
            _powers[at] = np.cumprod(factors)
    return _powers[0], _powers[1]


def mixed(hashes: np.ndarray) -> np.ndarray:
    out = hashes ^ (hashes >> np.uint64(31))
    out = out * np.uint64(_MIX)
    return out ^ (out >> np.uint64(29))


@dataclass
class Words:
    """Words in reading order: runs of Unicode letters, marks and numerals, so quotes, dashes and any blanks end them.

    `doc`: index of the text; `initial`: first letter is a capital; `after_stop`: first of its text, or a sentence end
    or line end stands before it; `number`: ASCII digits, with inner points or commas only; `line`: number of its line.
    """

    doc: np.ndarray
    code: np.ndarray
    number: np.ndarray
    initial: np.ndarray
    after_stop: np.ndarray
    line: np.ndarray


def _pieces(text: str) -> Iterator[str]:
    """The text in parts of about PIECE characters that end at white space."""
    at = 0
    while len(text) - at > PIECE:
        cut = max(text.rfind(" ", at, at + PIECE), text.rfind("\n", at, at + PIECE))
        if cut <= at:
            later = [p for p in (text.find(" ", at + PIECE), text.find("\n", at + PIECE)) if p >= 0]
            cut = min(later) if later else len(text)
        yield text[at:cut]
        at = cut
    yield text[at:]


def _words_of(buffer: str, bounds: np.ndarray, docs: np.ndarray) -> Words:
    """Words of texts that lie in one buffer; bounds are their starts, docs their numbers."""
    raw = np.frombuffer(buffer.encode("utf-32-le", "replace"), np.uint32)
    digits, letters_, capitals, stops_, lower = _signs()
    digit, letter = digits[raw], letters_[raw]
    token = digit | letter
    inner = np.zeros(len(raw), bool)
    inner[1:-1] = ((raw[1:-1] == ord(POINTS[0])) | (raw[1:-1] == ord(POINTS[1]))) & digit[:-2] & digit[2:]
    token |= inner
    edge = np.flatnonzero(np.diff(np.concatenate(([0], token.view(np.int8), [0]))))
    start, end = edge[0::2], edge[1::2]
    power, inverse = _power_tables(len(raw) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((lower[raw].astype(np.uint64) + np.uint64(1)) * power[:len(raw)])))
    code = mixed((sums[end] - sums[start]) * inverse[start])
    letters = np.concatenate(([0], np.cumsum(letter)))
    stops = np.concatenate(([0], np.cumsum(stops_[raw] & ~inner)))
    before = np.concatenate(([0], end[:-1]))
    which = np.searchsorted(bounds, start, side="right") - 1
    first = np.ones(len(start), bool)
    first[1:] = which[1:] != which[:-1]
    lines = np.cumsum(raw == 10)
    after = first | (stops[start] > stops[before])
    return Words(docs[which], code, letters[end] == letters[start], capitals[raw[start]], after, lines[start])


def words(texts: Iterable[str | None]) -> Iterator[Words]:
    """Words of all texts, several texts at a time, a text never split. Null has none. Numbers count from 0."""
    parts: list[str] = []
    numbers: list[int] = []
    size = 0

    def flush() -> Words:
        starts = np.cumsum([0] + [len(p) + 1 for p in parts[:-1]])
        return _words_of("\n".join(parts), starts, np.array(numbers))

    for number, text in enumerate(texts):
        data = text or ""
        if len(data) > PIECE:
            found, lines = [], 0
            for piece in _pieces(data):
                if piece:
                    part = _words_of(piece, np.zeros(1, np.int64), np.array([number]))
                    part.line += lines
                    lines += piece.count("\n")
                    found.append(part)
            for later in found[1:]:
                later.after_stop[:1] = False
            yield Words(*[np.concatenate([getattr(w, f) for w in found]) for f in Words.__dataclass_fields__])
            continue
        parts.append(data)
        numbers.append(number)
        size += len(data) + 1
        if size >= PIECE:
            yield flush()
            parts, numbers, size = [], [], 0
    if parts:
        yield flush()
