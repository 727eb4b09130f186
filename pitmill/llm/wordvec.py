"""Word hashes of many texts at once, in numpy.

A word is a maximal run of word bytes: ASCII letters and digits and every byte of a character
beyond ASCII. Hashes are polynomials over the bytes modulo 2**64, finished by a mixing step; equal
words have equal hashes everywhere. Texts are cut into pieces at separators, so that the arrays
stay small however long a text is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

PIECE = 1 << 20
_BASE = 0x9E3779B97F4A7C15
WORD = np.zeros(256, bool)
WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_SPACED = bytes(x if WORD[x] else 32 for x in range(256))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_powers: list[np.ndarray] = []


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each."""
    if not _powers or len(_powers[0]) < n:
        n = max(n, PIECE + 4096)
        inverse = pow(_BASE, -1, 1 << 64)
        _powers[:] = [np.cumprod(np.append(np.uint64(1), np.full(n - 1, b, np.uint64))) for b in (_BASE, inverse)]
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """The finishing step of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spaced(text: bytes) -> bytes:
    """The text with a space for each byte that is no part of a word."""
    return text.translate(_SPACED)


def _cut(text: bytes) -> Iterator[bytes]:
    """Pieces of a long text, cut at separators."""
    at = 0
    while len(text) - at > PIECE:
        end = at + PIECE
        while end < len(text) and WORD[text[end]]:
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def batches(texts: list[bytes]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Pieces of about ``PIECE`` bytes together, each with the index of its text, in order."""
    own, held, size = [], [], 0
    for i, text in enumerate(texts):
        for piece in _cut(text or b""):
            if held and size + len(piece) > PIECE:
                yield own, held
                own, held, size = [], [], 0
            own.append(i)
            held.append(piece)
            size += len(piece) + 1
    if held:
        yield own, held


def hashes(pieces: list[bytes], prefix: int = 0, suffix: int = 0, places: bool = False) -> tuple[np.ndarray, ...]:
    """(hash of each word, index of its piece), and with ``prefix`` or ``suffix`` the hash of so many first or last bytes of each; with ``places`` where each word begins and ends in the pieces, joined by one byte. A-Z count as a-z."""
    raw = b"\n".join([*pieces, b""])
    data = _LOWER[np.frombuffer(raw, np.uint8)]
    step = np.diff(WORD[data].astype(np.int8), prepend=np.int8(0))
    begin, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    power, inverse = _power(len(data) + 1)
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=total[1:])
    first = np.cumsum(np.fromiter((len(p) + 1 for p in pieces), np.int64, len(pieces)))
    own = np.searchsorted(first, begin, "right")
    out = [mix((total[end] - total[begin]) * inverse[begin]), own]
    if prefix:
        out.append(mix((total[np.minimum(end, begin + prefix)] - total[begin]) * inverse[begin]))
    if suffix:
        tail = np.maximum(begin, end - suffix)
        out.append(mix((total[end] - total[tail]) * inverse[tail]))
    if places:
        out += [begin, end]
    return tuple(out)


def text_words(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """The word hashes of each text, whole, in order."""
    parts: dict[int, list[np.ndarray]] = {}
    last = -1
    for own, pieces in batches(texts):
        word, piece = hashes(pieces)
        cuts = np.searchsorted(piece, np.arange(len(pieces) + 1))
        for k, i in enumerate(own):
            if i != last and last >= 0:
                yield last, np.concatenate(parts.pop(last))
            last = i
            parts.setdefault(i, []).append(word[cuts[k] : cuts[k + 1]])
    if last >= 0:
        yield last, np.concatenate(parts.pop(last))


def word_hash(word: str) -> int:
    """The hash of one word, as ``hashes`` gives it."""
    return int(hashes([word.encode()])[0][0])
