"""64-bit hashes of byte ranges of a text, by numpy prefix sums.

The hash of a range is a polynomial over random byte values, so it does not
depend on where the range stands, and all ranges of a text cost a few
vector operations.
"""

from __future__ import annotations

import functools

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(20240613).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Bytes hashed at once; longer texts go in overlapping pieces.
PIECE = 1 << 17


@functools.lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.cumprod(np.full(size, _BASE, np.uint64))
    down = np.cumprod(np.full(size, pow(_BASE, -1, 1 << 64), np.uint64))
    return up, down


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser: every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def range_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``data[start:end]`` for each pair."""
    size = PIECE * 2
    while size < len(data):
        size *= 2
    up, down = _powers(size)
    a = np.frombuffer(data, np.uint8)
    sums = np.empty(len(a) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTES[a] * up[:len(a)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


_PLAIN = bytes(32 if 9 <= c <= 13 else c + 32 if 65 <= c <= 90 else c for c in range(256))


def single_spaced(text: bytes) -> bytes:
    """A-Z lower-cased, runs of white space as one space, none at the ends."""
    return b" ".join(text.translate(_PLAIN).split())


def _spans(data: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    gaps = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    starts, ends = np.append(0, gaps + 1), np.append(gaps, len(data))
    if len(starts) < width:
        return starts[:1], ends[-1:]
    return starts[:len(starts) - width + 1], ends[width - 1:]


def shingles(text: bytes, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of all ``width``-word shingles (words are what
    stands between ASCII white space; A-Z lower-cased).  A text of fewer words
    has its whole sequence as one shingle, a text without words none.

    Long texts are hashed in pieces that overlap by ``width - 1`` words."""
    data = single_spaced(text)
    if not data:
        return np.empty(0, np.uint64)
    found, at = [], 0
    while True:
        end = data.find(b" ", at + PIECE)
        back = end
        for _ in range(width - 1):
            back = data.rfind(b" ", at, back) if back > at else -1
        if end < 0 or back < 0:  # the last piece, or words too long to cut here
            end = back = len(data)
        piece = data[at:end]
        found.append(np.unique(range_hashes(piece, *_spans(piece, width))))
        if end == len(data):
            return found[0] if len(found) == 1 else np.unique(np.concatenate(found))
        at = back + 1


_WORD = np.array([c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 for c in range(256)])
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of the words of a text, in order: runs of ASCII letters (A-Z
    lower-cased), digits and bytes outside ASCII.  Long texts go in pieces cut
    between words."""
    data, found, at = text.translate(_LOWER), [], 0
    while at < len(data):
        piece = data[at:at + PIECE]
        inside = _WORD[np.frombuffer(piece, np.uint8)]
        if at + len(piece) < len(data):
            gaps = np.flatnonzero(~inside)
            if not len(gaps):  # one word fills the piece: take the text up to its end
                rest = np.flatnonzero(~_WORD[np.frombuffer(data, np.uint8, offset=at)])
                piece = data[at:at + int(rest[0])] if len(rest) else data[at:]
                inside = np.ones(len(piece), bool)
            else:
                piece, inside = piece[:int(gaps[-1]) + 1], inside[:int(gaps[-1]) + 1]
        at += len(piece)
        edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
        found.append(range_hashes(piece, np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)))
    return np.concatenate([np.empty(0, np.uint64), *found])
