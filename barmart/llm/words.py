"""Words of a text and 64-bit codes of word windows; small helpers that run inside tasks.

A word is a run of characters other than space and U+0009 to U+000D. In UTF-8 these six are single bytes that occur in no
other character, so the split is made on bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

MASK = (1 << 64) - 1
#: Odd multipliers of the two window codes (the golden ratio and the square root of 3, as 64-bit fractions).
STEP = 0x9E3779B97F4A7C15
STEP_2 = 0xBB67AE8584CAA73B
MEMO_WORDS = 500_000
MEMO_BYTES = 48


def words_of(text: str | None) -> list[bytes]:
    """The words of a text; none for null."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def lower_words_of(text: str | None) -> list[bytes]:
    """The words with A-Z lower-cased; other letters stay as they are."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class WordCodes(dict):
    """64-bit code of a word. Holds at most `most` short words, so its memory is bounded."""

    def __init__(self, most: int = MEMO_WORDS) -> None:
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        code = xxhash.xxh3_64_intdigest(word)
        if len(word) <= MEMO_BYTES:
            if len(self) >= self.most:
                self.clear()
            self[word] = code
        return code

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(codes: np.ndarray) -> np.ndarray:
    """Spreads each code over all 64 bits (the finalizer of splitmix64)."""
    z = codes ^ (codes >> np.uint64(30))
    z = z * np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return z


def window_codes(codes: np.ndarray, length: int, step: int = STEP) -> np.ndarray:
    """Code of every window of `length` words: a polynomial in `step` modulo 2^64, from running sums, then mixed."""
    n = len(codes)
    if n < length:
        return np.empty(0, np.uint64)
    inverse = pow(step, -1, 1 << 64)
    down = np.full(n + 1, np.uint64(inverse))
    down[0] = 1
    down = np.multiply.accumulate(down)
    up = np.full(n - length + 1, np.uint64(step))
    up[0] = 1
    up = np.multiply.accumulate(up)
    sums = np.zeros(n + 1, np.uint64)
    np.add.accumulate(codes * down[:n], out=sums[1:])
    return mixed((sums[length:] - sums[:-length]) * up)


#: Bytes of texts whose words are coded at once; arrays of eight bytes for each of them stay in a core's cache.
PIECE_BYTES = 1 << 16
_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
#: The lower-cased byte, plus one so that a leading NUL counts.
_LETTER = np.frombuffer(bytes(range(256)).lower(), np.uint8).astype(np.uint64) + np.uint64(1)


def _powers(base: int) -> np.ndarray:
    """Ascending powers modulo 2^64 for the bytes of a piece. They aren't kept in the module, which is shipped with each task."""
    power = np.full(PIECE_BYTES, np.uint64(base))
    power[0] = 1
    return np.multiply.accumulate(power)


def lower_codes(data: bytes, down: np.ndarray, up: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all words, A-Z lower-cased, and the places where they begin; `down` and `up` hold the powers of STEP_2.

    The code of a word is a polynomial of its bytes modulo 2^64, from running sums, then mixed. Words beyond MEMO_BYTES, for which
    such polynomials are weak, are digested one by one. Beyond PIECE_BYTES the data must be one word.
    """
    if len(data) > PIECE_BYTES:
        return np.array([xxhash.xxh3_64_intdigest(data.lower())], np.uint64), np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)
    edges = np.flatnonzero(np.diff(_SPACE[raw], prepend=True, append=True))
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.add.accumulate(_LETTER[raw] * down[: len(raw)], out=sums[1:])
    codes = mixed((sums[ends] - sums[starts]) * up[starts])
    for i in np.flatnonzero(ends - starts > MEMO_BYTES):
        codes[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].lower())
    return codes, starts


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text cut behind white space into pieces of at most PIECE_BYTES; a longer word is a piece of its own."""
    raw, at = np.frombuffer(text, np.uint8), 0
    while at < len(raw):
        end = min(len(raw), at + PIECE_BYTES)
        if end < len(raw):
            space = np.flatnonzero(_SPACE[raw[at:end]])
            if len(space):
                end = at + int(space[-1]) + 1
            else:
                while end < len(raw) and not (ahead := _SPACE[raw[end : end + PIECE_BYTES]]).any():
                    end = min(len(raw), end + PIECE_BYTES)
                end += int(ahead.argmax()) if end < len(raw) else 0
        yield text[at:end]
        at = end


def shingle_sets(texts: list[bytes | None], length: int = 5) -> list[np.ndarray]:
    """Of each text the sorted distinct codes of the shingles of its words, A-Z lower-cased; the whole sequence is one if there are
    fewer words; empty without words."""
    powers = _powers(pow(STEP_2, -1, 1 << 64)), _powers(STEP_2)
    out, held, size = [], [], 0
    for text in texts:
        text = text or b""
        if held and size + len(text) > PIECE_BYTES:
            out += _shingles(held, length, *powers)
            held, size = [], 0
        held.append(text)
        size += len(text) + 1
    return out + _shingles(held, length, *powers) if held else out


def _shingles(texts: list[bytes], length: int, down: np.ndarray, up: np.ndarray) -> list[np.ndarray]:
    if len(texts) == 1:
        codes = np.concatenate([np.empty(0, np.uint64), *(lower_codes(p, down, up)[0] for p in _pieces(texts[0]))])
        firsts = [0, len(codes)]
    else:
        codes, starts = lower_codes(b"\n".join(texts), down, up)
        begins = np.cumsum([0, *[len(t) + 1 for t in texts]])
        firsts = np.searchsorted(starts, begins)
    windows, out = window_codes(codes, length), []
    for a, b in zip(firsts[:-1], firsts[1:]):
        own = windows[a : b - length + 1] if b - a >= length else window_codes(codes[a:b], b - a) if b > a else codes[:0]
        own = np.sort(own)
        out.append(own[np.diff(own, prepend=own[:1] + np.uint64(1)) != 0])
    return out
