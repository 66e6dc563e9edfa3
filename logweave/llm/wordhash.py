"""Word hashes with a bounded memory of words seen before."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Words remembered per task.
MEMO_WORDS = 600_000
MASK = (1 << 64) - 1


_memos: dict = {}


def worker_memo(name: str, make):
    """What a Python worker remembers from task to task under ``name``; it keeps one thing only.

    Workers serve one stage after another, so what another stage remembered
    is let go.
    """
    if name not in _memos:
        _memos.clear()
        _memos[name] = make()
    return _memos[name]


def forget() -> None:
    """Let go what earlier stages remembered; for stages that remember nothing themselves."""
    _memos.clear()


class WordHashes(dict):
    """``hashes[word]`` is the 64-bit xxh3 of a word (``bytes``), remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def window_hashes(words: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """One 64-bit hash per window of ``width`` consecutive word hashes."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, (seed * 0x9E3779B97F4A7C15 + 1) & MASK, np.uint64)
    for k in range(width):
        out = mix(out ^ words[k:k + n]) + np.uint64(0x9E3779B97F4A7C15)
    return mix(out)


#: Words of more bytes are hashed one by one.
LONG_WORD = 256


def hashes_of(words: pa.Array) -> np.ndarray:
    """64-bit hash of each word (no nulls), eight bytes of all words at a time; nothing is remembered."""
    words = words.cast(pa.large_binary())
    borders = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    if not len(words):
        return np.zeros(0, np.uint64)
    data = np.append(np.frombuffer(words.buffers()[2] or b"", np.uint8)[borders[0]:borders[-1]], np.zeros(8, np.uint8))
    lanes = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    start, size = borders[:-1] - borders[0], np.diff(borders)
    out = mix(size.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    at = np.flatnonzero((size > 0) & (size <= LONG_WORD))
    start, left = start[at], size[at]
    while len(at):
        lane = lanes[start]
        lane &= np.uint64(MASK) >> (64 - 8 * np.minimum(left, 8)).astype(np.uint64)
        out[at] = mix(out[at] ^ lane) + np.uint64(0x9E3779B97F4A7C15)
        more = left > 8
        at, start, left = at[more], start[more] + 8, left[more] - 8
    for k in np.flatnonzero(size > LONG_WORD).tolist():
        out[k] = xxhash.xxh3_64_intdigest(words[k].as_py())
    return out


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words between ASCII blanks of all texts, one after another, and how many each text has.

    A null has no words.
    """
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    coded = pc.dictionary_encode(split.flatten())
    at = coded.indices.to_numpy()
    borders = split.offsets.to_numpy() - split.offsets[0].as_py()
    codes = hashes_of(coded.dictionary)[at] if len(at) else np.zeros(0, np.uint64)
    blank = pc.index(coded.dictionary, pa.scalar("", coded.dictionary.type)).as_py()
    if blank >= 0:  # blanks at an end
        real = at != blank
        codes, borders = codes[real], np.append(0, np.cumsum(real))[borders]
    return codes, np.diff(borders)


def coded_words(texts: pa.Array, code_of: dict, dtype=np.int64) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the words between ASCII blanks of all texts, one after another, and how many each text has.

    Each distinct word (``bytes``) is looked up once. A null has no words.
    """
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    coded = pc.dictionary_encode(split.flatten())
    words = coded.dictionary.cast(pa.binary()).to_pylist()
    at = coded.indices.to_numpy()
    borders = split.offsets.to_numpy() - split.offsets[0].as_py()
    codes = np.fromiter(map(code_of.__getitem__, words), dtype, len(words))[at] if words else np.zeros(0, dtype)
    if b"" in words:  # blanks at an end
        real = at != words.index(b"")
        codes, borders = codes[real], np.append(0, np.cumsum(real))[borders]
    return codes, np.diff(borders)
