"""Words and word shingles of whole Arrow batches as arrays of 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are hashed at a time, which takes some fifty times as much
#: memory; longer texts are cut at white space.
SLICE = 1 << 18

_RNG = np.random.default_rng(20240101)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACE = _RNG.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_POWERS = _powers(256)


def word_hashes(data: np.ndarray) -> np.ndarray:
    """A hash for each word ``[^\\x20\\x09-\\x0D]+`` of UTF-8 bytes, A-Z as a-z."""
    inside = ~_SPACE[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    at = np.flatnonzero(starts)
    if not len(at):
        return np.empty(0, np.uint64)
    data, inside, at = data[at[0] :], inside[at[0] :], at - at[0]
    gaps = np.diff(np.append(at, len(data)))
    place = np.arange(len(data)) - np.repeat(at, gaps)
    powers = _POWERS if (most := int(gaps.max())) <= len(_POWERS) else _powers(most)
    value = _BYTE[data] * powers[place]
    value[~inside] = 0
    return mixed(np.add.reduceat(value, at))


def _cuts(data: np.ndarray) -> Iterator[np.ndarray]:
    """Pieces of about SLICE bytes that end at white space."""
    at = 0
    while len(data) - at > SLICE:
        end = at + SLICE
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        yield data[at:end]
        at = end
    yield data[at:]


def documents_words(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes of the words, their numbers by row) for runs of rows;
    null is an empty text."""
    texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
    n = len(texts)
    if not n:
        return
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    raw = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.empty(0, np.uint8)
    lengths = np.diff(at)
    if texts.null_count:
        lengths = np.where(np.asarray(texts.is_valid()), lengths, 0)
    row = 0
    while row < n:
        end, total = row, 0
        while end < n and (end == row or total + lengths[end] <= SLICE):
            total += int(lengths[end]) + 1
            end += 1
        if end == row + 1 and total > SLICE:
            text = raw[at[row] : at[row] + lengths[row]]
            hashes = np.concatenate([word_hashes(x) for x in _cuts(text)])
            yield row, hashes, np.array([len(hashes)])
        else:
            # One space after each text, so that no word spans two rows.
            ends = np.cumsum(lengths[row:end] + 1)
            data = np.full(int(ends[-1]), 32, np.uint8)
            for i, e in zip(range(row, end), ends.tolist()):
                data[e - 1 - lengths[i] : e - 1] = raw[at[i] : at[i] + lengths[i]]
            inside = ~_SPACE[data]
            inside[1:] &= _SPACE[data[:-1]]
            upto = np.concatenate([[0], np.cumsum(inside)])[np.concatenate([[0], ends])]
            yield row, word_hashes(data), np.diff(upto)
        row = end


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """For each row the sorted distinct hashes of its k-word shingles. A text of
    fewer words is one shingle; a text without words has none."""
    place = _PLACE[:k]
    for _, words, counts in documents_words(texts):
        if len(words) >= k:
            all_ = np.zeros(len(words) - k + 1, np.uint64)
            for j in range(k):
                all_ += words[j : len(words) - k + 1 + j] * place[j]
            all_ = mixed(all_)
        at = 0
        for c in counts.tolist():
            if c >= k:
                s = np.sort(all_[at : at + c - k + 1])
                yield s[np.concatenate([[True], s[1:] != s[:-1]])]
            elif c:
                yield mixed((words[at : at + c] * place[:c]).sum(keepdims=True) + np.uint64(k - c))
            else:
                yield np.empty(0, np.uint64)
            at += c
