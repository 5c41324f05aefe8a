"""Texts as seekable compressed frames: independent zstandard frames, each with
the units, code points and bytes that lie before it.

A unit is ``[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+``, so that units
tile a text: one begins at its first character and wherever white space follows
a character that is none. A cut between units is found by the cumulative counts
and one decompressed frame; a range of bytes is streamed frame by frame. Nothing
here holds more than a frame of a text besides its compressed form.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import zstandard

#: Bytes of text in a frame.
FRAME = 1 << 16
FRAMES = "array<struct<units:bigint,chars:bigint,bytes:bigint,open:boolean,data:binary>>"

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_PACK = zstandard.ZstdCompressor(level=1)
_UNPACK = zstandard.ZstdDecompressor()


def unit_starts(data: bytes, open_: bool, first: bool) -> np.ndarray:
    """Where units begin in a frame; ``open_``: the byte before is no white space;
    ``first``: nothing is before."""
    space = _SPACE[np.frombuffer(data, np.uint8)]
    starts = space.copy()
    starts[1:] &= ~space[:-1]
    starts[:1] &= open_
    starts[:1] |= first
    return np.flatnonzero(starts)


def code_points(data: bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


class Frames:
    """The frames of one text, appended to or read."""

    def __init__(self, size: int = FRAME, held: list[dict] | None = None, units: int = 0, chars: int = 0, n_bytes: int = 0):
        self.size, self.held = size, held if held is not None else []
        self.units, self.chars, self.bytes = units, chars, n_bytes
        self._rest, self._open = b"", False

    def add(self, data: bytes) -> None:
        self._rest += data
        while len(self._rest) >= self.size + 4:
            end = self.size
            while self._rest[end] & 0xC0 == 0x80:
                end -= 1
            self._put(self._rest[:end])
            self._rest = self._rest[end:]

    def close(self) -> Frames:
        while self._rest:
            end = min(self.size, len(self._rest))
            while end < len(self._rest) and self._rest[end] & 0xC0 == 0x80:
                end -= 1
            self._put(self._rest[:end])
            self._rest = self._rest[end:]
        return self

    def _put(self, data: bytes) -> None:
        self.held.append({"units": self.units, "chars": self.chars, "bytes": self.bytes, "open": self._open, "data": _PACK.compress(data)})
        self.units += len(unit_starts(data, self._open, not self.bytes))
        self.chars += code_points(data)
        self.bytes += len(data)
        self._open = not _SPACE[data[-1]]

    def cut(self, unit: int) -> tuple[int, int]:
        """(code points, bytes) before a unit; of the whole text after the last."""
        if unit >= self.units:
            return self.chars, self.bytes
        i = bisect_right(self.held, unit, key=lambda f: f["units"]) - 1
        frame = self.held[i]
        data = _UNPACK.decompress(frame["data"])
        at = int(unit_starts(data, frame["open"], i == 0)[unit - frame["units"]])
        return frame["chars"] + code_points(data[:at]), frame["bytes"] + at

    def stream(self, begin: int = 0, end: int | None = None) -> Iterator[bytes]:
        """The bytes from ``begin`` to ``end``, frame by frame."""
        end = self.bytes if end is None else end
        i = max(0, bisect_right(self.held, begin, key=lambda f: f["bytes"]) - 1)
        while i < len(self.held) and self.held[i]["bytes"] < end:
            frame = self.held[i]
            data = _UNPACK.decompress(frame["data"])
            part = data[max(0, begin - frame["bytes"]) : end - frame["bytes"]]
            if part:
                yield part
            i += 1

    def find(self, mark: bytes, begin: int = 0) -> int:
        """The byte at which ``mark`` first stands from ``begin`` on; -1 if nowhere."""
        tail, at = b"", begin
        for part in self.stream(begin):
            window = tail + part
            hit = window.find(mark)
            if hit >= 0:
                return at - len(tail) + hit
            at += len(part)
            tail = window[len(window) - len(mark) + 1 :] if len(mark) > 1 else b""
        return -1


def packed(parts: Iterable[bytes], size: int = FRAME) -> Frames:
    out = Frames(size)
    for part in parts:
        out.add(part)
    return out.close()
