"""Cutting a CSV stream at record ends.

``Records`` follows the quotes of a CSV stream piece by piece, with the rules of Spark's reader (quote ``"``,
escape ``\\``, delimiter ``,``): a quote opens a quoted cell only where a cell begins; in it, a backslash
takes the next byte with it; the first other quote closes the cell, and up to the next delimiter or line
end further quotes are plain. Line ends inside a quoted cell end no record. Its state is a few flags, so
streams of any size are cut without holding a record.

``PartStream`` deals a stream into parts of whole records, each with the header record first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

# Rest of a quoted cell with its closing quote.
_CLOSE = re.compile(rb'(?:[^"\\]++|\\.)*+"', re.DOTALL)
_QUOTE = ord('"')
_BEFORE_CELL = b",\n\r"


class Records:
    def __init__(self):
        self.quoted = False  # inside a quoted cell
        self.skip = False  # the next byte is escaped
        self.start = True  # at the begin of a cell
        self.line_end: bytes | None = None  # known after the first record

    def _opening(self, data: bytes, i: int) -> int:
        """The first quote from ``i`` on that opens a cell; -1 if there is none."""
        if self.start and data[i] == _QUOTE:
            return i
        q = data.find(b'"', i + 1)
        while q >= 0 and data[q - 1] not in _BEFORE_CELL:
            q = data.find(b'"', q + 1)
        return q

    def _end(self, data: bytes, i: int, stop: int) -> int:
        """The byte after the first line end in [i, stop); -1 if there is none."""
        if self.line_end is None:
            at = [p for p in (data.find(b"\n", i, stop), data.find(b"\r", i, stop)) if p >= 0]
            if not at:
                return -1
            p = min(at)
            self.line_end = b"\r" if data[p : p + 1] == b"\r" and data[p + 1 : p + 2] != b"\n" else b"\n"
        p = data.find(self.line_end, i, stop)
        return p + 1 if p >= 0 else -1

    def advance(self, data: bytes, i: int, least: int) -> tuple[int, bool]:
        """Follow ``data`` from ``i``: (byte after the first record end at ``least`` or later, True), or
        (its length, False) if no record ends there."""
        n = len(data)
        if self.skip and i < n:
            i, self.skip = i + 1, False
        while i < n:
            if self.quoted:
                m = _CLOSE.match(data, i)
                if m is None:
                    tail = n - max(i, len(data.rstrip(b"\\")))
                    self.skip = tail % 2 == 1
                    return n, False
                i, self.quoted, self.start = m.end(), False, False
                continue
            q = self._opening(data, i)
            end = self._end(data, max(i, least - 1), n if q < 0 else q)
            if end >= 0:
                self.start = True
                return end, True
            if q < 0:
                self.start = data[n - 1] in _BEFORE_CELL
                return n, False
            i, self.quoted = q + 1, True
        return n, False


class PartStream:
    """Parts of about ``part_bytes`` of the stream ``pieces``; ``part()`` gives the bytes of the next one,
    ``more`` says whether there is one."""

    def __init__(self, pieces: Iterator[bytes], part_bytes: int):
        self.pieces, self.part_bytes = iter(pieces), part_bytes
        self.records, self.header, self.rest = Records(), b"", b""
        self.parts, self.more = 0, True

    def _fill(self) -> bool:
        """Whether anything but line ends is left; line ends alone make no part."""
        while not self.rest.strip(b"\r\n"):
            piece = next(self.pieces, None)
            if piece is None:
                return False
            self.rest += piece
        return True

    def _first_record(self) -> Iterator[bytes]:
        """The lines up to the first record that is not empty, which is kept as the header."""
        record = b""
        while True:
            data = self.rest or next(self.pieces, None)
            if data is None:
                break
            end, ended = self.records.advance(data, 0, 0)
            record, self.rest = record + data[:end], data[end:]
            if ended:
                yield record
                if record.strip(b"\r\n"):
                    self.header = record
                    return
                record = b""
        yield record

    def part(self) -> Iterator[bytes]:
        size = 0
        if self.parts:
            yield self.header
        else:
            for piece in self._first_record():
                size += len(piece)
                yield piece
        self.parts += 1
        ended = True
        while not (ended and size >= self.part_bytes):
            data = self.rest or next(self.pieces, None)
            if data is None:
                break
            end, ended = self.records.advance(data, 0, self.part_bytes - size)
            yield data[:end]
            size, self.rest = size + end, data[end:]
        self.more = self._fill()
