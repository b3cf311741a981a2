"""ZIP archives read by range: directories (plain and ZIP64) and stored members, without extraction.

``Source`` is anything with ``size`` and ``read(offset, length)``; only the end records, the
central directory and each member's local header are read to find where a member's bytes lie.
``pack`` writes such archives, members stored one after the other.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable
from dataclasses import dataclass
from typing import BinaryIO, Protocol

# fixed values of the ZIP format
END, END64, LOCATOR64, CENTRAL, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
END_FORMAT, END64_FORMAT, LOCATOR64_FORMAT = "<4s4H2LH", "<4sQ2H2L4Q", "<4sLQL"
CENTRAL_FORMAT, LOCAL_FORMAT = "<4s6H3L5H2L", "<4s5H3L2H"
STORED = 0
EXTRA64 = 1
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
DATE_1980 = 0x21
UTF8_NAMES = 0x800


class Source(Protocol):
    size: int

    def read(self, offset: int, length: int) -> bytes: ...


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    offset: int  # of the member's bytes in the archive


class BadArchive(ValueError):
    pass


def _directory(source: Source) -> tuple[int, int, int]:
    """Offset, size and number of entries of the central directory."""
    tail_at = max(0, source.size - struct.calcsize(END_FORMAT) - FULL16)
    tail = source.read(tail_at, source.size - tail_at)
    at = tail.rfind(END)
    while at >= 0:  # the comment may hold the signature: the record must reach to the end
        if len(tail) - at >= 22 and at + 22 + struct.unpack_from(END_FORMAT, tail, at)[7] == len(tail):
            break
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise BadArchive("no end of central directory")
    _, _, _, _, entries, size, offset, _ = struct.unpack_from(END_FORMAT, tail, at)
    if entries == FULL16 or size == FULL32 or offset == FULL32:
        place = tail_at + at - struct.calcsize(LOCATOR64_FORMAT)
        if place >= 0:
            mark, _, end64, _ = struct.unpack(LOCATOR64_FORMAT, source.read(place, struct.calcsize(LOCATOR64_FORMAT)))
            if mark == LOCATOR64:
                record = struct.unpack(END64_FORMAT, source.read(end64, struct.calcsize(END64_FORMAT)))
                if record[0] != END64:
                    raise BadArchive("no ZIP64 end record")
                entries, size, offset = record[7], record[8], record[9]
    return offset, size, entries


def _wide(extra: bytes, values: list[int]) -> list[int]:
    """``values`` with those that are full replaced, in order, from the ZIP64 extra field."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<2H", extra, at)
        if kind == EXTRA64:
            field, place, out = extra[at + 4 : at + 4 + size], 0, []
            for v in values:
                if v == FULL32:
                    v = struct.unpack_from("<Q", field, place)[0]
                    place += 8
                out.append(v)
            return out
        at += 4 + size
    return values


def members(source: Source) -> list[Member]:
    """All members, from the central directory and their local headers."""
    offset, size, entries = _directory(source)
    raw = source.read(offset, size)
    out, at = [], 0
    for _ in range(entries):
        head = struct.unpack_from(CENTRAL_FORMAT, raw, at)
        if head[0] != CENTRAL:
            raise BadArchive("bad central directory")
        flags, method, packed, full = head[3], head[4], head[8], head[9]
        names, extras, comments, local = head[10], head[11], head[12], head[16]
        at += struct.calcsize(CENTRAL_FORMAT)
        name = raw[at : at + names].decode("utf-8" if flags & UTF8_NAMES else "cp437")
        full, packed, local = _wide(raw[at + names : at + names + extras], [full, packed, local])
        at += names + extras + comments
        first = struct.unpack(LOCAL_FORMAT, source.read(local, struct.calcsize(LOCAL_FORMAT)))
        if first[0] != LOCAL:
            raise BadArchive("bad local header")
        out.append(Member(name, method, packed, local + struct.calcsize(LOCAL_FORMAT) + first[9] + first[10]))
    return out


def pack(out: BinaryIO, parts: Iterable[tuple[str, bytes]], zip64: bool = False) -> None:
    """Writes stored members; ``zip64`` gives every entry and the directory their ZIP64 forms."""
    entries, at = [], 0
    for name, data in parts:
        raw, crc = name.encode(), zlib.crc32(data)
        wide = zip64 or len(data) >= FULL32
        size = FULL32 if wide else len(data)
        extra = struct.pack("<2H2Q", EXTRA64, 16, len(data), len(data)) if wide else b""
        version = 45 if wide else 20
        out.write(struct.pack(LOCAL_FORMAT, LOCAL, version, UTF8_NAMES, STORED, 0, DATE_1980, crc, size, size, len(raw), len(extra)) + raw + extra + data)
        entries.append((raw, crc, len(data), at))
        at += struct.calcsize(LOCAL_FORMAT) + len(raw) + len(extra) + len(data)
    start = at
    for raw, crc, n, offset in entries:
        wide = zip64 or n >= FULL32 or offset >= FULL32
        extra = struct.pack("<2H3Q", EXTRA64, 24, n, n, offset) if wide else b""
        size, where = (FULL32, FULL32) if wide else (n, offset)
        head = (CENTRAL, 45, 45 if wide else 20, UTF8_NAMES, STORED, 0, DATE_1980, crc, size, size, len(raw), len(extra), 0, 0, 0, 0, where)
        out.write(struct.pack("<4s6H3L5H2L", *head) + raw + extra)
        at += struct.calcsize(CENTRAL_FORMAT) + len(raw) + len(extra)
    n = len(entries)
    if zip64 or n >= FULL16 or at >= FULL32:
        out.write(struct.pack(END64_FORMAT, END64, 44, 45, 45, 0, 0, n, n, at - start, start))
        out.write(struct.pack(LOCATOR64_FORMAT, LOCATOR64, 0, at, 1))
        out.write(struct.pack(END_FORMAT, END, 0, 0, FULL16, FULL16, FULL32, FULL32, 0))
    else:
        out.write(struct.pack(END_FORMAT, END, 0, 0, n, n, at - start, start, 0))
