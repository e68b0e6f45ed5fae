"""Image files by their bytes alone: dimensions, EXIF, and dropping it."""

from __future__ import annotations

import struct

#: Tags of the first EXIF directory by number.
EXIF_TAGS = {0x010E: "ImageDescription", 0x010F: "Make", 0x0110: "Model", 0x0112: "Orientation", 0x0131: "Software", 0x0132: "DateTime", 0x013B: "Artist", 0x8298: "Copyright"}
#: Bytes of a value by its EXIF type.
_WIDTHS = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 7: 1, 9: 4, 10: 8}
_PNG = b"\x89PNG\r\n\x1a\n"


def _segments(data: bytes):
    """(marker, start, end) of a JPEG's segments up to its scan."""
    at = 2
    while at + 4 <= len(data) and data[at] == 0xFF:
        marker, size = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
        yield marker, at, at + 2 + size
        if marker == 0xDA:
            return
        at += 2 + size


def _chunks(data: bytes):
    """(type, start, end) of a PNG's chunks."""
    at = len(_PNG)
    while at + 12 <= len(data):
        end = at + 12 + int.from_bytes(data[at : at + 4], "big")
        yield data[at + 4 : at + 8], at, end
        at = end


def image_size(data: bytes) -> tuple[int, int, str]:
    """Width, height and format from the header; raises for anything else."""
    if data[:8] == _PNG:
        return *struct.unpack(">II", data[16:24]), "PNG"
    if data[:2] == b"\xff\xd8":
        for marker, start, _ in _segments(data):
            if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                height, width = struct.unpack(">HH", data[start + 5 : start + 9])
                return width, height, "JPEG"
    if data[:6] in (b"GIF87a", b"GIF89a"):
        return *struct.unpack("<HH", data[6:10]), "GIF"
    if data[:2] == b"BM" and len(data) >= 26:
        width, height = struct.unpack("<ii", data[18:26])
        return width, abs(height), "BMP"
    if data[:4] == b"RIFF" and data[8:12] == b"WEBP":
        if data[12:16] == b"VP8X":
            return 1 + int.from_bytes(data[24:27], "little"), 1 + int.from_bytes(data[27:30], "little"), "WEBP"
        if data[12:16] == b"VP8L":
            bits = int.from_bytes(data[21:25], "little")
            return 1 + (bits & 0x3FFF), 1 + (bits >> 14 & 0x3FFF), "WEBP"
        if data[12:16] == b"VP8 ":
            width, height = struct.unpack("<HH", data[26:30])
            return width & 0x3FFF, height & 0x3FFF, "WEBP"
    if data[:4] in (b"II*\0", b"MM\0*"):
        tags = dict(_directory(data))
        if 0x100 in tags and 0x101 in tags:
            return int(tags[0x100]), int(tags[0x101]), "TIFF"
    raise ValueError("not an image that can be read")


def _directory(tiff: bytes):
    """(tag, value) of a TIFF's first directory."""
    order = "<" if tiff[:2] == b"II" else ">"
    at = struct.unpack(order + "I", tiff[4:8])[0]
    (count,) = struct.unpack(order + "H", tiff[at : at + 2])
    for i in range(count):
        own = tiff[at + 2 + 12 * i : at + 14 + 12 * i]
        tag, kind, n = struct.unpack(order + "HHI", own[:8])
        size = _WIDTHS.get(kind, 0) * n
        raw = own[8 : 8 + size] if size <= 4 else tiff[(p := struct.unpack(order + "I", own[8:12])[0]) : p + size]
        if kind == 2:
            yield tag, raw.split(b"\0")[0].decode("latin-1")
        elif kind in (3, 4) and len(raw) == size:
            yield tag, str(struct.unpack(order + "HI"[kind - 3], raw[: _WIDTHS[kind]])[0])


def exif(data: bytes) -> dict[str, str]:
    """Named tags of the first EXIF directory; empty for none and for whatever can't be read."""
    try:
        tiff = b""
        if data[:2] == b"\xff\xd8":
            tiff = next((data[a + 10 : b] for m, a, b in _segments(data) if m == 0xE1 and data[a + 4 : a + 10] == b"Exif\0\0"), b"")
        elif data[:8] == _PNG:
            tiff = next((data[a + 8 : b - 4] for t, a, b in _chunks(data) if t == b"eXIf"), b"")
        elif data[:4] in (b"II*\0", b"MM\0*"):
            tiff = data
        return {EXIF_TAGS[t]: v for t, v in _directory(tiff) if t in EXIF_TAGS} if tiff else {}
    except (struct.error, IndexError, KeyError):
        return {}


def without_exif(data: bytes) -> bytes:
    """A JPEG without its application data (but JFIF and colour), a PNG without EXIF and texts; other
    formats, whose pixels would have to be written again, raise."""
    if data[:2] == b"\xff\xd8":
        out, last = [data[:2]], 2
        for marker, a, b in _segments(data):
            if marker == 0xDA:
                last = a
                break
            if marker not in (0xE1, 0xED, 0xFE):
                out.append(data[a:b])
            last = b
        return b"".join([*out, data[last:]])
    if data[:8] == _PNG:
        return _PNG + b"".join(data[a:b] for t, a, b in _chunks(data) if t not in (b"eXIf", b"tEXt", b"zTXt", b"iTXt", b"tIME"))
    raise ValueError("no way to strip this format")
