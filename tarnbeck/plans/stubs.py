"""Deterministic stand-ins for the tools that media need; their files are texts of the form kind|number|size."""

from __future__ import annotations

import json

from ..sources.media import Tools


def _fields(content) -> tuple[int, int]:
    own = bytes(content).decode().split("|")
    return int(own[1]), int(own[2])


class Reader:
    def read(self, images):
        out = []
        for x in images:
            number, size = _fields(x)
            if number % 13 == 0:
                raise ValueError("no image")
            out.append((size * 20, size * 10, "PNG", {"Make": f"m{size}"}, None))
        return out


class Probe:
    def probe(self, files):
        out = []
        for x in files:
            number, size = _fields(x)
            if number % 11 == 0:
                raise ValueError("bad file")
            sound = {"codec_type": "audio", "codec_name": "aac", "sample_rate": "16000", "channels": 1}
            shown = {"codec_type": "video", "codec_name": "h264", "width": 640, "height": 360, "avg_frame_rate": "25/1"}
            streams = [] if number % 7 == 0 else [sound] if bytes(x)[:1] == b"A" else [shown, sound] if number % 3 else [shown]
            out.append(json.dumps({"format": {"duration": f"{size}.0"}, "streams": streams}))
        return out


class Codec:
    def convert(self, files, options):
        out = []
        for x, option in zip(files, options, strict=True):
            number, size = _fields(x)
            if number % 17 == 0:
                raise ValueError("codec failed")
            kind, _, rest = option.partition(":")
            if kind == "scene_log":
                out.append(f"frame 1 pts_time:{size / 2} x\nnothing here".encode())
            elif kind == "frame":
                out.append(f"F|{number}|{size}|{float(rest)}".encode())
            else:
                out.append(bytes(x) + f"|{option}".encode())
        return out


class Ocr:
    def read(self, images):
        return [[("LINE", f"line {n}"), ("WORD", "line")] if n % 2 else [] for n, _ in map(_fields, images)]


class Captioner:
    def caption(self, images):
        return [f"caption {size}" if size % 2 else "" for _, size in map(_fields, images)]


class Asr:
    def transcribe(self, recordings):
        return [[(0.0, 5.0, f"said {n}", None), (5.0, float(size), f"write to a{n}@b.org", "S1")] if size > 5 else [] for n, size in map(_fields, recordings)]


class Faces:
    def detect(self, images):
        return [[(0.25, 0.5, 0.5, 0.25), (0.0, 0.0, 0.0, 0.5)] if n % 5 == 0 else [] for n, _ in map(_fields, images)]


TOOLS = Tools(Reader, Probe, Codec, Ocr, Captioner, Asr, Faces)
