"""Engine settings: one frozen object, captured as literals in plans."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields

#: File extension to modality.
EXTENSIONS = {
    ".txt": "text", ".md": "text", ".pdf": "text", ".docx": "text", ".html": "text", ".csv": "text", ".json": "text",
    ".jpg": "image", ".jpeg": "image", ".png": "image", ".tiff": "image", ".tif": "image", ".webp": "image", ".bmp": "image",
    ".mp3": "audio", ".wav": "audio", ".flac": "audio", ".m4a": "audio", ".aac": "audio", ".ogg": "audio",
    ".mp4": "video", ".mov": "video", ".avi": "video", ".mkv": "video", ".webm": "video",
}
MODALITIES = ("text", "image", "audio", "video")


@dataclass(frozen=True)
class EngineConfig:
    """Defaults are the engine's; from_env() reads overrides from the environment.

    strict reproduces behaviour that the defaults make safe: an unredacted video transcript, a
    pii_redacted flag that is always true, and quarantine keys that keep only the base name.
    """

    text_window: int = 1000
    text_overlap: int = 100
    image_max_size_mb: int = 25
    image_min_width_px: int = 32
    image_min_height_px: int = 32
    image_tile_threshold_px: int = 4096
    image_tile_size_px: int = 2048
    image_allowed_formats: tuple[str, ...] = ("JPEG", "PNG", "TIFF", "WEBP", "BMP")
    image_enable_captioning: bool = False
    image_enable_ocr: bool = True
    image_dedup_hash_distance: int = 5
    audio_max_duration_sec: float = 3600
    audio_min_duration_sec: float = 0.5
    audio_min_sample_rate: int = 8000
    audio_chunk_window_sec: int = 30
    audio_chunk_overlap_sec: int = 5
    video_max_duration_sec: float = 7200
    video_allowed_codecs: tuple[str, ...] = ("h264", "hevc", "vp9", "vp8")
    video_max_resolution_px: int = 3840
    video_scene_threshold: float = 30.0
    video_min_scene_len_sec: float = 2.0
    enable_face_redaction: bool = True
    enable_exif_strip: bool = True
    enable_pii_text_redaction: bool = True
    face_blur_kernel: int = 35
    embedding_strategy: str = "dual_vector"
    processed_prefix: str = "processed"
    quarantine_prefix: str = "quarantine"
    model_call_partitions: int | None = None
    strict: bool = False
    extensions: dict[str, str] = field(default_factory=lambda: dict(EXTENSIONS))

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None, **more) -> EngineConfig:
        """Overrides by upper-case field name, coerced by the default's type: bool, int, float, string.
        Tuples are comma-separated."""
        env = os.environ if env is None else env
        got = {}
        for f in fields(cls):
            raw, default = env.get(f.name.upper()), getattr(cls(), f.name)
            if raw is None or isinstance(default, dict) or default is None:
                continue
            if isinstance(default, bool):
                got[f.name] = raw.lower() in ("1", "true", "yes")
            elif isinstance(default, tuple):
                got[f.name] = tuple(x.strip() for x in raw.split(","))
            else:
                got[f.name] = type(default)(raw)
        return cls(**(got | more))
