"""Options of an ingestion session: defaults, layers and validation."""

from __future__ import annotations

import re
from dataclasses import asdict, dataclass, fields

MODES = ("auto", "precision", "agent")
MODELS = ("pipeline", "vlm", "html")
EXTRA_FORMATS = ("docx", "html", "latex")

# Allowed integer ranges of the options.
RANGES = {
    "poll_interval_ms": (500, 60000),
    "poll_jitter_ms": (0, 10000),
    "timeout_ms": (10000, 3600000),
    "max_file_bytes": (0, 512 * 1024 * 1024),
    "inline_markdown_bytes": (256, 1024 * 1024),
    "artifact_url_ttl_sec": (60, 30 * 24 * 3600),
    "submit_rate_per_min": (1, 60),
    "poll_rate_per_min": (10, 1000),
    "daily_submit_limit": (1, 100000),
}


class ConfigError(ValueError):
    pass


@dataclass(frozen=True)
class Config:
    api_base_url: str = "https://service.invalid"
    token_credential: str = "PARSER_TOKEN"
    mode: str = "auto"
    model_version: str = "vlm"
    language: str = "ch"
    enable_table: bool = True
    enable_formula: bool = True
    is_ocr: bool = False
    extra_formats: tuple[str, ...] = ()
    expose_mode: str = "progressive"
    artifact_root_name: str = ".artifacts"
    poll_interval_ms: int = 3000
    poll_jitter_ms: int = 500
    timeout_ms: int = 600000
    max_file_bytes: int = 0
    inline_markdown_bytes: int = 12000
    artifact_url_ttl_sec: int = 86400
    submit_rate_per_min: int = 40
    poll_rate_per_min: int = 900
    daily_submit_limit: int = 5000
    user_agent: str = "millrace"

    def problems(self) -> list[str]:
        """Names of the options that are unusable, in the order of the fields."""
        bad = {
            "api_base_url": not re.match(r"https?://", self.api_base_url or "", re.I),
            "token_credential": not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", self.token_credential or ""),
            "mode": self.mode not in MODES,
            "model_version": self.model_version not in MODELS,
            "extra_formats": not set(self.extra_formats) <= set(EXTRA_FORMATS),
            "expose_mode": self.expose_mode not in ("progressive", "always"),
            "artifact_root_name": self.artifact_root_name in ("", ".", "..", None) or bool(re.search(r"[/\\]", self.artifact_root_name or "")),
        }
        for name, (low, high) in RANGES.items():
            v = getattr(self, name)
            bad[name] = isinstance(v, bool) or not isinstance(v, int) or not low <= v <= high
        return [f.name for f in fields(self) if bad.get(f.name)]

    def check(self) -> Config:
        if found := self.problems():
            raise ConfigError("unusable options: " + ", ".join(found))
        return self


def layered(*layers: dict) -> Config:
    """Later layers win, key by key; unknown keys are errors."""
    merged = asdict(Config())
    for layer in layers:
        if unknown := set(layer) - set(merged):
            raise ConfigError("unknown options: " + ", ".join(sorted(unknown)))
        merged |= layer
    return Config(**merged).check()
