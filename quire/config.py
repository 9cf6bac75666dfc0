"""Settings: one validated object on the driver, from defaults and a ``.env`` file.

A value in the file wins over the shell's, because a corpus should build alike everywhere.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, fields
from pathlib import Path

TRUE, FALSE = {"1", "true", "yes", "on"}, {"0", "false", "no", "off"}
#: Folders of a corpus root; the tables beside them are made by Spark.
FOLDERS = ["inbox", "processed", "failed", "exports", "state", "logs"]


def parse_env(text: str) -> dict[str, str]:
    """KEY=VALUE lines; blank lines, comments and an ``export`` in front are skipped, quotes dropped."""
    found = {}
    for line in text.splitlines():
        key, equals, value = line.strip().removeprefix("export ").partition("=")
        if not equals or key.startswith("#"):
            continue
        value = value.strip()
        if len(value) > 1 and value[0] == value[-1] and value[0] in "'\"":
            value = value[1:-1]
        found[key.strip()] = value
    return found


@dataclass(frozen=True)
class Settings:
    root: Path = Path(".")
    api_key: str = ""
    vision_model: str = "stub-vision"
    embedding_model: str = "stub-embedding"
    embedding_dimensions: int = 768
    embedding_batch: int = 32
    max_requests_per_day: int = 18
    min_interval_seconds: float = 60.0
    max_retries: int = 5
    native_router_enabled: bool = False
    keep_page_images: bool = True
    render_dpi: int = 240
    inbox_poll_seconds: float = 5.0
    stable_seconds: int = 8
    chunk_target_tokens: int = 750
    chunk_max_tokens: int = 900
    chunk_overlap_tokens: int = 120

    @classmethod
    def load(cls, root: str | Path, shell: dict[str, str] | None = None) -> Settings:
        root = Path(root)
        file = root / ".env"
        values = dict(os.environ if shell is None else shell) | (parse_env(file.read_text("utf-8-sig")) if file.exists() else {})
        out: dict = {"root": root}
        for f in fields(cls):
            raw = values.get(f"QUIRE_{f.name.upper()}", "")
            if f.name == "root" or not raw:
                continue
            out[f.name] = cls._value(f.name, str(f.type), raw)
        made = cls(**out)
        made.validate()
        return made

    @staticmethod
    def _value(name: str, kind: str, raw: str) -> object:
        try:
            if kind == "bool":
                if raw.lower() not in TRUE | FALSE:
                    raise ValueError(raw)
                return raw.lower() in TRUE
            return {"int": int, "float": float}.get(kind, str)(raw)
        except ValueError:
            raise ValueError(f"QUIRE_{name.upper()} has an invalid value: {raw!r}") from None

    def validate(self) -> None:
        if not 0 <= self.chunk_overlap_tokens < self.chunk_target_tokens <= self.chunk_max_tokens:
            raise ValueError("chunk sizes must satisfy overlap < target <= max")
        for name in ("embedding_dimensions", "embedding_batch", "render_dpi"):
            if getattr(self, name) < 1:
                raise ValueError(f"{name} must be at least 1")
        for name in ("max_requests_per_day", "min_interval_seconds", "max_retries", "stable_seconds", "inbox_poll_seconds"):
            if getattr(self, name) < 0:
                raise ValueError(f"{name} must not be negative")

    def validate_for_ingestion(self) -> None:
        if not self.native_router_enabled and not self.api_key and not self.vision_model.startswith("stub"):
            raise ValueError("an API key is required for the visual converter")

    def ensure_directories(self) -> None:
        for name in FOLDERS:
            (self.root / name).mkdir(parents=True, exist_ok=True)

    def path(self, name: str) -> str:
        return str(self.root / name)
