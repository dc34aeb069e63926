"""Configuration as frozen dataclasses; unknown keys are errors."""

from __future__ import annotations

import dataclasses
import json
from dataclasses import dataclass, field
from typing import Any


# The numbers below are the defaults that results depend on.


@dataclass(frozen=True)
class Limits:
    """Gates of a clip, by what they measure: the least or greatest value that passes, or both."""

    # signal
    peak_dbfs: tuple[float, float] = (-35.0, -0.5)
    clipped_share: float = 0.001
    snr_db: float = 12.0
    # predicted quality
    mos: float = 3.0
    pesq: float = 1.8
    stoi: float = 0.75
    # music, which rejects only where that is asked for
    reject_music: bool = False
    accompaniment: float = 0.10
    music: float = 0.20
    # text
    words: int = 2
    pace: tuple[float, float] = (4.0, 18.0)
    script_share: float = 0.6
    disagreement: float = 0.35
    confidence: float = 0.5
    log_confidence: float = -1.0
    alignment: float = -5.5
    reject_cut_words: bool = True


@dataclass(frozen=True)
class Pieces:
    """How speech is cut into clips, in seconds."""

    longest: float = 12.0
    shortest: float = 2.0
    margin: float = 0.2
    joined_gap: float = 0.3
    cutting_pause: float = 0.25
    caption_window: float = 900.0


@dataclass(frozen=True)
class Voices:
    """When voices are one, and which count."""

    same_voice: float = 0.35
    off_voice: float = 0.45
    seconds: float = 30.0
    ruling_share: float = 0.9


@dataclass(frozen=True)
class Sources:
    """Where recordings come from, and how they are asked for."""

    hosts: tuple[str, ...] = ("video.example",)
    short_hosts: tuple[str, ...] = ("v.example",)
    languages: tuple[str, ...] = ("ar*", "en*")
    depth: int = 2
    tries: int = 3


@dataclass(frozen=True)
class Config:
    """All of it."""

    limits: Limits = field(default_factory=Limits)
    pieces: Pieces = field(default_factory=Pieces)
    voices: Voices = field(default_factory=Voices)
    sources: Sources = field(default_factory=Sources)

    @classmethod
    def load(cls, path: str | None = None, overrides: dict[str, Any] | None = None) -> Config:
        """Defaults, then a JSON (or YAML, if a parser is installed) file, then dotted overrides."""
        tree: dict[str, Any] = {}
        if path:
            with open(path, encoding="utf-8") as f:
                raw = f.read()
            try:
                tree = json.loads(raw)
            except ValueError:
                import yaml

                tree = yaml.safe_load(raw) or {}
        for dotted, value in (overrides or {}).items():
            *sections, last = dotted.split(".")
            node = tree
            for s in sections:
                node = node.setdefault(s, {})
            node[last] = value
        return _build(cls, tree, "")

    def to_dict(self) -> dict[str, Any]:
        """As nested dictionaries."""
        return dataclasses.asdict(self)


def _build(cls: type, tree: dict[str, Any], where: str) -> Any:
    known = {f.name: f for f in dataclasses.fields(cls)}
    if unknown := set(tree) - set(known):
        raise KeyError(f"unknown configuration: {', '.join(sorted(where + k for k in unknown))}")
    default = cls()
    values = {}
    for name, value in tree.items():
        now = getattr(default, name)
        values[name] = _build(type(now), value, f"{where}{name}.") if dataclasses.is_dataclass(now) else tuple(value) if isinstance(now, tuple) else value
    return dataclasses.replace(default, **values)
