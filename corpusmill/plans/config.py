"""Configuration of the flows: dataclasses read from and written to YAML or JSON, with missing parts reported by name."""

from __future__ import annotations

import dataclasses
import json
from dataclasses import dataclass, field
from pathlib import Path

try:
    import yaml
except ImportError:
    yaml = None


class ConfigError(ValueError):
    pass


@dataclass
class Cleaning:
    similarity_threshold: float = 0.9
    min_chars: int = 20
    attribution_patterns: list[str] = field(default_factory=list)


@dataclass
class Validation:
    bypass_domains: list[str] = field(default_factory=list)
    secret_patterns: list[str] = field(default_factory=list)


@dataclass
class Synthesis:
    primary_model: str = ""
    bulk_model: str = ""
    max_retries: int = 2
    examples_per_domain: int = 100


@dataclass
class Scraping:
    max_files_per_repo: int = 500
    private_patterns: list[str] = field(default_factory=list)


@dataclass
class Config:
    cleaning: Cleaning
    validation: Validation
    synthesis: Synthesis
    scraping: Scraping


REQUIRED = {"cleaning": ("similarity_threshold",), "validation": (), "synthesis": ("primary_model",), "scraping": ()}


def from_dict(data: dict) -> Config:
    """Unknown keys are dropped; numbers are made what the field's default is; missing sections and fields are named."""
    parts = {}
    for f in dataclasses.fields(Config):
        kind = globals()[f.type] if isinstance(f.type, str) else f.type
        if not isinstance(data.get(f.name), dict):
            raise ConfigError(f"missing section: {f.name}")
        given = data[f.name]
        for name in REQUIRED[f.name]:
            if given.get(name) in (None, ""):
                raise ConfigError(f"missing field: {f.name}.{name}")
        known = {}
        for g in dataclasses.fields(kind):
            if g.name in given:
                default = g.default if g.default is not dataclasses.MISSING else g.default_factory()
                known[g.name] = type(default)(given[g.name]) if isinstance(default, (int, float, str)) else list(given[g.name])
        parts[f.name] = kind(**known)
    return Config(**parts)


def load(path: str | Path) -> Config:
    text = Path(path).read_text(encoding="utf-8")
    data = yaml.safe_load(text) if yaml else json.loads(text)
    if not isinstance(data, dict):
        raise ConfigError("not a mapping")
    return from_dict(data)


def save(config: Config, path: str | Path) -> None:
    data = dataclasses.asdict(config)
    Path(path).write_text(yaml.safe_dump(data) if yaml else json.dumps(data, indent=1), encoding="utf-8")
