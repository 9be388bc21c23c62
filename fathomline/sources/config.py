"""Configuration: an INI file, overridden by the environment."""

from __future__ import annotations

import configparser
import os
from dataclasses import dataclass, fields
from pathlib import Path


@dataclass(frozen=True)
class Config:
    ais_path: str = "data/ais"
    ais_url: str = ""
    warehouse: str = "warehouse"
    cell_sizes: tuple[int, ...] = (5000, 1000, 200, 50)
    drop_on_init: bool = False
    partitions: int = 400
    version: str = "unknown"


def _value(kind, text: str):  # noqa: ANN001, ANN202
    if kind in ("bool", bool):
        if text.strip().lower() not in ("true", "false", "1", "0", "yes", "no"):
            raise ValueError(f"not a boolean: {text!r}")
        return text.strip().lower() in ("true", "1", "yes")
    if "tuple" in str(kind):
        return tuple(int(x) for x in text.replace(",", " ").split())
    return int(text) if kind in ("int", int) else text


def load_config(path: str | Path | None = None, environ: dict[str, str] | None = None) -> Config:
    """Section [fathomline] of a file, then FATHOMLINE_NAME from the environment."""
    found: dict[str, str] = {}
    if path is not None:
        parser = configparser.ConfigParser()
        parser.read_string(Path(path).read_text())
        found |= dict(parser["fathomline"]) if parser.has_section("fathomline") else {}
    env = os.environ if environ is None else environ
    found |= {f.name: env[f"FATHOMLINE_{f.name.upper()}"] for f in fields(Config) if f"FATHOMLINE_{f.name.upper()}" in env}
    kinds = {f.name: f.type for f in fields(Config)}
    if unknown := set(found) - set(kinds):
        raise ValueError(f"unknown settings: {sorted(unknown)}")
    return Config(**{k: _value(kinds[k], v) for k, v in found.items()})
