"""SQL from files: templates, named parameters, folders in order."""

from __future__ import annotations

import re
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession

_PIECE = re.compile(r"'(?:[^']|'')*'|--[^\n]*|/\*.*?\*/|;|[^';/-]+|.", re.S)


def statements(text: str) -> list[str]:
    """Statements between semicolons; those in strings and comments do not count."""
    out, now = [], []
    for m in _PIECE.finditer(text):
        if m[0] == ";":
            out.append("".join(now))
            now = []
        else:
            now.append(m[0])
    out.append("".join(now))
    return [s.strip() for s in out if re.sub(r"--[^\n]*|/\*.*?\*/", "", s, flags=re.S).strip()]


def run_text(spark: SparkSession, text: str, names: dict[str, str] | None = None, args: dict[str, Any] | None = None, split: bool = True) -> DataFrame | None:
    """Run statements; ``names`` fill {NAME} in the text, ``args`` bind :name. The last one's result."""
    for k, v in (names or {}).items():
        text = text.replace(f"{{{k}}}", v)
    out = None
    for s in statements(text) if split else [text]:
        used = {k: v for k, v in (args or {}).items() if re.search(rf"(?<!:):{re.escape(k)}\b", s)}
        out = spark.sql(s, args=used) if used else spark.sql(s)
    return out


def run_file(spark: SparkSession, path: str | Path, **how: Any) -> DataFrame | None:
    return run_text(spark, Path(path).read_text(), **how)


def run_folder(spark: SparkSession, folder: str | Path, **how: Any) -> list[str]:
    """All .sql files of a folder by name; the names."""
    files = sorted(Path(folder).glob("*.sql"))
    for f in files:
        run_file(spark, f, **how)
    return [f.name for f in files]
