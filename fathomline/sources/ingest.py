"""Archive listing, download and extraction, on the driver and before Spark reads anything."""

from __future__ import annotations

import re
import urllib.parse
import urllib.request
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import date, timedelta
from html.parser import HTMLParser
from pathlib import Path


@dataclass(frozen=True)
class Archive:
    name: str
    url: str


def date_from_filename(name: str) -> date:
    """The date of ``aisdk-2007-04-03.zip``; without a day, the first of the month."""
    m = re.fullmatch(r"aisdk-(\d{4})-(\d{1,2})(?:-(\d{1,2}))?(?:\.zip|\.rar)?", name)
    if not m:
        raise ValueError(f"no date in {name!r}")
    return date(int(m[1]), int(m[2]), int(m[3] or 1))


class _Links(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.found: list[str] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "a" and (href := dict(attrs).get("href")):
            self.found.append(href)


def list_archives(url: str, fetch: Callable[[str], bytes] | None = None) -> dict[date, Archive]:
    """Archives linked from a page, by date; only zip and rar names that hold a date."""
    fetch = fetch or (lambda u: urllib.request.urlopen(u, timeout=60).read())  # noqa: S310
    links = _Links()
    links.feed(fetch(url).decode("utf-8", "replace"))
    return {date_from_filename(n): Archive(n, urllib.parse.urljoin(url, n)) for n in links.found if n.endswith((".zip", ".rar")) and n.startswith("aisdk-")}


def archive_for(day: date, archives: dict[date, Archive]) -> Archive:
    """The day's archive, or that of its month."""
    for key in (day, day.replace(day=1)):
        if key in archives:
            return archives[key]
    raise FileNotFoundError(f"no archive for {day}")


def renamed(name: str) -> str:
    """aisdk_20070101.csv as aisdk-2007-01-01.csv; other names as they are."""
    return re.sub(r"^aisdk_(\d{4})(\d{2})(\d{2})\.csv$", r"aisdk-\1-\2-\3.csv", name)


def extract(archive: Path, folder: Path) -> list[Path]:
    """Files of a zip archive, renamed; members outside the folder are refused."""
    if archive.suffix != ".zip":
        raise NotImplementedError(f"no extractor for {archive.suffix!r}")
    out = []
    with zipfile.ZipFile(archive) as z:
        for member in z.infolist():
            if member.is_dir():
                continue
            target = folder / renamed(Path(member.filename).name)
            with z.open(member) as src, target.open("wb") as dst:
                while block := src.read(1 << 20):
                    dst.write(block)
            out.append(target)
    return out


def ensure_day(day: date, folder: Path, archives: dict[date, Archive], fetch: Callable[[str], bytes] | None = None) -> Path:
    """The CSV of a day, downloaded and extracted if it is not there."""
    path = folder / f"aisdk-{day}.csv"
    if not path.exists():
        found = archive_for(day, archives)
        packed = folder / found.name
        if not packed.exists():
            packed.write_bytes((fetch or (lambda u: urllib.request.urlopen(u, timeout=600).read()))(found.url))  # noqa: S310
        extract(packed, folder)
        if not path.exists():
            raise FileNotFoundError(f"{found.name} holds no {path.name}")
    return path


def days(first: date, last: date) -> Iterator[date]:
    """All days, the last included."""
    for i in range((last - first).days + 1):
        yield first + timedelta(days=i)
