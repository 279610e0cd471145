"""Schema lookup by subject."""

from __future__ import annotations

import json
import urllib.parse
import urllib.request
from dataclasses import dataclass
from pathlib import Path
from typing import Protocol


@dataclass(frozen=True)
class Registered:
    schema: str
    schema_id: int


class SchemaProvider(Protocol):
    def latest(self, subject: str) -> Registered: ...


@dataclass(frozen=True)
class HttpRegistry:
    """A registry that answers /subjects/<subject>/versions/latest."""

    url: str
    timeout: float = 10.0

    def latest(self, subject: str) -> Registered:
        at = f"{self.url.rstrip('/')}/subjects/{urllib.parse.quote(subject, safe='')}/versions/latest"
        with urllib.request.urlopen(at, timeout=self.timeout) as answer:
            found = json.load(answer)
        return Registered(found["schema"], int(found["id"]))


@dataclass(frozen=True)
class FileRegistry:
    """<folder>/<subject>.json with the same answers."""

    folder: str

    def latest(self, subject: str) -> Registered:
        path = Path(self.folder) / f"{subject}.json"
        if not path.is_file():
            raise KeyError(subject)
        found = json.loads(path.read_text())
        return Registered(found["schema"] if isinstance(found["schema"], str) else json.dumps(found["schema"]), int(found["id"]))


def check_topics(topics: dict[str, str], subjects: dict[str, str], tables) -> None:
    """Every table has a topic and a subject of its own."""
    for what, given in (("topic", topics), ("subject", subjects)):
        wrong = set(tables) ^ set(given)
        if wrong or len(set(given.values())) != len(given):
            raise ValueError(f"{what}s and tables differ: {sorted(wrong) or 'repeated names'}")
