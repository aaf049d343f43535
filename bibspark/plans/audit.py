"""What a run did: an audit log that stays between runs, and log handlers for screen, file and JSON lines."""

from __future__ import annotations

import json
import logging
import os
import sys
import time
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from bibspark.sources import files


@dataclass
class AuditLog:
    """Entries of a time, the stage, what it did, and details."""

    entries: list[dict] = field(default_factory=list)

    def add(self, stage: str, action: str, **details) -> None:
        self.entries.append({"timestamp": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime()), "stage": stage, "action": action, "details": details})

    def of(self, stage: str | None = None) -> list[dict]:
        """The entries of one stage, or all."""
        return [e for e in self.entries if stage is None or e["stage"] == stage]

    def save(self, spark: SparkSession, path: str) -> None:
        """Written behind the entries that are there already."""
        files.write_text(spark, path, json.dumps(load(spark, path) + self.entries, ensure_ascii=False, indent=2, default=str))


def load(spark: SparkSession, path: str) -> list[dict]:
    """The entries of a log; none if it is missing or broken."""
    try:
        found = json.loads(files.read_text(spark, path)) if files.exists(spark, path) else []
    except ValueError:
        return []
    return found if isinstance(found, list) else []


def plain(doc, most: int = 2000) -> dict | None:
    """A JSON result with simple values: of a list its first object; lists inside as text, nothing as ''."""
    if isinstance(doc, list):
        doc = doc[0] if doc and isinstance(doc[0], dict) else None
    if not isinstance(doc, dict):
        return None
    return {k: "" if v is None else v if isinstance(v, (str, int, float, bool, dict)) else str(v)[:most] for k, v in doc.items()}


class _JsonLines(logging.Formatter):
    def format(self, record: logging.LogRecord) -> str:
        doc = {"timestamp": self.formatTime(record), "level": record.levelname, "logger": record.name, "message": record.getMessage()}
        return json.dumps(doc | ({"error": self.formatException(record.exc_info)} if record.exc_info else {}), ensure_ascii=False)


def logger(folder: str | None = None, name: str = "bibspark") -> logging.Logger:
    """Messages on the screen; with a local folder of the driver also in a text file and as JSON lines."""
    log = logging.getLogger(name)
    log.setLevel(logging.DEBUG)
    if not log.handlers:
        screen = logging.StreamHandler(sys.stderr)
        screen.setLevel(logging.WARNING)
        screen.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s", "%H:%M:%S"))
        log.addHandler(screen)
    have = {getattr(h, "baseFilename", "") for h in log.handlers}
    if folder:
        os.makedirs(folder, exist_ok=True)
        for file, form in ((f"{name}.log", logging.Formatter("%(asctime)s %(levelname)s %(name)s %(message)s")), (f"{name}.jsonl", _JsonLines())):
            path = os.path.abspath(os.path.join(folder, file))
            if path not in have:
                h = logging.FileHandler(path, encoding="utf-8")
                h.setFormatter(form)
                log.addHandler(h)
    return log
