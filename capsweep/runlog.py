"""Events of a run, for people and as JSON lines; a logger that fails never fails the run."""

from __future__ import annotations

import json
import sys
from dataclasses import dataclass, field
from pathlib import Path
from typing import Protocol, TextIO

LEVELS = {"debug": 10, "info": 20, "warn": 30, "error": 40}
#: Fields whose content is never logged, by exact name.
SECRET_FIELDS = ("cpf", "partyName", "jsessionid", "viewState", "ca")


class Logger(Protocol):
    def log(self, level: str, event: str, fields: dict) -> None: ...


@dataclass
class ConsoleLogger:
    least: str = "info"
    out: TextIO = field(default_factory=lambda: sys.stderr)

    def log(self, level: str, event: str, fields: dict) -> None:
        if LEVELS[level] >= LEVELS[self.least]:
            print(" ".join([level.upper(), event, *(f"{k}={v}" for k, v in fields.items() if v is not None)]), file=self.out)


@dataclass
class JsonlLogger:
    folder: str
    run_id: str
    least: str = "debug"

    def log(self, level: str, event: str, fields: dict) -> None:
        if LEVELS[level] >= LEVELS[self.least]:
            path = Path(self.folder, f"run-{self.run_id}.jsonl")
            path.parent.mkdir(parents=True, exist_ok=True)
            with path.open("a", encoding="utf-8") as f:
                f.write(json.dumps({"level": level, "event": event, "fields": fields}, ensure_ascii=False) + "\n")


class NullLogger:
    def log(self, level: str, event: str, fields: dict) -> None:
        pass


@dataclass
class Redacting:
    inner: Logger

    def log(self, level: str, event: str, fields: dict) -> None:
        self.inner.log(level, event, {k: "[REDACTED]" if k in SECRET_FIELDS else v for k, v in fields.items()})


def emit(logger: Logger | None, level: str, event: str, **fields) -> None:
    try:
        if logger is not None:
            logger.log(level, event, fields)
    except Exception:  # observing a run must not change it
        pass
