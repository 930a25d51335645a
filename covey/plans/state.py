"""State of a run's steps, kept in a JSON file."""

from __future__ import annotations

import json
import os
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

STEPS = ("convert", "sort", "partition", "density", "plan", "build", "verify")
PENDING, RUNNING, COMPLETED, FAILED, SKIPPED = "pending", "running", "completed", "failed", "skipped"


def now() -> str:
    return datetime.now(timezone.utc).isoformat()


@dataclass
class Step:
    status: str = PENDING
    started_at: str | None = None
    completed_at: str | None = None
    output_path: str | None = None
    error_message: str | None = None
    metrics: dict = field(default_factory=dict)

    @property
    def seconds(self) -> float | None:
        """How long it ran; None unless it started and ended."""
        if not self.started_at or not self.completed_at:
            return None
        return (datetime.fromisoformat(self.completed_at) - datetime.fromisoformat(self.started_at)).total_seconds()


class Run:
    """Steps in order with their states. A file that can't be read is set aside and all steps are pending again."""

    def __init__(self, path: str, names: tuple[str, ...] = STEPS):
        self.path, self.names = path, names
        self.created_at = now()
        self.steps = {n: Step() for n in names}
        if os.path.exists(path):
            try:
                with open(path) as f:
                    held = json.load(f)
                self.created_at = held["created_at"]
                self.steps |= {n: Step(**x) for n, x in held["steps"].items() if n in self.steps}
            except (ValueError, KeyError, TypeError, AttributeError):
                os.replace(path, f"{path}.corrupt")

    def save(self) -> None:
        with open(f"{self.path}.part", "w") as f:
            json.dump({"created_at": self.created_at, "updated_at": now(), "steps": {n: asdict(s) for n, s in self.steps.items()}}, f, indent=2)
        os.replace(f"{self.path}.part", self.path)

    def start(self, name: str) -> None:
        self.steps[name] = Step(RUNNING, now())
        self.save()

    def end(self, name: str, output_path: str | None = None, **metrics) -> None:
        step = self.steps[name]
        step.status, step.completed_at, step.output_path, step.metrics = COMPLETED, now(), output_path, metrics
        self.save()

    def fail(self, name: str, error: BaseException) -> None:
        step = self.steps[name]
        step.status, step.completed_at, step.error_message = FAILED, now(), f"{type(error).__name__}: {error}"
        self.save()

    def skip(self, name: str) -> None:
        self.steps[name].status = SKIPPED
        self.save()

    def next(self) -> str | None:
        """The first step that isn't done."""
        return next((n for n in self.names if self.steps[n].status not in (COMPLETED, SKIPPED)), None)

    def suffix(self, first: str) -> tuple[str, ...]:
        if first not in self.names:
            raise ValueError(f"unknown step {first}; steps are {', '.join(self.names)}")
        return self.names[self.names.index(first) :]

    def go(self, actions: dict, first: str | None = None, force: bool = False) -> None:
        """Runs actions (name to a function that gives (output path, metrics)) that aren't done, in order, from a step on."""
        for name in self.suffix(first) if first else self.names:
            if self.steps[name].status in (COMPLETED, SKIPPED) and not force:
                continue
            self.start(name)
            try:
                path, metrics = actions[name]()
            except BaseException as e:
                self.fail(name, e)
                raise
            self.end(name, path, **metrics)

    def table(self) -> list[tuple[str, str, float | None]]:
        return [(n, s.status, s.seconds) for n, s in self.steps.items()]
