"""Stages of a run with resumable state in a JSON file."""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from pathlib import Path

STAGES = ("collect", "quality", "annotate", "active_learning", "train", "report")


@dataclass
class StageState:
    status: str = "pending"
    artifacts: dict[str, str] = field(default_factory=dict)
    error: str | None = None


@dataclass
class RunState:
    run_id: str
    stages: dict[str, StageState] = field(default_factory=lambda: {s: StageState() for s in STAGES})

    @property
    def status(self) -> str:
        """failed before awaiting, awaiting before completed, completed before running, running before idle."""
        have = {s.status for s in self.stages.values()}
        if "failed" in have:
            return "failed"
        if "awaiting_review" in have:
            return "awaiting_review"
        if have <= {"completed", "skipped"}:
            return "completed"
        return "running" if have & {"running", "completed"} else "idle"


class Runs:
    """State files under one folder; writes are atomic."""

    def __init__(self, folder: str | Path) -> None:
        self.folder = Path(folder)

    def create(self, run_id: str | None = None) -> RunState:
        state = RunState(run_id or time.strftime("run_%Y%m%d_%H%M%S"))
        self.save(state)
        return state

    def save(self, state: RunState) -> None:
        path = self.folder / state.run_id / "state.json"
        path.parent.mkdir(parents=True, exist_ok=True)
        tmp = path.with_suffix(".tmp")
        tmp.write_text(json.dumps(asdict(state), indent=1, sort_keys=True))
        os.replace(tmp, path)

    def load(self, run_id: str) -> RunState:
        raw = json.loads((self.folder / run_id / "state.json").read_text())
        return RunState(raw["run_id"], {k: StageState(**v) for k, v in raw["stages"].items()})

    def latest(self) -> RunState | None:
        found = sorted(self.folder.glob("*/state.json"), key=lambda p: (p.stat().st_mtime, p.parent.name))
        return self.load(found[-1].parent.name) if found else None


def run(runs: Runs, state: RunState, steps: dict[str, Callable[[RunState], dict[str, str] | None]]) -> RunState:
    """Pending stages in order until one fails or asks for a review (by returning None)."""
    for name in STAGES:
        stage = state.stages[name]
        if stage.status in ("completed", "skipped"):
            continue
        if stage.status == "awaiting_review":
            break
        if name not in steps:
            stage.status = "skipped"
            runs.save(state)
            continue
        stage.status = "running"
        runs.save(state)
        try:
            got = steps[name](state)
        except Exception as e:
            stage.status, stage.error = "failed", f"{type(e).__name__}: {e}"
            runs.save(state)
            break
        stage.status, stage.artifacts = ("awaiting_review", {}) if got is None else ("completed", got)
        runs.save(state)
        if got is None:
            break
    return state


def approve(runs: Runs, state: RunState, stage: str, artifacts: dict[str, str] | None = None) -> RunState:
    """A reviewed stage counts as completed."""
    if state.stages[stage].status != "awaiting_review":
        raise ValueError(f"{stage} isn't waiting for a review")
    state.stages[stage].status, state.stages[stage].artifacts = "completed", artifacts or {}
    runs.save(state)
    return state


def reset(runs: Runs, state: RunState, stage: str) -> RunState:
    """A stage and all after it count as not run."""
    for name in STAGES[STAGES.index(stage) :]:
        state.stages[name] = StageState()
    runs.save(state)
    return state
