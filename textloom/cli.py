"""Command line of runs: ``python -m textloom.cli COMMAND --runs FOLDER [--config FILE]``.

status, artifacts    what a run came to
run, resume          the stages of a configuration, from the start or from where the run stands
approve STAGE        a reviewed stage may go on; with --decision, the quality decision
reset STAGE          that stage and all after it are pending again

Exit codes: 0 done or waiting for a review, 1 a stage failed, 2 wrong use.
"""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from textloom.plans import pipeline


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="textloom", description="Runs of the collection and labelling stages.")
    p.add_argument("command", choices=("status", "artifacts", "run", "resume", "approve", "reset"))
    p.add_argument("stage", nargs="?", choices=pipeline.STAGES)
    p.add_argument("--runs", required=True, help="folder of runs")
    p.add_argument("--config", help="configuration, JSON")
    p.add_argument("--run-id", help="a run other than the latest")
    p.add_argument("--decision", help="quality decision, JSON")
    p.add_argument("--master", help="Spark master")
    return p


def _lines(state: pipeline.RunState) -> list[str]:
    return [f"{state.run_id}: {state.status}", *[f"  {n}: {s.status}{' - ' + s.error if s.error else ''}" for n, s in state.stages.items()]]


def _go(runs: pipeline.Runs, state: pipeline.RunState, config: dict, master: str | None) -> int:
    from textloom.plans import stages
    from textloom.session import get_spark, ship

    spark = ship(get_spark(master=master))
    state = pipeline.run(runs, state, stages.steps(spark, config, str(runs.folder.resolve())))
    print("\n".join(_lines(state)))
    return 1 if state.status == "failed" else 0


def main(argv: list[str] | None = None) -> int:
    try:
        a = parser().parse_args(argv)
    except SystemExit as e:
        return 2 if e.code else 0
    runs = pipeline.Runs(a.runs)
    config = json.loads(Path(a.config).read_text()) if a.config else {}
    if a.decision:
        config.setdefault("quality", {})["decision"] = json.loads(Path(a.decision).read_text())
    if a.command == "run":
        if not config:
            print("run needs --config", file=sys.stderr)
            return 2
        return _go(runs, runs.create(a.run_id), config, a.master)
    state = runs.load(a.run_id) if a.run_id else runs.latest()
    if state is None:
        print("no run", file=sys.stderr)
        return 2
    if a.command == "status":
        print("\n".join(_lines(state)))
    elif a.command == "artifacts":
        print("\n".join(f"{n}.{k}: {v}" for n, s in state.stages.items() for k, v in sorted(s.artifacts.items())))
    elif a.command in ("approve", "reset"):
        if not a.stage:
            print(f"{a.command} needs a stage", file=sys.stderr)
            return 2
        if a.command == "reset":
            pipeline.reset(runs, state, a.stage)
        elif state.stages[a.stage].status != "awaiting_review":
            print(f"{a.stage} isn't waiting for a review", file=sys.stderr)
            return 2
        else:
            # the stage runs again, now with its decision
            state.stages[a.stage].status = "pending"
            runs.save(state)
        print("\n".join(_lines(state)))
    else:
        return _go(runs, state, config, a.master)
    return 0


if __name__ == "__main__":
    sys.exit(main())
