"""Progress of a run: log lines, and a state document that is rewritten as stages begin and end."""

from __future__ import annotations

import datetime
import json
import logging
import threading

from pyspark.util import InheritableThread

from ..sources.storage import Stages

log = logging.getLogger("quillmine")
STAGES = ("chunks", "candidates", "deduped", "clusters", "merged_topics", "scores", "final_topics")


def now() -> str:
    return datetime.datetime.now().isoformat(timespec="seconds")


class Heartbeat:
    """Reports, while a block runs, how far something has come: every ``interval`` steps, looked at once a ``pause``, and at the end."""

    def __init__(self, look, report, interval: int = 1, pause: float = 1.0):
        self.look, self.report, self.interval, self.pause = look, report, max(1, interval), pause
        self.told, self.over = 0, threading.Event()
        self.thread = InheritableThread(target=self._watch, daemon=True)

    def _watch(self) -> None:
        while not self.over.wait(self.pause):
            self._tell(self.interval)

    def _tell(self, least: int) -> None:
        done = self.look()
        if done - self.told >= least:
            self.told = done
            self.report(done)

    def __enter__(self) -> Heartbeat:
        self.thread.start()
        return self

    def __exit__(self, *_) -> None:
        self.over.set()
        self.thread.join()
        self._tell(1)


class Progress:
    """Writes run_state.json: status, current stage, counts of rows, times; an error if there was one."""

    def __init__(self, stages: Stages, **facts):
        self.stages, self.facts, self.counts, self.call_state = stages, facts, {}, {}
        self.started: str | None = None

    def write(self, status: str, **more) -> None:
        state = self.facts | {"status": status, "started_at": self.started, "updated_at": now(), "counts": self.counts, "calls": self.call_state} | more
        self.stages.write_text(f"{self.stages.root}/run_state.json", json.dumps(state, ensure_ascii=False, indent=2))

    def begin(self, entry: str) -> None:
        self.facts, self.started, self.counts = self.facts | {"entry": entry}, now(), {}
        self.call_state = {}
        self.write("running")

    def done(self, stage: str, rows: int) -> None:
        self.counts[stage] = rows
        at = f"{STAGES.index(stage) + 1}/{len(STAGES)}" if stage in STAGES else "-"
        log.info("[%s] %s: %d rows", at, stage, rows)
        if self.started:
            self.write("running", current_stage=stage)

    def calls(self, stage: str, done: int, of: int, mode: str | None = None) -> None:
        """``mode`` says at the beginning whether answers are generated, resumed or all reused; then answers kept, of how many."""
        state = self.call_state.setdefault(stage, {})
        state |= {"mode": mode, "asked": state.get("asked", 0) + of} if mode else {"answered": f"{done}/{of}"}
        log.info("%s: %s", stage, f"{mode}, {of} calls to make" if mode else f"{done} of {of} answers")
        if self.started:
            self.write("running", current_stage=stage)

    def end(self, error: Exception | None = None) -> None:
        if error is None:
            self.write("completed", finished_at=now())
        else:
            log.error("failed: %s", error)
            self.write("failed", finished_at=now(), error=f"{type(error).__name__}: {error}"[:2000])
