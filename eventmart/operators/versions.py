"""Versioned lists of folders: what a table consists of, switched in one step.

A table of many small folders (one per micro-batch) is merged into sets, few and
large. Which sets there are, and which small folders they cover, stands in the newest file
of ``<root>/<name>``; its creation is the only step by which a merge takes effect. So a
reader sees the small folders or the set made of them, never both; a merge that died
leaves a folder that nobody lists, and is simply run again. Folders that were replaced
stay until ``sweep``, for readers that have listed them already.

Sets are merged by levels: as many folders as ``FAN`` make a set of the first level, as
many sets one of the next. So a row is written again once per level, and there are
never more than ``FAN`` sets of a level.

A single writer per list is assumed; a second one fails on the number of its version.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import SparkSession

from eventmart.operators import storage

FAN = 16


@dataclass
class State:
    """Sets (name, level and figures of theirs), and the last batch of each run that they cover."""

    sets: list[dict] = field(default_factory=list)
    covered: dict[str, int] = field(default_factory=dict)

    def covers(self, run_id: str, batch_id: int) -> bool:
        return batch_id <= self.covered.get(run_id, -1)

    def due(self, fan: int = FAN) -> list[dict]:
        """Sets of the lowest level that has as many as are merged into one, or none."""
        levels: dict[int, list[dict]] = {}
        for s in self.sets:
            levels.setdefault(s["level"], []).append(s)
        return next((levels[k] for k in sorted(levels) if len(levels[k]) >= fan), [])


class Versions:
    """The list of one table, as numbered files; the largest number counts."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _numbers(self) -> list[int]:
        names = storage.children(self.spark, self.path)
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def current(self) -> State:
        numbers = self._numbers()
        return State(**json.loads(storage.content(self.spark, self._file(numbers[-1])))) if numbers else State()

    def _file(self, number: int) -> str:
        return f"{self.path}/{number:012d}.json"

    def publish(self, state: State) -> None:
        numbers = self._numbers()
        storage.publish_text(self.spark, self._file(numbers[-1] + 1 if numbers else 0), json.dumps(asdict(state)))
        for old in numbers[:-FAN]:
            storage.delete(self.spark, self._file(old))


def batches(spark: SparkSession, table: str) -> dict[str, list[int]]:
    """Batches of each run that have a folder below ``table``, in order."""
    out = {}
    for run in storage.children(spark, table):
        if run.startswith("run_id="):
            names = storage.children(spark, f"{table}/{run}")
            out[run.removeprefix("run_id=")] = sorted(int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id="))
    return out


def folder(table: str, run_id: str, batch_id: int) -> str:
    return f"{table}/run_id={run_id}/batch_id={batch_id}"


def uncovered(spark: SparkSession, table: str, state: State, final: bool = False) -> list[tuple[str, int]]:
    """(run, batch) of the folders that no set covers; ``final`` leaves out the last one of each run, which may be repeated."""
    found = batches(spark, table).items()
    return [(r, b) for r, own in found for b in (own[:-1] if final else own) if not state.covers(r, b)]


def sweep(spark: SparkSession, table: str, sets: str, state: State) -> int:
    """Delete folders of ``table`` that sets cover, and folders of ``sets`` that aren't listed; how many there were."""
    old = [folder(table, r, b) for r, own in batches(spark, table).items() for b in own if state.covers(r, b)]
    listed = {s["name"] for s in state.sets}
    old += [f"{sets}/{n}" for n in storage.children(spark, sets) if n not in listed]
    return sum(storage.delete(spark, p) for p in old)
