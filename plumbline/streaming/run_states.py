"""Extension: a stream of run events through the state machine.

Each run's state and retry count live in Spark's state store; an event that isn't
allowed leaves the state as it is and says why.  Late and repeated events are
dropped by sequence number."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

EVENT = "run string, seq long, target string, artifacts array<string>, failed boolean, approved boolean"
RESULT = "run string, seq long, state string, attempts int, reason string"


def advance(events: DataFrame, doc: dict, max_attempts: int = 3) -> DataFrame:
    """events: a stream (or table) of EVENT rows; doc: the machine's document."""
    steps = {(t["from"], t["to"]): t for t in doc["transitions"]}
    gates = doc.get("gates", {})
    terminal, start = set(doc.get("terminal_states", ())), doc["states"][0]

    def one(state: str, attempts: int, e) -> tuple[str, int, str | None]:
        if state in terminal:
            return state, attempts, "TERMINAL"
        if e.target in ("BLOCKED", "CANCELLED"):
            return e.target, attempts, None
        t = steps.get((state, e.target))
        if t is None:
            return state, attempts, "NO_TRANSITION"
        if e.failed:
            blocked = attempts + 1 >= max_attempts
            return ("BLOCKED", attempts + 1, "BUDGET") if blocked else (state, attempts + 1, "FAILED")
        have = set(e.artifacts) if e.artifacts is not None else set()
        if set(t.get("required_artifacts", ())) - have:
            return state, attempts, "MISSING_ARTIFACT"
        if gates.get(t.get("gate"), {}).get("human") and not e.approved:
            return state, attempts, "NOT_APPROVED"
        return e.target, 0, None

    def run(key, batches: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        state, attempts, last = held.get if held.exists else (start, 0, -1)
        rows = pd.concat(list(batches)).sort_values("seq", kind="stable")
        out = []
        for e in rows.itertuples(index=False):
            if e.seq <= last:
                continue
            state, attempts, reason = one(state, attempts, e)
            last = int(e.seq)
            out.append((key[0], last, state, attempts, reason))
        held.update((state, attempts, last))
        yield pd.DataFrame(out, columns=["run", "seq", "state", "attempts", "reason"])

    return events.groupBy("run").applyInPandasWithState(run, RESULT, "state string, attempts int, last long", "append", GroupStateTimeout.NoTimeout)
