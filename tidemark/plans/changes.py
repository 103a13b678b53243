"""What silver's runs have changed, for the tables that follow it."""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass

from tidemark.sources.state import Step

#: Buckets by which a run names the users it touched. A dimension's number of buckets divides it.
USER_BUCKETS = 1024
KEPT = 100  # runs that are remembered; tables further behind use their lookback


@dataclass(frozen=True)
class Changes:
    """Dates silver rewrote, or None for all from `since` on; no date before `since` has changed.

    `users` are the buckets (of USER_BUCKETS) of all users with an event that came, went or changed; None: any.
    """

    since: dt.date
    dates: list[dt.date] | None
    users: list[int] | None


def with_run(
    step: Step, run: int, since: dt.date, dates: list[dt.date] | None, users: list[int] | None
) -> str:
    """The saved list of changes with one more run's."""
    changes = json.loads(step.get("silver_changes", "[]"))
    first = min(dates, default=since) if dates is not None else since
    changes.append({"run": run, "since": first.isoformat(), "dates": dates and [d.isoformat() for d in dates], "users": users})
    return json.dumps(changes[-KEPT:])


def changes_after(step: Step, seen: object) -> Changes | None:
    """What the runs after `seen` (a run's number) have changed; None if that isn't known."""
    run = step.get("silver_run")
    if run is None or seen is None:
        return None
    known = {c["run"]: c for c in json.loads(step.get("silver_changes", "[]"))}
    found = [known.get(i) for i in range(int(seen) + 1, int(run) + 1)]
    if not found or None in found:
        return None
    since = min(dt.date.fromisoformat(c["since"]) for c in found)
    users = None if any(c["users"] is None for c in found) else sorted({u for c in found for u in c["users"]})
    if any(c["dates"] is None for c in found):
        return Changes(since, None, users)
    return Changes(since, sorted({dt.date.fromisoformat(d) for c in found for d in c["dates"]}), users)
