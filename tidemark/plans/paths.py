"""Where the tables live."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Paths:
    """All tables, state and stream checkpoints below one root."""

    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/raw/events"

    @property
    def logs(self) -> str:
        return f"{self.root}/raw/logs"

    @property
    def rejected(self) -> str:
        return f"{self.root}/raw/rejected"

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/events"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/events"

    @property
    def dimension(self) -> str:
        return f"{self.root}/warehouse/dim_user_scd"

    @property
    def marts(self) -> str:
        return f"{self.root}/warehouse/marts"

    @property
    def checks(self) -> str:
        return f"{self.root}/warehouse/checks"

    @property
    def schemas(self) -> str:
        return f"{self.root}/_schemas"

    @property
    def state(self) -> str:
        return f"{self.root}/_state"

    def stream(self, job: str) -> str:
        return f"{self.root}/_streams/{job}"
