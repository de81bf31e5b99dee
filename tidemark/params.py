"""Every constant that carries meaning, in one immutable place.

Functions take a ``Params`` so a caller can change a threshold without touching code.
"""

from __future__ import annotations

from dataclasses import dataclass

# Tracked languages, markers and thresholds of the analysis.
PROJECTS = ("en.wikipedia", "fr.wikipedia", "de.wikipedia", "es.wikipedia", "ru.wikipedia")
TOTAL_TITLE = "-"
NO_RANK = 9999


@dataclass(frozen=True)
class Params:
    projects: tuple[str, ...] = PROJECTS
    total_title: str = TOTAL_TITLE
    no_rank: int = NO_RANK

    # emergence: each article against its own past
    history_days: int = 28
    min_history_days: int = 3
    z_threshold: float = 3.5
    min_editors: int = 3
    mad_to_sigma: float = 1.4826
    scale_floor: float = 1.0

    # hourly lead-lag
    window_hours: int = 48
    max_lead_hours: int = 12
    max_lag_hours: int = 24
    event_hours: int = 24
    min_event_edits: int = 5
    min_corr: float = 0.3
    min_overlap: int = 6
    alpha: float = 0.05

    # gates
    min_daily_edits: int = 1000
    min_in_day_share: float = 0.99
    min_view_match: float = 0.8
    max_emerging_share: float = 0.05
    min_id_rate: float = 0.5

    # entity lookups
    batch_size: int = 50

    @property
    def edit_projects(self) -> tuple[str, ...]:
        """Project names as the edit stream spells them."""
        return tuple(f"{p}.org" for p in self.projects)

    @property
    def lag_count(self) -> int:
        return self.max_lead_hours + self.max_lag_hours + 1


DEFAULTS = Params()
