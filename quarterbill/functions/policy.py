"""The price policy."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Policy:
    """Yearly prices in dollars, and how much use makes a period billable."""

    # The published prices and cutoffs.
    storage_per_tb: float = 50.0
    first_power_user: float = 1000.0
    additional_power_user: float = 500.0
    period_months: int = 3
    min_use_months: int = 2

    @property
    def year_share(self) -> float:
        """Share of a yearly price that one period costs."""
        return self.period_months / 12
