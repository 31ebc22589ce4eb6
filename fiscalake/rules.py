"""The parameters of a data set: valid years, lookups and thresholds.

The same plans run on any record set of the model; only the rules differ.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column

from .functions import lookups


@dataclass(frozen=True)
class Rules:
    first_year: int = 2020
    last_year: int = 2025
    state_of: Callable[[Column], Column] = lookups.state_of_place
    state_of_loose: Callable[[Column], Column] = lookups.state_of_place_loose
    region_of: Callable[[Column], Column] = lookups.region_of_state
    theme_of: Callable[[Column], Column] = lookups.theme_of_function
    period_of: Callable[[Column], Column] = lookups.period_of_year
    type_of: Callable[[Column], Column] = lookups.simple_type
    northeast: str = "Nordeste"
    north: str = "Norte"
    individual: str = "Individual"
    # Tolerance of the financial rule, discard ceiling, showcase ratio, label.
    tolerance: Decimal = Decimal("1.01")
    discard_limit: float = 0.30
    showcase_below: float = 0.1
    good_rate: int = 80

    @property
    def years(self) -> list[int]:
        return list(range(self.first_year, self.last_year + 1))


DEFAULT_RULES = Rules()
