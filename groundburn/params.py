"""Every number the analytics depend on, in one immutable object."""

from __future__ import annotations

from dataclasses import dataclass

LOW = "bajo"
HIGH = "alto"


@dataclass(frozen=True)
class Params:
    # Fuel burnt per taxi minute (kg), low and high scenario,
    # and kg of CO2 per kg of fuel.
    fuel_low: float = 6.0
    fuel_high: float = 12.0
    co2_factor: float = 3.16

    # Longer taxi times stay in the data but are left out of the totals.
    taxi_cap: float = 180.0

    # Expected calendar.
    years: tuple[int, ...] = (2023, 2024, 2025)
    months: tuple[int, ...] = tuple(range(1, 13))

    # Weather thresholds.
    heavy_rain_mm: float = 5.0
    strong_wind_kmh: float = 40.0

    # Rankings keep airports / routes with strictly more flights than this.
    ranking_floor: int = 50_000
    route_floor: int = 5_000

    # Savings scenario and "excessive taxi" definition.
    cut_share: float = 0.10
    excess_quantile: float = 0.9

    def rate(self, scenario: str) -> float:
        """Fuel rate of a scenario, kg per taxi minute."""
        try:
            return {LOW: self.fuel_low, HIGH: self.fuel_high}[scenario]
        except KeyError:
            raise ValueError(f"unknown scenario {scenario!r}") from None
