"""Tunables in one place."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    index_min_days: int = 4
    basket_min_retailers: int = 5
    basket_items_per_category: int = 2
    inflated_gap_bp: int = 1500
    fact_window_days: int = 7
    movers_days: int = 28


SETTINGS = Settings()
