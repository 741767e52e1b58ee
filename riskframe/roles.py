"""Column roles by name (the reference addressed them by position)."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Roles:
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    label: str = "class"
    key: str = "app_id"
    positive: int = 2          # "bad" outcome
    negative: int = 1
    label_text: dict = field(default_factory=lambda: {1: "Good Credit", 2: "Bad Credit"})

    @property
    def features(self) -> tuple[str, ...]:
        return self.numeric + self.categorical


# Role assignment for the `applications` view (see FIXTURES.md §2).
APPLICATION_ROLES = Roles(
    numeric=("total_price", "acct_balance", "n_lines", "qty", "max_discount", "max_tax", "cust_orders"),
    categorical=("priority", "segment", "nation", "region", "order_year", "order_quarter", "order_month",
                 "top_flag", "low_flag", "top_status", "low_status", "balance_band", "lines_band"),
)
