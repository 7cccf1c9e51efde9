"""The set of base tables that every operator reads."""

from dataclasses import dataclass
from typing import Optional

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Tables:
    customers: DataFrame
    products: DataFrame
    channels: DataFrame
    loans: DataFrame
    schedule: DataFrame
    payments: DataFrame
    collections: DataFrame
    macro: Optional[DataFrame] = None
    # monthly flows written earlier (see plans.layout); the operators then skip the raw rows
    flows: Optional[DataFrame] = None

    def by_name(self) -> dict:
        """Table name -> frame, parents before children."""
        named = {
            "dim_customers": self.customers,
            "dim_products": self.products,
            "dim_channels": self.channels,
            "fct_loans": self.loans,
            "fct_schedule": self.schedule,
            "fct_payments": self.payments,
            "fct_collections": self.collections,
        }
        if self.macro is not None:
            named["dim_macro_monthly"] = self.macro
        return named
