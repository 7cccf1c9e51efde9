"""Lending-portfolio analytics as lazy Spark DataFrame operators."""

from .params import DEFAULTS, Params
from .tables import Tables

__all__ = ["DEFAULTS", "Params", "Tables"]
