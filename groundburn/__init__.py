"""Ground-taxi time, fuel and CO2 analytics on Spark."""

from groundburn.params import Params

__all__ = ["Params"]
