"""Bulk work on oceanographic profiling-float data, on Spark."""

from profilelake.flavour import BIOGEOCHEMICAL, CORE, Flavour, flavour, flavours

__all__ = ["BIOGEOCHEMICAL", "CORE", "Flavour", "flavour", "flavours"]
