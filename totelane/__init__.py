"""Tote routing on Spark: plan, reconcile and dispatch conveyor routes."""

from totelane.settings import RouterSettings, SkewSettings

__all__ = ["RouterSettings", "SkewSettings"]
