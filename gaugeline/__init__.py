"""Sensor telemetry on Spark: parse, validate, de-duplicate, alert, archive, index, snapshot."""

from gaugeline.session import configure

__all__ = ["configure"]
