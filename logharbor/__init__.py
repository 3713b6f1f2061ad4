"""Spark-native processing of GPU-telemetry log landing zones."""

from logharbor.session import prepare

__all__ = ["prepare"]
