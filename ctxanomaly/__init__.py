"""Contextual anomaly detection as Spark DataFrame operators.

Stages: raw records -> hourly cells -> contextual z-score -> leave-one-out
context features -> isolation forest -> method-agreement reports.  Every
stage is a ``DataFrame -> DataFrame`` function with configurable keys.
"""

from ctxanomaly.config import DetectConfig

__all__ = ["DetectConfig"]
