"""Trade-event medallion engine: Bronze, Silver, Gold, quality gate and export on Spark."""

from blotter.config import Config

__all__ = ["Config"]
