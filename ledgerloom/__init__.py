"""ledgerloom: retail cleaning, star-schema loading and reporting as Spark jobs."""

__all__ = ["config", "functions", "operators", "plans", "presets", "session", "sources", "streaming"]
