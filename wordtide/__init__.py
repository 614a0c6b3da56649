"""Text metrics of message streams on Spark."""

from wordtide import fixed, functions, operators, sources, streaming

__all__ = ["fixed", "functions", "operators", "sources", "streaming"]
