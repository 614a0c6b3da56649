"""The operators bound to the tables of a data folder: queries, and their SQL twins."""

from wordtide.plans.bounded import BOUNDED
from wordtide.plans.streams import STREAMS

__all__ = ["BOUNDED", "STREAMS"]
