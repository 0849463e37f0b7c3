"""Shop visitor and advertising analytics on Spark DataFrames."""

from shoptrail.params import TaskParams
from shoptrail.runtime import build_session

__all__ = ["TaskParams", "build_session"]
