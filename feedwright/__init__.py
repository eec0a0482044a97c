"""Conform delimited retail feeds with Spark DataFrames."""

from feedwright.limits import Limits
from feedwright.session import build_session

__all__ = ["Limits", "build_session"]
