"""Bars in, analytics tables out: functions from DataFrame to DataFrame."""

from barmart.schemas import Bars

__all__ = ["Bars"]
