"""Applying stages to streams."""

from rankfold.streaming.files import write_transformed

__all__ = ["write_transformed"]
