"""Incremental table loading on Spark: extract, clean, align, apply, remember."""

from tidemark.spec import Mapping, Source, SpecError, Target, Task

__all__ = ["Mapping", "Source", "SpecError", "Target", "Task"]
