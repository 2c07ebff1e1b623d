"""Named queries over the given tables, each with its SQL check where SQL can say it."""

from flowgauge.registry.entry import ENTRIES
from flowgauge.registry import cleaning, evaluation, ingest, modelling, reporting, sampling, streaming, versions  # noqa: F401

__all__ = ["ENTRIES"]
