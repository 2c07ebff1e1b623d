"""Composed jobs: report tables, run log, report text and the batch run."""
