"""The refresh job and the physical-plan checks."""

from disclosure.plans.job import ConnectorSink, TableSink, run

__all__ = ["ConnectorSink", "TableSink", "run"]
