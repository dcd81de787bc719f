"""Errors raised on the driver when a contract between stages or inputs is broken."""


class AnalysisError(Exception):
    """Base class of every error this package raises on purpose."""


class SourceError(AnalysisError):
    """An input path is missing, empty or cannot be read as the declared format."""


class ContractError(AnalysisError):
    """A table does not satisfy the schema or value contract of an operator."""


class SinkError(AnalysisError):
    """A result could not be written."""
