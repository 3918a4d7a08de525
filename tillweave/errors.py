"""Errors raised to callers."""

from __future__ import annotations


class TillweaveError(Exception):
    """Any error of this package."""


class QualityError(TillweaveError):
    """The data breaks a constraint of the model."""


class ConfigError(TillweaveError):
    """A configuration table or argument is not usable."""


class SourceError(TillweaveError):
    """A source file or sheet cannot be read as a report."""
