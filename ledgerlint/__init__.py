"""ledgerlint: data-quality rules and delivery-completeness checks on Spark."""

from ledgerlint.params import RunParams

__all__ = ["RunParams"]
