"""Two-vendor claims linkage and integration on Spark DataFrames."""

from claimlink.schema import Rules

__all__ = ["Rules"]
