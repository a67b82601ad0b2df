"""Tabular and text preparation on Spark: load, profile, validate, encode, split and score."""

from sparkprep.schema import COMPLAINTS, SchemaSpec
from sparkprep.session import get_spark

__all__ = ["COMPLAINTS", "SchemaSpec", "get_spark"]
