"""Registered queries over the given tables, each next to the SQL it must equal."""

from tidemill.plans.registry import load_all

__all__ = ["load_all"]
