"""Registered queries over the supplied tables, with equivalent SQL."""

from importlib import import_module

from .registry import ORACLE, QUERIES

for _m in ("events", "billing", "migration", "content", "metrics", "storage"):
    import_module(f"{__name__}.{_m}")

__all__ = ["ORACLE", "QUERIES"]
