"""Registered queries: each runs operators over whole tables, most with an SQL twin."""

from prepkit.queries import (  # noqa: F401
    cleaning,
    closed_forms,
    encoding,
    figures,
    files,
    flagship,
    gaps,
    jobs,
    joining,
    modelling,
    profiling,
    scoring,
    shaping,
    splitting,
    wording,
)
from prepkit.queries.registry import REGISTRY

__all__ = ["REGISTRY"]
