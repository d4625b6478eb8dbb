"""Registered queries: each operator run over the given tables, beside the SQL it must agree with."""

from . import basics, billing, joins, log, reports, scalars, shapes, survey  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
