"""The operators applied to the given tables, each with its SQL counterpart."""

from zonepulse.plans import chains, cleaning, impact, ingest, profiles, traffic  # noqa: F401
from zonepulse.plans.registry import CATALOG

__all__ = ["CATALOG"]
