"""The registered queries; importing the package registers them all."""

from tasklens.plans import (  # noqa: F401
    commands,
    events,
    ingest,
    naming,
    questions,
    registries,
    scalars,
    states,
    streams,
)
from tasklens.plans.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
