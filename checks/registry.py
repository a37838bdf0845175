"""All queries, by importing the modules that register them."""

from checks import flow, kpi, model, quality, sources  # noqa: F401
from checks.base import ORACLES, QUERIES  # noqa: F401
