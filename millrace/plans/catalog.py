"""All registered queries: importing the modules fills the registry."""

from millrace.plans import q_clean, q_flows, q_quality, q_sketches, q_sources, q_tables  # noqa: F401
from millrace.plans.registry import ORACLES, QUERIES  # noqa: F401
