"""Every registered query with the SQL that states the same result."""

from . import registry
from . import cdc_cases, feature_cases, flow_cases, gold_cases, governance_cases  # noqa: F401
from . import graph_cases, identity_cases, ingest_cases, quality_cases, stream_cases  # noqa: F401

QUERIES = registry.QUERIES
ORACLES = registry.ORACLES
