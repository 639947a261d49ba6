"""Named queries over the shared benchmark tables, with equivalent SQL where SQL can state them."""

from . import registry
from . import (  # noqa: F401  (importing a module registers its queries)
    q_stats, q_consensus, q_support, q_compare, q_time, q_geometry, q_rules, q_audit, q_scenario, q_io,
)

QUERIES = registry.QUERIES
ORACLE_SQL = registry.ORACLE_SQL
