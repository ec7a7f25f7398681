"""All registered queries of the library."""

from quillon.plans import files, service  # noqa: F401  they register their queries
from quillon.plans.queries import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
