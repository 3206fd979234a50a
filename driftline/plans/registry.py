"""All registered queries and their SQL."""

from driftline.plans import composites, jobs, models, panel, streams, tables  # noqa: F401  they register their queries
from driftline.plans.catalog import ORACLE_SQL, QUERIES  # noqa: F401
