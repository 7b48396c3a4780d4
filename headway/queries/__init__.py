"""Named queries over the given tables, each with the SQL it must agree with."""

from headway.queries import continuous, curated, serving, stateful, statistics, streamed  # noqa: F401
from headway.queries.registry import QUERIES, SQL  # noqa: F401
