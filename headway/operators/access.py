"""Audit of access requests against allow-lists per role."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway import constants as c

READS = [*c.CATALOG_READ, *c.NAMESPACE_READ, *c.TABLE_READ, *c.VIEW_READ]
DATA_WRITES = [*c.NAMESPACE_WRITE, *c.TABLE_WRITE, *c.TABLE_METADATA_WRITE, *c.VIEW_WRITE]

# Role -> (operations it may ask for, whether its targets must lie in the warehouses).
RULES = {
    "service_admin": ([*READS, *c.CATALOG_WRITE, *DATA_WRITES], False),
    "trino_service": ([*READS, *DATA_WRITES], True),
    "polaris_viewer": (READS, True),
}


def target_catalog(target: Column) -> Column:
    """Catalog of a target: itself, or its one catalog parent; NULL when unclear."""
    parents = F.array_distinct(
        F.transform(F.filter(target["parents"], lambda p: p["type"] == "CATALOG"), lambda p: p["name"])
    )
    return F.when(target["type"] == "CATALOG", target["name"]).when(F.size(parents) == 1, parents[0])


def in_scope(targets: Column, warehouses: list[str] = c.WAREHOUSES) -> Column:
    """Every target lies in a known warehouse; a request without targets is in scope."""
    return F.forall(targets, lambda t: F.coalesce(target_catalog(t).isin(warehouses), F.lit(False)))


def decide(requests: DataFrame, rules: dict[str, tuple[list[str], bool]] = RULES) -> DataFrame:
    """Add ``allowed`` to rows of (principal, roles, action, targets); denied unless a rule allows.

    The rules are a handful of constant lists, so they are part of the expression and
    the log is neither joined nor shuffled.
    """
    scoped = in_scope(F.col("targets"))
    decision = F.lit(False)
    for role, (operations, needs_scope) in rules.items():
        permitted = F.array_contains("roles", role) & F.col("action").isin(operations)
        permitted = permitted & scoped if needs_scope else permitted
        decision = decision | F.coalesce(permitted, F.lit(False))
    return requests.withColumn("allowed", decision)
