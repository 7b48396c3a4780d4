"""Access decisions: who may do what, and where."""

from __future__ import annotations

import pytest

from headway.operators.access import decide

SCHEMA = (
    "principal STRING, roles ARRAY<STRING>, action STRING, "
    "targets ARRAY<STRUCT<type: STRING, name: STRING, parents: ARRAY<STRUCT<type: STRING, name: STRING>>>>"
)


def table(catalog, name="t"):
    return ("TABLE", name, [("CATALOG", catalog), ("NAMESPACE", "ns")])


def catalog(name):
    return ("CATALOG", name, [])


ADMIN, ENGINE, VIEWER = ["service_admin"], ["trino_service"], ["polaris_viewer"]
CASES = [
    # administrators: every data operation everywhere, no privilege management
    (ADMIN, "CREATE_CATALOG", [catalog("fresh_store")], True),
    (ADMIN, "DROP_TABLE_WITH_PURGE", [table("analytics")], True),
    (ADMIN, "COMMIT_TRANSACTION", [table("raw")], True),
    (ADMIN, "ADD_TABLE_SNAPSHOT", [table("raw")], True),
    (ADMIN, "SET_TABLE_SNAPSHOT_REF", [table("analytics")], True),
    (ADMIN, "SET_TABLE_PROPERTIES", [table("curated")], True),
    (ADMIN, "ADD_PRINCIPAL_GRANT_TO_PRINCIPAL_ROLE", [("PRINCIPAL_ROLE", "trino_service", [])], False),
    (ADMIN, "CREATE_PRINCIPAL", [("PRINCIPAL", "somebody", [])], False),
    (ADMIN, "CREATE_POLICY", [("POLICY", "some_policy", [])], False),
    (ADMIN, "UNHEARD_OF_REQUEST", [catalog("analytics")], False),
    # the query engine: tables, views and namespaces within the warehouses
    (ENGINE, "LOAD_TABLE_WITH_READ_DELEGATION", [table("analytics")], True),
    (ENGINE, "LOAD_TABLE_WITH_WRITE_DELEGATION", [table("curated")], True),
    (ENGINE, "LIST_NAMESPACES", [catalog("analytics")], True),
    (ENGINE, "CREATE_TABLE_DIRECT", [table("curated")], True),
    (ENGINE, "ADD_TABLE_SNAPSHOT", [table("curated")], True),
    (ENGINE, "ADD_TABLE_SNAPSHOT", [table("elsewhere")], False),
    (ENGINE, "CREATE_CATALOG", [catalog("other_store")], False),
    (ENGINE, "DELETE_CATALOG", [catalog("analytics")], False),
    (ENGINE, "CREATE_TABLE_DIRECT", [table("elsewhere")], False),
    (ENGINE, "ADD_CATALOG_ROLE_TO_PRINCIPAL_ROLE", [("PRINCIPAL_ROLE", "trino_service", [])], False),
    (ENGINE, "UNHEARD_OF_REQUEST", [table("analytics")], False),
    (ENGINE, "RENAME_TABLE", [table("curated", "x"), table("elsewhere", "x")], False),
    (ENGINE, "RENAME_TABLE", [table("curated", "x"), table("curated", "y")], True),
    # viewers: reads within the warehouses
    (VIEWER, "LOAD_TABLE_WITH_READ_DELEGATION", [table("analytics")], True),
    (VIEWER, "UPDATE_TABLE", [table("analytics")], False),
    (VIEWER, "LOAD_TABLE_WITH_WRITE_DELEGATION", [table("curated")], False),
    (VIEWER, "LOAD_TABLE", [table("elsewhere")], False),
    # nobody in particular
    ([], "LOAD_TABLE_WITH_READ_DELEGATION", [table("analytics")], False),
    (["not_a_role"], "LOAD_TABLE_WITH_READ_DELEGATION", [table("analytics")], False),
    # beyond the published cases
    (ENGINE, "LIST_CATALOGS", [], True),
    (["not_a_role", *VIEWER], "LIST_CATALOGS", [], True),
    (ENGINE, "LOAD_TABLE", [("TABLE", "t", [])], False),
    (ENGINE, "LOAD_TABLE", [("TABLE", "t", None)], False),
    (ENGINE, "LOAD_TABLE", [("TABLE", "t", [("CATALOG", "raw"), ("CATALOG", "curated")])], False),
    (ENGINE, "LOAD_TABLE", None, False),
    (ENGINE, None, [table("raw")], False),
    (None, "LOAD_TABLE", [table("raw")], False),
    (ADMIN, "LOAD_TABLE", None, True),
]


@pytest.fixture(scope="module")
def decisions(spark):
    data = [(str(i), roles, action, targets) for i, (roles, action, targets, _) in enumerate(CASES)]
    return {r.principal: r.allowed for r in decide(spark.createDataFrame(data, SCHEMA)).collect()}


@pytest.mark.parametrize("case", range(len(CASES)))
def test_case(decisions, case):
    assert decisions[str(case)] is CASES[case][3]
