"""Every registered query against its SQL on the smallest tables."""

import pytest

from cellmend.plans import CATALOG, oracles, queries
from tests.oracle_check import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def plan_is_sound(df):
    """No Python per row and no blow-up of pairs."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct"):
        assert node not in plan


@pytest.mark.parametrize("name", list(CATALOG))
def test_query_equals_its_sql(spark, duck, name):
    problem, _ = difference(spark, duck, SF_DIR, name, plan_is_sound)
    assert problem is None


def test_check_notices_a_wrong_row(spark, duck):
    from cellmend.plans.catalog import Entry
    right = CATALOG["norm_upper"]
    CATALOG["norm_upper"] = Entry(right.run, right.oracle.replace("upper(raw)", "raw"))
    try:
        assert "rows differ" in difference(spark, duck, SF_DIR, "norm_upper")[0]
    finally:
        CATALOG["norm_upper"] = right


def test_types_equal_too(spark, duck):
    spark_types = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
                   "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}
    for name, sql in oracles().items():
        if name.startswith(("stream", "scan", "read", "write", "csv_")):
            continue  # these run jobs to build their plan; their rows are compared above
        got = {f.name: spark_types.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in queries()[name](spark, SF_DIR).schema.fields}
        want = {row[0]: row[1] for row in duck.execute(f"DESCRIBE {sql}").fetchall()}
        assert got == want, name
