"""Plan guards: JVM-side expressions only, no pair-forming joins."""

import contextlib
import io

import pytest

from chainstar.plans import catalog

from fixtures import SF_SMALL

# Their plans only read back written files.
WRITERS = {"k7_incremental_network", "k7_incremental_pool", "k7_incremental_block", "k7_incremental_price",
           "e7_stream_network_1d", "k1_built_network", "k3_built_obt_pool", "k6_rebuild_after_price"}


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - WRITERS))
def test_no_python_udfs_or_pairwise_joins(spark, name):
    df = catalog.QUERIES[name](spark, SF_SMALL)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    plan = buf.getvalue()
    for bad in ("EvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF"):
        assert bad not in plan, f"{name}: {bad}"
