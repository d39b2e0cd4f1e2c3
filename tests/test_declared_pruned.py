"""K4 declared tables, J3 bucketed join, K7 pruning, E5 tail, default-member split: plans and refusals."""

import contextlib
import io
import math
import uuid

import pytest
from pyspark.sql import functions as F

from chainstar.functions.numeric import poisson_at_least
from chainstar.operators.sinks import insert_declared
from chainstar.operators.star import Arm, drill_across
from chainstar.plans import catalog, dims
from chainstar.plans.marts import Marts
from chainstar.plans.obts import obt_block

from fixtures import RUN_TS, SF_SMALL, sources

COLUMNS = [("id", "INT", True), ("name", "VARCHAR(4)", False), ("day", "DATE", False)]


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _insert(spark, tmp_dir, rows, schema):
    return insert_declared(spark.createDataFrame(rows, schema), f"declared.t_{uuid.uuid4().hex}", COLUMNS, f"{tmp_dir}/t")


def test_declared_types_come_back(spark, tmp_dir):
    got = _insert(spark, tmp_dir, [("x", 7, None)], "name string, id bigint, day date")
    assert got.dtypes == [("id", "int"), ("name", "string"), ("day", "date")]
    assert [tuple(r) for r in got.collect()] == [(7, "x", None)]


@pytest.mark.parametrize("rows,schema", [
    ([(None, "x", None)], "id int, name string, day date"),               # NULL in a not-null column
    ([(2 ** 40, "x", None)], "id bigint, name string, day date"),          # does not fit an int
    ([(1, "too long", None)], "id int, name string, day date"),            # does not fit varchar(4)
    ([(1, "x", "2024-01-01")], "id int, name string, day string"),         # text is not a date
])
def test_declared_tables_refuse_what_does_not_fit(spark, tmp_dir, rows, schema):
    with pytest.raises(Exception):
        _insert(spark, tmp_dir, rows, schema)


def test_calendar_fits_its_declared_schema(spark, tmp_dir):
    columns = [(c, kind, True) for c, kind in dims.CALENDAR_TYPES.items()]
    cal = dims.calendar(spark)
    assert [c for c, _, _ in columns] == cal.columns
    got = insert_declared(cal, f"dim.date_{uuid.uuid4().hex}", columns, f"{tmp_dir}/date")
    assert got.count() == 29220 and got.exceptAll(cal).count() == 0


def test_bucketed_block_tables_join_without_a_shuffle(spark):
    df = catalog.QUERIES["j3_obt_block_bucketed"](spark, SF_SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")      # as for tables too large to broadcast
    try:
        plan = _plan(df.select("*"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(block_id" not in plan and "SortMergeJoin" in plan


def test_days_are_pruned_at_run_time(spark):
    assert "dynamicpruning" in _plan(catalog.QUERIES["k7_pruned_weekends"](spark, SF_SMALL))


def test_block_table_from_one_row_equals_the_star_join(spark):
    m = Marts(spark, sources(spark), run_ts=RUN_TS, persist_shared=False)
    star = obt_block(m["fact.block"], m["dim.block"], m["dim.date"], m["dim.pool"])
    one = m["obt.block"]
    assert one.columns == star.columns and one.count() == 4
    assert one.exceptAll(star).count() == 0 and star.exceptAll(one).count() == 0
    assert one.filter("pool_id = '0'").select("pool_name", "is_antpool_friend").distinct().collect() == [("[Unknown]", None)]


def test_default_member_takes_no_part_in_the_join(spark):
    base = spark.createDataFrame([(k, "0" if k % 3 else f"d{k % 2}") for k in range(30)] + [(99, "absent")], "k int, id string")
    dim = spark.createDataFrame([("0", "[Unknown]", None), ("d0", "even", 1), ("d1", "odd", 2)], "id string, name string, n int")
    arm = Arm(dim, on=["id"], default={"id": "0", "name": "[Unknown]"}, spread=["k"])
    got = drill_across(base, [arm], ["k", "id", "name", "n"])
    want = base.join(dim, "id").select("k", "id", "name", "n")
    assert got.count() == 30 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_poisson_tail(spark):
    cases = [(k, m) for m in (1e-9, 0.3, 1.0, 5.5, 40.0, 900.0) for k in (0, 1, 2, 5, 17, 40, 41, 900, 1000)]
    rows = spark.createDataFrame(cases, "k long, m double").select("k", "m", poisson_at_least(F.col("k"), F.col("m")).alias("p"))

    def terms(lo, hi, m):
        return math.fsum(math.exp(i * math.log(m) - m - math.lgamma(i + 1)) for i in range(lo, hi))

    for r in rows.collect():
        want = terms(r.k, r.k + 800, r.m) if r.k > r.m else 1 - terms(0, r.k, r.m)
        assert math.isclose(r.p, want, rel_tol=1e-9 if r.k > r.m else 0, abs_tol=0 if r.k > r.m else 1e-11), r
    odd = spark.createDataFrame([(1, 0.0), (1, None), (None, 2.0)], "k long, m double")
    assert [r[0] for r in odd.select(poisson_at_least(F.col("k"), F.col("m"))).collect()] == [None, None, None]
