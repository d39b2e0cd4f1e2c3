"""Session helpers, previews and broadcast hints."""

from pyspark.sql import functions as F

from chainstar.operators.keys import broadcast_if_small
from chainstar.operators.preview import preview
from chainstar.plans.marts import Marts, preview_model
from chainstar.session import scale_conf, session_key

from fixtures import RUN_TS, sources


def test_scale_conf_sizes_partitions():
    c = scale_conf(100 * 2 ** 40, total_cores=8000)        # 100 TB
    assert int(c["spark.sql.shuffle.partitions"]) == 100 * 2 ** 40 // (256 * 2 ** 20)
    small = scale_conf(10 * 2 ** 20, total_cores=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 24  # at least 3 per core
    assert int(c["spark.sql.files.maxPartitionBytes"]) == 256 * 2 ** 20


def test_session_key_is_stable(spark):
    assert session_key(spark) == session_key(spark)


def test_preview_orders_like_postgres(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 7), (None, 1)], "a int, b int")
    assert [r.a for r in preview(df, ["a"]).collect()] == [1, 2, 3, None]       # NULL last
    assert [r.b for r in preview(df, ["-b"], k=2).collect()] == [None, 7]     # NULL first


def test_preview_model_and_hints(spark):
    m = Marts(spark, sources(spark), run_ts=RUN_TS)
    rows = preview_model(m, "fact.block").collect()
    assert [r.blockheight for r in rows] == sorted(r.blockheight for r in rows)
    assert broadcast_if_small(m["dim.pool"], known_small=True).count() == 3
    assert broadcast_if_small(spark.range(5)).agg(F.sum("id")).first()[0] == 10
