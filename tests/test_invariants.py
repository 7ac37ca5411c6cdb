"""Relations that must hold on the fixtures (survey §5, item 4)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from snapmetrics.plans import jobs as J


def test_qf_7d_telescopes(tables):
    frame = J.subgraphs_frame(tables, F.lit(0.05))
    w = Window.partitionBy("subgraph_id").orderBy("block", "stamp")
    chk = frame.select(
        "QF_7d", (F.col("QF_total") - F.lag("QF_total", 7).over(w)).alias("tele"), F.row_number().over(w).alias("rn")
    ).where("rn >= 8")
    bad = chk.where(F.abs(F.col("QF_7d") - F.col("tele")) > 1e-6).count()
    assert chk.count() > 0 and bad == 0


def test_subgraph_totals_sum_to_network(tables):
    subs = J.subgraphs_rollup(J.versions_clean(tables)).groupBy("block").agg(F.sum("QF_total").alias("s"))
    net = J.global_clean(tables, J.with_spec(J.GLOBAL, days=30)).select("block", "QF_total")
    joined = subs.join(net, "block")
    assert joined.count() == 30
    assert joined.where(F.abs(F.col("s") - F.col("QF_total")) > 1e-6).count() == 0


def test_windows_and_names_keep_row_count(tables):
    rolled = J.subgraphs_rollup(J.versions_clean(tables))
    assert rolled.count() == J.subgraphs_windows(rolled).count() == 450


def test_fee_split_in_expected_range(tables):
    v = tables.spark.range(1).select(J.fee_split_of(tables).alias("f")).first().f
    assert 0.04 < v < 0.06
