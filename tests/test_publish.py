import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, StructField, StructType

from snapmetrics.plans import columns as C
from snapmetrics.plans import jobs as J
from snapmetrics.plans import publish as P


def _sheet_rows(spark):
    cols = C.SHEET_SUBGRAPHS + ["active"]
    base = {c: None for c in cols}
    d = dt.date(2024, 1, 30)
    rows = []
    for sid, apr, sig, active, day in [
        ("a", None, 5.0, True, d),
        ("b", 0.5, 1.0, True, d),
        ("c", 0.5, 3.0, True, d),
        ("d", 0.9, 1.0, True, d),
        ("e", 0.95, 1.0, False, d),
        ("f", 0.99, 1.0, True, d - dt.timedelta(days=1)),
        ("g", 0.5, 3.0, True, d),
    ]:
        r = dict(base, subgraph_id=sid, curator_apr_30d_estimate=apr, signal=sig, active=active, date=day)
        rows.append(r)
    schema = ", ".join(
        f"{c} {'string' if c in ('subgraph_id', 'display_name') else 'date' if c == 'date' else 'boolean' if c == 'active' else 'double'}"
        for c in cols
    )
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], schema)


def test_sheet_sort_x12(spark):
    got = [r.subgraph_id for r in P.sheet_subgraphs(_sheet_rows(spark)).collect()]
    assert got == ["d", "c", "g", "b", "a"]


def test_column_formats_later_ranges_win():
    f = P.column_formats(C.SHEET_SUBGRAPHS, C.FORMATS_SUBGRAPHS)
    assert f["date"] == "yyyy-mm-dd"
    assert f["curator_apr_30d_estimate"] == "0.00%"
    assert f["QF_30d"] == "#,##0.00"
    assert f["signal"] == "#,##0"
    assert f["price_growth_30d"] == "0.00%"
    g = P.column_formats(C.SHEET_GLOBAL, C.FORMATS_GLOBAL)
    assert g["signal_per_stake"] == "0.0000%" and g["QF_total"] == "#,##0.00" and g["stake"] == "#,##0"


def test_text_view_patterns(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 2), 0.12345, 1234567.891, 2.5)], "date date, a double, b double, c double")
    out = P.text_view(df, [("A:A", "yyyy-mm-dd"), ("B:B", "0.00%"), ("C:C", "#,##0.00"), ("D:D", "#,##0")]).first()
    assert (out.date, out.a, out.b, out.c) == ("2024-01-02", "12.35%", "1,234,567.89", "2")


def test_csv_roundtrip_keeps_types(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 2), 1.5, "x", 3)], "date date, v double, s string, n bigint")
    back = P.csv_roundtrip(df)
    assert back.schema == P.schema_like(df) and back.collect() == df.collect()


def test_run_all_writes_outputs(spark, tmp_path):
    paths = P.run_all(spark, "/root/testdata/sf0.001", str(tmp_path))
    assert set(paths) == {"allocations", "global", "subgraphs"}
    assert paths["global"].endswith("/global_01_30_2024") and paths["subgraphs"].endswith("/subgraphs_01_30_2024")
    view = P.republish_global(spark, paths["global"])
    assert view.columns == C.OUT_GLOBAL and view.count() == 30
    dates = [r.date for r in view.collect()]
    assert dates == sorted(dates, reverse=True)
    s = spark.read.option("header", True).csv(paths["subgraphs"])
    assert s.columns == C.OUT_SUBGRAPHS and s.count() == 450
    sheet, label = P.published(spark, str(tmp_path), "subgraphs_sheet")
    assert sheet.columns == C.SHEET_SUBGRAPHS and sheet.count() > 0 and label == "Last updated: 01-31-2024"
    a = P.read_csv(spark, paths["allocations"], P.allocations_csv_schema())
    assert a.columns == C.OUT_ALLOCATIONS and a.count() > 0



def test_label_and_sheet_of_run_all(spark, tmp_path):
    from snapmetrics.plans import jobs as J

    assert P.run_label(dt.date(2024, 1, 31)) == "Last updated: 01-31-2024"
    P.run_all(spark, "/root/testdata/sf0.001", str(tmp_path), specs=(J.GLOBAL,))
    assert P.published(spark, str(tmp_path), "global_sheet")[1] == "Last updated: 01-31-2024"


def test_a_cluster_without_a_shared_folder_is_an_error():
    import pytest

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(ValueError):
        P.shared_dir(Session())


def test_dated_output_is_dealt_by_more_than_the_date(spark):
    df = spark.range(2000).selectExpr("DATE '2024-01-01' + CAST(id % 3 AS INT) AS date", "CAST(id AS STRING) AS subgraph_id")
    spread = df.repartition(4).repartitionByRange(8, "date", "subgraph_id").select(F.spark_partition_id().alias("p"))
    assert spread.distinct().count() == 8


SCHEMA = StructType([StructField("a", DoubleType()), StructField("b", DoubleType()), StructField("d", DateType())])


def _write_lines(tmp_path, name, *files):
    (tmp_path / name).mkdir()
    for i, lines in enumerate(files):
        (tmp_path / name / f"part-{i}.csv").write_text("\n".join(lines) + "\n")
    return str(tmp_path / name)


def test_csv_is_read_by_name(spark, tmp_path):
    path = _write_lines(tmp_path, "x", ["d,more,b,a", "2024-01-02,z,2.0,1.0", ",,,"])
    rows = P.read_csv(spark, path, SCHEMA)
    assert rows.columns == ["a", "b", "d"]
    assert sorted(map(tuple, rows.collect()), key=str) == [(1.0, 2.0, dt.date(2024, 1, 2)), (None, None, None)]


def test_csv_refuses_a_missing_column_and_a_second_header(spark, tmp_path):
    with pytest.raises(ValueError, match="no column b"):
        P.read_csv(spark, _write_lines(tmp_path, "x", ["a,d", "1.0,2024-01-02"]), SCHEMA)
    path = _write_lines(tmp_path, "y", ["a,b,d", "1.0,2.0,2024-01-02"], ["b,a,d", "1.0,2.0,2024-01-02"])
    with pytest.raises(Exception, match="(?i)header"):
        P.read_csv(spark, path, SCHEMA).collect()


def test_a_bad_number_fails_or_goes_to_the_bad_rows(spark, tmp_path):
    path = _write_lines(tmp_path, "x", ["b,a,d", "2.0,1.0,2024-01-02", "n/a,5.0,2024-01-02", "3.0,4.0,yesterday"])
    with pytest.raises(Exception, match="(?i)malformed"):
        P.read_csv(spark, path, SCHEMA).collect()
    # Also where the plan does not use the bad column.
    with pytest.raises(Exception, match="(?i)malformed"):
        P.read_csv(spark, path, SCHEMA).select("a").collect()
    good, bad = P.read_csv_checked(spark, path, SCHEMA)
    assert [r.a for r in good.select("a").collect()] == [1.0]
    assert [tuple(r) for r in good.collect()] == [(1.0, 2.0, dt.date(2024, 1, 2))]
    assert sorted(r[P.BAD_LINE] for r in bad.collect()) == ["3.0,4.0,yesterday", "n/a,5.0,2024-01-02"]
    assert P.read_csv(spark, _write_lines(tmp_path, "y"), SCHEMA).count() == 0


def test_a_reader_sees_the_last_complete_version(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        P.published(spark, base, "sheet")
    P.publish(spark.range(3).toDF("n"), base, "sheet", "first")
    bad = spark.range(5).select(F.raise_error(F.lit("lost")).cast("long").alias("n"))
    with pytest.raises(Exception, match="lost"):
        P.publish(bad, base, "sheet", "second")
    view, label = P.published(spark, base, "sheet")
    assert (view.count(), label) == (3, "first")
    P.publish(spark.range(7).toDF("n"), base, "sheet", "third")
    view, label = P.published(spark, base, "sheet")
    assert (view.count(), label) == (7, "third")


def test_a_second_run_goes_on_where_the_first_died(spark, tmp_path, monkeypatch):
    made = []
    frame = lambda name, n: spark.range(n).select(F.col("id").alias("n"), F.lit(name).alias("job"))

    def run(die: bool):
        def allocations(spec):
            made.append("allocations")
            return frame("allocations", 3)

        def subgraphs(spec, fs):
            made.append("subgraphs")
            if die:
                raise RuntimeError("killed")
            return frame("subgraphs", 4).withColumn("date", F.lit(dt.date(2024, 1, 30))).withColumn("fs", fs)

        def split(path):
            made.append("split")
            return spark.read.option("header", True).csv(path).agg(F.sum("n").cast("double")).scalar()

        specs = [J.ALLOCATIONS, J.with_spec(J.SUBGRAPHS, upload=False)]
        return P.run_jobs(spark, str(tmp_path), specs, allocations, split, {"subgraphs": subgraphs})

    monkeypatch.setattr(J, "allocations_output", lambda df: df)
    monkeypatch.setattr(J, "job_output", lambda df, spec: df)
    with pytest.raises(RuntimeError):
        run(True)
    assert made == ["allocations", "split", "subgraphs"]
    paths = run(False)
    assert made == ["allocations", "split", "subgraphs", "subgraphs"]
    rows = spark.read.option("header", True).csv(paths["subgraphs"]).collect()
    assert paths["subgraphs"].endswith("subgraphs_01_30_2024") and len(rows) == 4 and rows[0].fs == "3.0"
    assert run(False) == paths and len(made) == 4
