"""Sinks, sheet views and the run-all driver (survey A11–A15, B8, C3, G4, G5,
I9, I12, L4–L7).

The source writes CSV files, uploads them and rewrites a spreadsheet.  Here
every output is a DataFrame written by Spark to a shared location; the
"latest" views are plain DataFrames that a caller can save as a table.
Credentials, uploads and sheet styling are remote UI and are not built.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, StringType, StructField, StructType

from snapmetrics.operators.relations import latest_active
from snapmetrics.plans import columns as C
from snapmetrics.plans import jobs as J
from snapmetrics.sources import fixtures as fx


# --- shared storage -------------------------------------------------------------


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder named by ``spark.checkpoint.dir``.

    Our own folder is set only where the setting is unset in a local session
    (tests); a cluster without one is an error, since its executors do not
    see each other's disks.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = "/tmp/snapmetrics-checkpoints"
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/snapmetrics/{name}-{uuid.uuid4().hex}"


# --- CSV sink and source (A11-A14) ----------------------------------------------


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """Chosen columns, header, overwriting the earlier run."""
    out = df.select(*columns) if columns else df
    out.write.mode("overwrite").option("header", True).csv(path)


BAD_LINE = "_bad_line"


def _file_schema(spark: SparkSession, path: str, schema: StructType) -> StructType | None:
    """The declared columns in the order of the file's header, others as text;
    None for a folder without any line."""
    try:
        names = spark.read.option("header", True).csv(path).columns
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":  # no file in the folder
            raise
        names = []
    if not names:
        return None
    missing = [f.name for f in schema.fields if f.name not in names]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}; its header is {', '.join(names)}")
    declared = {f.name: f for f in schema.fields}
    return StructType([declared.get(n, StructField(n, StringType(), True)) for n in names])


def _csv_reader(spark: SparkSession, schema: StructType, mode: str):
    # Every file's header is held against the schema.
    return spark.read.option("header", True).option("enforceSchema", False).option("mode", mode).schema(schema)


def _all_parsed(schema: StructType) -> Column:
    """True of every row, but needs all declared columns: the reader parses
    only what a plan uses, and a row is bad whichever columns are used."""
    return F.length(F.xxhash64(*[f"`{f.name}`" for f in schema.fields]).cast("string")) > 0


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with header and declared types (dates parsed by type).

    Columns are matched by name, in whatever order the header has them;
    columns that are not declared are left out.  A missing column, a file
    with another header and a value that does not parse are errors (T2).
    """
    found = _file_schema(spark, path, schema)
    if found is None:
        return spark.createDataFrame([], schema)
    rows = _csv_reader(spark, found, "FAILFAST").csv(path).where(_all_parsed(schema))
    return rows.select(*[f"`{f.name}`" for f in schema.fields])


def read_csv_checked(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """``read_csv`` with a channel for bad rows: (the rows that parse, the
    others with their whole line as ``BAD_LINE`` and the values that did)."""
    found = _file_schema(spark, path, schema)
    names = [f"`{f.name}`" for f in schema.fields]
    if found is None:
        empty = spark.createDataFrame([], schema)
        return empty, empty.withColumn(BAD_LINE, F.lit(None).cast("string"))
    marked = StructType([*found.fields, StructField(BAD_LINE, StringType(), True)])
    rows = _csv_reader(spark, marked, "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_LINE).csv(path)
    rows = rows.where(_all_parsed(schema))
    bad = F.col(BAD_LINE).isNotNull()
    return rows.where(~bad).select(*names), rows.where(bad).select(*names, BAD_LINE)


def schema_like(df: DataFrame) -> StructType:
    return StructType([StructField(f.name, f.dataType, True) for f in df.schema.fields])


def csv_roundtrip(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Write to the shared folder as CSV and read it back with the same types."""
    spark = df.sparkSession
    out = df.select(*columns) if columns else df
    path = scratch_path(spark, "csv")
    write_csv(out, path)
    return read_csv(spark, path, schema_like(out))


def global_csv_schema() -> StructType:
    """Schema of the saved global output: ``date`` parsed as a date."""
    return StructType(
        [StructField("date", DateType(), True)] + [StructField(c, DoubleType(), True) for c in C.OUT_GLOBAL[1:]]
    )


# --- sheet views (L4, L5) ---------------------------------------------------------


def sheet_subgraphs(frame: DataFrame, top: Column | None = None) -> DataFrame:
    """L4: latest date, active only, best 30-day curator yield first (nulls
    last), then signal, then key (G4).  ``top``: the latest date, where it
    can be had without the frame (``jobs.latest_date``)."""
    view = latest_active(frame, top=top).select(*C.SHEET_SUBGRAPHS)
    return view.orderBy(
        F.col("curator_apr_30d_estimate").desc_nulls_last(),
        F.col("signal").desc_nulls_last(),
        F.col("subgraph_id").asc(),
    )


def sheet_global(frame: DataFrame) -> DataFrame:
    """The whole global frame, newest first (G5), ties by block and stamp
    where the frame has them."""
    ties = [c for c in ("block", "stamp") if c in frame.columns]
    ordered = frame.orderBy(*[F.col(c).desc() for c in ("date", *ties)])
    return ordered.select(*C.SHEET_GLOBAL)


def run_label(run_date: _dt.date, prefix: str = "Last updated: ") -> str:
    """The published view's label, the run date as ``MM-dd-yyyy``."""
    return prefix + run_date.strftime("%m-%d-%Y")


# --- display formats (I12) --------------------------------------------------------


def _letters_to_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - ord("A") + 1)
    return n - 1


def column_formats(columns: list[str], ranges: list[tuple[str, str]]) -> dict[str, str]:
    """Resolve spreadsheet ranges (``"D:S"``) to column names; later ranges win."""
    out: dict[str, str] = {}
    for rng, pattern in ranges:
        a, b = rng.split(":")
        for i in range(_letters_to_index(a), _letters_to_index(b) + 1):
            if i < len(columns):
                out[columns[i]] = pattern
    return out


def _format(c: Column, pattern: str) -> Column:
    """Spreadsheet pattern -> text.  Number patterns are Java DecimalFormat
    patterns too (half-even rounding, ``%`` multiplies by 100)."""
    if pattern == "yyyy-mm-dd":
        return F.date_format(c, "yyyy-MM-dd")
    return F.call_function("format_number", c.cast("double"), F.lit(pattern))


def text_view(view: DataFrame, ranges: list[tuple[str, str]]) -> DataFrame:
    """Every formatted column as display text; others cast to text."""
    fmts = column_formats(view.columns, ranges)
    return view.select(
        *[(_format(F.col(c), fmts[c]) if c in fmts else F.col(c).cast("string")).alias(c) for c in view.columns]
    )


# --- published versions (A15) -----------------------------------------------------


def _pointers(spark: SparkSession, base: str, name: str) -> DataFrame | None:
    """Every version ever published, or None before the first."""
    try:
        return spark.read.schema("number long, version string").json(f"{base}/{name}/pointers")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _newest(pointers: DataFrame):
    return pointers.orderBy(F.col("number").desc(), F.col("version").desc()).first()


def publish(view: DataFrame, base: str, name: str, label: str) -> str:
    """Publish a sheet view as the latest version of ``name``.

    View and label are written to a folder of their own, and one pointer to
    it last.  Pointers are only ever added, so a reader sees the version
    before or this one, never an empty or half-written view; a run that dies
    on the way leaves the latest version as it was.  Returns the folder.
    """
    spark = view.sparkSession
    version = uuid.uuid4().hex
    path = f"{base}/{name}/{version}"
    view.write.parquet(f"{path}/view")
    spark.range(1).select(F.lit(label).alias("value")).write.text(f"{path}/label")
    before = _pointers(spark, base, name)
    number = 1 if before is None else _newest(before).number + 1
    pointer = spark.range(1, numPartitions=1).select(F.lit(number).cast("long").alias("number"), F.lit(version).alias("version"))
    pointer.write.mode("append").json(f"{base}/{name}/pointers")
    return path


def published(spark: SparkSession, base: str, name: str) -> tuple[DataFrame, str]:
    """(view, label) of the latest published version of ``name``."""
    pointers = _pointers(spark, base, name)
    if pointers is None:
        raise FileNotFoundError(f"nothing published as {name} under {base}")
    path = f"{base}/{name}/{_newest(pointers).version}"
    return spark.read.parquet(f"{path}/view"), spark.read.text(f"{path}/label").first().value


# --- run all (L6) and re-publish (L7) -------------------------------------------


class Manifest:
    """The finished steps of a run, one line each under ``base``.

    A step's line is added when its output is complete, so a run that is
    started again with the same folder takes the outputs of finished steps
    and repeats the one that it died in.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.path = spark, f"{base}/manifest"
        try:
            rows = spark.read.schema("step string, value string").json(self.path).collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = []
        self.done = {r.step: r.value for r in rows}

    def step(self, name: str, make: Callable[[], str]) -> str:
        """The value (a path, or a number as text) of a step, made once."""
        if name not in self.done:
            value = make()
            line = self.spark.range(1, numPartitions=1).select(F.lit(name).alias("step"), F.lit(value).alias("value"))
            line.write.mode("append").json(self.path)
            self.done[name] = value
        return self.done[name]


def run_jobs(
    spark: SparkSession,
    base: str,
    specs,
    allocations: Callable[[J.JobSpec], DataFrame],
    split: Callable[[str | None], Column],
    frames: dict[str, Callable[[J.JobSpec, Column], DataFrame]],
    latest: Callable[[J.JobSpec], Column | None] = lambda spec: None,
) -> dict[str, str]:
    """L6 on any inputs: the jobs in order, each output a CSV with header.

    ``allocations`` makes the allocations frame, ``split`` the fee split
    (given the path of the written allocations), ``frames`` the other jobs'
    frames, ``latest`` a frame's latest date where it is known without it.
    The fee split is one number and is computed once; each frame is written
    once as Parquet, and the dated output (A14), the published sheet and its
    label (A15) come from there.  Finished steps are in the run's manifest.
    """
    done = Manifest(spark, base)
    paths: dict[str, str] = {}

    def saved_csv(df: DataFrame, path: str) -> str:
        write_csv(df, path)
        return path

    def saved_frame(df: DataFrame, path: str) -> str:
        df.write.mode("overwrite").parquet(path)
        return path

    def ratio() -> str:
        value = spark.range(1).select(split(paths.get("allocations")).alias("fs")).first().fs
        return "" if value is None else repr(float(value))

    def outputs(spec: J.JobSpec) -> str:
        saved = spark.read.parquet(f"{base}/{spec.filename}_frame")
        # The one value that comes back to the driver names a path.
        path = f"{base}/{saved.agg(J.dated_name(spec.filename).alias('name')).first().name or spec.filename}"
        out = J.job_output(saved, spec)
        # More keys than the date, or one date would be one task.
        return saved_csv(out.orderBy(*[c for c in ("date", "subgraph_id", "block", "stamp") if c in out.columns]), path)

    def sheet(spec: J.JobSpec) -> str:
        saved = spark.read.parquet(f"{base}/{spec.filename}_frame")
        view = sheet_global(saved) if spec.type == "global" else sheet_subgraphs(saved, latest(spec))
        return publish(view, base, f"{spec.filename}_sheet", run_label(spec.end))

    for spec in specs:
        if spec.type == "allocations":
            make = lambda spec=spec: saved_csv(J.allocations_output(allocations(spec)), f"{base}/{spec.filename}")
            paths[spec.type] = done.step(spec.type, make)
            continue
        number = done.step("fee_split", ratio)
        fs = F.lit(float(number) if number else None).cast("double")
        done.step(f"{spec.type} frame", lambda spec=spec: saved_frame(frames[spec.type](spec, fs), f"{base}/{spec.filename}_frame"))
        paths[spec.type] = done.step(f"{spec.type} output", lambda spec=spec: outputs(spec))
        if spec.upload == "sheet":
            done.step(f"{spec.type} sheet", lambda spec=spec: sheet(spec))
    return paths


def run_all(spark: SparkSession, sf_dir: str, out_dir: str | None = None, specs=J.JOBS) -> dict[str, str]:
    """L6 on the test tables, under ``out_dir`` (default: a new folder in the
    shared one).  Returns ``{job: output path}``; with the folder of a run
    that died, goes on where that one stopped."""
    t = fx.Tables(spark, sf_dir)
    base = out_dir or scratch_path(spark, "outputs")
    own = next((s for s in specs if s.type == "allocations"), J.ALLOCATIONS)
    return run_jobs(
        spark, base, specs,
        allocations=lambda spec: J.allocations_frame(t, spec),
        split=lambda path: J.fee_split_of(t, own),
        frames={
            "global": lambda spec, fs: J.global_frame(t, fs, spec),
            "subgraphs": lambda spec, fs: J.subgraphs_frame(t, fs, spec),
        },
        latest=lambda spec: J.latest_date(J.snapshots_for(t, spec)),
    )


def run_payloads(spark: SparkSession, payloads: dict[str, DataFrame], blocktimes: dict[str, DataFrame], out_dir: str, specs=J.JOBS) -> dict[str, str]:
    """L6 on a caller's own nested payloads, by job type, and the block times
    of the ``global`` and ``subgraphs`` jobs.  The fee split comes from the
    written allocations, as in the source; ``cap``, ``names`` and ``rows`` of
    a job's spec hold here too."""
    return run_jobs(
        spark, out_dir, specs,
        allocations=lambda spec: J.allocations_from(payloads["allocations"], spec.cap),
        split=lambda path: J.fee_split(read_csv(spark, path, allocations_csv_schema())),
        frames={
            "global": lambda spec, fs: J.global_from(payloads["global"], blocktimes["global"], fs),
            "subgraphs": lambda spec, fs: J.subgraphs_from(payloads["subgraphs"], blocktimes["subgraphs"], fs, spec.names, spec.cap),
        },
    )


def allocations_csv_schema() -> StructType:
    from pyspark.sql.types import LongType, StringType

    types = {"block": LongType(), "closed_at_block": LongType()}
    doubles = {"allocated_tokens", "delegation_fees", "QF_collected"}
    return StructType(
        [
            StructField(c, types.get(c, DoubleType() if c in doubles else StringType()), True)
            for c in C.OUT_ALLOCATIONS
        ]
    )


def republish_global(spark: SparkSession, path: str) -> DataFrame:
    """Read a saved global CSV (dates parsed) and rebuild its sheet view."""
    return sheet_global(read_csv(spark, path, global_csv_schema()))


__all__ = [
    "shared_dir",
    "write_csv",
    "read_csv",
    "csv_roundtrip",
    "sheet_subgraphs",
    "sheet_global",
    "text_view",
    "column_formats",
    "publish",
    "published",
    "run_all",
    "run_payloads",
    "republish_global",
    "run_label",
]
