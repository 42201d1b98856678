"""Tables written by runs: partitioned by day, safe to repeat, replaced at once.

A table is a folder of generations, a generation a folder of runs, a run what one job wrote::

    <table>/generation=000001/run=<name>/day=2001-07-30/part-*.parquet
    <table>/generation=000001/run=<name>/_committed

A run is part of the table from the moment its mark ``_committed`` is there; the mark is renamed into
place after the last file, holds the run's counts, and is all that a commit is.  So

* a job that failed half-way has added nothing, and repeating it replaces its leftovers;
* a run that is repeated after it was committed writes nothing and reports the counts of the first time;
* a replacement writes the first run of the next generation, and readers move to it by its mark alone.

Folders are only listed by the driver, never rows.  Writers of one table take turns, as the jobs of a
schedule do; a replacement that finds runs committed since it read the table raises instead of losing them.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from forecourt.sources.tables import conform

#: Partition columns by which tables of listings and pages are laid out: one of them.
UNITS = ("day", "month")
RUN = "run"
_MARK = "_committed"


@dataclass(frozen=True)
class Written:
    """What a run wrote: its rows, other counts taken while writing, and whether it had been written before."""

    rows: int
    counts: dict[str, int | float] = field(default_factory=dict)
    repeated: bool = False


@dataclass(frozen=True)
class Snapshot:
    """The committed runs of the generation that readers see."""

    generation: int
    runs: dict[str, str]
    marks: dict[str, dict]

    def absorbed(self) -> set[str]:
        return {run for mark in self.marks.values() for run in mark.get("absorbed", ())}


def scratch_folder(spark: SparkSession) -> str:
    """A folder that driver and executors share: ``spark.checkpoint.dir``, in a local session the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = spark.conf.get("spark.sql.warehouse.dir")
    return named.rstrip("/")


def scratch_table(spark: SparkSession, name: str) -> str:
    """A new folder there; it goes when the application ends."""
    path = f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"
    at, fs = _fs(spark, path)
    fs.mkdirs(at)
    fs.deleteOnExit(at)
    return path


def drop_folder(spark: SparkSession, path: str) -> None:
    at, fs = _fs(spark, path)
    fs.delete(at, True)


def _fs(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def _folders(spark: SparkSession, path: str, key: str) -> dict[str, str]:
    """Values of ``key=value`` folders in a folder, with their paths."""
    at, fs = _fs(spark, path)
    if not fs.exists(at):
        return {}
    names = [s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory()]
    return {n.partition("=")[2]: f"{path}/{n}" for n in names if n.startswith(f"{key}=")}


def _read_mark(spark: SparkSession, run_path: str) -> dict | None:
    at, fs = _fs(spark, f"{run_path}/{_MARK}")
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
    finally:
        stream.close()


def _set_mark(spark: SparkSession, run_path: str, content: dict) -> None:
    at, fs = _fs(spark, f"{run_path}/{_MARK}")
    draft, _ = _fs(spark, f"{run_path}/{_MARK}.draft")
    stream = fs.create(draft, True)
    stream.write(bytearray(json.dumps(content).encode("utf-8")))
    stream.close()
    if not fs.rename(draft, at):
        raise OSError(f"cannot commit {run_path}")


def snapshot(spark: SparkSession, table: str) -> Snapshot:
    """The last generation that has a committed run, or generation 0 without runs."""
    generations = _folders(spark, table.rstrip("/"), "generation")
    for name in sorted(generations, reverse=True):
        runs = _folders(spark, generations[name], RUN)
        marks = {run: mark for run, path in runs.items() if (mark := _read_mark(spark, path)) is not None}
        if marks:
            return Snapshot(int(name), {run: runs[run] for run in marks}, marks)
    return Snapshot(0, {}, {})


def _generation(table: str, number: int) -> str:
    return f"{table.rstrip('/')}/generation={number:06d}"


def _write_run(
    df: DataFrame, table: str, path: str, schema: StructType, by: str | None, unit: str, counts: dict[str, Column],
    replaces: Snapshot | None = None,
) -> Written:
    spark, rows, seen = df.sparkSession, conform(df, schema), Observation()
    rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(name) for name, c in counts.items()])
    if by:
        # Rows of a day meet in a few files; a day with most of the rows is dealt to several tasks.
        rows = rows.withColumn(unit, F.trunc(F.col(by).cast("date"), unit) if unit != "day" else F.col(by).cast("date")).hint("rebalance", F.col(unit))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(unit) if by else writer).parquet(path)
    if replaces is not None:
        now = snapshot(spark, table)
        if (now.generation, set(now.runs)) != (replaces.generation, set(replaces.runs)):
            raise RuntimeError(f"{table} was written while its replacement was made")
    found = dict(seen.get)
    n = int(found.pop("rows"))
    mark = {"rows": n, "counts": found, "unit": unit if by else None}
    if replaces is not None:
        # Runs whose rows this one stands for: repeating them must not bring the rows back.
        mark["absorbed"] = sorted({*replaces.runs, *replaces.absorbed()})
    _set_mark(spark, path, mark)
    return Written(n, found)


def _checked(run: str) -> str:
    if not run or any(c in run for c in "/=:%\\") or run.startswith(("_", ".")):
        raise ValueError(f"not a run's name: {run!r}")
    return run


def append_run(
    df: DataFrame, table: str, run: str, schema: StructType, by: str | None = None,
    counts: dict[str, Column] | None = None, unit: str = "day",
) -> Written:
    """Add the rows of one run; a run that is there already is left as it is.

    ``by`` names the column whose ``unit`` (day or month) lays the files out.  ``counts`` are aggregates over the
    rows, taken in the pass that writes them and kept in the run's mark.
    """
    now = snapshot(df.sparkSession, table)
    if (mark := now.marks.get(_checked(run))) is not None:
        return Written(mark["rows"], mark["counts"], repeated=True)
    if run in now.absorbed():
        return Written(0, repeated=True)
    path = f"{_generation(table, max(now.generation, 1))}/{RUN}={run}"
    return _write_run(df, table, path, schema, by, unit, counts or {})


def replace_runs(
    df: DataFrame, table: str, run: str, schema: StructType, by: str | None = None,
    counts: dict[str, Column] | None = None, read_at: Snapshot | None = None, unit: str = "day",
) -> Written:
    """Put the rows of one run in the place of the whole table; ``df`` may read the table.

    ``read_at``: the snapshot that ``df`` was made from; runs committed since then are an error.
    """
    now = snapshot(df.sparkSession, table)
    if (mark := now.marks.get(_checked(run))) is not None and "absorbed" in mark:
        return Written(mark["rows"], mark["counts"], repeated=True)
    path = f"{_generation(table, now.generation + 1)}/{RUN}={run}"
    return _write_run(df, table, path, schema, by, unit, counts or {}, replaces=read_at or now)


def read_runs(
    spark: SparkSession, table: str, schema: StructType, at: Snapshot | None = None, runs: list[str] | None = None,
) -> DataFrame:
    """Rows of the committed runs (or of those named), with ``run`` and, where files are laid out so, ``day`` or ``month``.

    Only files of committed runs are listed.  Conditions on these columns leave files unread.
    """
    now = at or snapshot(spark, table)
    chosen = {k: v for k, v in now.runs.items() if runs is None or k in runs}
    units = {m["unit"] for m in now.marks.values() if m["rows"]}
    if len(units) > 1:
        raise ValueError(f"runs of {table} are laid out in different ways: {units}")
    extra = [StructField(RUN, StringType()), *(StructField(u, DateType()) for u in units if u)]
    whole = StructType([*schema.fields, *extra])
    filled = [path for run, path in chosen.items() if now.marks[run]["rows"]]
    if not filled:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in whole])
    return spark.read.schema(whole).option("basePath", _generation(table, now.generation)).parquet(*sorted(filled))


def since_day(df: DataFrame, moment: Column) -> Column:
    """The condition on the layout's column that goes with ``time >= moment``; true for other tables."""
    date = moment.cast("date")
    first = {"day": date, "month": F.trunc(date, "month")}
    return next((F.col(u) >= first[u] for u in UNITS if u in df.columns), F.lit(True))


def drop_old(spark: SparkSession, table: str, keep: int = 1) -> int:
    """Remove generations before the ``keep`` last ones that readers may still hold; how many went."""
    now = snapshot(spark, table)
    old = [(int(n), p) for n, p in _folders(spark, table.rstrip("/"), "generation").items() if int(n) <= now.generation - keep]
    for _, path in old:
        at, fs = _fs(spark, path)
        fs.delete(at, True)
    return len(old)


def run_counts(spark: SparkSession, table: str) -> DataFrame:
    """``run, measure, value``: what the marks of the committed runs hold; reads no rows of the table."""
    now = snapshot(spark, table)
    rows = [(run, k, float(v)) for run, m in sorted(now.marks.items()) for k, v in {"rows": m["rows"], **m["counts"]}.items() if v is not None]
    schema = "run string, measure string, value double"
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(t).alias(n) for n, t in (p.split() for p in schema.split(", "))])
    cells = [F.struct(F.lit(r).alias("run"), F.lit(k).alias("measure"), F.lit(v).alias("value")) for r, k, v in rows]
    return reduce(lambda a, b: a.union(b), [spark.range(1).select(F.inline(F.array(*cells[i:i + 500]))) for i in range(0, len(cells), 500)])
