"""Sinks: dated files, appended tables, rebuilt tables.

A table folder holds one folder of files per run (``run-<id>``) and numbered manifests (``_manifest``), each of which names the runs that
make up the table. A run's files are written first and count from the moment the manifest that names them is there: a write that
dies before leaves the table as it was, and the same run repeated, after an error or a lost answer, leaves one copy.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

MANIFESTS = "_manifest"


class _Folder:
    """File operations on any store that Spark's own file system interface reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark._jvm, path
        self.fs = self.at().getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, *names: str):
        return self.jvm.org.apache.hadoop.fs.Path("/".join([self.path, *filter(None, names)]))

    def names(self, name: str) -> list[str]:
        return [s.getPath().getName() for s in self.fs.listStatus(self.at(name))] if self.fs.exists(self.at(name)) else []

    def read(self, *names: str) -> str:
        stream = self.fs.open(self.at(*names))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, text: str, *names: str) -> None:
        stream = self.fs.create(self.at(*names), True)
        stream.write(bytearray(text.encode()))
        stream.close()

    def put(self, text: str, *names: str) -> bool:
        """Write a file under a name that nobody has taken; it appears whole or not at all."""
        draft = f"{MANIFESTS}/.draft-{uuid.uuid4().hex}"
        self.write(text, draft)
        taken = self.fs.exists(self.at(*names)) or not self.fs.rename(self.at(draft), self.at(*names))
        if taken:
            self.fs.delete(self.at(draft), False)
        return not taken


def _newest(folder: _Folder) -> tuple[int, list[str]]:
    versions = sorted(int(n.removesuffix(".json")) for n in folder.names(MANIFESTS) if n.endswith(".json") and not n.startswith("."))
    return (versions[-1], json.loads(folder.read(MANIFESTS, f"{versions[-1]:012d}.json"))) if versions else (0, [])


def _commit(folder: _Folder, run_id: str, replace: bool) -> None:
    while True:
        version, runs = _newest(folder)
        if run_id in runs and (not replace or runs == [run_id]):
            return
        if folder.put(json.dumps([run_id] if replace else [*runs, run_id]), MANIFESTS, f"{version + 1:012d}.json"):
            return


def stage_run(df: DataFrame, path: str, run_id: str) -> None:
    """Write a run's files; they are no part of the table yet. What an earlier attempt left of the run is replaced."""
    df.write.mode("overwrite").parquet(f"{path}/run-{run_id}")


def _write_run(df: DataFrame, path: str, run_id: str | None, replace: bool) -> None:
    run_id = run_id or uuid.uuid4().hex
    folder = _Folder(df.sparkSession, path)
    if run_id not in _newest(folder)[1]:
        stage_run(df, path, run_id)
    _commit(folder, run_id, replace)


def append_table(df: DataFrame, path: str, run_id: str | None = None) -> None:
    """Add the rows to the table once per ``run_id``; without one every call is a run of its own."""
    _write_run(df, path, run_id, replace=False)


def replace_files(df: DataFrame, path: str, run_id: str | None = None) -> None:
    """Truncate and load: from the commit on the table is these rows; readers of an earlier manifest keep their files."""
    _write_run(df, path, run_id, replace=True)


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The rows of the runs that the newest manifest names. A table without runs needs a schema to be empty with."""
    runs = _newest(_Folder(spark, path))[1]
    if not runs:
        if schema is None:
            raise FileNotFoundError(f"no run has been committed to {path}")
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(*[f"{path}/run-{run}" for run in runs])


def drop_stale_runs(spark: SparkSession, path: str) -> int:
    """Delete files of runs that the newest manifest does not name; to be called when no writer and no older reader is at work."""
    folder = _Folder(spark, path)
    runs = set(_newest(folder)[1])
    stale = [n for n in folder.names("") if n.startswith("run-") and n.removeprefix("run-") not in runs]
    for name in stale:
        folder.fs.delete(folder.at(name), True)
    return len(stale)


def write_dated_csv(df: DataFrame, path: str, calc_date, partition: str) -> None:
    """One folder per partition value below the calculation date; reading the root gives all of them.

    The date's files are written aside and take the place of older ones in one move each, so a write that dies changes nothing.
    """
    folder = _Folder(df.sparkSession, path)
    run, name = uuid.uuid4().hex, f"calc_date={calc_date}"
    df.write.partitionBy(partition).option("header", True).csv(f"{path}/_staged-{run}")
    if folder.fs.exists(folder.at(name)):
        folder.fs.rename(folder.at(name), folder.at(f"_old-{run}"))
    folder.fs.rename(folder.at(f"_staged-{run}"), folder.at(name))
    folder.fs.delete(folder.at(f"_old-{run}"), True)


def name_outputs(spark: SparkSession, written: str, target: str, calc_date) -> None:
    """Move written part files below ``target``, each under a name that ends in the date, for ``scans.read_dated_outputs``."""
    source, folder = _Folder(spark, written), _Folder(spark, target)
    folder.fs.mkdirs(folder.at())
    files = source.fs.listFiles(source.at(), True)
    while files.hasNext():
        file = files.next().getPath()
        if file.getName().startswith("part-"):
            folder.fs.rename(file, folder.at(f"{file.getName().split('.')[0]}-{file.getParent().getName()}_{calc_date}.csv"))


def rebuild_table(df: DataFrame, name: str) -> DataFrame:
    """Drop and create as select, then the row count of what was stored. The old table stays until the new one is written."""
    spark = df.sparkSession
    staged = f"{name}_{uuid.uuid4().hex}"
    df.write.saveAsTable(staged)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    return spark.table(name).selectExpr("count(*) AS num_records")
