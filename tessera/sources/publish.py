"""Atomic publication of all tables of a job run.

A run writes its tables to folders of its own and then one small entry into
``{root}/publications``: which folders now hold which units of which table. A unit is a
value of the table's partition column (a report date), or the run itself. The entry is
put in place by one rename that fails if the name is taken, so

* readers, who fold the entries in order, see all tables of a run or none of them;
* a run that stops before its entry has changed nothing, however many tables it wrote;
* a rerun (same ``run``) replaces what the run published before: units that it no longer
  has are gone, in every table that it publishes, also when it has no rows at all;
* a unit that two runs publish belongs to the later one.

Folders that no entry needs any more stay until ``vacuum``, for readers who still hold
an older state. Entries are one a run; readers fetch them whole (names, no data).
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ENTRIES = "publications"


@dataclass
class Table:
    """Rows to publish; ``by`` names the column whose values are the units."""

    rows: DataFrame
    by: str | None = None


def _files(spark: SparkSession, path: str):
    """Hadoop's file system of ``path``, and its Path class."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    return hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()), hadoop.Path


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if it is not there."""
    fs, path = _files(spark, folder)
    if not fs.exists(path(folder)):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(path(folder)))


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """A file with ``text`` under a name that must be free: it is there whole or not at
    all. False if somebody else has the name."""
    fs, at = _files(spark, path)
    folder, name = path.rsplit("/", 1)
    fs.mkdirs(at(folder))
    draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
    out = fs.create(at(draft), False)
    out.write(bytearray(text.encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(at(path).toUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    if not fs.exists(at(path)):
        try:
            # without the overwrite option the rename fails if the name is taken
            context.rename(context.makeQualified(at(draft)), context.makeQualified(at(path)), none)
            return True
        except Exception as e:  # noqa: BLE001  (a Java exception)
            if "FileAlreadyExists" not in str(e):
                raise
    fs.delete(at(draft), False)
    return False


def entries(spark: SparkSession, root: str) -> list[dict]:
    """All entries, in order."""
    folder = f"{root.rstrip('/')}/{ENTRIES}"
    found = [n for n in names(spark, folder) if n.endswith(".json") and not n.startswith(".")]
    if not found:
        return []
    rows = spark.read.text([f"{folder}/{n}" for n in found], wholetext=True).collect()
    return sorted((json.loads(r.value) for r in rows), key=lambda e: e["number"])


def state(spark: SparkSession, root: str) -> dict[str, dict]:
    """``table -> {"schema", "by", "units": {unit: (run, folder)}}`` after all entries."""
    out: dict[str, dict] = {}
    for e in entries(spark, root):
        for table, held in e["tables"].items():
            t = out.setdefault(table, {"units": {}})
            t["schema"], t["by"] = held["schema"], held["by"]
            t["units"] = {u: v for u, v in t["units"].items() if v[0] != e["run"]}
            t["units"].update({u: (e["run"], folder) for u, folder in held["units"].items()})
    return out


def publish(spark: SparkSession, root: str, run: str, tables: dict[str, Table]) -> int:
    """Write ``tables`` and make them the state of ``run``; returns the entry's number."""
    root = root.rstrip("/")
    attempt = uuid.uuid4().hex
    entry: dict = {"run": run, "tables": {}}
    for name, table in tables.items():
        folder = f"{name}/attempt={attempt}"
        w = table.rows.write
        (w.partitionBy(table.by) if table.by else w).parquet(f"{root}/{folder}")
        units = {run: folder}
        if table.by:
            parts = [n for n in names(spark, f"{root}/{folder}") if n.startswith(f"{table.by}=")]
            units = {unquote(p.split("=", 1)[1]): f"{folder}/{p}" for p in parts}
        entry["tables"][name] = {"schema": table.rows.schema.jsonValue(), "by": table.by, "units": units}
    while True:
        taken = [int(n.split(".")[0]) for n in names(spark, f"{root}/{ENTRIES}") if n[0].isdigit()]
        entry["number"] = max(taken, default=-1) + 1
        if put_new(spark, f"{root}/{ENTRIES}/{entry['number']:010d}.json", json.dumps(entry)):
            return entry["number"]


def read(spark: SparkSession, root: str, table: str, schema: str | StructType | None = None) -> DataFrame:
    """The published rows of ``table``; without any, an empty frame of ``schema``."""
    root = root.rstrip("/")
    t = state(spark, root).get(table)
    if t is None:
        if schema is None:
            raise LookupError(f"nothing is published as '{table}' under {root}")
        return spark.createDataFrame([], schema)
    kind = StructType.fromJson(t["schema"])
    folders = sorted({f"{root}/{folder}" for _, folder in t["units"].values()})
    if not folders:
        return spark.createDataFrame([], kind)
    df = spark.read.schema(kind).option("basePath", f"{root}/{table}").parquet(*folders)
    return df.select(*[F.col(f"`{c}`") for c in kind.names])


def vacuum(spark: SparkSession, root: str, older_than_hours: float = 168) -> list[str]:
    """Remove attempt folders that the state does not need and that were last written
    ``older_than_hours`` ago; returns what went."""
    root = root.rstrip("/")
    used = {"/".join(f.split("/")[:2]) for t in state(spark, root).values() for _, f in t["units"].values()}
    fs, path = _files(spark, root)
    limit = spark._jvm.java.lang.System.currentTimeMillis() - older_than_hours * 3_600_000
    gone = []
    for table in names(spark, root):
        for name in names(spark, f"{root}/{table}") if table != ENTRIES else []:
            folder = f"{table}/{name}"
            if name.startswith("attempt=") and folder not in used and \
                    fs.getFileStatus(path(f"{root}/{folder}")).getModificationTime() <= limit:
                fs.delete(path(f"{root}/{folder}"), True)
                gone.append(folder)
    return gone
