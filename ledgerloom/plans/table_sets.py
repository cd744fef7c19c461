"""Several tables that change together.

Rows are ordinary Parquet folders, written by Spark and never changed. A
manifest, one small JSON file per version, names the folders and the schema of
every table of the set. A commit adds the next manifest by a rename that
refuses an existing name, so readers see all tables of a version or none, a
job that dies before its commit leaves only folders that no manifest names,
and of two writers that read one version the second gets ``Conflict``.

The rename must be atomic, as on HDFS or a local disk. A set that gets many
small appends is rewritten by ``replace`` with a table read from itself.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .sinks import write_table


class Conflict(Exception):
    """Another writer has committed the version that this one prepared."""


class TableSet:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._manifests = f"{self.root}/_manifests"

    # --- reading ---------------------------------------------------------------
    def version(self) -> int:
        """The newest committed version; 0 where nothing has been committed."""
        folder = self._path(self._manifests)
        files = folder.getFileSystem(self._conf())
        if not files.exists(folder):
            return 0
        numbers = [re.fullmatch(r"(\d+)\.json", s.getPath().getName()) for s in files.listStatus(folder)]
        return max((int(m.group(1)) for m in numbers if m), default=0)

    def manifest(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        if version == 0:
            return {"version": 0, "tables": {}}
        path = self._path(f"{self._manifests}/{version:09d}.json")
        stream = path.getFileSystem(self._conf()).open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """A table as of one version, by default the newest."""
        entry = self.manifest(version)["tables"][name]
        schema = StructType.fromJson(entry["schema"])
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{f}" for f in entry["folders"]])

    # --- writing ---------------------------------------------------------------
    def replace(self, tables: dict[str, DataFrame], expected: int | None = None) -> int:
        """Commit ``tables`` as the whole content of their names; tables not named stay as they are."""
        return self._write(tables, expected, append=False)

    def append(self, tables: dict[str, DataFrame], expected: int | None = None) -> int:
        """Commit the rows of ``tables`` in addition to what their names hold at version ``expected``."""
        return self._write(tables, expected, append=True)

    def _write(self, tables: dict[str, DataFrame], expected: int | None, append: bool) -> int:
        old = self.manifest(expected)
        new, batch = dict(old["tables"]), uuid.uuid4().hex
        for name, rows in tables.items():
            folder = f"{name}/{batch}"
            write_table(rows, f"{self.root}/{folder}")
            before = old["tables"][name] if append and name in old["tables"] else None
            if before and [f["name"] for f in before["schema"]["fields"]] != rows.columns:
                raise ValueError(f"{name}: columns {rows.columns} do not continue the table")
            new[name] = {"schema": before["schema"] if before else json.loads(rows.schema.json()),
                         "folders": [*(before["folders"] if before else []), folder]}
        return self._commit({"version": old["version"] + 1, "tables": new})

    def _commit(self, manifest: dict) -> int:
        jvm, version = self.spark._jvm, manifest["version"]
        draft = self._path(f"{self._manifests}/.draft-{uuid.uuid4().hex}")
        final = self._path(f"{self._manifests}/{version:09d}.json")
        stream = draft.getFileSystem(self._conf()).create(draft)
        try:
            stream.write(bytearray(json.dumps(manifest).encode()))
        finally:
            stream.close()
        kinds = jvm.org.apache.hadoop.fs.Options.Rename
        never_over = self.spark.sparkContext._gateway.new_array(kinds, 1)
        never_over[0] = kinds.NONE
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self._conf()).rename(draft, final, never_over)
        except Exception as e:
            if "FileAlreadyExistsException" in str(e):
                raise Conflict(f"version {version} exists") from e
            raise
        return version

    def _path(self, text: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(text)
        return path.getFileSystem(self._conf()).makeQualified(path)

    def _conf(self):
        return self.spark._jsc.hadoopConfiguration()
