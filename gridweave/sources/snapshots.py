"""A table kept as versions: data files by group of columns, and a manifest for every version that names them.

A writer puts its data where no version looks, claims the next number (a file
that only one writer can make) and renames its manifest into place.  So a reader
that holds a version sees all of it and nothing else, a column that is added or
replaced is written alone, and what a crash leaves between data and manifest
changes nothing.  A writer whose version is no longer the newest is refused, and
can try again from the newest.

Folders: ``data/ID`` Parquet files with the key columns and some others;
``claims/N`` and ``manifests/N.json``.  A version's columns name the folders that
hold their rows; columns in the same folders are read together, others are joined
by key.  Rows that are appended hold all columns.

A table made with ``buckets`` has its folders in that many by key, so that columns
that are joined are not shuffled, nor are those made of them dealt out again.  Sessions
learn of buckets from their catalog alone: a folder is named there, as an external
table, when it is first read.  A column in several folders (after an append) is read
as plain files, since buckets are not kept through a union.
"""

from __future__ import annotations

import json
import time
import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class Conflict(RuntimeError):
    """Another writer was first."""


class Snapshots:
    def __init__(self, spark: SparkSession, path: str, stale: float = 60.0) -> None:
        """A claim that led to no manifest for ``stale`` minutes is of a lost writer, and its number is left out."""
        self.spark, self.path, self.stale = spark, path.rstrip("/"), stale
        self._fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _listed(self, folder: str) -> dict[str, int]:
        """Names and when they were last changed."""
        at = self._at(folder)
        return {s.getPath().getName(): s.getModificationTime() for s in self._fs.listStatus(at)} if self._fs.exists(at) else {}

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self._listed("manifests") if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        """What a version holds; the newest without one."""
        found = self.versions()
        if version is None and not found or version is not None and version not in found:
            raise FileNotFoundError(f"{self.path} has no version {'' if version is None else version}")
        n = found[-1] if version is None else version
        return json.loads("".join(r.value for r in self.spark.read.text(str(self._at(f"manifests/{n}.json"))).collect()))

    def read(self, columns: list[str] | None = None, version: int | None = None) -> DataFrame:
        """A version's rows, its keys and the columns asked for; only folders that hold any of these are opened."""
        m = self.manifest(version)
        wanted = [c for c in m["columns"] if columns is None or c in columns] or list(m["columns"])[:1]
        groups: dict[tuple[str, ...], list[str]] = {}
        for c in wanted:
            groups.setdefault(tuple(m["columns"][c]), []).append(c)
        out = None
        for folders, names in groups.items():
            fields = StructType([f for f in StructType.fromJson(m["schema"]) if f.name in (*m["keys"], *names)])
            if m.get("buckets") and len(folders) == 1:
                one = self._bucketed(folders[0], fields, m["keys"], m["buckets"])
            else:
                one = self.spark.read.schema(fields).parquet(*[f"{self.path}/data/{f}" for f in folders])
            one = one.select(*m["keys"], *names)
            out = one if out is None else out.join(one, m["keys"])
        order = [*m["keys"], *(c for c in m["columns"] if c in wanted)]
        return out.select(*[c for c in order if columns is None or c in columns or c in m["keys"]])

    def _bucketed(self, folder: str, fields: StructType, keys: list[str], buckets: int) -> DataFrame:
        """A folder's columns by a name in the session's catalog, which knows of buckets."""
        quoted = lambda names: ", ".join("`" + n.replace("`", "``") + "`" for n in names)
        name = f"snapshot_{folder}_{zlib.crc32(fields.json().encode())}"
        columns = ", ".join(f"{quoted([f.name])} {f.dataType.simpleString()}" for f in fields)
        at = str(self._at(f"data/{folder}")).replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({quoted(keys)}) SORTED BY ({quoted(keys)}) INTO {buckets} BUCKETS LOCATION '{at}'")
        return self.spark.table(name)

    def _data(self, df: DataFrame, keys: list[str], buckets: int = 0) -> str:
        """The folder that df was written to, in ``buckets`` by key unless there are none."""
        name = uuid.uuid4().hex
        at = f"{self.path}/data/{name}"
        if buckets:
            df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).option("path", at).saveAsTable(f"snapshot_{name}")
            self.spark.sql(f"DROP TABLE snapshot_{name}")  # the name only; its files stay
        else:
            df.write.parquet(at)
        return name

    def commit(self, base: int, keys: list[str], columns: dict[str, list[str]], schema: StructType, buckets: int = 0) -> int:
        """Makes the version after ``base`` (0: none) visible, or says that another writer was first."""
        newest = (self.versions() or [0])[-1]
        if newest != base:
            raise Conflict(f"version {newest} is newer than {base}")
        claims = {int(n): at for n, at in self._listed("claims").items() if not n.startswith(".")}
        number = base + 1
        while number in claims and (time.time() * 1000 - claims[number]) / 60000 >= self.stale:
            number += 1
        self._fs.mkdirs(self._at("claims"))
        self._fs.mkdirs(self._at("manifests"))
        if not self._fs.createNewFile(self._at(f"claims/{number}")):
            raise Conflict(f"version {number} is being written")
        body = json.dumps({"version": number, "base": base, "keys": keys, "columns": columns, "schema": schema.jsonValue(), "buckets": buckets})
        draft = self._at(f"manifests/.{uuid.uuid4().hex}")
        out = self._fs.create(draft)
        out.write(bytearray(body.encode()))
        out.close()
        if not self._fs.rename(draft, self._at(f"manifests/{number}.json")):
            raise Conflict(f"version {number} could not be named")
        return number

    def create(self, df: DataFrame, keys: list[str], buckets: int = 0) -> int:
        """The table's first version, or one that has nothing of those before; ``buckets`` by key for its columns, 0 for plain files."""
        base = (self.versions() or [0])[-1]
        name = self._data(df, keys, buckets)
        return self.commit(base, keys, {c: [name] for c in df.columns if c not in keys}, df.schema, buckets)

    def put(self, df: DataFrame, base: int | None = None) -> int:
        """Adds or replaces df's columns, which are written alone; df has the keys of every row once."""
        m = self.manifest(base)
        new = [c for c in df.columns if c not in m["keys"]]
        buckets = m.get("buckets", 0)
        name = self._data(df.select(*m["keys"], *new), m["keys"], buckets)
        old = [f for f in StructType.fromJson(m["schema"]) if f.name not in new]
        return self.commit(m["version"], m["keys"], {**m["columns"], **{c: [name] for c in new}}, StructType([*old, *(df.schema[c] for c in new)]), buckets)

    def append(self, df: DataFrame, base: int | None = None) -> int:
        """Adds rows of new keys with all columns."""
        m = self.manifest(base)
        if missing := {*m["keys"], *m["columns"]} ^ set(df.columns):
            raise ValueError(f"columns differ: {', '.join(sorted(missing))}")
        kinds = StructType.fromJson(m["schema"])
        name = self._data(df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in kinds]), m["keys"])
        return self.commit(m["version"], m["keys"], {c: [*folders, name] for c, folders in m["columns"].items()}, kinds, m.get("buckets", 0))

    def vacuum(self, keep: int = 1) -> list[str]:
        """Deletes the data folders that none of the last ``keep`` versions names, and older manifests; returns the folders.

        For a time when nobody writes: a writer's data are named by no version until it commits.
        """
        kept = self.versions()[-keep:]
        used = {f for v in kept for folders in self.manifest(v)["columns"].values() for f in folders}
        for v in self.versions()[:-keep]:
            self._fs.delete(self._at(f"manifests/{v}.json"), False)
        gone = sorted(set(self._listed("data")) - used)
        for name in gone:
            self._fs.delete(self._at(f"data/{name}"), True)
            for known in self.spark.catalog.listTables(pattern=f"snapshot_{name}_*"):
                self.spark.sql(f"DROP TABLE IF EXISTS {known.name}")
        return gone
