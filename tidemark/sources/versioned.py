"""Tables in versions: data files that never change, and one manifest a version that lists them.

A change writes new data files beside the old ones, then a manifest under a temporary name, then gives the manifest its number by one
rename that fails if the number is taken. Before the rename nothing of the change is seen, after it all is; a job that dies on the way
leaves the last version whole, and its files are no part of any version. A reader holds the file list of the version it
opened, so later changes do not reach it. Of two writers that start from one version, the second to commit is refused.

A merge is copy-on-write: the files that hold touched keys are found by file name and written anew, all others go into the next version
as they are.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.joins import new_rows_only
from tidemark.session import pin


class Conflict(RuntimeError):
    """Another writer has committed since this change began."""


class VersionedTable:
    """The table under ``folder``; version 0 is the empty table without a schema."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._paths = spark._jvm.org.apache.hadoop.fs.Path
        self._hadoop = spark._jsc.hadoopConfiguration()
        self._files = self._paths(self.folder).getFileSystem(self._hadoop)

    def versions(self) -> list[int]:
        """The numbers of all committed versions, ascending."""
        place = self._paths(f"{self.folder}/manifests")
        if not self._files.exists(place):
            return []
        names = (status.getPath().getName() for status in self._files.listStatus(place))
        return sorted(int(name[:-5]) for name in names if name.endswith(".json"))

    def version(self) -> int:
        """The newest version."""
        return max(self.versions(), default=0)

    def files(self, version: int | None = None) -> list[str]:
        """The data files of a version, relative to ``folder/data``."""
        version = self.version() if version is None else version
        if version == 0:
            return []
        rows = self.spark.read.schema("path string").json(f"{self.folder}/manifests/{version:012d}.json")
        return sorted(row["path"] for row in rows.collect() if row["path"])

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the newest by default: a frame that stays with that version whatever is committed later."""
        version = self.version() if version is None else version
        schema = self._schema(version)
        return self._open(self.files(version), schema)

    def _schema(self, version: int):
        from pyspark.sql.types import StructType

        if version == 0:
            raise FileNotFoundError(f"no version of {self.folder}")
        first = self.spark.read.text(f"{self.folder}/manifests/{version:012d}.json").first()[0]
        return StructType.fromJson(json.loads(json.loads(first)["schema"]))

    def _open(self, files: list[str], schema) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.folder}/data/{name}" for name in files))

    def _write(self, df: DataFrame) -> list[str]:
        """New data files, not yet part of any version."""
        batch = uuid.uuid4().hex
        df.write.parquet(f"{self.folder}/data/{batch}")
        found = self._files.listStatus(self._paths(f"{self.folder}/data/{batch}"))
        return [f"{batch}/{name}" for name in (status.getPath().getName() for status in found) if name.startswith("part-")]

    def _commit(self, files: list[str], schema, base: int) -> int:
        """One rename makes ``files`` the version after ``base``."""
        lines = [{"schema": schema.json()}, *({"path": name} for name in sorted(files))]
        text = "".join(json.dumps(line) + "\n" for line in lines).encode()
        staged = self._paths(f"{self.folder}/manifests/.{uuid.uuid4().hex}")
        target = self._paths(f"{self.folder}/manifests/{base + 1:012d}.json")
        stream = self._files.create(staged, False)
        stream.write(bytearray(text))
        stream.close()
        jvm = self.spark._jvm
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        where = self._files.makeQualified(target)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), self._hadoop).rename(self._files.makeQualified(staged), where, options)
        except Exception as error:
            self._files.delete(staged, False)
            if self._files.exists(target):
                raise Conflict(f"{self.folder} has moved on from version {base}") from error
            raise
        return base + 1

    def replace(self, df: DataFrame, checks: Iterable[Callable[[DataFrame], None]] = ()) -> int:
        """A version of these rows alone. ``checks`` see the written rows and raise to keep the version from coming."""
        base = self.version()
        files = self._write(df)
        for check in checks:
            check(self._open(files, df.schema))
        return self._commit(files, df.schema, base)

    def append(self, df: DataFrame) -> int:
        """A version with these rows added."""
        base = self.version()
        if base == 0:
            return self.replace(df)
        schema = self._schema(base)
        return self._commit(self.files(base) + self._write(df.select(*schema.names)), schema, base)

    def append_new(self, incoming: DataFrame, keys: Iterable[str]) -> int:
        """A version with the rows added whose key, nulls included, the table lacks. If there are none, the version stays."""
        base = self.version()
        if base == 0:
            return self.replace(incoming)
        rows = pin(new_rows_only(incoming, self.read(base), list(keys)))
        if rows.isEmpty():
            return base
        schema = self._schema(base)
        return self._commit(self.files(base) + self._write(rows.select(*schema.names)), schema, base)

    def touched(self, keys: DataFrame, version: int | None = None) -> list[str]:
        """The files of a version that hold any of the keys. Reads the key columns only, and of those what lies between the
        least and the greatest of the keys; the names of files, not rows, come to the driver."""
        names = keys.columns
        place = F.regexp_extract("_metadata.file_path", "([^/]+/[^/]+)$", 1).alias("\0file")
        stored = self.read(version).select(*names, place)
        first = names[0]
        edges = keys.agg(F.min(first).alias("low"), F.max(first).alias("high"), F.count_if(F.col(first).isNull()).alias("nulls")).first()
        if edges["low"] is not None:
            inside = F.col(first).between(F.lit(edges["low"]), F.lit(edges["high"]))
            stored = stored.where(inside | F.col(first).isNull() if edges["nulls"] else inside)
        match = F.lit(True)
        wanted = keys.select(*(F.col(c).alias(f"\0{c}") for c in names))
        for c in names:
            match = match & F.col(c).eqNullSafe(F.col(f"\0{c}"))
        return sorted(row[0] for row in stored.join(wanted, match, "left_semi").select("\0file").distinct().collect())

    def merge(self, incoming: DataFrame, keys: Iterable[str], force: bool = True, order: Iterable[str] = ()) -> int:
        """A version in which incoming rows replace those of their key (``force``), or are added where their key is new.

        Only files with touched keys are written anew; without ``force`` none is. When a key can repeat in the incoming rows, ``order``
        says in which sequence they arrive: the last one counts with ``force``, else the first. Null keys are keys.
        """
        keys, order, base = list(keys), list(order), self.version()
        if order:
            pick = F.max_by if force else F.min_by
            rest = [c for c in incoming.columns if c not in keys]
            one = incoming.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("\0row"))
            incoming = one.select(*(F.col(c) if c in keys else F.col("\0row")[c].alias(c) for c in incoming.columns))
        if base == 0:
            return self.replace(incoming)
        if not force:
            return self.append_new(incoming, keys)
        schema = self._schema(base)
        incoming = pin(incoming.select(*schema.names))
        if incoming.isEmpty():
            return base
        old = self.touched(incoming.select(*keys).distinct(), base)
        kept = new_rows_only(self._open(old, schema), incoming, keys)
        files = self._write(kept.unionByName(incoming))
        return self._commit([name for name in self.files(base) if name not in set(old)] + files, schema, base)

    def vacuum(self, keep: int = 2) -> None:
        """Delete the manifests before the last ``keep`` versions and the data files that no remaining version lists.

        Readers of older versions lose their files, and so do changes that are under way: run it when there are none.
        """
        versions = self.versions()
        for version in versions[:-keep]:
            self._files.delete(self._paths(f"{self.folder}/manifests/{version:012d}.json"), False)
        listed = {name for version in versions[-keep:] for name in self.files(version)}
        data = self._paths(f"{self.folder}/data")
        for batch in self._files.listStatus(data) if self._files.exists(data) else []:
            inside = [(status.getPath(), f"{batch.getPath().getName()}/{status.getPath().getName()}") for status in self._files.listStatus(batch.getPath())]
            if not any(name in listed for _, name in inside):
                self._files.delete(batch.getPath(), True)
                continue
            for path, name in inside:
                if name not in listed and path.getName().startswith("part-"):
                    self._files.delete(path, False)
