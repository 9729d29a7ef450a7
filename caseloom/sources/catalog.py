"""Named artifacts below one root: declared schemas, safe paths, write-once and atomic writes, checksums."""

from __future__ import annotations

import json
import uuid
from pathlib import Path, PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def safe_relative(relative: str) -> str:
    """``relative`` with plain separators if it names something below a root; else an error."""
    parts = PurePosixPath(relative.replace("\\", "/")).parts
    inside = bool(parts) and parts[0] != "/" and ":" not in parts[0] and ".." not in parts
    if not inside:
        raise ValueError(f"unsafe path: {relative}")
    return "/".join(parts)


def safe_path(root: str | Path, relative: str) -> Path:
    """``relative`` below the local folder ``root``; links that lead out of it are errors as well."""
    base = Path(root).resolve()
    path = base.joinpath(safe_relative(relative)).resolve()
    if base not in (path, *path.parents):
        raise ValueError(f"unsafe path: {relative}")
    return path


class Files:
    """The file system that Spark itself uses for a path: local, mounted or remote alike."""

    def __init__(self, spark: SparkSession, root: str | Path) -> None:
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path(str(root)).getFileSystem(self._conf)

    def path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def rename(self, old: str, new: str) -> None:
        if not self.fs.rename(self.path(old), self.path(new)):
            raise OSError(f"cannot rename {old} to {new}")

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def write_text(self, name: str, text: str) -> None:
        stream = self.fs.create(self.path(name), True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()

    def read_text(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8-sig")
        finally:
            stream.close()


class Catalog:
    """Artifacts below one root, a folder or a URI of any file system. Table names map to Parquet below it."""

    def __init__(self, spark: SparkSession, root: str | Path, schemas: dict[str, str] | None = None) -> None:
        self.spark, self.root, self.schemas = spark, str(root).rstrip("/"), schemas or {}
        self.files = Files(spark, self.root)

    def path(self, relative: str) -> str:
        return f"{self.root}/{safe_relative(relative)}"

    def _beside(self, path: str, tag: str) -> str:
        folder, _, name = path.rpartition("/")
        return f"{folder}/.{name}.{tag}-{uuid.uuid4().hex}"

    def read(self, name: str, columns: list[str] | None = None, optional: bool = False) -> DataFrame:
        """The table; an optional one that is missing is empty with its declared schema."""
        path = self.path(name + ".parquet")
        if not self.files.exists(path):
            if optional and name in self.schemas:
                return self.spark.createDataFrame([], self.schemas[name])
            raise FileNotFoundError(f"{name} is missing; run the stage that writes it")
        df = self.spark.read.schema(self.schemas[name]).parquet(path) if name in self.schemas else self.spark.read.parquet(path)
        return df.select(*columns) if columns else df

    def write(self, name: str, df: DataFrame, once: bool = False) -> None:
        """Write beside the target, then rename: readers see the old or the new table, never a part."""
        path = self.path(name + ".parquet")
        if once and self.files.exists(path):
            raise FileExistsError(name)
        if name in self.schemas:
            want = self.spark.createDataFrame([], self.schemas[name])
            df = df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in want.schema))
        new, old = self._beside(path, "new"), self._beside(path, "old")
        df.write.option("compression", "zstd").parquet(new)
        replaced = self.files.exists(path)
        if replaced:
            self.files.rename(path, old)
        self.files.rename(new, path)
        if replaced:
            self.files.delete(old)

    def write_json(self, relative: str, value: object, once: bool = False) -> None:
        """JSON with sorted keys; a write-once file may be written again with equal content only."""
        path = self.path(relative)
        text = json.dumps(value, sort_keys=True, ensure_ascii=False, indent=2) + "\n"
        there = self.files.exists(path)
        if once and there:
            if self.files.read_text(path) == text:
                return
            raise FileExistsError(relative)
        new, old = self._beside(path, "new"), self._beside(path, "old")
        self.files.write_text(new, text)
        if there:
            self.files.rename(path, old)
        self.files.rename(new, path)
        if there:
            self.files.delete(old)

    def read_json(self, relative: str) -> object:
        return json.loads(self.files.read_text(self.path(relative)))


def checksums(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """(name, bytes, sha256) of the files in ``folder``; files are read where they are, one at a time a task.

    The reader passes over empty files, so these are taken from the folder's listing.
    """
    from fnmatch import fnmatch
    from hashlib import sha256

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder)
    name = F.regexp_replace("path", r"^.*/", "")
    full = files.select(name.alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    listed = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(path, True)
    empty = []
    while listed.hasNext():
        f = listed.next()
        if f.getLen() == 0 and fnmatch(f.getPath().getName(), glob):
            empty.append((f.getPath().getName(), 0, sha256(b"").hexdigest()))
    return full.unionByName(spark.createDataFrame(empty, full.schema))


def verify_files(found: DataFrame, lock: DataFrame) -> DataFrame:
    """(name, problem) of the locked files that are missing or differ in size or digest; empty if all hold."""
    f = found.select("name", F.col("bytes").alias("b"), F.col("sha256").alias("s"))
    problem = F.when(F.col("b").isNull(), "MISSING").when(F.col("b") != F.col("bytes"), "SIZE").when(F.col("s") != F.col("sha256"), "DIGEST")
    return lock.join(f, "name", "left").select("name", problem.alias("problem")).where("problem is not null")
