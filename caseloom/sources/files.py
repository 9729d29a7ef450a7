"""CSV, JSON lines and archives as DataFrames, and the matching sinks."""

from __future__ import annotations

import os
import re
import shutil
import zipfile
import zlib
from collections.abc import Iterator
from pathlib import PurePosixPath

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.session import ship

ship(__name__)


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """CSV with a header, quoted line breaks and doubled quotes."""
    r = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
    df = (r.schema(schema) if schema else r).csv(path)
    return df.withColumnsRenamed({c: c.lstrip("﻿") for c in df.columns if c.startswith("﻿")})


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV that :func:`read_csv` reads back: a header in each file, quoted line breaks, doubled quotes."""
    df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"').option("quoteAll", True).option("nullValue", "").option("emptyValue", "").csv(path)


def read_jsonl(spark: SparkSession, path: str, schema: str, strict: bool = True) -> DataFrame:
    """JSON lines as ``schema`` with the column problem; blank lines are skipped.

    problem is MALFORMED for lines that are no JSON object and, if ``strict``, FIELDS for those whose
    field names are not just those of the schema, else null.
    """
    rows = spark.read.text(path).where(F.trim("value") != "")
    want = spark.createDataFrame([], schema).schema
    keys = F.expr("json_object_keys(value)")
    bad = F.when(keys.isNull(), "MALFORMED")
    if strict:
        bad = bad.when(F.array_sort(keys) != F.array(*(F.lit(c) for c in sorted(want.names))), "FIELDS")
    return rows.select(F.from_json("value", want).alias("r"), bad.alias("problem")).select("r.*", "problem")


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object a line, nulls kept."""
    df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")).write.mode(mode).text(path)


def _entries(path: str) -> list[tuple[str, int]]:
    """(name, bytes) of the files in the archive at the mounted ``path``, from its directory alone; unsafe names and links are errors."""
    with zipfile.ZipFile(path) as z:
        for e in z.infolist():
            p = PurePosixPath(e.filename.replace("\\", "/"))
            if p.is_absolute() or ".." in p.parts or (e.external_attr >> 28) == 10:
                raise ValueError(f"unsafe entry {e.filename} in {path}")
        return [(e.filename, e.file_size) for e in z.infolist() if not e.is_dir()]


def read_zip(spark: SparkSession, path: str, together: int = 64 << 20) -> DataFrame:
    """(archive, path, content) of the files in the archives at ``path``, a file or folder that all executors mount.

    The archives' directories are read first, and the entries dealt to tasks of about ``together`` bytes,
    so an archive of any size is read by many tasks, each holding one entry at a time.
    """
    at = re.sub("^file:/*", "/", path)
    names = sorted(os.path.join(at, n) for n in os.listdir(at)) if os.path.isdir(at) else [at]
    tasks: list[tuple[str, list[str]]] = []
    for name in names:
        size = together
        for entry, n in _entries(name):
            if size >= together:
                tasks.append((name, []))
                size = 0
            tasks[-1][1].append(entry)
            size += n
    listed = spark.createDataFrame(tasks, "archive string, entries array<string>").repartition(max(1, len(tasks)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, entries in zip(batch["archive"], batch["entries"], strict=True):
                with zipfile.ZipFile(name) as z:
                    for e in entries:
                        yield pd.DataFrame({"archive": [name], "path": [e.replace("\\", "/")], "content": [z.read(e)]})

    return listed.mapInPandas(run, "archive string, path string, content binary")


def extract_checked(archive: str, root: str) -> list[str]:
    """Extract the archive below ``root``; files that are there already must hold the same bytes. Returns the new ones."""
    from caseloom.sources.catalog import safe_path

    new = []
    with zipfile.ZipFile(archive) as z:
        for entry, size in _entries(archive):
            target = safe_path(root, entry)
            if target.exists():
                crc = 0
                with open(target, "rb") as f:
                    while chunk := f.read(1 << 20):
                        crc = zlib.crc32(chunk, crc)
                if target.stat().st_size != size or crc != z.getinfo(entry).CRC:
                    raise ValueError(f"{entry} is there with other content")
                continue
            target.parent.mkdir(parents=True, exist_ok=True)
            part = target.with_name(target.name + ".part")
            with z.open(entry) as source, open(part, "wb") as out:
                shutil.copyfileobj(source, out, 1 << 20)
            os.replace(part, target)
            new.append(entry)
    return new
