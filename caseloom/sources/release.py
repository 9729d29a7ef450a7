"""Write-once releases: staged, checksummed, renamed at the end, verified."""

from __future__ import annotations

import json
import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.sources.acquire import file_digest
from caseloom.sources.catalog import safe_path


def write_ledger(df: DataFrame, path: str) -> None:
    """The distinct sorted rows as one CSV file with a header; for ledgers, which are small."""
    df.distinct().orderBy(*df.columns).coalesce(1).write.mode("errorifexists").option("header", True).csv(path)


def build_card(manifest: DataFrame, version: str, label: str, licence: str, part: str) -> dict:
    """The card of a release from aggregates: rows, classes, licences and rows by part."""
    counts = manifest.groupBy(label, licence, part).agg(F.count("*").alias("n")).collect()  # labels x licences x parts
    by = lambda k: {str(v): sum(r["n"] for r in counts if r[k] == v) for v in sorted({r[k] for r in counts}, key=str)}
    return {"version": version, "rows": sum(r["n"] for r in counts), "classes": by(label), "licences": sorted(by(licence)), "parts": by(part)}


def copy_checked(pairs: list[tuple[str, str, str]], root: Path) -> None:
    """Copy (source, relative target, sha256), checking the digest before and after."""
    for source, relative, want in pairs:
        if file_digest(source) != want:
            raise ValueError(f"{source} has changed")
        target = safe_path(root, relative)
        target.parent.mkdir(parents=True, exist_ok=True)
        shutil.copyfile(source, target)
        if file_digest(target) != want:
            raise ValueError(f"{relative} was not copied whole")


def publish(root: str | Path, version: str, tables: dict[str, DataFrame], card: dict, ledgers: dict[str, DataFrame] | None = None, files: list[tuple[str, str, str]] | None = None, problems: DataFrame | None = None) -> Path:
    """Make the release ``version`` below ``root``; nothing is left behind if a step fails.

    ``problems`` is the gate: if it has a row, no release is made. An existing version is never changed.
    """
    target = safe_path(root, version)
    if target.exists():
        raise FileExistsError(version)
    if problems is not None and (rows := problems.limit(5).collect()):
        raise ValueError(f"the gate does not pass: {rows}")
    target.parent.mkdir(parents=True, exist_ok=True)
    stage = Path(tempfile.mkdtemp(prefix=f".{target.name}-", dir=target.parent))
    try:
        for name, df in tables.items():
            df.write.option("compression", "zstd").parquet(safe_path(stage, name + ".parquet").as_uri())
        for name, df in (ledgers or {}).items():
            write_ledger(df, safe_path(stage, name + ".csv").as_uri())
        copy_checked(files or [], stage)
        (stage / "gate.json").write_text(json.dumps({"status": "PASS"}))
        (stage / "card.json").write_text(json.dumps(card, sort_keys=True, ensure_ascii=False, indent=1))
        sums = {str(p.relative_to(stage)): {"bytes": p.stat().st_size, "sha256": file_digest(p)} for p in sorted(stage.rglob("*")) if p.is_file() and not p.name.endswith(".crc")}
        (stage / "checksums.json").write_text(json.dumps(sums, sort_keys=True, indent=1))
        os.rename(stage, target)
    except BaseException:
        shutil.rmtree(stage, ignore_errors=True)
        raise
    return target


def verify_release(spark: SparkSession, path: str | Path) -> list[str]:
    """What is amiss with a release: files that are missing, changed or not listed, a gate that did not pass, or an empty table."""
    root = Path(path)
    if not (root / "checksums.json").exists():
        return ["checksums.json is missing"]
    sums = json.loads((root / "checksums.json").read_text())
    found = {str(p.relative_to(root)) for p in root.rglob("*") if p.is_file() and not p.name.endswith(".crc") and p.name != "checksums.json"}
    out = [f"{n} is missing" for n in sorted(set(sums) - found)] + [f"{n} is not listed" for n in sorted(found - set(sums))]
    for n in sorted(found & set(sums)):
        if (root / n).stat().st_size != sums[n]["bytes"] or file_digest(root / n) != sums[n]["sha256"]:
            out.append(f"{n} has changed")
    if (root / "gate.json").exists() and not out and json.loads((root / "gate.json").read_text()).get("status") != "PASS":
        out.append("the gate did not pass")
    if (root / "manifest.parquet").exists() and not out and spark.read.parquet((root / "manifest.parquet").resolve().as_uri()).limit(1).count() == 0:
        out.append("the manifest is empty")
    return out


def overlap_problems(manifest: DataFrame, fields: list[str], by: str) -> DataFrame:
    """(field, n) of the fields that tie different values of ``by`` together; a gate for :func:`publish`."""
    from caseloom.operators.splits import overlaps

    return overlaps(manifest, fields, by).where(F.col("n") > 0)
