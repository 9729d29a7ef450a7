"""Pinned downloads on the driver: resumed, checked, recorded in a lock."""

from __future__ import annotations

import hashlib
import json
import os
import time
import urllib.error
import urllib.request
from pathlib import Path

from caseloom.sources.catalog import safe_path


def file_digest(path: str | Path, algorithm: str = "sha256") -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, algorithm).hexdigest()


def _check(path: Path, size: int | None, checksum: str | None) -> None:
    """``checksum`` is algorithm:digest."""
    if size is not None and path.stat().st_size != size:
        raise ValueError(f"{path.name}: {path.stat().st_size} bytes instead of {size}")
    if checksum:
        algorithm, _, want = checksum.partition(":")
        if file_digest(path, algorithm) != want:
            raise ValueError(f"{path.name}: {algorithm} digest differs")


def fetch(url: str, path: Path, size: int | None = None, checksum: str | None = None, tries: int = 3, pause: float = 1.0) -> bool:
    """Download ``url`` to ``path``; False if it is there already and holds.

    A part of an earlier try is continued where the server allows it. After a failure the next try
    waits twice as long; a complete file that does not hold is discarded.
    """
    if path.exists():
        _check(path, size, checksum)
        return False
    path.parent.mkdir(parents=True, exist_ok=True)
    part = path.with_name(path.name + ".part")
    for n in range(tries):
        have = part.stat().st_size if part.exists() else 0
        try:
            request = urllib.request.Request(url, headers={"Range": f"bytes={have}-"} if have else {})
            with urllib.request.urlopen(request, timeout=60) as answer:
                with part.open("ab" if have and answer.status == 206 else "wb") as out:
                    while chunk := answer.read(1 << 20):
                        out.write(chunk)
            _check(part, size, checksum)
            os.replace(part, path)
            return True
        except (urllib.error.URLError, ConnectionError, TimeoutError, ValueError) as e:
            if isinstance(e, ValueError) or (isinstance(e, urllib.error.HTTPError) and e.code == 416):
                part.unlink(missing_ok=True)
            if n + 1 == tries:
                raise
            time.sleep(pause * 2**n)
    raise AssertionError


def get_json(url: str, tries: int = 3, pause: float = 1.0) -> object:
    """The JSON document at ``url``; after a failure of the connection the next try waits twice as long."""
    for n in range(tries):
        try:
            with urllib.request.urlopen(urllib.request.Request(url, headers={"Accept": "application/json"}), timeout=60) as answer:
                return json.loads(answer.read().decode("utf-8-sig"))
        except (urllib.error.URLError, ConnectionError, TimeoutError):
            if n + 1 == tries:
                raise
            time.sleep(pause * 2**n)
    raise AssertionError


def fetch_at_commit(template: str, commit: str, path: Path, checksum: str | None = None, **how) -> dict:
    """Fetch ``template`` with {commit} filled in; returns what a lock needs to pin it.

    Only a whole commit id is taken: names of branches and tags may point elsewhere tomorrow.
    """
    if len(commit) != 40 or set(commit) - set("0123456789abcdef"):
        raise ValueError(f"{commit} is no whole commit id")
    url = template.format(commit=commit)
    fetch(url, path, checksum=checksum, **how)
    return {"url": url, "commit": commit, "sha256": file_digest(path), "bytes": path.stat().st_size}


def probe(url: str, timeout: float = 10.0) -> dict:
    """Whether a service answers at ``url``: {reachable, status, problem}; sends no data."""
    try:
        with urllib.request.urlopen(urllib.request.Request(url, method="HEAD"), timeout=timeout) as answer:
            return {"reachable": True, "status": answer.status, "problem": None}
    except urllib.error.HTTPError as e:
        return {"reachable": True, "status": e.code, "problem": str(e.reason)}
    except (urllib.error.URLError, ConnectionError, TimeoutError) as e:
        return {"reachable": False, "status": None, "problem": str(getattr(e, "reason", e))}


def acquire(root: str | Path, files: list[dict], lock: str = "source_lock.json", **how) -> dict:
    """Fetch ``files`` (path, url, size, checksum) below ``root`` and record them; returns the lock by path.

    The lock is written after every file, so an interrupted run goes on where it was. A file whose record
    says otherwise than the lock is an error: what is pinned does not change.
    """
    at = safe_path(root, lock)
    known = json.loads(at.read_text()) if at.exists() else {}
    for f in files:
        old = known.get(f["path"])
        if old and f.get("checksum") and old.get("checksum") not in (None, f["checksum"]):
            raise ValueError(f"{f['path']} is pinned to another version")
        path = safe_path(root, f["path"])
        fetch(f["url"], path, f.get("size"), f.get("checksum"), **how)
        known[f["path"]] = {"url": f["url"], "checksum": f.get("checksum"), "bytes": path.stat().st_size, "sha256": file_digest(path)}
        new = at.with_name(at.name + ".new")
        new.write_text(json.dumps(known, sort_keys=True, indent=1))
        os.replace(new, at)
    return known


def differs_from_latest(pinned: dict, latest: dict, fields: tuple[str, ...] = ("id", "version")) -> list[str]:
    """The fields in which the pinned record is not the latest one."""
    return [f for f in fields if pinned.get(f) != latest.get(f)]
