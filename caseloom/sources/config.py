"""Settings of a project: YAML or JSON files as plain values."""

from __future__ import annotations

import json
from pathlib import Path

from caseloom.sources.catalog import safe_path


def read_config(root: str | Path, name: str) -> dict:
    """The mapping in ``name``.yaml, .yml or .json below ``root``; an empty file is an empty mapping.

    YAML needs its parser to be installed; JSON does not. A missing file and one that holds no mapping
    are errors.
    """
    for suffix in (".yaml", ".yml", ".json"):
        path = safe_path(root, name + suffix)
        if not path.exists():
            continue
        text = path.read_text(encoding="utf-8-sig")
        if suffix == ".json":
            value = json.loads(text) if text.strip() else {}
        else:
            try:
                import yaml
            except ImportError as e:
                raise RuntimeError(f"{path.name} needs a YAML parser; none is installed") from e
            value = yaml.safe_load(text)
        value = {} if value is None else value
        if not isinstance(value, dict):
            raise ValueError(f"{path.name} holds no mapping")
        return value
    raise FileNotFoundError(f"no configuration {name}")
