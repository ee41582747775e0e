"""JSON documents of runs: gzipped by suffix, with numpy values and enumerations."""

from __future__ import annotations

import gzip
import json
from enum import Enum
from typing import Any

import numpy as np


def _plain(value: Any) -> Any:
    if isinstance(value, Enum):
        return value.name
    if isinstance(value, np.ndarray):
        return value.tolist()
    if isinstance(value, np.generic):
        return value.item()
    raise TypeError(f"{type(value).__name__} has no JSON form")


def _open(path: str, mode: str):
    return gzip.open(path, mode, encoding="utf-8") if path.endswith(".gz") else open(path, mode, encoding="utf-8")


def save_json(path: str, value: Any) -> None:
    """``value`` as a text of lines indented by tabs; letters beyond ASCII stay."""
    with _open(path, "wt") as f:
        json.dump(value, f, ensure_ascii=False, indent="\t", default=_plain)


def load_json(path: str) -> Any:
    with _open(path, "rt") as f:
        return json.load(f)
