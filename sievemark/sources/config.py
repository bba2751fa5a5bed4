"""Small settings files, read on the driver."""

from __future__ import annotations

import json
from dataclasses import dataclass
from pathlib import Path

# Thresholds (auto, review) of each class where none are given.
THRESHOLDS = {"person": (0.75, 0.55), "helmet": (0.75, 0.55), "vest": (0.75, 0.55), "tractor": (0.70, 0.50), "slipper": (0.65, 0.45), "smoking": (0.65, 0.40)}


@dataclass(frozen=True)
class Model:
    path: str
    pred_class: int = 0


def thresholds(overrides: list[str], defaults: dict[str, tuple[float, float]] | None = None) -> dict[str, tuple[float, float]]:
    """Defaults with ``class:auto:review`` overrides, where 0 <= review <= auto <= 1."""
    out = dict(THRESHOLDS if defaults is None else defaults)
    for text in overrides:
        match text.split(":"):
            case [name, high, low] if name in out:
                auto, review = float(high), float(low)
            case _:
                raise ValueError(f"not class:auto:review of a known class: {text}")
        if not (0 <= review <= auto <= 1):
            raise ValueError(f"not 0 <= review <= auto <= 1: {text}")
        out[name] = (auto, review)
    return out


def models(raw: object) -> dict[str, Model]:
    """From an object of class to path, or to an object with path and pred_class."""
    if not isinstance(raw, dict):
        raise ValueError("models must be an object")
    out = {}
    for name, spec in raw.items():
        spec = {"path": spec} if isinstance(spec, str) else spec
        if not isinstance(spec, dict) or "path" not in spec:
            raise ValueError(f"{name}: neither a path nor an object with a path")
        out[name] = Model(str(spec["path"]), int(spec.get("pred_class", 0)))
    return out


def load_models(path: str | Path) -> dict[str, Model]:
    """Relative model paths are looked up beside the file first, then in the working folder."""
    path = Path(path)
    out = {}
    for name, m in models(json.loads(path.read_text(encoding="utf-8"))).items():
        p = Path(m.path).expanduser()
        options = [p] if p.is_absolute() else [path.resolve().parent / p, Path.cwd() / p]
        out[name] = Model(str(next((x for x in options if x.exists()), options[0]).resolve()), m.pred_class)
    return out


def class_names(data: object) -> list[str]:
    """The data set's class names from its parsed YAML: a list, or a map from 0, 1, ... on."""
    if not isinstance(data, dict):
        raise ValueError("data.yaml must be a mapping")
    names = data.get("names")
    if isinstance(names, dict):
        ids = {int(k): str(v) for k, v in names.items()}
        if sorted(ids) != list(range(len(ids))):
            raise ValueError("class ids must be 0, 1, ... without gaps")
        names = [ids[i] for i in range(len(ids))]
    if not isinstance(names, list) or not names:
        raise ValueError("names must be a list or a map")
    names = [str(n) for n in names]
    if len(set(names)) < len(names):
        raise ValueError("class names must differ")
    if "nc" in data and int(data["nc"]) != len(names):
        raise ValueError("nc is not the number of names")
    return names


def load_class_names(path: str | Path) -> list[str]:
    text = Path(path).read_text(encoding="utf-8")
    try:
        import yaml
    except ImportError:
        return class_names(_plain_yaml(text))
    return class_names(yaml.safe_load(text))


def _plain_yaml(text: str) -> dict:
    """Enough for a data.yaml without nesting but names: ``key: value``, ``names: [a, b]``, or indented ``- a`` or ``0: a`` below it."""
    out: dict = {}
    key = ""
    for raw in text.splitlines():
        line = raw.split(" #")[0].rstrip()
        if not line.strip() or line.lstrip().startswith("#"):
            continue
        body = line.strip()
        if body.startswith("- "):
            out[key] = [*(out.get(key) or []), body[2:].strip().strip("'\"")]
            continue
        name, _, value = (x.strip() for x in body.partition(":"))
        if line[0] in " \t" and key:
            out[key] = {**(out.get(key) or {}), name: value.strip("'\"")}
        elif value.startswith("["):
            out[key := name] = [x.strip().strip("'\"") for x in value.strip("[]").split(",") if x.strip()]
        else:
            out[key := name] = value.strip("'\"") or None
    return out
