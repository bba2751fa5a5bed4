"""Writers: CSV tables, label files, JSON and HTML summaries."""

from __future__ import annotations

import html
import json
import os
import tempfile
import uuid
from datetime import UTC, datetime
from pathlib import Path
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.functions.scores import stem
from sievemark.plans.shipping import ship
from sievemark.plans.tables import cut

from sievemark.sources.schemas import CANDIDATE_KEY


def csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(header=True, escape='"', emptyValue="").csv(path)


def candidate_tables(df: DataFrame, root: str) -> None:
    """auto, review and all; a candidate that appears twice is written once."""
    rounded = df.withColumns({c: F.round(c, 6) for c in ("cx", "cy", "w", "h")}).dropDuplicates(CANDIDATE_KEY)
    rounded.write.mode("overwrite").partitionBy("mode").parquet(f"{root}/candidates")
    written = df.sparkSession.read.schema(rounded.schema).parquet(f"{root}/candidates")
    for mode in ("auto", "review"):
        csv(written.filter(F.col("mode") == mode), f"{root}/candidates_{mode}")
    csv(written, f"{root}/candidates_all")


def label_text(df: DataFrame) -> DataFrame:
    """Rows (split, image, position, value): a label line with six places, rounded as the number's own binary value, at the place of its idx."""
    exact = lambda c: F.col(c).cast("double")

    def run(batches):
        for b in batches:
            columns = [b.column(c).to_pylist() for c in ("class_id", "cx", "cy", "w", "h")]
            lines = [f"{int(k)} {x:.6f} {y:.6f} {w:.6f} {h:.6f}" for k, x, y, w, h in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("split"), b.column("image"), b.column("position"), pa.array(lines, pa.string())], names=["split", "image", "position", "value"])

    position = F.col("idx") if "idx" in df.columns else F.lit(0)
    named = df.select(F.col("split").cast("string").alias("split"), F.col("image").cast("string").alias("image"), position.cast("long").alias("position"), "class_id", *[exact(c).alias(c) for c in ("cx", "cy", "w", "h")])
    return named.mapInArrow(run, "split string, image string, position long, value string")


def safe_name(name: str) -> str:
    """A split's or file's name that stays below its folder."""
    parts = name.split("/")
    if not name or name.startswith("/") or "\\" in name or any(x in ("", ".", "..") for x in parts):
        raise ValueError(f"not a name below the folder: {name!r}")
    return name


def merged_text(old: str | None, new: list[str]) -> tuple[str, int]:
    """A label file's text with the lines that it lacks added at its end, in order, and how many these are."""
    text = old or ""
    known = {line.strip() for line in text.splitlines()}
    added = [x for x in dict.fromkeys(new) if x.strip() not in known]
    if not added:
        return text, 0
    gap = "" if not text or text.endswith("\n") else "\n"
    return f"{text}{gap}" + "".join(f"{x}\n" for x in added), len(added)


def _write(system: fs.FileSystem, path: str, data: bytes) -> None:
    """Whole or not at all, where renaming replaces a file."""
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with system.open_output_stream(part) as f:
        f.write(data)
    system.move(part, path)


def _place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address that executors see, and the path there."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), os.path.abspath(path))


def label_tree(old: DataFrame, new: DataFrame, root: str, folder: str | None = "labels") -> DataFrame:
    """Writes ``root``/<folder>/<split>/<stem>.txt for every file of ``old`` and ``new``; rows (split, image, lines, added).

    ``old`` has rows (split, image, text), one for each file; ``new`` rows (split, image,
    position, value), lines that are added by position and text. Each file is written by the task
    that holds it, whole or not at all; doing it again adds nothing. ``root`` is a folder
    that executors share.
    """
    ordered = F.sort_array(F.collect_set(F.struct("position", "value")))  # a picture's labels
    lines = new.groupBy("split", "image").agg(F.transform(ordered, lambda x: x["value"]).alias("new"))
    both = old.select("split", "image", "text").join(lines, ["split", "image"], "full")
    base = _place(root)[1] + (f"/{safe_name(folder)}" if folder else "")

    def run(batches):
        system = _place(root)[0]
        for b in batches:
            out = []
            for split, image, text, extra in zip(*[b.column(c).to_pylist() for c in ("split", "image", "text", "new")], strict=True):
                whole, added = merged_text(text, extra or [])
                _write(system, f"{base}/{safe_name(split)}/{safe_name(image)}.txt", whole.encode())
                out.append({"split": split, "image": image, "lines": sum(bool(x.strip()) for x in whole.splitlines()), "added": added})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("split", pa.string()), ("image", pa.string()), ("lines", pa.int64()), ("added", pa.int64())]))

    ship(__name__)
    return cut(both.mapInArrow(run, "split string, image string, lines bigint, added bigint"))


def agreed_labels(decided: DataFrame, names: DataFrame, path: str) -> DataFrame:
    """Label files of the agreed candidates only, below a folder that must not hold anything yet; rows (split, image, lines, added).

    ``names`` has rows (class_name, class_id); a candidate whose class has no number, or a
    negative one, is refused.
    """
    system, base = _place(path)
    if system.get_file_info(base).type != fs.FileType.NotFound and system.get_file_info(fs.FileSelector(base)):
        raise ValueError(f"not empty: {path}")
    rows = decided.filter("consensus_decision = 'agreed_auto'").withColumnRenamed("class_id", "class_name").join(F.broadcast(names), "class_name", "left")
    if not rows.filter("class_id is null or class_id < 0").isEmpty():
        raise ValueError("an agreed candidate's class has no number")
    new = label_text(rows.withColumn("image", stem(F.col("image"))))
    return label_tree(new.limit(0).select("split", "image", F.col("value").alias("text")), new, path, None)


def trainable(images: DataFrame, labels: DataFrame, names: list[str], dataset: str, out: str) -> dict:
    """A data set that can be trained on: pictures linked (or copied), label files with their additions, data.yaml.

    ``images`` has rows (split, path, relative) and ``labels`` rows (split, image, text).
    Returns how many pictures were linked and copied. A link is made where the file system
    is local to the task and has links; else the picture is copied.
    """
    base = _place(out)[1]

    def run(batches):
        system = _place(out)[0]
        for b in batches:
            done = []
            for split, path, relative in zip(*[b.column(c).to_pylist() for c in ("split", "path", "relative")], strict=True):
                source, at = _place(unquote(path))
                target = f"{base}/images/{safe_name(split)}/{safe_name(relative)}"
                system.create_dir(target.rsplit("/", 1)[0], recursive=True)
                done.append(_linked(source, at, system, target))
            yield pa.RecordBatch.from_pydict({"linked": pa.array(done, pa.bool_())})

    ship(__name__)
    counts = images.select("split", "path", "relative").mapInArrow(run, "linked boolean").groupBy("linked").agg(F.count(F.lit(1)).alias("n")).collect()
    nothing = labels.select("split", "image", F.lit(0).alias("position"), F.col("text").alias("value")).limit(0)
    label_tree(labels, nothing, out)
    splits = sorted({r["split"] for r in images.select("split").distinct().collect()})
    _write(*_place(f"{out}/data.yaml"), data_yaml(names, splits, base).encode())
    return {"linked": sum(r["n"] for r in counts if r["linked"]), "copied": sum(r["n"] for r in counts if not r["linked"])}


def _linked(source: fs.FileSystem, path: str, system: fs.FileSystem, target: str) -> bool:
    """Whether a link could be made; else the file is copied. A file that is there already is replaced."""
    if system.get_file_info(target).type != fs.FileType.NotFound:
        system.delete_file(target)
    if isinstance(source, fs.LocalFileSystem) and isinstance(system, fs.LocalFileSystem):
        try:
            os.link(path, target)
            return True
        except OSError:
            pass
    fs.copy_files(path, target, source_filesystem=source, destination_filesystem=system)
    return False


def data_yaml(names: list[str], splits: list[str], root: str) -> str:
    """The settings file that trainers read."""
    lines = [f"path: {json.dumps(root)}", *[f"{s}: {json.dumps(f'images/{s}')}" for s in splits], f"nc: {len(names)}", "names:"]
    return "\n".join([*lines, *[f"  {i}: {json.dumps(n, ensure_ascii=False)}" for i, n in enumerate(names)]]) + "\n"


def run_summary(path: str | Path, stats: list[dict], more: dict) -> None:
    """A text file with a line for each class and the totals."""
    totals = {k: sum(r[k] for r in stats) for k in ("predictions", "matched", "repeats", "auto", "review")}
    shown = lambda r: ", ".join(f"{k} {r[k]}" for k in totals)
    lines = [*(f"{k}: {v}" for k, v in more.items()), *(f"class {r['class_id']}: {shown(r)}" for r in stats), f"all: {shown(totals)}"]
    Path(path).write_text("\n".join(lines) + "\n", encoding="utf-8")


class Status:
    """status.json: running while a verb works, then complete or failed; counts how often an unfinished run was taken up again."""

    def __init__(self, out: str | Path, verb: str):
        self.path = Path(out) / "status.json"
        before = json.loads(self.path.read_text(encoding="utf-8")) if self.path.exists() else {}
        again = before.get("resume_count", 0) + 1 if before.get("verb") == verb and before.get("status") in ("running", "failed") else 0
        self.data = {"verb": verb, "status": "running", "started_at": datetime.now(UTC).isoformat(), "resume_count": again}

    def __enter__(self) -> Status:
        whole_json(self.path, self.data)
        return self

    def __exit__(self, kind, *_) -> None:
        whole_json(self.path, self.data | {"status": "failed" if kind else "complete", "ended_at": datetime.now(UTC).isoformat()})


def whole_json(path: str | Path, data: object) -> None:
    """The file is there whole or not at all."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    handle, name = tempfile.mkstemp(dir=path.parent, prefix=f".{path.name}.")
    with os.fdopen(handle, "w", encoding="utf-8") as f:
        json.dump(data, f, indent=2, ensure_ascii=False, default=str)
    os.replace(name, path)


def redacted(path: str) -> str:
    return f"<redacted>/{Path(path).name}"


def summary(verb: str, sources: list[str], tables: dict[str, DataFrame], redact: bool = False, **more: object) -> dict:
    """A dictionary of small result tables; every table here is an aggregate."""
    made = datetime.now(UTC).isoformat()
    return {"schema_version": 1, "verb": verb, "generated_at": made, "sources": [redacted(s) if redact else s for s in sources], **more, **{k: [r.asDict(recursive=True) for r in t.collect()] for k, t in tables.items()}}


def page(path: str | Path, data: dict) -> None:
    """The summary as one HTML file without outside references; all text is escaped."""
    parts = [f"<!DOCTYPE html><meta charset=utf-8><title>{html.escape(str(data.get('verb', '')))}</title><style>body{{font:14px sans-serif}}td,th{{border:1px solid #ccc;padding:2px 6px}}</style>"]
    for key, value in data.items():
        if isinstance(value, list) and value and isinstance(value[0], dict):
            head = "".join(f"<th>{html.escape(str(c))}</th>" for c in value[0])
            body = "".join("<tr>" + "".join(f"<td>{html.escape(str(x))}</td>" for x in r.values()) + "</tr>" for r in value[:500])
            parts.append(f"<h2>{html.escape(key)}</h2><table><tr>{head}</tr>{body}</table>")
        else:
            parts.append(f"<p><b>{html.escape(key)}</b>: {html.escape(str(value))}</p>")
    Path(path).write_text("\n".join(parts), encoding="utf-8")


def guard_output(root: str | Path, out: str | Path, *others: str | Path) -> None:
    """The output must lie outside the data set, and the data set and the ``others`` (model or input files) outside it."""
    r, o = Path(root).resolve(), Path(out).resolve()
    for x in others:
        if o == Path(x).resolve() or o in Path(x).resolve().parents:
            raise ValueError(f"an input lies within the output: {x}")
    if r == o or r in o.parents or o in r.parents:
        raise ValueError(f"the output must not overlap the data set: {out}")
