"""Readers for label files, CSV tables and image folders; all of them are scans that executors do.

CSV files double their quotes, may hold line breaks in fields and may begin with a byte
order mark. A file's rows are numbered in file order; record 2 is the first after the header.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemark.functions import scores as sc
from sievemark.sources import schemas

# Image files by their suffix.
IMAGE_SUFFIXES = ["jpg", "jpeg", "png", "bmp", "webp"]


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def plain_uri(c: Column) -> Column:
    """Spark's sources write one or three slashes after a scheme; this is always one."""
    return F.regexp_replace(c, "^([a-z0-9]+):/+", "$1:/")


def csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.options(header=True, escape='"', multiLine=True, encoding="UTF-8")
    return (reader.schema(schema) if schema else reader.option("inferSchema", False)).csv(path)


def csv_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The file's rows; none if there is no file."""
    return csv(spark, path, schema) if exists(spark, path) else spark.createDataFrame([], schema)


def candidates(spark: SparkSession, path: str) -> DataFrame:
    return csv_or_empty(spark, path, schemas.CANDIDATE_SCHEMA)


def _need(df: DataFrame, columns: Sequence[str]) -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def _numbered(df: DataFrame) -> DataFrame:
    """With record: a number that rises in file order. One file with line breaks in fields is one partition, so it is dense there."""
    return df.withColumn("record", F.monotonically_increasing_id() + 2)


def _refuse(df: DataFrame, faults: Column) -> None:
    """Raises for the first row with a fault."""
    bad = df.withColumn("__fault", faults).filter(F.col("__fault").isNotNull()).agg(F.min(F.struct("record", "__fault")).alias("x")).first()["x"]
    if bad:
        raise ValueError(f"record {bad['record']}: {bad['__fault']}")


def reviewed(spark: SparkSession, path: str, classes: Sequence[str] = (), class_column: str = "class_name", conf_column: str = "conf", verdict_column: str = "verdict") -> DataFrame:
    """Rows (class_name, conf, accepted). Classes are filtered first; then a fault in any row is an error."""
    raw = csv(spark, path)
    _need(raw, [class_column, conf_column, verdict_column])
    d = _numbered(raw).withColumn("__c", F.trim(F.coalesce(F.col(class_column), F.lit(""))))
    d = d.filter(F.col("__c").isin(list(classes))) if classes else d
    conf, verdict = sc.unit_float(F.col(conf_column)), sc.verdict(F.coalesce(F.col(verdict_column), F.lit("")))
    _refuse(d, F.when(F.col("__c") == "", "empty class").when(conf.isNull(), "confidence is not a number from 0 to 1").when(verdict.isNull(), F.concat(F.lit("unsupported verdict: "), F.coalesce(F.col(verdict_column), F.lit("")))))
    return d.select(F.col("__c").alias("class_name"), conf.alias("conf"), verdict.alias("accepted"))


def consensus_input(spark: SparkSession, path: str, classes: Sequence[str] = ()) -> DataFrame:
    """The file's own columns prefixed by ``raw_``, beside typed ones for the consensus operator; idx is the file order."""
    raw = csv(spark, path)
    _need(raw, schemas.CONSENSUS_NEEDS)
    d = _numbered(raw)
    name = F.trim(F.coalesce(F.col("class_name"), F.lit("")))
    d = d.filter(name.isin(list(classes))) if classes else d
    numbers = {c: sc.unit_float(F.col(c)) for c in ("conf", "cx", "cy", "w", "h")}
    mode = F.lower(F.trim(F.coalesce(F.col("mode"), F.lit(""))))
    fault = F.when(name == "", "empty class").when(~mode.isin("auto", "review"), "mode is neither auto nor review")
    for c, v in numbers.items():
        fault = fault.when(v.isNull(), f"{c} is not a number from 0 to 1")
    _refuse(d, fault)
    return d.select(F.col("record").alias("idx"), F.trim("split").alias("split"), sc.normalized_image(F.col("image")).alias("image"), name.alias("class_id"), mode.alias("mode"), *[v.alias(c) for c, v in numbers.items()], *[F.col(c).alias(f"raw_{c}") for c in raw.columns])


def queue_input(spark: SparkSession, path: str, modes: Sequence[str] = ("review",), classes: Sequence[str] = ()) -> DataFrame:
    """Rows (split, image, class_name, conf, mode). All rows are checked before modes and classes are chosen."""
    raw = csv(spark, path)
    _need(raw, schemas.QUEUE_NEEDS)
    d = _numbered(raw)
    conf, mode = sc.unit_float(F.col("conf")), F.lower(F.trim(F.coalesce(F.col("mode"), F.lit(""))))
    text = {c: F.trim(F.coalesce(F.col(c), F.lit(""))) for c in ("split", "image", "class_name")}
    fault = F.when(conf.isNull(), "conf is not a number from 0 to 1").when(~mode.isin("auto", "review"), "mode is neither auto nor review")
    for c, v in text.items():
        fault = fault.when(v == "", f"empty {c}")
    _refuse(d, fault)
    d = d.select(*[v.alias(c) for c, v in text.items()], conf.alias("conf"), mode.alias("mode")).filter(F.col("mode").isin(list(modes)))
    return d.filter(F.col("class_name").isin(list(classes))) if classes else d


def images(spark: SparkSession, root: str, splits: Sequence[str], recursive: bool = True) -> DataFrame:
    """Rows (split, path, relative, stem, length) of the image files below ``root``/images/<split>; contents are not read.

    The flat listing takes suffixes in lower or upper case only, the recursive one in any case.
    """
    suffixes = [x for s in IMAGE_SUFFIXES for x in (s, s.upper())]
    out = None
    for split in dict.fromkeys(splits):
        path = f"{root}/images/{split}"
        if not exists(spark, path):
            continue
        d = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(path).select(plain_uri(F.col("path")).alias("path"), "length")
        suffix = F.regexp_extract("path", r"\.([^./]*)$", 1)
        d = d.filter(F.lower(suffix).isin(IMAGE_SUFFIXES) if recursive else suffix.isin(suffixes))
        relative = F.element_at(F.split("path", f"/images/{split}/", 2), 2)
        d = d.select(F.lit(split).alias("split"), "path", relative.alias("relative"), sc.stem(relative).alias("stem"), "length")
        out = d if out is None else out.unionByName(d)
    return out if out is not None else spark.createDataFrame([], "split string, path string, relative string, stem string, length long")


def image_hashes(spark: SparkSession, root: str, splits: Sequence[str]) -> DataFrame:
    """Rows (hash, split, path): SHA-256 of each image file."""
    listed = images(spark, root, splits).select("split", "path")
    content = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{root}/images").select(plain_uri(F.col("path")).alias("path"), F.sha2("content", 256).alias("hash"))
    return listed.join(content, "path").select("hash", "split", "path")


def corrupt_images(spark: SparkSession, root: str) -> DataFrame:
    """Paths of images that cannot be decoded; they never fail the job."""
    d = spark.read.format("image").option("recursiveFileLookup", True).load(f"{root}/images")
    return d.filter(F.col("image.width") <= 0).select(plain_uri(F.col("image.origin")).alias("path"))


def label_lines(spark: SparkSession, root: str, splits: Sequence[str], recursive: bool = True, folder: str = "labels") -> DataFrame:
    """Rows (split, file, line_no, value) of the text files below ``root``/labels/<split>; file is the path without suffix."""
    out = None
    for split in dict.fromkeys(splits):
        path = f"{root}/{folder}/{split}"
        if not exists(spark, path):
            continue
        d = spark.read.option("recursiveFileLookup", recursive).option("pathGlobFilter", "*.txt").text(path, wholetext=True)
        d = d.select(F.element_at(F.split(F.col("_metadata.file_path"), f"/{folder}/{split}/", 2), 2).alias("f"), F.posexplode(F.split("value", r"\r\n|\n|\r")).alias("p", "value"))
        d = d.select(F.lit(split).alias("split"), sc.stem(F.col("f")).alias("file"), (F.col("p") + 1).alias("line_no"), "value")
        out = d if out is None else out.unionByName(d)
    return out if out is not None else spark.createDataFrame([], "split string, file string, line_no int, value string")


def label_files(spark: SparkSession, root: str, splits: Sequence[str]) -> DataFrame:
    """Rows (split, stem, size) of the label files."""
    out = None
    for split in dict.fromkeys(splits):
        path = f"{root}/labels/{split}"
        if not exists(spark, path):
            continue
        d = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").load(path)
        name = lambda c: sc.stem(F.element_at(F.split(c, f"/labels/{split}/", 2), 2))  # noqa: E731,B023
        sized = d.select(name(F.col("path")).alias("stem"), "length")
        # A scan leaves out files without bytes, the listing has them.
        listed = spark.createDataFrame([(unquote(f),) for f in d.inputFiles()], "f string").select(F.lit(split).alias("split"), name(F.col("f")).alias("stem"))
        d = listed.join(sized, "stem", "left").select("split", "stem", F.coalesce("length", F.lit(0)).alias("size"))
        out = d if out is None else out.unionByName(d)
    return out if out is not None else spark.createDataFrame([], "split string, stem string, size long")


def label_texts(spark: SparkSession, root: str, splits: Sequence[str]) -> DataFrame:
    """Rows (split, image, text): each label file's whole text, empty files too."""
    out = None
    for split in dict.fromkeys(splits):
        path = f"{root}/labels/{split}"
        if not exists(spark, path):
            continue
        d = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").text(path, wholetext=True)
        d = d.select(sc.stem(F.element_at(F.split(F.col("_metadata.file_path"), f"/labels/{split}/", 2), 2)).alias("stem"), "value")
        d = label_files(spark, root, [split]).join(d, "stem", "left").select("split", F.col("stem").alias("image"), F.coalesce("value", F.lit("")).alias("text"))
        out = d if out is None else out.unionByName(d)
    return out if out is not None else spark.createDataFrame([], "split string, image string, text string")


def boxes(lines: DataFrame, class_id: int | None = None) -> DataFrame:
    """Lenient reading: five words or more, numbers in the first five, positive sides; the class is cut to a whole number."""
    w = F.filter(F.split("value", r"\s+"), lambda x: x != "")
    v = F.transform(F.slice(w, 1, 5), lambda x: x.try_cast("double"))
    d = lines.withColumn("__v", v).filter((F.size("__v") == 5) & ~F.exists("__v", lambda x: x.isNull() | F.isnan(x)))
    c = F.get("__v", 0)
    d = d.filter((F.abs(c) < 2e9) & (F.get("__v", 3) > 0) & (F.get("__v", 4) > 0))
    out = d.select("split", F.col("file").alias("image"), F.when(c >= 0, F.floor(c)).otherwise(F.ceil(c)).cast("int").alias("class_id"), *[F.get("__v", i + 1).alias(n) for i, n in enumerate(("cx", "cy", "w", "h"))])
    return out.filter(F.col("class_id") == class_id) if class_id is not None else out


def resolved_images(wanted: DataFrame, inventory: DataFrame) -> DataFrame:
    """``wanted`` (split, image) with path and error: of the places an image name can mean, the first that exists."""
    keys = F.array(F.col("image"), F.concat_ws("/", F.lit("images"), "split", "image"), F.concat_ws("/", F.lit("images"), "image"))
    tried = wanted.select("split", "image", F.posexplode(keys).alias("rank", "place"))
    known = inventory.select(F.concat_ws("/", F.lit("images"), "split", "relative").alias("place"), "path")
    found = tried.join(known.unionByName(inventory.select(F.col("path").alias("place"), "path")).distinct(), "place").groupBy("split", "image").agg(F.min_by("path", "rank").alias("path"))
    return wanted.join(found, ["split", "image"], "left").withColumn("error", F.when(F.col("path").isNull(), "image not found inside the data set"))
