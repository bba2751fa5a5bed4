"""Command line: python -m sievemark.cli VERB ... Each verb reads files, runs one operator and writes tables, JSON and HTML."""

from __future__ import annotations

import argparse
import platform
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemark import __version__
from sievemark.operators import audit, calibrate, consensus, prioritize, recover, report, similar
from sievemark.sources import config, files, pictures, sinks


def session() -> SparkSession:
    return SparkSession.builder.appName("sievemark").getOrCreate()


def _finish(out: str, verb: str, sources: list[str], tables: dict[str, DataFrame], redact: bool, **more: object) -> dict:
    data = sinks.summary(verb, sources, tables, redact, **more)
    sinks.whole_json(Path(out) / f"{verb}.json", data)
    sinks.page(Path(out) / f"{verb}.html", data)
    return data


def run_run(a: argparse.Namespace) -> int:
    """Predictions (a CSV of split, image, class_name, conf, cx, cy, w, h) against a data set's labels."""
    spark = session()
    sinks.guard_output(a.dataset, a.output, a.predictions)
    names = config.load_class_names(Path(a.dataset) / "data.yaml")
    limits = config.thresholds(a.threshold, {n: config.THRESHOLDS.get(n, (0.75, 0.55)) for n in names})
    classes = spark.createDataFrame([(i, n, *limits[n]) for i, n in enumerate(names)], "class_id int, class_name string, auto_thr double, review_thr double")
    raw = files.csv(spark, a.predictions)
    numbers = [F.col(c).try_cast("double").alias(c) for c in ("conf", "cx", "cy", "w", "h")]
    p = raw.select("split", "image", "class_name", *numbers, F.monotonically_increasing_id().alias("idx")).join(F.broadcast(classes.select("class_id", "class_name")), "class_name").drop("class_name")
    labels = files.boxes(files.label_lines(spark, a.dataset, a.splits))
    stems = p.withColumn("image", F.regexp_replace(F.element_at(F.split("image", "/"), -1), r"\.[^.]*$", ""))
    best = classes.select("class_id", "auto_thr", "review_thr")
    kept = recover.distinct_boxes(recover.candidates(stems, labels, best, a.iou_existing), a.iou_duplicate)
    sinks.candidate_tables(kept, a.output)
    made: dict = {}
    if a.apply or a.trainable:
        texts = files.label_texts(spark, a.dataset, a.splits)
        made["labels_added"] = sinks.label_tree(texts, sinks.label_text(kept.filter("mode = 'auto'")), a.output).agg(F.sum("added").alias("n")).first()["n"] or 0
    if a.trainable:
        merged = files.label_texts(spark, a.output, a.splits)
        made["images"] = sinks.trainable(files.images(spark, a.dataset, a.splits), merged, names, a.dataset, f"{a.output}/trainable")
    stats = recover.class_statistics(stems, labels, best, a.iou_existing, a.iou_duplicate)
    shown = [r.asDict() for r in stats.orderBy("class_id").collect()]
    sinks.run_summary(Path(a.output) / "summary.txt", shown, {"dataset": sinks.redacted(a.dataset) if a.redact else a.dataset, **made})
    totals = {k: sum(r[k] for r in shown) for k in ("predictions", "matched", "repeats", "auto", "review")}
    _finish(a.output, "run", [a.dataset, a.predictions], {"stats": stats, "histograms": report.histogram(kept, {"auto_conf": (F.col("mode") == "auto", F.col("conf")), "review_conf": (F.col("mode") == "review", F.col("conf")), "auto_iou": (F.col("mode") == "auto", F.col("max_iou"))})}, a.redact, totals=totals, **made)
    return 0


def run_audit(a: argparse.Namespace) -> int:
    """Exit code 2 for critical findings, 3 for files that two splits share."""
    spark = session()
    names = config.load_class_names(Path(a.dataset) / "data.yaml")
    images = files.images(spark, a.dataset, a.splits).select("split", "stem")
    labels = files.label_files(spark, a.dataset, a.splits)
    checked = audit.checked_lines(files.label_lines(spark, a.dataset, a.splits), len(names))
    orphans = audit.unmatched(images, labels).filter("kind = 'orphan_label'").select("split", F.col("stem").alias("path"), F.lit(None).cast("int").alias("line"), "kind", F.lit("no matching image").alias("detail"))
    read = checked.join(images.select("split", F.col("stem").alias("file")).distinct(), ["split", "file"])
    findings = audit.line_findings(read).unionByName(orphans)
    if a.check_images:
        bad = files.images(spark, a.dataset, a.splits).join(files.corrupt_images(spark, a.dataset), "path")
        findings = findings.unionByName(bad.select("split", F.col("relative").alias("path"), F.lit(None).cast("int").alias("line"), F.lit("corrupt_image").alias("kind"), F.lit("cannot be decoded").alias("detail")))
    groups = audit.duplicates(files.image_hashes(spark, a.dataset, a.splits))
    leaks = groups.filter("cross_split")
    findings = findings.unionByName(leaks.select(F.lit("").alias("split"), F.col("hash").alias("path"), F.lit(None).cast("int").alias("line"), F.lit("cross_split_duplicate").alias("kind"), F.concat(F.col("n").cast("string"), F.lit(" files")).alias("detail")))
    classes = spark.createDataFrame(list(enumerate(names)), "class_id int, class_name string")
    data = _finish(a.output, "audit", [a.dataset], {"status": audit.status(findings), "splits": audit.split_statistics(images, labels, checked), "classes": audit.class_objects(read, classes), "issues": audit.issue_counts(findings), "duplicates": groups.orderBy(F.col("n").desc(), "hash").limit(20), "details": audit.details(findings, a.details)}, a.redact, cross_split_groups=leaks.count())
    return 2 if data["status"][0]["status"] == "fail" else 3 if data["cross_split_groups"] else 0


def run_calibrate(a: argparse.Namespace) -> int:
    rows = files.reviewed(session(), a.reviewed, a.classes, a.class_column, a.conf_column, a.verdict_column)
    sinks.csv(calibrate.curve(rows, a.level).orderBy("class_name", "threshold"), f"{a.output}/curve")
    chosen = calibrate.policy(rows, a.precision, a.level, a.recall, a.samples).orderBy("class_name")
    data = _finish(a.output, "calibrate", [a.reviewed], {"classes": chosen}, a.redact)
    for r in data["classes"]:
        if r["auto_threshold"] is not None and r["review_threshold"] is not None:
            print(f"{r['class_name']}:{r['auto_threshold']}:{r['review_threshold']}")
    return 0


def run_consensus(a: argparse.Namespace) -> int:
    spark = session()
    decided = consensus.decisions(files.consensus_input(spark, a.primary, a.classes), files.consensus_input(spark, a.verifier, a.classes).select("split", "image", "class_id", "idx", "conf", "cx", "cy", "w", "h"), a.iou, a.conf)
    raw = [c for c in decided.columns if c.startswith("raw_")]
    table = decided.orderBy("idx").select(*[(F.col("mode") if c == "raw_mode" else F.col(c)).alias(c[4:]) for c in raw], *[F.col(c) for c in ("verifier_conf", "agreement_iou", "consensus_score", "consensus_decision")])
    for name, part in (("all", table), ("auto", table.filter("mode = 'auto'")), ("review", table.filter("mode = 'review'"))):
        sinks.csv(part, f"{a.output}/consensus_{name}")
    if a.labels:
        names = config.load_class_names(a.names)
        numbers = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "class_name string, class_id int")
        path = F.regexp_replace(F.trim("raw_image"), r"\\", "/")
        within = F.concat(F.lit("images/"), F.col("split"), F.lit("/"))
        below = F.when(F.startswith(path, within), F.substring(path, F.length(within) + 1, F.length(path))).otherwise(path)
        sinks.agreed_labels(decided.withColumn("image", below), numbers, a.labels)
    _finish(a.output, "consensus", [a.primary, a.verifier], {"classes": consensus.totals(decided).orderBy(F.col("class_id").asc_nulls_last())}, a.redact)
    return 0


def run_cluster(a: argparse.Namespace) -> int:
    """Exit code 3 if a group spans splits."""
    spark = session()
    sinks.guard_output(a.dataset, a.output)
    fp = pictures.fingerprints(spark, a.dataset, a.splits)
    good, failed = fp.filter("error IS NULL").drop("error"), fp.filter("error IS NOT NULL").select("split", "path", "error")
    groups = similar.clusters(good, a.least, a.full_edges, a.dhash, ahash=a.ahash, aspect=a.aspect)
    named = groups.withColumn("cluster", F.format_string("ND-%05d", "cluster"))
    sinks.csv(named.orderBy("cluster", "split", "path"), f"{a.output}/members")
    sinks.csv(similar.representatives(named).orderBy("cluster"), f"{a.output}/representatives")
    sinks.csv(failed, f"{a.output}/failures")
    data = _finish(a.output, "cluster", [a.dataset], {"summary": similar.summary(good, groups, fp.count(), failed.count()), "sizes": similar.size_distribution(groups)}, a.redact)
    return 3 if data["summary"][0]["cross_split_clusters"] else 0


def run_prioritize(a: argparse.Namespace) -> int:
    spark = session()
    sinks.guard_output(a.dataset, a.output)
    rows = files.queue_input(spark, a.candidates, a.modes, a.classes)
    inventory = files.images(spark, a.dataset, a.splits)
    places = files.resolved_images(rows.select("split", "image").distinct(), inventory)
    origin = inventory.select(F.col("path"), F.concat_ws("/", F.lit("images"), "split", "relative").alias("place"))
    fp = pictures.fingerprints(spark, a.dataset, a.splits).filter("error IS NULL").select(F.col("path").alias("place"), "dhash", "ahash")
    hashed = places.join(origin, "path").join(fp, "place").select("split", "image", "dhash", "ahash")
    pool = prioritize.items(rows, hashed)
    if not pool.take(1):
        raise ValueError("none of the images can be read")
    chosen = prioritize.queue(pool, a.budget, tuple(a.weights))
    sinks.csv(chosen.orderBy("priority_rank"), f"{a.output}/review_queue")
    sinks.csv(prioritize.queue_candidates(chosen, rows).orderBy("priority_rank"), f"{a.output}/queue_candidates")
    sinks.csv(prioritize.pool_table(pool, chosen).withColumn("classes", F.array_join("classes", ",")), f"{a.output}/review_pool")
    sinks.csv(places.filter("error IS NOT NULL").select("split", "image", "error"), f"{a.output}/failures")
    _finish(a.output, "prioritize", [a.dataset, a.candidates], {"classes": prioritize.class_rarity(rows.join(hashed.select("split", "image"), ["split", "image"]))}, a.redact)
    return 0


def run_report(a: argparse.Namespace) -> int:
    c = files.candidates(session(), f"{a.output}/candidates_all")
    auto, review = F.col("mode") == "auto", F.col("mode") == "review"
    drawn = {"auto_conf": (auto, F.col("conf")), "review_conf": (review, F.col("conf")), "auto_iou": (auto, F.coalesce("max_iou_same_class", F.col("max_iou")) if "max_iou" in c.columns else F.col("max_iou_same_class"))}
    _finish(a.output, "report", [a.output], {"counts": report.mode_counts(c), "histograms": report.histogram(c, drawn)}, a.redact)
    return 0


def run_doctor(a: argparse.Namespace) -> int:
    s = session()
    print(f"sievemark {__version__}, Python {platform.python_version()}, Spark {s.version}, master {s.sparkContext.master}, default parallelism {s.sparkContext.defaultParallelism}")
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sievemark", description=__doc__)
    verbs = p.add_subparsers(dest="verb", required=True)

    def verb(f, *paths: str) -> argparse.ArgumentParser:
        v = verbs.add_parser(f.__name__[4:], help=(f.__doc__ or "").strip())
        for x in paths:
            v.add_argument(x)
        v.add_argument("--redact", action="store_true")
        v.set_defaults(run=f)
        return v

    splits = {"nargs": "+", "default": ["train", "val", "test"]}
    v = verb(run_run, "dataset", "predictions", "output")
    v.add_argument("--splits", **splits)
    v.add_argument("--threshold", action="append", default=[])
    v.add_argument("--iou-existing", type=float, default=recover.EXISTING)
    v.add_argument("--iou-duplicate", type=float, default=recover.REPEATED)
    v.add_argument("--apply", action="store_true", help="write labels/<split>/<stem>.txt with the auto candidates added")
    v.add_argument("--trainable", action="store_true", help="write a data set of linked pictures, these labels and data.yaml")
    v = verb(run_audit, "dataset", "output")
    v.add_argument("--splits", **splits)
    v.add_argument("--details", type=int, default=5000)
    v.add_argument("--check-images", action="store_true")
    v = verb(run_calibrate, "reviewed", "output")
    v.add_argument("--classes", nargs="*", default=[])
    for name in ("class", "conf", "verdict"):
        v.add_argument(f"--{name}-column", default={"class": "class_name"}.get(name, name))
    for name, value in (("precision", calibrate.PRECISION), ("level", calibrate.LEVEL), ("recall", calibrate.RECALL)):
        v.add_argument(f"--{name}", type=float, default=value)
    v.add_argument("--samples", type=int, default=calibrate.SAMPLES)
    v = verb(run_consensus, "primary", "verifier", "output")
    v.add_argument("--classes", nargs="*", default=[])
    v.add_argument("--iou", type=float, default=consensus.OVERLAP)
    v.add_argument("--conf", type=float, default=consensus.CONFIDENCE)
    v.add_argument("--labels", help="a new folder for label files of the agreed candidates")
    v.add_argument("--names", help="the data.yaml that numbers the classes")
    v = verb(run_cluster, "dataset", "output")
    v.add_argument("--splits", **splits)
    v.add_argument("--dhash", type=int, default=similar.DHASH)
    v.add_argument("--ahash", type=int, default=similar.AHASH)
    v.add_argument("--aspect", type=float, default=similar.ASPECT)
    v.add_argument("--least", type=int, default=2)
    v.add_argument("--full-edges", action="store_true")
    v = verb(run_prioritize, "dataset", "candidates", "output")
    v.add_argument("--splits", **splits)
    v.add_argument("--modes", nargs="+", default=["review"])
    v.add_argument("--classes", nargs="*", default=[])
    v.add_argument("--budget", type=int, default=prioritize.BUDGET)
    v.add_argument("--weights", type=float, nargs=3, default=list(prioritize.WEIGHTS))
    verb(run_report, "output")
    verb(run_doctor)
    return p


def main(args: list[str] | None = None) -> int:
    a = parser().parse_args(args)
    if not hasattr(a, "output") or a.verb == "report":
        return a.run(a)
    if hasattr(a, "dataset"):
        sinks.guard_output(a.dataset, a.output)
    with sinks.Status(a.output, a.verb):
        return a.run(a)


if __name__ == "__main__":
    sys.exit(main())
