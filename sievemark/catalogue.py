"""The library's queries over the driver tables, each with its SQL twin."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemark.functions import scores as sc
from sievemark.functions.boxes import box, corners, overlap
from sievemark.operators import audit, calibrate, consensus, prioritize, recover, report, similar
from sievemark.operators.components import connected_components
from sievemark.plans import adapters as ad
from sievemark.plans.tables import shared_dir, table
from sievemark.streaming import recover_stream

#: So many numbers of a vector stand for its picture, each for several bits of the hashes, so that near hashes occur.
GREYS = 12
#: Aspect ratios of the derived pictures differ by a tenth and more; hashes are compared at the default distances.
LIMITS = {"aspect": 0.12}
Q: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict:
    return dict(Q)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


# Boxes ---------------------------------------------------------------------------------


def _iou(a: str, b: str, sides: bool = False) -> str:
    """The overlap in SQL, in the same order of operations as the column function."""
    lo = lambda t, c, s: f"({t}.{c} - {t}.{s} / 2)"
    hi = lambda t, c, s: f"({t}.{c} + {t}.{s} / 2)"
    side = lambda c, s: f"greatest(0e0, least({hi(a, c, s)}, {hi(b, c, s)}) - greatest({lo(a, c, s)}, {lo(b, c, s)}))"
    area = lambda t: f"({t}.w * {t}.h)" if sides else f"(greatest(0e0, {hi(t, 'cx', 'w')} - {lo(t, 'cx', 'w')}) * greatest(0e0, {hi(t, 'cy', 'h')} - {lo(t, 'cy', 'h')}))"
    inner = f"({side('cx', 'w')} * {side('cy', 'h')})"
    union = f"({area(a)} + {area(b)} - {inner})"
    return f"CASE WHEN {union} > 0 THEN {inner} / {union} ELSE 0e0 END"


_THRESHOLDS = "thr(class_id, auto_thr, review_thr) AS (VALUES " + ", ".join(f"({c}, {a}::DOUBLE, {r}::DOUBLE)" for c, a, r in ad.THRESHOLDS) + ")"
_BASE = f"boxes AS MATERIALIZED ({ad.BOXES}), p AS (SELECT * FROM boxes WHERE role = 0), v AS (SELECT * FROM boxes WHERE role = 1), l AS (SELECT * FROM boxes WHERE role = 2), {_THRESHOLDS}"
_ON = "p.split = l.split AND p.image = l.image AND p.class_id = l.class_id"
_BEST = f"best AS (SELECT p.split, p.image, p.class_id, p.idx, p.conf, p.cx, p.cy, p.w, p.h, coalesce(max({_iou('p', 'l')}), 0e0) AS max_iou FROM p LEFT JOIN l ON {_ON} WHERE true GROUP BY ALL)"
_BEST = _BEST.replace(f"coalesce(max({_iou('p', 'l')}), 0e0)", f"coalesce(max(CASE WHEN l.image IS NOT NULL THEN {_iou('p', 'l')} END), 0e0)")
_ROUTED = f"{_BASE}, {_BEST}, routed AS (SELECT best.*, CASE WHEN conf >= auto_thr THEN 'auto' ELSE 'review' END AS mode FROM best JOIN thr USING (class_id) WHERE conf >= review_thr)"
_CANDIDATES = f"{_ROUTED}, candidates AS (SELECT * FROM routed WHERE max_iou < 0.5)"
_KEPT = f"""{_CANDIDATES},
ordered AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY split, image, class_id ORDER BY conf DESC, idx) AS k, {{'cx': cx, 'cy': cy, 'w': w, 'h': h}} AS b FROM candidates),
fold(split, image, class_id, k, taken, ok, idx) AS (
  SELECT split, image, class_id, k, [b], true, idx FROM ordered WHERE k = 1
  UNION ALL
  SELECT o.split, o.image, o.class_id, o.k, CASE WHEN s.ok THEN list_append(f.taken, o.b) ELSE f.taken END, s.ok, o.idx
  FROM fold f JOIN ordered o ON o.split = f.split AND o.image = f.image AND o.class_id = f.class_id AND o.k = f.k + 1,
  LATERAL (SELECT len(list_filter(f.taken, lambda t: {_iou('o.b', 't')} >= 0.95)) = 0 AS ok) s),
kept AS (SELECT c.* FROM candidates c JOIN fold f USING (split, image, class_id, idx) WHERE f.ok)"""


def _parts(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    keep = ["split", "image", "class_id", "idx", "conf", "cx", "cy", "w", "h"]
    return ad.boxes(spark, d, 0).select(*keep), ad.boxes(spark, d, 2).select(*keep), ad.thresholds(spark)


@query(f"""WITH {_BASE}, pairs AS (SELECT p.split, p.image, p.idx, p.cx - p.w / 2 AS p_left, p.cy - p.h / 2 AS p_top, {_iou('p', 'l')} AS iou FROM p JOIN l ON p.split = l.split AND p.image = l.image)
SELECT split, image, idx, p_left, p_top, max(iou) AS best_iou, min(iou) AS least_iou, count(*) AS labels, count(*) FILTER (iou > 0) AS touching FROM pairs GROUP BY ALL""")
def iou_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """each prediction's overlaps with all labels of its image."""
    p, l, _ = _parts(spark, sf_dir)
    j = p.alias("p").join(l.alias("l"), ["split", "image"])
    left, top, _, _ = corners(box("p."))
    pairs = j.select("split", "image", "p.idx", left.alias("p_left"), top.alias("p_top"), overlap(box("p."), box("l.")).alias("iou"))
    found = pairs.groupBy("split", "image", "idx", "p_left", "p_top")
    return found.agg(F.max("iou").alias("best_iou"), F.min("iou").alias("least_iou"), F.count(F.lit(1)).alias("labels"), F.count_if(F.col("iou") > 0).alias("touching"))


@query(f"WITH {_CANDIDATES} SELECT split, image, class_id, idx, conf, max_iou, mode FROM candidates")
def recover_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1, F4, F6, J12."""
    return recover.candidates(*_parts(spark, sf_dir)).select("split", "image", "class_id", "idx", "conf", "max_iou", "mode")


@query(f"WITH {_BASE}, {_BEST} SELECT split, image, class_id, idx, conf FROM best WHERE max_iou < 0.5")
def recover_unmatched_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 as an anti join."""
    p, l, _ = _parts(spark, sf_dir)
    return recover.unlabelled(p, l).select("split", "image", "class_id", "idx", "conf")


@query(f"WITH RECURSIVE {_KEPT} SELECT split, image, class_id, idx, conf, mode FROM kept")
def recover_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2, T1."""
    return recover.distinct_boxes(recover.candidates(*_parts(spark, sf_dir))).select("split", "image", "class_id", "idx", "conf", "mode")


@query(f"""WITH RECURSIVE {_KEPT}, m AS (SELECT class_id, count(*) AS predictions, count(*) FILTER (max_iou >= 0.5) AS matched FROM routed GROUP BY 1),
k AS (SELECT class_id, count(*) FILTER (mode = 'auto') AS auto, count(*) FILTER (mode = 'review') AS review FROM kept GROUP BY 1)
SELECT class_id, predictions, matched, coalesce(auto, 0) AS auto, coalesce(review, 0) AS review, predictions - matched - coalesce(auto, 0) - coalesce(review, 0) AS repeats FROM m LEFT JOIN k USING (class_id)""")
def recover_class_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7, A8."""
    return recover.class_statistics(*_parts(spark, sf_dir))


@query(f"""WITH {_CANDIDATES}, g AS (SELECT mode, class_id, split, image, max(conf) AS score, count(*) AS n FROM candidates GROUP BY ALL)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY mode, class_id ORDER BY score DESC, split DESC, image DESC)::INT AS rank FROM g) WHERE rank <= 80""")
def recover_top_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature is a bounded sample."""
    return recover.top_images(recover.candidates(*_parts(spark, sf_dir)))


_LINE = "concat_ws(' ', class_id::VARCHAR, round(cx * 1000000)::BIGINT, round(cy * 1000000)::BIGINT, round(w * 1000000)::BIGINT, round(h * 1000000)::BIGINT)"


@query(f"""WITH {_CANDIDATES}, a AS (SELECT split, image, {_LINE} AS line, 1 AS old FROM l UNION ALL SELECT split, image, {_LINE}, 0 FROM candidates WHERE mode = 'auto'),
d AS (SELECT split, image, line, max(old) AS old FROM a GROUP BY ALL) SELECT split, image, count(*) AS lines, sum(1 - old)::BIGINT AS added FROM d GROUP BY ALL""")
def label_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4, U3, U4, U5."""
    p, l, t = _parts(spark, sf_dir)
    return recover.merged_labels(l, recover.candidates(p, l, t).filter("mode = 'auto'"))


# Consensus -----------------------------------------------------------------------------

_EDGES = f"""{_BASE}, edges AS MATERIALIZED (SELECT p.split, p.image, p.class_id, p.idx AS p_idx, v.idx AS v_idx, p.conf AS p_conf, v.conf AS v_conf, {_iou('p', 'v', True)} AS iou
FROM p JOIN v ON p.split = v.split AND p.image = v.image AND p.class_id = v.class_id AND p.mode = 'auto' AND v.conf >= 0.5 WHERE {_iou('p', 'v', True)} >= 0.5)"""
_DECIDED = f"""{_EDGES}, ranked AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY split, image, class_id ORDER BY iou DESC, least(p_conf, v_conf) DESC, p_idx, v_idx) AS k FROM edges),
fold(split, image, class_id, k, ps, vs, ok, p_idx, v_conf, iou) AS (
  SELECT split, image, class_id, k, [p_idx], [v_idx], true, p_idx, v_conf, iou FROM ranked WHERE k = 1
  UNION ALL
  SELECT r.split, r.image, r.class_id, r.k, CASE WHEN s.ok THEN list_append(f.ps, r.p_idx) ELSE f.ps END, CASE WHEN s.ok THEN list_append(f.vs, r.v_idx) ELSE f.vs END, s.ok, r.p_idx, r.v_conf, r.iou
  FROM fold f JOIN ranked r ON r.split = f.split AND r.image = f.image AND r.class_id = f.class_id AND r.k = f.k + 1,
  LATERAL (SELECT NOT list_contains(f.ps, r.p_idx) AND NOT list_contains(f.vs, r.v_idx) AS ok) s),
won AS (SELECT split, image, class_id, p_idx AS idx, v_conf AS verifier_conf, iou AS agreement_iou FROM fold WHERE ok),
decided AS (SELECT p.split, p.image, p.class_id, p.idx, p.conf, verifier_conf, agreement_iou, sqrt(p.conf * verifier_conf) AS consensus_score,
  CASE WHEN p.mode = 'review' THEN 'primary_review' WHEN verifier_conf IS NOT NULL THEN 'agreed_auto' ELSE 'downgraded_to_review' END AS consensus_decision, p.mode AS was
  FROM p LEFT JOIN won USING (split, image, class_id, idx))"""


def _models(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return ad.boxes(spark, d, 0), ad.boxes(spark, d, 1)


@query(f"WITH {_EDGES} SELECT * FROM edges")
def consensus_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3, F3."""
    return consensus.edges(*_models(spark, sf_dir))


@query(f"WITH RECURSIVE {_DECIDED} SELECT split, image, class_id, idx, verifier_conf, agreement_iou, consensus_score, consensus_decision, CASE WHEN consensus_decision = 'agreed_auto' THEN 'auto' ELSE 'review' END AS mode FROM decided")
def consensus_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4, J5, F27."""
    return consensus.decisions(*_models(spark, sf_dir)).select("split", "image", "class_id", "idx", "verifier_conf", "agreement_iou", "consensus_score", "consensus_decision", "mode")


@query(f"""WITH RECURSIVE {_DECIDED}, t AS (SELECT class_id, count(*) AS primary_candidates, count(*) FILTER (consensus_decision = 'agreed_auto') AS agreed_auto,
count(*) FILTER (consensus_decision = 'downgraded_to_review') AS downgraded_to_review, count(*) FILTER (consensus_decision = 'primary_review') AS primary_review FROM decided GROUP BY ROLLUP (class_id))
SELECT *, agreed_auto + downgraded_to_review AS primary_auto, CASE WHEN agreed_auto + downgraded_to_review > 0 THEN agreed_auto::DOUBLE / (agreed_auto + downgraded_to_review) ELSE 0e0 END AS agreement_rate FROM t""")
def consensus_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A13, A14."""
    return consensus.totals(consensus.decisions(*_models(spark, sf_dir)))


# Calibration ---------------------------------------------------------------------------

_Z = f"{__import__('statistics').NormalDist().inv_cdf(0.5 + 0.9 / 2)!r}::DOUBLE"
_CURVE = f"""reviewed AS ({ad.REVIEWED}), tied AS (SELECT class_name, conf AS threshold, count(*) AS n, count(*) FILTER (accepted) AS good FROM reviewed GROUP BY ALL),
run AS (SELECT class_name, threshold, sum(n) OVER d AS selected, sum(good) OVER d AS tp, sum(good) OVER (PARTITION BY class_name) AS every FROM tied WINDOW d AS (PARTITION BY class_name ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING)),
curve AS (SELECT class_name, threshold, selected::BIGINT AS selected, tp::BIGINT AS true_positive, (selected - tp)::BIGINT AS false_positive, tp::DOUBLE / selected AS precision,
  ((tp::DOUBLE / selected) + ({_Z} * {_Z}) / (2e0 * selected) - {_Z} * sqrt((tp::DOUBLE / selected) * (1e0 - tp::DOUBLE / selected) / selected + ({_Z} * {_Z}) / (4e0 * selected * selected))) / (1e0 + ({_Z} * {_Z}) / selected) AS lower,
  CASE WHEN every > 0 THEN tp::DOUBLE / every END AS recall FROM run)"""


@query(f"WITH {_CURVE} SELECT class_name, threshold, selected, true_positive, false_positive, precision, round(lower, 9) AS precision_lower_bound, recall FROM curve")
def calibrate_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9, A10, W1, F11."""
    c = calibrate.curve(ad.reviewed(spark, sf_dir), 0.9)
    return c.withColumn("precision_lower_bound", F.round("precision_lower_bound", 9))


@query(f"""WITH {_CURVE}, auto AS (SELECT class_name, min(threshold) AS t FROM curve WHERE selected >= 5 AND lower >= 0.7 GROUP BY 1),
review AS (SELECT class_name, max(threshold) AS t FROM curve LEFT JOIN auto USING (class_name) WHERE threshold <= coalesce(auto.t, 1e0) AND recall >= 0.8 GROUP BY 1),
sums AS (SELECT r.class_name, count(*) AS samples, count(*) FILTER (accepted) AS accepted, count(*) FILTER (conf >= review.t AND (auto.t IS NULL OR conf < auto.t)) AS queue, count(*) FILTER (accepted AND conf >= review.t AND (auto.t IS NULL OR conf < auto.t)) AS good
  FROM reviewed r LEFT JOIN auto USING (class_name) LEFT JOIN review USING (class_name) GROUP BY 1)
SELECT class_name, CASE WHEN accepted = 0 THEN 'no_positive_samples' WHEN auto.t IS NULL THEN 'auto_target_not_met' WHEN review.t IS NULL THEN 'review_target_not_met' ELSE 'calibrated' END AS status,
  samples, accepted, samples - accepted AS rejected, accepted::DOUBLE / samples AS acceptance_rate, auto.t AS auto_threshold, a.precision AS auto_precision, round(a.lower, 9) AS auto_precision_lower_bound, a.recall AS auto_recall,
  coalesce(a.selected, 0) AS auto_samples, review.t AS review_threshold, b.recall AS captured_positive_recall, queue AS review_queue_samples, CASE WHEN queue > 0 THEN good::DOUBLE / queue END AS review_queue_acceptance_rate
FROM sums LEFT JOIN auto USING (class_name) LEFT JOIN review USING (class_name) LEFT JOIN curve a ON a.class_name = sums.class_name AND a.threshold = auto.t LEFT JOIN curve b ON b.class_name = sums.class_name AND b.threshold = review.t""")
def calibrate_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11, A12."""
    p = calibrate.policy(ad.reviewed(spark, sf_dir), precision=0.7, level=0.9, recall=0.8, samples=5)
    return p.withColumn("auto_precision_lower_bound", F.round("auto_precision_lower_bound", 9))


# Audit ---------------------------------------------------------------------------------

_V = [f"try_cast(ws[{i}] AS DOUBLE)" for i in range(1, 6)]
_CHECKED = f"""lines AS MATERIALIZED ({ad.LINES}), ws AS (SELECT split, file, line_no, list_filter(regexp_split_to_array(value, '\\s+'), lambda x: x <> '') AS ws FROM lines),
typed AS (SELECT split, file, line_no, array_to_string(ws, ' ') AS normalized, ws, {_V[0]} AS c, {_V[1]} AS cx, {_V[2]} AS cy, {_V[3]} AS w, {_V[4]} AS h FROM ws WHERE len(ws) > 0),
checked AS (SELECT *, line_no > min(line_no) OVER (PARTITION BY split, file, normalized) AS repeated, CASE WHEN len(ws) <> 5 THEN 'malformed_line' WHEN c IS NULL OR cx IS NULL OR cy IS NULL OR w IS NULL OR h IS NULL THEN 'non_numeric'
  WHEN NOT (isfinite(c) AND isfinite(cx) AND isfinite(cy) AND isfinite(w) AND isfinite(h)) THEN 'non_finite' WHEN c <> floor(c) OR c < 0 OR c >= 6 THEN 'invalid_class_id'
  WHEN w <= 0 OR h <= 0 OR w > 1 OR h > 1 OR cx < 0 OR cx > 1 OR cy < 0 OR cy > 1 THEN 'invalid_box' END AS problem FROM typed),
flagged AS (SELECT *, problem IS NULL AND (cx - w / 2 < 0 OR cy - h / 2 < 0 OR cx + w / 2 > 1 OR cy + h / 2 > 1) AS crossing FROM checked),
findings AS (SELECT split, file, line_no, 'duplicate_label_line' AS kind FROM flagged WHERE repeated UNION ALL SELECT split, file, line_no, problem FROM flagged WHERE problem IS NOT NULL UNION ALL SELECT split, file, line_no, 'box_crosses_image_edge' FROM flagged WHERE crossing)"""
_FILES = f"images AS (SELECT DISTINCT split, image AS stem FROM ({ad.BOXES}) WHERE role = 0), files AS (SELECT split, file AS stem, sum(length(value)) + count(*) - 1 AS size FROM lines GROUP BY ALL)"


def _checked(spark: SparkSession, d: str) -> DataFrame:
    return audit.checked_lines(ad.lines(spark, d), 6)


def _files(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    images = ad.boxes(spark, d, 0).select("split", F.col("image").alias("stem")).distinct()
    files = ad.lines(spark, d).groupBy("split", F.col("file").alias("stem")).agg((F.sum(F.length("value")) + F.count(F.lit(1)) - 1).alias("size"))
    return images, files


def _findings(spark: SparkSession, d: str) -> DataFrame:
    images, files = _files(spark, d)
    orphans = audit.unmatched(images, files).filter("kind = 'orphan_label'").select("split", F.col("stem").alias("path"), F.lit(None).cast("long").alias("line"), "kind", F.lit("no matching image").alias("detail"))
    return audit.line_findings(_checked(spark, d)).unionByName(orphans)


@query(f"WITH {_CHECKED} SELECT split, kind, count(*) AS n FROM findings GROUP BY ALL")
def audit_label_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1, F24, W3."""
    return audit.line_findings(_checked(spark, sf_dir)).groupBy("split", "kind").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {_CHECKED}, {_FILES} SELECT split, (SELECT count(*) FROM images i WHERE i.split = s.split) AS images, (SELECT count(*) FROM files f WHERE f.split = s.split) AS labels,
(SELECT count(*) FROM flagged c JOIN images i ON i.split = c.split AND i.stem = c.file WHERE c.split = s.split AND problem IS NULL) AS objects, (SELECT count(*) FROM flagged c JOIN images i ON i.split = c.split AND i.stem = c.file WHERE c.split = s.split AND problem IS NOT NULL) AS bad_label_lines,
(SELECT count(*) FROM images i ANTI JOIN files f USING (split, stem) WHERE i.split = s.split) AS images_without_label, (SELECT count(*) FROM files f ANTI JOIN images i USING (split, stem) WHERE f.split = s.split) AS orphan_labels,
(SELECT count(*) FROM files f JOIN images i USING (split, stem) WHERE f.split = s.split AND size = 0) AS empty_labels FROM (VALUES ('train'), ('val'), ('test')) s(split)""")
def audit_split_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2, J8."""
    return audit.split_statistics(*_files(spark, sf_dir), _checked(spark, sf_dir))


@query(f"WITH {_CHECKED} SELECT c.class_id, 'class_' || c.class_id AS class_name, (SELECT count(*) FROM flagged f WHERE f.problem IS NULL AND f.c = c.class_id) AS objects FROM (VALUES (0), (1), (2), (3), (4), (5), (6)) c(class_id)")
def audit_class_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class 6 has no objects."""
    ids = spark.range(7).select(F.col("id").cast("int").alias("class_id"))
    classes = ids.select("class_id", sc.class_name(F.lit(None).cast("string"), F.col("class_id")).alias("class_name"))
    return audit.class_objects(_checked(spark, sf_dir), classes)


@query("SELECT kind, count(*) AS n FROM (SELECT 'image_without_label' AS kind FROM orders ANTI JOIN lineitem ON o_orderkey = l_orderkey UNION ALL SELECT 'orphan_label' FROM (SELECT DISTINCT l_orderkey FROM lineitem) ANTI JOIN orders ON o_orderkey = l_orderkey) GROUP BY 1")
def audit_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stand for images, their line items for label files."""
    images = table(spark, sf_dir, "orders").select(F.lit("all").alias("split"), F.col("o_orderkey").alias("stem"))
    labels = table(spark, sf_dir, "lineitem").select(F.lit("all").alias("split"), F.col("l_orderkey").alias("stem"))
    return audit.unmatched(images, labels).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT sha256(text) AS hash, count(*) AS n, count(DISTINCT source) AS splits, count(DISTINCT source) > 1 AS cross_split FROM documents GROUP BY 1 HAVING count(*) > 1")
def audit_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's source stands for its split."""
    return audit.duplicates(table(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("hash"), F.col("source").alias("split")))


_CRITICAL = ", ".join(f"'{k}'" for k in audit.CRITICAL)


@query(f"""WITH {_CHECKED}, {_FILES}, everything AS (SELECT kind FROM findings UNION ALL SELECT 'orphan_label' FROM files ANTI JOIN images USING (split, stem)),
s AS (SELECT count(*) FILTER (kind IN ({_CRITICAL})) AS critical, count(*) FILTER (kind NOT IN ({_CRITICAL})) AS warnings FROM everything) SELECT *, CASE WHEN critical > 0 THEN 'fail' WHEN warnings > 0 THEN 'warn' ELSE 'pass' END AS status FROM s""")
def audit_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5, A6."""
    return audit.status(_findings(spark, sf_dir))


@query(f"""WITH {_CHECKED}, {_FILES} SELECT split, file AS path, line_no AS line, kind FROM (SELECT * FROM findings UNION ALL SELECT split, stem, NULL, 'orphan_label' FROM files ANTI JOIN images USING (split, stem)) ORDER BY split, path, line NULLS FIRST, kind LIMIT 100""")
def audit_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bounded list of findings is the feature."""
    return audit.details(_findings(spark, sf_dir), 100).drop("detail")


# Near duplicates -----------------------------------------------------------------------

_SPLIT = "CASE label % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'val' ELSE 'test' END"
_BITS = "list_sum(list_transform(range(64), lambda i: CASE WHEN {} THEN pow(2, 63 - i)::HUGEINT ELSE 0::HUGEINT END))"
_FP = f"""raw AS (SELECT 'v' || lpad(vec_id::VARCHAR, 12, '0') AS path, {_SPLIT} AS split, vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
summed AS (SELECT *, list_reduce(e, lambda a, b: a + b) AS total FROM raw), wide AS (SELECT *, {_BITS.format(f'e[i % {GREYS} + 1] < e[(i + 1) % {GREYS} + 1]')} AS d, {_BITS.format(f'e[i % {GREYS} + 1] * 64 >= total')} AS a FROM summed),
fp AS MATERIALIZED (SELECT split, path, vec_id, label, (CASE WHEN d >= 9223372036854775808 THEN d - 18446744073709551616 ELSE d END)::BIGINT AS dhash, (CASE WHEN a >= 9223372036854775808 THEN a - 18446744073709551616 ELSE a END)::BIGINT AS ahash,
  (vec_id % 5 + 8)::INT AS width, 100 AS height FROM wide)"""
_PAIRS = f"""{_FP}, pairs AS MATERIALIZED (SELECT l.split AS l_split, l.path AS l_path, r.split AS r_split, r.path AS r_path, l.dhash AS l_dhash, bit_count(xor(l.dhash, r.dhash))::INT AS distance FROM fp l JOIN fp r ON (l.split, l.path) < (r.split, r.path)
WHERE bit_count(xor(l.dhash, r.dhash)) <= {similar.DHASH} AND bit_count(xor(l.ahash, r.ahash)) <= {similar.AHASH} AND abs(l.width / 100e0 - r.width / 100e0) / greatest(l.width / 100e0, r.width / 100e0) <= {LIMITS['aspect']})"""
_FIRST = f"{_PAIRS}, edges AS MATERIALIZED (SELECT min({{'s': l_split, 'p': l_path}}) AS l, r_split, r_path FROM pairs GROUP BY r_split, r_path, l_dhash)"
_COMPONENTS = f"""{_FIRST}, ways AS MATERIALIZED (SELECT l, {{'s': r_split, 'p': r_path}} AS r FROM edges UNION ALL SELECT {{'s': r_split, 'p': r_path}}, l FROM edges),
reach(node, root) AS (SELECT DISTINCT l, l FROM ways UNION SELECT w.r, reach.root FROM reach JOIN ways w ON w.l = reach.node), parts AS (SELECT node, min(root) AS root FROM reach GROUP BY 1)"""
_CLUSTERS = f"""{_COMPONENTS}, members AS (SELECT root, fp.* FROM parts JOIN fp ON fp.split = node.s AND fp.path = node.p),
heads AS (SELECT root, count(*) AS size, count(DISTINCT split) > 1 AS cross_split, max({{'a': width * height, 'p': path, 'd': dhash}}) AS best, row_number() OVER (ORDER BY min(path), root) AS cluster FROM members GROUP BY root),
clusters AS (SELECT cluster, split, path, size, cross_split, best.p AS representative, bit_count(xor(dhash, best.d))::INT AS distance FROM members JOIN heads USING (root))"""


def fingerprint_table(spark: SparkSession, d: str) -> DataFrame:
    """F15 to F18 on vectors of 64 numbers in place of 8 x 8 pixels."""
    e = F.transform("embedding", lambda x: x.cast("double"))
    t = table(spark, d, "embeddings").select("vec_id", "label", e.alias("e")).withColumn("total", F.aggregate("e", F.lit(0.0), lambda a, x: a + x))
    split = F.when(F.col("label") % 3 == 0, "train").when(F.col("label") % 3 == 1, "val").otherwise("test")
    at = F.sequence(F.lit(0), F.lit(63))
    return t.select(
        split.alias("split"), F.concat(F.lit("v"), F.lpad(F.col("vec_id").cast("string"), 12, "0")).alias("path"), "vec_id", "label",
        sc.bits_to_long(F.transform(at, lambda i: F.get("e", i % GREYS) < F.get("e", (i + 1) % GREYS))).alias("dhash"), sc.bits_to_long(F.transform(at, lambda i: F.get("e", i % GREYS) * 64 >= F.col("total"))).alias("ahash"),
        (F.col("vec_id") % 5 + 8).cast("int").alias("width"), F.lit(100).alias("height"), F.lit(100.0).alias("mean_luma"), F.lit(50.0).alias("luma_stddev"),
    )


@query(f"WITH {_FP} SELECT split, path, dhash, ahash, lpad(lower(to_hex(dhash)), 16, '0') AS dhash_hex, bit_count(dhash)::INT AS ones FROM fp")
def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F13, F15 to F18, F21."""
    fp = fingerprint_table(spark, sf_dir)
    return fp.select("split", "path", "dhash", "ahash", sc.hex_hash(F.col("dhash")).alias("dhash_hex"), F.bit_count("dhash").alias("ones"))


@query(f"WITH {_PAIRS} SELECT * FROM pairs")
def near_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6, F13, F19, F20."""
    return similar.pairs(fingerprint_table(spark, sf_dir), **LIMITS)


@query(f"WITH {_FIRST} SELECT l.s AS l_split, l.p AS l_path, r_split, r_path FROM edges")
def near_first_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6 with one link for each distinct earlier hash."""
    return similar.first_edges(similar.pairs(fingerprint_table(spark, sf_dir), **LIMITS))


@query(f"WITH RECURSIVE {_COMPONENTS} SELECT node.s AS split, node.p AS path, root.s AS root_split, root.p AS root_path FROM parts")
def near_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A19."""
    e = similar.first_edges(similar.pairs(fingerprint_table(spark, sf_dir), **LIMITS))
    ends = e.select(F.struct(F.col("l_split").alias("split"), F.col("l_path").alias("path")).alias("src"), F.struct(F.col("r_split").alias("split"), F.col("r_path").alias("path")).alias("dst"))
    return connected_components(ends).select("node.split", "node.path", F.col("component.split").alias("root_split"), F.col("component.path").alias("root_path"))


@query(f"WITH RECURSIVE {_CLUSTERS} SELECT * FROM clusters")
def near_representatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A17, A18, W5, T3, T4."""
    return similar.clusters(fingerprint_table(spark, sf_dir), **LIMITS)


@query(f"""WITH RECURSIVE {_CLUSTERS} SELECT (SELECT count(*) FROM fp) AS images, count(DISTINCT cluster) AS clusters, count(*) AS clustered_images, count(DISTINCT cluster) FILTER (cross_split) AS cross_split_clusters, coalesce(max(size), 0) AS largest,
count(*) - count(DISTINCT cluster) AS redundant_images, count(*) FILTER (cross_split) AS cross_split_images, coalesce(sum(size - 1)::BIGINT // 2, 0) AS pairs_within, (SELECT count(*) FROM fp) - count(*) AS single_images,
(SELECT count(*) FROM fp) AS files, 0::BIGINT AS failures FROM clusters""")
def near_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A15."""
    fp = fingerprint_table(spark, sf_dir)
    return similar.summary(fp, similar.clusters(fp, **LIMITS))


@query(f"WITH RECURSIVE {_CLUSTERS} SELECT size, count(DISTINCT cluster) AS clusters FROM clusters GROUP BY 1")
def near_size_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A16."""
    return similar.size_distribution(similar.clusters(fingerprint_table(spark, sf_dir), **LIMITS))


# Review queue --------------------------------------------------------------------------

_CAND = f"""{_FP}, cand AS (SELECT split, path AS image, 'class_' || ((label + j) % 10) AS class_name, (vec_id * 37 + j * 211) % 1000 / 1e3 AS conf FROM fp, range(3) t(j) WHERE (vec_id + j) % 4 <> 0),
rare AS (SELECT class_name, count(*) AS n, sqrt(min(count(*)) OVER ()::DOUBLE / count(*)) AS rarity FROM cand GROUP BY 1)"""
_ENTROPY = "CASE WHEN conf <= 0 OR conf >= 1 THEN 0e0 ELSE -(conf * ln(conf) + (1 - conf) * ln(1 - conf)) / ln(2e0) END"


def _review(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    fp = fingerprint_table(spark, d)
    c = fp.select("split", F.col("path").alias("image"), "vec_id", "label", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("j")).filter((F.col("vec_id") + F.col("j")) % 4 != 0)
    c = c.select("split", "image", F.concat(F.lit("class_"), ((F.col("label") + F.col("j")) % 10).cast("string")).alias("class_name"), ((F.col("vec_id") * 37 + F.col("j") * 211) % 1000 / F.lit(1000.0)).alias("conf"))
    return c, fp.select("split", F.col("path").alias("image"), "dhash", "ahash")


@query(f"""WITH {_CAND} SELECT split, image, round(max({_ENTROPY}), 9) AS uncertainty, max(rarity) AS rarity, count(*) AS candidate_count, array_to_string(list_sort(list_distinct(list(class_name))), ',') AS classes, min(conf) AS min_conf, max(conf) AS max_conf FROM cand JOIN rare USING (class_name) GROUP BY ALL""")
def review_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A20, F12."""
    i = prioritize.items(*_review(spark, sf_dir))
    return i.select("split", "image", F.round("uncertainty", 9).alias("uncertainty"), "rarity", "candidate_count", F.array_join("classes", ",").alias("classes"), "min_conf", "max_conf")


@query(f"WITH {_CAND} SELECT class_name, n, rarity FROM rare")
def class_rarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A21."""
    return prioritize.class_rarity(_review(spark, sf_dir)[0])


_D, _A = (f"bit_count(xor(i.{h}, c.{h}))" for h in ("dhash", "ahash"))
_ITEMS = f"""items AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY split, image) AS place FROM (SELECT split, image, max({_ENTROPY}) AS uncertainty, max(rarity) AS rarity, list_distinct(list(class_name)) AS classes
  FROM cand JOIN rare USING (class_name) GROUP BY ALL) t JOIN (SELECT split, path AS image, dhash, ahash FROM fp) h USING (split, image))"""
#: The greedy choice as a recursion: each step takes the best image given the list of those chosen so far.
_QUEUE = f"""{_CAND}, {_ITEMS}, step(k, chosen, pick) AS (
  SELECT 0, []::STRUCT(place BIGINT, dhash BIGINT, ahash BIGINT, classes VARCHAR[])[], NULL::STRUCT(score DOUBLE, neg BIGINT, rarity DOUBLE, diversity DOUBLE, dhash BIGINT, ahash BIGINT, classes VARCHAR[])
  UNION ALL
  SELECT k + 1, list_append(chosen, {{'place': -pick.neg, 'dhash': pick.dhash, 'ahash': pick.ahash, 'classes': pick.classes}}), pick
  FROM (SELECT k, chosen, max({{'score': 0.45::DOUBLE * uncertainty + 0.2::DOUBLE * dynamic + 0.35::DOUBLE * nearest, 'neg': -place, 'rarity': dynamic, 'diversity': nearest, 'dhash': dhash, 'ahash': ahash, 'classes': classes}}) AS pick
    FROM (SELECT s.k, s.chosen, i.place, i.uncertainty, i.dhash, i.ahash, i.classes,
        i.rarity / sqrt(1 + list_min(list_transform(i.classes, lambda x: len(list_filter(s.chosen, lambda c: list_contains(c.classes, x)))))) AS dynamic,
        least(1e0, coalesce(list_min(list_transform(s.chosen, lambda c: 0.7::DOUBLE * {_D} / 64e0 + 0.3::DOUBLE * {_A} / 64e0)), 1e0)) AS nearest
      FROM step s JOIN items i ON s.k < 20 AND len(list_filter(s.chosen, lambda c: c.place = i.place)) = 0) t GROUP BY k, chosen)),
queue AS (SELECT k::INT AS priority_rank, round(pick.score, 9) AS priority_score, round(pick.rarity, 9) AS rarity_score, round(pick.diversity, 9) AS diversity_score, split, image FROM step JOIN items ON place = -pick.neg WHERE k > 0)"""


@query(f"WITH RECURSIVE {_QUEUE} SELECT * FROM queue")
def review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W6, T5, T8, F14."""
    chosen = prioritize.queue(prioritize.items(*_review(spark, sf_dir)), 20)
    return chosen.withColumns({c: F.round(c, 9) for c in ("priority_score", "rarity_score", "diversity_score")})


@query(f"WITH RECURSIVE {_QUEUE} SELECT class_name, count(*) AS pool, count(priority_rank) AS queue FROM cand LEFT JOIN queue USING (split, image) GROUP BY 1")
def review_queue_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of the pool and of the queue by class."""
    c, f = _review(spark, sf_dir)
    chosen = prioritize.queue(prioritize.items(c, f), 20)
    pool = c.groupBy("class_name").agg(F.count(F.lit(1)).alias("pool"))
    queued = prioritize.queue_candidates(chosen, c).groupBy("class_name").agg(F.count(F.lit(1)).alias("queue"))
    return pool.join(queued, "class_name", "left").fillna(0, ["queue"])


# Report and stream ---------------------------------------------------------------------


@query(f"""WITH {_CANDIDATES}, drawn AS (SELECT 'auto_conf' AS series, conf AS x FROM candidates WHERE mode = 'auto' UNION ALL SELECT 'review_conf', conf FROM candidates WHERE mode = 'review' UNION ALL SELECT 'auto_iou', max_iou FROM candidates WHERE mode = 'auto')
SELECT s AS series, b::INT AS bin, count(x) AS n FROM (VALUES ('auto_conf'), ('review_conf'), ('auto_iou')) t(s) CROSS JOIN range(10) r(b) LEFT JOIN drawn ON series = s AND least(9, greatest(0, floor(x * 10))) = b GROUP BY ALL""")
def report_histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A23, F25."""
    c = recover.candidates(*_parts(spark, sf_dir))
    auto, review = F.col("mode") == "auto", F.col("mode") == "review"
    return report.histogram(c, {"auto_conf": (auto, F.col("conf")), "review_conf": (review, F.col("conf")), "auto_iou": (auto, F.col("max_iou"))})


@query(f"WITH {_CANDIDATES} SELECT class_id, count(*) FILTER (mode = 'auto') AS auto, count(*) FILTER (mode = 'review') AS review FROM candidates GROUP BY 1")
def report_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates by class and mode."""
    return report.mode_counts(recover.candidates(*_parts(spark, sf_dir)))


@query("SELECT event_id, min(user_id) AS user_id, min(event_type) AS event_type, CASE WHEN min(value) >= 50 THEN 'auto' ELSE 'review' END AS mode FROM events GROUP BY 1")
def stream_recover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events routed in micro-batches, each key once."""
    schema = table(spark, sf_dir, "events").schema
    source = recover_stream.parquet_stream(spark, f"{sf_dir}/events.parquet", schema)
    base = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    route = lambda b: b.select("event_id", "user_id", "event_type", sc.routed(F.col("value"), F.lit(50.0)).alias("mode"))
    recover_stream.run(source, f"{base}/out", f"{base}/state", ["event_id"], route, {"threshold": 50.0})
    return spark.read.parquet(f"{base}/out").drop("batch_id")
