import math
import random

import pytest
from pyspark.sql import functions as F

from sievemark.functions import boxes, scores
from sievemark.operators import audit, calibrate, consensus, prioritize, recover, similar
from sievemark.operators.components import connected_components
from sievemark.plans.ranking import numbered
from sievemark.streaming import recover_stream

BOX = "split string, image string, class_id int, idx long, mode string, conf double, cx double, cy double, w double, h double"


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def lit4(*v):
    return tuple(F.lit(float(x)) for x in v)


def test_overlap(spark):
    same, far = lit4(0.5, 0.5, 0.2, 0.2), lit4(0.8, 0.8, 0.1, 0.1)
    for areas in ("corners", "sides"):
        assert value(spark, boxes.overlap(same, same, areas)) == pytest.approx(1.0)
        assert value(spark, boxes.overlap(lit4(0.2, 0.2, 0.1, 0.1), far, areas)) == 0.0
    assert value(spark, boxes.overlap(lit4(0.5, 0.5, 0, 0), lit4(0.5, 0.5, 0, 0))) == 0.0


def test_scores(spark):
    e = lambda p: value(spark, scores.confidence_entropy(F.lit(p)))
    assert e(0.0) == e(1.0) == 0 and e(0.5) == 1 and e(0.4) == pytest.approx(e(0.6)) and round(e(0.55), 6) == 0.992774
    w = lambda s, n, c: value(spark, scores.wilson_lower_bound(F.lit(s), F.lit(n), c))
    assert round(w(10, 10, 0.95), 4) == 0.7225 and round(w(100, 100, 0.95), 4) == 0.9630 and w(10, 10, 0) == 1.0
    assert value(spark, scores.hamming(F.lit(0b1010), F.lit(0b1111))) == 2
    assert value(spark, scores.hex_hash(F.lit(-1).cast("long"))) == "f" * 16 and value(spark, scores.hex_hash(F.lit(255).cast("long"))) == "0" * 14 + "ff"
    assert [value(spark, scores.tenth(F.lit(v))) for v in (-1.0, 0.0, 0.95, 1.0, 7.0)] == [0, 0, 9, 9, 9]
    assert [value(spark, scores.unit_float(F.lit(t))) for t in (" 0.5 ", "nan", "1.1", "x", "")] == [0.5, None, None, None, None]
    assert [value(spark, scores.verdict(F.lit(t))) for t in (" Accept", "FP", "maybe")] == [True, False, None]
    assert value(spark, scores.normalized_image(F.lit(" A\\b.JPG "))) == "a/b.jpg"
    assert value(spark, scores.normalized_image(F.lit("STRASSE/Straße ς"))) == "STRASSE/Straße ς".casefold()
    assert value(spark, scores.sample_name(F.lit("train"), F.lit("x/a.b.png"))) == "train_a.b_png.jpg" and value(spark, scores.progress_key(F.lit("helmet"), F.lit("val"))) == "helmet/val"


def reviewed(spark, rows):
    return spark.createDataFrame([("c", c, a) for c, a in rows], "class_name string, conf double, accepted boolean")


def test_calibration_choice_ties_and_refusal(spark):
    rows = [(0.95, True), (0.9, True), (0.85, True), (0.8, False), (0.75, False), (0.7, True), (0.6, False)]
    p = calibrate.policy(reviewed(spark, rows), 1.0, 0.0, 1.0, 3).first()
    assert (p["status"], p["auto_threshold"], p["review_threshold"], p["review_queue_samples"]) == ("calibrated", 0.85, 0.7, 3)
    c = {r["threshold"]: r for r in calibrate.curve(reviewed(spark, [(0.8, True), (0.8, False), (0.5, True)]), 0.0).collect()}
    assert sorted(c) == [0.5, 0.8] and c[0.8]["selected"] == 2 and c[0.8]["precision"] == 0.5
    p = calibrate.policy(reviewed(spark, [(0.9, False), (0.8, True), (0.7, False)]), 1.0, 0.0, 1.0, 2).first()
    assert p["status"] == "auto_target_not_met" and p["auto_threshold"] is None
    assert calibrate.policy(reviewed(spark, [(0.9, False)]), 1.0, 0.0, 1.0, 1).first()["status"] == "no_positive_samples"
    many = calibrate.policy(reviewed(spark, [(0.99 - i / 1000, True) for i in range(100)]), 0.95, 0.95, 1.0, 20).first()
    assert many["status"] == "calibrated" and many["auto_samples"] >= 73 and many["auto_precision_lower_bound"] >= 0.95
    with pytest.raises(ValueError):
        calibrate.policy(reviewed(spark, rows), precision=1.5)


def test_published_thresholds(spark):
    """The six calibrated classes of the public example, rebuilt from its formula."""
    limits = {"person": (0.78, 0.50, 5), "helmet": (0.80, 0.52, 5), "vest": (0.82, 0.55, 4), "tractor": (0.76, 0.48, 6), "slipper": (0.84, 0.50, 3), "smoking": (0.86, 0.46, 3)}
    rows = []
    for k, (name, (clean, useful, period)) in enumerate(limits.items()):
        for i in range(400):
            c = 0.30 + 0.69 * i / 399
            good = c >= clean or (c >= useful and (i + k) % period != 0) or (c < useful and (i + 2 * k) % 8 == 0)
            rows.append((name, float(f"{c:.4f}"), good))
    got = calibrate.policy(spark.createDataFrame(rows, "class_name string, conf double, accepted boolean"), 0.95, 0.95, 0.90, 20).collect()
    assert {r["class_name"]: (r["auto_threshold"], r["review_threshold"]) for r in got} == {"helmet": (0.7929, 0.5421), "person": (0.7686, 0.5231), "slipper": (0.8395, 0.5231), "smoking": (0.8586, 0.4954), "tractor": (0.7323, 0.5144), "vest": (0.8171, 0.5629)}
    helmet = next(r for r in got if r["class_name"] == "helmet")
    assert helmet["auto_precision_lower_bound"] == pytest.approx(0.9523832736556861, abs=1e-12) and helmet["review_queue_samples"] == 145


def test_consensus_is_one_to_one(spark):
    p = spark.createDataFrame([("t", "a", 0, 0, "auto", 0.9, 0.50, 0.5, 0.2, 0.2), ("t", "a", 0, 1, "auto", 0.9, 0.51, 0.5, 0.2, 0.2), ("t", "a", 0, 2, "review", 0.6, 0.5, 0.5, 0.2, 0.2), ("t", "b", 0, 3, "auto", 0.8, 0.5, 0.5, 0.2, 0.2)], BOX)
    v = spark.createDataFrame([("t", "a", 0, 0, "auto", 0.8, 0.50, 0.5, 0.2, 0.2), ("t", "b", 0, 1, "auto", 0.4, 0.5, 0.5, 0.2, 0.2)], BOX)
    d = consensus.decisions(p, v)
    assert {r["idx"]: r["consensus_decision"] for r in d.collect()} == {0: "agreed_auto", 1: "downgraded_to_review", 2: "primary_review", 3: "downgraded_to_review"}
    t = {r["class_id"]: r for r in consensus.totals(d).collect()}
    assert t[None]["primary_auto"] == 3 and t[0]["agreement_rate"] == pytest.approx(1 / 3)
    only_review = consensus.totals(consensus.decisions(p.filter("mode = 'review'"), v)).collect()
    assert all(r["agreement_rate"] == 0 for r in only_review)
    assert consensus.decisions(p.limit(0), v).count() == 0


def test_recovery(spark):
    p = spark.createDataFrame([("t", "a", 0, i, "", c, x, 0.5, 0.2, 0.2) for i, (c, x) in enumerate([(0.9, 0.5), (0.8, 0.5001), (0.7, 0.2), (0.3, 0.8), (0.95, 0.2)])], BOX).drop("mode")
    labels = p.filter("idx = 2").drop("idx", "conf")
    limits = spark.createDataFrame([(0, 0.85, 0.5)], "class_id int, auto_thr double, review_thr double")
    c = recover.candidates(p, labels, limits)
    assert {r["idx"]: r["mode"] for r in c.collect()} == {0: "auto", 1: "review"}
    assert [r["idx"] for r in recover.distinct_boxes(c).collect()] == [0]
    assert sorted(r["idx"] for r in recover.unlabelled(p, labels).collect()) == [0, 1, 3]
    s = recover.class_statistics(p, labels, limits).first()
    assert (s["predictions"], s["matched"], s["repeats"], s["auto"], s["review"]) == (4, 2, 1, 1, 0)
    once = recover.merged_labels(labels, c).first()
    assert (once["lines"], once["added"]) == (3, 2)


def test_label_lines(spark):
    texts = ["0 .5 .5 .2 .2", "0  .5 .5 .2 .2", "0 .5 .5 .2", "x .5 .5 .2 .2", "nan .5 .5 .2 .2", "1.5 .5 .5 .2 .2", "2 .5 .5 .2 .2", "1 .5 .5 0 .2", "1 .05 .5 .2 .2", "  ", "1 inf .5 .2 .2"]
    lines = spark.createDataFrame([("t", "f", i + 1, v) for i, v in enumerate(texts)], "split string, file string, line_no int, value string")
    checked = audit.checked_lines(lines, 2)
    assert sorted((r["line"], r["kind"]) for r in audit.line_findings(checked).collect()) == [(2, "duplicate_label_line"), (3, "malformed_line"), (4, "non_numeric"), (5, "non_finite"), (6, "invalid_class_id"), (7, "invalid_class_id"), (8, "invalid_box"), (9, "box_crosses_image_edge"), (11, "non_finite")]
    assert checked.filter("problem IS NULL").count() == 3
    assert audit.status(audit.line_findings(checked)).first()["status"] == "fail"
    assert audit.status(audit.line_findings(checked).limit(0)).first()["status"] == "pass"


IMAGE = "split string, path string, dhash long, ahash long, width int, height int, mean_luma double, luma_stddev double"


def picture(path, dhash, ahash=0, w=100, mean=100.0, std=50.0, split="train"):
    return (split, path, dhash, ahash, w, 100, mean, std)


def test_first_match_of_each_hash_only(spark):
    """a and b have one hash but differ in brightness and are flat; c matches a, so it never meets b."""
    rows = [picture("a", 1, mean=10.0, std=1.0), picture("b", 1, mean=30.0, std=1.0), picture("c", 1, mean=20.0, std=1.0)]
    df = spark.createDataFrame(rows, IMAGE)
    assert sorted(r["path"] for r in similar.clusters(df).collect()) == ["a", "c"]
    assert sorted(r["path"] for r in similar.clusters(df, full_edges=True).collect()) == ["a", "b", "c"]


def test_hamming_join_against_all_pairs(spark):
    rng = random.Random(4)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    base = [rng.getrandbits(64) for _ in range(12)]
    h = [b ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(0, 9))) for b in base for _ in range(5)]
    df = spark.createDataFrame([picture(f"p{i:03}", signed(x), split=["train", "val"][i % 2]) for i, x in enumerate(h)], IMAGE)
    order = sorted(range(len(h)), key=lambda i: (i % 2, i))
    want = {(f"p{i:03}", f"p{j:03}") for a, i in enumerate(order) for j in order[a + 1 :] if (h[i] ^ h[j]).bit_count() <= 6}
    for bands in (None, 7, 9):
        assert {(r["l_path"], r["r_path"]) for r in similar.pairs(df, bands=bands).collect()} == want
    c = similar.clusters(df).collect()
    assert {r["cluster"] for r in c} == set(range(1, len({r["cluster"] for r in c}) + 1)) and similar.summary(df, similar.clusters(df)).first()["clustered_images"] == len(c)
    assert similar.clusters(df.limit(0)).count() == 0


def test_representative_and_spread(spark):
    df = spark.createDataFrame([picture("a", 0), picture("b", 3, w=104, split="val"), picture("z", -1)], IMAGE)
    c = {r["path"]: r for r in similar.clusters(df).collect()}
    assert set(c) == {"a", "b"} and c["a"]["representative"] == "b" and c["a"]["distance"] == 2 and c["a"]["cross_split"]


def test_components_of_long_paths_and_hubs(spark):
    path = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7), (None, 3), (5, 4)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(path, "src int, dst int")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1050)}}
    assert connected_components(spark.createDataFrame([], "src int, dst int")).count() == 0


def test_numbers_in_global_order(spark):
    df = spark.range(1000).withColumn("x", F.pmod(F.col("id") * 37, F.lit(1000))).repartition(7)
    got = numbered(df, ["x"], "n").collect()
    assert all(r["n"] == r["x"] + 1 for r in got) and len(got) == 1000
    assert numbered(df.limit(0), ["x"], "n").count() == 0


def naive_queue(pool, budget, weights):
    left, chosen, near, out = list(range(len(pool))), {}, [1.0] * len(pool), []
    while left and len(out) < budget:
        def score(i):
            rare = max(pool[i]["rarity"] / math.sqrt(1 + chosen.get(c, 0)) for c in pool[i]["classes"])
            return weights[0] * pool[i]["uncertainty"] + weights[1] * rare + weights[2] * near[i]

        best = min(left, key=lambda i: (-score(i), pool[i]["split"], pool[i]["image"]))
        out.append((pool[best]["image"], score(best)))
        for c in pool[best]["classes"]:
            chosen[c] = chosen.get(c, 0) + 1
        left.remove(best)
        for i in left:
            d = ((pool[i]["dhash"] ^ pool[best]["dhash"]) % 2**64).bit_count() / 64 * 0.7 + ((pool[i]["ahash"] ^ pool[best]["ahash"]) % 2**64).bit_count() / 64 * 0.3
            near[i] = min(near[i], d)
    return out


@pytest.mark.parametrize("ahead", [7, 1024])
def test_queue_against_its_definition(spark, monkeypatch, ahead):
    monkeypatch.setattr(prioritize, "AHEAD", ahead)
    rng = random.Random(8)
    c = [("train", f"i{i:02}", f"k{rng.randrange(5) ** 2 // 4}", rng.random()) for i in range(40) for _ in range(rng.randrange(1, 4))]
    f = [("train", f"i{i:02}", rng.getrandbits(63) if i % 3 else 5, rng.getrandbits(62)) for i in range(40)]
    pool = prioritize.items(spark.createDataFrame(c, "split string, image string, class_name string, conf double"), spark.createDataFrame(f, "split string, image string, dhash long, ahash long"))
    rows = [r.asDict() for r in pool.orderBy("split", "image").collect()]
    got = prioritize.queue(pool, 25).orderBy("priority_rank").collect()
    want = naive_queue(rows, 25, prioritize.WEIGHTS)
    assert [r["image"] for r in got] == [w[0] for w in want] and [r["priority_score"] for r in got] == pytest.approx([w[1] for w in want])
    assert prioritize.pool_table(pool, prioritize.queue(pool, 25)).filter("selected").count() == 25
    with pytest.raises(ValueError):
        prioritize.queue(pool, 5, (1.0, 1.0, 1.0))


def test_stream_resumes_once_and_refuses_other_settings(spark, tmp_path):
    schema = "event_id long, value double"
    source, out, state = (f"file://{tmp_path}/{x}" for x in ("in", "out", "state"))
    go = lambda settings: recover_stream.run(recover_stream.parquet_stream(spark, source, spark.createDataFrame([], schema).schema, 1), out, state, ["event_id"], lambda b: b, settings)
    spark.createDataFrame([(1, 0.1), (2, 0.2), (2, 0.2)], schema).coalesce(1).write.parquet(source)
    go({"a": 1})
    spark.createDataFrame([(2, 0.2), (3, 0.3)], schema).coalesce(1).write.mode("append").parquet(source)
    go({"a": 1})
    go({"a": 1})
    assert sorted(r["event_id"] for r in spark.read.parquet(out).collect()) == [1, 2, 3]
    recover_stream.write_batch(out, spark.createDataFrame([(3, 0.3)], schema), 1)
    assert spark.read.parquet(out).count() == 3
    assert [r["event_id"] for r in recover_stream.best_of_batches(spark, out, [], ["-value"], 2).orderBy("rank").collect()] == [3, 2]
    with pytest.raises(ValueError):
        go({"a": 2})
