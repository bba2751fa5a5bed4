import json
import struct
import zlib

import pytest

from sievemark import cli
from sievemark.sources import config, files, pictures, sinks


def png(path, pixel, w=40, h=30):
    raw = b"".join(b"\0" + b"".join(bytes(pixel(x, y)) for x in range(w)) for y in range(h))
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


@pytest.fixture
def dataset(tmp_path):
    root = tmp_path / "data"
    scene = lambda x, y: ((x * 13 + y * 7) % 256, (x * y) % 256, (y * 11) % 256)
    png(root / "images/train/a.png", scene)
    png(root / "images/val/copy.PNG", scene)
    png(root / "images/val/wide.png", lambda x, y: scene(x // 2, y // 2), 80, 60)
    png(root / "images/train/flat.png", lambda x, y: (9, 9, 9))
    (root / "images/train/broken.jpg").write_bytes(b"no image")
    for name, text in {"train/a": "0 0.5 0.5 0.2 0.2\n", "val/copy": "8 0.5 0.5 0.2 0.2\n", "train/orphan": "0 .1 .1 .1 .1\n", "train/flat": ""}.items():
        p = root / f"labels/{name}.txt"
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text)
    (root / "data.yaml").write_text("nc: 2\nnames:\n  0: person\n  1: helmet\n")
    return root


def test_listing_and_labels(spark, dataset):
    d = str(dataset)
    assert sorted(r["relative"] for r in files.images(spark, d, ["train", "val", "none"]).collect()) == ["a.png", "broken.jpg", "copy.PNG", "flat.png", "wide.png"]
    assert [(r["image"], r["class_id"]) for r in files.boxes(files.label_lines(spark, d, ["train"])).orderBy("image").collect()] == [("a", 0), ("orphan", 0)]
    (dataset / "labels/train/many.txt").write_text("0 .5 .5 .1 .1\r\n\n1 .5 .5 .1 .1\nx")
    assert [(r["line_no"], r["value"]) for r in files.label_lines(spark, d, ["train"]).filter("file = 'many'").orderBy("line_no").collect()] == [(1, "0 .5 .5 .1 .1"), (2, ""), (3, "1 .5 .5 .1 .1"), (4, "x")]
    (dataset / "labels/train/many.txt").unlink()
    assert {r["stem"]: r["size"] for r in files.label_files(spark, d, ["train"]).collect()}["flat"] == 0
    hashes = files.image_hashes(spark, d, ["train", "val"]).groupBy("hash").count().filter("count = 2").count()
    assert hashes == 1 and files.corrupt_images(spark, d).count() == 1


def test_audit_verb(spark, dataset, tmp_path):
    assert cli.main(["audit", str(dataset), str(tmp_path / "out"), "--check-images", "--redact"]) == 2
    data = json.loads((tmp_path / "out/audit.json").read_text())
    assert data["status"][0] == {"critical": 3, "warnings": 1, "status": "fail"} and data["cross_split_groups"] == 1
    assert {c["class_name"]: c["objects"] for c in data["classes"]} == {"person": 1, "helmet": 0} and data["sources"] == ["<redacted>/data"]
    assert "<h2>splits</h2>" in (tmp_path / "out/audit.html").read_text()


def test_cluster_and_prioritize_verbs(spark, dataset, tmp_path):
    assert cli.main(["cluster", str(dataset), str(tmp_path / "out")]) == 3
    data = json.loads((tmp_path / "out/cluster.json").read_text())
    assert data["summary"][0]["images"] == 4 and data["summary"][0]["cross_split_clusters"] == 1
    rows = "split,image,class_name,conf,mode\ntrain,a.png,person,0.5,review\nval,images/val/copy.PNG,helmet,0.6,review\nval,gone.png,helmet,0.6,review\ntrain,flat.png,person,0.9,auto\n"
    (tmp_path / "c.csv").write_text("﻿" + rows)
    assert cli.main(["prioritize", str(dataset), str(tmp_path / "c.csv"), str(tmp_path / "queue"), "--budget", "5"]) == 0
    queue = spark.read.option("header", True).csv(str(tmp_path / "queue/review_queue"))
    assert queue.count() == 2 and spark.read.option("header", True).csv(str(tmp_path / "queue/failures")).first()["image"] == "gone.png"
    with pytest.raises(ValueError):
        cli.main(["cluster", str(dataset), str(dataset / "images")])


def test_fingerprints(spark, dataset):
    fp = {r["path"]: r for r in pictures.fingerprints(spark, str(dataset), ["train", "val"]).collect()}
    a, b = fp["images/train/a.png"], fp["images/val/copy.PNG"]
    assert (a["dhash"], a["ahash"]) == (b["dhash"], b["ahash"]) and fp["images/train/broken.jpg"]["error"]
    assert fp["images/train/flat.png"]["luma_stddev"] == 0 and fp["images/train/flat.png"]["ahash"] == -1 and a["width"] == 40


def test_csv_rules(spark, tmp_path):
    path = str(tmp_path / "r.csv")
    (tmp_path / "r.csv").write_text('﻿class_name,conf,verdict,note\nhelmet, 0.95 ,Accept,"a ""b""\nc"\nhelmet,0.80,reject,\nother,x,maybe,\n')
    assert [tuple(r) for r in files.reviewed(spark, path, ["helmet"]).collect()] == [("helmet", 0.95, True), ("helmet", 0.8, False)]
    with pytest.raises(ValueError, match="record 4"):
        files.reviewed(spark, path)
    with pytest.raises(ValueError, match="missing columns: mode"):
        files.queue_input(spark, path.replace("r.csv", "q.csv")) if (tmp_path / "q.csv").write_text("split,image,class_name,conf\n") else None
    assert files.candidates(spark, str(tmp_path / "none.csv")).count() == 0


def test_calibrate_and_consensus_verbs(spark, tmp_path, capsys):
    (tmp_path / "r.csv").write_text("class_name,conf,verdict\nhelmet,0.95,accept\nhelmet,0.80,reject\n")
    cli.main(["calibrate", str(tmp_path / "r.csv"), str(tmp_path / "cal"), "--precision", "1", "--level", "0", "--recall", "1", "--samples", "1"])
    assert "helmet:0.95:0.95" in capsys.readouterr().out
    head = "split,image,class_name,conf,mode,cx,cy,w,h,extra\n"
    (tmp_path / "p.csv").write_text(head + "t,A.jpg,x,0.9,auto,0.5,0.5,0.2,0.2,keep\nt,A.jpg,x,0.9,auto,0.51,0.5,0.2,0.2,keep\n")
    (tmp_path / "v.csv").write_text(head + "t,a.JPG,x,0.8,auto,0.5,0.5,0.2,0.2,\n")
    cli.main(["consensus", str(tmp_path / "p.csv"), str(tmp_path / "v.csv"), str(tmp_path / "con")])
    rows = spark.read.option("header", True).csv(str(tmp_path / "con/consensus_all")).collect()
    assert sorted((r["consensus_decision"], r["mode"], r["extra"]) for r in rows) == [("agreed_auto", "auto", "keep"), ("downgraded_to_review", "review", "keep")]


def test_run_verb_twice_is_the_same(spark, dataset, tmp_path):
    (tmp_path / "p.csv").write_text("split,image,class_name,conf,cx,cy,w,h\ntrain,a.png,person,0.9,0.5,0.5,0.2,0.2\ntrain,a.png,helmet,0.9,0.2,0.2,0.1,0.1\ntrain,flat.png,person,0.6,0.5,0.5,0.2,0.2\nval,wide.png,person,0.8,0.1234565,0.5,0.2,0.2\n")
    out = tmp_path / "run"
    for _ in range(2):
        assert cli.main(["run", str(dataset), str(tmp_path / "p.csv"), str(out), "--trainable"]) == 0
        assert spark.read.parquet(str(out / "candidates")).groupBy("mode").count().count() == 2
        assert (out / "labels/train/a.txt").read_text() == "0 0.5 0.5 0.2 0.2\n1 0.200000 0.200000 0.100000 0.100000\n"
        assert (out / "labels/val/wide.txt").read_text() == "0 0.123457 0.500000 0.200000 0.200000\n" or f"{0.1234565:.6f}" in (out / "labels/val/wide.txt").read_text()
        assert (out / "labels/train/flat.txt").read_text() == "" and (out / "labels/train/orphan.txt").exists()
        made = out / "trainable"
        assert (made / "images/train/a.png").samefile(dataset / "images/train/a.png") and (made / "labels/train/a.txt").read_text() == (out / "labels/train/a.txt").read_text()
        assert config.load_class_names(made / "data.yaml") == ["person", "helmet"]
        data = json.loads((out / "run.json").read_text())
        assert data["totals"]["auto"] == 2 and data["images"] == {"linked": 5, "copied": 0} and data["labels_added"] == 2
        assert "all: predictions" in (out / "summary.txt").read_text() and not list(out.rglob("*.part"))
    # The package's own reader finds the tree.
    assert files.boxes(files.label_lines(spark, str(out), ["train", "val"])).count() == 5
    assert cli.main(["report", str(out)]) == 0 and cli.main(["doctor"]) == 0
    assert {h["series"] for h in json.loads((out / "report.json").read_text())["histograms"]} == {"auto_conf", "review_conf", "auto_iou"}


def test_merged_text_and_names():
    assert sinks.merged_text("1 a\n2 b", ["2 b", "3 c", "3 c"]) == ("1 a\n2 b\n3 c\n", 1) and sinks.merged_text(None, ["x"]) == ("x\n", 1) and sinks.merged_text("x \n", ["x"]) == ("x \n", 0)
    for bad in ("", "../x", "a/../b", "/a", "a//b", "a\\b"):
        with pytest.raises(ValueError):
            sinks.safe_name(bad)


def test_agreed_labels_only_and_into_an_empty_folder(spark, tmp_path):
    head = "split,image,class_name,conf,mode,cx,cy,w,h\n"
    (tmp_path / "p.csv").write_text(head + "train,images/train/Sub/A.jpg,helmet,0.9,auto,0.5,0.5,0.2,0.2\ntrain,images/train/Sub/A.jpg,person,0.9,auto,0.2,0.2,0.1,0.1\ntrain,b.jpg,helmet,0.9,auto,0.5,0.5,0.2,0.2\n")
    (tmp_path / "v.csv").write_text(head + "train,images/train/sub/a.jpg,helmet,0.8,auto,0.5,0.5,0.2,0.2\ntrain,images/train/sub/a.jpg,person,0.8,auto,0.2,0.2,0.1,0.1\n")
    (tmp_path / "data.yaml").write_text("names: [person, helmet]\n")
    args = ["consensus", str(tmp_path / "p.csv"), str(tmp_path / "v.csv"), str(tmp_path / "con"), "--names", str(tmp_path / "data.yaml"), "--labels", str(tmp_path / "agreed")]
    cli.main(args)
    assert [p.relative_to(tmp_path / "agreed").as_posix() for p in (tmp_path / "agreed").rglob("*.txt")] == ["train/Sub/A.txt"]
    assert (tmp_path / "agreed/train/Sub/A.txt").read_text() == "1 0.500000 0.500000 0.200000 0.200000\n0 0.200000 0.200000 0.100000 0.100000\n"
    with pytest.raises(ValueError, match="not empty"):
        cli.main(args)
    assert json.loads((tmp_path / "con/status.json").read_text())["status"] == "failed"
    (tmp_path / "data.yaml").write_text("names: [person]\n")
    with pytest.raises(ValueError, match="no number"):
        cli.main([*args[:-1], str(tmp_path / "other")])
    assert json.loads((tmp_path / "con/status.json").read_text())["resume_count"] == 1


def test_settings(tmp_path):
    assert config.thresholds(["smoking:0.70:0.45"])["smoking"] == (0.70, 0.45)
    for bad in ("smoking:0.4:0.5", "nobody:0.5:0.4", "smoking:0.5"):
        with pytest.raises(ValueError):
            config.thresholds([bad])
    assert config.models({"a": "x.pt", "b": {"path": "y.pt", "pred_class": 3}})["b"].pred_class == 3
    with pytest.raises(ValueError):
        config.models({"a": 3})
    assert config.class_names({"names": {"1": "b", "0": "a"}, "nc": 2}) == ["a", "b"]
    for bad in ({"names": {0: "a", 2: "b"}}, {"names": ["a", "a"]}, {"names": ["a"], "nc": 2}, {}):
        with pytest.raises(ValueError):
            config.class_names(bad)
    assert config._plain_yaml("path: .  # here\nnames: [a, 'b']\n") == {"path": ".", "names": ["a", "b"]}
    assert config.class_names(config._plain_yaml("names:\n- a\n- b\n")) == ["a", "b"]
    sinks.whole_json(tmp_path / "x.json", {"a": 1})
    assert [p.name for p in tmp_path.iterdir()] == ["x.json"]
