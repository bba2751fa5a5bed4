import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[2]
SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").getOrCreate()
import public_tokenizers
from sievemark.llm import bpe, html_text, lang_crf, minhash, near_vectors, toxicity
docs = spark.createDataFrame([(1, "one two three four five six", "en"), (2, "eins zwei drei vier", "de"), (3, None, None)], "doc_id long, text string, lang string")
print("bpe", bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN).count())
pages = spark.createDataFrame([(i, "http://a/", f"<body><div>x</div><p>text {i}</p></body>") for i in range(5)], "page_id long, url string, html string")
print("html", html_text.extract(pages).filter("n_chars > 0").count())
print("lang", lang_crf.predict(docs, lang_crf.train(docs)).count())
print("tox", toxicity.predict(docs, toxicity.fit(["bad word"] * 9 + ["good word"] * 9, [1] * 9 + [0] * 9)).count())
print("minhash", minhash.near_duplicates(docs).count())
print("vectors", near_vectors.near_duplicates(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.1])], "vec_id long, embedding array<double>")).count())
"""


def test_operators_run_where_workers_cannot_import_the_package(tmp_path):
    """Without the package on PYTHONPATH and from another folder, functions travel inside the tasks."""
    import public_tokenizers

    script = tmp_path / "run.py"
    script.write_text(SCRIPT)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONPATH": str(Path(public_tokenizers.__file__).resolve().parents[1])}
    env["PYTHONPATH"] = os.pathsep.join(p for p in env["PYTHONPATH"].split(os.pathsep) if Path(p).resolve() != ROOT)
    done = subprocess.run([sys.executable, str(script), str(ROOT)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    assert done.stdout.split() == ["bpe", "3", "html", "5", "lang", "3", "tox", "3", "minhash", "3", "vectors", "2"]
