import os
import subprocess
import sys

import numpy as np

from codexlake.llm import common


def test_cut_writes_to_the_shared_folder_and_release_clears_it(spark):
    df = common.cut(spark.range(5).selectExpr("id", "CAST(NULL AS STRING) AS s"), "numbers")
    assert df.schema.simpleString() == "struct<id:bigint,s:string>" and df.count() == 5
    assert all(p.startswith(common.shared_dir(spark)) or common.shared_dir(spark).split(":", 1)[-1].lstrip("/") in p for p in df.inputFiles())
    common.release(spark)
    assert common.cut(spark.range(2), "again").count() == 2


def test_hash_samples_are_fixed_and_bounded(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    one, two = ({r["k"] for r in common.hash_sample(df.repartition(n), ["k"], 100).collect()} for n in (1, 7))
    assert one == two and len(one) == 100
    assert common.hash_sample(df.limit(10), ["k"], 100).count() == 10
    assert common.hash_sample(df.limit(0), ["k"], 100).count() == 0


def test_held_out_is_the_crc_of_the_text(spark):
    import zlib

    rows = spark.createDataFrame([(i,) for i in (0, 7, 123456, None)], "doc_id long").select("doc_id", common.held_out("doc_id", 4, 2).alias("h")).collect()
    assert [r["h"] for r in rows] == [zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 if r["doc_id"] is not None else False for r in rows]


def test_logistic_fit_recovers_a_curve():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(20_000, 2))
    y = (rng.random(20_000) < common.sigmoid(x @ np.array([1.5, -0.5]) + 0.25)).astype(float)
    assert np.allclose(common.fit_logistic(x, y, 1e-6), [1.5, -0.5, 0.25], atol=0.1)


OUTSIDE = """
import sys
sys.path.insert(0, {root!r})
import public_tokenizers
from pyspark.sql import SparkSession
from codexlake.llm import media, near_texts, packing, pieces, secrets, simhash
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").config("spark.sql.warehouse.dir", {warehouse!r}).getOrCreate()
df = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
for f in ({call}):
    assert f(df).count() == 2
"""


def test_operators_run_on_workers_that_lack_the_package(tmp_path):
    """From another folder, on a frame that no function of the package has made."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    call = "lambda df: pieces.digest(df, public_tokenizers.path('piece_bpe_32k.model')), media.text_media, secrets.scan_secrets, simhash.fingerprints, near_texts.keep_one"
    script = OUTSIDE.format(root=root, warehouse=str(tmp_path / "w"), call=call)
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert done.returncode == 0, done.stderr[-3000:]
    assert not any(p.name.startswith("codexlake-") for p in (tmp_path / "w").rglob("codexlake-*"))  # cleared at the end
