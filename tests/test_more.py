"""Operators that no query covers, and odd inputs."""

from pyspark.sql import functions as F

from lodestack.operators import classify, evolve, metrics, pages, textstyle, wiki
from lodestack.sources import sinks


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_semantic_graph(spark):
    files = spark.createDataFrame([("a.py", "script", "readme"), ("b.md", "raw", None)], "path string, role string, evidence string")
    nodes, edges = wiki.semantic_graph(files)
    assert {r["node"] for r in nodes.collect()} == {"a.py", "script", "readme", "b.md", "raw"}
    assert {tuple(r) for r in edges.collect()} == {("a.py", "script", "has role"), ("b.md", "raw", "has role"), ("script", "readme", "shown by")}


def test_page_text(spark):
    html = '<title>T</title><style>p{}</style><p>Hi <b>you</b></p><!-- x --><script>var a="<p>";</script><img src="i.png"><a href="/x">x</a>'
    r = one(spark, pages.visible_text(F.lit(html)), pages.media(F.lit(html)), pages.links(F.lit(html)), pages.title(F.lit("")))
    assert tuple(r) == ("T Hi you x", ["i.png"], ["/x"], None)
    df = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    assert tuple(pages.evaluate(df, "title").first()["result"]) == ("T", None)
    assert tuple(pages.evaluate(df, "eval(1)").first()["result"]) == (None, "unknown extraction eval(1)")


def test_retention_lens_and_opportunity(spark):
    t = F.lit(True)
    f = F.lit(False)
    r = one(spark, classify.retention(F.lit("growth means value")), classify.retention(F.lit("12 percent")), classify.lens(f, f, f), classify.lens(f, t, f), classify.opportunity(t, t, f), classify.container(t, f, f))
    assert tuple(r) == ("keep", "drop", "full", "primitive", 2, "prompt")


def test_top_rows(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 2.0)], "n string, v double")
    assert [r["n"] for r in evolve.top_k(df, F.col("v"), 2, "n").collect()] == ["b", "c"]
    assert evolve.top_k_each(df, "v", [F.col("n")], 1).count() == 2


def test_function_shape_finds_the_exponential(spark):
    df = spark.range(1, 30).select(F.col("id").cast("double").alias("x"), F.exp(F.col("id") / 3).alias("y"))
    best = metrics.function_shape(df, "x", "y").orderBy(F.desc("r2")).first()
    assert best["shape"] == "exponential"
    assert abs(best["r2"] - 1) < 1e-9
    assert {r["r2"] for r in metrics.function_shape(df.limit(0), "x", "y").collect()} == {0.0}


def test_entropy_and_attribution(spark):
    df = spark.createDataFrame([(1, "a b a b"), (2, "x"), (3, "")], "k int, t string")
    assert {r["k"]: round(r["entropy"], 9) for r in textstyle.entropy(df, "k", "t").collect()} == {1: 1.0, 2: 0.0}
    assert one(spark, textstyle.attributed(F.lit("报告说增长")))[0] is True


def test_cleanable(spark):
    a = spark.createDataFrame([(1, 10), (2, 20)], "k int, length int")
    assert [r["k"] for r in sinks.cleanable(a, a.where("k = 2").select("k"), "k").collect()] == [2]


def test_stored_tables_are_released(spark):
    from pathlib import Path

    from lodestack.sources import shared

    t = shared.stored(spark.range(3), "some")
    path = Path(t._stored_at)
    assert t.count() == 3
    assert path.is_dir()
    shared.release(t, spark.range(1))  # a table that isn't stored is left alone
    assert not path.exists()
    assert str(path) not in shared._WRITTEN


def test_no_shared_folder_is_an_error_on_a_cluster():
    from unittest.mock import MagicMock

    import pytest

    from lodestack.sources import shared

    cluster = MagicMock()
    cluster.conf.get.return_value = None
    cluster.sparkContext.getCheckpointDir.return_value = None
    cluster.sparkContext._jsc.sc.return_value.isLocal.return_value = False
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared.shared_dir(cluster)
    cluster.conf.get.return_value = "hdfs:///shared/"
    assert shared.shared_dir(cluster) == "hdfs:///shared"
