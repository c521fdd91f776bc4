"""The pipeline, stage by stage, against brute force."""

import zlib

import numpy as np
import pytest

pytest.importorskip("lodestack.llm")
corpus_pipeline = pytest.importorskip("corpus_pipeline")
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lodestack.llm import quality, toxicity
from lodestack.llm.common import table
from lodestack.llm.queries import vocabulary

from .test_operators import brute_components, brute_lines

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        seen[name] = {r["doc_id"]: r for r in out.collect()} if name != "packing" else out.collect()
        if name != "packing":
            assert out.columns == columns
            docs = spark.createDataFrame(list(seen[name].values()), docs.schema)
    labels = {r["doc_id"]: r for r in table(spark, SF, "labels").collect()}
    good = [i for i, r in labels.items() if r["quality"] == 1 and r["toxic"] == 0]
    assert sum(i in seen["toxicity"] for i in good) >= 0.9 * len(good)
    before = [(i, r["text"]) for i, r in seen["toxicity"].items()]
    assert sorted((i, r["text"], r["n_chars"]) for i, r in seen["line_dedup"].items()) == sorted((i, t, len(t)) for i, _, _, t in brute_lines(before))
    kept = brute_components([(i, r["text"]) for i, r in seen["line_dedup"].items()])
    assert set(seen["near_dedup"]) == {i for i, (_, _, k) in kept.items() if k}
    full = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    for r in seen["packing"]:
        ids = [*full.encode(seen["near_dedup"][r["doc_id"]]["text"], add_special_tokens=False).ids, 0]
        assert zlib.crc32(np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes()) == r["ids_crc32"]
    assert {r["doc_id"] for r in seen["packing"]} == set(seen["near_dedup"])


CLASHING = "_score score _id _ a.b kept_text rest carried c c0 key component n_lines".split()


def test_stages_on_odd_and_empty_tables(spark, edges):
    """Nulls, repeats and extra columns under the operators' own names; every stage but the last returns all columns."""
    docs = edges.select("doc_id", "text").withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.char_length("text").cast("long")})
    docs = docs.withColumns({c: F.concat(F.lit(f"{c} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for c in CLASHING})
    for rows in (docs, docs.where("false")):
        at = rows
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, at, SF)
            if name != "packing":
                assert out.columns == docs.columns
                at = spark.createDataFrame(out.collect(), out.schema)
                for r in at.collect():
                    assert all(r[c] == f"{c} {'none' if r['doc_id'] is None else r['doc_id']}" for c in CLASHING)
            else:
                at = out
        assert (at.count() > 0) == (rows.count() > 0)


def test_near_dedup_keeps_one_row_of_a_document(spark):
    long = " ".join(f"w{i}" for i in range(50))
    rows = [(1, long), (1, long), (1, long + " x"), (2, long), (3, "other words of its own here"), (None, long), (None, "no id"), (None, "no id"), (None, None), (None, None), (4, None), (5, ""), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.lit(0))
    got = sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()), key=repr)
    assert [i for i, _ in got] == [1, 3, 4, 5, None, None, None]
    assert got[0][1] in (long, long + " x")
    assert {t for i, t in got if i is None} == {long, "no id", None}


@pytest.mark.parametrize(("stage", "module", "label", "keep"), [("quality", quality, "quality", lambda s: s >= 0.3), ("toxicity", toxicity, "toxic", lambda s: s < 0.5)])
def test_classifier_stages_equal_brute_force(spark, stage, module, label, keep):
    """The stage keeps just the rows that the model, applied text by text, lets through; and it drops what it should."""
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    fold = lambda i: zlib.crc32(str(i).encode()) % 5
    model = module.fit(*(spark.createDataFrame([r for r in t.collect() if fold(r["doc_id"]) != 0], t.schema) for t in (docs, labels)))
    want = {r["doc_id"] for r in docs.collect() if keep(float(model.score([r["text"]])[0]))}
    got = {r["doc_id"] for r in dict(corpus_pipeline.STAGES)[stage](spark, docs, sf).select("doc_id").collect()}
    assert got == want
    known = {r["doc_id"]: r[label] for r in labels.collect()}
    bad, good = (0, 1) if label == "quality" else (1, 0)
    assert sum(i in got for i, y in known.items() if y == good) >= 0.97 * sum(y == good for y in known.values())
    assert sum(i in got for i, y in known.items() if y == bad) <= 0.2 * sum(y == bad for y in known.values())


def test_run_is_registered(spark):
    import __spark_entry__ as e

    assert e.queries()["pipeline"](spark, SF).count() > 0
    assert "pipeline" not in e.oracle_sql()
