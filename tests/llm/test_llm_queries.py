"""The registered queries: those with SQL against DuckDB, and the pipeline stage by stage."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from compare import compare, duck
from ledgerline.llm.oracle import ORACLE_SQL
from ledgerline.llm.queries import QUERIES

SF_DIR = f"/root/testdata/sf{os.environ.get('LEDGERLINE_TEST_SF', '0.001')}"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    ok, msg = compare(QUERIES[name](spark, SF_DIR), duck(SF_DIR), ORACLE_SQL[name])
    assert ok, msg


def test_a_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_decisions_take_effect(spark, tmp_path):
    """Planted cases go, clean documents stay byte for byte."""
    import random
    rng = random.Random(5)
    words = [f"w{i}" for i in range(4000)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    clean = {i: text(120) for i in range(40)}
    rows = dict(clean)
    labelled = {}
    for i in range(300, 700):                                            # what the model learns from
        labelled[i] = i % 2
        rows[i] = text(30) + (". awful nasty brute. " if i % 2 else ". ") + text(30)
    rows[40] = text(60) + " awful nasty brute " + text(20)               # toxic
    rows[41] = clean[3]                                                   # exact copy
    near = clean[4].split()
    near[50] = "changed"
    rows[42] = " ".join(near)                                             # near copy
    passage = text(60)
    rows[43], rows[44] = f"{text(90)}\n{passage}\n{text(90)}", f"{text(90)}\n{passage}\n{text(90)}"
    item = text(25)
    leak = item.split()
    leak[7] = "other"
    rows[45] = f"{text(50)} {' '.join(leak).title()} {text(50)}"          # leaked test item, one word replaced
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows.items()] + [(None, None, "en", "s", None)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    base = str(tmp_path)
    docs.write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, y in labelled.items()], "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    now, kept = spark.read.parquet(f"{base}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, base)
        assert k == 4 or (out.columns == docs.columns and out.dtypes == docs.dtypes), name
        out.write.parquet(f"{base}/stage{k}")
        now = spark.read.parquet(f"{base}/stage{k}")
        kept[name] = {r.doc_id: r for r in now.collect()} if k < 4 else now.collect()
    assert 40 not in kept["toxicity"] and {41, 42, 43, 45, *clean} <= set(kept["toxicity"])
    assert not {41, 42} & set(kept["near_duplicates"]) and {43, 44, 45, *clean} <= set(kept["near_duplicates"])
    cut = kept["substring_dedup"]
    assert passage in cut[43].text and passage not in cut[44].text and cut[44].n_chars == len(cut[44].text) < len(rows[44])
    left = kept["decontamination"]
    assert 45 not in left and all(left[i].text == t for i, t in clean.items()) and left[None].text is None
    packed = kept["packing"]
    assert {r.doc_id for r in packed} == set(left)
    again = corpus_pipeline.run(spark, base).select("doc_id", "piece", "length", "ids_crc32")
    assert sorted(map(str, again.collect())) == sorted(str(r) for r in now.select(*again.columns).collect())


def test_pipeline_of_empty_documents(spark, tmp_path):
    for t, kind in (("documents", "doc_id long, text string, lang string, source string, n_chars long"),
                    ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], kind).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_name_the_dealt_operators():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "substring_dedup", "decontamination", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None and F is not None


def test_stages_take_any_column_names(spark, tmp_path):
    text = " ".join(f"t{i}" for i in range(60))
    rows = [(i, t, 1, "s", True, 4, 5, 6) for i, t in enumerate([text, "a b c " + text, text, "plain words here", None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, found_id int, __linked string, `my col` boolean, `a-b` int, "
                                       "found_hash int, `a.b` int")
    spark.createDataFrame([(0, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "plain words here and there and so on")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        assert all(r["a.b"] == 6 and r["my col"] is True for r in out.collect()), name
