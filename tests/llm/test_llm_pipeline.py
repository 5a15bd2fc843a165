"""The pipeline's stages against brute force."""

import random

import corpus_pipeline
from mentionflow.llm import queries
from pyspark.sql import functions as F
from test_llm_operators import brute_components, brute_hits

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def write_tables(spark, path, rows, labels, items):
    spark.createDataFrame(rows, DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")


def test_stages_take_effect(spark, tmp_path):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choices(["ba", "de", "ti", "mo", "ru", "sel", "kan"], k=rng.randint(2, 4))) for _ in range(500)]
    text = lambda n=80: " ".join(rng.choices(vocabulary, k=n))
    items = [(1, text(14)), (2, text(6))]
    rows = [(i, text() + (" zorkish zorker" if i % 4 == 0 else ""), "en", f"s{i % 3}", 1) for i in range(400)]
    rows += [(1000 + k, rows[k][1] + " tail", "en", None, 1) for k in range(1, 4)]
    edited = text(100).split()  # two edits: similar by five words at 0.8, not by three at 0.9
    rows += [(1100, " ".join(edited), "en", "s1", 1), (1101, " ".join(vocabulary[k] if k in (33, 66) else w for k, w in enumerate(edited)), "en", "s1", 1)]
    rows += [(2000, text(30) + " " + items[0][1] + " " + text(20), "en", "s0", 1)]
    rows += [(3000, None, None, None, None), (3001, "", "en", "s1", 0), (None, text(3), "en", "s1", 3), (5, rows[5][1], "en", "s2", 1)]
    write_tables(spark, str(tmp_path), rows, [(i, 1, int(i % 4 == 0)) for i in range(400)], items)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    clean = corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).collect()
    assert {r.doc_id for r in clean} == {r[0] for r in rows if not (r[0] is not None and r[0] < 400 and r[0] % 4 == 0)}
    first = spark.createDataFrame(clean, DOCS)
    single = corpus_pipeline.drop_near_duplicates(spark, first, str(tmp_path)).collect()
    groups = brute_components([(r.doc_id, r.text) for r in clean], (5, 80))
    assert sorted(r.doc_id for r in single if r.doc_id is not None) == sorted(i for i, c in groups.items() if i == c)
    assert sum(r.doc_id is None for r in single) == 1
    left = corpus_pipeline.drop_contaminated(spark, spark.createDataFrame(single, DOCS), str(tmp_path)).collect()
    hits = brute_hits([(r.doc_id, r.text) for r in single if r.doc_id is not None], items)
    assert {r.doc_id for r in left} == {i for i, h in hits.items() if not h[1]} | {None}
    assert not any(r.doc_id == 2000 for r in left)
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in whole} <= {r.doc_id for r in left} and all(0 < r.taken <= 2 * r.size for r in whole)


def test_empty_tables(spark, tmp_path):
    write_tables(spark, str(tmp_path), [], [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).isEmpty()


def test_stages_and_columns(spark, sf_dir):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert corpus_pipeline.drop_contaminated(spark, docs, sf_dir).columns == docs.columns


def test_held_out_labels_are_not_learned(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("toxic", F.when(queries.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    score = lambda given: [r.s for r in docs.orderBy("doc_id").select(queries.toxicity_model(docs, given).score(F.col("text")).alias("s")).collect()]
    assert score(labels) == score(flipped)
