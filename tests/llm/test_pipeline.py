"""The pipeline's stages against plain Python over a planted fixture."""

import random

import corpus_pipeline
from pyspark.sql import functions as F

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_pipeline_keeps_clean_rows_and_drops_planted_ones(spark, tmp_path):
    rng = random.Random(1)
    word = lambda: f"w{rng.randrange(5000)}"
    clean = [" ".join(word() for _ in range(60)) for _ in range(60)]
    leak = " ".join(word() for _ in range(30))
    near = clean[0].split()
    near[30] = "changed"
    texts = clean + [clean[1], " ".join(near), clean[2][:50] + " " + leak + " " + clean[3][:40] + " end of it all",
                     "too short", None]
    rows = [(i, t, "en", f"s{i % 4}", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(0, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = None
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept = {r["doc_id"] for r in docs.collect()}
    assert len(kept) == 60 and 62 not in kept and 63 not in kept and 64 not in kept
    assert len(kept & {1, 60}) == 1 and len(kept & {0, 61}) == 1
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert set(r["doc_id"] for r in out.select("doc_id").distinct().collect()) <= kept
    sizes = [r["count"] for r in out.groupBy("shard").count().collect()]
    assert not sizes or max(sizes) - min(sizes) <= 1
    assert out.select(F.countDistinct("row_number")).first()[0] == out.count()
