"""Positions of a sample's rows over several files."""

import random

from conftest import write
from pyspark.sql import functions as F

from twasprep.plans import workflows as WF
from twasprep.schemas import REGION_TENSORS
from twasprep.sources import positions as PO


def test_positions_follow_file_names_not_scan_order(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(PO, "STRETCH", 16)
    rng = random.Random(1)
    files = {"a": [("S1", n) for n in range(5)] + [(None, n) for n in range(2)],
             "b": [(rng.choice(["S1", "S2", None]), 10 + n) for n in range(400)],
             "c": [("S2", 1000 + n) for n in range(50)]}
    for name, rows in files.items():
        spark.createDataFrame(rows, "sample_id string, v int").repartition(1).sortWithinPartitions("v") \
            .write.parquet(f"{tmpdir_path}/{name}")
    seen = {}
    paths = [f"{tmpdir_path}/{n}" for n in reversed(files)]  # listed in any order
    got = PO.add_positions(PO.read_with_source(spark, paths)).collect()
    # rows in file-name order, then row order: count per sample as they come
    order = sorted(got, key=lambda r: (r["src_file"], r["src_row"]))
    for r in order:
        assert r["ord"] == seen.get(r["sample_id"], 0)
        seen[r["sample_id"]] = r["ord"] + 1
    assert sum(seen.values()) == sum(map(len, files.values())) == len(got)


def test_rejected_rows_take_no_position_and_the_first_file_comes_first(spark, tmpdir_path):
    small = [("S1", f"chr1_{r}", [[float(r)], [float(r)]]) for r in range(3)]
    small.insert(1, ("S1", "chr1_bad", [[1.0], [1.0, 2.0]]))
    large = [("S1", f"chr1_{r}", [[float(r)], [float(r)]]) for r in range(3, 400)]
    for name, rows in (("t1", small), ("t2", large)):
        spark.createDataFrame(rows, REGION_TENSORS).repartition(1) \
            .sortWithinPartitions(F.length("region"), "region").write.parquet(f"{tmpdir_path}/t/f={name}")
    write(tmpdir_path / "w.csv", "gene_name,region_names\nGA,chr1_0|chr1_3\n")
    WF.gene_features_job(spark, f"{tmpdir_path}/t", f"{tmpdir_path}/w.csv", f"{tmpdir_path}/o", chunk_rows=4)
    # positions 0 and 3: the same chunk of four, though the scan reads t2 first
    got = spark.read.parquet(f"{tmpdir_path}/o/gene_features").collect()
    assert [(r.gene_name, r.features) for r in got] == [("GA", [1.5])]


def test_contiguous_rows_need_no_rank(spark, tmpdir_path):
    spark.range(1000).select(F.concat(F.lit("S"), F.floor(F.col("id") / 500)).alias("sample_id"), "id") \
        .repartition(1).sortWithinPartitions("id").write.parquet(f"{tmpdir_path}/x")
    df = PO.add_positions(PO.read_with_source(spark, f"{tmpdir_path}/x"))
    assert df.where(F.col("ord") != F.col("id") % 500).count() == 0
