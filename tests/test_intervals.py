"""The binned overlap join against plain comparison, and its bound on rows."""

import random

import pytest
from pyspark.sql import functions as F

from twasprep.operators import intervals as I
from twasprep.operators import rsid as R


def _brute(points, spans):
    return sorted((k, q, a, b) for k, q in points for j, a, b in spans
                  if None not in (k, q, j, a, b) and k == j and a <= q <= b)


@pytest.mark.parametrize("seed", range(3))
def test_overlaps_equal_plain_comparison(spark, seed):
    rng = random.Random(seed)
    size = lambda: rng.choice([1, 1, 2, 15, 16, 17, 255, 256, 257, 5000, 100_000])
    spans = [(rng.choice("ab"), a, a + size() - 1) for a in (rng.randrange(120_000) for _ in range(80))]
    spans += [("a", 10, 9), ("a", None, 5), (None, 1, 9), ("a", -40, 40), ("b", 0, 2 ** 40), ("c", 7, 7)]
    points = [(rng.choice("abd"), rng.randrange(130_000)) for _ in range(150)]
    points += [("a", -1), ("a", 0), ("b", 2 ** 40), ("b", 2 ** 40 + 1), (None, 5), ("a", None), ("c", 7)]
    points = sorted(set(points), key=str)
    p = spark.createDataFrame(points, "k string, q long")
    s = spark.createDataFrame(spans, "k string, a long, b long")
    got = sorted(tuple(r) for r in I.overlaps(p, s, ["k"], "q", "a", "b").select("k", "q", "a", "b").collect())
    assert got == _brute(points, spans)


def test_a_record_is_at_most_two_rows_whatever_its_length(spark):
    lengths = [1, 3, 16, 1000, 100_000, 248_000_000]
    s = spark.createDataFrame([(i, 12_345, 12_344 + n) for i, n in enumerate(lengths)], "i int, a long, b long")
    rows = I.binned_intervals(s, "a", "b").groupBy("i").count().collect()
    assert len(rows) == len(lengths) and max(r["count"] for r in rows) <= 2


def test_long_deletion_blocks_the_fallback_without_a_row_per_base(spark):
    db = spark.createDataFrame(
        [("1", 1000, "rsDEL", "A" * 100_000, "A", 0), ("chr1", 50_000, "rs1", "C", "T", 1),
         ("chr1", 200_000, "rs2", "C", "T", 2)],
        "chrom string, pos long, rsid string, ref string, alt string, ord long")
    snps = spark.createDataFrame(
        [("1", 50_000, "v1", "C", "T", "."), ("1", 200_000, "v2", "C", "T", ".")],
        "chromosome string, pos long, varID string, ref_vcf string, alt_vcf string, rsid string")
    got = {r.varID: r.rsid for r in R.resolve_rsids(snps, db).collect()}
    assert got == {"v1": ".", "v2": "rs2"}
    report = {r.varID: tuple(r)[1:] for r in R.rsid_naming_report(snps, db).collect()}
    assert report == {"v1": (1, 1, "bare", "rsDEL"), "v2": (0, 1, "chr", "rs2")}
    found = {r.varID: tuple(r)[1:] for r in R.overlapping_records(snps, db).collect()}
    assert found == {"v1": (2, "rsDEL", 100_000), "v2": (1, "rs2", 1)}
    spans = R.record_spans(db)
    assert I.binned_intervals(spans, "first", "last").count() <= 2 * spans.count()
    assert spans.where(F.col("last") - F.col("first") > 90_000).count() == 1
