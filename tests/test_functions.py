from twasprep.functions.genotype import (
    clean_chromosome,
    dosage_of_gt,
    dosage_of_token,
    folded_maf,
    reformat_varid,
    render_maf,
    variant_id,
)


def test_dosage_of_gt_exact_phased_only(spark):
    gts = ["0|0", "0|1", "1|0", "1|1", "0/1", "1|2", ".", "./.", "1", None]
    df = spark.createDataFrame([(g,) for g in gts], "gt string")
    got = [r.d for r in df.select(dosage_of_gt("gt").alias("d")).collect()]
    assert got == [0, 1, 1, 2, None, None, None, None, None, None]


def test_dosage_of_token(spark):
    df = spark.createDataFrame([(t,) for t in ["0", "1", "2", ".", "3", "NA"]], "t string")
    assert [r.d for r in df.select(dosage_of_token("t").alias("d")).collect()] == \
        [0, 1, 2, None, None, None]


def test_variant_id_keeps_comma_alt(spark):
    df = spark.createDataFrame([("chr1", 300, "G", "A,T")], "c string, p long, r string, a string")
    assert df.select(variant_id("c", "p", "r", "a").alias("v")).first().v == "chr1_300_G_A,T"


def test_reformat_varid_leading_chr_only_and_not_idempotent(spark):
    df = spark.createDataFrame([("chr1_100_A_G",), ("1_5_A_C",), ("xchr2_1_A_C",)], "v string")
    out = df.select(reformat_varid("v").alias("a"),
                    reformat_varid(reformat_varid("v")).alias("b"),
                    reformat_varid(reformat_varid("v"), idempotent=True).alias("c")).collect()
    assert [r.a for r in out] == ["1_100_A_G_GRCh38", "1_5_A_C_GRCh38", "xchr2_1_A_C_GRCh38"]
    assert out[0].b == "1_100_A_G_GRCh38_GRCh38"
    assert out[0].c == "1_100_A_G_GRCh38"


def test_clean_chromosome_removes_every_chr(spark):
    df = spark.createDataFrame([("chr1",), ("chrchr2",), ("X",)], "c string")
    assert [r.c for r in df.select(clean_chromosome("c").alias("c")).collect()] == ["1", "2", "X"]


def test_folded_maf_matches_python_round(spark):
    # every k/d for a range of denominators, incl. exact ties (d = 64, 128)
    rows = [(k, d) for d in (2, 6, 10, 14, 64, 128, 320, 640, 1006, 5008, 8000, 20000)
            for k in range(0, d + 1)]
    df = spark.createDataFrame(rows, "k long, d long")
    got = {(r.k, r.d): r.m for r in df.select("k", "d", folded_maf("k", "d").alias("m")).collect()}
    for k, d in rows:
        x = k / d
        if x > 0.5:
            x = 1 - x
        assert got[(k, d)] == round(x, 5), (k, d)


def test_folded_maf_null_without_calls(spark):
    df = spark.createDataFrame([(0, 0)], "k long, d long")
    assert df.select(folded_maf("k", "d").alias("m")).first().m is None


def test_render_maf_like_python(spark):
    vals = [0.5, 0.0, 1e-05, 3e-05, 0.00012, 0.125, 0.33333, None]
    df = spark.createDataFrame([(v,) for v in vals], "m double")
    got = [r.t for r in df.select(render_maf("m").alias("t")).collect()]
    assert got == ["0.5", "0.0", "1e-05", "3e-05", "0.00012", "0.125", "0.33333", "NA"]
    assert got[:-1] == [str(v) for v in vals[:-1]]


def test_natural_order(spark):
    from twasprep.operators.genotype import chromosome_order

    df = spark.createDataFrame([(c,) for c in ["10", "2", "X", "1", "22", "Y"]], "chromosome string")
    got = [r.chromosome for r in chromosome_order(df).orderBy("chrom_rank").collect()]
    assert got == ["1", "2", "10", "22", "X", "Y"]


def test_gt_of_sample_cell_by_format_position(spark):
    from twasprep.functions.genotype import gt_field_index, gt_of_sample_cell

    rows = [("GT", "0|1"), ("GT:DS", "1|1:2"), ("DS:GT", "0.5:1|0"), ("DS:GT", "0.5"),
            ("DS", "0.5"), ("GT", None), ("GT:DP:GQ", "0|0:7:9")]
    df = spark.createDataFrame(rows, "fmt string, cell string")
    got = [r.g for r in df.select(gt_of_sample_cell("cell", gt_field_index("fmt")).alias("g"))
           .collect()]
    assert got == ["0|1", "1|1", "1|0", ".", ".", ".", "0|0"]
