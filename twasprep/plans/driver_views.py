"""Workflow inputs derived by Spark from the benchmark tables.

The benchmark tables are a retail star schema; these views re-read them as
the genomics inputs the operators expect, so that every registered query's
work grows with the tables. Each view has a SQL twin in ``oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twasprep.functions.genotype import variant_id


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def variant_cols(key_col: str) -> list:
    k = F.col(key_col)
    idx = (k % 4 + 1).cast("int")
    return [
        F.concat(F.lit("chr"), (k % 22 + 1).cast("string")).alias("chrom"),
        (k * 10).cast("long").alias("pos"),
        F.lit("ACGT").substr(idx, F.lit(1)).alias("ref"),
        F.lit("CGTA").substr(idx, F.lit(1)).alias("alt"),
    ]


def gt_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phased genotype calls, long layout: one row per (variant, sample).

    Variant = part key (chromosome, position, alleles derived from it);
    sample = supplier key modulo 8; the call is the smallest GT string over
    the line items of that pair (line number 7 = no call).
    """
    li = table(spark, sf_dir, "lineitem")
    # The smallest GT string per pair, aggregated as a code whose order is the
    # string order ("./." < "0|0" < "0|1" < "1|0" < "1|1"): min() over an int
    # is a hash aggregate, min() over strings would be a sort aggregate.
    codes = ["./.", "0|0", "0|1", "1|0", "1|1"]
    code = (F.when(F.col("l_linenumber") == 7, F.lit(0))
            .when(F.col("l_returnflag") == "N", F.lit(1))
            .when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "O"), F.lit(2))
            .when(F.col("l_returnflag") == "A", F.lit(3))
            .otherwise(F.lit(4)))
    # group on the integer keys; the string columns are built on the
    # aggregated rows only
    cells = (li.groupBy(F.col("l_partkey").alias("vkey"), (F.col("l_suppkey") % 8).alias("_s"))
             .agg(F.min(code).alias("_code"))
             .select("vkey",
                     F.concat(F.lit("S"), F.lpad(F.col("_s").cast("string"), 2, "0"))
                     .alias("sample_id"),
                     F.element_at(F.array(*[F.lit(c) for c in codes]), F.col("_code") + 1)
                     .alias("gt")))
    v = cells.select("vkey", *variant_cols("vkey"), "sample_id", "gt")
    return v.select(variant_id("chrom", "pos", "ref", "alt").alias("varid"),
                    "chrom", "pos", "ref", "alt", "sample_id", "gt")


def variant_annotation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variant annotation: one row per part (also variants never genotyped)."""
    part = table(spark, sf_dir, "part")
    v = part.select(*variant_cols("p_partkey"))
    return v.select(variant_id("chrom", "pos", "ref", "alt").alias("varid"),
                    "chrom", "pos", "ref", "alt")


def snp_annotation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNP annotation to resolve, one row per part.

    Every 13th variant is multi-allelic (``alt,ref`` list), every 10th already
    has an rsid, every 97th a NULL rsid, every 89th no position; every 7th
    carries a legacy ``rsid_dbSNP150``.
    """
    part = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    v = part.select("p_partkey", *variant_cols("p_partkey"))
    alt = F.when(k % 13 == 0, F.concat_ws(",", "alt", "ref")).otherwise(F.col("alt"))
    return v.select(
        F.replace(F.col("chrom"), F.lit("chr"), F.lit("")).alias("chromosome"),
        F.when(k % 89 == 0, F.lit(None)).otherwise(F.col("pos")).cast("long").alias("pos"),
        variant_id("chrom", "pos", "ref", alt).alias("varID"),
        F.col("ref").alias("ref_vcf"),
        alt.alias("alt_vcf"),
        F.lit(1.0).alias("R2"),
        F.lit(None).cast("double").alias("MAF"),
        F.when(k % 97 == 0, F.lit(None).cast("string"))
        .when(k % 10 == 0, F.concat(F.lit("rsKNOWN"), k.cast("string")))
        .otherwise(F.lit(".")).alias("rsid"),
        F.when(k % 7 == 0, F.concat(F.lit("rsOLD"), k.cast("string")))
        .otherwise(F.lit(".")).alias("rsid_dbSNP150"),
    )


def dbsnp_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dbSNP-like records derived from part, in a fixed file order ``ord``.

    Per part: a first record whose chromosome is ``chr``-named when
    ``p_size % 3 = 0`` and whose ALT is exact / inside a comma list / a raw
    list / not matching by ``p_size % 4``; a second, always ``chr``-named,
    exact record when ``p_size % 5 = 0``; and a bare-named 3-base deletion
    starting two bases earlier (overlapping the position) when
    ``p_size % 7 = 0``.
    """
    part = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    s = F.col("p_size")
    v = part.select("p_partkey", "p_size", *variant_cols("p_partkey"))
    bare = (k % 22 + 1).cast("string")
    first_alt = (F.when(s % 4 == 0, F.col("alt"))
                 .when(s % 4 == 1, F.concat(F.lit("N,"), F.col("alt")))
                 .when(s % 4 == 2, F.concat(F.col("alt"), F.lit(",N")))
                 .otherwise(F.lit("N")))
    first = v.select(
        F.when(s % 3 == 0, F.concat(F.lit("chr"), bare)).otherwise(bare).alias("chrom"),
        F.col("pos"),
        F.concat(F.lit("rs"), (k * 3 + 1).cast("string")).alias("rsid"),
        F.col("ref"), first_alt.alias("alt"), (k * 3 + 1).cast("long").alias("ord"))
    second = v.where(s % 5 == 0).select(
        F.concat(F.lit("chr"), bare).alias("chrom"), F.col("pos"),
        F.concat(F.lit("rs"), (k * 3 + 2).cast("string")).alias("rsid"),
        F.col("ref"), F.col("alt"), (k * 3 + 2).cast("long").alias("ord"))
    deletion = v.where(s % 7 == 0).select(
        bare.alias("chrom"), (F.col("pos") - 2).alias("pos"),
        F.concat(F.lit("rs"), (k * 3).cast("string")).alias("rsid"),
        F.lit("ACG").alias("ref"), F.lit("A").alias("alt"), (k * 3).cast("long").alias("ord"))
    return first.unionByName(second).unionByName(deletion)


#: Bases of the long deletions among the overlap query's records.
LONG_DELETION = 100_000


def dbsnp_with_long_deletions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dbsnp_rows`` and, for parts of size 49, a deletion of ``LONG_DELETION``
    bases that starts at the variant (``chr``-named for every other part)."""
    part = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    bare = (k % 22 + 1).cast("string")
    long = part.where("p_size = 49").select(*variant_cols("p_partkey"), "p_partkey").select(
        F.when(k % 2 == 0, F.concat(F.lit("chr"), bare)).otherwise(bare).alias("chrom"), F.col("pos"),
        F.concat(F.lit("rsL"), k.cast("string")).alias("rsid"),
        F.repeat(F.lit("A"), F.lit(LONG_DELETION)).alias("ref"), F.lit("A").alias("alt"),
        (k * 3 - 1).cast("long").alias("ord"))
    return dbsnp_rows(spark, sf_dir).unionByName(long)


def _region_of(r):
    return F.concat(F.lit("chr"), (r % 22 + 1).cast("string"), F.lit("_"), r.cast("string"))


def region_tensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region tensors: four consecutive embeddings form the bins of one region."""
    e = table(spark, sf_dir, "embeddings")
    r = (F.col("vec_id") / 4).cast("long")
    grouped = (e.groupBy(r.alias("r"))
               .agg(F.array_sort(F.collect_list(F.struct("vec_id", "embedding"))).alias("_b")))
    return grouped.select(
        F.concat(F.lit("S"), (F.col("r") % 3).cast("string")).alias("sample_id"),
        _region_of(F.col("r")).alias("region"),
        F.transform("_b", lambda s: s["embedding"]).alias("bins"),
    )


def region_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region feature rows: sample = vec_id mod 4, region = vec_id div 4, and
    the row position in the sample's file (``ord``) = region number."""
    e = table(spark, sf_dir, "embeddings")
    r = F.floor(F.col("vec_id") / 4).cast("long")
    return e.select(
        F.concat(F.lit("S"), (F.col("vec_id") % 4).cast("string")).alias("sample_id"),
        _region_of(r).alias("region"),
        F.concat(F.lit("chr"), (r % 22 + 1).cast("string")).alias("chromo"),
        r.alias("ord"),
        F.col("embedding").cast("array<double>").alias("features"),
    )


def gene_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gene windows over the regions: ``G<b>`` = regions b*5..b*5+4, ``H<b>``
    the same blocks shifted by two (windows overlap); each list repeats its
    first region. Plus a NULL, an empty and an unmatched window."""
    e = table(spark, sf_dir, "embeddings")
    r = F.floor(F.col("vec_id") / 4).cast("long")
    regions = e.select(r.alias("r")).distinct().select("r", _region_of(F.col("r")).alias("region"))

    def block(prefix: str, shift: int) -> DataFrame:
        g = regions.groupBy(F.concat(F.lit(prefix), F.floor((F.col("r") + shift) / 5).cast("string"))
                            .alias("gene_name")) \
            .agg(F.array_sort(F.collect_list("region")).alias("_l"))
        return g.select("gene_name", F.array_join(F.array_append("_l", F.element_at("_l", 1)), "|")
                        .alias("region_names"))

    extra = spark.createDataFrame(
        [("GNULL", None), ("GEMPTY", ""), ("GNONE", "chr0_none|chr0_gone")],
        "gene_name string, region_names string")
    return block("G", 0).unionByName(block("H", 2)).unionByName(extra)


def gene_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gene feature rows per sample: sample = label, gene = vec_id div 3 (so a
    gene can repeat within a sample), ``ord`` = vec_id (file order)."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.concat(F.lit("L"), F.col("label").cast("string")).alias("sample_id"),
        F.concat(F.lit("g"), F.floor(F.col("vec_id") / 3).cast("string")).alias("gene_name"),
        F.col("vec_id").cast("long").alias("ord"),
        F.col("embedding").cast("array<double>").alias("features"),
    )


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as prediction rows: sample = event type, gene = user, ord = event id."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_type").alias("sample_id"),
        F.concat(F.lit("g"), F.col("user_id").cast("string")).alias("gene_name"),
        F.col("event_id").alias("ord"),
        F.col("value"),
    )


# Cell types of the event-derived predictions: the event types, plus one
# that never occurs (its column is absent and must be skipped).
EVENT_CELL_TYPES = ("click", "error", "purchase", "signup", "view", "refund")
# Samples discovered for the event-derived predictions (S6 has no file rows).
EVENT_SAMPLES = ("S0", "S1", "S2", "S3", "S4", "S5", "S6")


def event_predictions_wide(spark: SparkSession, sf_dir: str, suffix: str = "_predicted"
                           ) -> DataFrame:
    """Wide per-sample predictions: sample = event id mod 6, gene = user, one
    column per occurring event type = its latest value for that pair."""
    ev = table(spark, sf_dir, "events")
    occurring = [c for c in EVENT_CELL_TYPES if c != "refund"]
    cols = [F.max_by(F.when(F.col("event_type") == ct, F.col("value")),
                     F.when(F.col("event_type") == ct, F.col("event_id"))).alias(f"{ct}{suffix}")
            for ct in occurring]
    return ev.groupBy(
        F.concat(F.lit("S"), (F.col("event_id") % 6).cast("string")).alias("sample_id"),
        F.concat(F.lit("g"), F.col("user_id").cast("string")).alias("gene_name"),
    ).agg(*cols)


def legacy_named_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer rows under legacy model-output column names (two cell types),
    plus an unrelated column that renaming must leave alone."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_name").alias("gene_name"),
        F.col("c_acctbal").alias("pericytes_mean_expression_mean_expression_predicted_expression"),
        F.col("c_custkey").cast("double")
        .alias("neurons_mean_expression_mean_expression_predicted_expression"),
        F.col("c_mktsegment").alias("segment"),
    )


def expression_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expression matrix keyed by gene name (several rows per gene)."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.concat(F.lit("GENE"), F.col("c_nationkey").cast("string")).alias("gene_name"),
        F.col("c_custkey").alias("S_key"),
        F.col("c_acctbal").alias("S_acct"),
    )


def gene_annotation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gene annotation for nations outside region 4; region-0 genes are
    defined twice, the later definition (higher ``ord``) wins."""
    n = table(spark, sf_dir, "nation")
    base = n.where(F.col("n_regionkey") != 4)
    first = base.select(
        F.concat(F.lit("GENE"), F.col("n_nationkey").cast("string")).alias("gene_name"),
        F.concat(F.lit("ENSG"), F.lpad(F.col("n_nationkey").cast("string"), 11, "0")).alias("ensembl_id"),
        F.col("n_nationkey").cast("long").alias("ord"))
    again = base.where(F.col("n_regionkey") == 0).select(
        F.concat(F.lit("GENE"), F.col("n_nationkey").cast("string")).alias("gene_name"),
        F.concat(F.lit("ENSGALT"), F.col("n_nationkey").cast("string")).alias("ensembl_id"),
        (F.col("n_nationkey") + 100).cast("long").alias("ord"))
    return first.unionByName(again)


def manifest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempt log: one entry per line item for its order (success when the
    return flag is N), rows = line number."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.lit("predict").alias("stage"),
        F.col("l_orderkey").cast("string").alias("key"),
        F.when(F.col("l_returnflag") == "N", F.lit("success")).otherwise(F.lit("failed"))
        .alias("status"),
        F.col("l_linenumber").cast("long").alias("rows"),
    )


def manifest_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").cast("string").alias("key"))


# Sample names of the rendered VCF header (file order, alphabetical).
VCF_HEADER_SAMPLES = ("S00", "S01", "S02", "S03", "S04", "S05", "S06", "S07")


def _per_variant_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per variant with its calls as a sample -> GT map (at most one
    entry per sample, so the gathered group is bounded by the sample count)."""
    cells = gt_cells(spark, sf_dir)
    return cells.groupBy("varid", "chrom", "pos", "ref", "alt").agg(
        F.map_from_entries(F.collect_list(F.struct("sample_id", "gt"))).alias("calls"))


def _chromosome_files(spark: SparkSession, sf_dir: str, prefix: str, suffix: str) -> DataFrame:
    """One "file" per chromosome present in the calls (a cheap distinct on the
    part key column, independent of the call aggregation)."""
    li = table(spark, sf_dir, "lineitem")
    chrom = F.concat(F.lit("chr"), (F.col("l_partkey") % 22 + 1).cast("string"))
    return li.select(chrom.alias("chrom")).distinct().select(
        F.concat(F.lit(prefix), F.col("chrom"), F.lit(suffix)).alias("file_path"))


def vcf_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The genotype calls rendered as VCF text, one "file" per chromosome:
    ``(file_path, line_no, value)``. A meta line and the ``#CHROM`` header
    open every file; every third variant carries ``GT:DP`` cells; a pair
    without a call is written ``./.``."""
    v = _per_variant_cells(spark, sf_dir)
    k = (F.col("pos") / 10).cast("long")
    with_dp = k % 3 == 0
    cells = F.transform(
        F.array(*[F.lit(s) for s in VCF_HEADER_SAMPLES]),
        lambda s: F.when(with_dp, F.concat(F.coalesce(F.element_at("calls", s), F.lit("./.")),
                                           F.lit(":7")))
        .otherwise(F.coalesce(F.element_at("calls", s), F.lit("./."))))
    fmt = F.when(with_dp, F.lit("GT:DP")).otherwise(F.lit("GT"))
    file_path = F.concat(F.lit("vcf/"), F.col("chrom"), F.lit(".vcf"))
    records = v.select(
        file_path.alias("file_path"), (F.col("pos") + 2).alias("line_no"),
        F.concat_ws("\t", "chrom", F.col("pos").cast("string"), F.lit("."), "ref", "alt",
                    F.lit("."), F.lit("PASS"), F.lit("."), fmt, F.array_join(cells, "\t"))
        .alias("value"))
    files = _chromosome_files(spark, sf_dir, "vcf/", ".vcf")
    header = "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT",
                        *VCF_HEADER_SAMPLES])
    meta = files.select("file_path", F.lit(0).cast("long").alias("line_no"),
                        F.lit("##fileformat=VCFv4.2").alias("value"))
    head = files.select("file_path", F.lit(1).cast("long").alias("line_no"),
                        F.lit(header).alias("value"))
    return meta.unionByName(head).unionByName(records)


def matrix_lines_rendered(spark: SparkSession, sf_dir: str, samples) -> DataFrame:
    """Dosage-matrix text per chromosome: header ``varID <samples>`` then one
    row per variant; odd variants use spaces, even ones tabs; every 50th
    variant is preceded by a stale all-zero row that the later row replaces."""
    v = _per_variant_cells(spark, sf_dir)
    k = (F.col("pos") / 10).cast("long")
    dose = {"0|0": "0", "0|1": "1", "1|0": "1", "1|1": "2"}
    dmap = F.create_map(*[F.lit(x) for kv in dose.items() for x in kv])
    toks = F.transform(F.array(*[F.lit(s) for s in samples]),
                       lambda s: F.coalesce(F.element_at(dmap, F.element_at("calls", s)),
                                            F.lit(".")))
    sep = F.when(k % 2 == 1, F.lit(" ")).otherwise(F.lit("\t"))
    file_path = F.concat(F.lit("geno/"), F.col("chrom"), F.lit("_genotypes.txt"))
    rows = v.select(file_path.alias("file_path"), (k * 2 + 2).alias("line_no"),
                    F.concat(F.col("varid"), sep, F.array_join(toks, " ")).alias("value"))
    stale = v.where(k % 50 == 0).select(
        file_path.alias("file_path"), (k * 2 + 1).alias("line_no"),
        F.concat_ws("\t", F.col("varid"), *[F.lit("0") for _ in samples]).alias("value"))
    files = _chromosome_files(spark, sf_dir, "geno/", "_genotypes.txt")
    head = files.select("file_path", F.lit(0).cast("long").alias("line_no"),
                        F.lit("\t".join(["varID", *samples])).alias("value"))
    return head.unionByName(rows).unionByName(stale)


def annotation_lines_rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headerless variant annotation text, one row per part; every 40th
    variant is followed by a 4-field junk row and a 6-field row (rejected)."""
    a = variant_annotation_rows(spark, sf_dir)
    k = (F.col("pos") / 10).cast("long")
    file_path = F.concat(F.lit("ann/"), F.col("chrom"), F.lit("_variant_annotation.txt"))
    good = a.select(file_path.alias("file_path"), (k * 3).alias("line_no"),
                    F.concat_ws("\t", "varid", "chrom", F.col("pos").cast("string"), "ref", "alt")
                    .alias("value"))
    junk = a.where(k % 40 == 0).select(
        file_path.alias("file_path"), (k * 3 + 1).alias("line_no"),
        F.concat_ws("\t", F.lit("junk"), "chrom", F.col("pos").cast("string"), "ref")
        .alias("value"))
    wide = a.where(k % 40 == 0).select(
        file_path.alias("file_path"), (k * 3 + 2).alias("line_no"),
        F.concat_ws("\t", F.concat(F.col("varid"), F.lit("_x")), "chrom",
                    F.col("pos").cast("string"), "ref", "alt", F.lit("extra")).alias("value"))
    return good.unionByName(junk).unionByName(wide)
