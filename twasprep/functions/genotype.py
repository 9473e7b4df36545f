"""Genotype, variant-id and allele-frequency expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from twasprep.schemas import BUILD_SUFFIX, MAF_DIGITS, PHASED_DOSAGE


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def variant_id(chrom, pos, ref, alt) -> Column:
    """``CHROM_POS_REF_ALT``; a multi-allelic ALT keeps its comma list."""
    return F.concat_ws("_", _c(chrom), _c(pos).cast("string"), _c(ref), _c(alt))


def dosage_of_gt(gt) -> Column:
    """Phased GT string -> alternate-allele dosage (tinyint), NULL otherwise.

    Only the four exact phased forms count; ``0/1``, ``1|2``, ``.``, ``./.``
    and haploid calls have no dosage.
    """
    gt = _c(gt)
    expr = None
    for text, dose in PHASED_DOSAGE:
        expr = (F.when(gt == text, F.lit(dose)) if expr is None
                else expr.when(gt == text, F.lit(dose)))
    return expr.cast("tinyint")


def gt_field_index(format_field) -> Column:
    """1-based position of ``GT`` in a FORMAT column (0 when absent). Compute
    it once per record, not once per sample cell."""
    return F.array_position(F.split(_c(format_field), ":"), "GT").cast("int")


def gt_of_sample_cell(cell, gt_index) -> Column:
    """GT sub-field of a VCF sample cell given the record's GT position.

    The field is cut out with ``substring_index`` (no per-cell array). A
    FORMAT without GT, or a cell shorter than the GT position, yields ``.``
    (what a per-sample GT query prints for an absent value).
    """
    cell = _c(cell)
    idx = _c(gt_index)
    n_fields = F.size(F.split(cell, ":"))
    upto = F.call_function("substring_index", cell, F.lit(":"), idx)
    field = F.when(idx == 1, F.substring_index(cell, ":", 1)).otherwise(
        F.substring_index(upto, ":", -1))
    ok = (idx > 0) & (cell.isNotNull()) & ((idx == 1) | (n_fields >= idx))
    return F.when(ok, field).otherwise(F.lit("."))


def dosage_of_token(token) -> Column:
    """Dosage-matrix cell -> tinyint; only ``0``, ``1``, ``2`` are calls."""
    token = _c(token)
    return F.when(token.isin("0", "1", "2"), token.cast("tinyint"))


def allele_counts_of(dosages) -> tuple[Column, Column]:
    """(alt_count, total_alleles) of an array of dosages, row-local."""
    called = F.filter(_c(dosages), lambda d: d.isNotNull())
    alt = F.aggregate(called, F.lit(0).cast("long"), lambda acc, d: acc + d.cast("long"))
    total = F.size(called).cast("long") * F.lit(2)
    return alt, total


def folded_maf(alt_count, total_alleles, digits: int | None = MAF_DIGITS) -> Column:
    """Minor allele frequency: alt/total folded at 0.5 and rounded half-even
    exactly as rounding the binary double ``alt/total`` does.

    The ratio is rounded on exact decimals; only when that ratio is exactly
    half-way does the binary value decide, through the sign of the double's
    residual ``alt - q * total``. The residual is computed exactly with a
    Veltkamp split of ``q`` (both partial products are exact for any
    realistic allele count). NULL when there are no called alleles.
    """
    k = _c(alt_count)
    d = _c(total_alleles)
    kd, dd = k.cast("double"), d.cast("double")
    q = kd / dd
    c = q * F.lit(134217729.0)  # 2**27 + 1
    q_hi = c - (c - q)
    q_lo = q - q_hi
    residual = (kd - q_hi * dd) - q_lo * dd  # exact: sign of (alt/total - q)
    ratio = k.cast("decimal(20,0)") / d.cast("decimal(20,0)")
    fold = ratio > F.lit(0.5)
    folded = F.when(fold, F.lit(1) - ratio).otherwise(ratio)
    if digits is None:
        return F.when(d > 0, F.when(fold, F.lit(1.0) - q).otherwise(q))
    scale = F.lit(10 ** digits).cast("decimal(20,0)")
    scaled = folded * scale
    low = F.floor(scaled)
    tie = (scaled - low) == F.lit(0.5)
    # binary value above the exact ratio <=> q > alt/total, mirrored by the fold
    above = F.when(fold, residual > 0).otherwise(residual < 0)
    below = F.when(fold, residual < 0).otherwise(residual > 0)
    rounded = (F.when(tie & above, low + 1)
               .when(tie & below, low)
               .otherwise(F.bround(scaled, 0)))
    return F.when(d > 0, (rounded / scale).cast("double"))


def render_maf(maf) -> Column:
    """Text form of a rounded MAF as a Python float prints it (``NA`` if NULL).

    ``0.5`` -> ``0.5``, ``0`` -> ``0.0``, ``3e-05`` below 1e-4.
    """
    maf = _c(maf)
    fixed = F.regexp_replace(maf.cast(f"decimal(10,{MAF_DIGITS})").cast("string"), "0+$", "")
    fixed = F.when(fixed.endswith("."), F.concat(fixed, F.lit("0"))).otherwise(fixed)
    tiny = F.concat(F.bround(maf * 1e5, 0).cast("int").cast("string"), F.lit("e-05"))
    return (F.when(maf.isNull(), F.lit("NA"))
            .when((maf > 0) & (maf < 1e-4), tiny)
            .otherwise(fixed))


def reformat_varid(varid, suffix: str = BUILD_SUFFIX, idempotent: bool = False) -> Column:
    """Strip one leading ``chr`` (case-sensitive) and append the build suffix.

    With ``idempotent=False`` (default, the upstream behaviour) a second
    application appends the suffix again.
    """
    varid = _c(varid)
    out = F.concat(F.regexp_replace(varid, "^chr", ""), F.lit(suffix))
    if idempotent:
        out = F.when(varid.endswith(suffix), varid).otherwise(out)
    return out


def clean_chromosome(chrom) -> Column:
    """Remove every ``chr`` substring (not only a leading one)."""
    return F.replace(_c(chrom), F.lit("chr"), F.lit(""))


def natural_chromosome_order(chrom) -> list[Column]:
    """Sort keys: numeric names as integers first, then the rest by name."""
    chrom = _c(chrom)
    return [chrom.try_cast("int").asc_nulls_last(), chrom.asc()]
