"""DuckDB twins of the sink queries: the text each sink must have written."""

from __future__ import annotations

from twasprep.plans.sink_queries import DIGITS, WIDTH
from twasprep.schemas import MODEL_OUTPUT_SUFFIX, SNP_ANNOTATION_COLUMNS


def _digest(part: str, header: str | None, cells: list[str], sep: str, source: str) -> str:
    """Digest of the lines of ``cells`` (null cells are empty) over ``source``."""
    line = f" || {sep} || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in cells)
    return f"""
SELECT part, {"CAST(NULL AS VARCHAR)" if header is None else header} AS header, count(*) AS rows,
       CAST(sum(('0x' || substr(md5(line), 1, 7))::BIGINT) AS BIGINT) AS checksum, true AS unchanged
FROM (SELECT {part} AS part, {line} AS line FROM {source}) GROUP BY part"""


def _quoted(names: list[str], sep: str) -> str:
    return f" || {sep} || ".join(f"'{n}'" for n in names)


def sink_sql(ann: str, snps: str, strict: str, feat: str, genes: str) -> dict[str, str]:
    """``ann`` .. ``genes``: the WITH clauses of the derived inputs."""
    tab, comma = "chr(9)", "','"
    numbers = [str(i) for i in range(WIDTH)]
    short = "list_transform(embedding[1:{w}], lambda x: round(x::DOUBLE * 8) + 0.0)".format(w=WIDTH)
    found = f"(rsid = '.' AND ({strict}) IS NOT NULL)"
    snp_cells = {"MAF": "''", "R2": "'1.0'",
                 "rsid": f"CASE WHEN {found} THEN ({strict}) ELSE rsid END",
                 "rsid_dbSNP150": f"CASE WHEN {found} THEN ({strict}) ELSE rsid_dbSNP150 END"}
    models = ["neurons", "opc"]
    weight = lambda k, i: f"{((7 * i + 3 * k) % 11 - 5) / 10.0!r}::DOUBLE"
    score = lambda k: (" + ".join(f"x[{i + 1}] * {weight(k, i)}" for i in range(WIDTH))
                       + f" + {(k - 5) / 10.0!r}::DOUBLE")
    return {
        "sink_variant_annotation": ann + _digest("''", None, ["varid", "chrom", "pos", "ref", "alt"], tab, "ann"),
        "sink_snp_rsids": snps + _digest(
            "chromosome", _quoted(list(SNP_ANNOTATION_COLUMNS), tab),
            [snp_cells.get(c, c) for c in SNP_ANNOTATION_COLUMNS], tab, "res"),
        "sink_region_features": feat + _digest(
            "sample_id", _quoted(["gene_name", *numbers, "chromo"], comma),
            ["region", *[f"x[{i + 1}]" for i in range(WIDTH)], "split_part(region, '_', 1)"], comma,
            f"(SELECT *, {short} AS x FROM f)"),
        "sink_gene_features": feat + _digest(
            "sample_id", _quoted(["gene_name", *numbers], comma), ["gene_name", *[f"m{i}" for i in range(WIDTH)]],
            comma, "(SELECT sample_id, gene_name, " + ", ".join(
                f"round(avg(x[{i + 1}]), {DIGITS}) + 0.0 AS m{i}" for i in range(WIDTH))
            + f" FROM (SELECT *, {short} AS x FROM f) g JOIN pairs p ON g.region = p.region GROUP BY 1, 2)"),
        "sink_predictions": _digest(
            "sample_id", _quoted(["gene_name", *[f"{m}{MODEL_OUTPUT_SUFFIX}" for m in models]], comma),
            ["gene_name", *[f"p{k}" for k in range(len(models))]], comma,
            "(SELECT sample_id, gene_name, " + ", ".join(
                f"round(max({score(k)}), {DIGITS}) + 0.0 AS p{k}" for k in range(len(models)))
            + f" FROM (SELECT 'L' || label AS sample_id, 'g' || (vec_id // 3) AS gene_name, {short} AS x"
            " FROM embeddings) GROUP BY 1, 2)"),
        "sink_predictdb": genes + _digest(
            "''", _quoted(["NAME", "S_key", "S_acct"], tab), ["coalesce(m.ensembl_id, e.gene_name)", "S_key", "S_acct"],
            tab, "e LEFT JOIN m ON e.gene_name = m.gene_name"),
    }
