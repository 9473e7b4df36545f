"""DuckDB twins of the reader and model-table queries."""

from __future__ import annotations

from twasprep.plans.readers import CHECKED_ROWS, HEAD, MODEL_TYPES
from twasprep.schemas import RENAMED_SUFFIX

_PRED = f"""
WITH c AS (SELECT *, 'G' || (c_custkey % 50) AS gene FROM customer),
r AS (
  SELECT 'A.b' AS sample_id, CAST(c_custkey + 1 AS BIGINT) AS line_no,
         'gene_name,neurons{RENAMED_SUFFIX},note' AS header,
         gene || ',' || c_custkey || ',n' AS value, gene, 'neurons' AS t1, CAST(c_custkey AS VARCHAR) AS v1,
         NULL AS t2, NULL AS v2
  FROM c WHERE c_custkey % 3 = 0 UNION ALL
  SELECT 'B', c_custkey + 1, 'gene_name,segment,opc{RENAMED_SUFFIX},neurons{RENAMED_SUFFIX}',
         gene || ',' || c_mktsegment || ',' || c_custkey || ',' || CASE WHEN c_custkey % 4 = 0 THEN '' ELSE '2' END,
         gene, 'opc', CAST(c_custkey AS VARCHAR), 'neurons', CASE WHEN c_custkey % 4 = 0 THEN '' ELSE '2' END
  FROM c WHERE c_custkey % 3 = 1 UNION ALL
  SELECT 'C', c_custkey + 1, 'id,neurons{RENAMED_SUFFIX}', gene || ',' || c_custkey, gene, 'neurons',
         CAST(c_custkey AS VARCHAR), NULL, NULL
  FROM c WHERE c_custkey % 3 = 2)
"""


def _checks(look: str) -> str:
    return f"""
WITH a AS (SELECT c_custkey AS k, c_custkey % 10 AS g, c_custkey % 9 = 0 AS word,
                  row_number() OVER (ORDER BY c_custkey) AS rn FROM customer),
s AS (SELECT *, {look} AS looked FROM a),
d AS (SELECT g, count(*) AS n FROM s WHERE looked GROUP BY g)
SELECT 'neurons' AS cell_type, CAST(2 AS BIGINT) AS n_samples, CAST(count(*) AS BIGINT) AS n_genes,
       true AS has_gene_name, true AS all_numeric, true AS no_duplicate_columns,
       true AS no_missing_genes, true AS no_duplicate_genes FROM s
UNION ALL
SELECT 'opc', 2, count(*), true, count_if(looked AND word) = 0, false, true,
       (SELECT max(n) FROM d) <= 1 FROM s
UNION ALL SELECT 'ast', 0, 0, false, false, false, false, false"""


_TYPES = ", ".join(f"({k}, '{t}')" for k, t in enumerate(MODEL_TYPES))


def _dense(z_ctes: str, sigmoid: bool) -> str:
    y = "sum(h * w) + 0.25::DOUBLE"
    y = f"1.0::DOUBLE / (1.0::DOUBLE + exp(-({y})))" if sigmoid else y
    return z_ctes + f""",
w AS (SELECT vec_id % 7 AS g, i, avg(CAST(embedding[i + 1] AS DOUBLE)) AS x
      FROM (SELECT vec_id, embedding, unnest(range(len(embedding))) AS i FROM embeddings) GROUP BY 1, 2),
hid AS (SELECT z.sample_id, z.gene_name, w.g // 2 AS k, w.g % 2 AS u,
               greatest(sum(z.z * w.x) + CASE WHEN w.g % 2 = 0 THEN 0.1::DOUBLE ELSE -0.1::DOUBLE END, 0.0::DOUBLE) AS h
        FROM z JOIN w ON z.i = w.i AND w.g < 6 GROUP BY 1, 2, w.g),
o AS (SELECT i AS u, x AS w FROM w WHERE g = 6 AND i < 2)
SELECT sample_id, gene_name, ct.cell_type, round({y}, 6) + 0.0 AS prediction
FROM hid JOIN o USING (u) JOIN (VALUES {_TYPES}) ct(k, cell_type) ON ct.k = hid.k
GROUP BY 1, 2, 3"""


def reader_sql(z_ctes: str) -> dict[str, str]:
    """``z_ctes``: the WITH clause that ends in ``z(sample_id, gene_name, i, z)``."""
    return {
        "snp_annotation_scan": """
SELECT CAST(p_partkey % 22 + 1 AS VARCHAR) AS chromosome, CAST(p_partkey * 10 AS BIGINT) AS pos,
       'v' || p_partkey AS varID, 'A' AS ref_vcf, 'C' AS alt_vcf,
       CASE WHEN p_partkey % 3 < 2 THEN 0.9::DOUBLE END AS R2,
       CASE WHEN p_partkey % 5 > 1 THEN 0.25::DOUBLE END AS MAF,
       CASE WHEN p_partkey % 3 = 1 THEN '.' ELSE 'rs' || p_partkey END AS rsid,
       '.' AS rsid_dbSNP150
FROM part""",
        "rename_rows": _PRED + "SELECT sample_id, line_no, header, value FROM r",
        "prediction_csv_scan": _PRED + """
SELECT sample_id, gene AS gene_name, t1 AS cell_type, TRY_CAST(v1 AS DOUBLE) AS prediction, line_no AS ord FROM r
UNION ALL
SELECT sample_id, gene, t2, TRY_CAST(v2 AS DOUBLE), line_no FROM r WHERE t2 IS NOT NULL""",
        "gene_annotation_scan": """
SELECT n_name AS gene_name, 'ENSG' || n_nationkey AS ensembl_id, CAST(n_nationkey + 1 AS BIGINT) AS ord
FROM nation WHERE n_regionkey <> 4""",
        "dbsnp_scan": """
SELECT CAST(p_partkey % 22 + 1 AS VARCHAR) AS chrom, CAST(p_partkey * 10 AS BIGINT) AS pos,
       'rs' || p_partkey AS rsid, 'A' AS ref, 'C,G' AS alt, CAST(p_partkey + 1 AS BIGINT) AS ord
FROM part WHERE p_partkey % 13 <> 0 AND p_partkey % 11 <> 0""",
        "feature_csv_scan": """
WITH v AS (SELECT vec_id AS v, CASE WHEN vec_id % 5 = 0 THEN -1.0 ELSE vec_id % 7 END AS mid FROM embeddings),
x AS (SELECT v, 0 AS idx, CASE WHEN v % 3 = 2 THEN 0.5 ELSE v END AS value FROM v UNION ALL
      SELECT v, 1, mid FROM v UNION ALL
      SELECT v, 2, CASE WHEN v % 3 = 2 THEN v ELSE 0.5 END FROM v)
SELECT 'S' || (v % 3) AS sample_id, 'g' || v AS gene_name,
       CASE WHEN v % 3 < 2 THEN 'chr' || (v % 22) END AS chromo,
       CAST(idx AS INTEGER) AS idx, CAST(value AS DOUBLE) AS value FROM x""",
        "feature_csv_positional": """
WITH v AS (SELECT vec_id AS v, CASE WHEN vec_id % 5 = 0 THEN -1.0 ELSE vec_id % 7 END AS mid FROM embeddings),
x AS (SELECT v, 0 AS idx, CASE WHEN v % 3 = 2 THEN 0.5 ELSE v END AS value FROM v UNION ALL
      SELECT v, 1, mid FROM v UNION ALL
      SELECT v, 2, CASE WHEN v % 3 = 2 THEN v ELSE 0.5 END FROM v)
SELECT 'S' || (v % 3) AS sample_id, 'g' || v AS gene_name,
       CASE WHEN v % 3 < 2 THEN 'chr' || (v % 22) END AS chromo,
       CAST(idx AS INTEGER) AS idx, CAST(value AS DOUBLE) AS value FROM x""",
        "sample_list_scan": """
SELECT CAST(row_number() OVER (ORDER BY s_suppkey) - 1 AS INTEGER) AS ord, s_name AS sample_id
FROM supplier WHERE s_suppkey % 7 <> 0""",
        "gene_windows_scan": """
WITH regions AS (SELECT DISTINCT vec_id // 4 AS r, 'chr' || (vec_id // 4 % 22 + 1) || '_' || (vec_id // 4) AS region
                 FROM embeddings)
SELECT 'G' || (r // 5) AS gene_name, region FROM regions
UNION ALL SELECT 'H' || ((r + 2) // 5), region FROM regions
UNION ALL SELECT 'GNONE', unnest(['chr0_none', 'chr0_gone'])""",
        "discovered_chromosomes": """
SELECT chromosome, CAST(row_number() OVER (ORDER BY CAST(chromosome AS INTEGER)) AS INTEGER) AS chrom_rank
FROM (SELECT DISTINCT CAST(p_partkey % 22 + 1 AS VARCHAR) AS chromosome FROM part)""",
        "head_variants": f"""
SELECT 'chr' || (p_partkey % 22 + 1) || '_' || (p_partkey * 10) || '_'
         || substr('ACGT', CAST(p_partkey % 4 + 1 AS INT), 1) || '_'
         || substr('CGTA', CAST(p_partkey % 4 + 1 AS INT), 1) AS varid,
       'chr' || (p_partkey % 22 + 1) AS chrom, CAST(p_partkey * 10 AS BIGINT) AS pos,
       substr('ACGT', CAST(p_partkey % 4 + 1 AS INT), 1) AS ref,
       substr('CGTA', CAST(p_partkey % 4 + 1 AS INT), 1) AS alt
FROM part ORDER BY p_partkey LIMIT {HEAD}""",
        "concat_tables": """
SELECT 'G' || c_custkey AS gene_name, CASE WHEN c_custkey % 3 <> 1 THEN c_custkey END AS neurons_predicted,
       CASE c_custkey % 3 WHEN 1 THEN c_custkey * 2 WHEN 2 THEN -c_custkey END AS opc_predicted
FROM customer""",
        "transform_files": """
WITH l AS (SELECT CASE c_custkey % 2 WHEN 0 THEN 'neurons' ELSE 'opc' END AS part,
                  coalesce('ENSG' || n.n_nationkey, 'GENE' || c_nationkey) || chr(9) || c_custkey || chr(9)
                  || CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_mktsegment END AS line
           FROM customer LEFT JOIN nation n ON n.n_nationkey = c_nationkey AND n.n_regionkey <> 4)
SELECT part, 'NAME' || chr(9) || 'S2' || chr(9) || 'S1' AS header, count(*) AS rows,
       CAST(sum(('0x' || substr(md5(line), 1, 7))::BIGINT) AS BIGINT) AS checksum
FROM l GROUP BY part""",
        "matrix_file_checks": _checks("true"),
        "matrix_checks_sampled": _checks(f"rn <= {CHECKED_ROWS}"),
        "predict_dense": _dense(z_ctes, False),
        "predict_sigmoid": _dense(z_ctes, True),
    }
