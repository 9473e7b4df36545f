"""Independent SQL (DuckDB dialect) for every registered query.

Each statement recomputes its query from the benchmark tables without the
library: the derived inputs are rebuilt as CTEs and the operator semantics
are written out relationally.
"""

from __future__ import annotations

from twasprep.plans.catalog import (CHROMOSOME_SELECTION, DONE_BEFORE, FAIL_AT_FIRST,
                                   GT_SAMPLE_ORDER)
from twasprep.plans.driver_views import LONG_DELETION

# Derived genotype calls and variant annotation (see driver_views.py).
_GT = """
gt AS (
  SELECT 'chr' || (l_partkey % 22 + 1) || '_' || (l_partkey * 10) || '_'
           || substr('ACGT', CAST(l_partkey % 4 + 1 AS INT), 1) || '_'
           || substr('CGTA', CAST(l_partkey % 4 + 1 AS INT), 1)          AS varid,
         'chr' || (l_partkey % 22 + 1)                                   AS chrom,
         CAST(l_partkey * 10 AS BIGINT)                                  AS pos,
         'S' || lpad(CAST(l_suppkey % 8 AS VARCHAR), 2, '0')             AS sample_id,
         min(CASE WHEN l_linenumber = 7 THEN './.'
                  WHEN l_returnflag = 'N' THEN '0|0'
                  WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN '0|1'
                  WHEN l_returnflag = 'A' THEN '1|0'
                  ELSE '1|1' END)                                        AS gt
  FROM lineitem GROUP BY 1, 2, 3, 4
),
dos AS (
  SELECT *, CAST(CASE gt WHEN '0|0' THEN 0 WHEN '0|1' THEN 1 WHEN '1|0' THEN 1
                         WHEN '1|1' THEN 2 END AS TINYINT) AS dosage
  FROM gt
)"""

_ANN = """
ann AS (
  SELECT 'chr' || (p_partkey % 22 + 1) || '_' || (p_partkey * 10) || '_'
           || substr('ACGT', CAST(p_partkey % 4 + 1 AS INT), 1) || '_'
           || substr('CGTA', CAST(p_partkey % 4 + 1 AS INT), 1)          AS varid,
         'chr' || (p_partkey % 22 + 1)                                   AS chrom,
         CAST(p_partkey * 10 AS BIGINT)                                  AS pos,
         substr('ACGT', CAST(p_partkey % 4 + 1 AS INT), 1)               AS ref,
         substr('CGTA', CAST(p_partkey % 4 + 1 AS INT), 1)               AS alt
  FROM part
)"""

_COUNTS = """
counts AS (
  SELECT varid, CAST(coalesce(sum(dosage), 0) AS BIGINT) AS alt_count,
         CAST(2 * count(dosage) AS BIGINT) AS total_alleles
  FROM dos GROUP BY varid
),
maf AS (
  SELECT varid,
         CASE WHEN total_alleles > 0 THEN
           round(CASE WHEN alt_count / total_alleles > 0.5 THEN 1 - alt_count / total_alleles
                      ELSE alt_count / total_alleles END, 5) END AS MAF
  FROM counts
),
snp AS (
  SELECT replace(a.chrom, 'chr', '') AS chromosome, a.pos, a.varid AS varID,
         a.ref AS ref_vcf, a.alt AS alt_vcf, CAST(1.0 AS DOUBLE) AS R2,
         CAST(m.MAF AS DOUBLE) AS MAF, '.' AS rsid, '.' AS rsid_dbSNP150
  FROM ann a LEFT JOIN maf m ON a.varid = m.varid
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") for c in ctes) + "\n"


def _pivot_cols(values, value_col: str, key_col: str = "sample_id") -> str:
    return ",\n  ".join(
        f"max(CASE WHEN {key_col} = '{v}' THEN {value_col} END) AS \"{v}\"" for v in values)


_chrom_list = ", ".join(f"'{c}'" for c in CHROMOSOME_SELECTION.split(","))

ORACLE_SQL: dict[str, str] = {
    "dosage": _with(_GT) + "SELECT varid, chrom, pos, sample_id, gt, dosage FROM dos",
    "dosage_matrix": _with(_GT) + "SELECT varid,\n  "
    + _pivot_cols(GT_SAMPLE_ORDER, "dosage") + "\nFROM dos GROUP BY varid",
    "varid_reformat": _with(_ANN) + """
SELECT varid,
       regexp_replace(varid, '^chr', '') || '_GRCh38' AS varid_build,
       regexp_replace(regexp_replace(varid, '^chr', '') || '_GRCh38', '^chr', '') || '_GRCh38'
         AS varid_twice,
       regexp_replace(varid, '^chr', '') || '_GRCh38' AS varid_idempotent,
       replace(chrom, 'chr', '') AS chromosome
FROM ann""",
    "allele_counts": _with(_GT, _COUNTS.split("maf AS")[0].rstrip().rstrip(","))
    + "SELECT varid, alt_count, total_alleles FROM counts",
    "maf_annotation": _with(_GT, _ANN, _COUNTS) + "SELECT * FROM snp",
    "chromosome_order": _with(_GT, _ANN, _COUNTS) + """
SELECT chromosome,
       CAST(row_number() OVER (ORDER BY TRY_CAST(chromosome AS INTEGER) NULLS LAST,
                                        chromosome) AS INTEGER) AS chrom_rank
FROM (SELECT DISTINCT chromosome FROM snp) d""",
    "chromosome_filter": _with(_GT, _ANN, _COUNTS)
    + f"SELECT * FROM snp WHERE chromosome IN ({_chrom_list})",
}

# --- rsid resolution -------------------------------------------------------
_PV = """
pv AS (
  SELECT p_partkey AS pk, p_size AS ps, CAST(p_partkey % 22 + 1 AS VARCHAR) AS bare,
         CAST(p_partkey * 10 AS BIGINT) AS vpos,
         substr('ACGT', CAST(p_partkey % 4 + 1 AS INT), 1) AS ref,
         substr('CGTA', CAST(p_partkey % 4 + 1 AS INT), 1) AS alt
  FROM part
),
snp_in AS (
  SELECT bare AS chromosome,
         CASE WHEN pk % 89 = 0 THEN NULL ELSE vpos END AS pos,
         'chr' || bare || '_' || vpos || '_' || ref || '_'
           || (CASE WHEN pk % 13 = 0 THEN alt || ',' || ref ELSE alt END) AS varID,
         ref AS ref_vcf,
         CASE WHEN pk % 13 = 0 THEN alt || ',' || ref ELSE alt END AS alt_vcf,
         CAST(1.0 AS DOUBLE) AS R2, CAST(NULL AS DOUBLE) AS MAF,
         CASE WHEN pk % 97 = 0 THEN NULL WHEN pk % 10 = 0 THEN 'rsKNOWN' || pk ELSE '.' END
           AS rsid,
         CASE WHEN pk % 7 = 0 THEN 'rsOLD' || pk ELSE '.' END AS rsid_dbSNP150
  FROM pv
),
db AS (
  SELECT CASE WHEN ps % 3 = 0 THEN 'chr' || bare ELSE bare END AS chrom, vpos AS pos,
         'rs' || (pk * 3 + 1) AS rsid, ref,
         CASE ps % 4 WHEN 0 THEN alt WHEN 1 THEN 'N,' || alt WHEN 2 THEN alt || ',N'
              ELSE 'N' END AS alt,
         pk * 3 + 1 AS ord
  FROM pv
  UNION ALL
  SELECT 'chr' || bare, vpos, 'rs' || (pk * 3 + 2), ref, alt, pk * 3 + 2 FROM pv WHERE ps % 5 = 0
  UNION ALL
  SELECT bare, vpos - 2, 'rs' || (pk * 3), 'ACG', 'A', pk * 3 FROM pv WHERE ps % 7 = 0
),
dbn AS (
  SELECT CASE WHEN starts_with(chrom, 'chr') THEN substr(chrom, 4) ELSE chrom END AS chrom_key,
         CASE WHEN starts_with(chrom, 'chr') THEN 1 ELSE 0 END AS naming,
         pos, rsid, ref, alt AS alt_raw, ord
  FROM db
),
cand AS (
  SELECT chrom_key, naming, pos, ref, rsid, ord,
         unnest(list_distinct(list_append(string_split(alt_raw, ','), alt_raw))) AS match_alt
  FROM dbn
),
best AS (
  SELECT chrom_key, pos, ref, match_alt,
         arg_min(rsid, ord) FILTER (WHERE naming = 0) AS rsid_bare,
         arg_min(rsid, ord) FILTER (WHERE naming = 1) AS rsid_chr
  FROM cand GROUP BY chrom_key, pos, ref, match_alt
),
cov AS (
  SELECT chrom_key, naming, rsid, ord, pos + g AS q
  FROM (SELECT *, unnest(range(0, greatest(length(ref), 1))) AS g FROM dbn) x
),
bare_hit AS (SELECT DISTINCT chrom_key, q FROM cov WHERE naming = 0),
res AS (
  SELECT s.*, b.rsid_bare, b.rsid_chr, h.q IS NOT NULL AS bare_seen
  FROM snp_in s
  LEFT JOIN best b ON s.rsid = '.' AND replace(s.chromosome, 'chr', '') = b.chrom_key
       AND s.pos = b.pos AND s.ref_vcf = b.ref AND s.alt_vcf = b.match_alt
  LEFT JOIN bare_hit h ON s.rsid = '.' AND replace(s.chromosome, 'chr', '') = h.chrom_key
       AND s.pos = h.q
)"""

_STRICT = "CASE WHEN bare_seen THEN rsid_bare ELSE rsid_chr END"
_NORMAL = "coalesce(rsid_bare, rsid_chr)"


def _resolved_select(resolved: str) -> str:
    return f"""
SELECT chromosome, pos, varID, ref_vcf, alt_vcf, R2, MAF,
       CASE WHEN rsid = '.' AND ({resolved}) IS NOT NULL THEN ({resolved}) ELSE rsid END AS rsid,
       CASE WHEN rsid = '.' AND ({resolved}) IS NOT NULL THEN ({resolved}) ELSE rsid_dbSNP150 END
         AS rsid_dbSNP150
FROM res"""


_LEGACY = f"coalesce(nullif(rsid_dbSNP150, '.'), {_STRICT})"

ORACLE_SQL.update({
    "rsid_resolve": _with(_PV) + _resolved_select(_STRICT),
    "rsid_resolve_normalized": _with(_PV) + _resolved_select(_NORMAL),
    "rsid_bucketed": _with(_PV) + _resolved_select(_STRICT),
    "rsid_legacy_fill": _with(_PV) + f"""
SELECT chromosome, pos, varID, ref_vcf, alt_vcf, R2, MAF,
       CASE WHEN rsid = '.' AND {_LEGACY} IS NOT NULL THEN {_LEGACY} ELSE rsid END AS rsid,
       rsid_dbSNP150
FROM res""",
    "rsid_stats": _with(_PV) + f"""
SELECT chromosome, CAST(count(*) AS BIGINT) AS total,
       CAST(count_if(rsid = '.' AND ({_STRICT}) IS NOT NULL) AS BIGINT) AS found,
       round(CAST(count_if(rsid = '.' AND ({_STRICT}) IS NOT NULL) AS DOUBLE) * 100.0
             / CAST(count(*) AS DOUBLE), 6) AS pct
FROM res GROUP BY chromosome""",
    "rsid_naming_report": _with(_PV) + """,
v AS (SELECT varID, replace(chromosome, 'chr', '') AS ck, pos FROM snp_in WHERE pos IS NOT NULL),
hits AS (SELECT v.varID, c.naming, c.rsid, c.ord FROM v JOIN cov c ON v.ck = c.chrom_key AND v.pos = c.q),
counts AS (SELECT varID, CAST(count_if(naming = 0) AS BIGINT) AS bare_hits,
                  CAST(count_if(naming = 1) AS BIGINT) AS chr_hits FROM hits GROUP BY varID),
ranked AS (SELECT varID, naming, rsid,
                  row_number() OVER (PARTITION BY varID, naming ORDER BY ord) AS rn FROM hits),
used AS (SELECT varID, CASE WHEN bare_hits > 0 THEN 0 WHEN chr_hits > 0 THEN 1 END AS naming
         FROM counts),
shown AS (SELECT r.varID, CASE WHEN r.naming = 0 THEN 'bare' ELSE 'chr' END AS used_naming,
                 string_agg(r.rsid, ',' ORDER BY r.rn) AS first_hits
          FROM ranked r JOIN used u ON r.varID = u.varID AND r.naming = u.naming
          WHERE r.rn <= 3 GROUP BY r.varID, r.naming)
SELECT v.varID, CAST(coalesce(bare_hits, 0) AS BIGINT) AS bare_hits,
       CAST(coalesce(chr_hits, 0) AS BIGINT) AS chr_hits, used_naming, first_hits
FROM v LEFT JOIN counts USING (varID) LEFT JOIN shown USING (varID)""",
    "rsid_overlap": _with(_PV) + f""",
span AS (SELECT chrom_key, pos AS a, pos + greatest(length(ref), 1) - 1 AS b, rsid, ord FROM dbn
         UNION ALL
         SELECT bare, vpos, vpos + {LONG_DELETION} - 1, 'rsL' || pk, pk * 3 - 1 FROM pv WHERE ps = 49),
hit AS (SELECT s.varID, count(*) AS hits, arg_min(d.rsid, d.ord) AS first_rsid, max(d.b - d.a + 1) AS longest
        FROM snp_in s JOIN span d ON replace(s.chromosome, 'chr', '') = d.chrom_key
             AND s.pos BETWEEN d.a AND d.b GROUP BY s.varID)
SELECT varID, CAST(coalesce(hits, 0) AS BIGINT) AS hits, first_rsid,
       CAST(coalesce(longest, 0) AS BIGINT) AS longest
FROM snp_in LEFT JOIN hit USING (varID)""",
})

# --- features --------------------------------------------------------------
# Rounded outputs add 0.0: DuckDB's round keeps the sign of a value that
# rounds to zero (-0.0), Spark's decimal rounding returns 0.0; x + 0.0 is x
# for every other value.
from twasprep.plans.catalog import CHUNK_ROWS, VALUE_DIGITS  # noqa: E402

_FEAT = f"""
f AS (
  SELECT 'S' || (vec_id % 4) AS sample_id, vec_id // 4 AS r,
         'chr' || (vec_id // 4 % 22 + 1) || '_' || (vec_id // 4) AS region, embedding
  FROM embeddings
),
regions AS (SELECT DISTINCT r, region FROM f),
win AS (
  SELECT 'G' || (r // 5) AS gene_name,
         string_agg(region, '|' ORDER BY region) || '|' || min(region) AS region_names
  FROM regions GROUP BY 1
  UNION ALL
  SELECT 'H' || ((r + 2) // 5), string_agg(region, '|' ORDER BY region) || '|' || min(region)
  FROM regions GROUP BY 1
  UNION ALL SELECT 'GNULL', NULL
  UNION ALL SELECT 'GEMPTY', ''
  UNION ALL SELECT 'GNONE', 'chr0_none|chr0_gone'
),
pairs AS (
  SELECT DISTINCT gene_name, unnest(string_split(region_names, '|')) AS region
  FROM win WHERE region_names IS NOT NULL AND region_names <> ''
),
fx AS (
  SELECT sample_id, r, r // {CHUNK_ROWS} AS chunk, region, unnest(embedding) AS x,
         unnest(range(len(embedding))) AS i
  FROM f
),
gx AS (
  SELECT fx.sample_id, fx.chunk, p.gene_name, fx.i, avg(CAST(fx.x AS DOUBLE)) AS m
  FROM fx JOIN pairs p ON fx.region = p.region
  GROUP BY fx.sample_id, fx.chunk, p.gene_name, fx.i
)"""

ORACLE_SQL.update({
    "bin_means": f"""
WITH e AS (
  SELECT vec_id // 4 AS r, unnest(embedding) AS x, unnest(range(len(embedding))) AS i
  FROM embeddings
)
SELECT 'S' || (r % 3) AS sample_id, 'chr' || (r % 22 + 1) || '_' || r AS region,
       'chr' || (r % 22 + 1) AS chromo, CAST(i AS INTEGER) AS idx,
       round(avg(CAST(x AS DOUBLE)), {VALUE_DIGITS}) + 0.0 AS value
FROM e GROUP BY r, i""",
    "gene_region_means": _with(_FEAT) + f"""
SELECT fx.sample_id, p.gene_name, CAST(fx.i AS INTEGER) AS idx,
       round(avg(CAST(fx.x AS DOUBLE)), {VALUE_DIGITS}) + 0.0 AS value
FROM fx JOIN pairs p ON fx.region = p.region
GROUP BY fx.sample_id, p.gene_name, fx.i""",
    "gene_region_means_chunked": _with(_FEAT) + f"""
SELECT sample_id, CAST(chunk AS BIGINT) AS chunk, gene_name, CAST(i AS INTEGER) AS idx,
       round(m, {VALUE_DIGITS}) + 0.0 AS value
FROM gx""",
    "chunked_from_files": _with(_FEAT) + f"""
SELECT sample_id, CAST(chunk AS BIGINT) AS chunk, gene_name, CAST(i AS INTEGER) AS idx,
       round(m, {VALUE_DIGITS}) + 0.0 AS value
FROM gx""",
    "first_chunk_means": _with(_FEAT) + f"""
SELECT g.sample_id, g.gene_name, CAST(g.i AS INTEGER) AS idx, round(g.m, {VALUE_DIGITS}) + 0.0 AS value
FROM gx g
JOIN (SELECT sample_id, gene_name, min(chunk) AS c FROM gx GROUP BY 1, 2) fc
  ON g.sample_id = fc.sample_id AND g.gene_name = fc.gene_name AND g.chunk = fc.c""",
})

# --- prediction ------------------------------------------------------------
from twasprep.plans.driver_views import EVENT_CELL_TYPES, EVENT_SAMPLES  # noqa: E402
from twasprep.schemas import CELL_TYPES  # noqa: E402

_Z = f"""
x AS (
  SELECT 'L' || label AS sample_id, 'g' || (vec_id // 3) AS gene_name, vec_id AS ord, embedding
  FROM embeddings
),
fr AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sample_id, gene_name ORDER BY ord)
                   AS rn FROM x) t WHERE rn = 1
),
ux AS (
  SELECT sample_id, gene_name, unnest(embedding) AS v, unnest(range(len(embedding))) AS i FROM fr
),
st AS (
  SELECT sample_id, i, avg(CAST(v AS DOUBLE)) AS mu,
         CASE WHEN count(*) > 1 THEN stddev_samp(CAST(v AS DOUBLE)) ELSE 'NaN'::DOUBLE END AS sd
  FROM ux GROUP BY sample_id, i
),
z AS (
  SELECT ux.sample_id, ux.gene_name, ux.i, (CAST(ux.v AS DOUBLE) - st.mu) / (st.sd + 1e-8) AS z
  FROM ux JOIN st ON ux.sample_id = st.sample_id AND ux.i = st.i
)"""

_CT_VALUES = ", ".join(f"({k}, '{ct}')" for k, ct in enumerate(CELL_TYPES))
_OCCURRING = [c for c in EVENT_CELL_TYPES if c != "refund"]
_WIDE = "w AS (\n  SELECT 'S' || (event_id % 6) AS sample_id, 'g' || user_id AS gene_name,\n  " + \
    ",\n  ".join(f"arg_max(value, event_id) FILTER (WHERE event_type = '{ct}') AS {ct}_predicted"
                 for ct in _OCCURRING) + "\n  FROM events GROUP BY 1, 2\n)"
_LONG = "lg AS (\n" + "\n  UNION ALL\n".join(
    f"  SELECT sample_id, gene_name, '{ct}' AS cell_type, {ct}_predicted AS prediction FROM w"
    for ct in _OCCURRING) + "\n)"
_MAT = "mat AS (\n  SELECT cell_type, gene_name,\n  " + _pivot_cols(EVENT_SAMPLES, "prediction") \
    + "\n  FROM lg GROUP BY cell_type, gene_name\n)"
_NULL_ANY = " OR ".join(f'"{s}" IS NULL' for s in EVENT_SAMPLES)

_PER_TYPE = [
    f"(SELECT 'g' || user_id AS gene_name, arg_max(value, event_id) AS "
    f"{ct}_mean_expression_predicted_expression FROM events WHERE event_type = '{ct}' GROUP BY 1) "
    f"t{k}" for k, ct in enumerate(_OCCURRING)]

_GENE_ANN = """
ann AS (
  SELECT 'GENE' || n_nationkey AS gene_name,
         'ENSG' || lpad(CAST(n_nationkey AS VARCHAR), 11, '0') AS ensembl_id,
         CAST(n_nationkey AS BIGINT) AS ord
  FROM nation WHERE n_regionkey <> 4
  UNION ALL
  SELECT 'GENE' || n_nationkey, 'ENSGALT' || n_nationkey, CAST(n_nationkey + 100 AS BIGINT)
  FROM nation WHERE n_regionkey = 0
),
m AS (SELECT gene_name, arg_max(ensembl_id, ord) AS ensembl_id FROM ann GROUP BY gene_name),
e AS (SELECT 'GENE' || c_nationkey AS gene_name, c_custkey AS S_key, c_acctbal AS S_acct
      FROM customer)"""

ORACLE_SQL.update({
    "keep_first": """
SELECT sample_id, gene_name, ord, value FROM (
  SELECT event_type AS sample_id, 'g' || user_id AS gene_name, event_id AS ord, value,
         row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id) AS rn
  FROM events) t
WHERE rn = 1""",
    "duplicate_report": """
SELECT event_type AS sample_id, 'g' || user_id AS gene_name, count(*) AS n_rows
FROM events GROUP BY 1, 2 HAVING count(*) > 1""",
    "feature_zscore": _with(_Z) + f"""
SELECT sample_id, gene_name, CAST(i AS INTEGER) AS idx, round(z, {VALUE_DIGITS}) + 0.0 AS value FROM z""",
    "feature_zscore_bucketed": _with(_Z) + f"""
SELECT sample_id, gene_name, CAST(i AS INTEGER) AS idx, round(z, {VALUE_DIGITS}) + 0.0 AS value FROM z""",
    "predict_expression": _with(_Z) + f""",
ct AS (SELECT * FROM (VALUES {_CT_VALUES}) t(k, cell_type))
SELECT z.sample_id, z.gene_name, ct.cell_type,
       round(sum(z.z * (CAST(((7 * z.i + 3 * ct.k) % 11) - 5 AS DOUBLE) / 10.0::DOUBLE))
             + CAST(ct.k - 5 AS DOUBLE) / 10.0::DOUBLE, {VALUE_DIGITS}) + 0.0 AS prediction
FROM z CROSS JOIN ct
GROUP BY z.sample_id, z.gene_name, ct.cell_type, ct.k""",
    "streamed_scores": _with(_Z) + f""",
ct AS (SELECT * FROM (VALUES {_CT_VALUES}) t(k, cell_type))
SELECT z.sample_id, z.gene_name, ct.cell_type,
       round(sum(z.z * (CAST(((7 * z.i + 3 * ct.k) % 11) - 5 AS DOUBLE) / 10.0::DOUBLE))
             + CAST(ct.k - 5 AS DOUBLE) / 10.0::DOUBLE, {VALUE_DIGITS}) + 0.0 AS prediction
FROM z CROSS JOIN ct
GROUP BY z.sample_id, z.gene_name, ct.cell_type, ct.k""",
    "row_conservation": f"""
SELECT 'L' || label AS sample_id, count(DISTINCT vec_id // 3) AS genes,
       count(DISTINCT vec_id // 3) * {len(CELL_TYPES)} AS predictions, true AS conserved
FROM embeddings GROUP BY label""",
    "predictions_long": _with(_WIDE, _LONG) + "SELECT * FROM lg",
    "cell_type_matrix": _with(_WIDE, _LONG, _MAT) + "SELECT * FROM mat",
    "matrix_checks": _with(_WIDE, _LONG, _MAT) + f"""
SELECT cell_type, CAST({len(EVENT_SAMPLES)} AS BIGINT) AS n_samples,
       CAST(count(*) AS BIGINT) AS n_genes, true AS has_gene_name,
       count_if({_NULL_ANY}) = 0 AS all_numeric, true AS no_duplicate_columns,
       count_if(gene_name IS NULL) = 0 AS no_missing_genes,
       count(DISTINCT gene_name) = count(gene_name) AS no_duplicate_genes
FROM mat GROUP BY cell_type""",
    "combine_predictions": "SELECT * FROM " + _PER_TYPE[0] + "".join(
        f"\nJOIN {t} USING (gene_name)" for t in _PER_TYPE[1:]),
    "rename_columns": """
SELECT c_name AS gene_name, c_acctbal AS pericytes_predicted,
       CAST(c_custkey AS DOUBLE) AS neurons_predicted, c_mktsegment AS segment
FROM customer""",
    "gene_id_map": _with(_GENE_ANN) + """
SELECT coalesce(m.ensembl_id, e.gene_name) AS NAME, e.S_key, e.S_acct
FROM e LEFT JOIN m ON e.gene_name = m.gene_name""",
    "unmapped_genes": _with(_GENE_ANN) + """
SELECT DISTINCT e.gene_name FROM e
WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.gene_name = e.gene_name)""",
    "bundle_report": _with(_GENE_ANN) + """,
va AS (SELECT CAST(p_partkey * 10 AS BIGINT) AS pos, 'v' || p_partkey AS k FROM part),
s AS (
  SELECT 'gene' AS kind, ensembl_id AS k, 1 AS a, 0 AS b FROM ann UNION ALL
  SELECT 'gene', coalesce(m.ensembl_id, e.gene_name), 0, 1 FROM e LEFT JOIN m ON e.gene_name = m.gene_name
  UNION ALL SELECT 'variant', k, 1, 0 FROM va WHERE pos % 70 <> 0
  UNION ALL SELECT 'variant', k, 0, 1 FROM va WHERE pos % 110 <> 0
  UNION ALL SELECT 'variant', k, 0, 1 FROM va WHERE pos % 130 = 0),
per AS (SELECT kind, k, sum(a) AS a, sum(b) AS b FROM s GROUP BY 1, 2),
c AS (SELECT kind, sum(a) AS ra, sum(b) AS rb, count_if(a > 0) AS ka, count_if(b > 0) AS kb,
             count_if(a > 1) AS pa, count_if(b > 1) AS pb, count_if(a > 0 AND b = 0) AS oa,
             count_if(a = 0 AND b > 0) AS ob FROM per GROUP BY kind),
n AS (SELECT *, CASE kind WHEN 'gene' THEN 'gene_annotation' ELSE 'snp_annotation' END AS ta,
             CASE kind WHEN 'gene' THEN 'expression' ELSE 'genotype' END AS tb FROM c),
i AS (SELECT unnest([
  {'item': ta || '_rows', 'value': ra}, {'item': tb || '_rows', 'value': rb},
  {'item': ta || '_keys', 'value': ka}, {'item': tb || '_keys', 'value': kb},
  {'item': ta || '_repeated_keys', 'value': pa}, {'item': tb || '_repeated_keys', 'value': pb},
  {'item': ta || '_keys_not_in_' || tb, 'value': oa}, {'item': tb || '_keys_not_in_' || ta, 'value': ob}]) AS x
  FROM n)
SELECT x.item AS item, CAST(x.value AS BIGINT) AS value FROM i""",
    "pending_outputs": """
SELECT CAST(o_orderkey AS VARCHAR) AS key FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l
                  WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'N')""",
    "stage_attempts": f"""
SELECT p_brand AS key, CAST(1 AS BIGINT) AS done,
       CAST(CASE WHEN p_brand = '{FAIL_AT_FIRST}' THEN 1 ELSE 0 END AS BIGINT) AS failed,
       CAST(CASE WHEN p_brand IN {DONE_BEFORE} THEN 0 ELSE count(*) END AS BIGINT) AS rows
FROM part GROUP BY p_brand""",
    "job_summary": """
WITH per AS (
  SELECT l_orderkey, bool_or(l_returnflag = 'N') AS ok,
         sum(CASE WHEN l_returnflag = 'N' THEN l_linenumber END) AS r
  FROM lineitem GROUP BY l_orderkey
),
j AS (
  SELECT CASE WHEN per.ok THEN 'success' WHEN per.ok IS NOT NULL THEN 'failed'
              ELSE 'pending' END AS status, per.r
  FROM orders o LEFT JOIN per ON o.o_orderkey = per.l_orderkey
)
SELECT status, CAST(count(*) AS BIGINT) AS inputs, CAST(coalesce(sum(r), 0) AS BIGINT) AS "rows"
FROM j GROUP BY status""",
})

# --- text round trips --------------------------------------------------------
_SAMPLE_VALUES = ", ".join(f"('{s}')" for s in GT_SAMPLE_ORDER)
ORACLE_SQL.update({
    "vcf_dosages": _with(_GT) + f"""
SELECT v.varid, s.sample_id, d.dosage
FROM (SELECT DISTINCT varid FROM gt) v
CROSS JOIN (VALUES {_SAMPLE_VALUES}) s(sample_id)
LEFT JOIN dos d ON d.varid = v.varid AND d.sample_id = s.sample_id""",
    "matrix_maf_annotation": ORACLE_SQL["maf_annotation"],
})

# --- text sinks ---------------------------------------------------------------
_DOSAGE_CELLS = " || chr(9) || ".join(
    f"coalesce(CAST(max(CASE WHEN sample_id = '{s}' THEN dosage END) AS VARCHAR), '.')"
    for s in GT_SAMPLE_ORDER)
_MATRIX_CELLS = " || ',' || ".join(
    f"coalesce(CAST(\"{s}\" AS VARCHAR), '')" for s in sorted(EVENT_SAMPLES))

ORACLE_SQL.update({
    "dosage_matrix_text": _with(_GT) + f"""
SELECT varid, varid || '\t' || {_DOSAGE_CELLS} AS value FROM dos GROUP BY varid""",
    "snp_annotation_text": _with(_GT, _ANN, _COUNTS) + """
SELECT varID,
       chromosome || '\t' || CAST(pos AS VARCHAR) || '\t' || varID || '\t' || ref_vcf || '\t'
       || alt_vcf || '\t' || '1.0' || '\t'
       || CASE WHEN MAF IS NULL THEN 'NA' ELSE CAST(MAF AS VARCHAR) END
       || '\t' || rsid || '\t' || rsid_dbSNP150 AS value
FROM snp""",
    "cell_type_matrix_text": _with(_WIDE, _LONG, _MAT) + f"""
SELECT cell_type, gene_name || ',' || {_MATRIX_CELLS} AS value FROM mat""",
    "unmapped_summary": _with(_GENE_ANN) + """,
u AS (SELECT DISTINCT e.gene_name FROM e
      WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.gene_name = e.gene_name))
SELECT CAST(count(*) AS BIGINT) AS n_unmapped,
       CASE WHEN count(*) < 10 THEN string_agg(gene_name, ',' ORDER BY gene_name)
            ELSE array_to_string(list_slice(list(gene_name ORDER BY gene_name), 1, 5), ',')
       END AS examples
FROM u""",
})

ORACLE_SQL["vcf_snp_annotation"] = _with(_GT, _ANN, _COUNTS) + """
SELECT replace(v.chrom, 'chr', '') AS chromosome, v.pos, v.varid AS varID,
       split_part(v.varid, '_', 3) AS ref_vcf, split_part(v.varid, '_', 4) AS alt_vcf,
       CAST(1.0 AS DOUBLE) AS R2, CAST(m.MAF AS DOUBLE) AS MAF, '.' AS rsid, '.' AS rsid_dbSNP150
FROM (SELECT DISTINCT varid, chrom, pos FROM gt) v JOIN maf m ON v.varid = m.varid"""

from twasprep.plans.readers_sql import reader_sql  # noqa: E402

ORACLE_SQL.update(reader_sql(_with(_Z)))

from twasprep.plans.sink_sql import sink_sql  # noqa: E402

ORACLE_SQL.update(sink_sql(_with(_ANN), _with(_PV), _STRICT, _with(_FEAT), _with(_GENE_ANN)))
