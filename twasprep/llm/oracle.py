"""DuckDB twins of the training-data queries that SQL can express."""

from __future__ import annotations

import string

from twasprep.llm import covertree, merkle, mixing, quality, rtree, sharding, urls


def _hash52(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 13))::BIGINT"


_ID = "coalesce(doc_id::VARCHAR, 'null')"


def _lower(x: str) -> str:
    return f"translate({x}, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def _urls_sql() -> str:
    """Rules, edges, and the rounds of both propagations as one chain of CTEs."""
    rest = "CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END"
    part = "regexp_extract(rest, '^([^/?#]*)([^?#]*)', {})"
    link = urls.LINK.replace("'", "''")
    order = sorted(urls.RULES, key=lambda r: -len(r[0] + r[1]))
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, v)
            for h, p, v in order]
    rule = "CASE " + " ".join(f"WHEN {c} THEN '{r}'" for c, r, _ in fits) + " END"
    verdict = "CASE " + " ".join(f"WHEN {c} THEN '{v}'" for c, _, v in fits) + " END"
    d = urls.DAMPING
    rounds = ["r0 AS (SELECT kind, host, mass AS score FROM seeds)"]
    for i in range(1, urls.ROUNDS + 1):
        rounds.append(f"""r{i} AS (SELECT kind, host, sum(score) AS score FROM (
  SELECT kind, host, mass * {1.0 - d} AS score FROM seeds UNION ALL
  SELECT s.kind, s.dst, r.score * s.share * {d} FROM share s
  JOIN r{i - 1} r ON s.kind = r.kind AND s.src = r.host) GROUP BY 1, 2)""")
    return f"""
WITH a AS (SELECT page_id, html, coalesce({rest}, '') AS rest FROM pages),
b AS (SELECT page_id, html, {_lower(part.format(1))} AS host, {part.format(2)} AS path FROM a),
p AS (SELECT *, {rule} AS rule, {verdict} AS by_rule FROM b),
sd AS (SELECT DISTINCT CASE WHEN by_rule = 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host
       FROM p WHERE by_rule IS NOT NULL AND host <> ''),
seeds AS (SELECT kind, host, 1.0::DOUBLE / count(*) OVER (PARTITION BY kind) AS mass FROM sd),
x AS (SELECT host AS src, {_lower("unnest(regexp_extract_all(coalesce(html, ''), '" + link + "', 1))")} AS dst
      FROM p),
e AS (SELECT src, dst, count(*) AS n FROM x WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY 1, 2),
both_ways AS (SELECT 'trust' AS kind, src, dst, n FROM e UNION ALL SELECT 'distrust', dst, src, n FROM e),
share AS (SELECT kind, src, dst, n::DOUBLE / sum(n) OVER (PARTITION BY kind, src) AS share FROM both_ways),
{", ".join(rounds)},
w AS (SELECT count(DISTINCT host)::DOUBLE AS n_hosts FROM p),
h AS (SELECT host, round(sum(CASE WHEN kind = 'trust' THEN score ELSE 0.0 END) * any_value(n_hosts), 9) AS trust,
             abs(round(sum(CASE WHEN kind = 'distrust' THEN score ELSE 0.0 END) * any_value(n_hosts), 9))
               AS distrust
      FROM w, (SELECT * FROM r{urls.ROUNDS} UNION ALL
            SELECT kind, host, -mass * {1.0 - d} FROM seeds WHERE kind = 'distrust') GROUP BY 1),
j AS (SELECT p.page_id, p.host, p.path, p.rule, p.by_rule, coalesce(h.trust, 0.0)::DOUBLE AS trust,
             coalesce(h.distrust, 0.0)::DOUBLE AS distrust
      FROM p LEFT JOIN h ON p.host = h.host)
SELECT page_id, host, path, rule, coalesce(by_rule, CASE WHEN distrust > {urls.RATIO} * trust
       AND distrust > {urls.LEAST} THEN 'block' ELSE 'allow' END) AS verdict, trust, distrust
FROM j"""


def _crc_table() -> str:
    """The 256 entries of the reflected CRC-32 table, from its polynomial."""
    table = []
    for value in range(256):
        for _ in range(8):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    return f"({table})::BIGINT[]"


def _crc(text: str) -> str:
    """Unsigned CRC-32 of a text's UTF-8 bytes."""
    code = (f"list_transform(regexp_extract_all(hex(encode({text})), '..'), "
            "lambda h: ('0x' || h)::BIGINT)")
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {code}), lambda c, x: "
            f"xor(c >> 8, ({_crc_table()})[(xor(c, x) & 255) + 1])), 4294967295::BIGINT)")


def _md5_32(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 8))::BIGINT"


def _feistel(source: str) -> str:
    """One pass of the network over ``source(id, n, a, b, p, step)``: nested
    selects, one per round; the new image is ``r * a + l``."""
    out = f"(SELECT id, n, a, b, step, p % a AS l, p // a AS r FROM {source})"
    for i in range(sharding.ROUNDS):
        key = f"'{sharding.SEED}:{i}:' || "
        new = ((f"(l + {_md5_32(key + 'r::VARCHAR')}) % a AS l, r") if i % 2 == 0
               else f"l, (r + {_md5_32(key + 'l::VARCHAR')}) % b AS r")
        out = f"(SELECT id, n, a, b, step, {new} FROM {out})"
    return f"SELECT id, n, a, b, r * a + l AS p, step + 1 AS step FROM {out}"


def _sharding_sql() -> str:
    text = "coalesce(text, '')"
    crc = _crc(text)
    k = sharding.N_SHARDS
    return f"""
WITH RECURSIVE c AS MATERIALIZED (
  SELECT doc_id, CAST(strlen({text}) + 16 AS BIGINT) AS size, CAST({crc} AS BIGINT) AS text_crc32 FROM documents),
d AS MATERIALIZED (SELECT *, {_md5_32(f"'row:' || {_ID} || ':' || text_crc32 || ':' || size")}
                             % {sharding.BUCKETS} AS bucket FROM c),
m AS MATERIALIZED (
  SELECT doc_id, size, text_crc32, count(*) OVER () AS n, row_number() OVER (
         ORDER BY bucket, doc_id NULLS FIRST, text_crc32, size) - 1 AS id FROM d),
side AS (SELECT n, floor(sqrt(n::DOUBLE))::BIGINT AS root FROM m LIMIT 1),
grid AS (SELECT n, greatest(CASE WHEN root * root >= n THEN root ELSE root + 1 END, 1) AS a FROM side),
start AS (SELECT m.id, m.n, g.a, greatest((m.n + g.a - 1) // g.a, 1) AS b, m.id AS p, -1 AS step
          FROM m, grid g),
walk AS (SELECT * FROM ({_feistel("start")}) UNION ALL
         SELECT * FROM ({_feistel(f"(SELECT * FROM walk WHERE p >= n AND step < {sharding.WALK})")}))
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(p % {k} AS INTEGER) AS shard,
       CAST(p // {k} AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard,
       CAST(id AS BIGINT) AS row_number
FROM m JOIN (SELECT id, p FROM walk WHERE p < n) USING (id)"""


def _quality_sql() -> str:
    """Statistics, exact binomial tails and the chosen cutoffs, relationally."""
    size, blank = quality.REPEAT_WINDOW, "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    tests = [(r, c) for r, cs in quality.CUTOFFS.items() for c in cs]
    table = ", ".join(f"('{r}', {c}::DOUBLE)" for r, c in tests)
    share = lambda x, y: f"CASE WHEN {y} > 0 THEN {x}::DOUBLE / {y} ELSE 0.0 END"
    same = "CASE WHEN n_words > 0 THEN 1.0 - n_distinct::DOUBLE / n_words ELSE 0.0 END"
    values = {"symbol_share": share("n_symbols", "word_chars"),
              "dup_line_share": share("n_dup_lines", "n_lines"),
              "repeat_share": share("n_repeat_words", "n_words"),
              "upper_share": share("n_upper", "word_chars"), "sameness": same,
              "word_length": share("word_chars", "n_words")}
    rules = " UNION ALL ".join(f"SELECT id, stratum, '{r}' AS rule, {v} AS v FROM f"
                               for r, v in values.items())
    al = f"{quality.ALPHA / len(quality.CUTOFFS)!r}::DOUBLE"
    tail = (f"CASE WHEN k < n_good * {al} THEN list_sum(list_transform(range(0, (k + 1)::BIGINT), lambda i: "
            f"exp(lgamma(n_good + 1) - lgamma(i + 1) - lgamma(n_good - i + 1) + i * ln({al}) "
            f"+ (n_good - i) * ln(1.0::DOUBLE - {al})))) ELSE 1.0 END")
    return f"""
WITH t AS (SELECT row_number() OVER () AS id, doc_id, coalesce(lang, '') AS stratum,
                  coalesce(text, '') AS text FROM documents),
w AS MATERIALIZED (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws,
       list_filter(string_split(text, chr(10)), lambda x: trim(x, {blank}) <> '') AS ls FROM t),
g AS (SELECT id, i, array_to_string(ws[i:i + {size - 1}], ' ') AS words
      FROM (SELECT id, ws, unnest(range(1, len(ws) - {size - 2})) AS i FROM w)),
hit AS (SELECT id, i FROM (SELECT id, i, count(*) OVER (PARTITION BY id, words) AS n FROM g) WHERE n > 1),
rep AS (SELECT id, count(DISTINCT i + o) AS n FROM hit, range({size}) r(o) GROUP BY id),
f AS MATERIALIZED (
  SELECT w.id, doc_id, stratum, text, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, len(ls) AS n_lines,
         length(regexp_replace(text, '[^A-Z]+', '', 'g')) AS n_upper,
         len(list_distinct(ws)) AS n_distinct,
         len(ws) < {quality.MIN_WORDS} OR 100 * coalesce(rep.n, 0) > 30 * len(ws) AS base_failed
  FROM w LEFT JOIN rep ON w.id = rep.id),
v AS ({rules}),
lab AS (SELECT doc_id, min(quality::INTEGER) AS y FROM labels WHERE quality::INTEGER IN (0, 1)
        GROUP BY doc_id HAVING min(quality::INTEGER) = max(quality::INTEGER)),
y AS (SELECT min(f.id) AS id, stratum, min(y) AS y FROM f JOIN lab l ON f.doc_id = l.doc_id
      WHERE NOT base_failed GROUP BY stratum, text HAVING min(y) = max(y)),
strata AS (SELECT stratum, count_if(y = 1) AS n_good, count_if(y = 0) AS n_bad FROM y GROUP BY 1),
cuts AS (SELECT * FROM (VALUES {table}) c(rule, cutoff)),
k AS (SELECT y.stratum, c.rule, c.cutoff, count_if(y.y = 1 AND v.v > c.cutoff) AS k,
             count_if(y.y = 0 AND v.v > c.cutoff) AS hit
      FROM y JOIN v ON y.id = v.id JOIN cuts c ON v.rule = c.rule GROUP BY 1, 2, 3),
tested AS (SELECT k.*, n_good, n_bad, {tail} AS tail, (SELECT count(*) FROM strata) AS n_strata
           FROM k JOIN strata USING (stratum) WHERE n_good > 0 AND n_bad > 0),
ok AS (SELECT *, hit / n_bad::DOUBLE - {quality.GOOD_COST}::DOUBLE * k / n_good AS gain FROM tested
       WHERE tail <= {quality.DELTA}::DOUBLE / ({len(tests)} * n_strata)),
best AS (SELECT stratum, rule, cutoff FROM ok WHERE gain > 0
         QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY gain DESC, cutoff DESC) = 1),
out AS (SELECT DISTINCT v.id FROM v JOIN best b ON v.stratum = b.stratum AND v.rule = b.rule
        WHERE v.v > b.cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND out.id IS NULL AS kept
FROM f LEFT JOIN out ON f.id = out.id"""


def _merkle_tree(name: str, leaves: str, key: str) -> str:
    """CTEs: ``{name}``, the nodes (k, lvl, idx, cnt, h) of every level over
    ``leaves(k, idx, cnt, h)``, and ``{name}_sib``, each node's siblings."""
    a = merkle.ARITY
    return f"""
{name}(k, lvl, idx, cnt, h) AS (
  SELECT k, 0, idx, cnt, h FROM {leaves} UNION ALL
  SELECT k, any_value(lvl) + 1, idx // {a}, (any_value(cnt) + {a - 1}) // {a}, sha256(string_agg(h, '' ORDER BY idx))
  FROM {name} WHERE cnt > 1 GROUP BY k, idx // {a}),
{name}_sib AS (
  SELECT n.k, n.lvl, n.idx, coalesce(string_agg(s.h, '' ORDER BY s.idx) FILTER (s.idx < n.idx), '') AS l,
         coalesce(string_agg(s.h, '' ORDER BY s.idx) FILTER (s.idx > n.idx), '') AS r
  FROM {name} n JOIN {name} s ON n.k = s.k AND n.lvl = s.lvl AND n.idx // {a} = s.idx // {a}
  WHERE n.cnt > 1 GROUP BY 1, 2, 3)"""


def _merkle_sql() -> str:
    part = lambda c: (f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR)::VARCHAR || ':' "  # noqa: E731
                      f"|| {c}::VARCHAR END")
    leaf = lambda text: "sha256(" + " || ".join(part(c) for c in (*merkle.FIELDS[:4], text)) + ")"
    return f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, CASE WHEN source IS NULL THEN '-' ELSE '=' || source END AS k, {leaf("text")} AS leaf,
         CASE WHEN {_crc("doc_id::VARCHAR")} % {merkle.TAMPER} = 0 THEN {leaf(_lower("text"))}
              ELSE {leaf("text")} END AS bad FROM documents),
base AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
         count(*) OVER (PARTITION BY k) AS cnt FROM d),
low AS (SELECT k, idx, cnt, leaf AS h FROM base),{_merkle_tree("t", "low", "k")},
sub AS (SELECT k, h FROM t WHERE cnt = 1),
high AS (SELECT 0 AS k, row_number() OVER (ORDER BY encode(k)) - 1 AS idx, count(*) OVER () AS cnt, h FROM sub),
{_merkle_tree("u", "high", "k")},
pos AS (SELECT k, h AS subroot, row_number() OVER (ORDER BY encode(k)) - 1 AS top FROM sub),
leaves AS (SELECT row_number() OVER () AS id, base.*, subroot, top FROM base JOIN pos USING (k)),
p(id, k, lvl, idx, top, phase, h, proof) AS (
  SELECT id, k, 0, idx, top, 0, bad, '' FROM leaves UNION ALL
  SELECT p.id, p.k, CASE WHEN p.phase = 0 AND t_sib.k IS NULL THEN 0 ELSE p.lvl + 1 END,
         CASE WHEN p.phase = 0 AND t_sib.k IS NULL THEN p.top ELSE p.idx // {merkle.ARITY} END, p.top,
         CASE WHEN p.phase = 0 AND t_sib.k IS NOT NULL THEN 0 WHEN p.phase = 1 AND u_sib.k IS NULL THEN 2 ELSE 1 END,
         CASE WHEN t_sib.k IS NOT NULL THEN sha256(t_sib.l || p.h || t_sib.r)
              WHEN u_sib.k IS NOT NULL THEN sha256(u_sib.l || p.h || u_sib.r) ELSE p.h END,
         p.proof || coalesce(t_sib.l || t_sib.r, '') || coalesce(u_sib.l || u_sib.r, '')
  FROM p LEFT JOIN t_sib ON p.phase = 0 AND t_sib.k = p.k AND t_sib.lvl = p.lvl AND t_sib.idx = p.idx
         LEFT JOIN u_sib ON p.phase = 1 AND u_sib.lvl = p.lvl AND u_sib.idx = p.idx
  WHERE p.phase < 2)
SELECT doc_id, leaf, subroot, u.h AS root, sha256(p.proof) AS proof_sha256, p.h AS folded_root,
       p.h = u.h AS verified
FROM leaves JOIN p ON p.id = leaves.id AND p.phase = 2, u WHERE u.cnt = 1"""


def _integers(scale: int, label: str = "label") -> str:
    """vec_id, label, q of the rows that take part (one row for each vec_id)."""
    return f"""
    SELECT vec_id, {label} AS label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS q
    FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""


def _hard_negatives_sql() -> str:
    moved = f"CASE WHEN vec_id % {rtree.SHIFT} = 0 THEN (label + 1) % {rtree.LABELS} ELSE label END"
    return f"""
WITH v AS MATERIALIZED (SELECT * FROM ({_integers(rtree.SCALE, moved)}) WHERE label IS NOT NULL),
s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, c.vec_id AS other, a.label = c.label AS same,
         CAST(list_dot_product(a.q, c.q) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id AND a.vec_id % {rtree.EVERY} = 0),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= {rtree.POSITIVES})
SELECT anchor_id, positive_id, CAST(row_number() OVER (
         PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND {rtree.LOW} * positive_score <= 100 * score AND 100 * score <= {rtree.HIGH} * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) <= {rtree.NEGATIVES}"""


def _top_k_sql() -> str:
    return f"""
WITH v AS MATERIALIZED ({_integers(covertree.SCALE)}),
s AS (SELECT a.vec_id AS query_id, c.vec_id, CAST(list_dot_product(a.q, c.q) AS BIGINT) AS score
      FROM v a JOIN v c ON a.vec_id <> c.vec_id AND a.vec_id % {covertree.EVERY} = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= {covertree.K}"""


ORACLE_SQL = {
    "op11_hard_negatives": _hard_negatives_sql(),
    "op13_top_k": _top_k_sql(),
    "op12_manifest": _merkle_sql(),
    "op3_quality": _quality_sql(),
    "op8_sharding": _sharding_sql(),
    "op9_urls": _urls_sql(),
    "op5_mixing": f"""
WITH s AS (SELECT coalesce(source, '') AS src,
                  sum(greatest(coalesce(length(text), 0), 1))::DOUBLE AS size
           FROM documents GROUP BY 1),
t AS (SELECT src, size, pow(size, {mixing.TEMPERATURE}) AS w FROM s),
r AS (SELECT src, {mixing.BUDGET} * w * (SELECT sum(size) FROM t)
             / ((SELECT sum(w) FROM t) * size) AS rate FROM t),
k AS (SELECT src, rate,
             unnest(range(0, floor(rate + 12.0 * sqrt(rate) + 30.0)::BIGINT + 1)) AS k FROM r),
c AS (SELECT src, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (
             PARTITION BY src ORDER BY k) AS cdf FROM k),
l AS (SELECT src, list(cdf ORDER BY k) AS cdf FROM c GROUP BY src),
d AS (SELECT documents.*, l.cdf,
             (({_hash52(f"'{mixing.SEED}:' || {_ID}")})::DOUBLE + 0.5) / 4503599627370496.0 AS u
      FROM documents JOIN l ON coalesce(source, '') = l.src),
n AS (SELECT * EXCLUDE (cdf, u), len([x FOR x IN cdf IF x <= u])::INTEGER AS n_copies FROM d),
e AS (SELECT *, unnest(range(1, n_copies + 1))::INTEGER AS copy FROM n)
SELECT *, {_hash52(f"'{mixing.SEED + 1}:' || {_ID} || ':' || copy::VARCHAR")} AS mix_key FROM e
""",
}
