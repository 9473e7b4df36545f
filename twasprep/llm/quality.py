"""Quality rules with risk-controlled cutoffs (native DataFrame code).

Word and line statistics feed six one-sided rules. For each stratum (the
language) labelled good texts act as the holdout: a cutoff may be used only if
the exact binomial tail P(Bin(n, a) <= k) for k rejected of n good texts is at
most delta divided by the number of (rule, stratum, cutoff) tests, a being
``alpha`` over the number of rules. So with probability 1 - delta the rules in
use together reject at most ``alpha`` of the good texts of any stratum. Among
such cutoffs the one with the best gain (bad share rejected less ``good_cost``
times good share rejected) is taken.

The bound needs independent trials: a label table's repeated rows count once,
and so does each distinct text of a stratum, however many copies are labelled;
documents (and texts) whose labels disagree are left out. Texts are told apart
by a 64-bit hash within the labelled rows.

Edge cases: null or blank text has no words (it fails the base rule); a null
language is a stratum of its own; labels that are null or not 0/1 are ignored;
repeated rows are judged alike; texts of any length are measured whole; an empty
table gives an empty result; without enough labels a rule stays off; a value on
a cutoff passes. Only the named columns are read, so extra columns with any name
are harmless.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twasprep.llm.common import BLANKS, binomial_cdf, let, materialise, words

MIN_WORDS = 20
REPEAT_WINDOW = 8
ALPHA = 0.03  # false rejection allowed per stratum, by all rules together
DELTA = 0.05  # chance that any of the guarantees fails
GOOD_COST = 10.0

#: Candidate cutoffs per rule, fixed before any label is seen.
CUTOFFS = {
    "symbol_share": [0.02, 0.05, 0.1, 0.15, 0.2, 0.3],
    "dup_line_share": [0.1, 0.2, 0.3, 0.4, 0.5],
    "repeat_share": [0.02, 0.05, 0.1, 0.15, 0.2, 0.25],
    "upper_share": [0.1, 0.2, 0.3, 0.5, 0.7],
    "sameness": [0.5, 0.6, 0.7, 0.8, 0.9, 0.95],
    "word_length": [8.0, 10.0, 12.0, 15.0, 20.0],
}


def quality_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     stratum_col: str | None = "lang") -> DataFrame:
    """One narrow row per document: the id, its stratum and all statistics."""
    stratum = F.coalesce(F.col(stratum_col).cast("string"), F.lit("")) if stratum_col else F.lit("")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), stratum.alias("stratum"),
                       F.xxhash64(text).alias("text_key"), statistics(text).alias("_s"))
    return rows.select("doc_id", "stratum", "text_key", "_s.*")


def statistics(text: Column) -> Column:
    """All statistics of a text as a struct."""
    w = REPEAT_WINDOW
    none = F.array().cast("array<bigint>")
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "")

    def covered(p: Column) -> Column:
        """Words inside the windows that begin at the ascending positions ``p``."""
        steps = F.transform(p, lambda x, i: F.least(
            F.lit(w), F.coalesce(F.get(p, i + 1) - x, F.lit(w))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def windows(h: Column) -> Column:
        return F.when(F.size(h) >= w, F.transform(
            F.sequence(F.lit(1), F.size(h) - (w - 1)), lambda i: F.xxhash64(F.slice(h, i, w)))) \
            .otherwise(none)

    def repeated(g: Column) -> Column:
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(
            let(_dup_positions(g), covered))

    def of_words(ws: Column) -> Column:
        hashes = F.transform(ws, lambda x: F.xxhash64(x))
        return let(lines, lambda ls: F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.length(F.array_join(ws, "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
            let(hashes, lambda h: let(windows(h), repeated)).cast("long").alias("n_repeat_words"),
            F.size(ls).cast("long").alias("n_lines"),
            F.length(F.regexp_replace(text, r"[^A-Z]+", "")).cast("long").alias("n_upper"),
            F.size(F.array_distinct(ws)).cast("long").alias("n_distinct")))

    return let(words(text), of_words)


def _dup_positions(g: Column) -> Column:
    """Ascending positions of the elements of ``g`` that occur more than once."""
    pairs = F.array_sort(F.transform(g, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

    def find(z: Column) -> Column:
        same = lambda r, j: F.coalesce(F.get(z, j)["h"] == r["h"], F.lit(False))
        marked = F.transform(z, lambda r, j: F.when(same(r, j - 1) | same(r, j + 1), r["i"]))
        return F.array_sort(F.array_compact(marked))

    return let(pairs, find)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def rule_values() -> dict[str, Column]:
    share = lambda a, b: F.coalesce(F.col(a) / F.col(b), F.lit(0.0))
    safe = lambda c, n: F.when(F.col(n) > 0, c).otherwise(F.lit(0.0))
    return {
        "symbol_share": safe(share("n_symbols", "word_chars"), "word_chars"),
        "dup_line_share": safe(share("n_dup_lines", "n_lines"), "n_lines"),
        "repeat_share": safe(share("n_repeat_words", "n_words"), "n_words"),
        "upper_share": safe(share("n_upper", "word_chars"), "word_chars"),
        "sameness": safe(1.0 - share("n_distinct", "n_words"), "n_words"),
        "word_length": safe(share("word_chars", "n_words"), "n_words"),
    }


def risk_controlled_cutoffs(features: DataFrame, labels: DataFrame, alpha: float = ALPHA,
                            delta: float = DELTA, good_cost: float = GOOD_COST,
                            label_id: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """One row per stratum: its cutoff per rule (null where the rule is off)."""
    lab = labels.select(F.col(label_id).alias("doc_id"), F.col(label_col).cast("int").alias("_y")) \
        .where(F.col("_y").isin(0, 1) & F.col("doc_id").isNotNull())
    # one label per document, one trial per text and stratum; none where they disagree
    lab = lab.groupBy("doc_id").agg(F.min("_y").alias("_y"), F.max("_y").alias("_z")).where("_y = _z").drop("_z")
    vals = rule_values()
    narrow = features.where(~base_failed()).select("doc_id", "stratum", "text_key",
                                                   *[v.alias(f"v_{k}") for k, v in vals.items()])
    joined = narrow.join(lab, "doc_id").groupBy("stratum", "text_key").agg(
        F.min("_y").alias("_y"), F.max("_y").alias("_z"), *[F.max(f"v_{k}").alias(f"v_{k}") for k in vals]) \
        .where("_y = _z")
    good, bad = F.col("_y") == 1, F.col("_y") == 0
    tests = [(r, c) for r, cs in CUTOFFS.items() for c in cs]
    aggs = [F.count(F.when(good, 1)).alias("n_good"), F.count(F.when(bad, 1)).alias("n_bad")]
    for j, (r, c) in enumerate(tests):
        over = F.col(f"v_{r}") > c
        aggs += [F.count(F.when(good & over, 1)).alias(f"g{j}"),
                 F.count(F.when(bad & over, 1)).alias(f"b{j}")]
    counts = joined.groupBy("stratum").agg(*aggs)
    n_strata = counts.select(F.count(F.lit(1)).alias("n_strata"))
    rows = counts.select("stratum", "n_good", "n_bad", F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), F.lit(float(c)).alias("cutoff"),
                 F.col(f"g{j}").alias("k"), F.col(f"b{j}").alias("hit"))
        for j, (r, c) in enumerate(tests)])).alias("x")).select(
            "stratum", "n_good", "n_bad", "x.*")
    tested = rows.join(F.broadcast(n_strata)).withColumn(
        "tail", binomial_cdf(F.col("k"), F.col("n_good"), alpha / len(CUTOFFS)))
    gain = (F.col("hit") / F.col("n_bad") - good_cost * F.col("k") / F.col("n_good"))
    ok = tested.where((F.col("n_good") > 0) & (F.col("n_bad") > 0)) \
        .where(F.col("tail") <= F.lit(delta) / (F.lit(len(tests)) * F.col("n_strata"))) \
        .withColumn("gain", gain).where("gain > 0")
    best = ok.groupBy("stratum", "rule").agg(
        F.max(F.struct("gain", "cutoff"))["cutoff"].alias("cutoff"))
    return best.groupBy("stratum").agg(*[
        F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"c_{r}") for r in CUTOFFS])


def judge(features: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Features plus ``base_failed``, ``failed_rules`` and ``kept``."""
    vals = rule_values()
    failed = F.array_compact(F.array(*[
        F.when(vals[r] > F.col(f"c_{r}"), F.lit(r)) for r in CUTOFFS]))
    j = features.join(cutoffs, "stratum", "left") \
        .withColumn("base_failed", base_failed()).withColumn("failed_rules", failed)
    # one comparison: half of it can't be pushed below the join and computed again there
    bad = F.size("failed_rules") + F.col("base_failed").cast("int")
    return j.withColumn("kept", bad == 0) \
        .drop("text_key", *[f"c_{r}" for r in CUTOFFS])


def quality_verdicts(docs: DataFrame, labels: DataFrame, **kw) -> DataFrame:
    feats = materialise(quality_features(docs), "quality")
    cuts = materialise(risk_controlled_cutoffs(feats, labels, **kw), "cutoffs")
    return judge(feats, cuts)


def keep_good(docs: DataFrame, labels: DataFrame, **kw) -> DataFrame:
    """The rows of ``docs`` that pass, unchanged (all columns).

    Statistics are computed once and written beside the packed rows, so texts
    are never shuffled and rows never meet by id.
    """
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    text = F.coalesce(F.col("_row.text"), F.lit(""))
    rows = packed.select("_row", F.coalesce(F.col("_row.lang").cast("string"), F.lit("")).alias("stratum"),
                         F.xxhash64(text).alias("text_key"), statistics(text).alias("_s"))
    rows = materialise(rows, "quality").select("_row", "stratum", "text_key", "_s.*")
    feats = rows.withColumn("doc_id", F.col("_row.doc_id"))
    cuts = materialise(risk_controlled_cutoffs(feats.drop("_row"), labels, **kw), "cutoffs")
    return judge(rows, cuts).where("kept").select("_row.*")
