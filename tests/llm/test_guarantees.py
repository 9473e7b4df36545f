"""Guarantees that must not depend on copies, on the size of the corpus or on column names."""

import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from twasprep.llm import mixing, quality, urls

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(rng, n, vocab=60):
    return " ".join(f"w{rng.randrange(vocab)}{'abc'[rng.randrange(3)]}" for _ in range(n))


def _labelled(spark, texts, copies_of_first=0, repeat_labels=1, flip=()):
    """(features, labels): text i good unless it holds '#'; copies get labels too."""
    all_texts = texts + [texts[0]] * copies_of_first
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(all_texts)], DOCS)
    labels = [(i, int("#" not in t) if i not in flip else int("#" in t)) for i, t in enumerate(all_texts)]
    return (quality.quality_features(docs),
            spark.createDataFrame(labels * repeat_labels, "doc_id bigint, quality int"))


def test_copies_and_repeated_labels_are_no_trials(spark):
    rng = random.Random(6)
    texts = [prose(rng, 40) for _ in range(300)] + [prose(rng, 40).replace(" ", "### ") for _ in range(60)]
    cut = lambda f, y: quality.risk_controlled_cutoffs(f, y).collect()
    assert cut(*_labelled(spark, texts)) == []                        # 300 good texts license nothing
    assert cut(*_labelled(spark, texts, repeat_labels=8)) == []       # nor do their labels, eight times
    assert cut(*_labelled(spark, texts, copies_of_first=2400)) == []  # nor one good text, 2,400 times
    enough = texts + [prose(rng, 40) for _ in range(3000)]
    once = cut(*_labelled(spark, enough))
    assert once and once == cut(*_labelled(spark, enough, copies_of_first=50, repeat_labels=3))


def test_disagreeing_labels_are_left_out(spark):
    rng = random.Random(7)
    texts = [prose(rng, 40) for _ in range(3300)] + [prose(rng, 40).replace(" ", "### ") for _ in range(60)]
    feats, labels = _labelled(spark, texts)
    clean = quality.risk_controlled_cutoffs(feats, labels).collect()
    noise = spark.createDataFrame([(3300 + i, 1) for i in range(30)], "doc_id bigint, quality int")
    assert clean and quality.risk_controlled_cutoffs(feats, labels.unionByName(noise)).collect() == clean


def test_the_bound_holds_for_the_rules_together():
    # at most ALPHA of a stratum's good texts over all rules: each rule has its part of it
    assert quality.ALPHA / len(quality.CUTOFFS) == pytest.approx(0.005)


def test_verdicts_do_not_depend_on_the_number_of_hosts(spark):
    ranks = spark.createDataFrame(
        [("trust", f"h{i}", 1e-3 * (i % 7)) for i in range(50)]
        + [("distrust", f"h{i}", 1e-3 * (i % 5)) for i in range(50)], "kind string, host string, score double")
    small = {r["host"]: (r["trust"], r["distrust"]) for r in urls.host_scores(ranks, 1000).collect()}
    tiny = ranks.withColumn("score", F.col("score") / 1e9)
    large = {r["host"]: (r["trust"], r["distrust"]) for r in urls.host_scores(tiny, 1000 * 10 ** 9).collect()}
    for host, pair in small.items():
        assert large[host] == pytest.approx(pair, rel=1e-8)
    assert sum(d > t for t, d in small.values()) == sum(d > t for t, d in large.values()) > 0


def test_propagation_goes_on_until_single_hosts_are_settled(spark):
    chain = spark.createDataFrame([("trust", f"n{i}", f"n{i + 1}", 1) for i in range(40)],
                                  "kind string, src string, dst string, n long")
    seeds = spark.createDataFrame([("trust", "n0", 1.0)], "kind string, host string, mass double")
    got = {r["host"]: r["score"] for r in urls.propagate(chain, seeds, hosts=10 ** 6).collect()}
    assert got["n40"] == pytest.approx(0.15 * 0.85 ** 40, rel=1e-6)


def test_mixing_keeps_columns_of_any_name(spark):
    own = ("cdf", "copy", "n_copies", "mix_key", "_u", "_src", "_row", "_n", "_copy", "_key", "base", "a.b")
    docs = spark.createDataFrame([(i, f"t{i}", "en", "s", 2) for i in range(40)], DOCS)
    for c in own:
        docs = docs.withColumn(c, F.concat(F.lit(f"{c}:"), F.col("text")))
    out = mixing.poisson_mix(docs, budget=3.0)
    assert out.columns[:len(docs.columns)] == docs.columns and len(out.columns) == len(docs.columns) + 3
    assert {"__copy", "_n_copies", "_mix_key"} <= set(out.columns)
    rows = out.collect()
    assert len(rows) > 60 and all(r[c] == f"{c}:{r['text']}" for r in rows for c in own)
    kept = corpus_pipeline.mix_sources(spark, docs, "")
    assert kept.columns == docs.columns and kept.where(F.col("copy") != F.concat(F.lit("copy:"), "text")).count() == 0


def test_large_rates_are_inverted_without_long_arrays(spark):
    docs = spark.createDataFrame([(i, "x", "en", "tiny" if i < 5 else "big", 1) for i in range(3005)], DOCS)
    w = spark.createDataFrame([("tiny", 1e6), ("big", 1.0)], "source string, weight double")
    rates = {r["_src"]: r for r in mixing.source_rates(docs, w, budget=1000.0).collect()}
    r = rates["tiny"]["rate"]
    assert r == pytest.approx(601_000, rel=1e-4) and len(rates["tiny"]["cdf"]) < 30 * r ** 0.5
    assert rates["tiny"]["cdf"][-1] == pytest.approx(1.0, abs=1e-6)
    n = [x["_n"] for x in mixing.poisson_counts(docs.where("source = 'tiny'"), mixing.source_rates(
        docs, w, budget=1000.0)).collect()]
    assert len(n) == 5 and all(abs(x - r) < 6 * r ** 0.5 for x in n)


def _classes(links, n):
    up = list(range(n))
    for a, b in links:
        while up[a] != a:
            a = up[a]
        while up[b] != b:
            b = up[b]
        up[max(a, b)] = min(a, b)
    for i in range(n):
        while up[i] != up[up[i]]:
            up[i] = up[up[i]]
    return up


@pytest.mark.parametrize("wide", [0, 2048])
def test_pairs_of_wide_buckets_meet_over_rare_elements(spark, monkeypatch, wide):
    from collections import Counter

    from twasprep.llm import bagminhash

    monkeypatch.setattr(bagminhash, "WIDE", wide)   # 0: every pair by its prefix
    monkeypatch.setattr(bagminhash, "CHAINS", 0)
    rng = random.Random(12)
    template = prose(rng, 60, 4000)
    texts = []
    for _ in range(60):
        t = (template + " " + prose(rng, rng.choice([8, 14, 20, 30]), 4000)).split()
        texts.append(" ".join(t))
        for _ in range(rng.randrange(3)):
            t[rng.randrange(len(t))] = "other"
            texts.append(" ".join(t))
    bags = []
    for t in texts:
        w = t.split()
        bags.append(Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)))
    links = [(i, j) for i in range(len(texts)) for j in range(i)
             if 5 * sum((bags[i] & bags[j]).values()) >= 4 * sum((bags[i] | bags[j]).values())]
    up = _classes(links, len(texts))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = {r["doc_id"]: r["class_id"] for r in bagminhash.near_duplicates(docs).collect()}
    assert got == dict(enumerate(up)) and len(set(up)) > 20


def test_a_shared_template_makes_pairs_in_proportion_to_the_rows(spark, monkeypatch):
    from twasprep.llm import bagminhash

    counts = {}

    def count(df, tag, write=bagminhash.materialise):
        out = write(df, tag)
        if tag in ("rest", "star"):
            counts[tag] = out.count()
        return out

    monkeypatch.setattr(bagminhash, "materialise", count)
    monkeypatch.setattr(bagminhash, "WIDE", 64)
    sizes = {}
    for n in (200, 400):
        rng = random.Random(n)
        template = prose(rng, 60, 100_000)
        docs = spark.createDataFrame([(i, template + " " + prose(rng, 30, 100_000)) for i in range(n)],
                                     "doc_id bigint, text string")
        assert bagminhash.near_duplicates(docs).select("class_id").distinct().count() == n
        sizes[n] = counts["rest"] + counts["star"]
    assert sizes[400] < 3 * max(sizes[200], 1) and sizes[400] < 400 * 40
