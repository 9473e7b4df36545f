"""Personal data and information-theoretic sanitisation (native DataFrame code).

Entities (email, ip, card, phone) are found by pattern. Terms near an entity may
reveal it: with N distinct texts, df(t) of them holding t, n holding an entity
value e and c holding t beside e, PMI = log2(c * N / (df * n)) is compared with
the information IC = log2(N / n) of e itself. All four count distinct texts, so
copies of rows change nothing, and PMI / IC is 1 when t occurs only in texts
where it stands beside e. Terms at ``REMOVE`` or more are removed, from ``GENERALISE`` on they are generalised to
their shape; both only with ``SUPPORT`` distinct contexts, so that copies of one
passage prove nothing. A context is a window: the tokens up to the ``NEAR``-th word
of four letters on each side, ``FAR`` characters at most (in a long table of
numbers every entity's context would else be the whole table). A flagged term is reported at
every occurrence in every text, beside the entity or not, with its strictest action.

Tokens are runs of letters and digits; a term has four characters, a digit or a
capital (short words in lower case are no evidence).

Edge cases: null and empty texts have no spans; equal texts and repeated rows
get equal spans; the same value twice in one text is two spans; a term inside
an entity is not reported; an empty table gives no rows; only the id and text
columns are read, so other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twasprep.llm.common import let, materialise

# Fixed patterns, written so that a search is linear in the text: a match can
# only begin at the start of its run of characters or where the last one ended,
# and repeated groups are one character long.
EMAIL = (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@(?=[A-Za-z0-9-]+\.[A-Za-z0-9-])"
         r"[A-Za-z0-9-](?:[A-Za-z0-9.-](?<!\.\.))*[A-Za-z0-9-]")
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]+\.[0-9]+\.[0-9]+"
CARD = r"[0-9](?:[0-9\x20-](?<![\x20-]{2}))*[0-9]"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone", "term")
WORD = r"[\p{L}\p{M}\p{N}]+"
LONG = r"\p{L}{4,}"
TERM = r"\p{N}|\p{Lu}|.{4}"
NEAR = 6  # context words per side
REACH, FAR = 200, 4000  # characters per side in which they are looked for: first, if too few
CHUNK = 64  # matches added up at once, so that long texts take linear time
SUPPORT = 3
GENERALISE, REMOVE = 0.75, 0.9

SPAN = "struct<start:int,rank:int,end:int,kind:string,value:string>"


def matches(text: Column, pattern: str) -> Column:
    """All matches as array<struct<start, end, value>>, in code points.

    The gaps between matches come from ``split``, so positions are sums of lengths.
    """
    gaps = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(found.alias("m"), F.transform(gaps, lambda g: F.length(g)).alias("g"))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    init = F.struct(F.lit(0).alias("pos"), none.alias("out"))

    def add(acc: Column, x: Column) -> Column:
        start = acc["pos"] + x["g"]
        end = start + F.coalesce(F.length(x["m"]), F.lit(0))
        return F.struct(end.alias("pos"), F.when(x["m"].isNull(), acc["out"]).otherwise(
            F.concat(acc["out"], F.array(F.struct(
                start.alias("start"), end.alias("end"), x["m"].alias("value"))))).alias("out"))

    def shifted(parts: Column) -> Column:
        at = F.aggregate(parts, F.struct(F.lit(0).alias("pos"), F.array().cast("array<int>").alias("at")),
                         lambda acc, p: F.struct((acc["pos"] + p["pos"]).alias("pos"), F.concat(
                             acc["at"], F.array(acc["pos"])).alias("at")))["at"]
        return F.flatten(F.zip_with(parts, at, lambda p, o: F.transform(p["out"], lambda x: F.struct(
            (x["start"] + o).alias("start"), (x["end"] + o).alias("end"), x["value"].alias("value")))))

    def chunked(x: Column) -> Column:
        first = F.sequence(F.lit(1), F.size(x), F.lit(CHUNK))
        return let(F.transform(first, lambda i: F.aggregate(
            F.slice(x, i, F.lit(CHUNK)), init, add)), shifted)

    return let(pairs, lambda x: F.when(F.size(x) <= CHUNK, F.aggregate(x, init, add)["out"])
               .otherwise(chunked(x)))


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def total(rev: Column) -> Column:
        at = lambda i: F.substring(rev, i, F.lit(1)).cast("int")
        # a doubled digit counts as the sum of its digits
        return F.aggregate(F.sequence(F.lit(1), F.length(rev)), F.lit(0), lambda a, i: a + F.when(
            i % 2 == 1, at(i)).otherwise((at(i) * 2) % 10 + F.floor(at(i) / 5).cast("int")))

    return let(F.reverse(digits), total) % 10 == 0


def entities(text: Column) -> Column:
    """Entity spans of a text, sorted by start and kind."""
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def kind(rank: int, gate: Column, pattern: str, good) -> Column:
        found = F.when(gate, matches(text, pattern)).otherwise(none)
        return F.transform(F.filter(found, good), lambda x: F.struct(
            x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"),
            F.lit(KINDS[rank]).alias("kind"), x["value"].alias("value")))

    def digits(x: Column) -> Column:
        return F.regexp_replace(x["value"], "[^0-9]+", "")

    def is_card(x: Column) -> Column:
        return let(digits(x), lambda d: F.when(
            F.length(d).between(12, 19), luhn(d)).otherwise(False))

    return F.array_sort(F.concat(
        kind(0, F.contains(text, F.lit("@")), EMAIL, lambda x: F.lit(True)),
        kind(1, F.rlike(text, F.lit(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]")), IP,
             lambda x: F.forall(F.split(x["value"], r"\."), lambda p: p.cast("double") <= 255)),
        kind(2, F.rlike(text, F.lit(r"[0-9](?:[\x20-]?[0-9]){11}")), CARD, is_card),
        kind(3, F.contains(text, F.lit("+")), PHONE,
             lambda x: F.length(digits(x)).between(9, 15))))


def _context(text: Column, spans: Column) -> Column:
    """Per span its value, the hash of the words around it (the context) and its terms."""
    size = F.length(text)
    is_long = lambda w: F.rlike(w["value"], F.lit(LONG))

    def before(x: Column, reach: int, then=None) -> Column:
        lo = F.greatest(x["start"] - reach, F.lit(0))
        found = matches(F.substring(text, lo + 1, x["start"] - lo), WORD)
        # a word cut by the window's edge is no word
        found = F.transform(F.filter(found, lambda w: (w["start"] > 0) | (lo == 0)), shift(lo))

        def cut(ws: Column) -> Column:
            least = let(F.filter(ws, is_long), lambda n: F.when(
                F.size(n) >= NEAR, F.get(n, F.size(n) - NEAR)["start"]))
            near = let(least, lambda at: F.filter(ws, lambda w: at.isNull() | (w["start"] >= at)))
            return near if then is None else F.when(
                (lo > 0) & (F.size(F.filter(ws, is_long)) < NEAR), then).otherwise(near)

        return let(found, cut)

    def after(x: Column, reach: int, then=None) -> Column:
        hi = F.least(x["end"] + reach, size)
        found = matches(F.substring(text, x["end"] + 1, hi - x["end"]), WORD)
        found = F.transform(F.filter(found, lambda w: (w["end"] < hi - x["end"]) | (hi == size)),
                            shift(x["end"]))

        def cut(ws: Column) -> Column:
            most = let(F.filter(ws, is_long), lambda n: F.get(n, F.lit(NEAR - 1))["end"])
            near = let(most, lambda at: F.filter(ws, lambda w: at.isNull() | (w["end"] <= at)))
            return near if then is None else F.when(
                (hi < size) & (F.size(F.filter(ws, is_long)) < NEAR), then).otherwise(near)

        return let(found, cut)

    def shift(at: Column):
        return lambda w: F.struct((w["start"] + at).alias("start"), (w["end"] + at).alias("end"),
                                  w["value"].alias("value"))

    def around(x: Column) -> Column:
        near = F.concat(before(x, REACH, before(x, FAR)), after(x, REACH, after(x, FAR)))
        lower = lambda ws: F.transform(ws, lambda w: F.lower(w["value"]))
        return let(near, lambda ws: F.struct(
            x["value"].alias("value"), F.xxhash64(lower(F.filter(ws, is_long))).alias("context"),
            F.array_distinct(lower(F.filter(ws, lambda w: F.rlike(w["value"], F.lit(TERM))))).alias("terms")))

    return F.transform(spans, around)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, tkey, spans, contexts: one narrow row per document."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("_t")).select(
        "doc_id", F.xxhash64("_t").alias("tkey"), "_t", entities(F.col("_t")).alias("spans"))
    return rows.select("doc_id", "tkey", "spans", F.when(
        F.size("spans") > 0, _context(F.col("_t"), F.col("spans"))).alias("contexts"))


def distinct_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(tkey, words): the distinct lower-case tokens of every distinct text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    once = docs.select(F.xxhash64(text).alias("tkey"), text.alias("_t")).dropDuplicates(["tkey"])
    return once.select("tkey", F.array_distinct(F.transform(F.regexp_extract_all(
        "_t", F.lit(WORD), F.lit(0)), F.lower)).alias("words"))


def revealing_terms(scanned: DataFrame, words: DataFrame, support: int = SUPPORT) -> DataFrame:
    """(value, term, action, ratio) of the pairs beyond the disclosure thresholds.

    ``words``: :func:`distinct_words` of the same documents."""
    # equal rows (text, value, context) count once ahead of the explode
    each = scanned.where("contexts is not null").select("tkey", F.explode("contexts").alias("c")) \
        .select("tkey", "c.value", "c.context", "c.terms").distinct()
    texts, contexts = F.count_distinct("tkey"), F.count_distinct("context")
    seen = each.groupBy("value").agg(texts.alias("n"), contexts.alias("_s")) \
        .where(F.col("_s") >= support).drop("_s")
    pairs = each.select("tkey", "value", "context", F.explode("terms").alias("term")) \
        .groupBy("value", "term").agg(texts.alias("c"), contexts.alias("_s")) \
        .where(F.col("_s") >= support).drop("_s")
    pairs = materialise(pairs.join(seen, "value"), "pairs")
    # counted before the join, map side first: a common term is one row per task
    df = words.select(F.explode("words").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    total = words.agg(F.count(F.lit(1)).alias("n_docs"))
    pmi = F.log2(F.col("c") * F.col("n_docs") / (F.col("df") * F.col("n")))
    ic = F.log2(F.col("n_docs") / F.col("n"))
    return pairs.join(df, "term").join(F.broadcast(total)) \
        .withColumn("ratio", F.when(ic > 0, pmi / ic).otherwise(F.lit(0.0))) \
        .where(F.col("ratio") >= GENERALISE).select(
            "value", "term", F.when(F.col("ratio") >= REMOVE, "remove").otherwise(
                "generalise").alias("action"), "ratio")


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       support: int = SUPPORT) -> DataFrame:
    """doc_id, tkey, spans (entities), terms (array<struct<start, end, action>>).

    Positions are worked out only in texts that hold a flagged term, which their
    distinct words tell; all joins are on keys and left to the optimizer, whose
    sides are written tables of known size."""
    scanned = materialise(scan(docs, id_col, text_col), "scanned")
    words = materialise(distinct_words(docs, text_col), "words")
    flagged = materialise(revealing_terms(scanned, words, support), "revealing")
    # of several verdicts on one term the strictest holds, at all its occurrences
    terms = materialise(flagged.groupBy("term").agg(F.max("action").alias("action")), "terms")
    holding = materialise(words.select("tkey", F.explode("words").alias("term")).join(terms, "term")
                          .groupBy("tkey").agg(F.map_from_entries(F.collect_list(
                              F.struct("term", "action"))).alias("flagged")), "holding")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("tkey"), text.alias("_t")) \
        .join(holding, "tkey")
    action = lambda w: F.try_element_at("flagged", F.lower(w["value"]))
    found = F.filter(F.transform(matches(F.col("_t"), WORD), lambda w: F.struct(
        w["start"].alias("start"), w["end"].alias("end"), action(w).alias("action"))),
        lambda w: w["action"].isNotNull())
    per_doc = rows.select(F.col("doc_id").alias("_d"), F.col("tkey").alias("_k"), found.alias("terms")) \
        .groupBy("_d", "_k").agg(F.first("terms").alias("terms"))
    none = F.array().cast("array<struct<start:int,end:int,action:string>>")
    joined = scanned.select("doc_id", "tkey", "spans").join(
        per_doc, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("tkey") == F.col("_k")), "left")
    outside = F.filter(F.array_sort("terms"), lambda t: ~F.exists(
        "spans", lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])))
    return joined.select("doc_id", "tkey", "spans", F.coalesce(outside, none).alias("terms"))


def all_spans(spans: Column, terms: Column) -> Column:
    """Entities and terms in one array, sorted by start and kind."""
    return F.array_sort(F.concat(spans, F.transform(terms, lambda t: F.struct(
        t["start"].alias("start"), F.lit(len(KINDS) - 1).alias("rank"), t["end"].alias("end"),
        F.lit("term").alias("kind"), t["action"].alias("value")))))


def redact(text: Column, spans: Column) -> Column:
    """The text with entities as [KIND], generalised terms as their shape, removed terms gone."""
    init = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(acc: Column, x: Column) -> Column:
        word = F.substring(text, x["start"] + 1, x["end"] - x["start"])
        put = F.when(x["kind"] != "term", F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]"))) \
            .when(x["value"] == "remove", F.lit("")) \
            .otherwise(F.regexp_replace(word, r"[\p{L}\p{N}]", "x"))
        # a span that begins inside the last one only extends it
        start = F.greatest(acc["at"], x["start"])
        gap = F.substring(text, acc["at"] + 1, start - acc["at"])
        return F.when(x["end"] <= acc["at"], acc).otherwise(F.struct(
            x["end"].alias("at"), F.concat(acc["out"], gap, put).alias("out")))

    acc = F.aggregate(spans, init, add)
    return F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))


def sanitise(docs: DataFrame, **kw) -> DataFrame:
    """doc_id, text (sanitised): null texts stay null."""
    found = find_personal_data(docs, **kw).select(
        F.col("doc_id").alias("_d"), F.col("tkey").alias("_k"),
        all_spans(F.col("spans"), F.col("terms")).alias("_s")).dropDuplicates(["_d", "_k"])
    key = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    return docs.select("doc_id", "text").join(
        found, F.col("doc_id").eqNullSafe(F.col("_d")) & (key == F.col("_k"))) \
        .select("doc_id", redact(F.col("text"), F.col("_s")).alias("text"))
