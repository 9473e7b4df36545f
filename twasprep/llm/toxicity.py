"""Toxicity by Levenshtein automata over a learned lexicon trie and context windows.

Lexicon: from the training labels, whole words and stems (word beginnings) that
occur almost only in toxic documents, judged by the lower confidence bound of
their log odds. The lexicon's trie is intersected with Levenshtein automata
(one edit, a letter put in, left out or changed or two neighbours swapped, for
words and stems of four letters or more, except for near forms that clean
training documents hold as words) and made deterministic; all words of a block
of texts run through the transition table at once, so misspelled terms are found
in time linear in the text.

Context: a hit that quotation marks enclose within its window counts as a
quotation, with a weight of its own, and not as abuse; marks and line ends of a
text are looked up, not searched again for every hit.
Per document the numbers of plain, misspelled and quoted hits form a small
cell; a logistic model fitted to the training cells gives the score.

Labels enter only through training rows (``crc32(doc_id as text) % 5 <> 0``);
ids, languages, sources and labels are never inputs of a score.

The lexicon holds at most ``TERMS`` terms and hit counts saturate at ``SATURATE``:
sizes of the model, not of the data.

Edge cases: null and empty texts have no hits and get the model's base score;
texts of any length are scored whole; without labels (or without a term that
qualifies) every score is the smoothed share of toxic training rows, 0 if there
are none; null labels are ignored; equal label rows count once; terms of equal
bound rank by their letters; repeated documents are scored alike; an empty table
gives no rows; only the named columns are read, so others may have any name.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twasprep.llm import textvec as tv
from twasprep.llm.common import materialise

FOLDS = 5
STEMS = (5, 6, 7)  # lengths of word beginnings offered as terms
LEAST_DOCS = 3  # toxic training documents that must hold a term
LEAST_ODDS = 2.3  # lower bound of the log odds of a term
LEAST_SHARE = 0.005  # and the share of them
ONE_WORD = 0.9  # share of a stem's documents that makes it one word
TERMS = 400  # size of the lexicon (model size, not a cap on data)
FUZZY = 6  # letters from which one edit is allowed, unless told otherwise
LETTERS = 4  # letters from which the learned terms take one edit
TRAIN_ROWS = 40_000  # labelled rows that the model is fitted on (a sample, if there are more)
CONTEXT = 40  # characters on each side searched for quotation marks
BLOCK = 1 << 20
OPEN, CLOSE = "\"\u201c\u201e\u00ab\u2018", "\"\u201d\u201c\u00bb\u2019"
_TOKEN = r"[^\s.,;:!?()\[\]{}\"\u201c\u201d\u201e\u00ab\u00bb|<>/]+"


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds == 0


def training_rows(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """(text, y) of about ``most`` labelled training rows (all, if there are fewer).

    Rows are sampled by a hash of the id at one rate for both classes, so the
    sampled labels are a table of bounded size and texts need not be shuffled.
    """
    lab = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("y")) \
        .where(F.col("y").isin(0, 1) & F.col("_id").isNotNull()).where(~held_out(F.col("_id"))) \
        .distinct()
    size = lab.agg(F.count(F.lit(1)).alias("_n"))
    cells = 1 << 30
    lab = lab.join(F.broadcast(size)).where(
        F.pmod(F.xxhash64(F.lit("train"), "_id"), F.lit(cells)) * F.col("_n") < most * cells)
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")) \
        .join(F.broadcast(lab.select("_id", "y")), F.col("doc_id") == F.col("_id")) \
        .select("text", "y")


def _terms_of(rows: DataFrame) -> DataFrame:
    """The distinct terms of each text, one row each: '=' and a word, '^' and a stem."""
    tokens = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(f"({_TOKEN})"), 1))
    w = rows.select(tokens.alias("ws"))

    def stems(n: int) -> Column:
        return F.array_distinct(F.transform(
            F.filter("ws", lambda w: F.length(w) > n),
            lambda w: F.concat(F.lit("^"), F.substring(w, 1, n))))

    return w.select(F.explode(F.concat(F.transform("ws", lambda w: F.concat(F.lit("="), w)),
                                       *[stems(n) for n in STEMS])).alias("t"))


def learn_terms(train: DataFrame, terms: int = TERMS) -> list[tuple[str, bool, float, bool]]:
    """(term, is a stem, log odds, may be misspelled) of the lexicon, strongest first."""
    sizes = train.agg(F.coalesce(F.sum("y"), F.lit(0)).alias("p"),
                      F.coalesce(F.sum(1 - F.col("y")), F.lit(0)).alias("n"))
    pos = _terms_of(train.where("y = 1")).groupBy("t").agg(F.count(F.lit(1)).alias("pos"))
    # a term must be in a set share of the toxic documents, so there are at most
    # (terms per document) / LEAST_SHARE of them at any input size
    offered = materialise(pos.join(F.broadcast(sizes)).where(
        (F.col("pos") >= LEAST_DOCS) & (F.col("pos") >= LEAST_SHARE * F.col("p"))), "terms")
    neg = _terms_of(train.where("y = 0")).join(offered.select("t"), "t").groupBy("t").agg(
        F.count(F.lit(1)).alias("neg"))
    counts = offered.join(neg, "t", "left").fillna(0, ["neg"])
    odds = F.log((F.col("pos") + 0.5) / (F.col("p") + 1.0)) - F.log(
        (F.col("neg") + 0.5) / (F.col("n") + 1.0))
    bound = odds - F.sqrt(1.0 / (F.col("pos") + 0.5) + 1.0 / (F.col("neg") + 0.5))
    best = counts.withColumn("odds", odds).withColumn("bound", bound) \
        .where(F.col("bound") >= LEAST_ODDS).orderBy(F.desc("bound"), "t").limit(terms)
    rows = [(r["t"][1:], r["t"][0] == "^", float(r["odds"]), r["pos"], True)
            for r in best.collect()]
    # a stem that is nearly always one word gives way to the word, and a longer
    # stem adds nothing to a shorter one; words stay for their own edits
    words = [(t, n) for t, stem, _, n, _ in rows if not stem]
    rows = [r for r in rows if not r[1] or not any(
        t.startswith(r[0]) and n >= ONE_WORD * r[3] for t, n in words)]
    stems = {r[0] for r in rows if r[1]}
    return [(t, s, o, f) for t, s, o, _, f in rows
            if not s or not any(t[:n] in stems for n in STEMS if n < len(t))]


class Automaton:
    """Deterministic automaton of all words within the allowed edits of a term.

    States are sets of (trie node, edits, swap), built by the subset method (swap:
    the letter that must follow, and the node it leads to, after the second of
    two neighbours was read first);
    ``step[state, symbol]`` with one symbol per lexicon character and one for
    all others; state 0 is dead, state 1 the start. ``exact`` and ``near`` mark
    accepting states; in a stem's accepting state any continuation stays accepted.
    """

    def __init__(self, terms: list[tuple[str, bool, float, bool]], least: int = FUZZY,
                 stems: bool = False):
        kids, end, edits, most = [{}], [0], [0], [0]
        for term, stem, _, frequent in terms:
            node = 0
            allowed = 1 if frequent and len(term) >= least and (stems or not stem) else 0
            edits[0] = max(edits[0], allowed)
            for ch in term:
                if ch not in kids[node]:
                    kids[node][ch] = len(kids)
                    kids.append({})
                    end.append(0)
                    edits.append(0)
                    most.append(0)
                node = kids[node][ch]
                edits[node] = max(edits[node], allowed)
            end[node] = max(end[node], 2 if stem else 1)
            most[node] = max(most[node], allowed)  # of the terms that end here
        chars = sorted({c for t, *_ in terms for c in t})
        self.symbol = {c: i + 1 for i, c in enumerate(chars)}
        sym = chars

        def close(items):
            """Add what deleting a term's character reaches; keep the least edits per node."""
            best: dict[tuple, int] = {}
            todo = list(items)
            while todo:
                n, e, swap = todo.pop()
                if best.get((n, swap), 9) <= e:
                    continue
                best[n, swap] = e
                if swap is None:
                    todo += [(k, e + 1, None) for k in kids[n].values() if e + 1 <= edits[k]]
            return frozenset((n, e, swap) for (n, swap), e in best.items())

        def follow(state, a):
            """What reading ``a`` (None: a letter of no term) leads to."""
            for n, e, swap in state:
                if swap is not None:
                    if swap[0] == a:
                        yield swap[1], e, None
                    continue
                if end[n] == 2 and e <= most[n]:
                    yield n, e, None  # a finished stem takes any ending
                for ch, k in kids[n].items():
                    if ch == a and e <= edits[k]:
                        yield k, e, None
                    elif e + 1 <= edits[k]:
                        yield k, e + 1, None  # substitution
                    if a in kids[k] and a != ch and e + 1 <= edits[kids[k][a]]:
                        yield n, e + 1, (ch, kids[k][a])
                if e + 1 <= edits[n]:
                    yield n, e + 1, None  # insertion

        start = close([(0, 0, None)])
        ids, queue, step = {frozenset(): 0, start: 1}, [start], {}
        while queue:
            state = queue.pop()
            for a in [None, *sym]:
                to = close(follow(state, a))
                if to not in ids:
                    ids[to] = len(ids)
                    queue.append(to)
                step[ids[state], 0 if a is None else self.symbol[a]] = ids[to]
        self.step = np.zeros((len(ids), len(sym) + 1), np.int32)
        for (s, a), t in step.items():
            self.step[s, a] = t
        self.accept = np.zeros(len(ids), np.int8)  # 0 no, 1 exact, 2 misspelled
        for state, i in ids.items():
            fits = [e for n, e, swap in state if swap is None and end[n] and e <= most[n]]
            if fits:
                self.accept[i] = 1 if min(fits) == 0 else 2

    def run(self, codes: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """0, 1 (exact) or 2 (misspelled) for each word of a coded text."""
        state = np.ones(len(start), np.int32)
        alive = np.arange(len(start))
        i = 0
        while len(alive):
            alive = alive[size[alive] > i]
            s = self.step[state[alive], codes[start[alive] + i]]
            state[alive] = s
            alive = alive[s > 0]
            i += 1
        return self.accept[state]


class Scanner:
    """Hits of the automaton in blocks of texts, each with its context."""

    def __init__(self, terms, least: int = FUZZY, stems: bool = False):
        self.auto = Automaton(terms, least, stems)
        table = np.zeros(0x3000, np.uint8 if len(self.auto.symbol) < 250 else np.int32)
        for c, i in self.auto.symbol.items():
            table[min(ord(c), 0x2FFF)] = i
        self.table = table
        stop = np.zeros(0x3000, bool)
        for c in range(0x3000):
            stop[c] = not re.fullmatch(_TOKEN, chr(c))
        self.stop = stop

    def hits(self, texts: list[str]):
        """(row, start, end, misspelled) arrays over a list of texts."""
        low = "\n".join(t.lower() if len(t.lower()) == len(t) else "".join(
            c.lower() if len(c.lower()) == 1 else c for c in t) for t in texts)
        off = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
        cp = np.minimum(np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32), 0x2FFF)
        codes, inside = self.table[cp], ~self.stop[cp]
        edge = np.diff(np.concatenate(([0], inside.astype(np.int8), [0])))
        start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        # apostrophes and dashes at the edges do not belong to the word
        kind = self.auto.run(codes, start, stop - start)
        at = np.flatnonzero(kind)
        row = np.searchsorted(off, start[at], "right") - 1
        return row, start[at] - off[row], stop[at] - off[row], kind[at] == 2


class Marks:
    """Line ends and quotation marks of a text, found once."""

    def __init__(self, text: str):
        cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        at = lambda chars: np.flatnonzero(np.isin(cp, [ord(c) for c in chars]))
        self.size, self.cp = len(cp), cp
        self.lines, self.straight, self.opens, self.closes = at("\n"), at('"'), at(OPEN), at(CLOSE)

    def quoted(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Whether quotation marks enclose each span within the context window and line."""
        def last(places, x):  # the last place before x, else -1
            return np.concatenate(([-1], places))[np.searchsorted(places, x)]

        def first(places, x):  # the first place from x on, else the text's end
            return np.concatenate((places, [self.size]))[np.searchsorted(places, x)]

        line = last(self.lines, start) + 1
        before = last(self.opens, start)
        inside = before >= np.maximum(line, start - CONTEXT)
        inside &= first(self.closes, end) < np.minimum(end + CONTEXT, first(self.lines, end))
        # a straight mark opens if it is the line's first, third, ... one
        odd = (np.searchsorted(self.straight, start) - np.searchsorted(self.straight, line)) % 2 == 1
        bent = self.cp[np.maximum(before, 0)] != ord('"') if self.size else np.zeros(len(start), bool)
        return inside & (bent | odd)


def quoted(text: str, start: int, end: int) -> bool:
    """:meth:`Marks.quoted` of one span."""
    return bool(Marks(text).quoted(np.array([start]), np.array([end]))[0])


_CELLS = "abuse int, misspelled int, quoted int"


def _count(texts: list[str], scanner: Scanner, skip=frozenset()):
    """Per text the numbers of plain, misspelled and quoted hits."""
    out = np.zeros((len(texts), 3), np.int32)
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= BLOCK):
            size += len(texts[hi])
            hi += 1
        row, start, end, near = scanner.hits(texts[lo:hi])
        ends = np.flatnonzero(np.diff(row, append=-1)) + 1
        for a, b in zip(np.concatenate(([0], ends[:-1])), ends):  # the hits of one text
            r = lo + int(row[a])
            keep = np.array([not (near[i] and texts[r][start[i]:end[i]].lower() in skip) for i in range(a, b)])
            s, e, m = start[a:b][keep], end[a:b][keep], near[a:b][keep]
            inside = Marks(texts[r]).quoted(s, e)
            out[r] += np.bincount(np.where(inside, 2, m), minlength=3)
        lo = hi
    return out


def near_forms(train: DataFrame, scanner: Scanner) -> DataFrame:
    """(form, pos, neg): toxic and clean training documents that hold a misspelled form."""

    def run(batches):
        for b in batches:
            texts, ys, forms, out = [t or "" for t in b.column("text").to_pylist()], [], [], set()
            y = b.column("y").to_pylist()
            for i, t in enumerate(texts):
                out = {t[s:e].lower() for _, s, e, near in zip(*scanner.hits([t])) if near}
                forms += out
                ys += [y[i]] * len(out)
            yield pa.RecordBatch.from_arrays([pa.array(forms, pa.string()), pa.array(ys, pa.int32())],
                                             ["form", "y"])

    return train.select("text", "y").mapInArrow(run, "form string, y int").groupBy("form").agg(
        F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))


def other_words(forms, p: int, n: int, own: int = 0) -> frozenset:
    """Near forms that are words of clean documents (``own`` of which are left out), not misspellings."""
    return frozenset(f for f, pos, neg in forms
                     if neg > own and (pos + 0.5) / (neg - own + 0.5) * (n + 1.0) / (p + 1.0) < np.exp(LEAST_ODDS))


def count_hits(rows: DataFrame, scanner: Scanner | None, text_col: str = "text",
               skip=frozenset()) -> DataFrame:
    """``rows`` without the text, plus abuse, misspelled and quoted."""
    rest = [f for f in rows.schema.fields if f.name != text_col]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rest] + [_CELLS])
    names = [f.name for f in rest]

    def run(batches):
        for b in batches:
            texts = [t or "" for t in b.column(text_col).to_pylist()]
            c = _count(texts, scanner, skip) if scanner else np.zeros((len(texts), 3), np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(n) for n in names] + [pa.array(np.ascontiguousarray(c[:, j]))
                                                for j in range(3)],
                [*names, "abuse", "misspelled", "quoted"])

    return rows.mapInArrow(run, schema)


def features(a, m, q) -> np.ndarray:
    """Model inputs of a cell. A misspelled hit counts as a hit; a weight of its own
    moves away from that only as far as the training rows show."""
    a, m, q = (np.asarray(x, float) for x in (a, m, q))
    return np.stack([np.ones_like(a), a + m > 0, np.log1p(a + m), (m > 0) & (a == 0),
                     q > 0, np.log1p(q)], axis=-1).astype(float)


def fit(cells: list[tuple[int, int, int, int, int]], ridge: float = 0.05) -> np.ndarray:
    """Logistic weights by Newton steps from cells (abuse, misspelled, quoted, rows, toxic)."""
    c = np.array(cells, float).reshape(-1, 5)
    x, n, pos = features(c[:, 0], c[:, 1], c[:, 2]), c[:, 3], c[:, 4]
    w = np.zeros(x.shape[1])
    pen = np.full(len(w), ridge)
    pen[0] = 1e-3
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (pos - n * p) - pen * w
        hess = (x * (n * p * (1 - p))[:, None]).T @ x + np.diag(pen)
        d = np.linalg.solve(hess, grad)
        w += d
        if np.abs(d).max() < 1e-9:
            break
    return w


#: Hit counts above this fall into one training cell, which bounds the cells.
SATURATE = 20


def train_model(docs: DataFrame, labels: DataFrame) -> tuple:
    """(scanner, near forms that are other words, logistic weights) from the training rows.

    A near form seen in clean training documents is a word of its own. The model
    is fitted with each document's own evidence left out of that list, so that
    the weight of misspelled hits holds for documents not seen.
    """
    train = materialise(training_rows(docs, labels), "train")
    terms = learn_terms(train)
    scanner = Scanner(terms, LETTERS, True) if terms else None
    # at most the distinct words of the training sample, which is bounded
    forms = [tuple(r) for r in near_forms(train, scanner).collect()] if terms else []
    size = {r["y"]: r["n"] for r in train.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    p, n = size.get(1, 0), size.get(0, 0)
    skip = other_words(forms, p, n)
    hits = count_hits(train.where("y = 1"), scanner, skip=skip).unionByName(
        count_hits(train.where("y = 0"), scanner, skip=other_words(forms, p, n, 1)))
    s = F.lit(SATURATE)
    cells = hits.groupBy(
        F.least("abuse", s).alias("a"), F.least("misspelled", s).alias("m"),
        F.least("quoted", s).alias("q")).agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos"))
    rows = [tuple(r) for r in cells.collect()]  # at most 21 ** 3 cells
    return scanner, skip, fit(rows) if rows else None


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, abuse, misspelled, quoted."""
    scanner, skip, w = train_model(docs, labels)
    counted = count_hits(docs.select("doc_id", "text"), scanner, skip=skip)
    if w is None:
        score = F.lit(0.0)
    else:
        a, m, q = (F.least(F.col(c), F.lit(SATURATE)) for c in ("abuse", "misspelled", "quoted"))
        parts = [F.lit(1.0), (a + m > 0).cast("double"), F.log1p(a + m),
                 ((m > 0) & (a == 0)).cast("double"), (q > 0).cast("double"), F.log1p(q)]
        z = sum((F.lit(float(b)) * p for b, p in zip(w[1:], parts[1:])), F.lit(float(w[0])))
        score = 1.0 / (1.0 + F.exp(-z))
    return counted.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"),
        (score >= 0.5).cast("int").alias("predicted"), "abuse", "misspelled", "quoted")
