"""Toxicity by a lexicon, misspellings and context.

1. Lexicon: words that labelled documents tie to label 1 (a Wilson lower bound on their precision).
2. Levenshtein automaton over the lexicon's trie: states are sets of (trie node, edits spent), built as
   words ask for them, so a word costs one table step per letter and most words die after a few.  Terms
   of 5 letters or more may have one edit, of 8 or more two.  A misspelling counts unless the sample
   shows the same spelling in harmless documents.
3. Context windows: a match inside quotation marks, or near words of reporting, is told from one near
   words that address the reader.  Counts, densities and contexts go to a logistic model.

Fitting reads a sample of at most ``SAMPLE`` labelled training rows, chosen by hash; only spellings near
the lexicon and the features of that sample reach the driver.  Training rows are those whose crc32 of the
doc_id's text is not 0 modulo 5.  Scores depend on the text alone.  No word of the sample that passes the bound
is left out of the lexicon.

Defined results: null and empty texts get the model's score for no matches; without training rows of
both labels the score is the share of toxic ones (0 if none); repeated rows score alike, and of the texts of a
repeated id the least is fitted on; an empty table
gives an empty result; a null doc_id is not held out; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.common import arrow_batches

SAMPLE = 20_000
WORDS_KEPT = 500_000
FOLDS = 5
EDGES = "#*$%&|<>.,;:!?¡¿…()[]{}\"'`´“”„‘’‚«»‹›-–—_~=+/\\@^"
OPEN = "\"“”„‘‚«»‹›`"
REPORT = {"said", "says", "say", "called", "wrote", "word", "term", "quote", "quoted", "insult", "dit", "mot", "terme", "insulte", "sagte", "schrieb", "wort", "begriff", "dijo", "palabra", "insulto", "llamó"}
ADDRESS = {"you", "your", "you're", "u", "ur", "he", "she", "they", "du", "dein", "ihr", "sie", "tu", "toi", "vous", "ton", "usted", "tú", "eres", "vosotros"}


def edits_for(term: str) -> int:
    return 2 if len(term) >= 8 else 1 if len(term) >= 5 else 0


class Automaton:
    """Nearest lexicon term of a word within the term's allowed edits."""

    def __init__(self, terms: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.most: list[int] = [0]
        for t in terms:
            node, k = 0, edits_for(t)
            self.most[0] = max(self.most[0], k)
            for c in t:
                nxt = self.children[node].get(c)
                if nxt is None:
                    nxt = self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.most.append(0)
                node = nxt
                self.most[node] = max(self.most[node], k)
            self.term[node] = t
        self._reset()

    def _reset(self) -> None:
        self.ids: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.accepts: list[tuple[int, str] | None] = []
        self.dead = self._state({})
        self.start = self._state({0: 0})

    def _state(self, best: dict[int, int]) -> int:
        """The state of a set of (node, fewest edits), closed under letters the word leaves out."""
        stack = list(best)
        while stack:
            node = stack.pop()
            e = best[node] + 1
            for child in self.children[node].values():
                if e <= self.most[child] and e < best.get(child, 99):
                    best[child] = e
                    stack.append(child)
        key = frozenset(best.items())
        known = self.ids.get(key)
        if known is None:
            known = self.ids[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
            ends = [(e, self.term[n]) for n, e in best.items() if self.term[n] and e <= edits_for(self.term[n])]
            self.accepts.append(min(ends) if ends else None)
        return known

    def _step(self, state: int, c: str) -> int:
        best: dict[int, int] = {}
        for node, e in self.sets[state]:
            if e + 1 <= self.most[node] and e + 1 < best.get(node, 99):
                best[node] = e + 1  # a letter too many
            for letter, child in self.children[node].items():
                cost = e + (letter != c)
                if cost <= self.most[child] and cost < best.get(child, 99):
                    best[child] = cost
        nxt = self.steps[state][c] = self._state(best)
        return nxt

    def match(self, word: str) -> tuple[int, str] | None:
        if len(self.sets) > 50_000:
            self._reset()
        state, steps, dead = self.start, self.steps, self.dead
        for c in word:
            nxt = steps[state].get(c)
            state = self._step(state, c) if nxt is None else nxt
            if state == dead:
                return None
        return self.accepts[state]


def core(word: str) -> str:
    return word.strip(EDGES)


@dataclass
class Model:
    weight: dict[str, float] = field(default_factory=dict)  # term -> log odds
    harmless: set[str] = field(default_factory=set)  # spellings near a term that are words of their own
    coef: list[float] = field(default_factory=list)
    mean: list[float] = field(default_factory=list)
    scale: list[float] = field(default_factory=list)
    bias: float = 0.0


class Scorer:
    """Features of texts under a model; matches of words are cached, the full cache emptied."""

    NAMES = ("exact", "near", "direct", "quoted", "reported", "addressed", "weight", "density", "kinds", "any")

    def __init__(self, model: Model):
        self.model, self.auto = model, Automaton(sorted(model.weight))
        self.known: set[str] = set()
        self.hits: dict[str, tuple[int, str]] = {}

    def learn(self, words: set[str]) -> None:
        new = words - self.known
        if len(self.known) + len(new) > WORDS_KEPT:
            self.known, self.hits, new = set(), {}, words
        match, harmless = self.auto.match, self.model.harmless
        for w in new:
            c = core(w)
            m = match(c) if c and c not in harmless else None
            if m:
                self.hits[w] = m
        self.known |= new

    def features(self, texts: list[str | None]) -> np.ndarray:
        split = [(t or "").lower().split() for t in texts]
        sets = [set(w) for w in split]
        self.learn(set().union(*sets))
        out = np.zeros((len(texts), len(self.NAMES)))
        hits = self.hits
        for row, words, own in zip(out, split, sets):
            if own.isdisjoint(hits):
                continue
            at = [i for i, w in enumerate(words) if w in hits]
            terms = set()
            exact = near = direct = quoted = reported = addressed = 0
            weight = 0.0
            for i in at:
                d, t = hits[words[i]]
                exact, near = exact + (d == 0), near + (d > 0)
                weight += self.model.weight[t] / (1 + d)
                terms.add(t)
                around = words[max(0, i - 5) : i + 6]
                plain = [core(w) for w in around]
                marks = sum(w[:1] in OPEN or w[-1:] in OPEN for w in (words[i], *around[max(0, min(i, 5) - 2) : min(i, 5) + 3]))
                q = words[i][:1] in OPEN and words[i].rstrip(".,;:!?")[-1:] in OPEN or marks > 1
                r = not REPORT.isdisjoint(plain)
                quoted, reported = quoted + q, reported + r
                addressed += not ADDRESS.isdisjoint(plain)
                direct += not q and not r
            row[:] = (
                math.log1p(exact), math.log1p(near), math.log1p(direct), math.log1p(quoted), math.log1p(reported), math.log1p(addressed),
                math.log1p(max(weight, 0.0)), math.log1p(100 * len(at) / len(words)), len(terms), 1.0,
            )
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        z = np.full(len(texts), self.model.bias)
        if self.model.coef:
            # summed row by row, so that a score doesn't depend on the texts beside it
            z = z + ((self.features(texts) - self.model.mean) / self.model.scale * self.model.coef).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-3) -> tuple[np.ndarray, float]:
    """Newton steps on the regularised log likelihood."""
    x1 = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = np.zeros(x1.shape[1])
    reg = np.full(len(w), l2 * len(x))
    reg[-1] = 1e-9
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        g = x1.T @ (p - y) + reg * w
        h = (x1 * (p * (1 - p))[:, None]).T @ x1 + np.diag(reg + 1e-6)
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def _wilson(a: int, n: int, z: float = 1.96) -> float:
    p = a / n
    return (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fits lexicon, harmless spellings and weights on at most ``sample`` labelled training rows."""
    own = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).where(~held_out())
    own = own.groupBy("doc_id").agg(F.max("toxic").alias("y"))
    ids = own.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(sample)
    # at most ``sample`` ids: bounded, so it may be broadcast
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(ids), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.first("y").alias("y"), F.min("text").alias("text"))  # of a repeated id always the same text
    rows = rows.persist()
    try:
        totals = dict(rows.groupBy("y").count().collect())
        n1, n0 = totals.get(1, 0), totals.get(0, 0)
        if not n1 or not n0:
            share = n1 / (n1 + n0) if n1 + n0 else 0.0
            return Model(bias=math.log(max(share, 1e-9) / max(1 - share, 1e-9)))

        def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                a: dict[str, list[int]] = {}
                for t, y in zip(b.column("text").to_pylist(), b.column("y").to_pylist()):
                    for w in {core(x) for x in (t or "").lower().split()}:
                        a.setdefault(w, [0, 0])[y] += 1
                yield pa.RecordBatch.from_arrays([pa.array(list(a), pa.string()), pa.array([v[0] for v in a.values()], pa.int64()), pa.array([v[1] for v in a.values()], pa.int64())], ["w", "n0", "n1"])

        words = arrow_batches(rows.select("text", F.col("y").cast("int").alias("y"))).mapInArrow(spell, "w string, n0 long, n1 long")
        words = words.groupBy("w").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).where("length(w) >= 3").persist()
        terms = {}
        for r in words.where("n1 >= 5 and n1 > n0").collect():  # at most the sample's vocabulary
            if _wilson(r["n1"], r["n1"] + r["n0"]) > 0.6:
                terms[r["w"]] = math.log((r["n1"] + 0.5) / (n1 + 1) / ((r["n0"] + 0.5) / (n0 + 1)))
        model = Model(weight=terms)
        if not terms:
            model.bias = math.log(n1 / n0)
            return model
        shared = Automaton(sorted(terms))

        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                hit = [m is not None and m[0] > 0 for m in map(shared.match, b.column("w").to_pylist())]
                yield b.filter(pa.array(hit, pa.bool_()))

        # spellings near a term that the sample has in harmless documents; at most the sample's vocabulary
        found = words.where("n0 > 0").mapInArrow(near, words.schema).collect()
        model.harmless = {r["w"] for r in found if r["n1"] <= 3 * r["n0"]}
        scorer = Scorer(model)

        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                f = scorer.features(b.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([b.column("y"), pa.array(list(f), pa.list_(pa.float64()))], ["y", "f"])

        got = rows.select("text", F.col("y").cast("int").alias("y")).mapInArrow(measure, "y int, f array<double>").toPandas()
        words.unpersist()
    finally:
        rows.unpersist()
    x, y = np.stack(got["f"].to_numpy()), got["y"].to_numpy().astype(float)
    order = np.lexsort((y, *x.T))  # a fixed order, so that sums don't depend on the partitioning
    x, y = x[order], y[order]
    mean, scale = x.mean(0), x.std(0) + 1e-9
    coef, bias = _logistic((x - mean) / scale, y)
    model.coef, model.mean, model.scale, model.bias = coef.tolist(), mean.tolist(), scale.tolist(), bias
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    slim = docs.select("doc_id", held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    schema = T.StructType([slim.schema["doc_id"], T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    shared = slim.sparkSession.sparkContext.broadcast(model)  # terms and spellings of the sample's documents, which SAMPLE bounds

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for b in batches:
            s = scorer.scores(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], schema.names)

    return arrow_batches(slim).mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
