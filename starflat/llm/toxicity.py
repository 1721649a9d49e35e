"""Toxicity by a weighted finite-state grammar over clauses."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflat.llm.common import byte_rows, staged, texts

# Labelled documents that the model is fitted on, at most; entries it may keep.
TRAIN_DOCS = 10_000
LEXICON_SIZE = 20_000
FOLDS, HELD_OUT_FOLD = 4, 2
THRESHOLD = 0.3
STEMS = (4, 5, 6, 7)
KEPT_WORDS = 300_000
# A stem stays if it is in so many times the toxic documents of any form it begins.
GENERAL = 1.5

TOKEN = re.compile(r"[^\W\d_]+|[.!?;:\n]")
ENDS = frozenset(".!?;:\n")

# Closed classes of the grammar, in the languages of the corpus.
TARGETS = """you your yours u he she they them these those people du dich dir ihr euch sie tu te
toi vous votre ils elles eux tú te ti usted ustedes vosotros ellos ellas""".split()
NEGATIONS = """not no never isn aren don doesn without nicht kein keine nie ohne ne pas jamais
sans nunca sin jamás""".split()
REPORTS = """said says say wrote called quoted claims reported sagte sagt schrieb nannte dit
disait écrit appelé dijo dice escribió llamó""".split()
THREATS = """kill hurt destroy burn shoot stab beat punish töten schlagen verletzen zerstören
tuer frapper détruire brûler matar golpear destruir quemar""".split()

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = "I", "H", "T", "N", "R", "w"
NEGATED, QUOTED, AIMED, AIMED_THREAT = "n", "q", "A", "B"
SYMBOLS = (INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER)
SCORED = (INSULT, AIMED, NEGATED, QUOTED, THREAT, AIMED_THREAT)


@dataclass(frozen=True)
class Transducer:
    """Arcs ``(state, symbol) -> (state, output)``; where none is given a symbol stays as it is."""

    start: object
    arcs: dict = field(default_factory=dict)

    def step(self, state, symbol: str):
        return self.arcs.get((state, symbol), (state, symbol))


def negation(scope: int = 3) -> Transducer:
    """Insults within ``scope`` words after a negation become negated ones."""
    arcs = {}
    for state in range(scope + 1):
        later = max(state - 1, 0)
        for symbol in SYMBOLS:
            arcs[state, symbol] = (later, symbol)
        arcs[state, NEGATION] = (scope, NEGATION)
        if state:
            arcs[state, INSULT] = (later, NEGATED)
    return Transducer(0, arcs)


def reported() -> Transducer:
    """What follows a verb of saying is quoted."""
    return Transducer(
        "own",
        {
            ("own", REPORT): ("said", REPORT),
            ("said", INSULT): ("said", QUOTED),
            ("said", NEGATED): ("said", QUOTED),
            ("said", THREAT): ("said", QUOTED),
        },
    )


def aimed() -> Transducer:
    """Insults and threats of a clause that has named a target before are aimed at it."""
    return Transducer(
        "nobody",
        {
            ("nobody", TARGET): ("somebody", TARGET),
            ("somebody", INSULT): ("somebody", AIMED),
            ("somebody", THREAT): ("somebody", AIMED_THREAT),
        },
    )


def compose(*parts: Transducer) -> Transducer:
    """One transducer that runs all of them, each on the output of the one before."""
    start = tuple(p.start for p in parts)
    arcs, todo, seen = {}, [start], {start}
    while todo:
        state = todo.pop()
        for symbol in SYMBOLS:
            after, out = [], symbol
            for part, at in zip(parts, state):
                at, out = part.step(at, out)
                after.append(at)
            after = tuple(after)
            arcs[state, symbol] = (after, out)
            if after not in seen:
                seen.add(after)
                todo.append(after)
    return Transducer(start, arcs)


GRAMMAR = compose(negation(), reported(), aimed())
FEATURES = (*SCORED, "best")


class ClauseScorer:
    """Sums of arc weights per scored symbol over the clauses of a text."""

    def __init__(self, lexicon: dict[str, float]) -> None:
        self.lexicon = lexicon
        self.closed = {
            **dict.fromkeys(THREATS, (THREAT, 1.0)),
            **dict.fromkeys(REPORTS, (REPORT, 0.0)),
            **dict.fromkeys(NEGATIONS, (NEGATION, 0.0)),
            **dict.fromkeys(TARGETS, (TARGET, 0.0)),
        }
        self.known: dict[str, tuple[str, float] | None] = {}

    def lookup(self, word: str) -> tuple[str, float] | None:
        """The word's class and weight: the word or its heaviest stem in the lexicon."""
        weight = max((self.lexicon.get(f, 0.0) for f in forms(word)), default=0.0)
        if weight > 0:
            return INSULT, weight
        return self.closed.get(word)

    def features(self, text: str) -> list[float]:
        known, tokens = self.known, TOKEN.findall(text.lower())
        if len(known) > KEPT_WORDS:
            known.clear()
        for word in set(tokens).difference(known):
            known[word] = None if word in ENDS else self.lookup(word)
        sums = dict.fromkeys(FEATURES, 0.0)
        if not any(known[w] and known[w][0] in (INSULT, THREAT) for w in set(tokens)):
            return list(sums.values())
        arcs, state = GRAMMAR.arcs, GRAMMAR.start
        for word in tokens:
            if word in ENDS:
                state = GRAMMAR.start
                continue
            symbol, weight = known[word] or (OTHER, 0.0)
            state, out = arcs[state, symbol]
            if out in sums:
                sums[out] += weight
                sums["best"] = max(sums["best"], weight)
        return [math.log1p(v) for v in sums.values()]


def forms(word: str) -> list[str]:
    """The word, and its beginnings marked as stems."""
    return [word, *(f"{word[:n]}-" for n in STEMS if len(word) > n)]


@dataclass(frozen=True)
class Model:
    lexicon: dict[str, float]
    weights: list[float]
    bias: float


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from training: crc32 of its id as text. A NULL id is not in a fold."""
    fold = F.crc32(doc_id.cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == HELD_OUT_FOLD, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """``(toxic, text)`` of at most ``most`` labelled documents, chosen by a hash of the id.

    Contradicting labels of an id count as toxic. The chosen ids, at most
    ``most`` numbers, are sent to the documents, so texts do not move.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    return texts(docs).join(F.broadcast(chosen), "doc_id").select("toxic", "text")


def lexicon(rows: DataFrame, size: int) -> dict[str, float]:
    """Words and stems that mark toxic documents, with their log odds.

    Documents are counted per form; counts of a batch are added up before the
    shuffle. A form stays if its share of toxic documents cannot be chance among
    as many forms as were seen. At most ``size`` reach the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_class: tuple[Counter, Counter] = (Counter(), Counter())
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = {w for w in TOKEN.findall(text.lower()) if w not in ENDS}
                by_class[1 if toxic else 0].update({f for w in words for f in forms(w)})
            clean, bad = by_class
            found = list(clean | bad)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(found, pa.string()),
                    pa.array([bad[f] for f in found], pa.int64()),
                    pa.array([clean[f] for f in found], pa.int64()),
                ],
                ["form", "bad", "clean"],
            )

    totals = {r["toxic"]: r["n"] for r in rows.groupBy((F.col("toxic") > 0).alias("toxic")).agg(F.count(F.lit(1)).alias("n")).collect()}
    n_bad, n_clean = totals.get(True, 0), totals.get(False, 0)
    if not n_bad or not n_clean:
        return {}
    base = n_bad / (n_bad + n_clean)
    counts = staged(
        rows.mapInArrow(count, "form string, bad long, clean long")
        .groupBy("form")
        .agg(F.sum("bad").alias("bad"), F.sum("clean").alias("clean")),
        "forms",
    )
    share = F.col("bad") / (F.col("bad") + F.col("clean"))
    # How unlikely so large a share is by chance (Chernoff bound), as a logarithm.
    chance = F.col("bad") * F.log(share / base) + F.when(
        F.col("clean") > 0, F.col("clean") * F.log((1 - share) / (1 - base))
    ).otherwise(0.0)
    odds = F.log(((F.col("bad") + 0.25) / n_bad) / ((F.col("clean") + 0.25) / n_clean))
    kept = (
        counts.filter((F.col("bad") > 0) & (share > base))
        .select("form", "bad", chance.alias("chance"), odds.alias("odds"))
        .filter((F.col("chance") > math.log(max(counts.count(), 2)) + 1) & (F.col("odds") > 1))
        .orderBy(F.desc("chance"), "form")
        .limit(size)
    )
    return _general({r["form"]: (r["bad"], float(r["odds"])) for r in kept.collect()})


def _general(found: dict[str, tuple[int, float]]) -> dict[str, float]:
    """Without the stems that stand for one word only: they would match others that start alike."""
    widest: Counter = Counter()
    for form, (bad, _) in found.items():
        word = form.rstrip("-")
        for n in STEMS:
            if n < len(word):
                stem = f"{word[:n]}-"
                widest[stem] = max(widest[stem], bad)
    return {
        form: odds
        for form, (bad, odds) in found.items()
        if not form.endswith("-") or bad >= GENERAL * widest[form]
    }


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.diag([*[ridge] * (x.shape[1] - 1), 1e-3])
    for _ in range(50):
        p = _sigmoid(x @ w)
        slope = x.T @ (p - y) + penalty @ w
        bend = (x * (p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS, size: int = LEXICON_SIZE) -> Model:
    """Insult weights and the weights of the grammar's outputs, from labelled rows outside the held-out fold."""
    rows = staged(training_rows(docs, labels, most), "toxic-train")
    found = lexicon(rows, size)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = ClauseScorer(found)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([scorer.features(t) for t in batch.column(1).to_pylist()], pa.list_(pa.float64()))],
                ["toxic", "x"],
            )

    # At most `most` short rows of numbers.
    seen = rows.mapInArrow(measure, "toxic int, x array<double>").collect()
    if not seen:
        return Model(found, [0.0] * len(FEATURES), -3.0)
    x = np.array([r["x"] for r in seen], float)
    y = np.array([r["toxic"] > 0 for r in seen], float)
    w = _logistic(x, y)
    return Model(found, w[:-1].tolist(), float(w[-1]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score)`` for every row, from the whole text alone.

    NULL and empty texts match nothing and get the score of the bias. Repeated
    rows stay repeated; an empty table gives no rows.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = ClauseScorer(model.lexicon)
        weights = np.array(model.weights)
        for keys, rows in byte_rows(batches):
            x = np.array([scorer.features(r.decode("utf-8", "replace")) for r in rows]).reshape(len(keys), -1)
            found = _sigmoid(x @ weights + model.bias) if len(keys) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([keys, pa.array(found)], ["doc_id", "score"])

    return texts(docs).mapInArrow(apply, "doc_id long, score double")


def judge(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every document."""
    scored = score(docs, fit(docs, labels, most))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def reject(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> DataFrame:
    """``docs`` without the documents judged toxic; all columns stay and nothing is shuffled."""
    model = fit(docs, labels, most)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = ClauseScorer(model.lexicon)
        weights = np.array(model.weights)
        for batch in batches:
            column = batch.column("text")
            x = np.array([scorer.features(v.as_py() or "") for v in column]).reshape(len(batch), -1)
            score = _sigmoid(x @ weights + model.bias) if len(batch) else np.zeros(0)
            yield batch.filter(pa.array(score < THRESHOLD))

    return docs.mapInArrow(keep, docs.schema)
