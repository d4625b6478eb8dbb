"""Toxicity scores from a factorization machine over hashed terms."""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from haulbook.llm.common import crc_of, discard, giving_back, stored, text_or_empty

BUCKETS = 1 << 18        # hashed terms
LABELLED = 12_000        # bound on the labelled ids, and then on the rows, that the model is fitted on
FACTORS = 4
EPOCHS = 30
EVIDENCE = 15.0          # least chi-square of a term with the label for it to enter the model
REJECT = 0.7
HELD, LONG = 200_000, 64   # words whose buckets a task holds, and the longest of them

_word = re.compile(r"[^\W_]+")


def term_ids(word: str) -> tuple[int, ...]:
    """Buckets of a word: the word itself and its first two to eight letters."""
    return tuple({zlib.crc32(word.encode()) % BUCKETS}
                 | {zlib.crc32(b"^" + word[:k].encode()) % BUCKETS for k in range(2, 9) if len(word) >= k})


class _Terms(dict):
    """Packed buckets of words, emptied when full. Long words are never held."""

    def __missing__(self, word: str) -> bytes:
        out = array("i", term_ids(word)).tobytes()
        if len(word) <= LONG:
            if len(self) >= HELD:
                self.clear()
            self[word] = out
        return out


def text_terms(text: str, known: dict[str, bytes]) -> np.ndarray:
    """The distinct buckets of a text, in order."""
    return np.unique(np.frombuffer(b"".join(map(known.__getitem__, set(_word.findall(text.lower())))), dtype=np.int32))


class Machine:
    """Score = bias + sum of term weights + sum over pairs of present terms of their factors' products.

    The pairs let two terms mean together what neither means alone. Terms enter only if
    their presence goes with the label beyond chance; the rest weigh nothing.
    """

    def __init__(self, terms: np.ndarray, bias: float, weights: np.ndarray, factors: np.ndarray):
        self.terms, self.bias, self.weights, self.factors = terms, bias, weights, factors
        self.place = np.full(BUCKETS, -1, dtype=np.int32)
        self.place[terms] = np.arange(len(terms))

    def raw(self, places: np.ndarray, starts: np.ndarray) -> np.ndarray:
        rows = len(starts) - 1
        owner = np.repeat(np.arange(rows), np.diff(starts))
        linear = np.bincount(owner, self.weights[places], rows)
        pairs = np.zeros(rows)
        for f in range(self.factors.shape[1]):
            v = self.factors[places, f]
            pairs += np.bincount(owner, v, rows) ** 2 - np.bincount(owner, v * v, rows)
        return self.bias + linear + pairs / 2

    def score(self, docs: list[np.ndarray]) -> np.ndarray:
        own = [p[p >= 0] for p in (self.place[d] for d in docs)]
        starts = np.concatenate([[0], np.cumsum([len(p) for p in own])]).astype(np.int64)
        places = np.concatenate(own) if own else np.zeros(0, np.int32)
        return 1 / (1 + np.exp(-np.clip(self.raw(places, starts), -30, 30)))


def fit(places: list[np.ndarray], labels: np.ndarray, terms: np.ndarray, factors: int = FACTORS, epochs: int = EPOCHS, seed: int = 7) -> Machine:
    """Log loss by Adam on small batches. ``places`` lists the terms that each text holds, as places in ``terms``.
    Without both labels the score is the smoothed share of label 1."""
    n, positive = len(labels), float(labels.sum())
    prior = (positive + 1) / (n + 2)
    bias = float(np.log(prior / (1 - prior)))
    if positive in (0, n):
        return Machine(np.zeros(0, np.int64), bias, np.zeros(0), np.zeros((0, factors)))
    rng = np.random.default_rng(seed)
    model = Machine(terms, bias, np.zeros(len(terms)), rng.normal(0, 0.05, (len(terms), factors)))
    starts = np.concatenate([[0], np.cumsum([len(p) for p in places])]).astype(np.int64)
    flat = np.concatenate(places).astype(np.int64)
    state = [np.zeros(len(terms)), np.zeros(len(terms)), np.zeros_like(model.factors), np.zeros_like(model.factors), 0.0, 0.0]
    step, size = 0, 256
    for epoch in range(epochs):
        rate = 0.05 if epoch < epochs * 2 // 3 else 0.01
        order = rng.permutation(n)
        for rows in (order[i:i + size] for i in range(0, n, size)):
            counts = starts[rows + 1] - starts[rows]
            cut = np.concatenate([[0], np.cumsum(counts)])
            own = flat[np.repeat(starts[rows] - cut[:-1], counts) + np.arange(cut[-1])]
            who = np.repeat(np.arange(len(rows)), counts)
            error = (1 / (1 + np.exp(-np.clip(model.raw(own, cut), -30, 30))) - labels[rows]) / len(rows)
            grads = [np.bincount(own, error[who], len(terms)) + 1e-4 * model.weights, np.empty_like(model.factors)]
            for f in range(factors):
                v = model.factors[own, f]
                total = np.bincount(who, v, len(rows))
                grads[1][:, f] = np.bincount(own, error[who] * (total[who] - v), len(terms)) + 1e-3 * model.factors[:, f]
            step += 1
            for value, grad, k in ((model.weights, grads[0], 0), (model.factors, grads[1], 2)):
                state[k] = 0.9 * state[k] + 0.1 * grad
                state[k + 1] = 0.99 * state[k + 1] + 0.01 * grad * grad
                value -= rate * (state[k] / (1 - 0.9 ** step)) / (np.sqrt(state[k + 1] / (1 - 0.99 ** step)) + 1e-6)
            state[4] = 0.9 * state[4] + 0.1 * error.sum()
            state[5] = 0.99 * state[5] + 0.01 * error.sum() ** 2
            model.bias -= rate * (state[4] / (1 - 0.9 ** step)) / (np.sqrt(state[5] / (1 - 0.99 ** step)) + 1e-6)
    return model


def labelled_terms(docs: DataFrame, labels: DataFrame, most: int = LABELLED) -> DataFrame:
    """doc_id, toxic and terms of at most ``most`` labelled rows that are not held out, those with the smallest id hashes.

    Rows whose crc32 of the id mod 3 is 1 are held out. Rows without id or label are left
    out; an id labelled more than once is toxic if any label says so. The labelled ids
    are broadcast: the bound on their number bounds their size. Documents may repeat an id, so the rows are bounded again.
    """
    wanted = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (crc_of() % 3 != 1))
              .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))

    @giving_back
    def terms(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Terms()
        for frame in frames:
            yield pd.DataFrame({"doc_id": frame["doc_id"], "toxic": frame["toxic"], "terms": [text_terms(t, known) for t in frame["text"]]})

    rows = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(wanted), "doc_id").mapInPandas(terms, "doc_id long, toxic int, terms array<int>")
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("terms")).limit(most)


def telling_terms(rows: DataFrame) -> np.ndarray:
    """The buckets whose presence goes with the label beyond chance (chi-square), counted by Spark; there are ``BUCKETS`` at most."""
    n, positive = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < positive < n:
        return np.zeros(0, dtype=np.int64)
    counts = rows.select("toxic", F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("seen"), F.sum("toxic").alias("with_label"))
    expected = F.col("seen") * F.lit(positive / n)
    spread = expected * F.lit(1 - positive / n) * (1 - F.col("seen") / F.lit(float(n)))
    chi = F.when(spread > 0, F.pow(F.col("with_label") - expected, F.lit(2.0)) / spread)
    chosen = counts.filter((chi >= EVIDENCE) & (F.least(F.col("seen"), F.lit(n) - F.col("seen")) >= 5)).select("term").collect()
    return np.array(sorted(r.term for r in chosen), dtype=np.int64)


def train(docs: DataFrame, labels: DataFrame, most: int = LABELLED) -> Machine:
    """A machine from at most ``most`` labelled rows. Only the chosen terms of each row reach the one task that fits it,
    and only the chosen terms' numbers reach the driver."""
    rows = stored(labelled_terms(docs, labels, most))
    terms = telling_terms(rows)

    def own_places(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = np.full(BUCKETS, -1, dtype=np.int32)
        place[terms] = np.arange(len(terms))
        for frame in frames:
            held = [place[np.asarray(t, dtype=np.int64)] for t in frame["terms"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "toxic": frame["toxic"], "places": [p[p >= 0] for p in held]})

    def fitted(rows: pd.DataFrame) -> pd.DataFrame:
        # A fixed order, so that reruns fit the same machine.
        rows = rows.assign(_at=[tuple(p) for p in rows["places"]]).sort_values(["doc_id", "toxic", "_at"], kind="stable")
        model = fit([np.asarray(p, dtype=np.int32) for p in rows["places"]], rows["toxic"].to_numpy(dtype=float), terms)
        return pd.DataFrame({"term": np.append(model.terms, -1), "weight": np.append(model.weights, model.bias),
                             "factors": [*model.factors, np.zeros(model.factors.shape[1])]})

    found = (rows.mapInPandas(own_places, "doc_id long, toxic int, places array<int>").withColumn("_all", F.lit(0))
             .groupBy("_all").applyInPandas(lambda f: fitted(f), "term long, weight double, factors array<double>").orderBy("term").collect())
    discard(rows)
    if not found:
        return fit([], np.zeros(0), terms)
    bias, own = found[0].weight, found[1:]
    return Machine(np.array([r.term for r in own], dtype=np.int64), bias, np.array([r.weight for r in own]),
                   np.array([r.factors for r in own]).reshape(len(own), len(found[0].factors)))


def toxic_score(docs: DataFrame, model: Machine, text_col: str = "text") -> Column:
    """The score of a text, 0 to 1; null counts as empty, whose score follows from the bias alone."""
    shared = docs.sparkSession.sparkContext.broadcast((model.terms, model.bias, model.weights, model.factors))

    @F.pandas_udf("double")
    @giving_back
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known, machine = _Terms(), Machine(*shared.value)
        for part in texts:
            yield pd.Series(machine.score([text_terms(t, known) for t in part]))

    return score(text_or_empty(text_col))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: ``doc_id``, ``held_out``, ``score`` and ``predicted`` (1 from 0.7 up).

    Whole texts are scored, row by row, so repeated rows score alike and a null id is no
    obstacle (it is not held out unless its empty text's remainder is 1). Without any
    usable label every score is 0.5. Language, source and id are never inputs of a score.
    """
    scored = docs.select("doc_id", (crc_of() % 3 == 1).alias("held_out"), toxic_score(docs, train(docs, labels)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= REJECT).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents with a score below the threshold, with the columns they came with."""
    names = {f"c{i}": n for i, n in enumerate(docs.columns)}
    plain = docs.select(*[docs[n].alias(c) for c, n in names.items()], docs["text"].alias("_text"))
    kept = plain.withColumn("_score", toxic_score(plain, train(docs, labels), "_text")).filter(F.col("_score") < REJECT)
    return kept.select(*[F.col(c).alias(n) for c, n in names.items()])
