"""Mixing documents to target weights of domains, with soft membership.

A classifier learned from a labelled table gives each document a posterior over domains. A rate per
document, not negative, is then fitted so that the expected tokens of each domain (rate times tokens times
posterior) match a target: least squares by projected gradient. All that an iteration moves is a sum for
each domain; a document's rate is a function of its posterior and of the short list of gradients so far.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm.arrowtext import blocks, coded, filled, split_words
from wattloom.sources.tables import stage

# Labelled documents that the classifier is fitted on: the first by a hash of their identifiers.
LABELLED = 20_000
# Words are counted by hash in so many cells, once for each document, which bounds the model.
CELLS = 1 << 16
# Cells that the model uses: those with the clearest differences between domains.
FEATURES = 1_000
# Standard deviations from chance beyond which a difference is clear.
SURE = 4.0
# Steps of the fit, their size, and the penalty on squared weights.
FIT_STEPS, FIT_SIZE, PENALTY = 200, 0.1, 1e-4

MAX_STEPS, TOLERANCE = 60, 1e-4

_CELLS = "domain int, cell int, n bigint"
_CHOSEN = "domain int, held boolean, cells array<int>"


def _cells(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each cell of each text once, the text that it is of, and the number of words of each text.

    A word, A-Z lower-cased and without punctuation at its ends, has a cell; so has what is left of it
    without letters, such as a run of symbols or digits.
    """
    words, starts = split_words(pc.ascii_lower(filled(texts)))
    names, codes = coded(words)
    shapes = pc.replace_substring_regex(names, r"[a-z\x{80}-\x{10FFFF}]+", "").cast(pa.large_binary()).to_pylist()
    names = pc.utf8_trim(names, ".,;:!?\"'()").cast(pa.large_binary()).to_pylist()
    sizes = np.diff(starts)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    keys = []
    for strings, seed in ((names, 0), (shapes, 1)):
        hashed = np.array([xxhash.xxh3_64_intdigest(x, seed) % CELLS if x else -1 for x in strings], np.int64)
        cells = hashed[codes] if len(codes) else np.empty(0, np.int64)
        keys.append((owner * CELLS + cells)[cells >= 0])
    both = np.unique(np.concatenate(keys))
    return both % CELLS, both // CELLS, sizes


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches, 0):
        cells, owner, _ = _cells(batch.column(0))
        domain = batch.column(1).to_numpy()[owner].astype(np.int64)
        keys, counts = np.unique(domain * CELLS + cells, return_counts=True)
        if len(keys):
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys // CELLS, pa.int32()), pa.array(keys % CELLS, pa.int32()), pa.array(counts)],
                names=["domain", "cell", "n"],
            )


def _choose(features: np.ndarray):
    """The cells of each labelled text that are among the features, by their place there."""

    def choose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(CELLS, -1, np.int32)
        place[features] = np.arange(len(features), dtype=np.int32)
        for batch in blocks(batches, 0):
            cells, owner, sizes = _cells(batch.column(0))
            cells, owner = place[cells], owner[place[cells] >= 0]
            offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(sizes)))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(cells[cells >= 0]))
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), lists], names=["domain", "held", "cells"])

    return choose


def _softmax(logits: np.ndarray) -> np.ndarray:
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


@dataclass(frozen=True)
class DomainModel:
    """Softmax regression on the presence of cells: a bias and a weight of each cell for each domain."""

    bias: np.ndarray
    weights: np.ndarray

    def posteriors(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The posterior of each text over the domains, and its number of words."""
        cells, owner, sizes = _cells(texts)
        sums = [np.bincount(owner, weights=w[cells], minlength=len(sizes)) for w in self.weights]
        return _softmax(np.array(sums).T.reshape(-1, len(self.bias)) + self.bias), sizes


def _regression(cells: np.ndarray, owner: np.ndarray, domain: np.ndarray, held: np.ndarray, n_features: int, n_domains: int) -> tuple[np.ndarray, np.ndarray]:
    """Bias and weights by gradient steps with momentum and a scale of their own for each weight; of all steps the best on held-out rows."""
    n, train = len(domain), (~held).astype(float)
    right = np.eye(n_domains)[domain]
    theta = np.zeros((n_features + 1, n_domains))
    theta[-1] = np.log((right[~held].sum(axis=0) + 1) / (max(train.sum(), 1) + n_domains))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    best, chosen = np.inf, theta
    check = held if held.any() else ~held
    for step in range(1, FIT_STEPS + 1):
        logits = np.stack([np.bincount(owner, weights=theta[cells, k], minlength=n) for k in range(n_domains)], axis=1) + theta[-1]
        p = _softmax(logits)
        loss = -np.log(p[check, domain[check]] + 1e-12).mean()
        if loss < best:
            best, chosen = loss, theta.copy()
        slope = (p - right) * train[:, None] / max(train.sum(), 1)
        gradient = np.empty_like(theta)
        for k in range(n_domains):
            gradient[:-1, k] = np.bincount(cells, weights=slope[owner, k], minlength=n_features) + PENALTY * theta[:-1, k]
        gradient[-1] = slope.sum(axis=0)
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient**2
        theta = theta - FIT_SIZE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
    return chosen[-1], chosen[:-1].T


def fit_domains(
    docs: DataFrame, labels: DataFrame, domain: Column, n_domains: int, sample: int = LABELLED
) -> DomainModel:
    """A word model from at most ``sample`` labelled rows of ``docs`` (doc_id, text).

    ``domain`` is a number from 0 over ``labels``, null where a row belongs to none. A document with several labels
    has the largest. Cells are chosen from counts over the sample; the driver gets the chosen cells
    of the sample's documents, at most ``sample`` rows of ``FEATURES`` numbers, and fits. A fifth of the
    sample is held out to choose when to stop. Without labels every posterior is uniform.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), domain.cast("int").alias("domain")).where("doc_id IS NOT NULL AND domain IS NOT NULL")
    chosen = known.groupBy("doc_id").agg(F.max("domain").alias("domain")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    held = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(5)) == 0
    # At most ``sample`` rows of 13 bytes.
    few = F.broadcast(stage(chosen.withColumn("held", held), "domain-sample"))
    labelled = stage(docs.join(few, "doc_id").select("text", "domain", "held"), "labelled-texts")

    counted = labelled.where("NOT held").select("text", "domain").mapInArrow(_count, _CELLS).groupBy("domain", "cell").agg(F.sum("n").alias("n"))
    found = counted.toArrow()  # at most a row for each domain and cell
    table = np.zeros((n_domains, CELLS))
    table[found["domain"].to_numpy(), found["cell"].to_numpy()] = found["n"].to_numpy()
    members = np.zeros(n_domains)
    for row in labelled.where("NOT held").groupBy("domain").count().collect():
        members[row["domain"]] = row["count"]
    chance = table.sum(axis=0) * (members / max(members.sum(), 1))[:, None]
    clear = (np.abs(table - chance) / np.sqrt(chance + 1)).max(axis=0)
    features = np.sort(np.argsort(-clear, kind="stable")[:FEATURES])
    features = features[clear[features] > SURE]

    rows = labelled.mapInArrow(_choose(features), _CHOSEN).toArrow()
    lists = rows["cells"].combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    owner = np.repeat(np.arange(len(lists)), sizes)
    # Rows may come in any order, which moves the last bits of a sum; rounding keeps the model repeatable.
    bias, weights = _regression(lists.flatten().to_numpy(), owner, rows["domain"].to_numpy(), rows["held"].to_numpy(), len(features), n_domains)
    full = np.zeros((n_domains, CELLS), np.float32)
    full[:, features] = np.round(weights, 4)
    return DomainModel(np.round(bias, 4), full)


def predict_domains(docs: DataFrame, model: DomainModel, names: Sequence[str]) -> DataFrame:
    """doc_id, n_tokens and a posterior column for each domain, for each row of ``docs`` (doc_id, text)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    columns = ["doc_id", "n_tokens", *names]

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, 1):
            p, sizes = sent.value.posteriors(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(sizes), *(pa.array(p[:, k]) for k in range(len(names)))], names=columns
            )

    return docs.mapInArrow(predict, "doc_id bigint, n_tokens bigint, " + ", ".join(f"{n} double" for n in names))


def _rate(names: Sequence[str], steps: list[np.ndarray]) -> Column:
    """The rate after the given steps: from 1, each step goes down its gradient and is cut at 0."""
    rate = F.lit(1.0)
    for step in steps:
        slope = sum((F.col(n) * float(s) for n, s in zip(names, step)), F.lit(0.0))
        rate = F.greatest(F.lit(0.0), rate - slope)
    return rate


def fit_rates(mixed: DataFrame, names: Sequence[str], targets: Sequence[float]) -> tuple[DataFrame, np.ndarray, list[float]]:
    """``mixed`` with the column rate; the domain totals that it gives; the residual after each step.

    Minimises the squared distance of (sum over documents of rate * n_tokens * posterior) from
    ``targets`` over rates of 0 or more, by projected gradient from rate 1. The gradient is taken in the
    metric in which a document counts by its tokens, and is scaled by the domains' Gram matrix, which
    makes the first step exact where no rate is cut off; a step that does not help is halved. Targets far
    out of reach may end at rates that are not yet the nearest ones; the totals returned say how far.
    """
    k = len(names)
    weight = F.col("n_tokens").cast("double")
    goal = np.asarray(targets, float)
    unit = max(float(goal.sum()), 1.0)

    def measure(rows: DataFrame, rate: Column) -> tuple[np.ndarray, np.ndarray]:
        """Domain totals, and the Gram matrix of the documents whose rate is not 0."""
        rated = rows.withColumn("rate", rate)
        live = F.when(F.col("rate") > 0, weight).otherwise(0.0)
        sums = [F.sum(F.col("rate") * weight * F.col(n)) for n in names]
        sums += [F.sum(live * F.col(a) * F.col(b)) for a in names for b in names]
        found = np.array([x or 0.0 for x in rated.agg(*sums).first()])
        # The order of a sum differs between runs in its last bits; rounding keeps rates repeatable.
        found = np.array([float(f"{x:.9g}") for x in found])
        return found[:k], found[k:].reshape(k, k)

    rows, steps, size = mixed, [], 1.0
    totals, gram = measure(rows, F.lit(1.0))
    residuals = [float(np.linalg.norm(totals - goal) / unit)]
    while residuals[-1] > TOLERANCE and len(residuals) <= MAX_STEPS and size > 1e-3:
        scale = np.linalg.pinv(gram + 1e-9 * np.trace(gram) * np.eye(k))
        step = size * (scale @ (totals - goal))
        new_totals, new_gram = measure(rows, _rate(names, [*steps, step]))
        residual = float(np.linalg.norm(new_totals - goal) / unit)
        if residual < residuals[-1]:
            steps, totals, gram, size = [*steps, step], new_totals, new_gram, min(1.0, size * 2)
            residuals.append(residual)
        else:
            size /= 2
    return rows.withColumn("rate", _rate(names, steps)), totals, residuals


def copies(rate: Column, identifier: Column, seed: int) -> Column:
    """Whole copies whose expectation is the rate: the fraction is drawn by a hash of the identifier."""
    draw = F.pmod(F.xxhash64(identifier, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    return F.floor(rate + draw).cast("bigint")


def mix(
    docs: DataFrame,
    labels: DataFrame,
    domain: Column,
    weights: dict[str, float],
    anchor: str,
    growth: float = 1.0,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, a posterior for each domain, rate, copies.

    ``weights`` gives each domain, in the order of the numbers of ``domain``, its share of the mixture's expected
    tokens. The total is set by the domain ``anchor``: it keeps its expected tokens times ``growth``. Rates
    are fitted over all documents. A null text has no words, the prior as its posterior and a rate
    like any other; null identifiers share one draw. Repeated rows are rated alike. A very long text is a block by
    itself and counts by all its words. An empty table gives no rows; other columns aren't read.
    """
    names = [f"p_{n}" for n in weights]
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    model = fit_domains(texts, labels, domain, len(names))
    mixed = stage(predict_domains(texts, model, names), "posteriors")
    own = F.sum(F.col("n_tokens") * F.col(f"p_{anchor}"))
    available = mixed.agg(own).first()[0] or 0.0
    total = float(f"{available:.9g}") * growth / weights[anchor]
    rated, _, _ = fit_rates(mixed, names, [total * w for w in weights.values()])
    rated = rated.withColumn("rate", F.round("rate", 6))
    return rated.withColumn("copies", copies(F.col("rate"), F.col("doc_id"), seed))
