"""Toxicity by weak supervision.

Many voters look at a text: seed lexicons of insults, lexicons of words
and of word beginnings learnt from labelled rows, by number of hits and
in tiers of strength, patterns of shouting, and the annotators of the
labelled rows, who may err like any voter. Each votes toxic, clean or
abstains. A generative label model, a tree-augmented naive Bayes fitted
by expectation maximisation, estimates how accurate every voter is and
how voters depend on each other, and turns the votes of the training
rows into posterior labels. A linear classifier, which sees the text
alone, is trained on these posteriors and scores all texts.

Fitting reads a bounded sample: at most ``SAMPLE`` rows of each label.
Scoring covers all rows and whole texts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lexispan.llm.common import labelled_sample, scored
from lexispan.llm.words import Lookup, column_bytes, mix, word_views

#: Labelled rows of each label that the model is fitted on.
SAMPLE = 3000
#: Learnt words and word beginnings at most, and the likelihood-ratio
#: statistic that each must reach.
LEXICON, EVIDENCE = 4096, 16.0
#: Bytes of the word beginnings that are looked at.
AFFIXES = (4, 5, 6, 7)
#: Log-odds that start the tiers of learnt lexicons.
TIERS = (2.0, 3.0, 4.5)
#: Probability that an annotator calls a toxic text, and a clean one, toxic,
#: before the votes are seen, and the rows that this is worth.
ANNOTATORS, ANNOTATORS_ROWS = (0.95, 0.005), 20
#: Change of a posterior below which the label model has settled.
SETTLED = 1e-3
#: Score from which a text is predicted toxic.
CUT = 0.3

# Seed lexicons, one voter each.
SEEDS = {
    "insults_en": "idiot moron stupid dumb fool imbecile clown loser jerk creep freak scumbag".split(),
    "contempt_en": "trash garbage scum filth vermin worthless pathetic disgusting useless vile despicable".split(),
    "insults_de": "idiot dummkopf trottel depp blöd dumm arschloch abschaum widerlich wertlos".split(),
    "insults_fr": "idiot imbécile crétin abruti débile connard ordure minable dégoûtant salaud".split(),
    "insults_es": "idiota imbécil estúpido tonto basura escoria cabrón inútil asqueroso miserable".split(),
}
_SEED_NAMES = list(SEEDS)
_ROW = np.uint64(0xD1B54A32D192ED03)


def _hash_words(words: list[str]) -> np.ndarray:
    return word_views(pa.array(words), (), letters=True)[0][0]


def _views(texts: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
    return word_views(texts, AFFIXES, letters=True)


def _shouting(texts: pa.Array) -> np.ndarray:
    """Per row: share of capital letters, and of exclamation marks."""
    data, starts = column_bytes(texts)
    size = np.maximum(np.diff(starts), 1)

    def share(flags: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(flags)]
        return (total[starts[1:]] - total[starts[:-1]]) / size
    return np.column_stack([share((data >= 65) & (data <= 90)), share(data == 33)])


@dataclass
class Model:
    """What scoring needs; a few hundred kilobytes at most."""

    keys: np.ndarray  # hashes of learnt words and beginnings
    view: np.ndarray  # 0 for words, then the places in AFFIXES
    odds: np.ndarray  # their log-odds
    seeds: np.ndarray  # hashes of seed words
    seed_voter: np.ndarray
    weights: np.ndarray  # of every key, then of the dense inputs
    bias: float


def _hits(texts: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, key) of learnt hits, number of words and seed hits per voter and row."""
    views, rows = _views(texts)
    n = len(rows) - 1
    row_of = np.repeat(np.arange(n), np.diff(rows))
    lookup = Lookup(model.keys)
    found = [lookup.find(v) for v in views]
    row = np.concatenate([row_of[at] for at, _ in found])
    key = np.concatenate([k for _, k in found])
    at, seed = Lookup(model.seeds).find(views[0])
    seeds = np.zeros((n, len(_SEED_NAMES)))
    np.add.at(seeds, (row_of[at], model.seed_voter[seed]), 1)
    return row, key, np.diff(rows), seeds


def _votes(row: np.ndarray, key: np.ndarray, words: np.ndarray, seeds: np.ndarray, shouting: np.ndarray,
           model: Model) -> np.ndarray:
    """Votes (rows x voters): 0 abstains, 1 toxic, 2 clean."""
    n = len(words)
    columns = [(seeds[:, j] > 0).astype(int) for j in range(seeds.shape[1])]
    edges = [*TIERS, math.inf]
    expected = 1 + words / 400  # chance hits of a long clean text
    hits = np.zeros(n)
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        times = np.bincount(row[(model.odds[key] >= low) & (model.odds[key] < high)], minlength=n)
        hits += times
        columns.append((times > 0).astype(int))
    for view in range(1 + len(AFFIXES)):
        times = np.bincount(row[model.view[key] == view], minlength=n)
        columns += [(times > expected).astype(int), (times > 2 * expected).astype(int)]
    columns.append(np.where((hits == 0) & (seeds.sum(axis=1) == 0), 2, 0))
    columns.append(np.where(hits <= expected, 2, 0))
    columns += [(shouting[:, 0] > 0.5).astype(int), (shouting[:, 1] > 0.01).astype(int)]
    return np.column_stack(columns)


def label_model(votes: np.ndarray, annotated: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Posterior of the toxic class from the votes.

    Tree-augmented naive Bayes: each voter depends on the class and on
    one other voter, the tree being the maximum spanning tree of their
    mutual information given the class. Annotators are a voter outside
    the tree. Their accuracies are estimated in every round like the
    others'; ANNOTATORS start the fit and stay in it as a prior, which
    ties the two classes to their meaning. Rounds end once posteriors
    settle, after ``rounds`` at the latest.
    """
    n, m = votes.shape
    one_hot = (votes[:, :, None] == np.arange(3)).astype(float)
    posterior = np.where(annotated, 0.95, 0.02)
    for _ in range(rounds):
        weight = np.column_stack([1 - posterior, posterior])
        share = np.clip(weight.mean(axis=0), 0.005, 0.995)
        # Joint counts of every two voters in each class, smoothed.
        joint = np.einsum("nc,nia,njb->cijab", weight, one_hot, one_hot, optimize=True) + 0.1
        joint /= joint.sum(axis=(3, 4), keepdims=True)
        alone = np.einsum("nc,nia->cia", weight, one_hot) + 0.3
        alone /= alone.sum(axis=2, keepdims=True)
        outer = joint.sum(axis=4)[..., None] * joint.sum(axis=3)[:, :, :, None, :]
        mutual = (share[:, None, None] * (joint * np.log(joint / outer)).sum(axis=(3, 4))).sum(axis=0)
        parent = _spanning_tree(mutual)
        score = np.log(share)[None, :].repeat(n, axis=0)
        for j in range(m):
            if parent[j] < 0:
                score += np.log(alone[:, j][:, votes[:, j]]).T
            else:
                table = joint[:, parent[j], j]
                table = table / table.sum(axis=2, keepdims=True)
                score += np.log(table[:, votes[:, parent[j]], votes[:, j]]).T
        hit, alarm = (
            (weight[annotated, c].sum() + ANNOTATORS_ROWS * ANNOTATORS[1 - c]) / (weight[:, c].sum() + ANNOTATORS_ROWS)
            for c in (1, 0))
        said = np.where(annotated, math.log(hit / alarm), math.log((1 - hit) / (1 - alarm)))
        last, posterior = posterior, 1 / (1 + np.exp(-np.clip(score[:, 1] - score[:, 0] + said, -50, 50)))
        if np.abs(posterior - last).max() < SETTLED:
            break
    return posterior


def _spanning_tree(weight: np.ndarray) -> list[int]:
    """Parent of each node in the maximum spanning tree (Prim); -1 at the root."""
    m = len(weight)
    parent, best, inside = [-1] * m, weight[0].copy(), {0}
    near = [0] * m
    while len(inside) < m:
        j = max((x for x in range(m) if x not in inside), key=lambda x: best[x])
        parent[j] = near[j]
        inside.add(j)
        for x in range(m):
            if x not in inside and weight[j, x] > best[x]:
                best[x], near[x] = weight[j, x], j
    return parent


def _inputs(row: np.ndarray, key: np.ndarray, words: np.ndarray, seeds: np.ndarray,
            odds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sparse (row, key, value) of the classifier and its dense inputs.

    A hit counts by its saturated number; dense inputs are the summed
    strength of hits, also against the hits that a clean text of the
    length has by chance, and seed hits."""
    n = len(words)
    code, times = np.unique(row * max(len(odds), 1) + key, return_counts=True)
    row, key = code // max(len(odds), 1), code % max(len(odds), 1)
    value = np.log1p(times)
    strength = np.bincount(row, np.maximum(odds[key], 0) * value, minlength=n)
    per_word = strength / np.sqrt(50 + words)
    dense = np.column_stack([np.log1p(strength), per_word, np.log1p(per_word * 10),
                             np.minimum(seeds.sum(axis=1), 3), np.log1p(words) / 10])
    return row, key, value / np.sqrt(1 + words / 400)[row], dense


def _fit_linear(row: np.ndarray, key: np.ndarray, value: np.ndarray, dense: np.ndarray, keys: int,
                target: np.ndarray, weight: np.ndarray, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weighted logistic regression on soft targets (Adam, L2)."""
    n = len(target)
    theta = np.zeros(keys + dense.shape[1] + 1)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    decay = np.r_[np.full(keys, 3e-4), np.full(dense.shape[1] + 1, 1e-5)]
    total = weight.sum()
    for step in range(1, steps + 1):
        margin = np.bincount(row, theta[key] * value, minlength=n) + dense @ theta[keys:-1] + theta[-1]
        error = weight * (1 / (1 + np.exp(-np.clip(margin, -50, 50))) - target) / total
        grad = np.r_[np.bincount(key, error[row] * value, minlength=keys), dense.T @ error, error.sum()]
        grad += decay * theta
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        theta -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def fit(texts: pa.Array, toxic: np.ndarray, weight: np.ndarray) -> Model:
    """Fit on a bounded sample of labelled texts. ``weight`` undoes the
    sampling of the labels. One class alone gives a constant score."""
    seeds = np.concatenate([_hash_words(SEEDS[s]) for s in _SEED_NAMES])
    voter = np.concatenate([np.full(len(SEEDS[s]), j) for j, s in enumerate(_SEED_NAMES)])
    prior = float(np.clip((weight * toxic).sum() / weight.sum(), 0.001, 0.999)) if len(toxic) else 0.05
    dense_inputs = 5
    none = np.zeros(0, np.uint64)
    if not 0 < toxic.sum() < len(toxic):
        return Model(none, np.zeros(0, int), np.zeros(0), seeds, voter, np.zeros(dense_inputs), math.log(prior / (1 - prior)))
    keys, view, odds = _learn_lexicon(texts, toxic)
    model = Model(keys, view, odds, seeds, voter, np.zeros(len(keys) + dense_inputs), 0.0)
    row, key, words, seed_hits = _hits(texts, model)
    votes = _votes(row, key, words, seed_hits, _shouting(texts), model)
    posterior = label_model(votes, toxic)
    row, key, value, dense = _inputs(row, key, words, seed_hits, odds)
    model.weights, model.bias = _fit_linear(row, key, value, dense, len(keys), posterior, weight)
    return model


def _learn_lexicon(texts: pa.Array, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words and beginnings (hash, view, log-odds) that toxic rows have
    more often than chance allows."""
    views, rows = _views(texts)
    row_of = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    keys, kinds, odds, evidence = [], [], [], []
    n_toxic, n_clean = toxic.sum(), (~toxic).sum()
    for kind, view in enumerate(views):
        _, once = np.unique(mix(view + row_of.astype(np.uint64) * _ROW), return_index=True)
        once = once[view[once] != 0]
        found, at = np.unique(view[once], return_inverse=True)
        bad = np.bincount(at, toxic[row_of[once]], minlength=len(found))
        good = np.bincount(at, minlength=len(found)) - bad
        strength = np.log((bad + 0.1) / (n_toxic + 0.2)) - np.log((good + 0.5) / (n_clean + 1))
        share = n_toxic / (n_toxic + n_clean)
        ratio = 2 * (bad * np.log(np.maximum(bad, 1e-9) / ((bad + good) * share))
                     + good * np.log(np.maximum(good, 1e-9) / ((bad + good) * (1 - share))))
        keep = (strength >= TIERS[0]) & (ratio >= EVIDENCE)
        keys.append(found[keep])
        kinds.append(np.full(keep.sum(), kind))
        odds.append(strength[keep])
        evidence.append(ratio[keep])
    keys, kinds, odds = np.concatenate(keys), np.concatenate(kinds), np.concatenate(odds)
    top = np.argsort(-np.concatenate(evidence), kind="stable")[:LEXICON]
    return keys[top], kinds[top], odds[top]


def score(texts: pa.Array, model: Model) -> np.ndarray:
    """Scores of texts, 0 to 1."""
    row, key, words, seeds = _hits(texts, model)
    row, key, value, dense = _inputs(row, key, words, seeds, model.odds)
    keys = len(model.keys)
    margin = np.bincount(row, model.weights[key] * value, minlength=len(words)) if len(row) else 0.0
    margin = margin + dense @ model.weights[keys:] + model.bias
    return 1 / (1 + np.exp(-np.clip(margin, -50, 50)))


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   sample: int = SAMPLE) -> DataFrame:
    """Toxicity of every text: doc_id, held_out, score, predicted.

    Learns from rows of ``labels`` (doc_id, toxic) that are not held
    out. A null or empty text is scored like any other, by its lack of
    hits. Without rows of both labels every score is the known share of
    toxic rows. Repeated rows are scored alike; an empty table gives an
    empty result; other columns are not read.
    """
    model = fit(*labelled_sample(docs, labels, "toxic", sample, id_col, text_col))
    return scored(docs, lambda texts: score(texts, model), CUT, id_col, text_col)
