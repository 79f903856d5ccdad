"""Language identification by a linear-chain conditional random field.

Every word of a text gets a label. A word's scores come from its first
and last bytes, its byte trigrams and the languages' lexicons of
frequent words; transitions between neighbouring labels are learnt too.
Forward-backward gives each word's posterior, also in code-switched
text, and a document's language is the one with the largest mean
posterior over its words with letters.

Training sequences are stitched from runs of words of several labelled
documents, so that transitions between languages are seen. Fitting reads
a bounded sample: ``SAMPLE`` documents of each language. Prediction
covers whole texts: long ones are cut into chunks whose transfer
matrices are multiplied up first, which gives the exact messages at
every chunk's border.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispan.llm.common import bounded_choice, held_out
from lexispan.llm.words import LOWER, Lookup, Ranges, blocks, column_bytes, mix, row_slices, trimmed, word_bounds

#: Labelled documents of each language that the model is fitted on.
SAMPLE = 400
#: Affixes in bytes (negative: at the end), hashed weights of each kind
#: of feature, words of a language's lexicon.
AFFIXES = (2, 3, -2, -3, -4)
BUCKETS, LEXICON = 1 << 14, 800
#: Words of a training sequence, runs stitched into it at most, sequences.
LENGTH, RUNS, SEQUENCES = 48, 4, 4000
EPOCHS, STEP, ROWS = 6, 0.03, 64
#: Words of a chunk in prediction.
CHUNK = 64
#: Label of texts without letters.
UNDETERMINED = "und"


@dataclass
class Model:
    """Fixed size for a given number of languages."""

    languages: list[str]
    lexicon: np.ndarray  # word hashes
    member: np.ndarray  # lexicon x languages
    affix: np.ndarray  # len(AFFIXES) * BUCKETS x languages
    trigram: np.ndarray  # BUCKETS x languages
    lexical: np.ndarray  # languages x languages
    step: np.ndarray  # from x to


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(BUCKETS - 1)).astype(np.int64)


@dataclass
class _Words:
    """Words of a block, trimmed of marks and digits."""

    hashes: np.ndarray
    affix: np.ndarray  # words x len(AFFIXES)
    grams: np.ndarray  # trigram bucket at every byte of the block
    first: np.ndarray
    last: np.ndarray
    place: np.ndarray  # where the untrimmed word begins in the column

    @property
    def letters(self) -> np.ndarray:
        return self.last > self.first


def _read(texts: pa.Array) -> Iterator[_Words]:
    """Words of a column, block by block."""
    data, starts = column_bytes(texts)
    for at, end in blocks(data, starts):
        block = LOWER[data[at:end]]
        inner = starts[np.searchsorted(starts, at):np.searchsorted(starts, end)] - at
        first, last = word_bounds(block, inner)
        place = first + at
        first, last = trimmed(block, first, last)
        ranges = Ranges(block)
        affix = np.empty((len(first), len(AFFIXES)), np.int64)
        for j, size in enumerate(AFFIXES):
            a, b = (first, np.minimum(first + size, last)) if size > 0 else (np.maximum(last + size, first), last)
            affix[:, j] = _buckets(mix(ranges.hashes(a, b))) + j * BUCKETS
        wide = np.r_[block, np.zeros(2, np.uint8)].astype(np.uint64)
        grams = _buckets(mix(wide[:-2] | wide[1:-1] << np.uint64(8) | wide[2:] << np.uint64(16)))
        yield _Words(mix(ranges.hashes(first, last)), affix, grams, first, last, place)


def _emissions(words: _Words, model: Model, lookup: Lookup) -> np.ndarray:
    """Scores of every word (words x languages); 0 without letters."""
    scores = model.affix[words.affix].sum(axis=1)
    total = np.zeros((len(words.grams) + 1, scores.shape[1]))
    np.cumsum(model.trigram[words.grams], axis=0, out=total[1:])
    scores += total[np.maximum(words.last - 2, words.first)] - total[words.first]
    at, key = lookup.find(words.hashes)
    scores[at] += model.member[key] @ model.lexical
    scores[~words.letters] = 0
    return scores


def _sequences(texts: pa.Array, label: np.ndarray, rng: np.random.Generator) -> tuple[dict, np.ndarray]:
    """Features and labels of SEQUENCES stitched runs of LENGTH words."""
    parts, offset = [], 0
    for words in _read(texts):
        parts.append((words, offset))
        offset += len(words.hashes)
    place = np.concatenate([w.place for w, _ in parts]) if parts else np.zeros(0, np.int64)
    rows = np.searchsorted(place, column_bytes(texts)[1])
    long_enough = np.flatnonzero(np.diff(rows) > 0)
    by_language = [long_enough[label[long_enough] == k] for k in range(label.max() + 1)]
    by_language = [b for b in by_language if len(b)]
    picks = np.empty((SEQUENCES, LENGTH), np.int64)
    gold = np.empty((SEQUENCES, LENGTH), np.int64)
    for s in range(SEQUENCES):
        cuts = np.sort(rng.integers(0, LENGTH, rng.integers(0, RUNS)))
        edges = np.r_[0, cuts, LENGTH]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            row = rng.choice(by_language[rng.integers(len(by_language))])
            n = rows[row + 1] - rows[row]
            start = rng.integers(max(n - (b - a), 0) + 1)
            picks[s, a:b] = rows[row] + (start + np.arange(b - a)) % n
            gold[s, a:b] = label[row]
    hashes = np.concatenate([w.hashes for w, _ in parts])
    affix = np.concatenate([w.affix for w, _ in parts])
    letters = np.concatenate([w.letters for w, _ in parts])
    size = np.concatenate([np.maximum(w.last - 2 - w.first, 0) for w, _ in parts])
    begins = np.r_[0, np.cumsum(size)]
    grams = np.concatenate([w.grams[np.repeat(w.first, s) + _within(s)]
                            for w, _ in parts for s in [np.maximum(w.last - 2 - w.first, 0)]])
    owner = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    return {"hashes": hashes, "affix": affix, "letters": letters, "begins": begins, "grams": grams,
            "label": label[owner], "picks": picks}, gold


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each size in turn."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _lexicon(hashes: np.ndarray, label: np.ndarray, letters: np.ndarray, languages: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent words of each language and who lists them."""
    lists = []
    for k in range(languages):
        found, times = np.unique(hashes[(label == k) & letters], return_counts=True)
        lists.append(found[np.argsort(-times, kind="stable")[:LEXICON]])
    keys = np.unique(np.concatenate(lists))
    return keys, np.column_stack([np.isin(keys, one) for one in lists]).astype(float)


def _posteriors(scores: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward on rows of equal length: each word's posterior
    and the expected number of each transition."""
    rows, length, k = scores.shape
    emit = np.exp(scores - scores.max(axis=2, keepdims=True))
    move = np.exp(step)
    ahead = np.empty_like(emit)
    ahead[:, 0] = emit[:, 0] / emit[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, length):
        now = (ahead[:, t - 1] @ move) * emit[:, t]
        ahead[:, t] = now / now.sum(axis=1, keepdims=True)
    behind = np.ones((rows, k))
    posterior = np.empty_like(emit)
    moves = np.zeros((k, k))
    for t in range(length - 1, -1, -1):
        joint = ahead[:, t] * behind
        posterior[:, t] = joint / joint.sum(axis=1, keepdims=True)
        if t:
            later = emit[:, t] * behind
            pair = ahead[:, t - 1][:, :, None] * move * later[:, None, :]
            moves += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            behind = later @ move.T
            behind /= behind.sum(axis=1, keepdims=True)
    return posterior, moves


def fit(texts: pa.Array, languages: list[str]) -> Model:
    """Fit on a bounded sample: texts and the language of each."""
    names = sorted(set(languages))
    k = len(names)
    model = Model(names, np.zeros(0, np.uint64), np.zeros((0, k)), np.zeros((len(AFFIXES) * BUCKETS, k)),
                  np.zeros((BUCKETS, k)), np.zeros((k, k)), np.zeros((k, k)))
    if k < 2:
        return model
    rng = np.random.default_rng(11)
    label = np.searchsorted(names, languages)
    data, gold = _sequences(texts, label, rng)
    model.lexicon, model.member = _lexicon(data["hashes"], data["label"], data["letters"], k)
    lookup = Lookup(model.lexicon)
    moments: dict[str, list[np.ndarray]] = {}
    count = 0
    for _ in range(EPOCHS):
        order = rng.permutation(SEQUENCES)
        for at in range(0, SEQUENCES, ROWS):
            count += 1
            own = order[at:at + ROWS]
            pick = data["picks"][own].reshape(-1)
            affix, letters = data["affix"][pick], data["letters"][pick]
            size = data["begins"][pick + 1] - data["begins"][pick]
            gram = data["grams"][np.repeat(data["begins"][pick], size) + _within(size)]
            holder = np.repeat(np.arange(len(pick)), size)
            hit, key = lookup.find(data["hashes"][pick])
            scores = model.affix[affix].sum(axis=1)
            for j in range(k):
                scores[:, j] += np.bincount(holder, model.trigram[gram, j], minlength=len(pick))
            scores[hit] += model.member[key] @ model.lexical
            scores[~letters] = 0
            posterior, moves = _posteriors(scores.reshape(len(own), LENGTH, k), model.step)
            truth = np.eye(k)[gold[own]]
            error = ((posterior - truth) / len(own)).reshape(-1, k)
            error[~letters] = 0
            seen = np.zeros((k, k))
            np.add.at(seen, (gold[own][:, :-1].reshape(-1), gold[own][:, 1:].reshape(-1)), 1)
            grads = {
                "affix": np.column_stack([np.bincount(affix.reshape(-1), np.repeat(error[:, j], len(AFFIXES)),
                                                      minlength=len(model.affix)) for j in range(k)]),
                "trigram": np.column_stack([np.bincount(gram, error[holder, j], minlength=BUCKETS)
                                            for j in range(k)]),
                "lexical": model.member[key].T @ error[hit],
                "step": (moves - seen) / len(own)}
            for name, grad in grads.items():
                theta = getattr(model, name)
                first, second = moments.setdefault(name, [np.zeros_like(theta), np.zeros_like(theta)])
                grad = grad + 1e-4 * theta
                first += 0.1 * (grad - first)
                second += 0.01 * (grad**2 - second)
                theta -= STEP * (first / (1 - 0.9**count)) / (np.sqrt(second / (1 - 0.99**count)) + 1e-6)
    return model


def word_posteriors(scores: np.ndarray, rows: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Posterior of every word, for rows of any length (words x languages)."""
    n, k = scores.shape
    if not n:
        return scores
    sizes = np.diff(rows)
    chunks = -(-sizes // CHUNK)
    first_chunk = np.r_[0, np.cumsum(chunks)]
    begin = np.repeat(rows[:-1], chunks) + CHUNK * _within(chunks)
    end = np.minimum(begin + CHUNK, np.repeat(rows[1:], chunks))
    emit = np.exp(scores - scores.max(axis=1, keepdims=True))
    move = np.exp(step - step.max())
    starts = np.ones((len(begin), k)) / k  # message into each chunk
    ends = np.ones((len(begin), k))
    fresh = np.zeros(len(begin), dtype=bool)
    fresh[first_chunk[:-1][chunks > 0]] = True
    inner = np.flatnonzero(np.repeat(chunks, chunks) > 1)
    if len(inner):
        # Transfer matrix of every chunk of a long row: what its words do
        # to a message, from before its first word to its last one.
        matrix = np.broadcast_to(np.eye(k), (len(inner), k, k)).copy()
        for t in range(CHUNK):
            live = begin[inner] + t < end[inner]
            at = (begin[inner] + t)[live]
            into = np.where((fresh[inner][live] & (t == 0))[:, None, None], np.ones((k, k)) / k, move)
            step_by = np.matmul(matrix[live], into) * emit[at][:, None, :]
            matrix[live] = step_by / step_by.sum(axis=(1, 2), keepdims=True)
        where = np.full(len(begin), -1)
        where[inner] = np.arange(len(inner))
        for i in range(1, int(chunks.max())):
            own = first_chunk[:-1][chunks > i] + i
            message = np.einsum("nk,nkl->nl", starts[own - 1], matrix[where[own - 1]])
            starts[own] = message / message.sum(axis=1, keepdims=True)
            own = first_chunk[1:][chunks > i] - 1 - i
            message = np.einsum("nkl,nl->nk", matrix[where[own + 1]], ends[own + 1])
            ends[own] = message / message.sum(axis=1, keepdims=True)
    ahead = np.empty((n, k))
    message = starts
    for t in range(CHUNK):
        live = np.flatnonzero(begin + t < end)
        if not len(live):
            break
        at = begin[live] + t
        into = message[live] @ move
        if t == 0:
            into[fresh[live]] = 1.0
        into *= emit[at]
        into /= into.sum(axis=1, keepdims=True)
        ahead[at] = into
        if t == 0:
            message = np.empty_like(starts)
        message[live] = into
    out = np.empty((n, k))
    # The message behind a chunk's last word is the next chunk's, taken
    # from before its first word; a row's last word has none.
    message = ends.copy()
    for t in range(CHUNK - 1, -1, -1):
        live = np.flatnonzero(begin + t < end)
        if not len(live):
            continue
        at = begin[live] + t
        joint = ahead[at] * message[live]
        out[at] = joint / joint.sum(axis=1, keepdims=True)
        back = (emit[at] * message[live]) @ move.T
        message[live] = back / back.sum(axis=1, keepdims=True)
    return out


def predict(texts: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(language number, its mean posterior) of each text."""
    n, k = len(texts), len(model.languages)
    if k < 2:
        return np.zeros(n, int), np.ones(n) * k
    lookup = Lookup(model.lexicon)
    scores, letters, places = [], [], []
    for words in _read(texts):
        scores.append(_emissions(words, model, lookup))
        letters.append(words.letters)
        places.append(words.place)
    if not scores:
        return np.zeros(n, int), np.zeros(n)
    rows = np.searchsorted(np.concatenate(places), column_bytes(texts)[1])
    posterior = word_posteriors(np.concatenate(scores), rows, model.step)
    counted = np.concatenate(letters)[:, None]
    total = np.r_[np.zeros((1, k)), np.cumsum(posterior * counted, axis=0)]
    mass = np.maximum(total[rows[1:]] - total[rows[:-1]], 0)
    best = mass.argmax(axis=1)
    return best, mass[np.arange(n), best] / np.maximum(mass.sum(axis=1), 1e-9)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             sample: int = SAMPLE) -> DataFrame:
    """Language of every text: doc_id, held_out, lang_pred, score.

    Learns from the text and language of rows that are not held out and
    have both. A null text or one without letters gets ``und`` and score
    0, as do all texts if nothing can be learnt from. Repeated rows are
    predicted alike; an empty table gives an empty result; other columns
    are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    has_letter = text.rlike(r"\p{L}")
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(F.col(id_col)))
    names = [r[0] for r in known.select(F.col(lang_col).cast("string")).distinct().collect()]
    model = Model([], *[np.zeros(0)] * 6)
    if names:
        parts = [bounded_choice(known.where((F.col(lang_col) == name) & has_letter).select(
            F.col(id_col).alias("id"), F.lit(name).alias("lang"), text.alias("text")), sample, "id", "text")
            .select("lang", "text") for name in sorted(names)]
        chosen = parts[0]
        for part in parts[1:]:
            chosen = chosen.unionByName(part)
        table = chosen.toArrow().combine_chunks()
        if len(table):
            model = fit(table["text"].combine_chunks(), table["lang"].to_pylist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end in row_slices(batch.column("text")):
                own = batch.slice(at, end - at)
                best, score = predict(own.column("text"), model)
                known_ = own.column("has_letter").to_numpy(zero_copy_only=False) & bool(model.languages)
                names_ = [model.languages[b] if ok else UNDETERMINED for b, ok in zip(best, known_, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [own.column("id"), own.column("held_out"), pa.array(names_, pa.string()),
                     pa.array(np.where(known_, score, 0.0), pa.float64())],
                    names=["doc_id", "held_out", "lang_pred", "score"])
    rows = docs.select(F.col(id_col).cast("long").alias("id"), held_out(F.col(id_col)).alias("held_out"),
                       text.alias("text"), has_letter.alias("has_letter"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
