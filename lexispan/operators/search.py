"""Batch BM25 ranking: join + aggregate + windowed top-k.

For a batch of questions:

1. question tokens are counted per question (``qtf``; a repeated token
   counts again) and joined to ``terms`` (idf, df, largest tf factor);
2. the postings of the questions' tokens are gathered per chunk, which
   needs no shuffle, as each group of postings is clustered by chunk;
   tasks score blocks of chunks with numpy and keep the best k chunks of
   each question (``block_top``): pairs of questions and chunks are never
   rows, and tokens that cannot lift a chunk past the k-th are looked up
   only for chunks that the other tokens lead to;
3. ``row_number`` over (question) ordered by score, then chunk id (the
   corpus order), ``<= k``, of these;
4. the k rows of each question meet their paths.

The question side goes to all tasks, at most QUESTION_SLICE rows at a
time; larger batches are scored in slices of the questions. Scores of
all pairs (``bm25_scores``) are a join with the postings and a sum per
(question, chunk), also without a shuffle of the postings.

Zero-fill (reference behaviour): when fewer than ``k`` chunks score
above zero, the list continues with zero-score chunks in corpus order,
and negative scores come last. For those questions only, the first
``k + n_negative`` chunk ids are the candidates: they are numbers, so no
chunk is read for them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexispan.functions.text import is_blank, tokenize
from lexispan.operators.index import BM25Index

# Broadcast limits (rows). Beyond them the planner chooses a shuffle join.
BROADCAST_QUESTION_TOKENS = 2_000_000
BROADCAST_SURVIVORS = 2_000_000
BROADCAST_CANDIDATES = 1_000_000
# (question, token) rows up to this count have their tokens pushed into
# the postings/terms scans as an IN filter (row-group skipping on Parquet).
PUSHDOWN_TOKENS = 1_000
# (question, token) rows that are sent to all tasks at a time (12 bytes each).
QUESTION_SLICE = 4_000_000
# Postings that are scored at a time, and tasks that score, for each task slot.
BLOCK_POSTINGS, BLOCK_TASKS = 1 << 20, 3
# Questions that are prepared at a time, rows that a task holds and hands on at a time.
QUESTION_BATCH, HELD_ROWS, OUT_ROWS = 4096, 4_000_000, 1 << 17
# Of a question's threshold, what its frequent tokens may add unseen; chunks of a group.
BOUND_SHARE, GROUP_CHUNKS = 0.6, 64
# Matching postings of a batch beyond which its scoring goes by bounds; None:
# never, as blocks take less (bounds shuffle the pairs they leave open).
BOUNDED_PAIRS: int | None = None
# Postings of a question's rare tokens in the first pass, and chunks that
# get their full score after it, for each of its k.
FIRST_PASS, PROMISING = 64, 2
# Scores are sums of doubles in any order: bounds leave them this much room.
SLACK = 1e-6


class Intermediates:
    """Small results that a search keeps while it is read (question
    tokens, top-k rows). The caller that consumes the result releases
    them, so that a long-running session does not gather them."""

    def __init__(self) -> None:
        self._kept: list[DataFrame] = []
        self._held: list[Broadcast] = []

    def keep(self, df: DataFrame) -> DataFrame:
        kept = df.persist()
        self._kept.append(kept)
        return kept

    def hold(self, sent: Broadcast) -> Broadcast:
        self._held.append(sent)
        return sent

    def release(self) -> None:
        while self._kept:
            self._kept.pop().unpersist()
        while self._held:
            self._held.pop().unpersist()


# Of searches that were given none of their own.
_SHARED = Intermediates()


def release_cached() -> None:
    """Release what searches without ``Intermediates`` of their own keep."""
    _SHARED.release()


def check_k(k: int) -> int:
    if isinstance(k, bool) or not isinstance(k, int):
        raise ValueError("k must be an integer.")
    if k < 0:
        raise ValueError("k must not be negative.")
    return k


def question_tokens(questions: DataFrame) -> DataFrame:
    """(question_id, token, qtf): token counts of each question."""
    return (questions.select("question_id", F.explode(tokenize("question")).alias("token"))
            .groupBy("question_id", "token").agg(F.count(F.lit(1)).alias("qtf")))


def _maybe_broadcast(df: DataFrame, rows: int, limit: int) -> DataFrame:
    return F.broadcast(df) if rows <= limit else df


def weighted_tokens(index: BM25Index, questions: DataFrame, kept: Intermediates,
                    pushdown: bool = True) -> tuple[DataFrame, int, list[str] | None]:
    """(question_id, token, w, df, most) of the question tokens the index
    knows, a bound of their number, and for small batches the distinct
    tokens: ``w = qtf * idf``, ``most`` the largest contribution of the
    token to a score."""
    qtok, terms, wanted = kept.keep(question_tokens(questions)), index.terms, None
    some = [r[0] for r in qtok.select("token").limit(PUSHDOWN_TOKENS + 1).collect()]
    n = len(some) if len(some) <= PUSHDOWN_TOKENS else qtok.count()
    if pushdown and index.on_disk and n <= PUSHDOWN_TOKENS:
        wanted = sorted(set(some))
        terms = terms.where(F.col("token").isin(wanted))
    known = _maybe_broadcast(qtok, n, BROADCAST_QUESTION_TOKENS).join(terms, "token")
    w = F.col("qtf").cast("double") * F.col("idf")
    return known.select("question_id", "token", w.alias("w"), "df", (w * F.col("max_tfn")).alias("most")), n, wanted


def _summed(index: BM25Index, weights: DataFrame, rows: int, wanted: list[str] | None = None,
            chunks: DataFrame | None = None) -> DataFrame:
    """(question_id, chunk_id, score): the sums of ``w * tfn`` over
    ``weights`` (question_id, token, w), of ``rows`` rows at most and
    ``wanted`` tokens, if given; with ``chunks`` (question_id, chunk_id)
    only of these pairs.

    Each group of postings is clustered by chunk (bucketed table or the
    persisted in-memory index), so the sum needs no shuffle.
    """
    side = _maybe_broadcast(weights.select("question_id", "token", "w"), rows, BROADCAST_QUESTION_TOKENS)

    def of_group(postings: DataFrame) -> DataFrame:
        if wanted is not None:
            postings = postings.where(F.col("token").isin(wanted))
        postings = postings.select("token", "chunk_id", "tfn")
        if chunks is not None:
            postings = postings.join(chunks.select("chunk_id").distinct(), "chunk_id", "left_semi")
        matched = side.join(postings, "token")
        if chunks is not None:
            matched = matched.join(chunks, ["question_id", "chunk_id"], "left_semi")
        return matched.groupBy("question_id", "chunk_id").agg(F.sum(F.col("w") * F.col("tfn")).alias("score"))
    return reduce(DataFrame.unionByName, [of_group(g) for g in index.groups])


def bm25_scores(index: BM25Index, questions: DataFrame, pushdown: bool = True,
                kept: Intermediates = _SHARED) -> DataFrame:
    """(question_id, chunk_id, score) for every chunk sharing at least
    one token with the question (not rounded)."""
    return _summed(index, *weighted_tokens(index, questions, kept, pushdown))


def top_scores(index: BM25Index, questions: DataFrame, k: int, pushdown: bool = True,
               kept: Intermediates = _SHARED) -> DataFrame:
    """R1 for a top-k: (question_id, chunk_id, score) of a few chunks of
    each question, the best k of all among them."""
    weights, n, wanted = weighted_tokens(index, questions, kept, pushdown)
    if BOUNDED_PAIRS is not None and (weights.agg(F.sum("df")).first()[0] or 0) > BOUNDED_PAIRS:
        return bounded_scores(index, kept.keep(weights), n, k, wanted, kept)
    slices = max(math.ceil(n / QUESTION_SLICE), 1)
    if slices == 1:
        return block_top(index, weights, k, wanted, kept)
    own = F.pmod(F.xxhash64("question_id"), F.lit(slices))
    return reduce(DataFrame.unionByName, [block_top(index, weights.where(own == i), k, wanted, kept)
                                          for i in range(slices)])


def block_top(index: BM25Index, weights: DataFrame, k: int, wanted: list[str] | None = None,
              kept: Intermediates = _SHARED) -> DataFrame:
    """The best ``k`` chunks of each question of ``weights`` (question_id,
    token, w, df) among the chunks of every task, with their scores; ties
    go by chunk id.

    All postings of a chunk meet in one row (no shuffle: each group is
    clustered by chunk), so a block's scores are final.
    """
    spark = index.chunks.sparkSession
    tokens, *questions = asked_questions(weights.select("question_id", "token", "w", "df").toArrow())
    asked = kept.hold(spark.sparkContext.broadcast((*questions, len(tokens))))
    known = F.broadcast(spark.createDataFrame(
        pa.table({"token": tokens, "number": pa.array(range(len(tokens)), pa.int32())}), "token string, number int"))
    # A task hands on k chunks of a question, however many blocks it scores.
    tasks = BLOCK_TASKS * spark.sparkContext.defaultParallelism

    def of_group(postings: DataFrame) -> DataFrame:
        if wanted is not None:
            postings = postings.where(F.col("token").isin(wanted))
        hits = postings.select("token", "chunk_id", "tfn").join(known, "token").groupBy("chunk_id").agg(
            F.collect_list(F.struct("number", "tfn")).alias("hits"))
        return hits.coalesce(tasks).mapInArrow(
            _block_scores(asked, k), "question_id string, chunk_id bigint, score double")
    return reduce(DataFrame.unionByName, [of_group(g) for g in index.groups])


def asked_questions(weights: pa.Table) -> tuple[pa.Array, pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct tokens of ``weights`` (question_id, token, w, df), question
    ids, and the questions: the i-th has the tokens ``numbers`` and
    ``weights`` from ``starts[i]`` to ``starts[i + 1]``, frequent ones
    first."""
    tokens = weights["token"].unique()
    numbers = pc.index_in(weights["token"], tokens).to_numpy().astype(np.int32)
    ids = weights["question_id"].combine_chunks().dictionary_encode("encode")  # a null id is one, too
    own = ids.indices.to_numpy()
    order = np.lexsort((numbers, -weights["df"].to_numpy(), own))
    starts = np.r_[0, np.cumsum(np.bincount(own, minlength=len(ids.dictionary)))]
    return tokens, ids.dictionary, starts, numbers[order], weights["w"].to_numpy()[order]


def _block_scores(asked: Broadcast, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, held, size = BestChunks(k, *asked.value), [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch.column("hits").flatten())
            if size >= best.block_postings:
                yield from best.add(pa.Table.from_batches(held))
                held, size = [], 0
        if held:
            yield from best.add(pa.Table.from_batches(held))
        yield from best.rows()
    return run


class BestChunks:
    """Best ``k`` chunks of each question among the blocks of a task.

    A question's k-th best score so far is its threshold. Its frequent
    tokens, as far as their largest contributions in a block together
    stay below BOUND_SHARE of the threshold, cannot lift a chunk into the
    result by themselves: the others are summed over the block, and only
    chunks that can still reach the threshold get the contributions of
    the frequent tokens. Arguments as ``asked_questions`` gives them.
    """

    def __init__(self, k: int, ids: pa.Array, starts: np.ndarray, numbers: np.ndarray, weights: np.ndarray,
                 n_tokens: int) -> None:
        self._k, self._ids, self._starts, self._numbers, self._weights = k, ids, starts, numbers, weights
        self._n_tokens = n_tokens
        # Few questions do not pay for large blocks.
        self.block_postings = BLOCK_POSTINGS if len(ids) > QUESTION_BATCH else BLOCK_POSTINGS // 8
        self._unit = np.full(n_tokens, np.inf)
        np.minimum.at(self._unit, numbers, weights)
        self._unit[self._unit == 0] = 1.0
        self._least = np.full(len(ids), -np.inf)
        # Where k chunks of all questions are too many to hold, each block's go out.
        self._held = len(ids) * k <= HELD_ROWS
        self._n = np.zeros(len(ids), np.int64)
        self._chunks = np.empty((len(ids), k if self._held else 0), np.int64)
        self._scores = np.empty((len(ids), k if self._held else 0))

    def add(self, block: pa.Table) -> Iterator[pa.RecordBatch]:
        """Score the chunks of ``block`` (chunk_id, hits: number and tf
        factor of their tokens) for all questions."""
        place = np.argsort(block["chunk_id"].to_numpy())
        block = block.take(pa.array(place)).combine_chunks()
        chunk_ids, lists = block["chunk_id"].to_numpy(), block["hits"].chunk(0)
        rows = np.repeat(np.arange(len(chunk_ids)), pc.list_value_length(lists).to_numpy())
        tokens, factors = (pc.struct_field(lists.flatten(), i).to_numpy() for i in (0, 1))
        # The block's postings by token, and by chunk within it.
        order = np.argsort(tokens, kind="stable")
        rows, factors = rows[order], factors[order]
        ends = np.cumsum(np.bincount(tokens, minlength=self._n_tokens))
        begins = np.r_[0, ends[:-1]]
        present = np.flatnonzero(begins < ends)
        largest = np.zeros(self._n_tokens)
        if len(present):
            largest[present] = np.maximum.reduceat(factors, begins[present])
        # Most questions ask for a token as often as any: its postings are weighted once.
        factors = factors * np.repeat(self._unit, ends - begins)
        out: list[tuple[int, np.ndarray, np.ndarray]] = []
        for low in range(0, len(self._ids), QUESTION_BATCH):
            self._add(low, min(low + QUESTION_BATCH, len(self._ids)), chunk_ids, rows, factors, begins, ends, largest, out)
        if out:
            yield self._batch(np.repeat([q for q, _, _ in out], [len(c) for _, c, _ in out]),
                              np.concatenate([c for _, c, _ in out]), np.concatenate([s for _, _, s in out]))

    def _add(self, low: int, high: int, chunk_ids: np.ndarray, rows: np.ndarray, factors: np.ndarray, begins: np.ndarray,
             ends: np.ndarray, largest: np.ndarray, out: list[tuple[int, np.ndarray, np.ndarray]]) -> None:
        """The questions from ``low`` to ``high``."""
        own = slice(self._starts[low], self._starts[high])
        question = np.repeat(np.arange(high - low), np.diff(self._starts[low:high + 1]))
        here = np.flatnonzero(begins[self._numbers[own]] < ends[self._numbers[own]])
        question, numbers, weights = question[here], self._numbers[own][here], self._weights[own][here]
        starts = np.r_[0, np.cumsum(np.bincount(question, minlength=high - low))]
        # What a question's first tokens can add to a score together.
        bound = np.maximum(weights * largest[numbers], 0.0)
        total = np.cumsum(bound)
        total -= (total - bound)[np.minimum(starts[:-1], max(len(total) - 1, 0))][question]
        spare = np.where(self._least[low:high] > 2 * SLACK, BOUND_SHARE * self._least[low:high], -1.0)
        rest = starts[:-1] + np.bincount(question, total <= spare[question], minlength=high - low).astype(np.int64)
        begin, end, times, bounds, total = (
            x.tolist() for x in (begins[numbers], ends[numbers], weights / self._unit[numbers], bound, total))
        for q, first, split, last in zip(range(low, high), starts[:-1].tolist(), rest.tolist(), starts[1:].tolist(), strict=True):
            if split == last:
                continue  # nothing here, or too little
            parts = [slice(b, e) for b, e in zip(begin[split:last], end[split:last], strict=True)]
            values = [factors[p] if x == 1.0 else factors[p] * x for p, x in zip(parts, times[split:last], strict=True)]
            scores = np.bincount(np.concatenate([rows[p] for p in parts]), np.concatenate(values), len(chunk_ids))
            least = self._least[q]
            if least > 2 * SLACK:
                most = total[split - 1] if split > first else 0.0
                hit = np.flatnonzero(scores >= least - most - SLACK)
                found = scores[hit]
                for i in range(split - 1, first - 1, -1):
                    if not len(hit):
                        break
                    list_ = rows[begin[i]:end[i]]
                    at = np.minimum(np.searchsorted(list_, hit), len(list_) - 1)
                    found = found + np.where(list_[at] == hit, factors[begin[i]:end[i]][at] * times[i], 0.0)
                    most -= bounds[i]
                    open_ = found >= least - most - 2 * SLACK
                    hit, found = hit[open_], found[open_]
            else:
                hit = self._leading(scores)
                if hit is None:  # scores may be 0 or less, few chunks are hit
                    hit = np.unique(np.concatenate([rows[begin[i]:end[i]] for i in range(first, last)]))
                found = scores[hit]
            if len(hit):
                self._keep(q, chunk_ids[hit], found, out)

    def _leading(self, scores: np.ndarray) -> np.ndarray | None:
        """Chunks that may be among the best k: those that reach the k-th
        largest score of disjoint groups of chunks, if it is above 0."""
        groups = len(scores) // GROUP_CHUNKS
        if groups < self._k:
            return None
        largest = scores[:groups * GROUP_CHUNKS].reshape(GROUP_CHUNKS, groups).max(axis=0)
        least = np.partition(largest, groups - self._k)[groups - self._k] - SLACK
        return np.flatnonzero(scores >= least) if least > 0 else None

    def _keep(self, q: int, chunks: np.ndarray, scores: np.ndarray, out: list[tuple[int, np.ndarray, np.ndarray]]) -> None:
        if n := self._n[q]:
            chunks = np.concatenate((self._chunks[q, :n], chunks))
            scores = np.concatenate((self._scores[q, :n], scores))
        if len(chunks) > self._k:
            best = np.lexsort((chunks, -np.rint(scores * 1e9)))[:self._k]  # as score_key has it
            chunks, scores = chunks[best], scores[best]
        if len(chunks) == self._k:
            self._least[q] = max(self._least[q], scores.min())
        if self._held:
            n = self._n[q] = len(chunks)
            self._chunks[q, :n], self._scores[q, :n] = chunks, scores
        else:
            out.append((q, chunks, scores))

    def _batch(self, questions: np.ndarray, chunks: np.ndarray, scores: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([self._ids.take(pa.array(questions)), pa.array(chunks), pa.array(scores)],
                                          names=["question_id", "chunk_id", "score"])

    def rows(self) -> Iterator[pa.RecordBatch]:
        """What is held, some questions at a time."""
        step = max(OUT_ROWS // self._k, 1)
        for low in range(0, len(self._ids) if self._held else 0, step):
            there = np.arange(self._k) < self._n[low:low + step, None]
            yield self._batch(low + np.nonzero(there)[0], self._chunks[low:low + step][there],
                              self._scores[low:low + step][there])


def bounded_scores(index: BM25Index, weights: DataFrame, n: int, k: int, wanted: list[str] | None = None,
                   kept: Intermediates = _SHARED) -> DataFrame:
    """Scores of all chunks that can be among a question's first ``k``,
    ties included; arguments as ``weighted_tokens`` gives them.

    A chunk's score is at most the score of the tokens looked at so far
    plus ``most`` of each other token. The threshold is the k-th full
    score of the chunks that lead by rare tokens; a question whose rare
    tokens are in fewer than k chunks has none, and all its chunks are
    scored. A question's cheapest tokens, whose ``most`` together stay
    below the threshold, cannot lift a chunk into the result by
    themselves: only chunks that hold one of the other tokens are summed,
    and of these only those that can still reach the threshold get the
    contributions of the cheap tokens.
    """
    rare_first = Window.partitionBy("question_id").orderBy("df", "token")
    before = F.sum("df").over(rare_first.rowsBetween(Window.unboundedPreceding, -1))
    rare = weights.withColumn("_before", F.coalesce(before, F.lit(0))).where(F.col("_before") < FIRST_PASS * k)
    by_score = Window.partitionBy("question_id").orderBy(F.col("score").desc(), F.col("chunk_id"))
    first = _summed(index, rare, n, wanted).withColumn("_r", F.row_number().over(by_score)).where(
        F.col("_r") <= PROMISING * k)
    first = kept.keep(first.select("question_id", "chunk_id"))
    promising = _maybe_broadcast(first, first.count(), BROADCAST_CANDIDATES)
    full = _summed(index, weights, n, wanted, promising).withColumn("_r", F.row_number().over(by_score))
    reached = kept.keep(full.where(F.col("_r") == k).select("question_id", (F.col("score") - SLACK).alias("least")))
    cheap_first = Window.partitionBy("question_id").orderBy("most", "token").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    split = weights.join(reached, "question_id", "left").withColumn(
        "cheap", F.coalesce(F.sum("most").over(cheap_first) < F.col("least"), F.lit(False)))
    split = kept.keep(split)
    rest = split.groupBy("question_id").agg(
        F.coalesce(F.sum(F.when(F.col("cheap"), F.col("most"))), F.lit(0.0)).alias("rest"),
        F.first("least").alias("least"))
    n_cheap = split.where("cheap").count()
    leading = _summed(index, split.where(~F.col("cheap")), n - n_cheap, wanted)
    if not n_cheap:
        return leading
    open_ = leading.join(_maybe_broadcast(rest, n, BROADCAST_QUESTION_TOKENS), "question_id").where(
        F.col("least").isNull() | (F.col("score") + F.col("rest") >= F.col("least")))
    open_ = kept.keep(open_.select("question_id", "chunk_id", "score"))
    keys = _maybe_broadcast(open_.select("question_id", "chunk_id"), open_.count(), BROADCAST_CANDIDATES)
    more = _summed(index, split.where("cheap"), n_cheap, wanted, keys)
    return open_.unionByName(more).groupBy("question_id", "chunk_id").agg(F.sum("score").alias("score"))


def score_key(score: Column) -> Column:
    """Scores equal to 9 decimal places tie (sums of doubles depend on
    their order); then corpus order decides."""
    return F.rint(score * F.lit(1e9))


def with_spans(index: BM25Index, scored: DataFrame, rows: int | None = None) -> DataFrame:
    """Attach (file_path, first, last) to rows keyed by chunk_id.

    With a known, bounded row count the keyed rows are broadcast and the
    chunk table is streamed (never shuffled); otherwise the chunks' keys
    are dealt like the scores, which stay where they were summed, unsorted.
    """
    keys = index.chunks.select("chunk_id", "file_path", "first_character_index",
                               "last_character_index")
    if rows is not None and rows <= BROADCAST_SURVIVORS:
        return F.broadcast(scored).join(keys, "chunk_id")
    return scored.join(keys.hint("shuffle_hash"), "chunk_id")


def top_k(index: BM25Index, scored: DataFrame, k: int) -> DataFrame:
    """R2: best ``k`` chunks per question with their ``rank``; equal scores
    keep corpus order, which is the order of the chunk ids."""
    order = Window.partitionBy("question_id").orderBy(score_key(F.col("score")).desc(), F.col("chunk_id"))
    return scored.select("question_id", "chunk_id", "score").withColumn(
        "rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _fill_rows(index: BM25Index, deficient: DataFrame, exclude: DataFrame) -> DataFrame:
    """Score-0 rows: the first ``need`` chunk ids of every deficient
    question, minus the chunks in ``exclude`` (already scored)."""
    last = F.least(F.col("need"), F.lit(index.n_chunks)).cast("bigint") - 1
    wanted = deficient.where(last >= 0).select(
        "question_id", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("chunk_id"))
    return wanted.join(exclude.select("question_id", "chunk_id"), ["question_id", "chunk_id"], "left_anti")\
        .withColumn("score", F.lit(0.0))


def zero_fill_candidates(index: BM25Index, scored: DataFrame, k: int) -> DataFrame | None:
    """R4, general case (negative scores possible): candidates for questions
    with fewer than k positive scores. Zeros rank above negatives, so the
    candidates must reach past the negatives: ``k + n_negative``.

    Returns None when no question needs filling (nothing is planned).
    """
    counts = scored.groupBy("question_id").agg(
        F.count_if(F.col("score") > 0).alias("npos"),
        F.count_if(F.col("score") < 0).alias("nneg"))
    deficient = counts.where(F.col("npos") < k).select(
        "question_id", (F.lit(k) + F.col("nneg")).alias("need"))
    return None if deficient.isEmpty() else _fill_rows(index, deficient, scored)


def search(index: BM25Index, questions: DataFrame, k: int = 10, fill: bool = True,
           pushdown: bool = True, kept: Intermediates = _SHARED) -> DataFrame:
    """Ranked sources per question.

    ``questions``: (question_id, question). Output columns
    ``question_id, rank, file_path, first_character_index,
    last_character_index, score`` (score rounded to 6 places). Questions
    without a known token (or blank, or k = 0) get no rows.

    Zero-fill: with non-negative idf (the normal case) a question is
    deficient when its top-k holds fewer than k positive scores; those
    top-k rows (small, kept) and the first k chunk ids are all that is
    needed. Otherwise the general path counts negatives over the whole
    matched set.
    """
    check_k(k)
    if k == 0:
        return scored_empty(questions)
    if index.nonnegative_idf:
        best = kept.keep(top_k(index, top_scores(index, questions, k, pushdown, kept), k))
        of_question = best.groupBy("question_id").agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("score") > 0).alias("npos"))
        rows, lacking = of_question.agg(F.sum("n"), F.count_if(F.col("npos") < k)).first()
        if fill and lacking:
            deficient = of_question.where(F.col("npos") < k).select("question_id", F.lit(k).alias("need"))
            best = top_k(index, best.drop("rank").unionByName(_fill_rows(index, deficient, best)), k)
            rows += lacking * k
    else:
        scored = bm25_scores(index, questions, pushdown, kept)
        if fill:
            scored = kept.keep(scored)
            filled = zero_fill_candidates(index, scored, k)
            scored = scored if filled is None else scored.unionByName(filled)
        best = kept.keep(top_k(index, scored, k))
        rows = best.count()
    return with_spans(index, best, rows or 0).select(
        "question_id", "rank", "file_path", "first_character_index", "last_character_index",
        F.round("score", 6).alias("score"))


def scored_empty(questions: DataFrame) -> DataFrame:
    spark = questions.sparkSession
    return spark.createDataFrame([], "question_id string, rank int, file_path string, "
                                     "first_character_index bigint, last_character_index bigint, "
                                     "score double")


def search_one(index: BM25Index, query: str, k: int = 10, question_id: str | None = None,
               fill: bool = True, kept: Intermediates = _SHARED) -> DataFrame:
    """One query -> its ranked sources. Blank query / negative k raise."""
    if not isinstance(query, str) or not query.strip():
        raise ValueError("query must not be empty.")
    check_k(k)
    import uuid

    spark = index.chunks.sparkSession
    qid = question_id or str(uuid.uuid4())
    questions = spark.createDataFrame([(qid, query)], "question_id string, question string")
    return search(index, questions, k, fill, kept=kept)


def search_dataset(index: BM25Index, questions: DataFrame, k: int = 10,
                   fill: bool = True, kept: Intermediates = _SHARED) -> DataFrame:
    """Every question of a set, unmatched ones kept with null sources.

    Flat output: ``question_id, question, rank, file_path,
    first_character_index, last_character_index, score``. With an
    ``input_pos`` column the set may repeat ids: each position is ranked
    by itself and the column is kept. Without one, ids must be unique.
    """
    check_k(k)
    placed = "input_pos" in questions.columns
    columns = (["input_pos"] if placed else []) + ["question_id", "question"]
    q = questions.select(*columns)
    key = F.col("input_pos").cast("string") if placed else F.col("question_id")
    keyed = q.select(key.alias("question_id"), "question").where(~is_blank("question"))
    res = search(index, keyed, k, fill, kept=kept).withColumnRenamed("question_id", "_key")
    return q.withColumn("_key", key).join(res, "_key", "left").select(
        *columns, "rank", "file_path", "first_character_index", "last_character_index", "score")
