"""Near-duplicate documents by SetSketch registers (Ertl, 2021).

Each set of word shingles gives ``REGISTERS`` registers: the smallest of
independent exponential variables of its shingles, on an exponentially
spaced and truncated scale. Registers of a union are the maxima of the
registers, and two sets agree in a register with nearly the probability
of their Jaccard similarity, so bands of registers are the hash keys of
a locality-sensitive search. A candidate pair's similarity is estimated
jointly from its registers and set sizes by maximum likelihood; pairs
that may reach the threshold are verified on the full sets.

Groups of copies are never expanded into pairs. Documents with equal
sets are one class. A class's shingles that no other candidate class
has can be in no intersection, which bounds every similarity it can
reach: this rules out most pairs of heavily edited copies exactly. In
every bucket the classes are compared with a few pivots, those with the
largest share of common shingles; after linking, only buckets that still
hold several components are looked at again, and only for pairs of
different components that the bound allows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from lexispan.llm.common import BROADCAST_BYTES, SLICE_BYTES, Scratch, broadcast_within, let, text_hash, without
from lexispan.llm.words import mix, row_slices, shingle_hashes, word_hashes

WIDTH, THRESHOLD = 5, 0.75
#: Registers, those of a band, and the sketch's scale: base, largest
#: value, rate. At similarity 0.75 a pair misses all 32 bands with
#: probability 6e-6.
REGISTERS, BAND = 128, 4
BASE, TOP, RATE = 1.001, 65535, 20.0
#: Standard errors below the threshold at which an estimate rules a pair out.
MARGIN = 4.5
#: Pivots of a bucket.
PIVOTS = 3
#: Bytes of a row of numbers in a table that is broadcast.
_ROW_BYTES = 64
#: Pairs of one class verified by one task.
FAN = 512
#: Classes of a block in the search for the links left over.
BLOCK = 192
#: Shingles sketched at a time.
GROUP = 1 << 18

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def registers(shingles: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """SetSketch registers of each row's shingles (rows x REGISTERS).

    Each shingle is a Poisson process whose events fall on registers at
    random: the first event on a register is exponentially distributed
    and independent of the others. Processes run until no later event
    can be the smallest of any register.
    """
    rows = len(begins) - 1
    least = np.full((rows, REGISTERS), np.inf)
    flat = least.reshape(-1)
    row = np.repeat(np.arange(rows), np.diff(begins))
    time, key = np.zeros(len(shingles)), shingles
    while len(row):
        key = key + _GOLDEN
        draw = mix(key)
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / REGISTERS
        np.minimum.at(flat, row * REGISTERS + (draw % np.uint64(REGISTERS)).astype(np.int64), time)
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        bound = np.repeat(least[row[first]].max(axis=1), np.diff(np.r_[first, len(row)]))
        active = time < bound
        row, time, key = row[active], time[active], key[active]
    with np.errstate(divide="ignore"):
        scaled = np.floor(1 - np.log(least / RATE) / np.log(BASE))
    return np.clip(scaled, 0, TOP).astype(">u2")


def _sets(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, sorted distinct shingles, begins) of ranges of rows."""
    for first, last in row_slices(texts, SLICE_BYTES):
        for at, end, found, begins in _slice_sets(texts.slice(first, last - first)):
            yield first + at, first + end, found, begins


def _slice_sets(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    words, rows = word_hashes(texts)
    at = 0
    while at < len(rows) - 1:
        end = max(at + 1, int(np.searchsorted(rows, rows[at] + GROUP, "right")) - 1)
        own = words[rows[at]:rows[end]]
        found, begins = shingle_hashes(own, rows[at:end + 1] - rows[at], WIDTH)
        for a, b in zip(begins[:-1], begins[1:], strict=True):
            found[a:b].sort()
        fresh = np.ones(len(found), dtype=bool)
        fresh[1:] = found[1:] != found[:-1]
        fresh[begins[:-1][np.diff(begins) > 0]] = True
        counts = np.r_[0, np.cumsum(fresh)]
        yield at, end, found[fresh], counts[begins]
        at = end


def _digests(found: np.ndarray, begins: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit sums that stand for each row's set."""
    out = []
    salted = found
    for _ in range(2):
        salted = mix(salted + _GOLDEN)
        sums = np.r_[np.uint64(0), np.cumsum(salted, dtype=np.uint64)]
        out.append((sums[begins[1:]] - sums[begins[:-1]]).view(np.int64))
    return out


def _batch(rows: list[list], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, types, strict=True)], names=names)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, end, found, begins in _sets(batch.column("text")):
            k1, k2 = _digests(found, begins)
            packed = registers(found, begins)
            carried = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).slice(at, end - at) for c in carried], pa.array(np.diff(begins), pa.int64()),
                 pa.array(k1), pa.array(k2), pa.array([r.tobytes() for r in packed], pa.binary())],
                names=[*carried, "n", "k1", "k2", "registers"])
        pa.default_memory_pool().release_unused()


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cid, shingles) of texts whose set is the class's, once a task."""
    done: set[int] = set()
    for batch in batches:
        fresh = []
        for cid in batch.column("cid").to_pylist():
            fresh.append(cid not in done)
            done.add(cid)
        batch = batch.filter(pa.array(fresh, pa.bool_()))
        own = np.column_stack([batch.column(c).to_numpy() for c in ("n", "k1", "k2")])
        for at, end, found, begins in _sets(batch.column("text")):
            same = (np.column_stack([np.diff(begins), *_digests(found, begins)]) == own[at:end]).all(axis=1)
            sets = pa.LargeListArray.from_arrays(pa.array(begins, pa.int64()), pa.array(found.view(np.int64)))
            keep = pa.array(same)
            yield pa.RecordBatch.from_arrays(
                [batch.column("cid").slice(at, end - at).filter(keep),
                 sets.filter(keep).cast(pa.list_(pa.int64()))], names=["cid", "shingles"])
        pa.default_memory_pool().release_unused()


def likely(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of register rows ``a``, ``b``
    of sets of known sizes: the share of registers that are larger in
    one, in the other or equal fixes it jointly with the sizes."""
    above, below = (a > b).sum(axis=1), (a < b).sum(axis=1)
    equal = a.shape[1] - above - below
    u = n_a / (n_a + n_b)
    v = 1 - u

    def share(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def log_likelihood(j: np.ndarray) -> np.ndarray:
        p, q = share(u - v * j), share(v - u * j)
        tiny = 1e-12
        return (above * np.log(np.maximum(p, tiny)) + below * np.log(np.maximum(q, tiny))
                + equal * np.log(np.maximum(1 - p - q, tiny)))
    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(40):  # the likelihood has one maximum
        third = (high - low) / 3
        left = log_likelihood(low + third) < log_likelihood(high - third)
        low, high = np.where(left, low + third, low), np.where(left, high, high - third)
    return (low + high) / 2


def _floor(threshold: float) -> float:
    """Smallest estimate that does not rule a pair out."""
    return threshold - MARGIN * np.sqrt(threshold * (1 - threshold) / REGISTERS)


def _may_reach(threshold: float):
    floor = _floor(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), ">u2").reshape(-1, REGISTERS)
                    for c in ("registers_a", "registers_b"))
            n_a, n_b = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            estimate = likely(a, b, n_a, n_b)
            keep = estimate >= floor
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(pa.array(keep)), batch.column("b").filter(pa.array(keep)),
                 pa.array(estimate[keep])], names=["a", "b", "estimate"])
    return run


_SIDE = ["bucket", "own", "band", "cid", "n", "common", "label", "inside", "outside", "registers"]


def _block_pairs(threshold: float):
    """Pairs of each group (bucket, low, high) of sorted rows."""
    percent, floor = round(100 * threshold), _floor(threshold)

    def pairs_of(group: pa.Table) -> pa.RecordBatch | None:
        col = {c: group[c].to_numpy() for c in _SIDE[1:-1]}
        low, high = group["low"][0].as_py(), group["high"][0].as_py()
        one = np.flatnonzero(col["own"] == low)
        two = np.flatnonzero(col["own"] == high)
        if not len(one) or not len(two):
            return None

        def least(name: str) -> np.ndarray:
            return np.minimum(col[name][one][:, None], col[name][two][None, :])
        most = np.minimum(least("common"), least("inside") + least("outside"))
        total = col["n"][one][:, None] + col["n"][two][None, :]
        may = (col["label"][one][:, None] != col["label"][two][None, :]) & (100 * most >= percent * (total - most))
        if low == high:
            may &= col["cid"][one][:, None] < col["cid"][two][None, :]
        a, b = (side[at] for side, at in zip((one, two), np.nonzero(may), strict=True))
        raw = b"".join(group["registers"].to_pylist())
        bands = np.frombuffer(raw, f"V{2 * BAND}").view("<u8").reshape(group.num_rows, -1)
        # Classes that share several buckets meet in the first of them.
        first = (bands[a] == bands[b]).argmax(axis=1) == col["band"][0]
        a, b = a[first], b[first]
        if not len(a):
            return None
        registers_ = np.frombuffer(raw, ">u2").reshape(group.num_rows, REGISTERS)
        estimate = likely(registers_[a], registers_[b], col["n"][a], col["n"][b])
        keep = estimate >= floor
        left, right = col["cid"][a][keep], col["cid"][b][keep]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.minimum(left, right)), pa.array(np.maximum(left, right)), pa.array(estimate[keep])],
            names=["a", "b", "estimate"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in itertools.chain(batches, [None]):
            if batch is None:
                rows, done = held, held.num_rows if held is not None else 0
            else:
                rows = pa.Table.from_batches([batch])
                if held is not None:
                    rows = pa.concat_tables([held, rows]).combine_chunks()
                done = None
            if rows is None or not rows.num_rows:
                continue
            key = np.column_stack([rows[c].to_numpy() for c in ("bucket", "low", "high")])
            edges = np.r_[0, np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1, rows.num_rows]
            if done is None:  # the last group may go on in the next batch
                held, edges = rows.slice(edges[-2]), edges[:-1]
            for start, end in itertools.pairwise(edges):
                if end - start > 1 and (out := pairs_of(rows.slice(start, end - start))) is not None:
                    yield out
    return run


def _compared(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared, linked = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, dtype=bool)
            one, two = batch.column("shingles_a"), batch.column("shingles_b")
            for i in range(batch.num_rows):
                a, b = one[i].values.to_numpy(), two[i].values.to_numpy()
                both = np.sort(np.concatenate([a, b]))
                shared[i] = (both[1:] == both[:-1]).sum()
                linked[i] = 100 * shared[i] >= percent * (len(a) + len(b) - shared[i])
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(shared), pa.array(linked)],
                names=["a", "b", "shared", "linked"])
            pa.default_memory_pool().release_unused()
    return run


def components(links: DataFrame, scratch: Scratch | None = None, rounds: int | None = None) -> DataFrame:
    """(id, label): the smallest id reachable over links (a, b); after
    ``rounds`` rounds some smaller one, not yet the smallest."""
    scratch = scratch or Scratch(links.sparkSession)
    both = scratch.table(links.select("a", "b").union(links.select("b", "a")), "edges")
    labels = scratch.table(both.groupBy(F.col("a").alias("id")).agg(
        F.least("id", F.min("b")).alias("label")), "labels")
    while rounds is None or rounds > 0:
        rounds = None if rounds is None else rounds - 1
        near = both.join(labels, both["b"] == labels["id"]).groupBy("a").agg(F.min("label").alias("near"))
        closer = labels.join(near, labels["id"] == near["a"]).select(
            "id", F.col("label").alias("old"), F.least("label", "near").alias("to"))
        closer = scratch.table(closer, "closer")
        if closer.where("old <> to").isEmpty():
            scratch.drop(closer)
            break
        ends = closer.select(F.col("id").alias("end"), F.col("to").alias("further"))
        further = scratch.table(closer.join(ends, closer["to"] == ends["end"]).select(
            "id", F.least("to", "further").alias("label")), "labels")
        scratch.drop(labels, closer)
        labels = further
    scratch.drop(both)
    return labels


def _pairs_with(pairs: DataFrame, values: DataFrame, columns: list[str], scratch: Scratch,
                value_bytes: Column) -> DataFrame:
    """Distinct pairs (a, b) with both sides' columns, of ``value_bytes``
    a row.

    Many pairs share their class a, a pivot, while few share their b.
    The pairs, which are two numbers, go to the values of b where they
    lie, and the few classes that are an a bring their values to the
    pairs. Where either is too large to be broadcast, the sides are
    dealt by class, and a class that is in many pairs is copied, so that
    its pairs spread over many tasks.
    """
    def named(side: str) -> DataFrame:
        return values.select(F.col("cid").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns])
    pairs = pairs.select("a", "b")
    ends = broadcast_within(pairs, _ROW_BYTES)
    with_b = named("b").join(ends, "b")
    pivots = broadcast_within(scratch.table(pairs.select("a").distinct(), "ends"), _ROW_BYTES)
    size = values.join(pivots, F.col("cid") == F.col("a")).agg(F.sum(value_bytes + _ROW_BYTES)).first()[0] or 0
    own = named("a").join(pivots, "a")
    if size <= BROADCAST_BYTES:
        return with_b.join(F.broadcast(own), "a")
    copies = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / FAN).cast("int").alias("_copies")).where("_copies > 1")
    copies = broadcast_within(scratch.table(copies, "copies"), _ROW_BYTES)
    number = F.coalesce("_copies", F.lit(1))
    own = own.join(copies, "a", "left").withColumn("_copy", F.explode(F.sequence(F.lit(0), number - 1))).drop("_copies")
    dealt = with_b.join(copies, "a", "left").withColumn(
        "_copy", F.pmod(F.xxhash64("b"), number).cast("int")).drop("_copies")
    return dealt.join(own, ["a", "_copy"]).drop("_copy")


def _bands():
    """Bucket of each band of the registers."""
    width, count = 2 * BAND, REGISTERS // BAND
    return let(F.col("registers"), lambda r: F.transform(
        F.sequence(F.lit(0), F.lit(count - 1)),
        lambda i: F.xxhash64(i, F.substring(r, i * width + 1, F.lit(width)))))


class _Classes:
    """Classes of equal sets and what is compared of them."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, threshold: float) -> None:
        self.threshold, self.percent = threshold, round(100 * threshold)
        self.scratch = Scratch(docs.sparkSession)
        self.texts = docs.select(F.col(id_col).cast("long").alias("id"), text_hash(text_col).alias("text_hash"),
                                 F.col(text_col).alias("text"))
        sketched = self.texts.mapInArrow(
            _sketch, "id long, text_hash long, n long, k1 long, k2 long, registers binary")
        self.rows = self.scratch.table(sketched, "sketches")
        # A class's sets are made again from one of its texts.
        classes = self.rows.where("n > 0").groupBy("k1", "k2", "n").agg(
            F.min("id").alias("first"), F.min(F.struct("id", "text_hash")).alias("one"),
            F.min("registers").alias("registers"))
        self.table = self.scratch.table(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
        members = self._members()
        self.sets = self._full(members)
        self.members = self._bounded(members)

    def _members(self) -> DataFrame:
        """(bucket, band, cid) of classes that share a band with another."""
        spread = self.table.select("cid", F.posexplode(_bands()).alias("band", "bucket"))
        met = spread.groupBy("bucket").agg(
            F.min("band").alias("band"), F.min("cid").alias("low"), F.max("cid").alias("high"),
            F.count(F.lit(1)).alias("members"))
        met = self.scratch.table(met.where("low <> high"), "buckets")
        # Two members are the two ends; the others of larger buckets are found again.
        pairs = met.where("members = 2").select("bucket", "band", F.explode(F.array("low", "high")).alias("cid"))
        large = self.scratch.table(met.where("members > 2").select("bucket"), "large")
        more = spread.join(broadcast_within(large, _ROW_BYTES), "bucket").select("bucket", "band", "cid")
        members = self.scratch.table(pairs.unionByName(more), "members")
        self.scratch.drop(met, large)
        return members

    def _full(self, members: DataFrame) -> DataFrame:
        """(cid, shingles) of all candidate classes, made again from one
        text of each."""
        candidates = self.scratch.table(members.select("cid").distinct(), "candidates")
        wanted = self.scratch.table(self.table.select("cid", "n", "k1", "k2", "one").join(
            broadcast_within(candidates, _ROW_BYTES), "cid").select(
            "cid", "n", "k1", "k2", F.col("one.id").alias("_id"), F.col("one.text_hash").alias("_hash")), "wanted")
        same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
        texts = self.texts.join(broadcast_within(wanted, _ROW_BYTES), same).drop("id", "_id", "text_hash", "_hash")
        sets = self.scratch.table(texts.mapInArrow(_full_sets, "cid long, shingles array<long>"), "sets")
        repeated = sets.groupBy("cid").count().where("count > 1")
        if not repeated.isEmpty():  # rows of one id and text in several tasks
            single = self.scratch.table(sets.dropDuplicates(["cid"]), "single")
            self.scratch.drop(sets)
            sets = single
        self.scratch.drop(candidates, wanted)
        return sets

    def _bounded(self, members: DataFrame) -> DataFrame:
        """Members with n and common, the number of shingles that some
        other candidate class has too. Those that no set of the
        bucket's sizes can bring to the threshold are left out."""
        spread = self.sets.select("cid", F.explode("shingles").alias("shingle"))
        alone = spread.groupBy("shingle").agg(F.min("cid").alias("cid"), F.max("cid").alias("last"))
        alone = alone.where("cid = last").groupBy("cid").agg(F.count(F.lit(1)).alias("alone"))
        sizes = self.sets.select("cid", F.size("shingles").cast("long").alias("n"))
        nodes = self.scratch.table(sizes.join(alone, "cid", "left").select(
            "cid", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("common")), "nodes")
        joined = self.scratch.table(members.join(broadcast_within(nodes, _ROW_BYTES), "cid"), "joined")
        least = self.scratch.table(joined.groupBy("bucket").agg(F.min("n").alias("least")), "least")
        partner = F.greatest("least", "common")
        reach = 100 * F.col("common") >= self.percent * (F.col("n") + partner - F.col("common"))
        bounded = self.scratch.table(joined.join(
            broadcast_within(least, _ROW_BYTES), "bucket").where(reach).drop("least"), "bounded")
        self.scratch.drop(members, nodes, joined, least)
        return bounded

    def within_reach(self, a: str, b: str):
        """Condition that the shared shingles of two sides could do."""
        shared = F.least(f"{a}.common", f"{b}.common")
        return 100 * shared >= self.percent * (F.col(f"{a}.n") + F.col(f"{b}.n") - shared)

    def stars(self) -> DataFrame:
        """Distinct pairs (a, b) of each bucket's pivots and members."""
        rank = F.row_number().over(W.partitionBy("bucket").orderBy(F.desc(F.col("common") / F.col("n")), "cid"))
        self.pivots = self.scratch.table(self.members.withColumn("rank", rank).where(F.col("rank") <= PIVOTS), "pivots")
        one, two = self.pivots.alias("one"), self.members.alias("two")
        met = two.join(one, (F.col("one.bucket") == F.col("two.bucket")) & (F.col("one.cid") != F.col("two.cid"))
                       & self.within_reach("one", "two"))
        return met.select(F.col("one.cid").alias("a"), F.col("two.cid").alias("b")).distinct()

    def plausible(self, pairs: DataFrame) -> DataFrame:
        """Of distinct pairs (a, b), those whose estimate may reach the threshold."""
        known = _pairs_with(pairs, self.table, ["n", "registers"], self.scratch, F.lit(2 * REGISTERS))
        return self.scratch.table(known.mapInArrow(_may_reach(self.threshold), "a long, b long, estimate double"),
                            "plausible")

    def compare(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) with the size of their full sets' intersection
        and whether they link."""
        known = _pairs_with(pairs, self.sets, ["shingles"], self.scratch, 8 * F.size("shingles"))
        return self.scratch.table(known.mapInArrow(
            _compared(self.percent), "a long, b long, shared long, linked boolean"), "compared")

    def open_members(self, labels: DataFrame) -> DataFrame:
        """Members of buckets that hold several components, with their
        label and the bucket's first pivot."""
        marked = self.members.join(labels, "cid", "left").withColumn("label", F.coalesce("label", "cid"))
        marked = self.scratch.table(marked, "marked")
        several = marked.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"),
                                               F.count(F.lit(1)).alias("members"))
        pivots = self.pivots.where("rank = 1").select("bucket", F.col("cid").alias("pivot"), F.col("n").alias("n_pivot"))
        several = self.scratch.table(several.where("low <> high").select("bucket", "members").join(pivots, "bucket"), "several")
        return self.scratch.table(marked.join(several, "bucket"), "open")

    def residual(self, open_: DataFrame, compared: DataFrame) -> DataFrame:
        """Pairs (a, b) of different components that share a bucket and
        whose sets could link, each once, by bound and by estimate.

        What two sets share lies inside the bucket's pivot, at most the
        smaller of their intersections with it, or outside, at most the
        smaller number of common shingles there. A class that was not
        compared with the pivot, being no link of it by its estimate, is
        bounded by that and by its common shingles alone.

        A bucket is cut into blocks of about BLOCK classes; every two
        blocks meet in one group of bounded size, which hands on only
        the pairs that may link.
        """
        known = compared.groupBy(F.col("a").alias("_a"), F.col("b").alias("_b")).agg(F.max("shared").alias("shared"))
        with_pivot = open_.join(known, (F.col("pivot") == F.col("_a")) & (F.col("cid") == F.col("_b")), "left")
        shared = F.when(F.col("cid") == F.col("pivot"), F.col("n")).otherwise(F.col("shared"))
        below = F.floor((F.col("n") + F.col("n_pivot")) * self.percent / (100 + self.percent))
        sides = with_pivot.select(
            "bucket", "band", "cid", "n", "common", "label", F.coalesce(shared, below).alias("inside"),
            F.when(shared.isNull(), F.col("common")).otherwise(
                F.greatest(F.col("common") - shared, F.lit(0))).alias("outside"),
            F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
        sides = sides.join(self.table.select("cid", "registers"), "cid")
        own = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
        others = F.sequence(F.lit(0), F.col("blocks") - 1)
        sides = sides.withColumn("own", own).select("*", F.explode(others).alias("other")).select(
            F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), *_SIDE)
        dealt = sides.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
        return self.scratch.table(dealt.mapInArrow(_block_pairs(self.threshold), "a long, b long, estimate double"),
                            "residual")


def _labelled(links: DataFrame, scratch: Scratch, rounds: int | None = None) -> DataFrame:
    """(cid, label) of classes with links."""
    return components(links, scratch, rounds).withColumnRenamed("id", "cid")


def _merged(labels: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """Labels after further links: only components that these touch are
    joined, whatever the number of links before."""
    def label(side: str) -> DataFrame:
        return labels.select(F.col("cid").alias(side), F.col("label").alias(f"label_{side}"))
    ends = links.join(label("a"), "a", "left").join(label("b"), "b", "left").select(
        "a", "b", F.coalesce("label_a", "a").alias("x"), F.coalesce("label_b", "b").alias("y"))
    ends = scratch.table(ends, "ends")
    joined = scratch.table(components(ends.select(F.col("x").alias("a"), F.col("y").alias("b")), scratch).select(
        F.col("id").alias("old"), F.col("label").alias("new")), "joined")
    single = ends.select(F.explode(F.array(F.struct(F.col("a").alias("cid"), F.col("x").alias("label")),
                                           F.struct(F.col("b").alias("cid"), F.col("y").alias("label")))).alias("e"))
    single = single.select("e.*").distinct().join(labels, "cid", "left_anti")
    # Both sides are written, so that a large component is split over tasks.
    known = scratch.table(labels.unionByName(single), "known")
    return known.join(broadcast_within(joined, _ROW_BYTES), F.col("label") == F.col("old"), "left").select(
        "cid", F.coalesce("new", "label").alias("label"))


def link_classes(classes: _Classes) -> DataFrame:
    """(cid, label) of all linked classes: components over all links."""
    scratch = classes.scratch
    stars = classes.plausible(scratch.table(classes.stars(), "stars"))
    # Each class with its likeliest pivot first, then what that left open.
    best = stars.groupBy("b").agg(F.max_by("a", F.struct("estimate", "a")).alias("a")).select("a", "b")
    compared = classes.compare(scratch.table(best, "best"))
    # Labels are here to save comparisons: one round does.
    labels = broadcast_within(_labelled(compared.where("linked"), scratch, 1), _ROW_BYTES)

    def more(pairs: DataFrame) -> DataFrame:
        fresh = scratch.table(pairs.join(compared.select("a", "b"), ["a", "b"], "left_anti"), "fresh")
        return compared if fresh.isEmpty() else scratch.table(
            compared.unionByName(classes.compare(fresh)), "compared")

    left = labels.select(F.col("cid").alias("a"), F.col("label").alias("label_a"))
    right = labels.select(F.col("cid").alias("b"), F.col("label").alias("label_b"))
    apart = stars.join(left, "a", "left").join(right, "b", "left").where(
        F.coalesce("label_a", "a") != F.coalesce("label_b", "b"))
    compared = more(apart.select("a", "b"))
    labels = _labelled(compared.where("linked"), scratch)
    open_ = classes.open_members(labels)
    with_pivot = open_.where("cid <> pivot").select(F.col("pivot").alias("a"), F.col("cid").alias("b")).distinct()
    compared = more(with_pivot.join(stars.select("a", "b"), ["a", "b"], "left_semi"))
    tried = compared.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = classes.residual(open_, compared).select("a", "b").join(tried, ["a", "b"], "left_anti")
    late = classes.compare(scratch.table(rest, "fresh")).where("linked")
    found = scratch.table(labels if late.isEmpty() else _merged(labels, late, scratch), "found")
    scratch.drop_all_but(classes.rows, classes.table, found)
    return found


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               threshold: float = THRESHOLD) -> DataFrame:
    """Components of near-duplicate documents; one row per input row.

    Returns doc_id, n_shingles, component_id and kept. Words are runs of
    bytes outside 0x09-0x0D and 0x20 with A-Z lower-cased; a document's
    set holds its distinct five-word shingles, or its whole sequence
    when it has fewer words. Documents link when the Jaccard similarity
    of their sets reaches ``threshold``; a null or wordless text links
    with nothing. component_id is the smallest id reachable over links
    (nulls aside), kept whether it is the row's own. Repeated rows of
    one id are all kept or all dropped. An empty table gives an empty
    result; other columns are not read.
    """
    return _marked(docs, id_col, text_col, threshold)[0].drop("text_hash")


def _marked(docs: DataFrame, id_col: str, text_col: str, threshold: float) -> tuple[DataFrame, Scratch]:
    """``near_dedup``'s rows with text_hash, in a table of their own."""
    classes = _Classes(docs, id_col, text_col, threshold)
    scratch, labels = classes.scratch, link_classes(classes)
    # The classes of a component meet in sums, then its row goes to them.
    firsts = labels.join(classes.table.select("cid", "k1", "k2", "n", "first"), "cid")
    firsts = scratch.table(firsts, "firsts")
    smallest = scratch.table(firsts.groupBy("label").agg(F.min("first").alias("component")), "smallest")
    found = scratch.table(firsts.join(broadcast_within(smallest, _ROW_BYTES), "label").select(
        "k1", "k2", "n", "component"), "components")
    alone = classes.table.join(labels, "cid", "left_anti").select("k1", "k2", "n", F.col("first").alias("component"))
    found = scratch.table(found.unionByName(alone), "all")
    marked = classes.rows.select("id", "text_hash", "n", "k1", "k2").join(found, ["k1", "k2", "n"], "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.coalesce("component", "id").alias("component_id"),
        F.col("id").eqNullSafe(F.coalesce("component", "id")).alias("kept"), "text_hash")
    marked = scratch.table(marked, "marked")
    scratch.drop_all_but(marked)
    return marked, scratch


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Only the
    ids and hashes of those that go are carried to the texts; of rows
    that share an id, null or not, each goes by its own text. Of equal
    rows of one id all stay or all go; an empty table stays empty."""
    marked, scratch = _marked(docs, id_col, text_col, THRESHOLD)
    return without(docs, marked.where(~F.col("kept")), id_col, text_col, scratch)
