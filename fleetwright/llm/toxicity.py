"""Toxicity by the nearest labelled examples.

Learning, on a bounded sample of labelled rows: every word in it is a term, and every
example with a word is in the index. Examples become unit TF-IDF vectors over the terms,
a term weighing more the further its presence goes with or against the label beyond
chance (root of chi-square). They go into an inverted index whose example range is cut
into blocks; for the terms many examples share the largest weight in each block is kept.

Scoring: sums over the rarer terms' postings are exact, and with the block maxima of
the others they bound what a block can reach. The blocks that can reach the k-th best
similarity are looked into, for many documents by one matrix product, and what
comes out on top is summed again in full precision. Found are the exact k most
similar examples by cosine, ties to the smaller id. They vote with one over
their distance; a monotone curve fitted to votes on the examples themselves, each
without itself, makes a probability of the vote. The neighbours are the evidence.

Defined cases: a NULL or empty text gets the share of toxic ones among examples
without words, 0 if there are none; a text none of whose words is in the sample gets
the share among all; without any usable label the score is 0. A document labelled
more than once is toxic if one label says so; NULL labels are left out. Equal rows
get equal scores; a NULL id is carried and counts as held out. Other columns are not
read, or kept as they are (`without_toxic`).
"""

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fleetwright.llm.common import byte_texts, give_back, held_out, in_slices, make_room, materialise

# Bound of learning: rows (expected; drawn by a hash of the id).
SAMPLE_ROWS = 12_000
NEIGHBOURS, BLOCK_EXAMPLES = 15, 64
THRESHOLD = 0.5
_SEED = 5
# What is stripped off a word.
_EDGES = b".,;:!?\"'()[]|#*$%&<>"
# The distance two equal vectors count as having, and the prior's weight in a vote.
_NEAR, _PRIOR = 0.05, 0.5
# A term in more than one of so many examples is kept by blocks; the others by postings.
_COMMON = 16
# Documents whose vectors are held together, those searched together; more than single precision can be wrong by.
SLICE_ROWS, _TOGETHER, _SLACK = 512, 128, 1e-5


def words(text: bytes) -> Counter:
    """The words of a text, without marks at their edges, and how often each is there."""
    found = Counter()
    for word, n in Counter(text.lower().split()).items():
        if bare := word.strip(_EDGES):
            found[bare] += n
    return found


# ---- index ------------------------------------------------------------------

# Ascending term numbers and their weights.
Vector = tuple[np.ndarray, np.ndarray]


def _arrays(vector) -> Vector:
    if isinstance(vector, dict):
        terms = sorted(vector)
        vector = terms, [vector[t] for t in terms]
    return np.asarray(vector[0], np.int32), np.asarray(vector[1], np.float64)


def _places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of runs of `sizes` from `starts`, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class BlockMaxIndex:
    """Unit vectors by term, with the largest weight of each common term in each block."""

    def __init__(self, vectors: list, terms: int, block: int = BLOCK_EXAMPLES):
        vectors = [_arrays(v) for v in vectors]
        self._fill(np.array([len(t) for t, _ in vectors], np.int64),
                   np.concatenate([np.zeros(0, np.int32), *(t for t, _ in vectors)]),
                   np.concatenate([np.zeros(0), *(w for _, w in vectors)]), terms, block)

    @classmethod
    def of_joined(cls, sizes: np.ndarray, numbers: np.ndarray, values: np.ndarray, terms: int) -> "BlockMaxIndex":
        """The index of vectors that lie one after the other."""
        index = cls.__new__(cls)
        index._fill(sizes, numbers, values, terms, BLOCK_EXAMPLES)
        return index

    def _fill(self, sizes, numbers, values, terms, block):
        self.size, self.block = len(sizes), block
        self.blocks = -(-len(sizes) // block)
        self.sizes, self.terms, self.values = sizes, numbers, values
        self.begins = np.cumsum(self.sizes) - self.sizes
        # Postings: the examples of each term, ascending.
        order = np.argsort(self.terms, kind="stable")
        self.examples = np.repeat(np.arange(self.size, dtype=np.int32), self.sizes)[order]
        self.weights = self.values.astype(np.float32)[order]
        self.rows = np.bincount(self.terms, minlength=terms)
        self.first = np.cumsum(self.rows) - self.rows
        common = np.flatnonzero(self.rows > self.size // _COMMON)
        self.slot = np.full(terms, -1, np.int32)
        self.slot[common] = np.arange(len(common))
        self.starts, self.highest = {}, np.zeros((len(common), self.blocks), np.float32)
        edges = np.arange(self.blocks + 1) * block
        for slot, term in enumerate(common.tolist()):
            run = slice(self.first[term], self.first[term] + self.rows[term])
            self.starts[term] = self.first[term] + np.searchsorted(self.examples[run], edges)
            np.maximum.at(self.highest[slot], self.examples[run] // block, self.weights[run])
        self._slabs: dict[int, np.ndarray] = {}
        self._whole = None

    def vector(self, example: int) -> Vector:
        run = slice(self.begins[example], self.begins[example] + self.sizes[example])
        return self.terms[run], self.values[run]

    def _slab(self, block: int) -> np.ndarray:
        """Weights of the common terms in the examples of a block, put together when first looked into."""
        if block not in self._slabs:
            slab = np.zeros((len(self.starts), self.block), np.float32)
            for slot, starts in enumerate(self.starts.values()):
                a, b = starts[block], starts[block + 1]
                if a < b:
                    slab[slot, self.examples[a:b] - block * self.block] = self.weights[a:b]
            self._slabs[block] = slab
        return self._slabs[block]

    def nearest(self, vector, k: int, skip: int = -1) -> list[tuple[float, int]]:
        """The k largest positive cosines as (cosine, example), best first, ties to the smaller example."""
        return self.nearest_of([_arrays(vector)], k, [skip])[0]

    def nearest_of(self, vectors: list[Vector], k: int, skips=None) -> list[list[tuple[float, int]]]:
        """`nearest` of each vector."""
        if not self.size:
            return [[] for _ in vectors]
        skips = [-1] * len(vectors) if skips is None else skips
        found = []
        for start in range(0, len(vectors), _TOGETHER):
            some = slice(start, start + _TOGETHER)
            found += self._together(vectors[some], k, skips[some])
        return found

    def _together(self, vectors, k, skips):
        asked = np.zeros((len(vectors), len(self.starts)), np.float32)
        scores = np.zeros((len(vectors), self.blocks * self.block), np.float32)
        for row, ((terms, weights), skip) in enumerate(zip(vectors, skips)):
            slots = self.slot[terms]
            asked[row, slots[slots >= 0]] = weights[slots >= 0]
            rare, weights = terms[slots < 0], weights[slots < 0]
            sizes = self.rows[rare]
            at = _places(self.first[rare], sizes)
            scores[row, :self.size] = np.bincount(
                self.examples[at], np.repeat(weights, sizes) * self.weights[at], self.size)
            if skip >= 0:
                scores[row, skip] = -np.inf
        by_block = scores.reshape(len(vectors), self.blocks, self.block)
        reach = by_block.max(axis=2) + asked @ self.highest
        best = np.zeros((len(vectors), k), np.float32)
        for block in np.argsort(-reach.sum(axis=0), kind="stable").tolist():
            some = np.flatnonzero((reach[:, block] > 0) & (reach[:, block] >= best.min(axis=1) - _SLACK))
            if len(some):
                by_block[some, block] += asked[some] @ self._slab(block)
                both = np.concatenate([best[some], by_block[some, block]], axis=1)
                best[some] = np.partition(both, self.block, axis=1)[:, self.block:]
        # Blocks not looked into have part of their sums only, which are below the k-th best.
        floors = np.maximum(best.min(axis=1) - _SLACK, np.float32(1e-30))
        return [self._exact(vector, np.flatnonzero(row >= floor), k)
                for vector, row, floor in zip(vectors, scores, floors)]

    def _exact(self, vector, examples, k):
        """The best k of `examples`, their cosines summed in the order of the terms."""
        if not len(examples):
            return []
        if self._whole is None:
            self._whole = np.zeros(len(self.slot))
        terms, weights = vector
        sizes = self.sizes[examples]
        at = _places(self.begins[examples], sizes)
        self._whole[terms] = weights
        cosines = np.add.reduceat(self._whole[self.terms[at]] * self.values[at], np.cumsum(sizes) - sizes)
        self._whole[terms] = 0.0
        order = np.lexsort((examples, -cosines))[:k]
        return [(float(cosines[i]), int(examples[i])) for i in order.tolist()]


# ---- model ------------------------------------------------------------------

@dataclass
class Model:
    """What goes to the workers: words and counts, packed. The index is built there."""

    names: bytes
    idf: np.ndarray
    ids: list
    toxic: np.ndarray
    rate: float
    plain_rate: float
    packed: bytes
    curve: tuple[np.ndarray, np.ndarray] = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("terms", "index", "shared")}

    @cached_property
    def terms(self) -> dict[bytes, int]:
        return parted(self.names)

    @cached_property
    def index(self) -> "BlockMaxIndex":
        make_room()
        if not self.ids:
            return BlockMaxIndex([], len(self.idf))
        sizes, terms, counts = _unpacked(self.packed, len(self.ids))
        values, ends = np.empty(len(terms)), np.cumsum(sizes)
        for a, b in zip((ends - sizes).tolist(), ends.tolist()):
            values[a:b] = unit(terms[a:b], counts[a:b], self.idf)[1]
        del counts
        index = BlockMaxIndex.of_joined(sizes, terms, values, len(self.idf))
        give_back()
        return index

    def sent(self, spark):
        """The model at the workers, where its curve is not yet fitted."""
        if "shared" not in self.__dict__:
            self.shared = spark.sparkContext.broadcast(self)
        return self.shared

    def vote(self, near: list[tuple[float, int]]) -> float:
        """Share of toxic neighbours, each by one over its distance, and the prior's share."""
        cosines = np.array([c for c, _ in near])
        weights = cosines / (1.0 - np.minimum(cosines, 1.0) + _NEAR)
        votes = weights @ self.toxic[[e for _, e in near]]
        return float((votes + _PRIOR * self.rate) / (weights.sum() + _PRIOR))

    def scores(self, vectors: "Vectors", texts: list[bytes]) -> list[tuple[float, list[int]]]:
        found = self.index.nearest_of([vectors.of(t) for t in texts], NEIGHBOURS)
        return [self.score(near) if near else (self.rate if t.split(None, 1) else self.plain_rate, [])
                for t, near in zip(texts, found)]

    def score(self, near: list[tuple[float, int]]) -> tuple[float, list[int]]:
        vote = self.vote(near)
        # The vote itself, with little weight, keeps the order where the curve is flat.
        smooth = 0.999 * float(np.interp(vote, *self.curve)) + 0.001 * vote
        return min(max(smooth, 0.0), 1.0), [e for _, e in near]


def joined(terms) -> bytes:
    return zlib.compress(b"\n".join(terms), 1)


def parted(packed: bytes) -> dict[bytes, int]:
    """The terms by number; a term has no white space inside."""
    return {t: i for i, t in enumerate(zlib.decompress(packed).split())}


def _packed(rows: list[tuple[np.ndarray, np.ndarray]]) -> bytes:
    """Term numbers, as steps, and counts of all rows, their bytes by place."""
    none = [np.zeros(0, np.int32)]
    columns = [np.array([len(t) for t, _ in rows], np.int32),
               np.concatenate(none + [np.diff(t, prepend=np.int32(0)) for t, _ in rows]),
               np.concatenate(none + [n for _, n in rows])]
    return zlib.compress(b"".join(c.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes() for c in columns), 1)


def _unpacked(packed: bytes, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes, term numbers and counts of all rows, one after the other: many small arrays
    would leave the worker's memory in pieces."""
    plain = np.frombuffer(zlib.decompress(packed), np.uint8)

    def column(part):
        return np.array(part.reshape(4, -1).T, order="C").view("<i4").ravel()

    sizes, rest = column(plain[:4 * size]).astype(np.int64), plain[4 * size:]
    ends = np.cumsum(sizes)
    terms, counts = (column(part) for part in np.split(rest, 2))
    for a, b in zip((ends - sizes).tolist(), ends.tolist()):
        terms[a:b] = np.cumsum(terms[a:b], dtype=np.int32)
    return sizes, terms, counts


class Vectors:
    """Unit vectors of texts by the weights of the terms."""

    def __init__(self, terms: dict[bytes, int], idf: np.ndarray):
        self.terms, self.idf = terms, idf

    def counts(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the text's terms, ascending, and how often each is there."""
        counts = {number: n for word, n in words(text).items() if (number := self.terms.get(word)) is not None}
        terms = np.fromiter(counts, np.int32, len(counts))
        order = np.argsort(terms)
        return terms[order], np.fromiter(counts.values(), np.int32, len(counts))[order]

    def of(self, text: bytes) -> Vector:
        return unit(*self.counts(text), self.idf)


def unit(terms: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> Vector:
    weights = (1.0 + np.log(counts)) * idf[terms]
    return terms, weights / math.sqrt((weights * weights).sum() or 1.0)


def rising(votes: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The monotone curve nearest to (vote, label) by pooling neighbours that fall."""
    order = np.argsort(votes, kind="stable")
    pools: list[list[float]] = []
    for x, y in zip(votes[order].tolist(), toxic[order].tolist()):
        pools.append([x, y, 1.0])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            x2, y2, n2 = pools.pop()
            pools[-1] = [pools[-1][0] + x2, pools[-1][1] + y2, pools[-1][2] + n2]
    # Half a row of each kind keeps small pools away from certainty.
    return (np.array([x / n for x, _, n in pools]), np.array([(y + 0.5) / (n + 1.0) for _, y, n in pools]))


# ---- learning ---------------------------------------------------------------

def _sample(docs: DataFrame, labels: DataFrame, sample_rows: int) -> DataFrame:
    """(doc_id, text, toxic) of about `sample_rows` labelled documents, written."""
    usable = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    each = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, sample_rows / max(each.count(), 1))
    drawn = each.filter(F.pmod(F.xxhash64("doc_id", F.lit(_SEED)), F.lit(1_000_000)) < int(share * 1_000_000))
    # The drawn labels number about `sample_rows` whatever the tables hold.
    return materialise(docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id"), "labelled")


def _term_counts(sample: DataFrame) -> DataFrame:
    """(term, rows, toxic_rows), added up in each task first."""
    def counted(batches):
        rows, toxic = Counter(), Counter()
        for batch in in_slices(batches):
            for text, label in zip(byte_texts(batch.column("text")), batch.column("toxic").to_pylist()):
                terms = words(text).keys()
                rows.update(terms)
                if label > 0:
                    toxic.update(terms)
        names = list(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.binary()), pa.array([rows[t] for t in names], pa.int64()),
             pa.array([toxic[t] for t in names], pa.int64())], ["term", "n", "k"])

    return (
        sample.select("text", "toxic").mapInArrow(counted, "term binary, n bigint, k bigint")
        .groupBy("term").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    )


def weights_of(n: np.ndarray, k: np.ndarray, rows: int, toxic: int) -> np.ndarray:
    """IDF of terms in `n` rows, `k` of them toxic, times one and the root of chi-square."""
    idf = np.log((rows + 1) / (n + 1)) + 1.0
    if not 0 < toxic < rows:
        return idf
    rate = toxic / rows
    expected = n * rate
    return idf * (1.0 + np.abs(k - expected) / np.sqrt(expected * (1 - rate) * (1 - n / (rows + 1))))


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from (doc_id, text) and (doc_id, toxic); all rows given may be learnt from."""
    sample = _sample(docs, labels, sample_rows)
    rows, toxic = sample.agg(F.count("*"), F.coalesce(F.sum((F.col("toxic") > 0).cast("long")), F.lit(0))).first()
    # The vocabulary of the sample's rows, whatever the table holds.
    found = _term_counts(sample).toArrow().sort_by("term")
    names = joined(found.column("term").to_pylist())
    idf = weights_of(found.column("n").to_numpy(), found.column("k").to_numpy(), rows, toxic)

    def counted(batches):
        vectors = Vectors(parted(names), np.zeros(0))
        for batch in in_slices(batches):
            counts = [vectors.counts(t) for t in byte_texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"),
                 pa.array([t.astype("<i4").tobytes() for t, _ in counts], pa.binary()),
                 pa.array([n.astype("<i4").tobytes() for _, n in counts], pa.binary())],
                ["doc_id", "toxic", "terms", "counts"])

    # Eight bytes for each term of each of the sample's rows.
    kinds = {f.name: f.dataType.simpleString() for f in sample.schema.fields}
    schema = f"doc_id {kinds['doc_id']}, toxic {kinds['toxic']}, terms binary, counts binary"
    examples = sample.mapInArrow(counted, schema).toArrow()
    del found
    model = _model(names, idf, [
        (key, label > 0, np.frombuffer(t, "<i4"), np.frombuffer(n, "<i4"))
        for batch in examples.to_batches()
        for key, label, t, n in zip(*(c.to_pylist() for c in batch.columns))])
    return _fitted(docs.sparkSession, model)


def _model(names, idf, examples) -> Model:
    """Rates and examples. Similar examples lie together: by their heaviest term, then id."""
    plain = [label for _, label, found, _ in examples if not len(found)]
    kept = sorted((e for e in examples if len(e[2])), key=lambda e: (e[2][unit(*e[2:], idf)[1].argmax()], e[0]))
    toxic = np.array([float(label) for _, label, _, _ in kept])
    rate = sum(label for _, label, _, _ in examples) / len(examples) if examples else 0.0
    return Model(names, idf, [e[0] for e in kept], toxic, rate, sum(plain) / (len(plain) + 1.0),
                 _packed([e[2:] for e in kept]))


def _fitted(spark, model: Model) -> Model:
    """The model with the curve of its examples' votes, each without itself."""
    shared = model.sent(spark)

    def voted(batches):
        model = shared.value
        for batch in batches:
            some = batch.column("id").to_pylist()
            near = model.index.nearest_of([model.index.vector(i) for i in some], NEIGHBOURS, some)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([model.vote(n) if n else None for n in near], pa.float64())], ["id", "vote"])

    if model.ids:
        rows = spark.range(0, len(model.ids), 1, -(-len(model.ids) // 1_000))
        votes = rows.mapInArrow(voted, "id bigint, vote double").filter("vote IS NOT NULL").toArrow().sort_by("id")
        if votes.num_rows:
            model.curve = rising(votes.column("vote").to_numpy(), model.toxic[votes.column("id").to_numpy()])
    return model


# ---- scoring ----------------------------------------------------------------

def scores(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, score, nearest): the probability and the ids of the neighbours, most similar first."""
    shared, curve = model.sent(docs.sparkSession), model.curve

    def scored(batches):
        model = shared.value
        model.curve = curve
        vectors = Vectors(model.terms, model.idf)
        for batch in in_slices(batches):
            found = model.scores(vectors, byte_texts(batch.column("_text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key"), pa.array([s for s, _ in found], pa.float64()),
                 pa.array([[model.ids[e] for e in near] for _, near in found], pa.list_(pa.int64()))],
                ["_key", "score", "nearest"])
        give_back()

    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    kind = rows.schema["_key"].dataType.simpleString()
    return rows.mapInArrow(scored, f"_key {kind}, score double, nearest array<bigint>").withColumnRenamed("_key", key)


def predicted(score: Column) -> Column:
    return F.when(score >= THRESHOLD, 1).otherwise(0)


def without_toxic(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents below the threshold, all columns as they are."""
    shared, curve = model.sent(docs.sparkSession), model.curve

    @F.arrow_udf("double")
    def score(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        model.curve = curve
        vectors = Vectors(model.terms, model.idf)
        for texts in parts:
            found = []
            for start in range(0, len(texts), SLICE_ROWS):
                some = byte_texts(texts.slice(start, SLICE_ROWS))
                found += [score for score, _ in model.scores(vectors, some)]
            yield pa.array(found, pa.float64())
        give_back()

    return docs.filter(score(F.coalesce(F.col(text), F.lit(""))) < THRESHOLD)


def learning_rows(docs: DataFrame, modulus: int, remainder: int) -> DataFrame:
    """The rows that may be learnt from: those not held out."""
    return docs.filter(~held_out("doc_id", modulus, remainder))
