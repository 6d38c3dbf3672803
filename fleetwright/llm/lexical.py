"""Ranked lexical search: sums over short lists first, then documents at a time over long ones.

Queries are taken in blocks of a bounded number of items, each against all documents.
For a block every document is read once; consecutive documents form segments with an
inverted index of the terms that the block asks for (position, occurrences) and the
length of each document. Segments are written, and the corpus counts (documents with a
term, all terms, documents per term) are summed from them by Spark.

Searching a segment for an item is a hybrid of two ways. Term at a time, its shortest
lists are added up into accumulators, as long as they hold no more postings than the
segment has documents. Documents at a time, the accumulators are then one more iterator
beside the long lists, with the largest sum of each block of documents as its bound:
blocks whose bounds together stay below the k-th best score known so far are skipped,
the documents of others are dropped as soon as what is still to come cannot lift them.
A task carries its k best of each item from one segment to the next; only those leave it.

Terms are maximal runs of ASCII letters and digits and of all other characters beyond
ASCII; only A-Z are lower-cased. Scores are 64-bit integers but for the weight of a term,
which is cut to an integer from a double.

Defined cases: a NULL or empty text, or one without a term, is no document of the counts
and is never found; an item without a term, or whose terms no document holds, has no
rows. Equal scores rank by ascending doc_id, a NULL id last; every row of `docs` is a
document of its own, so repeated rows are found repeatedly. Items with one id are one
item, with the smallest of their texts; a NULL item_id is an item like others. Texts of
any length are read whole. Other columns, of any name, are not read.
"""

import math
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from fleetwright.llm.common import byte_texts, in_slices, materialise

# Items whose terms and results a task holds at once; more are further blocks.
BLOCK_ITEMS = 2_000
# Documents and postings of a segment, documents of a block, blocks looked into at a time.
SEGMENT_DOCUMENTS, SEGMENT_POSTINGS = 8_192, 2_000_000
SKIP_BLOCK, WINDOW_BLOCKS = 64, 32
# Parts in which the best of an item meet before they meet as a whole.
MERGE_PARTS = 64

_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256)
)
_SEGMENT = (
    "ids array<bigint>, lengths array<bigint>, documents bigint, total bigint, "
    "terms array<int>, sizes array<int>, positions binary, occurrences binary"
)


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text, in order."""
    return text.translate(_LETTERS).split()


@dataclass
class Items:
    """A block of queries: ids and, for each, its terms' numbers with their repeats."""

    ids: list
    wanted: list[dict[int, int]]
    numbers: dict[bytes, int]

    @classmethod
    def of(cls, rows: list) -> "Items":
        numbers: dict[bytes, int] = {}
        wanted = [
            {numbers.setdefault(term, len(numbers)): n for term, n in Counter(terms_of((row[1] or "").encode())).items()}
            for row in rows
        ]
        return cls([row[0] for row in rows], wanted, numbers)


@dataclass
class Corpus:
    """Counts over all documents: with a term, terms in all, documents by term number."""

    documents: int
    total: int
    holding: dict[int, int]

    def weight(self, term: int) -> int:
        return math.floor(1000 * math.log((2 * self.documents + 2) / (2 * self.holding.get(term, 0) + 1)))

    def norm(self, length: int) -> int:
        return 75 + 25 * length * self.documents // self.total


class _Builder:
    """Gathers the postings of one segment."""

    def __init__(self):
        self.ids, self.lengths, self.of_term, self.held = [], [], {}, 0  # by term: positions, occurrences

    def add(self, doc_id: int | None, text: bytes, numbers: dict[bytes, int]) -> None:
        terms = terms_of(text)
        if not terms:
            return
        position = len(self.ids)
        self.ids.append(doc_id)
        self.lengths.append(len(terms))
        found = Counter(number for number in map(numbers.get, terms) if number is not None)
        for term, count in found.items():
            if term not in self.of_term:
                self.of_term[term] = array("H"), array("q")
            positions, occurrences = self.of_term[term]
            positions.append(position)
            occurrences.append(count)
        self.held += len(found)

    @property
    def full(self) -> bool:
        return len(self.ids) >= SEGMENT_DOCUMENTS or self.held >= SEGMENT_POSTINGS

    def row(self) -> dict:
        terms = sorted(self.of_term)
        return {
            "ids": self.ids, "lengths": self.lengths, "documents": len(self.ids), "total": sum(self.lengths),
            "terms": terms, "sizes": [len(self.of_term[term][0]) for term in terms],
            "positions": b"".join(self.of_term[term][0].tobytes() for term in terms),
            "occurrences": b"".join(self.of_term[term][1].tobytes() for term in terms),
        }


def _segments(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """One row per segment of consecutive documents."""
    shared = docs.sparkSession.sparkContext.broadcast(numbers)
    types = pa.schema([
        ("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("documents", pa.int64()),
        ("total", pa.int64()), ("terms", pa.list_(pa.int32())), ("sizes", pa.list_(pa.int32())),
        ("positions", pa.binary()), ("occurrences", pa.binary()),
    ])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        builder = _Builder()
        for batch in in_slices(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), byte_texts(batch.column("text"))):
                builder.add(doc_id, text, shared.value)
                if builder.full:
                    yield pa.RecordBatch.from_pylist([builder.row()], types)
                    builder = _Builder()
        if builder.ids:
            yield pa.RecordBatch.from_pylist([builder.row()], types)

    return docs.select("doc_id", "text").mapInArrow(build, _SEGMENT)


class _List:
    """A term's postings in a segment: positions, what each adds per unit of weight, block maxima."""

    def __init__(self, positions: np.ndarray, impacts: np.ndarray):
        self.positions, self.impacts = positions, impacts

    @cached_property
    def maxima(self) -> np.ndarray:
        return _block_maxima(self.positions, self.impacts)


def _block_maxima(positions: np.ndarray, values: np.ndarray) -> np.ndarray:
    maxima = np.zeros(-(-SEGMENT_DOCUMENTS // SKIP_BLOCK), np.int64)
    if len(positions):
        blocks = positions // SKIP_BLOCK
        starts = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]])
        maxima[blocks[starts]] = np.maximum.reduceat(values, starts)
    return maxima


class Segment:
    """A segment's index with the corpus norms applied."""

    def __init__(self, row: dict, corpus: Corpus):
        self.ids, self.size = row["ids"], len(row["ids"])
        norms = np.array([corpus.norm(n) for n in row["lengths"]], np.int64)
        positions = np.frombuffer(row["positions"], np.uint16).astype(np.int64)
        occurrences = np.frombuffer(row["occurrences"], np.int64)
        impacts = 1_000_000_000 * occurrences // (1_000 * occurrences + 12 * norms[positions])
        ends = np.cumsum(row["sizes"])
        self.lists = {
            term: _List(positions[end - size:end], impacts[end - size:end])
            for term, size, end in zip(row["terms"], row["sizes"], ends.tolist())
        }

    def best(self, factors: dict[int, int], k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores of the documents that may be among the best k, each scoring at
        least `floor`: all of the k best of the segment that reach it are among them."""
        lists = sorted(((self.lists[t], f) for t, f in factors.items() if t in self.lists and f),
                       key=lambda each: len(each[0].positions))
        short = int(np.searchsorted(np.cumsum([len(each.positions) for each, _ in lists]), self.size, "right"))
        sums = self._summed(lists[:short])
        held = np.flatnonzero(sums)
        if len(held) >= k:
            floor = max(floor, int(np.partition(sums[held], -k)[-k]))
        return self._walk(sums, held, lists[short:], k, floor)

    def _summed(self, lists: list[tuple[_List, int]]) -> np.ndarray:
        """Term at a time: the accumulators of the short lists."""
        sums = np.zeros(self.size, np.int64)
        for each, factor in lists:
            sums[each.positions] += factor * each.impacts
        return sums

    def _walk(self, sums: np.ndarray, held: np.ndarray, long: list[tuple[_List, int]], k: int, floor: int):
        """Documents at a time over the accumulators and the long lists, skipping by bounds."""
        # The lists that can add most are asked first, so that hopeless documents go early.
        long = sorted(long, key=lambda each: -each[1] * int(each[0].impacts.max()))
        tops = [factor * each.maxima for each, factor in long]
        bounds = _block_maxima(held, sums[held])
        for top in tops:
            bounds = bounds + top
        found, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for first in range(0, len(bounds), WINDOW_BLOCKS):
            window = bounds[first:first + WINDOW_BLOCKS]
            blocks = first + np.flatnonzero((window >= floor) & (window > 0))
            if not len(blocks):
                continue
            at = (blocks[:, None] * SKIP_BLOCK + np.arange(SKIP_BLOCK)).ravel()
            at = at[at < self.size]
            score = sums[at]
            rest = sum((top[at // SKIP_BLOCK] for top in tops), np.zeros(len(at), np.int64))
            for (each, factor), top in zip(long, tops):
                open_ = score + rest >= floor
                at, score, rest = at[open_], score[open_], rest[open_]
                place = np.minimum(np.searchsorted(each.positions, at), len(each.positions) - 1)
                score = score + np.where(each.positions[place] == at, factor * each.impacts[place], 0)
                rest = rest - top[at // SKIP_BLOCK]
            good = (score >= floor) & (score > 0)
            found.append(at[good])
            scores.append(score[good])
            reached = np.concatenate(scores)
            if len(reached) >= k:
                floor = max(floor, int(np.partition(reached, -k)[-k]))
        return np.concatenate(found), np.concatenate(scores)


class _Best:
    """The best k of one item so far, highest score first, then smallest id."""

    def __init__(self, k: int):
        self.k, self.entries = k, []

    @property
    def floor(self) -> int:
        return self.entries[-1][0] if len(self.entries) == self.k else 1

    def take(self, ids: list, positions: np.ndarray, scores: np.ndarray) -> None:
        new = [(score, ids[p]) for p, score in zip(positions.tolist(), scores.tolist())]
        self.entries = sorted(self.entries + new, key=lambda e: (-e[0], e[1] is None, e[1] or 0))[:self.k]


def _search_block(docs: DataFrame, items: Items, k: int) -> DataFrame:
    """The best of each task for each item of a block."""
    segments = materialise(_segments(docs, items.numbers), "lexical_segments")
    # One row, and one row per term of the block.
    documents, total = segments.agg(F.sum("documents"), F.sum("total")).first()
    counted = segments.select(F.explode(F.arrays_zip("terms", "sizes")).alias("t")).groupBy("t.terms").agg(
        F.sum("t.sizes").alias("n")).collect()
    corpus = Corpus(documents or 0, total or 0, {row["terms"]: row["n"] for row in counted})
    factors = [{t: n * corpus.weight(t) for t, n in wanted.items() if t in corpus.holding} for wanted in items.wanted]
    shared = docs.sparkSession.sparkContext.broadcast((items.ids, factors, corpus))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, wanted, corpus = shared.value
        best = [_Best(k) for _ in ids]
        for batch in in_slices(batches, 1):
            segment = Segment(batch.to_pylist()[0], corpus)
            for each, factors in zip(best, wanted):
                if factors:
                    each.take(segment.ids, *segment.best(factors, k, each.floor))
        rows = [(item, doc, score) for item, each in zip(ids, best) for score, doc in each.entries]
        columns = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item_id", "doc_id", "score"])

    return segments.drop("documents", "total").mapInArrow(search, "item_id bigint, doc_id bigint, score bigint")


def search(docs: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """The `k` highest-scoring documents of each item: item_id, rank (from 1), doc_id, score.

    `docs` has doc_id and text, `queries` item_id and text. One pass over the documents
    for each block of at most about `BLOCK_ITEMS` items.
    """
    asked = queries.groupBy("item_id").agg(F.min("text").alias("text"))
    blocks = -(-asked.count() // BLOCK_ITEMS)
    found = []
    for block in range(blocks):
        part = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        found.append(_search_block(docs, Items.of(part.collect()), k))
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    best = found[0]
    for more in found[1:]:
        best = best.unionByName(more)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    # The best of every task meet in parts first, so that no task sorts those of all tasks.
    best = best.withColumn("part", F.pmod(F.xxhash64("doc_id", "score"), F.lit(MERGE_PARTS)))
    for keys in (["item_id", "part"], ["item_id"]):
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(
            F.col("rank") <= k)
    return best.select("item_id", "rank", "doc_id", "score")
