"""Alignment of two tokenizers' tokens of the same text, merged in lockstep.

Both token sequences of a text cover the same bytes. Byte offsets where a token of A and
one of B end together are cuts; they part the tokens into groups, and all A-B pairs of
occurrences within a group are links.

A batch of documents is merged at once: a state vector with one column per lane holds
the lane's places in A and B and where its group began. Each step compares the ends of
the tokens at those places, advances the side that ends first (both at a cut), emits the
links of the tokens entered and the cuts, and drops the lanes that are through. A lane is
a document, or a stretch of a long one between two cuts.

How many documents hold a pair of ids linked is counted over the corpus: tasks count
their documents and emit sorted arrays, which are added up bucket by bucket of A ids, in
a tree as wide as there are tasks. A document's distinct pairs travel once, as sorted
arrays by bucket, to those counts, and its sums come back. A bucket's documents are
salted over as many groups as they need, each with the bucket's counts beside it; the
counts of a bucket are bounded by the vocabularies, not by the corpus.

Defined cases: a NULL or empty text, and one whose tokens' bytes differ from a blank and
the text (B turns U+2581 into a blank), has no tokens: all figures are 0 and the digest is
empty. Strings of special tokens are plain text. Of equal counts of an A id all are its
highest. Every row is a document of its own, also one that repeats an id or has a NULL
one; documents without rows give an empty result. Texts of any length are read whole, by
one task each. Other columns, of any name, are not read.
"""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from fleetwright.llm.common import in_slices, materialise
from fleetwright.llm.tokens import encoder, piece_encoder, vocabulary_path

A_VOCABULARY, B_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"

# Text and documents of a batch; A tokens of a lane, and those looked at for its end.
BATCH_BYTES, BATCH_DOCUMENTS = 1 << 20, 4_096
LANE_TOKENS, LANE_SEARCH = 1_024, 64
# Buckets of A ids; pairs a task counts before it hands them on.
BUCKETS, HELD_PAIRS = 32, 4_000_000
# Rows added up by one group; rows of links that meet one copy of a bucket's counts.
FAN_IN, LINK_ROWS = 64, 256

_ALIGNED = (
    "kind int, part bigint, place int, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
    "groups_sha256 string, bucket int, span bigint, sizes binary, pairs binary, times binary"
)
_ALIGNED_TYPES = pa.schema([
    ("kind", pa.int32()), ("part", pa.int64()), ("place", pa.int32()), ("doc_id", pa.int64()),
    *[(name, pa.int64()) for name in ("n_a", "n_b", "n_groups", "n_links")],
    ("groups_sha256", pa.string()), ("bucket", pa.int32()), ("span", pa.int64()),
    *[(name, pa.binary()) for name in ("sizes", "pairs", "times")],
])
_DOCUMENT, _LINKS, _COUNTS = 0, 1, 2


def _lane_starts(a_end: np.ndarray, b_end: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A tokens at which lanes begin: every document's first, and in long documents those
    behind a cut at about every `LANE_TOKENS` tokens."""
    probes = np.arange(LANE_TOKENS - 1, len(a_end) - 1, LANE_TOKENS)
    near = np.minimum(probes[:, None] + np.arange(LANE_SEARCH), len(a_end) - 1)
    ends = a_end[near]
    cut = b_end[np.minimum(np.searchsorted(b_end, ends), len(b_end) - 1)] == ends
    found = cut.any(axis=1)
    behind = near[found, cut[found].argmax(axis=1)] + 1
    return np.unique(np.concatenate([first, behind[behind < len(a_end)]]))


def lockstep(a_end: np.ndarray, b_end: np.ndarray, a_first: np.ndarray):
    """Cuts and links of the tokens of several documents, one behind the other.

    `a_end` and `b_end` are the offsets at which tokens end, counted through all documents,
    and `a_first` the documents' first tokens in A. Returns for each token of A and of B
    whether a group ends with it, and the links as two arrays of token numbers.
    """
    cut_a, cut_b = np.zeros(len(a_end), bool), np.zeros(len(b_end), bool)
    if not len(a_end):
        return cut_a, cut_b, np.zeros(0, np.int64), np.zeros(0, np.int64)
    start = _lane_starts(a_end, b_end, a_first)
    stop = np.r_[start[1:], len(a_end)]
    # A lane begins in B behind the token that ends where the lane begins.
    begins = np.where(start > 0, a_end[start - 1], 0)
    b_start = np.where(begins > 0, np.searchsorted(b_end, begins) + 1, 0)
    # Places in A and B, the group's first tokens, the lane's end, the links just entered (below
    # zero: of a token of B with those of A so far).
    state = np.stack([start, b_start, start, b_start, stop, np.ones_like(start)])
    entered = np.empty((3, len(a_end) + len(b_end)), np.int64)
    filled = 0
    while state.shape[1]:
        a, b, group_a, group_b, stop, links = state
        entered[:, filled:filled + len(a)] = a, b, links
        filled += len(a)
        ahead = a_end[a] - b_end[b]
        step_a, step_b = ahead <= 0, ahead >= 0
        both = step_a & step_b
        cut_a[a[both]] = True
        cut_b[b[both]] = True
        a += step_a
        b += step_b
        np.copyto(group_a, a, where=both)
        np.copyto(group_b, b, where=both)
        np.copyto(links, np.where(step_a, b - group_b + 1, group_a - a - 1))
        np.copyto(links, 1, where=both)
        through = a == stop
        if through.any():
            state = state[:, ~through]
    a, b, links = entered[:, :filled]
    times = np.abs(links)
    back = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
    of_a = np.repeat(links > 0, times)
    return cut_a, cut_b, np.repeat(a, times) - np.where(of_a, 0, back), np.repeat(b, times) - np.where(of_a, back, 0)


def _digit_table(size: int) -> np.ndarray:
    """Each number below `size` as decimal digits, zero bytes in front and one behind."""
    powers = 10 ** np.arange(len(str(size - 1)) - 1, -1, -1)
    numbers = np.arange(size)[:, None]
    table = np.zeros((size, len(powers) + 1), np.uint8)
    table[:, :-1] = np.where((numbers >= powers) | (powers == 1), numbers // powers % 10 + ord("0"), 0)
    return table


@dataclass
class Aligned:
    """The tokens of a batch with their groups and links. Documents are counted by place."""

    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    cut_a: np.ndarray
    cut_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray

    @cached_property
    def of_a(self) -> np.ndarray:
        """The document of each A token."""
        return np.repeat(np.arange(len(self.n_a)), self.n_a)

    def groups(self) -> np.ndarray:
        return np.bincount(self.of_a[self.cut_a], minlength=len(self.n_a))

    def links(self) -> np.ndarray:
        return np.bincount(self.of_a[self.link_a], minlength=len(self.n_a))

    def digests(self, digits_a: np.ndarray, digits_b: np.ndarray) -> list[str]:
        """SHA-256 of each document's groups, written a,a|b,b;a|b; empty without tokens."""
        # A group's A tokens come behind all B tokens of earlier groups, its B tokens behind its A tokens.
        group_a, group_b = np.cumsum(self.cut_a) - self.cut_a, np.cumsum(self.cut_b) - self.cut_b
        b_until = np.r_[0, np.flatnonzero(self.cut_b) + 1]
        a_until = np.flatnonzero(self.cut_a) + 1
        place_a = np.arange(len(self.a)) + b_until[group_a]
        place_b = np.arange(len(self.b)) + (a_until[group_b] if len(self.b) else 0)
        rows = np.empty((len(self.a) + len(self.b), max(digits_a.shape[1], digits_b.shape[1])), np.uint8)
        for place, ids, digits, cut, end in (
            (place_a, self.a, digits_a, self.cut_a, b"|"), (place_b, self.b, digits_b, self.cut_b, b";"),
        ):
            written = np.zeros((len(ids), rows.shape[1]), np.uint8)
            written[:, rows.shape[1] - digits.shape[1]:] = digits[ids]
            written[:, -1] = np.where(cut, end[0], b","[0])
            rows[place] = written
        kept = rows != 0
        text = rows[kept].tobytes()
        until = np.r_[0, np.cumsum(kept.sum(axis=1))][np.r_[0, np.cumsum(self.n_a + self.n_b)]].tolist()
        return [hashlib.sha256(text[lo:hi - 1]).hexdigest() if hi > lo else "" for lo, hi in zip(until, until[1:])]


class Aligner:
    """Both tokenizers with their tokens' bytes."""

    def __init__(self, a_path: str, b_path: str):
        self.encode_a = encoder(a_path, blank_joins=True, plain_specials=True)
        self.encode_b = piece_encoder(b_path)
        self.a_bytes, self.b_bytes = self.encode_a.token_bytes(), self.encode_b.token_bytes()
        self.a_lengths, self.b_lengths = (
            np.array([len(token) for token in table], np.int64) for table in (self.a_bytes, self.b_bytes))
        self.a_digits, self.b_digits = _digit_table(len(self.a_bytes)), _digit_table(len(self.b_bytes))

    def align(self, texts: list[str | None]) -> Aligned:
        """The tokens, groups and links of a batch of texts."""
        a_ids, b_ids = [], []
        given = [text or "" for text in texts]
        for text, a, b in zip(given, self.encode_a.encode(given, behind_blank=True), self.encode_b.encode(given)):
            a, b = np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4")
            if not text or not self._covers(text, a, b):
                a = b = a[:0]
            a_ids.append(a)
            b_ids.append(b)
        n_a, n_b = (np.array([len(ids) for ids in each], np.int64) for each in (a_ids, b_ids))
        a, b = (np.concatenate([np.zeros(0, "<u4"), *ids]).astype(np.int64) for ids in (a_ids, b_ids))
        first = (np.cumsum(n_a) - n_a)[n_a > 0]
        found = lockstep(np.cumsum(self.a_lengths[a]), np.cumsum(self.b_lengths[b]), first)
        return Aligned(a, b, n_a, n_b, *found)

    def _covers(self, text: str, a: np.ndarray, b: np.ndarray) -> bool:
        whole = b" " + text.encode()
        return (b"".join(map(self.a_bytes.__getitem__, a.tolist())) == whole
                and b"".join(map(self.b_bytes.__getitem__, b.tolist())) == whole)


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _aligner(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _ALIGNERS:
        _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
    return _ALIGNERS[a_path, b_path]


def _batches(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str | None]]]:
    """Ids and texts of consecutive documents, up to the bounds of a batch."""
    ids, texts, held = [], [], 0
    for batch in in_slices(rows):
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            ids.append(doc_id)
            texts.append(text)
            held += len(text or "")
            if held >= BATCH_BYTES or len(ids) >= BATCH_DOCUMENTS:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def _bucket(a: np.ndarray) -> np.ndarray:
    # Frequent ids lie together in a vocabulary.
    return a * 2_654_435_761 % (1 << 32) * BUCKETS >> 32


def _tally(values: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and how often each comes (or the sum of its `times`)."""
    if times is None:
        values = np.sort(values)
    else:
        order = np.argsort(values, kind="stable")
        values, times = values[order], times[order]
    starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]][:len(values)])
    if times is None:
        return values[starts], np.diff(np.r_[starts, len(values)])
    return values[starts], np.add.reduceat(times, starts) if len(starts) else times


def _packed(values: np.ndarray) -> bytes:
    """Integers as bytes, the planes of bytes one behind the other, as few as the largest needs."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8).T[:width]
    return bytes([width]) + np.ascontiguousarray(planes).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.zeros((8, (len(data) - 1) // width), np.uint8)
    planes[:width] = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel().astype(np.int64)


class _Counts:
    """How many of a task's documents hold each pair."""

    def __init__(self):
        self.pairs, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.new: list[np.ndarray] = []
        self.n_new = 0

    def add(self, pairs: np.ndarray) -> None:
        self.new.append(pairs)
        self.n_new += len(pairs)
        if self.n_new > max(HELD_PAIRS // 4, len(self.pairs)):
            self.settle()

    def settle(self) -> None:
        pairs, times = _tally(np.concatenate([np.zeros(0, np.int64), *self.new]))
        self.pairs, self.times = _tally(np.r_[self.pairs, pairs], np.r_[self.times, times])
        self.new, self.n_new = [], 0

    def rows(self, width: int) -> Iterator[dict]:
        self.settle()
        buckets = _bucket(self.pairs // width)
        for bucket in np.unique(buckets).tolist():
            mine = buckets == bucket
            yield {"bucket": bucket, "pairs": _deltas(self.pairs[mine]), "times": _packed(self.times[mine])}


def _deltas(ascending: np.ndarray) -> bytes:
    return _packed(np.diff(ascending, prepend=0))


def _link_rows(batch: Aligned, width: int) -> tuple[list[dict], np.ndarray]:
    """A row per bucket with each document's distinct pairs and their times; and all pairs held."""
    pairs = batch.a[batch.link_a] * width + batch.b[batch.link_b]
    span = int(pairs.max()) + 1 if len(pairs) else 1
    documents = len(batch.n_a)
    if BUCKETS * documents * span >= 1 << 63:
        raise ValueError("vocabularies too large for one key")
    owner = _bucket(batch.a)[batch.link_a] * documents + batch.of_a[batch.link_a]
    keys, times = _tally(owner * span + pairs)
    owner, pairs = keys // span, keys % span
    rows = []
    until = np.searchsorted(owner, np.arange(BUCKETS + 1) * documents)
    for bucket, (lo, hi) in enumerate(zip(until, until[1:])):
        if hi > lo:
            sizes = np.bincount(owner[lo:hi] - bucket * documents, minlength=documents)
            # Ascending through the documents: each adds its place times the span.
            rows.append({"bucket": bucket, "span": span, "sizes": _packed(sizes), "times": _packed(times[lo:hi]),
                         "pairs": _deltas(keys[lo:hi] - bucket * documents * span)})
    return rows, pairs


def _align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Documents, links by batch and bucket, and the tasks' counts, as rows of three kinds."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, counts = _aligner(a_path, b_path), _Counts()
        width = len(aligner.b_bytes)
        part = TaskContext.get().partitionId() << 32
        for ids, texts in _batches(batches):
            batch = aligner.align(texts)
            figures = zip(ids, batch.n_a.tolist(), batch.n_b.tolist(), batch.groups().tolist(), batch.links().tolist(),
                          batch.digests(aligner.a_digits, aligner.b_digits))
            names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
            rows = [{"kind": _DOCUMENT, "part": part, "place": place, **dict(zip(names, row))}
                    for place, row in enumerate(figures)]
            links, held = _link_rows(batch, width)
            yield pa.RecordBatch.from_pylist(rows + [{"kind": _LINKS, "part": part, **row} for row in links], _ALIGNED_TYPES)
            counts.add(held)
            if len(counts.pairs) > HELD_PAIRS:
                yield _count_batch(counts, part, width)
                counts = _Counts()
            part += 1
        yield _count_batch(counts, part, width)

    return docs.select("doc_id", "text").mapInArrow(align, _ALIGNED)


def _count_batch(counts: _Counts, part: int, width: int) -> pa.RecordBatch:
    rows = [{"kind": _COUNTS, "part": part, **row} for row in counts.rows(width)]
    return pa.RecordBatch.from_pylist(rows, _ALIGNED_TYPES)


def _summed(rows: pd.DataFrame) -> pd.DataFrame:
    """Counts of one bucket added up."""
    pairs, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for row in rows.itertuples():
        pairs, times = _tally(np.r_[pairs, np.cumsum(_unpacked(row.pairs))], np.r_[times, _unpacked(row.times)])
    first = rows.iloc[0]
    return pd.DataFrame({"bucket": [first.bucket], "part": [first.part], "pairs": [_deltas(pairs)], "times": [_packed(times)]})


def _corpus_counts(aligned: DataFrame) -> DataFrame:
    """One row per bucket: its pairs in order and how many documents hold each."""
    counts = aligned.filter(F.col("kind") == _COUNTS).select("bucket", "part", "pairs", "times")
    rows = counts.groupBy("bucket").count().agg(F.max("count")).first()[0] or 0
    while True:
        groups = max(1, -(-rows // FAN_IN))
        counts = counts.groupBy("bucket", F.pmod(F.xxhash64("part"), F.lit(groups)).alias("salt")).applyInPandas(
            _summed, "bucket int, part bigint, pairs binary, times binary")
        if groups == 1:
            return counts
        rows = groups


def _with_counts(width: int):
    """Per batch and bucket, the sums of each document over its links."""

    def sums(links: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(links):
            pairs, held = np.cumsum(_unpacked(counts.pairs.iloc[0])), _unpacked(counts.times.iloc[0])
            starts = np.flatnonzero(np.r_[True, np.diff(pairs // width) > 0])
            best = held == np.repeat(np.maximum.reduceat(held, starts), np.diff(np.r_[starts, len(pairs)]))
        for row in links.itertuples():
            sizes, times = _unpacked(row.sizes), _unpacked(row.times)
            at = np.searchsorted(pairs, np.cumsum(_unpacked(row.pairs)) % row.span)
            holders = np.flatnonzero(sizes)
            starts_of = (np.cumsum(sizes) - sizes)[holders]
            total, top = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            total[holders] = np.add.reduceat(times * held[at], starts_of)
            top[holders] = np.add.reduceat(times * best[at], starts_of)
            found.append({"part": row.part, "sums": _packed(total), "tops": _packed(top)})
        return pd.DataFrame(found, columns=["part", "sums", "tops"])

    return sums


def _finished(sums: pd.DataFrame, documents: pd.DataFrame) -> pd.DataFrame:
    """The documents of a batch with the sums of all buckets."""
    total, top = np.zeros(len(documents), np.int64), np.zeros(len(documents), np.int64)
    for row in sums.itertuples():
        total += _unpacked(row.sums)
        top += _unpacked(row.tops)
    places = documents["place"].to_numpy()
    return documents.drop(columns=["part", "place"]).assign(n_best=top[places], count_sum=total[places])


def align_documents(docs: DataFrame, a_vocabulary: str | None = None, b_vocabulary: str | None = None) -> DataFrame:
    """Per document of `docs` (doc_id, text): doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256. The vocabularies are paths of a byte-level and of a piece vocabulary."""
    a_path, b_path = a_vocabulary or vocabulary_path(A_VOCABULARY), b_vocabulary or vocabulary_path(B_VOCABULARY)
    width = len(piece_encoder(b_path).pieces)
    aligned = materialise(_align(docs, a_path, b_path), "aligned")
    counts = _corpus_counts(aligned)
    links = aligned.filter(F.col("kind") == _LINKS)
    most = links.groupBy("bucket").count().agg(F.max("count")).first()[0] or 0
    salts = max(1, -(-most // LINK_ROWS))
    links = links.select("bucket", F.pmod(F.xxhash64("part"), F.lit(salts)).alias("salt"), "part", "span", "sizes", "pairs", "times")
    copies = counts.select("bucket", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))).alias("salt"),
                           "pairs", "times")
    sums = links.groupBy("bucket", "salt").cogroup(copies.groupBy("bucket", "salt")).applyInPandas(
        _with_counts(width), "part bigint, sums binary, tops binary")
    # As text the ids keep all digits where some are NULL.
    documents = aligned.filter(F.col("kind") == _DOCUMENT).select(
        "part", "place", F.col("doc_id").cast("string"), "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    return sums.groupBy("part").cogroup(documents.groupBy("part")).applyInPandas(
        _finished, "doc_id string, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
                   "n_best bigint, count_sum bigint",
    ).select(F.col("doc_id").cast("bigint"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def alignments(docs: DataFrame, a_vocabulary: str | None = None, b_vocabulary: str | None = None) -> DataFrame:
    """Per document the ids of both tokenizers and, for each group, the number of A and of B tokens up to its end."""
    a_path, b_path = a_vocabulary or vocabulary_path(A_VOCABULARY), b_vocabulary or vocabulary_path(B_VOCABULARY)
    names = ["doc_id", "a_ids", "b_ids", "a_until", "b_until"]

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _batches(batches):
            batch = _aligner(a_path, b_path).align(texts)
            columns = [pa.array(ids, pa.int64())]
            for numbers, n, cut in ((batch.a, batch.n_a, None), (batch.b, batch.n_b, None),
                                    (batch.a, batch.n_a, batch.cut_a), (batch.b, batch.n_b, batch.cut_b)):
                until = np.cumsum(n)
                values = numbers
                if cut is not None:
                    values = (np.arange(len(numbers)) + 1 - np.repeat(until - n, n))[cut]
                    until = np.r_[0, np.cumsum(cut)][until]
                columns.append(pa.ListArray.from_arrays(pa.array(np.r_[0, until], pa.int32()), pa.array(values, pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select("doc_id", "text").mapInArrow(
        align, "doc_id bigint, a_ids array<int>, b_ids array<int>, a_until array<int>, b_until array<int>")
