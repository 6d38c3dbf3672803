"""Vector best-fit packing of token pieces into sequences.

A piece asks for three things of a sequence: tokens, one of its documents, and
attention cost (the square of its length). Every sequence has a capacity of each.
Pieces are placed from the longest to the shortest: among the open sequences with
room in every dimension the one is taken that leaves the smallest weighted norm
of what remains ("norm"), or that has the largest weighted dot product of demand
and room ("dot"); without one, a new sequence is opened.

Pieces are packed in groups of bounded size, drawn evenly over the table: a group
is one task's work, and only its last sequences are less full. Full pieces are a
sequence each and are not moved.

Defined cases: a NULL or empty text is its end id alone; equal rows are packed
each by itself; of equally good sequences the fullest one, or the first one found, is taken; a NULL id is carried. Other columns are not read, and an empty
table gives an empty result. A text of any length is cut, never shortened.
"""

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetwright.llm.common import give_back, in_slices, materialise
from fleetwright.llm.tokens import encoder, vocabulary_path

VOCABULARY, END_ID = "byte_bpe_50k.json", 2
SEQUENCE_TOKENS = 1024

# Pieces packed by one task together.
GROUP_PIECES = 50_000

# Where no cost capacity is asked for, the cost counts in the choice only, in this many parts.
_COST_PARTS = 256


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds, and the weight of each dimension in the choice.

    `documents` and `cost` default to what `tokens` allows anyway: they then shut no
    sequence. A cost that is stated is counted exactly, in squares of tokens.
    """

    tokens: int = SEQUENCE_TOKENS
    documents: int | None = None
    cost: int | None = None
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)
    rule: str = "norm"

    def limits(self) -> tuple[int, int, int]:
        return self.tokens, self.documents or self.tokens, self.cost or self.tokens ** 2


# ---- pieces -----------------------------------------------------------------

def cut(tokens: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all of `limit` tokens but the first."""
    first = tokens % limit or min(tokens, limit)
    return [(0, first)] + [(start, limit) for start in range(first, tokens, limit)]


def token_pieces(docs: DataFrame, limit: int = SEQUENCE_TOKENS, vocabulary: str = VOCABULARY,
                 end_id: int = END_ID, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, piece, start, length, ids_crc32) for every piece of every document."""
    path = vocabulary_path(vocabulary)
    end = end_id.to_bytes(4, "little")

    def pieces(batches):
        encode = encoder(path, blank_joins=True).encode
        for batch in in_slices(batches):
            rows, columns = [], ([], [], [], [])
            for row, ids in enumerate(encode([t or "" for t in batch.column("_text").to_pylist()])):
                view = memoryview(ids + end)
                for piece, (start, length) in enumerate(cut(len(view) // 4, limit)):
                    crc = zlib.crc32(view[4 * start:4 * (start + length)])
                    rows.append(row)
                    for column, value in zip(columns, (piece, start, length, crc)):
                        column.append(value)
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key").take(pa.array(rows, pa.int64())),
                 *(pa.array(column, kind) for column, kind in zip(columns, kinds))],
                ["_key", "piece", "start", "length", "ids_crc32"])
        give_back()

    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    kind = rows.schema["_key"].dataType.simpleString()
    schema = f"_key {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return rows.mapInArrow(pieces, schema).withColumnRenamed("_key", key)


# ---- best fit ---------------------------------------------------------------

class _Open:
    """Open sequences by room: tokens left, then (documents left, cost parts left)."""

    def __init__(self, capacity: Capacity):
        self.limits = capacity.limits()
        self.weights, self.rule = capacity.weights, capacity.rule
        self.costly = capacity.cost is not None
        self.scale = capacity.cost if self.costly else _COST_PARTS
        self.rooms: dict[int, dict[tuple[int, int], list[int]]] = {}
        self.filled = 0  # bit r is set if a sequence has r tokens left

    def add(self, sequence: int, room: tuple[int, int, int]) -> None:
        tokens, documents, cost = room
        if tokens and documents and (cost or not self.costly):
            self.rooms.setdefault(tokens, {}).setdefault((documents, cost), []).append(sequence)
            self.filled |= 1 << tokens

    def take(self, tokens: int, cost: int):
        """The chosen sequence and its room, removed from the open ones; None if none has room."""
        best, chosen = None, None
        for left in (self._upwards(tokens) if self.rule == "norm" else self._downwards(tokens)):
            if best is not None and self._bound(left, tokens) >= best:
                break
            for documents, parts in self.rooms[left]:
                if parts >= cost or not self.costly:
                    value = self._value(left, documents, parts, tokens, cost)
                    if best is None or value < best:
                        best, chosen = value, (left, documents, parts)
        if chosen is None:
            return None
        left, documents, parts = chosen
        states = self.rooms[left]
        sequence = states[documents, parts].pop()
        if not states[documents, parts]:
            del states[documents, parts]
            if not states:
                del self.rooms[left]
                self.filled &= ~(1 << left)
        return sequence, chosen

    def _upwards(self, tokens):
        rest = self.filled >> tokens << tokens
        while rest:
            lowest = rest & -rest
            yield lowest.bit_length() - 1
            rest ^= lowest

    def _downwards(self, tokens):
        rest = self.filled >> tokens << tokens
        while rest:
            highest = rest.bit_length() - 1
            yield highest
            rest ^= 1 << highest

    def _value(self, left, documents, parts, tokens, cost):
        """Smaller is better: the norm of what remains, or the dot product negated."""
        (wt, wd, wc), (lt, ld, _) = self.weights, self.limits
        if self.rule == "norm":
            return (wt * ((left - tokens) / lt) ** 2 + wd * ((documents - 1) / ld) ** 2
                    + wc * ((parts - cost) / self.scale) ** 2)
        return -(wt * left * tokens / lt ** 2 + wd * documents / ld ** 2 + wc * parts * cost / self.scale ** 2)

    def _bound(self, left, tokens):
        """No sequence with `left` tokens, or with more in the order of search, does better."""
        (wt, wd, wc), (lt, ld, _) = self.weights, self.limits
        if self.rule == "norm":
            return wt * ((left - tokens) / lt) ** 2
        return -(wt * left * tokens / lt ** 2 + wd / ld + wc)


def best_fit(lengths: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece; lengths are at most the capacity's tokens."""
    most_tokens, most_documents, most_cost = capacity.limits()
    lengths = np.asarray(lengths, dtype=np.int64)
    costs = lengths ** 2 if capacity.cost is not None else lengths ** 2 * _COST_PARTS // most_cost
    sequences, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    opened, open_ones = 0, _Open(capacity)
    for item in np.argsort(-lengths, kind="stable").tolist():
        tokens, cost = int(lengths[item]), int(costs[item])
        found = open_ones.take(tokens, cost)
        if found is None:
            sequence, (left, documents, parts) = opened, (most_tokens, most_documents, open_ones.scale)
            opened += 1
        else:
            sequence, (left, documents, parts) = found
        sequences[item], offsets[item] = sequence, most_tokens - left
        open_ones.add(sequence, (left - tokens, documents - 1, parts - cost))
    return sequences, offsets


def pack(pieces: DataFrame, capacity: Capacity = Capacity(), length: str = "length") -> DataFrame:
    """`pieces` with `sequence_id` and `offset`. They are written first, so that a
    piece's group, drawn from its place in the table, holds for good."""
    placed = materialise(pieces.withColumn("_place", F.monotonically_increasing_id()), "pieces")
    full = F.col(length) >= capacity.tokens
    short = placed.filter(~full)
    group_count = -(-short.count() // GROUP_PIECES) or 1

    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_place", ignore_index=True)
        sequences, offsets = best_fit(rows[length].to_numpy(), capacity)
        return rows.assign(sequence_id=rows["_group"] * (1 << 32) + sequences, offset=offsets)[columns]

    columns = [*pieces.columns, "sequence_id", "offset"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    # Consecutive places go to different groups, so that each has a mix of lengths.
    grouped = short.withColumn("_group", F.pmod(F.xxhash64("_place"), F.lit(group_count)))
    mixed = grouped.groupBy("_group").applyInPandas(packed, f"{fields}, sequence_id bigint, offset bigint")
    alone = placed.filter(full).withColumns({"sequence_id": -1 - F.col("_place"), "offset": F.lit(0).cast("bigint")})
    return mixed.union(alone.select(*columns))


def packed_documents(docs: DataFrame, capacity: Capacity = Capacity(), vocabulary: str = VOCABULARY,
                     end_id: int = END_ID, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Every document's pieces with their place in a sequence."""
    return pack(token_pieces(docs, capacity.tokens, vocabulary, end_id, text, key), capacity)
