"""SimHash near-duplicates by the generalised pigeonhole principle.

A fingerprint is the bitwise majority of the XXH64 hashes of a text's word
shingles. Fingerprints within `distance` bits are linked; groups are the
connected components.

The search over distinct fingerprints: bits are dealt to parts so that bits that
move together share one, measured on a bounded sample. If the thresholds t_i of
m parts add up to `distance - m + 1`, two fingerprints within `distance` agree up
to t_i bits in some part. Each fingerprint chooses its own thresholds by dynamic
programming over the number of candidates that histograms of the part values
predict: -1 leaves a part out, so values that many share are not asked for. It
then visits the buckets of all part values within its thresholds, and the rows
that meet in a bucket are verified. A bucket returns a spanning forest of its
links, not all pairs; which links of a component are given differs, its members
do not.

Defined cases: a NULL or empty text has fingerprint 0 and is linked like any
other; equal rows share a fingerprint and one group. A NULL id is carried, and a
group's id is the smallest that is not NULL. Other columns are not read. An empty
table gives an empty result.
"""

from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from fleetwright.llm.common import byte_texts, give_back, in_slices, materialise, sorted_runs
from fleetwright.llm.components import component_roots

SHINGLE_WORDS, MAX_DISTANCE = 3, 3
SEED, BITS = 42, 64

# Bounds: fingerprints looked at to group the bits; leading bits of a part value
# that its histogram tells apart; rows of a bucket compared by one task at once.
SAMPLE_FINGERPRINTS = 20_000
HISTOGRAM_BITS = 16
BUCKET_ROWS = 16_384

# What asking for one bucket costs, in verified candidates.
_ASK_COST = 4.0
_HASHES_AT_ONCE = 65_536

_RESIDENT, _ASKS = 1, 2


# ---- fingerprints -----------------------------------------------------------

def fingerprint(text: bytes, shingle: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of UTF-8 text with A-Z lower-cased; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        shingles, total = iter([b" ".join(words)]), 1
    else:
        shingles, total = map(b" ".join, zip(*[words[k:] for k in range(shingle)])), len(words) - shingle + 1
    ones = np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    while block := [digest(s, SEED) for s in islice(shingles, _HASHES_AT_ONCE)]:
        rows = np.array(block, dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE_WORDS, carry=("doc_id",)) -> DataFrame:
    """The carried columns and `fp`, the fingerprint as a signed bigint."""
    def hashed(batches):
        for batch in in_slices(batches):
            marks = np.array([fingerprint(t, shingle) for t in byte_texts(batch.column("_text"))], dtype=np.uint64)
            columns = [batch.column(c) for c in carry]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(marks.view(np.int64))], [*carry, "fp"])
        give_back()

    rows = docs.select(*carry, F.col(text).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("_text").schema.fields)
    return rows.mapInArrow(hashed, f"{schema}, fp bigint")


# ---- plan of the parts ------------------------------------------------------

class Parts:
    """Which bits make up each part, and what its buckets are expected to hold."""

    def __init__(self, bits: list[list[int]], distance: int):
        self.bits, self.distance = bits, distance
        self.near: list[list[np.ndarray]] = []

    def values(self, marks: np.ndarray, part: int) -> np.ndarray:
        """The part's value of each fingerprint."""
        value = np.zeros(len(marks), dtype=np.uint64)
        for position, bit in enumerate(self.bits[part]):
            value |= ((marks >> np.uint64(bit)) & np.uint64(1)) << np.uint64(position)
        return value

    def set_histograms(self, counts: list[np.ndarray]) -> None:
        """From rows per leading value: rows expected within 0, 1, ... bits of a value."""
        self.near = []
        for bits, count in zip(self.bits, counts):
            known = min(len(bits), HISTOGRAM_BITS)
            scale = 2.0 ** (known - len(bits))
            cells = np.arange(1 << known)
            within = [np.asarray(count, dtype=np.float64) * scale]
            spread = [np.asarray(count, dtype=np.float64)]
            # Rows at exactly d bits: each of them is reached from d flips of the d - 1 before.
            for d in range(1, self.distance + 1):
                ring = sum(spread[d - 1][cells ^ (1 << k)] for k in range(known))
                if d > 1:
                    ring = ring - (known - d + 2) * spread[d - 2]
                spread.append(ring / d)
                hidden = len(bits) - known
                within.append(within[-1] + scale * sum(
                    spread[d - j] * _choose(hidden, j) for j in range(min(d, hidden) + 1)))
            self.near.append([w.astype(np.float32) for w in within])

    def thresholds(self, marks: np.ndarray) -> np.ndarray:
        """Thresholds per fingerprint and part, -1 where a part is not asked.

        best[s] is the least cost of the parts so far with s = sum(t_i + 1).
        """
        parts, target = len(self.bits), self.distance + 1
        best = np.full((target + 1, len(marks)), np.inf)
        best[0] = 0.0
        taken = []
        for part in range(parts):
            lead = (self.values(marks, part) & np.uint64((1 << HISTOGRAM_BITS) - 1)).astype(np.int64)
            costs = [np.zeros(len(marks))] + [
                self.near[part][t][lead] + _ASK_COST * len(self.flips(part, t)) for t in range(target)]
            after = np.full_like(best, np.inf)
            choice = np.zeros(best.shape, dtype=np.int8)
            for total in range(target + 1):
                for given in range(total + 1):
                    cost = best[total - given] + costs[given]
                    better = cost < after[total]
                    after[total][better] = cost[better]
                    choice[total][better] = given
            best = after
            taken.append(choice)
        chosen = np.empty((len(marks), parts), dtype=np.int8)
        left, rows = np.full(len(marks), target), np.arange(len(marks))
        for part in reversed(range(parts)):
            given = taken[part][left, rows]
            chosen[:, part] = given - 1
            left = left - given
        return chosen

    def flips(self, part: int, threshold: int) -> list[int]:
        """What a part value is combined with to reach all values within the threshold."""
        masks, latest = [0], [(0, 0)]
        for _ in range(threshold):
            latest = [(m | 1 << k, k + 1) for m, first in latest for k in range(first, len(self.bits[part]))]
            masks += [m for m, _ in latest]
        return masks


def _choose(n: int, k: int) -> int:
    result = 1
    for i in range(k):
        result = result * (n - i) // (i + 1)
    return result


def part_count(rows: int, distance: int) -> int:
    """The number of parts that is cheapest for `rows` evenly spread fingerprints."""
    def cost(parts):
        width = BITS / parts
        spare = distance + 1 - parts
        # Even thresholds: the first `spare` parts take one more step each, and so on.
        total = 0.0
        for part in range(parts):
            t = spare // parts + (1 if part < spare % parts else 0)
            asked = sum(_choose(int(width), d) for d in range(t + 1))
            total += asked * (_ASK_COST + rows / 2.0 ** width)
        return total

    return min(range(2, distance + 2), key=cost) if distance > 0 else 1


def group_bits(sample: np.ndarray, parts: int) -> list[list[int]]:
    """Deal the bits to equal parts, the most correlated pairs first into one part."""
    size = -(-BITS // parts)
    rows = np.unpackbits(sample.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(float)
    rows -= rows.mean(axis=0) if len(rows) else 0
    scale = np.sqrt((rows ** 2).sum(axis=0))
    scale[scale == 0] = 1.0
    together = np.abs(rows.T @ rows / np.outer(scale, scale)) if len(rows) else np.zeros((BITS, BITS))
    a, b = np.triu_indices(BITS, 1)
    group = {bit: [bit] for bit in range(BITS)}
    for k in np.argsort(-together[a, b], kind="stable"):
        left, right = group[a[k]], group[b[k]]
        if left is not right and len(left) + len(right) <= size:
            left += right
            for bit in right:
                group[bit] = left
    pieces = sorted({id(g): g for g in group.values()}.values(), key=lambda g: (-len(g), g[0]))
    dealt: list[list[int]] = [[] for _ in range(parts)]
    for bit in (bit for piece in pieces for bit in piece):
        min((p for p in dealt if len(p) < size), key=lambda p: (-len(p), dealt.index(p))).append(bit)
    return [sorted(p) for p in dealt if p]


def _plan(distinct: DataFrame, distance: int) -> Parts:
    rows = distinct.count()
    share = min(1.0, SAMPLE_FINGERPRINTS / max(rows, 1))
    picked = distinct.filter(F.pmod(F.xxhash64("fp"), F.lit(1_000_000)) < int(share * 1_000_000)).select("fp")
    sample = np.array([r[0] for r in picked.collect()], dtype=np.int64).view(np.uint64)
    parts = Parts(group_bits(sample, part_count(rows, distance)), distance)

    def cells(batches):
        for batch in batches:
            marks = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for part, bits in enumerate(parts.bits):
                known = min(len(bits), HISTOGRAM_BITS)
                values = parts.values(marks, part) & np.uint64((1 << known) - 1)
                cell, rows = np.unique(values.astype(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell + (part << HISTOGRAM_BITS)), pa.array(rows.astype(np.int64))], ["cell", "n"])

    # At most 2^HISTOGRAM_BITS rows for each part, whatever the table's size.
    counted = distinct.select("fp").mapInArrow(cells, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    counts = [np.zeros(1 << min(len(b), HISTOGRAM_BITS)) for b in parts.bits]
    for cell, n in counted.collect():
        counts[cell >> HISTOGRAM_BITS][cell & ((1 << HISTOGRAM_BITS) - 1)] = n
    parts.set_histograms(counts)
    return parts


# ---- probe and verify -------------------------------------------------------

def _memberships(distinct: DataFrame, parts: Parts) -> DataFrame:
    """A row for every bucket a fingerprint lives in or asks: (bucket, fp, role)."""
    def member(batches):
        for batch in batches:
            marks = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            chosen = parts.thresholds(marks)
            for part in range(len(parts.bits)):
                values = parts.values(marks, part)
                high = np.uint64(part) << np.uint64(BITS - 4)
                yield _rows(values | high, marks, np.where(chosen[:, part] >= 0, _RESIDENT | _ASKS, _RESIDENT))
                for threshold in range(1, parts.distance + 1):
                    asking = chosen[:, part] == threshold
                    if asking.any():
                        for flip in parts.flips(part, threshold)[1:]:
                            visited = values[asking] ^ np.uint64(flip) | high
                            yield _rows(visited, marks[asking], np.full(len(visited), _ASKS))

    return distinct.select("fp").mapInArrow(member, "bucket bigint, fp bigint, role tinyint")


def _rows(buckets, marks, roles):
    return pa.RecordBatch.from_arrays(
        [pa.array(buckets.view(np.int64)), pa.array(marks.view(np.int64)), pa.array(roles.astype(np.int8))],
        ["bucket", "fp", "role"])


def _split_large(members: DataFrame) -> DataFrame:
    """Give each task bounded groups: a larger bucket is cut into blocks, and every
    pair of blocks is a group of its own."""
    sizes = members.groupBy("bucket").agg(F.count("*").alias("rows")).filter(F.col("rows") > BUCKET_ROWS)
    blocks = F.coalesce(F.ceil(2 * F.col("rows") / BUCKET_ROWS), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit(3)), F.col("blocks")).cast("int")
    return (
        members.join(sizes, "bucket", "left").withColumn("blocks", blocks).withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("group"),
                "bucket", "fp", "role")
    )


def _forest(marks: np.ndarray, buckets: np.ndarray, roles: np.ndarray, starts: np.ndarray, distance: int):
    """Links within the runs that connect all that is linked there, without cycles."""
    root = np.arange(len(marks))

    def find(nodes):
        found = root[nodes]
        while True:
            above = root[found]
            if (above == found).all():
                return found
            found = above

    resident, asks = roles & _RESIDENT > 0, roles & _ASKS > 0
    end = np.r_[starts[1:], len(marks)].repeat(np.diff(np.r_[starts, len(marks)]))
    left, step, links = np.arange(len(marks)), 1, []
    while True:
        # Each row with the one `step` further on in its run.
        left = left[left + step < end[left]]
        if not len(left):
            return links
        right = left + step
        close = np.bitwise_count(marks[left] ^ marks[right]) <= distance
        close &= (resident[left] & asks[right]) | (asks[left] & resident[right])
        close &= (buckets[left] == buckets[right]) & (marks[left] != marks[right])
        a, b = left[close], right[close]
        if len(a):
            apart = find(a) != find(b)
            for x, y in zip(a[apart], b[apart]):
                rx, ry = x, y
                while root[rx] != rx:
                    root[rx] = rx = root[root[rx]]
                while root[ry] != ry:
                    root[ry] = ry = root[root[ry]]
                if rx != ry:
                    root[max(rx, ry)] = min(rx, ry)
                    links.append((x, y))
        step += 1


def links(distinct: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """(a, b): links between distinct fingerprints that connect every group."""
    if distance == 0:
        return distinct.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    parts = _plan(distinct, distance)

    def verified(batches):
        for table, starts in sorted_runs(batches, "group"):
            marks = table.column("fp").to_numpy().view(np.uint64)
            found = _forest(marks, table.column("bucket").to_numpy(), table.column("role").to_numpy(), starts, distance)
            if found:
                pairs = marks.view(np.int64)[np.array(found)]
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    grouped = _split_large(_memberships(distinct, parts))
    return grouped.repartition("group").sortWithinPartitions("group").mapInArrow(verified, "a bigint, b bigint")


def groups(marked: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """`marked` (doc_id, fp, ...) with `root`, which names its group, and
    `component_id`, the smallest doc_id in it.

    Copies meet first: from there on there is one row per distinct fingerprint.
    """
    distinct = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprints")
    roots = component_roots(links(distinct, distance))
    placed = (
        distinct.join(roots, distinct["fp"] == roots["node"], "left")
        .select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    )
    least = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return marked.join(placed.join(least, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id",
                    shingle: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE) -> DataFrame:
    """(doc_id, fp, component_id) of every document."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    marked = materialise(fingerprints(rows, "text", shingle), "marked")
    return groups(marked, distance).select(F.col("doc_id").alias(key), "fp", "component_id")


def one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id",
                shingle: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE) -> DataFrame:
    """The documents with one left of each group, whole: that with the smallest key.

    Rows are told apart by where they were written, so of equal rows, and of rows
    without a key, one stays as well.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(key).alias("doc_id"),
        F.col(text).alias("text"), F.monotonically_increasing_id().alias("place"))
    marked = materialise(fingerprints(rows, "text", shingle, ["row", "doc_id", "place"]), "marked_documents")
    grouped = groups(marked.select("doc_id", "place", "fp"), distance)
    kept = grouped.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "place"))["place"].alias("place"))
    return marked.join(kept.select("place"), "place", "left_semi").select("row.*")
