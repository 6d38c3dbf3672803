"""SimHash groups against brute force."""

import numpy as np
import pytest
import xxhash

from fleetwright.llm import simhash
from fleetwright.llm.components import component_roots
from fleetwright.llm.queries import QUERIES


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = words.replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, marks, distance):
    """Smallest id reachable, by walking all pairs."""
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    marks = np.array(marks, dtype=np.uint64)
    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(marks[i + 1:] ^ marks[i]) <= distance):
            a, b = find(i), find(i + 1 + int(j))
            root[max(a, b)] = min(a, b)
    members = {}
    for i in range(len(ids)):
        members.setdefault(find(i), []).append(ids[i])
    return {i: min(ids[j] for j in range(len(ids)) if find(j) == r) for r in members for i in members[r]}


def test_query_against_all_pairs(spark, testdata):
    folder = str(testdata / "sf0.01")
    rows = {r.doc_id: r for r in QUERIES["op10_simhash"](spark, folder).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    ids = sorted(texts)
    marks = [plain_fingerprint(texts[i]) for i in ids]
    assert [rows[i].fingerprint for i in ids] == [f"{m:016x}" for m in marks]
    assert {i: rows[i].component_id for i in ids} == brute_components(ids, marks, 3)


@pytest.mark.parametrize("distance,rows", [(3, 600), (2, 600), (1, 300), (0, 300)])
def test_planted_neighbours(spark, distance, rows):
    """Chains of neighbours at and beyond the distance, and a bucket value shared by all."""
    rng = np.random.default_rng(distance)
    centres = rng.integers(0, 1 << 63, rows // 6, dtype=np.uint64)
    centres[: len(centres) // 2] = centres[: len(centres) // 2] & np.uint64(~0xFFFF & (2 ** 64 - 1)) | np.uint64(0x1234)
    marks = []
    for c in centres:
        for flips in (0, 1, 2, 3, 4, 5):
            bits = rng.choice(64, flips, replace=False)
            marks.append(int(c) ^ sum(1 << int(b) for b in bits))
    ids = list(range(len(marks)))
    frame = spark.createDataFrame([(i, m - (1 << 64) if m >> 63 else m) for i, m in zip(ids, marks)], "doc_id long, fp long")
    found = {r.doc_id: r.component_id for r in simhash.groups(frame, distance).collect()}
    assert found == brute_components(ids, marks, distance)


def test_large_buckets_are_split(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET_ROWS", 8)
    rng = np.random.default_rng(5)
    marks = list({int(m) & 0xFFFFFFFFFFFF for m in rng.integers(0, 1 << 62, 40, dtype=np.uint64)})
    marks += [m ^ 1 << int(rng.integers(0, 48)) for m in marks for _ in range(3)]
    marks = list(dict.fromkeys(marks))
    ids = list(range(len(marks)))
    frame = spark.createDataFrame(list(zip(ids, marks)), "doc_id long, fp long")
    found = {r.doc_id: r.component_id for r in simhash.groups(frame).collect()}
    assert found == brute_components(ids, marks, 3)


def test_thresholds_add_up():
    rng = np.random.default_rng(1)
    marks = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    for count in (2, 3, 4):
        parts = simhash.Parts(simhash.group_bits(marks, count), 3)
        assert sorted(b for p in parts.bits for b in p) == list(range(64))
        parts.set_histograms([np.ones(1 << min(len(b), 16)) for b in parts.bits])
        chosen = parts.thresholds(marks)
        assert (chosen.sum(axis=1) == 3 - count + 1).all() and (chosen >= -1).all()


def test_crowded_values_are_left_out():
    parts = simhash.Parts(simhash.group_bits(np.zeros(0, np.uint64), 4), 3)
    crowd = [np.ones(1 << 16) for _ in range(4)]
    crowd[0][0] = 1e6
    parts.set_histograms(crowd)
    assert parts.thresholds(np.zeros(1, np.uint64))[0, 0] == -1


def test_histogram_counts_neighbours():
    parts = simhash.Parts([list(range(16))], 3)
    rng = np.random.default_rng(2)
    count = rng.integers(0, 3, 1 << 16)
    parts.set_histograms([count])
    cells = np.arange(1 << 16, dtype=np.uint64)
    for value in (0, 77, 65535):
        apart = np.bitwise_count(cells ^ np.uint64(value))
        for t in range(4):
            assert parts.near[0][t][value] == pytest.approx(count[apart <= t].sum(), rel=1e-5)


def test_parts_follow_the_table_size():
    assert simhash.part_count(10 ** 5, 3) == 4
    assert simhash.part_count(10 ** 12, 3) == 2


def test_odd_rows(spark):
    """NULL and empty texts share fingerprint 0, copies one group, a NULL id no name."""
    rows = [(1, None, "x"), (2, "", "x"), (3, " \t\n", "x"), (None, "some words here to read", "y"),
            (7, "some words here to read", "y"), (7, "some words here to read", "y"), (9, "other " * 50_000, "z"),
            (None, "nothing like the others at all", "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    found = {(r.doc_id, r.fp): r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert {found[i, 0] for i in (1, 2, 3)} == {1}
    assert {c for (i, _), c in found.items() if i == 7} == {7}
    kept = simhash.one_of_each(docs).collect()
    assert sorted((r.doc_id or -1, r.fp) for r in kept) == [(-1, "n"), (1, "x"), (7, "y"), (9, "z")]
    assert kept[0].__fields__ == ["doc_id", "text", "fp"]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).collect() == []
    assert simhash.one_of_each(docs).collect() == []


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    found = dict(component_roots(spark.createDataFrame(chain + star, "a long, b long")).collect())
    assert found == {**{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1300)}}
