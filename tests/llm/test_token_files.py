"""Token files: exact round trips, damage, order, the query against the tokenizer."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from fleetwright.llm import range_coder, token_files, tokens
from fleetwright.llm.queries import QUERIES
from fleetwright.llm.tokens import vocabulary_path


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 70_000), min_size=1, max_size=300), st.integers(1, 50))
def test_any_ids_come_back(ids, block):
    ids = np.array(ids, np.uint32)
    sizes = np.minimum(len(ids) - np.arange(0, len(ids), block), block)
    payloads = range_coder.encode(ids, sizes, 5)
    assert (range_coder.decode(payloads, sizes, 5) == ids).all()
    # Every block stands for itself.
    last = len(sizes) - 1
    assert (range_coder.decode(payloads[last:], sizes[last:], 5) == ids[sizes[:last].sum():]).all()


@pytest.mark.parametrize("values", [[7] * 3_000, [0xFFFF] * 500 + [0] * 500, [1, 2, 3, 4] * 600])
def test_repeating_ids_become_small(values):
    ids, sizes = np.array(values, np.uint32), np.array([len(values)])
    payloads = range_coder.encode(ids, sizes, 4)
    assert (range_coder.decode(payloads, sizes, 4) == ids).all()
    assert len(payloads[0]) < 0.1 * 2 * len(values)


def test_context_helps():
    """Ids that follow from the two before cost far less than the same ids shuffled."""
    rng = np.random.default_rng(0)
    table = rng.integers(0, 50_000, (16, 16))
    ids = [0, 1]
    while len(ids) < 4_000:
        ids.append(int(table[ids[-1] % 16, ids[-2] % 16]))
    ids = np.array(ids, np.uint32)
    mixed = rng.permutation(ids)
    size = np.array([len(ids)])
    assert len(range_coder.encode(ids, size, 4)[0]) < 0.5 * len(range_coder.encode(mixed, size, 4)[0])


def test_weights_stay_in_bounds():
    rng = np.random.default_rng(1)
    ids = np.where(rng.random(6_000) < 0.999, 0, 0xFFFF).astype(np.uint32)
    sizes = np.array([6_000])
    assert (range_coder.decode(range_coder.encode(ids, sizes, 4), sizes, 4) == ids).all()


def test_segments_and_damage():
    rng = np.random.default_rng(2)
    ids = rng.zipf(1.3, 5_000).clip(0, 49_000).astype(np.uint32)
    sizes = np.array([1, 0, 1_999, 3_000])
    data = token_files.write_segment([5, None, 6, 9], sizes, ids)
    segment = token_files.read_directory(data)
    assert segment.ids == [5, None, 6, 9] and segment.sizes.tolist() == sizes.tolist()
    assert (token_files.read_blocks(data, segment) == ids).all()
    block = segment.block_sizes[0]
    assert (token_files.read_blocks(data, segment, 3, 5) == ids[3 * block:5 * block]).all()
    for place in (*range(0, 60, 3), segment.payloads - 3, segment.payloads + 3, len(data) - 9):
        broken = bytearray(data)
        broken[place] ^= 64
        with pytest.raises(ValueError, match="damaged"):
            token_files.read_blocks(bytes(broken), token_files.read_directory(bytes(broken)))


def test_fewer_bits_than_order_0():
    """Ids with some order cost less than their shares alone would, in few decisions an id."""
    rng = np.random.default_rng(3)
    ids = rng.zipf(1.3, 60_000).clip(0, 40_000).astype(np.uint32)
    again = rng.integers(2, len(ids), 9_000)
    for place, back in zip(again, rng.integers(50, 900, len(again))):
        ids[place:place + 6] = ids[max(place - back, 0):max(place - back, 0) + 6][:len(ids) - place]
    counts = np.unique(ids, return_counts=True)[1] / len(ids)
    sizes = np.minimum(len(ids) - np.arange(0, len(ids), 1_024), 1_024)
    known = range_coder.shares(ids)
    payloads = range_coder.encode(ids, sizes, 4, known)
    assert (range_coder.decode(payloads, sizes, 4, known) == ids).all()
    assert 8 * sum(map(len, payloads)) < -len(ids) * (counts * np.log2(counts)).sum()
    # A block stands for itself.
    assert (range_coder.decode(payloads[7:9], sizes[7:9], 4, known) == ids[7 * 1_024:9 * 1_024]).all()


@pytest.mark.parametrize("ids", [[0xFFFFFFFF, 0, 1 << 22, 5], [7], [3, 3, 0, 3], [1 << 31]])
def test_shares_of_any_ids(ids, monkeypatch):
    ids = np.array(ids * 40, np.uint32)
    sizes = np.array([len(ids)])
    for most in (1 << 18, 0):
        monkeypatch.setattr(range_coder, "MOST_SHARES", most)
        known = range_coder.shares(ids)
        assert known[1].sum() == (1 << range_coder.SHARE_BITS if most else 0)
        assert (range_coder.decode(range_coder.encode(ids, sizes, 8, known), sizes, 8, known) == ids).all()


ODD_TEXTS = [
    "", None, "  a  b ", "A\tb\n\nC.\r\nx", "hello <|endoftext|> World <|startoftext|> a", "H\u0331 \u1e96 I\u0307 \u0130",
    "Stra\u00dfe \u00c9t\u00e9. e\u0301t\u00e9!!", "it's don't 's 'S x's.", "a1b2 ...,, '., foo's'  x\u00a0y \x1c z\x85q", "\x0b\x0c", "\x00 nul\x00x",
    "\u4e2d\u6587 \U0001F600!! word\u3000wide", "a \u0301b e\n\u0301", "A" * 500 + " " + "ab" * 90, "under_score _bar a- <|endoftext| >",
    "K \u017f \u03a3\u03a3 \u1e9e", "w" + "!" * 15, "w" + "!" * 17, "(paren) \"Quoted\" K.K."]


def test_columns_against_the_tokenizer(monkeypatch):
    path = vocabulary_path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    expected = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for t in ODD_TEXTS]
    encoder = tokens.ColumnEncoder(path)
    # Also with units forgotten in between, and in slices.
    for most in (1_000_000, 3, 3):
        monkeypatch.setattr(tokens, "UNITS", most)
        for part in (slice(None), slice(3, 9), slice(0, 0), slice(0, 2)):
            column = pa.array(ODD_TEXTS, pa.string())[part]
            ids, sizes = encoder.encode(column, 1)
            assert [list(i) for i in np.split(ids, np.cumsum(sizes)[:-1])] == expected[part] or not len(column) and not len(ids)
    assert len(encoder.names) < 200


def test_new_words_go_to_the_tokenizer_together(monkeypatch):
    encoder = tokens.ColumnEncoder(vocabulary_path("word_bpe_49k.json"))
    calls, encoded = [], encoder._encoded
    monkeypatch.setattr(encoder, "_encoded", lambda units, together: calls.append(len(units)) or encoded(units, together))
    letters = ["".join(chr(97 + (n // 26 ** k) % 26) for k in range(3)) for n in range(1_000)]
    encoder.encode(pa.array([" ".join(letters), ". ".join(letters), " ".join(letters).upper()]), 1)
    assert sum(calls) == 1_002 and len(calls) <= 8
    encoder.encode(pa.array([" ".join(letters)]), 1)
    assert sum(calls) == 1_002


def test_query_against_the_tokenizer(spark, testdata):
    folder = str(testdata / "sf0.01")
    rows = sorted(QUERIES["op5_token_files"](spark, folder).collect(), key=lambda r: r.doc_id)
    docs = sorted(spark.read.parquet(f"{folder}/documents.parquet").collect(), key=lambda r: r.doc_id)
    tokenizer = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    start = 0
    assert len(rows) == len(docs)
    for r, d in zip(rows, docs):
        ids = [*tokenizer.encode(d.text or "", add_special_tokens=False).ids, 1]
        assert (r.doc_id, r.start, r.n_tokens) == (d.doc_id, start, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_odd_rows_over_many_segments(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", 50)
    rows = [(9, "b", 1), (9, "a", 1), (None, "x y", 1), (3, None, 1), (1, "", 1), (7, "word " * 20_000, None),
            (9, "a", 1)] + [(100 + i, f"text {i}", 0) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int")
    segments = token_files.write_files(docs, f"file://{tmp_path}/ids")
    assert segments.count() > 2
    found = sorted(token_files.read_files(segments).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found[:8]] == [None, 1, 3, 7, 9, 9, 9, 100]
    assert [r.n_tokens for r in found[1:3]] == [1, 1]
    assert all(a.start + a.n_tokens == b.start for a, b in zip(found, found[1:]))
    assert token_files.round_trip(docs.limit(0)).collect() == []
