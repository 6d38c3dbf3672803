"""Packing: pieces against the tokenizer, placement against its constraints and bounds."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from fleetwright.llm import packing, tokens
from fleetwright.llm.packing import Capacity, best_fit
from fleetwright.llm.queries import QUERIES
from fleetwright.llm.tokens import Encoder, vocabulary_path


def plain_ids(name, texts):
    tokenizer = Tokenizer.from_file(vocabulary_path(name))
    return [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=120, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t \x1cab'sé1,.|*_́Σ語", max_size=25), max_size=4))
def test_ids_are_those_of_the_whole_text(texts):
    for name, joins in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        encoder = ENCODERS.setdefault(name, Encoder(vocabulary_path(name), joins))
        found = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode(texts)]
        assert found == plain_ids_cached(name, texts)


def test_a_model_makes_room_in_a_worker():
    from fleetwright.llm import toxicity

    kept = tokens.encoder(vocabulary_path("byte_bpe_50k.json"), True)
    before = kept.encode(["ab cd"])
    model = toxicity._model(toxicity.joined([b"a"]), np.ones(1), [(1, True, np.zeros(1, np.int32), np.ones(1, np.int32))])
    assert tokens._ENCODERS and model.index.size == 1 and not tokens._ENCODERS
    # A partition that is being encoded goes on.
    assert kept.encode(["ab cd"]) == before


ENCODERS, TOKENIZERS = {}, {}


def plain_ids_cached(name, texts):
    if name not in TOKENIZERS:
        TOKENIZERS[name] = Tokenizer.from_file(vocabulary_path(name))
    return [TOKENIZERS[name].encode(t, add_special_tokens=False).ids for t in texts]


def test_query_places_every_token_once(spark, testdata):
    folder = str(testdata / "sf0.01")
    rows = QUERIES["op9_packing"](spark, folder).collect()
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    ids = dict(zip(docs, plain_ids("byte_bpe_50k.json", docs.values())))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(docs)
    for key, pieces in by_doc.items():
        pieces.sort(key=lambda r: r.piece)
        want = np.array([*ids[key], 2], dtype="<u4")
        assert [r.piece for r in pieces] == list(range(len(pieces)))
        assert len(want) > 1024 or len(pieces) == 1
        assert all(r.length == 1024 for r in pieces[1:])
        place = 0
        for r in pieces:
            assert r.start == place
            assert r.ids_crc32 == zlib.crc32(want[place:place + r.length].tobytes())
            place += r.length
        assert place == len(want)
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 1024
    fewest = -(-sum(r.length for r in rows) // 1024)
    assert len(by_sequence) <= 1.01 * fewest + 1


def plain_choice(rooms, item, capacity):
    """The best open sequence by looking at all of them."""
    lt, ld, _ = capacity.limits()
    parts = capacity.cost or packing._COST_PARTS
    best = None
    for number, (t, d, c) in enumerate(rooms):
        if t >= item[0] and d >= 1 and (capacity.cost is None or c >= item[1]):
            if capacity.rule == "norm":
                value = sum(w * x * x for w, x in zip(capacity.weights, (
                    (t - item[0]) / lt, (d - 1) / ld, (c - item[1]) / parts)))
            else:
                value = -sum(w * x for w, x in zip(capacity.weights, (
                    t * item[0] / lt ** 2, d / ld ** 2, c * item[1] / parts ** 2)))
            if best is None or value < best[0] - 1e-12:
                best = value, number
    return best


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60), st.sampled_from(["norm", "dot"]),
       st.sampled_from([None, 3]), st.sampled_from([None, 4096, 4500]))
def test_choice_is_the_best_of_all(lengths, rule, documents, cost):
    capacity = Capacity(64, documents, cost, (1.0, 0.3, 0.2), rule)
    sequences, offsets = best_fit(np.array(lengths, dtype=np.int64), capacity)
    most_tokens, most_documents, most_cost = capacity.limits()
    rooms, numbers = [], {}
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        need = lengths[item], lengths[item] ** 2 if cost else lengths[item] ** 2 * packing._COST_PARTS // most_cost
        best = plain_choice(rooms, need, capacity)
        if best is None:
            rooms.append([most_tokens, most_documents, cost or packing._COST_PARTS])
            numbers[sequences[item]] = len(rooms) - 1
            chosen = len(rooms) - 1
        else:
            chosen = numbers[sequences[item]]
            t, d, c = rooms[chosen]
            value = plain_choice([rooms[chosen]], need, capacity)
            assert value is not None and abs(value[0] - best[0]) < 1e-9
        assert offsets[item] == most_tokens - rooms[chosen][0]
        rooms[chosen] = [rooms[chosen][0] - need[0], rooms[chosen][1] - 1, rooms[chosen][2] - need[1]]


def test_every_constraint_holds():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 1025, 3_000)
    capacity = Capacity(1024, 3, 600_000)
    short = lengths[lengths ** 2 <= 600_000]
    sequences, _ = best_fit(short, capacity)
    for s in np.unique(sequences):
        inside = short[sequences == s]
        assert inside.sum() <= 1024 and len(inside) <= 3 and (inside ** 2).sum() <= 600_000


def test_pieces_of_lengths():
    for tokens in (1, 1023, 1024, 1025, 2048, 5000):
        pieces = packing.cut(tokens, 1024)
        assert sum(length for _, length in pieces) == tokens
        assert all(length == 1024 for _, length in pieces[1:])
        assert [start for start, _ in pieces] == [sum(x for _, x in pieces[:k]) for k in range(len(pieces))]


def test_odd_rows(spark):
    rows = [(1, None, 5), (None, "", 5), (3, "word " * 30_000, None), (4, "same text", 1), (4, "same text", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, offset int")
    found = packing.packed_documents(docs).collect()
    lengths = defaultdict(int)
    for r in found:
        lengths[r.doc_id] += r.length
    assert lengths[1] == 1 and lengths[None] == 1 and lengths[3] > 30_000
    assert sum(r.doc_id == 4 for r in found) == 2
    assert packing.packed_documents(docs.limit(0)).collect() == []


@pytest.mark.parametrize("rows", [1, 7])
def test_groups_are_packed_apart(spark, monkeypatch, rows):
    monkeypatch.setattr(packing, "GROUP_PIECES", rows)
    frame = spark.createDataFrame([(i, 10 + i) for i in range(40)], "doc_id long, length long")
    found = packing.pack(frame).collect()
    ends = defaultdict(list)
    for r in found:
        ends[r.sequence_id].append((r.offset, r.offset + r.length))
    assert sum(map(len, ends.values())) == 40
    assert all(a[1] == b[0] for places in ends.values() for a, b in zip(sorted(places), sorted(places)[1:]))


def test_strings_of_added_tokens_are_those_tokens():
    text = "hello <|endoftext|> world <|startoftext|> a"
    plain = Encoder(vocabulary_path("word_bpe_49k.json"), False, plain_specials=True)
    usual = Encoder(vocabulary_path("word_bpe_49k.json"), False)
    assert np.frombuffer(usual.encode([text])[0], "<u4").tolist() == [3306, 49407, 1002, 49406, 320]
    assert len(plain.encode([text])[0]) == 4 * 16


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_small_pieces_fill_whole_sequences(rule):
    for lengths in ([1] * 1024, [3] * 300 + [1] * 124, [1000] + [1] * 24, [1] * 3000):
        sequences, _ = best_fit(np.array(lengths), Capacity(rule=rule))
        assert len(set(sequences.tolist())) == -(-sum(lengths) // 1024)


def test_a_stated_cost_is_kept_exactly():
    lengths = np.random.default_rng(4).integers(1, 200, 400)
    sequences, _ = best_fit(lengths, Capacity(cost=40_000))
    for sequence in set(sequences.tolist()):
        assert (lengths[sequences == sequence] ** 2).sum() <= 40_000
    # Two pieces whose squares are exactly the capacity share a sequence.
    assert len(set(best_fit(np.array([120, 160]), Capacity(cost=40_000))[0].tolist())) == 1
