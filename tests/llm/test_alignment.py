"""Alignment against the tokenizers themselves and a plain merge of offsets."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from fleetwright.llm import alignment
from fleetwright.llm.queries import QUERIES
from fleetwright.llm.tokens import PieceEncoder, vocabulary_path

A_PATH, B_PATH = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model")
LETTERS = {chr(b): b for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}
for byte in (b for b in range(256) if b not in LETTERS.values()):
    LETTERS[chr(256 + sum(v not in range(33, 127) and v not in range(161, 173) and v not in range(174, 256)
                          for v in range(byte)))] = byte
PLAIN = {}


def plain_tokens(text):
    """Ids and bytes of both tokenizers, straight from the libraries."""
    if not PLAIN:
        PLAIN["a"], PLAIN["b"] = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
        PLAIN["a"].encode_special_tokens = True
    a = PLAIN["a"].encode(" " + text, add_special_tokens=False)
    b = PLAIN["b"].encode(text)
    pieces = [PLAIN["b"].id_to_piece(i) for i in b]
    return (a.ids, [bytes(LETTERS[c] for c in t) for t in a.tokens],
            b, [bytes([int(p[3:5], 16)]) if PLAIN["b"].is_byte(i) else p.replace("▁", " ").encode()
                for i, p in zip(b, pieces)])


def plain_groups(text):
    """The groups of a text as pairs of id lists; none where the bytes differ."""
    if not text:
        return [], [], []
    a, a_bytes, b, b_bytes = plain_tokens(text)
    whole = b" " + text.encode()
    if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
        return [], [], []
    a_ends, b_ends = (np.cumsum([len(t) for t in each]).tolist() for each in (a_bytes, b_bytes))
    groups, last = [], (0, 0)
    for cut in sorted(set(a_ends) & set(b_ends)):
        until = a_ends.index(cut, last[0]) + 1, b_ends.index(cut, last[1]) + 1
        groups.append((a[last[0]:until[0]], b[last[1]:until[1]]))
        last = until
    return a, b, groups


def plain_rows(docs):
    aligned = [(doc, *plain_groups(text)) for doc, text in docs]
    links = [[(x, y) for ga, gb in groups for x in ga for y in gb] for *_, groups in aligned]
    counts = Counter(pair for each in links for pair in set(each))
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    rows = []
    for (doc, a, b, groups), each in zip(aligned, links):
        written = ";".join(f"{','.join(map(str, ga))}|{','.join(map(str, gb))}" for ga, gb in groups)
        digest = hashlib.sha256(written.encode()).hexdigest() if written else ""
        rows.append((doc, len(a), len(b), len(groups), len(each), sum(counts[p] == best[p[0]] for p in each),
                     sum(counts[p] for p in each), digest))
    return sorted(rows, key=str)


TEXTS = st.text(alphabet=" \n\t\x00ab'sé1,.|<>_́語▁\xa0ﬁ😀", max_size=30)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXTS, max_size=5))
def test_batches_against_a_plain_merge(texts):
    batch = alignment._aligner(A_PATH, B_PATH).align(texts)
    found = batch.digests(alignment._aligner(A_PATH, B_PATH).a_digits, alignment._aligner(A_PATH, B_PATH).b_digits)
    plain = plain_rows(list(enumerate(texts)))
    mine = sorted(zip(range(len(texts)), batch.n_a.tolist(), batch.n_b.tolist(), batch.groups().tolist(),
                      batch.links().tolist(), found), key=str)
    assert mine == [(*row[:5], row[7]) for row in plain]
    links = sorted((batch.of_a[x], batch.a[x], batch.b[y]) for x, y in zip(batch.link_a.tolist(), batch.link_b.tolist()))
    assert links == sorted((d, x, y) for d, t in enumerate(texts) for ga, gb in plain_groups(t)[2] for x in ga for y in gb)


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXTS, max_size=4))
def test_pieces_are_those_of_the_whole_text(texts):
    encoder = ENCODERS.setdefault("b", PieceEncoder(B_PATH))
    assert encoder.wordwise
    whole = sentencepiece.SentencePieceProcessor(model_file=B_PATH) if "sp" not in ENCODERS else ENCODERS["sp"]
    ENCODERS["sp"] = whole
    assert [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode(texts)] == [whole.encode(t) for t in texts]


ENCODERS = {}


@settings(max_examples=200, deadline=None)
@given(st.data())
def test_lanes_do_not_change_the_merge(data):
    """Any two sequences over the same bytes, in lanes of any length."""
    sizes = data.draw(st.lists(st.integers(1, 12), min_size=1, max_size=6))
    def pieces(n):
        cuts = data.draw(st.sets(st.integers(1, n), max_size=n)) | {n}
        return sorted(cuts)
    a_end, b_end, first, base = [], [], [], 0
    for n in sizes:
        first.append(len(a_end))
        a_end += [base + c for c in pieces(n)]
        b_end += [base + c for c in pieces(n)]
        base += n
    a_end, b_end = np.array(a_end), np.array(b_end)
    shared = set(a_end.tolist()) & set(b_end.tolist())
    before = alignment.LANE_TOKENS, alignment.LANE_SEARCH
    for lane in (1, 2, 1000):
        alignment.LANE_TOKENS, alignment.LANE_SEARCH = lane, 3
        try:
            cut_a, cut_b, link_a, link_b = alignment.lockstep(a_end, b_end, np.array(first))
        finally:
            alignment.LANE_TOKENS, alignment.LANE_SEARCH = before
        assert a_end[cut_a].tolist() == b_end[cut_b].tolist() == sorted(shared)
        group_a, group_b = (np.searchsorted(sorted(shared), ends) for ends in (a_end, b_end))
        assert sorted(zip(link_a.tolist(), link_b.tolist())) == sorted(
            (x, y) for x in range(len(a_end)) for y in range(len(b_end)) if group_a[x] == group_b[y])


@pytest.mark.parametrize("small", [False, True])
def test_odd_rows_over_many_batches(spark, monkeypatch, small):
    if small:
        for name, value in (("BATCH_DOCUMENTS", 3), ("HELD_PAIRS", 8), ("FAN_IN", 2), ("LINK_ROWS", 2), ("LANE_TOKENS", 16)):
            monkeypatch.setattr(alignment, name, value)
    docs = [(1, "The cat sat, naïve ﬁsh 語 😀"), (2, None), (3, ""), (4, "a▁b"), (5, "<|endoftext|> </s> <unk>"),
            (None, "The cat sat"), (6, "The cat sat"), (6, "The cat sat"), (7, " two  blanks \n\n end "),
            ((1 << 60) + 1, "word wörter " * 3000), (8, "\x00\x01")]
    docs += [(100 + i, f"The cat {i % 7} sat thththth{i % 5}") for i in range(40)]
    table = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, part int, n_a string")
    found = sorted(map(tuple, alignment.align_documents(table.repartition(4)).collect()), key=str)
    assert found == plain_rows(docs)


def test_empty_table(spark):
    table = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align_documents(table).collect() == []
    assert alignment.alignments(table).collect() == []


def test_groups_as_rows(spark):
    docs = [(1, "The naïve 語 cat"), (2, None), (None, "x y")]
    rows = alignment.alignments(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    for row in rows:
        a, b, groups = plain_groups(dict(docs)[row.doc_id])
        assert (row.a_ids, row.b_ids) == (a, b)
        bounds = list(zip([0, *row.a_until], row.a_until, [0, *row.b_until], row.b_until))
        assert [(a[p:q], b[r:s]) for p, q, r, s in bounds] == groups


def test_query_against_a_plain_version(spark, testdata):
    folder = str(testdata / "sf0.001")
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op11_alignment"](spark, folder).collect()), key=str) == plain_rows(docs)
