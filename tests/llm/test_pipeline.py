"""The pipeline against plain versions of its stages, one stage's output the next one's input."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from fleetwright.llm import mixing, packing, toxicity
from fleetwright.llm.common import documents
from fleetwright.sources.tables import parquet_table
from tests.llm.test_mixing import plain_targets
from tests.llm.test_packing import plain_ids
from tests.llm.test_pii import plain_spans
from tests.llm.test_simhash import brute_components, plain_fingerprint

NAMES = ["toxicity", "simhash_near_dedup", "pii", "mixing", "packing"]


@pytest.fixture(scope="module")
def stages(spark, testdata):
    """The rows before and after each stage."""
    folder = str(testdata / "sf0.01")
    docs = documents(spark, folder)
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialise(stage(spark, docs, folder), f"test_{name}")
        frames.append(docs)
    return folder, [f.columns for f in frames], [f.collect() for f in frames]


def test_stages_and_columns(stages):
    _, columns, rows = stages
    assert [name for name, _ in corpus_pipeline.STAGES] == NAMES
    assert all(c == ["doc_id", "text", "lang", "source", "n_chars"] for c in columns[:5])
    assert all(rows)


def test_toxic_documents_go(spark, stages):
    folder, _, rows = stages
    labels = parquet_table(spark, folder, "labels").select("doc_id", "toxic")
    model = toxicity.learn(documents(spark, folder), toxicity.learning_rows(labels, 5, 0))
    vectors = toxicity.Vectors(model.terms, model.idf)
    index = model.index
    dense = np.zeros((index.size, len(model.terms)))
    dense[np.repeat(np.arange(index.size), index.sizes), index.terms] = index.values
    kept = set()
    for r in rows[0]:
        vector = vectors.of((r.text or "").encode())
        query = np.zeros(len(model.terms))
        query[vector[0]] = vector[1]
        cosines = dense @ query
        near = sorted(((-c, e) for e, c in enumerate(cosines) if c > 0))[:toxicity.NEIGHBOURS]
        score = model.plain_rate
        if near:
            vote = model.vote([(-c, e) for c, e in near])
            score = 0.999 * float(np.interp(vote, *model.curve)) + 0.001 * vote
        if score < 0.5:
            kept.add(r.doc_id)
    assert {r.doc_id for r in rows[1]} == kept
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    gone = {r.doc_id for r in rows[0]} - kept
    assert sum(truth.get(i, 0) for i in gone) >= 0.6 * sum(truth.values())
    assert sum(truth.get(i) == 0 for i in gone) <= 0.02 * len(truth)


def test_one_of_each_group_stays(stages):
    before, after = stages[2][1], stages[2][2]
    ids = sorted(r.doc_id for r in before)
    texts = {r.doc_id: r.text for r in before}
    component = brute_components(list(range(len(ids))), [plain_fingerprint(texts[i]) for i in ids], 3)
    assert sorted(r.doc_id for r in after) == sorted({ids[c] for c in component.values()})
    assert all(r.text == texts[r.doc_id] for r in after)


def test_personal_data_is_replaced(stages):
    before, after = ({r.doc_id: r for r in rows} for rows in stages[2][2:4])
    assert set(before) == set(after)
    changed = 0
    for key, r in before.items():
        spans = plain_spans(r.text or "")
        changed += bool(spans)
        assert not plain_spans(after[key].text or "")
        for _, a, b in spans:
            assert r.text[a:b] not in (after[key].text or "")
        if not spans and not re.search(r"(?i)iban|ssn|acc|konto", r.text or ""):
            assert after[key].text == r.text
        assert after[key].n_chars == len(after[key].text)
    assert changed > 10


def test_documents_are_taken_to_target(spark, stages):
    before, after = stages[2][3], stages[2][4]
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in before}
    total, taken = Counter(), Counter()
    for r in before:
        total[r.source] += size[r.doc_id]
    copies = Counter(r.doc_id for r in after)
    assert max(copies.values()) <= mixing.MAX_REPEATS
    for r in after:
        taken[r.source] += size[r.doc_id]
    want = plain_targets(total)
    assert all(abs(taken[s] - want[s]) <= max(5, 0.01 * want[s]) for s in total)
    texts = {r.doc_id: r.text for r in before}
    assert all(texts[r.doc_id] == r.text for r in after)


def test_sequences_hold_every_token(stages):
    before, after = stages[2][4], stages[2][5]
    ids = plain_ids(packing.VOCABULARY, [r.text or "" for r in before])
    assert sum(r.length for r in after) == sum(len(i) + 1 for i in ids)
    assert Counter(r.doc_id for r in after if r.piece == 0) == Counter(r.doc_id for r in before)
    places = defaultdict(list)
    for r in after:
        places[r.sequence_id].append((r.offset, r.length))
    for inside in places.values():
        inside.sort()
        assert inside[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(inside, inside[1:]))
        assert sum(n for _, n in inside) <= 1024


def test_run_is_all_stages(spark, testdata):
    rows = corpus_pipeline.run(spark, str(testdata / "sf0.001"))
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert rows.count() > 0


def test_stages_take_odd_rows_and_empty_tables(spark, testdata):
    folder = str(testdata / "sf0.001")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    odd = spark.createDataFrame(
        [(1, None, None, None, None), (None, "", None, None, 0), (3, "word " * 20_000, "en", "a", 100_000),
         (4, "same text", "en", "a", 9), (4, "same text", "en", "a", 9)], schema)
    for docs, least in ((odd, 1), (odd.limit(0), 0)):
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.materialise(stage(spark, docs, folder), "odd")
            assert docs.count() >= least
