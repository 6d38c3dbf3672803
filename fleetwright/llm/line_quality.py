"""Document quality by a linear-chain conditional random field over lines.

Every line with a word is labelled good or bad. A line's features are its size, the kinds
of characters and words in it, and how much of it the document has had before, each as
its value and as steps at fixed values, with the values of the lines before and behind.
The field scores features and transitions; forward-backward gives each line's marginal
probability of being good, and the marginals, weighted by the lines' lengths, make the
document's raw score. A curve fitted to the examples turns it into a probability.

Learning takes a bounded sample of labelled documents, whose lines carry the document's
label. Each step of L-BFGS is a job: tasks run forward-backward over their part of the
sample's features and return one gradient each. All lanes of a batch (documents) advance
by one line at a time, longest documents first.

Defined cases: a document without a line with a word (NULL, empty, white space) gets the
share of good ones among such examples, smoothed towards one half. Without labels of both
kinds every score is the share of good examples, one half if there are none. A document
labelled more than once is bad if one label says so; NULL labels and NULL ids are not
learnt from. Equal texts get equal scores. A document without a doc_id is scored like any
other. Texts of any length are read whole; other columns, of any name, are not read.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fleetwright.llm.common import byte_texts, held_out, materialise, sized

# Bound of learning: rows (expected; drawn by a hash of the id).
SAMPLE_ROWS = 12_000
THRESHOLD = 0.3
_SEED = 13
# Steps of the fit, gradients it remembers, weight of the squared parameters.
MOST_STEPS, MEMORY, PENALTY = 40, 8, 1e-3
# Text and documents whose lines are in memory together.
BATCH_BYTES, BATCH_DOCUMENTS = 1 << 20, 1_024

_KINDS = ("upper", "letter", "digit", "stop", "shout", "bar", "sign", "quote", "other", "space")
_EDGES = (0.01, 0.03, 0.07, 0.15, 0.3, 0.5, 0.8)
# Sizes are logarithms, divided so that most fall between 0 and 1.
_SIZES = ("bytes", "words", "word_bytes")
_SHARES = ("capital", "marked", "again", "repeated", "same_line")
NAMES = (*_SIZES, *_KINDS[:-1], *_SHARES)


def _kind_table() -> np.ndarray:
    """The kind of each byte; bytes beyond ASCII count as letters."""
    kinds = np.full(256, _KINDS.index("other"), np.uint8)
    kinds[[*range(97, 123), *range(128, 256)]] = _KINDS.index("letter")
    for name, members in (("upper", bytes(range(65, 91))), ("digit", b"0123456789"), ("stop", b".,;:-"), ("shout", b"!?"),
                          ("bar", b"|"), ("sign", b"#*$%&<>~^=+@\\/_"), ("quote", b"\"'()[]{}`"),
                          ("space", b" \t\n\x0b\x0c\r")):
        kinds[list(members)] = _KINDS.index(name)
    return kinds


_KIND = _kind_table()
_SPACE = _KINDS.index("space")
# Odd, so that powers can be undone modulo 2 ** 64.
_BASE = 0x9E3779B97F4A7C15
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """The powers of the base and of its inverse, up to the n-th."""
    while len(_POWERS[0]) <= n:
        size = len(_POWERS[0])
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            _POWERS[i] = np.concatenate([_POWERS[i], _POWERS[i] * np.uint64(pow(base, size, 1 << 64))])
    return _POWERS


@dataclass
class Lines:
    """The lines with a word of a batch of documents: counted through, with their documents."""

    document: np.ndarray  # ascending
    number: np.ndarray  # the place among the document's lines, blank ones too
    weight: np.ndarray
    values: np.ndarray  # one row per line, one column per name


def _seen_before(document: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether the document has had the value earlier."""
    # A hash of both: a sort of one number.
    keys = values * np.uint64(0xD6E8FEB86659FD93) + document.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
    order = np.argsort(keys, kind="stable")
    again = np.zeros(len(keys), bool)
    again[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    return again


def lines_of(texts: list[bytes]) -> Lines:
    """The lines of all texts and what is measured of each."""
    texts = texts or [b""]
    blob = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    ends = np.flatnonzero(blob == 10)
    starts = np.r_[0, ends[:-1] + 1]
    document = np.searchsorted(begins, starts, "right") - 1
    number = np.arange(len(starts)) - np.searchsorted(starts, begins[:-1])[document]
    line = np.repeat(np.arange(len(starts)), ends - starts + 1)
    kinds = _KIND[blob]
    counts = np.bincount(line * len(_KINDS) + kinds, minlength=len(starts) * len(_KINDS)).reshape(-1, len(_KINDS))

    space = kinds == _SPACE
    word_start = np.flatnonzero(~space & np.r_[True, space[:-1]])
    word_end = np.flatnonzero(space & np.r_[False, ~space[:-1]])
    word_line = line[word_start]
    words = np.bincount(word_line, minlength=len(starts))

    power, inverse = _powers(len(blob))
    sums = np.r_[np.uint64(0), np.cumsum(blob * power[:len(blob)], dtype=np.uint64)]

    def hashed(start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (sums[end] - sums[start]) * inverse[start]

    word, word_document = hashed(word_start, word_end), document[word_line]
    again = np.zeros(len(word), bool)
    again[1:] = (word[1:] == word[:-1]) & (word_document[1:] == word_document[:-1])
    triple, inside = word.copy(), np.zeros(len(word), bool)
    if len(word) > 2:
        triple[2:] += word[1:-1] * np.uint64(3) + word[:-2] * np.uint64(7)
        inside[2:] = word_document[2:] == word_document[:-2]
    repeated = _seen_before(word_document, triple) & inside
    last = kinds[np.maximum(word_end - 1, 0)]
    marked = np.isin(last, [_KINDS.index(k) for k in ("shout", "bar", "sign", "other")])
    capital = kinds[word_start] == _KINDS.index("upper")

    kept = words > 0
    black = np.maximum(ends - starts - counts[:, _SPACE] + 1, 1)  # the line's end is a space too
    shares = [np.bincount(word_line[flag], minlength=len(starts)) / np.maximum(words, 1)
              for flag in (capital, marked, again, repeated)]
    same = np.zeros(len(starts), bool)
    same[kept] = _seen_before(document[kept], hashed(starts[kept], ends[kept]))
    values = np.column_stack([
        np.log1p(black) / 8, np.log1p(words) / 6, np.log1p(black / np.maximum(words, 1)) / 4,
        *(counts[:, k] / black for k in range(_SPACE)), *shares, same,
    ])
    return Lines(document[kept], number[kept], black[kept].astype(np.float64), values[kept].astype(np.float32))


def features(lines: Lines) -> np.ndarray:
    """Per line: one, its values, their steps, and the values of the lines before and behind."""
    values, n = lines.values, len(lines.values)
    steps = (values[:, :, None] > np.array(_EDGES, np.float32)).reshape(n, len(NAMES) * len(_EDGES))
    before, behind = np.zeros_like(values), np.zeros_like(values)
    joined = np.zeros((n, 2), np.float32)
    if n:
        same = lines.document[1:] == lines.document[:-1]
        before[1:][same], behind[:-1][same] = values[:-1][same], values[1:][same]
        joined[1:, 0], joined[:-1, 1] = same, same
    return np.concatenate([np.ones((n, 1), np.float32), values, steps.astype(np.float32), joined, before, behind], axis=1)


WIDTH = 1 + len(NAMES) * (3 + len(_EDGES)) + 2


# ---- the chain --------------------------------------------------------------

@dataclass
class Chains:
    """Marginals of all lines of a batch, pairs of neighbours summed by document, log of the partition."""

    good: np.ndarray
    pairs: np.ndarray  # document, label before, label
    log_partition: np.ndarray


def forward_backward(document: np.ndarray, score: np.ndarray, transitions: np.ndarray, documents: int) -> Chains:
    """`score` is a line's log-odds of good; `transitions[i, j]` scores label j behind label i (0 bad, 1 good)."""
    sizes = np.bincount(document, minlength=documents)
    order = np.argsort(-sizes, kind="stable")
    first = (np.cumsum(sizes) - sizes)[order]
    longest = int(sizes.max()) if documents else 0
    # Documents that still have a line at each step.
    active = np.searchsorted(-sizes[order], -np.arange(longest), "left")
    scale = np.maximum(score, 0.0)
    emitted = np.exp(np.column_stack([-scale, score - scale]))
    move = np.exp(transitions - transitions.max())
    log_norm = np.zeros(len(score))
    forward, backward = np.empty((len(score), 2)), np.ones((len(score), 2))
    for t in range(longest):
        at = first[:active[t]] + t
        reached = emitted[at] * (forward[at - 1] @ move if t else 1.0)
        total = reached.sum(axis=1)
        forward[at] = reached / total[:, None]
        log_norm[at] = np.log(total) + (transitions.max() if t else 0.0)
    for t in range(longest - 1, 0, -1):
        at = first[:active[t]] + t
        left = (emitted[at] * backward[at]) @ move.T
        backward[at - 1] = left / left.sum(axis=1)[:, None]
    both = forward * backward
    marginal = both / both.sum(axis=1)[:, None]
    pairs = np.zeros((documents, 2, 2))
    behind = np.flatnonzero(document[1:] == document[:-1]) + 1
    if len(behind):
        joint = forward[behind - 1][:, :, None] * move * (emitted[behind] * backward[behind])[:, None, :]
        joint /= joint.sum(axis=(1, 2))[:, None, None]
        for i in range(2):
            for j in range(2):
                pairs[:, i, j] = np.bincount(document[behind], joint[:, i, j], documents)
    partition = np.bincount(document, log_norm + scale, documents) if len(score) else np.zeros(documents)
    return Chains(marginal[:, 1], pairs, partition)


@dataclass
class Model:
    """Weights of the features, transitions, the curve from raw score to probability."""

    weights: np.ndarray
    transitions: np.ndarray
    slope: float = 1.0
    shift: float = 0.0
    without_lines: float = 0.5
    constant: float | None = None

    def marginals(self, texts: list[bytes]) -> tuple[Lines, np.ndarray]:
        """The lines and each one's probability of being good."""
        lines = lines_of(texts)
        if self.constant is not None:
            return lines, np.full(len(lines.document), self.constant)
        score = features(lines) @ self.weights.astype(np.float32)
        return lines, forward_backward(lines.document, score.astype(np.float64), self.transitions, len(texts)).good

    def raw(self, texts: list[bytes]) -> np.ndarray:
        """Length-weighted share of good lines; NaN for a document without lines."""
        lines, good = self.marginals(texts)
        weight = np.bincount(lines.document, lines.weight, len(texts))
        share = np.bincount(lines.document, lines.weight * good, len(texts))
        return np.where(weight > 0, share / np.maximum(weight, 1), np.nan)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        raw = self.raw(texts)
        odds = self.slope * _log_odds(raw) + self.shift
        return np.where(np.isnan(raw), self.without_lines, 1.0 / (1.0 + np.exp(-odds)))


def _log_odds(share: np.ndarray) -> np.ndarray:
    share = np.clip(share, 1e-6, 1 - 1e-6)
    return np.log(share) - np.log1p(-share)


# ---- learning ---------------------------------------------------------------

def _sample(docs: DataFrame, labels: DataFrame, sample_rows: int) -> DataFrame:
    """(text, good) of about `sample_rows` labelled documents, written."""
    usable = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    each = usable.groupBy("doc_id").agg((F.min("quality") > 0).cast("int").alias("good"))
    share = min(1.0, sample_rows / max(each.count(), 1))
    drawn = each.filter(F.pmod(F.xxhash64("doc_id", F.lit(_SEED)), F.lit(1_000_000)) < int(share * 1_000_000))
    # The drawn labels number about `sample_rows` whatever the tables hold.
    return materialise(docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").select("text", "good"), "rated")


def _measured(sample: DataFrame) -> DataFrame:
    """The sample's lines as bytes, one row per batch of documents, written."""
    def measured(batches):
        for batch in sized(batches, "text", BATCH_BYTES, BATCH_DOCUMENTS):
            lines = lines_of(byte_texts(batch.column("text")))
            good = np.array(batch.column("good").to_pylist(), np.int32)
            fields = (good, lines.document.astype(np.int32), lines.weight, lines.values)
            yield pa.RecordBatch.from_arrays(
                [pa.array([f.tobytes()], pa.binary()) for f in fields], ["good", "document", "weight", "vals"])

    return materialise(sample.mapInArrow(measured, "good binary, document binary, weight binary, vals binary"), "rated_lines")


def _batches_of(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, Lines]]:
    for batch in rows:
        for row in batch.to_pylist():
            document = np.frombuffer(row["document"], np.int32).astype(np.int64)
            values = np.frombuffer(row["vals"], np.float32).reshape(len(document), len(NAMES))
            yield (np.frombuffer(row["good"], np.int32).astype(np.int64),
                   Lines(document, np.zeros(0, np.int64), np.frombuffer(row["weight"]), values))


def loss_and_gradient(good: np.ndarray, lines: Lines, parameters: np.ndarray) -> tuple[float, np.ndarray]:
    """Negative log-likelihood of the documents' labels on all their lines, per line of each document."""
    weights, transitions = parameters[:WIDTH], parameters[WIDTH:].reshape(2, 2)
    x = features(lines).astype(np.float64)
    score = x @ weights
    chains = forward_backward(lines.document, score, transitions, len(good))
    sizes = np.bincount(lines.document, minlength=len(good))
    per_line = 1.0 / np.maximum(sizes, 1)
    label = good[lines.document]
    moves = np.maximum(sizes - 1, 0)
    own = np.bincount(lines.document, score * label, len(good)) + moves * transitions[good, good]
    slope = np.zeros(WIDTH + 4)
    slope[:WIDTH] = x.T @ ((chains.good - label) * per_line[lines.document])
    expected = (chains.pairs * per_line[:, None, None]).sum(axis=0)
    for kind in range(2):
        expected[kind, kind] -= ((moves * per_line)[good == kind]).sum()
    slope[WIDTH:] = expected.ravel()
    return float(((chains.log_partition - own) * per_line).sum()), slope


def minimise(asked: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, steps: int) -> np.ndarray:
    """L-BFGS with halved steps; `asked` gives value and gradient."""
    point, (value, slope) = start, asked(start)
    history: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        direction = slope.copy()
        used = []
        for s, y in reversed(history):
            share = (s @ direction) / (s @ y)
            used.append(share)
            direction -= share * y
        if history:
            s, y = history[-1]
            direction *= (s @ y) / (y @ y)
        else:
            direction /= max(1.0, np.linalg.norm(slope))
        for (s, y), share in zip(history, reversed(used)):
            direction += (share - (y @ direction) / (s @ y)) * s
        gain, length = slope @ direction, 1.0
        for _ in range(12):
            reached = point - length * direction
            new_value, new_slope = asked(reached)
            if new_value <= value - 1e-4 * length * gain:
                break
            length /= 2
        else:
            return point
        s, y = reached - point, new_slope - slope
        if s @ y > 1e-12:
            history = [*history[1 - MEMORY:], (s, y)]
        small = value - new_value <= 1e-5 * max(abs(new_value), 1e-3)
        point, value, slope = reached, new_value, new_slope
        if small:
            break
    return point


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from (doc_id, text) and (doc_id, quality); all rows given may be learnt from."""
    sample = _sample(docs, labels, sample_rows)
    has_word = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows, good, bare, bare_good = sample.agg(
        F.count("*"), F.count_if(F.col("good") == 1), F.count_if(~has_word), F.count_if(~has_word & (F.col("good") == 1))).first()
    none = Model(np.zeros(WIDTH), np.zeros((2, 2)))
    if not 0 < good < rows:
        return replace(none, constant=good / rows if rows else 0.5)
    table = _measured(sample)

    def summed(parameters: np.ndarray) -> tuple[float, np.ndarray]:
        def part(batches):
            value, slope = 0.0, np.zeros(WIDTH + 4)
            for labels_of, lines in _batches_of(batches):
                more, steeper = loss_and_gradient(labels_of, lines, parameters)
                value, slope = value + more, slope + steeper
            yield pa.RecordBatch.from_arrays([pa.array([value]), pa.array([slope.tolist()], pa.list_(pa.float64()))], ["value", "slope"])

        # One row per task; the tasks of a sample of stated size are few.
        parts = table.mapInArrow(part, "value double, slope array<double>").collect()
        value, slope = sum(p.value for p in parts), np.sum([p.slope for p in parts], axis=0)
        return value / rows + PENALTY * parameters @ parameters, slope / rows + 2 * PENALTY * parameters

    found = minimise(summed, np.zeros(WIDTH + 4), MOST_STEPS)
    model = replace(none, weights=found[:WIDTH], transitions=found[WIDTH:].reshape(2, 2),
                    without_lines=(bare_good + 1) / (bare + 2))
    return _fitted(table, model)


def _fitted(table: DataFrame, model: Model) -> Model:
    """The model with the logistic curve of its examples' raw scores."""
    def raw(batches):
        for good, lines in _batches_of(batches):
            score = features(lines) @ model.weights.astype(np.float32)
            line_good = forward_backward(lines.document, score.astype(np.float64), model.transitions, len(good)).good
            weight = np.bincount(lines.document, lines.weight, len(good))
            share = np.bincount(lines.document, lines.weight * line_good, len(good)) / np.maximum(weight, 1)
            yield pa.RecordBatch.from_arrays([pa.array(share[weight > 0]), pa.array(good[weight > 0])], ["share", "good"])

    # Two numbers for each row of the sample.
    examples = table.mapInArrow(raw, "share double, good bigint").toArrow().sort_by([("share", "ascending"), ("good", "ascending")])
    x, y = _log_odds(examples.column("share").to_numpy()), examples.column("good").to_numpy()

    def asked(curve):
        odds = curve[0] * x + curve[1]
        p = 1.0 / (1.0 + np.exp(-odds))
        value = np.mean(np.logaddexp(0.0, odds) - y * odds) + PENALTY * (curve[0] - 1) ** 2
        return float(value), np.array([np.mean((p - y) * x) + 2 * PENALTY * (curve[0] - 1), np.mean(p - y)])

    slope, shift = minimise(asked, np.array([1.0, 0.0]), 100) if len(x) else (1.0, 0.0)
    # More good lines never lower a score.
    return replace(model, slope=max(float(slope), 0.01), shift=float(shift))


# ---- scoring ----------------------------------------------------------------

def scores(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row of `docs` (doc_id, text)."""
    def scored(batches):
        for batch in sized(batches, "text", BATCH_BYTES, BATCH_DOCUMENTS):
            found = model.scores(byte_texts(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(scored, "doc_id bigint, score double")


def line_labels(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, line, n_bytes, p_good, good) of every line with a word; lines count from 0, blank ones too.
    `n_bytes` leaves white space out."""
    def labelled(batches):
        for batch in sized(batches, "text", BATCH_BYTES, BATCH_DOCUMENTS):
            lines, good = model.marginals(byte_texts(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(lines.document)), pa.array(lines.number, pa.int64()),
                 pa.array(lines.weight.astype(np.int64)), pa.array(good, pa.float64()), pa.array(good >= 0.5)],
                ["doc_id", "line", "n_bytes", "p_good", "good"])

    return docs.select("doc_id", "text").mapInArrow(
        labelled, "doc_id bigint, line bigint, n_bytes bigint, p_good double, good boolean")


def predicted(score: Column) -> Column:
    return F.when(score >= THRESHOLD, 1).otherwise(0)


def learning_rows(labels: DataFrame, modulus: int, remainder: int) -> DataFrame:
    """The labels that may be learnt from: those not held out."""
    return labels.filter(~held_out("doc_id", modulus, remainder))
