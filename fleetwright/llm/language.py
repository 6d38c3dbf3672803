"""Language identification by error-correcting output codes.

Every language has a codeword; a bit splits the languages in two, and a binary
classifier over byte n-grams predicts it. Decoding compares the predicted bits
with each codeword: a wrong bit costs the logistic loss of its margin, weighted by
how well that classifier did on rows it had not seen. The nearest codeword is the
language; a result is ambiguous if the next one is nearly as near.

Learning takes a bounded sample per language. One part gives n-gram counts, from
which each bit's log-odds follow (its classifier is linear in the n-grams); the
other part fits the scale of each bit's margin and its weight.

Defined cases: a NULL text, or one without a letter, is `und` with score 0; so is
every text if nothing could be learnt. With one language all others get that one.
NULL languages are not learnt from, and neither are rows without id. Equal rows get
equal results; other columns are not read; an empty table gives an empty result.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from fleetwright.llm.common import byte_texts, in_slices, materialise

UNKNOWN = "und"
# Bound of learning: rows per language (expected; drawn by a hash of the id).
SAMPLE_ROWS = 1_200
# N-grams of 1 to 4 bytes are hashed to this many cells.
CELL_BITS, LONGEST_GRAM = 15, 4
# Codes of up to this many languages have every possible bit; others a random one.
EXHAUSTIVE, BITS_PER_DOUBLING = 5, 10
AMBIGUOUS = 0.1
_SEED, _SMOOTH = 23, 0.5
# Bytes looked at together, and the share of the sample that calibrates.
_AT_ONCE, _CALIBRATE = 1 << 19, 4
_LETTER = regex.compile(r"\p{L}")
_PRIMES = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)


# ---- codes ------------------------------------------------------------------

def codewords(languages: int, seed: int = _SEED) -> np.ndarray:
    """A row of -1 and 1 per language; every column splits the languages.

    Up to EXHAUSTIVE languages all splits; beyond, the best of some random
    matrices by the smallest distance between two rows.
    """
    if languages < 2:
        return np.zeros((languages, 0))
    if languages <= EXHAUSTIVE:
        splits = np.arange(1, 1 << (languages - 1))
        return np.array([[1.0 if s >> row & 1 else -1.0 for s in splits] for row in range(languages)])
    rng = np.random.default_rng([seed, languages])
    width = int(np.ceil(BITS_PER_DOUBLING * np.log2(languages)))
    best, distance = None, -1
    for _ in range(50):
        code = np.empty((languages, width))
        for bit in range(width):
            code[:, bit] = rng.permutation(np.where(np.arange(languages) < languages // 2, 1.0, -1.0))
        apart = (width - code @ code.T) / 2
        np.fill_diagonal(apart, width)
        if apart.min() > distance:
            best, distance = code, apart.min()
    return best


# ---- n-grams ----------------------------------------------------------------

def cells(data: np.ndarray) -> list[np.ndarray]:
    """For each n-gram length the cell of the n-gram that begins at each byte."""
    wide, grams = data.astype(np.uint32), []
    packed = np.zeros(len(wide), np.uint32)
    for n in range(1, LONGEST_GRAM + 1):
        packed = packed[:len(wide) - n + 1] | wide[n - 1:] << np.uint32(8 * (n - 1))
        grams.append((packed * np.uint32(_PRIMES[n - 1])) >> np.uint32(32 - CELL_BITS))
        if len(wide) <= n:
            break
    return grams


def _prepared(text: bytes) -> bytes:
    """Lower-cased (all letters, not only A-Z), white space as single blanks."""
    return b" " + b" ".join(text.decode("utf-8", "replace").lower().encode().split()) + b" "


def _texts_at_once(texts: list[bytes]):
    """Texts as bytes, some at a time: (places, joined bytes, starts). A long text comes in
    parts, whose sums are the text's but for the n-grams across the cut."""
    places, held, size = [], [], 0
    for place, text in enumerate(texts):
        for start in range(0, len(text), _AT_ONCE):
            part = text[start:start + _AT_ONCE]
            places.append(place)
            held.append(part)
            size += len(part)
            if size >= _AT_ONCE:
                yield places, held
                places, held, size = [], [], 0
    if held:
        yield places, held


def margins(texts: list[bytes], weights: np.ndarray) -> np.ndarray:
    """Mean weight of the n-grams of each text, per bit."""
    total, grams = np.zeros((len(texts), weights.shape[1])), np.zeros(len(texts))
    for places, parts in _texts_at_once(texts):
        sizes = np.array([len(p) for p in parts])
        data = np.frombuffer(b"".join(parts), np.uint8)
        starts = np.r_[0, np.cumsum(sizes)[:-1]]
        places = np.array(places)
        for n, cell in enumerate(cells(data), start=1):
            # N-grams that run over into the next text count for neither; one that
            # begins in the last n - 1 bytes of a text does.
            inside = np.ones(len(cell), bool)
            for back in range(1, n):
                ends = starts + sizes - back
                inside[ends[(ends >= 0) & (ends < len(cell))]] = False
            found = weights[cell]
            found[~inside] = 0.0
            rows = np.flatnonzero(sizes > 0)
            begins = np.minimum(starts[rows], max(len(cell) - 1, 0))
            sums = np.add.reduceat(found, begins, axis=0)
            full = starts[rows] < len(cell)
            np.add.at(total, places[rows][full], sums[full])
            np.add.at(grams, places, np.maximum(sizes - n + 1, 0))
    return total / np.maximum(grams, 1)[:, None]


def gram_counts(texts: list[bytes]) -> np.ndarray:
    counts = np.zeros(1 << CELL_BITS, np.int64)
    for text in texts:
        for start in range(0, len(text), _AT_ONCE):
            for cell in cells(np.frombuffer(text[start:start + _AT_ONCE], np.uint8)):
                counts += np.bincount(cell, minlength=1 << CELL_BITS)
    return counts


# ---- model ------------------------------------------------------------------

@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    scale: np.ndarray
    shift: np.ndarray
    trust: np.ndarray

    def losses(self, margin: np.ndarray) -> np.ndarray:
        """Weighted logistic loss of each text against each codeword."""
        bits = margin * self.scale + self.shift
        return np.einsum("tlb,b->tl", np.logaddexp(0.0, -bits[:, None, :] * self.code[None]), self.trust)

    def decode(self, texts: list[bytes]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and gap to the next language of each prepared text."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        if len(self.languages) == 1:
            return self.languages * len(texts), np.ones(len(texts)), np.ones(len(texts))
        loss = self.losses(margins(texts, self.weights))
        likely = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
        likely /= likely.sum(axis=1, keepdims=True)
        best = likely.argmax(axis=1)
        ranked = np.sort(likely, axis=1)
        return [self.languages[b] for b in best], ranked[:, -1], ranked[:, -1] - ranked[:, -2]


def _bit_weights(counts: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Log-odds of every cell for every bit; each language counts the same."""
    rates = (counts + _SMOOTH) / (counts + _SMOOTH).sum(axis=1, keepdims=True)
    ones = (code.T > 0) @ rates / (code > 0).sum(axis=0)[:, None]
    zeros = (code.T < 0) @ rates / (code < 0).sum(axis=0)[:, None]
    return np.log(ones / zeros).T.astype(np.float32)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Scale and shift of a logistic curve from x to y in {-1, 1}, by Newton steps; the
    scale is held back a little, so separable rows do not drive it off."""
    spread = max(float(np.abs(x).mean()), 1e-9)
    z, a, b = x / spread, 1.0, 0.0
    for _ in range(30):
        p = 1.0 / (1.0 + np.exp(np.clip(-(a * z + b), -30, 30)))
        error, flat = p - (y > 0), np.maximum(p * (1 - p), 1e-6)
        gradient = np.array([(error * z).sum() + 0.01 * a, error.sum() + 0.01 * b])
        curve = np.array([[(flat * z * z).sum() + 0.01, (flat * z).sum()], [(flat * z).sum(), flat.sum() + 0.01]])
        step = np.linalg.solve(curve, gradient)
        a, b = a - float(np.clip(step[0], -2, 2)), b - float(np.clip(step[1], -2, 2))
    return max(a, 0.0) / spread, b


def learn(rows: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from (doc_id, text, lang); all rows given may be learnt from."""
    usable = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    found = sorted((r["lang"], r["count"]) for r in usable.groupBy("lang").count().collect())
    languages = [lang for lang, _ in found]
    code = codewords(len(languages))
    width = code.shape[1]
    model = Model(languages, code, np.zeros((1 << CELL_BITS, width), np.float32), np.ones(width), np.zeros(width), np.ones(width))
    if len(languages) < 2:
        return model
    # Of each language about sample_rows rows: one list of shares, as long as there are languages.
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(_SEED)), F.lit(1_000_000))
    shares = F.create_map(*[F.lit(x) for lang, n in found for x in (lang, int(min(1.0, sample_rows / n) * 1_000_000))])
    part = F.when(F.pmod(F.xxhash64("doc_id", F.lit(_SEED + 1)), F.lit(_CALIBRATE)) == 0, 1).otherwise(0)
    sample = materialise(
        usable.filter(drawn < F.element_at(shares, F.col("lang"))).select("lang", "text", part.alias("part")), "language_sample")
    number = {lang: i for i, lang in enumerate(languages)}

    def counted(batches):
        counts: dict[str, np.ndarray] = {}
        for batch in in_slices(batches):
            for text, lang in zip(byte_texts(batch.column("text")), batch.column("lang").to_pylist()):
                counts.setdefault(lang, np.zeros(1 << CELL_BITS, np.int64))
                counts[lang] += gram_counts([_prepared(text)])
        for lang, cell in counts.items():
            some = np.flatnonzero(cell)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(some), pa.string()), pa.array(some), pa.array(cell[some])], ["lang", "cell", "n"])

    # One number per language and cell, however large the sample.
    added = (
        sample.filter("part = 0").mapInArrow(counted, "lang string, cell bigint, n bigint")
        .groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas()
    )
    counts = np.zeros((len(languages), 1 << CELL_BITS))
    counts[added["lang"].map(number).to_numpy(dtype=int), added["cell"].to_numpy(dtype=int)] = added["n"].to_numpy()
    model.weights = _bit_weights(counts, code)

    def measured(batches):
        for batch in in_slices(batches):
            margin = margins([_prepared(t) for t in byte_texts(batch.column("text"))], model.weights)
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), pa.array(list(margin.astype(float)), pa.list_(pa.float64()))], ["lang", "margin"])

    held = sample.filter("part = 1").mapInArrow(measured, "lang string, margin array<double>").collect()
    if held:
        margin, truth = np.array([r["margin"] for r in held]), np.array([number[r["lang"]] for r in held])
        # Every language weighs the same here as well.
        for bit in range(width):
            y = code[truth, bit]
            if (y > 0).any() and (y < 0).any():
                model.scale[bit], model.shift[bit] = _logistic(margin[:, bit], y)
            right = ((margin[:, bit] * model.scale[bit] + model.shift[bit]) * y > 0).mean()
            model.trust[bit] = max(2 * right - 1, 0.01)
        # Bits of one code repeat each other; together they weigh as those that tell two languages apart.
        model.trust *= 2.0 / model.trust.sum()
    return model


def predict(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, lang_pred, score, ambiguous) of every whole text."""
    def decoded(batches):
        for batch in in_slices(batches):
            texts = byte_texts(batch.column("_text"))
            some = [i for i, t in enumerate(texts) if _LETTER.search(t.decode("utf-8", "replace"))]
            names, score, gap = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
            if some:
                found, score[some], gap[some] = model.decode([_prepared(texts[i]) for i in some])
                for i, name in zip(some, found):
                    names[i] = name
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key"), pa.array(names, pa.string()), pa.array(score),
                 pa.array(gap < AMBIGUOUS)], ["_key", "lang_pred", "score", "ambiguous"])

    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    kind = rows.schema["_key"].dataType.simpleString()
    return rows.mapInArrow(decoded, f"_key {kind}, lang_pred string, score double, ambiguous boolean").withColumnRenamed("_key", key)
