"""Language model scoring: unigram counts and a log-bilinear model by classes.

Texts become numbers once: each task numbers the words of a stretch of its texts (a
chunk) and writes words, counts and word numbers. From there on

* counts of all training words are added up by word and sent back to the chunks, so
  that no task needs the whole vocabulary;
* the most frequent words are classes of their own, all others share classes by
  their last letters; a log-bilinear model predicts the class of a word from the
  classes of the two before it. It is trained in numpy by noise-contrastive
  estimation on all training texts, task by task from the same beginning, and the
  parameters are averaged by the number of words behind them;
* a word's probability is that of its class, normalised over all classes by batched
  matrix products, times its smoothed share within the class, where one more place
  is kept for words not in training.

Tokens are words, A-Z lower-cased, and one end per text.

Defined cases: a NULL or empty text is its end alone; a row without id is not
trained on; equal rows get equal scores. Without training texts all words are
unknown and classes are uniform. Other columns are not read; an empty table gives
an empty result. A text of any length is one piece of one chunk.
"""

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from fleetwright.llm.common import byte_texts, in_slices, materialise

# A chunk ends with the text that reaches either of these.
CHUNK_TOKENS, CHUNK_WORDS = 1_000_000, 250_000
# Classes: frequent words, shared ones, then end of text and, as context only, begin of text.
FREQUENT, SHARED = 190, 64
END, BEGIN = FREQUENT + SHARED, FREQUENT + SHARED + 1
CLASSES = BEGIN + 1

WIDTH, NOISE, BATCH, RATE = 16, 32, 1_024, 0.2
# Tokens scored at once.
SCORED_TOKENS = 200_000
_SEED = 31


# ---- chunks -----------------------------------------------------------------

def _chunk(ids, training, sizes, numbers, words, counts):
    return pa.RecordBatch.from_arrays(
        [pa.array([ids], pa.list_(pa.int64())), pa.array([training], pa.list_(pa.bool_())),
         pa.array([sizes], pa.list_(pa.int64())),
         pa.array([pa.compress(np.concatenate(numbers).astype("<i4").tobytes(), "zstd", asbytes=True)], pa.binary()),
         pa.array([words], pa.list_(pa.binary())), pa.array([counts], pa.list_(pa.int64()))],
        ["ids", "training", "sizes", "numbers", "words", "counts"])


def chunks(rows: DataFrame) -> DataFrame:
    """(doc_id, text, training) as chunks: ids, training flags and word counts of the
    texts; the words' numbers in text order, four bytes each, compressed; the words by
    number, and how often each is in training texts. Written, so a chunk's name and
    content hold."""
    def numbered(batches):
        known: dict[bytes, int] = {}
        ids, training, sizes, numbers, counts, total = [], [], [], [], np.zeros(0, np.int64), 0

        def finished():
            return _chunk(ids, training, sizes, numbers, list(known), np.pad(counts, (0, len(known) - len(counts))))

        for batch in in_slices(batches):
            flags = batch.column("training").to_pylist()
            for key, text, trains in zip(batch.column("doc_id").to_pylist(), byte_texts(batch.column("text")), flags):
                words = text.lower().split()
                for word in words:
                    if word not in known:
                        known[word] = len(known)
                found = np.fromiter(map(known.__getitem__, words), np.int32, len(words))
                ids.append(key)
                training.append(trains)
                sizes.append(len(words))
                numbers.append(found)
                total += len(words) + 1
                if trains and len(words):
                    if len(known) > len(counts):
                        counts = np.pad(counts, (0, 2 * len(known) - len(counts)))
                    if len(words) > len(counts) // 8:
                        counts += np.bincount(found, minlength=len(counts))
                    else:
                        np.add.at(counts, found, 1)
                if total >= CHUNK_TOKENS or len(known) >= CHUNK_WORDS:
                    counts = counts[:len(known)]
                    yield finished()
                    known = {}
                    ids, training, sizes, numbers, counts, total = [], [], [], [], np.zeros(0, np.int64), 0
        if ids:
            counts = counts[:len(known)]
            yield finished()

    schema = ("ids array<bigint>, training array<boolean>, sizes array<bigint>, numbers binary, "
              "words array<binary>, counts array<bigint>")
    found = rows.select("doc_id", "text", "training").mapInArrow(numbered, schema)
    return materialise(found.withColumn("chunk", F.monotonically_increasing_id()), "chunks")


# ---- counts -----------------------------------------------------------------

@dataclass
class Counts:
    """What is known of the training texts besides the words' own counts."""

    tokens: int
    types: int
    texts: int
    frequent: dict[bytes, int]
    frequent_counts: list[int]
    shared: dict[int, tuple[int, int]]

    def class_counts(self) -> np.ndarray:
        """Training tokens per class; none for the begin of text."""
        counts = np.zeros(CLASSES)
        counts[:len(self.frequent_counts)] = self.frequent_counts
        for number, (tokens, _) in self.shared.items():
            counts[FREQUENT + number] = tokens
        counts[END] = self.texts
        return counts

    def classes(self, words: list[bytes]) -> np.ndarray:
        find, crc = self.frequent.get, zlib.crc32
        found = [FREQUENT + crc(w[-2:]) % SHARED if (n := find(w)) is None else n for w in words]
        return np.array(found, np.uint8)

    def within_class(self, classes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """log10 of a word's share of its class."""
        size = np.ones(CLASSES)
        for number, (tokens, types) in self.shared.items():
            size[FREQUENT + number] = tokens + types + 1
        return np.where(classes < FREQUENT, 0.0, np.log10((counts + 1) / size[classes]))


def counted_words(chunked: DataFrame) -> DataFrame:
    """(chunk, place, total, word): for each word of each chunk its number there and how
    often it is in all training texts; the word itself in one of its rows only.

    A word has a row per chunk, not per occurrence, and all meet in one shuffle.
    """
    entries = chunked.select("chunk", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "entry")).select(
        "chunk", "place", F.col("entry.words").alias("word"), F.col("entry.counts").alias("n"))
    same = Window.partitionBy("word").orderBy("chunk")
    whole = same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counted = entries.withColumns({"total": F.sum("n").over(whole), "_n": F.row_number().over(same)})
    return materialise(counted.select(
        "chunk", "place", "total", F.when(F.col("_n") == 1, F.col("word")).alias("word")), "word_counts")


def word_figures(counted: DataFrame, chunked: DataFrame) -> Counts:
    """The figures of the training words that all chunks need."""
    table = counted.filter(F.col("word").isNotNull() & (F.col("total") > 0)).select("word", F.col("total").alias("n"))
    top = table.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    frequent = {bytes(r["word"]): i for i, r in enumerate(top)}
    last = F.crc32(F.substring("word", -2, 2)) % SHARED
    rest = table.join(F.broadcast(table.sparkSession.createDataFrame(
        [(bytearray(w),) for w in frequent], "word binary")), "word", "left_anti")
    shared = {r["k"]: (r["n"], r["v"]) for r in rest.groupBy(last.alias("k")).agg(
        F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
    texts = chunked.select(F.sum(F.size(F.filter("training", lambda t: t)))).first()[0] or 0
    tokens = sum(r["n"] for r in top) + sum(n for n, _ in shared.values()) + texts
    types = len(top) + sum(v for _, v in shared.values()) + (1 if texts else 0)
    return Counts(tokens, types, texts, frequent, [r["n"] for r in top], shared)


def totals_by_chunk(counted: DataFrame) -> DataFrame:
    """(chunk, known): the training counts of a chunk's words, by their number."""
    placed = F.sort_array(F.collect_list(F.struct("place", "total")))
    return counted.groupBy("chunk").agg(placed["total"].alias("known"))


# ---- log-bilinear model -----------------------------------------------------

@dataclass
class Bilinear:
    """Class vectors as context and as target, one diagonal per context place, biases."""

    context: np.ndarray
    target: np.ndarray
    places: np.ndarray
    bias: np.ndarray

    @classmethod
    def begin(cls, class_counts: np.ndarray) -> "Bilinear":
        rng = np.random.default_rng(_SEED)
        small = rng.normal(0, 0.1, (2, CLASSES, WIDTH))
        bias = np.log((class_counts + 0.5) / (class_counts + 0.5).sum())
        return cls(small[0], small[1], np.ones((2, WIDTH)), bias)

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in (self.context, self.target, self.places, self.bias)])

    @classmethod
    def from_flat(cls, values: np.ndarray) -> "Bilinear":
        a, b, c = CLASSES * WIDTH, 2 * CLASSES * WIDTH, 2 * CLASSES * WIDTH + 2 * WIDTH
        return cls(values[:a].reshape(CLASSES, WIDTH).copy(), values[a:b].reshape(CLASSES, WIDTH).copy(),
                   values[b:c].reshape(2, WIDTH).copy(), values[c:].copy())

    def log_probabilities(self) -> np.ndarray:
        """Natural log of P(class | the two before), row before_last * CLASSES + last.

        One matrix product per class before last; the begin of text is no outcome.
        """
        table = np.empty((CLASSES * CLASSES, CLASSES), np.float32)
        for first in range(CLASSES):
            meant = self.context[first] * self.places[0] + self.context * self.places[1]
            scores = meant @ self.target.T + self.bias
            scores[:, BEGIN] = -np.inf
            scores -= scores.max(axis=1, keepdims=True)
            scores -= np.log(np.exp(scores).sum(axis=1, keepdims=True))
            table[first * CLASSES:(first + 1) * CLASSES] = scores
        return table


def _added(rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sum of `values` by row number, as a table of CLASSES rows."""
    return np.stack([np.bincount(rows, values[:, d], CLASSES) for d in range(values.shape[1])], axis=1)


class Trainer:
    """Noise-contrastive estimation with steps scaled by the gradients so far."""

    def __init__(self, model: Bilinear, noise: np.ndarray, seed: int):
        self.model, self.noise, self.rng = model, noise, np.random.default_rng([_SEED, seed])
        self.expected = np.log(NOISE * noise)
        self.past = Bilinear.from_flat(np.full_like(model.flat(), 1e-6))
        self.seen = 0

    def step(self, first: np.ndarray, last: np.ndarray, target: np.ndarray) -> None:
        """One batch: classes before last, last, and the class that followed."""
        model = self.model
        drawn = self.rng.choice(CLASSES, NOISE, p=self.noise)
        a, b, t = model.context[first], model.context[last], model.target[target]
        meant = a * model.places[0] + b * model.places[1]
        # The score is taken for a log probability; noise is told from data by its odds.
        odds = (meant * t).sum(axis=1) + model.bias[target] - self.expected[target]
        wrong = 1.0 / (1.0 + np.exp(np.clip(odds, -30, 30)))
        noisy = meant @ model.target[drawn].T + (model.bias[drawn] - self.expected[drawn])
        believed = 1.0 / (1.0 + np.exp(np.clip(-noisy, -30, 30)))
        push = wrong[:, None] * t - believed @ model.target[drawn]
        gradients = Bilinear(
            _added(first, push * model.places[0]) + _added(last, push * model.places[1]),
            _added(target, wrong[:, None] * meant),
            np.stack([(push * a).sum(axis=0), (push * b).sum(axis=0)]),
            np.bincount(target, wrong, CLASSES))
        np.add.at(gradients.target, drawn, -(believed.T @ meant))
        np.add.at(gradients.bias, drawn, -believed.sum(axis=0))
        for name in ("context", "target", "places", "bias"):
            gradient = getattr(gradients, name) / len(target)
            past = getattr(self.past, name)
            past += gradient * gradient
            getattr(model, name)[...] += RATE * gradient / np.sqrt(past)
        self.seen += len(target)

    def train(self, first, last, target) -> None:
        order = self.rng.permutation(len(target))
        for k in range(0, len(order), BATCH):
            some = order[k:k + BATCH]
            self.step(first[some], last[some], target[some])


def _tokens(classes: np.ndarray, words: np.ndarray, sizes: np.ndarray):
    """Of texts with `sizes` words: which tokens are words, where the texts start, and
    the classes of the two tokens before, and of the token."""
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    is_word = np.ones(len(words) + len(sizes), bool)
    is_word[starts + sizes] = False
    target = np.full(len(is_word), END, np.int32)
    target[is_word] = classes[words]
    last = np.r_[np.int32(BEGIN), target[:-1]]
    first = np.r_[np.int32(BEGIN), last[:-1]]
    last[starts] = BEGIN
    first[starts] = BEGIN
    first[starts[sizes > 0] + 1] = BEGIN
    return is_word, starts, first, last, target


def _rows_of(batches):
    """One chunk at a time, its lists as numpy arrays and its word numbers unpacked."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = {}
            for name in batch.schema.names:
                value = batch.column(name)[k]
                if name == "numbers":
                    plain = value.as_buffer()
                    row[name] = np.frombuffer(pa.decompress(plain, 4 * int(row["sizes"].sum()), "zstd"), "<i4")
                elif name == "classes":
                    row[name] = np.frombuffer(value.as_buffer(), np.uint8)
                elif name in ("ids", "words"):
                    row[name] = value.values
                elif name == "chunk":
                    row[name] = value.as_py()
                else:
                    row[name] = value.values.to_numpy(zero_copy_only=False)
            yield row


def train(chunked: DataFrame, counts: Counts) -> tuple[Bilinear, DataFrame]:
    """The average, by words seen, of the models that the tasks trained on their chunks;
    and (chunk, classes), the classes of each chunk's words, a byte each."""
    class_counts = counts.class_counts()
    begin = Bilinear.begin(class_counts)
    noise = (class_counts + 0.5) / (class_counts + 0.5).sum()
    names = ["chunk", "classes", "place", "value", "seen"]
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.float64(), pa.float64()]

    def trained(batches):
        trainer = Trainer(Bilinear.from_flat(begin.flat()), noise, 0)
        for row in _rows_of(batches):
            classes = counts.classes(row["words"].to_pylist())
            sizes, some = row["sizes"], np.repeat(row["training"].astype(bool), row["sizes"] + 1)
            _, _, first, last, target = _tokens(classes, row["numbers"], sizes)
            trainer.train(first[some], last[some], target[some])
            one = [[row["chunk"]], [classes.tobytes()], [None], [None], [None]]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(one, kinds)], names)
        if trainer.seen:
            values = trainer.model.flat()
            rest = [[None] * len(values), [None] * len(values), np.arange(len(values)), values * trainer.seen,
                    np.full(len(values), float(trainer.seen))]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rest, kinds)], names)

    written = materialise(chunked.select("chunk", "training", "sizes", "numbers", "words").mapInArrow(
        trained, "chunk bigint, classes binary, place bigint, value double, seen double"), "trained")
    # A row per parameter and task is added up before the driver reads one per parameter.
    parts = written.filter(F.col("place").isNotNull())
    added = parts.groupBy("place").agg((F.sum("value") / F.sum("seen")).alias("value")).toPandas()
    classes = written.filter(F.col("chunk").isNotNull()).select("chunk", "classes")
    if added.empty:
        return begin, classes
    values = np.empty(len(added))
    values[added["place"].to_numpy()] = added["value"].to_numpy()
    return Bilinear.from_flat(values), classes


# ---- scoring ----------------------------------------------------------------

def _stretches(sizes: np.ndarray):
    """(first, last) of texts scored together, about SCORED_TOKENS tokens or one text."""
    ends, first = np.cumsum(sizes + 1), 0
    while first < len(sizes):
        done = ends[first - 1] if first else 0
        last = max(int(np.searchsorted(ends, done + SCORED_TOKENS, side="right")), first + 1)
        yield first, last
        first = last


def scores(chunked: DataFrame, known: DataFrame, classes: DataFrame, counts: Counts, model: Bilinear) -> DataFrame:
    """(doc_id, training, n_tokens, n_known, train_tokens, base_score, score) per text."""
    every = np.log10(counts.tokens + counts.types + 1)
    end_base = np.log10(counts.texts + 1) - every
    names = ["doc_id", "training", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def scored(batches):
        table = None
        for row in _rows_of(batches):
            if table is None:
                table = model.log_probabilities()
            kinds, seen = row["classes"], row["known"]
            of_word = np.stack([np.log10(seen + 1) - every, counts.within_class(kinds, seen), seen > 0])
            words_before = np.r_[0, np.cumsum(row["sizes"])]
            for first_text, last_text in _stretches(row["sizes"]):
                sizes = row["sizes"][first_text:last_text]
                words = row["numbers"][words_before[first_text]:words_before[last_text]]
                is_word, starts, first, last, target = _tokens(kinds, words, sizes)
                found = np.empty((3, len(target)))
                found[:, ~is_word] = np.array([[end_base], [0.0], [counts.texts > 0]])
                found[:, is_word] = of_word[:, words]
                found[1] += table[first * CLASSES + last, target] / np.log(10)
                base, likely, hit = np.add.reduceat(found, starts, axis=1)
                yield pa.RecordBatch.from_arrays(
                    [row["ids"].slice(first_text, last_text - first_text),
                     pa.array(row["training"][first_text:last_text].astype(bool)), pa.array(sizes + 1),
                     pa.array(hit.astype(np.int64)), pa.array(np.full(len(sizes), counts.tokens, np.int64)),
                     pa.array(base), pa.array(likely)], names)

    rows = chunked.select("chunk", "ids", "training", "sizes", "numbers").join(classes, "chunk")
    # A chunk without any word has no counts.
    whole = rows.join(known, "chunk", "left").withColumn("known", F.coalesce("known", F.expr("CAST(array() AS array<bigint>)")))
    return whole.drop("chunk").mapInArrow(
        scored, "doc_id bigint, training boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
                "base_score double, score double")


def score_documents(docs: DataFrame, training, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Score every text of `docs`, learning from those for which the column `training` holds."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"),
                       (F.coalesce(training, F.lit(False)) & F.col(key).isNotNull()).alias("training"))
    chunked = chunks(rows)
    counted = counted_words(chunked)
    figures = word_figures(counted, chunked)
    model, classes = train(chunked, figures)
    return scores(chunked, totals_by_chunk(counted), classes, figures, model).withColumnRenamed("doc_id", key)
