"""Quality rules as a short-circuit cascade, in DataFrame functions only.

A rule is a condition over the features of a document that rejects it. Cost and
selectivity of every rule are measured on a sample; the cascade asks the rule
with the most rejection per cost first, and a document that one rule rejects is
not shown to the next. The order changes the time, never the result.

Defined cases: a NULL or empty text has no words, and zero in every feature; a
NULL id is carried. Equal rows give equal rows. Other columns are not read, and
an empty table gives an empty result. A text of any length stays within its row.
"""

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from fleetwright.llm.common import SPACES, WORD, materialise

SYMBOLS = "#*$%&|<>"
WINDOW = 5
SAMPLE_ROWS = 1_000
_SEED = 11

FEATURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """`rejects` is SQL over the features named in `needs`."""

    name: str
    rejects: str
    needs: tuple[str, ...]


RULES = (
    Rule("few_words", "n_words < 10", ("n_words",)),
    Rule("repeated_words", "100 * n_repeat_words > 20 * n_words", ("n_words", "n_repeat_words")),
    Rule("symbols", "100 * n_symbols > 30 * n_words", ("n_words", "n_symbols")),
    Rule("repeated_lines", "100 * n_dup_lines > 30 * n_lines", ("n_lines", "n_dup_lines")),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 12 * n_words", ("n_words", "word_chars")),
)


def _zipped(array: str, size: Column, width: int) -> Column:
    """`width` neighbouring elements at a time: an array of structs with fields "0", "1", ..."""
    return F.arrays_zip(*[F.slice(array, i + 1, size).alias(f"x{i}") for i in range(width)])


def _room(array: str, width: int) -> Column:
    """How many windows of `width` elements an array has."""
    return F.greatest(F.size(array) - (width - 1), F.lit(0))


def features(docs: DataFrame, names=FEATURES, text: str = "text", carry=("doc_id",)) -> DataFrame:
    """The named features of every document, as bigint, after the carried columns.

    Repeated windows are found within the row: window hashes are sorted with
    their positions, equal neighbours are repeats, and the words they cover are
    the union of their spans. Each step is a projection of its own, because the
    optimizer keeps a column apart that a later step reads twice; a longer text
    costs its own length times its logarithm and nothing is exploded.
    """
    rows = docs.select(*[F.col(c) for c in carry], F.coalesce(F.col(text), F.lit("")).alias("_text"))
    wanted = list(carry)

    def add(**columns):
        nonlocal rows
        rows = rows.select(*wanted, *[c for c in ("_text", "_words", "_lines") if c in rows.columns and c not in columns],
                           *[value.alias(name) for name, value in columns.items()])

    if {"n_words", "word_chars", "n_repeat_words"} & set(names):
        add(_words=F.array_remove(F.split("_text", SPACES), ""))
    if {"n_lines", "n_dup_lines"} & set(names):
        add(_lines=F.filter(F.split("_text", "\n"), lambda line: line.rlike(WORD)))
    if "n_repeat_words" in names:
        add(_windows=_zipped("_words", _room("_words", WINDOW), WINDOW))
        hashed = F.transform("_windows", lambda w, i: F.struct(
            F.xxhash64(*[w[f"x{k}"] for k in range(WINDOW)]).alias("h"), i.alias("i")))
        add(_sorted=F.sort_array(hashed))
        pairs = F.filter(_zipped("_sorted", _room("_sorted", 2), 2), lambda p: p["x0"]["h"] == p["x1"]["h"])
        add(_pairs=F.transform(pairs, lambda p: F.struct(p["x0"]["i"].alias("a"), p["x1"]["i"].alias("b"))))
        add(_found=F.sort_array(F.array_distinct(F.concat("_pairs.a", "_pairs.b"))))
        steps = F.transform(_zipped("_found", _room("_found", 2), 2),
                            lambda p: F.least(p["x1"] - p["x0"], F.lit(WINDOW)))
        covered = F.aggregate(steps, F.lit(0), lambda total, step: total + step)
        add(n_repeat_words=(covered + F.when(F.size("_found") > 0, WINDOW).otherwise(0)).cast("long"))
        wanted.append("n_repeat_words")
    plain = {
        "n_words": lambda: F.size("_words"),
        "word_chars": lambda: F.length(F.array_join("_words", "")),
        "n_symbols": lambda: F.length("_text") - F.length(F.translate("_text", SYMBOLS, "")),
        "n_lines": lambda: F.size("_lines"),
        "n_dup_lines": lambda: F.size("_lines") - F.size(F.array_distinct("_lines")),
    }
    columns = {name: plain[name]().cast("long") for name in names if name in plain}
    return rows.select(*wanted, *[value.alias(name) for name, value in columns.items()]).select(*carry, *names)


def _seconds(df: DataFrame) -> float:
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def measured_order(docs: DataFrame, rules=RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejected share per second on about `sample_rows` rows, best first."""
    texts = docs.select(F.col(text).alias("text"))
    rows = max(texts.select(F.lit(1)).count(), 1)
    sample = materialise(texts.sample(fraction=min(1.0, sample_rows / rows), seed=_SEED), "rule_sample")
    tested = {rule: features(sample, rule.needs, carry=()).select(F.expr(rule.rejects).alias("r")) for rule in rules}
    ranked = []
    for rule, df in tested.items():
        share = df.select(F.avg(F.col("r").cast("int"))).first()[0] or 0.0
        cost = min(_seconds(df) for _ in range(2))
        ranked.append((share / max(cost, 1e-6), rule))
    return [rule for _, rule in sorted(ranked, key=lambda pair: (-pair[0], pair[1].name))]


def failed_rule(order: list[Rule]) -> Column:
    """Name of the first rule of `order` that rejects; NULL if none does.

    CASE asks its conditions in turn and stops at the first that holds.
    """
    found = F.lit(None).cast("string")
    for rule in reversed(order):
        found = F.when(F.expr(rule.rejects), rule.name).otherwise(found)
    return found


def cascade(docs: DataFrame, rules=RULES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: key, all features, the rule that rejected it, and `kept`.

    Whether a rule rejects is asked in the measured order; the name is that of the first one in
    the order of `rules`, the same in every run.
    """
    order = measured_order(docs, rules, text)
    rows = features(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")))
    rows = rows.withColumn("kept", failed_rule(order).isNull())
    named = F.when(~F.col("kept"), failed_rule(list(rules)))
    return rows.select("*", named.alias("failed_rule")).withColumnRenamed("doc_id", key)


def survivors(docs: DataFrame, rules=RULES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Keys of the kept documents, each feature computed only where the cascade gets to it.

    Every rule is a filter over its own features, in the measured order, so the
    costly ones see what the cheap ones left.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    for rule in measured_order(docs, rules, text):
        rows = (
            features(rows, rule.needs, carry=("doc_id", "text"))
            .filter(~F.coalesce(F.expr(rule.rejects), F.lit(False))).select("doc_id", "text")
        )
    return rows.select(F.col("doc_id").alias(key))
