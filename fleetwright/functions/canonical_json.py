"""Byte-exact canonical JSON: sorted keys, no blanks, ASCII only.

Two writers make the same text. `typed_json` goes by a column's type, `variant_json` by
what a VARIANT holds, so that a document may have any fields, nested in any way. Keys are
sorted as text, so "10" comes before "2". All within one row: the text of a document is
bounded by the document.
"""

import json

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Text that needs no escape: printable ASCII without quote and backslash.
_PLAIN_CHAR = r"[ !#-\[\]-~]"
_PLAIN = rf"\A{_PLAIN_CHAR}*\z"

# The two-character escapes of JSON.
_SHORT_ESCAPES = [("\\", "\\\\"), ('"', '\\"'), ("\b", "\\b"), ("\f", "\\f"),
                  ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")]

# Levels of nesting that are written; Spark's expressions may not nest without end.
LEVELS = 12
# Stands for a value that cannot be written. No JSON text holds it, as it would be escaped.
_UNWRITABLE = "\0"

# Columns of a manifest record that are not part of the manifest, and the column that
# holds the canonical text of one that came as a document.
NOT_IN_MANIFEST = ("firmware_id", "signature_valid")
DOCUMENT_JSON = "manifest_json"


def _unit(code: Column) -> Column:
    return F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(code)), 4, "0"))


def _escaped(char: Column) -> Column:
    code = F.ascii(char)
    above = code - 0x10000
    pair = F.concat(
        _unit(F.lit(0xD800) + F.shiftright(above, 10)),
        _unit(F.lit(0xDC00) + above.bitwiseAND(F.lit(0x3FF))),
    )
    out = F.when(char.rlike(_PLAIN), char)
    for plain, short in _SHORT_ESCAPES:
        out = out.when(char == plain, F.lit(short))
    return out.when(code > 0xFFFF, pair).otherwise(_unit(code))


def json_string(text: Column) -> Column:
    """A JSON string literal; anything outside printable ASCII becomes \\uXXXX."""
    parts = F.regexp_extract_all(text, F.lit(f"(?s){_PLAIN_CHAR}+|."), F.lit(0))
    slow = F.array_join(F.transform(parts, _escaped), "")
    body = F.when(text.rlike(_PLAIN), text).otherwise(slow)
    return F.concat(F.lit('"'), body, F.lit('"'))


def json_float(number: Column) -> Column:
    """The shortest decimal that reads back as the same double, with a point or an exponent.

    Each step is made once and read from there, as text of a number is slow to make.
    """
    def shortest(longest: Column) -> Column:
        sixteen = F.format_string("%.15e", number)
        fifteen = F.format_string("%.14e", number)
        # Java's own text may have a digit more than needed; without it it may read back as well.
        cut = F.regexp_replace(longest, "[0-9]e", "e")
        return F.coalesce(*[
            _apart(text, lambda t: F.when(t.try_cast("double") == number, t)) for text in (fifteen, sixteen, cut)], longest)

    def parts(text: Column) -> Column:
        digits = F.regexp_replace(F.regexp_replace(F.regexp_extract(text, r"^-?([0-9.]+)e", 1), r"\.", ""), "0+$", "")
        return F.struct(digits.alias("digits"), F.regexp_extract(text, r"e([+-][0-9]+)$", 1).cast("int").alias("exponent"))

    sign = F.when(number < 0, "-").otherwise("")

    def written(at: Column) -> Column:
        digits, exponent = F.when(at["digits"] == "", "0").otherwise(at["digits"]), at["exponent"]
        count = F.length(digits)
        first, rest = F.substring(digits, 1, 1), F.substring(digits, F.lit(2), count)
        # lpad and rpad would cut longer texts, which these conditions rule out.
        whole = F.concat(F.rpad(digits, exponent + 1, "0"), F.lit(".0"))
        inside = F.concat(F.substring(digits, F.lit(1), exponent + 1), F.lit("."), F.substring(digits, exponent + 2, count))
        below = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)
        plain = F.when(exponent >= count - 1, whole).when(exponent >= 0, inside).otherwise(below)
        wide = F.lpad(F.abs(exponent).cast("string"), F.greatest(F.lit(2), F.length(F.abs(exponent).cast("string"))), F.lit("0"))
        scientific = F.concat(
            first, F.when(rest == "", "").otherwise(F.concat(F.lit("."), rest)), F.when(exponent < 0, "e-").otherwise("e+"), wide)
        return F.concat(sign, F.when(exponent.between(-4, 15), plain).otherwise(scientific))

    finite = _apart(_apart(_apart(F.format_string("%.16e", number), shortest), parts), written)
    return (
        F.when(F.isnan(number), "NaN").when(F.abs(number) == float("inf"), F.concat(sign, F.lit("Infinity")))
        .otherwise(finite)
    )


def _apart(value: Column, written) -> Column:
    """`written(value)` within a lambda, so that the value is made once and a long expression is not compiled."""
    return F.get(F.transform(F.array(value), written), F.lit(0))


def _by_key(a: Column, b: Column) -> Column:
    return F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)


# ---- by type ----------------------------------------------------------------

def _front(name: str) -> Column:
    return F.lit(json.dumps(name) + ":")


def _object(members: list[Column]) -> Column:
    return F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*members)), ","), F.lit("}"))


def typed_json(value: Column, kind: T.DataType) -> Column:
    """JSON of a column of any type; NULL for NULL.

    A NULL field of a struct is absent; a NULL in an array or map is `null`.
    """
    if isinstance(kind, T.StructType):
        members = [
            F.concat(_front(field.name), typed_json(value[field.name], field.dataType))
            for field in sorted(kind.fields, key=lambda f: f.name)]
        return F.when(value.isNotNull(), _object(members))
    if isinstance(kind, T.MapType):
        def member(entry: Column) -> Column:
            inner = F.coalesce(typed_json(entry["value"], kind.valueType), F.lit("null"))
            return F.concat(json_string(entry["key"].cast("string")), F.lit(":"), inner)

        entries = F.map_entries(value)
        # The plain sort needs values that have an order, but is much quicker.
        ordered = F.array_sort(entries, _by_key) if _holds_variant(kind) else F.sort_array(entries)
        return F.concat(F.lit("{"), F.array_join(F.transform(ordered, member), ","), F.lit("}"))
    if isinstance(kind, T.ArrayType):
        items = F.transform(value, lambda e: F.coalesce(typed_json(e, kind.elementType), F.lit("null")))
        return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))
    if isinstance(kind, T.VariantType):
        return variant_json(value)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return _apart(value.cast("double"), json_float)
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return value.cast("string")
    if isinstance(kind, T.DecimalType):
        return value.cast("string") if kind.scale == 0 else _apart(value.cast("double"), json_float)
    return json_string(value.cast("string"))


def _holds_variant(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_holds_variant(f.dataType) for f in kind.fields)
    if isinstance(kind, T.MapType):
        return True if isinstance(kind.valueType, T.MapType) else _holds_variant(kind.valueType)
    if isinstance(kind, T.ArrayType):
        return _holds_variant(kind.elementType)
    return isinstance(kind, T.VariantType)


# ---- by content -------------------------------------------------------------

def _scalar(value: Column) -> Column:
    """JSON of a variant that is neither object nor array."""
    kind = F.schema_of_variant(value)
    double = value.try_cast("double")
    # A decimal without places that fits a long was written with a point, as integers come as longs.
    whole = value.try_cast("decimal(38,0)")
    is_long = whole.between(F.lit(-(1 << 63)).cast("decimal(38,0)"), F.lit((1 << 63) - 1).cast("decimal(38,0)"))
    return (
        F.when(kind == "STRING", json_string(value.try_cast("string")))
        .when(kind == "BIGINT", value.try_cast("bigint").cast("string"))
        .when(kind == "BOOLEAN", value.try_cast("boolean").cast("string"))
        .when(kind == "VOID", "null")
        .when(kind.rlike(r"^DECIMAL\(\d+,\s*0\)$") & ~is_long, whole.cast("string"))
        .when(kind.rlike("^(DECIMAL|DOUBLE|FLOAT)"), _apart(double, json_float))
    )


def _token(mark: Column | str | None = None, key: Column | None = None, leaf: Column | None = None) -> Column:
    """A part of a JSON text: a mark as it is, then a key, then a value that is no container."""
    return F.struct(
        (F.lit(mark) if not isinstance(mark, Column) else mark).cast("string").alias("mark"),
        (F.lit(None) if key is None else key).cast("string").alias("key"),
        (F.lit(None).cast("variant") if leaf is None else leaf).alias("leaf"))


def _simple(levels: int) -> str:
    """Pattern of a JSON text without blanks of at most so many levels, in which no string needs an escape and
    no number has a point. Possessive, so it takes one pass and no stack."""
    scalar = pattern = rf'"{_PLAIN_CHAR}*+"|[a-z0-9-]++'
    for _ in range(levels):
        pattern = rf"{scalar}|[\[{{](?:[:,]|{pattern})*+[\]}}]"
    return rf"\A(?:{pattern})\z"


def _whole(value: Column, levels: int) -> Column:
    """Spark's own text of a variant, whose keys are sorted as well, where it is the canonical one; else NULL.

    Other numbers than integers are told by the type, as 1.0 comes out as 1; a type that stands for several may hide them.
    """
    other = F.schema_of_variant(value).rlike("DECIMAL|DOUBLE|FLOAT|VARIANT")
    return _apart(F.to_json(value), lambda t: F.when(t.rlike(_simple(levels)) & ~other, t))


def _tokens(value: Column, levels: int, inner: bool = False) -> Column:
    """The parts of a variant's text in order; an inner object or array that Spark writes alike is one part.
    Few expressions for each level, as there is one copy for each."""
    if levels < 0:
        return F.array(_token(_UNWRITABLE))

    def expanded(members: Column, items: Column) -> Column:
        plain = F.transform(items, lambda e: F.struct(F.lit(None).cast("string").alias("key"), e.alias("value")))
        entries = F.coalesce(F.array_sort(F.map_entries(members), _by_key), plain)
        within = F.flatten(F.transform(entries, lambda e, i: F.concat(
            F.array(_token(F.when(i > 0, ","), e["key"])), _tokens(e["value"], levels - 1, True))))
        open_, close = (F.when(members.isNotNull(), a).otherwise(b) for a, b in (("{", "["), ("}", "]")))
        return F.concat(F.array(_token(open_)), within, F.array(_token(close)))

    def parts(inside: Column) -> Column:
        members, items = inside["members"], inside["items"]
        text = expanded(members, items)
        if inner:
            text = _apart(_whole(value, levels), lambda t: F.when(t.isNotNull(), F.array(_token(t))).otherwise(text))
        return F.when(members.isNull() & items.isNull(), F.array(_token(leaf=value))).otherwise(text)

    return _apart(F.struct(
        value.try_cast("map<string,variant>").alias("members"), value.try_cast("array<variant>").alias("items")), parts)


def variant_json(value: Column, levels: int = LEVELS) -> Column:
    """JSON of whatever a VARIANT holds; NULL where it is nested deeper than `levels`.

    Integers of any size up to 38 digits are written as they are, other numbers as the
    shortest text of the double.
    """
    none = F.lit("")
    texts = F.transform(_tokens(value, levels), lambda t: F.concat(
        F.coalesce(t["mark"], none), F.coalesce(F.concat(json_string(t["key"]), F.lit(":")), none),
        F.when(t["leaf"].isNull(), none).otherwise(F.coalesce(_scalar(t["leaf"]), F.lit(_UNWRITABLE)))))
    # One pass over the tokens, whose text is then looked at twice.
    text = F.transform(F.array(F.array_join(texts, "")), lambda t: F.when(~t.contains(_UNWRITABLE), t))
    return F.when(value.isNotNull(), F.get(text, F.lit(0)))


def nesting(text: Column) -> Column:
    """How deep objects and arrays of a JSON text are nested."""
    outside = F.regexp_replace(text, r'"(?:[^"\\]|\\.)*+"', "")
    brackets = F.regexp_extract_all(outside, F.lit(r"[\[\]{}]"), F.lit(0))
    zero = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(at: Column, bracket: Column) -> Column:
        now = at["now"] + F.when(bracket.isin("{", "["), 1).otherwise(-1)
        return F.struct(now.alias("now"), F.greatest(at["most"], now).alias("most"))

    return F.aggregate(brackets, zero, step)["most"]


# ---- manifests --------------------------------------------------------------

def manifest_json(records: DataFrame) -> Column:
    """Canonical JSON of each manifest record: of all its fields, but the columns that are
    not part of it; absent (NULL) fields are left out. The canonical text of a manifest
    that came as a document is taken as it is."""
    if DOCUMENT_JSON in records.columns:
        return F.col(DOCUMENT_JSON)
    fields = [f for f in records.schema.fields if f.name not in NOT_IN_MANIFEST]
    members = [
        F.concat(_front(f.name), typed_json(F.col(f"`{f.name}`"), f.dataType))
        for f in sorted(fields, key=lambda f: f.name)]
    return _object(members)
