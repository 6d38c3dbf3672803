"""Token ids of whole texts by a public tokenizer, as little-endian uint32 bytes.

A text is cut at blanks that stand alone between two other characters. Both
tokenizers end a token there and look no further, so the pieces' ids, one after
the other, are the text's. Each worker keeps the ids of pieces it has met, up to
a bound, as most words of a corpus come back.
"""

import os
import re
import sys
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from fleetwright.llm.common import worker_cache

# Python's \s holds every character a tokenizer takes for white space.
_LONE_BLANK = re.compile(r"(?<=\S) (?=\S)")

# Pieces a worker remembers in each of two generations (about 200 bytes each), and
# the longest one kept.
REMEMBERED, LONGEST = 300_000, 64
# Marks that, behind a word, are one unit together. Not the apostrophe, which may begin one.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def _packed(ids: list[int]) -> bytes:
    values = array("I", ids)
    if sys.byteorder == "big":
        values.byteswap()
    return values.tobytes()


def _byte_letters() -> dict[int, str]:
    """The character that byte-level vocabularies write for each byte: itself where it
    is printable, else one from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {**{b: chr(b) for b in printable}, **{b: chr(256 + n) for n, b in enumerate(others)}}


_BYTE_LETTERS = _byte_letters()
_BLANK = _BYTE_LETTERS[ord(" ")]


class _WideSpace(Exception):
    """A piece is empty or has white space at its edge: a blank was not alone."""


class _Known(dict):
    """Ids by piece; what is missing is encoded and remembered."""

    def __init__(self, encoder: "Encoder", older: dict):
        super().__init__()
        self.encoder, self.older = encoder, older

    def __missing__(self, piece: str) -> bytes:
        # What comes back passes on from the older generation to the younger.
        ids = self.older.get(piece)
        if ids is None:
            ids = self.encoder.piece_ids(piece)
        # Two words around a line's end seldom come back together.
        if len(piece) <= LONGEST and "\n" not in piece:
            self[piece] = ids
        return ids


class Encoder:
    """Ids of texts. `blank_joins`: a blank belongs to the token behind it, and case
    counts; else blanks are dropped and letters lower-cased.

    A new piece of Latin letters, maybe with marks behind, is one unit of letters and
    one of marks, which go to the vocabulary's merges directly. A piece with a line's
    end inside is two pieces, the second without a blank in front. Other new pieces go
    through the whole tokenizer, and so does a text that holds the string of an added
    token, which is that one id, unless `plain_specials` makes it ordinary text.
    """

    def __init__(self, path: str, blank_joins: bool, plain_specials: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.specials = [] if plain_specials else [token.content for token in added]
        self.merge = self.tokenizer.model.tokenize
        self.joins, self.blank, self.front = blank_joins, *((" ", _BLANK) if blank_joins else ("", ""))
        self.known = _Known(self, {})
        self.bare: dict[str, bytes] = {}

    def _alone(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _letters(self, word: str, front: str) -> bytes:
        """The ids of a word of Latin letters; `front` is what the vocabulary writes before it."""
        if not self.joins:
            word = word.lower()
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(_BYTE_LETTERS)
        return _packed([t.id for t in self.merge(front + word)])

    def piece_ids(self, piece: str) -> bytes:
        """The ids of a piece that has a lone blank in front."""
        if piece.isalpha() and (piece.isascii() or max(piece) < "Ā"):
            return self._letters(piece, self.front)
        if not piece or piece[0].isspace() or piece[-1].isspace():
            raise _WideSpace
        if "\n" in piece:
            first, *rest = piece.split("\n")
            if any(not part or part[0].isspace() or part[-1].isspace() for part in (first, *rest)):
                return self._alone(self.blank + piece)
            end = self._bare("\n")
            return self.known[first] + b"".join([end + self._bare(part) for part in rest])
        core = piece.rstrip(_MARKS)
        if not core.isalpha() or not core.isascii() and max(core) >= "Ā":
            return self._alone(self.blank + piece)
        if len(core) < len(piece):
            # The word without marks comes by itself as well.
            return self.known[core] + self._bare(piece[len(core):])
        return self._letters(core, self.front)

    def _bare(self, part: str) -> bytes:
        """The ids of marks, a line's end, or a piece behind one: nothing in front."""
        ids = self.bare.get(part)
        if ids is None:
            plain = part.isalpha() and (part.isascii() or max(part) < "Ā")
            ids = self._letters(part, "") if plain else self._alone(part)
            if len(self.bare) > REMEMBERED:
                self.bare.clear()
            if len(part) <= LONGEST:
                self.bare[part] = ids
        return ids

    def encode(self, texts: list[str], behind_blank: bool = False) -> list[bytes]:
        """The ids of each text, four bytes each; `behind_blank`: of a blank and the text."""
        ids, front = [], " " if behind_blank else ""
        for text in texts:
            if len(self.known) > REMEMBERED:
                self.known = _Known(self, dict(self.known))
            if any(special in text for special in self.specials):
                ids.append(self._alone(front + text))
                continue
            head, *rest = text.split(" ")
            try:
                if head != head.strip() or not head and (rest or front):
                    raise _WideSpace
                # The first piece of a text has no blank before it but for that of `behind_blank`.
                first = self.known[head] if front else self._alone(head)
                ids.append(first + b"".join(map(self.known.__getitem__, rest)))
            except _WideSpace:
                ids.append(self._wide(front + text))
        return ids

    def token_bytes(self) -> list[bytes]:
        """The bytes that each id of a byte-level vocabulary stands for."""
        letters = {letter: byte for byte, letter in _BYTE_LETTERS.items()}
        added = {i: token.content.encode() for i, token in self.tokenizer.get_added_tokens_decoder().items()}
        names = sorted((i, name) for name, i in self.tokenizer.get_vocab(with_added_tokens=True).items())
        table = [b""] * (names[-1][0] + 1)
        for i, name in names:
            table[i] = added[i] if i in added else bytes(letters[c] for c in name)
        return table

    def _wide(self, text: str) -> bytes:
        """The ids of a text with white space of any kind and number."""
        head, *rest = _LONE_BLANK.split(text)
        if not rest:
            return self._alone(head)
        # Only the text's own end may be white space.
        return self._alone(head) + b"".join(map(self.known.__getitem__, rest[:-1])) + self._alone(self.blank + rest[-1])


# Units a column encoder remembers, and the bytes of their names; new units that go to
# the tokenizer together; marks behind a word that are a unit of their own.
UNITS, UNIT_BYTES = 1_000_000, 64 << 20
_TOGETHER = 200
_MOST_MARKS = 16
_BESIDE_BLANKS = {byte: letter for byte, letter in _BYTE_LETTERS.items() if byte != ord(" ")}


class ColumnEncoder:
    """Ids of columns of texts, by a vocabulary that drops white space and lower-cases.

    White space ends every token and leaves nothing behind, so a text's ids are those of
    its words. The distinct words of a column are encoded once: one of letters, maybe with
    marks behind, is one unit of letters and one of marks, another is a unit itself. Units
    met before are remembered, up to a bound. New ones of letters go to the tokenizer many
    at a time, where the vocabulary marks the token that ends a unit. A text that holds the
    string of an added token is encoded whole.
    """

    def __init__(self, path: str):
        self.whole = Encoder(path, blank_joins=False)
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = self.whole.tokenizer
        suffix, vocabulary = self.tokenizer.model.end_of_word_suffix, self.tokenizer.get_vocab()
        # For letters as the vocabulary writes them, which need no other preparation.
        self.prepared = Tokenizer(self.tokenizer.model)
        self.prepared.pre_tokenizer = WhitespaceSplit()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.ends[[i for name, i in vocabulary.items() if name.endswith(suffix)]] = True
        # The units known and the bytes of their ids.
        self.names, self.ids = pa.array([], pa.string()), pa.array([], pa.large_binary())

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, each with `end_id` behind, and how
        many each has. NULL is an empty text."""
        texts, special = pc.fill_null(texts, "").cast(pa.string()), np.zeros(len(texts), bool)
        for string in self.whole.specials:
            special |= pc.match_substring(texts, string).to_numpy(zero_copy_only=False)
        lists = pc.ascii_split_whitespace(pc.if_else(pa.array(special), "", texts) if special.any() else texts)
        words = lists.flatten().dictionary_encode()
        found = self._words(words.dictionary).take(words.indices)
        ids, until = _values(found)
        ends = until[np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), dtype=np.int64)])][1:]
        if special.any():
            parts = np.split(ids, ends[:-1])
            for row in np.flatnonzero(special).tolist():
                parts[row] = np.frombuffer(self.whole.encode([texts[row].as_py()])[0], "<u4")
            ids, ends = np.concatenate(parts), np.cumsum([len(part) for part in parts])
        return np.insert(ids, ends, end_id).astype(np.uint32, copy=False), np.diff(ends, prepend=0) + 1

    def _words(self, words: pa.Array) -> pa.LargeBinaryArray:
        """The bytes of the words' ids."""
        lower = pc.if_else(pc.string_is_ascii(words), pc.ascii_lower(words), words)
        letters = pc.ascii_rtrim(lower, characters=_MARKS)
        trimmed = pc.subtract(pc.binary_length(lower), pc.binary_length(letters))
        plain = pc.and_(pc.utf8_is_alpha(letters), pc.less_equal(trimmed, _MOST_MARKS))
        units = pc.if_else(plain, letters, lower).dictionary_encode()
        trimmed = np.where(plain.to_numpy(zero_copy_only=False), trimmed.to_numpy(), 0)
        # Behind the units come no marks, and the marks of each length.
        names, mark = [units.dictionary, pa.array([""])], np.full(len(words), len(units.dictionary))
        for length in range(1, _MOST_MARKS + 1):
            rows = np.flatnonzero(trimmed == length)
            if len(rows):
                marks = pc.utf8_slice_codeunits(lower.take(pa.array(rows)), start=-length, stop=None).dictionary_encode()
                mark[rows] = marks.indices.to_numpy() + sum(map(len, names))
                names.append(marks.dictionary)
        ids = self._units(pa.concat_arrays(names))
        return pc.binary_join_element_wise(
            ids.take(units.indices), ids.take(pa.array(mark)), pa.scalar(b"", pa.large_binary()))

    def _units(self, units: pa.Array) -> pa.LargeBinaryArray:
        """The bytes of the units' ids."""
        place = pc.index_in(units, value_set=self.names)
        if len(self.names) > UNITS or self.names.nbytes > UNIT_BYTES:
            # Only what has come again is kept.
            kept = place.drop_null().unique()
            place, self.names, self.ids = pc.index_in(place, value_set=kept, skip_nulls=True), self.names.take(kept), self.ids.take(kept)
        missing = place.is_null()
        place = place.to_numpy(zero_copy_only=False).astype(np.float64)
        rows = np.flatnonzero(missing.to_numpy(zero_copy_only=False))
        if len(rows):
            place[rows] = len(self.names) + np.arange(len(rows))
            new = units.take(pa.array(rows))
            self.names, self.ids = pa.concat_arrays([self.names, new]), pa.concat_arrays([self.ids, self._new(new)])
        return self.ids.take(pa.array(place.astype(np.int64)))

    def _new(self, units: pa.Array) -> pa.LargeBinaryArray:
        """The bytes of new units' ids."""
        alpha = pc.utf8_is_alpha(units).to_numpy(zero_copy_only=False)
        sizes, parts, order = [], [], []
        ascii_ = pc.string_is_ascii(units).to_numpy(zero_copy_only=False)
        for kind, together in (alpha & ascii_, True), (alpha & ~ascii_, True), (~alpha, False):
            rows = np.flatnonzero(kind)
            for start in range(0, len(rows), _TOGETHER):
                part = rows[start:start + _TOGETHER]
                ids, counts = self._encoded(units.take(pa.array(part)).to_pylist(), together)
                parts.append(ids)
                order.append(part)
                sizes.append(counts)
        until = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]) * 4
        encoded = pa.Array.from_buffers(
            pa.large_binary(), len(units), [None, pa.py_buffer(until.astype(np.int64)), pa.py_buffer(np.concatenate(parts).astype("<u4"))])
        return encoded.take(pa.array(np.argsort(np.concatenate(order))))

    def _encoded(self, units: list[str], together: bool) -> tuple[np.ndarray, np.ndarray]:
        if together:
            text, tokenizer = " ".join(units), self.tokenizer
            if self.ends.any() and max(text) < "Ā":
                text, tokenizer = text.lower().encode().decode("latin-1").translate(_BESIDE_BLANKS), self.prepared
            ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.ends.take(ids)) + 1
            # What is a letter here may be none to the tokenizer.
            if len(ends) == len(units) and ends[-1] == len(ids):
                return ids, np.diff(ends, prepend=0)
        each = [e.ids for e in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)]
        return np.array(sum(each, []), np.uint32), np.array(list(map(len, each)))


def _values(found: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """The ids whose bytes these are, and how many there are up to each value's begin and the last one's end."""
    _, offsets, data = found.buffers()
    until = np.frombuffer(offsets, np.int64, len(found) + 1, 8 * found.offset) // 4
    ids = np.frombuffer(data or b"", "<u4", int(until[-1] - until[0]), 4 * int(until[0]))
    return ids, until - until[0]


_MARK = "\u2581"  # how pieces write a blank


class PieceEncoder:
    """Ids by a piece model, which puts a blank before every text and keeps all else.

    Where no piece has a blank behind another character, as in models that merge within
    words, a lone blank always begins a token, and words are encoded by themselves.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.wordwise = not any(_MARK in piece.lstrip(_MARK) for piece in self.pieces)
        self.known = _Known(self, {})

    def piece_ids(self, piece: str) -> bytes:
        if not piece:
            raise _WideSpace
        return _packed(self.model.encode(piece))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, four bytes each."""
        ids = []
        for text in texts:
            if len(self.known) > REMEMBERED:
                self.known = _Known(self, dict(self.known))
            try:
                if not self.wordwise or _MARK in text:
                    raise _WideSpace
                ids.append(b"".join(map(self.known.__getitem__, text.split(" "))))
            except _WideSpace:
                ids.append(_packed(self.model.encode(text)))
        return ids

    def token_bytes(self) -> list[bytes]:
        """The bytes that each id stands for: its piece, marks as blanks, or its one byte."""
        return [
            bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace(_MARK, " ").encode()
            for i, piece in enumerate(self.pieces)
        ]


_ENCODERS: dict[tuple, Encoder | ColumnEncoder | PieceEncoder] = worker_cache()


def encoder(path: str, blank_joins: bool, plain_specials: bool = False) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    if (path, blank_joins, plain_specials) not in _ENCODERS:
        _ENCODERS[path, blank_joins, plain_specials] = Encoder(path, blank_joins, plain_specials)
    return _ENCODERS[path, blank_joins, plain_specials]


def column_encoder(path: str) -> ColumnEncoder:
    """The worker's encoder of columns for a vocabulary file."""
    if ("columns", path) not in _ENCODERS:
        _ENCODERS["columns", path] = ColumnEncoder(path)
    return _ENCODERS["columns", path]


def piece_encoder(path: str) -> PieceEncoder:
    """The worker's encoder for a piece model."""
    if (path,) not in _ENCODERS:
        _ENCODERS[path,] = PieceEncoder(path)
    return _ENCODERS[path,]


def vocabulary_path(name: str) -> str:
    """Where the vocabulary file `name` of the public tokenizers lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
