"""An adaptive context-mixing range coder for token ids, many blocks side by side.

Two ids are foretold: what followed the two ids before (order 2), and what followed the
one before (order 1). Whether the id is the first, and if not the second, are two binary
decisions. For each, three predictions are added in the logistic domain, with weights
that a mixer learns: how often the follower of order 2 came, how often that of order 1
did, and the share of the foretold id (order 0). An id that is neither is coded by the
shares of order 0. All that adapts is reset at the start of a block, and depends on
nothing but the block, so blocks can be read one by one. Shares are given to all blocks
from outside (`shares`); without them ids are equally likely.

Blocks are coded in lanes: a numpy operation does one step of each block's coder. The
arithmetic is in integers throughout, so every machine reads what another wrote.
"""

import numpy as np

# Lanes coded together, and followers each lane keeps per order.
LANES, SLOT_BITS = 4_096, 9
_MIX_RATE, _MOST_WEIGHT = 10, 1 << 18
# A weight moves by less than 1,300 a token, so it stays near its bound in between.
_BOUND_EVERY = 32
_START_WEIGHT = int(0.45 * 65_536)

# Shares sum to this many; more ids than the other have none.
SHARE_BITS, MOST_SHARES = 20, 1 << 18

# A follower's state is a probability of 8 bits and a count of 4: the more often it was
# adapted, the smaller its steps. State 0 is no follower; one that falls below the least
# probability makes room.
_STATE_BITS = 12
_NEW, _LEAST = 64 << 4, 40


def _after(hit: int) -> np.ndarray:
    """The state that follows each state when its id came, or did not."""
    chance, count = np.arange(1 << _STATE_BITS) >> 4, np.arange(1 << _STATE_BITS) & 15
    step = ((hit * 255 - chance) * (65_536 / (count + 1.6)).astype(np.int64)) >> 16
    chance = chance + step
    state = chance << 4 | np.minimum(count + 1, 15)
    return np.where((chance < _LEAST) | (np.arange(1 << _STATE_BITS) < 16), 0, state).astype(np.int32)


def _stretch(chance: np.ndarray) -> np.ndarray:
    """Log odds times 256 of probabilities between 0 and 1, the ends excluded."""
    return np.clip(np.rint(256 * np.log(chance / (1 - chance))), -2_047, 2_047).astype(np.int32)


# What is added to a state by hit and state, or that its follower makes room; log odds by state; 12-bit probability by log odds, which the bounds
# of weights and inputs keep within the table.
_GONE = 1 << _STATE_BITS
_NEXT = np.concatenate([_after(0), _after(1)])
_CHANGE = np.where(_NEXT == 0, _GONE, _NEXT - np.tile(np.arange(1 << _STATE_BITS), 2)).astype(np.int32)
_STRETCH = _stretch((np.arange(1 << _STATE_BITS) // 16 + 0.5) / 256)
_FAR = 1 << 15
_SQUASH = np.clip(np.rint(4_096 / (1 + np.exp(-np.clip(np.arange(-_FAR, _FAR) / 256, -20, 20)))), 1, 4_095).astype(np.int32)
# The second decision leaves at least this much of 4,096 to all other ids.
_MOST_SECOND = 4_032
_MULTIPLIERS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))


def shares(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids and their shares of 2**SHARE_BITS; none if they are too many."""
    if len(ids) and ids.max() < MOST_SHARES:
        counts = np.bincount(ids)
        values = np.flatnonzero(counts)
        counts = counts[values]
    else:
        values, counts = np.unique(ids, return_counts=True)
    if len(values) > MOST_SHARES:
        return np.empty(0, np.uint32), np.empty(0, np.uint32)
    share = 1 + counts.astype(np.int64) * ((1 << SHARE_BITS) - len(values)) // len(ids)
    share[np.argmax(share)] += (1 << SHARE_BITS) - share.sum()
    return values.astype(np.uint32), share.astype(np.uint32)


class _Alphabet:
    """The ids as symbols, with the log odds of their shares and their places in the interval."""

    def __init__(self, groups: int, known: tuple[np.ndarray, np.ndarray] | None):
        self.values, share = (np.empty(0, np.uint32), None) if known is None else known
        if len(self.values):
            self.share = share.astype(np.uint64)
            self.before = np.cumsum(self.share) - self.share
            kind = np.uint16 if len(self.values) <= 1 << 16 else np.uint32
            self.symbols = np.repeat(np.arange(len(self.values), dtype=kind), share.astype(np.int64))
            self.odds = _stretch((share + 0.5) / ((1 << SHARE_BITS) + 1.0))
            self.kind = np.int32
        else:
            # Equally likely ids have steps of 16 bits, as an interval has no room for more.
            self.steps = [(shift, min(16, 4 * groups - shift)) for shift in range(0, 4 * groups, 16)][::-1]
            self.kind = np.int64

    def __len__(self) -> int:
        return len(self.values)

    def of(self, ids: np.ndarray) -> np.ndarray:
        if not len(self):
            return ids.astype(self.kind)
        last = int(self.values[-1])
        if last >= 1 << 22:
            return np.searchsorted(self.values, ids).astype(self.kind)
        place = np.zeros(last + 1, self.kind)
        place[self.values] = np.arange(len(self))
        return place.take(ids)

    def odds_of(self, symbols: np.ndarray) -> np.ndarray | int:
        return self.odds.take(symbols) if len(self) else 0


class _Lanes:
    """The followers and mixers of some blocks."""

    def __init__(self, lanes: int, alphabet: _Alphabet):
        self.alphabet = alphabet
        # By order (2, then 1), slot and lane, as lanes often need the same slots: the
        # follower and its state. Not a power of two apart, which would share cache sets.
        self.width = lanes + 16
        self.table = np.zeros(2 * self.width << SLOT_BITS, alphabet.kind)
        self.origin = (np.arange(2)[:, None] * self.width << SLOT_BITS) + np.arange(lanes)
        # By decision, kind of input and lane.
        self.weights = np.full((2, 3, lanes), _START_WEIGHT, np.int32)
        self.context = np.zeros((2, lanes), np.uint32)
        # Written anew for every id.
        self.inputs, self.sums = np.empty((2, 3, lanes), np.int32), np.empty((2, 3, lanes), np.int32)

    def predict(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The foretold ids by decision and lane, and 12-bit probabilities that they come
        (0: none is foretold)."""
        a, b, c = _MULTIPLIERS
        mixed = np.empty((2, n), np.uint32)
        np.multiply(self.context[0, :n], a, out=mixed[1])
        np.multiply(self.context[1, :n] + np.uint32(1), b, out=mixed[0])
        mixed[0] ^= mixed[1]
        mixed ^= mixed >> np.uint32(15)
        mixed *= c
        mixed >>= np.uint32(32 - SLOT_BITS)
        place = mixed.astype(np.int64)
        place *= self.width
        place += self.origin[:, :n]
        self.place = place.ravel()
        self.held = self.table[self.place].reshape(2, n)
        held = self.held.astype(np.int64)
        self.state = held & ((1 << _STATE_BITS) - 1)
        held >>= _STATE_BITS
        odds = _STRETCH.take(self.state)
        self.asked = (self.state != 0).astype(np.int32)
        same = (held[0] == held[1]).astype(np.int32)
        inputs, sums = self.inputs[:, :, :n], self.sums[:, :, :n]
        inputs[:, 0] = odds
        # Where the orders differ, only one that is sure of itself speaks against the other.
        against = np.minimum(-odds[1], 0)
        inputs[0, 1] = against + same * (odds[1] - against)
        inputs[1, 1] = odds[0]
        inputs[:, 2] = self.alphabet.odds_of(held)
        # The second decision is about an id the first was not about.
        self.asked[1] -= self.asked[1] * same * self.asked[0]
        np.multiply(self.weights[:, :, :n], inputs, out=sums)
        mixed_odds = sums[:, 0] + sums[:, 1]
        mixed_odds += sums[:, 2]
        mixed_odds >>= 16
        mixed_odds += _FAR
        self.said = _SQUASH.take(mixed_odds)
        np.minimum(self.said[1], _MOST_SECOND, out=self.said[1])
        self.said *= self.asked
        return held, self.said.astype(np.uint64)

    def learn(self, n: int, symbol: np.ndarray, came: np.ndarray) -> None:
        """`came`: by order and lane, whether its follower was the id."""
        wrong = came.astype(np.int32)
        # What the first decision settled is not asked again.
        self.asked[1] -= self.asked[1] * wrong[0] * self.asked[0]
        wrong <<= 12
        wrong -= self.said
        wrong *= self.asked
        wrong *= _MIX_RATE
        inputs = self.inputs[:, :, :n]
        inputs *= wrong[:, None]
        inputs >>= 16
        self.weights[:, :, :n] += inputs
        place = came.astype(np.int64)
        place <<= _STATE_BITS
        place += self.state
        change = _CHANGE.take(place)
        new = (symbol << _STATE_BITS | _NEW).astype(self.held.dtype)
        self.table[self.place] = np.where(change == _GONE, new, self.held + change).ravel()
        self.context[1, :n] = self.context[0, :n]
        self.context[0, :n] = symbol

    def bound(self) -> None:
        np.clip(self.weights, -_MOST_WEIGHT, _MOST_WEIGHT, out=self.weights)


_TOP, _LEAST_RANGE = np.uint64(1 << 48), np.uint64(1 << 40)
_WORD, _LAST_WORD, _TWELVE = np.uint64(16), np.uint64(48), np.uint64(12)


class _Interval:
    """The coders' intervals: 64 bits wide, narrowed by decisions. Leading words of 16
    bits that are settled are shifted out after each id; an interval that gets narrow
    across such a word's edge loses what lies beyond the edge."""

    def __init__(self, lanes: int):
        self.low, self.range = np.zeros(lanes, np.uint64), np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64)

    def parts(self, n: int, said: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The widths of the first decision, the second and the rest."""
        first = self.range[:n] >> _TWELVE
        first *= said[0]
        rest = self.range[:n] - first
        second = rest >> _TWELVE
        second *= said[1]
        rest -= second
        return first, second, rest

    def narrow(self, n: int, parts, came: np.ndarray) -> np.ndarray:
        """`came`: 1 where a decision was yes. Returns 1 where both were no."""
        first, second, rest = parts
        not_first = np.uint64(1) - came[0]
        neither = not_first - came[1]
        self.low[:n] += first * not_first + second * neither
        self.range[:n] = first * came[0] + second * came[1] + rest * neither
        return neither

    def share(self, n: int, neither: np.ndarray, unit: np.ndarray, before: np.ndarray, share: np.ndarray) -> None:
        """Narrow to a share of `unit`s behind those before, where both decisions were no."""
        unit = unit * neither
        self.low[:n] += unit * before
        unit *= share
        # Other lanes keep their range.
        self.range[:n] *= np.uint64(1) - neither
        self.range[:n] += unit

    def shift(self, n: int):
        """Shift out settled words; yields the lanes of each shift, before it."""
        low, width = self.low[:n], self.range[:n]
        ready = np.flatnonzero(_settled(low, width))
        while ready.size:
            yield ready
            low, width = self.low.take(ready), self.range.take(ready)
            # The others are narrow across an edge.
            across = np.flatnonzero((low ^ low + width) >= _TOP)
            if across.size:
                width[across] = (~low[across] + np.uint64(1)) & (_TOP - np.uint64(1))
            low <<= _WORD
            width <<= _WORD
            self.low[ready], self.range[ready] = low, width
            ready = ready[_settled(low, width)]


def _settled(low: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Whether an interval's leading word is settled, or the interval too narrow."""
    edges = low + width
    edges ^= low
    return (edges < _TOP) | (width < _LEAST_RANGE)


def _lane_groups(sizes: np.ndarray):
    """(first, last) of the blocks coded together; longer blocks come first in a group."""
    for first in range(0, len(sizes), LANES):
        yield first, min(first + LANES, len(sizes))


def _active(sizes: np.ndarray, token: int) -> int:
    """How many of the lanes, longest first, still have a token `token`."""
    return len(sizes) if token < sizes[-1] else int(np.searchsorted(-sizes, -token, side="left"))


def encode(ids: np.ndarray, sizes: np.ndarray, groups: int, known: tuple | None = None) -> list[bytes]:
    """One payload per block: `sizes` ids each, one block after the other in `ids`;
    sizes do not grow. An id has at most 4 * groups bits. `known`: their `shares`."""
    alphabet = _Alphabet(groups, known)
    symbols = alphabet.of(ids)
    payloads: list[bytes] = []
    starts = np.cumsum(sizes) - sizes
    for first, last in _lane_groups(sizes):
        payloads += _encode_lanes(symbols, starts[first:last], sizes[first:last], alphabet)
    return payloads


def _encode_lanes(symbols, starts, sizes, alphabet):
    count, longest = len(sizes), int(sizes.max())
    lanes, interval = _Lanes(count, alphabet), _Interval(count)
    out, written = np.empty((longest + 64, count), np.uint16), np.zeros(count, np.int64)
    everyone, most = np.arange(count), 0
    # By token and lane; what lies behind a shorter block is not looked at.
    matrix, whole = np.zeros((longest, count), symbols.dtype), _active(sizes, longest - 1)
    matrix[:, :whole] = symbols[starts[0]:starts[0] + whole * longest].reshape(whole, longest).T
    for lane in range(whole, count):
        matrix[:sizes[lane], lane] = symbols[starts[lane]:starts[lane] + sizes[lane]]

    def shift(n):
        for ready in interval.shift(n):
            at = written.take(ready)
            out.ravel()[at * count + ready] = (interval.low.take(ready) >> _LAST_WORD).astype(np.uint16)
            written[ready] = at + 1

    for token in range(longest):
        n = _active(sizes, token)
        # An id settles fewer than 16 words.
        most += 16
        if most > len(out):
            most = int(written.max()) + 16
            if most > len(out):
                out = np.concatenate([out, np.empty_like(out)])
        symbol = matrix[token, :n].astype(np.int64)
        foretold, said = lanes.predict(n)
        came = foretold == symbol
        yes = came & lanes.asked.astype(bool)
        yes[1] &= ~yes[0]
        neither = interval.narrow(n, interval.parts(n, said), yes.astype(np.uint64))
        if len(alphabet):
            unit = interval.range[:n] >> np.uint64(SHARE_BITS)
            interval.share(n, neither, unit, alphabet.before.take(symbol), alphabet.share.take(symbol))
            shift(n)
        else:
            rest = np.flatnonzero(neither)
            shift(n)
            for begin, bits in alphabet.steps:
                unit = interval.range.take(rest) >> np.uint64(bits)
                interval.low[rest] += unit * (symbol.take(rest) >> begin & (1 << bits) - 1).astype(np.uint64)
                interval.range[rest] = unit
                shift(n)
        lanes.learn(n, symbol, came)
        if token % _BOUND_EVERY == 0:
            lanes.bound()
    # Two words that lie in the interval whatever is read behind them.
    out = np.concatenate([out, np.empty((2, count), np.uint16)])
    top = (interval.low + np.uint64((1 << 32) - 1)) >> np.uint64(32)
    out[written, everyone] = top >> _WORD
    out[written + 1, everyone] = top & np.uint64(0xFFFF)
    rows = np.ascontiguousarray(out[:int(written.max()) + 2].T).astype("<u2", copy=False)
    return [rows[lane, :length + 2].tobytes() for lane, length in enumerate(written.tolist())]


def decode(payloads: list[bytes], sizes: np.ndarray, groups: int, known: tuple | None = None) -> np.ndarray:
    """The ids of all blocks, one block after the other."""
    alphabet = _Alphabet(groups, known)
    ids, start = np.empty(int(sizes.sum()), np.uint32), 0
    for first, last in _lane_groups(sizes):
        matrix = _decode_lanes(payloads[first:last], sizes[first:last], alphabet)
        whole = _active(sizes[first:last], len(matrix) - 1)
        parts = [matrix[:, :whole].T.ravel()]
        parts += [matrix[:sizes[first + lane], lane] for lane in range(whole, last - first)]
        for part in parts:
            ids[start:start + len(part)] = alphabet.values.take(part) if len(alphabet) else part
            start += len(part)
    return ids


def _decode_lanes(payloads, sizes, alphabet):
    count, longest = len(sizes), int(sizes.max())
    lanes, interval = _Lanes(count, alphabet), _Interval(count)
    lengths = np.array([len(p) for p in payloads]) // 2
    data = np.frombuffer(b"".join(p[:len(p) & ~1] for p in payloads) + bytes(64), "<u2")
    read = np.cumsum(lengths) - lengths
    code = np.zeros(count, np.uint64)
    for _ in range(4):
        code = code << _WORD | data.take(read, mode="clip").astype(np.uint64)
        read += 1
    matrix = np.zeros((longest, count), alphabet.kind)

    def shift(n):
        for ready in interval.shift(n):
            at = read.take(ready)
            # A damaged block may ask for more words than there are.
            code[ready] = code.take(ready) << _WORD | data.take(at, mode="clip").astype(np.uint64)
            read[ready] = at + 1

    for token in range(longest):
        n = _active(sizes, token)
        foretold, said = lanes.predict(n)
        parts = interval.parts(n, said)
        offset = code[:n] - interval.low[:n]
        came = np.empty((2, n), np.uint64)
        came[0] = offset < parts[0]
        came[1] = offset < parts[0] + parts[1]
        came[1] -= came[0]
        neither = interval.narrow(n, parts, came)
        first, second, third = came[0].view(np.int64), came[1].view(np.int64), neither.view(np.int64)
        if len(alphabet):
            unit = interval.range[:n] >> np.uint64(SHARE_BITS)
            # Only lanes that coded a follower have less than a unit.
            coded = alphabet.symbols.take(
                ((code[:n] - interval.low[:n]) // np.maximum(unit, np.uint64(1))).view(np.int64), mode="clip").astype(np.int64)
            interval.share(n, neither, unit, alphabet.before.take(coded), alphabet.share.take(coded))
            shift(n)
        else:
            rest = np.flatnonzero(third)
            coded = np.zeros(n, np.int64)
            shift(n)
            for begin, bits in alphabet.steps:
                low = interval.low.take(rest)
                unit = interval.range.take(rest) >> np.uint64(bits)
                part = np.minimum((code.take(rest) - low) // unit, np.uint64((1 << bits) - 1))
                coded[rest] |= part.astype(np.int64) << begin
                interval.low[rest] = low + unit * part
                interval.range[rest] = unit
                shift(n)
        symbol = foretold[0] * first + foretold[1] * second + coded * third
        matrix[token, :n] = symbol
        lanes.learn(n, symbol, foretold == symbol)
        if token % _BOUND_EVERY == 0:
            lanes.bound()
    return matrix
