"""An adaptive context-mixing range coder for token ids, run over many blocks side by side.

Every block is coded from a fresh model, so blocks are independent; step by step all blocks of a batch code their
next id together. Only whole-number and basic floating-point steps are used, one block's never depending on
another's, so a block decodes alike in whatever company it is read.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

#: Ids of a block, blocks coded side by side, and entries of each order's table.
BLOCK, LANES, ENTRIES = 2048, 4096, 512
#: Digits of 16 bits; a span of 48 bits is widened below BOTTOM; probabilities are shares of 2 ** SHARE.
DIGIT, TOP, BOTTOM, SHARE = 16, 1 << 48, 1 << 32, 15
HEAD = struct.Struct("<IIII")
MAX_ID = (1 << 16) - 1

#: Multipliers of the last id and the one before it in the places of contexts.
_NEAR, _FAR = 40503, 30011
#: Blocks that are looked through at once.
AHEAD = 128
#: Three cumulative probabilities of 16 bits each are held in one number, so that one step serves all three.
_PER_32 = 0x0000_07FF_07FF_07FF
_PER_8 = 0x0000_1FFF_1FFF_1FFF
_PER_2 = 0x0000_7FFF_7FFF_7FFF
_PER_2048 = 0x0000_001F_001F_001F
_START = 0x0000_C000_8000_4000
#: Least shares of the four outcomes, added to the sums cut to the rest, with the last one's bound in the sign's place.
_FLOOR = (8 | 16 << 16 | 24 << 32) - (1 << 63)
#: What keeps differences of bounds above 0, for the three and the last one, and for the bound before the first.
_MIDDLE, _BEFORE = 0x2000_2000_2000_2000, 0x2000
#: A one in each of the three, and their highest bits.
_ONES, _HIGHEST = 0x0000_0001_0001_0001, 0x0000_8000_8000_8000


class _Orders:
    """What the last two ids, the last id and the block so far say about the next one.

    Order 2 and order 1 each name the id that followed their context last, with how often it held in a row. Order 0
    keeps the last id of each of 256 slots. What is coded is which order is right first (0: order 2, 1: order 1,
    2: order 0, its slot follows; 3: none, the id follows). Both orders' tables stand one behind the other in one array.
    """

    def __init__(self, lanes: int):
        self.table = np.zeros(2 * lanes * ENTRIES, dtype=np.int32)
        self.recent = np.zeros(lanes * 256, dtype=np.uint16)
        self.lane, self.all = np.arange(lanes), lanes
        self.one, self.two = (np.zeros(lanes, dtype=np.int64) for _ in range(2))
        self._place()

    def _place(self) -> None:
        n = len(self.lane)
        self.slots = self.lane * 256
        self.entries = np.stack([self.lane, self.lane + self.all]) * ENTRIES
        self.mixed, self.named = np.empty((2, n), dtype=np.int64), np.empty((4, n), dtype=np.int32)

    def keep(self, lanes: int) -> None:
        """Only the first lanes go on."""
        self.lane, self.one, self.two = self.lane[:lanes], self.one[:lanes], self.two[:lanes]
        self._place()

    def look(self) -> tuple[np.ndarray, np.ndarray]:
        """The ids that order 2 and order 1 name, in the first two of four rows, and the orders' standing."""
        np.multiply(self.one, _NEAR, out=self.mixed[1])
        np.bitwise_xor(self.mixed[1], self.two, out=self.mixed[0])
        self.at = ((self.mixed >> 5 & ENTRIES - 1) + self.entries).ravel()
        kept = self.table.take(self.at).reshape(2, -1)
        np.bitwise_and(kept, 0xFFFF, out=self.named[:2])
        self.held = kept >> 16
        return self.named, ((self.held[0] << 2) + self.held[1] << 1) + (self.named[0] == self.named[1])

    def learn(self, ids: np.ndarray) -> None:
        kept = np.minimum(self.held, 2)
        kept *= self.named[:2] == ids
        kept += 1
        kept <<= 16
        kept |= ids
        self.table[self.at] = kept.ravel()
        self.two = self.one * _FAR
        self.one = ids.astype(np.int64)
        self.recent[self.slots + (self.one & 255)] = ids


def _foreseen(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The orders' standing before each id of the blocks, a row each, and which of them is right: as stepping through ``_Orders`` finds it."""
    rows = np.arange(len(ids))[:, None] * ids.shape[1]

    def latest(place):
        # ids of one place in their order: each is named by the one before it
        at = np.argsort(place, axis=1, kind="stable") + rows
        place, value = place.ravel().take(at), ids.ravel().take(at)
        known = np.zeros(ids.shape, dtype=bool)
        np.equal(place[:, 1:], place[:, :-1], out=known[:, 1:])
        again, named, held = np.zeros_like(known), np.zeros_like(value), np.zeros(ids.shape, dtype=np.uint8)
        named[:, 1:] = value[:, :-1] * known[:, 1:]
        again[:, 1:] = known[:, 1:] & (value[:, 1:] == value[:, :-1])
        held[:, 1:] = known[:, 1:] * (np.uint8(1) + again[:, :-1])
        held[:, 2:] += known[:, 2:] & again[:, 1:-1] & again[:, :-2]
        out = np.empty_like(value), np.empty_like(held)
        out[0].ravel()[at], out[1].ravel()[at] = named, held
        return out

    one, two = np.zeros(ids.shape, dtype=np.uint32), np.zeros(ids.shape, dtype=np.uint32)
    one[:, 1:], two[:, 2:] = ids[:, :-1], ids[:, :-2]
    one *= np.uint32(_NEAR)
    two *= np.uint32(_FAR)
    (second, often), (first, held) = (latest((x >> 5 & ENTRIES - 1).astype(np.uint16)) for x in (one ^ two, one))
    known, _ = latest((ids & 255).astype(np.uint8))
    outcome = np.where(ids == second, 0, np.where(ids == first, 1, 3 - (ids == known))).astype(np.uint8)
    return often * np.uint8(8) + held * np.uint8(2) + (second == first), outcome


class _Mixer:
    """Two adaptive predictions of the outcome, one from the orders' standing and one from the last two outcomes.

    They are mixed by weights that follow their success at every other id, and stand one behind the other in arrays that one step serves.
    """

    def __init__(self, lanes: int):
        self.shares = np.full(lanes * 48, _START, dtype=np.int64)
        self.lane, self.turn = np.arange(lanes), False
        self.weight, self.past = np.full(lanes, 4, dtype=np.int64), np.zeros(lanes, dtype=np.int64)
        self._place()

    def _place(self) -> None:
        self.rows = np.stack([self.lane * 48, self.lane * 48 + 32])
        self.row = np.empty_like(self.rows)

    def keep(self, lanes: int) -> None:
        """Only the first lanes go on."""
        self.lane, self.weight, self.past = self.lane[:lanes], self.weight[:lanes], self.past[:lanes]
        self._place()

    def predict(self, standing: np.ndarray) -> np.ndarray:
        """The upper bounds of the four outcomes."""
        np.add(self.rows[0], standing, out=self.row[0])
        np.add(self.rows[1], self.past, out=self.row[1])
        self.share = self.shares.take(self.row)
        a, b = self.share >> 3 & _PER_8
        self.apart = a - b
        sums = self.apart * self.weight + (b << 3)
        self.bounds = (sums >> 1 & _PER_2) - (sums >> 11 & _PER_2048) + _FLOOR
        return self.bounds

    def narrowed(self, span: np.ndarray, outcome: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the outcome's part of each span begins, and its size; takes in the outcome."""
        shift, unit = outcome << 4, span >> SHARE
        start = (self.bounds << 16) >> shift & 0xFFFF
        size = ((self.bounds >> shift & 0xFFFF) - start) * unit
        if self.turn:
            # lower less upper difference of the two predictions' bounds: above 0 where the second gave the outcome more
            apart = self.apart + _MIDDLE
            found = ((apart << 16 | _BEFORE) >> shift & 0xFFFF) - (apart >> shift & 0xFFFF)
            self.weight = np.minimum(np.maximum(self.weight - np.sign(found), 1), 7)
        self.turn = not self.turn
        # an outcome adds 1/32 of all probability to the sums that include it
        self.shares[self.row.ravel()] = (self.share - (self.share >> 5 & _PER_32) + (_PER_32 << shift & _PER_32)).ravel()
        self.past = (self.past << 2 | outcome) & 15
        return start * unit, size


def encode(blocks: list[np.ndarray]) -> list[bytes]:
    """Each block of ids as header (counts, checksum) and payload; ids must be below 2 ** 16."""
    out: list[bytes] = [b""] * len(blocks)
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    for i in range(0, len(order), LANES):
        part = order[i:i + LANES]
        for k, data in zip(part, _encode([blocks[k] for k in part])):
            out[k] = data
    return out


def _encode(blocks: list[np.ndarray]) -> list[bytes]:
    lanes, length = len(blocks), np.array([len(x) for x in blocks])
    steps = int(length.max()) if lanes else 0
    standing, outcomes = (np.zeros((steps, lanes), dtype=np.uint8) for _ in range(2))
    kinds = np.zeros((lanes, steps), dtype=np.uint8)
    for i in range(0, lanes, AHEAD):
        ids = np.zeros((min(AHEAD, lanes - i), length[i]), dtype=np.uint16)
        for row, x in zip(ids, blocks[i:]):
            row[:len(x)] = x
        found, kind = _foreseen(ids)
        kinds[i:i + AHEAD, :length[i]] = kind
        standing[:length[i], i:i + AHEAD], outcomes[:length[i], i:i + AHEAD] = found.T, kind.T
    mixer = _Mixer(lanes)
    # a digit may hold a carry for the one before it until all are there
    digits = np.zeros((steps + 2, lanes), dtype=np.int32)
    flat, width = digits.ravel(), lanes
    n = np.zeros(lanes, dtype=np.int64)
    low, span = np.zeros(lanes, dtype=np.int64), np.full(lanes, TOP - 1, dtype=np.int64)
    for t in range(steps):
        if length[-1] <= t:  # blocks that have ended leave; the longest stand first
            live = int(np.searchsorted(-length, -t))
            mixer.keep(live)
            _flush(digits, n, low, live, lanes)
            low, span, length, lanes = low[:live], span[:live], length[:live], live
        mixer.predict(standing[t, :lanes])
        start, span = mixer.narrowed(span, outcomes[t, :lanes].astype(np.int64))
        low = low + start
        at = np.flatnonzero(span < BOTTOM)
        if len(at):  # a share is never below 2 ** -12, so one digit is enough
            sure, count = low.take(at), n.take(at)
            flat[count * width + at] = sure >> 32
            low[at] = (sure & BOTTOM - 1) << DIGIT
            span[at] = span.take(at) << DIGIT
            n[at] = count + 1
    _flush(digits, n, low, 0, lanes)
    for k in range(len(digits) - 1, 0, -1):
        digits[k - 1] += digits[k] >> DIGIT
    digits = digits.T.astype("<u2")  # what was carried goes
    out = []
    for i, x in enumerate(blocks):
        kind = kinds[i, :len(x)]
        # the slot of each id that order 0 names, and each id that none does, one after the other
        rest = x.astype("<u2").view(np.uint8).reshape(-1, 2)[np.stack([kind > 1, kind == 3], axis=1)]
        body = digits[i, :n[i]].tobytes() + rest.tobytes()
        out.append(HEAD.pack(len(x), n[i], len(rest), zlib.crc32(body)) + body)
    return out


def _flush(digits: np.ndarray, n: np.ndarray, low: np.ndarray, begin: int, end: int) -> None:
    """Two digits that end a block: whatever follows them, the number stays inside the span."""
    own, last = np.arange(begin, end), low[begin:end] + BOTTOM // 2 ** DIGIT - 1
    digits[n[own], own] = last >> 32
    digits[n[own] + 1, own] = last >> DIGIT & 0xFFFF
    n[own] += 2


def split(data: bytes) -> list[tuple]:
    """(ids, digits, slots and ids that follow) of the blocks that stand one after the other; a wrong checksum is an error."""
    out, at = [], 0
    while at < len(data):
        count, n, rest, check = HEAD.unpack_from(data, at)
        at += HEAD.size
        end = at + 2 * n + rest
        if end > len(data) or zlib.crc32(data[at:end]) != check:
            raise ValueError(f"block at byte {at - HEAD.size} is damaged")
        out.append((count, np.frombuffer(data, "<u2", n, at), np.frombuffer(data, np.uint8, rest, at + 2 * n)))
        at = end
    return out


def decode(blocks: list[tuple]) -> list[np.ndarray]:
    """The ids of split blocks."""
    out: list[np.ndarray] = [np.empty(0, "<u2")] * len(blocks)
    order = sorted(range(len(blocks)), key=lambda i: -blocks[i][0])
    for i in range(0, len(order), LANES):
        part = order[i:i + LANES]
        for k, ids in zip(part, _decode([blocks[k] for k in part])):
            out[k] = ids
    return out


def _joined(arrays: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(x) for x in arrays])
    return np.concatenate([*arrays, np.zeros(4, dtype=arrays[0].dtype)]), np.cumsum(size) - size


def _decode(blocks: list[tuple]) -> list[np.ndarray]:
    lanes, length = len(blocks), np.array([x[0] for x in blocks])
    steps = int(length.max())
    ids = np.zeros((steps, lanes), dtype="<u2")
    orders, mixer = _Orders(lanes), _Mixer(lanes)
    (digits, d), (rest, r) = (_joined([x[k] for x in blocks]) for k in (1, 2))
    pairs = rest[:-1] | rest[1:].astype(np.uint16) << 8  # a byte and its successor
    span = np.full(lanes, TOP - 1, dtype=np.int64)
    digits = digits.astype(np.int64)
    code = digits[d] << 32 | digits[d + 1] << 16 | digits[d + 2]  # less the span's begin
    d = d + 3
    for t in range(steps):
        if length[-1] <= t:
            live = int(np.searchsorted(-length, -t))
            orders.keep(live)
            mixer.keep(live)
            span, code, length, d, r = (x[:live] for x in (span, code, length, d, r))
            lanes = live
        named, standing = orders.look()
        bounds = mixer.predict(standing)
        # 48 bits over 33 at most: as floating-point numbers, the quotient is cut to the same whole number
        share = (code / (span >> SHARE)).astype(np.int64)
        outcome = np.bitwise_count((share * _ONES + _HIGHEST) - bounds & _HIGHEST).astype(np.int64)
        named[3] = pair = pairs.take(r)
        named[2] = orders.recent.take(orders.slots + (pair & 255))
        now = named.ravel().take(outcome * lanes + orders.lane)
        r = r + (outcome * outcome >> 2)  # two bytes of an id, one of a slot
        ids[t, :lanes] = now
        start, span = mixer.narrowed(span, outcome)
        code = code - start
        at = np.flatnonzero(span < BOTTOM)
        if len(at):
            place = d.take(at)
            code[at] = code.take(at) << DIGIT | digits.take(place)
            span[at] = span.take(at) << DIGIT
            d[at] = place + 1
        orders.learn(now)
    ids = np.ascontiguousarray(ids.T)
    return [ids[i, :x[0]] for i, x in enumerate(blocks)]
