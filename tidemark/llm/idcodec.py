"""Context-mixing range coder for token ids.

Ids are cut into blocks of BLOCK. Every block starts from the same model and carries its own CRC-32, so it can be decoded
alone with its group's header. The model mixes three predictions of the next id:

- order 0: how often each id comes in the group of blocks (kept in the group's header);
- order 1: the ids that follow the previous id there, and how often; pairs that would not earn their place are left out;
- order 2: the id that last followed the previous two ids in this block.

Each has a share of the range. Order 1 divides its own by its counts and order 2 adds all of its own to one id there, so that an
id has what both give it; order 0 has the rest, for ids that order 1 does not know. A context without followers has the counts
of order 0 in place of order 1's. The shares are learnt: every block counts how often order 2 comes true after each number of
hits in a row, and how often order 1 knows the id, for contexts of each kind; at fixed steps the shares follow the counts. The
interval drives a carry-propagating range coder with 24-bit digits.

Blocks do not depend on each other, so a worker codes a group of them side by side. The encoder knows all ids beforehand and
finds every interval by sorting contexts; its only loop over positions is the coder's. The decoder takes one numpy step for
the next id of every block; the tables of orders 0 and 1 are the same for all of them, so they stay in the cache.

Payload: magic, block size, ids and groups; for each group its counts, its tables (the ids it holds and about how often; the
pairs and about how often), the digits and CRC-32 of each block, then the digits. Groups are as large as LANES and TABLE allow,
so any number of different ids can be held.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np

BLOCK = 4096
#: Blocks coded side by side, and most different ids of a group.
LANES, TABLE = 1536, 1 << 17
MAGIC = b"TMK3"
_TOTAL_BITS, _SLOT_BITS, _DIGIT = 24, 12, 24
_TOTAL = 1 << _TOTAL_BITS
_STEPS = (0, *(64 << k for k in range(5)), *range(1536, BLOCK, 512))
#: A slot holds the entry predicted and a state: 0 for none yet, then one more than its hits in a row.
_STATES = 8
#: Shares (of 65536) with which states of order 2 start, and how many ids that is worth.
_TRUST, _TRUST_PRIOR = (0, 9000, 26000, 45000, 56000, 60000, 62000, 63000), 24
#: Kinds of contexts, by how many 64ths of their followers order 1 knows, their first shares and what those are worth.
_KINDS, _KNOWN, _KNOWN_PRIOR = (20, 32, 44, 52, 57, 60, 62), (14000, 27000, 39000, 49000, 56000, 60000, 62500, 64800), 48
#: Bits by which order 0 is dearer than its counts say, as it comes behind order 1; bits that a pair takes in the header.
_SPARES, _COSTS = 3, 16
_U = np.uint64
_ALL, _BIG = _U(2**64 - 1), _U(1 << 36)
#: Blocks whose pairs are sorted at once, and whose intervals are found at once (so that they stay in the cache).
_SORTED, _CHUNK = 128, 16


def _level(counts: np.ndarray) -> np.ndarray:
    """Counts as bytes: four steps for each doubling."""
    k = np.frexp(counts)[1].astype(np.int64) - 1
    return (4 * k + ((counts << 2) >> k) - 4).astype(np.uint8)


def _of_level(level: np.ndarray) -> np.ndarray:
    k, m = level.astype(np.int64) >> 2, level.astype(np.int64) & 3
    return ((4 + m) << k) >> 2


class _Tables:
    """Orders 0 and 1 of a group. An id is known by its place in the group's table.

    Row 0 is order 0, an entry for each place; every context with followers has a row of them. A row's entries share 1 << bits,
    and rows lie one behind the other in `start`, so one search finds an entry in any row. A context without followers uses row 0.
    """

    def __init__(self, weights: np.ndarray, context: np.ndarray, follower: np.ndarray, pair_weights: np.ndarray):
        width = len(weights)
        self.width, self.bits = width, min(max(width.bit_length() + 4, 14), 19)
        per = np.bincount(context, minlength=width)
        held = per > 0
        row = np.where(held, np.cumsum(held), 0)
        self.rows = int(held.sum()) + 1
        self.place = np.concatenate([np.arange(width), follower]).astype(np.int64)
        counts = np.concatenate([weights, pair_weights]).astype(np.int64)
        sizes = np.concatenate([[width], per[held]]).astype(np.int64)
        first = np.cumsum(sizes) - sizes
        sums = np.add.reduceat(counts, first) if width else np.zeros(1, np.int64)
        of = np.repeat(np.arange(self.rows), sizes)
        share = 1 + counts * ((1 << self.bits) - sizes[of]) // np.maximum(sums[of], 1)
        if width:
            share[first] += (1 << self.bits) - np.add.reduceat(share, first)
        self.start = np.zeros(len(share) + 1, np.int64)
        np.cumsum(share, out=self.start[1:])
        # where entries begin and end in their rows, and where the rows begin
        self.within = self.start[:-1] & ((1 << self.bits) - 1)
        self.until = self.within + share
        self.row = self.start[:-1] - self.within
        # what follows a place, and at the end what starts a block
        self.base = np.append(row << self.bits, 0)
        known = np.bincount(context, pair_weights, width).astype(np.int64) * 64 // np.maximum(weights, 1)
        self.kind = np.append(np.where(held, np.searchsorted(_KINDS, known, "right"), len(_KINDS)), len(_KINDS))

    def index(self) -> tuple[np.ndarray, int]:
        """For each bucket of a row the entry in which it starts, and by how many bits a bucket is found."""
        shift = self.bits - min(max(20 - self.rows.bit_length(), 2), 10)
        first = self.start + (1 << shift) - 1 >> shift
        return np.repeat(np.arange(len(first) - 1, dtype=np.int32), np.diff(first)), shift

    def shares(self, trust: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What orders 2 and 1 get of _TOTAL; orders 1 and 0 keep enough for each of their entries."""
        room = _TOTAL - (2 << self.bits)
        two = trust * room >> 16
        return two, ((room - two) * known >> 16) + (1 << self.bits)


def _trust(counts: np.ndarray) -> np.ndarray:
    """counts: by block, state, and whether order 2 came true. Returns its shares by block and state."""
    out = (np.array(_TRUST) * _TRUST_PRIOR + (counts[..., 1] << 16)) // (_TRUST_PRIOR + counts.sum(-1))
    out = np.clip(out, 300, 65000)
    out[..., 0] = 0
    return out


def _known(counts: np.ndarray) -> np.ndarray:
    """counts: by block, kind, and whether order 0 was needed. Returns order 1's shares by block and kind."""
    return (np.array(_KNOWN) * _KNOWN_PRIOR + (counts[..., 0] << 16)) // (_KNOWN_PRIOR + counts.sum(-1))


def _slots(last: np.ndarray, i: np.ndarray) -> np.ndarray:
    """Slot of the context that is place i after place last."""
    return (last * last.dtype.type(0x9E3779B1) + i * last.dtype.type(0x85EBCA6B) >> 7) & ((1 << _SLOT_BITS) - 1)


def _pairs(x: np.ndarray, width: int, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """x: places, block by position. Returns the contexts, followers and counts of the pairs that order 1 holds, in order, and
    for each position the number of its pair among them, or -1."""
    size = max(x.shape[1] - 1, 0)
    number, runs, run_counts = np.empty((len(x), size), np.int32), [], []
    for a in range(0, len(x), _SORTED):
        part = x[a : a + _SORTED].astype(np.int64)
        key = (part[:, :-1] * width + part[:, 1:]).ravel()
        key <<= 20
        key |= np.arange(key.size)
        key.sort()
        pair = key >> 20
        new = np.empty(len(pair), bool)
        new[:1] = True
        np.not_equal(pair[1:], pair[:-1], out=new[1:])
        local = np.empty(len(pair), np.int32)
        local[key & 0xFFFFF] = np.cumsum(new, dtype=np.int32) - 1
        number[a : a + _SORTED] = local.reshape(part.shape[0], size)
        runs.append(pair[new])
        run_counts.append(np.diff(np.append(np.flatnonzero(new), len(pair))))
    pairs, inverse = np.unique(np.concatenate(runs), return_inverse=True)
    counts = np.bincount(inverse, np.concatenate(run_counts), len(pairs)).astype(np.int64)
    context, follower = np.divmod(pairs, max(width, 1))
    # bits that a pair spares, against coding its follower in order 0
    spared = counts * (np.log2(counts * float(x.size) / (weights[context] * weights[follower].astype(float))) + _SPARES)
    keep = (counts >= 2) & (spared > _COSTS)
    kept = np.where(keep, np.cumsum(keep) - 1, -1).astype(np.int32)
    at = 0
    for k, own in enumerate(runs):
        a = k * _SORTED
        number[a : a + _SORTED] = kept[inverse[at : at + len(own)]][number[a : a + _SORTED]]
        at += len(own)
    return context[keep], follower[keep], counts[keep], number


def _second_order(x: np.ndarray, entry: np.ndarray, row: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """x: places, unsigned; entry: each one's entry; row, base: where its row and that of its context begin. Returns the entries
    that order 2 predicts and the states of their slots, 0 where there is none in the context's row."""
    lanes, width = x.shape
    last, now = np.zeros_like(x), np.zeros_like(x)
    last[:, 2:], now[:, 1:] = x[:, :-2], x[:, :-1]
    key = np.arange(lanes, dtype=np.uint32)[:, None] << 24 | np.arange(width, dtype=np.uint32)
    key |= _slots(last, now) << 12
    key = key.ravel()
    key.sort()
    at = (key >> 24) * np.uint32(width) + (key & 0xFFF)
    key >>= 12
    own, rows, bases = entry.ravel().take(at), row.ravel().take(at), base.ravel().take(at)
    seen = np.zeros_like(own)
    seen[1:] = own[:-1]
    same = np.zeros(len(at), bool)
    same[1:] = (key[1:] == key[:-1]) & (rows[:-1] == bases[1:])
    seen *= same
    hit = same & (own == seen)
    places = np.arange(len(at), dtype=np.int32)
    in_a_row = places - np.maximum.accumulate(places * ~hit)
    sorted_state = np.zeros(len(at), np.uint8)
    sorted_state[1:] = np.minimum(in_a_row[:-1], _STATES - 2)
    sorted_state += 1
    sorted_state *= same
    state, guess = np.empty(len(at), np.uint8), np.empty_like(own)
    state[at], guess[at] = sorted_state, seen
    return guess.reshape(x.shape), state.reshape(x.shape)


def _before(cell: np.ndarray, cells: int, lanes: int) -> np.ndarray:
    """cell: numbers of cells of blocks by sections. Returns how often each came in all sections before, by section and block."""
    sections = len(_STEPS)
    counts = np.bincount(cell.ravel(), minlength=sections * lanes * cells).reshape(sections, lanes, cells)
    out = np.zeros_like(counts)
    np.cumsum(counts[:-1], axis=0, out=out[1:])
    return out


def _intervals(x: np.ndarray, number: np.ndarray, tables: _Tables, start: np.ndarray, size: np.ndarray) -> None:
    """Fills start and size (position by block) of each place's interval."""
    lanes, width = x.shape
    before = np.full_like(x, tables.width)
    before[:, 1:] = x[:, :-1]
    kind, base = tables.kind.take(before), tables.base.take(before)
    unknown = np.ones(x.shape, bool)
    np.less(number, 0, out=unknown[:, 1:])
    zero = unknown & (base > 0)  # order 1 does not know it
    entry = x.copy()
    np.copyto(entry[:, 1:], number + np.int32(tables.width), where=~unknown[:, 1:])
    guess, state = _second_order(x.view(np.uint32), entry, np.where(zero, 0, base), base)
    right = (guess == entry) & (state > 0)
    section = np.searchsorted(_STEPS, np.arange(width), "right") - 1
    row = (section * lanes + np.arange(lanes)[:, None]) * _STATES
    k2, k1 = row + state, row + kind
    trust = _trust(_before(2 * k2 + right, 2 * _STATES, lanes).reshape(-1, _STATES, 2)).ravel()
    known = _known(_before(4 * k1 + zero + 2 * right, 4 * _STATES, lanes).reshape(-1, _STATES, 4)[..., :2]).ravel()
    two, one = tables.shares(trust.take(k2), known.take(k1))
    span = np.where(zero, _TOTAL - two - one, one)
    a, b = tables.within.take(entry), tables.until.take(entry)
    a *= span
    a >>= tables.bits
    b *= span
    b >>= tables.bits
    b -= a
    b += two * right
    behind = zero | (entry > guess)  # what order 2 adds comes before it
    a += two * behind
    a += one * zero
    start[:], size[:] = a.T, b.T


def _encode_lanes(x: np.ndarray, number: np.ndarray, tables: _Tables) -> list[bytes]:
    """x: places, block by position. Returns each block's digits, 24 bits each, the highest byte first."""
    lanes, width = x.shape
    digits, sizes = np.zeros((width + 1, lanes), np.uint32), np.zeros((width, lanes), np.uint32)
    for a in range(0, lanes, _CHUNK):
        own = slice(a, a + _CHUNK)
        _intervals(x[own], number[own], tables, digits[:width, own], sizes[:, own])
    low, rng = np.zeros(lanes, _U), np.full(lanes, 1 << 60, _U)
    moved = np.zeros((width + 1, lanes), bool)
    for t in range(width):
        rng >>= _U(_TOTAL_BITS)
        low += rng * digits[t]
        rng *= sizes[t]
        small = np.less(rng, _BIG, out=moved[t]).astype(_U)
        digits[t] = low >> _U(36)
        by = small * _U(_DIGIT)
        low &= _ALL >> (small * _U(28))
        low <<= by
        rng <<= by
    # one digit is enough for a number inside the last interval, as the interval is wider than what it leaves out
    digits[width], moved[width] = (low + (_BIG - _U(1))) >> _U(36), True
    out = []
    for k in range(lanes):
        code = digits[:, k][moved[:, k]].astype(np.int64)
        while (over := code >> _DIGIT).any():  # carries go to the digit before
            code &= (1 << _DIGIT) - 1
            code[:-1] += over[1:]
        out.append(code.astype(">u4").view(np.uint8).reshape(-1, 4)[:, 1:].tobytes())
    return out


def _decode_lanes(codes: list[bytes], width: int, tables: _Tables) -> np.ndarray:
    """The places of each block, block by position."""
    lanes = len(codes)
    room = max(map(len, codes)) // 3 + 4
    digits = np.zeros((lanes, room), np.uint32)
    for k, c in enumerate(codes):
        raw = np.frombuffer(c, np.uint8).reshape(-1, 3).astype(np.uint32)
        digits[k, : len(raw)] = (raw[:, 0] << 16) | (raw[:, 1] << 8) | raw[:, 2]
    # the code starts in the middle of the third digit, so what follows is cut anew
    fresh = np.zeros((lanes, room), _U)
    fresh[:, 2:-1] = (digits[:, 2:-1] & 0xFFF) << 12 | digits[:, 3:] >> 12
    fresh = fresh.ravel()
    code = digits[:, 0].astype(_U) << _U(36) | digits[:, 1].astype(_U) << _U(12) | digits[:, 2].astype(_U) >> _U(12)
    del digits
    rows = np.arange(lanes)
    at = rows * room + 2
    rng = np.full(lanes, 1 << 60, _U)
    bits, starts, ends, within, until, places = tables.bits, tables.start, tables.start[1:], tables.within, tables.until, tables.place
    buckets, shift = tables.index()
    slots, slot_at, of = np.zeros(lanes << _SLOT_BITS, np.int32), rows << _SLOT_BITS, rows * _STATES
    out = np.zeros((width, lanes), np.int32)
    count2, count1 = np.zeros(lanes * _STATES * 2, np.int64), np.zeros(lanes * _STATES * 4, np.int64)
    # what the positions since the last step met
    states, kinds = np.zeros((512, lanes), np.int64), np.zeros((512, lanes), np.int64)
    rights, zeros = np.zeros((512, lanes), bool), np.zeros((512, lanes), bool)
    least, whole, low_bits = 1 << bits, _TOTAL - (2 << bits), (1 << bits) - 1
    last = np.zeros(lanes, np.int64)
    base, kind, slot = last.copy(), np.full(lanes, len(_KINDS)), _slots(last, last)
    steps, since, most, digit = frozenset(_STEPS), 0, _U(_TOTAL - 1), _U(_DIGIT)
    for t in range(width):
        if t in steps:
            met = slice(t - since)
            count2 += np.bincount((2 * states[met] + rights[met]).ravel(), minlength=len(count2))
            count1 += np.bincount((4 * kinds[met] + zeros[met] + 2 * rights[met]).ravel(), minlength=len(count1))
            trust = _trust(count2.reshape(-1, _STATES, 2)).ravel() * whole >> 16
            known = _known(count1.reshape(-1, _STATES, 4)[..., :2]).ravel()
            since = t
        slot += slot_at
        state = slots.take(slot)
        guess = state >> 3
        state &= _STATES - 1
        state *= tables.row.take(guess) == base  # else another context's
        two = trust.take(np.add(of, state, out=states[t - since]))
        one = whole - two
        one *= known.take(np.add(of, kind, out=kinds[t - since]))
        one >>= 16
        one += least
        rng >>= _U(_TOTAL_BITS)
        target = np.minimum(code // rng, most).view(np.int64)
        guess_a = within.take(guess)
        guess_a *= one
        guess_a >>= bits
        guess_b = until.take(guess)
        guess_b *= one
        guess_b >>= bits
        guess_b += two
        behind = target >= guess_b
        right = np.greater(target >= guess_a, behind, out=rights[t - since])
        right &= state > 0
        added = two * behind
        target -= added
        zero = np.greater(target >= one, right, out=zeros[t - since])
        first = one * zero
        span = np.where(zero, _TOTAL - two, one)
        span -= first
        target -= first
        target <<= bits
        target |= low_bits
        target //= span
        np.minimum(target, low_bits, out=target)  # where order 2 is right
        np.copyto(base, 0, where=zero)
        target += base
        e = buckets.take(target >> shift)
        e += ends.take(e) <= target
        far = np.flatnonzero(ends.take(e) <= target)
        if far.size:
            e[far] = np.searchsorted(starts, target[far], "right") - 1
        np.copyto(e, guess, where=right)
        a = within.take(e)
        a *= span
        a >>= bits
        b = until.take(e)
        b *= span
        b >>= bits
        b -= a
        b += two * right
        a += first
        a += added
        i = places.take(e)
        code -= rng * a.view(_U)
        rng *= b.view(_U)
        small = (rng < _BIG).astype(_U)
        by = small * digit
        code <<= by
        rng <<= by
        by = fresh.take(at, mode="clip")
        by *= small
        code |= by
        at += small.view(np.int64)
        out[t] = i
        np.minimum(state, _STATES - 2, out=state)
        state *= right
        state += 1
        e <<= 3
        state += e
        slots[slot] = state
        slot = _slots(last, i)
        base, kind, last = tables.base.take(i), tables.kind.take(i), i
    return out.T


def _distinct(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different ids in order, each id's place among them, and how often they come."""
    if not ids.size or int(ids.max()) >= 1 << 22:
        return np.unique(ids, return_inverse=True, return_counts=True)
    counts = np.bincount(ids)
    table = np.flatnonzero(counts)
    place = np.zeros(len(counts), np.int32)
    place[table] = np.arange(len(table))
    return table.astype(np.uint32), place[ids], counts[table]


def _groups(ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, table of different ids, their counts, each id's place) of runs of whole blocks that fit LANES and TABLE."""
    runs = -(-len(ids) // (BLOCK * LANES))
    size = BLOCK * -(-len(ids) // (BLOCK * max(runs, 1)))  # about equal, as few blocks take a step as long as many
    todo = [ids[a : a + size] for a in range(0, len(ids), max(size, 1))][::-1]
    while todo:
        part = todo.pop()
        blocks = -(-len(part) // BLOCK)
        table, place, counts = _distinct(part)
        if blocks > 1 and len(table) > TABLE:
            half = blocks // 2 * BLOCK
            todo += [part[half:], part[:half]]
        else:
            order = np.lexsort((table, -_level(counts).astype(np.int64)))  # frequent ids first: their shares lie together
            rank = np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order))
            yield part, table[order], counts[order], rank[place]


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32, all first bytes before all second ones."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(raw: bytes, count: int, offset: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, 4 * count, offset).reshape(4, count).T).view("<u4").ravel().astype(np.int64)


def encode(ids: np.ndarray) -> bytes:
    """ids: unsigned, 32-bit at most. Returns one payload."""
    ids = np.asarray(ids, dtype=np.uint32)
    parts = []
    for part, table, counts, places in _groups(ids):
        blocks = -(-len(part) // BLOCK)
        width = min(BLOCK, len(part))
        x = np.zeros(blocks * width, np.int32)  # a short last block is filled up with the most frequent id, which costs little
        x[: len(part)] = places
        x = x.reshape(blocks, width)
        level = _level(counts)
        context, follower, pair_counts, number = _pairs(x, len(table), counts)
        pair_level = _level(pair_counts)
        new = np.diff(context, prepend=-1) != 0
        steps = np.where(new, follower, np.diff(follower, prepend=0))
        by_level = np.concatenate([np.diff(np.sort(table[level == k]), prepend=0) for k in np.unique(level)[::-1]]) if len(table) else table
        raw = level.tobytes() + _planes(by_level) + _planes(np.bincount(context, minlength=len(table))) + pair_level.tobytes() + _planes(steps)
        head = zlib.compress(raw)
        codes = _encode_lanes(x, number, _Tables(_of_level(level), context, follower, _of_level(pair_level)))
        raw = part.astype("<u4")
        crcs = [zlib.crc32(raw[b * BLOCK : (b + 1) * BLOCK]) for b in range(blocks)]
        index = np.array([[len(c) // 3, crc] for c, crc in zip(codes, crcs, strict=True)], "<u4").tobytes()
        body = head + index + b"".join(codes)
        parts.append(struct.pack("<IIII", len(part), len(table), len(head), len(body)) + body)
    return MAGIC + struct.pack("<IQI", BLOCK, ids.size, len(parts)) + b"".join(parts)


def _header(head: bytes, distinct: int) -> tuple[np.ndarray, _Tables]:
    """A group's ids and its tables."""
    raw = zlib.decompress(head)
    level, steps = np.frombuffer(raw, np.uint8, distinct), _from_planes(raw, distinct, distinct)
    table = np.empty(distinct, np.uint32)
    for k in np.unique(level):
        table[level == k] = np.cumsum(steps[level == k], dtype=np.uint32)
    per = _from_planes(raw, distinct, 5 * distinct)
    pairs = int(per.sum())
    pair_level, moves = np.frombuffer(raw, np.uint8, pairs, 9 * distinct), _from_planes(raw, pairs, 9 * distinct + pairs)
    context = np.repeat(np.arange(distinct), per)
    follower = np.cumsum(moves)
    first = (np.cumsum(per) - per)[context]
    follower -= follower[first] - moves[first]
    return table, _Tables(_of_level(level), context, follower, _of_level(pair_level))


def decode(payload: bytes, blocks: slice | None = None) -> np.ndarray:
    """The ids of a payload, or of a slice of its blocks; a block whose CRC-32 does not fit raises ValueError."""
    if payload[:4] != MAGIC:
        raise ValueError("not a token-id payload")
    block, size, groups = struct.unpack_from("<IQI", payload, 4)
    if block != BLOCK:
        raise ValueError(f"block size {block}")
    wanted = set(range(-(-size // BLOCK))[blocks or slice(None)])
    out, pos, done = [], 20, 0
    for _ in range(groups):
        n, distinct, head, body = struct.unpack_from("<IIII", payload, pos)
        pos += 16
        count = -(-n // BLOCK)
        own = [k for k in range(count) if done + k in wanted]
        if own:
            table, tables = _header(payload[pos : pos + head], distinct)
            index = np.frombuffer(payload, "<u4", 2 * count, pos + head).reshape(count, 2)
            ends = pos + head + 8 * count + 3 * np.cumsum(index[:, 0].astype(np.int64))
            codes = [payload[int(ends[k]) - 3 * int(index[k, 0]) : int(ends[k])] for k in own]
            for k, row in zip(own, _decode_lanes(codes, min(BLOCK, n), tables), strict=True):
                ids = table[row[: min(BLOCK, n - k * BLOCK)]]
                if zlib.crc32(ids.astype("<u4")) != int(index[k, 1]):
                    raise ValueError(f"block {done + k}: checksum does not fit")
                out.append(ids)
        pos, done = pos + body, done + count
    return np.concatenate(out) if out else np.zeros(0, np.uint32)
