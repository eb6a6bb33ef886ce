"""Log probabilities of texts from an online logistic mixture of hashed-context bit predictors.

A text is its bytes with A-Z lower-cased, and an end, read as pieces: words with the white space after them. A piece is a
few binary decisions. The bits of a prefix code say which of the frequent pieces it is, or that it is none of them;
then the bits of a prefix code for each preceding byte spell it. For every decision three predictors look
up, under a hash of the decision and of their own context, how often it went either way in the training texts:
for a piece without context, after the piece before, and after that piece's end; for a byte after the piece so far, and after
the last five and the last three of its bytes. A mixer adds their log odds with weights chosen by a gate, the predictors'
confidence, and a last table refines the outcome by what happened at such odds. Weights and that table are
learned online, block of decisions by block, from all training texts: each with the counts of that half of them to which it
does not belong (all rows of one id belong to one half). The texts are dealt into shards of some `SHARD` bytes, each of which is gone
through in one order, and what shards have learned is averaged, by how often each has seen a gate or a cell. While a text is scored, its own copy of the weights goes on learning from each block of it, so
that a text's score depends on this text and the model only.

Counts are of all training texts. Those without another piece in the context come from the table of distinct
pieces, which Spark aggregates; the others from one pass over the texts, in which tasks add up tables of bounded
size that meet, block by block, in two steps. What every task must know is bounded: one 16-bit number for each slot, the
weights, `MAX_PIECES` pieces and `MAX_KNOWN` words; what a text has of rarer words meets the counts in a join.

A null text is empty: its only token is the end. Documents that are not said to be learned from (null
included) are scored only. Rows that occur repeatedly count, and are scored, each. Very long texts are scored in
stretches of `STRETCH` bytes, and words of more than 48 bytes in several pieces; both change nothing
else. Texts are cut, numbered and coded as arrays, `PORTION` bytes at a time, and decisions are worked on some `TOGETHER` at a
time, which stay in the cache and change nothing either. Without training texts all tables are empty, and every decision is even. Ties between pieces of one count go to the first in
byte order. An empty table gives an empty result. Further columns pass through if `keep` names them.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meteorill.llm.jaccard_join import _mixed, _powers
from meteorill.llm.tables import stored, text_or_empty

END = 0xFF
PIECE_WORD = 48
PIECE = re.compile(rb"[^\t-\r ]{1,48}[\t-\r ]{0,16}|[\t-\r ]{1,16}")
SPACE = b"\t\n\x0b\x0c\r "
#: The end as a token: no word holds white space.
END_TOKEN = b" "
#: Frequent pieces with a code of their own.
MAX_PIECES = 1 << 15

#: Predictors, and bits of a slot number at most. The first one has no other piece in its context.
MAX_BITS = (20, 21, 18)
#: Slots that travel together, and portions of tasks whose sums meet first.
BLOCK_BITS, SALTS = 12, 16
#: Bytes of the texts that one mixer learns from in turn, before mixers are averaged; averages are of multiples of 1 / FINE.
SHARD, FINE = 1 << 23, 1 << 20
#: Frequent words that all tasks know; pieces, and pieces in their context, that a task holds before it counts them; bytes of a text scored at a time.
MAX_KNOWN, HELD, COUNTED, STRETCH = 1 << 18, 1 << 22, 1 << 20, 1 << 16
#: Bytes of texts that are cut into pieces together, and decisions that are worked on together, so that their arrays stay in the cache.
PORTION, TOGETHER = 1 << 20, 1 << 15
#: Bytes after which a text's weights move, and by how much; the same while fitting, in decisions.
BLOCK, RATE = 1024, 0.0004
FIT_BLOCK, FIT_RATE, REFINE_RATE = 4096, 0.0006, 0.02
PRIOR, UNIT = 0.3, 800.0
STEPS, ODDS = 33, 8.0
#: Context of a predictor without context.
NOTHING = np.uint32(0x1234567)
_FACTOR, _GOLDEN = np.uint32(0x85EBCA6B), np.uint32(0x9E3779B1)


def _codes(weights: list[float], first_node: int) -> list[list[int]]:
    """A prefix code: for each symbol its decisions, 2 * node + bit, from the root on; heavier ones have fewer."""
    size = len(weights)
    heap = [(w, s) for s, w in enumerate(weights)]
    heapq.heapify(heap)
    parent: dict[int, tuple[int, int]] = {}
    node = size
    while len(heap) > 1:
        (v, low), (w, high) = heapq.heappop(heap), heapq.heappop(heap)
        parent[low], parent[high] = (node, 0), (node, 1)
        heapq.heappush(heap, (v + w, node))
        node += 1
    codes = []
    for symbol in range(size):
        decisions, at = [], symbol
        while at in parent:
            at, bit = parent[at]
            decisions.append(2 * (first_node + at - size) + bit)
        codes.append(decisions[::-1])
    return codes


class Code:
    """Prefix codes: of pieces, the last symbol saying that a piece is spelled, and of bytes after each byte."""

    def __init__(self, pieces: list[bytes], counts: list[int], pairs: np.ndarray, spelled: int) -> None:
        self.numbers = {p: k for k, p in enumerate(pieces)}
        self.known = pa.array(pieces, pa.large_binary())
        # Contexts that these pieces are for the piece after them; the last place is for pieces without a number.
        with np.errstate(over="ignore"):
            own = _mixed(np.arange(len(pieces), dtype=np.uint64) + np.uint64(1 << 20))
        lengths = np.array([len(p) for p in pieces], dtype=np.int64)
        found = _after(own, _endings(np.frombuffer(b"".join(pieces), dtype=np.uint8), lengths.cumsum(), lengths))
        self.after = [np.append(x, np.uint32(0)) for x in found]
        usual = pairs.sum(axis=0) / max(pairs.sum(), 1)
        codes = [c for before in range(256) for c in _codes((pairs[before] + 4 * usual + 1 / 64).tolist(), 0)]
        codes += _codes([*counts, max(spelled, 1)], 256)
        self.lengths = np.array([len(c) for c in codes], dtype=np.int32)
        self.offsets = np.cumsum(self.lengths, dtype=np.int64) - self.lengths
        self.flat = np.array([d for c in codes for d in c], dtype=np.int32)


def pieces_of(text: bytes) -> list[bytes]:
    return PIECE.findall(text.lower() + b"\xff")


def cut(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all texts, where their pieces begin, and the end of the last, how many pieces each text has), as `pieces_of` cuts them."""
    whole = b"".join([x for t in texts for x in (t, b"\xff")]).lower()
    data = np.frombuffer(whole, dtype=np.uint8)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1
    begins = np.cumsum(lengths) - lengths
    space = data - np.uint8(9) < 5
    space |= data == 32
    first = np.ones(len(data) + 1, dtype=bool)
    np.greater(space[:-1], space[1:], out=first[1:-1])
    first[begins] = True
    starts = np.flatnonzero(first)
    # A word begins at each of them, or the white space before the first word. Few are so long that they have several pieces.
    sizes = np.diff(starts)
    some = np.flatnonzero(sizes > 16)
    several = space[starts[some + 1] - 17] | (sizes[some] > PIECE_WORD) & ~space[np.minimum(starts[some] + PIECE_WORD, len(data) - 1)]
    if several.any():
        more = [starts]
        for a, b in zip(starts[some[several]].tolist(), starts[some[several] + 1].tolist(), strict=True):
            more.append(a + np.cumsum([len(p) for p in PIECE.findall(whole[a:b])])[:-1])
        starts = np.sort(np.concatenate(more))
    return data, starts, np.diff(np.searchsorted(starts, np.append(begins, len(data))))


def _array(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(data)])


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all values, where each begins, and the end of the last)."""
    column = column.cast(pa.large_binary())
    _, starts, data = column.buffers()
    starts = np.frombuffer(starts, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data or b"", dtype=np.uint8)
    return data[starts[0] : starts[-1]], starts - starts[0]


def numbers_of(known: pa.Array, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The number of each piece, -1 if it has none."""
    return pc.index_in(_array(data, starts), value_set=known).fill_null(-1).to_numpy().astype(np.int64)


@dataclass
class Pieces:
    """Pieces of one text or of several: bytes, where each piece begins, and the end of the last, numbers."""

    data: np.ndarray
    starts: np.ndarray
    numbers: np.ndarray

    def part(self, begin: int, end: int) -> Pieces:
        first, last = self.starts[begin], self.starts[end]
        return Pieces(self.data[first:last], self.starts[begin : end + 1] - first, self.numbers[begin:end])

    def stretches(self) -> Iterator[tuple[Pieces, bool]]:
        """Parts of some STRETCH bytes, and whether it is the last one."""
        begin, n = 0, len(self.numbers)
        while begin < n:
            end = min(n, int(np.searchsorted(self.starts, self.starts[begin] + STRETCH)))
            yield self.part(begin, end), end == n
            begin = end


def together(texts: list[Pieces]) -> tuple[Pieces, np.ndarray]:
    """(pieces of all texts, how many each text has)."""
    counts = np.array([len(t.numbers) for t in texts])
    ends = np.cumsum([len(t.data) for t in texts])
    starts = np.concatenate([t.starts[:-1] + (end - len(t.data)) for t, end in zip(texts, ends.tolist(), strict=True)] + [ends[-1:]])
    return Pieces(np.concatenate([t.data for t in texts]), starts, np.concatenate([t.numbers for t in texts])), counts


def cut_texts(code: Code, texts: list[bytes]) -> tuple[Pieces, np.ndarray]:
    """(pieces of all texts, how many each text has)."""
    data, starts, counts = cut(texts)
    return Pieces(data, starts, numbers_of(code.known, data, starts)), counts


def apart(every: Pieces, counts: np.ndarray) -> list[Pieces]:
    ends = np.cumsum(counts)
    return [every.part(a, b) for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True)]


def portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, about PORTION bytes of texts at a time."""
    for batch in batches:
        if batch.num_rows:
            sizes = pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.flatnonzero(np.diff(np.cumsum(sizes) // PORTION, prepend=0))
            for a, b in zip([0, *at.tolist()], [*at.tolist(), batch.num_rows], strict=True):
                if a < b:
                    yield batch.slice(a, b - a)


def _high(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(32)).astype(np.uint32)


def _endings(data: np.ndarray, ends: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The last four bytes of each: of a word its last letters, and the white space after it."""
    last = ends - 1
    out = data[last].astype(np.uint64)
    for k in (1, 2, 3):
        out = out << np.uint64(8) | np.where(lengths > k, data[np.maximum(last - k, 0)], 0).astype(np.uint64)
    return out


def _after(own: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Contexts of what follows a piece: by its hash, and by its end."""
    with np.errstate(over="ignore"):
        return [_high(_mixed(own + np.uint64(11))), _high(_mixed(ends + np.uint64(5)))]


#: Contexts at the beginning of a text.
BEGIN = tuple(x[0] for x in _after(np.zeros(1, dtype=np.uint64), np.zeros(1, dtype=np.uint64)))


@dataclass
class Symbols:
    """What is coded: the code of each symbol, and its contexts' hashes; `sizes`: symbols of each piece."""

    codes: np.ndarray
    hashes: list[np.ndarray]
    sizes: np.ndarray
    last: tuple[np.uint32, np.uint32] = BEGIN


class Spelling:
    """Bytes of some pieces one after the other, and running sums of them."""

    def __init__(self, data: np.ndarray, lengths: np.ndarray) -> None:
        self.data, self.lengths, self.ends = data, lengths, np.cumsum(lengths)
        self.starts = self.ends - lengths
        self.place = np.arange(len(data)) - np.repeat(self.starts, lengths)
        up, _, table = _powers(17)
        with np.errstate(over="ignore"):
            self.running = np.zeros(len(data) + 1, dtype=np.uint64)
            np.cumsum(table.take(data) * up.take(self.place), out=self.running[1:])
            self.begun = self.running[self.starts]

    def hashes(self) -> np.ndarray:
        """Of whole pieces."""
        with np.errstate(over="ignore"):
            return _mixed(self.running[self.ends] - self.begun + np.uint64(7))

    def coded(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """Codes and contexts of the bytes."""
        data, place = self.data, self.place.astype(np.uint8)
        last = []
        for k in range(1, 6):
            x = np.zeros(len(data), dtype=np.uint8)
            x[k:] = data[:-k]
            x *= place >= k
            last.append(x.astype(np.uint32))
        with np.errstate(over="ignore"):
            word = _high(_mixed(self.running[:-1] - np.repeat(self.begun, self.lengths) + np.uint64(1)))
            three = (last[0] | last[1] << np.uint32(8) | last[2] << np.uint32(16)) * _GOLDEN + np.uint32(1)
            five = (three ^ (last[3] | last[4] << np.uint32(8)) * np.uint32(0xC2B2AE35)) * np.uint32(0x27D4EB2F)
        codes = last[0].astype(np.int64)
        codes[self.starts] = END
        codes <<= 8
        codes += data
        return codes, [word, five ^ five >> np.uint32(15), three ^ three >> np.uint32(15)]


def spelling_of(data: np.ndarray, starts: np.ndarray, some: np.ndarray) -> Spelling:
    """Of the pieces at these places."""
    lengths = starts[some + 1] - starts[some]
    stops = np.cumsum(lengths)
    return Spelling(data.take(np.repeat(starts[some] - stops + lengths, lengths) + np.arange(lengths.sum())), lengths)


def symbols(code: Code, pieces: list[bytes], spell: bool = True) -> Symbols:
    """All symbols of a text's pieces."""
    data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    starts = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)
    return symbols_of(code, Pieces(data, starts, numbers_of(code.known, data, starts)), spell=spell)


def symbols_of(code: Code, pieces: Pieces, begins: np.ndarray | None = None, before: tuple[np.uint32, np.uint32] = BEGIN, spell: bool = True) -> Symbols:
    """All symbols of pieces in their order, without bytes if not `spell`. `begins` are the places at which texts begin; `before` are the
    contexts that the piece before the first makes.
    """
    numbers, n = pieces.numbers, len(pieces.numbers)
    unknown = np.flatnonzero(numbers < 0)
    after = [x.take(numbers, mode="wrap") for x in code.after]
    if len(unknown):
        spelling = spelling_of(pieces.data, pieces.starts, unknown)
        lengths = spelling.lengths
        for x, found in zip(after, _after(spelling.hashes(), _endings(spelling.data, spelling.ends, lengths)), strict=True):
            x[unknown] = found
    contexts = [np.full(n, NOTHING)]
    for x, b, outset in zip(after, before, BEGIN, strict=True):
        context = np.empty(n, dtype=np.uint32)
        context[0], context[1:] = b, x[:-1]
        if begins is not None:
            context[begins] = outset
        contexts.append(context)
    last = (after[0][-1], after[1][-1])
    codes = 65536 + np.where(numbers < 0, len(code.numbers), numbers)
    sizes = np.ones(n, dtype=np.int64)
    if not len(unknown) or not spell:
        return Symbols(codes, contexts, sizes, last)
    sizes[unknown] += lengths
    stops = np.cumsum(sizes)
    at = stops - sizes
    of_bytes = np.repeat(at[unknown] + 1 - spelling.starts, lengths) + np.arange(len(spelling.data))
    spelled, hashes = spelling.coded()

    def merged(of_pieces: np.ndarray, bytes_: np.ndarray) -> np.ndarray:
        out = np.empty(stops[-1], dtype=of_pieces.dtype)
        out[at] = of_pieces
        out[of_bytes] = bytes_
        return out

    return Symbols(merged(codes, spelled), [merged(a, b) for a, b in zip(contexts, hashes, strict=True)], sizes, last)


def decisions(code: Code, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(decisions, how many each symbol has)."""
    lengths = code.lengths.take(codes)
    return _decided(code, code.offsets.take(codes), lengths), lengths


def _decided(code: Code, offsets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    ends = np.cumsum(lengths, dtype=np.int64)
    at = np.repeat(offsets - (ends - lengths), lengths)
    at += np.arange(len(at))
    return code.flat.take(at)


def _node_hash(chosen: np.ndarray) -> np.ndarray:
    mixed = (chosen >> 1).view(np.uint32)
    with np.errstate(over="ignore"):
        mixed += np.uint32(1)
        mixed *= _GOLDEN
    mixed ^= mixed >> np.uint32(16)
    return mixed


def slots(hashes: np.ndarray, lengths: np.ndarray, node_hash: np.ndarray, bits: int) -> np.ndarray:
    at = np.repeat(hashes, lengths)
    at ^= node_hash
    return _slots(at, bits)


def _slots(at: np.ndarray, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        at *= _FACTOR
    at >>= np.uint32(32 - bits)
    return at.astype(np.int64)


def slot_bits(n_bytes: int) -> tuple[int, ...]:
    """Tables grow with the text up to a bound."""
    size = max(BLOCK_BITS, max(1, n_bytes).bit_length() - 3)
    return tuple(min(most, size) for most in MAX_BITS)


def _some(ends: np.ndarray) -> Iterator[slice]:
    """Symbols, by the ends of their decisions, some TOGETHER decisions at a time."""
    begin = 0
    while begin < len(ends):
        end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + TOGETHER, "right")))
        yield slice(begin, end)
        begin = end


class Counts:
    """How often each slot's decision went either way, for some of the predictors."""

    def __init__(self, bits: tuple[int, ...], which: tuple[int, ...]) -> None:
        self.bits, self.tables = bits, {k: np.zeros(2 << bits[k], dtype=np.int64) for k in which}

    def add(self, code: Code, codes: np.ndarray, hashes: dict[int, np.ndarray], weights: np.ndarray | None = None) -> None:
        """`hashes` of the predictors that count these symbols; `weights`: how often each symbol counts."""
        every = code.lengths.take(codes)
        for some in _some(np.cumsum(every, dtype=np.int64)):
            lengths = every[some]
            chosen = _decided(code, code.offsets.take(codes[some]), lengths)
            node_hash, bit = _node_hash(chosen), chosen & 1
            times = 1 if weights is None else np.repeat(weights[some], lengths)
            for k, context in hashes.items():
                at = slots(context[some], lengths, node_hash, self.bits[k])
                at += at
                at += bit
                np.add.at(self.tables[k], at, times)

    def blocks(self, held: bool) -> pa.RecordBatch:
        names, data = [], []
        for k, table in self.tables.items():
            whole = table.reshape(-1, 2 << BLOCK_BITS)
            for b in np.flatnonzero(whole.any(axis=1)).tolist():
                names.append(k << 24 | b)
                data.append(pa.compress(whole[b].tobytes(), codec="zstd", asbytes=True))
        return pa.RecordBatch.from_pydict({"block": pa.array(names, pa.int32()), "held": pa.array([held] * len(names), pa.bool_()), "counts": pa.array(data, pa.binary())})


def quantised(counts: np.ndarray) -> np.ndarray:
    """Log odds in 14 bits and confidence in 2 of each slot, from its two counts."""
    zero, one = counts[0::2].astype(np.float64), counts[1::2].astype(np.float64)
    odds = np.clip(np.log((one + PRIOR) / (zero + PRIOR)), -10, 10)
    sure = np.digitize(zero + one, [1, 3, 16])
    return (np.rint(odds * UNIT).astype(np.int16) << 2 | sure.astype(np.int16)).astype(np.int16)


@dataclass
class Model:
    """What all tasks know: the codes, a table for each predictor, the mixer's weights and the refinement."""

    code: Code
    bits: tuple[int, ...]
    tables: list[np.ndarray]
    weights: np.ndarray = field(default_factory=lambda: np.full((len(MAX_BITS) + 1, 4 ** len(MAX_BITS)), 0.4, dtype=np.float32))
    refined: np.ndarray = field(default_factory=lambda: np.tile(1 / (1 + np.exp(-np.linspace(-ODDS, ODDS, STEPS))), 256).astype(np.float32))


@dataclass
class Inputs:
    """The mixer's inputs for the decisions of some symbols."""

    odds: list[np.ndarray]
    gate: np.ndarray
    node: np.ndarray
    bit: np.ndarray
    lengths: np.ndarray


def inputs(model: Model, codes: np.ndarray, hashes: list[np.ndarray]) -> Inputs:
    return _inputs(model, model.code.offsets.take(codes), model.code.lengths.take(codes), hashes)


def _inputs(model: Model, offsets: np.ndarray, lengths: np.ndarray, hashes: list[np.ndarray]) -> Inputs:
    """Of symbols by where their decisions begin, and how many they are."""
    packed = np.empty((len(lengths), 1 + len(hashes)), dtype=np.uint32)
    with np.errstate(over="ignore"):
        packed[:, 0] = offsets - (np.cumsum(lengths, dtype=np.int64) - lengths)
        for k, context in enumerate(hashes, 1):
            packed[:, k] = context
        # One row for each decision, from one pass.
        packed = np.repeat(packed, lengths, axis=0)
        chosen = model.code.flat.take(packed[:, 0] + np.arange(len(packed), dtype=np.uint32))
    node_hash = _node_hash(chosen)
    odds, gate = [], np.zeros(len(chosen), dtype=np.int16)
    for context, bits, table in zip(packed.T[1:], model.bits, model.tables, strict=True):
        found = table.take(_slots(context ^ node_hash, bits), mode="wrap")
        gate <<= 2
        gate |= found & 3
        found >>= 2
        own = found.astype(np.float32)
        own *= np.float32(1 / UNIT)
        odds.append(own)
    bit = (chosen & 1).astype(np.float32)
    chosen >>= 1
    chosen &= 255
    return Inputs(odds, gate.astype(np.int64), chosen, bit, lengths)


def mixed(weights: list[np.ndarray], at: np.ndarray, odds: list[np.ndarray]) -> np.ndarray:
    total = weights[-1].take(at)
    for w, o in zip(weights, odds, strict=False):
        found = w.take(at)
        found *= o
        total += found
    return np.clip(total, -12, 12, out=total)


def _cells(node: np.ndarray, total: np.ndarray) -> np.ndarray:
    step = total * np.float32((STEPS - 1) / (2 * ODDS))
    np.rint(step, out=step)
    np.clip(step, -(STEPS // 2), STEPS // 2, out=step)
    cells = step.astype(np.int32)
    cells += node * np.int32(STEPS)
    cells += STEPS // 2
    return cells.astype(np.int64)


def _chances(total: np.ndarray) -> np.ndarray:
    out = np.negative(total)
    np.exp(out, out=out)
    out += np.float32(1)
    return np.divide(np.float32(1), out, out=out)


def stretches(code: Code, texts: list[Pieces]) -> Iterator[Symbols]:
    """The symbols of all texts in their order, some STRETCH bytes at a time."""
    short: list[Pieces] = []
    size = 0

    def joined() -> Symbols:
        every, counts = together(short)
        return symbols_of(code, every, np.cumsum(counts) - counts)

    for text in texts:
        # The end is no byte of the text.
        if len(text.data) <= STRETCH + 1:
            short.append(text)
            size += len(text.data) - 1
            if size > STRETCH:
                yield joined()
                short, size = [], 0
            continue
        before = BEGIN
        for stretch, _ in text.stretches():
            known = symbols_of(code, stretch, before=before)
            before = known.last
            yield known
    if short:
        yield joined()


#: How far a cell moves towards the mean of so many decisions.
_MOVED = 1 - (1 - REFINE_RATE) ** np.arange(FIT_BLOCK + 1)


class Learner:
    """Weights and refinement that move with each block of decisions, and how often each gate and cell was met."""

    def __init__(self, model: Model) -> None:
        self.weights, self.refined, self.steps = model.weights.copy(), model.refined.copy(), 0
        self.weights[-1] = 0
        self.gates, self.cells = np.zeros(self.weights.shape[1], dtype=np.int64), np.zeros(len(self.refined), dtype=np.int64)

    def learn(self, model: Model, texts: list[Pieces]) -> None:
        """From texts, with the tables of `model`."""
        code = model.code
        for known in stretches(code, texts):
            offsets, lengths = code.offsets.take(known.codes), code.lengths.take(known.codes)
            ends = np.cumsum(lengths, dtype=np.int64)
            for first in range(0, int(ends[-1]), TOGETHER // FIT_BLOCK * FIT_BLOCK):
                end = min(first + TOGETHER // FIT_BLOCK * FIT_BLOCK, int(ends[-1]))
                # The symbols to which these decisions belong; of the first and the last maybe only some.
                some = slice(int(np.searchsorted(ends, first, "right")), int(np.searchsorted(ends, end)) + 1)
                own, sizes = offsets[some].copy(), lengths[some].copy()
                done = first - int(ends[some.start] - sizes[0])
                own[0] += done
                sizes[0] -= done
                sizes[-1] -= int(ends[some.stop - 1]) - end
                got = _inputs(model, own, sizes, [h[some] for h in known.hashes])
                self.gates += np.bincount(got.gate, minlength=len(self.gates))
                for begin in range(0, end - first, FIT_BLOCK):
                    part = slice(begin, begin + FIT_BLOCK)
                    self._block(got.gate[part], [o[part] for o in got.odds], got.node[part], got.bit[part])

    def _block(self, gate: np.ndarray, odds: list[np.ndarray], node: np.ndarray, bit: np.ndarray) -> None:
        rate = np.float32(FIT_RATE / (1 + self.steps / 500) + RATE)
        self.steps += 1
        total = mixed(list(self.weights), gate, odds)
        error = bit - _chances(total)
        moves = [np.bincount(gate, error if o is None else error * o, minlength=len(self.gates)) for o in (*odds, None)]
        self.weights += rate * np.array(moves, dtype=np.float32)
        cells = _cells(node, total)
        cells += (bit != 0) * len(self.cells)
        zeros, ones = np.bincount(cells, minlength=2 * len(self.cells)).reshape(2, -1)
        met = zeros + ones
        at = np.flatnonzero(met != 0)
        met, old = met.take(at), self.refined.take(at)
        self.cells[at] += met
        # As if the decisions of a cell had moved it one after the other towards their mean.
        old += (_MOVED.take(met) * (ones.take(at) / met - old)).astype(np.float32)
        self.refined[at] = old

    def sums(self) -> pa.RecordBatch:
        """(at, total, n) of the weights and, after them, the refinement, as far as they were met; whole numbers, which add up to the same in any order."""
        n = np.concatenate([np.tile(self.gates, len(self.weights)), self.cells])
        at = np.flatnonzero(n)
        values = np.concatenate([self.weights.reshape(-1), self.refined])[at].astype(np.float64)
        return pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(np.rint(values * FINE).astype(np.int64) * n[at]), pa.array(n[at])], names=["at", "total", "n"])


def with_averages(model: Model, at: np.ndarray, total: np.ndarray, n: np.ndarray) -> Model:
    """`model` with the averages of what was learned; what was never met stays."""
    weights = model.weights.copy()
    weights[-1] = 0
    values = np.concatenate([weights.reshape(-1), model.refined])
    values[at] = (total / n / FINE).astype(np.float32)
    model.weights = values[: weights.size].reshape(weights.shape)
    model.refined = np.clip(values[weights.size :], 1 / 4096, 1 - 1 / 4096)
    return model


def fit(model: Model, texts: list[bytes]) -> Model:
    """Weights and refinement from some texts, one after the other."""
    learner = Learner(model)
    learner.learn(model, apart(*cut_texts(model.code, texts)))
    found = learner.sums()
    return with_averages(model, *(np.array(found.column(k)) for k in range(3)))


class Scorer:
    """Scores texts side by side, each with its own copy of the weights."""

    def __init__(self, model: Model) -> None:
        self.model, self.gates = model, model.weights.shape[1]

    def score(self, texts: list[bytes]) -> list[float]:
        """Natural logarithms of the texts' probabilities."""
        return self.scores(apart(*cut_texts(self.model.code, texts)))

    def scores(self, texts: list[Pieces]) -> list[float]:
        out, batch, size = [0.0] * len(texts), [], 0
        for k, text in enumerate(texts):
            if len(text.data) > STRETCH + 1:
                out[k] = self._long(text)
                continue
            batch.append(k)
            size += len(text.data)
            if size > 8 * STRETCH:
                self._short(texts, batch, out)
                batch, size = [], 0
        if batch:
            self._short(texts, batch, out)
        return out

    def _short(self, texts: list[Pieces], batch: list[int], out: list[float]) -> None:
        every, counts = together([texts[k] for k in batch])
        known = symbols_of(self.model.code, every, np.cumsum(counts) - counts)
        sizes = np.add.reduceat(known.sizes, np.cumsum(counts) - counts)
        # Texts of one block move no weights, and share the last row; the longer a text, the earlier its row.
        several = int((sizes > BLOCK).sum())
        rows = np.empty(len(sizes), dtype=np.int64)
        rows[np.argsort(-sizes, kind="stable")] = np.minimum(np.arange(len(sizes)), several)
        weights = np.repeat(self.model.weights[:, None, :], several + 1, axis=1)
        for k, value in zip(batch, self._blocks(known, sizes, rows, weights), strict=True):
            out[k] = float(value)

    def _long(self, text: Pieces) -> float:
        """A stretch of pieces at a time; the weights go on."""
        total, before = 0.0, BEGIN
        weights = self.model.weights[:, None, :].copy()
        for stretch, last in text.stretches():
            known = symbols_of(self.model.code, stretch, before=before)
            before = known.last
            total += float(self._blocks(known, np.array([len(known.codes)]), np.zeros(1, dtype=np.int64), weights, more=not last)[0])
        return total

    def _blocks(self, known: Symbols, sizes: np.ndarray, rows: np.ndarray, weights: np.ndarray, more: bool = False) -> np.ndarray:
        """Log probabilities of texts of so many symbols, block by block; a text's row of `weights` (input, row, gate) moves."""
        code = self.model.code
        offsets, lengths = code.offsets.take(known.codes), code.lengths.take(known.codes)
        running = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        result = np.zeros(len(sizes))
        # The first blocks of all texts, then the second ones, and so on; of each of them, first those that are not their text's last.
        n_blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(sizes)), n_blocks)
        begin = (np.arange(len(owner)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)) * BLOCK
        goes_on = (begin + BLOCK < sizes[owner]) | more
        order = np.argsort(2 * begin + ~goes_on, kind="stable")
        owner, begin, goes_on = owner[order], begin[order], goes_on[order]
        count = np.minimum(BLOCK, sizes[owner] - begin)
        first = (np.cumsum(sizes) - sizes)[owner] + begin
        n_decisions = running[first + count] - running[first]
        done = np.concatenate([[0], np.cumsum(n_decisions)])
        flat = [w.reshape(-1) for w in weights]
        a = 0
        while a < len(owner):
            b = min(int(np.searchsorted(begin, begin[a], "right")), max(a + 1, int(np.searchsorted(done, done[a] + TOGETHER, "right")) - 1))
            own, some = owner[a:b], count[a:b]
            at = np.repeat(first[a:b] - (np.cumsum(some) - some), some)
            at += np.arange(len(at))
            got = _inputs(self.model, offsets.take(at), lengths.take(at), [h.take(at) for h in known.hashes])
            at = got.gate
            at += np.repeat(rows[own] * self.gates, n_decisions[a:b])
            total = mixed(flat, at, got.odds)
            chance = _chances(total)
            right = self.model.refined.take(_cells(got.node, total))
            right += chance
            right *= np.float32(0.5)
            # What the model gave to that which came.
            right += got.bit - np.float32(1)
            np.abs(right, out=right)
            np.clip(right, 1 / 8192, 1 - 1 / 8192, out=right)
            np.log(right, out=right)
            result[own] += np.add.reduceat(right, done[a:b] - done[a], dtype=np.float64)
            if moving := int(goes_on[a:b].sum()):
                part = slice(0, int(done[a + moving] - done[a]))
                at, error = at[part], (got.bit[part] - chance[part]) * np.float32(RATE)
                for w, o in zip(flat, [*got.odds, None], strict=True):
                    found = np.bincount(at, error if o is None else error * o[part])
                    w[: len(found)] += found.astype(np.float32)
            a = b
        return result


def _texts(docs: DataFrame, *columns) -> DataFrame:
    return docs.select(*columns, text_or_empty().cast("binary").alias("text"))


def _half() -> Column:
    """Whether a training text belongs to the second half; by its id, as copies of other ids are among what later texts are scored with, too."""
    return F.xxhash64("doc_id") % 2 == 0


def piece_counts(docs: DataFrame) -> DataFrame:
    """(piece, fix, n, n_held): how often each piece occurs in the texts of the first half, and in those of the second. Rows with `fix` say
    by how much a word occurs more often (or less) than its pieces would have it, as long words have several.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        fixes: Counter = Counter()

        def counted() -> pa.RecordBatch:
            data, sizes, held = (np.concatenate(x) for x in zip(*waiting, strict=True))
            waiting.clear()
            found = _array(data, np.concatenate([[0], np.cumsum(sizes)])).dictionary_encode()
            at, pieces = found.indices.to_numpy(), found.dictionary.cast(pa.binary())
            n, n_held = np.bincount(at), np.bincount(at[held], minlength=len(pieces))
            words = [(w, k) for w, k in fixes.items() if k]
            columns = [
                pa.concat_arrays([pieces, pa.array([w for w, _ in words], pa.binary())]),
                pa.array(np.arange(len(pieces) + len(words)) >= len(pieces)),
                pa.array(np.concatenate([n - n_held, np.array([k for _, k in words], dtype=np.int64)])),
                pa.array(np.concatenate([n_held, np.zeros(len(words), dtype=np.int64)])),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["piece", "fix", "n", "n_held"])

        for batch in portions(batches):
            texts = batch["text"].to_pylist()
            data, starts, own = cut(texts)
            sizes = np.diff(starts)
            waiting.append((data, sizes, np.repeat(np.array(batch["held"].to_pylist()), own)))
            long = np.flatnonzero(sizes == PIECE_WORD)
            long = long[~np.isin(data[starts[long + 1] - 1], np.frombuffer(SPACE, dtype=np.uint8))]
            for k in np.unique(np.searchsorted(np.cumsum(own), long, "right")).tolist():
                fixes.update(Counter(texts[k].lower().split()))
                fixes.subtract(_words(Counter(pieces_of(texts[k]))))
            if sum(len(x) for _, x, _ in waiting) + len(fixes) > HELD:
                yield counted()
                fixes.clear()
        if waiting:
            yield counted()

    found = _texts(docs, _half().alias("held")).mapInArrow(run, "piece binary, fix boolean, n bigint, n_held bigint")
    return found.groupBy("piece", "fix").agg(F.sum("n").alias("n"), F.sum("n_held").alias("n_held"))


def _words(pieces: Counter) -> Counter:
    words: Counter = Counter()
    for piece, n in pieces.items():
        word = piece.rstrip(SPACE + b"\xff")
        if word:
            words[word] += n
    return words


def word_counts(pieces: DataFrame) -> DataFrame:
    """(token, n) of the words, from the pieces and their corrections."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [p if fix else p.rstrip(SPACE + b"\xff") for p, fix in zip(batch["piece"].to_pylist(), batch["fix"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_pydict({"token": pa.array(words, pa.binary()), "n": batch["n"]})

    words = pieces.select("piece", "fix", (F.col("n") + F.col("n_held")).alias("n")).mapInArrow(run, "token binary, n bigint")
    return words.groupBy("token").agg(F.sum("n").alias("n")).where((F.octet_length("token") > 0) & (F.col("n") > 0))


def make_code(pieces: DataFrame) -> Code:
    """Codes of the frequent pieces, and of bytes in the others; at most MAX_PIECES + 256 * 256 rows come here."""
    counted = pieces.where(~F.col("fix")).select("piece", (F.col("n") + F.col("n_held")).alias("n"))
    top = [(bytes(r["piece"]), r["n"]) for r in counted.orderBy(F.desc("n"), "piece").limit(MAX_PIECES).collect()]
    names = [p for p, _ in top]
    known = pieces.sparkSession.sparkContext.broadcast(pa.array(names, pa.large_binary()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, spelled = np.zeros(65536, dtype=np.int64), 0
        for batch in batches:
            if batch.num_rows:
                data, starts = _bytes(batch["piece"])
                rest = np.flatnonzero(numbers_of(known.value, data, starts) < 0)
                n = batch["n"].to_numpy()[rest]
                spelled += int(n.sum())
                spelling = spelling_of(data, starts, rest)
                np.add.at(pairs, spelling.coded()[0], np.repeat(n, spelling.lengths))
        at = np.flatnonzero(pairs)
        yield pa.RecordBatch.from_pydict({"pair": pa.array([*at.tolist(), -1], pa.int32()), "n": pa.array([*pairs[at].tolist(), spelled], pa.int64())})

    found = {r["pair"]: r["n"] for r in counted.mapInArrow(run, "pair int, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).collect()}
    pairs = np.zeros(65536)
    for pair, n in found.items():
        if pair >= 0:
            pairs[pair] = n
    return Code(names, [n for _, n in top], pairs.reshape(256, 256), found.get(-1, 0))


BLOCKS = "block int, held boolean, counts binary"
#: Columns of the tables' log odds.
HALVES = ("first", "second", "both")


def _piece_blocks(pieces: DataFrame, code, bits: tuple[int, ...]) -> DataFrame:
    """Partial tables of everything that has no other piece in its context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, tables = code.value, {}
        for batch in batches:
            if not batch.num_rows:
                continue
            data, starts = _bytes(batch["piece"])
            numbers = numbers_of(known.known, data, starts)
            for held, column in ((False, "n"), (True, "n_held")):
                n = batch[column].to_numpy()
                some = np.flatnonzero(n)
                if not len(some):
                    continue
                if held not in tables:
                    tables[held] = Counts(bits, (0, 1, 2))
                counts, own = tables[held], numbers[some]
                counts.add(known, 65536 + np.where(own < 0, len(known.numbers), own), {0: np.full(len(some), NOTHING)}, n[some])
                rest = some[own < 0]
                if len(rest):
                    spelling = spelling_of(data, starts, rest)
                    codes, hashes = spelling.coded()
                    counts.add(known, codes, dict(enumerate(hashes)), np.repeat(n[rest], spelling.lengths))
        for held, counts in tables.items():
            yield counts.blocks(held)

    return pieces.where(~F.col("fix")).select("piece", "n", "n_held").mapInArrow(run, BLOCKS)


def _text_blocks(docs: DataFrame, code, bits: tuple[int, ...]) -> DataFrame:
    """Partial tables of the pieces after the one and the two before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, tables = code.value, {False: Counts(bits, (1, 2))}
        waiting: dict[bool, list[list[np.ndarray]]] = {False: [], True: []}

        def count(held: bool) -> None:
            """What stands in the same context more than once is counted once, with its number."""
            if held not in tables:
                tables[held] = Counts(bits, (1, 2))
            for k, parts in enumerate(zip(*waiting[held], strict=True), 1):
                keys = np.sort(np.concatenate(parts))
                first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
                times, keys = np.diff(np.append(first, len(keys))), keys[first]
                tables[held].add(known, (keys & np.uint64((1 << 32) - 1)).astype(np.int64), {k: _high(keys)}, times)
            waiting[held] = []

        for batch in portions(batches):
            for held in (False, True):
                texts = batch.filter(pc.equal(batch["held"], held))["text"].to_pylist()
                if not texts:
                    continue
                every, counts = cut_texts(known, texts)
                found = symbols_of(known, every, np.cumsum(counts) - counts, spell=False)
                waiting[held].append([h.astype(np.uint64) << np.uint64(32) | found.codes.astype(np.uint64) for h in found.hashes[1:]])
                if sum(len(x) for x, _ in waiting[held]) > COUNTED:
                    count(held)
        for held in (False, True):
            if waiting[held]:
                count(held)
        for held, counts in tables.items():
            yield counts.blocks(held)

    return _texts(docs, _half().alias("held")).mapInArrow(run, BLOCKS)


def _unpacked(counts: bytes) -> np.ndarray:
    return np.frombuffer(pa.decompress(counts, 16 << BLOCK_BITS, codec="zstd"), dtype=np.int64)


def _added(keys: list[str], finish):
    """For mapInArrow: `finish(block, sums)` of the blocks that agree in `keys`, which come together; the sums
    of the two halves stand apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sums = None, {}
        for batch in batches:
            names = list(zip(*(batch[k].to_pylist() for k in keys), strict=True))
            for own, held, counts in zip(names, batch["held"].to_pylist(), batch["counts"], strict=True):
                if own != key:
                    if key is not None:
                        yield finish(key[0], sums)
                    key, sums = own, {}
                found = _unpacked(counts.as_py())
                sums[held] = sums[held] + found if held in sums else found
        if key is not None:
            yield finish(key[0], sums)

    return run


def _packed(block: int, sums: dict[bool, np.ndarray]) -> pa.RecordBatch:
    data = [pa.compress(x.tobytes(), codec="zstd", asbytes=True) for x in sums.values()]
    return pa.RecordBatch.from_pydict({"block": pa.array([block] * len(sums), pa.int32()), "held": pa.array(list(sums), pa.bool_()), "counts": pa.array(data, pa.binary())})


def _odds(block: int, sums: dict[bool, np.ndarray]) -> pa.RecordBatch:
    """Log odds of a block from the first half, the second, and both."""
    nothing = np.zeros(2 << BLOCK_BITS, dtype=np.int64)
    first, second = sums.get(False, nothing), sums.get(True, nothing)
    values = [pa.array([block], pa.int32()), *(pa.array([quantised(x).tobytes()], pa.binary()) for x in (first, second, first + second))]
    return pa.RecordBatch.from_arrays(values, names=["block", *HALVES])


def tables(parts: DataFrame, bits: tuple[int, ...]) -> list[list[np.ndarray]]:
    """The predictors' tables of the first half, the second, and both, from partial sums.

    Partial sums of one block meet in portions first, and come one after the other, so that a task holds one block. The
    tables come to the driver as 16-bit numbers; `MAX_BITS` bounds them to some 20 MB in all.
    """
    salted = parts.withColumn("salt", F.spark_partition_id() % SALTS)
    near = salted.repartition("block", "salt").sortWithinPartitions("block", "salt").mapInArrow(_added(["block", "salt"], _packed), BLOCKS)
    summed = near.repartition("block").sortWithinPartitions("block").mapInArrow(_added(["block"], _odds), f"block int, {', '.join(f'{h} binary' for h in HALVES)}")
    out = [[np.zeros(1 << b, dtype=np.int16) for b in bits] for _ in HALVES]
    for r in summed.collect():
        k, at = r["block"] >> 24, (r["block"] & (1 << 24) - 1) << BLOCK_BITS
        for known, half in zip(out, HALVES, strict=True):
            known[k][at : at + (1 << BLOCK_BITS)] = np.frombuffer(r[half], dtype=np.int16)
    return out


def averages(docs: DataFrame, first: Model, second: Model, shards: int) -> DataFrame:
    """(at, total, n): what mixers learn from all texts, each with the tables of the half to which it does not belong.

    Texts are dealt into shards, and ordered in them, by hashes of text and id: how they lie in partitions changes nothing.
    """
    shared = docs.sparkSession.sparkContext.broadcast((first, second))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = shared.value
        other = {False: second, True: first}
        shard, learner = None, Learner(first)
        waiting: dict[bool, list[Pieces]] = {False: [], True: []}

        def learn(held: bool) -> None:
            learner.learn(other[held], waiting[held])
            waiting[held] = []

        size = {False: 0, True: 0}
        for batch in portions(batches):
            texts = apart(*cut_texts(first.code, batch["text"].to_pylist()))
            for own, held, text in zip(batch["shard"].to_pylist(), batch["held"].to_pylist(), texts, strict=True):
                if own != shard:
                    if shard is not None:
                        learn(False)
                        learn(True)
                        yield learner.sums()
                    shard, learner, size = own, Learner(first), {False: 0, True: 0}
                waiting[held].append(text)
                size[held] += len(text.data) - 1
                if size[held] > STRETCH:
                    learn(held)
                    size[held] = 0
        if shard is not None:
            learn(False)
            learn(True)
            yield learner.sums()

    draw = F.xxhash64(text_or_empty(), "doc_id")
    dealt = _texts(docs, _half().alias("held"), F.pmod(draw, F.lit(shards)).alias("shard"), draw.alias("draw"))
    found = dealt.repartition("shard").sortWithinPartitions("shard", "draw").mapInArrow(run, "at int, total bigint, n bigint")
    return found.groupBy("at").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


@dataclass
class Learned:
    """The model and the training texts' word counts."""

    model: Model
    words: DataFrame
    n_tokens: int
    n_distinct: int
    n_texts: int


def learn(docs: DataFrame) -> Learned:
    """What texts are scored with, from all of `docs` (doc_id, text)."""
    spark = docs.sparkSession
    pieces = stored(piece_counts(docs))
    words = stored(word_counts(pieces))
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.coalesce(F.sum(F.col("n") * (F.octet_length("token") + 1)), F.lit(0))).first()
    n_texts = docs.count()
    code, bits = make_code(pieces), slot_bits(total[2])
    shared = spark.sparkContext.broadcast(code)
    parts = stored(_piece_blocks(pieces, shared, bits).unionByName(_text_blocks(docs, shared, bits)))
    first, second, both = tables(parts, bits)
    found = averages(docs, Model(code, bits, first), Model(code, bits, second), max(1, total[2] // SHARD)).toArrow()
    model = with_averages(Model(code, bits, both), *(np.array(found[c]) for c in ("at", "total", "n")))
    return Learned(model, words, total[0] + n_texts, total[1] + (n_texts > 0), n_texts)


class Base:
    """What texts' tokens give to the base score."""

    def __init__(self, code: Code, logs: dict[bytes, float]) -> None:
        self.logs = logs
        words = [p.rstrip(SPACE + b"\xff") for p in code.numbers]
        found = [logs.get(w) if w else 0.0 for w in words]
        # The last place is that of a piece without a number. Pieces of white space are no tokens, and no words to look for.
        self.counts = np.array([bool(w) and f is not None for w, f in zip(words, found, strict=True)] + [False])
        self.log = np.array([f or 0.0 for f in found] + [0.0])
        self.open = np.array([f is None for f in found] + [True])

    def tokens(self, texts: list[bytes], every: Pieces, counts: np.ndarray) -> list[tuple[int, int, float, Counter]]:
        """Of each text (tokens, known ones, sum of their logs, the words that are not known here). Pieces are looked up all at
        once; a text with a word in several pieces is read word by word.
        """
        numbers, starts, ends = every.numbers, every.starts, np.cumsum(counts)
        plain = np.ones(len(texts), dtype=bool)
        plain[np.searchsorted(ends, np.flatnonzero(np.diff(starts) == PIECE_WORD), "right")] = False
        known, log = self.counts[numbers].astype(np.int64), self.log[numbers]
        left = np.flatnonzero(self.open[numbers])
        data = every.data.tobytes()
        words = [data[a:b].rstrip(SPACE + b"\xff") for a, b in zip(starts[left].tolist(), starts[left + 1].tolist(), strict=True)]
        found = np.fromiter(map(self.logs.get, words, repeat(math.nan)), dtype=np.float64, count=len(words))
        is_word, here = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) > 0, ~np.isnan(found)
        known[left], log[left] = here, np.where(here, found, 0)
        n = known.copy()
        n[left] = is_word
        n, known, log = (np.diff(x.cumsum()[ends - 1], prepend=0).tolist() for x in (n, known, log))
        rare = is_word & ~here
        until = np.searchsorted(left[rare], ends).tolist()
        rest, out = list(compress(words, rare.tolist())), []
        for k, (a, b) in enumerate(zip([0, *until[:-1]], until, strict=True)):
            out.append(self._with_end(n[k], known[k], log[k], rest[a:b]) if plain[k] else self._by_word(texts[k].lower().split()))
        return out

    def _by_word(self, words: list[bytes]) -> tuple[int, int, float, Counter]:
        found = [self.logs[w] for w in words if w in self.logs]
        return self._with_end(len(words), len(found), math.fsum(found), [w for w in words if w not in self.logs])

    def _with_end(self, n: int, known: int, total: float, rest: list[bytes]) -> tuple[int, int, float, Counter]:
        if END_TOKEN in self.logs:
            return n + 1, known + 1, total + self.logs[END_TOKEN], Counter(rest)
        return n + 1, known, total, Counter([*rest, END_TOKEN])


def score(docs: DataFrame, learned: Learned, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` of every row with n_bytes, n_tokens, n_known, base_score, score (log10 of the text's probability) and
    bits_per_byte (of the text and its end).
    """
    spark = docs.sparkSession
    top = learned.words.orderBy(F.desc("n"), "token").limit(MAX_KNOWN).toArrow()
    frequent = {w: math.log10(n + 1) for w, n in zip(top["token"].to_pylist(), top["n"].to_pylist(), strict=True)}
    if learned.n_texts:
        frequent[END_TOKEN] = math.log10(learned.n_texts + 1)
    complete = top.num_rows < MAX_KNOWN
    shared = spark.sparkContext.broadcast((learned.model, frequent))
    kept = [docs.schema[c] for c in keep]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "n_bytes bigint, n_tokens bigint, known bigint, plain double, natural double, rest array<struct<token: binary, k: bigint>>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, logs = shared.value
        scorer, base = Scorer(model), Base(model.code, logs)
        for batch in portions(batches):
            texts = batch["text"].to_pylist()
            every, counts = cut_texts(model.code, texts)
            n_tokens, known, plain, rest = zip(*base.tokens(texts, every, counts), strict=True)
            columns = [batch[c] for c in keep]
            columns += [pa.array([len(t) for t in texts], pa.int64()), pa.array(n_tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(plain, pa.float64()), pa.array(scorer.scores(apart(every, counts)), pa.float64())]
            rest = [{} if complete else r for r in rest]
            rare = [pa.array([w for r in rest for w in r], pa.binary()), pa.array([k for r in rest for k in r.values()], pa.int64())]
            places = pa.array(np.cumsum([0, *map(len, rest)]), pa.int32())
            columns.append(pa.ListArray.from_arrays(places, pa.StructArray.from_arrays(rare, names=["token", "k"])))
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "n_bytes", "n_tokens", "known", "plain", "natural", "rest"])

    scored = _texts(docs, *keep).mapInArrow(run, schema)
    if not complete:
        scored = stored(scored.withColumn("row", F.monotonically_increasing_id()))
        rare = scored.select("row", F.explode("rest").alias("r")).select("row", "r.token", "r.k").join(learned.words, "token")
        more = rare.groupBy("row").agg(F.sum(F.col("k") * F.log10(F.col("n") + 1)).alias("more"), F.sum("k").alias("more_known"))
        scored = scored.join(more, "row", "left")
    else:
        scored = scored.withColumns({"more": F.lit(0.0), "more_known": F.lit(0).cast("long")})
    zero = F.lit(0).cast("long")
    base = F.col("plain") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * math.log10(learned.n_tokens + learned.n_distinct + 1)
    return scored.select(
        *keep,
        "n_bytes",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", zero)).alias("n_known"),
        base.alias("base_score"),
        (F.col("natural") / math.log(10)).alias("score"),
        (-F.col("natural") / math.log(2) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )
