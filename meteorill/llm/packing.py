"""Packing token streams into training sequences, in order, by dynamic programming.

Documents follow each other by id within a range of ids; each range is one task. Its stream is cut
into sequences of at most `length` tokens at document or sentence boundaries so that padding plus
penalties for cut documents are least. With `c` the places where a cut is possible,

    cost(j) = min over i with c[j] - c[i] <= length of cost(i) + penalty(i) + padding(c[j] - c[i]).

Padding is length - (c[j] - c[i]), so the minimum of cost(i) + penalty(i) + c[i] over a sliding
window is what counts, and a monotone queue keeps it. A sequence whose size is a power of two needs
no padding; those few transitions are looked up beside the queue.

A null text is empty, and an empty document is its end token alone. Equal ids and repeated rows stay
apart, in the order of their texts. Of cuts of equal cost the one whose sequence begins later is taken. Further columns, whatever
their names, play no part. An empty table gives no pieces. A task holds about `span` tokens
and the longest document at a time.
"""

from __future__ import annotations

import json
import zlib
from collections import deque
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteorill.llm.tables import text_or_empty

LENGTH = 2048
END_TOKEN = 1
#: Tokens of padding that a cut is worth: at a sentence's end, and inside a long sentence.
SENTENCE_PENALTY, INSIDE_PENALTY = 8, 64
#: Longer stretches without a sentence's end get cuts this far apart.
STRETCH = 256
#: Tokens planned at a time.
SPAN = 1 << 20
SENTENCE_ENDS = (b".", b"!", b"?", b"\n")


@cache
def _vocabulary(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Ranks by bytes, and special tokens, of a byte-level BPE vocabulary file."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
    special = {t["content"]: t["id"] for t in content.get("added_tokens", [])}
    words = {w: k for w, k in content["model"]["vocab"].items() if w not in special}
    return {bytes(byte_of[c] for c in w): k for w, k in words.items()}, special


@cache
def _exact(path: str):
    """The file's own tokenizer; large, so only loaded where it is needed."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@cache
def tokenizer(path: str) -> Callable[[str], np.ndarray]:
    """Text to ids, as the vocabulary at `path` gives them with add_special_tokens=False.

    The same merges run in a library four times as fast as the file's own; that one takes over
    where the fast one gives up, and where a text holds special tokens.
    """
    import public_tokenizers
    import tiktoken

    ranks, special = _vocabulary(path)
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if not any(s in text for s in special):
            try:
                return np.array(fast.encode_ordinary(text), dtype=np.uint32)
            except BaseException as error:
                if type(error).__name__ not in ("PanicException", "ValueError"):
                    raise
        return np.array(_exact(path).encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    return encode


@cache
def sentence_end_table(path: str) -> np.ndarray:
    """By id: whether the token ends a sentence."""
    ranks, special = _vocabulary(path)
    table = np.zeros(max([*ranks.values(), *special.values()]) + 1, dtype=bool)
    for word, rank in ranks.items():
        table[rank] = word.endswith(SENTENCE_ENDS)
    return table


def cut_places(starts: np.ndarray, ids: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where the stream may be cut, both ends included, and what a cut there costs.

    `starts` are the documents' first places. The last `length` tokens may also be cut at powers
    of two from the end.
    """
    size = len(ids)
    sentences = np.flatnonzero(ends[ids]) + 1
    places = np.concatenate([starts, sentences, [size]])
    cost = np.concatenate([np.zeros(len(starts)), np.full(len(sentences), SENTENCE_PENALTY), [0]])
    order = np.argsort(places, kind="stable")
    places, cost = places[order], cost[order]
    gaps = np.diff(places)
    stretch = min(STRETCH, length)
    wide = np.flatnonzero(gaps > stretch)
    inside = [np.arange(places[k] + stretch, places[k + 1], stretch) for k in wide]
    tail = size - 2 ** np.arange(0, length.bit_length())
    more = np.concatenate([*inside, tail[tail > 0]]).astype(np.int64)
    places = np.concatenate([places, more])
    cost = np.concatenate([cost, np.full(len(more), INSIDE_PENALTY)])
    order = np.lexsort((cost, places))
    places, cost = places[order], cost[order]
    first = np.diff(places, prepend=-1) > 0  # the cheapest of equal places
    return places[first], cost[first]


def best_cuts(places: np.ndarray, cost: np.ndarray, length: int) -> np.ndarray:
    """The places, first and last included, between which the sequences lie.

    No two neighbouring places are more than `length` apart.
    """
    at, penalty = places.tolist(), cost.tolist()
    n = len(at)
    extra: dict[int, list[int]] = {}
    for power in 2 ** np.arange(0, length.bit_length()):
        k = np.searchsorted(places, places - power)
        for j in np.flatnonzero((k < n) & (places[np.minimum(k, n - 1)] == places - power)).tolist():
            extra.setdefault(j, []).append(int(k[j]))
    total, before = [0.0] * n, [0] * n
    queue: deque[tuple[float, int]] = deque()
    for j in range(1, n):
        here = at[j]
        key = total[j - 1] + penalty[j - 1] + at[j - 1]
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j - 1))
        while at[queue[0][1]] < here - length:
            queue.popleft()
        least, origin = queue[0]
        least += length - here
        for i in extra.get(j, ()):
            if (exact := total[i] + penalty[i]) < least:
                least, origin = exact, i
        total[j], before[j] = least, origin
    cuts = [n - 1]
    while cuts[-1]:
        cuts.append(before[cuts[-1]])
    return places[cuts[::-1]]


class _Stream:
    """Documents of a task that are not yet in a sequence."""

    def __init__(self, path: str, length: int, block: int):
        self.length, self.block, self.sequence = length, block, 0
        self.encode, self.ends = tokenizer(path), sentence_end_table(path)
        self.doc_ids: list = []
        self.ids: list[np.ndarray] = []
        self.done: list[int] = []  # tokens of each document that earlier sequences hold
        self.size = 0

    def add(self, doc_id, text: str) -> None:
        self.doc_ids.append(doc_id)
        self.ids.append(np.append(self.encode(text), np.uint32(END_TOKEN)))
        self.done.append(0)
        self.size += len(self.ids[-1])

    def pieces(self, last: bool) -> dict[str, list]:
        """Pieces of the sequences that are settled: all if `last`, else all but the final one."""
        out: dict[str, list] = {name: [] for name in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")}
        if not self.ids:
            return out
        left = [ids[done:] for ids, done in zip(self.ids, self.done, strict=True)]
        stream = np.concatenate(left)
        starts = np.concatenate([[0], np.cumsum([len(x) for x in left])[:-1]]).astype(np.int64)
        places, cost = cut_places(starts, stream, self.ends, self.length)
        cuts = best_cuts(places, cost, self.length)
        if not last:
            cuts = cuts[:-1]
        stop = int(cuts[-1])
        bounds = np.union1d(cuts, starts[starts < stop])
        docs = np.searchsorted(starts, bounds[:-1], "right") - 1
        sequences = np.searchsorted(cuts, bounds[:-1], "right") - 1
        little = stream.astype("<u4", copy=False)
        for a, b, d, s in zip(bounds[:-1].tolist(), bounds[1:].tolist(), docs.tolist(), sequences.tolist(), strict=True):
            out["doc_id"].append(self.doc_ids[d])
            out["start"].append(a - int(starts[d]) + self.done[d])
            out["length"].append(b - a)
            out["ids_crc32"].append(zlib.crc32(little[a:b]))
            out["doc_tokens"].append(len(self.ids[d]))
            out["sequence_id"].append((self.block << 40) + self.sequence + s)
            out["offset"].append(a - int(cuts[s]))
        self.sequence += len(cuts) - 1
        keep = int(np.searchsorted(starts, stop, "right")) - 1 if stop < len(stream) else len(starts)
        if keep < len(starts):
            self.done[keep] += stop - int(starts[keep])
        del self.doc_ids[:keep], self.ids[:keep], self.done[:keep]
        self.size = len(stream) - stop
        return out


def pack(docs: DataFrame, path: str, *, length: int = LENGTH, span: int = SPAN) -> DataFrame:
    """Pieces of `docs` (doc_id, text): (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    Ranges of ids are dealt to tasks, so that nothing has to be in one place; only a range's last
    sequence knows nothing of what follows. `path` is the vocabulary file.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        stream = _Stream(path, length, context.partitionId() if context else 0)
        shape = None
        for batch in batches:
            shape = pa.schema([batch.schema.field("doc_id"), *((n, pa.int64()) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"))])
            texts = batch["text"]
            for k, doc_id in enumerate(batch["doc_id"].to_pylist()):
                stream.add(doc_id, texts[k].as_py())
                if stream.size >= span:
                    yield pa.RecordBatch.from_pydict(stream.pieces(False), shape)
        if shape is not None:
            yield pa.RecordBatch.from_pydict(stream.pieces(True), shape)

    texts = docs.select("doc_id", text_or_empty().alias("text"))
    return texts.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text").mapInArrow(run, schema)
