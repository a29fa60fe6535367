"""Benchmark decontamination by an FM-index of each training shard.

The words of a shard of documents become one sequence of numbers. Its suffixes are sorted, the
Burrows-Wheeler sequence is kept as a wavelet tree with rank counts, and every sixteenth text
position is sampled. All test windows are searched backward at once; the rows that match walk
back to a sampled position, which gives their place; places merge into removal spans.

Only words of the test items have numbers of their own; all others, and the ends of documents,
are one separator. No window holds a separator, so runs of known words that are shorter than the
shortest window cannot match and are left out of the index, and the separators between runs are
one each. This changes no result.

Documents are never shuffled or joined. Test items are broadcast in blocks of at most
``block_bytes`` each, and a shard is searched for one block after another.

Defined results: a null text has no words; a null item, or one without words, has no window; an
item without id marks words but is not named; an id that several items share is named once; repeated
rows are hit alike; a very long text is a shard of its own; empty tables give no rows or no hits.
Further columns are only carried, under ``rest``, so none clashes.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runtrail.llm.common import narrow

#: Bytes of words: digits, letters (A-Z in lower case) and all of 0x80 and above.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 32
    for b in range(256)
)
SAMPLE_EVERY = 16
#: Number of what stands between runs of known words. Words come after it, 0 ends the sequence.
SEPARATOR = 1
#: A shard holds so many bytes of text at most, or one document.
SHARD_BYTES = 8 << 20


def words_in(text: bytes | None) -> list[bytes]:
    """The words of a UTF-8 text."""
    return text.translate(WORD_BYTES).split() if text else []


def suffix_order(seq: np.ndarray) -> np.ndarray:
    """Start of every suffix, in order. Prefix doubling that sorts only what is still tied."""
    n = len(seq)
    order = np.argsort(seq, kind="stable")
    rank = np.empty(n, np.int64)
    starts = np.flatnonzero(np.r_[True, seq[order[1:]] != seq[order[:-1]]])
    first = np.repeat(starts, np.diff(np.r_[starts, n]))
    rank[order] = first
    width = 1
    while True:
        tied = np.flatnonzero(np.bincount(first, minlength=n)[first] > 1)
        if not len(tied):
            return order
        at = order[tied]
        after = np.where(at + width < n, rank[np.minimum(at + width, n - 1)], -1)
        by = np.lexsort((after, first[tied]))
        order[tied] = at[by]
        group, after = first[tied], after[by]
        new = np.r_[True, (group[1:] != group[:-1]) | (after[1:] != after[:-1])]
        heads = tied[new]
        first[tied] = np.repeat(heads, np.diff(np.r_[np.flatnonzero(new), len(tied)]))
        rank[order[tied]] = first[tied]
        width *= 2


class WaveletTree:
    """Rank and access over numbers of ``bits`` bits, one level of counted bits after another."""

    def __init__(self, seq: np.ndarray, bits: int):
        self.bits, self.n = bits, len(seq)
        counts = np.bincount(seq, minlength=1 << bits)
        self.below = np.r_[0, np.cumsum(counts)]
        self.ones = []
        current = seq
        for level in range(bits):
            bit = (current >> (bits - 1 - level)) & 1
            self.ones.append(np.r_[0, np.cumsum(bit)].astype(np.int32))
            if level + 1 < bits:
                current = current[np.argsort(current >> (bits - 1 - level), kind="stable")]

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol stands before ``end``."""
        at = end.copy()
        for level in range(self.bits):
            shift = self.bits - level
            start = self.below[(symbol >> shift) << shift]
            ones = self.ones[level]
            n_ones = ones[start + at] - ones[start]
            at = np.where((symbol >> (shift - 1)) & 1, n_ones, at - n_ones)
        return at

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and its rank there."""
        symbol = np.zeros_like(at)
        for level in range(self.bits):
            shift = self.bits - level
            start = self.below[symbol]
            ones = self.ones[level]
            n_ones = ones[start + at] - ones[start]
            bit = ones[start + at + 1] - ones[start + at]
            symbol = symbol + (bit.astype(np.int64) << (shift - 1))
            at = np.where(bit == 1, n_ones, at - n_ones)
        return symbol, at


class FMIndex:
    """Finds all places of many patterns in a sequence of numbers below ``size``.

    The sequence ends with its only 0.
    """

    def __init__(self, seq: np.ndarray, size: int):
        order = suffix_order(seq)
        self.tree = WaveletTree(seq[order - 1], max(1, int(size - 1).bit_length()))
        self.start = self.tree.below
        self.is_sampled = order % SAMPLE_EVERY == 0
        self.n_sampled = np.r_[0, np.cumsum(self.is_sampled)]
        self.sampled = order[self.is_sampled]
        self.n = len(seq)

    def ranges(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the suffixes that start with each pattern; patterns are padded at the end."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        for back in range(1, patterns.shape[1] + 1):
            live = np.flatnonzero((lengths >= back) & (low < high))
            symbol = patterns[live, lengths[live] - back]
            both = self.tree.rank(np.r_[symbol, symbol], np.r_[low[live], high[live]])
            low[live] = self.start[symbol] + both[: len(live)]
            high[live] = self.start[symbol] + both[len(live):]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        place, steps = np.empty(len(rows), np.int64), np.zeros(len(rows), np.int64)
        live, at = np.arange(len(rows)), rows
        while len(live):
            done = self.is_sampled[at]
            place[live[done]] = self.sampled[self.n_sampled[at[done]]] + steps[live[done]]
            live, at = live[~done], at[~done]
            steps[live] += 1
            symbol, rank = self.tree.access(at)
            at = self.start[symbol] + rank
        return place


class Block:
    """The windows of a block of items, as numbers of their words."""

    def __init__(self, items: list[tuple[str | None, str | None]], width: int):
        worded = [(name, words) for name, text in items if (words := words_in((text or "").encode()))]
        vocabulary = sorted({w for _, words in worded for w in words})
        self.number = {w: i for i, w in enumerate(vocabulary, SEPARATOR + 1)}
        self.size = len(vocabulary) + SEPARATOR + 1
        owners: dict[tuple[int, ...], set[str]] = {}
        for name, words in worded:
            ids = [self.number[w] for w in words]
            for s in range(max(1, len(ids) - width + 1)):
                owners.setdefault(tuple(ids[s:s + width]), set()).update([] if name is None else [name])
        self.lengths = np.array([len(w) for w in owners], np.int64)
        self.patterns = np.zeros((len(owners), width), np.int64)
        for i, window in enumerate(owners):
            self.patterns[i, :len(window)] = window
        names = sorted({name for own in owners.values() for name in own})
        index = {name: i for i, name in enumerate(names)}
        self.names = np.array(names, object)
        self.n_owners = np.array([len(own) for own in owners.values()], np.int64)
        self.first_owner = np.r_[0, np.cumsum(self.n_owners)]
        self.owners = np.array([index[n] for own in owners.values() for n in sorted(own)], np.int64)

    def search(self, words: list[bytes], ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places, windows' numbers and lengths of all occurrences among the words of a shard.

        ``ends`` has the end of each document in ``words``.
        """
        none = np.zeros(0, np.int64)
        if not len(self.lengths) or not words:
            return none, none, none
        get = self.number.get
        numbers = np.fromiter((get(w, SEPARATOR) for w in words), np.int64, len(words))
        known = np.r_[False, numbers > SEPARATOR, False]
        breaks = np.zeros(len(words) + 1, bool)
        breaks[ends] = True
        first = np.flatnonzero(known[1:-1] & (~known[:-2] | breaks[:-1]))
        last = np.flatnonzero(known[1:-1] & (~known[2:] | breaks[1:])) + 1
        long_enough = last - first >= self.lengths.min()
        first, last = first[long_enough], last[long_enough]
        if not len(first):
            return none, none, none
        sizes = last - first
        into = np.cumsum(sizes + 1) - sizes - 1
        origin = np.repeat(first - into, sizes + 1) + np.arange(int((sizes + 1).sum()))
        seq = numbers[np.minimum(origin, len(words) - 1)]
        seq[into + sizes] = SEPARATOR
        seq[-1] = 0
        index = FMIndex(seq, self.size)
        low, high = index.ranges(self.patterns, self.lengths)
        found = high - low
        window = np.repeat(np.arange(len(found)), found)
        rows = np.repeat(low - np.r_[0, np.cumsum(found)[:-1]], found) + np.arange(int(found.sum()))
        return origin[index.locate(rows)], window, self.lengths[window]


def shard_results(texts: list[bytes | None], blocks: Iterable[Block]) -> list[tuple]:
    """Of each document: words, hit words, removal spans as word offsets, names of its items."""
    words: list[bytes] = []
    ends = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        words += words_in(text)
        ends[i] = len(words)
    starts = np.r_[0, ends[:-1]]
    depth = np.zeros(len(words) + 1, np.int64)
    pairs = [np.zeros((0, 2), np.int64)]
    names: list[str] = []
    for block in blocks:
        place, window, length = block.search(words, ends)
        np.add.at(depth, place, 1)
        np.add.at(depth, place + length, -1)
        doc = np.searchsorted(ends, place, side="right")
        by_window = np.unique(np.stack([doc, window], 1), axis=0)
        n = block.n_owners[by_window[:, 1]]
        at = np.repeat(block.first_owner[by_window[:, 1]] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(int(n.sum()))
        pairs.append(np.unique(np.stack([np.repeat(by_window[:, 0], n), block.owners[at] + len(names)], 1), axis=0))
        names += list(block.names)
    hit = np.r_[False, np.cumsum(depth)[:-1] > 0, False].astype(np.int8)
    edge = np.diff(hit)
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    # A run of hit words that crosses the end of a document is a span in each.
    cut = np.union1d(ends, starts)
    cut = cut[(hit[cut] == 1) & (hit[np.minimum(cut + 1, len(hit) - 1)] == 1)]
    first, last = np.sort(np.r_[first, cut]), np.sort(np.r_[last, cut])
    doc_of_span = np.searchsorted(ends, first, side="right")
    span_at = np.searchsorted(doc_of_span, np.arange(len(texts) + 1))
    owned = np.concatenate(pairs)
    owned = owned[np.argsort(owned[:, 0], kind="stable")]
    own_at = np.searchsorted(owned[:, 0], np.arange(len(texts) + 1))
    out = []
    for i in range(len(texts)):
        spans = [
            {"start": int(a - starts[i]), "end": int(b - starts[i])}
            for a, b in zip(first[span_at[i]:span_at[i + 1]], last[span_at[i]:span_at[i + 1]])
        ]
        items = sorted({names[k] for k in owned[own_at[i]:own_at[i + 1], 1]})
        out.append((int(ends[i] - starts[i]), sum(s["end"] - s["start"] for s in spans), spans, items))
    return out


def without_spans(text: bytes | None, spans: list[dict]) -> bytes | None:
    """The text without its hit words and what stands between those of a span."""
    if not spans:
        return text
    places = [m.span() for m in re.finditer(rb"[0-9A-Za-z\x80-\xff]+", text)]
    out, at = [], 0
    for s in spans:
        out.append(text[at:places[s["start"]][0]])
        at = places[s["end"] - 1][1]
    return b"".join([*out, text[at:]])


def benchmark_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> list:
    """Broadcasts of (item id as string, text), each of at most ``block_bytes`` or one item."""
    sc = benchmark.sparkSession.sparkContext
    rows = benchmark.select(
        benchmark[id_col].cast("string").alias("name"), benchmark[text_col].alias("text")
    ).where("text IS NOT NULL").distinct()
    blocks, block, size = [], [], 0
    for name, text in rows.toLocalIterator():
        n = len(text.encode())
        if block and size + n > block_bytes:
            blocks.append(sc.broadcast(block))
            block, size = [], 0
        block.append((name, text))
        size += n
    if block:
        blocks.append(sc.broadcast(block))
    return blocks


def in_turn(blocks: list, width: int) -> Iterator[Block]:
    """One block after another. A broadcast keeps its value for the worker's life once it was read;
    it is let go here, so that a worker holds one block however many there are.
    """
    for b in blocks:
        items = b.value
        vars(b).pop("_value", None)
        yield Block(items, width)


_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", width: int = 10,
    block_bytes: int = 4 << 20, shard_bytes: int = SHARD_BYTES, cut: bool = False,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Per document: ``doc_id``, ``text``, ``n_words``, ``n_hit``, ``spans`` (word offsets, end
    exclusive, merged) and ``items`` (ids as strings, sorted), and the carried columns in ``rest``.
    With ``cut``, the text has lost its spans.
    """
    docs = narrow(docs, id_col, text_col, carry)
    blocks = benchmark_blocks(benchmark, item_col, item_text_col, block_bytes)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = list(in_turn(blocks, width)) if len(blocks) == 1 else []
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            total = np.cumsum([len(t) if t else 0 for t in texts])
            start = 0
            while start < len(texts):
                before = total[start - 1] if start else 0
                stop = int(np.searchsorted(total, before + shard_bytes, side="right"))
                stop = min(max(stop, start + 1), len(texts))
                part = batch.slice(start, stop - start)
                found = shard_results(texts[start:stop], kept or in_turn(blocks, width))
                arrays = [
                    pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()),
                    pa.array([f[2] for f in found], pa.list_(_SPAN)),
                    pa.array([f[3] for f in found], pa.list_(pa.string())),
                ]
                columns = {name: part.column(name) for name in part.schema.names}
                if cut:
                    columns["text"] = pa.array(
                        [without_spans(t, f[2]) for t, f in zip(texts[start:stop], found)], pa.binary()
                    ).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*columns.values(), *arrays], [*part.schema.names, "n_words", "n_hit", "spans", "items"]
                )
                start = stop

    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    schema = T.StructType(list(docs.schema.fields))
    schema = schema.add("n_words", "long").add("n_hit", "long").add("spans", T.ArrayType(span))
    return docs.mapInArrow(search, schema.add("items", T.ArrayType(T.StringType())))
