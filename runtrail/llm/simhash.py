"""SimHash near-duplicates found by fuzzy hashing with the Golay code.

Two fingerprints that differ in three bits at most differ in one bit at most in two of three
segments. The perfect Golay code decodes any 23 bits to one of 4,096 codewords, so a segment is
decoded as it is and with each of its bits flipped; most yield about five codewords. For each
pair of segments, a fingerprint gets as keys the own codeword of one together with every codeword
of the other. Fingerprints within the distance share a key of the pair with few errors, since
each one's own codeword is among the other's. What shares a key is compared bit by bit.

Copies count once: only distinct fingerprints are compared. Rows are sorted by key; each task
compares the runs of equal keys and returns links that span what is connected, never all pairs.

A run longer than ``RUN`` is not compared but passed on, row by row. Fingerprints within three bits
agree on one of four bands of any choice of bits, so each row of it gets four finer keys: the old
key with the bits of one band of those that no key has fixed yet. Every round fixes a quarter of
the free bits, and a run holds distinct fingerprints: with 12 free bits none is longer than
``RUN``. So the rounds end by themselves, no task holds or compares more than ``RUN`` rows of a key,
and a key that a third of all documents share spreads over many tasks.

Defined results: a null or empty text has fingerprint zero, and is linked like any other. A
component is named by its smallest id; it has none if all its documents lack an id. Repeated rows
have one fingerprint, of whole texts of any length; a bit that half the shingles set is 0. An empty
table gives an empty table. Further columns are only carried, so none clashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from runtrail.llm.common import narrow, others, restored, written
from runtrail.llm.components import components
from runtrail.llm.substrings import mixed

#: Generator polynomial of the binary Golay code of length 23.
GOLAY = 0xC75
#: Lowest bit and width of each segment of a fingerprint; none is wider than 23.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
SEED = 42
#: Fingerprints of one key that are compared at once.
RUN = 4096
#: One more than the largest distance: within it one of as many bands is equal.
BANDS = 4


def fingerprint(text: bytes | None, width: int = 3) -> int:
    """Majority of the bits of the hashes of all shingles of ``width`` words, repeats included."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    width = min(width, len(words))
    shingles = map(b" ".join, zip(*[words[i:] for i in range(width)]))
    n = len(words) - width + 1
    hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 65536):
        part = hashes[at:at + 65536].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, width: int) -> DataFrame:
    """``row``, ``doc_id`` and ``fp`` (as a signed number) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            found = np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(found)], ["row", "doc_id", "fp"]
            )

    schema = docs.select("row", "doc_id").schema.add("fp", "long")
    return docs.select("row", "doc_id", "text").mapInArrow(run, schema)


class Golay:
    """Decodes 23-bit words to the number of the nearest codeword."""

    def __init__(self):
        rest = np.arange(1 << 12, dtype=np.int64) << 11
        for bit in range(22, 10, -1):
            rest = np.where((rest >> bit) & 1, rest ^ (GOLAY << (bit - 11)), rest)
        self.rest = rest
        single = np.r_[0, 1 << np.arange(23)]
        patterns = np.unique(single[:, None, None] ^ single[None, :, None] ^ single[None, None, :])
        self.error = np.zeros(1 << 11, np.int64)
        self.error[self.syndrome(patterns)] = patterns

    def syndrome(self, words: np.ndarray) -> np.ndarray:
        return self.rest[words >> 11] ^ (words & 0x7FF)

    def decode(self, words: np.ndarray) -> np.ndarray:
        return (words ^ self.error[self.syndrome(words)]) >> 11


def fuzzy_keys(fps: np.ndarray, golay: Golay) -> tuple[np.ndarray, np.ndarray]:
    """All keys of unsigned fingerprints, and the position of the fingerprint of each key."""
    near = []
    for low, width in SEGMENTS:
        segment = ((fps >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64)
        near.append(golay.decode(segment[:, None] ^ np.r_[0, 1 << np.arange(width)]))
    keys, owners = [], []
    for number, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
        a, b = near[i], near[j]
        both = np.concatenate([(a << 12) | b[:, :1], (a[:, :1] << 12) | b], axis=1)
        both = np.sort(both, axis=1)
        new = np.ones(both.shape, bool)
        new[:, 1:] = both[:, 1:] != both[:, :-1]
        at, _ = np.nonzero(new)
        keys.append(both[new] | (number << 24))
        owners.append(at)
    return np.concatenate(keys), np.concatenate(owners)


def spanning(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` nodes the smallest node it is connected to."""
    low = np.arange(n)
    while True:
        x, y = low[a], low[b]
        apart = x != y
        if not apart.any():
            return low
        np.minimum.at(low, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (jumped := low[low]).tobytes() != low.tobytes():
            low = jumped


def linked(keys: np.ndarray, fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect whatever shares a key and is close enough. Keys are sorted."""
    nodes, node = np.unique(fps, return_inverse=True)
    low = np.arange(len(nodes))
    found, pending = [], 0
    live = np.arange(len(keys))
    for step in range(1, len(keys)):
        live = live[live + step < len(keys)]
        live = live[keys[live] == keys[live + step]]
        if not len(live):
            break
        close = live[np.bitwise_count(fps[live] ^ fps[live + step]) <= distance]
        a, b = node[close], node[close + step]
        apart = low[a] != low[b]
        found.append((a[apart], b[apart]))
        pending += int(apart.sum())
        if pending > 1 << 20:
            low = _joined(low, found)
            found, pending = [], 0
    low = _joined(low, found)
    moved = low != np.arange(len(nodes))
    return nodes[moved], nodes[low[moved]]


def _joined(low: np.ndarray, found: list) -> np.ndarray:
    rest = np.flatnonzero(low != np.arange(len(low)))
    a = np.concatenate([rest, *[x for x, _ in found]])
    b = np.concatenate([low[rest], *[y for _, y in found]])
    return spanning(a, b, len(low))


def finer_keys(keys: np.ndarray, free: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row ``BANDS`` finer keys, the bits that stay free beneath them, and the fingerprints.

    ``free`` marks the bits that no key has fixed yet. Keys are mixed from all that was fixed;
    two that mix to the same number would only be compared together.
    """
    number = np.cumsum(free[:, None] >> np.arange(64, dtype=np.uint64) & np.uint64(1), axis=1, dtype=np.uint64)
    band = (number - np.uint64(1)) * np.uint64(BANDS) // number[:, -1:]
    out = []
    for i in range(BANDS):
        own = (free[:, None] >> np.arange(64, dtype=np.uint64) & np.uint64(1)) * (band == i)
        bits = (own << np.arange(64, dtype=np.uint64)).sum(1, dtype=np.uint64)
        out.append((mixed(mixed(mixed(keys) ^ bits) ^ (fps & bits)), free & ~bits, fps))
    return tuple(np.concatenate(c) for c in zip(*out))


def fuzzy_links(distinct: DataFrame, distance: int, longest: int = RUN) -> DataFrame:
    """Links ``a``, ``b`` that connect all distinct fingerprints ``fp`` within the distance."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        golay = Golay()
        for batch in batches:
            fps = _unsigned(batch, "fp")
            for at in range(0, len(fps), 4096):
                keys, owners = fuzzy_keys(fps[at:at + 4096], golay)
                yield _keyed_batch(keys.astype(np.uint64), np.full(len(keys), ~np.uint64(0)), fps[at:at + 4096][owners])

    def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, free, fps = (_unsigned(batch, c) for c in ("key", "free", "a"))
            for at in range(0, len(fps), 4096):
                yield _keyed_batch(*finer_keys(*(c[at:at + 4096] for c in (key, free, fps))))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = np.zeros((3, 0), np.uint64)
        passing = None
        for batch in batches:
            rows = np.concatenate([rows, [_unsigned(batch, c) for c in ("key", "free", "fp")]], axis=1)
            keys = rows[0]
            heads = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][:len(keys)])
            lengths = np.diff(np.r_[heads, len(keys)])
            long = lengths > longest
            if passing is not None and len(keys):
                long[0] |= keys[0] == passing
            if not len(heads):
                continue
            # The last run may go on in the next batch: it waits, unless it is long already.
            passing = keys[-1] if long[-1] else None
            n = len(keys) if long[-1] else heads[-1]
            of_long = np.repeat(long, lengths)[:n]
            if of_long.any():
                yield _passed_batch(*rows[:, :n][:, of_long])
            if not of_long.all():
                yield _links_batch(*linked(keys[:n][~of_long], rows[2, :n][~of_long], distance))
            rows = rows[:, n:]
        yield _links_batch(*linked(rows[0], rows[2], distance))

    found = None
    keyed = distinct.select("fp").mapInArrow(emit, KEYED)
    while True:
        compared = written(
            keyed.repartition("key").sortWithinPartitions("key").mapInArrow(compare, COMPARED), "compared-keys"
        )
        links = compared.where("key IS NULL").select("a", "b")
        found = links if found is None else found.union(links)
        passed = compared.where("key IS NOT NULL")
        if passed.isEmpty():
            return found
        keyed = passed.mapInArrow(refine, KEYED)


KEYED = "key long, free long, fp long"
#: Links have no key; rows of long runs have one, and their fingerprint as ``a``.
COMPARED = "key long, free long, a long, b long"


def _unsigned(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(column).to_numpy(zero_copy_only=False).view(np.uint64)


def _batch(schema: str, *columns: np.ndarray | int) -> pa.RecordBatch:
    arrays = [pa.nulls(c, pa.int64()) if isinstance(c, int) else pa.array(c.view(np.int64)) for c in columns]
    return pa.RecordBatch.from_arrays(arrays, [part.split()[0] for part in schema.split(", ")])


def _keyed_batch(keys: np.ndarray, free: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
    return _batch(KEYED, keys, free, fps)


def _passed_batch(keys: np.ndarray, free: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
    return _batch(COMPARED, keys, free, fps, len(fps))


def _links_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return _batch(COMPARED, len(a), len(a), a, b)


def _grouped(prints: DataFrame, distance: int) -> tuple[DataFrame, DataFrame]:
    """Root of each distinct fingerprint, and first document of each root."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row"))
    distinct = written(prints.groupBy("fp").agg(first.alias("first")), "fingerprints")
    roots = components(fuzzy_links(distinct, distance))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    return rooted, rooted.groupBy("root").agg(F.min("first").alias("owner"))


def _check(distance: int) -> None:
    if not 0 <= distance <= 3:
        raise ValueError("two of three segments have one error at most only up to distance 3")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, distance: int = 3,
) -> DataFrame:
    """Per document: ``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``."""
    _check(distance)
    numbered = narrow(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    prints = written(fingerprints(numbered, width), "simhash")
    rooted, owners = _grouped(prints, distance)
    named = rooted.join(owners, "root").select("fp", F.col("owner.doc_id").alias("component_id"))
    return prints.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def first_of_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, distance: int = 3,
) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group, one row of its smallest id."""
    _check(distance)
    rest = others(docs, id_col, text_col)
    numbered = written(
        narrow(docs, id_col, text_col, rest).withColumn("row", F.monotonically_increasing_id()), "simhash-documents"
    )
    prints = written(fingerprints(numbered, width), "simhash")
    _, owners = _grouped(prints, distance)
    kept = numbered.join(owners.select(F.col("owner.row").alias("row")), "row", "left_semi")
    return kept.select(*restored(kept, docs.columns, id_col, text_col))
