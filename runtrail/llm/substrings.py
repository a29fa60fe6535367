"""Substring dedup: repeated windows of words are found by Rabin-Karp hashes and removed.

A document's words are hashed from running sums over its bytes, its windows from running sums over
its words, all of them, in vectors. Documents are dealt to shards by hash. A shard sends the
sorted hashes of its windows to buckets by their leading bits, packed as differences, a few bytes
each; a bucket counts the shards that hold each hash and answers with the repeated ones. Windows
found so are checked by a second round with an independent hash of 64 bits and more; what is still
repeated is removed, as maximal intervals of words.

A window that a third of all documents hold is sent once by each shard. Texts move once, to their
shard; the three passes read the same shuffle. Shards and buckets have a fixed size, so their
number grows with the data, not their memory; nor do the bytes of a task, as their number grows too.

Defined results: a null or empty text has no words. Windows are judged on the input, so copies of a
window all go, none stays as the first. A row that repeats another repeats its windows; rows that
are equal in id and text are spread by the tasks that read them. Documents with fewer words than a
window lose nothing. A long text is one document of its shard, and hashed whole. An empty table gives
an empty table. Carried columns stay apart in ``rest``, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runtrail.llm.common import narrow

SHARD_BYTES = 8 << 20
#: Bytes of text hashed at once.
CHUNK = 1 << 20
#: Bytes of text whose shards, or the buckets of whose windows, a task takes one after another.
TASK_BYTES = 64 << 20
#: Windows of a bucket, on average.
BUCKET_WINDOWS = 4 << 20
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
PACKED = "bucket int, from_shard int, n long, packed binary"


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def sums(values: np.ndarray) -> np.ndarray:
    return np.r_[np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)]


class RollingHash:
    """One of a family of Rabin-Karp hashes modulo 2**64, over words and over windows of words."""

    def __init__(self, number: int):
        self.bytes = mixed(np.arange(1, 257, dtype=np.uint64) + np.uint64(number * 1000))
        bases = mixed(np.array([7, 11], np.uint64) + np.uint64(number * 77)) | np.uint64(1)
        # 5 modulo 8: powers repeat as late as they can.
        self.base, self.word_base = ((int(b) & ~7) | 5 for b in bases)
        self.inverse, self.word_inverse = (pow(b, -1, 1 << 64) for b in (self.base, self.word_base))
        self.grown = 0

    def _grow(self, n: int) -> None:
        if n > self.grown:
            self.grown = max(n, 2 * self.grown)
            self.up, self.down = powers(self.base, self.grown), powers(self.inverse, self.grown)
            self.word_up = powers(self.word_base, self.grown)
            self.word_down = powers(self.word_inverse, self.grown)

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        before = sums(self.bytes[data] * self.up[:len(data)])
        return mixed((before[ends] - before[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))

    def windows(self, words: np.ndarray, width: int) -> np.ndarray:
        self._grow(len(words) + 1)
        before = sums(words * self.word_up[:len(words)])
        n = len(words) - width + 1
        return mixed((before[width:] - before[:n]) * self.word_down[:n]) if n > 0 else np.zeros(0, np.uint64)


def word_places(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of some texts, starts and ends of their words, and the words up to each text's end."""
    data = np.frombuffer(b"".join(t + b" " for t in texts if t), np.uint8)
    inked = np.r_[False, ~BLANK[data], False]
    edges = np.flatnonzero(inked[1:] != inked[:-1])
    starts, ends = edges[::2], edges[1::2]
    text_ends = np.cumsum([len(t) + 1 if t else 0 for t in texts])
    return data, starts, ends, np.searchsorted(starts, text_ends)


def chunks(texts: list[bytes | None]):
    """Consecutive texts of about ``CHUNK`` bytes together."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text) if text else 0
        if size >= CHUNK:
            yield texts[start:i + 1]
            start, size = i + 1, 0
    if start < len(texts):
        yield texts[start:]


def shard_windows(texts: list[bytes | None], width: int, hashes: list[RollingHash]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Of each hash the values of all windows of a shard; each window's first word, counted over
    the shard; and the words up to each text's end.
    """
    values: list[list[np.ndarray]] = [[] for _ in hashes]
    firsts, ends, n = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    for part in chunks(texts):
        data, starts, stops, text_ends = word_places(part)
        text = np.searchsorted(text_ends, np.arange(len(starts)), side="right")
        last = len(starts) - width + 1
        whole = np.flatnonzero(text[:last] == text[width - 1:]) if last > 0 else np.zeros(0, np.int64)
        for own, h in zip(values, hashes):
            own.append(h.windows(h.words(data, starts, stops), width)[whole])
        firsts.append(whole + n)
        ends.append(text_ends + n)
        n += len(starts)
    return [np.concatenate([np.zeros(0, np.uint64), *v]) for v in values], np.concatenate(firsts), np.concatenate(ends)


def pack(values: np.ndarray, width: int) -> bytes:
    """Sorted numbers below 256**width as differences, one plane of bytes after another."""
    steps = np.diff(values, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)
    return steps[:, :width].T.tobytes()


def unpack(data: bytes, n: int, width: int) -> np.ndarray:
    steps = np.zeros((n, 8), np.uint8)
    steps[:, :width] = np.frombuffer(data, np.uint8).reshape(width, n).T
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


def packed_rows(shard: int, buckets: np.ndarray, values: np.ndarray, width: int) -> pa.Table:
    """A row per bucket: its distinct values, sorted."""
    order = np.lexsort((values, buckets))
    buckets, values = buckets[order], values[order]
    new = np.r_[True, (buckets[1:] != buckets[:-1]) | (values[1:] != values[:-1])][:len(values)]
    buckets, values = buckets[new], values[new]
    heads = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]][:len(buckets)])
    tails = np.r_[heads[1:], len(buckets)]
    return pa.table({
        "bucket": pa.array(buckets[heads].astype(np.int32)),
        "from_shard": pa.array(np.full(len(heads), shard, np.int32)),
        "n": pa.array((tails - heads).astype(np.int64)),
        "packed": pa.array([pack(values[a:b], width) for a, b in zip(heads, tails)], pa.binary()),
    })


def repeated_across(rows: DataFrame, width: int, n_tasks: int) -> DataFrame:
    """To each shard, from each bucket, its values that another shard holds too."""

    def count(table: pa.Table) -> pa.Table:
        lists = [
            unpack(data, n, width) for data, n in zip(table["packed"].to_pylist(), table["n"].to_pylist())
        ]
        every = np.sort(np.concatenate(lists))
        twice = np.unique(every[1:][every[1:] == every[:-1]])
        shared = [np.intersect1d(own, twice, assume_unique=True) for own in lists]
        keep = [i for i, own in enumerate(shared) if len(own)]
        return pa.table({
            "bucket": table["bucket"].take(pa.array(keep, pa.int32())),
            "from_shard": table["from_shard"].take(pa.array(keep, pa.int32())),
            "n": pa.array([len(shared[i]) for i in keep], pa.int64()),
            "packed": pa.array([pack(shared[i], width) for i in keep], pa.binary()),
        })

    return rows.repartitionById(n_tasks, "bucket").groupBy("bucket").applyInArrow(count, PACKED)


def answered(reply: pa.Table, buckets: np.ndarray, values: np.ndarray, width: int) -> np.ndarray:
    """Which values are repeated: within the shard, or by the reply of the buckets."""
    flag = np.zeros(len(values), bool)
    order = np.lexsort((values, buckets))
    same = (values[order][1:] == values[order][:-1]) & (buckets[order][1:] == buckets[order][:-1])
    flag[order[1:][same]] = flag[order[:-1][same]] = True
    bounds = {}
    for bucket, n, data in zip(*[reply[c].to_pylist() for c in ("bucket", "n", "packed")]):
        bounds[bucket] = unpack(data, n, width)
    sorted_buckets = buckets[order]
    for bucket, own in bounds.items():
        a, b = np.searchsorted(sorted_buckets, [bucket, bucket + 1])
        part = values[order[a:b]]
        at = np.minimum(np.searchsorted(own, part), len(own) - 1)
        flag[order[a:b][own[at] == part]] = True
    return flag


def find_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 35,
    shard_bytes: int = SHARD_BYTES, carry: tuple[str, ...] = (),
) -> DataFrame:
    """Per document: ``doc_id``, ``text`` (the kept words joined by one space, or the text as it is
    where nothing goes), ``n_words``, ``n_removed`` and ``spans`` (removed intervals of words, end
    exclusive), and the carried columns in ``rest``.
    """
    size = docs.agg(F.sum(F.octet_length(docs[text_col]))).first()[0] or 0
    n_shards = max(1, math.ceil(size / shard_bytes))
    bucket_bits = max(0, math.ceil(math.log2(max(1, size / 6 / BUCKET_WINDOWS))))
    # As many tasks as the session's shuffles have, if there are that many shards, and more for large tables.
    usual = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_tasks = max(min(n_shards, usual), math.ceil(size / TASK_BYTES))
    dealt = narrow(docs, id_col, text_col, carry).withColumn(
        "shard", F.pmod(F.xxhash64("doc_id", "text", F.spark_partition_id()), F.lit(n_shards)).cast("int")
    ).repartitionById(n_tasks, "shard")  # in turn, so that every task has as many shards
    find, verify = 0, 1
    rest = (1 << 40) - 1

    def placed(hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bucket and the next 40 bits, of the hash that finds repeats."""
        if not bucket_bits:
            return np.zeros(len(hashed), np.int64), (hashed >> np.uint64(24)) & np.uint64(rest)
        bucket = (hashed >> np.uint64(64 - bucket_bits)).astype(np.int64)
        return bucket, (hashed >> np.uint64(24 - bucket_bits)) & np.uint64(rest)

    def placed_again(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bucket by bits of the first hash that finding did not use, and the second hash whole."""
        return (first & np.uint64((1 << min(bucket_bits, 20)) - 1)).astype(np.int64), second

    def texts_of(table: pa.Table) -> list[bytes | None]:
        return table["text"].cast(pa.binary()).to_pylist()

    def send(table: pa.Table) -> pa.Table:
        (first,), _, _ = shard_windows(texts_of(table), width, [RollingHash(find)])
        return packed_rows(table["shard"][0].as_py(), *placed(first), 5)

    def send_again(table: pa.Table, reply: pa.Table) -> pa.Table:
        if not len(table):
            return pa.table({"bucket": pa.array([], pa.int32()), "from_shard": pa.array([], pa.int32()),
                             "n": pa.array([], pa.int64()), "packed": pa.array([], pa.binary())})
        (first, second), _, _ = shard_windows(texts_of(table), width, [RollingHash(find), RollingHash(verify)])
        flag = answered(reply, *placed(first), 5)
        return packed_rows(table["shard"][0].as_py(), *placed_again(first[flag], second[flag]), 8)

    def remove(table: pa.Table, reply: pa.Table) -> pa.Table:
        texts = texts_of(table)
        (first, second), at, ends = shard_windows(texts, width, [RollingHash(find), RollingHash(verify)])
        at = at[answered(reply, *placed_again(first, second), 8)]
        n = int(ends[-1]) if len(ends) else 0
        depth = np.zeros(n + 1, np.int64)
        np.add.at(depth, at, 1)
        np.add.at(depth, at + width, -1)
        gone = np.cumsum(depth)[:-1] > 0
        kept, n_removed, spans = [], [], []
        for text, a, b in zip(texts, np.r_[0, ends[:-1]], ends):
            own = gone[a:b]
            edge = np.flatnonzero(np.diff(np.r_[False, own, False].astype(np.int8)))
            spans.append([{"start": int(x), "end": int(y)} for x, y in zip(edge[::2], edge[1::2])])
            n_removed.append(int(own.sum()))
            if len(edge):
                words = text.split()
                pieces = zip(np.r_[0, edge[1::2]], np.r_[edge[::2], len(words)])
                text = b" ".join(w for x, y in pieces for w in words[x:y])
            kept.append(text)
        columns = {c: table[c] for c in ("doc_id", "rest") if c in table.column_names}
        columns |= {
            "text": pa.array(kept, pa.binary()).cast(pa.string()), "n_words": pa.array(np.diff(np.r_[0, ends])),
            "n_removed": pa.array(n_removed, pa.int64()),
            "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
        }
        return pa.table({c: columns[c] for c in names})

    def with_reply(reply: DataFrame, function, schema):
        own = reply.repartitionById(n_tasks, "from_shard").groupBy("from_shard")
        return dealt.groupBy("shard").cogroup(own).applyInArrow(function, schema)

    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    schema = T.StructType([f for f in dealt.schema.fields if f.name != "shard"])
    schema = schema.add("n_words", "long").add("n_removed", "long").add("spans", T.ArrayType(span))
    names = schema.names
    suspects = repeated_across(dealt.groupBy("shard").applyInArrow(send, PACKED), 5, n_tasks)
    proven = repeated_across(with_reply(suspects, send_again, PACKED), 8, n_tasks)
    return with_reply(proven, remove, schema)
