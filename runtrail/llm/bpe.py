"""BPE encoding and decoding with a public vocabulary, by an index of pair occurrences.

A task cuts its texts into pieces and looks up those it has met before. The pieces that are new in a
chunk of texts are written one after another as numbers of their bytes, linked forwards and
backwards. An index maps the rank of every mergeable pair to all its positions among them. Active
ranks are taken from a heap in ascending order: all positions of a rank are merged at once, in
vectors, and the lists of the pairs that this makes are extended. A pair always ranks after the
merges that made its parts (checked when the vocabulary is read), so merging rank by rank over
many pieces gives what merging the best pair of each piece in turn would.

Nothing is shuffled. The vocabulary has a fixed size and is broadcast; pieces remembered by a task
are forgotten beyond ``KNOWN_PIECES``, which costs time only.

Defined results: a null text has no tokens, like an empty one, and decodes to the empty text; texts
of any length are encoded whole; equal texts have equal tokens; an id that the vocabulary lacks is
left out in decoding; an empty table gives an empty table. Further columns are not read.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from runtrail.llm.common import narrow

#: Characters of text encoded at once.
CHUNK = 4 << 20
KNOWN_PIECES = 1 << 18
#: Bytes of a vocabulary's file that are broadcast at most.
VOCABULARY_BYTES = 64 << 20
#: What the pattern's ``\\s`` stands for: the characters of Unicode's property White_Space.
WHITE_SPACE = "\\p{White_Space}"


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else the next one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    letters = {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


class Vocabulary:
    """The tables of a tokenizer file: symbols of bytes, merges in the order of their ranks, tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            text = f.read(VOCABULARY_BYTES + 1)
        if len(text) > VOCABULARY_BYTES:
            raise ValueError(f"{path} is larger than {VOCABULARY_BYTES} characters")
        file = json.loads(text)
        model = file["model"]
        kinds = [n["type"] for n in file["normalizer"]["normalizers"]]
        split, letters = file["pre_tokenizer"]["pretokenizers"]
        if (
            model["type"] != "BPE" or model["dropout"] or model["ignore_merges"] or model["continuing_subword_prefix"]
            or kinds != ["NFC", "Replace", "Lowercase"] or (split["behavior"], split["invert"]) != ("Removed", True)
            or letters["use_regex"] or letters["add_prefix_space"] or file["decoder"] or file["post_processor"]
        ):
            raise ValueError(f"{path} asks for steps that are not known here")
        self.pattern = split["pattern"]["Regex"].replace("\\s", WHITE_SPACE)
        ids, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        added = {t["content"]: t["id"] for t in file["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in file["added_tokens"]):
            raise ValueError(f"{path} has added tokens that are matched in ways not known here")
        self.added = added
        self.tokens = {i: t for t, i in (ids | added).items()}
        of_byte = byte_letters()
        self.inside = np.array([ids[c] for c in of_byte], np.int64)
        self.at_end = np.array([ids[c + suffix] for c in of_byte], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.left = np.array([ids[a] for a, _ in pairs], np.int64)
        self.right = np.array([ids[b] for _, b in pairs], np.int64)
        self.made = np.array([ids[a + b] for a, b in pairs], np.int64)
        self._check_order(path)
        keys = (self.left << 32) | self.right
        self.rank_of = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank_of]

    def _check_order(self, path: str) -> None:
        last = np.full(max(self.tokens) + 1, -1, np.int64)
        ranks = np.arange(len(self.made))
        np.maximum.at(last, self.made, ranks)
        if len(np.unique((self.left << 32) | self.right)) < len(ranks):
            raise ValueError(f"{path} repeats a merge")
        if (last[self.left] >= ranks).any() or (last[self.right] >= ranks).any():
            raise ValueError(f"{path} has merges ahead of those that make their parts")

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of symbols, -1 where they do not merge."""
        sought = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, sought), len(self.keys) - 1)
        return np.where(self.keys[at] == sought, self.rank_of[at], -1)


class PairIndex:
    """Pieces as linked symbols, and the positions of every pair that merges, by its rank."""

    def __init__(self, vocabulary: Vocabulary, pieces: list[bytes]):
        self.vocabulary = vocabulary
        data = np.frombuffer(b"".join(pieces), np.uint8)
        lengths = np.array([len(p) for p in pieces], np.int64)
        ends = np.cumsum(lengths)
        n = len(data)
        self.symbol = vocabulary.inside[data]
        self.symbol[ends - 1] = vocabulary.at_end[data[ends - 1]]
        self.after, self.before = np.arange(1, n + 1), np.arange(-1, n - 1)
        self.after[ends - 1] = -1
        self.before[ends - lengths] = -1
        self.piece = np.repeat(np.arange(len(pieces)), lengths)
        self.positions: dict[int, list[np.ndarray]] = {}
        self.active: list[int] = []
        self._list(np.flatnonzero(self.after >= 0))

    def _list(self, at: np.ndarray) -> None:
        """Lists the pairs that start at these positions."""
        ranks = self.vocabulary.ranks(self.symbol[at], self.symbol[self.after[at]])
        found = np.flatnonzero(ranks >= 0)
        if not len(found):
            return
        found = found[np.argsort(ranks[found], kind="stable")]
        at, ranks = at[found], ranks[found]
        starts = np.flatnonzero(np.r_[True, ranks[1:] != ranks[:-1]])
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(ranks)]):
            rank = int(ranks[a])
            if rank in self.positions:
                self.positions[rank].append(at[a:b])
            else:
                self.positions[rank] = [at[a:b]]
                heappush(self.active, rank)

    def merge_all(self) -> None:
        while self.active:
            self._merge(heappop(self.active))

    def _merge(self, rank: int) -> None:
        lists = self.positions.pop(rank)
        at = np.concatenate(lists) if len(lists) > 1 else lists[0]
        left, right = self.vocabulary.left[rank], self.vocabulary.right[rank]
        # A listed pair is gone if another merge has taken one of its symbols.
        at = at[(self.symbol[at] == left) & (self.after[at] >= 0)]
        at = at[self.symbol[self.after[at]] == right]
        if left == right and len(at) > 1:
            # Of a run of equal symbols every second pair, from the left.
            at = np.sort(at)
            follows = np.r_[False, self.after[at[:-1]] == at[1:]]
            place = np.arange(len(at))
            at = at[(place - np.maximum.accumulate(np.where(follows, 0, place))) % 2 == 0]
        if not len(at):
            return
        taken = self.after[at]
        beyond = self.after[taken]
        self.symbol[at] = self.vocabulary.made[rank]
        self.symbol[taken] = -1
        self.after[at] = beyond
        inner = beyond >= 0
        self.before[beyond[inner]] = at[inner]
        ahead = self.before[at]
        # What was merged just now is among the positions already.
        ahead = ahead[(ahead >= 0) & (self.symbol[ahead] != self.vocabulary.made[rank])]
        changed = np.concatenate([ahead, at[inner]])
        if len(changed):
            self._list(changed)

    def tokens(self) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all pieces, one after another, and how many each has."""
        alive = self.symbol >= 0
        n = int(self.piece[-1]) + 1 if len(self.piece) else 0
        return self.symbol[alive], np.bincount(self.piece[alive], minlength=n)


class Encoder:
    """Encodes texts, and remembers pieces from one chunk to the next."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.cut = regex.compile(vocabulary.pattern).findall
        marks = sorted(vocabulary.added, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None
        self._forget()

    def _forget(self) -> None:
        added = self.vocabulary.added
        # Added tokens are numbered like pieces, under names that no piece has.
        self.number: dict[object, int] = {(mark,): i for i, mark in enumerate(added)}
        self.flat = np.fromiter(added.values(), np.int64, len(added))
        self.count = np.ones(len(added), np.int64)

    def _plain(self, text: str) -> list[str]:
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            # Each letter by itself: Python would give a last sigma a form of its own.
            text = text.replace("Σ", "σ")
        return self.cut(text.lower())

    def pieces(self, text: str | None) -> list:
        if not text:
            return []
        if self.marks is None or not self.marks.search(text):
            return self._plain(text)
        out: list = []
        for i, part in enumerate(self.marks.split(text)):
            out += [(part,)] if i % 2 else self._plain(part)
        return out

    def _learn(self, new: list[str]) -> None:
        index = PairIndex(self.vocabulary, [p.encode("utf-8", "surrogatepass") for p in new])
        index.merge_all()
        tokens, counts = index.tokens()
        self.number.update(zip(new, range(len(self.count), len(self.count) + len(new))))
        self.flat, self.count = np.r_[self.flat, tokens], np.r_[self.count, counts]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and how many each has."""
        if len(self.number) > KNOWN_PIECES:
            self._forget()
        cut = [self.pieces(t) for t in texts]
        if new := list(set().union(*cut) - self.number.keys()):
            self._learn(new)
        lengths = np.array([len(own) for own in cut], np.int64)
        number = np.fromiter(map(self.number.__getitem__, chain.from_iterable(cut)), np.int64, int(lengths.sum()))
        counts = self.count[number]
        upto = np.r_[0, np.cumsum(counts)]
        starts = np.r_[0, np.cumsum(self.count)][number]
        ids = self.flat[np.repeat(starts - upto[:-1], counts) + np.arange(upto[-1])]
        return ids, np.diff(upto[np.r_[0, np.cumsum(lengths)]])


def _parts(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Bounds of consecutive texts of about ``CHUNK`` characters together."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text) if text else 0
        if size >= CHUNK:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode_texts(
    docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (),
) -> DataFrame:
    """Per document: ``doc_id``, ``ids`` (an array of token ids), and the carried columns in ``rest``."""
    docs = narrow(docs, id_col, text_col, carry)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    kept = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in _parts(texts):
                ids, counts = encoder.encode(texts[a:b])
                offsets = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], lists], [*kept, "ids"])

    schema = T.StructType([docs.schema[c] for c in kept]).add("ids", T.ArrayType(T.IntegerType()))
    return docs.mapInArrow(run, schema)


def decode_ids(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``encoded`` (its column ``ids``) with ``decoded``: the tokens joined by one space, as the
    vocabulary states no decoder. A null array decodes like an empty one.
    """
    names = [vocabulary.tokens.get(i) for i in range(max(vocabulary.tokens) + 1)]
    shared = encoded.sparkSession.sparkContext.broadcast(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = pa.array(shared.value, pa.large_string())
        known = np.array([t is not None for t in shared.value])
        for batch in batches:
            lists = batch.column("ids")
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            ids = np.where((ids >= 0) & (ids < len(known)), ids, len(known))
            kept = np.r_[known, False][ids]
            upto = np.r_[0, np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))]
            offsets = np.r_[0, np.cumsum(kept)][upto]
            own = pa.LargeListArray.from_arrays(pa.array(offsets), tokens.take(pa.array(ids[kept])))
            joined = pc.binary_join(own, pa.scalar(" ", pa.large_string())).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, joined], [*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, T.StructType(list(encoded.schema.fields)).add("decoded", "string"))
