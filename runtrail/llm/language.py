"""Language identification by cross-parsing entropy.

The labelled text of each language is indexed by a suffix automaton. A text is parsed greedily
into the longest pieces that occur in a language's text; the language that needs the fewest
pieces, each weighed by the bits of a position in its text, wins.

Symbols: the ``alphabet`` commonest letters of all languages are a symbol each; every other letter is
spelled in four digits of base 32, the first of its own kind, so that a script of any size matches
itself and only itself. Runs of other characters are one space.

What is learned has a fixed size, the bounded sample of labelled rows: of each language
``docs_per_language`` documents, the first in the order of their ids' hashes, give ``symbols`` symbols
in all, shared so that each gives as much as any other that has as much. The automata become one
table of transitions, whose bytes are checked against ``table_bytes`` before it is broadcast.

Texts are parsed whole, many side by side for all languages at once; the few that are much longer
than the rest go on one by one. Prediction is one pass without a shuffle.

Defined results: ``und`` with score 0 for a null or empty text, a text without letters, and where
nothing could be learned; a tie goes to the first language by code point; repeated rows fare alike;
an empty table gives an empty table. Further columns are only carried, under ``rest``.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runtrail.llm.common import narrow, written

#: Characters parsed side by side.
BATCH = 8 << 20
#: With fewer texts than this left, the rest of each is parsed by itself.
FEW = 32
#: States of an automaton put into the table at a time.
STATES = 4096
#: Marks a letter that is spelled out, ahead of spelling.
OTHER, SPACE = 0, 1
DIGITS, BASE_BITS = 4, 5
BASE = 1 << BASE_BITS
#: Symbols of first digits and of later ones; the letters of the alphabet come after them.
FIRST_DIGIT, LATER_DIGIT, FIRST_LETTER = 2, 2 + BASE, 2 + 2 * BASE


class SuffixAutomaton:
    """Accepts every substring of a sequence of symbols."""

    def __init__(self, sequence: list[int]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        last = 0
        for symbol in sequence:
            last = self._extend(last, symbol)

    def _state(self, moves: dict[int, int], length: int, link: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _extend(self, last: int, symbol: int) -> int:
        new = self._state({}, self.length[last] + 1, 0)
        at = last
        while at >= 0 and symbol not in self.next[at]:
            self.next[at][symbol] = new
            at = self.link[at]
        if at < 0:
            return new
        to = self.next[at][symbol]
        if self.length[to] != self.length[at] + 1:
            copy = self._state(dict(self.next[to]), self.length[at] + 1, self.link[to])
            while at >= 0 and self.next[at].get(symbol) == to:
                self.next[at][symbol] = copy
                at = self.link[at]
            self.link[to] = copy
            to = copy
        self.link[new] = to
        return new


class Letters:
    """The symbols of texts: which letters have one of their own, and how the others are spelled."""

    def __init__(self, texts: list[str], alphabet: int):
        seen = Counter(c for t in texts for c in t.lower() if c.isalpha())
        known = sorted(sorted(seen), key=lambda c: -seen[c])[:alphabet]
        number = {c: i for i, c in enumerate(known, FIRST_LETTER)}
        self.width = FIRST_LETTER + len(known)
        self.classes = np.full(0x110000, SPACE, np.uint8)
        self.spelled = np.zeros(0x110000, np.int32)
        for code in range(0x110000):
            letter = chr(code)
            if letter.isalpha():
                low = letter.lower()[0]
                self.classes[code] = number.get(low, OTHER)
                self.spelled[code] = ord(low)

    def symbols(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all texts, runs of non-letters as one space, and the end of each text."""
        lengths = np.array([len(t) if t else 0 for t in texts], np.int64)
        codes = np.frombuffer("".join(t for t in texts if t).encode("utf-32-le", "surrogatepass"), np.uint32)
        symbols = self.classes[codes]
        ends = np.cumsum(lengths)
        keep = symbols != SPACE
        keep[1:] |= symbols[:-1] != SPACE
        keep[(ends - lengths)[lengths > 0]] = True
        codes, symbols = codes[keep], symbols[keep]
        ends = np.r_[0, np.cumsum(keep)][ends]
        other = np.flatnonzero(symbols == OTHER)
        if not len(other):
            return symbols, ends
        n = np.where(symbols == OTHER, DIGITS, 1)
        upto = np.r_[0, np.cumsum(n)]
        out = np.repeat(symbols, n)
        code = self.spelled[codes[other]]
        for place in range(DIGITS):
            digit = (code >> (BASE_BITS * (DIGITS - 1 - place))) & (BASE - 1)
            out[upto[other] + place] = digit + (LATER_DIGIT if place else FIRST_DIGIT)
        return out, upto[ends]


def shared_out(lengths: list[int], total: int) -> list[int]:
    """How much each gives so that all give ``total``, or all they have, and none that has more gives
    less than another.
    """
    given, left = [0] * len(lengths), total
    for place, i in enumerate(sorted(range(len(lengths)), key=lambda i: lengths[i])):
        given[i] = min(lengths[i], left // (len(lengths) - place))
        left -= given[i]
    return given


class CrossParser:
    """The automata of all languages in one table.

    An entry is the offset of the next state's entries, times 4, plus the pieces that end there.
    """

    def __init__(
        self, references: dict[str, list[str]], symbols: int, alphabet: int, table_bytes: int = 1 << 30,
    ):
        self.languages = sorted(references)
        self.letters = Letters([t for name in self.languages for t in references[name]], alphabet)
        self.width = self.letters.width
        self.roots, self.bits, automata, size = [], [], [], 0
        for name in self.languages:
            own, ends = self.letters.symbols(references[name])
            starts = np.r_[0, ends[:-1]]
            given = shared_out((ends - starts).tolist(), symbols)
            parts = [[*own[a:a + n].tolist(), SPACE] for a, n in zip(starts.tolist(), given)]
            sequence = [s for part in parts for s in part]
            automata.append((SuffixAutomaton(sequence), size))
            self.roots.append(size)
            self.bits.append(math.log2(len(sequence) + 2))
            size += len(automata[-1][0].next) * self.width
        # An entry's low bits count pieces.
        kind = np.int32 if 4 * size + 3 < 1 << 31 else np.int64
        if size * np.dtype(kind).itemsize > table_bytes:
            raise ValueError(f"{len(self.languages)} languages need a table of over {table_bytes} bytes; learn fewer symbols")
        self.table = np.zeros(size, kind)
        while automata:
            self._fill(*automata.pop())

    def _fill(self, automaton: SuffixAutomaton, base: int) -> None:
        """The automaton's part of the table, some states at a time: the driver's memory is small."""
        width = self.width
        root = np.full(width, -1, np.int64)
        root[list(automaton.next[0])] = list(automaton.next[0].values())
        again = np.where(root >= 0, (root * width + base) * 4 + 1, base * 4 + 2)
        for first in range(0, len(automaton.next), STATES):
            states = automaton.next[first:first + STATES]
            moves = np.full((len(states), width), -1, np.int64)
            for state, arcs in enumerate(states):
                for symbol, to in arcs.items():
                    moves[state, symbol] = to
            entries = np.where(moves >= 0, (moves * width + base) * 4, again)
            if first == 0:
                entries[0] = np.where(root >= 0, (root * width + base) * 4, base * 4 + 1)
            at = base + first * width
            self.table[at:at + entries.size] = entries.ravel()

    def pieces(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Pieces that each language (row) needs for each text (column)."""
        lengths = np.diff(np.r_[0, ends])
        order = np.argsort(-lengths, kind="stable")
        begin, length = (ends - lengths)[order], lengths[order]
        at = np.repeat(np.array(self.roots, self.table.dtype)[:, None], len(order), 1)
        count = np.zeros(at.shape, np.int64)
        step = 0
        while step < length[:1].sum() and (n := int(np.searchsorted(-length, -step, side="left"))) >= FEW:
            entry = self.table[at[:, :n] + symbols[begin[:n] + step]]
            count[:, :n] += entry & 3
            at[:, :n] = entry >> 2
            step += 1
        table = memoryview(self.table)
        for i in range(int(np.searchsorted(-length, -step, side="left"))):
            rest = symbols[begin[i] + step:begin[i] + length[i]].tolist()
            for row in range(len(self.roots)):
                state, n = int(at[row, i]), 0
                for symbol in rest:
                    entry = table[state + symbol]
                    n += entry & 3
                    state = entry >> 2
                at[row, i] = state
                count[row, i] += n
        count += at != np.array(self.roots)[:, None]
        total = np.empty_like(count)
        total[:, order] = count
        return total

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, pieces per symbol and number of letter symbols of each text."""
        symbols, ends = self.letters.symbols(texts)
        lengths = np.diff(np.r_[0, ends])
        letters = np.diff(np.r_[0, np.r_[0, np.cumsum(symbols != SPACE)][ends]])
        names = ["und"] * len(texts)
        score, rate = np.zeros(len(texts)), np.zeros(len(texts))
        if not self.languages:
            return names, score, rate, letters
        pieces = self.pieces(symbols, ends)
        cost = pieces * np.array(self.bits)[:, None]
        best = np.argmin(cost, axis=0)
        ranked = np.sort(cost, axis=0)
        for i in np.flatnonzero(letters > 0):
            names[i] = self.languages[best[i]]
            rate[i] = pieces[best[i], i] / lengths[i]
            score[i] = 1.0 - ranked[0, i] / ranked[1, i] if len(ranked) > 1 else 1.0
        return names, score, rate, letters


def learn_languages(
    labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    docs_per_language: int = 48, symbols: int = 24576, alphabet: int = 96, table_bytes: int = 1 << 30,
) -> CrossParser:
    """A parser from the rows with a text and a language.

    The sample: at most ``docs_per_language`` documents of each language reach the driver, and of each
    at most ``symbols`` characters. Letters beyond the ``alphabet`` are spelled, not lost.
    """
    rows = labelled.select(
        labelled[id_col].alias("doc_id"), labelled[text_col].alias("text"), labelled[lang_col].alias("lang")
    ).where("lang IS NOT NULL AND text IS NOT NULL")
    chosen = rows.select("lang", "doc_id").withColumn("place", F.row_number().over(_in_order())).where(
        F.col("place") <= docs_per_language
    )
    texts = rows.join(F.broadcast(chosen.select("lang", "doc_id").distinct()), ["lang", "doc_id"]).select(
        "lang", "doc_id", F.substring("text", 1, symbols).alias("text")
    )
    again = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
    texts = texts.withColumn("place", F.row_number().over(again)).where(F.col("place") <= docs_per_language)
    references: dict[str, list[str]] = {}
    for row in texts.orderBy("lang", "place").toLocalIterator():
        references.setdefault(row.lang, []).append(row.text)
    return CrossParser(references, symbols, alphabet, table_bytes)


def _in_order() -> Window:
    return Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")


#: Values that the driver takes to find one by rank.
FEW_VALUES = 10_000


def exact_percentile(values: DataFrame, column: str, share: float) -> float:
    """What ``percentile`` gives, without holding the values in one task.

    Counts by bin narrow the range that holds the rank until few values, or one, are left.
    """
    n, low, high = values.agg(F.count(column), F.min(column), F.max(column)).first()

    def at_rank(rank: int) -> float:
        least, most, inside, before = low, high, n, 0
        own = values.where(F.col(column).isNotNull())
        while least < most and inside > FEW_VALUES:
            own = values.where(F.col(column).between(least, most))
            place = F.floor((F.col(column) - least) / (most - least) * 1024).alias("bin")
            bins = own.groupBy(place).agg(F.count("*").alias("n"), F.min(column).alias("least"), F.max(column).alias("most"))
            for found in bins.orderBy("bin").collect():
                if rank < before + found.n:
                    break
                before += found.n
            least, most, inside = found.least, found.most, found.n
        if least == most:
            return least
        left = values.where(F.col(column).between(least, most)).select(column).collect()
        return sorted(row[0] for row in left)[rank - before]

    position = (n - 1) * share
    down, up = math.floor(position), math.ceil(position)
    if down == up or (one := at_rank(down)) == (two := at_rank(up)):
        return at_rank(down) if down == up else one
    return (up - position) * one + (position - down) * two


def rejection_limit(
    labelled: DataFrame, parser: CrossParser, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    docs_per_language: int = 48, least_letters: int = 40, least_rows: int = 50, margin: float = 1.5,
) -> float | None:
    """Pieces per symbol beyond which a text of ``least_letters`` and more is in none of the languages.

    Calibrated on all labelled documents but those that the languages were learned from. The limit is
    ``margin`` times what 999 of 1,000 of them stay under; None, for no limit, with fewer than
    ``least_rows`` of them.
    """
    known = labelled.select(
        labelled[id_col].alias("doc_id"), labelled[text_col].alias("text"), labelled[lang_col].alias("lang")
    ).where("lang IS NOT NULL AND text IS NOT NULL")
    learned = known.select("lang", "doc_id").withColumn("place", F.row_number().over(_in_order())).where(
        F.col("place") <= docs_per_language
    )
    rest = known.join(F.broadcast(learned.select("lang", "doc_id").distinct()), ["lang", "doc_id"], "left_anti")
    parsed = predict_languages(rest, parser).where(F.col("letters") >= least_letters)
    rates = written(parsed.select("pieces_per_symbol"), "language-rates")
    if rates.count() < least_rows:
        return None
    return margin * exact_percentile(rates, "pieces_per_symbol", 0.999)


def predict_languages(
    docs: DataFrame, parser: CrossParser, id_col: str = "doc_id", text_col: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Per document: ``doc_id``, ``text``, ``lang_pred``, ``score`` (lead of the winner over the
    next language), ``pieces_per_symbol`` and ``letters`` (their symbols), and the carried columns in
    ``rest``.
    """
    docs = narrow(docs, id_col, text_col, carry)
    shared = docs.sparkSession.sparkContext.broadcast(vars(parser))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = CrossParser.__new__(CrossParser)
        vars(own).update(shared.value)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            total = np.cumsum([len(t) if t else 0 for t in texts])
            start = 0
            while start < len(texts):
                before = total[start - 1] if start else 0
                stop = int(np.searchsorted(total, before + BATCH, side="right"))
                stop = min(max(stop, start + 1), len(texts))
                names, score, rate, letters = own.predict(texts[start:stop])
                part = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(names, pa.string()), pa.array(score), pa.array(rate), pa.array(letters)],
                    [*part.schema.names, "lang_pred", "score", "pieces_per_symbol", "letters"],
                )
                start = stop

    schema = T.StructType(list(docs.schema.fields)).add("lang_pred", "string").add("score", "double")
    return docs.mapInArrow(run, schema.add("pieces_per_symbol", "double").add("letters", "long"))


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning: CRC-32 of its id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
