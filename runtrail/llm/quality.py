"""Quality rules as a short-circuit cascade.

Each rule's cost and rejection rate are measured on a sample, drawn in one scan and written: the
best of some rounds, less what an empty trial takes. The rules are then tried in the order of
rejections per second, those that reject nothing last and the cheaper first; the first that rejects
a document ends its trial. The order never changes a verdict, only the time. The whole cascade is
one expression, and every rule holds its own measures within its branch, so that none is taken
before its rule's turn comes, whatever the order. Only a caller who asks for the measures as columns
has them taken for every row; with ``reported`` the rules read those instead of their own, and just
the measures that are not reported wait for their turn.

All measures are column expressions over one row: nothing is exploded or shuffled. Repeated
5-word windows are found by hashing the windows of a text and counting distinct hashes; only a
text that has repeats sorts them to find the covered words.

Defined results: a null or empty text has no words and is rejected; texts of any length are judged
whole; repeated rows are judged alike; rules that tie are tried by name; an empty table gives an
empty table. Further columns are only carried, under ``rest``, so none clashes.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runtrail.llm.common import BLANKS, narrow, words_of, written

SYMBOLS = "#*$%&|<>"
#: The measures that are reported; ``n_letter_words``, the words with a letter, is not.
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
LETTER = "\\p{L}"


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeat_words(words: Column, width: int = 5) -> Column:
    """Words covered by windows of ``width`` words that the text holds twice or more."""

    def hashes(w):
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - width),
            lambda i: F.xxhash64(*[F.get(w, i + d) for d in range(width)]),
        )

    def covered(h):
        return _let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), starts)

    def starts(s):
        def start(row, j):
            same = F.lit(False)
            for other in (F.get(s, j - 1), F.get(s, j + 1)):
                same = same | F.coalesce(other["h"] == row["h"], F.lit(False))
            return F.when(same, row["i"])

        return F.aggregate(
            F.array_sort(F.array_compact(F.transform(s, start))),
            F.struct(F.lit(-width).alias("last"), F.lit(0).alias("n")),
            lambda acc, i: F.struct(
                i.alias("last"), (acc["n"] + F.least(F.lit(width), i - acc["last"])).alias("n")
            ),
            lambda acc: acc["n"],
        )

    def count(h):
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))

    return F.when(F.size(words) > width, _let(words, lambda w: _let(hashes(w), count))).otherwise(F.lit(0))


def measures(text: Column, words: Column) -> dict[str, Column]:
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    found = {
        "n_words": F.size(words),
        "word_chars": F.length(F.translate(text, BLANKS, "")),
        "n_symbols": F.length(text) - F.length(F.translate(text, SYMBOLS, "")),
        "n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))),
        "n_repeat_words": repeat_words(words),
        "n_letter_words": F.size(F.filter(words, lambda w: F.rlike(w, F.lit(LETTER)))),
    }
    return {name: column.cast("long") for name, column in found.items()}


@dataclass(frozen=True)
class Rule:
    """Rejects where ``rejects`` of the named measures holds."""

    name: str
    needs: tuple[str, ...]
    rejects: Callable[[Mapping[str, Column]], Column]
    base: bool = False

    def over(self, found: Mapping[str, Column]) -> Column:
        """Whether it rejects; each measure it needs is taken once."""
        return _let(F.struct(*[found[m].alias(m) for m in self.needs]), self.rejects)


RULES = (
    Rule("few_words", ("n_words",), lambda m: m["n_words"] < 10, base=True),
    Rule("repeats", ("n_words", "n_repeat_words"), lambda m: 100 * m["n_repeat_words"] > 20 * m["n_words"], base=True),
    Rule("symbols", ("n_words", "n_symbols"), lambda m: 10 * m["n_symbols"] > m["n_words"]),
    Rule(
        "word_length", ("n_words", "word_chars"),
        lambda m: (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 15 * m["n_words"]),
    ),
    Rule(
        "dup_lines", ("n_words", "n_dup_lines"),
        lambda m: (m["n_dup_lines"] > 3) & (20 * m["n_dup_lines"] > m["n_words"]),
    ),
    Rule("letterless", ("n_words", "n_letter_words"), lambda m: 2 * m["n_letter_words"] < m["n_words"]),
)


def order_rules(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 2000, rounds: int = 2,
) -> list[Rule]:
    """Rules by rejections per second, as measured on about ``sample_rows`` of ``docs``."""
    n = docs.count()
    drawn = docs.select("text").sample(min(1.0, sample_rows / max(n, 1)), seed=17)
    # A sample reads its whole input, so it is drawn once for all rules.
    sample = written(drawn, "quality-sample")
    found = measures(F.col("text"), F.col("words"))
    worded = sample.select("text", words_of(F.col("text")).alias("words"))

    def trial(test: Column) -> tuple[int, float]:
        counted, best = worded.agg(F.count_if(test)), float("inf")
        for _ in range(rounds):
            began = time.perf_counter()
            hits = counted.first()[0]
            best = min(best, time.perf_counter() - began)
        return hits, best

    _, empty = trial(F.size("words") < 0)
    worth = {}
    for rule in rules:
        hits, seconds = trial(rule.over(found))
        cost = max(seconds - empty, 0.01 * empty)
        worth[rule.name] = (-hits / cost, cost)
    return sorted(rules, key=lambda r: (*worth[r.name], r.name))


def rejected_by(ordered: list[Rule], found: Mapping[str, Column] | None = None) -> Column:
    """Name of the first rule in this order that rejects, else null.

    Without ``found`` the rules read the columns of the reported measures, and ``words``.
    """
    if found is None:
        found = measures(F.col("text"), words_of(F.col("text"))) | {m: F.col(m) for m in MEASURES}
    name = F.lit(None).cast("string")
    for rule in reversed(ordered):
        name = F.when(rule.over(found), F.lit(rule.name)).otherwise(name)
    return name


def judge_quality(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES,
    sample_rows: int = 2000, carry: tuple[str, ...] = (), reported: bool = False, order: list[Rule] | None = None,
) -> DataFrame:
    """Per document: ``doc_id``, ``text``, the five measures, ``base_failed``, ``kept`` and
    ``rejected_by`` (its value depends on the measured order, whether it is null does not).

    ``order`` takes the place of a measured one. ``reported`` suits a caller who takes the measures:
    the cascade then reads them, rather than taking them once more for itself.
    """
    docs = narrow(docs, id_col, text_col, carry)
    ordered = order_rules(docs, rules, sample_rows) if order is None else order
    text, words = F.col("text"), F.col("words")
    if reported:
        verdict = rejected_by(ordered, measures(text, words) | {m: F.col(m) for m in MEASURES})
    else:
        verdict = _let(words_of(text), lambda w: rejected_by(ordered, measures(text, w)))
    found = measures(text, words)
    measured = docs.withColumn("words", words_of(text)).select("*", *[found[m].alias(m) for m in MEASURES])
    base = F.lit(False)
    for rule in rules:
        if rule.base:
            base = base | rule.over(found | {m: F.col(m) for m in MEASURES})
    return measured.select(
        "doc_id", "text", *MEASURES, *(["rest"] if carry else []), base.alias("base_failed"), verdict.alias("rejected_by")
    ).withColumn("kept", F.col("rejected_by").isNull())  # the base rules are among the rules
