"""Toxicity by weak supervision.

Voters are the words and word beginnings that toxic rows hold much more often than others, and
patterns of writing (shouting, exclamation marks, symbols). A generative model of two classes
estimates by expectation maximisation, from the majority vote on, how often each voter fires in
either class and how it depends on the voter it errs with; the row's label votes too, as an
annotator of unknown accuracy. A voter that repeats another so adds nothing. A linear classifier on
the presence of words and beginnings is then trained on the model's posterior labels, and scores
every document by itself.

Learning uses a bounded sample of labelled rows: about ``max_rows``, chosen by the hash of their
ids. Spark counts terms and fetches features of these rows; only votes and the numbers of their
terms reach the driver. The classifier has a fixed size: ``n_terms`` features, the most telling of
the terms in ``least`` toxic rows of the sample and more (of the ``40 * n_terms`` commonest of
those), and ``n_voters`` of them vote. Scoring is one pass over all texts without a shuffle.

Defined results: a null or empty text, and one of no known term, gets the score of the intercept;
texts that are equal score alike, repeated rows too. A long text is read whole. Repeated labels of a
document count as the largest. Where the sample has toxic rows only, every score is nearly 1; with
clean rows only, or none, it is nearly 0. An empty table gives an empty table. Other columns of either
table are not read, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runtrail.llm.common import narrow, written

WORD = re.compile(r"[^\W\d_]+")
#: Lengths of the word beginnings that count as terms; their names end in ``*``.
STEMS = (4, 5, 6)
PATTERNS = ("shouting", "exclaiming", "symbols")


def terms_of(text: str | None) -> set[str]:
    """The words of a text in lower case, and their beginnings."""
    words = set(WORD.findall(text.lower())) if text else set()
    return words.union(*[{w[:n] + "*" for w in words if len(w) >= n} for n in STEMS])


def patterns_of(text: str | None) -> tuple[bool, ...]:
    if not text:
        return (False,) * len(PATTERNS)
    n = len(text)
    return (
        sum(map(str.isupper, text)) > 0.3 * n, 50 * text.count("!") > n,
        20 * sum(map(text.count, "#*$%&")) > n,
    )


class TermIndex:
    """Numbers of known terms, looked up word by word."""

    def __init__(self, terms: list[str]):
        self.words = {t: i for i, t in enumerate(terms) if not t.endswith("*")}
        self.stems = [
            (n, {t[:-1]: i for i, t in enumerate(terms) if t.endswith("*") and len(t) == n + 1}) for n in STEMS
        ]

    def numbers(self, text: str | None) -> set[int]:
        found: set[int] = set()
        if not text:
            return found
        for w in set(WORD.findall(text.lower())):
            if (i := self.words.get(w)) is not None:
                found.add(i)
            for n, stems in self.stems:
                if (i := stems.get(w[:n])) is not None:
                    found.add(i)
        return found


def term_counts(sample: DataFrame, known: list[str] | None = None) -> DataFrame:
    """In how many of the rows each term is (of the known ones only, if given)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        index = None if known is None else TermIndex(known)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                seen.update(terms_of(text) if index is None else (known[i] for i in index.numbers(text)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["term", "n"]
        )

    return sample.select("text").mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def spanning_forest(gain: np.ndarray, least: float) -> np.ndarray:
    """The parent of each node in the forest of the largest gains above ``least``; -1 for roots."""
    n = len(gain)
    parent, best, nearest = np.full(n, -1), np.full(n, least), np.full(n, -1)
    left = np.ones(n, bool)
    for _ in range(n):
        # Nodes that no gain above the limit ties to the forest so far start trees of their own.
        node = int(np.argmax(np.where(left, best, -np.inf)))
        parent[node], left[node] = nearest[node], False
        closer = left & (gain[node] > best)
        best[closer], nearest[closer] = gain[node][closer], node
    return parent


class LabelModel:
    """A generative model of two classes, voters that err together, and an annotator.

    Given the class, each voter depends on at most one other, its parent in a forest, so ``fires``
    holds how often it fires by class and by its parent's vote: rates given a silent parent and a
    firing one. The forest joins the pairs with the most mutual information given the class, where
    that pays for its parameters (Bayesian information criterion). ``alone`` holds how often each
    voter fires by class, ``annotator`` how often the label is 1, ``prior`` how common a class is.
    """

    def __init__(self, votes: np.ndarray, labels: np.ndarray, p: np.ndarray):
        """The most likely parameters, if ``p`` is each row's probability of being toxic."""
        n, m = votes.shape
        weight = np.stack([1 - p, p])
        total = weight.sum(1)
        self.prior = (total + 1) / (n + 2)
        self.annotator = (weight @ (labels == 1) + 0.5) / (total + 1)
        # In how many rows of a class both of two voters fire; one of them; neither.
        both = np.stack([votes.T @ (w[:, None] * votes) for w in weight])
        one = np.einsum("cii->ci", both)
        self.alone = (one + 0.5) / (total[:, None] + 1)
        gain = np.zeros((m, m))
        for c in (0, 1):
            mine, other = one[c][:, None], one[c][None, :]
            for seen, a, b in (
                (both[c], mine, other), (mine - both[c], mine, total[c] - other),
                (other - both[c], total[c] - mine, other),
                (total[c] - mine - other + both[c], total[c] - mine, total[c] - other),
            ):
                some = np.maximum(seen, 1e-9)
                gain += some * np.log(some * max(total[c], 1e-9) / np.maximum(a * b, 1e-9))
        np.fill_diagonal(gain, -np.inf)
        self.parent = spanning_forest(gain, math.log(max(n, 2)))
        child = np.flatnonzero(self.parent >= 0)
        above = self.parent[child]
        self.fires = np.stack([self.alone, self.alone], 1)
        together, own, over = both[:, child, above], one[:, child], one[:, above]
        seen = np.stack([own - together, together], 1)
        of = np.stack([total[:, None] - over, over], 1)
        self.fires[:, :, child] = (seen + self.alone[:, None, child]) / (of + 1)

    def posterior(self, votes: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """Probability that each row is toxic."""
        on, off = np.log(self.fires), np.log1p(-self.fires)
        fired, silent = on[1] - on[0], off[1] - off[0]
        above = np.where(self.parent >= 0, votes[:, self.parent], 0)
        odds = silent[0].sum() + votes @ (fired[0] - silent[0]) + above @ (silent[1] - silent[0])
        odds += (votes * above) @ (fired[1] - silent[1] - fired[0] + silent[0])
        said = np.where((labels == 1)[:, None], self.annotator, 1 - self.annotator)
        odds += np.log(self.prior[1] / self.prior[0]) + np.log(said[:, 1] / said[:, 0])
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def label_model(votes: np.ndarray, labels: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, LabelModel]:
    """Expectation maximisation from the majority vote: each row's probability of being toxic, and the model.

    ``votes`` holds 1 where a voter (column) fires on a row. For the first vote alone, firing voters
    and a label of 1 count for toxic, a label of 0 and the silence of all voters against it. The toxic
    class is the one that the label agrees with.
    """
    yes = votes.sum(1) + (labels == 1)
    p = (1 + yes) / (2 + yes + (labels == 0) + ~votes.any(1))
    model = LabelModel(votes, labels, p)
    for _ in range(rounds):
        before, p = p, model.posterior(votes, labels)
        if model.annotator[1] < model.annotator[0]:
            p = 1 - p
        model = LabelModel(votes, labels, p)
        if np.abs(p - before).max(initial=0) < 1e-6:
            break
    return p, model


def fit_linear(rows: list[np.ndarray], target: np.ndarray, size: int, steps: int = 600, penalty: float = 3e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on sets of features, by accelerated gradient steps."""
    n = len(rows)
    flat = np.concatenate(rows).astype(np.int64)
    of_row = np.repeat(np.arange(n), [len(r) for r in rows])
    across = lambda v, c: c + np.bincount(of_row, v[flat], n)
    back = lambda e: (np.bincount(flat, e[of_row], size) / n, e.mean())
    v, c = np.ones(size), 1.0
    for _ in range(12):  # the largest eigenvalue bounds the step
        length = math.sqrt(v @ v + c * c)
        v, c = back(across(v / length, c / length))
    step = 1 / (0.3 * math.sqrt(v @ v + c * c) + penalty)
    w, b = np.zeros(size), 0.0
    v, c = w.copy(), b
    for t in range(steps):
        error = 1 / (1 + np.exp(-np.clip(across(v, c), -30, 30))) - target
        down, down_b = back(error)
        new, new_b = v - step * (down + penalty * v), c - step * down_b
        speed = t / (t + 3)
        v, c = new + speed * (new - w), new_b + speed * (new_b - b)
        w, b = new, new_b
    return w, b


class ToxicModel:
    """Terms, their weights and an intercept."""

    def __init__(self, terms: list[str], weights: np.ndarray, intercept: float):
        self.terms, self.weights, self.intercept = terms, weights, intercept

    def scorer(self):
        index = TermIndex(self.terms)

        def score(text: str | None) -> float:
            odds = self.intercept + sum(self.weights[i] for i in index.numbers(text))
            return 1 / (1 + math.exp(-min(30.0, max(-30.0, odds))))

        return score


def learn_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    max_rows: int = 20000, n_terms: int = 1500, n_voters: int = 120, least: int = 3,
) -> ToxicModel:
    """A model from the labelled rows; ``labels`` has an id and a label of 0 or 1."""
    plain = labels.select(labels[id_col].alias("doc_id"), labels[label_col].alias("label"))
    known = plain.where("label IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label"))
    share = min(1.0, max_rows / max(1, known.count()))
    # 2**53 steps, so that the share of a very long table does not round to nothing.
    ids = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 53)) < int(share * (1 << 53)))
    # About max_rows ids, so small enough to broadcast.
    sample = written(
        narrow(docs, id_col, text_col).join(F.broadcast(ids), "doc_id").select("text", "label"), "labelled-sample"
    )
    toxic, clean = sample.where("label = 1"), sample.where("label = 0")
    n_toxic, n_clean = toxic.count(), clean.count()
    if not n_toxic or not n_clean:
        return ToxicModel([], np.zeros(0), 30.0 if n_toxic else -30.0)
    most = 40 * n_terms
    candidates = term_counts(toxic).where(F.col("n") >= least).orderBy(F.desc("n"), "term").limit(most).collect()
    hits = {r.term: r.n for r in candidates}
    misses = {r.term: r.n for r in term_counts(clean, sorted(hits)).collect()}

    def strength(term: str) -> tuple[float, float]:
        """How much more often toxic rows hold the term, as a logarithm; and that by its weight."""
        often = math.log((hits[term] + 0.5) / (n_toxic + 1)) - math.log((misses.get(term, 0) + 0.5) / (n_clean + 1))
        return often, often * math.sqrt(hits[term])

    # Terms that either class holds as often say nothing, but would share the intercept.
    telling = [t for t in hits if abs(strength(t)[0]) > 0.7]
    ranked = sorted(telling, key=lambda t: (-abs(strength(t)[1]), t))[:n_terms]
    voters = [t for t in ranked if strength(t)[0] > 2.0][:n_voters]
    number = {t: i for i, t in enumerate(ranked)}
    pa_row = T.StructType().add("label", "integer").add("terms", T.ArrayType(T.IntegerType()))
    pa_row = pa_row.add("patterns", T.ArrayType(T.BooleanType()))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = TermIndex(ranked)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays([
                batch.column("label").cast(pa.int32()),
                pa.array([sorted(index.numbers(t)) for t in texts], pa.list_(pa.int32())),
                pa.array([patterns_of(t) for t in texts], pa.list_(pa.bool_())),
            ], ["label", "terms", "patterns"])

    table = sample.mapInArrow(features, pa_row).toArrow()
    rows = [np.array(t, np.int64) for t in table["terms"].to_pylist()]
    votes = np.zeros((len(rows), len(voters) + len(PATTERNS)))
    place = np.full(len(ranked), -1)
    place[[number[t] for t in voters]] = np.arange(len(voters))
    for i, row in enumerate(rows):
        fired = place[row]
        votes[i, fired[fired >= 0]] = 1
    votes[:, len(voters):] = np.array(table["patterns"].to_pylist(), float).reshape(len(rows), len(PATTERNS))
    target, _ = label_model(votes, table["label"].to_numpy())
    return ToxicModel(ranked, *fit_linear(rows, target, len(ranked)))


def score_toxicity(docs: DataFrame, model: ToxicModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``doc_id`` and ``score`` (probability that it is toxic)."""
    docs = narrow(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast((model.terms, model.weights.tolist(), float(model.intercept)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = ToxicModel(*shared.value).scorer()
        for batch in batches:
            scores = pa.array([score(t) for t in batch.column("text").to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], ["doc_id", "score"])

    return docs.mapInArrow(run, docs.select("doc_id").schema.add("score", "double"))


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning: CRC-32 of its id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
