"""Toxicity by a weighted finite-state grammar over clauses.

Words pass through five transducers: insults and threats (weights learned from labels, on
whole words and on stems), targets, negations and reported speech (short word lists).
Their composition walks each clause once: a term scores its weight, more after a target,
less within reach of a negation, less in reported speech; a clause without a term scores
nothing. Clause scores, not isolated words, make the document's evidence, and a logistic
curve fitted on the labelled sample turns it into a score.

Null and empty texts have no clause and take the curve's lowest score. Rows that repeat
are scored each by itself; without labels every score is 0; an empty table gives an
empty result; columns other than id and text never take part in a score.
"""

from __future__ import annotations

import dataclasses
import functools
import math
import pickle
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import CACHE_ENTRIES, batches_of, id_text, quoted, rows_of, ship, stored

#: Labelled documents, on average, that the grammar is learned from: the bound of the sample.
SAMPLE_DOCS = 16_000

#: Evidence (documents times log odds) and log odds that make a word or stem a term.
LEAST_EVIDENCE, LEAST_ODDS = 18.0, 3.0

#: Lengths of stems in characters.
STEMS = range(4, 9)

# Fixed word lists of the transducers, English, French, German, Spanish.
TARGETS = frozenset("you your you're yourself they them he she these those people tu toi vous votre ils elles du dich "
                    "dein ihr euch sie tú usted ustedes ellos ellas".split())
NEGATIONS = frozenset("not never no isn't aren't wasn't don't nobody pas jamais aucun nicht kein keine nie nunca jamás".split())
REPORTS = frozenset("said says say wrote claims claimed quoted reported allegedly dit écrit selon sagte sagt schrieb "
                    "laut dijo dice según".split())
AFTER_TARGET, NEGATED, REPORTED = 1.25, 0.6, 0.75
#: Words that a negation reaches.
REACH = 3

_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
_CLAUSE = re.compile(r"[.!?;\n]+")


@dataclasses.dataclass
class Grammar:
    """Weights by whole word, by stem, and by stem found with two endings or more; and the curve."""

    words: dict[str, float]
    stems: dict[str, float]
    paired: dict[str, float]
    curve: tuple[float, ...] = (0.0, 0.0, 0.0, -30.0)

    def __post_init__(self) -> None:
        self.known: dict[str, tuple[float, tuple[str, ...]]] = {}

    def term(self, word: str) -> tuple[float, tuple[str, ...]]:
        """The best weight of a word, and its stems that count in pairs."""
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= CACHE_ENTRIES:
                self.known.clear()
            heads = [word[:n] for n in STEMS if n < len(word)]
            found = self.known[word] = (max([self.words.get(word, 0.0), *(self.stems.get(h, 0.0) for h in heads)]),
                                        tuple(h for h in heads if h in self.paired))
        return found

    def evidence(self, text: str) -> tuple[float, float, float]:
        """Sum and largest of the clause scores, and the sum for a hundred words."""
        lowered = text.lower()
        words = _WORD.findall(lowered)
        terms = {w: found for w in set(words) if (found := self.term(w))[0] or found[1]}
        if not terms:
            return 0.0, 0.0, 0.0
        endings = Counter(head for _, heads in terms.values() for head in heads)
        weights = {w: best for w, (own, heads) in terms.items()
                   if (best := max([own, *(self.paired[h] for h in heads if endings[h] > 1)]))}
        scores = [score for clause in _CLAUSE.split(lowered) if (score := clause_score(_WORD.findall(clause), weights))]
        total = sum(scores)
        return min(total, 60.0), max(scores, default=0.0), min(100 * total / len(words), 60.0)

    def score(self, text: str) -> float:
        *slopes, level = self.curve
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, sum(s * x for s, x in zip(slopes, self.evidence(text), strict=True)) + level))))


def clause_score(words: list[str], weights: dict[str, float]) -> float:
    """The composed transducers over one clause. The state is whether a target and reported
    speech have been met, and how many words a negation still reaches."""
    target, reported, reach, score = False, False, 0, 0.0
    for word in words:
        if word in NEGATIONS:
            reach = REACH + 1
        elif word in TARGETS:
            target = True
        elif word in REPORTS:
            reported = True
        elif weight := weights.get(word):
            score += weight * (AFTER_TARGET if target else 1) * (NEGATED if reach else 1) * (REPORTED if reported else 1)
        reach = max(0, reach - 1)
    return score


def features(text: str) -> set[str]:
    """Words (``=``), stems (``-``) and stems with two endings or more (``+``) of a text."""
    words = set(_WORD.findall(text.lower()))
    heads = Counter(word[:n] for word in words for n in STEMS if n < len(word))
    return {"=" + w for w in words} | {"-" + h for h in heads} | {"+" + h for h, n in heads.items() if n > 1}


def learn(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> Grammar:
    """Learn terms and curve from about ``sample_docs`` labelled documents, equal texts once."""
    ship(docs.sparkSession)
    marks = labels.select(F.col(quoted(id_col)).cast("long").alias("id"), (F.col(quoted(label_col)) > 0).alias("toxic")).dropna()
    marks = marks.groupBy("id").agg(F.max("toxic").alias("toxic"))
    rate = min(1.0, sample_docs / max(1, marks.count()))
    marks = marks.filter(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 30)) < rate * (1 << 30))
    sample = id_text(docs, id_col, text_col).filter("text is not null").join(marks, "id")
    sample = stored(sample.groupBy(F.sha2("text", 256).alias("same")).agg(
        F.first("text").alias("text"), F.max("toxic").alias("toxic")).drop("same"), "toxic-sample")
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(True, 0), sizes.get(False, 0)
    if not toxic or not clean:
        return Grammar({}, {}, {})
    schema = pa.schema([("feature", pa.string()), ("bad", pa.int64()), ("good", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            counts: tuple[Counter, Counter] = Counter(), Counter()
            for text, mark in rows_of(batches, "text", "toxic"):
                counts[mark].update(features(text.decode()))
                if len(counts[0]) > CACHE_ENTRIES // 2:
                    yield from ((f, counts[1][f], counts[0][f]) for f in counts[0].keys() | counts[1].keys())
                    counts[0].clear(), counts[1].clear()
            yield from ((f, counts[1][f], counts[0][f]) for f in counts[0].keys() | counts[1].keys())
        yield from batches_of(out(), schema)

    odds = F.log((F.col("bad") + 0.5) / (toxic + 1)) - F.log((F.col("good") + 0.5) / (clean + 1))
    terms = (sample.mapInArrow(count, "feature string, bad long, good long").groupBy("feature")
             .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).withColumn("odds", odds)
             .filter((F.col("odds") >= LEAST_ODDS) & (F.col("odds") * F.col("bad") >= LEAST_EVIDENCE)))
    found: dict[str, dict[str, float]] = {"=": {}, "-": {}, "+": {}}
    for row in terms.select("feature", "odds").collect():  # at most the words of the sample's toxic texts
        found[row["feature"][0]][row["feature"][1:]] = row["odds"]
    grammar = Grammar(found["="], found["-"], found["+"])
    shown = _scored(sample.select("text", "toxic"), grammar)
    return dataclasses.replace(grammar, curve=fitted(np.array([tuple(r) for r in shown.collect()], float)))


def _scored(sample: DataFrame, grammar: Grammar) -> DataFrame:
    schema = pa.schema([("a", pa.float64()), ("b", pa.float64()), ("c", pa.float64()), ("toxic", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches_of(((*grammar.evidence(text.decode()), mark) for text, mark in rows_of(batches, "text", "toxic")), schema)

    return sample.mapInArrow(run, "a double, b double, c double, toxic boolean")


def fitted(rows: np.ndarray, decay: float = 1.0, steps: int = 30) -> tuple[float, ...]:
    """Slopes and level of a logistic curve, by Newton's method with a small decay."""
    x, y = np.hstack([rows[:, :3], np.ones((len(rows), 1))]), rows[:, 3]
    weights = np.zeros(4)
    penalty = np.diag([decay, decay, decay, 0.01])

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((np.logaddexp(0, z) - y * z).sum() + w @ penalty @ w / 2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ weights)
        size = 1.0
        while size > 1e-6 and loss(weights + size * step) > loss(weights):
            size /= 2
        weights = weights + size * step
    return tuple(float(w) for w in weights)


@functools.lru_cache(maxsize=1)  # a worker that is used again drops the grammar before
def _loaded(state: bytes) -> Grammar:
    return pickle.loads(state)


def scored(docs: DataFrame, grammar: Grammar, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every text."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
    grammar.known.clear()
    state = docs.sparkSession.sparkContext.broadcast(pickle.dumps(grammar))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _loaded(state.value)
        yield from batches_of(((doc_id, own.score(text.decode())) for doc_id, text in rows_of(batches, "id", "text")), schema)
        own.known.clear()

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")


def filtered(docs: DataFrame, grammar: Grammar, most: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``most``, with all their columns."""
    ship(docs.sparkSession)
    columns = docs.columns
    place = columns.index(text_col)
    named = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    grammar.known.clear()
    state = docs.sparkSession.sparkContext.broadcast(pickle.dumps(grammar))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _loaded(state.value)
        for batch in batches:
            yield batch.filter(pa.array([own.score(text or "") < most for text in batch.column(place).to_pylist()], pa.bool_()))
        own.known.clear()

    return named.mapInArrow(run, named.schema).toDF(*columns)
