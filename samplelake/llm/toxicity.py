"""Toxicity: a learned lexicon, misspellings by Levenshtein automata, and scores of contexts.

Terms are the words that stand in toxic texts far more often than in others.  They are
kept in a trie; a word's Levenshtein automaton and the trie are walked together, so that
one walk finds the term a misspelled word stands for, if any.  Each term found counts
with what stands around it: other terms nearby raise it, quotation marks around it
lower it.  A logistic model of these sums, fitted to the same sample, gives the score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samplelake.llm.common import extended, held_out, schema_of, slices, take
from samplelake.staging import stage

# The labelled sample: so many texts of each label, by smallest hash of the id.
SAMPLE_TOXIC, SAMPLE_CLEAN = 4000, 8000
# Least likelihood-ratio statistic of a term, far beyond chance among many words.
LEAST_G2 = 25.0
# A word of at least so many letters may stand for a term with one edit, a swap included.
LEAST_FUZZY = 5
CONTEXT_WORDS, QUOTE_CHARS = 6, 60
QUOTES = "\"“”„«»‟‹›"
# Words a task remembers; when full it starts anew.
REMEMBERED = 500_000
_WORDS = re.compile(r"[^\W\d_]+")
# Signs and digits before a letter, as in "m0ron", and words with such inside.
_SIGN = re.compile(r"[0-9@$*!]++(?=[^\W\d_])")
_SIGNED = re.compile(r"[^\W\d_]++(?:[0-9@$*!]++[^\W\d_]++)*")

# Terms with their weights, then the coefficients of the logistic model.
Learned = tuple[dict[str, float], list[float]]


class Trie:
    """Terms, and the search for the nearest one by at most one edit."""

    def __init__(self, terms: dict[str, float]):
        self.terms = terms
        self.root: dict = {}
        # One edit leaves one end of a term as it is: the ends a word must share to be worth a walk.
        self.heads: dict[int, set[str]] = {}
        self.tails: dict[int, set[str]] = {}
        for term in sorted(terms):
            node = self.root
            for c in term:
                node = node.setdefault(c, {})
            node[""] = term
            if len(term) >= LEAST_FUZZY - 1:
                half = (len(term) - 1) // 2
                self.heads.setdefault(half, set()).add(term[:half])
                self.tails.setdefault(half, set()).add(term[-half:])
        self._known: dict[str, tuple[str, int] | None] = {}

    def find(self, word: str) -> tuple[str, int] | None:
        """The term a word stands for and its edits; None for other words."""
        if word in self._known:
            return self._known[word]
        if len(self._known) > REMEMBERED:
            self._known.clear()
        found = (word, 0) if word in self.terms else None
        if found is None and len(word) >= LEAST_FUZZY and self._may_match(word):
            near = min(self._walk(word), key=lambda t: (-self.terms[t], t), default=None)
            found = (near, 1) if near is not None else None
        self._known[word] = found
        return found

    def _may_match(self, word: str) -> bool:
        return any(word[:n] in s for n, s in self.heads.items()) or any(word[-n:] in s for n, s in self.tails.items())

    def _walk(self, word: str) -> set[str]:
        """Terms at one edit: states of the automaton are places in the word and edits made, at a trie node."""
        out, size = set(), len(word)
        states = [(self.root, 0, 0)]
        while states:
            node, at, edits = states.pop()
            if at == size and edits and "" in node:
                out.add(node[""])
            if at < size and word[at] in node:
                states.append((node[word[at]], at + 1, edits))
            if edits:
                continue
            if at + 1 == size and "" in node:
                out.add(node[""])  # the word's last letter is one too many
            if at < size:
                states.append((node, at + 1, 1))
            for c, below in node.items():
                if not c:
                    continue
                states.append((below, at, 1))
                if at < size and c != word[at]:
                    states.append((below, at + 1, 1))
                if at + 1 < size and c == word[at + 1] and c != word[at] and word[at] in below:
                    states.append((below[word[at]], at + 2, 1))
        return {t for t in out if len(t) >= LEAST_FUZZY - 1}

    def hits(self, text: str) -> list[tuple[int, int, int, str, int]]:
        """``place among words, start, end, term, edits`` of the terms in a lower-cased text."""
        known, find = self._known, self.find
        words = (_SIGNED if _SIGN.search(text) else _WORDS).findall(text)
        if all(map(str.isalpha, words)) and not any(known[w] if w in known else find(w) for w in words):
            return []
        # Asked again by find: remembering may have started anew meanwhile.
        out, place = [], 0
        for m in _SIGNED.finditer(text):
            word, start = m.group(), m.start()
            if not word.isalpha():
                hit = find(word)
                if hit:
                    out.append((place, start, m.end(), *hit))
                    place += 1
                    continue
            # A signed word that is no term counts as the plain words in it.
            for part in _WORDS.finditer(word):
                hit = find(part.group())
                if hit:
                    out.append((place, start + part.start(), start + part.end(), *hit))
                place += 1
        return out


def features(text: str | None, trie: Trie) -> list[float]:
    """Of a whole text: a constant, sums of exact and misspelled terms, of quoted ones, and terms per word."""
    lower = (text or "").lower()
    hits = trie.hits(lower)
    if not hits:
        return [1.0, 0.0, 0.0, 0.0, 0.0]
    exact = fuzzy = quoted = 0.0
    for k, (place, start, end, term, edits) in enumerate(hits):
        near = (k > 0 and place - hits[k - 1][0] <= CONTEXT_WORDS) + (
            k + 1 < len(hits) and hits[k + 1][0] - place <= CONTEXT_WORDS
        )
        score = trie.terms[term] * (1 + 0.25 * near)
        if _in_quotes(lower, start, end):
            quoted += score
        elif edits:
            fuzzy += score
        else:
            exact += score
    words = max(1, len(_WORDS.findall(lower)))
    return [1.0, math.log1p(exact), math.log1p(fuzzy), math.log1p(quoted), min(1.0, 10 * len(hits) / words)]


def _in_quotes(text: str, start: int, end: int) -> bool:
    """A quotation mark opens shortly before, on the same line, and one closes shortly behind."""
    before = text[max(0, start - QUOTE_CHARS) : start].rpartition("\n")[2]
    behind = text[end : end + QUOTE_CHARS].partition("\n")[0]
    return sum(before.count(q) for q in QUOTES) % 2 == 1 and any(q in behind for q in QUOTES)


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``toxic, text`` of a bounded sample outside the held-out fold, each distinct text once.

    The sample is chosen among labels alone and is small enough to be broadcast.  Of
    several labels of one document the toxic one counts; null ids and labels are left out.
    """
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64(F.col("doc_id").cast("string")), F.col("doc_id")]
    of = {1: SAMPLE_TOXIC, 0: SAMPLE_CLEAN}
    toxic, clean = (known.filter(F.col("toxic") == k).orderBy(*order).limit(n) for k, n in of.items())
    chosen = docs.join(F.broadcast(toxic.unionByName(clean)), "doc_id").filter("text IS NOT NULL")
    return chosen.groupBy(F.sha2(F.col("text").cast("binary"), 256).alias("h")).agg(
        F.max("toxic").alias("toxic"), F.min("text").alias("text")
    )


def learn(docs: DataFrame, labels: DataFrame) -> Learned:
    """The lexicon and the model from ``doc_id, text`` and ``doc_id, toxic``.

    Words are counted in Spark; the terms that pass both thresholds, which the bounded
    sample keeps few, and the sample's features, five numbers a text, come to the driver.
    Without texts of both labels every score is 0.
    """
    sample = stage(labelled_sample(docs, labels), "labelled")
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return {}, []

    def distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [sorted(set(_WORDS.findall(t.as_py().lower()))) for t in batch.column("text")]
            yield extended(batch, ["text", "h"], {"words": pa.array(found, pa.list_(pa.string()))})

    words = sample.mapInArrow(distinct_words, "toxic int, words array<string>")
    counts = words.select("toxic", F.explode("words").alias("word")).groupBy("word")
    counts = counts.agg(F.sum("toxic").cast("double").alias("a"), F.sum(1 - F.col("toxic")).cast("double").alias("c"))
    a, c = F.col("a"), F.col("c")
    both, share = a + c, n_toxic / (n_toxic + n_clean)

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    g2 = 2 * (
        part(a, both * share)
        + part(c, both * (1 - share))
        + part(n_toxic - a, n_toxic - both * share)
        + part(n_clean - c, n_clean - both * (1 - share))
    )
    weight = F.log((a + 0.5) / (n_toxic - a + 0.5)) - F.log((c + 0.5) / (n_clean - c + 0.5))
    rows = (
        counts.withColumns({"g2": g2, "weight": weight})
        .filter((F.col("g2") >= LEAST_G2) & (F.col("weight") >= math.log(8)) & (F.length("word") > 2))
        .select("word", "weight")
        .collect()
    )
    terms = {r["word"]: r["weight"] for r in rows}
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(shared.value)
        for batch in slices(batches):
            found = [features(t.as_py(), trie) for t in batch.column("text")]
            yield extended(batch, ["text", "h"], {"x": pa.array(found, pa.list_(pa.float64()))})

    seen = sorted(sample.mapInArrow(run, "toxic int, x array<double>").collect())
    return terms, _logistic(np.array([r["x"] for r in seen]), np.array([r["toxic"] for r in seen], float))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> list[float]:
    """Coefficients by Newton's method with a small ridge, which also holds separable samples."""
    beta = np.zeros(x.shape[1])
    pull = np.full(x.shape[1], ridge)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (y - p) - pull * beta
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(pull)
        step = np.linalg.solve(hessian, gradient)
        beta = beta + np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return beta.tolist()


def scored(docs: DataFrame, learned: Learned, text: str = "text", drop: tuple[str, ...] = ()) -> DataFrame:
    """Add ``score``: 0 to 1, higher where the whole text is likelier toxic.

    Null and empty texts have the score of a text without terms.  Rows are scored one by one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(learned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, beta = shared.value
        trie = Trie(terms)

        def score(value: str | None) -> float:
            if not beta:
                return 0.0
            x = sum(a * b for a, b in zip(features(value, trie), beta))
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))

        for part in slices(batches):
            found = [score(t.as_py()) for t in part.column(text)]
            yield extended(part, list(drop), {"score": pa.array(found, pa.float64())})

    return docs.mapInArrow(run, schema_of(docs, list(drop), "score double"))


def toxicities(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Result of the query, one row per document: ``doc_id, held_out, score, predicted``."""
    docs = take(docs, doc_id="doc_id", text="text")
    learned = learn(docs, take(labels, doc_id="doc_id", toxic="toxic"))
    found = scored(docs.withColumn("held_out", held_out(F.col("doc_id"))), learned, drop=("text",))
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
