"""Toxicity scores: Levenshtein automata over a lexicon trie find terms, misspelled too; their context weighs them."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopmetrics.llm.samples import class_sizes, labelled_sample, slices
from stopmetrics.llm.worker_memory import release_memory

# Terms the lexicon starts from.
SEED_TERMS = (
    "clown",
    "disgusting",
    "idiot",
    "loser",
    "moron",
    "pathetic",
    "scum",
    "stupid",
    "trash",
    "worthless",
)
# Words near a term that report what someone else said.
REPORTING_WORDS = frozenset(
    "said says quoted quotes wrote writes called calls told reported sagte schrieb nannte dit écrit appelé dijo "
    "escribió llamó".split()
)
# Signs that stand for letters in disguised words.
_DISGUISES = str.maketrans("013457@$", "oieastas")

_WORD = re.compile(r"[^\W_]+(?:[@$][^\W_]+)*")
_QUOTES = re.compile('["“”„«»]')
_WINDOW = 5  # words to each side of a term
_QUOTE_REACH = 80  # characters to each side in which a quotation has to open and close


class LexiconAutomaton:
    """Deterministic automaton, built as words are read, of all words near a term of the lexicon.

    A state is the set of (trie node, edits so far) that Levenshtein automata of the terms reach together on the trie;
    a term of fewer than five letters allows no edit, of fewer than nine one, else two.
    """

    def __init__(self, terms: Iterable[str]) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.allowed = [0]
        for term in sorted(set(terms)):
            edits = 0 if len(term) < 5 else 1 if len(term) < 9 else 2
            node = 0
            self.allowed[0] = max(self.allowed[0], edits)
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.allowed.append(0)
                node = self.children[node][letter]
                self.allowed[node] = max(self.allowed[node], edits)
            self.term[node] = term
        self.start = self._closed({(0, 0)})
        self.steps: dict[tuple[frozenset, str], frozenset] = {}
        self.found: dict[str, tuple[str, int] | None] = {}

    def _closed(self, states: set[tuple[int, int]]) -> frozenset:
        """With the states that missing letters lead to."""
        todo = list(states)
        while todo:
            node, edits = todo.pop()
            for child in self.children[node].values():
                reached = (child, edits + 1)
                if edits < self.allowed[child] and reached not in states:
                    states.add(reached)
                    todo.append(reached)
        return frozenset(states)

    def _step(self, state: frozenset, letter: str) -> frozenset:
        reached = set()
        for node, edits in state:
            if edits < self.allowed[node]:
                reached.add((node, edits + 1))  # a letter too many
            for own, child in self.children[node].items():
                cost = edits + (own != letter)
                if cost <= self.allowed[child]:
                    reached.add((child, cost))
        return self._closed(reached)

    def match(self, word: str) -> tuple[str, int] | None:
        """(term, edits) of the nearest term, or None; words met before are answered from memory."""
        if word in self.found:
            return self.found[word]
        if len(self.found) > 100_000:
            self.found.clear()
        state = self.start
        for letter in word:
            key = (state, letter)
            after = self.steps.get(key)
            if after is None:
                after = self.steps[key] = self._step(state, letter)
            state = after
            if not state:
                break
        ends = [
            (edits, self.term[node])
            for node, edits in state
            if self.term[node] and edits <= (0 if len(self.term[node]) < 5 else 1 if len(self.term[node]) < 9 else 2)
        ]
        best = min(ends) if ends else None
        self.found[word] = (best[1], best[0]) if best else None
        return self.found[word]


@dataclass(frozen=True)
class ToxicityModel:
    """Lexicon, spellings that clean documents use too, and the weights of the features of FEATURES."""

    terms: tuple[str, ...]
    benign: frozenset[str] = frozenset()
    intercept: float = -5.0
    weights: tuple[float, ...] = field(default=(6.0, 2.0, 5.0, 1.0, 0.0))


FEATURES = ("abuse", "log_abuse", "misspelled", "log_misspelled", "log_quoted")
_HIT = "array<struct<term:string,form:string,start:int,edits:int,quoted:boolean>>"
_HIT_TYPE = pa.list_(
    pa.struct(
        [("term", pa.string()), ("form", pa.string()), ("start", pa.int32()), ("edits", pa.int32()), ("quoted", pa.bool_())]
    )
)


def _quoted(text: str, start: int, end: int, before: list[str], after: list[str]) -> bool:
    """Whether a short quotation encloses the term, or a reporting word stands near it."""
    line_start = text.rfind("\n", 0, start) + 1
    line_end = text.find("\n", end)
    left = text[max(line_start, start - _QUOTE_REACH) : start]
    right = text[end : min(len(text) if line_end < 0 else line_end, end + _QUOTE_REACH)]
    enclosed = len(_QUOTES.findall(left)) % 2 == 1 and bool(_QUOTES.search(right))
    return enclosed or not REPORTING_WORDS.isdisjoint(before) or not REPORTING_WORDS.isdisjoint(after)


def find_hits(text: str | None, automaton: LexiconAutomaton, benign: frozenset[str]) -> list[dict]:
    """Terms of the lexicon in `text`, each with its spelling, place, edits, and whether it is a quotation."""
    if not text:
        return []
    lowered = text.lower()
    words = _WORD.findall(lowered)
    near = {}
    for word in set(words):
        plain = word if word.isalpha() else word.translate(_DISGUISES)
        hit = automaton.match(plain)
        if hit and not ((hit[1] or plain != word) and word in benign):
            near[word] = (hit[0], hit[1] + (plain != word))
    if not near:
        return []
    hits = []
    for place, found in enumerate(_WORD.finditer(lowered)):
        word = found.group()
        if word in near:
            start, end = found.span()
            context = words[max(0, place - _WINDOW) : place], words[place + 1 : place + 1 + _WINDOW]
            quoted = _quoted(lowered, start, end, *context)
            term, edits = near[word]
            hits.append({"term": term, "form": word, "start": start, "edits": edits, "quoted": quoted})
    return hits


_AUTOMATA: dict[tuple[str, ...], LexiconAutomaton] = {}


def with_hits(docs: DataFrame, terms: tuple[str, ...], benign: frozenset[str] = frozenset()) -> DataFrame:
    """`docs` with `hits`; only texts go to Python."""

    def of_batch(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if terms not in _AUTOMATA:
            _AUTOMATA.clear()
            _AUTOMATA[terms] = LexiconAutomaton(terms)
        automaton = _AUTOMATA[terms]
        for batch in texts:
            yield pa.array([find_hits(text, automaton, benign) for part in slices(batch) for text in part], _HIT_TYPE)
        automaton.found.clear()
        release_memory()

    return docs.withColumn("hits", F.arrow_udf(of_batch, _HIT)("text"))


def _features(hits: list[dict]) -> list[float]:
    exact = sum(not hit["quoted"] and not hit["edits"] for hit in hits)
    near = sum(not hit["quoted"] and hit["edits"] > 0 for hit in hits)
    return [exact > 0, np.log1p(exact), near > 0, np.log1p(near), np.log1p(len(hits) - exact - near)]


def learned_terms(sample: DataFrame, sizes: dict[int, int], least: int = 5, ratio: float = 20.0) -> list[str]:
    """Words that mark toxic documents of the sample: in at least `least` of them, `ratio` times as frequent as in clean
    ones, and beside many different words, which words of texts that were merely copied are not."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))
    listed = sample.select("doc_id", "label", words.alias("w")).where(F.size("w") > 0)
    places = F.explode(F.sequence(F.lit(1), F.size("w")))
    each = listed.select("doc_id", "label", "w", places.alias("i")).select(
        "doc_id",
        "label",
        F.element_at("w", F.col("i")).alias("term"),
        F.xxhash64(F.try_element_at("w", F.nullif(F.col("i") - 1, F.lit(0))), F.try_element_at("w", F.col("i") + 1)).alias("around"),
    )
    long = each.where(F.length("term") >= 4)
    by_doc = long.groupBy("term", "label", "doc_id").agg(F.min("around").alias("around"))
    toxic = F.count(F.when(F.col("label") == 1, 1))
    clean = F.count(F.when(F.col("label") == 0, 1))
    counts = by_doc.groupBy("term").agg(toxic.alias("toxic"), clean.alias("clean"), F.approx_count_distinct("around").alias("around"))
    share = F.col("toxic") / max(1, sizes.get(1, 0)), (F.col("clean") + 0.5) / max(1, sizes.get(0, 0))
    found = counts.where(
        (F.col("toxic") >= least) & (share[0] >= ratio * share[1]) & (F.col("around") * 2 >= F.col("toxic")) & (share[0] >= 0.01)
    )
    return [row[0] for row in found.orderBy(F.desc("toxic"), "term").limit(200).select("term").collect()]


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Intercept and weights by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    penalty = ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-3
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (p - y)) + penalty @ beta
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + penalty, slope)
        beta -= np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def fit_toxicity(docs: DataFrame, labels: DataFrame, rows_per_class: int = 4000, seeds: Iterable[str] = SEED_TERMS) -> ToxicityModel:
    """Fit on at most `rows_per_class` labelled documents of each class that are not held out.

    The lexicon is `seeds` and the words that `learned_terms` finds. Misspellings are rare in a sample, so each toxic
    document with exact hits also counts, lightly, as if they had been misspelled; spellings that the sample's clean
    documents use themselves are left out of the lexicon's reach. Without labels of both classes the default weights
    hold.
    """
    sizes = class_sizes(labels, "toxic")
    if not sizes.get(0) or not sizes.get(1):
        return ToxicityModel(tuple(sorted(seeds)))
    sample = labelled_sample(docs, labels, "toxic", rows_per_class)
    used = {value: min(rows_per_class, sizes[value]) for value in (0, 1)}
    terms = tuple(sorted({*seeds, *learned_terms(sample, used)}))
    rows = with_hits(sample, terms).select("label", "hits").toPandas()
    spelled: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for label, hits in zip(rows["label"], rows["hits"]):
        spelled[label].update({hit["form"] for hit in hits if hit["edits"]})
    rare = used[0] / used[1]
    benign = frozenset(form for form, n in spelled[0].items() if spelled[1][form] * rare < 5 * n)
    kept = [[hit for hit in hits if hit["form"] not in benign] for hits in rows["hits"]]
    x = np.array([_features(hits) for hits in kept], dtype=float).reshape(-1, len(FEATURES))
    y = rows["label"].to_numpy(float)
    if not 0 < y.sum() < len(y):
        return ToxicityModel(terms, benign)
    # Classes count as often as they occur among all labels, not in the balanced sample.
    weight = np.where(y == 1, sizes[1] / max(1, (y == 1).sum()), sizes[0] / max(1, (y == 0).sum()))
    weight *= len(y) / weight.sum()
    shown = x[(y == 1) & (x[:, 0] > 0)]
    shifted = shown[:, [2, 3, 0, 1, 4]]
    beta = _logistic(
        np.vstack([x, shifted]),
        np.concatenate([y, np.ones(len(shifted))]),
        np.concatenate([weight, np.full(len(shifted), 0.3)]),
    )
    return ToxicityModel(terms, benign, float(beta[0]), tuple(map(float, beta[1:])))


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """`docs` (text, ...) with hits, score and predicted; columns of these names are replaced, all rows stay.

    score, from 0 to 1, is the modelled probability of label 1; a NULL or empty text, or one without hits, gets the
    probability of documents without hits. predicted is 1 from a score of 0.5 on.
    """
    marked = with_hits(docs.withColumn("text", F.col("text").cast("string")), model.terms, model.benign)
    exact = F.size(F.filter("hits", lambda h: ~h["quoted"] & (h["edits"] == 0)))
    near = F.size(F.filter("hits", lambda h: ~h["quoted"] & (h["edits"] > 0)))
    quoted = F.size(F.filter("hits", lambda h: h["quoted"]))
    parts = ((exact > 0).cast("double"), F.log1p(exact), (near > 0).cast("double"), F.log1p(near), F.log1p(quoted))
    total = F.lit(model.intercept)
    for weight, part in zip(model.weights, parts):
        total = total + weight * part
    scored = marked.withColumn("score", 1 / (1 + F.exp(-total)))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
