"""Toxicity by the nearest labelled examples: exact TF-IDF cosine of whole texts over a block-max index, distance-weighted votes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm._arrow import give_back, in_arrow, packed_numbers, unpacked_numbers
from millrace.llm._scratch import shuffle_width, stored
from millrace.llm._words import NON_LETTERS, Slice, slices, words_of

#: Bound of the labelled examples. Their vectors hold all their terms.
SAMPLE_ROWS = 20_000
NEIGHBOURS = 24
#: Examples of a block; blocks that are looked at for a first bar; open blocks up to which each is looked at by itself.
BLOCK, FIRST, FEW = 64, 3, 12
#: A term that so manieth example or more hold lies there in full, one value for each. Texts whose similarities are summed together.
OFTEN, GROUP = 16, 64
#: Terms whose document frequencies are added up together.
STRIPE = 1 << 16
_SOFT = 0.02
THRESHOLD = 0.3


def _counted(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and count of each distinct letter word of each text."""
    words = words_of(part, NON_LETTERS)
    row, term = words.row, words.hash
    if not len(row):
        return row, term, row
    order = np.lexsort((term, row))
    row, term = row[order], term[order]
    first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (term[1:] != term[:-1])]))
    return row[first], term[first], np.diff(np.concatenate([first, [len(row)]]))


def _places(vocabulary: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of each term in a sorted vocabulary, and whether it is there."""
    at = np.minimum(np.searchsorted(vocabulary, term), max(len(vocabulary) - 1, 0))
    return at, vocabulary[at] == term if len(vocabulary) else np.zeros(len(term), bool)


@dataclass
class Vectors:
    """Sparse vectors end to end: the terms and weights of vector ``i`` lie from ``bounds[i]`` to ``bounds[i + 1]``."""

    bounds: np.ndarray
    term: np.ndarray
    weight: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    @staticmethod
    def of(dense: np.ndarray) -> Vectors:
        row, term = np.nonzero(dense)
        return Vectors(np.searchsorted(row, np.arange(len(dense) + 1)), term.astype(np.int32), dense[row, term])

    def spans(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the entries of the vectors ``at`` lie, one after the other, and which of them each belongs to."""
        n = self.bounds[at + 1] - self.bounds[at]
        which = np.repeat(np.arange(len(at)), n)
        return np.arange(len(which)) + np.repeat(self.bounds[at] - (np.cumsum(n) - n), n), which

    def picked(self, at: np.ndarray) -> Vectors:
        where, which = self.spans(at)
        return Vectors(np.searchsorted(which, np.arange(len(at) + 1)), self.term[where], self.weight[where])


@dataclass
class ExampleIndex:
    """Distinct example vectors in blocks, with the largest weight of each term in each block, and the examples that hold each term.

    ``idf`` is the weight of each term: its inverse document frequency times how far it goes with either label. ``rare`` is that of
    terms that no example holds; they have no neighbours but count in a text's length.
    """

    vocabulary: np.ndarray
    idf: np.ndarray
    vectors: Vectors | np.ndarray
    toxic: np.ndarray
    total: np.ndarray
    evidence: list[list[int]]
    prior: float
    empty_rate: float
    knots: tuple[np.ndarray, np.ndarray] = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    rare: float = 0.0

    def __post_init__(self):
        if isinstance(self.vectors, np.ndarray):
            self.vectors = Vectors.of(self.vectors)
        self.highest = None

    def __getstate__(self) -> dict:
        """What goes to the executors: the lists by term are made from the vectors where they are searched."""
        return {k: self.__dict__[k] for k in self.__dataclass_fields__} | {"highest": None}

    def _listed(self) -> None:
        """The largest weight of each term in each block, and the examples of each term."""
        size, n = len(self.vocabulary), len(self.vectors)
        example = np.repeat(np.arange(n, dtype=np.int32), np.diff(self.vectors.bounds))
        order = np.argsort(self.vectors.term, kind="stable")
        term = self.vectors.term[order]
        example, weight = example[order], self.vectors.weight[order].astype(np.float32)
        held = np.bincount(term, minlength=size)
        block = example // BLOCK
        starts = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (block[1:] != block[:-1])])) if len(term) else np.zeros(0, int)
        highest = np.maximum.reduceat(weight, starts) if len(starts) else weight
        self.highest = Vectors(np.searchsorted(term[starts], np.arange(size + 1)), block[starts], highest)
        often = np.flatnonzero(held * OFTEN > n)
        self.often = np.full(size, -1, np.int32)
        self.often[often] = np.arange(len(often))
        x = held[term] * OFTEN > n
        self.full = np.zeros((len(often), n), np.float32)
        self.full[self.often[term[x]], example[x]] = weight[x]
        self.holders = Vectors(np.searchsorted(term[~x], np.arange(size + 1)), example[~x], weight[~x])
        self.spread = np.zeros(size, np.float32)

    def weights(self, term: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Known terms of a text as places in the vocabulary, and their weights; its length is that of all its terms."""
        at, known = _places(self.vocabulary, term)
        own = (1 + np.log(count)) * np.where(known, self.idf[at] if len(self.idf) else 0.0, self.rare)
        own /= max(float(np.sqrt((own * own).sum())), 1e-9)
        return at[known], own[known].astype(np.float32)

    def nearest(self, q: np.ndarray | tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The NEIGHBOURS most similar distinct vectors and all that tie with the last: exact, since blocks whose bound is lower cannot hold one.

        Where few blocks are open after a look at the best ones these are looked at too, else the holders of all terms are added up. ``q`` is
        a whole vector or its terms and weights.
        """
        term, weight = q if isinstance(q, tuple) else (np.flatnonzero(q), q[q != 0])
        if not len(term) or not len(self.vectors):
            return np.zeros(0, int), np.zeros(0)
        if self.highest is None:
            self._listed()
        where, which = self.highest.spans(term)
        bound = np.bincount(self.highest.term[where], self.highest.weight[where] * weight[which], -(-len(self.vectors) // BLOCK))
        best = np.argsort(-bound, kind="stable")
        at, s = self._looked_at(best[:FIRST], term, weight)
        least = float(np.partition(s, -NEIGHBOURS)[-NEIGHBOURS]) if len(s) >= NEIGHBOURS else 0.0
        rest = best[FIRST:]
        rest = rest[(bound[rest] > 0) & (bound[rest] >= least - 1e-6)]
        if len(rest) > FEW:
            s = self._all(term, weight)
            at = np.arange(len(s))
        elif len(rest):
            more = self._looked_at(rest, term, weight)
            at, s = np.concatenate([at, more[0]]), np.concatenate([s, more[1]])
        least = float(np.partition(s, -NEIGHBOURS)[-NEIGHBOURS]) if len(s) > NEIGHBOURS else 0.0
        return self._near(at, s, least)

    def nearest_of(self, queries: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``nearest`` of many texts: whole vectors seldom leave a block closed, so the similarities of all examples are summed, a group of texts at a time."""
        if self.highest is None:
            self._listed()
        n = len(self.vectors)
        for k in range(0, len(queries), GROUP):
            some = queries[k : k + GROUP]
            row = np.repeat(np.arange(len(some)), [len(term) for term, _ in some])
            term, weight = (np.concatenate([q[c] for q in some]) for c in range(2))
            full = self.often[term] >= 0
            dense = np.zeros((len(some), len(self.full)), np.float32)
            dense[row[full], self.often[term[full]]] = weight[full]
            where, which = self.holders.spans(term[~full])
            s = np.bincount(row[~full][which] * n + self.holders.term[where], self.holders.weight[where] * weight[~full][which], len(some) * n)
            s = s.astype(np.float32).reshape(len(some), n)
            s += dense @ self.full
            least = np.partition(s, n - NEIGHBOURS, axis=1)[:, n - NEIGHBOURS] if n > NEIGHBOURS else np.zeros(len(some))
            for own, bar in zip(s, least):
                at = np.flatnonzero((own >= bar - 1e-6) & (own > 0))
                yield self._near(at, own[at], bar)

    @staticmethod
    def _near(at: np.ndarray, s: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        near = (s >= least - 1e-6) & (s > 0)
        order = np.lexsort((at[near], -s[near]))
        return at[near][order], s[near][order]

    def _looked_at(self, blocks: np.ndarray, term: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The examples of some blocks and their similarities."""
        at = (blocks[:, None] * BLOCK + np.arange(BLOCK)).ravel()
        at = at[at < len(self.vectors)]
        where, which = self.vectors.spans(at)
        self.spread[term] = weight
        s = np.bincount(which, self.spread[self.vectors.term[where]] * self.vectors.weight[where], len(at))
        self.spread[term] = 0
        return at, s

    def _all(self, term: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """The similarities of all examples."""
        full = self.often[term] >= 0
        where, which = self.holders.spans(term[~full])
        s = np.bincount(self.holders.term[where], self.holders.weight[where] * weight[~full][which], len(self.vectors)).astype(np.float64)
        for t, w in zip(self.often[term[full]], weight[full]):
            s += w * self.full[t]
        return s

    def raw(self, at: np.ndarray, similarity: np.ndarray, left_out: tuple[int, int] | None = None) -> float:
        """The share of toxic votes; an example weighs more the nearer it is. ``left_out``: a vector and label of which one example is not asked."""
        toxic, total = self.toxic[at].astype(float), self.total[at].astype(float)
        if left_out:
            own = at == left_out[0]
            toxic[own] -= left_out[1]
            total[own] -= 1
        w = 1 / (1 - np.minimum(similarity, 1) + _SOFT)
        return float(((w * toxic).sum() + self.prior) / ((w * total).sum() + 1))

    def left_out(self, numbers: list[int]) -> Iterator[tuple[float, float, float]]:
        """Raw score, toxic examples and examples of some vectors, by label, each asked without one of its own."""
        spans = [slice(self.vectors.bounds[i], self.vectors.bounds[i + 1]) for i in numbers]
        for i, (at, s) in zip(numbers, self.nearest_of([(self.vectors.term[x], self.vectors.weight[x]) for x in spans])):
            for label, n in ((1, self.toxic[i]), (0, self.total[i] - self.toxic[i])):
                if n:
                    yield self.raw(at, s, (i, label)), float(label * n), float(n)

    def calibrate(self, seen: list[tuple[float, float, float]]):
        """Makes scores shares: left-one-out votes of the examples, pooled until they rise."""
        pools: list[list[float]] = []  # raw score times weight, toxic, weight
        for raw, hit, n in sorted(seen):
            pools.append([raw * n, hit, n])
            while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
                last = pools.pop()
                pools[-1] = [a + b for a, b in zip(pools[-1], last)]
        if pools:
            x = np.array([p[0] / p[2] for p in pools])
            y = np.array([(p[1] + self.prior) / (p[2] + 1) for p in pools])
            self.knots = (x, np.maximum.accumulate(y))

    def score(self, at: np.ndarray, similarity: np.ndarray) -> float:
        return float(np.clip(np.interp(self.raw(at, similarity), *self.knots), 0, 1))


def _ties(n: np.ndarray, a: np.ndarray, p: float) -> np.ndarray:
    """How far each term goes with either label: 1 and its log-likelihood ratio, under the root. ``n`` examples hold it, ``a`` toxic ones."""
    part = lambda seen, expected: np.where(seen > 0, seen * np.log(np.maximum(seen, 1) / np.maximum(expected, 1e-9)), 0.0)
    return np.sqrt(1 + np.maximum(2 * (part(a, n * p) + part(n - a, n * (1 - p))), 0))


def _frequencies(docs: DataFrame, vocabulary: np.ndarray) -> tuple[int, np.ndarray]:
    """The rows of ``docs``, and in how many of them each term of the vocabulary stands."""

    def run(batches):
        held, rows = np.zeros(len(vocabulary), np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for part in slices(batch.column("text")):
                at, known = _places(vocabulary, _counted(part)[1])
                held += np.bincount(at[known], minlength=len(vocabulary))
        found = [(-1, packed_numbers(np.array([rows])))] + [(k // STRIPE, packed_numbers(held[k : k + STRIPE])) for k in range(0, len(held), STRIPE)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(), pa.binary()))], ["stripe", "counts"])

    def add_up(key, table):
        return pa.table({"stripe": pa.array([key[0].as_py()]), "counts": pa.array([packed_numbers(sum(unpacked_numbers(x)[0] for x in table.column("counts")))])})

    told = {r["stripe"]: unpacked_numbers(r["counts"])[0] for r in in_arrow(docs.select("text"), run, "stripe long, counts binary").groupBy("stripe").applyInArrow(add_up, "stripe long, counts binary").collect()}
    return int(told[-1][0]) if told else 0, np.concatenate([np.zeros(0, np.int64), *(told[k] for k in sorted(told) if k >= 0)])


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> ExampleIndex | None:
    """An index of about ``sample_rows`` labelled examples, picked by the hash of their doc_id; None without labels.

    ``docs`` has ``doc_id, text``, ``labels`` has ``doc_id, toxic``; of repeated labels the highest counts, NULL labels are none. All terms of the
    examples count, whichever label they go with; their document frequencies are counted over all of ``docs``.
    """
    labels = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    rows = labels.count()
    if not rows:
        return None
    share = int(min(1, sample_rows / rows) * 1_000_000)
    sample = stored(labels.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share), "labels")
    found = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # about sample_rows rows of 12 bytes

    def spell(batches):
        for batch in batches:
            texts = batch.column("text")
            for part in slices(texts):
                row, term, count = _counted(part)
                bounds = np.searchsorted(row, np.arange(part.rows + 1))
                own = [packed_numbers(term[a:b], count[a:b].astype(np.int32)) for a, b in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(part.first_row, part.rows) for c in ("doc_id", "toxic")), pa.array(own, pa.binary())], ["doc_id", "toxic", "own"])

    named = in_arrow(found.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic", "text"), spell, "doc_id long, toxic int, own binary")
    named = stored(named, "examples").groupBy("own").agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n"), F.min("doc_id").alias("one"), F.max("doc_id").alias("other"))
    held = [(r["one"], r["other"], r["toxic"], r["n"], *unpacked_numbers(r["own"])) for r in stored(named, "vectors").toLocalIterator()]
    rows, toxic = sum(x[3] for x in held), sum(x[2] for x in held)
    if not rows:
        return None
    held.sort(key=lambda x: x[:2])
    index = ExampleIndex(np.zeros(0, np.uint64), np.zeros(0), np.zeros((0, 0), np.float32), np.zeros(0), np.zeros(0), [], toxic / rows, toxic / rows)
    for x in held:
        if not len(x[4]):
            index.empty_rate = (x[2] + toxic / rows) / (x[3] + 1)
    held = [x for x in held if len(x[4])]
    if not held:
        return index
    sizes = np.array([len(x[4]) for x in held])
    votes, all_ = (np.array([x[c] for x in held]) for c in (2, 3))
    evidence = [sorted(set(x[:2])) for x in held]
    terms, count = (np.concatenate([x[k] for x in held]) for k in (4, 5))
    del held
    vocabulary = np.unique(terms)
    at = np.searchsorted(vocabulary, terms).astype(np.int32)
    del terms
    which = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    ties = _ties(np.bincount(at, all_[which], len(vocabulary)), np.bincount(at, votes[which], len(vocabulary)), toxic / rows)
    documents, frequency = _frequencies(docs, vocabulary)
    idf, rare = ties * np.log(1 + documents / (1 + frequency)), float(np.log(1 + documents / 2))
    weight = ((1 + np.log(count)) * idf[at]).astype(np.float32)
    weight /= np.maximum(np.sqrt(np.bincount(which, weight * weight, len(sizes))), 1e-9).astype(np.float32)[which]
    vectors = Vectors(np.concatenate([[0], np.cumsum(sizes)]), at, weight)
    # like vectors beside each other, so that blocks have tight bounds
    own = [slice(a, b) for a, b in zip(vectors.bounds, vectors.bounds[1:])]
    best = np.array([x.start + int(weight[x].argmax()) for x in own])
    order = np.lexsort((-weight[best], at[best]))
    index = ExampleIndex(vocabulary, idf, vectors.picked(order), votes[order], all_[order], [evidence[i] for i in order], toxic / rows, index.empty_rate, rare=rare)
    del vectors, at, weight, which, count, own

    def left_out(batches):
        for batch in batches:
            seen = list(index.left_out(batch.column("id").to_pylist()))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in seen], pa.float64()) for k in range(3)], ["raw", "hit", "n"])

    numbers = docs.sparkSession.range(0, len(order), 1, shuffle_width(docs.sparkSession))
    index.calibrate([tuple(r) for r in in_arrow(numbers, left_out, "raw double, hit double, n double").collect()])
    give_back()
    return index


def score(docs: DataFrame, index: ExampleIndex | None) -> DataFrame:
    """``doc_id, score, evidence`` for every row of ``docs(doc_id, text)``; other columns are ignored.

    The whole text is looked at. ``score`` is calibrated: of documents with score s, about the share s is toxic. ``evidence`` lists the
    doc_ids of examples of the three nearest vectors. A text without a term of any example, empty and NULL ones included, has the rate of such
    examples and no evidence; without labels every score is 0. Equal texts get equal scores.
    """

    def run(batches):
        known: dict[bytes, tuple[float, list[int]]] = {}
        for batch in batches:
            out, why = np.full(batch.num_rows, index.empty_rate if index else 0.0), [[] for _ in range(batch.num_rows)]
            for part in slices(batch.column("text")) if index else ():
                row, term, count = _counted(part)
                bounds = np.searchsorted(row, np.arange(part.rows + 1))
                worded = np.flatnonzero(np.diff(bounds))
                owns = [slice(bounds[r], bounds[r + 1]) for r in worded]
                keys = [hashlib.sha256(term[x].tobytes() + count[x].tobytes()).digest() for x in owns]
                if len(known) > 100_000:
                    known.clear()
                new = {key: x for key, x in zip(keys, owns) if key not in known}
                for key, (at, s) in zip(new, index.nearest_of([index.weights(term[x], count[x]) for x in new.values()])):
                    known[key] = (index.score(at, s), [d for i in at[:3] for d in index.evidence[i]]) if len(at) else (index.empty_rate, [])
                for r, key in zip(worded, keys):
                    out[part.first_row + r], why[part.first_row + r] = known[key]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out), pa.array(why, pa.list_(pa.int64()))], ["doc_id", "score", "evidence"])

    return in_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, score double, evidence array<long>")
