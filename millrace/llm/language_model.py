"""A hierarchical Pitman-Yor model of words, with seating drawn by Gibbs sweeps.

A word is drawn from the restaurant of its context, the word before it in its text (or none yet). All these restaurants share one
parent, that of any word, above a uniform base over the training words and one unknown word.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.folders import remove_folder
from millrace.llm._arrow import in_arrow, packed_numbers, unpacked_numbers
from millrace.llm._scratch import UNMARKED, Scratch, shuffle_width, stored
from millrace.llm._words import Slice, mix, slices, words_of
from millrace.session import scratch_dir

#: Words that ``_contexts`` names; every word is a context of the model.
CONTEXTS = 15
#: Cells of word hashes whose counts tell which words are counted in full on the way to the contexts.
CELLS = 1 << 12
#: Discounts of the context restaurants and of their parent; the strength of all.
DISCOUNT, PARENT_DISCOUNT, STRENGTH = 0.7, 0.75, 1.0
BURN_IN, SAMPLES = 2, 4
#: Text bytes whose distinct cells are asked for together.
BATCH_BYTES = 8 << 20
#: Text bytes for each bucket of words. Their number hangs on the texts alone, not on how the session deals them.
BUCKET_BYTES = 8 << 20
#: The end of a text, a token like others.
_END = np.uint64(0xE17D0F7E87)
#: The context of a text's first token.
_NONE = np.uint64(0x57A27)


def seated(customers: np.ndarray, opening: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of each dish after its customers sat down one after the other by the Chinese restaurant rule.

    ``opening`` is the weight of a new table: (strength + discount * tables) * probability of the dish in the parent. Beyond
    eight customers, those of a growth by an eighth sit down together, so the work grows with the logarithm of the customers.
    """
    tables = np.minimum(customers, 1)
    active, done = np.flatnonzero(customers > 1), 1
    while len(active):
        step = np.minimum(max(1, done // 8), customers[active] - done)
        w = opening[active]
        tables[active] += rng.binomial(step, w / (w + np.maximum(done - discount * tables[active], 1e-9)))
        done += max(1, done // 8)
        active = active[customers[active] > done]
    return tables


def _contexts(rows: DataFrame) -> np.ndarray:
    """The hashes of the CONTEXTS words that are most frequent in the training texts, exactly. The model asks for none of them.

    A first pass counts words by cell of their hash, and apart those that make a five-hundredth of some 2 MB of text. The latter counts
    are lower bounds; the least of the best CONTEXTS of them is a count that every word among the most frequent ones reaches. A word has
    no more than its cell, so a second pass counts in full all words of the cells that reach it, and no others can be among them.
    """
    rows = rows.select("text", "held_out")

    def counted(batch):
        train = ~batch.column("held_out").to_numpy(zero_copy_only=False)
        for part in slices(batch.column("text")):
            words = words_of(part)
            yield np.unique(words.hash[train[part.first_row : part.first_row + part.rows][words.row]], return_counts=True)

    def rough(batches):
        cells = np.zeros(CELLS, np.int64)
        for batch in batches:
            for hashes, counts in counted(batch):
                cells += np.bincount(_cell(hashes), counts, CELLS).astype(np.int64)
                often = counts * 500 >= counts.sum()
                yield _told(hashes[often].view(np.int64), counts[often], False)
        used = np.flatnonzero(cells)
        yield _told(used, cells[used], True)

    found = stored(in_arrow(rows, rough, "word long, n long, is_cell boolean").groupBy("is_cell", "word").agg(F.sum("n").alias("n")), "frequent")
    best = found.filter("NOT is_cell").orderBy(F.desc("n")).limit(CONTEXTS).collect()
    least = best[-1]["n"] if len(best) == CONTEXTS else 1
    reaching = np.zeros(CELLS, bool)
    reaching[[r["word"] for r in found.filter(F.col("is_cell") & (F.col("n") >= least)).collect()]] = True

    def full(batches):
        for batch in batches:
            for hashes, counts in counted(batch):
                x = reaching[_cell(hashes)]
                yield pa.RecordBatch.from_arrays([pa.array(hashes[x].view(np.int64)), pa.array(counts[x])], ["word", "n"])

    exact = in_arrow(rows, full, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    best = exact.orderBy(F.desc("n"), "word").limit(CONTEXTS).collect()
    return np.sort(np.array([r["word"] for r in best], np.int64).view(np.uint64))


def _cell(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes) % np.uint64(CELLS)).astype(np.int64)


def _told(word: np.ndarray, n: np.ndarray, is_cell: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(word, pa.int64()), pa.array(n, pa.int64()), pa.array(np.full(len(word), is_cell))], ["word", "n", "is_cell"])


def _tokens(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, word and context of each token of a slice, ends included."""
    words = words_of(part)
    n = len(words.hash) + part.rows
    ends = words.bounds[1:] + np.arange(part.rows)
    word = np.full(n, _END, np.uint64)
    inner = np.ones(n, bool)
    inner[ends] = False
    word[inner] = words.hash
    context = np.concatenate([[_NONE], word[:-1]])[:n]
    context[ends[:-1] + 1] = _NONE
    return np.repeat(np.arange(part.rows), np.diff(words.bounds) + 1), word, context


def _starts(values: np.ndarray) -> np.ndarray:
    """Where a new value begins among ordered ones."""
    return np.concatenate([[True], values[1:] != values[:-1]]) if len(values) else np.zeros(0, bool)


def _lengths(first: np.ndarray, n: int) -> np.ndarray:
    """The lengths of the runs that begin at the places ``first`` of ``n``."""
    return np.diff(np.append(first, n))


@dataclass
class Cells:
    """Distinct pairs of a word and its context, ordered by word, with their training counts."""

    word: np.ndarray
    context: np.ndarray
    count: np.ndarray

    def __post_init__(self):
        first = _starts(self.word)
        self.first = np.flatnonzero(first)
        self.at = np.cumsum(first) - 1

    def packed(self) -> bytes:
        return packed_numbers(self.word[self.first], _lengths(self.first, len(self.word)).astype(np.uint32), self.context, self.count.astype(np.uint64 if self.count.max(initial=0) >> 32 else np.uint32))

    @staticmethod
    def unpacked(blob) -> Cells:
        word, lengths, context, count = unpacked_numbers(blob)
        return Cells(np.repeat(word, lengths), context, count.astype(np.int64))

    def by_word(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, values, len(self.first)).astype(np.int64)


def _batches(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, length of each text and their bytes end to end, of runs of rows of about BATCH_BYTES."""
    for part in slices(texts, BATCH_BYTES):
        yield part.first_row, np.diff(part.offsets), part.data


def _cells_of(word: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The place of each pair among the distinct ones, and those: ordered by word, then by a hash of both."""
    named = mix(word ^ mix(context + np.uint64(1)))
    order = np.argsort(named)
    starts = _starts(named[order])
    heads = order[starts]
    by_word = np.argsort(word[heads], kind="stable")
    place = np.empty(len(heads), np.uint32)
    place[by_word] = np.arange(len(heads), dtype=np.uint32)
    cell = np.empty(len(order), np.uint32)
    cell[order] = place[np.cumsum(starts) - 1]
    heads = heads[by_word]
    return cell, word[heads], context[heads]


def _batch_cells(lengths: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of each text of a batch, the cell of each token, and the cells in order."""
    texts = pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])), pa.py_buffer(np.ascontiguousarray(data)))
    held = []
    for part in slices(texts, 1 << 20):
        row, word, context = _tokens(part)
        held.append((np.bincount(row, minlength=part.rows), word, context))
    tokens, word, context = (np.concatenate(x) for x in zip(*held))
    del held
    return tokens, *_cells_of(word, context)


def _by_bucket(word: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """The buckets of ordered words, each a range of their hashes."""
    bucket = (word >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
    return ((int(bucket[a]), slice(a, b)) for a, b in zip(cuts, cuts[1:]) if b > a)


@dataclass
class Totals:
    """Sums over all buckets: tokens, distinct words, customers and tables of the parent."""

    tokens: float
    distinct: float
    customers: float
    parents: float


@dataclass
class Seats:
    """The tables of a bucket's cells of several customers, the parent's tables of each of its words, those of the sampled sweeps so far, and the open contexts' tables of one customer in all buckets."""

    fixed: np.ndarray
    tables: np.ndarray
    parent_tables: np.ndarray
    samples: list[np.ndarray]

    def packed(self) -> bytes:
        return packed_numbers(self.fixed, *(x.astype(np.uint32) for x in (self.tables, self.parent_tables, *self.samples)))

    @staticmethod
    def unpacked(blob) -> Seats:
        fixed, tables, parent_tables, *samples = (x.astype(np.int64) for x in unpacked_numbers(blob))
        return Seats(fixed, tables, parent_tables, samples)


class Bucket:
    """The cells of a bucket of words, with what is asked of the contexts' owners.

    A cell of one customer has one table whatever is drawn, so only the contexts of cells of more are ``open`` here and asked for in each turn.
    """

    def __init__(self, cells: Cells):
        self.cells = cells
        self.many = np.flatnonzero(cells.count > 1)
        self.open, self.open_at = np.unique(cells.context[self.many], return_inverse=True)

    def tables(self, several: np.ndarray) -> np.ndarray:
        out = np.minimum(self.cells.count, 1)
        out[self.many] = several
        return out

    def sums(self, tables: np.ndarray, parent_tables: np.ndarray) -> list[float]:
        """This bucket's share of the totals."""
        return [float(x) for x in (self.cells.count.sum(), (self.cells.by_word(self.cells.count) > 0).sum(), tables.sum(), parent_tables.sum())]

    def parent(self, customers: np.ndarray, parent_tables: np.ndarray, totals: Totals) -> np.ndarray:
        opening = (STRENGTH + PARENT_DISCOUNT * totals.parents) / (totals.distinct + 1)
        return (customers - PARENT_DISCOUNT * parent_tables + opening) / (STRENGTH + totals.customers)

    def sweep(self, seats: Seats, moved: np.ndarray, totals: Totals, rng: np.random.Generator) -> Seats:
        """Seats the customers of every context restaurant anew, given the parent as it stands, and then the parent's, which are the tables of the others."""
        parent = self.parent(self.cells.by_word(self.tables(seats.tables)), seats.parent_tables, totals)
        opening = (STRENGTH + DISCOUNT * (seats.fixed + moved)[self.open_at]) * parent[self.cells.at[self.many]]
        tables = seated(self.cells.count[self.many], opening, DISCOUNT, rng)
        opening = (STRENGTH + PARENT_DISCOUNT * totals.parents) / (totals.distinct + 1)
        customers = self.cells.by_word(self.tables(tables))
        return Seats(seats.fixed, tables, seated(customers, np.full(len(customers), opening), PARENT_DISCOUNT, rng), seats.samples)

    def chances(self, seats: Seats, customers_of: np.ndarray, fixed: np.ndarray, moved: list[np.ndarray], sampled: list[Totals]) -> np.ndarray:
        """The predictive probability of each cell's word in its context, averaged over the sampled seatings."""
        out = np.zeros(len(self.cells.word))
        for k, (own, totals) in enumerate(zip(moved, sampled)):
            tables, parent_tables = self.tables(seats.samples[2 * k]), seats.samples[2 * k + 1]
            opening = (STRENGTH + DISCOUNT * (fixed + own)) * self.parent(self.cells.by_word(tables), parent_tables, totals)[self.cells.at]
            out += (np.maximum(self.cells.count - DISCOUNT * tables, 0) + opening) / (STRENGTH + customers_of)
        return out / len(sampled)


#: Kinds of rows: the texts of a batch; the cells of a bucket; where a batch's cells lie in them; seats; parts of sums for an owner of contexts; its answer.
_TEXTS, _CELLS, _PLACES, _SEATS, _PARTS, _SUMMED = range(6)
_ROWS = "bucket long, kind int, other long, data binary, sums array<double>"


def _rows(found: list[tuple]) -> pa.Table:
    """``_ROWS`` of ``(bucket, kind, other, data, sums)``."""
    columns = list(zip(*found)) or [()] * 5
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.float64()))
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=["bucket", "kind", "other", "data", "sums"])


def _owned(contexts: np.ndarray, owners: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each owner of some of the contexts, and their places."""
    owner = mix(contexts ^ np.uint64(0x0714E2)) % np.uint64(owners)
    order = np.argsort(owner, kind="stable")
    for x in np.split(order, np.flatnonzero(np.diff(owner[order])) + 1):
        if len(x):
            yield int(owner[x[0]]), x


def _parts(bucket: int, owners: int, contexts: np.ndarray, asks: np.ndarray, *values: np.ndarray) -> list[tuple]:
    """Rows for the owners of ``contexts``: this bucket's part of each sum, and whether it asks for the whole."""
    small = np.uint64 if any(int(v.max(initial=0)) >> 32 for v in values) else np.uint32
    return [(bucket, _PARTS, owner, packed_numbers(contexts[x], asks[x], *(v[x].astype(small) for v in values)), None) for owner, x in _owned(contexts, owners)]


def _add_up(key, table):
    """What an owner of contexts answers: to each bucket the sums over all buckets, in the order in which it asked."""
    held = [unpacked_numbers(x) for x in table.column("data")]
    contexts = [x[0] for x in held]
    names, at = np.unique(np.concatenate(contexts), return_inverse=True)
    sums = [np.bincount(at, np.concatenate([x[2 + k] for x in held]), len(names)).astype(np.int64) for k in range(len(held[0]) - 2)]
    out, begin = [], 0
    for bucket, own in zip(table.column("bucket").to_pylist(), held):
        x = at[begin : begin + len(own[0])][own[1]]
        begin += len(own[0])
        if len(x):
            out.append((bucket, _SUMMED, key[0].as_py(), packed_numbers(*(s[x] for s in sums)), None))
    return _rows(out)


def _answered(table: pa.Table, owners: int, contexts: np.ndarray, asked: np.ndarray) -> list[np.ndarray]:
    """The owners' sums of the contexts that were asked for, in the order of the contexts."""
    answers = {o: d for o, k, d in zip(table.column("other").to_pylist(), table.column("kind").to_pylist(), table.column("data")) if k == _SUMMED}
    out: list[np.ndarray] = []
    for owner, x in _owned(contexts, owners):
        x = x[asked[x]]
        if len(x):
            sums = unpacked_numbers(answers[owner])
            out = out or [np.zeros(len(contexts), np.int64) for _ in sums]
            for whole, part in zip(out, sums):
                whole[x] = part
    return [s[asked] for s in out]


def _of_kind(table: pa.Table, kind: int) -> list[tuple]:
    return [(o, d) for o, k, d in zip(table.column("other").to_pylist(), table.column("kind").to_pylist(), table.column("data")) if k == kind]


def _bucketed(df: DataFrame, count: int) -> tuple[DataFrame, str, str]:
    """``df`` stored by the hash of its column bucket, so that each later turn reads it where it lies; its name in the catalog and its folder."""
    spark, name = df.sparkSession, f"millrace_cells_{uuid.uuid4().hex}"
    path = scratch_dir(spark, "cells")
    df.write.options(**UNMARKED).bucketBy(count, "bucket").option("path", path).saveAsTable(name, format="parquet")
    return spark.table(name), name, path


def _summed(states: DataFrame) -> list[float]:
    return list(states.filter("sums IS NOT NULL").agg(*(F.coalesce(F.sum(F.col("sums")[k]), F.lit(0.0)) for k in range(4))).first())


def scored(docs: DataFrame, held_out) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs(doc_id, text)``.

    The model learns from the rows for which the condition ``held_out`` is false. Tokens are runs outside ``[\\x20\\x09-\\x0D]`` with A-Z
    lower-cased, then one end; a NULL or empty text has the end only. ``score`` is the log10 probability of the text, each token's predictive
    probability after the token before it averaged over the sampled seatings; any word never seen in training is the
    one unknown word. ``base_score`` adds log10((c + 1) / (N + V + 1)) over the tokens. Perplexity per token is ``pow(10, -score / n_tokens)``.
    Repeated rows are learned from and scored as often as they occur; an empty table gives an empty result. Words are told apart by 64-bit hashes.

    Texts lie in batches of about BATCH_BYTES. A batch asks once for each of its distinct cells (a word after a context) and sends its counts along.
    Buckets of words hold all cells of the corpus and seat the customers. After each sweep they send the tables of each context to its owner,
    which adds them up over all buckets; only four sums of a sweep reach the driver.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    scratch = Scratch()

    def pack(batches):
        number = TaskContext.get().partitionId() << 32
        for given in batches:
            held, ids = given.column("held_out").to_numpy(zero_copy_only=False), given.column("doc_id")
            for first, lengths, data in _batches(given.column("text")):
                own = slice(first, first + len(lengths))
                named = ids[own].is_valid().to_numpy(zero_copy_only=False)
                packed = packed_numbers(ids[own].fill_null(0).to_numpy(), named, held[own], lengths, data)
                yield from _rows([(None, _TEXTS, number, packed, [float(len(data)), 0.0, 0.0, 0.0])]).to_batches()
                number += 1

    packed = scratch.stored(in_arrow(rows, pack, _ROWS), "batches")
    buckets = int(_summed(packed)[0]) // BUCKET_BYTES + 1
    owners = min(buckets, 64 + buckets // 16)

    def ask(batches):
        for given in batches:
            for batch, blob in zip(given.column("other").to_pylist(), given.column("data")):
                _, _, held, lengths, data = unpacked_numbers(blob)
                tokens, cell, word, context = _batch_cells(lengths, data)
                count = np.bincount(cell[np.repeat(~held, tokens)], minlength=len(word))
                found = [(b, _CELLS, batch, Cells(word[x], context[x], count[x]).packed(), None) for b, x in _by_bucket(word, buckets)]
                yield from _rows(found).to_batches()

    def begin(key, table):
        """The cells of a bucket, where those of each batch lie in them, and their contexts' customers of one and of several to a cell."""
        number = key[0].as_py()
        held = [Cells.unpacked(x) for x in table.column("data")]
        at, word, context = _cells_of(*(np.concatenate([getattr(x, c) for x in held]) for c in ("word", "context")))
        cells = Cells(word, context, np.bincount(at, np.concatenate([x.count for x in held]), len(word)).astype(np.int64))
        bucket = Bucket(cells)
        tables = np.minimum(cells.count, 1)
        out = [(number, _CELLS, None, cells.packed(), bucket.sums(tables, (cells.by_word(cells.count) > 0).astype(np.int64)))]
        ends = np.cumsum([len(x.word) for x in held])
        for batch, own, end in zip(table.column("other").to_pylist(), held, ends):
            places = at[end - len(own.word) : end]
            out.append((number, _PLACES, batch, packed_numbers(np.diff(places, prepend=np.uint32(0))), None))
        contexts, x = np.unique(cells.context, return_inverse=True)
        once = np.bincount(x, cells.count == 1, len(contexts)).astype(np.int64)
        several = np.bincount(x, cells.count > 1, len(contexts)).astype(np.int64)
        some = (once > 0) | (several > 0)
        return _rows(out + _parts(number, owners, contexts[some], (several > 0)[some], once[some], several[some]))

    cells, name, path = _bucketed(in_arrow(packed, ask, _ROWS).groupBy("bucket").applyInArrow(begin, _ROWS), shuffle_width(spark))
    try:
        totals, sampled = Totals(*_summed(cells)), []
        parts, seats, turns = cells, None, BURN_IN + SAMPLES
        for turn in range(turns):
            last = turn == turns - 1

            def swept(key, left, right):
                number = key[0].as_py()
                bucket = Bucket(Cells.unpacked(left.column("data")[0]))
                every = np.ones(len(bucket.open), bool)
                *fixed, moved = _answered(right, owners, bucket.open, every) or [np.zeros(0, np.int64)] * 2
                if turn:
                    state = Seats.unpacked(_of_kind(right, _SEATS)[0][1])
                else:
                    state = Seats(fixed[0], np.ones(len(bucket.many), np.int64), (bucket.cells.by_word(bucket.cells.count) > 0).astype(np.int64), [])
                state = bucket.sweep(state, moved, totals, np.random.default_rng([number, turn]))
                if turn >= BURN_IN:
                    state.samples += [state.tables, state.parent_tables]
                out = [(number, _SEATS, None, state.packed(), bucket.sums(bucket.tables(state.tables), state.parent_tables))]
                if not last:
                    return _rows(out + _parts(number, owners, bucket.open, every, np.bincount(bucket.open_at, state.tables, len(bucket.open)).astype(np.int64)))
                contexts, x = np.unique(bucket.cells.context, return_inverse=True)
                summed = lambda values: np.bincount(x, values, len(contexts)).astype(np.int64)
                x_many = x[bucket.many]
                values = [summed(bucket.cells.count), summed(bucket.cells.count == 1)]
                values += [np.bincount(x_many, t, len(contexts)).astype(np.int64) for t in state.samples[::2]]
                return _rows(out + _parts(number, owners, contexts, np.ones(len(contexts), bool), *values))

            held = cells.filter(F.col("kind") == _CELLS)
            answers = parts.filter(F.col("kind") == _PARTS).groupBy("other").applyInArrow(_add_up, _ROWS)
            before = seats
            if seats is not None:
                answers = answers.unionByName(seats.filter(F.col("kind") == _SEATS))
            seats = parts = scratch.stored(held.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(swept, _ROWS), "seats")
            if before is not None:
                scratch.drop(before)
            totals = Totals(totals.tokens, totals.distinct, *_summed(seats)[2:])
            if turn >= BURN_IN:
                sampled.append(totals)

        def answer(key, left, right):
            number = key[0].as_py()
            bucket = Bucket(Cells.unpacked(_of_kind(left, _CELLS)[0][1]))
            contexts, x = np.unique(bucket.cells.context, return_inverse=True)
            customers, fixed, *moved = (s[x] for s in _answered(right, owners, contexts, np.ones(len(contexts), bool)))
            logs = np.log10(bucket.chances(Seats.unpacked(_of_kind(right, _SEATS)[0][1]), customers, fixed, moved, sampled)).astype(np.float32)
            own = bucket.cells.by_word(bucket.cells.count)[bucket.cells.at]
            out = []
            for batch, blob in _of_kind(left, _PLACES):
                places = np.cumsum(unpacked_numbers(blob)[0].astype(np.int64))
                out.append((number, _SUMMED, batch, packed_numbers(logs[places], own[places]), None))
            return _rows(out)

        held = cells.filter(F.col("kind").isin(_CELLS, _PLACES))
        answers = parts.filter(F.col("kind") == _PARTS).groupBy("other").applyInArrow(_add_up, _ROWS).unionByName(seats.filter(F.col("kind") == _SEATS))
        answers = stored(held.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(answer, _ROWS), "answers")
    finally:
        spark.sql(f"DROP TABLE {name}")
        remove_folder(spark, path)
    scratch.drop(seats)
    scale = float(np.log10(totals.tokens + totals.distinct + 1))
    train_tokens = int(totals.tokens)

    def tell(key, left, right):
        ids, named, held_out, lengths, data = unpacked_numbers(left.column("data")[0])
        tokens, cell, _, _ = _batch_cells(lengths, data)
        told = sorted(zip(right.column("bucket").to_pylist(), right.column("data")), key=lambda x: x[0])
        held = [unpacked_numbers(x) for _, x in told]
        logs, own = np.concatenate([x[0] for x in held]).astype(np.float64), np.concatenate([x[1] for x in held])
        row = np.repeat(np.arange(len(ids)), tokens)
        known, base, score = (np.bincount(row, v[cell], len(ids)) for v in (own > 0, np.log10(own + 1.0) - scale, logs))
        columns = [pa.array(ids, mask=~named), pa.array(held_out), pa.array(tokens), pa.array(known.astype(np.int64)), pa.array(np.full(len(ids), train_tokens)), pa.array(base), pa.array(score)]
        return pa.table(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return packed.groupBy("other").cogroup(answers.groupBy("other")).applyInArrow(tell, schema)
