"""How far the sources of a language are from each other and from the language, with terms that tell them apart.

Pairs of sources are compared in cells of a cube (block of sources, block of sources, block of terms): a cell gets
the slices of both blocks of sources, sums what its terms add, and the sums are added along the axis of terms.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm._arrow import _send_package, in_arrow
from millrace.llm._scratch import stored
from millrace.llm._words import NON_LETTERS, Slice, slices

#: A term of a language occurs in at least so many of its documents; so many telling terms of a source are listed.
LEAST_DOCS, TOP = 3, 200
#: Sources and terms of a block of the cube, about: blocks are dealt by hash.
BLOCK_SOURCES, BLOCK_TERMS = 32, 4096
#: Shares are whole numbers of this part of one.
UNIT = 1_000_000_000
#: Text bytes whose terms are counted together before they are sent.
SLICE_BYTES = 8 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _terms(part: Slice) -> tuple[np.ndarray, pa.Array]:
    """The row and the lower-cased text of each term of a slice."""
    data, n = part.data, len(part.data)
    inside = ~NON_LETTERS[data]
    edge = np.zeros(n + 1, bool)
    edge[part.offsets] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:n]
    ends[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    letters = np.ascontiguousarray(_LOWER[data[inside]])
    offsets = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(letters))
    return np.searchsorted(part.offsets, start, "right") - 1, words


def _count(batches):
    """For each slice of some MB: each group it has, and how often and in how many documents each of its terms occurs."""
    for batch in batches:
        langs, sources = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
        group = langs.indices.to_numpy().astype(np.int64) * max(1, len(sources.dictionary)) + sources.indices.to_numpy()
        for part in slices(batch.column("text"), SLICE_BYTES):
            own = group[part.first_row : part.first_row + part.rows]
            row, words = _terms(part)
            coded = words.dictionary_encode()
            size = max(1, len(coded.dictionary))
            pairs, times = np.unique(row * size + coded.indices.to_numpy(), return_counts=True)
            keys, where = np.unique(own[pairs // size] * size + pairs % size, return_inverse=True)
            n, docs = np.bincount(where, times, len(keys)).astype(np.int64), np.bincount(where, minlength=len(keys))
            found = np.unique(own)
            groups, names = np.concatenate([keys // size, found]), pa.array(np.concatenate([keys % size, np.zeros(len(found), np.int64)]), mask=np.arange(len(keys) + len(found)) >= len(keys))
            term = coded.dictionary.cast(pa.string()).take(names) if len(coded.dictionary) else pa.nulls(len(groups), pa.string())
            nothing = np.zeros(len(found), np.int64)
            columns = [langs.dictionary.take(pa.array(groups // max(1, len(sources.dictionary)))), sources.dictionary.take(pa.array(groups % max(1, len(sources.dictionary)))), term, pa.array(np.concatenate([n, nothing])), pa.array(np.concatenate([docs, nothing]))]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])


def _share(count, total, terms):
    """1 + floor(UNIT * (count + 1) / (total + terms)) in columns of longs, three decimal places at a time so that nothing overflows."""
    rest, whole, share = count + F.lit(1), total + terms, F.lit(0).cast("long")
    div = lambda a, b: F.call_function("div", a, b)
    share, rest = div(rest, whole), rest % whole
    for _ in range(3):
        share, rest = share * 1000 + div(rest * 1000, whole), rest * 1000 % whole
    return share + 1


def _shares(counts: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """The same for numpy arrays."""
    whole = total + terms
    share, rest = np.divmod(counts + 1, whole)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, whole)
        share = share * 1000 + more
    return share + 1


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _cell(key: tuple, table: pa.Table) -> pa.Table:
    """What one cell adds to the divergence of each ordered pair of its two blocks' sources.

    Terms that neither source has add the same everywhere; that is counted for all terms of the language in the first
    block of terms, and a cell adds how far its own terms are from it.
    """
    lang, first, second, block = (k.as_py() for k in key)
    sources, where = np.unique(np.array(table.column("source").to_pylist(), object), return_inverse=True)
    total, side = np.zeros(len(sources), np.int64), np.zeros(len(sources), np.int64)
    total[where], side[where] = table.column("total").to_numpy(), table.column("own_block").to_numpy()
    terms = int(table.column("terms")[0].as_py())
    coded = table.column("term").combine_chunks().dictionary_encode()
    has = coded.is_valid().to_numpy(zero_copy_only=False)
    counts = np.zeros((len(sources), len(coded.dictionary)), np.int64)
    counts[where[has], coded.indices.drop_null().to_numpy()] = table.column("n").to_numpy()[has]
    out: tuple[list, list, list] = ([], [], [])
    if terms:
        share, none = _shares(counts, total[:, None], terms), _shares(np.zeros(len(sources), np.int64), total, terms)
    for a in range(len(sources)):
        others = np.flatnonzero((side == first + second - side[a]) & (np.arange(len(sources)) != a))
        if terms:
            rest = _apart(none[a], none[others])
            value = (_apart(share[a], share[others]) - rest[:, None]).sum(axis=1) + (terms * rest if block == 0 else 0)
        else:
            value = np.zeros(len(others), np.int64)
        out[0].extend([sources[a]] * len(others))
        out[1].extend(sources[others])
        out[2].append(value)
    values = np.concatenate(out[2]) if out[2] else np.zeros(0, np.int64)
    return pa.table({"lang": pa.array([lang] * len(values), pa.string()), "source": pa.array(out[0], pa.string()), "item": pa.array(out[1], pa.string()), "value": pa.array(values, pa.int64())})


def _pairs(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value``: the divergence of each ordered pair of a language's sources."""
    own = F.pmod(F.xxhash64("source"), F.col("source_blocks"))
    columns = ["lang", "source", "term", "n", "total", "terms", "source_blocks"]
    slices_ = counts.select(*columns, own.alias("own_block"), F.pmod(F.xxhash64("term"), F.col("term_blocks")).alias("block"))
    # every cell hears of every source of its blocks, also of those that have none of its terms
    heads = groups.select("lang", "source", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"), "total", "terms", "source_blocks", own.alias("own_block"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("term_blocks") - 1)).alias("block"))
    dealt = slices_.unionByName(heads).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("source_blocks") - 1)))
    dealt = dealt.withColumn("first", F.least("own_block", "other")).withColumn("second", F.greatest("own_block", "other")).drop("other", "source_blocks")
    _send_package(counts.sparkSession)
    parts = dealt.groupBy("lang", "first", "second", "block").applyInArrow(_cell, "lang string, source string, item string, value long")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _blocks(n, size: int):
    return F.greatest(F.ceil(n / size), F.lit(1)).cast("long")


def divergences(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """How far each source of a language is from each other one and by which terms it differs from the language.

    Takes ``text, lang, source`` (other columns are ignored; NULL counts as '') and returns ``lang, source, part, item,
    value, rank``. Terms are runs of letters with A-Z lower-cased; a language keeps those in at least ``least_docs`` of its
    rows (each row is a document, also a repeated one). A source's share of a kept term is 1 + floor(UNIT * (count + 1) /
    (all counts + kept terms)), a language's likewise. With p of the source and q of what it is held against,
    f = floor((p - q)**2 / q), all in whole numbers.

    ``part`` 'pair': ``item`` is each other source of the language, ``value`` the sum of f over its kept terms (0 without
    any). ``part`` 'term': ``item`` is each kept term the source has with p > q of the language, ``value`` its f, the ``top``
    largest. Ranks count from 1 for each source and part, by value descending, then item in the order of its UTF-8 bytes.
    A source without terms has only pairs, the only source of a language only terms, an empty table nothing.
    """
    names = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    found = in_arrow(docs.select("text", *names), _count, "lang string, source string, term string, n long, docs long")
    found = stored(found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "source-terms")
    kept = found.filter("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).filter(F.col("docs") >= least_docs).drop("docs")
    kept = stored(kept, "kept-terms")
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    counts = stored(found.select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "kept-counts")
    groups = found.filter("term IS NULL").select("lang", "source").join(counts.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
    sizes = found.filter("term IS NULL").groupBy("lang").agg(F.count("*").alias("sources")).join(langs, "lang", "left")
    sizes = sizes.select("lang", F.coalesce("terms", F.lit(0)).alias("terms"), F.coalesce("lang_total", F.lit(0)).alias("lang_total"), _blocks(F.col("sources"), BLOCK_SOURCES).alias("source_blocks"), _blocks(F.coalesce("terms", F.lit(0)), BLOCK_TERMS).alias("term_blocks"))
    groups = stored(groups.join(sizes, "lang").withColumn("total", F.coalesce("total", F.lit(0))), "source-totals")
    counts = counts.join(groups, ["lang", "source"])
    p, q = _share(F.col("n"), F.col("total"), F.col("terms")), _share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    terms = counts.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).filter("p > q")
    terms = terms.select("lang", "source", F.lit("term").alias("part"), "item", F.expr("(p - q) * (p - q) div q").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = terms.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    pairs = _pairs(counts, groups).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(terms)
