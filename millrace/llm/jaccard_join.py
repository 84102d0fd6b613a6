"""Exact set-similarity join on word shingles that skips by set relations.

Two relations save work. On the index level, lists are cut in blocks by position and size, and a block pair
whose best case cannot reach the threshold is skipped whole. On the answer level, what is known of a set (its hub, the
highly similar set it was compared with first) gives the answers of the sets like it: members of a component
need no comparison among themselves, and the triangle inequality of the Jaccard distance rules out others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm._arrow import in_arrow
from millrace.llm._graph import components
from millrace.llm._scratch import shuffle_width, stored
from millrace.llm._words import Slice, mix, shingles_of, slices, words_of

PERCENT = 75
WIDTH = 5
#: Share of a set's elements, in percent, by which its sample is longer than the prefix that any link must meet.
SPARE = 15
#: Elements gathered before a map task sends them on, and blobs per shuffle partition.
_SEND = 1 << 19
_BLOBS = 4
#: Bytes of the texts whose sets are made together; the arrays on the way take some tens of times that.
_SLICE = 1 << 18
#: Hubs of a list in a turn after the first.
HUBS = 4
#: The sets a broadcast may hold; beyond it the same join shuffles.
BROADCAST_SETS = 200_000


def _prefix(n, percent: int):
    """Elements of a set of ``n`` in any fixed order of which a linked set must hold one."""
    return n - (percent * n + 99) // 100 + 1


def _row_sets(part: Slice, width: int) -> Iterator[tuple[int, np.ndarray]]:
    hashes, bounds = shingles_of(words_of(part), width)
    for r in range(part.rows):
        if bounds[r] < bounds[r + 1]:
            yield r, np.unique(hashes[bounds[r] : bounds[r + 1]])


def _signature(u: np.ndarray) -> bytes:
    return np.array([mix(u).sum(dtype=np.uint64), mix(u ^ np.uint64(0xA5A5A5A55A5A5A5A)).sum(dtype=np.uint64)], np.uint64).tobytes()


def _ref(signature: bytes) -> np.uint64:
    """A name of a set, never 0."""
    return np.frombuffer(signature, np.uint64)[0] | np.uint64(1)


# Elements travel as 5 bytes each. Two that coincide can only let a set through that need not be.
def _packed(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return out.view(np.uint64).ravel()


def set_signatures(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id, text_key, n_shingles, set_id, ref`` per row; equal sets share ``set_id``, empty ones have none."""

    def run(batches):
        for batch in batches:
            n, ids, refs = np.zeros(batch.num_rows, np.int64), [None] * batch.num_rows, np.zeros(batch.num_rows, np.uint64)
            for part in slices(batch.column("text"), _SLICE):
                for r, u in _row_sets(part, width):
                    at = part.first_row + r
                    n[at], ids[at] = len(u), _signature(u)
                    refs[at] = _ref(ids[at])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(n), pa.array(ids, pa.binary()), pa.array(refs.view(np.int64))],
                ["doc_id", "text_key", "n_shingles", "set_id", "ref"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    return in_arrow(rows, run, "doc_id long, text_key long, n_shingles long, set_id binary, ref long")


def _shared_counts(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``ref, shared``: how many elements of a set's sample other sets' samples hold too, or more.

    The sample is the elements with the smallest hashes, a little more than the prefix. A map task sends each
    distinct element once, whatever number of its texts hold it, so no element makes a large partition.
    """
    buckets = _BLOBS * shuffle_width(docs.sparkSession)

    def blobs(elements, refs):
        bucket = mix(elements ^ np.uint64(0x1234567)) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        elements, refs, bucket = elements[order], refs[order], bucket[order]
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        firsts = np.concatenate([[0], cuts]).astype(int)
        ends = np.concatenate([cuts, [len(bucket)]]).astype(int)
        return [(int(bucket[a]), False, _packed(elements[a:b]), refs[a:b].tobytes()) for a, b in zip(firsts, ends)]

    def flush(held):
        sets = {ref: u for ref, u in held}  # equal sets count once
        refs = np.repeat(np.array(list(sets), np.uint64), [len(u) for u in sets.values()])
        elements = np.concatenate(list(sets.values()))
        order = np.argsort(elements, kind="stable")
        elements, refs = elements[order], refs[order]
        first = np.concatenate([[True], elements[1:] != elements[:-1]])
        group = np.cumsum(first) - 1
        many = np.bincount(group)[group] > 1
        named, counts = np.unique(refs[many], return_counts=True)
        rows = blobs(elements[first], np.where(many, np.uint64(0), refs)[first])  # 0: known to be shared
        if len(named):
            rows.append((int(named[0] % np.uint64(buckets)), True, named.tobytes(), counts.astype(np.uint64).tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.bool_(), pa.binary(), pa.binary()))], ["bucket", "counted", "a", "b"])

    def ask(batches):
        held, size = [], 0
        for batch in batches:
            for part in slices(batch.column("text"), _SLICE):
                for _, u in _row_sets(part, width):
                    keep = _prefix(len(u), percent) + len(u) * SPARE // 100
                    held.append((_ref(_signature(u)), u[:keep].copy()))
                    size += keep
                if size >= _SEND:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    def totals(refs, counts):
        named, at = np.unique(np.concatenate(refs), return_inverse=True)
        return named, np.bincount(at, np.concatenate(counts), len(named)).astype(np.uint64)

    def answer(batches):
        elements, refs, told, counts = [], [], [], []
        for batch in batches:
            for counted, a, b in zip(batch.column("counted").to_pylist(), batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                if counted:
                    told.append(np.frombuffer(a, np.uint64))
                    counts.append(np.frombuffer(b, np.uint64))
                else:
                    elements.append(_unpacked(a))
                    refs.append(np.frombuffer(b, np.uint64))
        if elements:
            e, r = np.concatenate(elements), np.concatenate(refs)
            del elements, refs
            order = np.argsort(e, kind="stable")
            e, r = e[order], r[order]
            first = np.concatenate([[True], e[1:] != e[:-1]])
            starts = np.flatnonzero(first)
            # shared: known to be, or named by two different sets
            known = np.maximum.reduceat((r == 0).astype(np.int8), starts) > 0
            lows, highs = np.minimum.reduceat(r, starts), np.maximum.reduceat(r, starts)
            shared = (known | (lows != highs))[np.cumsum(first) - 1]
            named, n = np.unique(r[shared & (r != 0)], return_counts=True)
            told.append(named)
            counts.append(n.astype(np.uint64))
        if told:
            named, n = totals(told, counts)
            to = mix(named) % np.uint64(buckets)
            order = np.argsort(to, kind="stable")
            pieces = [x for x in np.split(order, np.flatnonzero(np.diff(to[order])) + 1) if len(x)]
            columns = [pa.array([int(to[x[0]]) for x in pieces], pa.int64()), *(pa.array([v[x].tobytes() for x in pieces], pa.binary()) for v in (named, n))]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "a", "b"])

    def add_up(batches):
        refs, counts = [], []
        for batch in batches:
            refs += [np.frombuffer(x, np.uint64) for x in batch.column("a").to_pylist()]
            counts += [np.frombuffer(x, np.uint64) for x in batch.column("b").to_pylist()]
        if refs:
            named, n = totals(refs, counts)
            yield pa.RecordBatch.from_arrays([pa.array(named.view(np.int64)), pa.array(n.view(np.int64))], ["ref", "shared"])

    width_ = shuffle_width(docs.sparkSession)
    asked = in_arrow(docs.select("text"), ask, "bucket long, counted boolean, a binary, b binary")
    told = in_arrow(asked.repartition(width_, "bucket"), answer, "bucket long, a binary, b binary")
    return in_arrow(told.repartition(width_, "bucket"), add_up, "ref long, shared long")


def _linkable_sets(docs: DataFrame, signs: DataFrame, width: int, percent: int) -> DataFrame:
    """``set_id, n, elements`` of the distinct sets that can have a link to a different set, written once."""
    n = F.col("n_shingles")
    least = F.floor(SPARE * F.floor((percent * n + 99) / 100) / 100)  # the sample of the smallest set that may link is longer by this
    one = signs.filter("n_shingles > 0").groupBy("set_id", "ref", "n_shingles").agg(F.min(F.struct("text_key", "doc_id")).alias("at"))
    live = one.join(_shared_counts(docs, width, percent), "ref").filter(F.col("shared") >= least + 1)
    live = stored(live.select(F.col("at.text_key").alias("text_key"), F.col("at.doc_id").alias("live_id")), "live-sets")
    if live.count() <= BROADCAST_SETS:
        live = F.broadcast(live)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    found = texts.join(live, (texts["text_key"] == live["text_key"]) & texts["doc_id"].eqNullSafe(live["live_id"])).select("text")

    def run(batches):
        for batch in batches:
            for part in slices(batch.column("text"), _SLICE):
                rows = [(_signature(u), len(u), u.view(np.int64)) for _, u in _row_sets(part, width)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.binary()), pa.array([x[1] for x in rows], pa.int64()), pa.array([x[2] for x in rows], pa.list_(pa.int64()))], ["set_id", "n", "elements"])

    # repeated rows of one document give a set twice; they are told apart by nothing and merged
    sets = in_arrow(found, run, "set_id binary, n long, elements array<long>")
    return stored(sets.dropDuplicates(["set_id"]), "sets")


def _postings(sets: DataFrame, percent: int) -> DataFrame:
    """``element, set_id, n, pos``: each set's prefix in the order of rising frequency, without elements of one set only."""
    each = sets.select("set_id", "n", F.explode("elements").alias("element"))
    frequent = each.groupBy("element").agg(F.count("*").alias("f")).filter("f > 1")
    own = each.join(frequent, "element").groupBy("set_id", "n").agg(F.sort_array(F.collect_list(F.struct("f", "element"))).alias("ordered"))
    rare = F.col("n") - F.size("ordered")  # elements of this set only come first
    n = F.col("n")
    within = n - F.floor((percent * n + 99) / 100) + 1 - rare
    return own.select("set_id", "n", rare.alias("rare"), within.alias("within"), "ordered").filter("within > 0").select(
        "set_id", "n", "rare", F.posexplode(F.slice("ordered", 1, F.col("within").cast("int"))).alias("i", "entry")
    ).select(F.col("entry.element").alias("element"), "set_id", "n", (F.col("rare") + F.col("i")).alias("pos"))


def _sizes_fit(n: Column | str, m: Column | str, percent: int) -> Column:
    n, m = (F.col(x) if isinstance(x, str) else x for x in (n, m))
    return (100 * n >= percent * m) & (100 * m >= percent * n)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b, distance, both, either`` of the pairs ``a, b``, counted on the whole sets."""
    left = sets.select(F.col("set_id").alias("a"), F.col("elements").alias("left"))
    right = sets.select(F.col("set_id").alias("b"), F.col("elements").alias("right"))
    both = F.size(F.array_intersect("left", "right"))
    either = F.size("left") + F.size("right") - F.col("both")
    met = pairs.join(left, "a").join(right, "b")
    return met.select("a", "b", both.alias("both"), "left", "right").select("a", "b", "both", either.alias("either")).withColumn("distance", 1 - F.col("both") / F.col("either"))


def _open_lists(grouped: DataFrame) -> DataFrame:
    """Of the postings with their groups those of the lists whose sets are not all in one group yet."""
    mixed = grouped.groupBy("element").agg(F.min("group").alias("low"), F.max("group").alias("high")).filter("low <> high").select("element")
    return grouped.join(mixed, "element")


def _open_work(lists: DataFrame) -> tuple[int, int]:
    """How many pairs of different groups the lists hold, counted once per list, and how many entries."""
    own = lists.groupBy("element", "group").agg(F.count("*").cast("double").alias("n"))
    sums = own.groupBy("element").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("squares"))
    left, entries = sums.agg(F.sum((F.col("n") * F.col("n") - F.col("squares")) / 2), F.sum("n")).first()
    return int(left or 0), int(entries or 0)


def _hub_pairs(lists: DataFrame, turn: int, percent: int) -> DataFrame:
    """Each list's members of other groups beside a few sets of the list: a few pairs per entry, however long the list."""
    draw = F.xxhash64("set_id", F.lit(turn))
    head = F.struct(draw.alias("draw"), F.col("set_id").alias("a"), F.col("n").alias("m"), F.col("group").alias("own"))
    heads = lists.groupBy("element", F.pmod(draw, F.lit(HUBS if turn else 1)).alias("part")).agg(F.min(head).alias("head"))
    met = lists.join(heads.drop("part"), "element")
    met = met.filter(F.col("group") != F.col("head.own")).filter(_sizes_fit("n", "head.m", percent))
    return met.select(F.col("head.a").alias("a"), F.col("set_id").alias("b")).distinct()


def _groups_at(groups: DataFrame, links: DataFrame) -> DataFrame:
    """``a, b``: the groups at the two ends of each link."""
    ends = links.join(groups.select(F.col("set_id").alias("a"), F.col("group").alias("x")), "a").join(groups.select(F.col("set_id").alias("b"), F.col("group").alias("y")), "b")
    return ends.select(F.col("x").alias("a"), F.col("y").alias("b"))


def _merged(groups: DataFrame, ends: DataFrame) -> DataFrame:
    """``set_id, group`` after the groups that ``ends`` joins have become one."""
    named = components(ends)
    met = groups.join(named, groups["group"] == named["node"], "left")
    return stored(met.select("set_id", F.coalesce("component", "group").alias("group")), "set-groups")


def _other_pairs(lists: DataFrame, hubs: DataFrame, percent: int) -> DataFrame:
    """The pairs whose answer the hubs do not give, by blocks of a list that pass the bounds."""
    p = lists.select(
        "element", "set_id", "n", "pos", "group",
        F.floor(F.log("n") / F.log(F.lit(100 / percent))).cast("int").alias("size_block"), F.floor(F.log2(F.col("pos") + 1)).cast("int").alias("pos_block"),
    )
    key = ["element", "size_block", "pos_block"]
    blocks = p.groupBy(*key).agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.min("pos").alias("first"), F.min("group").alias("low"), F.max("group").alias("high")
    )
    blocks = stored(blocks, "blocks")
    one = blocks.select("element", *[F.col(c).alias(f"{c}_1") for c in blocks.columns[1:]])
    two = blocks.select("element", *[F.col(c).alias(f"{c}_2") for c in blocks.columns[1:]])
    room = F.least(F.col("most_1") - F.col("first_1"), F.col("most_2") - F.col("first_2"))
    pairs = one.join(two, "element").filter(
        ((F.col("size_block_1") < F.col("size_block_2")) | ((F.col("size_block_1") == F.col("size_block_2")) & (F.col("pos_block_1") <= F.col("pos_block_2"))))
        & (100 * F.col("most_1") >= percent * F.col("least_2")) & (100 * F.col("most_2") >= percent * F.col("least_1"))
        & (room * (100 + percent) >= percent * (F.col("least_1") + F.col("least_2")))
        & ~((F.col("low_1") == F.col("high_1")) & (F.col("low_2") == F.col("high_2")) & (F.col("low_1") == F.col("low_2")))
    ).select("element", "size_block_1", "pos_block_1", "size_block_2", "pos_block_2")
    same = (F.col("size_block_1") == F.col("size_block_2")) & (F.col("pos_block_1") == F.col("pos_block_2"))
    left = p.select("element", *[F.col(c).alias(f"{c}_1") for c in p.columns[1:]])
    right = p.select("element", *[F.col(c).alias(f"{c}_2") for c in p.columns[1:]])
    met = pairs.join(left, ["element", "size_block_1", "pos_block_1"]).join(right, ["element", "size_block_2", "pos_block_2"])
    met = met.filter((F.col("group_1") != F.col("group_2")) & (~same | (F.col("set_id_1") < F.col("set_id_2")))).filter(_sizes_fit("n_1", "n_2", percent))
    met = met.filter(F.least(F.col("n_1") - F.col("pos_1"), F.col("n_2") - F.col("pos_2")) * (100 + percent) >= percent * (F.col("n_1") + F.col("n_2")))
    met = met.select(F.least("set_id_1", "set_id_2").alias("a"), F.greatest("set_id_1", "set_id_2").alias("b")).distinct()
    # the nearest hub of a, and how far b is from that hub if they were compared
    near = hubs.groupBy(F.col("b").alias("a")).agg(F.min(F.struct("distance", F.col("a").alias("hub"))).alias("near")).select("a", F.col("near.distance").alias("to_a"), F.col("near.hub").alias("hub"))
    far = hubs.select(F.col("a").alias("hub"), "b", F.col("distance").alias("to_b"))
    tested = hubs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    met = met.join(tested, ["a", "b"], "left_anti").join(near, "a", "left").join(far, ["hub", "b"], "left")
    return met.filter("to_a IS NULL OR to_b IS NULL" + f" OR abs(to_b - to_a) <= {1 - percent / 100} + 1e-9").select("a", "b")


def set_groups(docs: DataFrame, signs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``set_id, group`` of the sets that can have a link to a different set; linked sets have one group.

    Turn by turn, some sets of each list, drawn anew, are its hubs and compared with the members of other groups, and groups with a link become
    one. All pairs still open are compared as soon as these are no more than a turn compares, or a turn has closed less than a tenth of them.
    """
    sets = _linkable_sets(docs, signs, width, percent)
    postings = stored(_postings(sets, percent), "postings")
    linked = 100 * F.col("both") >= percent * F.col("either")
    grouped = postings.withColumn("group", F.col("set_id"))
    groups, hubs, turn, before = postings.select("set_id", F.col("set_id").alias("group")).distinct(), None, 0, None
    while True:
        lists = stored(_open_lists(grouped), "open-lists")
        left, entries = _open_work(lists)
        if hubs is not None and (left <= HUBS * entries or 10 * left > 9 * before):
            break
        before = left
        found = _hub_pairs(lists, turn, percent)
        if hubs is not None:
            found = found.join(hubs.select("a", "b"), ["a", "b"], "left_anti").join(hubs.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"], "left_anti")
        found = stored(_verified(found, sets), "hub-pairs")
        links = found.filter(linked).select("a", "b")
        groups = _merged(groups, links if hubs is None else _groups_at(groups, links))  # in the first turn a set is its own group
        hubs, turn = found if hubs is None else hubs.unionByName(found), turn + 1
        grouped = lists.drop("group").join(groups, "set_id")
    if not left:
        return groups
    rest = stored(_verified(_other_pairs(lists, hubs.select("a", "b", "distance"), percent), sets).filter(linked).select("a", "b"), "rest-links")
    return groups if rest.isEmpty() else _merged(groups, _groups_at(groups, rest))


def near_duplicate_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The connected groups of documents whose shingle sets are similar.

    Takes ``doc_id, text`` (other columns are ignored) and returns one row per row: ``doc_id, n_shingles,
    component_id, kept``. Words are runs outside ``[\\x20\\x09-\\x0D]`` with A-Z lower-cased, a set holds the distinct
    shingles of ``width`` words; a shorter text is one shingle, a text without words (or NULL) has an empty set
    and is linked with nothing. Two rows link when the Jaccard similarity of their sets is ``percent`` or more
    (equal sets always). ``component_id`` is the smallest doc_id of the component; NULL doc_ids are never the
    smallest, and a component of NULL doc_ids only has NULL. ``kept`` marks the row with that doc_id (of repeated rows each).
    Elements are 64-bit hashes; a pair of different shingles shares one with probability 2**-64.

    No pair is lost: a linked pair meets in the list of the first element that both prefixes hold. There it
    is either compared, or both are in one component already, or their known distances to a hub differ by too much.
    """
    named = _grouped_rows(docs, width, percent)
    low = stored(named.filter("group IS NOT NULL").groupBy("group").agg(F.min("doc_id").alias("low")), "least-ids")
    out = named.join(low, "group", "left")
    component = F.when(F.col("group").isNotNull(), F.col("low")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _grouped_rows(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``doc_id, text_key, n_shingles, group`` per row; the group is that of its set, NULL for an empty one."""
    signs = stored(set_signatures(docs, width), "signatures")
    groups = set_groups(docs, signs, width, percent)
    out = signs.join(groups, "set_id", "left").select("doc_id", "text_key", "n_shingles", F.coalesce("group", "set_id").alias("group"))
    return stored(out, "groups")


def keep_representatives(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay, with all columns: of each group one text.

    That is the text of the smallest doc_id, of several the one with the smallest hash; rows without doc_id come after all
    others. A row is known by its doc_id and text, so of rows with one doc_id only those go whose text is like another
    one's, and repeated rows of a text that stays stay. Texts without words are in no group and stay.
    """
    named = _grouped_rows(docs, width, percent).filter("group IS NOT NULL")
    own = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key").alias("own")
    first = stored(named.select("group", own).groupBy("group").agg(F.min("own").alias("first")), "first-rows")
    gone = named.select("group", own).join(first, "group").filter("own <> first").select("own.doc_id", "own.text_key").distinct()
    gone = gone.select(F.col("doc_id").alias("_gone_id"), F.col("text_key").alias("_gone_key"))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    same = F.col("row.doc_id").cast("long").eqNullSafe(F.col("_gone_id")) & F.xxhash64("row.text").eqNullSafe(F.col("_gone_key"))
    return row.join(gone, same, "left_anti").select("row.*")
