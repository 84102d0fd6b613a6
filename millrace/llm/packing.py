"""Packing by the histogram of lengths, shortest pack first."""

from __future__ import annotations

import heapq
import itertools
import json
import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm._arrow import in_arrow
from millrace.llm._scratch import shuffle_width, stored

CAPACITY = 4096
#: Words, and pieces of words, whose ids a task keeps; when full, those stay as the older ones until as many new ones have come.
_KNOWN_WORDS = 100_000
#: New words are encoded this many at a time, with this character between them where it has an id of its own.
_AT_ONCE, _BETWEEN = 128, "\x01"
#: Characters of the texts whose words are looked up together.
_TEXT_RUN = 1 << 22
#: The normalizer and the cuts of files whose words are taken apart before they are encoded.
_FOLDING = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_CUTS = {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True}
#: Letters that NFC leaves as they are and whose lower case is one of them, whatever is beside them (Latin, Cyrillic, kana, Han); and signs.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f\u0400-\u0481\u048a-\u04ff\u1ea0-\u1ef9\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5"
_SIGNS = "!-/:-@\\[-`{-~\u00a1-\u00a9\u00ab\u00ac\u00ae-\u00b1\u00b4\u00b6-\u00b8\u00bb\u00bf\u00d7\u00f7\u2010-\u2027\u2030-\u205e\u20a0-\u20bf\u3001-\u3003\u3008-\u3011"
_ODD = re.compile(f"[^\\n0-9{_LETTERS}{_SIGNS}]")
_PIECE = re.compile(f"[{_LETTERS}]+|[0-9\\n]|'s|'t|'re|'ve|'m|'ll|'d|[{_SIGNS}]+")
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class _Kept:
    """Ids by word, of the words that came last."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]]):
        self.encode = encode
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def learn(self, words: set[str]) -> dict[str, bytes]:
        """A table that holds at least these words."""
        new = words.difference(self.known)
        if not new:
            return self.known
        if len(self.known) + len(new) > _KNOWN_WORDS:
            self.older, self.known, new = self.known, {}, words
        found = [(w, self.older[w]) for w in new if w in self.older]
        self.known.update(found)
        unseen = list(new.difference(self.known) if found else new)
        self.known.update(zip(unseen, self.encode(unseen)))
        return self.known


class WordTokenizer:
    """Ids of a text by a tokenizers file whose tokens never reach across white space.

    A text is cut at ``[\\x20\\x09-\\x0D]`` and each distinct word is encoded once; that gives the ids of the
    whole text for any file whose pre-tokenizer splits at white space and drops it, and whose special strings hold none.
    A special string in a text has its id, as the file says. Ids are little-endian 32-bit.

    If the file folds case and cuts words as ``_FOLDING`` and ``_CUTS`` say, new words are taken apart first: their case and the signs
    beside them make most of them new, while their pieces are known. Words with a character beyond ``_LETTERS``, ``_SIGNS`` and digits, or with
    a special string, are encoded whole.
    """

    def __init__(self, path: str, end_id: int | None):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        between = self.tokenizer.encode(_BETWEEN, add_special_tokens=False).ids
        self.between = between[0] if len(between) == 1 else None
        file = json.loads(self.tokenizer.to_str())
        self.special = [x["content"] for x in file["added_tokens"]]
        folding, cuts = ((file[k] or {}).get(kinds) for k, kinds in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers")))
        bytes_only = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}
        takes_apart = folding == _FOLDING and bool(cuts) and cuts[0] == _CUTS and len(cuts) == 2 and bytes_only.items() <= cuts[1].items()
        self.words = _Kept(self._taken_apart if takes_apart else self._encoded)
        self.pieces = _Kept(self._encoded_pieces)
        #: Of each id, whether a piece ends there.
        ending, vocabulary = file["model"].get("end_of_word_suffix"), self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        if ending:
            self.ends[[i for token, i in vocabulary.items() if token.endswith(ending)]] = True
        self.folded = Tokenizer.from_file(path)
        self.folded.normalizer = None

    def _apart(self, words: list[str]) -> list[bytes]:
        return [np.array(found.ids, "<u4").tobytes() for found in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _encoded(self, words: list[str]) -> list[bytes]:
        """The ids of each word, in runs that share the cost of a call."""
        if self.between is None:
            return self._apart(words)
        runs = [words[k : k + _AT_ONCE] for k in range(0, len(words), _AT_ONCE)]
        out = []
        for run, found in zip(runs, self.tokenizer.encode_batch_fast([f" {_BETWEEN} ".join(run) for run in runs], add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            cuts = np.flatnonzero(ids == self.between).tolist()
            if len(cuts) != len(run) - 1:  # a word holds the character itself
                out += self._apart(run)
                continue
            raw = ids.tobytes()
            out += [raw[4 * a : 4 * b] for a, b in zip([0, *(c + 1 for c in cuts)], [*cuts, len(ids)])]
        return out

    def _encoded_pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece, which is folded and not cut further; where the ids show each piece's end, nothing stands between them."""
        runs = [pieces[k : k + _AT_ONCE] for k in range(0, len(pieces), _AT_ONCE)]
        out = []
        for run, found in zip(runs, self.folded.encode_batch_fast([" ".join(run) for run in runs], add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            cuts = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            if len(cuts) != len(run) or cuts[-1] != len(ids):
                out += self._encoded(run)
                continue
            raw = ids.tobytes()
            out += [raw[4 * a : 4 * b] for a, b in zip([0, *cuts], cuts)]
        return out

    def _taken_apart(self, words: list[str]) -> list[bytes]:
        """The ids of each word, put together from those of its pieces."""
        text = "\n".join(words)
        odd: list[str] = []
        if _ODD.search(text) or any(s in text for s in self.special):
            odd = [w for w in words if _ODD.search(w) or any(s in w for s in self.special)]
            whole = dict(zip(odd, self._encoded(odd)))
            words, every = [w for w in words if w not in whole], words
            text = "\n".join(words)
        mark = b"\xff\xff\xff\xff"  # no run of ids holds it
        parts = _PIECE.findall(text.lower())
        known = self.pieces.learn(set(parts) - {"\n"})
        known["\n"] = mark
        out = b"".join(map(known.__getitem__, parts)).split(mark) if words else []
        if not odd:
            return out
        whole.update(zip(words, out))
        return [whole[w] for w in every]

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; texts that come together share the cost of their words."""
        split = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        bounds = split.offsets.to_numpy()
        words = split.flatten().dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = self.words.learn(set(distinct) - {""})
        known[""] = b""
        each = list(map(known.__getitem__, distinct))
        sizes = np.fromiter(map(len, each), np.int64, len(each)) // 4
        at = words.indices.to_numpy()
        counts, first = sizes[at], np.cumsum(sizes) - sizes
        ends = np.concatenate([[0], np.cumsum(counts)])
        ids = np.frombuffer(b"".join(each), "<u4")[np.repeat(first[at] - ends[:-1], counts) + np.arange(ends[-1])].tobytes()
        cuts = (4 * ends[bounds]).tolist()
        return [ids[a:b] + self.end for a, b in zip(cuts, cuts[1:])]


def _together(texts: Iterable[str | None]) -> Iterator[list[str]]:
    """Runs of texts of some size in all, or one longer text."""
    run, size = [], 0
    for text in texts:
        text = text or ""
        if run and size + len(text) > _TEXT_RUN:
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text)
    if run:
        yield run


_TOKENIZERS: dict[tuple[str, int | None], WordTokenizer] = {}


def _tokenizer(path: str, end_id: int | None) -> WordTokenizer:
    """One per Python worker, so that its words stay known from task to task."""
    if (path, end_id) not in _TOKENIZERS:
        _TOKENIZERS[path, end_id] = WordTokenizer(path, end_id)
    return _TOKENIZERS[path, end_id]


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, end_id: int | None = 2, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens`` (and ``ids``) of every piece of every document of ``doc_id, text``.

    A document is cut every ``capacity`` ids; each id is in exactly one piece. NULL text is empty and, with an
    ``end_id``, still has that id; without one an empty document has no piece. Repeated rows are packed as often as they occur.
    """

    def run(batches):
        tokenizer = _tokenizer(tokenizer_path, end_id)
        for batch in batches:
            rows = [[] for _ in range(6)]
            found = itertools.chain.from_iterable(map(tokenizer.ids, _together(text.as_py() for text in batch.column("text"))))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), found):
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    piece = ids[4 * start : 4 * (start + capacity)]
                    for column, value in zip(rows, (doc_id, start, len(piece) // 4, zlib.crc32(piece), total, piece)):
                        column.append(value)
            arrays = [pa.array(x, pa.int64()) for x in rows[:5]]
            if with_ids:
                arrays.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in rows[5]], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][: len(arrays)])

    return in_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, _PIECES + (", ids array<int>" if with_ids else ""))


@dataclass
class Plan:
    """Where the pieces of each length go: those of rank ``first`` and on, up to the next entry's, fill sequences from ``sequence`` at ``offset``."""

    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    patterns: list[tuple[tuple[int, ...], int]]

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # lengths and ranks as one ordered key; an entry holds from its first rank to the next entry's
        entry = np.zeros(len(length), np.int64)
        for value in np.unique(length):
            own = np.flatnonzero(length == value)
            low, high = np.searchsorted(self.length, [value, value + 1])
            entry[own] = low + np.searchsorted(self.first[low:high], rank[own], "right") - 1
        return self.sequence[entry] + rank - self.first[entry], self.offset[entry]


def shortest_pack_first(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Packing patterns for a histogram of lengths, without looking at single pieces.

    Lengths are placed longest first, all pieces of a length together: they join the packs that are shortest so
    far, and a pattern held by more packs than there are pieces left is split. Where not even the shortest pack has room, each
    piece opens a pack. The work depends on the number of distinct lengths (at most ``capacity``), not on that of pieces.
    """
    heap: list[tuple[int, int, int, tuple]] = []  # tokens so far, first sequence, number of sequences, pattern
    entries, closed, sequences = [], [], 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left > 0:
            if heap and heap[0][0] + length <= capacity:
                total, at, count, pattern = heapq.heappop(heap)
                used = min(left, count)
                if count > used:
                    heapq.heappush(heap, (total, at + used, count - used, pattern))
            else:
                total, at, used, pattern = 0, sequences, left, ()
                sequences += used
            entries.append((length, rank, at, total))
            grown = (total + length, at, used, (*pattern, length))
            if grown[0] < capacity:
                heapq.heappush(heap, grown)
            else:
                closed.append(grown)
            left, rank = left - used, rank + used
    entries.sort()
    columns = [np.array(x, np.int64) for x in zip(*entries)] or [np.zeros(0, np.int64)] * 4
    counts: dict[tuple[int, ...], int] = {}
    for _, _, used, pattern in [*closed, *heap]:
        counts[pattern] = counts.get(pattern, 0) + used
    return Plan(*columns, sorted(counts.items(), key=lambda x: -x[1]))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: sequences of at most ``capacity`` tokens, gapless from offset 0.

    ``pieces`` needs ``doc_id, start, length`` and is written to the shared folder first. Pieces of a length are
    ranked in parts (by a hash of document and start) whose sizes are added up, so a length that a third of all pieces
    have is ranked by many tasks; the driver sees one count per length. An empty table gives an empty result.
    """
    pieces = stored(pieces, "pieces")
    parts = shuffle_width(pieces.sparkSession)
    salted = pieces.withColumn("_part", F.pmod(F.xxhash64("doc_id", "start"), F.lit(parts)))
    sizes = salted.groupBy("length", "_part").agg(F.count("*").alias("_n"))
    sizes = stored(sizes.withColumn("_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))), "lengths")
    plan = shortest_pack_first({r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("_n").alias("n")).collect()}, capacity)
    rank = F.row_number().over(Window.partitionBy("length", "_part").orderBy("doc_id", "start")) - 1
    ranked = salted.withColumn("_own", rank).join(sizes.drop("_n"), ["length", "_part"])
    ranked = ranked.select(*pieces.columns, (F.col("_own") + F.coalesce("_before", F.lit(0))).cast("long").alias("_rank"))

    names = pieces.columns

    def run(batches):
        for batch in batches:
            sequence, offset = plan.place(batch.column("length").to_numpy(), batch.column("_rank").to_numpy())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return in_arrow(ranked, run, f"{fields}, sequence_id long, offset long")


def sequences(packed: DataFrame, pad_id: int | None = None, capacity: int = CAPACITY) -> DataFrame:
    """``sequence_id, input_ids, doc_ids, starts, lengths`` from packed pieces with ids; padded to ``capacity`` unless its length is a power of two."""
    entry = F.struct("offset", "doc_id", "start", "length", "ids")
    rows = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(entry)).alias("parts"))
    ids = F.flatten("parts.ids")
    if pad_id is not None:
        n = F.size(ids)
        power = n.bitwiseAND(n - 1) == 0
        ids = F.when(power, ids).otherwise(F.concat(ids, F.array_repeat(F.lit(pad_id), F.lit(capacity) - n)))
    return rows.select("sequence_id", ids.alias("input_ids"), *[F.col(f"parts.{c}").alias(f"{c}s") for c in ("doc_id", "start", "length")])
