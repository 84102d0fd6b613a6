"""Language identification in two steps: the family first, then one-versus-one classifiers within it."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm._arrow import in_arrow
from millrace.llm._words import Slice, slices

# Families of closely related languages by ISO 639-1 code; any other language belongs to OTHER.
FAMILIES = {
    "germanic": ["de", "en", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb", "fy"],
    "romance": ["fr", "es", "it", "pt", "ca", "ro", "gl", "oc", "la"],
    "slavic": ["ru", "uk", "be", "pl", "cs", "sk", "bg", "mk", "sr", "hr", "bs", "sl"],
    "uralic": ["fi", "et", "hu"],
    "baltic": ["lt", "lv"],
    "turkic": ["tr", "az", "kk", "uz"],
}
OTHER = "other"
UNKNOWN = "und"
#: Features: hashed byte pairs and triples.
DIMENSIONS = 1 << 12
#: Bound of the labelled rows a classifier is fitted on, over all languages together.
SAMPLE_ROWS = 2000
_ROWS = 512
_STEPS = 120
_RIDGE = 1e-3


def _byte_classes() -> np.ndarray:
    """A-Z as a-z, every other ASCII byte that is no letter as a space."""
    out = np.full(256, 32, np.uint32)
    out[97:123], out[65:91] = np.arange(97, 123), np.arange(97, 123)
    out[128:] = np.arange(128, 256)
    return out


_CLASSES = _byte_classes()
_ASCII_LETTER = np.zeros(256, np.int64)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = 1


def _features(part: Slice) -> np.ndarray:
    """A row of unit length for each text: square roots of its counts of byte pairs and triples between letters and spaces."""
    rows, n = part.rows, len(part.data)
    out = np.zeros(rows * DIMENSIONS, np.float32)
    if n > 1:
        codes = _CLASSES[part.data]
        row = np.repeat(np.arange(rows, dtype=np.int64), np.diff(part.offsets))
        gram = codes
        for width in (2, 3):
            if n < width:
                break
            gram = gram[: n - width + 1] * np.uint32(256) + codes[width - 1 :]
            blank = gram == np.uint32(sum(32 << 8 * k for k in range(width)))
            inside = (row[: n - width + 1] == row[width - 1 :]) & ~blank
            bucket = (gram * np.uint32(0x9E3779B1)) >> np.uint32(20)
            at = row[: n - width + 1][inside] * DIMENSIONS + bucket[inside]
            out += np.bincount(at, minlength=len(out)).astype(np.float32)
    out = np.sqrt(out).reshape(rows, DIMENSIONS)
    norm = np.sqrt((out * out).sum(1, keepdims=True))
    return out / np.maximum(norm, 1e-9)


def _has_letter(part: Slice, texts: pa.Array) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(_ASCII_LETTER[part.data])])[part.offsets]
    found = np.diff(sums) > 0
    for r in np.flatnonzero(~found & (np.diff(part.offsets) > 0)):
        found[r] = any(c.isalpha() for c in texts[part.first_row + int(r)].as_py())
    return found


@dataclass
class Line:
    """A linear classifier with the slope and shift that turn its margin into a probability."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def chance(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (x @ self.weights + self.bias) + self.shift, -30, 30)))


def _fit_line(x: np.ndarray, y: np.ndarray) -> Line:
    """A linear support vector machine (squared hinge, both classes of equal weight) by accelerated gradient steps."""
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    w = v = np.zeros(x.shape[1] + 1, np.float32)
    step = 1 / (2 * 2 + _RIDGE)  # rows have length 1 and the bias 1: the curvature is at most 4
    for t in range(_STEPS):
        gap = np.maximum(0, 1 - y * (x @ v[:-1] + v[-1]))
        pull = -2 * weight * y * gap
        grad = np.concatenate([x.T @ pull + _RIDGE * v[:-1], [pull.sum()]]).astype(np.float32)
        new = v - step * grad
        v = new + t / (t + 3) * (new - w)
        w = new
    margin = x @ w[:-1] + w[-1]
    a, b, goal = 1.0, 0.0, np.where(y > 0, 0.99, 0.01)
    for _ in range(20):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        d, h = weight * (p - goal), weight * np.maximum(p * (1 - p), 1e-6)
        hess = np.array([[(h * margin * margin).sum() + 1e-6, (h * margin).sum()], [(h * margin).sum(), h.sum() + 1e-6]])
        move = np.linalg.solve(hess, [(d * margin).sum(), d.sum()])
        a, b = float(np.clip(a - move[0], 0.1, 200)), float(np.clip(b - move[1], -50, 50))
    return Line(w[:-1], float(w[-1]), a, b)


def family_of(lang: str) -> str:
    return next((name for name, langs in FAMILIES.items() if lang in langs), OTHER)


@dataclass
class LanguageModel:
    """Families with their languages, a classifier per family against the rest, and one per pair within a family."""

    members: dict[str, list[str]]
    families: dict[str, Line]
    pairs: dict[tuple[str, str], Line]

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        names = list(self.members)
        odds = np.stack([self.families[f].chance(x) if len(names) > 1 else np.ones(len(x)) for f in names], 1)
        odds = odds / np.maximum(odds.sum(1, keepdims=True), 1e-9)
        best = odds.argmax(1)
        langs, score = np.empty(len(x), object), odds.max(1)
        for k, family in enumerate(names):
            own = np.flatnonzero(best == k)
            if not len(own):
                continue
            inside = self.members[family]
            votes, chances = np.zeros((len(own), len(inside))), np.zeros((len(own), len(inside)))
            for i, j in combinations(range(len(inside)), 2):
                p = self.pairs[inside[i], inside[j]].chance(x[own])
                votes[:, i] += p >= 0.5
                votes[:, j] += p < 0.5
                chances[:, i] += p
                chances[:, j] += 1 - p
            chances = chances / max(1, len(inside) * (len(inside) - 1) / 2) if len(inside) > 1 else chances + 1
            pick = (votes + 1e-3 * chances).argmax(1)
            langs[own] = np.array(inside, object)[pick]
            score[own] *= chances[np.arange(len(own)), pick]
        return list(langs), np.clip(score, 0, 1)


def fit(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> LanguageModel | None:
    """A model from ``text, lang`` of ``labelled``; None where no row has both.

    At most about ``sample_rows`` distinct texts are used, an even share of each language, picked by the hash of the
    text over the whole table. Only their feature vectors reach the driver.
    """
    rows = labelled.select("text", "lang").filter("lang IS NOT NULL AND length(text) > 0")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return None
    share = sample_rows / len(counts)
    part = (F.xxhash64("text") % 1_000_000 + 1_000_000) % 1_000_000
    chosen = F.lit(False)
    for lang, n in counts.items():
        chosen = chosen | ((F.col("lang") == lang) & (part < int(min(1, share / n) * 1_000_000 + 1)))
    picked = rows.filter(chosen).groupBy("lang", F.xxhash64("text").alias("key")).agg(F.first("text").alias("text"))

    def run(batches):
        for batch in batches:
            for cut in slices(batch.column("text"), most_rows=_ROWS):
                x = _features(cut).astype(np.float16)
                yield pa.RecordBatch.from_arrays([batch.column("lang").slice(cut.first_row, cut.rows), batch.column("key").slice(cut.first_row, cut.rows), pa.array([r.tobytes() for r in x], pa.binary())], ["lang", "key", "x"])

    found = in_arrow(picked, run, "lang string, key long, x binary").toArrow().sort_by([("lang", "ascending"), ("key", "ascending")])
    langs = np.array(found.column("lang").to_pylist(), object)
    x = np.empty((len(langs), DIMENSIONS), np.float32)
    for k, vector in enumerate(found.column("x")):
        x[k] = np.frombuffer(vector.as_buffer(), np.float16)
    del found
    members: dict[str, list[str]] = {}
    for lang in sorted(set(langs)):
        members.setdefault(family_of(lang), []).append(lang)
    home = np.array([family_of(x) for x in langs], object)
    families = {f: _fit_line(x, np.where(home == f, 1, -1).astype(np.float32)) for f in members} if len(members) > 1 else {}
    pairs = {}
    for inside in members.values():
        for one, two in combinations(inside, 2):
            own = (langs == one) | (langs == two)
            pairs[one, two] = _fit_line(x[own], np.where(langs[own] == one, 1, -1).astype(np.float32))
    return LanguageModel(members, families, pairs)


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``row, lang_pred, score``: each row of ``docs`` as a struct, its language and how sure the model is (0 to 1).

    Only ``text`` is looked at, the whole of it. A text that is NULL, empty or without a letter is ``und`` with score 0, and so
    is every text where nothing could be learned. Equal texts get equal answers. Other columns may have any names.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.select("row", F.col("row.text").alias("text"))

    def run(batches):
        for batch in batches:
            texts = batch.column("text")
            langs, score = np.full(batch.num_rows, UNKNOWN, object), np.zeros(batch.num_rows)
            for part in slices(texts, most_rows=_ROWS) if model else ():
                letters = np.flatnonzero(_has_letter(part, texts))
                if len(letters):
                    found, sure = model.predict(_features(part)[letters])
                    langs[part.first_row + letters], score[part.first_row + letters] = found, sure
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(langs, pa.string()), pa.array(score)], ["row", "lang_pred", "score"])

    return in_arrow(rows, run, f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double")


def in_fold(doc_id, modulus: int, remainder: int):
    """Whether a row is held out: its crc32 of the doc_id as text has this remainder (a NULL doc_id is never held out)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus == remainder, F.lit(False))
