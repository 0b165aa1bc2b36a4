"""Language identification in two steps: the family first, then the language within it.

Both steps are linear support vector machines on hashed character n-grams of the whole text:
one-versus-rest machines choose the family, one-versus-one machines vote among the languages of
that family. They are trained in one Spark task, on a sample of labelled documents whose size is
bounded by ``TOTAL_ROWS`` rows in all, shared evenly by the languages, whatever the size of the
table and the number of distinct ``lang`` values. Feature rows are float32 (16 KB a row, so at most
64 MB for the sample); the machines never copy them all, but take a few hundred at a time.

A text that is null, empty or without a letter is ``und`` with score 0. A language that no family
names belongs to the family ``other``. Without labelled rows every text is ``und``.

A model also knows how narrow the margins of its languages get: machines trained on one half of the
sample are tried on the other half. A text far below that is in no learned language, although
``predict`` names the nearest one; ``documents_in`` drops it. A single language has no margins, so
nothing is dropped there but ``und``.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagefolio.llm.batches import small_batches
from pagefolio.llm.text import slices

FAMILIES = {
    "germanic": ["en", "de", "nl", "sv", "da", "no"],
    "romance": ["fr", "es", "it", "pt", "ro", "ca"],
    "slavic": ["ru", "uk", "pl", "cs", "bg", "sr"],
}
BUCKETS = 4096
# Labelled rows that training reads at most, shared by the languages (a documented sample bound).
TOTAL_ROWS = 4000
# A text is in a language if its margins reach this share of those that all but one in a hundred
# texts of the language reach. Languages of fewer rows than ``LEAST_ROWS`` reject nothing.
FLOOR_SHARE, FLOOR_QUANTILE, LEAST_ROWS = 0.2, 0.01, 20
# A letter is a character of the Unicode category L (as \pL in SQL): not ½, ² or Ⅷ.
LETTER = regex.compile(r"\p{L}")
# Characters that are turned into bytes and counted at a time.
CHUNK_CHARS = 1 << 20
# Feature rows or columns of a product. Machines count in float64, and numpy copies what it multiplies as such.
FIT_ROWS, FIT_COLUMNS = 512, 64


def features(text: str) -> np.ndarray:
    """Unit vector of the square roots of hashed 1- to 4-byte n-gram counts."""
    counts = np.zeros(BUCKETS)
    for start in range(0, len(text), CHUNK_CHARS):
        # Chunks overlap by a few bytes less than the longest n-gram would need; with chunks this
        # large that changes nothing that matters.
        code = np.frombuffer(text[start : start + CHUNK_CHARS].lower().encode("utf-8", "replace"), np.uint8)
        code = code.astype(np.uint32)
        key = code
        for size in range(1, 5):
            if len(code) < size:
                break
            if size > 1:
                key = key[:-1] * np.uint32(16777619) ^ code[size - 1 :]
            mixed = (key * np.uint32(2654435761) + np.uint32(size)) >> np.uint32(20)
            counts += np.bincount(mixed, minlength=BUCKETS)
    out = np.sqrt(counts)
    norm = np.linalg.norm(out)
    return out / norm if norm else out


class _Rows:
    """Some rows of several arrays as one matrix with a bias column, multiplied a part at a time.

    A row's product takes whole rows and a column's product whole columns, so every sum has the order that it
    has in one matrix.
    """

    def __init__(self, parts: list[np.ndarray], chosen: np.ndarray):
        ends = np.cumsum([len(part) for part in parts])
        self.parts = [(part, np.flatnonzero(mine)) for part, mine in zip(parts, np.split(chosen, ends[:-1]), strict=True)]
        self.ends = np.cumsum([len(at) for _, at in self.parts])
        self.width = parts[0].shape[1] + 1

    def _cut(self, start: int, end: int, left: int, right: int) -> np.ndarray:
        out = np.ones((end - start, right - left))
        for (part, at), stop in zip(self.parts, self.ends, strict=True):
            low, high = max(start, stop - len(at)), min(end, stop)
            if low < high:
                found = at[low - stop + len(at) : high - stop + len(at)]
                out[low - start : high - start, : self.width - 1 - left] = part[found, left : min(right, self.width - 1)]
        return out

    def times(self, w: np.ndarray) -> np.ndarray:
        n = int(self.ends[-1])
        return np.concatenate([np.zeros(0), *(
            self._cut(i, min(i + FIT_ROWS, n), 0, self.width) @ w for i in range(0, n, FIT_ROWS)
        )])

    def transposed_times(self, v: np.ndarray) -> np.ndarray:
        edges = [*range(0, max(self.width - FIT_COLUMNS, 1), FIT_COLUMNS), self.width]
        # numpy turns a transposed matrix that it must copy, which tells the order of the sums.
        return np.concatenate([
            np.ascontiguousarray(self._cut(0, len(v), i, j).T) @ v for i, j in zip(edges, edges[1:], strict=False)
        ])


def fit_svm(parts: list[np.ndarray], y: np.ndarray, penalty: float = 1e-4, rounds: int = 60) -> np.ndarray:
    """Weights, bias last, of a linear machine with squared hinge loss; ``y`` is -1 or 1 for each row of ``parts``.

    Newton steps with conjugate gradients; both classes weigh the same in the loss.
    """
    x = _Rows(parts, np.ones(len(y), bool))
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1))
    w = np.zeros(x.width)
    for _ in range(rounds):
        slack = 1 - y * x.times(w)
        active = slack > 0
        xa, ca = _Rows(parts, active), weight[active]
        gradient = penalty * w - xa.transposed_times(ca * y[active] * slack[active])
        if np.linalg.norm(gradient) < 1e-6:
            break
        step, r = np.zeros_like(w), -gradient
        p, rr = r.copy(), r @ r
        for _ in range(25):
            hp = penalty * p + xa.transposed_times(ca * xa.times(p))
            alpha = rr / max(p @ hp, 1e-30)
            step += alpha * p
            r -= alpha * hp
            rr, old = r @ r, rr
            if rr < 1e-14:
                break
            p = r + rr / old * p
        w = w + step
    return w


def sample_rows(labelled: DataFrame, total: int = TOTAL_ROWS) -> DataFrame:
    """``lang, place, x``: float32 feature rows of at most about ``total // languages`` documents per language.

    Rows are taken by the hash of the text: a threshold per language, from its count, keeps
    about as many as wanted, so that no text is sorted or gathered anywhere.
    """
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    per_language = max(1, total // max(len(sizes), 1))
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, per_language / n))).otherwise(share)
    place = (F.xxhash64("text", "doc_id") / F.lit(2.0**64)) + 0.5
    chosen = labelled.select("lang", "text", place.alias("place")).filter(place <= share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = [features(t).astype(np.float32).tobytes() for t in part.column(1).to_pylist()]
                yield pa.record_batch(
                    [part.column(0), part.column(2), pa.array(rows, pa.binary())], ["lang", "place", "x"]
                )

    return chosen.mapInArrow(run, "lang string, place double, x binary").withColumn("_quota", F.lit(per_language))


def _stacked(rows: Iterable[tuple[str, float, bytes, int]]) -> dict[str, np.ndarray]:
    """Feature rows by language, at most the quota that each row names, the first by hash place."""
    found: dict[str, list] = {}
    per_language = 1
    for lang, place, x, per_language in rows:
        found.setdefault(lang, []).append((place, x))
    samples = {}
    for lang in sorted(found):
        taken = sorted(found.pop(lang))[:per_language]
        samples[lang] = np.frombuffer(b"".join(x for _, x in taken), np.float32).reshape(len(taken), BUCKETS)
    return samples


def sample_features(labelled: DataFrame, total: int = TOTAL_ROWS) -> dict[str, np.ndarray]:
    """The sample of ``sample_rows`` on the driver (for tests and small tables)."""
    return _stacked((r["lang"], r["place"], bytes(r["x"]), r["_quota"]) for r in sample_rows(labelled, total).collect())


class LanguageModel:
    """Family machines and, per family, one machine for each pair of its languages."""

    def __init__(self, samples: dict[str, np.ndarray], families: dict[str, list[str]] = FAMILIES, floors: bool = True):
        home = {lang: family for family, langs in families.items() for lang in langs}
        self.members: dict[str, list[str]] = {}
        for lang in sorted(samples):
            self.members.setdefault(home.get(lang, "other"), []).append(lang)
        self.families = sorted(self.members)
        self.family_weights = self._one_versus_rest(samples)
        self.pair_weights = {
            (a, b): fit_svm([samples[a], samples[b]], np.r_[np.ones(len(samples[a])), -np.ones(len(samples[b]))])
            for langs in self.members.values()
            for a, b in combinations(langs, 2)
        }
        self.floors = self._floors(samples, families) if floors else {}

    @staticmethod
    def _floors(samples: dict[str, np.ndarray], families: dict[str, list[str]]) -> dict[str, tuple[float, float]]:
        """Least family and pair margin of a text of each language, from rows that the machines did not see."""
        found: dict[str, list] = {}
        for fold in (0, 1):
            seen = {lang: x[fold::2] if len(x) > 1 else x for lang, x in samples.items()}
            half = LanguageModel(seen, families, floors=False)
            for lang, x in samples.items():
                if len(x) >= LEAST_ROWS:
                    tried = [half.decide(np.append(row, np.float32(1.0))) for row in x[1 - fold :: 2]]
                    found.setdefault(lang, []).extend(margins for name, *margins in tried if name == lang)
        return {
            lang: tuple(FLOOR_SHARE * np.quantile(rows, FLOOR_QUANTILE, axis=0, method="lower"))
            for lang, rows in found.items()
            if rows
        }

    def _one_versus_rest(self, samples: dict[str, np.ndarray]) -> np.ndarray:
        if len(self.families) < 2:
            return np.zeros((len(self.families), BUCKETS + 1))
        x = [samples[lang] for f in self.families for lang in self.members[f]]
        of = np.concatenate([[i] * len(samples[lang]) for i, f in enumerate(self.families) for lang in self.members[f]])
        return np.array([fit_svm(x, np.where(of == i, 1.0, -1.0)) for i in range(len(self.families))])

    def decide(self, x: np.ndarray) -> tuple[str, float, float]:
        """Language of a feature row with its bias, and the narrowest family and pair margins; infinite if there are none."""
        margins = self.family_weights @ x
        best = int(np.argmax(margins))
        rest = np.delete(margins, best)
        langs = self.members[self.families[best]]
        votes, support = dict.fromkeys(langs, 0), dict.fromkeys(langs, 0.0)
        pairs = {pair: float(self.pair_weights[pair] @ x) for pair in combinations(langs, 2)}
        for (a, b), margin in pairs.items():
            votes[a if margin >= 0 else b] += 1
            support[a] += margin
            support[b] -= margin
        lang = max(langs, key=lambda name: (votes[name], support[name]))
        family = float(margins[best] - rest.max()) if len(rest) else np.inf
        return lang, family, min((abs(m) for pair, m in pairs.items() if lang in pair), default=np.inf)

    def _known(self, text: str | None) -> tuple[str, float, float] | None:
        if not text or not self.families or not LETTER.search(text):
            return None
        return self.decide(np.append(features(text), 1.0))

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score; the score falls with the narrowest margin of the decision."""
        found = self._known(text)
        if found is None:
            return "und", 0.0
        certainty = min(found[1:])
        return found[0], float(1 / (1 + np.exp(-2 * certainty))) if certainty < np.inf else 1.0

    def language_of(self, text: str | None) -> str | None:
        """The language of a text whose margins are as wide as its language's texts have them, or None."""
        found = self._known(text)
        if found is None:
            return None
        lang, *margins = found
        return lang if all(m >= floor for m, floor in zip(margins, self.floors.get(lang, (0.0, 0.0)), strict=True)) else None


def remainder(doc_id: Column, mod: int) -> Column:
    """Remainder of the CRC-32 of an id written as text; null ids count as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % mod


def train(docs: DataFrame) -> LanguageModel:
    """A model of the documents that are not held out and have a text and a language.

    The machines are fitted in one Spark task over the bounded sample (at most ``TOTAL_ROWS`` rows
    of 16 KB); only the fitted model comes to the driver.
    """
    usable = docs.filter("text is not null and lang is not null")
    learned = usable.filter(remainder(F.col("doc_id"), 4) != 2)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        # The fitted state only: weights, languages and floors.
        state = LanguageModel(_stacked(rows)).__dict__
        yield pa.record_batch([pa.array([pickle.dumps(state)], pa.binary())], ["model"])

    # A shuffle, so that only the sample's rows meet in one task and texts are read by many.
    sample = sample_rows(learned.select("doc_id", "text", "lang")).repartition(1)
    with small_batches(docs.sparkSession):
        fitted = sample.mapInArrow(fit, "model binary").collect()
    model = LanguageModel.__new__(LanguageModel)
    model.__dict__.update(pickle.loads(fitted[0]["model"]) if fitted else LanguageModel({}).__dict__)
    return model


def predictions(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` in place of ``text`` and of columns of these names."""
    rest = [c for c in docs.columns if c not in ("text", "lang_pred", "score")]
    ddl = docs.select(*rest).schema.add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = [model.predict(t) for t in part.column("text").to_pylist()]
                yield pa.record_batch(
                    [part.column(c) for c in rest]
                    + [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                    [*rest, "lang_pred", "score"],
                )

    return docs.select(*rest, "text").mapInArrow(run, ddl)


def documents_in(docs: DataFrame, model: LanguageModel, languages: list[str] | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is in a learned (or one of the given) language.

    If no language could be learned, nothing speaks against a document, and all stay unless languages are given.
    """
    if not model.families and languages is None:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = [model.language_of(t) for t in part.column(part.schema.get_field_index("text")).to_pylist()]
                keep = [f is not None and (languages is None or f in languages) for f in found]
                yield part.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
