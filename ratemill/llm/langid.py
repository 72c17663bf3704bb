"""Language identification by words first, then ever shorter character n-grams (operator 7).

A word that the training texts hold is scored by its log frequency in each language. An unseen
word is scored by its n-grams of the longest size of which any is known, then by shorter ones
at a fixed discount. The scores of a text are added up; the language with the largest sum is the
prediction. Its score is the share of the text's words that this language explains best, which
does not grow with the length: it is low for a text in two languages and for garbled text.

The model is a table of all words of a bounded sample of labelled documents, and the n-grams of
these words. It is learned from text and label alone.

Null or empty text and text without a letter is ``und`` with score 0. Documents without label are
not learned from. Of equal sums the first language in the alphabet wins. If nothing could be
learned every text is ``und``. Texts of any length are taken whole, in pieces that end between
words; repeated rows get the same result, and an empty table gives no rows. Other columns pass
through; the two that are added must have names of their own.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType


UNDETERMINED = "und"
LETTERS = re.compile(r"[^\W\d_]+")
# Bounds of the sample: documents of a language, and characters of one of them.
SAMPLE_DOCS = 1_000
SAMPLE_CHARS = 100_000
ORDERS = (4, 3, 2, 1)
HELD_OUT = 2
DISCOUNT = math.log(0.4)
TEXT_BLOCK = 1 << 20
MET_WORDS = 1 << 16
ROWS_AT_A_TIME = 1_000


@dataclass
class Scores:
    """Log scores by name, one row for each and one column for each language."""

    at: dict[str, int]
    rows: np.ndarray

    @classmethod
    def of(cls, rows: dict[str, list[float] | np.ndarray], languages: int) -> Scores:
        return cls(dict(zip(rows, range(len(rows)))), np.array(list(rows.values()), float).reshape(-1, languages))

    def __contains__(self, name: str) -> bool:
        return name in self.at


@dataclass
class Model:
    languages: list[str]
    words: Scores
    grams: list[Scores]
    floor: float

    def _start(self) -> None:
        """One matrix with the scores of the known words, and room for words met later."""
        n = len(self.words.at)
        self.rows = np.empty((n + MET_WORDS, len(self.languages)))
        self.rows[:n] = self.words.rows
        self.met: dict[str, int] = {}

    def _back_off(self, words: list[str]) -> np.ndarray:
        """Scores of words that are not known: the mean over a word's n-grams of the first size
        of which any is known, less the discount for each size."""
        out = np.full((len(words), len(self.languages)), self.floor)
        left = list(range(len(words)))
        for step, (size, grams) in enumerate(zip(ORDERS, self.grams), 1):
            rows, scores = grams.at, grams.rows
            flat, counts, hit, rest = [], [], [], []
            for i in left:
                marked = f"<{words[i]}>"
                found = [rows[g] for k in range(len(marked) - size + 1) if (g := marked[k : k + size]) in rows]
                if found:
                    flat += found
                    counts.append(len(found))
                    hit.append(i)
                else:
                    rest.append(i)
            if hit:
                n = np.array(counts)
                out[hit] = np.add.reduceat(scores[flat], np.cumsum(n) - n) / n[:, None] + step * DISCOUNT
            left = rest
        return out

    def score(self, words: list[str]) -> np.ndarray:
        """Log scores of distinct words for all languages."""
        if not hasattr(self, "rows"):
            self._start()
        out = np.empty((len(words), len(self.languages)))
        for at in range(0, len(words), MET_WORDS):
            some = words[at : at + MET_WORDS]
            if len(self.met) + len(some) > MET_WORDS:
                self.met.clear()
            known, met = self.words.at, self.met
            new = [w for w in some if w not in known and w not in met]
            if new:
                first = len(known) + len(met)
                self.rows[first : first + len(new)] = self._back_off(new)
                met.update(zip(new, range(first, first + len(new))))
            out[at : at + len(some)] = self.rows[[known[w] if w in known else met[w] for w in some]]
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        counts: Counter[str] = Counter()
        for part in _parts(text or ""):
            counts.update(LETTERS.findall(part.lower()))
        if not self.languages or not any(c.isalpha() for w in counts for c in w):
            return UNDETERMINED, 0.0
        times = np.fromiter(counts.values(), float, len(counts))
        scores = self.score(list(counts))
        best = int((times @ scores).argmax())
        explained = scores[:, best] >= scores.max(axis=1)
        return self.languages[best], float(times @ explained / times.sum())


def _parts(text: str) -> Iterator[str]:
    """Pieces of a long text that end between words."""
    at = 0
    while at < len(text):
        stop = min(len(text), at + TEXT_BLOCK)
        while stop < len(text) and text[stop].isalpha():
            stop += 1
        yield text[at:stop]
        at = stop


def _log_share(counts: np.ndarray) -> np.ndarray:
    """Log frequency per language (column), one added to each count."""
    return np.log(counts + 1.0) - np.log(counts.sum(axis=0) + max(1, len(counts)))


def train(
    docs: DataFrame, text_col: str, label_col: str, key: Column, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS
) -> Model:
    """Learn from about ``sample_docs`` documents of each language, drawn by the hash of ``key``
    from those of at most ``sample_chars`` characters.

    The driver gets the words of the sample with their counts.
    """
    fits = F.char_length(text_col) <= sample_chars
    labelled = docs.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull() & fits)
    sizes = {r[0]: r[1] for r in labelled.groupBy(label_col).count().collect()}
    languages = sorted(sizes)
    n = len(languages)
    if not languages:
        return Model([], Scores({}, np.zeros((0, 0))), [], 0.0)
    scale = 1 << 30
    share = F.create_map(*(F.lit(x) for name in languages for x in (name, min(scale, scale * sample_docs // sizes[name]))))
    drawn = labelled.where(F.pmod(F.xxhash64(key), F.lit(scale)) < share[F.col(label_col)])
    words = drawn.select(F.col(label_col).alias("label"), F.explode(F.regexp_extract_all(F.lower(text_col), F.lit(r"\p{L}+"), F.lit(0))).alias("word"))
    found = words.groupBy("word").agg(*(F.count_if(F.col("label") == name).alias(f"n{i}") for i, name in enumerate(languages))).toArrow()
    names = found.column("word").to_pylist()
    counts = np.stack([found.column(f"n{i}").to_numpy() for i in range(n)], axis=1).astype(float)
    grams = []
    for size in ORDERS:
        at: dict[str, int] = {}
        flat: list[int] = []
        of: list[int] = []
        for k, word in enumerate(names):
            marked = f"<{word}>"
            own = [at.setdefault(marked[i : i + size], len(at)) for i in range(len(marked) - size + 1)]
            flat += own
            of += [k] * len(own)
        sums = np.stack([np.bincount(flat, counts[of, i], len(at)) for i in range(n)], axis=1) if at else np.zeros((0, n))
        grams.append(Scores(at, _log_share(sums)))
    floor = float(grams[-1].rows.min(initial=0.0)) + (len(ORDERS) + 1) * DISCOUNT
    return Model(languages, Scores(dict(zip(names, range(len(names)))), _log_share(counts)), grams, floor)


def predict(docs: DataFrame, text_col: str, model: Model, language: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score, under names that ``docs`` must not
    have."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            column = batch.column(at)
            found = [own.predict(t) for k in range(0, len(column), ROWS_AT_A_TIME) for t in column.slice(k, ROWS_AT_A_TIME).to_pylist()]
            added = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, language, score])

    schema = StructType([*docs.schema.fields, StructField(language, StringType()), StructField(score, DoubleType())])
    return docs.mapInArrow(run, schema)


def fold(id_col: Column) -> Column:
    """Fold 0 to 3 of a document; a null id counts as the empty text."""
    return F.coalesce(F.crc32(id_col.cast("string")), F.lit(0)) % 4


def identify(docs: DataFrame, id_col: str, text_col: str, label_col: str) -> Model:
    """The model of all labelled documents outside the held-out fold."""
    key = docs[id_col]
    return train(docs.where(fold(key) != HELD_OUT), text_col, label_col, F.coalesce(key.cast("string"), F.lit("")))
