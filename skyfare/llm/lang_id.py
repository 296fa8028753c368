"""Language ID by a linear-chain conditional random field over words (``crf``).

Features of a word are its affixes, n-grams and lexicon entry; transitions are
learned from sequences that join pieces of different training texts, so that
switches inside a text are followed.  Forward-backward gives each word's label
marginals; a text's language is the label with the largest mean over all its
words, and the score is that mean.

The model is fitted on a bounded sample of every language that labels a row:
about ``SAMPLE_PER_LANG`` labelled texts of each (up to twice as many), fewer
with many languages (``texts_per_lang``) but one at least, about ``WINDOW``
characters of each text, chosen by a hash.  A language counts as soon as one of
its texts has a letter in its window.  Prediction reads whole texts; texts of more than ``PIECE`` words are labelled
piece by piece and the means go over all pieces.

Invalid UTF-8 reads as U+FFFD.  A null text or one without a letter is ``und`` with score 0, and so is
everything if there is no labelled row; ``keep_clear`` then keeps every text
with a letter, as nothing tells which are unclear.  Ties go to the label that sorts first.
Repeated rows get equal results; null ids pass through; extra columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfare.llm import crf
from skyfare.llm.common import prepare, slices, texts, worker_state

SAMPLE_PER_LANG, WINDOW = 300, 1500
#: Fewest texts of a language to aim at, and texts times squared languages, which training time goes by.
LEAST_PER_LANG, WORK = 4, 1 << 19
PIECE = 100_000
UNKNOWN = "und"
WORD = r"\p{L}+"
#: Words whose potentials a worker keeps, about; and words labelled at once.
KEEP, STREAM = 1 << 18, 1 << 17
#: Words times labels of the words kept and of those labelled at once, which are fewer with many labels.
KEEP_CELLS, STREAM_CELLS = 1 << 24, 1 << 22


def texts_per_lang(langs: int) -> int:
    return max(LEAST_PER_LANG, min(SAMPLE_PER_LANG, WORK // langs ** 2))


def sample(labelled: DataFrame) -> list[tuple[str, str]]:
    """(lang, window of text) of a bounded number of rows of each language of ``labelled`` (id, text, lang)."""
    labelled = labelled.filter("lang IS NOT NULL AND text IS NOT NULL")
    key = F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("text"))
    start = F.pmod(F.xxhash64(key), F.greatest(F.lit(1), F.length("text") - WINDOW)).cast("int") + 1
    window = F.substring("text", start, F.lit(WINDOW))
    # the least key of those whose window has a letter is taken in any case, so that each language has a text
    least = F.min(F.when(window.rlike(r"\p{L}"), key))
    counts = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), least.alias("least")).collect()
    if not counts:
        return []
    each = texts_per_lang(len(counts))
    one_in = labelled.sparkSession.createDataFrame(
        [(r["lang"], max(1, r["n"] // each), r["least"]) for r in counts], "lang string, m long, least long")
    # one row for each language; repeated rows count once
    rows = (labelled.join(F.broadcast(one_in), "lang")
            .filter((F.pmod(key, F.col("m")) == 0) | key.eqNullSafe(F.col("least")))
            .select("lang", window.alias("x"), key.alias("key")).distinct().collect())
    rows.sort(key=lambda r: (r["key"], r["lang"]))
    return [(r["lang"], r["x"]) for r in rows]


class Model:
    """Labels and weights of a fitted field; small, so it is broadcast."""

    def __init__(self, rows: list[tuple[str, str]]):
        self.key = uuid.uuid4().hex  # tells models apart in a worker
        find = regex.compile(WORD).findall
        found = [(lang, words) for lang, x in rows if (words := find(x.lower()))]
        self.labels = sorted({lang for lang, _ in found})
        if not found:
            return
        place = {x: i for i, x in enumerate(self.labels)}
        stream, label, start = [], [], []
        # sequences of 1 to 4 pieces from neighbouring rows: most texts stay in one language, some switch
        rng, left = np.random.default_rng(7), 0
        for lang, words in found:
            if left == 0:
                left = int(rng.integers(1, 5))
                start.append(len(stream))
            left -= 1
            stream += words
            label += [place[lang]] * len(words)
        ids: dict[str, int] = {}
        word_of = np.array([ids.setdefault(w, len(ids)) for w in stream])
        begins = np.zeros(len(stream), bool)
        begins[start] = True
        weights, trans, first, self.lexicon = crf.train(list(ids), word_of, np.array(label), begins, len(self.labels))
        self.weights = weights
        self.trans, self.first = np.exp(trans - trans.max()), np.exp(first - first.max())


class Labeller:
    """Applies a model; keeps the potentials of words it has met."""

    def __init__(self, model: Model):
        self.model, self.find = model, regex.compile(WORD).findall
        self.rows: dict[str, int] = {}
        self.potentials = np.empty((0, len(model.labels)), np.float32)

    def _potentials(self, words: list[str]) -> np.ndarray:
        if len(self.rows) > min(KEEP, KEEP_CELLS // len(self.model.labels)):
            self.rows, self.potentials = {}, self.potentials[:0]
        new = list(set(words).difference(self.rows))
        if new:
            buckets, owners, _ = crf.word_features(new, self.model.lexicon, crf.buckets_log2(len(self.model.labels)))
            scores = crf.emissions(self.model.weights, buckets, owners, len(new))
            self.rows.update(zip(new, range(len(self.rows), len(self.rows) + len(new)), strict=True))
            self.potentials = np.concatenate([self.potentials, crf.potentials(scores)])
        return self.potentials[np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))]

    def marginals(self, words: list[str], start: np.ndarray) -> np.ndarray:
        return crf.forward_backward(self._potentials(words), start, self.model.trans, self.model.first)[2]

    def __call__(self, texts: list[str]) -> tuple[list[str], list[float]]:
        sums = np.zeros((len(texts), max(1, len(self.model.labels))))
        count = np.zeros(len(texts), np.int64)
        words, starts, owner = [], [], []

        def flush():
            if words:
                begins = np.zeros(len(words), bool)
                begins[starts] = True
                part = np.add.reduceat(self.marginals(words, begins).astype(np.float64), starts, axis=0)
                np.add.at(sums, owner, part)
                words.clear(), starts.clear(), owner.clear()

        if self.model.labels:
            most = max(1, STREAM_CELLS // len(self.model.labels))
            piece, stream = min(PIECE, most), min(STREAM, most)
            for i, text in enumerate(texts):
                found = self.find(text.lower())
                count[i] = len(found)
                for at in range(0, len(found), piece):
                    starts.append(len(words))
                    owner.append(i)
                    words += found[at:at + piece]
                    if len(words) >= stream:
                        flush()
            flush()
        best = sums.argmax(axis=1)
        score = np.clip(sums[np.arange(len(texts)), best] / np.maximum(count, 1), 0, 1)
        return [self.model.labels[y] if n else UNKNOWN for y, n in zip(best.tolist(), count.tolist(), strict=True)], \
            score.tolist()


def _labeller(shared) -> Labeller:
    """One labeller in each worker process and model."""
    return worker_state(("labeller", shared.value.key), lambda: Labeller(shared.value))


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    return Model(sample(labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                                        F.col(lang_col).alias("lang"))))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) for each row of ``docs``; only the text is looked at."""
    spark = prepare(docs)
    shared = spark.sparkContext.broadcast(model)

    def task(batches):
        labeller = _labeller(shared)
        for batch in slices(batches):
            langs, score = labeller(texts(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(langs, pa.string()), pa.array(score, pa.float64())],
                names=["id", "lang_pred", "score"])

    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(task, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def keep_clear(docs: DataFrame, model: Model, min_share: float, text_col: str = "text") -> DataFrame:
    """Rows of ``docs``, with all their columns, that are not ``und`` and whose score is ``min_share`` or more.

    If the model has no labels: all rows whose text has a letter.
    """
    spark = prepare(docs)
    shared, model_has_labels = spark.sparkContext.broadcast(model), bool(model.labels)
    letter = regex.compile(WORD).search

    def task(batches):
        labeller = _labeller(shared)
        for batch in slices(batches, text_col):
            found = texts(batch.column(text_col))
            if model_has_labels:
                keep = [x != UNKNOWN and s >= min_share for x, s in zip(*labeller(found), strict=True)]
            else:
                keep = [letter(x) is not None for x in found]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(task, docs.schema)
