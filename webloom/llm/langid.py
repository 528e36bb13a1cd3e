"""Language ID: multinomial naive Bayes over hashed character n-grams.

All runs of one to four bytes of lower-cased text, blanks squeezed, are hashed to
a fixed number of slots.  Counts by language and slot give a matrix of log
probabilities for all languages of the sample; its size is bounded, and it is
broadcast.  A batch of texts is scored as the product of its sparse row-by-slot
counts with that matrix, in numpy: the rows of the matrix that a text's slots name
are summed up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.llm.bytewords import LOWER, byte_classes
from webloom.llm.common import crc_bucket, lean, row_slices, string_buffers
from webloom.llm.quality import sampled

BITS = 16
#: Labelled rows that the counts are taken from, at most.
SAMPLE_ROWS = 20_000
#: Cells of the matrix, at most: with more than 256 languages there are fewer slots, so that it stays of this size.
MATRIX_CELLS = 1 << 24
ORDERS = (1, 2, 3, 4)
_QUIET = ~byte_classes(lambda b: 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80)


def slot_bits(languages: int) -> int:
    """Bits of a slot, so that the matrix of all languages stays within :data:`MATRIX_CELLS`."""
    return max(8, min(BITS, (MATRIX_CELLS // max(1, languages)).bit_length() - 1))


def slots(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all n-grams of all rows, one row after the other, and the offsets of the rows in them.

    All but letters count as a blank, and blanks are squeezed; an n-gram doesn't
    reach into the next row.
    """
    form = np.where(_QUIET[data], np.uint8(0x20), LOWER[data])
    keep = np.ones(len(form), bool)
    keep[1:] = (form[1:] != 0x20) | (form[:-1] != 0x20)
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    keep[inner] = True
    at = np.concatenate([[0], np.cumsum(keep)])[offsets]
    form = form[keep].astype(np.uint64)
    n = len(form)
    left = np.repeat(at[1:], np.diff(at)) - np.arange(n)  # bytes from here to the end of the row
    out = np.empty((n, len(ORDERS)), np.int32)
    padded = np.concatenate([form, np.zeros(max(ORDERS), np.uint64)])
    code = np.zeros(n, np.uint64)
    for k in range(1, max(ORDERS) + 1):
        code = (code << np.uint64(8)) | padded[k - 1 : k - 1 + n]
        if k in ORDERS:
            h = ((code + np.uint64(k << 56)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
            out[:, ORDERS.index(k)] = np.where(left >= k, h.astype(np.int32), 1 << bits)  # the last slot says nothing
    return out.ravel(), at * len(ORDERS)


class Model:
    """Log probabilities (slot, language) and the languages, in order."""

    def __init__(self, languages: list[str], matrix: np.ndarray, prior: np.ndarray):
        self.languages, self.matrix, self.prior = languages, matrix, prior
        self.bits = slot_bits(len(languages))

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best language's number and its probability for each row; ties go to the first."""
        slot, at = slots(data, offsets, self.bits)
        rows = len(offsets) - 1
        total = np.tile(self.prior, (rows, 1))
        held = np.flatnonzero(np.diff(at))
        if len(held):
            for k in range(len(self.languages)):
                total[held, k] += np.add.reduceat(self.matrix[:, k][slot], at[:-1][held], dtype=np.float64)
        best = total.argmax(1)
        weight = np.exp(total - total.max(1, keepdims=True))
        return best, 1 / weight.sum(1)


def train(docs: DataFrame, learn: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Count n-grams by language in a bounded sample of the rows for which ``learn`` holds."""
    rows = sampled(docs.filter(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(id_col, text_col, lang_col), id_col, sample_rows)
    shares = sorted((r[0], r[1]) for r in rows.groupBy(lang_col).count().collect())  # of a bounded sample
    languages = [x for x, _ in shares]
    number = {x: i for i, x in enumerate(languages)}
    bits = slot_bits(len(languages))
    size = 1 << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(languages), size + 1), np.int64)
        for batch in batches:
            data, offsets = string_buffers(batch.column(0))
            names = batch.column(1).to_pylist()
            for i, j in row_slices(offsets):
                slot, at = slots(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], bits)
                lang = np.array([number.get(x, -1) for x in names[i:j]])
                each = np.repeat(lang, np.diff(at))
                for k in np.unique(lang[lang >= 0]):
                    sums[k] += np.bincount(slot[each == k], minlength=size + 1)
        k, s = np.nonzero(sums[:, :size])
        for p in range(0, len(k), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(k[p : p + 50_000], pa.int32()), pa.array(s[p : p + 50_000], pa.int32()), pa.array(sums[k[p : p + 50_000], s[p : p + 50_000]], pa.int64())], ["k", "slot", "n"])

    counts = np.zeros((size + 1, max(1, len(languages))), np.float64)
    if languages:
        got = rows.select(text_col, lang_col).mapInArrow(lean(count), "k int, slot int, n long").groupBy("k", "slot").agg(F.sum("n").alias("n")).toPandas()
        counts[got["slot"], got["k"]] = got["n"]
    matrix = np.log((counts + 0.1) / (counts.sum(0) + 0.1 * size))
    matrix[size] = 0
    prior = np.log(np.array([n for _, n in shares] or [1], float) / max(1, sum(n for _, n in shares)))
    return Model(languages, matrix.astype(np.float32), prior)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, lang_pred and score (probability of it) of each row; ``und`` with score 0 if there is no letter to go by."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        names = np.array([*known.languages, "und"], object)
        for batch in batches:
            data, offsets = string_buffers(batch.column(1))
            letter = np.asarray(batch.column(2))
            for i, j in row_slices(offsets):
                best, score = known.predict(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                sure = letter[i:j] & bool(known.languages)
                best = np.where(sure, best, len(known.languages))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(names[best], pa.string()), pa.array(np.where(sure, score, 0.0))], ["id", "lang_pred", "score"])

    letter = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    return docs.select(F.col(id_col).alias("id"), text_col, letter.alias("letter")).mapInArrow(lean(run), f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from rows whose crc32(id) modulo 5 is not 0 and whose language is not null, and predict all rows.

    Returns the id, held_out, lang_pred and score.  Where no language could be
    learnt, and for texts that are null or have no letter, lang_pred is ``und`` and
    score 0.  Rows that repeat an id are each predicted; an empty table gives an
    empty result.
    """
    model = train(docs, crc_bucket(id_col, 5) != 0, text_col, lang_col, id_col)
    return identify(docs, model, id_col, text_col).select(id_col, (F.coalesce(crc_bucket(id_col, 5), F.lit(1)) == 0).alias("held_out"), "lang_pred", "score")
