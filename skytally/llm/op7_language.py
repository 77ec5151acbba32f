"""Language identification: multinomial naive Bayes over hashed character n-grams.

Characters are lower-cased and everything but letters counts as a blank; n-grams of 1 to 3 characters are
hashed into at most 2^16 columns. Training counts n-grams per language in Spark over a sample of the
labelled rows: about ``TRAIN_ROWS`` per language at most, chosen by a hash of the row, every row of a language that
has fewer. The log-probability matrix (``MATRIX_BYTES`` at most: with very many languages it gets fewer
columns) is broadcast, and numpy scores batches of whole texts in slices of ``SLICE`` characters. All
classes start equal: there is no prior.

Defined results: a text that is null or has no letter is ``und`` with score 0, and so is every text when
nothing was learned; a null id counts as the empty string for the fold; repeated rows get equal
predictions; of equal scores the language first in code point order wins; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.llm import common as C
from skytally.llm.shingles import SLICE_ROWS, batches, row_slices

ORDERS = (1, 2, 3)
COLUMNS = 1 << 16
MATRIX_BYTES = 64 << 20
TRAIN_ROWS = 5_000   # labelled rows per language that are counted
SLICE = 1 << 19
SLACK = 0.4          # of the way from a language's typical n-gram to a never seen one
UNKNOWN = "und"
_MIX = np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917)

_letters: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def code_points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(characters, first place of each text, has a letter); a 0 ends every text."""
    joined = "\0".join([(t or "").replace("\0", " ").lower() for t in texts]) + "\0"
    chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").copy()
    ends = np.flatnonzero(chars == 0)
    starts = np.concatenate([[0], ends[:-1] + 1]).astype(np.int64)
    letter = letter_table()[chars]
    chars[~letter & (chars != 0)] = 32
    n = np.concatenate([[0], np.cumsum(letter)])
    return chars, starts, n[ends] > n[starts]


def ngram_columns(chars: np.ndarray, order: int, columns: int) -> np.ndarray:
    """Hashed column of the n-gram at each place; ``columns`` where it would leave its text."""
    n = max(0, len(chars) - order + 1)
    h = np.zeros(n, np.uint32)
    bad = np.zeros(n, bool)
    for k in range(order):
        part = chars[k:k + n]
        h = (h ^ part) * _MIX[k]
        h ^= h >> np.uint32(15)
        bad |= part == 0
    h = ((h + np.uint32(order)) * _MIX[1]) >> np.uint32(33 - columns.bit_length())
    h = h.astype(np.int64)
    h[bad] = columns
    return h


def slices(chars: np.ndarray) -> Iterator[tuple[int, int]]:
    for at in range(0, len(chars), SLICE):
        yield at, min(at + SLICE, len(chars))


def columns_of(chars: np.ndarray, lo: int, hi: int, order: int, columns: int) -> np.ndarray:
    """``ngram_columns`` of the places lo .. hi."""
    out = np.full(hi - lo, columns, np.int64)
    found = ngram_columns(chars[lo:hi + order - 1], order, columns)
    out[:len(found)] = found
    return out


@dataclass
class Model:
    languages: list[str]
    matrix: np.ndarray  # (columns + 1, languages): log probabilities; the last row is 0
    typical: np.ndarray | None = None   # per language, of an n-gram of its own texts: the mean log probability,
    spread: np.ndarray | None = None    # its standard deviation,
    unseen: np.ndarray | None = None    # and the log probability of an n-gram that was never seen

    @property
    def columns(self) -> int:
        return len(self.matrix) - 1

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """(language, score) of every text."""
        return self.judge(texts)[:2]

    def judge(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, whether the text may well be in that language) of every text.

        The last one is by likelihood per n-gram, whatever the other languages say: it lies no further below what
        is typical of the language than ``SLACK`` of the way to never seen n-grams, and, as short texts vary,
        three standard errors.
        """
        langs: list[str] = []
        scores, likely = [np.zeros(0)], [np.zeros(0, bool)]
        for lo, hi in batches([t or "" for t in texts]):
            some, score, fits = self._judge(texts[lo:hi])
            langs += some
            scores.append(score)
            likely.append(fits)
        return langs, np.concatenate(scores), np.concatenate(likely)

    def _judge(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        n, k = len(texts), len(self.languages)
        if not k:
            return [UNKNOWN] * n, np.zeros(n), np.zeros(n, bool)
        chars, starts, known = code_points(texts)
        total, grams = np.zeros((n, k)), np.zeros(n)
        for lo, hi in slices(chars):
            first = int(np.searchsorted(starts, lo, "right")) - 1
            last = int(np.searchsorted(starts, hi, "left"))
            cuts = np.maximum(starts[first:last], lo) - lo
            got, seen = np.zeros((hi - lo, k), np.float32), np.zeros(hi - lo)
            for order in ORDERS:
                columns = columns_of(chars, lo, hi, order, self.columns)
                got += self.matrix[columns]
                seen += columns < self.columns
            total[first:last] += np.add.reduceat(got.astype(np.float64), cuts, axis=0)
            grams[first:last] += np.add.reduceat(seen, cuts)
        best = total.argmax(1)
        score = np.where(known, 1.0 / np.exp(total - total.max(1, keepdims=True)).sum(1), 0.0)
        likely = known.copy()
        if self.typical is not None:
            mean = total[np.arange(n), best] / np.maximum(grams, 1)
            far = SLACK * (self.typical - self.unseen)[best] + 3 * self.spread[best] * np.sqrt(len(ORDERS) / np.maximum(grams, 1))
            likely &= mean >= self.typical[best] - far
        return [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, known, strict=True)], score, likely


def held_out(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % 4 == 2


def fit(rows: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Learn from ``rows`` (id, text, lang)."""
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    seen = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(seen)
    if not languages:
        return Model([], np.zeros((COLUMNS + 1, 0), np.float32))
    columns = COLUMNS
    while columns > 256 and columns * len(languages) * 4 > MATRIX_BYTES:
        columns //= 2
    part = F.element_at(F.create_map(*[F.lit(x) for k, n in seen.items() for x in (k, min(1.0, train_rows / n))]), F.col("lang"))
    chosen = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) < part * (1 << 30)).select("lang", "text")
    number = {k: i for i, k in enumerate(languages)}

    def count(parts: Iterator) -> Iterator:
        held = np.zeros((len(languages), columns), np.int64)
        for part in row_slices(parts):
            for lang, texts in part.to_pandas().groupby("lang")["text"]:
                texts = list(texts)
                for at, to in batches(texts):
                    chars, _, _ = code_points(texts[at:to])
                    for lo, hi in slices(chars):
                        for order in ORDERS:
                            found = columns_of(chars, lo, hi, order, columns)
                            held[number[lang]] += np.bincount(found, minlength=columns + 1)[:columns]
        at = np.nonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at[0], pa.int32()), pa.array(at[1], pa.int32()), pa.array(held[at])], names=["l", "c", "n"])

    counts = chosen.mapInArrow(count, "l int, c int, n long").groupBy("l", "c").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros((columns + 1, len(languages)))
    table[counts["c"], counts["l"]] = counts["n"]
    total = table[:-1].sum(0)
    logs = np.log((table[:-1] + 0.5) / (total + 0.5 * columns))
    # an n-gram of a text that was counted, as if it hadn't been: few counted texts don't look more typical than they are
    share, others = table[:-1] / np.maximum(total, 1), np.log((np.maximum(table[:-1] - 1, 0) + 0.5) / (total + 0.5 * columns))
    typical = (share * others).sum(0)
    spread = np.sqrt(np.maximum((share * others ** 2).sum(0) - typical ** 2, 0))
    return Model(languages, np.vstack([logs, np.zeros(len(languages))]).astype(np.float32), typical, spread,
                 np.log(0.5 / (total + 0.5 * columns)))


def predictor(spark: SparkSession, model: Model):
    """A column function: text -> struct(lang_pred, score, likely)."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double, likely boolean")
    def predict(texts: pa.Array) -> pa.Array:
        found = []
        for at in range(0, max(1, len(texts)), SLICE_ROWS):  # texts become Python objects a slice at a time
            langs, scores, likely = shared.value.judge(texts.slice(at, SLICE_ROWS).to_pylist())
            found.append(pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores), pa.array(likely)],
                                                    names=["lang_pred", "score", "likely"]))
        return pa.concat_arrays(found)

    return predict


def labelled(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang"))
    return rows.where(~held_out(F.col("id")))


def keep_identified(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text may well be in the learned language that it is taken for.

    Null texts and texts without a letter go, and texts far less likely in their language than its own are
    (``Model.judge``): texts of languages never learned, not short texts between two learned ones. Where no
    row is labelled nothing can be told, and every row stays.
    """
    model = fit(labelled(docs))
    if not model.languages:
        return docs
    predict = predictor(spark, model)
    got = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), predict(docs["text"]).alias("_p"))
    return got.where("_p.likely").select("_doc.*")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.read_documents(spark, sf_dir).select("doc_id", "text", "lang")
    predict = predictor(spark, fit(labelled(docs)))
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predict("text").alias("p")).select(
        "doc_id", "held_out", "p.lang_pred", "p.score")
