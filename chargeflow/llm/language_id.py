"""Language identification by a string kernel."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import crc_remainder, read, runs

#: Symbols of the folded text: 0 is what is no letter, then the most frequent
#: letters of the training texts, then SHARED classes for all other letters.
SYMBOLS, SHARED = 64, 8
#: Training texts of a language at most, landmarks of a language, characters of text that are indexed at a time.
PER_LANGUAGE, LANDMARKS = 250, 24
SLICE = 1 << 20
#: Numbers of the matrix of texts that one product takes.
PRODUCT = 1 << 22
SPAN = SYMBOLS**3 + SYMBOLS**2 + SYMBOLS


@lru_cache(1)
def _letters() -> np.ndarray:
    """For each code point its lower-case code point if it is a letter, or else 0."""
    out = np.zeros(0x110000, np.int32)
    for c in range(0x110000):
        x = chr(c)
        if x.isalpha():
            low = x.lower()
            out[c] = ord(low[0])
    return out


def _points(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)


def letter_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters of a text (0 for all that is none) and how often each occurs."""
    return np.unique(_letters()[_points([text])], return_counts=True)


def alphabet(points: list[int], numbers: list[int]) -> np.ndarray:
    """Symbol of each code point: own ones for the letters most frequent in the counts."""
    low = _letters()
    counts = np.zeros(0x110000, np.int64)
    counts[np.array(points, np.int64)] = numbers
    counts[0] = 0
    own = SYMBOLS - SHARED - 1
    top = np.argsort(-counts, kind="stable")[:own]
    of_low = (np.arange(0x110000) % SHARED + own + 1).astype(np.uint8)
    of_low[top[counts[top] > 0]] = 1 + np.arange((counts[top] > 0).sum())
    table = of_low[low]
    table[low == 0] = 0
    return table


def presence(symbols: np.ndarray) -> np.ndarray:
    """Sorted distinct codes of the 1-, 2- and 3-grams of a folded text, without
    those that hold no letter."""
    s = symbols.astype(np.int64)
    seen = np.zeros(SPAN, bool)
    two = s[:-1] * SYMBOLS + s[1:]
    seen[s] = True
    seen[SYMBOLS + two] = True
    if len(s) > 2:
        seen[SYMBOLS + SYMBOLS**2 + two[:-1] * SYMBOLS + s[2:]] = True
    seen[[0, SYMBOLS, SYMBOLS + SYMBOLS**2]] = False
    return np.flatnonzero(seen)


def of_text(table: np.ndarray, t: str) -> np.ndarray:
    """The n-grams of a whole text; a long one in slices that overlap by two
    characters, as presence is a union."""
    got = presence(table[_points([t[:SLICE]])])
    for k in range(SLICE, len(t), SLICE):
        got = np.union1d(got, presence(table[_points([t[k - 2 : k + SLICE]])]))
    return got


class Model:
    """Blended-spectrum presence kernel: n-grams (n = 1 to 3) that two texts
    share, over the root of the product of their numbers. Nyström features
    against landmark texts, one ridge regression a language on them."""

    def __init__(self, table: np.ndarray, sets: list[np.ndarray], langs: list[str], landmarks: int = LANDMARKS, ridge: float = 1e-2):
        """From the symbols, and each training text's n-grams and language."""
        self.table = table
        keep = [i for i, s in enumerate(sets) if len(s)]
        sets, langs = [sets[i] for i in keep], [langs[i] for i in keep]
        self.langs = sorted(set(langs))
        if not self.langs:
            return
        chosen = [i for x in self.langs for i in [j for j, y in enumerate(langs) if y == x][:landmarks]]
        counts = np.zeros(SPAN, np.int64)
        for i in chosen:
            counts[sets[i]] += 1
        codes = np.flatnonzero(counts)  # every n-gram of the landmarks
        self.column = np.full(SPAN, -1, np.int32)
        self.column[codes] = np.arange(len(codes))
        self.landmarks = np.zeros((len(codes), len(chosen)), np.float32)
        for j, i in enumerate(chosen):
            at = self.column[sets[i]]
            self.landmarks[at[at >= 0], j] = 1 / np.sqrt(len(sets[i]))
        kernel = self._kernel(sets)
        among = kernel[chosen]
        value, vector = np.linalg.eigh((among + among.T) / 2)
        good = value > 1e-6 * value.max()
        self.map = vector[:, good] / np.sqrt(value[good])
        phi = np.column_stack([kernel @ self.map, np.ones(len(sets))])
        goal = np.array([[1.0 if x == y else 0.0 for y in self.langs] for x in langs])
        # Languages weigh the same, however many texts each has.
        weight = 1 / np.maximum(1, goal.sum(0))[[self.langs.index(x) for x in langs]]
        gram = (phi * weight[:, None]).T @ phi
        self.weights = np.linalg.solve(gram + ridge * np.trace(gram) / len(gram) * np.eye(len(gram)), (phi * weight[:, None]).T @ goal)
        self.direct = (self.map @ self.weights[:-1]).astype(np.float32)

    def _kernel(self, sets: list[np.ndarray]) -> np.ndarray:
        dense = np.zeros((len(sets), len(self.landmarks)), np.float32)
        for row, s in zip(dense, sets):
            at = self.column[s]
            row[at[at >= 0]] = 1 / np.sqrt(max(1, len(s)))
        return dense @ self.landmarks

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of whole texts; ``und`` and 0 without letters."""
        names, scores = ["und"] * len(texts), [0.0] * len(texts)
        if not self.langs:
            return names, scores
        step = max(1, min(256, PRODUCT // len(self.landmarks)))
        for at in range(0, len(texts), step):
            part = [i for i in range(at, min(at + step, len(texts))) if texts[i]]
            sets = {}
            for i in part:
                if len(got := of_text(self.table, texts[i])):
                    sets[i] = got
            if not sets:
                continue
            out = self._kernel(list(sets.values())) @ self.direct + self.weights[-1]
            best = out.argmax(1)
            chance = np.exp(8 * (out - out.max(1, keepdims=True)))
            for i, b, c in zip(sets, best.tolist(), (1 / chance.sum(1)).tolist()):
                names[i], scores[i] = self.langs[b], float(c)
        return names, scores


def _first_ids(rows: DataFrame, many: int) -> list:
    """The ids of the first ``many`` rows (``id``, ``lang``) of each language, by a hash of the
    id. Only hashes below a bound are ranked, which about twice as many rows of each
    language have; where some language has too few there, the bound grows eightfold."""
    hashed = rows.withColumn("_h", F.xxhash64("id", F.lit(11)))
    number = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = Window.partitionBy("lang").orderBy("_h", "id")
    found, due, factor = [], set(number), 2.0
    while due:
        share = {x: factor * (many + 32) / number[x] for x in due}
        bound = [F.when(F.col("lang") == x, F.lit(min(2**63 - 1, int(-(2**63) + y * 2**64)))) for x, y in share.items()]
        near = hashed.filter(F.col("_h") <= F.coalesce(*bound))
        got = near.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= many).select("id", "lang").collect()
        full = {x for x in due if share[x] >= 1 or sum(r.lang == x for r in got) >= many}
        found += [r.id for r in got if r.lang in full]
        due, factor = due - full, factor * 8
    return found


def train(docs: DataFrame, allowed, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", per_language: int = PER_LANGUAGE) -> Model:
    """Fits on ``per_language`` texts of each language at most, the first by a
    hash of the id among the rows ``allowed`` (a condition). Their n-grams, of
    bounded number, come to the driver, not texts."""
    usable = docs.filter(allowed & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull())
    ids = _first_ids(usable.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang")), per_language)
    texts = usable.filter(F.col(id_col).isin(ids) & F.col(text_col).isNotNull()).select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"), F.col(id_col).cast("long").alias("id"))

    def letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [letter_counts(t) for t in b.column(0).to_pylist()]
            yield pa.record_batch([pa.array(np.concatenate([p for p, _ in found]), pa.int32()), pa.array(np.concatenate([n for _, n in found]), pa.int64())], names=["point", "n"])

    counted = texts.mapInArrow(letters, "point int, n long").groupBy("point").agg(F.sum("n").alias("n")).collect() if ids else []
    table = alphabet([r.point for r in counted], [r.n for r in counted])

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [of_text(table, t).astype(np.int32).tobytes() for t in b.column(0).to_pylist()]
            yield pa.record_batch([pa.array(sets, pa.binary()), b.column(1), b.column(2)], names=["grams", "lang", "id"])

    # Rows that repeat an id and language count once, so that what is collected stays bounded.
    found = texts.mapInArrow(grams, "grams binary, lang string, id long").groupBy("lang", "id").agg(F.min("grams").alias("grams"))
    rows = sorted(found.collect(), key=lambda r: (r.lang, r.id)) if ids else []
    return Model(table, [np.frombuffer(r.grams, np.int32).astype(np.int64) for r in rows], [r.lang for r in rows])


def identify(docs: DataFrame, model: Model, text_col: str = "text", pred: str = "lang_pred", score: str = "lang_score") -> DataFrame:
    """Adds ``lang_pred`` and ``lang_score`` (0 to 1; or other names) to ``docs``, which
    keeps its columns (those two are replaced). Null texts and texts without letters
    are ``und`` with score 0, as is everything if there was nothing to learn from."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop(pred, score)
    column = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in runs(batches):
            names, scores = held.value.predict(b.column(column).to_pylist())
            yield pa.record_batch([*b.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*b.schema.names, pred, score])

    schema = T.StructType([*docs.schema.fields, T.StructField(pred, T.StringType()), T.StructField(score, T.DoubleType())])
    return docs.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = train(docs, crc_remainder("doc_id", 3) != 1)
    held_out = F.coalesce(crc_remainder("doc_id", 3) == 1, F.lit(False))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
