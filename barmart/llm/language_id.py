"""Language ID with string kernels: blended-spectrum n-gram presence, Nyström landmarks, one-versus-rest ridge regression.

The kernel of two texts is the number of character n-grams (of 1 to 4 characters, in DIMS hashed slots) present in both,
over the root of the product of their own numbers. Landmarks are texts of a bounded training sample; a text is mapped to
its kernels with the landmarks, and one ridge regression for each language, solved in that space, scores it. Scoring is two
matrix products for each batch of texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barmart.llm.shared import if_small

DIMS_BITS = 14
DIMS = 1 << DIMS_BITS
#: Bounds of the training sample: texts of each language, and of all (48 MB of packed rows). With more than SAMPLE / PER_LANGUAGE
#: languages each has fewer texts, but at least one: every language is learnt.
PER_LANGUAGE, SAMPLE = 384, 24_576
#: Landmarks of each language, and of all (32 MB as numbers); with more languages than that, some have none of their own.
LANDMARKS_PER_LANGUAGE, LANDMARKS = 32, 512
RIDGE = 1e-2
BATCH = 64
LETTER = r"\p{L}"


def letter_table() -> np.ndarray:
    """For each code point below 0x30000 whether it is a letter; code points above are taken for letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x30000)), bool, 0x30000)


def gram_slots(text: str, letters: np.ndarray) -> np.ndarray | None:
    """Slots of the n-grams of a text, in lower case, every run of other characters as one space; None without a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    known = letters[np.minimum(points, len(letters) - 1)] | (points >= len(letters))
    if not known.any():
        return None
    points = np.where(known, points, 32)
    keep = known.copy()
    keep[1:] |= known[:-1]
    keep[0] = True
    points = np.concatenate([[32], points[keep], [32]]).astype(np.uint64)
    slots, code = [], np.zeros(len(points), np.uint64)
    for n in range(1, 5):
        code = code[: len(points) - n + 1] * np.uint64(0x110003) + points[n - 1 :]
        if not len(code):
            break
        mixed = (code + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        slots.append((mixed >> np.uint64(64 - DIMS_BITS)).astype(np.int64))
    return np.concatenate(slots)


def presence(texts: list[str | None], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A row of 0 and 1 for each text, and which texts have a letter."""
    rows, good = np.zeros((len(texts), DIMS), np.float32), np.zeros(len(texts), bool)
    for i, text in enumerate(texts):
        slots = gram_slots(text, letters) if text else None
        if slots is not None:
            rows[i, slots] = 1
            good[i] = True
    return rows, good


def unpacked(bits: np.ndarray) -> np.ndarray:
    return np.unpackbits(bits, axis=1).astype(np.float32)


class Classifier:
    """Languages, landmark rows and ridge weights; bounded by the parameters above. `bits` are packed rows of the sample."""

    def __init__(self, bits: np.ndarray, langs: list[str]):
        self.langs = sorted(set(langs))
        own = np.array([self.langs.index(x) for x in langs])
        each = max(1, min(LANDMARKS_PER_LANGUAGE, LANDMARKS // len(self.langs)))
        picked = np.concatenate([np.flatnonzero(own == c)[:each] for c in range(len(self.langs))])[:LANDMARKS]
        self.landmarks = unpacked(bits[picked]).T.copy()
        self.norms = np.sqrt(np.maximum(self.landmarks.sum(0), 1))
        near = np.concatenate([self.kernels(unpacked(bits[i : i + 512])) for i in range(0, len(bits), 512)]).astype(np.float64)
        target = (own[:, None] == np.arange(len(self.langs))) * 1.0
        among = near[picked]
        self.weights = np.linalg.solve(
            near.T @ near + RIDGE * (among + np.eye(len(picked))), near.T @ target
        ).astype(np.float32)

    def kernels(self, rows: np.ndarray) -> np.ndarray:
        own = np.sqrt(np.maximum(rows.sum(1), 1))
        return (rows @ self.landmarks) / own[:, None] / self.norms

    def predict(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        values = self.kernels(rows) @ self.weights
        best = values.argmax(1)
        return best, np.clip(values[np.arange(len(best)), best], 0, 1)


def training_sample(labelled: DataFrame, per_language: int = PER_LANGUAGE, most: int = SAMPLE) -> DataFrame:
    """(text, lang): at most `per_language` different texts of each language, at most `most` of all (but one of each language).

    Texts are chosen by a hash of the text, so copies, repeated and null keys don't matter. Of the different hashes, tasks pass on
    at most `per_language` of a language to its window, and then one row of each chosen text.
    """
    known = labelled.filter("lang IS NOT NULL AND text IS NOT NULL").filter(F.col("text").rlike(LETTER))
    languages = labelled.filter("lang IS NOT NULL").select("lang").distinct().count()
    each = max(1, min(per_language, most // max(1, languages)))
    # Copies are counted as one before the window, else the copies of one text could be all that it sees.
    codes = known.select("lang", F.xxhash64("text").alias("code")).distinct()
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("code"))
    chosen = codes.withColumn("nth", nth).filter(F.col("nth") <= each).select("lang", "code")
    rows = known.select("text", "lang", F.xxhash64("text").alias("code"))
    # At most `most` narrow rows, or one of each language.
    return rows.join(if_small(chosen, max(most, languages)), ["lang", "code"]).dropDuplicates(["lang", "code"]).select("text", "lang")


def fit(labelled: DataFrame) -> Classifier | None:
    """Learns from (text, lang) rows with a language, from `training_sample`; its n-gram rows (2 KB each) are made by tasks and
    gathered. None without such rows."""
    sample = training_sample(labelled)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_table()
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                found, good = presence(part.column(0).to_pylist(), letters)
                bits = np.packbits(found.astype(bool), axis=1)
                packed = pa.array([b.tobytes() for b in bits], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(1), packed, pa.array(good)], ["lang", "bits", "good"])

    got = sample.mapInArrow(rows, "lang string, bits binary, good boolean").filter("good").collect()
    if not got:
        return None
    # By language, then by a digest of the row, so that landmarks don't favour the texts that share the first n-grams.
    got = sorted((r["lang"], hashlib.md5(bytes(r["bits"])).digest(), bytes(r["bits"])) for r in got)
    matrix = np.frombuffer(b"".join(r[2] for r in got), np.uint8).reshape(len(got), -1)
    return Classifier(matrix, [r[0] for r in got])


def predict(docs: DataFrame, model: Classifier | None, keep: tuple[str, ...]) -> DataFrame:
    """The columns `keep` with lang_pred and score (0 to 1): `und` and 0 for texts that are null or have no letter."""
    kinds = dict(docs.dtypes)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_table()
        for batch in batches:
            texts, langs, scores = batch.column(len(keep)).to_pylist(), [], []
            for at in range(0, len(texts), BATCH):
                rows, good = presence(texts[at : at + BATCH], letters)
                best, score = model.predict(rows) if model else (np.zeros(len(rows), int), np.zeros(len(rows)))
                known = good & (model is not None)
                langs += [model.langs[b] if g else "und" for b, g in zip(best, known)]
                scores += [float(s) if g else 0.0 for s, g in zip(score, known)]
            columns = [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *columns], [*keep, "lang_pred", "score"])

    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "lang_pred string, score double"])
    return docs.select(*keep, "text").mapInArrow(work, schema)


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of `docs` (doc_id, text, lang; other columns are ignored).

    Learns from rows whose crc32(doc_id) mod 5 is not 0 and that have a language and a letter; a null doc_id is neither learnt from nor
    held out. Repeated rows are returned as often as they occur; an empty table gives an empty table.
    """
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    rows = docs.select("doc_id", "text", "lang", F.coalesce(fold == 0, F.lit(False)).alias("held_out"))
    model = fit(rows.filter("doc_id IS NOT NULL AND NOT held_out"))
    return predict(rows, model, ("doc_id", "held_out"))
