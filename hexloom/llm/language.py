"""Language identification by nearest centroids of TF-IDF n-gram vectors.

Character n-grams of one to three letters of the lower-cased text are counted in hashed dimensions,
weighted by count ** 0.85 and by the inverse document frequency over all training documents, and
normalised. Each language has several centroids, from spherical k-means over a bounded sample of its
documents; a text gets the language of the centroid with the highest cosine. A text farther from its
centroid than nearly all training texts of that language is rejected.

Scale: document frequencies are per-batch counts added up by dimension; languages are clustered in
parallel, one bounded group each; the model (languages x centroids x dimensions) is broadcast, and
one map over the texts predicts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexloom.llm.common import map_batches, prepare, residue, stored, table

DIMENSIONS = 4096
CENTROIDS = 4
#: Tables of at most this many languages are broadcast.
SMALL = 10_000
#: Bound of the sample of each language, and the share of it that the rejection distance keeps.
SAMPLE, KEPT = 1500, 0.999
FOLDS, HELD_OUT = 4, 2
NO_LANGUAGE = "und"
#: Code points mixed by odd factors give the dimension of an n-gram.
FACTORS = np.array([2654435761, 2246822519, 3266489917], dtype=np.uint64)


def _letters() -> np.ndarray:
    """For each code point of the basic plane: lower-case letter, or 0 for anything else."""
    out = np.zeros(1 << 16, dtype=np.uint32)
    for i in range(1 << 16):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


LETTERS = _letters()


def gram_counts(text: str | None, dimensions: int = DIMENSIONS) -> np.ndarray | None:
    """Hashed counts of the 1- to 3-grams of letters; null without any letter.

    Runs of other characters count as one gap, which takes part in n-grams with letters.
    """
    if not text:
        return None
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    low = codes >= len(LETTERS)
    if low.any():  # beyond the basic plane, Python tells what is a letter
        kept = [ord(c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else 0 for c in text]
        letters = np.array(kept, dtype=np.uint32)
    else:
        letters = LETTERS[codes]
    real = letters != 0
    if not real.any():
        return None
    gap = np.concatenate([[True], real[:-1]])
    row = np.concatenate([[0], letters[real | gap], [0]]).astype(np.uint64)
    mask = np.uint64(dimensions - 1)
    one = row * FACTORS[0]
    two = one[:-1] + row[1:] * FACTORS[1]
    three = two[:-1] + row[2:] * FACTORS[2]
    every = np.concatenate([one, two, three])
    every = ((every ^ (every >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(40)
    return np.bincount((every & mask).astype(np.int64), minlength=dimensions)


def vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    out = counts ** 0.85 * idf
    norm = np.linalg.norm(out)
    return (out / norm if norm else out).astype(np.float32)


def spherical_kmeans(rows: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids; starts from far-apart rows, and empty clusters are left out."""
    chosen = [0]
    near = rows @ rows[0]
    while len(chosen) < min(k, len(rows)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, rows @ rows[chosen[-1]])
    centres = rows[chosen]
    for _ in range(rounds):
        own = (rows @ centres.T).argmax(axis=1)
        sums = [rows[own == i].sum(axis=0) for i in range(len(centres)) if (own == i).any()]
        centres = np.stack([s / max(np.linalg.norm(s), 1e-12) for s in sums]).astype(np.float32)
    return centres


class Model:
    """IDF weights, centroids with their languages, and each language's rejection cosine."""

    def __init__(self, idf: np.ndarray, centroids: np.ndarray, languages: list[str], floors: dict[str, float]):
        self.idf, self.centroids, self.languages, self.floors = idf, centroids, languages, floors
        self.names = sorted(set(languages))
        self.of = np.array([self.names.index(x) for x in languages], dtype=int)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score from 0 to 1 and whether the text is rejected as too far away."""
        counts = gram_counts(text, len(self.idf))
        if counts is None or not self.names:
            return NO_LANGUAGE, 0.0, True
        cosine = self.centroids @ vector(counts, self.idf)
        best = np.full(len(self.names), -1.0)
        np.maximum.at(best, self.of, cosine)
        at = int(best.argmax())
        share = np.exp(20 * (best - best[at]))
        return self.names[at], float(1 / share.sum()), bool(best[at] < self.floors[self.names[at]])


def document_frequencies(docs: DataFrame, dimensions: int = DIMENSIONS) -> tuple[int, np.ndarray]:
    """Number of texts with a letter, and for each dimension the number of texts that have it."""
    def make():
        def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
            total, seen = 0, np.zeros(dimensions, dtype=np.int64)
            for text in rows.column(0).to_pylist():
                counts = gram_counts(text, dimensions)
                if counts is not None:
                    total += 1
                    seen += counts > 0
            return pa.RecordBatch.from_arrays([pa.array([*range(dimensions), -1], pa.int32()),
                                               pa.array([*seen, total], pa.int64())], names=["dim", "n"])
        return batch
    rows = (map_batches(docs.select("text"), make, "dim int, n long").groupBy("dim").agg(F.sum("n").alias("n")).collect())
    found = {r["dim"]: r["n"] for r in rows}
    return found.get(-1, 0), np.array([found.get(i, 0) for i in range(dimensions)])


def train(docs: DataFrame, sample: int = SAMPLE, centroids: int = CENTROIDS, dimensions: int = DIMENSIONS) -> Model:
    """Fit on texts with a language outside the held-out fold.

    Document frequencies cover all of them; the centroids of a language rest on at most about
    ``sample`` of its texts, chosen by a hash of the id.
    """
    learned = docs.filter((residue("doc_id", FOLDS) != HELD_OUT) & F.col("doc_id").isNotNull()
                          & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    total, seen = document_frequencies(learned, dimensions)
    idf = np.log((1 + total) / (1 + seen)) + 1
    sizes = stored(learned.groupBy("lang").agg(F.count("*").alias("n")), "lang-sizes")
    if sizes.count() <= SMALL:  # otherwise texts and sizes meet by an exchange
        sizes = F.broadcast(sizes)
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("lang")), F.lit(1 << 30))
    chosen = stored(learned.join(sizes, "lang").filter(place < F.lit(float(sample << 30)) / F.col("n")).drop("n"),
                    "lang-sample")

    def cluster(group: pd.DataFrame) -> pd.DataFrame:
        ordered = group.sort_values("doc_id", kind="stable")
        counts = [c for c in (gram_counts(t, dimensions) for t in ordered["text"]) if c is not None]
        if not counts:
            return pd.DataFrame({"lang": [], "centroid": [], "floor": []})
        rows = np.stack([vector(c, idf) for c in counts])
        centres = spherical_kmeans(rows, centroids)
        near = (rows @ centres.T).max(axis=1)
        return pd.DataFrame({"lang": group["lang"].iloc[0], "centroid": [c.tolist() for c in centres],
                             "floor": float(np.quantile(near, 1 - KEPT))})
    found = (chosen.groupBy("lang").applyInPandas(cluster, "lang string, centroid array<float>, floor double")
             .collect())
    found.sort(key=lambda r: r["lang"])
    stacked = np.array([r["centroid"] for r in found], dtype=np.float32).reshape(len(found), dimensions)
    return Model(idf, stacked, [r["lang"] for r in found], {r["lang"]: r["floor"] for r in found})


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """The rows with lang_pred, lang_score and lang_rejected.

    Null texts and texts without a letter get ``und``, score 0 and are rejected, as does every text
    if no language was learned. Rows and columns stay; columns of the new names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    new = ["lang_pred", "lang_score", "lang_rejected"]
    kept = [c for c in docs.columns if c not in new]

    def make():
        own, at = shared.value, kept.index("text")

        def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
            out = [own.predict(t) for t in rows.column(at).to_pylist()]
            columns = list(zip(*out)) or [[], [], []]
            return pa.RecordBatch.from_arrays(
                [*rows.columns, *(pa.array(c, t) for c, t in zip(columns, [pa.string(), pa.float64(), pa.bool_()]))],
                names=[*rows.schema.names, *new])
        return batch
    schema = docs.select(*kept).schema.add("lang_pred", "string").add("lang_score", "double").add("lang_rejected", "boolean")
    return map_batches(docs.select(*kept), make, schema)


def op5_language(spark, folder: str) -> DataFrame:
    """Predict the language of every whole text."""
    prepare(spark)
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    out = identify(docs.select("doc_id", "text"), train(docs))
    return out.select("doc_id", (residue("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "lang_pred",
                      F.col("lang_score").alias("score"), F.col("lang_rejected").alias("rejected"))


SQL = None
