"""Language identification in two levels: family first, then one-versus-one linear SVMs.

A text becomes the square roots of its relative frequencies of character 1- to 3-grams
(letters in lower case, anything else as one blank sign), hashed into ``FEATURES`` cells.
One linear SVM per family, against the rest, picks the family; inside it one SVM per pair of
languages votes. The features of whole texts are made in tasks; the SVMs are trained one per
task on a bounded sample, and only their weights are gathered.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so is every
text when there is nothing to learn from. Repeated rows are predicted alike. Other columns
of the input are kept by ``identify`` and never looked at; if one is called like an output
column, the output replaces it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from jobstrata.llm.common import as_row, map_arrow, stored, text_batches, texts_of, uniform

# Families of ISO 639-1 codes. A label not listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en fy is lb nl nn no nb sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "celtic": "br cy ga gd",
    "baltic": "lt lv",
    "uralic": "et fi hu",
    "turkic": "az kk ky tk tr tt uz",
    "indoaryan": "bn gu hi mr ne or pa si ur",
    "iranian": "fa ku ps tg",
    "dravidian": "kn ml ta te",
    "semitic": "am ar he mt",
    "austronesian": "id jv mg ms su tl",
    "sinitic": "zh",
    "japonic": "ja",
    "koreanic": "ko",
}
FEATURES = 1 << 13
ORDERS = 3
UNKNOWN = "und"
# Bound of the training sample: documents per language.
PER_LANGUAGE = 400
# Bound of the rows that one family's SVM sees.
FAMILY_ROWS = 3000
# Bound of the labels that are learned, the most frequent ones: families times labels are fitted.
MOST_LABELS = 1000
# Texts that are counted at once, and signs of a longer text.
BATCH_ROWS, PIECE = 256, 1 << 18


def family_of(lang: str) -> str:
    return next((f for f, codes in FAMILIES.items() if lang in codes.split()), f"={lang}")


_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Per code point whether it is a letter; made once per worker."""
    if not _LETTERS:
        flags = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        _LETTERS.append(flags)
    return _LETTERS[0]


def _cells(text: str) -> list[np.ndarray]:
    """Per order the feature of the gram that begins at each sign; one more than all for a
    gram without a letter."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[code]
    sign = np.where(letter, code, 32).astype(np.uint64)
    cells = []
    gram, seen = sign, letter
    with np.errstate(over="ignore"):
        for order in range(ORDERS):
            if order:
                # The gram that starts one sign earlier and ends here.
                gram = gram[:-1] * np.uint64(0x100000001B3) + sign[order:]
                seen = seen[:-1] | letter[order:]
            mixed = (gram + np.uint64(order)) * np.uint64(0x9E3779B97F4A7C15)
            cell = (mixed >> np.uint64(64 - 13)).astype(np.int64)
            cells.append(np.where(seen, cell, FEATURES))
    return cells


def _counted(cell: np.ndarray) -> np.ndarray:
    return np.bincount(cell, minlength=FEATURES + 1)[:FEATURES]


def _long_counts(text: str) -> np.ndarray:
    """Feature counts of one lower-case text, taken in pieces, so that memory does not grow
    with it. A piece holds the signs behind it that its last grams need."""
    padded = f" {text} "
    out = np.zeros(FEATURES, np.int64)
    for a in range(0, len(padded), PIECE):
        for cell in _cells(padded[a : a + PIECE + ORDERS - 1]):
            out += _counted(cell[:PIECE])
    return out


def _counts(texts: list[str | None]) -> np.ndarray:
    """A row of feature counts per text; all zero without a letter."""
    out = np.zeros((len(texts), FEATURES), np.float32)
    lowered = [(t or "").lower() for t in texts]
    for row, text in enumerate(lowered):
        if len(text) > PIECE:
            out[row], lowered[row] = _long_counts(text), ""
    blank = "  "
    lengths = np.array([len(t) for t in lowered], np.int64)
    starts = 2 + np.concatenate(([0], np.cumsum(lengths + 2)[:-1])) if len(texts) else lengths
    cells = _cells(blank + blank.join(lowered) + blank)
    for row, (start, length) in enumerate(zip(starts, lengths)):
        for order, cell in enumerate(cells):
            # Grams may begin or end in the one blank beside the text.
            first = max(start - order, start - 1)
            part = cell[first : start + length + (1 if order else 0) - order]
            if length:
                out[row] += _counted(part)
    return out


def _features(texts: list[str | None]) -> np.ndarray:
    counts = _counts(texts)
    total = counts.sum(1, keepdims=True)
    return np.sqrt(counts / np.maximum(total, 1))


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_batches(batches, "text", 1 << 20, BATCH_ROWS):
        rows = _features(batch.column("text").to_pylist())
        cells = [np.flatnonzero(r).astype(np.uint32) for r in rows]
        yield pa.record_batch(
            {
                "lang": batch.column("lang"),
                "place": batch.column("place"),
                "cells": pa.array([c.tobytes() for c in cells], pa.binary()),
                "parts": pa.array([r[c].tobytes() for r, c in zip(rows, cells)], pa.binary()),
            }
        )


def _svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, epochs: int = 12) -> np.ndarray:
    """Weights of an L2-loss linear SVM by dual coordinate descent, classes balanced."""
    upper = np.where(y > 0, len(y) / max(1, (y > 0).sum()), len(y) / max(1, (y < 0).sum()))
    slack = 1.0 / (2 * cost * upper / 2)
    norm = (x * x).sum(1) + slack
    alpha, weights = np.zeros(len(y)), np.zeros(x.shape[1], np.float64)
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(y)):
            gradient = y[i] * (x[i] @ weights) - 1 + slack[i] * alpha[i]
            new = max(0.0, alpha[i] - gradient / norm[i])
            if new != alpha[i]:
                weights += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return weights.astype(np.float32)


def _fit(key: tuple, table: pa.Table) -> pa.Table:
    x = np.zeros((table.num_rows, FEATURES), np.float32)
    rows = zip(table["cells"].to_pylist(), table["parts"].to_pylist())
    for row, (cells, parts) in enumerate(rows):
        x[row, np.frombuffer(cells, np.uint32)] = np.frombuffer(parts, np.float32)
    y = np.where(np.array(table["positive"].to_pylist(), bool), 1.0, -1.0)
    # Rows arrive in any order; training has to see them in one.
    order = np.lexsort((table["place"].to_numpy(), np.array(table["lang"].to_pylist(), object)))
    return pa.table({"task": [key[0].as_py()], "weights": [_svm(x[order], y[order]).tobytes()]})


def train(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> dict:
    """The model, from ``doc_id``, ``text`` and ``lang``: up to ``per_language`` documents
    of each language, chosen by hashes of their ids; rows without text or lang teach nothing."""
    known = labelled.where("text IS NOT NULL AND lang IS NOT NULL")
    # Per label, hashes below a limit that leaves about twice as many; the window that picks
    # the smallest then sees only those, however common the label.
    counted = known.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    limits = stored(counted.orderBy(F.desc("rows"), "lang").limit(MOST_LABELS), "languages")
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (
        known.select("doc_id", "lang", uniform("sample", F.col("doc_id")).alias("draw"))
        .join(limits, "lang")
        .where(F.col("draw") * F.col("rows") < 2 * per_language)
        .select("doc_id", "lang", F.row_number().over(by_hash).alias("place"))
        .where(F.col("place") <= per_language)
        .dropDuplicates(["doc_id", "lang"])
    )
    chosen = stored(chosen, "language-sample")
    sample = known.select("doc_id", "lang", "text").join(chosen, ["doc_id", "lang"])
    features = stored(
        map_arrow(
            sample.select("lang", "place", "text"),
            _sparse,
            "lang string, place int, cells binary, parts binary",
        ),
        "language-features",
    )
    # One row per label: as many as languages were labelled.
    langs = sorted(r["lang"] for r in features.select("lang").distinct().collect())
    families: dict[str, list[str]] = {}
    for lang in langs:
        families.setdefault(family_of(lang), []).append(lang)
    tasks: list[tuple[str, str, bool, int]] = []
    quota = max(4, FAMILY_ROWS // max(1, len(langs)))
    if len(families) > 1:
        tasks += [
            (f"f:{f}", lang, lang in members, quota)
            for f, members in families.items()
            for lang in langs
        ]
    for members in families.values():
        for a, b in combinations(members, 2):
            tasks += [(f"p:{a}:{b}", a, True, per_language), (f"p:{a}:{b}", b, False, per_language)]
    weights: dict[str, np.ndarray] = {}
    if tasks:
        spark = labelled.sparkSession
        plan = spark.createDataFrame(tasks, "task string, lang string, positive boolean, quota int")
        fitted = (
            features.join(plan, "lang")
            .where("place <= quota")
            .groupBy("task")
            .applyInArrow(_fit, "task string, weights binary")
        )
        # One row of FEATURES weights per SVM.
        weights = {r["task"]: np.frombuffer(r["weights"], np.float32) for r in fitted.collect()}
    return {"families": families, "weights": weights}


def _predict(
    batches: Iterator[pa.RecordBatch], shared, column: str
) -> Iterator[pa.RecordBatch]:
    model = shared.value
    families, weights = model["families"], model["weights"]
    names = list(weights)
    matrix = np.stack([weights[n] for n in names]).T if names else np.zeros((FEATURES, 0))
    place = {n: i for i, n in enumerate(names)}
    for batch in text_batches(batches, column, 1 << 20, BATCH_ROWS):
        rows = _features(texts_of(batch, column).to_pylist())
        found = rows.any(1)
        margins = rows @ matrix
        langs, scores = [], []
        for margin, ok in zip(margins, found):
            lang, score = _decide(families, place, margin) if ok else (UNKNOWN, 0.0)
            langs.append(lang)
            scores.append(score)
        kept = [(n, c) for n, c in zip(batch.schema.names, batch.columns) if n != "text"]
        yield pa.record_batch(
            {
                **dict(kept),
                "lang_pred": pa.array(langs, pa.string()),
                "score": pa.array(scores, pa.float64()),
            }
        )


def _sigmoid(margin: float) -> float:
    return float(1 / (1 + np.exp(-3.0 * np.clip(margin, -20, 20))))


def _decide(families: dict, column: dict, margin: np.ndarray) -> tuple[str, float]:
    if not families:
        return UNKNOWN, 0.0
    names = list(families)
    chances = [_sigmoid(margin[column[f"f:{f}"]]) if len(names) > 1 else 1.0 for f in names]
    best = int(np.argmax(chances))
    members = families[names[best]]
    votes = dict.fromkeys(members, 0)
    belief = dict.fromkeys(members, 0.0)
    for a, b in combinations(members, 2):
        chance = _sigmoid(margin[column[f"p:{a}:{b}"]])
        votes[a if chance >= 0.5 else b] += 1
        belief[a] += chance
        belief[b] += 1 - chance
    lang = max(members, key=lambda m: (votes[m], belief[m]))
    inside = belief[lang] / (len(members) - 1) if len(members) > 1 else 1.0
    return lang, chances[best] * inside


def _judged(rows: DataFrame) -> T.StructType:
    return T.StructType([*rows.schema.fields]).add("lang_pred", "string").add("score", "double")


def identify(docs: DataFrame, model: dict, keep: list[str] | None = None) -> DataFrame:
    """``docs`` without its text (or only the columns ``keep``) with lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score")]
    columns = [c for c in kept if c != "text"]
    rows = docs.select(*columns, "text")
    schema = _judged(rows.drop("text"))
    return map_arrow(rows, _predict, schema, shared, "text")


def held_out() -> Column:
    """Whether a document takes no part in training."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame) -> dict:
    """The model of a documents table, from the documents that are not held out."""
    return train(docs.where(~held_out()))


def confident(docs: DataFrame, model: dict, min_score: float) -> DataFrame:
    """The rows of ``docs`` whose language is found with ``min_score`` at least."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(as_row(docs))
    judged = map_arrow(rows, _predict, _judged(rows), shared, "row.text")
    sure = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)
    return judged.where(sure).select("row.*")
