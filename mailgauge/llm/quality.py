"""Quality classifier: regularised quadratic discriminant analysis of document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailgauge.llm.common import add_columns
from mailgauge.sources.scratch import land

# Bytes worked on at a time; a longer text is counted in several runs.
RUN_BYTES = 1 << 20

# Statistics are rates of bytes of these kinds; a byte is of the first kind that has it.
_KINDS = {
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "space": b" \t",
    "break": b"\n\r\x0b\x0c",
    "stop": b".",
    "comma": b",",
    "mark": b"!?",
    "quote": b"\"'`;:-()",
    "bar": b"|",
    "markup": b"<>{}[]/\\=_",
    "symbol": b"#$%&*@^~+",
    "control": bytes([*range(9), *range(14, 32), 127]),
    "high": bytes(range(128, 256)),
}
STATISTICS = ["length", *_KINDS, "words", "capital_words", "entropy", "commonest"]

_KIND_OF_BYTE = np.array([next((k for k, v in enumerate(_KINDS.values()) if b in v), 0) for b in range(256)])
_IS_KIND = (_KIND_OF_BYTE[:, None] == np.arange(len(_KINDS))).astype(np.float64)
_BLANK = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))
_UPPER = np.isin(np.arange(256), list(_KINDS["upper"]))


def document_statistics(texts: pa.Array) -> np.ndarray:
    """A row of transformed statistics for each text; null is as empty.

    Counts c become log((c + 1/2) / (bytes + 1)), the length becomes log(bytes + 1).
    """
    texts = pc.fill_null(texts.cast(pa.binary()), b"")
    n = len(texts)
    lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    data = np.frombuffer(b"".join(texts.to_pylist()), dtype=np.uint8)
    histogram = np.zeros((n, 256))
    words, capitals = np.zeros(n), np.zeros(n)
    for at in range(0, len(data), RUN_BYTES):
        run = data[at : at + RUN_BYTES]
        low = int(np.searchsorted(ends, at, side="right"))
        high = int(np.searchsorted(ends, at + len(run), side="left")) + 1
        edges = np.concatenate([[at], np.minimum(ends[low:high], at + len(run))])
        row = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
        histogram[low:high] += np.bincount(row * 256 + run, minlength=(high - low) * 256).reshape(-1, 256)
        before = np.concatenate([[True if at == 0 else _BLANK[data[at - 1]]], _BLANK[run[:-1]]])
        first = edges[:-1][np.diff(edges) > 0] - at  # a text begins a word whatever the text before ends in
        if low and at > ends[low - 1] or low == 0 and at > 0:
            first = first[1:]
        before[first] = True
        begins = before & ~_BLANK[run]
        words[low:high] += np.bincount(row[begins], minlength=high - low)
        begins &= _UPPER[run]
        capitals[low:high] += np.bincount(row[begins], minlength=high - low)
    size = lengths.astype(np.float64)[:, None]
    share = histogram / np.maximum(size, 1)
    entropy = -(share * np.log2(np.where(share > 0, share, 1))).sum(axis=1)
    rate = np.log((np.column_stack([histogram @ _IS_KIND, words, capitals]) + 0.5) / (size + 1))
    kinds = len(_KINDS)
    return np.column_stack(
        [np.log1p(lengths), rate[:, : kinds + 2], entropy, share.max(axis=1, initial=0)]
    )


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``statistics``, an array of doubles."""

    def prepare():
        def compute(column: pa.Array):
            rows = document_statistics(column)
            offsets = np.arange(len(rows) + 1, dtype=np.int32) * len(STATISTICS)
            return (pa.ListArray.from_arrays(offsets, pa.array(rows.ravel())),)

        return compute

    return add_columns(docs, text, "statistics array<double>", prepare)


@dataclass
class QualityModel:
    """Per class (0, 1): share, mean, and the inverse of the Cholesky factor of the covariance."""

    share: np.ndarray
    mean: np.ndarray
    whitener: np.ndarray
    log_det: np.ndarray


def class_moments(labelled: DataFrame) -> DataFrame:
    """label, place, total: sums of (1, x, x x') by class; a task sends one row per class and place."""
    width = len(STATISTICS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for batch in batches:
            label = batch.column(0).to_numpy()
            x = batch.column(1).flatten().to_numpy().reshape(-1, width)
            x = np.column_stack([np.ones(len(x)), x])
            for c in np.unique(label).tolist():
                own = x[label == c]
                sums[c] = sums.get(c, 0) + own.T @ own
        for c, total in sums.items():
            yield pa.RecordBatch.from_pydict(
                {
                    "label": pa.array([c] * total.size, pa.int32()),
                    "place": pa.array(np.arange(total.size, dtype=np.int32)),
                    "total": pa.array(total.ravel()),
                }
            )

    parts = labelled.select("label", "statistics").mapInArrow(run, "label int, place int, total double")
    return parts.groupBy("label", "place").agg(F.sum("total").alias("total"))


def train_quality_model(labelled: DataFrame, shrinkage: float = 0.1) -> QualityModel | None:
    """A model from rows of label (0 or 1) and statistics; None without rows.

    Each class covariance is drawn to its diagonal by ``shrinkage``, and by
    as much to the covariance of both classes together; a small ridge keeps
    statistics that never vary from blowing up.  A class without rows keeps
    the common moments and share 0.  What reaches the driver is of fixed size.
    """
    width = len(STATISTICS) + 1
    moments = np.zeros((2, width * width))
    for r in class_moments(labelled).collect():
        moments[r.label, r.place] = r.total
    moments = moments.reshape(2, width, width)
    counts = moments[:, 0, 0]
    if not counts.sum():
        return None

    def mean_and_covariance(m):
        mean = m[0, 1:] / m[0, 0]
        return mean, m[1:, 1:] / m[0, 0] - np.outer(mean, mean)

    common_mean, common = mean_and_covariance(moments.sum(axis=0))
    ridge = np.diag(0.01 * np.diag(common) + 1e-3)
    means, whiteners, dets = [], [], []
    for c in (0, 1):
        mean, own = mean_and_covariance(moments[c]) if counts[c] else (common_mean, common)
        own = (1 - shrinkage) * own + shrinkage * common
        own = (1 - shrinkage) * own + shrinkage * np.diag(np.diag(own)) + ridge
        factor = np.linalg.cholesky(own)
        means.append(mean)
        whiteners.append(np.linalg.inv(factor))
        dets.append(2 * np.log(np.diag(factor)).sum())
    return QualityModel(counts / counts.sum(), np.array(means), np.array(whiteners), np.array(dets))


def quality_scores(model: QualityModel | None, x: np.ndarray) -> np.ndarray:
    """Posterior probability of class 1 from the difference of the classes' log-densities."""
    if model is None:
        return np.full(len(x), 0.5)
    with np.errstate(divide="ignore"):
        log_share = np.log(model.share)
    logs = []
    for c in (0, 1):
        # Column by column: a matrix product rounds a row differently with the rows it comes with.
        white = sum(column[:, None] * w for column, w in zip((x - model.mean[c]).T, model.whitener[c].T))
        logs.append(log_share[c] - 0.5 * ((white**2).sum(axis=1) + model.log_det[c]))
    return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def score_quality(with_stats: DataFrame, model: QualityModel | None) -> DataFrame:
    """A frame with ``statistics``, and score (0 to 1) and predicted (1 if score >= 0.5); both replace their like."""
    spread = with_stats.sparkSession.sparkContext.broadcast(model)
    width = len(STATISTICS)

    @F.pandas_udf("double")
    def score(rows):
        x = np.vstack(rows.to_numpy()) if len(rows) else np.empty((0, width))
        import pandas as pd

        return pd.Series(quality_scores(spread.value, x))

    scored = with_stats.withColumn("score", score("statistics"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def classify_quality(
    docs: DataFrame,
    labels: DataFrame,
    learn_from=None,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> DataFrame:
    """doc_id, score, predicted of every row, learned from the labelled rows for which ``learn_from`` holds.

    ``learn_from`` is an expression over doc_id.  Labels other than 0 and 1
    and null ids teach nothing; a repeated label counts once, one that is
    contradicted counts for both classes, and every row of the id is learned
    from.  A null text is as an empty one.  Without any label all scores are
    0.5, with one class only all are that class.  Texts are read once and whole, however long: their
    statistics are stored and used for learning and scoring.  Rows that are
    repeated get equal scores, an empty table gives no rows.
    """
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    stats = land(with_statistics(base, "text").drop("text"))
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.filter(F.col("label").isin(0, 1)).distinct()
    taught = stats if learn_from is None else stats.filter(learn_from)
    model = train_quality_model(taught.join(known, "doc_id"))
    return score_quality(stats, model).drop("statistics")
