"""Quality classifier: ordinal cumulative-link regression on graded ratings.

The labels give three ordered grades: 0 toxic, 1 low quality, 2 good.  One
weight vector over hashed text features (the text's distinct words, and
binned style measures such as its share of symbols) is shared by all grades;
ordered thresholds t_0 < t_1 part them: P(grade <= k) = logistic(t_k - w x).
The expected grade and the tail probability P(grade = 2) follow; a document
stays if its tail probability is at least ``keep_from``.

Training takes a bounded sample of labelled documents (``train_rows``, those
whose hashed ids are least); Spark counts each one's rows by feature.  Every
feature of the sample weighs.  The less its shares of documents by grade lie
apart, the higher its penalty, so a long text is not moved by its many
ordinary words.  The driver holds the sparse sample, which long texts could
swell: it ends with the document that would take it over ``MAX_PAIRS`` (document,
feature) pairs (some 400 MB).  Every document is scored over its whole text, in
one pass without a shuffle.

Defined cases: null and empty texts have no words and an empty text's style;
labels with a null in either column, and labels without a document, are not
used; several labels of a document count as the lowest grade, several rows of it
as one document, the mean of their features; no usable labels keep everything (tail probability 1); repeated rows get equal
scores; an empty table gives no rows; extra columns are not read (scores) or
kept (filter).
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runoff.llm.common import tidied, written
from runoff.llm.words import text_segments

TRAIN_ROWS = 16_000
BUCKETS = 1 << 18
GRADES = 3
#: A feature with z of CLEAR or more has penalty L2; at less it grows by (CLEAR / z) ** STEEP, z from 1.
L2, CLEAR, STEEP = 0.02, 5.0, 6
#: (document, feature) pairs handled at a time, and those that the training sample may have.
PART, MAX_PAIRS = 1 << 20, 32_000_000
#: Bytes that part words: all ASCII but letters, digits and '.
APART = np.array([b < 128 and not (chr(b).isalnum() or chr(b) == "'") for b in range(256)])
#: Byte classes whose shares are style measures: symbols, punctuation, upper case, digits, beyond ASCII.
CLASSES = [np.array([b < 128 and chr(b) in s for b in range(256)]) for s in
           ("#$%&*+<>=@\\^_`{|}~[]/", ".,;:!?()\"-", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789")]
BINS = np.array([0.0, 0.002, 0.005, 0.01, 0.02, 0.04, 0.08, 0.12, 0.2, 0.3, 0.45, 0.6, 0.75, 0.9, 0.97])
STYLES = len(CLASSES) + 2


def _features(column: pa.Array):
    """Yields (first row, rows, row of each feature, feature): each row's
    distinct word buckets and one bin for each style measure."""
    for i, h, cut, raw, off in text_segments(column, APART):
        k = len(cut) - 1
        words = np.diff(cut)
        row = np.repeat(np.arange(k), words).astype(np.uint64)
        pair = np.unique(row << np.uint64(40) | (h & np.uint64(BUCKETS - 1)))
        row, word = (pair >> np.uint64(40)).astype(np.int64), (pair & np.uint64(BUCKETS - 1)).astype(np.int64)
        size = np.maximum(np.diff(off), 1)
        shares = [np.bincount(row, minlength=k) / np.maximum(words, 1)]
        for c in CLASSES:
            total = np.zeros(len(raw) + 1, np.int64)
            np.cumsum(c[raw], out=total[1:])
            shares.append((total[off[1:]] - total[off[:-1]]) / size)
        shares.append(np.minimum(np.log2(1 + words) / 16, 1))
        rows = [row, *[np.arange(k)] * STYLES]
        found = [word, *[BUCKETS + s * len(BINS) + np.searchsorted(BINS, x, "right") - 1
                         for s, x in enumerate(shares)]]
        yield i, k, np.concatenate(rows), np.concatenate(found)


N_FEATURES = BUCKETS + STYLES * len(BINS)


#: Stands for the row itself among a row's features.
ROW = -1


def _seen(batches):
    """A task's rows by (slot, feature), those by (slot, ROW) too; sent on
    whenever ``PART`` pairs have come together."""
    keys, counts, size = [], [], 0

    def sent():
        key, at = np.unique(np.concatenate(keys), return_inverse=True)
        n = np.bincount(at, np.concatenate(counts)).astype(np.int64)
        slot, feature = np.divmod(key, N_FEATURES + 1)
        return pa.RecordBatch.from_arrays(
            [pa.array(slot.astype(np.int32)), pa.array((feature + ROW).astype(np.int32)), pa.array(n)],
            names=["slot", "feature", "n"])

    for b in batches:
        slots = b.column("slot").to_numpy().astype(np.int64) * (N_FEATURES + 1)
        for i, k, row, feature in _features(b.column("text")):
            key, n = np.unique(np.concatenate([slots[i + row] + feature - ROW, slots[i:i + k]]), return_counts=True)
            keys.append(key)
            counts.append(n)
            size += len(key)
            if size > PART:
                yield sent()
                keys, counts, size = [], [], 0
    if size:
        yield sent()


def _packed(batches):
    """A row of bytes for each batch."""
    for b in batches:
        if b.num_rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array([b.column(c).to_numpy().astype(np.int32 if c != "n" else np.int64).tobytes()], pa.binary())
                 for c in b.schema.names], names=b.schema.names)


class OrdinalModel:
    """weights (one for each feature) and GRADES - 1 thresholds."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    def probabilities(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k from 1, by column."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -500, 500)))


def _penalties(grades: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Each feature's penalty, in parts of L2, by how far the shares of
    documents with it (``by`` grade) lie apart in some grade and the others."""
    n, has, z = len(grades), np.bincount(grades, minlength=GRADES), np.zeros(by.shape[1])
    for g in range(GRADES):
        if 0 < has[g] < n:
            rest = n - has[g]
            share = by.sum(0) / n
            spread = share * (1 - share) * (1 / has[g] + 1 / rest)
            z = np.maximum(z, np.abs(by[g] / has[g] - (by.sum(0) - by[g]) / rest) / np.sqrt(spread + 1e-12))
    return (CLEAR / np.clip(z, 1, CLEAR)) ** STEEP


def fit(grades: np.ndarray, features: list[np.ndarray], steps: int = 400, l2: float = L2) -> OrdinalModel:
    """The model of documents with these ``features``."""
    row = np.repeat(np.arange(len(grades), dtype=np.int32), [len(f) for f in features])
    col = np.concatenate([np.zeros(0, np.int32), *features]).astype(np.int32)
    return _fit(grades, row, col, np.ones(len(col), np.float32), steps, l2)


def _fit(grades: np.ndarray, row: np.ndarray, col: np.ndarray, share: np.ndarray, steps: int = 400,
         l2: float = L2) -> OrdinalModel:
    """Maximum likelihood with an L2 penalty, by Adam on the full sample, whose
    document ``row`` has feature ``col`` in ``share`` of its rows (``col`` is
    overwritten).  Every feature of the sample weighs; one that all documents
    have is left at 0, its optimum, as the thresholds do the same free of penalty."""
    n = len(grades)
    if not n:
        return OrdinalModel(np.zeros(N_FEATURES, np.float32), np.full(GRADES - 1, -500.0))
    parts = [slice(i, i + PART) for i in range(0, len(col), PART)]
    by = sum((np.bincount(grades[row[s]] * N_FEATURES + col[s], share[s], GRADES * N_FEATURES) for s in parts),
             np.zeros(GRADES * N_FEATURES)).reshape(GRADES, N_FEATURES)
    held = by.sum(0)
    top = np.flatnonzero((held > 0) & (held < n))
    k = len(top)
    # params are the weights over their scales, so that the penalty of all is L2
    scale = np.append(1 / np.sqrt(_penalties(grades, by[:, top])), 0)
    at = np.full(N_FEATURES, k, np.int32)  # k: no weight
    at[top] = np.arange(k)
    for s in parts:
        col[s] = at[col[s]]
    part = np.array([np.mean(grades <= j) for j in range(GRADES - 1)]).clip(0.5 / n, 1 - 0.5 / n)
    cut = np.log(part / (1 - part))
    # thresholds as the first and the logs of the steps between them keep their order
    params = np.concatenate([np.zeros(k), [cut[0]], np.log(np.maximum(np.diff(cut), 0.1))])
    m, v = np.zeros_like(params), np.zeros_like(params)
    for t in range(1, steps + 1):
        w, gaps = np.append(params[:k], 0) * scale, np.exp(params[k + 1:])
        th = params[k] + np.concatenate([[0], np.cumsum(gaps)])
        score = sum((np.bincount(row[s], w[col[s]] * share[s], n) for s in parts), np.zeros(n))
        below = 1 / (1 + np.exp(np.clip(score - np.concatenate([[-500], th, [500]])[:, None], -500, 500)))
        below[0], below[-1] = 0, 1
        hi, lo = below[grades + 1, np.arange(n)], below[grades, np.arange(n)]
        p = np.maximum(hi - lo, 1e-12)
        dhi, dlo = hi * (1 - hi) / p, lo * (1 - lo) / p
        grad = np.zeros_like(params)
        slope = dhi - dlo
        grad[:k] = sum((np.bincount(col[s], slope[row[s]] * share[s], k + 1) for s in parts), np.zeros(k + 1))[:k] * scale[:k] / n
        grad[:k] += l2 * params[:k] / np.sqrt(n)
        g_th = np.array([-(dhi[grades == j].sum() - dlo[grades == j + 1].sum()) for j in range(GRADES - 1)]) / n
        grad[k] = g_th.sum()
        grad[k + 1:] = np.cumsum(g_th[::-1])[::-1][1:] * gaps
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        params = params - 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    weights = np.zeros(N_FEATURES, np.float32)
    weights[top] = params[:k] * scale[:k]
    return OrdinalModel(weights, params[k] + np.concatenate([[0], np.cumsum(np.exp(params[k + 1:]))]))


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> OrdinalModel:
    """The model from a sample of at most ``train_rows`` labelled documents;
    the sampled labels are broadcast (their number is the bound)."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).otherwise(2)
    order = [F.xxhash64("_label"), F.col("_label")]
    picked = written(labels.where("doc_id is not null and quality is not null and toxic is not null")
                     .groupBy(F.col("doc_id").alias("_label")).agg(F.min(grade).alias("grade"))
                     .orderBy(*order).limit(train_rows)
                     .withColumn("slot", F.row_number().over(Window.orderBy(*order)) - 1), "labels")
    seen = (docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("_label"))
            .select("slot", "text").mapInArrow(tidied(_seen), "slot int, feature int, n long"))
    sample = written(seen.groupBy("slot", "feature").agg(F.sum("n").alias("n")), "sample")
    total = sample.count()
    if total > MAX_PAIRS:
        # documents by their place in the sample, up to the bound; a row of counts for each of at most train_rows
        upto = F.sum("pairs").over(Window.orderBy("slot"))
        fit_in = (sample.groupBy("slot").agg(F.count("*").alias("pairs")).withColumn("upto", upto)
                  .where((F.col("upto") <= MAX_PAIRS) | (F.col("upto") == F.col("pairs"))).select("slot"))
        sample = written(sample.join(fit_in, "slot"), "sample")
        total = sample.count()
    ranges = 1 + total // PART
    rows = (sample.repartitionByRange(ranges, "slot", "feature").sortWithinPartitions("slot", "feature")
            .mapInArrow(_packed, "slot binary, feature binary, n binary"))
    row, col, share = np.empty(total, np.int32), np.empty(total, np.int32), np.empty(total, np.float32)
    found, at = [], 0
    for r in rows.toLocalIterator():
        slot, feature, n = (np.frombuffer(r[c], t) for c, t in
                            (("slot", np.int32), ("feature", np.int32), ("n", np.int64)))
        # a document's number of rows comes first, under ROW
        new = feature == ROW
        found += zip(slot[new].tolist(), n[new].tolist())
        document = len(found) - new.sum() + np.cumsum(new) - 1
        of = np.array([c for _, c in found[document[0]:]])[document - document[0]]
        own = slice(at, at + int((~new).sum()))
        row[own], col[own], share[own] = document[~new], feature[~new], (n / of)[~new]
        at = own.stop
    if not found:
        return fit(np.zeros(0, np.int64), [])
    grades = {r["slot"]: r["grade"] for r in picked.select("slot", "grade").collect()}
    return _fit(np.array([grades[s] for s, _ in found], np.int64), row[:at], col[:at], share[:at])


def scores(docs: DataFrame, model: OrdinalModel, keep_from: float = 0.5) -> DataFrame:
    """``docs`` with expected_grade, tail_probability and keep."""
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))

    def run(batches):
        model = OrdinalModel(*sent.value)
        for b in batches:
            score = np.zeros(b.num_rows)
            for i, k, row, feature in _features(b.column("text")):
                w = model.weights[feature]
                score[i:i + k] = np.bincount(row, w, minlength=k)
            p = model.probabilities(score)
            tail = p[:, -1]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(p.sum(axis=1)), pa.array(tail), pa.array(tail >= keep_from)],
                names=[*b.schema.names, "expected_grade", "tail_probability", "keep"])

    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(tidied(run), f"{kind}, expected_grade double, tail_probability double, keep boolean")


def select(docs: DataFrame, labels: DataFrame, keep_from: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose tail probability is at least ``keep_from``."""
    model = train(docs, labels)
    used = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)], F.col("text"))
    kept = scores(used, model, keep_from).where("keep")
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
