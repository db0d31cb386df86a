"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's probability is a logistic function of its words (whole, and
their first 4, 5 and 6 bytes, so that word families generalise); the document's is the noisy-or of its
sentences, 1 - prod(1 - p). Weights of either sign are fitted to document labels through the noisy-or, so a
positive document is explained by the few sentences that can explain it, and the same weights locate offending
sentences.

Fitting uses a bounded sample: `MOST_POSITIVE` + `MOST_NEGATIVE` labelled documents, smallest hashed ids first,
with their whole texts. A feature takes part if its share among the documents of either label differs by
`SURE` standard errors and `LEAST_DOCS` documents have it. Features are counted on the executors; the driver gets
those that take part and the sample's sentences in terms of them, and only the weights are broadcast. Scoring
covers every whole text.

Null and empty texts have no sentence and score 0. Labels of repeated ids count as the largest, and of the texts
of a repeated id one teaches (that of the smallest hash); every row is scored. Null labels and labels without a
document are ignored. Without labels of both kinds, or in an empty table, nothing is learned and all scores are
near 0. Other columns are passed on; one named like the result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ._spark import Spool, table
from ._text import LOWER, column_pieces, flat, hash_spans, lanes, mix, pieces, spans

MOST_POSITIVE, MOST_NEGATIVE = 4_000, 8_000
#: Standard errors by which a feature's shares must differ, and the least documents that have it.
SURE, LEAST_DOCS = 4.0, 4
THRESHOLD = 0.7
KINDS = 4
#: Log odds of a sentence without any evidence, before the fit.
REST = -12.0

LETTER = np.zeros(256, bool)
LETTER[0x30:0x3A] = LETTER[0x61:0x7B] = LETTER[0x80:] = True
STOP = np.zeros(256, bool)
STOP[[0x0A, 0x21, 0x2E, 0x3F]] = True


def features(column: pa.Array) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """For each word its hashed features by kind and its sentence; for each sentence with words its document,
    first and last byte: (features, sentence of word, document of sentence, byte span of sentence)."""
    data, offsets = flat(column)
    data = LOWER[data]
    starts, ends, before = spans(LETTER[data], offsets)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return [np.zeros(0, np.uint64)] * KINDS, none, none, np.zeros((0, 2), np.int64)
    doc = np.repeat(np.arange(len(before) - 1), np.diff(before))
    stops = np.cumsum(STOP[data])[starts]
    sentence = np.cumsum(np.append(0, (np.diff(stops) != 0) | (np.diff(doc) != 0)))
    head = np.flatnonzero(np.append(True, np.diff(sentence) != 0))
    tail = np.append(head[1:], len(starts)) - 1
    kinds = [hash_spans(data, starts, ends, seed=1)]
    size, lane = ends - starts, lanes(data)[starts]
    for n in (4, 5, 6):
        low = lane & np.uint64((1 << 8 * n) - 1)
        kinds.append(np.where(size >= n, mix(low + np.uint64(n << 56)), np.uint64(0)))
    base = offsets[doc[head]]
    return [k >> np.uint64(14) for k in kinds], sentence, doc[head], np.stack([starts[head] - base, ends[tail] - base], axis=1)


class Model:
    """Sorted feature hashes, their weights, and the bias."""

    def __init__(self, hashes: np.ndarray, weights: np.ndarray, bias: float):
        self.hashes, self.weights, self.bias = hashes, weights, bias

    def prepare(self) -> None:
        self.seen = np.zeros(1 << 22, bool)
        self.seen[(self.hashes & np.uint64((1 << 22) - 1)).astype(np.int64)] = True

    def sentences(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log odds, document and byte span of each sentence."""
        kinds, sentence, doc, span = features(column)
        logit = np.full(len(doc), self.bias)
        for k in kinds if len(self.hashes) else ():
            some = np.flatnonzero(self.seen[(k & np.uint64((1 << 22) - 1)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.hashes, k[some]), len(self.hashes) - 1)
            true = self.hashes[at] == k[some]
            logit += np.bincount(sentence[some[true]], self.weights[at[true]], len(doc))
        return logit, doc, span


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, label) to (feature, documents that have it, those of label 1), folded per task."""
    f, n, n_pos = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        for part in pieces(batch, "text", 1 << 20):
            positive = part.column("label").to_numpy(zero_copy_only=False) == 1
            kinds, sentence, doc, _ = features(part.column("text"))
            own = doc[sentence].astype(np.uint64) << np.uint64(50)
            pair = np.unique(np.concatenate([own | k for k in kinds]))
            feature, owner = pair & np.uint64((1 << 50) - 1), (pair >> np.uint64(50)).astype(np.int64)
            every = np.concatenate([f, feature])
            order = np.argsort(every, kind="stable")
            every = every[order]
            new = np.flatnonzero(np.append(True, every[1:] != every[:-1])) if len(every) else np.zeros(0, np.int64)
            if len(new):
                n = np.add.reduceat(np.concatenate([n, np.ones(len(feature), np.int64)])[order], new)
                n_pos = np.add.reduceat(np.concatenate([n_pos, positive[owner].astype(np.int64)])[order], new)
                f = every[new]
            if len(f) > 2_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(f.view(np.int64)), pa.array(n), pa.array(n_pos)], ["f", "n", "n_pos"])
                f, n, n_pos = f[:0], n[:0], n_pos[:0]
    yield pa.RecordBatch.from_arrays([pa.array(f.view(np.int64)), pa.array(n), pa.array(n_pos)], ["f", "n", "n_pos"])


def sureness(n: Column, n_pos: Column, positives: int, negatives: int) -> Column:
    """Standard errors between a feature's shares among documents of label 1 and of label 0."""
    share = n / F.lit(positives + negatives)
    error = F.sqrt(share * (1 - share) * F.lit(1 / positives + 1 / negatives))
    return F.when(error > 0, (n_pos / F.lit(positives) - (n - n_pos) / F.lit(negatives)) / error).otherwise(0.0)


def bags(column: pa.Array, f: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """For each text the sizes of its sentences that hold features of the sorted `f`, these features' numbers
    sentence by sentence, and how many sentences hold none."""
    kinds, sentence, doc, _ = features(column)
    hits = [np.minimum(np.searchsorted(f, k), len(f) - 1) for k in kinds]
    true = [f[h] == k for h, k in zip(hits, kinds, strict=True)]
    own = np.concatenate([sentence[x] for x in true])
    number = np.concatenate([h[x] for h, x in zip(hits, true, strict=True)])
    order = np.argsort(own, kind="stable")
    some, size = np.unique(own, return_counts=True)
    owner = doc[some]
    cut, at = np.searchsorted(owner, np.arange(len(column) + 1)), np.append(0, np.cumsum(size))
    plain = np.bincount(doc, minlength=len(column)) - np.diff(cut)
    number = number[order].astype(np.int32)
    return [size[a:b].astype(np.int32) for a, b in zip(cut, cut[1:], strict=False)], [number[at[a] : at[b]] for a, b in zip(cut, cut[1:], strict=False)], plain


def fit(sizes: list[np.ndarray], numbers: list[np.ndarray], plain: np.ndarray, labels: np.ndarray, f: np.ndarray, lean: np.ndarray, rounds: int = 150, rate: float = 0.2, decay: float = 0.01, init: float = 1.5) -> Model:
    """Weights by Adam on the noisy-or likelihood of document labels; `lean` tells which features begin above zero."""
    n_docs, positive = len(labels), labels.astype(bool)
    owner = np.repeat(np.arange(n_docs), [len(x) for x in sizes])
    row, column, at = np.repeat(np.arange(len(owner)), np.concatenate(sizes)), np.concatenate(numbers), len(owner)
    bias, w, m, v = REST, np.where(lean, init, 0.0), np.zeros(len(f) + 1), np.zeros(len(f) + 1)
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    for t in range(1, rounds + 1):
        z = np.clip(bias + np.bincount(row, w[column], at), -60, 60)
        p, p0 = sigmoid(z), sigmoid(bias)
        off = np.bincount(owner, np.log1p(-np.minimum(p, 1 - 1e-12)), n_docs) + plain * np.log1p(-p0)
        clean = np.exp(off)  # probability that no sentence offends
        # d(-log likelihood)/d(log odds of a sentence) = p for label 0, -p * clean / (1 - clean) for label 1
        pull = np.where(positive, -clean / np.maximum(1 - clean, 1e-9), 1.0) / n_docs
        g = pull[owner] * p
        grad = np.append(np.bincount(column, g[row], len(f)) + decay / n_docs * w, g.sum() + (pull * plain).sum() * p0)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
        w, bias = w - step[:-1], bias - step[-1]
    keep = np.abs(w) > 1e-3
    return Model(f[keep], w[keep], float(bias))


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic") -> Model:
    """Fits on a bounded sample of the labelled documents."""
    spark = docs.sparkSession
    spool = Spool(spark, "toxicity")
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("id")).agg(F.max(label).cast("int").alias("label"))
    order = [F.xxhash64("id"), F.col("id")]
    picked = known.where("label = 1").orderBy(*order).limit(MOST_POSITIVE).union(known.where("label = 0").orderBy(*order).limit(MOST_NEGATIVE))
    # at most MOST_POSITIVE + MOST_NEGATIVE ids: a proven bound
    body = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = body.join(F.broadcast(picked), "id")
    sample = spool.keep(rows.groupBy("id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")), "sample")
    size = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    nothing = Model(np.zeros(0, np.uint64), np.zeros(0), REST)
    if not size.get(1) or not size.get(0):
        spool.drop(sample)
        return nothing
    counted = sample.select("text", "label").mapInArrow(_counting, "f long, n long, n_pos long").groupBy("f").agg(F.sum("n").alias("n"), F.sum("n_pos").alias("n_pos"))
    sure = counted.where((F.col("f") != 0) & (F.col("n") >= LEAST_DOCS)).withColumn("sure", sureness(F.col("n"), F.col("n_pos"), size[1], size[0]))
    chosen = sure.where(F.abs("sure") >= SURE).select("f", "sure").toArrow()
    hashes = chosen.column("f").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    f, lean = hashes[order], chosen.column("sure").to_numpy()[order] > 0
    if not len(f):
        spool.drop(sample)
        return nothing
    shared = spark.sparkContext.broadcast(f)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", 1 << 20):
                sizes, numbers, plain = bags(part.column("text"), shared.value)
                yield pa.RecordBatch.from_arrays([part.column("label"), pa.array(plain), pa.array(sizes, pa.list_(pa.int32())), pa.array(numbers, pa.list_(pa.int32()))], ["label", "plain", "sizes", "numbers"])

    # of the sample only the chosen features come to the driver
    got = sample.select("text", "label").mapInArrow(reduce, "label int, plain long, sizes array<int>, numbers array<int>").toArrow()
    spool.drop(sample)
    lists = lambda c: [np.asarray(x.values.to_numpy() if x.is_valid else [], np.int64) for x in got.column(c).combine_chunks()]
    return fit(lists("sizes"), lists("numbers"), got.column("plain").to_numpy(), got.column("label").to_numpy(), f, lean)


def toxicity(text: Column | str, model: Model, spark: SparkSession) -> Column:
    """A struct column: score, and the offending sentences as byte spans with their probability."""
    shared = spark.sparkContext.broadcast((model.hashes, model.weights, model.bias))

    @arrow_udf("struct<score:double,sentences:array<struct<start:long,stop:long,p:double>>>")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Model(*shared.value)
        own.prepare()
        for batch in batches:
            made = []
            for part in column_pieces(batch, 1 << 21):
                logit, doc, span = own.sentences(part)
                p = 1 / (1 + np.exp(-logit))
                off = np.bincount(doc, -np.logaddexp(0, logit), len(part))
                bad = np.flatnonzero(p >= 0.5)
                cut = np.searchsorted(doc[bad], np.arange(len(part) + 1))
                rows = pa.StructArray.from_arrays([pa.array(span[bad, 0]), pa.array(span[bad, 1]), pa.array(p[bad])], ["start", "stop", "p"])
                made.append(pa.StructArray.from_arrays([pa.array(-np.expm1(off)), pa.ListArray.from_arrays(pa.array(cut, pa.int32()), rows)], ["score", "sentences"]))
            empty = pa.struct([("score", pa.float64()), ("sentences", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("p", pa.float64())])))])
            yield pa.concat_arrays(made) if made else pa.array([], empty)

    return score.asNondeterministic()(text)  # so that no filter on the result makes it run twice


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose label is never learned. A null id belongs to none of the folds: not held out, and without label."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def score_documents(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic", into: str = "toxicity") -> DataFrame:
    """`docs` with the struct column of `toxicity`, learned from labels outside the held-out fold."""
    model = train(docs, labels.where(~held_out(doc_id)), text, doc_id, label)
    return docs.withColumn(into, toxicity(F.col(text), model, docs.sparkSession))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = score_documents(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    score = F.col("toxicity.score")
    return out.select("doc_id", held_out().alias("held_out"), score.alias("score"), (score >= THRESHOLD).cast("int").alias("predicted"), F.size("toxicity.sentences").cast("long").alias("n_offending"))


QUERIES = {"op1_toxicity": op1_toxicity}
ORACLE: dict[str, str] = {}
