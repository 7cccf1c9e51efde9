"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels are given per document. Words are first weighed by how much more often they stand
in toxic than in clean training documents (counts over all of them, exact copies once);
in toxic training documents, words of strong evidence are the labelled toxic tokens. A
two-state chain is fitted to labelled token sequences of a bounded sample: one weight for
each unit (word or beginning of a word) of a bounded lexicon, one per transition. Forward-backward gives each token's
marginal; the expected number of toxic tokens and the probability that there is any at
all give the document's score through a logistic function fitted on the same sample.
"""

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import session_scratch
from .common import slices, string_texts

WORD = re.compile(r"[^\W\d_]+")
THRESHOLD = 0.3
# Bounds of what is fitted: units with a weight, frequent units considered, lengths of the
# beginnings of words that are units besides whole words, sampled documents of each class, and the
# longest document and the segments of tokens that enter the fit.
LEXICON = 4000
CANDIDATES = 100_000
BEGINNINGS = (7, 5)
SAMPLE = 700
SAMPLE_CHARS = 50_000
SEGMENT = 96
# Evidence (log ratio of shares of documents) of a word that labels a token, or has a weight;
# and in how many contexts, as a share of the toxic documents, it must stand. Contexts are
# counted, not documents, so that a group of near copies teaches nothing.
LABEL_EVIDENCE = 2.5
WEIGHT_EVIDENCE = 1.0
LEAST_SHARE = 0.004
LEAST_CONTEXTS = 4
BROADCAST_BYTES = 64 << 20


class Chain:
    """A fitted model: unit weights, chain potentials, the logistic function of documents."""

    def __init__(self, units_known: dict[str, int], weights: np.ndarray, logistic: np.ndarray | None = None) -> None:
        self.units_known = units_known
        self.weights = weights
        self.start, self.trans = np.zeros(2), np.zeros((2, 2))
        self.logistic = np.zeros(4) if logistic is None else logistic
        self.known: dict[str, int] = {}
        self.blanks: dict[int, float] = {}

    def index(self, tokens: list[str]) -> list[int]:
        """Number of the first known unit of each token, 0 without one; a bounded memory holds words."""
        known = self.known
        if len(known) > 300_000:
            known.clear()
        for word in set(tokens):
            if word not in known:
                known[word] = next((self.units_known[u] for u in units(word) if u in self.units_known), 0)
        return [known[w] for w in tokens]

    def marginals(self, index: list[int]) -> tuple[list[float], float]:
        """Each token's probability of being toxic, and the log probability that none is."""
        (t00, t01), (t10, t11) = np.exp(self.trans).tolist()
        factors = np.exp(np.clip(self.weights, -30, 30))[index].tolist()
        a0, a1 = math.exp(self.start[0]), math.exp(self.start[1]) * factors[0]
        forward, log_z = [], 0.0
        for place, factor in enumerate(factors):
            if place:
                a0, a1 = a0 * t00 + a1 * t10, (a0 * t01 + a1 * t11) * factor
            total = a0 + a1
            a0, a1 = a0 / total, a1 / total
            log_z += math.log(total)
            forward.append(a1)
        b0 = b1 = 1.0
        found = [0.0] * len(factors)
        for place in range(len(factors) - 1, -1, -1):
            if place < len(factors) - 1:
                next1 = factors[place + 1] * b1
                b0, b1 = t00 * b0 + t01 * next1, t10 * b0 + t11 * next1
                total = b0 + b1
                b0, b1 = b0 / total, b1 / total
            toxic = forward[place] * b1
            found[place] = toxic / (toxic + (1.0 - forward[place]) * b0)
        none = self.start[0] + (len(factors) - 1) * self.trans[0, 0] - log_z
        return found, min(0.0, float(none))

    def score(self, expected: float, log_none: float) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(_features(expected, log_none) @ self.logistic, -40, 40))))

    def read(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """Score of a text, and (begin, end, probability) of its toxic words by code points."""
        lower = text.lower()
        tokens = WORD.findall(lower)
        index = self.index(tokens)
        if not any(index):
            return self.blank(len(tokens)), []
        found, none = self.marginals(index)
        places = (m.span() for m in WORD.finditer(lower))
        spans = [(b, e, p) for (b, e), p in zip(places, found, strict=True) if p >= 0.5]
        return self.score(sum(found), none), spans

    def blank(self, n: int) -> float:
        """Score of n words of which none is in the lexicon; a bounded memory holds lengths."""
        if n not in self.blanks:
            if len(self.blanks) > 100_000:
                self.blanks.clear()
            found, none = self.marginals([0] * n) if n else ([], 0.0)
            self.blanks[n] = self.score(sum(found), none)
        return self.blanks[n]


def _features(expected, log_none) -> np.ndarray:
    """Constant, log of the expected toxic tokens, chance of any, and whether they are more than one."""
    expected = np.asarray(expected, float)
    several = 1 / (1 + np.exp(-np.clip(4 * (expected - 1.5), -40, 40)))
    columns = (np.ones_like(expected), np.log(expected + 1e-3), -np.expm1(np.asarray(log_none)), several)
    return np.stack(columns, axis=-1)


def units(word: str) -> list[str]:
    """What a word may be known by: itself, then its longer and shorter beginnings."""
    return [word, *[word[:k] + "*" for k in BEGINNINGS if len(word) > k]]


def unit_counts(texts: DataFrame, wanted: frozenset[str] | None = None) -> DataFrame:
    """(unit, n): how many of the rows hold a unit, counted per slice before the shuffle."""
    shared = texts.sparkSession.sparkContext.broadcast(wanted)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                counts = Counter()
                for text in part.column(0).to_pylist():
                    found = {u for w in set(WORD.findall(text.lower())) for u in units(w)}
                    counts.update(found if shared.value is None else found & shared.value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["unit", "n"]
                )

    counted = texts.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(work, "unit string, n long")
    return counted.groupBy("unit").agg(F.sum("n").alias("n"))


def _evidence(toxic, n_toxic: int, n_clean: int):
    toxic = F.col(toxic) if isinstance(toxic, str) else toxic
    return F.log((toxic + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))


def contexts(toxic_rows: DataFrame) -> DataFrame:
    """(unit, contexts): how many different words stand before a unit in toxic documents."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                found = set()
                for text in part.column(0).to_pylist():
                    tokens = WORD.findall((text or "").lower())
                    found.update(zip(["", *tokens], tokens, strict=False))
                pairs = list({(u, left) for left, w in found for u in units(w)})
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w for w, _ in pairs], pa.string()), pa.array([b for _, b in pairs], pa.string())],
                    ["unit", "before"],
                )

    pairs = toxic_rows.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(work, "unit string, before string")
    return pairs.distinct().groupBy("unit").agg(F.count(F.lit(1)).alias("contexts"))


def _fit_chain(index: np.ndarray, gold: np.ndarray, mask: np.ndarray, n_words: int, rounds: int = 80):
    """Weights by gradient ascent (Adam) on the conditional likelihood; all segments advance together."""
    n, length = index.shape
    weights, start, trans = np.zeros(n_words), np.zeros(2), np.zeros((2, 2))
    weights[0] = -2.0
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (weights, start, trans)]
    own_words = np.bincount(index[mask & (gold == 1)], minlength=n_words).astype(float)
    own_start = np.bincount(gold[:, 0], minlength=2).astype(float)
    pair = mask[:, 1:]
    own_trans = np.bincount((gold[:, :-1] * 2 + gold[:, 1:])[pair], minlength=4).reshape(2, 2).astype(float)
    for step in range(1, rounds + 1):
        factor = np.stack([np.ones((n, length)), np.exp(np.clip(weights, -30, 30))[index]], axis=2)
        t = np.exp(trans)
        alpha = np.empty((n, length, 2))
        alpha[:, 0] = np.exp(start) * factor[:, 0]
        alpha[:, 0] /= alpha[:, 0].sum(1, keepdims=True)
        for k in range(1, length):
            a = (alpha[:, k - 1] @ t) * factor[:, k]
            alpha[:, k] = np.where(mask[:, k, None], a / a.sum(1, keepdims=True), alpha[:, k - 1])
        beta = np.ones((n, length, 2))
        expected_trans = np.zeros((2, 2))
        for k in range(length - 2, -1, -1):
            ahead = beta[:, k + 1] * factor[:, k + 1]
            joint = alpha[:, k, :, None] * t * ahead[:, None, :]
            joint /= joint.sum((1, 2), keepdims=True)
            expected_trans += joint[mask[:, k + 1]].sum(0)
            b = ahead @ t.T
            beta[:, k] = np.where(mask[:, k + 1, None], b / b.sum(1, keepdims=True), 1.0)
        gamma = alpha * beta
        gamma /= gamma.sum(2, keepdims=True)
        expected_words = np.bincount(index[mask], gamma[..., 1][mask], minlength=n_words)
        gradients = (
            (own_words - expected_words) - 0.05 * weights,
            (own_start - gamma[:, 0].sum(0)) - 0.05 * start,
            (own_trans - expected_trans) - 0.05 * trans,
        )
        for value, gradient, (m, v) in zip((weights, start, trans), gradients, moments, strict=True):
            m += 0.1 * (gradient - m)
            v += 0.01 * (gradient**2 - v)
            value += 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return weights, start, trans


def _fit_logistic(x: np.ndarray, y: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (share * p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-2 * np.eye(x.shape[1])
        w = w + np.linalg.solve(hessian, x.T @ (share * (y - p)) - 1e-2 * w)
    return w


def _segments(rows: list[tuple[list[int], int]], labels_token: np.ndarray):
    """Unit numbers, gold labels and which places are real, in segments of SEGMENT tokens."""
    parts = [(t[at : at + SEGMENT], label) for t, label in rows for at in range(0, len(t), SEGMENT)]
    index = np.zeros((len(parts), SEGMENT), np.int64)
    mask = np.zeros((len(parts), SEGMENT), bool)
    toxic = np.array([label for _, label in parts], bool)
    for row, (part, _) in enumerate(parts):
        index[row, : len(part)] = part
        mask[row, : len(part)] = True
    return index, (labels_token[index] & toxic[:, None]).astype(np.int64), mask


def training_rows(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(text, toxic) of labelled rows outside the held-out fold, exact copies of a class once."""
    ids = labels.where("toxic IS NOT NULL").select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
    ids = ids.where(~held_out(F.col("_id"))).dropDuplicates(["_id"])
    fits = (ids.count() * 16) <= BROADCAST_BYTES
    named = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("text"))
    joined = named.join(F.broadcast(ids) if fits else ids, "_id")
    keyed = joined.withColumn("_key", F.xxhash64("text"))
    first = keyed.groupBy("_key", "toxic").agg(F.min("_id").alias("_id"))
    first = session_scratch(docs.sparkSession).store(first)
    return keyed.join(F.broadcast(first) if fits else first, ["_key", "toxic", "_id"]).select("text", "toxic", "_key")


def held_out(doc_id) -> "F.Column":
    """Whether an id is in the fold that teaches nothing; an unknown id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Chain:
    """Fit on the labelled rows outside the held-out fold.

    The word counts cover all of them; the chain is fitted on up to SAMPLE documents of each
    class, picked by hash. Without both classes, every score is the share of toxic labels.
    """
    scratch = session_scratch(docs.sparkSession)
    # several passes read these rows; the whole table is read once for them
    rows = scratch.store(training_rows(docs, labels, doc_id, text))
    totals = rows.agg(F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("n")).first()
    n_toxic = int(totals.toxic or 0)
    n_clean = int(totals.n) - n_toxic
    if not n_toxic or not n_clean:
        share = (n_toxic + 0.1) / (n_toxic + n_clean + 1.0)
        logit = np.array([math.log(share / (1 - share)), 0.0, 0.0, 0.0])
        return Chain({}, np.zeros(1), logit)
    least = max(LEAST_CONTEXTS, LEAST_SHARE * n_toxic)
    # units of copied texts go before either bound, so that they take no place in them
    toxic = scratch.store(
        unit_counts(rows.where("toxic = 1"))
        .where(F.col("n") >= least)
        .join(contexts(rows.where("toxic = 1")).where(F.col("contexts") >= least), "unit")
        .orderBy(F.desc(F.least("n", "contexts")), "unit")
        .limit(CANDIDATES)
    ).withColumnRenamed("n", "toxic")
    frequent = frozenset(r.unit for r in toxic.select("unit").collect())
    clean = unit_counts(rows.where("toxic = 0"), frequent).withColumnRenamed("n", "clean")
    weighed = (
        toxic.join(clean, "unit", "left")
        .fillna(0, ["clean"])
        .withColumn("evidence", _evidence(F.least("toxic", "contexts"), n_toxic, n_clean))
        .where(F.col("evidence") >= WEIGHT_EVIDENCE)
        .orderBy(F.desc("evidence"), "unit")
        .limit(LEXICON)
    )
    lexicon = weighed.orderBy("unit").collect()
    chain = Chain({r.unit: i + 1 for i, r in enumerate(lexicon)}, np.zeros(len(lexicon) + 1))
    labels_token = np.array([False, *[r.evidence >= LABEL_EVIDENCE for r in lexicon]])
    # keys alone are ranked, so that no task gathers the texts of all others' first rows
    usable = rows.where(F.length("text") <= SAMPLE_CHARS)
    keys = usable.select("_key", "toxic")
    first = [keys.where(F.col("toxic") == k).orderBy(F.abs("_key"), "_key").limit(SAMPLE) for k in (1, 0)]
    picked = usable.join(F.broadcast(first[0].unionByName(first[1])), ["_key", "toxic"])
    sample = [(WORD.findall((r.text or "").lower()), r.toxic) for r in picked.orderBy("_key", "toxic").collect()]
    scratch.drop(rows)
    indexed = [(chain.index(tokens), label) for tokens, label in sample]
    index, gold, mask = _segments(indexed, labels_token)
    chain.weights, chain.start, chain.trans = _fit_chain(index, gold, mask, len(lexicon) + 1)
    read = [chain.marginals(tokens) if tokens else ([], 0.0) for tokens, _ in indexed]
    x = _features(np.array([sum(p) for p, _ in read]), np.array([none for _, none in read]))
    y = np.array([label for _, label in sample], float)
    share = np.where(y == 1, n_toxic / max(1, y.sum()), n_clean / max(1, (1 - y).sum())) * len(y) / (n_toxic + n_clean)
    chain.logistic = _fit_logistic(x, y, share)
    return chain


def read_toxicity(docs: DataFrame, chain: Chain, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, score and spans (begin, end, probability by code points of the text).

    NULL texts are empty, and empty texts have a score too; every row gives a row. Where
    lower-casing changes a text's length, offsets are those of the lower-cased text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    spans_type = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            batch = pa.RecordBatch.from_arrays([batch.column(0), string_texts(batch, 1)], ["doc_id", "text"])
            for part in slices(batch, 1):
                read = [model.read(t) for t in part.column(1).to_pylist()]
                spans = [[{"begin": b, "end": e, "probability": p} for b, e, p in s] for _, s in read]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([s for s, _ in read], pa.float64()), pa.array(spans, spans_type)],
                    ["doc_id", "score", "spans"],
                )

    return chosen.mapInArrow(
        work, f"doc_id {kind}, score double, spans array<struct<begin:long,end:long,probability:double>>"
    )


def toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, held_out, score, predicted (score at least THRESHOLD) and spans."""
    scored = read_toxicity(docs, fit(docs, labels, doc_id, text), doc_id, text)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).cast("int").alias("predicted"),
        "spans",
    )


def accepted(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` whose score is below THRESHOLD, columns unchanged, in one pass over the texts."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, doc_id, text))
    at = docs.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            row = 0
            for part in slices(batch.set_column(at, batch.schema.field(at).name, string_texts(batch, at)), at):
                keep = [model.read(t)[0] < THRESHOLD for t in part.column(at).to_pylist()]
                yield batch.slice(row, part.num_rows).filter(pa.array(keep, pa.bool_()))
                row += part.num_rows

    return docs.mapInArrow(work, docs.schema)
