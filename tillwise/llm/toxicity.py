"""Toxicity by a factorization machine over hashed terms.

A document is the set of its terms: words, the first bytes of words, which inflected and compounded forms
share, and for first bytes also that several different words begin so. Terms are hashed into ``2^HASH_BITS`` buckets.
The machine's inputs are the ``TERMS`` buckets that toxic and clean training documents hold most unevenly (G statistic),
and, of the ``FREQUENT`` buckets that divide the documents most evenly into with and without, every member of a pair that
together tells much more of the label than its two members do alone (``LEAST_JOINT``):

    score = sigmoid(bias + sum of w_i + sum over pairs of <v_i, v_j>)

The pairs cost no more than the terms: the sum is half of (sum of v)^2 - sum of v^2. A weight alone cannot say
that two terms are harmless apart and harmful together; the product of their factors can.

Learning uses at most ``SAMPLE`` labelled rows, those with the smallest hash of the id, so the driver holds
``SAMPLE`` short lists of terms, two square tables of ``FREQUENT`` and a model of fixed size, whatever the size of the
tables.

Defined results: null and empty texts have no terms and get the bias's score; labels that are null are not
learned from; a doc_id labelled more than once is learned once, as toxic if any label says so; with labels of one kind
or none, every score is that share (0 for none); extra columns are not read.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm.text import in_fold, lowered, pieces, shared, small_batches, table
from tillwise.sources.scratch import materialise

FOLDS, HELD = 4, 2
THRESHOLD = 0.3
HASH_BITS = 22
TERMS = 8192
SAMPLE = 20_000
LEAST_GAIN = 6.0
FREQUENT = 2048
LEAST_JOINT = 45.0  # chance reaches 42 in one of the two million pairs of 2048 terms, once in a hundred corpora
PREFIXES = (4, 5, 6)
SEVERAL = (2, 3, 5)
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_CACHE = 1 << 20


class Terms:
    """Distinct terms of texts; with ``chosen`` (sorted buckets) only those, as positions in it."""

    def __init__(self, chosen: np.ndarray | None = None):
        self.places = None if chosen is None else {int(b): i for i, b in enumerate(chosen)}
        self.known: dict[bytes, tuple[list[int], list[tuple[int, ...]]]] = {}

    def place(self, term: bytes, kind: int) -> int:
        """-1 for a bucket that is not chosen."""
        bucket = zlib.crc32(term, kind) & ((1 << HASH_BITS) - 1)
        return bucket if self.places is None else self.places.get(bucket, -1)

    def of_word(self, word: bytes) -> tuple[list[int], list[tuple[int, ...]]]:
        """Its own terms, and for each of its beginnings the terms for one, and for several, words that begin so."""
        got = self.known.get(word)
        if got is None:
            begins = [tuple(self.place(word[:n], 16 * n + k) for k in (1, *SEVERAL)) for n in PREFIXES if len(word) > n]
            own = self.place(word, 0)
            got = ([own] if own >= 0 else [], [b for b in begins if max(b) >= 0])
            if len(self.known) >= _CACHE:
                self.known.clear()
            self.known[word] = got
        return got

    def of_text(self, text: str | None) -> list[int]:
        words: set[bytes] = set()
        for piece in pieces(lowered(text)):
            words.update(_WORD.findall(piece))
        out: set[int] = set()
        counts: dict[tuple[int, ...], int] = {}
        for word in words:
            own, begins = self.of_word(word)
            out.update(own)
            for b in begins:
                counts[b] = counts.get(b, 0) + 1
        for b, n in counts.items():
            out.update(place for place, least in zip(b, (1, *SEVERAL), strict=True) if n >= least and place >= 0)
        return sorted(out)


class Machine:
    """bias, weights[i] and factors[i, f]."""

    def __init__(self, inputs: int, rank: int = 8, seed: int = 11):
        self.bias = 0.0
        self.weights = np.zeros(inputs)
        self.factors = np.random.default_rng(seed).normal(0, 0.01, (inputs, rank))

    def raw(self, flat: np.ndarray, owner: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
        """Score before the sigmoid, and the sum of factors, of ``rows`` documents given as (owner, term) lists."""
        linear = np.bincount(owner, self.weights[flat], rows)
        v = self.factors[flat]
        total = np.stack([np.bincount(owner, v[:, f], rows) for f in range(v.shape[1])], axis=1)
        squares = np.bincount(owner, (v * v).sum(1), rows)
        return self.bias + linear + 0.5 * ((total * total).sum(1) - squares), total

    def scores(self, documents: list[list[int]]) -> np.ndarray:
        flat, owner = flattened(documents)
        return sigmoid(self.raw(flat, owner, len(documents))[0])

    def fit(
        self, documents: list[list[int]], labels: np.ndarray, steps: int = 1200, batch: int = 256, rate: float = 0.1,
        keep: float = 1e-4, seed: int = 11,
    ) -> Machine:
        """Logistic loss, AdaGrad, L2 on every active weight; whole passes, ``steps`` batches at least."""
        rng = np.random.default_rng(seed)
        share = float(labels.mean())
        self.bias = float(np.log(share / (1 - share)))
        past_b, past_w, past_v = 1.0, np.ones_like(self.weights), np.ones_like(self.factors)
        for _ in range(-(-steps // -(-len(documents) // batch))):
            order = rng.permutation(len(documents))
            for at in range(0, len(order), batch):
                rows = order[at : at + batch]
                flat, owner = flattened([documents[i] for i in rows])
                raw, total = self.raw(flat, owner, len(rows))
                slope = sigmoid(raw) - labels[rows]
                g_b = slope.sum()
                past_b += g_b**2
                self.bias -= rate * g_b / np.sqrt(past_b)
                active, where = np.unique(flat, return_inverse=True)
                if not len(active):
                    continue
                each = slope[owner]
                g_w = np.bincount(where, each, len(active)) + keep * self.weights[active]
                push = each[:, None] * (total[owner] - self.factors[flat])
                g_v = np.stack([np.bincount(where, push[:, f], len(active)) for f in range(push.shape[1])], axis=1)
                g_v += keep * self.factors[active]
                past_w[active] += g_w**2
                past_v[active] += g_v**2
                self.weights[active] -= rate * g_w / np.sqrt(past_w[active])
                self.factors[active] -= 0.3 * rate * g_v / np.sqrt(past_v[active])
        return self


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def flattened(documents: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    lengths = [len(d) for d in documents]
    flat = np.fromiter((t for d in documents for t in d), np.int64, sum(lengths))
    return flat, np.repeat(np.arange(len(documents)), lengths)


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(toxic, text) of at most ``sample`` labelled documents outside the held-out fold."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(~in_fold(F.col("doc_id"), FOLDS, HELD))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # at most ``sample`` ids and labels
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(F.col("toxic").cast("int").alias("toxic"), "text")


def uneven_buckets(terms: DataFrame, toxic: int, clean: int, n: int = TERMS) -> np.ndarray:
    """The ``n`` buckets that divide toxic from clean documents best. ``terms`` has toxic and an array ``terms``."""
    counts = terms.select("toxic", F.explode("terms").alias("bucket")).groupBy("bucket").agg(
        F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n")
    )
    part = lambda seen, of, share: seen * F.log((seen + 0.5) / (of + 1) / share)
    share = (F.col("n") + 1) / (toxic + clean + 2)
    clean_seen = F.col("n") - F.col("t")
    gain = part(F.col("t"), toxic, share) + part(clean_seen, clean, share)
    # twice the gain is the G statistic; what is below LEAST_GAIN is mostly chance
    top = counts.where("n >= 3").where(gain >= LEAST_GAIN).orderBy(gain.desc(), "bucket").limit(n).select("bucket")
    return np.sort(np.array([r["bucket"] for r in top.collect()], np.int64))


def common_buckets(terms: DataFrame, total: int, n: int = FREQUENT) -> np.ndarray:
    """The ``n`` buckets whose rarer side, with or without, has most documents."""
    counts = terms.select(F.explode("terms").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    rarer = F.least("n", total - F.col("n"))
    top = counts.where(rarer >= 3).orderBy(rarer.desc(), "bucket").limit(n).select("bucket")
    return np.sort(np.array([r["bucket"] for r in top.collect()], np.int64))


def _g(cells: list[np.ndarray], of: np.ndarray) -> np.ndarray:
    """G statistic of documents divided into ``cells``, each with its (clean, toxic) counts along the first axis."""
    out = np.zeros(cells[0].shape[1:])
    for seen in cells:
        whole = np.maximum(seen.sum(0), 1)
        for n, share in zip(seen, of / of.sum(), strict=True):
            out += 2 * n * np.log(np.maximum(n, 1) / (whole * share))
    return out


def telling_pairs(documents: list[np.ndarray], labels: np.ndarray, terms: int, least: float = LEAST_JOINT, rows: int = 1024) -> np.ndarray:
    """Pairs of terms whose four cells (both, either, none) divide toxic from clean by ``least`` more than each on its own.

    Two terms that mean the same add nothing to each other; two that are neutral alone can tell all together.
    """
    both = np.zeros((2, terms, terms), np.float32)
    for at in range(0, len(documents), rows):
        flat, owner = flattened(documents[at : at + rows])
        held = np.zeros((min(rows, len(documents) - at), terms), np.float32)
        held[owner, flat] = 1
        for label in (0, 1):
            part = held[labels[at : at + rows] == label]
            both[label] += part.T @ part
    of = np.array([(labels == 0).sum(), (labels == 1).sum()], float)
    each = both.diagonal(axis1=1, axis2=2).astype(float)
    alone = _g([each, of[:, None] - each], of)
    pairs = [np.zeros((0, 2), np.int64)]
    for at in range(0, terms, 128):
        one, other, joint = each[:, at : at + 128, None], each[:, None, :], both[:, at : at + 128].astype(float)
        cells = [joint, one - joint, other - joint, of[:, None, None] - one - other + joint]
        more = _g(cells, of) - alone[at : at + 128, None] - alone[None, :]
        pairs.append(np.argwhere(more >= least) + [at, 0])
    found = np.concatenate(pairs)
    return found[found[:, 0] < found[:, 1]]


class Scorer:
    """A machine with the buckets it reads, or one share for all where there was nothing to tell apart."""

    def __init__(self, chosen: np.ndarray, machine: Machine | None, share: float):
        self.chosen, self.machine, self.share = chosen, machine, share
        self.terms: Terms | None = None

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.machine is None:
            return np.full(len(texts), self.share)
        self.terms = self.terms or Terms(self.chosen)
        return self.machine.scores([self.terms.of_text(t) for t in texts])


def placed(terms: DataFrame, chosen: np.ndarray) -> pd.DataFrame:
    """(toxic, places): the terms of each training document as positions in ``chosen``."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def places(terms: pd.Series) -> pd.Series:
        return pd.Series([np.flatnonzero(np.isin(chosen, t)).tolist() for t in terms])

    return terms.select("toxic", places("terms").alias("places")).toPandas()


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Scorer:
    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def all_terms(texts: pd.Series) -> pd.Series:
        terms = Terms()
        return pd.Series([terms.of_text(t) for t in texts])

    rows = training_rows(docs, labels, sample)
    seen = materialise(rows.select("toxic", all_terms("text").alias("terms")), "toxic-terms")
    total, toxic = seen.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).head()
    if not 0 < toxic < total:
        return Scorer(np.array([], np.int64), None, toxic / total if total else 0.0)
    common = common_buckets(seen, total)
    held = placed(seen, common)
    pairs = telling_pairs(held["places"].tolist(), held["toxic"].to_numpy(), len(common))
    chosen = np.union1d(uneven_buckets(seen, toxic, total - toxic), common[np.unique(pairs)])
    held = placed(seen, chosen)
    documents, marks = [list(p) for p in held["places"]], held["toxic"].to_numpy(float)
    # the same order on every run
    order = sorted(range(len(documents)), key=lambda i: (marks[i], documents[i]))
    machine = Machine(len(chosen)).fit([documents[i] for i in order], marks[order])
    return Scorer(chosen, machine, toxic / total)


def op9_fm_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    model = shared(spark, learn(docs, table(spark, sf_dir, "labels")))

    @F.pandas_udf(T.DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model().score(texts.tolist()))

    out = docs.select("doc_id", in_fold(F.col("doc_id"), FOLDS, HELD).alias("held_out"), score("text").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
