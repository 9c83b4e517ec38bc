"""Language-model scores from a weighted backoff automaton.

States are the words of the model (and the beginning of a text); an arc leads from state h by word w to state
w and weighs log10 P(w | h) for every bigram that training has seen. Every state has a failure arc to the root,
whose arcs weigh log10 P(w):

    P(w | h) = (c(h w) + kappa P(w)) / (c(h) + kappa)           seen: the arc
             = kappa / (c(h) + kappa) * P(w)                    else: failure arc, then the root's arc
    P(w)     = (c(w) - d) / N,  and d V / N for unknown words   d = n1 / (n1 + 2 n2)

The model grows with the corpus, so no task holds all of it:

1. Documents are packed into blocks (a few MB of text): local word numbers, the words' 64-bit hashes, the
   sequence. Blocks are written once.
2. Each block sends the hashes of its distinct words and bigrams, with its own training counts, to the parts
   that own those hashes. A key comes once per block however often it occurs, so a word that is a third of
   all tokens is one number per block.
3. Parts add up and answer each block in the order it asked, without the keys.
4. Each block builds the automaton of its own arcs and reads each text from left to right once.

Defined results: a null or blank text is one end token; rows that repeat an id are scored each; a null
id belongs to training; with nothing to train on every score and base_score is that of unknown words; an empty table gives
an empty table; extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm.text import in_fold, lowered, small_batches, table, token_pieces
from tillwise.sources.scratch import materialise

FOLDS, HELD = 5, 1
KAPPA = 400.0
BLOCK_BYTES = 8 << 20
PART_BYTES = 2_000_000  # of packed sequences, about a million keys
_END = b" "  # no word holds a blank
_BEGIN = np.uint64(0x9E3779B97F4A7C15)

_BLOCK = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("doc_ids", T.ArrayType(T.StringType())),
    T.StructField("texts", T.LongType()), T.StructField("held", T.BinaryType()), T.StructField("lengths", T.BinaryType()),
    T.StructField("vocabulary", T.BinaryType()), T.StructField("sequence", T.BinaryType()),
])
_ASKED = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("block", T.LongType()), T.StructField("keys", T.BinaryType()),
    T.StructField("counts", T.BinaryType()), T.StructField("pairs", T.IntegerType()),
])
_ANSWER = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("pairs", T.IntegerType()),
    T.StructField("totals", T.BinaryType()), T.StructField("tokens", T.LongType()), T.StructField("kinds", T.LongType()),
    T.StructField("once", T.LongType()), T.StructField("twice", T.LongType()),
])
_SCORED = T.StructType([
    T.StructField("doc_id", T.StringType()), T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("n_known", T.LongType()), T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType()),
])


def _pack(x: np.ndarray, kind: str) -> bytes:
    return zlib.compress(x.astype(kind).tobytes(), 1)


def _unpack(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), kind)


class _Numbers(dict):
    """A number for each new word."""

    def __missing__(self, word: bytes) -> int:
        got = self[word] = len(self)
        return got


def blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks of whole documents; a very long one is a block of its own."""
    task, made = TaskContext.get().partitionId(), 0
    numbers, ids, held, lengths, sequence, size = _Numbers(), [], [], [], [], 0

    def packed() -> pd.DataFrame:
        vocabulary = np.fromiter((xxhash.xxh64_intdigest(w) for w in numbers), np.uint64, len(numbers))
        return pd.DataFrame([{
            "block": (task << 24) + made, "doc_ids": ids, "texts": held.count(False), "held": np.array(held, np.uint8).tobytes(),
            "lengths": np.array(lengths, "<i4").tobytes(), "vocabulary": vocabulary.astype("<u8").tobytes(),
            "sequence": _pack(np.concatenate(sequence), "<i4"),
        }])

    for frame in frames:
        for doc_id, out, text in zip(frame["doc_id"], frame["held"], frame["text"], strict=True):
            data, n = lowered(text), 1
            for words in token_pieces(data):
                sequence.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
                n += len(words)
            sequence.append(np.array([numbers[_END]], np.int32))
            ids.append(doc_id)
            held.append(bool(out))
            lengths.append(n)
            size += len(data) + 1
            if size >= BLOCK_BYTES:
                yield packed()
                made += 1
                numbers, ids, held, lengths, sequence, size = _Numbers(), [], [], [], [], 0
    if ids:
        yield packed()


class Block:
    """A block's words and bigrams, each sorted by key."""

    def __init__(self, row):
        self.held = np.frombuffer(row.held, np.uint8).astype(bool)
        self.lengths = np.frombuffer(row.lengths, "<i4")
        self.words = np.frombuffer(row.vocabulary, "<u8")
        self.sequence = _unpack(row.sequence, "<i4").astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]]).astype(np.int64)
        training = np.repeat(~self.held, self.lengths)
        before = np.empty_like(self.sequence)
        before[1:] = self.sequence[:-1]
        before[self.starts] = len(self.words)  # the state at the beginning
        self.width = len(self.words) + 1
        pairs, self.pair_of = np.unique(before * self.width + self.sequence, return_inverse=True)
        states = np.append(self.words, _BEGIN)
        keys = states[pairs // self.width] * np.uint64(0xC2B2AE3D27D4EB4F) + self.words[pairs % self.width]
        keys = (keys ^ (keys >> np.uint64(31))) * np.uint64(0xFF51AFD7ED558CCD)
        keys ^= keys >> np.uint64(33)
        self.pairs = pairs
        self.word_order, self.pair_order = np.argsort(self.words, kind="stable"), np.argsort(keys, kind="stable")
        self.word_keys, self.pair_keys = self.words[self.word_order], keys[self.pair_order]
        word_counts = np.bincount(self.sequence, training, len(self.words))
        pair_counts = np.bincount(self.pair_of, training, len(pairs))
        self.word_counts, self.pair_counts = word_counts[self.word_order], pair_counts[self.pair_order]


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def asked(frames: Iterator[pd.DataFrame], parts: int) -> Iterator[pd.DataFrame]:
    """The keys of each block by the part that owns them, ascending."""
    for frame in frames:
        for row in frame.itertuples():
            block, out = Block(row), []
            for kind, keys, counts in ((0, block.word_keys, block.word_counts), (1, block.pair_keys, block.pair_counts)):
                cuts = np.searchsorted(_part(keys, parts), np.arange(parts + 1))
                for p in range(parts):
                    if cuts[p] < cuts[p + 1]:
                        own = slice(cuts[p], cuts[p + 1])
                        out.append((p, row.block, keys[own].astype("<u8").tobytes(), _pack(counts[own], "<u4"), kind))
            yield pd.DataFrame(out, columns=["part", "block", "keys", "counts", "pairs"])


def answered(group: pd.DataFrame) -> pd.DataFrame:
    """Totals for each block, in the order it asked, and this part's share of the vocabulary's statistics."""
    keys = [np.frombuffer(k, "<u8") for k in group["keys"]]
    cuts = np.cumsum([len(k) for k in keys])[:-1]
    _, where = np.unique(np.concatenate(keys), return_inverse=True)
    counts = np.concatenate([_unpack(c, "<u4") for c in group["counts"]])
    sums = np.bincount(where, counts)
    answers = np.split(sums[where], cuts)
    out = pd.DataFrame({
        "block": group["block"], "part": group["part"], "pairs": group["pairs"], "totals": [_pack(a, "<u8") for a in answers],
        "tokens": 0, "kinds": 0, "once": 0, "twice": 0,
    })
    if not group["pairs"].iloc[0]:
        seen = [int(sums.sum()), int((sums > 0).sum()), int((sums == 1).sum()), int((sums == 2).sum())]
        for name, value in zip(("tokens", "kinds", "once", "twice"), seen, strict=True):
            out[name] = [value] + [0] * (len(out) - 1)
    return out


class Automaton:
    """Arcs of one block: ``arcs[state * width + word]``, ``fail[state]``, ``root[word]``; a word is its own state."""

    def __init__(self, width: int, arcs: dict[int, float], fail: list[float], root: list[float]):
        self.width, self.arcs, self.fail, self.root = width, arcs, fail, root

    def score(self, words: list[int]) -> float:
        """log10 probability of one text: a single pass that carries the state."""
        total, state = 0.0, self.width - 1
        follow, width, fail, root = self.arcs.get, self.width, self.fail, self.root
        for word in words:
            weight = follow(state * width + word)
            total += fail[state] + root[word] if weight is None else weight
            state = word
        return total


def scored(row, answers: list, stats: dict, kappa: float = KAPPA) -> pd.DataFrame:
    """Scores of the documents of one block."""
    block = Block(row)
    in_order = lambda kind: [_unpack(a["totals"], "<u8") for a in sorted(answers, key=lambda a: a["part"]) if a["pairs"] == kind]
    words, pairs = np.zeros(len(block.words)), np.zeros(len(block.pairs))
    words[block.word_order] = np.concatenate(in_order(0))
    pairs[block.pair_order] = np.concatenate(in_order(1))
    n, kinds = stats["tokens"], stats["kinds"]
    base = np.log10((words + 0.5) / (n + 0.5 * (kinds + 1)))
    discount = stats["once"] / max(stats["once"] + 2 * stats["twice"], 1)
    discount = min(max(discount, 0.1), 0.9)
    root = np.where(words > 0, words - discount, max(discount * kinds, 1)) / max(n, 1)
    states = np.append(words, stats["texts"])
    seen = pairs > 0
    head, tail = block.pairs[seen] // block.width, block.pairs[seen] % block.width
    weights = np.log10((pairs[seen] + kappa * root[tail]) / (states[head] + kappa))
    arcs = dict(zip(block.pairs[seen].tolist(), weights.tolist(), strict=True))
    fail = np.log10(kappa / (states + kappa)).tolist()
    machine = Automaton(block.width, arcs, fail, np.log10(root).tolist())
    texts = np.split(block.sequence, block.starts[1:])
    return pd.DataFrame({
        "doc_id": row.doc_ids, "held_out": block.held, "n_tokens": block.lengths.astype(np.int64),
        "n_known": np.add.reduceat((words > 0)[block.sequence].astype(np.int64), block.starts),
        "base_score": np.add.reduceat(base[block.sequence], block.starts),
        "score": [machine.score(t.tolist()) for t in texts],
    })


def scores(docs: DataFrame, kappa: float = KAPPA) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs``."""
    small_batches(docs.sparkSession)
    held = in_fold(F.col("doc_id"), FOLDS, HELD)
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), held.alias("held"), "text")
    packed = materialise(rows.mapInPandas(blocks, _BLOCK), "lm-blocks")
    size, texts = packed.agg(
        F.coalesce(F.sum(F.octet_length("sequence")), F.lit(0)), F.coalesce(F.sum("texts"), F.lit(0))
    ).head()
    parts = int(size // PART_BYTES) + 1
    keys = packed.mapInPandas(lambda frames: asked(frames, parts), _ASKED)
    totals = materialise(keys.groupBy("pairs", "part").applyInPandas(answered, _ANSWER), "lm-totals")
    names = ["tokens", "kinds", "once", "twice"]
    stats = totals.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]).head().asDict()
    stats["texts"] = int(texts)

    def finish(_key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        answers = right[["part", "pairs", "totals"]].to_dict("records")
        return pd.concat([scored(row, answers, stats, kappa) for row in left.itertuples()])

    both = packed.groupBy("block").cogroup(totals.select("block", "part", "pairs", "totals").groupBy("block"))
    out = both.applyInPandas(finish, _SCORED)
    return out.select(
        F.col("doc_id").cast("long").alias("doc_id"), "held_out", "n_tokens", "n_known",
        F.lit(stats["tokens"]).cast("long").alias("train_tokens"), "base_score", "score",
    )


def op4_backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model score of every document."""
    return scores(table(spark, sf_dir, "documents"))
