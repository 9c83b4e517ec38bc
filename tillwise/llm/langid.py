"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts of order 0 to ``order``. The statistics are counted over all
training texts in Spark and then frozen. The code length of a byte after a context of order k is that of
its count there, if it has been seen (method C: count over total plus distinct), else the length of an escape
plus the length after the next shorter context; below order 0 all byte classes are equally likely.

With frozen statistics the length depends on the last ``order`` bytes only. Each tree is kept as sorted arrays, for every
order the (context, byte) codes seen with their lengths and the contexts seen with their escapes. The distinct codes of a
stretch of text are looked up by binary search, longest context first, and the lengths summed in numpy. Bytes that no
training text holds are in no array, so every tree escapes on them alike.

Memory on the driver and in the tasks is in proportion to the contexts seen, 8 bytes for each and language and order.

Defined results: null, empty and letterless texts are ``und`` with score 0; a text in which two languages
need equally many bits gets the first of them by name; training skips null texts and null languages; with
nothing to learn from, every text is ``und``; extra columns pass unread.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm.text import in_fold, shared, small_batches, table

ORDER = 2
FOLDS, HELD = 5, 0
REJECT_BELOW = 0.5
_CHUNK = 1 << 18


def _codes(data: bytes, order: int) -> np.ndarray:
    """Each byte with the ``order`` bytes before it, as one number; a text begins after zero bytes."""
    raw = np.frombuffer(b"\0" * order + data, np.uint8).astype(np.int32 if order < 3 else np.int64)
    code = raw[: len(raw) - order].copy()
    for i in range(1, order + 1):
        code = (code << 8) | raw[i : len(raw) - order + i]
    return code


def _joined(texts: list[str | None], order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes of many texts at a time, and the text that each run of codes belongs to, as (owner, start) rows."""
    parts, owners, held = [], [], 0
    for i, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass")
        for at in range(0, len(data), _CHUNK):
            # a later piece of a long text begins with the bytes before it
            part = _codes(data[max(0, at - order) : at + _CHUNK], order)
            part = part[min(at, order) :]
            parts.append(part)
            owners.append(i)
            held += len(part)
            if held >= _CHUNK:
                yield _packed(parts, owners)
                parts, owners, held = [], [], 0
    if parts:
        yield _packed(parts, owners)


def _packed(parts: list[np.ndarray], owners: list[int]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(p) for p in parts])
    return np.concatenate(parts), np.stack([np.array(owners), np.concatenate([[0], np.cumsum(lengths)[:-1]])], axis=1)


def _piece_sums(frames: Iterator[pd.DataFrame], order: int) -> Iterator[pd.DataFrame]:
    """Partial counts per task, kept sparse between batches."""
    held: dict[str, pd.Series] = {}
    for frame in frames:
        for lang, texts in frame.groupby("lang")["text"]:
            for codes, _ in _joined(texts.tolist(), order):
                values, n = np.unique(codes, return_counts=True)
                more = pd.Series(n, index=values)
                held[lang] = held[lang].add(more, fill_value=0) if lang in held else more
    for lang, n in held.items():
        yield pd.DataFrame({"lang": lang, "code": n.index.to_numpy(np.int64), "n": n.to_numpy(np.int64)})


def count_contexts(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, code, n): how often each byte follows each context of ``order`` bytes. ``docs`` has text and lang."""
    known = docs.where("text is not null and lang is not null").select("lang", "text")
    counted = known.mapInPandas(lambda frames: _piece_sums(frames, order), "lang string, code long, n long")
    return counted.groupBy("lang", "code").agg(F.sum("n").alias("n"))


class Tree:
    """One language: for each order k, codes with their bits and contexts with the bits of an escape from them."""

    def __init__(self, code: np.ndarray, n: np.ndarray, order: int):
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        for k in range(order, -1, -1):
            seen, where = np.unique(code & ((1 << 8 * (k + 1)) - 1), return_inverse=True)
            times = np.bincount(where, n)
            context, first, owner = np.unique(seen >> 8, return_index=True, return_inverse=True)
            kinds = np.diff(np.append(first, len(seen)))
            whole = np.log2(np.bincount(owner, times) + kinds)
            escape, bits = whole - np.log2(kinds), whole[owner] - np.log2(times)
            kind = np.int32 if k < 3 else np.int64
            self.levels.append((seen.astype(kind), bits.astype(np.float32), context.astype(kind), escape.astype(np.float32)))

    def bits(self, codes: np.ndarray, none: float) -> np.ndarray:
        """Length of each code; ``none`` bits for a byte that no context has."""
        out, open_ = np.zeros(len(codes)), np.arange(len(codes))
        for k, (seen, bits, contexts, escapes) in zip(range(len(self.levels) - 1, -1, -1), self.levels, strict=True):
            short = (codes[open_] & ((1 << 8 * (k + 1)) - 1)).astype(seen.dtype)
            at, hit = _found(seen, short)
            out[open_[hit]] += bits[at[hit]]
            open_, short = open_[~hit], short[~hit]
            at, known = _found(contexts, short >> 8)
            out[open_[known]] += escapes[at[known]]
        out[open_] += none
        return out


def _found(values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each wanted value among sorted ones, and whether it is there."""
    at = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
    return at, values[at] == wanted


class Models:
    """A tree for each language, over the byte classes of all."""

    def __init__(self, counts: pd.DataFrame, order: int = ORDER):
        self.order = order
        code = counts["code"].to_numpy(np.int64)
        self.width = len({int(b) for i in range(order + 1) for b in np.unique(code >> (8 * i) & 255)}) + 1
        n = counts["n"].to_numpy(np.float64)
        groups = counts.groupby("lang", sort=True).indices
        self.langs = sorted(groups)
        self.trees = [Tree(code[groups[lang]], n[groups[lang]], order) for lang in self.langs]

    def bits(self, codes: np.ndarray) -> np.ndarray:
        """Length of each code (rows) in every language (columns)."""
        none = float(np.log2(self.width))
        return np.stack([tree.bits(codes, none) for tree in self.trees], axis=1)

    def total_bits(self, texts: list[str | None]) -> np.ndarray:
        """Code length of every whole text (rows) in every language (columns)."""
        out = np.zeros((len(texts), len(self.langs)))
        for codes, runs in _joined(texts, self.order):
            distinct, where = np.unique(codes, return_inverse=True)
            lengths = np.take(self.bits(distinct), where, axis=0)
            np.add.at(out, runs[:, 0], np.add.reduceat(lengths, runs[:, 1], axis=0))
        return out

    def predict(self, texts: list[str | None], lettered: list[bool]) -> pd.DataFrame:
        """Language and its posterior under equal priors."""
        if not self.langs:
            return pd.DataFrame({"lang_pred": ["und"] * len(texts), "score": 0.0})
        bits = self.total_bits([t if ok else None for t, ok in zip(texts, lettered, strict=True)])
        best = bits.argmin(axis=1)
        ahead = np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000))
        known = np.array(lettered, bool)
        return pd.DataFrame({
            "lang_pred": np.where(known, np.array(self.langs, object)[best], "und"),
            "score": np.where(known, 1 / ahead.sum(axis=1), 0.0),
        })


def learn(docs: DataFrame, order: int = ORDER) -> Models:
    """Models from all training rows; the driver receives the summed counts, one for each language and code seen."""
    small_batches(docs.sparkSession)
    training = docs.where(~in_fold(F.col("doc_id"), FOLDS, HELD)).select("text", "lang")
    return Models(count_contexts(training, order).toPandas(), order)


def predicted(models: Models, text: Column) -> Column:
    """struct(lang_pred, score) of a text column."""
    model = shared(SparkSession.active(), models)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series, lettered: pd.Series) -> pd.DataFrame:
        return model().predict(texts.tolist(), lettered.tolist())

    return predict(text, F.coalesce(text.rlike(r"\p{L}"), F.lit(False)))


def op8_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents")
    out = docs.select("doc_id", predicted(learn(docs), F.col("text")).alias("p"))
    return out.select("doc_id", in_fold(F.col("doc_id"), FOLDS, HELD).alias("held_out"), "p.lang_pred", "p.score")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents without a letter go, and those whose language stays uncertain."""
    judged = docs.withColumn("__lang", predicted(learn(docs), F.col("text")))
    sure = (F.col("__lang.lang_pred") != "und") & (F.col("__lang.score") >= REJECT_BELOW)
    return judged.where(sure).select(*docs.columns)
