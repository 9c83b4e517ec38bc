import math
import zlib
from collections import Counter

import pytest

from tests.llm.conftest import awkward_rows
from tillwise.llm import ngrams


def tokens(text):
    return [*(text or "").encode().lower().split(), b" "]


class Plain:
    """The model by dictionaries."""

    def __init__(self, texts, kappa):
        self.kappa, self.texts = kappa, len(texts)
        self.words = Counter(t for text in texts for t in tokens(text))
        self.pairs = Counter(p for text in texts for p in zip([None, *tokens(text)], tokens(text), strict=False))
        self.n, self.kinds = sum(self.words.values()), len(self.words)
        once, twice = (sum(c == k for c in self.words.values()) for k in (1, 2))
        self.d = min(max(once / max(once + 2 * twice, 1), 0.1), 0.9)

    def root(self, w):
        return (self.words[w] - self.d if self.words[w] else max(self.d * self.kinds, 1)) / max(self.n, 1)

    def after(self, h, w):
        context = self.texts if h is None else self.words[h]
        return (self.pairs[h, w] + self.kappa * self.root(w)) / (context + self.kappa)

    def score(self, text):
        return sum(math.log10(self.after(h, w)) for h, w in zip([None, *tokens(text)], tokens(text), strict=False))

    def base(self, text):
        return sum(math.log10((self.words[w] + 0.5) / (self.n + 0.5 * (self.kinds + 1))) for w in tokens(text))


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


@pytest.mark.parametrize("block, part", [(8 << 20, 2_000_000), (300, 40)])
def test_same_as_dictionaries(spark, awkward, monkeypatch, block, part):
    monkeypatch.setattr(ngrams, "BLOCK_BYTES", block)
    monkeypatch.setattr(ngrams, "PART_BYTES", part)
    rows = awkward_rows()
    plain = Plain([t for i, t, _, _ in rows if not held(i)], ngrams.KAPPA)
    got = sorted(ngrams.op4_backoff_scores(spark, awkward).collect(), key=lambda r: (str(r["doc_id"]), r["base_score"]))
    want = sorted(((i, t) for i, t, _, _ in rows), key=lambda r: (str(r[0]), plain.base(r[1])))
    assert len(got) == len(want)
    for r, (i, text) in zip(got, want, strict=True):
        known = sum(plain.words[w] > 0 for w in tokens(text))
        assert (r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"]) == (i, held(i), len(tokens(text)), known)
        assert r["train_tokens"] == plain.n
        assert r["base_score"] == pytest.approx(plain.base(text)) and r["score"] == pytest.approx(plain.score(text))


def test_probabilities_of_the_next_token_sum_to_one():
    plain = Plain([t for i, t, _, _ in awkward_rows() if not held(i)], ngrams.KAPPA)
    for h in (None, b"the", b"und", b"ipsum"):
        # the words of the model, and all others together
        total = sum(plain.after(h, w) for w in plain.words) + plain.after(h, b"never seen")
        # the last token of a text has no successor, so its context is not left
        assert total == pytest.approx(1, abs=1e-9)


def test_nothing_to_train_on(spark, write_tables):
    ids = [i for i in range(60) if held(i)]
    got = ngrams.op4_backoff_scores(spark, write_tables([(i, "a b", "en", "web") for i in ids])).collect()
    assert len(got) == len(ids) and {r["train_tokens"] for r in got} == {0} and {r["n_known"] for r in got} == {0}
    assert all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in got)
