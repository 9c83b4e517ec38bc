import itertools
import zlib

import numpy as np
import pytest

from tillwise.llm import toxicity


def test_score_is_the_sum_over_pairs():
    machine = toxicity.Machine(6, rank=3, seed=1)
    machine.factors = np.random.default_rng(2).normal(0, 1, (6, 3))
    machine.weights, machine.bias = np.arange(6) / 10, -0.4
    for document in ([], [2], [0, 3, 5], [0, 1, 2, 3, 4, 5]):
        raw = -0.4 + sum(machine.weights[i] for i in document)
        raw += sum(machine.factors[i] @ machine.factors[j] for i, j in itertools.combinations(document, 2))
        assert machine.scores([document])[0] == pytest.approx(1 / (1 + np.exp(-raw)))


def test_learns_a_pair_that_no_weight_can():
    # toxic exactly if both terms are there or neither is
    documents = [[], [0], [1], [0, 1]] * 100
    labels = np.array([1.0, 0.0, 0.0, 1.0] * 100)
    machine = toxicity.Machine(2).fit(documents, labels)
    assert machine.scores([[0, 1], []]).min() > 0.7 and machine.scores([[0], [1]]).max() < 0.3


def test_documents_without_terms_get_the_share():
    machine = toxicity.Machine(0).fit([[]] * 40, np.array([1.0] + [0.0] * 3).repeat(10))
    assert machine.scores([[], []]) == pytest.approx(0.25, abs=0.02)


def test_terms_of_a_text():
    terms = toxicity.Terms()
    assert terms.of_text(None) == terms.of_text("") == terms.of_text("!! ..") == []
    assert terms.of_text("Trash, trash") == terms.of_text("TRASH!")
    assert set(terms.of_text("house")) < set(terms.of_text("house houses"))
    # several words that begin alike are more than one
    assert len(terms.of_text("household houses")) > len(set(terms.of_text("household")) | set(terms.of_text("houses")))
    chosen = np.array(sorted(terms.of_text("trash")))
    assert toxicity.Terms(chosen).of_text("the trash") == list(range(len(chosen)))


def marked(n=600):
    rng = np.random.default_rng(3)
    words = [f"w{i:03d}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        text = [words[j] for j in rng.integers(0, 300, 40)]
        bad = i % 6 == 0
        if bad:
            text[5:5] = [f"vile{rng.integers(0, 50)}", "you"]
        rows.append((i, " ".join(text), "en", "web"))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_held_out_accuracy(spark, write_tables):
    rows, labels = marked()
    got = toxicity.op9_fm_toxicity(spark, write_tables(rows, labels=labels)).toPandas()
    held = got[got["held_out"]]
    assert set(held["doc_id"]) == {i for i in range(600) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert (held["predicted"] == (held["doc_id"] % 6 == 0)).mean() > 0.97
    assert ((held["score"] >= 0.3) == (held["predicted"] == 1)).all() and held["score"].between(0, 1).all()


def test_a_pair_of_neutral_terms_is_learned(spark, write_tables):
    # toxic exactly if both words are there or neither is, so each word alone tells nothing
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(1600):
        text = [f"w{j:03d}" for j in rng.integers(0, 200, 25)]
        one, other = (rng.random(2) < 0.5).tolist()
        text += ["amber"] * one + ["birch"] * other
        rows.append((i, " ".join(text), "en", "web"))
        labels.append((i, 1, int(one == other)))
    got = toxicity.op9_fm_toxicity(spark, write_tables(rows, labels=labels)).where("held_out").toPandas()
    truth = got["doc_id"].map({i: t for i, _, t in labels})
    bad, good = got["score"][truth == 1].to_numpy(), got["score"][truth == 0].to_numpy()
    assert (bad[:, None] > good[None, :]).mean() > 0.97


def test_telling_pairs_are_those_of_brute_force():
    rng = np.random.default_rng(6)
    held = rng.random((400, 140)) < 0.4
    held[:, 7] = held[:, 3]
    labels = (held[:, 2] ^ held[:, 130]).astype(int)
    labels[:40] = rng.integers(0, 2, 40)

    def g(*columns):
        cells = np.array([sum(c[d] << k for k, c in enumerate(columns)) for d in range(len(labels))])
        n = [[((cells == c) & (labels == t)).sum() for t in (0, 1)] for c in np.unique(cells)]
        share = np.bincount(labels) / len(labels)
        return 2 * sum(x * np.log(x / (sum(row) * share[t])) for row in n for t, x in enumerate(row) if x)

    bits = held.astype(int)
    alone = [g(bits[:, i]) for i in range(140)]
    some = [(2, 130), (3, 7), (0, 1), (129, 139)]
    want = {p for p in some if g(bits[:, p[0]], bits[:, p[1]]) - alone[p[0]] - alone[p[1]] >= 5}
    documents = [np.flatnonzero(row) for row in held]
    found = {tuple(p) for p in toxicity.telling_pairs(documents, labels, 140, least=5, rows=64).tolist()}
    assert found & set(some) == want and (2, 130) in want
    assert toxicity.telling_pairs(documents, labels, 140).tolist() == [[2, 130]]
    assert toxicity.telling_pairs([np.array([], int)] * 3, np.array([0, 1, 0]), 0).tolist() == []


def test_held_out_labels_are_not_read(spark, write_tables):
    rows, labels = marked(200)
    other = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels]
    one, two = (toxicity.op9_fm_toxicity(spark, write_tables(rows, labels=x)).collect() for x in (labels, other))
    assert sorted(one) == sorted(two)


@pytest.mark.parametrize("labels", [(), [(1, 1, 0), (2, 1, 0)], [(1, 1, 1), (4, 0, 1)]])
def test_labels_of_one_kind(spark, write_tables, labels):
    path = write_tables([(i, "a b c", "en", "web") for i in range(6)], labels=labels)
    scores = {r["score"] for r in toxicity.op9_fm_toxicity(spark, path).collect()}
    assert scores == {float(bool(labels) and labels[0][2])}
