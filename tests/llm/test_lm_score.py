from __future__ import annotations

import math
import random

import numpy as np
from test_support import SCHEMA, empty_docs, key, odd_docs, odd_rows, words

from quire.llm import lm_score as L


def chain(seed, n):
    """Text in which a word says much about its neighbours."""
    rng = random.Random(seed)
    w = [rng.randrange(40)]
    for _ in range(n - 1):
        w.append((w[-1] * 7 + 3) % 40 if rng.random() < 0.9 else rng.randrange(40))
    return [f"w{x}" for x in w]


def test_context_is_learned(spark):
    texts = [chain(k, 300) for k in range(60)]
    rows = [(k, " ".join(t), "en", "a", 1) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(2)
    v = L.vocabulary(docs)
    net = L.train(spark, docs, v, rounds=60, share=1)
    fresh = []
    for k in range(5):
        t = chain(1000 + k, 300)
        s = list(t)
        random.Random(k).shuffle(s)
        fresh += [(2 * k, " ".join(t), "en", "a", 1), (2 * k + 1, " ".join(s), "en", "a", 1)]
    got = {r.doc_id: r.mean_log_prob for r in L.lm_scores(spark, spark.createDataFrame(fresh, SCHEMA), model=(v, net)).collect()}
    assert all(got[2 * k] > got[2 * k + 1] + 1 for k in range(5))
    assert got[0] > -math.log(40) + 1


def test_log_probabilities_sum_to_one():
    v = L.Vocabulary(np.arange(5, dtype=np.uint64), np.arange(5, dtype=np.int32), np.log(np.full(L.SIZE, 1 / L.SIZE)), np.zeros(L.SIZE))
    net = L.Network.fresh(v)
    context = np.tile(np.array([[1, 2, 3, L.SIZE + 1]], np.int32), (L.SIZE, 1))
    assert abs(np.exp(net.log_prob(context, np.arange(L.SIZE))).sum() - 1) < 1e-4


def test_scores_by_definition(spark):
    """Every word of some texts by the written formula, one position at a time."""
    texts = [chain(1, 40), chain(2, 9), ["w1"], []]
    docs = spark.createDataFrame([(k, " ".join(t), "en", "a", 1) for k, t in enumerate(texts)], SCHEMA)
    v = L.vocabulary(docs)
    net = L.Network.fresh(v)
    ids = [v.encode(L.Texts(L.pa.array([" ".join(t)])).names) for t in texts]
    got = {r.doc_id: r.log_prob for r in L.lm_scores(spark, docs, model=(v, net)).collect()}
    softmax = lambda z: np.exp(z - z.max()) / np.exp(z - z.max()).sum()
    for k, own in enumerate(ids):
        total = 0.0
        for i, y in enumerate(own):
            around = [own[i + d] if 0 <= i + d < len(own) else v.size + (d > 0) for d in L.SIDES]
            h = np.tanh(net.hidden + sum(net.embed[p][c] for p, c in enumerate(around)))
            g, inner = divmod(int(y), v.shape[1])
            total += math.log(softmax(h @ net.classes + net.class_bias)[g]) + math.log(softmax(h @ net.words[g] + net.word_bias[g])[inner])
        assert abs(got[k] - total) < 1e-3 * max(1, len(own))


def test_step_is_the_gradient():
    """One step moves each weight as the loss' difference quotient says."""
    rng = np.random.default_rng(5)
    v = L.Vocabulary(np.zeros(0, np.uint64), np.zeros(0, np.int32), np.log(np.full(L.SIZE, 1 / L.SIZE)), np.zeros(L.SIZE))
    net = L.Network.fresh(v)
    context, target = rng.integers(0, 50, (40, 4)), rng.integers(0, 120, 40)
    moved, past = L.Network(net.flat.copy()), np.zeros(L.Network.LENGTH, np.float32)
    moved.step(context, target, past)
    loss = lambda: -net.log_prob(context, target).astype(np.float64).mean()
    for at in [*np.flatnonzero(past > 1e-7)[:: max(1, int((past > 1e-7).sum()) // 25)]]:
        was = net.flat[at]
        net.flat[at] = was + 1e-2
        up = loss()
        net.flat[at] = was - 1e-2
        slope = (up - loss()) / 2e-2
        net.flat[at] = was
        assert abs(abs(slope) - math.sqrt(past[at])) < 2e-4 + 0.05 * abs(slope)
        assert (moved.flat[at] < was) == (slope > 0)


def test_gradient_step_by_differences():
    rng = np.random.default_rng(1)
    v = L.Vocabulary(np.zeros(0, np.uint64), np.zeros(0, np.int32), np.log(np.full(L.SIZE, 1 / L.SIZE)), np.zeros(L.SIZE))
    net = L.Network(L.Network.fresh(v).flat.astype(np.float64))
    context, target = rng.integers(0, 30, (64, 4)), rng.integers(0, 30, 64)
    before = net.log_prob(context, target).sum()
    for _ in range(5):
        net.step(context, target, past := np.full(L.Network.LENGTH, 1e-6))
    assert net.log_prob(context, target).sum() > before and past.max() > 0


def test_odd_rows(spark):
    got = L.lm_scores(spark, odd_docs(spark)).collect()
    assert sorted((key(r.doc_id), r.n_words) for r in got) == sorted((key(r[0]), len(words(r[1]))) for r in odd_rows())
    assert all(r.log_prob <= 0 and math.isfinite(r.log_prob) and (r.n_words or r.log_prob == 0) for r in got)
    alike = [r.log_prob for r in got if r.doc_id in (4, 5)]
    assert max(alike) - min(alike) < 1e-4 * abs(alike[0])  # products in float32 depend on the block
    assert L.lm_scores(spark, empty_docs(spark)).collect() == []


def test_bucket_words_have_their_own_share(spark, monkeypatch):
    """Words beyond those with ids get the bucket's probability by their counts,
    whether the counts are sent or joined; the shares of a bucket sum to one."""
    text = [f"f{k}" for k in range(2048)] * 30
    seen = {f"r{k}": 1 + 19 * (k % 2) for k in range(1200)}
    text += [w for w, n in seen.items() for _ in range(n)]
    rows = [(k, " ".join(text[k::50]), "en", "a", 1) for k in range(50)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    single = spark.createDataFrame([(k, f"r{k}", "en", "a", 1) for k in range(1200)], SCHEMA)
    names = L.Texts(L.pa.array([f"r{k}" for k in range(1200)])).names
    scores = []
    for head in (1 << 17, 2100):
        monkeypatch.setattr(L, "HEAD", head)
        v = L.vocabulary(docs)
        if head == 2100:
            v.head = v.head[:0]  # as if none of them were sent
            v.head_log = v.head_log[:0]
        got = L.lm_scores(spark, single, model=(v, L.Network.fresh(v))).collect()
        scores.append({r.doc_id: r.log_prob for r in got})
    assert all(abs(scores[0][k] - scores[1][k]) < 1e-6 for k in scores[0])
    ids, by_id = v.encode(names), {}
    for k, i in enumerate(ids):
        by_id.setdefault(i, []).append(k)
    mixed = 0
    for group in by_id.values():
        n = [seen[f"r{k}"] for k in group]
        for a in range(1, len(group)):
            assert abs(scores[0][group[a]] - scores[0][group[0]] - math.log(n[a] / n[0])) < 1e-4
            mixed += n[a] != n[0]
    assert mixed > 50


def test_vocabulary_grows_with_the_corpus(spark):
    rows = [(k, " ".join(f"g{w}" for w in range(3000)), "en", "a", 1) for k in range(400)]
    v = L.vocabulary(spark.createDataFrame(rows, SCHEMA).repartition(2))
    assert len(v.names) == 3000 and len(set(v.ids.tolist())) == 3000 and v.size > L.SIZE
    got = L.lm_scores(spark, spark.createDataFrame(rows[:2], SCHEMA), model=(v, L.Network.fresh(v))).collect()
    assert all(r.n_words == 3000 and abs(r.mean_log_prob + math.log(3000)) < 0.5 for r in got)


def test_rounds_train_on_every_position():
    t = L.Texts(L.pa.array([" ".join(chain(k, 7 + 31 * k)) for k in range(9)] + ["", "one"]))
    at = np.concatenate([L.turn(t, k, L.SHARE) for k in range(L.ROUNDS)])
    assert np.array_equal(np.unique(at), np.arange(len(t.names))) and len(at) == len(t.names) * L.ROUNDS // L.SHARE


def test_context_is_learned_by_default(spark):
    """The registered parameters, on 1,500 documents of 300 words."""
    rows = [(k, " ".join(chain(k, 300)), "en", "a", 1) for k in range(1500)]
    for k in range(5):
        t = chain(10000 + k, 300)
        s = list(t)
        random.Random(k).shuffle(s)
        rows += [(-2 * k - 1, " ".join(t), "en", "a", 1), (-2 * k - 2, " ".join(s), "en", "a", 1)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(2)
    got = {r.doc_id: r.mean_log_prob for r in L.lm_scores(spark, docs).collect()}
    gain = [got[-2 * k - 1] - got[-2 * k - 2] for k in range(5)]
    assert min(gain) > 1, gain
