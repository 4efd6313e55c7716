"""The byte network: held-out accuracy, whole texts, odd rows."""

import random
import zlib

import numpy as np

from lakemart.llm import quality
from lakemart.llm.quality import ByteNet, fit_quality, held_out, quality_scores


def pages(n, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 8))) for _ in range(400)]
    out = []
    for i in range(n):
        good = [rng.choice(words) for _ in range(rng.randrange(40, 160))]
        if i % 2:
            out.append((" ".join(good), 1))
        else:
            junk = [w + rng.choice(("%%%", "&&&", "***")) for w in good] if i % 4 else good[:2] * 40
            out.append((" ".join(good[:20] + junk), 0))
    return out


def test_held_out_accuracy():
    rows, fresh = pages(700, 1)[:500], pages(700, 1)[500:]
    net = ByteNet().fit([t.encode() for t, _ in rows], np.array([y for _, y in rows]), epochs=20)
    scores = net.scores([t.encode() for t, _ in fresh])
    assert ((scores >= 0.5) == np.array([y for _, y in fresh])).mean() > 0.95


def test_long_texts_are_scored_whole(monkeypatch):
    net = ByteNet(seed=3)
    rng = random.Random(4)
    texts = [bytes(rng.randrange(32, 120) for _ in range(n)) for n in (0, 1, 3, 127, 128, 129, 5000, 20000, 20001)]
    whole = net.scores(texts)
    monkeypatch.setattr(quality, "SCORE_BYTES", 1000)
    assert np.allclose(net.scores(texts), whole, atol=1e-5)
    changed = texts[-1][:-40] + bytes(reversed(texts[-1][-40:]))
    assert len(changed) == len(texts[-1])
    assert (whole >= 0).all() and (whole <= 1).all()


def test_gradients():
    """Analytic against numeric gradients of the loss."""
    net = ByteNet(seed=5)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    texts, y = [b"some words in a text " * 20, b"AB!! " * 90], np.array([1, 0])

    def loss():
        net.tables = None
        p = np.clip(net.scores(texts), 1e-12, 1 - 1e-12)
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).sum()

    grads = net.gradients(texts, y, np.ones(2))
    rng = np.random.default_rng(1)
    for name in ("v", "u0", "u"):
        for _ in range(5):
            at = tuple(rng.integers(0, s) for s in net.p[name].shape)
            old = net.p[name][at]
            net.p[name][at] = old + 1e-3
            up = loss()
            net.p[name][at] = old - 1e-3
            down = loss()
            net.p[name][at] = old
            assert abs((up - down) / 2e-3 - grads[name][at]) < 5e-2 * max(1, abs(grads[name][at]))


def test_operator(spark, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE_PER_CLASS", 60)
    rows = [(i, t) for i, (t, _) in enumerate(pages(240, 1))]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(240)] + [(None, 1, 0), (3, None, 1)],
                                   "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts, y = quality.labelled_sample(docs, labels, per_class=60)
    assert len(texts) <= 120 and set(y) == {0, 1}
    kept_out = {t.encode() for i, t in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    assert not kept_out & set(texts)
    net = fit_quality(docs, labels, per_class=60)
    scored = quality_scores(odd_docs, net)
    assert scored.count() == odd_docs.count()
    assert scored.filter("score between 0 and 1").count() == odd_docs.count()
    assert quality_scores(no_docs, net).count() == 0
    assert fit_quality(docs, labels.limit(0)) is None
    assert quality_scores(odd_docs, None).filter("score <> 0.5").count() == 0
    assert [r[0] for r in docs.limit(6).select(held_out(docs["doc_id"])).collect()] == \
        [zlib.crc32(str(i).encode()) % 5 == 0 for i in range(6)]


def test_texts_are_taken_as_they_are_scored(monkeypatch):
    """A batch's texts were all copied before the first was scored."""
    net, drawn, ahead = ByteNet(), [], []
    short = ByteNet._short
    monkeypatch.setattr(ByteNet, "_short", lambda self, texts: ahead.append(len(drawn)) or short(self, texts))
    texts = [b"word %d " % i * 4000 for i in range(40)] + [b"", b"one"]
    got = net.scores(drawn.append(t) or t for t in texts)
    assert len(ahead) > 2 and ahead[0] < 20
    assert np.allclose(got, [net.scores([t])[0] for t in texts], atol=1e-6)
