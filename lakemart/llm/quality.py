"""Quality classifier: a byte-level convolutional network in numpy.

Filters over four bytes run over the whole document. Their activations are
max-pooled in overlapping chunks of 256 bytes (step 128), a hidden layer looks
at each chunk's pooled vector and its fill, and the hidden units are max-pooled
over the chunks and combined into one probability: junk in any chunk shows.

Training is plain back-propagation (Adam) on the driver over a bounded sample
of labelled rows; scoring runs in the tasks, over every byte of every text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.llm.common import text_or_empty, use_package_on_workers

WIDTH = 4          # bytes under one filter
FILTERS = 24
HIDDEN = 12
STEP = 128         # a chunk is two neighbouring blocks of this many positions
EPOCHS = 8
SEED = 7
#: Labelled rows of each class used for fitting, at most (the documented bound
#: of the sample; the rows with the smallest id hashes are taken).
SAMPLE_PER_CLASS = 800
#: Bytes of texts in the sample, at most: longer texts give way to shorter ones.
SAMPLE_TEXT_BYTES = 1 << 14
#: Bytes convolved at once while scoring.
SCORE_BYTES = 1 << 18

_OUT = np.float32(-1e9)


class ByteNet:
    """Parameters: ``w`` (WIDTH, 256, FILTERS), ``u`` (FILTERS + 1, HIDDEN) with
    the chunk's fill as last input, ``u0``, ``v``, ``v0``."""

    def __init__(self, parameters: dict[str, np.ndarray] | None = None, seed: int = SEED):
        if parameters is None:
            rng = np.random.default_rng(seed)
            parameters = {
                "w": rng.normal(0, 0.5, (WIDTH, 256, FILTERS)),
                "u": rng.normal(0, 0.2, (FILTERS + 1, HIDDEN)),
                "u0": np.full(HIDDEN, 0.1), "v": rng.normal(0, 0.2, HIDDEN), "v0": np.zeros(1)}
        self.p = {k: np.asarray(x, np.float32) for k, x in parameters.items()}
        self.tables: list[np.ndarray] | None = None

    # -- forward --------------------------------------------------------------

    def lay_out(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All texts in one byte array, each followed by WIDTH - 1 zero bytes (an
        empty text by one more), their starts and position counts."""
        sizes = np.array([max(len(t), 1) for t in texts], np.int64)
        starts = np.concatenate(([0], np.cumsum(sizes + WIDTH - 1)))
        pad = bytes(WIDTH - 1)
        data = b"".join([x for t in texts for x in (t or b"\0", pad)])
        return np.frombuffer(data, np.uint8), starts, sizes

    def activations(self, data: np.ndarray) -> np.ndarray:
        """(positions, FILTERS): byte pairs look up the sum of two taps."""
        if self.tables is None:
            w = self.p["w"]
            self.tables = [(w[k][:, None, :] + w[k + 1][None, :, :]).reshape(1 << 16, FILTERS)
                           for k in range(0, WIDTH, 2)]
        pair = (data[:-1].astype(np.int32) << 8) | data[1:]
        n = len(data) - WIDTH + 1
        out = self.tables[0].take(pair[:n], axis=0)
        for k, t in enumerate(self.tables[1:], 1):
            out += t.take(pair[2 * k:2 * k + n], axis=0)
        return out

    def blocks(self, texts: list[bytes]):
        """Pooled blocks (FILTERS), their number per text, and their fill."""
        data, starts, sizes = self.lay_out(texts)
        act = self.activations(np.concatenate((data, np.zeros(WIDTH - 1, np.uint8))))
        ends = starts[:-1] + sizes
        for k in range(WIDTH - 1):
            act[ends + k] = _OUT                    # windows that reach into the next text
        counts = -(-sizes // STEP)
        first = np.repeat(np.cumsum(counts) - counts, counts)
        nth = np.arange(counts.sum()) - first
        at = np.repeat(starts[:-1], counts) + nth * STEP
        pooled = np.maximum.reduceat(act, at, axis=0)
        fill = np.minimum(np.repeat([len(t) for t in texts], counts) - nth * STEP, STEP) / STEP
        return pooled, counts, fill.astype(np.float32), at, act

    def chunks(self, pooled: np.ndarray, counts: np.ndarray, fill: np.ndarray) -> np.ndarray:
        """(blocks, FILTERS + 1): a block pooled with the next one of its text."""
        last = np.cumsum(counts) - 1
        nxt, more = np.roll(pooled, -1, axis=0), np.roll(fill, -1)
        nxt[last], more[last] = _OUT, 0
        return np.concatenate((np.maximum(pooled, nxt), ((fill + more) / 2)[:, None]), axis=1)

    def scores(self, texts: Iterable[bytes]) -> np.ndarray:
        """Probabilities of label 1. Texts are taken as they are needed; those
        longer than SCORE_BYTES are pooled part by part, so memory doesn't grow
        with a text or their number."""
        out: dict[int, float] = {}
        group: dict[int, bytes] = {}
        size = 0

        def score_group() -> None:
            out.update(zip(group, self._short(list(group.values())).tolist(), strict=True))
            group.clear()

        for i, t in enumerate(texts):
            if len(t) > SCORE_BYTES:
                out[i] = float(self.combine(self._long(t))[0])
                continue
            group[i] = t
            size += len(t)
            if size >= SCORE_BYTES:
                score_group()
                size = 0
        if group:
            score_group()
        return np.array([out[i] for i in range(len(out))], np.float64)

    def hidden(self, chunk: np.ndarray) -> np.ndarray:
        return np.maximum(chunk @ self.p["u"] + self.p["u0"], 0)

    def combine(self, pooled_hidden: np.ndarray) -> np.ndarray:
        logit = np.atleast_2d(pooled_hidden) @ self.p["v"] + self.p["v0"]
        return 1 / (1 + np.exp(-np.clip(logit.astype(np.float64), -30, 30)))

    def _short(self, texts: list[bytes]) -> np.ndarray:
        pooled, counts, fill, _, _ = self.blocks(texts)
        z = self.hidden(self.chunks(pooled, counts, fill))
        return self.combine(np.maximum.reduceat(z, np.cumsum(counts) - counts, axis=0))

    def _long(self, text: bytes) -> np.ndarray:
        """Hidden maximum over a long text, in parts that share a block: the
        bytes after a part's last block are there for its windows."""
        best = np.zeros(HIDDEN, np.float32)
        part = SCORE_BYTES // STEP * STEP
        for a in range(0, len(text), part - STEP):
            piece = text[a:a + part + WIDTH - 1]
            pooled, counts, fill, _, _ = self.blocks([piece])
            keep = min(-(-(len(text) - a) // STEP), part // STEP)
            z = self.hidden(self.chunks(pooled[:keep], np.array([keep]), fill[:keep]))
            if a + part < len(text):
                z = z[:-1]                          # its second block is the next part's first
            best = np.maximum(best, z.max(axis=0, initial=0))
        return best

    # -- training -------------------------------------------------------------

    def gradients(self, texts: list[bytes], labels: np.ndarray, weight: np.ndarray):
        p = self.p
        pooled, counts, fill, at, act = self.blocks(texts)
        data = self.lay_out(texts)[0]
        chunk = self.chunks(pooled, counts, fill)
        z = self.hidden(chunk)
        g = {k: np.zeros_like(x) for k, x in p.items()}
        first = np.cumsum(counts) - counts
        for i, (a, n) in enumerate(zip(first, counts, strict=True)):
            zi = z[a:a + n]
            which = zi.argmax(axis=0)
            top = zi[which, np.arange(HIDDEN)]
            delta = (float(self.combine(top)[0]) - labels[i]) * weight[i]
            g["v"] += delta * top
            g["v0"] += delta
            live = np.flatnonzero(top > 0)
            back = delta * p["v"][live]
            g["u0"][live] += back
            picked = chunk[a + which[live]]
            g["u"][:, live] += picked.T * back
            down = (p["u"][:-1, live] * back).T     # per live unit: gradient of its chunk's maxima
            for c in np.unique(which[live]):
                grad = down[which[live] == c].sum(axis=0)
                lo = at[a + c]
                hi = at[a + c + 1] + STEP if c + 1 < n else lo + STEP
                peak = lo + act[lo:hi].argmax(axis=0)
                for k in range(WIDTH):
                    np.add.at(g["w"][k], (data[np.minimum(peak + k, len(data) - 1)],
                                          np.arange(FILTERS)), grad)
        return g

    def fit(self, texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS,
            rate: float = 0.01, batch: int = 24, seed: int = SEED) -> ByteNet:
        """Adam over shuffled batches; classes weigh by their share so that the
        score stays a probability for rows drawn evenly from both."""
        rng = np.random.default_rng(seed)
        share = np.bincount(labels, minlength=2) / len(labels)
        weight = 0.5 / np.maximum(share, 1e-9)[labels]
        m = {k: np.zeros_like(x) for k, x in self.p.items()}
        s = {k: np.zeros_like(x) for k, x in self.p.items()}
        steps, total = 0, epochs * -(-len(texts) // batch)
        for _ in range(epochs):
            order = rng.permutation(len(texts))
            for a in range(0, len(order), batch):
                pick = order[a:a + batch]
                self.tables = None
                g = self.gradients([texts[i] for i in pick], labels[pick], weight[pick] / len(pick))
                steps += 1
                step = rate * (1 - 0.9 * steps / total)
                for k, x in self.p.items():
                    m[k] += 0.1 * (g[k] - m[k])
                    s[k] += 0.001 * (g[k] * g[k] - s[k])
                    x -= step * (m[k] / (1 - 0.9 ** steps)) / (np.sqrt(s[k] / (1 - 0.999 ** steps)) + 1e-8)
        self.tables = None
        return self


def held_out(id_col):
    """Whether the row is kept out of learning: crc32 of the id as text mod 5
    is 0 (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def labelled_sample(documents: DataFrame, labels: DataFrame, *, id_col: str = "doc_id",
                    text_col: str = "text", label_col: str = "quality",
                    per_class: int = SAMPLE_PER_CLASS) -> tuple[list[bytes], np.ndarray]:
    """At most ``2 * per_class`` labelled texts outside the held-out fifth, each
    at most ``SAMPLE_TEXT_BYTES`` long: the bounded sample for fitting."""
    own = labels.select(labels[id_col].alias("id"), labels[label_col].cast("int").alias("label")) \
        .filter("label in (0, 1)").filter(~held_out(F.col("id")))
    rows = documents.select(documents[id_col].alias("id"), text_or_empty(text_col).alias("text")) \
        .filter(F.octet_length("text") <= SAMPLE_TEXT_BYTES).withColumn("of", F.xxhash64("text"))
    # ids and digests first: the joins and sorts move a few bytes a row, and
    # the texts of the chosen rows, a bounded number, are fetched afterwards
    light = rows.select("id", "of").join(own, "id")
    draw = [F.xxhash64("id"), F.col("id"), F.col("of")]
    chosen = light.filter("label = 1").orderBy(*draw).limit(per_class).unionAll(
        light.filter("label = 0").orderBy(*draw).limit(per_class)).distinct()
    found = rows.join(F.broadcast(chosen), ["id", "of"]).select("id", "text", "label").distinct().collect()
    found = sorted(found, key=lambda r: (r["id"], r["text"], r["label"]))
    return [r["text"].encode() for r in found], np.array([r["label"] for r in found], np.int64)


def fit_quality(documents: DataFrame, labels: DataFrame, **options) -> ByteNet | None:
    """The fitted network, or None when no row outside the held-out fifth is
    labelled."""
    texts, y = labelled_sample(documents, labels, **options)
    return ByteNet().fit(texts, y) if texts else None


def quality_scores(df: DataFrame, net: ByteNet | None, *, text_col: str = "text") -> DataFrame:
    """Rows ``(row struct, score double)``: every row of ``df`` as a struct and
    the probability that its text has label 1, from all bytes of the text.

    Null texts count as empty, which the network scores as any other text;
    columns of ``df`` stay inside ``row`` and cannot clash; without a network
    (no labels to learn from) every score is 0.5; an empty table gives an empty
    result.
    """
    spark = df.sparkSession
    use_package_on_workers(spark)
    rows = df.select(F.struct(*[df[c] for c in df.columns]).alias("row"))
    if net is None:
        return rows.withColumn("score", F.lit(0.5))
    shared = spark.sparkContext.broadcast(net.p)

    # an Arrow function over the text alone: the other columns stay in the JVM
    @F.arrow_udf(T.DoubleType())
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = ByteNet(shared.value)
        for texts in batches:
            yield pa.array(own.scores(t.as_py().encode() for t in texts), pa.float64())

    text = F.coalesce(F.col(f"row.`{text_col}`").cast("string"), F.lit(""))
    return rows.withColumn("score", score(text))
