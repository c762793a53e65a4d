"""Language of a text by a byte convolutional network.

Bytes are embedded, filters of several widths slide over them, each filter's largest response in a window is kept, and
a softmax layer turns those into languages. The network is trained in numpy on windows of labelled texts and applied to
batches of windows that cover each whole text.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import give_back, quoted, sub_batches, with_fields, without

WIDTHS, FILTERS, EMBEDDED, SPAN, PAD = (2, 3, 4), 12, 8, 128, 256
UNKNOWN = "und"


def windows(data: bytes, span: int = SPAN):
    """All bytes of a text in windows of ``span``, the last one padded."""
    flat = np.full(max(1, -(-len(data) // span)) * span, PAD, "i2")
    flat[:len(data)] = np.frombuffer(data, "u1")
    return flat.reshape(-1, span)


class ByteNetwork:
    """Weights, training and use; ``languages`` in alphabetical order."""

    def __init__(self, languages, seed: int = 11):
        random = np.random.default_rng(seed)
        self.languages, width, n = list(languages), max(WIDTHS), len(WIDTHS) * FILTERS
        # narrower filters are filters of the largest width with a part that stays zero
        self.open = np.zeros((width * EMBEDDED, n), "f4")
        for i, w in enumerate(WIDTHS):
            self.open[:w * EMBEDDED, i * FILTERS:(i + 1) * FILTERS] = 1
        self.bytes = random.normal(0, 0.5, (PAD + 1, EMBEDDED)).astype("f4")
        self.bytes[PAD] = 0
        self.filters = random.normal(0, 0.3, (width * EMBEDDED, n)).astype("f4") * self.open
        self.bias = np.zeros(n, "f4")
        self.out = random.normal(0, 0.1, (n, len(self.languages))).astype("f4")
        self.out_bias = np.zeros(len(self.languages), "f4")

    def _columns(self, x):
        embedded, width = self.bytes[x], max(WIDTHS)
        steps = x.shape[1] - width + 1
        return np.concatenate([embedded[:, i:i + steps] for i in range(width)], axis=2)

    def _forward(self, x):
        columns = self._columns(x)
        responses = columns.reshape(-1, columns.shape[2]) @ self.filters
        responses = responses.reshape(len(x), columns.shape[1], -1)
        pooled = np.maximum(responses.max(axis=1) + self.bias, 0)
        logits = pooled @ self.out + self.out_bias
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        return columns, responses, pooled, e / e.sum(axis=1, keepdims=True)

    def probabilities(self, x, batch: int = 1024):
        parts = [self._forward(x[i:i + batch])[3] for i in range(0, len(x), batch)]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.languages)), "f4")

    def train(self, x, y, epochs: int = 6, batch: int = 128, rate: float = 0.01, seed: int = 5):
        random, names = np.random.default_rng(seed), ("bytes", "filters", "bias", "out", "out_bias")
        first = {n: np.zeros_like(getattr(self, n)) for n in names}
        second = {n: np.zeros_like(getattr(self, n)) for n in names}
        width, t = max(WIDTHS), 0
        for _ in range(epochs):
            order = random.permutation(len(x))
            for start in range(0, len(x), batch):
                some, t = order[start:start + batch], t + 1
                columns, responses, pooled, p = self._forward(x[some])
                error = p.copy()
                error[np.arange(len(some)), y[some]] -= 1
                error /= len(some)
                slope = (error @ self.out.T) * (pooled > 0)
                best = responses.argmax(axis=1)          # only the largest response passes a gradient on
                at = columns[np.arange(len(some))[:, None], best]
                grads = {"out": pooled.T @ error, "out_bias": error.sum(axis=0), "bias": slope.sum(axis=0),
                         "filters": np.einsum("bf,bfk->kf", slope, at) * self.open, "bytes": np.zeros_like(self.bytes)}
                back = slope[:, :, None] * self.filters.T[None]
                for i in range(width):
                    source = np.take_along_axis(x[some], best + i, axis=1)
                    np.add.at(grads["bytes"], source, back[:, :, i * EMBEDDED:(i + 1) * EMBEDDED])
                grads["bytes"][PAD] = 0
                for n in names:
                    first[n] = 0.9 * first[n] + 0.1 * grads[n]
                    second[n] = 0.999 * second[n] + 0.001 * grads[n] ** 2
                    step = first[n] / (1 - 0.9 ** t) / (np.sqrt(second[n] / (1 - 0.999 ** t)) + 1e-8)
                    setattr(self, n, (getattr(self, n) - rate * step).astype("f4"))
        return self

    def classify(self, texts: list[bytes]):
        """(language, score) of each text: the mean of its windows' probabilities, weighted by their bytes."""
        if not self.languages or not texts:
            return [(UNKNOWN, 0.0)] * len(texts)
        cut = [windows(t) for t in texts]
        sizes = np.array([len(c) for c in cut])
        every = np.concatenate(cut)
        weighted = self.probabilities(every).astype("f8") * (every != PAD).sum(axis=1)[:, None]
        sums = np.add.reduceat(weighted, np.concatenate(([0], np.cumsum(sizes)[:-1])), axis=0)
        totals = sums.sum(axis=1)
        best = sums.argmax(axis=1)
        return [(self.languages[b], round(float(s[b] / t), 6) if t else 0.0) for b, s, t in zip(best, sums, totals)]


def held_out(doc_id: str = "doc_id"):
    """Documents that training never sees."""
    return F.coalesce(F.crc32(F.col(quoted(doc_id)).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_windows(docs: DataFrame, per_language: int, per_text: int, lang: str, text: str):
    """At most ``2 * per_language`` texts for each language, up to ``per_text`` windows of each, spread over the text.

    The texts are those with the least hashes, so the sample is the same for the same data. This is the only part of
    the corpus that training sees, and all that comes to the driver.
    """
    counts = {r[0]: r[1] for r in docs.groupBy(F.col(quoted(lang)).alias("lang")).count().collect()}
    steps = F.create_map(*[F.lit(v) for k, n in sorted(counts.items()) for v in (k, max(1, n // per_language))]) \
        if counts else None
    if steps is None:
        return [], np.zeros((0, SPAN), "i2"), np.zeros(0, "i8")
    rank = F.xxhash64(F.col(quoted(text)), *[F.col(quoted(c)) for c in docs.columns if c == "doc_id"])
    some = docs.select(F.col(quoted(lang)).alias("lang"), F.col(quoted(text)).alias("text"), rank.alias("rank")).where(
        F.pmod("rank", F.element_at(steps, F.col("lang"))) == 0)

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            rows = []
            for label, value, rank in zip(*[c.to_pylist() for c in batch.columns]):
                every = windows(value.encode())
                chosen = np.unique(np.linspace(0, len(every) - 1, min(per_text, len(every))).astype(int))
                rows.append((label, rank, every[chosen].astype("<i2").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int64(), pa.binary()))],
                names=["lang", "rank", "cut"])

    bound = 2 * per_language * len(counts)
    rows = some.mapInArrow(cut, "lang string, rank long, cut binary").orderBy("rank", "lang", "cut").limit(bound).collect()
    languages = sorted({r[0] for r in rows})
    parts = [np.frombuffer(r[2], "<i2").reshape(-1, SPAN) for r in rows]
    x = np.concatenate(parts) if parts else np.zeros((0, SPAN), "i2")
    y = np.repeat([languages.index(r[0]) for r in rows], [len(p) for p in parts]) if parts else np.zeros(0, "i8")
    return languages, x, y.astype("i8")


def train_network(docs: DataFrame, per_language: int = 400, per_text: int = 6, lang: str = "lang",
                  text: str = "text") -> ByteNetwork:
    """A network for the languages of ``docs``, learned from labelled rows with a letter in their text."""
    usable = docs.where(F.col(quoted(lang)).isNotNull() & F.col(quoted(text)).rlike(r"\p{L}"))
    languages, x, y = training_windows(usable, per_language, per_text, lang, text)
    network = ByteNetwork(languages)
    return network.train(x, y) if len(x) else network


def identify(docs: DataFrame, network: ByteNetwork, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` (a learned language, or ``und``) and ``score`` (0 to 1).

    ``und`` with score 0 if the text is null, empty or without a letter, or if nothing was learned. Every byte of a text
    is in a window. Rows are independent; columns named like a new one are replaced. Nothing is shuffled.
    """
    docs = without(docs, "lang_pred", "score")
    lettered = F.coalesce(F.col(quoted(text)).rlike(r"\p{L}"), F.lit(False))
    schema = with_fields(docs.schema, ("lang_pred", "string"), ("score", "double"))

    def predict(batches):
        import pyarrow as pa

        for whole in batches:
            for batch in sub_batches(whole, text, 2_000_000):
                values, use = batch.column(text).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
                found = iter(network.classify([v.encode() for v, u in zip(values, use) if u]))
                rows = [next(found) if u else (UNKNOWN, 0.0) for u in use]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.float64())],
                    names=[f.name for f in schema])
        give_back()

    return docs.withColumn("_op_lettered", lettered).mapInArrow(predict, schema)
