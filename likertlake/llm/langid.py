"""Language identification by a byte convolutional network.

Text is cut into fixed-length windows of bytes. Filters of several widths slide over a
window, each keeps its greatest response, and a softmax layer reads those. A text's
probabilities are the mean over all its windows, weighted by their bytes. The network
is trained in numpy on a bounded sample of labelled text, and applied in batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from likertlake.llm import words as W
from likertlake.llm.share import column_udf, give_back, share

LENGTH, WIDTHS, FILTERS = 256, (2, 3, 4), 16
#: The sample: documents of each language, windows of each document, and how many languages are learned.
SAMPLE_DOCS, SAMPLE_WINDOWS, LANGS = 800, 6, 1000
UNKNOWN = "und"
#: Of the training windows, mixed and hardened ones too, so many stay below the level of noise.
BELOW = 0.999
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
#: First and last letters of scripts that noise is made of.
SCRIPTS = [
    (0x370, 0x3FF), (0x400, 0x4FF), (0x5D0, 0x5EA), (0x621, 0x64A), (0x905, 0x939),
    (0xE01, 0xE2E), (0x3041, 0x3096), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3),
]
#: How many times the sample is ordered to choose it; that fewer are below the threshold does not happen.
MARGIN = 4
#: Windows that the network reads at once, and that are laid out at once.
BATCH, AT_ONCE = 128, 2048


class Network:
    """One-hot byte convolutions, max pooling, ReLU, softmax.

    With a ``level``, the last class is noise, and a window beyond the level is in no language.
    """

    level: float | None = None

    def __init__(self, langs: list[str], seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.langs = langs
        self.taps = [[rng.normal(0, 0.1, (256, FILTERS)).astype(np.float32) for _ in range(w)] for w in WIDTHS]
        n = FILTERS * len(WIDTHS)
        self.bias = np.zeros(n, np.float32)
        self.out = rng.normal(0, 0.1, (n, len(langs))).astype(np.float32)
        self.out_bias = np.zeros(len(langs), np.float32)

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Greatest responses of all filters, and the responses by width."""
        every = []
        for taps in self.taps:
            n = x.shape[1] - len(taps) + 1
            r = taps[0][x[:, :n]]
            for k in range(1, len(taps)):
                r += taps[k][x[:, k : k + n]]
            every.append(r)
        return np.concatenate([r.max(1) for r in every], 1), every

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = np.maximum(self.pooled(x)[0] + self.bias, 0) @ self.out + self.out_bias
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.005, seed: int = 11) -> Network:
        """Adam on the cross entropy; only the pooled positions get a gradient."""
        rng = np.random.default_rng(seed)
        params = [t for taps in self.taps for t in taps] + [self.bias, self.out, self.out_bias]
        first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for part in (order[k : k + batch] for k in range(0, len(x), batch)):
                b, n = x[part], len(part)
                top, every = self.pooled(b)
                hidden = np.maximum(top + self.bias, 0)
                z = hidden @ self.out + self.out_bias
                z = np.exp(z - z.max(1, keepdims=True))
                dz = z / z.sum(1, keepdims=True)
                dz[np.arange(n), y[part]] -= 1
                dz /= n
                dh = (dz @ self.out.T) * (hidden > 0)
                grads, at = [], 0
                for taps, r in zip(self.taps, every):
                    best = r.argmax(1)  # the position of each filter's greatest response
                    own, at = dh[:, at : at + FILTERS], at + FILTERS
                    for k in range(len(taps)):
                        byte = np.take_along_axis(b, best + k, 1).astype(np.int64)
                        cell = byte * FILTERS + np.arange(FILTERS)
                        grads.append(np.bincount(cell.ravel(), own.ravel(), 256 * FILTERS).reshape(256, FILTERS).astype(np.float32))
                grads += [dh.sum(0), hidden.T @ dz, dz.sum(0)]
                step += 1
                for p, g, m, v in zip(params, grads, first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return self


def windows(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all texts, lower-cased and padded; their texts and byte counts."""
    size = np.diff(offsets)
    n = -(-size // length)
    doc = np.repeat(np.arange(len(size)), n)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    start = offsets[doc] + k * length
    count = np.minimum(length, offsets[doc + 1] - start)
    lower, x = np.r_[W.LOWER[data], np.zeros(length, np.uint8)], np.empty((len(doc), length), np.uint8)
    for k in range(0, len(doc), AT_ONCE):  # an index has eight times the bytes of what it picks
        own = slice(k, k + AT_ONCE)
        x[own] = lower[np.minimum(start[own, None] + np.arange(length), len(data))]
        x[own][np.arange(length) >= count[own, None]] = 0
    return x, doc, count


def in_training(id: Column, folds: int = 5) -> Column:
    """Whether a document's fold may be learned from; never for a null id."""
    return F.coalesce(F.crc32(id.cast("string")) % folds != 0, F.lit(False))


def noise(parts: list[str], seed: int = 13) -> list[str]:
    """Texts without a language: shuffled ones, codes, random letters, random words of a script."""
    rng, out = np.random.default_rng(seed), []
    for i, t in enumerate(parts):
        n = max(1, len(t))
        if i % 4 == 0:
            out.append("".join(rng.permutation(list(t))))
        elif i % 4 == 1:
            letters = BASE64[: int(rng.choice([16, 36, 52, 64]))] if rng.random() < 0.5 else "0123456789abcdef"
            out.append("".join(rng.choice(list(letters), n)))
        elif i % 4 == 2:
            out.append("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz" + " " * int(rng.integers(8))), n)))
        else:
            low, high = SCRIPTS[rng.integers(len(SCRIPTS))]
            c = rng.integers(low, high + 1, n)
            c[rng.random(n) < 0.15] = 32
            out.append("".join(map(chr, c)))
    return out


def hardened(parts: list[str], seed: int = 17) -> list[str]:
    """Each text with a key in it, or mixed with another text word by word: clean all the same."""
    rng, out = np.random.default_rng(seed), []
    for i, t in enumerate(parts):
        if i % 2:
            n = int(rng.integers(16, 65))
            letters = ("0123456789abcdef", BASE64, BASE64[:10], BASE64[26:52])[rng.integers(4)]
            key = "".join(rng.choice(list(letters), n))
            t = t[: int(rng.integers(n // 2, LENGTH + 1))]
            k = int(rng.integers(len(t) + 1))
            out.append(f"{t[:k]} {key} {t[k:]}"[:LENGTH])
        else:
            n, a, b = int(rng.integers(1, 12)), t.split(), parts[rng.integers(len(parts))].split()
            both = [x for k in range(0, max(len(a), len(b)), n) for x in a[k : k + n] + b[k : k + n]]
            out.append(" ".join(both)[:LENGTH])
    return out


def _first_windows(parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The first window of each part that has one, and whose it is."""
    x, doc, _ = windows(*W.column(parts))
    keep = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])  # a part longer in bytes than in characters has one more
    return x[keep], doc[keep]


def rejecting(langs: list[str], parts: list[str], y: np.ndarray) -> Network:
    """A network with a class for noise, and the level that clean windows stay below."""
    clean, of = _first_windows(pa.array(parts + hardened(parts[::2]), pa.string()))
    y = np.r_[y, y[::2]][of]
    junk, _ = _first_windows(pa.array(noise(parts[::2]), pa.string()))
    x, y = np.concatenate([clean, junk]), np.r_[y, np.full(len(junk), len(langs))]
    net = Network([*langs, UNKNOWN]).fit(x, y, epochs=min(40, max(6, 24_000 // len(x))))  # small samples need more steps
    own = np.concatenate([net.probabilities(clean[k : k + BATCH])[:, -1] for k in range(0, len(clean), BATCH)])
    net.level = max(0.5, float(np.quantile(own, BELOW)))
    return net


def fit(
    docs: DataFrame, text: str = "text", lang: str = "lang", id: str = "doc_id",
    sample_docs: int = SAMPLE_DOCS, sample_windows: int = SAMPLE_WINDOWS, reject: bool = False, langs: int = LANGS,
) -> Network | None:
    """A network for the languages of the labelled training folds; None if there is no label.

    Learns from ``sample_windows`` windows, spread over the whole text, of at most
    ``sample_docs`` documents of each language, chosen by a hash of the id. Of more than ``langs``
    languages the most frequent are learned, and so many share the sample of a hundred. The sample
    is all that reaches the driver. Rows with a null text, language or id are left out; rows of one id
    count one by one, equal ones once.
    With ``reject``, the network also learns to tell languages from noise.
    """
    rows = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"))
    rows = rows.where(in_training(F.col("id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.approx_count_distinct("id").alias("n")).orderBy(F.desc("n"), "lang").limit(langs).collect()}
    if not sizes:
        return None
    sample_docs = max(1, min(sample_docs, sample_docs * 100 // len(sizes)))
    # Few more than the sample lie below a threshold that falls with the size of a language: no language is one task's rows.
    least = {lang: 1 - MARGIN * sample_docs / n for lang, n in sizes.items() if n > MARGIN * sample_docs}
    level = F.create_map(*[F.lit(x) for lang in sizes for x in (lang, least.get(lang, 0.0))])[F.col("lang")]
    drawn = F.xxhash64("id").alias("h"), F.xxhash64("text").alias("t")
    near = rows.select("lang", "id", *drawn).where(0.5 - F.col("h") / F.lit(2.0**64) >= level).distinct()
    order = Window.partitionBy("lang").orderBy("h", "id", "t")
    chosen = near.withColumn("r", F.row_number().over(order)).where(F.col("r") <= sample_docs).select("lang", "id", "t")
    picked = rows.withColumn("t", F.xxhash64("text")).join(F.broadcast(chosen), ["lang", "id", "t"])  # bounded by the sample
    k = F.explode(F.sequence(F.lit(0), F.lit(sample_windows - 1)))
    at = 1 + F.floor(F.greatest(F.length("text") - LENGTH, F.lit(0)) * F.col("k") / max(1, sample_windows - 1))
    part = picked.withColumn("k", k).select("lang", "id", F.substring("text", at.cast("int"), F.lit(LENGTH)).alias("part")).distinct()
    got = part.orderBy("lang", "id", "part").toArrow()
    names = got.column("lang").to_pylist()
    known = sorted(set(names))
    label = np.array([known.index(v) for v in names])
    if reject:
        net = rejecting(known, got.column("part").to_pylist(), label)
    else:
        x, doc = _first_windows(got.column("part"))
        net = Network(known).fit(x, label[doc])
        del x, doc
    del got, names
    give_back()  # the driver lives on, too
    return net


def predict(docs: DataFrame, net: Network | None, text: str = "text", to: str = "language") -> DataFrame:
    """``docs`` with a struct column ``to``: the language and its probability.

    Every window of the whole text counts. The language is ``und`` and the score 0 for a
    null text, one without a letter, or without a network. With a network that rejects, so
    it is for a text with more than half of its bytes in windows of noise. Only the text is read. A
    column ``to`` of ``docs`` is replaced, others stay as they are.
    """
    get = share(docs.sparkSession, net)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        net = get()
        for batch in batches:
            data, offsets = W.column(batch)
            best, score = [None] * len(batch), np.zeros(len(batch))
            for i, part, at in W.slices(data, offsets, 1 << 17) if net else ():
                x, doc, count = windows(part, at)
                total = np.zeros((len(at) - 1, len(net.langs)))
                junk = np.zeros(len(at) - 1)
                for k in range(0, len(x), BATCH):
                    p = net.probabilities(x[k : k + BATCH])
                    if net.level is not None:
                        np.add.at(junk, doc[k : k + BATCH], (p[:, -1] > net.level) * count[k : k + BATCH])
                        p[:, -1] = 0
                        p /= np.maximum(p.sum(1, keepdims=True), 1e-30)
                    np.add.at(total, doc[k : k + BATCH], p * count[k : k + BATCH, None])
                size = np.diff(at)
                for d in np.flatnonzero((size > 0) & (2 * junk <= size)):
                    top = int(total[d].argmax())
                    best[i + d], score[i + d] = net.langs[top], min(1.0, total[d, top] / size[d])
            yield pa.StructArray.from_arrays([pa.array(best, pa.string()), pa.array(score)], ["lang", "score"])

    lettered = F.coalesce(F.col(f"`{text}`").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("_row"), lettered.alias("_has"), F.when(lettered, F.col(f"`{text}`")).alias("_text"))
    rows = rows.withColumn("_p", column_udf(run, "struct<lang string, score double>")("_text"))
    known = F.col("_has") & F.col("_p.lang").isNotNull()
    found = F.struct(F.when(known, F.col("_p.lang")).otherwise(UNKNOWN).alias("lang"), F.when(known, F.col("_p.score")).otherwise(0.0).alias("score"))
    return rows.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns if c != to], found.alias(to))
