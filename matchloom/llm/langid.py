"""Language identification by a byte convolutional network.

Filters of widths 2, 3 and 4 run over byte embeddings of fixed-length windows; each filter's largest
response, rectified, goes to a softmax. The network is trained in numpy. For prediction the products of
embeddings and filters are added up beforehand for every pair of bytes, so a filter of width 4 costs two
lookups.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lean, ragged, slices, text_parts

WIDTHS, WINDOW = (2, 3, 4), 512
#: Windows overlap by the widest filter less one, so every filter is applied at every place of a text once.
STEP = WINDOW - max(WIDTHS) + 1
UNKNOWN = "und"


@dataclass
class Network:
    langs: list[str]
    embed: np.ndarray  # (256, d)
    filters: list[np.ndarray]  # of each width: (width, d, n)
    bias: np.ndarray  # (widths * n,)
    out: np.ndarray  # (widths * n, langs)
    out_bias: np.ndarray

    def pair_tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Responses to the first pair of bytes of each filter, and to the second pair of the filters wider than 2."""
        first, second = [], []
        for w in self.filters:
            part = [(self.embed @ w[k]).astype(np.float32) for k in range(len(w))]
            first.append((part[0][:, None] + part[1][None, :]).reshape(65536, -1))
            if len(w) == 3:
                second.append(np.repeat(part[2], 256, axis=0))
            elif len(w) == 4:
                second.append((part[2][:, None] + part[3][None, :]).reshape(65536, -1))
        return np.ascontiguousarray(np.hstack(first)), np.ascontiguousarray(np.hstack(second))


def to_windows(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whole texts as overlapping windows, the last of each padded with zeros: windows, their numbers of bytes, windows of each text (1 at least)."""
    sizes = np.diff(offsets)
    counts = np.maximum(1, -(-(sizes - (WINDOW - STEP)) // STEP))
    number = ragged(np.zeros(len(counts), np.int64), counts)
    starts = np.repeat(offsets[:-1], counts) + number * STEP
    lengths = np.clip(np.repeat(offsets[1:], counts) - starts, 0, WINDOW)
    flat = np.zeros(len(starts) * WINDOW, np.uint8)
    flat[ragged(np.arange(len(starts)) * WINDOW, lengths)] = body[ragged(starts, lengths)]
    return flat.reshape(-1, WINDOW), lengths, counts


def train(windows: np.ndarray, labels: np.ndarray, langs: list[str], dims: int = 12, per_width: int = 12, epochs: int = 4, batch: int = 64, rate: float = 0.01, seed: int = 7) -> Network:
    """Trains on windows (n, WINDOW) by Adam. Gradients pass through a filter's largest response only, so they are gathered at those places."""
    rnd = np.random.default_rng(seed)
    n_filters = per_width * len(WIDTHS)
    net = Network(langs, rnd.normal(0, 0.5, (256, dims)), [rnd.normal(0, 1 / np.sqrt(w * dims), (w, dims, per_width)) for w in WIDTHS], np.zeros(n_filters), rnd.normal(0, 0.1, (n_filters, len(langs))), np.zeros(len(langs)))
    params = [net.embed, *net.filters, net.bias, net.out, net.out_bias]
    mean, square, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    total = max(1, epochs * -(-len(windows) // batch))
    places = WINDOW - max(WIDTHS) + 1
    for _ in range(epochs):
        order = rnd.permutation(len(windows))
        for i in range(0, len(order), batch):
            x, y = windows[order[i : i + batch]], labels[order[i : i + batch]]
            first, second = net.pair_tables()
            pairs = x[:, :-1].astype(np.intp) << 8 | x[:, 1:]
            act = first.take(pairs[:, :places], axis=0)
            act[:, :, per_width:] += second.take(pairs[:, 2 : places + 2], axis=0)
            where = act.argmax(axis=1)
            top = np.take_along_axis(act, where[:, None, :], axis=1)[:, 0] + net.bias
            pooled = np.maximum(top, 0)
            logits = pooled @ net.out + net.out_bias
            prob = np.exp(logits - logits.max(axis=1, keepdims=True))
            prob /= prob.sum(axis=1, keepdims=True)
            delta = prob
            delta[np.arange(len(y)), y] -= 1
            delta /= len(y)
            back = (delta @ net.out.T) * (top > 0)
            grads_filters, grad_embed = [], np.zeros_like(net.embed)
            rows = np.arange(len(x))[:, None]
            for g, w in enumerate(net.filters):
                mine, grad = slice(g * per_width, (g + 1) * per_width), np.zeros_like(w)
                for k in range(len(w)):
                    table = np.zeros((256, per_width))
                    np.add.at(table, (x[rows, where[:, mine] + k], np.arange(per_width)[None, :]), back[:, mine])
                    grad[k] = net.embed.T @ table
                    grad_embed += table @ w[k].T
                grads_filters.append(grad)
            grads = [grad_embed, *grads_filters, back.sum(axis=0), pooled.T @ delta, delta.sum(axis=0)]
            step += 1
            now = rate * min(1.0, 2 * (1 - step / (total + 1)))
            for p, g, m, s in zip(params, grads, mean, square):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                p -= now * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return net


class Predictor:
    """Applies a trained network to whole texts, some windows at a time."""

    def __init__(self, net: Network, chunk: int = 48):
        self.net, self.chunk = net, chunk
        self.first, self.second = net.pair_tables()
        self.bias, self.out, self.out_bias = (x.astype(np.float32) for x in (net.bias, net.out, net.out_bias))

    def windows(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of the languages for each window."""
        places, n = WINDOW - max(WIDTHS) + 1, self.first.shape[1]
        skip, pooled = n - self.second.shape[1], np.empty((len(x), self.first.shape[1]), np.float32)
        for i in range(0, len(x), self.chunk):
            part = x[i : i + self.chunk]
            pairs = part[:, :-1].astype(np.intp) << 8 | part[:, 1:]
            act = self.first.take(pairs[:, :places], axis=0)
            act[:, :, skip:] += self.second.take(pairs[:, 2 : places + 2], axis=0)
            pooled[i : i + self.chunk] = act.max(axis=1)
        logits = np.maximum(pooled + self.bias, 0) @ self.out + self.out_bias
        prob = np.exp(logits - logits.max(axis=1, keepdims=True))
        return prob / prob.sum(axis=1, keepdims=True)

    def texts(self, body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probabilities for each text: the mean over its windows, by their bytes."""
        x, lengths, counts = to_windows(body, offsets)
        weight = np.maximum(lengths, 1).astype(np.float64)
        first = np.cumsum(counts) - counts
        return np.add.reduceat(self.windows(x) * weight[:, None], first, axis=0) / np.add.reduceat(weight, first)[:, None]


def learn(df: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", per_lang: int = 300, most: int = 4096, places: int = 6) -> Network | None:
    """A network from a bounded sample of labelled rows: at most per_lang documents a language and `most` in all, chosen by a hash of their ids, with windows from `places` places spread over each text.

    Rows without text, language or id teach nothing; of rows with one id the one of smallest language and text counts. None if no row is left.
    """
    known = df.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull())
    chosen = known.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col)).alias("hashed")).withColumn("part", F.pmod("hashed", F.lit(8)))
    for keys in (["lang", "part"], ["lang"]):  # a language's first are among the first of its 8 parts, so no task sees all of a language
        chosen = chosen.withColumn("n", F.row_number().over(Window.partitionBy(*keys).orderBy("hashed", "id"))).where(F.col("n") <= per_lang)
    chosen = chosen.orderBy("n", "lang").limit(most).select(F.col("id").alias("chosen")).distinct()
    text = F.col("text")
    pieces = F.transform(F.sequence(F.lit(0), F.lit(places - 1)), lambda i: F.substring(text, (F.floor(F.char_length(text) * i / places) + 1).cast("int"), F.lit(WINDOW)))
    taught = known.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).join(F.broadcast(chosen), F.col("id") == F.col("chosen"))
    taught = taught.groupBy("id").agg(F.min(F.struct("lang", pieces.alias("pieces"))).alias("row")).select("id", "row.lang", "row.pieces")  # `most` rows at most
    rows = taught.collect()
    rows = sorted((r for r in rows if any(r.pieces)), key=lambda r: (r.lang, r.id))
    langs = sorted({r.lang for r in rows})
    if not langs:
        return None
    rnd, x, y = np.random.default_rng(11), [], []
    for r in rows:
        for piece in dict.fromkeys(r.pieces):
            raw = piece.encode()[: int(rnd.integers(16, WINDOW)) if rnd.random() < 0.4 else WINDOW]
            x.append(np.frombuffer(raw.ljust(WINDOW, b"\0"), np.uint8))
            y.append(langs.index(r.lang))
    return train(np.array(x), np.array(y), langs)


def predict(df: DataFrame, net: Network | None, text_col: str = "text", id_col: str = "doc_id", most: int = 1 << 19) -> DataFrame:
    """Language of every whole text: id, lang_pred, score (probability of that language, 0 for `und`).

    A text that is null or has no letter is `und`, and so is every text if nothing was learned. Rows keep
    their number, repeated ones too; other columns are neither used nor carried.
    """
    schema = df.select(F.col(id_col)).schema.add("lang_pred", "string").add("score", "double")
    told = _teller(net, most)

    def run(batches):
        for batch in batches:
            for i, j, langs, scores in told(batch.column(1), batch.column(2)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(langs, pa.string()), pa.array(scores)], names=[f.name for f in schema])

    return df.select(F.col(id_col), F.col(text_col), _lettered(text_col)).mapInArrow(lean(run), schema)


def keep_known(df: DataFrame, net: Network | None, least: float, text_col: str = "text", lang_col: str = "lang", most: int = 1 << 19) -> DataFrame:
    """The rows whose language is learned and has a probability of `least` at least, with that language in lang_col; all columns stay, whatever their names.

    Texts that are null or without a letter go; repeated rows and null ids stay. Only texts go through Python.
    """
    told = _teller(net, most)

    def run(batches):
        for texts, lettered in batches:
            found = [(pa.array(langs, pa.string()), pa.array(scores)) for _, _, langs, scores in told(texts, lettered)]
            langs, scores = (pa.concat_arrays([f[k] for f in found]) if found else pa.array([], t) for k, t in enumerate((pa.string(), pa.float64())))
            yield pa.StructArray.from_arrays([langs, scores], ["lang", "score"])

    def predicted(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        return lean(run)(batches)

    names = df.columns
    own = df.select(*(df[f"`{c}`"].alias(f"c{k}") for k, c in enumerate(names)))
    text = f"c{names.index(text_col)}"
    scored = own.withColumn("told", F.arrow_udf(predicted, "lang string, score double").asNondeterministic()(F.col(text), _lettered(text)))
    kept = scored.where((F.col("told.lang") != UNKNOWN) & (F.col("told.score") >= least))
    return kept.select(*((F.col("told.lang") if c == lang_col else F.col(f"c{k}")).alias(c) for k, c in enumerate(names)))


def _lettered(text_col: str):
    return F.col(text_col).rlike(r"\p{L}").alias("_lettered")


def _teller(net: Network | None, most: int):
    """A function of texts and whether they have letters, that gives (start, end, languages, scores) by portions."""
    state: list[Predictor] = []

    def told(texts: pa.Array, lettered: pa.Array):
        if net is not None and not state:
            state.append(Predictor(net))
        use_all = np.array(lettered.fill_null(False).to_pylist(), bool)
        body, at = text_parts(texts)
        for i, j in slices(at, most):
            langs, scores, use = np.full(j - i, UNKNOWN, object), np.zeros(j - i), use_all[i:j]
            if state:
                prob = state[0].texts(body[at[i] : at[j]], at[i : j + 1] - at[i])
                langs[use] = np.array(net.langs, object)[prob.argmax(axis=1)[use]]
                scores[use] = np.clip(prob.max(axis=1), 0, 1)[use]
            yield i, j, langs, scores

    return told


def held_out(id_col: str = "doc_id"):
    """Whether crc32 of the id as text leaves 2 when divided by 4; a null id isn't held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
