"""Quality classifier: a factorisation machine over hashed words and structure.

A text's features are its lower-cased words hashed to 2**15 columns (term frequencies of unit length) and one column
for the quantile bin of each structure statistic (counts, shares and repetition measured on the whole text). The
score is a bias, a linear part and all pairwise interactions of low-rank factors, in linear time by
    sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2).
It is fitted by AdaGrad on a bounded sample of labelled texts; scoring covers every whole text.

Defined results: null text counts as empty and is scored by its structure alone; without usable labels every score
is 0.5; labels other than 0 and 1 are ignored; ids may be null or repeated (one row for each input row); other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lantern.llm import textvec
from lantern.llm.common import forget, written

BITS, RANK, BINS = 15, 8, 12
EPOCHS, STEPS, BATCH, RATE, DECAY = 12, 500, 64, 0.08, 2e-4
#: The fit reads at most so many labelled texts, those of the lowest hashes.
SAMPLE = 6000
#: And so many bytes of them.
SAMPLE_BYTES = 64 << 20
STATS = ("words", "bytes a word", "symbols", "bangs", "capitals", "digits", "distinct words", "word after itself", "repeated lines", "punctuation", "lines", "non-ASCII")


@dataclass
class Model:
    edges: np.ndarray  # [statistic, BINS - 1], inner bounds of its bins
    bias: float
    linear: np.ndarray
    factors: np.ndarray


def _share(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offs[1:]] - total[offs[:-1]]


def _distinct(keys: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, key and count of each distinct (row, key), and how many a row has."""
    order = np.lexsort((keys, row))
    k, r = keys[order], row[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (r[1:] != r[:-1])
    at = np.flatnonzero(new)
    return r[at], k[at], np.diff(np.append(at, len(k))), np.bincount(r[at], minlength=n)


def features(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Statistics [text, statistic]; and text, hashed column and value of each word feature."""
    n = len(offs) - 1
    low = textvec.lowered(buf)
    starts, ends, first = textvec.words(buf, offs)
    h = textvec.word_hashes(low, starts, ends)
    row = np.repeat(np.arange(n), np.diff(first))
    count = np.diff(first)
    some, size = np.maximum(count, 1), np.maximum(np.diff(offs), 1)
    col = (h >> np.uint64(64 - BITS)).astype(np.int64)
    r, k, times, _ = _distinct(col, row, n)
    distinct = _distinct(h, row, n)[3]
    twin = np.zeros(len(h), bool)
    twin[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    # lines: hashes of what stands between line ends, empty ones left out
    cut = np.unique(np.concatenate([np.flatnonzero(buf == 10) + 1, offs]))
    ls, le = cut[:-1], cut[1:]
    full = le - ls > 1
    ls, le = ls[full], le[full]
    of = np.searchsorted(offs, ls, "right") - 1
    lines = np.bincount(of, minlength=n) if len(of) else np.zeros(n, np.int64)
    lh = textvec.word_hashes(low, ls, le - (low[np.maximum(le - 1, 0)] == 10)) if len(ls) else np.zeros(0, np.uint64)
    dup = lines - _distinct(lh, of, n)[3] if len(of) else np.zeros(n, np.int64)
    symbol = np.isin(buf, np.frombuffer(b"#*$%&|<>", np.uint8))
    stats = np.stack([
        np.log1p(count), np.diff(offs) / some, _share(symbol, offs) / some, _share(buf == 33, offs) / some,
        _share((buf >= 65) & (buf <= 90), offs) / size, _share((buf >= 48) & (buf <= 57), offs) / size,
        distinct / some / np.maximum(1, np.log(some + 1)) * 4, _share(twin, first) / some, dup / np.maximum(lines, 1),
        _share((buf == 44) | (buf == 46), offs) / some, np.log1p(lines), _share(buf >= 128, offs) / size,
    ], axis=1)
    norm = np.sqrt(np.bincount(r, times.astype(np.float64) ** 2, n))
    return stats, r, k, times / norm[r]


def _design(stats, r, k, x, edges):
    """All features in order of text: text, column, value."""
    n, s = stats.shape
    bins = np.stack([np.searchsorted(edges[j], stats[:, j], "right") for j in range(s)], axis=1)
    cols = (1 << BITS) + np.arange(s) * BINS + bins
    rr = np.concatenate([r, np.repeat(np.arange(n), s)])
    kk, xx = np.concatenate([k, cols.ravel()]), np.concatenate([x, np.ones(n * s)])
    order = np.argsort(rr, kind="stable")
    return rr[order], kk[order], xx[order]


def _raw(model: Model, r, k, x, n: int):
    first = np.searchsorted(r, np.arange(n))  # every text has features: its bins
    vx = model.factors[k] * x[:, None]
    total = np.add.reduceat(vx, first, axis=0)
    pairs = 0.5 * (total**2 - np.add.reduceat(vx**2, first, axis=0)).sum(axis=1)
    return model.bias + np.add.reduceat(model.linear[k] * x, first) + pairs, total, vx


def fit(texts: list[bytes], labels: np.ndarray, seed: int = 7) -> Model:
    buf = np.frombuffer(b"".join(texts), np.uint8)
    offs = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    parts = [features(buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a]) for a in range(0, len(texts), 256) for b in [min(a + 256, len(texts))]]
    stats = np.concatenate([p[0] for p in parts])
    r, k, x = np.concatenate([p[1] + 256 * i for i, p in enumerate(parts)]), np.concatenate([p[2] for p in parts]), np.concatenate([p[3] for p in parts])
    edges = np.stack([np.quantile(s, np.linspace(0, 1, BINS + 1)[1:-1]) for s in stats.T])
    # a statistic that is one value for most texts: bounds above it, by the quantiles of the others
    for j, s in enumerate(stats.T):
        usual = np.median(s)
        rest = s[s > usual]
        if len(rest) and (np.unique(edges[j]).size < BINS // 2):
            edges[j] = np.sort(np.concatenate([[np.nextafter(usual, np.inf)], np.quantile(rest, np.linspace(0, 1, BINS - 1)[1:])]))
    r, k, x = _design(stats, r, k, x, edges)
    rng = np.random.default_rng(seed)
    n_cols = (1 << BITS) + len(STATS) * BINS
    model = Model(edges, 0.0, np.zeros(n_cols), rng.normal(0, 0.01, (n_cols, RANK)))
    g_lin, g_fac, g_bias = np.full(n_cols, 1e-2), np.full((n_cols, RANK), 1e-2), 1e-2
    bounds = np.searchsorted(r, np.arange(len(texts) + 1))
    y = labels.astype(np.float64)
    for _ in range(max(EPOCHS, -(-STEPS * BATCH // len(texts)))):  # a small sample is read more often
        order = rng.permutation(len(texts))
        for lo in range(0, len(order), BATCH):
            rows = order[lo : lo + BATCH]
            sizes = bounds[rows + 1] - bounds[rows]
            at = np.concatenate([np.arange(bounds[i], bounds[i + 1]) for i in rows])
            br = np.repeat(np.arange(len(rows)), sizes)
            bk, bx = k[at], x[at]
            z, total, vx = _raw(model, br, bk, bx, len(rows))
            err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[rows]) / len(rows)
            cols, inv = np.unique(bk, return_inverse=True)
            e = err[br] * bx
            lin = np.bincount(inv, e, len(cols)) + DECAY * model.linear[cols]
            grad = e[:, None] * (total[br] - vx)
            fac = np.stack([np.bincount(inv, grad[:, f], len(cols)) for f in range(RANK)], axis=1) + DECAY * model.factors[cols]
            g_lin[cols] += lin**2
            g_fac[cols] += fac**2
            g_bias += err.sum() ** 2
            model.linear[cols] -= RATE * lin / np.sqrt(g_lin[cols])
            model.factors[cols] -= RATE * 0.5 * fac / np.sqrt(g_fac[cols])
            model.bias -= RATE * err.sum() / np.sqrt(g_bias)
    model.linear, model.factors = model.linear.astype(np.float32), model.factors.astype(np.float32)
    return model


def sample(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most: int = SAMPLE, most_bytes: int = SAMPLE_BYTES) -> tuple[list[bytes], np.ndarray]:
    """At most `most` texts with a label of 0 or 1, of the lowest hashes, and of them as many as have `most_bytes` bytes
    in all (the first, whatever its size); a text counts once for each label row. Of rows that share an id, the least
    text stands for all, so what comes to the driver is bounded by both."""
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("i"), F.col(label_col).alias("y"))
    chosen = known.withColumnRenamed("i", id_col).filter(usable).withColumnRenamed(id_col, "i").orderBy(F.xxhash64("i"), "i", "y").limit(most)
    texts = docs.select(F.col(id_col).alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    texts = texts.join(F.broadcast(chosen.select("i").distinct()), "i", "left_semi").groupBy("i").agg(F.min("t").alias("t"))  # `most` ids
    rows = written(texts.join(F.broadcast(chosen), "i").withColumn("n", F.octet_length("t").cast("long")), "labelled")
    order = Window.orderBy(F.xxhash64("i"), "i", "y")  # `most` rows
    upto = rows.select("i", "y", "n").withColumn("upto", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    fit_for = upto.filter((F.col("upto") <= most_bytes) | (F.col("upto") == F.col("n"))).select("i", "y").distinct()
    own = rows.join(F.broadcast(fit_for), ["i", "y"], "left_semi").orderBy("i", "y").collect()
    forget(rows)
    rows = own
    return [r["t"].encode("utf-8", "surrogatepass") for r in rows], np.array([r["y"] for r in rows], np.float64)


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score, the probability of label 1."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            out = [np.zeros(0)]
            for lo, hi, buf, offs in textvec.text_chunks(batch.column(1), 1 << 19):
                if own is None:
                    out.append(np.full(hi - lo, 0.5))
                    continue
                z = _raw(own, *_design(*features(buf, offs), own.edges), hi - lo)[0]
                out.append(1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(out), pa.float64())], ["doc_id", "score"])

    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, score double")
