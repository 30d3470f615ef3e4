"""Language identification by prediction by partial matching.

One variable-order byte context tree for each language, of orders 0 to 3, counted on a bounded sample of labelled
texts and frozen. A symbol costs -log2(n / (n + d)) bits in a context with n symbols seen, d of them distinct; an
unseen one costs the escape, -log2(d / (n + d)), plus its cost in the next shorter context; below order 0 all 256
bytes cost 8 bits. A text's code length under each tree is exact, over all its bytes; the shortest names the language.
The trees are laid out as tables, so scoring is a few gathers for each byte; they are bounded by the sample. Every
language with a label is learned; tables hold a few languages each, and a text is scored under one after another.

Defined results: `und` with score 0 for null texts, texts without a letter, and if nothing could be learned; ties go
to the language that sorts first; ids may be null or repeated (one row for each input row); other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lantern.llm import textvec

ORDER = 3
SPACE = 32
#: The fit reads at most so many texts of a language, those of the lowest hashes.
SAMPLE_PER_LANGUAGE = 300
#: The rows that are ranked for it are those of the lowest hashes, about so many times as many.
SLACK = 4
#: Languages whose tables are made and looked up together; those of more are scored block by block.
BLOCK_LANGUAGES = 4


@dataclass
class Model:
    """langs: names, sorted. code: byte -> class, the last class for bytes never seen. pair, triple: tables that
    walk to the longest known context of up to three bytes. bits: [context * classes + class, language]."""

    langs: list[str]
    code: np.ndarray
    pair: np.ndarray
    short: np.ndarray
    triple: np.ndarray
    bits: np.ndarray

    @property
    def classes(self) -> int:
        return int(self.code.max()) + 1


def _padded(texts: list[bytes]) -> np.ndarray:
    pad = bytes([SPACE]) * ORDER
    return np.frombuffer(b"".join(pad + t for t in texts), np.uint8)


def fit(samples: dict[str, list[bytes]]) -> Model:
    langs = sorted(samples)
    streams = {lang: _padded(samples[lang]) for lang in langs}
    known = np.unique(np.concatenate([*streams.values(), np.array([SPACE], np.uint8)]))
    code = np.full(256, len(known), np.int64)
    code[known] = np.arange(len(known))
    a, n_langs = len(known) + 1, len(langs)
    coded = {lang: code[s] for lang, s in streams.items()}
    # the symbols that count are those after the padding; context and symbol are one number in base a
    starts = {lang: np.concatenate([[0], np.cumsum([len(t) + ORDER for t in samples[lang]])[:-1]]).astype(np.int64) for lang in langs}
    real = {}
    for lang in langs:
        keep = np.ones(len(coded[lang]), bool)
        for k in range(ORDER):
            keep[starts[lang] + k] = False
        real[lang] = np.flatnonzero(keep)
    cost = np.full((1, a, n_langs), 8.0)
    contexts, rows, shift = [np.zeros(1, np.int64)], [cost], 1
    for order in range(ORDER + 1):
        seen = {}
        for lang in langs:
            c, at = coded[lang], real[lang]
            key = np.zeros(len(at), np.int64)
            for back in range(order, -1, -1):
                key = key * a + c[at - back]
            seen[lang] = np.unique(key, return_counts=True)
        ctx = np.unique(np.concatenate([k // a for k, _ in seen.values()])) if order else np.zeros(1, np.int64)
        if order:
            below = ctx % shift if order > 1 else np.zeros(len(ctx), np.int64)
            at = np.searchsorted(contexts[-1], below)
        else:
            at = np.zeros(1, np.int64)
        cost = rows[-1][at].copy()
        for j, lang in enumerate(langs):
            key, count = seen[lang]
            own = np.searchsorted(ctx, key // a) if order else np.zeros(len(key), np.int64)
            n = np.bincount(own, count, len(ctx))
            d = np.bincount(own, minlength=len(ctx))
            there = n > 0
            cost[there, :, j] += -np.log2(d[there] / (n[there] + d[there]))[:, None]
            cost[own, key % a, j] = -np.log2(count / (n[own] + d[own]))
        if order:
            contexts.append(ctx)
            rows.append(cost)
        else:
            rows[0] = cost
        shift *= a if order else 1
    first = np.cumsum([0, *[len(r) for r in rows]])
    node1 = np.zeros(a, np.int64)
    node1[contexts[1]] = first[1] + np.arange(len(contexts[1]))
    node2 = np.tile(node1, a)  # (c1, c2) -> the longest known of c1c2, c2, none
    node2[contexts[2]] = first[2] + np.arange(len(contexts[2]))
    # the first two bytes of known triples are numbered; number 0 stands for all others
    heads = np.unique(contexts[3] // a)
    pair = np.zeros(a * a, np.int64)
    pair[heads] = 1 + np.arange(len(heads))
    triple = np.full((len(heads) + 1) * a, -1, np.int64)
    triple[pair[contexts[3] // a] * a + contexts[3] % a] = first[3] + np.arange(len(contexts[3]))
    bits = np.concatenate(rows).reshape(-1, n_langs).astype(np.float32)
    return Model(langs, code, pair.astype(np.int32), node2.astype(np.int32), triple.astype(np.int32), bits)


def code_lengths(model: Model, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Bits of each text under each language."""
    out = np.zeros((len(offs) - 1, len(model.langs)))
    if not len(buf):
        return out
    a = model.classes
    c = model.code[buf]
    space = int(model.code[SPACE])
    starts = offs[:-1][np.diff(offs) > 0]
    back = []
    for k in range(1, ORDER + 1):
        p = np.full(len(c), space, np.int64)
        p[k:] = c[:-k] if k < len(c) else p[k:]
        for j in range(k):
            p[np.minimum(starts + j, len(c) - 1)[starts + j < len(c)]] = space
        back.append(p)
    # a start within reach of the text before: only positions of the same text may be contexts
    low = back[1] * a + back[0]
    node = model.triple[model.pair[back[2] * a + back[1]] * a + back[0]]
    node = np.where(node >= 0, node, model.short[low])
    cost = model.bits[node.astype(np.int64) * a + c]
    out[np.diff(offs) > 0] = np.add.reduceat(cost, starts, axis=0, dtype=np.float64)
    return out


def sample(docs: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = SAMPLE_PER_LANGUAGE) -> Iterator[tuple[str, list[bytes]]]:
    """Each language with a label and a text, in order, with at most per_language of its texts, of the lowest hashes.

    Rows of each language are counted first, so that only those under a hash that SLACK times as many would be under
    are ranked: what meets in a language's task is bounded, however many rows there are. Rows of the least hash always
    are, so that a language whose rows are all alike has a text too; each task ranks its own first.
    """
    d = docs.filter(usable).select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t"), F.col(lang_col).alias("g")).filter("t is not null and g is not null")
    d = d.withColumn("h", F.xxhash64("i", "t"))
    rows_of = d.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("h").alias("least"))  # a row for each language: joined by broadcast
    share = F.col("h") / F.lit(float(1 << 63)) / 2 + 0.5  # 0 to 1, alike for all hashes
    near = d.join(F.broadcast(rows_of), "g").filter((share <= SLACK * per_language / F.col("n")) | (F.col("h") == F.col("least")))
    order = Window.partitionBy("g").orderBy("h", "i", "t")
    rows = near.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= per_language).select("g", "t")
    for g, own in groupby(rows.orderBy("g").toLocalIterator(), lambda r: r["g"]):
        yield g, [r["t"].encode("utf-8", "surrogatepass") for r in own]


def learn(docs: DataFrame, usable: Column) -> list[Model | bytes]:
    """Models of all languages, BLOCK_LANGUAGES in each; packed if there are several, as dense tables pack well."""
    languages, out = sample(docs, usable), []
    while samples := dict(islice(languages, BLOCK_LANGUAGES)):
        if len(out) == 1 and isinstance(out[0], Model):
            out = [_packed(out[0])]
        model = fit(samples)
        out.append(_packed(model) if out else model)
    return out


def _packed(model: Model) -> bytes:
    return zlib.compress(pickle.dumps(model), 1)


def predict(docs: DataFrame, model: Model | list[Model | bytes] | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (the chosen language's share of the probability, 0 to 1) and bits (its code length).
    model: of fit or learn; a code length depends on its language alone, so blocks of languages add up to one model."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("ok"))
    shared = docs.sparkSession.sparkContext.broadcast([model] if isinstance(model, Model) else model or [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            names, least, total = np.full(n, "und", object), np.full(n, np.inf), np.zeros(n)
            for block in shared.value:
                own = block if isinstance(block, Model) else pickle.loads(zlib.decompress(block))
                for lo, hi, buf, offs in textvec.text_chunks(batch.column(1), 1 << 19):
                    bits = code_lengths(own, buf, offs)
                    best = bits.argmin(axis=1)
                    low = bits[np.arange(len(bits)), best]
                    share = np.exp2(np.maximum(low[:, None] - bits, -1000.0)).sum(axis=1)
                    before = least[lo:hi]
                    both = np.minimum(before, low)
                    total[lo:hi] = total[lo:hi] * np.exp2(np.maximum(both - before, -1000.0)) + share * np.exp2(np.maximum(both - low, -1000.0))
                    names[lo:hi] = np.where(low < before, np.array(own.langs, object)[best], names[lo:hi])  # ties: the first
                    least[lo:hi] = both
            learned = len(shared.value) > 0
            ok = batch.column(2).to_numpy(zero_copy_only=False).astype(bool) & learned
            scores = np.where(ok, 1.0 / np.maximum(total, 1.0), 0.0)
            names = np.where(ok, names, "und").tolist()
            lengths = least.tolist() if learned else [None] * n
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(lengths, pa.float64())], ["doc_id", "lang_pred", "score", "bits"])

    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, bits double")
