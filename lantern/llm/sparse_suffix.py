"""Exact repeats across documents by a sparse suffix array.

1. Of the LENGTH - K + 1 K-grams of a passage of LENGTH words, the one of least hash (the first of equals) is its
   minimiser. Suffixes are kept at minimisers alone, about one word in 22; a suffix stands for the passages whose
   minimiser it starts with, LENGTH words that begin up to LENGTH - K words before it. Equal passages have equal
   minimisers, so what two documents share meets at a suffix.
2. The heads of suffixes, their first K words as one hash, are counted by hash, with partial counts in each task. Two
   filters of fixed size, sent to all tasks, tell which heads two documents have and which stand over MANY suffixes.
   Where the input outgrows the filters, more is sent, and nothing else changes.
3. Suffixes of shared heads travel with the words around them that their passages cover, dealt by head. A task sorts
   them by their words and compares neighbours. Going from long matches on the right to short ones, and so from short
   ones on the left to long ones, it extends each to the left: suffixes with r words in common stand together, and
   those among them with the same LENGTH - r words before are one passage, a repeat if two documents hold it.
4. A head with over MANY suffixes, as of a line that a third of all documents hold, would gather in one task. Its
   passages travel as hashes instead, each to a task of its own; those that several documents in a chunk of the input
   hold are settled there and sent once, those of one document from every place.
5. Passages that overlap or touch merge, so longer repeats come out whole. Every word counts; nothing is capped.

Defined results: null or empty text, texts under LENGTH words and null ids give no rows; rows that share an id are one
document, so they aren't repeats of each other; words are compared with A-Z lower-cased; positions count words; other
columns are ignored; an empty table gives an empty result. Equality is that of 64-bit hashes for heads and hashed
passages and of 48-bit hashes, word by word, for the words around a head.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lantern.llm import textvec
from lantern.llm.common import added, n_partitions, release

LENGTH, K = 50, 8
#: Suffixes of one head that a task sorts, at most.
MANY = 10_000
#: Bits of the filter of shared heads, most bits of that of heads over MANY, and most bytes of a slice of them.
SHARED, FREQUENT, SLICE = 1 << 26, 1 << 22, 1 << 14
#: Heads, and bytes of suffixes, that a task holds before it sends them.
HEADS, HELD = 1 << 19, 24 << 20


def _join(a: np.ndarray, b: np.ndarray, far: int) -> np.ndarray:
    """Hash of the pair a[i], b[i + far]."""
    n = max(0, min(len(a), len(b) - far))
    x = a[:n] * np.uint64(textvec.BASE)
    x ^= x >> np.uint64(31)
    x += b[far : far + n]
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def spans_hash(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each word on, by doubling."""
    power, width, out, done = h, 1, None, 0
    todo = n
    while todo:
        if todo & 1:
            out, done = (power, width) if out is None else (_join(out, power, done), done + width)
        todo >>= 1
        if todo:
            power, width = _join(power, power, width), 2 * width
    return textvec.mix(out)


def sliding_least(v: np.ndarray, n: int) -> np.ndarray:
    """Place of the least of v[i : i + n], the first of equals."""
    best, width = np.arange(len(v)), 1
    first = lambda a, b: np.where(v[a] <= v[b], a, b)
    while 2 * width <= n:
        best, width = first(best[:-width], best[width:]), 2 * width
    return first(best[: len(best) - (n - width)], best[n - width :]) if n > width else best


class Suffixes:
    """The suffixes at minimisers of some texts: text and word they start at (place counts words of all texts), hash of
    the head, and how many words before them their passages begin, from `near` to `far`."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, length: int, k: int):
        starts, ends, self.first = textvec.words(buf, offs)
        z = np.zeros(0, np.int64)
        self.words, self.place, self.text, self.near, self.far, self.head = z.astype(np.uint64), z, z, z, z, z.astype(np.uint64)
        n = len(starts) - length + 1
        if n <= 0:
            return
        self.words = textvec.word_hashes(textvec.lowered(buf), starts, ends)
        row = np.repeat(np.arange(len(offs) - 1), np.diff(self.first))
        begin = np.flatnonzero(row[:n] == row[length - 1 :])  # passages inside one text
        if not len(begin):
            return
        grams = spans_hash(self.words, k)
        place = sliding_least(grams, length - k + 1)[begin]
        run = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (begin[1:] != begin[:-1] + 1)]))
        self.place = place[run]
        self.far = self.place - begin[run]
        self.near = self.place - begin[np.append(run[1:], len(begin)) - 1]
        self.text, self.head = row[self.place], grams[self.place]


def _bit(filter_: np.ndarray, head: np.ndarray) -> np.ndarray:
    at = head >> np.uint64(64 - (8 * len(filter_)).bit_length() + 1)
    return (filter_[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def shared_runs(mark: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Flags marks that two documents or more have."""
    order = np.argsort(mark, kind="stable")
    m, d = mark[order], doc[order]
    at = np.flatnonzero(np.concatenate([[True], m[1:] != m[:-1]])) if len(m) else np.zeros(0, np.int64)
    if not len(at):
        return np.zeros(0, bool)
    several = np.minimum.reduceat(d, at) != np.maximum.reduceat(d, at)
    out = np.empty(len(m), bool)
    out[order] = np.repeat(several, np.diff(np.append(at, len(m))))
    return out


def intervals(doc: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, first and end word of what passages that overlap or touch cover together."""
    order = np.lexsort((at, doc))
    d, a = doc[order], at[order]
    new = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (a[1:] > a[:-1] + length)])) if len(d) else np.zeros(0, np.int64)
    last = np.append(new[1:], len(d)) - 1 if len(new) else new
    return d[new], a[new], a[last] + length


def _cuts(key: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin, and the end."""
    return np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]]) if len(key) else np.zeros(1, np.int64)


COUNT = np.dtype([("head", "<u8"), ("low", "<i8"), ("high", "<i8"), ("n", "<i8")])


def _added_up(rows: np.ndarray) -> np.ndarray:
    """One row of COUNT for each head: the least and greatest document and how many suffixes."""
    rows = rows[np.argsort(rows["head"], kind="stable")]
    at = _cuts(rows["head"])[:-1]
    out = rows[at]
    out["low"], out["high"], out["n"] = np.minimum.reduceat(rows["low"], at), np.maximum.reduceat(rows["high"], at), np.add.reduceat(rows["n"], at)
    return out


def filters(docs: DataFrame, length: int, k: int, many: int, shared: int) -> tuple[np.ndarray, np.ndarray]:
    """The filters of heads that two documents have and, of those, of heads with over `many` suffixes, as packed bits;
    shared: bits of the first, a power of 2 from 64 on."""
    parts = n_partitions(docs.sparkSession)
    frequent, step = min(FREQUENT, shared), min(SLICE, shared // 8, FREQUENT // 8)
    buckets = 4 * parts

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            own = _added_up(np.concatenate(held))
            bucket = ((own["head"] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            cuts = _cuts(bucket)  # heads ascend, so a bucket holds a range of them
            return pa.RecordBatch.from_arrays([pa.array(bucket[cuts[:-1]].astype(np.int32)), pa.array([own[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())], ["bucket", "data"])

        for batch in batches:
            ids = batch.column(0).to_numpy()
            for lo, _, buf, offs in textvec.text_chunks(batch.column(1)):
                x = Suffixes(buf, offs, length, k)
                if not len(x.head):
                    continue
                own = np.empty(len(x.head), COUNT)
                own["head"], own["low"], own["n"] = x.head, ids[lo + x.text], 1
                own["high"] = own["low"]
                held.append(_added_up(own))
                if sum(map(len, held)) > HEADS:
                    yield out()
                    held = []
        if held:
            yield out()
        release()

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [np.frombuffer(x.as_buffer(), COUNT) for batch in batches for x in batch.column(1)]
        if not rows:
            return
        own = _added_up(np.concatenate(rows))
        own = own[own["low"] != own["high"]]
        for bits, heads, base in ((shared, own["head"], 0), (frequent, own["head"][own["n"] > many], shared // 8 // step)):
            at = (heads >> np.uint64(64 - bits.bit_length() + 1)).astype(np.int64)
            cuts = _cuts(at // (8 * step))
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                flags = np.zeros(8 * step, bool)
                flags[at[a:b] % (8 * step)] = True
                yield pa.RecordBatch.from_arrays([pa.array([base + at[a] // (8 * step)], pa.int32()), pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary())], ["part", "counts"])
        del own
        release()

    dealt = docs.mapInArrow(count, "bucket int, data binary").repartition(parts, "bucket")
    both = added(dealt.mapInArrow(flag, "part int, counts binary"), "u1", (shared + frequent) // 8, np.bitwise_or, once=True)
    return both[: shared // 8], both[shared // 8 :]


def around(words: np.ndarray, place: np.ndarray, near: np.ndarray, far: np.ndarray, length: int, k: int) -> np.ndarray:
    """48 bits of each word around the suffixes: length - k words before, the nearest first, and length words from them
    on; 0 where no passage of the suffix goes."""
    left = np.arange(1, length - k + 1)
    right = np.arange(length)
    at = np.concatenate([place[:, None] - left, place[:, None] + right], axis=1)
    inside = np.concatenate([left <= far[:, None], right < length - near[:, None]], axis=1)
    h = np.where(inside, words[np.where(inside, at, 0)], np.uint64(0))
    return np.ascontiguousarray(h.view(np.uint16).reshape(len(place), 2 * length - k, 4)[:, :, :3])


def repeated(doc: np.ndarray, at: np.ndarray, near: np.ndarray, far: np.ndarray, words: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Document and first word of the passages that two documents hold, among the suffixes of whole heads."""
    left, right = words[:, : length - k], np.ascontiguousarray(words[:, length - k :])
    order = np.argsort(right.reshape(len(doc), -1).view(f"S{6 * length}").ravel(), kind="stable")
    doc, at, near, far, left, right = doc[order], at[order], near[order], far[order], left[order], right[order]
    # words that a suffix has in common with the one before it
    differ = (right[1:] != right[:-1]).any(axis=2)
    common = np.concatenate([[0], np.where(differ.any(axis=1), differ.argmax(axis=1), length)])
    before = np.zeros(len(doc), np.uint64)
    docs, starts = [], []
    for o in range(length - k + 1):  # words before the suffix
        if o:
            word = left[:, o - 1].astype(np.uint64)
            before = textvec.mix(before * np.uint64(textvec.BASE) + (word[:, 0] | word[:, 1] << np.uint64(16) | word[:, 2] << np.uint64(32)))
        own = np.flatnonzero((near <= o) & (o <= far))
        if len(own) > 1:
            together = np.cumsum(common < length - o)[own]  # the suffixes with so many words in common
            same = own[shared_runs(textvec.mix(before[own] + together.astype(np.uint64) * np.uint64(textvec.BASE)), doc[own])]
            docs.append(doc[same])
            starts.append(at[same] - o)
    return (np.concatenate(docs), np.concatenate(starts)) if docs else (doc[:0], at[:0])


ROWS = pa.schema([("bucket", pa.int64()), ("doc", pa.binary()), ("at", pa.binary()), ("near", pa.binary()), ("far", pa.binary()), ("data", pa.binary()), ("a", pa.int64()), ("b", pa.int64()), ("doc_id", pa.int64())])
TYPES = "bucket long, doc binary, at binary, near binary, far binary, data binary, a long, b long, doc_id long"
FOUND = pa.schema([("doc_id", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, k: int = K, many: int = MANY, shared_bits: int = SHARED) -> DataFrame:
    """doc_id, n_spans, n_repeated_words, spans ("first:end" in words, comma-joined) of documents with a passage of
    `length` words or more that another document has. Ids are whole numbers; k is less than length. shared_bits: of the
    filter of shared heads, a power of 2; all tasks hold it."""
    spark = docs.sparkSession
    parts = 2 * n_partitions(spark)  # what travels is more than the input's columns are in Parquet
    buckets = 8 * parts
    d = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    known = spark.sparkContext.broadcast(filters(d, length, k, many, shared_bits))

    def settled(found) -> pa.RecordBatch:
        n = len(found[0])
        return pa.RecordBatch.from_arrays([pa.nulls(n, f.type) for f in list(ROWS)[:6]] + [pa.array(found[1]), pa.array(found[2]), pa.array(found[0])], schema=ROWS)

    def packed(bucket: np.ndarray, doc: np.ndarray, at: np.ndarray, data: np.ndarray, near=None, far=None) -> pa.RecordBatch:
        """A row for each bucket."""
        order = np.argsort(bucket, kind="stable")
        cuts = _cuts(bucket[order])
        own = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        put = lambda x, kind: pa.array([x[i].astype(kind).tobytes() for i in own], pa.binary())
        none = pa.nulls(len(own), pa.binary())
        columns = [pa.array(bucket[order[cuts[:-1]]], pa.int64()), put(doc, np.int64), put(at, np.int32), none if near is None else put(near, np.uint8), none if far is None else put(far, np.uint8), put(data, data.dtype)]
        return pa.RecordBatch.from_arrays(columns + [pa.nulls(len(own), pa.int64())] * 3, schema=ROWS)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared, frequent = known.value
        held: dict[bool, list] = {False: [], True: []}
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            if held[False]:
                doc, at, near, far, head, words = (np.concatenate(x) for x in zip(*held[False], strict=True))
                yield packed((head % np.uint64(buckets)).astype(np.int64), doc, at, words, near, far)
            if held[True]:
                doc, at, mark = (np.concatenate(x) for x in zip(*held[True], strict=True))
                yield packed((mark % np.uint64(buckets)).astype(np.int64) + buckets, doc, at, mark)

        for batch in batches:
            ids = batch.column(0).to_numpy()
            for lo, _, buf, offs in textvec.text_chunks(batch.column(1)):
                x = Suffixes(buf, offs, length, k)
                some = _bit(shared, x.head)
                usual = some & ~_bit(frequent, x.head)
                own = np.flatnonzero(usual)
                for at in (own[i : i + 8192] for i in range(0, len(own), 8192)):  # none where no head is shared
                    words = around(x.words, x.place[at], x.near[at], x.far[at], length, k)
                    held[False].append((ids[lo + x.text[at]], x.place[at] - x.first[x.text[at]], x.near[at], x.far[at], x.head[at], words))
                    size += words.nbytes
                own = np.flatnonzero(some & ~usual)
                if len(own):
                    n = (x.far - x.near + 1)[own]
                    of = np.repeat(own, n)
                    begin = x.place[of] - x.far[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
                    doc, at, mark = ids[lo + x.text[of]], begin - x.first[x.text[of]], spans_hash(x.words, length)[begin]
                    twice = shared_runs(mark, doc)
                    if twice.any():
                        yield settled(intervals(doc[twice], at[twice], length))
                    once = np.zeros(len(mark), bool)
                    once[np.unique(mark, return_index=True)[1]] = True
                    # a passage of one document here is not settled: all its places may yet be shared with one elsewhere
                    once = np.flatnonzero(once | ~twice)
                    held[True].append((doc[once], at[once], mark[once]))
                    size += 20 * len(once)
                if size > HELD:
                    yield from out()
                    held, size = {False: [], True: []}, 0
        yield from out()
        release()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by bucket, so one is held at a time."""
        held: list = []
        now = None

        def found() -> Iterator[pa.RecordBatch]:
            doc, at = (np.concatenate([np.frombuffer(r[i], kind) for r in held]) for i, kind in ((0, np.int64), (1, np.int32)))
            at = at.astype(np.int64)
            if now < buckets:
                near, far = (np.concatenate([np.frombuffer(r[i], np.uint8) for r in held]) for i in (2, 3))
                words = np.concatenate([np.frombuffer(r[4], np.uint16) for r in held]).reshape(len(doc), 2 * length - k, 3)
                doc, at = repeated(doc, at, near, far, words, length, k)
            else:
                same = shared_runs(np.concatenate([np.frombuffer(r[4], np.uint64) for r in held]), doc)
                doc, at = doc[same], at[same]
            if len(doc):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in intervals(doc, at, length)], schema=FOUND)

        for batch in batches:
            done = batch.filter(batch.column(8).is_valid())
            if len(done):
                yield pa.RecordBatch.from_arrays([done.column(8), done.column(6), done.column(7)], schema=FOUND)
            for bucket, *row in zip(batch.column(0).to_pylist(), *(batch.column(i) for i in range(1, 6)), strict=True):
                if bucket is None:
                    continue
                if held and bucket != now:
                    yield from found()
                    held = []
                now = bucket
                held.append([x.as_buffer() if x.is_valid else None for x in row])
        if held:
            yield from found()
        release()

    # what was settled in its chunk travels along, dealt by document
    key = F.coalesce("bucket", F.lit(2 * buckets).cast("long") + F.abs(F.col("doc_id") % buckets))
    dealt = d.mapInArrow(send, TYPES).withColumn("_key", key).repartition(parts, "_key").sortWithinPartitions("_key").drop("_key")
    each = Window.partitionBy("doc_id").orderBy("a", "b")
    # of the rows of an id that many have, each place goes on once
    found = dealt.mapInArrow(compare, "doc_id long, a long, b long").groupBy("doc_id", "a").agg(F.max("b").alias("b"))
    reach = F.max("b").over(each.rowsBetween(Window.unboundedPreceding, -1))
    found = found.withColumn("new", F.coalesce((F.col("a") > reach).cast("long"), F.lit(1).cast("long"))).withColumn("span", F.sum("new").over(each))
    merged = found.groupBy("doc_id", "span").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    own = merged.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_spans"), F.sum(F.col("b") - F.col("a")).alias("n_repeated_words"), F.sort_array(F.collect_list(F.struct("a", "b"))).alias("s"))
    text = F.array_join(F.transform("s", lambda x: F.concat_ws(":", x["a"].cast("string"), x["b"].cast("string"))), ",")
    return own.select("doc_id", "n_spans", "n_repeated_words", text.alias("spans"))
