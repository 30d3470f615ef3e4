"""N-gram Jaccard join with set-relation skipping.

A text's set is its distinct n-word shingles, as 64-bit hashes; two texts link when their sets' Jaccard similarity is
`percent` / 100 or more. The join is exact over whole texts:

1. A sketch of fixed size counts shingles, so that all sets can be ordered alike with frequent shingles last. Equal
   sets become one, with the number of its rows as weight.
2. A set is indexed under its first n - ceil(t n) + 1 shingles in that order: linked sets share one of them. Lists
   under a shingle carry sizes and positions; lists that repeat another list are skipped.
3. Set-relation skipping, by index: a list is kept in blocks by size and position, and a block is skipped whole where
   its least size and most room after a position leave too little in common. Members of the others are held against
   parity bits, which bound |x - y| from below. A list gives a forest of what may link: its sets take turns as leader,
   a leader passes over sets that are in its tree already, and the list is done once it is one tree.
4. Trees become groups; all links are inside groups. A group's sets are fetched once, dealt in blocks, and each pair of
   blocks is a piece of work in which every pair of sets is answered.
5. Set-relation skipping, by answer: in a piece, |x & y| for all y is computed for a leader; the answers of sets much
   like it are the leader's, corrected for the shingles alone in which the two differ.
6. A piece gives the number of links of each set and a forest of links, whose components are the result.

Rows that travel grow with lists and blocks, not with pairs. A shingle that more than HOT sets may list is cut into
lists of its own by hash; afterwards, sets outside the list's largest group meet all others, chunk by chunk. Nothing is
capped.

Defined results: null, empty or blank text has an empty set and links with nothing; fewer words than n are one
shingle, the whole sequence; ids may be repeated (one row for each input row); a row with a null id links nothing of
its own (n_links 0) and takes the component of its equals; other columns are ignored; an empty table gives an empty
result. Equality is that of 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lantern.llm import textvec
from lantern.llm.common import added, forget, n_partitions, release, written
from lantern.llm.components import components, forest

WORDS, PERCENT = 5, 75
#: Counters of the sketch, and bits of the filter of sets to fetch; both are fixed, whatever the input.
SKETCH, SLICE, FILTER = 1 << 20, 1 << 14, 1 << 23
#: Tasks that the sets of one component are dealt to.
SALTS = 32
#: Sets of a list that one task holds, about; rows of a list's block; sets and shingles of a group's block.
HOT, SKIP, BLOCK, WORK = 1 << 16, 64, 4096, 1 << 22
#: Shingles that so many sets of a piece have at most are counted pair by pair, others in matrix products.
RARE = 16
ODD = 0x9E3779B97F4A7C15


def shingles(buf: np.ndarray, offs: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    starts, ends, first = textvec.words(buf, offs)
    h = textvec.word_hashes(textvec.lowered(buf), starts, ends)
    grams = textvec.ngram_hashes(h, n)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= n:
            yield np.unique(grams[a : b - n + 1])
        elif b > a:
            yield textvec.ngram_hashes(h[a:b], int(b - a))
        else:
            yield grams[:0]


def digest(s: np.ndarray) -> int:
    """A 64-bit name for a set, as a signed number."""
    x = textvec.mix(s)
    both = np.array([np.bitwise_xor.reduce(x), x.sum(dtype=np.uint64) + np.uint64(len(s))], np.uint64)
    return int(textvec.mix(textvec.mix(both[:1]) + both[1:]).view(np.int64)[0])


def parity(s: np.ndarray) -> bytes:
    """Bits that tell whether an odd number of shingles falls on each; two sets' bits differ in |x - y| places at most."""
    width = max(256, min(1 << 16, 1 << max(0, len(s) - 1).bit_length()))
    return np.packbits((np.bincount((s & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1).astype(bool), bitorder="little").tobytes()


def folded(x: np.ndarray, width: int) -> np.ndarray:
    """Rows of parity bits as if made for fewer bytes."""
    while x.shape[-1] > width:
        half = x.shape[-1] // 2
        x = x[..., :half] ^ x[..., half:]
    return x


def may_link(away, na, nb, percent: int):
    """Whether sets of these sizes that differ in `away` shingles link."""
    return (100 + percent) * away <= (100 - percent) * (na + nb)


def _sets(batch: pa.RecordBatch, column: int, n: int) -> Iterator[np.ndarray]:
    for _, _, buf, offs in textvec.text_chunks(batch.column(column)):
        yield from shingles(buf, offs, n)


def _batch(columns, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def measured(docs: DataFrame, n: int) -> DataFrame:
    """(id, n, s, sig, k) of each row, s the name of its set, sig its parity bits, k a hash of the row; and slices of each
    task's sketch (part, counts)."""
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen, kind = np.zeros(SKETCH, np.uint32), set(), None
        for batch in batches:
            kind = batch.schema.field(0).type
            size, name, sig = [], [], []
            for s in _sets(batch, 1, n):
                size.append(len(s))
                name.append(digest(s))
                sig.append(parity(s))
                if name[-1] not in seen:
                    if len(seen) > 500_000:
                        seen.clear()
                    seen.add(name[-1])
                    counts[(s >> np.uint64(44)).astype(np.int64)] += np.uint32(1)  # two of one text in a counter count once
            m = batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(name, pa.int64()), pa.array(sig, pa.binary()), batch.column(2), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], ["id", "n", "s", "sig", "k", "part", "counts"])
        if kind is not None:
            parts = [p for p in range(SKETCH // SLICE) if counts[p * SLICE : (p + 1) * SLICE].any()]
            m = len(parts)
            data = [counts[p * SLICE : (p + 1) * SLICE].tobytes() for p in parts]
            yield pa.RecordBatch.from_arrays([pa.nulls(m, kind), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary()), pa.nulls(m, pa.int64()), pa.array(parts, pa.int32()), pa.array(data, pa.binary())], ["id", "n", "s", "sig", "k", "part", "counts"])
        release()

    return docs.mapInArrow(run, f"id {id_type}, n long, s long, sig binary, k long, part int, counts binary")


def _classes(counts: np.ndarray) -> np.ndarray:
    """0 for counters of usual height; above, a class for each doubling."""
    usual = 2.0 * counts.mean() + 64
    return np.clip(np.ceil(np.log2(np.maximum(counts, 1) / usual)), 0, 60).astype(np.uint8)


def _cuts(counts: np.ndarray, most: int) -> np.ndarray:
    """Lists that the shingles of each counter are cut into, by how far it stands out."""
    usual = 2 * counts.mean(dtype=np.float64) + 64
    return (1 + np.maximum(0, counts - usual) // most).astype(np.uint32)


def _listed(token: np.ndarray, s: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The list of each posting, and whether its shingle is cut into several."""
    cut = cuts[(token >> np.uint64(44)).astype(np.int64)]
    return token + textvec.mix(s.view(np.uint64)) % cut.astype(np.uint64) * np.uint64(ODD), cut > 1


POSTING = np.dtype([("token", "<u8"), ("s", "<i8"), ("n", "<i4"), ("pos", "<i4")])


def postings(docs: DataFrame, n: int, percent: int, classes, cuts, buckets: int) -> DataFrame:
    """(bucket, data): packed postings of the prefixes, dealt by list; each set once in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, seen, held, size = classes.value, set(), [], 0

        def out() -> pa.RecordBatch:
            all_ = np.concatenate(held)
            bucket = (_listed(all_["token"], all_["s"], cuts.value)[0] % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            at = np.flatnonzero(np.concatenate([[True], bucket[order][1:] != bucket[order][:-1]]))
            groups = np.split(all_[order], at[1:])
            return pa.RecordBatch.from_arrays([pa.array(bucket[order[at]]), pa.array([g.tobytes() for g in groups], pa.binary())], ["bucket", "data"])

        for batch in batches:
            for s in _sets(batch, 1, n):
                if not len(s):
                    continue
                name = digest(s)
                if name in seen:
                    continue
                if len(seen) > 500_000:
                    seen.clear()
                seen.add(name)
                take = len(s) - (percent * len(s) + 99) // 100 + 1
                own = rank[(s >> np.uint64(44)).astype(np.int64)]
                first = np.argsort(own, kind="stable")[:take] if own.any() else slice(0, take)  # s is sorted
                p = np.empty(take, POSTING)
                p["token"], p["s"], p["n"], p["pos"] = s[first], name, len(s), np.arange(take)
                held.append(p)
                size += take
                if size > 500_000:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()
        del held
        release()

    return docs.mapInArrow(run, "bucket int, data binary")


LISTS = pa.schema([("list", pa.int64()), ("s", pa.int64()), ("n", pa.int32()), ("pos", pa.int32()), ("hot", pa.int64())])


def fits(na, nb, pa_, pb, percent: int):
    """Whether sizes and positions of a first shared shingle leave enough in common."""
    most = 1 + np.minimum(na - 1 - pa_, nb - 1 - pb)
    return (100 + percent) * most >= percent * (na + nb)


def lists(dealt: DataFrame, percent: int, cuts) -> DataFrame:
    """Members of lists of two or more sets that may link; equal lists of a bucket are one, with the least positions.
    Postings of a shingle that is cut come once more, without a list, as hot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [np.frombuffer(x.as_buffer(), POSTING) for batch in batches for x in batch.column(1)]
        if not parts:
            return
        p = np.concatenate(parts)
        del parts
        key, cut = _listed(p["token"], p["s"], cuts.value)
        order = np.lexsort((p["s"], key))
        p, key, cut = p[order], key[order], cut[order]
        new = np.ones(len(p), bool)
        new[1:] = (key[1:] != key[:-1]) | (p["s"][1:] != p["s"][:-1])
        p, key, cut = p[new], key[new], cut[new]
        hot = p[cut]
        for lo in range(0, len(hot), 200_000):
            x = hot[lo : lo + 200_000]
            yield _batch([pa.nulls(len(x), pa.int64()), x["s"], x["n"], x["pos"], x["token"].view(np.int64)], LISTS)
        at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(at, len(p)))
        keep = np.repeat(size > 1, size)
        p, size = p[keep], size[size > 1]
        if not len(p):
            return
        at = np.concatenate([[0], np.cumsum(size)[:-1]])
        order = textvec.mix(p["s"].view(np.uint64))
        name = textvec.mix(np.add.reduceat(textvec.mix(order), at) + size.astype(np.uint64)).view(np.int64)  # of the list's members
        of = np.repeat(np.arange(len(at)), size)
        # by list name, then set: the rows of equal lists come together
        by = np.lexsort((p["s"], name[of]))
        ln, s = name[of][by], p["s"][by]
        first = np.flatnonzero(np.concatenate([[True], (ln[1:] != ln[:-1]) | (s[1:] != s[:-1])]))
        pos = np.minimum.reduceat(p["pos"][by], first)
        ln, s, n = ln[first], s[first], p["n"][by][first]
        at = np.flatnonzero(np.concatenate([[True], ln[1:] != ln[:-1]]))
        size = np.diff(np.append(at, len(ln)))
        two = at[size == 2]
        send = np.ones(len(ln), bool)
        send[two] = send[two + 1] = fits(n[two], n[two + 1], pos[two], pos[two + 1], percent)
        for lo in range(0, len(ln), 200_000):
            part = slice(lo, lo + 200_000)
            rows = [c[part][send[part]] for c in (ln, s, n, pos)]
            yield _batch([*rows, pa.nulls(len(rows[0]), pa.int64())], LISTS)
        del p, ln, s, n, pos
        release()

    return dealt.mapInArrow(run, "list long, s long, n int, pos int, hot long")


class _Bits:
    """Parity bits of many sets, kept by width."""

    def __init__(self, column: pa.Array):
        sigs = [np.frombuffer(x.as_buffer(), np.uint8) for x in column]
        self.width = np.array([len(x) for x in sigs], np.int64)
        self.at, self.rows = np.zeros(len(sigs), np.int64), {}
        for w in np.unique(self.width).tolist():
            own = np.flatnonzero(self.width == w)
            self.at[own], self.rows[w] = np.arange(len(own)), np.stack([sigs[i] for i in own])

    def differ(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """A lower bound of the symmetric difference of each pair i, j."""
        out = np.zeros(len(i), np.int64)
        both = self.width[i] * (1 << 20) + self.width[j]
        for kind in np.unique(both).tolist():
            pairs = np.flatnonzero(both == kind)
            a, b = divmod(kind, 1 << 20)
            step = max(1, (4 << 20) // max(a, b))
            for lo in range(0, len(pairs), step):
                part = pairs[lo : lo + step]
                x, y = self.rows[a][self.at[i[part]]], self.rows[b][self.at[j[part]]]
                x, y = folded(x, min(a, b)), folded(y, min(a, b))
                out[part] = np.bitwise_count((x ^ y).view(np.uint64)).sum(axis=1, dtype=np.int64)
        return out


def turns(ln: np.ndarray, s: np.ndarray, n: np.ndarray, pos: np.ndarray, label: np.ndarray, bits: _Bits, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Edges of a forest of what may link in each list, between rows that don't have one label yet. Rows come by list,
    size and position."""
    start = np.flatnonzero(np.concatenate([[True], ln[1:] != ln[:-1]]))
    count = np.diff(np.append(start, len(ln)))
    of = np.repeat(np.arange(len(start)), count)
    by_turn = np.lexsort((textvec.mix(s.view(np.uint64)), of))  # in each list, the leaders in turn
    turn = np.empty(len(ln), np.int64)
    turn[by_turn] = np.arange(len(ln)) - start[of]
    # blocks of a list: rows near in size, then position, with the least size and the most room
    head = np.flatnonzero((np.arange(len(ln)) - start[of]) % SKIP == 0)
    end = np.append(head[1:], len(ln))
    of_block = of[head]
    least, room = np.minimum.reduceat(n, head), np.maximum.reduceat(n - 1 - pos, head)
    for r in range(int(count.max()) - 1):
        low, high = np.minimum.reduceat(label, start), np.maximum.reduceat(label, start)
        open_ = (count > r + 1) & (low != high)
        if not open_.any():
            return
        lead = by_turn[np.minimum(start + r, len(ln) - 1)]
        na, ra = n[lead[of_block]], (n - 1 - pos)[lead[of_block]]
        met = np.flatnonzero(open_[of_block] & ((100 + percent) * (1 + np.minimum(ra, room)) >= percent * (na + least)))
        long = end[met] - head[met]
        rows = np.repeat(head[met] - np.cumsum(long) + long, long) + np.arange(long.sum())
        mine = lead[of[rows]]
        ok = (turn[rows] > r) & (label[rows] != label[mine]) & fits(n[mine], n[rows], pos[mine], pos[rows], percent)
        rows, mine = rows[ok], mine[ok]
        if not len(rows):
            continue
        ok = may_link(bits.differ(mine, rows), n[mine], n[rows], percent)
        rows, mine = rows[ok], mine[ok]
        one = np.unique(label[rows], return_index=True)[1]  # an edge to each tree
        rows, mine = rows[one], mine[one]
        yield s[mine], s[rows]
        to = np.arange(len(label))
        to[label[rows]] = label[mine]
        label = to[label]


def may_links(members: DataFrame, percent: int) -> DataFrame:
    """(a, b): forests of what may link, of lists that lie whole in a partition. members: list, s, n, pos, sig, label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if len(b)]
        if not batches:
            return
        table = pa.Table.from_batches(batches).combine_chunks()
        ln, s, n, pos, label = (table.column(c).to_numpy().astype(np.int64) for c in ("list", "s", "n", "pos", "label"))
        size = np.unique(ln, return_inverse=True, return_counts=True)
        size = size[2][size[1]]
        order = np.lexsort((pos, n, ln, size))  # lists of like lengths together
        ln, size = ln[order], size[order]
        cuts = np.flatnonzero(np.concatenate([[True], ln[1:] != ln[:-1]]))
        seen: set = set()
        lo = 0
        while lo < len(ln):  # whole lists, up to so many rows
            k = int(np.searchsorted(cuts, lo + (1 << 15), "right"))
            hi = len(ln) if k == len(cuts) else max(int(cuts[k - 1]), lo + int(size[lo]))
            own = order[lo:hi]
            names = np.unique(np.stack([ln[lo:hi], label[own]]), axis=1, return_inverse=True)[1].ravel()
            bits = _Bits(table.column("sig").take(pa.array(own)).combine_chunks())
            found = [np.stack([np.minimum(a, b), np.maximum(a, b)], 1) for a, b in turns(ln[lo:hi], s[own], n[own], pos[own], names, bits, percent)]
            if found:
                new = [e for e in map(tuple, np.unique(np.concatenate(found), axis=0).tolist()) if e not in seen]
                if len(seen) > 500_000:
                    seen.clear()
                seen.update(new)
                if new:
                    yield _batch(zip(*new, strict=True), pa.schema([("a", pa.int64()), ("b", pa.int64())]))
            lo = hi
        release()

    return members.select("list", "s", "n", "pos", "sig", "label").mapInArrow(run, "a long, b long")


def across(hot: DataFrame, labels: DataFrame, sigs: DataFrame, percent: int, most: int, parts: int) -> DataFrame:
    """(a, b): what may link across the pieces that a hot shingle's list is cut into. Only lists with several labels have
    work left, and only sets outside the largest label of a list need to meet the others."""
    rows = hot.join(labels.withColumnRenamed("id", "s"), "s", "left").withColumn("label", F.coalesce("component", "s"))
    counts = rows.groupBy("hot", "label").count()
    top = counts.groupBy("hot").agg(F.max(F.struct("count", "label")).alias("top"), F.sum("count").alias("n_all"))
    pieces = lambda n: F.ceil(n / F.lit(most)).cast("long")
    top = top.filter("n_all > top.count").select("hot", F.col("top.label").alias("main"), pieces(F.col("n_all")).alias("c"), pieces(F.col("n_all") - F.col("top.count")).alias("u"))
    x = rows.join(top, "hot").join(sigs, "s")
    own = lambda n: F.pmod(F.xxhash64("s"), F.col(n))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    whole = x.withColumn("i", own("c")).withColumn("j", each("u"))
    outside = x.filter("label <> main").withColumn("j", own("u")).withColumn("i", each("c"))
    both = whole.unionByName(outside).withColumn("list", F.xxhash64("hot", "i", "j"))
    return may_links(both.repartition(parts, "list"), percent)


def fetched(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(k, data): shingles of the rows in wanted.k, and of a few others that a filter of fixed size lets through."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.zeros(FILTER, bool)
        for batch in batches:
            flags[(batch.column(0).to_numpy().view(np.uint64) >> np.uint64(41)).astype(np.int64)] = True
        packed = np.packbits(flags)
        step = SLICE
        parts = [p for p in range(len(packed) // step) if packed[p * step : (p + 1) * step].any()]
        yield _batch([parts, [packed[p * step : (p + 1) * step].tobytes() for p in parts]], pa.schema([("part", pa.int32()), ("counts", pa.binary())]))

    packed = added(wanted.select("k").mapInArrow(bits, "part int, counts binary"), "u1", FILTER // 8, np.bitwise_or, once=True)
    shared = docs.sparkSession.sparkContext.broadcast(packed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags, seen = np.unpackbits(shared.value).view(bool), set()
        schema = pa.schema([("k", pa.int64()), ("data", pa.binary())])
        for batch in batches:
            k = batch.column(2).to_numpy()
            own = np.flatnonzero(flags[(k.view(np.uint64) >> np.uint64(41)).astype(np.int64)])
            names, data, held = [], [], 0
            for name, s in zip(k[own].tolist(), _sets(batch.take(pa.array(own)), 1, n), strict=True):
                if name in seen or not len(s):
                    continue
                if len(seen) > 500_000:
                    seen.clear()
                seen.add(name)
                names.append(name)
                data.append(s.tobytes())
                held += 8 * len(s)
                if held > 8 << 20:
                    yield _batch([names, data], schema)
                    names, data, held = [], [], 0
            yield _batch([names, data], schema)
        release()

    return docs.mapInArrow(run, "k long, data binary")


def common(sets: list[np.ndarray], rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Shingles that each of the sets in rows shares with each of those in others.

    One set's answers are computed; a set that has most of its shingles takes them over and corrects them for the
    shingles in which the two differ. Shingles that all such sets share thus cost nothing."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    every = np.concatenate(sets)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    at = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    times = np.diff(np.append(at, len(every)))
    out = np.zeros((len(rows), len(others)), np.float32)
    row, column = np.full(len(sets), -1), np.full(len(sets), -1)
    row[rows], column[others] = np.arange(len(rows)), np.arange(len(others))
    for t in np.unique(times[(times > 1) & (times <= RARE)]).tolist():
        own = owner[at[times == t][:, None] + np.arange(t)]
        for i in range(t):
            for j in range(t):
                a, b = row[own[:, i]], column[own[:, j]]
                ok = (a >= 0) & (b >= 0)
                np.add.at(out, (a[ok], b[ok]), 1)
    usual = np.flatnonzero(times > RARE)
    if not len(usual):
        return out
    has = np.repeat(times > RARE, times)
    owner, times = owner[has], times[usual]
    at = np.concatenate([[0], np.cumsum(times)])
    token = np.repeat(np.arange(len(times)), times)
    total = np.bincount(owner, minlength=len(sets))
    lead = int(rows[total[rows].argmax()])
    of_lead = np.zeros(len(times), bool)
    of_lead[token[owner == lead]] = True
    shared = np.bincount(owner[of_lead[token]], minlength=len(sets))  # the leader's answers
    near = 2 * shared[rows] > total[rows]
    out += np.where(near[:, None], shared[others].astype(np.float32), 0)
    step = max(64, (1 << 22) // len(sets))
    for lo in range(0, len(times), step):
        hi = min(lo + step, len(times))
        own = slice(at[lo], at[hi])
        m = np.zeros((len(sets), hi - lo), np.float32)
        m[owner[own], token[own] - lo] = 1
        differ = m[rows] - np.where(near[:, None], m[lead], 0)
        some = np.flatnonzero(differ.any(axis=0))
        if len(some):
            out += differ[:, some] @ m[np.ix_(others, some)].T
    return out


FOUND = pa.schema([("id", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def answered(pieces: DataFrame, percent: int) -> DataFrame:
    """(id, links, root): of each piece (c, p, q) the links that its sets have there, by weight, and a forest of links (id,
    root). Rows come sorted by piece, so one piece is held at a time."""

    def settled(piece: list[pa.RecordBatch], key: tuple) -> list[np.ndarray]:
        s, w, own = (np.concatenate([b.column(c).to_numpy() for b in piece]) for c in ("s", "w", "own"))
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for b in piece for x in b.column("data")]
        size = np.array([len(x) for x in sets], np.float64)
        same = key[1] == key[2]
        rows, others = np.flatnonzero(own == key[1]), np.flatnonzero(own == key[2])
        links, label, edges = np.zeros(len(s)), np.arange(len(s)), []
        if len(rows) and len(others) and len(s) > 1:
            shared = common(sets, rows, others)
            for lo in range(0, len(rows), 512):
                part = rows[lo : lo + 512]
                hit = (100 + percent) * shared[lo : lo + 512].astype(np.float64) >= percent * (size[part][:, None] + size[others])
                if same:  # each pair is met from both sides
                    hit &= part[:, None] != others
                counted = hit.astype(np.float64)
                links[part] += counted @ w[others]
                if not same:
                    links[others] += w[part] @ counted
                edges += forest(hit, part, others, label)
        e = np.array(edges, np.int64).reshape(-1, 2)
        some = np.flatnonzero(links)
        return [np.concatenate([s[some], s[e[:, 0]]]), np.concatenate([links[some].astype(np.int64), np.zeros(len(e), np.int64)]), np.concatenate([s[some], s[e[:, 1]]])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        held_key = None
        for batch in filter(len, batches):
            key = np.stack([batch.column(c).to_numpy() for c in ("c", "p", "q")], axis=1)
            ends = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)])).tolist()
            out = []
            for lo, hi in zip(ends, [*ends[1:], len(key)], strict=True):
                own = tuple(key[lo].tolist())
                if held and own != held_key:
                    out.append(settled(held, held_key))
                    held = []
                held.append(batch.slice(lo, hi - lo))
                held_key = own
            if out:
                yield _batch([np.concatenate(c) for c in zip(*out, strict=True)], FOUND)
        if held:
            yield _batch(settled(held, held_key), FOUND)
        release()

    return pieces.mapInArrow(run, "id long, links long, root long")


def _pieces(members: DataFrame, sets: DataFrame, block: int, work: int, parts: int) -> DataFrame:
    """A row of a set (component c, s, w, k, n) for each pair of blocks of its group that its own block is in."""
    count = members.groupBy("c").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("n"))
    cuts = count.select("c", F.greatest(F.ceil(F.col("m") / block), F.ceil(F.col("n") / work)).cast("long").alias("cuts")).filter("cuts > 1")
    salt = F.pmod(F.xxhash64("s"), F.lit(SALTS)).alias("salt")
    cuts = cuts.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    dealt = members.select("*", salt).join(cuts, ["c", "salt"], "left").withColumn("cuts", F.coalesce("cuts", F.lit(1).cast("long")))
    full = dealt.join(sets, "k").withColumn("own", F.pmod(F.xxhash64("s", F.lit(1)), F.col("cuts")))
    each = full.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1)))
    each = each.select("c", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "s", "w", "data")
    return each.repartition(parts, "c", "p", "q").sortWithinPartitions("c", "p", "q")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS, percent: int = PERCENT, hot: int = HOT, block: int = BLOCK, work: int = WORK) -> DataFrame:
    """doc_id, n_shingles, component_id (least id that links reach, its own included), set_id, n_links (other rows linked
    directly, copies included) of every row. hot, block, work: sizes at which lists and groups are cut."""
    spark = docs.sparkSession
    parts = n_partitions(spark)
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    d = d.withColumn("k", F.xxhash64("id", "text"))
    rows = written(measured(d, n), "sets")
    of_docs = rows.filter("n is not null").select("id", "n", "s")
    one = rows.filter("n > 0").groupBy("s").agg(F.min("id").alias("rep"), F.count("id").alias("w"), F.count(F.lit(1)).alias("m"), F.max("sig").alias("sig"), F.min("k").alias("k"), F.min("n").alias("n"))
    one = written(one, "distinct")
    counts = added(rows.filter("counts is not null").select("part", "counts"), "u4", SKETCH, np.add)
    classes, cut = _classes(counts), _cuts(counts, hot)
    cuts = spark.sparkContext.broadcast(cut)
    dealt = postings(d, n, percent, spark.sparkContext.broadcast(classes), cuts, 4 * parts).repartition(parts, "bucket")
    found = written(lists(dealt, percent, cuts), "lists")
    sigs = one.select("s", "sig")
    members = found.filter("list is not null").groupBy("list", "s").agg(F.min("pos").alias("pos"), F.min("n").alias("n"))  # a list may be in several buckets
    members = members.join(sigs, "s").withColumn("label", F.col("s")).repartition(parts, "list")
    edges = written(may_links(members, percent).distinct(), "edges")
    groups = components(edges)
    if (cut > 1).any():
        more = across(found.filter("hot is not null").select("hot", "s", "n", "pos"), groups, sigs, percent, hot, parts)
        groups = components(written(edges.unionByName(more).distinct(), "edges"))
    wanted = written(groups.select(F.col("id").alias("s"), F.col("component").alias("c")).join(one.select("s", "w", "k", "n"), "s"), "members")
    sets = fetched(d, wanted, n).dropDuplicates(["k"])
    links = written(answered(_pieces(wanted, sets, block, work, parts), percent), "answers")
    forget(found, edges, wanted)
    labels = components(links.filter("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")))
    n_links = links.groupBy(F.col("id").alias("s")).agg(F.sum("links").alias("links"))
    # names of sets -> the least id of all rows whose sets are in the component
    named = one.select("s", "rep", "w", "m").join(labels.withColumnRenamed("id", "s"), "s", "left").join(n_links, "s", "left")
    named = named.withColumn("links", F.coalesce("links", F.lit(0).cast("long")) + F.greatest(F.col("w") - 1, F.lit(0).cast("long")))
    salt_of = lambda c: F.pmod(F.xxhash64(c), F.lit(SALTS))
    every = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
    linked = named.filter("component is not null").withColumn("salt", salt_of("s"))
    # the sets of a large component meet its least id in many tasks
    whole = linked.groupBy("component").agg(F.min("rep").alias("component_id")).withColumn("salt", F.explode(every))
    alone = named.filter("component is null").select("s", F.col("rep").alias("component_id"), "links", "rep", "m")
    by_set = linked.join(whole, ["component", "salt"]).select("s", "component_id", "links", "rep", "m").unionByName(alone)
    # and so do the rows of a set that many have; a row of its own is the one of its set's id
    by_set = by_set.select("s", "component_id", "links", F.explode(F.when(F.col("m") > 1, every).otherwise(F.array(salt_of("rep")))).alias("salt"))
    own_links = F.when(F.col("id").isNull(), F.lit(0).cast("long")).otherwise(F.col("links")).alias("n_links")
    full = of_docs.filter("n > 0").withColumn("salt", salt_of("id")).join(by_set, ["s", "salt"], "left")
    full = full.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id", F.col("s").alias("set_id"), own_links)
    empty = of_docs.filter("n = 0").select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("id").alias("component_id"), F.col("s").alias("set_id"), F.lit(0).cast("long").alias("n_links"))
    return full.unionByName(empty)
