"""The pipeline's rows against a brute-force version of each stage."""

import base64
import hashlib
import re
from collections import Counter

import corpus_pipeline
import tiktoken
from test_llm_operators import join_brute, rules_brute

from lantern.llm import queries, secret_scan

SF = "/root/testdata/sf0.001"


def kept(text):
    words, _, symbols, dup, repeat = rules_brute(text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return not (words < 20 or 100 * repeat > 30 * words or 100 * symbols > 30 * words or 100 * dup > 50 * len(lines) or 100 * text.count("!") > 50 * words)


def masked(text):
    spans = sorted((m.start(), k, m.end()) for k, r in enumerate(secret_scan.RULES) for m in re.finditer(r.pattern, text) if len(m.group(r.group)) >= r.least)
    out, at = "", 0
    for a, _, b in spans:
        if a >= at:
            out += text[at:a] + "[SECRET]"
        at = max(at, b)
    return out + text[at:]


def test_pipeline(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs = [(i, t) for i, t in docs if kept(t or "")]
    first = {i for i, _, c, _ in join_brute(docs) if i == c}
    docs = [(i, masked(t)) for i, t in docs if i in first]
    path, pattern = queries.tokenizer()
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    codec = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = []
    for i, t in docs:
        ids = codec.encode_ordinary(t)
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(t)))
    got = [(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, SF).collect()]
    assert sorted(got) == sorted(want) and len(want) > 50


def test_stages_take_empty_tables_and_odd_rows(spark):
    docs = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (2, "a b c " * 30, None, None, 5), (2, "a b c " * 30, None, None, 5)], "doc_id long, text string, lang string, source string, n_chars long")
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, SF)
            assert out.columns == frame.columns
            out.collect()
    mixed = spark.read.parquet(f"{SF}/documents.parquet")
    assert corpus_pipeline.mix(spark, mixed, SF).count() == mixed.count()


def test_the_mix_is_seen_in_the_result(spark):
    docs = {r["doc_id"]: r["source"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = sorted((r["position"], r["slot"], r["doc_id"]) for r in corpus_pipeline.run(spark, SF).collect())
    assert len({p for p, _, _ in got}) == len(got)
    slots = {}
    for p, slot, i in got:
        assert p // 16 == slot and slots.setdefault(slot, docs[i]) == docs[i]  # a slot is a block of one source
    assert sorted(slots) == list(range(len(slots)))
    total, blocks = Counter(docs[i] for _, _, i in got), Counter(slots.values())
    left, share, done = Counter(blocks), {s: n**0.5 for s, n in total.items()}, Counter()
    for t in range(len(slots)):
        done[slots[t]] += 1
        assert all(abs(done[s] - done.total() * w / sum(share.values())) < 1 for s, w in share.items())
        if done[slots[t]] == left[slots[t]]:  # a new phase, with those that have blocks
            left, done = left - done, Counter()
            share = {s: w for s, w in share.items() if left[s]}
    assert len(total) > 1 and not share


def test_tokens_name_the_places_of_the_mix(spark):
    """Null and repeated ids too: the n-th row that the mix writes is the n-th by position."""
    rows = [(i % 50 if i % 7 else None, f"text {i}", "en", "abc"[i % 3] if i % 5 else None, i) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    mixed = corpus_pipeline.mix(spark, docs, SF)
    written = [(r["doc_id"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in mixed.collect()]
    got = sorted(corpus_pipeline.tokens(spark, mixed, SF).collect(), key=lambda r: r["position"])
    assert [i for i, _ in written] == [r["doc_id"] for r in got]
    assert sorted(written, key=str) == sorted(((r["doc_id"], r["decoded_sha256"]) for r in got), key=str)


def test_near_duplicates_keep_one_row_of_each_group(spark):
    """Of rows, not of ids: null ids, repeated rows, and one id on several texts."""
    one, two, three = (" ".join(f"{c}{i}" for i in range(60)) for c in "xyz")
    near = one.replace("x59", "other")
    rows = [(5, one), (5, one), (6, near), (None, one), (5, two), (7, two), (None, three), (None, three + " "), (8, None), (8, None), (None, ""), (None, "alone in the whole table"), (9, two + " tail")]
    docs = spark.createDataFrame([(i, t, "en", "s", k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(r["n_chars"] for r in corpus_pipeline.near_duplicates(spark, docs.coalesce(1), SF).collect())
    assert got[0] in (0, 1) and got[1] == 4 and got[2] in (6, 7) and got[3:] == [8, 9, 10, 11]
