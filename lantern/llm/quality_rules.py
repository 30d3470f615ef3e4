"""Quality rules as a bitmask ledger [native].

Every rule is evaluated once per document: its measurements and one failure bit go to the ledger. Policies are
versioned bit masks applied to the ledger afterwards, and ablations are bitwise aggregation over it; neither reads
a text again. Everything is DataFrame functions, without a shuffle.

Defined results: null or empty text has no words and fails `few_words`; ids may be null or repeated (one row for each
input row); other columns are ignored; an empty table gives an empty ledger; lone window repeats overlap freely.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: Bit, and when a document fails. Bits never change their meaning; new rules get new bits.
RULES: dict[str, tuple[int, str]] = {
    "few_words": (0, "n_words < 20"),
    "repeated_words": (1, "100 * n_repeat_words > 30 * n_words"),
    "symbols": (2, "100 * n_symbols > 30 * n_words"),
    "repeated_lines": (3, "100 * n_dup_lines > 50 * n_lines"),
    "shouting": (4, "100 * n_bangs > 50 * n_words"),
    "long_words": (5, "word_chars > 25 * n_words"),
}
#: Version -> names of the rules that reject.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "repeated_lines", "shouting"),
    "strict": tuple(RULES),
}


def mask(names) -> int:
    return sum(1 << RULES[n][0] for n in names)


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once: it is bound as a lambda variable."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeats(windows: Column) -> Column:
    """Words that lie in a window whose hash another window of the text has."""

    def covered(s: Column) -> Column:
        twin = lambda x, k: (F.get(s, k - 1)["v"] == x["v"]) | (F.get(s, k + 1)["v"] == x["v"])
        at = F.filter(F.transform(s, lambda x, k: F.when(twin(x, k), x["i"])), lambda i: i.isNotNull())
        gaps = lambda p: F.transform(p, lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - i, F.lit(WINDOW))))
        return let(F.sort_array(at), lambda p: F.aggregate(gaps(p), F.lit(0), lambda a, g: a + g))

    pairs = F.transform(windows, lambda v, i: F.struct(v.alias("v"), i.alias("i")))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(let(F.sort_array(pairs), covered))


def _n_repeat_words(words: Column) -> Column:
    hashed = lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(WINDOW)]))
    several = let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: let(hashed(h), _repeats))
    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(several)


def _of_words(words: Column) -> Column:
    return F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.aggregate(words, F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
        _n_repeat_words(words).cast("long").alias("n_repeat_words"),
    )


def _of_lines(lines: Column) -> Column:
    return F.struct(
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
    )


def _measures(text_col: str) -> dict[str, Column]:
    text = F.coalesce(F.col(text_col), F.lit(""))
    count = lambda chars: (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    return {"w": let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), _of_words), "l": let(lines, _of_lines), "n_symbols": count(SYMBOLS), "n_bangs": count("!")}


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_bangs")


def _bits(measured: DataFrame) -> DataFrame:
    bits = sum((F.when(F.expr(rule), F.lit(1 << bit)).otherwise(F.lit(0)) for bit, rule in RULES.values()), F.lit(0))
    return measured.withColumn("bits", bits.cast("long"))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, measurements (long) and `bits`, the failure bits of all rules, one row for each document."""
    d = docs.select(F.col(id_col).alias("doc_id"), *[c.alias(k) for k, c in _measures(text_col).items()])
    return _bits(d.select("doc_id", *[{"n_symbols": F.col("n_symbols"), "n_bangs": F.col("n_bangs")}.get(m, F.col(("l." if m in ("n_lines", "n_dup_lines") else "w.") + m)) for m in MEASURES]))


def kept_rows(docs: DataFrame, version: str = "v1", text_col: str = "text") -> DataFrame:
    """The rows of docs that the policy keeps, with their columns: the ledger is computed beside each row."""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *[c.alias(k) for k, c in _measures(text_col).items()])
    flat = row.select("_row", "n_symbols", "n_bangs", "w.*", "l.*")
    return apply_policy(_bits(flat), version).filter("kept").select("_row.*")


def apply_policy(ledger_df: DataFrame, version: str = "v1") -> DataFrame:
    """The ledger with base_failed and kept under the named policy."""
    rejects = lambda name: F.col("bits").bitwiseAND(F.lit(mask(POLICIES[name]))) != 0
    return ledger_df.withColumns({"base_failed": rejects("base"), "kept": ~(rejects("base") | rejects(version))})


def ablations(ledger_df: DataFrame, version: str = "v1") -> DataFrame:
    """For each rule of a policy: documents failing it, failing it alone, and kept if the rule is left out.

    One pass of counts over bits, a row for each rule; `any_bits` and `all_bits` are the bitwise aggregates.
    """
    full = mask(POLICIES[version])
    bits = F.col("bits").bitwiseAND(F.lit(full))
    aggs = [F.count(F.lit(1)).alias("n"), F.bit_or(bits).alias("any_bits"), F.bit_and(bits).alias("all_bits"), F.count_if(bits == 0).alias("kept")]
    for name in POLICIES[version]:
        own = 1 << RULES[name][0]
        aggs += [F.count_if(bits.bitwiseAND(F.lit(own)) != 0).alias(f"f_{name}"), F.count_if(bits == own).alias(f"o_{name}")]
    one = ledger_df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"f_{n}").alias("failed"), F.col(f"o_{n}").alias("failed_alone"), (F.col("kept") + F.col(f"o_{n}")).alias("kept_without")) for n in POLICIES[version]])
    return one.select("n", "any_bits", "all_bits", "kept", F.inline(rows))
