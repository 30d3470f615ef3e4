"""Secret scans by an incremental blob ledger [native].

Every version of every path is content-addressed (SHA-256). The ledger holds which (blob, rule, rule version) have
been scanned and what they gave; a run scans only unseen pairs, once for each distinct content, and joins findings
back to all paths. Everything is DataFrame functions.

Defined results: null text counts as empty and has no findings; ids may be null or repeated (one row for each input
row); other columns are ignored; an empty table gives an empty result. Spans are code points, end exclusive, of the
whole match; matches that fail a rule's minimum are dropped after matching, so they still take up their text.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lantern.llm.common import is_small, written


def either_case(word: str) -> str:
    """The word with ASCII letters in either case, without a flag that folds others."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    """pattern: leftmost non-overlapping matches; least: code points that group `group` needs."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int


_names = "|".join(map(either_case, ("password", "passwd", "secret", "token"))) + "|" + either_case("api") + "_?" + either_case("key")
RULES = (
    Rule("assign", 1, rf"""({_names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", 1, r"[0-9a-f]{32,}", 0, 32),  # as [0-9a-f]+ of 32 or more: runs are maximal either way
)
SPANS = "array<struct<at:int,ord:int,kind:string,stop:int>>"
#: Tasks that the paths of one blob are dealt to; only blobs with findings are repeated so often.
SALTS = 32
LEDGER = "blob binary, kind string, version int, spans " + SPANS


def salt_of(id_col: str) -> Column:
    return F.pmod(F.xxhash64(F.col(id_col)), F.lit(SALTS)).cast("int")


def pieces_of(text: Column, rule: Rule) -> Column:
    """What lies between matches (p), each match (m) and the group that counts (g)."""
    found = lambda g: F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(g))
    return F.arrays_zip(F.split(text, rule.pattern, -1).alias("p"), found(0).alias("m"), found(rule.group).alias("g"))


def versions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """path, text, blob: each version with its content address."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("path"), text.alias("text")).withColumn("blob", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))


def unseen(paths: DataFrame, ledger: DataFrame | None, rules=RULES) -> DataFrame:
    """blob, text and `todo`, the kinds of rules whose version the ledger hasn't for that blob; each blob once."""
    kinds = [r.kind for r in rules]
    blobs = paths.groupBy("blob").agg(F.first("text").alias("text"))
    if ledger is None:
        return blobs.withColumn("todo", F.array(*map(F.lit, kinds)))
    current = F.lit(False)
    for r in rules:
        current = current | ((F.col("kind") == r.kind) & (F.col("version") == r.version))
    done = ledger.filter(current).groupBy("blob").agg(F.collect_set("kind").alias("done"))  # at most one for each rule
    left = paths.select("blob").distinct().join(done, "blob", "left")
    left = left.select("blob", F.array_except(F.array(*map(F.lit, kinds)), F.coalesce("done", F.array().cast("array<string>"))).alias("todo"))
    left = left.filter(F.size("todo") > 0)
    return paths.join(left, "blob", "left_semi").groupBy("blob").agg(F.first("text").alias("text")).join(left, "blob")


def scan(blobs: DataFrame, rules=RULES) -> DataFrame:
    """Ledger rows of the unseen (blob, rule) pairs, those without findings too. Places are running sums over the pieces
    of a text, a row for each, so work grows with a text's matches and not their square."""
    text, none = F.col("text"), F.array().cast("array<struct<p:string,m:string,g:string>>")
    entry = lambda k, r: F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), F.lit(k).alias("ord"), F.lit(r.least).alias("least"), F.when(F.array_contains("todo", r.kind) & text.rlike(r.pattern), pieces_of(text, r)).otherwise(none).alias("x"))
    pairs = blobs.select("blob", "todo", F.inline(F.array(*[entry(k, r) for k, r in enumerate(rules)]))).filter(F.array_contains("todo", F.col("kind")))
    each = pairs.select("blob", "kind", "version", "ord", "least", F.posexplode_outer("x").alias("pos", "x"))
    long = F.coalesce(F.length("x.m"), F.lit(0))
    stop = F.sum(F.length("x.p") + long).over(Window.partitionBy("blob", "kind", "version").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    each = each.select("blob", "kind", "version", "ord", (F.length("x.g") >= F.col("least")).alias("ok"), stop.cast("int").alias("stop"), long.alias("long"))
    span = F.struct((F.col("stop") - F.col("long")).alias("at"), "ord", "kind", "stop")
    return each.groupBy("blob", "kind", "version").agg(F.sort_array(F.collect_list(F.when(F.col("ok"), span))).cast(SPANS).alias("spans"))


def findings(ledger: DataFrame, rules=RULES) -> DataFrame:
    """blob and its spans under the current rule versions, by start, then kind as listed; blobs without any are left out."""
    current = F.lit(False)
    for r in rules:
        current = current | ((F.col("kind") == r.kind) & (F.col("version") == r.version))
    rows = ledger.filter(current & (F.size("spans") > 0))
    return rows.groupBy("blob").agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"))  # a list for each rule


def salted(found: DataFrame, salts: int = SALTS) -> DataFrame:
    """found once for each salt: paths of one blob are dealt by salt, so those of a hot blob meet its findings in many tasks."""
    return found.withColumn("_salt", F.explode(F.array([F.lit(k) for k in range(salts)])))


def by_path(paths: DataFrame, found: DataFrame) -> DataFrame:
    """path and spans (empty if none) for every path."""
    dealt = paths.select("path", "blob", salt_of("path").alias("_salt"))
    return dealt.join(salted(found), ["blob", "_salt"], "left").select("path", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"))


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ledger: DataFrame | None = None, rules=RULES) -> DataFrame:
    """path and spans of every row, with what the ledger has taken as seen."""
    paths = versions(docs, id_col, text_col)
    new = scan(unseen(paths, ledger, rules), rules)
    return by_path(paths, findings(new if ledger is None else new.unionByName(ledger.select(*new.columns)), rules))


def scan_through(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """path and spans of every row, all read back from the ledger in folder after it has been brought up to date."""
    update_ledger(docs.sparkSession, docs, folder, id_col, text_col, rules)
    return by_path(versions(docs, id_col, text_col), findings(read_ledger(docs.sparkSession, folder), rules))


def update_ledger(spark: SparkSession, docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> int:
    """Scan what the ledger in folder hasn't seen and add it there as a new part; returns how many pairs were scanned.

    A part is written under a new name in one job, so a run that is lost leaves the ledger as it was.
    """
    old = read_ledger(spark, folder) if _there(spark, folder) else None
    part = f"{folder.rstrip('/')}/part={uuid.uuid4().hex}"
    scan(unseen(versions(docs, id_col, text_col), old, rules), rules).write.parquet(part)  # old is None: nothing to look up
    return spark.read.parquet(part).count()


def _there(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """All parts; empty where there is none yet."""
    if not _there(spark, folder):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER + ", part string").parquet(folder).drop("part")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]", rules=RULES) -> DataFrame:
    """docs with each found span (overlapping ones as one) replaced by mark; same columns and rows.

    Spans come from the ledger scan; texts with findings are few, so they alone are cut up. Findings that are small when
    written go to the texts; others meet them by a join, the copies of a text in many tasks.
    """
    paths = versions(docs, id_col, text_col)
    found = written(findings(scan(unseen(paths, None, rules), rules), rules).select(F.col("blob").alias("_blob"), F.col("spans").alias("_spans")), "findings")
    key = F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(text: Column):
        def inner(acc: Column, x: Column) -> Column:
            before = F.substring(text, acc["at"] + 1, F.greatest(x["at"] - acc["at"], F.lit(0)))
            out = F.when(x["at"] >= acc["at"], F.concat(acc["out"], before, F.lit(mark))).otherwise(acc["out"])
            return F.struct(F.greatest(acc["at"], x["stop"]).alias("at"), out.alias("out"))

        return inner

    text = F.col(text_col)
    cut = F.aggregate(F.col("_spans"), start, step(text), lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    rows = docs.withColumn("_blob", key)
    joined = rows.join(F.broadcast(found), "_blob", "left") if is_small(found) else rows.withColumn("_salt", salt_of(id_col)).join(salted(found), ["_blob", "_salt"], "left")
    return joined.withColumn(text_col, F.when(F.col("_spans").isNotNull(), cut).otherwise(text)).select(*docs.columns)


def digest(spans: DataFrame) -> DataFrame:
    """doc_id, counts by kind, base_sha256 and the joined spans."""
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["kind"], x["at"].cast("string"), x["stop"].cast("string"))), ",")
    return spans.select(F.col("path").alias("doc_id"), count("assign"), count("access"), count("hex"), F.sha2(joined.cast("binary"), 256).alias("base_sha256"), joined.alias("spans"))
