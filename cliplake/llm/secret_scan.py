"""Secret scan with an incremental blob ledger.

A blob is a text by its SHA-256. The ledger holds, for each blob and batch, the
rules (with version) that have been applied and their findings. A scan takes the
blobs of all versions of all paths, drops the pairs of blob and rule version that
the ledger has, applies the rest, appends to the ledger, and joins the findings
back to every path with that content. DataFrame functions only: match positions
come from the lengths of what a split on the pattern leaves.

Scale: text is shuffled at most once, as one row per distinct blob (combined
before the shuffle). Of the ledger only the rows of a batch's blobs go beyond the
join with their ids. Only findings join back, against (path, blob) rows; both
sides of that join are plain exchanges, so adaptive execution splits a blob that
a third of all paths share.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, shared_dir, text_of


@dataclass(frozen=True)
class Rule:
    """pattern finds candidates, leftmost and non-overlapping; a candidate whose `group` is shorter than `least` is dropped, without another try."""

    kind: str
    pattern: str
    version: int = 1
    group: int = 0
    least: int = 1


#: The first three are fixed by contract. hex and access state their least length in the pattern, which is the same
#: as dropping short matches: a run that is too short has no part that is long enough.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", group=2, least=6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
)
BASE = ("assign", "access", "hex")
#: Hits of a text whose places are added up together.
PART = 256
_FINDINGS = "array<struct<kind:string,version:int,start:int,end:int>>"
LEDGER = f"blob string, scanned array<string>, findings {_FINDINGS}"


def _tag(rule: Rule) -> str:
    return f"{rule.kind}@{rule.version}"


def _spans(text: Column, rule: Rule) -> Column:
    """Findings of one rule, in code points, end exclusive."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    tested = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    gaps = F.split(text, rule.pattern, -1)
    def step(a: Column, x: Column) -> Column:
        begin = a["at"] + x["gap"]
        end = begin + F.length(x["hit"])
        one = F.struct(F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"), begin.alias("start"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(F.length(x["test"]) >= rule.least, F.array_append(a["out"], one)).otherwise(a["out"]).alias("out"))

    def part(a: Column, some: Column) -> Column:
        """One more part: an append copies its array, so a part's array is short and the parts are few."""
        done = F.aggregate(some, F.struct(a["at"].alias("at"), F.array().cast(_FINDINGS).alias("out")), step)
        return F.transform(F.array(done), lambda d: F.struct(d["at"].alias("at"), F.array_append(a["out"], d["out"]).alias("out")))[0]

    parts = F.transform(F.slice(F.arrays_zip(found.alias("hit"), tested.alias("test"), gaps.alias("gap")), F.lit(1), F.size(found)), lambda p: F.struct(p["hit"].alias("hit"), p["test"].alias("test"), F.length(p["gap"]).alias("gap")))
    some = F.transform(F.array(parts), lambda p: F.transform(F.sequence(F.lit(0), F.floor((F.size(p) - 1) / PART).cast("int")), lambda k: F.slice(p, k * PART + 1, F.lit(PART))))[0]
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_FINDINGS}>").alias("out"))
    return F.when(text.rlike(rule.pattern), F.flatten(F.aggregate(some, start, part)["out"])).otherwise(F.array().cast(_FINDINGS))


def new_ledger(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/cliplake/ledger-{uuid.uuid4().hex}"


def update_ledger(versions: DataFrame, ledger: str, rules: tuple = RULES, text: str = "text") -> DataFrame:
    """Scan the unseen pairs of blob and rule version of `versions`; returns (blob, findings) of its blobs under these rules.

    `ledger` is a Parquet folder that may not exist yet. A blob seen before is
    scanned by the rules that it lacks only; findings of other rule versions
    stay in the ledger but are not returned."""
    spark = versions.sparkSession
    body = text_of(versions, text)
    blobs = versions.select(F.sha2(body, 256).alias("blob"), body.alias("body"))
    tags = F.array(*[F.lit(_tag(r)) for r in rules])
    try:
        old = spark.read.schema(LEDGER).parquet(ledger)
    except Exception as e:  # the folder is made by the first scan
        if "PATH_NOT_FOUND" not in str(e):
            raise
        old = None
    if old is None:
        todo = blobs.groupBy("blob").agg(F.first("body").alias("body")).withColumn("todo", tags)
    else:
        mine = cut(blobs.select(F.col("blob").alias("b")).distinct(), "batch")  # what the increment is about: of the ledger only its rows go on
        seen = old.join(mine, F.col("blob") == F.col("b"), "left_semi").groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("scanned"))).alias("scanned"))
        done = cut(seen.where(F.size(F.array_except(tags, F.col("scanned"))) == 0).select("blob"), "done")
        fresh = blobs.join(done, "blob", "left_anti").groupBy("blob").agg(F.first("body").alias("body"))
        todo = fresh.join(seen, "blob", "left").withColumn("todo", F.array_except(tags, F.coalesce("scanned", F.array().cast("array<string>")))).drop("scanned")
    findings = F.concat(*[F.when(F.array_contains("todo", _tag(r)), _spans(F.col("body"), r)).otherwise(F.array().cast(_FINDINGS)) for r in rules])
    todo.select("blob", F.col("todo").alias("scanned"), findings.alias("findings")).write.mode("append").parquet(ledger)
    now = spark.read.schema(LEDGER).parquet(ledger)
    wanted = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
    if old is not None:
        now = now.join(mine, F.col("blob") == F.col("b"), "left_semi")
    hits = now.where(F.size("findings") > 0).withColumn("f", F.explode("findings"))
    hits = hits.where(F.array_contains(wanted, F.struct("f.kind", "f.version")))
    return hits.groupBy("blob").agg(F.collect_set("f").alias("findings"))  # two scans at once may both have found it


def scan(versions: DataFrame, ledger: str, rules: tuple = RULES, path: str = "doc_id", text: str = "text") -> DataFrame:
    """path, blob, findings (sorted by start, then rule): one row per row of `versions`.

    Null texts count as empty; an empty table gives no rows and an empty ledger
    entry; repeated rows and copies each get the findings of their blob; other
    columns are not read. Texts of any length are scanned whole, in time in
    proportion to their hits."""
    found = cut(update_ledger(versions, ledger, rules, text), "findings")
    order = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)])
    ranked = F.transform("findings", lambda f: F.struct(f["start"].alias("start"), F.element_at(order, f["kind"]).alias("rank"), f["kind"].alias("kind"), f["end"].alias("end")))
    found = found.select(F.col("blob").alias("of"), F.array_sort(ranked).alias("findings"))
    paths = versions.select(versions[path].alias(path), F.sha2(text_of(versions, text), 256).alias("blob"))
    paths = paths.join(found, F.col("blob") == F.col("of"), "left").drop("of")
    return paths.withColumn("findings", F.coalesce("findings", F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")))


def digest(scanned: DataFrame) -> DataFrame:
    """The columns of the contract."""
    said = lambda a: F.array_join(F.transform(a, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")
    base = F.filter("findings", lambda f: f["kind"].isin(*BASE))
    count = lambda k: F.size(F.filter("findings", lambda f: f["kind"] == k)).cast("long").alias(f"n_{k}")
    return scanned.select("doc_id", *[count(k) for k in BASE], F.sha2(said(base), 256).alias("base_sha256"), said(F.col("findings")).alias("spans"), "blob")
