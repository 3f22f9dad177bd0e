"""Secret scans with an incremental blob ledger.

Every version of every path is addressed by the SHA-256 of its text (its blob).  A ledger on
shared storage holds the (blob, rule, rule version) pairs that have been scanned and what was
found.  A run scans only pairs the ledger lacks, each blob once however many paths hold it,
appends to the ledger, and joins the findings back to all paths.

Defined cases: null text is an empty text (its blob is that of ""); repeated rows give
repeated results; an empty table gives no rows; a rule whose version is raised is scanned
again; a rule that is no longer asked for is not reported; a pair that overlapping runs have
scanned twice is reported once.  Spans are code points, end exclusive.  Other columns are left behind.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import staging_path
from .common import key_and_text, utf8_texts


@dataclass(frozen=True)
class Rule:
    """A kind of secret: leftmost non-overlapping matches of ``pattern`` whose ``group`` has
    ``shortest`` characters or more.  ``hints``: lower-case strings of which a text holds one
    if it has a match (none: always look)."""

    name: str
    version: int
    pattern: str
    shortest: int = 1
    group: int = 0
    flags: int = re.ASCII
    hints: tuple[str, ...] = ()


# The base kinds.  A run of [0-9a-f] or an AKIA run is matched whole or not at
# all, so the length condition is part of the pattern; for `assign` it must not be, since a
# match that is too short still takes its characters.
BASE_RULES = (
    Rule("assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         12, 2, re.ASCII | re.IGNORECASE, ("password", "passwd", "secret", "token", "apikey", "api_key")),
    Rule("access", 1, r"AKIA[A-Z0-9]{14,}", hints=("akia",)),
    Rule("hex", 1, r"[0-9a-f]{16,}"),
)
# Kinds added by this operator.
MORE_RULES = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", hints=("private key-----",)),
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", hints=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", hints=("eyj",)),
)
RULES = BASE_RULES + MORE_RULES

SPANS = "array<struct<rule:string,start:int,end:int>>"
FOUND = "array<struct<rule:string,version:int,start:int,end:int>>"


def find(text: str, rules: tuple[Rule, ...]) -> list[dict]:
    """All spans of ``rules`` in one text."""
    lower = text.lower()
    spans = []
    for rule in rules:
        if rule.hints and not any(h in lower for h in rule.hints):
            continue
        for m in re.compile(rule.pattern, rule.flags).finditer(text):
            if len(m[rule.group]) >= rule.shortest:
                spans.append({"rule": rule.name, "version": rule.version, "start": m.start(), "end": m.end()})
    return spans


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, text, todo: names of unseen rules) to (blob, todo, found)."""
    found_type = pa.list_(pa.struct([("rule", pa.string()), ("version", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            todo = batch.column("todo").to_pylist()
            found = [find(text.decode(), tuple(r for r in rules if r.name in names))
                     for text, names in zip(utf8_texts(batch.column("text")), todo)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("blob"), pa.array(todo, pa.list_(pa.string())), pa.array(found, found_type)],
                ["blob", "todo", "found"])

    return blobs.select("blob", "text", "todo").mapInArrow(scan, f"blob string, todo array<string>, found {FOUND}")


class Ledger:
    """What has been scanned, one row for each run that scanned a blob: (blob, seen: the
    rule-version pairs, found).  Appended to, never rewritten."""

    SCHEMA = f"blob string, seen array<string>, found {FOUND}"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.path = spark, f"{root.rstrip('/')}/scans"

    def read(self) -> DataFrame:
        try:
            return self.spark.read.schema(self.SCHEMA).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.SCHEMA)

    def append(self, scanned: DataFrame) -> None:
        scanned.write.mode("append").parquet(self.path)


# The session setting that names a lasting ledger; without it every call begins a new one.
LEDGER_SETTING = "farebox.secrets.ledger"


def session_ledger(spark: SparkSession) -> Ledger:
    """The ledger that the session names, or a new one in the shared folder."""
    return Ledger(spark, spark.conf.get(LEDGER_SETTING, None) or staging_path(spark, "secret-ledger"))


def pair(rule: Rule) -> str:
    return f"{rule.name}@{rule.version}"


def update_ledger(versions: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> None:
    """Scan the unseen pairs of ``versions`` (doc_id, text) and append them.

    Which blobs are new is decided on narrow rows (one path stands for all that hold the
    blob); only then are their texts fetched, by blob and path, so that a blob which a third
    of all paths hold does not gather in one task.
    """
    addressed = versions.withColumn("blob", F.sha2("text", 256))
    held = addressed.groupBy("blob").agg(F.min("doc_id").alias("_path"))
    seen = ledger.read().groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("seen"))).alias("_seen"))
    wanted = F.filter(F.lit([pair(r) for r in rules]),
                      lambda p: ~F.array_contains(F.coalesce("_seen", F.array().cast("array<string>")), p))
    todo = held.join(seen, "blob", "left").select(
        "blob", "_path", F.transform(wanted, lambda p: F.substring_index(p, "@", 1)).alias("todo")
    ).where(F.size("todo") > 0)
    texts = addressed.alias("a").join(
        todo.alias("t"),
        (F.col("a.blob") == F.col("t.blob")) & F.col("a.doc_id").eqNullSafe(F.col("t._path")),
    ).select("a.blob", "a.text", "t.todo")
    version_of = F.create_map(*[F.lit(x) for r in rules for x in (r.name, pair(r))])
    scanned = scan_blobs(texts, rules).dropDuplicates(["blob"])  # a repeated row is scanned with its path
    ledger.append(scanned.select("blob", F.transform("todo", lambda n: version_of[n]).alias("seen"), "found"))


def ordered_spans(ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, found) of every blob in the ledger that holds spans of ``rules``: by start, then
    rule as listed."""
    order = F.lit([r.name for r in rules])
    current = F.lit([pair(r) for r in rules])

    def asked(x: Column) -> Column:
        return F.array_contains(current, F.concat_ws("@", x["rule"], x["version"].cast("string")))

    all_spans = ledger.read().where(F.size("found") > 0).groupBy("blob").agg(
        F.array_distinct(F.flatten(F.collect_list("found"))).alias("all"))  # overlapping runs scan a pair twice
    ordered = F.transform(
        F.array_sort(F.transform(F.filter("all", asked), lambda x: F.struct(
            x["start"].alias("start"), F.array_position(order, x["rule"]).alias("nth"), x["end"].alias("end"), x["rule"].alias("rule")))),
        lambda x: F.struct(x["rule"].alias("rule"), x["start"].alias("start"), x["end"].alias("end")))
    return all_spans.select("blob", ordered.cast(SPANS).alias("found"))


def findings(versions: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, blob, found) for every row of ``versions``."""
    return versions.select("doc_id", F.sha2("text", 256).alias("blob")).join(
        ordered_spans(ledger, rules), "blob", "left").select(
        "doc_id", "blob", F.coalesce("found", F.array().cast(SPANS)).alias("found"))


def scan_documents(docs: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Bring the ledger up to date with ``docs`` and report every row's spans."""
    versions = key_and_text(docs, id_col, text_col)
    update_ledger(versions, ledger, rules)
    return findings(versions, ledger, rules)


def spans_text(found: Column) -> Column:
    """``rule:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(
        ":", x["rule"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact_documents(docs: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES, mark: str = "[secret]",
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every span in ``text_col`` replaced by ``mark`` (overlapping spans by
    one); every other column and row stays as it is."""
    update_ledger(key_and_text(docs, id_col, text_col), ledger, rules)
    spans = ordered_spans(ledger, rules)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.sha2(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), 256).alias("blob")).join(spans, "blob", "left")
    text = F.col(f"row.`{text_col}`")

    def cut(state: Column, x: Column) -> Column:
        fresh = F.concat(state["out"], text.substr(state["at"] + 1, x["start"] - state["at"]), F.lit(mark))
        return F.struct(F.greatest(state["at"], x["end"]).alias("at"),
                        F.when(x["start"] >= state["at"], fresh).otherwise(state["out"]).alias("out"))

    clean = F.aggregate("found", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), cut,
                        lambda s: F.concat(s["out"], text.substr(s["at"] + 1, F.length(text))))
    return rows.select(*[(F.when(F.size("found") > 0, clean).otherwise(text) if c == text_col else F.col(f"row.`{c}`")).alias(c)
                         for c in docs.columns])
