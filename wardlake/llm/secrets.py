"""Secret scan with an incremental blob ledger.

Every version of every path is addressed by the sha256 of its text. The ledger holds one row per
blob and scan: the rule versions that were applied and what they found. A scan takes the blobs of the
given versions, looks up which (blob, rule version) pairs the ledger lacks, reads each such blob
once, appends the outcome to the ledger and joins all findings back to all paths. A changed rule has
another version, so only that rule runs again.

Ledger rows are appended as whole Parquet files when their job commits; a scan that dies leaves no
row, and the next one takes up its blobs.

Defined cases: a null text is the empty blob and has no findings. Repeated rows are judged alike and
all returned; null ids are returned as they are. Extra columns are ignored. Positions are code points,
the end is exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.llm.common import BROADCAST_ROWS, stored
from wardlake.llm.flat import release_memory
from wardlake.session import unused

FINDINGS = "array<struct<kind:string,start:int,stop:int>>"
LEDGER = f"blob binary, rules array<string>, findings {FINDINGS}"


@dataclass(frozen=True)
class Rule:
    """Matches of `pattern`, leftmost and non-overlapping, whose `group` has `least` characters."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    any_case: bool = False
    hints: tuple[str, ...] = ()  # a text without any of these in lower case cannot match

    @property
    def key(self) -> str:
        """Kind and version; the version follows from all that decides the findings."""
        spec = f"{self.pattern}\0{self.least}\0{self.group}\0{self.any_case}"
        return f"{self.kind}@{hashlib.sha256(spec.encode()).hexdigest()[:12]}"


# The order is the order of kinds where spans begin together.
RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        6,
        2,
        True,
        ("passw", "secret", "token", "api"),
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 20, hints=("akia",)),
    Rule("hex", r"[0-9a-f]{24,}"),
    # from the last of several marks of a beginning: a text of nothing but such marks is read once
    Rule(
        "pem",
        r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:(?!-----BEGIN )[\s\S])*?-----END [A-Z ]*PRIVATE KEY-----",
        hints=("-----begin",),
    ),
    # these begin where a run of their characters does: a long run is tried once, not at each of its places
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", hints=(".eyj",)),
    Rule("hosting", r"gh[pousr]_[A-Za-z0-9]{36,}", hints=("gh",)),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", hints=("xox",)),
    Rule("login", r"(?<![A-Za-z0-9+.-])[a-z][a-z0-9+.-]{0,31}://[^\s/:@]+:[^\s/:@]+@", hints=("://",)),
)
BASE_KINDS = ("assign", "access", "hex")


def find(text: str, rules: list[Rule]) -> list[tuple[str, int, int]]:
    """(kind, start, stop) of all findings, by start and then by the order of the rules."""
    lowered = text.lower()
    found = []
    for order, rule in enumerate(rules):
        if rule.hints and not any(hint in lowered for hint in rule.hints):
            continue
        # with ASCII, either case means A-Z and a-z only
        flags = re.ASCII | re.IGNORECASE if rule.any_case else 0
        for m in re.compile(rule.pattern, flags).finditer(text):
            if len(m[rule.group]) >= rule.least:
                found.append((m.start(), order, m.end(), rule.kind))
    return [(kind, start, stop) for start, _, stop, kind in sorted(found)]


def blob_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def read_ledger(spark, ledger: str) -> DataFrame:
    """All scans so far; empty where there was none."""
    try:
        return spark.read.schema(LEDGER).parquet(ledger)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], LEDGER)


def scan_unseen(versions: DataFrame, ledger: str, text: str, rules: tuple[Rule, ...]) -> None:
    """Scan every (blob, rule version) pair the ledger lacks and append the outcome to it."""
    spark = versions.sparkSession
    done = read_ledger(spark, ledger).groupBy("blob").agg(F.flatten(F.collect_list("rules")).alias("done"))
    content = F.coalesce(F.col(text), F.lit(""))
    # copies are dropped before the shuffle and once more after it
    blobs = versions.select(blob_of(F.col(text)).alias("blob"), content.alias("text")).dropDuplicates(["blob"])
    wanted = F.array(*[F.lit(r.key) for r in rules])
    todo = blobs.join(done, "blob", "left").withColumn(
        "rules", F.array_except(wanted, F.coalesce("done", F.array().cast("array<string>")))
    )
    by_key = {r.key: r for r in rules}
    schema = pa.schema(
        [
            ("blob", pa.binary()),
            ("rules", pa.list_(pa.string())),
            ("findings", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))),
        ]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("rules").to_pylist()
            rows = [
                [dict(zip(("kind", "start", "stop"), f)) for f in find(body, [by_key[k] for k in own])]
                for body, own in zip(batch.column("text").to_pylist(), keys)
            ]
            findings = pa.array(rows, schema.field("findings").type)
            yield pa.RecordBatch.from_arrays([batch.column("blob"), batch.column("rules"), findings], schema=schema)
        release_memory()

    unseen = todo.filter(F.size("rules") > 0).select("blob", "text", "rules")
    unseen.mapInArrow(scan, LEDGER).write.mode("append").parquet(ledger)


def findings_by_blob(versions: DataFrame, ledger: str, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, findings) of all blobs with findings of the given kinds, in order."""
    kinds = [r.kind for r in rules]
    order = F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col("f.kind"))
    current = F.array(*[F.lit(r.key) for r in rules])
    scans = read_ledger(versions.sparkSession, ledger)
    # findings of replaced rule versions stay in the ledger but no longer count
    rows = scans.filter(F.size("findings") > 0).select("blob", "rules", F.explode("findings").alias("f"))
    valid = rows.filter(
        F.exists("rules", lambda key: F.array_contains(current, key) & (F.substring_index(key, "@", 1) == F.col("f.kind")))
    )
    ordered = valid.select("blob", F.struct("f.start", order.alias("rank"), "f.stop", "f.kind").alias("f")).distinct()
    grouped = ordered.groupBy("blob").agg(F.array_sort(F.collect_list("f")).alias("f"))
    return grouped.select("blob", F.transform("f", lambda f: F.struct(f["kind"], f["start"], f["stop"])).cast(FINDINGS).alias("findings"))


def scan(
    versions: DataFrame,
    ledger: str,
    path: str = "doc_id",
    text: str = "text",
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """Findings of every version: its path, blob and findings (kind, start, stop), by start."""
    scan_unseen(versions, ledger, text, rules)
    rows = versions.select(F.col(path).alias(path), blob_of(F.col(text)).alias("blob"))
    found = findings_by_blob(versions, ledger, rules)
    none = F.array().cast(FINDINGS)
    return rows.join(found, "blob", "left").select(path, "blob", F.coalesce("findings", none).alias("findings"))


def redact(docs: DataFrame, ledger: str, text: str = "text", rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """The documents with every finding replaced by a mark; all other columns as they are."""
    scan_unseen(docs, ledger, text, rules)
    found = stored(findings_by_blob(docs, ledger, rules), "findings")
    # a row is as large as its findings, so these are counted
    if (found.agg(F.sum(F.size("findings"))).first()[0] or 0) <= BROADCAST_ROWS:
        found = F.broadcast(found)
    body = F.col(f"`{text}`")
    blob, findings = unused(docs, "blob", "findings")
    found = found.select(F.col("blob").alias(blob), F.col("findings").alias(findings))
    joined = docs.join(found, blob_of(body) == F.col(blob), "left")
    # spans that overlap get one mark
    step = F.aggregate(
        findings,
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda acc, f: F.struct(
            F.when(
                f["start"] >= acc["at"],
                F.concat(acc["out"], F.substring(body, acc["at"] + 1, f["start"] - acc["at"]), F.lit(mark)),
            )
            .otherwise(acc["out"])
            .alias("out"),
            F.greatest(acc["at"], f["stop"]).alias("at"),
        ),
    )
    clean = F.when(F.col(findings).isNull(), body).otherwise(
        F.concat(step["out"], F.substring(body, step["at"] + 1, F.length(body)))
    )
    return joined.withColumn(text, clean).select(*[F.col(f"`{c}`") for c in docs.columns])
