"""URL rules by a sort-merge range join (DataFrame functions only).

A host turns into a canonical key of its labels in reverse order, each closed by '/', which no host
can hold: all subdomains of a rule's host then lie in one interval of keys. Rules become events, one
where their interval opens and one where it closes, each carrying the state that holds from there
on: the stack of open rules. Events and addresses are dealt out by key range and sorted, and each
address takes the state of the last event before it. A block of the range begins with the state the
blocks before it ended in, so neither a hot host nor one huge interval falls to a single task.

Hosts are swept first and give each address the nested rule hosts around it; a second sweep over
(rule host, path) finds the innermost path rule of each of these. The longest rule wins: most
characters of host and path together, then the longer host, then block before allow.

Defined cases: null urls and urls without '://' have an empty host and path, and only rules with an
empty host can fit them. Repeated rows are judged alike and all returned. Null rule parts count as
empty, rules without a verdict are ignored. Extra columns are ignored. Empty tables give empty or
default results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlake.llm.common import ascii_lower, stored

CLOSE, OPEN, POINT = 0, 1, 2


def host_of(url: Column) -> Column:
    """After the first '://' up to '/', '?', '#' or the end; A-Z in lower case."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host, up to '?', '#' or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """'a.example.net' -> 'net/example/a/'; the empty host -> ''."""
    labels = F.concat(F.array_join(F.reverse(F.split(host, "[.]")), "/"), F.lit("/"))
    return F.when(host == "", F.lit("")).otherwise(labels)


def ancestors(key: Column) -> Column:
    """Keys of a host key's parents and itself, shortest first, with '' as the root."""
    labels = F.split(key, "/")
    own = F.transform(
        F.sequence(F.lit(1), F.size(labels) - 1),
        lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "/"), F.lit("/")),
    )
    nothing = F.array().cast("array<string>")
    return F.concat(F.array(F.lit("")), F.when(key != "", own).otherwise(nothing))


def under(host: Column, path: Column) -> Column:
    """Key of a path below a rule host; neither can hold '?'."""
    return F.concat(host, F.lit("?"), path)


def sweep(points: DataFrame, events: DataFrame) -> DataFrame:
    """Give each point the state of the last event at or before its key.

    `points` has `key` and its own columns; `events` has `key`, `kind` (CLOSE or OPEN) and `state`.
    Keys are compared byte by byte.
    """
    own = [c for c in points.columns if c != "key"]
    state_type = events.schema["state"].dataType
    key = F.col("key").cast("binary").alias("key")
    rows = points.select(key, F.lit(POINT).alias("kind"), F.lit(None).cast(state_type).alias("state"), F.struct(*own).alias("own"))
    marks = events.select(key, "kind", "state", F.lit(None).cast(rows.schema["own"].dataType).alias("own"))
    # the hash splits a hot key over several blocks; at one key events still come first
    spread = F.when(F.col("kind") == POINT, F.xxhash64("own"))
    order = ["key", "kind", "spread"]
    blocks = stored(
        rows.unionByName(marks)
        .withColumn("spread", spread)
        .repartitionByRange(*order)
        .withColumn("block", F.spark_partition_id()),
        "sweep",
    )
    # what each block leaves open: one row per block, so the running pass over them is short
    left_open = (
        blocks.filter(F.col("kind") != POINT)
        .groupBy("block")
        .agg(F.max_by("state", F.struct("key", "kind")).alias("left_open"), F.lit(True).alias("any"))
    )
    all_blocks = blocks.select("block").distinct().join(left_open, "block", "left")
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = all_blocks.select(
        "block", F.last(F.when(F.col("any"), F.struct("left_open")), ignorenulls=True).over(before).alias("carried")
    )
    running = Window.partitionBy("block").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = F.last(F.when(F.col("kind") != POINT, F.struct("state")), ignorenulls=True).over(running)
    swept = blocks.withColumn("seen", seen).filter(F.col("kind") == POINT).join(F.broadcast(carried), "block")
    state = F.when(F.col("seen").isNotNull(), F.col("seen.state")).otherwise(F.col("carried.left_open"))
    return swept.select("key", *[F.col(f"own.{c}").alias(c) for c in own], state.alias("state"))


def host_events(rule_hosts: DataFrame) -> DataFrame:
    """Events of the distinct rule hosts (`key`); the state is the stack of rule hosts open after it."""
    around = rule_hosts.select("key", F.explode(ancestors(F.col("key"))).alias("outer_key"))
    known = rule_hosts.select(F.col("key").alias("outer_key"))
    stacks = around.join(known, "outer_key").groupBy("key").agg(
        F.array_sort(F.collect_set("outer_key")).alias("stack")
    )
    opened = stacks.select("key", F.lit(OPEN).alias("kind"), F.col("stack").alias("state"))
    # '0' follows '/', so 'net/example0' lies behind every 'net/example/...'; the root never closes
    closed = stacks.filter("key <> ''").select(
        F.expr("concat(substring(key, 1, length(key) - 1), '0')").alias("key"),
        F.lit(CLOSE).alias("kind"),
        F.array_except("stack", F.array("key")).alias("state"),
    )
    return opened.unionByName(closed)


def path_events(rules: DataFrame) -> DataFrame:
    """Events of the rules (`key`: rule host and path; `rule`); the state is the innermost rule."""
    taken = F.explode(F.sequence(F.lit(0), F.length("rule.path") - 1)).alias("taken")
    shorter = rules.filter("rule.path <> ''").select("key", "rule.*", taken)
    begin = F.expr("substring(path, 1, taken)")
    shorter = shorter.select("key", "taken", under(F.col("host_key"), begin).alias("outer_key"))
    outer = rules.select(F.col("key").alias("outer_key"), F.col("rule").alias("outer_rule"))
    parents = (
        shorter.join(outer, "outer_key").groupBy("key").agg(F.max_by("outer_rule", "taken").alias("parent"))
    )
    nested = rules.join(parents, "key", "left")
    opened = nested.select(
        F.col("key").cast("binary").alias("key"), F.lit(OPEN).alias("kind"), F.col("rule").alias("state")
    )
    # no UTF-8 text has a byte FF, so this lies behind all that begins with the key
    behind = F.concat(F.col("key").cast("binary"), F.lit(b"\xff"))
    closed = nested.select(behind.alias("key"), F.lit(CLOSE).alias("kind"), F.col("parent").alias("state"))
    return opened.unionByName(closed)


def judge(
    pages: DataFrame,
    rules: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    default: str = "allow",
) -> DataFrame:
    """One row per page: its id, host, path, rule (host and path as text, or null) and verdict."""
    source = pages.select(
        F.col(page_id).alias(page_id), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")
    )
    host = ascii_lower(F.coalesce("host", F.lit("")))
    clean = (
        rules.filter("verdict is not null")
        .groupBy(host.alias("host"), F.coalesce("path", F.lit("")).alias("path"))
        .agg(F.max("verdict").alias("verdict"))  # 'block' > 'allow'
        .withColumn("host_key", host_key(F.col("host")))
    )
    # equal addresses are judged once
    places = source.select("host", "path").distinct().withColumn("key", host_key(F.col("host")))
    by_host = sweep(places, host_events(clean.select(F.col("host_key").alias("key")).distinct()))
    # one row per address and rule host around it; at most one more than the host has labels
    inner = by_host.select("host", "path", F.explode("state").alias("rule_host"))
    points = inner.select("host", "path", under(F.col("rule_host"), F.col("path")).alias("key"))
    whole = F.struct("host", "path", "verdict", "host_key").alias("rule")
    by_path = sweep(points, path_events(clean.select(under(F.col("host_key"), F.col("path")).alias("key"), whole)))
    text = F.concat("state.host", "state.path")
    rank = F.struct(F.length(text), F.length("state.host"), F.col("state.verdict"))
    fits = (
        by_path.filter("state is not null")
        .groupBy("host", "path")
        .agg(F.max_by(F.struct(text.alias("rule"), "state.verdict"), rank).alias("best"))
    )
    return source.join(fits, ["host", "path"], "left").select(
        page_id,
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
