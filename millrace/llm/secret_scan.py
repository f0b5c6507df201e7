"""Secret scans over an incremental blob ledger. DataFrame functions only.

A text is addressed by the SHA-256 of its content, its blob. The ledger has one row per blob and
scan: the rule versions scanned and what they found. A run scans only pairs of blob and rule version that
the ledger lacks, each blob once however many paths or versions hold it, and appends them. Findings are
joined back to every path from the ledger.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import text_or_empty, wide_join
from millrace.operators import lookup_join
from millrace.sources import materialise

_FINDINGS = "array<struct<rule: string, start: int, end: int>>"
#: Matches of a text that are gathered at a time.
BLOCK = 256
LEDGER_SCHEMA = f"blob string, rules array<string>, findings {_FINDINGS}"


@dataclass(frozen=True)
class Rule:
    """A pattern; matches whose ``group`` has fewer than ``least`` characters are dropped."""

    name: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0

    @property
    def id(self) -> str:
        return f"{self.name}@{self.version}"


#: Fixed patterns of the three kinds, in their order. A run of the classes of "access" and "hex" is taken
#: whole or not at all, so their least lengths can be part of the pattern.
RULES = (
    Rule(
        "assign", 1,
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2, least=6,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
)


def match_spans(text: Column, rule: Rule) -> Column:
    """Array of (start, end) of the rule's leftmost non-overlapping matches, in code points.

    The text between matches and the matches themselves, in turn, give the positions.
    """
    pattern = F.lit(rule.pattern)
    gaps, found = F.split(text, rule.pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    checked = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    steps = F.zip_with(
        F.slice(gaps, F.lit(1), F.size(found)),
        F.zip_with(found, checked, lambda m, g: F.struct(F.length(m).alias("size"), F.length(g).alias("checked"))),
        lambda gap, m: F.struct(F.length(gap).alias("gap"), m["size"].alias("size"), m["checked"].alias("checked")),
    )
    none = F.array().cast("array<struct<start: int, end: int>>")
    return F.when(F.regexp_like(text, pattern), _running_spans(steps, rule.least)).otherwise(none)


def _running_spans(steps: Column, least: int) -> Column:
    """The spans of the steps (gap, size, checked) whose ``checked`` is ``least`` or more.

    An array that grows is copied with each element, so the steps are cut into blocks of :data:`BLOCK`:
    the blocks' lengths give where each begins, and spans are gathered block by block.
    """
    kind = "array<struct<start: int, end: int>>"

    def length(block: Column) -> Column:
        return F.aggregate(block, F.lit(0), lambda at, s: at + s["gap"] + s["size"])

    def starts(blocks: Column) -> Column:
        zero = F.array(F.lit(0))
        upto = F.aggregate(blocks, zero, lambda at, b: F.concat(at, F.array(F.element_at(at, -1) + length(b))))
        return F.slice(upto, F.lit(1), F.size(blocks))

    def step(acc: Column, s: Column) -> Column:
        begin = acc["at"] + s["gap"]
        end = begin + s["size"]
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        kept = F.when(s["checked"] >= least, F.concat(acc["out"], span)).otherwise(acc["out"])
        return F.struct(end.alias("at"), kept.alias("out"))

    def spans(block: Column, start: Column) -> Column:
        first = F.struct(start.alias("at"), F.array().cast(kind).alias("out"))
        return F.aggregate(block, first, step, lambda acc: acc["out"])

    def blocks(steps: Column) -> Column:
        last = F.greatest(F.floor((F.size(steps) - 1) / BLOCK), F.lit(0)).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(steps, i * BLOCK + 1, F.lit(BLOCK)))

    return _once(_once(steps, blocks), lambda b: F.flatten(F.zip_with(b, starts(b), spans)))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), 0)


def _with_blob(versions: DataFrame, text: str) -> DataFrame:
    return versions.withColumn("blob", F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def scan_unseen(
    versions: DataFrame, paths: Sequence[str], ledger: DataFrame | None = None,
    rules: Sequence[Rule] = RULES, text: str = "text",
) -> DataFrame:
    """New ledger rows for the pairs of blob and rule version that ``ledger`` lacks.

    ``versions`` has a text per historical version; the columns ``paths`` name it. A null text is
    an empty blob. Repeated versions are scanned once.
    """
    all_rules = F.array(*[F.lit(r.id) for r in rules])
    named = _with_blob(versions, text)
    # One version stands for a blob. Only hashes and names are grouped, no texts.
    first = F.struct(*paths)
    blobs = named.select("blob", first.alias("path")).groupBy("blob").agg(F.min("path").alias("path"))
    if ledger is None:
        todo = blobs.withColumn("todo", all_rules)
    else:
        seen = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
        left = F.array_except(all_rules, F.coalesce("seen", F.array().cast("array<string>")))
        todo = blobs.join(seen, "blob", "left").withColumn("todo", left)
    todo = materialise(todo.where(F.size("todo") > 0).select("path.*", "blob", "todo"))
    texts = wide_join(named.select(*paths, "blob", F.col(text).alias("text")), todo, [*paths, "blob"], "inner")
    content = text_or_empty()

    def findings(rule: Rule) -> Column:
        named = F.transform(
            match_spans(content, rule),
            lambda s: F.struct(F.lit(rule.name).alias("rule"), s["start"].alias("start"), s["end"].alias("end")),
        )
        none = F.array().cast(_FINDINGS)
        return F.when(F.array_contains("todo", rule.id), named).otherwise(none)

    found = [findings(r) for r in rules]
    scanned = texts.select("blob", F.col("todo").alias("rules"), F.concat(*found).alias("findings"))
    return scanned.dropDuplicates(["blob"])


def find_secrets(
    versions: DataFrame, paths: Sequence[str], ledger_path: str,
    rules: Sequence[Rule] = RULES, text: str = "text",
) -> DataFrame:
    """Scan what the ledger at ``ledger_path`` lacks, append it, and report on every version.

    Returns ``paths``, blob and findings (rule, start, end; by start, then in the order of ``rules``), one row
    per row of ``versions``. The ledger is created if there is none.
    Versions without secrets have an empty list, as have null and empty texts. Repeated versions are rows like
    any other; ledger rows that are there twice change nothing. Very long texts take time in proportion to their
    length and matches. An empty table gives an empty one; further columns are ignored, whatever their names,
    except that a path may not be called ``blob``, which is refused.
    """
    if "blob" in paths:
        raise ValueError("blob is the name of a result column; rename the path")
    spark = versions.sparkSession
    # An empty append makes the ledger exist, whatever store it is in.
    kinds = [c.split(" ", 1) for c in ("blob string", "rules array<string>", f"findings {_FINDINGS}")]
    nothing = spark.range(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in kinds])
    nothing.write.mode("append").parquet(ledger_path)
    ledger = spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path)
    fresh = ledger.isEmpty()
    new = scan_unseen(versions, paths, None if fresh else ledger, rules, text)
    new.write.mode("append").parquet(ledger_path)
    ledger = spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path)
    # The scans of one blob: as many as rule versions at most.
    merged = ledger.groupBy("blob").agg(F.flatten(F.collect_list(_valid(rules))).alias("findings"))
    names = F.array(*[F.lit(r.name) for r in rules])
    order = F.transform(
        "findings",
        lambda f: F.struct(
            f["start"].alias("start"), F.array_position(names, f["rule"]).alias("kind"), f.alias("finding")
        ),
    )
    # A scan that was appended twice, by overlapping runs or a retry, changes nothing.
    single = _once(F.array_sort(order), lambda s: F.filter(s, lambda x, i: (i == 0) | (x != F.get(s, i - 1))))
    ordered = F.transform(single, lambda o: o["finding"])
    merged = materialise(merged.select("blob", ordered.alias("findings")))
    return lookup_join(_with_blob(versions, text).select(*paths, "blob"), merged, ["blob"])


def _valid(rules: Sequence[Rule]) -> Column:
    """A scan's findings of rules whose current version it ran."""
    ids = F.create_map(*[c for r in rules for c in (F.lit(r.name), F.lit(r.id))])
    return F.filter(
        "findings", lambda f: F.coalesce(F.array_contains(F.col("rules"), ids[f["rule"]]), F.lit(False))
    )


def span_text(findings: Column) -> Column:
    """``kind:start:end`` of each finding, joined by commas."""
    return F.array_join(
        F.transform(findings, lambda f: F.concat_ws(":", f["rule"], f["start"].cast("string"), f["end"].cast("string"))), ","
    )
