"""Secret scans over a ledger of content-addressed blobs.

Every version of every path is addressed by the SHA-256 of its text. A ledger holds, for each pair of blob and rule
version ever scanned, the spans found. A run scans one copy of each blob whose pair the ledger lacks, appends what it
found, and joins the findings back to all paths that hold the blob. All of it is DataFrame work inside the JVM.

Defined cases: null text is empty text and holds nothing; a null path is kept as a row of its own; repeated rows each
get their findings; an empty table gives no rows and leaves the ledger as it is. Columns beside path and text are
neither read nor returned.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Rule:
    """A kind of secret: all leftmost non-overlapping matches whose group has the least length."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# Forms of secrets. The first three are the base rules; where a long run must be maximal, the least
# length stands in the pattern, which finds the same spans as matching any length and dropping the short ones.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{20,}"),
    Rule("cloud", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULE_VERSION = "1"
BASE = ("assign", "access", "hex")

SPANS = T.ArrayType(T.StructType([T.StructField(n, T.IntegerType()) for n in ("start", "kind", "end")]))
LEDGER = T.StructType(
    [T.StructField("blob", T.StringType()), T.StructField("rule_version", T.StringType()), T.StructField("findings", SPANS)]
)


def spans(text: Column, rule: Rule, kind: int) -> Column:
    """Spans of one rule, in code points, end exclusive.

    What lies between the matches and the matches themselves alternate, so their lengths give the places.
    """
    span = "struct<start:int,kind:int,end:int>"
    nothing = F.array().cast(f"array<{span}>")
    steps = F.zip_with(
        F.split(text, rule.pattern, -1),
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)),
        lambda gap, hit: F.struct(F.length(gap).alias("gap"), F.length(hit).alias("hit")),
    )
    if rule.least:
        steps = F.zip_with(
            steps,
            F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)),
            lambda s, part: F.struct(s["gap"].alias("gap"), s["hit"].alias("hit"), (F.length(part) >= rule.least).alias("ok")),
        )
    else:
        steps = F.transform(steps, lambda s: F.struct(s["gap"].alias("gap"), s["hit"].alias("hit"), F.lit(True).alias("ok")))

    def place(state: Column, step: Column) -> Column:
        start = state["at"] + step["gap"]
        end = start + step["hit"]
        found = F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end")).cast(span))
        return F.struct(end.alias("at"), F.when(step["ok"], F.concat(state["found"], found)).otherwise(state["found"]).alias("found"))

    begin = F.struct(F.lit(0).alias("at"), nothing.alias("found"))
    matched = F.filter(steps, lambda s: s["hit"].isNotNull())
    return F.when(text.rlike(rule.pattern), F.aggregate(matched, begin, place, lambda s: s["found"])).otherwise(nothing)


def scan(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """All spans of a text, by start, then by the order of the rules."""
    return F.array_sort(F.flatten(F.array(*[spans(text, r, i) for i, r in enumerate(rules)])))


class Ledger:
    """Findings by blob and rule version, as Parquet files that are only ever added to."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark, self._path = spark, path

    def _exists(self) -> bool:
        jvm = self._spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self._path)
        return path.getFileSystem(self._spark._jsc.hadoopConfiguration()).exists(path)

    def read(self, rule_version: str) -> DataFrame:
        if not self._exists():
            return self._spark.createDataFrame([], LEDGER)
        return self._spark.read.schema(LEDGER).parquet(self._path).where(F.col("rule_version") == rule_version)

    def append(self, scanned: DataFrame) -> None:
        """One job whose output is committed as a whole; a repeated run finds the pairs there and adds none."""
        scanned.write.mode("append").parquet(self._path)


def scan_versions(
    versions: DataFrame,
    ledger: Ledger,
    path: str = "doc_id",
    text: str = "text",
    rules: tuple[Rule, ...] = RULES,
    rule_version: str = RULE_VERSION,
) -> DataFrame:
    """Findings of every version: its path, its blob and the spans found in it.

    The copy of an unseen blob that is scanned is the one of the smallest path, so rows meet on blob and path together
    and a blob that a third of the paths share is not gathered anywhere.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    keyed = versions.select(F.col(path).alias("path"), content.alias("content"), F.sha2(content.cast("binary"), 256).alias("blob"))
    unseen = (
        keyed.select("blob", "path")
        .join(ledger.read(rule_version).select("blob"), "blob", "left_anti")
        .groupBy("blob")
        .agg(F.min("path").alias("path"))
    )
    one = keyed.alias("k").join(
        unseen.alias("u"), (F.col("k.blob") == F.col("u.blob")) & F.col("k.path").eqNullSafe(F.col("u.path")), "left_semi"
    )
    found = one.select("blob", F.lit(rule_version).alias("rule_version"), scan(F.col("content"), rules).alias("findings"))
    ledger.append(found.groupBy("blob", "rule_version").agg(F.first("findings").alias("findings")))
    known = ledger.read(rule_version).groupBy("blob").agg(F.first("findings").alias("findings"))
    return keyed.select("path", "blob").join(known, "blob", "left")


def listed(findings: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(
        F.transform(findings, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )


def redacted(text: Column, findings: Column, mark: str = "[SECRET]") -> Column:
    """The text with every found span, or union of overlapping spans, replaced by a mark."""

    def place(state: Column, s: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        fresh = s["start"] >= state["at"]
        first = F.concat(state["out"], gap, F.lit(mark))
        return F.struct(
            F.when(fresh, first).otherwise(state["out"]).alias("out"), F.greatest(state["at"], s["end"]).alias("at")
        )

    begin = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    whole = F.aggregate(
        findings, begin, place, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text)))
    )
    return F.when(F.size(findings) > 0, whole).otherwise(text)
