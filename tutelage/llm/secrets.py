"""Secret scans over a ledger of blobs: what was scanned once under a rule's version is never scanned again.

Every version of every path is addressed by the SHA-256 of its text. Only blobs that the ledger does not have under
a rule's current version are scanned for it; the result, empty or not, is appended to the ledger. Findings
are then joined back to all paths and versions that hold the blob. All of it is DataFrame functions.

Places come from the two halves that one pattern gives of a text, its matches and the pieces between them: a match
starts where all pieces and matches before it end.

Defined cases: a null text is an empty one and has no spans; repeated rows each get the spans of their blob; with an
empty table nothing is scanned; columns of the input other than those named are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tutelage.llm.frames import materialise

SPANS = "array<struct<start:int,rank:int,end:int,kind:string>>"


@dataclass(frozen=True)
class Rule:
    """A pattern and the least length of one of its groups; ``hint`` occurs in every text that the pattern matches."""
    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0
    hint: str = ""

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


#: Matches placed in one run: of n matches, n times this and the square of n / RUN steps are made.
RUN = 128

# The three base rules. A run of a class and a least length may be written into the pattern where no shorter
# match could hide a longer one behind it; the assignment keeps its short values, which do.
BASE = (
    Rule("assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, "(?i)(?:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]"),
    Rule("access", 1, r"AKIA[A-Z0-9]{14,}", 0, 18, "AKIA"),
    Rule("hex", 1, r"[0-9a-f]{16,}+", 0, 16, r"[0-9a-f]{16}"),
)
#: Further kinds, by the public formats of their issuers.
MORE = (
    Rule("pem", 2, r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:(?s:.*?)-----END [A-Z ]*PRIVATE KEY-----|[^-]*)", 0, 0, "PRIVATE KEY-----"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+", 0, 0, "eyJ"),
    Rule("prefixed", 1, r"(?:gh[opsur]_|glpat-|xox[abprs]-|sk_live_)[A-Za-z0-9-]{16,}+", 0, 0, "(?:gh[opsur]_|glpat-|xox[abprs]-|sk_live_)"),
)
RULES = BASE + MORE


def found(text: Column, rule: Rule, rank: int) -> Column:
    """The spans of one rule, by code points.

    Matches and the text between them are taken in runs of ``RUN``, each placed from its own start and then moved to its place, so
    that the cost of a text with many matches does not grow with their square.
    """
    whole, gaps = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), F.split(text, rule.pattern, -1)
    size = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    each = F.transform(F.arrays_zip(whole.alias("m"), F.slice(gaps, F.lit(1), F.size(whole)).alias("g"), size.alias("v")),
                       lambda x: F.struct(F.length(x["m"]).alias("m"), F.length(x["g"]).alias("g"), F.length(x["v"]).alias("v")))
    span = lambda start, end: F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(rule.kind).alias("kind"))
    none = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["g"]
        one = F.array(span(start, start + x["m"]))
        return F.struct((start + x["m"]).alias("at"), F.when(x["v"] >= rule.least, F.concat(acc["spans"], one)).otherwise(acc["spans"]).alias("spans"))

    def placed(each: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(1), F.greatest(F.size(each), F.lit(1)), F.lit(RUN)), lambda at: F.aggregate(F.slice(each, at, F.lit(RUN)), none, step))
        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<struct<at: int, spans: {SPANS}>>").alias("runs"))
        moved = F.aggregate(runs, start, lambda acc, x: F.struct((acc["at"] + x["at"]).alias("at"), F.concat(acc["runs"], F.array(F.struct(acc["at"].alias("at"), x["spans"].alias("spans")))).alias("runs")),
                            lambda acc: acc["runs"])
        return F.flatten(F.transform(moved, lambda r: F.transform(r["spans"], lambda s: span(r["at"] + s["start"], r["at"] + s["end"]))))

    spans = F.transform(F.array(each), placed)[0]  # the array is made once and then named
    hinted = F.contains(text, F.lit(rule.hint)) if rule.hint.replace("-", "").replace(" ", "").isalnum() else text.rlike(rule.hint)
    return F.when(hinted, spans).otherwise(F.array().cast(SPANS))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """``(blob, rules, spans)``: one row for each scan of a blob; none if there is no ledger yet."""
    schema = f"blob string, rules array<string>, spans {SPANS}"
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def addressed(versions: DataFrame) -> DataFrame:
    return versions.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit(""))).withColumn("blob", F.sha2("text", 256))


def scan(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> None:
    """Scan the blobs of ``versions`` (``text``) for the rules under which the ledger lacks them, and append the results to it."""
    blobs = addressed(versions.select("text")).dropDuplicates(["blob"])
    before = read_ledger(versions.sparkSession, ledger)
    seen = before.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_set("rules"))).alias("seen"))
    names = F.array(*[F.lit(r.name) for r in rules])
    todo = blobs.join(seen, "blob", "left").withColumn("rules", F.array_except(names, F.coalesce("seen", F.array().cast("array<string>")))).filter(F.size("rules") > 0)
    spans = [F.when(F.array_contains("rules", r.name), found(F.col("text"), r, i)).otherwise(F.array().cast(SPANS)) for i, r in enumerate(rules)]
    todo.select("blob", "rules", F.concat(*spans).alias("spans")).write.mode("append").parquet(ledger)


def findings(versions: DataFrame, ledger: str, paths: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``paths`` of every row of ``versions``, its ``blob`` and all ``spans`` found in it under the rules' current versions, by start."""
    current = {r.name: i for i, r in enumerate(rules)}
    scans = read_ledger(versions.sparkSession, ledger).withColumn("rules", F.filter("rules", lambda r: r.isin(*current)))
    kinds = F.transform("rules", lambda r: F.substring_index(r, "@", 1))
    scans = scans.filter(F.size("spans") > 0).select("blob", F.filter("spans", lambda s: F.array_contains(kinds, s["kind"])).alias("spans"))
    held = materialise(scans.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans")), "held")  # so that a hot blob can be split
    blobs = addressed(versions).select(*paths, "blob")
    return blobs.join(held, "blob", "left").select(*paths, "blob", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"))
