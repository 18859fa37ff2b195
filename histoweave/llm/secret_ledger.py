"""Secret scans over an incremental, content-addressed blob ledger.

Every version of every path is named by the SHA-256 of its content. Only pairs
of a blob and a rule version that the ledger doesn't hold yet are scanned, each
distinct blob once, and findings join back to all paths. All steps are built-in
expressions. A rule's matches come from two of them: `regexp_extract_all` lists
the matches and `split` by the same pattern lists the gaps between them, so
positions are running sums of lengths.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from histoweave.sources.written import new_path


@dataclass(frozen=True)
class Rule:
    """A kind of secret. `group` of the match must have `least` characters; the span is the whole match.

    `pattern` is valid for Java and RE2. The version names pattern and lengths; a
    change of either makes all blobs unseen for the rule.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYWORDS = "|".join(_any_case(w) for w in ("password", "passwd", "secret", "token")) + "|" + _any_case("api") + "_?" + _any_case("key")
BASE_RULES = (
    Rule("assign", rf"""({_KEYWORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: Further public token shapes.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("url", r"[a-z][a-z0-9+.-]{1,20}://[^\x20\x09-\x0D/:@]{1,64}:[^\x20\x09-\x0D/@]{1,128}@"),
)
RULES = BASE_RULES + MORE_RULES

FINDINGS = "blob binary, rule string, kind string, kind_order int, start long, end long"
LEDGER = "blob binary, rule string"
#: Copies of one blob meet its findings in so many parts, and increments in which `scan_documents` scans a table.
SALTS, INCREMENTS = 16, 2


def _pattern(rule: Rule):
    return F.lit(rule.pattern)


def blobs(versions: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """(path, blob) of every version; a null content is the empty one."""
    return versions.select(F.col(path).alias("path"), F.unhex(F.sha2(F.coalesce(F.col(content).cast("string"), F.lit("")), 256)).alias("blob"))


def scan(texts: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Findings of rows (blob, text, todo): rules whose names are in the array `todo`, leftmost and not overlapping per rule."""
    hits = []
    for k, rule in enumerate(rules):
        found = F.transform(F.regexp_extract_all("text", _pattern(rule), 0), F.char_length)
        group = F.transform(F.regexp_extract_all("text", _pattern(rule), F.lit(rule.group)), F.char_length) if rule.group else found
        gaps = F.transform(F.split("text", rule.pattern, -1), F.char_length)
        due = F.array_contains("todo", rule.name) & F.col("text").rlike(rule.pattern)
        hits.append(F.when(due, F.struct(F.lit(k).alias("k"), found.alias("found"), group.alias("group"), gaps.alias("gaps"))))
    rows = texts.select("blob", F.explode(F.array_compact(F.array(*hits))).alias("h"))
    rows = rows.select("blob", "h.k", F.posexplode(F.arrays_zip(F.col("h.found").alias("found"), F.col("h.group").alias("group"), F.slice("h.gaps", 1, F.size("h.found")).alias("gap"))).alias("at", "m"))
    ends = F.sum(F.col("m.gap") + F.col("m.found")).over(Window.partitionBy("blob", "k").orderBy("at"))
    rows = rows.select("blob", "k", F.col("m.group").alias("group"), F.col("m.found").cast("long").alias("found"), ends.cast("long").alias("end"))
    kind, least, name = (F.element_at(F.array(*[F.lit(x) for x in xs]), F.col("k") + 1) for xs in zip(*((r.kind, r.least, r.name) for r in rules)))
    return rows.where(F.col("group") >= least).select("blob", name.alias("rule"), kind.alias("kind"), F.col("k").alias("kind_order"), (F.col("end") - F.col("found")).alias("start"), "end")


def update(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, path: str = "path", content: str = "content") -> tuple[DataFrame, DataFrame]:
    """(findings of unseen pairs, ledger rows of these pairs), both by blob; append them to the tables of earlier runs.

    A blob's text is that of its smallest path among the versions given.
    """
    named = versions.select(F.col(path).alias("path"), F.coalesce(F.col(content).cast("string"), F.lit("")).alias("text"))
    named = named.withColumn("blob", F.unhex(F.sha2("text", 256)))
    first = named.select("path", "blob").groupBy("blob").agg(F.min("path").alias("path"))
    every = F.array(*[F.lit(r.name) for r in rules])
    if ledger is None:
        due = first.withColumn("todo", every)
    else:
        seen = ledger.join(first.select("blob"), "blob", "left_semi").where(F.col("rule").isin([r.name for r in rules])).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        due = first.join(seen, "blob", "left").withColumn("todo", F.array_except(every, F.coalesce("seen", F.array().cast("array<string>")))).where(F.size("todo") > 0)
    # The blob's path is part of the key, so the copies of one content are dealt over all tasks.
    due = due.select("blob", F.coalesce(F.col("path").cast("string"), F.lit("")).alias("key"), "todo")
    texts = named.withColumn("key", F.coalesce(F.col("path").cast("string"), F.lit(""))).join(due.hint("shuffle_hash"), ["blob", "key"]).select("blob", "text", "todo")
    findings = scan(texts, rules).distinct()
    return findings, due.select("blob", F.explode("todo").alias("rule"))


def _tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Findings and ledger of a folder, which is made if there is none."""
    out = []
    for name, schema in (("findings", FINDINGS), ("ledger", LEDGER)):
        empty = spark.range(0).selectExpr(*(f"CAST(NULL AS {kind}) AS {c}" for c, kind in (x.split() for x in schema.split(", "))))
        empty.write.mode("append").parquet(f"{folder}/{name}")
        out.append(spark.read.schema(schema).parquet(f"{folder}/{name}"))
    return out[0].distinct(), out[1].distinct()


def scan_increment(versions: DataFrame, folder: str, rules: tuple[Rule, ...] = RULES, path: str = "path", content: str = "content") -> None:
    """Scan what the ledger in a shared folder doesn't hold yet, and append findings and ledger rows there.

    Findings are written first, so a run that is lost between the two is made
    again by the next one; its findings are then in the folder twice and are read
    as one.
    """
    spark = versions.sparkSession
    findings, pairs = update(versions, _tables(spark, folder)[1], rules, path, content)
    findings.write.mode("append").parquet(f"{folder}/findings")
    pairs.write.mode("append").parquet(f"{folder}/ledger")


def _spans(kinds: tuple[str, ...] | None):
    found = F.col("spans") if kinds is None else F.filter("spans", lambda s: s["kind"].isin(list(kinds)))
    return F.concat_ws(",", F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def _count(kind: str):
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def by_path(versions: DataFrame, findings: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """(path, blob, spans) of every version; spans are in order of start, then of the rules, and null if there are none."""
    named = blobs(versions, path, content).withColumn("salt", F.pmod(F.xxhash64("path"), F.lit(SALTS)).cast("int"))
    return named.join(_by_blob(findings), ["blob", "salt"], "left").drop("salt")


def _by_blob(findings: DataFrame) -> DataFrame:
    """(blob, salt, spans): a blob's spans as one array, once for each salt, so that its copies needn't meet in one task."""
    spans = findings.groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("start", "kind_order", "kind", "end"))).alias("spans"))
    return spans.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def scan_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES, folder: str | None = None, increments: int = INCREMENTS) -> DataFrame:
    """doc_id, n_<kind> of the base rules, base_sha256 and spans for every row of docs(doc_id, text).

    The rows are scanned in increments, by a hash of their ids, against the ledger
    in `folder`, by default a new one in the shared folder: each reads back what
    the ones before have written and scans only blobs that they haven't seen.
    Null texts are empty; rows with equal or null ids are given each. Offsets are
    code points. A blob's findings are one row, as long as its own list of
    secrets. Other columns are ignored.
    """
    spark, folder = docs.sparkSession, folder or new_path(docs.sparkSession, "ledger")
    for i in range(increments):
        scan_increment(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(increments)) == i), folder, rules, "doc_id", "text")
    now = F.col("rule").isin([r.name for r in rules])
    every = by_path(docs, _tables(spark, folder)[0].where(now), "doc_id", "text").withColumn("spans", F.coalesce("spans", F.array().cast("array<struct<start:long,kind_order:int,kind:string,end:long>>")))
    base = tuple(r.kind for r in BASE_RULES)
    counts = [_count(k).alias(f"n_{k}") for k in base]
    return every.select(F.col("path").alias("doc_id"), *counts, F.sha2(_spans(base), 256).alias("base_sha256"), _spans(None).alias("spans"))


def redact_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """docs with every secret of `text` replaced by its kind in angle brackets; overlapping secrets by that of the first.

    All columns and rows stay; null texts stay null.
    """
    findings, _ = update(docs, None, rules, "doc_id", "text")
    named = docs.select(F.struct(*docs.columns).alias("d"), F.unhex(F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)).alias("blob"), F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"))
    named = named.join(_by_blob(findings), ["blob", "salt"], "left")
    text = F.col("d.text").cast("string")

    def step(done, s):
        # `end` is the place up to which the text has been dealt with
        fresh = F.concat(done["out"], F.substring(text, (done["end"] + 1).cast("int"), (s["start"] - done["end"]).cast("int")), F.lit("<"), s["kind"], F.lit(">"))
        return F.struct(F.greatest(done["end"], s["end"]).alias("end"), F.when(s["start"] >= done["end"], fresh).otherwise(done["out"]).alias("out"))

    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit("").alias("out"))
    clean = F.aggregate("spans", start, step, lambda done: F.concat(done["out"], F.substring(text, (done["end"] + 1).cast("int"), F.lit(2**31 - 1))))
    shown = [F.when(F.col("spans").isNull() | text.isNull(), text).otherwise(clean).alias(c) if c == "text" else F.col(f"d.`{c}`").alias(c) for c in docs.columns]
    return named.select(*shown)
