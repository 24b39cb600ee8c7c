"""Secret scans over a ledger of blobs: contents are addressed by digest, and only unseen pairs of blob and rule version are scanned.

Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import bound, cut, discard, fewer_files, small, text_of


def either_case(word: str) -> str:
    """A pattern for the word with its ASCII letters in either case."""
    return "".join(f"[{c}{c.upper()}]" if "a" <= c <= "z" else c for c in word)


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``pattern`` finds candidates, leftmost and non-overlapping; one counts if what stays of it
    without ``prefix`` has ``least`` characters. A changed pattern needs a new ``version``."""

    kind: str
    version: int
    pattern: str
    least: int
    prefix: str = ""

    @property
    def id(self) -> str:
        return f"{self.kind}@{self.version}"


_KEYWORDS = "|".join([either_case(w) for w in ("password", "passwd", "secret", "token")] + [either_case("api") + "_?" + either_case("key")])
ASSIGN_PREFIX = rf"(?:{_KEYWORDS})[\"']?\x20*[:=]\x20*[\"']?"
#: Fixed by the result's definition. In the runs of "access" and "hex" a match that is too short holds no longer one, so the length is part of the pattern.
RULES = (
    Rule("assign", 1, ASSIGN_PREFIX + r"[A-Za-z0-9+/_.=-]+", 12, ASSIGN_PREFIX),
    Rule("access", 1, r"AKIA[A-Z0-9]{14,}", 18),
    Rule("hex", 1, r"[0-9a-f]{16,}", 16),
)
#: A finding: code points, and bytes of the UTF-8 text, each with an exclusive end.
SPANS = "array<struct<start:int,end:int,first_byte:int,end_byte:int>>"


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """The array of ``combine`` over each value and all those before it. In round k each takes in the result 2^k places before it, so n values need about log2(n) rounds."""

    def doubled(done: Column, k: Column) -> Column:
        step = F.call_function("shiftleft", F.lit(1), k)
        return F.transform(done, lambda x, i: F.when(i >= step, combine(F.get(done, i - step), x)).otherwise(x))

    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)).cast("double"))).cast("int"))
    return F.aggregate(rounds, values, doubled)


def spans(text: Column, rule: Rule) -> Column:
    """The rule's matches in ``text``: lengths of the matches and of what lies between them, summed up."""
    none = F.array().cast(SPANS)

    def length(x: Column) -> Column:
        return F.struct(F.length(x).alias("c"), F.octet_length(x).alias("b"))

    def plus(x: Column, y: Column) -> Column:
        return F.struct((x["c"] + y["c"]).alias("c"), (x["b"] + y["b"]).alias("b"))

    def placed(x: Column) -> Column:
        # the last gap has no match
        steps = F.zip_with(F.slice(x["g"], 1, F.size(x["m"])), x["m"], lambda g, m: plus(length(g), length(m)))
        rest = (lambda m: F.length(F.regexp_replace(m, "^" + rule.prefix, ""))) if rule.prefix else F.length
        ends = bound(steps, lambda s: running(s, plus))
        each = F.zip_with(x["m"], ends, lambda m, e: F.when(rest(m) >= rule.least, F.struct((e["c"] - F.length(m)).alias("start"), e["c"].alias("end"), (e["b"] - F.octet_length(m)).alias("first_byte"), e["b"].alias("end_byte"))))
        return F.array_compact(each)

    both = F.struct(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)).alias("m"), F.split(text, rule.pattern, -1).alias("g"))
    return F.when(text.rlike(rule.pattern), bound(both, placed).cast(SPANS)).otherwise(none)


def scan_blobs(docs: DataFrame, ledger: DataFrame | None = None, rules: Sequence[Rule] = RULES, text_col: str = "text") -> DataFrame:
    """New ledger rows (blob, rule, found) for the contents in ``docs`` that the ledger doesn't have under these rule versions.

    A blob is the SHA-256 of a text. Pairs without a finding are rows too: they need no second scan. The ledger is held
    against digests alone; only texts with an unseen pair are moved.
    """
    ids = F.array(*[F.lit(r.id) for r in rules])
    text = text_of(text_col)
    blobs = docs.select(F.sha2(text.cast("binary"), 256).alias("blob"), text.alias("body"))
    if ledger is None:
        unseen = blobs.dropDuplicates(["blob"]).withColumn("todo", ids)
    else:
        seen = ledger.groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        todo = blobs.select("blob").distinct().join(seen, "blob", "left")
        todo = todo.select("blob", F.array_except(ids, F.coalesce("seen", F.array().cast("array<string>"))).alias("todo"))
        todo = cut(todo.where(F.size("todo") > 0), "unseen-blobs")
        unseen = blobs.join(small(todo, todo.count()), "blob").dropDuplicates(["blob"])
    scanned = [F.when(F.array_contains("todo", r.id), F.struct(F.lit(r.id).alias("rule"), spans(F.col("body"), r).alias("found"))) for r in rules]
    return unseen.select("blob", F.explode(F.array_compact(F.array(*scanned))).alias("x")).select("blob", "x.*")


def findings(docs: DataFrame, ledger_path: str | None = None, rules: Sequence[Rule] = RULES, text_col: str = "text") -> DataFrame:
    """(blob, found) of every content of ``docs`` with a finding: array of start, rank, end, kind, first_byte, end_byte, sorted.

    The ledger in ``ledger_path`` (Parquet; a new one where there is none yet) is added to, and scans nothing that it
    has. Without a path the ledger lives in the shared folder for this call.
    """
    spark = docs.sparkSession
    known = None
    if ledger_path is not None:
        path = spark._jvm.org.apache.hadoop.fs.Path(ledger_path)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            known = spark.read.parquet(ledger_path)
    fresh = scan_blobs(docs, known, rules, text_col)
    if ledger_path is None:
        ledger = cut(fresh, "ledger")
    else:
        fewer_files(fresh).write.mode("append").parquet(ledger_path)
        ledger = spark.read.parquet(ledger_path)
    order = {r.id: k for k, r in enumerate(rules)}
    current = ledger.where(F.col("rule").isin(list(order)) & (F.size("found") > 0))
    if ledger_path is not None:
        # the ledger may know many blobs that these paths don't have
        mine = docs.select(F.sha2(text_of(text_col).cast("binary"), 256).alias("blob")).distinct()
        current = current.join(mine, "blob", "left_semi")

    def tagged(r: Rule) -> Column:
        return F.transform("found", lambda s: F.struct(s["start"].alias("start"), F.lit(order[r.id]).alias("rank"), s["end"].alias("end"), F.lit(r.kind).alias("kind"), s["first_byte"].alias("first_byte"), s["end_byte"].alias("end_byte")))

    # a pair can be twice in the ledger after a retried append
    each = [F.first(F.when(F.col("rule") == r.id, tagged(r)), ignorenulls=True) for r in rules]
    per_blob = current.groupBy("blob").agg(F.array_sort(F.flatten(F.array_compact(F.array(*each)))).alias("found"))
    out = cut(per_blob, "findings")
    if ledger_path is None:
        discard(ledger)
    return out


def scan(docs: DataFrame, ledger_path: str | None = None, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The findings of every row of ``docs``: doc_id, blob, found (array of kind, start, end, in the order of start, then rule).

    For ``ledger_path`` see ``findings``. Every row is a version of its path: null texts are empty ones, equal texts are
    one blob scanned once, rows that repeat an id keep one result each, null ids stay null. An empty table gives an empty
    result. Other columns are ignored.
    """
    per_blob = findings(docs, ledger_path, rules, text_col)
    paths = docs.select(F.col(id_col).alias("doc_id"), F.sha2(text_of(text_col).cast("binary"), 256).alias("blob"))
    shape = "array<struct<kind:string,start:int,end:int>>"
    # a plain table on this side, so that the paths of a blob that very many share can be split over tasks
    out = paths.join(per_blob, "blob", "left")
    listed = F.transform("found", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return out.select("doc_id", "blob", F.coalesce(listed, F.array().cast(shape)).alias("found"))


def digest(found: DataFrame) -> DataFrame:
    """One row of counts and digests for each row that ``scan`` returned."""
    listed = F.array_join(F.transform("found", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    kinds = F.transform("found", lambda s: s["kind"])
    count = [(F.size("found") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")]
    return found.select("doc_id", *count, F.sha2(listed.cast("binary"), 256).alias("base_sha256"), listed.alias("spans"))


def redact(docs: DataFrame, mask: str = "[SECRET]", rules: Sequence[Rule] = RULES, text_col: str = "text") -> DataFrame:
    """``docs`` with every finding replaced by ``mask``, overlapping ones by a single one.

    Other columns and clean rows stay as they are, null texts too; rows that repeat an id are masked each. An empty table
    gives an empty result. Findings go to every task while they are few; texts then stay where they are.
    """
    found = findings(docs, None, rules, text_col).select("blob", F.col("found").alias("found"))
    n_spans = found.agg(F.coalesce(F.sum(F.size("found")), F.lit(0))).first()[0]
    names = docs.columns
    boxed = docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("d"), F.sha2(text_of(text_col).cast("binary"), 256).alias("blob"))
    text = F.col(f"d.`{text_col}`")

    def masked(x: Column) -> Column:
        def piece(s: Column, i: Column) -> Column:
            before = F.when(i > 0, F.get(x["ends"], i - 1)).otherwise(0)
            return F.when(s["first_byte"] >= before, F.concat(F.substring(x["data"], before + 1, s["first_byte"] - before).cast("string"), F.lit(mask))).otherwise(F.lit(""))

        last = F.element_at(x["ends"], -1)
        rest = F.substring(x["data"], last + 1, F.octet_length(x["data"]) - last).cast("string")
        return F.array_join(F.concat(F.transform(x["found"], piece), F.array(rest)), "")

    ends = bound(F.transform("found", lambda s: s["end_byte"]), lambda e: running(e, F.greatest))
    clean = bound(F.struct(text.cast("binary").alias("data"), F.col("found").alias("found"), ends.alias("ends")), masked)
    both = boxed.join(small(found, n_spans), "blob", "left")
    return both.select(*[(F.when(F.col("found").isNotNull(), clean).otherwise(text) if n == text_col else F.col(f"d.`{n}`")).alias(n) for n in names])
