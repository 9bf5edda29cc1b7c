"""Secret scans over an incremental ledger of blobs.

Every text is a blob, named by its content (SHA-256), however many paths and versions hold it. The
ledger says which blob was scanned with which version of the rules; a run scans the pairs it does not
hold, and joins the findings of all blobs back to the paths. Only DataFrame functions are used.

Positions come from splitting: the pieces between matches and the matches, in turn, rebuild the text,
so their running lengths are the starts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockledger.llm.store import staged


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds candidates; one counts if group ``group`` has ``least`` characters or more.

    ``hint`` is a cheap pattern that every text with a finding holds.
    """

    kind: str
    pattern: str
    group: int
    least: int
    hint: str
    version: str = "1"


# The base rules, in the order of their listing, then the rules this scanner adds.
_WORD_CHARS = "[A-Za-z0-9+/_.=-]"
_NAMES = "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?"
BASE_RULES = (
    Rule("assign", f"{_NAMES}({_WORD_CHARS}+)", 2, 6, f"{_NAMES}{_WORD_CHARS}{{6}}"),
    Rule("access", "AKIA[A-Z0-9]+", 0, 20, "AKIA[A-Z0-9]{16}"),
    Rule("hex", "[0-9a-f]+", 0, 24, "[0-9a-f]{24}"),
)
ADDED_RULES = (
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1, "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge_token", "gh[pousr]_[A-Za-z0-9]+", 0, 40, "gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("web_token", "eyJ[A-Za-z0-9_-]+[.]eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+", 0, 30, "eyJ[A-Za-z0-9_-]+[.]eyJ[A-Za-z0-9_-]+[.]"),
)
RULES = BASE_RULES + ADDED_RULES

LEDGER = "blob string, kind string, version string"
SPAN = "array<struct<start:int,rank:int,kind:string,end:int>>"


def _spans(text: Column, rule: Rule, rank: int) -> Column:
    """The spans of a rule in a text: leftmost, not overlapping, failing matches dropped afterwards."""
    pattern = F.lit(rule.pattern)
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
    found = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    kept = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length) if rule.group else found
    start = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {SPAN})").alias("spans"))

    def step(state: Column, x: Column) -> Column:
        at = state["at"] + x["gap"]
        span = F.struct(at.alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), (at + x["found"]).alias("end"))
        return F.struct((at + x["found"]).alias("at"), F.when(x["kept"] >= rule.least, F.array_append(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    sizes = F.zip_with(found, kept, lambda x, y: F.struct(x.alias("found"), y.alias("kept")))
    parts = F.zip_with(F.slice(gaps, 1, F.size(found)), sizes, lambda gap, x: F.struct(gap.alias("gap"), x["found"].alias("found"), x["kept"].alias("kept")))
    return F.when(text.rlike(rule.hint), F.aggregate(parts, start, step, lambda state: state["spans"])).otherwise(F.expr(f"cast(array() as {SPAN})"))


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, todo, text) to (blob, kind, version, spans): one row per pair, without findings too.

    ``todo`` lists the kinds that are unseen for the blob.
    """
    each = [
        F.struct(F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"), F.when(F.array_contains("todo", rule.kind), _spans(F.col("text"), rule, rank)).alias("spans"))
        for rank, rule in enumerate(rules)
    ]
    return blobs.select("blob", F.explode(F.array(*each)).alias("x")).select("blob", "x.*").filter(F.col("spans").isNotNull())


def find_secrets(versions: DataFrame, ledger: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """Findings of every row of ``versions``, and the ledger with the pairs of this run.

    ``ledger``: (blob, kind, version, spans) of earlier runs; None is an empty one. Returns
    (id, spans) per row, where spans is sorted by start and then by the order of the rules, and the
    whole ledger. Null texts are empty. Repeated ids and texts give a row each; null ids stay; other
    columns are not read. Empty tables give no rows.
    """
    paths = versions.select(F.col(id_col).alias("path"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    named = paths.select("path", F.sha2("text", 256).alias("blob"))
    texts = paths.select(F.sha2("text", 256).alias("blob"), "text")
    blobs = texts.groupBy("blob").agg(F.first("text").alias("text"))
    kinds = F.array(*[F.lit(x.kind) for x in rules])
    if ledger is None:
        unseen = blobs.withColumn("todo", kinds)
    else:
        current = F.create_map(*[y for x in rules for y in (F.lit(x.kind), F.lit(x.version))])
        done = ledger.filter(current[F.col("kind")] == F.col("version")).groupBy("blob").agg(F.collect_set("kind").alias("done"))
        unseen = blobs.join(done, "blob", "left").withColumn("todo", F.array_except(kinds, F.coalesce("done", F.array().cast("array<string>")))).filter(F.size("todo") > 0)
    fresh = staged(scan(unseen, rules), "blob-findings")
    whole = fresh if ledger is None else ledger.select("blob", "kind", "version", F.col("spans").cast(SPAN)).unionByName(fresh)
    versions_now = F.create_map(*[y for x in rules for y in (F.lit(x.kind), F.lit(x.version))])
    # At most one row per rule and blob, so the list is as long as the blob's own findings.
    found = whole.filter((versions_now[F.col("kind")] == F.col("version")) & (F.size("spans") > 0)).groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    return named.join(found, "blob", "left").select(F.col("path").alias(id_col), F.coalesce("spans", F.expr(f"cast(array() as {SPAN})")).alias("spans")), whole


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span replaced by ``mark``; spans that touch or overlap become one mark.

    ``spans`` is sorted by start. Null text stays null.
    """
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, x: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, x["start"] - state["at"])
        fresh = F.struct(x["end"].alias("at"), F.concat(state["out"], gap, F.lit(mark)).alias("out"))
        longer = F.struct(F.greatest(state["at"], x["end"]).alias("at"), state["out"].alias("out"))
        joined = (x["start"] < state["at"]) | ((x["start"] == state["at"]) & (state["at"] > 0))
        return F.when(joined, longer).otherwise(fresh)

    whole = F.aggregate(spans, start, step, lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def redact(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret of the text replaced by ``mark``; all rows and columns stay.

    Findings belong to contents, so neither ids nor repeated rows matter. Null texts stay null.
    """
    blob = F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256)
    found, ledger = find_secrets(docs.select(F.lit(0).alias("path"), F.col(text_col)), None, "path", text_col, rules)
    hits = ledger.filter(F.size("spans") > 0).groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("_llm_spans")).withColumnRenamed("blob", "_llm_blob")
    joined = docs.join(hits, blob == F.col("_llm_blob"), "left")
    spans = F.coalesce("_llm_spans", F.expr(f"cast(array() as {SPAN})"))
    return joined.withColumn(text_col, redacted(F.col(text_col), spans, mark)).drop("_llm_blob", "_llm_spans")
