"""The operators as queries over the test tables, and their check SQL where SQL can express them."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockledger.llm import chat, codes, decontaminate, embeddings, manifest, packing, pages, quality, rules, secrets, simhash, substrings, toxicity
from stockledger.llm.store import table

ROOT = str(Path(__file__).resolve().parents[2])


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    """A table; Python workers of this session find the package where this file lies."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, paths) if x)
    return table(spark, sf_dir, name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scored = toxicity.score(docs, toxicity.fit(docs, documents(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality.fit(docs, documents(spark, sf_dir, "labels"))
    return quality.score(docs, model).select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(documents(spark, sf_dir), with_text=False)


# Windows that span the text as a list of words, each counted by its joined words.
OP3_SQL = """
with words as (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from documents),
windows as (
  select doc_id, unnest(range(1, len(w) - 33)) as i, unnest(list_transform(range(1, len(w) - 33), lambda i: md5(array_to_string(w[i:i + 34], ' ')))) as h
  from words where len(w) >= 35),
again as (select h from windows group by h having count(*) > 1),
gone as (select distinct doc_id, unnest(range(i, i + 35)) as i from windows semi join again using (h)),
places as (select doc_id, unnest(range(1, len(w) + 1)) as i, unnest(w) as word from words),
kept as (
  select doc_id, count(*) as n, string_agg(word, ' ' order by i) as text from places anti join gone using (doc_id, i) group by doc_id)
select doc_id, len(w) as n_words, len(w) - coalesce(n, 0) as n_removed, sha256(coalesce(kept.text, '')) as kept_sha256
from words left join kept using (doc_id)
"""


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = chat.raw_transcripts(documents(spark, sf_dir, "conversations"))
    return chat.parse(raw.drop("role"), chat.learn(chat.lines_of(raw, label_col="role")))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(documents(spark, sf_dir, "embeddings"))


OP6_SQL = """
with recursive valid as (
  select vec_id, label, cast(embedding as double[]) as v from embeddings where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
  select a.vec_id as a, b.vec_id as b from valid a join valid b on a.label = b.label and a.vec_id <> b.vec_id
  where len(a.v) = len(b.v) and list_cosine_similarity(a.v, b.v) >= 0.93),
reach as (select vec_id as a, vec_id as b from embeddings union select r.a, l.b from reach r join links l on l.a = r.b)
select e.vec_id, (select count(*) from links l where l.a = e.vec_id) as n_links,
  (select min(b) from reach r where r.a = e.vec_id) as component_id, e.vec_id = (select min(b) from reach r where r.a = e.vec_id) as kept
from embeddings e
"""


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = secrets.find_secrets(documents(spark, sf_dir))
    spans = F.col("spans")
    kinds = [x.kind for x in secrets.BASE_RULES]
    base = F.filter(spans, lambda x: x["kind"].isin(kinds))

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(x) for x in kinds]
    return found.select("doc_id", *counts, F.sha2(secrets.spans_text(base), 256).alias("base_sha256"), secrets.spans_text(spans).alias("spans"))


def _op7_sql() -> str:
    """The pieces between matches and the matches rebuild a text, so their lengths give the places."""
    found = []
    for rank, rule in enumerate(secrets.RULES):
        pattern = rule.pattern.replace("'", "''")
        found.append(
            f"select doc_id, '{rule.kind}' as kind, {rank} as rank, {rule.least} as least, regexp_split_to_array(t, '{pattern}') as gaps, "
            f"regexp_extract_all(t, '{pattern}') as found, regexp_extract_all(t, '{pattern}', {rule.group}) as kept from texts"
        )
    return f"""
with texts as (select doc_id, coalesce(text, '') as t from documents),
found as ({" union all ".join(found)}),
each as (select *, unnest(range(1, len(found) + 1)) as i from found where len(found) > 0),
spans as (
  select doc_id, kind, rank, length(found[i]) as n, cast(list_sum(list_transform(gaps[1:i], lambda x: length(x)))
    + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) as bigint) as s from each where length(kept[i]) >= least)
select d.doc_id, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access, count(*) filter (kind = 'hex') as n_hex,
  sha256(coalesce(string_agg(concat(kind, ':', s, ':', s + n), ',' order by s, rank) filter (rank < {len(secrets.BASE_RULES)}), '')) as base_sha256,
  coalesce(string_agg(concat(kind, ':', s, ':', s + n), ',' order by s, rank) filter (kind is not null), '') as spans
from documents d left join spans using (doc_id) group by d.doc_id"""


OP7_SQL = _op7_sql()


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = documents(spark, sf_dir, "pages")
    return pages.extract(raw, pages.learn_weights(raw))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


# The words of the check: the separators of the operator, as a pattern of DuckDB.
_SEPARATORS = "[\\x20\\x09-\\x0D!-/:-@\\[-`{-~]+"

OP10_SQL = f"""
with texts as (
  select 'd' as side, doc_id as id, text from documents union all select 'b', item_id, text from benchmark),
words as (
  select side, id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '{_SEPARATORS}'), lambda x: x <> '') as w from texts),
brief as (select distinct len(w) as n from words where side = 'b' and len(w) between 1 and 4),
shingles as (
  select distinct side, id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) as shingle from words where len(w) >= 5
  union select side, id, array_to_string(w, ' ') from words where side = 'b' and len(w) between 1 and 4
  union select distinct side, id, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) from words join brief on len(w) >= n where side = 'd'),
sizes as (select id, count(*) as n from shingles where side = 'b' group by id)
select d.id as doc_id, b.id as item_id, any_value(s.n) as n_shingles, count(*) as n_shared, count(*) / any_value(s.n) as containment
from shingles d join shingles b on b.shingle = d.shingle and b.side = 'b' join sizes s on s.id = b.id
where d.side = 'd' group by d.id, b.id having count(*) >= 0.8 * any_value(s.n) - 1e-9
"""


#: Rows whose id's crc32 this divides are the ones tampered with in the check of the manifest.
TAMPERED = 7


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    more = {"n_chars": (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")}
    changed = F.col("n_chars").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % TAMPERED == 0)
    claim = F.when(changed, manifest.leaf_digest([more.get(c, F.col(c)) for c in manifest.FIELDS]))
    made = manifest.build(docs, claim=claim)
    proofs = manifest.checked(manifest.prove(made), made.root)
    return proofs.select(F.col("id").alias("doc_id"), "leaf", "subroot", F.lit(made.root).cast("string").alias("root"), "proof_sha256", "folded_root", "verified")


# crc32 by bits: each byte of the id's digits, then eight steps with the reversed polynomial.
OP11_SQL = f"""
with recursive fields as (
  select *, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(cast(doc_id as varchar), ''), lambda c: cast(ascii(c) as bigint))),
    lambda crc, c: list_reduce(list_prepend(xor(crc, c), range(1, 9)), lambda x, i: xor(x >> 1, case when x & 1 = 1 then 3988292384 else 0 end))) as crc
  from documents),
digests as (
  select doc_id, lang, {{leaf}} as leaf, case when n_chars is not null and xor(crc, 4294967295) % {TAMPERED} = 0 then {{claim}} end as claim from fields),
ranked as (select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as rank from digests),
nodes as (
  select lang, 0 as level, rank as pos, leaf as digest, count(*) over (partition by lang) as n from ranked
  union all
  select lang, level + 1, pos // 2, sha256(string_agg(digest, '' order by pos)), (any_value(n) + 1) // 2 from nodes where n > 1 group by lang, level, pos // 2),
subroots as (select lang, digest, row_number() over (order by lang nulls first) - 1 as rank from nodes where n = 1),
upper as (
  select 0 as level, rank as pos, digest, count(*) over () as n from subroots
  union all
  select level + 1, pos // 2, sha256(string_agg(digest, '' order by pos)), (any_value(n) + 1) // 2 from upper where n > 1 group by level, pos // 2),
siblings as (
  select r.lang, r.rank, [{{{{'level': s.level, 'left': s.pos < (r.rank >> s.level), 'digest': s.digest}}}}] as one
  from ranked r join nodes s on s.lang is not distinct from r.lang and s.pos = xor(r.rank >> s.level, 1) and s.n > 1
  union all
  select r.lang, r.rank, [{{{{'level': 100 + u.level, 'left': u.pos < (t.rank >> u.level), 'digest': u.digest}}}}]
  from ranked r join subroots t on t.lang is not distinct from r.lang join upper u on u.pos = xor(t.rank >> u.level, 1) and u.n > 1),
alone as (
  select r.lang, r.rank, [{{{{'level': l.level, 'left': false, 'digest': ''}}}}] as one
  from ranked r join (select distinct lang, level, n from nodes where n > 1) l on l.lang is not distinct from r.lang where xor(r.rank >> l.level, 1) >= l.n
  union all
  select r.lang, r.rank, [{{{{'level': 100 + l.level, 'left': false, 'digest': ''}}}}]
  from ranked r join subroots t on t.lang is not distinct from r.lang join (select distinct level, n from upper where n > 1) l on xor(t.rank >> l.level, 1) >= l.n),
paths as (
  select lang, rank, list(one[1] order by one[1].level) as path from (from siblings union all from alone) group by lang, rank)
select doc_id, leaf, t.digest as subroot, top.digest as root,
  sha256(coalesce(array_to_string(list_transform(path, lambda x: x.digest), ''), '')) as proof_sha256,
  coalesce(list_reduce(list_prepend({{{{'level': 0, 'left': false, 'digest': coalesce(claim, leaf)}}}}, path), lambda a, x: {{{{'level': 0, 'left': false,
    'digest': sha256(case when x.left then concat(x.digest, a.digest) else concat(a.digest, x.digest) end)}}}}).digest, coalesce(claim, leaf)) as folded_root,
  folded_root = top.digest as verified
from ranked r join (select digest from upper where n = 1) top on true left join paths p on p.lang is not distinct from r.lang and p.rank = r.rank join subroots t on t.lang is not distinct from r.lang
"""


def _op11_sql() -> str:
    guarded = lambda x: f"case when {x} is null then '-' else concat(strlen(cast({x} as varchar)), ':', {x}) end"
    digest = lambda fields: "sha256(concat(" + ", ".join(map(guarded, fields)) + "))"
    changed = ["(cast(n_chars as hugeint) + 1)" if x == "n_chars" else x for x in manifest.FIELDS]
    return OP11_SQL.format(leaf=digest(manifest.FIELDS), claim=digest(changed)).replace("{{", "{").replace("}}", "}")


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(documents(spark, sf_dir))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _op12_sql() -> str:
    values = {"word_length": ("word_chars", "n_words"), "symbols": ("n_symbols", "n_words"), "dup_lines": ("n_dup_lines", "n_lines"), "repeat_words": ("n_repeat_words", "n_words")}
    stats = ", ".join(f"case when {b} > 0 then (1000 * {a}) // {b} else 0 end as {k}" for k, (a, b) in values.items())
    each = " union all ".join(f"select lang, source, '{k}' as statistic, {k} as value from stats where not base_failed" for k in values)
    limits = []
    for name, on in (("own", "lang, source"), ("wide", "lang"), ("widest", "")):
        keys, by = (on + ", ", on + ", statistic") if on else ("", "statistic")
        limits.append(f"""
{name} as (
  select {keys}statistic, max(n) as n, min(bucket) filter (4 * up_to >= n) as q1, min(bucket) filter (4 * up_to >= 3 * n) as q3 from (
    select *, sum(c) over (partition by {by} order by bucket) as up_to, sum(c) over (partition by {by}) as n from (
      select {keys}statistic, bucket, count(*) as c from buckets group by {keys}statistic, bucket)) group by {by})""")
    spread = " ".join(f"when '{k}' then {v}" for k, v in rules.SPREAD.items())
    inside = " and ".join(f"coalesce({k} <= any_value(high) filter (statistic = '{k}')" + (f" and {k} >= any_value(low) filter (statistic = '{k}')" if k in rules.TWO_SIDED else "") + ", true)" for k in values)
    counts = "n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words"
    return f"""
with words as (
  select row_number() over () as r, doc_id, lang, source, coalesce(text, '') as t, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines from documents),
windows as (
  select r, unnest(range(1, len(w) - 1)) as i, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])) as x from words where len(w) > 2),
again as (select r, x from windows group by r, x having count(*) > 1),
covered as (select r, count(distinct i + k) as n from windows join again using (r, x), range(3) as s(k) group by r),
counts as (
  select words.r, doc_id, lang, source, cast(len(w) as bigint) as n_words, cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
    cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols, cast(len(lines) as bigint) as n_lines,
    cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines, coalesce(n, 0) as n_repeat_words from words left join covered using (r)),
stats as (select *, n_words < {rules.LEAST_WORDS} or 100 * n_repeat_words > {rules.MOST_REPEATED} * n_words as base_failed, {stats} from counts),
buckets as (
  select *, (value >> greatest(length(bin(value)) - {rules.EXACT_BITS}, 0)) << greatest(length(bin(value)) - {rules.EXACT_BITS}, 0) as bucket from ({each})),
{",".join(limits)},
chosen as (
  select o.lang, o.source, o.statistic, case when o.n >= {rules.LEAST_ROWS} then o.q1 when w.n >= {rules.LEAST_ROWS} then w.q1 else a.q1 end as q1,
    case when o.n >= {rules.LEAST_ROWS} then o.q3 when w.n >= {rules.LEAST_ROWS} then w.q3 else a.q3 end as q3
  from own o join wide w on w.lang is not distinct from o.lang and w.statistic = o.statistic join widest a on a.statistic = o.statistic),
fences as (
  select lang, source, statistic, q1 - {rules.REACH} * greatest(q3 - q1, case statistic {spread} end) as low,
    q3 + {rules.REACH} * greatest(q3 - q1, case statistic {spread} end) as high from chosen)
select doc_id, {counts}, base_failed, not base_failed and {inside} as kept
from stats s left join fences f on f.lang is not distinct from s.lang and f.source is not distinct from s.source
group by r, doc_id, {counts}, base_failed, {", ".join(values)}
"""


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = codes.encode(documents(spark, sf_dir, "embeddings"))
    by_label = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    rows = coded.join(by_label, F.col("label").eqNullSafe(F.col("_label")))
    return rows.select("vec_id", codes.code_text(F.col("code")).alias("code"), "error", "label_error", F.lit(codes.books_digest(books)).alias("codebooks_sha256"))


def _op13_sql() -> str:
    """The rounds one after the other, each part against every entry."""
    parts, scale = codes.PARTS, codes.SCALE
    found = [
        f"""rows as (
  select vec_id, label, list_transform(embedding, lambda x: cast(floor({scale} * cast(x as double)) as bigint)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
parts as (
  select row_number() over (order by vec_id nulls last, v) - 1 as r, vec_id, label, v, len(v) // {parts} as w from rows),
x as (
  select r, p, v[p * w + 1:(p + 1) * w] as x from parts, range({parts}) as s(p)),
b0 as (select p, r as e, x as c from x where r < {codes.ENTRIES})"""
    ]
    for k in range(codes.ROUNDS + 1):
        found.append(
            f"""a{k} as materialized (
  select r, p, min({{'d': list_sum(list_transform(list_zip(x, c), lambda y: (y[1] - y[2]) * (y[1] - y[2]))), 'e': e}}) as best from x join b{k} using (p) group by r, p)"""
        )
        if k < codes.ROUNDS:
            found.append(
                f"""m{k} as (
  select p, e, list(m order by i) as c from (
    select p, a.best.e as e, i, cast((sum(x[i]) - ((sum(x[i]) % count(*)) + count(*)) % count(*)) // count(*) as bigint) as m
    from a{k} a join x using (r, p), range(1, (select max(w) + 1 from parts)) as s(i) group by p, a.best.e, i) group by p, e),
b{k + 1} as materialized (select b.p, b.e, coalesce(m.c, b.c) as c from b{k} b left join m{k} m using (p, e))"""
            )
    last = codes.ROUNDS
    return f"""
with {", ".join(found)},
coded as (
  select vec_id, label, string_agg(lpad(lower(to_hex(best.e)), 2, '0'), '' order by p) as code, cast(sum(best.d) as bigint) as error
  from a{last} join parts using (r) group by r, vec_id, label),
whole as (select sha256(string_agg(array_to_string(c, ','), ',' order by p, e)) as h from b{last})
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, (select h from whole) as codebooks_sha256 from coded
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_quality_rules": op2_quality_rules,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_chat_formatting": op4_chat_formatting,
    "op5_packing": op5_packing,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_secret_scans": op7_secret_scans,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_html_extraction": op9_html_extraction,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_quality_rules": op12_quality_rules,
    "op13_vector_codes": op13_vector_codes,
}

ORACLES: dict[str, str] = {"op3_substring_dedup": OP3_SQL, "op6_embedding_near_dedup": OP6_SQL, "op7_secret_scans": OP7_SQL, "op10_benchmark_decontamination": OP10_SQL, "op11_merkle_manifest": _op11_sql(), "op12_quality_rules": _op12_sql(), "op13_vector_codes": _op13_sql()}
