"""The queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from activity_engine.llm import codes, decontaminate, fingerprints, jaccard, language, licenses, mixture, pages, ppm, quality, runs, search, toxicity
from activity_engine.llm.common import bucket, table


def _held_out(modulus: int, value: int) -> Column:
    """Whether a row is kept from training; a row without an id is neither learned from nor held out."""
    return F.coalesce(bucket("doc_id", modulus) == value, F.lit(False))


def op1_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries: the whole texts of the documents whose id is divisible by 20."""
    docs = table(spark, sf_dir, "documents")
    found = search.search(search.build(docs), search.query_terms(docs.where(F.col("doc_id") % 20 == 0)))
    return found.withColumn("score", F.round("score", 6))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", licenses.scan(F.col("text")).alias("r")).select("doc_id", "r.*")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.where(bucket("doc_id", 4) != 2))
    found = docs.select("doc_id", _held_out(4, 2).alias("held_out"), language.identify(F.col("text"), model).alias("r"))
    return found.select("doc_id", "held_out", "r.lang_pred", "r.score", "r.entropy", "r.rejected")


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_digest(table(spark, sf_dir, "documents"))


def op5_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole join: `op5_jaccard` and the number of links of each document, which its SQL has not."""
    return jaccard.join_digest(table(spark, sf_dir, "documents"), n_links=True)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(bucket("doc_id", 5) != 0))
    return _scored(docs, toxicity.score(F.col("text"), model), 0.5)


def op7_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score_digest(table(spark, sf_dir, "documents"), bucket("doc_id", 7) != 2, _held_out(7, 2), through=True)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.train(docs, labels.where(bucket("doc_id", 5) != 0))
    return _scored(docs, quality.score(F.col("text"), model), 0.3)


def _scored(docs: DataFrame, score: Column, least: float) -> DataFrame:
    found = docs.select("doc_id", _held_out(5, 0).alias("held_out"), score.alias("score"))
    return found.withColumn("predicted", (F.col("score") >= least).cast("int"))


def op9_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "pages").select("page_id", "url", pages.extract(F.col("html"), pages.train()).alias("r"))
    return found.select("page_id", "url", "r.text", "r.n_chars")


def op10_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mix_digest(table(spark, sf_dir, "documents"))


def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.code_digest(table(spark, sf_dir, "embeddings"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_digest(table(spark, sf_dir, "documents"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", runs.digest(F.col("text"), F.col("doc_id")).alias("r")).select("doc_id", "r.*")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_search": op1_search,
    "op2_licenses": op2_licenses,
    "op3_decontaminate": op3_decontaminate,
    "op4_language": op4_language,
    "op5_jaccard": op5_jaccard,
    "op5_links": op5_links,
    "op6_toxicity": op6_toxicity,
    "op7_ppm": op7_ppm,
    "op8_quality": op8_quality,
    "op9_pages": op9_pages,
    "op10_mixture": op10_mixture,
    "op11_codes": op11_codes,
    "op12_fingerprints": op12_fingerprints,
    "op13_runs": op13_runs,
}

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _codes_sql(rounds: int = 6) -> str:
    """Plain assigning and averaging, a table expression for each round."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
near{r} as (
  select vec_id, p, min(struct_pack(d := d, e := e)) as best from (
    select x.vec_id, x.p, b.e, cast(sum((x.x - b.x) * (x.x - b.x)) as bigint) as d
    from parts x join book{r} b on b.p = x.p and b.i = x.i group by 1, 2, 3) group by 1, 2)""")
        if r < rounds:
            steps.append(f"""
book{r + 1} as (
  select b.p, b.e, b.i, coalesce(m.x, b.x) as x from book{r} b left join (
    select x.p, n.best.e as e, x.i, cast(floor(sum(x.x) / count(*)) as bigint) as x
    from parts x join near{r} n on n.vec_id = x.vec_id and n.p = x.p group by 1, 2, 3) m on m.p = b.p and m.e = b.e and m.i = b.i)""")
    return f"""
with kept as (
  select vec_id, label, embedding as v, len(embedding) // 8 as w from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
parts as (
  select vec_id, (k - 1) // w as p, (k - 1) % w as i, cast(floor(4096 * cast(v[k] as double)) as bigint) as x
  from (select vec_id, v, w, unnest(range(1, len(v) + 1)) as k from kept)),
book0 as (
  select p, e, i, x from parts join (select vec_id, row_number() over (order by vec_id) - 1 as e from kept order by vec_id limit 16) using (vec_id)),
{",".join(steps)},
coded as (
  select vec_id, string_agg(printf('%02x', best.e), '' order by p) as code, cast(sum(best.d) as bigint) as error from near{rounds} group by 1)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
  (select sha256(string_agg(cast(x as varchar), ',' order by p, e, i)) from book{rounds}) as codebooks_sha256
from coded join kept using (vec_id)"""


def _fingerprints_sql() -> str:
    """Exact sets in place of peeling, and the cells by grouping."""
    keys = f"list_distinct(list_transform(regexp_extract_all($, '{fingerprints.PARAGRAPH}'), lambda p: cast('0x' || substr(md5(p), 1, 15) as bigint)))"
    hashes = []
    for number in range(4):
        low, high = fingerprints.multipliers(number, 0)
        hashes.append(f"(k % 1073741824 * {low} + (k >> 30) * {high}) % {fingerprints.PRIME}")
    cells = "".join(
        f"""
{name} as (
  select doc_id, string_agg(printf('%x:%x:%x:%x', spot, n, k, s), ';' order by spot) as {name} from (
    select doc_id, spot, count(*) as n, bit_xor(k) as k, bit_xor(s) as s
    from (select doc_id, k, {hashes[3]} as s, unnest([{hashes[0]} % 8, 8 + {hashes[1]} % 8, 16 + {hashes[2]} % 8]) as spot
          from (select doc_id, unnest({column}) as k from keyed))
    group by 1, 2) group by 1),"""
        for name, column in (("fingerprint", "own"), ("edited_fingerprint", "changed"))
    )
    return f"""
with docs as (select doc_id, coalesce(text, '') as t, length(coalesce(text, '')) as n from documents),
followed as (
  select doc_id, t, n, coalesce(lead(t) over (order by doc_id desc), first_value(t) over (order by doc_id desc)) as after from docs),
edits as (select *, substr(t, 1, n - n // 2) || substr(after, 1, n // 2) as edited from followed),
keyed as (
  select doc_id, n, sha256(edited) as sha, {keys.replace("$", "t")} as own, {keys.replace("$", "edited")} as changed,
    {keys.replace("$", "after")} as next from edits),{cells}
sizes as (
  select *, len(own) as a, len(changed) as b, len(next) as c, len(list_intersect(own, changed)) as ab, len(list_intersect(own, next)) as ac from keyed)
select doc_id, n as n_chars, sha as edited_sha256, coalesce(fingerprint, '') as fingerprint, coalesce(edited_fingerprint, '') as edited_fingerprint,
  case when a + b = 0 then 1.0 else ab / (a + b - ab) end as near_edited,
  case when a + c = 0 then 1.0 else ac / (a + c - ac) end as near_next
from sizes left join fingerprint using (doc_id) left join edited_fingerprint using (doc_id)"""


# The others have no SQL: fitted models, edits, alignments, a trie, an order by Spark's own hash, and all periods of a text.
ORACLE_SQL: dict[str, str] = {
    "op1_search": f"""
with words as (
  select doc_id, unnest(regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) as word
  from documents where text is not null),
counts as (select doc_id, word, count(*) as tf from words group by 1, 2),
lengths as (select doc_id, sum(tf) as n from counts group by 1),
everything as (select (select count(*) from documents) as docs, (select sum(n) from lengths) / (select count(*) from documents) as mean),
weights as (select word, ln(1 + (docs - count(*) + 0.5) / (count(*) + 0.5)) as idf from counts, everything group by word, docs),
scores as (
  select q.doc_id as query_id, c.doc_id, round(sum(idf * c.tf * 2.2 / (c.tf + 1.2 * (0.25 + 0.75 * n / mean))), 9) as score
  from counts q join weights using (word) join counts c using (word) join lengths l on l.doc_id = c.doc_id, everything
  where q.doc_id % 20 = 0 group by 1, 2)
select query_id, rank, doc_id, round(score, 6) as score
from (select *, cast(row_number() over (partition by query_id order by score desc, doc_id) as integer) as rank from scores) where rank <= 10""",
    "op11_codes": _codes_sql(),
    "op12_fingerprints": _fingerprints_sql(),
    "op5_jaccard": f"""
with recursive texts as (
  select doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') as w from documents),
sets as (
  select doc_id, list_distinct(case when len(w) < 3 then [array_to_string(w, ' ')]
    else [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)] end) as s
  from texts where len(w) > 0),
sizes as (select doc_id, len(s) as n from sets),
shingles as (select doc_id, unnest(s) as x from sets),
common as (select a.doc_id as a, b.doc_id as b, count(*) as shared from shingles a join shingles b on a.x = b.x and a.doc_id <> b.doc_id group by 1, 2),
links as (
  select a, b from common join sizes p on p.doc_id = a join sizes q on q.doc_id = b where 100 * shared >= 90 * (p.n + q.n - shared)),
reach as (select doc_id as a, doc_id as b from documents union select r.a, l.b from reach r join links l on l.a = r.b)
select d.doc_id, coalesce(any_value(n), 0) as n_shingles, min(b) as component_id
from documents d join reach on a = d.doc_id left join sizes z on z.doc_id = d.doc_id group by 1""",
}
