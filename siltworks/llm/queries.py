"""The numbered queries on the test tables, and the SQL that some of them must equal."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.llm import ann, bpe, cells, fim, html_text, language_id, lm, mixing, near_dup, quality_rules, runs, url_filter, warc
from siltworks.llm.words import word_count, words
from siltworks.session import stored, work_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_prefix_forest(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "embeddings")
    return ann.search(rows, rows.filter("vec_id % 100 = 0"))


@query
def op2_elias_fano_lm(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").withColumn("held_out", language_id.held_out("doc_id", 7, 2))
    model = lm.train(docs.filter(~F.col("held_out")))
    return lm.score(docs, model).withColumn("held_out", language_id.held_out("doc_id", 7, 2))


def vocabulary() -> str:
    """Where the public vocabulary file lies; it is never copied."""
    return importlib.import_module("public_tokenizers").path("word_bpe_49k.json")


@query
def op3_rank_array_bpe(spark: SparkSession, sf: str) -> DataFrame:
    encoded = bpe.encode(table(spark, sf, "documents"), vocabulary(), keep=["doc_id"])
    decoded = bpe.decode(encoded, vocabulary())
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op4_entropy_mixing(spark: SparkSession, sf: str) -> DataFrame:
    plan = mixing.plan_mix(table(spark, sf, "documents"))
    return plan.withColumn("taken", F.col("size") * F.col("copies"))


@query
def op5_warc_transactions(spark: SparkSession, sf: str) -> DataFrame:
    archives = work_dir(spark, "warc")
    warc.write(table(spark, sf, "pages"), archives)
    response = F.col("record_type") == "response"
    # Digests take the place of payloads before captures are put together; a revisit states those of its response.
    records = warc.read(spark, archives).withColumns(
        {
            "payload_bytes": F.when(response, F.octet_length("payload").cast("long")).otherwise(F.col("http_length")),
            "payload_digest": F.when(response, F.sha2("payload", 256)).otherwise(F.regexp_replace("payload_digest", "^sha256:", "")),
            "payload": F.when(F.col("record_type") == "metadata", F.col("payload")),
        }
    )
    records = stored(records, "records")  # archives are unpacked once
    captures = stored(warc.assemble(records).withColumn("page_id", warc.noted("pageId").cast("long")), "captures")
    captures = captures.select("page_id", "response.payload_bytes", "response.payload_digest", "response.record_type")
    first = captures.filter(f"record_type = 'response' and payload_bytes >= {warc.LEAST}").groupBy("payload_digest")
    first = first.agg(F.min("page_id").alias("_first")).withColumnRenamed("payload_digest", "_digest")
    found = captures.join(first, (F.col("payload_digest") == F.col("_digest")) & (F.col("record_type") == "revisit"), "left")
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", F.col("_first").alias("refers_to"))


#: The rules of the contract.
URL_RULES = (
    url_filter.UrlRule("com", "/", "allow"),
    url_filter.UrlRule("example.com", "/en/", "block"),
    url_filter.UrlRule("www.example.com", "/en/", "allow"),
    url_filter.UrlRule("net", "/es/", "block"),
    url_filter.UrlRule("net", "/fr/", "block"),
)


@query
def op6_link_trust(spark: SparkSession, sf: str) -> DataFrame:
    return url_filter.judge(table(spark, sf, "pages"), URL_RULES)


@query
def op7_tensored_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return near_dup.cluster(table(spark, sf, "documents"), width=4)


@query
def op8_block_tree(spark: SparkSession, sf: str) -> DataFrame:
    texts = html_text.extract(table(spark, sf, "pages"), keep=["page_id", "url"])
    return texts.withColumn("n_chars", F.length("text").cast("long"))


@query
def op9_adaptive_quality(spark: SparkSession, sf: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op10_language_mixture(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").withColumn("held_out", language_id.held_out("doc_id", 5, 0))
    model = language_id.collect_model(language_id.learn(docs.filter(~F.col("held_out"))))
    found = language_id.identify(docs, model, keep=["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "lang_pred", "score")


@query
def op11_spherical_cells(spark: SparkSession, sf: str) -> DataFrame:
    return cells.group(table(spark, sf, "embeddings"))


@query
def op12_chunked_fim(spark: SparkSession, sf: str) -> DataFrame:
    cut = fim.transform(table(spark, sf, "documents"))
    digests = {"output_sha256": F.sha2("output", 256), "restored_sha256": F.sha2(fim.restored(), 256)}
    return cut.withColumns(digests).drop("output")


@query
def op13_difference_cover_runs(spark: SparkSession, sf: str) -> DataFrame:
    found = runs.detect(with_planted_runs(table(spark, sf, "documents")))
    exponent = lambda r: F.floor(F.lit(1000) * r["length"] / r["period"]).cast("long")
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    # Of equal exponents the first stands; runs come by start and period.
    more = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    best = F.aggregate("runs", none, lambda best, r: F.when(more(best, r), r).otherwise(best))
    lines = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    digests = {"runs_sha256": F.sha2(lines, 256), "collapsed_sha256": F.sha2("collapsed", 256)}
    found = found.withColumns({"_best": best, "n_runs": F.size("runs").cast("long"), **digests})
    strongest = ["_best.start", "_best.length", "_best.period", exponent(F.col("_best")).alias("exponent_milli")]
    return found.select("doc_id", "n_runs", *strongest, *digests)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; in every tenth document by hash, a tail of words repeats a shorter one."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g, n = F.floor(h / 10), word_count("text")
    chosen = (h % 10 == 0) & (n > 0)
    docs = docs.select("doc_id", "text", g.alias("_g"), F.when(chosen, n).alias("_n"), F.when(chosen, words("text")).alias("_words"))
    docs = docs.withColumn("_a", F.col("_g") % F.col("_n"))
    docs = docs.withColumn("_p", 1 + F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8)))
    a, p, n = (F.col(c).cast("int") for c in ("_a", "_p", "_n"))
    tail = F.flatten(F.array_repeat(F.slice("_words", a + 1, p), F.ceil((n - a) / p).cast("int")))
    planted = F.slice(F.concat(F.slice("_words", F.lit(1), a), tail), F.lit(1), n)
    return docs.select("doc_id", F.when(F.col("_n").isNotNull(), F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))


SQL["op5_warc_transactions"] = """
with p as (select page_id, coalesce(html, '') as body from pages),
     d as (select page_id, octet_length(encode(body)) as n, sha256(body) as digest from p),
     f as (select digest, min(page_id) as first_id from d where n >= 100 group by digest)
select d.page_id, cast(d.n as bigint) as payload_bytes, d.digest as payload_digest,
       case when f.first_id is null or f.first_id = d.page_id then 'response' else 'revisit' end as record_type,
       case when f.first_id <> d.page_id then f.first_id end as refers_to
from d left join f on d.digest = f.digest and d.n >= 100
"""

SQL["op11_spherical_cells"] = """
with recursive v as (
    select vec_id, cast(embedding as double[]) as x from embeddings
    where len(embedding) > 0 and len([c for c in embedding if c is null or not isfinite(c)]) = 0
      and len([c for c in embedding if c <> 0]) > 0),
l as (select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and len(a.x) = len(b.x)
      where list_cosine_similarity(a.x, b.x) >= 0.9),
r as (select vec_id, vec_id as reached from embeddings union select r.vec_id, l.b from r join l on l.a = r.reached),
c as (select vec_id, min(reached) as component_id from r group by vec_id),
n as (select a, count(*) as n from l group by a)
select c.vec_id, coalesce(n.n, 0) as n_links, c.component_id, c.vec_id = c.component_id as kept
from c left join n on n.a = c.vec_id
"""

SQL["op12_chunked_fim"] = """
with d as (select doc_id, coalesce(text, '') as t, sha256('1:' || doc_id) as s from documents),
     u as (select doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') as w,
                  cast('0x' || s[1:8] as ubigint) as h1, cast('0x' || s[9:16] as ubigint) as h2,
                  cast('0x' || s[17:24] as ubigint) as h3, cast('0x' || s[25:32] as ubigint) as h4 from d),
     c as (select *, len(w) as n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) as a,
                  greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) as b,
                  case when doc_id is null or t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90
                       then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form from u),
     p as (select *, array_to_string(w[1:a], '') as pre, array_to_string(w[a + 1:b], '') as mid,
                  array_to_string(w[b + 1:], '') as suf from c)
select doc_id, cast(n as bigint) as n, form,
       case when form <> 'plain' then length(pre) end as prefix_chars, case when form <> 'plain' then length(mid) end as middle_chars,
       sha256(case form when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid
                        when 'spm' then '<S>' || suf || '<P>' || pre || '<M>' || mid else t end) as output_sha256,
       sha256(t) as restored_sha256
from p
"""
