"""Queries of the reference's dataflow operators, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkloom.functions import hashing
from sparkloom.operators import prepare, text
from sparkloom.plans.tables import PROTECTED, REPO, SHINGLES, TOKENS, U64LE, protected, repo, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents")


def lp_sql(x: str) -> str:
    return f"{U64LE.format(f'octet_length(encode({x}))')} || encode({x})"


# --- sources and sinks


@query("select i::int as retry, least(500 * (1::bigint << i), 8000)::bigint as delay_ms from range(12) t(i)")
def s1b_retry_backoff(spark, d):
    return spark.range(12).select(F.col("id").cast("int").alias("retry"), F.least(F.expr("500L * shiftleft(1L, cast(id as int))"), F.lit(8000)).cast("long").alias("delay_ms"))


@query(r"select page_id, (regexp_matches(url, '^https://[^/@?#\\\s]+') and length(url) <= 4096 and not regexp_matches(url, '[\s#\\]')) as allowed from pages")
def s1c_url_guard(spark, d):
    return table(spark, d, "pages").select("page_id", (F.col("url").rlike(r"^https://[^/@?#\\\s]+") & (F.length("url") <= 4096) & ~F.col("url").rlike(r"[\s#\\]")).alias("allowed"))


@query(f"select doc_id, {REPO} as repository, 'https://host.invalid/' || {REPO} || '/' || doc_id::varchar as origin_url, ((row_number() over (order by doc_id) - 1) // 300)::bigint as part from documents")
def s2a_materialize_source(spark, d):
    # manifest parts follow the global order; ids are dense here, so the rank is their count below, by range buckets
    rows = docs(spark, d).select("doc_id", repo().alias("repository")).withColumn("bucket", F.floor(F.col("doc_id") / 5000))
    below = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy("doc_id")) - 1
    out = rows.withColumn("rank", rank).join(below, "bucket")
    return out.select("doc_id", "repository", F.concat(F.lit("https://host.invalid/"), "repository", F.lit("/"), F.col("doc_id").cast("string")).alias("origin_url"), F.floor((F.col("before") + F.col("rank")) / 300).cast("long").alias("part"))


@query(r"select doc_id, case when lang <> 'en' then 'skipped_language' when not regexp_matches(text, 'MIT License|Apache') and regexp_matches(text, 'License') then 'skipped_license' when octet_length(encode(text)) > 20000 then 'skipped_oversize' when row_number() over (partition by md5(text), lang <> 'en', not regexp_matches(text, 'MIT License|Apache') and regexp_matches(text, 'License'), octet_length(encode(text)) > 20000 order by doc_id) > 1 then 'skipped_duplicate' else 'admitted' end as outcome from documents")
def s3_parquet_metadata_scan(spark, d):
    reason = F.when(F.col("lang") != "en", "skipped_language").when(~F.col("text").rlike("MIT License|Apache") & F.col("text").rlike("License"), "skipped_license").when(F.octet_length("text") > 20000, "skipped_oversize")
    rows = docs(spark, d).select("doc_id", reason.alias("reason"), F.md5("text").alias("blob"))
    first = rows.where("reason is null").groupBy("blob").agg(F.min("doc_id").alias("first"))
    return rows.join(first, "blob", "left").select("doc_id", F.coalesce("reason", F.when(F.col("doc_id") != F.col("first"), "skipped_duplicate"), F.lit("admitted")).alias("outcome"))


@query("select source, array_to_string(list_sort(list_distinct(list(lang))), ' AND ') as expression from documents group by source")
def s3a_licence_join(spark, d):
    return docs(spark, d).groupBy("source").agg(F.array_join(F.array_sort(F.collect_set("lang")), " AND ").alias("expression"))


@query("select doc_id, substr(md5(text), 1, 1) as prefix from documents where substr(md5(text), 1, 1) in ('0', '1', '2', '3')")
def s3b_hash_prefix_partition(spark, d):
    return docs(spark, d).select("doc_id", F.substring(F.md5("text"), 1, 1).alias("prefix")).where(F.col("prefix").isin("0", "1", "2", "3"))


@query("select doc_id, sha1(encode('blob ' || octet_length(encode(text))::varchar) || '\\x00'::blob || encode(text)) as blob_id from documents")
def s3d_blob_identity(spark, d):
    return docs(spark, d).select("doc_id", hashing.git_blob_id(F.col("text")).alias("blob_id"))


@query("select doc_id, sha256(encode(text)) as sha256, octet_length(encode(text))::bigint as bytes from documents")
def k5_artifact_binding(spark, d):
    return docs(spark, d).select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha256"), F.octet_length("text").cast("long").alias("bytes"))


# --- projections, filters, predicates


@query(f"select doc_id, sha256(encode('sparkloom/source-id/v1') || '\\x00'::blob || {lp_sql(chr(39) + 'adapter' + chr(39))} || {lp_sql(chr(39) + 'snapshot' + chr(39))} || {lp_sql('doc_id::varchar')}) as source_id, sha256(encode('sparkloom/repository-group/v1') || '\\x00'::blob || {lp_sql(chr(39) + 'adapter' + chr(39))} || {lp_sql(REPO)}) as repository_group_id from documents")
def f1_identity_columns(spark, d):
    ns = F.lit("adapter")
    return docs(spark, d).select("doc_id", hashing.source_id(ns, F.lit("snapshot"), F.col("doc_id").cast("string")).alias("source_id"), hashing.repository_group_id(ns, repo()).alias("repository_group_id"))


@query(r"select doc_id, (octet_length(encode(text)) between 1 and 4096 and not regexp_matches(text, '[\x00-\x1f\x7f]')) as bounded from documents")
def f2_bounded_text(spark, d):
    return docs(spark, d).select("doc_id", (F.octet_length("text").between(1, 4096) & ~F.col("text").rlike(r"[\x00-\x1f\x7f]")).alias("bounded"))


@query(r"select page_id, regexp_matches(url, '^https://[^/@?#\\\s]+(/[^?#@\\\s]*)?$') as https from pages")
def f3_https_identity(spark, d):
    return table(spark, d, "pages").select("page_id", text.is_https_identity(F.col("url")).alias("https"))


@query("select page_id, (p <> '' and not regexp_matches(p, '[:\\\\]') and len(list_filter(string_split(p, '/'), lambda s: s in ('', '.', '..'))) = 0) as portable from (select page_id, regexp_replace(url, '^[a-z]+://', '') p from pages)")
def f5_portable_path(spark, d):
    return table(spark, d, "pages").select("page_id", text.is_portable_path(F.regexp_replace("url", "^[a-z]+://", "")).alias("portable"))




@query("select doc_id, octet_length(encode(text)) between 100 and 1000000 as allowed from documents")
def f10_size_filter(spark, d):
    return docs(spark, d).select("doc_id", F.octet_length("text").between(100, 1_000_000).alias("allowed"))




def quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


# --- scalar functions


@query("select doc_id, md5(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10))) as digest from documents")
def m1_newline_normalize(spark, d):
    return docs(spark, d).select("doc_id", F.md5(text.newline_normalize(F.col("text"))).alias("digest"))


@query(f"select doc_id, len(tk)::int as n, md5(array_to_string(tk, ' ')) as digest from (select doc_id, {TOKENS} tk from documents)")
def m9_lexical_tokens(spark, d):
    rows = docs(spark, d).select("doc_id", text.lexical_tokens(text.newline_normalize(F.col("text"))).alias("tk"))
    return rows.select("doc_id", F.size("tk").alias("n"), F.md5(F.array_join("tk", " ")).alias("digest"))


PREP = f"(select doc_id, source, text, sha256(text) sha, tk, {SHINGLES} sh from (select *, {TOKENS} tk from documents))"


@query(f"select doc_id, len(sh)::int as n, md5(array_to_string(list_sort(sh), '|')) as digest from {PREP}")
def w7_ngram_runs(spark, d):
    return prepare.prepared(docs(spark, d)).select("doc_id", F.size("shingles").alias("n"), F.md5(F.array_join(F.array_sort("shingles"), "|")).alias("digest"))


@query("select doc_id, (('0x' || substr(sha256(encode('sparkloom/split/v1') || '\\x00'::blob || unhex(sha256(doc_id::varchar))), 1, 16))::ubigint % 10000)::bigint as bucket from documents")
def m8_split_bucket(spark, d):
    return docs(spark, d).select("doc_id", hashing.split_bucket(F.sha2(F.col("doc_id").cast("string"), 256)).alias("bucket"))


@query("select i as step, round(case when i < 1000 then 3e-4 * (i + 1) / 1000 else 3e-5 + 0.5 * (3e-4 - 3e-5) * (1 + cos(pi() * (i - 1000) / 29000.0)) end, 12) as rate from range(0, 30001, 500) t(i)")
def m20_learning_rate(spark, d):
    i = F.col("id")
    return spark.range(0, 30001, 500).select(i.alias("step"), F.round(F.when(i < 1000, 3e-4 * (i + 1) / 1000).otherwise(3e-5 + 0.5 * (3e-4 - 3e-5) * (1 + F.cos(F.pi() * (i - 1000) / 29000.0))), 12).alias("rate"))


@query("select p as pos, i as dim, round(p * pow(10000.0, -2.0 * i / 64), 9) as angle from range(32) a(p), range(32) b(i)")
def m23_rope_angle(spark, d):
    return spark.range(32).withColumnRenamed("id", "pos").withColumn("dim", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(31).cast("long")))).select("pos", "dim", F.round(F.col("pos") * F.pow(F.lit(10000.0), -2.0 * F.col("dim") / 64), 9).alias("angle"))


@query("select item_id, sha256('bench:' || item_id::varchar || ':/text:prompt') as path from benchmark")
def m29_benchmark_identity(spark, d):
    return table(spark, d, "benchmark").select("item_id", F.sha2(F.concat_ws(":", F.lit("bench"), F.col("item_id").cast("string"), F.lit("/text"), F.lit("prompt")), 256).alias("path"))


@query("select event_id, json_extract_string(props, '$.' || k) as value, k as pointer from events, (select unnest(json_keys(props)) k, event_id e from events) where e = event_id")
def m14_json_extract(spark, d):
    rows = table(spark, d, "events").select("event_id", F.explode(F.from_json("props", "map<string,string>")).alias("pointer", "value"))
    return rows.select("event_id", "value", "pointer")


# --- joins


@query(f"select d.doc_id, b.item_id from documents d join {PROTECTED} b on sha256(d.text) = sha256(b.text)")
def j1_exact_match_join(spark, d):
    b = protected(spark, d).select("item_id", F.sha2("text", 256).alias("sha"))
    return docs(spark, d).select("doc_id", F.sha2("text", 256).alias("sha")).join(b, "sha").select("doc_id", "item_id")


@query("select doc_id, (doc_id in (select doc_id from labels where quality = 0) or source in (select source from documents where doc_id % 97 = 0)) as removed from documents")
def j4_removal_semi_join(spark, d):
    rows = docs(spark, d).select("doc_id", "source")
    records = table(spark, d, "labels").where("quality = 0").select(F.col("doc_id").alias("r")).distinct()
    sources = rows.where("doc_id % 97 = 0").select(F.col("source").alias("s")).distinct()
    return rows.join(records, F.col("doc_id") == F.col("r"), "left").join(sources, F.col("source") == F.col("s"), "left").select("doc_id", (F.col("r").isNotNull() | F.col("s").isNotNull()).alias("removed"))


RUNS = "(select {0}, unnest(list_transform(range(greatest(len(tk) - {1}, 0)), lambda i: array_to_string(tk[i + 1:i + {2}], ' '))) run from (select {0}, {3} tk from {4}))"


@query(f"select distinct doc_id, item_id from {RUNS.format('doc_id', 49, 50, TOKENS, 'documents')} join {RUNS.format('item_id', 49, 50, TOKENS, 'benchmark')} using (run)")
def j5_span_containment_join(spark, d):
    """Runs of 50 tokens meet by hash; then the runs themselves decide."""
    tokens = lambda df, key: df.select(key, text.lexical_tokens(text.newline_normalize(F.col("text"))).alias("tk")).where(F.size("tk") >= 50)
    runs = lambda tk: F.transform(F.sequence(F.lit(1), F.size(tk) - 49), lambda i: F.array_join(F.slice(tk, i, 50), " "))
    hashes = lambda rows, key: rows.select(key, F.explode(F.transform(runs("tk"), lambda r: F.xxhash64(r))).alias("h"))
    own, items = tokens(docs(spark, d), "doc_id"), tokens(table(spark, d, "benchmark"), "item_id")
    met = hashes(own, "doc_id").join(hashes(items, "item_id").distinct(), "h").select("doc_id", "item_id").distinct()
    pairs = met.join(own, "doc_id").join(items.withColumnRenamed("tk", "item"), "item_id")
    return pairs.where(F.arrays_overlap(runs("tk"), runs("item"))).select("doc_id", "item_id")


#: The words 2 to 7 of an item have a space on both sides if the item has an eighth.
ANCHORED = 8


@query("select doc_id, item_id from documents d join benchmark b on contains(d.text, b.text)")
def j7_substring_join(spark, d):
    """Items of ANCHORED words or more are found through an anchor, six words that stand whole in any text with the item: they join by hash, then the whole text decides. Shorter items are looked for in every text."""
    b = table(spark, d, "benchmark").select("item_id", F.col("text").alias("item"))
    words = F.split("item", " ")
    anchored = b.where(F.size(words) >= ANCHORED)
    items = anchored.select("item_id", F.xxhash64(F.array_join(F.slice(words, 2, 6), " ")).alias("h"))
    rows = docs(spark, d).select("doc_id", F.split("text", " ").alias("words"))
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.size("words") - 5, F.lit(1))), lambda i: F.xxhash64(F.array_join(F.slice("words", i, 6), " ")))
    met = rows.select("doc_id", F.explode(F.array_distinct(runs)).alias("h")).join(items, "h").select("doc_id", "item_id").distinct()
    long = met.join(docs(spark, d).select("doc_id", "text"), "doc_id").join(anchored, "item_id").where(F.contains("text", "item")).select("doc_id", "item_id")
    short = docs(spark, d).select("doc_id", "text").join(b.where(F.size(words) < ANCHORED), F.contains("text", "item")).select("doc_id", "item_id")
    return long.unionByName(short)


@query(f"select doc_id, min(doc_id) over (partition by {REPO}) as first_doc from documents")
def j8_repository_join(spark, d):
    rows = docs(spark, d).select("doc_id", repo().alias("repo"))
    return rows.join(rows.groupBy("repo").agg(F.min("doc_id").alias("first_doc")), "repo").select("doc_id", "first_doc")


# --- aggregations


@query("select sha256(text) as sha, count(*)::bigint as n, min(doc_id) as first_doc from documents group by 1 having count(*) > 1")
def a2_exact_dup_groups(spark, d):
    return docs(spark, d).groupBy(F.sha2("text", 256).alias("sha")).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc")).where("n > 1")


FIRSTS = f"(select min(doc_id) doc_id, sh from (select doc_id, list_sort(sh) sh from {PREP}) group by sh)"


@query(f"with p as {FIRSTS}, x as (select doc_id, unnest(sh) s from p), c as (select a.doc_id u, b.doc_id v, count(*) i from x a join x b on a.s = b.s and a.doc_id < b.doc_id group by all), n as (select doc_id, len(sh) n from p) select u, v from c join n a on u = a.doc_id join n b on v = b.doc_id where 100 * i > 85 * (a.n + b.n - i)")
def j3_near_pairs(spark, d):
    """Pairs above 0.85 of the first documents of equal shingle sets, by the candidates of the bands."""
    sets, _ = prepare.classes(docs(spark, d))
    return prepare.near(prepare.candidates(sets), sets)


CLUSTERS = f"with recursive p as (select doc_id, source, sh from {PREP}), x as (select doc_id, unnest(sh) s from p), c as (select a.doc_id u, b.doc_id v, count(*) i from x a join x b on a.s = b.s and a.doc_id < b.doc_id group by all), n as (select doc_id, len(sh) n from p), e as (select u, v from c join n a on u = a.doc_id join n b on v = b.doc_id where 100 * i > 85 * (a.n + b.n - i)), ee as (select u, v from e union select v, u from e), r as (select doc_id id, doc_id l from documents union select ee.v, r.l from r join ee on r.id = ee.u), cl as (select id, min(l) label from r group by id)"


@query(CLUSTERS + " select id as doc_id, label as cluster from cl")
def a6_connected_components(spark, d):
    rows = docs(spark, d)
    return prepare.labelled(rows.select(F.col("doc_id").alias("id")), prepare.near_edges(rows)).select(F.col("id").alias("doc_id"), F.col("label").alias("cluster"))


@query(CLUSTERS + ", m as (select distinct doc_id from documents d join benchmark b on contains(d.text, b.text)) select label as cluster, bool_or(m.doc_id is not null) as contaminated from cl left join m on m.doc_id = cl.id group by label")
def a9_cluster_contaminated(spark, d):
    hits = j7_substring_join(spark, d).select("doc_id").distinct().withColumn("hit", F.lit(True))
    return a6_connected_components(spark, d).join(hits, "doc_id", "left").groupBy("cluster").agg(F.bool_or(F.coalesce("hit", F.lit(False))).alias("contaminated"))


SPLIT = CLUSTERS + f", g as (select id, label, {REPO} repo from cl join documents on id = doc_id), ge as (select a.id u, b.id v from g a join g b on (a.label = b.label or a.repo = b.repo) and a.id <> b.id), r2 as (select id, id l from g union select ge.v, r2.l from r2 join ge on r2.id = ge.u), co as (select id doc_id, min(l) component from r2 group by id), bk as (select doc_id, component, (('0x' || substr(sha256(encode('sparkloom/split/v1') || '\\x00'::blob || unhex(sha256(encode('sparkloom/component/v1') || '\\x00'::blob || {lp_sql('component::varchar')}))), 1, 16))::ubigint % 10000)::bigint bucket from co)"


@query(SPLIT + " select doc_id, component, bucket, case when bucket < 9800 then 'train' when bucket < 9900 then 'validation' else 'test' end as split from bk")
def flagship_prepare(spark, d):
    rows = docs(spark, d)
    clusters = prepare.labelled(rows.select(F.col("doc_id").alias("id")), prepare.near_edges(rows))
    return prepare.splits(clusters, docs(spark, d).select("doc_id", repo().alias("repo")))


TOKENED = f"(select doc_id, source, case when doc_id % 10 = 0 then 'test' when doc_id % 10 = 1 then 'validation' else 'train' end split, len({TOKENS}) + 1 stored, octet_length(encode(text)) bytes from documents)"


def tokened(spark, d):
    split = F.when(F.col("doc_id") % 10 == 0, "test").when(F.col("doc_id") % 10 == 1, "validation").otherwise("train")
    return docs(spark, d).select("doc_id", "source", split.alias("split"), (F.size(text.lexical_tokens(text.newline_normalize(F.col("text")))) + 1).cast("long").alias("stored"), F.octet_length("text").alias("bytes"))


@query(f"select split, count(*)::bigint as documents, sum(bytes)::bigint as bytes, sum(stored)::bigint as stored, greatest(sum(stored) - 1, 0)::bigint as targets from {TOKENED} group by split")
def a12_split_accounting(spark, d):
    return tokened(spark, d).groupBy("split").agg(F.count(F.lit(1)).alias("documents"), F.sum("bytes").alias("bytes"), F.sum("stored").alias("stored"), F.greatest(F.sum("stored") - 1, F.lit(0)).alias("targets"))


@query(f"select sum(stored)::bigint as total, least(sum(stored) filter (split = 'train'), 200000)::bigint as prefix, sum(stored) filter (split = 'train') >= 200000 as satisfied from {TOKENED}")
def a13_corpus_accounting(spark, d):
    train = F.sum(F.when(F.col("split") == "train", F.col("stored")))
    return tokened(spark, d).agg(F.sum("stored").alias("total"), F.least(train, F.lit(200000)).alias("prefix"), (train >= 200000).alias("satisfied"))


@query(f"with t as (select unnest({TOKENS}) w, doc_id % 10 = 0 held from documents), c as (select w, count_if(not held) t, count_if(held) h from t group by w), s as (select sum(t) n, count(*) v from c) select round(sum(-h * ln((t + 1) / (n + v)::double)), 6) as nll, sum(h)::bigint as targets from c, s")
def a17_unigram_nll(spark, d):
    tk = text.lexical_tokens(text.newline_normalize(F.col("text")))
    held = F.col("doc_id") % 10 == 0
    c = docs(spark, d).select(F.explode(tk).alias("w"), held.alias("held")).groupBy("w").agg(F.count_if(~F.col("held")).alias("t"), F.count_if(F.col("held")).alias("h"))
    s = c.agg(F.sum("t").alias("n"), F.count(F.lit(1)).alias("v"))
    return c.join(F.broadcast(s)).agg(F.round(F.sum(-F.col("h") * F.log((F.col("t") + 1) / (F.col("n") + F.col("v")).cast("double"))), 6).alias("nll"), F.sum("h").alias("targets"))


@query("select round(least(1, 1 / sqrt(sum(x * x))), 9) as scale from (select unnest(embedding)::double x from embeddings)")
def a23_grad_clip_scale(spark, d):
    x = table(spark, d, "embeddings").select(F.explode("embedding").alias("x")).select(F.col("x").cast("double").alias("x"))
    return x.agg(F.round(F.least(F.lit(1.0), 1 / F.sqrt(F.sum(F.col("x") * F.col("x")))), 9).alias("scale"))


@query("select (doc_id // 300)::bigint as part, count(*)::bigint as documents, sum(n_chars)::bigint as chars from documents group by 1")
def a24_generation_totals(spark, d):
    return docs(spark, d).groupBy(F.floor(F.col("doc_id") / 300).alias("part")).agg(F.count(F.lit(1)).alias("documents"), F.sum("n_chars").alias("chars"))


# --- ordered computations


@query(f"select doc_id, split, row_number() over (partition by split order by source, doc_id) - 1 as ord, coalesce(sum(stored) over (partition by split order by source, doc_id rows between unbounded preceding and 1 preceding), 0)::bigint as first_id from {TOKENED}")
def w1_w2_document_order(spark, d):
    """Two levels, so that neither a split nor a source is one task: totals per (split, source, block of ids), then order within each."""
    rows = tokened(spark, d).withColumn("block", F.floor(F.col("doc_id") / 4096))
    totals = rows.groupBy("split", "source", "block").agg(F.count(F.lit(1)).alias("n"), F.sum("stored").alias("s"))
    before = Window.partitionBy("split").orderBy("source", "block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("split", "source", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"), F.coalesce(F.sum("s").over(before), F.lit(0)).alias("s0"))
    own = Window.partitionBy("split", "source", "block").orderBy("doc_id")
    out = rows.withColumns({"k": F.row_number().over(own) - 1, "s": F.coalesce(F.sum("stored").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    return out.join(totals, ["split", "source", "block"]).select("doc_id", "split", (F.col("n0") + F.col("k")).alias("ord"), (F.col("s0") + F.col("s")).alias("first_id"))


ORDERED = f"(select doc_id, split, stored, coalesce(sum(stored) over (partition by split order by source, doc_id rows between unbounded preceding and 1 preceding), 0)::bigint first_id from {TOKENED})"


@query(f"select doc_id from {ORDERED} where split <> 'train' or first_id < 200000")
def w3_prefix_admission(spark, d):
    return w1_w2_document_order(spark, d).where("split <> 'train' or first_id < 200000").select("doc_id")


@query(f"select split, unnest(range(n)) as sequence, unnest(range(n)) * 2048 as first_id, least(t - 1 - unnest(range(n)) * 2048, 2048)::bigint as valid_targets from (select split, sum(stored)::bigint t, ((sum(stored) - 1 + 2047) // 2048)::bigint n from {TOKENED} group by split)")
def w4_sequence_windows(spark, d):
    t = tokened(spark, d).groupBy("split").agg(F.sum("stored").alias("t"))
    last = F.floor((F.col("t") - 2) / 2048)
    # in two steps, so that a split's windows are made by many tasks
    blocks = t.where("t > 1").select("split", "t", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / 65536))).alias("block")).repartition("split", "block")
    rows = blocks.select("split", "t", F.explode(F.sequence(F.col("block") * 65536, F.least(last, F.col("block") * 65536 + 65535))).alias("sequence"))
    return rows.select("split", "sequence", (F.col("sequence") * 2048).alias("first_id"), F.least(F.col("t") - 1 - F.col("sequence") * 2048, F.lit(2048)).alias("valid_targets"))


@query("select conv_id, turn, role, lead(role) over (partition by conv_id order by turn) as next_role from conversations")
def w6_pair_adjacency(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", "role", F.lead("role").over(Window.partitionBy("conv_id").orderBy("turn")).alias("next_role"))


@query("select conv_id, bool_and(ok) as dense from (select conv_id, coalesce(turn = 1 + lag(turn) over (partition by conv_id order by turn), true) ok from conversations) group by conv_id")
def w8_contiguity(spark, d):
    ok = F.coalesce(F.col("turn") == 1 + F.lag("turn").over(Window.partitionBy("conv_id").orderBy("turn")), F.lit(True))
    return table(spark, d, "conversations").select("conv_id", ok.alias("ok")).groupBy("conv_id").agg(F.bool_and("ok").alias("dense"))


@query("select user_id, max(event_id) as newest, arg_max(event_type, event_id) as kind from events group by user_id")
def w9_newest_snapshot(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.max("event_id").alias("newest"), F.max_by("event_type", "event_id").alias("kind"))


@query("select p as step, (p // 65536)::bigint as update_no, (p // 1000000 > (p - 65536) // 1000000 or p = 6553600) as due from range(65536, 6553601, 65536) t(p)")
def w11_w12_boundaries(spark, d):
    p = F.col("id")
    return spark.range(65536, 6553601, 65536).select(p.alias("step"), F.floor(p / 65536).alias("update_no"), ((F.floor(p / 1000000) > F.floor((p - 65536) / 1000000)) | (p == 6553600)).alias("due"))


# --- order, top-k, sampling, set operations


@query("select doc_id, sha256('sample' || doc_id::varchar) as rank_key from documents order by 2, 1 limit 100")
def t2_hash_rank_sample(spark, d):
    return docs(spark, d).select("doc_id", F.sha2(F.concat(F.lit("sample"), F.col("doc_id").cast("string")), 256).alias("rank_key")).orderBy("rank_key", "doc_id").limit(100)


@query("select vec_id, i as token, p as prob from (select vec_id, i, round(exp(x) / sum(exp(x)) over (partition by vec_id), 9) p, row_number() over (partition by vec_id order by x desc, i) k from (select vec_id, unnest(range(len(embedding))) i, unnest(embedding)::double x from embeddings)) where k <= 5")
def t5_topk_sample(spark, d):
    x = table(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("token", "x")).select("vec_id", F.col("token").cast("long").alias("token"), F.col("x").cast("double").alias("x"))
    w = Window.partitionBy("vec_id")
    out = x.withColumns({"prob": F.round(F.exp("x") / F.sum(F.exp("x")).over(w), 9), "k": F.row_number().over(w.orderBy(F.desc("x"), "token"))})
    return out.where("k <= 5").select("vec_id", "token", "prob")


@query("select doc_id from documents where lang = 'en' union select doc_id from labels where toxic = 1")
def u2_union_distinct(spark, d):
    return docs(spark, d).where("lang = 'en'").select("doc_id").union(table(spark, d, "labels").where("toxic = 1").select("doc_id")).distinct()


@query("select doc_id from documents except select doc_id from labels")
def u3_cluster_except(spark, d):
    return docs(spark, d).select("doc_id").subtract(table(spark, d, "labels").select("doc_id"))


@query("select doc_id from documents where lang = 'en' intersect select doc_id from labels where quality = 1")
def u4_intersect(spark, d):
    return docs(spark, d).where("lang = 'en'").select("doc_id").intersect(table(spark, d, "labels").where("quality = 1").select("doc_id"))


@query("select doc_id from (select doc_id, row_number() over (partition by text order by doc_id) k from documents) where k = 1")
def u6_dedup_by_key(spark, d):
    return docs(spark, d).groupBy(F.sha2("text", 256).alias("sha")).agg(F.min("doc_id").alias("doc_id")).select("doc_id")
