"""Queries of rollups, counts and positions, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.operators import bpe, order, prepare, text
from sparkloom.plans import core, more, policy
from sparkloom.plans.tables import TOKENS, protected, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


# --- clusters


@query(core.CLUSTERS + " select label as cluster, count(*)::bigint as members, max(id) as last_doc, sum(id)::bigint as checksum from cl group by label having count(*) > 1")
def a7_cluster_rollup(spark, d):
    """Clusters of two or more with their number of members; who the members are stands in a6, a row for each."""
    found = core.a6_connected_components(spark, d).groupBy("cluster")
    return found.agg(F.count(F.lit(1)).alias("members"), F.max("doc_id").alias("last_doc"), F.sum("doc_id").alias("checksum")).where("members > 1")


FACTS = f"(select doc_id, doc_id % 13 <> 0 as complete, case when {policy.PARSED} then {policy.COMMENT} else 0 end::bigint as comments, strlen(text)::bigint as bytes, t.n from {policy.CODE} c join (select doc_id k, len({TOKENS}) n from documents) t on k = c.doc_id)"


@query(core.CLUSTERS + f", f as {FACTS} select label as cluster, arg_min(id, (not complete, comments / bytes::double, -n, id)) as representative from cl join f on f.doc_id = id group by label")
def a8_representative(spark, d):
    """Of each cluster, by whole provenance, the smaller share of comments, more tokens and the id. The shares are quotients of whole numbers below 2^26, so doubles order them exactly."""
    facts = policy.parsed(spark, d).select("doc_id", (F.col("doc_id") % 13 == 0).alias("lacking"), (text.comment_bytes(F.col("facts.comments")) / F.octet_length("raw").cast("double")).alias("share"))
    size = table(spark, d, "documents").select("doc_id", (-F.size(more.tk_of())).alias("fewer"))
    found = core.a6_connected_components(spark, d).join(facts, "doc_id").join(size, "doc_id")
    return found.groupBy("cluster").agg(F.min_by("doc_id", F.struct("lacking", "share", "fewer", "doc_id")).alias("representative"))


HITS = (
    f"(select doc_id, item_id, 'EXACT' reason from ({core.SQL['j1_exact_match_join']})"
    f" union all select doc_id, item_id, 'NEAR' from ({more.SQL['j2b_lsh_bench_join']}) c join {core.PREP} p using (doc_id) join {more.ITEMS} i using (item_id) where 100 * len(list_intersect(p.sh, i.sh)) > 85 * (len(p.sh) + len(i.sh) - len(list_intersect(p.sh, i.sh)))"
    f" union all select *, 'SPAN' from ({core.SQL['j5_span_containment_join']}) union all select *, 'SHORT' from ({more.SQL['j6_short_sequence_join']})"
    " union all select doc_id, item_id, 'SUBSTRING' from documents d join benchmark b on contains(d.text, b.text))"
)


@query(f"select doc_id, array_to_string(list_sort(list_distinct(list(reason))), ',') as reasons, count(distinct item_id)::bigint as items, min(item_id) as first_item from {HITS} group by doc_id")
def a10_match_rollup(spark, d):
    """The five kinds of matches of each document; a near match is a candidate of the bands whose overlap is above 0.85."""
    sets = prepare.hashed(table(spark, d, "documents")).withColumnRenamed("hashes", "a")
    items = prepare.hashed(protected(spark, d), "item_id").withColumnRenamed("hashes", "b")
    pairs = more.j2b_lsh_bench_join(spark, d).join(sets, "doc_id").join(items, "item_id")
    common = F.size(F.array_intersect("a", "b"))
    near = pairs.where(100 * common > 85 * (F.size("a") + F.size("b") - common)).select("doc_id", "item_id")
    kinds = [(core.j1_exact_match_join(spark, d), "EXACT"), (near, "NEAR"), (core.j5_span_containment_join(spark, d), "SPAN"), (more.j6_short_sequence_join(spark, d), "SHORT"), (core.j7_substring_join(spark, d), "SUBSTRING")]
    hits = None
    for found, kind in kinds:
        found = found.select("doc_id", "item_id", F.lit(kind).alias("reason"))
        hits = found if hits is None else hits.unionByName(found)
    return hits.groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_set("reason")), ",").alias("reasons"), F.count_distinct("item_id").alias("items"), F.min("item_id").alias("first_item"))


# --- accounts


LIMIT = 200_000


@query(
    f"with t as (select * from {core.ORDERED}), s as (select split, count(*) n, sum(stored)::bigint ids, max(first_id + stored)::bigint top, sum(stored - 1)::bigint source_ids from t group by split), w as (select split, sum(valid_targets)::bigint targets, count(*) spans from ({core.SQL['w4_sequence_windows']}) group by split), h as (select split, sum(ids)::bigint ids from ({more.SQL['k4_token_shard_sink']}) group by split)"
    f" select count(*) = 3 as three_streams, bool_and(s.ids = top) as streams_close, bool_and(source_ids + n = s.ids) as one_end_each, bool_and(h.ids = s.ids) as shards_whole, bool_and(targets = s.ids - 1) as targets_whole, bool_and(spans = (s.ids - 1 + 2047) // 2048) as spans_whole, sum(n)::bigint = (select count(*) from documents) as documents_whole, sum(s.ids)::bigint = (select sum(stored) from {core.TOKENED})::bigint as ids_whole, max(case when s.split = 'train' then least(s.ids, {LIMIT}) + greatest(s.ids - {LIMIT}, 0) = s.ids end) as prefix_and_tail, sum(s.ids) <= 1000000000000 as within_limit from s join w on w.split = s.split join h on h.split = s.split"
)
def a14_accounting_invariants(spark, d):
    """What the manifest of a token corpus must satisfy: streams, shards, spans and totals agree."""
    rows = core.w1_w2_document_order(spark, d).join(core.tokened(spark, d).select("doc_id", "stored"), "doc_id")
    s = rows.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("stored").alias("ids"), F.max(F.col("first_id") + F.col("stored")).alias("top"), F.sum(F.col("stored") - 1).alias("source_ids"))
    w = core.w4_sequence_windows(spark, d).groupBy("split").agg(F.sum("valid_targets").alias("targets"), F.count(F.lit(1)).alias("spans"))
    h = more.k4_token_shard_sink(spark, d).groupBy("split").agg(F.sum("ids").alias("shard_ids"))
    whole = core.tokened(spark, d).agg(F.count(F.lit(1)).alias("all_n"), F.sum("stored").alias("all_ids"))
    all_of = lambda rule, name: F.bool_and(rule).alias(name)
    c = F.col
    one = s.join(w, "split").join(h, "split").agg(
        (F.count(F.lit(1)) == 3).alias("three_streams"), all_of(c("ids") == c("top"), "streams_close"), all_of(c("source_ids") + c("n") == c("ids"), "one_end_each"), all_of(c("shard_ids") == c("ids"), "shards_whole"),
        all_of(c("targets") == c("ids") - 1, "targets_whole"), all_of(c("spans") == F.floor((c("ids") + 2046) / 2048), "spans_whole"), F.sum("n").alias("n"), F.sum("ids").alias("ids"),
        F.bool_and(F.when(c("split") == "train", F.least(c("ids"), F.lit(LIMIT)) + F.greatest(c("ids") - LIMIT, F.lit(0)) == c("ids"))).alias("prefix_and_tail"), (F.sum("ids") <= 1_000_000_000_000).alias("within_limit"),
    )
    kept = ["three_streams", "streams_close", "one_end_each", "shards_whole", "targets_whole", "spans_whole", "prefix_and_tail", "within_limit"]
    return one.join(whole).select(*kept, (c("n") == c("all_n")).alias("documents_whole"), (c("ids") == c("all_ids")).alias("ids_whole"))


@query(f"select a as left_id, b as right_id, count(*)::bigint as n from (select unnest(ids[:-2]) a, unnest(ids[2:]) b from (select list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: 4 + ('0x' || x)::int) ids from documents where strlen(text) > 1)) group by all having count(*) >= 2")
def a15_pair_counts(spark, d):
    """Adjacent pairs of byte ids that occur twice or more, as the first round of learning merges counts them."""
    return bpe.pair_counts(byte_ids(spark, d).withColumn("n", F.lit(1))).select(F.col("l").alias("left_id"), F.col("r").alias("right_id"), F.col("n").cast("long").alias("n")).where("n >= 2")


@query(f"select a as left_token, b as right_token, count(*)::bigint as n from (select unnest(tk[:-2]) a, unnest(tk[2:]) b from (select {TOKENS} tk from documents) where len(tk) > 1) group by all")
def a15b_word_pair_counts(spark, d):
    rows = table(spark, d, "documents").select(more.tk_of().alias("tk")).where(F.size("tk") > 1)
    pairs = rows.select(F.explode(F.transform(F.sequence(F.lit(1), F.size("tk") - 1), lambda i: F.struct(F.get("tk", i - 1).alias("left_token"), F.get("tk", i).alias("right_token")))).alias("p"))
    return pairs.select("p.*").groupBy("left_token", "right_token").agg(F.count(F.lit(1)).alias("n"))


CHUNKS = "(select conv_id, turn, 8 * turn + (case when conv_id % 7 = 3 and turn > 1 then 1 else 0 end) as first_target, 8 as valid, length(text) / 64.0::double as nll from conversations)"


@query(f"select conv_id, sum(valid)::bigint as targets, round(sum(nll) / sum(valid), 9) as loss, round(exp(sum(nll) / sum(valid)), 6) as perplexity, bool_and(ok) as contiguous from (select *, first_target = coalesce(lag(first_target + valid) over (partition by conv_id order by turn), 0) and nll >= 0 as ok from {CHUNKS}) group by conv_id")
def a16_aggregate_loss(spark, d):
    """Loss and perplexity of each conversation's chunks, summed in their order with compensation, and whether each chunk begins where the one before ends."""
    shift = F.when((F.col("conv_id") % 7 == 3) & (F.col("turn") > 1), 1).otherwise(0)
    chunk = F.struct("turn", (8 * F.col("turn") + shift).alias("first"), F.lit(8).cast("long").alias("valid"), (F.length("text") / F.lit(64.0)).alias("nll"))
    rows = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(chunk)).alias("chunks"))
    zero = F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("lost"), F.lit(0).cast("long").alias("next"), F.lit(True).alias("ok"))

    def add(s, x):
        corrected = x["nll"] - s["lost"]
        total = s["sum"] + corrected
        return F.struct(total.alias("sum"), ((total - s["sum"]) - corrected).alias("lost"), (x["first"] + x["valid"]).cast("long").alias("next"), (s["ok"] & (x["first"] == s["next"]) & (x["nll"] >= 0)).alias("ok"))

    loss = F.col("s.sum") / F.col("targets")
    out = rows.select("conv_id", F.aggregate("chunks", zero, add).alias("s"), F.aggregate("chunks", F.lit(0).cast("long"), lambda s, x: s + x["valid"]).alias("targets"))
    return out.select("conv_id", "targets", F.round(loss, 9).alias("loss"), F.round(F.exp(loss), 6).alias("perplexity"), F.col("s.ok").alias("contiguous"))


@query("select event_type, count(*)::bigint as samples, min(r)::bigint as least, max(r)::bigint as most, count_if(event_id % 2 = 0)::bigint as synchronized, count_if(event_id % 3 > 0)::bigint as cleaned, max(peak)::bigint as peak from (select *, ((event_id % 5000 + 1)::hugeint * 1000000000000 // ((user_id + 1) * 1000003))::bigint r, case when event_id % 4 = 1 then event_id * 1024 end peak from events) group by event_type")
def a19_profile_summary(spark, d):
    """Rates in thousandths of targets a second by whole-number division, and the peak of the samples that have one."""
    rate = F.floor(((F.col("event_id") % 5000 + 1).cast("decimal(19,0)") * F.lit("1000000000000").cast("decimal(13,0)")) / ((F.col("user_id") + 1) * 1000003).cast("decimal(19,0)")).cast("long")
    peak = F.when(F.col("event_id") % 4 == 1, F.col("event_id") * 1024)
    rows = table(spark, d, "events").select("event_type", "event_id", rate.alias("r"), peak.alias("peak"))
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("samples"), F.min("r").alias("least"), F.max("r").alias("most"), F.count_if(F.col("event_id") % 2 == 0).alias("synchronized"), F.count_if(F.col("event_id") % 3 > 0).alias("cleaned"), F.max("peak").alias("peak"))


ERRORS = "(select l_linenumber k, case when l_linenumber = 7 and l_orderkey % 1000 = 0 then 'NaN'::double else l_quantity end a, l_extendedprice / 1000 r from lineitem)"


@query(
    f"select k as l_linenumber, count(*)::bigint as elements, case when bool_or(not ok) then 1.7976931348623157e308 else max(e) filter (ok) end as max_abs, case when bool_or(not ok) then 1.7976931348623157e308 else round(max(e / greatest(abs(r), 1e-6)) filter (ok), 6) end as max_rel, case when bool_or(not ok) then 1.7976931348623157e308 else round(sqrt(sum(e * e) filter (ok)) / greatest(sqrt(sum(r * r) filter (ok)), 1e-12), 9) end as rel_l2, case when bool_or(not ok) then 0.0 else round(sum(a * r) filter (ok) / (sqrt(sum(a * a) filter (ok)) * sqrt(sum(r * r) filter (ok))), 9) end as cosine, count_if(not ok or e > 5 + 0.5 * abs(r))::bigint as violations from (select *, isfinite(a) and isfinite(r) ok, abs(a - r) e from {ERRORS}) group by k"
)
def a22_error_metrics(spark, d):
    """Largest errors, relative L2 error, cosine and violations of the envelope; values that are not finite spoil a group's metrics."""
    a = F.when((F.col("l_linenumber") == 7) & (F.col("l_orderkey") % 1000 == 0), float("nan")).otherwise(F.col("l_quantity"))
    rows = table(spark, d, "lineitem").select("l_linenumber", a.alias("a"), (F.col("l_extendedprice") / 1000).alias("r"))
    finite = lambda x: ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = rows.withColumn("ok", finite(F.col("a")) & finite(F.col("r"))).withColumn("e", F.when(F.col("ok"), F.abs(F.col("a") - F.col("r"))))
    ok = lambda x: F.when(F.col("ok"), x)
    norm = lambda x: F.sqrt(F.sum(ok(x * x)))
    a, r, e = F.col("a"), F.col("r"), F.col("e")
    found = rows.groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("elements"), F.bool_and("ok").alias("whole"), F.max("e").alias("max_abs"), F.max(e / F.greatest(F.abs(r), F.lit(1e-6))).alias("max_rel"),
        (norm(e) / F.greatest(norm(r), F.lit(1e-12))).alias("rel_l2"), (F.sum(ok(a * r)) / (norm(a) * norm(r))).alias("cosine"), F.count_if(~F.col("ok") | (e > 5 + 0.5 * F.abs(r))).alias("violations"),
    )
    most = lambda x: F.when(F.col("whole"), x).otherwise(1.7976931348623157e308)
    return found.select("l_linenumber", "elements", most(F.col("max_abs")).alias("max_abs"), most(F.round("max_rel", 6)).alias("max_rel"), most(F.round("rel_l2", 9)).alias("rel_l2"), F.when(F.col("whole"), F.round("cosine", 9)).otherwise(0.0).alias("cosine"), "violations")


# --- positions


@query("select s as shard, count(*)::bigint as documents from (select unnest(range((st // 100000)::bigint, ((en - 1) // 100000 + 1)::bigint)) s from (select sum(n_chars) over (order by doc_id) - n_chars st, sum(n_chars) over (order by doc_id) en from documents) where st < en) group by s")
def j10_range_overlap_join(spark, d):
    """Each document's range is dealt to all shards it overlaps by arithmetic, so the range join is an equi-join; positions are sums within blocks of ids after the sums of the blocks before."""
    rows = table(spark, d, "documents").select("doc_id", "n_chars").withColumn("block", F.floor(F.col("doc_id") / 4096))
    sums = rows.groupBy("block").agg(F.sum("n_chars").alias("s"))
    before = sums.select("block", F.coalesce(F.sum("s").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    en = F.col("before") + F.sum("n_chars").over(Window.partitionBy("block").orderBy("doc_id"))
    at = rows.join(before, "block").select("n_chars", en.alias("en")).select((F.col("en") - F.col("n_chars")).alias("st"), "en").where("st < en")
    dealt = at.select(F.explode(F.sequence(F.floor(F.col("st") / 100000), F.floor((F.col("en") - 1) / 100000))).alias("shard"))
    return dealt.groupBy("shard").agg(F.count(F.lit(1)).alias("documents"))


@query(f"with o as (select first_target, ord, least(valid_targets, 2048) targets from (select first_id as first_target, valid_targets, row_number() over (order by valid_targets < 2048, sha256('span' || first_id::varchar), first_id) - 1 as ord from ({core.SQL['w4_sequence_windows']}) where split = 'train')), n as (select sum(stored) - 1 t from {core.TOKENED} where split = 'train') select min(ord) = 0 as from_zero, max(ord) + 1 = count(*) and count(distinct ord) = count(*) as dense, count_if(targets = 2048) = max(t) // 2048 and count(distinct case when targets = 2048 then first_target end) = max(t) // 2048 as complete, count_if(targets = 2048 and first_target % 2048 <> 0) = 0 as aligned, count_if(targets < 2048) = (max(t) % 2048 > 0)::int and coalesce(max(ord) filter (targets < 2048), max(ord)) = max(ord) as partial_last, sum(targets) = max(t) as covered from o, n")
def t4_span_order_validate(spark, d):
    """The checks of an order of spans, on the order by digests with the partial span last."""
    n = core.tokened(spark, d).where("split = 'train'").agg(F.sum("stored")).first()[0]
    spans = core.w4_sequence_windows(spark, d).where("split = 'train'")
    full = more.t3c_hash_order_spans(spark, d).join(spans.select(F.col("first_id").alias("first_target"), F.col("valid_targets").alias("targets")), "first_target")
    part = full.where("targets < 2048").select(F.col("ord").alias("at"))
    last = F.coalesce(F.max("at"), F.lit(2**62))
    moved = full.join(part.agg(last.alias("at"))).withColumn("ord", F.when(F.col("targets") < 2048, F.lit(-1)).when(F.col("ord") > F.col("at"), F.col("ord") - 1).otherwise(F.col("ord")))
    total = full.agg((F.count(F.lit(1)) - 1).alias("end"))
    return order.span_order_valid(moved.join(total).withColumn("ord", F.when(F.col("ord") < 0, F.col("end")).otherwise(F.col("ord"))), n - 1)


@query("with p as (select doc_id, substr(md5(text), 1, 1) in ('0', '1', '2', '3', '4', '5', '6', '7') low from documents) select count(*)::bigint as rows, (count_if(low) + count_if(not low))::bigint as parts, (select count(*) from (select doc_id from p where low intersect select doc_id from p where not low))::bigint as shared from p")
def u5_partition_union_identity(spark, d):
    """Rows of the table, of its hash-prefix partitions together, and ids that two partitions share."""
    return more.u5_partition_union_identity(spark, d)


@query("select source, sha256(string_agg(part, '' order by prefix)) as snapshots, sum(n)::bigint as n from (select source, substr(sha, 1, 3) prefix, sha256(string_agg(sha, '' order by sha)) part, count(*) n from (select distinct source, sha256(text) sha from documents) group by all) group by source")
def m28_governed_metadata(spark, d):
    """The digest that binds a source to its snapshots' digests: those of one prefix are bound first, so no task holds all digests of a source."""
    rows = table(spark, d, "documents").select("source", F.sha2("text", 256).alias("sha")).distinct()
    bound = lambda c: F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*c))), lambda x: x[c[-1]]), ""), 256)
    parts = rows.groupBy("source", F.substring("sha", 1, 3).alias("prefix")).agg(bound(["sha"]).alias("part"), F.count(F.lit(1)).alias("n"))
    return parts.groupBy("source").agg(bound(["prefix", "part"]).alias("snapshots"), F.sum("n").alias("n"))


# --- tokens


def byte_ids(spark, d) -> DataFrame:
    ids = F.transform(F.regexp_extract_all(F.hex(F.col("text").cast("binary")), F.lit(".."), F.lit(0)), lambda x: 4 + F.conv(x, 16, 10).cast("int"))
    return table(spark, d, "documents").where("text is not null").select("doc_id", ids.alias("ids"))


@query("select doc_id, len(ids)::bigint as n, sha256(array_to_string(ids, ' ')) as digest from (select doc_id, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: 4 + ('0x' || x)::int) ids from documents where text is not null)")
def m18_byte_tokenize(spark, d):
    """Every byte of every text."""
    return byte_ids(spark, d).select("doc_id", F.size("ids").cast("long").alias("n"), F.sha2(F.array_join("ids", " "), 256).alias("digest"))


@query("select doc_id, sha256(encode(text)) as digest, strlen(text)::bigint as bytes from documents where text is not null")
def m17_bpe_decode(spark, d):
    """What decoding gives back of every encoded text: its own bytes."""
    rules = more.rules_of(spark, d)
    found = bpe.decode(bpe.encode(table(spark, d, "documents").where("text is not null"), rules), rules)
    return found.select("doc_id", F.sha2("raw", 256).alias("digest"), F.octet_length("raw").cast("long").alias("bytes"))


@query(f"select split, count(*)::bigint as spans, sum(valid_targets)::bigint as targets, max(first_id)::bigint as last from ({core.SQL['w4_sequence_windows']}) group by split")
def s10_span_loader(spark, d):
    """What a loader hands out of each split: its spans in order, every one checked to begin where the last one ended."""
    rows = [(split, *order.load_spans(core.w4_sequence_windows(spark, d).where(F.col("split") == split))) for split in ("test", "train", "validation")]
    return spark.createDataFrame([r for r in rows if r[1]], "split string, spans long, targets long, last long")
