"""Queries of the remaining dataflow operators: ranges, rules, set joins, layouts and schedules."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.functions import python_code, strict_json
from sparkloom.functions.hashing import lp
from sparkloom.operators import bpe, order, prepare, text
from sparkloom.plans import core
from sparkloom.plans.core import ORDERED, PREP, TOKENED, docs, lp_sql, quoted, tokened, w1_w2_document_order
from sparkloom.plans.tables import PROTECTED, REPO, TOKENS, protected, repo, table
from sparkloom.sources import files, sinks

QUERIES: dict = {}
SQL: dict[str, str] = {}
P = prepare.PRIME


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def tk_of(column: str = "text"):
    return text.lexical_tokens(text.newline_normalize(F.col(column)))


# --- sources and sinks

OUTCOME = "case when not regexp_matches(text, 'MIT|Apache') and regexp_matches(text, 'License') then 'skipped_license' when octet_length(encode(text)) > 20000 then 'skipped_oversize' when source = '' then 'skipped_unusable_identity' when contains(source, chr(92)) then 'skipped_unusable_path' end"


@query(f"with r as (select doc_id, {OUTCOME} o, md5(text) h from documents), f as (select h, min(doc_id) first from r where o is null group by h) select coalesce(o, case when doc_id <> first then 'skipped_duplicate' end, 'admitted') as outcome, count(*)::bigint as n from r left join f using (h) group by 1")
def s4_parquet_content_scan(spark, d):
    t = F.col("text")
    reason = F.when(~t.rlike("MIT|Apache") & t.rlike("License"), "skipped_license").when(F.octet_length(t) > 20000, "skipped_oversize").when(F.col("source") == "", "skipped_unusable_identity").when(F.contains("source", F.lit("\\")), "skipped_unusable_path")
    rows = docs(spark, d).select("doc_id", reason.alias("o"), F.md5("text").alias("h"))
    first = rows.where("o is null").groupBy("h").agg(F.min("doc_id").alias("first"))
    outcome = F.coalesce("o", F.when(F.col("doc_id") != F.col("first"), "skipped_duplicate"), F.lit("admitted"))
    return rows.join(first, "h", "left").groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def parted(spark, d, size=300):
    rows = docs(spark, d).select("doc_id", F.sha2("text", 256).alias("line")).withColumn("bucket", F.floor(F.col("doc_id") / 5000))
    return files.ranked(rows, "bucket", "doc_id", size).drop("bucket")


PARTED = "(select doc_id, sha256(text) line, (row_number() over (order by doc_id) - 1) // 300 part, (row_number() over (order by doc_id) - 1) % 300 ordinal from documents)"


@query(f"select part::bigint as part, count(*)::bigint as rows, octet_length(encode(string_agg(line, chr(10) order by ordinal)))::bigint as bytes, sha256(string_agg(line, chr(10) order by ordinal)) as sha256 from {PARTED} group by part")
def k3_sharded_manifest_sink(spark, d):
    return sinks.sharded_manifest(parted(spark, d))


@query(f"select doc_id, part::bigint as part, ordinal::bigint as ordinal from {PARTED}")
def s6a_j12_index_part_join(spark, d):
    """Rows of the parts that agree with the index in number and digest."""
    rows = parted(spark, d)
    index = sinks.sharded_manifest(rows).select("part", "rows", "sha256")
    return files.sharded_manifest_scan(index, rows).select("doc_id", "part", F.col("ordinal").cast("long").alias("ordinal"))


def token_docs(spark, d) -> DataFrame:
    """Documents as token ids (a token's id is 4 and the first byte of its digest; 3 ends a document) at their offsets in their split."""
    ids = F.concat(F.transform(tk_of(), lambda t: 4 + F.conv(F.substring(F.md5(t), 1, 2), 16, 10).cast("int")), F.array(F.lit(3)))
    return docs(spark, d).select("doc_id", ids.alias("ids")).join(w1_w2_document_order(spark, d).select("doc_id", "split", "first_id"), "doc_id")


IDS = f"(select doc_id, list_append(list_transform({TOKENS}, lambda t: 4 + ('0x' || substr(md5(t), 1, 2))::int), 3) ids from documents)"
STREAM = f"(select doc_id, split, first_id + unnest(range(len(ids))) pos, unnest(ids) id from {IDS} join {ORDERED} using (doc_id))"


@query(f"select split, (pos // 65536)::bigint as shard, count(*)::bigint as ids, min(pos)::bigint as first, sum(id)::bigint as checksum from {STREAM} group by all")
def k4_token_shard_sink(spark, d):
    pieces = sinks.token_shards(token_docs(spark, d), 65536)
    total = F.aggregate("ids", F.lit(0).cast("long"), lambda s, x: s + x)
    return pieces.groupBy("split", "shard").agg(F.sum(F.size("ids")).alias("ids"), F.min("first").alias("first"), F.sum(total).alias("checksum"))


@query(f"select pos::bigint as pos, id::int as id from {STREAM} where split = 'train' and pos between 60000 and 72999")
def s8_token_shard_scan(spark, d):
    return sinks.read_range(sinks.token_shards(token_docs(spark, d), 65536), "train", 60000, 13000, 65536)


@query(f"select doc_id, len(ids)::int as n, ids[-1]::int as last_id, sha256(array_to_string(ids, ' ')) as digest from {IDS} where doc_id in (select doc_id from labels where toxic = 1)")
def s9_token_doc_lookup(spark, d):
    wanted = table(spark, d, "labels").where("toxic = 1").select("doc_id").distinct()
    pieces = sinks.token_shards(token_docs(spark, d), 65536)
    index = tokened(spark, d).select("doc_id").join(wanted, "doc_id").join(w1_w2_document_order(spark, d).select("doc_id", "split", "first_id"), "doc_id").join(tokened(spark, d).select("doc_id", "stored"), "doc_id")
    # a document lies in the shards from its first to its last id, so index and shards meet by equality
    at = index.withColumn("shard", F.explode(F.sequence(F.floor(F.col("first_id") / 65536), F.floor((F.col("first_id") + F.col("stored") - 1) / 65536))))
    own = (F.col("first") >= F.col("first_id")) & (F.col("first") < F.col("first_id") + F.col("stored"))
    met = at.join(pieces, ["split", "shard"]).where(own).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("first", "ids"))).alias("p"))
    whole = met.select("doc_id", F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids"))
    return whole.select("doc_id", F.size("ids").alias("n"), F.element_at("ids", -1).alias("last_id"), F.sha2(F.array_join("ids", " "), 256).alias("digest"))


@query(f"with e as (select split, pos from {STREAM} where id = 3), x as (select split, first_id + stored - 1 pos from {ORDERED}) select coalesce(e.split, x.split) as split, count(*)::bigint as documents, count_if(e.pos is null or x.pos is null)::bigint as unmatched from e full join x on e.split = x.split and e.pos = x.pos group by 1")
def j9_eos_position_check(spark, d):
    rows = token_docs(spark, d)
    found = rows.select("split", "first_id", F.posexplode("ids").alias("i", "id")).where("id = 3").select("split", (F.col("first_id") + F.col("i")).alias("pos"), F.lit(1).alias("e"))
    want = rows.select("split", (F.col("first_id") + F.size("ids") - 1).alias("pos"), F.lit(1).alias("x"))
    return found.join(want, ["split", "pos"], "full_outer").groupBy("split").agg(F.count(F.lit(1)).alias("documents"), F.count_if(F.col("e").isNull() | F.col("x").isNull()).alias("unmatched"))


# --- projections, filters, predicates


@query("select doc_id, case when lang <> 'en' then 'DIALECT_UNSUPPORTED' end as reason from documents")
def f7_dialect_filter(spark, d):
    return docs(spark, d).select("doc_id", F.when(F.col("lang") != "en", "DIALECT_UNSUPPORTED").alias("reason"))


@query("select doc_id from documents where doc_id not in (select doc_id from labels where quality = 0) and source not in (select source from documents where doc_id % 97 = 0)")
def f9_removal_filter(spark, d):
    return core.j4_removal_semi_join(spark, d).where("not removed").select("doc_id")


# --- signatures and candidate joins


def signed_sql(sets: str, key: str = "doc_id") -> str:
    """``key, i, m``: the minima of the affine maps, from a table of ``key, sh``."""
    bits = "('0x' || substr(md5({0}), 1, 15))::bigint"
    folded = f"((a * x + b) & {P}::hugeint) + ((a * x + b) >> 61)"  # modulo 2^61-1, but for one subtraction
    return f"(select {key}, i, min((case when {folded} >= {P} then {folded} - {P} else {folded} end)::bigint) m from (select {key}, {bits.format('unnest(sh)')}::hugeint x from {sets}) cross join (select i, (1 + {bits.format(chr(39) + 'a' + chr(39) + ' || i')})::hugeint a, {bits.format(chr(39) + 'b' + chr(39) + ' || i')}::hugeint b from range({prepare.COMPONENTS}) t(i)) group by {key}, i)"


def banded_sql(sets: str, key: str = "doc_id") -> str:
    """``key, band, key``: the digests of each run of components."""
    return f"(select {key}, band, ('0x' || substr(sha256(band::varchar || ':' || string_agg(m::varchar, ':' order by i)), 1, 15))::bigint as key from (select *, (i // {prepare.ROWS})::int band from {signed_sql(sets, key)}) group by {key}, band)"


ITEMS = f"(select item_id, {core.SHINGLES} sh from (select item_id, {TOKENS} tk from {PROTECTED}))"


@query(f"select doc_id, count(*)::int as n, md5(string_agg(m::varchar, ',' order by i)) as digest from {signed_sql(PREP)} group by doc_id")
def a3_minhash_signature(spark, d):
    """A digest of each document's signature of 256 components."""
    found = prepare.signatures(prepare.hashed(docs(spark, d)))
    return found.select("doc_id", F.size("signature").alias("n"), F.md5(F.array_join("signature", ",")).alias("digest"))


@query(f"select * from {banded_sql(PREP)}")
def a4_lsh_band_keys(spark, d):
    return prepare.bands(prepare.signatures(prepare.hashed(docs(spark, d))))


@query(f"select band, key, count(*)::bigint as n, min(doc_id) as first_doc from {banded_sql(PREP)} group by all having count(*) > 1")
def j2_lsh_self_join(spark, d):
    """Documents that meet in a band, as groups with their first member: the join's links without a row for each pair."""
    return a4_lsh_band_keys(spark, d).groupBy("band", "key").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc")).where("n > 1")


@query(f"select distinct a.doc_id, b.item_id from {banded_sql(PREP)} a join {banded_sql(ITEMS, 'item_id')} b using (band, key)")
def j2b_lsh_bench_join(spark, d):
    items = prepare.hashed(protected(spark, d), "item_id")
    keys = prepare.bands(prepare.signatures(items, key="item_id"), key="item_id")
    return a4_lsh_band_keys(spark, d).join(keys, ["band", "key"]).select("doc_id", "item_id").distinct()


@query(f"with f as {core.FIRSTS}, k as {banded_sql('f')} select u, v, len(list_intersect(a.sh, b.sh))::int as common, (100 * len(list_intersect(a.sh, b.sh)) > 85 * (len(a.sh) + len(b.sh) - len(list_intersect(a.sh, b.sh)))) as near from (select distinct a.doc_id u, b.doc_id v from k a join k b using (band, key) where a.doc_id < b.doc_id) join f a on a.doc_id = u join f b on b.doc_id = v")
def a5_jaccard(spark, d):
    """Overlap of all pairs that meet in a band, of the first documents of equal shingle sets."""
    sets, _ = prepare.classes(docs(spark, d))
    found = prepare.overlaps(prepare.candidates(sets), sets)
    return found.select("u", "v", "common", (100 * F.col("common") > 85 * (F.col("sizes") - F.col("common"))).alias("near"))


@query(f"select d.doc_id, b.item_id from (select doc_id, {TOKENS} tk from documents) d join (select item_id, {TOKENS} tk from {PROTECTED}) b on d.tk = b.tk where len(b.tk) < 50")
def j6_short_sequence_join(spark, d):
    b = protected(spark, d).select("item_id", tk_of().alias("bt")).where(F.size("bt") < 50).select("item_id", "bt", F.xxhash64("bt").alias("h"))
    rows = docs(spark, d).select("doc_id", tk_of().alias("dt")).where(F.size("dt") < 50).withColumn("h", F.xxhash64("dt"))
    return rows.join(b, "h").where(F.col("dt") == F.col("bt")).select("doc_id", "item_id")


@query("select (select count(*) from documents d join labels l using (doc_id))::bigint as bound, (select count(*) from labels where doc_id not in (select doc_id from documents))::bigint as unbound")
def j11_binding_check(spark, d):
    """Labels that name a document, and those that name none."""
    rows = docs(spark, d).select("doc_id", F.lit(1).alias("hit"))
    met = table(spark, d, "labels").select("doc_id").join(rows, "doc_id", "left")
    return met.agg(F.count_if(F.col("hit").isNotNull()).alias("bound"), F.count_if(F.col("hit").isNull()).alias("unbound"))


# --- aggregations

KEPT = core.CLUSTERS + f", bad as (select distinct label from cl join (select doc_id from documents d join benchmark b on contains(d.text, b.text)) on doc_id = id), g as (select id, label, {REPO} repo from cl join documents on id = doc_id where label not in (select label from bad)), ge as (select a.id u, b.id v from g a join g b on (a.label = b.label or a.repo = b.repo) and a.id <> b.id), r2 as (select id, id l from g union select ge.v, r2.l from r2 join ge on r2.id = ge.u) select id as doc_id, min(l) as component from r2 group by id"


@query(KEPT)
def a11_split_components(spark, d):
    """Components over clusters and repositories after contaminated clusters are gone."""
    clusters = core.a6_connected_components(spark, d)
    clean = core.a9_cluster_contaminated(spark, d).where("not contaminated").select("cluster")
    kept = clusters.join(clean, "cluster").select(F.col("doc_id").alias("id"), F.col("cluster").alias("label"))
    return prepare.splits(kept, docs(spark, d).select("doc_id", repo().alias("repo"))).select("doc_id", "component")


@query(f"select t.i as token, count(x.id)::bigint as n from range(4, 260) t(i) left join (select unnest(ids) id from {IDS}) x on x.id = t.i group by t.i")
def a18_token_frequencies(spark, d):
    counts = token_docs(spark, d).select(F.explode("ids").alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return spark.range(4, 260).withColumnRenamed("id", "token").join(counts, F.col("token") == F.col("id"), "left").select("token", F.coalesce("n", F.lit(0)).alias("n"))


# --- ordered computations

RANKED = f"(select doc_id, {REPO} repo, octet_length(encode(text)) bytes, row_number() over (order by sha256('sample' || doc_id::varchar), doc_id) k from documents)"


@query(f"with recursive r as (select * from {RANKED}), s as (select 0::bigint k, null::bigint doc_id, map([''], [0::bigint]) m, 0::bigint total, false admitted union all select r.k, r.doc_id, case when coalesce(m[repo], 0) + bytes <= 30000 and total + bytes <= 1000000 then map_concat(m, map([repo], [(coalesce(m[repo], 0) + bytes)::bigint])) else m end, case when coalesce(m[repo], 0) + bytes <= 30000 and total + bytes <= 1000000 then (total + bytes)::bigint else total end, coalesce(m[repo], 0) + bytes <= 30000 and total + bytes <= 1000000 from s join r on r.k = s.k + 1) select doc_id, admitted from s where doc_id is not null")
def w5_greedy_cap_admission(spark, d):
    rows = docs(spark, d).select("doc_id", repo().alias("repo"), F.octet_length("text").alias("bytes"))
    rank = F.sha2(F.concat(F.lit("sample"), F.col("doc_id").cast("string")), 256)
    return order.greedy_admission(rows, [rank, F.col("doc_id")], "doc_id", "repo", "bytes", 30_000, 1_000_000)


@query("with g as (select distinct user_id, event_id from events), r as (select *, row_number() over (partition by user_id order by event_id desc) k from g), a as (select user_id, min(event_id) event_id from g, (values (2000), (4000), (6000)) t(x) where event_id >= x group by user_id, x) select distinct user_id, event_id from (select user_id, event_id from r where k <= 2 union all select * from a)")
def w10_checkpoint_retention(spark, d):
    """Two newest generations of each run, and the first at or past each anchor."""
    g = table(spark, d, "events").select("user_id", "event_id")
    anchors = [F.min(F.when(F.col("event_id") >= x, F.col("event_id"))).alias(f"a{x}") for x in (2000, 4000, 6000)]
    top = F.max("event_id").alias("n1")
    one = g.groupBy("user_id").agg(top, *anchors)
    second = g.join(one.select("user_id", "n1"), "user_id").where("event_id < n1").groupBy("user_id").agg(F.max("event_id").alias("n2"))
    kept = one.join(second, "user_id", "left").select("user_id", F.explode(F.array_distinct(F.array_compact(F.array("n1", "n2", "a2000", "a4000", "a6000")))).alias("event_id"))
    return kept


WINDOWS = core.SQL["w4_sequence_windows"]


@query(f"select split, (first_id // 65536)::bigint as update_no, count(*)::bigint as spans, sum(valid_targets)::bigint as targets from ({WINDOWS}) group by all")
def w13_micro_batching(spark, d):
    """Whole spans of each exact window of 65,536 targets."""
    return core.w4_sequence_windows(spark, d).groupBy("split", F.floor(F.col("first_id") / 65536).alias("update_no")).agg(F.count(F.lit(1)).alias("spans"), F.sum("valid_targets").alias("targets"))


@query(f"select split, sequence, first_id, (40960 % 2048 = 0) as on_boundary from ({WINDOWS}) where first_id >= 40960")
def w14_resume_cursor(spark, d):
    return core.w4_sequence_windows(spark, d).where("first_id >= 40960").select("split", "sequence", "first_id", F.lit(40960 % 2048 == 0).alias("on_boundary"))


@query(f"select doc_id, sha256(array_to_string(ids[:-2], ' ')) as inputs, sha256(array_to_string(ids[2:], ' ')) as targets from {IDS} where len(ids) > 1")
def w15_input_target_shift(spark, d):
    ids, n = F.col("ids"), F.size("ids") - 1
    hashed = lambda x: F.sha2(F.array_join(x, " "), 256)
    return token_docs(spark, d).where(n > 0).select("doc_id", hashed(F.slice(ids, 1, n)).alias("inputs"), hashed(F.slice(ids, 2, n)).alias("targets"))


# --- order and samples


@query()
def t3_fisher_yates_order(spark, d):
    """The seeded order of the train split's spans."""
    n = tokened(spark, d).where("split = 'train'").agg(F.sum("stored")).first()[0]
    return order.span_order(spark, n, order.span_seed("sparkloom/span/v1", "00" * 32, "11" * 32))


@query(f"select first_id as first_target, row_number() over (order by sha256('span' || first_id::varchar), first_id) - 1 as ord from ({WINDOWS}) where split = 'train'")
def t3c_hash_order_spans(spark, d):
    """The order of t3b over all spans of the train split."""
    rows = core.w4_sequence_windows(spark, d).where("split = 'train'").select(F.col("first_id").alias("first_target"))
    rows = rows.withColumn("h", F.sha2(F.concat(F.lit("span"), F.col("first_target").cast("string")), 256)).withColumn("bucket", F.substring("h", 1, 4))
    before = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).select("bucket", F.coalesce(F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("b"))
    at = F.row_number().over(Window.partitionBy("bucket").orderBy("h", "first_target")) - 1
    return rows.withColumn("at", at).join(F.broadcast(before), "bucket").select("first_target", (F.col("b") + F.col("at")).alias("ord"))


@query(f"select split, sequence, first_id, least(valid_targets, 1000)::bigint as targets from (select *, row_number() over (partition by split order by sha256('eval' || first_id::varchar), first_id) k from ({WINDOWS})) where k <= 20")
def t6_eval_sample_ranked(spark, d):
    w = Window.partitionBy("split").orderBy(F.sha2(F.concat(F.lit("eval"), F.col("first_id").cast("string")), 256), "first_id")
    return core.w4_sequence_windows(spark, d).withColumn("k", F.row_number().over(w)).where("k <= 20").select("split", "sequence", "first_id", F.least("valid_targets", F.lit(1000)).cast("long").alias("targets"))


@query(f"select split, sequence, least(valid_targets, 10000 - first_id)::bigint as targets from ({WINDOWS}) where first_id < 10000")
def t7_eval_sample_prefix(spark, d):
    return core.w4_sequence_windows(spark, d).where("first_id < 10000").select("split", "sequence", F.least(F.col("valid_targets"), 10000 - F.col("first_id")).alias("targets"))


@query("select doc_id, exists (select 1 from benchmark b where contains(d.text, b.text)) as hit from documents d")
def t8_first_hit(spark, d):
    hits = core.j7_substring_join(spark, d).select("doc_id").distinct().withColumn("h", F.lit(True))
    return docs(spark, d).select("doc_id").join(hits, "doc_id", "left").select("doc_id", F.coalesce("h", F.lit(False)).alias("hit"))


@query("select 'a' as generation, doc_id, sha256(text) as sha from documents where lang = 'en' union all select 'b', doc_id, sha256(text) from documents where lang <> 'en'")
def u1_generation_union(spark, d):
    rows = docs(spark, d).select("doc_id", "lang", F.sha2("text", 256).alias("sha"))
    part = lambda name, rule: rows.where(rule).select(F.lit(name).alias("generation"), "doc_id", "sha")
    return part("a", "lang = 'en'").unionByName(part("b", "lang <> 'en'"))


def u5_partition_union_identity(spark, d):
    """Rows of the table, of its hash-prefix partitions together, and ids that two partitions share."""
    rows = docs(spark, d).select("doc_id", F.substring(F.md5("text"), 1, 1).alias("p"))
    parts = None
    for k in ("01234567", "89abcdef"):
        piece = rows.where(F.col("p").isin(*k)).select("doc_id", F.lit(k).alias("k"))
        parts = piece if parts is None else parts.unionByName(piece)
    each = parts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("k").alias("ks"))
    return each.agg(F.sum("n").alias("parts"), F.count_if(F.col("ks") > 1).alias("shared")).join(rows.agg(F.count(F.lit(1)).alias("rows"))).select("rows", "parts", "shared")


# --- scalar functions


def kind_of(t):
    return F.when(t.rlike("^[0-9]+$"), "integer").when(t.rlike(r"^[\p{L}\p{N}_]+$"), "identifier").otherwise(t)


KIND = r"case when regexp_matches(t, '^[0-9]+$') then 'integer' when regexp_matches(t, '^[\p{L}\p{N}_]+$') then 'identifier' else t end"


@query(f"select item_id, sha256(unhex(string_agg(hex({lp_sql('kind')} || {lp_sql('t')}), '' order by i))) as digest from (select item_id, t, i, {KIND} kind from (select item_id, unnest({TOKENS}) t, unnest(range(len({TOKENS}))) i from benchmark)) group by item_id")
def m2_m11_lexical_digest(spark, d):
    """Tokens with kinds, each with its length in front, and the digest of their run."""
    encoded = F.transform(tk_of(), lambda t: F.hex(F.concat(lp(kind_of(t)), lp(t))))
    return table(spark, d, "benchmark").select("item_id", F.sha2(F.unhex(F.array_join(encoded, "")), 256).alias("digest"))


@query(f"select doc_id, len(tk)::int as n, sha256(encode('short/v1') || '\\x00'::blob || {core.U64LE.format('len(tk)')} || encode(array_to_string(tk, ' '))) as digest from {PREP} where len(tk) < 5")
def m3_short_shingle(spark, d):
    from sparkloom.functions.hashing import u64le

    body = F.concat(F.lit(b"short/v1\0"), u64le(F.size("tk")), F.array_join("tk", " ").cast("binary"))
    return docs(spark, d).select("doc_id", tk_of().alias("tk")).where(F.size("tk") < 5).select("doc_id", F.size("tk").alias("n"), F.sha2(body, 256).alias("digest"))


@query()
def m12_m13_canonical_json(spark, d):
    return table(spark, d, "events").select("event_id", strict_json.canonical_json("props").alias("canonical"))


def rules_of(spark, d, n=6):
    return bpe.train(table(spark, d, "benchmark"), n)


@query()
def m19_bpe_train(spark, d):
    rules = rules_of(spark, d)
    return spark.createDataFrame([(bpe.FIRST_MERGE + i, a, b) for i, (a, b) in enumerate(rules)], "id int, left_id int, right_id int")


@query()
def m16_bpe_encode(spark, d):
    found = bpe.encode(docs(spark, d), rules_of(spark, d))
    return found.select("doc_id", F.size("ids").alias("n"), F.sha2(F.array_join("ids", " "), 256).alias("digest"))


@query("select vec_id, i as token, round(x - 0.0025 * (x / (sqrt(x * x) + 1e-8) + 0.1 * x), 9) as stepped from (select vec_id, unnest(range(len(embedding))) i, unnest(embedding)::double x from embeddings)")
def m21_adamw_step(spark, d):
    """The first AdamW step with the parameter as its own gradient: both moments' corrections cancel."""
    x = table(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("token", "x")).select("vec_id", F.col("token").cast("long").alias("token"), F.col("x").cast("double").alias("x"))
    return x.select("vec_id", "token", F.round(F.col("x") - 0.0025 * (F.col("x") / (F.sqrt(F.col("x") * F.col("x")) + 1e-8) + 0.1 * F.col("x")), 9).alias("stepped"))


@query()
def m22_m31_renderings(spark, d):
    x = table(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("token", "x"))
    return x.select("vec_id", "token", strict_json.bf16_bits("x").alias("bf16"), strict_json.f64_le_hex(F.col("x").cast("double")).alias("f64"))


# The canonical model's sizes, its planning limits and the order of its phases.
VOCABULARY, WIDTH, FFN, LAYERS, QUERY_HEADS, KV_HEADS, HEAD, CONTEXT = 32000, 768, 2432, 12, 12, 4, 64, 2048
TARGETS, UPDATE, EVENT, STATE_FACTOR, QUANTUM, SLA = 2_000_000_000, 65536, 100_000_000, 20, 268_435_456, 28_800
PHASES = ["P7", "P7A", "P8", "P9A", "P9B", "P10", "P11", "P12", "P13", "P14", "P15", "P16", "P16A"]


@query(f"select name, (r * c)::bigint as elements from (select 'blocks.' || b::varchar || '.' || n as name, r, c from range({LAYERS}) t(b), (values ('attn_norm.weight', {WIDTH}, 1), ('attn.q.weight', {WIDTH}, {WIDTH}), ('attn.k.weight', {KV_HEADS * HEAD}, {WIDTH}), ('attn.v.weight', {KV_HEADS * HEAD}, {WIDTH}), ('attn.o.weight', {WIDTH}, {WIDTH}), ('ffn_norm.weight', {WIDTH}, 1), ('ffn.gate.weight', {FFN}, {WIDTH}), ('ffn.up.weight', {FFN}, {WIDTH}), ('ffn.down.weight', {WIDTH}, {FFN})) u(n, r, c) union all values ('tok_embeddings.weight', {VOCABULARY}, {WIDTH}), ('final_norm.weight', {WIDTH}, 1), ('lm_head.weight', {VOCABULARY}, {WIDTH}))")
def m24_parameter_layout(spark, d):
    square, kv, ffn = WIDTH * WIDTH, KV_HEADS * HEAD * WIDTH, FFN * WIDTH
    block = {"attn_norm": WIDTH, "attn.q": square, "attn.k": kv, "attn.v": kv, "attn.o": square, "ffn_norm": WIDTH, "ffn.gate": ffn, "ffn.up": ffn, "ffn.down": ffn}
    entries = F.array(*[F.struct(F.lit(f".{n}.weight").alias("n"), F.lit(size).cast("long").alias("elements")) for n, size in block.items()])
    rows = spark.range(LAYERS).select("id", F.explode(entries).alias("e")).select(F.concat(F.lit("blocks."), F.col("id").cast("string"), "e.n").alias("name"), "e.elements")
    ends = [("tok_embeddings.weight", VOCABULARY * WIDTH), ("final_norm.weight", WIDTH), ("lm_head.weight", VOCABULARY * WIDTH)]
    return rows.union(spark.createDataFrame(ends, "name string, elements long"))


@query(f"with p as ({SQL['m24_parameter_layout']}), s as (select sum(elements)::bigint n from p) select n as parameters, ((20 * n + {QUANTUM - 1}) // {QUANTUM} * {QUANTUM})::bigint as memory, 30518::bigint as updates, 976562::bigint as spans, 21::bigint as evaluations, 25920::bigint as admission_seconds from s")
def m25_m27_scale_up_plan(spark, d):
    """Sizes that follow from the layout and the number of targets; an evaluation falls on the update that crosses each interval, on the start and the end."""
    n = F.sum("elements")
    crossed = F.transform(F.sequence(F.lit(1), F.lit(TARGETS // EVENT)), lambda k: F.least(F.ceil(k * F.lit(EVENT).cast("long") / UPDATE) * UPDATE, F.lit(TARGETS)))
    marks = F.size(F.array_distinct(F.concat(F.array(F.lit(0).cast("long"), F.lit(TARGETS).cast("long")), F.transform(crossed, lambda x: x.cast("long")))))
    return m24_parameter_layout(spark, d).agg(n.alias("parameters")).select(
        "parameters", (F.floor((STATE_FACTOR * F.col("parameters") + QUANTUM - 1) / QUANTUM) * QUANTUM).alias("memory"), F.lit(-(-TARGETS // UPDATE)).cast("long").alias("updates"),
        F.lit(TARGETS // CONTEXT).cast("long").alias("spans"), marks.cast("long").alias("evaluations"), F.lit(SLA // 10 * 9).cast("long").alias("admission_seconds"),
    )


@query("select * from (values ('vocabulary', 'P7,P7A,P8,P9A,P9B,P10,P11,P12,P13,P14,P15,P16,P16A'), ('context', 'P8,P9A,P9B,P10,P11,P12,P13,P14,P15,P16,P16A'), ('targets', 'P8,P9A,P9B,P10,P11,P12,P13,P14,P15,P16,P16A'), ('layers', 'P9B,P10,P11,P12,P13,P14,P15,P16,P16A'), ('sla', 'P14,P15,P16,P16A')) t(changed, phases)")
def m26_rerun_phases(spark, d):
    chain = F.array(*map(F.lit, PHASES))
    first = F.when(F.col("changed") == "vocabulary", "P7").when(F.col("changed").isin("context", "targets"), "P8").when(F.col("changed") == "layers", "P9B").otherwise("P14")
    rows = spark.createDataFrame([(c,) for c in ("vocabulary", "context", "targets", "layers", "sla")], "changed string")
    return rows.select("changed", F.array_join(F.slice(chain, F.array_position(chain, first).cast("int"), F.lit(len(PHASES))), ",").alias("phases"))


@query("select count(*)::bigint as items, count(distinct item_id) = count(*) as unique_ids, count_if(text is null or text = '') = 0 as whole from benchmark")
def m32_benchmark_manifest_guard(spark, d):
    return table(spark, d, "benchmark").agg(F.count(F.lit(1)).alias("items"), (F.count_distinct("item_id") == F.count(F.lit(1))).alias("unique_ids"), (F.count_if(F.col("text").isNull() | (F.col("text") == "")) == 0).alias("whole"))
