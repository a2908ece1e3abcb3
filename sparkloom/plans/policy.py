"""Queries of the source policy: sources made of the documents' lines, as Python files, each with its SQL.

A document's lines become comments, every third an assignment; remainders of its
id decide whether the file fails to parse, says that it is generated (in a
comment or outside one, in the head or beyond it), has more code than comments,
and what its last line assigns. The SQL knows these from the rule; the operators parse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import python_code
from sparkloom.operators import text
from sparkloom.plans import privacy
from sparkloom.plans.privacy import LINES, quoted, sql_list
from sparkloom.plans.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}
LICENCES = ("MIT", "Apache-2.0", "GPL-3.0-only", "BSD-2-Clause", "MIT-0", "Python-2.0", "CC0-1.0", "Unlicense", "ISC", "0BSD", "LicenseRef-private", "Zlib", "BSL-1.0", "BSD-3-Clause")
#: Which of the lines are Python statements.
VALID = tuple(python_code.parses(x) for x in LINES)


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


CLEAN = "regexp_replace(replace(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), chr(13), chr(10)), '[\\x00-\\x09\\x0B-\\x1F\\x7F\\x{85}\\x{2028}\\x{2029}]', ' ', 'g')"
HEADERS = ("", "# Code Generated by a tool, do not touch", "s = 'do not edit'")
ENDS = ("", "# @generated", "x = = 1")
CODE_LINES = (
    f"list_concat([{sql_list(HEADERS)}[(doc_id % 3 + 1)::int]], list_transform(string_split({CLEAN}, chr(10)), lambda l, i: case when (i - 1 + doc_id) % 3 = 0 then 'v' || (i - 1)::varchar || ' = 1' else '# ' || l end),"
    f" [case when doc_id % 2 = 0 then 'pad = ' || chr(39) || repeat('x', (2 * strlen(coalesce(text, '')) + 100)::int) || chr(39) else '' end, {sql_list(LINES)}[(doc_id % {len(LINES)} + 1)::int], {sql_list(ENDS)}[(doc_id % 4 + 1)::int]])"
).replace("[(doc_id % 3 + 1)::int]", "[(case when doc_id % 10 < 7 then 1 when doc_id % 10 = 7 then 2 else 3 end)::int]").replace("[(doc_id % 4 + 1)::int]", "[(case when doc_id % 12 = 5 then 2 when doc_id % 12 = 11 then 3 else 1 end)::int]")
LINED = f"(select doc_id, lang, source, {CODE_LINES} ls from documents)"
CODE = f"(select doc_id, lang, source, ls, array_to_string(ls, chr(10)) as text from {LINED})"


def sources(spark, d) -> DataFrame:
    """``doc_id, lang, source, code``."""
    k = F.col("doc_id")
    clean = F.regexp_replace(F.regexp_replace(F.coalesce("text", F.lit("")), "\r\n?", "\n"), "[\\x00-\\x09\\x0B-\\x1F\\x7F\\x{85}\\x{2028}\\x{2029}]", " ")
    body = F.transform(F.split(clean, "\n"), lambda x, i: F.when((i + k) % 3 == 0, F.concat(F.lit("v"), i.cast("string"), F.lit(" = 1"))).otherwise(F.concat(F.lit("# "), x)))
    head = F.when(k % 10 < 7, HEADERS[0]).when(k % 10 == 7, HEADERS[1]).otherwise(HEADERS[2])
    line = F.element_at(F.array(*map(F.lit, LINES)), (k % len(LINES) + 1).cast("int"))
    end = F.when(k % 12 == 5, ENDS[1]).when(k % 12 == 11, ENDS[2]).otherwise(ENDS[0])
    pad = F.when(k % 2 == 0, F.concat(F.lit("pad = '"), F.repeat(F.lit("x"), (2 * F.coalesce(F.octet_length("text"), F.lit(0)) + 100).cast("int")), F.lit("'"))).otherwise("")
    return table(spark, d, "documents").select("doc_id", "lang", "source", F.array_join(F.concat(F.array(head), body, F.array(pad, line, end)), "\n").alias("code"))


def parsed(spark, d) -> DataFrame:
    """``doc_id, raw, facts`` of the sources."""
    return sources(spark, d).select("doc_id", F.col("code").cast("binary").alias("raw"), python_code.parse_facts("code").alias("facts"))


PARSED = f"(doc_id % 12 <> 11 and {sql_list(tuple(str(v).lower() for v in VALID))}[(doc_id % {len(VALID)} + 1)::int] = 'true')"
ADDED_COMMENT = "(case when starts_with({0}, '#') then strlen({0}) when contains({0}, '  # ') then strlen(substr({0}, strpos({0}, '  # ') + 2)) else 0 end)"
COMMENT = "coalesce(list_sum(list_transform(ls, lambda l: " + ADDED_COMMENT.format("l") + ")), 0)"
OFFSETS = f"(select doc_id, unnest(ls) l, unnest(list_transform(range(len(ls)), lambda i: coalesce(list_sum(list_transform(ls[:i], lambda x: strlen(x) + 1)), 0))) st from {LINED})"
HEADED = f"(select distinct doc_id from (select doc_id, case when st + strlen(l) > {text.HEAD_BYTES} then (case when st >= {text.HEAD_BYTES} then '' else substr(hex(encode(l)), 1, 2 * ({text.HEAD_BYTES} - st)::int) end) else hex(encode(l)) end h from {OFFSETS} where starts_with(l, '#')) where regexp_matches(h, '^(..)*({'|'.join(''.join(f'({ord(c):02X}|{ord(c.upper()):02X})' if c.isalpha() else f'{ord(c):02X}' for c in m) for m in text.GENERATED)})'))"


@query(f"select doc_id, {PARSED} as parsed from documents")
def f14_syntax_filter(spark, d):
    return parsed(spark, d).select("doc_id", "facts.parsed")


@query(f"select doc_id, {PARSED} and doc_id in {HEADED} as generated from documents")
def f12_generated_marker(spark, d):
    return parsed(spark, d).select("doc_id", text.generated_marker(F.col("raw"), F.col("facts.comments")).alias("generated"))


@query(f"select doc_id, not {PARSED} or 2 * {COMMENT} <= strlen(text) as passes from {CODE}")
def f13_comment_ratio(spark, d):
    return parsed(spark, d).select("doc_id", (2 * text.comment_bytes(F.col("facts.comments")) <= F.octet_length("raw")).alias("passes"))


@query(f"select doc_id, case when {PARSED} then {COMMENT} else 0 end::bigint as comment_bytes from {CODE}")
def a21_comment_bytes(spark, d):
    return parsed(spark, d).select("doc_id", text.comment_bytes(F.col("facts.comments")).alias("comment_bytes"))


@query("select conv_id, bool_and(n > 0 and st >= coalesce(b, 0)) and max(e) <= 8 * 100000 as valid from (select *, lag(e) over (partition by conv_id order by turn) b from (select conv_id, turn, length(text) n, 700 * turn st, 700 * turn + length(text) e from conversations)) group by conv_id")
def f18_range_validity(spark, d):
    """Ranges that start every 700 characters and are as long as the turns: some overlap, some are empty."""
    rows = table(spark, d, "conversations").select("conv_id", F.struct((700 * F.col("turn")).cast("long").alias("start"), (700 * F.col("turn") + F.length("text")).cast("long").alias("end")).alias("r"))
    ranges = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("r")).alias("ranges"))
    return ranges.select("conv_id", text.ranges_valid(F.col("ranges"), F.lit(8 * 100_000)).alias("valid"))


@query(f"select doc_id, case doc_id % 4 when 0 then a in {text.PERMISSIVE} when 1 then a in {text.PERMISSIVE} and b in {text.PERMISSIVE} when 2 then a in {text.PERMISSIVE} or b in {text.PERMISSIVE} else a in {text.PERMISSIVE} and (b in {text.PERMISSIVE} or c in {text.PERMISSIVE}) end and doc_id % 9 <> 4 as allowed from (select doc_id, {sql_list(LICENCES)}[(doc_id % 14 + 1)::int] a, {sql_list(LICENCES)}[(doc_id // 14 % 14 + 1)::int] b, {sql_list(LICENCES)}[(doc_id // 5 % 14 + 1)::int] c from documents)")
def f8_licence_filter(spark, d):
    """Expressions of one to three identifiers, with brackets, and broken ones."""
    return table(spark, d, "documents").select("doc_id", python_code.licence_udf(text.PERMISSIVE)(licence()).alias("allowed"))


def licence() -> Column:
    k = F.col("doc_id")
    pick = lambda of: F.element_at(F.array(*map(F.lit, LICENCES)), (of % 14 + 1).cast("int"))
    a, b, c = pick(k), pick(F.floor(k / 14)), pick(F.floor(k / 5))
    whole = F.when(k % 4 == 0, a).when(k % 4 == 1, F.concat(a, F.lit(" AND "), b)).when(k % 4 == 2, F.concat(a, F.lit(" OR "), b)).otherwise(F.concat(a, F.lit(" AND ("), b, F.lit(" OR "), c, F.lit(")")))
    return F.when(k % 9 == 4, F.concat(whole, F.lit(" WITH LLVM-exception"))).otherwise(whole)


@query("select doc_id, case doc_id % 10 when 1 then 'ENCODING_UNSUPPORTED' when 2 then 'ENCODING_CONFLICT' when 3 then 'BOM_REMOVED' when 4 then 'ENCODING_CONFLICT' when 5 then case when regexp_matches(text, '[^\\x00-\\x7F]') then 'ENCODING_INVALID' else 'OK' end when 6 then 'NUL_BYTE' when 7 then 'ENCODING_INVALID' else 'OK' end as decoded from documents where text is not null and not regexp_matches(text, '[\\x00]')")
def f11_decode_status(spark, d):
    """Texts behind byte-order marks and encoding cookies, or with bytes that no encoding has."""
    heads = [b"", b"# -*- coding: latin-1 -*-\n", b"# coding: utf-8\n# coding=ascii\n", b"\xef\xbb\xbf", b"\xef\xbb\xbf# coding: ascii\n", b"# coding : US-ASCII\n", b"x\x00", b"\xff\n", b"\n# vim: set fileencoding = UTF_8 :\n", b"x\ny\n# coding: latin-1\n"]
    head = F.element_at(F.array(*map(F.lit, heads)), (F.col("doc_id") % 10 + 1).cast("int"))
    rows = table(spark, d, "documents").where("text is not null").where(~F.contains("text", F.lit("\0")))
    return rows.select("doc_id", text.decode_status(F.concat(head, F.col("text").cast("binary"))).alias("decoded"))


@query("select o_orderkey, (case o_orderkey % 6 when 0 then true when 4 then (day(o_orderdate) % 2 = 0) else false end) as valid from orders")
def f4_utc_second(spark, d):
    """Order dates as stamps: whole, with a fraction, on a 30th of February, in a 25th hour, on a leap day or none, without the letter between."""
    t, k = F.col("o_orderdate"), F.col("o_orderkey") % 6
    stamp = lambda pattern: F.date_format(t, pattern)
    leap = F.when(F.dayofmonth(t) % 2 == 0, F.lit("2028-02-29T00:00:00Z")).otherwise(F.lit("2026-02-29T00:00:00Z"))
    made = (
        F.when(k == 0, stamp("yyyy-MM-dd'T'HH:mm:ss'Z'")).when(k == 1, stamp("yyyy-MM-dd'T'HH:mm:ss'.1Z'")).when(k == 2, stamp("yyyy-'02-30T'HH:mm:ss'Z'"))
        .when(k == 3, stamp("yyyy-MM-dd'T25:'mm:ss'Z'")).when(k == 4, leap).otherwise(stamp("yyyy-MM-dd HH:mm:ss'Z'"))
    )
    return table(spark, d, "orders").select("o_orderkey", text.is_utc_second(made).alias("valid"))


@query("select doc_id, doc_id % 5 = 0 or (doc_id % 5 = 1 and not regexp_matches(sha256(doc_id::varchar), '[a-f]')) as ok from documents")
def f6_sha256_shape(spark, d):
    """Digests as they should be, in capitals, short, long, or with a sign that is no hexadecimal digit."""
    h, k = F.sha2(F.col("doc_id").cast("string"), 256), F.col("doc_id") % 5
    made = F.when(k == 0, h).when(k == 1, F.upper(h)).when(k == 2, F.substring(h, 1, 63)).when(k == 3, F.concat(h, F.lit("0"))).otherwise(F.concat(F.substring(h, 1, 63), F.lit("g")))
    return table(spark, d, "documents").select("doc_id", made.rlike("^[0-9a-f]{64}\\z").alias("ok"))


# --- the whole policy

RAW = f"(select doc_id, lang, source, ls, case when doc_id % 16 = 9 then '# coding: latin-1' || chr(10) || text else text end as text from {CODE})"
OUTCOMES = (
    f"(with c as {RAW}, l as (select doc_id, allowed from ({SQL['f8_licence_filter']})), removed as (select distinct doc_id from labels where quality = 0),"
    " p as (select c.*, list_filter([case when lang = 'de' then 'DIALECT_UNSUPPORTED' end, case when not allowed then 'LICENSE_NOT_ALLOWED' end, case when c.doc_id in (select doc_id from removed) then 'REMOVED_BY_AUTHORITY' end,"
    f" case when strlen(text) > {text.MOST_BYTES} + 3 then 'SIZE_OUT_OF_RANGE' when contains(text, chr(0)) then 'NUL_BYTE' when c.doc_id % 16 = 9 then 'ENCODING_UNSUPPORTED' when strlen(text) not between {text.LEAST_BYTES} and {text.MOST_BYTES} then 'SIZE_OUT_OF_RANGE' end], lambda x: x is not null) declared from c join l using (doc_id)),"
    f" q as (select *, case when len(declared) = 0 then case when not {PARSED} then 'PYTHON_SYNTAX_REJECTED' when doc_id in {HEADED} then 'GENERATED_MARKER' when 2 * {COMMENT} > strlen(text) then 'COMMENT_RATIO_EXCEEDED' end end parser from p),"
    f" v as ({privacy.verdict_sql('(select doc_id, text from q where len(declared) = 0 and parser is null)')})"
    " select q.doc_id, list_concat(declared, list_filter([parser, case v.status when 'REJECTED' then 'SENSITIVE_CONTENT_DETECTED' when 'QUARANTINED' then 'SENSITIVE_CONTENT_UNCERTAIN' end], lambda x: x is not null)) r,"
    " case v.status when 'ACCEPTED' then 'POLICY_ACCEPTED' when 'QUARANTINED' then 'QUARANTINED' else 'REJECTED' end status from q left join v on v.doc_id = q.doc_id)"
)


def outcomes(spark, d) -> DataFrame:
    raw = F.when(F.col("doc_id") % 16 == 9, F.concat(F.lit("# coding: latin-1\n"), F.col("code"))).otherwise(F.col("code")).cast("binary")
    removed = table(spark, d, "labels").where("quality = 0").select("doc_id").distinct().withColumn("hit", F.lit(True))
    rows = sources(spark, d).join(removed, "doc_id", "left")
    rows = rows.select("doc_id", raw.alias("raw"), F.when(F.col("lang") == "de", "python2").otherwise("python3").alias("dialect"), licence().alias("licence"), F.coalesce("hit", F.lit(False)).alias("removed"))
    return text.reasons(rows)


@query(f"select doc_id, array_to_string(r, ',') as reasons, status from {OUTCOMES}")
def f15_reason_pipeline(spark, d):
    return outcomes(spark, d).select("doc_id", F.array_join("reasons", ",").alias("reasons"), "status")


@query(f"select doc_id from {OUTCOMES} where status = 'POLICY_ACCEPTED'")
def f16_accepted_only(spark, d):
    return outcomes(spark, d).where("status = 'POLICY_ACCEPTED'").select("doc_id")


@query(f"select count(*)::bigint as documents, count_if(status = 'POLICY_ACCEPTED')::bigint as accepted, count_if(status = 'QUARANTINED')::bigint as quarantined, count_if(status = 'REJECTED')::bigint as rejected from {OUTCOMES}")
def a1_outcome_counts(spark, d):
    is_ = lambda s: F.count_if(F.col("status") == s)
    return outcomes(spark, d).agg(F.count(F.lit(1)).alias("documents"), is_("POLICY_ACCEPTED").alias("accepted"), is_("QUARANTINED").alias("quarantined"), is_("REJECTED").alias("rejected"))


@query(f"select reason, count(*)::bigint as n from (select unnest(r) reason from {OUTCOMES}) group by reason")
def a20_skip_counters(spark, d):
    return outcomes(spark, d).select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("select count(*) <= 100000000 as documents_ok, sum(strlen(text)) <= 1000000000000 as bytes_ok from documents")
def f17_capacity_guards(spark, d):
    """The totals against their limits; a run goes on only where both hold."""
    totals = table(spark, d, "documents").agg((F.count(F.lit(1)) <= 100_000_000).alias("documents_ok"), (F.sum(F.octet_length("text")) <= 1_000_000_000_000).alias("bytes_ok"))
    return totals.where(F.assert_true(F.col("documents_ok") & F.col("bytes_ok"), "the totals exceed the limits of a run").isNull())


SNIPPETS = ("def f{0}():\n    return {0}\n", "    return {0}\n", "assert f({0}) == 2", "x = = {0}")


@query("select doc_id, doc_id % 4 in (0, 2) as parsed, ['module', 'fragment', 'module', 'none'][(doc_id % 4 + 1)::int] as standalone, [7, 2, 7, 0][(doc_id % 4 + 1)::int]::int as n_tokens from documents")
def m15_m30_fragments(spark, d):
    """A module, a fragment that parses within a function, a statement, or neither, by the id."""
    made = [F.replace(F.lit(s), F.lit("{0}"), F.col("doc_id").cast("string")) for s in SNIPPETS]
    code = F.element_at(F.array(*made), (F.col("doc_id") % 4 + 1).cast("int"))
    return table(spark, d, "documents").select("doc_id", python_code.parse_facts(code).alias("f")).select("doc_id", "f.parsed", "f.standalone", "f.n_tokens")


@query()
def m10_tree_digest(spark, d):
    return sources(spark, d).select("doc_id", python_code.parse_facts("code").alias("f")).select("doc_id", "f.tree_sha", "f.n_tokens")


@query(f"select i::int as entry, {sql_list(LICENCES)}[i::int] as licence, {sql_list(LICENCES)}[i::int] in {text.PERMISSIVE} as permitted from range(1, 15) t(i)")
def s3e_licence_config_guard(spark, d):
    """Each entry of an allowlist, and whether the policy lets it stand there; a scan refuses a list with one that may not."""
    rows = spark.range(1, len(LICENCES) + 1).select(F.col("id").cast("int").alias("entry"), F.element_at(F.array(*map(F.lit, LICENCES)), F.col("id").cast("int")).alias("licence"))
    return rows.withColumn("permitted", F.col("licence").isin(*text.PERMISSIVE))
