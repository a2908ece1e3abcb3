"""Text policy, lexing and shingles as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import python_code, sensitive

# The permissive licence identifiers, in the order of their names.
PERMISSIVE = ("0BSD", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "ISC", "MIT", "MIT-0", "Python-2.0", "Zlib")
# The marks of generated files, and the bytes of a file's head that are searched for them.
GENERATED = ("@generated", "auto-generated", "autogenerated", "automatically generated", "code generated", "generated by", "generated file", "this file is generated", "do not edit")
HEAD_BYTES = 8192
LEAST_BYTES, MOST_BYTES = 100, 1_000_000
LEXER = r"[\p{L}\p{N}_]+|[^\s\p{L}\p{N}_]"


def newline_normalize(t: Column) -> Column:
    return F.regexp_replace(t, "\r\n?", "\n")


def lexical_tokens(t: Column) -> Column:
    return F.regexp_extract_all(t, F.lit(LEXER), F.lit(0))


def shingles(tokens: Column, n: int = 5) -> Column:
    """Distinct runs of n tokens; a shorter sequence is one shingle."""
    runs = F.transform(F.sequence(F.lit(1), F.size(tokens) - n + 1), lambda i: F.array_join(F.slice(tokens, i, n), " "))
    return F.when(F.size(tokens) < n, F.array(F.concat(F.lit("short "), F.array_join(tokens, " ")))).otherwise(F.array_distinct(runs))


def licence_allowed(expr: Column) -> Column:
    """Flat SPDX expressions: some OR branch whose AND parts are all permissive."""
    ok = lambda part: part.isin(*PERMISSIVE)
    return F.exists(F.split(expr, " OR "), lambda b: F.forall(F.split(b, " AND "), ok)) & (expr != "")


def is_portable_path(p: Column) -> Column:
    return (p != "") & ~p.rlike("[:\\\\\\x00]") & F.forall(F.split(p, "/"), lambda s: ~s.isin("", ".", ".."))


def is_utc_second(t: Column) -> Column:
    return t.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z$") & F.try_to_timestamp(t, F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")).isNotNull() & (t >= "1970")


def is_https_identity(u: Column) -> Column:
    return u.rlike("^https://[^/@?#\\\\\\s]+(/[^?#@\\\\\\s]*)?$")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _cookie(line: Column) -> Column:
    """The encoding that a line's comment names, without hyphens and underscores; null where none."""
    tail = lambda x: F.when(F.instr(x, "#") > 0, F.substr(x, F.instr(x, "#") + 1))
    after = lambda x: F.when(F.instr(x, "coding") > 0, F.substr(x, F.instr(x, "coding") + 6))
    found = lambda x: F.regexp_replace(F.lower(F.regexp_extract(x, "^[ \t]*[:=][ \t]*([A-Za-z0-9._-]+)", 1)), "[-_]", "")
    known = lambda x: F.when(x != "", F.when(x == "utf8sig", "utf8").when(x == "usascii", "ascii").otherwise(x))
    return let(line, lambda x: let(tail(x), lambda y: let(after(y), lambda z: let(found(z), known))))


def canonical(raw: Column) -> Column:
    """Bytes without a byte-order mark."""
    return F.when(raw.startswith(F.lit(b"\xef\xbb\xbf")), F.substring(raw, 4, 2147483647)).otherwise(raw)


def decode_status(raw: Column) -> Column:
    """How bytes decode: OK, BOM_REMOVED, or the first reason why they don't."""
    first = lambda t: F.substring_index(t, "\n", 1)
    second = lambda t: F.when(F.contains(t, F.lit("\n")), F.substring_index(F.substring_index(t, "\n", 2), "\n", -1))
    named = lambda t: F.array_distinct(F.array_compact(F.array(_cookie(first(t)), _cookie(second(t)))))

    def judged(b: Column, t: Column, names: Column) -> Column:
        bom = b.startswith(F.lit(b"\xef\xbb\xbf"))
        return (
            F.when(F.contains(b, F.lit(b"\x00")), "NUL_BYTE").when(~F.is_valid_utf8(t), "ENCODING_INVALID")
            .when(F.exists(names, lambda c: ~c.isin("utf8", "ascii")), "ENCODING_UNSUPPORTED")
            .when((F.size(names) > 1) | (bom & F.array_contains(names, "ascii")), "ENCODING_CONFLICT")
            .when(F.array_contains(names, "ascii") & t.rlike("[^\\x00-\\x7f]"), "ENCODING_INVALID")
            .when(bom, "BOM_REMOVED").otherwise("OK")
        )

    return F.when(raw.isNotNull(), let(raw, lambda b: let(canonical(b).cast("string"), lambda t: let(named(t), lambda names: judged(b, t, names)))))


def ranges_valid(ranges: Column, size: Column) -> Column:
    """Byte ranges that are not empty, in order, apart and within ``size``."""
    steps = F.aggregate(ranges, F.struct(F.lit(0).cast("long").alias("end"), F.lit(True).alias("ok")), lambda s, r: F.struct(r["end"].alias("end"), (s["ok"] & (r["start"] < r["end"]) & (r["start"] >= s["end"])).alias("ok")))
    return steps["ok"] & (steps["end"] <= size)


def comment_bytes(ranges: Column) -> Column:
    return F.aggregate(ranges, F.lit(0).cast("long"), lambda s, r: s + r["end"] - r["start"])


def generated_marker(raw: Column, ranges: Column) -> Column:
    """Whether a comment has a mark of a generated file within the head."""
    stop = lambda r: F.least(r["end"], F.lit(HEAD_BYTES))
    said = lambda r: F.lower(F.decode(F.substr(raw, (r["start"] + 1).cast("int"), (stop(r) - r["start"]).cast("int")), "ISO-8859-1"))
    return F.exists(F.filter(ranges, lambda r: r["start"] < HEAD_BYTES), lambda r: said(r).rlike("|".join(GENERATED)))


def parser_reason(raw: Column, parsed: Column, ranges: Column) -> Column:
    """Why the parser's policy refuses a source; null where it doesn't."""
    return F.when(~parsed, "PYTHON_SYNTAX_REJECTED").when(generated_marker(raw, ranges), "GENERATED_MARKER").when(2 * comment_bytes(ranges) > F.octet_length(raw), "COMMENT_RATIO_EXCEEDED")


def reasons(docs: DataFrame) -> DataFrame:
    """``docs`` (of ``raw, dialect, licence, removed``) with ``reasons`` in their order and ``status``.

    What the declared facts and the bytes refuse is all listed; only a source
    without such reasons is parsed, and only one that the parser's policy
    accepts is searched for sensitive content.
    """
    decoded = decode_status(F.col("raw"))
    bytes_ = F.octet_length(F.col("canonical"))
    declared = F.array_compact(F.array(
        F.when(F.col("dialect") != "python3", "DIALECT_UNSUPPORTED"), F.when(~python_code.licence_udf(PERMISSIVE)("licence"), "LICENSE_NOT_ALLOWED"),
        F.when(F.col("removed"), "REMOVED_BY_AUTHORITY"),
        F.when(F.octet_length("raw") > MOST_BYTES + 3, "SIZE_OUT_OF_RANGE").when(~F.col("decoded").isin("OK", "BOM_REMOVED"), F.col("decoded")).when(~bytes_.between(LEAST_BYTES, MOST_BYTES), "SIZE_OUT_OF_RANGE"),
    ))
    found = docs.withColumns({"decoded": decoded, "canonical": canonical(F.col("raw"))}).withColumn("declared", declared)
    source = F.when(F.size("declared") == 0, F.col("canonical").cast("string"))
    found = found.withColumn("facts", python_code.parse_facts(source))
    parser = F.when(F.size("declared") == 0, parser_reason(F.col("canonical"), F.col("facts.parsed"), F.col("facts.comments")))
    found = found.withColumn("parser", parser).withColumn("searched", F.when((F.size("declared") == 0) & F.col("parser").isNull(), F.col("canonical").cast("string")))
    found = sensitive.verdict(found.withColumnRenamed("status", "status_given") if "status" in docs.columns else found, "searched")
    content = F.when(F.col("searched").isNotNull(), F.when(F.col("status") == "REJECTED", "SENSITIVE_CONTENT_DETECTED").when(F.col("status") == "QUARANTINED", "SENSITIVE_CONTENT_UNCERTAIN"))
    outcome = F.when(F.col("searched").isNotNull() & (F.col("status") == "ACCEPTED"), "POLICY_ACCEPTED").when(F.col("searched").isNotNull() & (F.col("status") == "QUARANTINED"), "QUARANTINED").otherwise("REJECTED")
    found = found.withColumn("reasons", F.concat("declared", F.array_compact(F.array("parser", content))))
    return found.withColumn("status", outcome).drop("decoded", "canonical", "declared", "facts", "parser", "searched", "rules")
