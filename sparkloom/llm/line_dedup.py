"""Repeated line runs by distributed prefix doubling; later copies go.

Only DataFrame functions: no Python runs on the executors.

Lines get identifiers; prefix doubling ranks the suffixes of the line
sequences by their first 1, 2, 4, ... lines: the rank at one level is the
order of the pair (rank here, rank ``2^k`` lines on) among the distinct pairs,
sorted across the cluster. Suffixes of equal rank at level k are an interval of
the suffix array whose longest common prefix is ``2^k`` lines or more; a
suffix whose rank is its own is dropped, since nothing longer can repeat there.
Two overlapping ranks name a run of any length, and so the interval of its
copies.

A run counts when it has ``min_words`` words. A maximal repeated run of so many
words is the union of its shortest such windows, those that are shortest from
their first line and those that are shortest to their last; every window that
has an earlier copy, by (doc_id, line), is deleted. Where a copy overlaps the
first occurrence within one document, the first occurrence stays whole.

Lines are cut at line feeds and compared exactly; words are runs of other
characters than ASCII white space.

Defined cases: a null text stays null and an empty text empty; rows of one
doc_id with equal texts are one document in several rows and are treated
alike; rows of one doc_id with different texts are ordered by the hash of
the text; a null id comes before all others; a document may lose all its lines
and stays as an empty text; a very long text is an array of its lines, cut whole;
an empty table gives an empty result; extra columns pass through, and where
one has the name of a result column, that gets underscores in front.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.llm.names import fresh, quoted
from sparkloom.scratch import cut, drop, small_side

DOC = ["doc_id", "th"]


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def later_copies(docs: DataFrame, min_words: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, th, a, z``: line ranges [a, z) that copy an earlier run; th is the text's hash."""
    text = F.col(text_col)
    line = lambda x: F.struct(F.xxhash64(x).alias("h"), F.hash(x).alias("g"), F.size(F.array_remove(F.split(x, "[\\x20\\x09-\\x0D]+"), "")).alias("w"))
    narrow = docs.where(text.isNotNull()).select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("th"), F.transform(lines_of(text), line).alias("lines"))
    per_doc = cut(narrow.groupBy(*DOC).agg(F.first("lines").alias("lines")), "lines")
    rows = per_doc.select(*DOC, F.posexplode("lines").alias("i", "line")).select(*DOC, "i", "line.h", "line.g", "line.w")
    names = _ranks(rows.groupBy("h", "g").agg(F.count(F.lit(1)).alias("n")), ["h", "g"])
    marked = rows.join(names, ["h", "g"], "left").select(*DOC, "i", "w", F.col("r"))
    ends = per_doc.select(*DOC, F.size("lines").alias("i"), F.lit(0).alias("w"), F.lit(None).cast("long").alias("r"))
    level = cut(_windows(marked.unionByName(ends), min_words), "level0")
    windows = cut(level.select(*DOC, F.inline(F.array(F.struct(F.col("i").alias("a"), F.col("to").alias("z")), F.struct(F.col("since").alias("a"), F.col("i").alias("z"))))).where("a is not null and z is not null").distinct(), "windows")
    ranks = level.where("r is not null").select(*DOC, "i", "r")
    longest = windows.agg(F.max(F.col("z") - F.col("a"))).first()[0] or 0
    found, k = None, 0
    while (1 << k) <= longest:
        span = F.col("z") - F.col("a")
        own = windows.where((span >= (1 << k)) & (span < (2 << k)))
        head = ranks.select(*DOC, F.col("i").alias("a"), F.col("r").alias("r1"))
        tail = ranks.select(*DOC, (F.col("i") + (1 << k)).alias("z"), F.col("r").alias("r2"))
        copies = _repeats(cut(_met(_met(own, head, "a"), tail, "z").select(*DOC, "a", "z", "r1", "r2"), "named"))
        found = copies if found is None else found.unionByName(copies)
        if (2 << k) <= longest:
            ranks = _double(ranks, 1 << k)
        k += 1
    if found is None:
        return windows.select(*DOC, "a", "z").limit(0)
    return found


def _windows(rows: DataFrame, min_words: int) -> DataFrame:
    """For each line i (and the end): ``to``, the end of the shortest run of enough words from i, and ``since``, the start of the shortest one before i, where all their lines repeat."""
    by = Window.partitionBy(*DOC)
    before = by.orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({"s": F.coalesce(F.sum("w").over(before), F.lit(0)), "odd": F.coalesce(F.sum(F.col("r").isNull().cast("long")).over(before), F.lit(0))})
    at = F.struct("i", "odd")
    words = by.orderBy("s")
    rows = rows.withColumns({"n": F.min(at).over(words.rangeBetween(min_words, Window.unboundedFollowing)), "p": F.max(at).over(words.rangeBetween(Window.unboundedPreceding, -min_words))})
    return rows.select(*DOC, "i", "r", F.when(F.col("n.odd") == F.col("odd"), F.col("n.i")).alias("to"), F.when(F.col("p.odd") == F.col("odd"), F.col("p.i")).alias("since"))


def _ranks(counts: DataFrame, key: list[str]) -> DataFrame:
    """Order-keeping ranks ``r`` of the keys that occur twice or more."""
    return cut(counts.where("n > 1").select(*key).orderBy(*key).withColumn("r", F.monotonically_increasing_id()), "ranks")


def _met(left: DataFrame, right: DataFrame, at: str) -> DataFrame:
    """Inner join by document and ``at``; a null id equals itself."""
    key = [*DOC, at]
    right = right.withColumnsRenamed({c: f"{c}_met" for c in key})
    return left.join(right, [F.col(c).eqNullSafe(F.col(f"{c}_met")) for c in key]).drop(*[f"{c}_met" for c in key])


def _double(ranks: DataFrame, h: int) -> DataFrame:
    """Ranks by twice as many lines, of the suffixes that still share theirs."""
    ahead = F.max("r").over(Window.partitionBy(*DOC).orderBy("i").rangeBetween(h, h))
    pairs = cut(ranks.withColumn("r2", ahead).where("r2 is not null").withColumnRenamed("r", "r1"), "pairs")
    names = _ranks(pairs.groupBy("r1", "r2").agg(F.count(F.lit(1)).alias("n")), ["r1", "r2"])
    level = cut(pairs.join(names, ["r1", "r2"]).select(*DOC, "i", "r"), "level")
    drop(pairs)
    return level


def _repeats(named: DataFrame) -> DataFrame:
    """What to delete of the windows that have an earlier copy."""
    name = ["r1", "r2", "span"]
    named = named.withColumn("span", F.col("z") - F.col("a"))
    at = F.struct("doc_id", "th", "a")
    firsts = cut(named.groupBy(*name).agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "firsts")
    later = named.join(firsts, name).where(~at.eqNullSafe(F.col("first")))
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("th") == F.col("first.th"))
    start = F.when(same, F.greatest("a", F.col("first.a") + F.col("span"))).otherwise(F.col("a"))
    return later.select(*DOC, start.alias("a"), "z").where("a < z")


def dedup_lines(docs: DataFrame, min_words: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with later copies of repeated line runs cut out of the text, and ``n_lines`` and ``n_removed`` (by :func:`fresh`) added."""
    gone_id, gone_th, gone, kept = (fresh(c, docs.columns) for c in ("gone_id", "gone_th", "gone", "left_lines"))
    n_lines, n_removed = (fresh(c, docs.columns) for c in ("n_lines", "n_removed"))
    copies = later_copies(docs, min_words, id_col, text_col)
    runs = copies.groupBy(*DOC).agg(F.sort_array(F.collect_set(F.struct("a", "z"))).alias(gone)).withColumnsRenamed({"doc_id": gone_id, "th": gone_th})
    runs = small_side(cut(runs, "gone"))
    text = F.col(quoted(text_col))
    joined = docs.join(runs, F.col(quoted(id_col)).eqNullSafe(F.col(gone_id)) & (F.xxhash64(text) == F.col(gone_th)) & text.isNotNull(), "left")
    left = F.filter(lines_of(text), lambda x, i: ~F.exists(gone, lambda g: (i >= g["a"]) & (i < g["z"])))
    joined = joined.withColumn(kept, F.when(F.col(gone).isNotNull(), left))
    size = F.when(text.isNull(), 0).otherwise(F.size(lines_of(text)))
    out = [F.when(F.col(kept).isNotNull(), F.array_join(kept, "\n")).otherwise(text).alias(c) if c == text_col else F.col(quoted(c)) for c in docs.columns]
    return joined.select(*out, size.cast("long").alias(n_lines), F.when(F.col(kept).isNotNull(), size - F.size(kept)).otherwise(0).cast("long").alias(n_removed))


ORACLE = r"""
with l as (select doc_id, string_split(text, chr(10)) ls from documents where text is not null),
w as (select doc_id, ls, list_transform(ls, lambda x: len(list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda y: y <> ''))) ws from l),
pos as (select doc_id, ls, ws, unnest(range(len(ls) + 1)) i from w),
s as (select doc_id, ls, i, coalesce(list_sum(ws[:i]), 0) s from pos),
f as (select a.doc_id, a.ls, a.i a, min(b.i) z from s a join s b on a.doc_id = b.doc_id and b.s >= a.s + 50 group by all),
b as (select a.doc_id, a.ls, max(b.i) a, a.i z from s a join s b on a.doc_id = b.doc_id and b.s <= a.s - 50 group by all),
win as (select doc_id, a, z, array_to_string(ls[a + 1:z], chr(10)) t from (select * from f union select * from b)),
firsts as (select t, z - a n, min((doc_id, a)) f from win group by all having count(*) > 1),
gone as (select win.doc_id, case when win.doc_id = f[1] then greatest(a, f[2] + n) else a end a, z from win join firsts on win.t = firsts.t and z - a = n where (win.doc_id, win.a) <> f),
dead as (select distinct doc_id, unnest(range(a, z)) i from gone where a < z),
byd as (select doc_id, list(i) d from dead group by 1)
select doc_id, case when d is null then text else array_to_string(list_filter(string_split(text, chr(10)), lambda x, i: not list_contains(d, i - 1)), chr(10)) end as text,
       case when text is null then 0 else len(string_split(text, chr(10))) end::bigint n_lines, coalesce(len(d), 0)::bigint n_removed
from documents left join byd using (doc_id)
"""
