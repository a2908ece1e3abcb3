"""Benchmark decontamination by template canonicalisation.

Texts become sequences of tokens in which numbers, names and units are typed
placeholders and all else is lower-cased. Windows of ``window`` template tokens
(of a shorter item: the whole item) are hashed and joined between documents and
benchmark; windows of one document and item that agree on the offset make an
alignment, which counts as a leak if it covers ``enough`` tokens or the whole
item, and if its slots are consistent: one value of the item always stands
against one value of the document. A question with other numbers and names is
so caught, and a chance meeting of templates is not.

Whether a capitalised word is a name depends on what surrounds it, so windows are
hashed in five readings, each of which is matched with itself alone: ``NAMES``, by the rule
below; ``CAPITALS``, where every capitalised word is a name; and ``PLAIN``, without placeholders. These last
two read a passage the same way wherever it stands, so copies match whatever
surrounds them. ``NAME_RUNS`` and ``CAPITAL_RUNS`` read as the first two, but names with
nothing but space between them are one placeholder, so a name can stand for one of more words.
An alignment is of one reading; a leak in any of them is one.

A number is digits with inner points or commas; a unit is a word of ``UNITS``
right after a number; a name is a capitalised word that doesn't begin a
sentence, or does and stands capitalised within another sentence of the text.

Documents are scanned once. While the benchmark's window hashes number at most
``SIEVE`` and its tokens take at most ``SIEVE_BYTES``, both travel to the scan, so only windows that can match
leave it; a larger benchmark joins all windows by shuffle. The results are the same.

Defined cases: null, empty and blank texts match nothing; items without a
literal token, or null ones, are left out; an item shorter than a window is one
window, so an item of one word is found in every text that has the word, and
short items of few literals match whatever fills their slots; very long texts
are windowed whole; rows that repeat an id and text are one; rows of one id with
different texts are judged apart; among alignments of one item in one text
that of the most tokens counts, and of those the one with the fewest changed slots;
rows that repeat an item's id and text are one item, and of one id with different
texts each can be found; an empty table or benchmark gives an empty result; extra
columns, whatever their names, are ignored by ``leaks`` and kept by ``decontaminate``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.names import fresh
from sparkloom.scratch import cut, drop, small_side

UNITS = frozenset("mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ounce ounces pound pounds ton tons ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year years cent cents dollar dollars euro euros percent degree degrees".split())
TOKENS = re.compile(r"\d+(?:[.,]\d+)*|\w+|[.!?\n]|[^\w\s'’-]")
WORD = re.compile(r"\w")
LITERAL, CAPITAL, NUMBER, UNIT, MARK, BREAK = range(6)
SLOT_HASHES = np.array([0, 0x9E3779B97F4A7C1, 0x7F4A7C15F39CC06, 0x2545F4914F6CDD1])  # of a capital, number and unit
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Most window hashes, and bytes of distinct tokens (with 60 for each as an object), that travel to the scan.
SIEVE, SIEVE_BYTES = 1 << 21, 64 << 20
MEMO = 300_000
OTHER = 1 << 3 | LITERAL
NAMES, CAPITALS, PLAIN, NAME_RUNS, CAPITAL_RUNS = range(5)


class Codes(dict):
    """Token to (hash of its lower-cased form, kind) as one integer.

    With ``known``, tokens that start lower-case and whose lower-cased form is
    outside it share one code: no window of the benchmark holds them, so which of them it is makes no difference.
    """

    def __init__(self, known: frozenset[str] | None = None):
        super().__init__()
        self.known = None if known is None else known | UNITS

    def __missing__(self, token: str) -> int:
        if len(self) >= MEMO:
            self.clear()
        low = token.lower()
        if self.known is not None and low not in self.known and token[0].islower():
            self[token] = OTHER
            return OTHER
        kind = MARK if token in ".!?\n" else BREAK if not WORD.match(token) else NUMBER if token[0].isdigit() else UNIT if low in UNITS else CAPITAL if token[0] != low[0] else LITERAL
        code = self[token] = xxhash.xxh3_64_intdigest(low.encode("utf-8", "surrogatepass")) >> 4 << 3 | kind
        return code


@dataclass
class Template:
    tokens: list[str]
    codes: np.ndarray
    slots: np.ndarray  # kind of each template token as a placeholder, LITERAL if it is none
    places: np.ndarray = field(repr=False, default=None)  # of all words among the tokens
    first: np.ndarray = field(repr=False, default=None)  # the first word of each template token, and the number of words
    reading: int = NAMES
    words: np.ndarray = field(repr=False, default=None)  # whether a token is neither a number nor its unit
    origin: np.ndarray = field(repr=False, default=None)  # the place of each template token in the template of the whole text

    def windows(self, n: int) -> np.ndarray:
        """Hash of the n template tokens from each position."""
        return windows([self], n)[2]

    def values(self, at: int, n: int) -> list[tuple[int, str]]:
        """(position from ``at``, lower-cased value) of the slots among n template tokens."""
        return [(int(i), " ".join(self.tokens[p].lower() for p in self.places[self.first[at + i] : self.first[at + i + 1]])) for i in np.flatnonzero(self.slots[at : at + n])]


def windows(made: list[Template], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(which template, position, hash) of the n template tokens from each position of each template."""
    sizes = np.array([len(t.codes) for t in made])
    count = int(sizes.sum()) - n + 1
    if count < 1:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    codes = np.concatenate([t.codes for t in made])
    which = np.repeat(np.arange(len(made)), sizes)
    at = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = np.repeat(np.array([t.reading << 32 | n for t in made], np.uint64), sizes)[:count]
    for j in range(n):
        out = (out * BASE) ^ codes[j : j + count]
        out ^= out >> np.uint64(29)
    whole = which[:count] == which[n - 1 :]
    return which[:count][whole], at[:count][whole], out[whole]


def templates(text: str | None, codes: Codes, least: int = 0) -> list[Template]:
    """The template of a whole text in each reading; none if the text is empty.

    With ``least``, only runs of so many words without one that no benchmark window holds are kept (each with the
    word that ends it), since only there a window can match; ``origin`` keeps their places in the whole text.
    """
    tokens = TOKENS.findall(text or "")
    packed = np.fromiter(map(codes.__getitem__, tokens), np.int64, len(tokens))
    said = np.flatnonzero(packed & 7 != BREAK)
    parted = np.diff(said, prepend=-1) > 1  # a break stands before the token
    packed = packed[said]
    if least and np.diff(np.flatnonzero(packed == OTHER), prepend=-1, append=len(packed)).max() <= least:
        return []
    kind = packed & 7
    at = np.flatnonzero(kind != MARK)
    if not len(at):
        return []
    starts = np.concatenate([[True], kind[:-1] == MARK])[at]
    packed, kind, places = packed[at], kind[at], said[at]
    kept = slice(None)
    if least:
        runs = np.diff(np.flatnonzero(packed == OTHER), prepend=-1, append=len(packed))
        kept = np.repeat(runs > least, runs)[: len(packed)]
        if not kept.any():
            return []
    capital = kind == CAPITAL
    inner = capital & ~starts
    if inner.any():
        inner |= capital & np.isin(packed, packed[inner])
    joined = ~(starts | parted[at])  # to the word before, by nothing but space
    after_number = np.concatenate([[False], kind[:-1] == NUMBER])[kept]
    every = np.arange(len(kind))[kept]
    word, kind, places = packed[kept] >> 3, kind[kept], places[kept]
    measures = np.where(kind == NUMBER, NUMBER, np.where((kind == UNIT) & after_number, UNIT, LITERAL))
    made = []
    for reading, name in ((NAMES, inner), (CAPITALS, capital), (PLAIN, None), (NAME_RUNS, inner), (CAPITAL_RUNS, capital)):
        slots = np.zeros(len(kind), np.int64) if name is None else np.where(name[kept], CAPITAL, measures)
        out = word if name is None else np.where(slots == LITERAL, word, SLOT_HASHES[slots])
        if reading in (NAME_RUNS, CAPITAL_RUNS):
            head = np.concatenate([[True], ~(name[1:] & name[:-1] & joined[1:])])
            first, origin = np.flatnonzero(head[kept]), (np.cumsum(head) - 1)[kept][head[kept]]
            made.append(Template(tokens, out[first].astype(np.uint64), slots[first], places, np.append(first, len(kind)), reading, (measures == LITERAL)[first], origin))
        else:
            made.append(Template(tokens, out.astype(np.uint64), slots, places, np.arange(len(kind) + 1), reading, measures == LITERAL, every))
    return made


def benchmark_windows(benchmark: DataFrame, window: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``h, n, reading, item_id, item_h, item_at, item_from, item_to, item_tokens, item_slots`` of every template window of the benchmark that has a literal token in it (of the plain reading: a word)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes()
        for b in batches:
            rows = []
            for item, own, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for t in templates(text, codes):
                    n = min(window, len(t.codes))
                    for at, h in enumerate(t.windows(n).view(np.int64).tolist()):
                        if ((t.slots[at : at + n] == LITERAL) & t.words[at : at + n]).any():
                            rows.append((h, n, t.reading, item, own, at, int(t.first[at]), int(t.first[at + n]), len(t.places), [{"p": p, "v": v} for p, v in t.values(at, n)]))
            if rows:
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), *[pa.int32()] * 4, _SLOTS]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["h", "n", "reading", "item_id", "item_h", "item_at", "item_from", "item_to", "item_tokens", "item_slots"])

    rows = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.xxhash64(text_col).alias("item_h"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "h long, n int, reading int, item_id long, item_h long, item_at int, item_from int, item_to int, item_tokens int, item_slots array<struct<p: int, v: string>>")


_SLOTS = pa.list_(pa.struct([("p", pa.int32()), ("v", pa.string())]))


def benchmark_tokens(benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """``t``: the distinct lower-cased tokens of the benchmark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(sorted({t.lower() for x in b.column(0).to_pylist() for t in TOKENS.findall(x or "")}), pa.string())], names=["t"])

    return benchmark.select(text_col).mapInArrow(run, "t string").distinct()


def sieve_of(items: DataFrame, benchmark: DataFrame) -> tuple[np.ndarray, frozenset[str]] | None:
    """Sorted window hashes and tokens of a benchmark, if both are counted to be within ``SIEVE`` and ``SIEVE_BYTES``; none beyond."""
    hashes = cut(items.select("h").distinct(), "hashes")
    tokens = cut(benchmark_tokens(benchmark), "tokens")
    size = tokens.agg(F.sum(F.octet_length("t") + 60)).first()[0] or 0
    found = None
    if hashes.count() <= SIEVE and size <= SIEVE_BYTES:
        found = np.sort(hashes.toArrow()["h"].to_numpy().view(np.uint64)), frozenset(tokens.toArrow()["t"].to_pylist())
    drop(hashes)
    drop(tokens)
    return found


def document_windows(docs: DataFrame, lengths: list[tuple[int, int]], sieve: tuple[np.ndarray, frozenset[str]] | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, th, h, doc_at, doc_slots`` of the template windows of every document, of the readings and sizes in ``lengths``; with a sieve (the benchmark's window hashes and tokens), only of those whose hash is in it."""
    shared = docs.sparkSession.sparkContext.broadcast(sieve)
    by_size = [(n, [r for r, m in lengths if m == n]) for n in sorted({m for _, m in lengths})]
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, known = shared.value or (None, None)
        codes, least = Codes(known), min((n for _, n in lengths), default=0) if known is not None else 0
        if hashes is not None:  # sorted
            bits = np.zeros(1 << 24, bool)
            bits[(hashes & np.uint64((1 << 24) - 1)).astype(np.int64)] = True
        for b in batches:
            for i in range(len(b)):
                made, rows = templates(b.column(2)[i].as_py(), codes, least), []
                for n, readings in by_size if made else ():
                    chosen = [made[r] for r in readings]
                    which, at, found = windows(chosen, n)
                    if hashes is not None:
                        k = np.flatnonzero(bits[(found & np.uint64((1 << 24) - 1)).astype(np.int64)])
                        k = k[hashes[np.searchsorted(hashes, found[k]) % len(hashes)] == found[k]]
                        which, at, found = which[k], at[k], found[k]
                    rows += [(h, int(chosen[w].origin[p]), [{"p": q, "v": v} for q, v in chosen[w].values(p, n)]) for w, p, h in zip(which.tolist(), at.tolist(), found.view(np.int64).tolist(), strict=True)]
                for part in range(0, len(rows), 4096):
                    h, at, slots = zip(*rows[part : part + 4096], strict=True)
                    ids = pa.array([b.column(0)[i].as_py()] * len(h), b.column(0).type)
                    keys = pa.array([b.column(1)[i].as_py()] * len(h), pa.int64())
                    yield pa.RecordBatch.from_arrays([ids, keys, pa.array(h, pa.int64()), pa.array(at, pa.int32()), pa.array(slots, _SLOTS)], names=["doc_id", "th", "h", "doc_at", "doc_slots"])

    rows = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, th long, h long, doc_at int, doc_slots array<struct<p: int, v: string>>")


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = 10, enough: int = 13, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """``doc_id, th, item_id, matched_tokens, item_tokens, changed_slots``: the best alignment of each leaked item in each document."""
    items = cut(benchmark_windows(benchmark, window, item_col, "text"), "items")
    lengths = sorted((r[0], r[1]) for r in items.select("reading", "n").distinct().collect())
    sieve = sieve_of(items, benchmark)
    found = cut(document_windows(docs, lengths, sieve, id_col, text_col).distinct(), "windows")
    pairs = found.join(items, "h").withColumn("shift", F.col("doc_at") - F.col("item_at"))
    key = ["doc_id", "th", "item_id", "item_h", "item_tokens", "reading", "shift"]
    tokens = pairs.groupBy(*key).agg(F.sort_array(F.collect_set(F.struct("item_from", "item_to"))).alias("ats"))
    covered = F.aggregate("ats", F.struct(F.lit(0).alias("sum"), F.lit(0).alias("end")), lambda s, at: F.struct((s["sum"] + at["item_to"] - F.greatest(at["item_from"], s["end"])).alias("sum"), at["item_to"].alias("end")), lambda s: s["sum"])
    tokens = tokens.select(*key, covered.alias("matched_tokens"))
    zipped = F.explode(F.arrays_zip("item_slots", "doc_slots"))
    values = pairs.where(F.size("item_slots") > 0).select(*key, zipped.alias("s")).select(*key, F.col("s.item_slots.v").alias("a"), F.col("s.doc_slots.v").alias("b"))
    slots = values.groupBy(*key, "a").agg(F.min("b").alias("least"), F.max("b").alias("most")).groupBy(*key).agg(F.max((F.col("least") != F.col("most")).cast("int")).alias("broken"), F.sum((F.col("a") != F.col("least")).cast("long")).alias("changed_slots"))
    safe = lambda a, b: [a[k].eqNullSafe(b[k]) for k in key]
    joined = tokens.join(slots, safe(tokens, slots), "left").select(*[tokens[k] for k in key], "matched_tokens", F.coalesce("broken", F.lit(0)).alias("broken"), F.coalesce("changed_slots", F.lit(0)).cast("long").alias("changed_slots"))
    kept = joined.where((F.col("broken") == 0) & (F.col("matched_tokens") >= F.least(F.lit(enough), F.col("item_tokens"))))
    best = kept.groupBy("doc_id", "th", "item_id").agg(F.max(F.struct("matched_tokens", (-F.col("changed_slots")).alias("same"), "item_tokens")).alias("best"))
    return best.select("doc_id", "th", "item_id", F.col("best.matched_tokens").cast("long").alias("matched_tokens"), F.col("best.item_tokens").cast("long").alias("item_tokens"), (-F.col("best.same")).alias("changed_slots"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    bad_id, bad_th = fresh("bad_id", docs.columns), fresh("bad_th", docs.columns)
    bad = small_side(cut(leaks(docs, benchmark, **options).select(F.col("doc_id").alias(bad_id), F.col("th").alias(bad_th)).distinct(), "leaks"))
    return docs.join(bad, F.col(id_col).eqNullSafe(F.col(bad_id)) & (F.xxhash64(text_col) == F.col(bad_th)), "left_anti")
