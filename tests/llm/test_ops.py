"""The ten operators against brute force, on messy and on empty tables."""

import os
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sparkloom.llm import balltree, decontaminate, langid, line_dedup, nbest, pieces, shard_lp, simhash, token_counts, toxicity, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, th long, label string, fp long"
PATH = pieces.model_path()


def docs(spark, texts, ids=None):
    """A table of documents with columns whose names clash with the operators' own."""
    ids = ids if ids is not None else range(len(texts))
    return spark.createDataFrame([(i, t, "en", None, None, 1, "x", 2) for i, t in zip(ids, texts, strict=True)], DOCS)


MESSY = [None, "", " \n\t", "one", "one two", "Same text here.\nAnd more.", "Same text here.\nAnd more.", "long " * 30_000, "é①▁ x y", "x" * 20_000]
EMPTY: list = []


def test_shards_are_even_gapless_and_keep_groups(spark):
    rng = random.Random(1)
    texts = ["hot"] * 400 + [f"copy {rng.randrange(150)}" for _ in range(500)] + [f"own {i}" for i in range(301)] + [None, None, ""]
    rows = shard_lp.assign_shards(docs(spark, texts)).collect()
    by: dict = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
        t = texts[r["doc_id"]]
        assert r["size"] == len((t or "").encode()) + 8
        assert r["text_crc32"] == (None if t is None else zlib.crc32(t.encode()))
    assert len(rows) == len(texts) and len(by) == 24
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    where: dict = {}
    for r in rows:
        where.setdefault(texts[r["doc_id"]], set()).add(r["shard"])
    small = [len(s) for t, s in where.items() if t and t.startswith("copy")]
    assert sum(n > 1 for n in small) <= 0.2 * len(small)
    hot = sorted((sum(texts[r["doc_id"]] == "hot" for r in rows if r["shard"] == s) for s in by), reverse=True)
    assert sum(hot[:10]) >= 0.5 * 400


def test_shards_of_messy_and_empty(spark):
    assert shard_lp.assign_shards(docs(spark, MESSY)).count() == len(MESSY)
    assert shard_lp.assign_shards(docs(spark, EMPTY)).count() == 0


QUESTION = "Last spring Alice walked 12 km to the old market and bought 5 apples for her cousin Bob before the long evening rain started there."


def test_templates_catch_changed_slots(spark):
    item = spark.createDataFrame([(7, QUESTION), (8, None), (9, "")], "item_id long, text string")
    swapped = QUESTION.replace("Alice", "Maria").replace("12", "30").replace("5", "9").replace("Bob", "Tom")
    clash = "Ann met Bob and Bob met 5 men, 5 dogs and 5 cats near old town"
    texts = ["Intro words here. " + QUESTION + " More.", "Intro. " + swapped, "nothing of it at all, 12 km", None, "", swapped, "the old market and bought"]
    got = {(r["doc_id"], r["item_id"], r["changed_slots"] > 0) for r in decontaminate.leaks(docs(spark, texts), item).collect()}
    assert got == {(0, 7, False), (1, 7, True), (5, 7, True)}
    two = spark.createDataFrame([(1, "So then Ann met Bob and Bob met 5 men, 5 dogs and 5 cats near old town")], "item_id long, text string")
    mixed = ["So then " + clash.replace("Bob met", "Tom met"), "So then " + clash.replace("Bob", "Tom"), "So then " + clash.replace("5 dogs", "6 dogs")]
    assert {r["doc_id"] for r in decontaminate.leaks(docs(spark, mixed), two).collect()} == {1}
    assert decontaminate.leaks(docs(spark, EMPTY), item).count() == 0
    assert decontaminate.leaks(docs(spark, MESSY), item.limit(0)).count() == 0
    assert sorted(r["doc_id"] for r in decontaminate.decontaminate(docs(spark, texts), item).collect()) == [2, 3, 4, 6]


def test_sieve_and_shuffle_agree_on_mixed_case(spark, monkeypatch):
    texts = ["the mRNA level at low pH is high", "so my iPhone drew 3 kWh and 5 mL of it leaked over the old desk", "the mRNA level at low pH", "nothing of it"]
    items = spark.createDataFrame([(1, texts[0]), (2, texts[1]), (3, "mRNA pH")], "item_id long, text string")
    found = []
    for sieve in (decontaminate.SIEVE, 0):
        monkeypatch.setattr(decontaminate, "SIEVE", sieve)
        found.append(sorted(tuple(r) for r in decontaminate.leaks(docs(spark, [f"Here {t} now" for t in texts]), items).collect()))
    assert found[0] == found[1] and {(r[0], r[2]) for r in found[0]} == {(0, 1), (1, 2)}


def test_copies_match_whatever_surrounds_them(spark):
    item = "She sold the old boat. He kept the oars."
    items = spark.createDataFrame([(1, "What is the capital of France?"), (2, item)], "item_id long, text string")
    texts = ["Q: What is the capital of France?", "Q: What is the capital of Spain?", 'In "The Times and She Said and He Said" it stood. ' + item, "now " + item.lower(), "The capital of France is what it is."]
    got = {(r["doc_id"], r["item_id"], r["changed_slots"]) for r in decontaminate.leaks(docs(spark, texts), items).collect()}
    assert got == {(0, 1, 0), (1, 1, 1), (2, 2, 0), (3, 2, 0)}


def test_items_dense_in_slots_and_longer_names(spark):
    dense = "Alice paid 5 dollars, Bob 7 dollars, Carl 9 dollars"
    long = "So far as we know Alice went down to the old harbour and then she sailed away"
    items = spark.createDataFrame([(1, dense), (2, long), (3, "5 7 9")], "item_id long, text string")
    texts = ["Here: " + dense, "Then " + dense.replace("Bob", "Tom").replace("9", "11"), "Well. " + long.replace("Alice", "Maria Jane Lee"), dense.replace("Bob", "Tom").replace("dollars", "cars"), "5 7 9"]
    got = {(r["doc_id"], r["item_id"], r["matched_tokens"], r["item_tokens"]) for r in decontaminate.leaks(docs(spark, texts), items).collect()}
    assert got == {(0, 1, 10, 10), (1, 1, 10, 10), (2, 2, 17, 17)}


def plain_templates(text):
    """The five readings of a text, token by token: lists of (what must be equal, words, whether it is a slot, whether it holds a word)."""
    tokens = [t for t in re.findall(r"\d+(?:[.,]\d+)*|\w+|[.!?\n]|[^\w\s'’-]", text or "")]
    words, start, gap, before = [], True, False, None
    for t in tokens:
        if t in ".!?\n":
            start, before = True, None
        elif not re.match(r"\w", t):
            gap = True
        else:
            kind = "N" if t[0].isdigit() else "U" if t.lower() in decontaminate.UNITS else "C" if t[0] != t[0].lower() else "L"
            words.append((t.lower(), kind, start, gap, kind == "U" and before == "N"))
            start, gap, before = False, False, kind
    names = {w for w, kind, start, _, _ in words if kind == "C" and not start}
    for reading in range(5):
        out = []
        for w, kind, start, gap, measure in words:
            name = kind == "C" and (reading in (1, 4) or (reading in (0, 3) and (not start or w in names)))
            if reading != 2 and name:
                if reading in (3, 4) and out and out[-1][0] == "<C>" and not start and not gap:
                    out[-1] = ("<C>", out[-1][1] + [w], True, True)
                else:
                    out.append(("<C>", [w], True, True))
            elif reading != 2 and (kind == "N" or measure):
                out.append((f"<{kind}>", [w], True, False))
            else:
                out.append((w, [w], False, not (kind == "N" or measure)))
        yield reading, out


def brute_leaks(texts, items, window=10, enough=13):
    """Every item against every text at every shift."""
    found = {}
    for d, text in enumerate(texts):
        for item, own in items:
            for (_, a), (_, b) in zip(plain_templates(text), plain_templates(own), strict=True):
                n = min(window, len(b))
                size = sum(len(x[1]) for x in b)
                ends = [0]
                for x in b:
                    ends.append(ends[-1] + len(x[1]))
                for shift in range(-len(b), len(a)) if n else ():
                    covered, values = set(), {}
                    for at in range(len(b) - n + 1):
                        i = at + shift
                        own_run, run = b[at : at + n], a[i : i + n] if i >= 0 else []
                        if len(run) == n and [x[0] for x in run] == [x[0] for x in own_run] and any(not x[2] and x[3] for x in own_run):
                            covered |= set(range(ends[at], ends[at + n]))
                            for x, y in zip(own_run, run, strict=True):
                                if x[2]:
                                    values.setdefault(" ".join(x[1]), set()).add(" ".join(y[1]))
                    if len(covered) >= min(enough, size) and covered and all(len(v) == 1 for v in values.values()):
                        changed = sum(v != {k} for k, v in values.items())
                        found[d, item] = max(found.get((d, item), (0, 0, 0)), (len(covered), -changed, size))
    return {(d, i, m, size, -same) for (d, i), (m, same, size) in found.items()}


@pytest.mark.parametrize("sieve", [decontaminate.SIEVE, 0])
def test_leaks_match_brute_force(spark, monkeypatch, sieve):
    """Random texts of few words, so that windows meet often; messy texts, repeated ids and items of one word among them."""
    monkeypatch.setattr(decontaminate, "SIEVE", sieve)
    rng = random.Random(11)
    bag = "the old man saw Alice Bob Lee 5 7 12 km kg red . , mRNA of and".split()
    write = lambda n: " ".join(rng.choice(bag) for _ in range(n))
    items = [(k, write(rng.choice([1, 3, 12, 16, 22]))) for k in range(14)] + [(3, write(15)), (20, None), (21, ""), (22, "5 7"), (23, "harbour")]
    texts = [write(rng.choice([5, 40, 120])) for _ in range(20)]
    for k in range(14):
        item = items[k][1]
        texts += [write(8) + " " + item + " " + write(8), item.replace("Alice", "Maria Jane").replace("5", "11"), "zzz qqq " + item.lower() + " zzz"]
    texts += [*MESSY, "a Harbour wall"]
    frame = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, h int")
    got = {tuple(r[k] for k in ("doc_id", "item_id", "matched_tokens", "item_tokens", "changed_slots")) for r in decontaminate.leaks(docs(spark, texts), frame).collect()}
    assert got == brute_leaks(texts, [(i, t) for i, t in items if t]) and len(got) > 40


def brute_paths(lattice, s):
    found = []

    def go(i, score, ids):
        if i == len(s):
            found.append(score)
            return
        single = False
        for j in range(i + 1, len(s) + 1):
            piece = lattice.vocabulary.get(s[i:j])
            if piece:
                go(j, score + piece[1], ids + 1)
                single |= j == i + 1
        if not single:
            n = len(s[i].encode())
            go(i + 1, score + n * nbest.BYTE_SCORE, ids + n)

    go(0, 0.0, 0)
    return sorted(found, reverse=True)


@pytest.mark.parametrize("text", ["the cat.", "in on", "a\nb①", "he  he", "Then,no", "", "①é"])
def test_nbest_is_exact(text):
    lattice = nbest.Lattice(PATH, 5)
    ids, ranked, _ = lattice.text(text)
    assert [s for s, _ in ranked] == brute_paths(lattice, pieces.normalize(PATH, text))[:5]
    assert nbest.Decoder(PATH).text(ids) == text


def brute_segmentations(lattice, s):
    """(score, ids) of every segmentation."""
    found = []

    def go(i, score, ids):
        if i == len(s):
            found.append((score, ids))
            return
        for j in range(i + 1, len(s) + 1):
            piece = lattice.vocabulary.get(s[i:j])
            if piece:
                go(j, score + piece[1], (*ids, piece[0]))
        if s[i] not in lattice.vocabulary:
            raw = s[i].encode()
            go(i + 1, score + len(raw) * nbest.BYTE_SCORE, (*ids, *(lattice.byte_ids[b] for b in raw)))

    go(0, 0.0, ())
    return sorted(found, key=lambda f: -f[0])


@pytest.mark.parametrize("text", ["the cat.", "in on", "aaaaaa", "①é he", "Then,no", "the\nthe\nthe", "he he he he"])
def test_nbest_ids_match_brute_force(text):
    """Every segmentation above the N-th score comes out with its ids, the rest of the N are among those that tie there, and the order is by score."""
    n = 6
    lattice = nbest.Lattice(PATH, n)
    ids, ranked, changes = lattice.text(text)
    got = [(score, tuple(nbest.changed(ids, c).tolist())) for (score, _), c in zip(ranked, changes, strict=True)]
    want = brute_segmentations(lattice, pieces.normalize(PATH, text))
    assert [s for s, _ in got] == [s for s, _ in want[:n]] and len(set(got)) == len(got)
    last = got[-1][0]
    assert {g for g in got if g[0] > last} == {w for w in want if w[0] > last} and set(got) <= set(want)
    assert got[0][1] == tuple(ids.tolist())


def test_library_ids_stand_beside(spark):
    texts = ["the cat sat there.", "", None, "①é of it"]
    rows = {r["doc_id"]: r["library_ids"] for r in nbest.encode(docs(spark, texts), library=True).collect()}
    assert rows == {i: None if t is None else pieces.processor(PATH).encode(t) for i, t in enumerate(texts)}


def test_encode_and_decode_round_trip(spark):
    out = nbest.encode(docs(spark, MESSY))
    back = {r["doc_id"]: r["text"] for r in nbest.decode(out).collect()}
    assert back == {i: None if t is None else t.replace("▁", " ") for i, t in enumerate(MESSY)}
    assert nbest.encode(docs(spark, EMPTY)).count() == 0


def test_encode_returns_every_segmentation(spark):
    texts = ["the cat.", "in on", "Then,no", "", "the house and the garden, then on", None, "aaaa bbbb ①é"]
    lattice, decoder = nbest.Lattice(PATH, 4), nbest.Decoder(PATH)
    score = {i: w for i, w in lattice.vocabulary.values()}
    rows = {r["doc_id"]: r for r in nbest.encode(docs(spark, texts)).collect()}
    brief = {r["doc_id"]: r for r in nbest.encode(docs(spark, texts), keep_ids=False).collect()}
    assert rows[5]["changes"] is None and rows[5]["digests"] is None
    for i, t in enumerate(texts):
        if t is not None:
            r = rows[i]
            found = [nbest.changed(np.array(r["ids"], np.int32), [tuple(c) for c in made]).tolist() for made in r["changes"]]
            assert len({tuple(f) for f in found}) == len(found) == len(r["scores"]) and [len(f) for f in found] == r["sizes"]
            assert {decoder.text(f) for f in found} == {t}
            assert [sum(score.get(x, nbest.BYTE_SCORE) for x in f) for f in found] == pytest.approx(r["scores"])
            assert brief[i]["digests"] == r["digests"] == [nbest.digest(np.array(f, np.int32)) for f in found]
    assert len(rows[4]["scores"]) == 4


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    ones = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def brute_components(fps, radius=3):
    left, n = set(fps), 0
    while left:
        todo, n = [left.pop()], n + 1
        while todo:
            f = todo.pop()
            near = {g for g in left if (f ^ g).bit_count() <= radius}
            left -= near
            todo += near
    return n


def test_simhash_components_match_brute_force(spark):
    rng = random.Random(2)
    base = [[f"w{rng.randrange(4000)}" for _ in range(300)] for _ in range(12)]
    texts = []
    for words in base:
        for _ in range(8):
            copy = list(words)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(300)] = f"w{rng.randrange(4000)}"
            texts.append(" ".join(copy))
    texts += ["", None, "  ", "A b", "a B"] + [texts[0]] * 20
    fps = [brute_fingerprint(t) for t in texts]
    label = list(range(len(fps)))
    for _ in range(len(fps)):
        new = [min(label[j] for j in range(len(fps)) if (fps[i] ^ fps[j]).bit_count() <= 3) for i in range(len(fps))]
        if new == label:
            break
        label = new
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs(spark, texts)).collect()}
    assert got == {i: (f"{f:016x}", c) for i, (f, c) in enumerate(zip(fps, label, strict=True))}
    kept = sorted(r["doc_id"] for r in simhash.one_of_each(docs(spark, texts)).collect())
    assert kept == sorted(set(label))
    assert simhash.one_of_each(docs(spark, ["a b c", "a b c", "d e f"], [1, 1, 2])).count() == 2
    assert simhash.near_duplicates(docs(spark, EMPTY)).count() == 0


def test_hot_cells_lose_no_link(spark):
    rng = random.Random(5)
    fps = list({(1 << 40) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(900)})
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    links = simhash.near_links(df, len(fps), 3, cell=100)
    from sparkloom.llm.components import connected_components

    assert {r["label"] for r in connected_components(links).collect()} == {min(f - (1 << 64) if f >> 63 else f for f in fps)}


SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are absent")
def test_learnt_operators_on_held_out_rows(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    found = langid.identify(d).join(d.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in found]) > 0.95 and all(0 <= r["score"] <= 1 for r in found)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = toxicity.score(d, toxicity.fit(d, labels)).join(labels, "doc_id").where(langid.held_out()).collect()
    hits = [(r["toxic_pred"], r["toxic"]) for r in scored]
    assert np.mean([a == b for a, b in hits]) > 0.9, hits


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="driver tables are absent")
def test_toxicity_recall_and_precision(spark):
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    scored = toxicity.score(d.join(labels.select("doc_id"), "doc_id", "left_semi"), toxicity.fit(d, labels)).join(labels, "doc_id").where(langid.held_out()).collect()
    caught = sum(r["toxic_pred"] and r["toxic"] for r in scored)
    assert caught / sum(r["toxic"] for r in scored) >= 0.85 and caught / sum(r["toxic_pred"] for r in scored) >= 0.85


def test_learnt_operators_on_messy_and_empty(spark):
    got = {r["doc_id"]: r for r in langid.identify(docs(spark, [*MESSY, "12 345"])).collect()}
    assert {i for i, r in got.items() if r["lang_pred"] == "und"} == {0, 1, 2, 10}
    assert langid.identify(docs(spark, EMPTY)).count() == 0
    labels = spark.createDataFrame([(1, None), (3, 0)], "doc_id long, toxic int")
    out = toxicity.score(docs(spark, MESSY), toxicity.fit(docs(spark, MESSY), labels)).collect()
    assert len(out) == len(MESSY) and {r["toxic_score"] for r in out} == {0.0}
    assert toxicity.score(docs(spark, EMPTY), toxicity.fit(docs(spark, EMPTY), labels.limit(0))).count() == 0


def test_counts_equal_the_library(spark):
    rng = random.Random(3)
    texts = MESSY + ["".join(rng.choice("ab e\n▁ \t.é①ñ<s>,;'") for _ in range(rng.randrange(40))) for _ in range(500)] + ["<s> </s> <unk> <0x41>"]
    want = [len(x) for x in pieces.processor(PATH).encode([t or "" for t in texts])]
    rows = {r["doc_id"]: r for r in token_counts.count_tokens(docs(spark, texts)).collect()}
    assert [rows[i]["n_tokens"] for i in range(len(texts))] == want
    assert [rows[i]["n_bytes"] for i in range(len(texts))] == [len((t or "").encode()) for t in texts]
    assert token_counts.count_tokens(docs(spark, EMPTY)).count() == 0


def test_warc_round_trip_and_seeking(spark, tmp_path):
    rows = [(1, "http://a/b", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "http://c d", ""), (4, "u", None), (5, "v", "z" * 700_000), (5, "v", "z" * 700_000), (None, "w", "only")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    bundles = warc.archive_pages(pages)
    got = sorted(((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.read(bundles).collect()), key=str)
    want = [(1, 8, "revisit", 2), (2, 8, "response", None), (3, 0, "revisit", 4), (4, 0, "response", None), (5, 700_000, "response", None), (5, 700_000, "response", None), (None, 4, "response", None)]
    assert got == sorted(want, key=str)
    for b in bundles.collect():
        for place in b["index"]:
            fields, _ = warc.fetch(bytes(b["archive"]), place["frame"], place["offset"])
            assert fields["WARC-Record-ID"] == place["record_id"]
    files = warc.export(bundles, f"file://{tmp_path}").collect()
    assert {r["file"]: os.path.getsize(tmp_path / r["file"]) for r in files} == {r["file"]: r["bytes"] for r in files}
    assert warc.read(warc.archive_pages(pages.limit(0))).count() == 0


def test_top_k_matches_brute_force(spark):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(400, 8)).astype(np.float32)
    v[100:200] = v[0]
    rows = [(int(i), [float(x) for x in v[i]]) for i in range(400)] + [(400, None), (420, [1.0, None] + [0.0] * 6), (440, [float("nan")] * 8), (None, [1.0] * 8), (460, [1.0, 2.0])]
    got = {}
    for r in balltree.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    w = np.floor(64 * v.astype(np.float64)).astype(np.int64)
    for q in range(0, 400, 20):
        best = sorted((-int(w[q] @ w[c]), c) for c in range(400) if c != q)[:20]
        assert got[q] == {k + 1: (c, -s) for k, (s, c) in enumerate(best)}
    assert balltree.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_top_k_meets_a_bundle_of_shards_at_once(spark, monkeypatch):
    """A query's hits in a cell of eight shards are its k best of them all; small trees and samples hold the same rows."""
    made, cut = [], balltree.cut
    monkeypatch.setattr(balltree, "cut", lambda df, name="cut": made.append((name, cut(df, name))) or made[-1][1])
    monkeypatch.setattr(balltree, "SHARD_ROWS", 50)
    monkeypatch.setattr(balltree, "SAMPLE_BYTES", 8 * 8 * 40, raising=False)
    w = np.random.default_rng(6).integers(-90, 90, size=(400, 8))
    got = balltree.top_k(spark.createDataFrame([(i, [x / 64 for x in r]) for i, r in enumerate(w.tolist())], "vec_id long, embedding array<double>"))
    want = [(q, k + 1, c, -s) for q in range(0, 400, 20) for k, (s, c) in enumerate(sorted((-int(w[q] @ w[c]), c) for c in range(400) if c != q)[:20])]
    assert sorted(map(tuple, got.collect())) == want
    assert sum(t.count() for name, t in made if name == "hits") == len(want)


@pytest.mark.parametrize("cell_rows", [balltree.CELL_ROWS, 40])
def test_top_k_counts_every_row(spark, monkeypatch, cell_rows):
    """Repeated ids and rows, vectors whose products leave the range of a long, other lengths, and clusters that cells can skip; extra columns clash."""
    monkeypatch.setattr(balltree, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(balltree, "SHARD_ROWS", 4 * cell_rows)
    rng = np.random.default_rng(9)
    v = [[float(x) for x in np.float32(rng.normal(size=6) + 40 * (i % 3 - 1))] for i in range(900)]
    ids = [i % 300 for i in range(900)]
    v += [v[0], [3e38] * 6, [-3e38] * 6, [1e12] * 6, [1e9, -1e9, 1.5, 0.0, 0.0, 0.0], [2.0, 3.0], [4.0, 5.0], []]
    ids += [0, 1000, 1001, 1020, 1040, 1060, 7, 1080]
    frame = spark.createDataFrame([(i, [float(np.float32(y)) for y in x], "a", 1, 2) for i, x in zip(ids, v, strict=True)], "vec_id long, embedding array<float>, row string, cell int, dim int")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in balltree.top_k(frame).collect())
    w = [[int(np.floor(64 * float(np.float32(y)))) for y in x] for x in v]
    most = 2**63 - 1
    want = []
    for q in range(len(w)):
        if ids[q] % 20 == 0:
            best = sorted((-max(-most, min(most, sum(a * b for a, b in zip(w[q], w[c], strict=True)))), ids[c], c) for c in range(len(w)) if c != q and len(w[c]) == len(w[q]))[:20]
            want += [(ids[q], k + 1, i, -s) for k, (s, i, _) in enumerate(best)]
    assert got == sorted(want)


def test_line_runs(spark):
    words = lambda k, n: " ".join(f"w{k}x{i}" for i in range(n))
    a, b, c, d = (words(k, n) for k, n in enumerate((30, 25, 60, 10)))
    texts = [
        f"start\n{a}\n{b}\nmiddle\n{c}", f"other\n{a}\n{b}\nend", f"{a}\nbetween\n{b}", f"{c}\ntail", "\n".join([d] * 20), None, "", f"{c}\n{c}", f"{a}\n{b}", "short line\nshort line",
    ]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs(spark, texts)).collect()}
    assert got == {
        0: texts[0], 1: "other\nend", 2: texts[2], 3: "tail", 4: "\n".join([d] * 5), 5: None, 6: "", 7: "", 8: "", 9: texts[9],
    }
    out = line_dedup.dedup_lines(docs(spark, MESSY))
    assert out.count() == len(MESSY) and out.columns[:3] == ["doc_id", "text", "lang"]
    assert line_dedup.dedup_lines(docs(spark, EMPTY)).count() == 0


def test_line_runs_of_null_ids(spark):
    run = " ".join(f"w{i}" for i in range(60))
    texts = [f"a\n{run}\nb", f"c\n{run}\nd", f"e\n{run}\nf", "own line"]
    got = {r["text"] for r in line_dedup.dedup_lines(docs(spark, texts, [3, None, 1, None])).collect()}
    assert got == {"a\nb", texts[1], "e\nf", "own line"}
    both = [r["text"] for r in line_dedup.dedup_lines(docs(spark, texts[:2], [None, None])).collect()]
    assert len(both) == 2 and sum(run in t for t in both) == 1


def test_one_of_each_by_row(spark):
    own = [" ".join(f"t{k}w{i}" for i in range(40)) for k in range(6)]
    rows = [(1, own[0]), (None, own[0]), (None, own[1]), (None, own[2]), (5, own[3]), (6, own[3]), (6, own[4]), (6, own[5]), (7, own[5]), (6, own[4])]
    left = simhash.one_of_each(docs(spark, [t for _, t in rows], [i for i, _ in rows])).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in left) == sorted([(1, own[0]), (0, own[1]), (0, own[2]), (5, own[3]), (6, own[4]), (6, own[5])])
    blank = simhash.one_of_each(docs(spark, [None, "", None, " "], [3, 2, 2, None])).collect()
    assert len(blank) == 1 and blank[0]["doc_id"] == 2


HELPERS = "gone gone_id gone_th left_lines n_lines n_removed at_id at_th bad_id bad_th toxic_score toxic_pred th fp doc_at h label id dice hit Toxic_Pred2 text_".split()


@pytest.fixture(scope="module")
def stage_tables(tmp_path_factory):
    """Labels and a benchmark beside which the stages of the pipeline run."""
    import pandas as pd

    where = tmp_path_factory.mktemp("stages")
    pd.DataFrame({"doc_id": [101, 103], "quality": [0, 1], "toxic": [1, 0]}).to_parquet(where / "labels.parquet")
    pd.DataFrame({"item_id": [1], "text": [QUESTION]}).to_parquet(where / "benchmark.parquet")
    return str(where)


@pytest.mark.parametrize("stage", range(4))
def test_stages_keep_columns_whatever_their_names(spark, stage_tables, stage):
    import corpus_pipeline

    name, run = corpus_pipeline.STAGES[stage]
    own = " ".join(f"v{i}" for i in range(60))
    texts = [*MESSY, "Intro. " + QUESTION, own, own, f"first\n{own}", f"second\n{own}", None, "quiet words of its own here", "other words that stand alone"]
    ids = [*range(len(texts) - 4), 3, None, None, 50]
    frame = docs(spark, texts, ids).drop("th", "label", "fp").withColumns({c: F.concat(F.lit(f"{c}:"), F.monotonically_increasing_id().cast("string")) for c in HELPERS}).withColumn("a.b", F.lit(1))
    before = [r.asDict() for r in frame.collect()]
    plain = run(spark, frame.drop(*HELPERS, "a.b"), stage_tables)
    out = run(spark, frame, stage_tables)
    assert out.columns == frame.columns and out.dtypes == frame.dtypes
    rows = [r.asDict() for r in out.collect()]
    assert {r["gone"] for r in rows} <= {r["gone"] for r in before} and len({r["gone"] for r in rows}) == len(rows)
    mine = {r["gone"]: r for r in before}
    changed = {"text", "n_chars"}
    assert all({k: v for k, v in r.items() if k not in changed} == {k: v for k, v in mine[r["gone"]].items() if k not in changed} for r in rows)
    key = lambda r: (str(r["doc_id"]), str(r["text"]))
    assert sorted(map(key, rows)) == sorted(map(key, plain.collect()))
    if name == "line dedup":
        assert sum(own in (r["text"] or "") for r in rows) == 1 and len(rows) == len(before)
    if name == "simhash near-dedup":
        assert len(rows) == brute_components([brute_fingerprint(t) for t in texts]) and {r["text"] for r in rows} >= set(texts[-2:])
    if name == "benchmark decontamination":
        assert {r["text"] for r in before} - {r["text"] for r in rows} == {"Intro. " + QUESTION}
    assert run(spark, frame.limit(0), stage_tables).count() == 0


def test_encoding_stage_on_messy_and_empty(spark, stage_tables):
    import corpus_pipeline

    run = corpus_pipeline.STAGES[4][1]
    rows = run(spark, docs(spark, [*MESSY, "one"], [*range(len(MESSY)), None]), stage_tables).collect()
    assert len(rows) == len(MESSY) + 1 and sum(r["ids"] is None for r in rows) == 1 and all(r["round_trip"] for r in rows if r["ids"] is not None)
    assert run(spark, docs(spark, EMPTY), stage_tables).count() == 0


def test_samples_are_bounded_by_rows_not_ids(spark):
    """One id over many texts doesn't bring all of them to the driver."""
    rows = [(1, f"text number {i}", "en") for i in range(3000)] + [(k, f"own text {k}", "de") for k in range(100, 160)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 1), (100, 0)], "doc_id long, toxic int")
    p, u, prior = toxicity.samples(frame, labels, 100, 200, "doc_id", "text", "toxic")
    assert 50 < len(p) < 170 and 120 < len(u) < 300 and prior in (0.5, 1.0)
    texts, langs = langid.sample(frame, 100, "doc_id", "text", "lang")
    assert 50 < langs.count("en") < 170 and langs.count("de") > 30
    assert set(langid.sample(frame, 100, "doc_id", "text", "lang", classes=1)[1]) == {"en"}
    again = frame.unionByName(frame).unionByName(frame)
    assert len(toxicity.samples(again, labels, 10**6, 10**6, "doc_id", "text", "toxic")[0]) == 3000


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are absent")
def test_pipeline_follows_its_stages(spark):
    import corpus_pipeline

    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = d.select("doc_id").collect()
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    ids = [r[0] for r in out.select("doc_id").collect()]
    assert len(set(ids)) == len(ids) and set(ids) <= {r[0] for r in rows} and len(ids) > 0.6 * len(rows)
    assert out.where(~F.col("round_trip")).count() == 0
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, d, "/root/testdata/sf0.001").columns == d.columns
