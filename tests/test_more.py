"""Operators without SQL against fixtures, round trips and plain versions; sources and sinks on small files."""

import gzip
import hashlib
import http.server
import random
import struct
import threading
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sparkloom.functions import python_code, strict_json
from sparkloom.operators import bpe, order, text
from sparkloom.sources import files, sinks


def test_chacha_key_stream_of_twenty_rounds():
    words = order.chacha_words(bytes(32), 20)
    first = struct.pack("<4I", *(next(words) for _ in range(4)))
    assert first.hex() == "76b8e0ada0f13d90405d6ae55386bd28"  # the published first block of the zero key


def test_span_order(spark):
    for ids, full, part in ((10_242, 5, 1), (2_049, 1, 0), (2, 0, 1)):
        spans = order.span_order(spark, ids, bytes(32))
        rows = [tuple(r) for r in spans.orderBy("ord").collect()]
        assert sorted(r[1] for r in rows if r[2] == 2048) == [2048 * i for i in range(full)]
        assert [r for r in rows if r[2] < 2048] == ([(full, 2048 * full, part)] if part else [])
        assert all(order.span_order_valid(spans, ids - 1).first())
    wrong = order.span_order(spark, 10_242, bytes(32)).where("ord <> 2")
    assert not all(order.span_order_valid(wrong, 10_241).first())
    with pytest.raises(ValueError):
        order.span_order(spark, 1, bytes(32))


def test_shuffle_is_a_permutation_of_the_seed():
    a = order.shuffled(1000, bytes(range(32)))
    assert sorted(a) == list(range(1000)) and a == order.shuffled(1000, bytes(range(32))) != order.shuffled(1000, bytes(32))


def test_greedy_admission(spark):
    draw = random.Random(3)
    rows = [(i, draw.choice("abbb"), draw.randrange(1, 40)) for i in range(300)] + [(300, "c", 10**7)]
    got = {r["k"]: r["admitted"] for r in order.greedy_admission(spark.createDataFrame(rows, "k long, g string, n long"), [F.col("k")], "k", "g", "n", 900, 1500).collect()}
    total, sums, want = 0, Counter(), {}
    for k, g, n in rows:
        want[k] = sums[g] + n <= 900 and total + n <= 1500
        if want[k]:
            sums[g] += n
            total += n
    assert got == want


def plain_train(texts, merges):
    words, rules = [[4 + b for b in t.encode()] for t in texts], []
    for new in range(260, 260 + merges):
        n = Counter(p for w in words for p in zip(w, w[1:]))
        best = min(n, key=lambda p: (-n[p], p))
        rules.append(best)
        words = [plain_merge(w, best, new) for w in words]
    return rules


def plain_merge(w, pair, new):
    out = []
    for x in w:
        if out and (out[-1], x) == pair:
            out[-1] = new
        else:
            out.append(x)
    return out


def test_bpe(spark):
    texts = ["ababcdcd", "ababcdcd", "aaaaa", "", "x", "cdab ünder"]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(9, None)], "doc_id long, text string")
    rules = bpe.train(docs, 6, cut_every=2)
    assert rules == plain_train(texts, 6)
    ids = {r["doc_id"]: r["ids"] for r in bpe.encode(docs, rules).collect()}
    for i, t in enumerate(texts):
        want = [4 + b for b in t.encode()]
        for k, pair in enumerate(rules):
            want = plain_merge(want, pair, 260 + k)
        assert ids[i] == want and bpe.decode_ids(want, rules) == t.encode()
    assert ids[9] == []
    with pytest.raises(ValueError):
        bpe.decode_ids([3], rules)
    with pytest.raises(ValueError):
        bpe.train(spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string"), 1)


def test_strict_json():
    good = {'{"b":1.0,"a":[1e2,null,true]}': '{"a":[100,null,true],"b":1}', '"\\u20ac\\n\\u0001"': '"€\\n\\u0001"', "1e21": "1e+21", "0.000001": "0.000001", "1e-7": "1e-7", "-0": "0", "123456789012345680000": "123456789012345680000"}
    for raw, want in good.items():
        assert strict_json.canonical_or_none(raw) == want
    for bad in ('{"a":1,"a":2}', '"\t"', '"\\ud800"', "NaN", "1e999", "0.1000000000000000055511151231257827", "[" * 200 + "]" * 200, "{", '{"a":{"b":1,"b":2}}'):
        assert strict_json.canonical_or_none(bad) is None
    keys = strict_json.canonical(strict_json.parse('{"\\ufb33":1,"\\ud83d\\ude00":2}'))
    assert keys.index("\U0001f600") < keys.index("\ufb33")


def test_python_facts():
    assert python_code.parses("x = 1\n") and not python_code.parses("x = = 1") and not python_code.parses("print 'x'")
    assert python_code.fragment("return 1") == [("return", "return"), ("number", "1")]
    assert python_code.fragment("x = = 1") == []
    assert python_code.comments("# é\nx = 1  # b\n") == [{"start": 0, "end": 4}, {"start": 12, "end": 15}]
    assert python_code.tree_digest("x=1") == python_code.tree_digest("x = 1 # c")


def test_licences(spark):
    cases = [("MIT OR GPL-3.0-only", True), ("MIT AND Apache-2.0", True), ("MIT AND GPL-3.0-only", False), ("Apache-2.0 WITH LLVM-exception", False), ("LicenseRef-private", False), ("", False), (None, False), ("(MIT OR X) AND (ISC)", True), ("MIT)", False), ("MIT AND", False)]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, e string")
    got = {r["i"]: r["ok"] for r in df.select("i", python_code.licence_udf(text.PERMISSIVE)("e").alias("ok")).collect()}
    assert [got[i] for i in range(len(cases))] == [c[1] for c in cases]


def test_tree_scan_and_stability(spark, tmp_path):
    root = tmp_path / "tree"
    (root / "pkg").mkdir(parents=True)
    (root / "pkg" / "a.py").write_text("x = 1\n")
    (root / "pkg" / "empty.py").write_text("")
    (root / "c.py").write_text("y = 1\n")
    (root / "b.txt").write_text("no")
    got = {r["relative_path"]: r["status"] for r in files.tree_scan(spark, str(root)).collect()}
    assert got == {"pkg/a.py": "admitted", "c.py": "admitted"}
    assert {r["relative_path"]: r["status"] for r in files.tree_scan(spark, str(root), depth=1).collect()} == {"pkg/a.py": "skipped_path", "c.py": "admitted"}
    before = spark.createDataFrame(files.discover(spark, str(root)).collect())
    assert files.stable(spark, str(root), before).count() == 0
    (root / "b.txt").write_text("changed")
    assert [r["path"].rsplit("/", 1)[1] for r in files.stable(spark, str(root), before).collect()] == ["b.txt"]


def test_jsonl_and_manifests(spark, tmp_path):
    path = tmp_path / "x.jsonl.gz"
    path.write_bytes(gzip.compress(b'{"task_id":"b","n":1.0}\n{"n":2,"task_id":"a"}\n'))
    digest = hashlib.sha256(path.read_bytes()).hexdigest()
    assert [tuple(r) for r in files.jsonl_scan(spark, str(path), digest).collect()] == [("a", '{"n":2,"task_id":"a"}'), ("b", '{"n":1,"task_id":"b"}')]
    with pytest.raises(ValueError):
        files.jsonl_scan(spark, str(path), "0" * 64)
    bad = tmp_path / "bad.jsonl"
    bad.write_text('{"task_id":1}\n')
    with pytest.raises(Exception, match="task_id"):
        files.jsonl_scan(spark, str(bad)).collect()
    plan = tmp_path / "m.json"
    plan.write_text('{"a": 1}')
    assert files.manifest_scan(spark, str(plan), "a int").first()["a"] == 1
    with pytest.raises(ValueError):
        files.manifest_scan(spark, str(plan), "a int", "0" * 64)
    plan.write_text('{"a": 1, "b": [{"c": 2, "d": 3}]}')
    assert files.manifest_scan(spark, str(plan), "a int, b array<struct<c: int, d: int>>").first()["a"] == 1
    for less in ("a int", "a int, b array<struct<c: int>>"):
        with pytest.raises(ValueError, match="keys"):
            files.manifest_scan(spark, str(plan), less)
    raw = spark.createDataFrame([(1, gzip.compress(b"abc")), (2, gzip.compress(b"abcd")), (3, b"no"), (4, None)], "k int, b binary")
    assert {r["k"]: r["v"] and bytes(r["v"]) for r in raw.select("k", files.gunzip(3)("b").alias("v")).collect()} == {1: b"abc", 2: None, 3: None, 4: None}


def test_parts_must_agree_with_the_index(spark):
    rows = files.ranked(spark.range(10).withColumn("g", F.floor(F.col("id") / 4)), "g", "id", 3).withColumn("line", F.col("id").cast("string"))
    index = sinks.sharded_manifest(rows)
    assert sorted(r["rows"] for r in index.collect()) == [1, 3, 3, 3]
    assert [r["id"] for r in files.sharded_manifest_scan(index, rows).collect()] == list(range(10))
    with pytest.raises(ValueError):
        files.sharded_manifest_scan(index, rows.where("id <> 4"))
    with pytest.raises(ValueError):
        files.sharded_manifest_scan(index, rows.withColumn("line", F.when(F.col("id") == 4, "x").otherwise(F.col("line"))))


def test_publish_once(spark, tmp_path):
    target = str(tmp_path / "out")
    sinks.publish(spark.range(3), target)
    assert spark.read.parquet(target).count() == 3
    with pytest.raises(FileExistsError):
        sinks.publish(spark.range(3), target)
    broken = str(tmp_path / "broken")
    with pytest.raises(Exception, match="boom"):
        sinks.publish(spark.range(3).select(F.raise_error(F.lit("boom")).cast("string").alias("x")), broken)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["out"]
    sinks.single_file("a", str(tmp_path / "one"))
    with pytest.raises(FileExistsError):
        sinks.single_file("b", str(tmp_path / "one"))
    for bad in (target, target + "/in", str(tmp_path / ".git" / "x")):
        with pytest.raises(ValueError):
            sinks.require_boundary(bad, [target])


def test_token_shards(spark, tmp_path):
    docs = spark.createDataFrame([("train", 0, [1, 2, 3, 4, 5]), ("train", 5, [6, 7]), ("test", 0, [9]), ("test", 1, [])], "split string, first_id long, ids array<int>")
    path = str(tmp_path / "shards")
    sinks.write_token_shards(docs, path, 3)
    shards = spark.read.parquet(path)
    assert [r["id"] for r in sinks.read_range(shards, "train", 1, 5, 3).orderBy("pos").collect()] == [2, 3, 4, 5, 6]
    assert [r["n"] for r in shards.where("split = 'train'").groupBy("shard").agg(F.sum(F.size("ids")).alias("n")).orderBy("shard").collect()] == [3, 3, 1]
    assert bytes(docs.where("first_id = 5").select(sinks.u16le("ids").alias("b")).first()["b"]) == b"\x06\x00\x07\x00"


class Site(http.server.BaseHTTPRequestHandler):
    def do_GET(self):
        self.send_response(302 if self.path in ("/hop", "/away", "/ring") else 200)
        to = {"/hop": "/body", "/away": "http://other.invalid/x", "/ring": "/ring"}.get(self.path)
        if to:
            self.send_header("Location", to)
        self.end_headers()
        if not to:
            self.wfile.write(b"hello")

    def log_message(self, *args):
        pass


def test_fetch():
    site = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Site)
    threading.Thread(target=site.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{site.server_port}"
    assert files.fetch(base + "/hop", 5, loopback=True) == (b"hello", hashlib.sha256(b"hello").hexdigest())
    for path, limit in (("/body", 4), ("/away", 9), ("/ring", 9)):
        with pytest.raises(ValueError):
            files.fetch(base + path, limit, loopback=True)
    with pytest.raises(ValueError):
        files.fetch(base + "/body", 9)
    site.shutdown()
    assert files.url_allowed("https://a.invalid/x") and not any(map(files.url_allowed, ("http://a.invalid", "https://u:p@a.invalid", "https://a.invalid/#x", "https://a b", "https://é.invalid", "https://")))
