"""URL filters, token counts, BPE, fingerprints and archives against brute force, and on awkward input."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kerbside.llm import bpe, fingerprints, token_counts, url_filters, warc
from kerbside.llm.queries import URL_RULES

LONG = "wörd " * 30_000
AWKWARD = [None, "", " ", "\n\n", "a", "same", "same", "x" * 9_000, " " * 5_000, "ab12# " * 4_000, LONG, "İΑΣ é́ <|endoftext|> don't", "𐕰𐕱 \U0001e5d0"]


@pytest.fixture
def awkward(spark):
    """Rows with null ids, repeated rows and columns named like results."""
    data = [(i if i != 3 else None, t, -1, "x") for i, t in enumerate(AWKWARD)]
    return spark.createDataFrame(data, "doc_id long, text string, n_tokens int, value string")


def test_hosts_paths_and_longest_rules(spark):
    urls = [
        ("HTTP://Blog.Example.COM/en/1?q#f", "blog.example.com", "/en/1", "example.com/en/", "block"),
        ("https://www.example.com/en/x", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
        ("https://a.www.example.com/en/x", "a.www.example.com", "/en/x", "www.example.com/en/", "allow"),
        ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
        ("http://example.com", "example.com", "", None, "allow"),
        ("x://net/es/", "net", "/es/", "net/es/", "block"),
        ("a://b://net/fr/", "b:", "//net/fr/", None, "allow"),
        ("no scheme", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("", "", "", None, "allow"),
        ("http://a.org/porn", "a.org", "/porn", None, "block"),
        ("http://a.org/pornography", "a.org", "/pornography", None, "allow"),
        ("http://a.org/casino", "a.org", "/casino", None, "allow"),
        ("http://a.org/casino/casino", "a.org", "/casino/casino", None, "allow"),
        ("http://a.org/Casino-poker", "a.org", "/Casino-poker", None, "block"),
        ("http://porn.com/", "porn.com", "/", "com/", "allow"),
    ]
    df = spark.createDataFrame([(i, u[0], "own") for i, u in enumerate(urls)], "page_id long, url string, HOST string")
    got = url_filters.judge_urls(df, URL_RULES).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in got] == [u[1:] for u in urls]
    assert url_filters.judge_urls(df.limit(0), URL_RULES).count() == 0
    assert {r.verdict for r in url_filters.judge_urls(df, (), (), ()).collect()} == {"allow"}


def test_rules_of_equal_length_prefer_the_longer_host():
    index = url_filters.rule_index([("allow", "com/ab"), ("block", "b.com/")])
    assert url_filters.longest_rule("b.com", "/ab", index) == ("b.com/", "block")


@pytest.mark.parametrize("table_size", [0, 3, 1 << 16])
def test_token_counts_equal_the_library(awkward, table_size):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted((len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for t in AWKWARD)
    got = token_counts.count_tokens(awkward, table_size=table_size, limit=100)
    assert sorted((r.n_bytes, r.n_tokens) for r in got.collect()) == want
    assert all(r.over_limit == (r.n_tokens > 100) for r in got.collect())
    assert token_counts.count_tokens(awkward.limit(0)).count() == 0


def test_the_cache_of_a_worker_may_start_afresh(monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE_SIZE", 4)
    path = public_tokenizers.path("word_bpe_49k.json")
    worker, tokenizer = token_counts.PreTokenCounter(path, {}), Tokenizer.from_file(path)
    texts = [" ".join(f"w{i}x{j}" for j in range(5)) for i in range(20)]
    assert [worker.count([t])[0] for t in texts] == [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


def test_bpe_equals_the_library_and_round_trips(awkward):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for long_bytes in (1 << 16, 2_000):  # few or many texts are dealt out as pieces
        rows = bpe.decode(bpe.encode(awkward, long_bytes=long_bytes)).collect()
        assert len(rows) == len(AWKWARD)
        for r in rows:
            want = tokenizer.encode(r.text or "", add_special_tokens=False).ids
            assert bpe.from_bytes(r.ids) == want and r.n_tokens == len(want)
            assert r.decoded == tokenizer.decode(want, skip_special_tokens=False) == (r.text or "")
    assert bpe.encode(awkward.limit(0)).count() == 0


@pytest.mark.parametrize("leaf", [3, 16, 300])
def test_tree_concatenation_is_exact(leaf):
    path = public_tokenizers.path("byte_bpe_50k.json")
    codec, tokenizer, rng = bpe.codec(path), Tokenizer.from_file(path), random.Random(leaf)
    for alphabet in ("a", "ab", "etaoinshr", "é世a", "=-", " ", "0123"):
        text = "".join(rng.choice(alphabet) for _ in range(3_000))
        parts = codec.leaves(text.encode(), leaf)
        assert codec.decode(codec.tree(parts)) == text
        assert codec.encode(text + " end", leaf) == tokenizer.encode(text + " end", add_special_tokens=False).ids


def test_fingerprints_ignore_order_and_follow_edits():
    text = "one two three\nfour five six\n\nseven\nseven"
    whole = fingerprints.fingerprint(text)
    assert whole == fingerprints.fingerprint("seven\nfour five six\nseven\none two three")
    assert whole != fingerprints.fingerprint("one two three\nfour five six\nseven")
    less = fingerprints.delete(whole, "four five six")
    assert less == fingerprints.fingerprint("one two three\nseven\nseven")
    assert fingerprints.insert(less, "four five six") == whole
    assert fingerprints.insert(fingerprints.fingerprint(""), text) == whole


def test_documents_beside_the_next(spark, awkward):
    rows = [(r.doc_id, r.text or "") for r in awkward.collect()]
    rows += [(5, "tie"), (5, "tie")]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, fingerprint int").repartition(5)
    rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    want = []
    for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        edited = text[: len(text) - len(text) // 3] + following[: len(text) // 3]
        want.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), fingerprints.fingerprint(text), fingerprints.fingerprint(edited)))
    got = fingerprints.compare_with_next(df).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert fingerprints.compare_with_next(df.limit(0)).count() == 0
    alone = fingerprints.compare_with_next(df.where("doc_id = 4")).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0


def test_likeness_tells_edits_from_others():
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 6))
    texts = ["\n".join(" ".join(word() for _ in range(12)) for _ in range(10)) for _ in range(20)]
    edits = [fingerprints.spliced(a, b) for a, b in zip(texts, texts[1:])]
    hasher = fingerprints.Hasher()
    plain, edited = (hasher.vectors([t.encode() for t in x]) for x in (texts, edits))
    assert fingerprints.likeness(plain[:-1], edited).min() > 0.5
    assert fingerprints.likeness(plain[:-1], plain[1:]).max() < 0.25


@pytest.mark.parametrize("broadcast", [True, False])
def test_archives_round_trip(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr("kerbside.session.BROADCAST_BYTE_LIMIT", -1)
    payloads = [None, "", "<p>a</p>", "<p>a</p>", "é" * 100_000, "é" * 100_000, "line\r\n\r\nWARC/1.1\r\n", "x"]
    data = [(i, "http://h/\r\n" if i == 6 else None if i == 7 else f"http://h/{i}", p, "own") for i, p in enumerate(payloads)]
    data += [(3, "http://h/again", "<p>a</p>", "own"), (None, "http://h/none", "x", "own"), (None, "http://h/none", "y", "own")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string, record_type string").repartition(3)
    for least in (0, 5):
        manifest = warc.write_archives(warc.record_chunks(pages, min_bytes=least, chunk_bytes=1_000), archive_bytes=50_000)
        chunks = warc.read_archives(manifest, chunk_bytes=777).collect()
        last = [c for c in chunks if c["last"]]
        assert len(last) == len(data) == sum(r.records for r in manifest.collect())
        assert max(len(c.data) for c in chunks) <= 777
        best = {}
        for i, _, p, _ in data:
            if i is not None:
                best[p or ""] = max(best.get(p or "", -1), i)
        want = []
        for i, _, p, _ in data:
            body, kept = (p or "").encode(), best.get(p or "")
            refers = kept if kept is not None and kept != i and len(body) >= least else None
            want.append((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "response" if refers is None else "revisit", refers))
        key = lambda r: tuple(str(x) for x in r)
        got = [(c.record_id, c.payload_bytes, c.payload_digest, c.record_type, c.refers_to) for c in last]
        assert sorted(got, key=key) == sorted(want, key=key)
        for c in last:
            if c.record_type == "response":
                assert c.digest_so_far == c.payload_digest and c.bytes_so_far == c.payload_bytes
    assert warc.read_archives(warc.write_archives(warc.record_chunks(pages.limit(0)))).count() == 0


@pytest.mark.parametrize("most, tasks", [(100, 9), (4, 4)])
def test_archives_are_read_side_by_side(spark, most, tasks):
    """Every archive has a task of its own, and beyond the bound all tasks have their share."""
    pages = spark.range(0, 90, 1, 9).selectExpr("id AS page_id", "'u' AS url", "repeat(string(id), 100) AS html")
    manifest = warc.write_archives(warc.record_chunks(pages))
    assert manifest.count() == 9
    read = warc.read_archives(manifest, most_tasks=most).withColumn("task", F.spark_partition_id())
    records = {r.task: r.records for r in read.where("last").groupBy("task").agg(F.count("*").alias("records")).collect()}
    assert len(records) == tasks and sum(records.values()) == 90 and max(records.values()) <= 10 * -(-9 // tasks)


def test_large_pages_of_one_batch(spark):
    """Pages above the slice size meet in one batch; each goes through in chunks."""
    pages = spark.range(0, 3, 1, 1).selectExpr("id AS page_id", "'u' AS url", "repeat(string(id), 20000000) AS html")
    chunks = warc.read_archives(warc.write_archives(warc.record_chunks(pages)))
    found = {r.record_id: r for r in chunks.where("last").select("record_id", "payload_bytes", "digest_so_far", "chunk_no").collect()}
    for i in range(3):
        digest = base64.b32encode(hashlib.sha1(str(i).encode() * 20_000_000).digest()).decode()
        assert (found[i].payload_bytes, found[i].digest_so_far, found[i].chunk_no) == (20_000_000, digest, 20_000_000 // 65_536)


def test_a_damaged_archive_is_noticed(spark):
    import gzip

    pages = spark.createDataFrame([(1, "u", "payload")], "page_id long, url string, html string")
    path = warc.write_archives(warc.record_chunks(pages)).collect()[0].path.removeprefix("file://")
    with gzip.open(path) as file:
        data = file.read()
    with gzip.open(path, "wb") as file:
        file.write(data.replace(b"payload\r\n\r\n", b"pAyload\r\n\r\n"))
    with pytest.raises(ValueError, match="digest"):
        list(warc._archive_chunks("file://" + path, 4))
