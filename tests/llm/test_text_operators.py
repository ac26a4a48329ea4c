"""Chat, sharding, BPE, URL filters, WARC and language ID."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.llm import bpe, chat, language_id, sharding, url_filter, warc

ODD = "\\### Assistant: </turn> ok"


def chats(spark, rows):
    return {r["conv_id"]: r for r in chat.chat_digests(chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string"))).collect()}


def test_chat_round_trip(spark):
    rows = [(1, 0, "user", ODD), (1, 1, "assistant", ODD), (2, 0, "assistant", "\\\\### x</turn></turn>"), (3, 1, None, None), (3, 0, "tool(1): ", "é\n"), (None, 0, "user", ""), (4, 0, "user", "a" * 50_000), (4, 0, "user", "b"), (4, 0, "user", "b")]
    got = chats(spark, [(*r, "clash") for r in rows])
    for conv in {r[0] for r in rows}:
        mine = sorted([((r[1]), r[2] or "", r[3] or "") for r in rows if r[0] == conv])
        turns = "".join(f"{role}\n{text}\n" for _, role, text in mine)
        loss = "".join(text for _, role, text in mine if role == "assistant")
        assert got[conv]["turns_sha256"] == hashlib.sha256(turns.encode()).hexdigest()
        assert got[conv]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert (got[conv]["n_turns"], got[conv]["loss_chars"]) == (len(mine), len(loss))
    assert [got[c]["valid"] for c in (1, 2, 3, 4)] == [True, False, False, False]
    assert chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_chat_escapes_every_control_string(spark):
    random.seed(1)
    texts = ["".join(random.choice(["#", " ", "\\", "<", "/turn>", "</turn>", "### ", "x"]) for _ in range(12)) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escaped(F.col("t")).alias("e")).select("t", "e", chat.unescaped(F.col("e")).alias("back"))
    for r in df.collect():
        assert r["t"] == r["back"] and "### " not in r["e"] and "</turn>" not in r["e"]
    with pytest.raises(ValueError):
        chat.Template(control=("### ", "aXa"), end="aXa\n")


def test_sharding_law(spark):
    docs = spark.createDataFrame([(i, "x" * (i % 50), 1) for i in range(4000)] + [(None, None, 1), (None, "é", 1), (7, "x" * 7, 1)], "doc_id long, text string, shard int")
    rows = sharding.shard_documents(docs).collect()
    assert len(rows) == 4003
    assert all(r["grown_shard"] in (r["shard"], 40) for r in rows) and any(r["grown_shard"] == 40 for r in rows)
    counts = {}
    for r in rows:
        counts.setdefault(r["shard"], []).append(r["slot"])
    assert set(counts) == set(range(40)) and all(sorted(v) == list(range(len(v))) for v in counts.values())
    assert max(map(len, counts.values())) < 2 * 4003 / 40
    for r in rows:
        if r["doc_id"] == 9:
            assert (r["size"], r["text_crc32"]) == (25, zlib.crc32(b"x" * 9))
    assert {(r["size"], r["text_crc32"]) for r in rows if r["doc_id"] is None} == {(16, None), (18, zlib.crc32("é".encode()))}
    assert sharding.shard_documents(docs.limit(0)).count() == 0


def test_changed_weights_move_rows_of_that_subtree_only(spark):
    tree = sharding.balanced_tree(40)
    heavier = [sharding.Shard(s.region, s.rack, s.shard, 3.0 if s.shard == 12 else s.weight) for s in tree]
    ids = spark.range(3000)
    both = sharding.place(sharding.place(ids, "id", tree, "a"), "id", heavier, "b").where("a <> b").collect()
    region = {s.shard: s.region for s in tree}
    rack = {s.shard: s.rack for s in tree}
    # what moves goes into the region that grew; within the region into the rack, within the rack into the shard
    assert both and all(region[r["b"]] == region[12] for r in both)
    assert all(rack[r["b"]] == rack[12] for r in both if region[r["a"]] == region[12])
    assert all(r["b"] == 12 for r in both if rack[r["a"]] == rack[12])


@pytest.fixture(scope="module")
def coder():
    P = pytest.importorskip("public_tokenizers")
    tokens = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    table = bpe.PerfectHash(tokens)
    assert all(table.find(k) == i for i, k in enumerate(tokens)) and table.find(b"no such token at all") == -1
    return bpe.Coder(tokens, table, P.PATTERN), tokens, P


def test_bpe_matches_the_library(coder):
    tiktoken = pytest.importorskip("tiktoken")
    c, tokens, P = coder
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    random.seed(2)
    alphabet = "ab  \n\t\r 1²Ⅷé字中\u00a0\u3000 .!_-\u0301\x00𝔘😀'ſsdt\u200b\x1c\x85ªⅣ९ the of"
    texts = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 40))) for _ in range(4000)] + ["", "a" * 5000, "it's we'll 'S", "\n\n  x", "<|endoftext|>"]
    for t in texts:
        ids = [int(x) for x in c.encode(t).split(",") if x]
        assert ids == lib.encode_ordinary(t), t
        assert c.decode(c.encode(t)) == t.encode()


def test_bpe_query(spark, coder):
    c, _, P = coder
    docs = spark.createDataFrame([(1, "Hello world", 5), (2, None, 5), (3, "", 5), (None, "x", 5), (1, "Hello world", 5)], "doc_id long, text string, n_tokens int")
    rows = bpe.encode_documents(docs, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN, ids=True).collect()
    assert len(rows) == 5
    empty = hashlib.sha256(b"").hexdigest()
    for r in rows:
        if r["doc_id"] in (2, 3):
            assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], r["ids"]) == (0, empty, empty, [])
        if r["doc_id"] == 1:
            assert r["ids_sha256"] == hashlib.sha256(c.encode("Hello world").encode()).hexdigest() and r["n_tokens"] == len(r["ids"])
    assert bpe.encode_documents(docs.limit(0), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).count() == 0


RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def test_url_rules(spark):
    cases = {
        "http://a.EXAMPLE.org/es/1": ("a.example.org", "/es/1", "example.org/es/", "block"),
        "http://example.org/en/12?x": ("example.org", "/en/12", "example.org/en/1", "block"),
        "http://x.org": ("x.org", "", None, "allow"),
        "http://x.org/": ("x.org", "/", "org/", "allow"),
        "http://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
        "https://a.com/de/": ("a.com", "/de/", "com/de/", "block"),
        "a.com/de/": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "x://h?a/b": ("h", "", None, "allow"),
        "http://a://b/c": ("a:", "//b/c", None, "allow"),
    }
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(cases)], "page_id long, url string, bad string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(pages, RULES).collect()}
    assert got == dict(enumerate(cases.values()))


def test_url_templates(spark):
    pages = [(i, f"http://h.net/spam/{i}.html") for i in range(30)] + [(100 + i, f"http://h.net/good/{i}.html") for i in range(30)] + [(200 + i, f"http://h.net/user/u{'abcdefghij'[i]}x/home") for i in range(10)]
    labels = [(i, 1) for i in range(20)] + [(100 + i, 0) for i in range(20)] + [(5, 1), (101, None), (None, 1)]
    rows = url_filter.judge(spark.createDataFrame(pages, "page_id long, url string"), RULES, spark.createDataFrame(labels, "page_id long, bad int")).collect()
    by = {r["page_id"]: r for r in rows}
    assert len(rows) == len(pages)
    assert by[3]["verdict"] == by[29]["verdict"] == "block" and by[103]["verdict"] == "allow"
    assert by[3]["template"] == "/spam/{n}.x"
    assert len({by[200 + i]["template"] for i in range(10)}) == 1  # a wide node is variable
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge(empty, RULES).count() == 0


def test_url_templates_of_deep_paths(spark):
    """The tree tells branches apart at any depth."""
    deep = "/a/b/c/d/e/f/g/h/i"
    pages = [(i, f"http://h.net{deep}/spam/{i}") for i in range(20)] + [(100 + i, f"http://h.net{deep}/clean/{i}") for i in range(20)] + [(200, f"http://h.net{deep}"), (201, "http://other.net/x/y/z/1/2/3/4/5/6/7/8")]
    labels = [(i, 1) for i in range(20)] + [(100 + i, 0) for i in range(20)]
    rows = url_filter.judge(spark.createDataFrame(pages, "page_id long, url string"), RULES, spark.createDataFrame(labels, "page_id long, bad int")).collect()
    by = {r["page_id"]: r for r in rows}
    assert len(rows) == len(pages) and by[3]["verdict"] == "block" and by[103]["verdict"] == "allow"
    assert by[3]["template"] == f"{deep}/spam/{{n}}"


def test_warc_round_trip(spark):
    big = "<html>" + "x" * 200
    rows = [(3, "http://a/\r\nb", big), (1, "http://a/", big), (2, None, "short"), (5, "u", "short"), (4, "v", None), (6, "w", ""), (None, "n", big), (1, "http://a/", big)] + [(10 + i, f"http://h/{i}", f"<p>page {i}</p>" * 40) for i in range(40)]
    got = warc.archive_and_read(spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int")).collect()
    assert len(got) == len(rows)
    for r in got:
        html = {x[0]: x[2] or "" for x in rows}[r["page_id"]]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(html), hashlib.sha256(html.encode()).hexdigest())
        assert (r["record_type"], r["refers_to"]) == (("revisit", 1) if r["page_id"] in (3, None) else ("response", None))
        assert r["payload"] is None or r["payload"].decode() == html
    assert warc.archive_and_read(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_warc_archives_hold_a_dictionary(tmp_path):
    import zstandard

    path = tmp_path / "x.warc.zst"
    w = warc.Writer(path.open("wb"))
    records = [warc.make_record(i, f"http://h/{i}", b"<html><body>some common words %d</body></html>" % i * 20, "0" * 64, None, False, "2024-01-01T00:00:00Z") for i in range(60)]
    for r in records:
        w.add(r)
    w.close()
    data = path.read_bytes()
    assert data[:4] == (0x184D2A5D).to_bytes(4, "little")
    size = int.from_bytes(data[4:8], "little")
    assert data[8:12] == warc.DICTIONARY
    one = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size])).decompressobj()
    assert one.decompress(data[8 + size :]) == records[0]  # each record is a frame of its own
    with path.open("rb") as f:
        assert list(warc.read_archive(f)) == records


def brute_phrases(text, train):
    n, i = 0, 0
    while i < len(text):
        j = i + 1
        while j <= len(text) and text[i:j] in train:
            j += 1
        n, i = n + 1, max(i + 1, j - 1)
    return n


def test_cross_parse_against_brute_force():
    random.seed(4)
    make = lambda letters: "".join(random.choice(letters) for _ in range(300))
    model = language_id.fit({"x": [make("abc ")], "y": [make("bcd ")]})
    texts = ["".join(random.choice("abcd  e!") for _ in range(random.randint(1, 80))) for _ in range(200)]
    counts, _, has = language_id.cross_parse(texts, model)
    for t, row, h in zip(texts, counts, has, strict=True):
        assert h == any(c.isalpha() for c in t)
        if h:
            sym = model.symbol_of[language_id.points(t)].tolist()
            sym = [s for k, s in enumerate(sym) if k == 0 or s != 1 or sym[k - 1] != 1]
            for m in range(2):
                assert row[m] == brute_phrases("".join(map(chr, sym)), "".join(map(chr, model.symbols[m])))


def test_languages_of_large_alphabets(spark):
    """Two languages of the same word lengths whose letters are all rare, among 70 languages: all are learnt and told apart."""
    rng = random.Random(5)
    rows, truth = [], {}
    for k in range(70):
        own = [chr(0x4E00 + 100 * k + x) for x in range(100)]
        for d in range(6):
            i = 6 * k + d
            rows.append((i, f"l{k:02}", " ".join("".join(rng.choice(own) for _ in range(4)) for _ in range(60))))
            truth[i] = f"l{k:02}"
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    taught = {r["lang"] for r in docs.where(~language_id.held_out("doc_id")).collect()}
    assert len(taught) > 64
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(docs).collect()}
    assert {i: x for i, x in got.items() if truth[i] in taught} == {i: x for i, x in truth.items() if x in taught}


def test_languages_are_learnt_whatever_is_repeated(spark):
    """One row that is repeated doesn't crowd out the other rows or languages."""
    rows = [(1, "de", "der die und das ist nicht")] * 500 + [(10 + i, lang, f"{text} {i}") for i in range(40) for lang, text in (("de", "ein haus und ein baum"), ("en", "the of and was with her"), ("en", "a house and a tree"))]
    model = language_id.learn(spark.createDataFrame(rows, "doc_id long, lang string, text string"))
    assert model.languages == ["de", "en"]
    assert language_id.predict(["was the house with her", "ein haus ist das"], model)[0] == ["en", "de"]
    two = spark.createDataFrame([(1, "en", "b b"), (1, "en", "a a"), (1, "fr", "c c")], "doc_id long, lang string, text string")
    assert language_id.learn(two).languages == ["en", "fr"]


def test_perfect_hash_takes_another_seed():
    keys = [b"%04d" % i for i in range(3000)]
    table = bpe.PerfectHash(keys)
    assert all(table.find(k) == i for i, k in enumerate(keys)) and sorted(table.slots) == list(range(3000))
    with pytest.raises(ValueError):
        bpe.PerfectHash([b"a", b"a"])


def test_archives_are_read_from_any_name():
    for uri, kind in (("/tmp/x", "local"), ("file:/tmp/x", "local"), ("file:///tmp/x", "local")):
        fs, path = warc._open(uri)
        assert fs.type_name == kind and path == "/tmp/x"


def test_language_id(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = spark.createDataFrame([(10**6, None, None), (10**6 + 1, "", "en"), (10**6 + 2, "123 !?", "fr"), (None, "the of and", None)], "doc_id long, text string, lang string")
    both = docs.select("doc_id", "text", "lang", F.lit("clash").alias("score")).unionByName(extra.withColumn("score", F.lit("clash")))
    rows = language_id.identify(both, train=both).select("*", language_id.held_out("doc_id").alias("held")).collect()
    assert len(rows) == docs.count() + 4
    odd = {r["doc_id"]: r for r in rows if r["doc_id"] is None or r["doc_id"] >= 10**6}
    assert [odd[10**6 + i]["lang_pred"] for i in range(3)] == ["und"] * 3 and odd[None]["lang_pred"] != "und"
    tested = [r for r in rows if r["held"] and r["doc_id"] < 10**6]
    assert all(r["held"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in tested)
    assert sum(r["lang_pred"] == r["lang"] for r in tested) >= 0.95 * len(tested) and all(0 <= r["score"] <= 1 for r in rows)
    assert language_id.identify(both.limit(0)).count() == 0
    long = language_id.predict(["the of and " * 50_000], language_id.fit({"en": ["the of and was with"], "de": ["der die und das"]}))
    assert long[0] == ["en"]


def test_languages_of_large_batches_take_little_memory(monkeypatch):
    """Texts are parsed a piece at a time, however many a batch has, with the counts that they have at once."""
    import tracemalloc

    rng = random.Random(6)
    texts = ["".join(rng.choice("abcd e!") for _ in range(100)) for _ in range(10_000)] + [None, "", "1"]
    model = language_id.fit({"x": ["abc cab " * 30], "y": ["bcd dbc " * 30]})
    whole = language_id.cross_parse(texts, model)
    monkeypatch.setattr(language_id, "PIECE", 1 << 16, raising=False)
    monkeypatch.setattr(language_id, "LANES", 1000, raising=False)
    tracemalloc.start()
    pieces = language_id.cross_parse(texts, model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert all(np.array_equal(a, b) for a, b in zip(whole, pieces, strict=True))
    assert peak < 2 << 20  # all symbols at once, twice, are 8 MB


def test_tasks_drop_what_other_operators_keep():
    import weakref
    from types import SimpleNamespace

    from sparkloom.llm import common

    tokens = [bytes([b]) for b in range(256)]
    shared = SimpleNamespace(value=(tokens, bpe.PerfectHash(tokens), bpe.KNOWN_PATTERN))
    coders = lambda _: iter([weakref.ref(bpe._coder(shared))])
    (first,), (second,) = (list(common.lean(coders, "bpe")(iter([]))) for _ in range(2))
    assert first() is not None and first() is second()
    assert list(common.lean(lambda batches: batches)(iter([1, 2]))) == [1, 2] and first() is None


def test_words_are_split_at_ascii_space_only():
    from sparkloom.llm.common import text_words

    for t in ["a b\tc\n\x0b\x0cd\re", "x\u00a0y z", "", " ", "É é", "A a"]:
        want = re.findall(r"[^\x20\x09-\x0D]+", t)
        w = text_words(t)
        assert len(w) == len(want)
    assert text_words("ABC")[0] == text_words("abc")[0] and text_words("É")[0] != text_words("é")[0]
