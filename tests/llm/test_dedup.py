"""Near-duplicate, passage and benchmark operators and the pipeline, against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.llm import common, decontaminate, embedding_dedup, jaccard_join, substring_dedup

DOCS = "doc_id long, text string, n_words string, n long"


def components_of(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    k = min(5, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def brute_jaccard(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    ids = sorted(sets)
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    return {i: (len(sets[i]), c) for i, c in components_of(ids, links).items()}


def test_components(spark):
    random.seed(6)
    chain = [(i, i + 1) for i in range(60)] + [(i, 500) for i in range(400, 480)] + [(900, 900), (None, 3)]
    some = [(random.randrange(1000, 1200), random.randrange(1000, 1200)) for _ in range(120)]
    edges = chain + some
    got = {r["node"]: r["component"] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    assert got == components_of({x for e in real for x in e}, real)
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_copies(seed, groups, size, words):
    random.seed(seed)
    texts, i = {}, 0
    for _ in range(groups):
        base = [f"w{random.randrange(400)}" for _ in range(words)]
        for _ in range(size):
            w = list(base)
            for _ in range(random.randrange(5)):
                w[random.randrange(len(w))] = f"e{random.randrange(10**6)}"
            texts[i] = " ".join(w)
            i += 1
    return texts


@pytest.mark.parametrize(("groups", "size", "words"), [(3, 60, 120), (40, 4, 9), (10, 6, 60)])
def test_jaccard_join(spark, groups, size, words, monkeypatch):
    monkeypatch.setattr(jaccard_join, "FREQUENT", 8)
    texts = near_copies(groups, groups, size, words)
    passage = " ".join(f"p{k}" for k in range(40))
    n = len(texts)
    for k in range(30):  # a passage that many texts share
        texts[n + k] = " ".join(f"z{random.randrange(10**6)}" for _ in range(60)) + " " + passage
    n = len(texts)
    texts |= {n: None, n + 1: "", n + 2: " \n", n + 3: "one", n + 4: "ONE", n + 5: "one two", n + 6: "one\ttwo", n + 7: "a b c d e", n + 8: "a b c d e f", n + 9: "x " * 3000, n + 10: "x " * 2000}
    rows = [(i, t, "clash", 1) for i, t in texts.items()]
    got = jaccard_join.jaccard_components(spark.createDataFrame([*rows, rows[0], (None, texts[0], "", 1), (None, None, "", 1)], DOCS)).collect()
    assert len(got) == len(rows) + 3
    want = brute_jaccard(texts)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None} == want


def test_jaccard_join_of_shared_digests(spark, monkeypatch):
    """Different sets whose first 64 bits are equal stay apart; a class that most rows have is joined by broadcast."""
    both = jaccard_join.Ids.both
    monkeypatch.setattr(jaccard_join.Ids, "both", staticmethod(lambda s: (both(s)[0] % 7, both(s)[1])))
    texts = near_copies(3, 6, 5, 40)
    texts |= {1000 + i: "the same text for most of all rows" for i in range(2500)}
    ids = jaccard_join.Ids(frozenset(range(7)))
    assert len({ids(np.array([i], np.uint64)) for i in range(50)}) == 50
    monkeypatch.undo()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(spark.createDataFrame([(i, t, "", 1) for i, t in texts.items()], DOCS)).collect()}
    want = brute_jaccard({i: t for i, t in texts.items() if i <= 1000})
    assert {i: got[i] for i in want} == want and all(got[i] == got[1000] for i in range(1000, 3500))


def test_jaccard_join_of_nothing(spark):
    assert jaccard_join.jaccard_components(spark.createDataFrame([], DOCS)).count() == 0


def test_bitmaps_bound_the_distance():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = np.unique(rng.integers(0, 2**63, rng.integers(1, 300)).astype(np.uint64))
        b = np.unique(np.concatenate((rng.choice(a, rng.integers(0, len(a) + 1), replace=False), rng.integers(0, 2**63, rng.integers(1, 300)).astype(np.uint64))))
        d = len(set(a.tolist()) ^ set(b.tolist()))
        assert jaccard_join.bitmap_distance(jaccard_join.parity_bits(a), jaccard_join.parity_bits(b)) <= d


def test_embedding_links(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(30, 16))
    rows, i = [], 0
    for k in range(30):
        for _ in range(6):
            v = (base[k] + rng.normal(size=16) * rng.choice([0.0, 0.02, 0.12])) * rng.uniform(0.1, 9)
            rows.append((i, [float(np.float32(x)) for x in v], int(k % 3)))
            i += 1
    rows += [(i, rows[0][1], 0), (i + 1, rows[0][1], 0), (i + 2, rows[0][1], None), (i + 3, None, 0), (i + 4, [0.0] * 16, 0), (i + 5, [float("nan")] * 16, 0), (i + 6, [None] * 16, 0), (i + 7, [], 0), (i + 8, [1.0, 0.0], 0), (i + 9, [2.0, 0.0], 0), (i + 10, [float("inf")] + [0.0] * 15, 0)]
    ok = {r[0]: np.array(r[1], float) for r in rows if r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])}
    label = {r[0]: (r[2], len(r[1] or [])) for r in rows}
    links = [(a, b) for a in ok for b in ok if a < b and label[a] == label[b] and ok[a] @ ok[b] / (np.linalg.norm(ok[a]) * np.linalg.norm(ok[b])) >= 0.98]
    n = Counter(x for e in links for x in e)
    comp = components_of([r[0] for r in rows], links)
    df = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<float>, label int, rep string")
    for tile in (2048, 16):  # one block, and several
        got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.near_duplicates(df, tile=tile).collect()}
        assert got == {r[0]: (n[r[0]], comp[r[0]], comp[r[0]] == r[0]) for r in rows}
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_embedding_links_of_odd_rows(spark):
    """Null and repeated vec_ids, and vectors of any length."""
    near, far = [1.0, 0.1, 0.0], [0.0, 0.0, 1.0]
    rows = [(5, near, 1), (None, [1.0, 0.11, 0.0], 1), (6, [1.0, 0.0, 0.0], 1), (7, near, 2), (7, far, 1), (8, [x * 1e-170 for x in near], 1), (9, [x * 1e170 for x in near], 1), (None, [5.0, 5.0, 5.0], 3), (10, [5e-324, 0.0, 0.0], 4), (11, [1e308, 0.0, 0.0], 4)]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    want = [(5, 4, 5, True), (None, 4, 5, False), (6, 4, 5, False), (7, 0, 7, True), (7, 0, 7, True), (8, 4, 5, False), (9, 4, 5, False), (None, 0, None, False), (10, 1, 10, True), (11, 1, 10, False)]
    assert Counter(map(tuple, got)) == Counter(want)


def test_embedding_dedup_of_many_copies(spark):
    """A vector that most rows have, beside others: its class is joined by broadcast."""
    rows = [(i, [1.0, 0.0], 0) for i in range(3000)] + [(5000 + i, [float(i + 1), 1.0], 0) for i in range(40)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in rows if i == 0 or i >= 5000}
    near = {i: [j for j in unit if j != i and unit[i] @ unit[j] >= 0.98] for i in unit}
    assert all(got[i] == (2999 + len(near[0]), 0) for i in range(3000))
    for i in unit:
        if i:
            assert got[i][0] == len(near[i]) + (2999 if 0 in near[i] else 0)


def test_quantisation_bounds_hold():
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=(80, 48)), rng.normal(size=(70, 48))
    ua, ub = a / np.linalg.norm(a, axis=1)[:, None], b / np.linalg.norm(b, axis=1)[:, None]
    qa, sa, na, ea = embedding_dedup.quantise(ua)
    qb, sb, nb, eb = embedding_dedup.quantise(ub)
    near = embedding_dedup.int8_products(qa, qb) * sa[:, None] * sb
    assert (np.abs(near - ua @ ub.T) <= na[:, None] * eb + ea[:, None] * (nb + eb)).all()


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_best_match_against_brute_force():
    random.seed(8)
    for _ in range(200):
        a = [random.randrange(4) for _ in range(random.randint(1, 8))]
        b = [random.randrange(4) for _ in range(random.randint(0, 12))]
        want = min(edit_distance(a, b[i:j]) for i in range(len(b) + 1) for j in range(i, len(b) + 1))
        assert decontaminate.best_match(np.array(a, np.uint64), np.array(b, np.uint64))[0] == want


def test_decontamination(spark):
    random.seed(9)
    word = lambda: f"v{random.randrange(900)}"
    items = [(k, " ".join(word() for _ in range(random.randint(12, 60)))) for k in range(40)]
    docs, planted = [], set()
    for d in range(400):
        w = [word() for _ in range(random.randint(0, 150))]
        if d % 2:
            k = random.randrange(40)
            v = items[k][1].split()
            for _ in range(random.randint(0, len(v) // 10)):
                v[random.randrange(len(v))] = "changed"
            at = random.randint(0, len(w))
            w[at:at] = [x.upper() if d % 3 == 0 else x for x in v]
            planted.add((d, k))
        docs.append((d, " ".join(w), "clash", 1))
    docs += [(None, items[0][1], "", 1), (1000, None, "", 1), (1001, "", "", 1), (1002, items[1][1] + " x" * 100_000, "", 1)]
    bench = [*items, (50, None), (51, ""), (None, "a b c d e f"), (52, "two words")]
    rows = decontaminate.contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(*b, 1) for b in bench], "item_id long, text string, doc_id int")).collect()
    found = {(r["doc_id"], r["item_id"]) for r in rows}
    missed = planted - found
    assert len(missed) <= 0.02 * len(planted) and (1002, 1) in found and found - planted == {(1002, 1)}
    kept = decontaminate.without_contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(bench, "item_id long, text string"))
    assert kept.columns == ["doc_id", "text", "n_words", "n"] and kept.count() == len(docs) - len({d for d, _ in found})
    assert decontaminate.contaminated(spark.createDataFrame([], DOCS), spark.createDataFrame([], "item_id long, text string")).count() == 0


@pytest.mark.parametrize("where", ["first", "last", "even", "random"])
def test_decontamination_at_the_limit(spark, where):
    """Every item is found with len / 5 words changed or missing, wherever they are."""
    rng = random.Random(31)
    items = [(n * 10 + r, [f"i{rng.randrange(3000)}" for _ in range(n)]) for n in range(5, 40) for r in range(6)]
    docs = []
    for d, (_, w) in enumerate(items):
        n, k = len(w), len(w) // 5
        hit = {"first": range(k), "last": range(n - k, n), "even": range(0, 5 * k, 5), "random": rng.sample(range(n), k)}[where]
        v = [f"c{d}" if i in hit else x for i, x in enumerate(w) if not (d % 2 and i in hit)]
        docs.append((d, " ".join([*(f"p{rng.randrange(3000)}" for _ in range(30)), *v, *(f"q{rng.randrange(3000)}" for _ in range(30))])))
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert {(d, i) for d, (i, _) in enumerate(items)} <= found


def test_substring_dedup(spark):
    random.seed(11)
    word = lambda: random.choice(["the", "of", "and", f"u{random.randrange(5000)}"])
    long = [" ".join(word() for _ in range(n)) for n in (51, 60, 75, 120, 200)]
    short = [" ".join(word() for _ in range(n)) for n in (10, 25, 40)]
    texts, has = {}, {}
    for d in range(150):
        w = [word() for _ in range(random.randint(10, 200))]
        p = random.choice([None, *long, *short])
        if p:
            at = random.randint(0, len(w))
            w[at:at] = [f"@{d}", *p.split(), f"#{d}"]
        texts[d], has[d] = " ".join(w), p
    docs = [(d, t, "clash", 1) for d, t in texts.items()] + [(500, texts[0], "", 1), (501, None, "", 1), (502, "", "", 1), (None, texts[0], "", 1), (0, texts[0], "clash", 1), (503, "again " * 4000, "", 1)]
    rows = substring_dedup.dedup_substrings(spark.createDataFrame(docs, DOCS)).collect()
    assert len(rows) == len(docs)
    got = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    seen = set()
    for d in range(150):
        p = has[d]
        if p in long and p in seen:
            assert p not in got[d]["text"] and got[d]["removed_words"] == len(p.split()), d
            assert got[d]["text"].split() == [x for x in texts[d].replace(p, " ").split()]
        else:
            assert got[d]["text"] == texts[d] and got[d]["removed_words"] == 0, d
        seen.add(p)
    assert got[500]["text"] == "" and got[501]["text"] is None and got[502]["text"] == ""
    assert [r["text"] for r in rows if r["doc_id"] is None] == [texts[0]] and got[503]["removed_words"] == 0
    assert substring_dedup.dedup_substrings(spark.createDataFrame([], DOCS)).count() == 0


def units(text):
    """Words as operator 9 compares them."""
    return re.findall(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u9fff\uf900-\ufaff\uff00-\uffef\U00020000-\U0003ffff]|[^\x20\x09-\x0D\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u9fff\uf900-\ufaff\uff00-\uffef\U00020000-\U0003ffff]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))


def brute_substrings(docs, least=50):
    """By (doc_id, text): words, and which of them are in a stretch of ``least`` words that a smaller doc_id has."""
    owner, out = {}, {}
    words = {(i, t): units(t) for i, t in docs if i is not None and t is not None}
    for (i, _), w in words.items():
        for k in range(len(w) - least + 1):
            key = tuple(w[k : k + least])
            owner[key] = min(owner.get(key, i), i)
    for (i, t), w in words.items():
        gone = [False] * len(w)
        for k in range(len(w) - least + 1):
            if owner[tuple(w[k : k + least])] < i:
                gone[k : k + least] = [True] * least
        out[i, t] = (w, gone)
    return out


def check_substrings(spark, docs, least=50):
    got = substring_dedup.dedup_substrings(spark.createDataFrame(docs, "doc_id long, text string"), least).collect()
    assert len(got) == len(docs)
    want = brute_substrings(docs, least)
    left = Counter()
    for (i, t), (w, gone) in want.items():
        left[i, len(w), sum(gone), tuple(x for x, g in zip(w, gone, strict=True) if not g)] += sum((a, b) == (i, t) for a, b in docs)
    assert Counter((r["doc_id"], r["n_words"], r["removed_words"], tuple(units(r["text"]))) for r in got if r["doc_id"] is not None and r["text"] is not None) == left
    return sum(sum(g) for _, g in want.values())


@pytest.mark.parametrize("words", [2, 40, 3000])
def test_substring_dedup_against_brute_force(spark, words):
    """Long passages, shorter ones side by side, parts of popular lines, repeated lines behind different text, rows that share a
    doc_id, texts without blanks: exactly the stretches of 50 words that one earlier document has go."""
    rng = random.Random(words)
    some = lambda n: [f"w{int(rng.random() ** 2 * words)}" for _ in range(n)]
    pool = [some(n) for n in (30, 30, 45, 49, 50, 51, 64, 90, 300)] + [(some(p) * 60)[:n] for p, n in ((1, 51), (2, 60), (3, 55), (7, 120), (16, 80))]
    docs = []
    for d in range(300):
        w = some(rng.choice([0, 3, 30, 120]))
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(pool)
            a = rng.randint(0, len(p)) if rng.random() < 0.3 else 0
            w += [*p[a:], *some(rng.choice([0, 0, 1, 5, 40]))]
        docs.append((d, rng.choice([" ", "\n", "  "]).join(x.upper() if rng.random() < 0.1 else x for x in w)))
    docs += [docs[5], (6, docs[7][1]), (7, docs[6][1]), (None, docs[3][1]), (None, None), (900, None), (901, ""), (902, " \n")]
    assert check_substrings(spark, docs) > 1000


def test_substring_dedup_of_texts_without_blanks(spark):
    rng = random.Random(3)
    some = lambda n, first=0x4E00: "".join(chr(first + rng.randrange(300)) for _ in range(n))
    pool = [some(n) for n in (40, 49, 50, 60, 400)] + [some(70, 0x0E01), some(70, 0x20000), "latin words " * 20 + some(30)]
    docs = [(d, some(rng.randint(0, 80)) + rng.choice(pool) + some(rng.randint(0, 80))) for d in range(120)]
    assert check_substrings(spark, docs) > 1000
    assert check_substrings(spark, docs, 20) > 1000


def test_substring_dedup_keeps_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 5, 6, 7)], "doc_id int, text string, doc long, mark int, check int")
    out = substring_dedup.dedup_substrings(docs)
    assert out.columns == [*docs.columns, "n_words", "removed_words", "removed"]
    assert tuple(out.first()) == (1, "a b", 5, 6, 7, 2, 0, [])


def test_every_passage_shares_chunks_whatever_is_around_it():
    rng = np.random.default_rng(12)
    word = lambda n, k: [b"%x" % x for x in rng.integers(0, k, n)]
    for period in (1, 2, 3, 5, 8, 10, 16, 50):
        for least in (9, 20, 50):
            passage = (word(period, 40) * 50)[:least]
            digests, found = [], []
            for _ in range(2):
                before = word(rng.integers(0, 60), 99)
                words = substring_dedup.Words([b" ".join([*before, *passage, *word(rng.integers(0, 60), 99)])])
                c = substring_dedup.Chunks(words, least)
                digests.append(c)
                found.append(len(before))
            for a, b, at in ((*digests, found[0]), (*digests[::-1], found[1])):
                assert at in a.stretches(np.isin(a.digests(), b.digests())).tolist()


def test_repeated_lines_are_cut_out(spark):
    rng = random.Random(13)
    docs, lines = [], []
    for x in range(80):
        line = [f"line{x}w{k}" for k in range(2 + 2 * (x % 5))]
        passage = (line * 50)[: 60 + 4 * (x % 9)]
        lines.append((" ".join(passage), len(passage)))
        for side in range(2):
            before = [f"b{x}_{side}_{k}" for k in range(rng.randint(0, 40))]
            docs.append((2 * x + side, " ".join([*before, *passage, *(f"e{x}_{side}_{k}" for k in range(rng.randint(1, 40)))])))
    got = {r["doc_id"]: r for r in substring_dedup.dedup_substrings(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert [got[2 * x]["removed_words"] for x in range(80)] == [0] * 80
    assert [got[2 * x + 1]["removed_words"] for x in range(80)] == [n for _, n in lines]


def test_chunks_resist_shifts():
    rng = np.random.default_rng(2)
    text = b" ".join(b"%x" % x for x in rng.integers(0, 2**40, 400))
    one, two = (set(substring_dedup.Chunks(substring_dedup.Words([t]), 50).digests().tolist()) for t in (text, b"some words before it " + text))
    assert len(one & two) >= len(one) - 2


def brute_matches(docs, items):
    """(doc_id, item_id) -> fewest edits and where such a stretch first ends, of the matches within a fifth of the item's words."""
    out = {}
    words = {i: common.text_words(t) for i, t in docs.items()}
    for k, text in items.items():
        item = common.text_words(text)
        for i, w in words.items():
            if len(item) and len(w):
                edits, end = decontaminate.best_match(item, w)
                if edits <= len(item) // 5:
                    out[i, k] = (edits, end)
    return out


def test_decontamination_query_against_brute_force(spark, sf):
    """The query's rows, on its table with copies of items at and beyond the limit added."""
    from sparkloom.llm.queries import op8_decontamination

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    got = {(r["doc_id"], r["item_id"]): (r["edits"], r["end_word"]) for r in op8_decontamination(spark, sf).collect()}
    assert got == brute_matches(docs, items) and got
    rng = random.Random(21)
    more = {}
    for d in range(150):
        k = rng.choice(sorted(items))
        w = items[k].split()
        for _ in range(len(w) // 5 + rng.choice([-1, 0, 0, 1])):
            at = rng.randrange(len(w))
            w[at : at + 1] = rng.choice([[], ["other"], ["new", w[at]]])
        more[d] = " ".join(docs[rng.choice(sorted(docs))].split()[:60] + w + docs[rng.choice(sorted(docs))].split()[:60])
    rows = decontaminate.contaminated(spark.createDataFrame(list(more.items()), "doc_id long, text string"), spark.read.parquet(f"{sf}/benchmark.parquet")).collect()
    want = brute_matches(more, items)
    found = {(r["doc_id"], r["item_id"]): r["edits"] for r in rows}
    assert set(found) == set(want) and all(found[x] == want[x][0] for x in want)


def test_pipeline(spark, sf):
    """Each stage against brute force, on rows with odd values and with columns named like those that the operators add."""
    import corpus_pipeline as P

    plain = spark.read.parquet(f"{sf}/documents.parquet")
    odd = spark.createDataFrame([(10**6, None, None, None, None), (10**6 + 1, "1 2 3", "en", "s", 5), (None, "words of no document", None, "s", 1)], plain.schema)
    clash = ["score", "n_words", "Removed", "removed_words", "lang_pred", "component_id"]
    docs = plain.unionByName(odd)
    docs = docs.select("*", *[F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(c) for c in clash])
    at, tables = docs, []
    for _, stage in P.STAGES[:-1]:
        at = common.written(stage(spark, at, sf), "test")
        assert at.schema.names == docs.schema.names and at.dtypes == docs.dtypes
        tables.append({r["doc_id"]: r for r in at.collect()})
        assert all(r[c] == f"{c} of {'none' if i is None else i}" for i, r in tables[-1].items() for c in clash)
    start = {r["doc_id"]: r["text"] for r in docs.collect()}
    language, jaccard, substring, clean = ({i: r["text"] for i, r in t.items()} for t in tables)
    assert language == {i: t for i, t in start.items() if t and any(c.isalpha() for c in t)}
    want = brute_jaccard({i: t for i, t in language.items() if i is not None})
    assert jaccard == {i: t for i, t in language.items() if i is None or want[i][1] == i}
    cut = brute_substrings(list(jaccard.items()))
    left = {i: [x for x, gone in zip(*cut[i, t], strict=True) if not gone] for i, t in jaccard.items() if i is not None}
    assert {i: units(t) for i, t in substring.items() if i is not None} == {i: w for i, w in left.items() if w} and substring[None] == jaccard[None]
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    dirty = {i for i, _ in brute_matches({i: t for i, t in substring.items() if i is not None}, items)}
    assert clean == {i: t for i, t in substring.items() if i not in dirty}
    assert all(r["n_chars"] == len(r["text"]) for r in tables[-1].values() if r["text"] != start[r["doc_id"]])
    out = P.STAGES[-1][1](spark, at, sf).collect()
    assert {r["doc_id"] for r in out} == set(clean)
    whole = P.run(spark, sf).collect()
    assert sorted(r["ids_sha256"] for r in whole) == sorted(r["ids_sha256"] for r in out if r["doc_id"] is not None)
