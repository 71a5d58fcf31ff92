"""Deduplication, joins, decontamination, licences, filters and packing against plain versions."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pandas as pd
import pytest

from ratingloom.llm import contamination, exact, jaccard, licences, packing, urls
from ratingloom.llm.common import code_points, word_hashes
from ratingloom.llm.components import components

SCHEMA = "doc_id long, text string, keep_id string, _n int, _sha string"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "k", 1, "s") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_cuckoo_index_inserts_deletes_and_grows():
    index, live, r = exact.CuckooIndex(2), {}, random.Random(1)
    for n in range(6000):
        digest = hashlib.sha256(str(r.randrange(900)).encode()).digest()
        if r.random() < 0.4:
            assert index.remove(digest) == (live.pop(digest, None) is not None)
        else:
            live[digest] = n
            index.put(digest, n)
        assert index.get(digest) == live.get(digest)
    assert dict(index.items()) == live and index.size == len(live) and index.mask > 1


def test_copies_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "a"), (5, "a"), (4, "a"), (None, "b"), (7, "b"), (8, "x" * 200_000), (9, "c"), (9, "c"), (None, "d")]
    docs = frame(spark, rows)
    found = {(r["doc_id"], r["text_sha256"]): r for r in exact.mark_copies(docs).collect()}
    sha = {t: hashlib.sha256((t or "").encode()).hexdigest() for _, t in rows}
    for i, t in rows:
        own = [j for j, u in rows if (u or "") == (t or "")]
        keep = max((j for j in own if j is not None), default=None)
        row = found[(i, sha[t])]
        assert (row["keep_id"], row["group_size"], row["kept"]) == (keep, len(own), i == keep)
    kept = exact.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r["text"] or "") for r in kept.collect()) == sorted({t or "" for _, t in rows})
    assert exact.mark_copies(docs.limit(0)).count() == 0


def test_groups_lose_withdrawn_digests(spark):
    def rows(pairs):
        return spark.createDataFrame([(bytes([s]) * 32, i) for s, i in pairs], "_sha binary, _id long")

    groups = exact.digest_groups(rows([(1, 5), (1, 6), (2, 7)]))
    after = exact.update_groups(groups, exact.digest_groups(rows([(2, 9), (3, 4)])), rows([(1, 0)]).select("_sha"))
    found = {bytes(r["_sha"])[0]: (r["_top"], r["_n"]) for r in after.collect()}
    assert found == {2: (9, 2), 3: (4, 1)}


def test_components_of_random_graphs(spark):
    r = random.Random(2)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(400 + i, 401 + i) for i in range(40)] + [(500, 500)]
    parent = {n: n for e in edges for n in e}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    found = {x["node"]: x["component"] for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {n: root(n) for a, b in edges if a != b for n in (a, b)}


def brute_join(rows):
    sets = []
    for i, t in rows:
        w = [x for x in re.split("[ \t-\r]+", low(t)) if x]
        sets.append((i, frozenset([tuple(w)] if 0 < len(w) < 4 else [tuple(w[k : k + 4]) for k in range(len(w) - 3)])))
    parent = list(range(len(sets)))

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, (_, x) in enumerate(sets):
        for b in range(a):
            y = sets[b][1]
            common = len(x & y)
            if x and y and 100 * common >= 85 * (len(x) + len(y) - common):
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    least = {}
    for n, (i, _) in enumerate(sets):
        if i is not None:
            least[root(n)] = min(least.get(root(n), i), i)
    return sorted((i, len(s), least.get(root(n))) for n, (i, s) in enumerate(sets) if i is not None)


def near_copies(r, n, size, edits, first):
    base = [f"w{first}x{r.randrange(10**6)}" for _ in range(size)]
    out = []
    for k in range(n):
        words = list(base)
        for _ in range(r.randrange(edits + 1)):
            words[r.randrange(size)] = f"e{r.randrange(10**6)}"
        out.append((first + k, " ".join(words)))
    return out


def test_join_equals_all_pairs(spark, monkeypatch):
    r = random.Random(3)
    rows = near_copies(r, 120, 90, 4, 1000) + near_copies(r, 40, 12, 1, 2000) + near_copies(r, 30, 400, 30, 3000)
    shared = " ".join(f"passage{i}" for i in range(60))
    rows += [(4000 + i, shared + " " + " ".join(f"u{r.randrange(10**6)}" for _ in range(r.randrange(5, 60)))) for i in range(60)]
    rows += [(1, None), (2, ""), (3, " \t\r"), (4, "One two"), (5, "one  two"), (6, "one two three"), (7, "A b C d"), (8, "a B c D"), (9, rows[0][1])]
    docs = frame(spark, rows)
    found = sorted((x["doc_id"], x["n_shingles"], x["component_id"]) for x in jaccard.join_similar(docs).collect())
    assert found == brute_join(rows)
    monkeypatch.setattr(jaccard, "BLOCK_TOKENS", 3000)  # clusters then span several blocks
    again = sorted((x["doc_id"], x["n_shingles"], x["component_id"]) for x in jaccard.join_similar(docs).collect())
    assert again == found
    kept = jaccard.drop_similar(docs)
    assert kept.columns == docs.columns
    assert sorted(x["doc_id"] for x in kept.collect()) == sorted({c for _, _, c in found})
    assert jaccard.join_similar(docs.limit(0)).count() == 0


def test_words_of_the_same_characters_have_their_own_hashes():
    words = [f"{n:06d}" for n in range(10**6)] + ["otto", "toot", "1001", "0110", "2112", "1221", "a\U0001f600", "\U0001f600a"]
    codes, _ = code_points(words)
    _, _, h = word_hashes(codes, codes != 10)
    assert len(np.unique(h)) == len(h) == len(words)


def test_join_tells_numbers_and_permuted_words_apart(spark):
    r = random.Random(8)
    rows = [(1, "otto 1001 2112 a b"), (2, "toot 0110 1221 a b"), (3, "1001 x y z 0110 x y z 1001"), (4, "0110 x y z 1001 x y z 0110")]
    for k in range(60):
        words = [f"{r.randrange(10**6):06d}" for _ in range(60)]
        rows.append((100 + 2 * k, " ".join(words)))
        rows.append((101 + 2 * k, " ".join(w[::-1] if n % 20 == 7 else w for n, w in enumerate(words))))
    pairs = [("otto", "toot"), ("1001", "0110"), ("2112", "1221")]
    for k in range(20):
        some = [r.choice(pairs) for _ in range(40)]
        rows += [(300 + 2 * k, " ".join(a for a, _ in some)), (301 + 2 * k, " ".join(b for _, b in some))]
    docs = frame(spark, rows)
    found = sorted((x["doc_id"], x["n_shingles"], x["component_id"]) for x in jaccard.join_similar(docs).collect())
    assert found == brute_join(rows)


def test_links_count_once_where_a_side_is_empty(spark, monkeypatch):
    r = random.Random(9)
    rows = near_copies(r, 2, 400, 0, 5000)
    rows[1] = (rows[1][0], rows[1][1] + " more")
    monkeypatch.setattr(jaccard, "BLOCK_TOKENS", 100)  # two documents on eight sides
    found = jaccard.join_similar(frame(spark, rows)).collect()
    assert [x["n_links"] for x in found] == [1, 1]


def test_chance_passages_send_no_whole_sets(spark, monkeypatch):
    r = random.Random(11)
    words = [[f"{r.randrange(10**6):06d}" for _ in range(r.choice((60, 90, 140)))] for _ in range(80)]
    for one, two in zip(words, words[1:], strict=False):  # prefixes connect them, nothing is linked
        two[:30] = one[-30:]
    rows = [(i, " ".join(w)) for i, w in enumerate(words)]
    rows += [(100 + i, rows[i][1] + " more") for i in (3, 40)]
    seen = []

    def recorded(df, name, staged=jaccard.stage, **how):
        seen.append((name, staged(df, name, **how)))
        return seen[-1][1]

    monkeypatch.setattr(jaccard, "stage", recorded)
    monkeypatch.setattr(jaccard, "BLOCK_TOKENS", 300)
    found = jaccard.join_similar(frame(spark, rows)).collect()
    assert sorted((x["doc_id"], x["n_shingles"], x["component_id"]) for x in found) == brute_join(rows)
    assert {x["doc_id"]: x["n_links"] for x in found if x["n_links"]} == {3: 1, 103: 1, 40: 1, 140: 1}
    clusters = [df for name, df in seen if name == "clusters"][-1]
    assert clusters.count() > 50
    whole = [df for name, df in seen if name == "blocks"][-1]
    assert whole.count() < clusters.count()  # once each at most, whatever the clusters' size


def test_bands_part_no_sizes_that_a_rule_links(spark):
    for percent in (0, 1, 50, 85, 99, 100):
        rule = jaccard.Rule(percent=percent)
        band = dict(spark.range(1, 3000).select("id", rule.band(jaccard.F.col("id"))).collect())
        for a in range(1, 3000, 7):
            most = max(b for b in range(a, 3000) if rule.sizes(a, b))
            assert abs(band[most] - band[a]) <= 1


def test_join_with_very_many_copies_of_a_row(spark):
    r = random.Random(10)
    text = " ".join(f"w{i}" for i in range(30))
    near = text.replace("w0 ", "changed ")
    rows = [(5, text)] * 500 + [(9, text)] * 40 + [(7, near)] * 300 + [(None, text)] * 20 + [(8, "a b c d e f g h")] * 50
    rows += near_copies(r, 20, 40, 1, 100)
    found = jaccard.join_similar(frame(spark, rows)).collect()
    assert sorted((x["doc_id"], x["n_shingles"], x["component_id"]) for x in found if x["doc_id"] is not None) == brute_join(rows)
    assert {x["n_links"] for x in found if x["doc_id"] in (5, 7, 9)} == {1}
    assert len(jaccard.drop_similar(frame(spark, rows)).filter("doc_id = 5").collect()) == 500


def test_links_of_very_many_short_sets_take_seconds():
    n = 170_000
    r = np.random.default_rng(1)
    tokens = r.integers(0, 1 << 60, (n, 12))
    tokens[1::2, 1:] = tokens[::2, 1:]  # 11 of 13 tokens are shared: 84.6 percent
    tokens[3::4, 0] = tokens[2::4, 0]
    block = pd.DataFrame({"_key": np.arange(n), "_side": 0, "_n": 12, "_i": 0, "_j": 0, "_tokens": list(np.sort(tokens, axis=1))})
    for k in range(2):
        block[f"_p{k}"] = [t[k : k + 3] for t in block["_tokens"]]
    began = time.process_time()
    found = jaccard.verified(block, jaccard.Rule())
    assert time.process_time() - began < 60
    assert {(a, b) for a, b, c in found if a != b} == {(i + 1, i) for i in range(2, n, 4)}


def brute_contamination(texts, items):
    windows = {}
    for i, t in items:
        w = WORD.findall(low(t))
        m = min(10, len(w))
        for k in range(len(w) - m + 1 if m else 0):
            windows.setdefault(tuple(w[k : k + m]), set()).add(str(i))
    out = []
    for t in texts:
        w, hit, ids = WORD.findall(low(t)), set(), set()
        for m in {len(k) for k in windows}:
            for k in range(len(w) - m + 1):
                if tuple(w[k : k + m]) in windows:
                    hit |= set(range(k, k + m))
                    ids |= windows[tuple(w[k : k + m])]
        out.append((len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("small", [True, False])
def test_contamination_equals_a_plain_scan(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(contamination, "fits_broadcast", lambda df, limit=0: False)
    r = random.Random(4)
    vocabulary = [f"v{i}" for i in range(12)]
    items = [(i, " ".join(r.choices(vocabulary, k=n))) for i, n in enumerate([0, 1, 3, 9, 10, 11, 14, 30])] + [(90, None), (91, "Ä-ö 1")]
    items[1] = (1, "lonely")
    texts = [None, "", "LONELY", "x" * 50_000, "ä ö 1"] + [" ".join(r.choices(vocabulary, k=r.randrange(1, 80))) for _ in range(40)]
    texts += [f"a, {items[k][1].upper()}. b {items[7][1]} c" for k in (3, 4, 5, 6)]
    docs = frame(spark, list(enumerate(texts)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = contamination.contamination_digest(contamination.find_contamination(docs, bench)).orderBy("doc_id").collect()
    expected = brute_contamination(texts, items)
    assert [(x["n_words"], x["n_hit"], x["n_items"], x["items_sha256"]) for x in found] == expected
    clean = contamination.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns and clean.count() == sum(e[1] == 0 for e in expected)
    cut = contamination.cut_contamination(docs, bench).orderBy("doc_id").collect()
    assert [len(WORD.findall(x["text"] or "")) for x in cut] == [e[0] - e[1] for e in expected]
    none = contamination.find_contamination(docs, bench.limit(0))
    assert none.filter("size(spans) > 0").count() == 0 and none.count() == len(texts)


def test_automaton_matches_are_longest():
    r = random.Random(5)
    sequences = [[b"abcd"[r.randrange(4) :][:1] for _ in range(n)] for n in (30, 12, 25)]
    automaton = licences.SuffixAutomaton()
    for i, s in enumerate(sequences):
        automaton.add(i, s)
    text = [b"abcde"[r.randrange(5) :][:1] for _ in range(400)]
    factors = {tuple(s[i:j]): set() for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    found = {(end, size) for end, size, _ in automaton.matches(text, 2)}
    expected, before = set(), 0
    longest = [max((n for n in range(e + 1) if not n or tuple(text[e - n : e]) in factors), default=0) for e in range(len(text) + 1)]
    for e in range(len(text) + 1):
        grows = e < len(text) and longest[e + 1] == longest[e] + 1
        if longest[e] >= 2 and not grows:
            expected.add((e, longest[e]))
    assert found == expected and before == 0


def test_licences_of_odd_rows(spark):
    texts = [None, "", "CC BY cc-by ccby", "All rights reserved. ALL RIGHTS\nreserved", "x " * 60_000 + "GNU general Public License",
             "Licensed under the Apache License, Version 2.0.", "apache of the license", "all all rights reserved"]
    found = licences.licence_digest(licences.scan_licences(frame(spark, list(enumerate(texts))))).orderBy("doc_id").collect()
    for row, text in zip(found, texts):
        w = WORD.findall(low(text))
        at = [(i, k) for p, k in licences.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        starts = [i for i, _ in at]
        assert (row["n_words"], row["n_base"]) == (len(w), len(at))
        assert (row["first_word"], row["last_word"]) == (min(starts, default=None), max(starts, default=None))
        assert row["base_labels"] == ",".join(sorted({k for _, k in at}))
        assert set(row["base_labels"].split(",")) - {""} <= set(row["labels"].split(","))
    assert found[5]["labels"] == "apache-2.0" and found[6]["labels"] == ""


def test_cascade_is_exact_over_its_keys():
    r = np.random.default_rng(6)
    keys = np.unique(r.integers(0, 1 << 64, 20_000, dtype=np.uint64))
    listed = r.random(len(keys)) < 0.3
    levels = urls.build_cascade(keys, listed)
    assert len(levels) > 2 and (urls.ask_cascade(levels, keys) == listed).all()
    assert urls.build_cascade(keys, np.zeros(len(keys), bool)) == []


def test_urls_of_odd_rows(spark, monkeypatch):
    rows = [(1, None), (2, ""), (3, "no scheme/net/"), (4, "http://X.NET"), (5, "http://X.net/"), (6, "https://a.Example.net/en/q?x#y"),
            (7, "ftp://example.com/de/?a"), (8, "x://y://org/fr/"), (9, "http://org/fr/1"), (10, "http://my-casino.io?/fr/"),
            (11, "http://casinos.io#x"), (12, "http://notexample.net/en/")]
    pages = spark.createDataFrame([(i, u, "h", "v") for i, u in rows], "page_id long, url string, host string, verdict string")

    def found():
        return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge_urls(pages).collect()}

    once = found()
    assert once == {
        1: ("", "", None, "allow"), 2: ("", "", None, "allow"), 3: ("", "", None, "allow"), 4: ("x.net", "", None, "allow"),
        5: ("x.net", "/", "net/", "block"), 6: ("a.example.net", "/en/q", "example.net/en/", "allow"),
        7: ("example.com", "/de/", "example.com/de/", "block"), 8: ("y:", "//org/fr/", None, "allow"), 9: ("org", "/fr/1", "org/fr/", "allow"),
        10: ("my-casino.io", "", None, "block"), 11: ("casinos.io", "", None, "allow"), 12: ("notexample.net", "/en/", "net/", "block"),
    }
    monkeypatch.setattr(urls, "SHARD_HOSTS", 2)
    monkeypatch.setattr(urls, "MOST_BYTES", 1)
    assert {r["page_id"] for r in urls.judge_urls(pages, most_bytes=1).collect()} == set(once)
    assert {r["page_id"]: r["verdict"] for r in urls.judge_urls(pages, most_bytes=1).collect()} == {k: v[3] for k, v in once.items()}


def _ids(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def test_packing_is_whole_and_tight(spark, documents):
    odd = [(-1, None), (-2, ""), (-3, "a\n\n  b\t\tdon't <|endoftext|> ½ 漢字 \x1c é"), (-4, "word " * 5000), (-4, "word " * 5000), (None, "x")]
    docs = documents.select("doc_id", "text").limit(150).unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    texts = {}
    for row in docs.collect():
        texts.setdefault(row["doc_id"], []).append(row["text"])
    pieces = packing.pack_documents(docs).collect()
    ids = {i: _ids(t[0]) for i, t in texts.items()}
    found, places = {}, {}
    for p in pieces:
        own = np.array(ids[p["doc_id"]][p["start"] : p["start"] + p["length"]], "<u4")
        assert zlib.crc32(own.tobytes()) == p["ids_crc32"] and 0 < p["length"] <= 1024 and len(own) == p["length"]
        found.setdefault(p["doc_id"], []).append((p["piece"], p["start"], p["length"]))
        places.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for i, many in texts.items():
        assert sum(n for _, _, n in found[i]) == len(many) * len(ids[i])
        assert all(n == 1024 for k, _, n in found[i] if k > 0)
    for spans in places.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= 1024
    total = sum(n for spans in places.values() for _, n in spans)
    assert len(places) <= -(-total // 1024) * 1.02 + 1
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_fullest_equals_all_choices():
    r = random.Random(7)
    for _ in range(60):
        counts = np.zeros(41, np.int64)
        for _ in range(5):
            counts[r.randrange(1, 30)] += r.randrange(1, 3)
        room = r.randrange(1, 41)
        sums = {0}
        for length in np.flatnonzero(counts):
            for _ in range(counts[length]):
                sums |= {s + int(length) for s in sums}
        chosen = packing.fullest(counts, room)
        assert sum(k * v for k, v in chosen.items()) == max(s for s in sums if s <= room)
        assert all(v <= counts[k] for k, v in chosen.items())


DISCLAIMER = (
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed "
    "on an as is basis without warranties or conditions of any kind either express or implied"
)


@pytest.mark.parametrize("stray", ["under the license", "of any", "the license", "software software of any kind"])
def test_stray_matches_do_not_cut_a_licence(stray):
    scanner = licences.LicenceScanner({"apache": [DISCLAIMER]})
    words = DISCLAIMER.split()
    for at in range(2, len(words) - 2, 3):
        text = " ".join([*words[:at], stray, *words[at:]])
        found = scanner.spans(licences.words_of(f"before it {text} behind it"))
        assert [(a, b) for a, b, _, _ in found] == [(2, 2 + len(text.split()))], text
        assert found[0][3] > 0.9


def test_best_chains_equal_all_chains():
    r = random.Random(12)
    scanner = licences.LicenceScanner({"x": ["a"]}, gap=3)
    for _ in range(200):
        places = []
        for _ in range(r.randrange(1, 9)):
            size, end, stop = r.randrange(1, 5), r.randrange(5, 20), r.randrange(5, 14)
            places.append((end - size, end, stop - size, stop))
        places.sort(key=lambda p: p[1])

        def best(k, places=places):
            a, b, c, d = places[k]
            covered = [b - a]
            for j in range(k):
                e, f, g, h = places[j]
                if a - f <= 3 and e < a and f < b and g < c and h < d:
                    covered.append(best(j) + b - a - max(0, h - c, f - a))
            return max(covered)

        assert [c for c, _, _ in scanner.chains(places)] == [best(k) for k in range(len(places))]


def test_every_place_of_a_repeated_phrase_counts():
    template = "the software is given as it is and the software may be used by all who like the software"
    scanner = licences.LicenceScanner({"x": [template]}, coverage=0.9)
    assert [s[3] for s in scanner.spans(licences.words_of(template))] == [1.0]
    ends = scanner.automaton.ends
    assert max(len(v) for d in ends for v in d.values()) == 3
