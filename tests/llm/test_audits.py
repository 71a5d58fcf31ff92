"""Source divergence, chat formatting and hard negatives against plain versions."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ratingloom.llm import chat, divergence, negatives

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# --- divergence ---------------------------------------------------------------------------


def brute_audit(rows, least, top=10):
    held, docs = Counter(), {}
    groups = set()
    for lang, source, text in rows:
        lang, source, words = lang or "", source or "", TERM.findall(low(text))
        groups.add((lang, source))
        for w in words:
            held[lang, source, w] += 1
        for w in set(words):
            docs[lang, w] = docs.get((lang, w), 0) + 1
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [w for (at, w), n in docs.items() if at == lang and n >= least]
        sources = [s for at, s in groups if at == lang]

        def shares(names, lang=lang, kept=kept):
            count = {w: sum(held[lang, s, w] for s in names) for w in kept}
            total = sum(count.values())
            return count, {w: 1 + 10**9 * (count[w] + 2) // (total + 2 * len(kept)) for w in kept}

        of = {s: shares([s]) for s in sources}
        every = shares(sources)[1]
        for s in sources:
            p = of[s][1]
            pairs = [(o, sum((p[w] - of[o][1][w]) ** 2 // (p[w] + of[o][1][w]) for w in kept)) for o in sources if o != s]
            terms = [(w, (p[w] - every[w]) ** 2 // (p[w] + every[w])) for w in kept if of[s][0][w] and p[w] > every[w]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out |= {(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(ranked)}
    return out


def audited(spark, rows, least):
    docs = spark.createDataFrame([(i, *r, 1, "x") for i, r in enumerate(rows)], "doc_id long, lang string, source string, text string, _p int, t string")
    found = [tuple(r) for r in divergence.audit_sources(docs, least).collect()]
    assert len(found) == len(set(found))
    return set(found)


def corpus(seed, n):
    r = random.Random(seed)
    words = [f"{'pre' * r.randrange(3)}{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)]
    words += ["averyveryverylongwordthatgoesonandon", "averyveryverylongwordthatgoesonandin", "éclair", "ÉCLAIR", "straße", "a" * 70, "a" * 71]
    rows = []
    for k in range(n):
        source = "s0" if r.random() < 0.4 else f"s{r.randrange(6)}"
        text = " ".join(r.choice(words) if r.random() < 0.8 else words[k % 5].upper() for _ in range(r.randrange(40)))
        rows.append((r.choice(["en", "en", "de", None]), source, text + f" rare{chr(97 + k % 26) * 3}"))
    return rows + [("en", None, None), ("fr", "only", ""), ("fr", "other", "12 34"), ("xx", "s", "one"), rows[0], rows[0]]


@pytest.mark.parametrize(("terms", "sources", "first"), [(4096, 128, 3), (5, 2, 1)])
def test_audit_equals_plain_version(spark, monkeypatch, terms, sources, first):
    monkeypatch.setattr(divergence, "BLOCK_TERMS", terms)
    monkeypatch.setattr(divergence, "BLOCK_SOURCES", sources)
    monkeypatch.setattr(divergence, "FIRST_BYTES", first)
    rows = corpus(terms, 150)
    assert audited(spark, rows, 4) == brute_audit(rows, 4)


def test_audit_without_broadcasts_is_the_same(spark, monkeypatch):
    rows = corpus(3, 90)
    monkeypatch.setattr(divergence, "fits_broadcast", lambda df: False)
    monkeypatch.setattr(divergence, "bounded_broadcast", lambda df: df)
    assert audited(spark, rows, 5) == brute_audit(rows, 5)


def test_terms_lie_flat_and_by_group(spark, monkeypatch):
    """A task that adds up occurrences meets few groups, and reads no column that it does not need."""
    staged, write = {}, divergence.stage

    def kept(df, name):
        staged[name] = write(df, name)
        return staged[name]

    monkeypatch.setattr(divergence, "stage", kept)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        audited(spark, corpus(7, 400), 5)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    kinds = dict(staged["terms"].dtypes)
    assert not any(kind.startswith(("array", "struct")) for kind in kinds.values())
    parts = staged["terms"].select(F.input_file_name().alias("file"), "_g").distinct().collect()
    files, groups = len({r["file"] for r in parts}), len({r["_g"] for r in parts})
    assert files > 2 and groups > 8
    assert len(parts) <= groups + files  # files of rows in any order hold nearly all groups each


def test_audit_of_few_rows(spark):
    assert audited(spark, [], 10) == set()
    rows = [("en", "a", "x y"), ("en", "b", None), ("en", "c", "x")]
    assert audited(spark, rows, 10) == brute_audit(rows, 10) != set()  # pairs of value 0


def test_shares_of_huge_counts_are_exact(spark):
    row = spark.createDataFrame([(9 * 10**17, 3 * 10**18, 10**9)], "n long, t long, v long")
    assert row.select(divergence._share("n", "t", "v")).first()[0] == 1 + 10**9 * (9 * 10**17 + 2) // (3 * 10**18 + 2 * 10**9)


def test_terms_know_what_they_share():
    terms = [b"a", b"ab", b"abc", b"b", b"a" * 40, b"a" * 40 + b"b", b"abc"]
    heads, shared = divergence.term_heads(pa.array(terms, pa.binary()), np.array([0, 6]))
    assert shared.tolist() == [0, 1, 2, 0, 0, 40, 0]
    assert heads.tolist() == [int.from_bytes(x[:8].ljust(8, b"\0"), "big", signed=True) for x in terms]


# --- chat -------------------------------------------------------------------------------------

TEXTS = st.lists(st.sampled_from(["\\", "</turn>", "### user: ", "### Assistant: ", "###", " ", ": ", "\n", "</tu", "rn>", "a", "é", "#"]), max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "", "a b: c\n", "é%"]), TEXTS), max_size=5))
def test_conversations_come_back(turns):
    whole = "".join(chat.render_turn(*t)[0] for t in turns)
    assert [(role, chat.unescaped(whole[a:b])) for role, a, b in chat.parse_turns(whole)] == turns


def test_text_without_conflict_stays_as_it_is():
    for text in ("", "plain", "a \\ b", "# heading", "### heading", "</turn"):
        assert text in chat.render_turn("user", text)[0]
    assert chat.render_turn("user", "x</turn>")[0] == "### user: x\\</turn>\n</turn>\n"


@pytest.mark.parametrize("text", ["x", "### user: ", "### user: a", "### user: a</turn>\n", "### user: a\n</turn>", "### user: ### b: c\n</turn>\n"])
def test_other_texts_are_no_conversations(text):
    assert chat.parse_turns(text) is None


def brute_chat(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv))
        learnt = "".join(x for *_, r, x in own if r == "assistant")
        all_ = "".join(f"{r}\n{x}\n" for *_, r, x in own)
        out[conv] = (len(own), hashlib.sha256(all_.encode()).hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    return out


@pytest.mark.parametrize("piece_chars", [1_000_000, 60])
def test_conversations_of_odd_rows(spark, piece_chars):
    r = random.Random(1)
    parts = ["</turn>", "\\### assistant: ", "hello ", "\n", "ç", "x" * 30]
    rows = [
        (c, t, r.choice(["user", "assistant", "system", None]), "".join(r.choice(parts) for _ in range(r.randrange(6))))
        for c in (1, 2, 3, None)
        for t in range(r.randrange(1, 30))
    ]
    rows += [(7, 0, "assistant", None), (8, None, "user", "a"), (8, 1, "assistant", "b"), (8, 1, "assistant", "b"), (9, 0, "assistant", "y" * 300_000)]
    frame = spark.createDataFrame([(*row, 5, "z") for row in rows], "conv_id long, turn long, role string, text string, piece int, loss string")
    made = chat.format_conversations(frame, piece_chars)
    pieces = made.collect()
    for p in pieces:
        assert len(chat.parse_turns(p["text"])) == p["n_turns"]
        bodies = [(a, b) for role, a, b in chat.parse_turns(p["text"]) if role == "assistant"]
        assert bodies == [(s["start"], s["end"]) for s in p["loss"]]
    for conv in {p["conv_id"] for p in pieces}:
        own = sorted((p for p in pieces if p["conv_id"] == conv), key=lambda p: p["piece"])
        assert [p["piece"] for p in own] == list(range(len(own)))
        assert [p["start"] for p in own] == [sum(len(o["text"]) for o in own[:k]) for k in range(len(own))]
    assert (len(pieces) > 10) == (piece_chars == 60)
    digest = {d["conv_id"]: d for d in chat.chat_digest(made).collect()}
    found = {c: (d["n_turns"], d["turns_sha256"], d["loss_chars"], d["loss_sha256"]) for c, d in digest.items()}
    assert found == brute_chat(rows)
    assert all(d["formatted_chars"] == sum(len(p["text"]) for p in pieces if p["conv_id"] == c) for c, d in digest.items())
    assert chat.chat_digest(chat.format_conversations(frame.limit(0))).count() == 0


# --- negatives --------------------------------------------------------------------------------


def brute_mining(rows, rule=negatives.Mining()):  # noqa: B008
    used = [(i, y, v) for i, y, v in rows if y is not None and v is not None and None not in v]
    wide = max((len(v) for *_, v in used), default=0)
    vectors = [list(v) + [0] * (wide - len(v)) for *_, v in used]
    big = 2**63 - 1
    out = []
    for a, (i, y, _) in enumerate(used):
        if i is None or i % 100:
            continue
        scored = [(-sum(p * q for p, q in zip(vectors[a], v, strict=True)), used[b][0] if used[b][0] is not None else big, b) for b, v in enumerate(vectors)]
        positives = sorted(s[:2] for s in scored if s[2] != a and used[s[2]][1] == y)[: rule.positives]
        others = sorted(s[:2] for s in scored if used[s[2]][1] != y)
        for k, (p, j) in enumerate(positives):
            fits = [(s, n) for s, n in others if rule.low * -p <= 100 * -s <= rule.high * -p][: rule.negatives]
            out += [(i, j, k + 1, r + 1, n, -p, -s) for r, (s, n) in enumerate(fits)]
    return sorted(out)


def mined(spark, rows, **options):
    frame = spark.createDataFrame([(*r, 1, "b") for r in rows], "vec_id long, label int, vector array<bigint>, _a int, _rank string")
    found = negatives.mine_negatives(frame, (negatives.F.col("vec_id") % 100 == 0), **options).collect()
    big = 2**63 - 1
    return sorted(tuple(big if x is None else x for x in r) for r in found)


def vectors(seed, n, d, labels=4, scale=100):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(12, d))
    rows = [(i, int(r.integers(labels)), [int(x) for x in scale * (centres[i % 12] * (i % 3 > 0) + r.normal(size=d))]) for i in range(n)]
    return rows


def test_mining_equals_all_pairs(spark):
    rows = vectors(1, 900, 24) + vectors(2, 120, 24)  # ids that repeat, some of them anchors
    rows += [rows[0], rows[100], rows[100], (5, None, [1]), (6, 1, None), (7, 1, [1, None]), (1000, 1, []), (1100, 9, [3, 4]), (1200, 2, [0] * 24), (None, 2, [50] * 24)]
    expected = brute_mining(rows)
    assert mined(spark, rows) == expected and len(expected) > 100


def test_mining_in_small_blocks_and_other_levels(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_ANCHORS", 3)
    rows = vectors(3, 700, 9, labels=2)
    rule = negatives.Mining(3, 2, 50, 90)
    expected = brute_mining(rows, rule)
    assert mined(spark, rows, rule=rule, positive_levels=(0.9, -1.0), window_levels=(1.0,)) == expected
    assert mined(spark, rows, rule=rule, positive_levels=(0.99, 0.5, 0.2, -1.0), window_levels=(0.05, 0.3, 1.0)) == expected


def test_mining_of_copies_and_few_rows(spark):
    copies = [(i, i % 2, [7, 1, 3]) for i in range(400)]
    assert mined(spark, copies) == brute_mining(copies)
    assert mined(spark, []) == [] and mined(spark, [(1, 0, [1]), (2, 1, [2])]) == []
    assert mined(spark, [(0, 0, [1]), (2, 1, [2])]) == []


@pytest.mark.parametrize("size", [100, 2**22, 2**40])
def test_pairs_above_a_threshold(size):
    r = np.random.default_rng(4)
    q, x = (r.integers(-size, size, (n, 40)) * (r.random(40) ** 3 + 1 / size) for n in (70, 300))
    q, x = q.astype(np.int64), x.astype(np.int64)
    scores = q.astype(object) @ x.astype(object).T
    for share in (0.9, 0.3, 0.05, 0, -1):
        least = np.array([int(share * int(s)) for s in scores.max(axis=1)], np.int64) if size < 2**30 else np.full(70, int(share * 2**60), np.int64)
        i, j, s = negatives.above(q, least, x)
        at = np.nonzero(scores >= least.astype(object)[:, None])
        assert sorted(zip(i, j, strict=True)) == sorted(zip(*at, strict=True))
        assert all(min(max(scores[a, b], -(2**63 - 1)), 2**63 - 1) == c for a, b, c in zip(i, j, s, strict=True))
