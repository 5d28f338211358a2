"""Spelling variants, collocations and source mixing against plain Python."""

import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.llm import collocations, mixing, spelling

ALPHABET = "abcdeé"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- spelling variants

def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


@settings(max_examples=300, deadline=None)
@given(st.text(ALPHABET, min_size=2, max_size=12), st.integers(0, 12), st.sampled_from(ALPHABET),
       st.sampled_from(["replace", "insert"]))
def test_words_one_letter_apart_meet(word, at, letter, edit):
    at %= len(word) + (edit == "insert")
    other = word[:at] + letter + word[at + (edit == "replace"):]
    if other == word:
        return
    left = {s for s, on_left, _ in spelling.signatures(word) if on_left}
    right = {s for s, _, on_right in spelling.signatures(other) if on_right}
    assert left & right


def brute_words(rows):
    n = Counter()
    for doc, text in rows:
        plain = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        runs, run = [], ""
        for c in plain + " ":
            if "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c
            elif run:
                runs.append(run)
                run = ""
        for run in runs:
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                n[run] += 1
    return {w: k for w, k in n.items() if k >= 2}


def brute_variants(n):
    without = defaultdict(set)
    for w in n:
        without[w].add(w)
        for i in range(len(w)):
            without[w[:i] + w[i + 1:]].add(w)
    near = {w: {v for i in range(len(w)) for v in without[w[:i] + w[i + 1:]]} | without[w]
            for w in n}
    form = {}
    for w in n:
        near[w] = [v for v in near[w] if one_edit(w, v)]
        if near[w]:
            best = min(near[w], key=lambda v: (-n[v], v))
            if n[best] >= 10 * n[w]:
                form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return sorted(out, key=repr)


def test_variants_of_documents(small, edge):
    for docs in (small, edge):
        rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        assert rows_of(spelling.spelling_variants(docs)) == brute_variants(brute_words(rows))


def test_variants_follow_chains_and_break_ties(spark):
    n = {"abcdefg": 2, "abcdefgh": 20, "abcdefghi": 200, "xbcdefgh": 20, "abcdefghij": 2500,
         "zzzzzzz": 5, "zzzzzzzz": 50, "azzzzzzz": 50, "zzzzzzy": 6}
    words = spark.createDataFrame(list(n.items()), "word string, n bigint")
    got = rows_of(spelling.group_variants(words))
    assert got == brute_variants(n)
    assert {w: r for w, _, r, *_ in got}["abcdefg"] == "abcdefghij"
    assert {w: f for w, f, *_ in got}["zzzzzzz"] == "azzzzzzz"


def test_variants_of_a_family_that_shares_a_signature(spark):
    rng = random.Random(5)
    family = {"common" + "".join(rng.choice("ab") for _ in range(9)): rng.randrange(2, 400)
              for _ in range(400)}
    words = spark.createDataFrame(list(family.items()), "word string, n bigint")
    assert rows_of(spelling.group_variants(words)) == brute_variants(family)


def test_empty_tables(empty):
    assert spelling.spelling_variants(empty).collect() == []
    assert collocations.collocations(empty).collect() == []
    assert mixing.mixed(empty).collect() == []


# --- collocations

def brute_collocations(rows, longest, least, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        plain = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for c in ".,;:!?\x0b\x0c\r":
            plain = plain.replace(c, "\n")
        for piece in plain.split("\n"):
            words = tuple(w for w in piece.replace("\t", " ").split(" ") if w)
            n[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, min(longest, len(words) - i) + 1):
                    f[lang, words[i:i + k]] += 1
    cands = {g: a for g, a in f.items() if a >= least and len(g[1]) > 1}
    covered = set()
    for (lang, g), a in cands.items():
        for i in range(len(g)):
            for j in range(i + 2, len(g) + 1):
                if j - i < len(g) and a >= f[lang, g[i:j]]:
                    covered.add((lang, g[i:j]))
    out = defaultdict(list)
    for (lang, g), a in cands.items():
        if (lang, g) not in covered:
            score, k = min((1000 * a * n[lang] // (f[lang, g[:k]] * f[lang, g[k:]]), k)
                           for k in range(1, len(g)))
            out[lang].append((-score, -a, " ".join(g).encode(), f[lang, g[:k]], f[lang, g[k:]]))
    return sorted(
        ((lang, rank, phrase.decode(), -a, left, right, n[lang], -score)
         for lang, found in out.items()
         for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1)), key=repr)


def speech(seed, pieces, words="a b A c the The of é x\x01 x \x00\x08 b\x02 ſ 日本".split(" ")):
    rng = random.Random(seed)
    return "".join(" ".join(rng.choices(words, [2 ** -(i % 6) for i in range(len(words))],
                                        k=rng.randrange(1, 9)))
                   + rng.choice([". ", ",", "\n", "\t", "  ", "\x0c", "!", "\x1c"])
                   for _ in range(pieces))


@pytest.mark.parametrize("least, block", [(2, 64), (7, 1 << 20), (300, 64)])
def test_collocations_against_counting(spark, monkeypatch, least, block):
    rows = [("en", speech(1, 400)), (None, speech(2, 300)), ("en", speech(3, 300)), ("de", None),
            ("de", "one two. " * 40), ("und", speech(4, 50)), ("fr", ""), ("es", " \t\n . "),
            *[("en", "rare words stand here, alone number " + str(i)) for i in range(40)]]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    real = collocations.phrase_counts
    monkeypatch.setattr(collocations, "phrase_counts", lambda *a: real(*a, block_words=block))
    got = rows_of(collocations.collocations(docs, least=least, top=50))
    assert got == brute_collocations(rows, 5, least, 50)


def test_collocation_scores_beyond_64_bits(spark, monkeypatch):
    # counts as of a large corpus, put in place of the counting
    a = 3 * 10**12
    counts = [("en", "", 0, 10**13), ("en", "a", 1, a), ("en", "b", 1, a + 7), ("en", "a\tb", 2, a - 1)]
    orders = spark.createDataFrame(counts, "lang string, gram string, size int, a bigint")
    monkeypatch.setattr(collocations, "phrase_counts", lambda *_: orders)
    (row,) = collocations.collocations(None).collect()
    assert row["score"] == 1000 * (a - 1) * 10**13 // (a * (a + 7)) and row["phrase"] == "a b"


def test_counters_too_few_change_no_result(spark):
    rows = [("en", speech(9, 200)), ("de", speech(10, 200))]
    docs = spark.createDataFrame(rows, "lang string, text string")
    plenty = rows_of(collocations.phrase_counts(docs, least=5))
    assert rows_of(collocations.phrase_counts(docs, least=5, slots=64)) == plenty


def test_windows_of_many_splits_are_counted_together(spark):
    texts = [" ".join(f"w{(i + k) % 40}" for k in range(60)) for i in range(320)]
    rows = [(i, t, "en") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(64)
    counted = collocations.count_windows(docs, 5, 100, 1 << 12).collect()
    distinct = len({(r["lang"], r["gram"]) for r in counted})
    assert len(counted) <= distinct * spark.sparkContext.defaultParallelism
    # every position begins one window
    assert sum(r["n"] for r in counted if r["gram"]) == sum(len(t.split()) for t in texts)


# --- source mixing

def brute_targets(size):
    weight = {s: i % 3 + 1 for i, s in enumerate(sorted(
        size, key=lambda s: (s is None, (s or "").encode())))}
    total, full = sum(size.values()), set()
    while True:
        left = total - 3 * sum(size[s] for s in full)
        shared = sum(weight[s] for s in size if s not in full)
        target = {s: 3 * size[s] if s in full else left * weight[s] / shared for s in size}
        over = {s for s in size if s not in full and target[s] > 3 * size[s]}
        if not over:
            return target
        full |= over


def brute_tilt(sizes, target):
    low, high = math.log(target / sum(sizes)) - 1, 3.0
    for _ in range(200):
        middle = (low + high) / 2
        taken = sum(s * min(3, math.exp(min(middle * s, 700))) for s in sizes)
        low, high = (middle, high) if taken < target else (low, middle)
    return low


def test_mix_of_documents(small, edge):
    for docs in (small, edge):
        rows = mixing.mix(docs).collect()
        if docs is small:
            again = mixing.mix(docs.repartition(7)).collect()
            assert sorted(map(tuple, again)) == sorted(map(tuple, rows))
        given_ids = sorted(repr(r["doc_id"]) for r in docs.select("doc_id").collect())
        assert sorted(repr(r["doc_id"]) for r in rows) == given_ids
        by = defaultdict(list)
        for r in rows:
            by[r["source"]].append(r)
        size = {s: sum(r["size"] for r in of) for s, of in by.items()}
        target = brute_targets(size)
        for source, of in by.items():
            sizes = [r["size"] for r in of]
            assert {r["source_size"] for r in of} == {size[source]}
            assert [r["target"] for r in of] == [pytest.approx(target[source])] * len(of)
            if 0 < target[source] < 3 * size[source]:
                tilt = brute_tilt(sizes, target[source])
                for r in of:
                    assert r["rate"] == pytest.approx(
                        min(3, math.exp(min(tilt * r["size"], 700))), rel=1e-3, abs=1e-6)
            assert all(0 <= r["copies"] <= 3 for r in of)
            taken = sum(r["copies"] * r["size"] for r in of)
            # a document longer than the target, among few, can't be made up for
            near = 0.01 * target[source] if docs is small else max(sizes) / 2
            assert abs(taken - target[source]) <= max(near, min([s for s in sizes if s] or [0]))


def test_targets_are_shared_again_until_none_is_above(spark):
    size = {"a": 1000, "b": 10, "c": 90, "d": 0, None: 30, "é": 500}
    weight = [1, 2, 3, 1, 2, 3]
    rows = [(s, size[s], w) for s, w in zip(["a", "b", "c", "d", "é", None], weight, strict=True)]
    got = mixing.targets(spark.createDataFrame(rows, "source string, words bigint, weight int"))
    assert {r["source"]: r["target"] for r in got.collect()} == {
        s: pytest.approx(t) for s, t in brute_targets(size).items()}


def test_rows_that_occur_often_are_rounded_together(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 100)
    rows = [(7, "w " * 10, "hot")] * 1500 + [(i, "w " * (i % 40), "hot") for i in range(900)]
    rows += [(i, "w " * 11, "b") for i in range(10_000, 10_400)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))
    got = got.collect()
    assert len(got) == len(rows)
    for source in ("hot", "b"):
        of = [r for r in got if r["source"] == source]
        assert sum(r["copies"] * r["size"] for r in of) == pytest.approx(of[0]["target"], rel=0.01)
    assert sum(r["doc_id"] == 7 for r in got) == 1501  # with the one of size 7


def test_copies_are_taken(small):
    rates = {r["doc_id"]: r["copies"] for r in mixing.mix(small).where("size > 0").collect()}
    taken = Counter(r["doc_id"] for r in mixing.take_copies(small).where(
        mixing.word_count("text") > 0).collect())
    assert taken == Counter({d: n for d, n in rates.items() if n})
