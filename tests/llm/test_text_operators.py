"""Operators on single texts, against plain Python and the tokenizers library."""

import hashlib
import itertools
import json
import random
import re
import string
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskloom.llm import bpe, license_scan, line_dedup, packing, quality_classifier, quality_rules, secret_scan

WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
BYTE_FILE = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module", params=[WORD_FILE, BYTE_FILE])
def pair(request):
    with open(request.param, encoding="utf-8") as f:
        return bpe.Encoder(f.read()), Tokenizer.from_file(request.param)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(
    st.sampled_from("aeinorst '\n\t .,!0123456789\xe9\xc9\xdf\u03a3\u017f\xa0\u2003\x1c\x85\u65e5\U0001f642<|"),
    st.characters(codec="utf-8")), max_size=60))
def test_ids_and_text_are_those_of_the_library(pair, text):
    ours, theirs = pair
    ids = theirs.encode(text, add_special_tokens=False).ids
    assert ours.encode(text).tolist() == ids
    assert ours.decode(np.array(ids, "<u4")).decode() == theirs.decode(
        ids, skip_special_tokens=False)


def test_every_letter_and_digit_is_split_as_the_library_splits_it(pair):
    ours, theirs = pair
    # unassigned ones, and ideographs in a row, are too many to ask one by one
    points = [c for c in map(chr, range(0x110000)) if regex.match(r"[\p{L}\p{N}\p{M}]", c) and not (
        regex.match(r"\p{Han}|\p{Hangul}|\p{Tangut}", c) and ord(c) % 64)]
    points += [chr(c) for first, last in bpe.NEWER for c in {first, last}]
    for k in range(0, len(points), 4096):
        texts = [f"!{c}a{c}" for c in points[k:k + 4096]]
        for text, found in zip(texts, theirs.encode_batch(texts, add_special_tokens=False),
                               strict=True):
            assert ours.encode(text).tolist() == found.ids, text


@pytest.mark.parametrize("text", [
    "<|endoftext|>", "a<|endoftext|> b<|startoftext|>c", "a" * 3000, "abab" * 500 + " " * 50,
    "don't we'll 's't", "end of word Σ", ""])
def test_added_tokens_and_long_runs(pair, text):
    ours, theirs = pair
    assert ours.encode(text).tolist() == theirs.encode(text, add_special_tokens=False).ids


def test_forgetting_words_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 3)
    with open(WORD_FILE, encoding="utf-8") as f:
        ours = bpe.Encoder(f.read())
    text = "one two three four five six one two seven one"
    want = Tokenizer.from_file(WORD_FILE).encode(text, add_special_tokens=False).ids
    assert [ours.encode(text).tolist() for _ in range(3)] == [want] * 3


@pytest.mark.parametrize("docs", ["edge", "small", "empty"])
def test_round_trip_query(request, docs):
    docs = request.getfixturevalue(docs)
    theirs = Tokenizer.from_file(WORD_FILE)

    def row(doc_id, text):
        ids = theirs.encode(text or "", add_special_tokens=False).ids
        return (doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                hashlib.sha256(theirs.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    want = Counter(row(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    assert Counter(map(tuple, bpe.round_trip(docs, WORD_FILE).collect())) == want
    again = bpe.decode_documents(bpe.encode_documents(docs, BYTE_FILE), BYTE_FILE)
    assert Counter(map(tuple, again.collect())) == Counter(
        (r.doc_id, r.text or "") for r in docs.collect())  # byte-level: an exact round trip


@pytest.fixture(scope="module")
def by_rank():
    with open(BYTE_FILE, encoding="utf-8") as f:
        return bpe.RankEncoder(f.read()), Tokenizer.from_file(BYTE_FILE)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(
    st.sampled_from("aeinorst '\n\t .,!0123456789\xe9\xc9\xdf\u03a3\u017f\xa0\u2003\x1c\x85\u65e5\U0001f642<|"),
    st.characters(codec="utf-8")), max_size=60))
def test_ids_by_rank_are_those_of_the_library(by_rank, text):
    ours, theirs = by_rank
    assert ours.encode(text).tolist() == theirs.encode(text, add_special_tokens=False).ids


def test_ids_by_rank_of_every_character_added_tokens_and_long_runs(by_rank):
    ours, theirs = by_rank
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000
              and (c < 0x3000 or c % 16 == 0 or any(a <= c <= b for a, b in bpe.NEWER))]
    texts = [f"a{c}a 1{c}1 {c}  {c}! {c}{c}" for c in points]
    texts += ["<|endoftext|>", "a<|endoftext|> b<|startoftext|>c", "", "don't we'll 's't",
              "a" * 3000, "abab" * 500 + " " * 50, " " * 70_000 + "x", "\t \n" * 30_000,
              "".join(random.Random(8).choices("abcd\xe90", k=50_000)), "\u65e5\u672c" * 9000]
    for k in range(0, len(texts), 4096):
        some = texts[k:k + 4096]
        want = theirs.encode_batch(some, add_special_tokens=False)
        for text, ids, found in zip(some, ours.encode_all(some), want, strict=True):
            assert ids.tolist() == found.ids, text[:50]
    assert ours.encode(None).tolist() == []


def spec_of(merges):
    """A byte-level file with some merges (pairs of tokens)."""
    with open(BYTE_FILE, encoding="utf-8") as f:
        conf = json.load(f)
    order = [*bpe._byte_symbols(), *("".join(m) for m in merges)]
    conf["model"] |= {"vocab": {t: i for i, t in enumerate(order)}, "merges": merges}
    conf["added_tokens"] = []
    return json.dumps(conf)


@pytest.mark.parametrize("merges, suffice", [
    ([["a", "b"], ["ab", "c"]], True),
    ([["b", "c"], ["a", "b"], ["ab", "c"]], False),  # abc stands as a, bc: never joined
    ([["a", "b"], ["c", "d"], ["b", "c"], ["a", "bc"]], False),  # its parts never meet
    ([["a", "a"], ["aa", "a"]], True),
    ([["a", "a"], ["a", "aa"]], False),  # aa, a stand there and spell it, a, aa don't
])
def test_ranks_serve_only_where_they_give_the_ids_of_the_merges(merges, suffice):
    spec = spec_of(merges)
    assert bpe.ranks_suffice(spec) == suffice
    theirs = Tokenizer.from_str(spec)
    texts = ["".join(x) for n in range(1, 7) for x in itertools.product("abcd", repeat=n)]
    want = [x.ids for x in theirs.encode_batch(texts, add_special_tokens=False)]
    found = [x.tolist() for x in bpe.RankEncoder(spec).encode_all(texts)]
    assert (found == want) == suffice


def test_packing_encodes_by_rank_where_that_is_exact(spark, tmp_path):
    """Over twice as fast on words not seen before, as many words of large corpora are."""
    shared = bpe.SharedEncoder(spark, BYTE_FILE, by_rank=True)
    assert isinstance(shared.get(), bpe.RankEncoder)
    assert type(bpe.SharedEncoder(spark, BYTE_FILE).get()) is bpe.Encoder
    assert type(bpe.SharedEncoder(spark, WORD_FILE, by_rank=True).get()) is bpe.Encoder
    other = tmp_path / "other.json"
    other.write_text(spec_of([["b", "c"], ["a", "b"], ["ab", "c"]]), encoding="utf-8")
    assert type(bpe.SharedEncoder(spark, str(other), by_rank=True).get()) is bpe.Encoder
    draw = random.Random(5)
    texts = [" ".join("".join(draw.choices(string.ascii_lowercase, k=8)) for _ in range(1000))
             for _ in range(60)]
    took = []
    for kind in (bpe.RankEncoder, bpe.Encoder):
        with open(BYTE_FILE, encoding="utf-8") as f:
            encoder = kind(f.read())
        start = time.process_time()
        n = sum(map(len, encoder.encode_all(texts)))
        took.append((n, time.process_time() - start))
    assert took[0][0] == took[1][0] and 2 * took[0][1] < took[1][1]


@pytest.mark.parametrize("docs", ["edge", "small", "empty"])
def test_packing_places_every_id_once(request, docs):
    docs = request.getfixturevalue(docs)
    theirs = Tokenizer.from_file(BYTE_FILE)
    pieces = packing.pack(docs, BYTE_FILE, shard_docs=16).collect()
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        ids = theirs.encode(r.text or "", add_special_tokens=False).ids + [1]
        want[r.doc_id] += len(ids)
    got = Counter()
    whole = {r.doc_id: np.array(theirs.encode(r.text or "", add_special_tokens=False).ids + [1],
                                "<u4") for r in docs.dropDuplicates(["doc_id"]).collect()
             if r.doc_id is not None}
    for p in pieces:
        got[p.doc_id] += p.length
        if p.doc_id in whole:
            part = whole[p.doc_id][p.start:p.start + p.length]
            assert len(part) == p.length and zlib.crc32(part.tobytes()) == p.ids_crc32
    assert got == want
    sequences = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == sequences.get(p.sequence_id, 0)  # gapless
        sequences[p.sequence_id] = p.offset + p.length
    assert all(0 < n <= 2048 for n in sequences.values())
    open_ones = sum(n < 2048 for n in sequences.values())
    assert open_ones <= -(-docs.count() // 16)  # at most one per shard


def test_seed_takes_its_lexical_neighbour_first():
    a, b, c, d = (np.arange(k, k + 300) for k in (0, 1000, 2000, 3000))
    tails = [np.append(a, a), np.append(b, c)[:599], np.append(a, d)[:400], np.append(c, d)[:350]]
    tails += [np.arange(5000 + 10 * k, 5010 + 10 * k) for k in range(8)]  # in few, terms weigh
    first = next(packing.fill_windows(tails, 1000))
    assert [i for i, _, _ in first] == [0, 2]


def counted(text):
    found = WORD.findall(text or "")
    windows = Counter(zip(found, found[1:], found[2:], strict=False))
    repeated = {i + d for i in range(len(found) - 2) for d in range(3)
                if windows[tuple(found[i:i + 3])] > 1}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(repeated))


@pytest.mark.parametrize("docs", ["edge", "small", "empty"])
def test_quality_rules(request, spark, docs, marks):
    docs = request.getfixturevalue(docs)
    rows = quality_rules.quality_rules(docs, marks).collect()

    def want(text):
        c = counted(text)
        return (*c, c[0] < 50 or 100 * c[4] > 50 * c[0])
    assert Counter((r.doc_id, *r[1:6], r.base_failed) for r in rows) == Counter(
        (r.doc_id, *want(r.text)) for r in docs.collect())
    assert not any(r.kept for r in rows if r.base_failed)
    kept = quality_rules.keep_good(docs, marks)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in rows)


def test_no_labels_no_rules(spark, edge, marks):
    rows = quality_rules.quality_rules(edge, marks.limit(0)).collect()
    assert all(r.kept != r.base_failed and r.rule == 0 for r in rows)


def test_rules_are_learned_grown_and_pruned(spark):
    rows = [(float(i % 10) / 10, 0.0, float(i % 7) / 7, 0.0, 0.0, 5.0,
             i % 10 > 6 and i % 7 > 3, i % 3 == 0) for i in range(3000)]
    names = ", ".join(f"{f} double" for f in quality_rules.FEATURES)
    found = quality_rules.learn(spark.createDataFrame(rows, f"{names}, bad boolean, prune boolean"))
    assert len(found.rules) == 1
    assert {(x.feature, x.above) for x in found.rules[0]} == {
        ("symbol_share", True), ("upper_share", True)}


@pytest.mark.parametrize("every", [100, 28, 10])
def test_a_rare_bad_class_is_found(spark, every):
    draw = np.random.default_rng(every)
    bad = np.arange(3000) % every == 0
    noise = draw.uniform(0, 1, (3000, len(quality_rules.FEATURES)))
    noise[:, 0] = np.where(bad, draw.uniform(0.2, 0.9, 3000), draw.uniform(0, 0.15, 3000))
    rows = [(*map(float, x), bool(b), k % 3 == 0) for k, (x, b) in enumerate(zip(
        noise, bad, strict=True))]
    names = ", ".join(f"{f} double" for f in quality_rules.FEATURES)
    found = quality_rules.learn(spark.createDataFrame(rows, f"{names}, bad boolean, prune boolean"))
    assert len(found.rules) == 1
    (rule,) = found.rules[0]
    assert (rule.feature, rule.above) == ("symbol_share", True) and 0.15 < rule.threshold < 0.25


def test_thresholds_are_taken_again_inside_a_rule(spark):
    """Bad rows that only lie apart among the few rows that the first literal covers."""
    draw = np.random.default_rng(3)
    x, y = draw.uniform(0, 1, (2, 6000))
    bad = (x > 0.95) & (y > 0.6) & (y < 0.9)
    rows = [(float(a), 0.0, float(b), 0.0, 0.0, 5.0, bool(c), k % 3 == 0)
            for k, (a, b, c) in enumerate(zip(x, y, bad, strict=True))]
    names = ", ".join(f"{f} double" for f in quality_rules.FEATURES)
    table = spark.createDataFrame(rows, f"{names}, bad boolean, prune boolean")
    rules = quality_rules.learn(table)
    hit = rules.rule_number({f: quality_rules.F.col(f) for f in quality_rules.FEATURES}) > 0
    got = table.select("bad", hit.alias("hit")).collect()
    assert sum(r.hit and r.bad for r in got) >= 0.9 * bad.sum()
    assert sum(r.hit and not r.bad for r in got) <= 0.1 * bad.sum()


@pytest.mark.parametrize("docs", ["edge", "small", "empty"])
def test_secret_scan(request, docs):
    docs = request.getfixturevalue(docs)
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                        r"""([A-Za-z0-9+/_.=-]+)""", re.I | re.A)

    def want(text):
        text = text or ""
        spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text)
                  if len(m[0]) >= 20]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text)
                  if len(m[0]) >= 24]
        joined = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(spans))
        n = Counter(k for _, k, _ in spans)
        return n[0], n[1], n[2], hashlib.sha256(joined.encode()).hexdigest()
    got = secret_scan.scan(docs).collect()
    assert Counter((r.doc_id, *r[1:5]) for r in got) == Counter(
        (r.doc_id, *want(r.text)) for r in docs.collect())
    clean = secret_scan.redact(docs)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    assert all(secret_scan.base_spans(r.text or "") == [] for r in clean.collect())


@pytest.mark.parametrize("text, found", [
    ("auth bearer 9f8G7h6J5k4L3m2N1b0VxZq", "novel:12:35"),
    ("private key zzzzzzzzzzzzzzzzzzzzzzzzzz1", ""),       # compresses
    ("signature your_api_key_here_your_api_key_here1", ""),  # a placeholder
    ("nothing near 9f8G7h6J5k4L3m2N1b0VxZq", ""),          # no sensitive context
    ("secret=token:abcdefgh", ""), ("password=token=abcdef", "assign:0:21")])
def test_novel_strings(text, found):
    assert secret_scan._joined(secret_scan.all_spans(text)[1]) == found


KEY = "9f8G7h6J5k4L3m2N1b0VxZqTy"
LONG = hashlib.shake_256(b"long").hexdigest(50).upper()


@pytest.mark.parametrize("text, found", [
    (f"password => '{KEY}'", "novel:13:38"), (f"run --password {KEY}", "novel:15:40"),
    (f"passwd({KEY})", "novel:7:32"), (f"the PassWord is {KEY}", "novel:16:41"),
    ("Zq" + LONG + " # auth token", "novel:0:102"),        # half a byte a digit, all of it new
    (4 * KEY[:5] + " nothing", ""), (KEY + " " * 65 + "auth", ""),
    (KEY + " " * 64 + "auth", "novel:0:25"), ("auth" + " " * 64 + KEY, "novel:68:93"),
    ("auth" + " " * 65 + KEY, "")])
def test_novel_strings_near_passwords_and_by_their_nearer_end(text, found):
    assert secret_scan._joined(secret_scan.all_spans(text)[1]) == found


@pytest.mark.parametrize("n", [50, 100, 500])
def test_novel_strings_of_any_length_before_the_word(n):
    draw = random.Random(n)
    key = "".join(draw.choice(string.ascii_letters + string.digits) for _ in range(n))
    assert secret_scan._joined(secret_scan.all_spans(key + " # auth token")[1]) == f"novel:0:{n}"


ALPHABETS = (string.ascii_letters + string.digits + "+/", "0123456789ABCDEF", string.ascii_letters,
             string.ascii_lowercase + string.digits)


@pytest.mark.parametrize("alphabet", ALPHABETS)
@pytest.mark.parametrize("n", [20, 64, 300, 2000])
def test_random_strings_of_any_alphabet_and_length_are_novel(alphabet, n):
    draw = random.Random(n)
    keys = ["".join(draw.choice(alphabet) for _ in range(n)) for _ in range(200)]
    assert sum(f"novel:12:{12 + n}" == secret_scan._joined(
        secret_scan.all_spans(f"private key {k} here")[1]) for k in keys) >= 198


def test_identifiers_of_the_words_of_a_corpus_are_not_novel(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    known = secret_scan.learn_words(docs)
    assert 1000 < len(known) < secret_scan.WORD_BYTES
    counts = Counter()
    for r in docs.select("text").collect():
        counts.update({w.lower() for w in re.findall("[A-Za-z][a-z]+", r.text or "")})
    classes = {w: int(np.floor(np.log2(n) * secret_scan.CLASSES))
               for w, n in counts.items() if 4 <= len(w) <= 15}
    due, size = [], 0
    for c in sorted(set(classes.values()), reverse=True):
        level = [w for w in classes if classes[w] == c]
        size += sum(len(w) + 1 for w in level)
        if size > secret_scan.WORD_BYTES:
            break
        due += level
    assert known.split() == sorted(due, key=lambda w: (classes[w], w))
    draw, found = random.Random(3), 0
    for i in range(2000):
        words = [draw.choice(due) for _ in range(draw.randint(4, 8))]
        name = ("_".join(words), "/".join(words), "-".join(words).upper(),
                words[0] + "".join(map(str.title, words[1:])))[i % 4]
        found += bool(secret_scan.all_spans(f"private key {name} here", known)[1])
    assert found <= 20


def test_secret_scan_learns_nothing_from_no_text(spark):
    none = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert secret_scan.learn_words(none) == "" and secret_scan.learn_words(none.limit(0)) == ""
    assert [r.spans for r in secret_scan.scan(none).collect()] == ["", ""]


@pytest.mark.parametrize("docs", ["edge", "small", "empty"])
def test_classifier_scores_every_document(request, docs, marks):
    docs = request.getfixturevalue(docs)
    rows = quality_classifier.score_quality(docs, marks).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in docs.collect())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
               for r in rows if r.doc_id is not None)
    none = quality_classifier.score_quality(docs, marks.limit(0)).collect()
    assert {r.score for r in none} <= {0.5}


def test_classifier_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality_classifier.score_quality(docs, labels).join(labels, "doc_id").where(
        "held_out").collect()
    good = [r.score for r in scored if r.quality == 1]
    bad = [r.score for r in scored if r.quality == 0]
    assert np.mean([np.mean([g > b for b in bad]) for g in good]) > 0.9
    assert np.mean([r.predicted == r.quality for r in scored]) > 0.9
    # whatever labels the held-out rows carry, scores stay the same
    turned = labels.withColumn("quality", quality_classifier.F.when(
        quality_classifier.held_out(), 1 - quality_classifier.F.col("quality")).otherwise(
        quality_classifier.F.col("quality")))
    other = {r.doc_id: r.score for r in quality_classifier.score_quality(docs, turned).collect()}
    assert all(other[r.doc_id] == r.score for r in scored)


@pytest.mark.parametrize("docs", ["edge", "small", "empty"])
def test_line_dedup_of_documents(request, docs):
    docs = request.getfixturevalue(docs)
    rows = docs.collect()
    pages, seen = Counter(r.source or "" for r in rows), Counter()
    for r in rows:
        seen.update({(r.source or "", x) for x in (r.text or "").split("\n") if WORD.search(x)})
    common = {k for k, n in seen.items() if n >= 3 and n > 0.2 * pages[k[0]]}

    def want(r):
        return r.text if r.text is None else "\n".join(
            x for x in r.text.split("\n") if (r.source or "", x) not in common)
    got = line_dedup.dedup_documents(docs, ratio=0.2, min_pages=3)
    assert got.columns == docs.columns
    assert Counter((r.doc_id, r.text, r.n_chars) for r in got.collect()) == Counter(
        (r.doc_id, want(r), r.n_chars if want(r) == r.text else len(want(r))) for r in rows)


def test_hot_host_and_null_pages(spark):
    pages = spark.createDataFrame(
        [(i, "http://hot.example/a", f"<p>menu</p><p>page {i}</p><script>x</script>")
         for i in range(60)] + [(100, None, "<p>menu</p>"), (101, "http://b.example", None),
                                (101, "http://b.example", None)],
        "page_id long, url string, html string")
    rows = {r.page_id: r for r in line_dedup.dedup_pages(pages).collect()}
    assert rows[5].text == "page 5" and rows[5].n_dropped == 1 and rows[5].n_lines == 2
    assert rows[100].text == "menu" and rows[101].text is None and len(rows) == 62


def test_terms_of_any_length_are_scanned(spark):
    text = "license " + "a." * 200_000 + "\nReleased under the MIT License."
    rows = spark.createDataFrame([(1, text), (2, "license " + "a." * 5000)], "doc_id long, text string")
    assert rows.select(license_scan.own_license(F.col("text")).alias("l")).count() == 2
    got = rows.select("doc_id", license_scan.own_license(F.col("text")).alias("l")).collect()
    assert [r["l"] and r["l"]["license"] for r in got] == ["MIT", None]
