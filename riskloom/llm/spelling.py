"""Spelling variants: words one letter apart, each led to its much more frequent form.

Near words are found with partition-and-enumerate signatures. A word is the binary vector of its
letter multiset: dimension (letter, i) is set when the letter occurs more than i times. Replacing
a letter moves two dimensions, inserting or deleting one moves a single one, so near words have
vectors at Hamming distance two or one. The first level of the partition is by half of the word:
an edit lies in one half, so the other half agrees whole and goes into the signature as it is. The
dimensions of the edited half are dealt to a few second-level parts, and one signature is made for
every choice of parts that leaves out as many as the distance may touch: some choice leaves out
all that differ, and the rest agree. Equal signatures meet in an equi-join; the edit distance of
each pair that met is then verified, so the signatures lose no pair and add none.

Edge cases: a null or empty text has no words, a null doc_id hashes as the empty text. Repeated
rows count as often as they occur. Of equally frequent near words the smallest in code-point order
is the form. An empty table gives an empty result. Columns besides doc_id and text are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.bpe import id_text
from riskloom.llm.scratch import written

DAMAGED_ONE_IN = 31  # of word occurrences, by checksum
LEAST_LETTERS, LEAST_COUNT = 7, 2
FORM_FACTOR = 10  # how much more frequent a form is than its variant
HELD_WORDS = 200_000  # distinct words that a task counts before it hands them on
REPLACE_PARTS, INSERT_PARTS = 3, 2  # second-level parts for distance two and one

LETTERS = "[a-zÀ-ÿ]"  # after A-Z are lower-cased


def damaged(run: str, hashed: int) -> str:
    """The run without one letter where its checksum says so, else as it is."""
    if hashed % DAMAGED_ONE_IN:
        return run
    at = hashed % len(run)
    return run[:at] + run[at + 1:]


def count_words(docs: DataFrame, least_letters: int = LEAST_LETTERS,
                least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n: the words of all texts and how often they occur. Tasks count first."""
    runs = re.compile(f"{LETTERS}{{{least_letters},}}")  # shorter runs can't give a word

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def handed_on() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                ["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                 strict=True):
                if not text:
                    continue
                before = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                plain = text.encode().lower().decode()  # bytes lower-case A-Z only
                for found, n in Counter(runs.findall(plain)).items():
                    word = damaged(found, zlib.crc32(found.encode(), before))
                    if len(word) >= least_letters:
                        held[word] += n
                if len(held) >= HELD_WORDS:
                    yield handed_on()
        yield handed_on()

    return (id_text(docs).mapInArrow(run, "word string, n bigint")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count))


def _projections(half: str, parts: int, left_out: int) -> list[str]:
    """The vector of a half's letters, without each choice of `left_out` of its parts."""
    seen: Counter[str] = Counter()
    dealt: list[list[str]] = [[] for _ in range(parts)]
    for letter in half:
        dealt[(ord(letter) * 7 + seen[letter]) % parts].append(f"{letter}{seen[letter]}")
        seen[letter] += 1
    whole = ["".join(sorted(part)) for part in dealt]
    return ["|".join("*" if p in out else whole[p] for p in range(parts))
            for out in combinations(range(parts), left_out)]


def signatures(word: str) -> Iterator[tuple[str, bool, bool]]:
    """(signature, stands on the left, stands on the right) of a word of two letters or more.

    Left and right words with equal signatures are candidates. Of words of equal length (`=`)
    both stand on both sides; else (`+`) the shorter one, of m letters, stands on the left.
    """
    for kind, m, parts in (("=", len(word), REPLACE_PARTS), ("+", len(word), INSERT_PARTS),
                           ("+", len(word) - 1, INSERT_PARTS)):
        first, last = m // 2, m - m // 2
        for side, same, edited in (("<", word[:first], word[first:]),
                                   (">", word[-last:], word[:-last])):
            for projection in _projections(edited, parts, 2 if kind == "=" else 1):
                yield (f"{kind}{m}{side}{same} {projection}", kind == "=" or m == len(word),
                       kind == "=" or m < len(word))


def _signed(words: DataFrame) -> DataFrame:
    """key, on_left, on_right, word, n: a row per signature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                               strict=True):
                rows += [(xxhash.xxh64_intdigest(s) - (1 << 63), left, right, word, n)
                         for s, left, right in signatures(word)]
            names = ["key", "on_left", "on_right", "word", "n"]
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
            types = [pa.int64(), pa.bool_(), pa.bool_(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return words.select("word", "n").mapInArrow(
        run, "key bigint, on_left boolean, on_right boolean, word string, n bigint")


def near_pairs(words: DataFrame) -> DataFrame:
    """a, a_n, b, b_n: every pair of words one inserted, deleted or replaced letter apart, once.

    `words` has word (distinct) and n. Both sides of the join come straight from a shuffle by
    signature, so adaptive execution splits a signature that many words share.
    """
    signed = written(_signed(words), "spelling-signatures")
    left = signed.where("on_left").select("key", F.col("word").alias("a"), F.col("n").alias("a_n"))
    right = signed.where("on_right").select("key", F.col("word").alias("b"),
                                            F.col("n").alias("b_n"))
    shorter_or_first = (F.length("a") < F.length("b")) | (F.col("a") < F.col("b"))
    met = left.hint("merge").join(right, "key").where(
        shorter_or_first & (F.abs(F.length("a") - F.length("b")) <= 1)
        & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "a_n", "b", "b_n").distinct()


def follow_forms(forms: DataFrame) -> DataFrame:
    """word, root: the last form reached from each word of `forms` (word, form, never null).

    A form is many times more frequent than its word, so chains are short and end. Each round
    halves them by following every root's own root.
    """
    now = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = written(now.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"),
            F.col("further").isNotNull().alias("moved")), "spelling-roots")
        now = after.select("word", "root")
        if after.where("moved").isEmpty():
            return now


def group_variants(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of `words` (word, n)."""
    pairs = near_pairs(words)
    each = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"),
                        F.col("b_n").alias("near_n")).union(
        pairs.select(F.col("b"), F.col("a"), F.col("a_n")))
    best = each.groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    is_form = -F.col("best.less") >= FORM_FACTOR * F.col("n")
    judged = written(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"),
        F.when(is_form, -F.col("best.less")).alias("form_n")), "spelling-forms")
    roots = follow_forms(judged.where("form is not null"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """`group_variants` of the words of `documents`."""
    return group_variants(written(count_words(docs), "spelling-words"))
