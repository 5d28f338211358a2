"""Phrase collocations from count streams in prefix and suffix order.

Counting. Tasks cut every piece of text into windows of up to `longest` words, one per position,
and count equal windows of a block. The windows are then put in prefix order: sorted by range, all
windows that begin alike lie together, so one pass over the stream gives the count of every shorter
phrase as the sum of a run. Runs that reach over the edge of a range are added up afterwards.
Before that, windows are cut where no frequent phrase can be: counters of words, pairs and threes,
a fixed number of them shared by checksum, can only be too high, so what has a counter below the
least count is in no frequent phrase. That saves shuffled windows and changes no result.

Scoring. The streams of two neighbouring orders are merge-joined in lockstep, once in prefix order
(a phrase meets its first words: counts of the left parts) and once in suffix order (its last
words: counts of the right parts). The same meeting shows the extensions of a phrase: a phrase with
a longer one as frequent as itself always has one that is longer by a single word.

All arithmetic of scores is in whole decimals, so it is exact beyond 64 bits.

Edge cases: a null text is empty, a null lang is `und`. Repeated rows count as often as they
occur. Equal scores go by count, then by phrase. An empty table gives an empty result. Columns
besides text and lang are ignored.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.llm.scratch import written
from riskloom.operators.bounded import broadcast_if_small

LONGEST, LEAST, TOP = 5, 100, 2000
NO_LANG = "und"
COUNTED = 3  # words, pairs and threes have counters
SLOTS = 1 << 24  # counters for each of them: 6 MB of bits to each task
CHUNK = 1 << 16
BLOCK_WORDS = 1 << 20
HELD_WINDOWS = 500_000  # distinct windows that a task counts before it hands them on

# Inside, words of a phrase are joined by a tab, which no word holds. Control characters below it
# are written as two, so that the tab sorts first and phrases that begin alike lie together.
TAB, ESCAPE = "\t", "\x0b"
BREAKS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b"\n" * 10 + b" ")
CONTROL = re.compile(rb"[\x00-\x08]")
FACTORS = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93], np.uint64)  # odd, well mixed


def pieces_of(text: str) -> list[bytes]:
    """The pieces of a text, A-Z lower-cased, with spaces as only white space."""
    plain = text.encode().lower().translate(BREAKS)
    if CONTROL.search(plain):
        plain = CONTROL.sub(lambda c: b"\x0b" + bytes([c[0][0] + 64]), plain)
    return plain.split(b"\n")


def shown(gram):
    """A phrase as it stands in the text, its words joined by a space."""
    plain = F.replace(gram, F.lit(TAB), F.lit(" "))
    return F.when(F.contains(gram, F.lit(ESCAPE)), _unescaped(plain)).otherwise(plain)


def _unescaped(plain):
    for code in range(9):
        plain = F.replace(plain, F.lit(ESCAPE + chr(code + 64)), F.lit(chr(code)))
    return plain


class Block:
    """Numbered words of some pieces of text. `ids` has a 0 between pieces, `lang` the number of
    the language of each position."""

    def __init__(self):
        self.number: dict[bytes, int] = {}
        self.langs: dict[str, int] = {}
        self._ids, self._of, self._lengths = array("i", [0]), array("i", [0]), array("q", [1])

    def __len__(self) -> int:
        return len(self._ids)

    def add(self, lang: str, words: list[bytes]) -> None:
        number = self.number
        self._ids.extend([number.setdefault(w, len(number) + 1) for w in words])
        self._ids.append(0)
        self._of.append(self.langs.setdefault(lang, len(self.langs)))
        self._lengths.append(len(words) + 1)

    def close(self) -> Block:
        self.ids = np.array(self._ids, np.int64)
        self.lang = np.repeat(np.array(self._of, np.int64), np.array(self._lengths))
        hashed = [np.array([xxhash.xxh64_intdigest(x) for x in names], np.uint64)
                  for names in (self.number, self.langs)]
        self.word = np.append(np.zeros(1, np.uint64), hashed[0])[self.ids] ^ hashed[1][self.lang]
        # how many words from each position on stand in one piece, three at most
        one = self.ids > 0
        two = one & np.append(one[1:], False)
        self.runs = [one, two, two & np.append(two[1:], False)]
        return self

    def slots(self, slots: int) -> list[np.ndarray]:
        """Counters of each word, each pair and each three words in a row, by first position."""
        shift = np.uint64(64 - (slots - 1).bit_length())
        found, mixed = [], np.zeros(len(self.ids), np.uint64)
        for size in range(COUNTED):
            ahead = np.append(self.word[size:], np.zeros(size, np.uint64))
            mixed = (mixed ^ (mixed >> np.uint64(29))) * FACTORS[0] + ahead
            found.append(((mixed * FACTORS[1]) >> shift).astype(np.int64) + size * slots)
        return found

    def windows(self, frequent: np.ndarray, longest: int) -> Iterator[tuple[str, bytes, int]]:
        """(lang, window, count); the empty window has the count of all words."""
        langs = list(self.langs)
        per_lang = np.bincount(self.lang[self.runs[0]], minlength=len(langs)).tolist()
        yield from ((lang, b"", n) for lang, n in zip(langs, per_lang, strict=True) if n)
        one, two, three = (run & frequent[slot] for run, slot in zip(
            self.runs, self.slots(len(frequent) // COUNTED), strict=True))
        two &= one & np.append(one[1:], False)
        three &= two & np.append(two[1:], False)
        start = np.flatnonzero(one)
        code, base = self.lang[start], len(self.number) + 1
        for size in range(1, longest + 1):
            # a window as one number, from that of the window one word shorter
            code = code * base + self.ids[start + size - 1]
            further = two[start] if size == 1 else three[start + size - 2]
            if size == longest:
                further = np.zeros(len(start), bool)
            yield from self._counted(start[~further], code[~further], size, langs)
            start, code = start[further], np.unique(code[further], return_inverse=True)[1]

    def _counted(self, start: np.ndarray, code: np.ndarray, size: int, langs: list[str]):
        _, first, count = np.unique(code, return_index=True, return_counts=True)
        first = start[first]
        words = list(self.number)
        grams = (self.ids[first[:, None] + np.arange(size)] - 1).tolist()
        for lang, gram, n in zip(self.lang[first].tolist(), grams, count.tolist(), strict=True):
            yield langs[lang], b"\t".join([words[w] for w in gram]), n


def _blocks(batches: Iterator[pa.RecordBatch], block_words: int) -> Iterator[Block]:
    block = Block()
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                              strict=True):
            for piece in pieces_of(text):
                # an escape counts as white space to a plain split
                words = [w for w in piece.split(b" ") if w] if b"\x0b" in piece else piece.split()
                if words:
                    block.add(lang, words)
            if len(block) > block_words:
                yield block.close()
                block = Block()
    if len(block) > 1:
        yield block.close()


def _texts(docs: DataFrame) -> DataFrame:
    """lang and text, in no more parts than tasks run at once: each task counts most of the
    frequent phrases again, so with a task per split of the input, rows would grow with the number
    of splits times that of phrases."""
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).coalesce(
        docs.sparkSession.sparkContext.defaultParallelism)


def frequent_slots(docs: DataFrame, least: int, slots: int = SLOTS,
                   block_words: int = BLOCK_WORDS) -> np.ndarray:
    """Bits: whether a counter reached `least`. Of fixed size, whatever the corpus: `slots`, a
    power of two, for each of words, pairs and threes.

    A task's counters stop at `least` (or at 255 and so count as reached), so one byte each is
    enough, and their sums reach it exactly if the true ones do.
    """
    stop, width = min(least, 255), min(CHUNK, slots)
    n_chunks = COUNTED * slots // width

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(COUNTED * slots, np.uint8)
        for block in _blocks(batches, block_words):
            for run, slot in zip(block.runs, block.slots(slots), strict=True):
                found, n = np.unique(slot[run], return_counts=True)
                held[found] = np.minimum(held[found] + n, stop).astype(np.uint8)
        pack = zstandard.ZstdCompressor(level=1).compress
        parts = held.reshape(n_chunks, width)
        chunks = np.flatnonzero(parts.any(1)).tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array(chunks, pa.int32()),
             pa.array([pack(parts[c].tobytes()) for c in chunks], pa.binary())],
            ["chunk", "counts"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for chunk, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                now = sums.setdefault(chunk, np.zeros(width, np.uint16))
                now += np.frombuffer(unpack(packed), np.uint8)
                np.minimum(now, stop, out=now)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()),
             pa.array([np.packbits(s >= stop).tobytes() for s in sums.values()], pa.binary())],
            ["chunk", "bits"])

    rows = _texts(docs).mapInArrow(count, "chunk int, counts binary").repartition(
        "chunk").mapInArrow(total, "chunk int, bits binary").collect()
    bits = np.zeros((n_chunks, width // 8), np.uint8)
    for row in rows:
        bits[row["chunk"]] = np.frombuffer(row["bits"], np.uint8)
    return bits


def count_windows(docs: DataFrame, longest: int, least: int, slots: int = SLOTS,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """lang, gram, n: windows counted by block; a phrase's count is the sum of those that begin
    with it, except for phrases that can't reach `least`."""
    shared = docs.sparkSession.sparkContext.broadcast(
        frequent_slots(docs, least, slots, block_words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = np.unpackbits(shared.value).view(bool)
        held: defaultdict[str, Counter[bytes]] = defaultdict(Counter)

        def handed_on() -> Iterator[pa.RecordBatch]:
            for lang, counts in held.items():
                grams, n = list(counts), list(counts.values())
                for k in range(0, len(n), 1 << 16):
                    here = slice(k, k + (1 << 16))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(n[here]), pa.string()),
                         pa.array(grams[here], pa.binary()).cast(pa.string()),
                         pa.array(n[here], pa.int64())], ["lang", "gram", "n"])
            held.clear()

        for block in _blocks(batches, block_words):
            for lang, gram, n in block.windows(frequent, longest):
                held[lang][gram] += n
            if sum(map(len, held.values())) > HELD_WINDOWS:
                yield from handed_on()
        yield from handed_on()

    return _texts(docs).mapInArrow(run, "lang string, gram string, n bigint")


def phrase_counts(docs: DataFrame, longest: int = LONGEST, least: int = LEAST,
                  slots: int = SLOTS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """lang, gram, size, a: every phrase of up to `longest` words that occurs `least` times or
    more; the phrase of no words has the number of all words of the language."""
    windows = written(count_windows(docs, longest, least, slots, block_words), "phrase-windows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: list[str] = []  # language and words of the row before
        sums: list[int] = []  # of its phrases of 0, 1, 2 ... words
        edge = 0  # so many of them began with the range
        out: list[tuple[str, str, int, int]] = []

        def close(depth: int, last: bool) -> None:
            nonlocal edge
            while len(sums) > depth:
                n = sums.pop()
                size = len(sums)
                if last or size < edge or n >= least or not size:
                    out.append((before[0], TAB.join(before[1:size + 1]), size, n))
                edge = min(edge, size)

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [(), (), (), ()]
            types = [pa.string(), pa.string(), pa.int32(), pa.int64()]
            result = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                ["lang", "gram", "size", "a"])
            out.clear()
            return result

        for batch in batches:
            for lang, gram, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                path = [lang, *gram.split(TAB)] if gram else [lang]
                shared = 0
                for x, y in zip(path, before, strict=False):
                    if x != y:
                        break
                    shared += 1
                first = not before
                # a phrase that the new row begins with stays open
                close(shared, last=False)
                before = path
                sums += [0] * (len(path) - len(sums))
                if first:
                    edge = len(sums)
                for size in range(1 if gram else 0, len(path)):
                    sums[size] += n
            if len(out) >= 1 << 16:
                yield batch_of()
        close(0, last=True)
        yield batch_of()

    ordered = windows.repartitionByRange("lang", "gram").sortWithinPartitions("lang", "gram")
    return (ordered.mapInArrow(run, "lang string, gram string, size int, a bigint")
            .groupBy("lang", "gram", "size").agg(F.sum("a").alias("a"))
            .where((F.col("a") >= least) | (F.col("size") == 0)))


def _order_streams(counts: DataFrame, longest: int) -> Iterator[DataFrame]:
    """Per number of words from 2: lang, gram, a, head and tail (the phrase without its last, its
    first word), lefts and rights (counts of the parts at each cut), head_a, tail_a."""
    words = F.split("gram", TAB)
    none = F.expr("array()").cast("array<bigint>")
    before = counts.where("size = 1").select(
        "lang", "gram", "a", none.alias("lefts"), none.alias("rights"))
    for size in range(2, longest + 1):
        now = counts.where(F.col("size") == size).select(
            "lang", "gram", "a",
            F.substring_index("gram", TAB, size - 1).alias("head"),
            F.substring_index("gram", TAB, 1 - size).alias("tail"))
        heads = before.select("lang", F.col("gram").alias("head"), F.col("a").alias("head_a"), "lefts")
        tails = before.select("lang", F.col("gram").alias("tail"), F.col("a").alias("tail_a"), "rights")
        before = written(
            now.join(heads.hint("merge"), ["lang", "head"])
            .join(tails.hint("merge"), ["lang", "tail"])
            .withColumn("lefts", F.concat("lefts", F.array("head_a")))
            .withColumn("rights", F.concat(F.array("tail_a"), "rights")), f"phrase-order-{size}")
        yield before


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST,
                 top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the `top` phrases of each language."""
    counts = written(phrase_counts(docs, longest, least), "phrase-counts")
    orders = list(_order_streams(counts, longest))
    found, covered = orders[0], None
    for longer in orders[1:]:
        found = found.unionByName(longer)
        for side in ("head", "tail"):
            shorter = longer.where(F.col("a") == F.col(f"{side}_a")).select(
                "lang", F.col(side).alias("gram"))
            covered = shorter if covered is None else covered.union(shorter)
    if covered is not None:
        found = found.join(covered.distinct(), ["lang", "gram"], "left_anti")
    totals = counts.where("size = 0").select("lang", F.col("a").alias("n"))
    whole = "decimal(19,0)"
    cut = F.expr(f"""array_min(transform(lefts, (l, i) -> named_struct(
        'score', (cast(a * 1000 as {whole}) * cast(n as {whole}))
                 div (cast(l as {whole}) * cast(rights[i] as {whole})),
        'cut', i, 'l', l, 'r', rights[i])))""")
    scored = found.join(broadcast_if_small(totals), "lang").select(
        "lang", shown(F.col("gram")).alias("phrase"), "a", "n", cut.alias("cut"))
    best = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    return scored.withColumn("rank", F.row_number().over(best)).where(
        F.col("rank") <= top).select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a",
        F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n",
        F.col("cut.score").alias("score"))


# the same phrases, counted and cut one by one
ORACLE = r"""
WITH piece AS (
  SELECT lang, regexp_extract_all(p, '[^ \t]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\n\x0b\x0c\r]')) AS p
    FROM documents)),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM piece GROUP BY lang),
gram AS (
  SELECT lang, g, count(*) AS a FROM (
    SELECT lang, list_slice(w, i, i + k - 1) AS g FROM (
      SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
      FROM piece, (SELECT unnest(range(1, 6)) AS k)))
  GROUP BY lang, g HAVING count(*) >= 100),
cand AS (SELECT * FROM gram WHERE len(g) > 1),
inner_part AS (
  SELECT DISTINCT lang, list_slice(g, i, i + k - 1) AS g, a FROM (
    SELECT lang, g, a, k, unnest(range(1, len(g) - k + 2)) AS i FROM (
      SELECT lang, g, a, unnest(range(2, len(g))) AS k FROM cand))),
kept AS (
  SELECT * FROM cand WHERE NOT EXISTS (
    SELECT 1 FROM inner_part s
    WHERE s.lang = cand.lang AND s.g = cand.g AND 100 * s.a >= 100 * cand.a)),
cut AS (
  SELECT c.lang, c.g, c.k, c.a, x.a AS l, y.a AS r, t.n,
         ((1000::HUGEINT * c.a * t.n) // (x.a::HUGEINT * y.a))::BIGINT AS score
  FROM (SELECT lang, g, a, unnest(range(1, len(g))) AS k FROM kept) c
  JOIN gram x ON x.lang = c.lang AND x.g = list_slice(c.g, 1, c.k)
  JOIN gram y ON y.lang = c.lang AND y.g = list_slice(c.g, c.k + 1, len(c.g))
  JOIN total t ON t.lang = c.lang),
lowest AS (
  SELECT *, array_to_string(g, ' ') AS phrase FROM cut
  QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM lowest
QUALIFY rank <= 2000
"""
