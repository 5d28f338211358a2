"""Secret scans: fixed patterns, and strings that zstandard cannot explain.

Besides the base patterns, every long string near a sensitive word is a candidate. Its novelty is
its marginal size: what compressing it after its surroundings adds to compressing them alone, with
two dictionaries primed: the words in most documents of the corpus (`learn_words`) and usual
placeholder strings. Words, names used nearby and placeholders cost a few bytes; keys cost their
length and are reported as `novel`. Only matches are counted, literals are not entropy-coded, so a
random string costs its length whatever its alphabet and however long it is.

Edge cases: a null text is scanned as an empty one and stays null when redacted. Positions are
code points, ends exclusive. Rows are independent but for the dictionary, which no order of rows
and no repeated row changes by more than its count; repeated rows give equal results. Empty tables
give no rows and an empty dictionary. Other columns are kept by `redact` and ignored by `scan`.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.bpe import id_text
from riskloom.llm.scratch import few_rows, slices, written

# fixed values: the base patterns
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # the longest run from the first AKIA of a run
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "novel")

SENSITIVE = re.compile(
    r"(?:key|auth|bearer|credential|pass(?:word|wd)|passphrase|passcode|pwd|private|signature|secret"
    r"|token|session)",
    re.IGNORECASE | re.ASCII)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
CAPITALS = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
JOINS = re.compile(r"[+/_=-]")
REACH = 64            # code points from a sensitive word to the nearer end, and around a candidate
LEAST_NOVELTY = 0.8   # marginal bytes per byte of the candidate

WORD_BYTES = 64 << 10  # of the corpus dictionary, so also the bound of what is sent to the driver
WORD_LENGTHS = (4, 15)
CLASSES = 8

# what the primed dictionary explains besides words: alphabets, placeholders, identifiers
USUAL = (
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 01234567890123456789 "
    "0123456789abcdef 0123456789ABCDEF xxxxxxxxxxxxxxxx XXXXXXXXXXXXXXXX 0000000000000000 "
    "________________ ---------------- ================ deadbeef qwertyuiop "
    "example EXAMPLE placeholder changeme replace_me insert_your your_api_key_here your-token-here "
    "YOUR_SECRET_KEY my_private_key dummy sample default test_value undefined null none "
    "access_key_id secret_access_key client_secret refresh_token session_token authorization "
    "bearer credential credentials password passphrase signature certificate public private "
    "config configuration environment variable settings getenv process module function return "
    "class import export string number boolean object array length index value result response "
    "request header content type application json encode decode base64 sha256 version license "
    "https http www com org net html index path file name user admin root localhost server client")

# matches of six characters and more; `fast` with a step leaves literals as they are
PARAMETERS = zstandard.ZstdCompressionParameters(
    window_log=20, hash_log=18, min_match=6, target_length=1, strategy=zstandard.STRATEGY_FAST,
    write_content_size=False, write_dict_id=False)

_COMPRESSORS: dict[str, zstandard.ZstdCompressor] = {}


def learn_words(docs: DataFrame) -> str:
    """The words in most documents, rarest first, `WORD_BYTES` at most.

    Words are counted by one aggregate over whole texts, written, and cut where a class of
    frequency (`CLASSES` to a doubling) would no longer fit; equal counts are in or out together, so
    the driver gets a row per class and no more words than fit. Words of capitals and lower-case
    letters are parts of identifiers too (`getUserName`: get, User, Name).
    """
    shortest, longest = WORD_LENGTHS
    words = F.array_distinct(F.transform(
        F.regexp_extract_all("text", F.lit("[A-Za-z][a-z]++"), F.lit(0)), F.lower))
    counts = written(
        docs.select(F.explode(words).alias("word"))
        .where(F.length("word").between(shortest, longest))
        .groupBy("word").agg(F.count("*").alias("n"))
        .select("word", F.floor(F.log2("n") * CLASSES).cast("int").alias("class")), "words")
    size, least = 0, None
    for row in counts.groupBy("class").agg(
            F.sum(F.length("word") + 1).alias("bytes")).orderBy(F.desc("class")).collect():
        size += row.bytes
        if size > WORD_BYTES:
            break
        least = row["class"]
    if least is None:
        return ""
    taken = counts.where(F.col("class") >= least).collect()
    return " ".join(w for _, w in sorted((r["class"], r.word) for r in taken))


def _size(data: bytes, words: str) -> int:
    if words not in _COMPRESSORS:  # one per worker and dictionary
        primed = zstandard.ZstdCompressionDict(
            f"{words} {USUAL}".encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        primed.precompute_compress(compression_params=PARAMETERS)
        _COMPRESSORS.clear()
        _COMPRESSORS[words] = zstandard.ZstdCompressor(
            compression_params=PARAMETERS, dict_data=primed)
    return len(_COMPRESSORS[words].compress(data))


def _plain(text: str) -> bytes:
    """Words as the dictionary has them: lower case, apart at capitals and at joining signs."""
    return JOINS.sub(" ", CAPITALS.sub(" ", text)).lower().encode()


def novelty(candidate: str, before: str, after: str, words: str = "") -> float:
    """Marginal compressed bytes of `candidate` per byte, given its surroundings."""
    around, added = _plain(before + "\n" + after + "\n"), _plain(candidate)
    return (_size(around + added, words) - _size(around, words)) / len(added)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, in order."""
    spans = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def novel_spans(
    text: str, base: list[tuple[int, int, int]], words_known: str = ""
) -> list[tuple[int, int, int]]:
    """(start, kind, end) of incompressible strings in a sensitive context, off the base spans."""
    words = [(m.start(), m.end()) for m in SENSITIVE.finditer(text)]
    spans, k = [], 0
    for m in CANDIDATE.finditer(text) if words else ():
        # neither words nor candidates overlap their like, so both are in order of their ends
        while k < len(words) and words[k][1] + REACH < m.start():
            k += 1
        if k == len(words):
            break
        if words[k][0] > m.end() + REACH:
            continue
        if any(s < m.end() and m.start() < e for s, _, e in base):
            continue
        before, after = text[max(0, m.start() - REACH):m.start()], text[m.end():m.end() + REACH]
        if novelty(m[0], before, after, words_known) >= LEAST_NOVELTY:
            spans.append((m.start(), 3, m.end()))
    return spans


def all_spans(text: str, words_known: str = "") -> tuple[list, list]:
    base = base_spans(text)
    return base, sorted(base + novel_spans(text, base, words_known))


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_novel; one row per document."""
    known = learn_words(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for text in batch.column(1).to_pylist():
                base, spans = all_spans(text or "", known)
                kinds = [k for _, k, _ in spans]
                rows.append((*map(kinds.count, (0, 1, 2)),
                             hashlib.sha256(_joined(base).encode()).hexdigest(),
                             _joined(spans), kinds.count(3)))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_novel"])

    return id_text(docs).mapInArrow(
        run, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, "
             "spans string, n_novel bigint")


def redacted(text: str, mark: str, words_known: str = "") -> str:
    out, at = [], 0
    for start, _, end in all_spans(text, words_known)[1]:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """`docs` with every span replaced by `mark`; n_chars follows the text, other columns stay.

    Written here: only a run that starts here can send few rows at a time.
    """
    names = docs.columns
    known = learn_words(docs)
    whole = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            columns = list(batch.columns)
            at = names.index("text")
            texts = columns[at].to_pylist()
            clean = [t and redacted(t, mark, known) for t in texts]
            columns[at] = pa.array(clean, columns[at].type)
            if "n_chars" in names:
                k = names.index("n_chars")
                columns[k] = pa.array(
                    [n if a == b else len(b) for n, a, b in
                     zip(columns[k].to_pylist(), texts, clean, strict=True)], columns[k].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    with few_rows(docs.sparkSession):
        return written(docs.mapInArrow(run, whole), "redacted")
