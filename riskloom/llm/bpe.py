"""Byte-pair encoding and decoding of whole texts.

Encoding: an Aho-Corasick automaton finds the longest token at every position of a piece; tokens
are taken greedily and checked against the pair-compatibility table, stepping back where two
neighbours could not stand side by side after all merges. Each position is given up at most once,
so a piece takes linear time and gives exactly what applying the merges in order gives.
Decoding: token bytes lie one after another in one buffer, and an offset table gathers them.
Where ids alone are wanted, `RankEncoder` gives the same ids by tiktoken for byte-level files in
which merging by the ranks of tokens and merging pair by pair are the same (`ranks_suffice`).

Edge cases: a null or empty text has no tokens and decodes to the empty text. Strings of added
tokens inside a text become those tokens, as in the tokenizers library. Rows are independent:
repeated rows give equal results, an empty table an empty one. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: white space and the pattern of pieces of each pre-tokenizer
SPACE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
NO_SPACE = SPACE[:1] + "^" + SPACE[1:]
BYTE_LEVEL = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?" + SPACE[:1] + r"^\p{L}\p{N}" + SPACE[1:]
    + "+|" + SPACE + "+(?!" + NO_SPACE + ")|" + SPACE + "+")

# fixed values: letters and digits of newer Unicode versions (first, last), neither for the library
NEWER = [
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC),
    (0x208F, 0x208F), (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4),
    (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF),
    (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A),
    (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1), (0x1246F, 0x1246F),
    (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3),
    (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20),
    (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128),
    (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81),
    (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2),
    (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF),
    (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479),
    (0x3D000, 0x3FC3F),
]
# fixed values: capital letters (first, last) and the first one's small letter, which the library
# knows and str.lower() doesn't
NEWER_CAPITALS = [
    (0x1C89, 0x1C89, 0x1C8A), (0xA7CB, 0xA7CB, 0x264), (0xA7CC, 0xA7CC, 0xA7CD),
    (0xA7CE, 0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2, 0xA7D3), (0xA7D4, 0xA7D4, 0xA7D5),
    (0xA7DA, 0xA7DA, 0xA7DB), (0xA7DC, 0xA7DC, 0x19B), (0x10D50, 0x10D65, 0x10D70),
    (0x16EA0, 0x16EB8, 0x16EBB),
]

PAIR = 1 << 20  # more than tokens in a vocabulary
PRIVATE = "\ue001"  # a character that is no letter, digit or white space
END = "\ue000"  # stands for the word-end suffix, as one symbol
BORDER = "\ue002"  # stands between pieces, in no token
# what a worker remembers, about 100 MB: up to twice so many words, and pairs of tokens
CACHED_WORDS, CACHED_PAIRS = 250_000, 200_000
REMEMBERED = 500_000  # keys of a `Memo`, of which it holds up to twice as many
BATCH_CHARS = 2_000_000  # texts encoded together; one that is longer, alone
LONG_PIECE, FEW = 200, 16  # longer pieces, and the last few, are merged one by one


def _byte_symbols() -> list[str]:
    """The symbol of each byte: printable Latin-1 bytes stand for themselves, the others take
    the code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(other)) for b in range(256)]


class Memo(dict):
    """What `make` gives for each key asked for. At `REMEMBERED` keys the older ones step back
    and stay only if they are asked for again before the next turn, so frequent keys are kept."""

    def __init__(self, make):
        self.make, self.older = make, {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def _in_ranges(ranges: list[tuple[int, ...]]) -> re.Pattern:
    return re.compile("[" + "".join(f"{chr(r[0])}-{chr(r[1])}" for r in ranges) + "]")


def _any_of(added: Iterable[str]) -> regex.Pattern:
    return regex.compile("(" + "|".join(
        regex.escape(t) for t in sorted(added, key=len, reverse=True)) + ")")


def _id_type(vocab: dict[str, int], added: dict[str, int]) -> str:
    return "<u2" if max(chain(vocab.values(), added.values())) < 1 << 16 else "<u4"


class Encoder:
    """A tokenizer file in memory: pieces, merges, pair compatibility, decoding."""

    def __init__(self, spec: str):
        conf = json.loads(spec)
        model = conf["model"]
        suffix = model.get("end_of_word_suffix") or ""
        self.suffix = bool(suffix)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]

        def symbols(token: str) -> str:
            return token[:-len(suffix)] + END if suffix and token.endswith(suffix) else token

        # tokens in the order in which merging makes them; base symbols come first
        made = [a + b for a, b in merges]
        base = sorted(set(model["vocab"]) - set(made), key=model["vocab"].get)
        order = base + made
        rank = {token: r for r, token in enumerate(order)}
        if len(rank) != len(order):
            raise ValueError("a token that several merges make has no single split")
        self.base = len(base)
        self.ids = [model["vocab"][token] for token in order]
        self.merged = {(rank[a], rank[b]): self.base + k for k, (a, b) in enumerate(merges)}
        self.left = [*range(self.base), *(rank[a] for a, _ in merges)]
        self.right = [*range(self.base), *(rank[b] for _, b in merges)]
        self.texts = texts = [symbols(token) for token in order]
        self.length = [len(t) for t in texts]
        by_text = {t: r for r, t in enumerate(texts)}
        self.shorter = [
            next((by_text[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in by_text), -1)
            for t in texts]
        self.automaton = ahocorasick.Automaton()
        for r, t in enumerate(texts):
            self.automaton.add_word(t, r)
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.known: dict[str | tuple[str], bytes] = {}  # ids of words, and of pieces
        self.older: dict[str | tuple[str], bytes] = {}
        self.ids_of, self.length_of, self.shorter_of = (
            np.array(x, np.int64) for x in (self.ids, self.length, self.shorter))
        self.pair_keys, self.pair_fits = np.zeros(1, np.int64) - 1, np.zeros(1, np.bool_)
        self.loose_space = re.compile(f"^ | \\Z|{SPACE} | {SPACE}")

        byte_symbol = _byte_symbols()
        self.to_symbols = {b: s for b, s in enumerate(byte_symbol)}
        self.added = {t["content"]: t["id"] for t in conf["added_tokens"]}
        self.split_added = _any_of(self.added)
        self.pieces, self.space = self._pre_tokenizer(conf["pre_tokenizer"])
        self.has_newer = _in_ranges(NEWER)
        self.has_newer_capital = _in_ranges(NEWER_CAPITALS)
        self.small = {c: small + c - first for first, last, small in NEWER_CAPITALS
                      for c in range(first, last + 1)}
        self.separators = re.compile("[\x1c-\x1f]")
        self.lower = conf["normalizer"] is not None
        self._offsets(model["vocab"], byte_symbol, joined=conf["decoder"] is None)

    def _pre_tokenizer(self, conf: dict):
        space = regex.compile(SPACE + "+")
        if conf["type"] == "ByteLevel":
            return regex.compile(BYTE_LEVEL), space
        pattern = conf["pretokenizers"][0]["pattern"]["Regex"]
        return regex.compile(pattern.replace(r"\s", SPACE[1:-1])), space

    def _offsets(self, vocab: dict[str, int], byte_symbol: list[str], joined: bool) -> None:
        """Bytes of all tokens in one buffer; `joined`: a space follows each token."""
        tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.added.items()}
        to_byte = {s: b for b, s in enumerate(byte_symbol)}
        size = max(tokens) + 1
        self.id_type = _id_type(vocab, self.added)
        parts = []
        for i in range(size):
            token = tokens.get(i, "")
            if joined:
                parts.append(token.encode() + b" ")
            elif token in self.added:
                parts.append(token.encode())
            else:
                parts.append(bytes(to_byte[s] for s in token))
        self.joined = joined
        self.offsets = np.zeros(size + 1, np.int64)
        self.offsets[1:] = np.cumsum([len(p) for p in parts])
        self.buffer = np.frombuffer(b"".join(parts), np.uint8)

    def compatible(self, a: int, b: int) -> bool:
        """Whether tokens a and b can be neighbours once all merges are done.

        Goes back in time: undo the later of the two merges, and see whether the symbols that
        then met at the border would have merged earlier.
        """
        verdict = self.neighbours(a, b, len(self.ids))
        if len(self.pairs) > CACHED_PAIRS:
            self.pairs.clear()
        self.pairs[a * PAIR + b] = verdict
        return verdict

    def neighbours(self, a: int, b: int, limit: int) -> bool:
        """Whether tokens a and b can be neighbours once the merges before `limit` are done."""
        while True:
            across = self.merged.get((a, b))
            if across is not None and across < limit:
                return False
            if max(a, b) < self.base:
                return True
            if a > b:
                limit, a = a, self.right[a]
            else:
                limit, b = b + 1, self.left[b]  # of equal merges the left one comes first

    def merge_piece(self, symbols: str) -> list[int]:
        """Ids of one piece, given as symbols."""
        n, length, pairs = len(symbols), self.length, self.pairs
        longest = [-1] * n + [0]
        for end, token in self.automaton.iter(symbols):  # at equal starts the longer ends later
            longest[end - length[token] + 1] = token
        taken: list[int] = []
        given_up = set()
        at, token, last = 0, longest[0], -1
        while at < n:
            end = at + length[token]
            following = longest[end]
            fits = following >= 0 and end not in given_up
            if fits and last >= 0:
                fits = pairs.get(last * PAIR + token)
                if fits is None:
                    fits = self.compatible(last, token)
            if fits:
                taken.append(token)
                at, last, token = end, token, following
            elif self.shorter[token] >= 0:
                token = self.shorter[token]
            else:
                given_up.add(at)
                token = taken.pop()
                at -= length[token]
                last = taken[-1] if taken else -1
        ids = self.ids
        return [ids[t] for t in taken]

    def _symbols(self, piece: str) -> str:
        if piece.isascii() and piece.isprintable():  # such bytes but the space are their own symbols
            symbols = piece.replace(" ", self.to_symbols[32])
        else:
            symbols = piece.encode().decode("latin-1").translate(self.to_symbols)
        return symbols + END if self.suffix else symbols

    def fitting(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """`compatible` of many pairs; those asked for before are looked up in a sorted table."""
        keys = a * PAIR + b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        new = np.unique(keys[self.pair_keys[at] != keys])
        if len(new):
            fits = np.array([self.compatible(*divmod(k, PAIR)) for k in new.tolist()])
            if len(self.pair_keys) > CACHED_PAIRS:
                self.pair_keys, self.pair_fits = self.pair_keys[:1], self.pair_fits[:1]
                return self.fitting(a, b)
            known = np.concatenate([self.pair_keys, new])
            order = np.argsort(known, kind="stable")
            self.pair_keys = known[order]
            self.pair_fits = np.concatenate([self.pair_fits, fits])[order]
            at = np.searchsorted(self.pair_keys, keys)
        return self.pair_fits[at]

    def merge_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece, given as symbols: the steps of `merge_piece`, for all at once."""
        if not pieces:
            return []
        text = BORDER.join(pieces) + BORDER
        size = np.array([len(p) for p in pieces])
        ends = np.cumsum(size + 1) - 1
        starts = ends - size
        length = self.length_of
        longest = np.full(len(text), -1, np.int64)
        found = np.fromiter(chain.from_iterable(self.automaton.iter(text)), np.int64).reshape(-1, 2)
        longest[found[:, 0] - length[found[:, 1]] + 1] = found[:, 1]  # the last one, so the longest
        longest[ends] = 0
        given_up = np.zeros(len(text), np.bool_)
        ended = np.full(len(text), -1, np.int64)  # the token taken up to here
        left = np.arange(len(pieces))
        at, token = starts.copy(), longest[starts]
        while len(left) > FEW:
            here, now, last = at[left], token[left], ended[at[left]]
            last[here == starts[left]] = -1
            end = here + length[now]
            fits = (longest[end] >= 0) & ~given_up[end]
            asked = np.flatnonzero(fits & (last >= 0))
            fits[asked] = self.fitting(last[asked], now[asked])
            shorter = self.shorter_of[now]
            back = ~fits & (shorter < 0)
            ended[end[fits]] = now[fits]
            before = ended[here]
            given_up[here[back]] = True
            at[left] = np.where(fits, end, np.where(back, here - length[before], here))
            token[left] = np.where(fits, longest[end], np.where(back, before, shorter))
            left = left[at[left] < ends[left]]
        # back from the end, to mark where tokens begin
        begins = np.full(len(text), -1, np.int64)
        done = np.setdiff1d(np.arange(len(pieces)), left)
        at = ends[done]
        while len(at):
            begin = at - length[ended[at]]
            begins[begin] = ended[at]
            more = begin > starts[done]
            at, done = begin[more], done[more]
        taken = np.flatnonzero(begins >= 0)
        ids = self.ids_of[begins[taken]].astype("=u4").tobytes()
        cuts = (4 * np.searchsorted(taken, np.stack([starts, ends]))).T.tolist()
        out = [ids[a:b] for a, b in cuts]
        for k in left.tolist():
            out[k] = array("I", self.merge_piece(pieces[k])).tobytes()
        return out

    def _pieces(self, word: str) -> list[str]:
        if max(word, default="") >= chr(NEWER[0][0]) and self.has_newer.search(word):
            plain = self.pieces.finditer(self.has_newer.sub(PRIVATE, word))
            return [word[m.start():m.end()] for m in plain]
        return self.pieces.findall(word)

    def _learn(self, words: Iterable[str]) -> None:
        """Puts the ids of words into `known`, which has none of them."""
        known, older = self.known, self.older
        whole: list[str] = []
        split: list[tuple[str, list[str]]] = []
        for word in words:
            if word in older:
                known[word] = older[word]
            elif word.isascii() and word[word[:1] == " ":].isalpha():
                whole.append(word)  # letters, a space before them or not
            else:
                split.append((word, self._pieces(word)))
        # a piece by itself is split no further, so it counts as a word too
        pieces = set(chain.from_iterable(p for _, p in split)).difference(known, whole)
        for piece in pieces:
            if piece in older:
                known[piece] = older[piece]
            else:
                whole.append(piece)
        symbols = list(map(self._symbols, whole))
        short = [k for k, x in enumerate(symbols) if len(x) <= LONG_PIECE]
        for k, ids in zip(short, self.merge_pieces([symbols[k] for k in short]), strict=True):
            known[whole[k]] = ids
        for piece, x in zip(whole, symbols, strict=True):
            if len(x) > LONG_PIECE:
                known[piece] = array("I", self.merge_piece(x)).tobytes()
        for word, pieces in split:
            if len(pieces) != 1:
                known[word] = b"".join([known[p] for p in pieces])

    def _words(self, text: str) -> list[str]:
        """A text without added tokens, cut where no piece reaches over."""
        if self.lower:
            text = unicodedata.normalize("NFC", text)
            # each letter by itself: no special form of sigma at the end of a word
            low = text.replace("Σ", "σ").lower()
            if not low.isascii() and self.has_newer_capital.search(low):
                low = low.translate(self.small)
            # str.split() also splits at four separators that aren't white space here
            return self.space.split(low) if self.separators.search(low) else low.split()
        # between two characters that aren't white space, a piece begins at a single space
        if self.loose_space.search(text):
            return [text]
        first, *words = text.split(" ")
        return [first, *[" " + w for w in words]]

    def _units(self, text: str | None) -> list[str | tuple[str]]:
        """Words, and added tokens (as tuples)."""
        if not text:
            return []
        if not self.added or not any(t in text for t in self.added):
            return self._words(text)
        units: list[str | tuple[str]] = []
        for s in self.split_added.split(text):
            units += [(s,)] if s in self.added else self._words(s) if s else []
        return units

    def encode_all(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """Ids of whole texts. What no text of a batch has had before is merged together."""
        at = 0
        while at < len(texts):
            units, chars = [], 0
            while at < len(texts) and chars < BATCH_CHARS:
                units.append(self._units(texts[at]))
                chars += len(texts[at] or "")
                at += 1
            if len(self.known) >= CACHED_WORDS:  # of the older ones those asked for again stay
                self.older, self.known = self.known, {}
            for token, number in self.added.items():
                self.known[token,] = array("I", [number]).tobytes()
            self._learn(set(chain.from_iterable(units)).difference(self.known))
            for unit in units:
                ids = b"".join(map(self.known.__getitem__, unit))
                yield np.frombuffer(ids, "=u4").astype("<u4", copy=False)

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text."""
        return next(self.encode_all([text]))

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 bytes of the text of `ids`; bytes that aren't UTF-8 are replaced."""
        if not len(ids):
            return b""
        ids = ids.astype(np.int64)
        start, size = self.offsets[ids], self.offsets[ids + 1] - self.offsets[ids]
        shift = start - (np.cumsum(size) - size)
        out = self.buffer[np.arange(size.sum()) + np.repeat(shift, size)].tobytes()
        if self.joined:
            return out[:-1]
        return out.decode("utf-8", "replace").encode()


@lru_cache(maxsize=4)
def ranks_suffice(spec: str) -> bool:
    """Whether merging by rank of the joined token, as tiktoken does, gives the ids of a file.

    It joins any two neighbours whose text is a token, and takes a piece that is a token whole. So
    no two tokens but those of its merge may ever stand side by side where they spell a token, and
    the two of its merge must do so.
    """
    conf = json.loads(spec)
    split, model = conf["pre_tokenizer"] or {}, conf["model"]
    if (split.get("type") != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"]
            or conf["normalizer"] is not None or model.get("end_of_word_suffix")
            or model.get("continuing_subword_prefix") or model.get("ignore_merges")):
        return False
    e = Encoder(spec)
    texts = list(e.texts)
    if set(texts[:e.base]) != set(_byte_symbols()):
        return False
    rank = {t: r for r, t in enumerate(texts)}
    for token in range(e.base, len(texts)):
        for k in range(1, len(texts[token])):
            a, b = rank.get(texts[token][:k]), rank.get(texts[token][k:])
            if a is None or b is None:
                continue
            if (a, b) == (e.left[token], e.right[token]):
                fits = max(a, b) < token and e.neighbours(a, b, token)
            elif max(a, b) < token:
                fits = not e.neighbours(a, b, token)
            elif a > b:  # the later one is made beside the other
                fits = not e.neighbours(e.right[a], b, a)
            else:
                fits = not e.neighbours(a, e.left[b], b + (a == b))
            if not fits:
                return False
    return True


class RankEncoder:
    """Ids of whole texts by tiktoken, for files of which `ranks_suffice` holds."""

    def __init__(self, spec: str):
        conf = json.loads(spec)
        vocab = conf["model"]["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in conf["model"]["merges"]]
        to_byte = {s: b for b, s in enumerate(_byte_symbols())}
        order = [*to_byte, *map("".join, merges)]
        self.ids = np.array([vocab[t] for t in order], "<u4")
        self.ranks = tiktoken.Encoding(
            "ranks", pat_str=BYTE_LEVEL, special_tokens={},
            mergeable_ranks={bytes(to_byte[s] for s in t): r for r, t in enumerate(order)})
        self.added = {t["content"]: t["id"] for t in conf["added_tokens"]}
        self.split_added = _any_of(self.added)
        self.id_type = _id_type(vocab, self.added)

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text."""
        if not text:
            return self.ids[:0]
        if not any(t in text for t in self.added):
            return self.ids[self.ranks.encode_to_numpy(text, disallowed_special=())]
        return np.concatenate([
            np.array([self.added[s]], "<u4") if s in self.added
            else self.ids[self.ranks.encode_to_numpy(s, disallowed_special=())]
            for s in self.split_added.split(text)])

    def encode_all(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        return map(self.encode, texts)


_LOADED: dict[tuple[str, type], Encoder | RankEncoder] = {}


class SharedEncoder:
    """The tokenizer file, broadcast (1-2 MB); each Python worker builds the encoder once.

    `by_rank`: for ids alone, a `RankEncoder` if the file allows one.
    """

    def __init__(self, spark: SparkSession, path: str, by_rank: bool = False):
        with open(path, encoding="utf-8") as f:
            spec = f.read()
        self.kind = RankEncoder if by_rank and ranks_suffice(spec) else Encoder
        self.key = hashlib.sha256(spec.encode()).hexdigest()
        self.spec = spark.sparkContext.broadcast(spec)

    def get(self) -> Encoder | RankEncoder:
        if (self.key, self.kind) not in _LOADED:
            _LOADED[self.key, self.kind] = self.kind(self.spec.value)
        return _LOADED[self.key, self.kind]


def id_text(docs: DataFrame) -> DataFrame:
    """doc_id as long and the text, nothing else."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))


def encode_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit numbers, binary), one row per document."""
    shared = SharedEncoder(docs.sparkSession, tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.get()
        for batch in batches:
            ids = [x.tobytes() for x in encoder.encode_all(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return id_text(docs).mapInArrow(run, "doc_id bigint, ids binary")


def decode_documents(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, text from doc_id, ids."""
    shared = SharedEncoder(encoded.sparkSession, tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.get()
        for batch in batches:
            texts = [encoder.decode(np.frombuffer(b or b"", "<u4")).decode()
                     for b in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encode, then decode, in one pass, so that
    neither ids nor texts leave the worker."""
    shared = SharedEncoder(docs.sparkSession, tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.get()
        for batch in batches:
            n, digest, decoded = [], [], []
            for ids in encoder.encode_all(batch.column(1).to_pylist()):
                n.append(len(ids))
                digest.append(hashlib.sha256(ids).hexdigest())
                decoded.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(digest), pa.array(decoded)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return id_text(docs).mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
