"""Lexical retrieval packing: windows of related documents.

Every document is tokenised once; full windows of a long document stand alone, and the tails are
dealt evenly into shards of about `shard_docs` documents. Each shard has a BM25 inverted index of
its tails. A seed's unused neighbours, best score first, fill its window; the one that doesn't fit
is cut there and its rest stays in the index. So every window but a shard's last is full.

Edge cases: a null or empty text is the end token alone. Documents without a common term follow
in the order of their lengths; ties go to the earlier document of the shard. Repeated rows are
documents of their own. An empty table gives no piece. Columns besides doc_id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.bpe import SharedEncoder, id_text
from riskloom.llm.scratch import few_rows, slices, written

K1, B = 1.2, 0.75  # the usual BM25 saturation and length weight
PIECE = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
         "sequence_id bigint, offset bigint")
SERIALS = 1 << 33  # rows a task may number


def tokenised(docs: DataFrame, tokenizer: str, window: int, end_id: int) -> DataFrame:
    """One row per document: doc_id, doc_tokens, the checksums of its full windows, the ids of
    its tail (unsigned, 2 bytes each where the vocabulary allows), and a number for dealing."""
    shared = SharedEncoder(docs.sparkSession, tokenizer, by_rank=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.get()
        serial = TaskContext.get().partitionId() * SERIALS
        for batch in slices(batches):
            tokens, crcs, tails = [], [], []
            for ids in encoder.encode_all(batch.column(1).to_pylist()):
                ids = np.append(ids, np.array([end_id], "<u4"))
                full = len(ids) - len(ids) % window
                tokens.append(len(ids))
                crcs.append([zlib.crc32(ids[k:k + window]) for k in range(0, full, window)])
                tails.append(ids[full:].astype(encoder.id_type).tobytes())
            n = len(tokens)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(tokens, pa.int64()),
                 pa.array(crcs, pa.list_(pa.int64())), pa.array(tails, pa.binary()),
                 pa.array(range(serial, serial + n), pa.int64())],
                ["doc_id", "doc_tokens", "full_crcs", "tail", "serial"])
            serial += n

    return id_text(docs).mapInArrow(
        run, "doc_id bigint, doc_tokens bigint, full_crcs array<bigint>, tail binary, "
             "serial bigint")


class LexicalIndex:
    """BM25 inverted index of some token sequences. Terms in over half of them weigh nothing."""

    def __init__(self, docs: list[np.ndarray]):
        n = len(docs)
        pairs = [np.unique(d, return_counts=True) for d in docs]
        owner = np.repeat(np.arange(n), [len(t) for t, _ in pairs])
        raw = np.concatenate([t for t, _ in pairs]) if n else np.zeros(0, np.int64)
        tf = np.concatenate([c for _, c in pairs]).astype(np.float64) if n else np.zeros(0)
        _, term, df = np.unique(raw, return_inverse=True, return_counts=True)
        idf = np.log((n - df + 0.5) / (df + 0.5))
        sizes = np.array([len(d) for d in docs], np.float64)
        weight = idf[term] * tf * (K1 + 1) / (
            tf + K1 * (1 - B + B * sizes[owner] / max(sizes.mean(), 1)))
        useful = idf[term] > 0
        owner, term, weight = owner[useful], term[useful], weight[useful]
        self.n = n
        self.terms_at = np.searchsorted(owner, np.arange(n + 1))  # terms of each sequence
        self.terms = term
        by_term = np.argsort(term, kind="stable")
        self.docs, self.weights = owner[by_term], weight[by_term]
        self.postings_at = np.searchsorted(term[by_term], np.arange(len(df) + 1))

    def scores(self, seed: int) -> np.ndarray:
        terms = self.terms[self.terms_at[seed]:self.terms_at[seed + 1]]
        start = self.postings_at[terms]
        size = self.postings_at[terms + 1] - start
        at = np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)
        return np.bincount(self.docs[at], self.weights[at], self.n).astype(np.float64)


def fill_windows(tails: list[np.ndarray], window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Windows as lists of (tail, from, to)."""
    size = np.array([len(t) for t in tails], np.int64)
    used = np.zeros(len(tails), np.int64)
    index = LexicalIndex(tails)
    for seed in np.argsort(-size, kind="stable"):
        while used[seed] < size[seed]:
            # a seed that fits is whole here; its rest opens the next window otherwise
            scores = index.scores(seed)
            scores[seed] = np.inf
            free = np.flatnonzero(used < size)
            room, pieces = window, []
            for i in free[np.lexsort((free, -size[free], -scores[free]))]:
                taken = min(room, size[i] - used[i])
                pieces.append((int(i), int(used[i]), int(used[i] + taken)))
                used[i] += taken
                room -= taken
                if not room:
                    break
            yield pieces


def pack(docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 1,
         shard_docs: int = 512) -> DataFrame:
    """The pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset. A piece of a document is a run of its ids; a sequence is at most `window` ids.

    The texts are read once; what moves is one row of at most `window` ids per document.
    """
    with few_rows(docs.sparkSession):
        encoded = written(tokenised(docs, tokenizer, window, end_id), "pack-tokens")
    shards = max(1, -(-encoded.count() // shard_docs))
    shared = SharedEncoder(docs.sparkSession, tokenizer, by_rank=True)
    id_bytes = 2 if shared.get().id_type == "<u2" else 4

    # as Arrow tables: pandas would stay in the memory of every Python worker
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("serial")
        sequence = rows["shard"][0].as_py() << 32
        out = []
        doc_ids, tokens = rows["doc_id"].to_pylist(), rows["doc_tokens"].to_pylist()
        starts = []
        for doc, n, crcs in zip(doc_ids, tokens, rows["full_crcs"].to_pylist(), strict=True):
            for k, crc in enumerate(crcs):
                out.append((doc, k * window, window, crc, n, sequence, 0))
                sequence += 1
            starts.append(len(crcs) * window)
        tails = [np.frombuffer(t, f"<u{id_bytes}") for t in rows["tail"].to_pylist()]
        for pieces in fill_windows(tails, window):
            offset = 0
            for i, begin, end in pieces:
                crc = zlib.crc32(tails[i][begin:end].astype("<u4"))
                out.append((doc_ids[i], starts[i] + begin, end - begin, crc, tokens[i],
                            sequence, offset))
                offset += end - begin
            sequence += 1
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        return pa.table([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names)

    dealt = encoded.withColumn("shard", F.pmod(F.xxhash64("serial"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(run, PIECE)
