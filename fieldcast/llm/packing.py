"""Cost-balanced packing of tokenised documents into sequences of a fixed length."""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldcast.llm.common import each_text, stored
from fieldcast.session import send_with_tasks

send_with_tasks(__name__)

#: Fixed value: the added token of ``byte_bpe_50k.json``, one id in any text.
ADDED = {"<|endoftext|>": 50256}
#: Chunks a task remembers before it starts anew; only a matter of memory.
REMEMBERED = 1_000_000
PLAN = "row long, spans array<struct<start:long,length:long,sequence_id:long,offset:long>>"


class ByteBpe:
    """Byte-level BPE ids of whole texts.

    ``vocabulary`` is a file of ranks (default: that of the public 50k vocabulary, which has the ids of
    ``byte_bpe_50k.json``); ``added`` are strings that are one id wherever they stand, as the added token of that file is.
    The pattern never joins a blank with what stands before it, so a text's ids are
    those of its chunks between single blanks, each with its blank; a chunk is encoded when it is first met.  A text
    with a chunk that is empty, has other white space at an end or holds an added string is encoded as a whole.
    """

    def __init__(self, vocabulary: str | None = None, pattern: str | None = None, added: dict[str, int] | None = None) -> None:
        import public_tokenizers
        import tiktoken

        with open(vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines)}
        pattern = pattern or public_tokenizers.PATTERN
        self.plain = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.added = ADDED if added is None else added
        self.at_added = re.compile("|".join(f"({re.escape(a)})" for a in self.added)) if self.added else None
        self.opens = np.zeros(max(ranks.values()) + 1, bool)  # ids that begin with a blank, and so a chunk
        self.opens[[rank for token, rank in ranks.items() if token[:1] == b" "]] = True
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.heads: dict[str, np.ndarray] = {}
        self.pool, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def whole(self, text: str) -> list[int]:
        if not self.at_added or not self.at_added.search(text):
            return self.plain(text)
        ids: list[int] = []
        for part in self.at_added.split(text):
            if part:
                ids += [self.added[part]] if part in self.added else self.plain(part)
        return ids

    def learn(self, chunks: set[str]) -> None:
        new = chunks - self.place.keys()
        fine = [c for c in new if c and c == c.strip()]
        if self.at_added and self.at_added.search(" ".join(fine)):
            fine = [c for c in fine if not self.at_added.search(c)]
        self.place.update(dict.fromkeys(new, -1))
        if fine:
            self.place.update(zip(fine, range(len(self.ends) - 1, len(self.ends) - 1 + len(fine)), strict=True))
            ids = np.array(self.plain(" " + " ".join(fine)), np.uint32)
            ends = np.append(np.nonzero(self.opens[ids])[0][1:], len(ids))
            self.ends = np.concatenate([self.ends, self.ends[-1] + ends])
            self.pool = np.concatenate([self.pool, ids])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text; equal texts are encoded once, and the chunks of all others are looked up together."""
        if len(self.place) > REMEMBERED:
            self.forget()
        made: dict[str, np.ndarray] = dict.fromkeys(texts)
        split = [text.split(" ") for text in made]
        counts = np.array([len(chunks) - 1 for chunks in split], np.int64)
        chunks = [chunk for chunks in split for chunk in chunks[1:]]
        self.learn(set(chunks))
        places = np.fromiter(map(self.place.__getitem__, chunks), np.int64, len(chunks))
        starts = self.ends[places]
        sizes = np.where(places < 0, 0, self.ends[places + 1] - starts)
        begins = np.concatenate([[0], np.cumsum(sizes)])
        pooled = self.pool[np.arange(begins[-1]) + np.repeat(starts - begins[:-1], sizes)]
        ends = np.concatenate([[0], np.cumsum(counts)])
        odd = np.concatenate([[0], np.cumsum(places < 0)])
        odd, cuts = (odd[ends[1:]] > odd[ends[:-1]]).tolist(), begins[ends].tolist()
        for k, text in enumerate(made):
            head = split[k][0]
            if odd[k] or not counts[k] or not head or head != head.rstrip():
                made[text] = np.array(self.whole(text), np.uint32)
            else:
                made[text] = np.concatenate([self._head(head), pooled[cuts[k] : cuts[k + 1]]])
        return [made[text] for text in texts]

    def _head(self, chunk: str) -> np.ndarray:
        ids = self.heads.get(chunk)
        if ids is None:
            ids = self.heads[chunk] = np.array(self.whole(chunk), np.uint32)
        return ids


def tokenised(docs: DataFrame, text: str, end_id: int, vocabulary: str | None, pattern: str | None) -> DataFrame:
    """``docs`` without the text, with ``lm row``, ``lm n`` (ids) and ``lm ids``.  Null texts are empty.

    Ids are little-endian, 16 bits wide in rows where all of them fit and else 32.
    """

    def make():
        bpe = ByteBpe(vocabulary, pattern)

        def job(texts):
            ids = [np.append(x, np.uint32(end_id)) for x in bpe.encode([t or "" for t in texts])]
            return [[len(x) for x in ids], [x.astype("<u2" if x.max() < 1 << 16 else "<u4").tobytes() for x in ids]]

        return job

    fields = [T.StructField("lm n", T.LongType(), False), T.StructField("lm ids", T.BinaryType(), False)]
    numbered = docs.withColumn("lm row", F.monotonically_increasing_id())
    return each_text(numbered, F.col(text), make, fields)


def assign(rows: np.ndarray, sizes: np.ndarray, capacity: int, linear: float, quadratic: float) -> Iterator[tuple]:
    """(row, start, length, sequence, offset) for the documents of one shard.

    Whole lengths of the capacity are cut off first and fill a sequence each.  What is left is taken in
    descending order and goes to the sequence of lowest cost so far among those that have room for it.  The
    number of sequences is the least that holds all; where none has room for a whole piece, the roomiest takes
    as much as it can and the rest is taken again in its order.
    """
    sequence = 0
    left: list[tuple[int, int, int]] = []
    for row, size in zip(rows.tolist(), sizes.tolist(), strict=True):
        full = size // capacity
        for k in range(full):
            yield row, k * capacity, capacity, sequence, 0
            sequence += 1
        if size % capacity:
            left.append((-(size % capacity), row, full * capacity))
    if not left:
        return
    n = -(sum(size for size, _, _ in left) // capacity)
    cost, used = np.zeros(n), np.zeros(n, np.int64)
    heapq.heapify(left)
    while left:
        size, row, start = heapq.heappop(left)
        length = -size
        priced = np.where(used + length <= capacity, cost, np.inf)
        best = int(priced.argmin())
        if priced[best] == np.inf:
            best = int(used.argmin())
            part = capacity - int(used[best])
            heapq.heappush(left, (part - length, row, start + part))
            length = part
        yield row, start, length, sequence + best, int(used[best])
        used[best] += length
        cost[best] += linear * length + quadratic * length * length


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = 2048,
    end_id: int = 1,
    linear: float = 1.0,
    quadratic: float = 1.0 / 2048,
    shard_tokens: int = 1 << 20,
    shard_rows: int = 1 << 14,
    vocabulary: str | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """Pieces of all documents, packed into sequences of at most ``capacity`` tokens.

    One row for each piece: doc_id, doc_row (a number of the input row), start, length, doc_tokens, sequence_id,
    offset, and ``ids``, its token ids as little-endian unsigned 32-bit integers.  Every id of every document (its tokens and ``end_id``) lies in
    one piece, and a sequence's pieces lie gapless from offset 0.  A document's cost is ``linear`` times its
    length plus ``quadratic`` times its square, as attention within a document has it.

    Documents are dealt at random into shards of about ``shard_tokens`` tokens and ``shard_rows``
    documents at most on average, packed one by one; all but the last sequence's worth of each shard is full, so
    padding stays under capacity / shard_tokens.  Shards get (row, length) only.  The ids are written once and
    meet their pieces in one join by row, which no key can skew.

    A null text is empty (its ``end_id`` alone), a null ``doc_id`` stays null, repeated rows are documents of their own,
    other columns of ``docs`` are left out, and an empty table gives no rows.
    """
    ids = stored(tokenised(docs.select(doc_id, text), text, end_id, vocabulary, pattern), "packing-ids")
    sums = ids.agg(F.sum(F.col("lm n") % capacity).alias("tokens"), F.count("*").alias("rows")).first()
    shards = max(1, -(-(sums["tokens"] or 0) // shard_tokens), -(-sums["rows"] // shard_rows))

    def plan(shard: pd.DataFrame) -> pd.DataFrame:
        base = int(shard["shard"].iloc[0]) << 36
        spans: dict[int, list[dict[str, int]]] = {}
        for row, start, length, sequence, offset in assign(
            shard["row"].to_numpy(), shard["n"].to_numpy(), capacity, linear, quadratic
        ):
            at = {"start": start, "length": length, "sequence_id": base + sequence, "offset": offset}
            spans.setdefault(row, []).append(at)
        return pd.DataFrame({"row": list(spans), "spans": list(spans.values())})

    dealt = ids.select(
        F.col("lm row").alias("row"), F.col("lm n").alias("n"), F.pmod(F.xxhash64("lm row"), F.lit(shards)).alias("shard")
    )
    spans = dealt.groupBy("shard").applyInPandas(plan, PLAN)
    both = ids.join(spans, ids["lm row"] == spans["row"]).select(
        doc_id, F.col("lm row").alias("doc_row"), "lm n", "lm ids", "spans"
    )
    schema = T.StructType(
        [both.schema[doc_id], both.schema["doc_row"]]
        + [T.StructField(c, T.LongType(), False) for c in ("start", "length", "doc_tokens", "sequence_id", "offset")]
        + [T.StructField("ids", T.BinaryType(), False)]
    )
    names = schema.names

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                of, out = [], ([], [], [], [], [], [])
                for k, (n, data, parts) in enumerate(zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True)):
                    ids_of = np.frombuffer(data, f"<u{len(data) // n}").astype("<u4")
                    for p in parts:
                        of.append(k)
                        piece = ids_of[p["start"] : p["start"] + p["length"]].tobytes()
                        row = (p["start"], p["length"], n, p["sequence_id"], p["offset"], piece)
                        for column, value in zip(out, row, strict=True):
                            column.append(value)
                kinds = [pa.int64()] * 5 + [pa.binary()]
                made = [pa.array(column, kind) for column, kind in zip(out, kinds, strict=True)]
                rows = pa.array(of, pa.int64())
                yield pa.RecordBatch.from_arrays([*(batch.column(i).take(rows) for i in (0, 1)), *made], names=names)

    return both.mapInArrow(cut, schema)
