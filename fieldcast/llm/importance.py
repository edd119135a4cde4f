"""Importance resampling towards a target: weights by hashed n-grams, ranks by regular sampling.

Every run of one to ``max_n`` words falls in one of ``buckets`` buckets by the CRC32 of its bytes.  A bucket's gain says how
much more often the target uses it than the corpus, a document's weight is the sum of its features' gains, and the highest
weights, each with Gumbel noise from a hash of the document's id, are a sample without replacement.

The CRC of a run of words follows from those of its words: appending n bytes is a linear map of the CRC,
kept as a table for each n, so numpy works out all runs of a batch at once and no n-gram is ever cut out or hashed.

Ranks come from parallel sorting by regular sampling: every partition sorts its own rows and gives up rows at a regular
distance; the sorted samples yield splitters; each segment between two splitters is exchanged and sorted by itself; sums
of the segments' counts make local places exact ranks.  Segments wholly behind the last drawn rank are never exchanged.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldcast.llm.common import stored
from fieldcast.session import send_with_tasks

send_with_tasks(__name__)

#: A-Z in lower case; every other ASCII character but digits and letters is a blank; the rest of UTF-8 stays.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Bytes of one text that are cut into words at a time; a longer text goes on in a further piece.
PIECE = 4_000_000
#: Words looked at together, and words remembered before the vocabulary of a task is emptied.
BATCH_WORDS, VOCABULARY = 1_000_000, 1_000_000
#: Samples for each segment, and the most segments; the driver holds at most their product and one row a partition.
SAMPLES, MAX_SEGMENTS = 32, 4096


def _append_tables() -> tuple[np.ndarray, np.ndarray]:
    """CRC32 after n zero bytes as a map of its four bytes: for n < 64, and for 64 times the powers of two."""
    step = np.zeros(256, np.uint32)
    for b in range(256):
        c = b
        for _ in range(8):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        step[b] = c
    one = np.arange(256, dtype=np.uint32)
    same = np.stack([one << np.uint32(8 * k) for k in range(4)])
    small = [same]
    for _ in range(64):
        last = small[-1]
        small.append((last >> np.uint32(8)) ^ step[last & np.uint32(255)])
    doubled = [small.pop()]
    for _ in range(25):
        table = doubled[-1]
        doubled.append(_through(table, table))
    return np.stack(small), np.stack(doubled)


def _through(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    out = table[0][crc & np.uint32(255)]
    for k in range(1, 4):
        out = out ^ table[k][(crc >> np.uint32(8 * k)) & np.uint32(255)]
    return out


class Features:
    """CRCs of all runs of words in texts."""

    def __init__(self, max_n: int) -> None:
        self.max_n = max_n
        small, self.doubled = _append_tables()
        self.small = small.reshape(64 * 4, 256).ravel()
        self._empty()

    def _empty(self) -> None:
        self.places: dict[bytes, int] = {}
        self.known = np.zeros((3, 1024), np.int64)

    def _learn(self, words: list[bytes]) -> None:
        if len(self.places) > VOCABULARY:
            self._empty()
        new = [w for w in dict.fromkeys(words) if w not in self.places]
        at = len(self.places)
        self.places.update(zip(new, range(at, at + len(new)), strict=True))
        if len(self.places) > self.known.shape[1]:
            grown = np.zeros((3, 2 * len(self.places)), np.int64)
            grown[:, :at] = self.known[:, :at]
            self.known = grown
        crc = zlib.crc32
        self.known[:, at : at + len(new)] = np.array(
            [[crc(w) for w in new], [crc(b" " + w) for w in new], [len(w) + 1 for w in new]], np.int64
        ).reshape(3, len(new))

    def append(self, crc: np.ndarray, size: np.ndarray) -> np.ndarray:
        """CRCs after ``size`` zero bytes."""
        base = (size & 63) << 10
        out = self.small[base + (crc & np.uint32(255))]
        for k in range(1, 4):
            out = out ^ self.small[base + 256 * k + ((crc >> np.uint32(8 * k)) & np.uint32(255))]
        more, k = size >> 6, 0
        while more.any():
            odd = np.flatnonzero(more & 1)
            out[odd] = _through(self.doubled[k], out[odd])
            more, k = more >> 1, k + 1
        return out

    def of(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(text's place, CRC) of every feature, in blocks, and the text's place for every word of the block."""
        owners, counts, carries, words = [], [], [], []
        for owner, piece, carry in _pieces(texts, self.max_n - 1):
            owners.append(owner)
            counts.append(len(piece))
            carries.append(carry)
            words += piece
            if len(words) >= BATCH_WORDS:
                yield self._block(owners, counts, carries, words)
                owners, counts, carries, words = [], [], [], []
        if words:
            yield self._block(owners, counts, carries, words)

    def _block(self, owners, counts, carries, words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self._learn(words)
        ids = np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))
        crc, after, size = self.known[:, ids]
        after = after.astype(np.uint32)
        owner = np.repeat(np.array(owners, np.int64), counts)
        ends = np.cumsum(counts)
        place = np.arange(len(words)) - np.repeat(ends - counts, counts)
        new = place >= np.repeat(carries, counts)
        run, made = crc.astype(np.uint32), [(owner[new], crc.astype(np.uint32)[new])]
        for n in range(1, self.max_n):
            run = self.append(run[:-1], size[n:]) ^ after[n:]
            whole = new[n:] & (place[n:] >= n)
            made.append((owner[n:][whole], run[whole]))
        return np.concatenate([a for a, _ in made]), np.concatenate([b for _, b in made]), owner[new]


def _pieces(texts: list[str | None], carry: int) -> Iterator[tuple[int, list[bytes], int]]:
    """(text's place, words, how many of them the piece before has shown already)."""
    for k, text in enumerate(texts):
        if not text:
            continue
        folded = text.encode("utf-8", "surrogatepass").translate(FOLD)
        at, last = 0, []
        while at < len(folded):
            end = len(folded) if len(folded) - at <= PIECE else folded.find(b" ", at + PIECE)
            end = len(folded) if end < 0 else end
            words = folded[at:end].split()
            if words:
                yield k, last + words, len(last)
                last = (last + words)[-carry:] if carry else []
            at = end


def bucket_counts(frame: DataFrame, text: str, buckets: int = 10_000, max_n: int = 3) -> np.ndarray:
    """How often each bucket occurs in all texts; every task adds up its own before anything is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(max_n), np.zeros(buckets, np.int64)
        for batch in batches:
            for _, crc, _ in features.of(batch.column(0).to_pylist()):
                total += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["bucket", "n"])

    counted = frame.select(F.col(text).alias("lm text")).mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most one row a bucket
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + b) / ((s + 1)(T + b)))) for each of b buckets, in doubles."""
    b, all_corpus, all_target = len(corpus), int(corpus.sum()), int(target.sum())
    odds = [(t + 1.0) * (all_corpus + b) / ((s + 1.0) * (all_target + b)) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(x)) for x in odds], np.int64)


def weighted(docs: DataFrame, text: str, gain: np.ndarray, max_n: int = 3) -> DataFrame:
    """``docs`` without its text, with ``lm n_words``, ``lm n_features`` and ``lm weight``."""
    kept = [c for c in docs.columns if c != text]
    source = docs.select(*kept, text)
    names = ("lm n_words", "lm n_features", "lm weight")
    schema = T.StructType([source.schema[c] for c in kept] + [T.StructField(n, T.LongType(), False) for n in names])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(max_n)
        for batch in batches:
            n = batch.num_rows
            made = np.zeros((3, n), np.int64)
            for owner, crc, word_owner in features.of(batch.column(len(kept)).to_pylist()):
                made[0] += np.bincount(word_owner, minlength=n)
                made[1] += np.bincount(owner, minlength=n)
                # gains are whole numbers, so sums in doubles are exact below 2**53
                made[2] += np.bincount(owner, gain[crc % np.uint32(len(gain))], n).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *map(pa.array, made)], names=schema.names)

    return source.mapInArrow(weigh, schema)


def _noise(doc_id: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln u)), u from the first 32 bits of a SHA-256 of seed and id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(
    docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
    percent: int = 5, least_words: int = 20, seed: int = 42, buckets: int = 10_000, max_n: int = 3,
    rows_per_segment: int = 200_000,
) -> DataFrame:
    """Every row of ``docs``, without its text, with ``n_features``, ``weight``, ``score`` and ``rank``.

    Of the N rows with at least ``least_words`` words, floor(``percent`` N / 100) are drawn: ranks 1, 2, 3, ... go by falling
    score, ties to the smaller ``doc_id`` (nulls last, ids compared by value), rows alike in both in the order they
    were read.  All other rows have a null rank.  A null or empty text has no features, weight 0 and is never drawn for
    ``least_words`` above 0; a null id is hashed as empty text; repeated rows count each by itself.  Columns named like a
    result are replaced, an empty table gives no rows, an empty target counts nothing for each bucket.
    """
    new = ("n_features", "weight", "score", "rank")
    kept = [c for c in docs.columns if c != text and c.lower() not in new]
    gain = gains(bucket_counts(docs, text, buckets, max_n), bucket_counts(target, target_text, buckets, max_n))
    held = docs.select(*(F.col(c).alias(f"lm kept {k}") for k, c in enumerate(kept)), F.col(text).alias("lm text"))
    scored = weighted(held, "lm text", gain, max_n)
    scored = scored.withColumns(
        {
            "lm id": F.col(f"lm kept {kept.index(doc_id)}"),
            "lm score": F.col("lm weight") + _noise(F.col(f"lm kept {kept.index(doc_id)}"), seed),
            "lm row": F.monotonically_increasing_id(),
            "lm out": F.col("lm n_words") < least_words,
        }
    )
    ranked = top_ranks(stored(scored, "importance-scores"), percent, rows_per_segment)
    return ranked.select(
        *(F.col(f"lm kept {k}").alias(c) for k, c in enumerate(kept)), F.col("lm n_features").alias("n_features"),
        F.col("lm weight").alias("weight"), F.col("lm score").alias("score"), F.col("lm rank").alias("rank"),
    )


def top_ranks(scored: DataFrame, percent: int, rows_per_segment: int) -> DataFrame:
    """``scored`` with ``lm rank`` for the best ``percent`` of the rows that are not ``lm out``, by regular sampling."""
    n = scored.where("not `lm out`").count()
    drawn = percent * n // 100
    if not drawn:
        return scored.withColumn("lm rank", F.lit(None).cast("long"))
    segments = min(MAX_SEGMENTS, -(-n // rows_per_segment))
    order = [F.col("lm out"), F.col("lm score").desc(), F.col("lm id").asc_nulls_last(), F.col("lm row")]
    runs = scored.sortWithinPartitions(*order)
    splitters = _splitters(runs, n, segments)
    placed = stored(_segmented(runs, splitters), "importance-segments")

    counts = placed.where("`lm segment` is not null").groupBy("lm segment").count().collect()  # one row a segment
    before, total = {}, 0
    for segment, count in sorted(tuple(r) for r in counts):
        before[segment], total = total, total + count
    wanted = sorted((s, at) for s, at in before.items() if at < drawn)
    last = wanted[-1][0]
    inside = F.coalesce(F.col("lm segment") <= last, F.lit(False))
    offsets = placed.sparkSession.createDataFrame(wanted, "`lm at` int, `lm before` long")  # at most MAX_SEGMENTS rows
    local = F.row_number().over(Window.partitionBy("lm segment").orderBy(*order[1:]))
    found = placed.where(inside).withColumn("lm local", local)
    found = found.join(F.broadcast(offsets), F.col("lm segment") == F.col("lm at"))
    rank = F.col("lm before") + F.col("lm local")
    found = found.withColumn("lm rank", F.when(rank <= drawn, rank).cast("long"))
    rest = placed.where(~inside).withColumn("lm rank", F.lit(None).cast("long"))
    return found.select(*rest.columns).unionByName(rest)


def _splitters(runs: DataFrame, n: int, segments: int) -> list[tuple]:
    """Keys that cut all rows into ``segments`` parts of about the same size."""
    stride = max(1, n // (segments * SAMPLES))
    keys = runs.select("lm out", "lm score", "lm id", "lm row")

    def regular(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            inside = batch.filter(pa.compute.invert(batch.column(0)))
            first = (stride // 2 - seen) % stride
            seen += inside.num_rows
            yield inside.take(pa.array(range(first, inside.num_rows, stride), pa.int64()))

    samples = sorted(_key(r["lm score"], r["lm id"], r["lm row"]) for r in keys.mapInArrow(regular, keys.schema).collect())
    return sorted({samples[len(samples) * k // segments] for k in range(1, segments)}) if samples else []


def _key(score: int, doc_id, row: int) -> tuple:
    return (-score, doc_id is None, 0 if doc_id is None else doc_id, row)


def _segmented(runs: DataFrame, splitters: list[tuple]) -> DataFrame:
    """Rows with the number of splitters at or before them; a sorted batch is cut where a splitter falls."""
    schema = T.StructType([*runs.schema.fields, T.StructField("lm segment", T.IntegerType())])
    at = {c: k for k, c in enumerate(runs.columns)}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(at[c]) for c in ("lm score", "lm id", "lm row")]
            inside = batch.num_rows - int(pa.compute.sum(batch.column(at["lm out"])).as_py() or 0)

            def key(i: int, columns=columns) -> tuple:
                return _key(*(c[i].as_py() for c in columns))

            segment = np.zeros(batch.num_rows, np.int32)
            start = 0
            while start < inside:
                part = bisect_left(splitters, (*key(start), 0))
                end = inside if part == len(splitters) else bisect_left(range(inside), splitters[part], start, inside, key=key)
                segment[start:end] = part
                start = end
            null = np.arange(batch.num_rows) >= inside
            made = pa.array(segment, pa.int32(), mask=null)
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=schema.names)

    return runs.mapInArrow(place, schema)


def resample_sql(docs: str, target: str) -> str:
    """The same rows in DuckDB's SQL, with the default parameters, for tables with unique ``doc_id``."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    words = "regexp_extract_all(translate(text, '{u}', '{l}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    words = words.format(u=upper, l=upper.lower())
    runs = "SELECT doc_id, w[i] AS f FROM {t} UNION ALL SELECT doc_id, w[i] || ' ' || w[i + 1] FROM {t} WHERE i < len(w)"
    runs += " UNION ALL SELECT doc_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM {t} WHERE i < len(w) - 1"
    return f"""
WITH crc_table AS (
  SELECT list(list_reduce(range(8), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)), b) ORDER BY b) AS t FROM range(256) r(b)
),
docs AS (SELECT doc_id, {words} AS w FROM {docs}),
goal AS (SELECT item_id AS doc_id, {words} AS w FROM {target}),
doc_words AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM docs),
goal_words AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM goal),
doc_runs AS (SELECT doc_id, f, count(*) AS n FROM ({runs.format(t='doc_words')}) GROUP BY 1, 2),
goal_runs AS (SELECT f, count(*) AS n FROM ({runs.format(t='goal_words')}) GROUP BY 1),
hashed AS (
  SELECT f, xor(4294967295, list_reduce(list_transform(range(0, octet_length(encode(f))), lambda j: CAST(('0x' || substr(hex(encode(f)), 2 * j + 1, 2)) AS BIGINT)),
           lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)]), 4294967295)) % 10000 AS bucket
  FROM (SELECT f FROM doc_runs UNION SELECT f FROM goal_runs), crc_table
),
counts AS (
  SELECT bucket, sum(s) AS s, sum(t) AS t FROM (
    SELECT bucket, n AS s, 0 AS t FROM doc_runs JOIN hashed USING (f) UNION ALL SELECT bucket, 0, n FROM goal_runs JOIN hashed USING (f)
  ) GROUP BY bucket
),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * (sum(s) OVER () + 10000) / (CAST(s + 1 AS DOUBLE) * (sum(t) OVER () + 10000)))) AS BIGINT) AS g FROM counts
),
weight AS (
  SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * g) AS BIGINT) AS weight FROM doc_runs JOIN hashed USING (f) JOIN gain USING (bucket) GROUP BY 1
),
scored AS (
  SELECT d.doc_id, len(d.w) >= 20 AS inside, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(('0x' || substr(sha256('42:' || d.doc_id), 1, 8)) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM docs d LEFT JOIN weight USING (doc_id)
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY inside ORDER BY score DESC, doc_id) AS r, count(*) FILTER (WHERE inside) OVER () AS n FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN inside AND r <= 5 * n // 100 THEN r END AS rank FROM ranked
"""
