"""Removal of byte strings that occur more than once, by a cover of sampled suffixes.

A difference cover picks sample positions so that any two suffixes, moved on by the same few bytes, both meet the
sample; only sampled suffixes are sorted and named, the others are merged by what stands before their next
sample.  Residues modulo 3 sample two thirds of all bytes, which is many times the input in every sort.  Equal
strings of ``length`` bytes are all that matters here, so the cover is picked by content (winnowing): of every
``length - core + 1`` consecutive positions the one whose ``core`` bytes hash lowest.  Each string of ``length`` bytes holds such a
position, at the same place in all its occurrences; for 400 bytes the sample is a 150th of the text.

1. Sampled suffixes are named by their core; only names that occur again are looked at further.
2. Names are refined by the whole surroundings within which strings with this core lie.  Where the surroundings
   occur twice, every string there does.
3. What is left lies at the edges of repeats.  Suffixes are merged there: the strings that start 0, 1, 2 ... bytes before the
   sample are ordered among those of the same name, and neighbours in that order are compared over ``length`` bytes.

Strings with a common core overlap, so of each sample only the first and the last repeated start count: the bytes in
between are covered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldcast.llm.common import each_text, stored
from fieldcast.session import send_with_tasks

send_with_tasks(__name__)

LOW31 = (1 << 31) - 1
SPAN = "k1 long, k2 long, low long, high long"


class Hashes:
    """Hashes of any substring from running sums modulo 2 ** 64; the last bits of a string's sum are well mixed at the end."""

    def __init__(self, seed: int) -> None:
        draw = np.random.default_rng(seed)
        self.value = draw.integers(1 << 63, size=256, dtype=np.uint64)
        self.base = int(draw.integers(1 << 62)) * 2 + 1
        self.power = self.inverse = np.ones(1, np.uint64)

    def prepare(self, n: int) -> None:
        """Powers of the base and of its inverse up to n."""
        if len(self.power) > n:
            return
        n = max(1 << 12, 2 * n)
        with np.errstate(over="ignore"):
            for name, factor in (("power", self.base), ("inverse", pow(self.base, -1, 1 << 64))):
                steps = np.full(n, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def sums(self, data: np.ndarray) -> np.ndarray:
        """Running sums along the last axis, from 0."""
        n = data.shape[-1]
        self.prepare(n + 1)
        out = np.zeros((*data.shape[:-1], n + 1), np.uint64)
        np.cumsum(self.value[data] * self.power[:n], axis=-1, dtype=np.uint64, out=out[..., 1:])
        return out

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((sums[end] - sums[start]) * self.inverse[start])


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive numbers."""
    n = len(x) - width + 1
    blocks = np.full(-(-len(x) // width) * width, np.iinfo(x.dtype).max, x.dtype)
    blocks[: len(x)] = x
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def cover(data: np.ndarray, length: int, core: int, one: Hashes, two: Hashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions, names, surroundings) of the sampled suffixes of one text; none below ``length`` bytes."""
    n = len(data)
    if n < length:
        none = np.zeros(0, np.int64)
        return none, none, none
    sums = one.sums(data)
    starts = np.arange(n - core + 1)
    names = one.of(sums, starts, starts + core)
    ranked = (names >> np.uint64(33)).astype(np.int64) << 31 | (LOW31 - starts)
    at = np.unique(LOW31 - (sliding_least(ranked, length - core + 1) & LOW31))
    low, high = np.maximum(at - (length - core), 0), np.minimum(at + length, n)
    around = two.of(two.sums(data), low, high) ^ mixed(((at - low) << 32 | (high - at)).astype(np.uint64))
    return at, names[at].view(np.int64), around.view(np.int64)


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _samples(docs: DataFrame, text: str, length: int, core: int) -> DataFrame:
    def make():
        one, two = Hashes(1), Hashes(2)

        def job(texts):
            with np.errstate(over="ignore"):
                found = [cover(np.frombuffer(_bytes(t), np.uint8), length, core, one, two) for t in texts]
            return [list(column) for column in zip(*found, strict=True)]

        return job

    fields = [T.StructField(c, T.ArrayType(T.LongType(), False), False) for c in ("at", "name", "around")]
    return each_text(docs.select("k1", "k2", text), F.col(text), make, fields).drop(text)


def repeated_starts(left: np.ndarray, sizes: np.ndarray, contexts: np.ndarray, length: int, one: Hashes) -> tuple[np.ndarray, np.ndarray]:
    """(least, most) bytes before the sample at which a repeated string starts, for each context; -1 for none.

    ``contexts`` has a row for each, with the sample at the same column; ``left`` and ``sizes`` say how many bytes
    are there before and from the sample on.
    """
    reach = contexts.shape[1] - length
    sums = one.sums(contexts)
    least, most = np.full(len(contexts), -1), np.full(len(contexts), -1)
    for before in range(reach + 1):
        column = reach - before
        there = np.nonzero((left >= before) & (sizes >= length - before))[0]
        values = sums[there, column + length] - sums[there, column]
        order = np.argsort(values, kind="stable")
        equal = values[order][1:] == values[order][:-1]
        hit = np.zeros(len(there), bool)
        hit[order[1:][equal]] = True
        hit[order[:-1][equal]] = True
        rows = there[hit]
        most[rows] = before
        least[rows[least[rows] < 0]] = before
    return least, most


def _edges(batches: Iterator[pa.RecordBatch], length: int, core: int, at_once: int) -> Iterator[pa.RecordBatch]:
    """Spans of the lone contexts (``n`` = 1) among rows sorted by name, a few whole names at a time."""
    one, reach = Hashes(1), length - core

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        single = list({(r[0], r[1]): r for r in rows}.values())  # a copy of a row brings its context again
        contexts = np.zeros((len(single), reach + length), np.uint8)
        left = np.array([r[5] for r in single])
        sizes = np.array([len(r[6]) for r in single]) - left
        for k, r in enumerate(single):
            contexts[k, reach - left[k] : reach + sizes[k]] = np.frombuffer(r[6], np.uint8)
        with np.errstate(over="ignore"):
            least, most = repeated_starts(left, sizes, contexts, length, one)
        found = [
            (r[2], r[3], r[4] - int(m), r[4] - int(s) + length)
            for r, s, m in zip(single, least, most, strict=True)
            if m >= 0 and r[7] == 1
        ]
        columns = list(zip(*found, strict=True)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["k1", "k2", "low", "high"])

    waiting: list[tuple] = []
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if len(waiting) >= at_once and row[0] != waiting[-1][0]:
                yield solve(waiting)
                waiting = []
            waiting.append(row)
    if waiting:
        yield solve(waiting)


def _starts(batches: Iterator[pa.RecordBatch], length: int, core: int) -> Iterator[pa.RecordBatch]:
    """Every string around a sample as a row of its own: (name, before, hash 1, hash 2, context, k1, k2, at, n)."""
    one, two = Hashes(1), Hashes(2)
    names = ["name", "before", "h1", "h2", "around", "k1", "k2", "at", "n"]
    for batch in batches:
        for name, around, k1, k2, at, left, context, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            data = np.frombuffer(context, np.uint8)
            before = np.arange(max(0, length - (len(data) - left)), min(left, length - core) + 1)
            if not len(before):
                continue
            start = left - before
            with np.errstate(over="ignore"):
                h1, h2 = (h.of(h.sums(data), start, start + length).view(np.int64) for h in (one, two))
            same = [np.full(len(before), v, np.int64) for v in (around, k1, k2, at, n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v) for v in (np.full(len(before), name, np.int64), before, h1, h2, *same)], names=names
            )


def repeated_spans(docs: DataFrame, text: str, length: int, core: int, hot: int, at_once: int = 2000) -> DataFrame:
    """(k1, k2, low, high): bytes of the documents of each key that strings of ``length`` bytes cover which start elsewhere, too."""
    table = stored(_samples(docs, text, length, core), "suffix-samples")
    samples = table.select("k1", "k2", F.explode(F.arrays_zip("at", "name", "around")).alias("s")).select("k1", "k2", "s.*")
    # what is joined by a hot key is written first: Spark splits a hot partition only where no aggregate feeds the join
    named = stored(samples.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name"), "suffix-names")
    again = stored(samples.join(named, "name"), "suffix-named")

    # one sample stands for its class; chosen here, where a name's samples are combined before the shuffle
    first = F.min(F.struct("k1", "k2", "at")).alias("one")
    classes = stored(again.groupBy("name", "around").agg(F.count("*").alias("n"), first), "suffix-classes")
    whole = again.join(classes.where("n > 1").select("name", "around"), ["name", "around"]).select(
        "k1", "k2", (F.col("at") - (length - core)).alias("low"), (F.col("at") + length).alias("high")
    )

    edges = classes.groupBy("name").agg(
        F.count("*").alias("contexts"), F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).alias("lone")
    )
    edges = stored(edges.where("contexts > 1 and lone > 0").select("name", (F.col("contexts") > hot).alias("hot")), "suffix-edges")
    asked = classes.join(edges, "name").select("name", "around", "hot", "n", "one.*").groupBy("k1", "k2").agg(
        F.collect_list(F.struct("name", "around", "hot", "n", "at")).alias("asked")
    )
    held = docs.select("k1", "k2", text).join(asked, ["k1", "k2"]).select("k1", "k2", text, "asked")
    schema = "name long, around long, k1 long, k2 long, at long, before long, context binary, n long, hot boolean"

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 6 + [pa.binary(), pa.int64(), pa.bool_()]
        names = ["name", "around", "k1", "k2", "at", "before", "context", "n", "hot"]
        for batch in batches:
            for row in range(0, batch.num_rows, 200):
                out: list[tuple] = []
                for k1, k2, t, wanted in zip(*(c.to_pylist() for c in batch.slice(row, 200).columns), strict=True):
                    data = _bytes(t)
                    for w in wanted:
                        low = max(0, w["at"] - (length - core))
                        context = data[low : w["at"] + length]
                        out.append((w["name"], w["around"], k1, k2, w["at"], w["at"] - low, context, w["n"], w["hot"]))
                columns = list(zip(*out, strict=True)) or [[]] * 9
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=names)

    found = stored(held.mapInArrow(contexts, schema), "suffix-contexts")
    fields = ["name", "around", "k1", "k2", "at", "before", "context", "n"]
    usual = found.where("not hot").select(fields).repartition("name").sortWithinPartitions("name")
    usual = usual.mapInArrow(lambda batches: _edges(batches, length, core, at_once), SPAN)

    # names with very many surroundings: each string is a row, so no task gathers a name
    rows = "name long, before long, h1 long, h2 long, around long, k1 long, k2 long, at long, n long"
    single = found.where("hot").dropDuplicates(["name", "around"]).select(fields)
    strings = single.mapInArrow(lambda batches: _starts(batches, length, core), rows)
    key = ["name", "before", "h1", "h2"]
    twice = stored(strings.groupBy(*key).agg(F.count("*").alias("twins")).where("twins > 1").select(key), "suffix-strings")
    hits = strings.where("n = 1").join(twice, key).groupBy("k1", "k2", "at").agg(F.max("before").alias("most"), F.min("before").alias("least"))
    frequent = hits.select("k1", "k2", (F.col("at") - F.col("most")).alias("low"), (F.col("at") - F.col("least") + length).alias("high"))
    return whole.union(usual).union(frequent)


def drop_repeated(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 400, core: int | None = None, hot: int = 5000
) -> DataFrame:
    """``docs`` without the bytes that a string of ``length`` bytes covers which also starts anywhere else.

    Texts count as UTF-8 bytes, a null text as empty; strings lie within one document, may overlap, and are judged on the
    texts as given.  The text is replaced by ``kept``, the bytes that stay, joined; beside it ``n_bytes``, ``n_removed``,
    ``n_spans`` (removed runs) and ``removed``, their (start, length) in bytes.  Every occurrence goes, the first too; so do both
    of two equal rows.  A text of fewer than ``length`` bytes stays.  A null ``doc_id`` stays null; other columns are kept unless
    they are named like a result; an empty table gives no rows.

    A row's key is a hash of its id and text, so every job sees the same keys whatever is computed anew; equal rows share
    one.  Cores are named by 64 bits of hash, surroundings within a core by another 64.  Names with more than ``hot`` surroundings
    are settled string by string instead of name by name, with the same result.
    """
    core = core or max(1, length // 4)
    new = ("kept", "n_bytes", "n_removed", "n_spans", "removed")
    names = [c for c in docs.columns if c != text and c.lower() not in new]
    keys = (F.xxhash64(doc_id, text).alias("k1"), F.xxhash64(F.length(text), text, doc_id, F.lit(1)).alias("k2"))
    held = [f"lm kept {k}" for k in range(len(names))]
    keyed = docs.select(*(F.col(c).alias(h) for c, h in zip(names, held, strict=True)), F.col(text).alias("text"), *keys)
    spans = repeated_spans(keyed.select("k1", "k2", "text"), "text", length, core, hot)
    lists = spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    joined = keyed.join(lists, ["k1", "k2"], "left").select(*held, "text", "spans")
    at = len(names)
    pair = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType())])
    schema = T.StructType(
        [docs.schema[c] for c in names]
        + [T.StructField("kept", T.BinaryType(), False)]
        + [T.StructField(c, T.LongType(), False) for c in new[1:4]]
        + [T.StructField("removed", T.ArrayType(pair), False), T.StructField("kept_sha256", T.StringType(), False)]
    )
    kinds = [pa.binary()] + [pa.int64()] * 3 + [pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])), pa.string()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for row in range(0, whole.num_rows, 500):
                batch = whole.slice(row, 500)
                out = [without(_bytes(t), s or [], length) for t, s in zip(*(batch.column(i).to_pylist() for i in (at, at + 1)), strict=True)]
                made = [pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(batch.columns[:at] + made, names=schema.names)

    return joined.mapInArrow(cut, schema)


def without(data: bytes, spans: list[dict[str, int]], length: int) -> tuple:
    """(kept, n_bytes, n_removed, n_spans, removed, digest of kept) for the bytes of one text."""
    n = len(data)
    runs: list[list[int]] = []
    for low, high in sorted((max(0, s["low"]), min(n, s["high"])) for s in spans):
        if high - low < length:
            continue  # surroundings at an end of the text, too short for a string
        if runs and low <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], high)
        else:
            runs.append([low, high])
    ends = [0, *(x for run in runs for x in run), n]
    kept = b"".join(data[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True))
    removed = [{"start": a, "length": b - a} for a, b in runs]
    return kept, n, n - len(kept), len(runs), removed, hashlib.sha256(kept).hexdigest()
