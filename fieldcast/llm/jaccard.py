"""Documents whose sets of word shingles are alike: a Jaccard join by prefixes of token combinations, and its components.

Of two sets that reach the threshold the larger one, of n shingles, has at most n - ceil(percent n / 100) that the other lacks,
and the smaller one at most n - ceil(2 percent n / (100 + percent)).  All shingles are ordered from rare to frequent.  A prefix
is long enough when, whatever shingles of that number are lacking, some class keeps as many as it combines: rare shingles
stand alone (k = 1); frequent ones count in combinations of k = 2, very frequent ones of k = 3, within cells of a few
shingles each, and each cell lengthens the prefix by k - 1.  Of two sets, the one whose prefix ends first thus has a combination
in common with the other's prefix, and only sets that meet in one, the one as the smaller and the other as the larger, are
compared.  Sizes of alike sets differ by less than the threshold, so sets are indexed by bands of size: under their own as
the larger, under their own and the next as the smaller; the number of cells follows from the band.

How often a shingle occurs is counted by hash buckets; shingles that occur once are dropped there, and they use up s: a set
with more than s of them has no partner and is not indexed at all.  A shingle that very many documents of one task share
is sent once with a mark instead of with each of them.

Sets that meet are compared with a pivot first, the one with the fewest shingles of its own; what is in one component already
is not compared again, nor what cannot reach the threshold by the numbers of shingles that both sets share with others.  So a
large group of alike documents costs a comparison each, not one for each pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldcast.llm.common import stored
from fieldcast.llm.graph import components
from fieldcast.session import send_with_tasks

send_with_tasks(__name__)

#: Occurrences in one task from which a shingle is marked instead of sent, and the most that is counted.
MANY = 255
#: Occurrences from which k shingles are combined.
CLASSES = ((2, 16), (3, MANY))
#: Shingles a task gathers before it deals them out; rows it may number within 16 bits.
BLOCK, BLOCK_ROWS = 500_000, 60_000
#: Words whose hashes a task remembers; only a matter of memory.
WORDS_AT_ONCE = 150_000
#: Characters of text for each hash bucket.
BUCKET_CHARS = 8_000_000
#: Sets outside a component that are compared with all others they meet at once; more meet further pivots first.
FEW = 2000
SIGNATURES_AT_ONCE = 20_000
ODD = 0x9E3779B97F4A7C15
SMALL, LARGE = 1, 2


class WordHashes(dict):
    """Hashes of the words met so far."""

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh64_intdigest(word, 7)
        return h


class Shingles:
    """Distinct shingles of texts as 64-bit numbers."""

    def __init__(self, words: int) -> None:
        self.words, self.known = words, WordHashes()

    def of(self, text: str | None) -> np.ndarray:
        found = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not found:
            return np.zeros(0, np.uint64)
        if len(self.known) > WORDS_AT_ONCE:
            self.known.clear()
        hashes = np.fromiter(map(self.known.__getitem__, found), np.uint64, len(found))
        width = min(self.words, len(found))
        made = np.full(len(found) - width + 1, width, np.uint64)  # a short sequence is no shingle
        for k in range(width):
            made = made * np.uint64(ODD) + hashes[k : len(found) - width + 1 + k]
        made ^= made >> np.uint64(32)
        made *= np.uint64(0xD6E8FEB86659FD93)
        made ^= made >> np.uint64(29)
        return np.unique(made)


def slack(n: int, percent: int) -> int:
    """How many of its n shingles the larger of two sets that are alike may have alone."""
    return n - -(-percent * n // 100)


def small_slack(n: int, percent: int) -> int:
    """The same for the smaller one."""
    return n - -(-2 * percent * n // (100 + percent))


def band(n: int, percent: int) -> int:
    return int(math.log(n) / _width(percent))


def _width(percent: int) -> float:
    return max(-math.log(percent / 100) * (1 + 1e-9), 1e-9)


def cells(group: int, percent: int) -> int:
    """Cells for frequent shingles of sets in the bands ``group - 1`` and ``group``; 0: all stand alone, as sets are small."""
    least = max(1, int(math.exp((group - 1) * _width(percent))))
    return 0 if least < 8 or percent < 60 else max(1, (slack(least, percent) + 1) // 3)


def signatures(tokens: list[int], counts: list[int], n: int, percent: int) -> dict[int, int]:
    """Combinations of a set's prefixes, as the SMALL one, as the LARGE one or both.

    ``tokens`` are the shared ones by rising (count, token); the other n - len(tokens) occur nowhere else.
    """
    made: dict[int, int] = {}
    lone, own = n - len(tokens), band(n, percent)
    for group, large in ((own, slack(n, percent) + 1 - lone), (own + 1, 0)):
        small = small_slack(n, percent) + 1 - lone
        n_cells, got = cells(group, percent), 0
        held: dict[tuple[int, int], list[int]] = {}
        for token, count in zip(tokens, counts, strict=True):
            role = SMALL * (got < small) | LARGE * (got < large)
            if not role:
                break
            k = max((k for k, least in CLASSES if count >= least), default=1) if n_cells else 1
            cell = held.setdefault((k, token % n_cells if k > 1 else 0), [])
            for rest in combinations(cell, k - 1) if k > 1 else ((),):
                made[hash((group, *rest, token))] = role
            if k > 1:
                cell.append(token)
            got += k == 1 or len(cell) >= k
        if got < max(small, large):
            raise AssertionError("prefix too short for the threshold")
    return made


def similar(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 4, percent: int = 85
) -> DataFrame:
    """Every row of ``docs``, without its text, with ``n_shingles`` and ``component_id``.

    Two rows link when 100 |A & B| >= ``percent`` |A | B| for their sets of ``words``-word shingles (A-Z in lower case, words
    cut at ASCII white space; a text with fewer words is one shingle).  ``component_id`` is the smallest ``doc_id`` that
    links reach, itself included; a null id is never the smallest, and a component without any other gets a null.  Null,
    empty and blank texts have no shingles and link with nothing.  Repeated rows stay and are linked.  Columns named like a
    result are replaced; an empty table gives no rows.  Shingles are compared by 64 bits of hash.
    """
    kept = [c for c in docs.columns if c != text and c.lower() not in ("n_shingles", "component_id")]
    spark = docs.sparkSession
    chars = docs.agg(F.coalesce(F.sum(F.length(text)), F.lit(0))).first()[0]
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), chars // BUCKET_CHARS)
    named = [F.col(c).alias(f"kept {k}") for k, c in enumerate(kept)]
    source = docs.select(*named, F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"))
    table = stored(_with_counts(source, len(kept), words, percent, buckets), "jaccard-documents")

    own = F.col(f"kept {kept.index(doc_id)}")
    inside = table.where("tokens is not null")
    first = stored(inside.groupBy("digest").agg(F.min("row").alias("row")), "jaccard-first")
    sets = stored(inside.join(first.select("row"), "row").select("row", "n", "tokens", "counts"), "jaccard-sets")
    links = _links(sets, percent)
    roots = components(links, "jaccard-stars")
    classes = first.join(roots, first["row"] == roots["node"], "left").select("digest", F.coalesce("root", "row").alias("class"))
    classes = stored(classes, "jaccard-classes")
    best = inside.groupBy("digest").agg(F.min(own).alias("id")).join(classes, "digest").groupBy("class").agg(F.min("id").alias("id"))
    best = stored(classes.join(stored(best, "jaccard-best"), "class").select("digest", "id"), "jaccard-components")
    columns = [F.col(f"kept {k}").alias(c) for k, c in enumerate(kept)] + [F.col("n").alias("n_shingles")]
    linked = inside.join(best, "digest").select(*columns, F.col("id").alias("component_id"))
    alone = table.where("tokens is null").select(*columns, own.alias("component_id"))
    return linked.unionByName(alone)


SET = [("row", T.LongType(), pa.int64()), ("n", T.LongType(), pa.int64()), ("digest", T.BinaryType(), pa.binary())]
#: What is dealt out by hash of the shingle, and then by block: a block's shingles, its rows for them, and counts.
DEALT = [
    ("kind", T.IntegerType(), pa.int32()), ("block", T.LongType(), pa.int64()), ("tokens", T.BinaryType(), pa.binary()),
    ("rows", T.BinaryType(), pa.binary()), ("counts", T.BinaryType(), pa.binary()),
]
DOCUMENT, SINGLE, MARK, MARKED = range(4)


def _with_counts(source: DataFrame, n_kept: int, words: int, percent: int, buckets: int) -> DataFrame:
    """(kept columns, row, n, digest, tokens, counts); the last two only for sets that may have a partner."""
    kept = [T.StructField(f.name, f.dataType) for f in source.schema.fields[:n_kept]]  # null in rows that are no documents
    spec = SET + DEALT
    dealt_out = T.StructType([*kept, *(T.StructField(a, b) for a, b, _ in spec)])
    by_bucket = T.StructType([*dealt_out.fields, T.StructField("bucket", T.IntegerType())])

    def rows_of(parts: list[dict], types: list[pa.DataType]) -> list[pa.Array]:
        """Columns of DEALT rows, after nulls for those of documents."""
        out = [pa.nulls(len(parts), t) for t in [*types, *(k for _, _, k in SET)]]
        return out + [pa.array([p.get(name) for p in parts], kind) for name, _, kind in DEALT]

    def dealt(held: list[tuple[int, np.ndarray]], block: int, types: list[pa.DataType]) -> pa.RecordBatch:
        parts = _dealt(held, block, buckets)
        columns = [*rows_of(parts, types), pa.array([p["bucket"] for p in parts], pa.int32())]
        return pa.RecordBatch.from_arrays(columns, names=by_bucket.names)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        held, block, size = [], None, 0
        for batch in batches:
            types = [c.type for c in batch.columns[:n_kept]]
            rows, n, digests, blocks = batch.column(n_kept).to_pylist(), [], [], []
            for row, text in zip(rows, batch.column(n_kept + 1).to_pylist(), strict=True):
                if block is None or size >= BLOCK or row - block >= BLOCK_ROWS:
                    if held:
                        yield dealt(held, block, types)
                    held, block, size = [], row, 0
                found = shingles.of(text)
                held.append((row - block, found))
                size += len(found)
                n.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()))
                blocks.append(block)
            m = len(rows)
            info = [batch.column(n_kept), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array([DOCUMENT] * m, pa.int32())]
            info += [pa.array(blocks, pa.int64()), *[pa.nulls(m, pa.binary())] * 3, pa.array([r % buckets for r in rows], pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n_kept], *info], names=by_bucket.names)
        if held:
            yield dealt(held, block, types)

    def count(table: pa.Table) -> pa.Table:
        table = table.drop_columns(["bucket"])
        kinds = table.column("kind").to_numpy()
        documents = table.filter(pa.array(kinds == DOCUMENT))
        rest = table.filter(pa.array(kinds != DOCUMENT)).select([name for name, *_ in DEALT]).to_pylist()
        made = pa.Table.from_arrays(rows_of(_counted(rest), table.schema.types[:n_kept]), schema=table.schema)
        return pa.concat_tables([documents, made])

    sets = T.StructType(
        [*kept, *(T.StructField(a, b) for a, b, _ in SET), T.StructField("tokens", T.ArrayType(T.LongType())), T.StructField("counts", T.ArrayType(T.IntegerType()))]
    )

    def gather(table: pa.Table) -> pa.Table:
        kinds = table.column("kind").to_numpy()
        documents = table.filter(pa.array(kinds == DOCUMENT))
        rest = table.filter(pa.array(kinds != DOCUMENT))
        block = table.column("block")[0].as_py()
        tokens, rows, counts = (
            np.frombuffer(b"".join(rest.column(c).to_pylist()), kind) for c, kind in (("tokens", "<u8"), ("rows", "<u2"), ("counts", "u1"))
        )
        order = np.lexsort((tokens, counts, rows))
        tokens, rows, counts = tokens[order].view(np.int64), rows[order], counts[order]
        own, sizes = documents.column("row").to_numpy() - block, documents.column("n").to_numpy()
        begin, end = np.searchsorted(rows, own, "left"), np.searchsorted(rows, own, "right")
        lists = ([], [])
        for a, b, n in zip(begin.tolist(), end.tolist(), sizes.tolist(), strict=True):
            partner = 0 < n and n - (b - a) <= slack(n, percent)
            lists[0].append(tokens[a:b] if partner else None)
            lists[1].append(counts[a:b].astype(np.int32) if partner else None)
        columns = documents.columns[: n_kept + len(SET)]
        return pa.Table.from_arrays(
            [*columns, pa.array(lists[0], pa.list_(pa.int64())), pa.array(lists[1], pa.list_(pa.int32()))], names=sets.names
        )

    return source.mapInArrow(deal, by_bucket).groupBy("bucket").applyInArrow(count, dealt_out).groupBy("block").applyInArrow(gather, sets)


def _dealt(held: list[tuple[int, np.ndarray]], block: int, buckets: int) -> list[dict]:
    """A block's shingles by bucket.  One that is in MANY of its sets is marked in its bucket, and its rows go anywhere."""
    tokens = np.concatenate([t for _, t in held])
    rows = np.repeat(np.array([r for r, _ in held], "<u2"), [len(t) for _, t in held])
    order = np.argsort(tokens, kind="stable")
    tokens, rows = tokens[order], rows[order]
    starts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]])) if len(tokens) else np.zeros(0, int)
    counts = np.diff(np.append(starts, len(tokens)))
    many = np.repeat(counts >= MANY, counts)
    out = []
    marked = tokens[starts[counts >= MANY]] if len(tokens) else tokens
    for kind, some, numbers in ((SINGLE, tokens[~many], rows[~many]), (MARK, marked, None)):
        bucket = (some % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        some, numbers = some[order], None if numbers is None else numbers[order]
        found, at = np.unique(bucket[order], return_index=True)
        for b, i, j in zip(found.tolist(), at.tolist(), [*at.tolist()[1:], len(some)], strict=False):
            part = {"kind": kind, "block": block, "tokens": some[i:j].tobytes(), "bucket": b}
            out.append(part | ({} if numbers is None else {"rows": numbers[i:j].tobytes()}))
    some, numbers = tokens[many], rows[many]
    for k, i in enumerate(range(0, len(some), 20_000)):
        j = i + 20_000
        part = {"kind": MARKED, "block": block, "tokens": some[i:j].tobytes(), "rows": numbers[i:j].tobytes()}
        out.append(part | {"bucket": (block + 1 + k * 31) % buckets})
    return out


def _counted(parts: list[dict]) -> list[dict]:
    """The shingles of a bucket that occur more than once, by block, with the number of rows that have them (MANY at most)."""
    out = [p | {"counts": np.full(len(p["rows"]) // 2, MANY, "u1").tobytes()} for p in parts if p["kind"] == MARKED]
    single = [p for p in parts if p["kind"] == SINGLE]
    if not single:
        return out
    marks = np.unique(np.frombuffer(b"".join(p["tokens"] for p in parts if p["kind"] == MARK), "<u8"))
    tokens = np.frombuffer(b"".join(p["tokens"] for p in single), "<u8")
    rows = np.frombuffer(b"".join(p["rows"] for p in single), "<u2")
    blocks = np.repeat([p["block"] for p in single], [len(p["rows"]) // 2 for p in single])
    order = np.argsort(tokens, kind="stable")
    ordered = tokens[order]
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    sizes = np.diff(np.append(starts, len(ordered)))
    total = np.minimum(sizes, MANY)
    total[np.isin(ordered[starts], marks)] = MANY
    counts = np.empty(len(tokens), "u1")
    counts[order] = np.repeat(total, sizes)
    shared = np.flatnonzero(counts > 1)
    shared = shared[np.argsort(blocks[shared], kind="stable")]
    found, at = np.unique(blocks[shared], return_index=True)
    for block, i, j in zip(found.tolist(), at.tolist(), [*at.tolist()[1:], len(shared)], strict=False):
        some = shared[i:j]
        out.append({"kind": SINGLE, "block": block, "tokens": tokens[some].tobytes(), "rows": rows[some].tobytes(), "counts": counts[some].tobytes()})
    return out


def _links(sets: DataFrame, percent: int) -> DataFrame:
    """Enough links (src, dst: row) between different sets for the components to be those of all links.

    Sets that meet in a combination are compared with 1, 2, 4, ... pivots in one round after the other.  After each round
    meetings within one component are over; where at most FEW sets lie outside the largest component, these are
    compared with all they may have met, which is once for all combinations that they share.
    """
    names = ["sig", "row", "n", "shared", "role"]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[list[int]] = [[] for _ in names]
        for batch in batches:
            for at in range(batch.num_rows):  # a set at a time: its shingles as Python numbers take many times their room
                row, n, tokens, counts = (c[at].as_py() for c in batch.columns)
                found = signatures(tokens, counts, n, percent)
                for column, values in zip(made, (found, [row] * len(found), [n] * len(found), [len(tokens)] * len(found), found.values()), strict=True):
                    column += values
                if len(made[0]) > SIGNATURES_AT_ONCE:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in made], names=names)
                    made = [[] for _ in names]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in made], names=names)

    signed = stored(sets.mapInArrow(sign, ", ".join(f"{c} long" for c in names)), "jaccard-signatures")
    meets = signed.groupBy("sig").agg(F.count("*").alias("size")).where("size > 1").select("sig")
    now = signed.join(stored(meets, "jaccard-meets"), "sig").withColumn("root", F.col("row"))
    now = stored(now, "jaccard-index")
    links, turn = [], 0
    while True:
        fields = ("row", "n", "shared", "role", "root")
        salt = F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(1 << min(turn, 30))).alias("salt")
        key = F.struct(((F.col("n") - F.col("shared")) / F.col("n")).alias("own"), *fields)
        chosen = now.groupBy("sig", salt).agg(F.min(key).alias("p"))
        chosen = stored(chosen.select("sig", *(F.col(f"p.{c}").alias(f"p_{c}") for c in fields)), "jaccard-pivots")
        links.append(_linked(now.join(chosen, ["sig"]).where(_may_link(percent) & _roles()), sets, percent))

        roots = components(_all(links), "jaccard-stars")
        left = now.drop("root").join(chosen.select("sig", F.col("p_row").alias("row")), ["sig", "row"], "left_anti")
        left = left.join(roots.withColumnRenamed("node", "row"), "row", "left").withColumn("root", F.coalesce("root", "row"))
        left = stored(left, "jaccard-left")
        left = stored(_apart(left).drop("major"), "jaccard-left")
        left = stored(_apart(_still_shared(left, sets, percent)), "jaccard-left")
        if left.isEmpty():
            return _all(links)
        # meetings with one largest component are looked at together; the few outside it are compared with all of them
        fields = ("row", "n", "shared", "root")
        gathered = stored(left.select("major", *fields).distinct(), "jaccard-gathered")
        outside = gathered.where("root <> major")
        settled = outside.groupBy("major").agg(F.count("*").alias("outside")).where(F.col("outside") <= FEW).select("major")
        settled = stored(settled, "jaccard-settled")
        few = stored(outside.join(settled, "major").select("major", *(F.col(c).alias(f"p_{c}") for c in fields)), "jaccard-few")
        once = (F.col("root") == F.col("major")) | (F.col("row") > F.col("p_row"))
        links.append(_linked(gathered.join(few, ["major"]).where(_may_link(percent) & once), sets, percent))
        now = stored(left.join(settled, "major", "left_anti").drop("major"), "jaccard-index")
        if now.isEmpty():
            return _all(links)
        turn += 1


def _apart(left: DataFrame) -> DataFrame:
    """The meetings of sets in several components, each with the largest of these as ``major``."""
    by_root = left.groupBy("sig", "root").agg(F.count("*").alias("c"))
    major = by_root.groupBy("sig").agg(F.max(F.struct("c", "root")).alias("m"), F.count("*").alias("roots"))
    return left.join(stored(major.where("roots > 1").select("sig", F.col("m.root").alias("major")), "jaccard-meets"), "sig")


def _still_shared(left: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``left`` with ``shared`` counting only shingles that sets of several of its components have.

    No set outside a set's component can have more than these in common with it; a set with too few of them is done.
    """
    rows = left.select("row", "root").distinct().join(sets.select("row", "tokens"), "row")
    held = stored(rows.select("row", "root", F.explode("tokens").alias("token")), "jaccard-shingles")
    across = held.groupBy("token").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a < b").select("token")
    shared = held.join(stored(across, "jaccard-across"), "token").groupBy("row").agg(F.count("*").alias("shared"))
    return left.drop("shared").join(stored(shared, "jaccard-shared"), "row").where(F.col("shared") * 100 >= F.col("n") * percent)


def _linked(met: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    pair = met.select(F.greatest("row", "p_row").alias("src"), F.least("row", "p_row").alias("dst")).distinct()
    return stored(_alike(stored(pair, "jaccard-pairs"), sets, percent), "jaccard-links")


def _may_link(percent: int) -> Column:
    """Whether a set and another may reach the threshold by their numbers, and are not in one component yet."""
    n, m = F.col("n"), F.col("p_n")
    sizes = F.least(n, m) * 100 >= F.greatest(n, m) * percent
    most = F.least("shared", "p_shared") * (100 + percent) >= (n + m) * percent
    return sizes & most & (F.col("root") != F.col("p_root")) & (F.col("row") != F.col("p_row"))


def _roles() -> Column:
    """Whether the smaller of two sets that meet does so as the smaller one, and the other as the larger."""
    n, m, role, of = F.col("n"), F.col("p_n"), F.col("role"), F.col("p_role")
    first = (n <= m) & (role.bitwiseAND(SMALL) > 0) & (of.bitwiseAND(LARGE) > 0)
    return first | ((m <= n) & (of.bitwiseAND(SMALL) > 0) & (role.bitwiseAND(LARGE) > 0))


def _all(links: list[DataFrame]) -> DataFrame:
    out = links[0]
    for more in links[1:]:
        out = out.union(more)
    return out


def _alike(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs of rows whose sets reach the threshold; shingles of one set alone are in no intersection."""
    a = sets.select(F.col("row").alias("src"), F.col("n").alias("a_n"), F.col("tokens").alias("a"))
    b = sets.select(F.col("row").alias("dst"), F.col("n").alias("b_n"), F.col("tokens").alias("b"))
    both = F.size(F.array_intersect("a", "b")).cast("long")
    found = pairs.join(a, "src").join(b, "dst").withColumn("both", both)
    return found.where(F.col("both") * 100 >= (F.col("a_n") + F.col("b_n") - F.col("both")) * percent).select("src", "dst")


def similar_sql(table: str, words: int, percent: int) -> str:
    """The same rows in DuckDB's SQL, over a table with unique ``doc_id``, for groups of few documents."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\\x20\\x09-\\x0D]+') AS w FROM {table}
),
places AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {words - 1}, 1) + 1)) AS i FROM docs WHERE len(w) > 0),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + {words - 1}], ' ') || least(len(w), {words}) AS s FROM places),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= {percent} * (p.n + q.n - c)
),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached AS (SELECT x, y FROM both_ways UNION SELECT r.x, b.y FROM reached r JOIN both_ways b ON b.x = r.y),
least_reached AS (SELECT x, min(y) AS y FROM reached GROUP BY x)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, least(d.doc_id, r.y) AS component_id
FROM docs d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least_reached r ON r.x = d.doc_id
"""
