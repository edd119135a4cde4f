"""Near-duplicate documents by SimHash fingerprints and pigeonring filtering.

The pigeonring principle: cut a fingerprint of 64 bits into a ring of m = d + 1 segments.  If two
fingerprints differ in at most d bits, then on some start every chain of 1, 2, ... m consecutive segments
stays within its share of the budget, that is at most floor(l * d / m) differing bits in the first l.  For
d = 4 the budgets are 0, 1, 2, 3, 4.  Chains of the first two segments (equal, then at most one bit)
are found by an equality join; the longer chains are tested on those candidates, and what is left
gets the full Hamming check.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldcast.llm.common import each_text, stored
from fieldcast.llm.graph import components
from fieldcast.session import send_with_tasks

send_with_tasks(__name__)

BITS = 64


def fingerprint(text: str | None, words: int) -> int:
    """SimHash of one text as a signed 64-bit integer; a text without words has 0."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    n = max(1, len(found) - words + 1)
    ends = list(accumulate(len(w) + 1 for w in found))
    starts = [0, *ends]
    digest = xxhash.xxh64_intdigest
    last = min(words, len(found)) - 1
    hashes = np.array([digest(joined[starts[i] : ends[i + last] - 1], 42) for i in range(n)], dtype=">u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 8192):
        part = hashes[at : at + 8192]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, text: str = "text", words: int = 4) -> DataFrame:
    """``docs`` with a column ``fp``.  Words are cut at ASCII white space and A-Z lower-cased."""

    def make():
        return lambda texts: [[fingerprint(t, words) for t in texts]]

    return each_text(docs, F.col(text), make, [T.StructField("fp", T.LongType(), False)])


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """(shift, width) of the segments of the ring, from the lowest bits up."""
    m = max_bits + 1
    widths = [BITS // m + (i < BITS % m) for i in range(m)]
    return list(zip([0, *accumulate(widths)], widths, strict=False))


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask


def links(prints: DataFrame, max_bits: int = 4) -> DataFrame:
    """Pairs (src < dst) of different values of ``fp`` that differ in at most ``max_bits`` bits, each once.

    Every fingerprint is kept once under each of the m chain starts (the values of segments i and i + 1)
    and asks at its own key and at those with one bit of segment i + 1 turned: for 4 bits, 5 rows kept
    and 70 asked.  A key of 25 or 26 bits is chosen by several fingerprints only if they are alike.  Chain
    budgets and the Hamming check are conditions of the join, so that it puts out links only.  Spark takes
    an exploded table to be as small as what it was made from, so the join is a sorted one at every size.
    """
    ring = _segments(max_bits)
    m = len(ring)
    if max_bits >= BITS // 2:
        raise ValueError("max_bits must be below 32")
    if m == 1:
        return prints.select(F.col("fp").alias("src"), F.col("fp").alias("dst")).where("false")
    one = prints.select("fp").distinct()

    def part(i: int) -> Column:
        shift, width = ring[i % m]
        return F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1).cast("long"))

    def key(i: int, flip: int) -> Column:
        after = part(i + 1).bitwiseXOR(F.lit(flip).cast("long")) if flip else part(i + 1)
        packed = F.shiftleft(part(i), ring[(i + 1) % m][1]).bitwiseOR(after)
        return packed.bitwiseOR(F.lit(i << 56).cast("long"))

    keep = F.array(*(key(i, 0) for i in range(m)))
    # the first two segments of a chain may differ in floor(2 d / m) = 1 bit, the first of them in none
    ask = F.array(*(key(i, flip) for i in range(m) for flip in [0, *(1 << b for b in range(ring[(i + 1) % m][1]))]))
    kept = one.select(F.explode(keep).alias("key"), F.col("fp").alias("src"))
    asked = one.select(F.explode(ask).alias("key"), F.col("fp").alias("dst"))

    differing = F.col("src").bitwiseXOR(F.col("dst"))
    start = F.shiftrightunsigned("key", 56)
    within: Column | None = None
    for i in range(m):
        mask, chain = 0, F.lit(True)
        for size in range(1, m + 1):
            shift, width = ring[(i + size - 1) % m]
            mask |= ((1 << width) - 1) << shift
            if size > 2:
                chain = chain & (F.bit_count(differing.bitwiseAND(F.lit(_signed(mask)))) <= size * max_bits // m)
        test = (start != i) | chain
        within = test if within is None else within & test
    found = kept.hint("merge").join(asked.hint("merge"), "key").where(
        (F.col("src") < F.col("dst")) & (F.bit_count(differing) <= max_bits) & within
    )
    return found.select("src", "dst").distinct()


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 4, max_bits: int = 4
) -> DataFrame:
    """Every row of ``docs``, without its text, with ``fp`` and ``component_id``.

    ``component_id`` is the smallest ``doc_id`` among the documents reachable over links, itself included.
    Null and empty texts have fingerprint 0 and are linked like any other; a null ``doc_id`` is never
    the smallest, and a component that has no other id gets a null ``component_id``.  Repeated rows stay
    repeated.  Columns named ``fp`` or ``component_id`` are replaced.  Empty input gives no rows.
    """
    kept = [c for c in docs.columns if c != text and c.lower() not in ("fp", "component_id")]
    table = stored(fingerprints(docs, text, words).select(*kept, "fp"), "simhash-prints")
    best = stored(_best(table, doc_id, max_bits), "simhash-components")
    return table.join(best.select("fp", F.col("best.id").alias("component_id")), "fp").select(*kept, "fp", "component_id")


def one_of_each(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 4, max_bits: int = 4
) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest ``doc_id`` (nulls last), of equal ids one row.

    Which of several rows with the same id stays is open.  Nothing else changes; empty input gives no rows.
    """
    numbered = docs.select(*(F.col(c).alias(f"lm {c}") for c in docs.columns), F.monotonically_increasing_id().alias("row"))
    table = stored(fingerprints(numbered, f"lm {text}", words), "simhash-documents")
    best = _best(table, f"lm {doc_id}", max_bits, F.col("row"))
    # the rows that go are fewer than those that stay, and only their numbers meet the texts; they grow with the
    # documents, so the join is a sorted one at every size
    best = best.select("fp", F.col("best.row").alias("first"))
    gone = stored(table.select("row", "fp").join(best, "fp").where("row <> first").select("row"), "simhash-gone")
    return table.join(gone.hint("merge"), "row", "left_anti").select(*(F.col(f"lm {c}").alias(c) for c in docs.columns))


def _best(table: DataFrame, doc_id: str, max_bits: int, row: Column | None = None) -> DataFrame:
    """(fp, best: struct(no_id, id, row)) for each fingerprint; best is the first document of its component."""
    root = stored(components(links(table, max_bits), "simhash-stars"), "simhash-roots")
    first = F.struct(
        F.col(doc_id).isNull().alias("no_id"), F.col(doc_id).alias("id"), (F.lit(0) if row is None else row).alias("row")
    )
    own = table.groupBy("fp").agg(F.min(first).alias("own"))
    own = own.join(root, own["fp"] == root["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "own")
    own = stored(own, "simhash-own")
    # written before it is joined, so that a root that very many fingerprints have can be split
    best = stored(own.groupBy("root").agg(F.min("own").alias("best")), "simhash-best")
    return own.join(best, "root").select("fp", "best")
