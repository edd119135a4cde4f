"""Tables that are merged by key and rewrite only the files that may hold a key of the batch.

A table is dealt by hash of its key into buckets, the parts of a committed table, and a bucket's versions are its files' folders.
Beside each version lies an index: blocked Bloom filters, bitmaps of 32,768 bits of which every key sets PROBES in one block.
A merge asks the index of the touched buckets first.  Versions that may hold a key are read, merged and replaced; where none may, the
batch's rows become a further version beside the others, and nothing stored is read or written again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldcast.operators.commits import CommittedTable, folder_name
from fieldcast.operators.merge import merge_replace, upsert
from fieldcast.session import delete, scratch_path

BUCKET = "key_bucket"
BITS = 32_768
PROBES = 3
#: versions of a bucket from which a merge writes it anew as one
MANY_VERSIONS = 8

Merge = Callable[[DataFrame, DataFrame, list[str], list[str]], DataFrame]


@dataclass
class Merged:
    """What a merge did: its commit, how many versions it replaced, how many buckets got a further version only."""

    commit: int
    replaced: int
    appended: int


class KeyedTable:
    """One table of ``columns`` below ``path``, keyed by ``keys``; ``buckets`` and ``blocks`` (of the filters of one bucket) are fixed at its start.

    A bucket should hold no more than a task can merge, and ``blocks`` about 4,000 keys a block.
    """

    def __init__(
        self, spark: SparkSession, path: str, keys: list[str], columns: list[str], buckets: int = 256, blocks: int = 16, keep: int = 3
    ):
        self._spark, self._path, self._keys, self._columns = spark, path.rstrip("/"), keys, columns
        self._buckets, self._blocks = buckets, blocks
        self._table = CommittedTable(spark, path, keep=keep)

    def read(self) -> DataFrame:
        rows = self._table.read()
        if rows is None:
            raise FileNotFoundError(self._path)
        return rows.select(self._columns)

    def files(self) -> int:
        """Versions of all buckets."""
        return sum(len(v) for v in self._table.segments().values())

    def replace(self, batch: DataFrame, order: list[str]) -> Merged:
        """Stored rows whose key the batch has go, then the batch's first row of each key comes in (:func:`merge_replace`)."""
        return self._merge(batch, order, merge_replace)

    def upsert(self, batch: DataFrame, order: list[str]) -> Merged:
        """The batch's rows win; columns it lacks keep their stored value (:func:`merge.upsert`)."""
        return self._merge(batch, order, upsert)

    def _hash(self, seed: int) -> Column:
        return F.xxhash64(F.lit(seed), *self._keys)

    def _bucket(self) -> Column:
        # text, as parts are; NULL keys match nothing and lie where their hash says
        return F.lpad(F.pmod(self._hash(1), F.lit(self._buckets)).cast("string"), 6, "0")

    def _probes(self, rows: DataFrame) -> DataFrame:
        """(bucket, block, bits): where a key's bits are."""
        bits = F.array(*(F.pmod(self._hash(3 + k), F.lit(BITS)) for k in range(PROBES)))
        return rows.select(F.col(BUCKET), F.pmod(self._hash(2), F.lit(self._blocks)).alias("block"), bits.alias("bits"))

    def _merge(self, batch: DataFrame, order: list[str], merge: Merge) -> Merged:
        staged = scratch_path(self._spark, "keyed-batch")
        batch.withColumn(BUCKET, self._bucket()).write.parquet(staged)
        batch = self._spark.read.parquet(staged)
        now = self._table.segments()
        touched = [r[0] for r in batch.select(BUCKET).distinct().collect()]  # buckets at most
        hit = {(b, v) for b in touched if len(now.get(b, ())) >= MANY_VERSIONS for v in now[b]}
        hit |= self._may_hold(batch, [(b, v) for b in touched for v in now.get(b, ()) if (b, v) not in hit])
        stored = self._table.read(only=hit)
        if stored is None:
            whole = self._table.read()
            stored = (batch if whole is None else whole).limit(0)
        merged = merge(stored.select(self._columns), batch.drop(BUCKET), self._keys, order).withColumn(BUCKET, self._bucket())
        written = self._table.write(merged.hint("rebalance", BUCKET), BUCKET)
        self._index(written.version, written.parts)
        commit = self._table.publish(written, hit)
        self._table.remove_unused("index")
        delete(self._spark, staged)
        return Merged(commit, len(hit), len(written.parts - {b for b, _ in hit}))

    def _index(self, version: str, parts: set[str | None]) -> None:
        """Filters of a version's buckets, from what was written."""
        if not parts:
            return
        data = f"{self._path}/data"
        rows = self._spark.read.option("basePath", data).parquet(*(f"{data}/lot={folder_name(p)}/version={version}" for p in sorted(parts)))
        bits = self._probes(rows.select(BUCKET, *self._keys)).select(BUCKET, "block", F.explode("bits").alias("bit"))
        filters = bits.groupBy(BUCKET, "block").agg(F.expr("bitmap_construct_agg(bitmap_bit_position(bit + 1))").alias("filter"))
        filters.coalesce(max(1, len(parts) // 64)).write.parquet(f"{self._path}/index/{version}")

    def _may_hold(self, batch: DataFrame, asked: list[tuple[str | None, str]]) -> set[tuple[str | None, str]]:
        """Those of the (bucket, version) whose filter holds all bits of a key of the batch."""
        versions = sorted({v for _, v in asked})
        if not versions:
            return set()
        index = None
        for v in versions:
            one = self._spark.read.parquet(f"{self._path}/index/{v}").withColumn("version", F.lit(v))
            index = one if index is None else index.union(one)
        keyed = batch.select(BUCKET, *self._keys).dropna(subset=self._keys).distinct()
        met = self._probes(keyed).join(index, [BUCKET, "block"])
        byte = "conv(hex(substring(filter, cast(b div 8 as int) + 1, 1)), 16, 10)"
        every = F.expr(f"forall(bits, b -> shiftright(cast({byte} as int), cast(b % 8 as int)) & 1 = 1)")
        found = met.where(every).select(BUCKET, "version").distinct().collect()  # versions of touched buckets at most
        return {tuple(r) for r in found} & set(asked)
