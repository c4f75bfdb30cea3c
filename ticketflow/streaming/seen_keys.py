"""Duplicate flags across landings: keys seen in earlier batches are remembered.

The state under one folder has two tables, each with a folder per batch:

* ``keys``: the distinct keys that the batch brought first, by hash slot;
* ``bits``: for every slot the bits of those keys in a Bloom filter of ``BITS`` bits.

A batch is flagged by what earlier batches have stored and, within itself, by the
skew-safe flag of ``dedup``. Its distinct keys are first looked up in the bits, a
table of a few bytes a key; only keys whose bits are all set are then compared with
the stored keys themselves, so the exact check touches few keys when keys are meant
to be unique. A batch reads only the folders of batches before it and overwrites its
own, so running a batch again changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketflow.operators.dedup import flag_repeats
from ticketflow.operators.joins import broadcast_if_small
from ticketflow.session import scratch_path

# One slot's filter is the bitmap of the built-in bitmap aggregate.
BITS = 32_768
HASHES = 3


def _slot(key: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(0), key), F.lit(slots))


def _positions(key: Column) -> Column:
    """The bits of a key in its slot (places from 0 to BITS - 1)."""
    return F.array(*[F.pmod(F.xxhash64(F.lit(i + 1), key), F.lit(BITS)) for i in range(HASHES)])


def _bit(bits: Column, place: Column) -> Column:
    """Whether the bit at ``place`` of the bitmap is set."""
    byte = F.conv(F.hex(F.substring(bits, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (place % 8).cast("int")) == 1


def bloom_bits(keys: DataFrame) -> DataFrame:
    """``(slot, bits)``: the filter of each slot of ``(slot, key)``, partially aggregated to one bitmap a slot and task."""
    return (keys.select("slot", F.explode(_positions(F.col("key"))).alias("place"))
            .groupBy("slot").agg(F.bitmap_construct_agg("place").alias("bits")))


class SeenKeys:
    """Key state of a series of landings under ``path``.

    ``slots`` is fixed for a state: about ``BITS / 10`` keys a slot keep false hits
    near 2 %. A larger state only makes the prefilter pass more keys, never a wrong flag.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, slots: int = 4096):
        self.spark, self.key, self.slots = spark, key, slots
        self.path = path.rstrip("/")
        spark.createDataFrame([], "slot bigint, key string").write.mode("append").parquet(f"{self.path}/keys/batch=-1")
        spark.createDataFrame([], "slot bigint, bits binary").write.mode("append").parquet(f"{self.path}/bits/batch=-1")

    def _before(self, table: str, batch: int, schema: str) -> DataFrame:
        return (self.spark.read.schema(f"{schema}, batch bigint").parquet(f"{self.path}/{table}")
                .where(F.col("batch") < batch).drop("batch"))

    def _batch_keys(self, rows: DataFrame) -> DataFrame:
        key = F.col(f"`{self.key}`").cast("string")
        return rows.where(key.isNotNull()).select(_slot(key, self.slots).alias("slot"), key.alias("key")).distinct()

    def maybe_seen(self, keys: DataFrame, batch: int) -> DataFrame:
        """Those of ``(slot, key)`` whose bits are all set by batches before ``batch``."""
        bits = (self._before("bits", batch, "slot bigint, bits binary").groupBy("slot")
                .agg(F.bitmap_or_agg("bits").alias("bits")))
        hit = F.forall(_positions(F.col("key")), lambda p: _bit(F.col("bits"), p))
        return keys.join(bits, "slot").where(hit).select("slot", "key")

    def flag(self, rows: DataFrame, batch: int, order: Sequence[str], flag: str) -> DataFrame:
        """``rows`` with ``flag``: the key came in an earlier batch, or earlier in this one. Stores nothing.

        NULL keys are never flagged.
        """
        known = self._known(self._batch_keys(rows), batch)
        inside = flag_repeats(rows, self.key, order, flag)
        known = broadcast_if_small(known.select(F.col("key").alias("__seen")))
        key = F.col(f"`{self.key}`").cast("string")
        return (inside.join(known, key == F.col("__seen"), "left")
                .withColumn(flag, F.col(flag) | F.col("__seen").isNotNull()).drop("__seen"))

    def _known(self, keys: DataFrame, batch: int) -> DataFrame:
        """The keys that earlier batches stored: candidates of the filter, then the exact check, written once."""
        candidates = self._write(self.maybe_seen(keys, batch), "candidates")
        stored = self._before("keys", batch, "slot bigint, key string")
        # the candidates go to the stored keys where they are few, so the state isn't shuffled
        found = stored.join(broadcast_if_small(candidates), ["slot", "key"], "left_semi").distinct()
        return self._write(found, "known")

    def _write(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, f"seen-{name}")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def add(self, rows: DataFrame, batch: int) -> None:
        """Store the keys that ``batch`` brought first, replacing what an earlier run of it stored."""
        keys = self._write(self._batch_keys(rows), "keys")
        new = self._write(keys.join(broadcast_if_small(self._known(keys, batch)), ["slot", "key"], "left_anti"), "new")
        new.write.mode("overwrite").parquet(f"{self.path}/keys/batch={batch}")
        bloom_bits(new).write.mode("overwrite").parquet(f"{self.path}/bits/batch={batch}")


def land_batch(state: SeenKeys, rows: DataFrame, batch: int, order: Sequence[str], flag: str, sink: str) -> None:
    """Flag a batch, write it to its own folder of ``sink`` and remember its keys; a rerun replaces all of it."""
    state.flag(rows, batch, order, flag).write.mode("overwrite").parquet(f"{sink}/batch={batch}")
    state.add(rows, batch)


def batch_writer(state: SeenKeys, order: Sequence[str], flag: str, sink: str) -> Callable[[DataFrame, int], None]:
    """For ``writeStream.foreachBatch``: the batch id decides what came before."""
    def write(rows: DataFrame, batch: int) -> None:
        session = rows.sparkSession
        own = SeenKeys.__new__(SeenKeys)
        own.__dict__.update(state.__dict__, spark=session)
        # the batch is read several times, and its source files only once
        path = scratch_path(session, "seen-batch")
        rows.write.parquet(path)
        land_batch(own, session.read.schema(rows.schema).parquet(path), batch, order, flag, sink)
    return write


def stream_flagged(spark: SparkSession, landing_dir: str, schema: T.StructType, state: SeenKeys, order: Sequence[str],
                   flag: str, sink: str, checkpoint_dir: str, fmt: str = "parquet", files_per_batch: int = 1000) -> None:
    """Flag every not-yet-processed landed file, at most ``files_per_batch`` a batch, in arrival order of the files."""
    stream = (spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_per_batch)
              .option("pathGlobFilter", "part-*").option("recursiveFileLookup", True).load(landing_dir))
    (stream.writeStream.foreachBatch(batch_writer(state, order, flag, sink))
     .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start().awaitTermination())
