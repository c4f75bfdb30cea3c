"""Duplicate-key detection and removal that stay balanced under skew.

``flag_repeats`` marks every occurrence of a key after the first one in a
declared order. A plain ``row_number() OVER (PARTITION BY key …)`` puts all
rows of a key into one task, so one key (or one group of identical copies)
holding a third of the data would sit in a single task. The hot groups are
therefore split off:

1. a key census — one aggregate, partially combined map-side, shuffling
   keys only — counts keys above a hot threshold. The caller may have it
   written (``keep``), since several parts of the plan read it;
2. cold keys (at most ``threshold`` rows each) use the window;
3. rows of hot keys never shuffle by key: the first row of each hot key is
   a partially-aggregated ``min`` of a sort struct; rows that differ from it are
   repeats outright, and the exact copies of it are collapsed to one
   ``(row, copies)`` row and regenerated in chunks spread over tasks (one copy
   stays unflagged). First rows meet their key's rows in an inner join, which
   Spark broadcasts below its byte threshold and else splits where it is skewed.

When few keys repeat at all (keys are meant to be unique) and the measured
bytes of the repeated keys are within a bound, these are broadcast and only
their rows are shuffled; rows of single keys are settled where they are. Where they
are too many for that, filter bits of the repeated keys are broadcast instead, a
few bits a key: rows whose bit is not set have a single key, and only the others, among
them a few of single keys, are shuffled. With no hot key only the window runs. ``dedup_first`` keeps one row per key through a
``min`` aggregate over rows dealt by key; hot keys are aggregated where their rows lie first.

Rows dealt by key go to as many tasks as their counted number asks for, so that what
a task sorts does not grow with the input and nothing is spilled.

The sort struct compares like ``ORDER BY o1 NULLS LAST, …`` and then every
other column, so results do not depend on partitioning or arrival order. Maps
take part as their sorted entries; a map inside another type has no order and
is refused whatever the data.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketflow.session import tasks_for

# Bytes reckoned for a broadcast key besides its text.
KEY_OVERHEAD_BYTES = 48
# Hot keys up to which they are broadcast when one row of each is kept.
MAX_HOT_KEYS = 100_000
# Filter bits of repeated keys: bits in a block (a row of the broadcast), bits for a key where
# there is room, bytes of memory that a block takes besides its bits, and the largest share of
# rows left to shuffle for which reading the input twice pays.
BLOCK_BITS = 1024
BITS_PER_KEY = 8
BLOCK_OVERHEAD_BYTES = 80
MAX_LEFT_SHARE = 0.6


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _has_map(t: T.DataType) -> bool:
    if isinstance(t, T.MapType):
        return True
    if isinstance(t, T.ArrayType):
        return _has_map(t.elementType)
    return isinstance(t, T.StructType) and any(_has_map(f.dataType) for f in t.fields)


def check_orderable(df: DataFrame) -> None:
    """Every column must have an order: maps only at the top, of orderable parts."""
    for f in df.schema.fields:
        parts = [f.dataType.keyType, f.dataType.valueType] if isinstance(f.dataType, T.MapType) else [f.dataType]
        if any(_has_map(p) for p in parts):
            raise TypeError(f"column {f.name!r} holds a map inside another type, which has no order")


def _comparable(f: T.StructField) -> Column:
    return F.array_sort(F.map_entries(_q(f.name))) if isinstance(f.dataType, T.MapType) else _q(f.name)


def _original(f: T.StructField, c: Column) -> Column:
    return F.map_from_entries(c) if isinstance(f.dataType, T.MapType) else c


def sort_struct(df: DataFrame, order: Sequence[str]) -> Column:
    """Struct that orders like ``ORDER BY o1 NULLS LAST, …, rest…`` over every column."""
    by_name = {f.name: f for f in df.schema.fields}
    fields: list[Column] = []
    for i, c in enumerate(order):
        fields += [_q(c).isNull().alias(f"_n{i}"), _comparable(by_name[c]).alias(f"_o{i}")]
    rest = [f for f in df.schema.fields if f.name not in order]
    return F.struct(*fields, *[_comparable(f).alias(f"_r{j}") for j, f in enumerate(rest)])


def from_sort_struct(df: DataFrame, order: Sequence[str], struct: str) -> list[Column]:
    """The columns of ``df`` rebuilt from its sort struct."""
    rest = [f.name for f in df.schema.fields if f.name not in order]
    at = {**{c: f"_o{i}" for i, c in enumerate(order)}, **{c: f"_r{j}" for j, c in enumerate(rest)}}
    return [_original(f, F.col(f"{struct}.{at[f.name]}")).alias(f.name) for f in df.schema.fields]


def _window_order(df: DataFrame, order: Sequence[str]) -> list[Column]:
    by_name = {f.name: f for f in df.schema.fields}
    names = [*order, *[f.name for f in df.schema.fields if f.name not in order]]
    return [_comparable(by_name[c]).asc_nulls_last() for c in names]


def hot_threshold(total: int, hot_over: int, max_hot_keys: int, n_hot: int) -> int:
    """Rows per key above which a key is hot, so that at most ``max_hot_keys``
    keys are hot (their rows sum to at most ``total``)."""
    if n_hot <= max_hot_keys:
        return hot_over
    return max(hot_over, -(-total // max_hot_keys))


def key_census(df: DataFrame, key: str) -> DataFrame:
    """Rows of every key; those without a key are one group, ``__hk`` NULL."""
    return df.groupBy(_q(key).alias("__hk")).agg(F.count(F.lit(1)).alias("__n"))


def filter_blocks(repeated: int, max_bytes: int) -> int:
    """Blocks of filter bits for so many keys, within ``max_bytes``."""
    return min(-(-repeated * BITS_PER_KEY // BLOCK_BITS), max_bytes // (BLOCK_BITS // 8 + BLOCK_OVERHEAD_BYTES))


def left_share(rows: int, rep_rows: int, repeated: int, blocks: int) -> float:
    """Expected share of rows whose filter bit is set: those of repeated keys, and single keys that meet a bit of theirs."""
    if not blocks:
        return 1.0
    return (rep_rows + (rows - rep_rows) * -math.expm1(-repeated / (blocks * BLOCK_BITS))) / rows


def _hashes_as_it_groups(t: T.DataType) -> bool:
    """Whether equal keys have equal hashes: not so for texts of a collation."""
    return isinstance(t, T.IntegralType) or t == T.StringType()


def split_by_bits(df: DataFrame, key: str, repeated: DataFrame, blocks: int, n_repeated: int) -> tuple[DataFrame, DataFrame]:
    """Rows of ``df`` whose key has a filter bit of the keys ``__hk`` of ``repeated`` set, and the others.

    Every row of these keys is among the first; rows without a key are among the others.
    A key's bit is in one of ``blocks`` blocks, of words of 64 bits.
    """
    def placed(rows: DataFrame, c: Column) -> DataFrame:
        place = F.pmod(F.xxhash64(c), F.lit(blocks * BLOCK_BITS))
        return rows.withColumns({"__block": F.floor(place / BLOCK_BITS), "__word": F.floor(place % BLOCK_BITS / 64).cast("int"),
                                 "__bit": (place % 64).cast("int")})

    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    words = [F.coalesce(F.bit_or(F.when(F.col("__word") == i, F.call_function("shiftleft", one, F.col("__bit")))), none)
             for i in range(BLOCK_BITS // 64)]
    # dealt by block first: else a task would send a row of words for almost every key
    bits = (placed(repeated, F.col("__hk")).select(F.col("__block").alias("__of"), "__word", "__bit")
            .repartition(tasks_for(df.sparkSession, n_repeated), "__of").groupBy("__of").agg(F.array(*words).alias("__words")))
    seen = placed(df, _q(key)).join(F.broadcast(bits), F.col("__block") == F.col("__of"), "left")  # bounded by ``blocks``
    is_set = _q(key).isNotNull() & F.coalesce(F.getbit(F.get("__words", F.col("__word")), F.col("__bit")) == 1, F.lit(False))
    return seen.where(is_set).select(*[_q(c) for c in df.columns]), seen.where(~is_set).select(*[_q(c) for c in df.columns])


def _cold_flags(df: DataFrame, key: str, order: Sequence[str], flag: str, rows: int) -> DataFrame:
    """Window flag. NULL keys are never repeats; they are spread over tasks by
    a content hash instead of forming one NULL group. ``rows`` of ``df`` decide
    over how many tasks they are dealt."""
    k = _q(key)
    spread = F.when(k.isNull(), F.xxhash64(*[_comparable(f) for f in df.schema.fields]))
    # computed once, as columns, so that the window finds the rows dealt as it needs them
    dealt = (df.withColumns({"__null": k.isNull(), "__spread": spread})
             .repartition(tasks_for(df.sparkSession, rows), F.col("__null"), F.col("__spread"), k))
    w = Window.partitionBy("__null", "__spread", k).orderBy(*_window_order(df, order))
    return dealt.withColumn(flag, k.isNotNull() & (F.row_number().over(w) > 1)).drop("__null", "__spread")


def _hot_flags(df: DataFrame, key: str, order: Sequence[str], flag: str,
               chunk_rows: int) -> DataFrame:
    s = df.withColumn("__s", sort_struct(df, order))
    firsts = s.groupBy(_q(key).alias("__fk")).agg(F.min("__s").alias("__f"))
    m = s.join(firsts, _q(key) == F.col("__fk"), "inner")
    repeats = m.where(F.col("__s") != F.col("__f")).select(*[_q(c) for c in df.columns],
                                                           F.lit(True).alias(flag))
    copies = (m.where(F.col("__s") == F.col("__f"))
              .groupBy("__fk", "__s").agg(F.count(F.lit(1)).alias("__copies")))
    n = F.col("__copies")
    chunks = (copies.withColumn("__chunk", F.explode(F.sequence(
                  F.lit(0).cast("long"), F.floor((n - 1) / chunk_rows).cast("long"))))
              .repartition("__chunk", "__fk"))
    lo = F.col("__chunk") * chunk_rows + 1
    hi = F.least(n, (F.col("__chunk") + 1) * chunk_rows)
    regen = (chunks.withColumn("__copy", F.explode(F.sequence(lo, hi)))
             .select(*from_sort_struct(df, order, "__s"), (F.col("__copy") > 1).alias(flag)))
    return repeats.unionByName(regen)


def _window_flags(df: DataFrame, key: str, order: Sequence[str], flag: str, rows: int, chunk_rows: int,
                  hot_keys: DataFrame | None) -> DataFrame:
    """Flags of rows that go through the window, those of ``hot_keys`` (if any) split off."""
    if hot_keys is None:
        return _cold_flags(df, key, order, flag, rows)
    tagged = df.join(hot_keys, _q(key) == F.col("__hk"), "left")
    cold = tagged.where(F.col("__hk").isNull()).drop("__hk")
    hot = tagged.where(F.col("__hk").isNotNull()).drop("__hk")
    return _cold_flags(cold, key, order, flag, rows).unionByName(
        _hot_flags(hot, key, order, flag, chunk_rows))


def flag_repeats(df: DataFrame, key: str, order: Sequence[str], flag: str,
                 hot_over: int = 1_000_000, max_hot_keys: int = 100_000,
                 chunk_rows: int = 100_000, max_repeated_keys: int = 1_000_000,
                 max_repeated_share: float = 0.25,
                 broadcast_max_bytes: int = 64 * 1024 * 1024,
                 keep: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """Add boolean ``flag``: the row's key already occurred earlier in ``order``.

    Every occurrence after the first is flagged; the first is not, whatever
    else is wrong with it. NULL keys are never flagged. Runs one census job
    (a few scalars reach the driver) to choose the plan:

    * no key occurs twice: nothing to shuffle, the flag is false;
    * at most ``max_repeated_keys`` keys, of at most ``broadcast_max_bytes`` in
      all, occur twice and their rows are at most ``max_repeated_share`` of all
      rows (the usual case — keys are meant to be unique): those keys are
      broadcast (rows and bytes counted by the census);
      rows of single keys are settled without a shuffle and only rows of
      repeated keys go through the window / hot-key paths. This reads the
      input twice, so it is chosen only when it spares most of the shuffle;
    * filter bits of the repeated keys, of at most ``broadcast_max_bytes``, are expected
      to leave at most ``MAX_LEFT_SHARE`` of the rows: the others are settled without a
      shuffle, these go through the window / hot-key paths;
    * otherwise every row goes through the window, hot keys split off.
    """
    check_orderable(df)
    census = key_census(df, key)
    if keep is not None:
        census = keep(census, "key_census")
    key_bytes = F.octet_length(F.col("__hk").cast("string")) + F.lit(KEY_OVERHEAD_BYTES)
    n = F.when(F.col("__hk").isNotNull(), F.col("__n"))  # rows without a key are in no group
    st = census.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(n), F.lit(0)).alias("total"),
                    F.count_if(n > 1).alias("repeated"),
                    F.coalesce(F.sum(F.when(n > 1, n)), F.lit(0)).alias("rep_rows"),
                    F.coalesce(F.sum(F.when(n > 1, key_bytes)), F.lit(0)).alias("rep_bytes"),
                    F.count_if(n > hot_over).alias("hot")).first()
    census = census.where(F.col("__hk").isNotNull())
    rows, total, n_rep, n_hot = int(st["rows"]), int(st["total"]), int(st["repeated"]), int(st["hot"])
    if n_rep == 0:
        return df.withColumn(flag, F.lit(False))
    limit = hot_threshold(total, hot_over, max_hot_keys, n_hot)
    if (n_rep <= max_repeated_keys and int(st["rep_bytes"]) <= broadcast_max_bytes
            and int(st["rep_rows"]) <= max_repeated_share * total):
        rep = F.broadcast(census.where(F.col("__n") > 1)  # rows and bytes counted above
                          .select("__hk", (F.col("__n") > limit).alias("__hot")))
        singles = df.join(rep, _q(key) == F.col("__hk"), "left_anti").withColumn(flag, F.lit(False))
        repeated = df.join(rep, _q(key) == F.col("__hk"), "inner")
        cold = repeated.where(~F.col("__hot")).drop("__hk", "__hot")
        out = singles.unionByName(_cold_flags(cold, key, order, flag, int(st["rep_rows"])))
        if n_hot:
            hot = repeated.where(F.col("__hot")).drop("__hk", "__hot")
            out = out.unionByName(_hot_flags(hot, key, order, flag, chunk_rows))
        return out
    hot_keys = None
    if n_hot:
        hot_keys = census.where(F.col("__n") > limit).select("__hk")
        if int(st["rep_bytes"]) <= broadcast_max_bytes:  # the hot keys are among the repeated ones
            hot_keys = F.broadcast(hot_keys)
    blocks = filter_blocks(n_rep, broadcast_max_bytes)
    left = left_share(rows, int(st["rep_rows"]), n_rep, blocks)
    if left <= MAX_LEFT_SHARE and _hashes_as_it_groups(df.schema[key].dataType):
        maybe, single = split_by_bits(df, key, census.where(F.col("__n") > 1), blocks, n_rep)
        flagged = _window_flags(maybe, key, order, flag, math.ceil(left * rows), chunk_rows, hot_keys)
        return single.withColumn(flag, F.lit(False)).unionByName(flagged)
    return _window_flags(df, key, order, flag, rows, chunk_rows, hot_keys)


def dedup_first(df: DataFrame, key: str, order: Sequence[str], check_unique: bool = True,
                hot_over: int = 1_000_000) -> DataFrame:
    """One row per key (NULL is a key too): the first in ``order``.

    A key census runs first (keys only, combined map-side): when no key
    occurs twice — e.g. after validation, which already rejected every
    repeat — the rows are returned as they are and never shuffled.
    Otherwise rows are dealt by key, over as many tasks as their number asks for, and
    ``min`` of the sort struct per key, from which the row is rebuilt, is taken in each
    task. Rows of hot keys (more than ``hot_over``) are partially aggregated map-side
    instead, so that a hot key is reduced to one row per task before the shuffle.
    ``check_unique=False`` is for rows that are dealt by key already.
    """
    check_orderable(df)

    def first_rows(rows: DataFrame) -> DataFrame:
        best = rows.groupBy(_q(key).alias("__k")).agg(F.min(sort_struct(df, order)).alias("__s"))
        return best.select(*from_sort_struct(df, order, "__s"))

    if not check_unique:
        return first_rows(df)
    census = key_census(df, key)
    st = census.agg(F.count_if(F.col("__n") > 1).alias("repeated"), F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"),
                    F.count_if(F.col("__n") > hot_over).alias("hot")).first()
    if int(st["repeated"]) == 0:
        return df
    cold, hot = df, None
    if int(st["hot"]):
        hot_keys = census.where(F.col("__n") > hot_over).select("__hk")
        if int(st["hot"]) <= MAX_HOT_KEYS:
            hot_keys = F.broadcast(hot_keys)
        same = _q(key).eqNullSafe(F.col("__hk"))
        cold, hot = df.join(hot_keys, same, "left_anti"), df.join(hot_keys, same, "left_semi")
    out = first_rows(cold.repartition(tasks_for(df.sparkSession, int(st["rows"])), _q(key)))
    return out if hot is None else out.unionByName(first_rows(hot))
