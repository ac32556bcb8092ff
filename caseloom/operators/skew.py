"""A chain of left joins on one key that stays balanced when keys are hot.

``left ⟕ side_1 ⟕ side_2 ⟕ …``, every side keyed by the left's key (plus optional further equalities). Spark's adaptive
skew handling can split the preserved (left) side of a left join but not the other side, so a key holding a large share
of one side's rows would be joined by a single task.

Hot keys are found without a shuffle by key: the rows of all sides are counted in hash buckets in one pass; a side with a
bucket above ``hot_threshold`` is counted in more buckets (16 per threshold's worth of rows), and keys exactly only in
those above it. A bucket never counts less than a key in it, so no hot key is missed.
Keys above the threshold number at most rows / threshold. Cold keys take the ordinary chain. For a hot key, each join is
done on a grid: the rows so far are dealt to as many salts as they fill thresholds, the side's rows likewise, and each
row is copied along the other axis only. The output is row for row the same as the plain chain.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.config import materialize


@dataclass
class Side:
    df: DataFrame
    key: str
    extra: list = field(default_factory=list)  # [(left_col, right_col)] further equalities
    # rows per key are counted here when it is cheaper than ``df`` and has at least as many rows per key (e.g. a
    # table before a lookup join); sides may share one frame, which is then counted once
    count_on: DataFrame | None = None
    count_key: str | None = None


def _prep(i: int, side: Side) -> tuple[DataFrame, str, list[tuple[str, str]]]:
    """Rename a side's key columns to private names so no join is ambiguous."""
    rk = f"_rk{i}"
    df = side.df.withColumnRenamed(side.key, rk)
    extras = []
    for n, (lc, rc) in enumerate(side.extra):
        name = f"_rx{i}_{n}"
        df = df.withColumnRenamed(rc, name)
        extras.append((lc, name))
    return df, rk, extras


def _cond(key: str, rk: str, extras) -> Column:
    """Equal keys; further equalities as ranges, so the join stays partitioned by the key alone, whatever the session's
    options, and joins that follow reuse that partitioning."""
    c = F.col(key) == F.col(rk)
    for lc, rc in extras:
        c = c & F.col(lc).between(F.col(rc), F.col(rc))
    return c


def _private(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith(("_rk", "_rx"))]


def plain_chain(left: DataFrame, key: str, sides: list[Side]) -> DataFrame:
    out = left
    for i, side in enumerate(sides):
        df, rk, extras = _prep(i, side)
        out = out.join(df, _cond(key, rk, extras), "left")
        out = out.drop(*_private(out))
    return out


def _key_bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets))


def bucket_sizes(sources: list[tuple[DataFrame, str]], buckets: int = 1 << 12) -> list[tuple[int, int]]:
    """(rows, rows of the fullest bucket) of every source, in one pass over all of them."""
    rows = None
    for i, (df, key) in enumerate(sources):
        part = df.select(F.col(key).cast("string").alias("_hk")).where(F.col("_hk").isNotNull()).select(
            F.lit(i).alias("_src"), _key_bucket("_hk", buckets).alias("_b"))
        rows = part if rows is None else rows.unionByName(part)
    per_bucket = rows.groupBy("_src", "_b").agg(F.count(F.lit(1)).alias("_n"))
    found = {r["_src"]: (r["rows"], r["most"]) for r in per_bucket.groupBy("_src").agg(
        F.sum("_n").alias("rows"), F.max("_n").alias("most")).collect()}  # a row per source
    return [found.get(i, (0, 0)) for i in range(len(sources))]


def hot_keys(df: DataFrame, key: str, hot_threshold: int, total: int | None = None) -> DataFrame | None:
    """(_hk, _n) of the keys with more than ``hot_threshold`` rows; None if there is none."""
    keys = df.select(F.col(key).alias("_hk")).where(F.col("_hk").isNotNull())
    total = df.count() if total is None else total
    buckets = 1 << max(4, (16 * total // hot_threshold).bit_length())
    bucket = _key_bucket("_hk", buckets)
    per_bucket = keys.groupBy(bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    if (per_bucket.agg(F.max("_n")).first()[0] or 0) <= hot_threshold:
        return None
    full = materialize(per_bucket.where(F.col("_n") > hot_threshold).select("_b"))
    suspects = keys.withColumn("_b", bucket).join(full, "_b", "left_semi")
    found = materialize(suspects.groupBy("_hk").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_threshold))
    return found if found.head(1) else None


def hot_grid(sides: list[Side], hot_threshold: int) -> DataFrame | None:
    """(_hk, _n0, _n1, …): the rows of every hot key on every side (0 where it isn't hot)."""
    sources = [(side.df, side.key) if side.count_on is None else (side.count_on, side.count_key or side.key) for side in sides]
    each = {(id(df), key): (df, key) for df, key in sources}  # sides that share a frame are counted once
    sizes = dict(zip(each, bucket_sizes(list(each.values())), strict=True))
    counted = {at: hot_keys(*each[at], hot_threshold, total) if most > hot_threshold else None for at, (total, most) in sizes.items()}
    found = [counted[id(df), key] for df, key in sources]
    if all(h is None for h in found):
        return None
    rows = None
    for i, h in enumerate(found):
        if h is not None:
            part = h.select("_hk", F.lit(i).alias("_side"), "_n")
            rows = part if rows is None else rows.unionByName(part)
    return materialize(rows.groupBy("_hk").agg(*[
        F.coalesce(F.max(F.when(F.col("_side") == i, F.col("_n"))), F.lit(0)).alias(f"_n{i}") for i in range(len(sides))]))


def _grid_step(out: DataFrame, key: str, i: int, side: Side, salts: DataFrame) -> DataFrame:
    """One left join for hot keys; ``salts``: (_hk, _a, _b), the salts of the rows so far and of the side."""
    df, rk, extras = _prep(i, side)
    # Random salts (not a content hash), so identical copies of a row spread too. Any salt is correct, since the
    # other side is in every one. Spark treats a nondeterministic key as indeterminate and re-runs the downstream
    # stage if a map output is lost.
    left = out.join(salts, F.col(key) == F.col("_hk")).withColumn("_la", F.floor(F.rand(17 + i) * F.col("_a")).cast("int")).withColumn(
        "_lb", F.explode(F.sequence(F.lit(0), F.col("_b") - 1))).drop("_hk", "_a", "_b")
    right = df.join(salts, F.col(rk) == F.col("_hk")).withColumn("_rb", F.floor(F.rand(71 + i) * F.col("_b")).cast("int")).withColumn(
        "_ra", F.explode(F.sequence(F.lit(0), F.col("_a") - 1))).drop("_hk", "_a", "_b")
    matched = left.join(right, _cond(key, rk, extras) & (F.col("_la") == F.col("_ra")) & (F.col("_lb") == F.col("_rb")))
    present = df.join(salts, F.col(rk) == F.col("_hk"), "left_semi").select(rk, *[rc for _, rc in extras]).distinct()
    alone = out.join(present, _cond(key, rk, extras), "left_anti")
    joined = matched.drop("_la", "_lb", "_ra", "_rb", rk, *[rc for _, rc in extras])
    return joined.unionByName(alone, allowMissingColumns=True)


def left_join_chain(left: DataFrame, key: str, sides: list[Side], hot_threshold: int | None = 1_000_000) -> DataFrame:
    """The left-join chain with hot keys on a grid. ``hot_threshold``: rows of one key that one task may take;
    ``None`` turns the detection off."""
    plain = plain_chain(left, key, sides)
    if not hot_threshold:
        return plain
    grid = hot_grid(sides, hot_threshold)
    if grid is None:
        return plain
    # no broadcast hints: the table of hot keys is stored, so Spark knows its size and chooses
    cold_left = left.join(grid, left[key] == grid["_hk"], "left_anti")
    cold_sides = [Side(s.df.join(grid, s.df[s.key] == grid["_hk"], "left_anti"), s.key, s.extra) for s in sides]
    out = left.join(grid, left[key] == grid["_hk"], "left_semi")
    so_far = F.lit(1.0)  # rows a left row has become, at most
    for i, side in enumerate(sides):
        n = F.greatest(F.col(f"_n{i}"), F.lit(1)).cast("double")
        salts = grid.select("_hk", F.ceil(so_far / hot_threshold).cast("int").alias("_a"), F.ceil(n / hot_threshold).cast("int").alias("_b"))
        out = _grid_step(out, key, i, side, salts)
        so_far = so_far * n
    return plain_chain(cold_left, key, cold_sides).unionByName(out.select(*plain.columns))
