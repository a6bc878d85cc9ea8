"""Half steps over packed blocks of ratings, for factors too large to broadcast.

Every entity of a side belongs to one block by a hash, and a block's ratings are packed once
per fit into one row of arrays: per entity its id and number of ratings, per rating the target
and the place of the other entity's factor among those the block wants.  Which ones it wants
is packed too, per block that they belong to.  So a half step moves no ratings and joins
nothing: each block of fixed factors cuts out what every block of ratings wants of it, the
pieces are shuffled as they are, and a block that has all of its pieces solves its entities.

Entities with more than ``max_rows`` ratings are split over blocks by a salt.  They get
partial sums there, which are added and solved in a second, small step, and their factors
travel in blocks of their own, of negative numbers.
"""

from __future__ import annotations

import gc
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankfold import config
from rankfold.session import ship_package

SIDES = {"user": ("user_id", "item_id", "n_u", "n_i"),
         "item": ("item_id", "user_id", "n_i", "n_u")}
# Split entities in a block of their factors.
SPLIT_ENTITIES = 50_000
# Bytes of factors in a row that is shuffled: larger ones cost the JVM several times as much.
PIECE_BYTES = 256 * 1024

_PACKED = ("_block int, _from int, ids binary, n binary, whole binary, at binary, y binary, "
           "rating binary")
_SOLVED = ("_block int, ids binary, ns binary, factors binary, split_id long, n long, sums binary, "
           "se double, objective double")
_SOLVED_KINDS = pa.schema([
    ("_block", pa.int32()), ("ids", pa.binary()), ("ns", pa.binary()), ("factors", pa.binary()),
    ("split_id", pa.int64()), ("n", pa.int64()), ("sums", pa.binary()),
    ("se", pa.float64()), ("objective", pa.float64())])
_PACKED_KINDS = pa.schema([("_block", pa.int32()), ("_from", pa.int32()), *[
    (c, pa.binary()) for c in ("ids", "n", "whole", "at", "y", "rating")]])


@dataclass
class Plan:
    """How entities map to blocks; both sides have the same numbers of blocks."""

    labels: list[int]
    split_blocks: int
    max_rows: int

    def salts(self, n: Column) -> Column:
        return F.greatest(F.lit(1), F.ceil(n / F.lit(self.max_rows))).cast("long")

    def block(self, entity: str, salt: Column) -> Column:
        k = F.pmod(F.xxhash64(F.col(entity), salt), F.lit(len(self.labels)))
        return F.get(F.lit(self.labels), k.cast("int"))

    def home(self, entity: str, n: Column) -> Column:
        """The block that an entity's factor is in: its ratings' block, unless it is split."""
        own = F.pmod(F.xxhash64(entity), F.lit(self.split_blocks)).cast("int")
        return F.when(self.salts(n) == 1, self.block(entity, F.lit(0).cast("long"))).otherwise(
            F.lit(-1) - own)


@dataclass
class Packed:
    """Blocks of ratings of one side, and the ids that they want of the other's blocks."""

    ratings: DataFrame
    wanted: DataFrame


def block_rows(ratings: int, entities: int, rank: int) -> int:
    """Ratings in a block, such that it wants at most ``config.FIT_BLOCK_BYTES`` of factors of
    ``entities`` that all have as many ratings."""
    most = min(config.FIT_BLOCK_ROWS, -(-ratings // config.FIT_BLOCKS))
    held = config.FIT_BLOCK_BYTES / (8 * rank)
    if held < entities:
        most = min(most, int(-entities * math.log(1 - held / entities)))
    return max(1, most)


def plan(spark: SparkSession, ratings: int, entities: int, rank: int, max_rows: int) -> Plan:
    """Blocks by the number of ratings, numbered so that each has a partition to itself.
    ``entities`` are those of the larger side."""
    n = max(1, -(-ratings // block_rows(ratings, entities, rank)))
    some = spark.range(n * (20 + n.bit_length())).select(F.col("id").cast("int").alias("v"))
    found = some.groupBy(F.pmod(F.hash("v"), F.lit(n)).alias("p")).agg(F.min("v").alias("v"))
    return Plan(sorted(r["v"] for r in found.collect()),
                1 + ratings // max_rows // SPLIT_ENTITIES, max_rows)


def _column(table: pa.Table, name: str, kind) -> np.ndarray:
    return table[name].to_numpy().astype(kind, copy=False)


def _read(value: pa.Scalar, kind) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), kind)


def _binaries(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes of ``data`` between ``ends``, without a copy."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [
        None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _pack(me: str, other: str):
    def fn(table: pa.Table) -> pa.Table:
        block = table["_block"][0].as_py()
        ids, salts = _column(table, me, np.int64), _column(table, "_salt", np.int64)
        order = np.lexsort((salts, ids))
        starts = _starts(ids[order], salts[order])
        n = np.diff(np.append(starts, len(order)))
        # entities by their number of ratings, so that those of one number are one array
        by_n = np.argsort(n, kind="stable")
        first = order[starts][by_n]
        n = n[by_n]
        at = np.repeat(starts[by_n] - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        order = order[at + np.arange(len(order))]
        others, homes = _column(table, other, np.int64)[order], _column(
            table, "_from", np.int32)[order]
        by_home = np.lexsort((others, homes))
        new = _starts(homes[by_home], others[by_home])
        place = np.empty(len(order), np.int32)
        place[by_home] = np.repeat(np.arange(len(new), dtype=np.int32),
                                   np.diff(np.append(new, len(order))))
        wanted, homes = others[by_home][new], homes[by_home][new]
        cuts = _starts(homes)
        rows = [(block, None, ids[first].tobytes(), n.astype(np.int64).tobytes(),
                 (_column(table, "_ns", np.int64)[first] == 1).tobytes(), place.tobytes(),
                 _column(table, "y", np.float64)[order].tobytes(),
                 _column(table, "rating", np.float64)[order].tobytes()
                 if "rating" in table.column_names else None)]
        rows += [(block, int(homes[a]), wanted[a:z].tobytes(), *[None] * 5)
                 for a, z in zip(cuts, [*cuts[1:], len(homes)])]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(
            zip(*rows), _PACKED_KINDS.types)], schema=_PACKED_KINDS)
    return fn


def pack(rows: DataFrame, side: str, how: Plan, checkpoint, placed) -> Packed:
    """``rows`` are residual rows, with ``rating`` if errors are wanted.  ``checkpoint`` writes
    a table, ``placed`` does so and keeps what is known of its partitions."""
    me, other, n_me, n_other = SIDES[side]
    ship_package(rows.sparkSession)
    salts, more = how.salts(F.col(n_me)), [c for c in ("rating",) if c in rows.columns]
    blocks = len(how.labels)
    r = (rows.withColumn("_ns", salts)
         .withColumn("_salt", F.pmod(F.xxhash64(other), F.col("_ns")))
         .select(how.block(me, F.col("_salt")).alias("_block"), me, other, "_salt", "_ns",
                 how.home(other, F.col(n_other)).alias("_from"), "y", *more)
         .repartition(blocks, "_block"))
    packed = checkpoint(r.groupBy("_block").applyInArrow(_pack(me, other), _PACKED))
    own = packed.filter("_from is null").drop("_from").repartition(blocks, "_block")
    wanted = packed.filter("_from is not null").select("_from", "_block", "ids").repartition(
        blocks, "_from")
    return Packed(placed(own), placed(wanted))


def pack_factors(factors: DataFrame, id_col: str, how: Plan) -> DataFrame:
    """``_block, ids, factors`` of a table ``id_col, n, factors``."""
    def fn(table: pa.Table) -> pa.Table:
        x = table["factors"].combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
        ids = table["_id"].to_numpy()
        order = np.argsort(ids)
        return pa.table({"_block": table["_block"][:1], "ids": [ids[order].tobytes()],
                         "factors": [x[order].tobytes()]})
    ship_package(factors.sparkSession)
    f = factors.select(how.home(id_col, F.col("n")).alias("_block"),
                       F.col(id_col).alias("_id"), "factors")
    return f.groupBy("_block").applyInArrow(fn, "_block int, ids binary, factors binary")


def unpack_factors(packed: DataFrame, id_col: str, rank: int, counts: bool = False) -> DataFrame:
    """``id_col, factors`` as rows; with ``counts`` also ``n``, from the blocks of a stage."""
    names = [id_col, "n", "factors"] if counts else [id_col, "factors"]

    def fn(batches):
        for b in batches:
            for k, (ids, x) in enumerate(zip(b["ids"], b["factors"])):
                ids, x = _read(ids, np.int64), _read(x, np.float64)
                n = [_read(b["ns"][k], np.int64)] if counts else []
                for i in range(0, len(ids), config.ROUTING_STEP_ROWS):
                    own = ids[i:i + config.ROUTING_STEP_ROWS]
                    ends = np.arange(len(own) + 1, dtype=np.int32) * rank
                    lists = pa.ListArray.from_arrays(
                        pa.array(ends), pa.array(x[i * rank:(i + len(own)) * rank]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own), *[pa.array(c[i:i + len(own)]) for c in n], lists],
                        names=names)
    return packed.select("ids", *["ns"] * counts, "factors").mapInArrow(
        fn, f"{id_col} long, {'n long, ' * counts}factors array<double>")


def pieces(fixed: DataFrame, p: Packed, rank: int) -> DataFrame:
    """``_block, _from, part, factors``: what each block wants of each block of ``fixed``, once,
    in parts of ``PIECE_BYTES``."""
    kinds = pa.schema([("_block", pa.int32()), ("_from", pa.int32()), ("part", pa.int32()),
                       ("factors", pa.binary())])
    step = max(1, PIECE_BYTES // (8 * rank))

    def cut(wanted: pa.Table, factors: pa.Table) -> pa.Table:
        if not wanted.num_rows:
            return kinds.empty_table()
        if not factors.num_rows:
            raise ValueError("ratings of entities that have no factors")
        ids = _read(factors["ids"][0], np.int64)
        x = _read(factors["factors"][0], np.float64).reshape(-1, rank)
        own = [_read(w, np.int64) for w in wanted["ids"]]
        parts = np.array([-(-len(w) // step) for w in own])
        part = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        whole = np.array([len(w) for w in own])
        ends = np.append(0, np.cumsum(np.minimum(step, np.repeat(whole, parts) - part * step)))
        found = np.empty((ends[-1], rank))
        for w, z in zip(own, np.cumsum(whole)):
            at = np.minimum(np.searchsorted(ids, w), max(len(ids) - 1, 0))
            if len(w) and (not len(ids) or (ids[at] != w).any()):
                raise ValueError("ratings of an entity that has no factor")
            np.take(x, at, 0, found[z - len(w):z])
        blocks = wanted["_block"].to_numpy()
        return pa.Table.from_arrays([
            pa.array(np.repeat(blocks, parts)), pa.array(np.repeat(wanted["_from"].to_numpy(), parts)),
            pa.array(part.astype(np.int32)), _binaries(found, ends * 8 * rank)], schema=kinds)
    return p.wanted.groupBy("_from").cogroup(fixed.groupBy("_block")).applyInArrow(
        cut, "_block int, _from int, part int, factors binary")


def stage(p: Packed, fixed: DataFrame, rank: int, reg: float, errors: bool) -> DataFrame:
    """Per block the factors of its whole entities, and with ``errors`` those of their ratings:
    ``se`` (clipped) and ``objective``; per split entity and salt the partial sums."""
    from rankfold.operators.als import solve_systems

    step = config.ROUTING_STEP_ROWS

    def solve(ratings: pa.Table, found: pa.Table) -> pa.Table:
        if not ratings.num_rows:
            return _SOLVED_KINDS.empty_table()
        block = ratings["_block"][0].as_py()
        order = np.lexsort((found["part"].to_numpy(), found["_from"].to_numpy()))
        x = np.concatenate([_read(found["factors"][i], np.float64)
                            for i in order.tolist()]).reshape(-1, rank)
        del found
        ids, n = (_read(ratings[c][0], np.int64) for c in ("ids", "n"))
        whole = _read(ratings["whole"][0], bool)
        at, y = _read(ratings["at"][0], np.int32), _read(ratings["y"][0], np.float64)
        rating = _read(ratings["rating"][0], np.float64) if errors else None
        length = (x * x).sum(1) if errors else None
        solved, parts, se, objective = np.empty((len(ids), rank)), [], 0.0, 0.0
        ends = np.cumsum(n)
        runs = _starts(n, whole).tolist()
        for a, z in zip(runs, [*runs[1:], len(ids)]):
            size = int(n[a])
            for g in range(a, z, max(1, step // size)):
                h = min(z, g + max(1, step // size))
                rows = slice(ends[g] - size, ends[h - 1])
                own = x[at[rows]].reshape(h - g, size, rank)
                target = y[rows].reshape(h - g, size, 1)
                turned = own.transpose(0, 2, 1)
                xtx, xty = turned @ own, (turned @ target)[..., 0]
                if not whole[a]:
                    parts += [(int(ids[k]), size, np.append(xtx[k - g], xty[k - g]).tobytes())
                              for k in range(g, h)]
                    continue
                q = solve_systems(xtx, xty, n[g:h].astype(np.float64), reg)
                solved[g:h] = q
                if errors:
                    d, target = (own @ q[..., None])[..., 0], target[..., 0]
                    actual = rating[rows].reshape(h - g, size)
                    # what the target is the rating less of: the mean and both biases
                    predicted = np.clip(actual - target + d, config.CLIP_LO, config.CLIP_HI)
                    se += float(((actual - predicted) ** 2).sum())
                    objective += float(((target - d) ** 2).sum() + reg * (
                        length[at[rows]].sum() + size * (q * q).sum()))
        done = np.flatnonzero(whole)
        done = done[np.argsort(ids[done])]
        rows = [(block, ids[done].tobytes(), n[done].tobytes(), solved[done].tobytes(), None, None,
                 None, se, objective)] + [(block, *[None] * 3, *own, None, None) for own in parts]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(
            zip(*rows), _SOLVED_KINDS.types)], schema=_SOLVED_KINDS)
    return p.ratings.groupBy("_block").cogroup(
        pieces(fixed, p, rank).groupBy("_block")).applyInArrow(solve, _SOLVED)


def split_factors(st: DataFrame, id_col: str, rank: int, reg: float) -> DataFrame:
    """``id_col, n, factors`` of the split entities of a written stage."""
    from rankfold.operators.als import solve_systems

    def add(table: pa.Table) -> pa.Table:
        n = int(table["n"].to_numpy().sum())
        sums = sum(_read(s, np.float64) for s in table["sums"])
        f = solve_systems(sums[:-rank].reshape(1, rank, rank), sums[-rank:][None],
                          np.array([float(n)]), reg)[0]
        return pa.table({id_col: table["split_id"][:1], "n": pa.array([n], pa.int64()),
                         "factors": pa.array([f.tolist()], pa.list_(pa.float64()))})
    return st.filter("split_id is not null").select("split_id", "n", "sums").groupBy(
        "split_id").applyInArrow(add, f"{id_col} long, n long, factors array<double>")


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of what is done; it does so only for what the
    driver's JVM has collected, which may be long after the disk is full."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
