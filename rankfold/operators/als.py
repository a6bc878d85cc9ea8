"""Biased matrix factorisation on residuals by alternating least squares.

Objective (weighted-lambda form, lambda scaled by the rating count):

    sum_(u,i) (y_ui - p_u . q_i)^2 + reg * (sum_u n_u |p_u|^2 + sum_i n_i |q_i|^2)
    with y_ui = r_ui - mu - b_u - b_i   (biases fixed beforehand)

Two solvers reach the same objective:

* ``fit_exact``: deterministic start values, users solved first, then items,
  train RMSE and objective after every iteration.  One half step is a Spark
  job: residual rows join the fixed factors, rows are hash-partitioned by
  (entity, salt) and sorted, and a vectorised pandas reduce builds the normal
  equations of each (entity, salt) group in one pass.  Entities with more
  than ``max_rows`` ratings get several salts; their partial sums are added
  in a second, small grouped step, so no entity's ratings must fit in one
  task.  A single half step is also the fold-in of new users.  Where the factors are too
  large to broadcast, ratings lie in packed blocks instead (``blocks``).
* ``fit_mllib``: ``pyspark.ml.recommendation.ALS`` on the residual column
  (same objective, block-partitioned, the scalable default for large ranks).
"""

from __future__ import annotations

import time
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankfold import config
from rankfold.functions.vectors import clip_rating, dot
from rankfold.operators import bias as bias_ops
from rankfold.operators import blocks
from rankfold.session import ship_package

SIDES = {"user": ("user_id", "item_id", "n_u"), "item": ("item_id", "user_id", "n_i")}


# --------------------------------------------------------------------------
# start values
# --------------------------------------------------------------------------
def _start(id_col: str, rank: int, scale: float = 0.1):
    x = F.col(id_col).cast("double")
    comps = []
    for k in range(rank):
        a, b = (17 + 6 * k) / 10, (3 + 6 * k) / 10
        f = F.sin if k % 2 == 0 else F.cos
        comps.append(f(x * F.lit(a) + F.lit(b)) * F.lit(scale))
    return F.array(*comps).alias("factors")


def init_factors(ids: DataFrame, id_col: str, rank: int, scale: float = 0.1) -> DataFrame:
    """Start factors as a function of the id (no random state, layout-free).

    Component k is ``scale * sin(id * a_k + b_k)`` for even k and ``cos`` for
    odd k, with ``a_k = (17 + 6k) / 10`` and ``b_k = (3 + 6k) / 10``.
    """
    return ids.select(id_col, _start(id_col, rank, scale))


# --------------------------------------------------------------------------
# normal equations
# --------------------------------------------------------------------------
def _tri(rank: int):
    return np.triu_indices(rank)


def _unpack(tri_vals: np.ndarray, rank: int) -> np.ndarray:
    """(g, r(r+1)/2) upper triangles -> (g, r, r) symmetric matrices."""
    iu = _tri(rank)
    m = np.zeros((tri_vals.shape[0], rank, rank))
    m[:, iu[0], iu[1]] = tri_vals
    m[:, iu[1], iu[0]] = tri_vals
    return m


def _solve(xtx_tri: np.ndarray, xty: np.ndarray, n: np.ndarray, rank: int,
           reg: float) -> np.ndarray:
    return solve_systems(_unpack(xtx_tri, rank), xty, n, reg)


def solve_systems(a: np.ndarray, b: np.ndarray, n: np.ndarray, reg: float) -> np.ndarray:
    """Solutions of ``(a + reg * n * I) x = b``; ``a`` may be changed."""
    rank = a.shape[1]
    if not (np.isfinite(a).all() and np.isfinite(b).all()):
        raise ValueError("non-finite ratings or factors")
    if reg == 0:
        return _solve_unregularised(a, b)
    # reg > 0 makes the systems positive definite, so only bad input can fail
    a[:, np.arange(rank), np.arange(rank)] += (reg * n)[:, None]
    return np.linalg.solve(a, b[..., None])[..., 0]


def deficient(a: np.ndarray) -> np.ndarray:
    """Which of the symmetric systems ``a`` are singular to rounding, by their eigenvalues."""
    e = np.linalg.eigvalsh(a)
    return e[:, 0] <= np.finfo(float).eps * a.shape[1] * np.maximum(e[:, -1], 0)


def _solve_unregularised(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Solutions of ``a x = b``; a singular system gets ``config.SINGULAR_REG`` on its diagonal,
    and zeros if that does not give finite numbers.  The others are solved as they are."""
    a, rank = a.copy(), a.shape[1]
    weak = np.flatnonzero(deficient(a))
    a[weak[:, None], np.arange(rank), np.arange(rank)] += config.SINGULAR_REG
    x = np.linalg.solve(a, b[..., None])[..., 0]
    x[~np.isfinite(x).all(1)] = 0.0
    return x


def _sums(x: np.ndarray, y: np.ndarray, starts: np.ndarray, n: np.ndarray):
    """Packed ``X^T X`` and ``X^T y`` of each run of rows; runs of one length are one product."""
    rank = x.shape[1]
    iu = _tri(rank)
    xtx, xty = np.empty((len(starts), len(iu[0]))), np.empty((len(starts), rank))
    for size in np.unique(n):
        at = np.flatnonzero(n == size)
        rows = starts[at][:, None] + np.arange(size)
        part = x[rows].transpose(0, 2, 1)
        xtx[at] = (part @ part.transpose(0, 2, 1))[:, iu[0], iu[1]]
        xty[at] = (part @ y[rows][..., None])[..., 0]
    return xtx, xty


def _lists(values: np.ndarray, given: np.ndarray) -> pa.Array:
    """One list per row of ``given``: the next row of ``values`` where it is true, else null."""
    ends = np.concatenate([[0], np.cumsum(given)]).astype(np.int32) * values.shape[1]
    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))
    return pc.if_else(pa.array(given), lists, pa.scalar(None, lists.type))


def _group_reduce(me: str, rank: int, reg: float, solve: bool):
    """Function over parts ``(ids, salts, ns, y, x)`` of rows sorted by (me, _salt).

    Emits one row per (me, _salt) group: the solved factor when the entity has
    a single salt (and ``solve``), else the partial normal equations.  Running
    sums of a group that continues into the next part are carried over
    (constant memory per task).
    """
    kinds = _stage_kinds(me)

    def reduce_part(ids, salts, ns, y, x):
        brk = np.flatnonzero((ids[1:] != ids[:-1]) | (salts[1:] != salts[:-1])) + 1
        starts = np.concatenate([[0], brk])
        cnt = np.diff(np.append(starts, len(ids)))
        return [ids[starts], salts[starts], ns[starts], cnt, *_sums(x, y, starts, cnt)]

    def emit(ids, salts, ns, cnt, xtx, xty):
        fin = (ns == 1) if solve else np.zeros(len(ids), bool)
        sol = (_solve(xtx[fin], xty[fin], cnt[fin].astype(np.float64), rank, reg) if fin.any()
               else np.zeros((0, rank)))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids), pa.array(salts), pa.array(ns), pa.array((~fin).astype(np.int32)),
             pa.array(cnt), _lists(xtx[~fin], ~fin), _lists(xty[~fin], ~fin), _lists(sol, fin)],
            schema=kinds)

    def fn(it):
        carry = None
        for part in it:
            if not len(part[0]):
                continue
            g = reduce_part(*part)
            if carry is not None:
                if carry[0][0] == g[0][0] and carry[1][0] == g[1][0]:
                    g[3][0] += carry[3][0]
                    g[4][0] += carry[4][0]
                    g[5][0] += carry[5][0]
                else:
                    yield emit(*carry)
            carry = [a[-1:] for a in g]
            if len(g[0]) > 1:
                yield emit(*[a[:-1] for a in g])
        if carry is not None:
            yield emit(*carry)

    return fn


def _stage_kinds(me: str) -> pa.Schema:
    return pa.schema([(me, pa.int64()), ("_salt", pa.int64()), ("_ns", pa.int64()),
                      ("kind", pa.int32()), ("n", pa.int64()),
                      *[(c, pa.list_(pa.float64())) for c in ("xtx", "xty", "factors")]])


_STAGE_SCHEMA = ("{me} long, _salt long, _ns long, kind int, n long, xtx array<double>, "
                 "xty array<double>, factors array<double>")


def _salted(rows: DataFrame, side: str, max_rows: int) -> DataFrame:
    """Residual rows of one side with the entity's number of salts and the row's salt."""
    me, other, ncol = SIDES[side]
    ns = F.greatest(F.lit(1), F.ceil(F.col(ncol) / F.lit(max_rows))).cast("long")
    return (rows.select(me, other, "y", ncol).withColumn("_ns", ns)
            .withColumn("_salt", F.pmod(F.xxhash64(other), F.col("_ns")))
            .select(me, other, "_salt", "_ns", "y"))


def layout(rows: DataFrame, side: str, max_rows: int = config.MAX_ROWS_PER_SOLVE_GROUP
           ) -> DataFrame:
    """Residual rows of one side, hash-partitioned by (entity, salt) and sorted.

    Checkpointed once by ``fit_exact``; every later half step of that side
    then reads the rows in place (like MLlib's in-blocks) and only the fixed
    factors travel, by broadcast.
    """
    me = SIDES[side][0]
    return (_salted(rows, side, max_rows)
            .repartition(me, "_salt").sortWithinPartitions(me, "_salt"))


@dataclass
class Routing:
    """Ratings of one side in blocks, and which block needs which factor.

    ``ratings`` has the rows of every entity (and salt) in one block, partitioned by block;
    ``routes`` has each pair (other entity, block) once.  Both are written once per fit.
    """

    ratings: DataFrame
    routes: DataFrame


def _partitioned_checkpoint(df: DataFrame) -> DataFrame:
    """A checkpoint that still says how its rows are partitioned; a plan that adapts while
    it runs does not promise that."""
    conf, key = df.sparkSession.conf, "spark.sql.adaptive.enabled"
    before = conf.get(key)
    conf.set(key, "false")
    try:
        return df.select("*").checkpoint(eager=True)  # planned anew, under this setting
    finally:
        conf.set(key, before)


def routing(rows: DataFrame, side: str, max_rows: int = config.MAX_ROWS_PER_SOLVE_GROUP,
            block_rows: int = config.ROUTING_BLOCK_ROWS) -> Routing:
    """The routing tables of one side, for one half step with factors too large to broadcast
    (``fit_exact`` packs its blocks, see ``blocks``).

    A half step then sends a factor once to every block that holds ratings of it, however
    many those are; the ratings stay where they are.
    """
    me, other, _ = SIDES[side]
    blocks = max(1, -(-rows.count() // block_rows))
    by = ["_block", me, "_salt"]
    ratings = (_salted(rows, side, max_rows)
               .withColumn("_block", F.pmod(F.xxhash64(me, "_salt"), F.lit(blocks)).cast("int"))
               .select("_block", me, other, F.col("_salt").cast("int").alias("_salt"),
                       F.col("_ns").cast("int").alias("_ns"), "y")
               # so many partitions that few of them hold two blocks
               .repartition(max(64, 4 * blocks), "_block").sortWithinPartitions(*by))
    ratings = _partitioned_checkpoint(ratings)
    routes = ratings.select(F.col("_block").alias("_block"), F.col(other).alias(other)).distinct()
    return Routing(ratings, _checkpoint(routes))


def routed_factors(fixed: DataFrame, r: Routing, other: str) -> DataFrame:
    """``_block, other, factors``: every factor once for each block that needs it."""
    fx = fixed.select(F.col(fixed.columns[0]).alias(other), "factors")
    return r.routes.join(fx, other).select("_block", other, "factors")


def _routed_stage(r: Routing, fixed: DataFrame, side: str, rank: int, reg: float,
                  solve: bool) -> DataFrame:
    """The groups' rows, as of ``_group_reduce``."""
    me, other, _ = SIDES[side]
    ship_package(fixed.sparkSession)
    reduce, step = _group_reduce(me, rank, reg, solve), config.ROUTING_STEP_ROWS
    schema, kinds = _STAGE_SCHEMA.format(me=me), _stage_kinds(me)

    def block(ratings: pa.Table, vectors: pa.Table) -> pa.Table:
        if not ratings.num_rows or not vectors.num_rows:
            return kinds.empty_table()
        known = vectors[other].to_numpy()
        x = vectors["factors"].combine_chunks().flatten().to_numpy().reshape(len(known), -1)
        order = np.argsort(known)
        wanted = ratings[other].to_numpy()
        at = order[np.minimum(np.searchsorted(known, wanted, sorter=order), len(known) - 1)]
        found = known[at] == wanted
        ids, salts = ratings[me].to_numpy(), ratings["_salt"].to_numpy()
        ns, y = ratings["_ns"].to_numpy(), ratings["y"].to_numpy()
        # they come sorted, with all their factors; a look is cheaper than a copy
        if not found.all() or (ids[1:] < ids[:-1]).any() or (
                (ids[1:] == ids[:-1]) & (salts[1:] < salts[:-1])).any():
            keep = np.lexsort((salts, ids))
            keep = keep[found[keep]]
            at, ids, salts, ns, y = (c[keep] for c in (at, ids, salts, ns, y))

        def parts():
            for i in range(0, len(ids), step):
                p = slice(i, i + step)
                yield ids[p], salts[p].astype(np.int64), ns[p].astype(np.int64), y[p], x[at[p]]
        return pa.Table.from_batches(reduce(parts()), kinds)
    vectors = routed_factors(fixed, r, other)
    return r.ratings.groupBy("_block").cogroup(vectors.groupBy("_block")).applyInArrow(
        block, schema)


def factor_bytes(n: int, rank: int) -> int:
    return n * (8 * rank + 48)


def _stage(rows: DataFrame, fixed: DataFrame | None, side: str, rank: int, reg: float,
           solve: bool, max_rows: int, laid_out: DataFrame | None = None) -> DataFrame:
    me, other, _ = SIDES[side]
    ship_package(rows.sparkSession)
    columns = (me, "_salt", "_ns", "y")
    if fixed is None:
        # a function of the id, so it is added where the rows are and does not travel
        s = (layout(rows, side, max_rows) if laid_out is None else laid_out).select(
            *columns, _start(other, rank))
    else:
        fx = fixed.select(F.col(fixed.columns[0]).alias(other), "factors")
        if laid_out is not None:
            # broadcast hash join: keeps the (entity, salt) partitioning and order of the rows
            s = laid_out.join(F.broadcast(fx), other).select(*columns, "factors")
        else:
            s = _salted(rows, side, max_rows).join(fx, other).select(*columns, "factors")
            s = s.repartition(me, "_salt").sortWithinPartitions(me, "_salt")
    reduce = _group_reduce(me, rank, reg, solve)

    def parts(batches):
        for b in batches:
            if b.num_rows:
                yield (*[b.column(c).to_numpy() for c in columns],
                       b.column("factors").flatten().to_numpy().reshape(b.num_rows, -1))
    return s.mapInArrow(lambda batches: reduce(parts(batches)), _STAGE_SCHEMA.format(me=me))


def _sum_partials(me: str, rank: int, reg: float | None):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        n = int(pdf["n"].sum())
        xtx = np.sum(np.stack(pdf["xtx"].to_numpy()), axis=0)[None, :]
        xty = np.sum(np.stack(pdf["xty"].to_numpy()), axis=0)[None, :]
        out = {me: [int(pdf[me].iloc[0])], "n": [n]}
        if reg is None:
            out["xtx"] = [xtx[0]]
            out["xty"] = [xty[0]]
        else:
            out["factors"] = [_solve(xtx, xty, np.array([float(n)]), rank, reg)[0]]
        return pd.DataFrame(out)
    return fn


def normal_equations(rows: DataFrame, fixed: DataFrame | None, side: str, rank: int,
                     max_rows: int = config.MAX_ROWS_PER_SOLVE_GROUP) -> DataFrame:
    """Per entity: ``n``, packed upper triangle of ``X^T X`` and ``X^T y``.

    ``rows`` are residual rows (``user_id, item_id, y, n_u, n_i``); ``fixed``
    is ``(other_id, factors)``, or None for the start factors.  The regularisation term is not included.
    """
    me = SIDES[side][0]
    st = _stage(rows, fixed, side, rank, 0.0, False, max_rows).checkpoint(eager=True)
    whole = st.filter("_ns = 1").select(me, "n", "xtx", "xty")
    split = (st.filter("_ns > 1").select(me, "n", "xtx", "xty")
             .groupBy(me).applyInPandas(
                 _sum_partials(me, rank, None),
                 f"{me} long, n long, xtx array<double>, xty array<double>"))
    return whole.unionByName(split)


def half_step(rows: DataFrame, fixed: DataFrame | None, side: str, rank: int,
              reg: float = config.REG,
              max_rows: int = config.MAX_ROWS_PER_SOLVE_GROUP,
              laid_out: "DataFrame | Routing | None" = None) -> DataFrame:
    """Solve ``(X^T X + reg * n * I) f = X^T y`` for every entity of ``side``.

    ``reg`` may be 0: entities whose system is singular (too few ratings for the rank) then
    take the fallback of ``_solve_unregularised``, the others are solved as they are.

    ``fixed`` is ``(other_id, factors)``, or None for the start factors (``init_factors``) of
    the other side, which then do not travel with the rows.

    Returns ``(<side>_id, n, factors)``.  Entities with one salt are solved
    inside the sorted reduce; split (hot) entities have their partial sums
    added per entity and are solved there.  ``laid_out`` skips the shuffle of the
    rating rows: from ``layout``, only when the fixed factors passed a broadcast size
    check, or from ``routing``, whatever their size.
    """
    if reg < 0:
        raise ValueError("reg must not be negative")
    # written once: both branches below read it, and a lost executor cannot undo it
    st = _checkpoint(_routed_stage(laid_out, fixed, side, rank, reg, True)
                     if isinstance(laid_out, Routing) else
                     _stage(rows, fixed, side, rank, reg, True, max_rows, laid_out))
    return _solved(st, side, rank, reg)


def second_half_step(rows: DataFrame, fixed: DataFrame, side: str, rank: int,
                     reg: float = config.REG,
                     max_rows: int = config.MAX_ROWS_PER_SOLVE_GROUP) -> DataFrame:
    """``half_step`` from the factors that one of the other side gave for the same ``rows``:
    ``(other_id, n, factors)``, one row for each entity with a rating.

    Factors too large to broadcast go once to each block of ratings (``blocks``); joined to
    the ratings, a vector would be shuffled with every one of them.
    """
    me, other, _ = SIDES[side]
    size = fixed.agg(F.count(F.lit(1)).alias("entities"), F.sum("n").alias("ratings")).first()
    if factor_bytes(size["entities"], rank) <= config.MAX_FACTOR_BROADCAST_BYTES:
        return half_step(rows, fixed.select(other, "factors"), side, rank, reg, max_rows)
    if reg < 0:
        raise ValueError("reg must not be negative")
    how = blocks.plan(rows.sparkSession, size["ratings"], size["entities"], rank, max_rows)
    packed = blocks.pack(rows.drop("rating"), side, how, _checkpoint, _partitioned_checkpoint)
    st = _checkpoint(blocks.stage(packed, blocks.pack_factors(fixed, other, how), rank, reg, False))
    done = blocks.unpack_factors(st.filter("ids is not null"), me, rank, counts=True)
    return done.unionByName(blocks.split_factors(st, me, rank, reg))


def _solved(st: DataFrame, side: str, rank: int, reg: float, split: bool = True) -> DataFrame:
    """Factors from a written stage; without ``split`` no entity of it has several salts."""
    me = SIDES[side][0]
    done = st.filter("kind = 0").select(me, "n", "factors")
    if not split:
        return done
    hot = (st.filter("kind = 1").select(me, "n", "xtx", "xty")
           .groupBy(me).applyInPandas(_sum_partials(me, rank, reg),
                                      f"{me} long, n long, factors array<double>"))
    return done.unionByName(hot)


def unregularised_check(equations: DataFrame, factors: DataFrame, side: str, rank: int
                        ) -> DataFrame:
    """Per entity of an unregularised half step: whether its system is singular, and the
    largest error of the one that was solved (with the fallback's diagonal if singular).

    ``equations`` comes from ``normal_equations``.  Output: ``<side>_id, n, deficient,
    max_error``.
    """
    me = SIDES[side][0]
    ship_package(equations.sparkSession)

    def check(frames):
        for f in frames:
            if not len(f):
                continue
            a = _unpack(np.stack(f["xtx"].to_numpy()), rank)
            weak = deficient(a)
            x, b = np.stack(f["factors"].to_numpy()), np.stack(f["xty"].to_numpy())
            error = np.einsum("gij,gj->gi", a, x) + config.SINGULAR_REG * weak[:, None] * x - b
            yield pd.DataFrame({me: f[me], "n": f["n"], "deficient": weak,
                                "max_error": np.abs(error).max(1)})
    return equations.join(factors.select(me, "factors"), me).mapInPandas(
        check, f"{me} long, n long, deficient boolean, max_error double")


def optimality(rows: DataFrame, p: DataFrame, q: DataFrame, side: str, rank: int,
               reg: float = config.REG) -> DataFrame:
    """Per entity of ``side``: the largest error of its weighted normal equations.

    The gradient ``sum (p . q - y) x + reg * n * f`` is summed with built-in
    aggregates from the residual rows and both factor tables, apart from the
    solver.  Output: ``<side>_id, n, max_error``.
    """
    me = SIDES[side][0]
    j = (rows.select("user_id", "item_id", "y")
         .join(p.select("user_id", F.col("factors").alias("_p")), "user_id")
         .join(q.select("item_id", F.col("factors").alias("_q")), "item_id"))
    own, fixed = ("_q", "_p") if side == "item" else ("_p", "_q")
    j = j.withColumn("_d", dot("_p", "_q") - F.col("y"))
    g = j.groupBy(me).agg(F.count(F.lit(1)).alias("n"), F.first(own).alias("_f"), F.array(*[
        F.sum(F.col(fixed)[k] * F.col("_d")) for k in range(rank)]).alias("_g"))
    err = F.array_max(F.zip_with("_g", "_f", lambda x, f: F.abs(x + reg * F.col("n") * f)))
    return g.select(me, "n", err.alias("max_error"))


# --------------------------------------------------------------------------
# model assembly
# --------------------------------------------------------------------------
def train_errors(rows: DataFrame, mu: float, p: DataFrame, q: DataFrame,
                 reg: float, broadcast_factors: bool = False) -> DataFrame:
    """One row: the sum of squared clipped errors and the regularised objective.

    ``broadcast_factors`` (set only after a size check of both factor
    tables) joins them by broadcast, so the rating rows are not shuffled.
    """
    pf = p.select("user_id", F.col("factors").alias("_p"))
    qf = q.select("item_id", F.col("factors").alias("_q"))
    if broadcast_factors:
        pf, qf = F.broadcast(pf), F.broadcast(qf)
    j = rows.join(qf, "item_id").join(pf, "user_id")
    d = dot("_p", "_q")
    pred = clip_rating(F.lit(mu) + F.col("b_u") + F.col("b_i") + d)
    sq = lambda a: F.aggregate(F.col(a), F.lit(0.0), lambda acc, v: acc + v * v)
    return j.agg(
        F.sum(F.pow(F.col("rating") - pred, 2)).alias("se"),
        F.sum(F.pow(F.col("y") - d, 2) + F.lit(reg) * (sq("_p") + sq("_q"))).alias("objective"))


def _checkpoint(df: DataFrame) -> DataFrame:
    return df.checkpoint(eager=True)


def _shape(size: dict, max_rows: int) -> tuple[int, dict]:
    """The number of ratings, and which side has entities that are split."""
    return size["user"]["ratings"], {side: size[side]["most"] > max_rows for side in size}


def _broadcast_loop(rows: DataFrame, ib: DataFrame, mu: float, rank: int, iterations: int,
                    reg: float, max_rows: int, size: dict, hist: list | None):
    """The iterations with the fixed factors broadcast to ratings that lie in place."""
    n_ratings, split = _shape(size, max_rows)
    q = _checkpoint(init_factors(ib.select("item_id"), "item_id", rank))
    p = None
    laid_out = {side: _checkpoint(layout(rows, side, max_rows)) for side in SIDES}

    def step(fixed: DataFrame, side: str):
        st = _checkpoint(_stage(rows, fixed, side, rank, reg, True, max_rows, laid_out[side]))
        f = _solved(st, side, rank, reg, split[side]).select(SIDES[side][0], "factors")
        return _checkpoint(f) if split[side] else f
    for it in range(1, iterations + 1):
        t0 = time.time()
        p = step(q, "user")
        q = step(p, "item")
        if hist is not None:
            found = train_errors(rows, mu, p, q, reg, True).first()
            hist.append((it, float(np.sqrt(found["se"] / n_ratings)), float(found["objective"]),
                         round(time.time() - t0, 3)))
    return p, q


def _block_loop(rows: DataFrame, ib: DataFrame, mu: float, rank: int, iterations: int,
                reg: float, max_rows: int, size: dict, hist: list | None):
    """The iterations over packed blocks (``blocks``); the item blocks have the errors too."""
    spark = rows.sparkSession
    n_ratings, split = _shape(size, max_rows)
    how = blocks.plan(spark, n_ratings, max(s["entities"] for s in size.values()), rank, max_rows)
    packed = {side: blocks.pack(rows if hist is not None and side == "item" else rows.drop(
        "rating"), side, how, _checkpoint, _partitioned_checkpoint) for side in SIDES}
    q = _checkpoint(blocks.pack_factors(
        ib.select("item_id", "n", _start("item_id", rank)), "item_id", how))
    p = None

    def step(fixed: DataFrame, side: str, errors: bool = False):
        st = _checkpoint(blocks.stage(packed[side], fixed, rank, reg, errors))
        f = st.filter("ids is not null").select("_block", "ids", "factors")
        if split[side]:
            me = SIDES[side][0]
            f = f.unionByName(_checkpoint(blocks.pack_factors(
                blocks.split_factors(st, me, rank, reg), me, how)))
        blocks.release(spark)
        return st, f
    for it in range(1, iterations + 1):
        t0 = time.time()
        _, p = step(q, "user")
        st, q = step(p, "item", hist is not None)
        if hist is not None:
            found = [st.agg(F.sum("se").alias("se"), F.sum("objective").alias("objective"))
                     .first()]
            if split["item"]:
                # the ratings of split items, whose factors no block of ratings has
                found.append(train_errors(
                    rows.filter(F.col("n_i") > max_rows), mu,
                    *[blocks.unpack_factors(f, me, rank)
                      for f, me in ((p, "user_id"), (q, "item_id"))], reg).first())
            se, objective = (sum(f[c] or 0.0 for f in found) for c in ("se", "objective"))
            hist.append((it, float(np.sqrt(se / n_ratings)), float(objective),
                         round(time.time() - t0, 3)))
    return tuple(None if f is None else _checkpoint(blocks.unpack_factors(f, me, rank))
                 for f, me in ((p, "user_id"), (q, "item_id")))


def fit_exact(train: DataFrame, rank: int = config.RANK,
              iterations: int = config.ITERATIONS, reg: float = config.REG,
              bias_reg: float = config.BIAS_REG, history: bool = True,
              max_rows: int = config.MAX_ROWS_PER_SOLVE_GROUP):
    """Reference-semantics training loop; returns ``rankfold.model.Model``.

    Lineage is cut after every half step with a reliable ``checkpoint()``
    (written below ``spark.checkpoint.dir``), so a lost executor recomputes
    at most one half step.
    """
    from rankfold.model import Model

    spark = train.sparkSession
    # read five times below; its sources are joined and merged once
    train = _checkpoint(train.select("user_id", "item_id", "rating"))
    mu = bias_ops.global_mean(train)
    ub = _checkpoint(bias_ops.user_bias(train, mu, bias_reg))
    ib = _checkpoint(bias_ops.item_bias(train, mu, ub, bias_reg))
    rows = _checkpoint(bias_ops.residuals(train, mu, ub, ib))
    size = {side: t.agg(F.count(F.lit(1)).alias("entities"), F.max("n").alias("most"),
                        F.sum("n").alias("ratings")).first()
            for side, t in (("user", ub), ("item", ib))}
    # in-place layouts: factors come by broadcast if both tables pass its bound, else in blocks
    small = factor_bytes(size["user"]["entities"] + size["item"]["entities"],
                         rank) <= config.MAX_FACTOR_BROADCAST_BYTES
    loop = _broadcast_loop if small else _block_loop
    hist = []
    p, q = loop(rows, ib, mu, rank, iterations, reg, max_rows, size, hist if history else None)
    uf = ub.join(p, "user_id").select("user_id", "bias", "n", "factors")
    itf = ib.join(q, "item_id").select("item_id", "bias", "n", "factors")
    hist_df = spark.createDataFrame(
        hist, "iteration int, train_rmse double, objective double, seconds double"
    ) if history else None
    return Model(mu=mu, user_factors=uf, item_factors=itf, rank=rank, reg=reg,
                 bias_reg=bias_reg, iterations=iterations, solver="exact",
                 history=hist_df)


def fit_mllib(train: DataFrame, rank: int = config.RANK,
              iterations: int = config.ITERATIONS, reg: float = config.REG,
              bias_reg: float = config.BIAS_REG, seed: int = 42,
              num_blocks: int | None = None, checkpoint_interval: int = 5):
    """MLlib ALS on the residual target; returns ``rankfold.model.Model``.

    MLlib scales ``regParam`` by the rating count (the same weighted-lambda
    objective) and solves its item side first in each iteration, so users
    are passed as MLlib items to keep the users-then-items order.  MLlib
    needs 32-bit ids; larger ids are mapped through a dense index.
    """
    from pyspark.ml.recommendation import ALS

    from rankfold.model import Model
    from rankfold.operators.profile import dense_index

    spark = train.sparkSession
    train = _checkpoint(train.select("user_id", "item_id", "rating"))
    mu = bias_ops.global_mean(train)
    ub = _checkpoint(bias_ops.user_bias(train, mu, bias_reg))
    ib = _checkpoint(bias_ops.item_bias(train, mu, ub, bias_reg))
    rows = bias_ops.residuals(train, mu, ub, ib).select("user_id", "item_id", "y")

    lim = 2 ** 31 - 1
    mx = ub.agg(F.max("user_id").alias("u"), F.min("user_id").alias("lu"),
                F.sum("n").alias("n")).first()
    n_ratings = mx["n"]
    mi = ib.agg(F.max("item_id").alias("i"), F.min("item_id").alias("li")).first()
    remap = max(mx["u"], mi["i"]) > lim or min(mx["lu"], mi["li"]) < 0
    if remap:
        uidx = _checkpoint(dense_index(ub.select("user_id"), "user_id"))
        iidx = _checkpoint(dense_index(ib.select("item_id"), "item_id"))
        rows = (rows.join(uidx, "user_id").join(iidx, "item_id")
                .select(F.col("user_id_idx").alias("u"), F.col("item_id_idx").alias("i"), "y"))
    else:
        rows = rows.select(F.col("user_id").cast("int").alias("u"),
                           F.col("item_id").cast("int").alias("i"), "y")
    # by the ratings, not by the session's partitions: every block more sends factors once more
    blocks = num_blocks or max(10, -(-n_ratings // config.MLLIB_BLOCK_ROWS))
    als = ALS(rank=rank, maxIter=iterations, regParam=reg, userCol="i", itemCol="u",
              ratingCol="y", implicitPrefs=False, nonnegative=False, seed=seed,
              numUserBlocks=blocks, numItemBlocks=blocks,
              checkpointInterval=checkpoint_interval)
    m = als.fit(rows)
    to_d = F.transform("features", lambda v: v.cast("double")).alias("factors")
    p = m.itemFactors.select(F.col("id").alias("u"), to_d)
    q = m.userFactors.select(F.col("id").alias("i"), to_d)
    if remap:
        p = p.join(uidx.withColumnRenamed("user_id_idx", "u"), "u").drop("u")
        q = q.join(iidx.withColumnRenamed("item_id_idx", "i"), "i").drop("i")
    else:
        p = p.select(F.col("u").cast("long").alias("user_id"), "factors")
        q = q.select(F.col("i").cast("long").alias("item_id"), "factors")
    p = _checkpoint(p)
    q = _checkpoint(q)
    uf = ub.join(p, "user_id").select("user_id", "bias", "n", "factors")
    itf = ib.join(q, "item_id").select("item_id", "bias", "n", "factors")
    return Model(mu=mu, user_factors=uf, item_factors=itf, rank=rank, reg=reg,
                 bias_reg=bias_reg, iterations=iterations, solver="mllib", history=None)


def fold_in(new_ratings: DataFrame, model, reg: float | None = None) -> DataFrame:
    """Factors for users not in the model, from their ratings and the fixed
    item side (one user half step, no retraining).  Returns user factor rows."""
    mu = model.mu
    ib = model.item_factors.select("item_id", F.col("bias").alias("b_i"))
    r = new_ratings.select("user_id", "item_id", "rating").join(ib, "item_id")
    ub = (r.groupBy("user_id")
          .agg(F.sum(F.col("rating") - F.lit(mu)).alias("_s"), F.count(F.lit(1)).alias("n"))
          .select("user_id", (F.col("_s") / (F.col("n") + model.bias_reg)).alias("bias"), "n"))
    rows = (r.join(ub.select("user_id", F.col("bias").alias("b_u"), F.col("n").alias("n_u")),
                   "user_id")
            .withColumn("y", F.col("rating") - F.lit(mu) - F.col("b_u") - F.col("b_i"))
            .withColumn("n_i", F.lit(1).cast("long")))
    p = half_step(rows, model.item_factors.select("item_id", "factors"), "user",
                  model.rank, reg if reg is not None else model.reg)
    return ub.join(p.select("user_id", "factors"), "user_id").select(
        "user_id", "bias", "n", "factors")
