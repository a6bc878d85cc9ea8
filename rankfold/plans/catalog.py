"""Named queries over the test tables: ``(spark, sf_dir) -> DataFrame``.

Each query reads the given tables through ``sources.testdata`` (which only
re-shapes them) and runs the library's operators on the whole tables.
Numeric outputs are rounded (6 decimals; 4 where the reference prints 4) so
that results compare across engines.  Models are trained at the reference's
constants (rank 20, 20 iterations), once per session and state of the data
folder, and reused by the serving queries.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankfold import config
from rankfold.model import (load_model, promote_decision, read_current_pointer, retrain,
                            retrain_due, save_model)
from rankfold.operators import als, bias, catalogue, clean, evaluate, merge, profile
from rankfold.operators import scoring, split
from rankfold.session import ensure_checkpoint_dir, scratch_path
from rankfold.sources import documents, store
from rankfold.sources import testdata as td
from rankfold.streaming import item_stats as live

# The split whose form any SQL engine can repeat, for the oracle.
SPLIT = "linear"
PAGE = 3
PAGE_AFTER = 59
LOOKUP_USER = 7
LOOKUP_ITEM = 42

_MEMO: dict = {}


def _stamp(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and times of the tables in a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime())
                        for f in found))


def _memo(spark: SparkSession, sf_dir: str, name: str, fn):
    """``fn()``, once per session as long as the tables stay as they are."""
    key = (spark.sparkContext.applicationId, sf_dir, _stamp(spark, sf_dir), name)
    if key not in _MEMO:
        _MEMO[key] = fn()
    return _MEMO[key]


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# ---------------------------------------------------------------- shared data
def merged(spark, d) -> DataFrame:
    """The ratings store: base and feedback merged (one scan), written once per data
    folder as Parquet sorted within files, so that lookups by user or item reach the scan."""
    def build():
        path = scratch_path(spark, "ratings")
        rows = merge.merge_tagged(td.tagged_ratings(spark, d))
        rows.sortWithinPartitions("user_id", "item_id").write.parquet(path)
        return spark.read.schema(rows.schema).parquet(path)
    return _memo(spark, d, "merged", build)


def stats_store(spark, d) -> DataFrame:
    """The catalogue with item statistics, written once as Parquet."""
    def build():
        path = scratch_path(spark, "catalogue")
        rows = catalogue.catalogue(td.movies(spark, d), merged(spark, d), None)
        rows.sortWithinPartitions("item_id").write.parquet(path)
        return spark.read.schema(rows.schema).parquet(path)
    return _memo(spark, d, "stats_store", build)


def train_holdout(spark, d):
    return split.train_holdout(merged(spark, d), method=SPLIT)


def movies_catalogue(spark, d) -> DataFrame:
    return catalogue.catalogue(td.movies(spark, d), merged(spark, d), None)


def serving_model(spark, d):
    def fit():
        ensure_checkpoint_dir(spark)
        tr, _ = train_holdout(spark, d)
        return als.fit_exact(tr)
    return _memo(spark, d, "serving_model", fit)


def feedback_model(spark, d):
    def fit():
        ensure_checkpoint_dir(spark)
        fb = merge.merge_ratings(None, td.feedback_ratings(spark, d), feedback_only=True)
        tr, _ = split.train_holdout(fb, method=SPLIT)
        return als.fit_exact(tr, history=False)
    return _memo(spark, d, "feedback_model", fit)


def _mu(spark, d) -> float:
    return _memo(spark, d, "mu", lambda: bias.global_mean(train_holdout(spark, d)[0]))


def _biases(spark, d):
    tr, _ = train_holdout(spark, d)
    mu = _mu(spark, d)
    ub = bias.user_bias(tr, mu)
    ib = bias.item_bias(tr, mu, ub)
    return tr, mu, ub, ib


def _factors(c: str = "factors"):
    """The first two components and the sum of all of them."""
    total = F.aggregate(F.col(c), F.lit(0.0), lambda a, v: a + v)
    return [r6(F.col(c)[0]).alias("f1"), r6(F.col(c)[1]).alias("f2"), r6(total).alias("f_sum")]


# ---------------------------------------------------------------- queries
def q_ratings_valid(spark, d):
    return clean.valid_ratings(td.raw_ratings(spark, d)).select(
        "user_id", "item_id", "rating", "seq")


def q_rating_rejects(spark, d):
    return clean.rating_rejects(td.rating_events(spark, d)).select(
        "event_id", "user_id", "item_id", "rating", "reason")


def q_ratings_merged(spark, d):
    """Two separate sources (base, feedback) merged by the library."""
    return merge.merge_ratings(td.base_ratings(spark, d), td.feedback_ratings(spark, d)).select(
        "user_id", "item_id", "rating", "seq", "source")


def q_ratings_feedback_only(spark, d):
    return merge.merge_ratings(td.base_ratings(spark, d), td.feedback_ratings(spark, d),
                               feedback_only=True).select("user_id", "item_id", "rating",
                                                          "seq")


def feedback_documents(spark, d) -> str:
    """The feedback ratings as a store of schemaless documents, written once per data folder."""
    return _memo(spark, d, "documents", lambda: documents.write_documents(
        td.feedback_ratings(spark, d), scratch_path(spark, "documents")))


def q_ratings_documents(spark, d):
    """Feedback only, scanned from documents."""
    fb = documents.read_documents(spark, feedback_documents(spark, d))
    return merge.merge_ratings(None, fb, feedback_only=True).select(
        "user_id", "item_id", "rating", "ts", "seq")


def q_documents_user(spark, d):
    """One user's feedback, from the one folder of documents that may hold it."""
    fb = documents.read_documents(spark, feedback_documents(spark, d), LOOKUP_USER)
    return merge.merge_ratings(None, fb, feedback_only=True).select(
        "user_id", "item_id", "rating", "ts", "seq")


def q_ratings_profile(spark, d):
    return profile.ratings_profile(merged(spark, d)).select(
        "n_ratings", "n_users", "n_items", r6("mean_rating").alias("mean_rating"))


def q_train_val_split(spark, d):
    return split.with_holdout_flag(merged(spark, d), method=SPLIT).select(
        "user_id", "item_id", "rating", "is_holdout")


def q_id_index(spark, d):
    tr, _ = train_holdout(spark, d)
    u = profile.dense_index(tr.select("user_id"), "user_id").select(
        F.lit("user").alias("kind"), F.col("user_id").alias("raw_id"),
        F.col("user_id_idx").alias("idx"))
    i = profile.dense_index(tr.select("item_id"), "item_id").select(
        F.lit("item").alias("kind"), F.col("item_id").alias("raw_id"),
        F.col("item_id_idx").alias("idx"))
    return u.unionByName(i)


def q_user_history(spark, d):
    return profile.user_summary(merged(spark, d)).select(
        "user_id", "n_ratings", r6("mean_rating").alias("mean_rating"), "min_rating",
        "max_rating", "n_base", "n_feedback")


def q_global_mean(spark, d):
    tr, _ = train_holdout(spark, d)
    return tr.agg(r6(F.avg("rating")).alias("mu"), F.count(F.lit(1)).alias("n_train"))


def q_user_bias(spark, d):
    _, _, ub, _ = _biases(spark, d)
    return ub.select("user_id", r6("bias").alias("bias"), "n")


def q_item_bias(spark, d):
    _, _, _, ib = _biases(spark, d)
    return ib.select("item_id", r6("bias").alias("bias"), "n")


def q_residuals(spark, d):
    tr, mu, ub, ib = _biases(spark, d)
    return bias.residuals(tr, mu, ub, ib).select("user_id", "item_id", "rating",
                                                 r6("y").alias("y"))


def _residual_rows(spark, d):
    tr, mu, ub, ib = _biases(spark, d)
    return bias.residuals(tr, mu, ub, ib)


def q_normal_equations(spark, d):
    rows = _residual_rows(spark, d)  # half steps start from the start factors (None)
    ne = als.normal_equations(rows, None, "user", config.RANK)
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, v: a + v)
    # the upper triangle of X^T X is packed by rows
    return ne.select("user_id", "n", r6(F.col("xtx")[0]).alias("xtx_11"),
                     r6(F.col("xtx")[1]).alias("xtx_12"),
                     r6(F.col("xtx")[config.RANK]).alias("xtx_22"),
                     r6(total("xtx")).alias("xtx_sum"), r6(F.col("xty")[0]).alias("xty_1"),
                     r6(total("xty")).alias("xty_sum"))


def q_als_user_half_step(spark, d):
    rows = _residual_rows(spark, d)  # half steps start from the start factors (None)
    p = als.half_step(rows, None, "user", config.RANK, config.REG)
    return p.select("user_id", "n", *_factors())


def q_als_item_half_step(spark, d):
    rows = _residual_rows(spark, d)  # half steps start from the start factors (None)
    p = als.half_step(rows, None, "user", config.RANK, config.REG)
    q = als.second_half_step(rows, p, "item", config.RANK, config.REG)
    return q.select("item_id", "n", *_factors())


def q_half_step_unregularised(spark, d):
    """A user half step without regularisation: users with too few ratings for the rank have
    singular systems, which take the fallback."""
    rows = _residual_rows(spark, d)  # half steps start from the start factors (None)
    ne = als.normal_equations(rows, None, "user", config.RANK)
    p = als.half_step(rows, None, "user", config.RANK, 0.0)
    c = als.unregularised_check(ne, p, "user", config.RANK)
    return c.select("user_id", "n", "deficient", (F.col("max_error") < 1e-6).alias("solved"))


def q_interaction_lists(spark, d):
    """The chunked lists of both sides, entry by entry."""
    def side(name, other):
        c = profile.interaction_lists(merged(spark, d), name)
        return c.select(F.lit(name).alias("side"), F.col(f"{name}_id").alias("id"), "chunk", "n",
                        F.posexplode("ratings").alias("place", "r")).select(
            "side", "id", "chunk", "n", F.col("place").cast("long").alias("place"),
            F.col(f"r.{other}").alias("other"), F.col("r.rating").alias("rating"))
    return side("user", "item_id").unionByName(side("item", "user_id"))


def q_als_training_history(spark, d):
    h = serving_model(spark, d).history
    return h.select("iteration", r6("train_rmse").alias("train_rmse"),
                    F.round("objective", 4).alias("objective"))


def q_als_fit(spark, d):
    """MLlib ALS at the reference's constants (rank 20, 20 iterations).

    Its start values are random, so the factors differ between runs; that they solve
    each item's weighted normal equations given the user factors does not.
    """
    tr, mu, ub, ib = _biases(spark, d)
    m = _memo(spark, d, "mllib_model", lambda: als.fit_mllib(tr))
    check = als.optimality(bias.residuals(tr, mu, ub, ib), m.user_factors, m.item_factors,
                           "item", config.RANK)
    return m.item_factors.join(check.select("item_id", "max_error"), "item_id").select(
        "item_id", r6("bias").alias("bias"), "n", F.size("factors").alias("rank"),
        (F.col("max_error") < 1e-4).alias("solved"))


def q_model_reload(spark, d):
    m = serving_model(spark, d)
    path = scratch_path(spark, "models")
    save_model(m, path)
    back = load_model(spark, path)
    return back.item_factors.select("item_id", r6("bias").alias("bias"), "n",
                                    *_factors())


def q_predict_pairs(spark, d):
    """The whole holdout by the model of the feedback store: some users and items are
    unknown to it."""
    _, ho = train_holdout(spark, d)
    p = scoring.predict_pairs(ho.select("user_id", "item_id"), feedback_model(spark, d))
    return p.select("user_id", "item_id", r6("raw").alias("raw"),
                    r6("predicted").alias("predicted"))


def q_eval_summary(spark, d):
    _, ho = train_holdout(spark, d)
    s = evaluate.eval_summary(ho, serving_model(spark, d))
    return s.select("n_eval", "n_skipped", r6("rmse").alias("rmse"), r6("mae").alias("mae"))


def q_prediction_errors(spark, d):
    _, ho = train_holdout(spark, d)
    e = evaluate.prediction_errors(ho, serving_model(spark, d))
    return e.select("user_id", "item_id", "actual", F.round("predicted", 4).alias("predicted"),
                    F.round("error", 4).alias("error"))


def q_recommend_personalized(spark, d):
    r = scoring.recommend_personalized(serving_model(spark, d), merged(spark, d),
                                       config.TOP_N)
    return r.select("user_id", F.col("rank").cast("int").alias("rank"), "item_id",
                    r6("score").alias("score"), r6("predicted").alias("predicted"))


def q_similar_items(spark, d):
    """The five nearest items of every item by the model's item factors."""
    s = scoring.similar_items(serving_model(spark, d).item_factors, config.SIMILAR_N)
    return s.select("item_id", F.col("rank").cast("int").alias("rank"), "similar_id",
                    r6("cosine").alias("cosine"))


def q_similar_vectors(spark, d):
    """The five nearest rows of every embedding."""
    s = scoring.similar_items(td.item_vectors(spark, d), config.SIMILAR_N)
    return s.select("item_id", F.col("rank").cast("int").alias("rank"), "similar_id",
                    r6("cosine").alias("cosine"))


def q_recommend_cold_start(spark, d):
    p = scoring.popular_items(movies_catalogue(spark, d), config.POPULAR_N)
    return p.select(F.col("rank").cast("int").alias("rank"), "item_id", "title",
                    r6("avg_rating").alias("avg_rating"), "rating_count")


def q_recommend_routed(spark, d):
    """Every user's list; the model is the one of the feedback store, which does not know
    all users and items, so both branches occur."""
    m = feedback_model(spark, d)
    m_all = merged(spark, d)
    users = catalogue.user_dim(td.users(spark, d), m_all, m)
    r = scoring.recommend_routed(users, m, m_all, movies_catalogue(spark, d), config.TOP_N)
    return r.select("user_id", "source", F.col("rank").cast("int").alias("rank"), "item_id",
                    "title")


def q_movie_stats(spark, d):
    return catalogue.movie_stats(merged(spark, d)).select(
        "item_id", r6("avg_rating").alias("avg_rating"), "rating_count")


def q_catalogue(spark, d):
    c = catalogue.catalogue(td.movies(spark, d), merged(spark, d), feedback_model(spark, d))
    return c.select("item_id", "title", F.array_join("genres", ", ").alias("genres_text"),
                    F.size("genres").alias("n_genres"), r6("avg_rating").alias("avg_rating"),
                    "rating_count", "has_model")


def q_user_dim(spark, d):
    return catalogue.user_dim(td.users(spark, d), merged(spark, d), feedback_model(spark, d))


def q_catalogue_after(spark, d):
    """The page after an id: the condition reaches the scan."""
    c = catalogue.catalogue_after(stats_store(spark, d), PAGE_AFTER)
    return c.select("item_id", "title", r6("avg_rating").alias("avg_rating"), "rating_count")


def q_movie_lookup(spark, d):
    """One movie's record by id."""
    c = catalogue.movie_lookup(stats_store(spark, d), LOOKUP_ITEM)
    return c.select("item_id", "title", r6("avg_rating").alias("avg_rating"), "rating_count")


def q_my_ratings_user(spark, d):
    """One user's ratings with the movies, by a filter on the store."""
    own = merged(spark, d).filter(F.col("user_id") == LOOKUP_USER)
    m = catalogue.my_ratings(own, stats_store(spark, d))
    return m.select("user_id", "item_id", "title", "user_rating",
                    r6("avg_rating").alias("avg_rating"), "rating_count")


def q_catalogue_page(spark, d):
    c = catalogue.catalogue_page(movies_catalogue(spark, d), PAGE)
    return c.select("item_id", "title", r6("avg_rating").alias("avg_rating"), "rating_count")


def q_catalogue_card(spark, d):
    c = catalogue.catalogue_card(movies_catalogue(spark, d))
    return c.select("item_id", "title", "genre_label", "avg_label", "avg_rating_2",
                    "rating_count")


def q_my_ratings(spark, d):
    m = catalogue.my_ratings(merged(spark, d), movies_catalogue(spark, d))
    return m.select("user_id", "item_id", "title", "user_rating",
                    r6("avg_rating").alias("avg_rating"), "rating_count")


def q_movie_detail(spark, d):
    """Every movie of the catalogue with its nearest movies by the feedback model."""
    sim = scoring.similar_items(feedback_model(spark, d).item_factors, config.SIMILAR_N)
    det = catalogue.movie_detail(movies_catalogue(spark, d), sim)
    return det.select("item_id", "title", F.col("rank").cast("int").alias("rank"),
                      "similar_id", "similar_title", r6("cosine").alias("cosine"))


def q_movie_detail_nested(spark, d):
    """The same as one answer per movie: its record and the array of similar records."""
    sim = scoring.similar_items(feedback_model(spark, d).item_factors, config.SIMILAR_N)
    rounded = movies_catalogue(spark, d).withColumn("avg_rating", r6("avg_rating"))
    a = catalogue.movie_answer(rounded, sim.withColumn("cosine", r6("cosine")))
    return a.select("item_id", F.to_json(F.struct("movie", "similar")).alias("answer"),
                    F.size("similar").alias("n_similar"))


def q_rating_upsert(spark, d):
    """Every event applied to a store of the merged ratings; what it gives for the movies that
    got one."""
    path = store.create_store(merged(spark, d), scratch_path(spark, "store"))
    touched = store.upsert_store(td.rating_events(spark, d), path)
    return td.movies(spark, d).select("item_id", "title").join(touched, "item_id").select(
        "item_id", "title", r6("avg_rating").alias("avg_rating"), "rating_count")


def _as_stream(spark, table: DataFrame) -> DataFrame:
    """A written table read as a stream."""
    folder = table.inputFiles()[0].rsplit("/", 1)[0]
    return spark.readStream.schema(table.schema).parquet(folder)


def live_store(spark, d) -> str:
    """Checkpoint of the query that has read the ratings store and the whole events table."""
    def build():
        raw = (spark.readStream.schema(td.table(spark, d, "events").schema)
               .option("pathGlobFilter", "events.parquet").parquet(d))
        checkpoint = scratch_path(spark, "live")
        live.run(td.event_columns(raw), checkpoint, _as_stream(spark, merged(spark, d)))
        return checkpoint
    return _memo(spark, d, "live_store", build)


def q_movie_stats_stream(spark, d):
    """Item statistics over the stored ratings and all streamed events."""
    s = live.live_stats(spark, live_store(spark, d))
    return s.select("item_id", r6("avg_rating").alias("avg_rating"), "rating_count")


def q_ratings_snapshot_stream(spark, d):
    """The current rating of every pair after all streamed events."""
    cur = live.live_ratings(spark, live_store(spark, d))
    return cur.select("user_id", "item_id", "rating", "seq")


def q_popular_stream(spark, d):
    """The popularity list after all streamed events."""
    p = live.live_popular(spark, live_store(spark, d), td.movies(spark, d))
    return p.select(F.col("rank").cast("int").alias("rank"), "item_id", "title",
                    r6("avg_rating").alias("avg_rating"), "rating_count")


def q_retrain_eval(spark, d):
    """Retraining from the feedback store only, evaluated on its holdout."""
    fb = merge.merge_ratings(None, td.feedback_ratings(spark, d), feedback_only=True)
    _, ho = split.train_holdout(fb, method=SPLIT)
    s = evaluate.eval_summary(ho, feedback_model(spark, d))
    return s.select("n_eval", "n_skipped", r6("rmse").alias("rmse"), r6("mae").alias("mae"))


def q_promote_decision(spark, d):
    _, ho = train_holdout(spark, d)
    cur = evaluate.eval_summary(ho, serving_model(spark, d))
    cand = evaluate.eval_summary(ho, feedback_model(spark, d))
    p = promote_decision(cur, cand)
    return p.select(r6("old_rmse").alias("old_rmse"), r6("new_rmse").alias("new_rmse"),
                    r6("old_mae").alias("old_mae"), r6("new_mae").alias("new_mae"), "promote")


def q_retrain(spark, d):
    """Two retrainings into one folder: both sources, then feedback only; feedback is read
    from documents.

    The second is promoted only if it is no worse on its own holdout; the last column
    says which version the pointer names afterwards.
    """
    out = scratch_path(spark, "versions")
    base = td.base_ratings(spark, d)
    fb = documents.read_documents(spark, feedback_documents(spark, d))
    a = retrain(base, fb, out, version="all", method=SPLIT)
    b = retrain(base, fb, out, feedback_only=True, version="feedback", method=SPLIT)
    rows = a.unionByName(b)
    saved = load_model(spark, f"{out}/all")
    meta = [F.lit(saved.n_train).alias("saved_n_train"),
            F.lit(read_current_pointer(spark, out)).alias("current")]
    return rows.select("version", "n_train", "n_eval", "n_skipped",
                       r6("new_rmse").alias("new_rmse"), r6("new_mae").alias("new_mae"),
                       "promote", *meta)


def q_retrain_due(spark, d):
    """Ratings newer than the base snapshot (the last base rating) vs. 1000."""
    base_end = td.base_ratings(spark, d).select(F.max("ts")).scalar()
    return retrain_due(merged(spark, d), base_end, 1000)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ratings_valid": q_ratings_valid,
    "rating_rejects": q_rating_rejects,
    "ratings_merged": q_ratings_merged,
    "ratings_feedback_only": q_ratings_feedback_only,
    "ratings_documents": q_ratings_documents,
    "documents_user": q_documents_user,
    "ratings_profile": q_ratings_profile,
    "train_val_split": q_train_val_split,
    "id_index": q_id_index,
    "user_history": q_user_history,
    "global_mean": q_global_mean,
    "user_bias": q_user_bias,
    "item_bias": q_item_bias,
    "residuals": q_residuals,
    "normal_equations": q_normal_equations,
    "als_user_half_step": q_als_user_half_step,
    "als_item_half_step": q_als_item_half_step,
    "half_step_unregularised": q_half_step_unregularised,
    "interaction_lists": q_interaction_lists,
    "als_training_history": q_als_training_history,
    "als_fit": q_als_fit,
    "model_reload": q_model_reload,
    "predict_pairs": q_predict_pairs,
    "eval_summary": q_eval_summary,
    "prediction_errors": q_prediction_errors,
    "recommend_personalized": q_recommend_personalized,
    "similar_items": q_similar_items,
    "similar_vectors": q_similar_vectors,
    "recommend_cold_start": q_recommend_cold_start,
    "recommend_routed": q_recommend_routed,
    "movie_stats": q_movie_stats,
    "catalogue": q_catalogue,
    "user_dim": q_user_dim,
    "catalogue_page": q_catalogue_page,
    "catalogue_after": q_catalogue_after,
    "movie_lookup": q_movie_lookup,
    "my_ratings_user": q_my_ratings_user,
    "catalogue_card": q_catalogue_card,
    "my_ratings": q_my_ratings,
    "movie_detail": q_movie_detail,
    "movie_detail_nested": q_movie_detail_nested,
    "rating_upsert": q_rating_upsert,
    "movie_stats_stream": q_movie_stats_stream,
    "ratings_snapshot_stream": q_ratings_snapshot_stream,
    "popular_stream": q_popular_stream,
    "retrain": q_retrain,
    "retrain_eval": q_retrain_eval,
    "promote_decision": q_promote_decision,
    "retrain_due": q_retrain_due,
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What should each user see next: personalised or popularity list."""
    return q_recommend_routed(spark, sf_dir)
