"""Benchmark of the headline jobs; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8).  Stages timed (seconds, each forced with a full write-free
action over the whole result):

  merge_bias       validate + keep-last merge + split + mu + user/item biases
                   + residual targets
  fit_mllib        MLlib ALS on residuals at rank 20, 20 iterations, lambda 0.1
  fit_exact        exact solver at rank 20, 20 iterations, with the train RMSE history
  recommend_all    top-10 unseen items for every user (rank-20 model)
  similar_items    top-5 cosine neighbours of every item vector
  evaluate         holdout RMSE / MAE of the model and of the bias-only model
  catalogue        item statistics, catalogue, popularity top-10, user dimension
  stats_stream     live store over all ratings, the whole event table streamed into it,
                   statistics read back
  routed           the flagship: personalised or popularity list for every user
  upsert           all rating events applied, statistics of the touched items
  snapshot         current rating of every pair after the stream
  detail           every movie with its nearest movies
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from pyspark.sql import functions as F

    from rankfold.operators import als, bias, catalogue, evaluate, merge, scoring, split
    from rankfold.plans import catalog as cat
    from rankfold.session import get_spark, scratch_path
    from rankfold.sources import testdata as td
    from rankfold.streaming import item_stats as live

    spark = get_spark(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus),
                      conf={"spark.driver.memory": "16g",
                            "spark.eventLog.enabled": "true",
                            "spark.eventLog.dir": tempfile.mkdtemp(prefix="rankfold-ev-")})
    spark.range(100_000).selectExpr("sum(id)").first()  # JVM / codegen warm-up, untimed
    times: dict[str, float] = {}
    extra: dict[str, float] = {}

    def timed(name, fn):
        t = time.time()
        out = fn()
        times[name] = round(time.time() - t, 3)
        return out

    def run_merge_bias():
        m = merge.merge_ratings(td.base_ratings(spark, sf_dir), td.feedback_ratings(spark, sf_dir))
        path = scratch_path(spark, "bench", "ratings")
        m.write.parquet(path)
        m = spark.read.parquet(path)
        tr, ho = split.train_holdout(m, method="linear")
        mu = bias.global_mean(tr)
        ub = bias.user_bias(tr, mu)
        ib = bias.item_bias(tr, mu, ub)
        res = bias.residuals(tr, mu, ub, ib)
        res.agg(F.sum("y"), F.count(F.lit(1))).first()
        return m, tr, ho

    merged, train, hold = timed("merge_bias", run_merge_bias)
    model = timed("fit_mllib", lambda: als.fit_mllib(train))
    model.user_factors.count()

    def run_exact():
        m = als.fit_exact(train)
        last = m.history.orderBy(F.col("iteration").desc()).first()
        extra["fit_exact_train_rmse"] = round(last["train_rmse"], 6)
    timed("fit_exact", run_exact)

    def run_rec():
        r = scoring.recommend_personalized(model, merged, 10)
        return r.agg(F.count(F.lit(1)), F.sum("score")).first()
    timed("recommend_all", run_rec)

    def run_sim():
        s = scoring.similar_items(td.item_vectors(spark, sf_dir), 5)
        return s.agg(F.count(F.lit(1)), F.sum("cosine")).first()
    timed("similar_items", run_sim)

    def run_eval():
        a = evaluate.eval_summary(hold, model).first()
        b = evaluate.bias_only_summary(hold, model).first()
        extra.update(rmse=round(a["rmse"], 6), mae=round(a["mae"], 6),
                     bias_only_rmse=round(b["rmse"], 6), bias_only_mae=round(b["mae"], 6),
                     n_eval=a["n_eval"])
    timed("evaluate", run_eval)

    def run_cat():
        c = catalogue.catalogue(td.movies(spark, sf_dir), merged, model)
        c.agg(F.sum("avg_rating")).first()
        scoring.popular_items(c, 10).collect()
        catalogue.user_dim(td.users(spark, sf_dir), merged, model).agg(
            F.count(F.lit(1))).first()
    timed("catalogue", run_cat)

    movies = td.movies(spark, sf_dir)

    def run_stream():
        raw = (spark.readStream.schema(td.table(spark, sf_dir, "events").schema)
               .option("pathGlobFilter", "events.parquet").parquet(sf_dir))
        store = scratch_path(spark, "bench", "ratings")
        merged.write.parquet(store)
        checkpoint = scratch_path(spark, "bench", "live")
        live.run(td.event_columns(raw), checkpoint,
                 spark.readStream.schema(merged.schema).parquet(store))
        live.live_stats(spark, checkpoint).agg(F.sum("avg_rating")).first()
        return checkpoint
    state = timed("stats_stream", run_stream)
    timed("snapshot", lambda: live.live_ratings(spark, state).agg(F.sum("rating")).first())

    def run_routed():
        c = catalogue.catalogue(movies, merged, model)
        users = catalogue.user_dim(td.users(spark, sf_dir), merged, model)
        return scoring.recommend_routed(users, model, merged, c, 10).agg(
            F.count(F.lit(1)), F.max("rank")).first()
    timed("routed", run_routed)

    def run_upsert():
        c = catalogue.catalogue(movies, merged, None)
        _, touched = catalogue.rating_upsert(merged, td.rating_events(spark, sf_dir), c)
        return touched.agg(F.sum("avg_rating")).first()
    timed("upsert", run_upsert)

    def run_detail():
        c = catalogue.catalogue(movies, merged, None)
        return catalogue.movie_detail(c, scoring.similar_items(model.item_factors, 5)).agg(
            F.count(F.lit(1)), F.sum("cosine")).first()
    timed("detail", run_detail)

    total = round(sum(times.values()), 3)
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    print(json.dumps({"metric": "total_sec", "value": total, "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus, "quality": extra,
                      "n_queries_registered": len(cat.QUERIES)}))
    spark.stop()


if __name__ == "__main__":
    main()
