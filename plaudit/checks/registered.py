"""Registered queries: name to ``(spark, directory) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plaudit.checks import stage
from plaudit.operators import anomaly, classify, embed, keyed, probing, sample, similar, topics
from plaudit.operators.clean import clean_reviews
from plaudit.operators.documents import search_documents, upsert_documents
from plaudit.operators.isolation_forest import IsolationForest
from plaudit.operators.quality import REVIEWS_SUITE, Suite, summarise, validate
from plaudit.operators.scoring import score_sentiment
from plaudit.plans import analytics, increments, marts, warehouse
from plaudit.session import ship_package
from plaudit.sources.adapter import as_of, table
from plaudit.sources.lake import Lake, land, land_csv, read_bronze, write_csv
from plaudit.storage import balanced, materialise, work_path
from plaudit.streaming.jobs import file_messages, read_serving, start_scoring, start_serving
from plaudit.streaming.messages import parse_messages, score_messages, to_messages

Query = Callable[[SparkSession, str], DataFrame]

# The two loads of the incremental queries: reviews before this day, then all from it on.
SPLIT_DAY = "1996-01-01"
TOPIC_STOP_WORDS = ("the", "it", "to", "this", "with", "at", "does", "though")
SAMPLE_ROWS = 1000
NEIGHBOURS = 10


def silver_reviews(spark, directory):
    return clean_reviews(stage.raw(spark, directory), as_of())


def bronze_reviews(spark, directory):
    return stage.raw(spark, directory)


def csv_landing(spark, directory):
    """A CSV export of the raw reviews is landed unchanged and read back."""
    source = work_path(spark, "export")
    write_csv(stage.raw(spark, directory), source, "gzip")
    lake = Lake(work_path(spark, "landing"))
    land_csv(spark, lake, source)
    return read_bronze(spark, lake).drop("ingest_date")


def csv_two_landings(spark, directory):
    """Two exports with other column orders, one with a further column, land in one go; nothing is lost."""
    source = work_path(spark, "exports")
    rows = stage.raw(spark, directory)
    late = F.col("product_id").substr(-1, 1).isin("0", "1", "2")
    write_csv(rows.filter(~late), f"{source}/first", "gzip")
    more = rows.filter(late).withColumn("store", F.concat(F.lit("store "), F.substring("customer_id", -1, 1)))
    write_csv(more.select(*reversed(more.columns)), f"{source}/second", "gzip")
    lake = Lake(work_path(spark, "landing"))
    land_csv(spark, lake, source)
    return read_bronze(spark, lake, rescued=True).drop("ingest_date").withColumn(
        "rescued", F.get_json_object("rescued", "$.store")).withColumnRenamed("rescued", "store")


@stage.once
def _incremental_lake(spark, directory):
    """Silver and Gold after three loads; repeated ids come in different loads, so first rows get replaced."""
    lake = Lake(work_path(spark, "increments"))
    rows = stage.raw(spark, directory)
    load = F.pmod(F.xxhash64("product_id", "customer_id", "review_text", "review_date"), F.lit(3))
    for number in range(3):
        land(rows.filter(load == number), lake)
        increments.refresh_silver(spark, lake, as_of())
        increments.refresh_gold(spark, lake)
    return lake


def silver_incremental(spark, directory):
    """Silver after three incremental loads."""
    return increments.read_silver_version(spark, _incremental_lake(spark, directory))


def gold_incremental(spark, directory):
    """The three marts, brought forward by two increments, as one table."""
    lake = _incremental_lake(spark, directory)

    def rows(name, *keys):
        mart = increments.read_gold(spark, lake, name)
        named = [F.col(key).cast("string") if key else F.lit(None).cast("string") for key in keys]
        first, last = (F.col(c) if c in mart.columns else F.lit(None).cast("date") for c in ("first_review", "last_review"))
        length = F.col("avg_review_length") if "avg_review_length" in mart.columns else F.lit(None).cast("double")
        return mart.select(
            F.lit(name).alias("mart"), *[column.alias(f"key_{i}") for i, column in enumerate(named, 1)],
            "review_count", "avg_rating", length.alias("avg_review_length"), first.alias("first_review"), last.alias("last_review"))

    return (
        rows("daily_category_sentiment", "review_date", "category", None)
        .unionByName(rows("product_summary", "product_id", "product_name", "category"))
        .unionByName(rows("topic_distribution", "category", "topic", None)))


def layer_counts(spark, directory):
    """Raw and Silver row counts."""
    count = F.count(F.lit(1)).alias("reviews")
    raw = stage.raw(spark, directory).agg(count).withColumn("layer", F.lit("bronze"))
    clean = stage.silver(spark, directory).agg(count).withColumn("layer", F.lit("silver"))
    return raw.unionByName(clean).select("layer", "reviews")


def gold_daily_category(spark, directory):
    return marts.daily_category_sentiment(stage.silver(spark, directory))


def gold_product_summary(spark, directory):
    return marts.product_summary(stage.silver(spark, directory))


def gold_topic_distribution(spark, directory):
    return marts.topic_distribution(stage.silver(spark, directory))


def sentiment_scored(spark, directory):
    scored = score_sentiment(stage.silver(spark, directory))
    return scored.select("review_id", "sentiment_stars", "sentiment_label", "sentiment_model")


def text_features(spark, directory):
    """Lengths and word counts of raw, untrimmed texts."""
    text = F.col("review_text")
    raw = stage.raw(spark, directory).filter(F.col("review_id").isNotNull() & text.isNotNull())
    return raw.select(
        "review_id", "review_date", F.length(text).alias("review_length"),
        anomaly.raw_word_count(text).alias("word_count"))


def rating_mismatch(spark, directory):
    scored = anomaly.with_mismatch(score_sentiment(stage.silver(spark, directory)))
    return scored.select("review_id", "rating", "sentiment_stars", "rating_sentiment_gap", "flag_mismatch")


def duplicate_spam(spark, directory):
    flagged = anomaly.with_spam(stage.silver(spark, directory))
    return flagged.select("review_id", "text_customer_spread", "flag_duplicate_spam")


def document_text_spread(spark, directory):
    """For every document the number of sources that carry exactly its text."""
    documents = table(spark, directory, "documents").select("doc_id", "text", "source")
    return anomaly.with_text_spread(documents, "text", "source", "source_spread").select("doc_id", "source_spread")


def rule_flag_summary(spark, directory):
    ruled = anomaly.with_rule_flags(stage.silver(spark, directory)).withColumn("flag_outlier", F.lit(False))
    return anomaly.flag_summary(
        ruled.withColumn("is_suspicious", anomaly.any_flag("flag_mismatch", "flag_duplicate_spam")))


def _adapter_suite() -> Suite:
    """The default suite with the category names of the order tables."""
    from dataclasses import replace

    kinds = ("LARGE", "MEDIUM", "ECONOMY", "PROMO", "SMALL", "STANDARD")
    checks = tuple(replace(c, values=kinds) if c.type == "in_set" else c for c in REVIEWS_SUITE.checks)
    return Suite("reviews_silver", checks)


def dq_report(spark, directory):
    return validate(stage.silver(spark, directory), _adapter_suite(), as_of())


def dq_report_dirty(spark, directory):
    return validate(stage.raw(spark, directory), REVIEWS_SUITE, as_of())


def dq_summary(spark, directory):
    suite = _adapter_suite()
    return summarise(validate(stage.raw(spark, directory), suite, as_of()), suite)


def model_tests(spark, directory):
    return analytics.model_tests(spark, stage.star(spark, directory))


def star_constraints(spark, directory):
    return warehouse.check_constraints(spark, stage.star(spark, directory))


def dim_date(spark, directory):
    return warehouse.merge_dates(warehouse.empty_star(spark).dim_date, stage.silver(spark, directory))


def dim_category(spark, directory):
    return warehouse.merge_categories(warehouse.empty_star(spark).dim_category, stage.silver(spark, directory))


def dim_product(spark, directory):
    silver = stage.silver(spark, directory)
    categories = stage.star(spark, directory).dim_category
    return warehouse.merge_products(warehouse.empty_star(spark).dim_product, silver, categories)


def dim_customer(spark, directory):
    return warehouse.merge_customers(warehouse.empty_star(spark).dim_customer, stage.silver(spark, directory))


def fact_reviews(spark, directory):
    flagged = warehouse.rule_flagged(stage.silver(spark, directory))
    return warehouse.fact_rows(flagged, stage.star(spark, directory).dim_category)


def _halves(spark, directory):
    silver = stage.silver(spark, directory)
    early = F.col("review_date") < F.lit(SPLIT_DAY).cast("date")
    return silver.filter(early), silver.filter(~early)


def insert_ignore(spark, directory):
    """Products of the early reviews, then those of the late ones: known products stay as they are."""
    before, after = _halves(spark, directory)
    categories = stage.star(spark, directory).dim_category
    first = warehouse.product_rows(before, categories)
    return warehouse.merge_products(first, after, categories)


def customer_upsert(spark, directory):
    before, after = _halves(spark, directory)
    return warehouse.merge_customers(warehouse.customer_rows(before), after)


def surrogate_keys_incremental(spark, directory):
    """Product names numbered in two loads; the first numbers stay."""
    before, after = _halves(spark, directory)
    start = spark.createDataFrame([], "name_id int, product_name string")
    first = keyed.number_new(start, before.filter("rating = 1"), "name_id", "product_name")
    return keyed.number_new(first, after, "name_id", "product_name")


def stg_reviews(spark, directory):
    return analytics.stg_reviews(stage.star(spark, directory))


def mart_category_sentiment(spark, directory):
    return analytics.mart_category_sentiment(stage.star(spark, directory))


def mart_daily_trends(spark, directory):
    return analytics.mart_daily_trends(stage.star(spark, directory))


def overview(spark, directory):
    return analytics.overview(stage.star(spark, directory))


def by_category(spark, directory):
    return analytics.by_category(stage.star(spark, directory))


def daily(spark, directory):
    return analytics.daily(stage.star(spark, directory))


def suspicious(spark, directory):
    return analytics.suspicious(stage.star(spark, directory))


def parameter_query(spark, directory):
    """SQL with a named parameter over the registered star."""
    stage.star(spark, directory).register()
    return warehouse.query(
        spark,
        "SELECT category_id, count(*) AS reviews FROM fact_reviews WHERE rating >= :least GROUP BY category_id",
        {"least": 4},
    )


def json_round_trip(spark, directory):
    """Silver reviews as keyed JSON messages and back to typed columns."""
    message = stage.silver(spark, directory).select("review_id", "category", "rating", "review_text")
    return parse_messages(to_messages(message))


def event_props(spark, directory):
    """The JSON properties of all events as a typed column."""
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("k", T.LongType())])
    events = table(spark, directory, "events")
    return events.select("event_id", F.from_json("props", schema)["k"].alias("k"))


def seeded_sample(spark, directory):
    return sample.fixed_sample(
        stage.silver(spark, directory).select("review_id", "rating", "review_text"), SAMPLE_ROWS, "review_id", seed=7)


def seeded_shuffle(spark, directory):
    return sample.shuffled(stage.silver(spark, directory).select("review_id", "rating"), "review_id", seed=7)


def _every_fiftieth(spark, directory):
    """The vectors that search queries ask for: all with an id divisible by 50."""
    return table(spark, directory, "embeddings").filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


def knn_cosine(spark, directory):
    return similar.nearest(
        table(spark, directory, "embeddings"), _every_fiftieth(spark, directory), NEIGHBOURS
    ).withColumn("score", F.floor(F.col("score") * 10000 + 0.5) / 10000)


def knn_lsh(spark, directory):
    return probing.nearest_probed(
        table(spark, directory, "embeddings"), _every_fiftieth(spark, directory), NEIGHBOURS)


def knn_lsh_quality(spark, directory):
    """Neighbours that exact search finds, whether multi-probe search finds 90 % of them with exact scores, and
    whether it compares fewer than all pairs."""
    corpus, queries = table(spark, directory, "embeddings"), _every_fiftieth(spark, directory)
    keys = ["query_id", "vec_id"]
    tried = materialise(probing.probed_candidates(corpus, queries, NEIGHBOURS, best=NEIGHBOURS), "tried")
    exact = similar.nearest(corpus, queries, NEIGHBOURS)
    found = similar.best_of(tried, NEIGHBOURS).select(*keys, F.col("score").alias("probed_score"))
    both = exact.join(found, keys, "left").agg(
        F.count(F.lit(1)).alias("neighbours"), F.avg(F.col("probed_score").isNotNull().cast("int")).alias("recall"),
        F.max(F.abs(F.col("score") - F.col("probed_score"))).alias("error"))
    counts = tried.agg(F.sum("tried").alias("tried"))
    sizes = corpus.agg(F.count(F.lit(1)).alias("vectors")), queries.agg(F.count(F.lit(1)).alias("asked"))
    row = [both, counts, *sizes]
    one = [part.withColumn("one", F.lit(1)) for part in row]
    joined = one[0].join(one[1], "one").join(one[2], "one").join(one[3], "one")
    return joined.select(
        "asked", "neighbours", (F.col("error") <= 2e-6).alias("scores_exact"),
        (F.col("tried") < F.col("vectors") * F.col("asked")).alias("prunes"), (F.col("recall") >= 0.9).alias("recalls"))


def similar_reviews(spark, directory):
    """The score of the most similar other review, for the first review of each text of several reviews."""
    reviews = stage.silver(spark, directory).select("review_id", "review_text")
    wanted = reviews.groupBy("review_text").agg(F.min("review_id").alias("review_id"), F.count(F.lit(1)).alias("n"))
    found = similar.similar_reviews(reviews, wanted.filter("n > 1").select("review_id", "review_text"), 1, exact=True)
    return found.select("query_id", F.round("score", 4).alias("score"))


@stage.once
def _topics(spark, directory):
    return topics.fit_topics(stage.silver(spark, directory).select("review_id", "review_text"))


def topic_vocabulary(spark, directory):
    """The 2,000 most frequent terms of the review texts with their document counts."""
    return topics.vocabulary(
        stage.silver(spark, directory), "review_text", stop_words=TOPIC_STOP_WORDS)


def document_vocabulary(spark, directory):
    """The same over the whole texts of the documents."""
    return topics.vocabulary(balanced(table(spark, directory, "documents").select("text")), "text", stop_words=TOPIC_STOP_WORDS)


def topic_labels(spark, directory):
    return _topics(spark, directory).labelled


def topic_terms(spark, directory):
    return _topics(spark, directory).terms


def topic_sizes(spark, directory):
    return _topics(spark, directory).sizes()


def outlier_forest(spark, directory):
    measured = anomaly.forest_features(anomaly.with_rule_flags(stage.silver(spark, directory)))
    model = IsolationForest(anomaly.FOREST_FEATURES).fit(measured)
    return model.transform(measured, "flag_outlier", "outlier_score").select(
        "review_id", "outlier_score", "flag_outlier")


def review_anomalies(spark, directory):
    return anomaly.detect(stage.silver(spark, directory)).select(
        "review_id", "sentiment_stars", "rating_sentiment_gap", "flag_mismatch", "text_customer_spread",
        "flag_duplicate_spam", "flag_outlier", "is_suspicious")


def text_classifier(spark, directory):
    """Stars predicted for all reviews by a classifier trained on samples of two separate halves."""
    reviews = stage.silver(spark, directory).select(
        "review_id", F.col("review_text").alias("text"), F.col("rating").alias("label"))
    train = F.pmod(F.xxhash64("review_id"), F.lit(2)) == 0
    model = classify.train_classifier(reviews.filter(train), reviews.filter(~train), "review_id")
    return model.transform(reviews, "text").select("review_id", "label", "sentiment_stars", "sentiment_label")


def text_embedding(spark, directory):
    documents = balanced(table(spark, directory, "documents").select("doc_id", "text"))
    return embed.embed(documents, "text").select("doc_id", "embedding")


def search_index(spark, directory):
    return search_documents(stage.silver(spark, directory), with_vector=False)


def search_upsert(spark, directory):
    """Early reviews are indexed, then all late ones and, twice, the early five-star ones; the later text wins."""
    before, after = _halves(spark, directory)
    first = before.filter("rating = 5").withColumn("review_text", F.lit("zz first edit"))
    again = first.withColumn("review_text", F.lit("edited review"))
    written = [part.withColumn("written", F.lit(n)) for n, part in enumerate((after, first, again))]
    existing = search_documents(before, with_vector=False)
    incoming = search_documents(
        written[0].unionByName(written[1]).unionByName(written[2]), with_vector=False, keep=("written",))
    return upsert_documents(existing, incoming, ("written",))


def _message_files(spark, directory) -> str:
    path = work_path(spark, "messages")
    messages = to_messages(stage.raw(spark, directory)).select("value")
    messages.write.text(path, compression="gzip")
    return path


def stream_scored(spark, directory):
    """All raw reviews as a message stream, scored into Parquet."""
    out, checkpoint = work_path(spark, "scored"), work_path(spark, "scored-checkpoint")
    start_scoring(
        file_messages(spark, _message_files(spark, directory)), checkpoint, sink="parquet",
        options={"path": out}, trigger={"availableNow": True}, as_messages=False,
    ).awaitTermination()
    return spark.read.parquet(out)


def stream_serving(spark, directory):
    """The scored stream folded into a serving table: per review the row that arrived last.

    The raw reviews have no arrival time; their rating stands for it.
    """
    out, checkpoint = work_path(spark, "serving"), work_path(spark, "serving-checkpoint")
    messages = file_messages(spark, _message_files(spark, directory)).withColumn(
        "arrival", F.get_json_object("value", "$.rating").cast("long"))
    scored = score_messages(messages, carry=("arrival",))
    start_serving(scored, out, checkpoint, {"availableNow": True}).awaitTermination()
    return read_serving(spark, out, ("arrival",))


def batch_scored_messages(spark, directory):
    """The streaming transformation on a batch of keyed messages."""
    return to_messages(score_messages(to_messages(stage.raw(spark, directory))))


def labelled_texts(spark, directory):
    """Documents with their quality label, written and read back as a labelled collection."""
    from plaudit.sources.lake import read_labelled

    joined = table(spark, directory, "documents").join(table(spark, directory, "labels"), "doc_id")
    path = work_path(spark, "labelled")
    joined.select(F.col("doc_id").alias("_id"), "text", F.col("quality").alias("label")).write.json(path)
    return read_labelled(spark, path).select("text", "label")


def _with_package(query: Query) -> Query:
    """The session may come from outside; its Python workers need this package."""

    @wraps(query)
    def run(spark: SparkSession, directory: str) -> DataFrame:
        ship_package(spark)
        return query(spark, directory)

    return run


QUERIES: dict[str, Query] = {
    query.__name__: _with_package(query)
    for query in (
        bronze_reviews, csv_landing, csv_two_landings, silver_incremental, gold_incremental, layer_counts, silver_reviews,
        gold_daily_category, gold_product_summary, gold_topic_distribution,
        sentiment_scored, text_features, rating_mismatch, duplicate_spam, document_text_spread, rule_flag_summary,
        dq_report, dq_report_dirty, dq_summary, model_tests, star_constraints,
        dim_date, dim_category, dim_product, dim_customer, fact_reviews,
        insert_ignore, customer_upsert, surrogate_keys_incremental,
        stg_reviews, mart_category_sentiment, mart_daily_trends, overview, by_category, daily, suspicious,
        parameter_query, json_round_trip, event_props, seeded_sample, seeded_shuffle,
        knn_cosine, knn_lsh, knn_lsh_quality, similar_reviews, topic_vocabulary, document_vocabulary, topic_labels, topic_terms, topic_sizes,
        outlier_forest, review_anomalies, text_classifier, text_embedding, search_index, search_upsert,
        stream_scored, stream_serving, batch_scored_messages, labelled_texts,
    )
}
