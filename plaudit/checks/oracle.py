"""SQL for DuckDB with the results the registered queries must give.

Every statement starts from the order tables and spells the computation out on its own; nothing
here shares expressions with the Spark side except the raw-review view and fixed word lists.
"""

from __future__ import annotations

from plaudit.checks.registered import (
    NEIGHBOURS,
    SAMPLE_ROWS,
    SPLIT_DAY,
    TOPIC_STOP_WORDS,
)
from plaudit.functions.sentiment import DEFAULT_LEXICON
from plaudit.operators.quality import REVIEWS_SUITE
from plaudit.plans.analytics import LABELS, STARS
from plaudit.sources.adapter import AS_OF, RAW_REVIEWS_SQL


def quoted(value) -> str:
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def listed(values) -> str:
    return ", ".join(quoted(v) for v in values)


def stars(text: str) -> str:
    words = f"list_transform(string_split_regex({text}, '\\s+'), lambda w: lower(trim(w, '.,!?')))"
    score = (f"len(list_intersect({words}, [{listed(DEFAULT_LEXICON.positive)}]))"
             f" - len(list_intersect({words}, [{listed(DEFAULT_LEXICON.negative)}]))")
    return (f"CASE WHEN {score} >= 2 THEN 5 WHEN {score} = 1 THEN 4 WHEN {score} = 0 THEN 3"
            f" WHEN {score} = -1 THEN 2 ELSE 1 END")


def label(star: str) -> str:
    return f"CASE WHEN {star} <= 2 THEN 'negative' WHEN {star} = 3 THEN 'neutral' ELSE 'positive' END"


# Named pieces; a statement pulls in the ones it names, in this order.
PIECES = {
    "raw": RAW_REVIEWS_SQL.format(lineitem="lineitem", orders="orders", part="part"),
    "valid": f"""
        SELECT * FROM (
          SELECT review_id, product_id, product_name, category, customer_id, rating,
                 trim(regexp_replace(review_text, '\\s+', ' ', 'g')) AS review_text, topic,
                 try_cast(review_date AS DATE) AS review_date
          FROM raw WHERE review_id IS NOT NULL AND review_text IS NOT NULL AND rating BETWEEN 1 AND 5)
        WHERE length(review_text) >= 3 AND review_date <= DATE '{AS_OF}'""",
    "silver": """
        SELECT review_id, product_id, product_name, customer_id, rating, review_text, topic, review_date,
               CAST(length(review_text) AS INTEGER) AS review_length,
               CAST(len(string_split_regex(review_text, '\\s+')) AS INTEGER) AS word_count,
               CAST(year(review_date) AS INTEGER) AS review_year,
               CAST(month(review_date) AS INTEGER) AS review_month, category
        FROM (SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY review_date NULLS FIRST,
                product_id NULLS FIRST, customer_id NULLS FIRST, rating NULLS FIRST, review_text NULLS FIRST,
                product_name NULLS FIRST, category NULLS FIRST, topic NULLS FIRST) AS place FROM valid)
        WHERE place = 1""",
    "scored": f"""
        SELECT *, {label('sentiment_stars')} AS sentiment_label
        FROM (SELECT *, CAST({stars('review_text')} AS INTEGER) AS sentiment_stars FROM silver)""",
    "spread": """
        SELECT review_text AS spread_text, count(DISTINCT customer_id) AS text_customer_spread
        FROM silver GROUP BY review_text""",
    "flagged": """
        SELECT s.*, CAST(abs(rating - sentiment_stars) AS INTEGER) AS rating_sentiment_gap,
               abs(rating - sentiment_stars) >= 3 AS flag_mismatch,
               text_customer_spread, text_customer_spread >= 3 AS flag_duplicate_spam,
               abs(rating - sentiment_stars) >= 3 OR text_customer_spread >= 3 AS is_suspicious
        FROM scored s JOIN spread ON review_text = spread_text""",
    "dim_date": """
        SELECT DISTINCT CAST(strftime(review_date, '%Y%m%d') AS INTEGER) AS date_id, review_date AS full_date,
               CAST(year(review_date) AS SMALLINT) AS year, CAST(month(review_date) AS SMALLINT) AS month,
               CAST(day(review_date) AS SMALLINT) AS day, CAST(isodow(review_date) AS SMALLINT) AS weekday,
               isodow(review_date) >= 6 AS is_weekend
        FROM silver""",
    "dim_category": """
        SELECT CAST(row_number() OVER (ORDER BY category) AS INTEGER) AS category_id, category AS category_name
        FROM (SELECT DISTINCT category FROM silver WHERE category IS NOT NULL)""",
    "dim_product": """
        SELECT product_id, product_name, category_id
        FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY review_date, review_id) AS place FROM silver)
        LEFT JOIN dim_category ON category_name = category
        WHERE place = 1 AND product_id IS NOT NULL""",
    "dim_customer": """
        SELECT customer_id, min(review_date) AS first_seen, CAST(count(review_id) AS INTEGER) AS review_count
        FROM silver WHERE customer_id IS NOT NULL GROUP BY customer_id""",
    "fact_reviews": """
        SELECT review_id, product_id, customer_id, CAST(strftime(review_date, '%Y%m%d') AS INTEGER) AS date_id,
               category_id, CAST(rating AS SMALLINT) AS rating, CAST(sentiment_stars AS SMALLINT) AS sentiment_stars,
               sentiment_label, review_length, word_count, is_suspicious
        FROM flagged LEFT JOIN dim_category ON category_name = category""",
    "stg_reviews": """
        SELECT f.review_id, f.product_id, p.product_name, c.category_name, f.customer_id,
               d.full_date AS review_date, d.year AS review_year, d.month AS review_month, d.is_weekend,
               f.rating, f.sentiment_stars, f.sentiment_label, f.review_length, f.word_count, f.is_suspicious
        FROM fact_reviews f
        LEFT JOIN dim_product p ON p.product_id = f.product_id
        LEFT JOIN dim_category c ON c.category_id = f.category_id
        LEFT JOIN dim_date d ON d.date_id = f.date_id""",
    "mart_category_sentiment": """
        SELECT category_name, count(*) AS reviews, round(avg(rating), 3) AS avg_rating,
               round(avg(sentiment_stars), 3) AS avg_sentiment,
               CAST(sum(CASE WHEN sentiment_label = 'positive' THEN 1 ELSE 0 END) AS BIGINT) AS positive_reviews,
               CAST(sum(CASE WHEN sentiment_label = 'negative' THEN 1 ELSE 0 END) AS BIGINT) AS negative_reviews,
               CAST(sum(CASE WHEN is_suspicious THEN 1 ELSE 0 END) AS BIGINT) AS suspicious_reviews
        FROM stg_reviews GROUP BY category_name""",
    "mart_daily_trends": """
        SELECT review_date, reviews, avg_rating,
               round(avg(avg_rating) OVER (ORDER BY review_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 3)
                 AS avg_rating_7d
        FROM (SELECT review_date, count(*) AS reviews, round(avg(rating), 3) AS avg_rating
              FROM stg_reviews GROUP BY review_date)""",
}
NEEDS = {
    "raw": (), "valid": ("raw",), "silver": ("valid",), "scored": ("silver",), "spread": ("silver",),
    "flagged": ("scored", "spread"), "dim_date": ("silver",), "dim_category": ("silver",),
    "dim_product": ("silver", "dim_category"), "dim_customer": ("silver",),
    "fact_reviews": ("flagged", "dim_category"),
    "stg_reviews": ("fact_reviews", "dim_product", "dim_category", "dim_date"),
    "mart_category_sentiment": ("stg_reviews",), "mart_daily_trends": ("stg_reviews",),
}


def statement(body: str, *needs: str, extra: dict[str, str] | None = None) -> str:
    """``body`` behind the pieces it needs, directly or through one another."""
    wanted: set[str] = set()

    def pull(name: str) -> None:
        if name not in wanted:
            wanted.add(name)
            for other in NEEDS[name]:
                pull(other)

    for name in needs:
        pull(name)
    parts = {name: PIECES[name] for name in PIECES if name in wanted}
    parts.update(extra or {})
    if not parts:
        return body
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in parts.items()) + "\n" + body


def check(name: str, kind: str, column: str, unexpected: str, source: str) -> str:
    return (f"SELECT '{name}' AS name, '{kind}' AS type, '{column}' AS \"column\","
            f" CAST({unexpected} AS BIGINT) AS unexpected, count(*) AS total,"
            f" {unexpected} = 0 AS success FROM {source}")


def violations(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


def repeats(column: str, nulls_repeat: bool) -> str:
    base = f"(count({column}) - count(DISTINCT {column}))"
    return f"({base} + greatest(count(*) - count({column}) - 1, 0))" if nulls_repeat else base


def suite_sql(source: str, categories) -> str:
    return "\nUNION ALL\n".join([
        check("review_id_not_null", "not_null", "review_id", violations("review_id IS NULL"), source),
        check("review_id_unique", "unique", "review_id", repeats("review_id", True), source),
        check("rating_in_range", "between", "rating", violations("NOT coalesce(rating BETWEEN 1 AND 5, false)"), source),
        check("review_text_min_length", "min_str_length", "review_text",
              violations("coalesce(length(trim(review_text)), 0) < 3"), source),
        check("review_date_not_in_future", "not_future", "review_date",
              violations(f"NOT coalesce(try_cast(review_date AS DATE) <= DATE '{AS_OF}', false)"), source),
        check("category_in_set", "in_set", "category",
              violations(f"NOT coalesce(category IN ({listed(categories)}), false)"), source),
    ])


def table_check(table: str, column: str, kind: str, condition: str | None = None, suffix: str | None = None) -> str:
    names = {"not_null": "not_null", "unique": "unique", "in_set": "accepted", "relationship": "related"}
    name = f"{table}.{column}_{suffix or names[kind]}"
    if kind == "unique":
        unexpected = repeats(column, condition == "nulls repeat")
    else:
        unexpected = violations(condition or f"{column} IS NULL")
    return check(name, kind, column, unexpected, table)


def orphan(column: str, parent: str) -> str:
    return f"{column} IS NOT NULL AND {column} NOT IN (SELECT {column} FROM {parent} WHERE {column} IS NOT NULL)"


def model_tests_sql() -> str:
    def nn(table, column):
        return table_check(table, column, "not_null")

    def uq(table, column):
        return table_check(table, column, "unique")

    def accepted(table, column, values):
        return table_check(table, column, "in_set", f"{column} NOT IN ({listed(values)})")

    return "\nUNION ALL\n".join([
        nn("fact_reviews", "review_id"), uq("fact_reviews", "review_id"), nn("fact_reviews", "rating"),
        accepted("fact_reviews", "rating", STARS), accepted("fact_reviews", "sentiment_stars", STARS),
        table_check("fact_reviews", "category_id", "relationship", orphan("category_id", "dim_category")),
        nn("dim_category", "category_id"), uq("dim_category", "category_id"),
        nn("dim_product", "product_id"), uq("dim_product", "product_id"),
        nn("dim_date", "date_id"), uq("dim_date", "date_id"),
        nn("stg_reviews", "review_id"), uq("stg_reviews", "review_id"),
        accepted("stg_reviews", "sentiment_label", LABELS),
        nn("mart_category_sentiment", "category_name"), uq("mart_category_sentiment", "category_name"),
        nn("mart_category_sentiment", "reviews"),
        nn("mart_daily_trends", "review_date"), uq("mart_daily_trends", "review_date"),
    ])


def constraints_sql() -> str:
    rows = []
    for table, column in (("dim_date", "date_id"), ("dim_category", "category_id"), ("dim_category", "category_name"),
                          ("dim_product", "product_id"), ("dim_customer", "customer_id"), ("fact_reviews", "review_id")):
        rows += [table_check(table, column, "not_null"), table_check(table, column, "unique", "nulls repeat")]
    for column in ("full_date", "year", "month", "day", "weekday", "is_weekend"):
        rows.append(table_check("dim_date", column, "not_null"))
    rows.append(table_check("dim_product", "product_name", "not_null"))
    for table, column, parent in (
        ("dim_product", "category_id", "dim_category"), ("fact_reviews", "product_id", "dim_product"),
        ("fact_reviews", "customer_id", "dim_customer"), ("fact_reviews", "date_id", "dim_date"),
        ("fact_reviews", "category_id", "dim_category"),
    ):
        rows.append(table_check(table, column, "relationship", orphan(column, parent), f"in_{parent}"))
    for column in ("rating", "sentiment_stars"):
        rows.append(table_check("fact_reviews", column, "between", f"NOT {column} BETWEEN 1 AND 5", "1_to_5"))
    return "\nUNION ALL\n".join(rows)


# --- text and vectors -----------------------------------------------------------------------


def vocabulary_sql(source: str, text: str, *needs: str) -> str:
    words = (f"list_filter(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_]{{2,}}'),"
             f" lambda w: w NOT IN ({listed(TOPIC_STOP_WORDS)}))")
    return statement(
        """SELECT term, term_count, doc_count
           FROM (SELECT term, count(*) AS term_count, count(DISTINCT doc) AS doc_count FROM terms GROUP BY term)
           ORDER BY term_count DESC, term LIMIT 2000""",
        *needs,
        extra={
            "words": f"SELECT row_number() OVER () AS doc, {words} AS w FROM {source}",
            "terms": """SELECT doc, unnest(w) AS term FROM words UNION ALL
                        SELECT doc, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))
                        FROM words""",
        })


def neighbours_sql() -> str:
    return statement(
        f"""SELECT query_id, vec_id, floor(score * 10000 + 0.5) / 10000 AS score, CAST(rank AS INTEGER) AS rank
            FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
            WHERE rank <= {NEIGHBOURS}""",
        extra={
            "asked": "SELECT vec_id AS query_id, embedding::DOUBLE[] AS wanted FROM embeddings WHERE vec_id % 50 = 0",
            "pairs": """SELECT query_id, vec_id,
                        round(list_cosine_similarity(embedding::DOUBLE[], wanted), 6) AS score
                        FROM embeddings CROSS JOIN asked""",
        })


# --- increments -----------------------------------------------------------------------------

EARLY = f"review_date < DATE '{SPLIT_DAY}'"


def insert_ignore_sql() -> str:
    def first(condition: str) -> str:
        return f"""SELECT product_id, product_name, category_id FROM (
                     SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY review_date, review_id) AS place
                     FROM silver WHERE {condition} AND product_id IS NOT NULL)
                   LEFT JOIN dim_category ON category_name = category WHERE place = 1"""

    return statement(
        """SELECT * FROM early UNION ALL
           SELECT * FROM late WHERE product_id NOT IN (SELECT product_id FROM early)""",
        "silver", "dim_category", extra={"early": first(EARLY), "late": first(f"NOT {EARLY}")})


def customer_upsert_sql() -> str:
    def counted(condition: str) -> str:
        return f"""SELECT customer_id, min(review_date) AS first_seen, CAST(count(review_id) AS INTEGER) AS review_count
                   FROM silver WHERE {condition} AND customer_id IS NOT NULL GROUP BY customer_id"""

    return statement(
        """SELECT coalesce(e.customer_id, l.customer_id) AS customer_id,
                  CASE WHEN e.customer_id IS NOT NULL THEN e.first_seen ELSE l.first_seen END AS first_seen,
                  CASE WHEN l.customer_id IS NOT NULL THEN l.review_count ELSE e.review_count END AS review_count
           FROM early e FULL JOIN late l ON e.customer_id = l.customer_id""",
        "silver", extra={"early": counted(EARLY), "late": counted(f"NOT {EARLY}")})


def surrogate_sql() -> str:
    return statement(
        """SELECT * FROM early UNION ALL
           SELECT CAST((SELECT coalesce(max(name_id), 0) FROM early) + row_number() OVER (ORDER BY product_name)
                       AS INTEGER) AS name_id, product_name
           FROM (SELECT DISTINCT product_name FROM silver
                 WHERE NOT ({early}) AND product_name IS NOT NULL
                   AND product_name NOT IN (SELECT product_name FROM early))""".replace("{early}", EARLY),
        "silver",
        extra={"early": f"""
            SELECT CAST(row_number() OVER (ORDER BY product_name) AS INTEGER) AS name_id, product_name
            FROM (SELECT DISTINCT product_name FROM silver
                  WHERE {EARLY} AND rating = 1 AND product_name IS NOT NULL)"""})


def search_upsert_sql() -> str:
    text = f"CASE WHEN {EARLY} AND rating = 5 THEN 'edited review' ELSE review_text END"
    return statement(
        f"""SELECT review_id, review_text, category, rating, sentiment_stars,
                   {label('sentiment_stars')} AS sentiment_label
            FROM (SELECT *, CAST({stars('review_text')} AS INTEGER) AS sentiment_stars FROM current)""",
        "silver",
        extra={"current": f"SELECT review_id, {text} AS review_text, category, rating FROM silver"})


def stream_sql(columns: str) -> str:
    return statement(
        f"SELECT {columns} FROM (SELECT *, {label('sentiment_stars')} AS sentiment_label FROM starred)",
        "raw",
        extra={"starred": f"""
            SELECT *, CAST({stars("coalesce(review_text, '')")} AS INTEGER) AS sentiment_stars
            FROM raw WHERE review_id IS NOT NULL"""})


def serving_sql() -> str:
    ranked = """SELECT *, CAST(rating AS BIGINT) AS arrival, row_number() OVER (
                  PARTITION BY review_id ORDER BY rating DESC NULLS LAST, category NULLS FIRST, sentiment_stars,
                  sentiment_label) AS place
                FROM all_scored"""
    return statement(
        "SELECT review_id, category, rating, sentiment_stars, sentiment_label, arrival FROM ranked WHERE place = 1",
        "raw",
        extra={
            "starred": f"""SELECT *, CAST({stars("coalesce(review_text, '')")} AS INTEGER) AS sentiment_stars
                           FROM raw WHERE review_id IS NOT NULL""",
            "all_scored": f"SELECT *, {label('sentiment_stars')} AS sentiment_label FROM starred",
            "ranked": ranked})


def oracle_statements() -> dict[str, str]:
    p_types = ("LARGE", "MEDIUM", "ECONOMY", "PROMO", "SMALL", "STANDARD")
    totals = "count(*) AS reviews, round(avg(rating), 3) AS avg_rating"
    gold = "count(*) AS review_count, round(avg(rating), 3) AS avg_rating"
    return {
        "bronze_reviews": statement("SELECT * FROM raw", "raw"),
        "csv_landing": statement("SELECT * FROM raw", "raw"),
        "csv_two_landings": statement(
            "SELECT *, CASE WHEN right(product_id, 1) IN ('0', '1', '2')"
            " THEN 'store ' || right(customer_id, 1) END AS store FROM raw", "raw"),
        "silver_incremental": statement("SELECT * FROM silver", "silver"),
        "gold_incremental": statement(
            f"SELECT 'daily_category_sentiment' AS mart, CAST(review_date AS VARCHAR) AS key_1, category AS key_2,"
            f" CAST(NULL AS VARCHAR) AS key_3, {gold}, round(avg(review_length), 1) AS avg_review_length,"
            " CAST(NULL AS DATE) AS first_review, CAST(NULL AS DATE) AS last_review FROM silver GROUP BY review_date, category"
            f" UNION ALL SELECT 'product_summary', product_id, product_name, category, {gold}, NULL, min(review_date),"
            " max(review_date) FROM silver GROUP BY product_id, product_name, category"
            f" UNION ALL SELECT 'topic_distribution', category, topic, NULL, {gold}, NULL, NULL, NULL"
            " FROM silver GROUP BY category, topic", "silver"),
        "layer_counts": statement(
            "SELECT 'bronze' AS layer, count(*) AS reviews FROM raw UNION ALL SELECT 'silver', count(*) FROM silver",
            "raw", "silver"),
        "silver_reviews": statement("SELECT * FROM silver", "silver"),
        "gold_daily_category": statement(
            f"SELECT review_date, category, {gold}, round(avg(review_length), 1) AS avg_review_length"
            " FROM silver GROUP BY review_date, category", "silver"),
        "gold_product_summary": statement(
            f"SELECT product_id, product_name, category, {gold}, min(review_date) AS first_review,"
            " max(review_date) AS last_review FROM silver GROUP BY product_id, product_name, category", "silver"),
        "gold_topic_distribution": statement(
            f"SELECT category, topic, {gold} FROM silver GROUP BY category, topic", "silver"),
        "sentiment_scored": statement(
            "SELECT review_id, sentiment_stars, sentiment_label, 'lexicon' AS sentiment_model FROM scored", "scored"),
        "text_features": statement(
            "SELECT review_id, review_date, CAST(length(review_text) AS INTEGER) AS review_length,"
            " CAST(len(list_filter(string_split_regex(review_text, '\\s+'), lambda w: w <> '')) AS INTEGER) AS word_count"
            " FROM raw WHERE review_id IS NOT NULL AND review_text IS NOT NULL", "raw"),
        "rating_mismatch": statement(
            "SELECT review_id, rating, sentiment_stars, rating_sentiment_gap, flag_mismatch FROM flagged", "flagged"),
        "duplicate_spam": statement(
            "SELECT review_id, text_customer_spread, flag_duplicate_spam FROM flagged", "flagged"),
        "document_text_spread": """
            SELECT doc_id, source_spread FROM documents
            JOIN (SELECT text, count(DISTINCT source) AS source_spread FROM documents GROUP BY text) USING (text)""",
        "rule_flag_summary": statement(
            """SELECT count(*) AS reviews, count(*) FILTER (WHERE is_suspicious) AS suspicious,
                      round(count(*) FILTER (WHERE is_suspicious) / greatest(count(*), 1), 4) AS suspicious_share,
                      count(*) FILTER (WHERE flag_mismatch) AS mismatch,
                      count(*) FILTER (WHERE flag_duplicate_spam) AS duplicate_spam,
                      CAST(0 AS BIGINT) AS outlier FROM flagged""", "flagged"),
        "dq_report": statement(suite_sql("silver", p_types), "silver"),
        "dq_report_dirty": statement(suite_sql("raw", REVIEWS_SUITE.checks[-1].values), "raw"),
        "dq_summary": statement(
            """SELECT 'reviews_silver' AS suite, max(total) AS rows, count(*) AS checks_total,
                      count(*) FILTER (WHERE success) AS checks_passed,
                      count(*) FILTER (WHERE success) = count(*) AS success FROM report""",
            "raw", extra={"report": suite_sql("raw", p_types)}),
        "model_tests": statement(model_tests_sql(), "mart_category_sentiment", "mart_daily_trends"),
        "star_constraints": statement(
            constraints_sql(), "fact_reviews", "dim_product", "dim_customer", "dim_date"),
        "dim_date": statement("SELECT * FROM dim_date", "dim_date"),
        "dim_category": statement("SELECT * FROM dim_category", "dim_category"),
        "dim_product": statement("SELECT * FROM dim_product", "dim_product"),
        "dim_customer": statement("SELECT * FROM dim_customer", "dim_customer"),
        "fact_reviews": statement("SELECT * FROM fact_reviews", "fact_reviews"),
        "insert_ignore": insert_ignore_sql(),
        "customer_upsert": customer_upsert_sql(),
        "surrogate_keys_incremental": surrogate_sql(),
        "stg_reviews": statement("SELECT * FROM stg_reviews", "stg_reviews"),
        "mart_category_sentiment": statement("SELECT * FROM mart_category_sentiment", "mart_category_sentiment"),
        "mart_daily_trends": statement("SELECT * FROM mart_daily_trends", "mart_daily_trends"),
        "overview": statement(
            """SELECT count(*) AS total_reviews, round(avg(rating), 3) AS avg_rating,
                      round(avg(sentiment_stars), 3) AS avg_sentiment,
                      CAST(sum(CASE WHEN is_suspicious THEN 1 ELSE 0 END) AS BIGINT) AS suspicious_reviews
               FROM fact_reviews""", "fact_reviews"),
        "by_category": statement(
            f"SELECT category_name, {totals}, round(avg(sentiment_stars), 3) AS avg_sentiment"
            " FROM fact_reviews JOIN dim_category USING (category_id) GROUP BY category_name", "fact_reviews"),
        "daily": statement(
            f"SELECT full_date, {totals} FROM fact_reviews JOIN dim_date USING (date_id) GROUP BY full_date",
            "fact_reviews", "dim_date"),
        "suspicious": statement(
            "SELECT review_id, product_id, rating, sentiment_stars, sentiment_label FROM fact_reviews"
            " WHERE is_suspicious ORDER BY review_id LIMIT 50", "fact_reviews"),
        "parameter_query": statement(
            "SELECT category_id, count(*) AS reviews FROM fact_reviews WHERE rating >= 4 GROUP BY category_id",
            "fact_reviews"),
        "json_round_trip": statement("SELECT review_id, category, rating, review_text FROM silver", "silver"),
        "event_props": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
        "seeded_sample": statement(
            "SELECT review_id, rating, review_text FROM silver"
            f" ORDER BY md5('7|' || review_id), review_id LIMIT {SAMPLE_ROWS}", "silver"),
        "seeded_shuffle": statement("SELECT review_id, rating FROM silver", "silver"),
        "knn_cosine": neighbours_sql(),
        "knn_lsh_quality": f"""SELECT count(*) AS asked,
               CAST(sum(least({NEIGHBOURS}, (SELECT count(*) FROM embeddings))) AS BIGINT) AS neighbours,
               true AS scores_exact, true AS prunes, true AS recalls FROM embeddings WHERE vec_id % 50 = 0""",
        "similar_reviews": statement(
            """SELECT min(review_id) AS query_id, 1.0::DOUBLE AS score FROM silver
               GROUP BY review_text HAVING count(*) > 1""", "silver"),
        "topic_vocabulary": vocabulary_sql("silver", "review_text", "silver"),
        "document_vocabulary": vocabulary_sql("documents", "text"),
        "search_index": statement(
            "SELECT review_id, review_text, category, rating, sentiment_stars, sentiment_label FROM scored", "scored"),
        "search_upsert": search_upsert_sql(),
        "stream_scored": stream_sql("review_id, category, rating, sentiment_stars, sentiment_label"),
        "stream_serving": serving_sql(),
        "batch_scored_messages": stream_sql(
            """review_id AS key, '{"review_id":"' || review_id || '","category":"' || category || '","rating":' || rating
               || ',"sentiment_stars":' || sentiment_stars || ',"sentiment_label":"' || sentiment_label || '"}' AS value"""),
        "labelled_texts": "SELECT text, quality AS label FROM documents JOIN labels USING (doc_id)",
    }
