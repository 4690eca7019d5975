"""DuckDB SQL for the training-data queries that SQL can express."""

_PLAIN = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

DECONTAMINATION = f"""
WITH doc AS (SELECT doc_id, {_PLAIN} AS w FROM documents),
item AS (SELECT item_id, {_PLAIN} AS w FROM benchmark),
phrase AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, least(10, len(w)) AS k,
    array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS gram
  FROM (SELECT *, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM item WHERE len(w) > 0)),
place AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS gram
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM doc, (SELECT DISTINCT k FROM phrase))),
met AS (SELECT doc_id, i, k, item FROM place JOIN phrase USING (k, gram)),
hit AS (
  SELECT doc_id, count(*) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS spot FROM met) GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM met WHERE item IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

SUBSTRING_DEDUP = r"""
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
place AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS gram
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM doc)),
first_doc AS (SELECT gram, min(doc_id) AS first_id FROM place GROUP BY gram),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS spot
  FROM place JOIN first_doc USING (gram) WHERE doc_id > first_id),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS spot FROM doc),
kept AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY spot) AS words
  FROM word ANTI JOIN gone USING (doc_id, spot) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(words, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)
"""


def _centroid_clusters(dimensions: int = 64, clusters: int = 16, rounds: int = 3) -> str:
    """The rounds written out one after another."""
    distance = f"list_sum([(v[i] - c[i]) * (v[i] - c[i]) for i in range(1, {dimensions} + 1)])"

    def nearest(centres: str) -> str:
        return f"""(
  SELECT any_value(vec_id) AS vec_id, any_value(v) AS v, list_sort(list({{'d': {distance}, 'k': k}}))[1] AS hit
  FROM kept, {centres} GROUP BY row)"""

    steps = [f"""
WITH kept AS (
  SELECT vec_id, row_number() OVER () AS row,
    [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
  FROM embeddings WHERE len(embedding) = {dimensions}
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS k, v AS c
  FROM kept ORDER BY sha256('1:' || vec_id) LIMIT {clusters})"""]
    for step in range(1, rounds + 1):
        before = f"c{step - 1}"
        steps.append(f"""
a{step} AS (SELECT hit.k AS k, v FROM {nearest(before)}),
s{step} AS (
  SELECT k, i, CAST(sum(v[i]) AS BIGINT) AS s, count(*) AS n
  FROM a{step}, (SELECT unnest(range(1, {dimensions} + 1)) AS i) GROUP BY k, i),
m{step} AS (SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM s{step} GROUP BY k),
c{step} AS (SELECT b.k, coalesce(m{step}.c, b.c) AS c FROM {before} b LEFT JOIN m{step} ON m{step}.k = b.k)""")
    last = f"c{rounds}"
    return ",".join(steps) + f""",
found AS (SELECT vec_id, hit.k AS k, hit.d AS d FROM {nearest(last)})
SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
  CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM found JOIN {last} USING (k)
"""


CENTROID_CLUSTERS = _centroid_clusters()

COLLOCATIONS = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS p, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS part
  FROM documents),
listed AS (SELECT lang, regexp_extract_all(part, '[^\x20\x09]+') AS w FROM piece),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM listed GROUP BY lang),
run AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM listed, (SELECT unnest([1, 2, 3]) AS k))),
counted AS (SELECT lang, k, phrase, count(*) AS f FROM run GROUP BY ALL),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE k > 1 AND f >= 10),
cut AS (
  SELECT lang, k, phrase, a, c, array_to_string(w[1:c], ' ') AS head, array_to_string(w[c + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, k)) AS c FROM cand)),
scored AS (
  SELECT cut.*, h.f AS l, t.f AS r,
    CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(h.f AS HUGEINT) * t.f) AS BIGINT) AS score
  FROM cut JOIN counted h ON h.lang = cut.lang AND h.phrase = head JOIN counted t ON t.lang = cut.lang AND t.phrase = tail),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inner_pair AS (
  SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, w, a, unnest([1, 2]) AS i FROM cand WHERE k = 3) GROUP BY ALL),
ranked AS (
  SELECT lowest.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM lowest LEFT JOIN inner_pair USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""
