"""For each registered query the SQL that DuckDB runs on the same tables."""

from ..schema import AGGREGATE_COLUMNS, AUTHOR_AND_COMMENT_COLUMNS
from .inputs import FACT_EXPRESSIONS, REVIEW_EXPRESSIONS, TEST_NEGATIVE, TEST_POSITIVE


def _words(words):
    return ", ".join(f"'{w}'" for w in words)


REVIEWS = f"""reviews AS (
  SELECT {", ".join(REVIEW_EXPRESSIONS)}
  FROM documents LEFT JOIN labels USING (doc_id))"""

FACT = f"""fact AS (
  SELECT {", ".join(FACT_EXPRESSIONS)}
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

SCORED = f"""{REVIEWS},
tokens AS (
  SELECT *, string_split_regex(lower(replace(replace(coalesce(review, ''),
    '"', '\\"'), chr(10), ' ')), '[^a-z]+') AS tk FROM reviews),
counted AS (
  SELECT * EXCLUDE (tk),
    len(list_filter(tk, lambda z: z IN ({_words(TEST_POSITIVE)}))) AS p,
    len(list_filter(tk, lambda z: z IN ({_words(TEST_NEGATIVE)}))) AS n FROM tokens),
shares AS (
  SELECT *, coalesce(review, '') = '' AS missing,
    CAST(p + 1 AS DOUBLE) / CAST(p + n + 2 AS DOUBLE) AS pp FROM counted),
scored AS (
  SELECT * EXCLUDE (p, n, missing, pp),
    CASE WHEN missing THEN 'NEUTRAL' WHEN pp >= 0.5 THEN 'POSITIVE' ELSE 'NEGATIVE' END AS label,
    CAST(CASE WHEN missing THEN 0 ELSE greatest(pp, 1 - pp) END AS FLOAT) AS score,
    CAST(CASE WHEN missing THEN 0 ELSE pp END AS FLOAT) AS positive_score,
    CAST(CASE WHEN missing THEN 0 ELSE 1 - pp END AS FLOAT) AS negative_score
  FROM shares)"""

SENTIMENT = "review_id, label, score, positive_score, negative_score"

FLAT = f"""{SCORED},
flat AS (
  SELECT review_id, game, language, {", ".join(f"coalesce({c}, 0) AS {c}" for c in AUTHOR_AND_COMMENT_COLUMNS)},
    steam_purchase, voted_up, positive_score, negative_score FROM scored)"""


def _aggregates(source, digits=8, scored="true", extra=""):
    def average(c):
        mean = f"avg(CASE WHEN {scored} THEN CAST({c} AS DOUBLE) END)"
        return f"round(coalesce({mean}, 0), {digits})"

    return f"""SELECT game, {average("positive_score")} AS avg_positive_score,
    {average("negative_score")} AS avg_negative_score,
    count(*) AS total_reviews,
    CAST(sum(CASE WHEN voted_up THEN 1 ELSE 0 END) AS BIGINT) AS total_positive_reviews,
    CAST(sum(CASE WHEN NOT voted_up THEN 1 ELSE 0 END) AS BIGINT) AS total_negative_reviews
    {extra} FROM {source} GROUP BY game"""


_SUMS = """, sum(CAST(positive_score AS DOUBLE)) AS sp, sum(CAST(negative_score AS DOUBLE)) AS sn"""

JSON_LINES = """lines AS (
  SELECT event_id, CASE WHEN event_id % 19 = 0 THEN '[' WHEN event_id % 23 = 0 THEN ']'
    WHEN event_id % 29 = 0 THEN '   '
    WHEN event_id % 31 = 0 THEN substring(props, 1, 5) || ','
    WHEN event_id % 37 = 0 THEN '5,'
    ELSE '  ' || props || ', ' || chr(9) END AS value FROM events),
cleaned AS (
  SELECT event_id, regexp_replace(regexp_replace(value, '^\\s+|\\s+$', '', 'g'), ',$', '') AS line
  FROM lines),
judged AS (
  SELECT *, json_valid(line) AND line[1] = '{' AS is_object FROM cleaned
  WHERE line NOT IN ('', '[', ']'))"""

LOADED_LINES = """made AS (
  SELECT *, json_object('event_id', event_id, 'event_type', event_type, 'props', props::JSON) AS j,
    CASE WHEN event_id % 7 = 0 THEN 'odd' ELSE event_id::VARCHAR END AS mixed FROM events),
judged AS (
  SELECT *, event_id % 19 = 0 OR event_id % 23 = 0 OR event_id % 29 = 0 AS bad FROM made)"""

# Four fifths of all digests sort before this one.
IN_TRAIN = f"md5(CAST(review_id AS VARCHAR)) < '{'c' * 32}'"

ENCODED = f"""{FACT},
games AS ({_aggregates("fact", 15)}),
numbered AS (
  SELECT *, CAST(row_number() OVER (ORDER BY game NULLS LAST) - 1 AS BIGINT) AS game_index,
    count(*) OVER () AS n FROM games)"""


# Boosting from -1 or 1 on, in 50 rounds of rate 0.1, where each round's tree tells the
# classes apart: the margin follows from the gradient of the logistic loss alone.
BOOSTED = """boosted AS (
  SELECT 1 AS round, CAST(1 AS DOUBLE) AS margin
  UNION ALL SELECT round + 1, margin + CAST(0.1 AS DOUBLE) * 4 / (1 + exp(2 * margin))
  FROM boosted WHERE round < 50)"""

PREDICTED = f"""WITH RECURSIVE {FACT}, {BOOSTED},
sizes AS (SELECT game, count(*) AS n FROM fact GROUP BY game),
popular AS (
  SELECT game, CAST(n > (SELECT avg(n) FROM sizes) AS INT) AS label FROM sizes),
predicted AS (
  SELECT review_id, label, CAST(label AS DOUBLE) AS prediction, round((2 * label - 1)
    * (SELECT margin FROM boosted WHERE round = 50), 6) AS margin
  FROM fact JOIN popular ON fact.game IS NOT DISTINCT FROM popular.game WHERE NOT {IN_TRAIN})"""


def _scaled(c):
    low, high = f"min({c}) OVER ()", f"max({c}) OVER ()"
    return f"""round(CASE WHEN {high} = {low} THEN 0.5
      ELSE CAST({c} - {low} AS DOUBLE) / CAST({high} - {low} AS DOUBLE) END, 8)"""


# Scores and labels of one reply each, by how the reply is damaged.
_REPLY_LABEL = """CASE WHEN event_id % 11 < 4 THEN 'ERROR' WHEN event_id % 11 IN (4, 7) THEN 'NEGATIVE'
      WHEN event_id % 11 = 5 THEN 'NEUTRAL' WHEN event_id % 11 = 6 THEN 'MIXED' ELSE 'POSITIVE' END"""
_REPLY_SCORE = """CASE WHEN event_id % 11 < 4 THEN NULL WHEN event_id % 11 = 4 THEN 0.5
      ELSE (event_id % 101) / CAST(100 AS DOUBLE) END"""


def _polarity(source):
    def side(name):
        return f"""CAST(coalesce(CASE WHEN label = '{name}' THEN score ELSE 1 - score END, 0)
      AS FLOAT)"""

    return f"""SELECT review_id, label, CAST(coalesce(score, 0) AS FLOAT) AS score,
    {side("POSITIVE")} AS positive_score, {side("NEGATIVE")} AS negative_score FROM ({source})"""


ORACLES = {
    "read_reviews": f"WITH {REVIEWS} SELECT * FROM reviews",
    "read_all_runs": f"""WITH {REVIEWS} SELECT review_id, game, language,
      CASE WHEN review_id % 2 = 1 THEN '20240102_000000' ELSE '20240103_000000' END AS run_ts
      FROM reviews""",
    "read_latest_run": f"""WITH {REVIEWS} SELECT review_id, game, language FROM reviews
      WHERE review_id % 2 = 0""",
    "json_lines_lenient": f"""WITH {JSON_LINES} SELECT event_id,
      CAST(json_extract_string(line, '$.k') AS BIGINT) AS k FROM judged WHERE is_object""",
    "load_lines": f"""WITH {LOADED_LINES},
    good AS (
      SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
        CASE WHEN event_id % 3 = 0 THEN value END AS value,
        CASE WHEN event_id % 5 = 0 THEN 'extra ' || event_id END AS extra, mixed,
        CAST(NULL AS VARCHAR) AS line FROM judged WHERE NOT bad
      UNION ALL SELECT event_id, NULL, NULL, NULL, NULL, mixed, NULL FROM judged WHERE NOT bad),
    texts AS (
      SELECT *, '{{"event_id":' || event_id || ',"event_type":"' || event_type || '","props":{{"k":'
        || json_extract_string(props, '$.k') || '}}'
        || CASE WHEN event_id % 3 = 0 THEN ',"value":' || value ELSE '' END
        || CASE WHEN event_id % 5 = 0 THEN ',"extra field":"extra ' || event_id || '"' ELSE '' END
        || ',"mixed":' || CASE WHEN event_id % 7 = 0 THEN '"odd"' ELSE event_id::VARCHAR END || '}}' AS text
      FROM judged WHERE bad),
    lines AS (
      SELECT CASE WHEN event_id % 19 = 0 THEN text || ' x'
        WHEN event_id % 23 = 0 THEN left(text, length(text) - 1)
        ELSE '[' || event_id || ']' END AS line FROM texts),
    loaded AS (
      SELECT * FROM good UNION ALL
      SELECT NULL, NULL, NULL, NULL, NULL, NULL, line FROM lines CROSS JOIN range(2))
    SELECT *, (SELECT 2 * count(*) FROM judged WHERE NOT bad) AS inserted,
      (SELECT 2 * count(*) FROM judged WHERE bad) AS rejected, 'mixed' AS conflicts FROM loaded""",
    "sample_lines": f"""WITH {JSON_LINES}, copies AS (
      SELECT line, row_number() OVER (PARTITION BY line) AS copy FROM cleaned)
      SELECT line FROM copies ORDER BY md5(concat_ws('_', '42', md5(line), copy)), line LIMIT 300""",
    "json_document": "SELECT event_id, event_type, value FROM events",
    "json_array": """SELECT event_id, '} ] "' || event_type || '\\ {' AS text, value FROM events
      UNION ALL SELECT NULL, NULL, NULL""",
    "extract_to_lake": f"WITH {REVIEWS} SELECT review_id, game, review, voted_up FROM reviews",
    "write_roundtrip": f"WITH {SCORED} SELECT {SENTIMENT} FROM scored",
    "write_train_val": f"""WITH {REVIEWS} SELECT review_id, game,
      coalesce(CAST(steam_purchase AS INT), 0) AS label,
      CASE WHEN {IN_TRAIN} THEN 'train' ELSE 'validation' END AS part FROM reviews""",
    "document_dump": """SELECT event_id, event_type, strftime(ts, '%Y%m%d_%H%M%S') AS stamp, value, props
      FROM events JOIN range(2) copies(copy) ON copy = 0 OR event_id % 2 = 0""",
    "append_load": """SELECT event_id, event_type, value FROM events WHERE event_id % 2 = 0
      UNION ALL SELECT event_id, event_type, value FROM events""",
    "write_sample": f"""WITH {REVIEWS} SELECT review_id, game FROM reviews
      ORDER BY md5(concat('42_', CAST(review_id AS VARCHAR))), review_id LIMIT 200""",
    "json_quarantine": f"WITH {JSON_LINES} SELECT event_id, line FROM judged WHERE NOT is_object",
    "preview": """SELECT event_id, user_id, event_type, value, props FROM events
      ORDER BY event_id LIMIT 5""",
    "record_count": f"WITH {JSON_LINES} SELECT count(*) AS records FROM judged WHERE is_object",
    "sentiment_label_counts": f"""WITH {SCORED} SELECT label, count(*) AS reviews FROM scored
      GROUP BY label""",
    "select_columns": f"""WITH {SCORED} SELECT review_id, game, language, {", ".join(AUTHOR_AND_COMMENT_COLUMNS)},
      steam_purchase, voted_up, label AS sentiment_label FROM scored""",
    "flatten_sentiment": f"""WITH {SCORED} SELECT review_id, game, language,
      {", ".join(AUTHOR_AND_COMMENT_COLUMNS)}, steam_purchase, voted_up, positive_score, negative_score
      FROM scored""",
    "score_reviews": f"WITH {SCORED} SELECT {SENTIMENT} FROM scored",
    "repartition_score": f"WITH {SCORED} SELECT {SENTIMENT} FROM scored",
    "score_by_dictionary": f"WITH {SCORED} SELECT {SENTIMENT} FROM scored",
    "score_reviews_batch": f"WITH {SCORED} SELECT {SENTIMENT} FROM scored",
    "conditional_flags": f"""WITH {REVIEWS} SELECT review_id,
      CASE WHEN voted_up = true THEN 1 ELSE 0 END AS is_up,
      CASE WHEN voted_up = false THEN 1 ELSE 0 END AS is_down FROM reviews""",
    "purchase_label": f"""WITH {REVIEWS} SELECT review_id,
      coalesce(TRY_CAST(steam_purchase AS INT), 0) AS label,
      steam_purchase IS NULL AS unknown FROM reviews""",
    "feature_columns": f"WITH {FACT} SELECT * FROM fact",
    "vote_split": f"""WITH {REVIEWS} SELECT review_id, game, voted_up FROM reviews
      WHERE voted_up IS NOT NULL""",
    "fill_numeric": f"WITH {FLAT} SELECT * FROM flat",
    "missing_text": f"""WITH {REVIEWS} SELECT review_id, coalesce(review, '') = '' AS is_missing
      FROM reviews""",
    "first_valid_rows": f"""WITH {JSON_LINES} SELECT event_id,
      CAST(json_extract_string(line, '$.k') AS BIGINT) AS k FROM judged WHERE is_object
      ORDER BY event_id LIMIT 1000""",
    "game_aggregates": f"WITH {FLAT} {_aggregates('flat')}",
    "game_aggregates_fact": f"WITH {FACT} {_aggregates('fact')}",
    "game_aggregates_exclude": f"""WITH {SCORED}
      {_aggregates("scored", scored="label NOT IN ('ERROR') AND NOT (label = 'NEUTRAL' AND score = 0)")}""",
    "avg_sentiment_by_game": f"""WITH {FACT}, games AS ({_aggregates("fact")})
      SELECT game, avg_positive_score, avg_negative_score FROM games""",
    "review_count_by_game": f"WITH {FACT} SELECT game, count(*) AS total_reviews FROM fact GROUP BY game",
    "votes_by_game": f"""WITH {FACT}, games AS ({_aggregates("fact")})
      SELECT game, total_positive_reviews, total_negative_reviews FROM games""",
    "review_features": f"""WITH {FLAT}, games AS ({_aggregates("flat")})
      SELECT review_id, flat.game, voted_up, positive_score, negative_score,
        avg_positive_score, avg_negative_score, total_reviews, total_positive_reviews,
        total_negative_reviews
      FROM flat LEFT JOIN games ON flat.game IS NOT DISTINCT FROM games.game""",
    "review_features_loo": f"""WITH {FLAT}, games AS ({_aggregates("flat", extra=_SUMS)})
      SELECT review_id, flat.game, voted_up, positive_score, negative_score,
        round(CASE WHEN total_reviews > 1 THEN (sp - positive_score) / (total_reviews - 1)
          ELSE 0 END, 6) AS avg_positive_score,
        round(CASE WHEN total_reviews > 1 THEN (sn - negative_score) / (total_reviews - 1)
          ELSE 0 END, 6) AS avg_negative_score,
        total_reviews - 1 AS total_reviews,
        total_positive_reviews - CASE WHEN voted_up THEN 1 ELSE 0 END AS total_positive_reviews,
        total_negative_reviews - CASE WHEN NOT voted_up THEN 1 ELSE 0 END AS total_negative_reviews
      FROM flat LEFT JOIN games ON flat.game IS NOT DISTINCT FROM games.game""",
    "sample_200": f"""WITH {REVIEWS} SELECT review_id, game, language, review FROM reviews
      ORDER BY md5(concat('42_', CAST(review_id AS VARCHAR))), review_id LIMIT 200""",
    "split_train": f"""WITH {REVIEWS} SELECT review_id, game, voted_up FROM reviews
      WHERE {IN_TRAIN}""",
    "split_val": f"""WITH {REVIEWS} SELECT review_id, game, voted_up FROM reviews
      WHERE NOT {IN_TRAIN}""",
    "clean_text": """SELECT doc_id, replace(replace(text, '"', '\\"'), chr(10), ' ') AS cleaned
      FROM documents""",
    "truncate_text": """SELECT doc_id,
      substring(replace(replace(text, '"', '\\"'), chr(10), ' '), 1, 500) AS shown FROM documents""",
    "clean_json_line": f"WITH {JSON_LINES} SELECT event_id, line FROM cleaned",
    "json_parse": """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
      CAST(json_object('event_type', event_type, 'k',
        CAST(json_extract_string(props, '$.k') AS BIGINT)) AS VARCHAR) AS document FROM events""",
    "score_polarity": _polarity(
        """SELECT event_id AS review_id, (event_id % 101) / CAST(100 AS DOUBLE) AS score,
        CASE event_id % 3 WHEN 0 THEN 'POSITIVE' WHEN 1 THEN 'NEGATIVE' ELSE 'MIXED' END AS label
        FROM events"""
    ),
    "parse_score_response": _polarity(
        f"SELECT event_id AS review_id, {_REPLY_LABEL} AS label, {_REPLY_SCORE} AS score FROM events"
    ),
    "run_stamp": "SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS stamp FROM events",
    "game_index": f"""WITH {REVIEWS} SELECT game,
      CAST(row_number() OVER (ORDER BY game) - 1 AS BIGINT) AS game_index
      FROM (SELECT DISTINCT game FROM reviews)""",
    "game_one_hot": f"""WITH {ENCODED} SELECT game, game_index AS hot_slot,
      CAST(n AS BIGINT) AS slots FROM numbered""",
    "scaled_features": f"""WITH {ENCODED} SELECT game,
      {", ".join(f"{_scaled(c)} AS scaled_{c}" for c in AGGREGATE_COLUMNS)} FROM numbered""",
    "final_features": f"""WITH {ENCODED} SELECT game,
      {", ".join(f"{_scaled(c)} AS feature_{i}" for i, c in enumerate(AGGREGATE_COLUMNS))},
      game_index + 5 AS hot_slot, CAST(n + 5 AS BIGINT) AS slots FROM numbered""",
    "training_frame": f"""WITH {ENCODED}, vectors AS (
      SELECT game, {", ".join(f"{_scaled(c)} AS feature_{i}" for i, c in enumerate(AGGREGATE_COLUMNS))},
        game_index + 5 AS hot_slot, CAST(n + 5 AS BIGINT) AS slots FROM numbered)
      SELECT review_id, coalesce(CAST(steam_purchase AS INT), 0) AS label,
        {", ".join(f"feature_{i}" for i in range(5))}, hot_slot, slots
      FROM fact JOIN vectors ON fact.game IS NOT DISTINCT FROM vectors.game""",
    "train_gbt": f"""{PREDICTED} SELECT label, prediction, count(*) AS reviews FROM predicted
      GROUP BY label, prediction""",
    "predictions": f"{PREDICTED} SELECT review_id, label, prediction, margin FROM predicted",
    "batch_predict": f"{PREDICTED} SELECT review_id, label, prediction, margin FROM predicted",
    "batch_predict_others": f"{PREDICTED} SELECT review_id, label, prediction, margin FROM predicted",
    "auc_exact": f"""WITH {FACT}, f AS (
      SELECT positive_score AS x, coalesce(CAST(steam_purchase AS INT), 0) AS y FROM fact),
      r AS (SELECT y, rank() OVER (ORDER BY x)
        + (count(*) OVER (PARTITION BY x) - 1) / CAST(2 AS DOUBLE) AS rk FROM f)
      SELECT round((sum(CASE WHEN y = 1 THEN rk ELSE 0 END)
        - sum(y) * (sum(y) + 1) / CAST(2 AS DOUBLE))
        / (CAST(sum(y) AS DOUBLE) * (count(*) - sum(y))), 8) AS auc FROM r""",
    "score_again": f"""WITH {SCORED}, counts AS (SELECT review_id, p FROM counted)
      SELECT review_id,
        CASE WHEN p % 2 = 1 THEN 'POSITIVE' ELSE label END AS label,
        CASE WHEN p % 2 = 1 THEN CAST(1 AS FLOAT) ELSE score END AS score,
        CASE WHEN p % 2 = 1 THEN CAST(1 AS FLOAT) ELSE positive_score END AS positive_score,
        CASE WHEN p % 2 = 1 THEN CAST(0 AS FLOAT) ELSE negative_score END AS negative_score
      FROM scored JOIN counts USING (review_id)""",
    "end_to_end": f"""WITH RECURSIVE {REVIEWS}, {BOOSTED},
    sizes AS (SELECT game, count(*) AS n FROM reviews GROUP BY game),
    halves AS (
      SELECT CAST(n > (SELECT avg(n) FROM sizes) AS INT) AS label,
        CASE WHEN {IN_TRAIN} THEN 'train' ELSE 'validation' END AS part
      FROM reviews JOIN sizes ON reviews.game IS NOT DISTINCT FROM sizes.game),
    counted AS (
      SELECT part, label, count(*) AS reviews, CAST(NULL AS DOUBLE) AS margin FROM halves
      GROUP BY part, label
      UNION ALL SELECT 'predictions', label, count(*), round((2 * label - 1)
        * (SELECT margin FROM boosted WHERE round = 50), 6)
      FROM halves WHERE part = 'validation' GROUP BY label)
    SELECT *, CASE WHEN (SELECT count(DISTINCT label) FROM halves WHERE part = 'validation') = 2
      THEN CAST(1 AS DOUBLE) END AS auc FROM counted""",
}
