"""SQL for the registered queries, to run on the same tables."""

from hitparade import fixed
from workload.queries import AS_OF, CATEGORY, COUNTRY, DATE, PAGE, STUMP


def _listed(words) -> str:
    return ", ".join("'{}'".format(word.replace("'", "''")) for word in words)


def _tokens(text: str) -> str:
    """Tokens of a text: split at each white space, blanks at the end left out."""
    return f"string_split_regex(regexp_replace(lower(coalesce({text}, '')), '\\s+$', ''), '\\s')"


def _kept(text: str) -> str:
    """How many tokens of a text are no stop words, twice."""
    tokens = _tokens(text)
    kept = f"len(list_filter({tokens}, lambda w: w NOT IN ({_listed(fixed.ENGLISH_STOP_WORDS)})))"
    return f"{kept} AS kept, CAST({kept} AS DOUBLE) AS counted"


RAW_COLUMNS = """video_id, trending_date, title, channel_title, category_id, publish_time, tags, views, likes,
dislikes, comment_count, thumbnail_link, comments_disabled, ratings_disabled, video_error_or_removed, description,
country, l_orderkey, l_linenumber"""

VIDEO = "video_id, title, channel_title, views, likes, dislikes, comment_count, category_id, tags"

ENGAGEMENT = "CASE WHEN views > 0 THEN CAST(likes + comment_count AS DOUBLE) / views ELSE 0e0 END"


def _fixed_one(number: str) -> str:
    """One decimal with ties up; printf rounds the exact ties .25 and .75 to even."""
    return (
        f"CASE WHEN ({number}) * 4 = floor(({number}) * 4) AND ({number}) * 2 <> floor(({number}) * 2) "
        f"THEN printf('%.1f', ({number}) + 0.01e0) ELSE printf('%.1f', ({number})) END"
    )


def _compact(number: str) -> str:
    return (
        f"CASE WHEN {number} >= 1000000 THEN {_fixed_one(f'{number} / 1e6')} || 'M' "
        f"WHEN {number} >= 1000 THEN {_fixed_one(f'{number} / 1e3')} || 'K' "
        f"ELSE coalesce(CAST({number} AS VARCHAR), '0') END"
    )


def _percent(share: str) -> str:
    return f"{_fixed_one(f'({share}) * 100e0')} || '%'"


def _age_bucket(days: str) -> str:
    return f"CASE WHEN {days} <= 1 THEN 1 WHEN {days} <= 7 THEN 2 WHEN {days} <= 30 THEN 3 ELSE 4 END"


COMMON = f"""
WITH obs AS (
  SELECT 'v' || l_partkey AS video_id,
    strftime(date_trunc('month', l_shipdate + INTERVAL 20 YEAR), '%y.%d.%m') AS trending_date,
    CASE WHEN l_orderkey % 97 <> 0 THEN p_name || ' ' || p_type END AS title,
    CASE WHEN l_orderkey % 83 <> 0 THEN s_name END AS channel_title,
    CAST(p_size AS INTEGER) AS category_id,
    strftime(o_orderdate + INTERVAL 20 YEAR, '%Y-%m-%d') || 'T' || printf('%02d', o_orderkey % 24) || ':00:00.000Z'
      AS publish_time,
    CASE l_returnflag WHEN 'A' THEN '' WHEN 'R' THEN p_brand || '|' || p_type || '|' || l_linestatus END AS tags,
    CASE WHEN l_orderkey % 101 = 0 THEN NULL WHEN l_orderkey % 103 = 0 THEN -1
      ELSE CAST(floor(l_extendedprice) AS BIGINT) END AS views,
    CASE WHEN l_orderkey % 89 = 0 THEN -5 WHEN l_orderkey % 79 = 0 THEN NULL
      ELSE CAST(floor(l_extendedprice * l_discount) AS BIGINT) END AS likes,
    CAST(floor(l_extendedprice * l_tax) AS BIGINT) AS dislikes,
    CAST(l_quantity AS BIGINT) AS comment_count,
    'https://i.example.org/v' || l_partkey || '.jpg' AS thumbnail_link,
    l_returnflag = 'A' AS comments_disabled,
    l_linestatus = 'F' AS ratings_disabled,
    l_quantity = 1 AS video_error_or_removed,
    CASE WHEN l_orderkey % 71 <> 0 THEN p_type || ' by ' || s_name END AS description,
    r_name AS country, l_orderkey, l_linenumber
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
), loaded AS (
  SELECT {RAW_COLUMNS}, CAST(try_strptime(trending_date, '%y.%d.%m') AS DATE) AS trending_date_parsed
  FROM obs WHERE video_id IS NOT NULL AND title IS NOT NULL AND views IS NOT NULL AND views >= 0
), clean AS (
  SELECT * REPLACE (
    CASE WHEN views < 0 THEN 0 ELSE views END AS views,
    CASE WHEN likes < 0 THEN 0 ELSE likes END AS likes,
    CASE WHEN dislikes < 0 THEN 0 ELSE dislikes END AS dislikes,
    CASE WHEN comment_count < 0 THEN 0 ELSE comment_count END AS comment_count,
    coalesce(description, '') AS description, coalesce(tags, '') AS tags,
    coalesce(channel_title, 'Unknown') AS channel_title)
  FROM loaded
), tops AS (
  SELECT country, trending_date_parsed, CAST(rank AS INTEGER) AS rank, video_id, title, channel_title,
    coalesce(views, 0) AS views, coalesce(likes, 0) AS likes, coalesce(dislikes, 0) AS dislikes,
    coalesce(comment_count, 0) AS comment_count, category_id, tags
  FROM (
    SELECT *, row_number() OVER (PARTITION BY country, trending_date_parsed
      ORDER BY views DESC NULLS LAST, video_id NULLS FIRST, title NULLS FIRST, channel_title NULLS FIRST,
        likes NULLS FIRST, dislikes NULLS FIRST, comment_count NULLS FIRST, category_id NULLS FIRST,
        tags NULLS FIRST) AS rank
    FROM clean WHERE trending_date_parsed IS NOT NULL)
  WHERE rank <= 10
), stats AS (
  SELECT country, trending_date_parsed, count(*) AS total_videos,
    CAST(coalesce(sum(views), 0) AS BIGINT) AS total_views, coalesce(avg(views), 0e0) AS average_views,
    coalesce(max(views), 0) AS max_views, CAST(coalesce(sum(likes), 0) AS BIGINT) AS total_likes,
    CAST(coalesce(sum(comment_count), 0) AS BIGINT) AS total_comments
  FROM clean WHERE trending_date_parsed IS NOT NULL GROUP BY country, trending_date_parsed
), listed AS (
  SELECT {VIDEO}, country, strftime(trending_date_parsed, '%Y-%m-%d') AS date FROM tops
), title_words AS (
  SELECT country, trending_date_parsed, word FROM (
    SELECT country, trending_date_parsed,
      unnest(string_split_regex(regexp_replace(lower(title), '[^\\p{{L}}0-9\\s]', ' ', 'g'), '\\s+')) AS word
    FROM clean WHERE trending_date_parsed IS NOT NULL)
  WHERE length(word) > 2 AND regexp_matches(word, '^[\\p{{L}}0-9]+$') AND word NOT IN ({_listed(fixed.TITLE_STOP_WORDS)})
), title_tops AS (
  SELECT country, trending_date_parsed, word, value, row_number() OVER (
    PARTITION BY country, trending_date_parsed ORDER BY value DESC, word) AS rank
  FROM (SELECT country, trending_date_parsed, word, count(*) AS value FROM title_words GROUP BY ALL)
  QUALIFY rank <= 50
), document_words AS (
  SELECT country, trending_date_parsed, word, count(*) AS value FROM (
    SELECT lang AS country, source AS trending_date_parsed,
      unnest(string_split_regex(regexp_replace(lower(text), '[^\\p{{L}}0-9\\s]', ' ', 'g'), '\\s+')) AS word
    FROM documents)
  WHERE length(word) > 2 AND regexp_matches(word, '^[\\p{{L}}0-9]+$') AND word NOT IN ({_listed(fixed.TITLE_STOP_WORDS)})
  GROUP BY ALL
), names AS (
  SELECT 'US' AS country, CAST(n_nationkey AS VARCHAR) AS category_id, n_name AS category_name FROM nation
  UNION ALL SELECT 'CA', CAST(r_regionkey AS VARCHAR), r_name FROM region
), dictionary AS (
  SELECT category_id, coalesce(category_name, 'Category ' || category_id) AS category_name
  FROM (SELECT DISTINCT category_id FROM tops) AS found
  LEFT JOIN (SELECT category_id AS category_key, category_name FROM names WHERE country = 'US') AS us
    ON CAST(category_id AS VARCHAR) = category_key
), derived AS (
  SELECT *,
    CAST(hour(published) AS INTEGER) AS publish_hour, CAST(dayofweek(published) + 1 AS INTEGER) AS publish_day_of_week,
    CAST(date_diff('day', CAST(published AS DATE), trending_date_parsed) AS INTEGER) AS video_age_days,
    CASE WHEN views > 0 THEN CAST(likes AS DOUBLE) / views ELSE 0e0 END AS like_ratio,
    CASE WHEN views > 0 THEN CAST(dislikes AS DOUBLE) / views ELSE 0e0 END AS dislike_ratio,
    CASE WHEN views > 0 THEN CAST(comment_count AS DOUBLE) / views ELSE 0e0 END AS comment_ratio,
    CASE WHEN views > 0 THEN CAST(likes + comment_count AS DOUBLE) / views ELSE 0e0 END AS engagement_score,
    CAST(length(title) AS INTEGER) AS title_length,
    CASE WHEN tags IS NULL THEN 0 ELSE CAST(len(string_split(tags, '|')) AS INTEGER) END AS tag_count,
    ln(views + 1) AS log_views
  FROM (SELECT *, try_strptime(publish_time, '%Y-%m-%dT%H:%M:%S.%gZ') AS published FROM clean)
), features AS (
  SELECT video_id, country, strftime(trending_date_parsed, '%Y-%m-%d') AS trending_date,
    coalesce(views, 0) AS views, coalesce(likes, 0) AS likes, coalesce(dislikes, 0) AS dislikes,
    coalesce(comment_count, 0) AS comment_count, coalesce(category_id, 0) AS category_id,
    coalesce(like_ratio, 0e0) AS like_ratio, coalesce(dislike_ratio, 0e0) AS dislike_ratio,
    coalesce(comment_ratio, 0e0) AS comment_ratio, coalesce(engagement_score, 0e0) AS engagement_score,
    coalesce(title_length, 0) AS title_length, coalesce(tag_count, 0) AS tag_count,
    coalesce(publish_hour, 12) AS publish_hour, coalesce(publish_day_of_week, 1) AS publish_day_of_week,
    coalesce(video_age_days, 7) AS video_age_days,
    {_age_bucket("video_age_days")} AS video_age_proxy,
    coalesce(log_views, 0e0) AS log_views
  FROM derived
), cluster_inputs AS (
  SELECT ln(views + 1) AS log_views, ln(likes + 1) AS log_likes, ln(comment_count + 1) AS log_comments,
    like_ratio, engagement_score, title_length, tag_count, category_id, publish_hour, video_age_proxy
  FROM features
), labels_per_video AS (
  SELECT video_id, max(views) AS views, max(likes) AS likes, max(comment_count) AS comment_count,
    max(title_length) AS title_length, max(tag_count) AS tag_count, max(category_id) AS category_id,
    max(publish_hour) AS publish_hour, max(video_age_proxy) AS video_age_proxy, count(*) AS days_in_trending
  FROM features GROUP BY video_id
), longevity AS (
  SELECT *, likes / (views + 1e-9) AS like_ratio, (likes + comment_count) / (views + 1e-9) AS engagement_score
  FROM labels_per_video
), requests AS (
  SELECT video_id, country, title, views, coalesce(likes, 0) AS likes, coalesce(comment_count, 0) AS comment_count,
    category_id, tags, tags <> '' AS has_tags, length(description) AS description_length,
    CASE WHEN l_orderkey % 4 = 3 THEN 12 ELSE CAST(substr(publish_time, 12, 2) AS INTEGER) END AS publish_hour,
    CASE l_orderkey % 4 WHEN 0 THEN days_old WHEN 2 THEN days_old_east END AS days
  FROM (SELECT *,
      CAST(floor((epoch(TIMESTAMP '{AS_OF[:10]} {AS_OF[11:19]}') - epoch(stamp)) / 86400) AS INTEGER) AS days_old,
      CAST(floor((epoch(TIMESTAMP '{AS_OF[:10]} {AS_OF[11:19]}') - epoch(stamp) + 7200) / 86400) AS INTEGER)
        AS days_old_east
    FROM (SELECT *, CAST(replace(substr(publish_time, 1, 19), 'T', ' ') AS TIMESTAMP) AS stamp FROM clean))
), scoring AS (
  SELECT *, greatest(CAST(views AS DOUBLE), 1e0) AS v FROM requests
)
"""

TREND = "total_videos, total_views, average_views, max_views, total_likes, total_comments"

LISTING_TIES = """video_id NULLS FIRST, country NULLS FIRST, date NULLS FIRST, title NULLS FIRST,
channel_title NULLS FIRST, {rest} category_id NULLS FIRST, tags NULLS FIRST"""


def _order(key: str, direction: str = "DESC NULLS LAST") -> str:
    counters = [name for name in ("views", "likes", "dislikes", "comment_count") if name != key]
    return f"{key} {direction}, " + LISTING_TIES.format(rest="".join(f"{name} NULLS FIRST, " for name in counters))


def _documents(where: str = "TRUE") -> str:
    return f"""SELECT country, strftime(trending_date_parsed, '%Y-%m-%d') AS date, {TREND},
      CAST(rank - 1 AS INTEGER) AS position, {VIDEO}
    FROM tops JOIN stats USING (country, trending_date_parsed) WHERE {where}"""


def _word_documents(where: str = "TRUE") -> str:
    return f"""SELECT country, strftime(trending_date_parsed, '%Y-%m-%d') AS date,
      CAST(rank - 1 AS INTEGER) AS position, word AS text, value FROM title_tops WHERE {where}"""


def _statistics(where: str = "TRUE") -> str:
    return f"""SELECT * FROM (
      SELECT count(*) AS total_videos, coalesce(max(views), 0) AS max_views,
        CAST(coalesce(sum(views), 0) AS BIGINT) AS total_views, CAST(coalesce(sum(likes), 0) AS BIGINT) AS total_likes,
        CAST(coalesce(sum(comment_count), 0) AS BIGINT) AS total_comments,
        sum(coalesce(views, 0)) / count(*) AS avg_views, sum(coalesce(likes, 0)) / count(*) AS avg_likes,
        sum(coalesce(comment_count, 0)) / count(*) AS avg_comments
      FROM clean WHERE {where}) WHERE total_videos > 0"""


def _metrics(source: str, label: str) -> str:
    return f"""SELECT round(sqrt(avg((y - p) * (y - p))), 6) AS rmse, round(avg(abs(y - p)), 6) AS mae,
      round(1 - avg((y - p) * (y - p)) / var_pop(y), 6) AS r2_score, '{label}' AS label FROM ({source})"""


HEURISTIC = "least(10e0, greatest(0e0, ln({v} + 1) * ((likes + comment_count) / {v} + 0.5e0)))"

SCATTER = f"""SELECT CAST(row_number() OVER (ORDER BY {_order("views")}) AS INTEGER) AS position, views AS x,
  {ENGAGEMENT} AS y, greatest(10, least(300, comment_count)) AS z, coalesce(nullif(title, ''), 'Untitled') AS title,
  coalesce(nullif(channel_title, ''), 'Unknown Channel') AS channel, category_id
  FROM listed QUALIFY position <= 100"""

QUALITY = [("total_rows", "NULL", "count(*)")]
QUALITY += [("null_count", f"'{name}'", f"count(*) FILTER ({name} IS NULL)") for name in fixed.CRITICAL_COLUMNS]
QUALITY += [("negative_count", f"'{name}'", f"count(*) FILTER ({name} < 0)") for name in fixed.COUNTER_COLUMNS]

DUPLICATES = "SELECT count(*) AS n FROM (SELECT video_id FROM loaded GROUP BY video_id HAVING count(*) > 1)"

# The 32-bit murmur hash of a word's bytes, with the seed 42, as the text weights use it.
_MASK = "4294967295::UBIGINT"


def _times(value: str, factor: int) -> str:
    return f"((({value}) * {factor}::UBIGINT) & {_MASK})"


def _turned(value: str, bits: int) -> str:
    return f"((({value}) << {bits}) | (({value}) >> {32 - bits})) & {_MASK}"


_MURMUR = f"""hashed_words AS (
  SELECT word, n, list_transform(range(0, n), lambda i: CAST('0x' || substr(hex(word), 2 * i + 1, 2) AS UBIGINT)) AS b
  FROM (SELECT word, CAST(strlen(word) AS BIGINT) AS n FROM (SELECT DISTINCT word FROM tokens))
), parts AS (
  SELECT word, n, list_transform(range(0, (n + 3) // 4), lambda i: b[4 * i + 1] + coalesce(b[4 * i + 2], 0) * 256::UBIGINT
      + coalesce(b[4 * i + 3], 0) * 65536::UBIGINT + coalesce(b[4 * i + 4], 0) * 16777216::UBIGINT) AS k FROM hashed_words
), once AS (
  SELECT word, n, list_transform(k, lambda x: {_times("x", 0xCC9E2D51)}) AS k FROM parts
), mixed AS (
  SELECT word, n, list_transform(k, lambda x: {_times(_turned("x", 15), 0x1B873593)}) AS k FROM once
), whole AS (
  SELECT word, n, list_reduce(list_prepend(42::UBIGINT, k[: n // 4]),
      lambda h, x: (({_turned("xor(h, x)", 13)}) * 5::UBIGINT + {0xE6546B64}::UBIGINT) & {_MASK}) AS h,
    CASE WHEN n % 4 > 0 THEN k[-1] ELSE 0::UBIGINT END AS rest FROM mixed
), closed AS (
  SELECT word, xor(xor(h, rest), CAST(n AS UBIGINT)) AS h FROM whole
), first AS (
  SELECT word, {_times("xor(h, h >> 16)", 0x85EBCA6B)} AS h FROM closed
), second AS (
  SELECT word, {_times("xor(h, h >> 13)", 0xC2B2AE35)} AS h FROM first
), signed AS (
  SELECT word, CASE WHEN h >= 2147483648 THEN CAST(h AS BIGINT) - 4294967296 ELSE CAST(h AS BIGINT) END AS h
  FROM (SELECT word, xor(h, h >> 16) AS h FROM second)
)"""


def _weights(key: str, rows: str, text: str, buckets: int) -> str:
    """WITH parts and a query for the weights of the buckets of rows (key and text)."""
    return f"""texts AS ({rows}), tokens AS (
  SELECT {key}, word FROM (SELECT {key}, unnest({_tokens(text)}) AS word FROM texts)
  WHERE word NOT IN ({_listed(fixed.ENGLISH_STOP_WORDS)})
), {_MURMUR}, counted AS (
  SELECT {key}, CAST((h % {buckets} + {buckets}) % {buckets} AS INTEGER) AS bucket, count(*) AS times
  FROM tokens JOIN signed USING (word) GROUP BY ALL
)
SELECT {key}, bucket,
  round(times * ln(((SELECT count(*) FROM texts) + 1) / (count(*) OVER (PARTITION BY bucket) + 1)), 9) AS weight
FROM counted QUALIFY weight <> 0"""


_STUMP_ROWS = " UNION ALL ".join(
    f"SELECT '{name}' AS feature, {i} AS place, CAST({name} AS DOUBLE) AS value, days_in_trending AS y FROM longevity"
    for i, name in enumerate(STUMP)
)
#: The split that leaves the least variance; values between two that occur go to the nearer one.
_STUMP = f""", stump_rows AS ({_STUMP_ROWS}), cuts AS (
  SELECT feature, place, value, lead(value) OVER (PARTITION BY feature ORDER BY value) AS next
  FROM (SELECT DISTINCT feature, place, value FROM stump_rows)
), splits AS (
  SELECT c.feature, c.place, (c.value + c.next) / 2 AS threshold, avg(y) FILTER (r.value <= c.value) AS below,
    avg(y) FILTER (r.value > c.value) AS above,
    coalesce(var_pop(y) FILTER (r.value <= c.value), 0) * count(*) FILTER (r.value <= c.value)
      + coalesce(var_pop(y) FILTER (r.value > c.value), 0) * count(*) FILTER (r.value > c.value) AS spread
  FROM cuts AS c JOIN stump_rows AS r USING (feature) WHERE c.next IS NOT NULL GROUP BY ALL
), best AS (
  SELECT feature, threshold, below, above FROM splits ORDER BY spread, place, threshold LIMIT 1
)
"""

_AWKWARD = """title: CASE l_orderkey % 11 WHEN 0 THEN '"' || title || '", said' WHEN 1 THEN replace(title, ' ', ',  ') END
description: CASE l_orderkey % 11 WHEN 2 THEN description || chr(10) || 'and "more",' || chr(10) || chr(10) || ', of it' WHEN 3 THEN chr(10) || '"' || description WHEN 4 THEN '""' WHEN 5 THEN ' , ' END
channel_title: CASE l_orderkey % 11 WHEN 6 THEN channel_title || '"' || chr(10) END"""
_AWKWARD = ", ".join("coalesce({1}, {0}) AS {0}".format(*line.split(": ", 1)) for line in _AWKWARD.split("\n"))

_BODIES = {
    "scan_observations": f"SELECT {RAW_COLUMNS} FROM obs",
    "load_observations": "SELECT * FROM loaded",
    "clean_observations": "SELECT * FROM clean",
    "union_sources": """SELECT country, trending_date_parsed, video_id, views FROM loaded
      UNION ALL SELECT event_type, CAST(ts AS DATE), CAST(user_id AS VARCHAR), CAST(floor(value) AS BIGINT)
      FROM events""",
    "raw_normalised": f"""SELECT {RAW_COLUMNS}, strftime(trending_date_parsed, '%Y-%m-%d') AS trending_date_parsed,
      CASE WHEN l_orderkey % 73 <> 0 THEN CAST(l_linenumber AS DOUBLE) END AS rating FROM clean""",
    "category_dim": "SELECT * FROM names",
    "quality_report": " UNION ALL ".join(
        f"""SELECT '{check}' AS "check", CAST({column} AS VARCHAR) AS "column", {count} AS value FROM loaded"""
        for check, column, count in QUALITY
    )
    + f" UNION ALL SELECT 'duplicate_video_ids', 'video_id', n FROM ({DUPLICATES})",
    "duplicate_keys": f"SELECT n AS duplicate_video_ids FROM ({DUPLICATES})",
    "top_videos": "SELECT * FROM tops",
    "trend_stats": "SELECT * FROM stats",
    "trend_stats_daily": """SELECT event_type AS country, CAST(ts AS DATE) AS trending_date_parsed,
      count(*) AS total_videos, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS total_views,
      avg(CAST(floor(value) AS BIGINT)) AS average_views, max(CAST(floor(value) AS BIGINT)) AS max_views,
      CAST(0 AS BIGINT) AS total_likes, CAST(0 AS BIGINT) AS total_comments FROM events GROUP BY 1, 2""",
    "trend_groups": "SELECT DISTINCT country, trending_date_parsed FROM clean",
    "trend_documents": _documents(),
    "trend_for_group": _documents(f"country = '{COUNTRY}' AND trending_date_parsed = DATE '{DATE}'"),
    "word_counts": "SELECT * FROM document_words",
    "top_words": """SELECT *, CAST(row_number() OVER (PARTITION BY country, trending_date_parsed
      ORDER BY value DESC, word) AS INTEGER) AS rank FROM document_words QUALIFY rank <= 50""",
    "wordcloud_documents": _word_documents(),
    "wordcloud_latest": _word_documents(
        """(country, trending_date_parsed) IN (SELECT (country, max(trending_date_parsed)) FROM clean
        GROUP BY country)"""
    ),
    "listing_flat": "SELECT * FROM listed",
    "listing_filtered": f"""SELECT * FROM listed WHERE country = '{COUNTRY}' AND category_id = {CATEGORY}
      ORDER BY {_order("views")} LIMIT 200""",
    "listing_for_date": f"""SELECT * FROM listed WHERE date = '{DATE}'
      ORDER BY {_order("views", "ASC NULLS FIRST")} LIMIT 200""",
    "listing_by_views": f"SELECT * FROM listed ORDER BY {_order('views')} LIMIT 200",
    "listing_by_likes": f"SELECT * FROM listed ORDER BY {_order('likes')} LIMIT 200",
    "listing_by_comments": f"SELECT * FROM listed ORDER BY {_order('comment_count', 'ASC NULLS FIRST')} LIMIT 1000",
    "listing_by_engagement": f"""SELECT *, {ENGAGEMENT} AS engagement FROM listed
      ORDER BY {_order("engagement")} LIMIT 200""",
    "listing_page": f"SELECT * FROM listed ORDER BY {_order('views')} LIMIT 20 OFFSET {(PAGE - 1) * 20}",
    "listing_pages": "SELECT CAST(greatest(1, ceil(count(*) / 20)) AS BIGINT) AS pages FROM listed",
    "listing_named": """SELECT listed.*, coalesce(n.category_name, 'Category ' || listed.category_id) AS category_name,
      coalesce(n.category_name, 'Other') AS chart_category, coalesce(n.category_name, 'Unknown') AS table_category
      FROM listed LEFT JOIN (SELECT * FROM names WHERE country = 'US') AS n
      ON CAST(listed.category_id AS VARCHAR) = n.category_id""",
    "listing_display": f"""SELECT video_id, country, date, coalesce(nullif(title, ''), 'Untitled') AS title,
      coalesce(nullif(channel_title, ''), 'Unknown Channel') AS channel_title, {_compact("views")} AS views,
      {_compact("likes")} AS likes, {_compact("comment_count")} AS comment_count, {_percent(ENGAGEMENT)} AS engagement,
      'https://www.youtube.com/watch?v=' || video_id AS link FROM listed""",
    "listing_summary": f"""SELECT round(mean_engagement, 9) AS mean_engagement, total_views, total_likes,
      total_comments, {_percent("mean_engagement")} AS mean_engagement_text, {_compact("total_views")} AS total_views_text,
      {_compact("total_likes")} AS total_likes_text, {_compact("total_comments")} AS total_comments_text
      FROM (SELECT coalesce(avg(CASE WHEN views > 0 THEN {ENGAGEMENT} END), 0e0) AS mean_engagement,
        CAST(coalesce(sum(views), 0) AS BIGINT) AS total_views, CAST(coalesce(sum(likes), 0) AS BIGINT) AS total_likes,
        CAST(coalesce(sum(comment_count), 0) AS BIGINT) AS total_comments FROM listed)""",
    "listing_words": f"""SELECT text, count(*) AS value FROM (
        SELECT unnest(string_split_regex(regexp_replace(lower(title), '[^\\w\\s]', ' ', 'g'), '\\s+')) AS text
        FROM listed)
      WHERE length(text) > 2 AND text NOT IN ({_listed(fixed.LISTING_STOP_WORDS)})
      GROUP BY text ORDER BY value DESC, text LIMIT 100""",
    "countries": "SELECT DISTINCT country FROM listed",
    "categories": "SELECT * FROM dictionary",
    "dates": "SELECT DISTINCT date FROM listed",
    "dates_of_both_generations": """SELECT DISTINCT unnest(CASE WHEN n % 2 = 0 AND n % 3 <> 0 THEN [date, older]
        WHEN n % 2 = 0 THEN [date] WHEN n % 3 <> 0 THEN [older] ELSE [] END) AS date
      FROM (SELECT date, substr(date, 1, 8) || '28' AS older,
          CAST(substr(date, 9, 2) AS INTEGER) + CAST(substr(date, 6, 2) AS INTEGER) AS n
        FROM (SELECT DISTINCT strftime(trending_date_parsed, '%Y-%m-%d') AS date FROM stats))""",
    "category_share": f"""SELECT category_id, category_name, count(*) AS count,
      {_fixed_one("CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM listed) * 100e0")} AS percentage
      FROM listed JOIN dictionary USING (category_id) GROUP BY category_id, category_name""",
    "scatter_points": SCATTER,
    "scatter_groups": f"""SELECT * FROM (
      SELECT CAST(dense_rank() OVER (ORDER BY size DESC, first_position) AS INTEGER) AS "group", * EXCLUDE first_position
      FROM (SELECT category_name AS name, count(*) OVER (PARTITION BY category_name) AS size,
          min(position) OVER (PARTITION BY category_name) AS first_position, points.*
        FROM ({SCATTER}) AS points JOIN dictionary USING (category_id)))
      WHERE "group" <= 7""",
    "statistics_all": _statistics(),
    "statistics_country": _statistics(f"country = '{COUNTRY}'"),
    "table_counts": """SELECT 'raw_videos' AS "table", count(*) AS rows FROM clean
      UNION ALL SELECT 'trending_results', count(*) FROM stats
      UNION ALL SELECT 'wordcloud_data', count(*) FROM stats""",
    "category_distribution": "SELECT category_id, count(*) AS count FROM features GROUP BY category_id",
    "text_presence": """SELECT count(*) FILTER (title <> '') AS titles,
      count(*) FILTER (description <> '') AS descriptions, count(*) AS rows FROM clean""",
    "training_gate": """SELECT count(*) AS rows_seen, CAST(1000 AS INTEGER) AS required,
      count(*) >= 1000 AS enough FROM features""",
    "ml_features": "SELECT * REPLACE (round(log_views, 9) AS log_views) FROM features",
    "training_input": """SELECT video_id, country, trending_date, coalesce(channel_title, '') AS channel_title,
      coalesce(tags, '') AS tags, coalesce(views, 0) AS views, coalesce(likes, 0) AS likes,
      coalesce(dislikes, 0) AS dislikes, coalesce(comment_count, 0) AS comment_count,
      coalesce(category_id, 0) AS category_id FROM loaded""",
    "cluster_features": """SELECT * REPLACE (round(log_views, 9) AS log_views, round(log_likes, 9) AS log_likes,
      round(log_comments, 9) AS log_comments) FROM cluster_inputs""",
    "longevity_label": "SELECT * FROM labels_per_video",
    "longevity_features": "SELECT * FROM longevity",
    "scaled_features": "SELECT "
    + ", ".join(
        f"round({name} / (SELECT stddev_samp({name}) FROM cluster_inputs), 6) AS {name}"
        for name in fixed.CLUSTER_FEATURES
    )
    + " FROM cluster_inputs",
    "term_idf": f"""SELECT term, count(*) AS documents,
      round(ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)), 9) AS idf
      FROM (SELECT unnest(list_distinct(string_split_regex(lower(text), '\\s'))) AS term FROM documents)
      WHERE term <> '' AND term NOT IN ({_listed(fixed.ENGLISH_STOP_WORDS)}) GROUP BY term""",
    "csv_round_trip": f"SELECT * EXCLUDE (l_orderkey, l_linenumber) REPLACE ({_AWKWARD}, nullif(tags, '') AS tags) FROM obs",
    "category_round_trip": """SELECT 'US' AS country, CAST(n_nationkey AS VARCHAR) AS category_id, n_name AS category_name
      FROM nation UNION ALL SELECT 'CA', CAST(r_regionkey AS VARCHAR), r_name FROM region""",
    "batch_by_days": """SELECT country, strftime(trending_date_parsed, '%Y-%m-%d') AS date, count(*) AS total_videos,
      max(views) AS max_views, CAST(sum(views) AS BIGINT) AS total_views, CAST(coalesce(sum(likes), 0) AS BIGINT) AS total_likes,
      CAST(sum(comment_count) AS BIGINT) AS total_comments
      FROM (SELECT country, trending_date_parsed, views + CASE WHEN year(trending_date_parsed) >= 2015 THEN 1 ELSE 0 END AS views,
          CASE WHEN likes < 0 THEN 0 ELSE likes END AS likes, comment_count
        FROM (SELECT *, CAST(try_strptime(trending_date, '%y.%d.%m') AS DATE) AS trending_date_parsed FROM obs
          WHERE title IS NOT NULL))
      WHERE views >= 0 GROUP BY ALL""",
    "cluster_points": f"""SELECT category_id % {fixed.CLUSTERS} AS point, CAST(1 AS BIGINT) AS points, count(*) AS rows
      FROM features GROUP BY ALL""",
    "stump_days": f"""{_STUMP} SELECT video_id, country, views, publish_hour,
        round(greatest(0, CASE WHEN CASE feature WHEN 'publish_hour' THEN publish_hour
            WHEN 'tag_count' THEN CASE WHEN tags = '' THEN 0 ELSE len(string_split(tags, '|')) END
            ELSE CASE WHEN days IS NULL THEN 2 ELSE {_age_bucket("days")} END END <= threshold THEN below ELSE above END), 2)
          AS predicted_days, 'high' AS confidence, 'spark_mllib' AS days_method
      FROM scoring, best""",
    "stump_importance": f"""{_STUMP} SELECT name AS feature, CASE WHEN name = feature THEN 1e0 ELSE 0e0 END AS importance,
        CAST(row_number() OVER (ORDER BY name = feature DESC, name) AS INTEGER) AS rank
      FROM (SELECT unnest([{_listed(STUMP)}]) AS name), best QUALIFY rank <= 2""",
    "label_silhouette": """WITH pairs AS (
        SELECT x.vec_id, x.label AS own, y.label, count(*) AS n,
          sum(list_inner_product(x.v, x.v) + list_inner_product(y.v, y.v) - 2 * list_inner_product(x.v, y.v)) AS total
        FROM (SELECT vec_id, label, list_transform(embedding, lambda c: CAST(c AS DOUBLE)) AS v FROM embeddings) AS x,
          (SELECT label, list_transform(embedding, lambda c: CAST(c AS DOUBLE)) AS v FROM embeddings) AS y
        GROUP BY ALL
      ), scores AS (
        SELECT vec_id, max(total / (n - 1)) FILTER (label = own AND n > 1) AS inner_, min(total / n) FILTER (label <> own) AS outer_
        FROM pairs GROUP BY ALL)
      SELECT round(avg(coalesce((outer_ - inner_) / greatest(outer_, inner_), 0)), 6) AS silhouette_score FROM scores""",
    "description_weights": "WITH " + _weights("doc_id", "SELECT doc_id, text FROM documents", "text", fixed.DESCRIPTION_HASH_BUCKETS),
    "title_weights": ", " + _weights("title", "SELECT DISTINCT title FROM clean", "title", fixed.TITLE_HASH_BUCKETS),
    "description_counts": f"SELECT doc_id, {_kept('text')} FROM documents",
    "title_counts": f"SELECT video_id, country, trending_date, title, {_kept('title')} FROM clean",
    "cluster_assign_inputs": """SELECT * REPLACE (round(log_views, 9) AS log_views, round(log_likes, 9) AS log_likes,
      round(log_comments, 9) AS log_comments) FROM cluster_inputs""",
    "cluster_quality_facts": f"""SELECT CAST({fixed.CLUSTERS} AS INTEGER) AS num_clusters,
      '{" ".join(fixed.CLUSTER_FEATURES)}' AS features_used""",
    "regression_quality_facts": f"""SELECT '{fixed.LONGEVITY_LABEL}' AS label,
      '{" ".join(fixed.LONGEVITY_FEATURES)}' AS features_used""",
    "feature_importance_names": f"SELECT unnest([{_listed(fixed.LONGEVITY_FEATURES)}]) AS feature",
    "model_metrics_facts": f"""SELECT count(*) AS dataset_size, CAST({fixed.CLUSTERS} AS INTEGER) AS num_clusters,
      '{fixed.LONGEVITY_LABEL}' AS label FROM features""",
    "score_days_facts": """SELECT video_id, country, views, 'high' AS confidence, 'spark_mllib' AS days_method
      FROM scoring""",
    "score_cluster_facts": "SELECT video_id, country, views, 'spark_mllib' AS cluster_method FROM scoring",
    "score_both_facts": """SELECT video_id, country, title, views, likes, comment_count, category_id, tags, publish_hour,
      'high' AS confidence, 'spark_mllib' AS days_method, 'spark_mllib' AS cluster_method FROM scoring""",
    "train_test_split": """SELECT video_id,
      CAST('0x' || substr(md5(video_id || '-42'), 1, 8) AS BIGINT) % 10 < 8 AS in_training_set FROM longevity""",
    "regression_metrics": _metrics(
        f"SELECT days_in_trending AS y, round({HEURISTIC.format(v='greatest(CAST(views AS DOUBLE), 1e0)')}, 2) AS p"
        " FROM longevity",
        "days_in_trending",
    )
    + " UNION ALL "
    + _metrics("SELECT ln(views + 1) AS y, ln(likes + 1) AS p FROM longevity", "log_views"),
    "score_features": f"""SELECT video_id, country, tags, has_tags, CAST(description_length AS INTEGER)
      AS description_length, v AS views, CAST(likes AS DOUBLE) AS likes, CAST(comment_count AS DOUBLE) AS comment_count,
      likes / v AS like_ratio, (likes + comment_count) / v AS engagement_score,
      CAST(length(title) AS DOUBLE) AS title_length,
      CASE WHEN tags = '' THEN 0e0 ELSE CAST(len(string_split(tags, '|')) AS DOUBLE) END AS tag_count,
      CAST(category_id AS DOUBLE) AS category_id, CAST(publish_hour AS DOUBLE) AS publish_hour,
      CASE WHEN days IS NULL THEN 2e0 ELSE CAST({_age_bucket("days")} AS DOUBLE) END AS video_age_proxy,
      round(ln(v + 1), 9) AS log_views, round(ln(likes + 1), 9) AS log_likes,
      round(ln(comment_count + 1), 9) AS log_comments FROM scoring""",
    "heuristic_days": f"""SELECT video_id, country, views, likes, comment_count,
      round({HEURISTIC.format(v="v")}, 2) AS predicted_days, 'medium' AS confidence, 'heuristic' AS days_method
      FROM scoring""",
    "url_video_id": """WITH links AS (
        SELECT url FROM pages UNION ALL
        SELECT CASE p_partkey % 5 WHEN 0 THEN 'https://www.youtube.com/watch?v=v' || p_partkey || '&t=1'
          WHEN 1 THEN 'https://youtu.be/v' || p_partkey
          WHEN 2 THEN 'https://m.youtube.com/embed/v' || p_partkey || '?x=1'
          WHEN 3 THEN 'https://www.youtube.com/channel/v' || p_partkey
          ELSE 'http://notyoutube.com/watch?list=a&v=v' || p_partkey || '#top' END FROM part
      ), parsed AS (
        SELECT url, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host,
          regexp_extract(url, '^[a-z]+://[^/?#]*/([^?#]*)', 1) AS path,
          regexp_extract(url, '[?&]v=([^&#]+)', 1) AS v FROM links)
      SELECT url, nullif(CASE WHEN host = 'youtu.be' THEN path
        WHEN host LIKE '%youtube.com' THEN
          CASE WHEN v <> '' THEN v WHEN path LIKE 'embed/%' THEN substr(path, 7) END END, '') AS video_id
      FROM parsed""",
    "cluster_names": "SELECT vec_id, label, CASE label "
    + " ".join(f"WHEN {number} THEN '{name}'" for number, name in fixed.CLUSTER_NAMES.items())
    + " ELSE 'Cluster ' || label END AS cluster_type FROM embeddings",
}

_BODIES["model_defaults"] = """SELECT video_id, country, trending_date, engagement_score, CAST(12 AS INTEGER) AS publish_hour,
  CASE WHEN engagement_score > 0.1 THEN 1 ELSE 2 END AS video_age_proxy FROM features"""
_BODIES["weights_without_text"] = """SELECT video_id, country, trending_date, 0e0 AS desc_tfidf
  FROM clean, (SELECT unnest([1, 2]))"""
_BODIES["metrics_round_trip"] = "SELECT *, '2018-01-01T00:00:00' AS training_timestamp, CAST(2 AS BIGINT) AS history_rows, CAST(2 AS BIGINT) AS runs FROM (" + _metrics(
    f"SELECT days_in_trending AS y, round({HEURISTIC.format(v='greatest(CAST(views AS DOUBLE), 1e0)')}, 2) AS p FROM longevity", "days_in_trending"
) + ")"
_BODIES["listing_page_by_key"] = _BODIES["listing_page"]

STANDALONE = ("url_video_id", "cluster_names", "label_silhouette", "description_weights", "category_round_trip")

ORACLE = {name: body if name in STANDALONE else COMMON + body for name, body in _BODIES.items()}
