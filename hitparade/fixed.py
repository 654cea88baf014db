"""Results are only right with exactly these words, names, numbers and formats."""

# Country codes with a daily snapshot file.
COUNTRIES = ("US", "CA", "GB", "DE", "FR", "IN", "JP", "KR", "MX", "RU")

# Date and time text in the snapshot files, and dates in stored results.
TRENDING_DATE_FORMAT = "yy.dd.MM"
PUBLISH_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
RESULT_DATE_FORMAT = "yyyy-MM-dd"

# Columns checked for nulls and for negative numbers.
CRITICAL_COLUMNS = ("video_id", "title", "channel_title", "views", "likes", "dislikes")
COUNTER_COLUMNS = ("views", "likes", "dislikes", "comment_count")

# Replacements for nulls in cleaned observations.
CLEAN_DEFAULTS = {"description": "", "tags": "", "channel_title": "Unknown"}

# Replacements for nulls in feature rows.
FEATURE_DEFAULTS = {
    "views": 0,
    "likes": 0,
    "dislikes": 0,
    "comment_count": 0,
    "category_id": 0,
    "like_ratio": 0.0,
    "dislike_ratio": 0.0,
    "comment_ratio": 0.0,
    "engagement_score": 0.0,
    "title_length": 0,
    "tag_count": 0,
    "publish_hour": 12,
    "publish_day_of_week": 1,
    "video_age_days": 7,
    "video_age_proxy": 2,
    "log_views": 0.0,
}

# Upper bounds in days of the age buckets 1, 2 and 3; older is 4.
AGE_BUCKET_DAYS = (1, 7, 30)

# Rows per group in stored results, and listing limits.
TOP_VIDEOS = 10
TOP_WORDS = 50
LISTING_WORDS = 100
LISTING_LIMIT = 200
LISTING_LIMIT_MAX = 1000
PAGE_SIZE = 20
SCATTER_ROWS = 100
SCATTER_GROUPS = 7

# Characters that make up a word, in title counts and in listing counts.
TITLE_WORD_CHARACTERS = r"[\p{L}0-9]"
LISTING_WORD_CHARACTERS = r"[A-Za-z0-9_]"
WORD_MIN_LENGTH = 3

# Words left out of title counts.
TITLE_STOP_WORDS = (
    "the", "and", "or", "but", "in", "on", "at", "to", "for", "of", "with",
    "by", "a", "an", "is", "are", "was", "were", "be", "been", "being",
    "have", "has", "had", "do", "does", "did", "will", "would", "could",
    "should", "may", "might", "must", "can", "this", "that", "these",
    "those", "i", "you", "he", "she", "it", "we", "they", "me", "him",
    "her", "us", "them", "my", "your", "his", "its", "our", "their",
)

# Words left out of listing counts.
LISTING_STOP_WORDS = (
    "the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for", "of",
    "with", "by", "from", "up", "about", "into", "through", "during", "before",
    "after", "above", "below", "between", "under", "again", "further", "then",
    "once", "here", "there", "when", "where", "why", "how", "all", "both",
    "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not",
    "only", "own", "same", "so", "than", "too", "very", "can", "will", "just",
    "should", "now", "i", "you", "he", "she", "it", "we", "they", "them",
    "this", "that", "these", "those", "is", "are", "was", "were", "be", "been",
    "being", "have", "has", "had", "do", "does", "did", "my", "your", "his",
    "her", "its", "our", "their",
)

# Display names.
CLUSTER_NAMES = {
    0: "Nhóm Viral mạnh",
    1: "Nhóm Buzz ngắn hạn",
    2: "Nhóm Tương tác niche",
}
CATEGORY_COUNTRY = "US"
UNTITLED = "Untitled"
UNKNOWN_CHANNEL = "Unknown Channel"
UNKNOWN_CATEGORY = "Unknown"
OTHER_CATEGORY = "Other"

# Video link hosts and the watch link prefix.
SHORT_LINK_HOST = "youtu.be"
WATCH_HOST_SUFFIX = "youtube.com"
WATCH_LINK = "https://www.youtube.com/watch?v="

# Model inputs and parameters.
CLUSTER_FEATURES = (
    "log_views", "log_likes", "log_comments", "like_ratio", "engagement_score",
    "title_length", "tag_count", "category_id", "publish_hour", "video_age_proxy",
)
LONGEVITY_FEATURES = (
    "views", "likes", "comment_count", "like_ratio", "engagement_score",
    "title_length", "tag_count", "category_id", "publish_hour", "video_age_proxy",
)
LONGEVITY_LABEL = "days_in_trending"
RATIO_EPSILON = 1e-9
CLUSTERS = 3
CLUSTER_ITERATIONS = 200
FOREST_TREES = 100
FOREST_DEPTH = 10
SEED = 42
TRAIN_TENTHS = 8
TITLE_HASH_BUCKETS = 1000
DESCRIPTION_HASH_BUCKETS = 2000
TRAINING_ROWS_MIN = 1000

# Longevity estimate without a model.
HEURISTIC_BASE = 0.5
HEURISTIC_MAX_DAYS = 10.0

# Fields of a scoring request beside the title, with their defaults.
REQUEST_DEFAULTS = {
    "views": 0,
    "likes": 0,
    "comment_count": 0,
    "category_id": 0,
    "tags": "",
    "description": "",
    "channel_title": "",
    "duration": "",
    "publish_hour": 12,
    "video_age_proxy": 2,
}

# Words left out of text weights: the English list of MLlib.
ENGLISH_STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours", "yourself", "yourselves",
    "he", "him", "his", "himself", "she", "her", "hers", "herself", "it", "its", "itself", "they", "them", "their",
    "theirs", "themselves", "what", "which", "who", "whom", "this", "that", "these", "those", "am", "is", "are",
    "was", "were", "be", "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by", "for", "with", "about",
    "against", "between", "into", "through", "during", "before", "after", "above", "below", "to", "from", "up",
    "down", "in", "out", "on", "off", "over", "under", "again", "further", "then", "once", "here", "there", "when",
    "where", "why", "how", "all", "any", "both", "each", "few", "more", "most", "other", "some", "such", "no",
    "nor", "not", "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don",
    "should", "now", "i'll", "you'll", "he'll", "she'll", "we'll", "they'll", "i'd", "you'd", "he'd", "she'd",
    "we'd", "they'd", "i'm", "you're", "he's", "she's", "it's", "we're", "they're", "i've", "we've", "you've",
    "they've", "isn't", "aren't", "wasn't", "weren't", "haven't", "hasn't", "hadn't", "don't", "doesn't", "didn't",
    "won't", "wouldn't", "shan't", "shouldn't", "mustn't", "can't", "couldn't", "cannot", "could", "here's",
    "how's", "let's", "ought", "that's", "there's", "what's", "when's", "where's", "who's", "why's", "would",
)
