"""Schemas of the records the jobs read and write."""

from __future__ import annotations

CORRUPT = "_corrupt_record"

# presence-only keys are kept as text: an object under them stays its JSON text
RAW_POST = f"""
    id BIGINT, created_at STRING, lang STRING, text STRING,
    user STRUCT<screen_name: STRING, location: STRING, lang: STRING>,
    geo STRING,
    entities STRUCT<hashtags: ARRAY<STRUCT<text: STRING>>,
                    urls: ARRAY<STRUCT<url: STRING>>,
                    media: ARRAY<STRUCT<url: STRING>>>,
    retweeted_status STRING, `delete` STRING, `limit` STRING,
    {CORRUPT} STRING
"""

TAGGED_POST = """
    id BIGINT, timestamp STRING, batchtime BIGINT, username STRING, text STRING,
    hashtags ARRAY<STRING>, first_term STRING, search_terms ARRAY<STRING>,
    multiple_terms BOOLEAN
"""

TERM_DICTIONARY = """
    general ARRAY<STRING>, candidates MAP<STRING, MAP<STRING, ARRAY<STRING>>>
"""


REDUCED_POST = """
    first_term STRING, text STRING, timestamp STRING, tweet_id BIGINT, username STRING
"""

SUMMARY_DATA = """
    count BIGINT, num_posts BIGINT, total_word_ct BIGINT, prop_words_scored DOUBLE,
    sentiment_avg DOUBLE, sentiment_std DOUBLE
"""
