"""tidepool: news-article and social-post collections on Spark.

Plain DataFrame -> DataFrame functions; import what you need::

    from tidepool import clean_text, top_words, resolve_roots, topk_words
"""

import sys as _sys

# The few Python task functions (mapInPandas) are shipped by value, so
# executors need not have the package installed; on a cluster the package
# can still be shipped with --py-files.
try:  # pragma: no cover - depends on the PySpark build
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass

from tidepool.functions.dates import normalize_date, trim_date, tweet_time
from tidepool.functions.text import clean_text, join_list, split_entities, tokens
from tidepool.functions.urls import site_of
from tidepool.operators.articles import load_articles
from tidepool.operators.chains import (bot_share, chain_summary, collection_gap, ingest_closure,
                                       parent_kind, resolve_roots, retweets_per_root, root_details,
                                       site_top, top_roots, topk_words)
from tidepool.operators.edge_index import index_edges, refresh_archive, saved_posts, walk_indexed
from tidepool.operators.html_extract import (extract_articles, extract_links, listing_cards,
                                             listing_links, next_link, ordered_links, rules_frame)
from tidepool.operators.hydration import hydrate_slices, hydrated
from tidepool.operators.key_filter import append_filtered
from tidepool.operators.keyed import (append_new, assign_ids, ensure_column, hydrate, new_by_key,
                                      orphans, retweet_ids, unhydrated, update_by_key, without_key, write_append)
from tidepool.operators.listing_walk import walk_links, walk_pages
from tidepool.operators.parse import (extract_media, join_entities, parse_retweet_v1, parse_tweet_v1,
                                      parse_tweet_v2, route_media, split_valid)
from tidepool.operators.predicates import (any_term, has_all_tags, has_links, lang_is, match_rules,
                                           non_replies, not_retweet, only_retweets, recent_window,
                                           select_where, take_while_sorted, time_range, time_range_utc,
                                           union_distinct)
from tidepool.operators.stats import (distinct_links, load_report, top_mentions, top_n, top_sites,
                                      top_tags, top_words)
from tidepool.operators.windows import cap_pages_per_day, cap_per_day
from tidepool.sources.calendar import expected_days, missing_days
from tidepool.sources.files import (month_ids, read_articles, read_daily_tsv, read_id_files, read_pages,
                                    write_articles)
from tidepool.sources.tweets_json import read_tweets_v1, read_tweets_v2, stream_tweets

__all__ = [n for n in dir() if not n.startswith("_")]
