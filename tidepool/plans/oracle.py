"""DuckDB twins of the check queries (the correctness oracle).

Written independently of the Spark plans: plain SQL over the driver's
views, recursive CTEs where Spark iterates. Adapter CTEs repeat the
expressions of ``tidepool.plans.adapters``.
"""

from __future__ import annotations

from tidepool.plans import catalog as cat

# Stated here on their own, as RE2 reads them. Removed from texts: all but
# ASCII letters, digits, spaces and tabs, and words followed by "://" and
# text up to white space (Unicode) or a separator control.
CLEAN_RE = (r"([^0-9A-Za-z \t])|([\p{L}\p{N}_]+://[^\s\x0B\x1C-\x1F\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}"
            r"\x{202F}\x{205F}\x{3000}]+)")
# Tokens: a phone number, a letter-eight sign, three letters or more, or a run.
TOKEN_PATTERN = r"(?:[01] *)?(?:[0-9]{3} *)?[0-9]{3} *[0-9]{4}|8o?[dp]|[dp]o?8|[a-z]{3,}|[0-9a-z]+"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# The English stopwords, stated here apart from the code under test.
STOPWORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you",
    "you're", "you've", "you'll", "you'd", "your", "yours", "yourself",
    "yourselves", "he", "him", "his", "himself", "she", "she's", "her",
    "hers", "herself", "it", "it's", "its", "itself", "they", "them",
    "their", "theirs", "themselves", "what", "which", "who", "whom", "this",
    "that", "that'll", "these", "those", "am", "is", "are", "was", "were",
    "be", "been", "being", "have", "has", "had", "having", "do", "does",
    "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because",
    "as", "until", "while", "of", "at", "by", "for", "with", "about",
    "against", "between", "into", "through", "during", "before", "after",
    "above", "below", "to", "from", "up", "down", "in", "out", "on", "off",
    "over", "under", "again", "further", "then", "once", "here", "there",
    "when", "where", "why", "how", "all", "any", "both", "each", "few",
    "more", "most", "other", "some", "such", "no", "nor", "not", "only",
    "own", "same", "so", "than", "too", "very", "s", "t", "can", "will",
    "just", "don", "don't", "should", "should've", "now", "d", "ll", "m",
    "o", "re", "ve", "y", "ain", "aren", "aren't", "couldn", "couldn't",
    "didn", "didn't", "doesn", "doesn't", "hadn", "hadn't", "hasn",
    "hasn't", "haven", "haven't", "isn", "isn't", "ma", "mightn",
    "mightn't", "mustn", "mustn't", "needn", "needn't", "shan", "shan't",
    "shouldn", "shouldn't", "wasn", "wasn't", "weren", "weren't", "won",
    "won't", "wouldn", "wouldn't",
]
STOP_LIST = "[" + ", ".join(_q(w) for w in STOPWORDS) + "]"


def clean_sql(x: str) -> str:
    return (f"trim(regexp_replace(regexp_replace(lower({x}), {_q(CLEAN_RE)}, '', 'g'), "
            f"'[ \\t]+', ' ', 'g'))")


def tokens_sql(x: str) -> str:
    return (f"list_filter(regexp_extract_all({clean_sql(x)}, {_q(TOKEN_PATTERN)}, 0), "
            f"lambda w: NOT list_contains({STOP_LIST}, w))")


def split_sql(x: str, lower: bool = True) -> str:
    v = f"lower({x})" if lower else x
    return f"list_filter(string_split(coalesce({v}, ''), ','), lambda e: e <> '')"


def site_sql(x: str) -> str:
    pat = _q(r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)")
    return (f"CASE WHEN regexp_extract({x}, {pat}, 1) <> '' THEN lower(regexp_extract({x}, {pat}, 1)) "
            f"|| '://' || regexp_extract({x}, {pat}, 2) || '/' END")


def host_sql(x: str) -> str:
    pat = _q(r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)")
    return f"nullif(regexp_extract({x}, {pat}, 2), '')"


def decode_sql(x: str) -> str:
    out = x
    # the references that occur in the driver's pages; &amp last
    for name, ch in [("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "'"), ("nbsp", "\u00a0"), ("copy", "\u00a9"),
                     ("middot", "\u00b7"), ("amp", "&")]:
        out = f"regexp_replace({out}, {_q('&' + name + ';?')}, {_q(ch)}, 'g')"
    return out


def tag_text_sql(x: str) -> str:
    return f"trim({decode_sql(f'regexp_replace({x}, {_q(r'<[^>]*>')}, {_q('')}, {_q('g')})')})"


def inner_sql(x: str, tag: str) -> str:
    return f"regexp_extract({x}, {_q(rf'(?s)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>')}, 1)"


def paragraphs_sql(x: str) -> str:
    pieces = f"string_split_regex({x}, {_q(r'<p(\s[^>]*)?>')})"
    inner = tag_text_sql("split_part(s, '</p>', 1)")
    texts = f"list_transform(({pieces})[2:], lambda s: {inner})"
    return f"list_filter({texts}, lambda t: t <> '')"


TS = "TIMESTAMP '2024-01-01 00:00:00'"

IDS = """ids AS (SELECT CAST(doc_id AS VARCHAR) AS tweet_id FROM labels
               UNION ALL SELECT CAST(page_id + 1000000 AS VARCHAR) FROM pages)"""

TWEETS = f"""tweets AS (
  SELECT d.doc_id, CAST(d.doc_id AS VARCHAR) AS tweet_id,
         CAST(d.doc_id % 97 AS VARCHAR) AS author_id,
         {TS} + to_minutes(CAST(d.doc_id * 20 AS BIGINT)) AS created_at,
         d.text, d.lang, d.source,
         concat_ws(',', CASE WHEN d.doc_id % 3 = 0 THEN '#Covid19' END,
                        CASE WHEN d.doc_id % 4 = 0 THEN '#2020Election' END,
                        '#' || d.source) AS hashtags_str,
         concat_ws(',', '@User' || CAST(d.doc_id % 13 AS VARCHAR),
                        CASE WHEN d.doc_id % 5 = 0 THEN '@user' || CAST(d.doc_id % 7 AS VARCHAR) END) AS mentions_str,
         coalesce(p.url, '') AS expanded_urls,
         d.doc_id % 50 AS like_count,
         d.doc_id % 11 AS retweet_count,
         CASE d.doc_id % 10 WHEN 8 THEN 'retweet' WHEN 9 THEN 'reply' ELSE 'regular' END AS kind
  FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id)"""

REGULAR = """regular AS (
  SELECT CAST(c.conv_id * 100 AS VARCHAR) AS tweet_id,
         CAST((c.conv_id * 13) % 400 AS VARCHAR) AS author_id,
         c.text, coalesce(p.url, '') AS expanded_urls, c.conv_id % 9 AS retweet_count
  FROM conversations c LEFT JOIN pages p ON p.page_id = c.conv_id
  WHERE c.turn = 0)"""

PARENT = ("CAST(CASE WHEN conv_id % 7 = 3 AND turn = 2 THEN conv_id * 100 + 99 "
          "ELSE conv_id * 100 + turn - 1 END AS VARCHAR)")

RETWEETS = f"""retweets AS (
  SELECT CAST(conv_id * 100 + turn AS VARCHAR) AS tweet_id,
         CAST((conv_id * 13 + turn * 29) % 400 AS VARCHAR) AS author_id,
         {PARENT} AS parent_tweet_id, text
  FROM conversations WHERE turn > 0)"""

ROOTS = """walk(tweet_id, cur, steps) AS (
  SELECT tweet_id, parent_tweet_id, 0 FROM retweets
  UNION ALL
  SELECT w.tweet_id, r.parent_tweet_id, w.steps + 1
  FROM walk w JOIN retweets r ON r.tweet_id = w.cur
  WHERE w.cur NOT IN (SELECT tweet_id FROM regular) AND w.steps < 10000),
roots AS (SELECT tweet_id, cur AS root_id FROM walk WHERE cur IN (SELECT tweet_id FROM regular)),
per_root AS (SELECT root_id, count(*) AS n_retweets FROM roots GROUP BY root_id),
ranked AS (SELECT root_id, n_retweets, row_number() OVER (ORDER BY n_retweets DESC, root_id) AS rank
           FROM per_root QUALIFY rank <= 100)"""

CHAINS = f"WITH RECURSIVE {REGULAR},\n{RETWEETS},\n{ROOTS}\n"

ARTICLE_PAGES = f"""article_pages AS (
  SELECT page_id, url, {host_sql('url')} AS source,
         {tag_text_sql(inner_sql(inner_sql('html', 'article'), 'h1'))} AS title,
         array_to_string({paragraphs_sql(inner_sql('html', 'article'))}, chr(10)) AS content
  FROM pages)"""

def published_sql(raw: str, source: str) -> str:
    """The ``YYYY-MM-DD`` day of a raw publish date, or NULL."""
    s = f"""(CASE {source} WHEN 'WND' THEN split_part({raw}, ' at', 1)
                     WHEN 'WorldHealth' THEN array_to_string(string_split({raw}, ',')[1:2], ',')
                     WHEN 'ZeroHedge' THEN split_part(split_part({raw}, ', ', 2), ' -', 1)
                     ELSE {raw} END)"""
    return f"""CASE WHEN coalesce({raw}, '') = '' THEN NULL ELSE strftime(coalesce(
         CAST(try_strptime({s}, '%Y-%m-%d') AS DATE),
         CAST(try_strptime(nullif(regexp_extract({s}, '^(\\d{{4}}-\\d{{1,2}}-\\d{{1,2}})T\\d{{1,2}}:\\d{{1,2}}:\\d{{1,2}}(Z|[+-]\\d{{2}}:?\\d{{2}})$', 1), ''), '%Y-%m-%d') AS DATE),
         CAST(try_strptime({s}, '%B %d, %Y') AS DATE),
         CAST(try_strptime({s}, '%b %d, %Y') AS DATE),
         CAST(try_strptime({s}, '%m/%d/%Y') AS DATE)), '%Y-%m-%d') END"""


ARTICLES = f"""{ARTICLE_PAGES},
scraped AS (SELECT page_id AS "row", url, source, title, content FROM article_pages
       UNION ALL
       SELECT page_id + 1000000, url, source, title, content FROM article_pages
       WHERE page_id IN (SELECT conv_id FROM conversations)),
dated AS (SELECT *, DATE '2020-01-01' + CAST("row" % 1000 AS INTEGER) AS day FROM scraped),
ai AS (SELECT "row", url, CASE WHEN "row" % 7 = 4 THEN 'ZeroHedge' ELSE source END AS source, title, content,
              CASE "row" % 7 WHEN 0 THEN strftime(day, '%Y-%m-%d')
                             WHEN 1 THEN strftime(day, '%Y-%m-%d') || 'T08:30:00-05:00'
                             WHEN 2 THEN strftime(day, '%B %-d, %Y')
                             WHEN 3 THEN strftime(day, '%b %-d, %Y')
                             WHEN 4 THEN strftime(day, '%a, %m/%d/%Y') || ' - 17:48'
                             WHEN 6 THEN '3 hours ago' END AS raw_date
       FROM dated),
parsed AS (SELECT *, {published_sql('raw_date', 'source')} AS published FROM ai),
ex AS (SELECT * FROM article_pages WHERE page_id IN (SELECT doc_id FROM labels)),
firsts AS (SELECT * FROM parsed WHERE raw_date IS NULL OR published IS NOT NULL
           QUALIFY row_number() OVER (PARTITION BY url ORDER BY source, "row") = 1),
new AS (SELECT * FROM firsts WHERE url NOT IN (SELECT url FROM ex)),
ided AS (SELECT (SELECT count(*) FROM ex) + row_number() OVER (ORDER BY source, "row") - 1 AS article_id,
                title, source, content, published AS "publishedAt", url
         FROM new)"""


def _raw_dates() -> str:
    fmts = ["strftime(o_orderdate, '%Y-%m-%d')",
            "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '-05:00'",
            "strftime(o_orderdate, '%B %-d, %Y')",
            "strftime(o_orderdate, '%b %-d, %Y')",
            "strftime(o_orderdate, '%B %-d, %Y') || ' at 1:40pm'",
            "strftime(o_orderdate, '%b %-d, %Y') || ',  2 p.m.'",
            "strftime(o_orderdate, '%a, %m/%d/%Y') || ' - 17:48'"]
    from tidepool.plans.adapters import RAW_DATE_SHAPES
    src = " ".join(f"WHEN {i} THEN {_q(s[0])}" for i, s in enumerate(RAW_DATE_SHAPES))
    txt = " ".join(f"WHEN {i} THEN {f}" for i, f in enumerate(fmts))
    return (f"raw AS (SELECT o_orderkey, CASE o_orderkey % 7 {src} END AS source, "
            f"CASE o_orderkey % 7 {txt} END AS raw_date FROM orders)")


def _rules_sql() -> str:
    tags = split_sql("hashtags_str")
    urls = split_sql("expanded_urls", lower=False)
    return (f"(list_has_all({tags}, ['#covid19', '#2020election'])) OR "
            f"(list_contains({tags}, '#2020election') AND len({urls}) > 0 AND lang = 'en' "
            f"AND kind <> 'retweet')")


ORACLE: dict[str, str] = {
    "clean_text": f"SELECT doc_id, {clean_sql('text')} AS clean FROM documents",
    "word_top20": f"""WITH {TWEETS}, w AS (SELECT unnest({tokens_sql('text')}) AS term FROM tweets)
        SELECT term, count(*) AS n FROM w GROUP BY term ORDER BY n DESC, term LIMIT 20""",
    "hashtag_top20": f"""WITH {TWEETS}, w AS (SELECT unnest({split_sql('hashtags_str')}) AS term FROM tweets)
        SELECT term, count(*) AS n FROM w GROUP BY term ORDER BY n DESC, term LIMIT 20""",
    "mention_top20": f"""WITH {TWEETS}, w AS (SELECT unnest({split_sql('mentions_str')}) AS term FROM tweets)
        SELECT term, count(*) AS n FROM w GROUP BY term ORDER BY n DESC, term LIMIT 20""",
    "select_where": f"WITH {TWEETS} SELECT tweet_id, lang, like_count FROM tweets WHERE like_count >= 25",
    "retweets_only": f"""WITH {TWEETS} SELECT tweet_id, author_id,
        strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at FROM tweets WHERE kind = 'retweet'""",
    "any_term": "SELECT doc_id FROM documents WHERE regexp_matches(text, '(?i)" + "|".join(cat.ANY_TERMS) + "')",
    "search_rules": f"WITH {TWEETS} SELECT tweet_id FROM tweets WHERE {_rules_sql()}",
    "union_distinct": f"""WITH {TWEETS} SELECT DISTINCT tweet_id, lang FROM (
        SELECT tweet_id, lang FROM tweets WHERE lang = 'en'
        UNION ALL SELECT tweet_id, lang FROM tweets WHERE like_count >= 40
        UNION ALL SELECT tweet_id, lang FROM tweets WHERE kind = 'reply')""",
    "recent_window": f"""WITH {TWEETS} SELECT tweet_id, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at
        FROM tweets WHERE created_at >= TIMESTAMP '{cat.RECENT_NOW}' - INTERVAL 7 DAY
        AND created_at < TIMESTAMP '{cat.RECENT_NOW}' - INTERVAL 1 MINUTE
        AND kind <> 'reply' AND kind <> 'retweet'""",
    "take_while_sorted": """WITH f AS (
          SELECT o_orderkey, o_custkey,
                 CASE WHEN o_orderdate > lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderkey)
                      THEN 1 ELSE 0 END AS rose
          FROM orders),
        s AS (SELECT o_orderkey, max(rose) OVER (PARTITION BY o_custkey ORDER BY o_orderkey
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stop FROM f)
        SELECT o_orderkey FROM s WHERE stop = 0""",
    "daily_source_ids": """SELECT CAST(d.doc_id AS VARCHAR) AS tweet_id FROM documents d
        WHERE d.lang = 'en' AND d.doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)""",
    "daily_retweet_ids": """SELECT CAST(d.doc_id AS VARCHAR) AS tweet_id FROM documents d
        WHERE d.lang = 'en' AND d.doc_id NOT IN (
          SELECT doc_id FROM documents WHERE lang = 'en'
          AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1))""",
    "hydrate": f"""WITH {IDS} SELECT i.tweet_id, d.lang, d.source
        FROM (SELECT DISTINCT tweet_id FROM ids) i JOIN documents d ON CAST(d.doc_id AS VARCHAR) = i.tweet_id""",
    "unhydrated": f"""WITH {IDS} SELECT DISTINCT tweet_id FROM ids
        WHERE tweet_id NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM documents)""",
    "orphans": f"""WITH {REGULAR}, {RETWEETS} SELECT tweet_id, parent_tweet_id FROM retweets
        WHERE parent_tweet_id NOT IN (SELECT tweet_id FROM regular UNION ALL SELECT tweet_id FROM retweets)""",
    "append_new": """SELECT tweet_id, turn, role FROM (
          SELECT CAST(conv_id AS VARCHAR) AS tweet_id, turn, role FROM conversations
          QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn, role) = 1)
        WHERE tweet_id NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)""",
    "update_stats": """WITH latest AS (
          SELECT user_id, arg_max(value, (ts, event_id)) AS v FROM events GROUP BY user_id)
        SELECT c.c_custkey AS key, CASE WHEN l.user_id IS NOT NULL THEN l.v ELSE c.c_acctbal END AS value
        FROM customer c LEFT JOIN latest l ON l.user_id = c.c_custkey""",
    "update_text": """WITH latest AS (
          SELECT user_id, arg_max(event_type, (ts, event_id)) AS t FROM events GROUP BY user_id)
        SELECT c.c_custkey AS key, c.c_acctbal AS value,
               CASE WHEN l.user_id IS NOT NULL THEN l.t ELSE CAST(NULL AS VARCHAR) END AS text
        FROM customer c LEFT JOIN latest l ON l.user_id = c.c_custkey""",
    "load_articles": f"""WITH {ARTICLES}
        SELECT article_id, title, source, content, publishedAt, url, 'unknown' AS label FROM ided""",
    "load_rejects": f"""WITH {ARTICLES}
        SELECT "row" AS listing_row, source, url, raw_date AS "publishedAt" FROM parsed
        WHERE raw_date IS NOT NULL AND published IS NULL""",
    "load_report": f"""WITH {ARTICLES}
        SELECT source, count(*) AS n FROM ided GROUP BY source
        UNION ALL SELECT '<before>', count(*) FROM ex
        UNION ALL SELECT '<inserted>', count(*) FROM ided
        UNION ALL SELECT '<after>', (SELECT count(*) FROM ex) + (SELECT count(*) FROM ided)""",
    "cap_per_day": f"""SELECT event_id FROM events QUALIFY row_number() OVER (
        PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id) <= {cat.CAP_PER_DAY}""",
    "cap_pages_per_day": f"""SELECT event_id FROM (
          SELECT event_id, (row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id) - 1)
                 // {cat.PAGE_SIZE} AS page FROM events)
        WHERE page * {cat.PAGE_SIZE} < {cat.CAP_PER_DAY}""",
    "date_normalize": f"WITH {_raw_dates()} SELECT o_orderkey, {published_sql('raw_date', 'source')} AS published FROM raw",
    "missing_days": f"""WITH days AS (
          SELECT CAST(unnest(generate_series(DATE '{cat.MISSING_MONTH}-01',
                 CAST(last_day(DATE '{cat.MISSING_MONTH}-01') AS DATE), INTERVAL 1 DAY)) AS DATE) AS day)
        SELECT strftime(day, '%Y-%m-%d') AS day FROM days WHERE day NOT IN (
          SELECT CAST(ts AS DATE) FROM events)""",
    "page_title": f"WITH {ARTICLE_PAGES} SELECT page_id, title FROM article_pages",
    "page_content": f"WITH {ARTICLE_PAGES} SELECT page_id, content FROM article_pages",
    "links": f"""WITH h AS (SELECT url, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS href FROM pages)
        SELECT DISTINCT CASE WHEN starts_with(href, '/') AND NOT starts_with(href, '//')
                             THEN regexp_replace({site_sql('url')}, '/$', '') || href ELSE href END AS link
        FROM h""",
    "listing_last_wins": f"""SELECT {host_sql('url')} AS host,
          arg_max({tag_text_sql(inner_sql(inner_sql('html', 'article'), 'h1'))}, page_id) AS title
        FROM pages GROUP BY 1""",
    "direct_undirect": f"""WITH {REGULAR}, {RETWEETS}
        SELECT tweet_id, CASE WHEN parent_tweet_id IN (SELECT tweet_id FROM regular)
                              THEN 'direct' ELSE 'undirect' END AS parent_kind FROM retweets""",
    "retweet_roots": CHAINS + "SELECT tweet_id, root_id FROM roots",
    "retweets_per_root": CHAINS + "SELECT root_id, n_retweets FROM per_root",
    "collection_gap": CHAINS + """SELECT p.root_id, p.n_retweets AS collected, r.retweet_count AS reported,
        r.retweet_count - p.n_retweets AS gap FROM per_root p JOIN regular r ON r.tweet_id = p.root_id""",
    "dataset_summary": CHAINS + """SELECT 'roots_with_retweets' AS metric, count(*) AS value FROM per_root
        UNION ALL SELECT 'regular', count(*) FROM regular
        UNION ALL SELECT 'retweets', count(*) FROM retweets
        UNION ALL SELECT 'direct', count(*) FROM retweets WHERE parent_tweet_id IN (SELECT tweet_id FROM regular)
        UNION ALL SELECT 'undirect', count(*) FROM retweets WHERE parent_tweet_id NOT IN (SELECT tweet_id FROM regular)
        UNION ALL SELECT 'resolved', count(*) FROM roots
        UNION ALL SELECT 'broken', count(*) FROM retweets WHERE tweet_id NOT IN (SELECT tweet_id FROM roots)""",
    "topk_words": CHAINS + f""", words AS (
          SELECT k.rank, unnest({tokens_sql('r.text')}) AS word FROM ranked k JOIN regular r ON r.tweet_id = k.root_id),
        per_cut AS (SELECT c.cut, w.word FROM words w JOIN (VALUES (10), (20), (50), (100)) c(cut) ON w.rank <= c.cut),
        counts AS (SELECT cut, word, count(*) AS n FROM per_cut GROUP BY cut, word)
        SELECT cut, word, n FROM counts
        QUALIFY row_number() OVER (PARTITION BY cut ORDER BY n DESC, word) <= 20""",
    "site_top20": CHAINS + f""", u AS (
          SELECT unnest({split_sql('r.expanded_urls', lower=False)}) AS url
          FROM ranked k JOIN regular r ON r.tweet_id = k.root_id),
        s AS (SELECT {site_sql('url')} AS site FROM u)
        SELECT site, count(*) AS n FROM s WHERE site IS NOT NULL GROUP BY site ORDER BY n DESC, site LIMIT 20""",
    "bot_share": CHAINS + """, scores AS (SELECT CAST(doc_id AS VARCHAR) AS author_id, CAST(toxic AS DOUBLE) AS score FROM labels)
        SELECT o.root_id, round(sum(CASE WHEN s.score > 0.5 THEN 1 ELSE 0 END) / count(*), 6) AS bot_share
        FROM roots o JOIN ranked k ON k.root_id = o.root_id
        JOIN retweets t ON t.tweet_id = o.tweet_id
        LEFT JOIN scores s ON s.author_id = t.author_id
        GROUP BY o.root_id""",
    "ingest_closure": f"""WITH RECURSIVE arch AS (
          SELECT CAST(conv_id * 100 + turn AS VARCHAR) AS tweet_id,
                 CASE WHEN turn = 0 THEN NULL ELSE {PARENT} END AS parent_tweet_id,
                 CASE WHEN turn = 0 THEN 'regular' WHEN turn % 3 = 1 THEN 'reply' ELSE 'retweet' END AS kind
          FROM conversations),
        seeds AS (SELECT CAST(conv_id * 100 + max(turn) AS VARCHAR) AS tweet_id FROM conversations GROUP BY conv_id),
        walk(fid, phase) AS (
          SELECT tweet_id, 'R' FROM seeds
          UNION
          SELECT a.parent_tweet_id, CASE WHEN a.kind = 'reply' THEN 'P' ELSE 'R' END
          FROM walk w JOIN arch a ON a.tweet_id = w.fid
          WHERE a.parent_tweet_id IS NOT NULL
            AND (a.kind = 'reply' OR (w.phase = 'R' AND a.kind = 'retweet')))
        SELECT DISTINCT a.tweet_id,
               CASE WHEN a.kind = 'regular' THEN 'regular' ELSE 'retweets' END AS saved_to
        FROM walk w JOIN arch a ON a.tweet_id = w.fid
        WHERE a.kind = 'regular' OR (w.phase = 'R' AND a.kind = 'retweet')""",
}


V2_URLS = ("CASE WHEN expanded_urls <> '' THEN expanded_urls || CASE WHEN doc_id % 2 = 0 "
           "THEN ',' || expanded_urls || '#u' ELSE '' END ELSE '' END")
V1_TIME = "strftime(created_at, '%a %b %d %H:%M:%S +0000 %Y')"
MEDIA = f"""{TWEETS}, m AS (
  SELECT tweet_id, doc_id, expanded_urls, doc_id % 4 AS k,
         CASE WHEN doc_id % 8 = 1 THEN NULL ELSE (doc_id % 3 + 1) * 100000 END AS b1,
         CASE WHEN doc_id % 8 = 1 THEN NULL WHEN doc_id % 8 = 0 THEN (doc_id % 3 + 1) * 100000
              ELSE (doc_id % 2 + 1) * 150000 END AS b2
  FROM tweets),
media AS (
  SELECT tweet_id, k,
         CASE k WHEN 0 THEN 'video' WHEN 1 THEN 'animated_gif' WHEN 2 THEN 'photo' ELSE 'other' END AS media_type,
         CASE WHEN k = 2 THEN 'https://img.example/' || doc_id || '.jpg'
              WHEN k = 3 THEN expanded_urls
              WHEN b2 >= b1 THEN 'https://video.example/' || doc_id || '/b.mp4'
              ELSE 'https://video.example/' || doc_id || '/a.mp4' END AS media_url
  FROM m WHERE (k <= 1 AND b1 IS NOT NULL) OR k = 2 OR (k = 3 AND expanded_urls <> ''))"""

ORACLE.update({
    "parse_v1": f"""WITH {TWEETS} SELECT tweet_id,
        substring(text, doc_id % 5 + 1, length(text) - doc_id % 5) AS full_text,
        {V1_TIME} AS created_at, lang AS language, hashtags_str, mentions_str,
        like_count AS favorite_count, retweet_count FROM tweets""",
    "parse_retweet_v1": f"""WITH {TWEETS} SELECT kind = 'retweet' AS is_retweet, tweet_id, author_id,
        {V1_TIME} AS created_at,
        CASE WHEN kind = 'retweet' THEN CAST(doc_id - 1 AS VARCHAR) ELSE '' END AS parent_tweet_id,
        CASE WHEN kind = 'retweet' THEN CAST((doc_id - 1) % 97 AS VARCHAR) ELSE '' END AS parent_tweet_author_id,
        like_count, doc_id % 7 AS quote_count, doc_id % 3 AS reply_count, retweet_count, text FROM tweets""",
    "parse_v2_split": f"""WITH {TWEETS} SELECT tweet_id, kind, author_id,
        strftime(created_at, '%Y-%m-%dT%H:%M:%S.000Z') AS created_at, text,
        CASE WHEN kind <> 'regular' THEN CAST(doc_id - 1 AS VARCHAR) END AS parent_tweet_id,
        CASE WHEN kind = 'retweet' THEN CAST((doc_id - 1) % 97 AS VARCHAR) END AS parent_tweet_author_id,
        CASE WHEN kind = 'regular' THEN {V2_URLS} END AS expanded_urls,
        CASE WHEN kind = 'regular' THEN hashtags_str END AS hashtags_str,
        CASE WHEN kind = 'regular' THEN mentions_str END AS mentions_str,
        like_count, doc_id % 7 AS quote_count, doc_id % 3 AS reply_count, retweet_count
        FROM tweets WHERE doc_id % 11 <> 0 AND NOT (kind = 'retweet' AND doc_id % 20 = 18)""",
    "rejects": f"""WITH {TWEETS} SELECT status, count(*) AS n FROM (
        SELECT CASE WHEN doc_id % 11 = 0 THEN 'malformed'
                    WHEN kind = 'retweet' AND doc_id % 20 = 18 THEN 'parent not included'
                    ELSE 'valid' END AS status FROM tweets) GROUP BY status""",
    "media_best_variant": f"WITH {MEDIA} SELECT tweet_id, media_type, media_url FROM media",
    "media_counts": f"""WITH {MEDIA} SELECT CASE k WHEN 0 THEN 'videos' WHEN 1 THEN 'gifs'
        WHEN 2 THEN 'images' ELSE 'externals' END AS "table", count(*) AS n FROM media GROUP BY 1""",
    "join_entities": f"""WITH {TWEETS} SELECT tweet_id, {V2_URLS} AS expanded_urls, hashtags_str, mentions_str
        FROM tweets WHERE doc_id % 11 <> 0""",
})

ORACLE.update({
    "articles_roundtrip": f"""WITH {ARTICLES} SELECT source, title, content, raw_date AS publishedAt, url
        FROM ai""",
    "id_files_month": f"WITH {TWEETS} SELECT strftime(created_at, '%Y-%m') AS month, tweet_id FROM tweets",
    "month_union": f"WITH {TWEETS} SELECT tweet_id FROM tweets WHERE strftime(created_at, '%Y-%m') = '2024-01'",
})

_NAV_LAST = f"regexp_extract_all({inner_sql('html', 'nav')}, 'href=\"([^\"]+)\"', 1)[-1]"
ORACLE.update({
    "next_link": f"""SELECT page_id, CASE WHEN starts_with(l, '/') AND NOT starts_with(l, '//')
          THEN regexp_replace({site_sql('url')}, '/$', '') || l ELSE l END AS next_url
        FROM (SELECT page_id, url, {_NAV_LAST} AS l FROM pages)""",
})

ORACLE.update({
    "stream_ingest": """SELECT CAST(event_id AS VARCHAR) AS tweet_id,
        CASE WHEN event_type = 'view' THEN 'retweets' ELSE 'regular' END AS saved_to
        FROM events WHERE event_type <> 'error'""",
    "stream_dedup": "SELECT user_id, arg_min(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id",
    "stream_daily": "SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1",
    "stream_update": ORACLE["update_stats"],
})

ORACLE.update({
    "stream_json_ingest": f"""WITH {TWEETS} SELECT tweet_id,
        CASE WHEN kind = 'retweet' THEN 'retweets' ELSE 'regular' END AS saved_to
        FROM tweets WHERE doc_id % 11 <> 0 AND kind <> 'reply' AND NOT (kind = 'retweet' AND doc_id % 20 = 18)""",
})

ORACLE["stream_closure"] = ORACLE["ingest_closure"].replace(
    "seeds AS (SELECT CAST(conv_id * 100 + max(turn) AS VARCHAR) AS tweet_id FROM conversations GROUP BY conv_id)",
    "seeds AS (SELECT CAST(conv_id * 100 + turn AS VARCHAR) AS tweet_id FROM conversations)")
assert ORACLE["stream_closure"] != ORACLE["ingest_closure"]


def _raw_text_sql(x: str) -> str:
    """Text of an HTML fragment as a tag walker sees it: tags dropped,
    references decoded, nothing trimmed."""
    return decode_sql(f"regexp_replace({x}, {_q(r'<[^>]*>')}, '', 'g')")


_ART = inner_sql("html", "article")
_NAV_HREFS = f"regexp_extract_all({inner_sql('html', 'nav')}, 'href=\"([^\"]+)\"', 1)"
_PIECES = f"(string_split_regex({_ART}, {_q(r'<p(\s[^>]*)?>')}))[2:]"
ORACLE["page_rules"] = f"""SELECT page_id, 'generic' AS site,
    {_raw_text_sql(inner_sql('html', 'h1'))} AS title,
    array_to_string(list_transform({_PIECES}, lambda s: {_raw_text_sql("split_part(s, '</p>', 1)")}), chr(10)) AS content,
    {_NAV_HREFS}[-1] AS next_href,
    CAST(len({_NAV_HREFS}) AS INTEGER) AS n_items
  FROM pages"""

ORACLE["retweet_search"] = f"""WITH {TWEETS} SELECT tweet_id, author_id,
    CAST(doc_id - 1 AS VARCHAR) AS parent_tweet_id, CAST((doc_id - 1) % 97 AS VARCHAR) AS parent_tweet_author_id
  FROM tweets WHERE kind = 'retweet'
   AND created_at >= TIMESTAMP '{cat.RT_START}' AND created_at < TIMESTAMP '{cat.RT_END}'
   AND doc_id NOT IN (SELECT doc_id FROM labels)"""


def _hashtag_search() -> str:
    parts = []
    for name, tags in cat.HASHTAG_TABLES.items():
        have = split_sql("hashtags_str")
        arr = "[" + ", ".join(_q(t.lower()) for t in tags) + "]"
        parts.append(f"""SELECT '{name}' AS "table", tweet_id FROM (
            SELECT tweet_id, (row_number() OVER (PARTITION BY CAST(created_at AS DATE)
                   ORDER BY created_at DESC, tweet_id DESC) - 1) // {cat.SEARCH_PAGE} AS page
            FROM tweets WHERE lang = 'en' AND list_has_all({have}, {arr}))
          WHERE page * {cat.SEARCH_PAGE} < {cat.SEARCH_PER_DAY}""")
    return f"WITH {TWEETS} " + " UNION ALL ".join(parts)


ORACLE["hashtag_search"] = _hashtag_search()

ORACLE["retweet_text_update"] = f"""WITH {RETWEETS}
SELECT r.tweet_id, r.author_id, r.parent_tweet_id, c.text
FROM retweets r LEFT JOIN conversations c ON CAST(c.conv_id * 100 + c.turn AS VARCHAR) = r.tweet_id"""

ORACLE["stream_daily_closed"] = """SELECT strftime(d, '%Y-%m-%d') AS day, count(*) AS n
FROM (SELECT CAST(ts AS DATE) AS d FROM events)
GROUP BY d HAVING CAST(d AS TIMESTAMP) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY"""

ORACLE["stream_late_arrivals"] = """SELECT event_id FROM events WHERE event_type NOT IN ('error', 'signup')
UNION ALL
SELECT event_id FROM events WHERE event_type IN ('error', 'signup')
  AND ts >= (SELECT max(ts) FROM events WHERE event_type NOT IN ('error', 'signup')) - INTERVAL 7 DAY"""

ORACLE["listing_links"] = f"""WITH h AS (
    SELECT url, unnest({_NAV_HREFS}) AS href FROM pages)
  SELECT DISTINCT CASE WHEN starts_with(href, '/') AND NOT starts_with(href, '//')
                       THEN regexp_replace({site_sql('url')}, '/$', '') || href ELSE href END AS link
  FROM h"""

ORACLE["take_while_sorted_spread"] = ORACLE["take_while_sorted"]

LISTING_WALK = """pager AS (SELECT page_id, html, 'https://lists.example/list/' || page_id AS url, 'https://lists.example/list/' ||
    CASE WHEN page_id % 40 <> 39 THEN page_id + 1 WHEN page_id // 40 % 3 = 1 THEN page_id - 17
         WHEN page_id // 40 % 3 = 2 THEN page_id + 10000000 END AS next_url FROM pages),
  starts AS (SELECT 'https://lists.example/list/' || (page_id + CASE WHEN page_id % 400 = 25 THEN 10000000 ELSE 0 END) AS url
             FROM pages WHERE page_id % 40 IN (0, 25)),
  steps(start, pos, url, met) AS (
    SELECT s.url, CAST(0 AS BIGINT), s.url, [s.url] FROM starts s JOIN pager p ON p.url = s.url
    UNION ALL
    SELECT w.start, w.pos + 1, n.url, list_append(w.met, n.url)
    FROM steps w JOIN pager p ON p.url = w.url JOIN pager n ON n.url = p.next_url
    WHERE NOT list_contains(w.met, n.url))"""
ORACLE["listing_walk"] = f"WITH RECURSIVE {LISTING_WALK} SELECT start, pos, url FROM steps"
ORACLE["listing_walk_links"] = f"""WITH RECURSIVE {LISTING_WALK},
  hrefs AS (SELECT url, unnest({_NAV_HREFS}) AS href, generate_subscripts({_NAV_HREFS}, 1) - 1 AS i FROM pager),
  links AS (SELECT url, i, CASE WHEN starts_with(href, '/') AND NOT starts_with(href, '//') THEN 'https://lists.example' || href
                                ELSE href END AS link FROM hrefs)
  SELECT start, link, pos, CAST(i AS INTEGER) AS link_pos
  FROM (SELECT start, link, pos, i, row_number() OVER (PARTITION BY start, link ORDER BY pos, i) AS k FROM steps JOIN links USING (url))
  WHERE k = 1"""

# kept up by streams: equal to the whole tables at once
ORACLE["stream_roots"] = ORACLE["retweet_roots"]
ORACLE["stream_root_counts"] = ORACLE["retweets_per_root"]
ORACLE["indexed_closure"] = ORACLE["ingest_closure"]
ORACLE["stream_walks"] = ORACLE["stream_closure"]
ORACLE["stream_rejects"] = ORACLE["rejects"]
ORACLE["hydrate_slices"] = ORACLE["hydrate"]
ORACLE["stream_first_links"] = f"""WITH h AS (SELECT page_id, url, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS href FROM pages),
  l AS (SELECT page_id, CASE WHEN starts_with(href, '/') AND NOT starts_with(href, '//')
                             THEN regexp_replace({site_sql('url')}, '/$', '') || href ELSE href END AS link FROM h)
  SELECT link, arg_min(page_id, (page_id % 3, page_id)) AS page_id FROM l WHERE link IS NOT NULL GROUP BY link"""
