"""SQL fragments used by several comparison queries (DuckDB dialect)."""

from __future__ import annotations

from freshet.functions.text import BLANK_CLASS, NEGATIVE_WORDS, POSITIVE_WORDS
from freshet.operators.keyword import STOP_WORDS

# The common event shape.
EV = """
b AS (SELECT *, 0 AS replay FROM events
      UNION ALL SELECT *, 1 AS replay FROM events WHERE event_id % 20 = 0),
ev AS (SELECT 'events' AS kafka_topic, CAST(user_id % 3 AS INT) AS kafka_partition, event_id AS kafka_offset,
  event_id * 2 + replay AS ord,
  CASE event_type WHEN 'view' THEN 'edit' WHEN 'click' THEN 'edit' WHEN 'purchase' THEN 'new'
       WHEN 'signup' THEN 'log' ELSE 'categorize' END AS type,
  CASE user_id % 4 WHEN 0 THEN 'enwiki' WHEN 1 THEN 'frwiki' WHEN 2 THEN 'wikidatawiki' ELSE '' END AS wiki,
  CASE WHEN event_id % 9 = 0 THEN NULL ELSE 'h' || CAST(user_id % 4 AS VARCHAR) || '.example.org' END AS server_name,
  CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 5 = 0 THEN 1 ELSE 0 END AS namespace,
  'Page ' || CAST(event_id % 200 AS VARCHAR) AS title,
  CASE WHEN event_id % 6 = 0 THEN NULL
       ELSE 'https://h.example.org/wiki/Page_' || CAST(event_id % 200 AS VARCHAR) END AS title_url,
  'user' || CAST(user_id AS VARCHAR) AS user_name,
  CASE WHEN event_id % 17 = 0 THEN NULL ELSE user_id % 10 = 0 END AS bot,
  event_id % 2 = 0 AS minor,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE '  changed  <b>' || props || '</b>&amp; more ' END AS parsedcomment,
  CASE WHEN event_id % 14 = 3 THEN NULL ELSE ' plain' || chr(160) || ' note ' || props || ' ' END AS raw_comment,
  CASE WHEN event_id % 4 = 0 THEN 'https://h.example.org/w/index.php?diff=' || CAST(event_id AS VARCHAR) END AS notify_url,
  CASE WHEN event_id % 8 = 6 THEN NULL ELSE ' https://h.example.org/uri/' || CAST(event_id % 200 AS VARCHAR) END AS meta_uri,
  CAST(floor(epoch(ts)) AS BIGINT) AS ts_epoch,
  CASE WHEN replay = 1 THEN event_id ELSE event_id - 1 END AS rev_old, event_id AS rev_new,
  CAST(floor(value * 10) AS INT) AS bytes_old,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(floor(value * 10) AS INT) + 5 END AS bytes_new
FROM b)
"""

KEEP = """type IN ('edit', 'new') AND coalesce(namespace = 0, true) AND NOT coalesce(bot, false)
  AND trim(coalesce(user_name, '')) NOT IN ('MediaWiki message delivery', 'InternetArchiveBot', 'JJMC89 bot III')"""


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{BLANK_CLASS}]+|[{BLANK_CLASS}]+$', '', 'g')"


def rstrip(x: str) -> str:
    return f"regexp_replace({x}, '[{BLANK_CLASS}]+$', '', 'g')"


def drop_tags(x: str) -> str:
    return f"regexp_replace({x}, '<[^>]+>', ' ', 'g')"


def unescape(x: str, extra: tuple[tuple[str, str], ...] = ()) -> str:
    for name, char in (*extra, ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        x = f"replace({x}, '{name}', '{char}')"
    return x


def normalize(x: str) -> str:
    return f"trim(regexp_replace(translate({x}, '‎‏', '  '), '[{BLANK_CLASS}]+', ' ', 'g'))"


def truncate(x: str, n: int) -> str:
    cut = rstrip(f"left({x}, {n - 1})")
    return f"CASE WHEN length({x}) > {n} THEN {cut} || '…' ELSE {x} END"


COMMENT = f"CASE WHEN parsedcomment IS NULL THEN {normalize("coalesce(raw_comment, '')")} ELSE {normalize(unescape(drop_tags('parsedcomment')))} END"


def content(comment: str = COMMENT) -> str:
    return f"""concat_ws(chr(10), 'Title: ' || title, 'Type: ' || type,
      'Wiki: ' || wiki || coalesce(' (' || server_name || ')', ''),
      CASE WHEN {comment} <> '' THEN 'Comment: ' || {comment} END, 'Diff: ' || notify_url,
      CASE WHEN rev_old <> 0 OR rev_new <> 0 THEN
        'Revision: ' || coalesce(CAST(rev_old AS VARCHAR), 'None') || ' -> ' || coalesce(CAST(rev_new AS VARCHAR), 'None') END,
      CASE WHEN bytes_old IS NOT NULL AND bytes_new IS NOT NULL THEN
        'Bytes: ' || CAST(bytes_old AS VARCHAR) || ' -> ' || CAST(bytes_new AS VARCHAR) END)"""


KV = """concat_ws(' | ', 'type=' || coalesce(type, 'None'), 'wiki=' || coalesce(wiki, 'None'), 'title=' || coalesce(title, 'None'),
      'user=' || coalesce(user_name, 'None'), 'bot=' || CASE WHEN bot THEN 'True' WHEN NOT bot THEN 'False' ELSE 'None' END,
      'comment=' || raw_comment,
      'server=' || server_name, CASE WHEN ts_epoch <> 0 THEN 'timestamp=' || CAST(ts_epoch AS VARCHAR) END)"""


def sha1_key(source: str, title: str, url: str, text: str) -> str:
    part = lambda x: strip(f"coalesce({x}, '')")
    return (
        f"sha1('v1|src=' || {part(source)} || '|url=' || {part(url)} || '|title=' || {part(title)}"
        f" || '|content_sha1=' || sha1({text}))"
    )


def surrogate(*parts: str) -> str:
    tagged = ", ".join(f"coalesce('=' || CAST({p} AS VARCHAR), '~')" for p in parts)
    return f"CAST('0x' || left(sha1(concat_ws('|', {tagged})), 15) AS BIGINT)"


def sentiment(x: str) -> str:
    pos = " + ".join(f"CAST(contains(lower({x}), '{w}') AS INT)" for w in POSITIVE_WORDS)
    neg = " + ".join(f"CAST(contains(lower({x}), '{w}') AS INT)" for w in NEGATIVE_WORDS)
    return f"((({pos}) - ({neg})) * 1.0 / greatest(1, ({pos}) + ({neg})))"


def chunks(table: str, key: str, text: str, size: int, overlap: int) -> str:
    """CTEs ending in ``ch(key, chunk_index, chunk_text)``."""
    step = size - overlap
    piece = strip(f"substring(t, s * {step} + 1, {size})")
    return f"""
body AS (SELECT {key}, {strip(text)} AS t FROM {table}),
starts AS (SELECT {key}, t, unnest(range(0, 1 + CAST(ceil(greatest(length(t) - {size}, 0) / {float(step)}) AS INT))) AS s
           FROM body WHERE t <> ''),
pieces AS (SELECT {key}, s, {piece} AS chunk_text FROM starts),
ch AS (SELECT {key}, row_number() OVER (PARTITION BY {key} ORDER BY s) - 1 AS chunk_index, chunk_text
       FROM pieces WHERE chunk_text <> '')"""


WORDS = r"[\p{L}\p{N}_]+"
STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)


def hash_vectors(name: str, table: str, key: str, text: str, dims: int = 64) -> str:
    """CTEs ending in ``name(key, v)``, the word-hash vector of every text."""
    return f"""
{name}_words AS (SELECT {key}, unnest(regexp_extract_all(lower({text}), '{WORDS}')) AS w FROM {table}),
{name}_hash AS (SELECT {key}, CAST('0x' || left(sha1(w), 8) AS BIGINT) AS h FROM {name}_words),
{name}_sum AS (SELECT {key}, h % {dims} AS bucket, sum(CASE WHEN (h // {dims}) % 2 = 0 THEN 1 ELSE -1 END) AS s
               FROM {name}_hash GROUP BY ALL),
{name}_all AS (SELECT t.{key}, r.bucket, coalesce(CAST(s.s AS DOUBLE), 0.0) AS s
               FROM {table} t CROSS JOIN (SELECT unnest(range(0, {dims})) AS bucket) r
               LEFT JOIN {name}_sum s ON s.{key} = t.{key} AND s.bucket = r.bucket),
{name} AS (SELECT {key}, list(s / len ORDER BY bucket) AS v FROM
            (SELECT *, coalesce(nullif(sqrt(sum(s * s) OVER (PARTITION BY {key})), 0), 1) AS len FROM {name}_all) GROUP BY {key})"""
