"""Raw posts derived from whole tables, as one SQL text for both engines.

Every event, document and conversation turn is a post with its whole text. The
tables hold no tags and no words of the lexicons, so a few are put in front.
Posts of some kinds were seen by a second crawl and come twice, with one more like.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import configure, spread, stored_bytes

_DIALECTS = {
    "spark": {"S": "string", "MICROS": "timestamp_micros", "EXPLODE": "explode", "SERIES": "sequence"},
    "duckdb": {"S": "varchar", "MICROS": "make_timestamp", "EXPLODE": "unnest", "SERIES": "generate_series"},
}

_LEAD = """case {id} % 12 when 0 then 'Buy now' when 1 then 'SELL' when 2 then 'breakout rally today'
      when 3 then 'dump exit' when 4 then 'buy!' when 5 then 'support up' when 6 then 'resistance down live'
      when 7 then 'bull bull bear' when 8 then 'urgent alert' when 9 then '' when 10 then 'green red' else 'hold' end"""

RAW_POSTS = """
with authored as (
  select 'event' as origin, event_id as post_no, event_type as kind, user_id as person,
    cast(floor(value) as bigint) as liked, concat('user_', cast(user_id as {S})) as username,
    cast(ts as timestamp) as made,
    concat(""" + _LEAD.format(id="event_id") + """, ' ', event_type, ' #Tag', cast(event_id % 7 as {S}),
      ' #caf', chr(233), ' @user_', cast(user_id + 1 as {S}), '  ', props) as content
  from events
  union all
  select 'document', doc_id, lang, length(source), n_chars, concat('user_', source),
    {MICROS}(1704067200000000 + (doc_id % 4320) * 600000000),
    concat(""" + _LEAD.format(id="doc_id") + """, ' ', text, ' #', lang, ' #', source)
  from documents
  union all
  select 'turn', conv_id * 1000 + turn, role, turn, conv_id % 40,
    concat(role, '_', cast(conv_id % 50 as {S})),
    {MICROS}(1704067200000000 + (conv_id % 720) * 3600000000 + turn * 60000000),
    concat(""" + _LEAD.format(id="(conv_id + turn)") + """, chr(10), text, ' #Talk @', role)
  from conversations
), crawled as (
  select *, {EXPLODE}({SERIES}(0, case when kind in ('click', 'de', 'user') then 1 else 0 end)) as copy_no
  from authored
)
select origin, post_no, copy_no, username,
  case post_no % 17 when 0 then concat(replace(cast(made as {S}), ' ', 'T'), 'Z')
    when 1 then concat(cast(made + interval '2' hour as {S}), '+02:00')
    when 2 then 'no time' when 3 then null
    when 4 then concat(replace(substr(cast(made as {S}), 1, 10), '-', '/'), ' ', substr(cast(made as {S}), 12, 5))
    when 5 then concat(cast(month(made) as {S}), '/', cast(day(made) as {S}), '/', cast(year(made) as {S}), ' ',
      cast((hour(made) + 11) % 12 + 1 as {S}), ':', lpad(cast(minute(made) as {S}), 2, '0'),
      case when hour(made) < 12 then ' AM' else ' PM' end)
    when 6 then case when day(made) > 12
      then concat(cast(day(made) as {S}), '/', cast(month(made) as {S}), '/', cast(year(made) as {S}))
      else concat(cast(month(made) as {S}), '/', cast(day(made) as {S}), '/', cast(year(made) as {S})) end
    when 7 then concat('January ', cast(day(made) as {S}), ', ', cast(year(made) as {S}))
    else cast(made as {S}) end as timestamp,
  content,
  case when post_no % 11 = 0 then 'n/a' when post_no % 13 = 0 then '12.0' when post_no % 19 = 0 then '12.7'
    when post_no % 7 = 0 then concat(' ', cast(person % 10 as {S}), chr(9))
    else cast(person % 10 as {S}) end as replies,
  cast(post_no % 50 as {S}) as retweets,
  cast(liked + copy_no as {S}) as likes,
  case when post_no % 3 = 0 then '@Desk, @user_1' else '' end as mentions,
  case when post_no % 5 = 0 then '#Extra, #tag1' else null end as hashtags,
  case when post_no % 4 = 0 then 'https://example.org/a, https://twitter.com/b' else '' end as urls,
  cast(made + interval '1' day as {S}) as scraped_at,
  concat('part_', cast(post_no % 4 as {S}), '.json') as source_file
from crawled
"""

# What "first" means among copies of a post.
POST_ORDER = ("origin", "post_no", "copy_no")


def raw_sql(dialect: str) -> str:
    text = RAW_POSTS
    for name, value in _DIALECTS[dialect].items():
        text = text.replace("{" + name + "}", value)
    return text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    configure(spark)
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    return spread(spark.read.parquet(path), stored_bytes(spark, path))


def raw_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("events", "documents", "conversations")
    sql = raw_sql("spark")
    for name in names:
        sql = sql.replace(f"from {name}\n", f"from {{{name}}}\n")
    return spark.sql(sql, **{name: table(spark, sf_dir, name) for name in names})
