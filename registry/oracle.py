"""The registered queries as DuckDB SQL, put together from named steps."""

from __future__ import annotations

from registry.raw import POST_ORDER, raw_sql

# Settings both sides share.
TERMS = 5000
PASSES = 20
MANY_PASSES = 60
BULL = ("the", "of", "la")
BEAR = ("and", "to", "de")
URGENT = ("in", "is", "un")
WEIGHTS = {"polarity": 0.4, "engagement": 0.3}
REPLICATES = 200

# Fixed values, written out here once more so that a wrong table in the library shows.
BULL_WORDS = ("buy", "bull", "long", "breakout", "rally", "support", "up", "green", "accumulate", "entry")
BEAR_WORDS = ("sell", "bear", "short", "breakdown", "resistance", "down", "red", "exit", "dump")
URGENCY_WORDS = ("now", "today", "alert", "immediate", "intraday", "urgent", "live")
DEFAULT_WEIGHTS = {"polarity": 0.4, "engagement": 0.3, "svd_1": 0.3}
LEHMER_PRIME, LEHMER_FACTOR = 2147483647, 48271
POISSON_STEPS = (
    790015083, 1580030167, 1975037709, 2106706890, 2139624185, 2146207644,
    2147304887, 2147461637, 2147481230, 2147483407, 2147483625, 2147483645,
)

_BLANKS = (
    r"[\x{00}-\x{20}\x{7f}-\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)
_ORDER = ", ".join(POST_ORDER)


def norm(x: str) -> str:
    return f"trim(regexp_replace(nfc_normalize(coalesce({x}, '')), '{_BLANKS}', ' ', 'g'))"


def split_list(x: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({norm(x)}), '[,\\s]+'), lambda i: i <> '')"


def tags(content: str, given: str, sigil: str) -> str:
    found = f"list_transform(regexp_extract_all({content}, '{sigil}[\\p{{L}}\\p{{N}}_]+'), lambda t: lower(t))"
    return f"list_sort(list_distinct(list_concat({given}, {found})))"


def whole_number(x: str) -> str:
    bare = rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"
    return (
        f"case when regexp_full_match({bare}, '[+-]?[0-9]+') "
        f"then coalesce(try_cast({bare} as bigint), 0) else 0 end"
    )


_TIMES = "'%Y/%m/%d %H:%M', '%m/%d/%Y %I:%M %p', '%m/%d/%Y', '%d/%m/%Y', '%B %d, %Y'"


def utc(x: str) -> str:
    bare = f"regexp_replace({x}, '([+-][0-9]{{2}}:[0-9]{{2}}|Z)$', '')"
    hours = f"coalesce(try_cast(nullif(regexp_extract({x}, '([+-][0-9]{{2}}):[0-9]{{2}}$', 1), '') as bigint), 0)"
    return f"coalesce(try_cast({bare} as timestamp) - to_hours({hours}), try_strptime({x}, [{_TIMES}]))"


def shown(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S.%f')"


def printed(ts: str) -> str:
    return (
        f"coalesce(strftime({ts}, '%Y-%m-%d %H:%M:%S') || case when epoch_us({ts}) % 1000000 = 0 "
        f"then '' else strftime({ts}, '.%f') end || '+00:00', 'NaT')"
    )


def hits(words: str, lex) -> str:
    listed = ", ".join(f"'{w}'" for w in lex)
    return f"len(list_filter({words}, lambda w: w in ({listed})))"


def lexical(words: str, bull, bear, urgent) -> str:
    size = f"greatest(len({words}), 1)"
    return (
        f"({hits(words, bull)} - {hits(words, bear)}) / {size}::double as polarity, "
        f"{hits(words, urgent)} / {size}::double as urgency"
    )


def joined(items: str) -> str:
    return f"array_to_string({items}, ' ')"


def moments(source: str, columns) -> str:
    return "select " + ", ".join(
        f"avg({c}) as {c}_m, stddev_pop({c}) as {c}_s" for c in columns
    ) + f" from {source}"


def z(c: str) -> str:
    return f"(({c} - {c}_m) / case when {c}_s = 0 then 1 else {c}_s end)"


def metric(x: str) -> str:
    s = f"upper(trim({x}))"
    parts = []
    for letter, factor in (("K", 1000), ("M", 1000000), ("B", 1000000000)):
        rest = f"trim(replace(replace({s}, '{letter}', ''), ',', ''))"
        number = f"case when regexp_full_match({rest}, '[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)(E[+-]?[0-9]+)?') then {rest} end"
        parts.append(
            f"case when contains({s}, '{letter}') then try_cast(trunc(try_cast({number} as double) * {factor}) as bigint) end"
        )
    return f"coalesce({', '.join(parts)}, try_cast(nullif(regexp_replace({s}, '[^0-9]', '', 'g'), '') as bigint), 0)"


def bucket(ts: str, micros: int, origin: str = "0") -> str:
    return f"make_timestamp(epoch_us({ts}) - ((epoch_us({ts}) - {origin}) % {micros}))"


HOUR = 3_600_000_000
DAY = 24 * HOUR

STEPS = {
    "raw_posts": raw_sql("duckdb"),
    "std": f"""
select origin, post_no, copy_no, {norm('username')} as username, {norm('content')} as content,
  {norm('urls')} as urls, {whole_number('replies')} as replies, {whole_number('retweets')} as retweets,
  {whole_number('likes')} as likes, {utc('timestamp')} as timestamp, {utc('scraped_at')} as scraped_at,
  {split_list('mentions')} as given_mentions, {split_list('hashtags')} as given_hashtags,
  mentions, hashtags, source_file
from raw_posts""",
    "tagged": f"""
select *, {tags('content', 'given_mentions', '@')} as mention_list, {tags('content', 'given_hashtags', '#')} as tag_list,
  sha1(username || '|' || {printed('timestamp')} || '|' || content) as uid,
  strftime(timestamp, '%Y-%m-%d') as date
from std""",
    "clean_all": "select *, coalesce(tag_list[1], '') as hashtag_primary from tagged",
    "clean": f"""
select * from clean_all
qualify row_number() over (partition by source_file, uid order by {_ORDER}) = 1""",
    "words": """
select *, list_filter(string_split(lower(content), ' '), lambda w: w <> '') as w
from clean where timestamp is not null and content is not null""",
    "scores": f"""
select *, {lexical('w', BULL_WORDS, BEAR_WORDS, URGENCY_WORDS)},
  ln(1 + likes + retweets + replies) as engagement
from words""",
    "moments": moments("scores", WEIGHTS),
    "composite": f"""
select *, {' + '.join(f'{w} * {z(c)}' for c, w in WEIGHTS.items())} as composite_signal
from scores, moments""",
    "doc_texts": "select doc_id, text from documents",
    "tokens": r"select *, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') as t from {texts}",
    "grams": """
select {keys}, unnest(t) as term from tokens
union all
select {keys}, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) from tokens""",
    "vocabulary": f"""
select term, row_number() over (order by n desc, term) - 1 as term_id
from (select term, count(*) as n from grams group by term order by n desc, term limit {TERMS})""",
    "counts": "select {keys}, term, term_id, count(*) as tf from grams join vocabulary using (term) group by all",
    "idf": """
select term_id, ln((1 + (select count(*) from {texts})) / (1 + count(*))::double) + 1 as idf
from counts group by term_id""",
    "weights": """
select {keys}, term, term_id, tf, tf * idf / sqrt(sum((tf * idf) * (tf * idf)) over (partition by {keys})) as w
from counts join idf using (term_id)""",
}


def power_steps(passes: int) -> dict[str, str]:
    """Repeated multiplication with the Gram matrix, one step per pass."""
    steps = {"v0": "select term_id, 1 / sqrt((select count(*) from vocabulary)) as v from vocabulary"}
    for i in range(passes):
        steps[f"z{i}"] = f"""
select term_id, sum(w * y) as x from weights join (
  select {{keys}}, sum(w * v) as y from weights join v{i} using (term_id) group by {{keys}}) using ({{keys}})
group by term_id"""
        steps[f"v{i + 1}"] = f"select term_id, x / (select sqrt(sum(x * x)) from z{i}) as v from z{i}"
    return steps


TEXT_STEPS = ("tokens", "grams", "vocabulary", "counts", "idf", "weights")


def query(final: str, *names: str, extra: dict[str, str] | None = None, **values: str) -> str:
    """WITH the named steps in order, then the final select."""
    steps = {name: STEPS[name] for name in names}
    steps.update(extra or {})
    parts = []
    for name, sql in steps.items():
        for key, value in values.items():
            sql = sql.replace("{" + key + "}", value)
        parts.append(f"{name} as materialized ({sql.strip()})")
    for key, value in values.items():
        final = final.replace("{" + key + "}", value)
    return ("with " + ",\n".join(parts) + "\n" if parts else "") + final.strip()


CLEAN_STEPS = ("raw_posts", "std", "tagged", "clean_all", "clean")
SCORE_STEPS = (*CLEAN_STEPS, "words", "scores")
SIGNAL_STEPS = (*SCORE_STEPS, "moments", "composite")


def clean_columns() -> str:
    return f"""origin, post_no, uid, username, {shown('timestamp')} as timestamp, md5(content) as content_md5,
  replies, retweets, likes, {joined('mention_list')} as mentions_list, {joined('tag_list')} as hashtags_list,
  urls, {shown('scraped_at')} as scraped_at, hashtag_primary, date, mentions, hashtags, source_file"""


def poisson_case(draw: str) -> str:
    whens = " ".join(f"when {draw} <= {step} then {k}" for k, step in enumerate(POISSON_STEPS))
    return f"case {whens} else {len(POISSON_STEPS)} end"


def bootstrap_steps(source: str, groups: str, key: str, value: str) -> dict[str, str]:
    p, factors, factor = LEHMER_PRIME, [], 1
    for _ in range(REPLICATES):
        factor = factor * LEHMER_FACTOR % p
        factors.append(factor)
    factors = ", ".join(map(str, factors))
    return {
        "seeded": f"select {groups}, {value} as x, ('0x' || substr(md5({key}), 1, 8))::bigint % {p - 1} + 1 as seed from {source}",
        "factors": f"select unnest([{factors}]) as f, unnest(range({REPLICATES})) as b",
        "drawn": f"select {groups}, b, x, {poisson_case(f'(seed * f % {p})')} as w from seeded, factors",
        "replicates": f"select {groups}, b, sum(w * x) / sum(w) as mean from drawn group by {groups}, b having sum(w) > 0",
        "ends": f"select {groups}, quantile_cont(mean, 0.025) as ci_lo, quantile_cont(mean, 0.975) as ci_hi from replicates group by {groups}",
    }


SPLITS = 8
RESAMPLE_BLOCK = 16


def resample_steps(source: str, order: str, value: str, block: int) -> dict[str, str]:
    """Fixed-n draws per ``bucket``: counts per block down a tree of up to 2 ** SPLITS blocks, then rows inside blocks."""
    p = LEHMER_PRIME
    md5 = "('0x' || substr(md5(concat_ws('|', {})), 1, {}))::bigint"
    steps = {
        "placed": f"select bucket, {value} as x, row_number() over (partition by bucket order by {order}) - 1 as i, count(*) over (partition by bucket) as n from {source}",
        "t0": f"select bucket, epoch_us(bucket) as label, n, b, 0::bigint as lo, ceil(n / {float(block)})::bigint as hi, n as k from (select distinct bucket, n from placed), range({REPLICATES}) r(b)",
    }
    for level in range(SPLITS):
        steps[f"s{level}"] = f"""
select *, (lo + hi) // 2 as mid, ((lo + hi) // 2 - lo) * {float(block)} / (least(hi * {block}, n) - lo * {block}) as p,
  {md5.format("'split', label, lo, hi, b", 13)} / 4503599627370496.0::double as u from t{level} where hi - lo > 1"""
        steps[f"c{level}"] = f"""
select bucket, b, lo, count(*) filter (below <= u) as x from (
  select *, sum(exp(lgamma(k + 1) - lgamma(j + 1) - lgamma(k - j + 1) + j * ln(p) + (k - j) * ln(1 - p)))
    over (partition by bucket, b, lo order by j) as below
  from (select *, unnest(range(k)) as j from s{level})) group by bucket, b, lo"""
        steps[f"t{level + 1}"] = f"""
select bucket, label, n, b, lo, hi, k from t{level} where hi - lo <= 1
union all select bucket, label, n, b, lo, mid, coalesce(x, 0) from s{level} left join c{level} using (bucket, b, lo)
union all select bucket, label, n, b, mid, hi, k - coalesce(x, 0) from s{level} left join c{level} using (bucket, b, lo)"""
    powers = f"""
with recursive f(j, v) as (select 0::bigint, {LEHMER_FACTOR}::bigint
  union all select j + 1, v * {LEHMER_FACTOR} % {p} from f where j < (select max(k) from t{SPLITS}))
select j, v from f"""
    steps |= {
        "powers": powers,
        "drawn": f"""
select bucket, b, lo * {block} + seed * v % {p} * (least((lo + 1) * {block}, n) - lo * {block}) // {p} as i
from (select *, {md5.format("'draw', label, lo, b", 8)} % {p - 1} + 1 as seed from t{SPLITS}) join powers on j < k""",
        "replicates": "select bucket, b, avg(x) as mean, count(*) as w from drawn join placed using (bucket, i) group by bucket, b",
        "ends": "select bucket, quantile_cont(mean, 0.025) as ci_lo, quantile_cont(mean, 0.975) as ci_hi, min(w) as w_lo, max(w) as w_hi from replicates group by bucket",
    }
    return steps


def spine(source: str, micros: int) -> str:
    return f"""select unnest(generate_series(min(bucket), max(bucket), to_microseconds({micros}))) as bucket from {source}"""


def r(x: str, digits: int = 9) -> str:
    return f"round({x}, {digits})"
