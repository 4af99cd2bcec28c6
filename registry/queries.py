"""One registered query per operator, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry import oracle as o
from registry.raw import POST_ORDER, raw_posts, table
from tidemark.functions import lexicon, text, values
from tidemark.operators import buckets, clean, dedupe, features, moments, series, summary, svd, tfidf
from tidemark.plans.display import display_series
from tidemark.plans.features import build_features, clean_scores, row_keys, run_features
from tidemark.plans.ingest import NOTE, ingest, read_clean
from tidemark.session import run_folder, spread, stage, stored_bytes
from tidemark.sources import html, posts as sources, tables
from tidemark.streaming import live

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

ID = ("origin", "post_no", "copy_no")
IDS = ", ".join(ID)
STRING = T.StringType()


def register(name: str, sql: str | None = None):
    def keep(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return keep


def shown(ts: str):
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(ts)


def joined(items: str, name: str):
    return F.array_join(items, " ").alias(name)


def r(column: str, digits: int = 9):
    return F.round(column, digits).alias(column)


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_posts(raw_posts(spark, sf), order_by=POST_ORDER)


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return clean_scores(raw_posts(spark, sf), order_by=POST_ORDER)


def composed(spark: SparkSession, sf: str) -> DataFrame:
    names = ("uid", "source_file", "timestamp", "hashtag_primary", *o.WEIGHTS)
    slim = stage(scored(spark, sf).select(*names), "scores")
    return features.composite_signal(slim, o.WEIGHTS)


def clean_view(posts: DataFrame) -> DataFrame:
    return posts.select(
        "origin", "post_no", "uid", "username", shown("timestamp"), F.md5("content").alias("content_md5"),
        "replies", "retweets", "likes", joined("_mentions_list", "mentions_list"),
        joined("_hashtags_list", "hashtags_list"), "urls", shown("scraped_at"), "hashtag_primary",
        "date", "mentions", "hashtags", "source_file",
    )


# ---- columns ---------------------------------------------------------------

_DECOMPOSED = "replace(text, chr(233), 'e\u0301')"


@register("normalized_text", f"""
select 'document' as origin, doc_id as no, md5({o.norm(_DECOMPOSED)}) as content_md5, length({o.norm(_DECOMPOSED)}) as chars from documents
union all select 'turn', conv_id * 1000 + turn, md5({o.norm(_DECOMPOSED)}), length({o.norm(_DECOMPOSED)}) from conversations""")
def normalized_text(spark, sf):
    documents = table(spark, sf, "documents").select(F.lit("document").alias("origin"), F.col("doc_id").alias("no"), "text")
    turns = table(spark, sf, "conversations").select(F.lit("turn"), F.expr("conv_id * 1000 + turn"), "text")
    every = documents.union(turns).select("origin", "no", F.expr(_DECOMPOSED).alias("text"))
    done = every.select("origin", "no", text.normalize_text(F.col("text")).alias("content"))
    return done.select("origin", "no", F.md5("content").alias("content_md5"), F.length("content").alias("chars"))


@register("parsed_lists", o.query(f"""
select {IDS}, {o.joined(o.split_list('mentions'))} as from_text,
  {o.joined(f"list_transform(list_filter([mentions, ' ', username, hashtags], lambda i: {o.norm('i')} <> ''), lambda i: lower({o.norm('i')}))")} as from_list
from raw_posts""", "raw_posts"))
def parsed_lists(spark, sf):
    raw = raw_posts(spark, sf).withColumn("items", F.array("mentions", F.lit(" "), "username", "hashtags"))
    return raw.select(
        *ID,
        F.array_join(text.parse_listish(F.col("mentions"), STRING), " ").alias("from_text"),
        F.array_join(text.parse_listish(F.col("items"), raw.schema["items"].dataType), " ").alias("from_list"),
    )


@register("hashtags_and_mentions", o.query(f"""
select {IDS}, {o.joined('tag_list')} as hashtags_list, {o.joined('mention_list')} as mentions_list from tagged""",
    "raw_posts", "std", "tagged"))
def hashtags_and_mentions(spark, sf):
    posts = clean.standardize(raw_posts(spark, sf))
    return posts.select(*ID, joined("_hashtags_list", "hashtags_list"), joined("_mentions_list", "mentions_list"))


@register("coerced_counts", o.query(f"""
select {IDS}, {o.whole_number('replies')} as replies, {o.whole_number('likes')} as likes,
  coalesce(trunc(try_cast(replies as double) * 1.5)::bigint, 0) as from_number from raw_posts""", "raw_posts"))
def coerced_counts(spark, sf):
    raw = raw_posts(spark, sf).withColumn("number", F.col("replies").try_cast("double") * 1.5)
    return raw.select(
        *ID,
        *[values.coerce_int(F.col(c), STRING).alias(c) for c in ("replies", "likes")],
        values.coerce_int(F.col("number"), T.DoubleType()).alias("from_number"),
    )


@register("utc_timestamps", o.query(f"""
select {IDS}, {o.shown(o.utc('timestamp'))} as timestamp, {o.shown(o.utc('scraped_at'))} as scraped_at,
  {o.shown('made')} as made from (select *, make_timestamp(1704067200000000 + post_no * 7) as made from raw_posts)""", "raw_posts"))
def utc_timestamps(spark, sf):
    raw = raw_posts(spark, sf).withColumn("nanos", (F.lit(1704067200000000) + F.col("post_no") * 7) * 1000 + 999)
    return raw.select(
        *ID,
        values.to_utc(F.col("timestamp"), STRING).alias("timestamp"),
        values.to_utc(F.col("scraped_at"), STRING).alias("scraped_at"),
        values.to_utc(F.col("nanos"), T.LongType()).alias("made"),
    ).select(*ID, shown("timestamp"), shown("scraped_at"), shown("made"))


@register("post_uids", o.query(f"select {IDS}, uid from tagged", "raw_posts", "std", "tagged"))
def post_uids(spark, sf):
    return clean.standardize(raw_posts(spark, sf)).select(*ID, "uid")


@register("derived_columns", o.query(f"select {IDS}, hashtag_primary, date from clean_all", "raw_posts", "std", "tagged", "clean_all"))
def derived_columns(spark, sf):
    return clean.standardize(raw_posts(spark, sf)).select(*ID, "hashtag_primary", "date")


@register("standard_schema", o.query(f"""
select 'uid,username,timestamp,content,replies,retweets,likes,_mentions_list,_hashtags_list,urls,scraped_at,hashtag_primary,date,origin,post_no,copy_no,hashtags,mentions,source_file' as layout,
  source_file, count(*) as posts, sum(likes) as likes, sum(len(urls)) as url_chars, count(mentions) as mentions
from (select *, null as mentions, '' as urls from raw_posts_less) group by source_file""", "raw_posts",
    extra={"raw_posts_less": f"select source_file, {o.whole_number('likes')} as likes from raw_posts"}))
def standard_schema(spark, sf):
    whole = clean.standardize(raw_posts(spark, sf).drop("mentions", "urls", "retweets"))
    return whole.groupBy("source_file").agg(
        F.count("*").alias("posts"), F.sum("likes").alias("likes"),
        F.sum(F.length("urls")).alias("url_chars"), F.count("mentions").alias("mentions"),
    ).withColumn("layout", F.lit(",".join(whole.columns)))


@register("clean_posts", o.query(f"select {o.clean_columns()} from clean", *o.CLEAN_STEPS))
def clean_table(spark, sf):
    return clean_view(cleaned(spark, sf))


@register("lexical_scores", o.query("select source_file, uid, round(polarity, 9) as polarity, round(urgency, 9) as urgency from scores", *o.SCORE_STEPS))
def lexical_scores(spark, sf):
    return scored(spark, sf).select("source_file", "uid", r("polarity"), r("urgency"))


@register("document_lexicon_scores", f"""
select doc_id, round(polarity, 9) as polarity, round(urgency, 9) as urgency from (
  select doc_id, {o.lexical('w', o.BULL, o.BEAR, o.URGENT)}
  from (select doc_id, list_filter(string_split(lower({o.norm('text')}), ' '), lambda w: w <> '') as w from documents))""")
def document_lexicon_scores(spark, sf):
    normal = table(spark, sf, "documents").select("doc_id", text.normalize_text(F.col("text")).alias("content"))
    done = normal.select(
        "doc_id",
        lexicon.lexicon_polarity(F.col("content"), o.BULL, o.BEAR).alias("polarity"),
        lexicon.urgency_score(F.col("content"), o.URGENT).alias("urgency"),
    )
    return done.select("doc_id", r("polarity"), r("urgency"))


@register("engagement", o.query("select source_file, uid, round(engagement, 9) as engagement from scores", *o.SCORE_STEPS))
def engagement(spark, sf):
    return features.score_reactions(clean.drop_incomplete(cleaned(spark, sf))).select("source_file", "uid", r("engagement"))


_METRIC_TEXT = """case event_id % 9 when 0 then concat({v}, 'K') when 1 then concat(' ', {v}, 'm ')
  when 2 then concat({v}, 'K replies') when 3 then {v} when 4 then '1,234' when 5 then '' when 6 then 'none'
  when 7 then concat('1,0', {v}, 'B') else concat(cast(event_id as {S}), ' likes') end"""


@register("parsed_metrics", f"""
select event_id, {o.metric('shown')} as metric from (
  select event_id, {_METRIC_TEXT.format(v='cast(value as varchar)', S='varchar')} as shown from events)""")
def parsed_metrics(spark, sf):
    shown_as = F.expr(_METRIC_TEXT.format(v="cast(value as string)", S="string"))
    return table(spark, sf, "events").select("event_id", values.parse_metric(shown_as).alias("metric"))


# ---- filters ---------------------------------------------------------------

@register("complete_rows", o.query(f"""
select origin, count(*) as posts from clean where timestamp is not null and content is not null group by origin""", *o.CLEAN_STEPS))
def complete_rows(spark, sf):
    return clean.drop_incomplete(cleaned(spark, sf)).groupBy("origin").agg(F.count("*").alias("posts"))


@register("complete_records", f"""
select doc_id, source from (select doc_id, {o.norm("case when lang = 'fr' then '' else source end")} as source,
  {o.norm("case when source = 'src3' then null else text end")} as content from documents)
where source <> '' and content <> ''""")
def complete_records(spark, sf):
    documents = table(spark, sf, "documents").select(
        "doc_id",
        text.normalize_text(F.when(F.col("lang") != "fr", F.col("source"))).alias("username"),
        text.normalize_text(F.when(F.col("source") != "src3", F.col("text"))).alias("content"),
    )
    return clean.complete_records(documents).select("doc_id", F.col("username").alias("source"))


@register("external_urls", o.query(f"""
select {IDS}, {o.joined("list_filter(string_split(urls, ', '), lambda u: regexp_matches(u, '^https?://') and not contains(u, 'twitter.com'))")} as external
from raw_posts""", "raw_posts"))
def external_urls(spark, sf):
    return raw_posts(spark, sf).select(
        *ID, F.array_join(clean.external_urls(F.split("urls", ", ")), " ").alias("external")
    )


# ---- repeats, caps, order, sampling -----------------------------------------

@register("repeats_dropped_globally", o.query(f"""
select origin, post_no, copy_no, uid from clean_all qualify row_number() over (partition by uid order by {IDS}) = 1""",
    "raw_posts", "std", "tagged", "clean_all"))
def repeats_dropped_globally(spark, sf):
    return clean.clean_posts(raw_posts(spark, sf), scope="global", order_by=POST_ORDER).select(*ID, "uid")


@register("repeats_dropped_per_file", o.query(f"select {IDS}, uid, source_file from clean", *o.CLEAN_STEPS))
def repeats_dropped_per_file(spark, sf):
    return cleaned(spark, sf).select(*ID, "uid", "source_file")


@register("same_content_dropped", """
select lang as hashtag, min(doc_id) as doc_id from documents group by lang, md5(source || text)""")
def same_content_dropped(spark, sf):
    documents = table(spark, sf, "documents").select(
        "doc_id", F.col("lang").alias("hashtag"), F.col("source").alias("username"), F.col("text").alias("content")
    )
    return dedupe.drop_same_content(documents, order_by=["doc_id"]).select("hashtag", "doc_id")


@register("capped_per_hashtag", o.query(f"""
select hashtag, {IDS} from (select *, regexp_replace(unnest(tag_list), '^#', '') as hashtag from clean)
qualify row_number() over (partition by hashtag order by timestamp nulls first, uid, source_file) <= 50""", *o.CLEAN_STEPS))
def capped_per_hashtag(spark, sf):
    tagged = summary.explode_hashtags(cleaned(spark, sf).select(*ID, "uid", "timestamp", "source_file", "_hashtags_list"))
    capped = dedupe.cap_per_group(tagged, 50, order_by=("timestamp", "uid", "source_file"))
    return capped.select("hashtag", *ID)


@register("sorted_signals", o.query(f"""
select {o.shown('bucket')} as timestamp, {o.r('avg(composite_signal)')} as signal, count(*) as n
from (select {o.bucket('timestamp', 2 * o.HOUR)} as bucket, composite_signal from composite) group by bucket order by 1""", *o.SIGNAL_STEPS))
def sorted_signals(spark, sf):
    signals = buckets.aggregate_signals(composed(spark, sf), "2h", method="none", gaps=False)
    return series.sort_by_time(signals).select(shown("timestamp"), r("signal"), "n")


@register("downsampled_events", """
with numbered as (select *, row_number() over (order by ts, event_id) - 1 as i, count(*) over () as n from events),
wanted as (select case when id = 999 then n - 1 else floor(id * ((n - 1) / 999::double))::bigint end as i
  from (select unnest(range(1000)) as id), (select count(*) as n from events))
select event_id, value from numbered join wanted using (i)""")
def downsampled_events(spark, sf):
    events = table(spark, sf, "events").select(F.col("ts").alias("timestamp"), "event_id", "value")
    return series.downsample(events, 1000, order_by=("timestamp", "event_id")).select("event_id", "value")


@register("display_series", o.query(f"""
select {o.shown('timestamp')} as timestamp, {o.r('signal')} as signal from signals join wanted using (i) order by 1""",
    *o.SIGNAL_STEPS, extra={
        "observed": f"select {o.bucket('timestamp', 900_000_000)} as bucket, avg(composite_signal) as signal from composite where hashtag_primary = '#caf' || chr(233) group by 1",
        "signals": "select bucket as timestamp, signal, row_number() over (order by bucket) - 1 as i from observed",
        "wanted": "select distinct case when n <= 400 then id when id = 399 then n - 1 else floor(id * ((n - 1) / 399::double))::bigint end as i from (select unnest(range(400)) as id), (select count(*) as n from signals)",
    }))
def display(spark, sf):
    signals = buckets.aggregate_signals(composed(spark, sf), "15min", by=["hashtag_primary"], method="none")
    blank = F.lit(None).cast("double")
    shown_series = display_series(signals.withColumns({"ci_lo": blank, "ci_hi": blank}), "#café", 400)
    return shown_series.select(shown("timestamp"), r("signal"))


@register("primary_hashtag_signals", o.query(f"""
select {o.shown(o.bucket('timestamp', o.HOUR))} as timestamp, {o.r('avg(composite_signal)')} as signal, count(*) as n from composite
where hashtag_primary = '#extra' group by 1""", *o.SIGNAL_STEPS))
def primary_hashtag_signals(spark, sf):
    signals = buckets.aggregate_signals(composed(spark, sf), "1h", by=["hashtag_primary"], method="none")
    return series.for_hashtag(signals, "#extra").select(shown("timestamp"), r("signal"), "n")


# ---- aggregates and fitted operators ----------------------------------------

@register("zscores", """
with m as (select avg(value) as v_m, stddev_pop(value) as v_s, avg(user_id) as u_m, stddev_pop(user_id) as u_s from events)
select event_id, round((value - v_m) / v_s, 9) as value_z, round((user_id - u_m) / u_s, 9) as user_id_z, 0.0::double as flat_z from events, m""")
def zscores(spark, sf):
    events = table(spark, sf, "events").withColumn("flat", F.lit(3.0))
    scores = features.zscore(events, ["value", "user_id", "flat"])
    return scores.select("event_id", r("value_z"), r("user_id_z"), r("flat_z"))


@register("zscores_of_merged_moments", """
with m as (select avg(value) as v_m, stddev_pop(value) as v_s, avg(user_id) as u_m, stddev_pop(user_id) as u_s from events)
select event_id, round((value - v_m) / v_s, 9) as value_z, round((user_id - u_m) / u_s, 9) as user_id_z from events, m""")
def zscores_of_merged_moments(spark, sf):
    """A run per day stores its moments; the z-scores come from what is stored."""
    events, folder = table(spark, sf, "events"), run_folder(spark, "moments")
    moments.store_moments(events, ["value", "user_id"], folder, F.to_date("ts"))
    fit = moments.as_fit(moments.stored_moments(spark, folder))
    scores = features.zscore(events, ["value", "user_id"], fit)
    return scores.select("event_id", r("value_z"), r("user_id_z"))


@register("tfidf_weights", o.query("select doc_id, term, tf, round(w, 9) as weight from weights",
                                   *o.TEXT_STEPS, texts="documents", keys="doc_id"))
def tfidf_weights(spark, sf):
    weights = tfidf.tfidf_weights(table(spark, sf, "documents"), ["doc_id"], "text", o.TERMS)
    return weights.select("doc_id", "term", F.col("tf").cast("bigint").alias("tf"), r("weight"))


@register("svd_scores", o.query(f"select doc_id, round(sum(w * v), 6) as svd_1 from weights join v{o.PASSES} using (term_id) group by doc_id",
                                *o.TEXT_STEPS, extra=o.power_steps(o.PASSES), texts="documents", keys="doc_id"))
def svd_scores(spark, sf):
    model = svd.fit_svd(table(spark, sf, "documents"), ["doc_id"], "text", 1, o.TERMS, oversample=0, passes=o.PASSES, method="power")
    return model.scores().select("doc_id", r("svd_1", 6))


@register("svd_scores_converged", o.query(
    f"select doc_id, round(sum(w * v), 6) as svd_1 from weights join v{o.MANY_PASSES} using (term_id) group by doc_id",
    *o.TEXT_STEPS, extra=o.power_steps(o.MANY_PASSES), texts="documents", keys="doc_id"))
def svd_scores_converged(spark, sf):
    model = svd.fit_svd(table(spark, sf, "documents"), ["doc_id"], "text", 1, o.TERMS, tolerance=1e-11)
    return model.scores().select("doc_id", r("svd_1", 6))


@register("svd_checks", o.query(f"""
select i, j, case when i = j then 1.0 else 0.0 end::double as dot, true as exact, (select round(sqrt(sum(y * y)), 6) from along) as largest
from range(1, 7) a(i), range(1, 7) b(j) where i <= j""", *o.TEXT_STEPS, extra=o.power_steps(o.MANY_PASSES) | {
    "along": f"select sum(w * v) as y from weights join v{o.MANY_PASSES} using (term_id) group by doc_id"},
    texts="documents", keys="doc_id"))
def svd_checks(spark, sf):
    """Scores are orthogonal, as long as their singular values, and directions are exact to 9 digits."""
    model = svd.fit_svd(table(spark, sf, "documents"), ["doc_id"], "text", 6, o.TERMS)
    report = F.broadcast(model.report().where("residual <= 1e-9 and converged").select("component", "singular_value"))
    first, second = report.toDF("i", "s_i"), report.toDF("j", "s_j")
    sums = model.products().join(first, "i", "left").join(second, "j", "left")
    return sums.select(
        F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"),
        (F.round(F.col("dot") / (F.col("s_i") * F.col("s_j")), 6) + 0.0).alias("dot"),
        (F.col("s_i").isNotNull() & F.col("s_j").isNotNull()).alias("exact"),
        F.round(F.lit(float(model.singular_values[0])), 6).alias("largest"),
    )


@register("svd_components")
def svd_components(spark, sf):
    documents = table(spark, sf, "documents")
    return svd.with_svd(documents.select("doc_id"), svd.fit_svd(documents, ["doc_id"], "text", 6, o.TERMS))


@register("signal_buckets", o.query(f"""
select {o.shown('bucket')} as timestamp, {o.r('signal')} as signal, coalesce(n, 0) as n
from spine left join observed using (bucket)""", *o.SIGNAL_STEPS, extra={
    "observed": f"select {o.bucket('timestamp', 2 * o.HOUR)} as bucket, avg(composite_signal) as signal, count(*) as n from composite group by 1",
    "spine": o.spine("observed", 2 * o.HOUR)}))
def signal_buckets(spark, sf):
    signals = buckets.aggregate_signals(composed(spark, sf), "2h", method="none")
    return signals.select(shown("timestamp"), r("signal"), "n")


@register("signal_buckets_from_first_day", o.query(f"""
select {o.shown('bucket')} as timestamp, round(value, 9) as value, coalesce(n, 0) as n from spine left join observed using (bucket)""",
    extra={
        "origin": "select epoch_us(date_trunc('day', min(ts))) as first from events",
        "observed": f"select {o.bucket('ts', 420_000_000, 'first')} as bucket, avg(value) as value, count(*) as n from events, origin group by 1",
        "spine": o.spine("observed", 420_000_000)}))
def signal_buckets_from_first_day(spark, sf):
    events = table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("timestamp"), "value")
    signals = buckets.aggregate_signals(events, "7min", method="none", value="value")
    return signals.select(shown("timestamp"), F.round("signal", 9).alias("value"), "n")


@register("signal_buckets_by_hashtag", o.query(f"""
select {o.shown('bucket')} as timestamp, hashtag_primary, {o.r('signal')} as signal, coalesce(n, 0) as n
from spine left join observed using (bucket, hashtag_primary)""", *o.SIGNAL_STEPS, extra={
    "observed": f"select {o.bucket('timestamp', 2 * o.HOUR)} as bucket, hashtag_primary, avg(composite_signal) as signal, count(*) as n from composite group by all",
    "spine": f"select hashtag_primary, unnest(generate_series(min(bucket), max(bucket), to_microseconds({2 * o.HOUR}))) as bucket from observed group by 1"}))
def signal_buckets_by_hashtag(spark, sf):
    signals = buckets.aggregate_signals(composed(spark, sf), "2h", by=["hashtag_primary"], method="none", gaps=True)
    return signals.select(shown("timestamp"), "hashtag_primary", r("signal"), "n")


@register("signal_buckets_with_a_null_group", o.query(f"""
select {o.shown('bucket')} as timestamp, tag, {o.r('signal')} as signal, coalesce(n, 0) as n
from spine left join observed on spine.bucket = observed.bucket and spine.g is not distinct from observed.tag""", *o.SIGNAL_STEPS, extra={
    "observed": f"select {o.bucket('timestamp', 2 * o.HOUR)} as bucket, nullif(hashtag_primary, '#extra') as tag, avg(composite_signal) as signal, count(*) as n from composite where hour(timestamp) % 6 < 4 group by all",
    "spine": f"select tag as g, unnest(generate_series(min(bucket), max(bucket), to_microseconds({2 * o.HOUR}))) as bucket from observed group by 1"}).replace(
        "select strftime(bucket,", "select strftime(spine.bucket,").replace(" as timestamp, tag,", " as timestamp, g as tag,"))
def signal_buckets_with_a_null_group(spark, sf):
    scores = composed(spark, sf).where(F.hour("timestamp") % 6 < 4).withColumn("tag", F.nullif("hashtag_primary", F.lit("#extra")))
    signals = buckets.aggregate_signals(scores, "2h", by=["tag"], method="none", gaps=True)
    return signals.select(shown("timestamp"), "tag", r("signal"), "n")


@register("bootstrap_intervals", o.query(f"""
select {o.shown('bucket')} as timestamp, {o.r('signal')} as signal, n, {o.r('ci_lo')} as ci_lo, {o.r('ci_hi')} as ci_hi
from observed join ends using (bucket)""", *o.SIGNAL_STEPS, extra={
    "binned": f"select {o.bucket('timestamp', 2 * o.HOUR)} as bucket, uid, source_file, composite_signal from composite",
    "observed": "select bucket, avg(composite_signal) as signal, count(*) as n from binned group by 1",
    **o.bootstrap_steps("binned", "bucket", "source_file || '|' || uid", "composite_signal")}))
def bootstrap_intervals(spark, sf):
    scores = composed(spark, sf)
    signals = buckets.aggregate_signals(scores, "2h", gaps=False, key=row_keys(scores))
    return signals.select(shown("timestamp"), r("signal"), "n", r("ci_lo"), r("ci_hi"))


@register("bootstrap_intervals_fixed_n", o.query(f"""
select {o.shown('bucket')} as timestamp, {o.r('signal')} as signal, n, {o.r('ci_lo')} as ci_lo, {o.r('ci_hi')} as ci_hi
from observed join ends using (bucket)""", *o.SIGNAL_STEPS, extra={
    "binned": f"select {o.bucket('timestamp', 2 * o.HOUR)} as bucket, uid, source_file, composite_signal from composite",
    "observed": "select bucket, avg(composite_signal) as signal, count(*) as n from binned group by 1",
    **o.resample_steps("binned", "source_file, uid, composite_signal", "composite_signal", o.RESAMPLE_BLOCK)}))
def bootstrap_intervals_fixed_n(spark, sf):
    """Blocks are small here, so that the tree has several levels in most buckets."""
    scores = composed(spark, sf)
    signals = buckets.aggregate_signals(
        scores, "2h", gaps=False, key=row_keys(scores), method="resample", block=o.RESAMPLE_BLOCK
    )
    return signals.select(shown("timestamp"), r("signal"), "n", r("ci_lo"), r("ci_hi"))


@register("bootstrap_intervals_by_hashtag", o.query(f"""
select {o.shown('bucket')} as timestamp, hashtag_primary, {o.r('signal')} as signal, n, {o.r('ci_lo')} as ci_lo, {o.r('ci_hi')} as ci_hi
from observed join ends using (bucket, hashtag_primary)""", *o.SIGNAL_STEPS, extra={
    "binned": f"select {o.bucket('timestamp', o.DAY)} as bucket, hashtag_primary, uid, source_file, composite_signal from composite",
    "observed": "select bucket, hashtag_primary, avg(composite_signal) as signal, count(*) as n from binned group by all",
    **o.bootstrap_steps("binned", "bucket, hashtag_primary", "source_file || '|' || uid", "composite_signal")}))
def bootstrap_intervals_by_hashtag(spark, sf):
    scores = composed(spark, sf)
    signals = buckets.aggregate_signals(scores, "1D", by=["hashtag_primary"], key=row_keys(scores))
    return signals.select(shown("timestamp"), "hashtag_primary", r("signal"), "n", r("ci_lo"), r("ci_hi"))


@register("hashtag_summary", o.query(f"""
select hashtag, count(*) as total_tweets, count(distinct username) as unique_users, {o.r('avg(likes)')} as avg_likes,
  {o.r('avg(retweets)')} as avg_retweets, {o.r('avg(replies)')} as avg_replies,
  {o.shown('min(timestamp)')} as range_start, {o.shown('max(timestamp)')} as range_end
from (select *, regexp_replace(unnest(tag_list), '^#', '') as hashtag from clean) group by hashtag""", *o.CLEAN_STEPS))
def hashtag_summary(spark, sf):
    return _summary_view(summary.summarize_by_hashtag(summary.explode_hashtags(cleaned(spark, sf))))


@register("users_by_stored_sketches", o.query("""
select hashtag, count(*) as posts, true as close from (select regexp_replace(unnest(tag_list), '^#', '') as hashtag from clean) group by hashtag""", *o.CLEAN_STEPS))
def users_by_stored_sketches(spark, sf):
    """Sketches per hashtag and date, stored, united per hashtag and held against exact counts (within 4 %, about six standard errors)."""
    tagged = stage(summary.explode_hashtags(cleaned(spark, sf)).select("hashtag", "date", "username"), "tagged")
    united = summary.united_users(stage(summary.user_sketches(tagged), "sketches"))
    exact = tagged.groupBy("hashtag").agg(F.count_distinct("username").alias("exact"))
    close = F.abs(F.col("unique_users") - F.col("exact")) <= 0.04 * F.col("exact")
    return united.join(exact, "hashtag", "left").select("hashtag", "posts", F.coalesce(close, F.lit(False)).alias("close"))


def _summary_view(stats: DataFrame) -> DataFrame:
    return stats.select(
        "hashtag", "total_tweets", "unique_users", r("avg_likes"), r("avg_retweets"), r("avg_replies"),
        F.col("date_range.start").alias("range_start"), F.col("date_range.end").alias("range_end"),
    ).withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in ("range_start", "range_end")})


# ---- sources and sinks -------------------------------------------------------

EXTRAS = "origin string, post_no bigint, copy_no int"
_FROM_FILES = """select origin, post_no, uid, username, md5(content) as content_md5, replies, likes, hashtag_primary, date
from (select * from clean_all qualify row_number() over (partition by uid order by {order}) = 1)"""
_CSV_STD = {**o.STEPS, "std": o.STEPS["std"].replace(
    o.whole_number("replies"), f"case when replies in ('12.0', '12.7') then 12 else {o.whole_number('replies')} end")}


def _from_files(raw: DataFrame) -> DataFrame:
    # CSV cells are text: as text, 11933 would come before 7613
    raw = raw.withColumns({"post_no": F.col("post_no").cast("bigint"), "copy_no": F.col("copy_no").cast("int")})
    kept = {c: F.col(c) for c in ("origin", "post_no", "uid", "username")}
    kept |= {"content_md5": F.md5("content"), **{c: F.col(c) for c in ("replies", "likes", "hashtag_primary", "date")}}
    return clean.clean_posts(raw, scope="global", order_by=POST_ORDER, columns=kept)


@register("json_lines_source", o.query(_FROM_FILES.format(order=IDS), "raw_posts", "std", "tagged", "clean_all"))
def json_lines_source(spark, sf):
    raw = raw_posts(spark, sf).drop("source_file")
    folder = run_folder(spark, "json-lines")
    raw.write.json(folder)
    return _from_files(sources.read_posts(spark, folder, extras=EXTRAS))


def write_json_documents(df: DataFrame, folder: str) -> int:
    """One JSON file per partition that holds one array; every third partition one more of a single object.

    A file has its final name only once it is complete, so a repeated task replaces its own file.
    """
    records = df.select(F.to_json(F.struct(*df.columns)).alias("value"))
    where = folder if "://" in folder else f"file://{folder}"

    def write(batches):
        import json

        import pyarrow as pa
        from pyarrow import fs
        from pyspark import TaskContext

        store, root = fs.FileSystem.from_uri(where)
        store.create_dir(root, recursive=True)
        number, rows = TaskContext.get().partitionId(), 0

        def save(name, chunks):
            draft = f"{root}/.{name}-{TaskContext.get().taskAttemptId()}"
            with store.open_output_stream(draft) as out:
                for chunk in chunks:
                    out.write(chunk.encode())
            store.move(draft, f"{root}/{name}")

        def array():
            nonlocal rows
            for batch in batches:
                values = batch.column("value").to_pylist()
                if number % 3 == 0 and rows == 0 and values:
                    save(f"single-{number}.json", [json.dumps(json.loads(values.pop(0)), indent=2)])
                    rows += 1
                if values:
                    yield ("[" if array.first else ",\n") + ",\n".join(values)
                    array.first = False
                rows += len(values)
            yield "[]" if array.first else "]"

        array.first = True
        save(f"array-{number}.json", array())
        yield pa.RecordBatch.from_pydict({"rows": [rows]})

    return records.mapInArrow(write, "rows long").agg(F.sum("rows")).first()[0]


@register("json_document_source", o.query(_FROM_FILES.format(order=IDS), "raw_posts", "std", "tagged", "clean_all"))
def json_document_source(spark, sf):
    folder = run_folder(spark, "json-arrays")
    write_json_documents(raw_posts(spark, sf).drop("source_file"), folder)
    return _from_files(sources.read_posts(spark, folder, extras=EXTRAS))


@register("csv_source", o.query(
    _FROM_FILES.format(order="origin, post_no, copy_no"),
    extra={name: _CSV_STD[name] for name in ("raw_posts", "std", "tagged", "clean_all")}))
def csv_source(spark, sf):
    folder = run_folder(spark, "csv")
    _write_csv(raw_posts(spark, sf).drop("source_file"), folder)
    return _from_files(sources.read_posts(spark, folder))


def _write_csv(df: DataFrame, folder: str) -> None:
    plain = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.options(**plain).mode("append").csv(folder)


@register("mixed_folder_source", o.query(f"""
select case when origin = 'event' then '.json' else '.csv' end as suffix, count(*) as posts, sum(likes) as likes, count(extra) as with_extra
from (select *, case when origin <> 'event' then urls end as extra from std) group by 1""", "raw_posts", "std"))
def mixed_folder_source(spark, sf):
    raw = raw_posts(spark, sf)
    folder = run_folder(spark, "mixed")
    raw.where("origin = 'event'").drop("source_file").write.mode("append").json(folder)
    others = raw.where("origin <> 'event'").drop("source_file", "timestamp")
    _write_csv(others.withColumn("extra", F.concat(F.lit("x"), "urls")), folder)
    others.select("username").write.mode("append").text(folder)  # not a dump: must be left alone
    posts = clean.standardize(sources.read_posts(spark, folder, extras=EXTRAS))
    suffix = F.regexp_extract("source_file", r"(\.[a-z]+)$", 1).alias("suffix")
    return posts.groupBy(suffix).agg(
        F.count("*").alias("posts"), F.sum("likes").alias("likes"), F.count("extra").alias("with_extra")
    )


@register("combined_parquet_sink", o.query("""
select date, count(*) as posts, sum(likes) as likes, sum(length(content)) as chars from clean group by date""", *o.CLEAN_STEPS))
def combined_parquet_sink(spark, sf):
    folder = run_folder(spark, "posts")
    tables.write_posts(cleaned(spark, sf), folder)
    kept = read_clean(spark, folder)
    return kept.groupBy("date").agg(
        F.count("*").alias("posts"), F.sum("likes").alias("likes"), F.sum(F.length("content")).alias("chars")
    )


@register("run_metadata", o.query(f"""
select count(distinct uid) as rows_written, count(distinct uid) as rows_of_files, true as all_files_listed, '{NOTE}' as note from tagged""", "raw_posts", "std", "tagged"))
def run_metadata(spark, sf):
    folder = run_folder(spark, "dump")
    raw_posts(spark, sf).drop("source_file").write.json(folder)
    out = run_folder(spark, "ingested")
    done = ingest(spark, folder, out, scope="global", extras=EXTRAS)
    files = spark.read.schema("name string, rows bigint").json(f"{out}/ingest_files").agg(
        F.sum("rows").alias("rows_of_files"), F.count("name").alias("named")
    )
    return done.crossJoin(files).select("rows_written", "rows_of_files", (F.col("named") == F.col("files")).alias("all_files_listed"), "note")


@register("pruned_scan", o.query("""
select source_file, uid, md5(content) as content_md5, likes, retweets, replies, hashtag_primary, username
from clean where timestamp is not null and content is not null""", *o.CLEAN_STEPS))
def pruned_scan(spark, sf):
    folder = run_folder(spark, "posts")
    tables.write_posts(cleaned(spark, sf), folder)
    return tables.load_minimal(spark, folder).select(
        "source_file", "uid", F.md5("content").alias("content_md5"), "likes", "retweets", "replies",
        "hashtag_primary", "username",
    )


@register("stored_signals", o.query(f"""
select {o.shown('bucket')} as timestamp, {o.r('signal')} as signal, coalesce(n, 0) as n
from spine left join observed using (bucket)""", *o.SIGNAL_STEPS, extra={
    "observed": f"select {o.bucket('timestamp', o.HOUR)} as bucket, avg(composite_signal) as signal, count(*) as n from composite group by 1",
    "spine": o.spine("observed", o.HOUR)}))
def stored_signals(spark, sf):
    posts, out = run_folder(spark, "posts"), run_folder(spark, "out")
    tables.write_posts(cleaned(spark, sf), posts)
    _, signals = run_features(spark, posts, out, "1h", weights=o.WEIGHTS)
    return tables.read_table(spark, signals).select(shown("timestamp"), r("signal"), "n")


@register("csv_per_hashtag", o.query("""
select hashtag, count(*) as posts, sum(likes) as likes, sum(length(content)) as chars
from (select *, regexp_replace(unnest(tag_list), '^#', '') as hashtag from clean) group by hashtag""", *o.CLEAN_STEPS))
def csv_per_hashtag(spark, sf):
    folder = run_folder(spark, "csv-by-hashtag")
    tagged = summary.explode_hashtags(cleaned(spark, sf)).drop("date")
    # plain files take eight times the stored bytes of the tables
    tables.write_csv_by_hashtag(tagged, folder, **{"compression": "gzip", "zlib.compress.level": "BEST_SPEED"})
    schema = T.StructType([
        *[T.StructField(c, T.StringType()) for c in tagged.columns if c != "hashtag"],
        T.StructField("hashtag", T.StringType()),
    ])
    stored = spark.read.schema(schema).option("header", True).option("escape", '"').csv(folder)
    return stored.groupBy("hashtag").agg(
        F.count("*").alias("posts"), F.sum(F.col("likes").cast("bigint")).alias("likes"),
        F.sum(F.length("content")).alias("chars"),
    )


@register("stats_per_hashtag", ORACLES["hashtag_summary"])
def stats_per_hashtag(spark, sf):
    folder = run_folder(spark, "stats-by-hashtag")
    stats = summary.summarize_by_hashtag(summary.explode_hashtags(cleaned(spark, sf)))
    tables.write_stats_by_hashtag(stats, folder)
    return _summary_view(spark.read.schema(stats.schema).json(folder))


# ---- pages and streams -------------------------------------------------------

_ESCAPED = "replace(replace(replace(content, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
_PAGE = f"""concat('<html><body><article data-testid="tweet"><div><a href="/', username, '"><span>@', username, '</span></a></div>',
  coalesce(concat('<time datetime="', timestamp, '">then</time>'), ''), '<div data-testid="tweetText">', {_ESCAPED}, '</div>',
  '<a href="/hashtag/tag?src=x">#Tag</a><a href="/desk">@Desk</a><a href="https://example.org/a?b=1&amp;c=2">out</a>',
  '<a href="https://twitter.com/b">in</a><br><div data-testid="reply"><span>', replies, '</span></div>',
  '<div data-testid="retweet"><span>', retweets, 'K</span></div><div data-testid="like"><span>', likes, '</span></div>',
  '</article><article data-testid="tweet"><div data-testid="tweetText">nobody said this</div></article></body></html>')"""


@register("posts_from_pages", o.query(rf"""
select {IDS}, username, timestamp, md5(regexp_replace(content, '^[\x{{00}}\s\x{{1c}}-\x{{1f}}\x{{85}}\x{{a0}}]+|[\s\x{{1c}}-\x{{1f}}\x{{85}}\x{{a0}}]+$', '', 'g')) as content_md5,
  {o.metric('replies')} as replies, cast(retweets as bigint) * 1000 as retweets, {o.metric('likes')} as likes,
  '@' || username || ', @Desk' as mentions, '#Tag' as hashtags, 'https://example.org/a?b=1&c=2' as urls from raw_posts""", "raw_posts"))
def posts_from_pages(spark, sf):
    pages = raw_posts(spark, sf).select(*ID, F.expr(_PAGE).alias("html"))
    posts = html.extract_posts(pages, keep=ID)
    return posts.select(
        *ID, "username", "timestamp", F.md5("content").alias("content_md5"),
        "replies", "retweets", "likes", "mentions", "hashtags", "urls",
    )


@register("links_and_headings_of_pages", r"""
select page_id, regexp_extract(html, '<a href="/([^/"]+)">', 1) as username,
  trim(replace(replace(replace(replace(regexp_extract(html, '<h1>(.*?)</h1>', 1), '&quot;', '"'), '&copy;', chr(169)), '&middot;', chr(183)), '&amp;', '&')) as content
from pages""")
def links_and_headings_of_pages(spark, sf):
    layout = html.Layout(post=None, content=html.Marked("h1"))
    return html.extract_posts(table(spark, sf, "pages"), layout=layout).select("page_id", "username", "content")


LIVE_DELAY = "60 days"


@register("live_signal_stream", o.query(f"""
select {o.shown('bucket')} as timestamp, {o.r('signal')} as signal, n, 0::bigint as late_rows from (
  select {o.bucket('timestamp', o.HOUR)} as bucket, avg(composite_signal) as signal, count(*) as n from composite group by 1)""",
    extra={**{"raw_posts": o.STEPS["raw_posts"], "std": o.STEPS["std"].replace(o.whole_number("likes"), o.whole_number("retweets"))},
           **{n: o.STEPS[n] for n in o.SIGNAL_STEPS if n not in ("raw_posts", "std")}}))
def live_signal_stream(spark, sf):
    # Copies of a post differ only in likes; a stream may keep either, so they are made equal.
    raw = raw_posts(spark, sf).withColumn("likes", F.col("retweets"))
    folder = run_folder(spark, "arriving")
    # Five triggers of as many files as keep all cores busy: a file is too small to be split, and cleaning is heavy work per row.
    each = max(spark.sparkContext.defaultParallelism, raw.rdd.getNumPartitions() // 5)
    raw.repartition(5 * each).write.parquet(folder)
    arrived = spread(spark.read.parquet(folder), stored_bytes(spark, folder))
    posts = clean.drop_incomplete(clean.clean_posts(arrived, order_by=POST_ORDER))
    fit = live.fit_frozen(features.score_reactions(features.score_text(posts)), o.WEIGHTS)
    # Files in no order of time: the delay must cover the whole month.
    stream = spark.readStream.schema(arrived.schema).option("maxFilesPerTrigger", each).parquet(folder)
    out, marks = run_folder(spark, "live"), run_folder(spark, "live-progress")
    query = live.write_live(live.live_signals(stream, fit, "1h", delay=LIVE_DELAY), out, marks, drain=True)
    query.awaitTermination()
    late = F.lit(live.late_rows(query)).alias("late_rows")
    live.compact(spark, out)
    return live.latest_signals(spark, out).select(shown("timestamp"), r("signal"), "n", late)


# ---- the whole flow ----------------------------------------------------------

_BLEND = {
    **o.power_steps(o.PASSES),
    "text_scores": f"select source_file, uid, sum(w * v) as s from weights join v{o.PASSES} using (term_id) group by all",
    "all_scores": "select scores.*, coalesce(s, 0) as svd_1 from scores left join text_scores using (source_file, uid)",
    "all_moments": o.moments("all_scores", o.DEFAULT_WEIGHTS),
    "blend": f"select *, {' + '.join(f'{w} * {o.z(c)}' for c, w in o.DEFAULT_WEIGHTS.items())} as composite_signal from all_scores, all_moments",
}


def _flow_sql(final: str, more: dict[str, str]) -> str:
    sql = o.query(final, *o.SCORE_STEPS, *o.TEXT_STEPS, extra={**_BLEND, **more}, texts="posts_texts", keys="source_file, uid")
    return sql.replace(
        "tokens as materialized", "posts_texts as materialized (select source_file, uid, content as text from words),\ntokens as materialized")


_OBSERVED = {
    "observed": f"select {o.bucket('timestamp', 2 * o.HOUR)} as bucket, avg(composite_signal) as signal, count(*) as n from blend group by 1",
    "spine": o.spine("observed", 2 * o.HOUR),
}


@register("signal_report", _flow_sql(f"""
select {o.shown('bucket')} as timestamp, {o.r('signal', 5)} as signal, coalesce(n, 0) as n
from spine left join observed using (bucket)""", _OBSERVED))
def signal_report(spark, sf):
    signals = buckets.aggregate_signals(_features(spark, sf), "2h", method="none")
    return signals.select(shown("timestamp"), r("signal", 5), "n")


@register("feature_table", _flow_sql(f"""
select source_file, uid, username, {o.shown('timestamp')} as timestamp, hashtag_primary, {o.joined('tag_list')} as hashtags_list,
  {o.r('polarity')} as polarity, {o.r('urgency')} as urgency, {o.r('engagement')} as engagement, {o.r('svd_1', 5)} as svd_1,
  {o.r('composite_signal', 5)} as composite_signal from blend""", {}))
def feature_table(spark, sf):
    return _features(spark, sf).select(
        "source_file", "uid", "username", shown("timestamp"), "hashtag_primary", joined("_hashtags_list", "hashtags_list"),
        r("polarity"), r("urgency"), r("engagement"), r("svd_1", 5), r("composite_signal", 5),
    )


def _features(spark: SparkSession, sf: str) -> DataFrame:
    folder = run_folder(spark, "posts")
    tables.write_posts(cleaned(spark, sf), folder)
    return stage(build_features(tables.load_minimal(spark, folder), oversample=0, passes=o.PASSES, method="power"), "features")


@register("composite_signal", _flow_sql(f"select source_file, uid, {o.r('composite_signal', 6)} as composite_signal from blend", {}))
def composite_signal(spark, sf):
    """All three parts: polarity, engagement and the leading direction of the texts."""
    posts = clean.drop_incomplete(cleaned(spark, sf)).select(*tables.MINIMAL_COLUMNS, "source_file")
    blend = build_features(stage(posts, "posts"), oversample=0, passes=o.PASSES, method="power")
    return blend.select("source_file", "uid", r("composite_signal", 6))


@register("signal_report_with_intervals", _flow_sql(f"""
select {o.shown('bucket')} as timestamp, {o.r('signal', 5)} as signal, coalesce(n, 0) as n, {o.r('ci_lo', 5)} as ci_lo, {o.r('ci_hi', 5)} as ci_hi
from spine left join observed using (bucket) left join ends using (bucket)""", {
    **_OBSERVED, "binned": f"select {o.bucket('timestamp', 2 * o.HOUR)} as bucket, uid, source_file, composite_signal from blend",
    **o.bootstrap_steps("binned", "bucket", "source_file || '|' || uid", "composite_signal")}))
def signal_report_with_intervals(spark, sf):
    kept = _features(spark, sf)
    signals = buckets.aggregate_signals(kept, "2h", key=row_keys(kept))
    return signals.select(shown("timestamp"), r("signal", 5), "n", r("ci_lo", 5), r("ci_hi", 5))
