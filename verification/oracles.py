"""The registered queries in DuckDB SQL, over the same tables."""

from __future__ import annotations

from pulsemart.plans.catalog import COVERAGE_WORDS, ENRICH, SUPPLIER_BRANDS
from pulsemart.settings import (
    CLUSTER_DEFAULT, CLUSTER_RULES, ENGLISH_STOP_WORDS, PRIORITY_RULES, TREND_CATEGORIES,
    TREND_COMBINATIONS,
)
from pulsemart.settings import BRAND_ROWS, URL_PATTERN
from pulsemart.sources import samples as S
from verification.feeds_sql import (
    CE, CF, EV, RD, RE, SE, TR, TW, brand, contains, country, day, rnd, with_, words,
)
from verification.stemmer_sql import stems

SQL: dict[str, str] = {}


def listed(items) -> str:
    return "[" + ", ".join("'" + str(i).replace("'", "''") + "'" for i in items) + "]"


def rounded(*names: str) -> str:
    return ", ".join(f"{rnd(n)} {n}" for n in names)


def hash16(x: str) -> str:
    return f"substr(sha256({x}), 1, 16)"


# ---------------------------------------------------------------- raw layer
SQL["raw_twitter_posts"] = with_(TW) + """
select brand_id, tweet_id, ts_event, date, author_id, total_engagements, text_length, geo_country from tw_raw"""
SQL["raw_reddit_messages"] = with_(RD) + f"""
select brand_id, reddit_id, date, author, type, score, text_length, {hash16('combined_text')} text_hash from rd_raw"""
SQL["raw_trends_timeseries"] = with_(TR) + """
select brand_id, keyword, geo, date, is_brand_keyword, count(*) points, sum(value)::bigint total from tr_raw group by all"""
SQL["raw_trends_date_range"] = with_(TR) + """
select brand_id, date, count(*) points, max(value) highest from tr_raw
where date between DATE '2024-01-05' and DATE '2024-01-11' group by all"""
SQL["raw_complaints"] = with_(CF) + """
select brand_id, complaint_id, date, product, timely_response, consumer_disputed, sent, severity_score,
  narrative_length, has_narrative from cf_raw"""
SQL["raw_complaints_export"] = with_(CE) + """
select complaint_id, 'td_bank' brand_id, product, issue, state, complaint_date, date_sent_to_company, text_length,
  true has_meaningful_text, severity_level, true is_complaint from ce_raw"""
SQL["raw_reddit_events"] = with_(RE) + f"""
select event_id, brand_id, event_date, subreddit, author, reddit_type, title, score, num_comments,
  {rounded('sentiment')}, text_length, true has_meaningful_text, is_complaint from re_raw"""


# ------------------------------------------------------------ daily rollups
def tone_ctes(src: str, text: str, out: str) -> str:
    t = S.TONE
    return f"""{out} as (
  select *, case when {words(text, t.positive)} then 0.5::double when {words(text, t.negative)} then -0.5::double
      else 0.0::double end tone,
    case when {words(text, t.toxic)} then 0.8::double else 0.1::double end tox from {src})"""


TONE_COLS = """avg(tone) sentiment_avg, stddev_samp(tone) sentiment_stddev,
    avg(tox) toxicity_avg, avg((tox > 0.7)::int) toxicity_rate, avg(text_length) avg_text_length"""
TONE_OUT = """least(100, greatest(0, (sentiment_avg + 1) * 50)) sentiment_index,
    coalesce(abs(sentiment_avg) > 2 * coalesce(sentiment_stddev, 0.5), false) anomaly_flag, true data_freshness_ok"""


def prank(metric: str) -> str:
    return f"percent_rank() over (partition by date, country order by {metric} asc nulls first) * 100"


TWD = TW + ",\n" + tone_ctes("tw_raw", "low", "tw_tone") + f""",
tw_sum as (
  select brand_id, date, coalesce(geo_country, 'Unknown') country, count(*) posts, count(distinct author_id) authors,
    sum(total_engagements)::bigint engagements, avg((tone > 0.1)::int) positive_rate,
    avg((tone < -0.1)::int) negative_rate, avg(total_engagements) avg_engagements_per_post,
    avg(coalesce(total_engagements > 10, false)::int) high_engagement_rate,
    avg(coalesce(possibly_sensitive, false)::int) sensitive_content_rate, {TONE_COLS}
  from tw_tone group by all),
tw_day as (select *, {prank('posts')} volume_index, {TONE_OUT}, posts >= 10 min_sample_size_met from tw_sum)"""

RDD = RD + ",\n" + tone_ctes("rd_raw", "lower(combined_text)", "rd_tone") + f""",
rd_sum as (
  select brand_id, date, coalesce(geo_country, 'Unknown') country, count(*) messages,
    count(distinct author) unique_authors, count(distinct subreddit) subreddits,
    count(*) filter (where type = 'post') posts, count(*) filter (where type = 'comment') as comments,
    sum(score)::bigint score_sum, avg(score) score_avg, avg((score > 0)::int) positive_score_rate,
    avg((score < 0)::int) negative_score_rate, avg((tone > 0.1)::int) positive_sentiment_rate,
    avg((tone < -0.1)::int) negative_sentiment_rate,
    count(*) filter (where upvote_ratio > 0.8) / nullif(count(upvote_ratio), 0) high_upvote_ratio_rate, {TONE_COLS}
  from rd_tone group by all),
rd_day as (select *, {prank('messages')} volume_index, {TONE_OUT}, messages >= 5 min_sample_size_met from rd_sum)"""


def pct(now: str, before: str) -> str:
    return f"case when {before} > 0 then ({now} - {before}) / {before} * 100 end"


TRD = TR + f""",
tr_geo as (select *, case when geo like 'US-%' then 'US' else geo end country from tr_raw),
tr_sum as (
  select brand_id, date, country, geo region, avg(value) filter (where is_brand_keyword) brand_rsv_avg,
    avg(value) filter (where not is_brand_keyword) category_rsv_avg, avg(value) rsv_avg, max(value) rsv_max,
    min(value) rsv_min, stddev_samp(value) rsv_stddev, count(*) data_points,
    count(distinct keyword) unique_keywords, count(distinct geo) regions_covered
  from tr_geo group by brand_id, date, country, geo),
tr_top as (
  select brand_id, date, country, region, string_agg(keyword || ':' || value::varchar, '|' order by place) top_keywords
  from (select brand_id, date, country, geo region, keyword, value,
          row_number() over (partition by brand_id, date, country, geo order by value desc, keyword) place from tr_geo)
  where place <= 5 group by all),
tr_lag as (
  select *, lag(rsv_avg, 7) over (partition by brand_id, country, region order by date) b7,
    lag(rsv_avg, 28) over (partition by brand_id, country, region order by date) b28 from tr_sum),
tr_day as (
  select l.* exclude (b7, b28), brand_rsv_avg - category_rsv_avg brand_category_diff,
    {pct('rsv_avg', 'b7')} rsv_trend_7d, {pct('rsv_avg', 'b28')} rsv_trend_28d,
    {prank('rsv_avg')} visibility_index, top_keywords, data_points >= 5 min_sample_size_met,
    coalesce(rsv_avg > 90 or {pct('rsv_avg', 'b7')} > 500, false) anomaly_flag, true data_freshness_ok
  from tr_lag l join tr_top t using (brand_id, date, country, region))"""

CFD = CF + f""",
cf_sev as (
  select *, geo_country country,
    case when consumer_disputed and not timely_response then severity_score + 0.2::double
      when consumer_disputed or not timely_response then severity_score + 0.1::double else severity_score end sev2,
    case when lower(product) like '%mortgage%' then 'Mortgage'
      when lower(product) like '%credit card%' then 'Credit Card'
      when regexp_matches(lower(product), 'checking|savings') then 'Deposit Account'
      when lower(product) like '%loan%' then 'Loan'
      when lower(product) like '%debt collection%' then 'Debt Collection' else 'Other' end category
  from cf_raw),
cf_mode as (
  select brand_id, date, country, first(category order by n desc, category) top_product_category
  from (select brand_id, date, country, category, count(*) n from cf_sev group by all) group by all),
cf_mode2 as (
  select brand_id, date, country, first(state order by n desc, state) top_state
  from (select brand_id, date, country, state, count(*) n from cf_sev where state is not null group by all) group by all),
cf_sum as (
  select brand_id, date, country, count(*) complaints, count(distinct complaint_id) unique_complaints,
    count(distinct state) states_affected, avg(coalesce(timely_response, false)::int) timely_rate,
    avg(coalesce(consumer_disputed, false)::int) dispute_rate, avg(has_narrative::int) narrative_rate,
    avg((company_public_response is not null)::int) public_response_rate, avg(severity_score) severity_avg,
    avg(sev2) enhanced_severity_avg, max(severity_score) severity_max, stddev_samp(severity_score) severity_stddev,
    count(distinct category) product_categories, avg(narrative_length) avg_narrative_length,
    avg((narrative_length > 500)::int) long_narrative_rate, count(distinct zip_code) zip_codes_affected
  from cf_sev group by all),
cf_ix as (
  select *, 100 - {prank('complaints')} complaints_volume_index,
    100 - {prank('round(enhanced_severity_avg, 9)')} complaints_severity_index,
    (timely_rate * 0.6::double + (1 - dispute_rate) * 0.4::double) * 100 response_quality_index from cf_sum),
cf_day as (
  select i.*, top_product_category, top_state,
    complaints_volume_index * 0.4::double + complaints_severity_index * 0.4::double + response_quality_index * 0.2::double complaints_index,
    complaints >= 1 min_sample_size_met,
    coalesce(complaints > 100 or enhanced_severity_avg > 0.9::double, false) anomaly_flag, true data_freshness_ok
  from cf_ix i left join cf_mode using (brand_id, date, country) left join cf_mode2 using (brand_id, date, country))"""

SQL["twitter_daily"] = with_(TWD) + f"""
select brand_id, date, country, posts, authors, engagements, {rounded('sentiment_avg', 'sentiment_stddev',
'positive_rate', 'negative_rate', 'toxicity_avg', 'toxicity_rate', 'avg_engagements_per_post', 'high_engagement_rate',
'avg_text_length', 'sensitive_content_rate', 'volume_index', 'sentiment_index')},
  min_sample_size_met, anomaly_flag, data_freshness_ok from tw_day"""
SQL["reddit_daily"] = with_(RDD) + f"""
select brand_id, date, country, messages, unique_authors, subreddits, posts, comments, score_sum,
  {rounded('score_avg', 'positive_score_rate', 'negative_score_rate', 'sentiment_avg', 'sentiment_stddev',
'positive_sentiment_rate', 'negative_sentiment_rate', 'toxicity_avg', 'toxicity_rate', 'avg_text_length',
'high_upvote_ratio_rate', 'volume_index', 'sentiment_index')},
  min_sample_size_met, anomaly_flag, data_freshness_ok from rd_day"""
SQL["trends_daily"] = with_(TRD) + f"""
select brand_id, date, country, region, rsv_max, rsv_min, data_points, unique_keywords, regions_covered, top_keywords,
  {rounded('rsv_avg', 'rsv_stddev', 'brand_rsv_avg', 'category_rsv_avg', 'brand_category_diff', 'rsv_trend_7d',
'rsv_trend_28d', 'visibility_index')}, min_sample_size_met, anomaly_flag, data_freshness_ok from tr_day"""
SQL["trends_daily_calendar"] = with_(TRD) + f"""
select s.brand_id, s.date, s.country, s.region, {rnd('s.rsv_avg')} rsv_avg, {rnd(pct('s.rsv_avg', 'a.rsv_avg'))} rsv_trend_7d,
  {rnd(pct('s.rsv_avg', 'b.rsv_avg'))} rsv_trend_28d
from tr_sum s
left join tr_sum a on a.brand_id = s.brand_id and a.country = s.country and a.region = s.region and a.date = s.date - 7
left join tr_sum b on b.brand_id = s.brand_id and b.country = s.country and b.region = s.region and b.date = s.date - 28"""
CF_ROUND = rounded('timely_rate', 'dispute_rate', 'narrative_rate', 'public_response_rate', 'severity_avg',
                   'enhanced_severity_avg', 'severity_max', 'severity_stddev', 'avg_narrative_length',
                   'long_narrative_rate', 'complaints_volume_index', 'complaints_severity_index',
                   'response_quality_index', 'complaints_index')
SQL["complaints_daily"] = with_(CFD) + f"""
select brand_id, date, country, complaints, unique_complaints, states_affected, product_categories,
  top_product_category, top_state, zip_codes_affected, {CF_ROUND},
  min_sample_size_met, anomaly_flag, data_freshness_ok from cf_day"""

# ---------------------------------------------------------- composite score
_BRANDS = ", ".join(f"('{b[0]}', '{b[1]}')" for b in BRAND_ROWS)


def _own(name: str, mean: bool) -> str:
    best = f"max(case when region = country then {name} end)"
    if mean:
        other = (f"sum({name} * data_points) / nullif(sum(case when {name} is not null then data_points end), 0)::double")
        return f"case when bool_or(region = country) then {best} else {other} end {name}"
    return f"coalesce(bool_or(case when region = country then {name} end), bool_or({name})) {name}"


TR_ONE = f"""tr_one as (
  select brand_id, date, country, {', '.join(_own(m, True) for m in ('rsv_avg', 'brand_rsv_avg', 'category_rsv_avg',
'rsv_trend_7d', 'rsv_trend_28d', 'visibility_index'))}, {_own('min_sample_size_met', False)},
    {_own('anomaly_flag', False)} from tr_day group by brand_id, date, country)"""


def metrics_ctes(trends: str) -> str:
    return f"""{TWD},
{RDD},
{TRD},
{CFD},
{TR_ONE},
names(brand_id, brand_name) as (values {_BRANDS}),
spine as (
  select brand_id, date, country from tw_day union select brand_id, date, country from rd_day
  union select brand_id, date, country from tr_day union select brand_id, date, country from cf_day),
side as (
  select s.brand_id, n.brand_name, s.date, s.country,
    coalesce(t.posts, 0) twitter_posts, coalesce(t.authors, 0) twitter_authors,
    coalesce(t.engagements, 0) twitter_engagements, t.sentiment_avg twitter_sentiment_avg,
    t.volume_index tv, t.sentiment_index ti, t.toxicity_rate twitter_toxicity_rate,
    coalesce(r.messages, 0) reddit_messages, coalesce(r.unique_authors, 0) reddit_authors,
    coalesce(r.score_sum, 0) reddit_score_sum, r.sentiment_avg reddit_sentiment_avg,
    r.volume_index rv, r.sentiment_index ri, r.toxicity_rate reddit_toxicity_rate,
    g.rsv_avg trends_rsv_avg, g.brand_rsv_avg trends_brand_rsv_avg, g.category_rsv_avg trends_category_rsv_avg,
    g.rsv_trend_7d trends_7d_change, g.rsv_trend_28d trends_28d_change, g.visibility_index trends_visibility_index,
    coalesce(c.complaints, 0) cfpb_complaints, c.timely_rate cfpb_timely_rate, c.dispute_rate cfpb_dispute_rate,
    c.severity_avg cfpb_severity_avg, c.complaints_index cfpb_complaints_index,
    c.response_quality_index cfpb_response_quality_index,
    coalesce((t.min_sample_size_met or r.min_sample_size_met) and (g.min_sample_size_met or c.min_sample_size_met), false) min_sample_size_met,
    coalesce(t.anomaly_flag or r.anomaly_flag or g.anomaly_flag or c.anomaly_flag, false) anomaly_flag
  from spine s left join names n using (brand_id)
  left join tw_day t using (brand_id, date, country) left join rd_day r using (brand_id, date, country)
  left join {trends} g using (brand_id, date, country) left join cf_day c using (brand_id, date, country)),
metrics as (
  select * exclude (tv, ti, rv, ri),
    case when twitter_posts > 0 and reddit_messages > 0
        then (tv * twitter_posts + rv * reddit_messages) / (twitter_posts + reddit_messages)
      when twitter_posts > 0 then tv when reddit_messages > 0 then rv end social_volume_index,
    case when ti is not null and ri is not null
        then (ti * twitter_posts + ri * reddit_messages) / nullif(twitter_posts + reddit_messages, 0)
      else coalesce(ti, ri) end social_sentiment_index, true data_freshness_ok
  from side)"""


METRIC_OUT = f"""brand_id, brand_name, date, country, twitter_posts, twitter_authors, twitter_engagements,
  reddit_messages, reddit_authors, reddit_score_sum, cfpb_complaints,
  {rounded('twitter_sentiment_avg', 'reddit_sentiment_avg', 'trends_rsv_avg', 'trends_brand_rsv_avg',
'trends_category_rsv_avg', 'trends_7d_change', 'trends_28d_change', 'cfpb_timely_rate', 'cfpb_dispute_rate',
'cfpb_severity_avg', 'social_volume_index', 'social_sentiment_index', 'trends_visibility_index',
'cfpb_complaints_index', 'cfpb_response_quality_index', 'twitter_toxicity_rate', 'reddit_toxicity_rate')},
  min_sample_size_met, anomaly_flag, data_freshness_ok"""
METRICS = metrics_ctes("tr_one")
SQL["brand_daily_metrics"] = with_(METRICS) + f"select {METRIC_OUT} from metrics"
SQL["brand_daily_metrics_by_region"] = with_(metrics_ctes("tr_day")) + f"select {METRIC_OUT} from metrics"

SCORE = METRICS + """,
parts as (
  select *, coalesce(social_sentiment_index, 50) social_score, coalesce(trends_visibility_index, 50) search_score,
    coalesce(cfpb_complaints_index, 50) complaints_score from metrics),
raw_score as (
  select *, round(0.3::double * social_score + 0.2::double * search_score + 0.25::double * complaints_score
    + 0.15::double * 50 + 0.1::double * 50, 9) raw from parts),
placed as (
  select *, least(100, greatest(0, raw)) composite_score,
    rank() over (partition by date, country order by raw desc) composite_rank,
    percent_rank() over (partition by date, country order by raw) * 100 composite_percentile,
    lag(raw, 7) over (partition by brand_id, country order by date) b7,
    lag(raw, 28) over (partition by brand_id, country order by date) b28 from raw_score),
scored as (
  select *, case when b7 > 0 then (composite_score - b7) / b7 * 100 end change_7d,
    case when b28 > 0 then (composite_score - b28) / b28 * 100 end change_28d from placed)"""
SQL["composite_score"] = with_(SCORE) + f"""
select brand_id, brand_name, date, country, {rounded('composite_score')}, composite_rank::int composite_rank,
  {rounded('composite_percentile', 'social_score', 'search_score', 'complaints_score')},
  50.0::double reviews_customer_score, 50.0::double reviews_employee_score, 0.3::double w_social, 0.2::double w_search,
  0.25::double w_complaints, 0.15::double w_reviews_customer, 0.1::double w_reviews_employee,
  twitter_posts + reddit_messages social_volume, {rounded('trends_rsv_avg')}, cfpb_complaints, min_sample_size_met,
  anomaly_flag, data_freshness_ok, {rounded('change_7d', 'change_28d')},
  case when composite_score < 30 then 'High Risk' when composite_score < 50 then 'Medium Risk'
    when composite_score < 70 then 'Low Risk' else 'Healthy' end risk_category,
  case when change_7d < -10 then 'Declining' when change_7d > 10 then 'Improving' else 'Stable' end trend_direction,
  case when anomaly_flag then 'Anomaly detected - manual review recommended'
    when not min_sample_size_met then 'Insufficient data - interpret with caution'
    when composite_score < 25 then 'Critical score - immediate attention required'
    when abs(change_7d) > 20 then 'Significant change detected' end notes,
  'v1.0' calc_version
from scored"""
SQL["latest_scores"] = with_(SCORE) + f"""
select brand_id, date, country, {rounded('composite_score')}, composite_rank::int composite_rank from scored s
order by date desc, s.composite_score desc, brand_id, country limit 10"""
SQL["score_forecast"] = with_(SCORE) + f""",
fit as (
  select brand_id, country, regr_slope(composite_score, date_diff('day', DATE '1970-01-01', date)::double) m,
    regr_intercept(composite_score, date_diff('day', DATE '1970-01-01', date)::double) b, max(date) last_date
  from scored group by all)
select brand_id, country, last_date + k.k::int date, k.k::int days_ahead,
  {rnd("least(100, greatest(0, b + m * date_diff('day', DATE '1970-01-01', last_date + k.k::int)))", 5)} predicted
from fit, (select unnest(range(1, 15)) k) k where m is not null and not isnan(m)"""

# ------------------------------------------------------------------ reviews
_K = "c_custkey"
RV = f"""rv as (
  select {brand('c_nationkey')} brand_id, 'r' || {_K}::varchar review_id, c_mktsegment review_title, c_name pros,
    case when {_K} % 2 = 1 then 'too slow' end advice,
    ({_K} % 5 + 1)::double overall_rating, case when {_K} % 3 <> 0 then ({_K} % 4 + 1)::double end culture_values,
    case when {_K} % 4 in (0, 1) then 0.8::double end ceo_approval,
    (['current', 'former', 'intern', 'Contractor'])[({_K} % 4 + 1)::int] employment_status,
    case {_K} % 5 when 0 then strftime({day(_K)}, '%Y-%m-%dT00:00:00') when 1 then strftime({day(_K)}, '%Y-%m-%dT00:00:00')
      when 2 then strftime({day(_K)}, '%Y-%m-%dT10:11:12') when 3 then 'last week' end ts_event
  from customer)"""
SQL["normalised_reviews"] = with_(RV) + """
select brand_id, review_id, ts_event, overall_rating, culture_values, ceo_approval, employment_status, review_title,
  'Title: ' || review_title || ' | Pros: ' || pros || coalesce(' | Advice: ' || advice, '') review_text
from rv where ts_event is not null"""
SQL["undated_reviews"] = with_(RV) + "select brand_id, review_id from rv where ts_event is null"
RVI = RV + """,
rv_day as (
  select brand_id, try_cast(left(ts_event, 10) as date) as date, 'US' country, count(*) review_count,
    avg(overall_rating) rating_avg, avg(culture_values) culture_values, avg(ceo_approval) ceo_approval
  from rv where ts_event is not null group by all),
rv_ix as (
  select *, least(100, greatest(0, ((rating_avg + coalesce(culture_values, 0))
    / (1 + (culture_values is not null)::int) - 1) / 4 * 100)) employee_review_index from rv_day)"""
SQL["review_index"] = with_(RVI) + f"""
select brand_id, date, country, review_count, {rounded('rating_avg', 'culture_values', 'ceo_approval', 'employee_review_index')}
from rv_ix"""
SQL["four_part_score"] = with_(METRICS, RVI) + f""",
four as (
  select m.brand_id, m.date, m.country,
    0.5::double * coalesce(social_sentiment_index, 50) + 0.5::double * coalesce(social_volume_index, 50) social,
    coalesce(trends_visibility_index, 50) search, coalesce(cfpb_complaints_index, 50) complaints,
    0.6::double * 50 + 0.4::double * coalesce(employee_review_index, 50) reviews
  from metrics m left join rv_ix using (brand_id, date, country))
select brand_id, date, country, {rounded('social', 'search', 'complaints', 'reviews')},
  {rnd('least(100, greatest(0, 0.3::double * social + 0.2::double * search + 0.25::double * complaints + 0.25::double * reviews))')} composite_score
from four"""
SQL["approval_scaling"] = f"""
with a as (select l_discount * case when l_linenumber % 2 = 0 then 1000 else 1 end v from lineitem)
select approval, count(*) n from (
  select round(case when v between 0 and 1 then v when v <= 100 then v / 100 end, 6) + 0.0 approval from a) group by all"""

# --------------------------------------------------------------- clustering
UNI = f"""{RE},
{CE},
uni as (
  select event_id complaint_id, 'reddit' source_type, brand_id, text complaint_text, low, event_date complaint_date,
    sentiment, severity, array_to_string(topics, ',') topics, subreddit source_detail, author, score, text_length,
    is_complaint, case when severity > 0.7 then 'high' when severity > 0.3 then 'medium' else 'low' end severity_level,
    0.6::double nlp_confidence, geo_country
  from re_raw where is_complaint
  union all
  select complaint_id, 'cfpb', 'td_bank', complaint_text, low, complaint_date, null,
    case severity_level when 'high' then 0.8::double when 'medium' then 0.5::double else 0.2::double end,
    issue || ',' || sub_issue, product, null, null, text_length, true, severity_level, null, 'US' from ce_raw)"""
FLAGS = [(n, f"coalesce({words('low', w)}, false)::int") for n, w in S.FEATURES.words]
FLAGS += [(n, f"coalesce(regexp_matches(low, '{p}'), false)::int") for n, p in S.FEATURES.patterns]
FEAT = UNI + f""",
feat as (select *, {', '.join(f'{e} {n}' for n, e in FLAGS)} from uni)"""


def rule(features) -> str:
    return " and ".join(f"{f} = 1" for f in features) or "true"


_NAME = " ".join(f"when {rule(f)} then '{n}'" for f, n, _ in CLUSTER_RULES)
_TEXT = " ".join(f"when '{n}' then '{t}'" for _, n, t in CLUSTER_RULES)
_PRIO = " ".join(
    f"when {rule(f)}{f' and severity_level = {chr(39)}{s}{chr(39)}' if s else ''} then {p}" for f, s, p in PRIORITY_RULES
)
CLU = FEAT + f""",
named as (
  select *, case {_NAME} else '{CLUSTER_DEFAULT[0]}' end cluster_name, case {_PRIO} else 6 end cluster_priority,
    case severity_level when 'high' then 1.0::double when 'medium' then 0.5::double else 0.0::double end sev_number
  from feat),
clu as (select *, case cluster_name {_TEXT} else '{CLUSTER_DEFAULT[1]}' end cluster_description from named),
summ as (
  select cluster_name, cluster_description, cluster_priority, count(*) complaint_count,
    count(distinct complaint_date) days_with_complaints, avg(sev_number) avg_severity_score,
    count(*) filter (where source_type = 'reddit') reddit_complaints,
    count(*) filter (where source_type = 'cfpb') cfpb_complaints,
    min(complaint_date) first_complaint_date, max(complaint_date) last_complaint_date,
    array_to_string(list_sort(list_distinct(list(source_detail) filter (where source_detail is not null)))[1:10], ',') common_sources
  from clu group by cluster_name, cluster_description, cluster_priority)"""

SQL["unified_complaints"] = with_(UNI) + f"""
select complaint_id, source_type, brand_id, {hash16('complaint_text')} complaint_text, complaint_date,
  {rounded('sentiment', 'severity')}, topics, source_detail, author, score, text_length, is_complaint, severity_level,
  {rounded('nlp_confidence')}, geo_country from uni"""
_VECTOR = " || ',' || ".join(f"{n}::varchar" for n, _ in FLAGS)
SQL["complaint_text_features"] = with_(FEAT) + rf"""
select complaint_id, {hash16(r"trim(regexp_replace(regexp_replace(low, '[^a-zA-Z0-9\s]', ' ', 'g'), '\s+', ' ', 'g'))")} cleaned_hash,
  length(complaint_text)::int original_length, len(string_split(complaint_text, ' '))::int word_count,
  len(regexp_extract_all(complaint_text, '[.!?]'))::int sentence_count, {_VECTOR} feature_vector,
  ({' + '.join(n for n, _ in FLAGS)})::int feature_score from feat"""
_FIGURES = f"""s.complaint_count cluster_total_complaints, s.days_with_complaints cluster_days_active,
  {rnd('s.avg_severity_score')} cluster_avg_severity, s.reddit_complaints cluster_reddit_count,
  s.cfpb_complaints cluster_cfpb_count, s.first_complaint_date cluster_first_date,
  s.last_complaint_date cluster_last_date, s.common_sources cluster_common_sources"""
SQL["complaint_clusters"] = with_(CLU) + f"""
select c.complaint_id, c.source_type, c.cluster_name, c.cluster_description, c.cluster_priority, {_FIGURES}
from clu c join summ s using (cluster_name, cluster_description, cluster_priority)"""
SQL["complaint_clusters_by_name"] = with_(CLU) + f"""
select c.complaint_id, c.source_type, c.cluster_name, c.cluster_description, c.cluster_priority, {_FIGURES}
from clu c join summ s on c.cluster_name = s.cluster_name"""
SQL["cluster_summary"] = with_(CLU) + f"""
select * exclude (avg_severity_score), {rounded('avg_severity_score')} from summ"""

_MENTION = ("account", "card", "loan", "fee", "fraud", "service", "error")
DAYS = CLU + f""",
stat as (
  select complaint_date, cluster_name, cluster_description, cluster_priority, count(*) daily_complaint_count,
    count(distinct complaint_id) unique_complaints, avg(sev_number) avg_severity_score,
    count(*) filter (where source_type = 'reddit') reddit_count,
    count(*) filter (where source_type = 'cfpb') cfpb_count,
    {', '.join(f'sum({m}_terms)::bigint {m}_mentions' for m in _MENTION)}
  from clu group by complaint_date, cluster_name, cluster_description, cluster_priority),
ranked as (
  select *, row_number() over (partition by complaint_date, cluster_name, cluster_priority
    order by case severity_level when 'high' then 1 when 'medium' then 2 else 3 end, length(complaint_text) desc, complaint_id) place
  from clu),
samp as (
  select complaint_date, cluster_name, cluster_priority, count(*) sample_count,
    list(complaint_id order by place) sample_ids,
    string_agg(complaint_id || ':' || source_type || ':' || severity_level || ':' || source_detail || ':'
      || {hash16('substr(complaint_text, 1, 200)')}, '|' order by place) sample_complaints
  from ranked where place <= 5 group by complaint_date, cluster_name, cluster_priority),
dstat as (
  select stat.*, sample_count, sample_ids, sample_complaints
  from stat join samp using (complaint_date, cluster_name, cluster_priority)),
wk as (
  select date_trunc('week', complaint_date)::date week_start, cluster_name, cluster_description,
    sum(daily_complaint_count)::bigint weekly_complaint_count, avg(avg_severity_score) weekly_avg_severity,
    count(distinct complaint_date) days_active_in_week, min(complaint_date) first_complaint_in_week,
    max(complaint_date) last_complaint_in_week
  from dstat group by all),
dd as (
  select complaint_date, count(distinct cluster_name) daily_active_clusters,
    sum(daily_complaint_count)::bigint total_daily_complaints, avg(avg_severity_score) overall_daily_severity,
    array_to_string(list(cluster_name || ':' || daily_complaint_count::varchar || ':' || sample_count::varchar
      order by daily_complaint_count desc, avg_severity_score desc, cluster_name, cluster_priority)[1:10], '|') daily_cluster_ranking
  from dstat group by complaint_date)"""
_DS = f"""d.complaint_date, d.cluster_name, d.cluster_description, d.cluster_priority, d.daily_complaint_count,
  d.unique_complaints, {rnd('d.avg_severity_score')} avg_severity_score, d.reddit_count, d.cfpb_count,
  {', '.join(f'd.{m}_mentions' for m in _MENTION)}, d.sample_complaints"""
SQL["daily_cluster_stats"] = with_(DAYS) + f"select {_DS} from dstat d"
SQL["daily_complaint_trends"] = with_(DAYS) + f"""
select {_DS}, wk.week_start, daily_active_clusters::int daily_active_clusters, total_daily_complaints,
  {rounded('overall_daily_severity')}, daily_cluster_ranking, (dayofweek(d.complaint_date) + 1)::int day_of_week,
  dayname(d.complaint_date) day_name, weekly_complaint_count, {rounded('weekly_avg_severity')},
  days_active_in_week::int days_active_in_week
from dstat d left join dd using (complaint_date)
left join wk on wk.week_start = date_trunc('week', d.complaint_date)::date and wk.cluster_name = d.cluster_name"""
SQL["weekly_complaint_trends"] = with_(DAYS) + f"""
select * exclude (weekly_avg_severity), {rounded('weekly_avg_severity')} from wk"""
SQL["dashboard_summary"] = with_(DAYS) + f""",
recent as (select * from dstat where complaint_date >= DATE '{S.AS_OF}' - 30),
last_day as (
  select *, max(complaint_date) over (partition by cluster_name, cluster_description, cluster_priority) latest from recent),
tsum as (
  select cluster_name, cluster_description, cluster_priority, count(distinct complaint_date) days_active,
    sum(daily_complaint_count)::bigint total_complaints, avg(daily_complaint_count) avg_daily_complaints,
    avg(avg_severity_score) avg_severity, max(daily_complaint_count) peak_daily_complaints,
    min(complaint_date) first_seen, max(complaint_date) last_seen,
    coalesce(sum(daily_complaint_count) filter (where complaint_date >= latest - 7), 0) / 7.0::double now_rate,
    coalesce(sum(daily_complaint_count) filter (where complaint_date < latest - 7), 0)
      / greatest(count(distinct complaint_date) - 7, 1)::double old_rate,
    array_to_string(list(complaint_date::varchar || ':' || daily_complaint_count::varchar || ':' || sample_count::varchar
      order by complaint_date desc)[1:7], '|') recent_daily_samples
  from last_day group by cluster_name, cluster_description, cluster_priority),
dsum as (
  select complaint_date, sum(daily_complaint_count)::bigint total, count(distinct cluster_name) active,
    avg(avg_severity_score) severity,
    array_to_string(list(cluster_name || ':' || daily_complaint_count::varchar || ':' || array_to_string(sample_ids[1:3], '+')
      order by daily_complaint_count desc, cluster_name, cluster_priority)[1:3], '|') top
  from recent group by complaint_date order by complaint_date desc limit 30)
select 'cluster_summary' report_type, TIMESTAMP '{S.AS_OF}' generated_at, cluster_name, cluster_description,
  cluster_priority, days_active, total_complaints, {rounded('avg_daily_complaints', 'avg_severity')},
  peak_daily_complaints, first_seen, last_seen,
  case when days_active < 7 then 'insufficient_data' when now_rate > old_rate * 1.2::double then 'increasing'
    when now_rate < old_rate * 0.8::double then 'decreasing' else 'stable' end trend_direction,
  recent_daily_samples, null::date complaint_date, null::bigint daily_total_complaints,
  null::bigint daily_active_clusters, null::double daily_overall_severity, null::varchar daily_top_clusters
from tsum
union all
select 'daily_summary', TIMESTAMP '{S.AS_OF}', null, null, null, null, null, null, null, null, null, null, null, null,
  complaint_date, total, active, {rnd('severity')}, top from dsum"""

# ---------------------------------------------------------- serving queries
OVER = CLU + """,
over_ as (
  select cluster_name, cluster_description, cluster_priority, complaint_count total_complaints,
    days_with_complaints days_active, avg_severity_score, reddit_complaints, cfpb_complaints,
    first_complaint_date first_seen, last_complaint_date last_seen from summ)"""
SQL["cluster_overview"] = with_(OVER) + f"""
select * exclude (avg_severity_score), {rounded('avg_severity_score')},
  round(total_complaints / max(total_complaints) over () * 100, 1) relative_volume_pct,
  case cluster_priority when 1 then 'Critical' when 2 then 'High' when 3 then 'Medium' else 'Low' end priority_label,
  case when avg_severity_score > 0.7 then 'high' when avg_severity_score > 0.4 then 'medium' else 'low' end severity_band,
  round(avg_severity_score * 100, 1) severity_pct from over_"""
SQL["kpi_tiles"] = with_(OVER) + f"""
select sum(total_complaints)::bigint total_complaints,
  coalesce(sum(total_complaints) filter (where cluster_priority = 1), 0)::bigint critical_complaints,
  count(*) filter (where cluster_priority = 1) critical_clusters, {rnd('avg(avg_severity_score)')} avg_severity,
  max(days_active) active_days from over_"""
SQL["overview_totals"] = with_(OVER) + """
select count(*) total_clusters, count(*) filter (where cluster_priority = 1) critical_issues,
  sum(reddit_complaints)::bigint reddit_posts, sum(cfpb_complaints)::bigint cfpb_reports from over_"""
SQL["trend_rows"] = with_(DAYS) + f"""
select complaint_date, cluster_name, cluster_description, daily_complaint_count, {rounded('avg_severity_score')},
  reddit_count, cfpb_count, sample_count::int sample_complaints, round(avg_severity_score * 100)::bigint severity_percentage
from dstat"""
SQL["date_rollup"] = with_(DAYS) + """
select complaint_date, sum(daily_complaint_count)::bigint total_count, sum(reddit_count)::bigint reddit_count,
  sum(cfpb_count)::bigint cfpb_count from stat group by complaint_date"""
_DIST = """select replace(cluster_name, '_', ' ') as name, sum(daily_complaint_count)::bigint as value, cluster_name
from stat group by cluster_name"""
SQL["cluster_distribution"] = with_(DAYS) + _DIST
SQL["top_categories"] = with_(DAYS) + _DIST + " order by value desc, cluster_name limit 5"
_SAMPLES = f"""
select r.complaint_id, r.source_type, r.severity_level, r.source_detail, r.complaint_date, r.cluster_name,
  r.cluster_description, {rnd('s.avg_severity_score')} avg_severity_score
from ranked r join stat s using (complaint_date, cluster_name, cluster_priority) where place <= 5"""
_ORDER = " order by r.complaint_date desc, case r.severity_level when 'high' then 3 when 'medium' then 2 else 1 end desc, r.cluster_name, r.complaint_id"
SQL["newest_samples"] = with_(DAYS) + _SAMPLES + _ORDER + " limit 15"
SQL["newest_grave_samples"] = with_(DAYS) + _SAMPLES + " and r.severity_level = 'high'" + _ORDER + " limit 5"
SQL["complaint_page"] = with_(CLU) + """
select complaint_id, source_type, complaint_date, severity_level, cluster_name from clu
where cluster_name = 'general_complaints'
order by complaint_date desc, case severity_level when 'high' then 3 when 'medium' then 2 else 1 end desc, complaint_id
limit 10 offset 10"""
SQL["complaint_page_envelope"] = with_(CLU) + """
select 2 page, 50 page_size, count(*) total_count, ceil(count(*) / 50.0)::bigint total_pages,
  2 < ceil(count(*) / 50.0) has_next_page, true has_previous_page from clu"""
_NEWEST = "complaint_date desc nulls last, case severity_level when 'high' then 3 when 'medium' then 2 when 'low' then 1 else 0 end desc, complaint_id nulls first"
SQL["complaint_places"] = with_(CLU) + f"""
select complaint_id, cluster_name, place, ((place + 49) // 50)::bigint page
from (select complaint_id, cluster_name, row_number() over (partition by cluster_name order by {_NEWEST}) place from clu)"""
SQL["complaint_last_page"] = with_(CLU) + f"""
select complaint_id, source_type, complaint_date, severity_level, cluster_name
from (select *, row_number() over (order by {_NEWEST}) place, count(*) over () total from clu)
where place > (total - 1) // 50 * 50"""
SQL["complaint_severity_counts"] = with_(CLU) + """
select count(*) filter (where severity_level = 'high') as high, count(*) filter (where severity_level = 'medium') as medium,
  count(*) filter (where severity_level = 'low') as low from clu"""

# ------------------------------------------------------------------ ingest
SQL["event_identity"] = f"""
select case when turn = 0 then 'reddit_t3_' when role = 'user' then 'reddit_t1_' else 'reddit_' || role || '_' end
  || conv_id::varchar || '_' || turn::varchar event_id, {hash16('text')} content_hash from conversations"""

_TERMS = ", ".join(
    f"({i}, '{b}', '{t}', '{t.lower()}')" for i, (b, ts) in enumerate(S.MENTION_TERMS.items()) for t in ts
)
_ALNUM = r"'[\p{L}\p{N}]'"
HITS = rf"""terms(ord, brand_id, term, low) as (values {_TERMS}),
docs as (select doc_id, text, lower(text) body from documents where length(trim(text)) >= 2),
cut as (
  select doc_id, ord, brand_id, term, t.low, text, body, string_split(body, t.low) p from docs, terms t where contains(body, t.low)),
hit as (
  select doc_id, ord, brand_id, term, text, length(term) n, i.i,
    (list_sum(list_transform(p[1:i.i], lambda q: length(q))) + (i.i - 1) * length(low))::bigint as position,
    case when p[i.i] <> '' then right(p[i.i], 1) when i.i > 1 then right(low, 1) else '' end before_,
    case when p[i.i + 1] <> '' then left(p[i.i + 1], 1) when i.i < len(p) - 1 then left(low, 1) else '' end after_
  from cut, lateral (select unnest(range(1, len(p))) i) i),
edge as (select *, not (regexp_matches(before_, {_ALNUM}) or regexp_matches(after_, {_ALNUM})) edged from hit),
kept as (select * from edge where edged or n > 3),
per as (
  select doc_id, ord, brand_id, count(distinct term) uniq, count(*) found, count(*) filter (where edged) edges,
    list_sort(list_distinct(list(term))) terms from kept group by doc_id, ord, brand_id),
conf as (
  select *, least(1, uniq / 3) * 0.4::double + (edges * 1.0::double + (found - edges) * 0.7::double) / found * 0.4::double
    + least(1, list_sum(list_transform(terms, lambda t: length(t))) / uniq / 10) * 0.2::double score from per),
best as (
  select * from (select *, row_number() over (partition by doc_id order by round(score, 12) desc, ord) place from conf) where place = 1)"""
SQL["mention_detection"] = with_(HITS) + f"""
select d.doc_id, b.brand_id mention_brand, coalesce(array_to_string(b.terms, ','), '') matched_terms,
  {rnd('coalesce(b.score, 0)')} mention_score, coalesce(b.found, 0)::int match_count
from documents d left join best b using (doc_id)"""
SQL["mention_acceptance"] = with_(HITS) + f"""
select doc_id, {rnd('score')} confidence_score, found::int match_count from best where brand_id = 'jpm' and score > 0.3"""
SQL["mention_positions"] = with_(HITS) + f"""
select k.doc_id, k.brand_id mention_brand, k.term, count(*) hits, count(*) filter (where edged) edged,
  min(position)::int first_position, max(position)::int last_position, sum(position)::bigint position_sum,
  sum(least(length(text), position + n + 20) - greatest(0, position - 20))::bigint context_chars,
  {rnd('avg(case when edged then 1.0::double else 0.7::double end)')} confidence
from kept k join best b on b.doc_id = k.doc_id and b.brand_id = k.brand_id group by k.doc_id, k.brand_id, k.term"""
SQL["simple_mentions"] = "select doc_id, lang from documents where contains(lower(text), 'anon') or contains(lower(text), 'eau')"
_COVER = contains("lower(text)", [w.lower() for w in COVERAGE_WORDS])
SQL["keyword_coverage"] = f"""
select count(*) samples, count(*) filter (where {_COVER}) matched,
  {rnd(f'count(*) filter (where {_COVER}) * 100.0 / count(*)')} coverage_pct,
  case when count(*) filter (where {_COVER}) * 100.0 / count(*) >= 90 then 'excellent'
    when count(*) filter (where {_COVER}) * 100.0 / count(*) >= 75 then 'good' else 'needs improvement' end band
from documents"""
SQL["keyword_hits"] = f"""
select keyword, count(*) texts from documents, (select unnest({listed(COVERAGE_WORDS)}) keyword)
where contains(lower(text), lower(keyword)) group by keyword"""
SQL["keyword_suggestions"] = """
select suggestion, count(*) texts
from documents, (select unnest(['The', 'Ering', 'Onen', 'Les', 'Ontion']) suggestion)
where contains(lower(text), 'er') and not regexp_matches(lower(text), 'anon|eau|und') and contains(lower(text), lower(suggestion))
group by suggestion"""
SQL["normalised_messages"] = rf"""
with m as (
  select *, conv_id::varchar || '_' || turn::varchar id, regexp_replace(
      case when turn = 0 then substr(text, 1, 30) || chr(10) || chr(10) || case when conv_id % 4 <> 0 then text else '' end
      else text end, '^\s+|\s+$', '', 'g') body
  from conversations)
select case when turn = 0 then 'reddit_t3_' else 'reddit_t1_' end || id event_id,
  {day('conv_id')}::timestamp + to_minutes(turn) ts_event, {brand('conv_id')} brand_id, length(body)::int chars,
  {hash16('body')} content_hash, case when role = 'system' then '[deleted]' else role end author,
  case when turn = 0 then 'post' else 'comment' end kind, 'https://reddit.com/r/' || conv_id::varchar permalink,
  case when turn > 0 then 't3_' || conv_id::varchar end parent_id, 'false' edited from m"""
SQL["first_comments"] = """
select conv_id, turn, role from (
  select *, row_number() over (partition by conv_id order by turn) place from conversations where turn > 0) where place <= 3"""
_EXACT = " ".join(
    f"when upper(s_name) in ({', '.join(repr(n.upper()) for n in names)}) then '{b}'" for b, names in SUPPLIER_BRANDS
)
_LOOSE = " ".join(
    "when " + " or ".join(f"contains(upper(s_name), '{n.upper()}') or contains('{n.upper()}', upper(s_name))" for n in names) + f" then '{b}'"
    for b, names in SUPPLIER_BRANDS
)
SQL["company_brands"] = f"select s_suppkey, case {_EXACT} {_LOOSE} end brand_id from supplier"
SQL["normalised_complaints"] = with_(CF) + f""",
known as (
  select *, 'Bank of ' || state company,
    case when state = 'NATION_1' then 'one' when state = 'NATION_2' or state = 'NATION_3' then 'two'
      when contains(upper('Bank of ' || state), 'BANK OF NATION_1') then 'one'
      when contains(upper('Bank of ' || state), 'NATION_2') then 'two' end owner from cf)
select 'cfpb_' || complaint_id event_id,
  case when consumer_disputed then TIMESTAMP '{S.RUN_TS}' else date::timestamp end ts_event, owner brand_id,
  {hash16('complaint_id')} content_hash,
  {hash16("'Issue: ' || issue || coalesce(' | Sub-issue: ' || sub_issue, '') || coalesce(' | Complaint: ' || nullif(narrative, ''), '') || ' | Product: ' || product")} text_hash,
  state from known where owner is not null"""
SQL["flattened_tweets"] = f"""
select {brand('e.user_id')} brand_id, e.event_id::varchar tweet_id, e.ts ts_event, e.user_id + 10 author_id,
  c.c_name author_username, coalesce(c.c_acctbal > 0, false) author_verified, c.c_mktsegment author_location,
  e.event_type as text, 'en' lang, e.event_id % 7 like_count, e.event_id % 5 reply_count, e.event_id % 3 retweet_count,
  e.event_id % 2 quote_count, e.event_type = 'error' possibly_sensitive, n.n_name geo_country,
  case when e.user_id % 3 <> 0 then e.user_id % 40 end geo_place_id, TIMESTAMP '{S.RUN_TS}' collected_at
from events e left join customer c on c.c_custkey = e.user_id + 10
left join nation n on n.n_nationkey = case when e.user_id % 3 <> 0 then e.user_id % 40 end"""
SQL["trend_terms"] = f"""
with b as (select distinct p_brand from part)
select p_brand brand_id, unnest([p_brand, p_brand || ' Inc']) keyword, 'brand' keyword_type, true is_brand_keyword from b
union all select p_brand, unnest({listed(TREND_CATEGORIES)}), 'category', false from b
union all select p_brand, p_brand || ' ' || unnest({listed(TREND_COMBINATIONS)}), 'brand_category', true from b
union all select p_brand, unnest({listed(TREND_COMBINATIONS)}) || ' ' || p_brand, 'category_brand', true from b"""
SQL["related_queries"] = with_(TR) + """,
pts as (select brand_id, keyword, sum(value)::bigint as value from tr group by all),
rel as (select p_brand keyword, array_to_string(list(p_name order by p_partkey)[1:5], ',') related_queries_top from part group by all)
select * from pts left join rel using (keyword)"""
SQL["trending_searches"] = with_(TR) + """
select geo, query, place::int rank from (
  select geo, keyword query, row_number() over (partition by geo order by sum(value) desc, keyword) place
  from tr group by geo, keyword) where place <= 20"""

# ------------------------------------------------- versions, merges, cursors
LATEST = EV + """,
latest as (
  select * exclude (place) from (
    select *, row_number() over (partition by event_id order by nlp_processed_at desc nulls last, ts_event desc,
      created_utc desc nulls last) place from ev) where place = 1)"""
SQL["latest_versions"] = with_(LATEST) + f"select * exclude (value), {rounded('value')} from latest"
_COUNTS = "count(*) total_rows, count(distinct event_id) unique_events, count(*) - count(distinct event_id) duplicate_count"
SQL["duplicate_audit"] = with_(LATEST) + f"""
select 'Original' table_name, {_COUNTS} from ev union all select 'Deduplicated', {_COUNTS} from latest"""
SQL["duplicate_rate"] = with_(EV) + f"""
select *, round(duplicate_count * 100 / total_rows, 2) duplicate_percentage,
  round(duplicate_count * 100 / total_rows, 2) > 5 alert from (select {_COUNTS} from ev)"""
SQL["most_duplicated"] = with_(EV) + """
select event_id, count(*) copies from ev group by event_id having count(*) > 1"""
_INCOMING = """select event_id, ts ts_event, case when event_type = 'error' then ts + interval 1 hour end edited,
    'again' as text, round(value, 6) as value from events where event_type in ('signup', 'error', 'click')"""
SQL["insert_only_new"] = f"""
with incoming as ({_INCOMING})
select i.* from incoming i where i.event_id not in (select event_id from events where event_type <> 'signup')"""
SQL["merge_events"] = f"""
with incoming as ({_INCOMING}),
stored as (select event_id, ts ts_event, null::timestamp edited, event_type as text, round(value, 6) as value
  from events where event_type <> 'signup'),
wins as (
  select i.* from incoming i left join stored s using (event_id)
  where s.event_id is null or coalesce(i.edited, i.ts_event) > coalesce(s.edited, s.ts_event))
select * from wins union all select s.* from stored s anti join wins w using (event_id)"""
SQL["merge_trends"] = with_(TR) + """,
a as (select brand_id, keyword, geo, date, max(value) as value, 'a' load from tr where value < 60 group by all),
b as (select brand_id, keyword, geo, date, max(value) as value, 'b' load from tr where value >= 40 group by all),
m as (select * from b union all select a.* from a anti join b using (brand_id, keyword, geo, date))
select brand_id, keyword, geo, strftime(date, '%Y-%m-%dT08:15:00') ts_event, value, load from m"""
STATE = """st as (
  select 'reddit_' || event_type source, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') cursor_iso, event_id::varchar tie_breaker_id,
    ts + to_minutes(user_id) updated_at, ts from events),
cur as (
  select * exclude (place) from (select *, row_number() over (partition by source
    order by updated_at desc, cursor_iso desc, tie_breaker_id desc) place from st) where place = 1)"""
SQL["ingest_state"] = with_(STATE) + "select source, cursor_iso, tie_breaker_id, updated_at from cur"
SQL["fetch_cutoffs"] = f"""
select event_id, case when user_id % 5 = 0 then epoch(TIMESTAMP '{S.RUN_TS}')::bigint - 7 * 86400
  when user_id % 3 = 0 and user_id > 0 then greatest(user_id * 100 - 7200, 0)
  when user_id % 3 = 1 then floor(epoch(ts))::bigint - 7200
  else epoch(TIMESTAMP '{S.RUN_TS}')::bigint - 7 * 86400 end cutoff from events"""
SQL["cursor_advance"] = with_(STATE) + f""",
acc as (
  select 'reddit_' || event_type source, event_id::varchar native_id, date_trunc('second',
    case when event_type = 'click' then ts - interval 60 day
    when event_type in ('signup', 'purchase') then TIMESTAMP '2024-01-05 00:00:00.25' else ts + interval 5 hour end) t from events),
top as (select source, max(t) t, arg_max(native_id, (t, native_id)) native_id from acc group by source),
had as (
  select source, cursor_iso, tie_breaker_id from cur where source in ('reddit_view', 'reddit_error', 'reddit_click')
  union all select 'reddit_' || event_type, '2024-01-05T00:00:00Z',
    case when event_type = 'signup' then min(event_id::varchar) else max(event_id::varchar) end
  from events where event_type in ('signup', 'purchase') group by event_type)
select top.source, strftime(t, '%Y-%m-%dT%H:%M:%SZ') cursor_iso, native_id tie_breaker_id,
  TIMESTAMP '{S.RUN_TS}' updated_at
from top left join had using (source)
where had.source is null or t > strptime(cursor_iso, '%Y-%m-%dT%H:%M:%SZ')
  or (t = strptime(cursor_iso, '%Y-%m-%dT%H:%M:%SZ') and native_id > tie_breaker_id)"""
SQL["run_report"] = with_(RE) + """
select count(*) total_records, count(distinct event_date) files_saved,
  array_to_string(list_sort(list_distinct(list(brand_id))), ',') brands_found from re"""

# -------------------------------------------------------------- enrichment
_URL = URL_PATTERN.replace("'", "''")


def enrich_ctes(source: str) -> str:
    e = ENRICH
    count = lambda ws: " + ".join(f"contains(low, '{w}')::int" for w in ws)
    topics = ", ".join(
        f"case when contains(low, '{t.replace('_', ' ')}') or contains(low, '{t}') then '{t}' end" for t in e.topics
    )
    return rf"""clean as (
  select *, trim(regexp_replace(regexp_replace(coalesce(body, ''), '{_URL}', '', 'g'), '\s+', ' ', 'g')) c from ({source})),
lowered as (select *, lower(c) low, length(c) < 10 short from clean),
counted as (
  select *, {count(e.positive)} pos, {count(e.negative)} neg, {count(e.severe)} sev,
    list_filter([{topics}], lambda t: t is not null)[1:3] tops from lowered),
enriched as (
  select *, case when short then 0.0 when pos > neg then least(0.8, pos * 0.2::double)
      when neg > pos then greatest(-0.8, neg * -0.2::double) else 0.0 end::double sentiment,
    case when short then 0.0 else least(0.8, sev * 0.3::double) end::double severity,
    case when short then '' else array_to_string(tops, ',') end topics,
    case when short then 0.0 else 0.6 end::double nlp_confidence from counted)"""


SQL["enriched_texts"] = with_(enrich_ctes("select doc_id, text body from documents")) + f"""
select doc_id, {rounded('sentiment', 'severity')}, topics, 'en' language, {rounded('nlp_confidence')},
  'lexicon' nlp_model, 'v1.0' nlp_version, TIMESTAMP '{S.RUN_TS}' nlp_processed_at, null::varchar nlp_error from enriched"""
SQL["enriched_messages"] = with_(enrich_ctes(
    """select conv_id::varchar || '_' || turn::varchar id, case when turn = 0
      then substr(text, 1, 30) || chr(10) || chr(10) || case when conv_id % 4 <> 0 then text else '' end
      when conv_id % 4 <> 0 then text else '' end body from conversations""")) + f"""
select id, {rounded('sentiment', 'severity')}, topics, {rounded('nlp_confidence')} from enriched"""
SQL["plugged_scorer"] = with_(enrich_ctes("select conv_id, turn, text body from conversations")) + f"""
select conv_id, turn, {rnd('(length(c) % 11 - 5) / 5.0')} sentiment, {rnd('(length(c) % 7) / 7.0')} severity,
  case when length(c) > 500 then 'long' else '' end topics, 'en' language, 0.9::double nlp_confidence,
  null::varchar nlp_error, 'length' nlp_model, 'v2' nlp_version, TIMESTAMP '{S.RUN_TS}' nlp_processed_at from clean"""
SQL["parsed_responses"] = f"""
select event_id, case when ok then least(1, greatest(-1, value)) else 0 end::double sentiment,
  {rnd('case when ok then least(1, greatest(0, 1 - value / 100)) else 0 end')} severity,
  case when ok then 'a,b,c' else '' end topics, 'en' language,
  case when not ok then 0.0 when event_type = 'click' then 0.5 else 0.25 end::double confidence
from (select *, event_type <> 'view' ok from events)"""
_REDACT = "text"
for _p, _r in (
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "[EMAIL]"),
    (r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", "[SSN]"),
    (r"\b[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}\b", "[CARD]"),
    (r"\b[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}\b", "[PHONE]"),
):
    _REDACT = f"regexp_replace({_REDACT}, '{_p}', '{_r}', 'g')"
SQL["redacted_documents"] = f"""
select doc_id, {hash16('clean')} text_hash, length(clean)::int chars from (select doc_id, {_REDACT} clean from documents)"""


# --------------------------------------------------------------- retrieval
def word_list(text: str) -> str:
    """Lower-case words but stop words."""
    word = r"regexp_extract_all(lower({t}), '[\p{{L}}\p{{N}}]+')".format(t=text)
    return f"list_filter({word}, lambda w: not list_contains({listed(ENGLISH_STOP_WORDS)}, w))"


def token_list(text: str) -> str:
    stem = "regexp_replace(regexp_replace(regexp_replace(w, '([^ae])ies$', '\\1y'), '([^aeo])es$', '\\1e'), '([^us])s$', '\\1')"
    return f"list_transform({word_list(text)}, lambda w: {stem})"


SQL["analysed_tokens"] = f"""
select doc_id, len(t)::int token_count, {hash16("array_to_string(t, ' ')")} token_hash
from (select doc_id, {token_list('text')} t from documents)"""
SQL["stemmed_tokens"] = f"""
with listed as (select doc_id, {word_list('text')} t from documents),
placed as (select doc_id, unnest(t) w, generate_subscripts(t, 1) i from listed),
words as (select distinct w from placed),
{stems('words')},
joined as (select doc_id, string_agg(stem, ' ' order by i) t from placed join stems using (w) group by doc_id)
select doc_id, len(listed.t)::int token_count, {hash16("coalesce(joined.t, '')")} token_hash
from listed left join joined using (doc_id)"""
SQL["search_extract"] = with_(RE) + f"""
select event_id, brand_id, 'reddit' source, ts_event, {rounded('sentiment', 'severity')}, array_to_string(topics, ',') topics,
  0.6::double nlp_confidence, 'lexicon' nlp_model, geo_country, {hash16('text')} content_hash, subreddit, author,
  '/r/' || split_part(replace(replace(event_id, 'reddit_t3_', ''), 'reddit_t1_', ''), '_', 1) url, score, num_comments
from re where length(text) > 10"""


def bm25(*terms: str, n: str = "") -> str:
    """Scores of the search table for stemmed terms."""
    tf = ", ".join(f"len(list_filter(toks, lambda w: w = '{t}')) tf{i}" for i, t in enumerate(terms))
    df = ", ".join(f"count(*) filter (where tf{i} > 0) df{i}" for i in range(len(terms)))
    total = " + ".join(
        f"case when tf{i} > 0 then ln(1 + (n - df{i} + 0.5) / (df{i} + 0.5)) * tf{i} * 2.2 "
        f"/ (tf{i} + 1.2 * (1 - 0.75 + 0.75 * dl / mean)) else 0 end" for i in range(len(terms))
    )
    return f"""tok{n} as (select *, {token_list(_REDACT)} toks from se),
tf{n} as (select *, len(toks) dl, {tf} from tok{n}),
st{n} as (select count(*)::double n, avg(dl) mean, {df} from tf{n}),
bm{n} as (select tf{n}.*, ({total})::double score from tf{n}, st{n})"""


SQL["relevance_match"] = with_(SE, bm25("ering", "reon")) + f"""
select event_id, {rounded('score')} from bm where score > 0 order by bm.score desc, event_id limit 5"""
SQL["relevance_scores"] = with_(SE, bm25("eau", "ontion", "thou")) + f"""
select event_id, {rounded('score')} from bm where score > 0"""
SQL["filtered_match"] = with_(SE, bm25("ontion", "thou")) + f"""
select event_id, brand_id, {rounded('score')} from bm where score > 0 and brand_id = 'wf'
order by bm.score desc, event_id limit 5"""
SQL["postings_match"] = SQL["relevance_match"]
SQL["postings_scores"] = SQL["relevance_scores"]
SQL["newest_match"] = with_(SE, bm25("ontion")) + f"""
select event_id, ts_event, {rounded('score')} from bm where score > 0 and sentiment between -1 and 1
order by ts_event desc, event_id limit 3"""
SQL["sentiment_range"] = with_(SE) + f"""
select event_id, brand_id, {rounded('sentiment')} from se where sentiment between -1 and -0.5
order by se.sentiment, event_id limit 5"""
_EVID = f"""where score > 0 and brand_id in ('jpm', 'bac') and ts_event >= TIMESTAMP '2024-01-05'
  order by ev.sentiment asc nulls first, ev.severity desc, ev.score desc, event_id limit 10"""
_EVCOLS = f"event_id, brand_id, {rounded('sentiment', 'severity')}, ts_event, source, {rounded('score')}"
SQL["evidence_quotes"] = with_(SE, bm25("fr", n="1"), bm25("eau", "thou", n="2")) + f""",
topic as (select count(*)::double n, count(*) filter (where list_contains(topics, 'fr')) df from se),
ev1 as (select bm1.* exclude (score), greatest(bm1.score * 2, case when list_contains(topics, 'fr')
  then ln(1 + (topic.n - topic.df + 0.5) / (topic.df + 0.5)) else 0 end) score from bm1, topic),
ev2 as (select * exclude (score), score * 2 score from bm2)
select *, 'fr' asked from (select {_EVCOLS} from ev1 ev {_EVID})
union all select *, 'eau thou' asked from (select {_EVCOLS} from ev2 ev {_EVID})"""
SQL["search_facets"] = with_(SE) + f"""
select 'source' facet, source bucket, count(*) events, {rnd('avg(sentiment)')} avg_sentiment from se group by source
union all select 'brand_id', brand_id, count(*), {rnd('avg(sentiment)')} from se group by brand_id
union all select 'all', null, count(*), {rnd('avg(sentiment)')} from se"""
VEC = """qv as (
  select list(x order by i) v from (
    select i, avg(x) x from (select unnest(embedding)::double x, generate_subscripts(embedding, 1) i from embeddings where label = 3)
    group by i))"""
_COS = "list_cosine_similarity(({0})::double[], qv.v)"
SQL["nearest_vectors"] = with_(VEC) + f"""
select vec_id, label, {rounded('similarity')} from (
  select vec_id, label, {_COS.format('embedding')} similarity from embeddings, qv) s
order by s.similarity desc, vec_id limit 100"""
SQL["nearest_vectors_indexed"] = with_(VEC) + f"""
select vec_id, {rounded('similarity')} from (select vec_id, {_COS.format('embedding')} similarity from embeddings, qv) s
order by s.similarity desc, vec_id limit 100"""
SQL["hybrid_match"] = with_(SE, bm25("ering", "thou"), VEC) + f""",
near as (
  select event_id, (1 + {_COS.format('dense_vec')}) / 2 vector_score from se, qv
  where dense_vec is not null and ts_event >= TIMESTAMP '2024-01-06' order by 2 desc, event_id limit 100),
pair as (
  select bm.event_id, bm.score text_score, near.vector_score, bm.score + coalesce(near.vector_score, 0) total
  from bm left join near using (event_id) where ts_event >= TIMESTAMP '2024-01-06')
select event_id, {rounded('text_score', 'vector_score')}, {rnd('total')} score from pair where total > 0
order by total desc, event_id limit 20"""



def picks(limit: int) -> str:
    """The greedy pick written out: one best row per label and round, then the closest pick so far of the rest."""
    parts = ["""u0 as (
  select event_id, label, severity gain, null::double closest,
    list_transform(dense_vec::double[], lambda x: x / greatest(sqrt(list_dot_product(dense_vec::double[], dense_vec::double[])), 1e-12)) unit
  from se where dense_vec is not null)"""]
    for k in range(limit):
        parts.append(f"""p{k} as (
  select * from u{k} qualify row_number() over (partition by label
    order by round(0.7 * gain - 0.3 * coalesce(closest, 0), 9) desc, gain desc, event_id) = 1),
u{k + 1} as (
  select u.event_id, u.label, u.gain, greatest(u.closest, list_dot_product(u.unit, p.unit)) closest, u.unit
  from u{k} u join p{k} p on u.label = p.label and u.event_id <> p.event_id)""")
    return ",\n".join(parts)


SQL["diverse_quotes"] = with_(SE, picks(10)) + " union all ".join(
    f"select event_id, label, {k + 1}::int pick, {rnd('gain')} relevance from p{k}" for k in range(10)
)


def contrib(name: str, value: str, source: str) -> str:
    return f"""(select '{name}' dimension, {value} as value, count(*) filter (where event_date >= DATE '2024-01-20') as current,
    count(*) filter (where event_date < DATE '2024-01-20') as previous,
    count(*) filter (where event_date >= DATE '2024-01-20') - count(*) filter (where event_date < DATE '2024-01-20') delta
  from {source} where event_date between DATE '2024-01-13' and DATE '2024-01-26'
  group by 2 order by abs(delta) desc, 2 nulls first limit 10)"""


SQL["metric_contributors"] = with_(RE) + ",\ntopic_rows as (select event_date, unnest(topics) topic from re_raw)\n" + " union all ".join(
    (contrib("topic", "topic", "topic_rows"), contrib("geo_country", "geo_country", "re_raw"), contrib("source", "'reddit'", "re_raw"))
)

# ------------------------------------------------------- monitors, reports
SQL["top_states"] = with_(CE) + """
select state, count(*) complaints from ce_raw group by state order by complaints desc, state limit 10"""
SQL["complaint_mix"] = with_(UNI) + " union all ".join(
    f"""(select '{c}' dimension, {c} as value, count(*) complaints,
  {rnd('count(*) / sum(count(*)) over () * 100')} share_pct from uni group by {c})""" for c in ("source_type", "severity_level")
)
SQL["peak_days"] = with_(DAYS) + """,
by_c as (select complaint_date, cluster_name, sum(daily_complaint_count)::bigint n from stat group by all)
select complaint_date, sum(n)::bigint total_complaints,
  array_to_string(list(cluster_name || ':' || n::varchar order by n desc, cluster_name)[1:3], '|') top_clusters
from by_c group by complaint_date order by total_complaints desc, complaint_date limit 3"""
LOADED = f"""{TW},
{RD},
{TR},
{CF},
loaded as (
  select 'twitter' f, ts_event t from tw union all select 'reddit', date + TIME '08:15:00' from rd
  union all select 'trends', date + TIME '08:15:00' from tr union all select 'cfpb', date + TIME '08:15:00' from cf)"""
SQL["feed_freshness"] = with_(LOADED) + f"""
select f source_table, max(t) last_update, date_diff('hour', max(t), TIMESTAMP '{S.RUN_TS}') hours_since_update
from loaded group by f"""
SQL["feed_synced_today"] = with_(LOADED) + """
select f source, count(*) filter (where t::date = DATE '2024-01-15') rows_today,
  max(t) filter (where t::date = DATE '2024-01-15') last_sync from loaded group by f"""
SQL["topic_weeks"] = with_(RE) + f""",
t as (select unnest(topics) topic, date_trunc('week', event_date)::date week_start, severity from re_raw),
w as (select topic, week_start, count(*) volume, avg(severity) avg_severity from t group by all)
select topic, week_start, volume, {rounded('avg_severity')},
  {rnd('(volume - lag(volume) over (partition by topic order by week_start)) / lag(volume) over (partition by topic order by week_start) * 100')} wow_change_pct
from w"""
SQL["topic_shares"] = with_(RE) + f""",
t as (select brand_id, event_date as date, unnest(topics) topic from re_raw),
n as (select brand_id, date, topic, count(*) mentions from t group by all)
select *, {rnd('mentions / sum(mentions) over (partition by brand_id, date)')} topic_share from n"""
SQL["share_of_voice"] = with_(TR) + f"""
select brand_id, date, sum(value) filter (where keyword_type in ('brand_category', 'category_brand'))::bigint brand_category_searches,
  sum(value) filter (where keyword_type = 'category')::bigint category_searches,
  {rnd("sum(value) filter (where keyword_type in ('brand_category', 'category_brand')) / nullif(sum(value) filter (where keyword_type = 'category'), 0) * 100")} share_of_voice
from tr_raw group by brand_id, date"""
SQL["intent_tiers"] = with_(TR) + f"""
select brand_id, case keyword_type when 'brand' then 'low' when 'category' then 'medium' else 'high' end intent,
  sum(value)::bigint searches, {rnd('avg(value)')} avg_interest, count(*) points from tr_raw group by 1, 2"""
SQL["volume_alerts"] = with_(CF) + f""",
d as (select brand_id, date, count(*) complaints, avg(severity_score) severity from cf_raw group by all),
j as (select *, {pct('complaints', 'lag(complaints) over (partition by brand_id order by date)')} jump from d),
a as (select *, coalesce(jump >= 50, false) volume_alert, severity >= 0.7::double severity_alert from j)
select brand_id, date, complaints, {rounded('severity')}, {rnd('jump')} volume_change_pct, volume_alert, severity_alert
from a where volume_alert or severity_alert"""


# ------------------------------------------------------------ data quality
def checks(table: str, source: str, *pairs: tuple[str, str]) -> list[str]:
    return [f"select '{table}' table_name, '{name}' check_name, ({sql})::bigint failures from {source} limit 1"
            if sql.startswith("(select") else
            f"select '{table}' table_name, '{name}' check_name, count(*) filter (where {sql}) failures from {source}"
            for name, sql in pairs]


def nulls(**columns: str) -> list[tuple[str, str]]:
    return [(f"not_null:{c}", f"{x} is null") for c, x in columns.items()]


def repeats(table: str, *keys: str) -> tuple[str, str]:
    listed_keys = ", ".join(keys)
    where = f"where {keys[0]} is not null" if len(keys) == 1 else ""
    return (f"unique:{','.join(keys)}", f"(select count(*) from (select 1 from {table} {where} group by {listed_keys} having count(*) > 1))")


def report(ctes: str, parts: list[str]) -> str:
    body = " union all ".join(f"({p})" for p in parts)
    return with_(ctes) + f"select *, failures = 0 passed from ({body})"


SQL["quality_report"] = report(
    f"{TW},\n{RD},\n{TR},\n{CF}",
    checks("twitter_posts", "tw", *nulls(brand_id="brand_id", tweet_id="tweet_id", ts_event="ts_event", text="text",
                                         collected_at="ts_event"), repeats("tw", "tweet_id"))
    + checks("reddit_messages", "rd", *nulls(brand_id="brand_id", reddit_id="reddit_id", ts_event="date", type="type"),
             ("accepted_values:type", "type not in ('post', 'comment')"), repeats("rd", "reddit_id"))
    + checks("trends_timeseries", "tr", *nulls(brand_id="brand_id", keyword="keyword", ts_event="date", value="value"),
             ("accepted_range:value", "value not between 0 and 100"))
    + checks("cfpb_complaints", "cf", *nulls(brand_id="brand_id", complaint_id="complaint_id", ts_event="date"),
             ("accepted_range:severity_score", "severity_score not between 0 and 1"), repeats("cf", "complaint_id")),
)
SQL["quality_violations"] = report(
    EV,
    checks("event_versions", "ev", ("not_null:nlp_processed_at", "nlp_processed_at is null"),
           ("accepted_values:text", "text not in ('view', 'click', 'signup')"),
           ("accepted_range:value", "value < 1 or value > 100"), repeats("ev", "event_id"),
           repeats("ev", "event_id", "ts_event")),
)
SQL["score_quality"] = report(
    SCORE,
    checks("composite_score", "scored",
           *nulls(brand_id="brand_id", brand_name="brand_name", date="date", country="country",
                  composite_score="composite_score", composite_rank="composite_rank", calc_version="'v1.0'"),
           *[(f"accepted_range:{c}", f"{c} not between 0 and 100")
             for c in ("composite_score", "social_score", "search_score", "complaints_score")],
           ("accepted_values:risk_category", "false"), ("accepted_values:trend_direction", "false"),
           repeats("scored", "brand_id", "date", "country")),
)

# ------------------------------------------------------- storage, streaming
LAND = f"""land as (
  select 'reddit_t3_' || event_id::varchar event_id, date_trunc('millisecond', ts) ts_event, {brand('user_id')} brand_id,
    event_type as text, value from events)"""
SQL["landing_roundtrip"] = with_(LAND) + f"""
select event_id, ts_event, brand_id, text, {rounded('value')}, ts_event::date dt from land
where ts_event::date between DATE '2024-01-03' and DATE '2024-01-20'"""
SQL["brand_day_roundtrip"] = with_(LAND) + f"""
select ts_event::date as date, brand_id, count(*) n, {rnd('sum(value)')} total from land group by 1, 2"""
SQL["mart_roundtrip"] = with_(CFD) + f"""
select brand_id, date, country, complaints, {rounded('complaints_index')} from cf_day where date >= DATE '2024-01-20'"""
SQL["upserted_table"] = with_(LATEST) + f"""
select event_id, ts_event, nlp_processed_at, text, {rounded('value')} from latest"""
SQL["re_enriched_days"] = with_(RE, enrich_ctes(
    "select event_id, event_date, text body, sentiment s0, severity v0, length(text)::int chars from re")) + f"""
select event_id, {rnd("case when event_date between DATE '2024-01-10' and DATE '2024-01-12' then sentiment else s0 end")} sentiment,
  {rnd("case when event_date between DATE '2024-01-10' and DATE '2024-01-12' then severity else v0 end")} severity, chars from enriched
union all select event_id, null, null, null from re"""
KEPT = LAND.replace("date_trunc('millisecond', ts)", "ts")  # Parquet keeps the microseconds
SQL["upserted_ties"] = with_(KEPT) + f"""
select event_id, case when changed then ts_event + interval 1 second else ts_event end ts_event,
  case when changed then 'changed' else text end as text, {rounded('value')}
from (select *, value > 20 and regexp_extract(event_id, '[0-9]+$')::bigint % 2 = 1 changed from land)"""
SQL["appended_events"] = with_(KEPT) + f"select event_id, ts_event, brand_id, text, {rounded('value')} from land"
SQL["stream_deduplicated"] = with_(LAND) + f"select event_id, ts_event, brand_id, text, {rounded('value')} from land"
SQL["stream_upserted"] = with_(LAND) + f"select event_id, ts_event, brand_id, {rounded('value')} from land"
DAILY = LAND + """,
d as (select ts_event::date as date, brand_id, count(*) volume, avg(value) mean_value from land group by 1, 2)"""
SQL["stream_daily"] = with_(DAILY) + f"select date, brand_id, volume, {rounded('mean_value')} from d"
SQL["stream_rollup"] = with_(LAND) + """
select ts_event::date as date, brand_id, count(*) volume, count(value) valued, round(sum(value), 6) total_value,
  round(avg(value), 6) mean_value, round(stddev_samp(value), 6) stddev_value from land group by 1, 2"""
SQL["stream_alerts"] = with_(DAILY) + f"""
select d.date, d.brand_id, d.volume, p.volume previous_volume, {rnd('(d.volume - p.volume) / p.volume * 100')} change_pct
from d join d p on p.brand_id = d.brand_id and p.date = d.date - 1 where (d.volume - p.volume) / p.volume * 100 >= 50"""
SQL["landed_posts_in_range"] = with_(TW) + """
select tweet_id, brand_id, date, total_engagements, text_length from tw_raw
where date between DATE '2024-01-05' and DATE '2024-01-09'"""
SQL["dictionary_from_file"] = """
select lower(n_name) brand_id, n_name || ', Bank' brand_name, n_name || '|x, y' aliases, lower(n_name) || '.example' domains,
  substr(n_name, 1, 3) ticker, 'US' hq_country from nation"""
SQL["registered_sources"] = """
select event_type as name, count(*) n from events group by 1 union all select n_name, count(*) from nation group by 1"""
SQL["replaced_with_backup"] = with_(LATEST) + """
select text, count(*) n, 'table' stored from latest group by 1
union all select text, count(*), 'backup' from ev group by 1"""
SQL["daily_severity"] = with_(DAYS) + f"""
select complaint_date, sum(daily_complaint_count)::bigint total_daily_complaints,
  {rnd('avg(avg_severity_score)')} overall_daily_severity,
  {rnd('sum(daily_complaint_count * avg_severity_score) / sum(daily_complaint_count)')} weighted_daily_severity
from stat group by complaint_date"""
SQL["composite_score_calendar"] = SQL["composite_score"]
for _n in (7, 28):
    SQL["composite_score_calendar"] = SQL["composite_score_calendar"].replace(
        f"lag(raw, {_n}) over (partition by brand_id, country order by date)",
        f"max(raw) over (partition by brand_id, country order by date range between interval {_n} day preceding and interval {_n} day preceding)",
    )
