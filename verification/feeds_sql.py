"""The feed adapters as DuckDB common table expressions."""

from __future__ import annotations

import json  # noqa: F401

from pulsemart.sources import samples as S

DAY0, SPAN = S.DAY0, S.SPAN


def brand(x: str) -> str:
    listed = ", ".join(f"'{b}'" for b in S.BRAND_IDS)
    return f"([{listed}])[(case when ({x}) % 3 = 0 then 0 else ({x}) % 7 end)::int + 1]"


def day(x: str) -> str:
    return f"(DATE '{DAY0}' + (({x}) % {SPAN})::int)"


def country(x: str) -> str:
    return f"(case when ({x}) % 4 <= 1 then 'US' when ({x}) % 4 = 2 then 'CA' end)"


def rnd(x: str, digits: int = 9) -> str:
    return f"(round(({x})::double, {digits}) + 0.0)"


def words(col: str, listed) -> str:
    return rf"regexp_matches({col}, '\b({'|'.join(listed)})\b')"


def contains(col: str, listed) -> str:
    return "(" + " or ".join(f"contains({col}, '{t}')" for t in listed) + ")"


def cases(col: str, values: dict, other) -> str:
    lit = lambda v: f"'{v}'" if isinstance(v, str) else f"{v}::double"
    arms = " ".join(f"when {col} = '{k}' then {lit(v)}" for k, v in values.items())
    return f"(case {arms} else {lit(other)} end)"


TW = f"""tw as (
  select {brand('e.user_id')} brand_id, e.event_id::varchar tweet_id, {day('e.event_id')} as date,
    {day('e.event_id')}::timestamp + (date_trunc('second', e.ts) - date_trunc('day', e.ts)) ts_event,
    e.user_id::varchar author_id, coalesce(d.text, e.event_type) as text, lower(coalesce(d.text, e.event_type)) low,
    coalesce(d.lang, 'en') lang,
    floor(e.value / 10)::bigint like_count, (e.user_id % 5)::bigint reply_count,
    floor(e.value / 50)::bigint retweet_count,
    case when e.event_type <> 'signup' then 0::bigint end quote_count,
    e.event_type = 'error' possibly_sensitive, {country('e.user_id')} geo_country
  from events e left join documents d on e.event_id = d.doc_id),
tw_raw as (
  select *, like_count + reply_count + retweet_count + quote_count total_engagements,
    length(text)::bigint text_length from tw where text <> '')"""

RD = f"""rd as (
  select {brand('conv_id')} brand_id, conv_id::varchar || '_' || turn::varchar reddit_id,
    {day('conv_id')} as date, 'sub' || (conv_id % 5)::varchar subreddit,
    case when role = 'system' then '[deleted]' else role || (length(text) % 9)::varchar end author,
    case when turn = 0 then 'post' else 'comment' end as type,
    case when turn = 0 then substr(text, 1, 40) end title,
    case when not (turn = 0 and conv_id % 3 = 0) then text end body,
    (length(text) % 21 - 5)::bigint score,
    case when turn = 0 then (length(text) % 7)::bigint end num_comments,
    case when turn = 0 then (length(text) % 100) / 100.0::double end upvote_ratio,
    {country('conv_id')} geo_country
  from conversations),
rd_raw as (
  select *, coalesce(body, title, '') combined_text, length(coalesce(body, title, ''))::bigint text_length
  from rd where coalesce(body, title) is not null and author <> '[deleted]')"""

_KINDS = ", ".join(f"'{k}'" for k in S.KEYWORD_TYPES)
TR = f"""tr as (
  select {brand('s.s_nationkey')} brand_id, p.p_brand keyword,
    ([{_KINDS}])[l.l_linenumber % 4 + 1] keyword_type,
    (['US','US-NY','US-CA','CA'])[(l.l_suppkey % 4)::int + 1] geo,
    {day("date_diff('day', DATE '1995-01-01', l.l_shipdate::date)")} as date,
    (l.l_quantity * 2)::bigint as value,
    l.l_linenumber % 4 <> 1 is_brand_keyword
  from lineitem l join part p on l.l_partkey = p.p_partkey join supplier s on l.l_suppkey = s.s_suppkey),
tr_raw as (select * from tr where value >= 0)"""

CF = f"""cf as (
  select {brand('c.c_nationkey')} brand_id, o.o_orderkey::varchar complaint_id, {day('o.o_orderkey')} as date,
    {cases('c.c_mktsegment', S.PRODUCTS, S.PRODUCT_ELSE)} product, o.o_orderpriority issue, d.lang sub_issue,
    d.text narrative,
    case when o.o_orderpriority <> '4-NOT SPECIFIED' then o.o_orderstatus = 'F' end timely_response,
    o.o_orderstatus = 'P' consumer_disputed,
    case when o.o_orderstatus <> 'O' then {day('o.o_orderkey')} end sent,
    case when c.c_acctbal > 0 then 'Responded' end company_public_response,
    n.n_name state, (c.c_custkey % 100)::varchar zip_code,
    case when c.c_custkey % 4 = 0 then 'CA' else 'US' end geo_country,
    {cases('o.o_orderpriority', S.SEVERITIES, S.SEVERITY_ELSE)} severity_score
  from orders o join customer c on o.o_custkey = c.c_custkey join nation n on c.c_nationkey = n.n_nationkey
  left join documents d on d.doc_id = o.o_orderkey),
cf_raw as (
  select *, coalesce(length(narrative), 0)::bigint narrative_length,
    coalesce(narrative <> '', false) has_narrative from cf)"""

CE = f"""ce as (
  select *, lower(complaint_text) low from (
    select o.o_orderkey::varchar complaint_id,
      coalesce(d.text, 'Order of priority ' || o.o_orderpriority || ' with state ' || o.o_orderstatus) complaint_text,
      {cases('c.c_mktsegment', S.PRODUCTS, S.PRODUCT_ELSE)} product, o.o_orderpriority issue, coalesce(d.lang, 'en') sub_issue,
      'Company ' || c.c_nationkey::varchar company, n.n_name state, (c.c_custkey % 100)::varchar zip_code,
      {day('o.o_orderkey')} complaint_date,
      case when o.o_orderstatus <> 'O' then {day('o.o_orderkey')} + 2 end date_sent_to_company
    from orders o left join documents d on d.doc_id = o.o_orderkey join customer c on o.o_custkey = c.c_custkey
    join nation n on c.c_nationkey = n.n_nationkey)),
ce_raw as (
  select *, length(complaint_text)::bigint text_length,
    case when {contains('low', S.SEVERITY_WORDS[0][1])} then 'high'
         when {contains('low', S.SEVERITY_WORDS[1][1])} then 'medium' else 'low' end severity_level
  from ce where length(complaint_text) > 20)"""

RE = f"""re as (
  select case when turn = 0 then 'reddit_t3_' else 'reddit_t1_' end || conv_id::varchar || '_' || turn::varchar event_id,
    {day('conv_id')} event_date, {day('conv_id')}::timestamp + to_minutes(turn) ts_event,
    case when conv_id % 3 <> 2 then 'td_bank' else 'jpm' end brand_id, {country('conv_id')} geo_country,
    text, lower(text) low, (length(text) % 21 - 10) / 10.0::double sentiment, (length(text) % 10) / 10.0::double severity,
    ['t' || (conv_id % 4)::varchar, 'u' || (turn % 3)::varchar] topics,
    'sub' || (conv_id % 5)::varchar subreddit, role author,
    case when turn = 0 then 'post' else 'comment' end reddit_type,
    case when turn = 0 then 'Thread ' || conv_id::varchar end title,
    (length(text) % 21 - 5)::bigint score, case when turn = 0 then (length(text) % 7)::bigint end num_comments
  from conversations),
re_raw as (
  select *, length(text)::bigint text_length,
    {contains('low', S.COMPLAINT_WORDS)} or sentiment < 0 is_complaint
  from re where length(text) > 10 and brand_id = 'td_bank')"""

EV = """ev as (
  select 'reddit_t3_' || event_id::varchar event_id, ts ts_event,
    case when user_id % 5 <> 0 then ts end nlp_processed_at, event_id created_utc, event_type as text, value
  from events
  union all
  select 'reddit_t3_' || event_id::varchar, ts, ts + interval 3 hour, event_id, 'edited', value
  from events where event_type = 'error'
  union all
  select 'reddit_t3_0', ts, ts + interval 3 hour, event_id, 'copy', value
  from events where event_type = 'purchase')"""

SE = f"""se as (
  select event_id, {brand('user_id')} brand_id, source, {day('event_id')}::timestamp ts_event, text,
    case when size % 13 <> 0 then (size % 21 - 10) / 10.0::double end sentiment,
    (size % 10) / 10.0::double severity, [lang, 't' || (size % 4)::varchar] topics,
    {country('user_id')} geo_country, embedding dense_vec, label
  from (
    select e.event_id, e.user_id, coalesce(d.source, 'events') source, coalesce(d.text, e.event_type) as text,
      coalesce(d.n_chars, length(e.event_type)) size, coalesce(d.lang, 'en') lang, v.embedding, v.label
    from events e left join documents d on e.event_id = d.doc_id left join embeddings v on v.vec_id = e.event_id))"""


def with_(*parts: str) -> str:
    return "with " + ",\n".join(parts) + "\n"
