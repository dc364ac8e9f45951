"""Explicit schemas of every feed; landing files are never schema-inferred."""

from __future__ import annotations

TWITTER_POSTS = """
    brand_id string, tweet_id string, ts_event string, author_id string, author_username string,
    author_verified boolean, author_location string, text string, lang string, like_count bigint,
    reply_count bigint, retweet_count bigint, quote_count bigint, possibly_sensitive boolean,
    geo_country string, geo_place_id string, collected_at string"""

REDDIT_MESSAGES = """
    brand_id string, reddit_id string, ts_event string, subreddit string, author string, type string,
    title string, body string, score bigint, num_comments bigint, upvote_ratio double, url string,
    permalink string, lang string, geo_country string, collected_at string"""

REDDIT_EVENTS = """
    event_id string, ts_event timestamp, brand_id string, source string, geo_country string, text string,
    content_hash string, metadata string, sentiment double, severity double, topics array<string>,
    language string, nlp_confidence double, nlp_model string, nlp_version string,
    nlp_processed_at timestamp, nlp_error string, _ingested_at timestamp, _source_run string"""

TRENDS_TIMESERIES = """
    brand_id string, keyword string, keyword_type string, geo string, ts_event string, value bigint,
    category string, is_brand_keyword boolean, related_queries_top array<string>, collected_at string"""

COMPLAINTS = """
    brand_id string, complaint_id string, ts_event string, product string, sub_product string,
    issue string, sub_issue string, consumer_complaint_narrative string,
    company_response_to_consumer string, timely_response boolean, consumer_disputed boolean,
    submitted_via string, date_sent_to_company string, company_public_response string, tags string,
    state string, zip_code string, geo_country string, severity_score double, collected_at string"""

COMPLAINTS_EXPORT = """
    Complaint_ID string, Consumer_complaint_narrative string, Product string, Sub_product string,
    Issue string, Sub_issue string, Company string, State string, ZIP_code string,
    Company_response_to_consumer string, Timely_response string, Consumer_disputed string,
    Submitted_via string, Date_received string, Date_sent_to_company string"""

EMPLOYEE_REVIEWS = """
    brand_id string, review_id string, ts_event string, overall_rating double, work_life_balance double,
    comp_benefits double, culture_values double, career_opportunities double, senior_management double,
    ceo_approval double, recommend_to_friend double, employment_status string, location string,
    job_title string, employment_length string, review_title string, pros string, cons string,
    advice_to_management string, review_text string, company_id string, fetched_at string,
    data_source string, data_type string"""

TRENDING_SEARCHES = "geo string, query string, rank bigint, ts_event string, collected_at string"

INGEST_STATE = "source string, cursor_iso string, tie_breaker_id string, updated_at timestamp"

BRAND_DICTIONARY = """
    brand_id string, brand_name string, aliases array<string>, domains array<string>,
    ticker string, hq_country string"""

FEEDS = {
    "twitter_posts": TWITTER_POSTS,
    "reddit_messages": REDDIT_MESSAGES,
    "reddit_events": REDDIT_EVENTS,
    "trends_timeseries": TRENDS_TIMESERIES,
    "cfpb_complaints": COMPLAINTS,
    "cfpb_export": COMPLAINTS_EXPORT,
    "glassdoor_reviews": EMPLOYEE_REVIEWS,
    "trending_searches": TRENDING_SEARCHES,
    "ingest_state": INGEST_STATE,
}
