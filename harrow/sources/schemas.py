"""Schemas of the records that the library reads and writes, as DDL; nothing is inferred."""

from __future__ import annotations

SLOT = "struct<days:string,hours:string>"
PRICE = "struct<type:string,amount:double,amount_max:double,currency:string,has_surcharge:boolean>"
SOURCE_REF = "struct<id:string,tier:string,trust:double,url:string,retrieved_at:timestamp>"

PAGE = ("url string, status int, body string, etag string, last_modified string, fetched_at timestamp")
INDEX_ENTRY = ("source_id string, url string, etag string, first_seen timestamp, last_seen timestamp, status int, verdict string")
EXTRACT = ("page_id bigint, level string, title string, description string, start_date string, end_date string, venue_name string, address string, lat double, lng double, price_text string, "
    "schedule_lines array<string>, official_url string, tickets_url string, image string, body_text string")
CANDIDATE = (f"ord bigint, source_id string, tier string, trust double, url string, collection string, title string, description string, start_at timestamp, end_at timestamp, time_confidence string, schedule array<{SLOT}>, "
    f"venue_name string, address string, lat double, lng double, category string, price {PRICE}, price_texts array<string>, official_url string, body_text string, retrieved_at timestamp, seed_slug string")
DECISION = ("at timestamp, cluster_id string, collection string, stage string, outcome string, reason string, score double, model string, input_tokens bigint, output_tokens bigint")
VERDICT = ("id string, worth_the_trip int, typical int, no_language_barrier int, no_tourist_trap int, is_tourist_trap boolean, is_generic boolean, needs_a_local boolean, is_a_brand boolean, temporality string, reason string")
SPEND_CALL = ("at timestamp, model string, task string, input_tokens bigint, output_tokens bigint, eur double, batch_id string, pending boolean")
OBSERVATION = ("source_id string, run timestamp, extracted bigint, empty_rate double, error string")
CARD = ("collection string, slug string, title string, price string, ends_at timestamp, locked boolean, prompt_version string, body string")
