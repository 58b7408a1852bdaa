"""Row types of the pipeline."""

from __future__ import annotations

ARTICLE = """source_id string, source_name string, tier int, source_role string, url string, title string,
    canonical_url string, summary string, published timestamp, updated timestamp, author string,
    category_hints array<string>, language string, raw string, fetched_at timestamp"""

RAW_ITEM = "title string, url string, summary string, published string, updated string, author string, category_hints array<string>, raw string"

REGISTRY = """id string, name string, type string, tier int, method string, url string, categories array<string>, language string,
    `group` string, `primary` boolean, news boolean, discovery boolean, allow_domains array<string>, enabled boolean, verified boolean,
    settings map<string,string>, notes string"""

HEALTH = """source_id string, status string, last_success timestamp, last_fetch timestamp, consecutive_failures int, total_errors int,
    timeouts int, malformed int, items_found int, last_error string"""

POSTED = "story_id string, event_id string, label string, message_id string, posted_at timestamp, scheduled_at timestamp"
SCHEDULED = "story_id string, event_id string, label string, scheduled_at timestamp, attempts int"
FAILURES = "story_id string, attempts int, failed_at timestamp"
SIGNAL = "array<struct<grp: string, term: string, location: string, start: int, stop: int>>"
SENTENCE = "array<struct<text: string, source: string, item_id: string>>"
