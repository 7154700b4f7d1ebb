"""Schemas of the tables; readers declare them, so nothing is inferred."""

from __future__ import annotations

ARTICLE = "title string, text string, url string, date string, source string, department string"
EVENT = "event_id string, bank string, place string, department string, region string, kind string, status string, temporal_status string, announced_on date, closed_on date, approximate boolean, reliability int, code string, lat double, lon double, address string, label string, original_place string, evidence string, point_id string, service_impact string, cutoff date, created_at timestamp, updated_at timestamp"
SOURCE = "event_id string, url string, title string, name string, published string, tier string"
QUARANTINE = "id string, url string, bank string, place string, department string, kind string, reason string, resolved string, created_at timestamp"
SIGNAL = "id string, url string, title string, bank string, department string, text string, score int, date string, created_at timestamp"
DEPARTMENT_SIGNAL = "id string, url string, bank string, department string, n int, places array<string>, confidence double, evidence string"
VAGUE_SIGNAL = "id string, url string, bank string, scope string, n int, confidence double, evidence string"
FULL_TEXT = "url string, final_url string, domain string, status string, full_text string, text_hash string, fetched_at timestamp"
RESULT = "content_hash string, version int, model string, status string, result_json string, error_type string, attempts int, retry_after timestamp, created_at timestamp, updated_at timestamp"
POINT = "point_id string, label string, characteristic string, address string, postal_code string, locality string, code string, department string, lat double, lon double, revision string"
CALENDAR = "point_id string, day date, slot_1 string, slot_2 string"
GAZETTEER = "name string, city string, code string, postal_code string, department string, lat double, lon double, rank int"
BRANCH = "branch_id string, bank string, name string, address string, postal_code string, place string, department string, lat double, lon double, source string"
CAPTURE = "urlkey string, url string, timestamp string, status string, mime string, filename string, offset string, length string"
