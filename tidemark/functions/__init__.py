"""Column functions: cleaning, parsing, canonical text and content hashes."""

from tidemark.functions.canonical import canonical_json, content_hash, json_number, json_text
from tidemark.functions.text import (
    clean_float,
    clean_str,
    contains_ignoring_case,
    file_name,
    file_stem,
    hash_prefix,
    moment,
    month_number,
    name_list,
    percent,
    round4,
    strip,
    year_label,
)

__all__ = [
    "canonical_json", "clean_float", "clean_str", "contains_ignoring_case", "content_hash",
    "file_name", "file_stem", "hash_prefix", "json_number", "json_text", "moment",
    "month_number", "name_list", "percent", "round4", "strip", "year_label",
]
