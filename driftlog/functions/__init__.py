"""Column functions (built-in Spark expressions only)."""

from driftlog.functions.json import is_json_object, object_check, parse_object, to_json_doc
from driftlog.functions.text import highlight, matches_any, query_tokens, tokens
from driftlog.functions.time import (day_text, hour_text, instant_to_wall, iso_text, millis_to_wall,
                                     wall_to_instant, wall_to_millis)
from driftlog.functions.url import decode_args, query_string, strip_prefix, url_decode

__all__ = [
    "is_json_object", "object_check", "parse_object", "to_json_doc",
    "highlight", "matches_any", "query_tokens", "tokens",
    "day_text", "hour_text", "instant_to_wall", "iso_text", "millis_to_wall", "wall_to_instant",
    "wall_to_millis",
    "decode_args", "query_string", "strip_prefix", "url_decode",
]
