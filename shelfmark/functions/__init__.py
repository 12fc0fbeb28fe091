from shelfmark.functions.documents import (
    Container, Elements, explode_elements, with_document_fields,
)
from shelfmark.functions.json_text import json_text
from shelfmark.functions.patterns import java_pattern
from shelfmark.functions.text import (
    catalog_link, compose_call_number, concat_present, matches_regex, normalise_code, parse_code_list,
)
from shelfmark.functions.values import (
    as_boolean, as_timestamp, as_uuid, within_days, within_midnights,
)

__all__ = [
    "Container", "Elements", "as_boolean", "as_timestamp", "as_uuid", "catalog_link",
    "compose_call_number", "concat_present", "explode_elements", "java_pattern", "json_text",
    "matches_regex", "normalise_code", "parse_code_list", "with_document_fields", "within_days", "within_midnights",
]
