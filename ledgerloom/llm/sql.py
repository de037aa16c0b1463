"""SQL counterparts of the llm queries, for a second engine on the same tables.

Given where SQL can say the same over whole tables.  The others (token repair, trained
models, dependent rounding, containment search) are tested against brute force or held-out
labels in ``tests/llm``.
"""

from __future__ import annotations

# The field names of this project's records; the operator learns its own.
FIELD_NAMES = ("metric", "value", "crop", "previous crop", "site", "phase", "year", "depth")

# the same ranges as in the operator, in the syntax of the second engine
_INVISIBLE = r"\x{00AD}\x{034F}\x{061C}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180E}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{206F}\x{FEFF}\x{FE00}-\x{FE0F}"
_SPACES = r"\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_WIDTH = r"\x{FF01}-\x{FF5E}\x{FB00}-\x{FB06}\x{FFE0}-\x{FFE6}\x{2460}-\x{24FF}\x{FE50}-\x{FE6F}\x{1D400}-\x{1D7FF}"
# letters of scripts whose letters are typed for Latin ones
_ALIKE = r"\p{Greek}\p{Cyrillic}\p{Armenian}\p{Cherokee}\p{Coptic}\p{Lisu}"


def _stands_for_others(x: str) -> str:
    word = r"[\p{L}\p{M}\p{N}]*"
    mixed = rf"\p{{Latin}}{word}[{_ALIKE}]|[{_ALIKE}]{word}\p{{Latin}}"
    return f"""(regexp_matches({x}, '[{_INVISIBLE}{_SPACES}{_WIDTH}]') OR regexp_matches({x}, '[\\p{{Latin}}\\p{{Greek}}\\p{{Cyrillic}}]\\p{{Mn}}') OR regexp_matches({x}, '{mixed}'))"""


def _words(x: str) -> str:
    """Lower-case words; the point inside a number is kept by a mark that no text has."""
    point = f"regexp_replace(regexp_replace({x}, '([0-9])\\.([0-9])', '\\1\x01\\2', 'g'), '([0-9])\\.([0-9])', '\\1\x01\\2', 'g')"
    return f"trim(regexp_replace(replace(lower(regexp_replace({point}, '[^\\p{{L}}\\p{{N}}\\p{{M}}\x01]+', ' ', 'g')), '\x01', '.'), '\\s+', ' ', 'g'))"


def _record(x: str, names: bool) -> str:
    """The sorted fields of a record as one text."""
    body = f"regexp_replace({x}, '^[^\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+$', '', 'g')"
    name = "\\s*(" + "|".join(n.replace(" ", "[\\s\\p{P}]+") for n in FIELD_NAMES) + ")[\\s:=]+"
    comma = f"contains({body}, ',')" + (f" AND regexp_matches({body}, '(?i)^{name}[^,]*(,{name}[^,]*)+$')" if names else "")
    parts = f"""CASE WHEN contains({body}, ';') THEN string_split({body}, ';') WHEN contains({body}, '|') THEN string_split({body}, '|')
      WHEN regexp_matches({body}, '\\s/\\s') THEN regexp_split_to_array({body}, '\\s+/\\s+') WHEN {comma} THEN string_split({body}, ',') ELSE [{body}] END"""
    return f"array_to_string(list_sort(list_filter(list_transform({parts}, lambda p: {_words('p')}), lambda p: p <> '')), ' # ')"


def _copies(name: str, source: str, key: str, text: str, beside: list[str], names: bool) -> str:
    part = ", ".join([*beside, "k"])
    return f"""SELECT '{name}' AS table_name, keep_id, row_id AS copy_id FROM (SELECT row_id, min(row_id) OVER (PARTITION BY {part}) AS keep_id FROM
      (SELECT {key} AS row_id, {', '.join(beside)}, {_record(text, names)} AS k FROM {source} WHERE {text} IS NOT NULL)) WHERE row_id <> keep_id"""


_TARGETS = f"(SELECT hint_id, bundle_id, source_item_id, column_label, value, excerpt, {_record('target', False)} AS k FROM metric_hint WHERE target IS NOT NULL)"
_CLAIMS = f"(SELECT evidence_id, bundle_id, source_item_id, {_record('claim', True)} AS k FROM evidence WHERE claim IS NOT NULL)"
SQL: dict[str, str] = {
    "p2_found": f"""SELECT 'metric_hint' AS table_name, hint_id AS row_id FROM metric_hint WHERE {_stands_for_others('metric_name')}
      UNION ALL SELECT 'evidence', evidence_id FROM evidence WHERE {_stands_for_others('source_text')}""",
    "p7_found": _copies("metric_hint", "metric_hint", "hint_id", "target", ["bundle_id", "source_item_id", "column_label", "value", "excerpt"], False)
    + " UNION ALL "
    + _copies("evidence", "evidence", "evidence_id", "claim", ["bundle_id", "source_item_id"], True),
    "p7_claims": f"""SELECT min(evidence_id) AS evidence_id, count(*) AS copies FROM {_CLAIMS} GROUP BY bundle_id, source_item_id, k
      UNION ALL SELECT evidence_id, 1 FROM evidence WHERE claim IS NULL""",
    "p7_targets": f"""SELECT min(hint_id) AS hint_id, count(*) AS copies FROM {_TARGETS} GROUP BY bundle_id, source_item_id, column_label, value, excerpt, k
      UNION ALL SELECT hint_id, 1 FROM metric_hint WHERE target IS NULL""",
}
