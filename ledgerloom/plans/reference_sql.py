"""SQL counterparts of the evidence-ledger queries, for a second engine on the same tables."""

from __future__ import annotations

from ledgerloom.functions import text
from ledgerloom.operators import discovery, ledger, rules
from ledgerloom.plans import problems


def _q(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _squeezed(x: str) -> str:
    return f"lower(trim(regexp_replace({x}, '[\\s\\p{{Z}}]+', ' ', 'g')))"


def _tokens(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '[\\p{{L}}\\p{{N}}]+')"


def _token_key(x: str) -> str:
    return f"array_to_string(list_sort({_tokens(f'coalesce({x}, {_q(str())})')}), '|')"


def _phrase(x: str) -> str:
    return f"(' ' || array_to_string({_tokens(f"coalesce({x}, '')")}, ' ') || ' ')"


_LISTED = f"""(SELECT DISTINCT {_phrase('n')} AS p, metric_key AS k FROM (SELECT metric_key, short_name AS n FROM canonical_metric UNION ALL SELECT metric_key, full_name FROM canonical_metric)
    WHERE n IS NOT NULL AND metric_key IS NOT NULL)"""
_WIDER = f"(SELECT a.p, a.k, b.p AS wider FROM {_LISTED} a LEFT JOIN {_LISTED} b ON b.p <> a.p AND contains(b.p, a.p))"


def _families(x: str) -> str:
    """Keys of the entries a name mentions, mentions inside longer ones left out."""
    of_alias = f"(SELECT k, p, list(wider) FILTER (wider IS NOT NULL) AS wider FROM {_WIDER} GROUP BY ALL)"
    return f"coalesce((SELECT list(DISTINCT l.k ORDER BY l.k) FROM {of_alias} l WHERE contains({_phrase(x)}, l.p) AND len(list_filter(coalesce(l.wider, []), lambda w: contains({_phrase(x)}, w))) = 0), [])"


def _identity(x: str) -> str:
    name = _squeezed(f"coalesce({x}, '')")
    marks = " || ".join(f"CASE WHEN regexp_matches({name}, '\\b{w}\\b') THEN '+{w}' ELSE '' END" for w in ("range", "maximum", "minimum"))
    return f"coalesce({_families(x)}[1], {name}) || {marks}"


def _decimal(x: str) -> str:
    return f"try_cast(CASE WHEN contains({x}, '.') THEN replace({x}, ',', '') ELSE replace({x}, ',', '.') END AS DOUBLE)"


def _aggregation(x: str) -> str:
    cases = " ".join(f"WHEN regexp_matches({x}, '\\b{w}\\b') THEN '{w}'" for w in ("median", "mean", "minimum", "maximum", "count"))
    return f"CASE {cases} WHEN regexp_matches({x}, '%|\\bpercent(age)?\\b|\\bproportion\\b') THEN 'proportion' END"


_NUMBER = "([0-9]+([.,][0-9]*)?|[.][0-9]+)([eE][-+]?[0-9]+)?"
_SIGNED = f"([-+−]?{_NUMBER})"
_TO = "\\s*([-–—−]|\\bto\\b)\\s*"
_UNIT = "(\\s*[a-zA-Z°%][a-zA-Z0-9°%./_]*)?"
_P = "\\s*(%|percent)?\\s*"


def _quantity(source: str, key: str, display: str, name: str | None = None, unit: str | None = None) -> str:
    """A relation of the shapes, read with one pattern each."""
    central = "(?:median|mean)\\s*[:=]?\\s*"
    shapes = {
        "rn": f"{_SIGNED}{_TO}{_SIGNED}{_UNIT}\\s*[;,(\\[]?\\s*{central}{_SIGNED}{_UNIT}\\s*[)\\]]?",
        "nr": f"{central}{_SIGNED}{_UNIT}\\s*[;,(\\[]?\\s*range\\s*[:=]?\\s*{_SIGNED}{_TO}{_SIGNED}{_UNIT}\\s*[)\\]]?",
        "er": f"{_SIGNED}{_P}[(\\[]\\s*{_SIGNED}{_TO}{_SIGNED}{_P}[)\\]]{_P}",
        "pm": f"{_SIGNED}\\s*(?:±|\\+/-)\\s*{_SIGNED}{_P}",
        "rg": f"{_SIGNED}{_TO}{_SIGNED}{_P}",
        "sc": f"{_SIGNED}{_P}",
    }
    code = "CASE " + " ".join(f"WHEN regexp_full_match(t, {_q('(?i)' + p)}) THEN '{c}'" for c, p in shapes.items()) + " ELSE 'tx' END"
    said = f"lower(concat_ws(' ', {name}, t))" if name else "lower(t)"
    own = f"lower(trim({unit}))" if unit else "NULL"
    codes = {"%": ("%", "percent", "percentage"), "d": ("d", "day", "days"), "h": ("h", "hour", "hours"), "a": ("a", "yr", "year", "years"), "Cel": ("°c", "degrees c")} | {u: (u,) for u in ("mm", "cm", "m", "km", "g", "kg", "t")}
    known = "CASE " + " ".join(f"WHEN own IN ({', '.join(map(_q, names))}) THEN {_q(c)}" for c, names in codes.items()) + " END"
    level = "try_cast(regexp_extract(t, '([0-9]+(?:[.][0-9]+)?)\\s*%\\s*(?i:ci|confidence|pi|prediction)', 1) AS DOUBLE) / 100"
    return f"""(
      WITH a AS (SELECT {key}, {name + ',' if name else ''} trim({display}) AS t, coalesce({own}, '') AS own FROM {source}),
      b AS (SELECT *, {code} AS code, list_transform(regexp_extract_all(regexp_replace(t, {_q('([0-9.%])' + _TO)}, '\\1 ', 'g'), {_q(_SIGNED)}, 1), lambda x: {_decimal("replace(x, '−', '-')")}) AS n FROM a),
      c AS (SELECT *, CASE WHEN code IN ('er', 'nr') THEN n[2] WHEN code IN ('rg', 'rn') THEN n[1] END AS lo, CASE WHEN code IN ('er', 'nr') THEN n[3] WHEN code IN ('rg', 'rn') THEN n[2] END AS hi FROM b),
      d AS (SELECT *, coalesce(lo > hi, false) AS falls FROM c)
      SELECT {key},
        CASE WHEN t IS NULL THEN NULL WHEN falls OR code = 'tx' THEN 'text_summary' WHEN code IN ('er', 'rn', 'nr') THEN 'estimate_with_range' WHEN code = 'pm' THEN 'estimate_with_uncertainty' WHEN code = 'rg' THEN 'range' ELSE 'scalar' END AS kind,
        CASE WHEN NOT falls THEN CASE WHEN code IN ('er', 'nr', 'pm', 'sc') THEN n[1] WHEN code = 'rn' THEN n[3] END END AS numeric_value,
        CASE WHEN NOT falls THEN lo END AS lower_bound,
        CASE WHEN NOT falls THEN hi END AS upper_bound,
        CASE WHEN code = 'pm' THEN abs(n[2]) END AS uncertainty,
        CASE WHEN t IS NULL OR t = '' THEN NULL WHEN own <> '' THEN {known} WHEN regexp_matches(t, '(?i)(%|\\bpercent)$') THEN '%' END AS unit_code,
        CASE WHEN t IS NULL THEN NULL WHEN NOT falls AND code IN ('rn', 'nr') THEN lower(regexp_extract(t, '(?i)(median|mean)', 1)) ELSE {_aggregation(said)} END AS aggregation,
        CASE WHEN falls THEN NULL WHEN code IN ('rn', 'nr') THEN 'reported min-max or across-group range' WHEN code = 'er' THEN 'reported interval or range (type not stated)' WHEN code = 'rg' THEN 'reported range (basis not stated)' END AS range_basis,
        CASE WHEN code = 'tx' AND {level} BETWEEN 0 AND 1 THEN {level} END AS nominal_level,
        CASE WHEN falls THEN 'descending_range' END AS parse_error
      FROM d)"""


_REGISTRY = """(SELECT bundle_id, source_item_id, max(item_type) AS item_type, max(source_page) AS source_page, max(source_location) AS source_location, max(section_hint) AS section_hint, max(caption) AS caption
  FROM registry_item GROUP BY ALL)"""
_UNKNOWN = """SELECT e.evidence_id, e.bundle_id, e.source_item_id FROM evidence e WHERE e.source_item_id IS NOT NULL
  AND e.bundle_id IN (SELECT bundle_id FROM registry_item) AND NOT EXISTS (SELECT 1 FROM registry_item r WHERE r.bundle_id = e.bundle_id AND r.source_item_id = e.source_item_id)"""

_R, _S = _quantity("ledger_metric", "metric_id", "as_reported"), _quantity("ledger_metric", "metric_id", "value_or_summary")
_QUANTITY_ISSUES = f"""
  SELECT l.metric_id AS record, 'QUANTITATIVE_VALUE_NOT_STRUCTURED' AS code, 'warning' AS severity FROM ledger_metric l JOIN {_R} r USING (metric_id) WHERE regexp_matches(l.as_reported, '[0-9]') AND r.kind = 'text_summary'
  UNION ALL SELECT metric_id, 'QUANTITATIVE_AS_REPORTED_MISMATCH', 'error' FROM ledger_metric WHERE {_squeezed('as_reported')} <> {_squeezed('value_or_summary')}
  UNION ALL SELECT r.metric_id, 'QUANTITATIVE_VALUE_DISPLAY_CONFLICT', 'error' FROM {_R} r JOIN {_S} s USING (metric_id) WHERE r.kind <> 'text_summary' AND s.kind <> 'text_summary'
    AND (r.numeric_value IS DISTINCT FROM s.numeric_value OR r.lower_bound IS DISTINCT FROM s.lower_bound OR r.upper_bound IS DISTINCT FROM s.upper_bound)"""
_TARGETS = "(" + ", ".join(_q(s) for s in rules.TARGET_SCOPES) + ")"
_SCOPE_ISSUES = f"""
  SELECT metric_id AS record, 'METRIC_SCOPE_LABEL_MULTIPLE_TARGETS' AS code, 'error' AS severity FROM ledger_metric WHERE regexp_matches(trim(scope_label), '[;|]')
  UNION ALL SELECT metric_id, 'METRIC_SCOPE_LABEL_CONTRADICTS_SCOPE', 'error' FROM ledger_metric WHERE trim(scope_label) <> '' AND scope IN {_TARGETS} AND regexp_matches(lower(trim(scope_label)), {_q(rules.ALL_WORDS)})
  UNION ALL SELECT metric_id, 'METRIC_SCOPE_LABEL_MISSING', 'warning' FROM ledger_metric WHERE coalesce(trim(scope_label), '') = '' AND scope IN {_TARGETS}
  UNION ALL SELECT metric_id, 'PHASE_YEAR_SCOPE_WITHOUT_YEAR', 'warning' FROM ledger_metric WHERE scope = 'phase_year' AND NOT coalesce(regexp_matches(trim(scope_label), '\\b(19|20)[0-9]{{2}}\\b'), false)
  UNION ALL SELECT metric_id, 'INTERVAL_METRIC_EVALUATION_SUPPORT_UNKNOWN', 'warning' FROM ledger_metric WHERE evaluation_support = 'unknown' AND regexp_matches(lower(name), '\\b(interval|picp|piw|coverage)\\b')"""
_LOCATED = f"(SELECT e.*, r.item_type, r.source_page AS rp, r.source_location AS rl, r.section_hint AS rs FROM evidence e JOIN {_REGISTRY} r USING (bundle_id, source_item_id))"
_LOCATOR_ISSUES = f"""
  SELECT evidence_id AS record, 'SOURCE_ITEM_ID_UNKNOWN' AS code, 'error' AS severity FROM ({_UNKNOWN})
  UNION ALL SELECT evidence_id, 'SOURCE_ITEM_MODALITY_MISMATCH', 'error' FROM {_LOCATED} WHERE source_modality IN ('author_table', 'author_figure', 'author_formula') AND source_modality <> 'author_' || item_type
  UNION ALL SELECT evidence_id, 'SOURCE_ITEM_PAGE_MISMATCH', 'error' FROM {_LOCATED} WHERE source_page <> rp
  UNION ALL SELECT evidence_id, 'SOURCE_ITEM_LOCATION_MISMATCH', 'error' FROM {_LOCATED} WHERE source_location <> rl
  UNION ALL SELECT evidence_id, 'SOURCE_ITEM_SECTION_MISMATCH', 'error' FROM {_LOCATED} WHERE source_section <> rs
  UNION ALL SELECT evidence_id, 'EXPLICIT_EVIDENCE_WEAK_LOCATOR', 'warning' FROM evidence WHERE evidence_type = 'explicit' AND source_page IS NULL AND source_item_id IS NULL AND source_section IS NULL"""

_SENTENCES = "list_filter(list_transform(regexp_split_to_array(regexp_replace(text, '([.!?])\\s+', '\\1\n', 'g'), '\n+'), lambda x: trim(x)), lambda x: x <> '')"
_LINES = "(SELECT {k}, i - 1 AS line_no, l[i] AS line FROM (SELECT {k}, l, unnest(generate_series(1, len(l))) AS i FROM (SELECT {k}, regexp_split_to_array({t}, '\\r?\\n') AS l FROM {s} WHERE {t} IS NOT NULL)))"
_VIEWS = ", ".join(_q(c) for c in ledger.PRODUCER_CONTEXTS)


def _anchor(x: str) -> str:
    number = f"regexp_extract({x}, '^\\s*([0-9]+(\\.[0-9]+)*)', 1)"
    return f"CASE WHEN {number} <> '' THEN {number} ELSE {_squeezed(x)} END"


_SET = "list_sort(list_distinct({x}))"


def _portable(path: str) -> str:
    plain = f"replace({path}, '\\', '/')"
    home = "('/data/packages/p' || bundle_id || '/')"
    return f"""CASE WHEN {path} IS NULL OR trim({path}) = '' THEN {path} WHEN NOT regexp_matches({plain}, '^(/|[A-Za-z]:/)') THEN {plain}
      WHEN starts_with({plain}, {home}) THEN substr({plain}, length({home}) + 1) ELSE regexp_extract({plain}, '([^/]*)/*$', 1) END"""

_STEMS = "list_distinct(list_transform(list_filter(regexp_extract_all(lower({x}), '[\\p{{L}}\\p{{N}}]+'), lambda w: length(w) >= 5), lambda w: substr(w, 1, 7)))"

_KEY = "coalesce(regexp_replace(regexp_replace(cast(cast(cast({x} AS VARCHAR) AS DECIMAL(38,18)) AS VARCHAR), '0+$', ''), '[.]$', ''), '')"
_D1_KEY = f"""concat_ws('|', {_identity('name')}, coalesce(context, ''), coalesce(scope, ''), coalesce(evaluation_support, ''),
    array_to_string(list_sort(list_filter({_tokens("coalesce(scope_label, '')")}, lambda t: t NOT IN ('the', 'a', 'an', 'of', 'for', 'in', 'on', 'at', 'to'))), ' '),
    CASE WHEN q.kind <> 'text_summary' THEN concat_ws(';', q.kind, {', '.join(_KEY.format(x='q.' + c) for c in ('numeric_value', 'lower_bound', 'upper_bound', 'uncertainty'))}, coalesce(q.unit_code, '')) ELSE {_squeezed("coalesce(as_reported, '')")} END)"""
_D1 = f"""WITH RECURSIVE k AS (SELECT bundle_id, metric_id, {_D1_KEY} AS identity, as_reported, {_aggregation("lower(concat_ws(' ', name, as_reported))")} AS agg, q.nominal_level AS lvl, q.unit_code, unit, evaluation_population, interpretation
      FROM ledger_metric JOIN {_quantity('ledger_metric', 'metric_id', 'as_reported')} q USING (metric_id) WHERE name IS NOT NULL),
    r AS (SELECT bundle_id, identity, agg, lvl, min(metric_id) AS id, count(*) AS n FROM k GROUP BY bundle_id, identity, as_reported, agg, lvl, unit_code, unit, evaluation_population, interpretation),
    g AS (SELECT bundle_id, identity, cast(sum(n) AS BIGINT) AS rows, list(struct_pack(id := id, agg := agg, lvl := lvl) ORDER BY id) AS seen FROM r GROUP BY ALL),
    f AS (SELECT bundle_id, identity, rows, seen, 1 AS i, list_slice([struct_pack(id := cast(0 AS BIGINT), agg := '', lvl := cast(0 AS DOUBLE), members := 0)], 1, 0) AS kept FROM g
      UNION ALL SELECT bundle_id, identity, rows, seen, i + 1, CASE WHEN h IS NULL THEN list_append(kept, struct_pack(id := x.id, agg := x.agg, lvl := x.lvl, members := 1))
        ELSE list_transform(kept, lambda s, j: CASE WHEN j = h THEN struct_pack(id := s.id, agg := coalesce(s.agg, x.agg), lvl := coalesce(s.lvl, x.lvl), members := s.members + 1) ELSE s END) END
      FROM (SELECT *, list_filter(range(1, len(kept) + 1), lambda j: coalesce(kept[j].agg = x.agg, true) AND coalesce(kept[j].lvl = x.lvl, true))[1] AS h FROM (SELECT *, seen[i] AS x FROM f WHERE i <= len(seen)))),
    o AS (SELECT bundle_id, identity, rows, unnest(kept) AS s FROM f WHERE i > len(seen))
    SELECT bundle_id, identity, s.id AS metric_id, s.agg AS aggregation, s.lvl AS nominal_level, s.members AS members, rows FROM o"""

def _target(x: str) -> str:
    fields = f"regexp_split_to_array(lower({x}), '[;|,]|\\s/\\s')"
    crop = f"coalesce(list_filter({fields}, lambda f: regexp_matches(f, '^\\W*crop\\W'))[1], {fields}[1])"
    return f"nullif(trim(regexp_replace(regexp_replace({crop}, '^\\W*crop\\W', ' '), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), '')"


def _words(x: str) -> str:
    return f"array_to_string(list_sort(list_filter({_tokens(f"coalesce({x}, '')")}, lambda t: t NOT IN ('the', 'a', 'an', 'of', 'for', 'in', 'on', 'at', 'to'))), ' ')"


_ITEMS = problems._elements(f"(SELECT record_id, ord AS parent, x FROM {problems._METRIC})", "record_id, parent", "x->'$.evidence'")
_TAKEN = f"""(SELECT DISTINCT m.record_id, r.bundle_id, m.ord, m.x->>'$.context' AS context, e.x->>'$.source_item_id' AS item, {_target("m.x->>'$.scope_label'")} AS target, {_identity("m.x->>'$.name'")} AS key
    FROM {problems._METRIC} m JOIN {_ITEMS} e ON e.record_id = m.record_id AND e.parent = m.ord JOIN matrix_record r ON r.record_id = m.record_id WHERE e.x->>'$.source_item_id' IS NOT NULL AND {_target("m.x->>'$.scope_label'")} IS NOT NULL)"""
_OFFERED = f"""(SELECT DISTINCT bundle_id, source_item_id AS item, {_target('target')} AS target, {_identity('metric_name')} AS key, {_families('metric_name')}[1] AS family FROM metric_hint
    WHERE kind = 'structured_table_metric' AND source_item_id IS NOT NULL AND metric_name IS NOT NULL AND {_target('target')} IS NOT NULL)"""
_RANK = "CASE scope WHEN 'crop' THEN 1 WHEN 'crop_phase' THEN 2 WHEN 'phase_year' THEN 3 END"
_SORTING = f"lower(trim(regexp_replace(concat_ws(' ', value_or_summary, interpretation), '[\\s\\p{{Z}}]+', ' ', 'g')))"
_MERGED = f"""WITH a AS (SELECT bundle_id, {_identity('metric_name')} AS m, '' AS c, {_words('target')} AS t, '' AS s, {_squeezed("coalesce(value, '')")} AS v, arg_min(struct_pack(u := unit_hint, o := hint_id), hint_id) AS r FROM metric_hint WHERE metric_name IS NOT NULL GROUP BY ALL),
    b AS (SELECT bundle_id, {_identity('name')} AS m, coalesce(context, '') AS c, {_words('scope_label')} AS t, coalesce(evaluation_support, '') AS s, {_squeezed("coalesce(as_reported, '')")} AS v, arg_min(struct_pack(u := unit, o := metric_id), metric_id) AS r FROM ledger_metric WHERE name IS NOT NULL GROUP BY ALL),
    j AS (SELECT m, CASE WHEN a.r IS NULL THEN 'repair' WHEN b.r IS NULL THEN 'initial' ELSE 'both' END AS origin, coalesce(b.r.u, a.r.u) AS u, coalesce(b.r.o, a.r.o) AS o FROM a FULL JOIN b USING (bundle_id, m, c, t, s, v))
    SELECT origin, count(*) AS rows, count(u) AS with_unit, count(DISTINCT m) AS metrics, cast(sum(o) AS BIGINT) AS ords FROM j GROUP BY origin"""

_LABEL = f"coalesce({_squeezed("x->>'$.scope_label'")}, '')"
SQL = {
    "evidence_siblings": f"""WITH m AS (SELECT record_id, ord, {_families("x->>'$.name'")}[1] AS own, {_LABEL} AS label FROM {problems._METRIC}),
        e AS (SELECT DISTINCT record_id, parent AS ord, unnest({_families("x->>'$.claim'")}) AS sibling FROM {_ITEMS} WHERE regexp_matches(x->>'$.claim', '[0-9]'))
        SELECT record_id, ord, sibling FROM e JOIN m USING (record_id, ord) WHERE own IS DISTINCT FROM sibling AND NOT EXISTS (SELECT 1 FROM m n WHERE n.record_id = m.record_id AND n.label = m.label AND n.own = e.sibling)""",
    "record_provenance": """SELECT record_id, bundle_id, source_filename AS injected_source, CASE WHEN regexp_full_match(lower(source_sha256), '[0-9a-f]{64}') THEN lower(source_sha256) END AS injected_sha256
        FROM matrix_record LEFT JOIN source_bundle USING (bundle_id)""",
    "structured_siblings": f"""WITH t AS {_TAKEN}, o AS {_OFFERED} SELECT record_id, item, target, string_agg(key, ', ' ORDER BY key) AS missing FROM (
        SELECT DISTINCT t.record_id, t.item, t.target, o.key FROM t JOIN o USING (bundle_id, item, target) WHERE NOT EXISTS (SELECT 1 FROM t u WHERE u.record_id = t.record_id AND u.item = t.item AND u.target = t.target AND u.key = o.key)) GROUP BY ALL""",
    "structured_targets": f"""WITH t AS {_TAKEN}, o AS {_OFFERED}, w AS (SELECT bundle_id, item FROM o GROUP BY ALL HAVING count(DISTINCT target) >= 2 AND count(DISTINCT family) >= 2),
        l AS (SELECT record_id, item, list(DISTINCT o.target ORDER BY o.target) AS a FROM (SELECT DISTINCT record_id, bundle_id, item FROM t) x JOIN w USING (bundle_id, item) JOIN o USING (bundle_id, item)
          WHERE NOT EXISTS (SELECT 1 FROM t u WHERE u.record_id = x.record_id AND u.item = x.item AND u.target = o.target) GROUP BY ALL)
        SELECT record_id, item, cast(len(a) AS INTEGER) AS missing, array_to_string(a[1:8], ', ') || CASE WHEN len(a) > 8 THEN ' and ' || (len(a) - 8) || ' more' ELSE '' END AS targets FROM l""",
    "scope_harmony": f"""WITH r AS (SELECT *, {_words('scope_label')} AS w, {_RANK} AS k FROM ledger_metric), b AS (SELECT bundle_id, w, arg_max(scope, k) AS s FROM r WHERE k IS NOT NULL AND contains(w, ' ') GROUP BY ALL)
        SELECT metric_id, scope, s AS harmonized FROM r JOIN b USING (bundle_id, w) WHERE scope IN ('unknown', 'subgroup', 'variable_or_layer')""",
    "ledger_sorting": f"""SELECT metric_id, CASE WHEN context = 'selection_or_tuning' AND len({_families('name')}) = 0 AND regexp_matches({_SORTING}, '\\b(threshold|multiplier|hyperparameter|parameter|setting)s?\\b[^.;]{{0,100}}(candidate|tested|evaluated|grid|range|set of|values?|levels?|=)|\\b(candidate|tested|evaluated|grid|range|set of|values?|levels?|=)[^.;]{{0,80}}\\b(threshold|multiplier|hyperparameter|parameter|setting)s?\\b')
        THEN 'parameters' WHEN regexp_matches({_SORTING}, '\\bno standalone numerical (summary|value|result)\\b|\\bnot an independently reported validation result\\b') THEN 'evidence' ELSE 'ledger' END AS belongs FROM ledger_metric""",
    "ledger_full_merge": _MERGED,
    "structured_evidence": f"""SELECT evidence_id, coalesce((item_type = 'table' AND source_modality = 'author_table') OR (item_type = 'figure' AND source_modality IN ('author_figure', 'author_caption')) OR (item_type = 'formula' AND source_modality = 'author_formula'), false)
        OR (coalesce(source_modality, 'unknown') = 'unknown' AND coalesce(representation_method IN ('docling_structured', 'structured_visual_recovery'), false)) AS structured FROM evidence LEFT JOIN (SELECT bundle_id, source_item_id, item_type FROM {_REGISTRY}) USING (bundle_id, source_item_id)""",
    "locator_counts": """SELECT bundle_id, count(*) FILTER (evidence_type = 'explicit' AND source_text IS NULL AND source_item_id IS NULL AND source_section IS NULL) AS weak_locators,
        count(*) FILTER (representation_method = 'structured_visual_recovery' AND coalesce(source_modality, '') NOT IN ('author_table', 'author_figure', 'author_caption', 'author_formula')) AS odd_modalities FROM evidence GROUP BY ALL""",
    "record_summary": f"""WITH c AS (SELECT record_id, count(*) FILTER (k = 'm') AS metrics, count(*) FILTER (k = 'p') AS parameters, count(*) FILTER (k = 'e') AS section_evidence FROM (SELECT record_id, 'm' AS k FROM {problems._METRIC} UNION ALL SELECT record_id, 'p' FROM {problems._PARAMETER}
          UNION ALL SELECT record_id, 'e' FROM {problems._elements(problems._VD, 'record_id', "v->'$.evidence'")}) GROUP BY ALL)
        SELECT record_id, j->>'$.document_metadata.title' AS title, j->>'$.document_metadata.document_status' AS status, j->>'$.extraction_provenance.schema_version' AS schema_version, coalesce(metrics, 0) AS metrics, coalesce(parameters, 0) AS parameters,
        coalesce(section_evidence, 0) AS section_evidence FROM (SELECT record_id, cast(record_json AS JSON) AS j FROM matrix_record) LEFT JOIN c USING (record_id)""",
    "numbered_sections": """WITH p AS (SELECT doc_id, unnest(string_split(regexp_replace(regexp_replace(text, '(?m)^#+ ([0-9]+) ', '\\1. ', 'g'), '(?m)^([0-9]+)\\.[ \\t]+', chr(1) || '\\1' || chr(2), 'g'), chr(1))) AS x FROM documents),
        i AS (SELECT doc_id, try_cast(split_part(x, chr(2), 1) AS INTEGER) AS number, regexp_replace(split_part(x, chr(2), 2), '^\\s+|\\s+$', '', 'g') AS item FROM p WHERE contains(x, chr(2)))
        SELECT doc_id, number, count(*) AS items, cast(max(length(item)) AS BIGINT) AS longest FROM i WHERE item <> '' GROUP BY ALL""",
    "metric_dedup_fold": _D1,
    "parse_quantity": f"SELECT * FROM {_quantity('ledger_metric', 'metric_id', 'as_reported', 'name', 'unit')}",
    "quantity_conflict_issues": f"SELECT code, severity, count(*) AS issues FROM ({_QUANTITY_ISSUES}) GROUP BY ALL",
    "number_identity": "SELECT key, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM (SELECT regexp_replace(regexp_replace(cast(cast(cast(l_discount AS VARCHAR) AS DECIMAL(38,18)) AS VARCHAR), '0+$', ''), '[.]$', '') AS key, l_quantity FROM lineitem) GROUP BY ALL",
    "metric_families": f"SELECT metric_id, array_to_string({_families('name')}, ',') AS families, {_identity('name')} AS identity FROM ledger_metric",
    "target_token_key": f"SELECT {_token_key('target')} AS target_key, count(*) AS n FROM metric_hint WHERE target IS NOT NULL GROUP BY ALL",
    "content_tokens": f"""SELECT token, count(*) AS n FROM (SELECT unnest(list_distinct(list_transform(list_filter({_tokens('caption')}, lambda t: length(t) >= 3 AND t NOT IN ({', '.join(_q(w) for w in text.STOP_WORDS)})),
        lambda t: regexp_replace(t, '^(...+)s$', '\\1')))) AS token FROM registry_item WHERE caption IS NOT NULL) GROUP BY ALL""",
    "registry_locator_join": f"""SELECT e.evidence_id, coalesce(r.source_page, e.source_page) AS source_page, coalesce(r.source_location, e.source_location) AS source_location, coalesce(r.section_hint, e.source_section) AS source_section,
        r.item_type IS NOT NULL AS known_item FROM evidence e LEFT JOIN {_REGISTRY} r USING (bundle_id, source_item_id)""",
    "registry_unknown_item": _UNKNOWN,
    "issue_catalogue": f"SELECT code, severity, count(*) AS issues FROM ({_QUANTITY_ISSUES} UNION ALL {_SCOPE_ISSUES} UNION ALL {_LOCATOR_ISSUES}) GROUP BY ALL",
    "scope_issues": f"SELECT record, code FROM ({_SCOPE_ISSUES})",
    "table_unpivot": "SELECT l_returnflag, l_linestatus, column_label, count(*) AS n, round(sum(value), 1) AS total FROM (UNPIVOT (SELECT l_returnflag, l_linestatus, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem) ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME column_label VALUE value) GROUP BY ALL",
    "sibling_gaps": f"""WITH have AS (SELECT DISTINCT bundle_id, {_families('name')}[1] AS family FROM ledger_metric WHERE len({_families('name')}) > 0)
        SELECT DISTINCT bundle_id, {_families('metric_name')}[1] AS family FROM metric_hint WHERE len({_families('metric_name')}) > 0 AND bundle_id IN (SELECT bundle_id FROM have) EXCEPT SELECT * FROM have""",
    "table_target_rows": f"""SELECT bundle_id, source_item_id, count(DISTINCT {_token_key('target')}) AS targets, count(DISTINCT {_families('metric_name')}[1]) AS families FROM metric_hint
        WHERE source_item_id IS NOT NULL AND target IS NOT NULL GROUP BY ALL HAVING targets >= 2 AND families >= 2""",
    "context_consensus": "SELECT bundle_id, scope, CASE WHEN count(DISTINCT evaluation_support) = 1 THEN min(evaluation_support) END AS evaluation_support, count(evaluation_support) AS votes FROM ledger_metric GROUP BY bundle_id, scope",
    "scope_mode": "SELECT bundle_id, scope, votes FROM (SELECT *, row_number() OVER (PARTITION BY bundle_id ORDER BY votes DESC, scope) AS k FROM (SELECT bundle_id, scope, count(*) AS votes FROM ledger_metric WHERE scope IS NOT NULL GROUP BY ALL)) WHERE k = 1",
    "fitness_views": f"SELECT metric_id, CASE WHEN context IN ({_VIEWS}) THEN 'producer' ELSE 'downstream' END AS view, context FROM ledger_metric WHERE context IN ({_VIEWS}, {_q(ledger.DOWNSTREAM_CONTEXT)})",
    "ledger_outer_merge": f"""WITH a AS (SELECT bundle_id, {_identity('metric_name')} AS identity, arg_min(value, hint_id) AS value FROM metric_hint WHERE metric_name IS NOT NULL GROUP BY ALL),
        b AS (SELECT bundle_id, {_identity('name')} AS identity, arg_min(as_reported, metric_id) AS value FROM ledger_metric WHERE name IS NOT NULL GROUP BY ALL)
        SELECT bundle_id, identity, coalesce(b.value, a.value) AS value, CASE WHEN a.value IS NULL THEN 'repair' WHEN b.value IS NULL THEN 'initial' ELSE 'both' END AS origin FROM a FULL JOIN b USING (bundle_id, identity)""",
    "composite_metrics": f"""WITH r AS (SELECT metric_id, bundle_id, context, {_families('name')} AS f FROM ledger_metric),
        s AS (SELECT bundle_id, context, list(DISTINCT f[1]) AS have FROM r WHERE len(f) = 1 GROUP BY ALL)
        SELECT metric_id, coalesce(list_has_all(coalesce(have, []), f), false) AS redundant FROM r LEFT JOIN s USING (bundle_id, context) WHERE len(f) > 1""",
    "target_subsets": f"""WITH d AS (SELECT DISTINCT bundle_id, source_item_id, {_SET.format(x=_tokens('target'))} AS words FROM metric_hint WHERE target IS NOT NULL AND source_item_id IS NOT NULL)
        SELECT a.bundle_id, a.source_item_id, array_to_string(a.words, ' ') AS parent, array_to_string(b.words, ' ') AS child FROM d a JOIN d b ON a.bundle_id = b.bundle_id AND a.source_item_id = b.source_item_id
        AND len(a.words) < len(b.words) AND len(a.words) > 0 AND list_has_all(b.words, a.words)""",
    "caption_overlap": f"""WITH r AS (SELECT bundle_id, caption, min(source_item_id) || '#' || caption AS id FROM registry_item WHERE caption IS NOT NULL GROUP BY bundle_id, caption),
        w AS (SELECT bundle_id, id, list_distinct({_tokens('caption')}) AS words FROM r),
        p AS (SELECT a.bundle_id, len(list_intersect(a.words, b.words)) / len(list_distinct(list_concat(a.words, b.words))) AS j FROM w a JOIN w b ON a.bundle_id = b.bundle_id AND a.id < b.id)
        SELECT bundle_id, count(*) AS pairs, round(max(j), 6) AS most FROM p WHERE j >= 0.6 GROUP BY ALL""",
    "stem_document_frequency": f"SELECT stem, count(*) AS documents FROM (SELECT unnest(list_distinct(list_transform(list_filter({_tokens('text')}, lambda t: length(t) >= 5), lambda t: substr(t, 1, 7)))) AS stem FROM documents) GROUP BY ALL",
    "sentence_windows": f"""WITH s AS (SELECT doc_id, {_SENTENCES} AS s FROM documents), w AS (SELECT doc_id, unnest(generate_series(1, len(s))) AS i, s FROM s),
        v AS (SELECT doc_id, 2 * i AS o, s[i] AS w FROM w UNION ALL SELECT doc_id, 2 * i + 1, s[i] || ' ' || s[i + 1] FROM w WHERE i < len(s))
        SELECT doc_id, count(*) AS windows, cast(sum(length(w)) AS BIGINT) AS characters, count(*) - 1 AS last FROM v WHERE length(w) <= 1800 GROUP BY doc_id""",
    "heading_context": f"""SELECT bundle_id, heading, count(*) AS lines FROM (SELECT bundle_id, last_value(CASE WHEN regexp_matches(line, '^#+ ') THEN trim(regexp_replace(line, '^#+ ', '')) END IGNORE NULLS)
        OVER (PARTITION BY bundle_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS heading FROM {_LINES.format(k='bundle_id', t='text_for_llm', s='source_bundle')}) GROUP BY ALL""",
    "paragraphs": f"""WITH l AS (SELECT *, sum(CASE WHEN trim(line) = '' OR regexp_matches(line, '^#+ ') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS par FROM {_LINES.format(k='doc_id', t='text', s='documents')}),
        p AS (SELECT doc_id, par, sum(length(line)) + count(*) - 1 AS n FROM l WHERE trim(line) <> '' AND NOT regexp_matches(line, '^#+ ') GROUP BY ALL) SELECT doc_id, count(*) AS paragraphs, cast(max(n) AS BIGINT) AS longest FROM p GROUP BY ALL""",
    "candidate_ids": "SELECT hint_id, substr(sha256(bundle_id || chr(10) || coalesce(source_item_id, '') || chr(10) || coalesce(target, '') || chr(10) || coalesce(metric_name, '') || chr(10) || coalesce(value, '')), 1, 16) AS id FROM metric_hint",
    "canonical_json_ids": "SELECT evidence_id, sha256(cast(json_object('claim', claim, 'source_item_id', source_item_id, 'source_page', source_page, 'source_section', source_section, 'source_text', source_text) AS VARCHAR)) AS identity FROM evidence",
    "caption_parse": f"""SELECT bundle_id, source_item_id, CASE lower(substr(regexp_extract(caption, {_q(text.CAPTION)}, 1), 1, 3)) WHEN 'tab' THEN 'table' WHEN 'fig' THEN 'figure' END AS kind,
        nullif(regexp_extract(caption, {_q(text.CAPTION)}, 2), '') AS number, nullif(regexp_extract(caption, {_q(text.CAPTION)}, 4), '') AS body FROM (SELECT DISTINCT * FROM registry_item)""",
    "box_overlap": """WITH r AS (SELECT DISTINCT l_orderkey AS o, l_quantity AS l, l_quantity + 20 AS r, l_discount * 100 AS t, l_discount * 100 + 10 AS b, l_partkey, l_suppkey, l_linenumber FROM lineitem),
        p AS (SELECT greatest(least(a.r, b.r) - greatest(a.l, b.l), 0.0) * greatest(least(a.b, b.b) - greatest(a.t, b.t), 0.0) AS s, (a.r - a.l) * (a.b - a.t) + (b.r - b.l) * (b.b - b.t) AS u
        FROM r a JOIN r b ON a.o = b.o AND (a.l, a.r, a.t, a.b, a.l_partkey, a.l_suppkey, a.l_linenumber) < (b.l, b.r, b.t, b.b, b.l_partkey, b.l_suppkey, b.l_linenumber))
        SELECT iou, count(*) AS pairs FROM (SELECT round(s / (u - s), 6) AS iou FROM p) WHERE iou >= 0.45 GROUP BY ALL""",
    "table_quality": f"""WITH j AS (SELECT table_id, u FROM recovered_row JOIN (SELECT row_id, CASE WHEN reason IS NULL OR reason = 'invalid_value' THEN u END AS u FROM {problems._ROWS}) USING (row_id)),
        c AS (SELECT table_id, count(*) AS rows, count(u) AS parsed, sum(len(u)) AS n, sum(len(list_filter(u, lambda x: trim(x) = ''))) AS e, sum(len(u[1:2])) AS ln, sum(len(list_filter(u[1:2], lambda x: trim(x) = ''))) AS le FROM j GROUP BY ALL),
        h AS (SELECT row_id AS table_id, reason IS NULL AND len(list_filter(u, lambda c: trim(c) = '')) = 0 AND len(list_distinct(list_transform(u, lambda c: trim(c)))) = len(u) AS has_header FROM {problems._HEADS}),
        t AS (SELECT table_id, coalesce(rows, 0) AS rows, len(column_types) AS columns, coalesce(has_header, false) AS has_header, (n - e) / n AS ne, le / ln AS lb, coalesce(rows > 0, false) AND coalesce(parsed, 0) = 0 AS failed FROM recovered_table JOIN h USING (table_id) LEFT JOIN c USING (table_id)),
        p AS (SELECT table_id, CASE WHEN failed THEN 5 ELSE 0 END AS f, CASE WHEN rows < 2 OR columns < 2 THEN 4 ELSE 0 END AS a, CASE WHEN ne < 0.35 THEN 3 WHEN ne < 0.55 THEN 1 ELSE 0 END AS b, CASE WHEN columns >= 4 AND rows >= 4 AND NOT has_header THEN 1 ELSE 0 END AS c,
          CASE WHEN lb >= 0.70 AND rows >= 6 THEN 2 ELSE 0 END AS d FROM t)
        SELECT table_id, cast(f + a + b + c + d AS BIGINT) AS risk_points, concat_ws(';', CASE WHEN f > 0 THEN 'export_failed' END, CASE WHEN a > 0 THEN 'too_small' END, CASE WHEN b > 0 THEN 'sparse' END, CASE WHEN c > 0 THEN 'no_header' END, CASE WHEN d > 0 THEN 'leading_blank' END) AS reason_codes,
        CASE WHEN f + a + b + c + d >= 4 THEN 'required' WHEN f + a + b + c + d >= 2 THEN 'recommended' WHEN f + a + b + c + d >= 1 THEN 'review' ELSE 'not_needed' END AS status FROM p""",
    "queue_dedup": """SELECT event_id, user_id, event_type, day FROM (SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY CASE event_type WHEN 'error' THEN 3 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 1 ELSE 0 END DESC, event_id) AS k
        FROM (SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d') AS day FROM events)) WHERE k = 1""",
    "last_event": "SELECT user_id, arg_max(event_id, ts) AS event_id, arg_max(event_type, ts) AS event_type, count(*) AS events FROM events GROUP BY ALL",
    "bundle_gate": """SELECT bundle_id, recovered, coalesce(q, false) AS all_quoted, coalesce(l, false) AS all_located, recovered AND coalesce(q, false) AND coalesce(l, false) AS ready FROM
        (SELECT bundle_id, coalesce(source_fidelity_status <> 'needs_recovery', false) AS recovered FROM source_bundle) LEFT JOIN
        (SELECT bundle_id, bool_and(source_text IS NOT NULL) AS q, bool_and(source_page IS NOT NULL OR source_item_id IS NOT NULL) AS l FROM evidence GROUP BY ALL) USING (bundle_id)""",
    "quality_summary": "SELECT count(*) AS metrics, count(unit) AS with_unit, count(*) - count(value_or_summary) AS without_summary, count(DISTINCT bundle_id) AS bundles, count(DISTINCT lower(name)) AS names, count(*) - count(scope_label) AS without_label FROM ledger_metric",
    "text_chunks": """SELECT bundle_id, cast(i AS INTEGER) AS chunk_index, cast(n AS INTEGER) AS chunk_count, sha256(substr(text_for_llm, i * 4000 + 1, 4000)) AS sha256 FROM
        (SELECT bundle_id, text_for_llm, n, unnest(generate_series(0, n - 1)) AS i FROM (SELECT bundle_id, text_for_llm, cast(greatest(ceil(length(text_for_llm) / 4000.0), 1) AS BIGINT) AS n FROM source_bundle WHERE text_for_llm IS NOT NULL))""",
    "evidence_first_wins": f"SELECT min(evidence_id) AS evidence_id, bundle_id FROM (SELECT evidence_id, bundle_id, coalesce({_squeezed('source_text')}, 'claim:' || {_squeezed('claim')}) AS k FROM evidence) GROUP BY bundle_id, k",
    "hints_per_item": "SELECT bundle_id, hint_id, cast(k AS INTEGER) AS rank FROM (SELECT bundle_id, hint_id, row_number() OVER (PARTITION BY bundle_id ORDER BY hint_id) AS k FROM metric_hint WHERE kind = 'prose_metric_candidate') WHERE k <= 220",
    "focus_groups": "SELECT bundle_id, source_item_id, target, count(*) AS n, string_agg(metric_name, '; ' ORDER BY hint_id) AS names FROM metric_hint WHERE source_item_id IS NOT NULL AND target IS NOT NULL AND metric_name IS NOT NULL GROUP BY ALL HAVING n >= 2",
    "distinct_locations": "SELECT bundle_id, coalesce(string_agg(DISTINCT source_item_id, '; ' ORDER BY source_item_id), '') AS items, coalesce(string_agg(DISTINCT source_location, '; ' ORDER BY source_location), '') AS locations FROM evidence GROUP BY ALL",
    "peer_targets": f"SELECT bundle_id, section_hint, {_identity('metric_name')} AS identity, value, count(DISTINCT {_token_key('target')}) AS targets, count(*) AS hints FROM metric_hint WHERE kind = 'prose_metric_candidate' GROUP BY ALL",
    "portable_paths": "SELECT bundle_id, " + _portable("('/data/packages/p' || bundle_id || '/raw/' || source_filename)") + " AS inside, " + _portable("('C:\\incoming\\' || source_filename)") + " AS elsewhere, " + _portable("source_filename") + " AS relative FROM source_bundle",
    "page_statistics": "SELECT source_fidelity_status, cast(sum(page_count) AS BIGINT) AS pages, round(median(page_count), 3) AS median_pages, round(avg(CASE WHEN length(text_for_llm) / page_count < 500 THEN 1.0 ELSE 0.0 END), 6) AS thin FROM source_bundle GROUP BY ALL",
    "terminology": """SELECT evidence_id, sha256(t) AS sha256 FROM (SELECT evidence_id, claim, regexp_replace(regexp_replace(regexp_replace(claim, '(?i)\\buser accuracy\\b', 'users accuracy', 'g'), '(?i)\\bpercent bias\\b', 'relative bias', 'g'),
        '(?i)\\blinear correlation\\b', 'product-moment correlation', 'g') AS t FROM evidence) WHERE t <> claim""",
    "section_relations": f"""WITH s AS (SELECT DISTINCT bundle_id, source_section AS x, {_anchor('source_section')} AS k FROM evidence WHERE source_section IS NOT NULL)
        SELECT p.bundle_id, p.x AS a, q.x AS b FROM s p JOIN s q ON p.bundle_id = q.bundle_id AND p.x < q.x WHERE p.k = q.k OR (regexp_matches(p.k, '^[0-9]') AND regexp_matches(q.k, '^[0-9]') AND (starts_with(p.k, q.k || '.') OR starts_with(q.k, p.k || '.')))""",
    "caption_bodies": f"""SELECT doc_id, cast(line_no AS INTEGER) AS line_no, n AS body_lines FROM (SELECT *, count(CASE WHEN regexp_matches(line, '^\\s*\\|.*\\|\\s*$') THEN 1 END) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 1 FOLLOWING AND 13 FOLLOWING) AS n
        FROM {_LINES.format(k='doc_id', t='text', s='documents')}) WHERE regexp_matches(line, '^(Table|Figure)\\s+[0-9]+\\.')""",
    "prose_pairs": f"""SELECT hint_id, nullif(trim(regexp_extract(excerpt, {_q(discovery.PAIR)}, 1)), '') AS pair_name, nullif(trim(regexp_extract(excerpt, {_q(discovery.PAIR)}, 2)), '') AS relation,
        nullif(trim(regexp_extract(excerpt, {_q(discovery.PAIR)}, 3)), '') AS pair_value, coalesce(nullif(trim(regexp_extract(excerpt, {_q(discovery.PAIR)}, 4)), ''), nullif(trim(regexp_extract(excerpt, {_q(discovery.PAIR)}, 5)), '')) AS pair_target,
        regexp_matches(lower(excerpt), {_q(discovery.SUMMARY)}) AS summary FROM metric_hint WHERE excerpt IS NOT NULL""",
    "table_cell_hints": f"""WITH h AS (SELECT row_id AS table_id, u AS names, reason IS NULL AND len(list_filter(u, lambda c: trim(c) = '')) = 0 AND len(list_distinct(list_transform(u, lambda c: trim(c)))) = len(u) AS fine FROM {problems._HEADS}),
        r AS (SELECT row_id, table_id, u, types, CASE WHEN fine THEN list_transform(names, lambda c: trim(c)) END AS names FROM {problems._ROWS} r JOIN (SELECT row_id, table_id FROM recovered_row) USING (row_id) JOIN h USING (table_id) WHERE reason IS NULL)
        SELECT row_id, cast(i - 1 AS INTEGER) AS cell_ord, list_filter(list_transform(generate_series(1, len(u)), lambda k: CASE WHEN types[k] = 'text' THEN nullif(u[k], '') END), lambda x: x IS NOT NULL)[1] AS target,
        coalesce(names[i], 'c' || (i - 1)) AS column_label, u[i] AS value FROM (SELECT *, unnest(generate_series(1, len(u))) AS i FROM r) WHERE types[i] IN ('int', 'double') AND regexp_matches(u[i], '[0-9]')""",
    "ledger_backfill": f"""WITH h AS (SELECT bundle_id, {_identity('metric_name')} AS k, {_families('metric_name')}[1] AS f, {_squeezed('value')} AS s, min(hint_id) AS hint_id FROM metric_hint WHERE metric_name IS NOT NULL AND target IS NOT NULL AND value IS NOT NULL GROUP BY ALL),
        l AS (SELECT bundle_id, metric_id, {_identity('name')} AS k, {_families('name')}[1] AS f, {_squeezed('as_reported')} AS s, context, scope FROM ledger_metric WHERE name IS NOT NULL),
        a AS (SELECT bundle_id, k, min(metric_id) AS id FROM l GROUP BY ALL), b AS (SELECT bundle_id, f, min(metric_id) AS id FROM l WHERE f IS NOT NULL GROUP BY ALL)
        SELECT hint_id, h.bundle_id, h.k AS identity, CASE WHEN a.id IS NOT NULL THEN 'metric' ELSE 'family' END AS prototype, p.context, p.scope FROM h LEFT JOIN a ON a.bundle_id = h.bundle_id AND a.k = h.k LEFT JOIN b ON b.bundle_id = h.bundle_id AND b.f = h.f
        JOIN ledger_metric p ON p.metric_id = coalesce(a.id, b.id) WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.bundle_id = h.bundle_id AND l.k = h.k AND l.s = h.s)""",
    "evidence_merge": f"""WITH r AS (SELECT *, coalesce({_squeezed('source_text')}, 'claim:' || {_squeezed('claim')}) AS k, CASE review_status WHEN 'human_verified' THEN 10 WHEN 'human_corrected' THEN 20 ELSE 0 END AS rank,
        {' + '.join(f'CASE WHEN {c} IS NOT NULL THEN {p} ELSE 0 END' for c, p in discovery.EVIDENCE_POINTS.items())} AS pts FROM evidence),
        o AS (SELECT *, row_number() OVER w AS n, max(source_page) OVER g AS mp, max(source_section) OVER g AS ms, max(rank) OVER g AS mr, count(*) OVER g AS c FROM r WINDOW w AS (PARTITION BY bundle_id, source_item_id, k ORDER BY pts + rank DESC, evidence_id), g AS (PARTITION BY bundle_id, source_item_id, k))
        SELECT evidence_id, bundle_id, coalesce(source_page, mp) AS source_page, coalesce(source_section, ms) AS source_section, mr AS review_rank, c AS merged FROM o WHERE n = 1""",
    "record_fields": """SELECT path, count(*) AS n, count(DISTINCT record_id) AS records FROM (SELECT record_id, regexp_replace(t.fullkey, '\\[[0-9]+\\]', '[]', 'g') AS path FROM matrix_record, json_tree(cast(record_json AS JSON)) t WHERE t.atom IS NOT NULL AND t.type <> 'NULL') GROUP BY ALL""",
    "provenance_issues": """SELECT record, code FROM (SELECT record_id AS record, CASE WHEN has IS NULL THEN 'EXTRACTION_PROVENANCE_MISSING' WHEN e IS NOT NULL AND m IS NULL THEN 'CANONICAL_SOURCE_HASH_MISSING' WHEN e <> m THEN 'CANONICAL_SOURCE_HASH_MISMATCH' END AS code
        FROM (SELECT record_id, json_extract_string(record_json, '$.extraction_provenance') AS has, json_extract_string(record_json, '$.extraction_provenance.canonical_source_sha256') AS m, CASE WHEN regexp_full_match(source_sha256, '[0-9a-f]{64}') THEN source_sha256 END AS e
        FROM matrix_record LEFT JOIN source_bundle USING (bundle_id))) WHERE code IS NOT NULL""",
    "bundle_digest": f"SELECT bundle_id, sha256(string_agg(caption, chr(10) || chr(10) ORDER BY source_item_id)) AS sha256 FROM {_REGISTRY} WHERE caption IS NOT NULL GROUP BY ALL",
    "stream_last_event": "SELECT user_id, arg_max(event_id, ts) AS event_id, arg_max(event_type, ts) AS event_type FROM events GROUP BY ALL",
    "stream_hourly_counts": "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n FROM events GROUP BY ALL",
    "recovery_queue": f"""SELECT bundle_id, source_item_id, item_type, status, priority, reason FROM (SELECT *, row_number() OVER (PARTITION BY bundle_id, source_item_id ORDER BY k) AS n FROM (
        SELECT *, 0 AS k, 'required' AS status, 'high' AS priority, 'table_without_caption' AS reason FROM {_REGISTRY} WHERE item_type = 'table' AND caption IS NULL
        UNION ALL SELECT *, 1, 'recommended', 'medium', 'item_without_caption' FROM {_REGISTRY} WHERE item_type <> 'table' AND caption IS NULL
        UNION ALL SELECT *, 2, 'review', 'medium', 'page_unknown' FROM {_REGISTRY} WHERE source_page IS NULL
        UNION ALL SELECT *, 3, 'review', 'low', 'section_unknown' FROM {_REGISTRY} WHERE section_hint IS NULL)) WHERE n = 1""",
    "guardrail_coverage": f"""WITH m AS (SELECT bundle_id, evidence_id AS item_id, unnest({_STEMS.format(x='source_text')}) AS stem FROM evidence WHERE source_text IS NOT NULL),
        d AS (SELECT bundle_id, stem, count(*) AS df FROM m GROUP BY ALL), t AS (SELECT DISTINCT bundle_id, unnest({_STEMS.format(x='text')}) AS stem FROM documents),
        c AS (SELECT bundle_id, item_id, count(*) FILTER (df = 1) AS rare, count(*) FILTER (df = 1 AND t.stem IS NOT NULL) AS rare_hits, count(*) FILTER (t.stem IS NOT NULL) AS hits FROM m JOIN d USING (bundle_id, stem) LEFT JOIN t USING (bundle_id, stem) GROUP BY ALL)
        SELECT bundle_id, item_id, CASE WHEN rare >= 2 THEN rare_hits ELSE hits END >= 2 AS covered FROM c""",
    "registry_build": """SELECT bundle_id, source_item_id, 'table' AS item_type, cast(source_page AS INTEGER) AS source_page, CASE WHEN regexp_matches(caption, '^Table [0-9]+') THEN 'Table ' || regexp_extract(caption, '^Table ([0-9]+)', 1)
        ELSE regexp_replace(source_item_id, '^tbl_0*', 'Table ') END AS source_location, caption FROM recovered_table""",
    "prose_hints": f"""WITH s AS (SELECT evidence_id, {_SENTENCES.replace('text', 'claim')} AS s FROM evidence), w AS (SELECT evidence_id, unnest(generate_series(1, len(s))) AS i, s FROM s),
        v AS (SELECT evidence_id, lower(s[i]) AS w FROM w UNION ALL SELECT evidence_id, lower(s[i] || ' ' || s[i + 1]) FROM w WHERE i < len(s))
        SELECT evidence_id, count(*) AS hints, count(*) FILTER (regexp_matches(w, '\\b(median|mean|average|overall|respectively)\\b|±')) AS summaries FROM v
        WHERE length(w) <= 1800 AND EXISTS (SELECT 1 FROM {_LISTED} l WHERE contains({_phrase('w')}, l.p)) AND regexp_matches(w, '[0-9]') GROUP BY evidence_id""",
    "guardrail_sections": f"""WITH h AS (SELECT bundle_id, line_no, length(regexp_extract(line, '^(#+)', 1)) AS level, trim(regexp_replace(line, '^#+ ', '')) AS title FROM {_LINES.format(k='bundle_id', t='text_for_llm', s='source_bundle')} WHERE regexp_matches(line, '^#+ '))
        SELECT a.bundle_id, cast(a.line_no AS INTEGER) AS start, a.title, cast((SELECT min(b.line_no) FROM h b WHERE b.bundle_id = a.bundle_id AND b.line_no > a.line_no AND b.level <= a.level) AS INTEGER) AS end FROM h a WHERE regexp_matches(lower(a.title), 'limitation|quality|discussion')""",
    "scope_labels": r"""SELECT trim(regexp_replace(trim(regexp_replace(scope_label, '\s*(;|\||,).*$', '')), '(?i)\s+and\s+(mae|rmse|bias|error|accuracy)s?$', '')) AS target, scope, count(*) AS n FROM ledger_metric WHERE scope_label IS NOT NULL GROUP BY ALL""",
    "unit_consensus": f"""WITH r AS (SELECT metric_id, bundle_id, {_identity('name')} AS k, unit FROM ledger_metric WHERE name IS NOT NULL), c AS (SELECT bundle_id, k, min(unit) AS v FROM r WHERE unit IS NOT NULL GROUP BY ALL HAVING count(DISTINCT unit) = 1)
        SELECT metric_id, coalesce(unit, v) AS unit, unit IS NULL AND v IS NOT NULL AS filled FROM r LEFT JOIN c USING (bundle_id, k)""",
    "batch_summary": "SELECT bundle_id, source_fidelity_status, page_count, " + ", ".join(f"(SELECT count(*) FROM {t} x WHERE x.bundle_id = b.bundle_id) AS {t}s" for t in ("registry_item", "metric_hint", "evidence", "ledger_metric")) + " FROM source_bundle b",
    "metric_headers": f"""SELECT name, count(*) AS tables FROM (SELECT unnest(list_transform(u, lambda c: trim(c))) AS name FROM {problems._HEADS} WHERE reason IS NULL AND len(list_filter(u, lambda c: trim(c) = '')) = 0
        AND len(list_distinct(list_transform(u, lambda c: trim(c)))) = len(u)) WHERE len({_families('name')}) > 0 GROUP BY ALL""",
    "prose_unrepresented": f"""WITH h AS (SELECT bundle_id, hint_id, {_identity('metric_name')} AS identity, {_tokens("coalesce(target, '')")} AS w FROM metric_hint WHERE kind = 'prose_metric_candidate' AND metric_name IS NOT NULL),
        r AS (SELECT bundle_id, {_identity('name')} AS identity, {_tokens("coalesce(scope_label, '')")} AS w FROM ledger_metric WHERE name IS NOT NULL)
        SELECT hint_id, bundle_id, identity FROM h WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.bundle_id = h.bundle_id AND r.identity = h.identity AND (len(h.w) = 0 OR list_has_any(r.w, h.w)))""",
}

_KIDS = " UNION ALL ".join(f"SELECT record_id, x FROM {e}" for e in (problems._METRIC, problems._PARAMETER, problems._elements(problems._VD, "record_id", "v->'$.evidence'"), _ITEMS,
    problems._elements(f"(SELECT record_id, ord AS parent, x FROM {problems._PARAMETER})", "record_id, parent", "x->'$.evidence'")))
SQL["record_unknown_items"] = f"""SELECT DISTINCT k.record_id, k.x->>'$.source_item_id' AS item FROM ({_KIDS}) k JOIN matrix_record r USING (record_id) WHERE k.x->>'$.source_item_id' IS NOT NULL
    AND r.bundle_id IN (SELECT bundle_id FROM registry_item WHERE source_item_id IS NOT NULL) AND NOT EXISTS (SELECT 1 FROM registry_item i WHERE i.bundle_id = r.bundle_id AND i.source_item_id = k.x->>'$.source_item_id')"""
_PROVENANCE = "(SELECT record_id, bundle_id, record_json, cast(record_json AS JSON)->'$.extraction_provenance' AS p FROM matrix_record)"
_HASHED = f"(SELECT record_id, p->>'$.source_bundle_sha256' AS mine, bundle_sha256 AS expected FROM {_PROVENANCE} JOIN source_bundle USING (bundle_id) WHERE p IS NOT NULL AND json_type(p) <> 'NULL' AND regexp_full_match(bundle_sha256, '[0-9a-f]{{64}}'))"
_PROVEN = f"""(SELECT m.record_id, m.ord, e.n FROM {problems._METRIC} m LEFT JOIN (SELECT record_id, parent AS ord, count(*) FILTER (coalesce(x->>'$.source_item_id', x->>'$.source_page', x->>'$.source_section') IS NOT NULL) AS n
    FROM {_ITEMS} GROUP BY ALL) e USING (record_id, ord))"""
_RULES = {
    ("QUANTITATIVE_METRIC_EVIDENCE_MISSING", "error"): f"SELECT record_id FROM {_PROVEN} WHERE n IS NULL",
    ("QUANTITATIVE_METRIC_EVIDENCE_WEAK_LOCATOR", "warning"): f"SELECT record_id FROM {_PROVEN} WHERE n = 0",
    ("COMPOSITE_CANONICAL_METRIC_RECORD", "error"): f"""SELECT record_id FROM {problems._METRIC} WHERE len({_families("x->>'$.name'")}) > 1""",
    ("METRIC_SCOPE_LABEL_MULTIPLE_TARGETS", "error"): f"SELECT record_id FROM {problems._METRIC} WHERE regexp_matches(x->>'$.scope_label', '[;|]')",
    ("METRIC_EVIDENCE_SUGGESTS_MISSING_SIBLING", "warning"): f"SELECT record_id FROM ({SQL['evidence_siblings']})",
    ("STRUCTURED_TABLE_METRIC_SIBLINGS_MISSING", "error"): f"SELECT record_id FROM ({SQL['structured_siblings']})",
    ("STRUCTURED_TABLE_TARGET_ROWS_MISSING", "error"): f"SELECT record_id FROM ({SQL['structured_targets']})",
    ("SOURCE_BUNDLE_HASH_MISSING", "error"): f"SELECT record_id FROM {_HASHED} WHERE mine IS NULL",
    ("SOURCE_BUNDLE_HASH_MISMATCH", "error"): f"SELECT record_id FROM {_HASHED} WHERE mine <> expected",
    ("SOURCE_REPRESENTATION_INCOMPLETE", "warning"): f"SELECT record_id FROM {_PROVENANCE} WHERE json_array_length(p->'$.unresolved_source_items') > 0",
    ("DEPRECATED_INTERVAL_CALIBRATION_TERMINOLOGY", "error"): "SELECT record_id FROM matrix_record WHERE regexp_matches(lower(record_json), '\\binterval[- ]calibrat|\\bcalibrated (prediction |confidence )?intervals?\\b')",
}
SQL["record_issue_catalogue"] = "SELECT code, severity, count(*) AS issues, count(DISTINCT record_id) AS records FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS code, '{s}' AS severity, record_id FROM ({q})" for (c, s), q in _RULES.items()) + ") GROUP BY ALL"
_OFFERS = f"(SELECT bundle_id, source_item_id AS item, {_target('target')} AS target, {_identity('metric_name')} AS key, hint_id, value FROM metric_hint WHERE kind = 'structured_table_metric' AND source_item_id IS NOT NULL AND metric_name IS NOT NULL)"
SQL["structured_backfill"] = f"""WITH t AS {_TAKEN}, o AS (SELECT bundle_id, item, target, key, min(hint_id) AS hint_id FROM {_OFFERS} WHERE target IS NOT NULL GROUP BY ALL), p AS (SELECT record_id, bundle_id, item, target, arg_min(context, ord) AS context FROM t GROUP BY ALL)
    SELECT record_id, item, target, key, hint_id, h.value, context FROM p JOIN o USING (bundle_id, item, target) JOIN (SELECT hint_id, value FROM metric_hint) h USING (hint_id)
    WHERE NOT EXISTS (SELECT 1 FROM t u WHERE u.record_id = p.record_id AND u.item = p.item AND u.target = p.target AND u.key = o.key)"""
_TAKE = "CASE WHEN coalesce(r.kind, 'text_summary') = 'text_summary' AND coalesce(s.kind, 'text_summary') <> 'text_summary' THEN s.{c} ELSE r.{c} END AS {c}"
_PARTS = "regexp_split_to_array(coalesce(interpretation, ''), '[;\\n]|[.](\\s|$)')"
_CENTRAL = "'(?i)\\b(?:median|mean)\\b[^0-9]{0,20}([0-9]+(?:[.,][0-9]+)?)'"
_IN = f"list_transform(regexp_extract_all(p, '[0-9]+(?:[.,][0-9]+)?'), lambda x: {_decimal('x')})"
SQL["quantity_backfill"] = f"""WITH j AS (SELECT metric_id, interpretation, {', '.join(_TAKE.format(c=c) for c in ('kind', 'numeric_value', 'lower_bound', 'upper_bound'))}, r.kind = 'range' AS own FROM {_R} r JOIN {_S} s USING (metric_id) JOIN (SELECT metric_id, interpretation FROM ledger_metric) USING (metric_id)),
    v AS (SELECT *, CASE WHEN own THEN list_filter({_PARTS}, lambda p: list_contains({_IN}, abs(lower_bound)) AND list_contains({_IN}, abs(upper_bound)) AND regexp_matches(p, {_CENTRAL}))[1] END AS hit FROM j)
    SELECT metric_id, CASE WHEN hit IS NOT NULL THEN 'estimate_with_range' ELSE kind END AS kind, CASE WHEN hit IS NOT NULL THEN {_decimal(f'regexp_extract(hit, {_CENTRAL}, 1)')} ELSE numeric_value END AS numeric_value, lower_bound, upper_bound FROM v"""
