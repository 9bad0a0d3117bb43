"""DuckDB statements of the checks over the fields of records."""

from __future__ import annotations

from sheaf.operators.record_checks import array_sections, template_members, template_paths
from sheaf.record_template import NUMBER, SAMPLE_MEMBER, SPRAY_SECTION, TECHNIQUES
from workload.fixtures import PARAMETERS, TECHNIQUE_CYCLE


def text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def array(items) -> str:
    return "[" + ", ".join("NULL" if i is None else text(i) for i in items) + "]"


def quoted(c: str) -> str:
    return f"CAST(to_json({c}) AS VARCHAR)"


def cycled(values, k: str) -> str:
    return f"({array(values)})[(doc_id + {k}) % {len(values)} + 1]"


_firsts, _thirds = [p[0] for p in PARAMETERS], [p[1] for p in PARAMETERS]
_shifted = _thirds[1:] + _thirds[:1]

RECORDS = f"""whole AS (
  SELECT doc_id, '{{"文献元数据":{{"标题":' || {quoted('source')}
    || CASE doc_id % 4 WHEN 0 THEN ',"发表年份":' || (2000 + doc_id % 25) WHEN 1 THEN ',"发表年份":" 2001.5 "'
                       WHEN 2 THEN ',"发表年份":null' ELSE '' END
    || ',"关键词":[' || {quoted('lang')} || ',1,"k"],"a~/*":{{"*":[]}}}}'
    || CASE WHEN doc_id % 7 = 0 THEN '' ELSE ',"文献原文信息":{{"摘要":' || {quoted('text')} || ',"结论":null,"重要机理":""}}' END
    || ',"喷涂工艺参数":[' || array_to_string(list_transform(range(1, 2 + doc_id % 3), lambda k:
         '{{"样品/涂层编号":"' || CASE WHEN doc_id % 2 = 0 THEN ' s' || k || ' ' ELSE 'S' || k END
         || '","功能层类型":"工作层","喷涂技术类型":' || coalesce({quoted(cycled(TECHNIQUE_CYCLE, 'k'))}, 'null')
         || ',"工艺参数":{{' || {quoted(cycled(_firsts, 'k'))} || ':' || n_chars || ','
         || CASE WHEN doc_id % 5 = 0 THEN {quoted(cycled(_shifted, 'k'))} ELSE {quoted(cycled(_thirds, 'k'))} END
         || ':null}}}}'), ',')
    || '],"力学性能参数":[' || array_to_string(list_transform(range(1, 2 + doc_id % 4), lambda k:
         '{{"样品/涂层编号":' || CASE WHEN doc_id % 9 = 0 AND k = 1 THEN 'null' ELSE '"S' || k || '"' END
         || ',"显微硬度":{{"类型":"HV","平均值":' || CASE doc_id % 6 WHEN 0 THEN '"n/a"' WHEN 1 THEN '"' || n_chars || '"' ELSE n_chars::VARCHAR END
         || '}},"弹性模量(GPa)":' || n_chars || '}}'), ',')
    || '],"摩擦学性能":' || CASE WHEN doc_id % 11 = 0 THEN 'null' ELSE '[]' END
    || CASE WHEN doc_id % 5 = 0 THEN ',"extra/field":{{"a":[1,{{"b":true}}]}}' ELSE '' END || '}}' AS record
  FROM documents),
recs AS (
  SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN '[' || record || ']'
                      WHEN doc_id % 17 = 0 THEN substr(record, 1, length(record) // 2) ELSE record END AS record FROM whole)"""

_members = ", ".join(
    f"({text(path)}, {text(name)})" for path, names in template_members().items() for name in names
)
_template = ", ".join(f"({text(p)}, {text(k)})" for p, k in template_paths())
_escaped = "CASE WHEN {0} = '*' THEN '~2' ELSE replace(replace({0}, '~', '~0'), '/', '~1') END"

PATHS = f"""RECURSIVE {RECORDS}, nodes AS (
  SELECT doc_id, '' AS path, record::JSON AS v FROM recs WHERE json_valid(record)
  UNION ALL
  SELECT n.doc_id, n.path || '/' || CASE WHEN json_type(n.v) = 'ARRAY' THEN '*' ELSE {_escaped.format('c.key')} END, c.value
  FROM nodes n, json_each(n.v) c WHERE json_type(n.v) IN ('OBJECT', 'ARRAY')),
kinds AS (
  SELECT doc_id, path, CASE json_type(v) WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'NULL' THEN 'null'
    WHEN 'BOOLEAN' THEN 'boolean'
    WHEN 'VARCHAR' THEN CASE WHEN regexp_full_match(v ->> '$', '\\s*[-+]?(\\d+\\.?\\d*|\\.\\d+)([eE][-+]?\\d+)?\\s*')
      THEN 'numeric text' ELSE 'text' END
    ELSE 'number' END AS kind FROM nodes
  UNION ALL
  SELECT doc_id, '', 'broken' FROM recs WHERE NOT json_valid(record)
  UNION ALL
  SELECT doc_id, path || '/' || {_escaped.format('m.name')}, 'absent'
  FROM nodes JOIN (VALUES {_members}) m(parent, name) ON path = parent
  WHERE json_type(v) = 'OBJECT' AND NOT list_contains(json_keys(v), m.name)),
paths AS (SELECT doc_id, path, kind, count(*) AS n FROM kinds GROUP BY ALL),
template(path, kind) AS (VALUES {_template})"""

SECTIONS = f"""{RECORDS}, items AS (
  SELECT doc_id, s.section, (c.key)::INTEGER AS position, s.member, c.value AS item
  FROM recs, (VALUES {", ".join(f"({text(s)}, {text(m)})" for s, m in array_sections().items())}) s(section, member),
       json_each(record::JSON -> ('$."' || s.section || '"')) c
  WHERE json_valid(record) AND json_type(record::JSON) = 'OBJECT' AND json_type(record::JSON -> ('$."' || s.section || '"')) = 'ARRAY'),
numbered AS (SELECT *, nullif(upper(trim(item ->> ('$."' || member || '"'))), '') AS sample_no FROM items)"""

_core = ", ".join(
    f"({text(t)}, {text(p.split('|')[0])}, {array(p.split('|'))})" for t, (core, _) in TECHNIQUES.items() for p in core
)
_allowed = ", ".join(
    f"({text(t)}, {array([s for p in (*core, *other) for s in p.split('|')])})" for t, (core, other) in TECHNIQUES.items()
)

SPRAYED = f"""{SECTIONS}, sprayed AS (
  SELECT doc_id, position, trim(item ->> '$."喷涂技术类型"') AS technique, json_keys(item -> '$."工艺参数"') AS names
  FROM items WHERE section = {text(SPRAY_SECTION)}),
core(technique, name, spellings) AS (VALUES {_core}),
allowed(technique, every) AS (VALUES {_allowed})"""

ORACLE = {
    "array_file_records": f"""SELECT doc_id, sha256(text) AS text_sha, 3 AS n_of,
      length('{{"id":' || doc_id || ',"text":' || {quoted('text')} || ',"of":[{{"lang":' || {quoted('lang')} || '}},"],[",null]}}') AS chars
      FROM documents""",
    "count_array_files": "SELECT count(*) AS samples FROM documents",
    "field_paths": f"WITH {PATHS} SELECT * FROM paths",
    "path_faults": f"""WITH {PATHS}
      SELECT doc_id, path, 'absent' AS fault, kind, n FROM paths WHERE kind = 'absent'
      UNION ALL
      SELECT doc_id, path, 'foreign', kind, n FROM paths
      WHERE kind <> 'absent' AND path <> '' AND path NOT IN (SELECT path FROM template)
        AND regexp_replace(path, '/[^/]*$', '') IN (SELECT path FROM template WHERE kind = 'object')
      UNION ALL
      SELECT doc_id, p.path, 'shape', p.kind, n FROM paths p JOIN template t USING (path)
      WHERE CASE WHEN t.kind = 'array' THEN p.kind NOT IN ('array', 'null', 'absent')
                 WHEN t.kind IN ('object', 'free') THEN p.kind NOT IN ('object', 'null', 'absent')
                 ELSE p.kind IN ('object', 'array') END""",
    "field_fill": f"""WITH {PATHS}
      SELECT t.path, coalesce(sum(n) FILTER (p.kind = 'absent'), 0)::BIGINT AS absent,
        coalesce(sum(n) FILTER (p.kind = 'null'), 0)::BIGINT AS null_values,
        coalesce(sum(n) FILTER (p.kind = 'number'), 0)::BIGINT AS numbers,
        coalesce(sum(n) FILTER (p.kind = 'numeric text'), 0)::BIGINT AS numeric_texts,
        coalesce(sum(n) FILTER (p.kind NOT IN ('absent', 'null', 'number', 'numeric text')), 0)::BIGINT AS others
      FROM template t LEFT JOIN paths p USING (path) WHERE t.kind = {text(NUMBER)} GROUP BY t.path""",
    "section_items": f"WITH {SECTIONS} SELECT doc_id, section, position, sample_no, item::VARCHAR AS item FROM numbered",
    "orphan_samples": f"""WITH {SECTIONS}
      SELECT doc_id, section, sample_no, count(*) AS n FROM numbered a
      WHERE section <> {text(SPRAY_SECTION)} AND member = {text(SAMPLE_MEMBER)} AND (sample_no IS NULL OR NOT EXISTS (
        SELECT 1 FROM numbered b
        WHERE b.doc_id = a.doc_id AND b.section = {text(SPRAY_SECTION)} AND b.sample_no = a.sample_no))
      GROUP BY ALL""",
    "process_param_check": f"""WITH {SPRAYED}
      SELECT doc_id, position, technique, 'missing' AS fault, name AS parameter FROM sprayed JOIN core USING (technique)
      WHERE NOT list_has_any(coalesce(names, []), spellings)
      UNION ALL
      SELECT doc_id, position, technique, 'foreign', name FROM (
        SELECT doc_id, position, technique, unnest(names) AS name, every FROM sprayed JOIN allowed USING (technique))
      WHERE NOT list_contains(every, name)""",
    "technique_check": f"""WITH {SPRAYED}
      SELECT doc_id, position, technique FROM sprayed
      WHERE technique IS NULL OR technique NOT IN (SELECT technique FROM core)""",
}
