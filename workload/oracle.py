"""DuckDB statements of the registered queries, written from the rules, not from the Spark plans."""

from __future__ import annotations

from sheaf.fixed import (
    CORRECTION_TEXT,
    GENERATION_RULES,
    LANGUAGES,
    MAX_SAMPLE_CHARS,
    RECORD_KEYS,
    TASKS,
    TRANSLATION_TEXT,
    WHITESPACE,
)
from workload import record_oracle
from workload.fixtures import IMAGE_HOST, STATUS_CYCLE


def text(s: str) -> str:
    """SQL literal."""
    return "'" + s.replace("'", "''") + "'"


def array(items) -> str:
    return "[" + ", ".join(text(i) for i in items) + "]"


def strip(c: str) -> str:
    return f"trim({c}, {text(WHITESPACE)})"


TASK_ARRAY = array(TASKS.values())


def nth_task(n: str) -> str:
    return f"({TASK_ARRAY})[({n} % 9) + 1]"


def quoted(c: str) -> str:
    return f"CAST(to_json({c}) AS VARCHAR)"


# -- inputs ------------------------------------------------------------------------------
CPT = f"""candidates AS (
  SELECT doc_id AS paper_index, {nth_task('doc_id')} AS task_type, 0 AS pos, ' ' || text || chr(10) AS text FROM documents
  UNION ALL
  SELECT doc_id, {nth_task('doc_id')}, 1, CASE WHEN doc_id % 50 = 0 THEN ' ' || chr(9) ELSE text END FROM documents)"""

TURNS = """turns AS (
  SELECT u.conv_id, u.turn, u.text AS instruction,
         CASE WHEN u.conv_id % 10 = 0 THEN ' ' ELSE coalesce(s.system, 'turn ' || u.turn) END AS input,
         a.text AS output
  FROM conversations u
  JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  LEFT JOIN (SELECT conv_id, min(text) AS system FROM conversations WHERE role = 'system' GROUP BY conv_id) s
    ON s.conv_id = u.conv_id
  WHERE u.role = 'user')"""

CPT_KEPT = f"""{CPT}, stripped AS (SELECT * REPLACE ({strip('text')} AS text) FROM candidates),
kept AS (SELECT * FROM stripped WHERE text <> '' AND length(CAST(to_json({{'text': text}}) AS VARCHAR)) <= {MAX_SAMPLE_CHARS})"""


def first_of(fields: str, source: str = "kept") -> str:
    return (
        f"SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY {fields} "
        "ORDER BY paper_index, task_type, pos) = 1"
    )


SFT_KEPT = f"""{TURNS}, candidates AS (
  SELECT conv_id AS paper_index, {nth_task('conv_id')} AS task_type, CAST(turn + d AS INTEGER) AS pos,
         {strip('instruction')} AS instruction, {strip('input')} AS input, {strip('output')} AS output
  FROM turns, (VALUES (0), (1000)) copies(d)),
kept AS (SELECT * FROM candidates WHERE instruction <> '' AND input <> '' AND output <> ''
  AND length(CAST(to_json({{'task_type': task_type, 'instruction': instruction, 'input': input, 'output': output}}) AS VARCHAR)) <= {MAX_SAMPLE_CHARS})"""

DPO_KEPT = f"""{TURNS}, candidates AS (
  SELECT t.conv_id AS paper_index, {nth_task('t.conv_id')} AS task_type, CAST(t.turn AS INTEGER) AS pos,
         {strip('t.instruction')} AS prompt, {strip('t.output')} AS chosen, {strip('coalesce(l.text, t.output)')} AS rejected
  FROM turns t LEFT JOIN conversations l ON l.conv_id = t.conv_id AND l.turn = t.turn + 3 AND l.role = 'assistant'),
kept AS (SELECT * FROM candidates WHERE prompt <> '' AND chosen <> '' AND rejected <> '' AND chosen <> rejected
  AND length(CAST(to_json({{'prompt': prompt, 'chosen': chosen, 'rejected': rejected}}) AS VARCHAR)) <= {MAX_SAMPLE_CHARS})"""

RECORDS = f"""records AS (
  SELECT doc_id AS paper_index, lang, source, text,
         '{{"文献元数据":{{"标题":' || {quoted('source')} || ',"关键词":[' || {quoted('lang')}
         || ']}},"文献原文信息":{{"摘要":' || {quoted('text')} || '}}}}' AS record FROM documents)"""

PROMPTS = "prompts(prompt_name, task_type) AS (VALUES " + ", ".join(
    f"({text(n)}, {text(t)})" for n, t in TASKS.items()
) + ")"


def matrix(shape: str) -> str:
    rules = GENERATION_RULES.split("%s")
    user = (
        f"'Task: ' || prompt_name || {text(chr(10) * 2 + rules[0] + str(MAX_SAMPLE_CHARS) + rules[1])} || {shape} "
        f"|| {text(rules[2])} || record"
    )
    return f"""WITH {RECORDS}, {PROMPTS}, asked AS (
      SELECT paper_index, task_type,
             CAST(to_json([{{'role': 'user', 'content': {user}}}]) AS VARCHAR) AS input
      FROM records CROSS JOIN prompts)
    SELECT paper_index, task_type, length(input) AS input_chars, sha256(input) AS input_sha FROM asked"""


PAGES = f"""papers AS (
  SELECT doc_id, '/papers/' || doc_id || '.pdf' AS doc_path, CAST(1 + n_chars // 400 AS INTEGER) AS page_count FROM documents),
pages AS (
  SELECT *, (doc_id * 7919 + page_no * 104729) % 12000000 AS image_bytes_len,
         'pdf-pages/' || substr(sha256(doc_path), 1, 16) || '/page-' || printf('%04d', page_no) || '.png' AS object_key
  FROM (SELECT *, CAST(unnest(range(1, page_count + 1)) AS INTEGER) AS page_no FROM papers)),
batches AS (
  SELECT doc_id, doc_path, (page_no - 1) // 20 + 1 AS batch_no, (any_value(page_count) + 19) // 20 AS batch_count,
         min(page_no) AS start_page, max(page_no) AS end_page, max(image_bytes_len) AS biggest,
         list({text(IMAGE_HOST)} || object_key ORDER BY page_no) AS urls
  FROM pages GROUP BY doc_id, doc_path, (page_no - 1) // 20),
bad AS (
  SELECT doc_path, min(page_no) AS first_bad, arg_min(image_bytes_len, page_no) AS bad_bytes
  FROM pages WHERE image_bytes_len > 10485760 GROUP BY doc_path),
guarded AS (
  SELECT b.* FROM batches b LEFT JOIN bad USING (doc_path) WHERE first_bad IS NULL OR end_page < first_bad)"""

STATUS = f"""{PAGES}, outcomes AS (SELECT *, (doc_id + batch_no) % 5 = 0 AS failed FROM guarded),
results AS (
  SELECT p.doc_path, p.doc_id, p.page_count,
         CASE WHEN b.doc_path IS NOT NULL THEN 'failed'
              WHEN coalesce(o.bad, 0) = 0 THEN 'success'
              WHEN o.good > 0 THEN 'partial' ELSE 'failed' END AS status,
         coalesce(o.good, 0) AS n_parts,
         coalesce(o.bad, 0) + CASE WHEN b.doc_path IS NOT NULL THEN 1 ELSE 0 END AS n_errors
  FROM papers p LEFT JOIN bad b USING (doc_path)
  LEFT JOIN (SELECT doc_path, count(*) FILTER (NOT failed) AS good, count(*) FILTER (failed) AS bad
             FROM outcomes GROUP BY doc_path) o USING (doc_path))"""

EXTRACTION_INPUT = f"""to_json([{{'role': 'user', 'content': list_concat(
    list_transform(urls, lambda u: json_object('type', 'input_image', 'image_url', u)),
    [json_object('type', 'input_text', 'text', 'Read the pages.')],
    CASE WHEN corrected THEN [json_object('type', 'input_text', 'text', {text(CORRECTION_TEXT)})] ELSE [] END)}}])"""

_middle = "".join(f',"{k}":[]' for k in RECORD_KEYS[2:-1])
DAMAGED = f"""whole AS (
  SELECT doc_id, '{{"{RECORD_KEYS[0]}":{{"标题":' || {quoted('source')} || '}},"{RECORD_KEYS[1]}":{{"摘要":' || {quoted('text')}
         || '}}{_middle}' || CASE WHEN doc_id % 7 = 0 THEN '' ELSE ',"{RECORD_KEYS[-1]}":'
         || CASE WHEN doc_id % 11 = 0 THEN 'null' ELSE '[]' END END || '}}' AS record FROM documents),
answers AS (
  SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN '[' || record || ']'
                      WHEN doc_id % 17 = 0 THEN substr(record, 1, length(record) // 2) ELSE record END AS answer FROM whole)"""

# what the answer of a response is, and what is inside it
ANSWERS = f"""parts AS (
  SELECT doc_id, n_chars, '{{"text":' || {quoted('text')} || '}}' AS one, '{{"text":' || {quoted('lang')} || '}}' AS other
  FROM documents),
answers AS (
  SELECT *, '[' || one || ',"note",' || other || ']' AS two FROM parts),
told AS (
  SELECT *, CASE doc_id % 10 WHEN 7 THEN '```json' || chr(10) || two || chr(10) || '```'
                             WHEN 8 THEN '{{"note":1,"samples":' || two || '}}'
                             WHEN 9 THEN one ELSE two END AS content FROM answers)"""

NOISY = f"""parts AS (SELECT doc_id, '{{"text":' || {quoted('text')} || '}}' AS one FROM documents)"""

TRANSLATION = f"""{TURNS}, numbered AS (
  SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS id, instruction, input, output FROM turns),
payloads AS (
  SELECT id, instruction, input, output,
         concat_ws(',', CASE WHEN {strip('instruction')} <> '' THEN 'instruction' END,
                        CASE WHEN {strip('input')} <> '' THEN 'input' END,
                        CASE WHEN {strip('output')} <> '' THEN 'output' END) AS names,
         concat_ws(',', CASE WHEN {strip('instruction')} <> '' THEN '"instruction":' || {quoted('instruction')} END,
                        CASE WHEN {strip('input')} <> '' THEN '"input":' || {quoted('input')} END,
                        CASE WHEN {strip('output')} <> '' THEN '"output":' || {quoted('output')} END) AS fields,
         concat_ws(', ', CASE WHEN {strip('instruction')} <> '' THEN '"instruction": ' || {quoted('instruction')} END,
                         CASE WHEN {strip('input')} <> '' THEN '"input": ' || {quoted('input')} END,
                         CASE WHEN {strip('output')} <> '' THEN '"output": ' || {quoted('output')} END) AS spaced
  FROM numbered),
sized AS (
  SELECT *, '{{"id":' || id || ',"fields":{{' || fields || '}}}}' AS payload,
         length('{{"id": ' || id || ', "fields": {{' || spaced || '}}}}') AS chars FROM payloads)"""


def greedy(max_chars: int) -> str:
    return f"""{TRANSLATION}, walk(id, batch_no, n, used) AS (
      SELECT id, CAST(0 AS BIGINT), 1, chars FROM sized WHERE id = 0
      UNION ALL
      SELECT s.id,
             CASE WHEN w.n >= 10 OR w.used + s.chars > {max_chars} THEN w.batch_no + 1 ELSE w.batch_no END,
             CASE WHEN w.n >= 10 OR w.used + s.chars > {max_chars} THEN 1 ELSE w.n + 1 END,
             CASE WHEN w.n >= 10 OR w.used + s.chars > {max_chars} THEN s.chars ELSE w.used + s.chars END
      FROM walk w JOIN sized s ON s.id = w.id + 1),
    batches AS (
      SELECT batch_no, count(*) AS n_records, min(id) AS first_id, max(id) AS last_id,
             '[' || string_agg(payload, ',' ORDER BY id) || ']' AS source_json
      FROM walk JOIN sized USING (id) GROUP BY batch_no)"""


_head, _tail = TRANSLATION_TEXT.split("%s")

LINES = f"""{TURNS}, lines AS (
  SELECT 0 AS src_ordinal, conv_id * 100000 + turn AS line_key, conv_id, turn, instruction, input, output,
         CASE WHEN turn % 6 = 0 THEN NULL WHEN turn % 7 = 0 THEN '  '
              WHEN turn % 5 = 0 THEN '  ' || {nth_task('conv_id')} || ' ' ELSE {nth_task('conv_id')} END AS task_type
  FROM turns),
texts AS (
  SELECT src_ordinal, line_key, '{{' || CASE WHEN task_type IS NULL THEN '' ELSE '"task_type":' || {quoted('task_type')} || ',' END
         || '"instruction":' || {quoted('instruction')} || ', "input" : ' || {quoted('input')}
         || ',"output":' || {quoted('output')} || '}}' AS value FROM lines
  UNION ALL SELECT 1, event_id, props FROM events
  UNION ALL SELECT 2, event_id, ' ' || chr(9) FROM events)"""

MERGED = f"""{LINES}, merged AS (
  SELECT src_ordinal, line_key, CAST(json(value) AS VARCHAR) AS record FROM texts WHERE {strip('value')} <> '')"""

TASK_COUNTS = f"""{LINES}, typed AS (
  SELECT CASE WHEN {strip('task_type')} <> '' THEN {strip('task_type')} END AS task_type, line_key AS first_at FROM lines
  UNION ALL SELECT NULL, 1000000000000 + event_id FROM events)"""

CALIBRATION = f"""{TURNS}, usable AS (
  SELECT conv_id * 100000 + turn AS line_key, {strip('instruction')} AS i, {strip('input')} AS u, {strip('output')} AS o
  FROM turns WHERE {strip('instruction')} <> '' AND {strip('output')} <> '')"""

# the model stub answers French plainly and English in a fence, cuts Spanish short, fails German
GENERATED = f"""{PROMPTS}, calls AS (
  SELECT d.doc_id AS paper_index, p.task_type, lang, {strip('text')} AS abstract, {strip('source')} AS title
  FROM documents d CROSS JOIN prompts p),
candidates AS (
  SELECT paper_index, task_type, 0 AS pos, abstract AS text FROM calls WHERE lang NOT IN ('de', 'es')
  UNION ALL SELECT paper_index, task_type, 1, title FROM calls WHERE lang NOT IN ('de', 'es')
  UNION ALL SELECT paper_index, task_type, 2, '' FROM calls WHERE lang NOT IN ('de', 'es')),
judged AS (
  SELECT *, text <> '' AND length(CAST(to_json({{'text': text}}) AS VARCHAR)) <= {MAX_SAMPLE_CHARS} AS good FROM candidates),
kept AS (SELECT paper_index, task_type, pos, text FROM judged WHERE good)"""

# the model stub leaves out a key for batches of one page (mended on correction) and of two (never), and
# gives no JSON for batches of three
EXTRACTED = f"""{PAGES}, outcomes AS (
  SELECT *, len(urls) IN (2, 3) AS failed FROM guarded),
results AS (
  SELECT p.doc_path,
         CASE WHEN b.doc_path IS NOT NULL THEN 'failed' WHEN coalesce(o.bad, 0) = 0 THEN 'success'
              WHEN o.good > 0 THEN 'partial' ELSE 'failed' END AS status,
         coalesce(o.good, 0) AS n_parts,
         coalesce(o.bad, 0) + CASE WHEN b.doc_path IS NOT NULL THEN 1 ELSE 0 END AS n_errors
  FROM papers p LEFT JOIN bad b USING (doc_path)
  LEFT JOIN (SELECT doc_path, count(*) FILTER (NOT failed) AS good, count(*) FILTER (failed) AS bad
             FROM outcomes GROUP BY doc_path) o USING (doc_path))"""

_others = "".join(f',"{k}":[]' for k in RECORD_KEYS[1:])


def _translated(member: str) -> str:
    return f"CASE WHEN {strip(member)} <> '' THEN 'T:' || {member} ELSE {member} END"


_told = (
    "'{\"instruction\":' || " + quoted(_translated("instruction")) + " || ',\"input\":' || "
    + quoted(_translated("input")) + " || ',\"output\":' || " + quoted(_translated("output")) + " || '}' AS record"
)

ORACLE: dict[str, str] = {
    "cpt_samples": f"WITH {CPT_KEPT} {first_of('text')}",
    "sft_samples": f"WITH {SFT_KEPT} {first_of('task_type, instruction, input, output')}",
    "dpo_samples": f"WITH {DPO_KEPT} {first_of('prompt, chosen, rejected')}",
    "sample_verdicts": f"""WITH {CPT}, judged AS (
        SELECT task_type, {strip('text')} <> '' AND length(CAST(to_json({{'text': {strip('text')}}}) AS VARCHAR)) <= {MAX_SAMPLE_CHARS} AS good FROM candidates)
        SELECT task_type, count(*) FILTER (good) AS kept, count(*) FILTER (NOT good) AS discarded FROM judged GROUP BY task_type""",
    "task_request_matrix": matrix(
        "'[{\"task_type\":\"' || task_type || '\",\"instruction\":\"...\",\"input\":\"...\",\"output\":\"...\"}]'"
    ),
    "task_request_matrix_cpt": matrix("'[{\"text\":\"...\"}]'"),
    "planned_calls": "SELECT count(*) AS papers, CAST(9 AS BIGINT) AS tasks, 9 * count(*) AS calls FROM documents",
    "prompt_completeness": f"""WITH {PROMPTS}, found AS (
        SELECT ({array(TASKS)})[doc_id % 5 + 1] AS prompt_name FROM documents)
        SELECT prompt_name FROM prompts WHERE prompt_name NOT IN (SELECT prompt_name FROM found)""",
    "page_batches": f"""WITH {PAGES} SELECT doc_path, batch_no, batch_count, start_page, end_page,
        array_to_string(urls, chr(10)) AS image_urls FROM batches""",
    "page_keys": f"WITH {PAGES} SELECT doc_path, page_no, object_key FROM pages",
    "oversized_guard": f"WITH {PAGES} SELECT doc_path, batch_no, start_page, end_page FROM guarded",
    "extraction_requests": f"""WITH {PAGES} SELECT doc_path, batch_no, corrected,
        sha256(CAST({EXTRACTION_INPUT} AS VARCHAR)) AS input_sha, 524288 AS max_output_tokens
        FROM guarded, (VALUES (false), (true)) c(corrected)""",
    "document_status": f"WITH {STATUS} SELECT doc_path, status, n_parts, n_errors FROM results",
    "document_errors": f"""WITH {STATUS}
        SELECT doc_path, batch_no, 'part ' || batch_no || '/' || batch_count || ' (page ' || start_page || '-' || end_page
               || '): no answer' AS error FROM outcomes WHERE failed
        UNION ALL
        SELECT doc_path, NULL, printf('image of page %d has %.2f MB, the limit is %.2f MB',
               first_bad, bad_bytes / 1048576.0, 10.0) FROM bad""",
    "extraction_report": f"""WITH {STATUS} SELECT count(*) AS papers, CAST(sum(n_parts) AS BIGINT) AS parts,
        count(*) FILTER (n_parts = 0) AS papers_without_parts, count(*) FILTER (status = 'success') AS successful,
        count(*) FILTER (status = 'partial') AS partial, count(*) FILTER (status = 'failed') AS failed FROM results""",
    "pending_documents": f"""WITH {STATUS} SELECT doc_path, page_count FROM results r
        WHERE NOT (status = 'success' AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1))""",
    "required_keys": f"""WITH {DAMAGED}, valid AS (
        SELECT doc_id, json_valid(answer) AS ok, CASE WHEN json_valid(answer) THEN json(answer) END AS j FROM answers),
        missing AS (
        SELECT *, CASE WHEN ok AND json_type(j) = 'OBJECT' THEN
            list_filter({array(RECORD_KEYS)}, lambda k: NOT list_contains(json_keys(j), k)) END AS lost FROM valid)
        SELECT doc_id, CASE WHEN NOT ok THEN 'no JSON value in the answer'
            WHEN json_type(j) <> 'OBJECT' THEN 'the answer is not an object'
            WHEN len(lost) > 0 THEN 'members are missing from the record: '
                 || array_to_string(lost, ', ') END AS schema_error FROM missing""",
    "record_items": f"""WITH {RECORDS} SELECT paper_index, 0 AS item_no, record AS record_json FROM records
        UNION ALL SELECT paper_index, 1, record FROM records WHERE paper_index % 2 <> 0""",
    "response_text": f"""WITH {ANSWERS} SELECT doc_id, doc_id % 10 IN (4, 5, 6) AS failed,
        CASE WHEN doc_id % 10 NOT IN (4, 5, 6) THEN content END AS text FROM told""",
    "salvage_fast_path": f"""WITH {ANSWERS} SELECT doc_id, CASE WHEN doc_id % 10 IN (8, 9) THEN 'object' ELSE 'array' END AS kind,
        CASE WHEN doc_id % 10 = 7 THEN two ELSE content END AS value FROM told WHERE doc_id % 10 NOT IN (4, 5, 6)""",
    "salvage_answers": f"""WITH {NOISY} SELECT doc_id,
        CASE doc_id % 5 WHEN 1 THEN 'array' WHEN 4 THEN NULL ELSE 'object' END AS kind,
        CASE doc_id % 5 WHEN 1 THEN '[1]' WHEN 4 THEN NULL ELSE one END AS value FROM parts""",
    "envelope_unwrap": f"""WITH {ANSWERS} SELECT doc_id, 0 AS pos, one AS item FROM told WHERE doc_id % 10 NOT IN (4, 5, 6)
        UNION ALL SELECT doc_id, 1, other FROM told WHERE doc_id % 10 NOT IN (4, 5, 6, 9)""",
    "token_usage": """WITH used AS (
        SELECT CASE WHEN doc_id % 23 = 0 OR doc_id % 29 = 0 THEN 0 ELSE n_chars END AS given,
               CASE WHEN doc_id % 23 = 0 THEN 0 ELSE doc_id * 3 END AS cached,
               CASE WHEN doc_id % 23 = 0 THEN 0 ELSE doc_id % 100 END AS output FROM documents)
        SELECT CAST(sum(given - least(cached, given)) AS BIGINT) AS regular_input_tokens,
               CAST(sum(least(cached, given)) AS BIGINT) AS cached_input_tokens,
               CAST(sum(output) AS BIGINT) AS output_tokens FROM used""",
    "retry_class": f"""WITH tried AS (
        SELECT doc_id, attempt, ({list(STATUS_CYCLE)})[doc_id % 10 + 1] AS status FROM documents, (VALUES (0), (1), (2)) a(attempt))
        SELECT doc_id, attempt, doc_id % 20 = 0 AS accepted,
               status IN (408, 409, 425, 429) OR status >= 500 OR doc_id % 10 = 2 AS named_retryable,
               doc_id % 20 <> 0 AND attempt < 2 AS retry,
               CASE WHEN doc_id % 20 <> 0 AND attempt < 2 THEN CAST(2 ** attempt AS DOUBLE) END AS backoff_s FROM tried""",
    "translate_payloads": f"WITH {TRANSLATION} SELECT id, payload, names, chars FROM sized",
    "translate_batches": f"WITH RECURSIVE {greedy(30000)} SELECT batch_no, n_records, first_id, sha256(source_json) AS source_sha FROM batches",
    "translate_batches_tight": f"WITH RECURSIVE {greedy(2000)} SELECT batch_no, n_records, first_id, sha256(source_json) AS source_sha FROM batches",
    "translate_requests": f"""WITH RECURSIVE {greedy(30000)} SELECT batch_no, sha256(CAST(to_json([{{'role': 'user', 'content':
        {text(_head + LANGUAGES['en'] + _tail)} || source_json}}]) AS VARCHAR)) AS input_sha FROM batches""",
    "translate_validate": f"""WITH RECURSIVE {greedy(2000)} SELECT batch_no, n_records,
        CASE batch_no % 5 WHEN 0 THEN 'records are missing from the translation'
             WHEN 1 THEN 'other members than were sent for id ' || first_id || '.' END AS fault FROM batches""",
    "translate_apply": f"""WITH RECURSIVE {greedy(2000)} SELECT id, {_told} FROM walk JOIN sized USING (id)
        WHERE batch_no % 5 NOT IN (0, 1)""",
    "translate_formulas": """SELECT doc_id AS id, '{"n":1.0E-7,"text":"new ' || lang || '","k":[null,true]}' AS record FROM documents""",
    "merge_files": f"""WITH {MERGED} SELECT row_number() OVER (ORDER BY src_ordinal, line_key) - 1 AS record_index, record FROM merged""",
    "merge_repeated_keys": """SELECT row_number() OVER (ORDER BY event_id) - 1 AS record_index,
        '{"a":' || user_id || ',"props":' || CAST(json(props) AS VARCHAR) || '}' AS record FROM events""",
    "count_files": f"""WITH {MERGED} SELECT CAST(s AS INTEGER) AS src_ordinal, count(record) AS samples
        FROM range(3) r(s) LEFT JOIN merged ON src_ordinal = s GROUP BY s""",
    "bad_line_files": f"""SELECT line, CASE WHEN doc_id % 3 = 1 THEN 'not a JSON object' ELSE 'broken JSON' END AS problem,
        sha256(CASE WHEN doc_id % 3 = 1 THEN {quoted('text')} ELSE '{{"n":' || {quoted('text')} END) AS value_sha
        FROM (SELECT *, row_number() OVER (ORDER BY doc_id) AS line FROM documents) WHERE doc_id % 3 <> 0""",
    "ledger_round": f"""WITH {EXTRACTED} SELECT doc_path, status <> 'success' AS pending,
        (SELECT count(*) FROM outcomes WHERE NOT failed) AS records_on_disk FROM results""",
    "intake_rounds": f"""WITH {EXTRACTED} SELECT r.doc_path, status <> 'success' AS pending,
        CASE WHEN status <> 'success' THEN p.page_count ELSE 0 END::BIGINT AS waiting_pages
        FROM results r JOIN papers p USING (doc_path)""",
    "record_patch": f"""WITH {MERGED} SELECT 1 AS src_ordinal, line_key, substr(record, 1, length(record) - 1)
        || CASE WHEN record = '{{}}' THEN '' ELSE ',' END || '"input":"new \\"input\\""}}' AS record FROM merged WHERE src_ordinal = 1
        UNION ALL SELECT 0, line_key, '{{' || CASE WHEN task_type IS NULL THEN '' ELSE '"task_type":' || {quoted('task_type')} || ',' END
        || '"instruction":' || {quoted('instruction')} || ',"input":"new \\"input\\"","output":' || {quoted('output')} || '}}' AS record FROM lines""",
    "merge_jsonl": f"WITH {MERGED} SELECT src_ordinal, line_key, record FROM merged",
    "count_records": f"WITH {MERGED} SELECT count(*) AS samples FROM merged",
    "count_array_items": """SELECT 2 * (doc_id % 4) AS n, count(*) AS files, CAST(sum(2 * (doc_id % 4)) AS BIGINT) AS samples
        FROM documents GROUP BY doc_id % 4""",
    "sample_lines": f"""WITH {DPO_KEPT} SELECT paper_index, pos,
        CAST(to_json({{'prompt': prompt, 'chosen': chosen, 'rejected': rejected}}) AS VARCHAR) AS line FROM kept""",
    "task_stats": f"""WITH {TASK_COUNTS} SELECT task_type, count(*) AS count,
        count(*) / CAST((SELECT count(*) FROM typed) AS DOUBLE) AS proportion,
        printf('%.2f%%', 100 * (count(*) / CAST((SELECT count(*) FROM typed) AS DOUBLE))) AS percent, min(first_at) AS first_at
        FROM typed WHERE task_type IS NOT NULL GROUP BY task_type""",
    "task_totals": f"WITH {TASK_COUNTS} SELECT count(*) AS total, count(*) FILTER (task_type IS NULL) AS missing FROM typed",
    "token_stats": f"""WITH {LINES}, counted AS (
        SELECT len(regexp_extract_all(value || chr(10), '[^\\t\\n\\x0B\\f\\r ]+')) AS n FROM texts)
        SELECT count(*) AS lines, CAST(sum(n) AS BIGINT) AS total_tokens, avg(n) AS mean_tokens,
               min(n) AS min_tokens, max(n) AS max_tokens FROM counted""",
    "record_index": "SELECT user_id, event_id, row_number() OVER (ORDER BY user_id, event_id) - 1 AS record_index FROM events",
    "calibration_pairs": f"""WITH {CALIBRATION} SELECT line_key, CASE WHEN u = '' THEN i ELSE i || chr(10) || chr(10) || u END AS asked,
        o AS answered FROM usable""",
    "calibration_draw": f"""WITH {CALIBRATION}, n AS (SELECT least(64, count(*)) AS k FROM usable)
        SELECT k AS drawn, k AS numbers, 0::BIGINT AS least, k - 1 AS most, k AS records, k AS usable FROM n""",
    "dataset_view_files": "SELECT sha256(text) AS prompt_sha FROM documents",
    "dataset_view_sft": f"""WITH {SFT_KEPT}, firsts AS ({first_of('task_type, instruction, input, output')})
        SELECT instruction AS prompt, input AS query, output AS response FROM firsts""",
    "dataset_view_cpt": f"WITH {CPT_KEPT}, firsts AS ({first_of('text')}) SELECT text AS prompt FROM firsts",
    "generated_samples": f"WITH {GENERATED} {first_of('text')}",
    "generated_calls": f"""WITH {GENERATED} SELECT c.paper_index, c.task_type, count(*) FILTER (j.good) AS n_samples,
        count(*) FILTER (NOT j.good) AS n_discarded, any_value(c.lang) IN ('de', 'es') AS failed
        FROM calls c LEFT JOIN judged j USING (paper_index, task_type) GROUP BY c.paper_index, c.task_type""",
    "generation_report": f"""WITH {GENERATED} SELECT (SELECT count(*) FROM calls) AS calls,
        (SELECT count(*) FROM calls WHERE lang IN ('de', 'es')) AS failed_calls,
        count(*) FILTER (good) AS kept, count(*) FILTER (NOT good) AS discarded FROM judged""",
    "extracted_status": f"WITH {EXTRACTED} SELECT doc_path, status, n_parts, n_errors FROM results",
    "extracted_parts": f"""WITH {EXTRACTED} SELECT doc_path, batch_no,
        '{{"{RECORD_KEYS[0]}":' || CAST(to_json({{'pages': urls}}) AS VARCHAR) || '{_others}}}' AS record_json
        FROM outcomes WHERE NOT failed""",
    "translated_records": f"""WITH RECURSIVE {greedy(2000)} SELECT id, {_told} FROM walk JOIN sized USING (id)
        JOIN batches USING (batch_no) WHERE first_id % 10 <> 3""",
    "translation_report": f"""WITH RECURSIVE {greedy(2000)} SELECT CAST(sum(n_records) AS BIGINT) AS records, count(*) AS batches,
        count(*) FILTER (first_id % 10 = 3) AS failed_batches,
        CAST(coalesce(sum(n_records) FILTER (first_id % 10 <> 3), 0) AS BIGINT) AS translated,
        CAST(coalesce(sum(n_records) FILTER (first_id % 10 = 3), 0) AS BIGINT) AS untranslated FROM batches""",
} | record_oracle.ORACLE
