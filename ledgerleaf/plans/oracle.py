"""The named queries as SQL for the check tool (DuckDB).

Written from the meaning of each query, not from its Spark form: windows where
Spark aggregates, list functions where Spark folds, a recursive query where
Spark replays in chunks.
"""

from __future__ import annotations

from ledgerleaf import constants as C
from ledgerleaf.plans.corpus import with_corpora

LF = "chr(10)"
SPACES = " || ".join(f"chr({ord(c)})" for c in C.WHITE_SPACE)


def _q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_q(v) for v in values) + "]"


def _strip(x: str) -> str:
    return f"trim({x}, ' ' || {LF})"


def _strip_all(x: str) -> str:
    return f"trim({x}, {SPACES})"


def _message(template: str, *args: str) -> str:
    """A message text with SQL expressions in its places."""
    parts = template.split("%s")
    out = _q(parts[0])
    for arg, tail in zip(args, parts[1:]):
        out += f" || {arg} || {_q(tail)}"
    return f"({out})"


def _clean(x: str) -> str:
    unix = f"replace(replace(coalesce({x}, ''), chr(13) || {LF}, {LF}), chr(13), {LF})"
    ascii_only = rf"regexp_replace({unix}, '[^\x20-\x7E\n\t]', ' ', 'g')"
    spaced = rf"regexp_replace({ascii_only}, '[ \t]+', ' ', 'g')"
    lines = rf"regexp_replace({spaced}, ' ?\n ?', {LF}, 'g')"
    return _strip(rf"regexp_replace({lines}, '\n{{3,}}', {LF} || {LF}, 'g')")


def _score(lowered: str, keywords) -> str:
    return " + ".join(f"CAST(contains({lowered}, {_q(k)}) AS INTEGER)" for k in keywords)


CLEAN = f"""docs AS MATERIALIZED (
  SELECT *, {_clean('text')} AS clean_text FROM docs_raw
)"""

LABEL = f"""scored AS (
  SELECT *, {_score('lower(clean_text)', C.INVOICE_KEYWORDS)} AS invoice_score,
         {_score('lower(clean_text)', C.RESUME_KEYWORDS)} AS resume_score
  FROM docs
), ruled AS (
  SELECT *, CASE WHEN invoice_score = 0 AND resume_score = 0 THEN 'Other'
                 WHEN invoice_score >= resume_score THEN 'Invoice' ELSE 'Resume' END AS rule_label
  FROM scored
)"""


def _capture(pattern: str, flags: str = "", group: int = 1, text: str = "clean_text") -> str:
    tail = f", '{flags}'" if flags else ""
    return f"nullif({_strip(f'regexp_extract({text}, {_q(pattern)}, {group}{tail})')}, '')"


def _first_line(condition: str) -> str:
    return f"list_extract(list_filter(string_split(clean_text, {LF}), lambda x: {condition}), 1)"


FIELD_SQL = {
    "invoice_number": f"coalesce({_capture(C.INVOICE_NUMBER_PATTERN, 'i')}, {_capture(C.BARE_NUMBER_PATTERN)})",
    "date": _capture(C.DATE_PATTERN),
    "company": f"coalesce(substr({_capture(C.COMPANY_PATTERN, 'i')}, 1, 80), "
    + _first_line("length(x) BETWEEN 1 AND 59 AND NOT contains(lower(x), 'invoice')")
    + ")",
    "total": _capture(C.TOTAL_PATTERN, "i"),
    "name": f"substr(coalesce({_capture(C.NAME_PATTERN, 'i')}, "
    + _first_line("x <> '' AND lower(x) NOT IN ('resume', 'curriculum vitae', 'cv')")
    + "), 1, 60)",
    "email": _capture(C.EMAIL_PATTERN, group=0),
    "phone": _capture(C.PHONE_PATTERN),
    "skills": f"nullif(substr(replace({_capture(C.SKILLS_PATTERN, 'is')}, {LF}, ' '), 1, 200), '')",
}
KIND_OF = {c: ("Invoice" if c in ("invoice_number", "date", "company", "total") else "Resume") for c in FIELD_SQL}
NOTES = f"""CASE WHEN filename LIKE '%.png' THEN [{_q(C.NOTE_NO_OCR)}]
         WHEN filename LIKE '%.PNG' THEN [{_q(C.NOTE_NO_OCR)}, {_q(C.NOTE_OCR_FAILED)}]
         ELSE [] END"""
FAILED_REASON = f"""CASE WHEN len(notes) > 0 THEN {_q(C.MSG_NO_TEXT)} || ' ' || array_to_string(notes, ' ')
         ELSE {_q(C.MSG_NO_TEXT + ' ' + C.MSG_NO_TEXT_HINT)} END"""
CONFIDENCE = "CASE WHEN doc_id % 5 <> 0 THEN CAST(doc_id * 37 % 101 AS DOUBLE) / 100 END"


def _extracted(source: str, failed: str = "length(clean_text) < 15", label: str = "rule_label") -> str:
    """Flat fields, missing list and status over ``source`` (ruled documents
    with columns notes, read_error and confidence)."""
    flat = ",\n         ".join(
        f"CASE WHEN document_type = '{KIND_OF[c]}' THEN {sql} END AS {c}" for c, sql in FIELD_SQL.items()
    )
    important = {
        "Invoice": (("Invoice Number", "invoice_number"), ("Company Name", "company"), ("Total Amount", "total")),
        "Resume": (("Name", "name"), ("Email", "email")),
    }
    missing = "CASE document_type " + " ".join(
        f"WHEN '{kind}' THEN concat_ws(', ', "
        + ", ".join(f"CASE WHEN {c} IS NULL THEN '{n}' END" for n, c in names)
        + ")"
        for kind, names in important.items()
    ) + " ELSE '' END"
    percent = "round(confidence * 100, 1)"
    return f"""typed AS (
  SELECT *, {failed} AS is_failed,
         CASE WHEN {failed} THEN 'Other' ELSE {label} END AS document_type
  FROM {source}
), flat AS (
  SELECT *, {flat}
  FROM typed
), judged AS (
  SELECT *, {missing} AS missing
  FROM flat
), done AS (
  SELECT *,
    CASE WHEN is_failed THEN 'Failed' WHEN missing <> '' OR {percent} < 60 THEN 'Needs Review'
         ELSE 'Processed' END AS status,
    CASE WHEN read_error IS NOT NULL THEN read_error
         WHEN is_failed THEN {FAILED_REASON}
         WHEN missing <> '' THEN 'Missing: ' || missing || '.'
         WHEN {percent} < 60 THEN 'The classifier is only ' || CAST(CAST(round_even({percent}, 0) AS INTEGER) AS VARCHAR)
              || '% sure about the document type.'
         ELSE {_q(C.MSG_ALL_FOUND)} END AS status_reason
  FROM judged
)"""


PLAIN = """plain AS (
  SELECT *, CAST([] AS VARCHAR[]) AS notes, CAST(NULL AS VARCHAR) AS read_error,
         CAST(NULL AS DOUBLE) AS confidence
  FROM ruled
)"""

RAW = with_corpora("docs_raw")
DOCS = f"{RAW},\n{CLEAN}"
RULED = f"{DOCS},\n{LABEL}"
DONE = f"{RULED},\n{PLAIN},\n{_extracted('plain')}"
STORED = with_corpora("stored_docs")
FLAT_NAMES = ", ".join(FIELD_SQL)


# --- landed files ---------------------------------------------------------------
EXT = r"lower(regexp_extract(filename, '[^/]\.([^./]+)$', 1))"
STEM = (
    r"coalesce(nullif(substr(trim(regexp_replace(regexp_replace(regexp_extract(filename, '([^/]*)$', 1), "
    r"'(.)\.[^.]+$', '\1'), '[^A-Za-z0-9]+', '_', 'g'), '_'), 1, 40), ''), 'document')"
)


def _stored_name(ext: str, ts: str, file_hash: str) -> str:
    return f"strftime({ts}, '%Y%m%d_%H%M%S') || '_' || left({file_hash}, 8) || '_' || {STEM} || '.' || {ext}"


def _folder(kind: str) -> str:
    return f"CASE {kind} WHEN 'Invoice' THEN 'invoices' WHEN 'Resume' THEN 'resumes' ELSE 'other' END"


CHECKED = f"""named AS (
  SELECT *, {EXT} AS ext, upper(left(hex(content), 16)) AS head FROM landed
), checked AS (
  SELECT *, CASE
      WHEN ext NOT IN ('pdf', 'jpg', 'jpeg', 'png') THEN {_message(C.MSG_UNSUPPORTED, 'filename')}
      WHEN coalesce(size, 0) = 0 THEN {_message(C.MSG_EMPTY, 'filename')}
      WHEN size > 10 * 1024 * 1024 THEN {_message(C.MSG_TOO_LARGE, 'filename', "printf('%.1f', size / (1024 * 1024))")}
      WHEN NOT coalesce(starts_with(head, CASE ext WHEN 'pdf' THEN '25504446' WHEN 'png' THEN '89504E470D0A1A0A'
           ELSE 'FFD8FF' END), FALSE) THEN {_message(C.MSG_BAD_MAGIC, 'filename', 'upper(ext)')}
    END AS upload_error
  FROM named
), hashed AS (
  SELECT *, CASE WHEN upload_error IS NULL THEN sha256(content) END AS file_hash FROM checked
)"""
LANDED = f"{with_corpora('landed')},\n{CHECKED}"
LIBRARY = f"""{LANDED},
library AS (
  SELECT doc_id, file_hash, filename AS original_filename FROM hashed
  WHERE upload_error IS NULL AND upload_ts < TIMESTAMP '2000-01-01 00:00:00'
  QUALIFY row_number() OVER (PARTITION BY file_hash ORDER BY upload_ts, doc_id) = 1
), batch AS (
  SELECT *, file_hash IS NOT NULL AND row_number() OVER (PARTITION BY file_hash ORDER BY upload_ts, doc_id) > 1 AS repeated,
    first_value(filename) OVER (PARTITION BY file_hash ORDER BY upload_ts, doc_id) AS first_name
  FROM hashed WHERE upload_ts >= TIMESTAMP '2000-01-01 00:00:00'
), matched AS (
  SELECT b.*, l.doc_id AS existing_id, l.original_filename AS existing_filename
  FROM batch b LEFT JOIN library l ON b.file_hash = l.file_hash
)"""
OUTCOME = f"""{LIBRARY},
kinds AS (
  SELECT * EXCLUDE (kind), CASE WHEN upload_error IS NOT NULL THEN 'rejected'
      WHEN existing_id IS NOT NULL OR repeated THEN 'duplicate' ELSE 'new' END AS kind
  FROM matched
), docs AS (
  SELECT *, {_clean("CASE WHEN kind = 'new' THEN text END")} AS clean_text FROM kinds
),
{LABEL},
{PLAIN},
{_extracted('plain')},
outcomes AS (
  SELECT doc_id, kind, clean_text,
    CASE WHEN upload_error IS NOT NULL THEN upload_error
         WHEN existing_id IS NOT NULL THEN {_message(C.MSG_DUPLICATE, 'existing_filename')}
         WHEN repeated THEN {_message(C.MSG_DUPLICATE, 'first_name')}
         WHEN status = 'Processed' THEN {_q(C.MSG_SAVED['Processed'])}
         WHEN status = 'Needs Review' THEN {_q(C.MSG_SAVED['Needs Review'])}
         ELSE {_q(C.MSG_SAVED['Failed'])} END AS message
  FROM done
)"""
APPEND = f"""{LANDED},
docs AS (
  SELECT *, {_clean('text')} AS clean_text FROM hashed WHERE upload_error IS NULL
  QUALIFY row_number() OVER (PARTITION BY file_hash ORDER BY upload_ts, doc_id) = 1
),
{LABEL},
{PLAIN},
{_extracted('plain')}"""


def _shown(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


# --- stored fields --------------------------------------------------------------------
def _alias(k: str) -> str:
    return f"CASE {k} " + " ".join(f"WHEN {_q(a)} THEN {_q(b)}" for a, b in C.FIELD_ALIASES.items()) + " END"


def _canonical(key: str) -> str:
    spaced = f"replace(lower({_strip_all(key)}), '_', ' ')"
    joined = f"replace({spaced}, ' ', '_')"
    return f"coalesce({_alias(spaced)}, {_alias(joined)}, {joined})"


LOADED = """loaded AS (
  SELECT *, CASE WHEN json_valid(fields_json) AND json_type(fields_json) = 'OBJECT'
      THEN map_entries(TRY_CAST(TRY_CAST(fields_json AS JSON) AS MAP(VARCHAR, VARCHAR)))
      ELSE [] END AS raw_entries
  FROM stored_docs
)"""


def _value(name: str) -> str:
    return f"list_extract(list_filter(entries, lambda e: e.k = '{name}'), 1).v"


def _present(name: str) -> str:
    return f"len(list_filter(entries, lambda e: e.k = '{name}')) > 0"


def _blank(v: str) -> str:
    return (
        f"({v} IS NULL OR {_strip_all(v)} = '' OR (starts_with({v}, '[') AND json_valid({v}) AND "
        f"len(list_filter(TRY_CAST(TRY_CAST({v} AS JSON) AS VARCHAR[]), lambda z: {_strip_all('z')} <> '')) = 0))"
    )


DATE_FORMATS = (
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "%Y-%m-%d"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "%d-%m-%Y"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "%d/%m/%Y"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "%m/%d/%Y"),
    (r"^\d{1,2}\s+[A-Za-z]+\s+\d{4}$", "%d %b %Y"),
    (r"^\d{1,2}\s+[A-Za-z]+\s+\d{4}$", "%d %B %Y"),
    (r"^[A-Za-z]+\s+\d{1,2},\s+\d{4}$", "%b %d, %Y"),
    (r"^[A-Za-z]+\s+\d{1,2},\s+\d{4}$", "%B %d, %Y"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "%Y/%m/%d"),
)


def _valid_email(v: str) -> str:
    return f"regexp_matches({_strip_all(v)}, {_q(C.VALID_EMAIL_PATTERN)})"


def _valid_phone(v: str) -> str:
    digits = rf"length(regexp_replace({_strip_all(v)}, '\D', '', 'g'))"
    return f"(regexp_matches({_strip_all(v)}, {_q(C.VALID_PHONE_PATTERN)}) AND {digits} BETWEEN 7 AND 15)"


def _valid_date(v: str) -> str:
    tests = (
        f"(regexp_matches({_strip_all(v)}, {_q(shape)}) AND try_strptime({_strip_all(v)}, '{fmt}') IS NOT NULL)"
        for shape, fmt in DATE_FORMATS
    )
    return "(" + " OR ".join(tests) + f") AND NOT regexp_matches({_strip_all(v)}, {_q(C.YEAR_ZERO)})"


def _amount(v: str) -> str:
    return rf"TRY_CAST(nullif(replace(regexp_replace({v}, '[^\d.,-]', '', 'g'), ',', ''), '') AS DOUBLE)"


def _valid_amount(v: str) -> str:
    return f"coalesce({_amount(v)} > 0, FALSE)"


CHECK_SQL = {
    "email": _valid_email,
    "phone": _valid_phone,
    "date": _valid_date,
    "total_amount": _valid_amount,
}
REQUIRED = "CASE lower(document_type) " + " ".join(
    f"WHEN '{kind}' THEN {_list(names)}" for kind, names in C.REQUIRED_FIELDS.items()
) + " ELSE CAST([] AS VARCHAR[]) END"

CANONICAL = f"""renamed AS (
  SELECT *, list_transform(raw_entries, lambda e: struct_pack(k := {_canonical('e.key')},
      v := nullif(e.value, 'Not Found'))) AS pairs
  FROM loaded
), canon AS (
  SELECT *, list_filter(pairs, lambda p, i: len(list_filter(pairs[i + 1:], lambda z: z.k = p.k)) = 0) AS entries
  FROM renamed
), parts AS (
  SELECT *, {REQUIRED} AS required, {', '.join(f'{_value(n)} AS v_{n}' for n in ('invoice_number', 'date', 'company_name', 'total_amount', 'name', 'email', 'skills', 'phone'))}
  FROM canon
), found AS (
  SELECT *, list_filter(required, lambda r: CASE r {' '.join(f"WHEN '{n}' THEN {_blank('v_' + n)}" for n in ('invoice_number', 'date', 'company_name', 'total_amount', 'name', 'email', 'skills'))} END) AS missing,
    list_filter([{', '.join(f"CASE WHEN NOT {_blank('v_' + n)} AND NOT coalesce({fn('v_' + n)}, FALSE) THEN '{n}' END" for n, fn in CHECK_SQL.items())}], lambda z: z IS NOT NULL) AS invalid,
    list_filter([{', '.join(f"CASE WHEN {_present(n)} THEN '{n}' END" for n in CHECK_SQL)}], lambda z: z IS NOT NULL) AS present
  FROM parts
)"""
FIELDS = f"{STORED},\n{LOADED},\n{CANONICAL}"
REASON_OF = "CASE z " + " ".join(f"WHEN '{k}' THEN {_q(v)}" for k, v in C.INVALID_REASONS.items()) + " END"

RULE_SQL = {
    "rule_unreadable": f"CASE WHEN len(list_filter(raw_entries, lambda e: coalesce({_strip_all('e.value')} NOT IN ('', 'Not Found'), FALSE))) = 0 THEN {_q(C.MSG_NO_FIELDS)} END",
    "rule_unsupported": "CASE WHEN coalesce(lower(document_type), '') NOT IN ('invoice', 'resume') THEN "
    + _message(C.MSG_UNKNOWN_TYPE, "coalesce(nullif(lower(document_type), ''), 'none')")
    + " END",
    "rule_low_confidence": "CASE WHEN confidence < 0.6 THEN "
    + _message(C.MSG_LOW_CONFIDENCE, "printf('%.2f', confidence)")
    + " END",
    "rule_validation": "CASE WHEN len(missing) > 0 THEN "
    + _message(C.MSG_MISSING, "array_to_string(missing, ', ')")
    + " WHEN len(invalid) > 0 THEN "
    + _message(
        C.MSG_INVALID,
        f"array_to_string(list_transform(invalid, lambda z: z || ' (' || {REASON_OF} || ')'), ', ')",
    )
    + " END",
}
ANY_RULE = "coalesce(" + ", ".join(RULE_SQL.values()) + ")"
REPEATED = "row_number() OVER (PARTITION BY file_hash ORDER BY upload_ts, doc_id) > 1"


# --- workflow --------------------------------------------------------------------------------
def _allowed(current: str, new: str) -> str:
    edges = ", ".join(f"({_q(a)}, {_q(b)})" for a, to in C.TRANSITIONS.items() for b in to)
    return f"(({current}, {new}) IN ({edges}))"


def _replay(requests: str, initial: str) -> str:
    """Recursive fold of ``requests`` (document_id, seq, requested_state) from
    the states in ``initial`` (document_id, state)."""
    return f"""numbered AS (
  SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY seq) AS rn FROM {requests}
), fold AS (
  SELECT n.document_id, n.rn, n.seq, n.requested_state, coalesce(i.state, 'New') AS before,
         CASE WHEN {_allowed("coalesce(i.state, 'New')", 'n.requested_state')} THEN n.requested_state
              ELSE coalesce(i.state, 'New') END AS after
  FROM numbered n LEFT JOIN {initial} i ON n.document_id = i.document_id WHERE n.rn = 1
  UNION ALL
  SELECT n.document_id, n.rn, n.seq, n.requested_state, f.after,
         CASE WHEN {_allowed('f.after', 'n.requested_state')} THEN n.requested_state ELSE f.after END
  FROM fold f JOIN numbered n ON n.document_id = f.document_id AND n.rn = f.rn + 1
)"""


STATE = "coalesce(nullif(workflow_status, ''), 'New')"
EMPTY_STATES = "start AS (SELECT CAST(NULL AS BIGINT) AS document_id, CAST(NULL AS VARCHAR) AS state WHERE FALSE)"
STORED_STATES = f"start AS (SELECT doc_id AS document_id, {STATE} AS state FROM stored_docs)"
REPLAY = f"{with_corpora('wf_events')},\n{EMPTY_STATES},\n{_replay('wf_events', 'start')}"
KNOWN = "known AS (SELECT * FROM wf_events WHERE document_id IN (SELECT doc_id FROM stored_docs))"
CHANGE = f"{with_corpora('stored_docs', 'wf_events')},\n{STORED_STATES},\n{KNOWN},\n{_replay('known', 'start')}"
DECIDED_REVIEW = f"""acts AS (
  SELECT *, coalesce(decision = 'reject' AND trim(coalesce(note, '')) = '', FALSE) AS unreasoned,
    coalesce(decision NOT IN ('approve', 'reject', 'complete', 'resubmit'), TRUE) AS unknown,
    CASE decision WHEN 'approve' THEN 'reviewer_approved' WHEN 'reject' THEN 'reviewer_rejected'
         WHEN 'complete' THEN 'workflow_completed' ELSE 'resubmitted' END AS action,
    CASE decision WHEN 'approve' THEN 'Approved' WHEN 'reject' THEN 'Rejected'
         WHEN 'complete' THEN 'Completed' ELSE 'New' END AS requested_state,
    CASE decision WHEN 'approve' THEN coalesce(nullif(note, ''), 'Approved by reviewer')
         WHEN 'reject' THEN trim(coalesce(note, '')) WHEN 'complete' THEN 'Approved document completed'
         ELSE 'Rejected document resubmitted' END AS reason
  FROM decisions
), known AS (
  SELECT * FROM acts WHERE NOT unreasoned AND NOT unknown AND document_id IN (SELECT doc_id FROM stored_docs)
)"""
REVIEW = f"{with_corpora('stored_docs', 'decisions')},\n{STORED_STATES},\n{DECIDED_REVIEW},\n{_replay('known', 'start')}"

BATCH = f"""{with_corpora('stored_docs', 'batch_ids')},
asked AS (
  SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY pos) AS turn FROM batch_ids
), firsts AS (
  SELECT * FROM asked WHERE turn = 1
), withconf AS (
  SELECT s.* REPLACE (coalesce(f.given_confidence, s.confidence) AS confidence), f.pos AS first_pos
  FROM (SELECT *, {REPEATED} AS is_copy FROM stored_docs) s JOIN firsts f ON f.document_id = s.doc_id
), loaded AS (
  SELECT *, CASE WHEN json_valid(fields_json) AND json_type(fields_json) = 'OBJECT'
      THEN map_entries(TRY_CAST(TRY_CAST(fields_json AS JSON) AS MAP(VARCHAR, VARCHAR)))
      ELSE [] END AS raw_entries
  FROM withconf
),
{CANONICAL},
ruled AS (
  SELECT doc_id, first_pos, confidence, document_type, {STATE} AS before, {STATE} = 'New' AS startable, len(missing) + len(invalid) = 0 AS is_valid,
    coalesce({ANY_RULE}, CASE WHEN is_copy THEN {_q(C.MSG_POSSIBLE_DUPLICATE)} END) AS hit
  FROM found
), outcome AS (
  SELECT *, CASE WHEN NOT startable THEN before WHEN hit IS NULL THEN 'Completed' ELSE 'Needs Review' END AS after,
    coalesce(hit, {_q(C.NOTE_PASSED)}) AS reason,
    CASE WHEN hit IS NULL THEN 'auto_completed' ELSE 'sent_to_review' END AS action
  FROM ruled
), results AS (
  SELECT a.pos, a.document_id, o.doc_id IS NOT NULL AS found, coalesce(o.startable AND a.turn = 1, FALSE) AS ok,
    o.before, o.after, o.action,
    CASE WHEN o.doc_id IS NULL THEN 'Document ' || CAST(a.document_id AS VARCHAR) || ' not found'
         WHEN o.startable AND a.turn = 1 THEN o.reason
         ELSE 'Invalid transition: ' || o.after || ' -> Processing' END AS reason
  FROM asked a LEFT JOIN outcome o ON o.doc_id = a.document_id
)"""


# --- models ------------------------------------------------------------------------------------
PREDICTIONS = """WITH preds AS (
  SELECT l.doc_id, CASE WHEN l.toxic = 1 THEN 'toxic' WHEN l.quality = 1 THEN 'good' ELSE 'bad' END AS label,
         m.model, CASE m.model
           WHEN 'LogisticRegression' THEN CASE WHEN d.n_chars > 900 THEN 'good' ELSE 'bad' END
           WHEN 'LinearSVM' THEN CASE WHEN d.n_chars > 400 THEN 'good' WHEN d.n_chars > 200 THEN 'toxic' ELSE 'bad' END
           ELSE 'good' END AS predicted
  FROM labels l JOIN documents d ON d.doc_id = l.doc_id
  CROSS JOIN (VALUES ('LogisticRegression'), ('LinearSVM'), ('NaiveBayes')) m(model)
), classes AS (
  SELECT DISTINCT model, label AS cls FROM preds UNION SELECT DISTINCT model, predicted FROM preds
), per_class AS (
  SELECT c.model, c.cls,
    count(*) FILTER (WHERE p.label = c.cls AND p.predicted = c.cls) AS tp,
    count(*) FILTER (WHERE p.label = c.cls) AS support,
    count(*) FILTER (WHERE p.predicted = c.cls) AS claimed
  FROM classes c JOIN preds p ON p.model = c.model GROUP BY c.model, c.cls
), evaluated AS (
  SELECT model, round(sum(tp) / sum(support), 3) AS accuracy,
    round(avg(CASE WHEN claimed = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / claimed END), 3) AS precision,
    round(avg(CASE WHEN support = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / support END), 3) AS recall,
    round(avg(CASE WHEN claimed + support = 0 THEN 0.0 ELSE 2.0 * CAST(tp AS DOUBLE) / (claimed + support) END), 3) AS f1
  FROM per_class GROUP BY model
)"""
# The labels as they are, and with gaps and an extra one.
LOOSE_LABEL = "CASE WHEN doc_id % 17 = 5 THEN NULL WHEN doc_id % 19 = 3 THEN 'Contract' ELSE kind END"


def _split(label: str) -> str:
    return f"""{DOCS},
labelled AS (SELECT doc_id, {label} AS label, clean_text FROM docs),
ranked AS (
  SELECT doc_id, label, clean_text,
    row_number() OVER (PARTITION BY label ORDER BY sha256(CAST(doc_id AS VARCHAR)), doc_id) AS rn,
    count(*) OVER (PARTITION BY label) AS n
  FROM labelled
), parted AS (
  SELECT doc_id, label, clean_text, rn <= (n * 300 + 999) // 1000 AS is_test FROM ranked
)"""


SPLIT = _split(LOOSE_LABEL)


def _terms(name: str, source: str) -> str:
    return rf"""{name}_words AS (
  SELECT doc_id, label, regexp_extract_all(lower(clean_text), '\w\w+') AS w FROM {source}
), {name}_terms AS MATERIALIZED (
  SELECT doc_id, label, term, count(*) AS tf FROM (
    SELECT doc_id, label, unnest(w) AS term FROM {name}_words
    UNION ALL
    SELECT doc_id, label, unnest(list_transform(w[:-2], lambda a, i: a || ' ' || w[i + 1])) FROM {name}_words
    WHERE len(w) > 1
  ) GROUP BY doc_id, label, term
)"""


def _weights(fit: str, fit_docs: str) -> str:
    return f"""freq AS MATERIALIZED (
  SELECT term, count(*) AS df,
    ln((1 + (SELECT count(*) FROM {fit_docs})) / CAST(1 + count(*) AS DOUBLE)) + 1 AS idf
  FROM {fit}_terms GROUP BY term
)"""


def _normed(name: str) -> str:
    return f"""{name}_raw AS (
  SELECT t.doc_id, t.label, t.term, t.tf * f.idf AS raw FROM {name}_terms t JOIN freq f ON f.term = t.term
), {name}_weights AS (
  SELECT doc_id, label, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight FROM {name}_raw
)"""


ALL_DOCS = f"""{DOCS},
labelled AS (SELECT doc_id, kind AS label, clean_text FROM docs),
{_terms('fit', 'labelled')},
{_weights('fit', 'labelled')}"""
BAYES = f"""{SPLIT},
train AS (SELECT * FROM parted WHERE NOT is_test AND label IS NOT NULL),
test AS (SELECT * FROM parted WHERE is_test),
{_terms('fit', 'train')},
{_weights('fit', 'train')},
{_normed('fit')},
{_terms('new', 'test')},
{_normed('new')},
cls AS (SELECT label, ln(count(*) / CAST((SELECT count(*) FROM train) AS DOUBLE)) AS prior FROM train GROUP BY label),
fc AS (SELECT label, term, sum(weight) AS s FROM fit_weights GROUP BY label, term),
tot AS (SELECT label, ln(sum(s) + (SELECT count(*) FROM freq)) AS lt FROM fc GROUP BY label),
pairs AS (
  SELECT w.doc_id, c.label, sum(w.weight * (ln(coalesce(fc.s, 0) + 1) - tot.lt)) AS part
  FROM new_weights w CROSS JOIN cls c JOIN tot ON tot.label = c.label
  LEFT JOIN fc ON fc.label = c.label AND fc.term = w.term
  GROUP BY w.doc_id, c.label
), totals AS (
  SELECT t.doc_id, c.label, c.prior + coalesce(p.part, 0) AS score
  FROM test t CROSS JOIN cls c LEFT JOIN pairs p ON p.doc_id = t.doc_id AND p.label = c.label
)"""


SCORED = f"""{BAYES}, best AS (
  SELECT doc_id, label AS predicted, score FROM totals QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) = 1
), sure AS (
  SELECT t.doc_id, round(1.0 / sum(exp(t.score - b.score)), 3) AS confidence
  FROM totals t JOIN best b ON b.doc_id = t.doc_id GROUP BY t.doc_id
)"""


# --- search ----------------------------------------------------------------------------------------
def _fold(x: str) -> str:
    return f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _has_words(words) -> str:
    return " AND ".join(
        "(" + " OR ".join(f"coalesce(contains({_fold(c)}, {_q(w)}), FALSE)" for c in C.SEARCH_COLUMNS) + ")"
        for w in words
    )


LATEST = """latest AS (
  SELECT document_id, action AS latest_action, ts AS latest_ts FROM audit_rows
  QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY id DESC) = 1
)"""
SEARCH = f"{with_corpora('stored_docs', 'audit_rows')},\n{LATEST}"


def _check_query(name: str, sql: str, column: str) -> str:
    return f"{FIELDS} SELECT doc_id, v_{name} AS value, {sql} AS {column} FROM found WHERE v_{name} IS NOT NULL"


def _entries(entries: str, k: str, v: str) -> str:
    return (
        f"array_to_string(list_sort(list_transform({entries}, lambda e: e.{k} || '=' || coalesce(e.{v}, '<null>'))), '; ')"
    )


ORACLE = {
    "scan_labelled": f"{DOCS} SELECT kind AS label, clean_text FROM docs",
    "scan_landed": f"SELECT 'page ' || CAST(page_id AS VARCHAR) || '.pdf' AS filename, CAST(octet_length(encode(html)) + 1 AS BIGINT) AS size, sha256(encode(html || {LF})) AS file_hash FROM pages",
    "scan_manifest": """WITH named AS (
  SELECT page_id, octet_length(encode(html)) AS size, 'f' || CAST(page_id AS VARCHAR) || '/p' || CAST(page_id % 50 AS VARCHAR) || '.pdf' AS name FROM pages
), placed AS (SELECT *, 's3://in/' || repeat('d/', CAST(page_id % 80 AS BIGINT)) || name AS path FROM named),
listed AS (
  SELECT page_id, size, CASE page_id % 3 WHEN 0 THEN name WHEN 1 THEN path ELSE split_part(name, '/', 2) END AS asked FROM placed
), hits AS (
  SELECT l.page_id, min(f.path) AS path, count(*) > 1 AS several
  FROM listed l JOIN placed f ON f.page_id % 11 <> 0 AND (f.path = l.asked OR ends_with(f.path, '/' || l.asked)) GROUP BY l.page_id
) SELECT coalesce(h.path, asked) AS path, regexp_extract(coalesce(h.path, asked), '([^/]+)$', 1) AS filename,
  CASE WHEN h.path IS NOT NULL THEN f.size WHEN l.size = 0 THEN 0 END AS size,
  h.path IS NULL AND l.size <> 0 AS lost, coalesce(several, FALSE) AS ambiguous
  FROM listed l LEFT JOIN hits h ON h.page_id = l.page_id LEFT JOIN placed f ON f.path = h.path""",
    "scan_documents": f"{STORED}, {LOADED} SELECT doc_id, {_entries('raw_entries', 'key', 'value')} AS fields FROM loaded",
    "route_folder": f"{STORED} SELECT doc_id, document_type, {_folder('document_type')} AS folder FROM stored_docs",
    "safe_filename": f"{RAW} SELECT doc_id, {_stored_name(EXT, 'upload_ts', 'sha256(text)')} AS stored_filename FROM docs_raw",
    "append_documents": f"""{APPEND}, named2 AS (
  SELECT *, {_folder('document_type')} AS folder, {_stored_name('ext', 'upload_ts', 'file_hash')} AS stored_filename FROM done
) SELECT doc_id, filename AS original_filename, stored_filename, folder, 'storage/' || folder || '/' || stored_filename AS file_path,
  document_type, {_shown('upload_ts')} AS upload_ts, company, invoice_number, total AS total_amount,
  substr(clean_text, 1, 1500) AS text_preview, file_hash, size AS file_size, FALSE AS used_ocr, status, status_reason,
  CASE document_type
    WHEN 'Invoice' THEN CAST(json_object('Invoice Number', coalesce(invoice_number, 'Not Found'), 'Date', coalesce(date, 'Not Found'),
         'Company Name', coalesce(company, 'Not Found'), 'Total Amount', coalesce(total, 'Not Found')) AS VARCHAR)
    WHEN 'Resume' THEN CAST(json_object('Name', coalesce(name, 'Not Found'), 'Email', coalesce(email, 'Not Found'),
         'Phone', coalesce(phone, 'Not Found'), 'Skills', coalesce(skills, 'Not Found')) AS VARCHAR)
    ELSE '{{}}' END AS fields_json, confidence FROM named2""",
    "audit_append": f"{with_corpora('audit_rows')} SELECT id, document_id, action, previous_status, new_status, {_shown('ts')} AS ts, coalesce(reason, '') AS reason FROM audit_rows",
    "migrate_documents": f"""{STORED} SELECT doc_id, original_filename, confidence, coalesce(workflow_status, 'New') AS workflow_status,
  CAST(NULL AS VARCHAR) AS review_reason, CAST(NULL AS VARCHAR) AS validation_json, CAST(NULL AS VARCHAR) AS predicted_type,
  FALSE AS failed, CAST(NULL AS VARCHAR) AS last_error, CAST(NULL AS DOUBLE) AS processing_ms FROM stored_docs""",
    "file_extension": f"{RAW} SELECT doc_id, filename, {EXT} AS ext FROM docs_raw",
    "validate_upload": f"{LANDED} SELECT doc_id, ext, upload_error FROM hashed",
    "content_hash": f"{with_corpora('landed')} SELECT doc_id, sha256(content) AS file_hash FROM landed",
    "quarantine": f"{LANDED} SELECT doc_id, filename, upload_error AS reason, 'Validate=fail' AS trace FROM hashed WHERE upload_error IS NOT NULL",
    "dup_vs_library": f"{LIBRARY} SELECT doc_id, existing_id, CASE WHEN existing_id IS NOT NULL THEN {_message(C.MSG_DUPLICATE, 'existing_filename')} END AS message FROM matched WHERE upload_error IS NULL",
    "dedup_keep_first": f"{RAW} SELECT doc_id, sha256(text) AS file_hash FROM docs_raw QUALIFY row_number() OVER (PARTITION BY sha256(text) ORDER BY upload_ts, doc_id) = 1",
    "stream_dedup": f"{RAW} SELECT doc_id, sha256(text) AS file_hash FROM docs_raw QUALIFY row_number() OVER (PARTITION BY sha256(text) ORDER BY upload_ts, doc_id) = 1",
    "ingest_outcome": f"{OUTCOME} SELECT doc_id, kind, message FROM outcomes",
    "stream_ingest": f"{OUTCOME} SELECT doc_id, kind, message FROM outcomes",
    "ingest_trace": f"""{OUTCOME} SELECT doc_id, CASE kind WHEN 'rejected' THEN 'Validate=fail'
  WHEN 'duplicate' THEN 'Validate=ok > Hash=ok > Duplicate check=stop'
  ELSE 'Validate=ok > Hash=ok > Duplicate check=ok > Read / OCR=ok > ' || CASE WHEN length(clean_text) < 15
    THEN 'Clean=fail > Classify=skip > Extract=skip' ELSE 'Clean=ok > Classify=ok > Extract=ok' END
    || ' > Store file=ok > Store metadata=ok' END AS trace FROM outcomes""",
    "missing_ids": f"{with_corpora('stored_docs', 'batch_ids')} SELECT DISTINCT document_id AS doc_id FROM batch_ids WHERE document_id NOT IN (SELECT doc_id FROM stored_docs)",
    "clean_text": f"{DOCS} SELECT doc_id, clean_text FROM docs",
    "too_short": f"{DOCS} SELECT doc_id, length(clean_text) < 15 AS too_short FROM docs",
    "text_preview": f"{DOCS} SELECT doc_id, substr(clean_text, 1, 1500) AS text_preview FROM docs",
    "failed_reason": f"{DOCS}, noted AS (SELECT *, {NOTES} AS notes FROM docs WHERE length(clean_text) < 15) SELECT doc_id, {FAILED_REASON} AS reason FROM noted",
    "assemble_pages": f"""WITH stripped AS (SELECT conv_id, turn, {_strip_all('text')} AS t FROM conversations)
SELECT conv_id, {_strip_all(f"coalesce(string_agg(t, {LF} ORDER BY turn) FILTER (WHERE t <> ''), '')")} AS text FROM stripped GROUP BY conv_id""",
    "keyword_scores": f"{RULED} SELECT doc_id, invoice_score, resume_score FROM ruled",
    "rule_classify": f"{RULED} SELECT doc_id, rule_label FROM ruled",
    "tfidf_terms": f"{ALL_DOCS} SELECT term, df, round(idf, 6) AS idf FROM freq",
    "tfidf_weights": f"{ALL_DOCS}, {_normed('fit')} SELECT doc_id, count(*) AS n_terms, round(sum(weight), 4) AS sum_weight, round(max(weight), 6) AS max_weight FROM fit_weights GROUP BY doc_id",
    "stratified_split": f"{SPLIT} SELECT doc_id, label, is_test FROM parted",
    "nb_relational": f"{BAYES} SELECT doc_id, label AS predicted, round(score, 4) AS score FROM totals QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) = 1",
    "ml_score": f"{SCORED} SELECT doc_id, predicted, confidence FROM best JOIN sure USING (doc_id)",
    "process_with_model": f"""{SCORED}
SELECT 'saved' AS model, doc_id, CASE WHEN length(clean_text) < 15 THEN 'Other' ELSE predicted END AS document_type,
  confidence, 'NaiveBayes' AS classifier FROM test JOIN best USING (doc_id) JOIN sure USING (doc_id)
UNION ALL
SELECT 'absent', doc_id, CASE WHEN length(clean_text) < 15 THEN 'Other' ELSE rule_label END, NULL, 'Rule-based'
FROM test JOIN (SELECT doc_id, rule_label FROM ({RULED} SELECT * FROM ruled)) USING (doc_id)""",
    "classify_with_fallback": f"""{RULED} SELECT doc_id, CASE WHEN filename LIKE '%.pdf' THEN kind ELSE rule_label END AS document_type,
  CASE WHEN filename LIKE '%.pdf' THEN CAST(0.875 AS DOUBLE) END AS confidence,
  CASE WHEN filename LIKE '%.pdf' THEN 'NaiveBayes' ELSE 'Rule-based' END AS classifier FROM ruled""",
    "eval_macro": f"{PREDICTIONS} SELECT model, accuracy, precision, recall, f1 FROM evaluated",
    "confusion_matrix": f"""{PREDICTIONS} SELECT label, count(*) FILTER (WHERE predicted = 'bad') AS bad,
  count(*) FILTER (WHERE predicted = 'good') AS good, count(*) FILTER (WHERE predicted = 'toxic') AS toxic
  FROM preds WHERE model = 'LinearSVM' GROUP BY label""",
    "best_model": f"""{PREDICTIONS} SELECT model AS best_model FROM evaluated ORDER BY f1 DESC, accuracy DESC,
  list_position(['LogisticRegression', 'LinearSVM', 'NaiveBayes'], model) LIMIT 1""",
    "evaluation_report": f"""{PREDICTIONS}, cells AS (
  SELECT model, label, predicted, count(*) AS n FROM preds GROUP BY model, label, predicted
), shown AS (
  SELECT model, string_agg(label || '>' || predicted || '=' || CAST(n AS VARCHAR), '; ' ORDER BY label, predicted) AS cells FROM cells GROUP BY model
) SELECT model, accuracy, f1, row_number() OVER (ORDER BY f1 DESC, accuracy DESC,
  list_position(['LogisticRegression', 'LinearSVM', 'NaiveBayes'], model)) = 1 AS chosen, cells FROM evaluated JOIN shown USING (model)""",
    "distinct_labels": f"{RAW} SELECT DISTINCT kind AS label FROM docs_raw ORDER BY label",
    **{
        f"extract_{name}": f"{DOCS} SELECT doc_id, {sql} AS {name} FROM docs"
        for name, sql in FIELD_SQL.items()
    },
    "extract_fields": f"{DONE} SELECT doc_id, document_type, {FLAT_NAMES} FROM done",
    "columns_from_fields": f"{DONE} SELECT doc_id, company, invoice_number, total AS total_amount FROM done",
    "missing_important": f"{DONE} SELECT doc_id, missing FROM done",
    "determine_status": f"{RULED}, given AS (SELECT *, CAST([] AS VARCHAR[]) AS notes, CAST(NULL AS VARCHAR) AS read_error, {CONFIDENCE} AS confidence FROM ruled),\n{_extracted('given', 'FALSE')} SELECT doc_id, status, status_reason FROM done",
    "ingest_status": f"{RULED}, given AS (SELECT *, {NOTES} AS notes, CASE WHEN filename LIKE '%.jpeg' THEN {_q(C.MSG_UNREADABLE)} END AS read_error, {CONFIDENCE} AS confidence FROM ruled),\n{_extracted('given', '(length(clean_text) < 15 OR read_error IS NOT NULL)')} SELECT doc_id, document_type, status, status_reason FROM done",
    "ingest_errors": f"""{RULED}, given AS (SELECT *, CAST([] AS VARCHAR[]) AS notes, CASE WHEN doc_id % 11 = 4 THEN {_q(C.MSG_UNREADABLE)} END AS read_error, CAST(NULL AS DOUBLE) AS confidence FROM ruled),
{_extracted('given', '(length(clean_text) < 15 OR read_error IS NOT NULL)')}, lost AS (SELECT *, doc_id % 7 = 3 AND NOT is_failed AS not_extracted FROM done)
SELECT doc_id, document_type, CASE WHEN not_extracted THEN 'Needs Review' ELSE status END AS status,
  CASE WHEN not_extracted THEN {_q(C.MSG_NOT_EXTRACTED)} ELSE status_reason END AS status_reason,
  CASE WHEN NOT not_extracted THEN company END AS company FROM lost""",
    "process_corpus": f"{DONE} SELECT doc_id, document_type, status, status_reason, 'Rule-based' AS classifier, {FLAT_NAMES} FROM done",
    "corpus_summary": f"{DONE} SELECT kind, document_type, status, count(*) AS n, count(total) AS with_total FROM done GROUP BY kind, document_type, status",
    "apply_corrections": f"""{STORED}, fixes AS (
  SELECT o_orderkey * 3 AS doc_id, 'FIX-' || CAST(o_orderkey AS VARCHAR) AS num,
    CASE WHEN o_orderstatus = 'F' THEN NULL ELSE 'Fixed Ltd' END AS comp,
    CASE WHEN o_orderstatus <> 'O' THEN '12.00' END AS total FROM orders
), joined AS (
  SELECT s.* EXCLUDE (status, company, invoice_number, total_amount, fields_json), s.status AS old_status,
    s.company AS old_company, s.invoice_number AS old_number, s.total_amount AS old_total, s.fields_json AS old_json,
    f.doc_id IS NOT NULL AS hit, num, comp, total,
    CASE document_type WHEN 'Invoice' THEN concat_ws(', ', CASE WHEN comp IS NULL THEN 'Company Name' END, CASE WHEN total IS NULL THEN 'Total Amount' END)
         WHEN 'Resume' THEN 'Name, Email' ELSE '' END AS missing
  FROM stored_docs s LEFT JOIN fixes f ON f.doc_id = s.doc_id
) SELECT doc_id, CASE WHEN NOT hit THEN old_status WHEN missing <> '' THEN 'Needs Review' ELSE 'Processed' END AS status,
  CASE WHEN hit THEN CASE WHEN missing <> '' THEN 'Missing: ' || missing || '.' ELSE {_q(C.MSG_ALL_FOUND)} END END AS status_reason,
  CASE WHEN hit THEN comp ELSE old_company END AS company, CASE WHEN hit THEN num ELSE old_number END AS invoice_number,
  CASE WHEN hit THEN total ELSE old_total END AS total_amount,
  CASE WHEN hit THEN CAST(json_object('Invoice Number', num, 'Date', 'Not Found', 'Company Name', coalesce(comp, 'Not Found'), 'Total Amount', coalesce(total, 'Not Found')) AS VARCHAR) ELSE old_json END AS fields_json,
  CASE WHEN hit THEN 'Changes saved. Status: ' || CASE WHEN missing <> '' THEN 'Needs Review' ELSE 'Processed' END || '.' END AS message FROM joined""",
    "load_fields": f"{STORED}, {LOADED} SELECT doc_id, CAST(len(raw_entries) AS INTEGER) AS n_fields FROM loaded",
    "normalize_fields": f"{FIELDS} SELECT doc_id, {_entries('entries', 'k', 'v')} AS canonical FROM found",
    "blank_fields": f"{FIELDS} SELECT doc_id, array_to_string(list_sort(list_transform(list_filter(entries, lambda e: {_blank('e.v')}), lambda e: e.k)), ', ') AS blank FROM found",
    "missing_required": f"{FIELDS} SELECT doc_id, array_to_string(missing, ', ') AS missing FROM found",
    "valid_email": _check_query("email", _valid_email("v_email"), "valid"),
    "valid_phone": _check_query("phone", _valid_phone("v_phone"), "valid"),
    "valid_date": _check_query("date", _valid_date("v_date"), "valid"),
    "parse_amount": _check_query("total_amount", _amount("v_total_amount"), "amount"),
    "valid_amount": _check_query("total_amount", _valid_amount("v_total_amount"), "valid"),
    "validate_documents": f"""{FIELDS} SELECT doc_id, len(missing) + len(invalid) = 0 AS is_valid, array_to_string(missing, ', ') AS missing,
  array_to_string(list_sort(list_transform(invalid, lambda z: z || '=' || {REASON_OF})), '; ') AS invalid,
  array_to_string(list_concat(missing, list_filter(invalid, lambda z: NOT list_contains(missing, z))), ', ') AS failed_fields,
  array_to_string(list_sort(list_distinct(list_concat(required, present))), ', ') AS checked FROM found""",
    **{name: f"{FIELDS} SELECT doc_id, {sql} AS reason FROM found" for name, sql in RULE_SQL.items()},
    "rule_duplicate": f"{STORED} SELECT doc_id, CASE WHEN {REPEATED} THEN {_q(C.MSG_POSSIBLE_DUPLICATE)} END AS reason FROM stored_docs",
    "decide": f"""{FIELDS}, hits AS (
  SELECT doc_id, coalesce({ANY_RULE}, CASE WHEN {REPEATED} THEN {_q(C.MSG_POSSIBLE_DUPLICATE)} END) AS hit FROM found
) SELECT doc_id, CASE WHEN hit IS NULL THEN 'Completed' ELSE 'Needs Review' END AS next_state,
  CASE WHEN hit IS NULL THEN 'auto_completed' ELSE 'sent_to_review' END AS action,
  coalesce(hit, {_q(C.NOTE_PASSED)}) AS reason FROM hits""",
    "transition_valid": f"{with_corpora('stored_docs', 'wf_events')} SELECT document_id, seq, doc_id IS NOT NULL AND {_allowed(STATE, 'requested_state')} AS allowed FROM wf_events LEFT JOIN stored_docs ON doc_id = document_id",
    "transition_blocked": f"""{with_corpora('stored_docs', 'wf_events')} SELECT document_id, seq,
  CASE WHEN doc_id IS NULL THEN 'Document ' || CAST(document_id AS VARCHAR) || ' not found'
       ELSE 'Invalid transition: ' || {STATE} || ' -> ' || requested_state END AS error
  FROM wf_events LEFT JOIN stored_docs ON doc_id = document_id WHERE doc_id IS NULL OR NOT {_allowed(STATE, 'requested_state')}""",
    "change_status": f"""{CHANGE}, last AS (
  SELECT document_id, arg_max(after, rn) AS after, count(*) FILTER (WHERE after <> before) AS applied FROM fold GROUP BY document_id
) SELECT doc_id, CASE WHEN coalesce(applied, 0) > 0 THEN after ELSE workflow_status END AS workflow_status
  FROM stored_docs LEFT JOIN last ON document_id = doc_id""",
    "stream_workflow_audit": f"{CHANGE} SELECT document_id, 'changed' AS action, before AS previous_status, after AS new_status, 'request ' || CAST(seq AS VARCHAR) AS reason FROM fold WHERE after <> before",
    "stream_workflow_states": f"""{CHANGE}, last AS (
  SELECT document_id, arg_max(after, rn) AS after, count(*) FILTER (WHERE after <> before) AS applied FROM fold GROUP BY document_id
) SELECT doc_id, CASE WHEN coalesce(applied, 0) > 0 THEN after ELSE workflow_status END AS workflow_status
  FROM stored_docs LEFT JOIN last ON document_id = doc_id""",
    "change_status_audit": f"{CHANGE} SELECT document_id, seq AS pos, 'changed' AS action, before AS previous_status, after AS new_status, 'request ' || CAST(seq AS VARCHAR) AS reason FROM fold WHERE after <> before",
    "workflow_batch": f"""{BATCH} SELECT s.doc_id, CASE WHEN o.startable THEN o.after ELSE s.workflow_status END AS workflow_status,
  CASE WHEN o.startable THEN o.hit END AS review_reason,
  CASE WHEN o.startable THEN nullif(lower(o.document_type), '') END AS predicted_type,
  CASE WHEN o.startable THEN o.confidence ELSE s.confidence END AS confidence,
  CASE WHEN o.startable THEN FALSE ELSE s.failed END AS failed, CAST(NULL AS VARCHAR) AS last_error
  FROM stored_docs s LEFT JOIN outcome o ON o.doc_id = s.doc_id""",
    "workflow_batch_audit": f"""{BATCH}
SELECT document_id, pos, 0 AS step, 'processing_started' AS action, before AS previous_status, 'Processing' AS new_status, 'Workflow started' AS reason FROM results WHERE ok
UNION ALL SELECT document_id, pos, 1, action, 'Processing', after, reason FROM results WHERE ok
UNION ALL SELECT document_id, pos, 0, 'transition_blocked', after, after, reason FROM results WHERE found AND NOT ok""",
    "workflow_failures": f"{BATCH} SELECT pos, document_id, reason FROM results WHERE NOT ok",
    "failure_records": f"""{STORED} SELECT doc_id AS document_id, 'processing_failed' AS action,
  CASE WHEN workflow_status = 'Processing' THEN 'Processing' END AS previous_status,
  CASE WHEN workflow_status = 'Processing' THEN 'New' END AS new_status, CASE WHEN o_orderkey % 4 = 0 THEN 'again ' ELSE '' END || 'worker lost: ' || o_orderpriority AS reason
  FROM stored_docs JOIN orders ON o_orderkey * 3 = doc_id""",
    "workflow_then_history": f"""{BATCH}, made AS (
  SELECT document_id, pos, 0 AS step, 'processing_started' AS action, before AS previous_status, 'Processing' AS new_status, 'Workflow started' AS reason FROM results WHERE ok
  UNION ALL SELECT document_id, pos, 1, action, 'Processing', after, reason FROM results WHERE ok
  UNION ALL SELECT document_id, pos, 0, 'transition_blocked', after, after, reason FROM results WHERE found AND NOT ok
) SELECT document_id, action, previous_status, new_status, reason FROM made""",
    "batch_validation_json": f"{BATCH} SELECT doc_id, is_valid FROM outcome WHERE startable",
    "batch_counts": f"{BATCH} SELECT count(*) FILTER (WHERE ok AND after = 'Completed') AS processed, count(*) FILTER (WHERE ok AND after = 'Needs Review') AS review, count(*) FILTER (WHERE NOT ok) AS failed FROM results",
    "review_actions": f"{REVIEW} SELECT f.document_id, f.seq AS pos, k.action, f.before AS previous_status, f.after AS new_status, k.reason FROM fold f JOIN known k ON k.document_id = f.document_id AND k.seq = f.seq WHERE f.after <> f.before",
    "review_refused": f"""{REVIEW} SELECT document_id, seq, 'Invalid transition: ' || before || ' -> ' || requested_state AS error FROM fold WHERE after = before
UNION ALL SELECT document_id, seq, 'Document ' || CAST(document_id AS VARCHAR) || ' not found' FROM acts WHERE NOT unreasoned AND NOT unknown AND document_id NOT IN (SELECT doc_id FROM stored_docs)
UNION ALL SELECT document_id, seq, {_q(C.REJECT_NEEDS_REASON)} FROM acts WHERE unreasoned
UNION ALL SELECT document_id, seq, {_message(C.MSG_DECISION, "coalesce(decision, 'None')")} FROM acts WHERE unknown""",
    "replay_workflow": f"{REPLAY} SELECT document_id, arg_max(after, rn) AS workflow_status, count(*) FILTER (WHERE after <> before) AS applied, count(*) FILTER (WHERE after = before) AS blocked FROM fold GROUP BY document_id",
    "stream_workflow": f"{REPLAY} SELECT document_id, arg_max(after, rn) AS workflow_status, count(*) AS requests FROM fold GROUP BY document_id",
    "audit_history": f"{with_corpora('stored_docs', 'audit_rows')} SELECT document_id, action, previous_status, new_status, {_shown('ts')} AS ts, reason FROM audit_rows WHERE document_id IN (SELECT doc_id FROM stored_docs) ORDER BY document_id, id",
    "latest_action": f"{with_corpora('audit_rows')}, {LATEST} SELECT doc_id, latest_action, {_shown('latest_ts')} AS latest_timestamp FROM documents LEFT JOIN latest ON document_id = doc_id",
    "search_words": f"{STORED} SELECT doc_id, original_filename FROM stored_docs WHERE {_has_words(['client', '50%', 'urgent'])}",
    "filter_type_status": f"{STORED} SELECT doc_id, document_type, status FROM stored_docs WHERE document_type = 'Invoice' AND status = 'Needs Review'",
    "filter_date_range": f"{STORED} SELECT doc_id, {_shown('upload_ts')} AS upload_ts FROM stored_docs WHERE CAST(upload_ts AS DATE) BETWEEN DATE '1996-03-01' AND DATE '2000-06-30'",
    "sort_documents": f"{STORED} SELECT doc_id, {_shown('upload_ts')} AS upload_ts FROM stored_docs ORDER BY stored_docs.upload_ts, doc_id",
    "page_documents": f"{STORED} SELECT doc_id, {_shown('upload_ts')} AS upload_ts FROM stored_docs WHERE document_type = 'Invoice' ORDER BY stored_docs.upload_ts DESC, doc_id DESC LIMIT 20 OFFSET 40",
    "count_filtered": f"{STORED} SELECT count(*) AS n, CAST(greatest(0, (count(*) - 1) // 20) AS BIGINT) AS last_page FROM stored_docs WHERE status = 'Processed' AND {_has_words(['client', 'trading'])}",
    "workflow_search": f"""{SEARCH} SELECT doc_id, original_filename, document_type, workflow_status, confidence, failed, latest_action, {_shown('latest_ts')} AS latest_timestamp
  FROM stored_docs LEFT JOIN latest ON document_id = doc_id
  WHERE workflow_status = 'New' AND (coalesce({_fold('original_filename')} LIKE '%inv_%5%', FALSE) OR coalesce({_fold('document_type')} LIKE '%inv_%5%', FALSE)
    OR coalesce({_fold('fields_json')} LIKE '%inv_%5%', FALSE)) ORDER BY doc_id DESC""",
    "lookup_ids": f"{with_corpora('stored_docs', 'batch_ids')} SELECT doc_id, original_filename, status FROM stored_docs WHERE doc_id IN (SELECT document_id FROM batch_ids)",
    "review_queue": f"{SEARCH} SELECT doc_id, original_filename, latest_action FROM stored_docs LEFT JOIN latest ON document_id = doc_id WHERE workflow_status = 'Needs Review' ORDER BY doc_id DESC",
    "document_cards": f"""{STORED} SELECT doc_id, coalesce(nullif(company, ''), nullif(invoice_number, ''), document_type) AS subtitle,
  printf('%.1f KB', coalesce(file_size, 0) / 1024) AS size_label, left(file_hash, 16) AS hash_prefix,
  '#' || CAST(doc_id AS VARCHAR) || ' - ' || original_filename || ' (' || coalesce(nullif(document_type, ''), 'unknown') || ') [' || coalesce(workflow_status, 'None') || ']' AS label FROM stored_docs""",
    "library_stats": f"""{STORED} SELECT 'total' AS measure, CAST(NULL AS VARCHAR) AS value, count(*) AS n FROM stored_docs
UNION ALL SELECT 'status', status, count(*) FROM stored_docs GROUP BY status
UNION ALL SELECT 'type', document_type, count(*) FROM stored_docs GROUP BY document_type""",
    "dashboard_tiles": f"""{STORED} SELECT count(*) AS total, count(*) FILTER (WHERE status = 'Processed') AS processed,
  count(*) FILTER (WHERE status = 'Needs Review') AS needs_review, count(*) FILTER (WHERE status = 'Failed') AS failed FROM stored_docs""",
    "workflow_metrics": f"""{STORED} SELECT count(*) AS total, count(*) FILTER (WHERE workflow_status NOT IN ('New', 'Processing')) AS processed,
  count(*) FILTER (WHERE workflow_status = 'Needs Review') AS needs_review, count(*) FILTER (WHERE workflow_status = 'Approved') AS approved,
  count(*) FILTER (WHERE workflow_status = 'Rejected') AS rejected, count(*) FILTER (WHERE workflow_status = 'Completed') AS completed,
  count(*) FILTER (WHERE failed) AS failed, round(avg(processing_ms), 6) AS avg_processing_ms FROM stored_docs""",
    "metrics_by_type": f"{STORED} SELECT coalesce(document_type, 'unknown') AS document_type, count(*) AS n FROM stored_docs GROUP BY 1",
    "metrics_by_status": f"{STORED} SELECT workflow_status, count(*) AS n FROM stored_docs GROUP BY 1",
    "avg_processing": f"{STORED} SELECT round(avg(processing_ms), 6) AS avg_processing_ms FROM stored_docs WHERE processing_ms IS NOT NULL",
    "apply_updates": f"""{STORED}, changes AS (
  SELECT o_orderkey * 3 AS doc_id, CASE WHEN o_totalprice > 200000 THEN 'Large Ltd' END AS company FROM orders WHERE o_orderstatus = 'F'
) SELECT s.doc_id, CASE WHEN c.doc_id IS NOT NULL THEN c.company ELSE s.company END AS company,
  CASE WHEN c.doc_id IS NOT NULL THEN 'Needs Review' ELSE s.status END AS status, c.doc_id IS NOT NULL AS changed
  FROM stored_docs s LEFT JOIN changes c ON c.doc_id = s.doc_id""",
    "apply_deletes": f"{with_corpora('stored_docs', 'batch_ids')} SELECT doc_id, stored_filename FROM stored_docs WHERE doc_id NOT IN (SELECT document_id FROM batch_ids)",
    "delete_report": f"""{with_corpora('stored_docs', 'batch_ids')} SELECT b.document_id AS doc_id, s.stored_filename AS removed_file,
  CASE WHEN s.doc_id IS NOT NULL THEN '{C.STORAGE_ROOT}/' || {_folder('s.document_type')} || '/' || s.stored_filename END AS removed_path,
  CASE WHEN s.doc_id IS NULL THEN {_q(C.MSG_GONE)} ELSE {_q(C.MSG_DELETED)} END AS message
  FROM (SELECT DISTINCT document_id FROM batch_ids) b LEFT JOIN stored_docs s ON s.doc_id = b.document_id""",
}
