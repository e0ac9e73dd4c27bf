"""Business documents rendered from the star schema.

The test tables hold no invoices or resumes, so these texts derive them: one
invoice per order, one resume per customer, and every row of ``documents`` as
an other document.  The statements are written in the SQL that Spark and DuckDB
share; the few spellings that differ are parameters.
"""

from __future__ import annotations

import hashlib
import textwrap
from string import Template

from pyspark.sql import DataFrame, SparkSession

from ledgerleaf.session import scratch_dir
from ledgerleaf.sources.layout import spread

SPARK = {
    "ts": "TIMESTAMP_NTZ",
    "sha_open": "sha2(",
    "sha_close": ", 256)",
    "bytes_open": "CAST(",
    "bytes_close": " AS BINARY)",
}
DUCKDB = {
    "ts": "TIMESTAMP",
    "sha_open": "sha256(",
    "sha_close": ")",
    "bytes_open": "encode(",
    "bytes_close": ")",
}

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Ten kinds of invoice by order key: without total, two-digit year, bare number,
# no company label, currency code, other labels, messy blanks, too short,
# copies in groups, plain.
DOCS_RAW = """
SELECT CAST(o_orderkey * 3 AS BIGINT) AS doc_id,
       'Invoice' AS kind,
       'scan/invoice ' || CAST(o_orderkey AS STRING) || CASE o_orderkey % 7
           WHEN 0 THEN '.PNG' WHEN 1 THEN '.jpeg' WHEN 2 THEN '.txt' WHEN 3 THEN ''
           ELSE '.pdf' END AS filename,
       o_orderdate AS upload_ts,
       CASE o_orderkey % 10
         WHEN 0 THEN 'INVOICE' || chr(10) || 'Company: Client ' || CAST(o_custkey AS STRING) || ' Trading' || chr(10)
              || 'Invoice Number: INV-' || CAST(o_orderkey AS STRING) || chr(10)
              || 'Date: ' || substr(CAST(o_orderdate AS STRING), 1, 10) || chr(10) || 'Settled by direct debit on delivery.'
         WHEN 1 THEN 'TAX INVOICE' || chr(10) || 'Company Name: Client ' || CAST(o_custkey AS STRING) || ' Ltd' || chr(10)
              || 'Invoice No. INV-' || CAST(o_orderkey AS STRING) || chr(10)
              || 'Date: ' || substr(CAST(o_orderdate AS STRING), 9, 2) || '/' || substr(CAST(o_orderdate AS STRING), 6, 2)
              || '/' || substr(CAST(o_orderdate AS STRING), 3, 2) || chr(10)
              || 'Total: $$' || CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING)
         WHEN 2 THEN 'Statement of account' || chr(10) || 'Company - House ' || CAST(o_custkey AS STRING) || chr(10)
              || 'Ref # ' || CAST(o_orderkey + 10000 AS STRING) || chr(10)
              || 'Date ' || substr(CAST(o_orderdate AS STRING), 1, 10) || chr(10)
              || 'Amount due: ' || CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING)
         WHEN 3 THEN 'Purchase Invoice' || chr(10) || 'House ' || CAST(o_custkey AS STRING) || ' and Sons' || chr(10)
              || 'Invoice Number: PO-' || CAST(o_orderkey AS STRING) || chr(10)
              || 'Date: ' || substr(CAST(o_orderdate AS STRING), 1, 10) || chr(10)
              || 'Subtotal: 10.00' || chr(10) || 'Total Amount: ' || CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING)
         WHEN 4 THEN 'INVOICE' || chr(10) || 'Company: Client ' || CAST(o_custkey AS STRING) || chr(10)
              || 'Invoice No: INV-' || CAST(o_orderkey AS STRING) || chr(10)
              || 'Date: ' || substr(CAST(o_orderdate AS STRING), 1, 10) || chr(10)
              || 'Grand Total: PKR ' || CAST(o_orderkey % 900 + 100 AS STRING) || ','
              || lpad(CAST(o_custkey % 1000 AS STRING), 3, '0')
         WHEN 5 THEN 'INVOICE' || chr(10) || 'Company: Client ' || CAST(o_custkey AS STRING) || ' Logistics' || chr(10)
              || 'Invoice #: QW-' || CAST(o_orderkey AS STRING) || chr(10)
              || 'Date: ' || substr(CAST(o_orderdate AS STRING), 1, 10) || chr(10)
              || 'Amount Due: $$' || CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING)
         WHEN 6 THEN '  INVOICE ' || chr(13) || chr(10) || chr(9) || 'Company:   Client' || chr(9) || chr(9)
              || CAST(o_custkey AS STRING) || ' Café' || chr(13) || chr(13) || chr(13) || chr(13)
              || 'Invoice Number:  INV-' || CAST(o_orderkey AS STRING) || '  ' || chr(10) || chr(10) || chr(10) || ' ' || chr(10)
              || 'Date:' || chr(9) || substr(CAST(o_orderdate AS STRING), 1, 10) || chr(13) || chr(10)
              || 'Total:  € ' || CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING) || chr(10)
         WHEN 7 THEN ' # ' || CAST(o_orderkey AS STRING) || chr(10)
         WHEN 8 THEN 'INVOICE' || chr(10) || 'Company: Group ' || CAST(o_orderkey - o_orderkey % 50 AS STRING) || chr(10)
              || 'Invoice Number: GRP-' || CAST(o_orderkey - o_orderkey % 50 AS STRING) || chr(10)
              || 'Date: 2001-02-03' || chr(10) || 'Total: ' || CAST(o_orderkey - o_orderkey % 50 + 100 AS STRING) || '.50'
         ELSE 'INVOICE' || chr(10) || 'Company: Client ' || CAST(o_custkey AS STRING) || ' Trading' || chr(10)
              || 'Invoice Number: INV-' || CAST(o_orderkey AS STRING) || chr(10)
              || 'Date: ' || substr(CAST(o_orderdate AS STRING), 1, 10) || chr(10)
              || 'Bill To: ' || o_orderpriority || chr(10)
              || 'Total Amount: $$' || CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING) || chr(10)
              || 'Kept on file at the counter.'
       END AS text
FROM $orders
UNION ALL
SELECT CAST(c_custkey * 3 + 1 AS BIGINT), 'Resume',
       'cv_' || CAST(c_custkey AS STRING) || '.pdf',
       CAST('2000-' || lpad(CAST(c_custkey % 12 + 1 AS STRING), 2, '0') || '-'
            || lpad(CAST(c_custkey % 28 + 1 AS STRING), 2, '0') || ' 08:30:00' AS $ts),
       CASE WHEN c_custkey % 2 = 0 THEN 'RESUME' ELSE 'Curriculum Vitae' END || chr(10)
       || CASE WHEN c_custkey % 5 = 1 THEN '' ELSE 'Name: ' END
       || 'Person ' || c_mktsegment || ' ' || CAST(c_custkey AS STRING) || chr(10)
       || CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'Email: person.' || CAST(c_custkey AS STRING) || '@example.com' || chr(10) END
       || 'Phone: ' || CASE WHEN c_custkey % 5 = 3 THEN '12345678901234567890'
                            ELSE '+92 300 ' || CAST(1000000 + c_custkey AS STRING) END || chr(10)
       || CASE WHEN c_custkey % 5 = 2 THEN '' ELSE 'Skills: ' || lower(c_mktsegment) || ', SQL,' || chr(10) || 'Reporting' || chr(10) END
       || 'Education: BSc Commerce' || chr(10)
       || 'Experience: Clerk, ' || CAST(c_custkey % 20 AS STRING) || ' years'
FROM $customer
UNION ALL
SELECT CAST(doc_id * 3 + 2 AS BIGINT), 'Other',
       source || '-' || lang || '_' || CAST(doc_id AS STRING) || '.pdf',
       CAST('2002-03-' || lpad(CAST(doc_id % 28 + 1 AS STRING), 2, '0') || ' 12:00:00' AS $ts),
       text
FROM $documents
"""

# The same documents as landed files with the uploader's list of sizes: some
# empty, some too large by the list, some without the bytes their name promises.
LANDED = """
SELECT doc_id, kind, filename, upload_ts, text,
       CASE WHEN doc_id % 11 = 0 THEN CAST(0 AS BIGINT)
            WHEN doc_id % 101 = 0 THEN CAST(11000000 + doc_id AS BIGINT)
            ELSE CAST(length(text) + 4 AS BIGINT) END AS size,
       CASE WHEN doc_id % 11 = 0 THEN NULL
            WHEN doc_id % 11 = 1 THEN $bytes_open text $bytes_close
            WHEN lower(filename) LIKE '%.png' THEN unhex('89504E470D0A1A0A') || $bytes_open text $bytes_close
            WHEN lower(filename) LIKE '%.jpeg' THEN unhex('FFD8FF') || $bytes_open text $bytes_close
            ELSE unhex('25504446') || $bytes_open text $bytes_close END AS content
FROM (
$docs_raw
)
"""

# Rows of the documents table with stored fields of every shape the checks know.
STORED_DOCS = """
SELECT CAST(o_orderkey * 3 AS BIGINT) AS doc_id,
       'invoice_' || CAST(o_orderkey AS STRING) || CASE WHEN o_orderkey % 4 = 0 THEN '_50%.png' ELSE '.pdf' END AS original_filename,
       '20260101_' || CAST(o_orderkey AS STRING) || '.pdf' AS stored_filename,
       CASE o_orderkey % 13 WHEN 0 THEN NULL WHEN 1 THEN 'Other' WHEN 2 THEN 'invoice' ELSE 'Invoice' END AS document_type,
       o_orderdate AS upload_ts,
       CASE WHEN o_orderkey % 6 = 1 THEN NULL ELSE 'Client ' || CAST(o_custkey AS STRING) || ' Trading' END AS company,
       CASE WHEN o_orderkey % 6 = 2 THEN NULL ELSE 'INV-' || CAST(o_orderkey AS STRING) END AS invoice_number,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING) AS total_amount,
       'INVOICE for Client ' || CAST(o_custkey AS STRING) || ' priority ' || o_orderpriority AS text_preview,
       $sha_open CASE WHEN o_orderkey % 8 = 0 THEN 'copy' || CAST(o_orderkey - o_orderkey % 40 AS STRING)
                 ELSE 'doc' || CAST(o_orderkey AS STRING) END $sha_close AS file_hash,
       CAST(o_orderkey * 17 % 200000 AS BIGINT) AS file_size,
       CASE o_orderstatus WHEN 'F' THEN 'Processed' WHEN 'O' THEN 'Needs Review' ELSE 'Failed' END AS status,
       CASE o_orderkey % 12
         WHEN 1 THEN '{"Invoice Number":"INV-' || CAST(o_orderkey AS STRING) || '","Date":"' || substr(CAST(o_orderdate AS STRING), 1, 10) || '","Total Amount":"$$2,984.10"}'
         WHEN 2 THEN '{"Invoice Number":"INV-' || CAST(o_orderkey AS STRING) || '","Date":"' || CASE WHEN o_orderkey % 24 = 2 THEN '01/02/0000' ELSE 'some day in Smarch' END || '","Company Name":"Rowan Mills Ltd","Total Amount":"$$2,984.10"}'
         WHEN 3 THEN '{"Invoice Number":"INV-' || CAST(o_orderkey AS STRING) || '","Date":"09/11/2025","Company Name":"Rowan Mills Ltd","Total Amount":"twelve"}'
         WHEN 4 THEN '{" invoice no ":"INV-' || CAST(o_orderkey AS STRING) || '","Date":"5 March 2026","Vendor":"House ' || CAST(o_custkey AS STRING) || '","Amount":"PKR 5,000"}'
         WHEN 5 THEN '{"Company":"First","invoice_id":"INV-' || CAST(o_orderkey AS STRING) || '","date":"Feb 29, 2025","vendor":"Second ' || CAST(o_custkey AS STRING) || '","total":"-4.50"}'
         WHEN 6 THEN '{}'
         WHEN 7 THEN 'not json {'
         WHEN 8 THEN '["a","b"]'
         WHEN 9 THEN CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE NULL END
         WHEN 10 THEN '{"Invoice Number":"  ","Date":"","Company Name":"' || chr(160) || '","Total Amount":null}'
         WHEN 11 THEN CASE WHEN o_orderkey % 5 = 1 THEN '{"Invoice Number":"Not Found","Date":"Not Found"}' ELSE '' END
                   || CASE WHEN o_orderkey % 5 = 1 THEN '' ELSE '{"Invoice Number":"INV-' || CAST(o_orderkey AS STRING) || '","Date":"01/02/26","Company Name":"Not Found","Total Amount":"Rs. 500"}' END
         ELSE '{"Invoice Number":"INV-' || CAST(o_orderkey AS STRING) || '","Date":"' || substr(CAST(o_orderdate AS STRING), 1, 10) || '","Company Name":"Client ' || CAST(o_custkey AS STRING) || '","Total Amount":"' || CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING) || '"}'
       END AS fields_json,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderkey * 37 % 101 AS DOUBLE) / 100 END AS confidence,
       CASE WHEN o_orderkey % 23 = 0 THEN 'Processing' WHEN o_orderkey % 19 = 0 THEN 'Rejected'
            WHEN o_orderkey % 17 = 0 THEN 'Approved' WHEN o_orderkey % 7 = 6 THEN 'Completed'
            WHEN o_orderkey % 7 = 5 THEN 'Needs Review' WHEN o_orderkey % 7 = 4 THEN NULL ELSE 'New' END AS workflow_status,
       CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderkey % 1000 AS DOUBLE) / 8 END AS processing_ms,
       o_orderkey % 29 = 0 AS failed
FROM $orders
UNION ALL
SELECT CAST(c_custkey * 3 + 1 AS BIGINT), 'cv_' || CAST(c_custkey AS STRING) || '.pdf',
       '20260102_' || CAST(c_custkey AS STRING) || '.pdf',
       CASE c_custkey % 4 WHEN 0 THEN 'resume' ELSE 'Resume' END,
       CAST('2000-' || lpad(CAST(c_custkey % 12 + 1 AS STRING), 2, '0') || '-'
            || lpad(CAST(c_custkey % 28 + 1 AS STRING), 2, '0') || ' 08:30:00' AS $ts),
       NULL, NULL, NULL, 'RESUME of Person ' || CAST(c_custkey AS STRING) || ' in ' || c_mktsegment,
       $sha_open 'cv' || CAST(c_custkey AS STRING) $sha_close,
       CAST(c_custkey * 31 % 90000 AS BIGINT),
       CASE c_custkey % 3 WHEN 0 THEN 'Needs Review' ELSE 'Processed' END,
       CASE c_custkey % 6
         WHEN 1 THEN '{"Name":"Person ' || CAST(c_custkey AS STRING) || '","Email":"mail at nowhere","Phone":"+44 20 7946 0958","Skills":["SQL"]}'
         WHEN 2 THEN '{"Name":"Person ' || CAST(c_custkey AS STRING) || '","Email":"p' || CAST(c_custkey AS STRING) || '@example.com","Phone":"12-34","Skills":["SQL","Excel"]}'
         WHEN 3 THEN '{"Name":"Person ' || CAST(c_custkey AS STRING) || '","Email":"p' || CAST(c_custkey AS STRING) || '@example.com","Phone":"","Skills":[""," "]}'
         WHEN 4 THEN '{"Full Name":"Person ' || CAST(c_custkey AS STRING) || '","E-mail":" p' || CAST(c_custkey AS STRING) || '@mail.example.org ","Mobile":"(030) 123-4567","skills":"Java"}'
         WHEN 5 THEN '{"Email":"p' || CAST(c_custkey AS STRING) || '@example","Contact":"123 abc","Skills":[]}'
         ELSE '{"Name":"Person ' || CAST(c_custkey AS STRING) || '","Email":"p' || CAST(c_custkey AS STRING) || '@example.com","Phone":"+44 20 7946 0958","Skills":["Python","SQL"]}'
       END,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_custkey * 37 % 101 AS DOUBLE) / 100 END,
       CASE WHEN c_custkey % 7 = 5 THEN 'Needs Review' WHEN c_custkey % 7 = 6 THEN 'Completed' ELSE 'New' END,
       CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE CAST(c_custkey % 1000 AS DOUBLE) / 8 END,
       c_custkey % 29 = 0
FROM $customer
UNION ALL
SELECT CAST(doc_id * 3 + 2 AS BIGINT), source || '-' || lang || '_' || CAST(doc_id AS STRING) || '.pdf',
       '20260103_' || CAST(doc_id AS STRING) || '.pdf', 'Other',
       CAST('2002-03-' || lpad(CAST(doc_id % 28 + 1 AS STRING), 2, '0') || ' 12:00:00' AS $ts),
       NULL, NULL, NULL, substr(text, 1, 1500), $sha_open text $sha_close, n_chars,
       'Processed', '{}', NULL, 'New', NULL, FALSE
FROM $documents
"""

# Change requests and audit rows on documents, from the event log; some requests name
# no stored document.
WF_EVENTS = """
SELECT CASE WHEN event_id % 97 = 5 THEN 5000000000 + user_id ELSE user_id END AS document_id, event_id AS seq,
       CASE event_type WHEN 'view' THEN 'Processing' WHEN 'click' THEN 'Needs Review'
            WHEN 'purchase' THEN 'Approved' WHEN 'error' THEN 'Rejected'
            ELSE CASE WHEN value < 4 THEN 'Completed' ELSE 'New' END END AS requested_state
FROM $events
"""

AUDIT_ROWS = """
SELECT event_id AS id, user_id AS document_id,
       CASE event_type WHEN 'view' THEN 'processing_started' WHEN 'click' THEN 'sent_to_review'
            WHEN 'purchase' THEN 'reviewer_approved' WHEN 'error' THEN 'reviewer_rejected'
            ELSE 'workflow_completed' END AS action,
       CASE event_type WHEN 'view' THEN 'New' WHEN 'click' THEN 'Processing'
            WHEN 'purchase' THEN 'Needs Review' WHEN 'error' THEN 'Needs Review'
            ELSE 'Approved' END AS previous_status,
       CASE event_type WHEN 'view' THEN 'Processing' WHEN 'click' THEN 'Needs Review'
            WHEN 'purchase' THEN 'Approved' WHEN 'error' THEN 'Rejected'
            ELSE 'Completed' END AS new_status,
       ts, CASE WHEN event_type = 'view' THEN NULL ELSE props END AS reason
FROM $events
"""

# Documents to run through the workflow: with repeats and with unknown ids.
BATCH_IDS = """
SELECT o_orderkey AS pos,
       CASE o_orderkey % 5 WHEN 0 THEN o_custkey * 3 + 1
            WHEN 1 THEN 3000000000 + o_orderkey
            ELSE (o_orderkey - o_orderkey % 2) * 3 END AS document_id,
       CASE WHEN o_orderkey % 6 = 0 THEN CAST(o_custkey % 100 AS DOUBLE) / 100 ELSE NULL END AS given_confidence
FROM $orders
"""

# Review decisions, some without a reason, some that are none.
DECISIONS = """
SELECT o_orderkey AS seq,
       CASE WHEN o_orderkey % 4 = 0 THEN o_custkey * 3 + 1 ELSE (o_orderkey - o_orderkey % 3) * 3 END AS document_id,
       CASE WHEN o_orderkey % 11 = 3 THEN NULL WHEN o_orderkey % 13 = 4 THEN 'postpone'
            ELSE CASE o_orderpriority WHEN '1-URGENT' THEN 'approve' WHEN '2-HIGH' THEN 'reject'
            WHEN '3-MEDIUM' THEN 'complete' WHEN '5-LOW' THEN 'resubmit' ELSE 'approve' END END AS decision,
       CASE o_orderkey % 3 WHEN 0 THEN '  ' WHEN 1 THEN ' checked by hand ' ELSE NULL END AS note
FROM $orders
"""

CORPORA = {
    "docs_raw": DOCS_RAW,
    "landed": LANDED.replace("$docs_raw", DOCS_RAW.strip()),
    "stored_docs": STORED_DOCS,
    "wf_events": WF_EVENTS,
    "audit_rows": AUDIT_ROWS,
    "batch_ids": BATCH_IDS,
    "decisions": DECISIONS,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_rendered: dict[tuple, str] = {}


def corpus(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A corpus over the tables of ``sf_dir``, as a scan.

    It is rendered once per application, into the shared scratch folder, so the
    queries read documents from a table as they would outside of tests.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _rendered:
        path = scratch_dir(spark, name)
        spread(_render(spark, sf_dir, name)).write.option("compression", "zstd").parquet(path)
        _rendered[key] = path
    return spark.read.parquet(_rendered[key])


def _render(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tag = hashlib.sha256(sf_dir.encode()).hexdigest()[:8]
    template = Template(CORPORA[name])
    views = {}
    for source in TABLES:
        if f"${source}\n" in CORPORA[name] + "\n":
            views[source] = f"ledgerleaf_{source}_{tag}"
            table(spark, sf_dir, source).createOrReplaceTempView(views[source])
    return spark.sql(template.substitute(SPARK, **views))


def corpus_sql(name: str) -> str:
    """The same corpus as SQL for the check tool."""
    return Template(CORPORA[name]).substitute(DUCKDB, **{t: t for t in TABLES}).strip()


def with_corpora(*names: str) -> str:
    """``WITH`` clause naming the given corpora, left open for more entries."""
    parts = [f"{name} AS (\n{textwrap.indent(corpus_sql(name), '  ')}\n)" for name in names]
    return "WITH RECURSIVE " + ",\n".join(parts)
