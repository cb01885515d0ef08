"""SQL pieces that several checks share."""

DOCUMENT_RECORDS = """
SELECT source AS dataset_id, 'E0' AS execution_id, 'OAI_HARVEST' AS execution_name,
       CAST(doc_id AS VARCHAR) AS record_id, text AS record_data, lang
FROM documents"""

TURN_RECORDS = """
SELECT 'turns_' || role AS dataset_id, 'E1' AS execution_id, 'OAI_HARVEST' AS execution_name,
       conv_id || '/' || turn AS record_id, text AS record_data
FROM conversations"""

PAGE_RECORDS = r"""
SELECT regexp_extract(url, 'example\.([a-z]+)', 1) AS dataset_id, 'E0' AS execution_id,
       'OAI_HARVEST' AS execution_name, CAST(page_id AS VARCHAR) AS record_id,
       html AS record_data
FROM pages"""

LABELLED = """
SELECT d.*, coalesce(l.quality, 0) AS quality, coalesce(l.toxic, 0) AS toxic
FROM documents d LEFT JOIN labels l USING (doc_id)"""

VALIDATED = f"""
SELECT dataset_id, 'E1' AS execution_id, 'VALIDATION_EXTERNAL' AS execution_name, record_id,
       CASE WHEN exception IS NULL THEN record_data ELSE '' END AS record_data, exception
FROM (SELECT *, nullif(concat_ws('; ',
        CASE WHEN length(record_data) < 100 THEN 'R1 shorter than 100 characters' END,
        CASE WHEN NOT contains(record_data, chr(10)) THEN 'R2 one line only' END,
        CASE WHEN lang NOT IN ('en', 'fr', 'de') THEN 'R3 language not supported' END
      ), '') AS exception
      FROM ({DOCUMENT_RECORDS}))"""

HEADERS = f"""
SELECT printf('doc:%08d', doc_id) AS identifier, toxic = 1 AS deleted,
       1700000000 + doc_id * 60 AS listed_at
FROM ({LABELLED})"""

MESSAGES = """
SELECT ts, event_id, user_id AS task_id,
       'http://repository.test/records/R' || event_id || '/representations/' || event_type
         || '/versions/V' || json_extract_string(props, '$.k') AS record_id,
       event_type = 'signup' AS marked_as_deleted
FROM events"""

MESSAGE_PARTS = rf"""
SELECT *, regexp_extract(record_id, '/records/([^/?#]+)', 1) AS cloud_id,
       regexp_extract(record_id, '/representations/([^/?#]+)', 1) AS representation_name,
       regexp_extract(record_id, '/versions/([^/?#]+)', 1) AS representation_version
FROM ({MESSAGES})"""

TASK_PARAMS = """
SELECT s_suppkey AS task_id, s_suppkey * 1000000 AS sent_micros,
       CASE WHEN s_acctbal >= 1000 THEN 'application/xml' END AS output_mime_type,
       'provider' || s_nationkey AS provider_id, 'set' || s_suppkey AS task_dataset_id,
       'normalized' AS new_representation_name, s_name AS revision_provider_id,
       'NORMALIZED' AS revision_name
FROM supplier"""

WRITTEN = f"""
SELECT *, CASE WHEN NOT marked_as_deleted THEN 'http://repository.test/records/' || cloud_id
         || '/representations/' || new_representation_name || '/versions/' || new_version END
         AS new_resource_url
FROM (SELECT m.*, p.* EXCLUDE (task_id), CASE WHEN NOT marked_as_deleted THEN
        sha256(sent_micros || '|' || record_id) END AS new_version,
        CASE WHEN provider_id IS NULL THEN 'no parameters for task ' || m.task_id END AS exception
      FROM ({MESSAGE_PARTS}) m LEFT JOIN ({TASK_PARAMS}) p USING (task_id))"""

ITEMS = """
SELECT user_id AS task_id, ts, event_id, CASE WHEN event_type = 'error' THEN 'STOP'
       ELSE 'CONTINUE' END AS status, event_type = 'signup' AS deleted,
       event_type = 'view' AS ignored, event_type = 'error' AS failed
FROM events"""

PAGE_LINKS = """
SELECT dataset_id, record_id, i - 1 AS place, links[i] AS resource
FROM (SELECT *, unnest(range(1, len(links) + 1)) AS i
      FROM (SELECT *, regexp_extract_all(record_data, '<a href="([^"]*)"', 1) AS links
            FROM ({records})))"""


def words(table: str) -> str:
    return (f"SELECT * FROM (SELECT unnest(string_split(trim(regexp_replace(text, "
            f"'[ \\t\\n\\r]+', ' ', 'g')), ' ')) AS word FROM {table}) WHERE word <> ''")


VOCABULARY = f"""
SELECT lower(word) AS reference, min(word) AS label FROM ({words('benchmark')}) GROUP BY 1"""

RESOURCE_METADATA = f"""
SELECT '/' || word AS resource, CASE WHEN length(word) > 3 THEN 'text/html'
       ELSE 'image/jpeg' END AS mime, count(*) AS bytes
FROM ({words('conversations')}) GROUP BY word"""


def looked_up_links(records: str = PAGE_RECORDS) -> str:
    return (f"SELECT l.*, m.mime, m.bytes, m.resource IS NOT NULL AS extracted "
            f"FROM ({PAGE_LINKS.format(records=records)}) l "
            f"LEFT JOIN ({RESOURCE_METADATA}) m USING (resource)")


MEDIA_TOTALS = f"""
SELECT p.dataset_id, p.record_id, count(CASE WHEN extracted THEN 1 END) AS extracted,
       count(CASE WHEN NOT extracted THEN 1 END) AS failed,
       CAST(coalesce(sum(bytes), 0) AS BIGINT) AS bytes,
       coalesce(bool_or(extracted AND place = 0), false) AS has_main_thumbnail
FROM ({PAGE_RECORDS}) p LEFT JOIN ({looked_up_links()}) l USING (dataset_id, record_id)
GROUP BY 1, 2"""

TIERS = f"""
SELECT *, CASE WHEN extracted = 0 THEN 'T0' WHEN has_main_thumbnail AND extracted > 3 THEN 'T3'
       WHEN has_main_thumbnail THEN 'T2' ELSE 'T1' END AS tier
FROM ({MEDIA_TOTALS})"""
