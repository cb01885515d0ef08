"""Validation, transformation, normalization, enrichment and routing."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from recordflow import schema
from recordflow.checks.fragments import DOCUMENT_RECORDS, LABELLED, VALIDATED, VOCABULARY
from recordflow.checks.registry import query
from recordflow.checks.rules import MAPPING, external_rules, internal_rules, validated
from recordflow.functions import text
from recordflow.operators import enrich, normalize, progress, project, route, transform, validate
from recordflow.plans import bindings

SCHEMA_FILE = "record.xsd"
TARGET = ("about string, datasetName string, country string, language string, title string, "
          "size string, year string, line array<string>")


def ship_schema(spark) -> str:
    """Sends the XML schema to all executors and returns the name to use there."""
    spark.sparkContext.addFile(str(Path(__file__).parent.parent / "resources" / SCHEMA_FILE))
    return SCHEMA_FILE


@query("canonical_order", f"""
SELECT record_id, array_to_string(list_sort(string_split(record_data, chr(10))), chr(10))
         AS checked_text, record_data
FROM ({DOCUMENT_RECORDS})""")
def _(tables):
    return bindings.document_records(tables).select(
        "record_id", validate.canonical_text(F.col("record_data")).alias("checked_text"),
        "record_data")


@query("validate_external", VALIDATED)
def _(tables):
    return validated(tables)


@query("validate_internal", f"""
SELECT dataset_id, 'E2' AS execution_id, 'VALIDATION_INTERNAL' AS execution_name, record_id,
       CASE WHEN exception IS NULL THEN record_data ELSE '' END AS record_data, exception
FROM (SELECT *, nullif(concat_ws('; ',
        CASE WHEN list_max([length(l) FOR l IN lines]) > 2000
             THEN 'R4 line over 2000 characters' END,
        CASE WHEN len(list_distinct(lines)) <> len(lines) THEN 'R5 repeated line' END,
        CASE WHEN list_contains(lines, '') THEN 'R6 empty line' END), '') AS exception
      FROM (SELECT *, string_split(record_data, chr(10)) AS lines FROM ({DOCUMENT_RECORDS})))""")
def _(tables):
    return validate.validate(bindings.document_records(tables), schema.VALIDATION_INTERNAL,
                             internal_rules(), "E2")


@query("route_ok", f"SELECT * EXCLUDE (exception) FROM ({VALIDATED}) WHERE exception IS NULL")
def _(tables):
    return route.good_records(validated(tables))


@query("route_err", f"""
SELECT * EXCLUDE (record_data) FROM ({VALIDATED}) WHERE exception IS NOT NULL""")
def _(tables):
    return route.bad_records(validated(tables))


@query("progress_report", f"""
SELECT dataset_id, 'E1' AS execution_id, count(*) AS source_total,
       count(CASE WHEN exception IS NULL THEN 1 END) AS success,
       count(CASE WHEN exception IS NOT NULL THEN 1 END) AS exceptions,
       count(*) AS processed
FROM ({VALIDATED}) GROUP BY 1""")
def progress_of_validation(tables):
    results = validated(tables)
    return progress.progress_report(
        bindings.document_records(tables), route.good_records(results),
        route.bad_records(results), {"E1": bindings.HARVEST_ID})


def _escaped(value: str) -> str:
    return f"replace(replace(replace({value}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


TRANSFORMED = rf"""
SELECT dataset_id, lang, record_id, toxic, exception, first_line, CASE WHEN exception IS NULL THEN
  '<record><about>' || record_id || '</about><datasetName>name of ' || dataset_id
  || '</datasetName><country>Nowhere</country><language>' || lang || '</language><title>'
  || {_escaped('first_line')} || '</title><size>' || length(record_data) || '</size><year>'
  || coalesce(nullif(regexp_extract(record_data, '\b(1[0-9]{{3}}|20[0-9]{{2}})\b', 1), ''),
              'unknown')
  || '</year>' || array_to_string(
       ['<line>' || {_escaped('l')} || '</line>' FOR l IN string_split(record_data, chr(10))], '')
  || '</record>' ELSE '' END AS record_data
FROM (SELECT *, CASE WHEN NOT regexp_matches(first_line, '[^ \t\n\r]')
             THEN 'no value for title' END AS exception
      FROM (SELECT r.*, toxic, string_split(record_data, chr(10))[1] AS first_line
            FROM ({DOCUMENT_RECORDS}) r
            JOIN (SELECT CAST(doc_id AS VARCHAR) AS record_id, toxic FROM ({LABELLED}))
              USING (record_id)))"""


def transformed(tables):
    records = bindings.document_records(tables, "lang")
    return transform.transform(
        records, MAPPING, dataset_name=F.concat(F.lit("name of "), "dataset_id"),
        country="Nowhere", language=F.col("lang"), execution_id="E2")


@query("transform_mapping", f"""
SELECT dataset_id, 'E2' AS execution_id, 'TRANSFORMATION' AS execution_name, record_id,
       record_data, exception FROM ({TRANSFORMED})""")
def _(tables):
    return transformed(tables)


@query("validate_schema", f"""
SELECT dataset_id, 'E3' AS execution_id, 'VALIDATION_INTERNAL' AS execution_name, record_id,
       CASE WHEN lang = 'es' THEN '' ELSE record_data END AS record_data,
       CASE WHEN lang = 'es' THEN 'record does not fit the schema' END AS exception
FROM ({TRANSFORMED}) WHERE exception IS NULL""")
def _(tables):
    return validate.validate_schema(
        route.good_records(transformed(tables)), schema.VALIDATION_INTERNAL, TARGET,
        ship_schema(tables.spark), "E3")


@query("malformed_isolated", f"""
SELECT dataset_id, 'E3' AS execution_id, 'VALIDATION_INTERNAL' AS execution_name, record_id,
       CASE WHEN toxic = 1 THEN '' ELSE first_line END AS record_data,
       CASE WHEN toxic = 1 THEN 'malformed record' END AS exception
FROM ({TRANSFORMED}) WHERE exception IS NULL""")
def _(tables):
    end = len("</record>")
    toxic = bindings.labelled(tables).select(
        F.col("doc_id").cast("string").alias("record_id"), "toxic")
    data = F.col("record_data")
    broken = route.good_records(transformed(tables)).join(toxic, "record_id").withColumn(
        "record_data", F.when(F.col("toxic") == 1, F.left(data, F.length(data) - F.lit(end)))
        .otherwise(data))
    parsed = broken.withColumn("xml", text.parse_xml(data, TARGET))
    return project.step_result(
        parsed, "E3", schema.VALIDATION_INTERNAL, F.col("xml.title"),
        F.when(F.col("xml.malformed").isNotNull(), F.lit("malformed record")))


@query("normalize_text", r"""
SELECT doc_id, trim(regexp_replace(text, '[ \t\n\r]+', ' ', 'g')) AS clean_text FROM documents""")
def _(tables):
    return tables.documents.select(
        "doc_id", text.collapse_spaces(F.col("text")).alias("clean_text"))


CLEAN_LINES = rf"""
SELECT dataset_id, record_id, string_agg(line, chr(10) ORDER BY place) AS clean_text
FROM (SELECT dataset_id, record_id, line, min(place) AS place
      FROM (SELECT dataset_id, record_id, i AS place,
                   trim(regexp_replace(lines[i], '[ \t\n\r]+', ' ', 'g')) AS line
            FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS i
                  FROM (SELECT *, string_split(record_data, chr(10)) AS lines
                        FROM ({DOCUMENT_RECORDS}))))
      WHERE line <> '' GROUP BY 1, 2, 3)
GROUP BY 1, 2"""


@query("normalize_statements", f"""
SELECT dataset_id, 'E4' AS execution_id, 'NORMALIZATION' AS execution_name, record_id,
       coalesce(clean_text, '') AS record_data,
       CASE WHEN clean_text IS NULL THEN 'nothing left after normalization' END AS exception
FROM ({DOCUMENT_RECORDS}) LEFT JOIN ({CLEAN_LINES}) USING (dataset_id, record_id)""")
def _(tables):
    return normalize.normalize(bindings.document_records(tables), "E4")


@query("normalize_language", """
SELECT doc_id, CASE lang WHEN 'en' THEN 'en' WHEN 'fr' THEN 'fr' WHEN 'de' THEN 'de'
       WHEN 'es' THEN 'spanish' ELSE lang END AS language
FROM documents""")
def _(tables):
    given = (F.when(F.col("lang") == "en", "ENG ").when(F.col("lang") == "fr", "fre")
             .when(F.col("lang") == "de", "ger").when(F.col("lang") == "es", " Spanish")
             .otherwise(F.col("lang")))
    return tables.documents.select("doc_id", text.language_code(given).alias("language"))


@query("normalize_dates", r"""
SELECT doc_id, CAST(nullif(regexp_extract(text, '\b(1[0-9]{3}|20[0-9]{2})\b', 1), '') AS INTEGER)
         AS year FROM documents""")
def _(tables):
    return tables.documents.select("doc_id", text.year_of(F.col("text")).alias("year"))


@query("enrich_reference", """
SELECT CAST(o_orderkey AS VARCHAR) AS record_id, o_custkey AS reference, label,
       label IS NOT NULL AS resolved
FROM orders LEFT JOIN (
  SELECT c_custkey, c_name || ', ' || n_name AS label
  FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_acctbal >= 0
) ON c_custkey = o_custkey""")
def _(tables):
    entities = tables.customer.where("c_acctbal >= 0").join(
        tables.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("reference"),
        F.concat_ws(", ", "c_name", "n_name").alias("label"))
    references = tables.orders.select(
        F.col("o_orderkey").cast("string").alias("record_id"),
        F.col("o_custkey").alias("reference"))
    return enrich.lookup_references(references, entities)


PART_LINKS = """
SELECT CAST(l_orderkey AS VARCHAR) AS record_id, l_partkey AS reference,
       count(*) AS "references", min(p_name) AS label, min(p_name) IS NOT NULL AS resolved
FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size <= 45) ON p_partkey = l_partkey
GROUP BY 1, 2"""


@query("enrich_entities", PART_LINKS)
def _(tables):
    return enrich.enrich_entities(bindings.part_references(tables), bindings.part_entities(tables))


@query("enrich_report", f"""
SELECT record_id, found, not_found,
       CASE WHEN not_found > 0 THEN 'STOP' ELSE 'CONTINUE' END AS status,
       CASE WHEN not_found > 0 THEN not_found || ' of ' || (found + not_found)
            || ' references not found' END AS exception
FROM (SELECT record_id,
             CAST(coalesce(sum("references") FILTER (WHERE resolved), 0) AS BIGINT) AS found,
             CAST(coalesce(sum("references") FILTER (WHERE NOT resolved), 0) AS BIGINT)
               AS not_found
      FROM ({PART_LINKS}) GROUP BY 1)""")
def _(tables):
    return enrich.enrich_report(bindings.part_references(tables), bindings.part_entities(tables))


LINE_STARTS = r"""
SELECT dataset_id, record_id, reference, min(place) AS place
FROM (SELECT dataset_id, record_id, i AS place,
             lower(string_split(trim(regexp_replace(lines[i], '[ \t\n\r]+', ' ', 'g')), ' ')[1])
               AS reference
      FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS i
            FROM (SELECT *, string_split(record_data, chr(10)) AS lines FROM ({records}))))
WHERE reference <> '' GROUP BY 1, 2, 3"""


@query("enrich_record", f"""
SELECT dataset_id, 'E5' AS execution_id, 'ENRICHMENT' AS execution_name, record_id,
       CASE WHEN stopped THEN '' ELSE record_data || chr(10) || coalesce(labels, '') END
         AS record_data,
       CASE WHEN stopped THEN reports END AS exception
FROM (SELECT dataset_id, record_id, record_data, labels, reports,
             reports IS NOT NULL AND labels IS NULL AS stopped
      FROM ({DOCUMENT_RECORDS}) LEFT JOIN (
        SELECT dataset_id, record_id,
               string_agg(label, ' ' ORDER BY place) AS labels,
               string_agg(CASE WHEN label IS NULL THEN 'not found: ' || reference END,
                          chr(10) ORDER BY place) AS reports
        FROM ({LINE_STARTS.format(records=DOCUMENT_RECORDS)})
        LEFT JOIN ({VOCABULARY}) USING (reference)
        GROUP BY 1, 2) USING (dataset_id, record_id))""")
def _(tables):
    starts = F.transform(text.distinct_lines(F.col("record_data")),
                         lambda line: F.lower(F.substring_index(line, " ", 1)))
    return enrich.enrich(
        bindings.document_records(tables), F.array_distinct(starts), bindings.vocabulary(tables),
        F.concat(F.col("record_data"), F.lit("\n"), F.array_join("labels", " ")),
        "E5", tolerate=True)
