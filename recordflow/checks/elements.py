"""Records of any form: their order, their frames, and all that lies inside them."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordflow.checks.registry import query
from recordflow.checks.steps import TARGET, TRANSFORMED, _escaped, ship_schema, transformed
from recordflow.functions import text
from recordflow.operators import route
from recordflow.operators.project import spread
from recordflow.plans import bindings, steps
from recordflow.session import task_count

#: The order of elements that the schema wants.
RANKS = {name.split()[0]: rank for rank, name in enumerate(TARGET.split(", "))}

# A record with its elements in three orders, a name twice, unknown names, and one in a namespace.
MIXED = """'<record xmlns:x="urn:x">' || CASE doc_id % 3 WHEN 0 THEN title || about || extra WHEN 1 THEN extra || ' <!-- c --> ' || title || about
  ELSE about || title || extra END || chr(10) || '</record>'"""
MIXED_PARTS = f"""SELECT *, '<about>' || doc_id || '</about>' AS about,
  '<x:title>' || {_escaped("split_part(text, chr(10), 1)")} || '</x:title><title>' || source || '</title>' AS title,
  '<zeta/><alpha><title>inner</title></alpha>' AS extra FROM documents"""


def mixed_records(tables):
    about = F.concat(F.lit("<about>"), F.col("doc_id").cast("string"), F.lit("</about>"))
    title = F.concat(
        F.lit("<x:title>"), text.xml_escape(F.split_part("text", F.lit("\n"), F.lit(1))), F.lit("</x:title><title>"),
        F.col("source"), F.lit("</title>"))
    extra = F.lit("<zeta/><alpha><title>inner</title></alpha>")
    turn = F.col("doc_id") % 3
    body = F.when(turn == 0, F.concat(title, about, extra)).when(
        turn == 1, F.concat(extra, F.lit(" <!-- c --> "), title, about)).otherwise(F.concat(about, title, extra))
    return bindings.document_records(tables, "doc_id", "text", "source").withColumn(
        "record_data", F.concat(F.lit('<record xmlns:x="urn:x">'), body, F.lit("\n</record>")))


@query("canonical_elements", f"""
SELECT record_id, CASE WHEN length(checked) % 2 = 0 THEN '' ELSE {MIXED} END AS record_data, CASE WHEN length(checked) % 2 = 0 THEN 'even' END AS exception
FROM (SELECT *, doc_id :: varchar AS record_id, '<record xmlns:x="urn:x">' || about || title
        || '<alpha><title>inner</title></alpha><zeta/></record>' AS checked
      FROM ({MIXED_PARTS}))""")
def _(tables):
    """Rules see elements in canonical order, whatever order they came in; what is stored is what came."""
    rules = {"even": F.length("checked_text") % 2 == 1}
    step = steps.external_validation(rules, ranks=RANKS)
    return step.run(mixed_records(tables), "E1").select("record_id", "record_data", "exception")


SWAPPED = r"regexp_replace(record_data, '^<record>(<about>[^<]*</about>)(.*)</record>$', '<record>\2\1</record>', 's')"


@query("workflow_xsd", f"""
WITH swapped AS (SELECT *, {SWAPPED} AS other FROM ({TRANSFORMED}) WHERE exception IS NULL)
SELECT n, record_id, CASE WHEN bad THEN '' ELSE other END AS record_data,
       CASE WHEN bad THEN 'record does not fit the schema' END AS exception
FROM (SELECT *, 1 AS n, true AS bad FROM swapped UNION ALL SELECT *, 2 AS n, lang = 'es' AS bad FROM swapped
      UNION ALL SELECT *, 3 AS n, lang = 'es' AS bad FROM swapped)""")
def _(tables):
    """A schema that wants an order, without and with canonical order, in both validation steps."""
    body = r"(?s)^<record>(<about>[^<]*</about>)(.*)</record>$"
    swapped = route.good_records(transformed(tables)).withColumn(
        "record_data", F.regexp_replace("record_data", body, "<record>$2$1</record>"))
    fits = steps.Schema(ship_schema(tables.spark), TARGET)
    runs = [steps.external_validation({}, schema_=fits), steps.external_validation({}, RANKS, fits),
            steps.internal_validation({}, RANKS, fits)]
    return bindings.union(*[
        step.run(swapped, f"E{n}").select(F.lit(n).alias("n"), "record_id", "record_data", "exception")
        for n, step in enumerate(runs, 1)])


HEAD = "'<?xml version=\"1.0\"?><!-- ' || lang || ' --><x:RDF xmlns:x=\"urn:x\">' || chr(10) || ' <?keep <this> ?>'"
INNER = f"""'<note><note>' || {_escaped('source')} || '</note>  two  </note>' || chr(10) || '<x:note><![CDATA[<a>  ' || doc_id || ' ]]></x:note>between '"""


@query("workflow_all_elements", f"""
SELECT doc_id :: varchar AS record_id, {HEAD} || {INNER} || '<x:title a="1">' || source || ' of ' || lang || '</x:title><link>u' || doc_id % 5 || '</link>'
       || CASE WHEN doc_id % 5 < 3 THEN '<concept>L &amp; ' || doc_id % 5 || '</concept>' ELSE '' END
       || CASE WHEN doc_id % 5 = 1 THEN '<resource>u1 image/png 5</resource><mainThumbnail>true</mainThumbnail>'
               ELSE '<mainThumbnail>false</mainThumbnail>' END || '</x:RDF>' || chr(10) AS record_data
FROM documents WHERE doc_id % 5 < 3""")
def _(tables):
    """A root and elements in a namespace, elements in elements of one name, CDATA, instructions and text
    between elements go through normalization, enrichment and media as they are."""
    link = "'<link>u' || doc_id % 5 || '</link>'"
    records = tables.documents.select(
        F.lit("d").alias("dataset_id"), F.col("doc_id").cast("string").alias("record_id"),
        F.concat(F.expr(HEAD.replace("chr(10)", "char(10)")), F.expr(
            INNER.replace("chr(10)", "char(10)").replace(_escaped("source"), "source")),
            F.expr(f"'<x:title a=\"1\"> ' || source || '  of ' || lang || '</x:title><empty> </empty>' || {link} || {link} || '</x:RDF>' || char(10)"),
        ).alias("record_data"))
    entities = tables.region.where("r_regionkey < 3").select(
        F.concat(F.lit("u"), F.col("r_regionkey").cast("string")).alias("reference"),
        F.concat(F.lit("L & "), F.col("r_regionkey").cast("string")).alias("label"))
    metadata = tables.region.where("r_regionkey = 1").select(
        F.lit("u1").alias("resource"), F.lit("image/png").alias("mime"), F.lit(5).cast("bigint").alias("bytes"))
    done = records
    for n, step in enumerate((steps.normalization(), steps.enrichment(entities, lambda x: x), steps.media_step(metadata))):
        done = route.good_records(step.run(done, f"E{n}"))
    return done.select("record_id", "record_data")


@query("blanks_isolated", f"""
SELECT doc_id :: varchar AS record_id, CASE WHEN doc_id % 4 = 3 THEN '' ELSE '<record>'
         || CASE doc_id % 4 WHEN 0 THEN repeat(' ', 30000 + doc_id) WHEN 1 THEN repeat('<!---->', 5000) ELSE repeat('<b>', 300) || repeat('</b>', 300) END
         || '<title>' || doc_id || '</title></record>' END AS record_data,
       CASE WHEN doc_id % 4 = 3 THEN 'malformed record' END AS exception
FROM documents WHERE lang = 'en'""")
def _(tables):
    """Thousands of blanks, comments, nested and open tags in every record."""
    turn = F.col("doc_id") % 4
    some = F.when(turn == 0, F.repeat(F.lit(" "), (F.col("doc_id") + 30000).cast("int"))).when(
        turn == 1, F.repeat(F.lit("<!---->"), F.lit(5000))).when(
        turn == 2, F.concat(F.repeat(F.lit("<b>"), F.lit(300)), F.repeat(F.lit("</b>"), F.lit(300)))).otherwise(
        F.repeat(F.lit("<b>"), F.lit(30000)))
    # texts are made of the ids alone: what is dealt out is a number a row, and no task is left with all long texts
    documents = spread(tables.documents.where("lang = 'en'").select("doc_id"), task_count(tables.spark))
    records = documents.select(
        F.lit("d").alias("dataset_id"), F.col("doc_id").cast("string").alias("record_id"),
        F.concat(F.lit("<record>"), some, F.lit("<title> "), F.col("doc_id").cast("string"), F.lit(" </title></record>")).alias("record_data"))
    return steps.normalization().run(records, "E1").select("record_id", "record_data", "exception")


# A free-text date of every document, in a form by its id, and the range of years it stands for.
DATE_FORMS = """
SELECT doc_id, CASE doc_id % 14
  WHEN 0 THEN y :: varchar WHEN 1 THEN 'ca. ' || y WHEN 2 THEN '[' || y || '?]' WHEN 3 THEN y || '-' || (y + 5) WHEN 4 THEN 'between ' || y || ' and ' || (y + 7)
  WHEN 5 THEN '12.05.' || y WHEN 6 THEN y || '-05-12' WHEN 7 THEN (y // 10) || '0s' WHEN 8 THEN (c + 1) || 'th  century' WHEN 9 THEN 'second half of the ' || (c + 1) || 'th century'
  WHEN 10 THEN 'before ' || y WHEN 11 THEN 'after ' || y WHEN 12 THEN c || '..' ELSE 'room ' || y || ' of ' || lang END AS written,
 CASE doc_id % 14
  WHEN 0 THEN y :: varchar WHEN 1 THEN y || '~' WHEN 2 THEN y || '~' WHEN 3 THEN y || '/' || (y + 5) WHEN 4 THEN y || '/' || (y + 7)
  WHEN 5 THEN y :: varchar WHEN 6 THEN y :: varchar WHEN 7 THEN (y // 10) || '0/' || (y // 10) || '9' WHEN 8 THEN c || '01/' || (c + 1) || '00' WHEN 9 THEN c || '51/' || (c + 1) || '00'
  WHEN 10 THEN '../' || y WHEN 11 THEN y || '/..' WHEN 12 THEN c || '00/' || c || '99' ELSE 'room ' || y || ' of ' || lang END AS range
FROM (SELECT doc_id, lang, 1100 + doc_id % 850 AS y, (1100 + doc_id % 850) // 100 AS c FROM documents)"""


@query("normalize_date_ranges", f"""
SELECT doc_id :: varchar AS record_id, '<record><date>' || range || '</date><language>xx</language><issued when="1">' || range || '</issued></record>' AS record_data
FROM ({DATE_FORMS})""")
def _(tables):
    """Dates become ranges in the normalization step, by a table of codes and names of its own."""
    y, c, form = "1100 + doc_id % 850", "(1100 + doc_id % 850) div 100", F.col("doc_id") % 14
    texts = [
        f"string({y})", f"'ca. ' || ({y})", f"'[' || ({y}) || '?]'", f"({y}) || '-' || ({y} + 5)", f"'between ' || ({y}) || ' and ' || ({y} + 7)",
        f"'12.05.' || ({y})", f"({y}) || '-05-12'", f"(({y}) div 10) || '0s'", f"({c} + 1) || 'th  century'", f"'second half of the ' || ({c} + 1) || 'th century'",
        f"'before ' || ({y})", f"'after ' || ({y})", f"({c}) || '..'"]
    written = F.expr(f"'room ' || ({y}) || ' of ' || lang")
    for i, value in enumerate(texts):
        written = F.when(form == i, F.expr(value)).otherwise(written)
    records = tables.documents.select(
        F.lit("d").alias("dataset_id"), F.col("doc_id").cast("string").alias("record_id"), F.concat(
            F.lit("<record><date> "), written, F.lit(" </date><language>unknown</language><issued when=\"1\">"), written,
            F.lit("</issued></record>")).alias("record_data"))
    return steps.normalization(languages={"unknown": "xx"}).run(records, "E1").select("record_id", "record_data")
