"""XML records, files, landed pages and hand-made cases."""

from __future__ import annotations

from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from recordflow import schema
from recordflow.checks.steps import TARGET, ship_schema
from recordflow.functions import text
from recordflow.operators import enrich, harvest, index, media, progress, route, transform, validate
from recordflow.plans import record_xml, steps
from recordflow.sources import landed, messages, store

# An invented weather log in two namespaces.
SAMPLE = """<w:log xmlns:w="urn:weather" xmlns:p="urn:place">
  <p:station p:code="/hill/7" w:high="411"/>
  <w:entry><w:when>spring of 1874, in the morning</w:when><w:note w:tongue="fra">vent  du nord</w:note><w:seen w:what="rain"/><w:seen w:what="hail"/><w:seen w:what="fog"/></w:entry>
</w:log>"""


def records(spark, *items):
    return spark.createDataFrame(
        [("d1", "e0", "OAI_HARVEST", i, d) for i, d in items], schema.EXECUTION_RECORD)


def test_malformed_xml_beside_good_xml(spark):
    good = "<record><title>A &amp; B</title><link>x</link><link>y</link></record>"
    cases = [("1", good), ("2", "<record><title>"), ("3", ""), ("4", None), ("5", "plain"),
             ("6", "<record><title>&nope;</title></record>")]
    parsed = record_xml.with_parsed(records(spark, *cases)).select(
        "record_id", record_xml.malformed().alias("error"), "xml.title", "xml.link")
    assert rows(parsed) == [
        ("1", None, "A & B", ["x", "y"]),
        *[(i, "malformed record", None, None) for i in "23456"]]


def test_values_of_a_namespaced_record(spark):
    fields = ("station struct<_code: string, _high: int>, entry struct<when: string, "
              "note: struct<_VALUE: string, _tongue: string>, seen: array<struct<_what: string>>>")
    frame = records(spark, ("1", SAMPLE))
    plain = F.regexp_replace("record_data", "(</?|\\s)[a-z]+:(?=[A-Za-z]+)", "$1")
    xml = text.parse_xml(plain, fields)
    out = frame.select(
        xml["station"]["_code"], xml["station"]["_high"], text.year_of(xml["entry"]["when"]),
        text.language_code(xml["entry"]["note"]["_tongue"]),
        F.size(xml["entry"]["seen"]), xml["malformed"])
    assert [tuple(r) for r in out.collect()] == [("/hill/7", 411, 1874, "fr", 3, None)]


def test_xsd_invalid_record(spark):
    good = ("<record><about>a</about><datasetName>n</datasetName><country>c</country>"
            "<language>de</language><title>t</title><size>1</size><year>unknown</year></record>")
    frame = records(spark, ("1", good), ("2", good.replace(">de<", ">xx<")), ("3", "<record>"))
    out = validate.validate_schema(
        frame, schema.VALIDATION_EXTERNAL, TARGET, ship_schema(spark), "e1")
    assert rows(out, "record_id", "record_data", "exception") == [
        ("1", good, None),
        ("2", "", "record does not fit the schema"),
        ("3", "", "record does not fit the schema")]


def test_checks_see_the_canonical_order_and_data_stay(spark):
    shuffled = ("<record><year>unknown</year><size>1</size><about>a</about><title>t</title>"
                "<country>c</country><datasetName>n</datasetName><language>de</language></record>")
    frame = records(spark, ("1", shuffled))
    given = (schema.VALIDATION_EXTERNAL, TARGET, ship_schema(spark), "e1")
    assert validate.validate_schema(frame, *given).first()["exception"] is not None
    parsed = frame.withColumn("xml", text.parse_xml(F.col("record_data"), TARGET))
    ordered = transform.mapped_record(
        [transform.Rule(n, f"xml.{n}") for n in ("title", "size", "year")],
        {n: F.col(f"xml.{n}") for n in ("about", "datasetName", "country", "language")})
    out = validate.validate_schema(parsed, *given, reorder=ordered).first()
    assert (out["record_data"], out["exception"]) == (shuffled, None)
    lines = validate.validate(
        records(spark, ("1", "b\na")), schema.VALIDATION_INTERNAL,
        {"a first": F.startswith("checked_text", F.lit("a"))}, "e1",
        validate.canonical_text(F.col("record_data"))).first()
    assert (lines["record_data"], lines["exception"]) == ("b\na", None)


def test_keyed_state_reads(spark):
    tasks = spark.createDataFrame([(1, 2, 3)], schema.TASK_INFO)
    assert rows(store.find_task(tasks, 1)) == [(1, 2, 3)]
    assert store.find_task(tasks, 9).count() == 0
    state = spark.createDataFrame([("d", "e", 5, "x")], schema.ITERATION_STATE)
    assert rows(store.find_iteration_state(state, "d", "e"), "last_identifier") == [("x",)]
    assert store.find_iteration_state(state, "d", "f").count() == 0


def test_unknown_profile_is_refused_before_any_plan(spark):
    with pytest.raises(ValueError):
        validate.validate(records(spark), "OTHER", {}, "e1")


def test_rule_that_gives_null_is_broken(spark):
    out = validate.validate(
        records(spark, ("1", None), ("2", "abc")), schema.VALIDATION_EXTERNAL,
        {"short": F.length("record_data") > 2}, "e1")
    assert rows(out, "record_id", "exception") == [("1", "short"), ("2", None)]


def test_harvest_cases(spark):
    headers = spark.createDataFrame(
        [("a", False), ("b", False), ("c", True), (None, False), ("d", False)],
        "identifier string, deleted boolean").withColumn(
        "datestamp", F.timestamp_seconds(F.lit(0)))
    content = spark.createDataFrame([("a", "text"), ("d", None)], "identifier string, content string")
    out = harvest.harvest_content(harvest.not_deleted(headers), content)
    assert rows(out, "external_id", "content", "exception") == [
        ("a", "text", None), ("b", "", "no record for b"), ("d", "", "no content for d"),
        (None, "", "header has no identifier")]
    assigned = harvest.assign_id(out, F.lit("d1"), F.col("external_id"), "e0")
    assert rows(assigned, "record_id", "exception") == [
        ("/d1/a", None), ("/oaiIdentifier/", "header has no identifier"),
        ("/oaiIdentifier/b", "no record for b"),
        ("/oaiIdentifier/d", "no content for d")]


def test_two_ids_that_become_one_are_reported(spark):
    harvested = spark.createDataFrame(
        [("a:b", "x"), ("a.b", "y"), ("c", "z")], "external_id string, content string").withColumn(
        "exception", F.lit(None).cast("string"))
    out = harvest.assign_id(harvested, F.lit("d1"), F.col("external_id"), "e0")
    assert rows(harvest.id_collisions(out)) == [("d1", "/d1/a_b", 2)]


def test_error_without_a_message_keeps_its_kind(spark):
    frame = spark.createDataFrame([("x",), ("",), (None,)], "m string")
    out = frame.select(route.error_text(F.col("m"), "TimeoutError").alias("e"))
    assert rows(out) == [("TimeoutError",), ("TimeoutError",), ("x",)]


def test_required_element_without_value(spark):
    rules = [transform.Rule("title", "nullif(record_data, '')", required=True),
             transform.Rule("kind", "cast(null as string)", default="none"),
             transform.Rule("part", "split(record_data, ',')", many=True)]
    frame = records(spark, ("1", "a<,b"), ("2", ""))
    out = transform.transform(frame, rules, dataset_name="n", country="c", language="de",
                              execution_id="e1")
    assert rows(out, "record_id", "record_data", "exception") == [
        ("1", "<record><about>1</about><datasetName>n</datasetName><country>c</country>"
              "<language>de</language><title>a&lt;,b</title><kind>none</kind>"
              "<part>a&lt;</part><part>b</part></record>", None),
        ("2", "", "no value for title")]
    blank = frame.withColumn("dataset_id", F.lit(" "))
    assert "<about>" not in transform.transform(
        blank, rules, dataset_name="n", country="c", language="de",
        execution_id="e1").first()["record_data"]


def test_enrichment_stops_with_one_report_line_each(spark):
    entities = spark.createDataFrame([("a", "Label A")], "reference string, label string")
    frame = records(spark, ("1", "a"), ("2", "a b c"), ("3", ""))
    refs = F.filter(F.split("record_data", " "), lambda r: r != "")
    data = F.concat_ws("|", "record_data", F.array_join("labels", ","))
    strict = enrich.enrich(frame, refs, entities, data, "e1")
    assert rows(strict, "record_id", "record_data", "exception") == [
        ("1", "a|Label A", None), ("2", "", "not found: b\nnot found: c"), ("3", "|", None)]
    tolerant = enrich.enrich(frame, refs, entities, data, "e1", tolerate=True)
    assert rows(tolerant, "record_id", "record_data") == [
        ("1", "a|Label A"), ("2", "a b c|Label A"), ("3", "|")]


def test_hot_reference_and_hot_record(spark):
    hot = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("record_id"),
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("reference"))
    entities = spark.createDataFrame([(1, "one")], "reference bigint, label string")
    report = {r["record_id"]: (r["found"], r["not_found"], r["status"])
              for r in enrich.enrich_report(hot, entities).collect()}
    assert report["hot"] == (1000, 1000, "STOP")
    assert report["2"] == (1, 0, "CONTINUE")
    assert len(report) == 4001


def test_unknown_task_and_default_mime_type(spark):
    items = spark.createDataFrame([(1, "u"), (2, "v")], "task_id bigint, record_id string")
    params = spark.createDataFrame([(1, None)], "task_id bigint, output_mime_type string")
    out = harvest.task_params_join(items, params)
    assert rows(out, "task_id", "output_mime_type", "exception") == [
        (1, "text/plain", None), (2, None, "no parameters for task 2")]


@pytest.mark.parametrize("line, kept", [
    ("1 name file", True), ("1 name", False), ("1 name file more", False),
    ("1 name file   ", True), ("1  name file", False), ("", False), ("a  b", True)])
def test_task_lines(spark, line, kept):
    frame = spark.createDataFrame([(line,)], "value string")
    assert messages.parse_task_lines(frame).count() == int(kept)


def test_broken_message_gives_nulls(spark):
    frame = spark.createDataFrame([('{"taskId": 3, "recordId": "r"}',), ("{",)], "value string")
    assert rows(messages.decode_messages(frame)) == [(3, "r", False), (None, None, False)]


def test_landed_files_and_pages(spark, folder):
    Path(folder, "files").mkdir()
    Path(folder, "files", "a.xml").write_text("<a>\n1\n</a>")
    Path(folder, "files", "b.xml").write_text("")
    found = landed.read_files(spark, f"{folder}/files").select(
        F.regexp_extract("file_url", "[^/]+$", 0), "content")
    assert ("a.xml", "<a>\n1\n</a>") in rows(found)
    Path(folder, "pages").mkdir()
    Path(folder, "pages", "1.xml").write_text(
        "<ListIdentifiers><header status='deleted'><identifier>x</identifier>"
        "<datestamp>2024-01-01T00:00:00Z</datestamp></header>"
        "<header><identifier>y</identifier><datestamp>2024-01-02</datestamp></header>"
        "</ListIdentifiers>")
    headers = landed.read_headers(spark, f"{folder}/pages")
    assert rows(headers, "identifier", "deleted", F.unix_seconds("datestamp")) == [
        ("x", True, 1704067200), ("y", False, 1704153600)]
    assert headers.schema.simpleString() == schema.HEADER.simpleString()


def test_count_of_nothing_is_zero(spark):
    assert progress.count_execution(records(spark), "d1", "e9").first()[0] == 0


def test_harvest_progress_uses_its_own_total(spark):
    done = records(spark, ("1", "a"), ("2", "b"))
    report = progress.progress_report(done, done, done.where("false"))
    assert rows(report) == [("d1", "e0", 2, 2, 0, 2)]


def test_progress_counts_errors_under_the_target(spark):
    source = records(spark, ("1", "a"), ("2", "b"))
    target = source.withColumn("execution_id", F.lit("e1"))
    report = progress.progress_report(
        source, target.where("record_id = '1'"), target.where("record_id = '2'"), {"e1": "e0"})
    assert rows(report) == [("d1", "e1", 2, 1, 1, 2)]


def test_media_of_records_without_links(spark):
    frame = records(spark, ("1", "a b"), ("2", ""), ("3", "c"))
    links = F.filter(F.split("record_data", " "), lambda link: link != "")
    metadata = spark.createDataFrame(
        [("a", "image/jpeg", 5), ("no link in 2", "x", 9)],
        "resource string, mime string, bytes bigint")
    assert rows(media.media_totals(frame, links, metadata)) == [
        ("d1", "1", 1, 1, 5, True), ("d1", "2", 0, 0, 0, False), ("d1", "3", 0, 1, 0, False)]
    main = media.main_resources(frame, links, metadata)
    assert rows(main, "record_id", "resource", "has_main_thumbnail") == [
        ("1", "a", True), ("2", None, False), ("3", "c", False)]
    enriched = media.enrich_media(
        frame, links, metadata, F.concat_ws("|", "record_data", F.size("resources")), "e1")
    assert rows(enriched, "record_id", "record_data") == [("1", "a b|2"), ("2", "|0"), ("3", "c|1")]


def test_publication_and_tiers(spark):
    frame = spark.createDataFrame(
        [(0, False), (1, False), (1, True), (4, True), (5, False)], "n int, main boolean")
    tiers = frame.select(index.media_tier(F.col("n"), F.col("main")).alias("t"))
    assert [r.t for r in tiers.collect()] == ["T0", "T1", "T2", "T3", "T1"]
    with pytest.raises(ValueError):
        index.publishable(F.col("t"), "OTHER")


def test_timestamps_are_kept_only_when_asked(spark):
    served = spark.createDataFrame([("1", "old")], "record_id string, updated string")
    new = spark.createDataFrame([("1",), ("2",)], "record_id string")
    kept = index.with_timestamps(new, served, F.lit("now"), preserve=True)
    assert rows(kept, "record_id", "updated") == [("1", "old"), ("2", "now")]
    fresh = index.with_timestamps(new, served, F.lit("now"), preserve=False)
    assert rows(fresh, "record_id", "updated") == [("1", "now"), ("2", "now")]


def test_redirects_give_one_target_per_old_record(spark):
    new = spark.createDataFrame([("n2", "x"), ("n1", "x"), ("n3", "y")], "record_id string, l string")
    old = spark.createDataFrame([("o1", "x"), ("o2", "x"), ("o3", "z")], "record_id string, l string")
    assert rows(index.redirects(new, old, "l")) == [("o1", "n1"), ("o2", "n1")]


def test_counter_going_backward(spark):
    frame = spark.createDataFrame(
        [("s", 1, 5), ("s", 2, 9), ("s", 3, 7), ("t", 1, 4)],
        "split_id string, checkpoint_id int, emitted_count int")
    assert rows(progress.progress_delta(frame, ["checkpoint_id"]), "split_id", "increase") == [
        ("s", -2), ("s", 4), ("s", 5), ("t", 4)]
    assert rows(progress.progress_violations(frame, ["checkpoint_id"]), "checkpoint_id") == [(3,)]


def test_bad_bytes_and_ids_stop_nothing(spark):
    from recordflow.functions import text
    from recordflow.sources.chunks import chunk_plan, read_chunks
    from recordflow.sources.messages import parse_cancelled_ids

    data = spark.createDataFrame([(bytearray(b"ok \xc3\xa9"),), (bytearray(b"bad \xff!"),), (None,)], "b binary")
    assert [r.t for r in data.select(text.utf8_text(F.col("b")).alias("t")).collect()] == ["ok é", "bad �!", None]
    ids = spark.createDataFrame([("7 x",), ("",), (" 8  9",)], "value string")
    assert rows(parse_cancelled_ids(ids)) == [("7",), ("8",), ("9",), ("x",)]
    messages = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c")], "task_id long, resource string")
    params = spark.createDataFrame([(1, None)], "task_id long, output_mime_type string")
    joined = harvest.task_params_join(messages, params)
    assert rows(joined, "resource", "output_mime_type", "exception") == [
        ("a", "text/plain", None), ("b", None, "no parameters for task without an id"), ("c", None, "no parameters for task 2")]
    stored = spark.createDataFrame([(d, "e", f"r{i}") for d in "ab" for i in range(6)], "dataset_id string, execution_id string, record_id string")
    plan = chunk_plan(stored.where("dataset_id = 'a'"), 2).where("chunk_id = 1")
    assert rows(read_chunks(stored, plan), "dataset_id", "record_id") == [("a", "r2"), ("a", "r3")]


def test_a_page_that_is_no_listing_fails_the_harvest(spark, folder):
    from pathlib import Path

    from recordflow.sources import landed
    good = '<ListRecords><record><header status = "deleted"><identifier>a&amp;b&#33;</identifier><setSpec>s:t</setSpec></header></record><error/></ListRecords>'
    Path(folder, "1.xml").write_text(good)
    Path(folder, "2.xml").write_text('<OAI-PMH><error code="noRecordsMatch">none</error></OAI-PMH>')
    got = landed.read_records(spark, folder, "s").collect()
    assert [(r.identifier, r.deleted, r.datestamp, r.sets, r.content) for r in got] == [("a&b!", True, None, ["s:t"], None)]
    assert landed.read_records(spark, folder, "t").count() == 0
    Path(folder, "3.xml").write_text("<html><p>gateway time-out</html>")
    with pytest.raises(Exception, match="page is no listing"):
        landed.read_records(spark, folder).collect()


def test_harvests_go_on_after_the_last_header(spark, folder):
    from recordflow.plans import harvest_job
    from recordflow.plans.workflow import Workflow
    workflow = Workflow(spark, folder)
    content = spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "C")], "identifier string, content string")
    headers = "identifier string, deleted boolean, datestamp timestamp"
    listing = [("a", False, None), ("b", True, None), ("c", False, None), ("d", False, None)]

    def run(n):
        listed = spark.createDataFrame(listing[:n], headers)
        harvest_job.harvest_dataset(workflow, listed, content, "d", F.col("external_id"), "E0", order=["identifier"])
        return harvest_job.last_state(harvest_job.iteration_states(workflow), "d", "E0")

    assert run(0) == (0, None) and run(2) == (2, "b") and run(2) == (2, "b") and run(4) == (4, "d")
    assert rows(workflow.results.records("E0"), "record_id", "record_data") == [("/d/a", "A"), ("/d/c", "C")]
    assert rows(workflow.results.errors("E0"), "record_id") == [("/oaiIdentifier/d",)]
    lost = spark.createDataFrame(listing[:1], headers)
    with pytest.raises(Exception, match="last identifier not in the listing"):
        harvest_job.harvest_dataset(workflow, lost, content, "d", F.col("external_id"), "E0", order=["identifier"])


def test_no_record_is_lost_to_another_of_its_id(spark):
    from recordflow.operators import harvest
    data = [("x2", "1", "two", None), ("x1", "1", "one", None), ("x1", "1", "one", None), ("x3", " ", "three", None), ("x4", "1", "", "failed"), (None, "2", "nobody", None)]
    frame = spark.createDataFrame(data, "external_id string, local string, content string, exception string")
    got = harvest.assign_unique_ids(frame, F.lit("d"), F.col("local"), "E0")
    assert sorted((r.record_id, r.record_data, r.exception or "") for r in got.collect()) == sorted([
        ("/externalIdentifier/x2", "", "id is taken: /d/1"), ("/d/1", "one", ""), ("/d/1", "one", ""),
        ("/externalIdentifier/x3", "", "record has no local id"), ("/oaiIdentifier/x4", "", "failed"), ("/d/2", "nobody", "")])


def test_ranges_of_a_chunk_plan_read_each_record_once(spark):
    """The conditions a database would be asked with, on the chunks of a plan; ids with quotes too."""
    import duckdb

    from recordflow.sources import chunks
    ids = [f"r{i}" for i in range(25)] + ["it's", "''"]
    data = [("d", "e", "S", i, "x") for i in ids] + [("d'", "e", "S", "r1", "other"), ("d", "f", "S", "r1", "other")]
    records = spark.createDataFrame(data, schema.EXECUTION_RECORD)
    plan = chunks.chunk_plan(records, 4).where("dataset_id = 'd' and execution_id = 'e'").orderBy("chunk_id").collect()
    conditions = store.range_predicates("d", "e", [(r.first_id, r.last_id) for r in plan])
    database = duckdb.connect()
    database.execute("create table records (dataset_id varchar, execution_id varchar, execution_name varchar, record_id varchar, record_data varchar)")
    database.executemany("insert into records values (?, ?, ?, ?, ?)", data)
    read = [r[0] for c in conditions for r in database.execute(f"select record_id from records where {c}").fetchall()]
    assert len(plan) == 7 and sorted(read) == sorted(ids)
    assert store.range_predicates("d'", "e", [("a", "b")])[0].startswith("dataset_id = 'd''' and")


def test_what_stands_between_elements_is_one_part(spark):
    from recordflow.functions import elements
    data = spark.createDataFrame(
        [(0, "<!--c--><r> <!--<a>--> t<?p?><![CDATA[<x>]]><a k='>'>one</a ><b/>\n<a>u<a>v</a></a></r>\n"), (1, "<r>t</r>"),
         (2, "<a>t</a><b>t</b>"), (3, "<a>t</a><b/>"), (4, "<![CDATA[x]]><a/>"), (5, "<r>" + "<b>" * 5000), (6, "<a></b>x</a>")],
        "i int, d string")
    got = {r.i: r.s for r in data.select("i", elements.scanned(F.col("d")).alias("s")).collect()}
    assert [(p.name, p.open, p.inner, p.close) for p in got[0].parts] == [
        (None, " <!--<a>--> t<?p?><![CDATA[<x>]]>", "", ""), ("a", "<a k='>'>", "one", "</a >"), ("b", "<b/>", "", ""),
        (None, "\n", "", ""), ("a", "<a>", "u<a>v</a>", "</a>")]
    assert (got[0].head, got[0].root, got[0].tail) == ("<!--c--><r>", "r", "</r>\n")
    assert [tuple(p) for p in got[1].parts] == [(0, None, "t", "", "")]
    assert [got[i] for i in range(2, 7)] == [None] * 5


def test_packed_pages_give_the_records_of_page_files(spark, folder):
    from pathlib import Path

    from recordflow.sources import landed
    pages = [f"<ListRecords><record><header><identifier>{i}</identifier></header><metadata> <m>&lt;{i}\x1e\n</m></metadata></record></ListRecords>" for i in range(40)]
    Path(folder, "files").mkdir()
    for i, page in enumerate(pages):
        Path(folder, "files", f"{i}.xml").write_text(page)
    landed.pack_pages(spark.createDataFrame([(p,) for p in pages], "value string").coalesce(1), f"{folder}/packed")
    assert len(list(Path(folder, "packed").glob("*.parquet"))) == 1
    read = rows(landed.read_records(spark, f"{folder}/packed", packed=True))
    assert len(read) == 40 and read == rows(landed.read_records(spark, f"{folder}/files"))
    landed.pack_pages(spark.createDataFrame([("no listing",)], "value string"), f"{folder}/bad")
    with pytest.raises(Exception, match="page is no listing"):
        landed.read_records(spark, f"{folder}/bad", packed=True).collect()


def test_what_the_parser_refuses_is_not_cut_into_parts(spark):
    cases = [("good", "<record><a>1</a></record>"), ("crossed", "<record><a>1</b></record>"), ("open", "<record><a></record>"), ("none", None)]
    parsed = record_xml.with_parsed(records(spark, *cases))
    got = {name: (cut, error) for name, cut, error in rows(
        parsed, "record_id", F.col("scan").isNotNull(), record_xml.malformed())}
    assert got == {"good": (True, None), **{name: (False, record_xml.MALFORMED) for name in ("crossed", "open", "none")}}
    plan = steps.normalization().run(records(spark, *cases), "E1")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml(") == plan.count("regexp_extract_all(") == 1  # each once a record


def test_a_record_is_rebuilt_as_it_was(spark):
    cases = [("a", "<!-- x --><record n='1'> one <a>1</a>\n<b/> two <c><d></d></c></record> "), ("b", "<record/>"), ("c", "no record")]
    parsed = record_xml.with_parsed(records(spark, *cases))
    assert rows(parsed, "record_id", record_xml.rebuilt(F.col("scan.parts"))) == [*cases[:2], ("c", None)]


def test_values_are_bound_once_and_as_they_are(spark):
    from recordflow.functions import elements
    got = spark.range(2).select(
        elements.let(F.when(F.col("id") > 0, F.lit("ab")), lambda x: F.concat(x, x)).alias("text"),
        elements.let(F.array(F.lit(1), F.lit(None)), lambda x: elements.let(F.size(x), lambda n: n + F.get(x, n - 2) + F.col("id"))).alias("number"),
        elements.let(F.rand(), lambda x: x == x).alias("same"))
    assert rows(got) == [("abab", 4, True), (None, 3, True)]


def test_texts_of_one_file_are_made_by_many_tasks(spark, folder):
    from recordflow.checks.registry import QUERIES
    import recordflow.checks.elements  # noqa: F401
    spark.createDataFrame([(i, "en" if i % 3 else "de") for i in range(40)], "doc_id bigint, lang string").coalesce(1).write.parquet(
        f"{folder}/documents.parquet")
    result = QUERIES["blanks_isolated"](spark, folder)
    assert result.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism
    got = rows(result, "record_id", F.length("record_data"), "exception")
    frame = len("<record><title></title></record>")
    assert got == sorted([(str(i), *{
        0: (frame + 30000 + i + len(str(i)), None), 1: (frame + 35000 + len(str(i)), None),
        2: (frame + 2100 + len(str(i)), None), 3: (0, "malformed record")}[i % 4]) for i in range(40) if i % 3], key=repr)
