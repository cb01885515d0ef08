from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from recordflow import schema
from recordflow.operators.project import step_result
from recordflow.operators.transform import Rule
from recordflow.params import PREVIEW, PUBLISH, MissingParameter
from recordflow.plans import jobs, record_xml, steps
from recordflow.plans.steps import Step
from recordflow.plans.workflow import Workflow


def source_step(spark, *items):
    def run(_, execution_id):
        return spark.createDataFrame(
            [("d1", execution_id, schema.HARVEST, i, d, None) for i, d in items],
            schema.STEP_RESULT)

    return Step(schema.HARVEST, run)


def copy_step(error=None):
    return Step(schema.MEDIA, lambda frame, execution_id: step_result(
        frame, execution_id, schema.MEDIA, F.col("record_data"), error))


def test_chain_hands_on_its_executions(spark, folder):
    workflow = Workflow(spark, folder)
    done = workflow.run([source_step(spark, ("1", "a"), ("2", "b")),
                         copy_step(F.when(F.col("record_id") == "2", F.lit("no"))), copy_step()])
    assert [e.source_id for e in done] == [None, done[0].execution_id, done[1].execution_id]
    report = {r["execution_id"]: r for r in workflow.report(done).collect()}
    assert [(report[e.execution_id]["source_total"], report[e.execution_id]["success"],
             report[e.execution_id]["exceptions"]) for e in done] == [
        (2, 2, 0), (2, 1, 1), (1, 1, 0)]
    assert sorted(r["write_count"] for r in workflow.progress.state().collect()) == [1, 2, 2]


def test_a_failing_step_stops_the_chain(spark, folder):
    workflow = Workflow(spark, folder)
    ran = []

    def later(frame, execution_id):
        ran.append(execution_id)
        return frame

    broken = copy_step(F.raise_error(F.lit("step is broken")).cast("string"))
    with pytest.raises(Exception, match="step is broken"):
        workflow.run([source_step(spark, ("1", "a")), broken, Step(schema.MEDIA, later)],
                     ["E0", "E1", "E2"])
    assert ran == []
    assert workflow.results.written("E1") == 0


def test_a_step_is_resumed_with_what_is_left(spark, folder):
    workflow = Workflow(spark, folder)
    first = workflow.run_step(source_step(spark, ("1", "a"), ("2", "b"), ("3", "c")), None, "E0")
    workflow.results.insert(copy_step().run(
        workflow.results.records("E0").where("record_id = '1'"), "E1"), "E1")
    seen = []

    def count(frame, execution_id):
        seen.append(frame.count())
        return copy_step().run(frame, execution_id)

    workflow.run_step(Step(schema.MEDIA, count), first.execution_id, "E1", task_id=3, resume=True)
    assert seen == [2]
    assert workflow.results.written("E1") == 3
    workflow.run_step(Step(schema.MEDIA, count), first.execution_id, "E1", task_id=3, resume=True)
    assert seen == [2, 0]
    assert workflow.progress.find(3) == (2, 3)


def test_publish_takes_refused_records_out(spark, folder):
    good = "<record><about>1</about><resource>x</resource></record>"
    poor = "<record><about>2</about></record>"
    workflow = Workflow(spark, folder)
    workflow.run([source_step(spark, ("1", good), ("2", poor)), *steps.index_both()],
                 ["E0", "E1", "E2"])
    early = F.lit("2024-01-01").cast("timestamp")
    late = F.lit("2024-02-02").cast("timestamp")
    workflow.serve(PUBLISH, "E1", 0, early)
    assert rows(workflow.serving(PUBLISH).state(), "record_id") == [("1",), ("2",)]
    served = workflow.serve(PUBLISH, "E2", 1, late, preserve_timestamps=True).state()
    assert rows(served, "record_id", F.date_format("updated", "yyyy-MM-dd")) == [
        ("1", "2024-01-01")]
    served = workflow.serve(PUBLISH, "E2", 1, late).state()
    assert rows(served, "record_id", F.date_format("updated", "yyyy-MM-dd")) == [
        ("1", "2024-02-02")]
    assert rows(workflow.results.errors("E2"), "exception") == [
        ("Record deleted from database PUBLISH, cause it was in media tier 0! Id: 2",)]
    assert workflow.serving(PREVIEW).state().count() == 0


def test_normalization_step(spark):
    data = ("<record><about>1</about><language>ger</language><title> a  b </title>"
            "<description/><link> x </link><link>x</link><link> </link><link>y</link></record>")
    frame = spark.createDataFrame(
        [("d1", "e0", "S", "1", data), ("d1", "e0", "S", "2", "<record>")],
        schema.EXECUTION_RECORD)
    out = steps.normalization().run(frame, "e1")
    assert rows(out, "record_id", "record_data", "exception") == [
        ("1", "<record><about>1</about><language>de</language><title>a b</title>"
              "<link>x</link><link>y</link></record>", None),
        ("2", "", record_xml.MALFORMED)]


def test_named_jobs_go_through_all_steps(spark, folder):
    headers = spark.createDataFrame(
        [("x:1", False), ("x:2", True), ("x:3", False)], "identifier string, deleted boolean",
    ).withColumn("datestamp", F.timestamp_seconds(F.lit(0)))
    content = spark.createDataFrame(
        [("x:1", "One a b"), ("x:3", "Three c")], "identifier string, content string")
    inputs = jobs.Inputs(
        headers=headers, content=content, local_id=F.col("external_id"),
        external_rules={"short": F.length("record_data") > 3},
        internal_rules={"no title": F.col("xml.title") != ""},
        mappings={"default": [
            Rule("title", "split(record_data, ' ')[0]", required=True),
            Rule("link", "slice(split(record_data, ' '), 2, 9)", many=True)]},
        entity_tables={"letters": spark.createDataFrame(
            [("a", "A"), ("b", "B")], "reference string, label string")},
        metadata=spark.createDataFrame(
            [("a", "image/jpeg", 5)], "resource string, mime string, bytes bigint"))
    workflow = Workflow(spark, folder)
    last = jobs.run_job(
        workflow, schema.HARVEST, inputs, dataset_id="d1", repository_url="http://r.test",
        metadata_prefix="p", set_spec="s")
    assert workflow.progress.find(int(last.execution_id)) == (1, 2)
    for name, given in (
            (schema.VALIDATION_EXTERNAL, {"validation_type": schema.VALIDATION_EXTERNAL}),
            (schema.TRANSFORMATION, {"dataset_name": "n", "country": "c", "language": "eng",
                                     "mapping": "default"}),
            (schema.VALIDATION_INTERNAL, {"validation_type": schema.VALIDATION_INTERNAL}),
            (schema.NORMALIZATION, {}),
            (schema.ENRICHMENT, {"entity_table": "letters"}),
            (schema.MEDIA, {})):
        last = jobs.run_job(workflow, name, inputs, dataset_id="d1",
                            execution_id=last.execution_id, **given)
    assert rows(workflow.results.records(last.execution_id), "record_id", "record_data") == [
        ("/d1/x_1", "<record><about>/d1/x_1</about><datasetName>n</datasetName>"
                    "<country>c</country><language>en</language><title>One</title><link>a</link>"
                    "<link>b</link><concept>A</concept><concept>B</concept>"
                    "<resource>a image/jpeg 5</resource><mainThumbnail>true</mainThumbnail>"
                    "</record>")]


def test_index_jobs_serve_redirect_and_repeat(spark, folder):
    data = "<record><title>same</title><resource>x</resource></record>"
    title = F.regexp_extract("record_data", "<title>([^<]*)", 1)
    workflow = Workflow(spark, folder)

    def index_job(source, dataset, **given):
        return jobs.run_job(
            workflow, schema.INDEXING, jobs.Inputs(local_id=title), dataset_id=dataset,
            execution_id=source, database=PUBLISH, preserve_timestamps=True, **given)

    old = spark.createDataFrame(
        [("old", "E0", schema.HARVEST, "/old/1", data, None)], schema.STEP_RESULT)
    new = spark.createDataFrame(
        [("new", "E1", schema.HARVEST, "/new/1", data, None)], schema.STEP_RESULT)
    workflow.results.insert(old, "E0")
    workflow.results.insert(new, "E1")
    index_job("E0", "old", perform_redirects=False)
    task = index_job("E1", "new", perform_redirects=True, redirect_from=("old",)).execution_id
    for _ in range(2):
        assert rows(workflow.serving(PUBLISH).state(), "record_id") == [("/new/1",), ("/old/1",)]
        assert rows(workflow.redirects(PUBLISH).state()) == [("/old/1", "/new/1")]
        assert workflow.run_number(PUBLISH, task) == 2
        again = index_job("E1", "new", perform_redirects=True, redirect_from=("old",),
                          task_id=task)
        assert again.execution_id == task


def test_parameters_are_checked_before_anything_runs(spark, folder):
    workflow = Workflow(spark, folder)
    with pytest.raises(MissingParameter):
        jobs.run_job(workflow, schema.MEDIA, jobs.Inputs(), dataset_id="d1")
    assert workflow.progress.state().count() == 0


CUT_OFF = "<record><about>x</about><title>half"
ODD = ('<?xml version="1.0"?>\n<record id="7">\n <about>a</about><title lang="en">  One\n two </title><title>Three &amp; four</title>'
       '<creator role="x"><name>N  N</name></creator><language>ENG</language><title/><flag on="1"/><!-- note -->'
       '<link>u1</link><link> u1 </link><link>u2</link><mainThumbnail>old</mainThumbnail></record>\n')
NESTED = "<record><a><a>x</a></a></record>"


def run_on(spark, step, *texts):
    records = spark.createDataFrame([("d", str(i), t) for i, t in enumerate(texts)], "dataset_id string, record_id string, record_data string")
    return {r.record_id: r for r in step.run(records, "e").collect()}


def test_no_step_loses_or_fakes_a_record(spark):
    entities = spark.createDataFrame([("u1", "L1"), ("u2", "L2")], "reference string, label string")
    metadata = spark.createDataFrame([("u1", "image/png", 5)], "resource string, mime string, bytes long")
    for step in (steps.normalization(), steps.enrichment(entities, lambda link: link), steps.media_step(metadata), steps.indexing("PREVIEW")):
        got = run_on(spark, step, CUT_OFF, ODD, None, "", "no record", NESTED)
        for key in ("0", "2", "3", "4"):
            assert got[key].exception == record_xml.MALFORMED and got[key].record_data == "", (step.name, key)
        assert got["5"].exception is None or step.name == schema.INDEXING
        assert got["5"].exception or "<a><a>x</a></a>" in got["5"].record_data
        assert '<creator role="x"><name>N  N</name></creator>' in got["1"].record_data or got["1"].exception


def test_records_are_changed_in_place(spark):
    normal = run_on(spark, steps.normalization(), ODD)["0"].record_data
    assert normal == ('<?xml version="1.0"?>\n<record id="7">\n <about>a</about><title lang="en">One two</title><title>Three &amp; four</title>'
                      '<creator role="x"><name>N  N</name></creator><language>en</language><flag on="1"/><!-- note --><link>u1</link><link>u2</link>'
                      '<mainThumbnail>old</mainThumbnail></record>\n')
    entities = spark.createDataFrame([("u1", "L & 1"), ("u2", "L2")], "reference string, label string")
    enriched = run_on(spark, steps.enrichment(entities, lambda link: link), normal)["0"].record_data
    assert enriched == normal.replace("</record>", "<concept>L &amp; 1</concept><concept>L2</concept></record>")
    metadata = spark.createDataFrame([("u1", "image/png", 5)], "resource string, mime string, bytes long")
    media = run_on(spark, steps.media_step(metadata), enriched)["0"].record_data
    assert media == enriched.replace("<mainThumbnail>old</mainThumbnail>", "").replace(
        "</record>", "<resource>u1 image/png 5</resource><mainThumbnail>true</mainThumbnail></record>")


NAMESPACED = ('<?xml version="1.0"?>\n<!-- from a library --><x:RDF xmlns:x="urn:x" xmlns:d="urn:d">\n  <d:title>A  b</d:title>\n'
              '  <?keep <this> ?><d:note><d:note>1</d:note> &lt;</d:note><d:title><![CDATA[a  <b> ]]></d:title>text between\n'
              '  <d:link>u1</d:link><link> u1 </link><d:link>u1</d:link></x:RDF><!-- end -->')


def test_any_root_and_what_lies_inside_survive(spark):
    normal = run_on(spark, steps.normalization(), NAMESPACED)["0"].record_data
    assert normal == NAMESPACED.replace("A  b", "A b").replace("> u1 <", ">u1<").replace("<d:link>u1</d:link></x", "</x")
    entities = spark.createDataFrame([("u1", "L1")], "reference string, label string")
    enriched = run_on(spark, steps.enrichment(entities, lambda link: link), normal)["0"].record_data
    assert enriched == normal.replace("</x:RDF>", "<concept>L1</concept><concept>L1</concept></x:RDF>")
    metadata = spark.createDataFrame([("u1", "image/png", 5)], "resource string, mime string, bytes long")
    for empty in ("<x:record a='/>'/><!-- e -->", "<x:record a='/>'></x:record><!-- e -->"):
        media = run_on(spark, steps.media_step(metadata), empty)["0"].record_data
        assert media == "<x:record a='/>'><mainThumbnail>false</mainThumbnail></x:record><!-- e -->"


def test_one_hostile_record_does_not_stop_a_step(spark):
    """Megabytes of blanks, comments, nested and open tags; a hundred thousand links."""
    million = 1_000_000
    hostile = ["<record>" + " " * 4 * million + "<title>q</title></record>", "<record>" + "<!---->" * 150_000 + "</record>",
               "<a>" * 100_000 + "</a>" * 100_000, "<record>" + "<link>u</link>" * 100_000 + "</record>", "<!--" * 250_000, "<" * million,
               '<a "' * 250_000, "<![" * 250_000, "<record a='" + "<>" * million + "'/>", "<record>" + "<a/>" * 100_000 + "</record>"]
    got = run_on(spark, steps.normalization(), *hostile)
    good = {k for k, r in got.items() if r.exception is None}
    assert good == {"0", "1", "3", "9"}
    assert got["0"].record_data == hostile[0] and got["1"].record_data == hostile[1]
    assert got["3"].record_data == "<record><link>u</link></record>" and got["9"].record_data == "<record></record>"
