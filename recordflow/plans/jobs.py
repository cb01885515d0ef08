"""Named jobs: parameters are checked before any plan is made, then one step is run."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordflow import params, schema
from recordflow.operators.transform import Rule
from recordflow.plans import steps
from recordflow.plans.workflow import Execution, Workflow


@dataclass(frozen=True)
class Inputs:
    """What jobs read besides records: landed pages, rules, mappings and tables.

    ``mappings`` and ``entity_tables`` are chosen by name in a job's parameters.
    """

    headers: DataFrame | None = None
    content: DataFrame | None = None
    local_id: Column | None = None
    external_rules: Mapping[str, Column] = field(default_factory=dict)
    internal_rules: Mapping[str, Column] = field(default_factory=dict)
    mappings: Mapping[str, Sequence[Rule]] = field(default_factory=dict)
    entity_tables: Mapping[str, DataFrame] = field(default_factory=dict)
    reference: Callable[[Column], Column] = staticmethod(lambda link: link)
    metadata: DataFrame | None = None


def _step(name: str, given: params.StepParams, inputs: Inputs) -> steps.Step:
    if name == schema.HARVEST:
        return steps.harvest_step(
            inputs.headers, inputs.content, F.lit(given.dataset_id), inputs.local_id)
    if isinstance(given, params.ValidationParams):
        if given.validation_type == params.EXTERNAL:
            return steps.external_validation(inputs.external_rules)
        return steps.internal_validation(inputs.internal_rules)
    if name == schema.TRANSFORMATION:
        return steps.transformation(
            inputs.mappings[given.mapping], dataset_name=given.dataset_name,
            country=given.country, language=given.language)
    if name == schema.NORMALIZATION:
        return steps.normalization()
    if name == schema.ENRICHMENT:
        return steps.enrichment(inputs.entity_tables[given.entity_table], inputs.reference)
    if name == schema.MEDIA:
        return steps.media_step(inputs.metadata)
    return steps.indexing(given.database)


def run_job(workflow: Workflow, name: str, inputs: Inputs, **given: object) -> Execution:
    """Runs the job ``name`` over one dataset.

    With a ``task_id`` the job goes on where that task stopped; without one it gets a
    random id. The id names the execution that is written. An index job is also taken
    over into its serving table, with redirects where they are asked for.
    """
    checked = params.check_params(name, **given)
    step = _step(name, checked, inputs)
    task_id = int(checked.task_id) if checked.task_id else params.new_task_id()
    done = workflow.run_step(
        step, checked.execution_id or None, str(task_id), task_id,
        resume=bool(checked.task_id), dataset_id=checked.dataset_id)
    if isinstance(checked, params.IndexingParams):
        number = workflow.run_number(checked.database, done.execution_id)
        if checked.perform_redirects and checked.redirect_from:
            workflow.redirect(checked.database, done.execution_id, number,
                              checked.redirect_from, inputs.local_id)
        workflow.serve(checked.database, done.execution_id, number, checked.record_date,
                       checked.preserve_timestamps)
    return done
