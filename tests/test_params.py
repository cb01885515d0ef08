from __future__ import annotations

from datetime import datetime, timezone

import pytest

from recordflow import params, schema
from recordflow.params import MissingParameter, check_params
from recordflow.session import shared_folder, size_settings
from recordflow.sinks.tables import ProgressLog

COMMON = {"dataset_id": "d1", "execution_id": "e1"}
COMPLETE = {
    schema.HARVEST: {"dataset_id": "d1", "repository_url": "http://repository.test",
                     "metadata_prefix": "edm", "set_spec": "s"},
    schema.VALIDATION_EXTERNAL: {**COMMON, "validation_type": schema.VALIDATION_EXTERNAL},
    schema.VALIDATION_INTERNAL: {**COMMON, "validation_type": schema.VALIDATION_INTERNAL},
    schema.TRANSFORMATION: {**COMMON, "dataset_name": "n", "country": "c", "language": "de",
                            "mapping": "default"},
    schema.NORMALIZATION: COMMON,
    schema.ENRICHMENT: {**COMMON, "entity_table": "entities"},
    schema.MEDIA: COMMON,
    schema.INDEXING: {**COMMON, "preserve_timestamps": False, "perform_redirects": True,
                      "database": params.PREVIEW},
}


@pytest.mark.parametrize("step", schema.STEP_NAMES)
def test_complete_parameters_are_taken(step):
    assert check_params(step, **COMPLETE[step]).dataset_id == "d1"


@pytest.mark.parametrize(
    "step, key", [(step, key) for step, given in COMPLETE.items() for key in given])
def test_each_required_parameter_is_missed(step, key):
    given = {k: v for k, v in COMPLETE[step].items() if k != key}
    with pytest.raises(MissingParameter, match=key):
        check_params(step, **given)


def test_blank_counts_as_missing():
    with pytest.raises(MissingParameter):
        check_params(schema.MEDIA, dataset_id=" ", execution_id="e1")


def test_unknown_step_profile_target_and_parameter():
    with pytest.raises(ValueError, match="unknown step"):
        check_params("HTTP_HARVEST", **COMMON)
    with pytest.raises(ValueError, match="unknown validation type"):
        check_params(schema.VALIDATION_EXTERNAL, **COMMON, validation_type="OTHER")
    with pytest.raises(ValueError, match="unknown target"):
        check_params(schema.INDEXING, **{**COMPLETE[schema.INDEXING], "database": "OTHER"})
    with pytest.raises(ValueError, match="unknown parameters"):
        check_params(schema.MEDIA, **COMMON, colour="red")


def test_redirect_ids_and_record_date():
    assert params.split_ids("a, b ,c") == ("a", "b", "c")
    assert params.split_ids(None) == ()
    assert params.parse_record_date("2024-05-06T07:08:09Z") == datetime(
        2024, 5, 6, 7, 8, 9, tzinfo=timezone.utc)
    assert params.parse_record_date("2024-05-06").tzinfo == timezone.utc
    assert params.parse_record_date(None).tzinfo == timezone.utc


def test_task_is_registered_once(spark, folder):
    log = ProgressLog(spark, folder)
    assert log.find(7) is None
    assert log.register(7) == 7
    log.add(7, 1, 10)
    assert log.register(7) == 7
    assert log.find(7) == (1, 10)
    new = log.register()
    assert new > 0 and log.find(new) == (0, 0)


def test_commit_written_again_counts_once(spark, folder):
    log = ProgressLog(spark, folder)
    log.register(1)
    log.add(1, 1, 10)
    log.add(1, 2, 5)
    log.add(1, 2, 5)
    log.set_written(1, 40)
    assert [tuple(r) for r in log.state().collect()] == [(1, 3, 40)]


def test_shared_folder_is_read_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_partitions_follow_the_size_of_the_data():
    def partitions(size, cores):
        return int(size_settings(size, cores)["spark.sql.shuffle.partitions"])

    assert partitions(0, 8) == 16
    assert partitions(1 << 40, 8) == 4096
    assert partitions(100 << 40, 4000) == 409_600
    assert size_settings(100 << 40, 4000, 100_000)["spark.sql.shuffle.partitions"] == "100000"
