"""Step parameters, checked on the driver before any plan is made."""

from __future__ import annotations

import secrets
import uuid
from dataclasses import dataclass, field, fields
from datetime import datetime, timezone

from recordflow import schema

EXTERNAL, INTERNAL = schema.VALIDATION_EXTERNAL, schema.VALIDATION_INTERNAL
PREVIEW, PUBLISH = "PREVIEW", "PUBLISH"

DEFAULT_CHUNK_SIZE = 1000


class MissingParameter(ValueError):
    """A required parameter is absent or blank."""


@dataclass(frozen=True, kw_only=True)
class StepParams:
    """What every step needs: where it reads and under which id it writes.

    ``execution_id`` is the execution to read, ``task_id`` the one to write.
    """

    dataset_id: str
    execution_id: str
    task_id: str = ""

    OPTIONAL = frozenset({"task_id"})

    def __post_init__(self) -> None:
        for item in fields(self):
            value = getattr(self, item.name)
            blank = value is None or (isinstance(value, str) and not value.strip())
            if blank and item.name not in self.OPTIONAL:
                raise MissingParameter(f"{type(self).__name__}: {item.name} is required")


@dataclass(frozen=True, kw_only=True)
class HarvestParams(StepParams):
    repository_url: str
    metadata_prefix: str
    set_spec: str
    execution_id: str = ""

    OPTIONAL = frozenset({"task_id", "execution_id"})


@dataclass(frozen=True, kw_only=True)
class ValidationParams(StepParams):
    validation_type: str

    def __post_init__(self) -> None:
        super().__post_init__()
        if self.validation_type not in (EXTERNAL, INTERNAL):
            raise ValueError(f"unknown validation type: {self.validation_type}")


@dataclass(frozen=True, kw_only=True)
class TransformationParams(StepParams):
    dataset_name: str
    country: str
    language: str
    mapping: str


@dataclass(frozen=True, kw_only=True)
class NormalizationParams(StepParams):
    pass


@dataclass(frozen=True, kw_only=True)
class EnrichmentParams(StepParams):
    entity_table: str


@dataclass(frozen=True, kw_only=True)
class MediaParams(StepParams):
    pass


@dataclass(frozen=True, kw_only=True)
class IndexingParams(StepParams):
    preserve_timestamps: bool
    perform_redirects: bool
    database: str
    record_date: datetime = field(default_factory=lambda: datetime.now(timezone.utc))
    redirect_from: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        super().__post_init__()
        if self.database not in (PREVIEW, PUBLISH):
            raise ValueError(f"unknown target database: {self.database}")


_BY_STEP: dict[str, type[StepParams]] = {
    schema.HARVEST: HarvestParams,
    schema.VALIDATION_EXTERNAL: ValidationParams,
    schema.VALIDATION_INTERNAL: ValidationParams,
    schema.TRANSFORMATION: TransformationParams,
    schema.NORMALIZATION: NormalizationParams,
    schema.ENRICHMENT: EnrichmentParams,
    schema.MEDIA: MediaParams,
    schema.INDEXING: IndexingParams,
}


def check_params(step: str, **given: object) -> StepParams:
    """The typed parameters of ``step``; unknown steps and missing keys are refused."""
    if step not in _BY_STEP:
        raise ValueError(f"unknown step: {step}")
    kind = _BY_STEP[step]
    names = {item.name for item in fields(kind)}
    unknown = set(given) - names
    if unknown:
        raise ValueError(f"{step}: unknown parameters {sorted(unknown)}")
    try:
        return kind(**given)
    except TypeError as missing:
        raise MissingParameter(f"{step}: {missing}") from None


def split_ids(text: str | None) -> tuple[str, ...]:
    """``"a, b"`` to ``("a", "b")``; nothing to an empty tuple."""
    return tuple(part.strip() for part in text.split(",")) if text else ()


def parse_record_date(text: str | None) -> datetime:
    """An ISO date or time, or the present moment. Called once, on the driver."""
    if not text:
        return datetime.now(timezone.utc)
    parsed = datetime.fromisoformat(text)
    return parsed if parsed.tzinfo else parsed.replace(tzinfo=timezone.utc)


def new_task_id() -> int:
    """A random positive 63-bit id."""
    return secrets.randbits(63)


def new_execution_id() -> str:
    """A time-based id, made once on the driver."""
    return str(uuid.uuid1())


def run_label(job: str, dataset_id: str, execution_id: str) -> str:
    return f"{job} (dataset: {dataset_id}, execution: {execution_id})"
