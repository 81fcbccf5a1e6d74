from probewatch.sources.constraints import split_valid, violations
from probewatch.sources.documents import (
    range_samples, read_documents, read_range_documents, rejected_documents,
    samples_from_documents, stream_documents,
)
from probewatch.sources.samples import (
    merge_success_duration, range_window, rename_address, stage_to_samples,
)
from probewatch.sources.staged import read_stage, write_stage

__all__ = [
    "merge_success_duration", "range_samples", "range_window", "read_documents",
    "read_range_documents", "read_stage", "rejected_documents", "rename_address",
    "samples_from_documents", "split_valid", "stage_to_samples", "stream_documents",
    "violations", "write_stage",
]
