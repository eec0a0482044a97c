"""Where the folders of one deployment lie."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Zones:
    """All folders below one root on the shared file system."""

    root: str

    def raw(self, glob: str) -> str:
        return f"{self.root}{glob}"

    def staged(self, dataset: str) -> str:
        return f"{self.root}/Stage/{dataset}"

    def staged_run(self, dataset: str, run_id: str) -> str:
        return f"{self.staged(dataset)}/run_id={run_id}"

    def snapshot(self, dataset: str) -> str:
        return f"{self.root}/Enriched/{dataset}/snapshot"

    def increments(self, dataset: str) -> str:
        return f"{self.root}/Enriched/{dataset}/increments"

    def per_file(self, dataset: str) -> str:
        return f"{self.root}/Enriched/{dataset}/files"

    def coverage(self, report: str) -> str:
        return f"{self.root}/Enriched/coverage/{report}"

    def file_ledger(self, dataset: str) -> str:
        return f"{self.root}/Errors/file_ledger/{dataset}"

    @property
    def load_reports(self) -> str:
        return f"{self.root}/Errors/loads"

    @property
    def file_manifests(self) -> str:
        return f"{self.root}/Errors/raw_to_stage"

    @property
    def line_records(self) -> str:
        return f"{self.root}/Errors/raw_to_stage_lines"

    @property
    def run_manifests(self) -> str:
        return f"{self.root}/Errors/stage_to_enriched/manifests"

    @property
    def error_records(self) -> str:
        return f"{self.root}/Errors/stage_to_enriched/records"
