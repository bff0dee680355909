"""Where each table lives under the output folder."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Layout:
    root: str

    def _path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    @property
    def landing(self) -> str:
        return self._path("raw", "landing")

    @property
    def landed_files(self) -> str:
        return self._path("raw", "landed_files")

    @property
    def repaired_lines(self) -> str:
        return self._path("raw", "repaired_lines")

    @property
    def validation_log(self) -> str:
        return self._path("staging", "validation_log")

    @property
    def validation_rules(self) -> str:
        return self._path("staging", "validation_rules")

    @property
    def agg_parts(self) -> str:
        return self._path("features", "agg_parts")

    @property
    def agg_merged(self) -> str:
        return self._path("features", "agg_merged")

    @property
    def stream_totals(self) -> str:
        return self._path("features", "stream_totals")

    @property
    def feature_rows(self) -> str:
        return self._path("features", "feature_rows")

    @property
    def feature_state(self) -> str:
        return self._path("features", "feature_state")

    @property
    def trained_series(self) -> str:
        return self._path("models", "trained_series")

    @property
    def untrained_series(self) -> str:
        return self._path("models", "untrained_series")

    @property
    def model_events(self) -> str:
        return self._path("models", "model_events")

    @property
    def comparison_log(self) -> str:
        return self._path("models", "model_comparison_log")

    @property
    def prediction_log(self) -> str:
        return self._path("monitoring", "prediction_log")

    @property
    def drift_metrics(self) -> str:
        return self._path("monitoring", "drift_metrics")

    @property
    def series_drift(self) -> str:
        return self._path("monitoring", "series_drift")

    @property
    def distributions(self) -> str:
        return self._path("monitoring", "distributions")

    @property
    def runs(self) -> str:
        return self._path("monitoring", "runs")

    @property
    def trigger_log(self) -> str:
        return self._path("monitoring", "trigger_log")
