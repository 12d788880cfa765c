"""The regression run: all models and diagnostics of one regression input."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from wattline.functions import constants as k
from wattline.operators import regression as reg


@dataclass(frozen=True)
class RegressionRun:
    """Result tables of one run; `by` names the group columns of every table."""

    by: tuple[str, ...]
    rows: DataFrame
    log_ols: reg.Fit
    gamma_glm: reg.Fit

    @property
    def coefficients(self) -> DataFrame:
        return reg.stack_models([reg.coefficients(self.log_ols), reg.coefficients(self.gamma_glm)])

    @property
    def sensitivity(self) -> DataFrame:
        return reg.sensitivity(self.coefficients, self.by)

    @property
    def metrics(self) -> DataFrame:
        return reg.model_metrics(self.log_ols, self.gamma_glm)

    @property
    def breusch_pagan(self) -> DataFrame:
        return reg.breusch_pagan(self.log_ols)

    @property
    def vif(self) -> DataFrame:
        return reg.vif(self.rows, self.log_ols.features, self.by)

    @property
    def correlation(self) -> DataFrame:
        return reg.correlation_matrix(self.rows, self.log_ols.features, self.by)

    @property
    def univariate(self) -> DataFrame:
        return reg.univariate_gamma_glm(self.rows, self.log_ols.features, self.by)

    @property
    def status(self) -> DataFrame:
        """Every group of every model: observations and whether it could be fitted."""
        return reg.stack_models([reg.fit_status(self.log_ols), reg.fit_status(self.gamma_glm)])

    def tables(self) -> dict[str, DataFrame]:
        return {
            "model_dataset": self.rows,
            "coefficients": self.coefficients,
            "sensitivity": self.sensitivity,
            "model_metrics": self.metrics,
            "vif": self.vif,
            "breusch_pagan": self.breusch_pagan,
            "correlation_matrix": self.correlation,
            "univariate_gamma_glm": self.univariate,
        }


def run_targets(
    regression_input: DataFrame,
    targets: Sequence[str] = k.TARGETS,
    features: Sequence[str] = k.FEATURES,
    by: Sequence[str] = (),
    strict: bool = True,
) -> RegressionRun:
    """Fit all models for all targets, pooled or per `by` group, in grouped jobs.

    With `strict` a group below the minimum of observations is an error;
    without it such groups have no result rows, the others are kept, and
    `status` names them all.
    """
    keys = ("target", *by)
    rows = reg.prepare(reg.model_rows(regression_input, targets, features))
    log_ols, gamma_glm = reg.fit_both(rows, features, keys)
    if strict:
        reg.require_observations(log_ols, gamma_glm)
    return RegressionRun(keys, rows, log_ols, gamma_glm)
