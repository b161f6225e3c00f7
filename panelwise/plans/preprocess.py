"""The preparation chain: drop, impute, drop, encode, log, scale, drop incomplete rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame

from panelwise.operators import columns as cols
from panelwise.operators import stages
from panelwise.operators.impute import ChainedImpute
from panelwise.roles import ColumnRoles

# Columns of the hourly clinical panel and what is done to them.
CLINICAL_DROP_FIRST = (
    "Unnamed: 0", "SBP", "DBP", "EtCO2", "BaseExcess", "HCO3", "pH", "PaCO2",
    "Alkalinephos", "Calcium", "Magnesium", "Phosphate", "Potassium", "PTT", "Fibrinogen",
)
CLINICAL_DROP_AFTER_IMPUTE = (
    "TroponinI", "Bilirubin_direct", "AST", "Bilirubin_total", "Lactate", "SaO2", "FiO2",
)
CLINICAL_LOG = ("MAP", "BUN", "Creatinine", "Glucose", "WBC", "Platelets")
CLINICAL_SCALE = (
    "HR", "O2Sat", "Temp", "MAP", "Resp", "BUN", "Chloride", "Creatinine", "Glucose",
    "Hct", "Hgb", "WBC", "Platelets",
)
CLINICAL_ROLES = ColumnRoles(entity="Patient_ID", time="Hour", label="SepsisLabel")


@dataclass(frozen=True)
class Preparation:
    """Which columns each step works on."""

    drop_first: Sequence[str] = ()
    impute: Sequence[str] = ()
    predictors: Sequence[str] = ()
    drop_after: Sequence[str] = ()
    one_hot: Sequence[str] = ()
    log: Sequence[str] = ()
    scale: Sequence[str] = ()
    method: str = "chained"
    max_rounds: int = 200
    exact_quantiles: bool = True

    def pipeline(self) -> Pipeline:
        if self.method not in ("chained", "mean"):
            raise ValueError(f"unknown imputation: {self.method}")
        steps = [stages.DropColumns(self.drop_first, strict=True)]
        if self.impute:
            if self.method == "mean":
                steps.append(stages.MeanImpute(self.impute))
            else:
                both = list(dict.fromkeys([*self.impute, *self.predictors]))
                steps.append(ChainedImpute(both, maxRounds=self.max_rounds))
        steps.append(stages.DropColumns(self.drop_after, strict=False))
        if self.one_hot:
            steps.append(stages.OneHot(self.one_hot))
        if self.log:
            steps.append(stages.ClippedLog(self.log))
        if self.scale:
            steps.append(stages.RobustScale(self.scale, exact=self.exact_quantiles))
        steps.append(stages.DropIncompleteRows())
        return Pipeline(stages=steps)


def clinical_preparation(
    df: DataFrame, roles: ColumnRoles = CLINICAL_ROLES, label_predicts: bool = False, **changes
) -> Preparation:
    """The preparation of the hourly clinical panel.

    Numeric columns are imputed from one another, with time among the predictors
    and sparse laboratory columns before they are dropped.  ``Gender`` is kept as
    it is and encoded.  ``label_predicts`` lets the label take part as a
    predictor; it leaks and is off.
    """
    skip = {roles.entity, roles.row_id, "Gender", *CLINICAL_DROP_FIRST}
    if not label_predicts:
        skip.add(roles.label)
    settings = dict(
        drop_first=CLINICAL_DROP_FIRST,
        impute=cols.numeric_columns(df, exclude=tuple(skip)),
        drop_after=CLINICAL_DROP_AFTER_IMPUTE,
        one_hot=("Gender",),
        log=CLINICAL_LOG,
        scale=CLINICAL_SCALE,
    )
    return Preparation(**{**settings, **changes})


def preprocess(
    train: DataFrame, preparation: Preparation, roles: ColumnRoles
) -> tuple[PipelineModel, DataFrame]:
    """Fit on the training rows; return the model and the prepared training rows."""
    named = cols.normalize_names(train, index_column=None)
    model = preparation.pipeline().fit(named)
    return model, check_prepared(model.transform(named), roles)


def check_prepared(df: DataFrame, roles: ColumnRoles) -> DataFrame:
    """One column per name, no nested features, label still there."""
    unique = cols.drop_duplicate_columns(df) if len(set(df.columns)) < len(df.columns) else df
    cols.require_columns(unique, [roles.label])
    skip = {roles.entity, roles.row_id}
    return cols.require_scalar(unique, [c for c in unique.columns if c not in skip])
