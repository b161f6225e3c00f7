"""Panel analytics on Spark: preparation, resampling, training and evaluation.

Every operator takes DataFrames and returns DataFrames.  Column roles (entity,
time, label, score, prediction, features) are always arguments.
"""

from panelwise.roles import ColumnRoles

__all__ = ["ColumnRoles"]
