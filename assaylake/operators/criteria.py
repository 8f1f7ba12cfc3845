"""Outlier criteria as checked settings, compiled to a flag and its reasons."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Criterion(NamedTuple):
    """What is compared, whether it must not be below (or else above) the limit, and what it is called if it is."""

    value: str
    least: bool
    reason: str


#: Criteria by the level that they judge. A limit of None is not checked.
CELL = {"min_cell_size": Criterion("sizes", True, "too_small"), "max_cell_size": Criterion("sizes", False, "too_large"), "min_nucleus_size": Criterion("nucleus_sizes", True, "nucleus_too_small"), "max_nucleus_size": Criterion("nucleus_sizes", False, "nucleus_too_large")}
IMAGE = {"min_number_cells": Criterion("n_cells", True, "too few cells"), "max_number_cells": Criterion("n_cells", False, "too many cells")}
WELL = {"min_number_control_cells": Criterion("n_control", True, "too few control cells"), "min_number_infected_cells": Criterion("n_infected", True, "too few infected cells"), "min_infected_intensity": Criterion("infected_mean", True, "too low infected intensity"), "max_ratio": Criterion("ratio", False, "too high ratio")}

#: Limits that the assay uses; fixed values.
CELL_DEFAULTS = {"max_cell_size": 12500, "min_cell_size": 250, "min_nucleus_size": None, "max_nucleus_size": None}
IMAGE_DEFAULTS = {"max_number_cells": 1000, "min_number_cells": 10}
WELL_DEFAULTS = {"min_number_control_cells": 100, "min_number_infected_cells": None, "min_infected_intensity": None, "max_ratio": None}


def compiled(criteria: Mapping[str, Criterion], limits: Mapping[str, Column | float | None]) -> tuple[Column, Column]:
    """(flag, reasons) of a level's criteria with these limits. The flag is 1 where a limit is passed, 0 where none is, and
    -1 if nothing is checked; reasons is the array of what is wrong. A null value passes no limit.

    The keys must be the criteria's: a missing or unknown one is an error, so that a misspelt limit isn't left unchecked.
    A limit is a number or a column, as one that depends on the plate.
    """
    if set(limits) != set(criteria):
        missing, unknown = sorted(set(criteria) - set(limits)), sorted(set(limits) - set(criteria))
        raise ValueError(f"criteria {missing} are missing and {unknown} are unknown")
    checks = []
    for key, (value, least, reason) in criteria.items():
        if (limit := limits[key]) is not None:
            checks.append(F.when(F.col(value) < limit if least else F.col(value) > limit, F.lit(reason)))
    if not checks:
        return F.lit(-1), F.array().cast("array<string>")
    why = F.array_compact(F.array(*checks))
    return (F.size(why) > 0).cast("int"), why


def judged(rows: DataFrame, criteria: Mapping[str, Criterion], limits: Mapping[str, Column | float | None], sep: str = ";") -> DataFrame:
    """``rows`` with is_outlier and outlier_type: the reasons put together, ``none`` without one, ``not_checked`` if nothing is."""
    flag, why = compiled(criteria, limits)
    named = F.when(flag < 0, "not_checked").when(F.size(why) > 0, F.concat_ws(sep, why)).otherwise("none")
    return rows.withColumns({"is_outlier": flag, "outlier_type": named})


def tags_by(images: DataFrame, predicate: Callable[[pd.Series], pd.Series], *columns: str) -> DataFrame:
    """image, tag by an own predicate: a function of the series of images (or of ``columns``) that tells for each -1 (not
    judged), 0 (accepted) or 1 (outlier), a batch at a time. Another value, a null, or a series of another length
    stops the job with an error. Rows of one image are judged once each; an empty table gives no rows."""

    @F.pandas_udf("int")
    def tag(*series: pd.Series) -> pd.Series:
        out = pd.Series(predicate(*series)).reset_index(drop=True)
        if len(out) != len(series[0]) or not out.isin([-1, 0, 1]).all():
            raise ValueError("a predicate tells -1, 0 or 1 of each image")
        return out.astype("int32")

    return images.select("image", tag(*[F.col(c) for c in (columns or ("image",))]).alias("tag"))
