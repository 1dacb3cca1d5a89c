"""DataFrame -> DataFrame cleaning operators."""

from .cube import quality_cube
from .currency import check_usd, convert_currency_to_usd
from .dedup import deduplicate_rows, drop_all, keep_first
from .diff import cleaning_diff
from .growing import grow_profile, stored_profile
from .impute import (
    BoolMajority,
    CatConstant,
    CatMode,
    CatNewLevel,
    NumConstant,
    NumMean,
    NumMedian,
    impute_missing,
    impute_report,
)
from .normalize import (
    normalize,
    normalize_company_size,
    normalize_country,
    normalize_employment_type,
    normalize_experience_level,
    normalize_job_title,
    normalize_remote_ratio,
)
from .quality import (
    check_column,
    clamp,
    plausible_year,
    validate_range,
    validate_range_table,
    validate_salary_ranges,
    winsor_bounds,
    winsorize,
)
from .quantiles import exact_quantiles
from .report import cleaning_report
from .schema import (
    missing_columns,
    salary_table,
    standardize_colnames,
    validate_schema,
)
from .typing import enforce_types, type_profile

__all__ = [name for name in dir() if not name.startswith("_")]
