from .columns import (  # noqa: F401
    bmi, clean_number, first_match, group_admission_location, group_admission_type, group_race,
    ilike_any, na_to_null, nan_to_null, pair_part, plausible, presence_flag, strip_prefix,
    typed_value,
)
from .tails import chi_square_tail, kolmogorov_tail, normal_two_sided_tail  # noqa: F401
