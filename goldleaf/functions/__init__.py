from goldleaf.functions.scalars import (  # noqa: F401
    POSITION_LABELS,
    full_name,
    nullif_zero,
    position_label,
    round_half_up,
    safe_divide,
    snapshot_stamp,
    tenths_to_units,
)
