from pricelake.functions.scalar import (  # noqa: F401
    any_of,
    cap_category,
    day_of_week0,
    exact_avg,
    exact_ratio,
    initcap_words,
    outside,
    run_type,
    safe_divide,
    sma_signal,
    surrogate_key,
    trunc_date,
)
