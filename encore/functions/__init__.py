from encore.functions.cells import (  # noqa: F401
    bin_label,
    clip_keep_null,
    compact_number,
    fill_unknown,
    gate_range,
    lenient,
    minutes_seconds,
    model_slug,
    null_column,
    year_prefix,
)
from encore.functions.text import (  # noqa: F401
    adjacent_pairs,
    clean_text,
    flip_the,
    match_key,
    non_blank_lines,
    sorted_words,
    strip_whitespace,
    word_list,
)
