from encore.sources.landing import (  # noqa: F401
    flatten_audio,
    flatten_popularity,
    flatten_recordings,
    last_popularity,
)
from encore.sources.tables import (  # noqa: F401
    attribute_rows,
    load_model,
    read_corpus_csv,
    read_table,
    save_model,
    write_csv,
    write_summary,
)
