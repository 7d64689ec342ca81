from matchstats.sources.schemas import (  # noqa: F401
    FORMER_NAMES_SCHEMA, GOALSCORERS_SCHEMA, RESULTS_SCHEMA, SHOOTOUTS_SCHEMA, NEW_MATCH_SCHEMA,
)
from matchstats.sources.io import (  # noqa: F401
    read_raw_csv, load_raw_tables, write_master_parquet, write_master_csv, append_jsonl, read_scorer_source,
)
from matchstats.sources.testdata import load_fixture_tables  # noqa: F401
