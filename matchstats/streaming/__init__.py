from matchstats.streaming.ingest import (  # noqa: F401
    validate_feed, feed_to_master_rows, new_master_rows, ingest_batch, run_ingest_stream,
)
from matchstats.streaming.update import make_update_hook  # noqa: F401
from matchstats.streaming.ingest import (  # noqa: F401
    scratch_dir,
)
