"""Readers, writers and the trip table derived from the driver's ``events``."""

from meterline.sources.fixtures import raw_trips_from_events  # noqa: F401
from meterline.sources.readers import (  # noqa: F401
    read_clean_parquet,
    read_raw_csv,
    read_result_csv,
)
from meterline.sources.sinks import (  # noqa: F401
    load_pipeline_model,
    publish_tables,
    save_pipeline_model,
    write_parquet,
    write_single_csv,
)
