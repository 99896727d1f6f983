from ebbline.sources.bucketed import write_bucketed
from ebbline.sources.readers import jdbc_options, load_features, read_csv, read_jdbc, read_json
from ebbline.sources.sample_log import sample_log
from ebbline.sources.scratch import drop_scratch, materialize, scratch_path
from ebbline.sources.writers import append_csv, export, register_view

__all__ = [
    "append_csv",
    "drop_scratch",
    "export",
    "jdbc_options",
    "load_features",
    "materialize",
    "read_csv",
    "read_jdbc",
    "read_json",
    "register_view",
    "sample_log",
    "scratch_path",
    "write_bucketed",
]
