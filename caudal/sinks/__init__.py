"""Writers of output tables."""

from caudal.sinks.files import (
    write_by_variable, write_csv, write_json, write_observations, write_records_xml, write_result, write_scratch,
    write_steps,
)
from caudal.sinks.named import file_name, page_copies, read_named, records_as_files, write_named

__all__ = [
    "file_name", "page_copies", "read_named", "records_as_files", "write_by_variable", "write_csv", "write_json",
    "write_named", "write_observations", "write_records_xml", "write_result", "write_scratch", "write_steps",
]
