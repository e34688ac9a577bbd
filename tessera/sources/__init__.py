from tessera.sources.incremental import (
    data_folders, new_folders, read_incremental, run_incremental, taken_folders,
)
from tessera.sources.tables import document_lines, fields_table, lines_frame, table
from tessera.sources.text_dirs import (
    completed_dirs, file_date, in_date_range, is_directory, path_date, read_partitioned_text,
    read_text_dirs,
)

__all__ = [
    "data_folders", "new_folders", "read_incremental", "run_incremental", "taken_folders",
    "document_lines", "fields_table", "lines_frame", "table", "completed_dirs", "file_date",
    "in_date_range", "is_directory", "path_date", "read_partitioned_text", "read_text_dirs",
]
