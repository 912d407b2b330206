from .pages import from_pages
from .publish import append, drop_old_versions, publish_partitions, publish_table, publish_tables, truncate
from .readers import from_reader, from_rows, from_table, rename_columns, scoped, source_limit
from .staging import discard_all, stage
