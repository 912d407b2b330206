"""Set-oriented table changes on Spark: merge, sync, lookup, batch update, graphs, change sets.

Every operation builds a DataFrame plan; nothing is written until a result is published.
"""

from .columns import ColumnPlan, resolve_columns
from .operators import (Aggregate, ForeignKey, Lookup, Many, MergeResult, Node, One, append_rows, apply_changes,
                        assign_identity, batch_delete, batch_update, cascade_delete, dedupe, duplicate_keys,
                        fill_self_reference, flatten_graph, insert, lookup, merge, merge_folder, merge_graph, merge_into,
                        rank_rows, table_diff, table_diff_digest)
from .operators.keys import assert_unique
from .sources import truncate
from .spec import Converter, MergeOptions, TableSpec


def upsert(target, source, spec, **settings):
    """Update matched rows that differ, insert the others, keep the rest of the table."""
    return merge(target, source, spec, "upsert", **settings)


def update(target, source, spec, **settings):
    """Update matched rows that differ; source rows without a partner are ignored."""
    return merge(target, source, spec, "update", **settings)


def delete(target, source, spec, **settings):
    """Remove the rows whose key the source holds."""
    return merge(target, source, spec, "delete", **settings)


def sync(target, source, spec, **settings):
    """Upsert, and remove (or soft-delete) the rows the source lacks."""
    return merge(target, source, spec, "sync", **settings)


def insert_absent(target, source, spec, **settings):
    """Insert the rows whose key the table lacks; leave the others alone."""
    return merge(target, source, spec, "insert_absent", **settings)
