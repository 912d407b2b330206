from .batch import Aggregate, Lookup, batch_delete, batch_update
from .changeset import ForeignKey, apply_changes, cascade_delete, cascade_delete_tree, table_groups, topological_order
from .digests import TableDigests, differing_ranges, digest_columns, digest_table, table_diff_digest
from .folders import merge_folder, read_folder
from .graph import Many, Node, One, fill_self_reference, flatten_graph, merge_graph
from .hierarchy import rows_of_type, split_types, union_types, with_type
from .identity import assign_identity, rank_rows
from .intervals import key_intervals, within
from .keys import dedupe, duplicate_keys
from .lookup import lookup
from .merge import MergeResult, append_rows, insert, merge, table_diff
from .row_level import merge_into
from .topn import first_rows
from .tree import ancestry
