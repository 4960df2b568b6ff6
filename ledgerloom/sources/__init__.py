"""Reading landed files and writing tables."""
from .catalog import Catalog
from .constants import aggregator_rows, literal
from .landed import landed_stream, read_landed
from .sinks import (append_once, clustered, delete_insert, evolve, merge_upsert, range_pruned_merge,
                    read_marks, read_table, upsert_table, write_bucketed, write_clustered)
