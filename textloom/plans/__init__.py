from textloom.plans.barrier import computed
from textloom.plans.lineage import discard, durable, fresh_path, shared_folder
from textloom.plans.ordering import range_scan, with_row_index, with_running_total
from textloom.plans.skew import balanced_join, key_weights, lookup_join
