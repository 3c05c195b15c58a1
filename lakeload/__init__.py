"""lakeload: move relational tables into a lakehouse with the right types, as Spark jobs.

Sub-packages:

* ``sources``    scans: whole, filtered, SQL, row key, key ranges, hash buckets, samples, as-of
* ``functions``  column expressions: value classification, type ladder, checked casts, partition transforms
* ``operators``  DataFrame jobs: numeric profiles, keys, rejects, metadata report
* ``plans``      type planning: rules, precedence, inferred overrides, type maps
* ``sinks``      writes: full replace, append, keyed merge, partitioned layout, load summary
* ``streaming``  incremental loads of newly arrived files with Structured Streaming
"""

__version__ = "0.1.0"

from lakeload.functions.transforms import add_partitions, prune_by  # noqa: E402
from lakeload.operators.keys import (check_key, describe_columns, key_candidates, key_violations,  # noqa: E402
                                     row_counts, split_key)
from lakeload.operators.profile import (merge_profiles, profile_numbers, recommend_types,  # noqa: E402
                                        storage_estimate)
from lakeload.operators.report import object_info, report_json, report_rows, write_report  # noqa: E402
from lakeload.plans.apply import apply_type_plan, cast_columns, cast_rejects, reject_summary  # noqa: E402
from lakeload.plans.rules import parse_rule_text, parse_rules  # noqa: E402
from lakeload.plans.typeplan import (number_declarations, plan_types, read_type_map,  # noqa: E402
                                     recommended_names, type_map)
from lakeload.sinks.load import load  # noqa: E402
from lakeload.sinks.table import read_version  # noqa: E402
from lakeload.sources.jdbc import JdbcSource  # noqa: E402
from lakeload.sources.scan import (hash_buckets, key_bounds, key_ranges, sample_plan, sample_rows,  # noqa: E402
                                   scan_as_of, scan_sample, scan_table, with_key_ranges)
from lakeload.streaming.incremental import loaded_profile, stream_load  # noqa: E402

__all__ = [
    "JdbcSource", "add_partitions", "apply_type_plan", "cast_columns", "cast_rejects", "check_key",
    "describe_columns", "hash_buckets", "key_bounds", "key_candidates", "key_ranges", "key_violations", "load",
    "loaded_profile", "merge_profiles", "number_declarations", "object_info", "parse_rule_text", "parse_rules",
    "plan_types", "profile_numbers", "prune_by", "read_type_map", "read_version", "recommend_types",
    "recommended_names", "reject_summary", "report_json", "report_rows", "row_counts", "sample_plan", "sample_rows",
    "scan_as_of", "scan_sample", "scan_table", "split_key", "storage_estimate", "stream_load", "type_map",
    "with_key_ranges", "write_report",
]
