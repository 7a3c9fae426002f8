"""DataFrame -> DataFrame operators (usable with ``df.transform``)."""

from blotter.operators.clean import clean_description, clean_district, dirty_row_filter
from blotter.operators.counters import Counters, count_by_watched
from blotter.operators.counts import count_by, count_by_type
from blotter.operators.joins import carried_forward, join_lookup, lookup_descriptions, tagged_union_join
from blotter.operators.layout import key_faults, order_faults
from blotter.operators.ordering import (
    hash_partition,
    order_by_district_count,
    order_by_year,
    range_sort,
    secondary_sort,
    split_points,
)
from blotter.operators.placement import (
    bottom_k,
    natural_key_sort,
    partition_by_points,
    partition_sizes,
    points_at,
    read_points,
    sample_points,
    string_hash,
    write_points,
)
from blotter.operators.rates import (
    arrest_rate_exact,
    arrest_rate_rounded,
    arrest_rate_two_aggregates,
)

__all__ = [
    "clean_description",
    "clean_district",
    "dirty_row_filter",
    "Counters",
    "count_by",
    "count_by_watched",
    "count_by_type",
    "carried_forward",
    "join_lookup",
    "lookup_descriptions",
    "tagged_union_join",
    "hash_partition",
    "key_faults",
    "order_by_district_count",
    "order_by_year",
    "order_faults",
    "range_sort",
    "secondary_sort",
    "split_points",
    "bottom_k",
    "natural_key_sort",
    "partition_by_points",
    "partition_sizes",
    "points_at",
    "read_points",
    "sample_points",
    "string_hash",
    "write_points",
    "arrest_rate_exact",
    "arrest_rate_rounded",
    "arrest_rate_two_aggregates",
]
