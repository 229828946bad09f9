"""Collections of JSON-like documents on Spark: read, search, project, decode, write by id, stream."""

from .functions.decode import (
    as_array,
    as_nested,
    decode,
    detect_geo_point,
    detect_geo_shape,
    empty_as_null,
    geo_point,
    geo_point_format,
    geo_shape,
    normalize_join,
    parse_bool,
    parse_date,
    parse_date_nanos,
    vector,
)
from .functions.documents import NOT_FOUND, extract, field_or_const, first_found, json_paths, to_document
from .functions.predicates import (
    Predicate,
    bool_,
    constant_score,
    contains,
    dsl,
    ends_with,
    equals,
    exists,
    filtered,
    is_in,
    is_not_null,
    is_null,
    match,
    match_all,
    match_any,
    missing,
    null_safe_eq,
    query_string,
    range,  # noqa: A004
    starts_with,
    term,
    terms,
    uri_query,
    wildcard,
)
from .operators.errors import (
    RejectedDocuments,
    collect_to,
    handle,
    malformed_as_rejected,
    retry_rejected,
    to_error_events,
)
from .operators.merge import (
    WriteResult,
    delete_by_query,
    place_by_routing,
    routing_of,
    with_write_meta,
    write_create,
    write_delete,
    write_index,
    write_json_docs,
    write_script,
    write_update,
    write_upsert,
    write_versioned,
)
from .operators.paging import limit_per_partition, page_after, slice_counts, slice_scan
from .operators.project import (
    flatten,
    flatten_schema,
    project_fields,
    project_for_write,
    source_filter,
    validate_fields,
)
from .operators.search import count_docs, search
from .operators.write import (
    MergeReport,
    commit_merge,
    expire_versions,
    external_table,
    insert_overwrite,
    is_valid_name,
    merge_collection,
    save_collection,
    save_many,
    split_index,
    with_index,
    write_dynamic,
    write_target,
)
from .sources.collections import is_empty, persisted, read_alias, read_collection, read_collections, register_view
from .sources.json_docs import detect_geo, mapped_schema, parse_docs, read_json_docs, read_pairs, with_metadata
from .sources.mapping import merge_mappings, parse_mapping, to_schema
from .streaming.sink import (
    commit_history,
    compact_stream,
    expire_batches,
    read_stream_collection,
    read_stream_errors,
    stream_to_collection,
)
